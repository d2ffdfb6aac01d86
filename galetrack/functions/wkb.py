"""Well-known binary as column expressions: points, lines, polygons, both ways.

No bytes of a double can be had in SQL, so its sign, exponent and fraction are worked out
by exact arithmetic (scaling by powers of two) and put together as hexadecimal text, in
time linear in the vertices. Written is big-endian; read are both byte orders.

A line is an array of structs (x, y), a polygon an array of closed rings, the outer one
first, a collection of polygons an array of those. Defined results: null gives null, as does
an empty array, or one with a null inside; a point with a null coordinate is null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Kinds of geometry.
POINT, LINE, POLYGON, POLYGONS = 1, 2, 3, 6
NAMES = {POINT: "Point", LINE: "LineString", POLYGON: "Polygon", POLYGONS: "MultiPolygon"}
SPOTS = "array<struct<x: double, y: double>>"
_HEAD, _INT, _DOUBLE = 10, 8, 16  # hexadecimal digits


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of ``value``, which is worked out once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def bits(number: Column) -> Column:
    """The 64 bits of a double, as a long."""
    infinite, no_number, fraction = 0x7FF0000000000000, 0x7FF8000000000000, 2.0**52

    def magnitude(a: Column) -> Column:
        def scaled(guess: Column) -> Column:
            def fix(m: Column) -> Column:  # the logarithm may be off by one next to powers of two
                low, high = m < 1.0, m >= 2.0
                exponent = guess + F.when(low, -1).when(high, 1).otherwise(0)
                part = F.when(low, m * 2.0).when(high, m / 2.0).otherwise(m)
                return F.shiftleft(exponent.cast("long") + 1023, 52) + ((part - 1.0) * fraction).cast("long")

            return let(a / F.pow(F.lit(2.0), guess.cast("double")), fix)

        tiny = (a * 2.0**537 * 2.0**537).cast("long")
        exponent = F.greatest(F.least(F.floor(F.log2(a)).cast("int"), F.lit(1023)), F.lit(-1022))
        return F.when(F.isnan(a), F.lit(no_number)).when(a > 1.7976931348623157e308, F.lit(infinite)).when(a < 2.0**-1022, tiny).otherwise(let(exponent, scaled))

    negative = (number < 0) | ((number == 0) & number.cast("string").startswith("-"))
    return F.when(number.isNotNull(), let(F.abs(number), magnitude).bitwiseOR(F.when(negative, F.lit(-(2**63))).otherwise(F.lit(0))))


def _double(number: Column) -> Column:
    return F.lpad(F.hex(bits(number)), 16, "0")


def _int(number: Column) -> Column:
    return F.lpad(F.hex(number), 8, "0")


def _start(kind: int) -> Column:
    return F.lit(f"00{kind:08X}")


def _many(parts: Column, one: Callable[[Column], Column]) -> Column:
    """A count and each part; a null among the parts makes all null."""
    made = F.transform(parts, one)
    whole = (F.size(parts) > 0) & ~F.exists(made, lambda m: m.isNull())
    return F.when(whole, F.concat(_int(F.size(parts)), F.array_join(made, "")))


def _spot(spot: Column) -> Column:
    return F.concat(_double(spot["x"]), _double(spot["y"]))


def _ring(ring: Column) -> Column:
    return _many(ring, _spot)


def point(x: Column, y: Column) -> Column:
    return F.unhex(F.concat(_start(POINT), _double(x), _double(y)))


def line(spots: Column) -> Column:
    return F.unhex(F.concat(_start(LINE), _many(spots, _spot)))


def polygon(rings: Column) -> Column:
    return F.unhex(F.concat(_start(POLYGON), _many(rings, _ring)))


def polygons(parts: Column) -> Column:
    return F.unhex(F.concat(_start(POLYGONS), _many(parts, lambda rings: F.concat(_start(POLYGON), _many(rings, _ring)))))


# Reading.


def _swapped(digits: Column, bytes_: int) -> Column:
    return F.concat(*[F.substr(digits, F.lit(2 * i + 1), F.lit(2)) for i in reversed(range(bytes_))])


def _field(text: Column, at: Column, size: int, little: Column) -> Column:
    """``size`` digits from the place ``at`` (from 0), the highest byte first."""
    return let(F.substr(text, at + 1, F.lit(size)), lambda d: F.when(little, _swapped(d, size // 2)).otherwise(d))


def _int_at(text: Column, at: Column, little: Column) -> Column:
    return F.conv(_field(text, at, _INT, little), 16, 10).cast("int")


def _double_at(text: Column, at: Column, little: Column) -> Column:
    def number(digits: Column) -> Column:
        top = F.conv(F.substr(digits, F.lit(1), F.lit(3)), 16, 10).cast("int")
        rest = F.conv(F.substr(digits, F.lit(4), F.lit(13)), 16, 10).cast("long").cast("double")
        exponent = top.bitwiseAND(F.lit(0x7FF))
        normal = (rest / 2.0**52 + 1.0) * F.pow(F.lit(2.0), (exponent - 1023).cast("double"))
        size = F.when(exponent == 0x7FF, F.when(rest == 0, float("inf")).otherwise(float("nan"))).when(exponent == 0, rest * 2.0**-537 * 2.0**-537).otherwise(normal)
        return F.when(top >= 0x800, -size).otherwise(size)

    return let(_field(text, at, _DOUBLE, little), number)


def _spots_at(text: Column, at: Column, count: Column, little: Column) -> Column:
    spot = lambda i: F.struct(_double_at(text, at + i * 2 * _DOUBLE, little).alias("x"), _double_at(text, at + i * 2 * _DOUBLE + _DOUBLE, little).alias("y"))
    return F.transform(F.sequence(F.lit(0), count - 1), spot)


def _fold(count: Column, at: Column, kind: str, step: Callable[[Column], tuple[Column, Column]]) -> Column:
    """(at, made): ``count`` parts one after another, each beginning where the last one ends."""
    start = F.struct(at.alias("at"), F.array().cast(f"array<{kind}>").alias("made"))

    def join(so_far: Column, _: Column) -> Column:
        made, end = step(so_far["at"])
        return F.struct(end.alias("at"), F.concat(so_far["made"], F.array(made)).alias("made"))

    return F.aggregate(F.sequence(F.lit(1), count), start, join)


def _rings_at(text: Column, at: Column, little: Column) -> Column:
    """(at, made) of a polygon's rings; ``at`` is the place of their number."""

    def ring(place: Column) -> tuple[Column, Column]:
        count = _int_at(text, place, little)
        return _spots_at(text, place + _INT, count, little), place + _INT + count * 2 * _DOUBLE

    return _fold(_int_at(text, at, little), at + _INT, SPOTS, ring)


def _little(text: Column, at: Column) -> Column:
    return F.substr(text, at + 2, F.lit(1)) == "1"


def kind(geometry: Column) -> Column:
    """The number of a geometry's kind."""
    return let(F.hex(F.substr(geometry, F.lit(1), F.lit(5))), lambda h: _int_at(h, F.lit(2), _little(h, F.lit(0))))


def _read(geometry: Column, wanted: int, then: Callable[[Column, Column], Column]) -> Column:
    return F.when(kind(geometry) == wanted, let(F.hex(geometry), lambda h: then(h, _little(h, F.lit(0)))))


def as_point(geometry: Column) -> Column:
    """A struct (x, y); null for another kind, as with all of these."""
    return _read(geometry, POINT, lambda h, e: F.struct(_double_at(h, F.lit(_HEAD), e).alias("x"), _double_at(h, F.lit(_HEAD + _DOUBLE), e).alias("y")))


def as_line(geometry: Column) -> Column:
    return _read(geometry, LINE, lambda h, e: _spots_at(h, F.lit(_HEAD + _INT), _int_at(h, F.lit(_HEAD), e), e))


def as_polygon(geometry: Column) -> Column:
    return _read(geometry, POLYGON, lambda h, e: _rings_at(h, F.lit(_HEAD), e)["made"])


def as_polygons(geometry: Column) -> Column:
    def all_of(h: Column, little: Column) -> Column:
        def part(place: Column) -> tuple[Column, Column]:
            rings = _rings_at(h, place + _HEAD, _little(h, place))
            return rings["made"], rings["at"]

        return _fold(_int_at(h, F.lit(_HEAD), little), F.lit(_HEAD + _INT), f"array<{SPOTS}>", part)["made"]

    return _read(geometry, POLYGONS, all_of)
