"""Domain constants and the scalar functions over them, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the best-track format and the intensity scale.
MISSING = (-999, -99)
RECORD_IDENTIFIERS = ("C", "G", "I", "L", "P", "R", "S", "T", "W")
STATUSES = ("TD", "TS", "HU", "EX", "SD", "SS", "LO", "WV", "DB")
TROPICAL_STATUSES = ("TD", "TS", "HU", "SD", "SS")
SYNOPTIC_HOURS = (0, 6, 12, 18)
BASINS = ("AL", "EP", "CP")
CATEGORY_FLOORS = ((137, "5"), (113, "4"), (96, "3"), (83, "2"), (64, "1"), (34, "TS"))
CATEGORIES = ("UNK", "TD", "TS", "1", "2", "3", "4", "5")
MAJOR_FLOOR = 96
HURRICANE_FLOOR = 64
CONUS_ERAS = ((1851, 1970), (1991, 9999))
INTERNATIONAL_ERAS = ((1951, 1970), (1991, 9999))
BYPASS_RADIUS_KM = 111.12
#: Classes in rank order.
CLASSES = ("Hurricane (Cat 1+)", "Tropical storm", "Depression", "Extratropical / other", "Unclassified (no wind)")
#: The units of the continental United States, by name.
CONUS_UNITS = (
    "Texas", "Louisiana", "Mississippi", "Alabama", "Florida", "Georgia", "South Carolina", "North Carolina", "Virginia", "Maryland",
    "Delaware", "New Jersey", "New York", "Pennsylvania", "Connecticut", "Rhode Island", "Massachusetts", "New Hampshire", "Maine", "District of Columbia",
)
NUMBER_WORDS = ("One", "Two", "Three", "Four", "Five", "Six", "Seven", "Eight", "Nine", "Ten", "Eleven", "Twelve", "Thirteen", "Fourteen", "Fifteen")


def ss_category(wind: Column) -> Column:
    """Saffir-Simpson label from wind alone; UNK for null or negative wind."""
    out = F.when(wind.isNull() | (wind < 0), "UNK")
    for floor, label in CATEGORY_FLOORS:
        out = out.when(wind >= floor, label)
    return out.otherwise("TD")


def is_major(wind: Column) -> Column:
    return F.coalesce(wind >= MAJOR_FLOOR, F.lit(False))


def is_tropical(status: Column) -> Column:
    return F.coalesce(status.isin(*TROPICAL_STATUSES), F.lit(False))


def in_eras(year: Column, eras: tuple[tuple[int, int], ...]) -> Column:
    out = F.lit(False)
    for first, last in eras:
        out = out | year.between(first, last)
    return out


def flagging_complete(season: Column, conus: Column) -> Column:
    """Whether the source flags landfalls completely in a season, by region."""
    return F.when(conus, in_eras(season, CONUS_ERAS)).otherwise(in_eras(season, INTERNATIONAL_ERAS))


def flag_era(season: Column) -> Column:
    return F.when(season <= 1970, "1851-1970").when(season <= 1990, "1971-1990").otherwise("1991 onward")


def event_class(status: Column, wind: Column) -> Column:
    """Class by status first, then by wind: whatever isn't tropical or subtropical is other."""
    hurricane, storm, depression, other, unknown = CLASSES
    return (
        F.when(~is_tropical(status), other)
        .when(wind.isNull(), unknown)
        .when(wind >= HURRICANE_FLOOR, hurricane)
        .when(wind >= 34, storm)
        .otherwise(depression)
    )


def class_rank(name: Column) -> Column:
    out = F.when(F.lit(False), F.lit(0))
    for i, c in enumerate(CLASSES):
        out = out.when(name == c, i)
    return out.otherwise(len(CLASSES)).cast("int")


def system_type(status: Column, wind: Column) -> Column:
    """The display's marker: status first; a null wind counts as a depression."""
    return F.when(~is_tropical(status), "extratropical").when(wind >= HURRICANE_FLOOR, "hurricane").when(wind >= 34, "tropical").otherwise("depression")


def is_synoptic(ts: Column) -> Column:
    return (F.minute(ts) == 0) & F.hour(ts).isin(*SYNOPTIC_HOURS)


def wrapped_longitude(x: Column) -> Column:
    """Into [-180, 180], both ends kept."""
    return F.when(x > 180, x - 360).when(x < -180, x + 360).otherwise(x)


def measured(token: Column) -> Column:
    """An integer field: blank and the sentinels are null."""
    value = F.trim(token).try_cast("int")
    return F.when(value.isin(*MISSING), F.lit(None)).otherwise(value)


def interpolated_int(a: Column, b: Column, fraction: Column) -> Column:
    """Rounded half to even; null if either end is."""
    return F.bround(a + (b - a) * fraction, 0).cast("int")


def interpolated_time(a: Column, b: Column, fraction: Column) -> Column:
    us = F.unix_micros(a) + F.bround((F.unix_micros(b) - F.unix_micros(a)) * fraction, 0).cast("long")
    return F.timestamp_micros(us)


def hours_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(3.6e9)


def decade(season: Column) -> Column:
    return (F.floor(season / 10) * 10).cast("int")


def published_label(name: Column, season: Column, number: Column | None = None) -> Column:
    """As in "Ida (2021)"; unnamed systems go by their number, spelled out up to fifteen."""
    label = name
    if number is not None:
        spelled = F.coalesce(F.get(F.array(*[F.lit(w) for w in NUMBER_WORDS]), number - 1), number.cast("string"))
        label = F.when(F.upper(name) == "UNNAMED", spelled).otherwise(name)
    return F.concat(F.initcap(F.lower(label)), F.lit(" ("), season.cast("string"), F.lit(")"))


def point_wkt(lon: Column, lat: Column) -> Column:
    return F.concat(F.lit("POINT ("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))


def line_wkt(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.concat(F.lit("LINESTRING ("), F.concat_ws(", ", *[F.concat_ws(" ", x.cast("string"), y.cast("string")) for x, y in ((x1, y1), (x2, y2))]), F.lit(")"))
