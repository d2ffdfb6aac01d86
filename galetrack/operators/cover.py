"""A quadtree of cells over land: wholly sea, wholly land, or boundary with its own edges.

Cells of level l are 2 / 2**l degrees wide. A cell that an edge touches (its border
counts) is a boundary cell and is cut in four, down to level ``LEAST_LEVEL``, and further
while it has more than ``MOST_EDGES`` edges. What is left are leaves: boundary cells keep
the edges in them and no others, and, for each unit at hand, whether their middle is
inside; cells without edges lie in one unit or in none, and those of the sea are no rows.

Whether a unit holds a point of a boundary cell follows from the middle and from the
cell's own edges on the way from the middle to the point, first up or down, then along.
As in the plane topology of a union, the boundary of all land is outside, and borders
between units are inside (in the unit of the smallest id).

Stretches of a track are put in cells the same way: long ones against coarse cells, those
that meet a boundary cell in short ones against fine cells, and only what still meets
one in samples. Nothing else of a track becomes rows.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galetrack.functions import domain
from galetrack.functions.geodesy import haversine_km, with_destination, with_geodesic
from galetrack.operators import geometry
from galetrack.operators.stage import settle

WIDTH, LEAST_LEVEL, DEEPEST, MOST_EDGES = 2.0, 4, 10, 32
#: Samples in a long and in a short stretch, and the levels whose cells they meet.
STRETCHES = ((64, 1), (8, 4))

_EDGE = ("x1", "y1", "x2", "y2", "coast")


def size(level: int) -> float:
    return WIDTH / 2**level


def _touched(low: Column, high: Column, width: float) -> Column:
    """Cells that a closed range meets, borders included."""
    return F.sequence((F.ceil(low / F.lit(width)) - 1).cast("int"), F.floor(high / F.lit(width)).cast("int"))


def _meets(width: float) -> Column:
    """Whether the edge x1, y1, x2, y2 touches the closed cell cx, cy: its box does, and
    the cell's corners aren't all on one side."""
    xa, ya = F.col("cx") * F.lit(width), F.col("cy") * F.lit(width)
    xb, yb = xa + width, ya + width
    box = (F.least("x1", "x2") <= xb) & (F.greatest("x1", "x2") >= xa) & (F.least("y1", "y2") <= yb) & (F.greatest("y1", "y2") >= ya)
    side = lambda x, y: (F.col("x2") - F.col("x1")) * (y - F.col("y1")) - (F.col("y2") - F.col("y1")) * (x - F.col("x1"))
    corners = [side(x, y) for x in (xa, xb) for y in (ya, yb)]
    return box & (F.least(*corners) <= 0) & (F.greatest(*corners) >= 0)


def pieces(edges: DataFrame) -> DataFrame:
    """``edges`` cut at shared vertices, with ``coast``: whether they bound the union."""
    fine = settle(geometry.split_edges(edges), "cover-edges")
    shore = geometry.normalised(geometry.boundary_edges(fine)).select("p", "q", F.lit(True).alias("coast"))
    return geometry.normalised(fine).join(shore, ["p", "q"], "left").select("unit_id", "x1", "y1", "x2", "y2", F.coalesce("coast", F.lit(False)).alias("coast"))


def build(edges: DataFrame) -> DataFrame:
    """level, cx, cy, kind and units of each leaf, and of the cells that were cut.

    kind is 'land' (``units`` has one without edges), 'boundary' or 'cut' (no units).
    """
    own = settle(pieces(edges), "cover-pieces")
    held = own.withColumn("cx", F.explode(_touched(F.least("x1", "x2"), F.greatest("x1", "x2"), WIDTH)))
    held = held.withColumn("cy", F.explode(_touched(F.least("y1", "y2"), F.greatest("y1", "y2"), WIDTH))).where(_meets(WIDTH))
    boxes = own.groupBy("unit_id").agg(*[f(g(a, b)).alias(n) for n, f, g, a, b in (("xa", F.min, F.least, "x1", "x2"), ("xb", F.max, F.greatest, "x1", "x2"), ("ya", F.min, F.least, "y1", "y2"), ("yb", F.max, F.greatest, "y1", "y2"))])
    every = boxes.withColumn("cx", F.explode(_touched(F.col("xa"), F.col("xb"), WIDTH))).withColumn("cy", F.explode(_touched(F.col("ya"), F.col("yb"), WIDTH))).select("cx", "cy").distinct()
    cut, open_, leaves = [], [], []
    for level in range(DEEPEST + 1):
        held = settle(held, f"cover-{level}")
        many = F.count("*").over(Window.partitionBy("cx", "cy")) > (0 if level < LEAST_LEVEL else MOST_EDGES)
        marked = held.withColumn("many", many & F.lit(level < DEEPEST))
        at = F.lit(level).alias("level")
        empty = every.join(held.select("cx", "cy").distinct(), ["cx", "cy"], "left_anti")
        open_.append(empty.select(at, "cx", "cy"))
        leaves.append(marked.where("not many").select(at, "cx", "cy", "unit_id", *_EDGE))
        split = marked.where("many").drop("many")
        if split.isEmpty():
            break
        cut.append(split.select(at, "cx", "cy").distinct())
        four = F.explode(F.array(*[F.struct((F.col("cx") * 2 + i).alias("cx"), (F.col("cy") * 2 + j).alias("cy")) for i in (0, 1) for j in (0, 1)]))
        every = split.select("cx", "cy").distinct().select(four.alias("c")).select("c.cx", "c.cy")
        held = split.withColumn("c", four).drop("cx", "cy").select("*", "c.cx", "c.cy").drop("c").where(_meets(size(level + 1)))
    together = functools.partial(functools.reduce, DataFrame.unionByName)
    edged = settle(together(leaves), "cover-leaves")
    wanted = together(open_).withColumn("kind", F.lit("land")).unionByName(edged.select("level", "cx", "cy").distinct().withColumn("kind", F.lit("boundary")))
    middle = settle(_middles(wanted, own), "cover-middles")
    land = middle.where("kind = 'land'").groupBy("level", "cx", "cy", "kind").agg(F.min("unit_id").alias("unit_id"))
    land = land.withColumn("units", F.array(F.struct("unit_id", F.lit(True).alias("inside"), F.array().cast(f"array<struct<{', '.join(f'{c}: double' for c in _EDGE[:4])}, coast: boolean>>").alias("edges"))))
    mine = edged.groupBy("level", "cx", "cy", "unit_id").agg(F.collect_list(F.struct(*_EDGE)).alias("edges"))
    inside = middle.where("kind = 'boundary'").select("level", "cx", "cy", "unit_id", F.lit(True).alias("inside"))
    both = mine.join(inside, ["level", "cx", "cy", "unit_id"], "full")
    both = both.withColumns({"inside": F.coalesce("inside", F.lit(False)), "edges": F.coalesce("edges", F.array().cast(mine.schema["edges"].dataType))})
    border = both.groupBy("level", "cx", "cy").agg(F.sort_array(F.collect_list(F.struct("unit_id", "inside", "edges"))).alias("units")).withColumn("kind", F.lit("boundary"))
    cols = ["level", "cx", "cy", "kind", "units"]
    out = land.select(*cols).unionByName(border.select(*cols))
    if cut:
        out = out.unionByName(together(cut).withColumn("kind", F.lit("cut")).withColumn("units", F.lit(None).cast(border.schema["units"].dataType)))
    return out


def _middles(cells: DataFrame, own: DataFrame) -> DataFrame:
    """``cells`` with each unit that holds their middle: by the stretches of each unit on
    the rows of middles, which cells meet by row and column of the first level."""
    levels = [r["level"] for r in cells.select("level").distinct().collect()]
    rows = []
    for level in levels:
        width = size(level)
        y = (F.col("cy") + 0.5) * F.lit(width)
        at = own.withColumn("cy", F.explode(_touched(F.least("y1", "y2"), F.greatest("y1", "y2"), width))).where((F.col("y1") > y) != (F.col("y2") > y))
        rows.append(at.select(F.lit(level).alias("level"), "cy", "unit_id", (F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))).alias("x")))
    met = functools.reduce(DataFrame.unionByName, rows)
    order = Window.partitionBy("level", "cy", "unit_id").orderBy("x")
    met = met.withColumns({"i": F.row_number().over(order), "xb": F.lead("x").over(order)}).where("i % 2 = 1")
    columns = met.withColumn("column", F.explode(F.sequence(F.floor(F.col("x") / WIDTH), F.floor(F.col("xb") / WIDTH))))
    x = (F.col("cx") + 0.5) * F.lit(WIDTH) / F.pow(F.lit(2.0), F.col("level"))
    keyed = cells.withColumn("mid", x).withColumn("column", F.floor(F.col("mid") / WIDTH))
    return keyed.join(columns, ["level", "cy", "column"]).where("x <= mid and mid < xb").select("level", "cx", "cy", "kind", "unit_id")


def _holding(units: Column, x: Column, y: Column, xm: Column, ym: Column) -> Column:
    """The smallest id of the units that hold a point of a leaf with the middle xm, ym."""
    rise = lambda e: e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / (e["y2"] - e["y1"])
    climb = lambda e: e["y1"] + (xm - e["x1"]) * (e["y2"] - e["y1"]) / (e["x2"] - e["x1"])
    along = lambda e: ((e["y1"] > y) != (e["y2"] > y)) & ((x < rise(e)) != (xm < rise(e)))
    up = lambda e: ((e["x1"] > xm) != (e["x2"] > xm)) & ((y < climb(e)) != (ym < climb(e)))
    on = lambda e: (
        ((e["x2"] - e["x1"]) * (y - e["y1"]) == (e["y2"] - e["y1"]) * (x - e["x1"]))
        & (F.least(e["x1"], e["x2"]) <= x) & (x <= F.greatest(e["x1"], e["x2"])) & (F.least(e["y1"], e["y2"]) <= y) & (y <= F.greatest(e["y1"], e["y2"]))
    )
    flips = lambda u: F.size(F.filter(u["edges"], along)) + F.size(F.filter(u["edges"], up))
    held = F.filter(units, lambda u: ((flips(u) + u["inside"].cast("int")) % 2 == 1) | F.exists(u["edges"], on))
    ashore = F.exists(units, lambda u: F.exists(u["edges"], lambda e: e["coast"] & on(e)))
    return F.when(~ashore, F.array_min(F.transform(held, lambda u: u["unit_id"])))


def levels(cover: DataFrame) -> list[int]:
    """The levels that have leaves: a few numbers."""
    return sorted(r["level"] for r in cover.where("kind <> 'cut'").select("level").distinct().collect())


def with_unit(points: DataFrame, cover: DataFrame, x: str = "longitude", y: str = "latitude", out: str = "unit_id", at: list[int] | None = None) -> DataFrame:
    """``points`` with the smallest id of the units that hold them, or null.

    Leaves are disjoint, so of one join for each level one finds something at most.
    """
    rows, held = points, F.lit(None)
    found = []
    for level in levels(cover) if at is None else at:
        width = size(level)
        own = cover.where((F.col("level") == level) & (F.col("kind") != "cut")).select(F.col("cx").alias("__cx"), F.col("cy").alias("__cy"), F.col("units").alias(f"__units{level}"))
        rows = rows.withColumns({"__cx": F.floor(F.col(x) / width).cast("int"), "__cy": F.floor(F.col(y) / width).cast("int")}).join(own, ["__cx", "__cy"], "left")
        middle = [(F.col(c) + 0.5) * F.lit(width) for c in ("__cx", "__cy")]
        rows = rows.withColumn(f"__held{level}", _holding(F.col(f"__units{level}"), F.col(x), F.col(y), *middle)).drop(f"__units{level}", "__cx", "__cy")
        found.append(F.col(f"__held{level}"))
    held = F.coalesce(*found) if found else held.cast("int")
    return rows.withColumn(out, held).select(*[c for c in points.columns if c != out], out)


# Stretches of tracks.


def parts(segs: DataFrame, step_km: float, planar: bool) -> DataFrame:
    """``segs`` with n, the number of equal parts of at most a step, and what positions follow from."""
    span = F.pmod(F.col("b_longitude") - F.col("a_longitude") + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)
    if planar:
        rows = segs.withColumn("km", haversine_km(F.col("a_longitude"), F.col("a_latitude"), F.col("b_longitude"), F.col("b_latitude"))).withColumn("az", F.lit(None).cast("double"))
    else:
        rows = with_geodesic(segs, "km", "a_longitude", "a_latitude", "b_longitude", "b_latitude", azimuth="az")
    rows = rows.withColumn("n", F.greatest(F.lit(1), F.ceil(F.col("km") / step_km)).cast("int")).withColumn("span", span)
    return rows.select("storm_id", "seg", "n", "km", "span", "az", "a_longitude", "a_latitude", "b_longitude", "b_latitude")


def positions(rows: DataFrame, planar: bool, **where: str) -> DataFrame:
    """``rows`` with the position of each sample: ``j="lon,lat"`` puts that of column j in lon and lat."""
    for j, outs in where.items():
        lon, lat = outs.split(",")
        f = F.col(j) / F.col("n")
        if planar:
            wrapped = domain.wrapped_longitude(F.col("a_longitude") + F.col("span") * f)
            rows = rows.withColumns({lon: wrapped, lat: F.col("a_latitude") + (F.col("b_latitude") - F.col("a_latitude")) * f})
            continue
        rows = with_destination(rows.withColumn("__part", F.col("km") * f), lon, lat, "a_longitude", "a_latitude", "az", "__part").drop("__part")
        pick = lambda c, to: F.when(F.col(j) == 0, F.col(f"a_{c}")).when(F.col(j) == F.col("n"), F.col(f"b_{c}")).otherwise(F.col(to))
        rows = rows.withColumns({lon: pick("longitude", lon), lat: pick("latitude", lat)})
    return rows


def _met_cells(rows: DataFrame, level: int, planar: bool) -> DataFrame:
    """``rows`` (j, upto and their positions) with each cell of a level that their samples can lie in."""
    width, around = size(level), int(360 / size(level))
    turn = F.pmod(F.col("lon2") - F.col("lon1") + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)
    # A geodesic leaves the box of its ends by less than this, in km: twice its sagitta over a parallel.
    lat = F.radians(F.greatest(F.abs("lat1"), F.abs("lat2")))
    far = F.lit(0.0) if planar else F.pow(F.col("km") * (F.col("upto") - F.col("j")) / F.col("n"), F.lit(2.0)) / (4 * 6371.0) * (1 + F.tan(F.least(lat, F.lit(1.5)))) + 0.01
    up = far / 110.0 + 1e-9
    aside = up / F.greatest(F.cos(lat), F.lit(0.02))
    low, high = F.least(F.col("lon1"), F.col("lon1") + turn) - aside, F.greatest(F.col("lon1"), F.col("lon1") + turn) + aside
    cx = F.explode(F.sequence(F.floor(low / width).cast("int"), F.floor(high / width).cast("int")))
    cy = F.explode(F.sequence(F.floor((F.least("lat1", "lat2") - up) / width).cast("int"), F.floor((F.greatest("lat1", "lat2") + up) / width).cast("int")))
    rows = rows.withColumn("cx", cx).withColumn("cx", (F.pmod(F.col("cx") + around // 2, F.lit(around)) - around // 2).cast("int"))
    return rows.withColumn("cy", cy)


def _classed(rows: DataFrame, cover: DataFrame, level: int, planar: bool) -> DataFrame:
    """``rows`` with ``mixed`` (they meet a boundary cell) and ``over`` (the unit that they lie in wholly)."""
    cells = _met_cells(positions(rows, planar, j="lon1,lat1", upto="lon2,lat2"), level, planar).select("storm_id", "seg", "j", "cx", "cy")
    border = cover.where((F.col("level") == level) & (F.col("kind") != "land")).select("cx", "cy", F.lit(True).alias("mixed"))
    land = [cover.where((F.col("level") == l) & (F.col("kind") == "land")).select(F.col("cx").alias(f"x{l}"), F.col("cy").alias(f"y{l}"), F.col("units")[0]["unit_id"].alias(f"u{l}")) for l in range(level + 1)]
    for l, leaf in enumerate(land):
        shift = lambda c, l=l: F.floor(F.col(c) / 2 ** (level - l)).cast("int")
        cells = cells.withColumns({f"x{l}": shift("cx"), f"y{l}": shift("cy")}).join(leaf, [f"x{l}", f"y{l}"], "left").drop(f"x{l}", f"y{l}")
    cells = cells.join(border, ["cx", "cy"], "left")
    over = F.coalesce(*[F.col(f"u{l}") for l in range(level + 1)])
    judged = cells.groupBy("storm_id", "seg", "j").agg(F.coalesce(F.max("mixed"), F.lit(False)).alias("mixed"), F.min(over).alias("over"))
    return rows.join(judged, ["storm_id", "seg", "j"])


def stretches(rows: DataFrame, cover: DataFrame, planar: bool) -> DataFrame:
    """Stretches of samples j to upto of each segment (of :func:`parts`), in units or over
    the sea as a whole: ``over`` is the unit or null."""
    keep = ["storm_id", "seg", "n", "km", "span", "az", "a_longitude", "a_latitude", "b_longitude", "b_latitude", "j", "upto"]
    rows, done = rows.withColumns({"j": F.lit(0), "upto": F.col("n")}).select(*keep), []
    for count, level in STRETCHES:
        first = F.explode(F.sequence(F.col("j"), F.col("upto"), F.lit(count)))
        rows = rows.withColumn("first", first).withColumns({"upto": F.least(F.col("first") + count - 1, F.col("upto")), "j": F.col("first")}).select(*keep)
        rows = settle(_classed(rows, cover, level, planar), f"stretches-{count}")
        done.append(rows.where("not mixed").select(*keep, "over"))
        rows = rows.where("mixed").select(*keep)
    samples = rows.withColumn("j", F.explode(F.sequence("j", "upto"))).withColumn("upto", F.col("j"))
    samples = with_unit(positions(samples, planar, j="lon,lat"), cover, "lon", "lat", "over")
    return functools.reduce(DataFrame.unionByName, [*done, samples.select(*keep, "over")])


def near_land(segs: DataFrame, cover: DataFrame) -> DataFrame:
    """Segments whose box meets a cell of the first level with land, or one beside it."""
    cells = cover.where("level = 0").select(F.explode(F.array(*[F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])).alias("c")).select("c.cx", "c.cy")
    around = int(360 / WIDTH)
    cells = cells.withColumn("cx", (F.pmod(F.col("cx") + around // 2, F.lit(around)) - around // 2).cast("int")).distinct()
    turn = F.pmod(F.col("b_longitude") - F.col("a_longitude") + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)
    cell = lambda c: F.floor(c / WIDTH).cast("int")
    low, high = F.least(F.col("a_longitude"), F.col("a_longitude") + turn), F.greatest(F.col("a_longitude"), F.col("a_longitude") + turn)
    # A geodesic rises over its ends' parallels, by less than a degree for each ten of its length.
    more = F.abs(turn) / 10
    met = segs.select("storm_id", "seg", F.explode(F.sequence(cell(low), cell(high))).alias("cx"), (F.least("a_latitude", "b_latitude") - more).alias("ya"), (F.greatest("a_latitude", "b_latitude") + more).alias("yb"))
    met = met.withColumn("cy", F.explode(F.sequence(cell(F.col("ya")), cell(F.col("yb")))))
    met = met.withColumn("cx", (F.pmod(F.col("cx") + around // 2, F.lit(around)) - around // 2).cast("int"))
    hits = met.join(cells, ["cx", "cy"], "left_semi").select("storm_id", "seg").distinct()
    return segs.join(hits, ["storm_id", "seg"], "left_semi")


def counts(cover: DataFrame) -> DataFrame:
    """level, kind, cells and edges: the size of a cover."""
    edges = F.coalesce(F.sum(F.aggregate("units", F.lit(0), lambda n, u: n + F.size(u["edges"]))), F.lit(0))
    return cover.groupBy("level", "kind").agg(F.count("*").alias("cells"), edges.cast("long").alias("edges"))
