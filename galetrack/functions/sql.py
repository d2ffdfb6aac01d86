"""SQL functions for users of the tables, and a table function for positions along a line.

They are written in SQL, so Catalyst inlines and optimises them like any expression.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from galetrack.functions import domain
from galetrack.functions.geodesy import MEAN_RADIUS_KM

#: name: (parameters, what it returns, its body).
FUNCTIONS = {
    "gale_category": (
        "wind int", "string",
        "case when wind is null or wind < 0 then 'UNK' "
        + " ".join(f"when wind >= {floor} then '{label}'" for floor, label in domain.CATEGORY_FLOORS) + " else 'TD' end",
    ),
    "gale_class": (
        "status string, wind int", "string",
        f"case when status is null or status not in ({', '.join(repr(s) for s in domain.TROPICAL_STATUSES)}) then '{domain.CLASSES[3]}' when wind is null then '{domain.CLASSES[4]}'"
        f" when wind >= 64 then '{domain.CLASSES[0]}' when wind >= 34 then '{domain.CLASSES[1]}' else '{domain.CLASSES[2]}' end",
    ),
    "gale_arc_km": (
        "lon1 double, lat1 double, lon2 double, lat2 double", "double",
        f"2 * {MEAN_RADIUS_KM} * asin(sqrt(least(1.0D, power(sin(radians(lat2 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) * power(sin(radians(lon2 - lon1) / 2), 2))))",
    ),
    "gale_decade": ("season int", "int", "cast(floor(season / 10) * 10 as int)"),
}
#: The same for functions that return tables.
TABLE_FUNCTIONS = {
    "gale_along": (
        "lon1 double, lat1 double, lon2 double, lat2 double, step_km double", "j int, lon double, lat double",
        "select j, if(x > 180, x - 360, if(x < -180, x + 360, x)) as lon, y as lat from (select j, lon1 + (pmod(lon2 - lon1 + 180.0D, 360.0D) - 180.0D) * (j / n) as x, lat1 + (lat2 - lat1) * (j / n) as y"
        " from (select n, explode(sequence(0, n)) as j from (select greatest(1, cast(ceil(gale_arc_km(lon1, lat1, lon2, lat2) / step_km) as int)) as n)))",
    ),
}


def register(spark: SparkSession) -> list[str]:
    """Makes the functions known to a session; their names."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"create or replace temporary function {name}({parameters}) returns {result} return {body}")
    for name, (parameters, result, body) in TABLE_FUNCTIONS.items():
        spark.sql(f"create or replace temporary function {name}({parameters}) returns table({result}) return {body}")
    return [*FUNCTIONS, *TABLE_FUNCTIONS]
