"""An external list of hurricanes, as a web page of one row a year and storm.

A row is: year, month, the states struck with the category in each (inland ones are
marked ``I-``), the highest category, central pressure, wind, name. ``*`` marks a
centre that missed the country, ``#`` a landfall in Mexico. Numbers that run together
are left out rather than guessed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the list.
STATES = ("AL", "CT", "DE", "FL", "GA", "LA", "MA", "MD", "ME", "MS", "NC", "NH", "NJ", "NY", "PA", "RI", "SC", "TX", "VA", "VT", "WV")
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
NAMED_SINCE, FIRST_YEAR, LAST_YEAR = 1950, 1851, 2100
NOTES = "Notes:"


def plain_text(page: Column) -> Column:
    """Markup removed: rows and line breaks as new lines, other tags as tabs."""
    out = F.regexp_replace(page, r"(?is)<(script|style)\b[^>]*>.*?</\1>", " ")
    out = F.regexp_replace(out, r"(?i)<br\s*/?>|</tr>", "\n")
    out = F.regexp_replace(out, r"<[^>]+>", "\t")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(name), F.lit(char))
    return F.get(F.split(out, NOTES), F.lit(0))


def parse(pages: DataFrame) -> DataFrame:
    """From rows of path and content (text): a row for each line that starts with a year.

    kind is "landfall", "none" (a year without any) or "unparsed".
    """
    lines = pages.select("path", F.posexplode(F.split(plain_text(F.col("content")), "\r?\n")).alias("at", "line"))
    lines = lines.select("path", "at", F.trim(F.regexp_replace("line", r"^\s+|\s+$", "")).alias("line"))
    lines = lines.withColumn("year", F.regexp_extract("line", r"^(\d{4})\b", 1).try_cast("int")).where(F.col("year").between(FIRST_YEAR, LAST_YEAR))
    lines = lines.withColumn("rest", F.substring("line", F.lit(5), F.length("line"))).where(F.trim(F.translate("rest", "\t", " ")) != "")
    month = F.regexp_extract("rest", rf"\b({'|'.join(MONTHS)})", 1)
    tail = F.when(month != "", F.substring("rest", F.instr("rest", month) + 3, F.length("rest"))).otherwise(F.col("rest"))
    rows = lines.withColumns({"month": F.nullif(month, F.lit("")), "tail": tail})
    # A state's code with an optional inland mark; letters before it belong to another word.
    codes = rf"(?<![A-Za-z])(I-?)?({'|'.join(STATES)})(?![a-z])"
    marks, found = F.regexp_extract_all("tail", F.lit(codes), F.lit(1)), F.regexp_extract_all("tail", F.lit(codes), F.lit(2))
    both = F.arrays_zip(marks.alias("mark"), found.alias("code"))
    inland = F.array_distinct(F.transform(F.filter(both, lambda b: b["mark"] != ""), lambda b: b["code"]))
    rows = rows.withColumns({"inland": inland, "coastal": F.array_distinct(F.transform(F.filter(both, lambda b: b["mark"] == ""), lambda b: b["code"]))})
    rows = rows.withColumn("coastal", F.array_except("coastal", "inland"))
    words = F.filter(F.split(F.trim(F.regexp_replace("tail", r"\s+", " ")), " "), lambda w: w != "")
    numbers = F.transform(F.filter(words, lambda w: w.rlike(r"^\d+$")), lambda w: w.try_cast("int"))
    rows = rows.withColumns({"words": words, "numbers": numbers})
    at = F.array_position("numbers", F.try_element_at(F.filter("numbers", lambda v: v.between(850, 1050)), F.lit(-1))).cast("int")
    rows = rows.withColumn("at", F.when((F.size("numbers") >= 3) & (F.size(F.filter("numbers", lambda v: v.between(850, 1050))) > 0), at))
    last = F.try_element_at("words", F.lit(-1))
    name = F.when((F.col("year") >= NAMED_SINCE) & last.rlike(r"^[A-Z][A-Za-z]{2,}$") & ~F.upper(last).isin("NONE", *STATES), last)
    category = F.when(F.array_contains("words", "TS"), "TS").otherwise(F.try_element_at(F.filter(F.slice("numbers", F.lit(1), F.col("at") - 1), lambda v: v.between(1, 5)), F.lit(-1)).cast("string"))
    kind = F.when(F.col("rest").rlike(r"(?i)^\s*none\b"), "none").when((F.size("coastal") > 0) | (F.size("inland") > 0), "landfall").otherwise("unparsed")
    return rows.select(
        "path", "year", "month", name.alias("name"), "coastal", "inland", category.alias("category"), F.get("numbers", F.col("at") - 1).alias("pressure_mb"),
        F.get(F.filter(F.slice("numbers", F.col("at") + 1, 100), lambda v: v.between(30, 200)), F.lit(0)).alias("wind_kt"),
        F.contains("tail", F.lit("*")).alias("missed"), F.contains("tail", F.lit("#")).alias("in_mexico"), kind.alias("kind"), "line",
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(path).select("path", F.decode("content", "UTF-8").alias("content"))
    return parse(files)


def landfalls(rows: DataFrame) -> DataFrame:
    """Rows that are landfalls of the centre in the country."""
    return rows.where("kind = 'landfall' and not missed and not in_mexico")


def parse_rate(rows: DataFrame) -> DataFrame:
    """One row: landfalls, unparsed lines, and the share parsed (0 without any)."""
    out = rows.agg(F.count_if(F.col("kind") == "landfall").alias("parsed"), F.count_if(F.col("kind") == "unparsed").alias("unparsed"))
    whole = F.col("parsed") + F.col("unparsed")
    return out.withColumn("rate", F.when(whole > 0, F.col("parsed") / whole).otherwise(0.0))
