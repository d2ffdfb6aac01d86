from galetrack.sources import hurricane_list

# Invented rows, in the list's format.
PAGE = """<html><style>td { x }</style><table>
<tr><td>1961</td><td>Sep</td><td>TX, 2; I-LA, 1</td><td>2</td><td>968</td><td>90</td><td>Quill</td></tr>
<tr><td>1962</td><td>None</td></tr>
<tr><td>1963</td><td>Aug</td><td>* NC, 1</td><td>1</td><td>985</td><td>70</td><td>Umber</td></tr>
<tr><td>1964</td><td>Oct</td><td># TX, 1</td><td>1</td><td>980</td><td>65</td><td>Vesper</td></tr>
<tr><td>1870</td><td>Jul</td><td>FL, 1; GA, TS</td><td>1</td><td>----</td><td>75</td><td>-----</td></tr>
<tr><td>1965</td><td>Oct</td><td>nowhere at all</td></tr>
</table>Notes: 1999 TX, 1</html>"""


def test_list(spark):
    rows = hurricane_list.parse(spark.createDataFrame([("p", PAGE)], "path string, content string"))
    got = {r["year"]: r for r in rows.collect()}
    assert sorted(got) == [1870, 1961, 1962, 1963, 1964, 1965]
    first = got[1961]
    assert (first["kind"], first["month"], first["coastal"], first["inland"], first["category"], first["pressure_mb"], first["wind_kt"], first["name"]) == ("landfall", "Sep", ["TX"], ["LA"], "2", 968, 90, "Quill")
    assert got[1962]["kind"] == "none" and got[1965]["kind"] == "unparsed"
    assert got[1963]["missed"] and not got[1963]["in_mexico"] and got[1964]["in_mexico"]
    old = got[1870]
    assert old["name"] is None and old["pressure_mb"] is None and old["coastal"] == ["FL", "GA"] and old["category"] == "TS"
    assert {r["year"] for r in hurricane_list.landfalls(rows).collect()} == {1870, 1961}
    rate = hurricane_list.parse_rate(rows).first()
    assert (rate["parsed"], rate["unparsed"], rate["rate"]) == (4, 1, 0.8)
    assert hurricane_list.parse_rate(rows.where("false")).first()["rate"] == 0.0


def test_report(spark):
    from galetrack.plans import external, planar, planar_queries, registry

    db = registry.database(spark, "/root/testdata/sf0.001", flat=True)
    text = external.report(db, planar_queries.listed(db), planar.CONUS)
    assert text.startswith("# Comparison") and "| 1991-present | yes |" in text and "## Only listed" in text
