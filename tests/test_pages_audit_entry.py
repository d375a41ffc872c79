"""Page extraction fixtures, audits, file sources and the driver contract."""

import pytest
from pyspark.sql import functions as F

from panelwright.operators.audit import TableRule, audit_table, duplicate_row_count, empty_row_count
from panelwright.sources.files import latest_file, range_from_name, read_csv_text, read_optional, write_table
from panelwright.sources.pages import page_status, page_tables, parse_tables

VISIBLE = """<html><body><table id="totals_stats"><thead><tr><th>Rk</th><th>Season</th><th>FG%</th></tr></thead>
<tbody><tr><td>1</td><td>2011-12</td><td>.5</td></tr>
<tr class="thead"><td>Rk</td><td>Season</td><td>FG%</td></tr>
<tr><td>Rk</td><td>Season</td><td>FG%</td></tr>
<tr><td>2</td><td>2012-13</td><td>.4</td></tr></tbody></table></body></html>"""

COMMENTED = """<html><body><div><!-- <table id="advanced"><thead>
<tr><th colspan="2">Shooting</th><th></th></tr><tr><th>FG</th><th>3P</th><th>Season</th></tr></thead>
<tbody><tr><td>3</td><td>1</td><td>2011-12</td></tr></tbody></table> --></div>
<table id="totals"><tbody></tbody></table><table id="totals_stats"><tbody></tbody></table></body></html>"""


def test_parse_visible_table_skips_repeated_headers():
    found = parse_tables(VISIBLE, {"totals": ["totals_stats", "totals"]})
    assert found["totals"] == [{"Rk": "1", "Season": "2011-12", "FGpct": ".5"},
                               {"Rk": "2", "Season": "2012-13", "FGpct": ".4"}]


def test_parse_commented_table_with_multilevel_header_and_fallback_ids():
    found = parse_tables(COMMENTED, {"advanced": ["adv_missing", "advanced"], "totals": ["totals_stats", "totals"]})
    assert found["advanced"] == [{"Shooting_FG": "3", "Shooting_3P": "1"}]  # blank top header: the column goes
    assert "totals" not in found  # both candidates are empty


@pytest.mark.parametrize(("html", "rows"), [
    ("<table id=t><tr><th>A<th>A<tr><td>1<td>2<tr><td>3<td>4", [{"A": "1", "A.1": "2"}, {"A": "3", "A.1": "4"}]),
    ("<table id=t><thead><tr><th>S<th>X<th>Y</thead><tr><td rowspan=2>a<td>1<td>2<tr><td>3<td>4<tr><td>b<td colspan=2>9</table>",
     [{"S": "a", "X": "1", "Y": "2"}, {"S": "a", "X": "3", "Y": "4"}, {"S": "b", "X": "9", "Y": "9"}]),
    ("<table id=t><tr><th>A<th>B<tr><td>1<td rowspan=0>x<tr><td>2<tr></table>", [{"A": "1", "B": "x"}, {"A": "2", "B": "x"}]),
    ("<table id=t><tr><th>A<th>B<tr><td>1<td><table id=n><tr><td>z</table>!<tr><td>2<td>3</table>", [{"A": "1", "B": "z!"}, {"A": "2", "B": "3"}]),
    ("<table id=t><tr><td>1<td>2<tr><td>3</table>", [{"0": "1", "1": "2"}, {"0": "3", "1": None}]),
])
def test_table_layouts(html, rows):
    assert parse_tables(html, {"x": ["t"]}) == {"x": rows}


def test_failed_page_is_one_error_row_with_text_ids(spark):
    from panelwright.sources.pages import page_bios, page_rows

    broken = "<p>Recruiting Rank: 2017 (3)</p><![broken" + "x" * 900 + " ]]>"
    pages = spark.createDataFrame([("a", broken), ("b", "<p>Recruiting Rank: 2017 (3) 6-4 200lb</p>"), ("c", None)], "page_id string, html string")
    got = {r["page_id"]: r for r in page_bios(page_rows(pages)).collect()}
    assert got["a"]["status"] == "error" and len(got["a"]["error"]) > 900 and got["a"]["recruiting_year"] is None
    assert (got["b"]["recruiting_year"], got["b"]["recruiting_rank"], got["b"]["height_inches"]) == (2017, 3, None)
    assert got["c"]["error"] == "empty page"


def test_page_tables_and_status(spark):
    pages = spark.createDataFrame([(1, VISIBLE), (2, COMMENTED), (3, None), (4, "<html>no tables</html>")],
                                  "page_id long, html string")
    long = page_tables(pages, {"totals": ["totals_stats"], "advanced": ["advanced"]})
    got = sorted((r["page_id"], r["table_id"], r["row_no"]) for r in long.collect())
    assert got == [(1, "totals", 0), (1, "totals", 1), (2, "advanced", 0)]
    status = {r["page_id"]: r["status"] for r in page_status(pages).collect()}
    assert status == {1: "ok", 2: "ok", 3: "error", 4: "ok"}


def test_audit_counts(spark):
    df = spark.createDataFrame([
        (None, " ", None), ("a", "x", 1.0), ("a", "x", 1.0), (None, None, 2.0), (None, None, 2.0),
    ], "k string, Season string, v double")
    assert df.agg(empty_row_count(df)).first()[0] == 1
    assert duplicate_row_count(df).first()[0] == 4
    assert duplicate_row_count(df, ["k"]).first()[0] == 5  # null keys group together
    findings = {r["check"]: r for r in audit_table(df, TableRule("t", ["k"])).collect()}
    assert findings["key_duplicates"]["severity"] == "issue" and findings["empty_rows"]["n_rows"] == 1
    missing = {r["check"]: r for r in audit_table(df, TableRule("t", ["nope"])).collect()}
    assert "missing columns" in missing["key_duplicates"]["detail"]


def test_file_sources_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("2011-12", "1", "NA"), ("2012-13", "n/a", "x")], "Season string, G string, t string")
    out = str(tmp_path / "ids_2011_2025.csv")
    assert write_table(df.coalesce(1), out, fmt="csv") == 2
    back = read_csv_text(spark, out)
    assert dict(back.dtypes)["Season"] == "string"
    vals = sorted((r["Season"], r["G"], r["t"]) for r in back.collect())
    assert vals == [("2011-12", "1", None), ("2012-13", None, "x")]
    assert latest_file(spark, str(tmp_path), "ids_*.csv").endswith("ids_2011_2025.csv")
    assert latest_file(spark, str(tmp_path), "none_*.csv") is None
    with pytest.raises(FileNotFoundError):
        latest_file(spark, str(tmp_path), "none_*.csv", required=True)
    assert range_from_name(out) == 15
    empty = read_optional(spark, str(tmp_path / "missing"), "a string")
    assert empty.count() == 0 and empty.columns == ["a"]


def test_entry_contract(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert "composite" in df.columns and "tier" in df.columns
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert F is not None


def test_pages_to_long_and_rebuild(spark, tmp_path):
    from panelwright.plans.panel import PanelSpec, pages_to_long, rebuild_panel

    pages = spark.createDataFrame([(1, "p1", VISIBLE), (2, "p2", COMMENTED)], "page_id long, entity string, html string")
    long = pages_to_long(pages, {"totals": ["totals_stats"], "advanced": ["advanced"]}, "entity", "entity_id",
                         ["Season", "FGpct", "Shooting_FG"])
    types = dict(long.dtypes)
    assert types["FGpct"] == "double" and types["Season"] == "string"
    got = sorted(((r["entity_id"], r["table_id"], r["Season"], r["FGpct"], r["Shooting_FG"]) for r in long.collect()), key=repr)
    assert got == [("p1", "totals", "2011-12", 0.5, None), ("p1", "totals", "2012-13", 0.4, None),
                   ("p2", "advanced", None, None, 3.0)]
    with pytest.raises(FileNotFoundError):
        rebuild_panel(spark, str(tmp_path / "nope"), str(tmp_path / "nope2"), None, PanelSpec())
    lt = spark.createDataFrame([("e1", "totals", "2011-12", "A", 10.0, 100.0)],
                               "entity_id string, table_id string, Season string, Team string, G double, MP double")
    cw = spark.createDataFrame([("e1", "L1")], "entity_id string, link_id string")
    lt.write.parquet(str(tmp_path / "long")); cw.write.parquet(str(tmp_path / "cw"))
    panel = rebuild_panel(spark, str(tmp_path / "long"), str(tmp_path / "cw"), None, PanelSpec(),
                          out_path=str(tmp_path / "panel"))
    assert [(r["entity_id"], r["link_id"]) for r in panel.collect()] == [("e1", "L1")]


@pytest.mark.parametrize("missing", ["xxhash", "corpus_pipeline", "panelwright.llm", "public_tokenizers"])
def test_entry_without_what_the_training_data_operators_need(monkeypatch, missing):
    import sys

    import __spark_entry__ as entry
    from panelwright.plans.catalogue import QUERIES

    for name in list(sys.modules):
        if name.split(".")[0] == "corpus_pipeline" or name.startswith("panelwright.llm"):
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, missing, None)  # importing it fails
    assert entry.queries() == QUERIES and set(entry.oracle_sql()) <= set(QUERIES)


MARKUP = ["<p>", "</p>", "<td>", "<td rowspan=2>", "<tr class='a b'>", '<table id="t">', "</table>", "<tbody>", "<a href='x&amp;y'>", "<a href=foo/>", "</a>", "<br/>", "<script>var a='</p>';</script>",
          "<script>", "</script>", "<STYLE>a</STYLE>", "<title>", "</title>", "<textarea>", "<!-- c -->", "<!---->", "<!-->", "<!-- a--b -->", "<!--x--->", "<!DOCTYPE html>", "<div id=info>", "</div>",
          '<span id="necro-birth">', "</span>", "text", "a &lt; b", "&amp", " \n", "<", "<?pi?>", "</p x>", "<p a=b c='d' A=e>", "<p a = b>", "<template>", "</template>", '<x y="a>b">', "<script/>", "<p\xa0a=b>", "</"]


def test_quick_reading_is_the_standard_parsers():
    import random

    from panelwright.sources.pages import PageReader

    class Standard(PageReader):
        def _read_plain(self, html):
            return False

    def state(reader, html):
        d = reader().read(html)
        return [(t.id, t.rows) for t in d.tables], d.comments, d.links, d.page_text, d.info_text, d.births

    rng = random.Random(1)
    for _ in range(4000):
        html = "".join(rng.choices(MARKUP, k=rng.randint(0, 9)))
        assert state(PageReader, html) == state(Standard, html), html


def test_rendered_pages_need_no_standard_parser(spark, monkeypatch):
    """the standard parser took most of the time of every page query."""
    from panelwright.plans import rendered
    from panelwright.sources.pages import PageReader

    orders = spark.range(1, 9).select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
                                      F.lit("1996-01-02").cast("date").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"))
    monkeypatch.setattr(rendered, "read", lambda *_: orders)
    pages = [r["html"] for r in rendered.rendered_pages(spark, "none").collect()]
    monkeypatch.setattr(PageReader, "feed", lambda *_: pytest.fail("read by the standard parser"))
    for html in pages:
        assert len(PageReader().read(html).tables) >= 3 and len(parse_tables(html, rendered.CANDIDATES)) == 3


def test_plain_paths_are_joined_as_urljoin_does(monkeypatch):
    """Every link of a page went through the whole of urljoin."""
    from urllib.parse import urljoin

    from panelwright.sources import pages

    hrefs = ["/players/c/c12.html", "/a", "/a/b", "/a/../b", "/a/./b", "/./a", "//host/a", "/a//b", "/", "", "a/b.html", "/a/", "/a?x=1", "/a#f", "/a;p", "https://other/x", "/a b", "/..a", "/a..b", "?q", "mailto:x@y", "/é", "/a\n"]
    bases = ["", "https://stats.example.org", "https://stats.example.org/", "https://stats.example.org/x/y.html?q=1#f", "http://h:80/p;v", "//h/p", "a/b", "/a/b", "mailto:x", "file:///a/b", "HTTPS://H/x"]
    for base in bases:
        for href in hrefs:
            assert pages.absolute(base, href) == urljoin(base, href), (base, href)
    pages._origin("https://stats.example.org")
    monkeypatch.setattr(pages, "urljoin", None)
    assert pages.absolute("https://stats.example.org", "/players/c/c12.html") == "https://stats.example.org/players/c/c12.html"
