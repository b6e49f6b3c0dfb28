"""Later passes over open rows, and their command line."""

import json

from pyspark.sql import functions as F

from refloom import tools
from refloom.plans import follow_up as U
from refloom.plans import review_queue as Q
from refloom.sources import files

ANSWERS = "doi_key string, source string, resolved boolean, doi string, title string, authors array<string>, type string, error string"
SEARCHES = "query_key string, source string, rank int, doi string, title string, authors array<string>"


def answers(spark, *rows):
    return spark.createDataFrame([(d.lower(), "doi.org", True, d, t, p, k, None) for d, t, p, k in rows], ANSWERS)


def test_round2(spark):
    rows = spark.createDataFrame([
        ("v", "x.pdf", "10.1049/ic_2010_0012", "Unreadable", [], "a study of grid faults in wind power farms at sea"),
        ("q", "clean_3_growth_of_thin_oxide_films.pdf", "", "Abstract", ["Ana Li"], ""),
        ("n", "y.pdf", "", None, None, None),
    ], "path string, filename string, doi string, title string, authors array<string>, text string")
    known = answers(spark, ("10.1049/cp:2010_0012", "Grid faults in wind power farms", ["B C"], "article"))
    found = spark.createDataFrame([("growth of thin oxide films", "openalex_title_search", 0, "10.1000/near", "Growth of thin oxide films", ["Ana Li"]),
        ("growth of thin oxide films", "other", 0, "10.1000/no", "Growth of thin oxide films", ["Ana Li"])],
        SEARCHES)
    got = {r["path"]: r for r in U.round2(rows, known, found).collect()}
    assert (got["v"]["final_doi"], got["v"]["source"], got["v"]["reason"], got["v"]["decision"]) == ("10.1049/cp:2010_0012", "prefix_variant", "IET conference publication DOI", "title in text")
    assert got["v"]["tried_dois"] == ["10.1049/ic_2010_0012", "10.1049/ic:2010_0012", "10.1049/cp:2010_0012"]
    assert (got["q"]["final_doi"], got["q"]["source"], got["q"]["by_title"], got["q"]["t"]) == ("10.1000/near", "openalex_title_search", "growth of thin oxide films", 1.0)
    assert not got["n"]["accepted"] and got["n"]["checked"] == 0


PAGE = "Operando imaging of sodium plating in solid electrolytes\nAlice Smith, Bob Chen\nAbstract\ndoi 10.1000/abc.1 and 10.1000/abc.1.s001 text\n"


def test_ocr_rows(spark):
    rows = spark.createDataFrame([("a", "30"), ("b", "900"), ("c", "bad")], "path string, hardcase_pdf_text_chars string")
    assert {r["path"] for r in U.ocr_targets(rows).collect()} == {"a", "c"} and U.ocr_targets(rows, every=True).count() == 3
    pages = spark.createDataFrame([("a", PAGE, None), ("b", None, "cannot read")], "path string, read string, error string")
    known = answers(spark, ("10.1000/abc.1", "Operando imaging of sodium plating in solid electrolytes", ["Alice Smith"], ""),
        ("10.1000/abc.1.s001", "Operando imaging of sodium plating in solid electrolytes", ["Alice Smith"], ""))
    got = {r["path"]: r for r in U.ocr(rows, pages, known).collect()}
    assert got["a"]["extracted_authors"] == ["Alice Smith", "Bob Chen"] and got["a"]["checked"] == 1
    assert (got["a"]["doi"], got["a"]["accepted"], got["a"]["decision"]) == ("10.1000/abc.1.s001", False, "supplement or dataset")  # the shorter one is the beginning of the longer
    assert got["b"]["error"] == "cannot read" and got["c"]["error"] == "missing PDF"


def test_layout_rows(spark):
    rows = spark.createDataFrame([("a", "conflict_review", "", ""), ("m", "x", "", ""), ("s", "x", "Seeded growth of thin oxide films", "Ana Li")],
        "path string, final_decision string, title string, authors string")
    assert U.layout_targets(rows, "conflict_review").count() == 1
    texts = spark.createDataFrame([("a", PAGE.replace(".s001", "")), ("m", "no identifier here"), ("s", "page")], "path string, text string")
    known = answers(spark, ("10.1000/abc.1", "Operando imaging of sodium plating in solid electrolytes", ["Alice Smith"], "article"),
        ("10.1000/mod.1", "A model told this long title of work", ["Bo Xu"], "article"))
    found = spark.createDataFrame([("seeded growth of thin oxide films", "datacite_title_search", 0, "10.1000/S1", "Seeded growth of thin oxide films", ["Ana Li"]),
        ("seeded growth of thin oxide films li", "crossref_title_search", 1, "10.1000/s1", "Other", [])],
        SEARCHES)
    got = {r["path"]: r for r in U.layout(rows, texts, known, found).collect()}
    assert (got["a"]["final_doi"], got["a"]["decision"], got["a"]["source"]) == ("10.1000/abc.1", "visible, title near-exact", "markdown_regex")
    assert (got["s"]["final_doi"], got["s"]["decision"], got["s"]["source"], got["s"]["checked"]) == ("10.1000/S1", "search, title near-exact", "llm_datacite_title_search", 1)
    said = json.dumps({"title": "A model told this long title of work", "authors": ["Bo Xu"],
        "doi_candidates": [{"doi": "10.1000/mod.1", "is_main_article": True, "confidence": "high", "evidence": "e"}, {"doi": "10.1000/mod.2", "is_main_article": False}]})
    got = {r["path"]: r for r in U.layout(rows, texts, known, found, spark.createDataFrame([("m", said)], "path string, value string")).collect()}
    assert (got["m"]["final_doi"], got["m"]["source"], got["m"]["decision"], got["m"]["checked"]) == ("10.1000/mod.1", "llm_markdown_doi", "visible, title near-exact", 1)


def test_tool_writes_parts_and_counts(spark, tmp_path):
    folder = tmp_path / "base" / "files" / "d"
    folder.mkdir(parents=True)
    for name in ("a.pdf", "b.pdf"):
        (folder / name).write_bytes(b"%PDF")
    (tmp_path / "in.tsv").write_text('folder\tfilename\ttitle\textra\tfinal_decision\nd\ta.pdf\tx\tkeep "q"\treview\nd\tb.pdf\ty\tk\tno_doi_unresolved\nd\tc.pdf\tz\tk\treview\n')
    answers(spark, ("10.1000/abc.1", "Operando imaging of sodium plating in solid electrolytes", ["Alice Smith"], "")).write.parquet(str(tmp_path / "auth"))

    class Reader:
        def read(self, content, name):
            if name != "a.pdf":
                raise ValueError("cannot")
            return "Operando imaging of sodium plating in solid electrolytes\nAlice Smith, Bob Chen\nAbstract\ndoi 10.1000/abc.1 text\n"

    out = tmp_path / "out"
    got = tools.run(spark, tools.options(["ocr", str(tmp_path / "in.tsv"), "--output-dir", str(out), "--local-base", str(tmp_path / "base"), "--authority-table", str(tmp_path / "auth")]), Reader())
    assert (got["input_rows"], got["targets"], got["accepted"], got["no_candidate"], got["accepted_by_source"]) == (3, 3, 1, 2, {"ocr_regex": 1})
    assert json.loads((out / "ocr_summary.json").read_text()) == got
    table = files.manifest(spark, str(out / "ocr_accepted.tsv"))
    assert table.columns[0] == "ocr_accept" and [(r["ocr_final_doi"], r["extra"], r["ocr_accept"]) for r in table.collect()] == [("10.1000/abc.1", 'keep "q"', "1")]
    panel = tools.run(spark, tools.options(["panel", str(out / "ocr_resolution.tsv"), "--output-dir", str(tmp_path / "panel"), "--ocr-results", str(out / "ocr_resolution.tsv")]))
    assert panel["by_action"] == {"candidate-visible-review": 1, "vision-ocr-needed": 2} and "<article" in (tmp_path / "panel" / "index.html").read_text()
    assert files.manifest(spark, str(tmp_path / "panel" / "review_queue.tsv")).columns == Q.QUEUE
    assert files.manifest(spark, str(tmp_path / "panel" / "review_decisions_template.tsv")).columns == Q.TEMPLATE


def test_links(spark):
    df = spark.createDataFrame([("A b", "10.1/x y"), ("", "")], "t string, d string")
    got = [[tuple(x) for x in r[0]] for r in df.select(Q.search_links(F.col("t"), F.col("d"))).collect()]
    assert got[0][0] == ("Google Scholar", "https://scholar.google.com/scholar?q=A%20b") and got[0][3][0] == "DOI" and got[1] == []
