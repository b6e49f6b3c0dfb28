"""The command line on small files, the review queue, and candidates from generated text."""

import json

from pyspark.sql import functions as F

from refloom import cli
from refloom.operators import authority as A
from refloom.operators import generated as G
from refloom.plans import hard_cases as H
from refloom.plans import review as R
from refloom.plans import review_queue as Q
from refloom.sources import connectors, files
from refloom.sources.sinks import SUMMARY_FIELDS


SCHEMA = "doi_key string, source string, resolved boolean, doi string, title string, authors array<string>, error string"


def run(spark, tmp_path, *flags, sources=None):
    out = tmp_path / "out"
    got = cli.run(spark, cli.options([str(tmp_path / "in"), "--output-dir", str(out), *flags]), sources=sources or {})
    rows = {r["filename"]: r for r in spark.read.json(str(out / "metadata.jsonl")).collect()}
    return got, rows


def pdf(tmp_path, name, content=b"%PDF"):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / name).write_bytes(content)


def test_command_line(spark, tmp_path):
    pdf(tmp_path, "10.1002_adma.202403521.pdf")
    pdf(tmp_path, "b.pdf", b"doi: 10.1000/abc1")
    (tmp_path / "in" / "b.md").write_text("see doi 10.1000/abc1\n")
    (tmp_path / "side.tsv").write_text("filename\ttitle\tauthors\nb.pdf\tA fine title\tX Y; Z W\n")
    spark.createDataFrame([("10.1002/adma.202403521", "crossref", True, "10.1002/adma.202403521", "A title of some length here", ["A B"], None)], SCHEMA).write.parquet(str(tmp_path / "auth"))
    got, rows = run(spark, tmp_path, "--markdown-dir", str(tmp_path / "in"), "--side-table", str(tmp_path / "side.tsv"), "--authority-table", str(tmp_path / "auth"))
    assert got["rows"] == 2 and got["status"] == {"ok": 2}
    assert rows["b.pdf"]["title"] == "A fine title" and rows["b.pdf"]["confidence"] == "high" and rows["b.pdf"]["metadata_source"] == "pdf+grobid"
    one = rows["10.1002_adma.202403521.pdf"]
    assert one["original_status"] == "review" and one["review_stage"] == "stage3" and one["method"] == "postprocess_stage3_accept_probable"
    assert one["doi_validation_source"] == "doi_authority" and json.loads(one["doi_validation_score"])["postprocess_decision"] == "stage3_accept_probable"
    table = files.manifest(spark, str(tmp_path / "out" / "metadata.tsv"))
    assert table.columns == SUMMARY_FIELDS and len(SUMMARY_FIELDS) == 71 and table.count() == 2
    kept = json.loads((tmp_path / "out" / "review_postprocess_summary.json").read_text())
    assert kept["accepted_rows"] == kept["target_rows"] == 1 and kept["stage"] == {"stage3": 1}


def Fake(answers):
    """A source that knows some answers. A class of its own each time: workers get it by value."""

    class Known:
        source = "fake"

        def fetch(self, key):
            if key not in answers:
                raise ValueError("429 too many requests")
            return answers[key]

        def read(self, content, name):
            if name not in answers:
                raise ValueError("cannot read")
            return answers[name]

    return Known()


def work(doi, title, *people):
    return json.dumps({"status": "ok", "message": {"DOI": doi, "title": [title], "author": [{"given": p.split()[0], "family": p.split()[1]} for p in people]}})


def test_look_ups_make_rows_sure_and_are_kept(spark, tmp_path):
    pdf(tmp_path, "a.pdf", b"see 10.1000/abc.17 there")
    pdf(tmp_path, "n.pdf")
    (tmp_path / "side.tsv").write_text("filename\ttitle\tauthors\na.pdf\tGrowth of thin oxide films on glass\tAna Li\nn.pdf\tAnother title that is long enough\tBo Xu\n")
    found = json.dumps({"message": {"items": [{"DOI": "10.1000/new.1"}]}})
    sources = {"crossref": Fake(answers={"10.1000/abc.17": work("10.1000/abc.17", "Growth of thin oxide films on glass", "Ana Li"),
        "10.1000/new.1": work("10.1000/new.1", "Another title that is long enough", "Bo Xu")}),
        "crossref_title": Fake(answers={"Another title that is long enough": found})}
    flags = ("--validate", "--side-table", str(tmp_path / "side.tsv"), "--no-review", "--no-hard-cases")
    got, rows = run(spark, tmp_path, *flags, sources=sources)
    assert got["status"] == {"ok": 2}
    assert (rows["a.pdf"]["doi_decision"], rows["a.pdf"]["confidence"], rows["a.pdf"]["doi_validation_source"]) == ("title_author_verified", "high", "crossref")
    assert json.loads(rows["a.pdf"]["doi_validation_score"]) == {"title_score": 1.0, "author_score": 1.0}
    assert rows["n.pdf"]["doi"] == "10.1000/new.1" and rows["n.pdf"]["doi_source"] == "crossref_title_search"
    got, rows = run(spark, tmp_path, *flags, sources={})  # from the caches alone
    assert got["status"] == {"ok": 2}


def test_header_service_ocr_and_model_add_candidates(spark, tmp_path):
    pdf(tmp_path, "h.pdf")
    pdf(tmp_path, "o.pdf")
    pdf(tmp_path, "m.pdf")
    tei = '<TEI xmlns="http://x"><titleStmt><title>A header title of some length</title></titleStmt><idno type="DOI">10.1000/head.1</idno></TEI>'
    page = "Operando imaging of sodium plating in solid electrolytes\nAlice Smith, Bob Chen\ndoi: 10.1000/ocr.1\nAbstract\n"
    options = cli.options([str(tmp_path / "in"), "--output-dir", "x"])
    assert options.ocr_pages == 3 and not options.llm

    class Model:
        source = "llm"

        def fetch(self, key):
            return '{"candidates": ["10.1000/model.1"]}' if '"title":' not in key else "{}"

    sources = {"header": Fake(answers={"h.pdf": tei}), "ocr": Fake(answers={"o.pdf": page}), "llm": Model()}
    flags = ("--grobid-on-missing", "--fallback-allow-ocr", "--ocr-metadata-on-missing", "--llm", "--no-review", "--no-hard-cases")
    _, rows = run(spark, tmp_path, *flags, sources=sources)
    assert (rows["h.pdf"]["doi"], rows["h.pdf"]["title"], rows["h.pdf"]["doi_source"]) == ("10.1000/head.1", "A header title of some length", "grobid_doi")
    assert (rows["o.pdf"]["doi"], rows["o.pdf"]["authors"], rows["o.pdf"]["authors_source"]) == ("10.1000/ocr.1", ["Alice Smith", "Bob Chen"], "ocr")
    assert (rows["m.pdf"]["doi"], rows["m.pdf"]["status"], rows["m.pdf"]["doi_source"]) == ("10.1000/model.1", "review", "llm_candidate")
    assert rows["m.pdf"]["error"] == "grobid unavailable: cannot read | cannot read"


def test_hard_cases_by_text_and_by_title_search(spark, tmp_path):
    title = "Bipolar Membranes with an Electrospun 3D Junction"
    records = [
        ("a", "a.pdf", "review", "10.2172/2516710", "This report was prepared as an account of work", [], f"intro {title.lower()} in detail"),
        ("b", "nothing.pdf", "no_doi", None, "Growth of thin oxide films on glass", ["Ana Li"], ""),
        ("c", "10.1149_1945-7111_ac6aea.pdf", "review", "10.1149/1945-7111_ac6aea", "Accepted Manuscript", [], None),
        ("d", "none.pdf", "no_doi", None, None, None, None),
        ("e", "ok.pdf", "ok", "10.1000/ok", "x", [], ""),
    ]
    df = spark.createDataFrame(records, "path string, filename string, status string, doi string, title string, authors array<string>, text string")
    df = df.withColumns({"method": F.lit("m"), "confidence": F.lit("review"), "metadata_source": F.lit("pdf"), "year": F.lit(""), "journal": F.lit("Own")})
    answers = spark.createDataFrame([("10.2172/2516710", "osti", True, "10.2172/2516710", title, ["Peter Pintauro"], None, None),
        ("10.1149/1945-7111/ac6aea", "doi.org", True, "10.1149/1945-7111/ac6aea", "Review - Carbon Cloth as a Versatile Electrode", ["Maria Leon", "Jose Nava"], None, "2022"),
        ("10.1149/1945-7111_ac6aea", "doi.org", False, None, None, None, "404", None)],
        SCHEMA + ", year string").withColumn("container", F.lit("Journal of ES"))
    searches = spark.createDataFrame([("growth of thin oxide films on glass", "crossref_title_search", 0, "10.1000/far", "Something else entirely here", ["Q R"]),
        ("growth of thin oxide films on glass", "datacite_title_search", 0, "10.1000/near", "Growth of thin oxide films on glass", ["Ana Li"])],
        "query_key string, source string, rank int, doi string, title string, authors array<string>")
    result = H.hard_cases(df, answers, searches)
    got = {r["path"]: r for r in result.collect()}
    assert set(got) == set("abcd")
    assert (got["a"]["decision"], got["a"]["confidence"], got["a"]["c"], got["a"]["answer_source"]) == ("title in text", "high", 1.0, "osti")
    assert (got["b"]["final_doi"], got["b"]["source"], got["b"]["decision"]) == ("10.1000/near", "datacite_title_search", "title near-exact")
    assert (got["c"]["final_doi"], got["c"]["decision"], got["c"]["tried_dois"][0]) == ("10.1149/1945-7111/ac6aea", "filename and no usable title", "10.1149/1945-7111_ac6aea")
    assert (got["d"]["decision"], got["d"]["confidence"], got["d"]["answer_error"]) == ("no DOI candidate and no usable title search", "none", "no candidate")
    out = {r["path"]: r for r in H.applied(df, result).collect()}
    c = out["c"]
    assert (c["status"], c["doi"], c["title"], c["authors"], c["year"], c["journal"]) == ("ok", "10.1149/1945-7111/ac6aea",
        "Review - Carbon Cloth as a Versatile Electrode", ["Maria Leon", "Jose Nava"], "2022", "Own")
    assert (c["original_doi"], c["method"], c["metadata_source"], c["hardcase_accept"], c["authority_authors_new"]) == ("10.1149/1945-7111_ac6aea",
        "hardcase_filename_variant", "pdf+authority", "1", "Maria Leon; Jose Nava")
    assert out["d"]["status"] == "no_doi" and out["d"]["hardcase_accept"] == "0" and out["e"]["hardcase_accept"] is None and out["e"]["original_status"] is None


REVIEW = "path string, filename string, doi string, status string, title string, authors array<string>, sources array<string>, old_t double, old_a double"


def test_review_stages(spark):
    """The facts of the review cascade, and a key with several answers."""
    rows = [
        ("two", "x.pdf", "10.1021/acsenergylett.4c01234", "review", "A Practical Battery Paper", ["Ada Lovelace", "Grace Hopper"], ["raw_pdf_bytes"], 0.89, 0.80),
        ("three", "10.1016_j.jpowsour.2020.228999.pdf", "10.1016/j.jpowsour.2020.228999", "review", "Accepted Manuscript", [], ["filename_doi"], 0.0, 0.0),
        ("book", "10.1007_978-3-030-12345-6.pdf", "10.1007/978-3-030-12345-6", "review", "", [], ["filename_doi"], 0.0, 0.0),
        ("four", "10.1149_ma2013-01_4_233.pdf", "10.1149/ma2013-01_4_233", "review", "Some title", [], ["filename_doi"], 0.0, 0.0),
        ("none", "y.pdf", "10.1000/gone.1", "review", "Some other title", [], ["raw_pdf_bytes"], 0.0, 0.0),
        ("done", "z.pdf", "10.1000/ok.1", "ok", "", [], [], 0.0, 0.0),
    ]
    known = [
        ("10.1016/j.jpowsour.2020.228999", "crossref", True, "10.1016/j.jpowsour.2020.228999", "Second", ["C D"], None),
        ("10.1016/j.jpowsour.2020.228999", "doi.org", True, "10.1016/j.jpowsour.2020.228999", "A Different But Real Battery Article", ["Ada Lovelace"], None),
        ("10.1007/978-3-030-12345-6", "doi.org", True, "10.1007/978-3-030-12345-6", "Some Battery Handbook", [], None),
        ("10.1149/ma2013-01/4/233", "doi.org", True, "10.1149/MA2013-01/4/233", "Electrochemical Society Abstract", [], None),
        ("10.1000/gone.1", "doi.org", False, None, None, None, "HTTP 429"),
    ]
    records, answers = spark.createDataFrame(rows, REVIEW), spark.createDataFrame(known, SCHEMA)
    decided = R.review(records, answers)
    got = {r["path"]: r for r in decided.collect()}
    assert len(got) == decided.count() == 5
    assert {k: (r["stage"], r["accepted"], r["decision"]) for k, r in got.items()} == {
        "two": ("stage2", True, "stage2_accept_probable"), "three": ("stage3", True, "stage3_accept_probable"), "book": ("stage3", True, "stage3_accept_probable"),
        "four": ("stage4", True, "stage4_accept_probable"), "none": ("stage4", False, "stage4_unresolved"),
    }
    assert got["three"]["authority_title"] == "A Different But Real Battery Article"
    assert (got["four"]["final_doi"], got["four"]["corrected_doi"], got["four"]["tried_dois"]) == ("10.1149/MA2013-01/4/233", "10.1149/MA2013-01/4/233", ["10.1149/MA2013-01/4/233"])
    assert (got["none"]["final_doi"], got["none"]["error"], got["none"]["tried_dois"]) == ("10.1000/gone.1", "no retry/normalized DOI resolved", ["10.1000/gone.1"])
    again = spark.createDataFrame([("10.1000/gone.1", "doi.org", True, "10.1000/GONE.1", "Some other title", ["A B"], None)], SCHEMA)
    none = {r["path"]: r for r in R.review(records, answers, retried=again).collect()}["none"]
    assert (none["stage"], none["decision"], none["final_doi"]) == ("stage4", "stage4_accept_high", "10.1000/GONE.1")
    stored = {r["path"]: r["decision"] for r in R.review(records, None).collect()}
    assert stored["two"] == "stage2_accept_probable" and stored["book"] == "stage2_needs_authority"
    out = {r["path"]: r for r in R.applied(records.withColumn("confidence", F.lit("review")), decided).collect()}
    assert (out["two"]["status"], out["two"]["original_status"], out["two"]["doi_validation_source"]) == ("ok", "review", "postprocess_existing_evidence")
    assert out["four"]["doi"] == "10.1149/MA2013-01/4/233" and out["four"]["original_doi"] == "10.1149/ma2013-01_4_233" and out["four"]["authority_title_score"] == "0.0000" or float(out["four"]["authority_title_score"]) > 0
    assert out["none"]["status"] == "review" and out["none"]["review_stage"] == "stage4" and out["done"]["original_status"] is None


def test_caches_of_json_lines(spark, tmp_path):
    path = tmp_path / "c.jsonl"
    path.write_text('{"key":"a","value":{"error":"HTTPError: 429"},"time":1}\n{"key":"b","value":{"x":"bad \\"q\\""},"time":2}\nno json\n\n{"doi":"10.1000/X","resolved":true,"error":""}\n{"key":"b","value":{"x":2},"time":3}\n')
    cache = A.cache_lines(spark, str(path))
    assert {r["key"]: r["error"] for r in cache.collect()} == {"a": "HTTPError: 429", "b": None, "10.1000/x": None}
    assert {r["key"]: r["value"] for r in A.latest(A.usable(cache), ["key"], "line").collect()}["b"] == '{"x":2}'
    new = spark.createDataFrame([('k"1', '{"v":1}', None, 5.0), ("k2", None, "timeout", 6.0)], "key string, value string, error string, time double")
    for keep, want in ((False, {'k"1': None}), (True, {'k"1': None, "k2": "timeout"})):
        A.append_cache(new, str(tmp_path / f"out{keep}"), keep)
        assert {r["key"]: r["error"] for r in A.cache_lines(spark, str(tmp_path / f"out{keep}")).collect()} == want


def test_search_results_of_each_source(spark):
    texts = {
        "crossref": {"message": {"items": [{"DOI": "10.1000/A1", "title": ["T"], "author": [{"given": "A", "family": "B"}]}, {"title": ["no id"]}]}},
        "datacite": {"data": [{"attributes": {"doi": "10.1000/a2", "titles": [{"title": "T"}], "creators": [{"name": "B, A"}]}}]},
        "openalex": {"results": [{"doi": "https://doi.org/10.1000/a3", "title": "T", "authorships": [{"author": {"display_name": "A B"}}]}]},
        "semantic_scholar": {"data": [{"externalIds": {"DOI": "10.1000/a4"}, "title": "T", "authors": [{"name": "A B"}], "publicationTypes": ["Review", "Study"]}]},
    }
    for source, data in texts.items():
        df = spark.createDataFrame([(json.dumps(data),), (None,), ("{}",)], "v string")
        rows = [r["a"] for r in df.select(A.search_results(source, F.col("v")).alias("a")).collect()]
        assert [len(x) for x in rows] == [1, 0, 0] and rows[0][0]["title"] == "T" and rows[0][0]["authors"] in (["A B"], ["B, A"])


def test_layout_text(spark):
    blocks = [("p", 1, 5.0, 20.04, "second\nline"), ("p", 1, 9.0, 1.0, "right one"), ("p", 1, 1.0, 1.04, " left  one "), ("p", 1, 0.0, 0.0, "123"),
        ("p", 2, 0.0, 0.0, "page two"), ("p", 2, 0.0, 1.0, "ab")]
    got = files.layout_text(spark.createDataFrame(blocks, "k string, page int, x double, y double, text string"), "k", 1000).first()["text"]
    assert got == "# Page 1\n\nleft one\n\nright one\n\nsecond line\n\n\n\n# Page 2\n\npage two\n\n"


def test_generated_answers(spark):
    text = 'Sure:\n```json\n{"title":"T","candidates":[{"doi":"10.1000/abc1"},{"doi":"10.1000/abc2","is_main_article":false},{"doi":"10.1000/abc3","confidence":"low"},{"doi":"bad"}]}\n```'
    df = spark.createDataFrame([(text,), ("no json",), (None,)], "x string")
    got = [[c["doi"] for c in r["c"]] for r in df.select(G.generated_candidates(G.answered(F.col("x"))).alias("c")).collect()]
    assert got == [["10.1000/abc1"], [], []]


def test_text_candidates_keep_the_longest(spark):
    df = spark.createDataFrame([(1, "10.1000/ab.1 and 10.1000/ab.1.s002, 10.1000/xy")], "k int, x string")
    assert {r["doi"] for r in G.text_candidates(df, "k", F.col("x")).collect()} == {"10.1000/ab.1.s002", "10.1000/xy"}


def test_titles_to_search_by(spark):
    df = spark.createDataFrame([("print", "clean_3_growth_of_thin_oxide_films.pdf", "Journal of X\nGrowth of thin oxide films on glass\nshort")], "t string, f string, x string")
    row = df.select(G.title_queries([F.col("t")], F.col("f"), F.col("x")).alias("q"), G.search_requests(F.col("f"), F.array(F.lit("Ana Li"))).alias("r")).first()
    assert row["q"] == ["Growth of thin oxide films on glass", "growth of thin oxide films"] and row["r"][1].endswith(" li")


def test_queue(spark):
    rows = [("d", "a.pdf", "PhD thesis", "900", ""), ("d", "b.pdf", "x", "10", ""), ("d", "c.pdf", "y", "900", ""), ("d", "e.pdf", "z", "900", "no_doi_unresolved")]
    records = spark.createDataFrame(rows, "folder string, filename string, title string, text_chars string, final_decision string")
    none = spark.createDataFrame([("d", "c.pdf", "10.1000/abc1")], "folder string, filename string, candidate_doi string")
    queue = Q.review_queue(records, none, none.limit(0))
    assert {r["filename"]: r["action"] for r in queue.collect()} == {"a.pdf": "thesis-repository-search", "b.pdf": "vision-ocr-needed", "c.pdf": "candidate-visible-review", "e.pdf": "likely-no-doi"}
    assert "<article" in Q.review_page(queue) and Q.decision_template(queue).count() == 4


def test_contact_is_told():
    assert "mailto:a@b.co" in connectors.HttpSource("crossref", mail="a@b.co").agent()


def test_unreadable_files_are_rows(spark):
    class Broken:
        def read(self, content, name):
            raise ValueError("cannot " + name)

    df = spark.createDataFrame([("p", "a.pdf", bytearray(b"x"))], "path string, filename string, content binary")
    assert tuple(connectors.read_files(df, Broken()).first()) == ("p", None, "cannot a.pdf")
