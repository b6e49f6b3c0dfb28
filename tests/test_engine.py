"""Facts that the engine must reproduce, boundaries of its rules, and independence of row order."""

import pytest
from pyspark.sql import functions as F

from refloom.functions import identifiers as I
from refloom.functions import similarity as S
from refloom.functions import text as T
from refloom.operators import authority as A
from refloom.operators import candidates as C
from refloom.operators import decisions as D
from refloom.plans import records as P
from refloom.sources import files
from refloom.sources.front_page import front_page


def values(spark, column, *rows, schema="x string"):
    df = spark.createDataFrame([(*([i] + list(r if isinstance(r, tuple) else (r,))),) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[0] for r in df.select(column.alias("v"), "i").orderBy("i").collect()]


def test_normal_form(spark):
    got = values(spark, I.normalize(F.col("x")), "https://doi.org/10.1021/acsnano.6b04019]", "10.1002/ange.201903709", "10.21203/rs.3.rs-123456_v1", "10.1/a(b)).",
        "10.1/a).;)", None, "10.1007/s12.Conclusion", "10.1000/ab.12 34;10.1000/x")
    assert got == ["10.1021/acsnano.6b04019", "10.1002/anie.201903709", "10.21203/rs.3.rs-123456/v1", "10.1/a(b", "10.1/a", "", "10.1007/s12", "10.1000/ab.1234"]


def test_plausible(spark):
    got = values(spark, I.is_plausible(F.col("x")), "10.1016/S0378-7753(98)00241-9", "10.1002/((please", "10.1039/x0xx00000x", "10.1088/2053-1591/0/0/000", "10.1/x",
        "10.1000/(ISSN)1", None, "10.1000/" + "a" * 300)
    assert got == [True] + [False] * 7


def test_strip_trailing_keeps_balanced_brackets(spark):
    assert values(spark, I.strip_trailing(F.col("x")), "10.1/a(b)).", "10.1/a(b)", "10.1/a).;)", "10.1/(98)00241-9]") == ["10.1/a(b)", "10.1/a(b)", "10.1/a", "10.1/(98)00241-9"]


def test_scan_gives_repeats_and_contexts(spark):
    hits = values(spark, I.find(F.col("x"), F.lit("t")), "see 10.1002/anie.201903709; 10.1002/ange.201903709 end", "Insert 10.1002/((please here", "doi: 10.21203/rs.3.rs-123456_v1", None)
    assert [h["doi"] for h in hits[0]] == ["10.1002/anie.201903709"] * 2
    assert hits[0][0]["context"].startswith("see 10.1002") and hits[0][0]["context"].endswith("end")
    assert hits[1] == [] and hits[2][0]["doi"] == "10.21203/rs.3.rs-123456/v1" and hits[3] == []


def test_bytes_keep_identifiers(spark):
    df = spark.createDataFrame([(bytes([0xA9]) + b" 2020 doi: 10.1016/j.jpowsour.2020.228999",)], "content binary")
    hits = df.select(files.raw_hits(files.decoded(F.col("content"))).alias("h")).first()["h"]
    assert [h["doi"] for h in hits] == ["10.1016/j.jpowsour.2020.228999"]


def test_source_weights(spark):
    assert values(spark, I.source_weight(F.col("x")), "markdown_references", "ocr_references", "xmp_tag_prism:doi_0", "raw_pdf_bytes", "pypdf_page_1") == ["review", "review", "high", "medium", "low"]


def rows_of(spark, rows):
    return spark.createDataFrame([("p", i, d, s) for i, (d, s) in enumerate(rows)], "path string, ord int, doi string, source string")


@pytest.mark.parametrize(
    ("rows", "want"),
    [
        ([("10.1002/((please", "grobid_doi"), ("10.1002/adma.202403521", "filename")], ("10.1002/adma.202403521", "review", "filename_only_candidate_requires_validation")),
        ([("10.1000/A1", "raw_pdf_bytes"), ("10.1000/a1", "markdown_front")], ("10.1000/A1", "high", "multiple_independent_sources")),
        ([("10.1000/ab", "filename"), ("10.1000/ab", "pypdf_page_1")], ("10.1000/ab", "review", "selected_by_source_weight")),
        ([("10.1000/ab", "pypdf_page_1"), ("10.1000/cd", "pypdf_page_2")], ("10.1000/ab", "low", "selected_by_source_weight")),
    ],
)
def test_choice(spark, rows, want):
    found = C.choose(C.to_candidates(rows_of(spark, rows).repartition(3), "path"), "path").first()
    assert (found["doi"], found["confidence"], found["doi_decision"]) == want


def test_added_candidates_have_weights_of_their_own(spark):
    assert values(spark, I.candidate_weight(F.col("x")), "grobid_doi", "crossref_title_search", "llm_candidate", "crossref_other", "markdown_front") == ["medium", "review", "review", "low", "high"]


def test_prefix_variants(spark):
    """Only the first underscore parts head and rest; the head's case counts where it is said."""
    got = values(spark, F.transform(I.prefix_variants(F.col("x")), lambda v: v["doi"]), "10.1049/ic_2010_0012", "10.1049/icp_2010_1", "10.1023/a_1234_5",
        "10.4233/uuid_ab_c", "10.1117/12.700000.x", "10.1117/12.700000", "10.1209/a_b_c", "10.1000/a_b")
    assert got == [["10.1049/ic:2010_0012", "10.1049/cp:2010_0012"], ["10.1049/icp:2010_1"], ["10.1023/A:1234_5"], ["10.4233/uuid:ab_c"], ["10.1117/12.700000"], [], ["10.1209/a/b/c"], []]


def test_suspicious_identifiers_and_titles(spark):
    by_doi = values(spark, I.suspicious(F.col("x")), "10.1000/a.s001", "10.1000/x/fig-1", "10.1000/x/figure12", "10.1000/x/figabc1", "10.1000/x/fig_v2",
        "10.5061/dryad.1", "10.1000/supporting-information", "10.1000/plain")
    assert by_doi == [True, True, True, False, False, True, True, False]
    by_title = values(spark, I.suspicious(F.lit("10.1000/a"), F.col("x"), F.lit("journal-article")), "On the dataset of x", "Data from: y", "See Figure 12 here",
        "Datasets", "A figure of speech", None)
    assert by_title == [True, False, True, False, False, False]
    assert values(spark, I.suspicious(F.lit("10.1000/a"), F.lit("t"), F.col("x")), "posted-content", "Dataset", "component", "book", None) == [True, True, True, False, False]


def test_useful_titles(spark):
    rows = ("Introduction to the growth of films", "Growth of films with a table of contents", "关键词: growth of thin oxide films here",
        "lithium battery electrode materials", "Growth of thin oxide films", "short one", "preparing your manuscript for the press now", None)
    assert values(spark, T.useful_title(F.col("x")), *rows) == [False, False, False, False, True, False, False, False]
    assert values(spark, T.useful_title(F.col("x"), domain=False), *rows) == [False, False, False, True, True, False, True, False]


def test_names_of_files_and_messages(spark):
    assert values(spark, T.title_from_name(F.col("x")), "clean_12_growth_of-thin_oxide_films(2).pdf", "10.1000_abc growth of films on thin glass.pdf", "short.pdf",
        None) == ["growth of thin oxide films", "growth of films on thin glass", "", ""]
    assert values(spark, T.append_message(F.col("a"), F.col("b")), ("", "x"), ("x", "y"), ("x", ""), (None, "y"), schema="a string, b string") == ["x", "x | y", "x", "y"]
    assert values(spark, T.short(F.col("x"), 5), "abcdef", "abcde", None) == ["abcd...", "abcde", ""]
    assert values(spark, T.add_source(F.col("x"), F.lit("ocr")), "pdf+ocr", "pdf", None) == ["pdf+ocr", "pdf+ocr", "ocr"]


def test_many_matches_have_their_contexts(spark):
    text = " ".join(f"see 10.1000/x{i:04}" for i in range(2000))
    hits = values(spark, I.find(F.col("x"), F.lit("t")), text)[0]
    assert [h["doi"] for h in hits] == [f"10.1000/x{i:04}" for i in range(2000)] and all(f"see 10.1000/x{i:04}" in hits[i]["context"] for i in range(2000))


@pytest.mark.parametrize("common", [2, 1000])
def test_title_search_is_exact(spark, common):
    import random

    rng = random.Random(5)
    words = [f"c{i}" for i in range(4)] * 6 + [f"r{i}" for i in range(60)]
    titles = lambda n: [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 6)))) for i in range(n)]
    asked, index = titles(60), titles(200)
    got = P.title_search(spark.createDataFrame(asked, "query_id long, title string"), spark.createDataFrame(index, "doc_key long, title string"), 3, common).collect()
    want = {}
    for i, t in asked:
        q = set(t.split())
        scored = sorted((-round(len(q & set(x.split())) / len(q), 4), k) for k, x in index if q & set(x.split()))
        want |= {(i, n + 1): (k, -s) for n, (s, k) in enumerate(scored[:3])}
    assert {(r["query_id"], r["rank"]): (r["doc_key"], r["overlap"]) for r in got} == want


def rows_of_joins(df):
    """Rows that the joins of a finished plan have made."""

    def made(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return made(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return made(node.plan())
        children, metric = node.children(), node.metrics().get("numOutputRows")
        own = metric.get().value() if kind.endswith("JoinExec") and metric.isDefined() else 0
        return own + sum(made(children.apply(i)) for i in range(children.size()))

    return made(df._jdf.queryExecution().executedPlan())


def test_title_search_by_common_words_does_not_pair_all_sets(spark):
    """One word is in all titles, and every set of words is another: their product is no work that has to be done."""
    texts = [f"note {kind} n{i}" for i in range(40) for kind in ("en s0", "en s1", "en s2", "de s0", "de s1", "de s2", "fr s0", "fr s1")]
    asked, index = list(enumerate(texts)), [(i, f"{t} again" if i % 3 == 0 else t) for i, t in enumerate(texts)]
    df = P.title_search(spark.createDataFrame(asked, "query_id long, title string"), spark.createDataFrame(index, "doc_key long, title string"), 3, 0)
    got = {(r["query_id"], r["rank"]): (r["doc_key"], r["overlap"]) for r in df.collect()}
    sets, want = [(k, set(x.split())) for k, x in index], {}
    for i, t in asked:
        q = set(t.split())
        want |= {(i, n + 1): (k, -s) for n, (s, k) in enumerate(sorted((-round(len(q & x) / len(q), 4), k) for k, x in sets)[:3])}
    assert got == want
    assert rows_of_joins(df) < len(asked) * len(index) / 2


def test_one_answer_for_a_key(spark):
    rows = [("10.1/a", "crossref", True, "B", None), ("10.1/a", "doi.org", True, "", None), ("10.1/a", "doi.org", False, None, "e"), ("10.1/b", "osti", True, "no", None),
        ("10.1/b", "datacite", False, None, "gone"), ("10.2172/c", "osti", True, "yes", None), ("10.2172/c", "doi.org", True, "x", None)]
    got = A.one_answer(spark.createDataFrame(rows, "doi_key string, source string, resolved boolean, title string, error string").repartition(3))
    assert {r["doi_key"]: (r["source"], r["resolved"]) for r in got.collect()} == {"10.1/a": ("crossref", True), "10.1/b": ("datacite", False), "10.2172/c": ("osti", True)}


def test_variants(spark):
    got = values(spark, F.transform(I.token_variants(F.col("x")), lambda v: v["doi"]), "10.1149_1945-7111_ac6aea", "10.5445_ir_1000091096", "no token")
    assert "10.1149/1945-7111/ac6aea" in got[0] and "10.5445/IR/1000091096" in got[1] and got[2] == []
    assert values(spark, I.ecs_variant(F.col("x")), "10.1149/ma2013-01_4_233", "10.1149/2.1jes") == ["10.1149/MA2013-01/4/233", ""]
    assert values(spark, I.from_pii(F.col("x")), "S0378775398002419", "nothing") == ["10.1016/S0378-7753(98)00241-9", ""]


def test_coverage_and_scores(spark):
    title, text = "Realizing ultrahigh energy storage", "intro REALIZING Ultrahigh energy-storage in"
    assert values(spark, S.title_coverage(F.col("t"), F.col("x")), (title, text), (title, ""), ("", text), schema="t string, x string") == [1.0, 0.0, 0.0]
    df = spark.createDataFrame([("Some longer title here", "Some longer title here"), ("print", "print"), ("abcd efgh", "bcde fghi")], "a string, b string")
    got = [r["s"] for r in S.with_title_score(df, "s", F.col("a"), F.col("b")).collect()]
    assert got[:2] == [1.0, 0.0] and 0 < got[2] < 1
    assert values(spark, S.author_score(F.array(F.lit("Jian Li"), F.lit("Q. Wang")), F.array(F.col("x"))), "Li, Jian", "Nobody Else") [1] == 0.0


def test_front_pages():
    one = "\n Nature Energy\n Article\n A robust interphase enables fast charging lithium metal batteries\n Jian Li1, Maria R. Gomez2 and Q. Wang3,*\n Department of Materials Science, Example University\n Abstract\n The abstract starts here.\n"
    two = "doi: 10.1021/example.12345\nwww.example-journal.org\nMicrosoft Word - manuscript.doc\nOperando imaging of sodium plating in solid electrolytes\nAlice Smith, Bob Chen\nAbstract\n"
    three = "View Article Online\nD Check for updates. Realizing ultrahigh energy storage performance in\n加 sodium bismuth titanate-based ceramics via local\nCite this: J. Mater. Chem. A, 2025, 13,\n32857 polarization engineering\nYiyan Zhou, Shiyu Yang, Ziyang Zhou, Meilin Cao\nAbstract\n"
    assert front_page(one) == ("A robust interphase enables fast charging lithium metal batteries", ["Jian Li", "Maria R. Gomez", "Q. Wang"])
    assert front_page(two) == ("Operando imaging of sodium plating in solid electrolytes", ["Alice Smith", "Bob Chen"])
    assert front_page(three) == ("Realizing ultrahigh energy storage performance in sodium bismuth titanate-based ceramics via local polarization engineering",
        ["Yiyan Zhou", "Shiyu Yang", "Ziyang Zhou", "Meilin Cao"])


FACTS = {"doi": True, "t": 0.0, "a": 0.0, "c": 0.0, "ff": False, "no_authors": False, "bad_title": False, "res": True, "mainstream": False, "search": False,
    "title_words": 5, "prefix_variant": False, "useful": True, "visible": False, "suspicious": False, "references": False}


@pytest.mark.parametrize(
    ("table", "facts", "want"),
    [
        ("stage2", {"t": 0.89, "a": 0.80}, (True, "medium", "stage2_accept_probable")),
        ("stage2", {}, (False, "none", "stage2_needs_authority")),
        ("stage2", {"t": 0.985}, (True, "high", "stage2_accept_high")),
        ("stage2", {"t": 0.9849}, (False, "none", "stage2_needs_authority")),
        ("stage2", {"t": 0.94, "a": 0.1499}, (False, "none", "stage2_needs_authority")),
        ("stage2", {"t": 0.94, "a": 0.15}, (True, "high", "stage2_accept_high")),
        ("stage3", {"ff": True, "bad_title": True}, (True, "medium", "stage3_accept_probable")),
        ("stage3", {"res": False, "t": 1.0}, (False, "none", "stage3_unresolved_not_resolved")),
        ("stage4", {"ff": True}, (True, "medium", "stage4_accept_probable")),
        ("hard_case", {"c": 0.78}, (True, "high", "title in text")),
        ("hard_case", {"c": 0.7799}, (False, "none", "no automatic rule matched")),
        ("hard_case", {"c": 0.78, "title_words": 3, "search": True}, (True, "medium", "search and title in text")),
        ("round2", {"t": 0.93, "a": 0.10}, (True, "high", "relaxed title and author")),
        ("ocr", {"suspicious": True, "c": 1.0}, (False, "none", "supplement or dataset")),
        ("layout", {"useful": False, "visible": True, "c": 0.95}, (True, "medium", "visible and title in text")),
    ],
)
def test_rules(spark, table, facts, want):
    df = spark.createDataFrame([tuple((FACTS | facts).values())], ", ".join(f"`{k}` {'boolean' if isinstance(v, bool) else 'int' if isinstance(v, int) else 'double'}" for k, v in FACTS.items()))
    assert tuple(df.select(D.decide(table).alias("d")).first()["d"]) == want


def test_cache_rules(spark):
    cache = spark.createDataFrame([("a", "1", None, 1.0), ("a", None, "429", 2.0), ("b", "2", None, 1.0), ("b", "3", None, 5.0)], "key string, value string, error string, time double")
    assert {r["key"]: r["value"] for r in A.latest(A.usable(cache), ["key"], "time").collect()} == {"a": "1", "b": "3"}
    wanted = spark.createDataFrame([("a",), ("c",), ("c",)], "key string")
    assert [r["key"] for r in A.misses(wanted, cache, "key").collect()] == ["c"]


def test_authority_json(spark):
    csl = '{"DOI":"10.1000/X1","title":"T","author":[{"literal":"Group"},{"given":"A","family":"B"}],"issued":{"date-parts":[[2001]]}}'
    osti = '[{"doi":"10.2172/12","title":"R","authors":["C, D"],"publication_date":"1999-01-01"}]'
    got = values(spark, A.parsed("doi.org", F.col("x")), csl)[0]
    assert (got["authority_doi"], got["authors"], got["year"]) == ("10.1000/X1", ["Group", "A B"], "2001")
    got = values(spark, A.parsed("osti", F.col("x")), osti)[0]
    assert (got["title"], got["authors"], got["publisher"], got["year"]) == ("R", ["C, D"], "OSTI", "1999")


def test_broken_headers_are_blank(spark):
    got = values(spark, files.tei_header(F.col("x")), '<TEI xmlns="http://x"><titleStmt><title>A <hi>b</hi></title></titleStmt><idno type="DOI">10.1000/x1</idno></TEI>', "<TEI><broken", None)
    assert (got[0]["title"], got[0]["doi"]) == ("A b", "10.1000/x1") and got[1]["title"] == got[2]["title"] == ""


def test_files_to_records(spark, tmp_path):
    (tmp_path / "10.1016_j.x.2020.1.PDF").write_bytes(b"%PDF /URI (https://doi.org/10.1016/j.x.2020.1) <x:xmpmeta a><prism:doi>10.1016/j.x.2020.1</prism:doi></x:xmpmeta>")
    (tmp_path / "none.pdf").write_bytes(b"%PDF")
    (tmp_path / "none.txt").write_bytes(b"10.1000/xyz1")
    hits = files.file_hits(files.inventory(spark, str(tmp_path)))
    found = {r["path"].rsplit("/", 1)[1]: r for r in P.identify(hits, F.col("hits")).collect()}
    assert found["10.1016_j.x.2020.1.PDF"]["doi"] == "10.1016/j.x.2020.1" and found["10.1016_j.x.2020.1.PDF"]["status"] == "ok"
    assert found["none.pdf"]["status"] == "no_doi" and len(found) == 2


def test_stream_is_written_once(spark, tmp_path):
    from refloom.streaming.ingest import ingest

    src = tmp_path / "in"
    src.mkdir()
    (src / "a.pdf").write_bytes(b"doi: 10.1000/abc1")
    for _ in range(2):
        ingest(spark, str(src), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert [r["doi"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["10.1000/abc1"]


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([('a "b"', ["x", "y"], None)], "t string, l array<string>, n int")
    files.write_table(df, str(tmp_path / "t"))
    assert [tuple(r) for r in files.manifest(spark, str(tmp_path / "t")).collect()] == [('a "b"', "x; y", None)]


def test_summary_counts(spark):
    df = spark.createDataFrame([("x", "a"), ("x", "b"), ("y", "a")], "stage string, decision string")
    got = {(r["metric"], r["value"]): r["n"] for r in P.summary(df, ["stage", "decision"]).collect()}
    assert got == {("total", ""): 3, ("stage", "x"): 2, ("stage", "y"): 1, ("decision", "a"): 2, ("decision", "b"): 1}


def test_titles(spark):
    assert values(spark, T.norm_text(F.col("x")), "β-phase <i>NiO</i> métal_film – 2", None) == ["beta phase nio métal film 2", ""]
    assert values(spark, T.is_bad_title(F.col("x")), "Abstract", "print", "", None, "A real title") == [True, True, True, True, False]
