"""Registered queries of the engine and their SQL for another engine.

The tables hold no identifiers, so each query puts some in by an expression that both engines read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import identifiers as I
from .functions import similarity as S
from .functions import text as T
from .operators import authority as A
from .operators import candidates as C
from .operators import decisions as D
from . import sql_facts as K
from .plans import hard_cases as H
from .plans import main_pass as M
from .plans import records as P
from .plans import review as R
from .sources import files, front_page

# ---------------------------------------------------------------- inputs, in SQL that both engines read
PAD = "lpad(cast(doc_id % 100000 as string), 5, '0')"
RAW = f"""CASE doc_id % 16
 WHEN 0 THEN 'https://doi.org/10.1021/acs' || doc_id || ']' WHEN 1 THEN '10.1002/ange.2019' || {PAD}
 WHEN 2 THEN '10.21203/rs.3.rs-' || doc_id || '_v1' WHEN 3 THEN '10.1002/((please'
 WHEN 4 THEN 'DOI: 10.1016/S0378-7753(98)' || {PAD} || '-9;' WHEN 5 THEN '10.1000/abc.' || doc_id || ').;)'
 WHEN 6 THEN '10.1039/x0xx00000x' WHEN 7 THEN '10.1002/adma.2024' || {PAD} || '.Advanced'
 WHEN 8 THEN '10.1007/s' || doc_id || '5.Conclusion' WHEN 9 THEN '10.1021/jp' || doc_id || '/suppl_file/x.pdf'
 WHEN 10 THEN '10.1149/2.' || doc_id || 'jes&gt;<b>' WHEN 11 THEN '10.1088/2053-1591/0/0/000'
 WHEN 12 THEN 'doi.org/10.5555/A(' || doc_id || ')b)].' WHEN 13 THEN '10.1002/anie.2020' || {PAD} || 'wileyonline.text'
 WHEN 14 THEN '10.1016/j.' || source || '.' || doc_id || ';10.1000/next' ELSE '10.' || doc_id || '/short' END"""
# A whole text with an identifier after it; every third has a second, spaced or broken one.
TEXT = f"""coalesce(text, '') || ' doi: 10.' || (1000 + doc_id % 7) || '/j.' || lang || '.' || doc_id || '. ' ||
 CASE doc_id % 3 WHEN 0 THEN 'see 10.1021/acs.' || doc_id || ', too' WHEN 1 THEN 'and http://dx.doi.org/10.1002/anie.2019' || {PAD} || ')' ELSE '' END"""
STEM = f"""CASE doc_id % 6 WHEN 0 THEN '10.1016_j.' || source || '.' || doc_id WHEN 1 THEN '1-s2.0-S03787753' || '98' || {PAD} || '9-main'
 WHEN 2 THEN 'paper_ssrn-' || (10000 + doc_id) || '_final' WHEN 3 THEN '10.1149_1945-7111_ac' || doc_id
 WHEN 4 THEN '10.1021_acs.' || doc_id || '_si_001' ELSE 'notes on ' || source || ' ' || doc_id END"""
TITLE = "CASE doc_id % 9 WHEN 0 THEN 'Abstract' WHEN 1 THEN 'Microsoft Word' WHEN 2 THEN '  ' WHEN 3 THEN 'Master''s thesis of ' || source WHEN 4 THEN 'β-phase <i>' || source || '</i> films – a study_of ' || lang || ' growth' ELSE coalesce(text, '') END"
SOURCES = ("filename_doi", "markdown_references_front", "xmp_tag_prism:doi_0", "pypdf_page_1", "raw_pdf_bytes", "ocr_body", "grobid_doi", "crossref_title_search",
    "llm_candidate", "markdown_front", "other")
SOURCE_SQL = "CASE (doc_id + k * 5) % 11 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SOURCES)) + " END"
SCORES = "((doc_id * 37) % 101) / 100.0"
SCORES_A = "((doc_id * 53) % 101) / 100.0"
SCORES_C = "((doc_id * 71) % 101) / 100.0"
FACTS = f"""doc_id, cast({SCORES} as double) AS t, cast({SCORES_A} as double) AS a, cast({SCORES_C} as double) AS c, doc_id % 13 <> 0 AS doi, doc_id % 3 = 0 AS ff,
 doc_id % 4 = 0 AS no_authors, doc_id % 5 = 0 AS bad_title, doc_id % 7 <> 0 AS res, doc_id % 11 < 5 AS mainstream, doc_id % 6 = 0 AS search,
 doc_id % 8 AS title_words, doc_id % 10 = 0 AS prefix_variant, doc_id % 2 = 0 AS useful, doc_id % 3 <> 1 AS visible, doc_id % 17 = 0 AS suspicious, doc_id % 19 = 0 AS "references" """
PEOPLE = "'Ana ' || source || '; Bob de ' || lang || ' and C. ' || upper(source) || 'son'"
WORK_PEOPLE = "CASE doc_id % 3 WHEN 0 THEN 'A. ' || source || ';Someone Else' WHEN 1 THEN 'Other Person' ELSE 'de ' || lang || ', and Xu Li' END"
SHORT_A = "'Growth of ' || source || ' films in ' || lang || ' oxide layers number ' || (doc_id % 10)"
SHORT_B = "CASE doc_id % 4 WHEN 0 THEN 'Growth of ' || source || ' films in ' || lang || ' oxide layers number ' || (doc_id % 10) WHEN 1 THEN 'Growth of ' || source || ' films' WHEN 2 THEN 'Films of ' || lang || ' oxide: growth and ' || source ELSE 'An unrelated ' || lang || ' title' END"
JSON = """'{"message":{"DOI":"10.1000/x' || doc_id || '","title":["","Work ' || doc_id || '"],"author":[{"given":"A","family":"' || source || '"},{"family":"B"}],"container-title":["J ' || lang || '"],"publisher":"P","issued":{"date-parts":[[' || (1990 + doc_id % 30) || ',1]]},"type":"journal-article"}}'"""
#: Titles that are searched by or not: headings, field words, long ones.
SEARCH_TITLE = f"""CASE doc_id % 7 WHEN 0 THEN {SHORT_A} WHEN 1 THEN 'lithium battery electrode ' || lang WHEN 2 THEN 'Introduction to ' || source || ' growth of films'
 WHEN 3 THEN 'Table of contents of ' || source || ' and others' WHEN 4 THEN '关键词: films of ' || source || ' in thin layers' WHEN 5 THEN coalesce(text, '') ELSE 'preparing your manuscript for ' || source || ' press' END"""
MARKDOWN = "coalesce(text, '') || chr(10) || '## References' || chr(10) || '[1] doi:10.1000/ref.' || doc_id || chr(10)"


def docs(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    quoted = [c.replace('"references"', "`references`") for c in columns]
    return spark.read.parquet(f"{d}/documents.parquet").selectExpr(*quoted)


# ---------------------------------------------------------------- pieces of SQL for the other engine
def q_clean(x: str) -> str:
    return f"regexp_replace(translate(coalesce({x}, ''), chr(13) || chr(10), '  '), '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g')"


def q_norm(x: str) -> str:
    y = f"lower({q_clean(x)})"
    for a, b in K.GREEK:
        y = f"replace({y}, '{a}', '{b}')"
    y = f"translate({y}, '{K.DASHES}', '{'-' * len(K.DASHES)}')"
    return f"trim(regexp_replace(regexp_replace({y}, '<[^>]+>', ' ', 'g'), '[^\\pL\\pN]+', ' ', 'g'))"


def q_plausible(x: str) -> str:
    return f"""(regexp_full_match({x}, '(?i)10\\.\\d{{4,9}}/[-._;()/:+A-Z0-9_]+') AND length({x}) BETWEEN 8 AND 300 AND lower({x}) <> '{K.PLACEHOLDER}'
      AND NOT regexp_matches({x}, '(?i)^10\\.1088/2053-1591/0/0/0+$') AND NOT regexp_matches({x}, '{K.PLACEHOLDER_WORDS}') AND NOT regexp_matches({x}, '^[^/]*/\\(\\(')
      AND length(replace({x}, '(', '')) = length(replace({x}, ')', '')) AND NOT regexp_matches({x}, '(?i)/\\(?ISSN\\)?'))"""


def q_normalize(rows: str, keep: str) -> str:
    """CTEs over ``rows`` (keep, raw), the last one named ``normal`` with ``doi``."""
    r = lambda x, p, to="": f"regexp_replace({x}, '{p}', '{to}')"
    edge = "[ \\t\\r\\n\"''<>\\[\\]{}(.,;:)]"
    steps = r("raw", f"^{edge}+")
    steps = r(steps, f"{edge}+$")
    for p in ("(?i)^https?://(?:dx\\.)?doi\\.org/", "(?i)^(?:dx\\.)?doi\\.org/", "(?i)^doi\\s*[:=]\\s*"):
        steps = r(steps, p)
    steps = f"regexp_replace(replace({steps}, '\\/', '/'), '\\\\\\s*|\\s+', '', 'g')"
    steps = r(steps, "(?s)[;,，。]+10\\.\\d{4,9}/.*")
    steps = f"replace(replace({steps}, '&gt', ''), '&lt', '')"
    for p in ("(?i)\\)tj$", "(?s)\\)/[A-Za-z]+.*", "(?is)/suppl_file/.*", "(?is)\\.?doi[:=].*"):
        steps = r(steps, p)
    steps = r(steps, "(?i)^(10\\.1002/\\d{10,13})\\.fmatter$", "\\1")
    steps = r(steps, "(?is)(?:<|%0a|%0d).*")
    steps = r(steps, "(?i)^(10\\.21203/rs\\.3\\.rs-[a-z0-9-]+)_v(\\d+)$", "\\1/v\\2")
    steps = r(steps, "(?i)^(10\\.1002/)ange(\\.\\d+)$", "\\1anie\\2")
    w = [f"regexp_extract(d1, '{p}', 1)" for p in K.WILEY_TAILS]
    s = f"regexp_extract(d2, '{K.SENTENCE_TAIL}', 1)"
    run = "regexp_extract(d3, '([.,;:''\"\\]}>)]*)$', 1)"
    return f"""n1 AS (SELECT {keep}, {steps} AS d1 FROM ({rows})),
    n2 AS (SELECT {keep}, CASE WHEN {q_plausible(w[0])} THEN {w[0]} WHEN {q_plausible(w[1])} THEN {w[1]} ELSE d1 END AS d2 FROM n1),
    n3 AS (SELECT {keep}, CASE WHEN {q_plausible(s)} THEN {s} ELSE d2 END AS d3 FROM n2),
    n4 AS (SELECT {keep}, d3, {run} AS tail, greatest(0, length(replace(d3, '(', '')) - length(replace(d3, ')', ''))) AS excess FROM n3),
    n5 AS (SELECT {keep}, d3, tail, string_split(tail, ')') AS parts, len(string_split(tail, ')')) - 1 - excess AS kept FROM n4),
    normal AS (SELECT {keep}, left(d3, length(d3) - length(tail)) || CASE WHEN kept <= 0 THEN '' ELSE array_to_string(parts[1:kept], ')') || ')' END AS doi FROM n5)"""


def q_group(x: str) -> str:
    return K.GROUP.format(x)


def q_weight(x: str) -> str:
    return K.WEIGHT.format(x)


def q_bad(x: str) -> str:
    return f"(length({q_norm(x)}) < 5 OR regexp_matches({q_clean(x)}, '{K.EMPTY_TITLE}') OR {q_norm(x)} IN {K.EMPTY_NORMAL})"


def q_local_bad(x: str) -> str:
    return f"({q_bad(x)} OR regexp_matches({q_clean(x)}, '{K.LOCAL_BAD}'))"


def q_hard_bad(x: str) -> str:
    return f"({q_bad(x)} OR length({q_norm(x)}) < 8 OR regexp_matches({q_clean(x)}, '{K.HARD_BAD}'))"


def q_authors(x: str) -> str:
    return f"list_filter(list_transform(string_split_regex({q_clean(x)}, ';|, and | and '), lambda s: trim(s)), lambda s: s <> '')"


def q_words(x: str) -> str:
    return f"list_filter(string_split({q_norm(x)}, ' '), lambda w: w <> '')"


def q_overlap(a: str, b: str) -> str:
    return f"len(list_intersect(list_distinct({q_words(a)}), list_distinct({q_words(b)}))) / greatest(len(list_distinct({q_words(a)})), 1)"


def q_containment(a: str, b: str) -> str:
    x, y = q_norm(a), q_norm(b)
    return f"CASE WHEN {x} <> '' AND {y} <> '' AND (contains({x}, {y}) OR contains({y}, {x})) THEN least(length({x}), length({y})) / greatest(length({x}), length({y})) ELSE 0 END"


QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# ---------------------------------------------------------------- identifiers
@query(f"WITH {q_normalize(f'SELECT doc_id, {RAW} AS raw FROM documents', 'doc_id')} SELECT doc_id, doi, {q_plausible('doi')} AS plausible FROM normal")
def doi_normalize(spark, d):
    doi = I.normalize(F.expr(RAW))
    return docs(spark, d, "doc_id", "source").select("doc_id", doi.alias("doi"), I.is_plausible(doi).alias("plausible"))


_SCAN_SQL = f"SELECT doc_id, regexp_extract_all(x, '{K.SCAN}', 1) AS ms FROM (SELECT doc_id, {TEXT} AS x FROM documents)"
_SCAN_ROWS = f"SELECT doc_id, unnest(ms) AS raw, unnest(range(1, len(ms) + 1)) - 1 AS ord FROM ({_SCAN_SQL})"


@query(f"WITH {q_normalize(_SCAN_ROWS, 'doc_id, ord')} SELECT doc_id, ord::BIGINT AS ord, doi FROM normal WHERE {q_plausible('doi')}")
def doi_scan(spark, d):
    hits = C.explode_hits(docs(spark, d, "doc_id", "text", "lang").select("doc_id", F.expr(TEXT).alias("x")), "doc_id", I.find(F.col("x"), F.lit("text")))
    return hits.select("doc_id", F.col("ord").cast("long").alias("ord"), "doi")


_PLACED = f"""SELECT doc_id, x, regexp_extract_all(x, '{K.SCAN}', 0) AS ms, list_transform(string_split_regex(x, '{K.SCAN}'), lambda g: length(g)) AS gs
FROM (SELECT doc_id, {TEXT} AS x FROM documents)"""


@query(f"""WITH p AS ({_PLACED}), k AS (SELECT doc_id, x, ms, gs, unnest(range(1, len(ms) + 1)) AS k FROM p),
h AS (SELECT doc_id, x, k, length(ms[k]) AS n, list_sum(gs[1:k]) + coalesce(list_sum(list_transform(ms[1:k - 1], lambda m: length(m))), 0) AS pos FROM k)
SELECT doc_id, k::BIGINT - 1 AS ord, trim(regexp_replace(substring(x, (greatest(0, pos - 80) + 1)::BIGINT, (pos + n + 80 - greatest(0, pos - 80))::BIGINT), '\\s+', ' ', 'g')) AS context FROM h""")
def doi_context(spark, d):
    hits = C.explode_hits(docs(spark, d, "doc_id", "text", "lang").select("doc_id", F.expr(TEXT).alias("x")), "doc_id", I.find(F.col("x"), F.lit("text")))
    return hits.select("doc_id", F.col("ord").cast("long").alias("ord"), "context")


_SPACED = f"({TEXT}) || ' 10 . 1021 / jp' || doc_id || ' . s001 and 10.1000/a' || chr(92) || chr(10) || ' b'"
_SPACED_ROWS = f"""SELECT doc_id, unnest(ms) AS raw, unnest(range(len(ms))) AS k FROM (
 SELECT doc_id, regexp_extract_all(x, '{K.SCAN}', 1) || regexp_extract_all(x, '{K.SCAN_SPACED}', 0) || regexp_extract_all(y, '{K.SCAN}', 1) || regexp_extract_all(y, '{K.SCAN_SPACED}', 0) AS ms
 FROM (SELECT doc_id, x, regexp_replace(x, '\\\\\\s+', '', 'g') AS y FROM (SELECT doc_id, {_SPACED} AS x FROM documents)))"""


@query(f"WITH {q_normalize(_SPACED_ROWS, 'doc_id, k')} SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS ord, doi FROM normal WHERE {q_plausible('doi')}")
def doi_scan_spaced(spark, d):
    x = F.concat(F.expr(TEXT), F.lit(" 10 . 1021 / jp"), F.col("doc_id"), F.lit(" . s001 and 10.1000/a\\\n b"))
    df = docs(spark, d, "doc_id", "text", "lang").select("doc_id", x.alias("x"))
    return C.explode_hits(df, "doc_id", I.find(F.col("x"), F.lit("text"), spaced=True)).select("doc_id", F.col("ord").cast("long").alias("ord"), "doi")


_PII = "regexp_replace(stem, '[^A-Za-z0-9]', '', 'g')"


def _pii(i: int) -> str:
    return f"regexp_extract(p, '(?i)^(?:101016)?S(\\d{{8}})(\\d{{2}})(\\d{{5}})([0-9X])', {i})"


@query(f"""SELECT doc_id, CASE WHEN {_pii(1)} <> '' THEN '10.1016/S' || left({_pii(1)}, 4) || '-' || right({_pii(1)}, 4) || '(' || {_pii(2)} || ')' || {_pii(3)} || '-' || upper({_pii(4)}) ELSE '' END AS pii,
CASE WHEN regexp_extract(stem, '(?i)(?:^|[^A-Za-z0-9])ssrn[-_]?(\\d{{5,10}})(?:[^0-9]|$)', 1) <> '' THEN '10.2139/ssrn.' || regexp_extract(stem, '(?i)(?:^|[^A-Za-z0-9])ssrn[-_]?(\\d{{5,10}})(?:[^0-9]|$)', 1) ELSE '' END AS ssrn
FROM (SELECT doc_id, stem, regexp_replace(regexp_replace(stem, '^1-s2.0-', ''), '[^A-Za-z0-9]', '', 'g') AS p FROM (SELECT doc_id, {STEM} AS stem FROM documents))""")
def filename_codes(spark, d):
    df = docs(spark, d, "doc_id", f"{STEM} AS stem")
    return df.select("doc_id", I.from_pii(F.regexp_replace("stem", r"^1-s2.0-", "")).alias("pii"), I.from_ssrn(F.col("stem")).alias("ssrn"))


@query(f"""WITH s AS (SELECT doc_id, {STEM} AS stem FROM documents),
x AS (SELECT doc_id, regexp_extract(stem, '^(10\\.\\d{{4,9}})_(.+)$', 1) AS p, regexp_extract(stem, '^(10\\.\\d{{4,9}})_(.+)$', 2) AS q FROM s),
{q_normalize("SELECT doc_id, p || '/' || q AS raw FROM x WHERE p <> '' AND NOT regexp_matches(q, '(?i)(?:^|[_.-])(si|supp|supporting)(?:[_.-]|[0-9]{1,4}$|$)')", "doc_id")}
SELECT doc_id, doi FROM normal WHERE {q_plausible('doi')}""")
def filename_doi(spark, d):
    hits = C.explode_hits(docs(spark, d, "doc_id", f"{STEM} AS stem"), "doc_id", I.scan_filename(F.col("stem")))
    return hits.filter("source = 'filename_doi'").select("doc_id", "doi")


@query(f"SELECT doc_id, k, s AS source, {q_group('s')} AS source_group, {q_weight('s')} AS weight FROM (SELECT doc_id, k, {SOURCE_SQL} AS s FROM documents, range(3) r(k))")
def source_weight(spark, d):
    df = docs(spark, d, "doc_id").select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k")).withColumn("k", F.col("k").cast("long")).withColumn("source", F.expr(SOURCE_SQL))
    return df.withColumn("source_group", I.source_group(F.col("source"))).withColumn("weight", I.source_weight(F.col("source")))


_CAND = f"SELECT doc_id, k AS ord, {SOURCE_SQL} AS source, CASE WHEN (doc_id + k) % 3 = 0 THEN '10.1000/A.' || doc_id ELSE '10.1000/' || CASE WHEN k % 2 = 0 THEN 'a.' ELSE 'b.' END || doc_id END AS doi"


def _candidates(spark, d):
    df = docs(spark, d, "doc_id").select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k"))
    return df.selectExpr("doc_id", "k", "k AS ord", f"{SOURCE_SQL} AS source", _CAND.split(" AS source, ")[1].removesuffix(" AS doi") + " AS doi")


_GIVEN = f"CASE source WHEN 'grobid_doi' THEN 'medium' WHEN 'crossref_title_search' THEN 'review' WHEN 'llm_candidate' THEN 'review' ELSE {q_weight('source')} END"
_CHOICE = f"""WITH c AS (SELECT *, {q_group('source')} AS grp, {_GIVEN} AS conf FROM ({_CAND} FROM documents, range(5) r(k))),
w AS (SELECT *, CASE conf WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END AS wt FROM c WHERE {q_plausible('doi')}),
g AS (SELECT doc_id, lower(doi) AS key,
 count(DISTINCT CASE WHEN grp <> 'filename' THEN grp END) AS ng, max(wt) AS mw, count(*) AS n, min(ord) AS o, arg_min(doi, ord) AS doi, arg_min(source, ord) AS source, arg_max(conf, wt * 1000 - ord) AS conf FROM w GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ng DESC, mw DESC, n DESC, o) AS rn FROM g),
b AS (SELECT doc_id, doi, CASE WHEN ng = 0 THEN 'review' WHEN ng >= 2 THEN 'high' ELSE conf END AS confidence,
 CASE WHEN ng = 0 THEN 'filename_only_candidate_requires_validation' WHEN ng >= 2 THEN 'multiple_independent_sources' ELSE 'selected_by_source_weight' END AS doi_decision, source AS doi_source FROM r WHERE rn = 1),
f AS (SELECT *, CASE WHEN confidence = 'review' THEN 'review' ELSE 'ok' END AS status FROM b)"""


@query(f"{_CHOICE} SELECT * FROM f")
def choose_candidate(spark, d):
    return C.chosen_for_all(docs(spark, d, "doc_id"), C.to_candidates(_candidates(spark, d), "doc_id"), "doc_id")


@query(f"{_CHOICE} SELECT status, confidence, count(*)::BIGINT AS n FROM f GROUP BY 1, 2")
def status_counts(spark, d):
    return choose_candidate(spark, d).groupBy("status", "confidence").agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, lower(doi) AS doi_key, source, min(ord)::BIGINT AS ord FROM ({_CAND} FROM documents, range(5) r(k)) GROUP BY 1, 2, 3")
def hit_dedup(spark, d):
    return C.unique_hits(_candidates(spark, d), "doc_id").select("doc_id", F.lower("doi").alias("doi_key"), "source", F.col("ord").cast("long").alias("ord"))


@query("""WITH d AS (SELECT doc_id, unnest(['10.1000/a.' || (doc_id % 50), '10.1000/a.' || (doc_id % 50) || '.s1', '10.1000/a.' || (doc_id % 50) || 'x', '10.1000/a.' || (doc_id % 50) || '/b/c', '10.1000/a.' || (doc_id % 50) || '/b']) AS doi FROM documents)
SELECT x.doc_id, x.doi FROM d x WHERE NOT EXISTS (SELECT 1 FROM d y WHERE y.doc_id = x.doc_id AND (starts_with(y.doi, x.doi || '.') OR starts_with(y.doi, x.doi || '/')))""")
def prefix_subsume(spark, d):
    base = F.concat(F.lit("10.1000/a."), (F.col("doc_id") % 50).cast("string"))
    df = docs(spark, d, "doc_id").select("doc_id", F.explode(F.array(base, *[F.concat(base, F.lit(x)) for x in (".s1", "x", "/b/c", "/b")])).alias("doi"))
    return C.longest_only(df, "doc_id")


# ---------------------------------------------------------------- text
_LINES = f"string_split(regexp_replace({MARKDOWN}, '\\r\\n|[\\r\\x0B\\x0C\\x1C-\\x1E\\x{{0085}}\\x{{2028}}\\x{{2029}}]', chr(10), 'g'), chr(10))"


@query(f"""WITH l AS (SELECT doc_id, {_LINES} AS x FROM documents), m AS (SELECT doc_id, CASE WHEN x[-1] = '' THEN x[1:len(x) - 1] ELSE x END AS x FROM l),
r AS (SELECT doc_id, x, coalesce(list_position(list_transform(x, lambda s: regexp_matches(trim(s), '(?i)^#*\\s*(references|bibliography)\\s*$')), true) - 1, len(x)) AS e FROM m)
SELECT doc_id, array_to_string(x[1:least(150, e)], chr(10)) AS front, CASE WHEN e > 150 THEN array_to_string(x[151:e], chr(10)) ELSE '' END AS body, array_to_string(x[e + 1:], chr(10)) AS refs FROM r""")
def markdown_sections(spark, d):
    s = docs(spark, d, "doc_id", f"{MARKDOWN} AS x").select("doc_id", T.sections(F.col("x")).alias("s"))
    return s.select("doc_id", "s.front", "s.body", F.col("s.references").alias("refs"))


@query(f"SELECT doc_id, {q_norm(TITLE)} AS normal FROM documents")
def norm_text(spark, d):
    return docs(spark, d, "doc_id", f"{TITLE} AS x").select("doc_id", T.norm_text(F.col("x")).alias("normal"))


@query(f"SELECT doc_id, {q_bad('x')} AS bad, {q_local_bad('x')} AS bad_local, {q_hard_bad('x')} AS bad_hard FROM (SELECT doc_id, {TITLE} AS x FROM documents)")
def bad_title(spark, d):
    x = F.col("x")
    return docs(spark, d, "doc_id", f"{TITLE} AS x").select("doc_id", T.is_bad_title(x).alias("bad"), T.local_title_is_bad(x).alias("bad_local"), T.title_is_bad(x).alias("bad_hard"))


_LONG = f"list_filter({q_words('x')}, lambda w: length(w) >= 3)"
_SOME = f"{q_clean('x')} <> '' AND length({q_clean('x')}) <= 280 AND length({q_norm('x')}) >= 18 AND len({_LONG}) >= 4"
_OWN_WORDS = f"len(list_filter({_LONG}, lambda w: w NOT IN {K.DOMAIN_WORDS})) >= 2"


@query(f"""SELECT doc_id, {_SOME} AND {_OWN_WORDS} AND NOT regexp_matches({q_clean('x')}, '{K.LAYOUT_BAD}') AS useful, {_SOME} AND NOT regexp_matches({q_clean('x')}, '{K.OCR_BAD}') AS useful_ocr,
 NOT {q_hard_bad('x')} AND length({q_norm('x')}) >= 18 AS searchable FROM (SELECT doc_id, {SEARCH_TITLE} AS x FROM documents)""")
def useful_title(spark, d):
    x = F.col("x")
    checks = {"useful": T.useful_title(x), "useful_ocr": T.useful_title(x, domain=False), "searchable": T.searchable_title(x)}
    return docs(spark, d, "doc_id", f"{SEARCH_TITLE} AS x").select("doc_id", *[v.alias(k) for k, v in checks.items()])


_SUPPLEMENT = "'10.1000/' || CASE doc_id % 8 WHEN 0 THEN 'a.s' || (100 + doc_id % 900) WHEN 1 THEN 'x/fig-' || doc_id WHEN 2 THEN 'x/figabc' || doc_id WHEN 3 THEN 'dryad.' || doc_id WHEN 4 THEN 'a/figure' || doc_id WHEN 5 THEN 'suppl' || doc_id ELSE 'y' || doc_id END"
_WORK = "CASE doc_id % 5 WHEN 0 THEN 'On the dataset of ' || source WHEN 1 THEN 'Data from: ' || source WHEN 2 THEN 'See figure 12 of ' || source WHEN 3 THEN 'Datasets of ' || source ELSE 'A title' END"
_KIND = "CASE doc_id % 3 WHEN 0 THEN 'posted-content' WHEN 1 THEN 'Dataset' ELSE 'journal-article' END"


@query(f"""SELECT doc_id, regexp_matches(d, '{K.SUSPICIOUS}') AS by_doi, regexp_matches(d, '{K.SUSPICIOUS}') OR regexp_matches(t, '{K.SUSPICIOUS_TITLE}') OR k IN ('posted-content', 'Dataset') AS by_any
FROM (SELECT doc_id, {_SUPPLEMENT} AS d, {_WORK} AS t, {_KIND} AS k FROM documents)""")
def suspicious_candidate(spark, d):
    df = docs(spark, d, "doc_id", f"{_SUPPLEMENT} AS d", f"{_WORK} AS t", f"{_KIND} AS k")
    return df.select("doc_id", I.suspicious(F.col("d")).alias("by_doi"), I.suspicious(F.col("d"), F.col("t"), F.col("k")).alias("by_any"))


@query(f"SELECT doc_id, len({q_authors(PEOPLE)})::BIGINT AS n, array_to_string({q_authors(PEOPLE)}, '|') AS names FROM documents")
def parse_authors(spark, d):
    a = T.parse_authors(F.expr(PEOPLE))
    return docs(spark, d, "doc_id", "source", "lang").select("doc_id", F.size(a).cast("long").alias("n"), F.array_join(a, "|").alias("names"))


_KEYS = lambda a: f"list_transform({a}, lambda p: list_filter(string_split({q_norm('p')}, ' '), lambda w: length(w) >= 2))"


@query(f"""WITH k AS (SELECT doc_id, list_transform({_KEYS(q_authors(PEOPLE))}, lambda w: CASE WHEN len(w) > 0 THEN [array_to_string(w, ''), w[-1]] ELSE [] END) AS q,
 flatten(list_transform({_KEYS(q_authors(WORK_PEOPLE))}, lambda w: CASE WHEN len(w) > 0 THEN [array_to_string(w, ''), w[-1]] ELSE [] END)) AS ws FROM documents)
SELECT doc_id, CASE WHEN len(q) > 0 AND len(ws) > 0 THEN round(len(list_filter(q, lambda ks: len(list_filter(ks, lambda x: len(list_filter(ws, lambda y: contains(y, x) OR contains(x, y))) > 0)) > 0)) / len(q), 4) ELSE 0 END AS score FROM k""")
def author_score(spark, d):
    df = docs(spark, d, "doc_id", f"{PEOPLE} AS p", f"{WORK_PEOPLE} AS w")
    return df.select("doc_id", F.round(S.author_score(T.parse_authors(F.col("p")), T.parse_authors(F.col("w"))), 4).alias("score"))


@query(f"SELECT doc_id, round({q_overlap('x', 'y')}, 4) AS overlap, round({q_containment('x', 'y')}, 4) AS containment FROM (SELECT doc_id, {SHORT_A} AS x, {SHORT_B} AS y FROM documents)")
def title_overlap(spark, d):
    x, y = F.col("x"), F.col("y")
    return docs(spark, d, "doc_id", f"{SHORT_A} AS x", f"{SHORT_B} AS y").select("doc_id", F.round(S.token_overlap(x, y), 4).alias("overlap"),
        F.round(S.containment(x, y), 4).cast("double").alias("containment"))


_TELLING = f"list_filter({q_words('t')}, lambda w: length(w) >= 4 AND w NOT IN {K.COVERAGE_WORDS})"


@query(f"""WITH x AS (SELECT doc_id, {SHORT_A} AS t, {q_norm("coalesce(text, '') || ' ' || " + SHORT_B)} AS n FROM documents)
SELECT doc_id, round(CASE WHEN {q_norm('t')} = '' OR n = '' THEN 0 WHEN contains(n, {q_norm('t')}) THEN 1 WHEN len({_TELLING}) > 0 THEN len(list_filter({_TELLING}, lambda w: contains(n, w))) / len({_TELLING}) ELSE 0 END, 4) AS coverage FROM x""")
def title_coverage(spark, d):
    df = docs(spark, d, "doc_id", f"{SHORT_A} AS t", f"coalesce(text, '') || ' ' || {SHORT_B} AS x")
    return df.select("doc_id", F.round(S.title_coverage(F.col("t"), F.col("x")), 4).cast("double").alias("coverage"))


def q_pairs(rows: str, a: str, b: str) -> str:
    """CTEs pairs and ratios over the normal forms of two titles of ``rows``."""
    return f"pairs AS (SELECT DISTINCT {q_norm(a)} AS a, {q_norm(b)} AS b FROM {rows} WHERE {a} IS NOT NULL AND {b} IS NOT NULL), {K.RATIOS}"


def q_score(a: str, b: str) -> str:
    """The score of two titles, where ``ratio`` is joined from ratios."""
    bad = f"{b} IS NULL OR {q_bad(a)} OR {q_bad(b)}"
    return f"CASE WHEN {bad} THEN 0.0 WHEN {q_norm(a)} = {q_norm(b)} THEN 1.0 ELSE greatest(0.94 * ({q_overlap(a, b)}), {q_containment(a, b)}, ratio) END"


@query(f"""WITH RECURSIVE x AS (SELECT doc_id, {SHORT_A} AS t, {SHORT_B} AS u FROM documents), {q_pairs('x', 't', 'u')}
SELECT doc_id, round({q_score('t', 'u')}, 4)::DOUBLE AS score FROM x JOIN ratios ON ratios.a = {q_norm('t')} AND ratios.b = {q_norm('u')}""")
def title_score(spark, d):
    df = docs(spark, d, "doc_id", f"{SHORT_A} AS x", f"{SHORT_B} AS y")
    return S.with_title_score(df, "score", F.col("x"), F.col("y")).select("doc_id", F.round("score", 4).alias("score"))


@query("SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title, regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM pages")
def page_title(spark, d):
    df = spark.read.parquet(f"{d}/pages.parquet")
    return df.select("page_id", F.trim(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1)).alias("title"), F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host"))


@query("""SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN '' ELSE 'Work ' || doc_id END AS title, CASE WHEN doc_id % 10 = 0 THEN '' ELSE '10.1000/' || lpad((doc_id % 100000)::VARCHAR, 5, '0') END AS doi,
 '' AS date, '' AS year, '' AS journal, '' AS publisher, CASE WHEN doc_id % 10 = 0 THEN '' ELSE 'A ' || source END AS authors, '' AS abstract FROM documents""")
def tei_header(spark, d):
    head = "'<TEI xmlns=\"http://www.tei-c.org/ns/1.0\"><teiHeader><titleStmt><title>Work ' || doc_id || '</title></titleStmt><sourceDesc><analytic><author><persName>'"
    people = "'<forename>A</forename><surname>' || source || '</surname></persName></author></analytic>'"
    code = f"'<idno type=\"DOI\">10.1000/' || {PAD} || '</idno></sourceDesc></teiHeader></TEI' || CASE WHEN doc_id % 10 = 0 THEN '' ELSE '>' END"
    xml = F.expr(f"{head} || {people} || {code}")
    return docs(spark, d, "doc_id", "source").select("doc_id", files.tei_header(xml).alias("h")).select("doc_id", "h.*")


@query()
def front_title_authors(spark, d):
    return docs(spark, d, "doc_id", "text").select("doc_id", front_page.title_authors(F.col("text")).alias("f")).select("doc_id", "f.title", F.array_join("f.authors", "; ").alias("authors"))


@query(f"SELECT doc_id, regexp_replace(regexp_replace(lower(source || ' ' || lang || '-' || doc_id), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS packed, regexp_matches({TITLE}, '[\\x{{4E00}}-\\x{{9FFF}}]') AS cjk FROM documents")
def name_checks(spark, d):
    return docs(spark, d, "doc_id", "source || ' ' || lang || '-' || doc_id AS x", f"{TITLE} AS t").select("doc_id", T.compact(F.col("x")).alias("packed"), T.has_cjk(F.col("t")).alias("cjk"))


# ---------------------------------------------------------------- joins with side tables and authorities
_SIDE = "SELECT source || '.pdf' AS name_key, CASE WHEN n % 3 = 0 THEN '' ELSE 'Side title of ' || source END AS title, 'X ' || source || '; Y' AS authors, '2020' AS year FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)"


@query(f"""WITH s AS ({_SIDE}), r AS (SELECT doc_id, source || '.pdf' AS name_key, {TITLE} AS title, doc_id % 2 = 0 AS own, CASE WHEN doc_id % 5 = 0 THEN '1999' ELSE '' END AS year FROM documents),
j AS (SELECT r.*, s.title AS st, s.authors AS sa, s.year AS sy, (coalesce(s.title, '') <> '' AND {q_bad('r.title')}) AS nt FROM r LEFT JOIN s ON r.name_key = s.name_key)
SELECT doc_id, CASE WHEN nt THEN st ELSE title END AS title, CASE WHEN own THEN 'Own' ELSE replace(sa, '; ', '|') END AS authors, CASE WHEN year = '' THEN sy ELSE year END AS year,
CASE WHEN nt THEN 'grobid' WHEN title <> '' THEN 'pdf' ELSE '' END AS title_source, CASE WHEN NOT own THEN 'grobid' ELSE 'pdf' END AS authors_source, CASE WHEN nt OR NOT own OR year = '' THEN 'grobid' ELSE '' END AS metadata_source FROM j""")
def sidecar_merge(spark, d):
    side = docs(spark, d, "source").groupBy("source").agg(F.count("*").alias("n")).selectExpr("source || '.pdf' AS name_key",
        "CASE WHEN n % 3 = 0 THEN '' ELSE 'Side title of ' || source END AS title", "'X ' || source || '; Y' AS authors", "'2020' AS year", "'' AS journal",
        "'' AS publisher", "'' AS abstract")
    rec = docs(spark, d, "doc_id", "source || '.pdf' AS name_key", f"{TITLE} AS title",
        "CASE WHEN doc_id % 2 = 0 THEN array('Own') ELSE cast(array() as array<string>) END AS authors", "CASE WHEN doc_id % 5 = 0 THEN '1999' ELSE '' END AS year")
    return P.with_side_metadata(rec, side).select("doc_id", "title", F.array_join("authors", "|").alias("authors"), "year", "title_source", "authors_source", "metadata_source")


@query(f"""WITH x AS (SELECT doc_id, {JSON} AS j FROM documents), m AS (SELECT doc_id, json_extract(j, '$.message') AS m FROM x)
SELECT doc_id, json_extract_string(m, '$.DOI') AS authority_doi, json_extract_string(m, '$.title[1]') AS title,
 'A ' || json_extract_string(m, '$.author[0].family') || '; ' || json_extract_string(m, '$.author[1].family') AS authors,
 json_extract_string(m, '$."container-title"[0]') AS container, json_extract_string(m, '$.publisher') AS publisher, 
 json_extract_string(m, '$.issued."date-parts"[0][0]') AS year, json_extract_string(m, '$.type') AS type FROM m""")
def authority_json(spark, d):
    df = docs(spark, d, "doc_id", f"{JSON} AS j").select("doc_id", A.parsed("crossref", F.col("j")).alias("a")).select("doc_id", "a.*")
    return df.withColumn("authors", F.array_join("authors", "; "))


_KEY = "'10.' || CASE WHEN doc_id % 4 = 0 THEN '2172' ELSE '1000' END || '/X' || (doc_id % 200)"
_ANSWERS = f"""SELECT lower({_KEY}) AS doi_key, src AS source, p, (doc_id + p) % 3 <> 0 AND (doc_id + p) % 5 <> 0 AS good, 'T' || doc_id || src AS title
FROM documents, (VALUES (0, 'osti'), (1, 'doi.org'), (2, 'crossref'), (3, 'datacite')) v(p, src) WHERE src <> 'osti' OR doc_id % 4 = 0"""


@query(f"""WITH a AS ({_ANSWERS}), n AS (SELECT doi_key, count(*) AS tried FROM a GROUP BY 1),
b AS (SELECT doi_key, source, title, row_number() OVER (PARTITION BY doi_key ORDER BY p, title) AS rn FROM a WHERE good)
SELECT q.doc_id, q.doi, coalesce(n.tried, 0)::BIGINT AS tried, b.source AS authority_source, b.title AS authority_title
FROM (SELECT doc_id, {_KEY} AS doi FROM documents) q LEFT JOIN n ON lower(q.doi) = n.doi_key LEFT JOIN b ON lower(q.doi) = b.doi_key AND b.rn = 1""")
def authority_priority(spark, d):
    """Every document asks for a key that many documents answer, from four sources each."""
    src = F.explode(F.array(*[F.struct(F.lit(i).alias("p"), F.lit(s).alias("source")) for i, s in enumerate(("osti", "doi.org", "crossref", "datacite"))]))
    each = docs(spark, d, "doc_id", f"lower({_KEY}) AS doi_key").select("doc_id", "doi_key", src.alias("v"))
    ans = each.selectExpr("doi_key", "v.source AS source", "(doc_id + v.p) % 3 <> 0 AS resolved", "CASE WHEN (doc_id + v.p) % 5 = 0 THEN '' ELSE 'T' || doc_id || v.source END AS title")
    return A.resolve(docs(spark, d, "doc_id", f"{_KEY} AS doi"), ans, "doc_id").select("doc_id", "doi", "tried", "authority_source", "authority_title")


@query("SELECT user_id AS key, max(ts) AS ts, arg_max(event_type, struct_pack(ts := ts, e := event_type, i := event_id)) AS event_type FROM events GROUP BY 1")
def cache_latest(spark, d):
    ev = spark.read.parquet(f"{d}/events.parquet").selectExpr("user_id AS key", "ts", "event_type", "event_id")
    return A.latest(ev, ["key"], "ts").select("key", "ts", "event_type")


@query("SELECT DISTINCT o_custkey AS key FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'click' AND user_id IS NOT NULL)")
def cache_misses(spark, d):
    wanted = spark.read.parquet(f"{d}/orders.parquet").selectExpr("o_custkey AS key")
    return A.misses(wanted, spark.read.parquet(f"{d}/events.parquet").filter("event_type = 'click'").selectExpr("user_id AS key"), "key")


_JOBS = "doc_id AS ord, CASE WHEN doc_id % 2 = 0 THEN '10.1000/A' ELSE '10.1000/a' END || (doc_id % 40) AS doi, doc_id % 7 = 0 AS force"


@query(f"SELECT lower(doi) AS doi_key, arg_min(doi, ord) AS doi, bool_or(force) AS force FROM (SELECT {_JOBS} FROM documents) GROUP BY 1")
def job_dedup(spark, d):
    return A.jobs(docs(spark, d, "doc_id AS ord", "CASE WHEN doc_id % 2 = 0 THEN '10.1000/A' ELSE '10.1000/a' END || (doc_id % 40) AS doi", "doc_id % 7 = 0 AS force"))


_VERIFY = f"""SELECT r.*, CASE WHEN NOT gone THEN wt END AS wt FROM (SELECT doc_id, source, {SHORT_A} AS t, doc_id % 4 = 0 AS noa, doc_id % 11 = 0 AS gone FROM documents) r
 JOIN (SELECT DISTINCT source, 'Growth of ' || source || ' films in en oxide layers number 3' AS wt FROM documents) w ON r.source = w.source"""
_PASSES = "wt IS NOT NULL AND ts >= 0.94 AND (aus >= 0.15 OR (ts >= 0.985 AND noa))"


@query(f"""WITH RECURSIVE j AS ({_VERIFY}), {q_pairs('j', 't', 'wt')},
s AS (SELECT j.*, {q_score('t', 'wt')} AS ts, CASE WHEN wt IS NULL OR noa THEN 0.0 ELSE 1.0 END AS aus FROM j LEFT JOIN ratios ON ratios.a = {q_norm('t')} AND ratios.b = {q_norm('wt')})
SELECT doc_id, {_PASSES} AS verified, CASE WHEN wt IS NULL THEN 'crossref_not_found' WHEN {_PASSES} THEN 'verified' ELSE 'score_below_threshold' END AS reason,
 round(ts, 4)::DOUBLE AS title_score, round(aus, 4)::DOUBLE AS author_score FROM s""")
def verify(spark, d):
    none = "cast(array() as array<string>)"
    rec = docs(spark, d, "doc_id", "'10.1000/' || CASE WHEN doc_id % 11 = 0 THEN 'gone.' ELSE 'x.' END || source AS doi", f"{SHORT_A} AS title",
        f"CASE WHEN doc_id % 4 = 0 THEN {none} ELSE array('Ana ' || source) END AS authors")
    title = "'Growth of ' || source || ' films in en oxide layers number 3' AS work_title"
    works = docs(spark, d, "source").distinct().selectExpr("'10.1000/x.' || source AS doi_key", title, "array('A. ' || source) AS work_authors")
    return A.verify(rec, works).select("doc_id", "verified", "reason", "title_score", "author_score")


# ---------------------------------------------------------------- decisions
def _decision(table: str):
    def run(spark, d):
        return docs(spark, d, *_split(FACTS)).select("doc_id", D.decide(table).alias("d")).select("doc_id", "d.*")

    run.__name__ = f"decide_{table}"
    query(f"SELECT doc_id, {K.decided('said')} FROM (SELECT doc_id, {K.DECISIONS[table]} AS said FROM (SELECT {FACTS} FROM documents))")(run)


def _split(columns: str) -> list[str]:
    out, depth, now = [], 0, ""
    for c in columns:
        depth += (c == "(") - (c == ")")
        if c == "," and not depth:
            out.append(now.strip())
            now = ""
        else:
            now += c
    return [*out, now.strip()]


for _t in D.TABLES:
    _decision(_t)


@query(f"""WITH x AS (SELECT doc_id % 100 AS path, doc_id AS ord, {FACTS.replace('doc_id, ', '', 1)}, 8 + doc_id % 9 AS doi_length FROM documents),
 y AS (SELECT *, t >= 0.5 AS accepted, CASE WHEN t >= 0.8 THEN 'high' WHEN t >= 0.5 THEN 'medium' ELSE 'none' END AS confidence FROM x),
r AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY accepted DESC, CASE confidence WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 0 END DESC, t DESC, a DESC, c DESC, doi_length DESC, ord) AS n FROM y)
SELECT path, ord, confidence FROM r WHERE n = 1""")
def best_result(spark, d):
    df = docs(spark, d, "doc_id % 100 AS path", "doc_id AS ord", *_split(FACTS)[1:4], "8 + doc_id % 9 AS doi_length").selectExpr("*", "t >= 0.5 AS accepted",
        "CASE WHEN t >= 0.8 THEN 'high' WHEN t >= 0.5 THEN 'medium' ELSE 'none' END AS confidence")
    return df.groupBy("path").agg(F.max_by(F.struct("ord", "confidence"), D.best_by("ocr")).alias("b")).select("path", "b.*")


_ACT = "doc_id, doc_id % 9 = 0 AS has_candidate, (doc_id * 97) % 2000 AS text_chars, lower(CASE doc_id % 5 WHEN 0 THEN 'PhD Thesis ' WHEN 1 THEN 'book chapter ' ELSE 'report ' END || source) AS text, doc_id % 7 = 0 AS cjk, CASE WHEN doc_id % 4 = 0 THEN 'no_doi_unresolved' ELSE 'review' END AS final_decision"


@query(f"SELECT doc_id, {K.ACTION} AS action FROM (SELECT {_ACT} FROM documents)")
def suggested_action(spark, d):
    return docs(spark, d, *_split(_ACT)).select("doc_id", D.action().alias("action"))


@query(f"""WITH f AS ({_CHOICE} SELECT * FROM f) SELECT metric, value, count(*)::BIGINT AS n FROM (
SELECT 'total' AS metric, '' AS value FROM f UNION ALL SELECT 'status', status FROM f UNION ALL SELECT 'confidence', confidence FROM f UNION ALL SELECT 'doi_decision', doi_decision FROM f) GROUP BY 1, 2""")
def summary_grouping_sets(spark, d):
    return P.summary(choose_candidate(spark, d), ["status", "confidence", "doi_decision"])


# ---------------------------------------------------------------- variants
_TOK = f"CASE doc_id % 6 WHEN 0 THEN '10.1149_1945-7111_ac' || doc_id WHEN 1 THEN '10.5445_ir_' || doc_id WHEN 2 THEN '10.1021_acs.' || doc_id || '.s001' WHEN 3 THEN '10.1039_c_' || {PAD} WHEN 4 THEN '10.1000_a@b_' || doc_id ELSE '10.1007-s' || {PAD} END"


@query(f"""WITH t AS (SELECT doc_id, replace({_TOK}, '@', '_') AS x FROM documents), s AS (SELECT doc_id, regexp_extract(x, '^(10\\.\\d{{4,9}})[_-](.+)$', 1) AS p, regexp_extract(x, '^(10\\.\\d{{4,9}})[_-](.+)$', 2) AS q FROM t),
v AS (SELECT doc_id, 0 AS k, p || '/' || q AS doi FROM s
 UNION ALL SELECT doc_id, 1, p || '/' || upper(replace(q, '_', '/')) FROM s WHERE p IN {K.REPOSITORY_PREFIXES} AND contains(q, '_')
 UNION ALL SELECT doc_id, 2, p || '/' || regexp_replace(q, '_', '/') FROM s WHERE contains(q, '_')
 UNION ALL SELECT doc_id, 3, p || '/' || replace(q, '_', '/') FROM s WHERE contains(q, '_')
 UNION ALL SELECT doc_id, 4, p || '/' || regexp_replace(q, '(?i)\\.s\\d{{3,4}}$', '') FROM s WHERE p = '10.1021' AND regexp_matches(q, '(?i)\\.s\\d{{3,4}}$')
 UNION ALL SELECT doc_id, 5, p || '/' || replace(q, '_', '') FROM s WHERE p = '10.1039')
SELECT doc_id, arg_min(doi, k) AS doi FROM v WHERE {q_plausible('doi')} GROUP BY doc_id, lower(doi)""")
def variants_filename(spark, d):
    return docs(spark, d, "doc_id", f"{_TOK} AS x").select("doc_id", F.explode(I.token_variants(F.col("x"))).alias("v")).select("doc_id", "v.doi")


_ECS = "'10.1149/' || CASE doc_id % 3 WHEN 0 THEN 'ma2013-0' || (1 + doc_id % 2) || '_4_' || doc_id WHEN 1 THEN '1945-7111_ac' || doc_id ELSE '2.' || doc_id || 'jes' END"


@query(f"SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN '' ELSE '10.1149/' || regexp_replace(replace(substring(x, 9), '_', '/'), '^ma', 'MA') END AS doi FROM (SELECT doc_id, {_ECS} AS x FROM documents)")
def variants_ecs(spark, d):
    return docs(spark, d, "doc_id", f"{_ECS} AS x").select("doc_id", I.ecs_variant(F.col("x")).alias("doi"))


_PRE = f"""CASE doc_id % 9 WHEN 0 THEN '10.1049/ic_' || doc_id WHEN 1 THEN '10.1023/a_' || doc_id || '_5' WHEN 2 THEN '10.4233/uuid_ab-' || doc_id || '_c' WHEN 3 THEN '10.1088/0022_' || doc_id || '_7'
 WHEN 4 THEN '10.1117/12.' || (700000 + doc_id) || '.x' WHEN 5 THEN '10.1049/ic_2010_' || {PAD} WHEN 6 THEN '10.1049/icp_2010_' || {PAD} WHEN 7 THEN '10.1117/12.' || (700000 + doc_id) ELSE '10.1209/Ab_c_' || doc_id END"""


@query(f"""SELECT doc_id, unnest(CASE doc_id % 9 WHEN 0 THEN ['10.1049/ic:' || doc_id, '10.1049/cp:' || doc_id] WHEN 1 THEN ['10.1023/A:' || doc_id || '_5'] WHEN 2 THEN ['10.4233/uuid:ab-' || doc_id || '_c']
 WHEN 3 THEN ['10.1088/0022/' || doc_id || '/7'] WHEN 4 THEN ['10.1117/12.' || (700000 + doc_id)] WHEN 5 THEN ['10.1049/ic:2010_' || {PAD}, '10.1049/cp:2010_' || {PAD}] WHEN 6 THEN ['10.1049/icp:2010_' || {PAD}]
 WHEN 7 THEN [] ELSE ['10.1209/Ab/c/' || doc_id] END) AS doi FROM documents""")
def variants_prefix(spark, d):
    return docs(spark, d, "doc_id", f"{_PRE} AS x").select("doc_id", F.explode(I.prefix_variants(F.col("x"))).alias("v")).select("doc_id", "v.doi")


# ---------------------------------------------------------------- whole passes
# What the names, texts and reference lists above hold, in order; the text's own identifier has the greatest weight.
_OWN = "'10.' || (1000 + doc_id % 7) || '/j.' || lang || '.' || doc_id"
_FOUND = f"""list_filter([
 CASE doc_id % 6 WHEN 0 THEN '10.1016/j.' || source || '.' || doc_id || ' filename_doi filename review' WHEN 2 THEN '10.2139/ssrn.' || (10000 + doc_id) || ' filename_ssrn filename review'
  WHEN 3 THEN '10.1149/1945-7111_ac' || doc_id || ' filename_doi filename review' END,
 {_OWN} || ' raw_pdf_bytes pdf_internal medium',
 CASE doc_id % 3 WHEN 0 THEN '10.1021/acs.' || doc_id || ' raw_pdf_bytes pdf_internal medium' WHEN 1 THEN '10.1002/anie.2019' || {PAD} || ' raw_pdf_bytes pdf_internal medium' END,
 '10.1000/ref.' || doc_id || ' markdown_references markdown review'], lambda c: c IS NOT NULL)"""


@query(f"""SELECT doc_id, {_OWN} AS doi, 'medium' AS confidence, 'selected_by_source_weight' AS doi_decision, 'raw_pdf_bytes' AS doi_source, 'ok' AS status,
 array_to_string({_FOUND}, '; ') AS doi_candidates FROM documents""")
def identify_records(spark, d):
    df = docs(spark, d, "doc_id", "text", "lang", "source")
    df = df.select("doc_id", F.expr(TEXT).alias("x"), F.expr(STEM).alias("stem"), F.expr(MARKDOWN).alias("md"))
    hits = F.concat(I.scan_filename(F.col("stem")), files.raw_hits(F.col("x")), files.section_hits(F.col("md")))
    listed = F.transform("doi_candidates", lambda c: F.concat_ws(" ", c["doi"], c["source"], c["source_group"], c["raw_confidence"]))
    return P.identify(df, hits, "doc_id").withColumn("doi_candidates", F.array_join(listed, "; "))


# A record of each document: two of three have an identifier with a slash too few, which another spelling mends.
RECORD = f"""SELECT doc_id::VARCHAR AS path, doc_id, lang, source, CASE WHEN doc_id % 3 = 0 THEN '10.1149/ma2013-01_4_' || doc_id ELSE '10.1000/x' || doc_id END AS doi, doc_id % 5 = 0 AS ok,
 {SHORT_A} AS title, 'Ana ' || source AS author, cast({SCORES} as double) AS old_t, cast({SCORES_A} as double) AS old_a, coalesce(text, '') AS text FROM documents"""
# Answers: of doi.org with an error or a result, of crossref a result with another title; keys of the mended spelling.
ANSWER_KEY = "CASE WHEN doc_id % 3 = 0 THEN '10.1149/ma2013-01/4/' || doc_id ELSE '10.1000/x' || doc_id END"
ANSWER_DOI = "CASE WHEN doc_id % 3 = 0 THEN '10.1149/MA2013-01/4/' || doc_id ELSE '10.1000/X' || doc_id END"


def _records(spark, d):
    return docs(spark, d, "doc_id", "text", "lang", "source").selectExpr(
        "cast(doc_id as string) AS path", "'10.1149_ma2013-01_4_' || doc_id || '.pdf' AS filename",
        "CASE WHEN doc_id % 3 = 0 THEN '10.1149/ma2013-01_4_' || doc_id ELSE '10.1000/x' || doc_id END AS doi",
        "CASE WHEN doc_id % 5 = 0 THEN 'ok' ELSE 'review' END AS status", f"{SHORT_A} AS title", "array('Ana ' || source) AS authors", "array('filename_doi') AS sources",
        f"cast({SCORES} as double) AS old_t", f"cast({SCORES_A} as double) AS old_a", "coalesce(text, '') AS text",
    )


def _answers(spark, d):
    """Two answers for a key: the better source fails for every seventh."""
    two = docs(spark, d, "doc_id", "lang", "source").withColumn("src", F.explode(F.array(F.lit("doi.org"), F.lit("crossref"))))
    title = f"CASE WHEN src = 'doi.org' THEN {SHORT_B} ELSE 'Other ' || {SHORT_B} END AS title"
    resolved = "CASE WHEN src = 'doi.org' THEN doc_id % 7 <> 0 ELSE doc_id % 4 <> 0 END"
    error = f"CASE WHEN {resolved} THEN '' ELSE 'timeout' END AS error"
    return two.selectExpr(f"{ANSWER_KEY} AS doi_key", "src AS source", f"{resolved} AS resolved", f"{ANSWER_DOI} AS doi", title, "array('A. ' || source) AS authors", error)


_BEST = f"""SELECT doc_id, {ANSWER_KEY} AS key, {ANSWER_DOI} AS adoi, doc_id % 7 <> 0 OR doc_id % 4 <> 0 AS res, CASE WHEN doc_id % 7 <> 0 THEN {SHORT_B} ELSE 'Other ' || ({SHORT_B}) END AS atitle FROM documents"""
_IN_NAME = "doc_id % 3 = 0"
# a record's author is the answer's by his last name
_REVIEW = f"""WITH RECURSIVE r AS (SELECT * FROM ({RECORD}) WHERE NOT ok), b AS ({_BEST}),
two AS (SELECT *, {K.STAGE2} AS said2 FROM (SELECT r.*, old_t AS t, old_a AS a, {_IN_NAME} AS ff, false AS no_authors FROM (SELECT doc_id, old_t, old_a FROM r) r), (SELECT true AS doi)),
x AS (SELECT r.*, said2, doc_id % 3 <> 0 AS direct FROM r JOIN (SELECT doc_id, said2 FROM two) USING (doc_id)),
j AS (SELECT x.*, b.adoi, b.res, b.atitle FROM x JOIN b USING (doc_id)), {q_pairs('j', 'title', 'atitle')},
s AS (SELECT j.*, {q_score('title', 'atitle')} AS score FROM j JOIN ratios ON ratios.a = {q_norm('title')} AND ratios.b = {q_norm('atitle')}),
three AS (SELECT *, {K.STAGE3} AS said3 FROM (SELECT doc_id, CASE WHEN direct THEN score ELSE 0.0 END AS t, CASE WHEN direct THEN 1.0 ELSE 0.0 END AS a, direct AND res AS res, {_IN_NAME} AS ff,
 false AS no_authors, false AS bad_title, true AS doi, doc_id % 3 = 0 AS mainstream FROM s)),
four AS (SELECT *, {K.STAGE4} AS said4 FROM (SELECT doc_id, CASE WHEN NOT direct AND res THEN score ELSE 0.0 END AS t, CASE WHEN NOT direct AND res THEN 1.0 ELSE 0.0 END AS a, NOT direct AND res AS res,
 {_IN_NAME} AS ff, false AS no_authors FROM s)),
f AS (SELECT s.*, said3, said4, three.t AS t3, three.a AS a3, four.t AS t4, four.a AS a4, starts_with(said2, 'yes') AS done2,
 regexp_matches(said3, 'stage3_(unresolved_not_resolved|conflict_review)') AS again FROM s JOIN three USING (doc_id) JOIN four USING (doc_id)),
z AS (SELECT path, doi, adoi, CASE WHEN done2 THEN 'stage2' WHEN again THEN 'stage4' ELSE 'stage3' END AS stage, CASE WHEN done2 THEN said2 WHEN again THEN said4 ELSE said3 END AS said,
 CASE WHEN done2 THEN old_t WHEN again THEN t4 ELSE t3 END AS t, CASE WHEN done2 THEN old_a WHEN again THEN a4 ELSE a3 END AS a FROM f)
SELECT path, stage, {K.decided('said')}, CASE WHEN starts_with(said, 'yes') AND stage <> 'stage2' THEN adoi ELSE doi END AS final_doi, round(t, 4)::DOUBLE AS t, round(a, 4)::DOUBLE AS a FROM z"""


@query(_REVIEW)
def review_pass(spark, d):
    return R.review(_records(spark, d), _answers(spark, d)).select("path", "stage", "accepted", "confidence", "decision", "final_doi", "t", "a")


# Tries of a record: its own identifier, then spellings of its file name, of which the last is the key of every third answer.
_HARD = f"""WITH RECURSIVE r AS (SELECT *, {q_norm('text')} AS normal FROM ({RECORD}) WHERE NOT ok), b AS ({_BEST}),
tries AS (SELECT doc_id, 0 AS ord, doi, 'existing_doi' AS src, doc_id % 3 <> 0 AS hit FROM r
 UNION ALL SELECT doc_id, 1, '10.1149/ma2013-01_4_' || doc_id, 'filename_variant', false FROM r WHERE doc_id % 3 <> 0
 UNION ALL SELECT doc_id, 2, '10.1149/ma2013-01/4_' || doc_id, 'filename_variant', false FROM r
 UNION ALL SELECT doc_id, 3, '10.1149/ma2013-01/4/' || doc_id, 'filename_variant', doc_id % 3 = 0 FROM r),
j AS (SELECT r.path, r.doc_id, r.title, r.normal, tries.ord, tries.doi AS try_doi, src, hit AND b.res AS res, b.adoi, CASE WHEN hit AND b.res THEN b.atitle END AS atitle FROM r JOIN tries USING (doc_id) JOIN b USING (doc_id)),
{q_pairs('j', 'title', 'atitle')},
s AS (SELECT j.*, {q_score('title', 'atitle')} AS t, CASE WHEN atitle IS NULL THEN 0.0 ELSE 1.0 END AS a, list_filter({q_words('atitle')}, lambda w: length(w) >= 4 AND w NOT IN {K.COVERAGE_WORDS}) AS telling
 FROM j LEFT JOIN ratios ON ratios.a = {q_norm('title')} AND ratios.b = {q_norm('atitle')}),
v AS (SELECT *, CASE WHEN atitle IS NULL OR normal = '' THEN 0.0 WHEN contains(normal, {q_norm('atitle')}) THEN 1.0 WHEN len(telling) = 0 THEN 0.0
 ELSE len(list_filter(telling, lambda w: contains(normal, w))) / len(telling) END AS c, len({q_words('atitle')}) AS title_words, src = 'filename_variant' AS ff, false AS no_authors, false AS bad_title, false AS search FROM s),
d AS (SELECT *, {K.HARD_CASE} AS said FROM v),
n AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY starts_with(said, 'yes') DESC, CASE regexp_extract(said, '^\\S+ (\\S+) ', 1) WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 0 END DESC,
 round(t, 4) DESC, round(c, 4) DESC, ord) AS rn FROM d)
SELECT path, try_doi AS doi, src AS source, {K.decided('said')}, CASE WHEN starts_with(said, 'yes') THEN adoi ELSE '' END AS final_doi, round(t, 4)::DOUBLE AS t, round(a, 4)::DOUBLE AS a, round(c, 4)::DOUBLE AS c FROM n WHERE rn = 1"""


@query(_HARD)
def hard_case_pass(spark, d):
    return H.hard_cases(_records(spark, d), _answers(spark, d)).select("path", "doi", "source", "accepted", "confidence", "decision", "final_doi", "t", "a", "c")


@query(f"""WITH z AS ({_REVIEW}), r AS ({RECORD}) SELECT r.path, CASE WHEN z.accepted OR r.ok THEN 'ok' ELSE 'review' END AS status, CASE WHEN z.accepted THEN z.final_doi ELSE r.doi END AS doi,
 CASE WHEN z.accepted THEN 'postprocess_' || z.decision END AS method, CASE WHEN z.accepted THEN z.confidence ELSE 'low' END AS confidence, CASE WHEN z.path IS NOT NULL THEN 'review' END AS original_status,
 CASE WHEN z.path IS NOT NULL THEN r.doi END AS original_doi, z.stage AS review_stage, z.decision AS postprocess_decision,
 CASE WHEN z.accepted AND z.stage <> 'stage2' THEN 'doi_authority' WHEN z.accepted THEN 'postprocess_existing_evidence' END AS doi_validation_source
FROM r LEFT JOIN z ON r.path = z.path""")
def review_applied(spark, d):
    records = _records(spark, d).withColumn("confidence", F.lit("low"))
    done = R.applied(records, R.review(records, _answers(spark, d)))
    shown = ("status", "doi", "method", "confidence", "original_status", "original_doi", "review_stage", "postprocess_decision", "doi_validation_source")
    return done.select("path", *shown)


@query(f"""WITH z AS ({_HARD}), r AS ({RECORD}) SELECT r.path, CASE WHEN z.accepted OR r.ok THEN 'ok' ELSE 'review' END AS status, CASE WHEN z.accepted THEN z.final_doi ELSE r.doi END AS doi,
 CASE WHEN z.accepted THEN 'hardcase_' || z.source END AS method, CASE WHEN z.path IS NOT NULL THEN CASE WHEN z.accepted THEN '1' ELSE '0' END END AS hardcase_accept,
 z.source AS hardcase_candidate_source, CASE WHEN z.accepted THEN CASE WHEN r.doc_id % 7 <> 0 THEN 'doi.org' ELSE 'crossref' END END AS doi_validation_source,
 CASE WHEN z.accepted THEN '2020' ELSE '' END AS year, 'Own' AS journal FROM r LEFT JOIN z ON r.path = z.path""")
def hard_case_applied(spark, d):
    """What an accepted answer has fills what is missing, and only that."""
    records = _records(spark, d).withColumns({"confidence": F.lit("low"), "year": F.lit(""), "journal": F.lit("Own")})
    answers = _answers(spark, d).withColumns({"year": F.lit("2020"), "container": F.lit("Other")})
    done = H.applied(records, H.hard_cases(records, answers))
    return done.select("path", "status", "doi", "method", "hardcase_accept", "hardcase_candidate_source", "doi_validation_source", "year", "journal")


_CELL = "CASE doc_id % 4 WHEN 0 THEN '  <b>' || source || '</b> & \"x\" ' WHEN 1 THEN coalesce(text, '') WHEN 2 THEN '' ELSE source || ' it' || chr(39) || 's' END"
_PARTS = "CASE doc_id % 3 WHEN 0 THEN 'pdf+' || lang WHEN 1 THEN '' ELSE 'ocr+pdf' END"
_NUMBER = "CASE doc_id % 5 WHEN 0 THEN '12.7' WHEN 1 THEN '-3' WHEN 2 THEN 'many' WHEN 3 THEN '' ELSE '' || doc_id END"


@query(f"""SELECT doc_id, CASE WHEN length({q_clean('x')}) > 40 THEN left({q_clean('x')}, 39) || '...' ELSE {q_clean('x')} END AS short,
 replace(replace(replace(replace(replace(left(x, 60), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&#x27;') AS escaped,
 CASE WHEN {q_clean('left(x, 60)')} = '' THEN p WHEN p = '' THEN left(x, 60) ELSE p || ' | ' || left(x, 60) END AS message,
 CASE WHEN list_contains(string_split(p, '+'), 'ocr') THEN p WHEN p = '' THEN 'ocr' ELSE p || '+ocr' END AS sources,
 greatest(0, coalesce(trunc(try_cast(n AS DOUBLE))::BIGINT, 0)) AS number FROM (SELECT doc_id, {_CELL} AS x, {_PARTS} AS p, {_NUMBER} AS n FROM documents)""")
def cell_texts(spark, d):
    df = docs(spark, d, "doc_id", f"{_CELL} AS x", f"{_PARTS} AS p", f"{_NUMBER} AS n").withColumn("head", F.substring("x", 1, 60))
    p, head = F.col("p"), F.col("head")
    out = {"short": T.short(F.col("x"), 40), "escaped": T.escape_html(head), "message": T.append_message(p, head), "sources": T.add_source(p, F.lit("ocr")), "number": T.number(F.col("n"))}
    return df.select("doc_id", *[v.alias(k) for k, v in out.items()])


_SCORED = "CASE doc_id % 4 WHEN 0 THEN '{\"title_score\":0.' || (doc_id % 10) || ',\"author_score\":\"0.5\"}' WHEN 1 THEN 'no json' WHEN 2 THEN '' ELSE '{\"title_score\":\"bad\",\"other\":1}' END"


@query("""SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN round((doc_id % 10) / 10.0, 4) ELSE 0.0 END::DOUBLE AS title_score, CASE WHEN doc_id % 4 = 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS author_score FROM documents""")
def stored_scores(spark, d):
    t, a = R.stored_scores(F.col("x"))
    return docs(spark, d, "doc_id", f"{_SCORED} AS x").select("doc_id", t.alias("title_score"), a.alias("author_score"))


_STATE = """doc_id, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'A' ELSE 'A fine title of ' || source END AS title, doc_id % 3 = 0 AS people, CASE WHEN doc_id % 5 < 2 THEN '' ELSE '10.1000/x' END AS doi,
 CASE doc_id % 7 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' WHEN 3 THEN 'none' ELSE 'review' END AS confidence, CASE WHEN doc_id % 11 = 0 THEN 'failed' END AS failed"""


@query(f"""SELECT doc_id, title = '' OR NOT people AS header, failed IS NOT NULL OR length(title) < 5 OR NOT people AS ocr_metadata, doi = '' AND length(title) >= 18 AS search,
 doi <> '' AND confidence IN ('review', 'low', 'medium') AS look_up, doi <> '' AS look_up_all, doi = '' OR confidence = 'review' AS more FROM (SELECT {_STATE} FROM documents)""")
def gates(spark, d):
    people = F.when(F.col("people"), F.array(F.lit("Ana Li"))).otherwise(F.array().cast("array<string>"))
    df = docs(spark, d, *_split(_STATE)).withColumn("authors", people)
    title, doi, sure = F.col("title"), F.col("doi"), F.col("confidence")
    out = {
        "header": M.needs_header(title, F.array_join("authors", "; ")),
        "ocr_metadata": M.needs_ocr_metadata(title, F.col("authors"), F.col("failed")),
        "search": M.needs_title_search(doi, title),
        "look_up": M.needs_look_up(doi, sure, False),
        "look_up_all": M.needs_look_up(doi, sure, True),
        "more": M.needs_more(doi, sure),
    }
    return df.select("doc_id", *[v.alias(k) for k, v in out.items()])


_NAME = """CASE doc_id % 4 WHEN 0 THEN 'clean_' || doc_id || '_growth_of-thin_oxide_films(2).pdf' WHEN 1 THEN '10.1000_abc.' || doc_id || '- growth of films on ' || source || '.pdf' WHEN 2 THEN 'short.pdf'
 ELSE '10.1016_j.x_y.' || doc_id || '..-10.1002@ab' || doc_id || '_.pdf' END"""


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'growth of thin oxide films' WHEN 1 THEN 'growth of films on ' || source ELSE '' END AS title,
 CASE doc_id % 4 WHEN 1 THEN '10.1000_abc.' || doc_id WHEN 3 THEN '10.1016_j.x_y.' || doc_id || '..-10.1002@ab' || doc_id ELSE '' END AS tokens FROM documents""")
def name_parts(spark, d):
    stem = F.regexp_replace("x", r"\.[^.]*$", "")
    return docs(spark, d, "doc_id", f"{_NAME} AS x").select("doc_id", T.title_from_name(F.col("x")).alias("title"), F.array_join(I.name_tokens(stem), "|").alias("tokens"))


_ASKED = "lang || ' ' || source || ' note ' || (doc_id % 97)"
_INDEXED = "'note ' || (doc_id % 89) || ' on ' || source || ' ' || lang || CASE WHEN doc_id % 3 = 0 THEN ' again' ELSE '' END"


@query(f"""WITH q AS (SELECT doc_id AS query_id, list_distinct(string_split({_ASKED}, ' ')) AS qs FROM documents), x AS (SELECT doc_id AS doc_key, list_distinct(string_split({_INDEXED}, ' ')) AS xs FROM documents),
qd AS (SELECT DISTINCT qs FROM q), s AS (SELECT qs, doc_key, round(len(list_intersect(qs, xs)) / len(qs), 4) AS overlap FROM qd, x),
r AS (SELECT *, row_number() OVER (PARTITION BY qs ORDER BY overlap DESC, doc_key) AS rank FROM s WHERE overlap > 0)
SELECT query_id, doc_key, rank::INT AS rank, overlap FROM r JOIN q ON q.qs = r.qs WHERE rank <= 5""")
def title_search_topk(spark, d):
    """Words of most titles are beyond ``common``, so both ways are taken."""
    q, x = docs(spark, d, "doc_id AS query_id", f"{_ASKED} AS title"), docs(spark, d, "doc_id AS doc_key", f"{_INDEXED} AS title")
    return P.title_search(q, x, common=50)
