"""Second look at rows that are not certain: stored scores, then the authority, then a repeated or respelled look-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import is_plausible, normalize
from ..functions.similarity import author_score, with_title_score
from ..functions.text import clean, compact
from ..operators import authority as A
from ..operators import decisions as D

#: What a decision keeps of the answer that it rests on.
ANSWER = ("authority_doi", "authority_title", "authority_authors", "authority_container", "authority_publisher", "authority_type", "authority_year", "error")


def in_filename(record_doi: Column, filename: Column, sources: Column) -> Column:
    """The identifier stands in the file name, and a source says that it came from there."""
    named = F.exists(sources, lambda s: s.startswith("filename"))
    return named & (record_doi != "") & compact(F.coalesce(filename, F.lit(""))).contains(compact(record_doi))


def stored_scores(json: Column) -> tuple[Column, Column]:
    """Title and author score of the JSON text that an earlier pass kept; 0 where there is none."""
    of = lambda field: F.coalesce(F.get_json_object(json, f"$.{field}").try_cast("double"), F.lit(0.0))
    return of("title_score"), of("author_score")


def _decided(df: DataFrame, table: str, t: str, a: str, resolved: Column) -> DataFrame:
    """Adds the decision of a table, as a column of its name, over the scores t and a."""
    facts = {"t": F.col(t), "a": F.col(a), "res": resolved, "doi": F.col("doi_ok")}
    own = [c for c in facts if c in df.columns]  # the rules' names, while they are read
    kept = {f"__own_{c}": F.col(c) for c in own}
    named = df.withColumns({**kept, **facts}).withColumn(table, D.decide(table)).drop(*facts)
    return named.withColumnsRenamed({f"__own_{c}": c for c in own})


def _looked_up(df: DataFrame, answers: DataFrame, key: Column, name: str) -> DataFrame:
    """df with the answer for ``key`` as the struct ``name``. A row without a key meets nothing and goes to no one place."""
    rest = [c for c in answers.columns if c != "doi_key"]
    named = answers.select(F.col("doi_key").alias("_key"), F.struct(*rest).alias(name))
    asked = df.withColumn("_key", F.coalesce(F.lower(key), F.concat(F.lit("\u0000"), F.col("path"))))
    return asked.join(named, "_key", "left").drop("_key")


def review(records: DataFrame, answers: DataFrame | None, exact: bool = True, retried: DataFrame | None = None) -> DataFrame:
    """records -> path, stage, decision, accepted, confidence, final_doi, corrected_doi, tried_dois, t, a and the answer's columns.

    records (path, filename, doi, status, title, authors array, sources array, old_t, old_a): those that are not ok but have a
    plausible identifier are looked at. answers (doi_key, source, resolved, doi, title, authors, ...), any number a key;
    retried: answers of look-ups that were repeated after a transient error, if there were any. Without answers only stored
    scores decide. Every row goes through once: an answer is joined where the step before has not accepted.
    """
    open_ = records.filter(F.coalesce(F.col("status"), F.lit("")) != "ok").withColumn("_doi", normalize(F.col("doi")))
    facts = open_.filter(is_plausible(F.col("_doi"))).withColumns({
        "doi_ok": F.lit(True),
        "ff": F.coalesce(in_filename(F.col("_doi"), F.col("filename"), F.col("sources")), F.lit(False)),
        "no_authors": F.size(F.coalesce("authors", F.array().cast("array<string>"))) <= 0,
        "bad_title": D.local_facts(F.col("title")),
        "mainstream": F.col("_doi").rlike(D.MAINSTREAM),
        "t2": F.coalesce("old_t", F.lit(0.0)),
        "a2": F.coalesce("old_a", F.lit(0.0)),
    })
    two = _decided(facts, "stage2", "t2", "a2", F.lit(False))
    accepted = F.col("stage2.accepted")
    if answers is None:
        nothing = {c: F.lit(None).cast("array<string>" if c == "authority_authors" else "string") for c in ANSWER}
        return two.select("path", F.lit("stage2").alias("stage"), "stage2.*",
            *_result(accepted, F.col("_doi"), F.lit(""), F.array().cast("array<string>"), F.col("t2"), F.col("a2")), *[v.alias(k) for k, v in nothing.items()])
    one = _named(A.one_answer(answers))
    again_answers = _named(A.one_answer(retried)) if retried is not None else one
    three = _looked_up(two, one, F.when(~accepted, F.col("_doi")), "found")
    three = _scored(three, "found", "t3", "a3", exact, ~accepted)
    three = _decided(three, "stage3", "t3", "a3", F.coalesce(F.col("found.resolved"), F.lit(False)))
    again = ~accepted & F.col("stage3.decision").isin("stage3_unresolved_not_resolved", "stage3_conflict_review")
    three = three.withColumn("again", again).withColumn("jobs", F.when(F.col("again"), A.retry_jobs(F.col("doi"), F.col("found.error"))))
    job = lambda forced: F.get(F.filter("jobs", lambda j: j["force"] == forced)["doi"], F.lit(0))
    four = _looked_up(_looked_up(three, again_answers, job(True), "same"), again_answers, job(False), "other")
    use = F.when(F.col("same.resolved"), F.col("same")).when(F.col("other.resolved"), F.col("other"))
    tried = F.when(F.col("same.resolved"), job(True)).when(F.col("other.resolved"), job(False))
    four = four.withColumns({"retry": use, "tried": tried}).drop("same", "other")
    four = _scored(four, "retry", "t4", "a4", exact, F.col("again"))
    four = _decided(four, "stage4", "t4", "a4", F.coalesce(F.col("retry.resolved"), F.lit(False)))
    stage = F.when(accepted, "stage2").when(F.col("again"), "stage4").otherwise("stage3")
    pick = lambda a, b, c: F.when(accepted, a).when(F.col("again"), c).otherwise(b)
    corrected = F.col("_corrected")
    told_doi = F.coalesce(F.nullif(pick(F.lit(None), F.col("found.authority_doi"), F.col("retry.authority_doi")), F.lit("")), F.when(F.col("again"), F.col("tried")))
    four = four.withColumn("_normal", normalize(told_doi)).withColumn("_corrected", F.when(F.col("again"), F.col("_normal")).otherwise(""))
    canonical = F.when(is_plausible(F.col("_normal")), F.col("_normal")).otherwise("")
    decision = pick(F.col("stage2"), F.col("stage3"), F.col("stage4"))
    told = F.when(F.col("again") & F.col("retry").isNull(), "no retry/normalized DOI resolved")
    kept = [pick(F.lit(None), F.col(f"found.{c}"), F.col(f"retry.{c}")).alias(c) for c in ANSWER if c != "error"]
    error = F.coalesce(told, pick(F.lit(None), F.col("found.error"), F.col("retry.error"))).alias("error")
    dois = F.coalesce(F.transform("jobs", lambda j: j["doi"]), F.array().cast("array<string>"))
    final = F.when(decision["accepted"] & (canonical != ""), canonical).otherwise(F.col("_doi"))
    out = four.select("path", stage.alias("stage"), decision.alias("d"),
        *_result(F.lit(True), final, corrected, dois, pick(F.col("t2"), F.col("t3"), F.col("t4")), pick(F.col("a2"), F.col("a3"), F.col("a4"))), *kept, error)
    return out.select("path", "stage", "d.*", *[c for c in out.columns if c not in ("path", "stage", "d")])


def _named(answers: DataFrame) -> DataFrame:
    """Answers under the names that decisions keep."""
    has = lambda c: F.col(c) if c in answers.columns else F.lit(None).cast("string")
    named = {"authority_doi": F.col("doi"), "authority_title": F.col("title"), "authority_authors": F.col("authors"), **{f"authority_{c}": has(c) for c in ("container", "publisher", "type", "year")}}
    return answers.select("doi_key", F.coalesce("resolved", F.lit(False)).alias("resolved"), *[v.alias(k) for k, v in named.items()], has("error").alias("error"))


def _scored(df: DataFrame, answer: str, t: str, a: str, exact: bool, wanted: Column) -> DataFrame:
    """Adds the scores of the record against an answer; the Python function sees only rows that are wanted."""
    theirs = F.when(wanted, F.col(f"{answer}.authority_title"))
    scored = with_title_score(df, t, F.col("title"), theirs, exact)
    return scored.withColumn(a, F.when(wanted, author_score(F.col("authors"), F.col(f"{answer}.authority_authors"))).otherwise(0.0))


def _result(ok: Column, final: Column, corrected: Column, tried: Column, t: Column, a: Column) -> list[Column]:
    return [F.when(ok, final).otherwise(F.col("_doi")).alias("final_doi"), F.coalesce(corrected, F.lit("")).alias("corrected_doi"), tried.alias("tried_dois"),
        F.round(t, 4).alias("t"), F.round(a, 4).alias("a")]


def keep_originals(columns: list[str]) -> dict[str, Column]:
    """What a record was before its first later pass: kept once."""
    was = {"status": "string", "method": "string", "doi": "string", "confidence": "string"}
    had = F.coalesce(F.col("original_status"), F.lit("")) != "" if "original_status" in columns else F.lit(False)
    old = lambda c: F.col(f"original_{c}") if f"original_{c}" in columns else F.lit(None).cast("string")
    now = lambda c, kind: F.col(c) if c in columns else F.lit(None).cast(kind)
    return {f"original_{c}": F.when(had, old(c)).otherwise(now(c, kind)) for c, kind in was.items()}


def merged_scores(json: Column, scores: dict[str, Column]) -> Column:
    """The JSON object with these entries added or replaced; text that is no object counts as an empty one."""
    numbers = F.create_map(*[x for k, v in scores.items() for x in (F.lit(k), v)])
    before = F.coalesce(F.from_json(F.when(clean(json).startswith("{"), json), "map<string,string>"), F.create_map().cast("map<string,string>"))
    rest = F.map_filter(before, lambda k, _: ~k.isin(*scores))
    return F.to_json(F.map_concat(rest, numbers))


def applied(records: DataFrame, decisions: DataFrame) -> DataFrame:
    """records with the review's decisions: accepted ones in place, the answer's fields beside, what was before kept once."""
    names = {"stage": "review_stage", "decision": "postprocess_decision", "confidence": "postprocess_confidence", "t": "authority_title_score",
        "a": "authority_author_score", "error": "authority_error"}
    mine = decisions.select("path", F.struct(*[c for c in decisions.columns if c != "path"]).alias("_d"))
    j = records.drop(*names.values(), *[c for c in ANSWER if c != "error"], "corrected_doi", "tried_dois").join(mine, "path", "left")
    d, seen = (lambda c: F.col(f"_d.{c}")), F.col("_d").isNotNull()
    ok = F.coalesce(d("accepted"), F.lit(False))
    had = lambda c: F.col(c) if c in records.columns else F.lit(None).cast("string")
    out = {k: F.when(seen, v).otherwise(had(k)) for k, v in keep_originals(records.columns).items()}
    score = merged_scores(had("doi_validation_score"), {"postprocess_decision": d("decision"), "authority_title_score": d("t").cast("string"), "authority_author_score": d("a").cast("string")})
    out |= {names.get(c, c): d(c) for c in decisions.columns if c in (*names, *ANSWER, "corrected_doi", "tried_dois")}
    out |= {c: F.when(seen, F.format_string("%.4f", d(k))) for c, k in (("authority_title_score", "t"), ("authority_author_score", "a"))}
    out |= {
        "doi_validation_score": F.when(seen & (ok | (d("stage") != "stage2")), score).otherwise(had("doi_validation_score")),
        "doi_validation_source": F.when(ok & d("stage").isin("stage3", "stage4"), "doi_authority").when(ok & (F.coalesce(had("doi_validation_source"), F.lit("")) == ""),
            "postprocess_existing_evidence").otherwise(had("doi_validation_source")),
        "status": F.when(ok, "ok").otherwise(F.col("status")),
        "method": F.when(ok, F.concat(F.lit("postprocess_"), d("decision"))).otherwise(had("method")),
        "doi": F.when(ok, d("final_doi")).otherwise(F.col("doi")),
        "confidence": F.when(ok, d("confidence")).otherwise(F.col("confidence")),
        "doi_decision": F.when(ok, d("decision")).otherwise(had("doi_decision")),
    }
    return j.withColumns(out).drop("_d")


__all__ = ["ANSWER", "applied", "in_filename", "keep_originals", "merged_scores", "review", "stored_scores"]
