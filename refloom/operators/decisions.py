"""Acceptance rules as tables: the first row whose condition holds decides. Each becomes one CASE expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.identifiers import suspicious
from ..functions.text import local_title_is_bad, norm_text, title_is_bad

Rule = tuple[str, bool, str, str]  # condition over the names below, accepted, confidence, decision

# The rules. t title score, a author score, c coverage of the title by the text, doi: there is a plausible
# one, ff: it is in the file name, no_authors / bad_title: local data, res: the authority answered.
STAGE2: list[Rule] = [
    ("not doi", False, "none", "stage2_unresolved_no_doi"),
    ("t >= 0.985", True, "high", "stage2_accept_high"),
    ("t >= 0.94 and (a >= 0.15 or no_authors)", True, "high", "stage2_accept_high"),
    ("t >= 0.88 and a >= 0.75", True, "medium", "stage2_accept_probable"),
    ("t >= 0.80 and a >= 0.90", True, "medium", "stage2_accept_probable"),
    ("ff and (t >= 0.5 or a >= 0.5)", True, "medium", "stage2_accept_probable"),
    ("true", False, "none", "stage2_needs_authority"),
]
STAGE3: list[Rule] = [
    ("not doi", False, "none", "stage3_unresolved_no_doi"),
    ("not res", False, "none", "stage3_unresolved_not_resolved"),
    ("t >= 0.985", True, "high", "stage3_accept_high"),
    ("t >= 0.94 and (a >= 0.15 or no_authors)", True, "high", "stage3_accept_high"),
    ("t >= 0.80 and a >= 0.50", True, "medium", "stage3_accept_probable"),
    ("ff and bad_title", True, "medium", "stage3_accept_probable"),
    ("ff and (t >= 0.50 or a >= 0.50)", True, "medium", "stage3_accept_probable"),
    ("ff and mainstream", True, "medium", "stage3_accept_probable"),
    ("true", False, "low", "stage3_conflict_review"),
]
STAGE4: list[Rule] = [
    ("not res", False, "none", "stage4_unresolved"),
    ("t >= 0.94 and (a >= 0.15 or no_authors)", True, "high", "stage4_accept_high"),
    ("ff", True, "medium", "stage4_accept_probable"),
    ("t >= 0.80 and a >= 0.50", True, "medium", "stage4_accept_probable"),
    ("true", False, "low", "stage4_conflict_review"),
]
HARD_CASE: list[Rule] = [
    ("not res", False, "none", "authority lookup failed"),
    ("t >= 0.985", True, "high", "title near-exact"),
    ("t >= 0.94 and (a >= 0.15 or no_authors)", True, "high", "title and author strict"),
    ("c >= 0.78 and title_words >= 4", True, "high", "title in text"),
    ("ff and bad_title", True, "medium", "filename and no usable title"),
    ("ff and c >= 0.55", True, "medium", "filename and partial title"),
    ("search and t >= 0.88 and a >= 0.50", True, "medium", "search and authors"),
    ("search and c >= 0.78", True, "medium", "search and title in text"),
    ("true", False, "none", "no automatic rule matched"),
]
ROUND2: list[Rule] = [
    *[r for r in HARD_CASE if r[1] or r[0] == "not res"],
    ("t >= 0.93 and (a >= 0.10 or no_authors)", True, "high", "relaxed title and author"),
    ("t >= 0.86 and a >= 0.50", True, "medium", "relaxed title, strong author"),
    ("c >= 0.72 and title_words >= 4 and prefix_variant", True, "medium", "prefix variant and title in text"),
    ("true", False, "none", "no automatic rule matched"),
]
LAYOUT: list[Rule] = [
    ("not useful and visible and c >= 0.95 and not references", True, "medium", "visible and title in text"),
    ("not useful", False, "none", "title not usable"),
    ("not res or title_words = 0", False, "none", "authority lookup failed"),
    ("suspicious", False, "none", "supplement or dataset"),
    ("visible and t >= 0.985 and (no_authors or a >= 0.10 or c >= 0.70)", True, "high", "visible, title near-exact"),
    ("visible and t >= 0.94 and a >= 0.15", True, "high", "visible, title and author"),
    ("visible and c >= 0.90 and t >= 0.85", True, "medium", "visible, title in text"),
    ("search and t >= 0.985 and (no_authors or a >= 0.10)", True, "high", "search, title near-exact"),
    ("search and t >= 0.94 and a >= 0.50", True, "medium", "search, title and author"),
    ("true", False, "none", "no automatic rule matched"),
]
OCR: list[Rule] = [
    ("not res or title_words = 0", False, "none", "authority lookup failed"),
    ("suspicious", False, "none", "supplement or dataset"),
    ("c >= 0.95 and not references", True, "medium", "title in text"),
    ("useful and t >= 0.985 and (no_authors or a >= 0.10 or c >= 0.70)", True, "high", "title near-exact"),
    ("useful and t >= 0.94 and a >= 0.15", True, "high", "title and author"),
    ("useful and c >= 0.90 and t >= 0.80", True, "medium", "title in text, close"),
    ("true", False, "none", "no automatic rule matched"),
]
# What a reviewer should do next; the first that fits. text is the lower-case file name and title.
ACTIONS = (
    ("has_candidate", "candidate-visible-review"),
    ("text_chars < 500", "vision-ocr-needed"),
    ("text rlike 'thesis|dissertation|mémoire|master|doctoral|undergraduate honor|学位|博士|硕士'", "thesis-repository-search"),
    ("text rlike '10[.]1201|978|chapter|book|b[0-9]{4}|liquid electrolytes|battery technologies'", "book-chapter-search"),
    ("cjk", "cnki-wanfang-search"),
    ("final_decision = 'no_doi_unresolved'", "likely-no-doi"),
    ("true", "manual-web-search"),
)
TABLES = {"stage2": STAGE2, "stage3": STAGE3, "stage4": STAGE4, "hard_case": HARD_CASE, "round2": ROUND2, "layout": LAYOUT, "ocr": OCR}
MAINSTREAM = r"(?i)^10\.(1016|1021|1039|1002|1149|1109|1038|1007)/"
CONFIDENCE = {"high": 3, "medium": 2, "low": 1, "none": 0}


def case_sql(rules: list[Rule]) -> str:
    """The rules as SQL over columns of the names above: struct(accepted, confidence, decision)."""
    arms = " ".join(f"WHEN {cond} THEN named_struct('accepted', {str(ok).lower()}, 'confidence', '{conf}', 'decision', '{name}')" for cond, ok, conf, name in rules)
    return f"CASE {arms} END"


def decide(table: str) -> Column:
    return F.expr(case_sql(TABLES[table]))


def action() -> Column:
    return F.expr("CASE " + " ".join(f"WHEN {cond} THEN '{name}'" for cond, name in ACTIONS) + " END")


def rank(confidence: Column) -> Column:
    out = F.lit(0)
    for name, n in CONFIDENCE.items():
        out = F.when(confidence == name, n).otherwise(out)
    return out


#: Keys, greatest first, by which the best of several results is chosen; the first result of equals wins.
BEST = {"hard_case": ("t", "c"), "round2": ("t", "c", "a"), "layout": ("t", "a", "c"), "ocr": ("t", "a", "c", "doi_length")}


def best_by(table: str) -> Column:
    """What ``max_by`` should order results (accepted, confidence, t, a, c, ord, ...) by; scores count to four places."""
    keys = [F.round(F.col(k).cast("double"), 4) for k in BEST[table]]
    return F.struct(F.col("accepted"), rank(F.col("confidence")), *keys, -F.col("ord"))


def local_facts(title: Column, stage: str = "review") -> Column:
    return local_title_is_bad(title) if stage == "review" else title_is_bad(title)


def title_words(title: Column) -> Column:
    return F.size(F.filter(F.split(norm_text(title), " "), lambda w: w != ""))


__all__ = ["ACTIONS", "BEST", "MAINSTREAM", "TABLES", "action", "best_by", "case_sql", "decide", "local_facts", "rank", "suspicious", "title_words"]
