"""Fixed values as the SQL of the registered queries reads them.

They are stated here once more, apart from the engine's own: where one of the two is wrong, results differ.
"""

from __future__ import annotations

SCAN = r"(?i)(?:(?:doi\s*[:=]\s*)|(?:https?://(?:dx\.)?doi\.org/)|(?:(?:dx\.)?doi\.org/))?(10\.\d{4,9}/[-._;()/:+A-Z0-9_]+)"
SCAN_SPACED = r"(?i)10\s*\.\s*\d{4,9}\s*/\s*[A-Za-z0-9]+(?:\s*[._;()/:+\-_]\s*[A-Za-z0-9]+)*"
PLACEHOLDER = "10.1039/x0xx00000x"
PLACEHOLDER_WORDS = "(?i)(?:please|insert|manuscript|placeholder|yourdoi|x0xx|xx00000)"
WILEY_TAILS = (r"(?i)^(10\.1002/[a-z]{2,12}\.\d{7,9}[a-z]?)[.:()].+$", r"(?i)^(10\.1002/[a-z]{2,12}\.\d{7,9})[a-z]{4,}.+$")
SENTENCE_TAIL = r"^(.+\d)\.([A-Z][A-Za-z]{3,})$"
REPOSITORY_PREFIXES = "('10.5445', '10.26153', '10.4233', '10.6092', '10.17635')"
GREEK = (("β", "beta"), ("α", "alpha"), ("γ", "gamma"))
DASHES = "–—‐‑−"

GROUP = """CASE WHEN starts_with({0}, 'filename') THEN 'filename' WHEN starts_with({0}, 'grobid') THEN 'grobid' WHEN starts_with({0}, 'markdown') THEN 'markdown'
 WHEN starts_with({0}, 'ocr') THEN 'ocr' WHEN starts_with({0}, 'llm') THEN 'llm' WHEN regexp_matches({0}, '^(crossref|openalex)') THEN 'title_lookup'
 WHEN regexp_matches({0}, '^(xmp_|pypdf|pdf_|raw_pdf|flate_stream)') THEN 'pdf_internal' ELSE 'unknown' END"""
WEIGHT = """CASE WHEN regexp_matches({0}, '^(filename|markdown_references|ocr_references)') THEN 'review'
 WHEN regexp_matches({0}, '^(xmp_tag_prism:doi|xmp_tag_dc:identifier|markdown_front|markdown_link)') THEN 'high'
 WHEN regexp_matches({0}, '^(xmp_metadata|pypdf_metadata|pdf_uri_annotation|raw_pdf_bytes)') THEN 'medium' ELSE 'low' END"""

EMPTY_TITLE = r"(?i)^(?:abstract|keywords|print|untitled|microsoft word|pdfthreading|crossmark_default|crossmark|template for electronic submission|doi\s*:|url\s*:)$"
EMPTY_NORMAL = "('print', 'pdfthreading', 'crossmark default')"
LOCAL_BAD = (
    "(?i)(accepted manuscript|to cite this version|self-archived|metadata of the chapter|dissertation|master''?s thesis|copyright|downloaded by|view article online|"
    "abstract of the dissertation|peer review information|editor summary|showcasing research)"
)
HARD_BAD = (
    "(?i)(accepted manuscript|to cite this version|self-archived|metadata of the chapter|dissertation|master''?s thesis|copyright|downloaded by|view article online|"
    "abstract of the dissertation|peer review information|editor summary|showcasing research|prepared as an account|we accept this|required standard|eingereicht|notice: subject|"
    "prior publication|issue information|table of contents|contents|downloaded from|terms of use|all rights reserved|this article is protected|supplementary material)"
)
LAYOUT_BAD = (
    r"(?i)(?:^|\b)(?:abstract|keywords?|introduction|references|bibliography|table of contents|preparing your manuscript|contents programmed|new titles for|titles are limited|"
    r"downloaded from|copyright|non-commercial research|摘要|关键词|引言)(?:\b|[:：])"
)
OCR_BAD = r"(?i)(?:^|\b)(?:abstract|keywords?|introduction|references|bibliography|table of contents|copyright|downloaded from|non-commercial research|摘要|关键词|引言)(?:\b|[:：])"
DOMAIN_WORDS = "('battery', 'batteries', 'electrode', 'electrodes', 'electrolyte', 'electrolytes', 'lithium', 'sodium', 'materials', 'technologies', 'chapter', 'introduction', 'review')"
COVERAGE_WORDS = "('and', 'for', 'the', 'with', 'from', 'this', 'that', 'into', 'using', 'based', 'study', 'effect', 'properties', 'materials')"
SUSPICIOUS = r"(?i)(?:\.s\d{3,4}$|/fig(?:ure)?[-_/]?\d+|/suppl|supplement|supporting[-_]?information|dryad|zenodo)"
SUSPICIOUS_TITLE = r"(?i)\b(?:supporting information|supplementary material|figure \d+|table \d+|dataset|data from:)\b"

# What each cascade decides: accepted, confidence and name. t title score, a author score, c coverage, ff: from the file name.
STAGE2 = """CASE WHEN NOT doi THEN 'no none stage2_unresolved_no_doi' WHEN t >= 0.985 THEN 'yes high stage2_accept_high' WHEN t >= 0.94 AND (a >= 0.15 OR no_authors) THEN 'yes high stage2_accept_high'
 WHEN t >= 0.88 AND a >= 0.75 OR t >= 0.80 AND a >= 0.90 THEN 'yes medium stage2_accept_probable' WHEN ff AND (t >= 0.50 OR a >= 0.50) THEN 'yes medium stage2_accept_probable' ELSE 'no none stage2_needs_authority' END"""
STAGE3 = """CASE WHEN NOT doi THEN 'no none stage3_unresolved_no_doi' WHEN NOT res THEN 'no none stage3_unresolved_not_resolved' WHEN t >= 0.985 THEN 'yes high stage3_accept_high'
 WHEN t >= 0.94 AND (a >= 0.15 OR no_authors) THEN 'yes high stage3_accept_high' WHEN t >= 0.80 AND a >= 0.50 THEN 'yes medium stage3_accept_probable'
 WHEN ff AND (bad_title OR t >= 0.50 OR a >= 0.50 OR mainstream) THEN 'yes medium stage3_accept_probable' ELSE 'no low stage3_conflict_review' END"""
STAGE4 = """CASE WHEN NOT res THEN 'no none stage4_unresolved' WHEN t >= 0.94 AND (a >= 0.15 OR no_authors) THEN 'yes high stage4_accept_high' WHEN ff THEN 'yes medium stage4_accept_probable'
 WHEN t >= 0.80 AND a >= 0.50 THEN 'yes medium stage4_accept_probable' ELSE 'no low stage4_conflict_review' END"""
HARD_RULES = """ WHEN NOT res THEN 'no none authority lookup failed' WHEN t >= 0.985 THEN 'yes high title near-exact' WHEN t >= 0.94 AND (a >= 0.15 OR no_authors) THEN 'yes high title and author strict'
 WHEN c >= 0.78 AND title_words >= 4 THEN 'yes high title in text' WHEN ff AND bad_title THEN 'yes medium filename and no usable title' WHEN ff AND c >= 0.55 THEN 'yes medium filename and partial title'
 WHEN search AND t >= 0.88 AND a >= 0.50 THEN 'yes medium search and authors' WHEN search AND c >= 0.78 THEN 'yes medium search and title in text'"""
HARD_CASE = f"CASE {HARD_RULES} ELSE 'no none no automatic rule matched' END"
ROUND2 = f"""CASE {HARD_RULES} WHEN t >= 0.93 AND (a >= 0.10 OR no_authors) THEN 'yes high relaxed title and author' WHEN t >= 0.86 AND a >= 0.50 THEN 'yes medium relaxed title, strong author'
 WHEN c >= 0.72 AND title_words >= 4 AND prefix_variant THEN 'yes medium prefix variant and title in text' ELSE 'no none no automatic rule matched' END"""
LAYOUT = """CASE WHEN NOT useful THEN CASE WHEN visible AND c >= 0.95 AND NOT "references" THEN 'yes medium visible and title in text' ELSE 'no none title not usable' END
 WHEN NOT res OR title_words = 0 THEN 'no none authority lookup failed' WHEN suspicious THEN 'no none supplement or dataset'
 WHEN visible AND t >= 0.985 AND (no_authors OR a >= 0.10 OR c >= 0.70) THEN 'yes high visible, title near-exact' WHEN visible AND t >= 0.94 AND a >= 0.15 THEN 'yes high visible, title and author'
 WHEN visible AND c >= 0.90 AND t >= 0.85 THEN 'yes medium visible, title in text' WHEN search AND t >= 0.985 AND (no_authors OR a >= 0.10) THEN 'yes high search, title near-exact'
 WHEN search AND t >= 0.94 AND a >= 0.50 THEN 'yes medium search, title and author' ELSE 'no none no automatic rule matched' END"""
OCR = """CASE WHEN NOT res OR title_words = 0 THEN 'no none authority lookup failed' WHEN suspicious THEN 'no none supplement or dataset' WHEN c >= 0.95 AND NOT "references" THEN 'yes medium title in text'
 WHEN useful AND t >= 0.985 AND (no_authors OR a >= 0.10 OR c >= 0.70) THEN 'yes high title near-exact' WHEN useful AND t >= 0.94 AND a >= 0.15 THEN 'yes high title and author'
 WHEN useful AND c >= 0.90 AND t >= 0.80 THEN 'yes medium title in text, close' ELSE 'no none no automatic rule matched' END"""
DECISIONS = {"stage2": STAGE2, "stage3": STAGE3, "stage4": STAGE4, "hard_case": HARD_CASE, "round2": ROUND2, "layout": LAYOUT, "ocr": OCR}
ACTION = """CASE WHEN has_candidate THEN 'candidate-visible-review' WHEN text_chars < 500 THEN 'vision-ocr-needed'
 WHEN regexp_matches(text, 'thesis|dissertation|mémoire|master|doctoral|undergraduate honor|学位|博士|硕士') THEN 'thesis-repository-search'
 WHEN regexp_matches(text, '10\\.1201|978|chapter|book|b\\d{4}|liquid electrolytes|battery technologies') THEN 'book-chapter-search'
 WHEN cjk THEN 'cnki-wanfang-search' WHEN final_decision = 'no_doi_unresolved' THEN 'likely-no-doi' ELSE 'manual-web-search' END"""


def decided(case: str) -> str:
    """Columns accepted, confidence and decision of a cascade above."""
    return f"""regexp_extract({case}, '^(\\S+) ', 1) = 'yes' AS accepted, regexp_extract({case}, '^\\S+ (\\S+) ', 1) AS confidence, regexp_extract({case}, '^\\S+ \\S+ (.*)$', 1) AS decision"""


#: CTEs over ``pairs`` (a, b: texts under 200 characters) that end in ``ratios`` (a, b, ratio): the share of characters in the
#: longest common blocks, found again to the left and right of each. Common runs lie on diagonals; an interval clips them.
RATIOS = """rp AS (SELECT DISTINCT a, b FROM pairs),
rc AS (SELECT a, b, unnest(range(length(a))) AS i, unnest(string_split(a, '')) AS ch FROM rp),
re AS (SELECT a, b, i, unnest(list_filter(range(length(b)), lambda j: substr(b, j + 1, 1) = ch)) AS j FROM rc),
rg AS (SELECT a, b, i - j AS d, i, i - row_number() OVER (PARTITION BY a, b, i - j ORDER BY i) AS g FROM re),
runs AS (SELECT a, b, d, min(i) AS s, max(i) + 1 AS e FROM rg GROUP BY a, b, d, g),
rw AS (
  SELECT a, b, 0::BIGINT AS al, length(a) AS ah, 0::BIGINT AS bl, length(b) AS bh, 0::BIGINT AS k FROM rp
  UNION ALL
  SELECT a, b, x.al, x.ah, x.bl, x.bh, x.k FROM (
    SELECT a, b, unnest([{'al': al, 'ah': i, 'bl': bl, 'bh': i - d, 'k': n}, {'al': i + n, 'ah': ah, 'bl': i - d + n, 'bh': bh, 'k': 0}]) AS x
    FROM (
      SELECT *, row_number() OVER (PARTITION BY a, b, al, ah, bl, bh ORDER BY n DESC, i, i - d) AS rn FROM (
        SELECT rw.a, rw.b, al, ah, bl, bh, d, greatest(s, al, bl + d) AS i, least(e, ah, bh + d) - greatest(s, al, bl + d) AS n FROM rw JOIN runs ON runs.a = rw.a AND runs.b = rw.b) WHERE n > 0)
    WHERE rn = 1)),
ratios AS (SELECT a, b, 2.0 * sum(k) / (length(a) + length(b)) AS ratio FROM rw GROUP BY a, b)"""
