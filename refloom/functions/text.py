"""Text expressions: cleaning, normal form, title and author predicates. Column in, Column out; no Python at run time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a title that says nothing, and as text of a page that is not the article's own.
EMPTY_TITLES = r"(?i)^(abstract|keywords|print|untitled|microsoft word|pdfthreading|crossmark_default|crossmark|template for electronic submission|doi\s*:|url\s*:)$"
EMPTY_NORMAL_TITLES = ("print", "pdfthreading", "crossmark default")
FOREIGN_TITLE = (
    "accepted manuscript|to cite this version|self-archived|metadata of the chapter|dissertation|master'?s thesis|copyright|"
    "downloaded by|view article online|abstract of the dissertation|peer review information|editor summary|showcasing research"
)
FOREIGN_TITLE_MORE = FOREIGN_TITLE + (
    "|prepared as an account|we accept this|required standard|eingereicht|notice: subject|prior publication|issue information|"
    "table of contents|contents|downloaded from|terms of use|all rights reserved|this article is protected|supplementary material"
)
COVERAGE_STOP_WORDS = ("and", "for", "the", "with", "from", "this", "that", "into", "using", "based", "study", "effect", "properties", "materials")
DOMAIN_STOP_WORDS = ("battery", "batteries", "electrode", "electrodes", "electrolyte", "electrolytes", "lithium", "sodium", "materials", "technologies", "chapter", "introduction", "review")
# Text that is no title to search by, in a page's text layer and in OCR text.
NOT_USEFUL = (
    "abstract|keywords?|introduction|references|bibliography|table of contents|preparing your manuscript|contents programmed|new titles for|"
    "titles are limited|downloaded from|copyright|non-commercial research|摘要|关键词|引言"
)
NOT_USEFUL_OCR = "abstract|keywords?|introduction|references|bibliography|table of contents|copyright|downloaded from|non-commercial research|摘要|关键词|引言"
GREEK = (("β", "beta"), ("α", "alpha"), ("γ", "gamma"))
DASHES = "–—‐‑−"
BLANK = r"[\s\u00a0\u0085\u001c-\u001f\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def let(x: Column, body) -> Column:
    """body of x, with x evaluated once however often the body names it: nested uses would multiply the plan otherwise."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def clean(x: Column) -> Column:
    """Null is empty; line ends are blanks; no blanks at the ends."""
    return F.regexp_replace(F.translate(F.coalesce(x.cast("string"), F.lit("")), "\r\n", "  "), rf"^{BLANK}+|{BLANK}+\z", "")


def norm_text(x: Column) -> Column:
    """Lower case; Greek letters by name; tags and everything that is no letter or digit read as one blank."""
    text = F.lower(clean(x))
    for letter, name in GREEK:
        text = F.replace(text, F.lit(letter), F.lit(name))
    text = F.translate(text, DASHES, "-" * len(DASHES))
    return F.trim(F.regexp_replace(F.regexp_replace(text, "<[^>]+>", " "), r"[^\p{L}\p{N}]+", " "))


def _bad(text: Column, normal: Column) -> Column:
    return (F.length(normal) < 5) | text.rlike(EMPTY_TITLES) | normal.isin(*EMPTY_NORMAL_TITLES)


def with_normal(x: Column, body) -> Column:
    """body of the clean and the normal text, each made once."""
    return let(clean(x), lambda text: let(norm_text(text), lambda normal: body(text, normal)))


def is_bad_title(x: Column) -> Column:
    return with_normal(x, _bad)


def local_title_is_bad(x: Column) -> Column:
    """For the review stages."""
    return with_normal(x, lambda text, normal: _bad(text, normal) | text.rlike(f"(?i)({FOREIGN_TITLE})"))


def _bad_hard(text: Column, normal: Column) -> Column:
    return _bad(text, normal) | (F.length(normal) < 8) | text.rlike(f"(?i)({FOREIGN_TITLE_MORE})")


def title_is_bad(x: Column) -> Column:
    """For the hard-case stage: a longer list, and eight characters at least."""
    return with_normal(x, _bad_hard)


def useful_title(x: Column, domain: bool = True) -> Column:
    """A title specific enough to search by. domain: as for a text layer, with two words beyond the field's common ones."""
    no = f"(?iU)(?:^|\\b)(?:{NOT_USEFUL if domain else NOT_USEFUL_OCR})(?:\\b|[:：])"

    def body(text: Column, normal: Column) -> Column:
        def enough(words: Column) -> Column:
            ok = F.size(words) >= 4
            return ok & (F.size(F.filter(words, lambda w: ~w.isin(*DOMAIN_STOP_WORDS))) >= 2) if domain else ok

        words = F.filter(F.split(normal, " "), lambda w: F.length(w) >= 3)
        return (text != "") & (F.length(text) <= 280) & (F.length(normal) >= 18) & ~text.rlike(no) & let(words, enough)

    return with_normal(x, body)


def searchable_title(x: Column) -> Column:
    """A title that a source may be asked for: none of the hard-case list, and eighteen characters at least."""
    return with_normal(x, lambda text, normal: ~_bad_hard(text, normal) & (F.length(normal) >= 18))


def parse_authors(x: Column) -> Column:
    """Names of a text list, separated by semicolons or "and"."""
    return F.filter(F.transform(F.split(clean(x), ";|, and | and "), lambda a: F.regexp_replace(a, rf"^{BLANK}+|{BLANK}+\z", "")), lambda a: a != "")


def author_names(x: Column) -> Column:
    """Names of an array: blank ones dropped."""
    return F.filter(F.transform(x, clean), lambda a: a != "")


def collapse(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, rf"{BLANK}+", " "))


def compact(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def has_cjk(x: Column) -> Column:
    return F.coalesce(x, F.lit("")).rlike("[\\u4e00-\\u9fff]")


def short(x: Column, width: int = 220) -> Column:
    return let(clean(x), lambda t: F.when(F.length(t) > width, F.concat(F.substring(t, 1, width - 1), F.lit("..."))).otherwise(t))


def append_message(existing: Column, message: Column) -> Column:
    """One more message behind a bar; a blank one adds nothing."""
    return F.when(clean(message) == "", existing).otherwise(F.concat_ws(" | ", F.nullif(clean(existing), F.lit("")), message))


def escape_html(x: Column) -> Column:
    out = F.coalesce(x, F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def add_source(existing: Column, source: Column) -> Column:
    """Adds to a set written with plus signs."""
    return F.array_join(F.array_distinct(F.concat(F.filter(F.split(clean(existing), r"\+"), lambda s: s != ""), F.array(source))), "+")


def number(x: Column) -> Column:
    """A non-negative whole number from text, 0 where there is none."""
    return F.greatest(F.lit(0).cast("long"), F.coalesce(x.try_cast("double").cast("long"), F.lit(0).cast("long")))


def first_file(*paths: Column) -> Column:
    return F.coalesce(*[F.nullif(clean(p), F.lit("")) for p in paths])


def sections(text: Column, front_lines: int = 150) -> Column:
    """struct(front, body, references): the references begin at the first line that is only their heading."""
    whole = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n|[\r\u000b\u000c\u001c-\u001e\u0085\u2028\u2029]", "\n"), "\n", -1)

    def parts(lines: Column, stop: Column) -> Column:
        part = lambda a, b: F.array_join(F.slice(lines, a + 1, F.greatest(F.lit(0), b - a)), "\n")
        return F.struct(part(F.lit(0), F.least(F.lit(front_lines), stop)).alias("front"),
            F.when(stop > front_lines, part(F.lit(front_lines), stop)).otherwise("").alias("body"), part(stop, F.size(lines)).alias("references"))

    def found(lines: Column) -> Column:
        at = F.array_position(F.transform(lines, lambda s: F.trim(s).rlike(r"(?i)^#*\s*(references|bibliography)\s*$")), F.lit(True)).cast("int")
        return let(let(at, lambda n: F.when(n > 0, n - 1).otherwise(F.size(lines))), lambda stop: parts(lines, stop))

    # a text that ends in a line end has no further, empty line
    last = lambda lines: F.when(F.element_at(lines, -1) == "", F.slice(lines, F.lit(1), F.size(lines) - 1)).otherwise(lines)
    return let(let(whole, last), found)


def title_from_name(filename: Column) -> Column:
    """A title guessed from a file name; empty if it says too little."""
    out = F.regexp_replace(F.coalesce(filename, F.lit("")), r"\.[^.]*$", "")
    for pattern in (r"(?i)^clean_\d+_", r"(?i)10\.\d{4,9}[_@-][A-Za-z0-9][A-Za-z0-9._;()/:+@-]*", r"\(\d+\)$", "[_-]"):
        out = F.regexp_replace(out, pattern, "" if pattern.endswith("_") else " ")
    return let(collapse(out), lambda o: F.when(F.length(norm_text(o)) >= 18, o).otherwise(""))
