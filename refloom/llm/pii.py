"""Personal data, also where it is disguised: detectors over a normalised text whose spans map back to the source.

The plain detectors run over the text as it is. Three transducers then rewrite what disguises hide, each reading what
the one before wrote and remembering where each piece came from: look-alike characters; spelled digits, marks in brackets
and character references; "at" and "dot" in words. The same detectors run over the rewritten text, and spans that are new
map back through all of them to source characters.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, id_text, table

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Characters drawn like an ASCII letter (Cyrillic and Greek).
LOOK_ALIKE = dict(zip("АВЕКМНОРСТУХаеорсухіјѕԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧοι", "ABEKMHOPCTYXaeopcyxijsdqwABEZHIKMNOPTYXoi", strict=True))
# Endings of addresses; words around "at" and "dot" are an address without another sign only if the last one is among these.
ENDINGS = frozenset("com org net edu gov mil int info biz io ai co app dev me tv eu uk us de fr es it nl be at ch pl pt se no fi dk ie cz ru cn jp kr in br mx ar cl au nz ca za example test".split())
# Digits in the words of the four languages, and a doubled or tripled one in English.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
MARKS = {"at": "@", "arroba": "@", "arobase": "@", "dot": ".", "point": ".", "punkt": ".", "punto": ".", "plus": "+"}
REFERENCES = {"&#64;": "@", "&#x40;": "@", "&commat;": "@", "&#46;": ".", "&#x2e;": ".", "&period;": ".", "&#43;": "+", "&plus;": "+"}

_digit = "(?:" + "|".join(sorted(SPELLED, key=len, reverse=True)) + ")"
_at, _dot = r"(?:at|arroba|arobase|@)", r"(?:dot|point|punkt|punto|\.)"
# The words for the dot that go with each word for the at. "point" goes with the French one alone: "at one point in" is prose.
SPOKEN = {"@": ("dot", "punkt", "punto"), "at": ("dot", "punkt"), "arroba": ("punto",), "arobase": ("point",)}
_blank = r"[\x20\t\r\n]"
# A run of at least three digits of which some are words; a bracketed mark; a character reference.
DISGUISE = re.compile(
    rf"(?P<digits>(?<!\w)(?:plus[\x20-]+)?{_digit}(?:[\x20-]+(?:{_digit}|[0-9]+|dot|punkt|punto|point)){{2,}}(?!\w))"
    rf"|(?P<mark>{_blank}*[\[({{<]{_blank}*(?:{_at}|{_dot}){_blank}*[\])}}>]{_blank}*)"
    rf"|(?P<reference>{'|'.join(map(re.escape, REFERENCES))})",
    re.IGNORECASE,
)
BLANKS = frozenset(" \t\r\n")
WORD_AT = re.compile(rf"(?<=[A-Za-z0-9._%+-])(?:@|{_blank}+(?P<word>at|arroba|arobase){_blank}+)(?=[A-Za-z0-9-])", re.IGNORECASE)
WORD_DOT = {at: re.compile(rf"(?:\.|(?P<word>{_blank}+(?:{'|'.join(dots)}){_blank}+))(?=[A-Za-z0-9-])", re.IGNORECASE) for at, dots in SPOKEN.items()}
DOT_WORDS = tuple(sorted({d for dots in SPOKEN.values() for d in dots}))
AT_HINT = re.compile(r"@|\b(?:at|arroba|arobase)\b")
LABEL = re.compile("[A-Za-z0-9-]+")
LETTERS = re.compile("[A-Za-z]{2,}")
#: Lower-case texts without any of these hold no disguise of that sort; the scans are much faster than the pattern.
HINT = re.compile(rf"[\[({{<]{_blank}*(?:{_at}|{_dot}){_blank}*[\])}}>]|&(?:#|commat|period|plus)")
DIGITS_HINT = re.compile(rf"(?<!\w){_digit}[\x20-]+(?:{_digit}|[0-9]+|dot|punkt|punto|point)[\x20-]+")
NAMES = frozenset(w.encode() for w in SPELLED)
WORDS_ONLY = bytes(b if b > 127 or chr(b).isalnum() or b == 95 else 32 for b in range(256))
DIGIT = re.compile("[0-9]")
PIECE = re.compile(r"[^\x20-]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            done = m.end()
        else:
            done = at + 1  # a local part holds no @
        at = text.find("@", done)
    return out


def detect(text: str) -> dict[str, list[tuple[int, int]]]:
    """Leftmost non-overlapping spans of each kind; a match that fails its test is dropped without a retry."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        found["email"] = emails(text)
    if not DIGIT.search(text):
        return found
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found["ip"].append(m.span())
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found["card"].append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                found["phone"].append(m.span())
    return found


def plain(c: str, _known: dict[str, str] = {}) -> str:  # noqa: B006  a table of characters seen
    """The ASCII character that c looks like, nothing for an invisible one, else c."""
    if c not in _known:
        kind = unicodedata.category(c)
        form = unicodedata.normalize("NFKC", c)
        digit = unicodedata.digit(c, None)
        _known[c] = LOOK_ALIKE.get(c) or (str(digit) if kind == "Nd" and digit is not None else " " if kind == "Zs" else "-" if kind == "Pd" else "" if kind == "Cf" else form if len(form) == 1 and form.isascii() else c)
    return _known[c]


def hinted(text: str) -> bool:
    """False only for texts that DISGUISE does not match; much faster than DISGUISE."""
    low = text.lower()
    if any(c in low for c in "([{<&") and HINT.search(low):
        return True
    for c in () if low.isascii() else set(low):
        if not c.isascii() and not c.isalnum():
            low = low.replace(c, " ")
    return not NAMES.isdisjoint(low.encode("utf-8", "replace").translate(WORDS_ONLY).split()) and DIGITS_HINT.search(low) is not None


def alike(text: str) -> list[tuple[int, int, str]]:
    """Rewritings (start, end, instead) of look-alike characters and blanks, in order and apart from one another."""
    if text.isascii():
        return []
    found = {c: p for c in set(text) if not c.isascii() and (p := plain(c)) != c}
    return [(m.start(), m.end(), found[m[0]]) for m in re.finditer("[" + re.escape("".join(found)) + "]", text)] if found else []


def marks(text: str) -> list[tuple[int, int, str]]:
    """Rewritings of spelled digits, bracketed marks and character references."""
    out = []
    if hinted(text):
        for m in DISGUISE.finditer(text):
            if m["digits"]:
                said = "".join((SPELLED.get(w := p[0].lower()) or MARKS.get(w) or w) for p in PIECE.finditer(m[0]))
                out.append((*m.span(), said))
            elif m["mark"]:
                out.append((*m.span(), "@" if re.search(_at, m["mark"], re.IGNORECASE) else "."))
            else:
                out.append((*m.span(), REFERENCES[m["reference"].lower()]))
    return out


def worded(text: str, signs: list[int]) -> list[tuple[int, int, str]]:
    """Rewritings of "at" and "dot" in words, on both sides of the at. signs: places of marks that were disguised otherwise.

    The longest address counts whose last label is a known ending, or letters where a sign or a second dot supports it.
    """
    out, done = [], 0
    low = text.lower()
    if not signs and not any(d in low for d in DOT_WORDS) or not AT_HINT.search(low):
        return out
    for m in WORD_AT.finditer(text):
        a, b = m.span()
        if a < done:
            continue
        dots, ends, at = [], [], LABEL.match(text, b).end()
        spoken = (m["word"] or "@").lower()
        while d := WORD_DOT[spoken].match(text, at):
            label = LABEL.match(text, d.end())
            dots.append(d)
            ends.append(label)
            at = label.end()
        sign = bisect_right(signs, a - 1)
        while dots:
            sure = m[0] == "@" or len(dots) > 1 or sign < len(signs) and signs[sign] < ends[-1].end()
            if ends[-1][0].lower() in ENDINGS or sure and LETTERS.fullmatch(ends[-1][0]):
                break
            dots.pop()
            ends.pop()
        marked = sign < len(signs) and dots and signs[sign] < ends[-1].end()
        said = [(*d.span(), ".") for d in dots if d["word"]]
        local, start = [], a
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        while (found := dot_before(text, start, done, SPOKEN[spoken])) is not None:
            local.append((found, start, "."))
            start = found
            while start > done and text[start - 1] in LOCAL:
                start -= 1
        if dots and (said or marked or m[0] == "@" and local):
            out += [*reversed(local), *([] if m[0] == "@" else [(a, b, "@")]), *said]
            done = ends[-1].end()
    return out


def dot_before(text: str, end: int, least: int, words: tuple[str, ...]) -> int | None:
    """Where the dot in one of the words begins that ends at ``end`` and has a label before it."""
    i = end
    while i > least and text[i - 1] in BLANKS:
        i -= 1
    size = next((len(w) for w in words if text[max(least, i - len(w)) : i].lower() == w), 0)
    j = i - size
    if i == end or not size or j <= least:
        return None
    while j > least and text[j - 1] in BLANKS:
        j -= 1
    return j if least < j < i - size and text[j - 1] in LOCAL else None


def rewritten(text: str, changes: list[tuple[int, int, str]]) -> tuple[str, list[int], list[tuple[int, int, bool]]]:
    """The new text; where each segment starts in it; each segment's source bounds and whether it was copied."""
    parts, starts, source, at, n = [], [], [], 0, 0
    for a, b, s in [*changes, (len(text), len(text), "")]:
        for piece, span in ((text[at:a], (at, a, True)), (s, (a, b, False))):
            if piece:
                parts.append(piece)
                starts.append(n)
                source.append(span)
                n += len(piece)
        at = b
    return "".join(parts), starts, source


def find(text: str | None) -> tuple[dict[str, list[tuple[int, int]]], dict[str, list[tuple[int, int]]]]:
    """Plain spans and all spans by kind, in code points of the text. A null text is empty."""
    text = text or ""
    base = detect(text)
    new, layers, signs = text, [], []
    for step in (alike, marks, lambda t: worded(t, signs)):
        changes = step(new)
        if changes:
            new, starts, source = rewritten(new, changes)
            layers.append((starts, source))
            signs = [n for n, (_, _, copied) in zip(starts, source, strict=True) if not copied and new[n] in "@."] if step is marks else signs
    if not layers:
        return base, base
    found = {}
    for kind, spans in detect(new).items():
        mapped = []
        for span in spans:
            for starts, source in reversed(layers):
                span = back(*span, starts, source)
            mapped.append(span)
        ends = [b for _, b in base[kind]]  # plain spans are in order and apart: the first that ends after a start is the one to look at
        new_ones = [s for s in mapped if (i := bisect_right(ends, s[0])) == len(ends) or base[kind][i][0] >= s[1]]
        found[kind] = sorted(base[kind] + new_ones)
    return base, found


def back(a: int, b: int, starts: list[int], source: list[tuple[int, int, bool]]) -> tuple[int, int]:
    """The span before the rewriting."""
    i, j = bisect_right(starts, a) - 1, bisect_right(starts, b - 1) - 1
    (sa, sb, sc), (ea, eb, ec) = source[i], source[j]
    return sa + a - starts[i] if sc else sa, ea + b - starts[j] if ec else eb


def joined(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])


def masked(text: str | None) -> str | None:
    """The text with each span (overlapping ones together) replaced by its kind."""
    if text is None:
        return None
    spans = sorted((a, -b, k) for k, v in find(text)[1].items() for a, b in v)
    out, at = [], 0
    for a, b, k in spans:
        if a >= at:
            out += [text[at:a], f"<{k.upper()}>"]
        at = max(at, -b)
    return "".join([*out, text[at:]]) if spans else text


OUT = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])
OUT_DDL = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def spans(documents: DataFrame) -> DataFrame:
    """documents (doc_id, text) -> one row each: counts of all spans, the digest of the plain ones, and all spans.

    A null or empty text has no span; a very long one is read whole, in time about linear in its length. Rows are
    independent: repeated rows give repeated results, a null doc_id stays, an empty table gives no rows. Other columns
    are not read, whatever their names.
    """

    def run(batches):
        for b in batches:
            ids, rows = b.column("doc_id"), []
            for text in b.column("text"):
                base, found = find(text.as_py())
                rows.append((*(len(found[k]) for k in KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(found)))
            yield batch(OUT, ids, *(list(c) for c in (zip(*rows, strict=True) if rows else [[]] * 6)))

    return id_text(documents).mapInArrow(run, OUT_DDL)


def mask(documents: DataFrame) -> DataFrame:
    """The documents, all columns, with personal data in ``text`` replaced and ``n_chars``, if there, counted again."""
    at = documents.columns.index("text")

    def run(batches):
        for b in batches:
            yield b.set_column(at, b.schema.field(at), pa.array([masked(t.as_py()) for t in b.column(at)], b.schema.field(at).type))

    out = documents.mapInArrow(run, documents.schema)
    return out.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType)) if "n_chars" in documents.columns else out


def op1_offset_deobfuscation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans(table(spark, sf_dir, "documents"))
