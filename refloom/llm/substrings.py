"""Removal of long repeated word sequences by recompression.

Rounds of pair compression name adjacent symbols: a fixed bit of each name makes it a left or a right one, and
every left-right pair becomes one symbol named by its two parts. Names are functions of content alone, so all
tasks agree on them without exchanging tables. Each symbol carries the words on which its existence depends; a
symbol whose dependence lies within a window is the same in every occurrence of that window. Each window is
represented by one such symbol, and neighbouring windows with the same one form a segment. A run of segments with
one name is one row. Symbols found in two documents reveal candidates; equal segments, and at the borders of
repeats single windows, are then verified by 128-bit names of their full word sequences.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, batch, id_text, table
from .words import U, Words, chunks, content, mix, prefix_sums

WINDOW = 13
ROUNDS = 3
#: A symbol that depends on at least so many words stands for a window rather than one that depends on fewer: it is rarer.
LONG = 6


def recompress(names: np.ndarray, bounds: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after the rounds: name, first and last word on which each depends.

    Beyond a text's ends nothing is known: a symbol that looks there depends on a word before or after all of its
    text's, which no window holds. Both dependence bounds never fall from one symbol to the next within a text.
    """
    low = np.arange(len(names), dtype=np.int64)
    high = low.copy()
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    name = names
    for k in range(rounds):
        n = len(name)
        if n == 0:
            break
        left = (mix(name ^ U(k + 0x1234567)) & U(1)).astype(bool)
        joins = np.zeros(n, bool)  # the symbol and its next become a pair
        joins[:-1] = left[:-1] & ~left[1:] & (row[:-1] == row[1:])
        second = np.zeros(n, bool)
        second[1:] = joins[:-1]
        # an unpaired left symbol has seen its next, an unpaired right one its previous
        last, begin = np.ones(n, bool), np.ones(n, bool)
        last[:-1] = begin[1:] = row[:-1] != row[1:]
        far = np.empty(n, np.int64)
        far[:-1] = high[1:]
        far[last] = bounds[row[last] + 1]
        near = np.empty(n, np.int64)
        near[1:] = low[:-1]
        near[begin] = bounds[row[begin]] - 1
        new_low = np.where(~joins & ~left, near, low)
        new_high = np.where(~joins & left, far, high)
        at = np.flatnonzero(joins)
        name = name.copy()
        name[at] = mix(name[at] * U(0xC2B2AE3D27D4EB4F) ^ name[at + 1] ^ U(k + 1))
        new_high[at] = high[at + 1]
        keep = ~second
        name, low, high, row = name[keep], new_low[keep], new_high[keep], row[keep]
    return name, low, high


def least_in_ranges(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Index of the least (the first, of equals) of values[start:end], for non-empty ranges."""
    order = np.empty(len(values), np.int64)
    order[np.argsort(values, kind="stable")] = np.arange(len(values))
    length = end - start
    power = np.frexp(length.astype(float))[1] - 1
    out = np.empty(len(start), np.int64)
    level = order
    for p in range(int(power.max()) + 1 if len(power) else 0):
        if p:
            half = 1 << (p - 1)
            level = np.minimum(level[:-half], level[half:])
        at = power == p
        out[at] = np.minimum(level[start[at]], level[end[at] - (1 << p)])
    place = np.empty(len(values), np.int64)
    place[order] = np.arange(len(values))
    return place[out]


class Windows:
    """All windows of a chunk of texts: row, position in the text, name of the whole window, name of its symbol."""

    def __init__(self, names: np.ndarray, bounds: np.ndarray):
        self.sums = sums = prefix_sums(names)
        counts = np.diff(bounds)
        per_row = np.maximum(counts - WINDOW + 1, 0)
        self.row = np.repeat(np.arange(len(counts)), per_row)
        begin = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(per_row, out=begin[1:])
        self.place = np.arange(begin[-1]) - begin[self.row]
        self.word = self.place + bounds[self.row]
        symbol, low, high = recompress(names, bounds)
        start = np.searchsorted(low, self.word, "left")
        end = np.searchsorted(high, self.word + WINDOW - 1, "right")
        inside = end > start
        # by the words on which a symbol depends, it is rare; the symbol's own name tells apart what depends alike
        clipped = np.clip(low, 0, len(names)), np.clip(high + 1, 0, len(names))
        key = mix(content(sums, clipped[0], np.maximum(*clipped)) ^ symbol)
        self.symbol = np.empty(len(self.word), U)
        self.at = np.full(len(self.word), -1, np.int64)
        order = np.where(high - low + 1 < LONG, U(1 << 63), U(0)) | (key >> U(1))
        self.at[inside] = least_in_ranges(order, start[inside], end[inside])
        self.symbol[inside] = key[self.at[inside]]
        rest = ~inside  # only where no symbol depends on the window alone: the window stands for itself
        self.symbol[rest] = mix(content(sums, self.word[rest], self.word[rest] + WINDOW) ^ U(0x5BD1E995))

    def segments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First window, number of windows and name of each maximal run of windows with one symbol."""
        n = len(self.word)
        new = np.ones(n, bool)
        new[1:] = (self.row[1:] != self.row[:-1]) | (self.at[1:] != self.at[:-1]) | (self.at[1:] < 0)
        first = np.flatnonzero(new)
        size = np.diff(np.r_[first, n])
        name = content(self.sums, self.word[first], self.word[first] + size + WINDOW - 1)
        # a run of segments with one name (one word again and again) is one row
        if len(first):
            run = np.ones(len(first), bool)
            run[1:] = (name[1:] != name[:-1]) | (self.symbol[first[1:]] != self.symbol[first[:-1]]) | (self.row[first[1:]] != self.row[first[:-1]])
            keep = np.flatnonzero(run)
            size, first, name = np.add.reduceat(size, keep), first[keep], name[keep]
        return first, size, name

    def names(self, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The windows of the given segments, and the name of each."""
        w = np.repeat(first, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        return w, content(self.sums, self.word[w], self.word[w] + WINDOW)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


SEGMENTS = pa.schema([("symbol", pa.int64()), ("segment", pa.int64()), ("doc_id", pa.int64()), ("part", pa.int32()), ("span", pa.int64())])
DDL = "symbol long, segment long, doc_id long, part int, span long"


def packed(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The first window and the number of windows in one number."""
    return first << 32 | size


def spans_of(values: list[int] | None) -> np.ndarray:
    """Rows of (first, size)."""
    x = np.array(values or [], np.int64)
    return np.stack([x >> 32, x & 0xFFFFFFFF], axis=1)


def segment_rows(rows: DataFrame) -> DataFrame:
    def run(batches):
        for whole in batches:
            for b in chunks(whole):
                words = Words(b.column("text"))
                w = Windows(words.names, words.first)
                first, size, name = w.segments()
                row = w.row[first]
                yield batch(SEGMENTS, signed(w.symbol[first]), signed(name), b.column("doc_id").take(pa.array(row)), b.column("part").take(pa.array(row)), packed(w.place[first], size))

    return rows.filter("doc_id is not null").mapInArrow(run, DDL)


STATE = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("n_words", pa.int64()), ("removed", pa.binary()), ("text", pa.string()), ("windows", pa.list_(pa.struct([("symbol", pa.int64()), ("name", pa.int64()), ("place", pa.int32())]))), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
STATE_DDL = "doc_id long, part int, n_words long, removed binary, text string, windows array<struct<symbol:long,name:long,place:int>>, n_removed long, kept_sha256 string"


def kept_words(text: str | None, removed: np.ndarray) -> str:
    words = (text or "").encode().split()
    if removed.any():
        words = compress(words, (~removed).tolist())
    return hashlib.sha256(b" ".join(words)).hexdigest()


def covered(n: int, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which of n words lie in windows first .. first + size - 1."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + size + WINDOW - 1, -1)
    return np.cumsum(edge[:n]) > 0


def applied(rows: DataFrame) -> DataFrame:
    """Takes rows with ``known`` (repeated segments) and ``open`` (their windows must still be looked up)."""

    def run(batches):
        for whole in batches:
            for b in chunks(whole):
                words = Words(b.column("text"))
                known, later = b.column("known"), b.column("open")
                ask = [i for i in range(b.num_rows) if later[i].is_valid and len(later[i])]
                windows = {}
                if ask:
                    some = np.zeros(b.num_rows, bool)
                    some[ask] = True
                    sub = Windows(words.names[np.repeat(some, words.counts)], np.r_[0, np.cumsum(words.counts[some])])
                    begin = np.searchsorted(sub.row, np.arange(len(ask)))
                    for j, i in enumerate(ask):
                        spans = spans_of(later[i].as_py())
                        at, name = sub.names(spans[:, 0] + begin[j], spans[:, 1])
                        windows[i] = pa.StructArray.from_arrays([pa.array(signed(sub.symbol[at])), pa.array(signed(name)), pa.array(sub.place[at].astype(np.int32))], ["symbol", "name", "place"]).to_pylist()
                out = []
                for i in range(b.num_rows):
                    n, text = int(words.counts[i]), b.column("text")[i].as_py()
                    spans = spans_of(known[i].as_py())
                    removed = covered(n, spans[:, 0], spans[:, 1]) if len(spans) else np.zeros(n, bool)
                    wait = i in windows
                    out.append((n, np.packbits(removed).tobytes() if wait else None, text if wait else None, windows.get(i), int(removed.sum()), None if wait else kept_words(text, removed)))
                yield batch(STATE, b.column("doc_id"), b.column("part"), *(list(c) for c in zip(*out, strict=True)))

    return rows.mapInArrow(run, STATE_DDL)


RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def finished(rows: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            out = []
            for n, bits, text, places in zip(b.column("n_words").to_pylist(), b.column("removed").to_pylist(), b.column("text").to_pylist(), b.column("places").to_pylist(), strict=True):
                removed = np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
                if places:
                    p = np.array(places, np.int64)
                    removed |= covered(n, p, np.ones(len(p), np.int64))
                out.append((n, int(removed.sum()), kept_words(text, removed)))
            if out:
                yield batch(RESULT, b.column("doc_id"), *(list(c) for c in zip(*out, strict=True)))

    return rows.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def numbered(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Rows with ``part``: 0, but a number by text where several rows have one doc_id."""
    rows = id_text(documents)
    twice = rows.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if not twice.limit(1).count():
        return rows.withColumn("part", F.lit(0))
    parts = rows.join(twice, "doc_id", "left_semi").select("doc_id", F.xxhash64("text").alias("h")).distinct()
    return rows.withColumn("h", F.xxhash64("text")).join(parts.withColumn("part", (F.col("h") % 2_000_000_000).cast("int")), ["doc_id", "h"], "left").withColumn("part", F.coalesce("part", F.lit(0))).drop("h")


def repeats_removed(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """documents (doc_id, text) -> doc_id, n_words, n_removed, kept_sha256.

    A word goes if a window of 13 words that covers it also starts in a document with a smaller doc_id. A null or
    empty text has no words; texts of fewer than 13 keep all. Rows with one doc_id do not remove one another's
    words, and repeated rows give repeated results. A row with a null doc_id neither loses words nor takes any from
    others. An empty table gives no rows.
    """
    scratch = Scratch(spark, "substrings")
    rows = numbered(spark, documents)
    segments = scratch.save(segment_rows(rows))
    bounds = segments.groupBy("symbol").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most").select("symbol", "least")
    shared = scratch.save(segments.join(bounds.hint("shuffle_hash"), "symbol"))
    scratch.drop(segments)
    scratch.release()
    first = shared.groupBy("symbol", "segment").agg(F.min("doc_id").alias("owner"))
    shared_old, shared = shared, scratch.save(shared.join(first.hint("shuffle_hash"), ["symbol", "segment"]))
    scratch.drop(shared_old)
    scratch.release()
    # A segment seen first here, of a symbol seen before: some of its windows may have been seen.
    contested = shared.filter("doc_id = owner and doc_id > least").select("symbol").distinct()
    asked = shared.filter("doc_id = owner").join(contested, "symbol", "left_semi")
    spans = shared.filter("doc_id > owner").select("doc_id", "part", F.col("span").alias("known"), F.lit(None).cast("long").alias("open"))
    spans = spans.unionByName(asked.select("doc_id", "part", F.lit(None).cast("long").alias("known"), F.col("span").alias("open")))
    by_document = spans.groupBy("doc_id", "part").agg(F.collect_list("known").alias("known"), F.collect_list("open").alias("open"))  # at most a document's own segments
    state = scratch.save(applied(rows.join(by_document.hint("shuffle_hash"), ["doc_id", "part"], "left").select("doc_id", "part", "text", "known", "open")))
    scratch.drop(shared)
    scratch.release()
    windows = state.filter("windows is not null").select("doc_id", "part", F.explode("windows").alias("w")).select("doc_id", "part", "w.*")
    owners = windows.groupBy("symbol", "name").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("most")).filter("owner < most").drop("most")
    seen = windows.join(owners, ["symbol", "name"]).filter("doc_id > owner").groupBy("doc_id", "part").agg(F.collect_list("place").alias("places"))
    rest = state.filter("windows is not null").select("doc_id", "part", "n_words", "removed", "text").join(seen, ["doc_id", "part"], "left")
    return state.filter("windows is null").select("doc_id", "n_words", "n_removed", "kept_sha256").unionByName(finished(rest.select("doc_id", "n_words", "removed", "text", "places")))


def op3_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_removed(spark, table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS a FROM documents),
w AS (
  SELECT doc_id, unnest(range(1, len(a) - 11)) AS i, unnest(list_transform(range(1, len(a) - 11), lambda i: array_to_string(a[i:i + 12], ' '))) AS g
  FROM d WHERE len(a) >= 13),
m AS (SELECT g, min(doc_id) AS o FROM w GROUP BY g HAVING min(doc_id) < max(doc_id)),
x AS (SELECT DISTINCT w.doc_id, unnest(range(w.i, w.i + 13)) AS j FROM w JOIN m ON w.g = m.g WHERE w.doc_id > m.o),
r AS (SELECT doc_id, list(j) AS js FROM x GROUP BY doc_id)
SELECT d.doc_id, len(d.a)::BIGINT AS n_words, coalesce(len(r.js), 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN r.js IS NULL THEN d.a ELSE list_transform(list_filter(range(1, len(d.a) + 1), lambda i: NOT list_contains(r.js, i)), lambda i: d.a[i]) END, ' '), '')) AS kept_sha256
FROM d LEFT JOIN r ON r.doc_id = d.doc_id
"""
