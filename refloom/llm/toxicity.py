"""Toxicity by multiple-instance learning: a text is toxic if at least one of its sentences is.

Only documents carry labels. A sentence's score is logistic over its words and their beginnings; a document's is the noisy-or of
its sentences', 1 - prod(1 - p). The gradient of the document's loss reaches each sentence in proportion to its share
in that. The same sentence scores then point at the offending sentences.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, batch, held_out, id_text, table
from .words import LOWER, Words, chunks, mix

#: Bound of the labelled rows behind the fit: at most about this many of each class.
SAMPLE = 4000
#: Features: at least this many toxic texts, and this many standard errors more frequent in them; the best of those.
MIN_TEXTS, MIN_Z, FEATURES = 4, 5.0, 20_000
#: Beginnings of words, in bytes.
PREFIXES = (4, 5, 6, 7)
#: Lower case; ASCII punctuation separates words.
FOLD = LOWER.copy()
FOLD[[c for c in range(33, 127) if not chr(c).isalnum()]] = 32
STOP = np.zeros(256, bool)
STOP[[10, 33, 46, 63]] = True  # new line ! . ?


def sentences(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """The sentence of each word, numbered through all texts, and each text's first sentence (one empty one if it has no word)."""
    row = w.document()
    stop = np.flatnonzero(STOP[w.raw])
    part = np.searchsorted(stop, w.start)
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (part[1:] != part[:-1])
    number = np.cumsum(new) - 1
    count = np.bincount(row[new], minlength=len(w.counts))
    return number, np.r_[0, np.cumsum(count)]


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Names of words and of their beginnings, and the word of each."""
    names, word = [w.names], [np.arange(len(w.names))]
    for k in PREFIXES:
        at = np.flatnonzero(w.end - w.start > k)
        names.append(mix(w.named(w.start[at], w.start[at] + k) ^ np.uint64(k)))
        word.append(at)
    return np.concatenate(names), np.concatenate(word)


def pairs(group: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order."""
    order = np.lexsort((names, group))
    group, names = group[order], names[order]
    keep = np.ones(len(names), bool)
    keep[1:] = (names[1:] != names[:-1]) | (group[1:] != group[:-1])
    return group[keep], names[keep]


def chosen(rows: DataFrame, n: dict[int, int]) -> np.ndarray:
    """Features that are markedly more frequent in toxic texts, by counts over all of the sampled rows (text, y)."""
    schema = pa.schema([("feature", pa.int64()), ("toxic", pa.int64()), ("other", pa.int64())])

    def run(batches):
        for whole in batches:
            for b in chunks(whole):
                w = Words(b.column("text"), table=FOLD)
                names, word = features(w)
                row, names = pairs(w.document()[word], names)
                y = b.column("y").to_numpy()[row]
                known, at = np.unique(names, return_inverse=True)
                yield batch(schema, signed(known), np.bincount(at, y == 1, len(known)).astype(np.int64), np.bincount(at, y == 0, len(known)).astype(np.int64))

    counted = rows.select("text", "y").mapInArrow(run, "feature long, toxic long, other long").groupBy("feature").agg(F.sum("toxic").alias("a"), F.sum("other").alias("b")).filter(F.col("a") >= min(MIN_TEXTS, n[1]))
    share = (F.col("a") + F.col("b")) / (n[0] + n[1])
    z = (F.col("a") / n[1] - F.col("b") / n[0]) / F.sqrt(F.greatest(share * (1 - share), F.lit(1e-12)) * (1 / n[0] + 1 / n[1]))
    best = counted.withColumn("z", z).filter(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "feature").limit(FEATURES).select("feature").collect()
    return np.sort(np.array([r[0] for r in best], np.int64).view(np.uint64))


def training_rows(rows: DataFrame, known: np.ndarray) -> DataFrame:
    """y, the number of sentences, and pairs of a known feature and a sentence that has it."""
    schema = pa.schema([("y", pa.int32()), ("sentences", pa.int32()), ("feature", pa.binary()), ("sentence", pa.binary())])

    def run(batches):
        for whole in batches:
            for b in chunks(whole):
                w = Words(b.column("text"), table=FOLD)
                number, first = sentences(w)
                at, word = located(known, *features(w))
                s, at = pairs(number[word], at)
                cut = np.searchsorted(s, first)
                yield batch(schema, b.column("y"), np.diff(first).astype(np.int32), [at[i:j].astype(np.int32).tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)], [(s[i:j] - f).astype(np.int32).tobytes() for i, j, f in zip(cut[:-1], cut[1:], first[:-1], strict=True)])

    return rows.select("text", "y").mapInArrow(run, "y int, sentences int, feature binary, sentence binary")


def located(known: np.ndarray, names: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``known`` of the names that are there, and their words."""
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(known, names)
    at[at == len(known)] = 0
    hit = np.flatnonzero(known[at] == names)
    return at[hit], word[hit]


class Model:
    """Sorted feature names with their weights, and the bias."""

    def __init__(self, names: np.ndarray, weights: np.ndarray, bias: float):
        self.names, self.weights, self.bias = names, weights, bias

    def sentence_scores(self, w: Words, number: np.ndarray, n: int) -> np.ndarray:
        """Logits. A feature counts once in a sentence."""
        at, word = located(self.names, *features(w))
        s, at = pairs(number[word], at)
        return self.bias + np.bincount(s, self.weights[at] if len(at) else None, minlength=n)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(known: np.ndarray, rows: list[tuple[int, int, bytes, bytes]], prior: float, steps: int = 200, shrink: float = 1e-3) -> Model:
    """Noisy-or likelihood by Adam steps over all sampled texts, with weights drawn towards 0. prior: share of toxic rows among all labelled."""
    if not rows or not 0 < sum(r[0] for r in rows) < len(rows):
        always = bool(rows) and rows[0][0] == 1
        return Model(known[:0], np.zeros(0), 40.0 if always else -40.0)
    rows = sorted(rows)  # the same order whatever the order of the table
    y = np.array([r[0] for r in rows], float)
    per_text = np.maximum(np.array([r[1] for r in rows]), 1)
    begin = np.r_[0, np.cumsum(per_text)]
    at = np.concatenate([np.frombuffer(r[2], np.int32) for r in rows]).astype(np.int64)
    sentence = np.concatenate([np.frombuffer(r[3], np.int32).astype(np.int64) + b for r, b in zip(rows, begin, strict=False)])
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    weight /= weight.sum()
    w = np.zeros(len(known) + 1)
    w[-1] = np.log(prior / (1 - prior)) - np.log(per_text.mean()) - 2
    m, v = np.zeros_like(w), np.zeros_like(w)
    row = np.repeat(np.arange(len(y)), per_text)
    for step in range(1, steps + 1):
        p = sigmoid(w[-1] + np.bincount(sentence, w[at] if len(at) else None, minlength=begin[-1]))
        none = np.exp(np.maximum(np.add.reduceat(np.log1p(-np.minimum(p, 1 - 1e-12)), begin[:-1]), -60))
        pull = np.where(y == 1, -none / np.maximum(1 - none, 1e-12), 1.0) * weight
        g_s = pull[row] * p
        g = np.r_[np.bincount(at, g_s[sentence] if len(at) else None, minlength=len(known)), g_s.sum()]
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        rate = 0.1
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-5)
        w[:-1] = np.sign(w[:-1]) * np.maximum(np.abs(w[:-1]) - shrink * 10 * rate, 0)
    used = np.flatnonzero(np.abs(w[:-1]) > 1e-3)
    return Model(known[used], w[:-1][used], float(w[-1]))


def learn(spark: SparkSession, documents: DataFrame, labels: DataFrame, allowed=None) -> Model:
    """Fits on labelled documents. Several labels of one document: toxic if any says so. Null labels are left out.

    Of several texts with one doc_id the least counts, so the sample's bound holds whatever repeats.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)")
    if allowed is not None:
        marked = marked.filter(allowed)
    marked = marked.groupBy("doc_id").agg(F.max("y").alias("y"))
    n = {r["y"]: r["count"] for r in marked.groupBy("y").count().collect()}
    if len(n) < 2:
        return fit(np.zeros(0, np.uint64), [(k, 1, b"", b"") for k in n], float(sum(n)))
    share = F.lit(1.0)
    for k, c in n.items():
        share = F.when(F.col("y") == k, F.lit(min(1.0, SAMPLE / c))).otherwise(share)
    sample = marked.filter(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) < share * (1 << 20))
    # about SAMPLE ids of each class, and one text of each: an id may have very many rows
    rows = id_text(documents).join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"))
    rows = Scratch(spark, "toxicity").save(rows.select("text", "y"))
    size = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if len(size) < 2:
        return fit(np.zeros(0, np.uint64), [(k, 1, b"", b"") for k in size], float(sum(size)))
    known = chosen(rows, size)
    return fit(known, [tuple(r) for r in training_rows(rows, known).collect()], n[1] / sum(n.values()))


OUT = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32()), ("offending", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))])
OUT_DDL = "doc_id long, score double, predicted int, offending array<struct<start:long,end:long,score:double>>"


def text_scores(w: Words, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Noisy-or of each text's sentences; the sentence of each word; each text's first sentence; each sentence's score."""
    number, first = sentences(w)
    p = sigmoid(model.sentence_scores(w, number, int(first[-1])))
    score = np.full(len(first) - 1, float(sigmoid(np.array([model.bias]))[0]))
    some = np.flatnonzero(np.diff(first) > 0)
    if len(some):  # a text's own sum: the same wherever it stands in a batch
        score[some] = 1 - np.exp(np.add.reduceat(np.log1p(-np.minimum(p, 1 - 1e-12)), first[:-1][some]))
    return np.clip(score, 0, 1), number, first, p


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted and, where toxic, the sentences that say so (code points, from first to last word)."""

    def run(batches):
        for whole in batches:
            for b in chunks(whole):
                w = Words(b.column("text"), table=FOLD)
                score, number, first, p = text_scores(w, model)
                begin = np.searchsorted(number, np.arange(len(p) + 1))
                found = []
                for i in range(b.num_rows):
                    spans = None
                    if score[i] >= 0.5:
                        s = np.arange(first[i], first[i + 1])
                        s = s[p[s] >= 0.5] if (p[s] >= 0.5).any() or not len(s) else s[[int(np.argmax(p[s]))]]
                        at = int(w.bounds[i])
                        chars = np.r_[0, np.cumsum((w.raw[at : int(w.bounds[i + 1])] & 0xC0) != 0x80)]
                        spans = [{"start": int(chars[w.start[begin[k]] - at]), "end": int(chars[w.end[begin[k + 1] - 1] - at]), "score": float(p[k])} for k in s.tolist()]
                    found.append(spans)
                yield batch(OUT, b.column("doc_id"), score, (score >= 0.5).astype(np.int32), found)

    return id_text(documents).mapInArrow(run, OUT_DDL)


def accepted(documents: DataFrame, model: Model) -> DataFrame:
    """The documents, all columns, without the toxic ones."""

    def run(batches):
        for whole in batches:
            for b in chunks(whole):
                w = Words(b.column("text"), table=FOLD)
                yield b.filter(pa.array(text_scores(w, model)[0] < 0.5))

    return documents.mapInArrow(run, documents.schema)


def toxicity(spark: SparkSession, documents: DataFrame, labels: DataFrame, allowed=None) -> DataFrame:
    """documents, labels (doc_id, toxic) -> doc_id, score, predicted, offending; one row a document.

    A null or empty text, or one of punctuation alone, has no sentence and gets the score of a sentence without known
    words. A very long text is read whole, and a text's score does not depend on its neighbours. Repeated rows get equal
    scores; a null doc_id stays, and labels with one are left out. Without labels, or with labels of one kind only, all
    scores are that of the kind seen (0 without any). An empty table gives no rows. Other columns are not read, whatever
    their names.
    """
    return scored(documents, learn(spark, documents, labels, allowed))


def op9_multiple_instance_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = held_out("doc_id", 5, 0)
    out = toxicity(spark, documents, labels, ~held)
    return out.select("doc_id", held.alias("held_out"), "score", "predicted", F.array_join(F.transform("offending", lambda x: F.concat_ws(":", x["start"], x["end"])), ",").alias("sentences"))
