"""Language of a text: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters are hashed. Document frequencies are counted over all labelled texts; weights are
fitted on a bounded sample by follow-the-regularised-leader with elastic-net penalties, and a temperature on a part of
it that the weights have not seen. Letters are folded only for ASCII; digits and ASCII punctuation read as blanks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch, held_out, id_text, table
from .words import LOWER, chunks, text_bytes

SIZE = 1 << 14
#: Bound of the labelled rows behind the fit (about).
SAMPLE = 5000
ALPHA, BETA, L1, L2, EPOCHS = 2.0, 1.0, 2e-4, 2e-4, 3
GROUP = 64
UNKNOWN = "und"
FOLD = LOWER.copy()
FOLD[[c for c in range(128) if not chr(c).isalpha()]] = 32


def counts(b: pa.RecordBatch):
    """Yields (first row, matrix): counts of hashed n-grams of a few texts at a time."""
    data, bounds = text_bytes(b.column("text"))
    i = 0
    while i < b.num_rows:
        j = max(i + 1, min(i + GROUP, int(np.searchsorted(bounds, bounds[i] + (1 << 20), "right")) - 1))
        raw = FOLD[data[bounds[i] : bounds[j]]]
        char = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        ends = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)][bounds[i : j + 1] - bounds[i]]
        row = np.repeat(np.arange(j - i), np.diff(ends))
        total = np.zeros((j - i) * SIZE, np.int64)
        h = np.zeros(len(char), np.uint32)
        for n in range(1, 4):
            if len(char) < n:
                break
            h = (h[: len(char) - n + 1] + char[n - 1 :] + np.uint32(n)) * np.uint32(0x9E3779B1)
            h = h ^ (h >> np.uint32(15))
            same = row[: len(h)] == row[n - 1 :]
            total += np.bincount(row[: len(h)][same] * SIZE + (h[same] * np.uint32(0x85EBCA6B) >> np.uint32(18)).astype(np.int64), minlength=(j - i) * SIZE)
        yield i, total.reshape(j - i, SIZE)
        i = j


def document_frequencies(rows: DataFrame) -> np.ndarray:
    """In how many texts each n-gram occurs; each task adds up its own."""

    def run(batches):
        total = np.zeros(SIZE, np.int64)
        for whole in batches:
            for b in chunks(whole):
                for _, c in counts(b):
                    total += (c > 0).sum(0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["feature", "n"])

    out = np.zeros(SIZE)
    for f, n in rows.select("text").mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n")).collect():  # at most SIZE rows
        out[f] = n
    return out


def sampled(rows: DataFrame, most: int) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Language, n-grams and counts of the ``most`` rows that come first by ``o``."""
    schema = pa.schema([("o", pa.int64()), ("lang", pa.string()), ("at", pa.binary()), ("n", pa.binary())])

    def run(batches):
        for whole in batches:
            for b in chunks(whole):
                at, n = [], []
                for _, c in counts(b):
                    for r in c:
                        k = np.flatnonzero(r)
                        at.append(k.astype(np.uint16).tobytes())
                        n.append(r[k].astype(np.uint32).tobytes())
                yield batch(schema, b.column("o"), b.column("lang"), at, n)

    found = rows.select("o", "lang", "text").mapInArrow(run, "o long, lang string, at binary, n binary").orderBy("o", "lang").limit(most).collect()
    return [(r["lang"], np.frombuffer(r["at"], np.uint16).astype(np.int64), np.frombuffer(r["n"], np.uint32).astype(float)) for r in found]


class Model:
    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.languages, self.idf, self.weights, self.bias, self.temperature = languages, idf, weights, bias, temperature

    def probabilities(self, c: np.ndarray) -> np.ndarray:
        x = np.log1p(c.astype(np.float32)) * self.idf
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        return softmax((x @ self.weights + self.bias) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(examples: list[tuple[int, np.ndarray, np.ndarray]], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias after a few passes of FTRL-proximal steps; the bias is feature SIZE and has no penalty."""
    z, n = np.zeros((SIZE + 1, classes)), np.zeros((SIZE + 1, classes))

    def current(at):
        s = z[at]
        free = (at == SIZE)[:, None]
        return -np.sign(s) * np.maximum(np.abs(s) - np.where(free, 0, L1), 0) / ((BETA + np.sqrt(n[at])) / ALPHA + np.where(free, 0, L2))

    for epoch in range(EPOCHS):
        for i in np.random.default_rng(epoch).permutation(len(examples)):
            y, at, x = examples[i]
            at, x = np.r_[at, SIZE], np.r_[x, 1.0]
            w = current(at)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = current(np.arange(SIZE + 1))
    return w[:-1], w[-1]


def learn(rows: DataFrame) -> Model:
    """rows (text, lang, and doc_id if there): all labelled texts with a language and some text.

    The sample is drawn by doc_id and text, so copies of a text under several ids are taken or left one by one. No more
    than twice SAMPLE rows, and 20 of each language, reach the driver, whatever repeats: beyond that the least by a hash
    stay.
    """
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.ones(SIZE), np.zeros((SIZE, 0)), np.zeros(0), 1.0)
    total = sum(sizes.values())
    df = document_frequencies(rows)
    idf = np.log((1 + total) / (1 + df)) + 1
    share, each = F.lit(0.0), max(20, SAMPLE // len(languages))
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, F.lit(min(1.0, each / n))).otherwise(share)
    order = F.xxhash64(*[c for c in ("doc_id", "text") if c in rows.columns], F.lit(13))
    drawn = rows.withColumn("o", order).filter(F.pmod("o", F.lit(1 << 20)) < share * (1 << 20))
    picked = sampled(drawn, 2 * max(SAMPLE, 20 * len(languages)))
    number = {name: i for i, name in enumerate(languages)}
    examples = []
    for name, at, n in picked:
        x = np.log1p(n) * idf[at]
        size = np.linalg.norm(x)
        if size:
            examples.append((number[name], at, x / size))
    examples.sort(key=lambda e: (e[0], len(e[1]), float(e[2][0])))  # the same order whatever the order of rows
    kept = [e for i, e in enumerate(examples) if i % 5 == 4] or examples
    w, bias = ftrl([e for i, e in enumerate(examples) if i % 5 != 4] or examples, len(languages))
    logits = np.array([x @ w[at] + bias for _, at, x in kept]).reshape(len(kept), len(languages))
    y = np.array([e[0] for e in kept], int)
    loss = lambda t: -np.log(np.maximum(softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() if len(y) else 0.0
    temperature = min((math.exp(t) for t in np.linspace(-3, 2, 101)), key=loss)
    return Model(languages, idf.astype(np.float32), w.astype(np.float32), bias.astype(np.float32), temperature)


OUT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def predicted(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score: the most likely language and its calibrated probability.

    A text that is null or has no letter is ``und`` with score 0, as is every text if no language was learned. Equal
    texts, repeated rows among them, get equal results; a very long one is read whole; of languages that are equally
    likely the first by name wins. A null doc_id stays; an empty table gives no rows. Other columns are not read,
    whatever their names.
    """

    def run(batches):
        for whole in batches:
            for b in chunks(whole):
                texts = b.column("text")
                for i, c in counts(b):
                    m = len(c)
                    p = model.probabilities(c) if model.languages else np.zeros((m, 1))
                    best = p.argmax(axis=1)
                    names, scores = [], []
                    for k in range(m):
                        text = texts[i + k].as_py()
                        ok = bool(model.languages) and bool(text) and any(map(str.isalpha, text))
                        names.append(model.languages[best[k]] if ok else UNKNOWN)
                        scores.append(min(1.0, float(p[k, best[k]])) if ok else 0.0)
                    yield batch(OUT, b.column("doc_id").slice(i, m), names, scores)

    return id_text(documents).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op6_ftrl_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, held = table(spark, sf_dir, "documents"), held_out("doc_id", 3, 1)
    labelled = documents.filter(~held & F.col("lang").isNotNull() & (F.length("text") > 0)).select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return predicted(documents, learn(labelled)).select("doc_id", held.alias("held_out"), "lang_pred", "score")
