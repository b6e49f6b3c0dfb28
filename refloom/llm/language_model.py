"""Class-based n-gram scores: Brown classes by exchange clustering.

Every word of the training texts is a type. The exchange algorithm first moves the most frequent words, and the others
in bounded groups by their last letters, between classes while the likelihood of the class bigrams grows. From there
every other word is moved by itself to the class of the greatest gain, which its own counts of classes before and after
it give; the groups are only where it starts, and where a word that no training text has stays. A word's probability is
that of its class after the class before it, times that of the word in its class. All counts are over every training
text. Counts and classes of the most frequent words go to the tasks as one bounded table; those of all others are
joined by the word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, batch, held_out, id_text, partitions, table
from .words import Words, chunks, mix

HEAD = 767  # words that the first exchange moves one by one, besides the end
GROUPS = 128
CLASSES = 48
LOOKUP = 65_536  # words whose counts and classes every task has
PASSES = 3
FLUSH = 400_000
SMALL = 16  # counts whose gains are looked up
SELF = CLASSES  # in a context: the word itself
RARE = 255  # in a context: a word whose class is not in the bounded table
END = np.int64(0x0E7D0E7D0E7D0E7D)
#: What a text's known tokens give, as bytes beside its other tokens.
DOC = np.dtype([("none", "?"), ("doc_id", "<i8"), ("n_tokens", "<i8"), ("n_known", "<i8"), ("base", "<f8"), ("model", "<f8")])


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def groups(w: Words) -> np.ndarray:
    """Group of each word by its last three bytes."""
    start = np.maximum(w.end - 3, w.start)
    code = np.zeros(len(start), np.uint64)
    for k in range(3):
        code = code * np.uint64(257) + np.where(start + k < w.end, w.data[np.minimum(start + k, len(w.data) - 1)], 0).astype(np.uint64) if len(start) else code
    return (mix(code + np.uint64(1)) % np.uint64(GROUPS)).astype(np.int64)


def word_counts(rows: DataFrame) -> DataFrame:
    """word, grp, n over all rows; each task adds up its own first, in bounded tables."""
    schema = pa.schema([("word", pa.int64()), ("grp", pa.int32()), ("n", pa.int64())])

    def run(batches):
        words, kinds, n, held = [], [], [], 0
        for whole in batches:
            for b in chunks(whole):
                w = Words(b.column("text"), lower=True)
                known, first, count = np.unique(signed(w.names), return_index=True, return_counts=True)
                words += [known, np.array([END])]
                kinds += [groups(w)[first], np.array([0])]
                n += [count, np.array([b.num_rows])]
                held += len(known)
                if held > FLUSH:
                    yield batch(schema, *merged(words, kinds, n))
                    words, kinds, n, held = [], [], [], 0
        if words:
            yield batch(schema, *merged(words, kinds, n))

    return rows.select("text").mapInArrow(run, "word long, grp int, n long").groupBy("word").agg(F.min("grp").alias("grp"), F.sum("n").alias("n"))


def merged(words: list, kinds: list, n: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    known, first, at = np.unique(np.concatenate(words), return_index=True, return_inverse=True)
    return known, np.concatenate(kinds)[first].astype(np.int32), np.bincount(at, np.concatenate(n), len(known)).astype(np.int64)


class Types:
    """Numbers of word types: frequent words (sorted names), the end, and then groups."""

    def __init__(self, head: np.ndarray):
        self.head = np.sort(head)
        self.end = len(head)
        self.count = len(head) + 1 + GROUPS

    def of(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Type of each token, each text's words and then its end, and where each text begins."""
        at, found = place(self.head, signed(w.names))
        kind = np.where(found, at, self.end + 1 + groups(w))
        first = w.first + np.arange(len(w.first))
        out = np.full(first[-1], self.end, np.int64)
        out[np.arange(len(kind)) + w.document()] = kind
        return out, first


def place(known: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(known):
        return np.zeros(len(names), np.int64), np.zeros(len(names), bool)
    at = np.searchsorted(known, names)
    at[at == len(known)] = 0
    return at, known[at] == names


def before(tokens: np.ndarray, first: np.ndarray, end: int) -> np.ndarray:
    """The type before each; a text begins after an end."""
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    if len(first) > 1:
        out[first[:-1]] = end
    return out


def bigrams(rows: DataFrame, types: Types) -> np.ndarray:
    """Counts of pairs of types: a table of fixed size, added up by each task."""
    size = types.count

    def run(batches):
        total = np.zeros(size * size, np.int64)
        for whole in batches:
            for b in chunks(whole):
                t, first = types.of(Words(b.column("text"), lower=True))
                total += np.bincount(before(t, first, types.end) * size + t, minlength=size * size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    found = rows.select("text").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()  # at most count**2 rows
    out = np.zeros(size * size)
    out[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(size, size)


def entropy(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray, classes: int = CLASSES, passes: int = PASSES) -> np.ndarray:
    """Class of each type. Each pass moves every type to the class where the likelihood of class bigrams is greatest."""
    n = len(pairs)
    weight = pairs.sum(0) + pairs.sum(1)
    order = np.argsort(-weight, kind="stable")
    cls = np.empty(n, np.int64)
    cls[order] = np.arange(n) % classes
    onto = np.eye(classes)[cls]
    table_ = onto.T @ pairs @ onto
    for _ in range(passes):
        moved = False
        for t in order.tolist():
            if weight[t] == 0:
                continue
            old = cls[t]
            own = pairs[t, t]
            row = np.bincount(cls, pairs[t], classes)
            col = np.bincount(cls, pairs[:, t], classes)
            row[old] -= own
            col[old] -= own
            table_[old] -= row
            table_[:, old] -= col
            table_[old, old] -= own
            # gain of each class k: its row, its column and its corner change, and its totals
            r, c = table_, table_.T
            gain = (entropy(r + row) - entropy(r)).sum(1) + (entropy(c + col) - entropy(c)).sum(1)
            corner = np.diag(table_)
            gain += entropy(corner + row + col + own) - entropy(corner) - (entropy(corner + row) - entropy(corner)) - (entropy(corner + col) - entropy(corner))
            out, into = table_.sum(1) + col, table_.sum(0) + row
            gain -= entropy(out + row.sum() + own) - entropy(out) + entropy(into + col.sum() + own) - entropy(into)
            best = int(np.argmax(np.round(gain, 6)))
            cls[t] = best
            moved |= best != old
            table_[best] += row
            table_[:, best] += col
            table_[best, best] += own
        if not moved:
            break
    return cls


def contexts(rows: DataFrame, types: Types, cls: np.ndarray) -> DataFrame:
    """word, ctx, n of all words but the head: its class so far, and the class (or SELF) before and after it, in one number."""
    schema = pa.schema([("word", pa.int64()), ("ctx", pa.int32()), ("n", pa.int64())])

    def run(batches):
        held, size = [], 0
        for whole in batches:
            for b in chunks(whole):
                w = Words(b.column("text"), lower=True)
                t, _ = types.of(w)
                c, where, names = cls[t], np.arange(len(w.names)) + w.document(), np.full(len(t), END)
                names[where] = signed(w.names)
                where = where[t[where] > types.end]
                word = names[where]
                left = np.where((names[where - 1] == word) & (where > 0), SELF, np.where(where > 0, c[where - 1], cls[types.end]))
                right = np.where(names[where + 1] == word, SELF, c[where + 1])
                held.append(tallied(word, (c[where] * (SELF + 1) + left) * (SELF + 1) + right, np.ones(len(word), np.int64)))
                size += len(held[-1][0])
                if size > FLUSH:
                    yield batch(schema, *tallied(*(np.concatenate(x) for x in zip(*held, strict=True))))
                    held, size = [], 0
        if held:
            yield batch(schema, *tallied(*(np.concatenate(x) for x in zip(*held, strict=True))))

    return rows.select("text").mapInArrow(run, "word long, ctx int, n long")


def tallied(word: np.ndarray, ctx: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((ctx, word))
    word, ctx, n = word[order], ctx[order], n[order]
    new = np.ones(len(word), bool)
    new[1:] = (word[1:] != word[:-1]) | (ctx[1:] != ctx[:-1])
    first = np.flatnonzero(new)
    return word[first], ctx[first].astype(np.int32), np.add.reduceat(n, first) if len(first) else n


class Gains:
    """Exchange of many words, each by itself, against one table of class bigrams."""

    def __init__(self, after: np.ndarray):
        self.after, self.both = after, np.stack([after.T, after])  # both[side][c]: with the class c after each class, before each class
        self.total = np.stack([after.sum(1), after.sum(0)])
        steps = np.arange(SMALL + 1)[:, None, None, None]
        self.small = entropy(self.both + steps) - entropy(self.both)
        self.entropy = entropy(self.both)

    def best(self, word: np.ndarray, ctx: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words in order -> each word once, its class, its count. The word is first taken out of its class so far."""
        k = SELF
        new = np.ones(len(word), bool)
        new[1:] = word[1:] != word[:-1]
        first, g = np.flatnonzero(new), np.cumsum(new) - 1
        size = len(first)
        old, left, right = ctx[first] // (k + 1) ** 2, ctx // (k + 1) % (k + 1), ctx % (k + 1)
        grid = lambda at, keep: np.bincount((g * (k + 1) + at)[keep], n[keep], size * (k + 1)).reshape(size, k + 1)
        every = np.ones(len(n), bool)
        row, col = grid(right, every), grid(left, every)
        own, count = row[:, k].copy(), row.sum(1)
        row, col = row[:, :k], col[:, :k]
        i, gain = np.arange(size), np.zeros((size, k))
        for side, x in enumerate((row, col)):
            y = (col, row)[side]
            at, c = np.nonzero(x)
            many = x[at, c]
            add = np.empty((len(at), k))
            few = many <= SMALL
            add[few] = self.small[many[few].astype(np.int64), side, c[few]]
            base = self.both[side][c[~few]]
            add[~few] = entropy(base + many[~few, None]) - self.entropy[side][c[~few]]
            where = old[at]  # there its own counts are taken out first
            was = self.both[side][c, where]
            inner = was - many - np.where(c == where, y[at, c] + own[at], 0)
            add[np.arange(len(at)), where] = entropy(inner + many) - entropy(inner)
            starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, np.int64)
            if len(starts):
                gain[at[starts]] += np.add.reduceat(add, starts)
            # the old class is without the word where it stands beside each other class, too
            beside, mine = self.both[side][old], x[i, old][:, None]
            less = beside - y
            fix = entropy(less + mine) - entropy(less) - entropy(beside + mine) + self.entropy[side][old]
            fix[i, old] = 0
            gain += fix
            out = np.repeat(self.total[side][None], size, 0)
            out[i, old] -= count
            gain -= entropy(out + count[:, None]) - entropy(out)
        corner = np.repeat(np.diag(self.after)[None], size, 0)
        corner[i, old] -= row[i, old] + col[i, old] + own
        gain += entropy(corner + row + col + own[:, None]) + entropy(corner) - entropy(corner + row) - entropy(corner + col)
        return word[first], np.argmax(np.round(gain, 6), 1), count


def word_classes(rows: DataFrame, types: Types, cls: np.ndarray, after: np.ndarray, parts: int) -> DataFrame:
    """word, cls, n of every word but the head."""
    schema = pa.schema([("word", pa.int64()), ("cls", pa.int32()), ("n", pa.int64())])
    exchanged = Gains(after)

    def run(batches):
        held, size = [], 0
        for b in batches:
            held.append([b.column(i).to_numpy() for i in range(3)])
            size += b.num_rows
            if size > FLUSH:
                word, ctx, n = (np.concatenate(x) for x in zip(*held, strict=True))
                cut = int(np.searchsorted(word, word[-1]))  # the last word may go on
                held, size = [[word[cut:], ctx[cut:], n[cut:]]], len(word) - cut
                yield from settled(word[:cut], ctx[:cut], n[:cut])
        if size:
            yield from settled(*(np.concatenate(x) for x in zip(*held, strict=True)))

    def settled(word, ctx, n):
        a = 0
        while a < len(word):
            b = int(np.searchsorted(word, word[min(a + 8192, len(word)) - 1], "right"))
            yield batch(schema, *(x.astype(t) for x, t in zip(exchanged.best(word[a:b], ctx[a:b], n[a:b]), (np.int64, np.int32, np.int64), strict=True)))
            a = b

    return contexts(rows, types, cls).repartition(parts, "word").sortWithinPartitions("word").mapInArrow(run, "word long, cls int, n long")


class Known:
    """Counts and classes of the end and the most frequent words; where other words start."""

    def __init__(self, types: Types, cls: np.ndarray, words: list[tuple[int, int, int]], end_n: int):
        words = sorted(words)
        self.names, self.cls, self.n = (np.array([w[i] for w in words], np.int64) for i in range(3))
        self.start, self.end, self.end_n = cls[types.end + 1 :], int(cls[types.end]), end_n

    def of(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class (or RARE) and count of each token, each text's words and then its end, and where each text begins."""
        at, found = place(self.names, signed(w.names))
        first = w.first + np.arange(len(w.first))
        c, n = np.full(first[-1], self.end, np.int64), np.full(first[-1], self.end_n, np.int64)
        where = np.arange(len(at)) + w.document()
        c[where] = np.where(found, self.cls[at], RARE) if len(self.cls) else RARE
        n[where] = np.where(found, self.n[at], 0) if len(self.n) else 0
        return c, n, first


def rare_tokens(b: pa.RecordBatch, known: Known) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, name and ``at`` of each token that is not known; ``at`` has the place, and the classes where it starts, before and after."""
    w = Words(b.column("text"), lower=True)
    c, _, first = known.of(w)
    row = w.document()
    where = np.arange(len(row)) + row
    rare = np.flatnonzero(c[where] == RARE)
    where, row = where[rare], row[rare]
    at = (((where - first[row]) << 8 | known.start[groups(w)[rare]]) << 8 | before(c, first, known.end)[where]) << 8 | c[where + 1]
    return row, signed(w.names)[rare], at


def settled_words(found: DataFrame, words: DataFrame | None, parts: int) -> DataFrame:
    """found (rid, word, at, ...) with the class and the count of each word, by row and place.

    A word that no training text has keeps the class of its group and a count of 0.
    """
    start, rest = F.shiftright("at", 16).bitwiseAND(255), [c for c in found.columns if c not in ("rid", "word", "at")]
    if words is None:
        found = found.select("rid", "at", start.cast("int").alias("cls"), F.lit(0).cast("long").alias("n"), *rest)
    else:
        found = found.join(words.hint("shuffle_hash"), "word", "left").select("rid", "at", F.coalesce("cls", start).cast("int").alias("cls"), F.coalesce("n", F.lit(0)).cast("long").alias("n"), *rest)
    return found.repartition(parts, "rid").sortWithinPartitions("rid", "at")


def rare_words(rows: DataFrame, known: Known, words: DataFrame | None, parts: int) -> DataFrame:
    """rid, at, cls, n of each token that is not known, by row and place."""
    schema = pa.schema([("rid", pa.int64()), ("word", pa.int64()), ("at", pa.int64())])

    def run(batches):
        for whole in batches:
            for b in chunks(whole):
                row, word, at = rare_tokens(b, known)
                if len(row):
                    yield batch(schema, b.column("rid").take(pa.array(row)), word, at)

    return settled_words(rows.select("rid", "text").mapInArrow(run, "rid long, word long, at long"), words, parts)


def in_place(batches):
    """Batches of ``rare_words`` -> rid, class before, class, class after (or RARE), count."""
    last = 0
    for b in batches:
        if b.num_rows:
            rid, at, cls, n = (b.column(i).to_numpy() for i in range(4))
            cls = cls.astype(np.int64)
            left = at >> 8 & 255
            yield rid, np.where(left == RARE, np.r_[last, cls[:-1]], left), cls, at & 255, n
            last = int(cls[-1])


def class_pairs(training: DataFrame, known: Known, words: DataFrame | None, parts: int) -> np.ndarray:
    """Counts of pairs of classes over all training texts."""
    k = CLASSES
    tally = lambda a, b, keep: np.bincount((a * k + b)[keep], minlength=k * k)

    def frequent(batches):
        total = np.zeros(k * k, np.int64)
        for whole in batches:
            for b in chunks(whole):
                c, _, first = known.of(Words(b.column("text"), lower=True))
                prior = before(c, first, known.end)
                total += tally(prior, c, (prior != RARE) & (c != RARE))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(total)], ["pair", "n"])

    def others(batches):
        total = np.zeros(k * k, np.int64)
        for _, left, c, right, _ in in_place(batches):
            total += tally(left, c, np.ones(len(c), bool)) + tally(c, right, right != RARE)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * k)), pa.array(total)], ["pair", "n"])

    found = training.select("text").mapInArrow(frequent, "pair long, n long")
    if words is not None:
        rows = training.select(F.monotonically_increasing_id().alias("rid"), "text")
        found = found.unionAll(rare_words(rows, known, words, parts).mapInArrow(others, "pair long, n long"))
    out = np.zeros(k * k)
    for r in found.groupBy("pair").agg(F.sum("n").alias("n")).collect():  # CLASSES**2 rows
        out[r["pair"]] = r["n"]
    return out.reshape(k, k)


class Model:
    """step[a, b]: log10 probability of class b after class a; share[b]: log10 of the class's total, with half a count for each member and for a word not seen."""

    def __init__(self, after: np.ndarray, members: np.ndarray):
        total = after.sum(0)
        prior = (total + 1) / (total.sum() + CLASSES)
        self.step = np.log10((after + 20 * prior) / (after.sum(1, keepdims=True) + 20))
        self.share = np.log10(total + 0.5 * (members + 1))

    def words(self, cls: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.log10(n + 0.5) - self.share[cls]


class Learned:
    """What scoring needs: the bounded table, the words beyond it (null if there are none), the model, and the counts of all tokens and words."""

    def __init__(self, known: Known, rest: DataFrame | None, model: Model, n: int, v: int):
        self.known, self.rest, self.model, self.n, self.v = known, rest, model, n, v


def learn(spark: SparkSession, training: DataFrame, scratch: Scratch) -> Learned:
    """training (text): counts, classes and class bigrams of all its words."""
    training, parts = id_text(training.select(F.lit(0).alias("doc_id"), "text")), partitions(spark)
    counts = scratch.save(word_counts(training))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n, v = int(total[0]), int(total[1])
    end_n = int(counts.filter(F.col("word") == int(END)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    top = counts.filter(F.col("word") != int(END)).orderBy(F.desc("n"), "word").limit(HEAD).collect()  # bounded
    scratch.drop(counts)
    scratch.release()
    types = Types(np.array([r["word"] for r in top], np.int64))
    pairs = bigrams(training, types)
    cls = exchange(pairs)
    onto = np.eye(CLASSES)[cls]
    words = scratch.save(word_classes(training, types, cls, onto.T @ pairs @ onto, parts))
    scratch.release()
    more = words.orderBy(F.desc("n"), "word").limit(max(LOOKUP - len(top), 0)).collect()  # bounded
    head_cls = dict(zip(types.head.tolist(), cls.tolist(), strict=False))
    known = Known(types, cls, [(r["word"], head_cls[r["word"]], r["n"]) for r in top] + [(r["word"], r["cls"], r["n"]) for r in more], end_n)
    members = np.bincount([known.end, *head_cls.values()], minlength=CLASSES)
    for r in words.groupBy("cls").agg(F.count("*").alias("v")).collect():
        members[r["cls"]] += r["v"]
    rest = None
    if v - (end_n > 0) > len(known.names):
        rest = words.filter(F.col("n") <= min((r["n"] for r in more), default=n))
    return Learned(known, rest, Model(class_pairs(training, known, rest, parts), members), n, v)


def scored(spark: SparkSession, documents: DataFrame, training: DataFrame, scratch: Scratch) -> DataFrame:
    """documents, training (text) -> doc_id, n_tokens, n_known, train_tokens, base_score, score; one row a document.

    Null and empty texts are the end token alone; very long ones are scored whole. Repeated rows are rows of their own
    and get equal results; a null doc_id stays. Of words that are equally frequent the least by name comes first.
    Without training texts all counts are 0. An empty table gives no rows. Other columns are not read, whatever their
    names.
    """
    learned, parts = learn(spark, training, scratch), partitions(spark)
    known, model, total = learned.known, learned.model, learned.n
    scratch.release()
    floor = np.log10(learned.n + 1.0 * (learned.v + 1))
    rows = id_text(documents).withColumn("rid", F.monotonically_increasing_id())
    whole_schema = pa.schema([("rid", pa.int64()), ("word", pa.int64()), ("at", pa.int64()), ("doc", pa.binary())])

    def tokens(batches):
        """A row for each text, with what its known tokens give, and one for each other token: in one pass, so a row's number holds."""
        for whole in batches:
            for b in chunks(whole):
                c, count, first = known.of(Words(b.column("text"), lower=True))
                size, prior = np.diff(first), before(c, first, known.end)
                logs = np.zeros(len(c))
                at = np.flatnonzero(c != RARE)
                logs[at] = model.words(c[at], count[at])
                at = at[prior[at] != RARE]
                logs[at] += model.step[prior[at], c[at]]
                add = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731, B023
                ids, rid = b.column("doc_id"), b.column("rid").to_numpy()
                doc = np.zeros(b.num_rows, DOC)
                doc["none"], doc["doc_id"], doc["n_tokens"] = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(), size
                doc["n_known"], doc["base"], doc["model"] = add((count > 0).astype(np.int64)), add(np.log10(count + 1.0)) - floor * size, add(logs)
                spread = signed(mix(rid.view(np.uint64) + np.uint64(1)))  # these rows meet no word, and go everywhere
                yield batch(whole_schema, rid, spread, np.full(b.num_rows, -1), [d.tobytes() for d in doc])
                row, word, place_ = rare_tokens(b, known)
                if len(row):
                    yield batch(whole_schema, rid[row], word, place_, pa.nulls(len(row), pa.binary()))

    out = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def results(docs: list[tuple[np.ndarray, int, float, float]]) -> pa.RecordBatch:
        d = np.concatenate([x[0] for x in docs])
        hits, base, score = (np.array([x[k] for x in docs]) for k in (1, 2, 3))
        ids = pa.array(d["doc_id"], pa.int64(), mask=d["none"])
        return batch(out, ids, d["n_tokens"], d["n_known"] + hits.astype(np.int64), np.full(len(d), total), d["base"] + base, d["model"] + score)

    def gathered(batches):
        """A text's own row comes first; those of its tokens follow, maybe over several batches."""
        open_, done = None, []
        for b in batches:
            if not b.num_rows:
                continue
            at, cls, n = (b.column(c).to_numpy() for c in ("at", "cls", "n"))
            heads = np.flatnonzero(at < 0)
            cls = cls.astype(np.int64)
            left, right = at >> 8 & 255, at & 255
            left = np.where(left == RARE, np.r_[open_[4] if open_ else 0, cls[:-1]], left)
            logs = np.zeros(len(at))
            rest = np.flatnonzero(at >= 0)
            logs[rest] = model.step[left[rest], cls[rest]] + model.words(cls[rest], n[rest])
            more = rest[right[rest] != RARE]
            logs[more] += model.step[cls[more], right[more]]
            hit, base = np.where(at < 0, 0, n > 0), np.where(at < 0, 0.0, np.log10(n + 1.0))
            cuts = np.r_[heads, len(at)]
            if open_ is not None:
                k = slice(0, cuts[0])
                open_ = (open_[0], open_[1] + int(hit[k].sum()), open_[2] + float(base[k].sum()), open_[3] + float(logs[k].sum()), int(cls[-1]))
            doc = b.column("doc")
            for i, j in zip(heads.tolist(), cuts[1:].tolist(), strict=True):
                if open_ is not None:
                    done.append(open_[:4])
                open_ = (np.frombuffer(doc[i].as_py(), DOC), int(hit[i:j].sum()), float(base[i:j].sum()), float(logs[i:j].sum()), int(cls[j - 1]))
            if len(done) >= 10_000:
                yield results(done)
                done = []
        if open_ is not None:
            yield results([*done, open_[:4]])

    found = rows.mapInArrow(tokens, "rid long, word long, at long, doc binary")
    return settled_words(found, learned.rest, parts).mapInArrow(gathered, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op8_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, held = table(spark, sf_dir, "documents"), held_out("doc_id", 7, 2)
    out = scored(spark, documents, documents.filter(~held), Scratch(spark, "brown"))
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
