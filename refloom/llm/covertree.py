"""All pairs of vectors with a cosine of at least a threshold, by dual traversal of cover trees.

On unit vectors a cosine bound is a distance bound. A node's centre covers its members, and each node keeps the largest
distance to them, so bounds are exact however a node was chosen. The upper levels are cells around a bounded sample of
centres, to which all vectors are routed; each cell, split where it is large, builds nested levels of its own with the
radii 1/2, 1/4, 1/8, 1/16. Pairs of cells that are too far apart for any of their members go before anything is sent.
Below, a pair of nodes is dropped if even its nearest members are too far apart, taken whole if even its farthest ones
are near enough, and otherwise replaced by its children's pairs, down to single vectors, whose cosine in double precision
decides. A taken pair adds sizes to counts and one link to the graph: no group of near copies is ever written out pair
by pair.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, row_numbers, table
from .components import components

BLOCK = 6000  # vectors of one tree
CENTERS = 1024  # bound of the cells behind the upper levels
RADII = (0.5, 0.25, 0.125, 0.0625)
SLACK = 1e-7
ALONE = -1  # the cell of vectors of a length that the sample has not


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(float)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cover(x: np.ndarray, radius: float) -> list[np.ndarray]:
    """Greedy cover: each group's first member is its centre, members are about within the radius of it."""
    n, most = len(x), 1 - radius * radius / 2
    alive, groups = np.ones(n, bool), []
    for i in range(0, n, 64):
        tried = np.flatnonzero(alive[i : i + 64]) + i
        near = x[tried] @ x.T >= most
        for row, c in zip(near, tried.tolist(), strict=True):
            if alive[c]:
                row[c] = True
                group = np.flatnonzero(row & alive)
                alive[group] = False
                groups.append(group)
    return groups


class Tree:
    """Nested levels over vectors (rows), which are put in an order in which every node is a range.

    lo[k]: where each node of level k begins; the vector there is its centre. radii[k]: the largest distance to it. The
    last level has one node for each vector. ``order`` is where each vector stood before.
    """

    def __init__(self, x: np.ndarray):
        u = unit(x)
        single = u.astype(np.float32)
        groups, self.lo, self.radii = [np.arange(len(x))], [], []
        for radius in RADII:
            parts = []
            for g in groups:
                parts += [g[m] for m in cover(single[g], radius)] if len(g) > 1 else [g]
            groups = parts
            self.lo.append(np.cumsum([0, *map(len, groups)])[:-1].astype(np.int32))
            far = [math.sqrt(max(0.0, 2 - 2 * float((u[g] @ u[g[0]]).min()))) + SLACK if len(g) > 1 else 0.0 for g in groups]
            self.radii.append(np.array(far))
        self.order = np.concatenate(groups) if groups else np.zeros(0, np.int64)
        self.raw = x[self.order]
        self._finish()

    def _finish(self) -> None:
        self.x = unit(self.raw) if len(self.raw) else np.zeros((0, 1))
        n = len(self.raw)
        self.lo = [*self.lo, np.arange(n, dtype=np.int32)]
        self.radii = [*self.radii, np.zeros(n)]
        self.first = [np.searchsorted(b, np.r_[a, n]) for a, b in zip(self.lo, self.lo[1:], strict=False)]

    def packed(self) -> bytes:
        return pickle.dumps((self.raw, self.lo[:-1], self.radii[:-1]))

    @classmethod
    def unpacked(cls, data: bytes) -> Tree:
        """A tree that another task has built."""
        tree = cls.__new__(cls)
        tree.raw, tree.lo, tree.radii = pickle.loads(data)
        tree._finish()
        return tree

    def below(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First child and number of children of each node."""
        c = self.first[level]
        return c[nodes], c[nodes + 1] - c[nodes]

    def leaves(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the vectors under each node."""
        return self.lo[level].astype(np.int64), np.r_[self.lo[level][1:], len(self.raw)].astype(np.int64)


def expanded(a: Tree, b: Tree, level: int, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children."""
    (pa_, pn), (qa, qn) = a.below(level, p), b.below(level, q)
    n = pn * qn
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    wide = np.repeat(qn, n)
    return np.repeat(pa_, n) + at // wide, np.repeat(qa, n) + at % wide


def reach_of(threshold: float) -> float:
    """The distance of unit vectors whose cosine is the threshold."""
    return math.sqrt(2 - 2 * threshold)


def dual(a: Tree, b: Tree, threshold: float):
    """Yields (level, p, q) of pairs of nodes whose vectors are all linked. If a is b, each pair of nodes once."""
    reach, same = reach_of(threshold), a is b
    xa, xb = a.x[a.lo[0]].astype(np.float32), b.x[b.lo[0]].astype(np.float32)
    widest = float(b.radii[0].max()) if len(b.radii[0]) else 0.0
    bound = (1 - np.minimum(a.radii[0] + (widest + reach + 1e-3), 2.0) ** 2 / 2 - 1e-5).astype(np.float32)[:, None]
    todo = []
    for i in range(0, len(xa), 512):
        p, q = np.nonzero(xa[i : i + 512] @ xb.T >= bound[i : i + 512])
        p += i
        if same:
            p, q = p[p <= q], q[p <= q]
        todo.append((0, p, q))
    while todo:
        level, p, q = todo.pop()
        if len(p) > 200_000:
            todo += [(level, p[i : i + 200_000], q[i : i + 200_000]) for i in range(0, len(p), 200_000)]
            continue
        if not len(p):
            continue
        cosine = np.einsum("ij,ij->i", a.x[a.lo[level][p]], b.x[b.lo[level][q]])
        if level == len(RADII):
            ok = cosine >= threshold
            if same:
                ok &= p <= q
            yield level, p[ok], q[ok]
            continue
        d = np.sqrt(np.maximum(2 - 2 * cosine, 0))
        r = a.radii[level][p] + b.radii[level][q]
        whole = d + r <= reach - SLACK
        yield level, p[whole], q[whole]
        open_ = ~whole & (d - r <= reach + SLACK)
        p, q = expanded(a, b, level, p[open_], q[open_])
        if same:
            p, q = p[p <= q], q[p <= q]
        todo.append((level + 1, p, q))


def roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least member of each of n nodes' component."""
    low = np.arange(n)
    while len(u):
        before = low.copy()
        m = np.minimum(low[u], low[v])
        np.minimum.at(low, u, m)
        np.minimum.at(low, v, m)
        np.minimum.at(low, before, low)
        low = low[low]
        if (low == before).all():
            break
    return low


def joined(ka, na, ta: Tree, kb, nb, tb: Tree, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, their linked weights, and links (u, v) that connect what is linked. Keys and weights are in the trees' order."""
    same = ta is tb
    last = len(RADII)
    ca, cb = np.zeros(len(ka) + 1), np.zeros(len(kb) + 1)
    sa, sb = np.r_[0, np.cumsum(na)], np.r_[0, np.cumsum(nb)]
    base = 0 if same else len(ka)
    us, vs = [], []
    bounds = [(ta.leaves(k), tb.leaves(k)) for k in range(last + 1)]
    for level, p, q in dual(ta, tb, threshold):
        (la, ha), (lb, hb) = bounds[level]
        la, ha, lb, hb = la[p], ha[p], lb[q], hb[q]
        np.add.at(ca, la, sb[hb] - sb[lb])
        np.add.at(ca, ha, -(sb[hb] - sb[lb]))
        other = ca if same else cb
        apart = (la != lb) | (not same)
        np.add.at(other, lb[apart], (sa[ha] - sa[la])[apart])
        np.add.at(other, hb[apart], -(sa[ha] - sa[la])[apart])
        n = (ha - la) + (hb - lb)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        in_a = at < np.repeat(ha - la, n)
        us.append(np.where(in_a, np.repeat(la, n) + at, base + np.repeat(lb - (ha - la), n) + at))
        vs.append(np.repeat(la, n))
        if sum(map(len, us)) > 2_000_000:
            low = roots(base + len(kb), np.concatenate(us), np.concatenate(vs))
            us, vs = [np.arange(len(low))], [low]
    ids = ka if same else np.r_[ka, kb]
    low = roots(len(ids), np.concatenate(us), np.concatenate(vs)) if us else np.arange(len(ids))
    # within one tree each vector has met itself once
    counts = np.cumsum(ca[:-1]) - na if same else np.r_[np.cumsum(ca[:-1]), np.cumsum(cb[:-1])]
    at = np.flatnonzero(low != np.arange(len(low)))
    some = np.flatnonzero(counts > 0.5)
    return ids[some], np.rint(counts[some]).astype(np.int64), ids[at], ids[low[at]]


def spread_out(x: np.ndarray, most: int) -> np.ndarray:
    """At most so many rows of x, each the farthest from those before it: the upper levels of a cover tree, from the top."""
    taken, far = [0], np.full(len(x), -np.inf)
    while len(taken) < min(most, len(x)):
        far = np.maximum(far, x @ x[taken[-1]])  # the greatest cosine with a taken one
        taken.append(int(np.argmin(far)))
    return x[taken]


def routed(vectors: DataFrame, centers: dict[int, np.ndarray]) -> DataFrame:
    """Adds the dimension, the nearest centre of that dimension and the distance to it."""
    schema = pa.schema([("k", pa.int64()), ("embedding", pa.list_(pa.float64())), ("n", pa.int64()), ("dim", pa.int32()), ("cell", pa.int32()), ("far", pa.float64())])

    def run(batches):
        for b in batches:
            v = b.column("embedding")
            n = v.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            cell, far = np.full(len(n), ALONE, np.int32), np.zeros(len(n))
            flat = np.asarray(v.flatten().to_numpy(zero_copy_only=False), float)
            start = np.r_[0, np.cumsum(n)]
            for d in set(n.tolist()) & set(centers):
                rows = np.flatnonzero(n == d)
                cosine = unit(flat[start[rows][:, None] + np.arange(d)]) @ centers[d].T
                cell[rows] = np.argmax(cosine, axis=1)
                far[rows] = np.sqrt(np.maximum(2 - 2 * cosine[np.arange(len(rows)), cell[rows]], 0)) + SLACK
            yield pa.RecordBatch.from_arrays([b.column("k"), v, b.column("n"), pa.array(n.astype(np.int32)), pa.array(cell), pa.array(far)], schema=schema)

    return vectors.select("k", F.col("embedding").cast("array<double>").alias("embedding"), "n").mapInArrow(run, "k long, embedding array<double>, n long, dim int, cell int, far double")


def near_cells(centers: dict[int, np.ndarray], radii: list[tuple[int, int, float]], reach: float) -> list[tuple[int, int, int]]:
    """(dim, a, b), a <= b: pairs of cells of which two members may be within reach. At most CENTERS**2 / 2 of them."""
    out = []
    for d, x in centers.items():
        own = np.array([c for dim, c, _ in radii if dim == d], int)
        r = np.array([far for dim, _, far in radii if dim == d])
        if len(own):
            apart = np.sqrt(np.maximum(2 - 2 * x[own] @ x[own].T, 0))
            a, b = np.nonzero(np.triu(apart <= r[:, None] + r[None] + reach + SLACK))
            out += [(d, int(min(i, j)), int(max(i, j))) for i, j in zip(own[a].tolist(), own[b].tolist(), strict=True)]
    return out


def work_items(spark: SparkSession, cells: DataFrame, numbers: DataFrame, centers: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """numbers (dim, cell, part) -> dim, a, i, b, j: the pairs of blocks to compare, each once."""
    radii = [tuple(r) for r in cells.filter(F.col("cell") != ALONE).groupBy("dim", "cell").agg(F.max("far")).collect()]  # a row a centre
    pairs = spark.createDataFrame(near_cells(centers, radii, reach_of(threshold)), "dim int, a int, b int")
    alone = numbers.filter(F.col("cell") == ALONE).select("dim", F.lit(ALONE).alias("a"), F.lit(ALONE).alias("b")).distinct()
    left = numbers.select("dim", F.col("cell").alias("a"), F.col("part").alias("i"))
    right = numbers.select("dim", F.col("cell").alias("b"), F.col("part").alias("j"))
    return left.join(pairs.unionByName(alone), ["dim", "a"]).join(right, ["dim", "b"]).filter("a < b or i <= j").select("dim", "a", "i", "b", "j")


def links(spark: SparkSession, vectors: DataFrame, threshold: float, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """vectors (k, embedding, n: how many have it) -> (k, linked) counts of other vectors, and (u, v) links."""
    total = vectors.count()
    wanted = min(CENTERS, max(1, total // BLOCK))
    sample = vectors.orderBy(F.xxhash64("embedding", F.lit(5))).limit(4 * wanted).select(F.col("embedding").cast("array<double>")).collect()  # bounded
    found: dict[int, list] = {}
    for (e,) in sample:
        found.setdefault(len(e), []).append(e)
    centers = {d: spread_out(unit(np.array(c, float)), max(1, wanted * len(c) // len(sample))) for d, c in found.items()}
    cells = scratch.save(routed(vectors, centers))
    sizes = cells.groupBy("dim", "cell").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    blocked = cells.join(sizes, ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("k", F.lit(3)), "parts").cast("int")).drop("parts")

    def gather(t: pa.Table) -> pa.Table:
        d = t.column("dim")[0].as_py()
        x = t.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        if (x.astype(np.float32) == x).all():  # as they came: half the bytes to send
            x = x.astype(np.float32)
        tree = Tree(x)
        k, n = (t.column(c).to_numpy()[tree.order] for c in ("k", "n"))
        return pa.table({"dim": pa.array([d], pa.int32()), "cell": t.column("cell").slice(0, 1), "part": t.column("part").slice(0, 1), "keys": pa.array([k.tobytes()]), "sizes": pa.array([n.tobytes()]), "tree": pa.array([tree.packed()])})

    blocks = scratch.save(blocked.groupBy("dim", "cell", "part").applyInArrow(gather, "dim int, cell int, part int, keys binary, sizes binary, tree binary"))
    items = scratch.save(work_items(spark, cells, blocks.select("dim", "cell", "part"), centers, threshold))
    first = items.withColumns({"cell": F.col("a"), "part": F.col("i"), "role": F.lit(0)})
    second = items.filter("a < b or i < j").withColumns({"cell": F.col("b"), "part": F.col("j"), "role": F.lit(1)})
    work = blocks.join(first.unionByName(second), ["dim", "cell", "part"]).drop("cell", "part")
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("c", pa.int64())])

    def compare(t: pa.Table) -> pa.Table:
        t = t.sort_by("role")
        made = []
        for r in range(t.num_rows):
            k, n = (np.frombuffer(t.column(c)[r].as_buffer(), np.int64) for c in ("keys", "sizes"))
            made.append((k, n, Tree.unpacked(t.column("tree")[r].as_py())))
        ids, counts, u, v = joined(*made[0], *made[-1], threshold)
        return pa.table([pa.array(np.r_[ids, u]), pa.array(np.r_[ids, v]), pa.array(np.r_[counts, np.zeros(len(u), np.int64)])], schema=schema)

    out = scratch.save(work.groupBy("dim", "a", "i", "b", "j").applyInArrow(compare, "u long, v long, c long"))
    return out.filter("c > 0").groupBy(F.col("u").alias("k")).agg(F.sum("c").alias("linked")), out.filter("u <> v").select("u", "v")


def classified(scratch: Scratch, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows (vec_id, embedding; null where it is linked with nothing) -> rows (vec_id, h), classes (h, k, rep, n, embedding) of equal vectors.

    A class is named by a hash of the vector. That no two vectors have one is looked at: otherwise another hash is taken.
    """
    seed = 41
    while True:
        named = scratch.save(rows.withColumn("h", F.when(F.col("embedding").isNotNull(), F.xxhash64("embedding", F.lit(seed)))))
        classes = named.filter("h is not null").groupBy("h").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.min("embedding").alias("embedding"), F.max("embedding").alias("other"))
        classes = row_numbers(scratch, classes.withColumn("clash", F.col("embedding") != F.col("other")).drop("other")).withColumnRenamed("__row", "k")
        if not classes.filter("clash").limit(1).count():
            return named.select("vec_id", "h"), classes.drop("clash")
        scratch.drop(named)
        seed += 1


def near_vectors(spark: SparkSession, embeddings: DataFrame, threshold: float = 0.95) -> DataFrame:
    """embeddings (vec_id, embedding) -> vec_id, n_links, component_id, kept; one row a vector.

    Equal vectors are one class with a weight, so copies add one row. A vector that is null, empty, zero or holds a
    null or non-finite component is linked with nothing; vectors of different lengths are not linked. A repeated row
    counts as another vector. A null vec_id stays, counts as a vector, and is no component's name unless no member has
    another. A very long vector is compared whole. An empty table gives no rows. Other columns are not read, whatever
    their names.
    """
    scratch = Scratch(spark, "covertree")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    ok = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~F.exists("embedding", bad) & F.exists("embedding", lambda x: x != 0)
    named, classes = classified(scratch, rows.select("vec_id", F.when(F.coalesce(ok, F.lit(False)), F.col("embedding")).alias("embedding")))
    linked, edges = links(spark, classes.select("k", "embedding", "n"), threshold, scratch)
    scratch.release()
    nodes = components(spark, edges, scratch)
    placed = classes.select("h", "k", "rep", "n").join(nodes.withColumnRenamed("node", "k"), "k", "left").withColumn("root", F.coalesce("root", "k"))
    least = placed.groupBy("root").agg(F.min("rep").alias("component"))
    placed = scratch.save(placed.join(least, "root").join(linked, "k", "left").select("h", "component", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("links")))
    out = named.join(placed, "h", "left").withColumn("component_id", F.when(F.col("h").isNull(), F.col("vec_id")).otherwise(F.col("component")))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op2_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark, table(spark, sf_dir, "embeddings"))


OP2_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR isnan(v) OR isinf(v))) = 0 AND len(list_filter(embedding, lambda v: v <> 0)) > 0),
l AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.95),
r(vec_id, reach) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.vec_id, l.v FROM r JOIN l ON l.u = r.reach)
SELECT r.vec_id, (SELECT count(*) FROM l WHERE l.u = r.vec_id)::BIGINT AS n_links, min(r.reach)::BIGINT AS component_id, r.vec_id = min(r.reach) AS kept
FROM r GROUP BY r.vec_id
"""
