"""Packing along a Hilbert curve: documents with like words lie near one another in the training sequences.

Each document's token ids make a hashed vector of damped counts, in which rarer ids weigh more, and a fixed random
projection maps it to three dimensions.
The Hilbert index of the point orders the documents; tokens are laid end to end along the curve and cut every
1,024. Each range of the curve is a stream of its own, whose rest is cut at powers of two: no token is padding.
"""

from __future__ import annotations

import json
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import Scratch, batch, id_text, partitions, table

LENGTH = 1024
BITS = 10
DIMENSIONS = 3
END = 0
#: Fixed value: the byte-level pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of whole texts as the tokenizer's file gives them, by a faster encoder over the same vocabulary.

    The file's byte-level vocabulary becomes a table of ranks. That is the same tokenizer only if merges are in the
    order of their ids and its pattern is the known one; otherwise, and for a text with a special token's string, the
    file's own library encodes.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, before = file["model"], file.get("pre_tokenizer") or {}
        vocabulary = {k: v for k, v in model["vocab"].items() if k not in self.special}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        ids = [vocabulary.get("".join(m), -1) for m in pairs]
        plain = ids == sorted(ids) and ids[:1] != [-1] and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True) and not file.get("normalizer")
        letter = {c: b for b, c in byte_letters().items()}
        ranks = {bytes(letter[c] for c in k): v for k, v in vocabulary.items()} if plain else None
        self.fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary if plain else None

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> list[int]:
        return self.whole(text) if self.fast is None or any(s in text for s in self.special) else self.fast(text)


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert indices of integer points (rows) below 2**bits, by Skilling's transposition."""
    x = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    n, q = len(x), 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            on = (x[i] & q) > 0
            t = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ t)
            x[i] = x[i] ^ t if i else x[0]
        q >>= 1
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t = np.where((x[-1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x = [v ^ t for v in x]
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for v in x:
            key = (key << 1) | ((v >> b) & 1)
    return key


def projection(buckets: int = 4096) -> np.ndarray:
    """Signs of a fixed pseudo-random projection of hashed counts."""
    return np.random.default_rng(20240229).choice([-1.0, 1.0], (buckets, DIMENSIONS))


def curve_key(ids: np.ndarray, signs: np.ndarray) -> list[float]:
    """The projection of log(1 + count) times a weight that grows with the id: merges are numbered by frequency."""
    known, counts = np.unique(ids, return_counts=True)
    weight = np.log1p(counts) * np.log2(known + 2.0)
    norm = math.sqrt(float(weight @ weight))
    return (weight @ signs[known % len(signs)] / norm).tolist() if norm else [0.0] * DIMENSIONS


TOKENS = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("ids", pa.binary())])
PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
PIECES_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def tokens(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, its key on the curve and its ids with the end token, as two bytes an id where all fit, else four after an odd byte."""

    def run(batches):
        encode, signs = Encoder(path), projection()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                packed, points = [], []
                for text in b.column("text"):
                    ids = np.array([*encode(text.as_py() or ""), END], "<u4")
                    points.append(curve_key(ids, signs))
                    packed.append(ids.astype("<u2").tobytes() if int(ids.max()) < 65536 else b"\0" + ids.tobytes())
                z = np.array(points).reshape(-1, DIMENSIONS)
                cell = np.clip((1 / (1 + np.exp(-1.7 * z)) * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
                yield batch(TOKENS, b.column("doc_id"), hilbert(cell, BITS), packed)

    return id_text(documents).mapInArrow(run, "doc_id long, key long, ids binary")


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u4", offset=1) if len(data) % 2 else np.frombuffer(data, "<u2").astype("<u4")


def tail(left: int, length: int) -> list[int]:
    """Powers of two that sum to what is left after the last full sequence."""
    return [1 << b for b in range(length.bit_length() - 1, -1, -1) if left >> b & 1]


def cut(batches, length: int, stream: int):
    """Pieces of the ids of one range. A document's last pieces wait until it is known whether they fill a sequence."""
    sequence, used, waiting = stream << 40, 0, []  # waiting: (doc_id, start, ids, doc_tokens) of the open sequence
    rows = []

    def close(parts, size):
        nonlocal sequence
        offset = 0
        for doc, start, ids, total in parts:
            rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total, sequence, offset))
            offset += len(ids)
        assert offset == size
        sequence += 1

    for b in batches:
        for doc, data in zip(b.column("doc_id").to_pylist(), b.column("ids"), strict=True):
            ids = unpacked(data.as_py())
            at = 0
            while at < len(ids):
                take = min(length - used, len(ids) - at)
                waiting.append((doc, at, ids[at : at + take], len(ids)))
                used, at = used + take, at + take
                if used == length:
                    close(waiting, length)
                    used, waiting = 0, []
            if len(rows) >= 10_000:
                yield rows
                rows = []
    for size in tail(used, length):
        parts, room = [], size
        while room:
            doc, start, ids, total = waiting.pop(0)
            parts.append((doc, start, ids[:room], total))
            if len(ids) > room:
                waiting.insert(0, (doc, start + room, ids[room:], total))
            room -= min(room, len(ids))
        close(parts, size)
    if rows:
        yield rows


def pack(spark: SparkSession, documents: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """documents (doc_id, text) -> one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document, and the end id after it, lies in exactly one piece; sequences are ``length`` long or
    a smaller power of two, so nothing is padded. A null or empty text is its end id alone. Equal texts share a key
    and lie side by side; equal keys are ordered by doc_id, so one key of very many rows spreads over several ranges, and
    rows of one key and doc_id by their ids. A very long text is encoded whole and cut into many pieces. A null doc_id
    stays. An empty table gives no rows. Other columns are not read, whatever their names.
    """
    scratch = Scratch(spark, "pack")
    ids = scratch.save(tokens(documents, path or tokenizer_path()))  # range bounds are sampled: do not tokenize twice

    def run(batches):
        from pyspark import TaskContext

        for rows in cut(batches, length, TaskContext.get().partitionId()):
            yield batch(PIECES, *(list(c) for c in zip(*rows, strict=True)))

    return ids.repartitionByRange(partitions(spark), "key", "doc_id").sortWithinPartitions("key", "doc_id", "ids").mapInArrow(run, PIECES_DDL)


def op5_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, table(spark, sf_dir, "documents"))
