"""Lempel-Ziv phrase fingerprints: minimum-hash signatures of LZ78 phrase sets."""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsentinel.llm.common import give_back, pa_schema, slices, table, task_partitions, utf8

LONG = 4 << 20  # bytes; the phrase tree of a longer text is kept in flat arrays
SIGNATURE = 128  # smallest phrase hashes kept
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


class PhraseHasher:
    """Hashes byte ranges of one text by differences of prefix sums modulo 2**64."""

    def __init__(self):
        self._up = np.ones(1, np.uint64)
        self._down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        while len(self._up) <= n:
            size = np.uint64(len(self._up))
            up, down = pow(_BASE, int(size), 1 << 64), pow(_INVERSE, int(size), 1 << 64)
            self._up = np.concatenate([self._up, self._up * np.uint64(up)])
            self._down = np.concatenate([self._down, self._down * np.uint64(down)])

    def __call__(self, data: bytes, cuts: list[int], start: int = 0) -> np.ndarray:
        """64-bit hashes of ``data[a:b]`` for the consecutive cuts after ``start``."""
        ends = np.asarray(cuts, np.int64)
        if not len(ends):
            return np.empty(0, np.uint64)
        starts = np.concatenate([[start], ends[:-1]])
        first, n = start, int(ends[-1]) - start
        self._grow(n)
        codes = np.frombuffer(data, np.uint8, n, first).astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * self._up[:n], dtype=np.uint64)])
        h = (sums[ends - first] - sums[starts - first]) * self._down[starts - first]
        h ^= h >> np.uint64(31)  # finalizer of a public 64-bit mixer (splitmix64)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(32))


def parse(data: bytes, start: int, root: dict, node: dict, undo: list | None = None) -> tuple[list[int], dict]:
    """LZ78 parse of ``data[start:]`` that goes on from ``node`` of the phrase tree ``root``.

    Returns the ends of the phrases completed and the node reached. ``undo`` collects
    the tree's new edges.
    """
    cuts, at = [], start
    cut = cuts.append
    for c in data[start:]:
        at += 1
        following = node.get(c)
        if following is None:
            node[c] = {}
            if undo is not None:
                undo.append((node, c))
            cut(at)
            node = root
        else:
            node = following
    return cuts, node


def long_cuts(data: bytes) -> array:
    """The ends of ``parse`` for a long text, with the phrase tree in flat arrays (some 20 bytes a phrase).

    A node's children are a chain, the earliest and so the likeliest first.
    """
    top = [0] * 256
    child, sibling, label, cuts = array("i", [0]), array("i", [0]), bytearray(1), array("q")
    node = 0
    for at, c in enumerate(data, 1):
        last, following = 0, child[node] if node else top[c]
        while following and label[following] != c:
            last, following = following, sibling[following]
        if following:
            node = following
            continue
        new = len(label)
        if last:
            sibling[last] = new
        elif node:
            child[node] = new
        else:
            top[c] = new
        child.append(0)
        sibling.append(0)
        label.append(c)
        cuts.append(at)
        node = 0
    return cuts


def long_signature(data: bytes, hasher: PhraseHasher, size: int = SIGNATURE, step: int = 1 << 16) -> np.ndarray:
    """The signature of a long text, its phrases hashed some at a time."""
    cuts, best, start = long_cuts(data), np.empty(0, np.uint32), 0
    for at in range(0, len(cuts), step):
        part = cuts[at: at + step]
        best = np.union1d(best, signature(hasher(data, part, start), size))[:size]
        start = part[-1]
    return best


def signature(hashes: np.ndarray, size: int = SIGNATURE) -> np.ndarray:
    """The ``size`` smallest distinct hashes, as 32-bit values."""
    return np.unique((hashes >> np.uint64(32)).astype(np.uint32))[:size]


def likeness(a: np.ndarray, b: np.ndarray, size: int = SIGNATURE) -> float:
    """Estimated Jaccard similarity of two phrase sets by their smallest hashes; 1 if both are empty."""
    if not len(a) and not len(b):
        return 1.0
    smallest = np.union1d(a, b)[:size]
    return float(np.isin(smallest, np.intersect1d(a, b, assume_unique=True)).mean())


def as_hex(sig: np.ndarray) -> str:
    return sig.astype(">u4").tobytes().hex()


def from_hex(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u4").astype(np.uint32)


def fingerprint_pair(data: bytes, keep: int, tail: bytes, hasher: PhraseHasher) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of ``data`` and of ``data[:keep] + tail``; the shared prefix is parsed once.

    A last phrase that the text's end cuts short is in the tree already, so it adds
    nothing to the set.
    """
    if len(data) > LONG or keep + len(tail) > LONG:
        return long_signature(data, hasher), long_signature(data[:keep] + tail, hasher)
    root: dict = {}
    head_cuts, node = parse(data[:keep], 0, root, root)
    undo: list = []
    own_cuts, _ = parse(data, keep, root, node, undo)
    for parent, c in undo:
        del parent[c]
    edited = data[:keep] + tail
    edit_cuts, _ = parse(edited, keep, root, node)
    head = hasher(data, head_cuts)
    last = head_cuts[-1] if head_cuts else 0
    own = np.concatenate([head, hasher(data, own_cuts, last)])
    new = np.concatenate([head, hasher(edited, edit_cuts, last)])
    return signature(own), signature(new)


def fingerprint(data: bytes, hasher: PhraseHasher | None = None) -> np.ndarray:
    if len(data) > LONG:
        return long_signature(data, hasher or PhraseHasher())
    root: dict = {}
    cuts, _ = parse(data, 0, root, root)
    return signature((hasher or PhraseHasher())(data, cuts))


def fingerprint_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and hex ``fingerprint`` of every whole text (null: empty, fingerprint '')."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, schema = PhraseHasher(), pa_schema("doc_id long, fingerprint string")
        for batch in batches:
            for part in slices(batch):
                prints = [as_hex(fingerprint(x, hasher)) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints, pa.string())], schema=schema)
        give_back()

    return docs.select(F.col(key).cast("long").alias("doc_id"), utf8(text).alias("data")).mapInArrow(
        run, "doc_id long, fingerprint string"
    )


def successive_blocks(docs: DataFrame, blocks: int) -> DataFrame:
    """Deal rows (``_k``, ``data``) into descending key ranges that a task can stream alone.

    Adds ``_block`` and ``_guest``: each range also gets, as guests, copies of the row that
    follows its last one (the top row of the range below; after the last range, the first
    row of all). Ranges come from approximate quantiles; of the table, at most ``blocks``
    bounds and as many top keys reach the driver. Texts are shuffled once, by the caller.
    """
    shares = [i / blocks for i in range(1, blocks)] or [0.5]
    bounds = docs.agg(F.percentile_approx("_k", shares, 20 * blocks)).first()[0] or []
    edges = np.unique(np.asarray(bounds, np.int64))

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, keys.to_numpy(np.int64))).astype("int32")

    tops = docs.select("_k").groupBy(range_of("_k").alias("b")).agg(F.max("_k").alias("top")).collect()
    top_of = np.full(len(edges) + 1, np.iinfo(np.int64).min)
    above = np.full(len(edges) + 1, -1, np.int32)
    used = sorted(r["b"] for r in tops)
    for r in tops:
        top_of[r["b"]] = r["top"]
    for b, following in zip(used, used[1:] + used[:1]):
        above[b] = following

    @F.pandas_udf("int")
    def guest_of(keys: pd.Series) -> pd.Series:
        ids = keys.to_numpy(np.int64)
        at = np.searchsorted(edges, ids)
        return pd.Series(np.where(top_of[at] == ids, above[at], -1)).astype("int32")

    placed = docs.withColumns({"_own": range_of("_k"), "_to": guest_of("_k")})
    own = F.struct(F.col("_own").alias("b"), F.lit(False).alias("g"))
    guest = F.struct(F.col("_to").alias("b"), F.lit(True).alias("g"))
    slots = F.when(F.col("_to") < 0, F.array(own)).otherwise(F.array(own, guest))
    return placed.withColumn("_slot", F.explode(slots)).select(
        *docs.columns, F.col("_slot.b").alias("_block"), F.col("_slot.g").alias("_guest")
    )


class _Stream:
    """Rows of one range in order; a row is finished once its successor's fingerprint is known."""

    def __init__(self):
        self.hasher = PhraseHasher()
        self.block, self.row, self.waiting, self.closed = None, None, None, True

    def push(self, block: int, guest: bool, key, data: bytes) -> list[tuple]:
        if block != self.block:
            self.block, self.row, self.waiting, self.closed = block, None, None, False
        if self.closed:
            return []
        done = []
        if self.row is not None:
            done = self._settle(data)
        if guest:
            self.closed = True
            done += self._finish(fingerprint(data, self.hasher))
        self.row = (key, data)
        return done

    def _settle(self, following: bytes) -> list[tuple]:
        key, data = self.row
        text = data.decode("utf-8", "surrogateescape")
        n = len(text)
        keep = len(text[: n - n // 3].encode("utf-8", "surrogateescape"))
        tail = following.decode("utf-8", "surrogateescape")[: n // 3].encode("utf-8", "surrogateescape")
        own, edited = fingerprint_pair(data, keep, tail, self.hasher)
        done = self._finish(own)
        sha = hashlib.sha256(data[:keep] + tail).hexdigest()
        self.waiting = (key, n, sha, own, edited)
        return done

    def _finish(self, following: np.ndarray) -> list[tuple]:
        if self.waiting is None:
            return []
        key, n, sha, own, edited = self.waiting
        self.waiting = None
        return [(key, n, sha, as_hex(own), as_hex(edited), likeness(own, edited), likeness(own, following))]


def compare_with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has the last third of the code points replaced by the first as many
    of the next document in descending key order (after the last: the first). Null texts
    are empty; two empty phrase sets are alike by 1, an empty and another one by 0. Null
    keys come last; rows with equal keys follow each other by text. A single row follows
    itself. Extra columns are ignored; an empty table gives an empty result.
    """
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    n = task_partitions(docs.sparkSession)
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)).cast("long")).alias("_k"),
        utf8(text).alias("data"),
    )
    placed = successive_blocks(rows, 3 * n).repartition(n, "_block")
    ordered = placed.sortWithinPartitions("_block", "_guest", F.desc("_k"), "data")
    out_schema = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, done = _Stream(), []

        def flush():
            columns = list(zip(*done)) or [[]] * len(out_schema)
            return pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(columns, out_schema)], schema=out_schema)

        for batch in batches:
            for part in slices(batch):
                for row in zip(*(part.column(c).to_pylist() for c in ("_block", "_guest", "doc_id", "data"))):
                    done += stream.push(*row)
                yield flush()
                done.clear()
        give_back()

    return ordered.select("_block", "_guest", "doc_id", "data").mapInArrow(run, schema)


def op1_lz_fingerprint(spark, sf_dir: str) -> DataFrame:
    """Every document against its edited text and the next document."""
    return compare_with_edits(table(spark, sf_dir, "documents"))
