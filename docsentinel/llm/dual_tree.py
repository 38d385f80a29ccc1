"""Ranked lexical search by two trees.

Items and documents each form a hierarchy whose nodes hold, per term, the largest weight
beneath them. The product of an item node and a document node bounds every score between
them, so a pair of nodes whose bound is under the items' weakest kth score is skipped
whole, without changing a result. All scores are integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from docsentinel.llm.common import WORD_ASCII, bucket_of, table, utf8
from docsentinel.session import ensure_checkpoint_dir

#: Item texts searched in one pass; a larger set of items takes more passes.
ITEM_BYTES = 4 << 20
FAN = 16
#: Documents whose tree is built at once.
BATCH = 4096
_NO_ID = np.iinfo(np.int64).min


def terms_in_slices(data: bytes, step: int = 1 << 20) -> Iterator[list[bytes]]:
    """The terms ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` of a text, A-Z lower-cased, a slice at a time."""
    plain, at = data.translate(WORD_ASCII), 0
    while at < len(plain):
        end = plain.find(b" ", at + step) if at + step < len(plain) else -1
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def count_terms(data: bytes, vocabulary: dict[bytes, int]) -> tuple[int, np.ndarray, np.ndarray]:
    """All terms' number, and (term, occurrences) of those in the vocabulary."""
    n, found = 0, []
    for words in terms_in_slices(data):
        n += len(words)
        ids = np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int64, len(words))
        found.append(ids[ids >= 0])
    terms, tf = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.int64),) * 2
    return n, terms, tf.astype(np.int64)


@dataclass
class Level:
    """Sparse vectors of a tree level's nodes: node ``i`` has entries ``start[i]:start[i + 1]``."""

    start: np.ndarray
    term: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(rows: list[tuple[np.ndarray, np.ndarray]]) -> Level:
        start = np.concatenate([[0], np.cumsum([len(t) for t, _ in rows], dtype=np.int64)])
        if not rows:
            return Level(start, np.empty(0, np.int64), np.empty(0, np.int64))
        return Level(start, np.concatenate([t for t, _ in rows]), np.concatenate([v for _, v in rows]))

    def __len__(self) -> int:
        return len(self.start) - 1

    def parents(self) -> Level:
        """One node for every ``FAN`` of this level: the largest value of each term."""
        n = -(-len(self) // FAN)
        owner = np.repeat(np.arange(len(self)) // FAN, np.diff(self.start))
        order = np.lexsort((self.term, owner))
        owner, term, value = owner[order], self.term[order], self.value[order]
        first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (term[1:] != term[:-1])])) if len(term) else np.empty(0, np.int64)
        best = np.maximum.reduceat(value, first) if len(first) else value
        return Level(np.searchsorted(owner[first], np.arange(n + 1)), term[first], best)

    def pick(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers of the nodes, and where each node's begin."""
        sizes = self.start[nodes + 1] - self.start[nodes]
        ends = np.cumsum(sizes)
        at = np.repeat(self.start[nodes] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        return at, ends - sizes

    def products(self, nodes: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Sums of the nodes' values times the dense coordinates (last axis); every node has entries."""
        at, begin = self.pick(nodes)
        return np.add.reduceat(self.value[at] * dense[..., self.term[at]], begin, axis=-1)


def tree(level: Level) -> list[Level]:
    """Levels from the single items up to one root."""
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].parents())
    return levels


@dataclass
class Items:
    """The items of one pass: their trees, and the vocabulary with its weights."""

    vocabulary: dict[bytes, int]
    weight: np.ndarray
    levels: list[Level]
    number: np.ndarray  # the items' own numbers, in tree order
    documents: int
    terms: int

    @staticmethod
    def vocabulary_of(texts: list[bytes]) -> dict[bytes, int]:
        out: dict[bytes, int] = {}
        for data in texts:
            for words in terms_in_slices(data):
                for w in words:
                    out.setdefault(w, len(out))
        return out

    @staticmethod
    def build(texts: list[bytes], vocabulary: dict[bytes, int], df: dict[int, int], documents: int, terms: int) -> Items:
        weight = np.zeros(len(vocabulary), np.int64)
        for t, n in df.items():
            weight[t] = math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1)))
        rows = []
        for i, data in enumerate(texts):
            _, t, tf = count_terms(data, vocabulary)
            live = weight[t] > 0  # the others add nothing to a score
            if live.any():
                t, v = t[live], tf[live] * weight[t[live]]
                rows.append((int(t[v.argmax()]), i, t, v))
        rows.sort(key=lambda r: r[:2])  # items with the same heaviest term become neighbours
        return Items(vocabulary, weight, tree(Level.of([r[2:] for r in rows])), np.array([r[1] for r in rows], np.int64),
                     documents, terms)

    def length_norm(self, n: int) -> int:
        return 100 - 25 + (25 * n * self.documents) // self.terms


class Best:
    """The ``k`` best (score, id) of each item so far, equal scores by smaller id; ``floor`` only rises."""

    def __init__(self, items: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()
        self.score: list[np.ndarray] = [np.empty(0, np.int64)] * items
        self.doc: list[np.ndarray] = [np.empty(0, np.int64)] * items

    def add(self, item: int, scores: np.ndarray, docs: np.ndarray) -> None:
        scores, docs = np.concatenate([self.score[item], scores]), np.concatenate([self.doc[item], docs])
        order = np.lexsort((docs, -scores))[: self.k]
        self.score[item], self.doc[item] = scores[order], docs[order]
        if len(order) == self.k:
            self.floor[item] = max(self.floor[item], scores[order[-1]])


def search_batch(items: Items, ids: np.ndarray, rows: list[tuple[np.ndarray, np.ndarray]], best: Best) -> None:
    """Enter a batch of documents, given as (terms, coordinates), into the best lists."""
    heaviest = [int(t[(items.weight[t] * v).argmax()]) for t, v in rows]
    order = np.argsort(heaviest, kind="stable")  # documents with the same heaviest term become neighbours
    ids = ids[order]
    docs = tree(Level.of([rows[i] for i in order]))
    dense = np.zeros(len(items.weight), np.int64)
    block = np.zeros((FAN, len(items.weight)), np.int64)

    def survivors(level: int, node: int, alive: np.ndarray) -> np.ndarray:
        """Items (of those alive) that some document under the node may still improve."""
        entries = slice(docs[level].start[node], docs[level].start[node + 1])
        dense[docs[level].term[entries]] = docs[level].value[entries]
        keep = alive
        for height in range(len(items.levels) - 1, -1, -1):
            span = FAN ** height
            nodes, first = np.unique(keep // span, return_index=True)
            weakest = np.minimum.reduceat(best.floor[keep], first)
            good = items.levels[height].products(nodes, dense) >= weakest
            keep = keep[np.repeat(good, np.diff(np.append(first, len(keep))))]
            if not len(keep):
                break
        dense[docs[level].term[entries]] = 0
        return keep

    def visit(level: int, node: int, alive: np.ndarray) -> None:
        alive = survivors(level, node, alive)
        if not len(alive):
            return
        children = range(node * FAN, min((node + 1) * FAN, len(docs[level - 1])))
        if level > 1:
            for child in children:
                visit(level - 1, child, alive)
            return
        at = docs[0].start
        row = np.repeat(np.arange(len(children)), np.diff(at[children.start: children.stop + 1]))
        entries = slice(at[children.start], at[children.stop])
        block[row, docs[0].term[entries]] = docs[0].value[entries]
        scores = items.levels[0].products(alive, block[: len(children)])
        block[row, docs[0].term[entries]] = 0
        hit = scores >= best.floor[alive]
        for j in np.flatnonzero(hit.any(axis=0)):
            best.add(int(alive[j]), scores[hit[:, j], j], ids[children.start: children.stop][hit[:, j]])

    if len(docs) == 1:  # one document: its own parent
        docs.append(docs[0])
    visit(len(docs) - 1, 0, np.arange(len(items.number)))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist())


def corpus_counts(docs: DataFrame, vocabulary: dict[bytes, int]) -> tuple[dict[int, int], int, int]:
    """Document frequencies of the vocabulary, documents with a term, and all terms."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        df, with_terms, all_terms = np.zeros(len(words), np.int64), 0, 0
        for _, data in _rows(batches):
            n, terms, _ = count_terms(data, words)
            df[terms] += 1
            with_terms += n > 0
            all_terms += n
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, -2, *seen.tolist()], pa.int64()), pa.array([with_terms, all_terms, *df[seen].tolist()], pa.int64())],
            names=["t", "n"],
        )

    # At most one row a vocabulary term, and two.
    counts = {r["t"]: r["n"] for r in docs.mapInArrow(run, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).collect()}
    shared.unpersist()
    documents, terms = counts.pop(-1, 0), counts.pop(-2, 0)
    return counts, documents, terms


def _search(docs: DataFrame, items: Items, k: int, floor: np.ndarray) -> DataFrame:
    """(``_i``, ``doc_id``, ``score``): each task's best ``k`` for every item, none under the item's floor."""
    shared = docs.sparkSession.sparkContext.broadcast((items, floor))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        it, low = shared.value
        best = Best(len(it.number), k, low)
        ids, rows = [], []

        def flush():
            if rows:
                search_batch(it, np.array(ids, np.int64), rows, best)
                ids.clear()
                rows.clear()

        for doc, data in _rows(batches):
            n, terms, tf = count_terms(data, it.vocabulary)
            terms, tf = terms[it.weight[terms] > 0], tf[it.weight[terms] > 0]
            if len(terms):
                ids.append(_NO_ID if doc is None else doc)
                rows.append((terms, (1_000_000_000 * tf) // (1000 * tf + 12 * it.length_norm(n))))
                if len(rows) >= BATCH:
                    flush()
        flush()
        for i, number in enumerate(it.number.tolist()):
            found = best.doc[i].tolist()
            if found:
                yield pa.RecordBatch.from_arrays([
                    pa.array([number] * len(found), pa.int64()), pa.array([None if d == _NO_ID else d for d in found], pa.int64()),
                    pa.array(best.score[i], pa.int64()),
                ], names=["_i", "doc_id", "score"])

    if not len(items.number):
        return docs.sparkSession.createDataFrame([], "_i long, doc_id long, score long")
    return docs.mapInArrow(run, "_i long, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("_i").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    docs: DataFrame,
    benchmark: DataFrame,
    k: int = 20,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """(*item*, ``rank``, ``doc_id``, ``score``): the ``k`` best documents of every item, none with score 0.

    Items are read in blocks of about ``item_bytes`` of text, each searched in passes of its
    own over the documents: one for the corpus counts, one over a 64th of the documents for
    a floor under every item's kth score (a lower bound, so nothing is lost by it), one over
    all. A task keeps ``k`` documents an item; Spark ranks the tasks' lists.

    Null texts have no terms; such documents and items have no rows. Every row of the
    items is an item, every row of the documents a document, so repeated rows rank
    several times. Equal scores are ranked by key, null keys first. Item ids keep their
    type. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), utf8(text).alias("data"))
    asked = benchmark.select(F.col(item).alias("_id"), utf8(item_text).alias("d"))
    total = asked.agg(F.sum(F.octet_length("d"))).first()[0] or 0
    blocks = max(1, -(-total // item_bytes))
    out = None
    for b in range(blocks):
        rows = asked.where(bucket_of(blocks, "_id", "d") == b).collect()
        vocabulary = Items.vocabulary_of([bytes(r["d"]) for r in rows])
        df, documents, terms = corpus_counts(texts, vocabulary)
        items = Items.build([bytes(r["d"]) for r in rows], vocabulary, df, documents, terms)
        floor = np.ones(len(items.number), np.int64)
        place = {n: i for i, n in enumerate(items.number.tolist())}
        few = _ranked(_search(texts.where(bucket_of(64, "doc_id") == 0), items, k, floor), k)
        for r in few.where(F.col("rank") == k).collect():  # at most one row an item of the block
            floor[place[r["_i"]]] = r["score"]
        found = _ranked(_search(texts, items, k, floor), k)
        ids = StructType([StructField("_i", LongType()), StructField(item, asked.schema["_id"].dataType)])
        names = spark.createDataFrame([(i, r["_id"]) for i, r in enumerate(rows)], ids)
        part = found.join(F.broadcast(names), "_i").select(item, F.col("rank").cast("int"), "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    return out


def op12_dual_tree(spark, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
