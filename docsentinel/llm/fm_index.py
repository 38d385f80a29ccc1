"""Benchmark decontamination with an FM-index per shard of training text.

A task indexes its documents shard by shard. Only words of the benchmark vocabulary
are symbols; a run of them too short for any phrase cannot hold one and is left out, all
others are indexed whole. Phrases are searched backwards, all at once, with ranks from a
wavelet matrix; occurrences are located by walking to sampled suffix positions; hits of
a document are merged into removal spans. Nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from docsentinel.llm.common import WORD_ASCII, bucket_of, give_back, table, utf8, words_alnum

SAMPLE = 8  # one suffix position in so many is stored
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 4 << 20  # benchmark text searched, and broadcast, at a time: some 50 MB of windows


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order of a word array by prefix doubling.

    0 ends a run; each 0 is smaller than all words and ordered by its place, so that no
    comparison goes beyond a run's end.
    """
    n = len(text)
    if n == 0:
        return np.empty(0, np.int64)
    ends = text == 0
    rank = text.astype(np.int64) + int(ends.sum())
    rank[ends] = np.arange(ends.sum())
    step = 1
    while True:
        later = np.zeros(n, np.int64)
        later[: n - step] = rank[step:] + 1
        pair = rank * np.int64(max(int(later.max()), 1) + 1) + later
        order = np.argsort(pair, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(np.diff(pair[order]) != 0)])
        rank = new
        if rank[order[-1]] == n - 1 or step >= n:
            return order
        step *= 2


class WaveletMatrix:
    """Rank of a symbol before a position, for arrays of queries."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.bits = max(1, int(n_symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        at = symbols.astype(np.int64)
        for b in range(self.bits - 1, -1, -1):
            bit = (at >> b) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            at = np.concatenate([at[bit == 0], at[bit == 1]])
        self.first = self._descend(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            ones = self.ones[level][at]
            at = np.where((symbol >> b) & 1, self.zeros[level] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._descend(symbol, at) - self.first[symbol]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols at positions and their ranks there."""
        symbol = np.zeros(len(at), np.int64)
        for level, b in enumerate(range(self.bits - 1, -1, -1)):
            ones = self.ones[level][at]
            bit = self.ones[level][at + 1] - ones
            symbol |= bit.astype(np.int64) << b
            at = np.where(bit, self.zeros[level] + ones, at - ones)
        return symbol, at - self.first[symbol]


class FMIndex:
    """Backward search and location over a word array whose runs each end with a 0."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        order = suffix_array(text)
        self.size = len(text)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])
        bwt = text[order - 1]  # what precedes the first word is the last 0
        self.wavelet = WaveletMatrix(bwt, n_symbols)
        # Every SAMPLE-th position, and the starts of runs: a walk never crosses a run's end.
        self.sampled = (order % SAMPLE == 0) | (bwt == 0)
        self.slot = np.cumsum(self.sampled) - 1
        self.position = order[self.sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of all phrases; rows are aligned right, 0 pads them on the left."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        alive = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            alive = alive[phrases[alive, column] > 0]
            c = phrases[alive, column].astype(np.int64)
            lo[alive] = self.before[c] + self.wavelet.rank(c, lo[alive])
            hi[alive] = self.before[c] + self.wavelet.rank(c, hi[alive])
            alive = alive[lo[alive] < hi[alive]]
            if not len(alive):
                break
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows."""
        rows, out = rows.copy(), np.full(len(rows), -1, np.int64)
        walking, steps = np.arange(len(rows)), 0
        while len(walking):
            at = rows[walking]
            known = self.sampled[at]
            out[walking[known]] = self.position[self.slot[at[known]]] + steps
            walking = walking[~known]
            symbol, rank = self.wavelet.access(rows[walking])
            rows[walking] = self.before[symbol] + rank
            steps += 1
        return out


@dataclass
class Phrases:
    """Benchmark windows: vocabulary, right-aligned word ids, and the items that have them.

    Window ``w`` belongs to the items ``names[owner[first[w]:first[w + 1]]]``. Items without an
    id are searched like others, but have no name: they are in no window's list.
    """

    vocabulary: dict[bytes, int]
    words: np.ndarray
    sizes: np.ndarray
    names: list[str]
    first: np.ndarray
    owner: np.ndarray

    @staticmethod
    def build(rows: list[tuple[str | None, bytes]], window: int) -> Phrases:
        vocabulary: dict[bytes, int] = {}
        parts, of_item = [np.empty((0, window), np.int32)], []
        names = sorted({item for item, _ in rows if item is not None})
        number = {item: i for i, item in enumerate(names)} | {None: -1}
        for item, data in rows:
            ids = np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_alnum(data)], np.int32)
            if not len(ids):
                continue
            if len(ids) < window:
                ids = np.concatenate([np.zeros(window - len(ids), np.int32), ids])
            windows = sliding_window_view(ids, window)
            parts.append(windows)
            of_item.append(np.full(len(windows), number[item], np.int32))
        words, which = np.unique(np.concatenate(parts), axis=0, return_inverse=True)
        item = np.concatenate(of_item) if of_item else np.empty(0, np.int32)
        pairs = np.unique(np.column_stack([which.ravel(), item])[item >= 0], axis=0)
        first = np.searchsorted(pairs[:, 0], np.arange(len(words) + 1))
        return Phrases(vocabulary, words, (words > 0).sum(axis=1), names, first, pairs[:, 1].astype(np.int32))

    def items_of(self, windows: np.ndarray) -> set[str]:
        found = [self.owner[self.first[w]: self.first[w + 1]] for w in np.unique(windows)]
        return {self.names[i] for i in np.unique(np.concatenate(found)).tolist()} if found else set()


def _runs(ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of known words that are long enough for a phrase."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], (ids > 0).astype(np.int8), [0]])))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def search_shard(phrases: Phrases, docs: list[bytes]) -> list[tuple[int, np.ndarray, np.ndarray, set]]:
    """For each document: words, starts and ends of hit places (not merged), items found."""
    get, least = phrases.vocabulary.get, int(phrases.sizes.min()) if len(phrases.sizes) else 0
    parts, owner, origin, n_words = [], [], [], []
    for k, data in enumerate(docs):
        words = words_alnum(data)
        n_words.append(len(words))
        if not least or len(words) < least:
            continue
        ids = np.fromiter(map(get, words, repeat(0)), np.int32, len(words))
        for a, b in zip(*_runs(ids, least)):
            parts += [ids[a:b], np.zeros(1, np.int32)]
            owner.append(k)
            origin.append(a)
    none = np.empty(0, np.int64)
    if not parts:
        return [(n, none, none, set()) for n in n_words]
    text = np.concatenate(parts)
    run_start = np.concatenate([[0], np.flatnonzero(text == 0)[:-1] + 1])
    index = FMIndex(text, len(phrases.vocabulary) + 1)
    lo, hi = index.search(phrases.words)
    counts = hi - lo
    which = np.repeat(np.arange(len(counts)), counts)
    rows = np.repeat(lo, counts) + np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    places = index.locate(rows)
    run = np.searchsorted(run_start, places, side="right") - 1
    doc = np.asarray(owner)[run]
    start = np.asarray(origin)[run] + places - run_start[run]
    out = [(n, none, none, set()) for n in n_words]
    order = np.argsort(doc, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(doc[order])) + 1):
        if len(part):
            found = phrases.items_of(which[part])
            k = int(doc[part[0]])
            out[k] = (n_words[k], start[part], start[part] + phrases.sizes[which[part]], found)
    return out


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[list[int], list[int]]:
    """Maximal runs of the union of half-open spans."""
    if not len(starts):
        return [], []
    order = np.argsort(starts, kind="stable")
    s, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], s[1:] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(s) - 1]])
    return s[new].tolist(), reach[last].tolist()




def _search_block(docs: DataFrame, phrases: Phrases) -> DataFrame:
    """One pass over (``doc_id``, ``data``, found so far, carried) rows with one block of phrases."""
    shared = docs.sparkSession.sparkContext.broadcast(phrases)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Schema, list[tuple]]]:
        rows, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                for row in zip(*(c.to_pylist() for c in part.columns)):
                    rows.append(row)
                    size += len(row[1])
                    if size >= SHARD_BYTES:
                        yield batch.schema, rows
                        rows, size = [], 0
        if rows:
            yield batch.schema, rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for schema, rows in shards(batches):
            out = []
            for row, (n, starts, ends, items) in zip(rows, search_shard(shared.value, [r[1] for r in rows])):
                starts = np.concatenate([starts, np.asarray(row[3], np.int64)])
                ends = np.concatenate([ends, np.asarray(row[4], np.int64)])
                out.append((row[0], row[1], n, *merge_spans(starts, ends), sorted(items.union(row[5])), *row[6:]))
            yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*out), schema)], schema=schema)
        give_back()

    return docs.mapInArrow(run, docs.schema)


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(``doc_id``, ``data``, ``n_words``, ``span_start``, ``span_end``, ``items``) of every document.

    Spans are merged word ranges covered by occurrences of any ``window`` consecutive
    words of an item (a shorter item that has words is one window). The benchmark's size
    is checked first: each block of about ``block_bytes`` of it is broadcast and searched
    in a pass of its own, so a large benchmark costs passes, not memory. Null and blank
    texts have no words; items without an id are searched, but are in no list; equal item
    ids count once; document keys keep their type, item ids are given as text;
    repeated documents are searched one by one; columns named in ``carry`` come along, others
    are ignored; empty tables give no rows or no spans.
    """
    items = benchmark.select(F.col(item).cast("string").alias("i"), utf8(item_text).alias("d"))
    total = items.agg(F.sum(F.octet_length("d"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    none = F.array().cast("array<long>")
    found = docs.select(
        F.col(key).alias("doc_id"), utf8(text).alias("data"), F.lit(0).cast("long").alias("n_words"),
        none.alias("span_start"), none.alias("span_end"), F.array().cast("array<string>").alias("items"), *carry,
    )
    for b in range(blocks):
        rows = items.where(bucket_of(blocks, "i", "d") == b).collect()
        found = _search_block(found, Phrases.build([(r["i"], bytes(r["d"])) for r in rows], window))
    return found


def cut_words(data: bytes, starts: list[int], ends: list[int]) -> bytes:
    """The text without the given word ranges, each from its first word's start to its last word's end."""
    places = [m.span() for m in re.finditer(rb"[^ ]+", data.translate(WORD_ASCII))]
    out, at = [], 0
    for a, b in zip(starts, ends):
        out.append(data[at: places[a][0]])
        at = places[b - 1][1]
    return b"".join([*out, data[at:]])


def remove_passages(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows, with all their columns, their texts without benchmark passages.

    Texts without a hit stay as they are, null ones too.
    """
    others = F.struct(F.when(F.col(text).isNull(), True).alias("_null"), *[c for c in docs.columns if c != text])
    packed = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), others.alias("_row"))
    found = find_passages(packed, benchmark, window, "_key", "_text", carry=("_row",))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("data", "span_start", "span_end"))
            cut = [cut_words(*r).decode("utf-8", "replace") for r in zip(*columns)]
            yield pa.RecordBatch.from_arrays([pa.array(cut, pa.string()), batch.column("_row")], names=["text", "row"])

    result = StructType([StructField("text", StringType()), StructField("row", found.schema["_row"].dataType)])
    done = found.select("data", "span_start", "span_end", "_row").mapInArrow(run, result)
    new_text = F.when(F.col("row._null"), F.lit(None)).otherwise(F.col("text"))
    return done.select(*[(new_text if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op10_fm_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Words of each document inside 10-word windows of the benchmark."""
    found = find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate(
        F.zip_with("span_start", "span_end", lambda a, b: b - a), F.lit(0).cast("long"), lambda x, y: x + y
    )
    names = F.array_join(F.array_sort("items"), ",")
    return found.select(
        F.col("doc_id").cast("long"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
