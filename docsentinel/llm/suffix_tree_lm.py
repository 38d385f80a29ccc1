"""Language-model scores by a probabilistic suffix tree.

The tree predicts a text byte by byte: each lower-cased word, a space after it, and a
line feed at the end. Its states are contexts of up to ``depth`` bytes, read backwards.
A context is a state if it is frequent enough and its next-byte distribution diverges
from its parent's (the context without its oldest byte), or if a longer state needs it.
Distributions are smoothed towards the parent's; the longest state that ends a position's
context scores the next byte.

Tasks count the byte grams and words of the training texts they scan, a chunk at a time,
and send the sums to buckets, which add them up and grow their part of the tree. States of
three bytes and more stay in their bucket; only contexts of up to two bytes, of which there
are at most 65,792, are gathered. For the scores, documents are dealt into blocks; a block
asks each bucket for the counts of its distinct words and the probabilities of its distinct
byte grams.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsentinel.llm.common import (
    block_count, count_sorted, from_planes, give_back, held_out, pa_schema, slices, table, task_partitions, text_blocks, tidy,
    to_planes, utf8, words_any_space,
)
from docsentinel.session import ensure_checkpoint_dir

DEPTH = 6
#: A state's context occurs at least so often, however large the corpus.
LEAST = 2
BLOCK_BYTES = 8 << 20
CHUNK_BYTES = 16 << 20
_END = 10
_PIECE = 1 << 19
_RANGES = 4  # of contexts, that a block's grams are sorted in
_BEFORE = 7  # bytes before a place that are read with it, DEPTH of them its context
_SPARE = 2  # slots a number has in a lookup table, at least
_MIXES = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xFF51AFD7ED558CCD))
_ROWS = 64  # blocks that a bucket answers at once
FAN = 256  # chunks summed, and blocks answered, by one group
_WORDS, _GRAMS, _TOTALS, _SHORT, _STATES = 0, 1, 2, 3, 4
_SCHEMA = "kind int, bucket int, a binary, b binary, c binary, d binary"
_COUNTED = "kind int, bucket int, part long, a binary, b binary"
_ASKED = "block int, bucket int, a binary, b binary"


def byte_sequence(words: list[bytes]) -> bytes:
    """What the tree predicts for a text."""
    return b" ".join(words) + b" \n" if words else b"\n"


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences in a row, each after DEPTH end marks, and the first place of each one's own bytes."""
    pad, front = bytes([_END]) * DEPTH, _BEFORE - DEPTH
    seq = np.frombuffer(b"".join([pad[:front], *(pad + t for t in texts)]), np.uint8)
    sizes = np.fromiter((len(t) + DEPTH for t in texts), np.int64, len(texts))
    return seq, np.cumsum(sizes) - sizes + _BEFORE


def _own(n: int, starts: np.ndarray) -> np.ndarray:
    own = np.ones(n, bool)
    own[:_BEFORE] = False
    for back in range(1, DEPTH + 1):
        own[starts - back] = False
    return own


def gram_keys(seq: np.ndarray, at: int, chosen: np.ndarray) -> np.ndarray:
    """For each chosen place from ``at`` on: context bytes, latest first, then the byte itself, packed from the high end."""
    # Overlapping 8-byte numbers whose highest byte is the place's own and the next ones its context.
    eight = np.ndarray((len(chosen),), "<u8", seq, at - _BEFORE, (1,))[chosen]
    key = eight << np.uint64(8)
    key >>= np.uint64(64 - 8 * DEPTH)
    key <<= np.uint64(8)
    eight >>= np.uint64(56)
    key |= eight
    return key


def parts_of(texts: Iterable[bytes], part_bytes: int) -> Iterator[list[bytes]]:
    """Texts in a row, some at a time."""
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= part_bytes:
            yield part
            part, size = [], 0
    if part:
        yield part


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers of a sorted row, and how often each occurs."""
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.append(first, len(keys)))


def count_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct gram keys in order, and how often each occurs; a range of latest context bytes at a time."""
    seq, starts = laid_out(texts)
    own = _own(len(seq), starts)
    pieces = [(at, min(at + _PIECE, len(seq))) for at in range(_BEFORE, len(seq), _PIECE)]
    latest = np.zeros(256, np.int64)
    for at, stop in pieces:
        latest += np.bincount(seq[at - 1: stop - 1][own[at:stop]], minlength=256)
    part = ((np.cumsum(latest) - latest) * _RANGES // max(1, len(seq))).astype(np.uint8)
    of = np.full(len(seq), _RANGES, np.uint8)
    for at, stop in pieces:
        np.copyto(of[at:stop], part[seq[at - 1: stop - 1]], where=own[at:stop])
    keys, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for r in np.unique(part):
        new = np.empty(int(latest[part == r].sum()), np.uint64)
        done = 0
        for at, stop in pieces:
            some = gram_keys(seq, at, of[at:stop] == r)
            new[done: done + len(some)] = some
            done += len(some)
        new.sort()
        for row, found in zip((keys, counts), _counted(new)):
            row.append(found)
    return np.concatenate(keys), np.concatenate(counts)


def _by_bucket(bucket: np.ndarray, buckets: int) -> list[np.ndarray]:
    """The places of each bucket's items, in order."""
    ends = np.cumsum(np.bincount(bucket, minlength=buckets))
    return np.split(np.argsort(bucket, kind="stable"), ends[:-1])


def _gram_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """By the three latest context bytes, so that a bucket has whole subtrees."""
    mixed = (keys >> np.uint64(8 * (DEPTH - 2))) * _MIXES[0] >> np.uint64(33)
    return (mixed % np.uint64(buckets)).astype(np.int64)


@dataclass
class Lookup:
    """A value for each of a set of distinct numbers, found again without a search.

    A table's slot that only one number falls on has its value; a slot of several has NaN,
    and they are in the next table. What is left after the last table is searched.
    """

    tables: list[tuple[np.uint64, np.ndarray]]
    keys: np.ndarray
    values: np.ndarray

    @staticmethod
    def build(keys: np.ndarray, values: np.ndarray) -> Lookup:
        """``keys`` in order; none of ``values`` is NaN."""
        tables = []
        for mix in _MIXES:
            slots = np.full(1 << max(8, (_SPARE * len(keys) - 1).bit_length()), np.nan, values.dtype)
            tables.append((mix, slots))
            slot = Lookup._slot(keys, mix, slots)
            alone = np.bincount(slot, minlength=len(slots))[slot] == 1
            slots[slot[alone]] = values[alone]
            keys, values = keys[~alone], values[~alone]
        return Lookup(tables, keys, values)

    @staticmethod
    def _slot(keys: np.ndarray, mix: np.uint64, slots: np.ndarray) -> np.ndarray:
        return ((keys * mix) >> np.uint64(65 - len(slots).bit_length())).view(np.int64)

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        """Values of numbers that are all in the set."""
        (mix, slots), *others = self.tables
        out = slots[self._slot(wanted, mix, slots)]
        left = np.flatnonzero(np.isnan(out))
        for mix, slots in others:
            found = slots[self._slot(wanted[left], mix, slots)]
            out[left] = found
            left = left[np.isnan(found)]
        out[left] = self.values[np.searchsorted(self.keys, wanted[left])]
        return out


@dataclass
class BlockWords:
    """Hashes of all tokens in a row, end marks included; tokens of each text; byte sequences."""

    hashes: np.ndarray
    sizes: np.ndarray
    sequences: list[bytes]

    @staticmethod
    def build(texts: Iterable[bytes]) -> BlockWords:
        hashes, sequences = [np.empty(0, np.uint64)], []
        for data in texts:
            words = words_any_space(data)
            sequences.append(byte_sequence(words))
            words.append(b"")
            hashes.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
        return BlockWords(np.concatenate(hashes), np.array([len(x) for x in hashes[1:]], np.int64), sequences)

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashes in order, and how often each occurs."""
        return _counted(np.sort(self.hashes))


def _word_bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes % np.uint64(buckets)).astype(np.int64)


def by_depth(keys: np.ndarray, counts: np.ndarray, depth: int):
    """(context, next byte, count) of one depth, in order."""
    shift = np.uint64(8 * (DEPTH + 1 - depth))
    return _split(*count_sorted(((keys >> shift) << np.uint64(8)) | (keys & np.uint64(255)), counts))


def _split(keys, counts):
    return keys >> np.uint64(8), keys & np.uint64(255), counts


def _totals(ctx, counts):
    first = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]])) if len(ctx) else np.empty(0, np.int64)
    return ctx[first], np.add.reduceat(counts, first) if len(ctx) else counts, first


def diverging(level, parent, n_total: int) -> np.ndarray:
    """Contexts of ``level`` whose distribution differs from the parent's beyond what its size explains.

    The test compares count times Kullback-Leibler divergence with a description-length
    penalty for the context's own parameters.
    """
    ctx, nxt, count = level
    p_ctx, p_nxt, p_count = parent
    if not len(ctx):
        return ctx
    own, total, first = _totals(ctx, count)
    kinds = np.diff(np.append(first, len(ctx)))
    n = np.repeat(total, kinds)
    of, p_total, _ = _totals(p_ctx, p_count)
    up = ctx >> np.uint64(8)
    p_n = p_total[np.searchsorted(of, up)]
    place = np.searchsorted((p_ctx << np.uint64(8)) | p_nxt, (up << np.uint64(8)) | nxt)
    gain = np.add.reduceat(count * np.log((count / n) / (p_count[place] / p_n)), first)
    return own[gain > 0.5 * kinds * np.log(max(n_total, 2))]


def frequent(level, least: int):
    ctx, nxt, count = level
    own, total, _ = _totals(ctx, count)
    keep = np.isin(ctx, own[total >= least])
    return ctx[keep], nxt[keep], count[keep]


def states_of(levels: dict[int, tuple], d: int, n_total: int) -> tuple:
    """Level ``d`` without contexts that neither diverge from their parent nor are needed by a state of the next level."""
    needed = levels[d + 1][0] >> np.uint64(8) if d < DEPTH else np.empty(0, np.uint64)
    keep = np.isin(levels[d][0], np.union1d(diverging(levels[d], levels[d - 1], n_total), needed))
    return tuple(x[keep] for x in levels[d])


def grow(keys: np.ndarray, counts: np.ndarray, least: int, n_total: int) -> dict[int, tuple]:
    """Levels of a bucket's part of the tree: its share of depths 1 and 2, frequent contexts of 3, states from 4 on."""
    levels = {d: by_depth(keys, counts, d) for d in (1, 2)}
    for d in range(3, DEPTH + 1):
        levels[d] = frequent(by_depth(keys, counts, d), least)
    for d in range(DEPTH, 3, -1):
        levels[d] = states_of(levels, d, n_total)
    return levels


def in_row(levels: dict[int, tuple]) -> tuple:
    """(depth, context, next, count) arrays of levels."""
    depth = np.concatenate([np.full(len(x[0]), d, np.uint8) for d, x in levels.items()])
    return depth, *(np.concatenate([x[i] for x in levels.values()]) for i in range(3))


def summed_levels(parts: list[tuple], depths: Iterable[int]) -> dict[int, tuple]:
    """Levels from (depth, context, next, count) arrays, equal contexts summed."""
    parts = parts or [tuple(np.empty(0, t) for t in (np.uint8, np.uint64, np.uint64, np.int64))]
    depth, ctx, nxt, count = (np.concatenate(x) for x in zip(*parts))
    return {d: _split(*count_sorted((ctx[depth == d] << np.uint64(8)) | nxt[depth == d], count[depth == d])) for d in depths}


@dataclass
class SuffixTree:
    """States with next-byte counts, by depth: a whole tree, or the part that a bucket's grams need."""

    levels: dict[int, tuple]

    @staticmethod
    def assemble(parts: list[tuple], least: int, n_total: int) -> SuffixTree:
        """The whole tree from the buckets' (depth, context, next, count) arrays."""
        levels = summed_levels(parts, range(1, DEPTH + 1))
        levels[2] = frequent(levels[2], least)
        for d in (3, 2):
            levels[d] = states_of(levels, d, n_total)
        return SuffixTree(levels)

    @cached_property
    def tables(self) -> list[tuple]:
        """By depth: contexts, their totals and numbers of next bytes; (context, next byte) and its counts."""
        out = []
        for d in range(1, DEPTH + 1):
            ctx, nxt, count = self.levels[d]
            own, total, first = _totals(ctx, count)
            out.append((own, total, np.diff(np.append(first, len(ctx))), (ctx << np.uint64(8)) | nxt, count))
        return out

    def log_probs(self, keys: np.ndarray) -> np.ndarray:
        """log10 probabilities of the last bytes of grams, each by the longest state that ends its context."""
        byte = keys & np.uint64(255)
        seen, n = count_sorted(self.levels[1][1], self.levels[1][2])
        root = np.ones(256)
        root[seen.astype(np.int64)] += n
        p = (root / (n.sum() + 257.0))[byte.astype(np.int64)]
        going = np.arange(len(keys))
        for d, (own, total, kinds, pairs, count) in enumerate(self.tables, 1):
            if not len(own):
                break
            ctx = keys[going] >> np.uint64(8 * (DEPTH + 1 - d))
            at = np.minimum(np.searchsorted(own, ctx), len(own) - 1)
            deeper = own[at] == ctx
            going, at, pair = going[deeper], at[deeper], (ctx[deeper] << np.uint64(8)) | byte[going[deeper]]
            place = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
            times = np.where(pairs[place] == pair, count[place], 0)
            p[going] = (times + kinds[at] * p[going]) / (total[at] + kinds[at])
        return np.log10(p)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 probabilities of byte sequences."""
        keys, _ = count_grams(texts)
        return sequence_scores(texts, keys, self.log_probs(keys))


def sequence_scores(texts: list[bytes], keys: np.ndarray, gains: np.ndarray) -> np.ndarray:
    """Sums over byte sequences of their grams' gains, a few MB of texts at a time; ``keys`` has all grams in order."""
    gain_of = Lookup.build(keys, gains)
    return np.concatenate([np.empty(0), *(_sums(part, gain_of) for part in parts_of(texts, _PIECE))])


def _sums(texts: list[bytes], gain_of: Lookup) -> np.ndarray:
    seq, starts = laid_out(texts)
    own = _own(len(seq), starts)
    gained = np.zeros(len(seq))
    for at in range(_BEFORE, len(seq), _PIECE):
        stop = min(at + _PIECE, len(seq))
        gained[at:stop][own[at:stop]] = gain_of(gram_keys(seq, at, own[at:stop]))
    return np.add.reduceat(gained, starts - DEPTH)


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.Table.from_arrays([pa.array(c, x.type) for c, x in zip(columns, schema)], schema=schema)


def _count_chunks(buckets: int, chunk_bytes: int):
    """Word and gram counts of the texts a task scans, by bucket, a chunk at a time; ``part`` numbers the chunk."""
    schema = pa_schema(_COUNTED)

    def count(texts: list[bytes], part: int) -> pa.RecordBatch:
        known = BlockWords.build(texts)
        rows = []
        for kind, (keys, size), bucket_of in (
            (_WORDS, known.counted(), _word_bucket), (_GRAMS, count_grams(known.sequences), _gram_bucket),
        ):
            for b, on in enumerate(_by_bucket(bucket_of(keys, buckets), buckets)):
                if len(on):
                    rows.append((kind, b, part, to_planes(keys[on]), to_planes(size[on].astype(np.int64))))
        return _table(schema, rows).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, size, part = [], 0, TaskContext.get().partitionId() << 24
        for batch in batches:
            for rows in slices(batch):
                for data in rows.column(0).to_pylist():
                    texts.append(data)
                    size += len(data)
                    if size >= chunk_bytes:
                        yield count(texts, part)
                        texts, size, part = [], 0, part + 1
        if texts:
            yield count(texts, part)
        give_back()

    return run


def _summed(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([from_planes(x.as_py(), "u8") for x in group.column("a")])
    return count_sorted(keys, np.concatenate([from_planes(x.as_py(), "i8") for x in group.column("b")]))


def _merge_parts():
    """Some chunks' counts of one bucket, summed."""
    schema = pa_schema(_COUNTED)

    def run(group: pa.Table) -> pa.Table:
        kind, bucket, part = (group.column(c)[0].as_py() for c in ("kind", "bucket", "group"))
        return _table(schema, [(kind, bucket, part, *map(to_planes, _summed(group)))])

    return tidy(run)


def counted_chunks(training: DataFrame, buckets: int, chunk_bytes: int, n_total: int) -> DataFrame:
    """Word and gram counts by bucket, in at most about ``FAN`` parts each.

    A bucket's grams follow one another in the tree, and those after a common trigram are
    one bucket: chunks are summed in rounds, so that no group reads a part of every chunk.
    """
    counted = training.mapInArrow(_count_chunks(buckets, chunk_bytes), _COUNTED)
    parts = n_total // chunk_bytes + 1
    while parts > FAN:
        parts = -(-parts // FAN)
        grouped = counted.withColumn("group", F.pmod(F.xxhash64("part"), F.lit(parts)))
        counted = grouped.groupBy("kind", "bucket", "group").applyInArrow(_merge_parts(), _COUNTED)
    return counted


def _sum_bucket(least: int, n_total: int):
    """Per bucket: words' counts and totals, or the bucket's part of the tree."""
    schema = pa_schema(_SCHEMA)

    def run(group: pa.Table) -> pa.Table:
        kind, bucket = group.column("kind")[0].as_py(), group.column("bucket")[0].as_py()
        keys, counts = _summed(group)
        if kind == _WORDS:
            totals = np.array([counts.sum(), len(counts)], np.int64)
            return _table(schema, [
                (_WORDS, bucket, to_planes(keys), to_planes(counts), b"", b""),
                (_TOTALS, bucket, to_planes(totals), b"", b"", b""),
            ])
        levels = grow(keys, counts, least, n_total)
        return _table(schema, [
            (kind, bucket, *map(to_planes, in_row({d: x for d, x in levels.items() if (d < 3) == (kind == _SHORT)})))
            for kind in (_SHORT, _STATES)
        ])

    return tidy(run)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and distinct words of each bucket."""
    for batch in batches:
        both = [from_planes(x, "i8").tolist() for x in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in both], pa.int64()) for i in (0, 1)], names=["n", "k"])


def _levels(row: tuple) -> tuple:
    return tuple(from_planes(x, t) for x, t in zip(row, ("u1", "u8", "u8", "i8")))


def _settled(batches: Iterator[pa.RecordBatch], short: dict[int, tuple], n_total: int) -> Iterator[tuple]:
    """Buckets and their states of three bytes and more, once the counts of two bytes are known as a whole."""
    for batch in batches:
        for kind, bucket, *row in zip(*(c.to_pylist() for c in batch.columns)):
            levels = summed_levels([_levels(row)], range(3, DEPTH + 1))
            yield kind, bucket, levels | {3: states_of(short | levels, 3, n_total)}


def _settle(short, n_total: int):
    schema = pa_schema(_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, bucket, levels in _settled(batches, short.value, n_total):
            yield from _table(schema, [(kind, bucket, *map(to_planes, in_row(levels)))]).to_batches()

    return run


def _needed(short, n_total: int):
    """Contexts of two bytes that the buckets' states need."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, levels in _settled(batches, short.value, n_total):
            above = np.unique(levels[3][0] >> np.uint64(8)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(above)], names=["ctx"])

    return run


def _ask(buckets: int):
    """Per block: its distinct words' hashes and its distinct grams, for each bucket."""
    schema = pa_schema(_ASKED)

    def run(block: pa.Table) -> pa.Table:
        known, number = BlockWords.build(x.as_py() for x in block.column("data")), block.column("block")[0].as_py()
        (words, _), (grams, _) = known.counted(), count_grams(known.sequences)
        parts = zip(_by_bucket(_word_bucket(words, buckets), buckets), _by_bucket(_gram_bucket(grams, buckets), buckets))
        return _table(schema, [
            (number, b, to_planes(words[w]), to_planes(grams[g])) for b, (w, g) in enumerate(parts) if len(w) or len(g)
        ])

    return tidy(run)


def _answer(shared):
    """Per bucket: the words' training counts and the grams' log10 probabilities that each block asks for, in its order."""
    schema = pa_schema(_ASKED)

    def run(asked: pa.Table, kept: pa.Table) -> pa.Table:
        rows = {kind: row for kind, *row in zip(*(kept.column(c).to_pylist() for c in ("kind", "a", "b", "c", "d")))}
        keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        if _WORDS in rows:
            keys, counts = (from_planes(x, t) for x, t in zip(rows[_WORDS], ("u8", "i8")))
        parts = [_levels(rows[_STATES])] if _STATES in rows else []
        tree, out = SuffixTree(shared.value | summed_levels(parts, range(3, DEPTH + 1))), []
        for at in range(0, asked.num_rows, _ROWS):
            block, bucket, words, grams = (asked.slice(at, _ROWS).column(c).to_pylist() for c in ("block", "bucket", "a", "b"))
            grams = [from_planes(x, "u8") for x in grams]
            distinct, which = np.unique(np.concatenate(grams), return_inverse=True)
            gains = np.split(tree.log_probs(distinct).astype(np.float32)[which], np.cumsum([len(x) for x in grams])[:-1])
            for number, b, raw, gain in zip(block, bucket, words, gains):
                wanted = from_planes(raw, "u8")
                place = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
                found = np.where(keys[place] == wanted, counts[place], 0) if len(keys) else np.zeros(len(wanted), np.int64)
                out.append((number, b, to_planes(found), to_planes(gain)))
        return _table(schema, out)

    return tidy(run)


_OUT = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def _score_block(buckets: int, n_words: int, n_kinds: int):
    schema = pa_schema(_OUT)

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        if not block.num_rows:
            return schema.empty_table()
        known = BlockWords.build(x.as_py() for x in block.column("data"))
        (words, _), (grams, _) = known.counted(), count_grams(known.sequences)
        words_of, grams_of = (_by_bucket(x, buckets) for x in (_word_bucket(words, buckets), _gram_bucket(grams, buckets)))
        count, gains = np.zeros(len(words)), np.zeros(len(grams), np.float32)
        for b, raw, raw_gains in zip(*(answers.column(c).to_pylist() for c in ("bucket", "a", "b"))):
            count[words_of[b]] = from_planes(raw, "i8")
            gains[grams_of[b]] = from_planes(raw_gains, "f4")
        ends = np.cumsum(known.sizes)[:-1]
        times = Lookup.build(words, count)(known.hashes)
        gain = np.split(np.log10((times + 1.0) / (n_words + n_kinds + 1.0)), ends)
        columns = {
            "doc_id": block.column("doc_id"), "held_out": block.column("held_out"),
            "n_tokens": known.sizes, "n_known": [np.count_nonzero(x) for x in np.split(times, ends)],
            "train_tokens": [n_words] * block.num_rows, "base_score": [float(x.sum()) for x in gain],
            "score": sequence_scores(known.sequences, grams, gains),
        }
        made = [c if isinstance(c, pa.ChunkedArray) else pa.array(c, schema.field(k).type) for k, c in columns.items()]
        return pa.Table.from_arrays(made, schema=schema)

    return tidy(run)


def score_texts(
    docs: DataFrame,
    folds: int = 7,
    out: int = 2,
    key: str = "doc_id",
    text: str = "text",
    least: int = LEAST,
    block_bytes: int = BLOCK_BYTES,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Tree and unigram scores of every whole text; the held-out fold is not learnt from.

    Columns: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score``. Null and blank texts are the end mark alone. Without
    training texts, N and V are 0 and the tree is uniform. Repeated rows count as often
    as they come; extra columns are ignored; an empty table gives none.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    blocks = block_count(docs, text, block_bytes)
    buckets = max(task_partitions(spark), 2 * blocks)
    fold = held_out(key, folds, out)
    training = docs.where(~fold)
    n_total = training.agg(F.sum(F.octet_length(text))).first()[0] or 0
    counted = counted_chunks(training.select(utf8(text).alias("data")), buckets, chunk_bytes, n_total)
    summed = counted.groupBy("kind", "bucket").applyInArrow(_sum_bucket(least, n_total), _SCHEMA).checkpoint()
    totals = summed.where(F.col("kind") == _TOTALS).select("a").mapInArrow(_unpacked, "n long, k long")
    n_words, n_kinds = totals.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("k"), F.lit(0))).first()
    # Contexts of up to two bytes, whatever the input.
    short = summed_levels([
        _levels(tuple(map(bytes, r))) for r in summed.where(F.col("kind") == _SHORT).select("a", "b", "c", "d").collect()
    ], (1, 2))
    short[2] = frequent(short[2], least)
    context = spark.sparkContext
    both_bytes, grown = context.broadcast(short), summed.where(F.col("kind") == _STATES)
    above = grown.mapInArrow(_needed(both_bytes, n_total), "ctx long").distinct().collect()
    needed = np.array([r["ctx"] for r in above], np.uint64)
    states = grown.mapInArrow(_settle(both_bytes, n_total), _SCHEMA)
    keep = np.isin(short[2][0], np.union1d(diverging(short[2], short[1], n_total), needed))
    shared = context.broadcast(short | {2: tuple(x[keep] for x in short[2])})
    by_block = text_blocks(docs, key, text, blocks, fold.alias("held_out")).groupBy("block")
    kept = summed.where(F.col("kind") == _WORDS).union(states)
    # A bucket answers at most about FAN blocks in one group; its part of the tree goes to each of its groups.
    groups = -(-blocks // FAN)
    asked = by_block.applyInArrow(_ask(buckets), _ASKED).withColumn("group", F.pmod("block", F.lit(groups)))
    each = kept.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    answers = asked.groupBy("bucket", "group").cogroup(each.groupBy("bucket", "group")).applyInArrow(_answer(shared), _ASKED)
    both = by_block.cogroup(answers.groupBy("block"))
    return both.applyInArrow(_score_block(buckets, n_words, n_kinds), _OUT)


def op3_suffix_tree(spark, sf_dir: str) -> DataFrame:
    """Scores of every document."""
    return score_texts(table(spark, sf_dir, "documents"))
