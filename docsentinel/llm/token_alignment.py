"""Cross-tokenizer alignment by divide and conquer at shared cuts.

Two tokenizers cut the same bytes. A byte offset where tokens of both end is a shared cut.
An interval is split at a shared cut near its middle, found by bisecting the other
tokenizer's ends, and both halves are treated alike; an interval without an inner shared
cut is a leaf, one group of tokens. All intervals of a depth are split together.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsentinel.llm.common import from_planes, give_back, pa_schema, slices, table, tidy, to_planes
from docsentinel.llm.packing import byte_alphabet
from docsentinel.session import work_path

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
#: White space that begins a unit when none stands before it, and signs that do so after a letter A-Z or a-z.
SPACES, SIGNS = " \n\t", r"!-/:-@\[-`{-~"
_CORE = rf"[^\sA-Za-z]*(?:[A-Za-z]+(?:[^\sA-Za-z{SIGNS}][^\sA-Za-z]*)?)*"
UNIT = re.compile(rf"\s*{_CORE}(?:[^\S{SPACES}]\s*{_CORE})*")
_AT_ONCE = 1 << 19  # characters of a text whose units are listed at once
#: Places around an interval's middle that are tried before all its ends are.
_TRIES = (0, 1, -1, 2, -2)


def shared_groups(ends_a: np.ndarray, ends_b: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Rows (a0, a1, b0, b1) of the leaf groups inside ``spans``, in order.

    Ends are strictly increasing byte offsets; a span's last tokens end together.
    """
    leaves = []
    while len(spans):
        a0, a1, b0, b1 = spans.T
        inner = a1 - a0 - 1  # ends of A's tokens a0 .. a1 - 2 lie inside
        middle = a0 + (inner - 1) // 2
        cut_a, cut_b = np.full(len(spans), -1), np.full(len(spans), -1)
        open_ = np.flatnonzero((inner > 0) & (b1 - b0 > 1))
        for step in _TRIES:
            at = middle[open_] + step
            near = open_[(at >= a0[open_]) & (at < a1[open_] - 1)]
            at = middle[near] + step
            to = np.searchsorted(ends_b, ends_a[at])
            same = ends_b[to] == ends_a[at]
            cut_a[near[same]], cut_b[near[same]] = at[same], to[same]
            open_ = open_[cut_a[open_] < 0]
            if not len(open_):
                break
        stubborn = open_[inner[open_] > len(_TRIES)]
        split = np.flatnonzero(cut_a >= 0)
        halves = np.empty((2 * len(split), 4), np.int64)  # in order, so that the next ends looked for are ascending
        halves[:, :2] = np.column_stack([a0[split], cut_a[split] + 1, cut_a[split] + 1, a1[split]]).reshape(-1, 2)
        halves[:, 2:] = np.column_stack([b0[split], cut_b[split] + 1, cut_b[split] + 1, b1[split]]).reshape(-1, 2)
        for i in stubborn.tolist():  # long and hardly shared: all inner ends at once, none searched again
            at = np.arange(a0[i], a1[i] - 1)
            to = np.searchsorted(ends_b, ends_a[at])
            same = ends_b[to] == ends_a[at]
            cuts_a = np.concatenate([[a0[i]], at[same] + 1, [a1[i]]])
            cuts_b = np.concatenate([[b0[i]], to[same] + 1, [b1[i]]])
            leaves.append(np.column_stack([cuts_a[:-1], cuts_a[1:], cuts_b[:-1], cuts_b[1:]]))
        leaf = cut_a < 0
        leaf[stubborn] = False
        leaves.append(spans[leaf])
        spans = halves
    out = np.concatenate(leaves) if leaves else np.empty((0, 4), np.int64)
    return out[np.argsort(out[:, 0], kind="stable")]


class UnitTokens:
    """Both tokenizers' ids of whole texts, with each distinct unit encoded once.

    Neither tokenizer has a token across the start of a unit: A's pattern joins neither
    other characters to white space behind them nor letters to signs, and B's vocabulary is
    looked through for pieces that do. New units wait until ``settle``.
    """

    def __init__(self, path_a: str | None, path_b: str | None, max_units: int = 300_000, max_bytes: int = 16 << 20):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        if path_a is None or path_b is None:
            import public_tokenizers

            path_a, path_b = path_a or public_tokenizers.path(TOKENIZER_A), path_b or public_tokenizers.path(TOKENIZER_B)
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        to_byte = {c: b for b, c in byte_alphabet().items()}
        vocabulary = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(to_byte.get(c, 0) for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        across = re.compile(rf"[^▁\s][▁{SPACES}]|▁[\n\t]|\n.|[A-Za-z][{SIGNS}]")
        if any(across.search(p) for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))):
            raise ValueError("tokenizer B joins characters across the start of a unit")
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.space_a, self.space_b = byte_alphabet()[32], self.b.piece_to_id("▁")
        self.length_a, self.length_b = ([len(x) for x in y] for y in (self.bytes_a, self.bytes_b))
        self.size_a, self.size_b = np.array(self.length_a), np.array(self.length_b)
        self.max_units, self.max_bytes = max_units, max_bytes
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = array("I"), array("I")
        self.start = array("q"), array("q")
        self.size = array("q"), array("q")
        self.bad: set[int] = set()
        self.pending: list[str] = []
        self.held = 0

    def full(self) -> bool:
        return len(self.index) > self.max_units or self.held > self.max_bytes

    def _encode_a(self, units: list[str]) -> list[list[int]]:
        out: list = [None] * len(units)
        other, tokenize, signs = [], self.a.model.tokenize, self.space_a
        for k, u in enumerate(units):
            word = u[1:]
            if u[0] == " " and word.isascii() and word.isalpha():  # one word of A's pattern
                out[k] = [t.id for t in tokenize(signs + word)]
            else:
                other.append(k)
        for k, e in zip(other, self.a.encode_batch_fast([units[k] for k in other], add_special_tokens=False)):
            out[k] = e.ids
        return out

    def _encode_b(self, units: list[str]) -> list[list[int]]:
        # B puts a space first: the unit's own, or a piece of its own before a line feed or tab. Nothing
        # joins what follows a line feed to it.
        skip = [0 if u[0] == " " else 1 if u[0] in SPACES else 2 for u in units]
        out = self.b.encode([("", "", "\n")[n] + u[1 - min(n, 1):] for u, n in zip(units, skip)], num_threads=1)
        return [[self.space_b] if u == " " else ids[n:] if n else ids for u, ids, n in zip(units, out, skip)]

    def settle(self) -> None:
        """Encode the units that wait; those whose tokens' bytes are not the unit's get no ids."""
        units, self.pending = self.pending, []
        if not units:
            return
        data = [u.encode("utf-8", "surrogatepass") for u in units]
        both = self._encode_a(units), self._encode_b(units)
        whole, lengths = b"".join(data), list(map(len, data))
        wrong: set[int] = set()
        for ids, name, length in zip(both, (self.bytes_a, self.bytes_b), (self.length_a, self.length_b)):
            sizes = [sum(map(length.__getitem__, i)) for i in ids]
            if sizes != lengths or b"".join([name[i] for x in ids for i in x]) != whole:
                wrong.update(k for k, x in enumerate(ids) if b"".join(map(name.__getitem__, x)) != data[k])
        at = len(self.start[0])
        self.bad.update(at + k for k in wrong)
        for k in (0, 1):
            ids = [[] if i in wrong else x for i, x in enumerate(both[k])] if wrong else both[k]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            ends = np.cumsum(sizes) + len(self.flat[k])
            self.start[k].frombytes((ends - sizes).tobytes())
            self.size[k].frombytes(sizes.tobytes())
            self.flat[k].extend(chain.from_iterable(ids))
        self.held += len(whole) + 4 * sum(map(len, both[0])) + 4 * sum(map(len, both[1]))

    def units(self, found: list[str]) -> np.ndarray:
        """The units' numbers; new ones get the next numbers."""
        out = np.fromiter(map(self.index.get, found, repeat(-1)), np.int64, len(found))
        missing = np.flatnonzero(out < 0).tolist()
        if missing:
            new = list(dict.fromkeys(map(found.__getitem__, missing)))
            at = len(self.index)
            self.index.update(zip(new, range(at, at + len(new))))
            self.pending += new
            out[missing] = [self.index[found[i]] for i in missing]
        return out

    def ids(self, units: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The units' ids one after the other, and the number of each unit's."""
        flat, start, size = (np.frombuffer(x, t) for x, t in (
            (self.flat[k], np.uint32), (self.start[k], np.int64), (self.size[k], np.int64)))
        n = size[units]
        ends = np.cumsum(n)
        return flat[np.repeat(start[units] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)].astype(np.int64), n


class Alignment:
    """What one document has gathered so far."""

    def __init__(self, doc, with_groups: bool):
        self.doc, self.n_a, self.n_b, self.bad = doc, 0, 0, False
        self.digest, self.tail = hashlib.sha256(), b""
        self.links: list[np.ndarray] = []
        self.text: list[bytes] | None = [] if with_groups else None

    def add(self, n_a: int, n_b: int, links: np.ndarray, groups: bytes) -> None:
        """``groups`` ends with its separator, which is held back until more follows."""
        self.n_a, self.n_b = self.n_a + n_a, self.n_b + n_b
        self.links.append(links)
        self.digest.update(self.tail + groups[:-1])
        if self.text is not None:
            self.text.append(self.tail + groups[:-1])
        self.tail = b";"

    def close(self) -> None:
        if self.bad:
            self.__init__(self.doc, self.text is not None)
        self.keys = np.concatenate(self.links) if self.links else np.empty(0, np.int64)
        self.links = []


class Aligner:
    """Aligns parts of documents together, up to ``most`` units at a time."""

    def __init__(self, tokens: UnitTokens, with_groups: bool, most: int = 120_000):
        self.tokens, self.with_groups, self.most = tokens, with_groups, most
        n_a = len(tokens.bytes_a)
        self.shift = 2 * n_a
        self.names = [b"%d%s" % (i, s) for i in range(n_a) for s in (b",", b"|")]
        self.names += [b"%d%s" % (i, s) for i in range(len(tokens.bytes_b)) for s in (b",", b";")]
        self.parts: list[tuple[Alignment, np.ndarray]] = []
        self.waiting = 0

    def document(self, doc, text: str | None) -> Alignment:
        out = Alignment(doc, self.with_groups)
        if not text:
            return out
        if len(text) < _AT_ONCE:
            self._part(out, UNIT.findall(" " + text))
            return out
        places = (m.group() for m in UNIT.finditer(" " + text))
        while found := list(islice(places, self.most)):
            self._part(out, found)
        return out

    def _part(self, out: Alignment, found: list[str]) -> None:
        units = self.tokens.units([u for u in found if u])
        self.parts.append((out, units))
        self.waiting += len(units)
        if self.waiting >= self.most:
            self.flush()

    def flush(self) -> None:
        """Align the parts that wait; afterwards the unit numbers may be forgotten."""
        self.tokens.settle()
        if self.tokens.bad:
            wrong = np.array(sorted(self.tokens.bad))
            for out, units in self.parts:
                out.bad = out.bad or bool(np.isin(units, wrong).any())
        parts = [p for p in self.parts if not p[0].bad and len(p[1])]
        if parts:
            self._align(*map(list, zip(*parts)))
        self.parts, self.waiting = [], 0
        if self.tokens.full():
            self.tokens.clear()

    def _align(self, owners: list[Alignment], units: list[np.ndarray]) -> None:
        whole = np.concatenate(units)
        (ids_a, n_a), (ids_b, n_b) = self.tokens.ids(whole, 0), self.tokens.ids(whole, 1)
        until = np.cumsum([len(u) for u in units])
        part_a = np.concatenate([[0], np.cumsum(n_a)[until - 1]])
        part_b = np.concatenate([[0], np.cumsum(n_b)[until - 1]])
        ends_a, ends_b = np.cumsum(self.tokens.size_a[ids_a]), np.cumsum(self.tokens.size_b[ids_b])
        groups = shared_groups(ends_a, ends_b, np.column_stack([part_a[:-1], part_a[1:], part_b[:-1], part_b[1:]]))
        a0, a1, b0, b1 = groups.T
        links = ids_a[a1 - 1] * len(self.tokens.bytes_b) + ids_b[b1 - 1]
        # A group's A tokens come after all earlier B tokens, its B tokens after its A tokens.
        names = np.empty(len(ids_a) + len(ids_b), np.int64)
        last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        last_a[a1 - 1], last_b[b1 - 1] = 1, 1
        names[np.arange(len(ids_a)) + np.repeat(b0, a1 - a0)] = 2 * ids_a + last_a
        names[np.arange(len(ids_b)) + np.repeat(a1, b1 - b0)] = self.shift + 2 * ids_b + last_b
        first = np.searchsorted(a0, part_a)
        for i, owner in enumerate(owners):
            mine = names[part_a[i] + part_b[i]: part_a[i + 1] + part_b[i + 1]].tolist()
            owner.add(int(part_a[i + 1] - part_a[i]), int(part_b[i + 1] - part_b[i]), links[first[i]: first[i + 1]],
                      b"".join(map(self.names.__getitem__, mine)))


_ALIGNED = (
    "chunk long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, groups string, links binary, "
    "pairs array<long>, counts array<long>"
)


def _aligned(docs: DataFrame, tokenizer_a, tokenizer_b, chunk_bytes: int, with_groups: bool) -> DataFrame:
    """Rows of documents in chunks; a chunk's first row also has its distinct linked pairs and their counts.

    ``links`` are a document's links in order, as places among the chunk's pairs.
    """
    schema = pa_schema(_ALIGNED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(UnitTokens(tokenizer_a, tokenizer_b), with_groups)
        number, size, docs_ = TaskContext.get().partitionId() << 32, 0, []

        def chunk() -> pa.RecordBatch:
            aligner.flush()
            for d in docs_:
                d.close()
            pairs, where, counts = np.unique(np.concatenate([d.keys for d in docs_]), return_inverse=True, return_counts=True)
            bounds = np.concatenate([[0], np.cumsum([len(d.keys) for d in docs_])])
            where = where.astype(np.uint32)
            rest = [None] * (len(docs_) - 1)
            return pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip([
                [number] * len(docs_), [d.doc for d in docs_], [d.n_a for d in docs_], [d.n_b for d in docs_],
                [len(d.keys) for d in docs_], [d.digest.hexdigest() if d.n_a else "" for d in docs_],
                [b"".join(d.text).decode() if with_groups else None for d in docs_],
                [to_planes(where[a:b]) for a, b in zip(bounds, bounds[1:])], [pairs, *rest], [counts, *rest],
            ], schema)], schema=schema)

        for batch in batches:
            for part in slices(batch):
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    docs_.append(aligner.document(doc, text))
                    size += len(text or "") + 64
                    if size >= chunk_bytes:
                        yield chunk()
                        number, size, docs_ = number + 1, 0, []
        if docs_:
            yield chunk()
        del aligner
        give_back()

    return docs.mapInArrow(run, _ALIGNED)


def align(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer_a: str | None = None,
    tokenizer_b: str | None = None,
    chunk_bytes: int = 6 << 20,
    with_groups: bool = False,
) -> DataFrame:
    """Tokens, groups and links of every whole text under both tokenizers.

    ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``, and
    ``groups`` (``a1,a2|b1;a3|b2,b3``) on request. A's tokens all have bytes and B's too, so at
    a shared cut exactly one token of each ends: a group has one link, its last tokens. A
    pair's count is its number of links over all documents; ``n_best`` counts links with the
    highest count of their B id, ties included.

    Tokenizers are files that every executor can read (None: the installed public ones). Texts
    are aligned once and written to the shared folder, in chunks of ``chunk_bytes``; a chunk asks
    Spark for the counts of its distinct pairs only. Null and empty texts, and texts whose
    tokens do not give their bytes back, have no tokens: zeros and an empty ``groups_sha256``.
    Repeated rows and null keys are documents of their own; other columns are ignored; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    path = work_path(spark, "alignment", unique=True)
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    _aligned(texts, tokenizer_a, tokenizer_b, chunk_bytes, with_groups).write.option("compression", "zstd").parquet(path)
    done = spark.read.parquet(path)
    pairs = done.where(F.col("pairs").isNotNull()).select("chunk", F.posexplode(F.arrays_zip("pairs", "counts")).alias("at", "p"))
    pairs = pairs.select("chunk", "at", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair") % _pieces(tokenizer_b))
    # One row an id of B, so the size is the vocabulary's at most.
    highest = totals.groupBy("b").agg(F.max("count").alias("most"))
    judged = totals.join(F.broadcast(highest), "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    answers = pairs.select("chunk", "at", "pair").join(judged, "pair").select(F.col("chunk").alias("asker"), "at", "count", "best")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"
    out_schema = pa_schema(schema)

    def settle(rows: pa.Table, told: pa.Table) -> pa.Table:
        at = told.column("at").to_numpy()
        count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        count[at] = told.column("count").to_numpy()
        best[at] = told.column("best").to_numpy(zero_copy_only=False)
        sums, bests, sizes = [], [], []
        for raw in rows.column("links").to_pylist():
            places = from_planes(raw, "<u4") if raw else np.empty(0, np.uint32)
            sums.append(int(count[places].sum()))
            bests.append(int(best[places].sum()))
            sizes.append(len(places))
        same = [rows.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")]
        new = [pa.array(x, pa.int64()) for x in (sizes, bests, sums)]
        return pa.Table.from_arrays([*same, *new, rows.column("groups_sha256"), rows.column("groups")], schema=out_schema)

    rows = done.drop("pairs", "counts")
    out = rows.groupBy("chunk").cogroup(answers.groupBy("asker")).applyInArrow(tidy(settle), schema)
    return out if with_groups else out.drop("groups")


def _pieces(path: str | None) -> int:
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER_B)
    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()


def op13_align(spark, sf_dir: str) -> DataFrame:
    """Both public tokenizers' alignment of every document."""
    return align(table(spark, sf_dir, "documents"))
