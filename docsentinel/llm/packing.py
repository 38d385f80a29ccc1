"""Packing by power-of-two decomposition.

Each document's tokens are cut into pieces whose lengths are the powers of two of the
token count's binary form (the largest piece repeated as needed). Pieces of equal length
form a bucket; each piece is a sequence of its own, so no sequence crosses documents and
none is padded.
"""

from __future__ import annotations

import re
import zlib
from array import array
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsentinel.llm.common import LOWER_ASCII, bucket_of, map_rows, table, task_partitions, utf8
from docsentinel.session import ensure_checkpoint_dir

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: A run of plain lower-case Latin letters, then a run of ASCII signs that are no letters or digits.
_PLAIN = re.compile("([a-zß-öø-ÿ]+)([!-/:-@\\[-`{-~]*)")


def byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level BPE writes for each byte (public convention)."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table_ = {b: chr(b) for b in own}
    others = [b for b in range(256) if b not in table_]
    return table_ | {b: chr(256 + i) for i, b in enumerate(others)}


class WordEncoder:
    """Token ids of whole texts, with each distinct word encoded once.

    The tokenizer drops white space and never merges across it, so a text's ids are its
    words' ids in a row. Words of plain Latin letters need no normalisation and go to the
    merge model directly; all others, and texts that may hold special tokens, go through
    the whole tokenizer.
    """

    def __init__(self, path: str | None, end_id: int, max_words: int = 600_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        self.tokenizer = Tokenizer.from_file(path)
        self.alphabet = byte_alphabet()
        self.end_id, self.max_words = end_id, max_words
        self._clear()

    def _clear(self) -> None:
        """Forget the words; word 0 is the document's end."""
        self.index: dict[bytes, int] = {}
        self.pieces: dict[str, bytes] = {}  # ids as 32-bit numbers
        self.flat, self.start, self.size = array("I", [self.end_id]), array("q", [0]), array("q", [1])

    def _model_ids(self, piece: str) -> bytes:
        """Ids of one run that the tokenizer would hand to its merge model."""
        ids = self.pieces.get(piece)
        if ids is None:
            signs = piece if piece.isascii() else "".join(map(self.alphabet.__getitem__, piece.encode()))
            ids = self.pieces[piece] = array("I", [t.id for t in self.tokenizer.model.tokenize(signs)]).tobytes()
        return ids

    def _full_ids(self, data: bytes) -> list[int]:
        return self.tokenizer.encode(data.decode("utf-8", "replace"), add_special_tokens=False).ids

    def _word_ids(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        lowered = text.lower()
        if len(lowered) == len(text) and (plain := _PLAIN.fullmatch(lowered)):
            letters, signs = plain.groups()
            return self._model_ids(letters) + self._model_ids(signs) if signs else self._model_ids(letters)
        return array("I", self._full_ids(word)).tobytes()

    def _add(self, word: bytes) -> int:
        ids = self._word_ids(word)
        at = self.index[word] = len(self.start)
        self.start.append(len(self.flat))
        self.size.append(len(ids) // self.flat.itemsize)
        self.flat.frombytes(ids)
        return at

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text, ``end_id`` last."""
        if len(self.index) > self.max_words:
            self._clear()
        get, add = self.index.get, self._add
        rows, whole = [], {}
        for k, data in enumerate(texts):
            if b"<|" in data:
                whole[k] = np.array([*self._full_ids(data), self.end_id], np.uint32)
                rows.append(np.zeros(1, np.int64))
                continue
            words = data.translate(LOWER_ASCII).split()
            found = np.zeros(len(words) + 1, np.int64)
            found[:-1] = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
            for i in np.flatnonzero(found < 0).tolist():
                at = get(words[i])
                found[i] = add(words[i]) if at is None else at
            rows.append(found)
        flat, start, size = (np.frombuffer(x, t) for x, t in ((self.flat, np.uint32), (self.start, np.int64), (self.size, np.int64)))
        out = []
        for k, row in enumerate(rows):
            n = size[row]
            ends = np.cumsum(n)
            out.append(whole[k] if k in whole else flat[np.repeat(start[row] - ends + n, n) + np.arange(ends[-1])])
        return out


def binary_cuts(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: ``most`` as often as it fits, then n's binary form."""
    cuts, at = [(k * most, most) for k in range(n // most)], n // most * most
    size = most >> 1
    while at < n:
        if n - at >= size:
            cuts.append((at, size))
            at += size
        size >>= 1
    return cuts


def decompose(
    docs: DataFrame,
    most: int = 4096,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    with_ids: bool = False,
    max_words: int = 600_000,
) -> DataFrame:
    """Pieces of every whole document; ``with_ids`` adds their token ids.

    ``most`` is a power of two. ``tokenizer`` is a file every executor can read (None: the
    installed public one). Null and empty texts are the end token alone.
    """
    if most < 1 or most & (most - 1):
        raise ValueError("most must be a power of two")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    schema += ", ids array<long>" if with_ids else ""

    def make():
        encoder = WordEncoder(tokenizer, end_id, max_words)

        def batch(cols):
            out: dict[str, list] = {c.split()[0]: [] for c in schema.split(", ")}
            for doc, ids in zip(cols[0], encoder.encode(cols[1])):
                raw = memoryview(ids.astype("<u4").tobytes())
                for at, size in binary_cuts(len(ids), most):
                    out["doc_id"].append(doc)
                    out["start"].append(at)
                    out["length"].append(size)
                    out["ids_crc32"].append(zlib.crc32(raw[4 * at: 4 * (at + size)]))
                    out["doc_tokens"].append(len(ids))
                    if with_ids:
                        out["ids"].append(ids[at: at + size])
            return out

        return batch

    return map_rows(docs.select(F.col(key).cast("long"), utf8(text).alias("data")), schema, make)


def pack(
    docs: DataFrame,
    most: int = 4096,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    with_ids: bool = False,
    max_words: int = 600_000,
) -> DataFrame:
    """All pieces with the sequence each one fills: dense ids, longest bucket first.

    Numbers come from the counts of (length, sub-bucket) groups, so no task sees a whole
    bucket. Repeated documents are packed as often as they come; extra columns are
    ignored; an empty table gives no pieces.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    subs = min(4096, task_partitions(spark))
    pieces = decompose(docs, most, key, text, tokenizer, end_id, with_ids, max_words).checkpoint()
    grouped = pieces.withColumn("_sub", bucket_of(subs, "doc_id", "start"))
    counts = grouped.groupBy("length", "_sub").agg(F.count(F.lit(1)).alias("_n"))
    # One row a length: as many as ``most`` has bits, and one more.
    lengths = counts.groupBy("length").agg(F.sum("_n").alias("_all"))
    longer = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    first = lengths.select("length", F.coalesce(F.sum("_all").over(longer), F.lit(0)).alias("_first"))
    in_length = Window.partitionBy("length").orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    # At most (bits of ``most`` + 1) * subs rows, whatever the table's size.
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(in_length), F.lit(0))).join(
        F.broadcast(first), "length"
    ).select("length", "_sub", (F.col("_before") + F.col("_first")).alias("_before"))
    in_group = Window.partitionBy("length", "_sub").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    numbered = grouped.withColumn("_rn", F.row_number().over(in_group)).join(F.broadcast(offsets), ["length", "_sub"])
    return numbered.select(
        *[c for c in pieces.columns if c != "ids"],
        (F.col("_before") + F.col("_rn") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        *(["ids"] if with_ids else []),
    )


def op6_pack(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return pack(table(spark, sf_dir, "documents"))
