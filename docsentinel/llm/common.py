"""Shared helpers of the text operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Lower-cases A-Z and turns every ASCII byte that is no letter or digit into a space.
WORD_ASCII = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or 48 <= b <= 57 or b > 127 else 32 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def utf8(col: str | Column) -> Column:
    """A text column's UTF-8 bytes; null counts as the empty text."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(col, F.lit("")).cast("binary")


def task_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions: what block counts scale with."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def bucket_of(n: int, *cols: str | Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def held_out(key: str, folds: int, out: int) -> Column:
    """Whether the checksum of the key's text leaves ``out`` modulo ``folds`` (null key: the empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds == out


def words_any_space(data: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words between ASCII white space: ``[^\\x20\\x09-\\x0D]+``."""
    return data.translate(LOWER_ASCII).split()


def words_alnum(data: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    return data.translate(WORD_ASCII).split()


def block_count(docs: DataFrame, text: str, block_bytes: int) -> int:
    return int((docs.agg(F.sum(F.octet_length(text))).first()[0] or 0) // block_bytes) + 1


def text_blocks(docs: DataFrame, key: str, text: str, blocks: int, *extra: str | Column) -> DataFrame:
    """(``doc_id``, ``data``, ``block``, *extra*) dealt over so many blocks.

    A block is a hash of key and text, so it holds the same documents whenever it is
    computed again, and one key's different texts are dealt out too; rows equal in both
    share a block.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), utf8(text).alias("data"), *extra)
    placed = rows.withColumn("block", bucket_of(blocks, "doc_id", "data"))
    return placed.repartition(max(min(blocks, 4 * task_partitions(docs.sparkSession)), blocks // 16), "block")


def to_planes(a: np.ndarray) -> bytes:
    """An array's bytes, all first bytes first: sorted numbers then compress well in a shuffle."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def from_planes(raw: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def count_sorted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their counts summed."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)


def give_back() -> None:
    """Return freed memory to the system: Python workers live on and would keep it through later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def tidy(run: Callable) -> Callable:
    """A function of one or two groups that gives memory back after each call."""

    def call(*groups):
        try:
            return run(*groups)
        finally:
            give_back()

    # Spark counts the parameters.
    return (lambda a: call(a)) if run.__code__.co_argcount == 1 else (lambda a, b: call(a, b))


def slices(batch: pa.RecordBatch, rows: int = 256, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most ``rows`` rows and about ``size`` bytes of text; a longer text is one part."""
    total = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_binary(column.type) or pa.types.is_string(column.type):
            total += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at = np.cumsum(total), 0
    while at < batch.num_rows:
        until = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right"))
        until = min(max(until, at + 1), at + rows, batch.num_rows)
        yield batch.slice(at, until - at)
        at = until


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[[list], dict[str, list]]], chunk: int = 256) -> DataFrame:
    """Apply a batch function inside tasks.

    ``make()`` runs once per task and returns a function from the columns of a
    slice of rows (a list of Python lists) to a dict of output columns. Slices are
    bounded by rows and by bytes.
    """
    out_schema = pa_schema(schema)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for part in slices(batch, chunk):
                cols = f([part.column(n).to_pylist() for n in names])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[x.name], type=x.type) for x in out_schema], schema=out_schema
                )
        del f
        give_back()

    return df.mapInArrow(run, schema)


_ARROW = {
    "long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
    "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string()),
}


def pa_schema(schema: str) -> pa.Schema:
    return pa.schema([(n, _ARROW[t]) for n, t in (x.split() for x in schema.split(", "))])
