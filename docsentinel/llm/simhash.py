"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Two 64-bit fingerprints with at most ``d`` differing bits agree in at least ``8 - d`` of
their 8 positional bytes. Sharing ``m`` of 8 bytes means sharing 3 of the first 7 when
``m >= 4``, so postings are kept under each triple of positions of the first seven: a
list holds the fingerprints that share those three positional bytes. Within a list, the
shared positional bytes of each pair are tallied, pairs under the guaranteed minimum are
dropped, and the rest are verified by their differing bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsentinel.llm.common import map_rows, pa_schema, table, task_partitions, utf8, words_any_space
from docsentinel.llm.components import connected_components
from docsentinel.session import ensure_checkpoint_dir

SEED = 42
_TRIPLES = list(combinations(range(7), 3))
#: Lists up to this size compare all their pairs; longer ones are walked as a graph.
_SHORT = 32
#: Walked lists above this size are first split by a fourth shared byte.
_LONG = 20_000


def simhash(data: bytes, shingle: int) -> int:
    """64-bit fingerprint of the lower-cased words' shingles; 0 without words."""
    words = words_any_space(data)
    if not words:
        return 0
    joined, n = b" ".join(words), len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    if n <= 1:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        a, b = starts[at: at + 65536][: n - at].tolist(), (ends[at + shingle - 1: at + shingle - 1 + 65536] - 1).tolist()
        hashes = np.array([digest(joined[x:y], SEED) for x, y in zip(a, b)], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc_id``, ``fp``, ``text_hash``): the fingerprint of every whole text, as a signed long, and its text's hash."""
    def make():
        def batch(cols):
            prints = np.array([simhash(x, shingle) for x in cols[1]], np.uint64).view(np.int64)
            return {"doc_id": cols[0], "fp": prints, "text_hash": cols[2]}

        return batch

    data = utf8(text)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), data.alias("data"), F.xxhash64(data).alias("text_hash"))
    return map_rows(rows, "doc_id long, fp long, text_hash long", make)


def _bytes_of(x: np.ndarray) -> np.ndarray:
    return x.astype(">u8").view(np.uint8).reshape(-1, 8)


def _verified(diff: np.ndarray, max_bits: int) -> np.ndarray:
    """Count filter, then the bit distance, over the XORs of candidate pairs."""
    shared = (_bytes_of(diff) == 0).sum(1)
    return (shared >= 8 - max_bits) & (np.bitwise_count(diff) <= max_bits)


def _walk(fps: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links within one list: no more links than members."""
    out, left = [], fps
    queue: list[int] = []
    while len(left):
        if not queue:
            queue.append(left[0])
            left = left[1:]
        node = np.uint64(queue.pop())
        near = _verified(left ^ node, max_bits)
        if near.any():
            found = left[near]
            out.append((np.full(len(found), node), found))
            queue.extend(found)
            left = left[~near]
    return out


def _walk_long(fps: np.ndarray, triple: int, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """As ``_walk`` for a long list: linked members share a fourth byte, so split by it."""
    out, columns = [], _bytes_of(fps)
    for position in sorted(set(range(8)) - set(_TRIPLES[triple])):
        order = np.argsort(columns[:, position], kind="stable")
        cuts = np.flatnonzero(np.diff(columns[order, position])) + 1
        for part in np.split(order, cuts):
            if len(part) > 1:
                out += _walk(fps[part], max_bits)
    return out


def links_in_lists(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among the distinct fingerprints of each posting list; ``keys`` is sorted.

    Short lists give a link only under the first triple that its two ends share, so that
    it is not repeated under other triples.
    """
    starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
    sizes = np.diff(np.concatenate([starts, [len(keys)]]))
    end = np.repeat(starts + sizes, sizes)
    short = np.repeat(sizes <= _SHORT, sizes)
    at = np.arange(len(keys))
    left, right = [], []
    rank = {t: i for i, t in enumerate(_TRIPLES)}
    for step in range(1, _SHORT):
        i = at[short & (at + step < end)]
        if not len(i):
            break
        diff = fps[i] ^ fps[i + step]
        good = _verified(diff, max_bits)
        i, diff = i[good], diff[good]
        shared = _bytes_of(diff)[:, :7] == 0
        first = [rank[tuple(np.flatnonzero(row)[:3])] for row in shared]
        i = i[np.array(first, np.int64) == (keys[i] >> 24)]
        left.append(fps[i])
        right.append(fps[i + step])
    for s, n in zip(starts[sizes > _SHORT], sizes[sizes > _SHORT]):
        members = fps[s: s + n]
        walked = _walk(members, max_bits) if n <= _LONG else _walk_long(members, int(keys[s] >> 24), max_bits)
        for a, b in walked:
            left.append(a)
            right.append(b)
    empty = [np.empty(0, np.uint64)]
    return np.concatenate(left or empty), np.concatenate(right or empty)


def similar_links(nodes: DataFrame, max_bits: int) -> DataFrame:
    """Links (``u``, ``v``) that join all fingerprints ``fp`` within ``max_bits`` bits.

    Every two linked fingerprints end up connected; dense lists give a spanning forest of
    their links instead of all pairs. Needs distinct fingerprints and ``max_bits <= 4``.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("the index guarantees pairs of at most 4 differing bits")

    def byte(position: int):
        return F.shiftrightunsigned("fp", 56 - 8 * position).bitwiseAND(F.lit(255))

    def posting(i: int, t: tuple):
        a, b, c = (byte(p) for p in t)
        return F.lit(i << 24).cast("long") + F.shiftleft(a, 16) + F.shiftleft(b, 8) + c

    # Dealt out first: each fingerprint becomes 35 postings.
    spread = nodes.repartition(task_partitions(nodes.sparkSession), "fp")
    postings = spread.select("fp", F.explode(F.array(*[posting(i, t) for i, t in enumerate(_TRIPLES)])).alias("key"))
    lists = postings.repartition(task_partitions(nodes.sparkSession), "key").sortWithinPartitions("key", "fp")
    schema = pa_schema("u long, v long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_f = [], []

        def flush(keys, fps):
            a, b = links_in_lists(keys, fps, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            fps = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(keys):
                continue
            last = np.searchsorted(keys, keys[-1])  # the last list may go on in the next batch
            if held_k and keys[0] != held_k[0][0]:
                yield flush(np.concatenate(held_k), np.concatenate(held_f))
                held_k, held_f = [], []
            if last:
                yield flush(np.concatenate([*held_k, keys[:last]]), np.concatenate([*held_f, fps[:last]]))
                held_k, held_f = [], []
            held_k.append(keys[last:])
            held_f.append(fps[last:])
        if held_k:
            yield flush(np.concatenate(held_k), np.concatenate(held_f))

    return lists.select("key", "fp").mapInArrow(run, "u long, v long")


def near_duplicates(
    docs: DataFrame, shingle: int, max_bits: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(``doc_id``, ``fp``, ``component_id``, ``root``, ``text_hash``) of every document.

    Documents are linked when their fingerprints differ in at most ``max_bits`` bits;
    ``component_id`` is the smallest key reachable. Null and blank texts have fingerprint
    0 and are linked like any other. Equal fingerprints are one node, so copies make no
    pairs. A null key takes part but never names a component unless all its keys are null.
    Repeated rows come out as often as they come in; an empty table gives none.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    prints = fingerprints(docs, shingle, key, text).checkpoint()
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = connected_components(similar_links(nodes.select("fp"), max_bits))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(named, "root").select("fp", "component_id", "root")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id", "root", "text_hash")


def keep_first_of_each(docs: DataFrame, shingle: int, max_bits: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, with all their columns, of one document of each component: the smallest key.

    Rows without a key cannot be told apart by it and all stay. Where a key has several
    texts in a component, the one with the smallest hash stays; texts of one key in different
    components are judged apart. Rows equal in key and text leave one.
    """
    found = near_duplicates(docs, shingle, max_bits, key, text)
    first = found.where("doc_id = component_id").groupBy("root").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("_first")
    ).select("_first").distinct()
    rows = docs.withColumn("_chosen", F.struct(F.col(key).cast("long").alias("doc_id"), F.xxhash64(utf8(text)).alias("text_hash")))
    named = rows.join(first, rows["_chosen"] == first["_first"], "left_semi").dropDuplicates(["_chosen"]).drop("_chosen")
    return named.unionByName(docs.where(F.col(key).isNull()))


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 4-word shingles, at most 4 bits apart."""
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
