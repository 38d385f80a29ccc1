"""Benchmark decontamination."""

import random

import numpy as np
import pytest

from docsentinel.llm import fm_index as M
from tests.llm.brute import passages, sha

ITEMS = "item_id long, text string"


def digest(df):
    out = []
    for r in df.collect():
        hit = sum(b - a for a, b in zip(r["span_start"], r["span_end"]))
        names = ",".join(sorted(map(str, r["items"])))
        out.append((r["doc_id"], r["n_words"], hit, len(r["items"]), sha(names.encode()), hit > 0))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def items(spark, edge_rows):
    words = edge_rows[7][1].split()
    rows = [(1, " ".join(words[:14])), (2, "word word word"), (3, None), (4, ""), (5, " ".join(words[5:25]).upper()),
            (5, "text ω"), (None, "one"), (10, "nice 12"), (11, "the of the of the of the of the of the of no such")]
    return spark.createDataFrame(rows, ITEMS), rows


@pytest.mark.parametrize("block_bytes", [1 << 24, 60])
def test_edge_rows_match_plain_version(edge_docs, edge_rows, items, block_bytes):
    """One pass, and a benchmark searched block by block."""
    got = digest(M.find_passages(edge_docs, items[0], block_bytes=block_bytes))
    assert got == sorted(passages([r[:2] for r in edge_rows], items[1]), key=str)


def test_ids_of_any_type(spark):
    """Text ids of items and documents, and a passage of an item without an id."""
    passage = "one two three four five six seven eight nine ten eleven"
    items = spark.createDataFrame([("mmlu-7", passage), (None, "red orange yellow green blue indigo violet white black grey")], "item_id string, text string")
    docs = spark.createDataFrame([("d-1", f"x {passage} y"), ("d-2", "red orange yellow green blue indigo violet white black grey"), ("d-3", "no")], "doc_id string, text string")
    rows = {r["doc_id"]: (r["span_start"], r["span_end"], r["items"]) for r in M.find_passages(docs, items).collect()}
    assert rows == {"d-1": ([1], [12], ["mmlu-7"]), "d-2": ([0], [10], []), "d-3": ([], [], [])}
    left = {r["doc_id"]: r["text"] for r in M.remove_passages(docs, items).collect()}
    assert left["d-2"].strip() == "" and left["d-3"] == "no"


def test_empty_tables_and_null_keys(spark, no_docs, null_key_docs, items):
    assert M.find_passages(no_docs, items[0]).collect() == []
    assert all(r[2] == 0 for r in digest(M.find_passages(null_key_docs, spark.createDataFrame([], ITEMS))))


def test_index_finds_every_occurrence():
    rng = random.Random(2)
    runs = [[rng.randint(1, 5) for _ in range(rng.randint(1, 60))] for _ in range(30)] + [[1, 2] * 50, [1, 2] * 50]
    text = np.array([w for r in runs for w in [*r, 0]], np.int32)
    index = M.FMIndex(text, 6)
    phrases = [[rng.randint(1, 5) for _ in range(n)] for n in (1, 2, 3, 3, 4)] + [[1, 2] * 5]
    table = np.zeros((len(phrases), 10), np.int32)
    for i, p in enumerate(phrases):
        table[i, 10 - len(p):] = p
    lo, hi = index.search(table)
    for p, a, b in zip(phrases, lo, hi):
        want = [i for i in range(len(text)) if text[i:i + len(p)].tolist() == p]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_suffix_array_orders_runs():
    text = np.array([2, 1, 0, 2, 1, 0, 1, 0], np.int32)
    ends = np.flatnonzero(text == 0)

    def suffix(i):
        end = ends[np.searchsorted(ends, i)]
        return [*(text[i:end].tolist()), -1.0 + end / 100]

    assert M.suffix_array(text).tolist() == sorted(range(len(text)), key=suffix)


def test_stage_cuts_passages_and_keeps_columns(edge_docs, edge_rows, items):
    out = M.remove_passages(edge_docs, items[0])
    assert out.columns == edge_docs.columns
    rows = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert len(rows) == len(edge_rows) and (0, None) in rows
    assert (3, "") in rows  # all of it is the passage of an item without an id
    assert all(not r[5] or r[2] < 10 for r in passages([x for x in rows if x[0] == 7], items[1]))
    assert M.cut_words(b"a, b c. d", [1], [3]) == b"a, . d"
