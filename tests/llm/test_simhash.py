"""SimHash near-duplicates."""

import random

import numpy as np
import pytest

from docsentinel.llm import simhash as S
from docsentinel.llm.components import connected_components
from tests.llm.brute import components, simhash


def expected(rows, bits=4):
    prints = [(k, simhash(t)) for k, t in rows]
    return sorted(((k, f, c) for (k, f), c in zip(prints, components(prints, bits))), key=str)


def got(df):
    return sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in df.collect()), key=str)


def test_edge_rows_match_plain_version(edge_docs, edge_rows):
    assert got(S.near_duplicates(edge_docs, 4, 4)) == expected([r[:2] for r in edge_rows])


def test_null_keys_and_empty_table(null_key_docs, no_docs):
    assert got(S.near_duplicates(null_key_docs, 4, 4)) == expected([tuple(r)[:2] for r in null_key_docs.collect()])
    assert S.near_duplicates(no_docs, 4, 4).collect() == []


@pytest.mark.parametrize("short,long", [(32, 20_000), (4, 20_000), (2, 6)])
def test_links_connect_all_pairs_within_the_distance(spark, monkeypatch, short, long):
    """Short lists, walked lists and split lists give the same components."""
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(6)]
    prints = {c for c in centres}
    for c in centres:
        for _ in range(40):
            p = c
            for _ in range(rng.randint(1, 9)):
                p ^= 1 << rng.randrange(64)
            prints.add(p)
    keys = np.array(sorted(prints), np.uint64)
    monkeypatch.setattr(S, "_SHORT", short)
    monkeypatch.setattr(S, "_LONG", long)
    columns = S._bytes_of(keys).astype(np.int64)
    posted = [
        ((i << 24) | (columns[k, a] << 16) | (columns[k, b] << 8) | columns[k, c], keys[k])
        for i, (a, b, c) in enumerate(S._TRIPLES) for k in range(len(keys))
    ]
    posted.sort()
    left, right = S.links_in_lists(np.array([p[0] for p in posted]), np.array([p[1] for p in posted], np.uint64), 4)
    root = {int(k): int(k) for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in zip(left.tolist(), right.tolist()):
        assert (a ^ b).bit_count() <= 4
        root[max(find(a), find(b))] = min(find(a), find(b))
    plain = components([(int(k), int(k)) for k in keys], 4)
    assert [find(int(k)) for k in keys] == plain


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (500, 499), (500, 499)]
    df = spark.createDataFrame(edges, "u long, v long")
    roots = {r["node"]: r["root"] for r in connected_components(df).collect()}
    assert roots == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {499: 499, 500: 499}
    assert connected_components(df.where("false")).collect() == []


def test_stage_keeps_one_of_each(edge_docs, edge_rows, null_key_docs):
    kept = S.keep_first_of_each(edge_docs, 4, 4)
    assert kept.columns == edge_docs.columns
    want = {c for _, _, c in expected([r[:2] for r in edge_rows])}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)
    assert sorted((r["doc_id"] for r in S.keep_first_of_each(null_key_docs, 4, 4).collect()), key=str) == [3, 7, None, None]
