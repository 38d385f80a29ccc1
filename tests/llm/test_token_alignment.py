import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsentinel.llm.token_alignment import align, op13_align, shared_groups

from .brute import aligned

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def collected(df, columns=COLUMNS):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_groups_of_random_ends_match_one_walk():
    rng = random.Random(3)
    for share in (0.02, 0.3, 0.9):
        for _ in range(40):
            n = rng.randint(1, 400)
            a = {x for x in range(1, n) if rng.random() < share} | {n}
            b = {x for x in range(1, n) if rng.random() < 0.5} | {n}
            ends_a, ends_b = np.array(sorted(a)), np.array(sorted(b))
            cuts = sorted(a & b)
            want, i, j = [], 0, 0
            for c in cuts:
                i2, j2 = int(np.searchsorted(ends_a, c)) + 1, int(np.searchsorted(ends_b, c)) + 1
                want.append((i, i2, j, j2))
                i, j = i2, j2
            got = shared_groups(ends_a, ends_b, np.array([[0, len(ends_a), 0, len(ends_b)]]))
            assert [tuple(r) for r in got.tolist()] == want


TEXTS = [
    "plain words, and MORE of them", "a  b", "  lead and trail  ", "tab\tand\nline\r\n breaks　wide   x", "has ▁ inside",
    "<|endoftext|> <s> </s> <0x41> it's we'll", "日本語 текст ω 😀😀😀😀 é", " ", "\n", "\t\t x", "a\x00b \x1c c", "a" * 500,
    "x\r y\r\rz );\r\n", "12345 67,8 ... !!! ??\n\n\n  end", " a   b", "éé ﻿q",
]


def test_edge_texts_match_whole_encodings(spark, edge_docs, edge_rows):
    rows = [(r[0], r[1]) for r in edge_rows] + [(1000 + i, t) for i, t in enumerate(TEXTS)]
    docs = edge_docs.unionByName(
        spark.createDataFrame([(1000 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string"), allowMissingColumns=True
    )
    got = collected(align(docs, chunk_bytes=20_000, with_groups=True), (*COLUMNS, "groups"))
    assert got == sorted(aligned(rows), key=repr)


def test_one_text_over_many_parts(spark, monkeypatch):
    import docsentinel.llm.token_alignment as T

    tokens = T.UnitTokens(None, None, max_units=50)
    small = T.Aligner(tokens, True, most=7)
    text = "the cat sat, on\nthe mat; it's 12 o'clock é " * 40
    one = small.document(1, text)
    two = small.document(2, "▁" + text)
    small.flush()
    one.close(), two.close()
    want = aligned([(1, text), (2, "▁" + text)])
    assert (one.n_a, one.n_b, len(one.keys), b"".join(one.text).decode()) == (want[0][1], want[0][2], want[0][3], want[0][8])
    assert one.digest.hexdigest() == want[0][7]
    assert (two.n_a, two.n_b, len(two.keys)) == (0, 0, 0)


def test_no_rows_and_null_keys(spark, no_docs, null_key_docs):
    assert align(no_docs).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in null_key_docs.collect()]
    assert collected(align(null_key_docs)) == sorted((r[:8] for r in aligned(rows)), key=repr)


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_matches_brute_force(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    assert collected(op13_align(spark, path)) == sorted((r[:8] for r in aligned(rows)), key=repr)
