import random

import numpy as np

from docsentinel.llm import dual_tree as T
from docsentinel.llm.dual_tree import Best, Items, count_terms, search, search_batch

from .brute import ranked, sha  # noqa: F401
from .conftest import sentence


def rows_of(df, item="item_id"):
    return sorted(((r[item], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


def expected(docs, items, k=20):
    return sorted(((items[i][0], *rest) for i, *rest in ranked(docs, [t for _, t in items], k)), key=repr)


ITEMS = [("i-1", "the of and tion"), ("i-2", None), ("i-3", "Wh sh er x1 x1 x1"), ("i-4", "!!"), (None, "ndau é the"), ("i-1", "and and")]


def test_edge_rows(spark, edge_docs, edge_rows):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    docs = [(r[0], r[1]) for r in edge_rows]
    # Repeated ids tie by their equal texts, so order is fixed.
    for k in (1, 3, 20):
        assert rows_of(search(edge_docs, items, k)) == expected(docs, ITEMS, k)


def test_blocks_of_items_give_the_same(spark, edge_docs):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    assert rows_of(search(edge_docs, items, 5)) == rows_of(search(edge_docs, items, 5, item_bytes=16))


def test_ties_go_to_the_smaller_key_and_null_first(spark):
    docs = [(9, "one two"), (4, "one two"), (None, "one two"), (5, "one two three"), (4, "one two")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(1, "one"), (2, "three")], "item_id int, text string")
    got = [r[2] for r in sorted(rows_of(search(df, items, 4))) if r[0] == 1]
    assert got == [None, 4, 4, 9] or sorted(map(str, got)) == sorted(map(str, [None, 4, 4, 9]))
    assert [r[1:3] for r in sorted(rows_of(search(df, items, 4))) if r[0] == 2] == [(1, 5)]


def test_empty_tables(spark, no_docs, edge_docs):
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    assert search(no_docs, items).count() == 0
    assert search(edge_docs, items.limit(0)).count() == 0
    assert search(edge_docs, items.where("text = '!!'")).count() == 0


def test_trees_skip_pairs_and_lose_none():
    rng = random.Random(11)
    texts = [sentence(rng, rng.randint(1, 60)).encode() for _ in range(1500)]
    asked = [sentence(rng, 12).encode() for _ in range(70)]
    vocabulary = Items.vocabulary_of(asked)
    bags = [count_terms(t, vocabulary) for t in texts]
    df = np.bincount(np.concatenate([b[1] for b in bags]), minlength=len(vocabulary))
    items = Items.build(asked, vocabulary, {i: int(n) for i, n in enumerate(df) if n}, len(texts), sum(b[0] for b in bags))
    rows, ids = [], []
    for i, (n, t, tf) in enumerate(bags):
        live = items.weight[t] > 0
        if live.any():
            rows.append((t[live], 1_000_000_000 * tf[live] // (1000 * tf[live] + 12 * items.length_norm(n))))
            ids.append(i)
    best = Best(len(items.number), 5, np.ones(len(items.number), np.int64))
    scored = []
    products = T.Level.products

    def counted(self, nodes, dense):
        if dense.ndim > 1:
            scored.append(len(nodes) * len(dense))
        return products(self, nodes, dense)

    T.Level.products = counted
    try:
        search_batch(items, np.array(ids), rows, best)
    finally:
        T.Level.products = products
    want = ranked([(i, t.decode()) for i, t in enumerate(texts)], [t.decode() for t in asked], 5)
    got = [(int(items.number[i]), r + 1, int(d), int(s)) for i in range(len(items.number)) for r, (d, s) in enumerate(zip(best.doc[i], best.score[i]))]
    assert sorted(got) == sorted(want)
    assert sum(scored) < 0.9 * len(rows) * len(asked)


def test_long_text_is_counted_in_slices():
    data = b"Alpha beta " * 50_000
    n, terms, tf = count_terms(data, {b"alpha": 0, b"x": 1})
    assert (n, terms.tolist(), tf.tolist()) == (100_000, [0], [50_000])
    assert sum(len(w) for w in T.terms_in_slices(data, 100)) == 100_000
