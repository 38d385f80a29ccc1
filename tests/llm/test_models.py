"""Trained models: quality, toxicity, language model."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from docsentinel.llm.quality_gam import FEATURES, PairwiseGam, keep_good, fit_quality, op5_quality, score_quality, text_features
from docsentinel.llm.suffix_tree_lm import Lookup, SuffixTree, byte_sequence, count_grams, grow, score_texts, sequence_scores
from docsentinel.llm.toxicity import ToxicNet, op7_toxicity, score_toxicity, windows_of
from tests.conftest import SF_MEDIUM
from tests.llm.brute import ANY_SPACE, fold, lower

LABELS = "doc_id long, quality int, toxic int"


def held_out_rows(spark, df, column):
    labels = {r["doc_id"]: r[column] for r in spark.read.parquet(f"{SF_MEDIUM}/labels.parquet").collect()}
    return [(r["predicted"], labels[r["doc_id"]]) for r in df.collect() if r["held_out"] and r["doc_id"] in labels]


# quality

def test_quality_on_held_out_rows(spark):
    rows = held_out_rows(spark, op5_quality(spark, SF_MEDIUM), "quality")
    assert len(rows) > 50 and np.mean([p == y for p, y in rows]) > 0.95


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = PairwiseGam.fit(x, y)
    fresh = rng.random((1000, 3))
    assert np.mean((model.score(fresh) > 0.5) == ((fresh[:, 0] > 0.5) ^ (fresh[:, 1] > 0.5))) > 0.9
    assert (0, 1) in model.pairs


def test_quality_edges(spark, edge_docs, edge_rows, no_docs, null_key_docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)] + [(None, 1, 1), (3, None, None)], LABELS)
    rows = score_quality(edge_docs, labels).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in edge_rows)
    assert all(0 <= r["score"] <= 1 and r["held_out"] == (fold(r["doc_id"], 3) == 1) for r in rows)
    assert {r["score"] for r in rows if r["doc_id"] == 0} == {r["score"] for r in rows if r["doc_id"] == 1}
    assert score_quality(no_docs, labels).collect() == []
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in score_quality(null_key_docs, none).collect()} == {0.5}
    assert keep_good(edge_docs, fit_quality(edge_docs, none)).columns == edge_docs.columns
    assert text_features(b"") == [0.0] * len(FEATURES)


# toxicity

def test_gradients_match_differences():
    net = ToxicNet.fresh(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    texts, y = [b"hello bad world a b c " * n for n in (1, 3, 9)] + [b""], np.array([1, 0, 1, 0], np.float32)
    _, g = net.gradients(texts, y)
    rng = np.random.default_rng(0)
    for name, a in net.p.items():
        places = np.argwhere(np.abs(g[name]) > 1e-5)
        i = tuple(places[rng.integers(len(places))])
        kept, eps = a[i], 1e-3
        a[i] = kept + eps
        up, _ = net.gradients(texts, y)
        a[i] = kept - eps
        down, _ = net.gradients(texts, y)
        a[i] = kept
        assert (up - down) / (2 * eps) == pytest.approx(g[name][i], rel=0.02, abs=1e-5)


def test_windows_cover_all_words():
    text = " ".join(f"w{i}" for i in range(75)).encode()
    words, windows, first = windows_of([text, b"", b"one two"], 16)
    assert first.tolist() == [0, 4, 5]
    assert {words[i] for i in windows[:4].ravel()} == set(text.split())
    assert [[words[i] for i in w if i] for w in windows[4:]] == [[], [b"one", b"two"]]


def test_toxicity_learns_and_handles_edges(spark, edge_docs, edge_rows, no_docs):
    rng = random.Random(4)
    plain = ["the", "of", "and", "tion", "rean", "ouble", "sher", "onin"]
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 90))]
        if i % 4 == 0:
            words[rng.randrange(len(words))] = rng.choice(["idiotic", "idiot", "idiots"])
        rows.append((i, " ".join(words), None, None, None))
        labels.append((i, 1, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, no_docs.schema)
    known = spark.createDataFrame(labels, LABELS)
    got = score_toxicity(docs, known).collect()
    held = [(r["predicted"], int(r["doc_id"] % 4 == 0)) for r in got if r["held_out"]]
    assert len(held) > 60 and np.mean([p == y for p, y in held]) > 0.95
    few = spark.createDataFrame([(i, 1, i % 2) for i in range(12)], LABELS)
    scored = score_toxicity(edge_docs, few).collect()
    assert Counter(r["doc_id"] for r in scored) == Counter(r[0] for r in edge_rows)
    assert all(0 <= r["score"] <= 1 for r in scored)
    assert score_toxicity(no_docs, few).collect() == []


# language model

def test_base_scores_match_plain_version(spark, edge_docs, edge_rows, no_docs):
    got = score_texts(edge_docs, block_bytes=5000, chunk_bytes=2000).collect()
    texts = [(k, [*ANY_SPACE.findall(lower(t)), None]) for k, t, *_ in edge_rows]
    count = Counter(w for k, words in texts if fold(k, 7) != 2 for w in words)
    n, v = sum(count.values()), len(count)
    want = sorted((k, fold(k, 7) == 2, len(words), sum(count[w] > 0 for w in words), n) for k, words in texts)
    assert sorted(tuple(r)[:5] for r in got) == want
    base = sorted((k, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words)) for k, words in texts)
    assert [b for _, b in sorted((r["doc_id"], r["base_score"]) for r in got)] == pytest.approx([b for _, b in base])
    assert all(r["score"] < 0 for r in got)
    assert score_texts(no_docs).collect() == []


def test_null_keys_and_no_training_texts(spark, null_key_docs, no_docs):
    assert len(score_texts(null_key_docs).collect()) == 4
    held = next(i for i in range(100) if fold(i, 7) == 2)
    row = score_texts(spark.createDataFrame([(held, "ab", None, None, 2)], no_docs.schema)).collect()[0]
    assert (row["train_tokens"], row["n_known"], row["base_score"]) == (0, 0, 0.0)
    assert row["score"] == pytest.approx(4 * math.log10(1 / 257), rel=1e-4)


def test_tree_walk_matches_plain_suffix_search():
    rng = random.Random(0)
    train = [byte_sequence([rng.choice([b"the", b"then", b"an", b"and", b"ban"]) for _ in range(300)]) for _ in range(5)]
    keys, counts = count_grams(train)
    total = int(counts.sum())
    levels = grow(keys, counts, 5, total)
    parts = [(np.full(len(x[0]), d, np.uint8), *x) for d, x in levels.items()]
    tree = SuffixTree.assemble(parts, 5, total)
    states = {}
    for d, (ctx, nxt, count) in tree.levels.items():
        for c, x, n in zip(ctx.tolist(), nxt.tolist(), count.tolist()):
            states.setdefault(c.to_bytes(d, "big"), {})[x] = n  # latest byte first
    root = Counter()
    for s, dist in states.items():
        if len(s) == 1:
            root.update(dist)
    assert any(len(s) >= 3 for s in states)

    def prob(state, byte):
        if not state:
            return (root.get(byte, 0) + 1) / (sum(root.values()) + 257)
        dist = states[state]
        kinds, n = len(dist), sum(dist.values())
        return (dist.get(byte, 0) + kinds * prob(state[:-1], byte)) / (n + kinds)

    text = byte_sequence([b"the", b"bandit", b"then"])
    padded, want = b"\n" * 6 + text, 0.0
    for i in range(6, len(padded)):
        state = b""
        while len(state) < 6 and state + padded[i - 1 - len(state): i - len(state)] in states:
            state += padded[i - 1 - len(state): i - len(state)]
        want += math.log10(prob(state, padded[i]))
    assert tree.score([text])[0] == pytest.approx(want, rel=1e-4)


def test_grams_and_their_gains_match_plain_counts(monkeypatch):
    """Whole texts of one block, and hardly a place looked up by search."""
    rng = random.Random(3)
    texts = [byte_sequence([rng.choice([b"the", "é".encode(), b"x" * 9, b"%d" % rng.randrange(9999)]) for _ in range(n)])
             for n in (0, 1, 2, 700, 3000, 0)]
    plain = Counter()
    of = []
    for text in texts:
        padded = b"\n" * 6 + text
        of.append([int.from_bytes(padded[i - 6: i][::-1] + padded[i: i + 1], "big") for i in range(6, len(padded))])
        plain.update(of[-1])
    keys, counts = count_grams(texts)
    assert dict(zip(keys.tolist(), counts.tolist())) == plain and (keys[1:] > keys[:-1]).all()
    gains = np.log10(np.arange(1, len(keys) + 1))
    gain_of, searched, search = dict(zip(keys.tolist(), gains)), [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *rest, **named: searched.append(np.size(v)) or search(a, v, *rest, **named))
    got = sequence_scores(texts, keys, gains)
    assert got == pytest.approx([sum(gain_of[k] for k in row) for row in of])
    assert sum(searched) < 0.05 * sum(map(len, of))
    assert count_grams([])[0].size == 0


def test_lookup_finds_keys_that_share_slots():
    keys = np.unique(np.concatenate([np.arange(5000), np.arange(5000) << 43, np.arange(1, 300) * (2**56 - 1) // 300]).astype(np.uint64))
    values = np.arange(len(keys)).astype(np.float32)
    wanted = np.random.default_rng(0).integers(0, len(keys), 20_000)
    assert (Lookup.build(keys, values)(keys[wanted]) == values[wanted]).all()
    # All in one slot: left to the search.
    few = np.arange(64).astype(np.uint64) * np.uint64(2**50)
    one = Lookup([(np.uint64(1), np.full(2, np.nan))], few, np.arange(64.0))
    assert (one(few[::-1]) == np.arange(64.0)[::-1]).all()
