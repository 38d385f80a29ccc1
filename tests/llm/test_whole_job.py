"""Operators do the whole job where a share, one group or one row could stand in for it."""

import numpy as np
import pytest

from docsentinel.llm.suffix_tree_lm import SuffixTree, byte_sequence, count_grams, grow, in_row, op3_suffix_tree
from tests.conftest import SF_MEDIUM
from tests.llm.brute import fold


def test_tree_keeps_every_diverging_context(spark):
    """Buckets' states score like the whole tree whose only floor is two occurrences."""
    rows = spark.read.parquet(f"{SF_MEDIUM}/documents.parquet").select("doc_id", "text").collect()
    texts = {r["doc_id"]: byte_sequence((r["text"] or "").encode().lower().split()) for r in rows}
    train = [t for k, t in texts.items() if fold(k, 7) != 2]
    n_total = sum(len((r["text"] or "").encode()) for r in rows if fold(r["doc_id"], 7) != 2)
    tree = SuffixTree.assemble([in_row(grow(*count_grams(train), 2, n_total))], 2, n_total)
    rare = np.bincount(np.unique(tree.levels[6][0], return_inverse=True)[1], tree.levels[6][2])
    assert rare.min() < 2e-6 * n_total
    want = dict(zip(texts, tree.score(list(texts.values()))))
    got = {r["doc_id"]: r["score"] for r in op3_suffix_tree(spark, SF_MEDIUM).collect()}
    assert got.keys() == want.keys()
    assert [got[k] for k in want] == pytest.approx(list(want.values()), rel=1e-5)


def test_rounds_and_groups_change_nothing(spark, edge_docs, monkeypatch):
    """Chunks summed in rounds and blocks answered in groups give the same scores as all at once."""
    from docsentinel.llm import suffix_tree_lm as T

    def scores():
        rows = T.score_texts(edge_docs, block_bytes=5000, chunk_bytes=2000).collect()
        return sorted((tuple(r)[:6] + (round(r["score"], 4),) for r in rows), key=str)

    want = scores()
    monkeypatch.setattr(T, "FAN", 3)
    assert scores() == want


def test_held_out_texts_score_above_the_unigram_base(spark):
    """At sf0.1 the tree's held-out log10 probability a token is over that of single words."""
    from pyspark.sql import functions as F

    from docsentinel.llm.suffix_tree_lm import op3_suffix_tree

    out = op3_suffix_tree(spark, "/root/testdata/sf0.1").where("held_out")
    tree, base = out.agg(F.sum("score") / F.sum("n_tokens"), F.sum("base_score") / F.sum("n_tokens")).first()
    assert tree > base + 0.1 and tree > -4.1


def test_toxicity_on_held_out_labels(spark):
    """Given labels of the held-out fold at sf0.1: recall and precision of the 0.3 cut."""
    from docsentinel.llm.toxicity import op7_toxicity

    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic").where("toxic is not null")
    rows = op7_toxicity(spark, sf).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    both = sum(r["predicted"] == 1 and r["toxic"] == 1 for r in rows)
    assert both >= 0.85 * sum(r["toxic"] == 1 for r in rows) and both >= 0.85 * sum(r["predicted"] == 1 for r in rows)
