"""The corpus pipeline."""

import corpus_pipeline
from docsentinel.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.brute import components, passages, removed, simhash


def rows_of(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_stages_against_plain_versions(spark):
    docs = table(spark, SF_SMALL, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, SF_SMALL)
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF_SMALL, "labels").collect()}
    kept = {k for k, _ in rows_of(good)}
    assert sum((k in kept) == bool(y) for k, y in labels.items()) > 0.9 * len(labels)

    single = stages["near_duplicates"](spark, docs, SF_SMALL)
    prints = [(k, simhash(t)) for k, t in rows_of(docs)]
    assert {k for k, _ in rows_of(single)} == set(components(prints, 4))

    clean = stages["repeats"](spark, docs, SF_SMALL)
    lost = {r[0]: r[2] for r in removed(rows_of(docs))}
    before = dict(rows_of(docs))
    for k, t in rows_of(clean):
        assert 0 <= len(t.encode()) - (len(before[k].encode()) - lost[k]) <= 6 * lost[k]
        assert (t == before[k]) or lost[k]

    items = [(r["item_id"], r["text"]) for r in table(spark, SF_SMALL, "benchmark").collect()]
    pure = stages["decontamination"](spark, docs, SF_SMALL)
    hits = {r[0]: r[2] for r in passages(rows_of(docs), items)}
    assert sum(hits.values()) > 0
    assert all((t == before[k]) == (hits[k] == 0) for k, t in rows_of(pure))
    assert not any(r[5] for r in passages(rows_of(pure), items))
    for df in (good, single, clean, pure):
        assert df.columns == columns
        assert all(r["n_chars"] == len(r["text"]) for r in df.collect())


def test_run_packs_what_is_left(spark):
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows))) and rows


def test_stages_take_edge_rows(spark, edge_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        plain = edge_docs.select(no_docs.columns)
        assert stage(spark, plain, SF_SMALL).count() >= 1, name
        assert stage(spark, no_docs, SF_SMALL).count() == 0, name
