"""Licence scan."""

from docsentinel.llm.licences import BASE_PHRASES, LicenceModel, matching_statistics, op8_licences, scan_licences
from tests.llm.brute import ALNUM, lower


def places(text):
    words, out = ALNUM.findall(lower(text)), []
    for phrase, label in BASE_PHRASES:
        p = phrase.split()
        out += [(label, i) for i in range(len(words)) if words[i:i + len(p)] == p]
    return len(words), sorted(out)


def test_base_places_match_plain_version(edge_docs, edge_rows):
    rows = scan_licences(edge_docs).collect()
    got = sorted(((r["doc_id"], r["n_words"], sorted(zip(r["base_label"], r["base_start"]))) for r in rows), key=str)
    assert got == sorted(((k, *places(t)) for k, t, *_ in edge_rows), key=str)


def test_overlapping_phrases_and_labels(spark, no_docs):
    texts = ["CC-BY cc by by CC  by!", "the GNU General Public License, version 3 general public license", "all rights",
             "Permission is hereby granted, free of charge, to anyone obtaining a copy of this software and associated "
             "documentation files, to deal in the Software without restriction", "Released under the MIT License."]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], no_docs.schema)
    rows = {r["doc_id"]: r for r in scan_licences(docs).collect()}
    for i, t in enumerate(texts):
        assert (rows[i]["n_words"], sorted(zip(rows[i]["base_label"], rows[i]["base_start"]))) == places(t)
    assert "mit" in rows[3]["span_label"] and "mit" in rows[4]["span_label"] and not rows[2]["span_label"]
    assert 0.8 <= rows[3]["best_cover"] <= 1.0


def test_matching_statistics_are_longest_matches():
    model = LicenceModel.build((), (("x", "a b c a b d"), ("y", "b c e a b")))
    grams = [t.split() for t in ("a b c a b d", "b c e a b")]
    known = {tuple(g[i:j]) for g in grams for i in range(len(g)) for j in range(i + 1, len(g) + 1)}
    words = "a b c e a b d q b c a a b c a b c e".split()
    got = {at: size for at, size, _ in matching_statistics(model, [model.vocabulary.get(w.encode()) for w in words])}
    for at in range(len(words)):
        longest = max((n for n in range(1, at + 2) if tuple(words[at + 1 - n:at + 1]) in known), default=0)
        assert got.get(at, 0) == longest


def test_null_keys_empty_table_and_query(spark, null_key_docs, no_docs):
    assert len(scan_licences(null_key_docs).collect()) == 4
    assert scan_licences(no_docs).collect() == []
    from tests.conftest import SF_SMALL

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in op8_licences(spark, SF_SMALL).collect():
        n, found = places(texts[r["doc_id"]])
        labels = ",".join(sorted({x for x, _ in found}))
        starts = [s for _, s in found]
        assert tuple(r)[:6] == (r["doc_id"], n, len(found), min(starts, default=None), max(starts, default=None), labels)
        assert set(labels.split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_edited_and_cut_notices_are_found(spark, no_docs):
    """Recall at least 0.9 on notices with one word in twenty changed or cut to a half; no label on plain prose."""
    import random

    from docsentinel.llm.licences import TEMPLATES

    rng = random.Random(4)
    rows, want = [], {}
    prose = "the report says that this software was used for any purpose by the authors and the copyright was not limited to them".split()

    def put(text, label):
        at = len(rows)
        around = [" ".join(rng.choice(prose) for _ in range(30)) for _ in range(2)]
        rows.append((at, f"{around[0]}. {text}. {around[1]}", None, None, None))
        want[at] = label

    for label, text in TEMPLATES:
        words = text.split()
        put(text, label)
        if len(words) >= 24:
            for _ in range(3):
                put(" ".join(rng.choice(prose) if rng.random() < 0.05 else w for w in words), label)
                half = rng.randrange(len(words) // 2)
                put(" ".join(words[half: half + len(words) // 2]), label)
    for _ in range(60):
        put(" ".join(rng.choice(prose) for _ in range(200)), None)
    found = {r["doc_id"]: set(r["span_label"]) for r in scan_licences(spark.createDataFrame(rows, no_docs.schema)).collect()}
    wanted = [i for i, label in want.items() if label]
    assert sum(want[i] in found[i] for i in wanted) >= 0.9 * len(wanted)
    assert not any(found[i] for i, label in want.items() if label is None)


def test_short_notices(spark, no_docs):
    texts = {"mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
             "apache-2.0": "Licensed under the Apache License v2.", "gpl": "// SPDX-License-Identifier: GPL-2.0-only",
             "cc-by-sa": "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
             "lgpl": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"}
    rows = [(i, t, None, None, None) for i, t in enumerate(texts.values())]
    found = {r["doc_id"]: r["span_label"] for r in scan_licences(spark.createDataFrame(rows, no_docs.schema)).collect()}
    assert all(label in found[i] for i, label in enumerate(texts))
