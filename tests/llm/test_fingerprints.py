"""Lempel-Ziv fingerprints."""

from docsentinel.llm.lz_fingerprint import as_hex, compare_with_edits, fingerprint, fingerprint_texts, from_hex, likeness
from tests.llm.brute import sha


def phrases(data):
    seen, start = set(), 0
    for end in range(1, len(data) + 1):
        if data[start:end] not in seen:
            seen.add(data[start:end])
            start = end
    return seen


def expected(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    out = []
    for i, (key, text) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        n = len(text)
        edited = (text[: n - n // 3] + following[: n // 3]).encode()
        own, new, nxt = (fingerprint(x) for x in (text.encode(), edited, following.encode()))
        out.append((key, n, sha(edited), as_hex(own), as_hex(new), likeness(own, new), likeness(own, nxt)))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=str)


def test_edge_rows_match_plain_version(edge_docs, edge_rows):
    assert order(compare_with_edits(edge_docs).collect()) == order(expected([r[:2] for r in edge_rows]))


def test_null_keys_single_row_and_empty_table(spark, null_key_docs, no_docs):
    rows = [tuple(r)[:2] for r in null_key_docs.collect()]
    assert order(compare_with_edits(null_key_docs).collect()) == order(expected(rows))
    one = spark.createDataFrame([(4, "abcabc", None, None, 6)], no_docs.schema)
    got = compare_with_edits(one).collect()[0]
    assert (got["edited_sha256"], got["near_next"]) == (sha(b"abcaab"), 1.0)
    assert compare_with_edits(no_docs).collect() == []


def test_likeness_estimates_phrase_set_overlap():
    a = b"the quick brown fox jumps over the lazy dog and runs away " * 3
    b = a[:100] + b"with quite another ending that goes on for a while, longer"
    exact = len(phrases(a) & phrases(b)) / len(phrases(a) | phrases(b))
    assert abs(likeness(fingerprint(a), fingerprint(b)) - exact) < 0.1
    assert likeness(fingerprint(b""), fingerprint(b"")) == 1.0
    assert likeness(fingerprint(b""), fingerprint(b"a")) == 0.0


def test_equal_texts_have_equal_fingerprints(edge_docs):
    got = {r["doc_id"]: r["fingerprint"] for r in fingerprint_texts(edge_docs).collect()}
    assert got[7] == got[14] and got[0] == got[1] == "" and as_hex(from_hex(got[7])) == got[7]


def test_long_texts_have_the_same_phrases(monkeypatch):
    """The flat tree cuts like the nested one; several slices of phrases give one signature."""
    import random

    from docsentinel.llm import lz_fingerprint as L

    rng = random.Random(6)
    for data in (b"", b"a", b"aaaa" * 500, bytes(rng.choices(b"abc", k=5000)), "été ñandú ".encode() * 700, rng.randbytes(20_000)):
        root: dict = {}
        assert L.long_cuts(data).tolist() == L.parse(data, 0, root, root)[0]
        assert as_hex(L.long_signature(data, L.PhraseHasher(), step=100)) == as_hex(fingerprint(data))


def test_pairs_of_long_texts(monkeypatch, spark, edge_docs, edge_rows):
    from docsentinel.llm import lz_fingerprint as L

    want = order(expected([r[:2] for r in edge_rows]))
    monkeypatch.setattr(L, "LONG", 100)
    assert order(compare_with_edits(edge_docs).collect()) == want


def test_long_texts_stay_small():
    """Parsing a text of random words needs a few dozen bytes a phrase."""
    import random
    import tracemalloc

    from docsentinel.llm import lz_fingerprint as L

    rng = random.Random(1)
    words = [bytes(rng.choices(b"abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(5000)]
    data = b" ".join(rng.choices(words, k=300_000))
    tracemalloc.start()
    cuts = L.long_cuts(data)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * len(cuts)
