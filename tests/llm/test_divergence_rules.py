import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from docsentinel.llm import divergence_rules as R
from docsentinel.llm.divergence_rules import op11_divergence_rules, quality_rules

from .brute import ANY_SPACE

BASE = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def classes(words):
    out = [0] * 6
    for c in "".join(words):
        if "a" <= c <= "z":
            out[0] += 1
        elif c in "-.,;:'\"?!()":
            out[1] += 1
        elif "A" <= c <= "Z":
            out[2] += 1
        elif "0" <= c <= "9":
            out[3] += 1
        else:
            out[4 if c < "\x80" else 5] += 1
    return out


def divergence(p, q):
    n, m = sum(p), sum(q)
    p, q = [x / n for x in p], [x / m for x in q]
    mid = [(a + b) / 2 for a, b in zip(p, q)]
    return sum(sum(a * math.log2(a / c) for a, c in zip(side, mid) if a) for side in (p, q)) / 2


def plain(rows, least_words=40, least_chars=200, least_reference=2000, top=50, far_class=0.21, far_word=0.33):
    """(base columns, kept, class distance, word distance) of (doc_id, text, lang) rows."""
    by_lang, class_of = defaultdict(Counter), defaultdict(lambda: [0] * 6)
    split = [(d, t or "", lang, ANY_SPACE.findall(t or "")) for d, t, lang in rows]
    for _, _, lang, words in split:
        by_lang[lang].update(words)
        class_of[lang] = [a + b for a, b in zip(class_of[lang], classes(words))]
    out = []
    for d, text, lang, words in split:
        n, chars = len(words), len("".join(words))
        runs = defaultdict(list)
        for i in range(n - 7):
            runs[tuple(words[i:i + 8])].append(i)
        inside = {j for at in runs.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
        lines = [x for x in text.split("\n") if ANY_SPACE.search(x)]
        ref = by_lang[lang]
        best = sorted(ref.items(), key=lambda x: (-x[1], x[0].encode()))[:top]
        known, total = ref.total() >= least_reference, ref.total()
        own, cd, wd, far = Counter(words), None, None, False
        if known and chars >= least_chars:
            cd = divergence(classes(words), class_of[lang])
            far |= math.sqrt(max(0, cd - 5 / (8 * math.log(2) * chars))) > far_class
        if known and n >= least_words:
            hits = [own[w] for w, _ in best]
            wd = divergence([*hits, n - sum(hits)], [*[c for _, c in best], total - sum(c for _, c in best)])
            far |= math.sqrt(max(0, wd - len(best) / (8 * math.log(2) * n))) > far_word
        failed = n < 20 or 100 * len(inside) > 30 * n
        out.append((d, n, chars, sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), failed,
                    not failed and not far, cd and round(math.sqrt(cd), 5), wd and round(math.sqrt(wd), 5)))
    return sorted(out, key=repr)


def collected(df):
    df = df.select(*BASE, F.round("class_distance", 5).alias("c"), F.round("word_distance", 5).alias("w"))
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def more_rows(edge_rows):
    eight = "a b c d e f g h "
    texts = [eight * 2, eight + "x " + eight, "one two " * 9, "A\nA\n \n \nb\nA", "x " * 8, "x " * 9, "#*$ %&|<> ok no", "\n" * 5,
             "der die das und " * 30, "# # #" * 60, "1 2 3 4 5 6 7 8 9 " * 40, "Éé ñ " * 80]
    return [(r[0], r[1], r[2]) for r in edge_rows] + [(500 + i, t, "en" if i % 2 else None) for i, t in enumerate(texts)]


@pytest.mark.parametrize("least_reference, top", [(2000, 50), (0, 3)])
def test_edge_rows_match_plain_version(spark, edge_docs, more_rows, least_reference, top):
    extra = spark.createDataFrame(more_rows[-12:], "doc_id long, text string, lang string")
    docs = edge_docs.unionByName(extra, allowMissingColumns=True)
    got = collected(quality_rules(docs, least_reference=least_reference, top=top, least_words=3, least_chars=5))
    assert got == plain(more_rows, 3, 5, least_reference, top)


def test_salted_join_gives_the_same(spark, edge_docs, monkeypatch):
    want = collected(quality_rules(edge_docs, least_reference=0))
    monkeypatch.setattr(R, "BROADCAST_LANGUAGES", 0)
    assert collected(quality_rules(edge_docs, least_reference=0)) == want


def test_empty_table_null_keys_and_carried_columns(no_docs, null_key_docs):
    assert quality_rules(no_docs).count() == 0
    rows = quality_rules(null_key_docs, carry=("source",)).collect()
    assert len(rows) == 4 and {r["source"] for r in rows} == {"s", None}
    assert [r["n_words"] for r in rows if r["doc_id"] is None and r["source"] is None] == [0]


def test_no_python_in_the_plan(spark):
    plan = op11_divergence_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not [x for x in ("Python", "Arrow", "Pandas") if x in plan]


def test_labelled_documents(spark):
    """Rejected: nearly all documents labelled bad, hardly any of the good ones long enough to judge."""
    sf = "/root/testdata/sf0.1"
    out = op11_divergence_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("n_words >= 20")
    shares = {r["quality"]: r["kept"] for r in out.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert shares[1] > 0.98 and shares[0] < 0.03
