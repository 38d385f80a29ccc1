"""Quality rules by distribution divergence, in DataFrame functions only.

Each document's histograms of character classes and of common words are compared with
those of its language over the whole corpus by Jensen-Shannon distance. Short texts, and
languages with little text, are not judged by distance.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docsentinel.llm.common import table
from docsentinel.session import ensure_checkpoint_dir

SPACES = r"[\x09-\x0D]"
#: Classes of the characters of words, in the order in which they are taken off; the last holds what is left.
CLASSES = (
    ("lower", "[a-z]+"), ("stop", "[-.,;:'\"?!()]+"), ("upper", "[A-Z]+"), ("digit", "[0-9]+"), ("sign", r"[\x00-\x7F]+"),
    ("other", None),
)
SLOTS = 1024
#: A reference has ``top`` words of some 20 bytes and a byte a slot: this many languages stay under 16 MB.
BROADCAST_LANGUAGES = 8_000


def words_of(text: str) -> Column:
    return F.array_remove(F.split(F.regexp_replace(text, SPACES, " "), " "), "")


def with_classes(rows: DataFrame, chars: str) -> DataFrame:
    """Adds ``_classes``, the counts of ``CLASSES`` in a column without white space, and ``_signs``."""
    out = rows.withColumn("_left0", F.col(chars))
    for i, (_, pattern) in enumerate(CLASSES[:-1]):
        out = out.withColumn(f"_left{i + 1}", F.regexp_replace(f"_left{i}", pattern, ""))
    left = [F.length(f"_left{i}").cast("long") for i in range(len(CLASSES))]
    counts = [a - b for a, b in zip(left, left[1:])] + [left[-1]]
    signs = F.length(F.regexp_replace("_left4", "[^#*$%&|<>]+", "")).cast("long")
    return out.select(*rows.columns, F.array(*counts).alias("_classes"), signs.alias("_signs"))


def language_references(docs: DataFrame, text: str, lang: str, top: int) -> DataFrame:
    """One row a language (null is one): word total, class counts, its ``top`` most frequent words and their counts.

    Equal counts are ordered by the word. Counts cover all documents, in one pass over the
    texts: classes are summed from the word counts. The top is cut map-side, before any task
    holds a language's words.
    """
    words = docs.select(F.col(lang).alias("_lang"), F.explode(words_of(F.coalesce(text, F.lit("")))).alias("_word"))
    counts = words.groupBy("_lang", "_word").agg(F.count(F.lit(1)).alias("_c"))
    totals = with_classes(counts, "_word").groupBy("_lang").agg(
        F.sum("_c").alias("_ref_n"),
        F.array(*[F.sum(F.col("_c") * F.col("_classes")[i]) for i in range(len(CLASSES))]).alias("_ref_classes"),
    )
    order = Window.partitionBy("_lang").orderBy(F.desc("_c"), "_word")
    best = counts.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= top)
    common = best.groupBy(F.col("_lang").alias("_of")).agg(
        F.sort_array(F.collect_list(F.struct("_rank", F.xxhash64("_word").alias("_hash"), "_c"))).alias("_best")
    )
    return totals.join(common, F.col("_lang").eqNullSafe(F.col("_of"))).select(
        "_lang", "_ref_n", "_ref_classes", F.col("_best._hash").alias("_ref_words"), F.col("_best._c").alias("_ref_counts")
    ).withColumn("_slots", F.transform("_ref_words", lambda h: F.pmod(h, F.lit(SLOTS)))).withColumn(
        # Where a word's hash may lie: most other words are told apart by one look.
        "_ref_slots", F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda i: F.array_contains("_slots", i.cast("long")))
    ).drop("_slots")


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x + y)


def js_divergence(counts: Column, n: Column, ref: Column, ref_n: Column) -> Column:
    """Jensen-Shannon divergence in bits of two histograms given as counts and their totals (both over 0)."""

    def half(p, q):
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))

    parts = F.zip_with(counts, ref, lambda a, b: half(a / n, b / ref_n) + half(b / ref_n, a / n))
    return F.aggregate(parts, F.lit(0.0), lambda x, y: x + y) / 2


def run_hashes(hashes: str) -> Column:
    """Hashes of the 4-word runs of a column of word hashes."""
    n = F.size(hashes)
    starts = F.slice(hashes, 1, F.greatest(n - 3, F.lit(0)))
    return F.transform(starts, lambda h, i: F.xxhash64(h, *[F.get(F.col(hashes), i + k) for k in (1, 2, 3)]))


def repeated_runs(fours: str) -> Column:
    """(``h``, ``p``) of the 8-word runs by hash and place, if some 4-word run comes twice; else none.

    An 8-word run that comes twice holds 4-word runs that do, so that most rows stop after a
    set of their hashes. An 8-word run's hash joins those of its halves.
    """
    starts = F.slice(fours, 1, F.greatest(F.size(fours) - 4, F.lit(0)))
    eights = F.transform(starts, lambda h, i: F.struct(F.xxhash64(h, F.get(F.col(fours), i + 4)).alias("h"), i.alias("p")))
    none = F.array().cast("array<struct<h:bigint,p:int>>")
    return F.when(F.size(F.array_distinct(fours)) < F.size(fours), F.sort_array(eights)).otherwise(none)


def places_of_repeats(runs: str) -> Column:
    """The places, in order, of the runs that the same row holds twice or more."""

    def twice(x, i):
        return x["h"].eqNullSafe(F.get(runs, i - 1)["h"]) | x["h"].eqNullSafe(F.get(runs, i + 1)["h"])

    return F.sort_array(F.transform(F.filter(runs, twice), lambda x: x["p"]))


def words_inside(places: str) -> Column:
    """Words in the union of 8-word runs at some places."""
    return _total(F.transform(places, lambda p, i: F.least(F.lit(8), F.coalesce(F.get(places, i + 1) - p, F.lit(8))).cast("long")))


def quality_rules(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    top: int = 50,
    max_class_distance: float = 0.21,
    max_word_distance: float = 0.33,
    least_words: int = 40,
    least_chars: int = 200,
    least_reference: int = 2_000,
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row a document: base counts, distances to its language's references, and ``kept``.

    A histogram of ``n`` draws over ``k`` bins lies some ``(k - 1) / (8 n ln 2)`` bits from its
    own source, so that much is taken off a divergence before its root is held against the
    limit. A distance is null, and does not reject, where the text has fewer than
    ``least_words`` words (class distance: ``least_chars`` characters) or its language fewer
    than ``least_reference`` words.

    Null texts are empty texts: no words, so ``base_failed``. A null language is a language of
    its own. Repeated rows and null keys are judged row by row; other columns are ignored
    (``carry`` names some to keep); an empty table gives no rows. A row's words must fit one
    task's memory; rows are not split.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    refs = language_references(docs, text, lang, top).checkpoint()
    kept = [f"_carry_{c}" for c in carry]
    rows = docs.select(
        F.col(key).alias("doc_id"), F.col(lang).alias("_lang"), F.coalesce(text, F.lit("")).alias("_text"),
        *[F.col(c).alias(k) for c, k in zip(carry, kept)],
    )
    # Each step keeps only what later ones read: rows are copied between steps with lambdas.
    lines = F.array_remove(F.split(F.regexp_replace("_text", r"(?md)^[\x20\x09\x0B-\x0D]+$", ""), "\n"), "")
    split = rows.select(
        "doc_id", "_lang", *kept, words_of("_text").alias("_words"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("_dup_lines"),
    ).withColumn("_chars", F.array_join("_words", ""))
    classed = with_classes(split, "_chars").select(
        "doc_id", "_lang", *kept, "_words", "_dup_lines", "_classes", "_signs", F.length("_chars").cast("long").alias("_n_chars"))
    # Words are compared by their 64-bit hashes from here on.
    hashed = classed.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w))).drop("_words")
    if refs.count() <= BROADCAST_LANGUAGES:
        joined = hashed.join(F.broadcast(refs.withColumnRenamed("_lang", "_of")), F.col("_lang").eqNullSafe(F.col("_of")), "left")
    else:  # salted: no task holds all rows of a common language
        salts = 64
        hashed = hashed.withColumn("_salt", F.pmod(F.xxhash64("_hashes"), F.lit(salts)))
        each = refs.withColumnRenamed("_lang", "_of").withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = hashed.join(each, F.col("_lang").eqNullSafe(F.col("_of")) & (F.col("_salt") == F.col("_s")), "left")
    sides = ["doc_id", *kept, "_dup_lines", "_classes", "_signs", "_n_chars", "_ref_n", "_ref_words", "_ref_counts", "_ref_classes"]
    empty = F.array().cast("array<bigint>")
    joined = joined.select(  # a language without a word has no reference
        *[c for c in sides if c not in ("_ref_n", "_ref_words", "_ref_counts")], "_hashes", "_ref_slots",
        F.coalesce("_ref_n", F.lit(0)).alias("_ref_n"), F.coalesce("_ref_words", empty).alias("_ref_words"),
        F.coalesce("_ref_counts", empty).alias("_ref_counts"),
    )
    # Common words first, so that each count reads few.
    common = F.filter("_hashes", lambda w: F.get("_ref_slots", F.pmod(w, F.lit(SLOTS)).cast("int")) & F.array_contains("_ref_words", w))
    found = joined.select(
        *sides, F.size("_hashes").cast("long").alias("_n"), common.alias("_common"), run_hashes("_hashes").alias("_fours"))
    hits = F.transform("_ref_words", lambda w: (F.size("_common") - F.size(F.array_remove("_common", w))).cast("long"))
    sides.remove("_ref_words")
    measured = found.select(
        *sides, "_n", F.size("_ref_words").alias("_bins"), hits.alias("_hits"),
        F.coalesce(F.col("_n") - F.size("_common"), "_n").alias("_rest"), repeated_runs("_fours").alias("_runs"))
    measured = measured.withColumn("_at", places_of_repeats("_runs")).drop("_runs")
    measured = measured.withColumn("_repeats", words_inside("_at")).drop("_at")

    def distance(divergence: Column, bins: Column, n: Column) -> tuple[Column, Column]:
        raw = F.greatest(divergence, F.lit(0.0))
        return F.sqrt(raw), F.sqrt(F.greatest(raw - (bins - 1) / (8 * math.log(2) * n), F.lit(0.0)))

    chars = F.col("_n_chars")
    known = (F.col("_ref_n") >= least_reference) & (F.col("_ref_n") > 0)
    word_ok, class_ok = known & (F.col("_n") >= least_words), known & (chars >= least_chars)
    ref_rest = F.col("_ref_n") - _total(F.col("_ref_counts"))
    word_js = js_divergence(
        F.concat("_hits", F.array("_rest")), F.col("_n"), F.concat("_ref_counts", F.array(ref_rest)), F.col("_ref_n")
    )
    class_js = js_divergence(F.col("_classes"), chars, F.col("_ref_classes"), _total(F.col("_ref_classes")))
    word_raw, word_net = distance(word_js, F.col("_bins") + 1, F.col("_n"))
    class_raw, class_net = distance(class_js, F.lit(len(CLASSES)), chars)
    judged = measured.select(
        "doc_id", F.col("_n").alias("n_words"), chars.alias("word_chars"), F.col("_signs").alias("n_symbols"),
        F.col("_dup_lines").alias("n_dup_lines"),
        F.col("_repeats").alias("n_repeat_words"),
        F.when(class_ok, class_raw).alias("class_distance"), F.when(word_ok, word_raw).alias("word_distance"),
        (F.when(class_ok, class_net > max_class_distance).otherwise(False)
         | F.when(word_ok, word_net > max_word_distance).otherwise(False)).alias("_far"),
        *[F.col(k).alias(c) for c, k in zip(carry, kept)],
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~F.col("_far")).drop("_far")


def op11_divergence_rules(spark, sf_dir: str) -> DataFrame:
    """Base counts and the divergence verdict of every document."""
    out = quality_rules(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("class_distance", 6).alias("class_distance"), F.round("word_distance", 6).alias("word_distance"),
    )
