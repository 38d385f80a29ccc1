"""A training corpus from raw documents: five stages, each over all that the one before kept.

``STAGES`` lists (name, function) in order. A function takes (spark, docs, sf_dir) and
returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsentinel.llm.common import table
from docsentinel.llm.fm_index import remove_passages
from docsentinel.llm.packing import pack
from docsentinel.llm.quality_gam import fit_quality, keep_good
from docsentinel.llm.simhash import keep_first_of_each
from docsentinel.llm.suffix_dedup import drop_repeats
from docsentinel.session import work_path
from docsentinel.sources.tables import delete_path


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now (null text: null)."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model calls good; labels come from the tables."""
    return keep_good(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: 4-word shingles, at most 4 bits apart."""
    return keep_first_of_each(docs, shingle=4, max_bits=4)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings of earlier documents; emptied documents go."""
    return _recounted(drop_repeats(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without 10-word benchmark passages."""
    return _recounted(remove_passages(docs, table(spark, sf_dir, "benchmark")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of every document and the sequences they fill."""
    return pack(docs, max_words=300_000)  # beside the memory that earlier stages left


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: No SQL engine expresses the trained model, SimHash components or the tokenizer.
ORACLE_SQL = None


#: Text that goes to a Python worker at once, while the stages run.
BATCH_BYTES = "8m"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result but the last is written and read again.

    A stage's corpus is deleted once the next one is written; the one that the last stage
    reads stays, as its result may still be read. Executors keep Python workers of earlier
    stages, so Arrow batches are kept small.
    """
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, BATCH_BYTES)
    try:
        docs, last = table(spark, sf_dir, "documents"), None
        for name, stage in STAGES[:-1]:
            path = work_path(spark, "pipeline", name, unique=True)
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
            if last:
                delete_path(spark, last)
            last = path
        return STAGES[-1][1](spark, docs, sf_dir)
    finally:
        spark.conf.set(_BATCH, before)
