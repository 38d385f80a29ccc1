"""A third of all control events on one document: results must still equal the oracle.

Broadcast joins are disabled and AQE's skew thresholds lowered so the skew-join
path (splitting the hot partition) is actually taken at this small size.
"""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from test_oracle import _rows

# An order key with two creation events (o_orderkey % 23 == 0, % 17 != 0): the hot document also fans out.
HOT_QUERIES = [
    "documents_controled_detailed", "control_results", "ctl_control_results_over_time", "control_aggregation",
    "results_control_score", "results_control_score_2", "control_monthly_trends", "status_bundle",
]

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("skewed"))
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    hot = orders.filter((F.col("o_orderkey") % 23 == 0) & (F.col("o_orderkey") % 17 != 0)).agg(
        F.min("o_orderkey")).first()[0]
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    third = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey"), F.lit(3)) == 0
    li.withColumn("l_orderkey", F.when(third, F.lit(hot)).otherwise(F.col("l_orderkey"))).repartition(8).write.parquet(
        f"{d}/lineitem.parquet")
    orders.write.parquet(f"{d}/orders.parquet")
    con = duckdb.connect()
    for t in ("lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    share = con.execute(f"SELECT avg(CASE WHEN l_orderkey = {hot} THEN 1.0 ELSE 0 END) FROM lineitem").fetchone()[0]
    assert share > 0.3
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield d, con
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", HOT_QUERIES)
def test_hot_document_matches_oracle(spark, skewed, name):
    d, con = skewed
    df = E.queries()[name](spark, d)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [c[0] for c in res.description]
    assert _rows(df.columns, got) == _rows(ocols, res.fetchall())


def test_detailed_join_splits_the_hot_partition(spark, skewed):
    d, _ = skewed
    df = E.queries()["documents_controled_detailed"](spark, d)
    df.collect()  # runs this DataFrame's own query execution, so its adaptive plan becomes final
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    assert "SortMergeJoin" in plan
    assert "SortMergeJoin(skew=true)" in plan and "skewed" in plan
