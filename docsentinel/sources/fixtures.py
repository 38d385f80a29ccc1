"""Raw event tables derived from the benchmark tables.

The benchmark data has no document events, so ``lineitem`` becomes the control
events (one per line) and ``orders`` the creation events (most orders once, some
twice, some never), by pure integer/string/date expressions. The expressions are
SQL text valid in both Spark SQL and DuckDB, so an independent oracle can start
from exactly the same raw rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsentinel.sources.schemas import RAW_CONTROLLED, RAW_CREATED

# Fixture run date: the latest order date at every scale factor.
FIXTURE_AS_OF = dt.date(2001, 8, 1)

# Rows of a task when a table is dealt out: the number of tasks grows with the table.
DEALT_ROWS = 2_000_000

# Fixture value lists (indexed by the integer expressions below).
SCORES = (
    "advanced", "ADVANCEDPF", "efficient", "EFFICIENTPF", "EFFICIENTPLUS",
    "jdiEfficientPlus", "standard", "STANDARDPF", "STANDARDPLUS",
)
IDENTIFIERS = (
    "Document.AddressConsistency", "Document.AddressLocalityConsistency",
    "Applicant.AlternateFamilyNameConsistency", "Applicant.AlternateFamilyNameDetection",
    "Document.BicIbanConsistency", "Document.BirthdateMrzConsistency", "Document.DateValidation",
    "Applicant.FamilyNameAccountHolderSearch", "Applicant.FamilyNameConsistency",
    " Applicant.FamilyNameSearch ", "Document.PersonalIdConsistency", "Other.Unknown",
)
SUBTYPES = (
    "ADDRESS_PROOF_FRA", "BANK_ACCOUNT_DETAILS_DEU", "DIGITALID", "DRIVING_LICENSE_FRA_CARD_2013",
    "DRIVING_LICENSE_ITA_PAPER_1990", "DRIVING_LICENSE_ESP_2015", "ID_CARD_FRA_2021", "ID_CARD_XYZ",
    "PASSPORT_BEL_2017", "PAYSLIP_FRA", "RESIDENCE_PERMIT_PRT_2020", "INCOME_TAX_STATEMENT_FRA",
    "OPEN_BANKING",
)
TYPES = (
    "ADDRESS_PROOF", "BANK_ACCOUNT_DETAILS", "DIGITALID", "DRIVING_LICENSE", "DRIVING_LICENSE",
    "DRIVING_LICENSE", "ID_CARD", "ID_CARD", "PASSPORT", "PAYSLIP", "RESIDENCE_PERMIT",
    " Tax_Document ", "OPEN_BANKING",
)


def _pick(expr: str, values: tuple[str, ...]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {arms} END"


CONTROL_ITEM = (
    "concat('{\"identifier\":\"', " + _pick("l_partkey % 12", IDENTIFIERS)
    + ", '\",\"status\":', CASE WHEN l_returnflag = 'A' THEN '\"OK\"' WHEN l_returnflag = 'R' "
    "THEN '\"KO\"' WHEN l_linestatus = 'O' THEN '\"NA\"' ELSE 'null' END, "
    "',\"scores\":[\"a\",\"b\"]}')"
)
# Control payloads of suppliers by ``l_suppkey % 97``; all others are an array of one item.
CONTROL_SHAPES = {
    5: "'[]'",
    11: f"concat('[', {CONTROL_ITEM}, ',5]')",
    17: f"concat('[', {CONTROL_ITEM}, ',{{\"identifier\":\"Document.Other\",\"status\":\"KO\"}},\"x\"]')",
    23: CONTROL_ITEM,
    29: "'[{\"identifier\":\"Document.DateValidation\"'",
    31: "'null'",
    37: f"concat(chr(10), chr(9), '[', {CONTROL_ITEM}, ']')",
    41: "'[{\"identifier\":{\"n\":\"Document.DateValidation\"},\"status\":[\"OK\"]}]'",
    43: "'[7]'",
    47: "'[null]'",
}
# The texts before and after the item in those payloads that hold it; ``'['`` and ``']'`` in all others.
ITEM_SURROUNDINGS = {
    11: ("'['", "',5]'"),
    17: ("'['", "',{\"identifier\":\"Document.Other\",\"status\":\"KO\"},\"x\"]'"),
    23: ("''", "''"),
    37: ("concat(chr(10), chr(9), '[')", "']'"),
}


def _around_item(side: int, otherwise: str) -> str:
    arms = " ".join(f"WHEN {k} THEN {texts[side]}" for k, texts in ITEM_SURROUNDINGS.items())
    return f"CASE l_suppkey % 97 {arms} ELSE {otherwise} END"


# The payload as Spark computes it, with the item once: its copies in ``CONTROLLED_EXPRS`` make a
# method so long that the JVM never compiles it.
CONTROL_PAYLOAD = (
    "CASE l_suppkey % 97 " + " ".join(f"WHEN {k} THEN {e}" for k, e in CONTROL_SHAPES.items() if k not in ITEM_SURROUNDINGS)
    + f" ELSE concat({_around_item(0, repr('['))}, {CONTROL_ITEM}, {_around_item(1, repr(']'))}) END"
)
PAYLOAD = "data_documentcontrolsdata_documentcontrols_anonymized"
CONTROLLED_EXPRS: dict[str, str] = {
    "id": "concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), "
    "cast(l_partkey as string), cast(l_suppkey as string), cast(cast(l_shipdate as date) as string))",
    "doc_id": "cast(l_orderkey as string)",
    "data_documentcontrolsdata_documentcontrols_anonymized": (
        "CASE l_suppkey % 97 " + " ".join(f"WHEN {k} THEN {e}" for k, e in CONTROL_SHAPES.items())
        + f" ELSE concat('[', {CONTROL_ITEM}, ']') END"
    ),
    "data_documentcontrolsdata_documentfaceids": (
        "concat('[{\"id\":\"f', cast(l_linenumber as string), '\",\"type\":\"', "
        "CASE WHEN l_linenumber % 2 = 0 THEN 'recto' ELSE 'verso' END, '\",\"domain\":\"kyc\"', "
        "CASE WHEN l_linenumber % 4 = 3 THEN '' ELSE concat(',\"organizationId\":\"client ', "
        "cast(l_linenumber % 2 + 1 as string), '\"') END, '}]')"
    ),
    "data_documentcontrolsdata_status": "CASE WHEN l_linestatus = 'F' THEN 'APPLIED' ELSE 'PARTIAL' END",
    "data_eventdate": "l_shipdate + INTERVAL '1' HOUR",
    "data_score": _pick("l_suppkey % 10", SCORES),
    "time": "l_shipdate",
}

CREATED_EXPRS: dict[str, str] = {
    "id": "concat('c', cast(r as string), '-', cast(o_orderkey as string))",
    "data_id_id": "cast(o_orderkey as string)",
    "data_acquisitionid_organizationid": "concat('client ', cast(o_custkey % 2 + 1 as string))",
    "data_acquisitionid_type": "CASE WHEN o_custkey % 2 = 0 THEN ' UPLOAD ' ELSE 'Scan' END",
    "data_documentclass_documentsubtype": _pick("(o_custkey + r) % 13", SUBTYPES),
    "data_documentclass_documenttype": _pick("(o_custkey + r) % 13", TYPES),
    "data_eventdate": "o_orderdate + INTERVAL '1' HOUR",
    "time": "o_orderdate",
}
LINEITEM_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus",
                    "l_shipdate")
ORDERS_COLUMNS = ("o_orderkey", "o_custkey", "o_orderdate")
CREATED_FILTER = "o_orderkey % 17 <> 0 AND (r = 1 OR o_orderkey % 23 = 0)"


def raw_controlled_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """One control event per ``lineitem`` row (narrow: no shuffle)."""
    exprs = CONTROLLED_EXPRS | {PAYLOAD: CONTROL_PAYLOAD}
    cols = [F.expr(e).cast(RAW_CONTROLLED[name].dataType).alias(name) for name, e in exprs.items()]
    return lineitem.select(*cols)


def raw_created_from_orders(orders: DataFrame) -> DataFrame:
    """Creation events from ``orders``: copy ``r=1`` always, ``r=2`` for some orders.

    The second copy is produced by ``explode`` of a 1- or 2-element array rather
    than a cross join with a two-row table, and the row filter on ``o_orderkey``
    is applied first so the scan can skip rows.
    """
    copies = F.when(F.col("o_orderkey") % 23 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    base = (
        orders.filter(F.col("o_orderkey") % 17 != 0)
        .select("o_orderkey", "o_custkey", "o_orderdate", F.explode(copies).alias("r"))
        .filter(F.expr(CREATED_FILTER))
    )
    cols = [F.expr(e).cast(RAW_CREATED[name].dataType).alias(name) for name, e in CREATED_EXPRS.items()]
    return base.select(*cols)


def fixture_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(raw_controlled, raw_created)`` derived from ``sf_dir``'s parquet tables.

    Raw events land as many files. A table in a few parquet row groups, each of which one task
    reads, is dealt out first; others are read as they lie. Filters still reach the scan.
    """
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*LINEITEM_COLUMNS)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(*ORDERS_COLUMNS)
    return (
        raw_controlled_from_lineitem(dealt(lineitem, "l_orderkey", "l_partkey", "l_suppkey")),
        raw_created_from_orders(dealt(orders, "o_orderkey")),
    )


def dealt(table: DataFrame, *keys: str) -> DataFrame:
    """``table`` over all tasks: dealt by ``keys`` if the largest scan task has over twice its share of the rows.

    The rows a scan task would read are counted from the file footers, without a column.
    """
    tasks = table.sparkSession.sparkContext.defaultParallelism
    scan = table.select(F.spark_partition_id().alias("task")).groupBy("task").count()
    largest, rows = scan.agg(F.max("count"), F.sum("count")).first()
    if not rows or largest * tasks <= 2 * rows:
        return table
    return table.repartition(max(tasks, -(-rows // DEALT_ROWS)), *keys)


def oracle_raw_ctes() -> str:
    """``WITH`` prefix defining ``raw_controlled`` and ``raw_created`` for DuckDB."""
    ctl = ",\n    ".join(f"{e} AS \"{n}\"" for n, e in CONTROLLED_EXPRS.items())
    cre = ",\n    ".join(f"{e} AS \"{n}\"" for n, e in CREATED_EXPRS.items())
    return (
        "WITH raw_controlled AS (\n  SELECT\n    " + ctl + "\n  FROM lineitem\n),\n"
        "raw_created AS (\n  SELECT\n    " + cre + "\n  FROM orders CROSS JOIN (SELECT 1 AS r UNION ALL SELECT 2 AS r) copies\n"
        "  WHERE " + CREATED_FILTER + "\n)"
    )
