"""Session construction for tests, tools and the benchmark, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.driver.memory": "16g",
}


def build_session(app: str = "docsentinel", master: str | None = None, **conf: str) -> SparkSession:
    """Local session for tests/bench (``local[$BENCH_CPUS]`` or ``local[*]``)."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**DEFAULT_CONF, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared ``spark.checkpoint.dir``; a private temp dir only where it is unset in local mode."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="docsentinel-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def work_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint folder, e.g. for tables a query writes."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    segs = ["docsentinel", *parts] + ([uuid.uuid4().hex] if unique else [])
    return "/".join([base, *segs])
