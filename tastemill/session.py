"""Session settings and the shared scratch area used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import tastemill

# Functions run by Python workers travel inside the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(tastemill)

_LOCAL_ROOTS: dict[str, str] = {}


def build_session(app: str = "tastemill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings every job relies on; safe to call on a session made elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    # One key may hold a large share of the rows: split its join partition even where the plan
    # above would then need one more shuffle.
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # Vector blocks are wide rows: bound an Arrow batch by bytes as well as by rows.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` where the cluster names one.

    Only a local master may fall back to a folder of its own; on a cluster a machine-local
    folder would be lost with its executor, so that case is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="tastemill-")
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join that must not broadcast it.

    The planner takes a table's size from its files; texts and ids that repeat need sixty times that in the driver's memory.
    """
    return df.hint("merge")


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to all cores: a small file is read by one task, however much is worked out of each of its rows."""
    return df.repartition(max(1, df.sparkSession.sparkContext.defaultParallelism))


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared scratch area and continue from the written table.

    The result survives lost executors, and plans that read it several times (or that must not
    see a second, differently sampled range partitioning) all read the same rows.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
