"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Adaptive execution coalesces small shuffle partitions, splits skewed join partitions and
# turns joins into broadcasts only when the measured side is below the size threshold.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # The JVM does not compile methods above 8000 bytes of code; wide projections are split instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Call sites of column expressions cost one stack walk per call; queries here build many.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", app: str = "fieldgap") -> SparkSession:
    """Local session for tests and measurements; on a cluster use the session you are given."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A constant table whose size the optimizer knows.

    Going through Arrow gives a local relation; a list of tuples would become an RDD scan of
    unknown size, and joins with it would shuffle the large side.
    """
    names = StructType.fromDDL(schema).names
    columns = {name: [row[i] for row in rows] for i, name in enumerate(names)}
    return spark.createDataFrame(pa.table(columns), schema=schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    A machine-local folder is only made where the setting is absent and the master is local.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="fieldgap-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
