"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What a cluster session should carry; AQE sizes and splits the shuffle partitions at run time.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Wide projections (a case form has some 60 columns) generate methods beyond 8,000 bytes, which the
    # JVM only interprets. At this limit Spark splits them instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: int = 8, app: str = "casewright", memory: str = "8g") -> SparkSession:
    """A session for tests and the bench on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediates: ``spark.checkpoint.dir``.

    A cluster sets it to a store all executors reach. Only where it is unset (tests on one
    machine) does the library choose a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="casewright-")
    atexit.register(shutil.rmtree, root, True)
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the scratch root, in that of this application; nothing is ever overwritten there."""
    return f"{scratch_root(spark)}/casewright-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application has written to the scratch root. For its end: tables that are still to be read go too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/casewright-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """What is written inside leaves no shuffle files: they go with the end of each write. Otherwise they stay on the executors' disks until
    the driver happens to collect its garbage, those of a whole day's run together."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def cut_lineage(spark: SparkSession, name: str, df):
    """Write ``df`` to the shared scratch folder and read it back.

    Used where several results branch off one expensive state: the written table is computed
    once, and survives the loss of executors.
    """
    path = scratch_path(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(name: str, df):
    """``cut_lineage`` on the table's own session."""
    return cut_lineage(df.sparkSession, name, df)
