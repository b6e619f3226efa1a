"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that the results rely on.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Overwriting some days of a table leaves its other days alone.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# The Silver projection is wide. Beyond this size the JVM would interpret the method generated
# for a whole stage instead of compiling it; Spark then generates one method per operator.
CODEGEN = {"spark.sql.codegen.hugeMethodLimit": "8000"}

# Settings that make the plans hold up on a large cluster: adaptive re-planning merges small
# shuffle partitions and splits skewed ones; retried stages must not lose shuffle output.
CLUSTER = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.parquet.compression.codec": "zstd",
    # Lets a task write both Silver outcomes side by side instead of sorting its rows first.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}

def build_session(app: str, master: str | None = None, partitions: int | None = None, **conf: str) -> SparkSession:
    """`partitions`: what shuffles start from before adaptive execution merges the small ones.

    Half a gigabyte each sorts within executor memory; shuffled rows take about three times their bytes
    as Parquet. A table of 100 TB thus wants some 600 000, one of 1 TB 6000.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    start = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions)} if partitions else {}
    for key, value in {**SEMANTICS, **CODEGEN, **CLUSTER, **start, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Set, on a session made by someone else, what results and generated code rely on."""
    for key, value in {**SEMANTICS, **CODEGEN}.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by the cluster in `spark.checkpoint.dir`.

    Only a single-machine session may do without it; it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="eventmill-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Wide rows that later steps read more than once, as Parquet in the shared folder: compressed, in no order."""
    path = scratch_path(df.sparkSession, "stored")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Rows that later steps read more than once, written to the shared folder by Spark's checkpoint."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
