"""Raw and Bronze JSONL files.

Raw files lie under `<root>/date=YYYY-MM-DD/events-NNNN.jsonl`, in one of two roots that tell
how a record came in. A file is known by its key, `<root name>/date=.../events-NNNN.jsonl`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import BRONZE

# Raw roots and the lineage tag of each, tags of the two Bronze drops, what a
# delivered file's key starts with, and file names. `part-*` is what Spark itself writes, here
# under a folder per micro-batch.
ROOT_TAGS = {"raw_events": "direct_raw", "raw_events_kafka": "kafka_consumer"}
DIRECT_TAG, STREAM_TAG = "direct_raw", "kafka_consumer_direct"
LEGACY_ROOT = "raw_events"
DELIVERY_PREFIXES = {"direct": "out/bronze_batches", "kafka": "data/bronze_batches_kafka"}
RAW_GLOB = "{events-*.jsonl,part-*}"
DIRECT_GLOB = "{*.jsonl,part-*}"
STREAM_GLOB = "{bronze_events-*.jsonl,part-*}"
RAW_KEY = r"([^/]+)/date=(\d{4}-\d{2}-\d{2})/(?:batch=[^/]+/)?(?:events|part)-(\d+)[^/]*$"


def if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What `read` gives, or nothing if there is no such path."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def lineage_tag(root: Column) -> Column:
    """Tag of a raw root; an unlisted root is its own tag."""
    return F.coalesce(*(F.when(root == name, F.lit(tag)) for name, tag in ROOT_TAGS.items()), root)


def file_key(path: Column) -> Column:
    """The end of a file path: root, date folder, batch folder if any, file name."""
    return F.regexp_extract(path, r"([^/]+/[^/]+(?:/batch=[^/]+)?/[^/]+)$", 1)


def with_key_parts(files: DataFrame) -> DataFrame:
    """Split `file_key` into root, day and sequence number; NULL where it has another shape."""
    def part(group: int) -> Column:
        return F.nullif(F.regexp_extract("file_key", "^" + RAW_KEY, group), F.lit(""))

    return files.withColumns({
        "root": part(1),
        "day": part(2).try_cast("date"),
        "seq": part(3).try_cast("int"),
    })


def list_raw_files(spark: SparkSession, roots: list[str]) -> DataFrame:
    """One row per raw file of the existing roots, by listing alone (no content is read)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", RAW_GLOB)
    listings = [if_present(lambda root=root: reader.load(root)) for root in roots]
    keys = [listing.select(file_key(F.col("path")).alias("file_key")) for listing in listings if listing is not None]
    return with_key_parts(reduce(DataFrame.unionByName, keys, spark.createDataFrame([], "file_key string")))


def misplaced(files: DataFrame) -> DataFrame:
    """Files whose key has another shape than root/date=.../events-NNNN.jsonl."""
    return files.filter("day is null or seq is null")


def placed(files: DataFrame) -> DataFrame:
    """The files, or a failure that names the first one found to be misplaced."""
    wrong = F.col("day").isNull() | F.col("seq").isNull()
    complaint = F.concat(F.lit("misplaced raw file: "), "file_key")
    return files.withColumn("file_key", F.when(wrong, F.raise_error(complaint)).otherwise(F.col("file_key")))


def current_key(key: Column) -> Column:
    """Keys written before there were two roots name no root; they belong to the first one."""
    return F.when(key.startswith("date="), F.concat(F.lit(LEGACY_ROOT + "/"), key)).otherwise(key)


def pending_files(found: DataFrame, processed: DataFrame) -> DataFrame:
    """Files found but not yet processed."""
    done = processed.select(current_key(F.col("file_key")).alias("file_key"))
    return found.join(done, "file_key", "left_anti")


def pending_deliveries(found: DataFrame, delivered: DataFrame) -> DataFrame:
    """Batch files (source, path) not yet delivered.

    A delivered file is known by its source's prefix and its path; one of the direct source
    may also be listed by its bare file name.
    """
    prefix = F.coalesce(
        *(F.when(F.col("source") == name, F.lit(value)) for name, value in DELIVERY_PREFIXES.items()),
        "source",
    )
    bare_name = F.regexp_extract("path", r"([^/]+)$", 1)
    keyed = found.withColumn("delivery_key", F.concat_ws("/", prefix, "path"))
    left = keyed.join(delivered, F.col("delivery_key") == F.col("file_key"), "left_anti")
    direct = F.col("source") == "direct"
    named = left.filter(direct).join(delivered, bare_name == F.col("file_key"), "left_anti")
    return named.unionByName(left.filter(~F.coalesce(direct, F.lit(False))))


def read_raw_lines(spark: SparkSession, base: str, max_files: int | None = None) -> DataFrame:
    """Lines of the raw files below `base` as (line, file_key); a stream if `max_files` a batch are given.

    Blank lines are left out. A stream takes each file once, however often it is started.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", max_files) if max_files else spark.read
    roots = "{" + ",".join(ROOT_TAGS) + "}"
    reader = reader.format("text").option("recursiveFileLookup", True).option("pathGlobFilter", RAW_GLOB)
    lines = if_present(lambda: reader.load(f"{base}/{roots}"))
    if lines is None:
        return spark.createDataFrame([], "line string, file_key string")
    return lines.select(
        F.col("value").alias("line"), file_key(F.col("_metadata.file_path")).alias("file_key")
    ).filter(F.btrim("line", F.lit(" \t\r\n")) != "")


def _read_drop(spark: SparkSession, folder: str, pattern: str, tag: str) -> DataFrame:
    reader = (
        spark.read.schema(BRONZE)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .option("ignoreMissingFiles", True)
    )
    rows = if_present(lambda: reader.json(folder))
    return spark.createDataFrame([], BRONZE) if rows is None else with_lineage(rows, tag)


def with_lineage(rows: DataFrame, default_tag: str) -> DataFrame:
    """The 13 Bronze columns as text, with a lineage tag where a row brings none."""
    tagged = rows.withColumn("ingestion_source", F.coalesce("ingestion_source", F.lit(default_tag)))
    return tagged.select(*(F.col(name).cast("string") for name in BRONZE.names))


def read_bronze(spark: SparkSession, direct: str, stream: str) -> DataFrame:
    """Rows of both Bronze drops, as they are; an absent folder counts as empty."""
    return _read_drop(spark, direct, DIRECT_GLOB, DIRECT_TAG).unionByName(
        _read_drop(spark, stream, STREAM_GLOB, STREAM_TAG)
    )
