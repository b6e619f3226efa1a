"""Which raw files have been taken, kept for open days only.

A run lists the folders of the days after each root's closed day, and leaves out the files that the manifest has
of those days. Closing a day replaces its file keys by a mark: how many files it had and the last number among
them. So what a run lists, reads and joins depends on the open days, however many days lie behind them. A file
that turns up in a closed day is not seen; close days only when nothing can come any more.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from .files import RAW_GLOB, ROOT_TAGS, file_key, if_present, placed, with_key_parts

_TAKEN = "root string, file_key string, seq int, day date"
_MARKS = "root string, closed_through date, files long, last_seq int"


class Manifest:
    """File keys by open day, in a table `name`, and one mark a root and closing in `name`_marks."""

    def __init__(self, spark: SparkSession, name: str, roots: tuple[str, ...] = tuple(ROOT_TAGS)):
        self.spark, self.taken, self.marks, self.roots = spark, name, f"{name}_marks", roots
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.taken} ({_TAKEN}) USING parquet PARTITIONED BY (day)")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.marks} ({_MARKS}) USING parquet")

    def closed(self) -> dict[str, date | None]:
        """The day through which each root is closed."""
        rows = self.spark.table(self.marks).groupBy("root").agg(F.max("closed_through").alias("day")).collect()  # a row a root
        return dict.fromkeys(self.roots) | {row.root: row.day for row in rows}

    def listed(self, base: str, until: date) -> DataFrame:
        """The files of the open days up to one, by listing their folders alone; all of a root never closed."""
        found = []
        for root, closed in self.closed().items():
            reader = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", RAW_GLOB)
            open_days = [closed + timedelta(days=n) for n in range(1, (until - closed).days + 1)] if closed else None
            if open_days == []:
                continue
            place = "{" + ",".join(f"date={day}" for day in open_days) + "}" if open_days else ""
            listing = if_present(lambda reader=reader, path=f"{base}/{root}/{place}": reader.load(path))
            if listing is not None:
                found.append(listing.select(file_key(F.col("path")).alias("file_key")))
        keys = reduce(DataFrame.unionByName, found, self.spark.createDataFrame([], "file_key string"))
        return placed(with_key_parts(keys)).filter(F.col("day") <= F.lit(until))

    def pending(self, base: str, until: date) -> DataFrame:
        """Files of the open days that have not been taken: (file_key, root, day, seq)."""
        known = self.spark.table(self.taken).select("file_key")  # of open days, all there is
        return self.listed(base, until).join(known, "file_key", "left_anti")

    def take(self, files: DataFrame) -> None:
        """Note files as taken; a repeat notes them again, which changes nothing."""
        rows = files.select("root", "file_key", "seq", "day")
        rows.hint("rebalance", "day").write.mode("append").insertInto(self.taken)

    def close(self, day: date) -> list[Row]:
        """Replace what is known of the days up to one by a mark for each root; the marks."""
        old = self.spark.table(self.taken).filter(F.col("day") <= F.lit(day))
        counts = old.select("root", "file_key", "seq").distinct().groupBy("root").agg(F.count("*").alias("files"), F.max("seq").alias("last_seq"))
        roots = self.spark.createDataFrame([(root, day) for root in self.roots], "root string, closed_through date")
        marks = roots.join(counts, "root", "left").select("root", "closed_through", F.coalesce("files", F.lit(0)).alias("files"), "last_seq").collect()
        self.spark.createDataFrame(marks, _MARKS).coalesce(1).write.mode("append").insertInto(self.marks)
        gone = sorted({row[0] for row in old.select("day").distinct().collect()})  # calendar days
        for gone_day in gone:
            self.spark.sql(f"ALTER TABLE {self.taken} DROP IF EXISTS PARTITION (day = DATE'{gone_day}')")
        return marks
