"""Incremental runs: daily slices, change tails, windows, running counters."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

SALTS = 16  # parts of a source's state, so that a source with most of the rows is not one task's


def records(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    """New JSON-line files of a folder as a stream. Files are read once, whole: they must be moved in when they are complete."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def ingest(stream: DataFrame, table: str, checkpoint: str, keys: list[str], transform: Callable[[DataFrame], DataFrame] = lambda d: d):
    """Appends the rows whose key has not come before, and ends when all files are read.

    Keys that came are the stream's state, in RocksDB under the checkpoint, so a batch looks up its own keys only and the
    table is not read.  A batch's number names its part of the table, and is overwritten if the batch runs again, so a
    restart adds nothing twice.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def one(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={number}")

    return transform(stream).dropDuplicates(keys).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def appended(stream: DataFrame, table: str, checkpoint: str):
    """Appends all rows of a stream, and ends when all that is there is read; a batch that runs again overwrites its part."""

    def one(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={number}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_by_window(events: DataFrame, ts: str, width: str, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Tumbling counts; rows later than the watermark are dropped in a stream."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width), *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")


def sessions(events: DataFrame, ts: str, gap: str, key: str, late: str = "1 hour") -> DataFrame:
    return events.withWatermark(ts, late).groupBy(key, F.session_window(ts, gap)).agg(F.count("*").alias("n")).select(key, F.col("session_window.start").alias("start"), "n")


def changes(df: DataFrame, updated: str, begin: str, end: str, most_days: int = 30) -> DataFrame:
    """Rows changed in [begin, end); windows over `most_days` are refused."""
    from datetime import datetime

    if (datetime.fromisoformat(end) - datetime.fromisoformat(begin)).days > most_days:
        raise ValueError(f"a window of more than {most_days} days")
    return df.where((F.col(updated) >= F.lit(begin).cast("timestamp")) & (F.col(updated) < F.lit(end).cast("timestamp")))


def day_slices(df: DataFrame, ts: str, path: str) -> None:
    """One folder a day, replaced whole when a day is run again."""
    days = df.withColumn("day", F.to_date(ts))
    days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


class Tally(StatefulProcessor):
    """Additive counts of outcomes, kept over batches and runs."""

    def init(self, handle) -> None:
        self.counts = handle.getMapState("counts", "outcome string", "n long")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        import pandas as pd

        new: Counter = Counter()
        for part in rows:
            new.update(part["outcome"].value_counts().to_dict())
        out = []
        for outcome, n in sorted(new.items()):
            before = self.counts.getValue((outcome,))[0] if self.counts.containsKey((outcome,)) else 0
            self.counts.updateValue((outcome,), (before + int(n),))
            out.append((*key, outcome, before + int(n)))
        yield pd.DataFrame(out, columns=["source", "salt", "outcome", "n"])

    def close(self) -> None:
        pass


def tallied(stream: DataFrame, source: str, outcome: str, path: str, checkpoint: str):
    """Counts of each source's outcomes over all runs so far, as a started query that ends when all that is there is read.

    A batch writes the counts that it has changed under its own number, and writes the same again if it is run again.  Null sources and
    outcomes count as empty ones.  `tallies` reads the counts.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    salt = F.pmod(F.xxhash64(*(F.col(c).cast("string") for c in stream.columns)), F.lit(SALTS)).cast("int")
    rows = stream.select(F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), salt.alias("salt"), F.coalesce(F.col(outcome).cast("string"), F.lit("")).alias("outcome"))
    counts = rows.groupBy("source", "salt").transformWithStateInPandas(statefulProcessor=Tally(), outputStructType="source string, salt int, outcome string, n long", outputMode="Update", timeMode="None")

    def one(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return counts.writeStream.foreachBatch(one).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tallies(spark: SparkSession, path: str) -> DataFrame:
    """(source, outcome, n) as the last batches have left them."""
    parts = spark.read.schema("source string, salt int, outcome string, n long, batch long").parquet(path)
    return parts.groupBy("source", "salt", "outcome").agg(F.max_by("n", "batch").alias("n")).groupBy("source", "outcome").agg(F.sum("n").alias("n"))
