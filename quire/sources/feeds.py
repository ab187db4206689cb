"""Day-sliced feeds that harvesters leave as files: one path for each day."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def days(begin: str, end: str) -> list[str]:
    """Days of [begin, end)."""
    a, b = date.fromisoformat(begin), date.fromisoformat(end)
    return [str(a + timedelta(days=i)) for i in range((b - a).days)]


def window(today: str, back: int = 1) -> tuple[str, str]:
    """The default window of a daily run: the day before, or `back` days before."""
    t = date.fromisoformat(today)
    return str(t - timedelta(days=back)), str(t - timedelta(days=back - 1))


def listed(files: DataFrame, name: str, begin: str, end: str, suffix: str = ".gz") -> DataFrame:
    """Files (name, modified) of a listing that are of the suffix and changed in [begin, end)."""
    t = F.col("modified")
    return files.where(F.endswith(name, F.lit(suffix)) & (t >= F.lit(begin).cast("timestamp")) & (t < F.lit(end).cast("timestamp")))


def daily(spark: SparkSession, template: str, begin: str, end: str, schema: str) -> DataFrame:
    """JSON lines of the days' files, `{day}` in the template; days without a file give nothing, and `day` says where a row is from."""
    wanted = days(begin, end)
    path = template.replace("{day}", "{" + ",".join(wanted) + "}")
    head, tail = template.split("{day}")
    rows = spark.read.schema(schema).json(path)
    return rows.withColumn("day", F.to_date(F.regexp_extract(F.input_file_name(), r"(\d{4}-\d{2}-\d{2})[^/]*" if not tail.count("/") else r"(\d{4}-\d{2}-\d{2})", 1)))
