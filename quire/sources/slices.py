"""Captured feeds as a data source: one input partition for each slice of days, with the cursor's pages read in order inside it.

A harvest leaves the pages of a slice in a folder named by its first day: the first page under the name of the first cursor, the next
under the cursor that the page before names.  Each page is a JSON document with items and the next cursor.

    feeds.register(spark)
    spark.read.format("quire_slices").option("begin", "2024-01-01").option("end", "2024-02-01").load("s3://bucket/feed").where("day = date'2024-01-03'")

Filters on `day` choose partitions, so other slices are not opened.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from quire.sources import stores

BATCH = 1000


def starts(begin: date, end: date, step: str) -> list[date]:
    """First days of the slices that meet [begin, end): single days, weeks from Monday, or months; the first may begin before `begin`."""
    day = {"day": begin, "week": begin - timedelta(days=begin.weekday()), "month": begin.replace(day=1)}[step]
    found = []
    while day < end:
        found.append(day)
        day = (day.replace(day=1) + timedelta(days=32)).replace(day=1) if step == "month" else day + timedelta(days=7 if step == "week" else 1)
    return found


class Slice(InputPartition):
    def __init__(self, day: date):
        super().__init__(day)


class SliceReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.first = options["path"].rstrip("/"), options.get("first", "*")
        self.items, self.next = options.get("items", "items").split("."), options.get("next", "next").split(".")
        self.days = starts(date.fromisoformat(options["begin"]), date.fromisoformat(options["end"]), options.get("step", "day"))

    def pushFilters(self, filters):  # noqa: N802
        """Conditions on `day` thin the slices; all others go back to Spark."""
        tests = {
            EqualTo: lambda d, v: d == v, EqualNullSafe: lambda d, v: d == v, In: lambda d, v: d in v, GreaterThan: lambda d, v: d > v,
            GreaterThanOrEqual: lambda d, v: d >= v, LessThan: lambda d, v: d < v, LessThanOrEqual: lambda d, v: d <= v,
        }
        for f in filters:
            if type(f) in tests and f.attribute == ("day",) and f.value is not None:
                self.days = [d for d in self.days if tests[type(f)](d, f.value)]
            else:
                yield f

    def partitions(self) -> list[Slice]:
        return [Slice(d) for d in self.days] or [Slice(None)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        cursor, page, seen = self.first, 0, set()
        day, rows = partition.value, []
        while day is not None and cursor is not None:
            body = stores.content(f"{self.path}/{day}/{named(cursor)}")
            if body is None:
                if page == 0:
                    return  # nothing was harvested
                raise FileNotFoundError(f"{self.path}/{day}: page {page}, of cursor {cursor}, is missing")
            seen.add(cursor)
            found = json.loads(body)
            for place, item in enumerate(_under(found, self.items) or []):
                rows.append((day, page, place, json.dumps(item, ensure_ascii=False, separators=(",", ":"))))
                if len(rows) == BATCH:
                    yield _batch(rows)
                    rows = []
            cursor, page = _under(found, self.next), page + 1
            if cursor in seen:  # a feed that has come to its end names the same cursor again
                break
        if rows:
            yield _batch(rows)


def named(cursor: str) -> str:
    """The file that holds a cursor's page."""
    return "".join(c if c.isalnum() or c in "-_" else f"%{ord(c):02x}" for c in cursor) + ".json"


def _under(value, keys: list[str]):
    for k in keys:
        value = value.get(k) if isinstance(value, dict) else None
    return value


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    days, pages, places, values = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(days, pa.date32()), pa.array(pages, pa.int32()), pa.array(places, pa.int32()), pa.array(values, pa.string())], ["day", "page", "place", "value"])


class SliceSource(DataSource):
    """Options: begin and end (days, end exclusive), step (day, week, month), first (cursor), items and next (dotted names in a page)."""

    @classmethod
    def name(cls) -> str:
        return "quire_slices"

    def schema(self) -> str:
        return "day date, page int, place int, value string"

    def reader(self, schema) -> SliceReader:
        return SliceReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SliceSource)


def sliced(spark: SparkSession, path: str, begin: str, end: str, schema: str, step: str = "day", **names: str) -> DataFrame:
    """Items of captured pages, parsed, with `day`, `page` and `place`; a filter on `day` opens its slices only."""
    register(spark)
    raw = spark.read.format("quire_slices").options(begin=begin, end=end, step=step, **names).load(path)
    return raw.select("day", "page", "place", F.from_json("value", schema).alias("x")).select("day", "page", "place", "x.*")


def capture(items: DataFrame, path: str, size: int = 100) -> int:
    """Writes items (day, value: JSON) as pages of `size` with cursors between them, as a harvest leaves them; returns the number of pages.

    Pages are numbered within their day in order of the value.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("day").orderBy("value")
    pages = items.withColumn("n", F.row_number().over(w) - 1).withColumn("page", F.floor(F.col("n") / size))
    pages = pages.groupBy("day", "page").agg(F.array_sort(F.collect_list(F.struct("n", "value"))).alias("items"), F.max("n").alias("last"))
    ends = items.groupBy("day").agg(F.count("*").alias("total"))
    pages = pages.join(ends, "day").select("day", "page", F.transform("items", lambda x: x["value"]).alias("items"), (F.col("last") + 1 < F.col("total")).alias("more"))

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                after = f"p{r['page'] + 1}" if r["more"] else None
                body = f'{{"items":[{",".join(r["items"])}],"next":{json.dumps(after)}}}'
                stores.put(f"{path}/{r['day']}/{named('*' if r['page'] == 0 else 'p%d' % r['page'])}", body.encode())
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    return pages.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
