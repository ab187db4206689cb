"""Catalog statistics: preservation coverage, histograms, browse trees, counters, ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRESERVATION = ("bright", "dark", "shadows_only", "none")


def preservation_by(df: DataFrame, key: str, preservation: str = "preservation", kinds: tuple[str, ...] = PRESERVATION) -> DataFrame:
    """(key, one count per kind, total); rows without a key are left out, one shuffle on the key."""
    counts = [F.count_if(F.col(preservation) == k).alias(k) for k in kinds]
    known = F.col(preservation).isin(*kinds)
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*counts, F.count_if(known).alias("total"))


def fill_years(stats: DataFrame, key: str, kinds: tuple[str, ...] = PRESERVATION) -> DataFrame:
    """Missing years between the first and the last, with zeros. The spine comes from one row, so it is small."""
    ends = stats.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).where("lo IS NOT NULL")
    spine = ends.select(F.explode(F.sequence("lo", "hi")).alias(key))
    return spine.join(stats, key, "left").fillna(0, [*kinds, "total"])


def fill_days(stats: DataFrame, key: str, last: str, days: int, kinds: tuple[str, ...] = PRESERVATION) -> DataFrame:
    """The `days` days to `last`, dense."""
    spine = stats.sparkSession.range(1).select(F.explode(F.sequence(F.date_sub(F.lit(last).cast("date"), days - 1), F.lit(last).cast("date"))).alias(key))
    return spine.join(stats, key, "left").fillna(0, [*kinds, "total"])


def by_volume(df: DataFrame, volume: str, preservation: str = "preservation", kinds: tuple[str, ...] = PRESERVATION) -> DataFrame:
    """Digits-only volumes as numbers."""
    rows = df.where(F.col(volume).rlike("^[0-9]+$")).withColumn(volume, F.col(volume).try_cast("int"))
    return preservation_by(rows, volume, preservation, kinds)


def container_stats(df: DataFrame, key: str, type_col: str = "release_type", preservation: str = "preservation") -> DataFrame:
    """Totals, conditional counts and a histogram of types (missing: _unknown) per container, in two small shuffles.

    Shadow copies count as not preserved.
    """
    kind = F.when(F.col(preservation) == "shadows_only", "none").otherwise(F.col(preservation))
    by_type = df.groupBy(key, F.coalesce(type_col, F.lit("_unknown")).alias("t")).agg(F.count("*").alias("n"), *(F.count_if(kind == k).alias(k) for k in ("bright", "dark", "none")))
    hist = F.map_from_entries(F.array_sort(F.collect_list(F.struct("t", "n"))))
    return by_type.groupBy(key).agg(F.sum("n").alias("total"), *(F.sum(k).alias(k) for k in ("bright", "dark", "none")), hist.alias("release_type"))


def browse_tree(df: DataFrame, year: str, volume: str, issue: str) -> DataFrame:
    """One row a year: volumes, each with issues and counts, newest first; missing parts stay as NULL nodes.

    Counts are aggregated first, so lists hold distinct nodes, not rows.
    """
    leaves = df.groupBy(year, volume, issue).agg(F.count("*").alias("n"))
    order = lambda x: F.struct(x.isNotNull().alias("a"), x.rlike("^[0-9]+$").alias("b"), x.try_cast("long").alias("c"), x.alias("d"))
    node = F.struct(order(F.col(issue).cast("string")).alias("o"), F.col(issue).alias("issue"), "n")
    volumes = leaves.groupBy(year, volume).agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(node), asc=False).alias("issues"))
    volumes = volumes.withColumn("issues", F.transform("issues", lambda x: F.struct(x["issue"], x["n"])))
    node = F.struct(order(F.col(volume).cast("string")).alias("o"), F.col(volume).alias("volume"), "n", "issues")
    years = volumes.groupBy(year).agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(node), asc=False).alias("volumes"))
    return years.withColumn("volumes", F.transform("volumes", lambda x: F.struct(x["volume"], x["n"], x["issues"])))


def period_change(current: Column, previous: Column) -> Column:
    """Per cent, one decimal, NULL where there was nothing before."""
    return F.round((current - previous) * 100.0 / F.nullif(previous, F.lit(0)), 1)


def success_ratio(ok: Column, total: Column) -> Column:
    return F.coalesce(ok / F.nullif(total, F.lit(0)), F.lit(1.0))


def add_counters(df: DataFrame, keys: list[str], counters: list[str]) -> DataFrame:
    """Counters are a monoid: partial sums on each side of the shuffle."""
    return df.groupBy(*keys).agg(*(F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in counters))


def merge_counts(counts: DataFrame, new: DataFrame, keys: list[str], counter: str) -> DataFrame:
    """Stored counts with new rows counted in: keys that are known add up, others are inserted."""
    more = new.groupBy(*keys).agg(F.count("*").alias(counter))
    return counts.select(*keys, counter).unionByName(more).groupBy(*keys).agg(F.sum(counter).alias(counter))


def tally(df: DataFrame, column: str, name: str) -> DataFrame:
    """Counts of each value, the most frequent first."""
    return df.groupBy(F.col(column).alias(name)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), name)


def distinct_counts(df: DataFrame, key: str, columns: dict[str, Column]) -> DataFrame:
    return df.groupBy(key).agg(*(F.count_distinct(c).alias(k) for k, c in columns.items()))


def null_profile(df: DataFrame, key: str, columns: list[str], conditions: dict[str, Column]) -> DataFrame:
    """Rows of each key, how many lack each column, and how many meet each condition."""
    return df.groupBy(key).agg(F.count("*").alias("n"), *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns), *(F.count_if(c).alias(k) for k, c in conditions.items()))


def sum_of_kinds(counts: Column, kinds: tuple[str, ...]) -> Column:
    """Sum over some keys of a map of counts."""
    return F.aggregate(F.map_values(F.map_filter(counts, lambda k, _: k.isin(*kinds))), F.lit(0).cast("long"), lambda a, x: a + x)


def greatest_url(df: DataFrame, key: Column, url: str) -> DataFrame:
    """(digest, n, url): of each group the address that is last by text."""
    return df.groupBy(key.alias("digest")).agg(F.count("*").alias("n"), F.max(url).alias("url"))


def rollup_counts(df: DataFrame, *keys: Column) -> DataFrame:
    """Counts by all keys, by fewer from the right, and in all."""
    return df.rollup(*keys).agg(F.count("*").alias("n"))


def hit_stats(df: DataFrame, host: str, hit: str, direct: str, least: int) -> DataFrame:
    """Hits, misses and rates of hosts with at least `least` rows."""
    out = df.groupBy(host).agg(F.count("*").alias("total"), F.count_if(hit).alias("hits"), F.count_if(F.expr(f"{hit} AND {direct}")).alias("direct"))
    out = out.where(F.col("total") >= least).withColumn("misses", F.col("total") - F.col("hits"))
    return out.withColumn("hit_rate", F.round(F.col("hits") / F.col("total"), 4)).withColumn("direct_rate", F.round(F.col("direct") / F.nullif("hits", F.lit(0)), 4))


def fixed_buckets(df: DataFrame, ts: str, value: str, start: str, seconds: int) -> DataFrame:
    """Mean by fixed buckets from `start`; empty buckets do not appear."""
    bucket = F.floor((F.unix_timestamp(ts) - F.unix_timestamp(F.lit(start).cast("timestamp"))) / seconds)
    return df.where(F.col(ts) >= F.lit(start).cast("timestamp")).groupBy(bucket.alias("bucket")).agg(F.round(F.avg(value), 4).alias("mean"), F.count("*").alias("n"))


def series_change(df: DataFrame, ts: str, values: list[str]) -> DataFrame:
    """Difference and relative change of each metric to the row before. The series is one row a period, so one window suffices."""
    w = Window.orderBy(ts)
    for v in values:
        before = F.lag(v).over(w)
        df = df.withColumn(f"{v}_diff", F.col(v) - before).withColumn(f"{v}_pct", F.round((F.col(v) - before) / F.nullif(before, F.lit(0)), 4))
    return df


def change_label(current: Column, previous: Column) -> Column:
    """'?' without a period before, infinity from nothing, else whole per cent cut towards zero."""
    pct = ((current - previous) * 100 / F.nullif(previous, F.lit(0))).cast("int").cast("string")
    return F.when(previous.isNull(), "?").when((previous == 0) & (current == 0), "0").when(previous == 0, "∞").otherwise(pct)


def islands(df: DataFrame, key: str, value: str) -> DataFrame:
    """Runs of consecutive integers per key: (key, first, last, size)."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(value))
    runs = df.select(key, value).where(F.col(value).isNotNull()).distinct().withColumn("island", F.col(value) - rank)
    return runs.groupBy(key, "island").agg(F.min(value).alias("first"), F.max(value).alias("last"), F.count("*").alias("size")).drop("island")


def contiguous(df: DataFrame, key: str, value: str) -> DataFrame:
    agg = df.groupBy(key).agg(F.min(value).alias("first"), F.max(value).alias("last"), F.count_distinct(value).alias("distinct_values"))
    return agg.withColumn("contiguous", F.col("last") - F.col("first") + 1 == F.col("distinct_values"))


def day_sketches(df: DataFrame, key: str, day: Column, value: str, precision: int = 12) -> DataFrame:
    """(key, day, sketch): mergeable sketches of the distinct values of each key and day, to be stored and added to day by day."""
    return df.groupBy(key, day.alias("day")).agg(F.hll_sketch_agg(F.col(value), F.lit(precision)).alias("sketch"))


def span_distinct(sketches: DataFrame, key: str, begin: str, end: str) -> DataFrame:
    """(key, about): distinct values of the days [begin, end), from sketches alone; the relative error has a deviation of about 1.04 / sqrt(2**precision)."""
    some = sketches.where((F.col("day") >= F.lit(begin).cast("date")) & (F.col("day") < F.lit(end).cast("date")))
    return some.groupBy(key).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("about"))
