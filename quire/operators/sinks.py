"""Writers: JSON lines, tables, sitemaps, idempotent slices."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import text
from quire.functions.identifiers import blob_path
from quire.operators.relational import insert_ignore


def write_json(df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "none") -> None:
    df.write.mode(mode).json(path, compression=compression)


def write_slice(df: DataFrame, path: str) -> None:
    """A slice that is there stays: repeated runs are harmless."""
    df.write.mode("ignore").json(path)


def write_index(documents: DataFrame, path: str, id_col: str) -> None:
    """Documents as a table that look-ups by id read little of: in ranges of the id, replaced whole."""
    documents.repartitionByRange(F.col(id_col)).sortWithinPartitions(id_col).write.mode("overwrite").parquet(path)


def indexed(spark: SparkSession, path: str, asked: DataFrame, id_col: str) -> DataFrame:
    """(id, indexed) of the ids asked for."""
    there = spark.read.parquet(path).select(id_col).withColumn("indexed", F.lit(True))
    return asked.select(id_col).distinct().join(there, id_col, "left").select(id_col, F.coalesce("indexed", F.lit(False)).alias("indexed"))


def url_digests(known: DataFrame, pages: DataFrame) -> DataFrame:
    """(url, sha1, ts) with the pages (url, payload, ts) added whose address and content are new together."""
    new = pages.select("url", F.sha1("payload").alias("sha1"), "ts")
    return insert_ignore(known.select("url", "sha1", "ts"), new, ["url", "sha1"])


def extracted(records: DataFrame, extension: str) -> DataFrame:
    """(path, payload) of distinct contents, named by digest, in folders by its first characters."""
    digest = F.sha1("payload")
    return records.where(F.octet_length("payload") > 0).select(F.concat(blob_path(digest), F.lit(extension)).alias("path"), "payload").dropDuplicates(["path"])


def write_tsv(df: DataFrame, path: str, blob: str | None = None) -> None:
    """Line breaks and tabs in values become spaces; a column of bytes is written in base 64."""
    if blob:
        df = df.withColumn(blob, F.base64(blob))
    cols = [text.one_line(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in df.columns]
    df.select(*cols).write.mode("overwrite").csv(path, sep="\t", header=True, quote="")


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; in local mode one of its own where that is unset."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.conf.set("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="quire-shared-"))
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    return spark.conf.get("spark.checkpoint.dir").rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """A table of its own in the shared folder, read again: later steps see one and the same rows, and read the columns they need."""
    path = f"{shared_folder(df.sparkSession)}/quire-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


IN_PART = (1 << 33) - 1  # monotonically_increasing_id has the partition above these bits, and the place in it below


def numbered(df: DataFrame, *order: str, name: str = "n") -> DataFrame:
    """All rows numbered from 0 in order, without sorting them in one task.

    Rows are dealt into ranges and stored with their place in them once; counts and numbers both come from what is stored,
    since ranges are sampled anew each time they are made.  Equal rows of the order take any order.
    """
    ranges = df.repartitionByRange(*map(F.col, order)).sortWithinPartitions(*order)
    parts = written(ranges.withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__at", 33)
    ends = parts.groupBy(part.alias("__p")).agg(F.count("*").alias("__n"))
    before = ends.select("__p", F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__b"))  # one row a partition
    joined = parts.join(F.broadcast(before), part == F.col("__p"))
    return joined.withColumn(name, F.col("__b") + F.col("__at").bitwiseAND(F.lit(IN_PART))).drop("__p", "__b", "__at")


def sharded(df: DataFrame, order: str, size: int, name: str = "shard") -> DataFrame:
    """Consecutive shards of `size` rows by the order column."""
    return numbered(df, order, name=name).withColumn(name, F.floor(F.col(name) / size))


def write_records(df: DataFrame, column: str, path: str, separator: str = "\x1e") -> None:
    """Records that may have line breaks, with a separator behind each."""
    df.select(F.col(column).alias("value")).where("value IS NOT NULL").write.option("lineSep", separator).text(path)


def sitemap_works(documents: DataFrame, this_year: int) -> DataFrame:
    """Works that sitemaps list: with an archived full text, not of another archive's own, and of large publishers only what is open or in the public domain (published 96 years ago or before); links with short timestamps are left out."""
    open_ = (F.coalesce("publisher_type", F.lit("")) != "big5") | (F.col("release_year") <= this_year - 96) | F.array_contains(F.coalesce("tags", F.array().cast("array<string>")), "oa")
    kept = documents.where((F.col("doc_type") == "work") & F.col("access_type").isin("ia_file", "wayback") & F.col("arxiv_id").isNull() & F.col("pmcid").isNull() & F.coalesce(open_, F.lit(False)))
    return kept.where(~F.coalesce(F.col("access_url").rlike(r"web\.archive\.org/web/\d{12}/"), F.lit(False)))


def sitemap_lines(works: DataFrame, base: str) -> DataFrame:
    """(kind, url): a work's own page under `works`, and under `access` its way to the archived full text, where its address has one."""
    url = F.regexp_replace
    wayback, item = r"^https?://web\.archive\.org/web/\d{14}/(.+)$", r"^https?://archive\.org/download/([^/]+)/(.+)$"
    own, to = F.concat(F.lit(f"{base}/work/"), "ident"), F.col("access_url")
    way = F.when((F.col("access_type") == "wayback") & to.rlike(wayback), F.concat(own, F.lit("/access/wayback/"), url(to, wayback, "$1")))
    way = way.when((F.col("access_type") == "ia_file") & to.rlike(item), F.concat(own, F.lit("/access/ia_file/"), url(to, item, "$1/$2")))
    named = works.where(F.coalesce("ident", F.lit("")) != "")
    return named.select(F.explode(F.array(F.struct(F.lit("works").alias("kind"), own.alias("url")), F.struct(F.lit("access").alias("kind"), way.alias("url")))).alias("x")).select("x.*").where("url IS NOT NULL")


def write_sitemap(urls: DataFrame, path: str, base: str, day: str, size: int = 20000) -> None:
    """Text files of at most `size` addresses a kind, one address a line in order, and for each kind an index with the day.

    urls: (kind, url).  Each file is a folder of one part, as Spark writes it.
    """
    rows = numbered(urls.select("kind", "url"), "kind", "url")
    first = rows.groupBy("kind").agg(F.min("n").alias("first"))  # one row a kind
    rows = rows.join(F.broadcast(first), "kind").withColumn("shard", F.floor((F.col("n") - F.col("first")) / size))
    parts = rows.repartition("kind", "shard").sortWithinPartitions("kind", "shard", "n")
    parts.select(F.col("url").alias("value"), "kind", F.format_string("%05d", "shard").alias("shard")).write.mode("overwrite").partitionBy("kind", "shard").text(f"{path}/urls")
    head = ['<?xml version="1.0" encoding="UTF-8"?>', '<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">']
    entry = lambda n: F.array(F.lit("  <sitemap>"), F.format_string(f"    <loc>{base}/urls/kind=%s/shard=%05d</loc>", "kind", n), F.lit(f"    <lastmod>{day}</lastmod>"), F.lit("  </sitemap>"))
    ends = rows.groupBy("kind").agg(F.max("shard").alias("last"))
    middle = ends.select("kind", F.posexplode(F.sequence(F.lit(0).cast("long"), "last")).alias("pos", "n")).select("kind", (F.col("pos") + 1).alias("k"), entry(F.col("n")).alias("lines"))
    fixed = lambda k, lines: ends.select("kind", F.lit(k).alias("k"), F.array(*map(F.lit, lines)).alias("lines"))
    lines = fixed(0, head).unionByName(middle).unionByName(fixed(1 << 30, ["</sitemapindex>"])).select("kind", "k", F.posexplode("lines").alias("i", "value"))
    lines.repartition("kind").sortWithinPartitions("kind", "k", "i").select("value", "kind").write.mode("overwrite").partitionBy("kind").text(f"{path}/index")
