"""Named queries over things that arrive bit by bit: sliced feeds, growing files, counts over runs, archives read in parts, sitemaps read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import sinks
from quire.plans.catalog import query, rd
from quire.plans.upstream import TEXT, place
from quire.sources import readers, slices, stores
from quire.streaming import growing, ingest

WORKS = """w AS (SELECT doc_id, 'https://x.org/work/w' || doc_id AS own FROM documents), u AS (SELECT 'works' AS kind, own AS url FROM w
  UNION ALL SELECT 'access', own || '/access/wayback/http://x/' || doc_id FROM w WHERE doc_id % 4 = 0 UNION ALL SELECT 'access', own || '/access/ia_file/item' || doc_id || '/f.pdf' FROM w WHERE doc_id % 4 = 1)"""


@query(f"""WITH {WORKS}, s AS (SELECT kind, url, (row_number() OVER (PARTITION BY kind ORDER BY url) - 1) // 100 AS shard FROM u)
SELECT kind, CAST(shard AS INT) AS shard, count(*) AS n, min(url) AS first, max(url) AS last, 1 AS listed FROM s GROUP BY 1, 2""")
def sitemap_files(spark, sf):
    """Sitemap files of two kinds, written and read back, and whether the index lists each."""
    n, k = F.col("doc_id").cast("string"), F.col("doc_id") % 4
    to = F.when(k == 0, TEXT("https://web.archive.org/web/20190102030405/http://x/", n)).when(k == 1, TEXT("http://archive.org/download/item", n, "/f.pdf")).when(k == 2, TEXT("https://web.archive.org/web/201901020304/http://x/", n)).otherwise("")
    works = rd(spark, sf, "documents").select(TEXT("w", n).alias("ident"), F.when(k == 1, "ia_file").otherwise("wayback").alias("access_type"), to.alias("access_url"))
    path = place(spark, "sitemap")
    sinks.write_sitemap(sinks.sitemap_lines(works, "https://x.org"), path, "https://x.org", "2026-01-01", 100)
    files = spark.read.text(f"{path}/urls").groupBy("kind", F.col("shard").cast("int").alias("shard")).agg(F.count("*").alias("n"), F.min("value").alias("first"), F.max("value").alias("last"))
    index = spark.read.text(f"{path}/index").select("kind", F.regexp_extract("value", r"<loc>https://x\.org/urls/kind=\w+/shard=(\d{5})</loc>", 1).alias("shard")).where("shard <> ''")
    return files.join(index.select("kind", F.col("shard").cast("int").alias("shard"), F.lit(1).alias("listed")), ["kind", "shard"], "left")


@query("""WITH o AS (SELECT o_orderkey AS k, o_orderpriority AS p, CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS day FROM orders)
SELECT day, p, count(*) AS n, CAST(sum(k) AS BIGINT) AS keys FROM o GROUP BY 1, 2""")
def feed_slices(spark, sf):
    """Orders as a feed captured in monthly slices of pages, read by cursor, one partition a slice."""
    o = rd(spark, sf, "orders").select(F.trunc("o_orderdate", "month").alias("day"), F.to_json(F.struct(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("p"))).alias("value"))
    path = place(spark, "feed")
    slices.capture(o, path)
    begin, end = o.agg(F.min("day").cast("string"), F.add_months(F.max("day"), 1).cast("string")).first()
    return slices.sliced(spark, path, begin, end, "k long, p string", step="month").groupBy("day", "p").agg(F.count("*").alias("n"), F.sum("k").alias("keys"))


def _written(rows, path: str, cut: bool):
    """A task's lines as a file of its own; cut: only those before the first with `stop`, and half of that one."""

    def run(batches):
        from pyspark import TaskContext

        store, at = stores.opened(f"{path}/part-{TaskContext.get().partitionId():05d}.jsonl")
        store.create_dir(at.rpartition("/")[0], recursive=True)
        lines = ((v.encode(), s) for b in batches for v, s in zip(b.column("value").to_pylist(), b.column("stop").to_pylist(), strict=True))
        with store.open_output_stream(at, compression=None) as f:
            for line, stop in lines:
                if cut and stop:
                    f.write(line[: len(line) // 2])
                    break
                f.write(line + b"\n")
        yield from ()

    return rows.mapInArrow(run, "n long").count()


FILE = 100_000  # lines of a growing file


@query("SELECT o_orderkey, o_orderpriority FROM orders")
def growing_files(spark, sf):
    """Orders as lines of files that have grown between two runs, with a line half written at first: each line once."""
    source, table, state = (place(spark, x) for x in ("growing", "grown", "state"))
    o = rd(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.to_json(F.struct("o_orderkey", "o_orderpriority")).alias("value"), (F.col("o_orderkey") % 97 == 0).alias("stop"))
    total = o.count()
    n = max(4, -(-total // FILE))
    lines = sinks.written(o.repartitionByRange(n, "k").sortWithinPartitions("k").withColumn("part", F.spark_partition_id()), "lines").repartitionById(n, "part").sortWithinPartitions("part", "k")
    growing.register(spark)
    for cut in (True, False):
        _written(lines, source, cut)
        stream = spark.readStream.format("quire_growing").option("range", max(1 << 16, 16 * total // n)).load(source)  # some ranges a file
        ingest.appended(stream, table, state).awaitTermination()
    return spark.read.parquet(table).select(F.from_json("value", "o_orderkey long, o_orderpriority string").alias("x")).select("x.*")


@query("SELECT event_type AS source, CASE WHEN event_id % 7 = 0 THEN 'skipped' ELSE 'done' END AS outcome, count(*) AS n FROM events GROUP BY 1, 2")
def carried_counts(spark, sf):
    """Outcomes of events counted by a stream in three runs, the last without new files."""
    source, table, state = (place(spark, x) for x in ("counted", "counts", "state"))
    e = rd(spark, sf, "events").select("event_id", "event_type", F.when(F.col("event_id") % 7 == 0, "skipped").otherwise("done").alias("outcome"))
    for part in (F.col("event_id") % 3 == 0, F.col("event_id") % 3 != 0, F.lit(False)):
        e.where(part).coalesce(2).write.mode("append").json(source)
        ingest.tallied(ingest.records(spark, source, "event_id long, event_type string, outcome string"), "event_type", "outcome", table, state).awaitTermination()
    return ingest.tallies(spark, table)


ARCHIVE = 32 << 20  # bytes of pages in a file of an archive


@query("""SELECT page_id % 2 AS archive, count(*) AS records, CAST(sum(octet_length(encode(html))) AS BIGINT) AS bytes, 1 AS same, count(DISTINCT url) AS urls FROM pages WHERE html IS NOT NULL GROUP BY 1""")
def archives_in_parts(spark, sf):
    """Two archives of a gzip member a page, in files of about ARCHIVE bytes, indexed once and read in small shares, against each file read in one share."""
    crlf = "\r\n"
    http = TEXT("HTTP/1.1 200 OK", crlf, "Content-Type: text/html", crlf, crlf, F.col("html"))
    record = TEXT("WARC/1.0", crlf, "WARC-Type: response", crlf, "WARC-Target-URI: ", F.col("url"), crlf, "Content-Length: ", F.octet_length(http).cast("string"), crlf, crlf, http, crlf, crlf)
    path = place(spark, "archives")

    def run(batches):
        import gzip

        files: dict = {}
        for b in batches:
            for k, part, text in zip(*(b.column(c).to_pylist() for c in ("archive", "part", "value")), strict=True):
                if (k, part) not in files:
                    store, at = stores.opened(f"{path}/{k}-{part}.warc.gz")
                    store.create_dir(at.rpartition("/")[0], recursive=True)
                    files[k, part] = store.open_output_stream(at, compression=None)
                files[k, part].write(gzip.compress(text.encode(), 1))
        for f in files.values():
            f.close()
        yield from ()

    pages = rd(spark, sf, "pages").where("html IS NOT NULL")
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    n = -(-total // (2 * ARCHIVE)) or 1
    rows = pages.select((F.col("page_id") % 2).alias("archive"), F.pmod(F.xxhash64("page_id"), F.lit(n)).alias("part"), record.alias("value"))
    rows.repartitionById(2 * n, (F.col("archive") * n + F.col("part")).cast("int")).mapInArrow(run, "n long").count()
    index = sinks.written(readers.warc_index(spark, path), "index")

    def read(share: int):
        return readers.warc_records(spark, path, readers.response, readers.WARC, share=share, index=index).select(F.regexp_extract("warc", r"(\d+)-\d+\.warc\.gz$", 1).cast("long").alias("archive"), "target_uri", "sha1", F.octet_length("payload").alias("n"))

    of = lambda share, x: read(share).groupBy("archive").agg(F.count("*").alias(f"n{x}"), F.sum(F.xxhash64("target_uri", "sha1") % 1000003).alias(f"h{x}"), F.sum("n").cast("long").alias(f"b{x}"), F.countDistinct("target_uri").alias(f"u{x}"))
    both = of(max(1 << 15, total // n // 128), 1).join(of(1 << 40, 2), "archive")
    same = (F.col("n1") == F.col("n2")) & (F.col("h1") == F.col("h2"))
    return both.select("archive", F.col("n1").alias("records"), F.col("b1").alias("bytes"), same.cast("int").alias("same"), F.col("u1").alias("urls"))
