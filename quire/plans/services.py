"""Named queries over catalog services: look-ups, children, replacement, results pages, relevance, sitemaps, captures, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import identifiers as ids, text
from quire.operators import buckets, convert, documents, entities, holdings, relational as rel, search, sinks, webarchive
from quire.plans.catalog import query, rd, release
from quire.plans.upstream import TEXT, place
from quire.sources import feeds, readers


@query("""WITH f AS (SELECT doc_id, sha1(text) AS s, md5(text) AS m FROM documents)
SELECT DISTINCT CASE doc_id % 5 WHEN 0 THEN 'sha1' WHEN 1 THEN 'md5' WHEN 2 THEN 'sha512' ELSE 'sha256' END AS id_type, CASE doc_id % 5 WHEN 0 THEN upper(s) WHEN 1 THEN m ELSE 'x' || doc_id END AS id_value,
  CASE doc_id % 5 WHEN 0 THEN (SELECT min(CAST(d.doc_id AS VARCHAR)) FROM f d WHERE d.s = f.s) WHEN 1 THEN (SELECT min(CAST(d.doc_id AS VARCHAR)) FROM f d WHERE d.m = f.m) END AS id, CASE WHEN doc_id % 5 < 2 THEN 'found' WHEN doc_id % 5 = 2 THEN 'unsupported' ELSE 'not-found' END AS status FROM f WHERE doc_id % 7 = 0 AND s IS NOT NULL""")
def file_lookup(spark, sf):
    d, n = rd(spark, sf, "documents").where("text IS NOT NULL"), F.col("doc_id").cast("string")
    table = d.select(n.alias("id"), F.sha1(F.col("text").cast("binary")).alias("sha1"), F.sha2("text", 256).alias("sha256"), F.md5("text").alias("md5"))
    k = F.col("doc_id") % 5
    asked = d.where("doc_id % 7 = 0").select(F.when(k == 0, "sha1").when(k == 1, "md5").when(k == 2, "sha512").otherwise("sha256").alias("id_type"), F.when(k == 0, F.upper(F.sha1(F.col("text").cast("binary")))).when(k == 1, F.md5("text")).otherwise(TEXT("x", n)).alias("id_value"))
    return entities.lookup(asked, table, "file")


@query("SELECT DISTINCT l_orderkey, l_partkey, p_name FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_orderkey % 32 = 0")
def child_listing(spark, sf):
    parents = rd(spark, sf, "orders").where("o_orderkey % 32 = 0").select(F.col("o_orderkey").alias("l_orderkey"))
    table = rd(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return entities.children(parents, rd(spark, sf, "lineitem"), table, "l_orderkey", "l_partkey").select("l_orderkey", "l_partkey", "p_name")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'invalid' WHEN o_orderkey % 2 = 0 THEN 'exists' ELSE 'created' END AS outcome FROM orders WHERE o_orderkey % 3 = 0""")
def bulk_create_outcomes(spark, sf):
    o = rd(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("price"))
    return entities.bulk_create(o.where("o_orderkey % 2 = 0"), o.where("o_orderkey % 3 = 0"), ["o_orderkey"], F.col("price").isNotNull())[1]


@query("""SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem WHERE l_orderkey % 3 <> 0 UNION ALL SELECT o_orderkey, 7, 1 FROM orders WHERE o_orderkey % 3 = 0""")
def replaced_children(spark, sf):
    o = rd(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    li = rd(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    new = o.where("l_orderkey % 3 = 0")
    kids = o.select("l_orderkey", F.lit(7).cast("long").alias("l_partkey"), F.lit(1).cast("long").alias("l_linenumber"))  # those of other parents are refused
    return entities.replace_with_children(o, li, new, kids, "l_orderkey")[1]


@query("""SELECT 'w' || doc_id AS work_ident, CASE WHEN doc_id % 4 = 0 THEN '(untitled)' ELSE 'T' || doc_id END AS title, 2000 + CAST(doc_id % 20 AS INT) AS release_year, CASE WHEN doc_id % 3 = 0 THEN 'doi:10.1/' || doc_id || ' ' ELSE '' END || 'arxiv:2001.1' AS ext_ids, CASE WHEN doc_id % 2 = 0 THEN '2019' ELSE '' END AS capture_year,
  CASE WHEN doc_id % 2 = 0 THEN '/work/w' || doc_id || '/access/wayback/http://x/' || doc_id ELSE 'https://x.org/' END AS access_url, 'wayback' AS access_type, CASE WHEN n_chars >= 1000 THEN (n_chars // 1000) || ' kB' ELSE '' END AS access_size FROM documents WHERE n_chars < 1000000""")
def results_page(spark, sf):
    d, n, k = rd(spark, sf, "documents").where("n_chars < 1000000"), F.col("doc_id").cast("string"), F.col("doc_id")
    hits = d.select(
        TEXT("w", n).alias("work_ident"), F.when(k % 4 != 0, TEXT("T", n)).alias("title"), (2000 + k % 20).cast("int").alias("release_year"), F.when(k % 3 == 0, TEXT("10.1/", n)).otherwise("").alias("doi"), F.lit("2001.1").alias("arxiv_id"),
        F.when(k % 2 == 0, TEXT("https://web.archive.org/web/20190102030405/http://x/", n)).otherwise("https://x.org/").alias("access_url"), F.lit("wayback").alias("access_type"), F.col("n_chars").alias("size_bytes"),
    )
    return documents.result_rows(hits).withColumn("ext_ids", F.array_join("ext_ids", " "))


@query("""WITH w AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{Nd}]+'), lambda x: x <> '') AS w FROM documents), t AS (SELECT doc_id, len(w) AS n, len(list_filter(w, lambda x: x = 'the')) AS a, len(list_filter(w, lambda x: x = 'und')) AS b FROM w),
s AS (SELECT count(*) AS rows, avg(n) AS mean, count(*) FILTER (a > 0) AS da, count(*) FILTER (b > 0) AS db FROM t)
SELECT doc_id, round(ln(1 + (rows - da + 0.5) / (da + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * n / mean)) + ln(1 + (rows - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * n / mean)), 6) AS score FROM t, s WHERE a + b > 0""")
def relevance(spark, sf):
    d = search.bm25(rd(spark, sf, "documents").select("doc_id", "text"), ["the", "und"], {"text": 1.0})
    return d.where("score > 0").select("doc_id", F.round("score", 6).alias("score"))


@query("SELECT CASE WHEN n < 20 THEN n ELSE least(n, 1000) END AS total, n >= 20 AND n > 1000 AS estimated FROM (SELECT count(*) AS n FROM supplier WHERE s_suppkey <= 13)")
def first_page_total(spark, sf):
    shown = rd(spark, sf, "supplier").where("s_suppkey <= 13").limit(20).agg(F.count("*").alias("n"))
    return shown.select(search.shown_total(F.lit(1000).cast("long"), F.lit(True), F.col("n"), 0, 20).alias("t")).select("t.total", "t.estimated")


@query("""SELECT o_orderkey FROM orders WHERE o_custkey % 3 < 2 AND o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AND (o_orderpriority <> '1-URGENT' OR year(o_orderdate) <= 1995 OR o_orderkey % 2 = 0) AND NOT (o_custkey % 3 = 0 AND o_orderkey % 4 = 3)""")
def sitemap_filter(spark, sf):
    k, c, n = F.col("o_orderkey"), F.col("o_custkey") % 3, F.col("o_orderkey").cast("string")
    url = F.when(c == 0, F.when(k % 4 == 3, TEXT("https://web.archive.org/web/202001010000/", n)).otherwise(TEXT("https://web.archive.org/web/20200101000000/", n)))
    d = rd(spark, sf, "orders").select(
        "o_orderkey", F.lit("work").alias("doc_type"), F.when(c == 0, "wayback").when(c == 1, "ia_file").otherwise("publisher").alias("access_type"), F.when(k % 11 == 0, n).alias("arxiv_id"), F.when(k % 13 == 0, n).alias("pmcid"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "big5").alias("publisher_type"), F.year("o_orderdate").alias("release_year"), F.when(k % 2 == 0, F.array(F.lit("oa"))).alias("tags"), url.alias("access_url"),
    )
    return sinks.sitemap_works(d, 1995 + 96).select("o_orderkey")


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Ada B. Li' WHEN 1 THEN 'University, Open' WHEN 2 THEN 'Li, Ada, Jr' WHEN 3 THEN 'Li (Ada), B' ELSE 'Order ' || o_orderkey END AS name FROM orders""")
def display_names(spark, sf):
    k = F.col("o_orderkey") % 5
    raw = F.when(k == 0, "Li,  Ada B. ").when(k == 1, "University, Open").when(k == 2, "Li, Ada, Jr").when(k == 3, "Li (Ada), B").otherwise(TEXT("Order ", F.col("o_orderkey").cast("string")))
    return rd(spark, sf, "orders").select("o_orderkey", text.index_to_display(raw).alias("name"))


@query("""SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN date_trunc('second', ts) END AS ts, CASE WHEN event_id % 4 <> 0 THEN CAST(event_id AS VARCHAR) END AS id FROM events""")
def cursor_parse(spark, sf):
    """Cursors as they are encoded, some of them spoilt, read again."""
    e = rd(spark, sf, "events")
    raw = F.when(F.col("event_id") % 4 == 0, F.when(F.col("event_id") % 8 == 0, "no cursor").otherwise("2024-01-01T00:00:00")).otherwise(rel.cursor(F.col("ts"), F.col("event_id")))
    return e.select("event_id", rel.parse_cursor(raw).alias("c")).select("event_id", "c.ts", "c.id")


@query("""SELECT page_id, CASE page_id % 6 WHEN 3 THEN '<meta charset="iso-8859-1">ä €' WHEN 4 THEN 'ß ü' ELSE html END AS html FROM pages""")
def decoded_pages(spark, sf):
    """Pages in several encodings: named by a header, by a mark, by themselves, or not at all."""
    k = F.col("page_id") % 6
    head = F.when(k == 0, "text/html; charset=utf-16le").when(k == 1, "text/html; charset=no-such-set").when(k == 5, "text/html; charset=iso-8859-1")
    mark = F.unhex(F.lit("fffe"))
    own = F.unhex(F.concat(F.hex(F.encode(F.lit('<meta charset="iso-8859-1">'), "UTF-8")), F.lit("E42080")))
    body = F.when(k == 0, F.encode("html", "UTF-16LE")).when(k == 2, F.concat(mark, F.encode("html", "UTF-16LE"))).when(k == 3, own).when(k == 4, F.unhex(F.lit("DF20FC"))).when(k == 5, F.concat(F.unhex(F.lit("efbbbf")), F.encode("html", "UTF-8"))).otherwise(F.encode("html", "UTF-8"))
    return rd(spark, sf, "pages").select("page_id", text.decoded(body, head).alias("html"))


@query("SELECT doc_id AS id, doc_id % 2 = 0 AS indexed FROM documents WHERE doc_id % 5 = 0")
def index_probe(spark, sf):
    d, path = rd(spark, sf, "documents").select(F.col("doc_id").alias("id"), "n_chars"), place(spark, "index")
    sinks.write_index(d.where("id % 2 = 0"), path, "id")
    return sinks.indexed(spark, path, d.where("id % 5 = 0"), "id")


@query("SELECT DISTINCT substr(sha1(text), 1, 2) || '/' || substr(sha1(text), 3, 2) || '/' || sha1(text) || '.txt' AS path, CAST(octet_length(encode(text)) AS BIGINT) AS size FROM documents WHERE octet_length(encode(text)) > 0")
def extracted_files(spark, sf):
    d = sinks.extracted(rd(spark, sf, "documents").select(F.encode("text", "UTF-8").alias("payload")), ".txt")
    return d.select("path", F.octet_length("payload").cast("long").alias("size"))


@query("SELECT url, sha1, count(*) AS n FROM (SELECT DISTINCT source AS url, sha1(text) AS sha1 FROM documents WHERE text IS NOT NULL) GROUP BY 1, 2")
def url_digests(spark, sf):
    """Pages seen in two runs; an address with the same content is kept once."""
    d = rd(spark, sf, "documents").where("text IS NOT NULL").select("doc_id", F.col("source").alias("url"), F.encode("text", "UTF-8").alias("payload"), F.lit("2024-01-01").cast("timestamp").alias("ts"))
    none = d.limit(0).select("url", F.lit("").alias("sha1"), "ts")
    once = sinks.url_digests(none, d.where("doc_id % 3 <> 0"))
    return sinks.url_digests(once, d).groupBy("url", "sha1").agg(F.count("*").alias("n"))


@query("SELECT page_id, sha1(url) AS sha1_hex FROM pages WHERE page_id % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1 AND url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)")
def unseen_captures(spark, sf):
    p = rd(spark, sf, "pages").select("page_id", F.sha1(F.col("url").cast("binary")).alias("sha1_hex"))
    return webarchive.unseen(p.where("page_id % 3 <> 0"), p.where("page_id % 3 = 0").select(F.col("sha1_hex").alias("sha1")), "page_id").select("page_id", "sha1_hex")


@query("""SELECT page_id, CASE WHEN page_id % 6 = 0 THEN 'cursed' WHEN page_id % 5 = 0 THEN 'ignored' END AS skip FROM pages""")
def skipped_captures(spark, sf):
    n = F.col("page_id").cast("string")
    c = rd(spark, sf, "pages").select("page_id", TEXT("S", n).alias("sha1_b32"), F.when(F.col("page_id") % 5 == 0, "https://x.wiley.com/action/downloadSupplement?a").otherwise(F.col("url")).alias("url"))
    return webarchive.wanted_captures(c, c.where("page_id % 6 = 0")).select("page_id", "skip")


@query("SELECT p_name AS url, (SELECT count(*) FROM lineitem WHERE l_partkey = min(p_partkey) AND l_returnflag = 'R') AS count FROM part WHERE p_partkey % 3 = 0 GROUP BY p_partkey, p_name")
def capture_counts(spark, sf):
    name = rd(spark, sf, "part").select("p_partkey", F.concat_ws("#", "p_name", F.col("p_partkey").cast("string")).alias("url"))
    captures = rd(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey")).join(name, "p_partkey").select("url")
    return webarchive.capture_counts(name.where("p_partkey % 3 = 0"), captures).select(F.regexp_replace("url", "#[0-9]+$", "").alias("url"), "count")


@query("SELECT c_name || '.xml.gz' AS name FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 31 >= 9 AND c_custkey % 31 < 19")
def listed_files(spark, sf):
    at = F.timestamp_add("DAY", (F.col("c_custkey") % 31).cast("int"), F.lit("2024-01-01").cast("timestamp"))
    files = rd(spark, sf, "customer").select(F.concat("c_name", F.when(F.col("c_custkey") % 3 == 0, ".xml.gz").otherwise(".xml.gz.md5")).alias("name"), at.alias("modified"))
    return feeds.listed(files, "name", "2024-01-10", "2024-01-20").select("name")


@query("SELECT doc_id, text FROM documents WHERE trim(text) <> '' AND NOT contains(text, chr(30))")
def separated_records(spark, sf):
    """Texts with line breaks, written with a separator behind each, and read again."""
    d = rd(spark, sf, "documents").where("trim(text) <> '' AND NOT contains(text, char(30))")
    path = place(spark, "records")
    sinks.write_records(d.select(F.to_json(F.struct("doc_id", "text"), {"pretty": "true"}).alias("v")), "v", path)
    return readers.json_lines(spark, path, "doc_id long, text string", "\x1e").select("doc_id", "text")


@query("""WITH c AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 3 = 0 THEN p_name WHEN l_partkey % 3 = 1 THEN 'Raw ' || l_linenumber ELSE 'G' || l_partkey || ' S' END AS name FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT l_orderkey AS release_id, string_agg(name, '; ' ORDER BY l_linenumber, name) AS names, count(*) FILTER (l_linenumber > 1) AS n_positioned FROM c GROUP BY 1""")
def contributors_in_order(spark, sf):
    k = F.col("l_partkey") % 3
    c = rd(spark, sf, "lineitem").select(F.col("l_orderkey").alias("release_id"), (F.col("l_linenumber") - 1).alias("position"), F.when(k == 0, F.col("l_partkey")).alias("creator_id"), F.when(k == 1, TEXT("Raw ", F.col("l_linenumber").cast("string"))).alias("raw_name"), TEXT("G", F.col("l_partkey").cast("string")).alias("given_name"), F.lit("S").alias("surname"))
    names = documents.contributor_names(c, rd(spark, sf, "part").select(F.col("p_partkey").alias("creator_id"), F.col("p_name").alias("name")))
    return names.withColumn("names", F.array_join("names", "; "))


@query("""SELECT l_orderkey AS file_id, count(*) AS n_hosts, coalesce('https://web.archive.org/web/1/' || arg_max(l_partkey, i) FILTER (l_returnflag = 'R'), CASE WHEN arg_min(l_returnflag, i) = 'A' THEN 'https://archive.example.co.uk/' ELSE 'https://x.example.org:8080/' END || arg_min(l_partkey, i)) AS best_url,
  bool_or(l_returnflag = 'R') AS in_ia, string_agg(CASE l_returnflag WHEN 'R' THEN 'archive.org' WHEN 'A' THEN 'example.co.uk' ELSE 'example.org' END, ' ' ORDER BY i) AS domains, 0 AS release_count
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS i FROM lineitem) GROUP BY 1""")
def file_documents(spark, sf):
    from pyspark.sql import Window

    at = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    host = F.when(F.col("l_returnflag") == "R", "https://web.archive.org/web/1/").when(F.col("l_returnflag") == "A", "https://archive.example.co.uk/").otherwise("https://x.example.org:8080/")
    urls = rd(spark, sf, "lineitem").select(F.col("l_orderkey").alias("file_id"), at.alias("url_index"), F.concat(host, F.col("l_partkey").cast("string")).alias("url"), F.lit("web").alias("rel"))
    files = urls.select("file_id").distinct().select("file_id", F.lit("s").alias("sha1"), F.lit("application/pdf").alias("mimetype"), F.lit(1).alias("size"))
    none = urls.limit(0).select("file_id", F.col("file_id").alias("release_id"))
    return documents.file_documents(files, urls, none).select("file_id", F.size("hosts").alias("n_hosts"), "best_url", "in_ia", F.array_join("domains", " ").alias("domains"), "release_count")


@query("SELECT n_nationkey AS container_id, 'active' AS state, n_name AS name, trim(CASE WHEN n_nationkey % 2 = 0 THEN 'L' || n_nationkey ELSE '' END || ' E' || n_nationkey) AS issns FROM nation")
def container_documents(spark, sf):
    n = F.col("n_nationkey").cast("string")
    c = rd(spark, sf, "nation").select(F.col("n_nationkey").alias("container_id"), F.col("n_name").alias("name"), F.lit("P").alias("publisher"), F.lit("journal").alias("container_type"), F.when(F.col("n_nationkey") % 2 == 0, TEXT("L", n)).otherwise("").alias("issnl"), TEXT("E", n).alias("issne"), F.lit(None).cast("string").alias("issnp"))
    return documents.container_documents(c).select("container_id", "state", "name", F.array_join("issns", " ").alias("issns"))


@query("""SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 'published' WHEN 1 THEN 'published' WHEN 2 THEN 'published' WHEN 3 THEN 'submitted' WHEN 4 THEN 'draft' WHEN 5 THEN 'published' WHEN 6 THEN 'published' END AS stage FROM orders""")
def stages_by_prefix(spark, sf):
    k, at = F.col("o_orderkey") % 8, lambda *v: F.element_at(F.array(*(F.lit(x).cast("string") for x in v)), (F.col("o_orderkey") % 8 + 1).cast("int"))
    prefix, stage = at("10.1109", "10.1145", "10.1063", "10.1101", "10.1109", "10.17504", "10.3510", "10.1117"), F.when(k == 4, "draft").when(k == 6, "submitted")
    kind, name = at("article", "article", "paper-conference", "post", "paper-conference", "article", "article", "article"), at("IEEE Access", "Proceedings of X", "X", "X", "X", None, "X", "Proceedings")
    return rd(spark, sf, "orders").select("o_orderkey", documents.release_stage(prefix, stage, kind, name, F.lit("Faculty of 1000 evaluation for x")).alias("stage"))


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'stub' WHEN 1 THEN 'entry' WHEN 2 THEN 'component' WHEN 3 THEN 'component' WHEN 4 THEN 'dataset' ELSE 'article' END AS kind, CASE o_orderkey % 6 WHEN 3 THEN 'v2' ELSE '7' END AS version FROM orders""")
def types_by_prefix(spark, sf):
    at = lambda *v: F.element_at(F.array(*map(F.lit, v)), (F.col("o_orderkey") % 6 + 1).cast("int"))
    doi = at("10.15468/dl.x", "10.5517/x", "10.9/x", "10.6084/m9.figshare.1.v2", "10.6084/x.vx", "10.9/y")
    title = at("GBIF Occurrence Download", "x", "Additional file 1", "Table 1 from x", "About x from y", "x")
    kind = at("dataset", "dataset", "article", "dataset", "dataset", "article")
    return rd(spark, sf, "orders").select("o_orderkey", convert.datacite_type(doi, title, kind).alias("kind"), convert.datacite_version(doi, F.lit("7")).alias("version"))


@query("SELECT '10.5/' || o_orderkey AS doi, 'u' || o_orderkey AS access_url FROM orders WHERE o_orderkey % 6 = 0")
def doi_full_texts(spark, sf):
    n = F.col("o_orderkey").cast("string")
    o = rd(spark, sf, "orders").select("o_orderkey", TEXT("10.5/", n).alias("doi"), F.when(F.col("o_orderkey") % 2 == 0, TEXT("u", n)).alias("access_url"))
    return documents.full_texts_of(o.where("o_orderkey % 3 = 0"), o.withColumn("doi", TEXT("https://doi.org/", F.col("doi"))))


@query("""WITH r AS (SELECT c_nationkey AS k, year(o_orderdate) AS y, CASE WHEN k % 4 = 1 AND o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS lost FROM orders JOIN customer ON c_custkey = o_custkey),
s AS (SELECT k, count(*) AS n, sum(lost) AS lost FROM r GROUP BY 1)
SELECT n_nationkey AS position, CASE WHEN n_nationkey = 2 THEN 'bad-ident' WHEN n_nationkey % 5 = 3 THEN 'container-type' WHEN coalesce(n, 0) < 15 THEN 'few-releases' WHEN (n - lost) / n < 0.8 THEN 'low-overall-preservation-fraction' ELSE 'success' END AS status,
  n_nationkey <> 2 AND n_nationkey % 5 <> 3 AND coalesce(n, 0) >= 15 AND (n - lost) / n >= 0.8 AS reported FROM nation LEFT JOIN s ON k = n_nationkey""")
def report_replay(spark, sf):
    """Containers dumped with their counts, some without a status, written, read and evaluated again."""
    k = F.col("n_nationkey")
    ident = F.when(k == 2, "no ident").otherwise(ids.uuid_to_short(F.format_string("00000000-0000-0000-0000-%012d", k.cast("long"))))
    c = rd(spark, sf, "nation").select(
        k.alias("container_id"), k.alias("position"), ident.alias("ident"), F.col("n_name").alias("name"), F.lit("P").alias("publisher"), F.when(k % 5 == 3, "magazine").alias("container_type"), TEXT("L", k.cast("string")).alias("issnl"), TEXT("E", k.cast("string")).alias("issne"),
        F.lit(None).cast("string").alias("issnp"), F.lit("{}").alias("extra"),
    )
    who = rd(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("container_id"))
    lost = (F.col("container_id") % 4 == 1) & (F.col("o_orderkey") % 3 == 0)
    o = rd(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate").join(who, "o_custkey")
    spans = holdings.spans(o.select("container_id", F.lit("article-journal").alias("release_type"), F.when(lost, "none").otherwise("bright").alias("preservation"), F.year("o_orderdate").alias("year"), (F.year("o_orderdate") - 1990).cast("string").alias("volume")))
    dumped = holdings.dump(c, spans, "ident", "position")
    forgotten = F.when(F.col("position") % 2 == 1, F.regexp_replace("info", '"status":"[a-z-]+"', '"status":""')).otherwise(F.col("info"))
    path = place(spark, "dump")
    sinks.write_json(dumped.withColumn("info", forgotten), path)
    schema = "ident string, status string, " + ", ".join(f"`{n}` {t}" for n, t in c.drop("ident", "position").dtypes) + ", " + ", ".join(f"`{n}` {t}" for n, t in spans.drop("container_id").dtypes)
    again = holdings.replay(readers.json_lines(spark, path, "position long, info string").drop("_corrupt_record"), schema, spans.drop("container_id").columns, 1998)
    return again.select("position", "status", F.col("publication_title").isNotNull().alias("reported"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 64 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price, 1 AS kept FROM orders WHERE o_orderkey % 64 <> 32 UNION ALL SELECT -c_custkey - 1, 0, 1 FROM customer WHERE c_custkey % 50 = 0""")
def merged_buckets(spark, sf):
    """Orders in 16 buckets after two merges and one that failed; and whether files of untouched buckets are those of before."""
    o = rd(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(15,2)").alias("price"))
    path = place(spark, "buckets")
    buckets.create(o, path, ["o_orderkey"], 16)
    buckets.merge(spark, path, o.where("o_orderkey % 64 = 0").withColumn("price", (F.col("price") + 1).cast("decimal(15,2)")), o.where("o_orderkey % 64 = 32").select("o_orderkey"))
    before = buckets.files(path)
    added = rd(spark, sf, "customer").where("c_custkey % 50 = 0").select((-F.col("c_custkey") - 1).alias("o_orderkey"), F.lit(0).cast("decimal(15,2)").alias("price"))
    touched = buckets.merge(spark, path, added)
    try:
        buckets.merge(spark, path, added.unionByName(added))
        raise AssertionError("two rows of a key were merged")
    except ValueError:
        pass
    held = {f for f in before if f.split("bucket=")[1].split("/")[0] not in touched}
    return buckets.read(spark, path).withColumn("kept", F.lit(int(held <= buckets.files(path))))
