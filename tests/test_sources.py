import gzip

import zstandard
from pyspark.sql import functions as F

from quire.sources import readers
from quire.streaming import ingest


def test_lines_and_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1}\n\n{"x": "2"}\nnot json')
    assert readers.lines(spark, str(tmp_path / "a.json")).count() == 3
    got = readers.json_lines(spark, str(tmp_path / "a.json"), "x string").collect()
    assert [r["x"] for r in got] == ["1", "2", None] and got[2]["_corrupt_record"] == "not json"


def test_oai_xml(spark, tmp_path):
    (tmp_path / "a.xml").write_text("""<r><record><header status="deleted"><identifier>oai:1</identifier></header></record>
    <record><header><identifier>oai:2</identifier></header><metadata><oai_dc:dc xmlns:oai_dc="x" xmlns:dc="y"><dc:title>T</dc:title><dc:creator>A B</dc:creator><dc:identifier>doi:10.1234/x</dc:identifier></oai_dc:dc></metadata></record></r>""")
    from quire.operators import convert

    rows = convert.oai(readers.oai_records(spark, str(tmp_path / "a.xml"))).collect()
    assert [r["skip_reason"] for r in rows] == ["deleted", None] and rows[1]["extids"] == {"oai": "oai:2", "doi": "10.1234/x"} and rows[1]["contribs"][0]["surname"] == "B"


def test_documents_behind_one_another(spark, tmp_path):
    """Two documents in one file, a record over several lines, and the tag's name in a text."""
    one = '<?xml version="1.0"?><r><record><header><identifier>oai:%d</identifier></header>\n<metadata><dc><title>a &lt;record&gt; %d</title></dc></metadata></record></r>\n'
    (tmp_path / "a.xml").write_text(one % (1, 1) + one % (2, 2) + "<record><header status='deleted'><identifier>oai:3</identifier></header></record>")
    rows = {r["oai"]: (r["status"], r["titles"]) for r in readers.oai_records(spark, str(tmp_path / "a.xml")).collect()}
    assert rows == {"oai:1": (None, ["a <record> 1"]), "oai:2": (None, ["a <record> 2"]), "oai:3": ("deleted", [])}


def test_cdx(spark, tmp_path):
    good = "org,x)/a 20200101000000 http://x.org/a application/pdf 200 " + "A" * 32 + " - - 10 20 w.warc.gz"
    with gzip.open(tmp_path / "a.cdx.gz", "wt") as f:
        f.write(f" CDX N b a m s k r M S V g\n{good}\nbad line\n{good.replace(' 10 ', ' x ')}\n")
    rows = readers.cdx(spark, str(tmp_path / "a.cdx.gz"))
    assert rows.count() == 1 and readers.pdf_captures(readers.usable_captures(rows)).first()["size"] == 10


def test_issn_map(spark, tmp_path):
    (tmp_path / "m").write_text("ISSN ISSN-L\n1111-1111 2222-2222\n")
    assert {(r["issn"], r["issnl"]) for r in readers.issn_map(spark, str(tmp_path / "m")).collect()} == {("1111-1111", "2222-2222"), ("2222-2222", "2222-2222")}


def test_zst(spark, tmp_path):
    (tmp_path / "a.zst").write_bytes(zstandard.compress(b"one\n\ntwo"))
    (tmp_path / "b.zst").write_bytes(b"")
    assert sorted(r["value"] for r in readers.decompressed(spark, str(tmp_path)).collect()) == ["one", "two"]


def test_warc(spark, tmp_path):
    def record(kind, body, size=None):
        return b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\nWARC-Target-URI: http://x/a\r\nContent-Length: " + str(size or len(body)).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\nContent-Type: application/pdf\r\n\r\n%PDF"
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(record(b"warcinfo", b"x")) + gzip.compress(record(b"response", http)))
    (tmp_path / "b.warc").write_bytes(record(b"response", http, 999))
    rows = readers.warc_responses(spark, str(tmp_path))
    assert rows.count() == 2 and readers.pdf_responses(rows).select("payload").first()["payload"] == b"%PDF" and rows.where("truncated").count() == 1


def test_warc_plug_ins(spark, tmp_path):
    """A filter on heads, and a processor that gives several rows a record and fails for some."""
    body = lambda k: b"WARC/1.0\r\nWARC-Type: resource\r\nX-Number: %d\r\nContent-Length: 4\r\n\r\na,%d\n\r\n\r\n" % (k, k)
    (tmp_path / "a.warc").write_bytes(b"".join(map(body, range(6))))

    def parts(head, content, cut):
        if head["x-number"] == "3":
            raise ValueError("no")
        for x in content.decode().strip().split(","):
            yield (x, int(head["x-number"]))

    rows = readers.warc_records(spark, str(tmp_path), parts, "warc string, part string, k int", keep=lambda h: h["x-number"] != "5", block=3)
    assert sorted((r["part"], r["k"]) for r in rows.collect()) == sorted([(p, k) for k in (0, 1, 2, 4) for p in ("a", str(k))])


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text('{"k": 1}\n{"k": 2}\n')
    run = lambda: ingest.ingest(ingest.records(spark, str(tmp_path / "in"), "k int"), str(tmp_path / "t"), str(tmp_path / "c"), ["k"]).awaitTermination()
    run()
    (tmp_path / "in/2.json").write_text('{"k": 2}\n{"k": 3}\n')
    run()
    run()
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [1, 2, 3]


def test_windows(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    assert ingest.counts_by_window(e, "ts", "1 hour", ["event_type"]).agg(F.sum("n")).first()[0] == e.count()
    assert ingest.changes(e, "ts", "2024-01-05", "2024-01-08").count() == e.where("ts >= '2024-01-05' and ts < '2024-01-08'").count()


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def warc_record(k: int, size: int) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + bytes((k * 7 + i * i) % 251 for i in range(size))
    return b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://x/%d\r\nContent-Length: %d\r\n\r\n" % (k, len(http)) + http + b"\r\n\r\n"


def test_archives_are_read_in_parts(spark, tmp_path):
    """Packed, plain, one member for all, cut in the middle, a record larger than a block, and gzip inside of a record: several tasks read what one would."""
    sizes = [3 * (1 << 20) if k == 3 else 500 + 37 * k for k in range(40)]
    records = [warc_record(k, n) for k, n in enumerate(sizes)]
    inner = gzip.compress(warc_record(99, 50))
    nested = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n" % len(inner) + inner + b"\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records)) + gzip.compress(nested, 0))
    (tmp_path / "b.warc").write_bytes(b"".join(records))
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(b"".join(records[:5])))
    (tmp_path / "d.warc.gz").write_bytes(b"".join(map(gzip.compress, records[:3])) + gzip.compress(records[4])[:-30])
    index = readers.warc_index(spark, str(tmp_path))
    assert {r["path"].rpartition("/")[2]: r["count"] for r in index.groupBy("path").count().collect()} == {"a.warc.gz": 41, "b.warc": 40, "c.warc.gz": 1, "d.warc.gz": 4}
    got = readers.warc_records(spark, str(tmp_path), readers.response, readers.WARC, share=4096, index=index)
    rows = got.withColumn("task", F.spark_partition_id()).collect()
    name = lambda r: r["warc"].rpartition("/")[2]
    import collections
    import hashlib

    want = lambda ks: sorted(hashlib.sha1(records[k].partition(b"\r\n\r\n")[2].partition(b"\r\n\r\n")[2][:-4]).hexdigest() for k in ks)
    for file, ks in (("a.warc.gz", range(40)), ("b.warc", range(40)), ("c.warc.gz", range(5)), ("d.warc.gz", range(3))):
        assert sorted(r["sha1"] for r in rows if name(r) == file and not r["truncated"]) == want(ks)
    assert [name(r) for r in rows if r["truncated"]] == ["d.warc.gz"]
    assert len({r["task"] for r in rows if name(r) == "b.warc"}) > 1
    assert collections.Counter(map(name, rows)) == {"a.warc.gz": 40, "b.warc": 40, "c.warc.gz": 5, "d.warc.gz": 4}


def test_slices(spark, tmp_path):
    """Cursor pages in order, days without files, pushed days, a page that is missing, a cursor that names itself."""
    import json

    from quire.sources import slices, stores

    def page(day, cursor, items, after):
        stores.put(f"{tmp_path}/{day}/{slices.named(cursor)}", json.dumps({"message": {"items": items, "next-cursor": after}}).encode())

    page("2024-01-01", "*", [{"k": 1}, {"k": 2}], "a/b=")
    page("2024-01-01", "a/b=", [{"k": 3}], "a/b=")
    page("2024-01-03", "*", [], None)
    page("2024-01-04", "*", [{"k": 4, "t": "ä"}], None)
    page("2024-01-06", "*", [{"k": 5}], "gone")
    names = {"items": "message.items", "next": "message.next-cursor"}
    read = lambda end: slices.sliced(spark, str(tmp_path), "2024-01-01", end, "k int, t string", **names)
    assert [tuple(r)[1:] for r in read("2024-01-06").orderBy("day", "page", "place").collect()] == [(0, 0, 1, None), (0, 1, 2, None), (1, 0, 3, None), (0, 0, 4, "ä")]
    assert read("2024-01-06").rdd.getNumPartitions() == 5
    one = read("2024-01-07").where("day = date'2024-01-04'")
    assert one.rdd.getNumPartitions() == 1 and [r["k"] for r in one.collect()] == [4]
    assert read("2024-01-07").where("day >= date'2024-01-03' and day < date'2024-01-05'").rdd.getNumPartitions() == 2
    assert read("2024-01-07").where("day in (date'2024-01-01', date'2024-01-04') and k > 2").count() == 2
    assert read("2024-01-07").where("day = date'2030-01-01'").count() == 0
    import pytest

    with pytest.raises(Exception, match="of cursor gone, is missing"):
        read("2024-01-07").collect()
    assert [str(d) for d in slices.starts(slices.date(2024, 1, 31), slices.date(2024, 3, 2), "month")] == ["2024-01-01", "2024-02-01", "2024-03-01"]
    assert [str(d) for d in slices.starts(slices.date(2024, 1, 3), slices.date(2024, 1, 16), "week")] == ["2024-01-01", "2024-01-08", "2024-01-15"]


def test_growing_files(spark, tmp_path):
    """Appended between runs: each line once, the unterminated one waits; ranges smaller than lines; a file that shrinks is refused."""
    from quire.streaming import growing

    growing.register(spark)
    (tmp_path / "in").mkdir()
    file = tmp_path / "in/a.jsonl"

    def run(size):
        stream = spark.readStream.format("quire_growing").option("range", size).load(str(tmp_path / "in"))
        ingest.appended(stream, str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
        return [r["value"] for r in spark.read.parquet(str(tmp_path / "t")).orderBy("file", "start").collect()]

    lines = [f"line {i} " + "x" * (i * 13 % 60) for i in range(300)]
    file.write_text("\n".join(lines[:100]) + "\nline hal")
    assert run(97) == lines[:100]
    assert run(7) == lines[:100]
    with open(file, "a") as f:
        f.write("f\n\n" + "\n".join(lines[100:]))
    (tmp_path / "in/b.jsonl").write_text("other\n")
    assert run(211) == [*lines[:100], "line half", "", *lines[100:-1], "other"]
    with open(file, "a") as f:
        f.write("\n")
    assert run(1 << 20) == [*lines[:100], "line half", "", *lines[100:], "other"]


def test_tallies_survive_restarts(spark, tmp_path):
    (tmp_path / "in").mkdir()

    def run(rows, name):
        if rows:
            import json

            (tmp_path / f"in/{name}.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
        ingest.tallied(ingest.records(spark, str(tmp_path / "in"), "s string, o string, k int"), "s", "o", str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
        return {(r["source"], r["outcome"]): r["n"] for r in ingest.tallies(spark, str(tmp_path / "t")).collect()}

    assert run([{"s": "a", "o": "done", "k": i} for i in range(50)] + [{"s": "b", "o": "bad", "k": 1}], 1) == {("a", "done"): 50, ("b", "bad"): 1}
    assert run([{"s": "a", "o": "done", "k": 7}, {"s": "a", "k": 8}, {"o": "done", "k": 9}], 2) == {("a", "done"): 51, ("b", "bad"): 1, ("a", ""): 1, ("", "done"): 1}
    assert run([], 3) == {("a", "done"): 51, ("b", "bad"): 1, ("a", ""): 1, ("", "done"): 1}
