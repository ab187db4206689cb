"""Readers: JSON lines, XML records, delimited text, capture indexes, archive files."""

from __future__ import annotations

import io
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quire.sources import stores

#: Columns of a capture index line and their places (fixed values).
CDX = ("surt", "ts", "url", "mimetype", "status", "sha1_b32", "redirect", "meta", "size", "offset", "warc_path")
#: Largest line that is parsed.
LARGEST = 256 << 20
BLOCK = 1 << 20  # bytes read of an archive at a time


def lines(spark: SparkSession, path: str, separator: str = "\n") -> DataFrame:
    """Non-blank lines of at most LARGEST bytes; the last one needs no separator."""
    raw = spark.read.text(path, lineSep=separator)
    return raw.where((F.trim("value") != "") & (F.octet_length("value") <= LARGEST))


def json_lines(spark: SparkSession, path: str, schema: str, separator: str = "\n") -> DataFrame:
    """Parsed lines; what does not parse is in `_corrupt_record`."""
    rows = lines(spark, path, separator)
    x = rows.select(F.from_json("value", f"{schema}, _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record", "mode": "PERMISSIVE"}).alias("x"))
    return x.select("x.*")


def xml_records(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """One row for each element `tag`. Harvested files are documents behind one another, without a root of their own, which the strict parser does not read on from."""
    return spark.read.format("xml").option("rowTag", tag).option("useLegacyXMLParser", "true").option("mode", "PERMISSIVE").option("ignoreNamespace", "true").schema(schema).load(path)


OAI_SCHEMA = "header struct<_status:string,identifier:string,datestamp:string,setSpec:array<string>>, metadata struct<dc:struct<title:array<string>,creator:array<string>,subject:array<string>,description:array<string>,date:array<string>,type:array<string>,identifier:array<string>,language:array<string>>>"


def oai_records(spark: SparkSession, path: str) -> DataFrame:
    """Harvested Dublin Core, flat."""
    x = xml_records(spark, path, "record", OAI_SCHEMA)
    dc = "metadata.dc"
    return x.select(
        F.col("header.identifier").alias("oai"), F.col("header._status").alias("status"), F.col("header.datestamp").alias("datestamp"), F.col("header.setSpec").alias("sets"),
        *(F.coalesce(F.col(f"{dc}.{f}"), F.array().cast("array<string>")).alias(n) for f, n in (("title", "titles"), ("creator", "creators"), ("subject", "subjects"), ("description", "descriptions"), ("date", "dates"), ("identifier", "identifiers"), ("language", "languages"))),
    )


ARXIV_SCHEMA = """header struct<_status:string,identifier:string,datestamp:string>, metadata struct<arXiv:struct<id:string,created:string,updated:string,title:string,categories:string,comments:string,`journal-ref`:string,`report-no`:string,doi:string,license:string,abstract:string,
 authors:struct<author:array<struct<keyname:string,forenames:string,suffix:string,affiliation:array<string>>>>>>"""


def arxiv_records(spark: SparkSession, path: str) -> DataFrame:
    """Harvested arXiv metadata, flat."""
    x, m = xml_records(spark, path, "record", ARXIV_SCHEMA), "metadata.arXiv"
    people = F.transform(F.col(f"{m}.authors.author"), lambda a: F.struct(a["forenames"].alias("forename"), a["keyname"].alias("keyname"), a["suffix"].alias("suffix"), F.try_element_at(a["affiliation"], F.lit(1)).alias("affiliation")))
    return x.select(
        F.col("header.identifier").alias("identifier"), F.col("header._status").alias("status"), F.col("header.datestamp").alias("datestamp"), *(F.col(f"{m}.{f}").alias(f) for f in ("id", "title", "abstract", "doi", "created", "updated", "license")),
        F.col(f"{m}.journal-ref").alias("journal_ref"), F.col(f"{m}.report-no").alias("report_no"), people.alias("authors"),
    )


DOAJ_SCHEMA = """header struct<_status:string,identifier:string,datestamp:string>, metadata struct<doajArticle:struct<language:string,publisher:string,journalTitle:string,issn:string,eissn:string,publicationDate:string,volume:string,issue:string,startPage:string,endPage:string,doi:string,title:string,abstract:string,fullTextUrl:string,
 authors:struct<author:array<struct<name:string,orcid_id:string>>>>>"""


def doaj_records(spark: SparkSession, path: str) -> DataFrame:
    """Harvested journal articles, flat; the id is the last part of the record's identifier."""
    x, m = xml_records(spark, path, "record", DOAJ_SCHEMA), "metadata.doajArticle"
    people = F.transform(F.col(f"{m}.authors.author"), lambda a: F.struct(a["name"].alias("name"), F.lit(None).cast("string").alias("affiliation"), a["orcid_id"].alias("orcid_id")))
    return x.select(
        F.regexp_extract("header.identifier", r"([^:/]+)$", 1).alias("id"), F.col("header._status").alias("status"), *(F.col(f"{m}.{f}").alias(n) for f, n in (("title", "title"), ("publisher", "publisher"), ("publicationDate", "publication_date"), ("doi", "doi"), ("language", "language"), ("abstract", "abstract"), ("volume", "volume"), ("issue", "issue"), ("startPage", "start_page"), ("endPage", "end_page"))),
        people.alias("authors"), F.lit(None).cast("string").alias("license_ref"),
    )


TEI_AUTHOR = "persName:struct<forename:array<string>,surname:string>,affiliation:array<struct<orgName:array<struct<_type:string,_VALUE:string>>>>"
TEI_SCHEMA = f"""teiHeader struct<`_xml:lang`:string,_lang:string,fileDesc:struct<titleStmt:struct<title:array<string>>,publicationStmt:struct<publisher:string,date:array<struct<_when:string,_VALUE:string>>>,sourceDesc:struct<biblStruct:struct<analytic:struct<author:array<struct<{TEI_AUTHOR}>>>,
 monogr:struct<imprint:struct<biblScope:array<struct<_unit:string,_from:string,_to:string,_VALUE:string>>>>,idno:array<struct<_type:string,_VALUE:string>>>>>,profileDesc:struct<abstract:struct<div:array<struct<p:array<string>>>,p:array<string>>>>"""


def tei_records(spark: SparkSession, path: str) -> DataFrame:
    """Documents of extracted papers, one a file, flat: what the header says, and the file's name."""
    x = spark.read.format("xml").option("rowTag", "TEI").option("ignoreNamespace", "true").option("useLegacyXMLParser", "true").schema(TEI_SCHEMA).load(path)
    h, b = "teiHeader.fileDesc", "teiHeader.fileDesc.sourceDesc.biblStruct"
    valued = lambda c, attr, k: F.try_element_at(F.filter(F.col(c), lambda i: F.lower(i[attr]) == k), F.lit(1))
    scope = lambda k: valued(f"{b}.monogr.imprint.biblScope", "_unit", k)
    org = lambda a, k: F.try_element_at(F.filter(F.flatten(F.transform(a["affiliation"], lambda f: f["orgName"])), lambda o: o["_type"] == k), F.lit(1))["_VALUE"]
    people = F.transform(F.col(f"{b}.analytic.author"), lambda a: F.struct(F.concat_ws(" ", a["persName"]["forename"], a["persName"]["surname"]).alias("full_name"), F.concat_ws(" ", a["persName"]["forename"]).alias("given_name"), a["persName"]["surname"].alias("surname"), org(a, "institution").alias("institution"), org(a, "department").alias("department")))
    pages = scope("page")
    return x.select(
        F.input_file_name().alias("file"), F.trim(F.try_element_at(F.col(f"{h}.titleStmt.title"), F.lit(1))).alias("title"), F.coalesce("teiHeader._lang", "teiHeader.`_xml:lang`").alias("language"), F.col(f"{h}.publicationStmt.publisher").alias("publisher"),
        F.try_element_at(F.filter(F.transform(F.col(f"{h}.publicationStmt.date"), lambda d: d["_when"]), lambda d: d.isNotNull()), F.lit(1)).alias("date"), scope("volume")["_VALUE"].alias("volume"), scope("issue")["_VALUE"].alias("issue"),
        F.coalesce(F.nullif(F.concat_ws("-", pages["_from"], pages["_to"]), F.lit("")), pages["_VALUE"]).alias("pages"), *(valued(f"{b}.idno", "_type", k)["_VALUE"].alias(k) for k in ("doi", "pmid", "pmcid", "arxiv")), F.filter(people, lambda a: a["full_name"] != "").alias("authors"),
        F.nullif(F.array_join(F.coalesce(F.flatten(F.transform(F.col("teiHeader.profileDesc.abstract.div"), lambda d: d["p"])), F.col("teiHeader.profileDesc.abstract.p")), " "), F.lit("")).alias("abstract"),
    )


def pubmed_records(spark: SparkSession, path: str, article: str, deletion: str) -> DataFrame:
    """Articles and deletions of the same files, told apart by `type`."""
    a = xml_records(spark, path, "PubmedArticle", article).withColumn("type", F.lit("article"))
    d = xml_records(spark, path, "DeleteCitation", deletion).withColumn("type", F.lit("deleteCitation"))
    return a.unionByName(d, allowMissingColumns=True)


def tsv(spark: SparkSession, path: str, schema: str | None = None, header: bool = True) -> DataFrame:
    """Tab-separated text with ragged rows; quotes mean nothing."""
    r = spark.read.option("sep", "\t").option("header", header).option("quote", "").option("mode", "PERMISSIVE")
    return (r.schema(schema) if schema else r).csv(path)


def issn_map(spark: SparkSession, path: str) -> DataFrame:
    """(issn, issnl) of a two-column table; each linking ISSN maps to itself as well."""
    t = spark.read.text(path).where(~F.col("value").startswith("ISSN")).select(F.split(F.trim("value"), r"\s+").alias("p")).where(F.size("p") >= 2).select(F.col("p")[0].alias("issn"), F.col("p")[1].alias("issnl"))
    return t.unionByName(t.select(F.col("issnl").alias("issn"), "issnl")).dropDuplicates(["issn"])


def cdx(spark: SparkSession, path: str) -> DataFrame:
    """Capture index lines with all eleven fields and numeric sizes; the header and bad lines are skipped."""
    p = spark.read.text(path).where(~F.trim("value").startswith("CDX")).select(F.split(F.trim("value"), " ").alias("p")).where(F.size("p") >= len(CDX))
    rows = p.select(*(F.col("p")[i].alias(c) for i, c in enumerate(CDX)))
    rows = rows.withColumn("size", F.col("size").try_cast("long")).withColumn("offset", F.col("offset").try_cast("long"))
    return rows.where("size IS NOT NULL AND offset IS NOT NULL").drop("redirect", "meta")


def usable_captures(df: DataFrame) -> DataFrame:
    """Captures with a WARC and a SHA-1; transfers over FTP count as status 226."""
    digest = F.lower("sha1_b32")
    ok = (F.col("warc_path") != "-") & ~F.startswith(digest, F.lit("sha-256")) & (digest != "error") & (F.length("sha1_b32") == 32) & (F.col("mimetype") != "warc/revisit")
    return df.where(ok).withColumn("status", F.when(F.startswith("url", F.lit("ftp")) & (F.col("status") == "-"), "226").otherwise(F.col("status")))


def collection_captures(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Captures of papers of a collection's items (item: path of its index), items of crawl logs left out, with the item's name."""
    found = [pdf_captures(usable_captures(cdx(spark, p))).withColumn("item", F.lit(k)) for k, p in sorted(paths.items()) if not k.endswith("-CRL")]
    return reduce(DataFrame.unionByName, found)


def pdf_captures(df: DataFrame) -> DataFrame:
    return df.where((F.col("mimetype") == "application/pdf") & (F.col("status") == "200"))


def decompressed(spark: SparkSession, path: str) -> DataFrame:
    """Lines of files that the text reader cannot open itself (.zst), and of others by its side; empty files give none."""

    def run(batches: Iterator):
        import io

        import pyarrow as pa
        import zstandard

        for b in batches:
            for name, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
                stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content), read_across_frames=True) if name.endswith(".zst") else io.BytesIO(content)
                block = []
                for line in io.TextIOWrapper(stream, "utf-8", errors="replace", newline="\n"):
                    if line.strip():
                        block.append(line.rstrip("\n"))
                    if len(block) == 10000:
                        yield pa.RecordBatch.from_pydict({"value": block})
                        block = []
                if block:
                    yield pa.RecordBatch.from_pydict({"value": block})

    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")
    return files.mapInArrow(run, "value string")


WARC = "warc string, target_uri string, ts string, record_type string, status int, content_type string, payload binary, truncated boolean, sha1 string"


def _warc_parts(stream, largest: int) -> Iterator[tuple[dict, bytes, bool]]:
    """Head, body and whether it was cut, of each record of an open WARC."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line.startswith(b"WARC/"):
            return
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            k, _, v = line.decode("utf-8", "replace").partition(":")
            head[k.strip().lower()] = v.strip()
        try:
            size = int(head.get("content-length", 0))
        except ValueError:
            return
        body = stream.read(min(size, largest))
        left = size - len(body)
        yield head, body, left > 0 or head.get("warc-truncated") is not None
        while left > 0 and (skipped := stream.read(min(left, 1 << 20))):
            left -= len(skipped)


def response(head: dict, body: bytes, cut: bool) -> Iterator[tuple]:
    """The row of an HTTP response, none of other records: the usual processor."""
    import hashlib

    if head.get("warc-type") == "response":
        http, _, payload = body.partition(b"\r\n\r\n")
        first, *fields = http.decode("latin-1").split("\r\n")
        kind = next((f.partition(":")[2].strip() for f in fields if f.lower().startswith("content-type:")), None)
        code = first.split(" ")[1] if first.startswith("HTTP/") and len(first.split(" ")) > 1 else ""
        yield (head.get("warc-target-uri"), head.get("warc-date"), "response", int(code) if code.isdigit() else None, kind, payload, cut, hashlib.sha1(payload).hexdigest())


class _Part(io.RawIOBase):
    """Bytes [offset, offset + length) of an open file, unpacked if they are gzip; what ends early ends there."""

    def __init__(self, file, offset: int, length: int, packed: bool):
        file.seek(offset)
        self.file, self.left, self.rest = file, length, b""
        self.unpack = zlib.decompressobj(31) if packed else None

    def readable(self) -> bool:
        return True

    def readinto(self, out) -> int:
        while not self.rest:
            held = self.unpack.unconsumed_tail if self.unpack else b""
            block = held or self.file.read(min(self.left, BLOCK))
            if not held:
                self.left -= len(block)
            if not block:
                return 0
            try:
                self.rest = self.unpack.decompress(block, BLOCK) if self.unpack else block
            except zlib.error:
                return 0
            if self.unpack and self.unpack.eof:
                self.left = 0
        n = min(len(out), len(self.rest))
        out[:n], self.rest = self.rest[:n], self.rest[n:]
        return n


def _members(file, size: int) -> Iterator[tuple[int, int, bool]]:
    """(offset, length, packed) of the gzip members of an archive, or of the records of one that is not packed; in one pass, a block at a time."""
    file.seek(0)
    if file.read(2) != b"\x1f\x8b":
        at = 0
        while at < size:
            file.seek(at)
            head, blank = b"", 0
            while b"\r\n\r\n" not in head.lstrip(b"\r\n") and (block := file.read(4096)):
                head += block
            blank = len(head) - len(head.lstrip(b"\r\n"))
            fields, found, _ = head[blank:].partition(b"\r\n\r\n")
            length = re.search(rb"(?im)^content-length:[ \t]*(\d+)", fields)
            if not fields.startswith(b"WARC/") or not found or not length:
                if blank < len(head):
                    yield at, size - at, False
                return
            step = min(blank + len(fields) + 4 + int(length[1]), size - at)
            yield at, step, False
            at += step
        return
    file.seek(0)
    start, at, held = 0, 0, b""
    while start < size:
        unpack = zlib.decompressobj(31)
        while not unpack.eof:
            block = held or file.read(BLOCK)
            held = b""
            if not block:
                break
            at += len(block)
            try:
                while block and not unpack.eof:
                    unpack.decompress(block, BLOCK)
                    block = unpack.unconsumed_tail
            except zlib.error:  # what follows is no gzip: it goes with the member that it breaks
                yield start, size - start, True
                return
        held = unpack.unused_data
        at -= len(held)
        yield start, at - start, True
        start = at
        if not unpack.eof:
            return


def warc_index(spark: SparkSession, path: str) -> DataFrame:
    """(path, offset, length, packed) of each part of archives that can be read by itself; one task a file, a block at a time. Store it for archives that are read again."""

    def run(batches: Iterator):
        for b in batches:
            for name, size in zip(b.column("path").to_pylist(), b.column("length").to_pylist(), strict=True):
                store, at = stores.opened(name)
                with store.open_input_file(at) as f:
                    rows: list[tuple] = []
                    for row in _members(f, size):
                        rows.append((name, *row))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], ["path", "offset", "length", "packed"])
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], ["path", "offset", "length", "packed"])

    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "length")
    return files.mapInArrow(run, "path string, offset long, length long, packed boolean")


def warc_records(
    spark: SparkSession, path: str, process: Callable[[dict, bytes, bool], Iterable[tuple]], schema: str, keep: Callable[[dict], bool] = lambda head: True, largest: int = 500 << 20, block: int = 64,
    share: int = 64 << 20, index: DataFrame | None = None,
) -> DataFrame:
    """The rows that `process(head, body, cut)` makes of each record that `keep(head)` takes, with the file's name first.

    Tasks take `share` bytes of an archive each, by an index of its parts (made where none is given).  A record that ends
    early or is larger than `largest` is cut, and one that makes `process` fail gives nothing.
    """
    names = [f.name for f in StructType.fromDDL(schema).fields]
    types = to_arrow_schema(StructType.fromDDL(schema))

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], types.field(i).type) for i in range(len(names))], names=names)

    def run(batches: Iterator):
        opened, file, rows, size = None, None, [], 0
        for b in batches:
            for name, offset, length, packed in zip(*(b.column(c).to_pylist() for c in ("path", "offset", "length", "packed")), strict=True):
                if name != opened:
                    store, at = stores.opened(name)
                    opened, file = name, store.open_input_file(at)
                for head, body, cut in _warc_parts(io.BufferedReader(_Part(file, offset, length, packed)), largest):
                    if not keep(head):
                        continue
                    try:
                        made = [(name, *r) for r in process(head, body, cut)]
                    except (ValueError, KeyError, IndexError, TypeError):
                        continue
                    rows += made
                    size += len(body) * len(made)
                    if len(rows) >= block or size > 8 << 20:
                        yield batch(rows)
                        rows, size = [], 0
        if rows:
            yield batch(rows)

    if index is None:
        files = spark.read.format("binaryFile").load(path).select("length")
        index = warc_index(spark, path)
    else:
        files = index.groupBy("path").agg(F.max(F.col("offset") + F.col("length")).alias("length"))
    tasks = files.agg(F.sum(F.ceil(F.col("length") / share))).first()[0]  # rows of the index are small, so Spark would put all into few tasks
    dealt = index.repartition(max(int(tasks or 1), 1), "path", F.floor(F.col("offset") / share)).sortWithinPartitions("path", "offset")
    return dealt.mapInArrow(run, schema)


def warc_responses(spark: SparkSession, path: str, largest: int = 500 << 20) -> DataFrame:
    """HTTP responses of WARC files; a record that ends early or exceeds `largest` is marked truncated."""
    return warc_records(spark, path, response, WARC, largest=largest)


def pdf_responses(df: DataFrame) -> DataFrame:
    return df.where((F.col("status") == 200) & F.lower("content_type").startswith("application/pdf") & ~F.col("truncated"))
