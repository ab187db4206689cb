import base64
import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from quire.functions import dates, identifiers as ids, text


def one(spark, f, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("10.1037//0002-9432.72.1.50", "10.1037/0002-9432.72.1.50"),
        ("doi:10.1234/ asdf ", None),
        ("https://doi.org/10.1234/ABC", "10.1234/abc"),
        ("doi:http://dx.doi.org/10.1234/x", "10.1234/x"),
        ("10.1234/a–b", None),
        ("10.123/abc", None),
        ("10.1234/é", None),
        ("", None),
        (None, None),
    ],
)
def test_clean_doi(spark, raw, want):
    assert one(spark, ids.clean_doi, raw) == want


@pytest.mark.parametrize("raw, want", [("https://doi.org/10.1/A b", "10.1/a"), ("doi:10.5/x", "10.5/x"), ("11.5/x", None), (None, None)])
def test_lenient_doi(spark, raw, want):
    assert one(spark, ids.lenient_doi, raw) == want


@pytest.mark.parametrize("raw, want", [("https://orcid.org/0000-0001-2345-6789", "0000-0001-2345-6789"), ("0000000123456789", "0000-0001-2345-6789"), ("12", "12")])
def test_orcid(spark, raw, want):
    assert one(spark, ids.orcid, raw) == want


@pytest.mark.parametrize("u", ["00112233-4455-6677-8899-aabbccddeeff", "ffffffff-ffff-ffff-ffff-ffffffffffff", "00000000-0000-0000-0000-000000000001"])
def test_short_id_round_trip(spark, u):
    want = base64.b32encode(uuid.UUID(u).bytes).decode().lower().rstrip("=")
    assert one(spark, ids.uuid_to_short, u) == want
    assert one(spark, ids.short_to_uuid, want) == u


def test_sha1_base32(spark):
    d = hashlib.sha1(b"x").digest()
    assert one(spark, lambda x: ids.hex_to_base32(x, 40), d.hex()).upper() == base64.b32encode(d).decode()
    assert one(spark, lambda x: ids.base32_to_hex(x, 40), base64.b32encode(d).decode()) == d.hex()


@pytest.mark.parametrize("raw, want", [("''two singles''", '"two singles"'), ("“a”…", '"a"...'), (",,x", '"x'), ("it’s", "it's"), (None, None)])
def test_clean_string(spark, raw, want):
    assert one(spark, text.clean_string, raw) == want


@pytest.mark.parametrize("raw, want", [("eng", "en"), ("zh-TW", "zh"), ("EN", "en"), ("und", None), ("", None), ("english", None), (None, None)])
def test_language(spark, raw, want):
    assert one(spark, text.language, raw) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("https://creativecommons.org/licenses/by/4.0/legalcode", "CC-BY"),
        ("http://creativecommons.org/licenses/BY-NC/4.0/", "CC-BY-NC"),
        ("https://creativecommons.org/licenses/by/2.0/uk", "CC-BY"),
        ("http://example.com/x", None),
        ("", None),
    ],
)
def test_licence(spark, raw, want):
    assert one(spark, text.licence_slug, raw) == want


def test_titles(spark):
    assert one(spark, text.title_key, " A Title: 42\nÜber ") == "atitleüber"
    assert one(spark, text.title_tokens, "Deep learning of the deep Sea, 2nd ed.") == ["deep", "learning"]
    assert one(spark, text.detag, "<p>A &amp; <b>B</b></p>") == "A & B"
    assert one(spark, lambda x: text.split_name(x)["surname"], "Lovelace, Ada") == "Lovelace"
    assert one(spark, lambda x: text.split_name(x)["given"], "Ada King Lovelace") == "Ada King"
    assert one(spark, lambda x: text.weblinks(x), "see https://b.org/x) and http://a.org") == ["http://a.org", "https://b.org/x"]


@pytest.mark.parametrize("raw, want", [("12", 12), ("x", 0), ("-1", 0), ("30001", 0), (None, 0), (" 7 ", 7)])
def test_small_int(spark, raw, want):
    assert one(spark, text.small_int, raw) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("2021", (None, 2021, None)),
        ("2021-06", (None, 2021, 6)),
        ("2021-06-15", ("2021-06-15", 2021, 6)),
        ("2021-06-15T00:00:00Z", ("2021-06-15", 2021, 6)),
        ("0999", None),
        ("2999", None),
        ("soon", None),
        (None, None),
    ],
)
def test_partial_date(spark, raw, want):
    got = one(spark, lambda x: dates.partial_date(x, "2026-01-01"), raw)
    if want is None:
        assert got is None
    else:
        assert (got["date"] and str(got["date"]), got["year"]) == want[:2]


@pytest.mark.parametrize("start, end, unit, n", [("10:30:00", "12:00:00", "minute", 90), ("10:30:30", "12:00:30", "minute", 91), ("10:30:00", "12:00:00", "hour", 2), ("10:30:00", "10:30:00", "minute", 0)])
def test_intervals(spark, start, end, unit, n):
    df = spark.createDataFrame([(f"2024-01-01 {start}", f"2024-01-01 {end}")], "a string, b string")
    got = df.select(dates.intervals(F.col("a").cast("timestamp"), F.col("b").cast("timestamp"), unit).alias("x")).first()["x"]
    assert len(got) == n
    if n:
        assert str(got[0]["start"])[11:] == start


def test_urls(spark):
    assert one(spark, ids.url_host, "https://u@Example.org:8080/x") == "example.org:8080"
    assert one(spark, ids.registered_domain, "www.journals.ac.uk") == "journals.ac.uk"
    assert one(spark, ids.arxiv_versioned, "2301.12345") == "2301.12345v1"
    assert one(spark, ids.arxiv_versioned, "2301.12345v2") == "2301.12345v2"
    assert one(spark, ids.blob_path, "abcdef") == "ab/cd/abcdef"


@pytest.mark.parametrize(
    "raw, work, want",
    [
        ("https://web.archive.org/web/20200101000000/http://a/b.pdf", "w", "/work/w/access/wayback/http://a/b.pdf"),
        ("http://archive.org/download/item/a/b.pdf", "w", "/work/w/access/ia_file/item/a/b.pdf"),
        ("https://web.archive.org/web/2020id_/http://a/b.pdf", "w", "https://web.archive.org/web/2020id_/http://a/b.pdf"),
        ("https://web.archive.org/web/20200101000000/http://a/b.pdf", None, "https://web.archive.org/web/20200101000000/http://a/b.pdf"),
        ("https://example.org/x.pdf", "w", "https://example.org/x.pdf"),
        (None, "w", None),
    ],
)
def test_access_url(spark, raw, work, want):
    assert one(spark, lambda x: ids.access_url(x, F.lit(work).cast("string")), raw) == want


@pytest.mark.parametrize(
    "raw, want",
    [("", "direct"), (None, "direct"), ("https://papers.finder.example/list?q=x", "finder_papers"), ("https://www.Finder.example/", "finder"), ("https://www.other.example/", "other"), ("not an address", "other")],
)
def test_referrer_bucket(spark, raw, want):
    assert one(spark, lambda x: ids.referrer_bucket(x, (("finder_papers", "papers.finder."), ("finder", "finder."))), raw) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("10.1234/ABC", 'doi:"10.1234/ABC"'), ("https://doi.org/10.1234/abc", 'doi:"10.1234/abc"'), ("HTTP://dx.doi.org/10.1234/abc", 'doi:"10.1234/abc"'), ("pmc123", 'pmcid:"pmc123"'), ("2101.12345v2", 'arxiv_id:"2101.12345v2"'),
        ("math.GT/0309136", 'arxiv_id:"math.GT/0309136"'), ("hep-th/9901001", 'arxiv_id:"hep-th/9901001"'), ("arxiv:2101.12345", "arxiv:2101.12345"), ("10.12/x", "10.12/x"), ("free text", "free text"),
    ],
)
def test_identifier_query(spark, raw, want):
    assert one(spark, ids.identifier_query, raw) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("/CIT5", "CIT5"), ("_5", "5"), ("b12", "b12"), ("smith-2004-nature", "smith-2004-nature"), ("10.1002/(SICI)1097-0258(19980815)17:15-BIB3", "BIB3"), ("10.1371/journal_ref9", "ref9"), ("a-long-reference#cr7", "cr7"),
        ("long_reference_key", "key"), ("short_key", "short_key"), ("", "4"), (None, "4"), (" _x ", "x"),
    ],
)
def test_citation_key(spark, raw, want):
    assert one(spark, lambda x: text.citation_key(x, F.lit(4)), raw) == want


@pytest.mark.parametrize(
    "raw, want",
    [("Abstract This is it", "This is it"), ("Abstract Background: two words", "two words"), ("Summary one", None), ("N/a.", None), ("Abstract: kept as is", "Abstract: kept as is"), ("", None), (None, None), ("Abstract No Abstract ", None)],
)
def test_trim_abstract(spark, raw, want):
    assert one(spark, text.trim_abstract, raw) == want


def test_split_creators(spark):
    assert one(spark, text.split_creators, " Ada Li;B. Oz ; ;") == ["Ada Li", "B. Oz"]
