import pytest
from pyspark.sql import functions as F

from quire.functions import identifiers, text
from quire.operators import cluster, convert, documents, holdings, relational as rel, search, sinks, stats, webarchive

CROSSREF = """`DOI` string, type string, title array<string>, subtitle array<string>, `original-title` array<string>, `container-title` array<string>, `ISBN` array<string>,
 license array<struct<`URL`:string,`content-version`:string>>, reference array<struct<key:string,year:string,`DOI`:string,author:string,`journal-title`:string,`volume-title`:string,`article-title`:string,`first-page`:string,volume:string,issue:string,page:string,unstructured:string,`series-title`:string>>,
 publisher string, abstract string, language string, volume string, issue string, page string, issued struct<`date-parts`:array<array<int>>>,
 author array<struct<given:string,family:string,name:string,affiliation:array<struct<name:string>>>>, editor array<struct<given:string,family:string,name:string,affiliation:array<struct<name:string>>>>, translator array<struct<given:string,family:string,name:string,affiliation:array<struct<name:string>>>>"""


def records(spark, schema, *docs):
    import json

    return spark.createDataFrame([(json.dumps(d),) for d in docs], "v string").select(F.from_json("v", schema).alias("x")).select("x.*")


BASE = {"DOI": "10.1234/ABC", "type": "journal-article", "title": ["A title"], "issued": {"date-parts": [[2024, 1, 2]]}}


@pytest.mark.parametrize(
    "change, reason",
    [({}, None), ({"title": []}, "no-titles"), ({"title": ["A"]}, "short-title"), ({"title": ["OUP Accepted Manuscript"]}, "filtered-title"), ({"type": "journal"}, "filtered-type"), ({"DOI": ""}, "empty-doi"),
     ({"author": [{"family": "x"}] * 2001}, "too-many-authors"), ({"reference": [{"key": "k"}] * 5001}, "too-many-refs")],
)
def test_crossref_skips(spark, change, reason):
    assert convert.crossref(records(spark, CROSSREF, BASE | change)).first()["skip_reason"] == reason


def test_crossref(spark):
    doc = BASE | {
        "license": [{"URL": "https://creativecommons.org/licenses/by/4.0/", "content-version": "vor"}, {"URL": "https://creativecommons.org/licenses/by-nc/4.0/", "content-version": "unspecified"}, {"URL": "http://x", "content-version": "tdm"}],
        "author": [{"given": "Ada", "family": "L", "affiliation": [{"name": ""}, {"name": "U"}]}, {"name": "Group"}], "abstract": "<p>" + "x" * 76 + "</p>", "reference": [{"key": "10.1234/ABCref1", "year": "1999", "journal-title": "J"}],
    }
    r = convert.accepted(convert.crossref(records(spark, CROSSREF, doc))).first()
    assert r["extids"] == {"doi": "10.1234/abc"} and r["release_type"] == "article-journal" and str(r["release_date"]) == "2024-01-02" and r["release_year"] is None
    assert r["license_slug"] == "CC-BY-NC" and [c["raw_name"] for c in r["contribs"]] == ["Ada L", "Group"] and r["contribs"][0]["raw_affiliation"] == "U"
    assert r["abstracts"][0]["content"] == "x" * 76 and r["refs"][0]["key"] == "ref1" and r["refs"][0]["year"] == 1999
    csl = convert.csl_json(spark.createDataFrame([r], convert.accepted(convert.crossref(records(spark, CROSSREF, doc))).schema)).first()["csl"]
    assert '"DOI":"10.1234/abc"' in csl and "volume" not in csl


def test_arxiv(spark):
    schema = "id string, status string, title string, authors array<struct<keyname:string,forename:string,suffix:string,affiliation:string>>, abstract string, doi string, created string, updated string, license string, journal_ref string, report_no string"
    df = records(spark, schema, {"id": "2301.1", "title": "T", "authors": [], "journal_ref": "Proc. of X", "created": "2023-01-02"}, {"id": "2301.2v3", "title": "T", "authors": [], "report_no": "R1"}, {"id": "", "title": "T", "authors": []}, {"id": "1", "status": "deleted", "title": "T", "authors": []})
    rows = convert.arxiv(df).collect()
    assert [r["release_type"] for r in rows[:2]] == ["paper-conference", "report"] and rows[0]["extids"]["arxiv"] == "2301.1v1" and [r["skip_reason"] for r in rows] == [None, None, "no-arxiv-id", "deleted"]


def test_datacite(spark):
    schema = """doi string, titles array<struct<title:string,titleType:string>>, types struct<resourceType:string,resourceTypeGeneral:string,citeproc:string,ris:string,bibtex:string,schemaOrg:string>,
     creators array<struct<name:string,givenName:string,familyName:string,contributorType:string,affiliation:array<struct<name:string>>>>, contributors array<struct<name:string,givenName:string,familyName:string,contributorType:string,affiliation:array<struct<name:string>>>>,
     descriptions array<struct<description:string,descriptionType:string>>, dates array<struct<date:string,dateType:string>>, rightsList array<struct<rightsUri:string>>, container struct<volume:string,issue:string,firstPage:string,lastPage:string>, publicationYear int, publisher string, language string, version string"""
    df = records(
        spark, schema,
        {"doi": "10.5/X", "titles": [{"title": "Sub", "titleType": "Subtitle"}, {"title": "Main"}], "types": {"ris": "DATA"}, "creators": [{"name": "A"}, {"name": "A"}, {"name": "(:unav)"}], "contributors": [], "dates": [{"date": "2020", "dateType": "Issued"}, {"date": "2021-06", "dateType": "Created"}], "rightsList": []},
        {"doi": "10.5/y", "titles": [{"title": "Watch full movie online free HD"}], "creators": [], "contributors": [], "dates": [], "rightsList": []},
    )
    a, b = convert.datacite(df, "2026-01-01").collect()
    assert a["title"] == "Main" and a["subtitle"] == "Sub" and a["release_type"] == "dataset" and a["release_year"] == 2021 and len(a["contribs"]) == 1
    assert b["skip_reason"] == "spam-title"


def eligible_releases(years=(2010, 2011), volumes=("1", "2"), n=50, **more):
    rows = []
    for y, v in zip(years, volumes, strict=True):
        rows += [{"container_id": 1, "release_type": "article-journal", "preservation": "bright", "year": y, "volume": v}] * n
    return rows + more.get("extra", [])


def article(p="none", y=None, v=None, t="article-journal", n=1):
    return [{"container_id": 1, "release_type": t, "preservation": p, "year": y, "volume": v}] * n


@pytest.mark.parametrize(
    "container, rows, status",
    [
        ({}, eligible_releases(), "success"),
        ({"container_type": "magazine"}, eligible_releases(), "container-type"),
        ({"issnl": ""}, eligible_releases(), "missing-issnl"),
        ({"issne": ""}, eligible_releases(), "missing-issn"),
        ({"issne": "", "extra": '{"issnp": "1234-5678"}'}, eligible_releases(), "success"),
        ({}, eligible_releases(n=5), "few-releases"),
        ({}, eligible_releases(extra=article(n=30)), "low-overall-preservation-fraction"),
        ({}, article("bright", t="dataset", n=90) + article("bright", n=10), "few-papers"),
        ({}, article("bright", t="dataset", n=50) + article("bright", n=50), "low-paper-fraction"),
        ({}, article("bright", n=50), "no-year-spans"),
        ({}, article("bright", 2010, n=50), "no-volume-spans"),
        ({}, eligible_releases((2010,), ("1",)), "short-preserved-year-spans"),
        ({}, eligible_releases(extra=article("dark", 2011, "3")), "short-preserved-year-spans"),
        ({}, eligible_releases((2010, 2012)), "non-contiguous-years"),
        ({}, eligible_releases(volumes=("1", "3")), "non-contiguous-volumes"),
        ({}, eligible_releases(volumes=("1", "2A")), "non-integer-volumes"),
    ],
)
def test_holdings_statuses(spark, container, rows, status):
    base = {"container_id": 1, "name": "Test Journal", "publisher": "P", "container_type": None, "issnl": "1234-5678", "issne": "1234-5678", "issnp": None, "extra": None}
    c = spark.createDataFrame([base | container], "container_id long, name string, publisher string, container_type string, issnl string, issne string, issnp string, extra string")
    r = spark.createDataFrame(rows, "container_id long, release_type string, preservation string, year int, volume string")
    e = holdings.eligibility(c, holdings.spans(r))
    assert e.first()["status"] == status
    if status == "success":
        row = holdings.rows(e, 2011).first()
        assert (row["date_last_issue_online"], row["num_last_vol_online"], row["linking_issn"]) == ("2010", "1", "1234-5678")


def test_holdings_file(spark, tmp_path):
    r = spark.createDataFrame([tuple("x" for _ in holdings.FIELDS)], ", ".join(f"{f} string" for f in holdings.FIELDS))
    holdings.write_tsv(holdings.combined(r, r), str(tmp_path / "k"))
    text_ = b"".join(p.read_bytes() for p in sorted((tmp_path / "k").glob("part-*")))
    assert text_.count(b"\r\n") == 3 and text_.count(b"publication_type") == 1


def test_words_of_a_query(spark):
    df = spark.createDataFrame([(1, "en", "The Cat"), (2, "de", "a dog"), (3, None, "cat and dog"), (4, "en", None)], "id int, lang string, text string")
    ask = lambda *must, **k: sorted(r["id"] for r in df.where(search.bool_filter(must, **k)).collect())
    words = lambda q: search.contains_all(q, ["text", "lang"])
    assert ask(words("cat")) == [1, 3] and ask(words("cat DOG")) == [3] and ask(words("")) == [1, 2, 3, 4] and ask(words("en")) == [1, 4]
    assert ask(words("a"), must_not=[F.col("lang") == "de"]) == [1, 3] and ask(should=[F.col("lang") == "en", F.col("lang") == "de"]) == [1, 2, 4]


def test_shown_total(spark):
    row = lambda total, est, shown, offset: tuple(spark.range(1).select(search.shown_total(F.lit(total), F.lit(est), F.lit(shown), offset, 20).alias("t")).first()["t"])
    assert row(1000, True, 20, 0) == (1000, True) and row(1000, True, 7, 0) == (7, False) and row(1000, True, 7, 20) == (1000, True) and row(0, False, 0, 0) == (0, False)


def test_facets(spark):
    df = spark.createDataFrame([("2024-01-10", "report"), ("2020-01-01", "chapter")], "d string, t string").withColumn("d", F.to_date("d"))
    assert df.where(search.date_facet("d", "past_week", "2024-01-12")).count() == 1 and df.where(search.date_facet("d", "junk", "2024-01-12")).count() == 2
    assert df.where(search.date_facet("d", "since_2000", "2024-01-12")).count() == 2 and df.where(search.date_facet("d", "before_1931", "2024-01-12")).count() == 0
    assert df.where(search.type_facet("t", "reports")).count() == 1 and df.where(search.type_facet("t", "junk")).count() == 1 and df.where(search.type_facet("t", "everything")).count() == 2
    some = spark.createDataFrame([(["wayback"], ["oa"]), (["ia_sim", "x"], []), (["x"], ["oa"])], "a array<string>, tags array<string>")
    assert [some.where(search.access_facet("a", "tags", n)).count() for n in ("fulltext", "microfilm", "oa", "everything", "junk")] == [2, 1, 2, 3, 2]
    assert df.where(search.drill_down("t", None, True)).count() == 0 and df.where(search.drill_down("t", None, False)).count() == 2


def test_release_documents(spark):
    rel_ = spark.createDataFrame(
        [("r1", "c1", "T", "post", None, 2020, "1", "2", "10-20", "CC-BY", {"doi": "10.1101/x"}, None), ("r2", "c2", "T", "article-journal", None, 2020, None, None, None, None, {"arxiv": "1v1"}, None)],
        "id string, container_id string, title string, release_type string, release_date date, release_year int, volume string, issue string, pages string, license_slug string, extids map<string,string>, extra string",
    ).withColumn("contribs", F.expr("array(struct(null as raw_name, 'Ada' as given_name, 'L' as surname))")).withColumn("refs", F.array())
    con = spark.createDataFrame([("c1", None, None, None)], "container_id string, name string, extra string, publisher_type string")
    files = spark.createDataFrame([("r1", 0, 1, "https://web.archive.org/web/1/x.pdf"), ("r1", 0, 0, "https://web.archive.org/web/2/z.pdf"), ("r1", 1, 0, "https://other.org/x.pdf")], "release_id string, file_index int, url_index int, url string")
    a, b = documents.release_documents(rel_, con, files).orderBy("id").collect()
    assert a["preservation"] == "bright" and a["is_oa"] and a["container_name"] == "biorxiv/medrxiv" and a["release_type"] == "article" and a["first_page"] == "10" and a["tags"] == ["oa"] and a["contrib_names"] == "Ada L"
    assert a["best_pdf_url"] == "https://web.archive.org/web/2/z.pdf" and a["file_count"] == 2
    assert b["preservation"] == "dark" and not b["is_oa"] and b["container_name"] == "arXiv" and b["file_count"] == 0


def test_upserts_are_idempotent(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "x"), (3, "c"), (3, "d")], "k int, v string")
    once = rel.insert_ignore(t, new, ["k"])
    assert once.count() == 3 and rel.insert_ignore(once, new, ["k"]).count() == 3 and rel.new_rows(new, once, ["k"]).count() == 0
    assert sorted(r["v"] for r in rel.replace_rows(t, new.limit(1), ["k"]).collect()) == ["a", "x"]


def test_series_labels(spark):
    df = spark.createDataFrame([(1, 0, None), (2, 0, 0), (3, 4, 0), (4, 3, 4)], "i int, n int, p int")
    assert [r["c"] for r in df.orderBy("i").select(stats.change_label(F.col("n"), F.col("p")).alias("c")).collect()] == ["?", "0", "∞", "-25"]


def test_hops(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x")], "url string, next string")
    starts = spark.createDataFrame([("a",), ("x",)], "url string")
    got = {r["start"]: (r["url"], r["outcome"]) for r in webarchive.hops(starts, links).collect()}
    assert got == {"a": ("c", "end"), "x": ("y", "loop")}


def test_full_text_links(spark):
    pages = [
        ('<meta name="citation_pdf_url" content="/a.pdf">', "https://x.org/p", ("https://x.org/a.pdf", "citation_pdf_url", False)),
        ('<a class="download-pdf big" href="b.pdf">', "https://x.org/p/", ("https://x.org/p/b.pdf", "download-pdf", False)),
        ("", None, (None, None, False)),
        (None, "https://x.org", (None, None, False)),
        ('<script>pdfUrl = "https:\\/\\/r.mx\\/1.pdf";</script>', "https://r.mx/article/view/1/2", ("https://r.mx/1.pdf", "jspdfurl", False)),
        ('{"pdfPath":"/iel7/1/2.pdf"}', "https://ieeexplore.ieee.org/document/1", ("https://ieeexplore.ieee.org/iel7/1/2.pdf", "ieeejs", True)),
        ('<noscript><a href="no"></a></noscript><noscript><p><a href="/f.pdf">x</a></p></noscript>', "https://m.de/receive/1", ("https://m.de/f.pdf", "mycore-receive", False)),
        ('<meta name="citation_issn" content="1"><meta name="citation_id" content="2">', "https://www.sciengine.com/x", ("https://www.sciengine.com/cfs/files/pdfs/view/1/2.pdf", "sciengine", False)),
        ('<div class="widget-files"><a href="/doc">x</a></div><embed alt="pdf" src="e">', "https://hal.science/1", ("https://hal.science/e", "pdf-embed-alt", False)),
        ('<section class="col-md-8"><a target="_blank" class="button button--primary" href="https://o.org">x</a></section>', "https://doaj.org/article/1", ("https://o.org", "doaj-access-link", True)),
        ('<a class="pdf" href="/x">no</a><a class="obj_galley_link file" href="g">x</a>', "https://j.org/article/view/1", ("https://j.org/article/view/g", "ojs-remote-pdf", True)),
    ]
    df = spark.createDataFrame([(i, h, u) for i, (h, u, _) in enumerate(pages)], "i int, html string, base string")
    got = [tuple(r["l"]) for r in df.select("i", webarchive.full_text_link("html", "base").alias("l")).orderBy("i").collect()]
    assert got == [w for _, _, w in pages]


@pytest.mark.parametrize(
    "url, want",
    [
        ("https://arxiv.org/abs/1234.5", "https://arxiv.org/pdf/1234.5"),
        ("https://arxiv.org/pdf/1234.5.pdf", "https://arxiv.org/pdf/1234.5"),
        ("https://onlinelibrary.wiley.com/doi/10.1/doi", "https://onlinelibrary.wiley.com/doi/pdf/10.1/doi"),
        ("https://www.protocols.io/view/x", "https://www.protocols.io/view/x.pdf"),
        ("https://journals.sagepub.com/doi/pdf/10.1177/2", "https://journals.sagepub.com/doi/pdf/10.1177/2?download=true"),
        ("https://pubs.acs.org/doi/10.1021/acs.9#", "https://pubs.acs.org/doi/pdf/10.1021/acs.9?ref=article_openPDF"),
        ("https://www.jcancer.org/v16p1684.html", "https://www.jcancer.org/v16p1684.pdf"),
        ("https://www.jcancer.org/v16p1684.htm", "https://www.jcancer.org/v16p1684.pdf"),
        ("https://www.tandfonline.com/doi/full/10.1080/1", "https://www.tandfonline.com/doi/pdf/10.1080/1"),
        ("https://www.journals.uchicago.edu/doi/10.14318/h", "https://www.journals.uchicago.edu/doi/epdf/10.14318/h"),
        ("https://www.worldscientific.com/doi/abs/10.1142/S", "https://www.worldscientific.com/doi/pdf/10.1142/S?download=true"),
        ("https://www.ahajournals.org/doi/pdf/10.1/x", "https://www.ahajournals.org/doi/pdf/10.1/x"),
        ("https://ehp.niehs.nih.gov/doi/full/10.1289/E", "https://ehp.niehs.nih.gov/doi/pdf/10.1289/E?download=true"),
        ("https://ehp.niehs.nih.gov/doi/10.1289/e.1", "https://ehp.niehs.nih.gov/doi/pdf/10.1289/e.1?download=true"),
        ("https://publications.rwth-aachen.de/record/986268/", "https://publications.rwth-aachen.de/record/986268/files/986268.pdf"),
        ("https://mhealth.jmir.org/2020/7/e17891/", "https://mhealth.jmir.org/2020/7/e17891/PDF"),
        ("https://array.aami.org/doi/10.2345/0", "https://array.aami.org/doi/pdf/10.2345/0?download=true"),
        ("https://drive.google.com/file/d/0123456789ab/view?x", "https://drive.google.com/uc?export=download&id=0123456789ab"),
        ("https://drive.google.com/file/d/short/view", "https://drive.google.com/file/d/short/view"),
        ("https://example.org/a", "https://example.org/a"),
    ],
)
def test_known_rewrite(spark, url, want):
    assert spark.range(1).select(webarchive.known_rewrite(F.lit(url)).alias("u")).first()["u"] == want


@pytest.mark.parametrize(
    "kind, ids_, want",
    [("dataset", {"doi": "10.1/x"}, "not-paperlike"), (None, {"doi": "10.1/x"}, "not-paperlike"), ("book", {}, "no-extids"), ("book", {"doi": "10.9/x"}, "doi-prefix-blocked:10.9/"), ("thesis", {"mag": "1"}, "no-fulltext-urls"), ("chapter", {"doi": "10.1/x"}, None)],
)
def test_crawl_skip(spark, kind, ids_, want):
    df = spark.createDataFrame([(kind, ids_)], "k string, ids map<string,string>")
    urls = identifiers.full_text_urls(F.col("ids"), F.lit(None).cast("string"))
    assert df.select(webarchive.crawl_skip(F.col("k"), F.col("ids"), urls, ("10.9/",)).alias("r")).first()["r"] == want


def test_dates_by_type(spark):
    one = lambda *d: spark.createDataFrame([(list(d),)], "d array<struct<date:string,dateType:string>>").select(convert.best_date(F.col("d"), "2026-01-01").alias("x")).first()["x"]
    got = one(("2019", "Issued"), ("soon", "Valid"), ("2020-02-03", "Created"), ("2018-05", "Available"))
    assert (got["date"], got["year"], got["month"]) == (None, 2018, 5)
    assert one(("2019", "Issued"), ("2017", "Other"))["year"] == 2019 and one(("x", "Valid")) is None and one() is None
    assert str(one(("bad", "Valid"), ("2001-02-03", "Valid"))["date"]) == "2001-02-03"


def test_first_abstracts(spark):
    df = spark.createDataFrame([([("Abstract only", "en"), ("Abstract two words", "en"), ("later one here", "en"), ("deux mots", "fr"), ("no language here", None)],)], "a array<struct<content:string,language:string>>")
    assert [tuple(x) for x in df.select(text.first_abstracts(F.col("a")).alias("x")).first()["x"]] == [("two words", "en"), ("deux mots", "fr"), ("no language here", None)]


def test_shards(spark):
    got = sinks.sharded(spark.range(95).repartition(7), "id", 10).groupBy("shard").count().collect()
    assert sorted((r["shard"], r["count"]) for r in got) == [(i, 10) for i in range(9)] + [(9, 5)]


def test_match_titles(spark):
    left = spark.createDataFrame([(1, "Neural networks predicting weather patterns")], "id int, title string")
    right = spark.createDataFrame([(7, "predicting weather with neural models"), (8, "weather")], "target int, title string")
    assert [(r["id"], r["target"], r["shared"]) for r in cluster.match_titles(left, right).collect()] == [(1, 7, 3)]
    left = left.withColumn("creators", F.lit("Ada Li; B. Oz"))
    right = right.unionByName(spark.createDataFrame([(9, "weather patterns")], "target int, title string")).withColumn("contrib_names", F.when(F.col("target") == 9, "b. oz"))
    assert [(r["id"], r["target"]) for r in cluster.best_match(left, right).collect()] == [(1, 9)]
    assert [(r["id"], r["target"]) for r in cluster.best_match(left.withColumn("creators", F.lit(None).cast("string")), right).collect()] == [(1, 7)]


def test_clusters(spark):
    df = spark.createDataFrame([(1, "A b!"), (2, "ab"), (3, "c"), (4, None), (5, "--"), (6, "A-B")], "id int, title string")
    assert [tuple(r) for r in cluster.clusters(df, "id", "title").collect()] == [("ab", 3, 1, 6)]
    assert sorted(tuple(r) for r in cluster.members(df, "id", "title").collect()) == [("ab", 3, 1), ("ab", 3, 2), ("ab", 3, 6)]


def test_collapse_and_first_of(spark):
    df = spark.createDataFrame([("x", 3, "a"), ("y", 3, "b"), ("x", 5, "c"), (None, 1, None), (None, 1, "d")], "k string, n int, v string")
    assert sorted((tuple(r) for r in rel.collapse(df, "k", [-F.col("n"), F.col("v")]).collect()), key=str) == sorted([("x", 5, "c", 2), ("y", 3, "b", 1), (None, 1, None, 2)], key=str)
    assert rel.first_of(df.select("n", "k", "v"), "k", [F.col("n")]).where("k = 'x'").first() == (3, "x", "a")


def test_lookup_first(spark):
    rows = spark.createDataFrame([(1, "p", "q"), (2, None, "q"), (3, "z", "z")], "row_id int, pmid string, doi string")
    table = spark.createDataFrame([("pmid", "p", "A"), ("doi", "q", "B")], "key string, value string, id string")
    assert {r["row_id"]: r["id"] for r in rel.lookup_first(rows, table, ["pmid", "doi"], "id").collect()} == {1: "A", 2: "B", 3: None}


def test_pipeline_of_columns(spark):
    f = text.pipeline(F.trim, F.upper)
    assert spark.range(1).select(f(F.lit(" a ")).alias("x")).first()["x"] == "A"


@pytest.mark.parametrize("coalesced", ["true", "false"])
def test_shards_of_many_wide_rows(spark, coalesced):
    """1.5 million rows with long addresses: all rows are there, all shards are consecutive and full, whatever the partitions become."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, coalesced)
    try:
        n = 1_500_000
        key = F.lpad(F.pmod(F.col("id") * 7919, F.lit(n)).cast("string"), 7, "0")
        wide = spark.range(n).select(F.concat(key, F.lit("/" + "x" * 248)).alias("url"), "id").repartition(13)
        at = F.substring("url", 1, 7).cast("long")
        got = sinks.sharded(wide, "url", 1000).groupBy("shard").agg(F.count("*").alias("n"), F.min(at).alias("a"), F.max(at).alias("b")).collect()
        assert sorted(tuple(r) for r in got) == [(i, 1000, 1000 * i, 1000 * i + 999) for i in range(1500)]
    finally:
        spark.conf.unset(name)


def test_numbers_with_ties_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(x, i) for i, x in enumerate([None, "b", "a", "a", None, "c"] * 20)], "k string, i int")
    rows = sinks.numbered(df, "k").orderBy("n").collect()
    assert [r["n"] for r in rows] == list(range(120)) and [r["k"] for r in rows] == [None] * 40 + ["a"] * 40 + ["b"] * 20 + ["c"] * 20
    assert sinks.numbered(df.limit(0), "k").count() == 0


def test_sitemap_lines(spark):
    rows = [("w1", "wayback", "https://web.archive.org/web/20200101000000/http://a/b"), ("w2", "wayback", "https://web.archive.org/web/202001010000/http://a/b"), ("w3", "ia_file", "http://archive.org/download/i/x/y.pdf"), ("w4", "wayback", ""), ("", "wayback", "x"), (None, None, None), ("w5", None, None)]
    got = sinks.sitemap_lines(spark.createDataFrame(rows, "ident string, access_type string, access_url string"), "B").collect()
    assert sorted(map(tuple, got)) == [("access", "B/work/w1/access/wayback/http://a/b"), ("access", "B/work/w3/access/ia_file/i/x/y.pdf"), *(("works", f"B/work/w{i}") for i in range(1, 6))]


def test_substrings_are_those_of_a_nested_loop(spark):
    import itertools
    import random

    from quire.operators import relational

    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abä ") for _ in range(rng.randint(0, n)))
    texts, patterns = [(i, word(12)) for i in range(200)] + [(300, None), (301, ""), (302, "aaaa")], [(word(6),) for _ in range(60)] + [("a",), ("ab",), ("a",), ("",), (None,), ("zzz",)]
    got = relational.by_substring(spark.createDataFrame(texts, "i int, t string"), "t", spark.createDataFrame(patterns, "p string"), "p").collect()
    known = {p for (p,) in patterns if p}
    assert sorted((r["i"], r["p"]) for r in got) == sorted((i, p) for (i, t), p in itertools.product(texts, known) if t and p in t)


def test_registered_domains(spark):
    from quire.operators import webarchive

    want = {
        "a.b.example.com": "example.com", "example.com": "example.com", "com": None, "x.co.uk": "x.co.uk", "co.uk": None, "uk": None, "a.uk": "a.uk", "b.c.kobe.jp": "b.c.kobe.jp", "c.kobe.jp": None, "a.city.kobe.jp": "city.kobe.jp", "city.kobe.jp": "city.kobe.jp",
        "EXAMPLE.com:80": "example.com", "example.com.": "example.com", "unlisted.zone": "unlisted.zone", "a.unlisted.zone": "unlisted.zone", "localhost": None, "1.2.3.4": None, "": None, ".com": None, None: None,
    }
    rules = spark.createDataFrame([("com",), ("uk",), ("co.uk",), ("jp",), ("*.kobe.jp",), ("!city.kobe.jp",)], "rule string")
    rows = webarchive.registered_domains(spark.createDataFrame([(h,) for h in [*want, "example.com"]], "host string"), "host", rules).collect()
    assert len(rows) == len(want) + 1 and all(want[r["host"]] == r["domain"] for r in rows)


def test_merges_rewrite_what_they_touch(spark, tmp_path):
    """Files of untouched buckets keep their names, older versions can be read, a merge that fails or comes second changes nothing."""
    from quire.operators import buckets

    path = str(tmp_path / "t")
    frame = lambda rows: spark.createDataFrame(rows, "k int, v string")
    at = lambda version=None: {r["k"]: r["v"] for r in buckets.read(spark, path, version).collect()}
    buckets.create(frame([(i, "a") for i in range(100)]), path, ["k"], 8)
    files = buckets.files(path)
    touched = buckets.merge(spark, path, frame([(5, "b"), (500, "c")]), frame([(6, "")]).select("k"))
    assert at() == {**{i: "a" for i in range(100) if i not in (5, 6)}, 5: "b", 500: "c"} and at(0) == dict.fromkeys(range(100), "a")
    assert 1 <= len(touched) <= 3 and {f for f in files if f.split("bucket=")[1][0] not in touched} == files & buckets.files(path)
    before = buckets.versions(path)
    with pytest.raises(ValueError, match="several new rows"):
        buckets.merge(spark, path, frame([(1, "x"), (1, "y")]))
    with pytest.raises(Exception):  # noqa: B017  a row that cannot be made fails while files are written
        buckets.merge(spark, path, spark.sql("SELECT 1 AS k, raise_error('no') AS v").selectExpr("k", "cast(v AS string) v"))
    assert buckets.versions(path) == before and at()[1] == "a"
    assert buckets.merge(spark, path, frame([])) == [] and len(at()) == 100
    with pytest.raises(RuntimeError, match="another merge"):
        buckets._publish(path, buckets.manifest(path, 0) | {"version": 1})


@pytest.mark.parametrize(
    "body, header, want",
    [
        (b"\xef\xbb\xbfa", "text/html; charset=latin1", "a"), (b"\xff\xfea\x00", None, "a"), (b"\xfe\xff\x00a", "utf-8", "a"), (b"\xe4", "text/html; charset='iso-8859-1'", "ä"), (b"\x80", "latin1", "€"), (b"\xe4", None, "ä"), ("ä€".encode(), None, "ä€"), ("ä".encode() + b"\xc3", None, "Ã¤Ã"),
        (b"<meta http-equiv=content-type content='text/html; charset=shift_jis'>\x82\xa0", "text/html", "<meta http-equiv=content-type content='text/html; charset=shift_jis'>あ"), (b"<meta charset=utf-16>a", None, "<meta charset=utf-16>a"), (b"<meta charset=none-such>\xe4", None, "<meta charset=none-such>ä"),
        (b" " * 2000 + b"<meta charset=koi8-r>\xe4", None, " " * 2000 + "<meta charset=koi8-r>ä"), (b"", None, ""), (None, "utf-8", None), (b"<meta charset=koi8-r>\xc1", "text/html; charset=bad", "<meta charset=koi8-r>а"),
    ],
)
def test_character_sets(spark, body, header, want):
    from quire.functions import text

    assert spark.createDataFrame([(body, header)], "b binary, h string").select(text.decoded("b", "h")).first()[0] == want


def test_citations(spark):
    from quire.operators import entities

    releases = spark.createDataFrame([(1, "10.1234/A", "deep learning methods applied", 2001, "Ada Li"), (2, None, "deep learning methods applied", 2002, "Bo Oz"), (3, None, None, None, None)], "id int, doi string, title string, release_year int, contrib_names string")
    refs = [
        ("a", "https://doi.org/10.1234/a", "x", 1, None), ("b", "10.1234/zz", "deep learning methods applied", 2001, None), ("c", None, "deep learning methods applied", 2002, "Oz, Bo"), ("d", None, "deep learning methods applied", 1900, "Nobody"), ("e", None, "deep learning methods applied", None, None),
        ("f", None, None, None, None), ("g", "10.9999/f", None, None, None), ("h", None, "deep learning methods applied Archived 2019 at x", None, None), ("i", None, "wholly different matters entirely", None, None),
    ]
    got = entities.match_citations(spark.createDataFrame(refs, "ref_id string, doi string, title string, year int, creators string"), releases, spark.createDataFrame([(9, "10.9999/F")], "id int, doi string")).collect()
    assert {r["ref_id"]: (r["id"], r["status"]) for r in got} == {"a": (1, "exact"), "b": (None, "unknown"), "c": (2, "fuzzy"), "d": (None, "refused"), "e": (1, "fuzzy"), "f": (None, "refused"), "g": (9, "fallback"), "h": (1, "fuzzy"), "i": (None, "refused")}
    assert {r["ref_id"]: r["score"] for r in got}["c"] == 100.0


def test_unseen_captures_are_the_first(spark):
    rows = [(k, f"d{k % 3}") for k in range(9, 0, -1)] + [(0, None)]
    captures = spark.createDataFrame(rows, "page_id long, sha1_hex string").repartition(4)
    files = spark.createDataFrame([("d2",), (None,)], "sha1 string")
    got = webarchive.unseen(captures, files, "page_id")
    assert got.columns == captures.columns and sorted(map(tuple, got.collect())) == [(1, "d1"), (3, "d0")]
