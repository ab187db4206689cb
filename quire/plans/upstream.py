"""Named queries over upstream records: made from the tables, written as files to the shared folder, read and converted again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators import convert, entities, sinks
from quire.plans.catalog import query, rd
from quire.sources import readers
from quire.streaming import ingest

CROSSREF = """`DOI` string, type string, title array<string>, subtitle array<string>, `original-title` array<string>, `container-title` array<string>, `ISBN` array<string>,
 license array<struct<`URL`:string,`content-version`:string>>, reference array<struct<key:string,year:string,`DOI`:string,author:string,`journal-title`:string,`volume-title`:string,`article-title`:string,`first-page`:string,volume:string,issue:string,page:string,unstructured:string,`series-title`:string>>,
 publisher string, abstract string, language string, volume string, issue string, page string, issued struct<`date-parts`:array<array<int>>>,
 author array<struct<given:string,family:string,name:string,affiliation:array<struct<name:string>>>>, editor array<struct<given:string,family:string,name:string,affiliation:array<struct<name:string>>>>, translator array<struct<given:string,family:string,name:string,affiliation:array<struct<name:string>>>>"""
DATACITE = """doi string, titles array<struct<title:string,titleType:string>>, types struct<citeproc:string,ris:string,schemaOrg:string,bibtex:string,resourceTypeGeneral:string,resourceType:string>, dates array<struct<date:string,dateType:string>>,
 creators array<struct<name:string,nameType:string,givenName:string,familyName:string,affiliation:array<struct<name:string>>,nameIdentifiers:array<struct<nameIdentifier:string,nameIdentifierScheme:string>>>>, contributors array<struct<name:string,nameType:string,givenName:string,familyName:string,contributorType:string,affiliation:array<struct<name:string>>>>,
 relatedIdentifiers array<struct<relationType:string,relatedIdentifier:string,relatedIdentifierType:string>>, published string,
 language string, descriptions array<struct<description:string,descriptionType:string>>, rightsList array<struct<rightsUri:string>>, publicationYear int, container struct<volume:string,issue:string,firstPage:string,lastPage:string>, publisher string, version string"""
ARXIV = "identifier string, status string, datestamp string, id string, title string, authors array<struct<forename:string,keyname:string,suffix:string,affiliation:string>>, abstract string, doi string, created string, updated string, license string, journal_ref string, report_no string"
DOAJ = "id string, status string, title string, publisher string, publication_date string, doi string, language string, abstract string, authors array<struct<name:string,affiliation:string,orcid_id:string>>, license_ref string, volume string, issue string, start_page string, end_page string"
PUBMED = """pmid string, title string, vernacular_title string, publication_types array<string>, authors array<struct<fore_name:string,last_name:string,collective_name:string,affiliation:string,more_affiliations:array<string>>>, year string, month string, day string, medline_date string, language string,
 abstract_parts array<struct<label:string,category:string,text:string>>, article_ids array<struct<id_type:string,value:string>>, electronic struct<year:string,month:string,day:string>, elocation_ids array<struct<id_type:string,valid:string,value:string>>, corrections array<struct<ref_type:string,ref_source:string,pmid:string>>,
 other_abstracts array<struct<language:string,texts:array<string>>>, complete_authors string, volume string, issue string, pages string, n_refs long"""
OPENALEX = "ids struct<openalex:string,pmid:string,pmcid:string,mag:string>, doi string, title string, authorships array<struct<raw_author_name:string>>, biblio struct<first_page:string,last_page:string,volume:string,issue:string>, publication_date string, publication_year int, language string"
DBLP = "key string, title string, author array<string>, year string, volume string, number string, pages string, ee array<string>"


def place(spark, name: str) -> str:
    return f"{sinks.shared_folder(spark)}/quire-{name}-{uuid.uuid4().hex}"


def reread(df: DataFrame, name: str, schema: str) -> DataFrame:
    """The rows as packed JSON lines, read again; a file a task, so rows come dealt out."""
    path = place(df.sparkSession, name)
    sinks.write_json(df, path, compression="gzip")
    return readers.json_lines(df.sparkSession, path, schema)


RECORDS = 200_000  # records of a task and file


def orders(spark, sf) -> DataFrame:
    """o_orderkey, its text, and the parts of the order's date; dealt out while rows are narrow, as a table of one file would be made into records and written in one task."""
    o = rd(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.to_date("o_orderdate").alias("d"))
    o = o.repartition(max(spark.sparkContext.defaultParallelism, -(-o.count() // RECORDS)))
    o = o.select(F.col("o_orderkey").alias("k"), F.col("o_orderkey").cast("string").alias("s"), F.col("o_custkey").cast("string").alias("c"), F.col("o_orderpriority").alias("p"), "d")
    return o.withColumn("day", F.date_format("d", "yyyy-MM-dd"))


O = "o AS (SELECT o_orderkey AS k, CAST(o_custkey AS VARCHAR) AS c, o_orderpriority AS p, CAST(o_orderdate AS DATE) AS d FROM orders)"
TEXT = lambda *x: F.concat(*(F.lit(v) if isinstance(v, str) else v for v in x))


def shown(df: DataFrame, *more) -> DataFrame:
    """What the queries compare of a release."""
    return df.select("id", "title", "release_type", "release_date", "release_year", F.try_element_at("extids", F.lit("doi")).alias("doi"), F.size("contribs").alias("n_contribs"), F.try_element_at("contribs", F.lit(1))["raw_name"].alias("first_name"), "skip_reason", *more)


@query(f"""WITH {O}, r AS (SELECT *, CASE WHEN k % 10 <> 0 THEN '10.5555/o' || k END AS doi, CASE WHEN k % 17 = 0 THEN NULL WHEN k % 19 = 0 THEN 'x' ELSE 'Order ' || k END AS title FROM o)
SELECT 'crossref-' || sha1(doi) AS id, title, CASE p WHEN '1-URGENT' THEN 'article-journal' WHEN '2-HIGH' THEN 'chapter' WHEN '3-MEDIUM' THEN 'dataset' WHEN '5-LOW' THEN 'post' END AS release_type, CASE WHEN k % 3 <> 0 THEN d END AS release_date,
  CASE WHEN k % 3 = 0 THEN CAST(year(d) AS INT) END AS release_year, doi, CASE WHEN k % 5 = 0 THEN 2 ELSE 1 END AS n_contribs, CASE WHEN k % 4 = 0 THEN 'Group ' || c ELSE 'A' || c || ' B' END AS first_name,
  CASE WHEN title IS NULL THEN 'no-titles' WHEN title = 'x' THEN 'short-title' WHEN p = '4-NOT SPECIFIED' THEN 'filtered-type' WHEN doi IS NULL THEN 'empty-doi' END AS skip_reason,
  CASE WHEN k % 2 = 0 THEN 'CC-BY' END AS license_slug, CASE WHEN k % 6 = 0 THEN 1 ELSE 0 END AS n_refs, CASE WHEN k % 6 = 0 THEN '_ref' || c END AS ref_key, CASE WHEN p IN ('1-URGENT', '2-HIGH') THEN 'published' END AS release_stage FROM r""")
def crossref_works(spark, sf):
    o = orders(spark, sf)
    kind = F.create_map(*[F.lit(x) for x in ("1-URGENT", "journal-article", "2-HIGH", "book-chapter", "3-MEDIUM", "dataset", "4-NOT SPECIFIED", "journal", "5-LOW", "posted-content")])
    none, k = F.lit(None).cast("string"), F.col("k")
    person = lambda given, family, name: F.struct(given.alias("given"), family.alias("family"), name.alias("name"))
    records = o.select(
        F.when(k % 10 != 0, TEXT("10.5555/O", F.col("s"))).alias("DOI"), kind[F.col("p")].alias("type"), F.when(k % 17 == 0, F.array().cast("array<string>")).when(k % 19 == 0, F.array(F.lit("x"))).otherwise(F.array(TEXT("Order ", F.col("s")))).alias("title"),
        F.struct(F.array(F.when(k % 3 == 0, F.array(F.year("d"))).otherwise(F.array(F.year("d"), F.month("d"), F.day("d")))).alias("date-parts")).alias("issued"),
        F.array(F.when(k % 4 == 0, person(none, none, TEXT("Group ", F.col("c")))).otherwise(person(TEXT("A", F.col("c")), F.lit("B"), none))).alias("author"), F.when(k % 5 == 0, F.array(person(F.lit("E"), F.lit("F"), none))).alias("editor"),
        F.when(k % 2 == 0, F.array(F.struct(F.lit("https://creativecommons.org/licenses/by/4.0/").alias("URL"), F.lit("vor").alias("content-version")))).alias("license"),
        F.when(k % 6 == 0, F.array(F.struct(TEXT(F.upper(F.concat(F.lit("10.5555/O"), F.col("s"))), "_ref", F.col("c")).alias("key"), F.lit("1999").alias("year")))).alias("reference"),
    )
    r = convert.crossref(reread(records, "crossref", CROSSREF))
    key = F.regexp_replace(F.try_element_at("refs", F.lit(1))["key"], r"^10\.5555/O[0-9]+", "")
    return shown(r, "license_slug", F.size("refs").alias("n_refs"), key.alias("ref_key"), "release_stage")


@query(f"""WITH {O} SELECT 'datacite-' || sha1('10.5/d' || k) AS id, CASE WHEN k % 9 = 0 THEN 'Watch full movie online free' ELSE 'Data ' || k END AS title, CASE WHEN k % 11 = 0 THEN 'review' WHEN k % 3 = 0 THEN 'dataset' WHEN k % 3 = 1 THEN 'thesis' ELSE 'software' END AS release_type,
  CASE WHEN k % 2 = 0 THEN d END AS release_date, CASE WHEN k % 2 = 0 THEN CAST(year(d) AS INT) ELSE 2003 END AS release_year, '10.5/d' || k AS doi, CASE WHEN k % 4 = 0 THEN 3 ELSE 1 END AS n_contribs, CASE WHEN k % 4 = 1 THEN 'Ada ' || c ELSE 'G' || c || ' F' END AS first_name,
  CASE WHEN k % 9 = 0 THEN 'spam-title' END AS skip_reason, 'Part' AS subtitle, CASE WHEN k % 4 = 0 THEN 'Group of all' END AS body, CASE WHEN k % 4 = 0 THEN 'National Office, Third' END AS third, CASE WHEN k % 2 = 0 THEN 'RS-INC' ELSE 'CC-BY' END AS license_slug,
  CASE WHEN k % 5 = 0 THEN 'Daten ' || k END AS original_title, CASE WHEN k % 7 = 0 THEN 2 ELSE 0 END AS n_refs, CASE WHEN k % 7 = 0 THEN '10.5/r' || k END AS ref_doi, CASE WHEN k % 3 = 0 THEN 2 WHEN k % 3 = 1 THEN 1 ELSE 0 END AS n_abstracts, CASE WHEN k % 3 <> 2 THEN '<p>' || repeat('a', 75) END AS abstract FROM o""")
def datacite_works(spark, sf):
    o, k, none = orders(spark, sf), F.col("k"), F.lit(None).cast("string")
    kinds = F.struct(F.when(k % 3 == 0, "dataset").alias("citeproc"), F.when(k % 3 == 1, "THES").alias("ris"), none.alias("schemaOrg"), F.when(k % 3 == 0, "phdthesis").alias("bibtex"), F.when(k % 3 == 2, "Software").alias("resourceTypeGeneral"))
    who = lambda name, kind=none, given=none, family=none: F.struct(name.alias("name"), kind.alias("nameType"), given.alias("givenName"), family.alias("familyName"))
    person = who(F.when(k % 4 == 1, "").when(k % 2 == 0, TEXT("F, G", F.col("c"))).otherwise(TEXT("G", F.col("c"), " F")), F.lit("Personal"), F.when(k % 4 == 1, "Ada").otherwise("unused"), F.when(k % 4 == 1, F.col("c")).otherwise("unused"))
    gone, odd, body, third = who(F.lit("(:unav)")), who(F.lit("X"), F.lit("Other")), who(F.lit("Group of all"), F.lit("Organizational")), who(F.lit("National Office, Third"))
    one = lambda a, b: F.struct(a.alias("date"), F.lit(b).alias("dateType"))
    related = lambda a, b, c: F.struct(F.lit(a).alias("relationType"), b.alias("relatedIdentifier"), F.lit(c).alias("relatedIdentifierType"))
    said = lambda n, kind="Abstract": F.struct(F.lit(" <p>" + "a" * n + " ").alias("description"), F.lit(kind).alias("descriptionType"))
    records = o.select(
        TEXT(" 10.5/D", F.col("s")).alias("doi"), kinds.alias("types"), F.when(k % 2 == 0, F.array(one(F.lit("1999"), "Created"), one(F.col("day"), "Available"))).otherwise(F.array(one(F.lit("later"), "Valid"))).alias("dates"), F.lit(2003).alias("publicationYear"),
        F.array(F.struct(F.lit("Part").alias("title"), F.lit("Subtitle").alias("titleType")), F.struct(F.when(k % 9 == 0, "Watch full movie online free").otherwise(TEXT("Data ", F.col("s"))).alias("title"), none.alias("titleType")), F.struct(F.when(k % 5 == 0, TEXT("Daten ", F.col("s"))).otherwise("???? what").alias("title"), F.lit("TranslatedTitle").alias("titleType"))).alias("titles"),
        F.when(k % 4 == 0, F.array(person, person, gone, odd, body)).otherwise(F.array(person, gone)).alias("creators"), F.when(k % 4 == 0, F.array(person, third)).alias("contributors"),
        F.array(F.struct(F.when(k % 2 == 0, "http://rightsstatements.org/vocab/InC/1.0/").otherwise("https://creativecommons.org/licenses/by/4.0/").alias("rightsUri")), F.struct(F.lit("http://x").alias("rightsUri"))).alias("rightsList"),
        F.filter(F.array(F.when(k % 7 == 0, related("References", TEXT("10.5/r", F.col("s")), "DOI")), F.when(k % 7 == 0, related("Cites", F.lit("x"), "URL")), F.when(k % 11 == 0, related("Reviews", F.lit("x"), "DOI"))), lambda x: x.isNotNull()).alias("relatedIdentifiers"),
        F.when(k % 3 == 0, F.array(said(75), said(80, "Other"), said(90))).when(k % 3 == 1, F.array(said(75))).otherwise(F.array(said(60))).alias("descriptions"),
    )
    at = lambda c, i: F.try_element_at(c, F.lit(i))
    return shown(
        convert.datacite(reread(records, "datacite", DATACITE), "2026-01-01"), "subtitle", F.try_element_at(at("contribs", 2)["extra"], F.lit("organization")).alias("body"), at("contribs", 3)["raw_name"].alias("third"), "license_slug", "original_title",
        F.size("refs").cast("int").alias("n_refs"), F.try_element_at(at("refs", 1)["extra"], F.lit("doi")).alias("ref_doi"), F.size("abstracts").alias("n_abstracts"), at("abstracts", 1)["content"].alias("abstract"),
    )


@query(f"""WITH {O}, r AS (SELECT *, '2001.' || lpad(CAST(k AS VARCHAR), 7, '0') || 'v1' AS x FROM o) SELECT 'arxiv-' || sha1(x) AS id, 'Two lines of ' || k AS title, CASE WHEN k % 3 = 0 THEN 'paper-conference' WHEN k % 3 = 1 THEN 'report' ELSE 'article-journal' END AS release_type, d AS release_date,
  CAST(year(d) AS INT) AS release_year, NULL::VARCHAR AS doi, 1 AS n_contribs, 'Ada L' || c AS first_name, CASE WHEN k % 7 = 0 THEN 'deleted' END AS skip_reason, 'submitted' AS release_stage, CASE WHEN k % 2 = 0 THEN 'Jr' END AS suffix FROM r""")
def arxiv_works(spark, sf):
    o, k = orders(spark, sf), F.col("k")
    records = o.select(
        F.when(k % 5 != 0, TEXT("2001.", F.lpad("s", 7, "0"), F.when(k % 2 == 0, "v1").otherwise(""))).alias("id"), TEXT("oai:arXiv.org:2001.", F.lpad("s", 7, "0")).alias("identifier"), TEXT(" Two lines\nof ", F.col("s")).alias("title"),
        F.array(F.struct(F.lit("Ada").alias("forename"), TEXT("L", F.col("c")).alias("keyname"), F.when(k % 2 == 0, "Jr").alias("suffix"))).alias("authors"), F.when(k % 4 != 0, F.col("day")).alias("created"), F.when(k % 4 == 0, F.col("day")).otherwise("2025-01-01").alias("datestamp"), F.lit("2024-01-01").alias("updated"),
        F.when(k % 3 == 0, "Proc. of a Workshop").alias("journal_ref"), F.when(k % 3 == 1, "TR-1").alias("report_no"), F.when(k % 7 == 0, "deleted").alias("status"),
    )
    return shown(convert.arxiv(reread(records, "arxiv", ARXIV)), "release_stage", F.try_element_at(F.try_element_at("contribs", F.lit(1))["extra"], F.lit("suffix")).alias("suffix"))


@query(f"""WITH {O} SELECT 'doaj-j' || k AS id, 'Title ' || k AS title, 'article-journal' AS release_type, CASE WHEN k % 2 = 0 THEN d ELSE make_date(year(d), 1, 1) END AS release_date, CAST(year(d) AS INT) AS release_year, CASE WHEN k % 3 = 0 THEN '10.5555/j' || k END AS doi, 2 AS n_contribs, 'Li, Ada ' || c AS first_name,
  CASE WHEN k % 8 = 0 THEN 'deleted' END AS skip_reason, 'Li' AS surname, 'Ada ' || c AS given, 'cc-by-nc' AS license_slug, CASE k % 3 WHEN 0 THEN '1-9' WHEN 1 THEN '1' END AS pages, NULL::VARCHAR AS second_surname FROM o""")
def doaj_works(spark, sf):
    o, k = orders(spark, sf), F.col("k")
    records = o.select(
        TEXT("j", F.col("s")).alias("id"), TEXT(" Title ", F.col("s")).alias("title"), F.when(k % 2 == 0, F.col("day")).otherwise(F.substring("day", 1, 4)).alias("publication_date"), F.when(k % 3 == 0, TEXT("https://doi.org/10.5555/J", F.col("s"))).otherwise("none").alias("doi"),
        F.array(F.struct(TEXT("Li, Ada ", F.col("c")).alias("name")), F.struct(F.lit("Bo Oz").alias("name"))).alias("authors"), F.when(k % 8 == 0, "deleted").alias("status"), F.lit("https://CreativeCommons.org/licenses/by-nc/4.0/").alias("license_ref"), F.when(k % 3 != 2, "1").alias("start_page"), F.when(k % 3 != 1, "9").alias("end_page"),
    )
    first = F.try_element_at("contribs", F.lit(1))
    return shown(convert.doaj(reread(records, "doaj", DOAJ)), first["surname"].alias("surname"), first["given_name"].alias("given"), "license_slug", "pages", F.try_element_at("contribs", F.lit(2))["surname"].alias("second_surname"))


@query(f"""WITH {O} SELECT 'pubmed-' || sha1('p' || k) AS id, CASE WHEN k % 5 = 0 THEN 'Not Available' WHEN k % 5 = 1 THEN 'Studie ' || k ELSE 'Study ' || k END AS title, CASE WHEN k % 3 = 0 THEN 'retraction' WHEN k % 3 = 1 THEN 'editorial' END AS release_type, CASE WHEN k % 7 = 0 THEN DATE '2001-02-03' WHEN k % 2 = 0 THEN d END AS release_date,
  CAST(CASE WHEN k % 7 = 0 THEN 2001 ELSE year(d) END AS INT) AS release_year, CASE WHEN k % 4 = 0 THEN '10.5555/p' || k WHEN k % 4 = 1 THEN '10.5555/e' || k END AS doi, CASE WHEN k % 8 = 0 THEN 2 ELSE 1 END AS n_contribs, CASE WHEN k % 6 = 0 THEN 'Group' ELSE 'F' || c || ' L' END AS first_name, CASE WHEN k % 5 = 0 THEN 'stub-title' END AS skip_reason,
  CASE WHEN k % 3 = 0 THEN 'retraction' WHEN k % 3 = 1 THEN 'updated' ELSE 'published' END AS release_stage, CASE WHEN k % 5 = 2 THEN 'Titel' END AS original_title, CASE WHEN k % 3 = 2 THEN 'retracted' WHEN k % 2 = 0 THEN 'concern' END AS withdrawn_status, CASE k % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 1 END AS n_abstracts,
  CASE WHEN k % 3 = 0 THEN repeat('b', 40) || chr(10) || repeat('c', 40) ELSE repeat('b', 80) END AS abstract, CASE WHEN k % 3 = 1 THEN 'de' ELSE 'en' END AS last_language FROM o""")
def pubmed_works(spark, sf):
    o, k, none = orders(spark, sf), F.col("k"), F.lit(None).cast("string")
    part = lambda c, n, category=none: F.struct(F.lit("LABEL").alias("label"), category.alias("category"), F.lit(c * n).alias("text"))
    kind = F.when(k % 3 == 0, F.array(F.lit("Editorial"), F.lit("Retraction of Publication"))).when(k % 3 == 1, F.array(F.lit("Odd"), F.lit("Editorial"), F.lit("Corrected and Republished Article"))).otherwise(F.array(F.lit("Odd"), F.lit("Retracted Publication")))
    records = o.select(
        TEXT("p", F.col("s")).alias("pmid"), F.when(k % 5 == 0, "[Not Available].").when(k % 5 == 1, TEXT("[Studie ", F.col("s"), "]..")).otherwise(TEXT("Study ", F.col("s"), ".")).alias("title"), F.when(k % 5 == 2, "Titel.").alias("vernacular_title"), kind.alias("publication_types"),
        F.array(F.when(k % 6 == 0, F.struct(none.alias("fore_name"), none.alias("last_name"), F.lit("Group").alias("collective_name"))).otherwise(F.struct(TEXT("F", F.col("c")).alias("fore_name"), F.lit("L").alias("last_name"), none.alias("collective_name")))).alias("authors"), F.when(k % 8 == 0, "N").otherwise("Y").alias("complete_authors"),
        F.when(k % 2 == 0, F.year("d").cast("string")).alias("year"), F.when(k % 2 == 0, F.date_format("d", "MMM")).alias("month"), F.when(k % 2 == 0, F.dayofmonth("d").cast("string")).alias("day"), F.when(k % 2 != 0, TEXT(F.year("d").cast("string"), " Jan-Feb")).alias("medline_date"),
        F.when(k % 7 == 0, F.struct(F.lit("2001").alias("year"), F.lit("02").alias("month"), F.lit("3").alias("day"))).alias("electronic"), F.when(k % 2 == 0, F.array(F.struct(F.lit("ExpressionOfConcernIn").alias("ref_type")))).alias("corrections"),
        F.when(k % 4 == 0, F.array(F.struct(F.lit("doi").alias("id_type"), TEXT(" 10.5555/P", F.col("s")).alias("value")))).otherwise(F.array().cast("array<struct<id_type:string,value:string>>")).alias("article_ids"),
        F.when(k % 4 == 1, F.array(F.struct(F.lit("doi").alias("id_type"), F.lit("N").alias("valid"), F.lit("10.5555/no").alias("value")), F.struct(F.lit("doi").alias("id_type"), F.lit("Y").alias("valid"), TEXT("10.5555/E", F.col("s")).alias("value")))).alias("elocation_ids"),
        F.when(k % 3 == 0, F.array(part("b", 40, F.lit("METHODS")), part("", 0), part("c", 40))).otherwise(F.array(part("b", 80), part("c", 40))).alias("abstract_parts"), F.when(k % 3 == 1, F.array(F.struct(F.lit("ger").alias("language"), F.array(F.lit("d" * 75), F.lit("short")).alias("texts")))).alias("other_abstracts"),
    )
    return shown(convert.pubmed(reread(records, "pubmed", PUBMED), "2026-01-01"), "release_stage", "original_title", "withdrawn_status", F.size("abstracts").alias("n_abstracts"), F.try_element_at("abstracts", F.lit(1))["content"].alias("abstract"), F.try_element_at("abstracts", F.lit(-1))["language"].alias("last_language"))


@query(f"""WITH {O} SELECT 'openalex-' || sha1('https://openalex.org/W' || k) AS id, 'W ' || k AS title, NULL::VARCHAR AS release_type, d AS release_date, CAST(year(d) AS INT) AS release_year, '10.5555/w' || k AS doi, 2 AS n_contribs, 'A ' || c AS first_name, NULL::VARCHAR AS skip_reason,
  'W' || k AS openalex, CASE WHEN k % 2 = 0 THEN CAST(k AS VARCHAR) END AS pmid FROM o""")
def openalex_works(spark, sf):
    o, k = orders(spark, sf), F.col("k")
    records = o.select(
        F.struct(TEXT("https://openalex.org/W", F.col("s")).alias("openalex"), F.when(k % 2 == 0, TEXT("https://pubmed.ncbi.nlm.nih.gov/", F.col("s"))).alias("pmid")).alias("ids"), TEXT("https://doi.org/10.5555/W", F.col("s")).alias("doi"), TEXT("W ", F.col("s")).alias("title"),
        F.array(F.struct(TEXT("A ", F.col("c")).alias("raw_author_name")), F.struct(F.lit("B").alias("raw_author_name"))).alias("authorships"), F.struct(F.lit("1").alias("first_page")).alias("biblio"), F.col("day").alias("publication_date"), F.year("d").alias("publication_year"),
    )
    of = lambda n: F.try_element_at("extids", F.lit(n)).alias(n)
    return shown(convert.openalex(reread(records, "openalex", OPENALEX)), of("openalex"), of("pmid"))


@query(f"""WITH {O} SELECT 'dblp-' || sha1('conf/x/' || k) AS id, 'Paper ' || k AS title, NULL::VARCHAR AS release_type, NULL::DATE AS release_date, CAST(year(d) AS INT) AS release_year, CASE WHEN k % 3 = 0 THEN '10.5555/b' || k END AS doi, 1 AS n_contribs, 'Ada ' || c AS first_name, NULL::VARCHAR AS skip_reason, c AS surname FROM o""")
def dblp_works(spark, sf):
    o, k = orders(spark, sf), F.col("k")
    records = o.select(TEXT("conf/x/", F.col("s")).alias("key"), TEXT("Paper ", F.col("s"), ".").alias("title"), F.array(TEXT("Ada ", F.col("c"))).alias("author"), F.year("d").cast("string").alias("year"), F.array(F.lit("https://x.org/"), F.when(k % 3 == 0, TEXT("https://doi.org/10.5555/b", F.col("s"))).otherwise("y")).alias("ee"))
    return shown(convert.dblp(reread(records, "dblp", DBLP)), F.try_element_at("contribs", F.lit(1))["surname"].alias("surname"))


@query("""SELECT 'oaiscrape-' || sha1('oai:x:' || page_id) AS id, CASE WHEN page_id % 5 <> 0 THEN 'A & B ' || page_id END AS title, CASE WHEN page_id % 2 = 0 AND page_id % 5 <> 0 THEN DATE '2020-02-03' END AS release_date, CASE WHEN page_id % 5 <> 0 THEN 2020 END AS release_year, CASE WHEN page_id % 3 = 0 AND page_id % 5 <> 0 THEN '10.5555/x' || page_id END AS doi,
  CASE WHEN page_id % 5 = 0 THEN 'deleted' END AS skip_reason, CASE WHEN page_id % 5 <> 0 THEN 'Li' END AS surname FROM pages""")
def oai_xml_records(spark, sf):
    """Harvested XML, some records deleted, some split over lines."""
    p, n = rd(spark, sf, "pages").select("page_id"), F.col("page_id").cast("string")
    body = TEXT("<metadata><oai_dc:dc xmlns:oai_dc='a' xmlns:dc='b'>\n<dc:title>A &amp; B ", n, "</dc:title><dc:creator>Li, Ada</dc:creator><dc:date>", F.when(F.col("page_id") % 2 == 0, "2020-02-03").otherwise("2020"), "</dc:date><dc:identifier>", F.when(F.col("page_id") % 3 == 0, TEXT("https://doi.org/10.5555/X", n)).otherwise("http://y"), "</dc:identifier></oai_dc:dc></metadata>")
    deleted = F.col("page_id") % 5 == 0
    line = TEXT("<record><header", F.when(deleted, " status='deleted'").otherwise(""), "><identifier>oai:x:", n, "</identifier></header>", F.when(deleted, "").otherwise(body), "</record>")
    path = place(spark, "oai")
    p.select(line.alias("value")).write.text(path)
    r = convert.oai(readers.oai_records(spark, path))
    return r.select("id", "title", "release_date", "release_year", F.try_element_at("extids", F.lit("doi")).alias("doi"), "skip_reason", F.try_element_at("contribs", F.lit(1))["surname"].alias("surname"))


@query("""SELECT 'arxiv-' || sha1('2001.0' || page_id || 'v1') AS id, 'On ' || page_id AS title, DATE '2020-02-03' AS release_date, 'submitted' AS release_stage, 2 AS n_contribs, 'Ada Li' AS first_name, CASE WHEN page_id % 2 = 0 THEN '10.5555/a' || page_id END AS doi FROM pages""")
def arxiv_xml_records(spark, sf):
    n, k = F.col("page_id").cast("string"), F.col("page_id")
    people = "<authors><author><keyname>Li</keyname><forenames>Ada</forenames><suffix>Jr</suffix></author><author><keyname>Oz</keyname></author></authors>"
    body = TEXT("<arXiv xmlns='a'><id>2001.0", n, "</id><created>2020-02-03</created>", people, "<title>On\n", n, "</title>", F.when(k % 3 == 0, "<journal-ref>J. 1</journal-ref>").otherwise(""), F.when(k % 2 == 0, TEXT("<doi>10.5555/A", n, "</doi>")).otherwise(""), "</arXiv>")
    path = place(spark, "arxiv-xml")
    rd(spark, sf, "pages").select(TEXT("<record><header><identifier>oai:", n, "</identifier></header><metadata>", body, "</metadata></record>").alias("value")).write.text(path)
    r = convert.arxiv(readers.arxiv_records(spark, path))
    return r.select("id", "title", "release_date", "release_stage", F.size("contribs").alias("n_contribs"), F.try_element_at("contribs", F.lit(1))["raw_name"].alias("first_name"), F.try_element_at("extids", F.lit("doi")).alias("doi"))


@query("""SELECT 'Paper ' || page_id AS title, 'article-journal' AS release_type, CASE WHEN page_id % 3 = 0 THEN 'submitted' ELSE 'published' END AS release_stage, CASE WHEN page_id % 2 = 0 THEN DATE '2019-04-05' END AS release_date, CASE WHEN page_id % 2 <> 0 THEN 2018 END AS release_year, '3' AS volume, '1-' || page_id AS pages, 'en' AS language,
  CASE WHEN page_id % 3 = 0 THEN 'arxiv=2001.' || page_id || ' ' ELSE '' END || 'doi=10.5/t' || page_id AS ids, 'Ada B. Li' AS first_name, 'Uni Dept' AS affiliation, 2 AS n_contribs, 1 AS n_abstracts FROM pages""")
def tei_headers(spark, sf):
    n, k = F.col("page_id").cast("string"), F.col("page_id")
    people = "<author><persName><forename type='first'>Ada</forename><forename type='middle'>B.</forename><surname>Li</surname></persName><affiliation><orgName type='institution'>Uni</orgName><orgName type='department'>Dept</orgName></affiliation></author><author><persName><surname>Oz</surname></persName></author><author><affiliation><orgName type='laboratory'>x</orgName></affiliation></author>"
    head = TEXT("<titleStmt><title level='a'>Paper ", n, "</title></titleStmt><publicationStmt><publisher>P</publisher><date type='published' when='", F.when(k % 2 == 0, "2019-04-05").otherwise("2018-12"), "'>x</date></publicationStmt>")
    source = TEXT("<sourceDesc><biblStruct><analytic>", people, "</analytic><monogr><imprint><biblScope unit='volume'>3</biblScope><biblScope unit='page' from='1' to='", n, "'/></imprint></monogr><idno type='DOI'>10.5/t", n, "</idno>", F.when(k % 3 == 0, TEXT("<idno type='arXiv'>2001.", n, "</idno>")).otherwise(""), "</biblStruct></sourceDesc>")
    body = "<profileDesc><abstract><div><p>" + "An abstract with some words in it. " * 4 + "</p></div></abstract></profileDesc>"
    path = place(spark, "tei")
    line = TEXT("<TEI xmlns='http://www.tei-c.org/ns/1.0'><teiHeader xml:lang='en'><fileDesc>", head, source, "</fileDesc>", body, "</teiHeader><text/></TEI>")
    rd(spark, sf, "pages").select(line.alias("value")).write.text(path)
    flat = readers.tei_records(spark, path)
    r = convert.tei(flat)
    ids_ = F.array_join(F.transform(F.array_sort(F.map_entries("extids")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), " ")
    first = F.try_element_at("contribs", F.lit(1))
    return r.select("title", "release_type", "release_stage", "release_date", "release_year", "volume", "pages", "language", ids_.alias("ids"), first["raw_name"].alias("first_name"), first["raw_affiliation"].alias("affiliation"), F.size("contribs").alias("n_contribs"), F.size("abstracts").alias("n_abstracts"))


@query("""SELECT 'doaj-d' || page_id AS id, 'On ' || page_id AS title, CAST(2000 + page_id % 20 AS INT) AS release_year, '1-' || page_id AS pages, 1 AS n_contribs, CASE WHEN page_id % 4 = 0 THEN 'deleted' END AS skip_reason FROM pages""")
def doaj_xml_records(spark, sf):
    n, k = F.col("page_id").cast("string"), F.col("page_id")
    body = TEXT("<doajArticle xmlns='a'><publicationDate>", (2000 + k % 20).cast("string"), "</publicationDate><startPage>1</startPage><endPage>", n, "</endPage><title language='eng'>On ", n, "</title><authors><author><name>Ada Li</name></author></authors></doajArticle>")
    path = place(spark, "doaj-xml")
    rd(spark, sf, "pages").select(TEXT("<record><header", F.when(k % 4 == 0, " status='deleted'").otherwise(""), "><identifier>oai:doaj.org/article:d", n, "</identifier></header><metadata>", body, "</metadata></record>").alias("value")).write.text(path)
    return convert.doaj(readers.doaj_records(spark, path)).select("id", "title", "release_year", "pages", F.size("contribs").alias("n_contribs"), "skip_reason")


@query("""SELECT url AS target_uri, CASE WHEN page_id % 3 = 0 THEN 404 ELSE 200 END AS status, sha1(html) AS sha1, CAST(octet_length(encode(html)) AS BIGINT) AS size, false AS truncated FROM pages WHERE page_id % 5 <> 0 AND html IS NOT NULL""")
def archived_responses(spark, sf):
    """Pages as records of archive files, some of another kind, read by one task a file."""
    crlf = "\r\n"
    http = TEXT(F.when(F.col("page_id") % 3 == 0, "HTTP/1.1 404 Not Found").otherwise("HTTP/1.1 200 OK"), crlf, "Content-Type: text/html", crlf, crlf, F.col("html"))
    record = TEXT("WARC/1.0", crlf, "WARC-Type: ", F.when(F.col("page_id") % 5 == 0, "request").otherwise("response"), crlf, "WARC-Target-URI: ", F.col("url"), crlf, "Content-Length: ", F.octet_length(http).cast("string"), crlf, crlf, http, crlf, crlf)
    path = place(spark, "warc")
    rd(spark, sf, "pages").where("html IS NOT NULL").select(record.alias("value")).repartition(3).write.option("lineSep", crlf).option("compression", "gzip").text(path)
    return readers.warc_responses(spark, path).select("target_uri", "status", "sha1", F.octet_length("payload").cast("long").alias("size"), "truncated")


@query("""SELECT page_id, url, 100 + page_id AS size, CASE WHEN page_id % 4 = 0 THEN '226' ELSE '200' END AS status FROM pages WHERE page_id % 7 <> 0 AND page_id % 3 <> 0""")
def capture_index(spark, sf):
    """Capture index lines, some bad, some without an archive file: those of usable captures."""
    n, k = F.col("page_id").cast("string"), F.col("page_id")
    line = F.concat_ws(" ", TEXT("org,x)/", n), F.lit("20200101000000"), F.when(k % 4 == 0, TEXT("ftp://x/", n)).otherwise(F.col("url")), F.lit("text/html"), F.when(k % 4 == 0, "-").otherwise("200"), F.lit("A" * 32), F.lit("-"), F.lit("-"), F.when(k % 7 == 0, "bad").otherwise((k + 100).cast("string")), n, F.when(k % 3 == 0, "-").otherwise("w.warc.gz"))
    path = place(spark, "cdx")
    rd(spark, sf, "pages").select(line.alias("value")).write.option("compression", "gzip").text(path)
    c = readers.usable_captures(readers.cdx(spark, path))
    pages = rd(spark, sf, "pages").select("page_id", "url")
    return c.select(F.col("offset").alias("page_id"), "size", "status").join(pages, "page_id").select("page_id", "url", "size", "status")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def tab_separated(spark, sf):
    """Rows written as TSV, one of them with a quote and a line break in it, and read again."""
    path = place(spark, "tsv")
    odd = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.col("c_name"), F.lit('"\n'))).otherwise(F.col("c_name"))
    sinks.write_tsv(rd(spark, sf, "customer").select("c_custkey", odd.alias("c_name"), "c_mktsegment"), path)
    return readers.tsv(spark, path, "c_custkey long, c_name string, c_mktsegment string").withColumn("c_name", F.regexp_replace("c_name", '"? ?$', ""))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS issn, 'L' || (s_suppkey % 7) AS issnl FROM supplier UNION SELECT 'L' || (s_suppkey % 7), 'L' || (s_suppkey % 7) FROM supplier")
def linking_issns(spark, sf):
    path = place(spark, "issn")
    pairs = rd(spark, sf, "supplier").select(F.concat_ws("\t", F.col("s_suppkey").cast("string"), TEXT("L", (F.col("s_suppkey") % 7).cast("string"))).alias("value"))
    pairs.unionByName(spark.createDataFrame([("ISSN\tISSN-L",)], "value string")).write.text(path)
    return readers.issn_map(spark, path)


@query("SELECT event_id, max(user_id) AS user_id FROM (SELECT event_id % 5000 AS event_id, event_id % 5000 AS user_id FROM events) GROUP BY 1")
def streamed_table(spark, sf):
    """Events as files, read as a stream in two runs into a table that has each key once."""
    source, table, state = (place(spark, x) for x in ("stream", "streamed", "state"))
    e = rd(spark, sf, "events").select((F.col("event_id") % 5000).alias("event_id"), (F.col("event_id") % 5000).alias("user_id"))
    e.repartition(6).write.json(source)
    for _ in range(2):
        ingest.ingest(ingest.records(spark, source, "event_id long, user_id long", 2), table, state, ["event_id"]).awaitTermination()
        e.limit(0).coalesce(1).write.mode("append").json(source)
    return spark.read.parquet(table).select("event_id", "user_id")


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'exact' WHEN 1 THEN 'fuzzy' WHEN 2 THEN 'fallback' WHEN 3 THEN 'refused' WHEN 4 THEN 'unknown' ELSE 'fuzzy' END AS status, CASE WHEN o_orderkey % 6 IN (0, 1, 5) THEN o_orderkey WHEN o_orderkey % 6 = 2 THEN -o_orderkey END AS id,
  CASE o_orderkey % 6 WHEN 1 THEN 100.0 WHEN 5 THEN round(100 * 2.5 / 3, 3) END AS score FROM orders WHERE o_orderkey % 50 IN (0, 1, 2, 3, 4, 5)""")
def matched_citations(spark, sf):
    """References by identifier, in the first table or the second or neither; others by title, names and year, good enough or not."""
    k, n = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    o, m = rd(spark, sf, "orders").select("o_orderkey"), k % 6
    title = TEXT("unusual", n, " words", n, " of works")
    releases = o.select(k.alias("id"), F.when(m == 0, TEXT("10.5555/", n)).alias("doi"), title.alias("title"), F.lit(1999).alias("release_year"), F.lit("Ada Li; Bo Oz").alias("contrib_names"))
    second = o.where(m == 2).select((-k).alias("id"), TEXT("10.5555/", n).alias("doi"))
    doi = F.when(m.isin(0, 2, 4), TEXT("https://doi.org/10.5555/", n))
    creators = F.when(m == 1, "Li, Ada").when(m == 3, "Nobody, Else; Other, Body").when(m == 5, "Bo Oz")
    refs = o.where("o_orderkey % 50 IN (0, 1, 2, 3, 4, 5)").select(k.alias("ref_id"), doi.alias("doi"), F.when(m == 1, TEXT(title, " Archived 2020-01-01 at x")).otherwise(title).alias("title"), F.when(m == 5, 2001).when(m == 1, 1999).alias("year"), creators.alias("creators"))
    return entities.match_citations(refs, releases, second).withColumnRenamed("ref_id", "o_orderkey")


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 <> 3 THEN 'article' END AS type, CASE WHEN o_orderkey % 4 <> 3 THEN CASE o_orderkey % 4 WHEN 0 THEN 'Li' WHEN 1 THEN 'Body' ELSE 'Oz' END END AS family, CASE WHEN o_orderkey % 4 = 0 THEN 'Ada' END AS given, CASE WHEN o_orderkey % 4 = 2 THEN 'Tr' END AS translator,
  CASE WHEN o_orderkey % 4 <> 3 THEN CASE WHEN o_orderkey % 2 = 0 THEN CAST(year(o_orderdate) AS VARCHAR) || ',' || month(o_orderdate) || ',' || day(o_orderdate) ELSE CAST(year(o_orderdate) AS VARCHAR) END END AS issued, CASE WHEN o_orderkey % 4 <> 3 THEN '7' END AS first_page, CASE WHEN o_orderkey % 4 <> 3 THEN 'J' || o_custkey END AS container,
  CASE WHEN o_orderkey % 4 <> 3 THEN 'P' || o_custkey END AS publisher, CASE WHEN o_orderkey % 4 <> 3 THEN '1234-5678' END AS issn, CASE WHEN o_orderkey % 4 <> 3 THEN 'PMC' || o_orderkey END AS pmcid, CASE WHEN o_orderkey % 4 <> 3 THEN 'An abstract' END AS abstract, CASE WHEN o_orderkey % 4 <> 3 THEN 0 END AS odd FROM orders""")
def csl_objects(spark, sf):
    """Releases as citation objects, read back by key: names by creator, contributor or last word, roles, dates, the container's names."""
    k, s, none = F.col("o_orderkey"), F.col("o_custkey").cast("string"), F.lit(None).cast("string")
    who = lambda raw, given, surname, role, creator: F.struct(raw.alias("raw_name"), given.alias("given_name"), surname.alias("surname"), F.lit(role).cast("string").alias("role"), none.alias("raw_affiliation"), F.lit(0).alias("position"), creator.alias("creator"))
    nobody = F.lit(None).cast("struct<display_name:string,given_name:string,surname:string>")
    creator = F.struct(F.lit("Ada Li").alias("display_name"), F.lit("Ada").alias("given_name"), F.lit("Li").alias("surname"))
    people = F.when(k % 4 == 0, F.array(who(F.lit("A L"), F.lit("A"), F.lit("L"), None, creator))).when(k % 4 == 1, F.array(who(F.lit("The Whole Body"), none, none, "author", nobody), who(none, none, none, "editor", nobody)))
    people = people.when(k % 4 == 2, F.array(who(none, none, F.lit("Oz"), "author", nobody), who(F.lit("X Tr"), none, none, "translator", nobody))).otherwise(F.array(who(none, F.lit("A"), none, "author", nobody)))
    r = rd(spark, sf, "orders").select(
        k.alias("id"), F.lit(None).cast("string").alias("release_type"), F.lit("").alias("language"), F.when(k % 2 == 0, F.to_date("o_orderdate")).alias("release_date"), F.year("o_orderdate").alias("release_year"), F.lit("7-9").alias("pages"), F.lit("T").alias("title"), none.alias("volume"), F.lit("").alias("issue"), F.lit("own").alias("publisher"),
        F.create_map(F.lit("pmcid"), TEXT("PMC", k.cast("string"))).alias("extids"), F.array(F.struct(F.lit("An abstract").alias("content"))).alias("abstracts"), people.alias("contribs"), F.struct(TEXT("J", s).alias("name"), F.lit("1234-5678").alias("issnl"), TEXT("P", s).alias("publisher")).alias("container"),
    )
    names = "array<struct<family:string,given:string>>"
    c = convert.csl_json(r).withColumn("c", F.from_json("csl", f"type string, issued struct<`date-parts`:array<array<int>>>, author {names}, translator {names}, `page-first` string, `container-title` string, publisher string, `ISSN` string, `PMCID` string, abstract string"))
    first = lambda x, f: F.try_element_at(F.col(f"c.{x}"), F.lit(1))[f]
    odd = sum(F.contains("csl", F.lit(x)).cast("int") for x in ('"language"', '"issue"', '"volume"', '"editor"', '"page":', '"given":null'))
    return c.select(
        "id", "c.type", first("author", "family").alias("family"), first("author", "given").alias("given"), first("translator", "family").alias("translator"), F.concat_ws(",", F.try_element_at(F.col("c.issued.date-parts"), F.lit(1)).cast("array<string>")).alias("issued"), F.col("c.page-first").alias("first_page"),
        F.col("c.container-title").alias("container"), "c.publisher", F.col("c.ISSN").alias("issn"), F.col("c.PMCID").alias("pmcid"), "c.abstract", odd.alias("odd"),
    ).withColumn("issued", F.nullif("issued", F.lit("")))


@query("""WITH u AS (SELECT l_orderkey, (l_orderkey // 4) * 32 + l_linenumber AS n, CASE WHEN l_returnflag = 'R' THEN 'https://web.archive.org/web/2020/' || l_partkey ELSE 'http://x/' || l_partkey END AS url, CASE WHEN l_returnflag = 'A' THEN 'webarchive' WHEN l_returnflag = 'R' THEN 'repository' ELSE 'web' END AS rel, l_partkey FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey % 1000 ORDER BY CASE WHEN url LIKE '%web.archive.org%' THEN 2 WHEN rel = 'webarchive' THEN 1 ELSE 0 END DESC, n DESC) AS k FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey % 1000 ORDER BY l_orderkey, n, l_partkey, url) AS m FROM u))
SELECT l_orderkey % 1000 AS work_id, arg_max(url, CASE WHEN url LIKE '%web.archive.org%' THEN 2 WHEN rel = 'webarchive' THEN 1 ELSE 0 END * 1000000000 + m) AS access_url FROM r GROUP BY 1""")
def work_access(spark, sf):
    """Works (of releases, of files) and the best address of their files: the web archive's host decides before the kind."""
    from pyspark.sql import Window

    li, part = rd(spark, sf, "lineitem"), F.col("l_partkey").cast("string")
    url = F.when(F.col("l_returnflag") == "R", TEXT("https://web.archive.org/web/2020/", part)).otherwise(TEXT("http://x/", part))
    rel = F.when(F.col("l_returnflag") == "A", "webarchive").when(F.col("l_returnflag") == "R", "repository").otherwise("web")
    u = li.select((F.col("l_orderkey") % 1000).alias("work_id"), "l_orderkey", (F.floor(F.col("l_orderkey") / 4) * 32 + F.col("l_linenumber")).alias("n"), "l_partkey", url.alias("url"), rel.alias("rel"))
    u = u.withColumn("m", F.row_number().over(Window.partitionBy("work_id").orderBy("l_orderkey", "n", "l_partkey", "url")))
    return entities.best_access(u, "m", "work_id")
