"""Search documents: releases joined with containers, files and creators, with derived flags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import identifiers, text
from quire.operators.search import first_value


def tag_set(tags: dict[str, Column]) -> Column:
    """Sorted names of the conditions that hold."""
    return F.array_sort(F.array_compact(F.array(*(F.when(c, name) for name, c in tags.items()))))


def best_pdf(urls: Column) -> Column:
    """struct(url, ia): the first web archive copy, else the last item copy, else the last other."""
    web = F.filter(urls, lambda u: F.contains(u, F.lit("//web.archive.org")))
    item = F.filter(urls, lambda u: F.contains(u, F.lit("//archive.org")))
    other = F.filter(urls, lambda u: ~F.contains(u, F.lit("//web.archive.org")) & ~F.contains(u, F.lit("//archive.org")))
    ia = F.coalesce(F.try_element_at(web, F.lit(1)), F.try_element_at(item, F.lit(-1)))
    return F.struct(F.coalesce(ia, F.try_element_at(other, F.lit(-1))).alias("url"), ia.isNotNull().alias("in_ia"))


def ordered_urls(file_index: Column, url_index: Column, url: Column) -> Column:
    """Aggregate: the addresses of a release's files, by file and by place in it."""
    return F.transform(F.array_sort(F.collect_list(F.struct(file_index.alias("f"), url_index.alias("u"), url.alias("url")))), lambda x: x["url"])


#: Identifiers of a hit, by label and field, in order (fixed values).
HIT_IDS = (("doi", "doi"), ("pmid", "pmid"), ("pmcid", "pmcid"), ("arxiv", "arxiv_id"), ("dblp", "dblp_id"), ("doaj", "doaj_id"), ("jstor", "jstor_id"))


def result_rows(hits: DataFrame) -> DataFrame:
    """What a results page shows of hits (work_ident, title, release_year, access_url, access_type, size_bytes, and identifiers): titles never empty, identifiers with labels, size, year of capture, links by the work's own pages."""
    have = [(label, c) for label, c in HIT_IDS if c in hits.columns]
    size = F.col("size_bytes")
    label = F.when(size >= 1000000, F.format_string("%.1f MB", size / 1000000.0)).when(size >= 1000, F.format_string("%d kB", F.floor(size / 1000))).otherwise("")
    return hits.select(
        "work_ident", F.coalesce("title", F.lit("(untitled)")).alias("title"), "release_year", F.array_compact(F.array(*(F.concat(F.lit(f"{n}:"), F.nullif(c, F.lit(""))) for n, c in have))).alias("ext_ids"),
        F.regexp_extract(F.coalesce("access_url", F.lit("")), r"/web/(\d{4})", 1).alias("capture_year"), F.coalesce(identifiers.access_url(F.col("access_url"), F.col("work_ident")), F.lit("")).alias("access_url"), F.coalesce("access_type", F.lit("")).alias("access_type"), label.alias("access_size"),
    )


def release_stage(prefix: Column, stage: Column, kind: Column, container: Column, title: Column) -> Column:
    """A missing stage, from what is known of some DOI prefixes (fixed values)."""
    none, name = F.coalesce(stage, F.lit("")) == "", F.coalesce(container, F.lit(""))
    has = lambda *words: reduce(lambda a, b: a | b, (F.contains(name, F.lit(w)) for w in words))
    paper = F.coalesce(kind, F.lit("")) == "paper-conference"
    published = (prefix == "10.1109") & (has("IEEE", "Conference", "Proceedings") | paper) | (prefix == "10.1145") & has("ACM", "Conference", "Proceedings") | prefix.isin("10.1145", "10.1109", "10.1117", "10.1063", "10.1142") & paper | (prefix == "10.17504")
    judged = (prefix == "10.3510") & F.startswith(title, F.lit("Faculty of 1000 evaluation for"))
    return F.when(F.coalesce(judged, F.lit(False)), "published").when(none & (prefix == "10.1101"), "submitted").when(none & F.coalesce(published, F.lit(False)), "published").otherwise(F.nullif(stage, F.lit("")))


def contributor_names(contribs: DataFrame, creators: DataFrame) -> DataFrame:
    """(release_id, names, n_positioned): of contribs (release_id, position, creator_id, raw_name, given_name, surname) the names in order, those of known creators (creator_id, name) as they name themselves."""
    known = creators.select("creator_id", F.col("name").alias("__name"))
    name = text.display_name(F.col("creator_id"), F.col("__name"), F.col("raw_name"), F.col("given_name"), F.col("surname"))
    rows = contribs.join(known, "creator_id", "left").select("release_id", "position", F.coalesce(name, F.lit("")).alias("name"))
    return rows.groupBy("release_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "name"))), lambda x: x["name"]).alias("names"), F.count_if(F.col("position") > 0).alias("n_positioned"))


def container_documents(containers: DataFrame) -> DataFrame:
    """Containers (container_id, name, publisher, container_type, issnl, issne, issnp) as search documents."""
    issns = F.array_compact(F.array(*(F.nullif(c, F.lit("")) for c in ("issnl", "issne", "issnp"))))
    return containers.select("container_id", F.lit("active").alias("state"), "name", "publisher", F.col("container_type").alias("type"), "issnl", "issne", "issnp", issns.alias("issns"))


def file_documents(files: DataFrame, urls: DataFrame, release_file: DataFrame) -> DataFrame:
    """Files (file_id, sha1, mimetype, size) with their urls (file_id, url_index, url, rel) and releases: hosts, domains, kinds, the best address (the last archived one, else the first), whether the archive has them."""
    host = identifiers.url_host(F.col("url"))
    u = urls.select("file_id", "url_index", "url", "rel", host.alias("host"), identifiers.registered_domain(host).alias("domain"))
    of = u.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct("url_index", "url", "rel", "host", "domain"))).alias("u"))
    n = release_file.groupBy("file_id").agg(F.count_distinct("release_id").alias("release_count"))
    pick = lambda k: F.transform(F.filter("u", lambda x: F.coalesce(x[k], F.lit("")) != ""), lambda x: x[k])
    archived = F.filter("u", lambda x: F.contains(x["domain"], F.lit("archive.org")))
    best = F.coalesce(F.try_element_at(archived, F.lit(-1))["url"], F.try_element_at(F.col("u"), F.lit(1))["url"])
    d = files.join(of, "file_id", "left").join(n, "file_id", "left").withColumn("u", F.coalesce("u", F.array().cast("array<struct<url_index:int,url:string,rel:string,host:string,domain:string>>")))
    return d.select("file_id", "sha1", "mimetype", "size", F.coalesce("release_count", F.lit(0)).alias("release_count"), pick("host").alias("hosts"), pick("domain").alias("domains"), pick("rel").alias("rels"), best.alias("best_url"), (F.size(archived) > 0).alias("in_ia"), F.array_contains(pick("host"), "archive.org").alias("in_ia_petabox"))


def full_texts_of(dois: DataFrame, releases: DataFrame) -> DataFrame:
    """(doi, access_url) of the DOIs that have a full text among releases (doi, access_url); misses are dropped."""
    clean = lambda df: df.withColumn("key", identifiers.lenient_doi(F.col("doi"))).where("key IS NOT NULL")
    known = clean(releases.where("access_url IS NOT NULL")).groupBy("key").agg(F.min("access_url").alias("access_url"))
    return clean(dois.select("doi")).join(known, "key").select("doi", "access_url")


def release_documents(releases: DataFrame, containers: DataFrame, files: DataFrame) -> DataFrame:
    """releases (id, container_id, license_slug, pages, extids, extra, ...) with containers (container_id, name, extra)
    and files (release_id, file_index, url_index, url): one row a release, its urls in the order of its files."""
    urls = files.groupBy(F.col("release_id").alias("id")).agg(F.count_distinct("file_index").alias("file_count"), ordered_urls(F.col("file_index"), F.col("url_index"), F.col("url")).alias("urls"))
    c = containers.select("container_id", F.col("name").alias("container_name"), F.col("extra").alias("container_extra"), F.col("publisher_type"))
    d = releases.join(c, "container_id", "left").join(urls, "id", "left").withColumn("pdf", best_pdf(F.coalesce("urls", F.array().cast("array<string>"))))
    of = lambda k: F.try_element_at("extids", F.lit(k))
    own = lambda p: F.get_json_object("extra", p)
    its = lambda p: F.get_json_object("container_extra", p)
    licence = F.lower(F.coalesce("license_slug", F.lit("")))
    cc = F.startswith(F.lower(F.coalesce(its("$.default_license"), F.lit(""))), F.lit("cc-"))
    in_ia = F.col("pdf.in_ia")
    in_kbart, in_jstor, in_doaj = F.coalesce(its("$.kbart").isNotNull(), F.lit(False)), of("jstor").isNotNull(), its("$.doaj").isNotNull()
    oa = first_value(
        [
            (F.startswith(licence, F.lit("cc-")) | F.startswith(licence, F.lit("arxiv-")), F.lit(True)),
            (F.col("container_extra").isNotNull(), cc),
            (own("$.crossref").isNotNull(), F.coalesce(F.col("file_count") > 0, F.lit(False))),
            (own("$.is_oa").isNotNull(), own("$.is_oa") == "true"),
            (own("$.longtail_oa") == "true", F.lit(True)),
        ],
        in_doaj,
    )
    preserved = in_ia | in_kbart | in_jstor | of("pmcid").isNotNull() | of("arxiv").isNotNull()
    prefix = F.split_part(of("doi"), F.lit("/"), F.lit(1))
    name = F.when(prefix.isin("10.6084", "10.25384"), "Figshare").when(prefix == "10.5281", "Zenodo").otherwise(F.col("container_name"))
    name = F.coalesce(name, F.when(prefix == "10.1101", "biorxiv/medrxiv").when(of("arxiv").isNotNull() & of("doi").isNull() & of("pmid").isNull(), "arXiv"))
    kind = F.when((prefix == "10.1101") & (F.col("release_type") == "post"), "article").otherwise(F.col("release_type"))
    tags = {"oa": F.startswith(licence, F.lit("cc-")) | cc | in_doaj | its("$.road").isNotNull(), "doaj": in_doaj, "road": its("$.road").isNotNull(), "jstor": (prefix == "10.2307") | in_jstor, "longtail": its("$.ia.longtail_oa").isNotNull(), "szczepanski": its("$.szczepanski").isNotNull()}
    return d.select(
        "id", "container_id", "title", kind.alias("release_type"), "release_date", F.coalesce("release_year", F.year("release_date")).alias("release_year"), "volume", "issue", "pages",
        F.split_part(F.coalesce("pages", F.lit("")), F.lit("-"), F.lit(1)).alias("first_page"), prefix.alias("doi_prefix"), name.alias("container_name"), F.coalesce("file_count", F.lit(0)).alias("file_count"),
        F.col("pdf.url").alias("best_pdf_url"), in_ia.alias("in_ia"), in_kbart.alias("in_kbart"), F.coalesce(oa, F.lit(False)).alias("is_oa"), preserved.alias("is_preserved"),
        F.when(in_ia, "bright").when(preserved, "dark").otherwise("none").alias("preservation"), tag_set(tags).alias("tags"), F.size(F.coalesce("contribs", F.array())).alias("contrib_count"), F.size(F.coalesce("refs", F.array())).alias("ref_count"),
        F.array_join(F.transform(F.coalesce("contribs", F.array()), lambda x: text.display_name(F.lit(None), F.lit(None), x["raw_name"], x["given_name"], x["surname"])), "; ").alias("contrib_names"),
    )
