"""The relational catalog: current versions, children, migration, patches, matching of citations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import identifiers as ids, text
from quire.operators.cluster import match_titles, title_pairs
from quire.operators.relational import delete_rows, insert_ignore, new_rows, replace_rows


def current(idents: DataFrame, revisions: DataFrame) -> DataFrame:
    """Live entities (ident, rev_id, is_live, redirect_id) with their revision (rev_id, ...)."""
    live = idents.where("is_live AND redirect_id IS NULL").select("ident", "rev_id")
    return live.join(revisions, "rev_id").withColumn("id", ids.short_to_uuid(F.col("ident")))


def without_tests(df: DataFrame, kind: str = "type") -> DataFrame:
    return df.where(F.coalesce(F.trim(kind), F.lit("")) != "test")


def legacy_ids(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """(id, id_type, id_value) of the id columns that are filled."""
    wide = df.select(F.col(id_col).alias("id"), *(F.col(c).cast("string").alias(c) for c in columns))
    return wide.unpivot("id", columns, "id_type", "id_value").where("id_value IS NOT NULL AND id_value <> ''")


def changed(changelog: DataFrame, edits: DataFrame, begin: str, end: str) -> DataFrame:
    """Distinct idents edited by changes in [begin, end)."""
    some = changelog.where((F.col("timestamp") >= F.lit(begin).cast("timestamp")) & (F.col("timestamp") < F.lit(end).cast("timestamp")))
    return edits.join(some.select("editgroup_id"), "editgroup_id").select("ident").distinct()


def patch(parents: DataFrame, children: DataFrame, new_parents: DataFrame, new_children: DataFrame, key: str, child_keys: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Parents, then children whose parent exists, each inserted once; the third result is the children that were refused."""
    parents = insert_ignore(parents, new_parents, [key])
    known = parents.select(key)
    ok = new_children.join(known, key, "left_semi")
    return parents, insert_ignore(children, ok, child_keys), new_children.join(known, key, "left_anti")


def file_urls(files: DataFrame, file_url: DataFrame, release_file: DataFrame) -> DataFrame:
    """(release_id, file_id, sha1, url, rel) of all files of releases."""
    return release_file.join(files, "file_id").join(file_url, "file_id").select("release_id", "file_id", "sha1", "url", "rel")


def add_urls(file_url: DataFrame, urls: DataFrame) -> DataFrame:
    """Addresses that a file has already are not added again."""
    return file_url.unionByName(new_rows(urls, file_url, ["file_id", "url"]), allowMissingColumns=True)


def best_access(urls: DataFrame, order: str, of: str = "release_id", host: str = "web.archive.org") -> DataFrame:
    """The last address that names the web archive's host, else the last of kind `webarchive`, else the last of all, by an explicit order; for each release, or for each work where `of` is its column."""
    rank = F.when(F.contains("url", F.lit(host)), 2).when(F.col("rel") == "webarchive", 1).otherwise(0)
    return urls.groupBy(of).agg(F.max_by("url", F.struct(rank, F.col(order))).alias("access_url"))


#: Fields by which entities are looked up besides their legacy identifier (fixed values).
LOOKUP_FIELDS = {"file": ("sha1", "sha256", "md5"), "creator": ("orcid",), "container": ("issnl", "issne", "issnp", "issn")}


def lookup(asked: DataFrame, table: DataFrame, kind: str) -> DataFrame:
    """(id_type, id_value, id, status) of distinct look-ups (id_type, id_value) in a table with `id` (text) and the kind's fields.

    Values are lower-cased but for `legacy_ident`, which names the id itself; of several entities the first by id counts. The
    status is found, not-found, or unsupported.
    """
    fields = [f for f in LOOKUP_FIELDS[kind] if f in table.columns]
    keys = table.select("id", F.explode(F.array(F.struct(F.lit("legacy_ident").alias("t"), F.col("id").alias("v")), *(F.struct(F.lit(f).alias("t"), F.lower(f).alias("v")) for f in fields))).alias("k"))
    known = keys.where("k.v IS NOT NULL").groupBy(F.col("k.t").alias("id_type"), F.col("k.v").alias("key")).agg(F.min("id").alias("id"))
    legacy = F.col("id_type") == "legacy_ident"
    wanted = asked.select("id_type", "id_value", F.when(legacy, ids.short_to_uuid(F.col("id_value"))).otherwise(F.lower("id_value")).alias("key")).distinct()
    status = F.when(~F.col("id_type").isin("legacy_ident", *fields), "unsupported").when(F.col("id").isNull(), "not-found").otherwise("found")
    return wanted.join(known, ["id_type", "key"], "left").select("id_type", "id_value", "id", status.alias("status"))


def children(parents: DataFrame, link: DataFrame, table: DataFrame, parent: str, child: str) -> DataFrame:
    """Each parent's children (parent, child, ...), once however often they are linked; link has both keys."""
    return parents.select(parent).distinct().join(link.select(parent, child).distinct(), parent).join(table, child)


def bulk_create(table: DataFrame, rows: DataFrame, keys: list[str], valid) -> tuple[DataFrame, DataFrame]:
    """The table with the valid rows whose key is free, and the outcome (keys, outcome) of every row given: created, exists or invalid."""
    ok = rows.where(F.coalesce(valid, F.lit(False)))
    marked = rows.select(*keys, F.coalesce(valid, F.lit(False)).alias("ok")).join(table.select(*keys).distinct().withColumn("known", F.lit(True)), keys, "left")
    return insert_ignore(table, ok, keys), marked.select(*keys, F.when(~F.col("ok"), "invalid").when(F.col("known"), "exists").otherwise("created").alias("outcome"))


def replace_with_children(parents: DataFrame, kids: DataFrame, new_parents: DataFrame, new_kids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Full replacement: parents that are given anew lose their old row and all their old children."""
    return replace_rows(parents, new_parents, [key]), delete_rows(kids, new_parents, [key]).unionByName(new_kids.join(new_parents.select(key), key, "left_semi").select(*kids.columns))


def titled(edges: DataFrame, key: str, titles: DataFrame) -> DataFrame:
    """edges with the title (key, title) of their target, NULL where it is unknown."""
    return edges.join(titles.select(key, "title"), key, "left")


EDGES = 250_000  # edges of a task that joins and counts them


def cited(edges: DataFrame, target: str, source: str, dates: DataFrame, size: int = EDGES) -> DataFrame:
    """(target, cited_by, first_cited) from edges and dates (source, date); works that cite twice count once.

    Both are dealt by source, about `size` edges a task, so what a task sorts and counts is the same for more edges; one dealing serves
    the join and the distinct pairs.
    """
    pairs = edges.select(F.col(target).alias("target"), source).where(F.col(source).isNotNull())
    n = max(edges.sparkSession.sparkContext.defaultParallelism, -(-pairs.count() // size))
    dated = pairs.repartition(n, source).join(dates.repartition(n, source), source)
    return dated.groupBy("target").agg(F.count_distinct(source).alias("cited_by"), F.min("date").alias("first_cited"))


def outgoing(edges: DataFrame, releases: DataFrame, release_id) -> DataFrame:
    """References of a release in order, with titles where the target is known."""
    return edges.where(F.col("release_id") == release_id).join(releases.select(F.col("id").alias("target_release_id"), "title"), "target_release_id", "left").orderBy("position")


def incoming(edges: DataFrame, releases: DataFrame, release_id) -> DataFrame:
    """Releases that cite a release, newest first."""
    return edges.where(F.col("target_release_id") == release_id).join(releases.select(F.col("id").alias("release_id"), "title", "release_year"), "release_id", "left").orderBy(F.desc_nulls_last("release_year"), "release_id")


def access_redirects(asked: DataFrame, urls: DataFrame, order: str, archive: str = "://web.archive.org/web/", store: str = "://archive.org/") -> DataFrame:
    """(ask_id, target) of asked (ask_id, work_id, original_url, path) by the works' addresses (work_id, url): the first, by an explicit order, that fits.

    An archived copy fits if it ends with the original address, and is answered by its raw form; a stored file fits if its address contains
    the path.  One join by work; none that fits: NULL.
    """
    j = asked.join(urls.select("work_id", "url", F.col(order).alias("__o")), "work_id")
    copy = F.contains("url", F.lit(archive)) & (F.coalesce("original_url", F.lit("")) != "") & F.endswith("url", F.col("original_url"))
    file = F.contains("url", F.lit(store)) & (F.coalesce("path", F.lit("")) != "") & F.contains("url", F.col("path"))
    raw = F.concat(F.substring_index("url", "/", 4), F.lit("/"), F.split_part("url", F.lit("/"), F.lit(5)), F.lit("id_/"), F.col("original_url"))
    fits = j.where(copy | file).groupBy("ask_id").agg(F.min_by(F.when(copy, F.regexp_replace(raw, "^http:", "https:")).otherwise(F.col("url")), "__o").alias("target"))
    return asked.select("ask_id").distinct().join(fits, "ask_id", "left")


#: Weights of what a citation and a release may agree in; the title's counts by the rarity of its tokens.
CITED_TITLE, CITED_NAMES, CITED_YEAR = 1.5, 1.0, 0.5


def match_citations(refs: DataFrame, releases: DataFrame, fallback: DataFrame | None = None, least: float = 80) -> DataFrame:
    """(ref_id, id, status, score) of every one of refs (ref_id, doi, title, and maybe year, creators) among releases (id, doi, title, and maybe release_year, contrib_names).

    A reference with an identifier is looked up by it: in the releases (`exact`), else in the fallback (id, doi; `fallback`), else it is `unknown`, as its
    title is not asked.  Others are compared by tokens: of what the reference gives, the share that the release agrees in, out of 100: tokens of the
    title by their rarity, surnames, the year.  The best of `least` or more is `fuzzy`, nothing that good `refused`.  What stands behind `Archived ` in a title is no title.
    """
    maybe = lambda df, c, kind: F.col(c) if c in df.columns else F.lit(None).cast(kind)
    r = refs.select(F.col("ref_id"), ids.lenient_doi(F.col("doi")).alias("key"), F.regexp_replace("title", "(?s)^(.+?)\\s*Archived .*$", "$1").alias("title"), maybe(refs, "year", "int").alias("year"), maybe(refs, "creators", "string").alias("creators"))
    table = lambda d: d.select("id", ids.lenient_doi(F.col("doi")).alias("key")).where("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("id"))
    nil = F.lit(None).cast("double")
    named = r.where("key IS NOT NULL").select("ref_id", "key").join(table(releases).withColumnRenamed("id", "own"), "key", "left")
    named = named.join(table(fallback).withColumnRenamed("id", "other"), "key", "left") if fallback is not None else named.withColumn("other", F.lit(None).cast(releases.schema["id"].dataType))
    status = F.when(F.col("own").isNotNull(), "exact").when(F.col("other").isNotNull(), "fallback").otherwise("unknown")
    named = named.select("ref_id", F.coalesce("own", "other").alias("id"), status.alias("status"), nil.alias("score"))

    rest = r.where("key IS NULL")
    near = title_pairs(rest.where("title IS NOT NULL").select(F.col("ref_id").alias("id"), "title"), releases.select(F.col("id").alias("target"), "title")).select(F.col("id").alias("ref_id"), F.col("target").alias("id"), "share")
    theirs = releases.select("id", maybe(releases, "release_year", "int").alias("release_year"), F.lower(F.coalesce(maybe(releases, "contrib_names", "string"), F.lit(""))).alias("names"))
    surnames = F.transform(text.split_creators(F.coalesce("creators", F.lit(""))), lambda x: F.lower(text.split_name(x)["surname"]))
    j = near.join(rest.select("ref_id", "year", surnames.alias("asked")), "ref_id").join(theirs, "id")
    people = F.when(F.size("asked") > 0, F.size(F.filter("asked", lambda x: F.contains("names", x))) / F.size("asked"))
    year = F.when(F.col("year").isNotNull(), (F.col("year") == F.col("release_year")).cast("double"))
    given = F.lit(CITED_TITLE) + F.when(people.isNotNull(), CITED_NAMES).otherwise(0.0) + F.when(year.isNotNull(), CITED_YEAR).otherwise(0.0)
    score = 100 * (CITED_TITLE * F.col("share") + CITED_NAMES * F.coalesce(people, F.lit(0.0)) + CITED_YEAR * F.coalesce(year, F.lit(0.0))) / given
    best = j.select("ref_id", "id", F.round(score, 3).alias("score")).where(F.col("score") >= least).groupBy("ref_id").agg(F.min_by(F.struct("id", "score"), F.struct((-F.col("score")).alias("s"), "id")).alias("b"))
    found = rest.select("ref_id").join(best, "ref_id", "left").select("ref_id", F.col("b.id").alias("id"), F.when(F.col("b").isNull(), "refused").otherwise("fuzzy").alias("status"), F.col("b.score").alias("score"))
    return named.unionByName(found)


def match_records(left: DataFrame, right: DataFrame) -> DataFrame:
    """As title matching for rows (id, title, creators) and (target, title, creators); where both name creators, one surname has to agree."""
    pairs = match_titles(left.select("id", "title"), right.select("target", "title"))
    names = lambda c: F.transform(text.split_creators(c), lambda x: F.lower(text.split_name(x)["surname"]))
    j = pairs.join(left.select("id", names(F.col("creators")).alias("a")), "id").join(right.select("target", names(F.col("creators")).alias("b")), "target")
    return j.where((F.coalesce(F.size("a"), F.lit(0)) < 1) | (F.coalesce(F.size("b"), F.lit(0)) < 1) | F.arrays_overlap("a", "b")).select("id", "target", "shared")


def series_report(series: DataFrame, ts: str, metrics: list[str], days: int) -> DataFrame:
    """(metric, start, value, change) of counters summed over periods of `days` from the first day.

    Rows become (metric, period) sums before the window, whose partitions are one row a period.
    """
    long_ = series.select(F.col(ts).cast("timestamp").alias("t"), *metrics).unpivot("t", metrics, "metric", "value")
    first = series.agg(F.date_trunc("day", F.min(F.col(ts).cast("timestamp"))).alias("first"))
    period = F.floor((F.unix_timestamp("t") - F.unix_timestamp("first")) / (86400 * days))
    sums = long_.join(F.broadcast(first)).groupBy("metric", "first", period.alias("p")).agg(F.sum("value").alias("value"))  # `first` is one row
    before = F.lag("value").over(Window.partitionBy("metric").orderBy("p"))
    from quire.operators.stats import change_label

    return sums.select("metric", F.timestamp_add("DAY", (F.col("p") * days).cast("int"), F.col("first")).alias("start"), "value", change_label(F.col("value"), before).alias("change"))
