"""Holdings reports: which journals qualify, and their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import identifiers

THRESHOLD = 15
PAPERS = ("article-journal", "conference_paper", "article", "post", "report", "retraction")
BLOCKED = ("book-series", "blog", "magazine", "trade", "test", "repository", "archive")
FIELDS = (
    "publication_type", "publication_title", "print_identifier", "online_identifier", "date_first_issue_online", "num_first_vol_online",
    "num_first_issue_online", "date_last_issue_online", "num_last_vol_online", "num_last_issue_online", "title_url", "first_author",
    "title_id", "coverage_depth", "coverage_notes", "publisher_name", "linking_issn",
)
#: Candidate tiers: bright at least, every other class at most.
TIERS = ((20, 5), (200, 20), (1000, 100))


def candidates(stats: DataFrame) -> DataFrame:
    """Containers (bright, dark, shadows_only, none and identifiers) worth evaluating."""
    tier = None
    for least, most in TIERS:
        one = (F.col("bright") >= least) & (F.col("none") <= most) & (F.col("dark") <= most) & (F.col("shadows_only") <= most)
        tier = one if tier is None else tier | one
    kinds = ~F.coalesce("container_type", F.lit("")).isin("archive", "repository") & (F.coalesce("publisher_type", F.lit("")) != "big5")
    return stats.where(tier & kinds & (F.col("issne").isNotNull() | F.col("issnp").isNotNull()) & F.col("issnl").isNotNull())


def spans(releases: DataFrame, papers: tuple[str, ...] = PAPERS) -> DataFrame:
    """What eligibility needs of each container: counts on all releases and papers, and its fully preserved years and volumes."""
    paper, bright = F.col("release_type").isin(*papers), F.col("preservation") == "bright"
    base = releases.groupBy("container_id").agg(
        F.count("*").alias("total"), F.count_if(bright).alias("bright"), F.count_if(paper).alias("papers"), F.count_if(paper & bright).alias("papers_bright"),
    )

    def per(value: str, numeric: bool):
        rows = releases.where(F.col(value).isNotNull()).groupBy("container_id", F.col(value).alias("v")).agg(F.count_if(bright).alias("b"), F.count_if(~bright).alias("rest"))
        full = (F.col("b") > 0) & (F.col("rest") == 0)
        n = F.when(full, F.col("v").cast("string").try_cast("int"))
        return rows.groupBy("container_id").agg(
            F.count("*").alias(f"{value}s"), F.sum("b").alias(f"{value}_bright"), F.count_if(full).alias(f"{value}s_full"), F.count_if(full & F.col("v").cast("string").try_cast("int").isNull()).alias(f"{value}s_odd"),
            F.min(n).alias(f"{value}_first"), F.max(n).alias(f"{value}_last"), F.count_distinct(n).alias(f"{value}s_distinct"),
        )

    return base.join(per("year", True), "container_id", "left").join(per("volume", False), "container_id", "left")


def eligibility(containers: DataFrame, spans_: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """containers with `status`: the first check that fails, or success. Both inputs have one row a container."""
    c = containers.withColumn("issne", F.coalesce(F.nullif("issne", F.lit("")), F.get_json_object("extra", "$.issne")))
    c = c.withColumn("issnp", F.coalesce(F.nullif("issnp", F.lit("")), F.get_json_object("extra", "$.issnp")))
    d = c.join(spans_, "container_id", "left").fillna(0, [x for x, t in spans_.dtypes if t in ("bigint", "int") and x != "container_id" and not x.endswith(("_first", "_last"))])
    n, share = F.col, lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0)) < 0.8
    checks = (
        ("container-type", F.coalesce("container_type", F.lit("")).isin(*BLOCKED)),
        ("missing-issnl", F.coalesce("issnl", F.lit("")) == ""),
        ("missing-issn", F.coalesce(F.nullif("issne", F.lit("")), F.nullif("issnp", F.lit(""))).isNull()),
        ("few-releases", n("total") < threshold),
        ("low-overall-preservation-fraction", share("bright", "total")),
        ("few-papers", n("papers") < threshold),
        ("low-paper-fraction", share("papers", "total")),
        ("few-preserved-papers", n("papers_bright") < threshold),
        ("low-paper-preservation-fraction", share("papers_bright", "papers")),
        ("no-year-spans", n("years") == 0),
        ("no-volume-spans", n("volumes") == 0),
        ("no-preserved-year-spans", n("years_full") == 0),
        ("no-preserved-volume-spans", n("volumes_full") == 0),
        ("short-preserved-year-spans", n("years_full") < 2),
        ("short-preserved-volume-spans", n("volumes_full") < 2),
        ("few-preserved-with-year", n("year_bright") < threshold),
        ("few-preserved-with-volume", n("volume_bright") < threshold),
        ("low-preserved-with-year-fraction", share("year_bright", "papers")),
        ("low-preserved-with-volume-fraction", share("volume_bright", "papers")),
        ("non-contiguous-years", n("year_last") - n("year_first") + 1 != n("years_distinct")),
        ("non-integer-volumes", n("volumes_odd") > 0),
        ("non-contiguous-volumes", n("volume_last") - n("volume_first") + 1 != n("volumes_distinct")),
    )
    status = F.lit("success")
    for name, failed in reversed(checks):
        status = F.when(failed, name).otherwise(status)
    return d.withColumn("status", status)


def rows(eligible: DataFrame, this_year: int) -> DataFrame:
    """The report's 17 columns; a span that reaches the running year ends one year and volume earlier."""
    early = F.when(F.col("year_last") == this_year, 1).otherwise(0)
    filled = {
        "publication_type": F.lit("serial"), "publication_title": F.col("name"), "print_identifier": F.col("issnp"), "online_identifier": F.col("issne"),
        "date_first_issue_online": F.col("year_first").cast("string"), "num_first_vol_online": F.col("volume_first").cast("string"),
        "date_last_issue_online": (F.col("year_last") - early).cast("string"), "num_last_vol_online": (F.col("volume_last") - early).cast("string"),
        "title_id": F.concat(F.lit("container_"), F.col("container_id").cast("string")), "coverage_depth": F.lit("fulltext"),
        "publisher_name": F.col("publisher"), "linking_issn": F.col("issnl"),
    }
    return eligible.where("status = 'success'").select(*(F.coalesce(filled.get(f, F.lit("")), F.lit("")).alias(f) for f in FIELDS))


def dump(containers: DataFrame, spans_: DataFrame, ident: str, position: str) -> DataFrame:
    """(position, info): each container with its status and counts as JSON, to be evaluated again later; what is no identifier has the status bad-ident."""
    e = eligibility(containers, spans_)
    bad = identifiers.short_to_uuid(F.col(ident)).isNull()
    kept = [c for c in e.columns if c not in ("status", ident, position)]
    return e.select(F.col(position).alias("position"), F.to_json(F.struct(F.col(ident).alias("ident"), F.when(bad, "bad-ident").otherwise(F.col("status")).alias("status"), *kept)).alias("info"))


def replay(dumped: DataFrame, schema: str, spans_columns: list[str], this_year: int) -> DataFrame:
    """Report rows, and status and position, of dumped containers (position, info) in their order; where a status is missing, the container is evaluated again."""
    x = dumped.select("position", F.from_json("info", schema).alias("x")).select("position", "x.*")
    given = x.withColumnRenamed("status", "__given")
    e = eligibility(given.drop(*spans_columns), given.select("container_id", *spans_columns)).withColumn("status", F.coalesce(F.nullif("__given", F.lit("")), F.col("status")))
    r = rows(e, this_year)
    return e.select("position", "ident", "status", F.concat(F.lit("container_"), F.col("container_id").cast("string")).alias("title_id")).join(r, "title_id", "left").orderBy("position")


def write_tsv(report: DataFrame, path: str) -> None:
    """Header and rows with CRLF line ends. The header is the first partition's first line."""
    lines = report.select(F.concat_ws("\t", *(F.translate(F.col(f), "\t\r\n", "   ") for f in FIELDS)).alias("value"))
    head = report.sparkSession.createDataFrame([("\t".join(FIELDS),)], "value string")
    head.unionByName(lines).write.mode("overwrite").option("lineSep", "\r\n").text(path)


def combined(*reports: DataFrame) -> DataFrame:
    """Reports one after another, one header."""
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r.select(*FIELDS))
    return out


def with_linking_issn(titles: DataFrame, issn_map: DataFrame) -> DataFrame:
    """Titles (print_identifier, online_identifier) with their linking ISSN: print first, then online."""
    p, o = (issn_map.select(F.col("issn").alias(k), F.col("issnl").alias(f"l_{k}")) for k in ("print_identifier", "online_identifier"))
    joined = titles.drop("linking_issn").join(p, "print_identifier", "left").join(o, "online_identifier", "left")
    return joined.withColumn("linking_issn", F.coalesce("l_print_identifier", "l_online_identifier")).drop("l_print_identifier", "l_online_identifier")
