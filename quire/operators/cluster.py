"""Title clusters and title matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text


def keyed(df: DataFrame, id_col: str, title_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), text.title_key(F.col(title_col)).alias("title_key")).where("title_key <> ''")


def clusters(df: DataFrame, id_col: str, title_col: str, least: int = 2) -> DataFrame:
    """(title_key, n, first_id, last_id) of titles that normalise alike, by partial counts: no group is gathered."""
    found = keyed(df, id_col, title_col).groupBy("title_key").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    return found.where(F.col("n") >= least)


def members(df: DataFrame, id_col: str, title_col: str, least: int = 2) -> DataFrame:
    """(title_key, n, id): the members of each cluster as rows."""
    rows = keyed(df, id_col, title_col)
    return rows.join(clusters(df, id_col, title_col, least).select("title_key", "n"), "title_key").select("title_key", "n", "id")


def match_titles(left: DataFrame, right: DataFrame) -> DataFrame:
    """(id, target, shared, score), as `title_pairs`."""
    return title_pairs(left, right).select("id", "target", "shared", "score")


def title_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """(id, target, shared, score, share) of titles of right (target, title) that have 40 % of the tokens of one of left (id, title).

    A title with 40 % of n tokens has one of the n - ceil(0.4 n) + 1 rarest, so only these are joined on, and what
    they find is checked on the whole token sets.  The score sums up how rare the shared tokens are among right's titles,
    and the share is its part of what all of left's tokens would give; tokens that none of right's titles has weigh as the rarest.
    """
    r = right.select("target", text.title_tokens(F.col("title")).alias("theirs"))
    each = r.select("target", F.explode("theirs").alias("t"))
    known = each.groupBy("t").agg(F.count("*").alias("n"))
    total = r.agg(F.count("*").alias("total"))
    l_ = left.select("id", text.title_tokens(F.col("title")).alias("tokens")).where(F.size("tokens") > 0)
    one = l_.select("id", F.explode("tokens").alias("t")).join(known, "t", "left").join(F.broadcast(total))  # one row
    weight = F.log(1 + F.col("total") / F.col("n"))
    own = one.groupBy("id").agg(F.count("*").alias("size"), F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "t", F.coalesce(weight, F.log(1 + F.col("total"))).alias("w")))).alias("own"))
    rare = F.slice("own", F.lit(1), F.col("size") - F.ceil(F.col("size") * 2 / 5).cast("int") + 1)
    pairs = own.select("id", F.explode(rare).alias("k")).where("k.n > 0").select("id", F.col("k.t").alias("t")).join(each, "t").select("id", "target").distinct()
    both = pairs.join(own, "id").join(r, "target").withColumn("hit", F.filter("own", lambda x: F.array_contains("theirs", x["t"])))
    found = both.select("id", "target", "size", F.size("hit").alias("shared"), F.round(F.aggregate("hit", F.lit(0.0), lambda a, x: a + x["w"]), 6).alias("score"), F.try_divide(F.aggregate("hit", F.lit(0.0), lambda a, x: a + x["w"]), F.aggregate("own", F.lit(0.0), lambda a, x: a + x["w"])).alias("share"))
    return found.where("shared * 5 >= size * 2").select("id", "target", "shared", "score", "share")


def best_match(left: DataFrame, right: DataFrame) -> DataFrame:
    """(id, target): of left (id, title, creators) the best match in right (target, title, contrib_names), by score, then by target.

    Where creators (`a; b`) are given, one of them must be among the contributors' names.
    """
    pairs = match_titles(left.select("id", "title"), right.select("target", "title"))
    names = left.select("id", text.split_creators(F.coalesce("creators", F.lit(""))).alias("names"))
    theirs = right.select("target", F.lower(F.coalesce("contrib_names", F.lit(""))).alias("contrib_names"))
    ok = pairs.join(names, "id").join(theirs, "target").where((F.size("names") == 0) | F.exists("names", lambda n: F.contains(F.col("contrib_names"), F.lower(n))))
    return ok.groupBy("id").agg(F.min_by("target", F.struct((-F.col("score")).alias("s"), "target")).alias("target"))
