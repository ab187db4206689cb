"""Joins, look-ups, upserts, set comparisons, ordered choices and paging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_first(rows: DataFrame, table: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """rows with the id of the first key, in order, that the table knows. The table has one row for each (key, value).

    Keys are unpivoted, so it is one join however many there are; rows need a unique `row_id`.
    """
    wide = rows.select("row_id", F.explode(F.array(*(F.struct(F.lit(i).alias("rank"), F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for i, k in enumerate(keys)))).alias("x"))
    wide = wide.select("row_id", "x.*").where("value IS NOT NULL AND value <> ''")
    hit = wide.join(table, ["key", "value"]).groupBy("row_id").agg(F.min_by(id_col, "rank").alias(id_col))
    return rows.join(hit, "row_id", "left")


def lookup_any(table: DataFrame, columns: list[str], values: DataFrame, value: str) -> DataFrame:
    """Rows of the table any of whose key columns has one of the values; an equi-join on unpivoted keys, each row once."""
    keys = table.select("*", F.explode(F.array_distinct(F.array_compact(F.array(*(F.col(k).cast("string") for k in columns))))).alias("__key"))
    return keys.join(values.select(F.col(value).cast("string").alias("__key")).distinct(), "__key", "left_semi").drop("__key").distinct()


def scalar(rows: DataFrame, table: DataFrame, row_key: str, key: str, value: str, name: str) -> DataFrame:
    """rows with the one value that the table has for their key, NULL if none; a key with several values fails."""
    one = table.groupBy(F.col(key).alias("__key")).agg(F.when(F.count("*") > 1, F.raise_error(F.concat(F.lit("several values for "), F.max(key).cast("string")))).otherwise(F.max(value)).alias(name))
    return rows.join(one, rows[row_key] == one["__key"], "left").drop("__key")


def among(rows: DataFrame, key: str, listed: DataFrame, listed_key: str) -> DataFrame:
    """Rows whose key is listed, each once however often it is."""
    return rows.join(listed.select(F.col(listed_key).alias(key)), key, "left_semi").select(*rows.columns)


def by_suffix(rows: DataFrame, column: str, suffixes: DataFrame, suffix: str) -> DataFrame:
    """rows with each suffix (one row each) that their column ends with.

    The suffixes of the distinct values are keys, so this is an equi-join instead of a nested loop, and what is
    exploded grows with the number of different values.
    """
    own = rows.select(F.col(column).alias("__own")).where("__own <> ''").distinct()
    keys = own.select("__own", F.explode(F.transform(F.sequence(F.lit(1), F.length("__own")), lambda i: F.substr("__own", i))).alias(suffix)).join(suffixes.select(suffix), suffix)
    return rows.join(keys, rows[column] == keys["__own"]).drop("__own")


GRAM = 3


def _grams(column: str, lengths: list[int]):
    """Distinct pieces of the text, of each length."""
    one = lambda n: F.transform(F.sequence(F.lit(1), F.length(column) - n + 1), lambda i: F.substr(F.col(column), i, F.lit(n)))
    return F.array_distinct(F.concat(*(F.when(F.length(column) >= n, one(n)).otherwise(F.array().cast("array<string>")) for n in lengths)))


def by_substring(rows: DataFrame, column: str, patterns: DataFrame, pattern: str) -> DataFrame:
    """rows with each pattern (one row each) that their column contains.

    A pattern is looked for by its rarest piece of three characters (all of it, if it is shorter), as counted in the distinct
    values, so this is an equi-join whose pairs are checked, instead of a nested loop.  Empty patterns and nulls find nothing.
    """
    own = rows.select(F.col(column).alias("__own")).where("__own <> ''").distinct()
    asked = patterns.select(F.col(pattern).alias("__p")).where("__p <> ''").distinct()
    shorter = F.least(F.length("__p"), F.lit(GRAM))
    pieces = own.select("__own", F.explode(_grams("__own", list(range(1, GRAM + 1)))).alias("__g"))
    wanted = asked.select("__p", F.explode(F.filter(_grams("__p", list(range(1, GRAM + 1))), lambda g: F.length(g) == shorter)).alias("__g"))
    used = pieces.join(wanted.select("__g").distinct(), "__g", "left_semi")
    counts = used.groupBy("__g").agg(F.count("*").alias("__n"))
    rarest = wanted.join(counts, "__g", "left").groupBy("__p").agg(F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), F.col("__g").alias("g"))).alias("k")).where("k.n > 0").select("__p", F.col("k.g").alias("__g"))
    hits = used.join(rarest, "__g").where(F.contains("__own", F.col("__p"))).select("__own", F.col("__p").alias(pattern))
    return rows.join(hits, rows[column] == hits["__own"]).drop("__own")


def missing(sets: list[DataFrame], known: DataFrame, key: str) -> DataFrame:
    """Distinct keys of any of the sets that are not known."""
    every = reduce(DataFrame.unionByName, (d.select(F.col(key).cast("string").alias(key)) for d in sets)).where(F.col(key).isNotNull())
    return every.distinct().join(known.select(F.col(key).cast("string").alias(key)), key, "left_anti")


def duplicates(df: DataFrame, key: str | Column, id_col: str, least: int = 2) -> DataFrame:
    """(key, n, first_id) of keys with `least` rows or more."""
    return df.groupBy((F.col(key) if isinstance(key, str) else key).alias("key")).agg(F.count("*").alias("n"), F.min(id_col).alias("first_id")).where(F.col("n") >= least)


def new_rows(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not known yet, one of each key."""
    return rows.dropDuplicates(keys).join(known.select(*keys).distinct(), keys, "left_anti")


def insert_ignore(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Insert where the key is free."""
    return table.unionByName(new_rows(rows, table, keys), allowMissingColumns=True)


def replace_rows(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Full replacement: all rows of a key that is given anew go."""
    return table.join(rows.select(*keys).distinct(), keys, "left_anti").unionByName(rows, allowMissingColumns=True)


def delete_rows(table: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    return table.join(listed.select(*keys).distinct(), keys, "left_anti")


def outcome_counts(rows: DataFrame, known: DataFrame, keys: list[str], reason: Column) -> DataFrame:
    """created, existing and skipped of an ingest, in one pass over the rows."""
    seen = rows.join(known.select(*keys).distinct().withColumn("__known", F.lit(True)), keys, "left")
    state = F.when(reason.isNotNull(), F.concat(F.lit("skipped:"), reason)).when(F.col("__known"), "existing").otherwise("created")
    return seen.groupBy(state.alias("outcome")).agg(F.count("*").alias("n"))


def _best(df: DataFrame, key: str | list[str], order: list[Column], *more: Column) -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    best = F.min_by(F.struct(*df.columns), F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)))).alias("__best")
    return df.groupBy(*(F.col(k).alias(f"__key{i}") for i, k in enumerate(keys))).agg(best, *more).select("__best.*", *(F.col("inner_count") for _ in more))


def first_of(df: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    """The row of each key that is smallest by `order` (negate a column to have its largest first).

    An aggregate, so that tasks hand on one row a key and a hot key meets as few rows as there are tasks.
    """
    return _best(df, key, order)


def collapse(df: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    """As `first_of`, with inner_count: the number of rows that each stands for."""
    return _best(df, key, order, F.count("*").alias("inner_count"))


def overlaps(sets: dict[str, DataFrame], key: str) -> DataFrame:
    """(a, b, size_a, size_b, both, only_a, only_b, jaccard) of all pairs of sets, from one shuffle on the key.

    Each key becomes a bit mask of the sets that hold it; pairs are counted over masks, of which there are few.
    """
    names = list(sets)
    rows = reduce(DataFrame.unionByName, (d.select(F.col(key).cast("string").alias("k"), F.lit(1 << i).alias("bit")) for i, d in enumerate(sets.values())))
    masks = rows.where("k IS NOT NULL").groupBy("k").agg(F.bit_or("bit").alias("mask")).groupBy("mask").agg(F.count("*").alias("n"))
    pairs = [F.struct(F.lit(names[i]).alias("a"), F.lit(names[j]).alias("b"), F.lit(1 << i).alias("x"), F.lit(1 << j).alias("y")) for i in range(len(names)) for j in range(i + 1, len(names))]
    wide = masks.select("n", "mask", F.explode(F.array(*pairs)).alias("p")).select("n", "p.a", "p.b", (F.col("mask").bitwiseAND(F.col("p.x")) != 0).alias("x"), (F.col("mask").bitwiseAND(F.col("p.y")) != 0).alias("y"))
    of = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    x, y = F.col("x"), F.col("y")
    out = wide.groupBy("a", "b").agg(of(x).alias("size_a"), of(y).alias("size_b"), of(x & y).alias("both"), of(x & ~y).alias("only_a"), of(y & ~x).alias("only_b"))
    return out.withColumn("jaccard", F.round(F.col("both") / F.nullif(F.col("both") + F.col("only_a") + F.col("only_b"), F.lit(0)), 4))


def page(df: DataFrame, order: list[Column], offset: int, limit: int, most: int = 300) -> DataFrame:
    """One page; the limit and offset are clamped."""
    return df.orderBy(*order).offset(max(0, min(offset, 200))).limit(max(0, min(limit, most)))


def capped_total(df: DataFrame, cap: int) -> DataFrame:
    """(total, estimated): counting stops one row beyond the cap."""
    return df.limit(cap + 1).agg(F.least(F.count("*"), F.lit(cap)).alias("total"), (F.count("*") > cap).alias("estimated"))


def keyset(df: DataFrame, ts: str, id_: str, at: tuple[str, int] | None, size: int, older: bool = True) -> DataFrame:
    """Rows beyond a cursor, nearest first, one more than `size` if there are more."""
    rows = df
    if at:
        here = F.struct(F.lit(at[0]).cast("timestamp").alias(ts), F.lit(at[1]).cast("long").alias(id_))
        rows = df.where(F.struct(ts, id_) < here if older else F.struct(ts, id_) > here)
    order = [F.desc(ts), F.desc(id_)] if older else [F.asc(ts), F.asc(id_)]
    return rows.orderBy(*order).limit(size + 1)


def cursor(ts: Column, id_: Column) -> Column:
    return F.concat_ws("_", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), id_.cast("string"))


def parse_cursor(raw: Column) -> Column:
    """struct(ts, id) of a cursor, NULL if it is none."""
    ts, id_ = F.regexp_extract(raw, "^(.*)_([^_]*)$", 1).try_cast("timestamp"), F.regexp_extract(raw, "^(.*)_([^_]*)$", 2)
    return F.when(ts.isNotNull() & id_.rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$|^[0-9]+$"), F.struct(ts.alias("ts"), id_.alias("id")))


def missing_last(df: DataFrame, column: str, id_col: str, limit: int) -> DataFrame:
    """The largest values first, rows without one last, ties by id."""
    return df.orderBy(F.desc_nulls_last(column), id_col).limit(limit)


def numeric_key(x: Column) -> Column:
    """Numbers first by value, anything else last."""
    return F.coalesce(x.try_cast("int"), F.lit(99999999))
