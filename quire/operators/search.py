"""Search predicates and scores as Columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_value(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    """The value of the first condition that holds."""
    out = otherwise
    for condition, value in reversed(cases):
        out = F.when(condition, value).otherwise(out)
    return out


def first_reason(cases: list[tuple[str, Column]], otherwise: str | None = None) -> Column:
    """The name of the first condition that holds."""
    return first_value([(condition, F.lit(name)) for name, condition in cases], F.lit(otherwise).cast("string"))


def bool_filter(must: list[Column] = (), should: list[Column] = (), must_not: list[Column] = (), least: int = 1) -> Column:
    """All of must, none of must_not (unknown counts as no), at least `least` of should."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    parts = [yes(c) for c in must] + [~yes(c) for c in must_not]
    if should:
        parts.append(sum((yes(c).cast("int") for c in should), F.lit(0)) >= least)
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def drill_down(column: str, value, given: bool) -> Column:
    """Unconstrained if not given, explicitly missing if None, else equal."""
    return F.lit(True) if not given else F.col(column).isNull() if value is None else F.col(column) == value


#: Facets by name; the first of each kind stands for unknown names (fixed values).
DATE_FACETS = ("all_time", "past_week", "past_year", "since_2000", "before_1931")
TYPE_FACETS = {"papers": ("article-journal", "paper-conference", "chapter", "article"), "reports": ("report", "standard"), "datasets": ("dataset", "software"), "everything": ()}
ACCESS_FACETS = {"fulltext": ("wayback", "ia_file", "ia_sim"), "microfilm": ("ia_sim",), "oa": (), "everything": ()}


def date_facet(column: str, name: str, today: str) -> Column:
    day, x = F.lit(today).cast("date"), F.col(column)
    kinds = {"past_week": x >= F.date_sub(day, 7), "past_year": x >= F.add_months(day, -12), "since_2000": x >= F.lit("2000-01-01").cast("date"), "before_1931": x < F.lit("1931-01-01").cast("date")}
    return kinds.get(name, F.lit(True))


def type_facet(column: str, name: str) -> Column:
    kinds = TYPE_FACETS.get(name, TYPE_FACETS["papers"])
    return F.col(column).isin(*kinds) if kinds else F.lit(True)


def access_facet(access_types: str, tags: str, name: str) -> Column:
    """By the kinds of a document's accesses (an array), or by the tag `oa`."""
    name = name if name in ACCESS_FACETS else "fulltext"
    if name == "oa":
        return F.array_contains(tags, "oa")
    kinds = ACCESS_FACETS[name]
    return F.arrays_overlap(F.col(access_types), F.array(*map(F.lit, kinds))) if kinds else F.lit(True)


def contains_all(words: str, columns: list[str]) -> Column:
    """Every word of a query is somewhere in one of the columns, without regard to case."""
    return reduce(lambda a, b: a & b, (reduce(lambda x, y: x | y, (F.coalesce(F.contains(F.lower(c), F.lit(w.lower())), F.lit(False)) for c in columns)) for w in words.split()), F.lit(True))


def shown_total(total: Column, estimated: Column, shown: Column, offset: int, size: int) -> Column:
    """struct(total, estimated): a first page that is not full says how many results there are."""
    short = (F.lit(offset) == 0) & (shown < size)
    return F.struct(F.when(short, shown).otherwise(total).alias("total"), (~short & estimated).alias("estimated"))


def bm25(df: DataFrame, terms: list[str], fields: dict[str, float], k: float = 1.2, b: float = 0.75) -> DataFrame:
    """df with `score`: the sum over fields and terms of weight * idf * saturated frequency, from statistics of all rows, counted in one pass.

    Terms are compared with the fields' words (letters and digits, without regard to case).
    """
    same = lambda t: lambda v: v == t.lower()
    words = {f: F.filter(F.split(F.lower(F.coalesce(f, F.lit(""))), r"[^\p{L}\p{Nd}]+"), lambda w: w != "") for f in fields}
    x = df.select("*", *(F.size(w).alias(f"__n_{f}") for f, w in words.items()), *(F.size(F.filter(w, same(t))).alias(f"__tf_{f}_{i}") for f, w in words.items() for i, t in enumerate(terms)))
    total = x.agg(F.count("*").alias("__rows"), *(F.avg(f"__n_{f}").alias(f"__avg_{f}") for f in fields), *(F.count_if(F.col(f"__tf_{f}_{i}") > 0).alias(f"__df_{f}_{i}") for f in fields for i in range(len(terms))))
    x, score = x.join(F.broadcast(total)), F.lit(0.0)  # one row
    for f, weight in fields.items():
        for i in range(len(terms)):
            tf, n = F.col(f"__tf_{f}_{i}"), F.col(f"__df_{f}_{i}")
            idf = F.log(1 + (F.col("__rows") - n + 0.5) / (n + 0.5))
            score = score + weight * idf * tf * (k + 1) / (tf + k * (1 - b + b * F.col(f"__n_{f}") / F.col(f"__avg_{f}")))
    return x.select(*df.columns, score.alias("score"))


def weighted_hits(term: str, fields: dict[str, int]) -> Column:
    """Occurrences of a term by field, weighted."""
    low = term.lower()
    hits = lambda c: F.floor((F.length(c) - F.length(F.replace(F.lower(c), F.lit(low), F.lit("")))) / len(low))
    return sum((hits(F.col(c)) * w for c, w in fields.items()), F.lit(0)).cast("long")


def boosted(score: Column, should: list[tuple[Column, float]] = (), negative: list[Column] = (), factor: float = 0.5) -> Column:
    """Adds each boost that applies, and halves what a negative condition meets."""
    out = score.cast("double")
    for condition, boost in should:
        out = out + F.when(condition, boost).otherwise(0.0)
    for condition in negative:
        out = F.when(condition, out * factor).otherwise(out)
    return out
