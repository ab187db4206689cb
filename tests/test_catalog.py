"""Every catalog query with SQL gives the rows of that SQL."""

import datetime
import re

import duckdb
import pytest

from quire.functions.text import STOP_WORDS
from quire.plans import catalog, flows, services, upstream  # noqa: F401  these register their queries in catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, float) or type(v).__name__ == "Decimal":
        return round(float(v), 6)
    if isinstance(v, datetime.date) and not isinstance(v, datetime.datetime):
        return f"{v} 00:00:00"
    return str(v) if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, sf, duck, name):
    df = catalog.QUERIES[name](spark, sf)
    result = duck.sql(catalog.ORACLES[name])
    assert sorted(df.columns) == sorted(result.columns)
    cols = sorted(df.columns)
    mine = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
    at = [result.columns.index(c) for c in cols]
    theirs = sorted(repr([plain(r[i]) for i in at]) for r in result.fetchall())
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_sql_runs(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf).columns


def test_title_overlap_match_reads_whole_items(spark, tmp_path):
    word = lambda i: f"word{i:03d}"
    items = {1: " ".join(map(word, range(40))), 2: " ".join(map(word, range(20))) + "\n" + " ".join(map(word, range(50, 70))), 3: "short title with four more", 4: "", 5: None}
    found = {10: " ".join(map(word, range(20, 40))), 11: " ".join(map(word, range(8))), 12: " ".join(map(word, [*range(16), 99])), 13: " ".join(map(word, range(50, 66))) + "\n" + items[1], 14: "Short, title\nwith four more", 15: None}
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(list(found.items()), "doc_id long, text string").selectExpr("*", "'s' AS source").write.parquet(f"{tmp_path}/documents.parquet")
    tokens = lambda t: {w for w in re.split(r"[\W_]+", (t or "").lower()) if len(w) >= 4} - set(STOP_WORDS)
    left, right = {i: tokens(t) for i, t in items.items()}, {i: tokens((t or "").split("\n")[0]) for i, t in found.items()}
    want = sorted((i, k, len(a & b)) for i, a in left.items() for k, b in right.items() if a & b and 5 * len(a & b) >= 2 * len(a))
    got = sorted((r["id"], r["target"], r["shared"]) for r in catalog.QUERIES["title_overlap_match"](spark, str(tmp_path)).collect())
    assert got == want and (1, 10, 20) in got and (2, 13, 16) in got and (1, 11, 8) not in got


def test_approx_distinct_is_near(spark, sf):
    near = {r["event_type"]: r["users"] for r in catalog.QUERIES["approx_distinct"](spark, sf).collect()}
    exact = {r["event_type"]: r["users"] for r in catalog.QUERIES["exact_distinct"](spark, sf).collect()}
    assert all(abs(near[k] - exact[k]) <= 0.05 * exact[k] + 1 for k in exact)


def made(spark, name: str) -> list:
    """Folders of that name in the shared folder."""
    from pathlib import Path

    return sorted(Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:").replace("//", "/")).glob(f"quire-{name}-*"))


def test_growing_files_are_as_many_as_lines_need(spark, sf, duck, monkeypatch):
    monkeypatch.setattr(flows, "FILE", 100)
    got = sorted(map(tuple, catalog.QUERIES["growing_files"](spark, sf).collect()))
    assert got == sorted(duck.sql(catalog.ORACLES["growing_files"]).fetchall())
    assert max(len(list(p.glob("part-*.jsonl"))) for p in made(spark, "growing")) == -(-len(got) // 100)


def test_archives_are_files_of_bounded_size(spark, sf, duck, monkeypatch):
    monkeypatch.setattr(flows, "ARCHIVE", 1 << 14)
    got = sorted(map(tuple, catalog.QUERIES["archives_in_parts"](spark, sf).collect()))
    assert got == sorted(duck.sql(catalog.ORACLES["archives_in_parts"]).fetchall())
    assert max(len(list(p.glob("*.warc.gz"))) for p in made(spark, "archives")) > 2


def test_upstream_records_are_dealt_narrow_and_written_packed(spark, sf):
    before = set(made(spark, "datacite"))
    runs = lambda: spark._jsparkSession.sharedState().statusStore().executionsList()
    first = runs().size()
    assert catalog.QUERIES["datacite_works"](spark, sf).columns
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    (path,) = set(made(spark, "datacite")) - before
    assert {p.name.partition(".")[2] for p in path.glob("part-*")} == {"json.gz"}
    written = [p for p in (runs().apply(i).physicalPlanDescription() for i in range(first, runs().size())) if "InsertIntoHadoopFsRelationCommand" in p]
    assert len(written) == 1 and "titles" not in "".join(x for x in written[0].split("\n\n") if x.lstrip().partition(" ")[2].startswith("Exchange"))
