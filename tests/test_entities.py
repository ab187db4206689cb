from pyspark.sql import functions as F

from quire.operators import entities
from quire.sources import feeds


def test_citations(spark):
    refs = spark.createDataFrame([(1, "https://doi.org/10.1/A", None), (2, None, "neural networks predicting weather"), (3, None, "nothing alike")], "ref_id int, doi string, title string")
    rel = spark.createDataFrame([("a", "10.1/a", "x"), ("b", None, "Predicting weather with neural models")], "id string, doi string, title string")
    assert {(r["ref_id"], r["id"], r["status"]) for r in entities.match_citations(refs, rel).collect()} == {(1, "a", "exact"), (2, "b", "fuzzy")}


def test_records(spark):
    left = spark.createDataFrame([(1, "neural weather models", "Ada Lovelace; X Y"), (2, "neural weather models", "Bob Z"), (3, "neural weather models", None)], "id int, title string, creators string")
    right = spark.createDataFrame([("t", "weather models, neural", "Lovelace, Ada")], "target string, title string, creators string")
    assert sorted(r["id"] for r in entities.match_records(left, right).collect()) == [1, 3]


def test_patch_is_idempotent(spark):
    p, c = spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(1, 1)], "k int, n int")
    np_, nc = spark.createDataFrame([(1, "x"), (2, "b")], "k int, v string"), spark.createDataFrame([(1, 1), (2, 5), (9, 9)], "k int, n int")
    a, b, refused = entities.patch(p, c, np_, nc, "k", ["k", "n"])
    a2, b2, _ = entities.patch(a, b, np_, nc, "k", ["k", "n"])
    assert (a.count(), b.count(), refused.count(), a2.count(), b2.count()) == (2, 2, 1, 2, 2)


def test_current_and_legacy(spark):
    i = spark.createDataFrame([("aaisem2ekvthpcezvk54zxpo74", 1, True, None), ("aaaaaaaaaaaaaaaaaaaaaaaaaa", 2, False, None)], "ident string, rev_id int, is_live boolean, redirect_id string")
    r = spark.createDataFrame([(1, "10.1/x", ""), (2, None, None)], "rev_id int, doi string, pmid string")
    rows = entities.current(i, r)
    assert rows.first()["id"] == "00112233-4455-6677-8899-aabbccddeeff"
    assert [(x["id_type"], x["id_value"]) for x in entities.legacy_ids(rows, "id", ["doi", "pmid"]).collect()] == [("doi", "10.1/x")]


def test_best_access(spark):
    u = spark.createDataFrame([("r", "w1", "webarchive", 1), ("r", "w2", "webarchive", 2), ("r", "z", "web", 9), ("s", "z", "web", 1)], "release_id string, url string, rel string, o int")
    assert {r["release_id"]: r["access_url"] for r in entities.best_access(u, "o").collect()} == {"r": "w2", "s": "z"}
    more = spark.createDataFrame([("r", "https://web.archive.org/web/1/a", "repository", 1), ("r", "w", "webarchive", 2)], u.schema)
    assert entities.best_access(more, "o").first()["access_url"] == "https://web.archive.org/web/1/a"


def test_report(spark):
    s = spark.createDataFrame([("2024-01-01", 1), ("2024-01-05", 1), ("2024-01-08", 4), ("2024-01-20", 3)], "t string, n int")
    got = {str(r["start"])[:10]: (r["value"], r["change"]) for r in entities.series_report(s.withColumn("m", F.lit(0)), "t", ["n", "m"], 7).where("metric = 'n'").collect()}
    assert got == {"2024-01-01": (2, "?"), "2024-01-08": (4, "100"), "2024-01-15": (3, "-25")}


def test_feeds(spark, tmp_path):
    (tmp_path / "x-2024-01-01.json").write_text('{"k": 1}\n')
    (tmp_path / "x-2024-01-03.json").write_text('{"k": 2}\n')
    got = feeds.daily(spark, str(tmp_path) + "/x-{day}.json", "2024-01-01", "2024-01-03", "k int").collect()
    assert [(r["k"], str(r["day"])) for r in got] == [(1, "2024-01-01")] and feeds.window("2024-03-01") == ("2024-02-29", "2024-03-01")


def test_cited_deals_by_source_once(spark):
    edges = spark.createDataFrame([(k % 7, k % 50 if k % 11 else None) for k in range(400)], "target long, source long")
    dates = spark.createDataFrame([(k, f"2020-01-{k % 28 + 1:02d}") for k in range(0, 50, 2)], "source long, date string")
    got = entities.cited(edges, "target", "source", dates, size=20)
    want: dict = {}
    for k in range(400):
        if k % 11 and k % 50 % 2 == 0:
            want.setdefault(k % 7, set()).add(k % 50)
    assert {r["target"]: (r["cited_by"], r["first_cited"]) for r in got.collect()} == {t: (len(s), min(f"2020-01-{k % 28 + 1:02d}" for k in s)) for t, s in want.items()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "hashpartitioning(target" in plan and ", source" not in "".join(x for x in plan.split("\n") if "ENSURE_REQUIREMENTS" in x and "hashpartitioning" in x)
