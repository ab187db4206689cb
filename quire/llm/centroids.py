"""Exact integer clustering around centroids with Hamerly's bounds.

Method: each vector keeps an upper bound of the distance to its own centroid and one lower bound of the distance
to the second nearest.  After centroids have moved, the upper bound grows by the drift of the own centroid and the
lower bound falls by the largest drift of any other.  A vector whose upper bound is under its lower bound, or under
half the distance from its centroid to the next one, keeps its place unseen; else its upper bound is made exact,
and if that does not decide, the vector is scanned against all centroids in whole integers.  Bounds are rounded
outwards and must decide strictly, so ties always come to a scan, which takes the smaller number.

State is a stored table of vectors, places and bounds, written anew in each round by a map without a shuffle;
sums go through one small aggregate of a row for each centroid and batch.  The driver sees centroids, counts and
sums: k rows of `dims` numbers, whatever the number of vectors.

Cases: vectors of another length, or with a null or non-finite component, or null, are left out.  Rows with one id
each count; of the ids that begin as centroids, equal ones go in order of their vectors, and rows without an id
are kept but begin as centroids only where there are too few others.  Fewer vectors than k: as many centroids as
there are vectors.  No vectors: no rows.  Components beyond +-2**21 are refused with an error, as squared distances would
not fit a long.  Ids are of any type that casts to text; further columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

DIMS, K, ROUNDS, SCALE = 64, 16, 3, 64
MOST = 1 << 27  # of a scaled component, so that squared distances fit a long
OUT = 1 + 1e-9  # bounds are rounded outwards by this
ROWS = 4096  # of a block that numpy works on


def kept(vectors: DataFrame, id_col: str, vector_col: str, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """id, v: the usable vectors as whole numbers floor(scale * x)."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce((F.size(v) == dims) & ~bad, F.lit(False))
    whole = F.transform(v, lambda x: F.when(F.abs(x * scale) > MOST, F.raise_error(F.lit("a component is too large for exact distances"))).otherwise(F.floor(x * scale)).cast("int"))
    return vectors.where(usable).select(F.col(id_col).alias("id"), whole.alias("v"))


def seeds(points: DataFrame, k: int = K, seed: int = 1) -> np.ndarray:
    """The k vectors whose ids hash least: at most k rows come to the driver."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = points.select(h.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.int64) if len(column) else np.zeros((0, 0), np.int64)


def squared(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances of each vector to each centroid."""
    reach = max(int(np.abs(v).max(initial=0)), int(np.abs(centres).max(initial=0)))
    if 4 * reach * reach * max(v.shape[1], 1) < 1 << 53:  # every sum is exact as a double, so the matrix product is
        x, y = v.astype(np.float64), centres.astype(np.float64)
        return ((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)).astype(np.int64)
    return np.stack([((v - y) ** 2).sum(1) for y in centres], 1)


def scanned(v: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place (ties: the smaller number), squared distance, and lower bound of the second nearest."""
    d = squared(v, centres)
    at = d.argmin(1)
    best = d[np.arange(len(v)), at]
    d[np.arange(len(v)), at] = np.iinfo(np.int64).max
    return at, best, np.sqrt(d.min(1).astype(np.float64)) / OUT if len(centres) > 1 else np.full(len(v), np.inf)


def _assigned(batches, centres: np.ndarray, drift: np.ndarray, gap: np.ndarray, first: bool):
    """Rows of id, v, cluster, upper, lower, distance, scans (1 where all centroids were looked at); distance is exact where it is not null."""
    others = np.array([np.delete(drift, j).max(initial=0.0) for j in range(len(drift))])
    for whole in batches:
        for start in range(0, whole.num_rows, ROWS):
            b = whole.slice(start, ROWS)
            v, n = _matrix(b.column("v")), b.num_rows
            if first:
                at, best, low = scanned(v, centres)
                up, seen, scans = np.sqrt(best.astype(np.float64)) * OUT, np.ones(n, bool), np.ones(n, np.int64)
            else:
                at = b.column("cluster").to_numpy(zero_copy_only=False).astype(np.int64)
                up = (b.column("upper").to_numpy(zero_copy_only=False) + drift[at]) * OUT
                low = b.column("lower").to_numpy(zero_copy_only=False) - others[at] * OUT
                low = np.where(low > 0, low / OUT, low * OUT)
                best, seen, scans = np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(n, np.int64)
                wide = np.flatnonzero(up >= np.maximum(low, gap[at]))  # the upper bound made exact
                best[wide] = ((v[wide] - centres[at[wide]]) ** 2).sum(1)
                up[wide], seen[wide] = np.sqrt(best[wide].astype(np.float64)) * OUT, True
                wide = wide[up[wide] >= np.maximum(low[wide], gap[at[wide]])]  # still undecided: all centroids
                if len(wide):
                    at[wide], best[wide], low[wide] = scanned(v[wide], centres)
                    up[wide], scans[wide] = np.sqrt(best[wide].astype(np.float64)) * OUT, 1
            distance = pa.array(best, pa.int64(), mask=~seen)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array(at, pa.int32()), pa.array(up), pa.array(low), distance, pa.array(scans)], ["id", "v", "cluster", "upper", "lower", "distance", "scans"])


def _sums(batches, k: int):
    for b in batches:
        v, at = _matrix(b.column("v")), b.column("cluster").to_numpy(zero_copy_only=False)
        for j in np.unique(at):
            mine = v[at == j]
            yield pa.RecordBatch.from_arrays([pa.array([j], pa.int32()), pa.array([len(mine)], pa.int64()), pa.array([mine.sum(0).tolist()], pa.list_(pa.int64()))], ["cluster", "n", "sums"])


def moved(state: DataFrame, centres: np.ndarray) -> np.ndarray:
    """Each centroid with vectors at the floor of their mean, the others where they were."""
    k, dims = centres.shape
    parts = c.mapped(state.select("cluster", "v"), lambda batches: _sums(batches, k), "cluster int, n long, sums array<long>")
    rows = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(dims))).collect()  # k rows at most
    out = centres.copy()
    for r in rows:
        out[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(dims)]
    return out


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = 1) -> tuple[DataFrame, np.ndarray]:
    """State after the last assignment (id, v, cluster, upper, lower, distance, scans) and the final centroids."""
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, v array<int>, cluster int, upper double, lower double, distance long, scans long"
    c.settle(vectors.sparkSession)
    points = kept(vectors, id_col, vector_col, dims, scale)
    centres = seeds(points, k, seed)
    if not len(centres):
        return vectors.sparkSession.createDataFrame([], schema), np.zeros((0, dims), np.int64)
    drift, state = np.zeros(len(centres)), points
    with c.scratch():
        for step in range(rounds + 1):
            between = np.sqrt(squared(centres, centres).astype(np.float64))
            np.fill_diagonal(between, np.inf)
            gap = between.min(1) / 2 / OUT
            state = c.table(c.mapped(state, lambda batches, x=(centres, drift, gap, step == 0): _assigned(batches, *x), schema), "bounds", keep=step == rounds)
            if step < rounds:
                before, centres = centres, moved(state, centres)
                drift = np.sqrt(((centres - before) ** 2).sum(1).astype(np.float64)) * OUT
    return state, centres


def _exact(batches, centres: np.ndarray):
    for b in batches:
        at = b.column("cluster").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("cluster"), pa.array(((_matrix(b.column("v")) - centres[at]) ** 2).sum(1), pa.int64())], ["id", "cluster", "distance"])


def described(state: DataFrame, centres: np.ndarray) -> DataFrame:
    """id, cluster, distance of each vector, with the sums of distances and a digest of its centroid."""
    kind = state.schema["id"].dataType.simpleString()
    if not len(centres):
        return state.select("id", "cluster", F.coalesce("distance", F.lit(0)).alias("distance"), *(F.lit(0).cast("long").alias(x) for x in ("cluster_inertia", "inertia")), F.lit("").alias("centroid_sha256"))
    placed = c.mapped(state.select("id", "v", "cluster"), lambda batches: _exact(batches, centres), f"id {kind}, cluster int, distance long")
    sums = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows at most
    digests = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in centres.tolist()]
    own = F.array(*(F.lit(sums.get(j, 0)).cast("long") for j in range(len(centres))))
    return placed.select(
        "id", "cluster", "distance", own[F.col("cluster")].alias("cluster_inertia"), F.lit(sum(sums.values())).cast("long").alias("inertia"), F.array(*map(F.lit, digests))[F.col("cluster")].alias("centroid_sha256")
    )


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, centres = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return described(state, centres).withColumnRenamed("id", "vec_id")


def _oracle() -> str:
    """All vectors against all centroids in each round, without bounds."""
    steps = []
    for i in range(ROUNDS + 1):
        steps.append(f"""
d{i} AS (SELECT e.r, c.j, sum((e.x - c.x) * (e.x - c.x))::BIGINT AS d FROM e JOIN c{i} c ON e.i = c.i GROUP BY 1, 2),
a{i} AS (SELECT r, d, j FROM d{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, j) = 1)""")
        if i < ROUNDS:
            steps.append(f"""
s{i} AS (SELECT a.j, e.i, sum(e.x)::BIGINT AS s, count(*)::BIGINT AS n FROM a{i} a JOIN e ON e.r = a.r GROUP BY 1, 2),
c{i + 1} AS (SELECT c.j, c.i, CASE WHEN s.n IS NULL THEN c.x ELSE (s.s - ((s.s % s.n) + s.n) % s.n) // s.n END AS x FROM c{i} c LEFT JOIN s{i} s ON s.j = c.j AND s.i = c.i)""")
    return f"""
WITH k AS (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NOT NULL AND isfinite(x))) = {DIMS}),
e AS MATERIALIZED (SELECT r, unnest(range({DIMS})) AS i, floor({SCALE} * unnest(v))::BIGINT AS x FROM k),
f AS (SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, v) - 1 AS j FROM k),
c0 AS (SELECT f.j, e.i, e.x FROM f JOIN e ON e.r = f.r WHERE f.j < {K}),{",".join(steps)},
h AS (SELECT j, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY 1)
SELECT k.vec_id, a.j::INTEGER AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.j))::BIGINT AS cluster_inertia,
  (sum(a.d) OVER ())::BIGINT AS inertia, h.centroid_sha256
FROM a{ROUNDS} a JOIN k ON k.r = a.r JOIN h ON h.j = a.j"""


OP11_SQL = _oracle()
