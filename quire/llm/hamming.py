"""Exact top-k search in Hamming space by incremental multi-index hashing.

Method: a binary code is cut into segments of 16 bits and indexed once for each.  By the pigeonhole
principle a code at distance d has a segment at distance d // m or less, so when all m segments have been
searched to radius r, every code within m * (r + 1) - 1 has been seen.  Radii grow one at a time, the new
ring of segment values is joined with the index, candidates are verified on whole codes, and a query leaves
the search when its k-th verified distance is within what has been covered.

A ring names buckets, by the upper bits of a segment, each once: a query never probes more than all buckets of a segment, which
is a scan of the index, however far its radius has grown.

Equal codes are one entry with their k smallest ids, so a code that a third of the rows share is one row of
the index, and candidates that are worse than the current k-th distance do not leave the join.

Joins of codes, queries and candidates are merges, as a file's size says little of what a broadcast of it takes of the driver: codes
and ids pack well.  Only the numbers of buckets' parts are broadcast, at most 2**18 rows.

Cases: vectors that are null or empty have no code and neither query nor answer; NaN and null components are zero
bits; vectors of several lengths are compared with zero bits for what is missing; fewer than k rows give
what there is; ties go to the smallest id; a query finds itself; repeated ids count once for each code; rows without an id are
left out, other columns may have any name; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as c

K, BITS = 10, 16


def sign_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int | None = None) -> DataFrame:
    """(id, w array<long>): one bit per component, set where it is positive, 64 to a word."""
    words = -(-(dims or vectors.agg(F.max(F.size(vector_col))).first()[0] or 1) // 64)

    def run(batches):
        for b in batches:
            col = b.column("v")
            at = col.offsets.to_numpy().astype(np.int64)
            flat = col.flatten() if not col.null_count else col.values.slice(at[0], at[-1] - at[0])
            x = np.nan_to_num(np.asarray(flat.to_numpy(zero_copy_only=False), float)) > 0
            size = np.diff(at)
            bits = np.zeros((len(size), words * 64), bool)
            row = np.repeat(np.arange(len(size)), size)
            bits[row, np.arange(len(row)) - np.repeat(at[:-1] - at[0], size)] = x
            w = np.packbits(bits, axis=1, bitorder="little").view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * words), pa.array(w.ravel()))], names=["id", "w"])

    rows = vectors.where(F.col(id_col).isNotNull() & (F.size(vector_col) > 0)).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    return rows.transform(c.mapped, run, "id long, w array<long>")


def _own(w: np.ndarray) -> np.ndarray:
    """Segment values of codes, one row a code."""
    return w.reshape(len(w), -1).view(np.uint16).astype(np.int64)


def _dealt(prefix: int, radius: int | None):
    """Rows (w, x, y) to rows (seg, prefix, w, x, y): codes to their own bucket, queries to those that can hold a segment at `radius` bits from theirs."""
    near = [v for v in range(1 << prefix) if radius is None and v == 0 or radius is not None and 0 <= radius - bin(v).count("1") <= BITS - prefix]
    flips = np.array(near, np.int64)

    def run(batches):
        for b in batches:
            if not b.num_rows or not len(flips):
                continue
            own = _own(b.column("w").flatten().to_numpy().reshape(b.num_rows, -1)) >> (BITS - prefix)
            m = own.shape[1]
            row = np.repeat(np.arange(b.num_rows), m * len(flips))
            part = b.take(pa.array(row))
            seg = np.tile(np.repeat(np.arange(m), len(flips)), b.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(seg), pa.array((own[:, :, None] ^ flips).ravel()), *part.columns], names=["seg", "prefix", *b.schema.names])

    return run


def _compared(words: int, radius: int, k: int):
    """Blocks of queries against blocks of one bucket's codes: pairs whose segment differs by `radius` bits and whose verified distance is within the query's current k-th, at most k a query and block."""

    def run(batches):
        for b in batches:
            for seg, qs, cs in zip(b.column("seg").to_pylist(), b.column("queries").to_pylist(), b.column("codes").to_pylist(), strict=True):
                q, code = (np.array([list(x["w"]) for x in v], np.int64) for v in (qs, cs))
                worst, low = np.array([x["x"] for x in qs]), np.array([x["x"] for x in cs])
                sq, sc = _own(q)[:, seg], _own(code)[:, seg]
                hits_q, hits_c, hits_d = [], [], []
                for i in range(0, len(q), 256):
                    ring = np.bitwise_count(sq[i : i + 256, None] ^ sc) == radius
                    r, j = np.nonzero(ring)
                    d = np.bitwise_count((q[i + r] ^ code[j]).view(c.U)).sum(axis=1, dtype=np.int64)
                    ok = d <= worst[i + r]
                    hits_q.append(i + r[ok])
                    hits_c.append(j[ok])
                    hits_d.append(d[ok])
                r, j, d = (np.concatenate(x) for x in (hits_q, hits_c, hits_d))
                order = np.lexsort((low[j], d, r))
                r, j, d = r[order], j[order], d[order]
                keep = np.arange(len(r)) - np.searchsorted(r, r) < k
                r, j, d = r[keep], j[keep], d[keep]
                offs = pa.array(np.arange(len(r) + 1, dtype=np.int32) * words)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offs, pa.array(q[r].ravel())), pa.ListArray.from_arrays(offs, pa.array(code[j].ravel())), pa.array(d.astype(np.int32))], names=["w", "cw", "distance"])

    return run


def topk(codes: DataFrame, queries: DataFrame, k: int = K, block: int = 4096) -> DataFrame:
    """(query_id, rank, id, distance): the k nearest codes (id, w) of each query (id, w).

    Buckets are segment values by their upper bits, so many that a bucket holds about `block` codes (all 16 bits
    when there are 2**28 codes); a bucket with more is cut by a hash of the code.
    """
    first = codes.select("w").first()
    words = len(first["w"]) if first else 1
    m = words * 64 // BITS
    rank = F.row_number().over(Window.partitionBy("w").orderBy("id"))
    ids = c.table(codes.groupBy("w", "id").agg(F.lit(1).alias("r")).withColumn("r", rank).where(F.col("r") <= k).groupBy("w").agg(F.array_sort(F.collect_list("id")).alias("ids")), "codes")  # k ids a code at most
    total = ids.count()
    prefix = min(BITS, max(0, (total // block).bit_length()))
    dealt = ids.select("w", F.col("ids")[0].alias("x")).transform(c.mapped, _dealt(prefix, None), "seg long, prefix long, w array<long>, x long")
    size = dealt.groupBy("seg", "prefix").agg(F.ceil(F.count("*") / block).alias("parts"))
    one = F.struct("w", "x")
    index = dealt.join(F.broadcast(size), ["seg", "prefix"]).groupBy("seg", "prefix", F.pmod(F.xxhash64("w"), F.col("parts")).alias("part")).agg(F.collect_list(one).alias("codes"))
    index = c.table(index, "index")
    asked = c.table(queries.distinct(), "asked")
    live = c.table(asked.select("w").distinct().withColumn("x", F.lit(64 * words).cast("long")), "live")
    groups = max(1, live.count() // 1024)
    order = F.row_number().over(Window.partitionBy("w").orderBy("distance", "id"))
    best = done = None
    for radius in range(BITS + 1):
        probes = live.transform(c.mapped, _dealt(prefix, radius), "seg long, prefix long, w array<long>, x long")
        probes = probes.groupBy("seg", "prefix", F.pmod(F.xxhash64("w", "x"), F.lit(groups)).alias("group")).agg(F.collect_list(one).alias("queries"))
        found = probes.join(index.hint("merge"), ["seg", "prefix"]).select("seg", "queries", "codes").transform(c.mapped, _compared(words, radius, k), "w array<long>, cw array<long>, distance int")
        found = (found if best is None else found.unionByName(best)).distinct()
        wide = found.join(ids.withColumnRenamed("w", "cw").hint("merge"), "cw").select("w", "cw", "distance", F.explode("ids").alias("id"))
        top = c.table(wide.withColumn("rank", order).where(F.col("rank") <= k), "top")
        state = top.groupBy("w").agg(F.count("*").alias("n"), F.max("distance").alias("last"))
        covered = F.coalesce((F.col("n") >= k) & (F.col("last") <= m * (radius + 1) - 1), F.lit(False)) | F.lit(radius == BITS)
        joined = c.table(live.select("w").join(state.hint("merge"), "w", "left").withColumn("covered", covered), "state")
        ended = top.join(joined.where("covered").select("w").hint("merge"), "w", "left_semi").select("w", "rank", "id", "distance")
        done = ended if done is None else done.unionByName(ended)
        live = joined.where("not covered").select("w", F.when(F.col("n") >= k, F.col("last")).otherwise(64 * words).cast("long").alias("x"))
        if not live.limit(1).count():
            break
        best = top.join(live.select("w").hint("merge"), "w", "left_semi").select("w", "cw", "distance").distinct()
    return asked.select(F.col("id").alias("query_id"), "w").join(done.hint("merge"), "w").select("query_id", "rank", "id", "distance")


def op2_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = c.table(sign_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet")), "signs")
    found = topk(codes, codes.where("id % 20 = 0"))
    return found.select("query_id", F.col("rank").cast("long").alias("rank"), F.col("id").alias("vec_id"), F.col("distance").cast("long").alias("distance"))


OP2_SQL = """
WITH e AS (SELECT vec_id, unnest(embedding) > 0 AS b, generate_subscripts(embedding, 1) AS i FROM embeddings),
d AS (SELECT q.vec_id AS query_id, r.vec_id, count(*) FILTER (q.b <> r.b) AS distance
  FROM e q JOIN e r ON q.i = r.i WHERE q.vec_id % 20 = 0 GROUP BY 1, 2)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank, vec_id, distance
FROM d QUALIFY rank <= 10"""
