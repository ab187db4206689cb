"""Removal of every byte covered by a long string that also starts elsewhere (exact substring dedup).

Method: induced sorting over a sampled suffix array, with Spark's external sort as the disk-backed queue.
Sampled are the suffixes that start at a window's smallest 32-byte fingerprint: each window of `length` bytes owns
exactly one, at a place fixed by the window's own bytes, so equal windows own equal samples at equal distance.
Tuples of sampled suffixes (name, document, place, and the bytes that decide) are sorted on disk by name; names
that occur once are dropped, as nothing that they own can repeat.  Within a name the suffixes are sorted by their
bytes to the right, and what stands before them by bytes to the left; neighbours in both orders give common-prefix
values.  From these the order of all suffixes before a sample is induced, one byte further left at a time: the
suffix j bytes before a sample shares `length` bytes with another exactly if some sample of the same name has the
same j bytes before it and a common prefix of length - j or more, which both orders' values tell without
another look at the bytes.

Names need not be sorted again by a recursion, since `length` bytes decide and tuples carry that many.  Two kinds of
names go another way, window by window as fingerprints that are counted by shuffle: those with more tuples than one
task should hold, and those of a repetitive text, where one name is the smallest of more windows than a sample can
own (a tuple then stands for the whole stretch and hands on each of its distinct windows once).

Cases: null and empty texts have no bytes and lose none; texts under `length` bytes lose none; copies of a whole text
are collapsed first and lose everything when long enough; a row that is repeated whole is a copy of itself, and rows
with one id and several texts are documents of their own; rows without an id are left out, but `remove_repeats`
works on all rows and keeps other columns, which may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c
from .common import replaced

LENGTH, GRAM = 200, 32
HOT = (2048, 32768)  # a name is hot from twice a task's share of tuples, but within these
HEAVY = 200_000  # fingerprints that are broadcast at most: those that are found most often
SEGMENT = 1 << 23
_LOW = c.U((1 << 24) - 1)


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    n = len(x)
    block = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, c.U)
    block[:n] = x
    block = block.reshape(-1, w)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


def _windows(data: np.ndarray, width: int) -> np.ndarray:
    """Fingerprint of data[i:i+width] for each i."""
    n = len(data)
    p, q = c.powers(n + 1)
    sums = np.zeros(n + 1, c.U)
    np.cumsum((data.astype(c.U) + c.U(1)) * p[:n], out=sums[1:])
    return c.mix((sums[width:] - sums[:-width]) * q[: n - width + 1])


def _sample(data: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Name of each sampled suffix, the first and the number of the windows that it owns, and its place from the first (-1: a repetitive stretch)."""
    width = length - gram + 1
    for at in range(0, len(data) - length + 1, SEGMENT):
        part = data[at : at + SEGMENT + length - 1]
        h = _windows(part, gram)
        # the leftmost minimum: place breaks ties of the upper 40 bits
        low = _sliding_min((h & ~_LOW) | np.arange(len(h), dtype=c.U), width)
        own, value = (low & _LOW).astype(np.int64), low >> c.U(24)
        stretch = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
        size = np.diff(np.append(stretch, len(own)))
        long_ = np.repeat(size > width, size)
        new = np.append(True, own[1:] != own[:-1]) & ~long_
        new[stretch] = True
        first = np.flatnonzero(new)
        place = np.where(long_[first], -1, own[first] - first)
        yield h[own[first]].view(np.int64), first + at, np.diff(np.append(first, len(own))), place


def _sampled(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = c.strings(batch.column("text"))
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for i, j in c.pieces(off):
                found = [(ids[k], *s) for k in range(i, j) if off[k + 1] - off[k] >= length for s in _sample(data[off[k] : off[k + 1]], length, gram)]
                if found:
                    whole = [np.concatenate([f[k] for f in found]) for k in (1, 2, 3, 4)]
                    doc = np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(whole[0]), pa.array(doc), *(pa.array(x.astype(np.int32)) for x in whole[1:])], names=["key", "doc_id", "first", "n", "place"])

    return docs.transform(c.mapped, run, "key long, doc_id long, first int, n int, place int")


TUPLE = "key long, doc_id long, first int, place int, ctx binary, hot boolean"


def _contexts(length: int):
    """Tuples with their bytes: all windows that a sampled suffix owns."""

    def run(batches):
        for batch in batches:
            data, off = c.strings(batch.column("text"))
            ids, lists = batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("owned")
            at = lists.offsets.to_numpy()
            own = lists.flatten()
            keys, first, n, place, hot = (own.field(k) for k in ("key", "first", "n", "place", "hot"))
            first, n = first.to_numpy(), n.to_numpy()
            base, raw = at[0], data.tobytes()
            for i in range(0, len(ids), 500):
                j = min(i + 500, len(ids))
                lo, hi = at[i] - base, at[j] - base
                row = np.repeat(np.arange(i, j), np.diff(at[i : j + 1]))
                start = off[row] + first[lo:hi]
                end = start + n[lo:hi] + length - 1
                ctx = pa.array([raw[s:e] for s, e in zip(start.tolist(), end.tolist(), strict=True)], pa.binary())
                cut = [x.slice(lo, hi - lo) for x in (keys, place, hot)]
                yield pa.RecordBatch.from_arrays([cut[0], pa.array(ids[row]), pa.array(first[lo:hi]), cut[1], ctx, cut[2]], names=["key", "doc_id", "first", "place", "ctx", "hot"])

    return run


def _runs(rows: np.ndarray, places: np.ndarray, ids: np.ndarray, first: np.ndarray, length: int) -> pa.RecordBatch:
    """Covered intervals from repeated windows, ordered by row and place."""
    new = np.append(True, (rows[1:] != rows[:-1]) | (places[1:] != places[:-1] + 1))
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(rows)) - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[rows[a]].astype(np.int64)), pa.array((first[rows[a]] + places[a]).astype(np.int32)), pa.array((first[rows[a]] + places[b] + length).astype(np.int32))], names=["doc_id", "start", "end"]
    )


def _ordered(key: np.ndarray, data: np.ndarray, at: np.ndarray, size: np.ndarray, width: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of suffixes by name and `width` bytes read from `at` in direction `step`, and how many bytes each shares with its predecessor (-1: another name).

    Bytes beyond `size` count as zero.
    """
    m = len(key)
    wide = np.zeros((m, 8 + width), np.uint8)
    wide[:, :8] = key.astype(">i8").view(np.uint8).reshape(m, 8)
    reach = np.arange(width)
    inside = reach < size[:, None]
    wide[:, 8:][inside] = data[(at[:, None] + step * reach)[inside]]
    order = np.argsort(wide.view(f"S{8 + width}").ravel(), kind="stable")
    wide = wide[order]
    differ = np.ones((m, 8 + width + 1), bool)
    differ[1:, :-1] = wide[1:] != wide[:-1]
    shared = differ.argmax(axis=1) - 8
    shared[0] = -1
    return order, np.maximum(shared, -1)


def repeats(key: np.ndarray, data: np.ndarray, off: np.ndarray, place: np.ndarray, n: np.ndarray, length: int) -> np.ndarray:
    """Which windows of each tuple repeat, a row a tuple, by distance before its sample: column j is the window that starts j bytes before it.

    Tuples are grouped by the bytes that they share: at distance j those to the left with j bytes in common, those to the
    right with length - j, both read off the common-prefix values of the two orders.
    """
    m, most = len(key), int(place.max()) + 1
    sample = off[:-1] + place
    right, after = _ordered(key, data, sample, off[1:] - sample, length, 1)
    left, before = _ordered(key, data, sample - 1, place, most, -1)
    near = []
    for order, shared in ((right, after), (left, before)):
        best = np.full(m, -1)
        best[order] = np.maximum(shared, np.append(shared[1:], -1))
        near.append(best)
    hit = np.zeros((m, most), bool)
    place_r, place_l = np.empty(m, np.int64), np.empty(m, np.int64)
    for j in range(most):
        own = np.flatnonzero((place >= j) & (place - j < n) & (near[0] >= length - j) & (near[1] >= j))
        if len(own) < 2:
            continue
        place_r[right] = np.cumsum(after < length - j)
        place_l[left] = np.cumsum(before < j)
        group = place_l[own] * (m + 1) + place_r[own]
        by = np.argsort(group, kind="stable")
        same = np.flatnonzero(group[by[1:]] == group[by[:-1]])
        hit[own[by[same]], j] = hit[own[by[same + 1]], j] = True
    return hit


def _induced(length: int):
    """Sorted tuples in, covered intervals out; the tuples of a name are never split."""

    def solve(t: pa.Table) -> Iterator[pa.RecordBatch]:
        key = t["key"].to_numpy()
        same = np.append(False, key[1:] == key[:-1])
        same[:-1] |= same[1:]
        if not same.any():
            return
        t = t.filter(pa.array(same))
        key, place = t["key"].to_numpy(), t["place"].to_numpy().astype(np.int64)
        data, off = c.strings(t["ctx"])
        hit = repeats(key, data, off, place, np.diff(off) - length + 1, length)
        rows, j = np.nonzero(hit[:, ::-1])
        if len(rows):
            yield _runs(rows, place[rows] - (hit.shape[1] - 1 - j), t["doc_id"].to_numpy(), t["first"].to_numpy(), length)

    def run(batches):
        kept: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 4000):
                part = batch.slice(at, 4000)
                kept.append(part)
                size += part.num_rows
                if size >= 12000 and part.column("key")[0].as_py() != part.column("key")[-1].as_py():
                    key = part.column("key").to_numpy()
                    split = int(np.searchsorted(key, key[-1], "left"))
                    yield from solve(pa.Table.from_batches([*kept[:-1], part.slice(0, split)]))
                    kept, size = [part.slice(split)], part.num_rows - split
        if kept:
            yield from solve(pa.Table.from_batches(kept))

    return run


def _windows_of(b: pa.RecordBatch, length: int):
    """Row, place in the text and fingerprint of the tuples' windows, by row, fingerprint and place, and where each fingerprint's run begins; some tuples at a time."""
    data, off = c.strings(b.column("ctx"))
    first = b.column("first").to_numpy().astype(np.int64)
    for i, j in c.pieces(off, 1 << 20):
        n = np.diff(off[i : j + 1]) - length + 1
        row = np.repeat(np.arange(i, j), n)
        place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        prints = _windows(data[off[i] : off[j]], length)[off[row] - off[i] + place]
        order = np.lexsort((place, prints, row))
        row, place, prints = row[order], place[order] + first[row[order]], prints[order].view(np.int64)
        yield row, place, prints, np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (prints[1:] != prints[:-1])))


def _prints(length: int):
    """Tuples to how often each has each of its windows, times how many such tuples there are: (print, n)."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                for row, _, prints, head in _windows_of(b, length):
                    n = np.diff(np.append(head, len(row))) * b.column("n").to_numpy()[row[head]]
                    key, back = np.unique(prints[head], return_inverse=True)
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.bincount(back, n).astype(np.int64))], names=["print", "n"])

    return run


def _marked(length: int, heavy):
    """Tuples to covered intervals (print is null) where windows repeat within a tuple or are among the frequent ones, and to the other windows, that remain to be looked up."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                ids = b.column("doc_id").to_numpy()
                for row, place, prints, head in _windows_of(b, length):
                    times = np.diff(np.append(head, len(row)))
                    known = np.repeat(times > 1, times)
                    if len(heavy.value):
                        known |= heavy.value[np.minimum(np.searchsorted(heavy.value, prints), len(heavy.value) - 1)] == prints
                    by = np.lexsort((place[known], row[known]))
                    runs = _runs(row[known][by], place[known][by], ids, np.zeros(len(ids), np.int64), length) if known.any() else None
                    if runs is not None:
                        yield pa.RecordBatch.from_arrays([pa.nulls(runs.num_rows, pa.int64()), *runs.columns], names=["print", *runs.schema.names])
                    rest = place[~known].astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(prints[~known]), pa.array(ids[row[~known]]), pa.array(rest), pa.array(rest + np.int32(length))], names=["print", "doc_id", "start", "end"])

    return run


def _counted(tuples: DataFrame, length: int) -> DataFrame:
    """Covered intervals of the tuples of hot names.

    Equal tuples repeat all over, and one stands for them among the others.  Windows are counted by fingerprint; those that
    are found most often are known to all tasks, so that no window's rows meet in one.
    """
    spark = tuples.sparkSession
    tuples = c.table(tuples.withColumn("digest", F.md5("ctx")).withColumn("size", F.octet_length("ctx")), "tuples")
    kinds = c.table(tuples.groupBy("key", "digest").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "first")).alias("one")), "kinds")
    several = F.coalesce(F.col("n") > 1, F.lit(False))
    often = kinds.where(F.col("n") > max(64, tuples.count() // HEAVY)).select("key", "digest")  # HEAVY rows at most
    many = tuples.select("key", "digest", "doc_id", F.col("first").alias("start"), (F.col("first") + F.col("size")).alias("end"))
    some = kinds.where(several).select("key", "digest").join(F.broadcast(often), ["key", "digest"], "left_anti")
    whole = [many.join(F.broadcast(often), ["key", "digest"], "left_semi"), many.join(some, ["key", "digest"], "left_semi")]
    ones = c.table(tuples.join(kinds.select("one.doc_id", "one.first", "n"), ["doc_id", "first"]).select("doc_id", "first", "ctx", "n"), "ones")
    counts = c.table(ones.transform(c.mapped, _prints(length), "print long, n long").groupBy("print").agg(F.sum("n").alias("n")).where("n > 1"), "prints")
    limit = max(16, (counts.agg(F.sum("n")).first()[0] or 0) // HEAVY)
    heavy = np.sort(counts.where(F.col("n") > limit).select("print").toArrow()["print"].to_numpy())  # HEAVY rows at most
    marked = c.table(ones.where("n = 1").transform(c.mapped, _marked(length, spark.sparkContext.broadcast(heavy)), "print long, doc_id long, start int, end int"), "marked")
    light = marked.where("print IS NOT NULL").join(counts.where(F.col("n") <= limit).select("print"), "print")
    return reduce(DataFrame.unionByName, (x.select("doc_id", "start", "end") for x in (*whole, marked.where("print IS NULL"), light)))


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, spans array<struct<start,end>>): byte intervals to remove, unmerged, for the texts (doc_id, text) that have any; ids are unique.

    Whole copies are represented by one text; a group with a copy is covered from end to end.
    """
    spark = texts.sparkSession
    kinds = c.table(texts.select("doc_id", F.sha2("text", 256).alias("sha"), F.octet_length("text").alias("n_bytes")).where(F.col("n_bytes") >= length), "kinds")
    same = c.table(kinds.groupBy("sha").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "same")
    anchors = c.table(_sampled(texts, length, gram), "anchors")
    anchors = anchors.join(same.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    # stored, so that the join below reads both sides from exchanges of its own and a hot name can be split
    names = c.table(anchors.groupBy("key").agg(F.count("*").alias("members"), F.min("place").alias("least")).where("members > 1 OR least < 0"), "names")
    owned = c.table(anchors.join(names, "key"), "owned")
    share = 2 * owned.count() // max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    hot = (F.col("members") > min(max(HOT[0], share), HOT[1])) | (F.col("least") < 0)
    lists = owned.groupBy("doc_id").agg(F.collect_list(F.struct("key", "first", "n", "place", hot.alias("hot"))).alias("owned"))
    contexts = texts.join(lists, "doc_id").transform(c.mapped, _contexts(length), TUPLE)
    plain = contexts.where("not hot").drop("hot").repartition("key").sortWithinPartitions("key").transform(c.mapped, _induced(length), "doc_id long, start int, end int")
    if owned.where(hot).limit(1).count():
        plain = plain.unionByName(_counted(contexts.where("hot").select("key", "doc_id", "first", "ctx"), length))
    spans = plain.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    whole = kinds.join(same.where("copies > 1").select("sha"), "sha", "left_semi").select("doc_id", F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").alias("end"))).alias("spans"))
    return spans.join(whole.select("doc_id"), "doc_id", "left_anti").unionByName(whole)


def _kept(batches):
    """Texts without the bytes of their spans; the spans merged."""
    for batch in batches:
        data, off = c.strings(batch.column("text"))
        raw = data.tobytes()
        texts, cut, runs = [], [], []
        for i, spans in enumerate(batch.column("spans").to_pylist()):
            text, at, out, n, last = raw[off[i] : off[i + 1]], 0, [], 0, -1
            for s, e in sorted((x["start"], x["end"]) for x in spans):
                if s > last:
                    out.append(text[at:s])
                    n += 1
                at = last = max(last, e)
            out.append(text[at:])
            texts.append(b"".join(out))
            cut.append(len(text) - len(texts[-1]))
            runs.append(n)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary()), pa.array(cut, pa.int64()), pa.array(runs, pa.int64())], names=["doc_id", "kept", "n_removed", "n_spans"])


def shortened(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, kept binary, n_removed, n_spans) of the texts (doc_id, text) that lose bytes; ids are unique."""
    with c.scratch():
        spans = repeated_spans(texts, length)
        return c.table(texts.join(spans, "doc_id").transform(c.mapped, _kept, "doc_id long, kept binary, n_removed long, n_spans long"), "shortened", keep=True)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """The documents, all columns, their texts without repeated strings; a character that loses some of its bytes goes whole."""

    def run(batches):
        for b in batches:
            texts = [bytes(x).decode("utf-8", "ignore") for x in b.column("kept").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows, _ = c.keyed(docs, id_col)
    less = shortened(c.id_text(rows, c.ROW, text_col), length).select("doc_id", "kept").transform(c.mapped, run, "doc_id long, text string")
    return replaced(rows, less, c.ROW, text_col).select(*docs.columns)


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row with an id."""
    rows, _ = c.keyed(docs.where(F.col(id_col).isNotNull()).select(id_col, text_col), id_col)
    less = shortened(c.id_text(rows, c.ROW, text_col), length).select(F.col("doc_id").alias(c.ROW), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = rows.select(c.ROW, F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha"))
    return whole.join(less, c.ROW, "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256")
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP6_SQL = r"""
WITH b AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
w AS (SELECT r, i, md5(substr(h, 2 * i + 1, 400)) AS m FROM (SELECT r, h, unnest(range(0, n - 199)) AS i FROM b WHERE n >= 200)),
d AS (SELECT m FROM w GROUP BY m HAVING count(*) > 1),
x AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS p FROM w WHERE m IN (SELECT m FROM d)),
g AS (SELECT r, i, sum(CASE WHEN p IS NULL OR i > p + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS g FROM x),
s AS (SELECT r, min(i) AS a, max(i) + 200 AS z FROM g GROUP BY r, g),
t AS (SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM s),
k AS (SELECT r, count(*) AS n_spans, sum(z - a)::BIGINT AS n_removed, max(z) AS last, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head FROM t JOIN b USING (r) GROUP BY r)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(head || substr(h, 2 * last + 1), h))) AS kept_sha256 FROM b LEFT JOIN k USING (r)"""
