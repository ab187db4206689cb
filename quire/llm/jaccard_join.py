"""Exact n-gram Jaccard join: documents whose five-word shingle sets overlap by 0.8 or more, as components.

Method: signature trees.  A document's signature is a bitmap of its shingles, its set's size and the number of
shingles that share a bit with another; a tree node holds the OR of its members' bitmaps and their range of
sizes.  Two members of two nodes share at most the bits that both ORs have, and as many shingles more as fell on
one bit in either.  A dual traversal opens the pairs of nodes that may still reach the threshold by that bound;
what is left at the leaves is decided by the whole sets, within the task, so that only links leave it, at most one
fewer than a tree has documents: once two documents are linked, pairs within their component are not opened.

Which documents meet in a tree: two sets with similarity t share one of their first n - ceil(t * n) + 1 shingles in
any common order.  The order is by exact document frequency, rarest first: each shingle of each text is counted by
one shuffle of packed hashes, a second one brings those found twice or more back to their documents, so that a
text of which a fifth occurs nowhere else has no prefix and goes no further.  Documents that share a prefix shingle
with another component form clusters, a tree each; a cluster too large for a task is dealt by shingle or as a whole by
pairs of subtrees, whichever copies fewer sets, and a shingle too hot for a task by pairs of subtrees, all measured in shingles.  Prefix
shingles that the same documents have (those of a line that several texts share) bring the same documents together, so one of them stands for all.  Before that, equal sets become one document, and documents with the same
minimal shingle are checked against the most central of them, so that a group of near copies is mostly one component.

Shingles in a large share of a bounded sample of texts count as last in the order and are dealt out by document, not
by shingle: the sample decides where work is done, not what is found.

Cases: null and empty texts have no shingles and link with nothing; under five words the whole sequence is one
shingle; equal sets link; rows that are repeated, and rows with one id and several texts, give a row each, the
smallest id of a class being that of its rows; rows without an id are left out; other columns may have any name.
Shingles are 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

WORDS, NUM, DEN = 5, 4, 5  # similarity of NUM / DEN or more
BLOCK, PART = 1 << 20, 1 << 20  # bytes of text whose hashes travel together; shingles counted in one step
SAMPLE, HOT = 1 << 26, 1 / 256  # bytes of the sample for hot shingles; share of its texts that makes a shingle hot
TREE, NODE, LEAF = 1 << 22, 1 << 22, 64  # shingles of a cluster that is one tree, of a dealt subtree; documents of a leaf
WIDE = 1 << 17  # shingles of a leaf with several documents
SPREAD = 256  # members that a leader is checked against in one group


def _first(row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(row, np.arange(n + 1))
    return at[:-1], np.diff(at)


def _lists(values: np.ndarray, count: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)).astype(np.int32)), pa.array(values))


def _sets(batches, most: int = c.CHUNK):
    """Ids, row, shingles, first shingle and size of each text, some megabytes at a time."""
    for b in batches:
        data, off = c.strings(b.column("text"))
        ids = b.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        for i, j in c.pieces(off, most):
            row, h = c.shingles(data[off[i] : off[j]], off[i : j + 1] - off[i], WORDS)
            yield ids[i:j], row, h, *_first(row, j - i)


def _sized(batches):
    """Size and digest of each text's set."""
    for ids, _, h, at, n in _sets(batches):
        sums = [np.append(c.U(0), np.cumsum(c.mix(h, seed))) for seed in (11, 12)]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n.astype(np.int32)), *(pa.array((s[at + n] - s[at]).view(np.int64)) for s in sums)], names=["doc_id", "n", "d1", "d2"])


def _whole(marked):
    """The sets themselves, of texts that may be among those marked, and three minimal shingles of each under other orders."""

    def run(batches):
        for ids, _, h, at, n in _sets(c.passing(batches, "doc_id", marked.value)):
            keys = np.zeros((len(ids), 3), np.int64)
            for k in range(3):
                if len(h):
                    keys[n > 0, k] = np.minimum.reduceat(c.mix(h, 21 + k), at[n > 0]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids), _lists(keys.ravel(), np.full(len(ids), 3)), _lists(h.view(np.int64), n)], names=["doc_id", "keys", "shingles"])

    return run


# --- prefixes by exact frequency ------------------------------------------------------------------------


def squeezed(*columns: np.ndarray) -> bytes:
    """Columns of integers below 2**63 as one compressed value, byte by byte."""
    head = np.array([len(columns), *map(len, columns)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(np.ascontiguousarray(x, np.int64).view(np.uint8).reshape(-1, 8).T.tobytes() for x in columns))


def unsqueezed(blob: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    sizes = raw[8 : 8 + 8 * int(raw[:8].view(np.int64)[0])].view(np.int64).tolist()
    at, out = 8 * (1 + len(sizes)), []
    for n in sizes:
        out.append(np.ascontiguousarray(raw[at : at + 8 * n].reshape(8, n).T).view(np.int64).ravel())
        at += 8 * n
    return out


def _blobs(to: np.ndarray, key: np.ndarray, doc: np.ndarray, n: np.ndarray, *more: np.ndarray) -> pa.RecordBatch:
    """Entries (key, document with its size, more) dealt to `to`, one compressed value for each destination."""
    order = np.lexsort((key, to))
    to, key, doc, n, more = to[order], key[order], doc[order], n[order], [x[order] for x in more]
    cut = np.append(np.flatnonzero(np.append(True, to[1:] != to[:-1])), len(to)) if len(to) else np.zeros(1, np.int64)
    out = []
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        own, first, back = np.unique(doc[a:b], return_index=True, return_inverse=True)
        out.append(squeezed(np.diff(own, prepend=0), n[a:b][first], np.diff(key[a:b], prepend=0), back, *(x[a:b] for x in more)))
    return pa.RecordBatch.from_arrays([pa.array(to[cut[:-1]].astype(np.int32)), pa.array(out, pa.binary())], names=["to", "blob"])


def _gathered(batches):
    """(key, document, size, more) of all entries of each destination; batches are sorted by it."""
    now, held = None, []
    for b in batches:
        for to, blob in zip(b.column("to").to_pylist(), b.column("blob").to_pylist(), strict=True):
            if to != now and held:
                yield [np.concatenate(x) for x in zip(*held, strict=True)]
                held = []
            now = to
            own, n, key, back, *more = unsqueezed(blob)
            held.append((np.cumsum(key), np.cumsum(own)[back], n[back], *more))
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    return rows.repartition(parts, "to").sortWithinPartitions("to")


def _hot(texts: DataFrame, size: int, bits: int) -> np.ndarray:
    """Upper bits of the shingles that a share HOT of a sample of SAMPLE bytes or so has, sorted: SAMPLE * HOT numbers at most."""
    sample = texts.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(min(1.0, SAMPLE / max(1, size)) * (1 << 30)) + 1)
    least = max(64, int(sample.count() * HOT))

    def run(batches):
        for _, _, h, _, _ in _sets(batches):
            key, n = np.unique(h >> c.U(64 - bits), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], names=["h", "n"])

    found = sample.transform(c.mapped, run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("h").toArrow()
    return np.sort(found["h"].to_numpy())


def _in(sorted_: np.ndarray, key: np.ndarray) -> np.ndarray:
    return sorted_[np.minimum(np.searchsorted(sorted_, key), len(sorted_) - 1)] == key if len(sorted_) else np.zeros(len(key), bool)


def prefixes(texts: DataFrame) -> DataFrame:
    """(doc_id, n, rare, prefix array<long>): of each text, how many shingles no other has, and the prefix shingles that another has, where there are any."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // 6 // PART + 1)
    bits = min(50, max(24, size.bit_length() + 4))  # a sixty-fourth of the single shingles or fewer look shared
    hot = texts.sparkSession.sparkContext.broadcast(_hot(texts, size, bits))

    def spread(ids):
        return (c.mix(ids.astype(c.U), 31) % c.U(parts)).astype(np.int64)

    def emit(batches):
        for ids, row, h, _, n in _sets(batches, BLOCK):
            key = (h >> c.U(64 - bits)).view(np.int64)
            to = ((key >> max(0, bits - 32)) * parts) >> min(32, bits)
            often = _in(hot.value, key)
            to[often] = spread(ids[row[often]])
            yield _blobs(to, key, ids[row], n[row])

    def count(batches):
        for key, doc, n in _gathered(batches):
            order = np.argsort(key, kind="stable")
            key, doc, n = key[order], doc[order], n[order]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            many = np.diff(np.append(first, len(key)))
            kind = np.where(_in(hot.value, key[first]), 63, np.minimum(62, (2 * np.log2(many)).astype(np.int64)))
            keep = np.repeat((many > 1) | (kind == 63), many)
            yield _blobs(spread(doc[keep]), key[keep], doc[keep], n[keep], np.repeat(kind, many)[keep])

    def choose(batches):
        for key, doc, n, kind in _gathered(batches):
            order = np.lexsort((key, kind, doc))
            key, doc, n = key[order], doc[order], n[order]
            first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
            many, n = np.diff(np.append(first, len(doc))), n[first]
            rare = n - many
            most = np.maximum(0, n - -(-NUM * n // DEN) + 1 - rare)
            take = np.arange(len(doc)) - np.repeat(first, many) < np.repeat(most, many)
            ok = most > 0
            yield pa.RecordBatch.from_arrays([pa.array(doc[first][ok]), pa.array(n[ok].astype(np.int32)), pa.array(rare[ok].astype(np.int32)), _lists(key[take], np.minimum(most, many)[ok])], names=["doc_id", "n", "rare", "prefix"])

    blobs = "to int, blob binary"
    back = _dealt(_dealt(texts.transform(c.mapped, emit, blobs), parts).transform(c.mapped, count, blobs), parts)
    return back.transform(c.mapped, choose, "doc_id long, n int, rare int, prefix array<long>")


# --- leaders --------------------------------------------------------------------------------------------


def _led(batches):
    """Rows (a, part, doc_id, n, shingles) sorted by group, the leader's (doc_id = a) first in its own; links (a, b) out."""
    group, known = None, np.zeros(0, np.int64)
    for b in batches:
        a, part, ids, n = (b.column(k).to_numpy() for k in ("a", "part", "doc_id", "n"))
        lists = b.column("shingles")
        flat, at = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
        at = at - at[0]
        hit = np.zeros(len(ids), bool)
        cut = np.append(np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (part[1:] != part[:-1]))), len(ids))
        for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            if (a[lo], part[lo]) != group:
                group, known = (a[lo], part[lo]), flat[at[lo] : at[lo + 1]].view(c.U)  # sorted, as shingles are
                lo += 1
            if lo < hi and len(known):
                own = flat[at[lo] : at[hi]].view(c.U)
                inside = np.append(0, np.cumsum(known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own))
                shared = inside[at[lo + 1 : hi + 1] - at[lo]] - inside[at[lo:hi] - at[lo]]
                hit[lo:hi] = DEN * shared >= NUM * (n[lo:hi] + len(known) - shared)
        yield pa.RecordBatch.from_arrays([pa.array(a[hit]), pa.array(ids[hit])], names=["a", "b"])


def _leaders(sets: DataFrame) -> DataFrame:
    """Links (a, b) between documents and the most central one of those with the same minimal shingle."""
    keyed = sets.select("doc_id", "n", "rare", F.posexplode("keys").alias("k", "key"))
    lead = keyed.groupBy("k", "key").agg(F.min(F.struct((F.col("rare") / F.col("n")).alias("odd"), "doc_id", "n")).alias("lead"), F.count("*").alias("m")).where("m > 1")
    # stored, here and below, so that the join reads rows of a hot key from an exchange of its own, which can be split
    lead = c.table(lead.select("k", "key", F.col("lead.doc_id").alias("a"), F.col("lead.n").alias("na")), "lead")
    near = f"doc_id <> a and {DEN} * n >= {NUM} * na and {DEN} * na >= {NUM} * n"
    pairs = c.table(keyed.join(lead, ["k", "key"]).where(near).select("a", "doc_id").distinct(), "led")
    count = pairs.groupBy("a").agg(F.ceil(F.count("*") / SPREAD).cast("int").alias("parts"))
    member = pairs.join(count, "a").select("a", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int").alias("part"), "doc_id")
    heads = count.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("a").alias("doc_id"))
    groups = member.unionByName(heads).join(sets.select("doc_id", "n", "shingles"), "doc_id").select("a", "part", "doc_id", "n", "shingles")
    return groups.repartition("a", "part").sortWithinPartitions("a", "part", F.col("doc_id") != F.col("a")).transform(c.mapped, _led, "a long, b long")


# --- trees ----------------------------------------------------------------------------------------------


class Forest:
    """Sets of documents, and which of them are one component by now."""

    def __init__(self, ids: np.ndarray, comp: np.ndarray, flat: np.ndarray, at: np.ndarray):
        self.ids, self.flat, self.at, self.n = ids, flat, at, np.diff(at)
        _, self.root = np.unique(comp, return_inverse=True)
        width = 64  # longer sets than the average have more excess, which the bound counts
        while width < min(4 * len(flat) // len(ids), 1 << 14):
            width *= 2
        place = (flat >> c.U(11)) & c.U(width - 1)
        self.bits = np.zeros((len(ids), width // 64), np.uint64)
        np.bitwise_or.at(self.bits, (np.repeat(np.arange(len(ids)), self.n), (place >> c.U(6)).astype(np.int64)), c.U(1) << (place & c.U(63)))
        self.excess = self.n - np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)
        self.links: list[tuple[int, int]] = []

    def link(self, p: int, q: int) -> None:
        if self.root[p] != self.root[q]:
            self.root[self.root == self.root[q]] = self.root[p]
            self.links.append((p, q))


class Node:
    """A subtree: members, OR of their bitmaps, range of sizes, most shingles that fell on a bit taken."""

    __slots__ = ("rows", "bits", "low", "high", "excess", "kids")

    def __init__(self, f: Forest, rows: np.ndarray, leaf: int):
        self.rows = rows
        if len(rows) > leaf or len(rows) > 1 and f.n[rows].sum() > WIDE:
            half = len(rows) // 2
            self.kids = (Node(f, rows[:half], leaf), Node(f, rows[half:], leaf))
            self.bits = self.kids[0].bits | self.kids[1].bits
        else:
            self.kids = ()
            self.bits = np.bitwise_or.reduce(f.bits[rows])
        self.low, self.high, self.excess = int(f.n[rows].min()), int(f.n[rows].max()), int(f.excess[rows].max())


def may_link(x: Node, y: Node) -> bool:
    """Whether sizes and the most that a member of x and one of y can share allow a link."""
    if DEN * x.high < NUM * y.low or DEN * y.high < NUM * x.low:
        return False
    most = int(np.bitwise_count(x.bits & y.bits).sum()) + min(x.excess, y.excess)
    return (NUM + DEN) * min(most, x.high, y.high) >= NUM * (x.low + y.low)


def _leaves(f: Forest, x: np.ndarray, y: np.ndarray) -> None:
    """Links the members of two leaves (or of one) by their whole sets."""
    rows = x if x is y else np.concatenate([x, y])
    size = f.n[rows]
    own = np.repeat(np.arange(len(rows)), size)
    h = f.flat[np.repeat(f.at[rows] - (np.cumsum(size) - size), size) + np.arange(len(own))]
    _, kind, many = np.unique(h, return_inverse=True, return_counts=True)
    keep = many[kind] > 1
    own, kind = own[keep], kind[keep]
    shared = np.zeros((len(rows), len(rows)), np.int64)
    used, kind = np.unique(kind, return_inverse=True)
    for lo in range(0, len(used), 8192):
        part = (kind >= lo) & (kind < lo + 8192)
        has = np.zeros((len(rows), min(8192, len(used) - lo)), np.float32)
        has[own[part], kind[part] - lo] = 1
        shared += (has @ has.T).astype(np.int64)
    hit = (NUM + DEN) * shared >= NUM * (size[:, None] + size[None, :])
    p, q = np.nonzero(np.triu(hit, 1) if x is y else hit[: len(x), len(x) :])
    for a, b in zip(rows[p].tolist(), rows[q if x is y else q + len(x)].tolist(), strict=True):
        f.link(a, b)


def traverse(f: Forest, x: Node, y: Node) -> None:
    """Links between members of x and y; x is y for those within."""
    stack = [(x, y)]
    while stack:
        p, q = stack.pop()
        own = f.root[p.rows[0]]
        if (f.root[p.rows] == own).all() and (p is q or (f.root[q.rows] == own).all()):
            continue
        if p is not q and not may_link(p, q):
            continue
        if not p.kids and not q.kids:
            _leaves(f, p.rows, p.rows if p is q else q.rows)
        elif p is q:
            a, b = p.kids
            stack += [(a, b), (b, b), (a, a)]
        elif p.kids and (not q.kids or len(p.rows) >= len(q.rows)):
            stack += [(k, q) for k in p.kids]
        else:
            stack += [(p, k) for k in q.kids]


def linked(ids, side, comp, flat, at, leaf: int = LEAF) -> np.ndarray:
    """Links found in one tree, or between the trees of side 0 and side 1, as pairs of ids."""
    f = Forest(ids, comp, flat, at)
    like = np.minimum.reduceat(flat, at[:-1]) if len(flat) else np.zeros(len(ids), c.U)  # the smallest shingle: like sets stand together
    order = np.lexsort((like, f.n))
    sides = [order[side[order] == k] for k in (0, 1)]
    nodes = [Node(f, rows, leaf) for rows in sides if len(rows)]
    if nodes and len(sides[0]):
        traverse(f, nodes[0], nodes[-1])
    return ids[np.array(f.links, np.int64).reshape(-1, 2)]


def _trees(batches):
    """Rows sorted by tree in; links (a, b) out."""
    now, held = None, []

    def done():
        if len(held) > 1:
            ids, side, comp = (np.array([x[k] for x in held], np.int64) for k in range(3))
            both = linked(ids, side, comp, np.concatenate([x[3] for x in held]).view(c.U), np.append(0, np.cumsum([len(x[3]) for x in held])))
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    for b in batches:
        keys = zip(*(b.column(k).to_pylist() for k in ("tree", "part")), strict=True)
        ids, side, comp = (b.column(k).to_numpy() for k in ("doc_id", "side", "comp"))
        lists = b.column("shingles")
        flat, at = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
        at = (at - at[0]).tolist()
        for i, key in enumerate(keys):
            if key != now:
                yield from done()
                now, held = key, []
            held.append((ids[i], side[i], comp[i], flat[at[i] : at[i + 1]].copy()))
    yield from done()


def _in_subtrees(rows: DataFrame) -> DataFrame:
    """Rows (h, doc_id, n, comp), a group h in which documents meet, as trees: whole where a task holds the group's shingles, else by pairs of subtrees whose sizes allow links."""
    rows = rows.join(rows.groupBy("h").agg(F.sum("n").alias("total")), "h")
    small = rows.where(F.col("total") <= TREE).select(F.col("h").alias("tree"), F.lit(0).alias("part"), F.lit(0).alias("side"), "doc_id", "comp")
    large = rows.where(F.col("total") > TREE)
    # a component with many shingles gets subtrees of its own, the others share theirs by size
    own = large.groupBy("h", "comp").agg(F.sum("n").alias("own"))
    large = large.join(own, ["h", "comp"])
    alone = F.col("own") > NODE // 2
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(DEN / NUM))).cast("int")
    large = large.withColumn("step", F.when(~alone, step))
    large = large.join(large.where("step is not null").groupBy("h", "step").agg(F.sum("n").alias("stepped")), ["h", "step"], "left")
    sub = F.when(alone, F.concat_ws(":", "comp", F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("own") / NODE)))).otherwise(F.concat_ws(":", F.lit("x"), F.col("step").cast("string"), F.pmod(F.xxhash64("comp"), F.ceil(F.col("stepped") / NODE))))
    large = large.withColumn("sub", sub).withColumn("pure", F.when(alone, F.col("comp")))
    nodes = large.groupBy("h", "sub").agg(F.first("pure").alias("pure"), F.min("n").alias("low"), F.max("n").alias("high"))
    x, y = (nodes.select("h", *[F.col(k).alias(k + s) for k in ("sub", "pure", "low", "high")]) for s in "xy")
    pairs = x.join(y, "h").where("subx <= suby and not (subx = suby and purex is not null) and not coalesce(purex = purey, false)")
    pairs = pairs.where(f"{DEN} * highx >= {NUM} * lowy and {DEN} * highy >= {NUM} * lowx").select("h", "subx", "suby", F.xxhash64("h", "subx", "suby").alias("pair"))
    part = (F.pmod("pair", F.lit((1 << 31) - 2)) + 1).cast("int").alias("part")
    sides = pairs.select("h", F.col("subx").alias("sub"), part, F.lit(0).alias("side")).unionByName(pairs.where("subx <> suby").select("h", F.col("suby").alias("sub"), part, F.lit(1).alias("side")))
    return small.unionByName(large.join(sides, ["h", "sub"]).select(F.col("h").alias("tree"), "part", "side", "doc_id", "comp"))


def _joined(rows: DataFrame, sets: DataFrame, comp: DataFrame) -> DataFrame:
    """Links (a, b) between components (node, component), of documents that share prefix shingles (rows h, doc_id, n)."""
    rows = rows.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("h", "doc_id", "n", F.coalesce("component", "doc_id").alias("comp"))
    shared = c.table(rows.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("doc_id").alias("head")).where("lo <> hi").select("h", "head"), "shared")
    rows = c.table(rows.join(shared, "h"), "rows")
    cluster = c.components(rows.select(F.col("head").alias("a"), F.col("doc_id").alias("b")))
    member = c.table(rows.select("doc_id", "n", "comp").distinct().join(cluster.withColumnRenamed("node", "doc_id"), "doc_id").withColumnRenamed("component", "cluster"), "member")
    size = member.groupBy("cluster").agg(F.sum("n").alias("size"))
    member = c.table(member.join(size, "cluster"), "clusters")
    dealt = member.where(F.col("size") <= TREE).select(F.col("cluster").alias("tree"), F.lit(0).alias("part"), F.lit(0).alias("side"), "doc_id", "comp")
    large = c.table(member.where(F.col("size") > TREE), "big")
    if large.limit(1).count():
        met = c.table(rows.select("h", "doc_id").join(large, "doc_id").select("h", "doc_id", "n", "comp", "cluster", "size"), "large")
        # a set goes to as many tasks as it has shingles here, or else, dealt by subtrees of the whole cluster, to about as many as there are subtrees
        copied = met.groupBy("cluster").agg((F.sum("n") / F.first("size")).alias("by_shingle"), F.ceil(F.first("size") / max(NODE, 1)).alias("by_subtree"))
        whole = copied.where("by_subtree <= by_shingle").select("cluster")
        key = F.xxhash64(F.lit("cluster"), "cluster").alias("h")
        groups = large.join(whole, "cluster", "left_semi").select(key, "doc_id", "n", "comp").unionByName(met.join(whole, "cluster", "left_anti").select("h", "doc_id", "n", "comp"))
        dealt = dealt.unionByName(_in_subtrees(c.table(groups, "groups")))
    full = dealt.join(sets.select("doc_id", "shingles"), "doc_id")
    return full.repartition("tree", "part").sortWithinPartitions("tree", "part").transform(c.mapped, _trees, "a long, b long")


def components_of(texts: DataFrame) -> DataFrame:
    """(doc_id, n, component) of each row of texts (doc_id, text) with unique ids, a component being named by its smallest id."""
    with c.scratch():
        return _components_of(texts)


def _components_of(texts: DataFrame) -> DataFrame:
    sizes = c.table(texts.transform(c.mapped, _sized, "doc_id long, n int, d1 long, d2 long"), "sizes")
    reps = c.table(sizes.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("rep")), "reps")
    found = c.table(prefixes(texts), "prefixes")
    rows = found.join(reps.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "n", "rare", F.explode(F.array_distinct("prefix")).alias("h"))
    digests = (F.bit_xor(F.xxhash64("doc_id", F.lit(k))).alias(f"x{k}") for k in (1, 2))  # of the documents that have the shingle, each once
    shared = rows.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("m"), *digests).where("lo <> hi")
    shared = c.table(shared.groupBy("lo", "hi", "m", "x1", "x2").agg(F.min("h").alias("h")).select("h"), "twice")
    rows = c.table(rows.join(shared, "h"), "candidates")
    some = c.table(rows.select("doc_id", "n", "rare").distinct(), "some")
    marked = texts.sparkSession.sparkContext.broadcast(c.marks(some, "doc_id"))
    sets = texts.transform(c.mapped, _whole(marked), "doc_id long, keys array<long>, shingles array<long>")
    sets = c.table(sets.join(some, "doc_id"), "sets")
    links = c.table(_leaders(sets), "leaders")
    comp = c.table(c.components(links), "leads")
    more = c.table(_joined(rows.select("h", "doc_id", "n").distinct(), sets, comp), "links")
    final = c.components(links.unionByName(more))
    named = reps.join(final.withColumnRenamed("node", "rep"), "rep", "left").select("n", "d1", "d2", F.coalesce("component", "rep").alias("component"))
    return c.table(sizes.join(named, ["n", "d1", "d2"], "left").select("doc_id", "n", F.coalesce("component", "doc_id").alias("component")), "components", keep=True)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row with an id."""
    rows, unique = c.keyed(docs.where(F.col(id_col).isNotNull()).select(id_col, text_col), id_col)
    found = components_of(c.id_text(rows, c.ROW, text_col))
    n = F.col("n").cast("long").alias("n_shingles")
    if unique:
        return found.select("doc_id", n, F.col("component").alias("component_id"))
    found = found.withColumnRenamed("doc_id", c.ROW).join(rows.select(c.ROW, F.col(id_col).alias("doc_id")), c.ROW)
    names = found.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return found.join(names, "component").select("doc_id", n, "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, with one row of each component: the smallest id, and of rows with that id the first by text.

    Texts without shingles link with nothing; of these, rows with the same id and text are one.  Rows without an id come last.
    """
    rows, unique = c.keyed(docs, id_col)
    found = components_of(c.id_text(rows, c.ROW, text_col))
    if unique:
        kept = found.where("doc_id = component").select(F.col("doc_id").alias(c.ROW))
    else:
        found = found.join(rows.select(F.col(c.ROW).alias("doc_id"), F.col(id_col).alias("id"), F.sha2(F.col(text_col), 256).alias("sha")), "doc_id")
        alone = F.when(F.col("n") == 0, F.struct("id", F.when(F.col("id").isNull(), F.col("doc_id")).alias("row"), "sha"))
        first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "sha", "doc_id")).alias("first")
        kept = found.groupBy(F.when(F.col("n") > 0, F.col("component")).alias("component"), alone.alias("alone")).agg(first).select(F.col("first.doc_id").alias(c.ROW))
    return rows.join(kept, c.ROW, "left_semi").select(*docs.columns)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP8_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS sh FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce((SELECT min(b) FROM r WHERE r.a = w.doc_id), w.doc_id)) AS component_id FROM w LEFT JOIN n USING (doc_id)"""
