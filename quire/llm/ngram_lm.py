"""Language-model scoring with an Elias-Fano n-gram trie.

Method: a word's id is the rank of its hash among all training words, so the first level is one monotone sequence of
hashes in Elias-Fano form.  Each further level has the n-grams in order of their context (the n-gram without its last
word, known by its rank in the level before) and last word: a monotone sequence of pointers, in Elias-Fano form, says
where each context's successors start, the successors' word ids lie behind one another in as few bits as the largest
needs, and beside them one byte for the quantised probability and one for each context's back-off weight.  A look-up
follows the context's two pointers and searches for the word among that context's successors; the place found is the
n-gram's rank, which is the context of the next level.  Levels are written by Spark tasks as files in the shared folder
and memory-mapped by the tasks that score; all tokens of some megabytes of text search at once.

Probabilities: p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)); p(w|x) = (c(xw) - D) / c(x) + b(x) p(w|x'), where x' is x
without its first word, c(x) counts the successors of x, b(x) is the mass that the kept successors leave, and the first
summand, which the trie holds, is zero for n-grams that it does not; contexts never seen: p(w|x').  The end mark stands
before the first word; longer contexts lie within one text.  All n-grams of training texts are kept; `least` leaves out
rarer ones, and `order` says how many levels there are.  All training texts are counted; counts and levels grow
with them, and the driver sees one row for each level file.

Cases: null and empty texts are one end mark; unknown words have count 0; without training texts V = N = 0 and all
tokens have the same probability; repeated ids are separate rows, rows without an id are left out; other columns may have
any name.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

END = np.int64(0x5DEECE66D1A4B5F7 >> 1)
DISCOUNT, SHARD, FLOOR = 0.75, 1 << 21, -10.0
BLOCK = 1 << 21  # bytes of text whose tokens search at once
BITS = 256  # of a pointer's upper bits, between counts


# --- Elias-Fano sequences -------------------------------------------------------------------------------


def ef_build(values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Arrays of a sorted sequence of integers below `universe`."""
    n = len(values)
    low = max(0, min(56, (max(1, universe) // max(1, n)).bit_length() - 1))
    v = values.astype(c.U)
    high = (v >> c.U(low)).astype(np.int64) + np.arange(n)
    size = n + (int(universe) >> low) + 2
    bits = np.zeros(-(-size // BITS) * BITS, bool)
    bits[high] = True
    upper = np.packbits(bits, bitorder="little").view(c.U)
    ones = np.append(0, np.cumsum(np.bitwise_count(upper).reshape(-1, BITS // 64).sum(axis=1, dtype=np.int64)))
    zeros = np.arange(len(ones)) * BITS - ones
    lower = pack(v & c.U((1 << low) - 1), low)
    return {"upper": upper, "zeros": zeros, "ones": ones, "lower": lower, "shape": np.array([n, low], np.int64)}


_PLACE = np.zeros((256, 8), np.uint8)  # place of the r-th one in a byte
for _k in range(8):
    _set = np.arange(256) >> _k & 1 == 1
    _PLACE[_set, np.bitwise_count(np.arange(256)[_set] & (1 << _k) - 1)] = _k
_OCTETS, _HIGH = c.U(0x0101010101010101), c.U(0x8080808080808080)
_M1, _M2, _M4 = c.U(0x5555555555555555), c.U(0x3333333333333333), c.U(0x0F0F0F0F0F0F0F0F)


def _in_word(w: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th one of each word: prefix counts of its bytes, the byte, then the place in the byte by table."""
    k = k.astype(c.U)
    n = w - (w >> c.U(1) & _M1)
    n = (n & _M2) + (n >> c.U(2) & _M2)
    n = ((n + (n >> c.U(4))) & _M4) * _OCTETS
    place = np.bitwise_count((k * _OCTETS | _HIGH) - n & _HIGH).astype(c.U) << c.U(3)
    k -= n << c.U(8) >> place & c.U(255)
    return place.astype(np.int64) + _PLACE[(w >> place & c.U(255)).astype(np.int64), k.astype(np.int64)]


def _select(ef: dict, k: np.ndarray, one: bool) -> np.ndarray:
    """Place of the k-th one, or the k-th zero, of the upper bits."""
    upper, zeros = ef["upper"], ef["zeros"]
    before = ef["ones"] if one else zeros
    block = np.searchsorted(before, k, "right") - 1
    rest, word = k - before[block], block * (BITS // 64)
    for _ in range(BITS // 64 - 1):
        n = np.bitwise_count(upper[word] if one else ~upper[word])
        go = rest >= n
        rest = rest - n * go
        word += go
    return word * 64 + _in_word(upper[word] if one else ~upper[word], rest)


def _bits(packed: np.ndarray, i: np.ndarray, width: int) -> np.ndarray:
    """The i-th numbers of `width` bits."""
    if not width:
        return np.zeros(len(i), c.U)
    b = i * width
    s = (b & 63).astype(c.U)
    at = b >> 6
    return (packed[at] >> s | packed[at + 1] << c.U(1) << (c.U(63) - s)) & c.U((1 << width) - 1)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Numbers of `width` bits behind one another."""
    out = np.zeros(len(values) * width // 64 + 2, c.U)
    at = np.arange(len(values), dtype=np.int64) * width
    shift = (at & 63).astype(c.U)
    np.bitwise_or.at(out, at >> 6, values.astype(c.U) << shift)
    over = (at & 63) + width > 64
    np.bitwise_or.at(out, (at[over] >> 6) + 1, values.astype(c.U)[over] >> (c.U(64) - shift[over]))
    return out


def ef_get(ef: dict, i: np.ndarray) -> np.ndarray:
    """The i-th values of the sequence."""
    low = int(ef["shape"][1])
    return (_select(ef, i, True) - i) << low | _bits(ef["lower"], i, low).astype(np.int64)


def ef_range(ef: dict, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The i-th values and those behind them, whose ones are the next in the upper bits."""
    low, at = int(ef["shape"][1]), _select(ef, i, True)
    word = at >> 6
    rest = ef["upper"][word] >> (at & 63).astype(c.U) >> c.U(1)
    step = np.bitwise_count((rest & -rest) - c.U(1)).astype(np.int64) + 1
    far = np.flatnonzero(rest == 0)  # the next one is in another word
    step[far] = 0
    while len(far):
        word[far] += 1
        w = ef["upper"][word[far]]
        hit = w != 0
        step[far[hit]] = (word[far[hit]] << 6) + np.bitwise_count((w[hit] & -w[hit]) - c.U(1)) - at[far[hit]]
        far = far[~hit]
    return (at - i) << low | _bits(ef["lower"], i, low).astype(np.int64), (at + step - i - 1) << low | _bits(ef["lower"], i + 1, low).astype(np.int64)


def ef_find(ef: dict, keys: np.ndarray) -> np.ndarray:
    """Rank of each key in the sequence, or -1: the bucket by its upper half, then a search among the lower halves."""
    n, low = (int(x) for x in ef["shape"])
    out = np.full(len(keys), -1, np.int64)
    if not n or not len(keys):
        return out
    high, want = keys >> low, (keys & ((1 << low) - 1)).astype(c.U)
    last = int(ef["zeros"][-1]) - 1
    rows = np.flatnonzero((high >= 0) & (high <= last))
    high, want = high[rows], want[rows]
    lo = np.where(high > 0, _select(ef, np.maximum(high - 1, 0), False) - high + 1, 0)
    hi = _select(ef, high, False) - high

    def at(i):
        return _bits(ef["lower"], i, low)

    live = np.flatnonzero(lo < hi)
    top = hi.copy()
    while len(live):
        mid = (lo[live] + hi[live]) >> 1
        less = at(mid) < want[live]
        lo[live] = np.where(less, mid + 1, lo[live])
        hi[live] = np.where(less, hi[live], mid)
        live = live[lo[live] < hi[live]]
    ok = np.flatnonzero(lo < top)
    ok = ok[at(lo[ok]) == want[ok]]
    out[rows[ok]] = lo[ok]
    return out


# --- level files ----------------------------------------------------------------------------------------


def save(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """One file with a header line; written aside and renamed, so a repeated task leaves the same file."""
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path)
    head, at, body = {}, 0, []
    for k, a in arrays.items():
        raw = np.ascontiguousarray(a).tobytes()
        head[k] = (str(a.dtype), len(a), at)
        raw += b"\0" * (-len(raw) % 8)
        body.append(raw)
        at += len(raw)
    line = json.dumps(head).encode()
    line += b" " * (-(len(line) + 1) % 8) + b"\n"
    aside = f"{path}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(aside) as f:
        f.write(line)
        for raw in body:
            f.write(raw)
    store.move(aside, f"{path}/{name}")


@lru_cache(maxsize=4096)
def load(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of a level file, memory-mapped; a store that is no file system is copied to an unlinked file first."""
    store, path = fs.FileSystem.from_uri(folder)
    if isinstance(store, fs.LocalFileSystem):
        raw = np.memmap(f"{path}/{name}", np.uint8, "r")
    else:
        with tempfile.TemporaryFile() as f, store.open_input_stream(f"{path}/{name}") as g:
            while block := g.read(1 << 22):
                f.write(block)
            f.flush()
            raw = np.memmap(f, np.uint8, "r")
    end = int(np.flatnonzero(raw[: 1 << 16] == 10)[0]) + 1
    head = json.loads(bytes(raw[:end]))
    return {k: raw[end + at : end + at + np.dtype(t).itemsize * n].view(t).view(np.ndarray) for k, (t, n, at) in head.items()}


def quantised(p: np.ndarray) -> np.ndarray:
    return np.clip(np.round(np.log10(np.maximum(p, 1e-300)) / FLOOR * 255), 0, 255).astype(np.uint8)


STEPS = 10 ** (np.arange(256) / 255 * FLOOR)  # what a byte stands for


def _all(batches) -> pa.Table | None:
    """The rows of one shard, SHARD or so, if there are any."""
    kept = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(kept) if kept else None


def _stored(rows: DataFrame, shards: int, folder: str, kind: str, arrays) -> list[tuple[int, int, int, int]]:
    """Sorts rows by key into shards, has each written by `arrays(keys, rows)`, and returns the shard list."""

    def run(batches):
        t = _all(batches)
        if t is not None:
            keys = t["key"].to_numpy()
            number = TaskContext.get().partitionId()
            save(folder, f"{kind}-{number}", ef_build(keys - keys[0], int(keys[-1] - keys[0]) + 1) | arrays(keys, t))
            yield pa.RecordBatch.from_pylist([{"number": number, "first": int(keys[0]), "n": len(keys), "total": int(t["n"].to_numpy().sum())}])

    found = rows.repartitionByRange(shards, "key").sortWithinPartitions("key").transform(c.mapped, run, "number long, first long, n long, total long").collect()  # a row for each file
    out, before = [], 0
    for r in sorted(found, key=lambda r: r["first"]):
        out.append((r["number"], r["first"], r["n"], before, r["total"]))
        before += r["n"]
    return out


# --- counting and scoring -------------------------------------------------------------------------------


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each token: words, then one end mark a text."""
    h, row, _, _ = c.words(data, off)
    n = len(off) - 1
    out, rows = np.empty(len(h) + n, np.int64), np.empty(len(h) + n, np.int64)
    at = np.arange(len(h)) + row
    count = np.bincount(row, minlength=n)
    ends = np.cumsum(count + 1) - 1
    out[at], rows[at] = (h >> c.U(1)).view(np.int64), row
    out[ends], rows[ends] = END, np.arange(n)
    return out, rows


def _chunks(batches):
    for b in batches:
        data, off = c.strings(b.column("text"))
        for i, j in c.pieces(off, BLOCK):
            yield b, i, j, *tokens(data[off[i] : off[j]], off[i : j + 1] - off[i])


def _unigrams(batches):
    kept, size = [], 0
    for _, _, _, tok, _ in _chunks(batches):
        kept.append(np.unique(tok, return_counts=True))
        size += len(kept[-1][0])
        if size > 1_500_000:
            yield _summed(kept)
            kept, size = [], 0
    if kept:
        yield _summed(kept)


def _summed(kept) -> pa.RecordBatch:
    key, at = np.unique(np.concatenate([k for k, _ in kept]), return_inverse=True)
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.bincount(at, np.concatenate([n for _, n in kept])).astype(np.int64))], names=["key", "n"])


class Model:
    """What a scoring task needs: N, V, and small lists of level files."""

    def __init__(self, folder: str, words: list[tuple[int, int, int, int, int]]):
        """words: (number, first hash, entries, entries before, tokens) of each file."""
        self.folder, self.words = folder, words
        self.total, self.kinds = sum(s[4] for s in words), sum(s[2] for s in words)
        self.first = np.array([s[1] for s in words], np.int64)
        self.levels: list[tuple[int, dict[int, int]]] = []  # contexts a file, and the n-grams before each file

    def ids(self, tok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id (or -1) and count of each token."""
        word, back = np.unique(tok, return_inverse=True)
        ids, n = np.full(len(word), -1, np.int64), np.zeros(len(word), np.int64)
        cut = np.append(np.searchsorted(word, self.first), len(word)).tolist()
        for (number, base, _, before, _), lo, hi in zip(self.words, cut[:-1], cut[1:], strict=True):
            if lo < hi:
                level = load(self.folder, f"words-{number}")
                at = ef_find(level, word[lo:hi] - base)
                ok = np.flatnonzero(at >= 0)
                ids[lo + ok], n[lo + ok] = at[ok] + before, level["n"][at[ok]]
        return ids[back], n[back]

    def successors(self, level: int, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rank (or -1), first summand and back-off weight of each word after its context (-1: unknown)."""
        width, files = self.levels[level]
        rank, gain, rest = np.full(len(word), -1, np.int64), np.zeros(len(word)), np.ones(len(word))
        order = np.argsort(context)
        ctx = context[order]
        known = int(np.searchsorted(ctx, 0))
        parts = np.unique(ctx[known:] // width)
        cut = np.append(np.searchsorted(ctx, parts * width), len(ctx)).tolist()
        for part, a, b in zip(parts.tolist(), cut[:-1], cut[1:], strict=True):
            if part not in files:
                continue  # no context of this range has successors
            f = load(self.folder, f"level{level + 2}-{part}")
            new = np.append(True, ctx[a + 1 : b] != ctx[a : b - 1])  # contexts are sorted
            own, back = ctx[a:b][new] - part * width, np.cumsum(new) - 1
            start, end = ef_range({k: f[f"pointer_{k}"] for k in ("upper", "zeros", "ones", "lower", "shape")}, own)
            rows = order[a:b]
            rest[rows] = STEPS[f["rest"][own]][back]
            lo, hi = start[back], end[back]
            want, top, bits = word[rows], hi.copy(), int(f["bits"][0])
            live = np.flatnonzero((lo < hi) & (want >= 0))
            x, low, high = want[live].astype(c.U), lo[live], hi[live]
            while len(live):
                mid = (low + high) >> 1
                less = _bits(f["words"], mid, bits) < x
                low, high = np.where(less, mid + 1, low), np.where(less, high, mid)
                more = low < high
                lo[live] = low
                if more.sum() < 0.8 * len(live):  # those that are found leave
                    live, x, low, high = live[more], x[more], low[more], high[more]
                elif not more.any():
                    break
            ok = np.flatnonzero((lo < top) & (want >= 0))
            ok = ok[_bits(f["words"], lo[ok], bits).astype(np.int64) == want[ok]]
            rank[rows[ok]], gain[rows[ok]] = lo[ok] + files[part], STEPS[f["gain"][lo[ok]]]
        return rank, gain, rest

    def contexts(self, tok: np.ndarray, ranks: np.ndarray, level: int) -> np.ndarray:
        """Of each token, the rank of the n-gram before it: the end mark before a text's first word, and nothing before that."""
        out = np.append(np.int64(-1), ranks[:-1])
        if level:
            out[1:][tok[:-1] == END] = -1
        else:
            out[0] = self.ids(np.array([END]))[0][0]
        return out


KEYS = 1 << 63  # numbers of n-grams under this are one integer, others two


def _tallied(part: np.ndarray, key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (part, key), sorted, with the sums of their numbers."""
    if not len(key):
        return part, key, n
    order = np.lexsort((key, part))
    part, key = part[order], key[order]
    first = np.flatnonzero(np.append(True, (part[1:] != part[:-1]) | (key[1:] != key[:-1])))
    return part[first], key[first], np.add.reduceat(n[order], first)


def _counted(texts: DataFrame, grams_of, contexts: int, width: int, kinds: int, parts: int, solve, schema: str) -> DataFrame:
    """What solve(part, keys, counts) makes of the n-grams of each part; sorted key lists travel as compressed blobs.

    grams_of gives context (negative: none) and word (below kinds) of each of a chunk's tokens; a part has `width` contexts, and a
    key is the context within its part, times kinds, and the word.
    """
    span, narrow = width * kinds, contexts * kinds < KEYS

    def flush(kept):
        if narrow:
            x, at = np.unique(np.concatenate([k for k, _ in kept]), return_inverse=True)
            n, part = np.bincount(at, np.concatenate([m for _, m in kept])).astype(np.uint32), x // span
            key = x - part * span
        else:
            part, key, n = _tallied(*(np.concatenate(x) for x in zip(*kept, strict=True)))
            n = n.astype(np.uint32)
        cut = np.searchsorted(part, np.arange(parts + 1))
        zip_, names, blobs = zstandard.ZstdCompressor(level=1), [], []
        for p in range(parts):
            rows = slice(cut[p], cut[p + 1])
            if cut[p] < cut[p + 1]:
                step = np.diff(key[rows], prepend=0).view(np.uint8).reshape(-1, 8).T.tobytes()
                names.append(p)
                blobs.append(zip_.compress(step + n[rows].view(np.uint8).reshape(-1, 4).T.tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "blob"])

    def emit(batches):
        kept, size = [], 0
        for _, _, _, tok, _ in _chunks(batches):
            ctx, word = grams_of(tok)
            ctx, word = ctx[ctx >= 0], word[ctx >= 0]
            if narrow:
                kept.append(np.unique(ctx * kinds + word, return_counts=True))
            else:
                kept.append(_tallied(ctx // width, ctx % width * kinds + word, np.ones(len(ctx), np.int64)))
            size += len(kept[-1][0])
            if size > 1_500_000:
                yield flush(kept)
                kept, size = [], 0
        if kept:
            yield flush(kept)

    def merge(batches):
        part, held = None, []

        def done():
            if held:
                k, at = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
                m = np.bincount(at, np.concatenate([y for _, y in held])).astype(np.int64)
                held.clear()
                yield from solve(part, k, m)

        unzip = zstandard.ZstdDecompressor()
        for b in batches:
            for p, blob in zip(b.column("part").to_pylist(), b.column("blob").to_pylist(), strict=True):
                if p != part:
                    yield from done()
                    part, held = p, []
                raw = np.frombuffer(unzip.decompress(blob), np.uint8)
                m = len(raw) // 12
                step = np.ascontiguousarray(raw[: 8 * m].reshape(8, m).T).view(np.int64).ravel()
                held.append((np.cumsum(step), np.ascontiguousarray(raw[8 * m :].reshape(4, m).T).view(np.uint32).ravel()))
        yield from done()

    blobs = texts.transform(c.mapped, emit, "part int, blob binary")
    return blobs.repartition(parts, "part").sortWithinPartitions("part").transform(c.mapped, merge, schema)


def _level(texts: DataFrame, model: Model, parts: int, least: int) -> tuple[int, dict[int, int]]:
    """Writes the next level and returns contexts a file, and the n-grams before each file.

    Files are ranges of contexts, so the task that merges a range has all successors of its contexts and writes its file:
    counts are neither stored nor sorted again.
    """
    level, folder, size = len(model.levels), model.folder, max(model.kinds, 1)
    contexts = model.kinds if not level else model.ranks
    width, bits = -(-max(contexts, 1) // parts), (size - 1).bit_length()
    if width * size >= 1 << 63:
        raise ValueError(f"{width} contexts a file and {size} words are too many for one number; more shuffle partitions make files smaller")

    def grams(tok):
        word = ranks = model.ids(tok)[0]
        for k in range(level):
            ranks = model.successors(k, model.contexts(tok, ranks, k), word)[0]
        ctx = model.contexts(tok, ranks, level)
        return np.where(word >= 0, ctx, -1), word

    def write(part, k, m):
        ctx = k // size
        n = min(width, contexts - part * width)
        whole = np.bincount(ctx, m, minlength=n)
        keep = m >= least
        k, m, ctx = k[keep], m[keep], ctx[keep]
        gain = (m - DISCOUNT) / whole[ctx]
        rest = 1 - np.bincount(ctx, gain, minlength=n)
        starts = np.searchsorted(ctx, np.arange(n + 1))
        pointer = {f"pointer_{x}": y for x, y in ef_build(starts, len(k) + 1).items()}
        save(folder, f"level{level + 2}-{part}", pointer | {"words": pack(k % size, bits), "bits": np.array([bits]), "gain": quantised(gain), "rest": quantised(rest)})
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (part, len(k))], names=["number", "n"])

    found = _counted(texts, grams, contexts, width, size, parts, write, "number long, n long").collect()  # a row for each file
    files, before = {}, 0
    for r in sorted(found, key=lambda r: r["number"]):
        files[r["number"]] = before
        before += r["n"]
    model.ranks = before
    return width, files


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 1, order: int = 3) -> Model:
    """Counts all texts and writes `order` levels: n-grams of two words or more that are found `least` times or more."""
    spark = docs.sparkSession
    folder = f"{c.shared_dir(spark)}/quire-trie-{uuid.uuid4().hex}"
    folder = folder if "://" in folder else f"file://{folder}"
    texts = c.id_text(docs, id_col, text_col)
    with c.scratch():
        words = c.table(texts.transform(c.mapped, _unigrams, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "words")
        model = Model(folder, _stored(words, words.count() // SHARD + 1, folder, "words", lambda keys, t: {"n": t["n"].to_numpy()}))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), model.total // SHARD + 1)
    while model.total and len(model.levels) < order - 1:
        model.levels.append(_level(texts, model, parts, least))
    return model


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every text."""

    def run(batches):
        for b, i, j, tok, row in _chunks(batches):
            n = j - i
            word, count = model.ids(tok)
            p = (count + 0.5) / (model.total + 0.5 * (model.kinds + 1))
            base, ranks = np.log10(p), word
            for level in range(len(model.levels)):
                ranks, gain, rest = model.successors(level, model.contexts(tok, ranks, level), word)
                p = gain + rest * p
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(i, n), pa.array(np.bincount(row, minlength=n)), pa.array(np.bincount(row, count > 0, minlength=n).astype(np.int64)), pa.array(np.bincount(row, base, minlength=n)), pa.array(np.bincount(row, np.log10(p), minlength=n))],
                names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
            )

    return c.id_text(docs, id_col, text_col).transform(c.mapped, run, "doc_id long, n_tokens long, n_known long, base_score double, score double")


def op4_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs.where(c.fold_bucket("doc_id", 5) != 1))
    return scored(docs, model).select("doc_id", (c.fold_bucket("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")
