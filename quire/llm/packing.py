"""Packing of tokenised documents into sequences of a fixed length, as few as can be found.

Method: bin completion.  Take the largest piece that is left, enumerate the undominated ways to fill the rest of its
sequence, fullest first, and follow them depth first.  A filling is left out if another piece still fits in, or if a
filling seen before at the same place dominates it: its pieces can be laid, one or several each, into pieces of that
one.  A branch is cut where the sequences used and a lower bound for what is left reach the incumbent's number; the
waste that this allows also ends the enumeration of fillings.  The incumbent starts as the better of best fit and of
the fullest filling at each step, whose emptiest sequences are then regrouped, a few at a time, by fullest fillings.

Whatever the corpus, pieces have one of `capacity` lengths, so the search runs on counts by length: one filling is
laid as often as its pieces allow, and less often only on the way back.  Only this histogram (capacity numbers at
most) comes to the driver.  The answer is a table of fillings; pieces of one length are numbered by partition offsets,
not by one sorted task, and the number of a piece within its length picks its sequence and offset.

The search is whole for small sets; for large ones it ends with `budget` nodes, and `gap` tells how many sequences the
answer can be above the least number.

Cases: null and empty texts have one token, the end mark; texts with more than `capacity` tokens are cut into full
pieces and one shorter first piece; a literal special token of the vocabulary is that token, as the tokenizers library
has it; repeated ids and rows without an id are packed as separate documents; an empty table has no pieces.
"""

from __future__ import annotations

import json
import random
import re
import zlib
from array import array
from bisect import insort
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as c

CAPACITY, END = 1024, 2
_END = array("I", [END]).tobytes()
CACHE, SLOTS = 50_000, 1 << 20  # words of which a task keeps the ids
_state: dict = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
#: The byte-level vocabulary's split into words (fixed values), for texts of Latin letters, ASCII and plain white space.
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\s{_LETTER}0-9]+|\s+(?!\S)|\s+")
_OTHER = re.compile(rf"[^{_LETTER}\t\n\r\x20-\x7e]")


_KIND = np.full(256, 2, np.int8)  # letter 0, digit 1, other 2, space 3, line 4
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 0
_KIND[48:58] = 1
_KIND[32] = 3
_KIND[[9, 10, 13]] = 4
_RARE = np.zeros(256, bool)
_RARE[[*(x for x in range(32) if x not in (9, 10, 13)), 127, *range(0xC0, 0xC3), *range(0xCA, 256)]] = True


def plain(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Which texts `cut_words` splits rightly: Latin letters, ASCII and plain white space, no contraction."""
    bad = _RARE[data]
    bad[1:] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    at = np.flatnonzero(data[:-1] == 39)
    nxt = data[at + 1]
    bad[at[np.isin(nxt, np.frombuffer(b"stmdrvl", np.uint8))]] = True
    return np.diff(np.append(0, np.cumsum(bad))[off]) == 0


def cut_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text, start and end of the words of plain texts, as `_SPLIT` cuts them."""
    n = len(data)
    if not n:
        return (np.zeros(0, c.U), *(np.zeros(0, np.int64) for _ in range(3)))
    kind = _KIND[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    white = kind >= 3
    before = np.append(True, white[:-1])  # white space before, within the text
    before[edge[:n]] = False
    after = np.append(white[1:], True)
    after[edge[1:]] = True  # nothing but white space follows at a text's end
    change = np.append(True, kind[1:] != kind[:-1]) | edge[:n]
    # white space: its first character, and its last before a word; words: unless a space was taken along
    spaced = np.append(False, kind[:-1] == 3) & ~edge[:n]
    left = np.where(white, ~before | ~after | edge[:n], change & ~spaced)
    start = np.flatnonzero(left)
    end = np.append(start[1:], n)
    p, q = c.powers(n + 1)
    sums = np.zeros(n + 1, c.U)
    np.cumsum((data.astype(c.U) + c.U(1)) * p[:n], out=sums[1:])
    h = c.mix((sums[end] - sums[start]) * q[start] ^ (end - start).astype(c.U) * c.U(0xD6E8FEB86659FD93))
    return h, np.searchsorted(off, start, "right") - 1, start, end


class Encoder:
    """Ids of whole texts.

    Words of plain texts are cut and hashed for a whole batch at once, and their ids looked up in a direct-mapped
    cache of SLOTS words; texts with contractions are cut one by one, and those with characters beyond `_OTHER` go
    to the tokenizers library whole.
    """

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model = whole["model"]
        self.special = [t["content"] for t in whole.get("added_tokens") or []]
        # the printable stand-ins of bytes in a byte-level vocabulary
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [x for x in range(256) if x not in plain]
        byte = {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(rest)}
        ranks = {bytes(byte[ch] for ch in t): k for t, k in model["vocab"].items() if all(ch in byte for ch in t)}
        made = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        # merges in the order of ids are what a rank-based merger does
        self.core = tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={}) if made == sorted(made) else None
        self.known: dict[str, bytes] = {}
        self.key, self.at, self.size = np.zeros(SLOTS, c.U), np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int32)
        self.pool, self.used = np.zeros(1 << 18, np.uint32), 0

    def batch(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, end marks included, and how many each has."""
        n = len(off) - 1
        h, row, start, end = cut_words(data, off)
        slot = (h & c.U(SLOTS - 1)).astype(np.int64)
        miss = np.flatnonzero(self.key[slot] != h)
        if len(miss):
            _, first = np.unique(h[miss], return_index=True)
            self.learn(data, h, slot, start, end, miss[first])
        at, size = self.at[slot].astype(np.int64), self.size[slot].astype(np.int64)
        # two words of this batch can claim one slot: the loser's ids are appended for this batch alone
        lost = np.flatnonzero(self.key[slot] != h)
        pool = self.pool
        if len(lost):
            word, back = np.unique(h[lost], return_inverse=True)
            pick = np.zeros(len(word), np.int64)
            pick[back] = lost
            own = [np.frombuffer(self.word(data[start[i] : end[i]].tobytes().decode()), np.uint32) for i in pick.tolist()]
            length = np.array([len(x) for x in own])
            at[lost], size[lost] = (self.used + np.cumsum(length) - length)[back], length[back]
            pool = np.concatenate([pool[: self.used], *own])
        total = np.bincount(row, size, minlength=n).astype(np.int64) + 1
        out = np.empty(int(total.sum()), np.uint32)
        ends = np.cumsum(total) - 1
        mask = np.ones(len(out), bool)
        mask[ends] = False
        out[ends] = END
        out[mask] = pool[np.repeat(at - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
        return out, total

    def learn(self, data, h, slot, start, end, rows) -> None:
        if self.used > 1 << 22:
            self.key[:], self.used = 0, 0
        own = [np.frombuffer(self.word(data[start[i] : end[i]].tobytes().decode()), np.uint32) for i in rows.tolist()]
        length = np.array([len(x) for x in own])
        flat = np.concatenate(own)
        if self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(flat), len(self.pool)), np.uint32)])
        self.pool[self.used : self.used + len(flat)] = flat
        self.key[slot[rows]] = h[rows]
        won = self.key[slot[rows]] == h[rows]
        self.at[slot[rows[won]]] = (self.used + np.cumsum(length) - length)[won]
        self.size[slot[rows[won]]] = length[won]
        self.used += len(flat)

    @cached_property
    def tok(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def simple(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Which texts `batch` can take."""
        easy, raw = plain(data, off), data.tobytes()
        for name in self.special:
            at = raw.find(name.encode())
            while at >= 0:
                easy[np.searchsorted(off, at, "right") - 1] = False
                at = raw.find(name.encode(), at + 1)
        return easy

    def word(self, w: str) -> bytes:
        ids = self.core.encode_ordinary(w) if self.core else self.tok.encode(w, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def __call__(self, text: str) -> bytes:
        if _OTHER.search(text) or any(t in text for t in self.special):
            return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes() + _END
        words, known = _SPLIT.findall(text), self.known
        try:
            return b"".join(map(known.__getitem__, words)) + _END
        except KeyError:
            if len(known) > CACHE:
                known.clear()
            for w in set(words).difference(known):
                known[w] = self.word(w)
            return b"".join(map(known.__getitem__, words)) + _END


def encoder(path: str) -> Encoder:
    if path not in _state:
        _state[path] = Encoder(path)
    return _state[path]


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the pieces to pack."""
    tokenizer = tokenizer or default_tokenizer()

    def run(batches):
        try:
            yield from cut(encoder(tokenizer), batches)
        finally:
            _state.clear()  # workers outlive their tasks

    def cut(enc, batches):
        for b in batches:
            data, off = c.strings(b.column("text"))
            ids_of = b.column("doc_id").to_pylist()
            for i, j in c.pieces(off, 1 << 20):
                part, at = data[off[i] : off[j]], off[i : j + 1] - off[i]
                easy = enc.simple(part, at) if len(part) else np.ones(j - i, bool)
                size = np.diff(at)
                ids, count = enc.batch(part[np.repeat(easy, size)], np.append(0, np.cumsum(size[easy])))
                raw, cuts = ids.tobytes(), iter(np.append(0, np.cumsum(count)).tolist())
                low, rows = next(cuts), []
                for k in range(i, j):
                    if easy[k - i]:
                        high = next(cuts)
                        text, low = raw[4 * low : 4 * high], high
                    else:
                        text = enc(part[at[k - i] : at[k - i + 1]].tobytes().decode())
                    n = len(text) // 4
                    start, end, piece = 0, (n - 1) % capacity + 1, 0
                    while start < n:
                        rows.append((ids_of[k], piece, start, end - start, zlib.crc32(text[4 * start : 4 * end])))
                        start, end, piece = end, end + capacity, piece + 1
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    c.settle(docs.sparkSession)
    every = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return every.transform(c.mapped, run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """(times, lengths) of best-fit decreasing over counts: each piece joins the fullest open sequence that it fits."""
    left = counts.copy()
    plan = []
    while True:
        over = np.flatnonzero(left)
        if not len(over):
            return plan
        fill, room = [], capacity
        while room:
            own = left.copy()
            for x in fill:
                own[x] -= 1
            fit = np.flatnonzero(own[: room + 1] > 0)
            if not len(fit):
                break
            fill.append(int(fit[-1]))
            room -= fill[-1]
        kinds, need = np.unique(fill, return_counts=True)
        times = int((left[kinds] // need).min())
        left[kinds] -= times * need
        plan.append((times, tuple(fill)))


def fullest(counts: np.ndarray, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """(times, lengths) where each sequence is filled, around the largest piece left, as far as the pieces left allow."""
    left, plan = counts.copy(), []
    while left.any():
        top = int(np.flatnonzero(left)[-1])
        left[top] -= 1
        fill = (top, *next(completions(left, capacity - top, capacity)))
        left[top] += 1
        plan.append((_lay(left, fill), fill))
    return plan


def _lay(left: np.ndarray, fill: tuple[int, ...], most: int | None = None) -> int:
    """Takes the filling out of the counts as often as it goes, and returns how often."""
    kinds, need = np.unique(fill, return_counts=True)
    times = int((left[kinds] // need).min())
    times = times if most is None else min(times, most)
    left[kinds] -= times * need
    return times


def regrouped(plan: list[tuple[int, tuple[int, ...]]], capacity: int, floor: int, rounds: int, pool: int = 2000, seed: int = 1) -> list[tuple[int, tuple[int, ...]]]:
    """The plan with fewer sequences where waste can be brought together.

    In each round the pieces of the emptiest sequence and of a few others are laid anew, each time around the largest, as
    full as can be; what comes out is kept if the emptiest one is emptier or gone.  At most `pool` sequences take part.
    """
    rng, open_, rest = random.Random(seed), [], []
    for times, f in sorted(plan, key=lambda p: sum(p[1])):
        part = min(times, pool - len(open_)) if len(f) > 1 or sum(f) < capacity else 0
        open_ += [f] * part
        rest += [(times - part, f)] if times > part else []
    fixed = sum(t for t, _ in rest)
    for _ in range(rounds):
        if len(open_) < 2 or len(open_) + fixed <= floor:
            break
        pick = sorted(rng.sample(range(1, len(open_)), min(len(open_) - 1, rng.choice((3, 5, 8)))), reverse=True)
        counts = np.bincount([x for i in (0, *pick) for x in open_[i]], minlength=capacity + 1)
        laid = [f for times, f in fullest(counts, capacity) for _ in range(times)]
        if len(laid) <= len(pick) or len(laid) == len(pick) + 1 and min(map(sum, laid)) < sum(open_[0]):
            for i in (*pick, 0):
                del open_[i]
            for f in laid:
                insort(open_, f, key=sum)
    return [*rest, *((1, f) for f in open_)]


def bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that are needed at least: pieces above half of the capacity have one each, and what the others, from some length on, cannot lay beside those needs more."""
    n, size = np.append(counts, 0), np.arange(len(counts) + 1)
    above, total = np.cumsum(n[::-1])[::-1], np.cumsum((n * size)[::-1])[::-1]  # of pieces from a length on
    k = np.arange(0, capacity // 2 + 1)  # pieces under k are left out
    half, far = capacity // 2 + 1, np.minimum(capacity - k + 1, len(counts))
    alone, beside = above[far], above[half] - above[far]
    room = beside * capacity - (total[half] - total[far])
    small = total[k] - total[half]
    return int((alone + beside + np.maximum(0, -(-(small - room) // capacity))).max()) if len(k) and above[0] else 0


def completions(counts: np.ndarray, room: int, slack: int):
    """Ways to fill `room` with the pieces counted, wasting `slack` at most, fullest first, none that leaves room for a piece."""
    lengths = [int(x) for x in np.flatnonzero(counts[: room + 1])[::-1] if x]
    mask, reach = (1 << room + 1) - 1, [1]
    for x in reversed(lengths):  # sums that the lengths from here on have
        sums, rest, step = reach[-1], min(int(counts[x]), room // x), 1
        while rest:
            step = min(step, rest)
            sums |= sums << step * x & mask
            rest -= step
            step *= 2
        reach.append(sums)
    reach.reverse()

    def grow(k: int, target: int, chosen: tuple[int, ...]):
        if not target:
            yield chosen
            return
        for i in range(k, len(lengths)):
            x = lengths[i]
            for n in range(min(int(counts[x]), target // x), 0, -1):
                if reach[i + 1] >> target - n * x & 1:
                    yield from grow(i + 1, target - n * x, chosen + (x,) * n)
            if not reach[i + 1] >> target & 1:
                return

    for waste in range(min(slack, room) + 1):
        if reach[0] >> room - waste & 1:
            for f in grow(0, room - waste, ()):
                if not waste or all(counts[x] <= f.count(x) for x in lengths if x <= waste):
                    yield f


def dominates(g: tuple[int, ...], f: tuple[int, ...]) -> bool:
    """Whether the pieces of f can be laid into those of g, several into one; both longest first."""
    if sum(f) > sum(g):
        return False
    bins = list(g)

    def lay(k: int) -> bool:
        if k == len(f):
            return True
        for i in range(len(bins)):
            if bins[i] >= f[k] and bins[i] not in bins[:i]:
                bins[i] -= f[k]
                if lay(k + 1):
                    return True
                bins[i] += f[k]
        return False

    return lay(0)


def plan(counts: np.ndarray, capacity: int, budget: int = 4000, rounds: int = 8000) -> list[tuple[int, tuple[int, ...]]]:
    """(times, lengths) of as few sequences as `rounds` of regrouping and `budget` nodes of the search find."""
    counts = counts.astype(np.int64)
    size = np.arange(len(counts))
    best = min((best_fit(counts, capacity), fullest(counts, capacity)), key=lambda p: sum(t for t, _ in p))
    floor = bound(counts, capacity)
    best = regrouped(best, capacity, floor, rounds)
    best_n = sum(t for t, _ in best)

    def branches(left: np.ndarray, used: int, banned: frozenset):
        """(times, filling) around the largest piece, best first; then the same less often."""
        top, seen = int(np.flatnonzero(left)[-1]), []
        rest = left.copy()
        rest[top] -= 1
        for f in completions(rest, capacity - top, (best_n - 1 - used) * capacity - int((size * left).sum())):
            if f in banned or any(dominates(g, f) for g in seen):
                continue
            seen.append(f)
            most = _lay(left.copy(), (top, *f))
            for times in range(most, 0, -1):
                yield times, (top, *f), frozenset(banned | {f}) if times < most else frozenset()

    stack = [(counts, (), 0, branches(counts, 0, frozenset()))] if best_n > floor else []
    while stack and best_n > floor and budget:
        left, laid, used, more = stack[-1]
        step = next(more, None)
        if step is None:
            stack.pop()
            continue
        times, f, banned = step
        budget -= 1
        after = left.copy()
        _lay(after, f, times)
        if not after.any():
            if used + times < best_n:
                best_n, best, chain = used + times, [(times, f)], laid
                while chain:
                    chain, one = chain
                    best.append(one)
        elif used + times + bound(after, capacity) < best_n:
            # pieces as long as this one that are left over may not be laid the same way again
            same = banned if after[f[0]] else frozenset()
            stack.append((after, (laid, (times, f)), used + times, branches(after, used + times, same)))
    return best


def gap(counts: np.ndarray, capacity: int, found: list[tuple[int, tuple[int, ...]]]) -> int:
    """How many sequences a plan may have above the least number."""
    return sum(t for t, _ in found) - bound(counts, capacity)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces (a stored table) with sequence_id and offset.

    A piece's number within its length is its number within a block, by id, and the count of that length in
    the blocks before; blocks grow with the square root of the rows, so neither step meets a large group.
    """
    spark = cut.sparkSession
    blocks = int(cut.count() ** 0.5) + 1
    cut = cut.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "length"), F.lit(blocks)))
    ranked = cut.withColumn("rank", F.row_number().over(Window.partitionBy("block", "length").orderBy("doc_id", "piece", "ids_crc32", "start")))
    by = cut.groupBy("block", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = by.select("block", "length", F.coalesce(before, F.lit(0)).alias("from"))
    counts = np.zeros(capacity + 1, np.int64)
    for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect():  # capacity rows at most
        counts[r["length"]] = r["n"]
    slots: dict[int, list[tuple[int, int, int]]] = {}
    base = 0
    for times, lengths in plan(counts, capacity):
        at = 0
        for x in lengths:
            slots.setdefault(x, []).append((times, base, at))
            at += x
        base += times
    where = spark.sparkContext.broadcast({x: (np.cumsum([t for t, _, _ in s]), *(np.array(v, np.int64) for v in zip(*s, strict=True))) for x, s in slots.items()})
    names = [f.name for f in cut.schema if f.name != "block"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema if f.name != "block") + ", sequence_id long, offset long"

    def run(batches):
        for b in batches:
            length, number = b.column("length").to_numpy(), b.column("number").to_numpy()
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length).tolist():
                rows = np.flatnonzero(length == x)
                ends, times, bases, offs = where.value[x]
                k = np.searchsorted(ends, number[rows], "right")
                seq[rows] = bases[k] + number[rows] - (ends[k] - times[k])
                off[rows] = offs[k]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(seq), pa.array(off)], names=[*names, "sequence_id", "offset"])

    numbered = ranked.join(starts, ["block", "length"]).select(*names, (F.col("from") + F.col("rank") - 1).alias("number"))
    return numbered.transform(c.mapped, run, schema)


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of all documents."""
    return pack(c.table(pieces(docs, id_col, text_col, capacity, tokenizer), "pieces"), capacity)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
