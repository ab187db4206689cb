"""SentencePiece encoding and decoding for batches of texts.

Method: Viterbi in batches.  Texts are cut into words (a run of spaces and what follows it; pieces hold spaces at their
start only).  The distinct words of a few megabytes are grouped by length, and all words of one length advance
together in numpy: at each place the hashes of the substrings that end there probe the sorted hashes of the
vocabulary's pieces, and the vectorised maximum of the score before each plus its own stores a backpointer, the longest
piece at ties.  A word's ids are those of the segmentation with the highest sum of piece scores.

A vocabulary trained by merges, such as the public one here, has scores too (minus the rank of a piece's merge), and
Viterbi segments by them; the ids that its own library gives come from merging, which no sum of scores reproduces.
With `merging` the same batches choose, step by step, the best adjacent pair of each word, the leftmost at ties, and
ids are those of the library.

A character without a piece becomes the pieces of its UTF-8 bytes.  Decoding joins pieces, turns marks into spaces and
drops the first, so texts come back exactly.

Cases: null and empty texts have no ids; a literal mark (U+2581) is coded by its bytes; words of any length are whole
(with `merging` those of more than LONG characters are merged by the library); equal words are coded alike wherever
they are; repeated ids are coded each, rows without an id are left out, other columns may have any name.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common as c

MARK, LONG, SLOTS = 0x2581, 400, 1 << 20
_state: dict = {}


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    def __init__(self, path: str, merging: bool = False):
        import sentencepiece

        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        if merging and proto.trainer_spec.model_type != 2:
            raise ValueError(f"{path} has no merges")
        sp = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        self.bytes_of = [b""] * n
        self.byte_ids = np.full(256, sp.unk_id(), np.int64)
        keys, ids, scores = [], [], []
        for i, name in enumerate(names):
            if sp.is_byte(i):
                value = int(re.fullmatch(r"<0x(..)>", name)[1], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.bytes_of[i] = name.replace(chr(MARK), " ").encode()
                keys.append(name)
                ids.append(i)
                scores.append(sp.get_score(i))
        self.sp, self.merges = sp, merging
        self.longest = max(map(len, keys))
        points = [np.frombuffer(k.encode("utf-32-le"), np.uint32) for k in keys]
        h = np.array([_hash(p) for p in points], c.U)
        order = np.argsort(h)
        self.keys, self.ids, self.scores = h[order], np.array(ids)[order], np.array(scores, float)[order]
        self.unknown = float(min(scores)) - 10
        self.known, self.at, self.size = np.zeros(SLOTS, c.U), np.zeros(SLOTS, np.int32), np.zeros(SLOTS, np.int32)
        self.pool, self.used = np.zeros(1 << 18, np.int32), 0

    def learn(self, slot: np.ndarray, h: np.ndarray, flat: np.ndarray, count: np.ndarray) -> None:
        """Keeps the ids of words in a direct-mapped cache; full pools start afresh."""
        if self.used + len(flat) > 1 << 22:
            self.known[:], self.used = 0, 0
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(flat)] = flat
        self.known[slot] = h
        won = self.known[slot] == h
        self.at[slot[won]], self.size[slot[won]] = (self.used + np.cumsum(count) - count)[won], count[won]
        self.used += len(flat)

    def recall(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, size = self.at[slot].astype(np.int64), self.size[slot].astype(np.int64)
        return self.pool[np.repeat(at - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))], size


def _hash(points: np.ndarray) -> np.uint64:
    p, _ = c.powers(len(points))
    with np.errstate(over="ignore"):
        return c.mix(np.array([((points.astype(c.U) + c.U(1)) * p).sum(dtype=c.U)]) ^ c.U(len(points)) * c.U(0xD6E8FEB86659FD93))[0]


def vocabulary(path: str, merging: bool = False) -> Vocabulary:
    if (path, merging) not in _state:
        _state[path, merging] = Vocabulary(path, merging)
    return _state[path, merging]


def viterbi(v: Vocabulary, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Backpointers (piece lengths) and piece ids, -1 for an unknown character, at each end of each word; words: code points, a word a row."""
    n, size = words.shape
    p, q = c.powers(size + 1)
    sums = np.zeros((n, size + 1), c.U)
    np.cumsum((words.astype(c.U) + c.U(1)) * p[:size], axis=1, out=sums[:, 1:])
    best = np.zeros((n, size + 1))
    back, ids = np.ones((n, size + 1), np.int64), np.full((n, size + 1), -1, np.int64)
    for end in range(1, size + 1):
        lengths = np.arange(min(end, v.longest), 0, -1)
        starts = end - lengths
        h = c.mix((sums[:, end : end + 1] - sums[:, starts]) * q[starts] ^ lengths.astype(c.U) * c.U(0xD6E8FEB86659FD93))
        at = np.minimum(np.searchsorted(v.keys, h), len(v.keys) - 1)
        hit = v.keys[at] == h
        score = np.where(hit, v.scores[at], -np.inf)
        none = ~hit[:, -1]
        score[none, -1] = v.unknown
        score += best[:, starts]
        pick = np.argmax(score, axis=1)
        row = np.arange(n)
        best[:, end] = score[row, pick]
        back[:, end] = lengths[pick]
        ids[:, end] = np.where(hit[row, pick], v.ids[at[row, pick]], -1)
    return back, ids


def merged(v: Vocabulary, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, id and last character of the pieces of each word: the best adjacent pair of every word is merged at each step."""
    n, size = words.shape
    p, q = c.powers(size + 1)
    sums = np.zeros((n, size + 1), c.U)
    np.cumsum((words.astype(c.U) + c.U(1)) * p[:size], axis=1, out=sums[:, 1:])

    def look(row, start, end):
        h = c.mix((sums[row, end] - sums[row, start]) * q[start] ^ (end - start).astype(c.U) * c.U(0xD6E8FEB86659FD93))
        at = np.minimum(np.searchsorted(v.keys, h), len(v.keys) - 1)
        hit = v.keys[at] == h
        return np.where(hit, v.ids[at], -1), np.where(hit, v.scores[at], -np.inf)

    bound = np.tile(np.arange(size + 2), (n, 1))
    bound[:, size + 1] = size
    row, col = np.repeat(np.arange(n), size), np.tile(np.arange(size), n)
    ids = look(row, col, col + 1)[0].reshape(n, size)
    score, pair = np.full((n, size), -np.inf), np.full((n, size), -1)
    if size > 1:
        row, col = np.repeat(np.arange(n), size - 1), np.tile(np.arange(size - 1), n)
        got = look(row, col, col + 2)
        pair[:, : size - 1], score[:, : size - 1] = (x.reshape(n, size - 1) for x in got)
    count, live, cols = np.full(n, size), np.arange(n), np.arange(size)
    while len(live):
        k = np.argmax(score[live], axis=1)
        ok = score[live, k] > -np.inf
        live, k = live[ok], k[ok]
        if not len(live):
            break
        ids[live, k] = pair[live, k]
        shift = np.minimum(cols + (cols > k[:, None]), size - 1)
        for x in (ids, pair, score):
            x[live] = np.take_along_axis(x[live], shift, 1)
        bound[live] = np.take_along_axis(bound[live], np.minimum(np.arange(size + 2) + (np.arange(size + 2) > k[:, None]), size + 1), 1)
        count[live] -= 1
        for at in (k - 1, k):  # the pairs that the new piece is in
            can = (at >= 0) & (at < count[live] - 1)
            r, a = live[can], at[can]
            pair[r, a], score[r, a] = look(r, bound[r, a], bound[r, a + 2])
            score[live[~can & (at >= 0)], at[~can & (at >= 0)]] = -np.inf
    row = np.repeat(np.arange(n), count)
    place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return row, ids[row, place], words[row, bound[row, place + 1] - 1]


def _traced(v: Vocabulary, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As `merged`, along the backpointers of Viterbi."""
    back, ids = viterbi(v, words)
    at, live, taken = np.full(len(words), words.shape[1]), np.arange(len(words)), []
    while len(live):
        taken.append((live, ids[live, at[live]], words[live, at[live] - 1]))
        at[live] -= back[live, at[live]]
        live = live[at[live] > 0]
    row, got, last = (np.concatenate([t[k] for t in taken])[::-1] for k in range(3))
    order = np.argsort(row, kind="stable")
    return row[order], got[order], last[order]


def encode_words(v: Vocabulary, points: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words points[start:end] one after another, and how many each has."""
    size = end - start
    out: list = [None] * len(start)
    for n in np.unique(size).tolist():
        rows = np.flatnonzero(size == n)
        if n > LONG and v.merges:
            for w in rows.tolist():
                text = points[start[w] : end[w]].astype(np.uint32).tobytes().decode("utf-32-le")
                out[w] = np.array(v.sp.encode(text[1:].replace(chr(MARK), " ")), np.int64)
            continue
        step = max(1, 4_000_000 // (n * min(n, v.longest) + 1))
        for i in range(0, len(rows), step):
            part = rows[i : i + step]
            words = points[start[part][:, None] + np.arange(n)]
            row, got, last = (merged if v.merges else _traced)(v, words)
            lost = np.flatnonzero(got < 0)
            if len(lost):
                raw = [v.byte_ids[np.frombuffer(chr(x).encode("utf-8", "replace"), np.uint8)] for x in last[lost].tolist()]
                count = np.ones(len(got), np.int64)
                count[lost] = [len(x) for x in raw]
                row, got = np.repeat(row, count), np.repeat(got, count)
                got[got < 0] = np.concatenate(raw)
            cut = np.searchsorted(row, np.arange(len(part) + 1)).tolist()
            for k, w in enumerate(part.tolist()):
                out[w] = got[cut[k] : cut[k + 1]]
    count = np.array([len(x) for x in out], np.int64)
    return (np.concatenate(out) if out else np.zeros(0, np.int64)), count


def encode(v: Vocabulary, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each text, one after another, and how many each has."""
    n = len(off) - 1
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    char = np.append(0, np.cumsum((data & 0xC0) != 0x80))[off]
    full = np.flatnonzero(np.diff(char))
    # the mark that stands before each text, then spaces as marks and literal marks as a character no piece has
    line = np.insert(np.where(points == 32, MARK, np.where(points == MARK, 0x10FFFF, points)), char[:-1][full], MARK)
    first = char[:-1][full] + np.arange(len(full))
    mark = line == MARK
    head = mark.copy()
    head[1:] &= ~mark[:-1]
    head[first] = True
    start = np.flatnonzero(head)
    end = np.append(start[1:], len(line))
    row = full[np.searchsorted(first, start, "right") - 1] if len(full) else start
    p, q = c.powers(len(line) + 1)
    sums = np.zeros(len(line) + 1, c.U)
    np.cumsum((line.astype(c.U) + c.U(1)) * p[: len(line)], out=sums[1:])
    h = c.mix((sums[end] - sums[start]) * q[start] ^ (end - start).astype(c.U) * c.U(0xD6E8FEB86659FD93))
    word, one, back = np.unique(h, return_index=True, return_inverse=True)
    slot = (word & c.U(SLOTS - 1)).astype(np.int64)
    new = v.known[slot] != word
    flat, count = encode_words(v, line, start[one[new]], end[one[new]])
    old, old_count = v.recall(slot[~new])
    v.learn(slot[new], word[new], flat, count)
    rank = np.empty(len(word), np.int64)  # new words first, then those recalled
    rank[new], rank[~new] = np.arange(len(count)), len(count) + np.arange(len(old_count))
    flat, count, back = np.concatenate([flat, old]), np.concatenate([count, old_count]), rank[back]
    if (line == 0x10FFFF).any():
        ghost, real = v.byte_ids[np.frombuffer(chr(0x10FFFF).encode(), np.uint8)], v.byte_ids[np.frombuffer(chr(MARK).encode(), np.uint8)]
        at = np.flatnonzero((flat[:-3] == ghost[0]) & (flat[1:-2] == ghost[1]) & (flat[2:-1] == ghost[2]) & (flat[3:] == ghost[3]))
        flat = flat.copy()
        for k in range(3):
            flat[at + k] = real[k]
        gone = at + 3
        word = np.searchsorted(np.cumsum(count), gone, "right")
        flat = np.delete(flat, gone)
        count = count - np.bincount(word, minlength=len(count))
    begin = np.cumsum(count) - count
    size = count[back]
    ids = flat[np.repeat(begin[back] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
    return ids, np.bincount(row, size, minlength=n).astype(np.int64)


def decode(v: Vocabulary, ids: np.ndarray) -> str:
    return b"".join([v.bytes_of[i] for i in ids.tolist()])[1:].decode("utf-8", "replace")


def _coded(batches, model: str, merging: bool = False):
    """Vocabulary, batch, row range, texts and their ids, about a megabyte at a time."""
    try:
        v = vocabulary(model, merging)
        for b in batches:
            data, off = c.strings(b.column("text"))
            for i, j in c.pieces(off, 1 << 20):
                part, at = data[off[i] : off[j]], off[i : j + 1] - off[i]
                yield v, b.column("doc_id").slice(i, j - i), part, at, *encode(v, part, at)
    finally:
        _state.clear()  # workers outlive their tasks


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None, merging: bool = False) -> DataFrame:
    """(doc_id, ids array<int>) of every text."""
    model = model or default_model()

    def run(batches):
        for _, ids_of, _, _, ids, n in _coded(batches, model, merging):
            yield pa.RecordBatch.from_arrays([ids_of, pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(ids.astype(np.int32)))], names=["doc_id", "ids"])

    return c.id_text(docs, id_col, text_col).transform(c.mapped, run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids)."""
    model = model or default_model()

    def run(batches):
        try:
            v = vocabulary(model)
            for b in batches:
                texts = [decode(v, np.array(x or [], np.int64)) for x in b.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])
        finally:
            _state.clear()

    return rows.select("doc_id", "ids").transform(c.mapped, run, "doc_id long, text string")


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, n_ids, ids_crc32, exact): exact says that decoding gave the text back."""
    model = default_model()

    def run(batches):
        for v, ids_of, part, at, ids, n in _coded(batches, model):
            cut, raw, text = np.append(0, np.cumsum(n)).tolist(), ids.astype(np.uint32).tobytes(), part.tobytes()
            spell, ids = v.bytes_of, ids.tolist()
            rows = [(cut[k + 1] - cut[k], zlib.crc32(raw[4 * cut[k] : 4 * cut[k + 1]]), b"".join([spell[x] for x in ids[cut[k] : cut[k + 1]]])[1:] == text[at[k] : at[k + 1]]) for k in range(len(ids_of))]
            yield pa.RecordBatch.from_arrays([ids_of, *(pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.bool_()), strict=True))], names=["doc_id", "n_ids", "ids_crc32", "exact"])

    return c.id_text(spark.read.parquet(f"{sf_dir}/documents.parquet")).transform(c.mapped, run, "doc_id long, n_ids long, ids_crc32 long, exact boolean")
