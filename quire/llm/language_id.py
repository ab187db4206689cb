"""Language identification by cross-parsing entropy.

Method: per language a suffix automaton of labelled text.  A text is parsed from left to right into the
longest phrases that occur in a language's sample; the number of phrases per character estimates the cross
entropy, and the language that needs the fewest wins.  Parses start afresh at each word, with its two
borders as characters, so a word's phrases are counted once and reused wherever the word occurs; every
word of every text counts.

The automata are learned from at most ROWS sampled rows and BYTES bytes a language; they are the only thing
that is broadcast.  Case is folded, and everything that is no letter separates words.

Cases: null texts and texts without a letter give `und` with score 0; ties go to the first language by
name; without labelled rows all is `und`; labels, source and id are never read while predicting; repeated
rows are predicted each, rows without an id are left out (`known_language` judges them like others), other columns may
have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

ROWS, BYTES = 400, 100_000
SLOTS = 1 << 19
_APART = np.ones(256, bool)
_APART[97:123] = False
_APART[65:91] = False
_APART[128:] = False
_cache: dict = {}


def automaton(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Transitions of the suffix automaton of text, as an open-addressing table (state * 256 + byte + 1 -> state)."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for ch in text:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and ch not in nxt[p]:
            nxt[p][ch] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][ch]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(ch) == q:
                    nxt[p][ch] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    keys = np.array([(s << 8 | ch) + 1 for s, d in enumerate(nxt) for ch in d], np.int64)
    to = np.array([t for d in nxt for t in d.values()], np.int32)
    size = 1 << max(10, int(2 * max(len(keys), 1)).bit_length())
    table, state = np.zeros(size, np.int64), np.zeros(size, np.int32)
    at, rest = _slot(keys, size), np.arange(len(keys))
    while len(rest):
        free = table[at[rest]] == 0
        table[at[rest[free]]] = keys[rest[free]]
        won = table[at[rest]] == keys[rest]
        state[at[rest[won]]] = to[rest[won]]
        rest = rest[~won]
        at[rest] = (at[rest] + 1) & (size - 1)
    return table, state


def _slot(keys: np.ndarray, size: int) -> np.ndarray:
    return (c.mix(keys.astype(c.U)) & c.U(size - 1)).astype(np.int64)


def _step(auto, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """The next state, or -1."""
    table, to = auto
    key = (state.astype(np.int64) << 8 | byte) + 1
    at = _slot(key, len(table))
    out = np.full(len(key), -1, np.int32)
    rest = np.arange(len(key))
    while len(rest):
        got = table[at[rest]]
        hit = got == key[rest]
        out[rest[hit]] = to[at[rest[hit]]]
        rest = rest[~hit & (got != 0)]
        at[rest] = (at[rest] + 1) & (len(table) - 1)
    return out


def phrases(auto, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Longest-match phrases of each word data[start:end], borders included; all words advance together."""
    count, state = np.zeros(len(start), np.int32), np.zeros(len(start), np.int32)
    live = np.arange(len(start))
    step = -1
    while len(live):
        at = start[live] + step
        byte = np.where((step < 0) | (at >= end[live]), 32, data[np.minimum(np.maximum(at, 0), len(data) - 1)]).astype(np.int64)
        to = _step(auto, state[live], byte)
        stuck = to < 0
        count[live[stuck & (state[live] != 0)]] += 1
        again = np.flatnonzero(stuck)
        to[again] = _step(auto, np.zeros(len(again), np.int32), byte[again])
        lone = to < 0  # a byte that the sample lacks is a phrase of its own
        count[live[lone]] += 1
        state[live] = np.where(lone, 0, to)
        step += 1
        live = live[start[live] + step <= end[live]]
    return count + (state != 0)


def samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = ROWS, size: int = BYTES) -> DataFrame:
    """(lang, texts): of each language a bounded sample of its rows, chosen by a hash of the id."""
    rows_in = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    per = {r["lang"]: r["n"] for r in rows_in.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row a language
    share = F.create_map(*[F.lit(x) for k, n in per.items() for x in (k, min(1.0, rows / n))]) if per else F.lit(None).cast("map<string,double>")
    picked = rows_in.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))

    # about `rows` texts a language, of which no more than `size` characters can be used
    return picked.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct(F.crc32(F.encode("text", "UTF-8")).alias("k"), F.substring("text", 1, size).alias("t")))), lambda x: x["t"]).alias("texts"))


def joined(texts: list[str], size: int) -> bytes:
    """The words of texts in lower case, one blank between, up to `size` bytes, and a blank at both ends."""
    got, have = [], 0
    for text in texts:
        raw = np.frombuffer(text.lower().encode(), np.uint8)
        word = b" ".join(np.where(_APART[raw], 32, raw).astype(np.uint8).tobytes().split())[: size - have]
        got.append(word)
        have += len(word) + 1
        if have >= size:
            break
    return b" " + b" ".join(got) + b" "


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = ROWS, size: int = BYTES) -> dict:
    """{language: automaton} of the languages' samples."""

    def run(batches):
        for b in batches:
            made = [automaton(joined(x, size)) for x in b.column("texts").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("lang"), *(pa.array([x[k].tobytes() for x in made], pa.binary()) for k in (0, 1))], names=["lang", "table", "state"])

    found = samples(docs, id_col, text_col, lang_col, rows, size).transform(c.mapped, run, "lang string, table binary, state binary").collect()  # one row a language, bounded by `size`
    return {r["lang"]: (np.frombuffer(r["table"], np.int64), np.frombuffer(r["state"], np.int32)) for r in sorted(found, key=lambda r: r["lang"])}


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), every: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score, entropy) and the columns to keep, as keep_<name>; the score is the lead over the second language, 0 to 1.

    Rows without an id are left out unless `every`.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = list(model)

    def counts(data, h, start, end):
        """Phrases of each word by language; words met before come from a direct-mapped cache."""
        if _cache.get("of") is not shared.value:
            _cache.update(of=shared.value, key=np.zeros(SLOTS, c.U), n=np.zeros((SLOTS, len(names)), np.int32))
        word, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        at = (word & c.U(SLOTS - 1)).astype(np.int64)
        out = _cache["n"][at]
        new = np.flatnonzero(_cache["key"][at] != word)
        if len(new):
            for k, name in enumerate(names):
                out[new, k] = phrases(shared.value[name], data, start[first[new]], end[first[new]])
            _cache["key"][at[new]] = word[new]
            _cache["n"][at[new]] = out[new]
        return out, inverse

    def run(batches):
        try:
            yield from told(batches)
        finally:
            _cache.clear()  # workers outlive their tasks

    def told(batches):
        for b in batches:
            text = pc.fill_null(b.column("text"), "")
            letters = pc.match_substring_regex(text, r"\pL").to_numpy(zero_copy_only=False)
            data, off = c.strings(pc.utf8_lower(text))
            n = len(off) - 1
            total, size = np.zeros((n, len(names)), np.int64), np.zeros(n, np.int64)
            for i, j in c.pieces(off):
                part = data[off[i] : off[j]]
                h, row, start, end = c.words(part, off[i : j + 1] - off[i], space=_APART)
                if len(h) and names:
                    each, inverse = counts(part, h, start, end)
                    for k in range(len(names)):
                        total[i:j, k] = np.bincount(row, each[inverse, k], minlength=j - i)
                    size[i:j] = np.bincount(row, end - start + 1, minlength=j - i)
            pred, score = np.full(n, "und", object), np.zeros(n)
            per = total / np.maximum(size, 1)[:, None]
            ok = letters & (size > 0) & bool(names)
            if names and ok.any():
                order = np.argsort(per[ok], axis=1, kind="stable")
                best = np.take_along_axis(per[ok], order[:, :1], 1)[:, 0]
                second = np.take_along_axis(per[ok], order[:, 1:2], 1)[:, 0] if len(names) > 1 else np.ones(len(best))
                pred[ok] = np.array(names, object)[order[:, 0]]
                score[ok] = np.clip(1 - best / np.maximum(second, 1e-9), 0, 1)
            low = np.where(ok, per.min(axis=1) if names else 0.0, 0.0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(pred, pa.string()), pa.array(score), pa.array(low), *(b.column(f"keep_{k}") for k in keep)], names=["doc_id", "lang_pred", "score", "entropy", *(f"keep_{k}" for k in keep)])

    c.settle(docs.sparkSession)
    cols = (docs if every else docs.where(F.col(id_col).isNotNull())).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *(F.col(k).alias(f"keep_{k}") for k in keep))
    more = "".join(f", `keep_{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    return cols.transform(c.mapped, run, "doc_id long, lang_pred string, score double, entropy double" + more)


def known_language(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, whose language can be told; where no language was learned, those with a letter. Rows without an id are judged like others."""
    if not model:
        return docs.where(F.col(text_col).rlike(r"\p{L}"))
    keep = tuple(k for k in docs.columns if k != id_col)
    told = predict(docs, model, id_col, text_col, keep, every=True).where("lang_pred <> 'und'")
    return told.select(*(F.col("doc_id").alias(id_col) if k == id_col else F.col(f"keep_{k}").alias(k) for k in docs.columns))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs.where(c.fold_bucket("doc_id", 4) != 2))
    return predict(docs, model).withColumn("held_out", c.fold_bucket("doc_id", 4) == 2)
