"""Document quality by a generalised additive model with pairwise interactions.

Method: each feature is cut into bins; boosting goes round the features, and at each a shallow tree over that
feature's bins adds a small step to its lookup table.  Afterwards the pairs whose residuals gain most get
two-way tables, grown the same way by trees with one cut on either feature.  A score is the logistic of the
sum of one table entry per feature and pair: vectorised additions by bin.

Features are read from the whole text in one pass (bytes, words and lines of an Arrow batch at once) and kept
as a table; the model is fitted on at most about SAMPLE labelled rows, which is all the driver sees.

Cases: null and empty texts have features of zero and get a score like any other; a document with several
labels has their mean, half counting as 1; without labelled rows every score is 0.5; repeated ids give a row each, rows without an id are left out.
Ids are 64-bit integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

SAMPLE, BINS, CYCLES, PAIRS, GRID = 20_000, 32, 240, 8, 8
NAMES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digit", "stop", "symbol", "bar", "wide", "blank", "distinct_words", "top_word", "distinct_lines",
    "line_words", "long_words", "marked_words", "capital_words", "distinct_pairs", "log_lines", "bang",
)
_CLASS = np.full(256, 6, np.int64)  # other symbols
for _chars, _k in ((range(97, 123), 0), (range(65, 91), 1), (range(48, 58), 2), (b".,;:?'\"()-", 3), (b"|", 4), (range(128, 256), 5), (b" \t\r\v\f", 7), (b"\n", 8), (b"!", 9)):
    _CLASS[list(_chars)] = _k
_LINE = np.zeros(256, bool)
_LINE[10] = True


def _distinct(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the largest number of equal ones in each row."""
    if not len(h):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    order = np.lexsort((h, row))
    r, x = row[order], h[order]
    first = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (x[1:] != x[:-1])))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, r[first], np.diff(np.append(first, len(r))))
    return np.bincount(r[first], minlength=n), top


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of numbers for each text."""
    n = len(off) - 1
    size = np.diff(off)
    kind = _CLASS[data]
    by = np.bincount(np.repeat(np.arange(n), size) * 10 + kind, minlength=n * 10).reshape(n, 10)
    lower, upper, digit, stop, bar, wide, symbol, blank, lines, bang = by.T
    h, row, start, end = c.words(data, off)
    words = np.bincount(row, minlength=n)
    kinds, top = _distinct(row, h, n)
    pair = h[1:][row[1:] == row[:-1]] * c.U(3) + h[:-1][row[1:] == row[:-1]]
    pairs, _ = _distinct(row[1:][row[1:] == row[:-1]], pair, n)
    lh, lrow, _, _ = c.words(data, off, space=_LINE)
    line_kinds, _ = _distinct(lrow, lh, n)
    line_n = np.bincount(lrow, minlength=n)
    length = end - start
    marked = np.bincount(row, np.isin(kind[end - 1], (4, 6, 9)) if len(end) else None, minlength=n)
    long_ = np.bincount(row, length > 18, minlength=n)
    capital = np.bincount(row, kind[start] == 1 if len(start) else None, minlength=n)
    letters, w, b = np.maximum(lower + upper + wide, 1), np.maximum(words, 1), np.maximum(size, 1)
    return np.column_stack(
        [np.log1p(size), np.log1p(words), np.bincount(row, length, minlength=n) / w, upper / letters, digit / b, stop / b, symbol / b, bar / b, wide / letters, blank / b,
         kinds / w, top / w, line_kinds / np.maximum(line_n, 1), words / np.maximum(line_n, 1), long_ / w, marked / w, capital / w, pairs / np.maximum(words - 1, 1), np.log1p(lines), bang / b]
    )


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x array<double>) of every text, stored."""

    def run(batches):
        for batch in batches:
            data, off = c.strings(batch.column("text"))
            parts = [features(data[off[i] : off[j]], off[i : j + 1] - off[i]) for i, j in c.pieces(off)] or [np.zeros((0, len(NAMES)))]
            x = np.concatenate(parts)
            at = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(at, pa.array(x.ravel()))], names=["doc_id", "x"])

    return c.table(c.id_text(docs, id_col, text_col).transform(c.mapped, run, "doc_id long, x array<double>"), "features")


def _cuts(g: np.ndarray, h: np.ndarray, leaves: int = 3) -> np.ndarray:
    """Step of each bin from a tree of up to `leaves` leaves over one feature's gradient and curvature by bin."""
    spans, gain = [(0, len(g))], lambda a, b: a * a / (b + 1.0)
    while len(spans) < leaves:
        best = (1e-6, None, None)
        for k, (lo, hi) in enumerate(spans):
            if hi - lo < 2:
                continue
            ga, ha = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
            got = gain(ga[:-1], ha[:-1]) + gain(ga[-1] - ga[:-1], ha[-1] - ha[:-1]) - gain(ga[-1], ha[-1])
            at = int(np.argmax(got))
            if got[at] > best[0]:
                best = (got[at], k, lo + at + 1)
        if best[1] is None:
            break
        lo, hi = spans.pop(best[1])
        spans += [(lo, best[2]), (best[2], hi)]
    out = np.zeros(len(g))
    for lo, hi in spans:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + 1.0)
    return out


def _corner(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best tree with one cut on each of two features over a grid: gain and the step of each cell."""
    ga, ha = np.cumsum(np.cumsum(g, 0), 1), np.cumsum(np.cumsum(h, 0), 1)
    gain = lambda a, b: a * a / (b + 1.0)
    a, b = ga[:-1, :-1], ha[:-1, :-1]
    parts = [(a, b), (ga[:-1, -1:] - a, ha[:-1, -1:] - b), (ga[-1:, :-1] - a, ha[-1:, :-1] - b), (ga[-1, -1] - ga[:-1, -1:] - ga[-1:, :-1] + a, ha[-1, -1] - ha[:-1, -1:] - ha[-1:, :-1] + b)]
    got = sum(gain(*p) for p in parts) - gain(ga[-1, -1], ha[-1, -1])
    i, j = np.unravel_index(int(np.argmax(got)), got.shape)
    step = np.zeros_like(g)
    for k, (p, q) in enumerate(parts):
        step[slice(0, i + 1) if k in (0, 1) else slice(i + 1, None), slice(0, j + 1) if k in (0, 2) else slice(j + 1, None)] = p[i, j] / (q[i, j] + 1.0)
    return float(got[i, j]), step


def fit(x: np.ndarray, y: np.ndarray, cycles: int = CYCLES, rate: float = 0.1) -> dict:
    """Edges, one table per feature, tables of the chosen pairs, and the intercept."""
    k = x.shape[1] if len(x) else len(NAMES)
    if not len(y):
        return {"base": 0.0, "edges": [np.zeros(0)] * k, "tables": np.zeros((k, BINS)), "pairs": []}
    edges = [np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1)[1:-1])) for col in x.T]
    bins = np.column_stack([np.searchsorted(e, col, "right") for e, col in zip(edges, x.T, strict=True)])
    mean = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(mean / (1 - mean)))
    tables, f = np.zeros((k, BINS)), np.full(len(y), base)

    def push():
        p = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(cycles):
        for j in range(k):
            g, h = push()
            step = rate * _cuts(np.bincount(bins[:, j], g, BINS), np.bincount(bins[:, j], h, BINS))
            tables[j] += step
            f += step[bins[:, j]]
    coarse = bins * GRID // BINS
    cell = lambda a, b: coarse[:, a] * GRID + coarse[:, b]
    g, h = push()
    ranked = sorted(((_corner(np.bincount(cell(a, b), g, GRID * GRID).reshape(GRID, GRID), np.bincount(cell(a, b), h, GRID * GRID).reshape(GRID, GRID))[0], a, b) for a in range(k) for b in range(a)), reverse=True)[:PAIRS]
    pairs = [[a, b, np.zeros((GRID, GRID))] for _, a, b in ranked]
    for _ in range(cycles // 4):
        for a, b, t in pairs:
            g, h = push()
            at = cell(a, b)
            step = rate * _corner(np.bincount(at, g, GRID * GRID).reshape(GRID, GRID), np.bincount(at, h, GRID * GRID).reshape(GRID, GRID))[1]
            t += step
            f += step.ravel()[at]
    return {"base": base, "edges": edges, "tables": tables, "pairs": pairs}


def score(model: dict, x: np.ndarray) -> np.ndarray:
    bins = np.column_stack([np.searchsorted(e, col, "right") for e, col in zip(model["edges"], x.T, strict=True)])
    f = np.full(len(x), model["base"])
    for j, t in enumerate(model["tables"]):
        f += t[bins[:, j]]
    coarse = bins * GRID // BINS
    for a, b, t in model["pairs"]:
        f += t[coarse[:, a], coarse[:, b]]
    return 1 / (1 + np.exp(-np.clip(f, -30, 30)))


def learn(described_: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", sample: int = SAMPLE) -> dict:
    """Model from at most about `sample` labelled rows, chosen by a hash of the id."""
    marks = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("y"))
    n = max(1, marks.count())
    marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(min(1.0, sample / n) * (1 << 20)) + 1)
    rows = described_.join(marks, "doc_id").select("doc_id", "x", "y").toPandas().sort_values("doc_id")
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(NAMES))
    return fit(x, rows["y"].to_numpy(float))


def scored(described_: DataFrame, model: dict) -> DataFrame:
    shared = described_.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            x = b.column("x").flatten().to_numpy().reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score(shared.value, x))], names=["doc_id", "score"])

    return described_.transform(c.mapped, run, "doc_id long, score double")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = described(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(c.fold_bucket("doc_id", 3) != 1)
    out = scored(x, learn(x, labels))
    return out.select("doc_id", (c.fold_bucket("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
