"""Chroma fingerprints of audio columns, and the alignment of recordings.

Method: short-time spectra are folded into twelve pitch classes; an integral image over the frames gives any
rectangle's energy in four look-ups, and a bank of sixteen two-part filters compares rectangles, each ratio
quantised to two Gray-coded bits, so every frame has a packed 32-bit integer.  Recordings are aligned by
votes: equal integers of a query and a recording vote for their offset, the fullest bin of the histogram is the
alignment, and the share of unequal bits over the overlap accepts or rejects it.

A held tone gives one integer for many frames: it is one row with its length, and two such runs give their votes by
offset, not by pairs of frames.  Frames of silence have no pitch and do not vote.  Recordings with equal fingerprints
are one class, found by a digest, so a recording that a third of the rows copy is searched once; matches name the
class by its smallest id with its number of members.

Cases: null, empty and undecodable audio, and audio too short for one integer, has no fingerprint and matches nothing;
samples of one (unsigned), two, three and four bytes are read, other widths are undecodable; several channels are
averaged; ties between offsets go to the smallest; repeated ids count once, rows without an id are left out; other columns
may have any name.
"""

from __future__ import annotations

import io
import wave

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

FRAME_S, HOP_S = 0.25, 1 / 32
VOTES, ERROR, OVERLAP = 3, 0.3, 16
SPAN = 16  # frames that one integer sees


def filters() -> list[tuple[int, int, int, int]]:
    """(kind, first class, classes, frames) of the bank, by rule: halves by pitch, by time, both, and the middle against the sides."""
    return [(i % 4, (5 * i) % 12, 2 + 2 * (i % 3), SPAN // (1 + (i // 4) % 2)) for i in range(16)]


def pcm(data: bytes | None) -> tuple[np.ndarray, int]:
    """Samples (-1 to 1) and rate of a WAV."""
    try:
        with wave.open(io.BytesIO(data or b"")) as w:
            raw, width = w.readframes(w.getnframes()), w.getsampwidth()
            raw = np.frombuffer(raw[: len(raw) // width * width], np.uint8).reshape(-1, width)
            if width == 1:
                x = raw[:, 0] / 128 - 1
            elif width <= 4:  # little-endian, widened to four bytes
                x = np.pad(raw, ((0, 0), (4 - width, 0))).view("<i4")[:, 0] / 2**31
            else:
                return np.zeros(0), 1
            return x[: len(x) // w.getnchannels() * w.getnchannels()].reshape(-1, w.getnchannels()).mean(axis=1), w.getframerate()
    except (wave.Error, EOFError, ValueError, ZeroDivisionError):
        return np.zeros(0), 1


def chroma(x: np.ndarray, rate: int) -> np.ndarray:
    """Pitch-class energies of each frame, scaled to a unit vector."""
    size, hop = int(FRAME_S * rate), max(1, int(HOP_S * rate))
    if size < 8 or len(x) < size:
        return np.zeros((0, 12))
    frames = np.lib.stride_tricks.sliding_window_view(x, size)[::hop]
    freq = np.fft.rfftfreq(size, 1 / rate)
    use = (freq > 60) & (freq < 3600)
    kind = np.round(12 * np.log2(np.maximum(freq, 1) / 440)).astype(int) % 12
    fold = np.zeros((len(freq), 12))
    fold[np.flatnonzero(use), kind[use]] = 1
    out = np.concatenate([np.abs(np.fft.rfft(frames[i : i + 2048] * np.hanning(size), axis=1)) ** 2 @ fold for i in range(0, len(frames), 2048)])
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def fingerprint(x: np.ndarray, rate: int) -> np.ndarray:
    """A 32-bit integer for each frame that SPAN frames start at."""
    frames = chroma(x, rate)
    n = len(frames) - SPAN + 1
    if n < 1:
        return np.zeros(0, np.int64)
    ring = np.concatenate([frames, frames], axis=1)  # pitch classes go round
    area = np.zeros((len(ring) + 1, 25))
    area[1:, 1:] = ring.cumsum(axis=0).cumsum(axis=1)
    t = np.arange(n)

    def box(a, b, lo, hi):
        return area[t + b, hi] - area[t + a, hi] - area[t + b, lo] + area[t + a, lo]

    out = np.zeros(n, np.int64)
    for k, lo, high, width in filters():
        hi, mid, half = lo + high, lo + high // 2, width // 2
        if k == 0:
            p, q = box(0, width, lo, mid), box(0, width, mid, hi)
        elif k == 1:
            p, q = box(0, half, lo, hi), box(half, width, lo, hi)
        elif k == 2:
            p, q = box(0, half, lo, mid) + box(half, width, mid, hi), box(0, half, mid, hi) + box(half, width, lo, mid)
        else:
            q = box(width // 4, width - width // 4, lo, hi)
            p = box(0, width, lo, hi) - q
        r = np.log((1 + p) / (1 + q))
        level = (r > -0.15).astype(np.int64) + (r > 0) + (r > 0.15)
        out = out << 2 | (level ^ level >> 1)
    return out


def fingerprints(media: DataFrame, id_col: str = "media_id", audio_col: str = "audio") -> DataFrame:
    """(id, fp array<long>) of each recording that has a fingerprint."""

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                prints = [fingerprint(*pcm(x)) for x in part.column("audio").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(prints, pa.list_(pa.int64()))], names=["id", "fp"])

    rows = media.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(audio_col).alias("audio"))
    return rows.transform(c.mapped, run, "id long, fp array<long>").where(F.size("fp") > 0)


def _flat() -> int:
    """The integer of frames without energy, in which all rectangles are equal."""
    return sum(1 << 2 * k for k in range(len(filters())))


def runs(rows: DataFrame) -> DataFrame:
    """(id, x, at, n): each integer of fingerprints (id, fp) with its place and how often it follows itself; silence is left out."""

    def run(batches):
        for b in batches:
            lists = b.column("fp")
            x, off = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
            off = off - off[0]
            new = np.append(True, x[1:] != x[:-1]) if len(x) else np.zeros(0, bool)
            new[off[:-1][np.diff(off) > 0]] = True
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(x)))
            row = np.searchsorted(off, at, "right") - 1
            keep = x[at] != _flat()
            row, at, n = row[keep], at[keep], n[keep]
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(row)), pa.array(x[at]), pa.array((at - off[row]).astype(np.int32)), pa.array(n.astype(np.int32))], names=["id", "x", "at", "n"])

    return rows.select("id", "fp").transform(c.mapped, run, "id long, x long, at int, n int")


def _judged(batches):
    """Bit error at the voted offset: (query, rec, offset, votes, q array, r array) to matches."""
    for b in batches:
        error, overlap = [], []
        for o, q, r in zip(b.column("offset").to_pylist(), b.column("q").to_pylist(), b.column("r").to_pylist(), strict=True):
            lo, hi = max(0, -o), min(len(q), len(r) - o)
            x, y = np.array(q[lo:hi], np.int64), np.array(r[lo + o : hi + o], np.int64)
            overlap.append(len(x))
            error.append(float(np.bitwise_count(x ^ y).sum()) / (32 * max(1, len(x))))
        yield pa.RecordBatch.from_arrays([*(b.column(k) for k in ("query_id", "class_id", "members", "offset", "votes")), pa.array(overlap, pa.int64()), pa.array(error, pa.float64())], names=["query_id", "class_id", "members", "offset", "votes", "overlap", "bit_error"])


def align(queries: DataFrame, recordings: DataFrame) -> DataFrame:
    """(query_id, class_id, members, offset, votes, overlap, bit_error) of the recordings (id, fp) that queries (id, fp) are found in."""
    digest = F.sha2(F.array_join("fp", ","), 256)
    known = recordings.withColumn("digest", digest)
    classes = known.groupBy("digest").agg(F.min("id").alias("class_id"), F.countDistinct("id").alias("members"))
    reps = c.table(classes.join(known.dropDuplicates(["digest"]).select("digest", "fp"), "digest").select("class_id", "members", "fp"), "classes")
    asked = queries.dropDuplicates(["id"])
    left = runs(asked).select(F.col("id").alias("query_id"), "x", F.col("at").alias("t"), F.col("n").alias("a"))
    right = runs(reps.select(F.col("class_id").alias("id"), "fp")).select(F.col("id").alias("class_id"), "x", F.col("at").alias("s"), F.col("n").alias("b"))
    # two runs of a and b frames have min(a, b - d) - max(0, -d) pairs that are d further apart than their starts
    each = left.join(right, "x").select("query_id", "class_id", (F.col("s") - F.col("t")).alias("apart"), "a", "b", F.explode(F.sequence(1 - F.col("a"), F.col("b") - 1)).alias("d"))
    count = F.least(F.col("a"), F.col("b") - F.col("d")) - F.greatest(F.lit(0), -F.col("d"))
    votes = each.groupBy("query_id", "class_id", (F.col("apart") + F.col("d")).alias("offset")).agg(F.sum(count).alias("votes")).where(F.col("votes") >= VOTES)
    best = votes.groupBy("query_id", "class_id").agg(F.max(F.struct("votes", (-F.col("offset")).alias("o"))).alias("b")).select("query_id", "class_id", F.col("b.votes").alias("votes"), (-F.col("b.o")).alias("offset"))
    pairs = best.join(asked.select(F.col("id").alias("query_id"), F.col("fp").alias("q")), "query_id").join(reps.withColumnRenamed("fp", "r"), "class_id")
    out = pairs.transform(c.mapped, _judged, "query_id long, class_id long, members long, offset int, votes long, overlap long, bit_error double")
    return out.where((F.col("overlap") >= OVERLAP) & (F.col("bit_error") <= ERROR))


RATE = 2048


def tune(vector: np.ndarray, first: int = 0, notes: int | None = None, noise: int | None = None) -> bytes:
    """A WAV with one tone for each component: the tables hold no audio, so recordings are played from vectors."""
    step = RATE // 16
    pitch = np.floor(np.abs(np.nan_to_num(vector)) * 997).astype(int) % 12
    t = np.arange(step) / RATE
    tones = np.sin(2 * np.pi * 220 * 2 ** (np.arange(12) / 12)[:, None] * t) * np.hanning(step)
    x = tones[pitch[first : None if notes is None else first + notes]].ravel() * 0.8
    if noise is not None:
        x = 0.5 * x + np.random.default_rng(noise).normal(0, 0.01, len(x))
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(RATE)
        w.writeframes((np.clip(x, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def played(vectors: DataFrame, excerpt: bool) -> DataFrame:
    """(media_id, audio): each vector's tune, or a quieter, noisy excerpt of it that starts 8 to 23 tones in."""

    def run(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                ids = part.column("vec_id").to_pylist()
                audio = [tune(np.array(v or [], float), *((8 + k % 16, 32, k) if excerpt else ())) for k, v in zip(ids, part.column("embedding").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(audio, pa.binary())], names=["media_id", "audio"])

    return vectors.select("vec_id", "embedding").transform(c.mapped, run, "media_id long, audio binary")


def op9_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Excerpts of every recording whose id is divisible by 20, found among all recordings."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    recordings = c.table(fingerprints(played(vectors, False)), "recordings")
    queries = c.table(fingerprints(played(vectors.where("vec_id % 20 = 0"), True)), "queries")
    return align(queries, recordings)
