"""The registered queries, column by column, against brute force on a small folder of tables with odd rows."""

import collections
import hashlib
import io
import math
import re
import wave
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import chroma, common, language_id, packing, pii, quality, registry

from test_llm import SCHEMA, brute_classes, brute_removed, words


@pytest.fixture(scope="module")
def tables(spark, sf, tmp_path_factory):
    """Rows of documents, and the folder that has them: nulls, empty and long texts, repeated rows and ids, rows without an id, further columns."""
    some = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 80").orderBy("doc_id").collect()]
    long_ = " ".join(f"w{i * 7919 % 5000}" for i in range(15000))
    some += [
        (900, None, None), (901, "", "en"), (902, " \n", None), (903, "123 456", "de"), (904, long_, "en"), (905, long_ + " tail", None), (906, "one two three", "en"), (907, "one two three", "en"), (907, "one two three", "en"),
        (908, some[5][1], "en"), (908, some[6][1] + " end", "fr"), (None, some[7][1], "en"), (None, None, None), (909, "x" * 3000, None), (910, "<|endoftext|> and <|endoftext|>", "en"), (911, "日本語 😀 ▁ text", None),
        (912, "mail a.b@c-d.org, call 555 123 4567, +1 (555) 123-4567, 4111 1111 1111 1111, 10.0.0.256 10.0.0.1", "en"),
    ]
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame([(i, t, g, "s", len(t or "")) for i, t, g in some], SCHEMA)
    docs.withColumn("h", F.lit(1)).withColumn("key", F.lit("k")).withColumn("score", F.lit("x")).withColumn("n", F.lit(0.5)).repartition(3).write.parquet(f"{folder}/documents.parquet")
    marks = [(i, i % 2, 0) for i in range(0, 80)] + [(3, None, 0), (None, 1, 1), (4, 1, 0), (906, 1, 0)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    rng = np.random.default_rng(1)
    vec = [(i, rng.normal(size=48).tolist()) for i in range(41)] + [(100, None), (120, []), (140, [0.0] * 48), (None, [1.0] * 48)]
    vec[20] = (20, vec[3][1])
    spark.createDataFrame(vec, "vec_id long, embedding array<double>").write.parquet(f"{folder}/embeddings.parquet")
    return folder, [(i, t, g) for i, t, g in some if i is not None], vec


def run(spark, name, folder):
    return [r.asDict(recursive=True) for r in registry.QUERIES[name](spark, folder).collect()]


def bucket(i, mod):
    return zlib.crc32(str(i).encode()) % mod


def plain_features(text):
    raw = text.encode()
    kind = [int(quality._CLASS[b]) for b in raw]
    of = lambda k: kind.count(k)
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
    w = [x for x in re.split(rb"[\x20\x09-\x0D]+", low) if x]
    spans = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
    lines = [x for x in low.split(b"\n") if x]
    letters, n, size = max(of(0) + of(1) + of(5), 1), max(len(w), 1), max(len(raw), 1)
    return [
        math.log1p(len(raw)), math.log1p(len(w)), sum(map(len, w)) / n, of(1) / letters, of(2) / size, of(3) / size, of(6) / size, of(4) / size, of(5) / letters, of(7) / size,
        len(set(w)) / n, max(collections.Counter(w).values(), default=0) / n, len(set(lines)) / max(len(lines), 1), len(w) / max(len(lines), 1), sum(len(x) > 18 for x in w) / n, sum(kind[b - 1] in (4, 6, 9) for _, b in spans) / n,
        sum(kind[a] == 1 for a, _ in spans) / n, len(set(zip(w, w[1:]))) / max(len(w) - 1, 1), math.log1p(of(8)), of(9) / size,
    ]


def test_op1(spark, tables):
    """Scores are sums of table look-ups by bin over features counted one text at a time; held-out labels change nothing."""
    folder, rows, _ = tables
    got = run(spark, "op1_quality", folder)
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.learn(quality.described(docs), labels.where(common.fold_bucket("doc_id", 3) != 1))
    want = []
    for i, t, _ in rows:
        x, f = plain_features(t or ""), model["base"]
        bins = [int(np.searchsorted(e, v, "right")) for e, v in zip(model["edges"], x, strict=True)]
        f += sum(model["tables"][j][b] for j, b in enumerate(bins))
        f += sum(t2[bins[a] * quality.GRID // quality.BINS][bins[b] * quality.GRID // quality.BINS] for a, b, t2 in model["pairs"])
        want.append((i, bucket(i, 3) == 1, 1 / (1 + math.exp(-f))))
    key = lambda r: (r[0], round(r[2], 9))
    assert len(got) == len(want)
    for r, (i, held, score) in zip(sorted(((r["doc_id"], r["held_out"], r["score"], r["predicted"]) for r in got), key=key), sorted(want, key=key), strict=True):
        assert r[:2] == (i, held) and math.isclose(r[2], score, rel_tol=1e-7) and r[3] == int(r[2] >= 0.5)
    flipped = quality.learn(quality.described(docs.drop("lang", "source")), labels.withColumn("quality", F.when(common.fold_bucket("doc_id", 3) == 1, 1 - F.col("quality")).otherwise(F.col("quality"))).where(common.fold_bucket("doc_id", 3) != 1))
    assert all((a == b).all() for a, b in zip(model["tables"], flipped["tables"], strict=True))


def test_op3(spark, tables):
    folder, rows, _ = tables
    patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")

    def good(k, x):
        d = re.sub("[^0-9]", "", x)
        return True if k == 0 else all(int(p) <= 255 for p in x.split(".")) if k == 1 else 13 <= len(d) <= 19 and pii.luhn(d) if k == 2 else 9 <= len(d) <= 15

    got, want = run(spark, "op3_pii", folder), []
    for i, t, _ in rows:
        base = [(k, m.start(), m.end()) for k in range(4) for m in re.finditer(patterns[k], t or "") if good(k, m[0])]
        text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
        want.append((i, *(sum(k == x for k, _, _ in base) for x in range(4)), hashlib.sha256(text.encode()).hexdigest(), text))
    assert sorted((r["doc_id"], *(r[f"n_{k}"] for k in pii.KINDS), r["base_sha256"]) for r in got) == sorted(w[:-1] for w in want)
    by = {w[0]: w[-1] for w in want if w[0] != 908}
    for r in got:
        spans = [x.split(":") for x in r["spans"].split(",") if x]
        assert spans == sorted(spans, key=lambda x: (pii.KINDS.index(x[0]), int(x[1])))
        assert r["doc_id"] == 908 or set(filter(None, by[r["doc_id"]].split(","))) <= set(r["spans"].split(","))


def test_op5(spark, tables):
    from tokenizers import Tokenizer

    folder, _, _ = tables
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert any(i is None for i, _ in rows)
    tok = Tokenizer.from_file(packing.default_tokenizer())
    ids = [(i, np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], np.uint32)) for i, t in rows]
    want = []
    for i, x in ids:
        cuts = [0, *range((len(x) - 1) % 1024 + 1, len(x) + 1, 1024)]
        want += [(i, k, a, b - a, zlib.crc32(x[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    got, by = run(spark, "op5_packing", folder), collections.defaultdict(list)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in by.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024
    counts = np.bincount([w[3] for w in want], minlength=1025)
    assert len(by) == sum(n for n, _ in packing.plan(counts, 1024)) and packing.bound(counts, 1024) <= len(by)


def test_op6(spark, tables):
    folder, rows, _ = tables
    raw = [(t or "").encode() for _, t, _ in rows]
    want = [(i, len(b), n, m, hashlib.sha256(kept).hexdigest()) for (i, _, _), b, (kept, n, m) in zip(rows, raw, brute_removed(raw), strict=True)]
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in run(spark, "op6_suffix_dedup", folder)) == sorted(want)


def test_op8(spark, tables):
    folder, rows, _ = tables
    named = [(k, t) for k, (_, t, _) in enumerate(rows)]  # rows apart, then the smallest id of each class
    found = brute_classes(named)
    least = collections.defaultdict(lambda: 1 << 62)
    for k, (i, _, _) in enumerate(rows):
        least[found[k][1]] = min(least[found[k][1]], i)
    want = sorted((i, found[k][0], least[found[k][1]]) for k, (i, _, _) in enumerate(rows))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in run(spark, "op8_jaccard_join", folder)) == want


def test_op10(spark, tables):
    """Phrases counted by looking for ever longer strings in the samples."""
    folder, rows, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    samples = {r["lang"]: language_id.joined(r["texts"], language_id.BYTES) for r in language_id.samples(docs.where(common.fold_bucket("doc_id", 4) != 2)).collect()}
    assert set(samples) <= {g for i, _, g in rows if g and bucket(i, 4) != 2}

    def phrases(sample, word):
        at = n = 0
        while at < len(word):
            k = 1
            while at + k < len(word) + 1 and word[at : at + k] in sample:
                k += 1
            at, n = at + max(1, k - 1), n + 1
        return n

    memo: dict = {}
    got = collections.defaultdict(list)
    for r in run(spark, "op10_language_id", folder):
        got[r["doc_id"]].append((r["held_out"], r["lang_pred"], round(r["score"], 9)))
    want = collections.defaultdict(list)
    for i, t, _ in rows:
        found = [x for x in re.split(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]+", (t or "").lower().encode()) if x]
        if not re.search(r"[^\W\d_]", t or ""):
            want[i].append((bucket(i, 4) == 2, "und", 0.0))
            continue
        size, per = sum(len(x) + 1 for x in found), []
        for g in sorted(samples):
            for x in found:
                if (g, x) not in memo:
                    memo[g, x] = phrases(samples[g], b" " + x + b" ")
            per.append(sum(memo[g, x] for x in found) / size)
        order = np.argsort(per, kind="stable")
        want[i].append((bucket(i, 4) == 2, sorted(samples)[order[0]], round(min(max(1 - per[order[0]] / max(per[order[1]], 1e-9), 0), 1), 9)))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_op2_and_op9(spark, tables):
    """Nearest codes by comparing all; alignments by counting every pair of equal integers."""
    folder, _, vec = tables
    code = {i: np.nan_to_num(np.array(v)) > 0 for i, v in vec if i is not None and v}
    want = [(q, k + 1, i, d) for q in code if q % 20 == 0 for k, (d, i) in enumerate(sorted((int((code[q] != b).sum()), i) for i, b in code.items())[:10])]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["distance"]) for r in run(spark, "op2_hamming_topk", folder)) == sorted(want)

    prints = {i: chroma.fingerprint(*chroma.pcm(chroma.tune(np.array(v)))) for i, v in vec if i is not None and v}
    asked = {i: chroma.fingerprint(*chroma.pcm(chroma.tune(np.array(v), 8 + i % 16, 32, i))) for i, v in vec if i is not None and i % 20 == 0 and v}
    classes = collections.defaultdict(list)
    for i, p in prints.items():
        if len(p):
            classes[p.tobytes()].append(i)
    want = []
    for q, x in asked.items():
        for same in classes.values():
            y = prints[same[0]]
            votes = collections.Counter(s - t for t, a in enumerate(x) for s, b in enumerate(y) if a == b and a != chroma._flat())
            n, o = max(((n, -o) for o, n in votes.items()), default=(0, 0))
            lo, hi = max(0, o), min(len(x), len(y) + o)
            error = sum(int(a ^ b).bit_count() for a, b in zip(x[lo:hi].tolist(), y[lo - o : hi - o].tolist(), strict=True)) / (32 * max(1, hi - lo))
            if n >= chroma.VOTES and hi - lo >= chroma.OVERLAP and error <= chroma.ERROR:
                want.append((q, min(same), len(same), -o, n, hi - lo, round(error, 9)))
    got = [(r["query_id"], r["class_id"], r["members"], r["offset"], r["votes"], r["overlap"], round(r["bit_error"], 9)) for r in run(spark, "op9_chroma", folder)]
    assert sorted(got) == sorted(want) and want


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_queries_equal_their_sql(spark, sf, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.sql(registry.ORACLES[name])
    got = registry.QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(tuple(r[c] for c in want.columns) for r in got.collect()) == sorted(want.fetchall())


def test_pipeline(spark, tables):
    """The whole pipeline against its stages done plainly: letters, one of each class of near copies, repeats cut, spans masked, pieces cut and laid."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    folder, _, _ = tables
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = [(i, t) for i, t in rows if t and re.search(r"[^\W\d_]", t)]
    found, groups = brute_classes(list(enumerate(t for _, t in rows))), collections.defaultdict(list)
    for k, (i, t) in enumerate(rows):
        groups[found[k][1]].append((i is None, i or 0, hashlib.sha256(t.encode()).hexdigest(), k))
    rows = [rows[min(g)[-1]] for g in groups.values()]
    rows = [(i, kept.decode("utf-8", "ignore")) for (i, _), (kept, _, _) in zip(rows, brute_removed([t.encode() for _, t in rows]), strict=True)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    w = pii.train(common.table(pii.found(df), "spans"))
    rows = [(i, pii.mask(t, [(s, e, k) for k, s, e, _ in pii.chosen(pii.candidates(t), w, pii.ACCEPT)])) for i, t in rows]
    tok, want = Tokenizer.from_file(packing.default_tokenizer()), []
    for i, t in rows:
        x = np.array([*tok.encode(t, add_special_tokens=False).ids, 2], np.uint32)
        cuts = [0, *range((len(x) - 1) % 1024 + 1, len(x) + 1, 1024)]
        want += [(i, k, a, b - a, zlib.crc32(x[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    got, by = [r.asDict() for r in corpus_pipeline.run(spark, folder).collect()], collections.defaultdict(list)
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    assert all(sum(n for _, n in s) <= 1024 and all(o == sum(n for q, n in s if q < o) for o, _ in s) for s in by.values())


def test_wav_sample_widths_and_silence():
    t = np.arange(4096) / 2048
    x = 0.5 * np.sin(2 * np.pi * 440 * t)

    def wav(width, data):
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(1)
            w.setsampwidth(width)
            w.setframerate(2048)
            w.writeframes(data)
        return out.getvalue()

    forms = {1: np.round(x * 128 + 128).astype("u1").tobytes(), 2: (x * 32767).astype("<i2").tobytes(), 3: b"".join(int(v * 8388607).to_bytes(3, "little", signed=True) for v in x), 4: (x * 2147483647).astype("<i4").tobytes()}
    for width, data in forms.items():
        got, rate = chroma.pcm(wav(width, data))
        assert rate == 2048 and len(got) == 4096 and np.abs(got - x).max() < 0.01
    assert (chroma.fingerprint(np.zeros(4096), 2048) == chroma._flat()).all()


def test_rectangles_are_those_of_plain_sums():
    x = chroma.pcm(chroma.tune(np.random.default_rng(2).normal(size=24)))[0]
    frames, got = chroma.chroma(x, chroma.RATE), chroma.fingerprint(x, chroma.RATE)
    for t in (0, 3, len(got) - 1):
        out = 0
        box = lambda a, b, lo, hi, t=t: sum(frames[t + f][p % 12] for f in range(a, b) for p in range(lo, hi))
        for k, lo, high, width in chroma.filters():
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
            r = math.log((1 + p) / (1 + q))
            level = (r > -0.15) + (r > 0) + (r > 0.15)
            out = out << 2 | (level ^ level >> 1)
        assert out == got[t]


@pytest.mark.parametrize("name", [*sorted(registry.QUERIES), "pipeline"])
def test_empty_tables(spark, tmp_path_factory, name):
    """Tables without rows give no rows; tables of nulls alone give what their ids are worth."""
    import corpus_pipeline

    run = corpus_pipeline.run if name == "pipeline" else registry.QUERIES[name]
    for rows, expect in (([], 0), ([(None, None, None, None, None), (1, None, None, None, None)], 1)):
        folder = str(tmp_path_factory.mktemp("empty"))
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([r[:3] for r in rows], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([r[:2] for r in rows], "vec_id long, embedding array<double>").write.parquet(f"{folder}/embeddings.parquet")
        spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
        spark.createDataFrame([r[:4] for r in rows], "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
        every = ("op5_packing", "op12_main_text", "op13_turns")  # rows without an id count there
        assert run(spark, folder).count() == (0 if name in ("pipeline", "op2_hamming_topk", "op9_chroma", "op11_centroids") else len(rows) if name in every else expect)


def test_words_of_the_shared_rule():
    assert words("A b\tC\x0bd") == ["a", "b", "c", "d"]
