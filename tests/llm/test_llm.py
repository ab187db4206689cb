"""Each operator against brute force on a small table with nulls, empty and long texts, copies, ties and odd columns."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.llm import chroma, common, hamming, jaccard_join, language_id, ngram_lm, packing, pieces, pii, quality, registry, suffix_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows(spark, sf):
    some = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60").orderBy("doc_id").collect()]
    long_ = " ".join(f"w{i * 7919 % 5000}" for i in range(30000))
    more = [
        (1000, None, None, None, None), (1001, "", "en", "a", 0), (1002, " \n\t ", None, "a", 4), (1003, "one two", "en", "b", 7), (1004, "one two", "en", "b", 7), (1005, "ONE two", "de", None, 7),
        (1006, long_, "en", "hot", 1), (1007, long_ + " tail", "en", "hot", 1), (1008, "x" * 900, None, "hot", 900), (1009, "ab" * 300 + "é" + "ab" * 300, "fr", "hot", 1),
        (1010, "mail a.b@c-d.example.org, +1 (555) 123-4567, 4111 1111 1111 1111, 10.0.0.256 10.0.0.1 @@ +1 1.2.3.4.5.6.7.8", "en", "p", 1), (1011, "日本語 😀 ▁ text", "ja", None, 1), (1012, "it's a_b <|endoftext|> x² don't", "en", None, 1),
    ]
    base = some[3][1]
    return some + more + [(1013, base + " one more word", "en", "hot", 1), (1014, base + " another", "en", "hot", 1)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    # columns whose names operators use inside
    return spark.createDataFrame(rows, SCHEMA).withColumn("h", F.lit(1)).withColumn("score", F.lit("s")).withColumn("spans", F.lit(None).cast("int"))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def texts(rows):
    return {r[0]: r[1] or "" for r in rows}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def brute_removed(raw):
    """(kept, removed, spans) of each of some texts, given as bytes."""
    count = collections.Counter(b[k : k + 200] for b in raw for k in range(len(b) - 199))
    out = []
    for b in raw:
        cover = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            if count[b[k : k + 200]] > 1:
                cover[k : k + 200] = True
        out.append((np.frombuffer(b, np.uint8)[~cover].tobytes(), int(cover.sum()), int((np.diff(np.append(0, cover.astype(int))) > 0).sum())))
    return out


def check_removed(df, rows):
    raw = [(t or "").encode() for _, t in rows]
    want = sorted((i, len(b), n, m, hashlib.sha256(kept).hexdigest()) for (i, _), b, (kept, n, m) in zip(rows, raw, brute_removed(raw), strict=True) if i is not None)
    assert sorted(tuple(r) for r in suffix_dedup.removed(df).collect()) == want


@pytest.mark.parametrize("hot", [(2048, 32768), (2, 2)])
def test_suffix_dedup(spark, rows, docs, empty, monkeypatch, hot):
    """Names sorted whole, and dealt by window."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    check_removed(docs, [r[:2] for r in rows])
    assert suffix_dedup.removed(empty).count() == 0
    if hot[0] > 2:
        out = suffix_dedup.remove_repeats(docs)
        assert out.columns == docs.columns and out.count() == len(rows) and suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_dedup_repeated_ids_and_passages(spark):
    line = "a line that is found in many of the texts, of some length and without a meaning; " * 3
    some = [(i % 30, f"{i * 37 % 91} " * (i % 5) + line[i % 7 :] + str(i * 77) * (i % 4)) for i in range(60)] + [(1, None), (1, ""), (None, line), (40, line), (40, line)]
    check_removed(spark.createDataFrame(some, "doc_id long, text string").where("doc_id IS NOT NULL"), [r for r in some if r[0] is not None])


def test_suffix_dedup_repetitive_texts(spark):
    """Long runs of one byte and of short periods, alone and shared, beside windows that occur in them once."""
    some = [(0, "x" * 5000), (1, "start " + "x" * 700 + " end"), (2, "ab" * 400 + "c"), (3, "q" + "ab" * 101), (4, "abc" * 300), (5, "y" * 199), (6, "z" * 200), (7, "z" * 200 + "!"), (8, "w" * 201), (9, "0123456789" * 21)]
    check_removed(spark.createDataFrame(some, "doc_id long, text string"), some)
    data = np.frombuffer(b"x" * 300_000, np.uint8)
    assert sum(len(s[0]) for s in suffix_dedup._sample(data, 200, 32)) == 1


def test_induced_repeats_are_those_of_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(20):
        base = rng.integers(97, 99, 60, np.uint8)
        place, ctx = [], []
        for _ in range(30):
            left, right = int(rng.integers(0, 12)), int(rng.integers(12, 20))
            body = np.concatenate([base[20 - left : 20 + right]])
            body[rng.integers(0, len(body))] ^= int(rng.integers(0, 2))
            place.append(left)
            ctx.append(body)
        key, place = rng.integers(0, 2, 30), np.array(place)
        off = np.append(0, np.cumsum([len(x) for x in ctx]))
        n = np.diff(off) - 12 + 1
        got = suffix_dedup.repeats(key, np.concatenate(ctx), off, place, n, 12)
        seen = collections.Counter((key[r], j, ctx[r][place[r] - j : place[r] - j + 12].tobytes()) for r in range(30) for j in range(place[r] + 1) if place[r] - j < n[r])
        for r in range(30):
            for j in range(got.shape[1]):
                own = j <= place[r] and place[r] - j < n[r]
                assert got[r, j] == (own and seen[key[r], j, ctx[r][place[r] - j : place[r] - j + 12].tobytes()] > 1)


def brute_classes(rows):
    sets = {}
    for i, t in texts(rows).items():
        w = words(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    name = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(name[a], name[b])
            changed |= name[a] != m or name[b] != m
            name[a] = name[b] = m
    return {i: (len(s), name[i]) for i, s in sets.items()}


@pytest.mark.parametrize("tree, node, leaf, hot", [(1 << 22, 512, 64, 1 / 256), (0, 3, 1, 1e-9), (0, 512, 2, 1 / 256)])
def test_jaccard_join(spark, rows, docs, monkeypatch, tree, node, leaf, hot):
    """Clusters as trees, dealt by shingle, and by pairs of subtrees; with hot shingles and without."""
    base = words(texts(rows)[3])[:200]
    near = [(2000 + i, " ".join(w for k, w in enumerate(base) if (k * 31 + i * 17) % 67 > i % 3), None, None, 1) for i in range(20)]
    near += [(2100 + i, " ".join([*base[:60], *(f"v{i}x{k}" for k in range(i))]), None, None, 1) for i in range(1, 16)]
    for k, v in (("TREE", tree), ("NODE", node), ("HOT", hot)):
        monkeypatch.setattr(jaccard_join, k, v)
    monkeypatch.setattr(jaccard_join, "linked", lambda *a, f=jaccard_join.linked: f(*a, leaf))
    more = spark.createDataFrame([*near, (None, "a b c d e f", None, None, 1)], SCHEMA).select("doc_id", "text")
    got = jaccard_join.classes(docs.select("doc_id", "text").unionByName(more))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == brute_classes(rows + near)


def test_jaccard_join_without_leaders(spark, monkeypatch):
    """Chains of near copies of which no document is like all others, found by trees alone."""
    some = [(i, " ".join(f"w{k}" for k in range(4 * i, 4 * i + 100)), None, None, 1) for i in range(40)]
    some += [(100 + i, " ".join(f"w{k}" for k in range(6 * i, 6 * i + 50)), None, None, 1) for i in range(20)]
    monkeypatch.setattr(jaccard_join, "_leaders", lambda sets: spark.createDataFrame([], "a long, b long"))
    want = brute_classes(some)
    for tree, node in ((1 << 22, 512), (0, 4)):
        monkeypatch.setattr(jaccard_join, "TREE", tree)
        monkeypatch.setattr(jaccard_join, "NODE", node)
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.classes(spark.createDataFrame(some, SCHEMA)).collect()} == want


def test_jaccard_join_of_shared_lines(spark, monkeypatch):
    """Texts put together from shared lines: sets travel a few times, not once for each of their prefix shingles."""
    rng = np.random.default_rng(2)
    lines = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 40)) for _ in range(40)]
    some = [(i, "\n".join(lines[k] for k in rng.choice(40, 8, replace=False)), None, None, 1) for i in range(150)]
    some += [(500 + i, some[3 * i][1] + " and more", None, None, 1) for i in range(10)]
    sent = []

    def spied(df, run, schema, f=common.mapped):
        if run is jaccard_join._trees:
            df = common.table(df, "sent")
            sent.append(df.agg(F.sum(F.size("shingles"))).first()[0])
            df = df.repartition("tree", "part").sortWithinPartitions("tree", "part")
        return f(df, run, schema)

    monkeypatch.setattr(jaccard_join, "_leaders", lambda sets: spark.createDataFrame([], "a long, b long"))
    monkeypatch.setattr(common, "mapped", spied)
    want = brute_classes(some)
    total = sum(n for n, _ in want.values())
    for k in ("TREE", "NODE"):
        monkeypatch.setattr(jaccard_join, k, total // 2)
    got = jaccard_join.classes(spark.createDataFrame(some, SCHEMA)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert sent[0] <= 4 * total


def test_jaccard_join_repeated_ids(spark):
    t = {k: " ".join(f"{k}{i}" for i in range(30)) for k in "abc"}
    some = [(7, t["a"]), (7, t["a"]), (7, t["b"]), (9, t["b"] + " x"), (9, t["c"]), (3, None), (3, "")]
    got = sorted(tuple(r) for r in jaccard_join.classes(spark.createDataFrame(some, "doc_id long, text string")).collect())
    assert got == [(3, 0, 3), (3, 0, 3), (7, 26, 7), (7, 26, 7), (7, 26, 7), (9, 26, 9), (9, 27, 7)]


def test_node_bound_is_never_too_small():
    """Nodes are never cut while two of their members link."""
    rng = np.random.default_rng(5)
    for _ in range(30):
        base = np.unique(rng.integers(0, 1 << 63, 60).astype(np.uint64))
        sets = [np.sort(base[rng.random(len(base)) < rng.uniform(0.7, 1)]) for _ in range(12)]
        at = np.append(0, np.cumsum([len(s) for s in sets]))
        f = jaccard_join.Forest(np.arange(12), np.arange(12), np.concatenate(sets), at)
        x, y = jaccard_join.Node(f, np.arange(6), 2), jaccard_join.Node(f, np.arange(6, 12), 2)
        link = lambda a, b: 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b]))
        for p in (x, *x.kids):
            for q in (y, *y.kids):
                assert jaccard_join.may_link(p, q) or not any(link(a, b) for a in p.rows for b in q.rows)
        got = {frozenset(map(int, r)) for r in jaccard_join.linked(np.arange(12), np.zeros(12, int), np.arange(12), np.concatenate(sets), at, 2)}
        assert all(link(*p) for p in got)


def test_jaccard_join_empty(empty):
    assert jaccard_join.classes(empty).count() == 0


def test_pii(spark, rows, docs, empty):
    patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")

    def good(k, x):
        d = re.sub("[^0-9]", "", x)
        return True if k == 0 else all(int(p) <= 255 for p in x.split(".")) if k == 1 else 13 <= len(d) <= 19 and pii.luhn(d) if k == 2 else 9 <= len(d) <= 15

    got = {r["doc_id"]: r for r in pii.spans_of(docs).collect()}
    for i, t in texts(rows).items():
        want = [(k, m.start(), m.end()) for k in range(4) for m in re.finditer(patterns[k], t) if good(k, m[0])]
        assert [(s["kind"], s["start"], s["end"]) for s in got[i]["spans"] if s["strict"]] == want
    assert [s["kind"] for s in got[1010]["spans"] if s["strict"]] == [0, 1, 1, 1, 2, 3, 3]
    out = pii.mask_documents(docs)
    assert out.columns == docs.columns and out.where("doc_id = 1010").first()["text"].startswith("mail <EMAIL>, <PHONE>, <CARD>,")
    assert pii.spans_of(empty).count() == 0 and pii.mask_documents(empty).count() == 0


def test_pii_weak_supervision():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    v = np.stack([np.where(rng.random(4000) < acc, np.where(truth, 1, -1), np.where(truth, -1, 1)) for acc in (0.95, 0.9, 0.6, 0.55, 0.85)], 1)
    patterns, n = np.unique(v, axis=0, return_counts=True)
    post, rates, prior = pii.expect(patterns, n)
    assert rates[1, 0, 2] > rates[1, 2, 2] and abs(prior - 0.4) < 0.05
    at = {tuple(p): x for p, x in zip(patterns.tolist(), post, strict=True)}
    assert np.mean([(at[tuple(x)] > 0.5) == t for x, t in zip(v.tolist(), truth, strict=True)]) > 0.93


def test_span_classifier_corrects_a_labeler(spark, empty):
    """A context word before spans of a shape that is elsewhere known to be none: votes alone would take them, the classifier does not."""
    real = [(i, f"please call ({200 + i % 700}) {100 + i % 900}-{1000 + i * 7 % 9000} today") for i in range(300)]
    parts = [(1000 + i, f"order {10 + i % 90}-{10000 + i * 31 % 90000}-{10000 + i * 17 % 90000} shipped") for i in range(300)]
    wrong = [(2000 + i, f"call {10 + i}-{20000 + i}-{30000 + i} later") for i in range(12)]
    df = spark.createDataFrame(real + parts + wrong, "doc_id long, text string")
    spans = common.table(pii.found(df), "spans")
    known, w = pii.posteriors(spans), pii.train(spans)
    voted = [known[s["code"]] for r in spans.where("doc_id >= 2000").collect() for s in r["spans"]]
    assert len(voted) == 12 and min(voted) > 0.5
    got = {r["doc_id"] for r in pii.spans_of(df).collect() if r["spans"]}
    assert len(got & {i for i, _ in real}) > 290 and not got & {i for i, _ in wrong} and not got & {i for i, _ in parts}
    assert len(w) == pii.BUCKETS and not pii.train(common.table(pii.found(empty), "none")).any()


def test_overlapping_candidates_are_taken_once():
    w = np.zeros(pii.BUCKETS)
    w[[1, 2, 3]] = 3, 5, 4
    spans = [(0, 0, 4, True, 0, [0]), (2, 10, 20, False, 0, [1]), (3, 10, 20, False, 0, [2]), (3, 18, 25, False, 0, [3]), (3, 30, 35, False, 0, [1]), (3, 40, 45, False, 0, [0])]
    assert pii.chosen(spans, w, 0.9) == [(0, 0, 4, True), (3, 10, 20, False), (3, 30, 35, False)]


def test_packing(spark, rows, docs, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    ids = {i: np.array([*tok.encode(t, add_special_tokens=False).ids, 2], np.uint32) for i, t in texts(rows).items()}
    got = packing.packed(docs).collect()
    by, seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
        seq[r["sequence_id"]].append(r)
    assert by.keys() == ids.keys()
    for i, x in ids.items():
        at = 0
        for k, r in enumerate(sorted(by[i], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"], r["ids_crc32"]) == (k, at, zlib.crc32(x[at : at + r["length"]].tobytes())) and (k == 0 or r["length"] == 1024)
            at += r["length"]
        assert at == len(x)
    for s in seq.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    assert packing.packed(empty).count() == 0


def exact_packing(items, capacity):
    """Fewest sequences, by trying all assignments."""
    items, best = sorted(items, reverse=True), [len(items)]

    def lay(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + items[k] <= capacity and bins[i] not in bins[:i]:
                lay(k + 1, [*bins[:i], bins[i] + items[k], *bins[i + 1 :]])
        lay(k + 1, [*bins, items[k]])

    lay(0, [])
    return best[0]


def test_bin_completion_finds_the_least_number_for_small_sets():
    rng = np.random.default_rng(1)
    sets = [rng.integers(20, 50 if k % 2 else 90, rng.integers(8, 14)).tolist() for k in range(60)] + [[34, 44, 21, 41, 42, 37, 38, 20, 30, 29, 23, 29]]
    for items in sets:
        counts = np.bincount(items, minlength=101)
        plan = packing.plan(counts, 100)
        used = collections.Counter()
        for times, lengths in plan:
            assert sum(lengths) <= 100
            for x in lengths:
                used[x] += times
        assert used == collections.Counter(items)
        least = exact_packing(items, 100)
        assert packing.bound(counts, 100) <= least == sum(t for t, _ in plan), items
    # best fit needs three sequences here; two suffice
    assert sum(t for t, _ in packing.plan(np.bincount([6, 5, 3, 2, 2, 2], minlength=11), 10)) == 2


def test_bin_completion_of_large_histograms():
    rng = np.random.default_rng(4)
    for low, high in ((1, 1025), (300, 600), (500, 520)):
        counts = np.bincount(rng.integers(low, high, 5000), minlength=1025)
        plan = packing.plan(counts, 1024, budget=200)
        used = np.zeros(1025, int)
        for times, lengths in plan:
            assert sum(lengths) <= 1024
            for x in lengths:
                used[x] += times
        assert (used == counts).all() and 0 <= packing.gap(counts, 1024, plan) <= sum(t for t, _ in packing.best_fit(counts, 1024)) - packing.bound(counts, 1024)


def test_language_id(spark, rows, docs, empty, sf):
    whole = spark.read.parquet(f"{sf}/documents.parquet")
    model = language_id.learn(whole.where(common.fold_bucket("doc_id", 4) != 2))
    held = language_id.predict(whole.where(common.fold_bucket("doc_id", 4) == 2), model).join(whole.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95 and all(0 <= r["score"] <= 1 for r in held)
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(docs, model).collect()}
    assert got[1000] == got[1001] == got[1002] == "und"
    kept = language_id.known_language(docs, model)
    assert kept.columns == docs.columns and {1000, 1001, 1002}.isdisjoint(r["doc_id"] for r in kept.select("doc_id").collect()) and kept.first()["score"] == "s"
    assert language_id.learn(empty) == {} and {r["lang_pred"] for r in language_id.predict(docs, {}).collect()} == {"und"}


def test_phrases_are_longest_matches():
    sample = b" the cat sat on the mat "
    auto = language_id.automaton(sample)
    for w in (b"the", b"mat", b"catsat", b"xyz", b"at", b"themat"):
        text, n, at = b" " + w + b" ", 0, 0
        while at < len(text):
            k = 1
            while at + k <= len(text) and text[at : at + k] in sample:
                k += 1
            at += max(1, k - 1)
            n += 1
        assert language_id.phrases(auto, np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)])).tolist() == [n]


def brute_model(fit, order, least):
    """p(w | context) by plain counts of lists of tokens; summands and weights are rounded to a byte as the trie does."""
    c1 = collections.Counter(w for t in fit for w in t)
    grams = [collections.Counter(tuple(s[k : k + n]) for t in fit for s in [["\n", *t]] for k in range(len(s) - n + 1)) for n in range(2, order + 1)]
    whole = [collections.Counter() for _ in grams]
    taken = [collections.Counter() for _ in grams]
    for g, n, kept in zip(grams, whole, taken, strict=True):
        for k, m in g.items():
            n[k[:-1]] += m
        for k, m in g.items():
            kept[k[:-1]] += (m - 0.75) / n[k[:-1]] * (m >= least)
    total, kinds = sum(c1.values()), len(c1)
    q = lambda x: 10 ** (min(max(round(math.log10(max(x, 1e-300)) / -10 * 255), 0), 255) / 255 * -10)

    def p(context, w):
        if not context:
            return (c1[w] + 0.5) / (total + 0.5 * (kinds + 1))
        g, n, kept = (x[len(context) - 1] for x in (grams, whole, taken))
        known = g[(*context, w)]
        first = q((known - 0.75) / n[context]) if known >= least and known else 0
        return first + (q(1 - kept[context]) if n[context] else 1) * p(context[1:], w)

    return c1, total, kinds, p


@pytest.mark.parametrize("order, least", [(3, 1), (2, 1), (2, 2), (4, 1)])
def test_ngram_lm(spark, rows, docs, empty, order, least):
    model = ngram_lm.train(docs.where(common.fold_bucket("doc_id", 5) != 1), order=order, least=least)
    got = {r["doc_id"]: r for r in ngram_lm.scored(docs, model).collect()}
    tok = {i: [*words(t), "\n"] for i, t in texts(rows).items()}
    c1, total, kinds, p = brute_model([t for i, t in tok.items() if zlib.crc32(str(i).encode()) % 5 != 1], order, least)
    assert (model.total, model.kinds) == (total, kinds)
    for i, t in tok.items():
        s = ["\n", *t]
        score = sum(math.log10(p(tuple(s[max(0, k - order + 1) : k]), s[k])) for k in range(1, len(s)))
        assert (got[i]["n_tokens"], got[i]["n_known"]) == (len(t), sum(c1[w] > 0 for w in t))
        assert math.isclose(got[i]["base_score"], sum(math.log10(p((), w)) for w in t), rel_tol=1e-9) and math.isclose(got[i]["score"], score, rel_tol=1e-9)
    none = ngram_lm.train(empty)
    assert none.total == 0 and ngram_lm.scored(docs, none).where("n_known = 0").count() == len(rows) and ngram_lm.scored(empty, model).count() == 0


def test_op4(spark, rows, docs, tmp_path):
    """The query's model has all bigrams and trigrams, those found once too."""
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in ngram_lm.op4_ngram_lm(spark, str(tmp_path)).collect()}
    tok = {i: [*words(t), "\n"] for i, t in texts(rows).items()}
    c1, total, _, p = brute_model([t for i, t in tok.items() if zlib.crc32(str(i).encode()) % 5 != 1], 3, 1)
    assert got.keys() == tok.keys()
    for i, t in tok.items():
        s, r = ["\n", *t], got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (zlib.crc32(str(i).encode()) % 5 == 1, len(t), sum(c1[w] > 0 for w in t), total)
        assert math.isclose(r["base_score"], sum(math.log10(p((), w)) for w in t), rel_tol=1e-9)
        assert math.isclose(r["score"], sum(math.log10(p(tuple(s[max(0, k - 2) : k]), s[k])) for k in range(1, len(s))), rel_tol=1e-9)


def test_numbers_of_ngrams_beyond_one_integer():
    """Two columns where the product of parts and keys is too large give what one number gives, and nothing is lost."""
    rng = np.random.default_rng(4)
    part, key = rng.integers(0, 7, 500), rng.integers(0, 40, 500) * 10**17
    n = rng.integers(1, 5, 500)
    want = collections.Counter()
    for p, k, m in zip(part.tolist(), key.tolist(), n.tolist(), strict=True):
        want[p, k] += m
    got = ngram_lm._tallied(part, key, n)
    assert [(p, k, m) for (p, k), m in sorted(want.items())] == list(zip(*(x.tolist() for x in got), strict=True))
    assert [len(x) for x in ngram_lm._tallied(part[:0], key[:0], n[:0])] == [0, 0, 0]


def test_model_is_the_same_by_two_columns(spark, docs, monkeypatch):
    some = docs.where("doc_id < 30")
    key = lambda r: (repr(r["doc_id"]), r["score"])
    want = sorted(ngram_lm.scored(some, ngram_lm.train(some)).collect(), key=key)
    counted = ngram_lm._counted
    monkeypatch.setattr(ngram_lm, "_counted", lambda texts, grams, contexts, *more: counted(texts, grams, max(contexts, ngram_lm.KEYS), *more))
    assert sorted(ngram_lm.scored(some, ngram_lm.train(some)).collect(), key=key) == want


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n, u in ((1, 1), (5, 1 << 40), (1000, 3000), (20000, 1 << 50), (3000, 1 << 12)):
        v = np.unique(rng.integers(0, u, n))
        q = np.unique(np.append(v, rng.integers(0, u, n)))
        ef = ngram_lm.ef_build(v, u)
        assert (ngram_lm.ef_find(ef, q) == np.where(np.isin(q, v), np.searchsorted(v, q), -1)).all()
        assert (ngram_lm.ef_get(ef, np.arange(len(v))) == v).all()
        many = np.sort(rng.integers(0, max(1, u // 2), n))  # pointers may repeat
        assert (ngram_lm.ef_get(ngram_lm.ef_build(many, u), np.arange(n)) == many).all()
    for width in (1, 7, 17, 33):
        x = rng.integers(0, 1 << width, 500)
        assert (ngram_lm._bits(ngram_lm.pack(x, width), np.arange(500), width).astype(np.int64) == x).all()


def test_hamming_topk(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 100)).round(3)
    x[50:120] = x[50]  # one code that a third shares
    vec = [(i, v.tolist()) for i, v in enumerate(x)] + [(500, None), (501, []), (502, [0.5]), (503, [float("nan")] * 100), (50, x[50].tolist())]
    codes = hamming.sign_codes(spark.createDataFrame(vec, "vec_id long, embedding array<double>")).cache()
    got = hamming.topk(codes, codes.where("id % 20 = 0"), 7, block=16).collect()
    full = {i: np.pad(np.nan_to_num(np.array(v)) > 0, (0, 128 - len(v))) for i, v in vec if v}
    by = collections.defaultdict(list)
    for r in got:
        by[r["query_id"]].append((r["rank"], r["id"], r["distance"]))
    assert set(by) == {i for i in full if i % 20 == 0}
    for q, found in by.items():
        want = sorted((int((full[q] != b).sum()), i) for i, b in full.items())[:7]
        assert [(d, i) for _, i, d in sorted(found)] == want
    none = hamming.sign_codes(spark.createDataFrame([], "vec_id long, embedding array<double>"))
    assert hamming.topk(none, none).count() == 0


def test_hamming_topk_broadcasts_no_codes(spark):
    x = np.random.default_rng(4).normal(size=(300, 64))
    codes = hamming.sign_codes(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).cache()
    runs = lambda: spark._jsparkSession.sharedState().statusStore().executionsList()
    before = runs().size()
    assert hamming.topk(codes, codes.where("id % 20 = 0"), 5, block=16).count() == 75
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    plans = [runs().apply(i).physicalPlanDescription() for i in range(before, runs().size())]
    assert len(plans) > 5 and sum("BroadcastExchange" in p for p in plans) == 1  # the parts of the buckets


def best_pieces(v, word):
    """Highest sum of scores over all segmentations of a word (given with its mark), by plain recursion over prefixes."""
    score = dict(zip((v.bytes_of[i].decode().replace(" ", "▁") for i in v.ids.tolist()), v.scores.tolist(), strict=True))
    best = [0.0]
    for end in range(1, len(word) + 1):
        best.append(max([best[k] + score[word[k:end]] for k in range(max(0, end - v.longest), end) if word[k:end] in score] + [best[end - 1] + v.unknown] * (word[end - 1] not in score)))
    return best[-1]


def test_pieces(spark, rows, docs, empty):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    for r in pieces.encoded(docs, merging=True).collect():
        t = texts(rows)[r["doc_id"]]
        if "▁" not in t:
            assert r["ids"] == sp.encode(t)
    got = pieces.encoded(docs)
    back = {r["doc_id"]: r["text"] for r in pieces.decoded(got).collect()}
    assert back == texts(rows)
    assert pieces.encoded(empty).count() == 0 and pieces.decoded(pieces.encoded(empty)).count() == 0


def test_op7(spark, sf):
    """The query's ids are those of a best segmentation of each word, and decode to the text."""
    v = pieces.Vocabulary(pieces.default_model())
    score = dict(zip(v.ids.tolist(), v.scores.tolist(), strict=True))
    text = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = {r["doc_id"]: r for r in pieces.op7_pieces(spark, sf).collect()}
    best: dict = {}
    assert out.keys() == text.keys() and all(r["exact"] for r in out.values())
    for r in pieces.encoded(spark.read.parquet(f"{sf}/documents.parquet")).collect():
        t, ids = text[r["doc_id"]], r["ids"]
        assert (out[r["doc_id"]]["n_ids"], out[r["doc_id"]]["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, np.uint32).tobytes()))
        if "▁" in t or not t or set(ids) - score.keys():
            continue
        words = re.findall("▁+[^▁]*", "▁" + t.replace(" ", "▁"))
        for w in words:
            if w not in best:
                best[w] = best_pieces(v, w)
        assert math.isclose(sum(score[i] for i in ids), sum(best[w] for w in words), rel_tol=1e-9)
    assert len(best) > 500


def test_viterbi_of_short_words():
    """Against all segmentations, listed."""
    v = pieces.Vocabulary(pieces.default_model())
    score = dict(zip(((v.bytes_of[i].decode().replace(" ", "▁")) for i in v.ids.tolist()), v.scores.tolist(), strict=True))

    def best(w):
        if not w:
            return 0.0
        return max(score[w[:k]] + best(w[k:]) for k in range(1, len(w) + 1) if w[:k] in score)

    for w in ("hello", "weather", "abcabc", "theses"):
        data, off = common.strings(pa.array([w]))
        ids, _ = pieces.encode(v, data, off)
        assert pieces.decode(v, ids) == w
        assert math.isclose(sum(score[v.bytes_of[i].decode().replace(" ", "▁")] for i in ids.tolist()), best("▁" + w)) and math.isclose(best_pieces(v, "▁" + w), best("▁" + w))


def test_chroma(spark):
    rng = np.random.default_rng(0)
    vec = [(i, rng.normal(size=64).tolist()) for i in range(30)]
    vec[7] = (7, vec[3][1])
    df = spark.createDataFrame([*vec, (90, None), (91, [])], "vec_id long, embedding array<double>")
    rec = chroma.fingerprints(chroma.played(df, False)).cache()
    assert rec.count() == 30
    found = {r["query_id"]: r for r in chroma.align(chroma.fingerprints(chroma.played(df.where("vec_id % 5 = 0 or vec_id = 7"), True)), rec).collect()}
    assert set(found) == {0, 5, 7, 10, 15, 20, 25}
    for q, r in found.items():
        assert r["class_id"] == (3 if q == 7 else q) and r["members"] == (2 if q == 7 else 1) and r["offset"] == 2 * (8 + q % 16) and r["bit_error"] < 0.1
    bad = spark.createDataFrame([(1, b"junk"), (2, None), (3, b"")], "media_id long, audio binary")
    assert chroma.fingerprints(bad).count() == 0


def test_quality(spark, rows, docs, empty, sf):
    whole, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    x = quality.described(whole)
    model = quality.learn(x, labels.where(common.fold_bucket("doc_id", 3) != 1))
    held = quality.scored(x, model).join(labels.where(common.fold_bucket("doc_id", 3) == 1), "doc_id").collect()
    assert np.mean([(r["score"] >= 0.5) == r["quality"] for r in held]) > 0.95
    got = quality.scored(quality.described(docs), model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    none = quality.learn(quality.described(empty), labels.limit(0))
    assert {r["score"] for r in quality.scored(quality.described(docs), none).collect()} == {0.5}


def test_boosting_learns_a_pair():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    m = quality.fit(x, y, cycles=80)
    assert {0, 1} in [set(p[:2]) for p in m["pairs"]] and ((quality.score(m, x) > 0.5) == y).mean() > 0.9


def test_words_and_shingles():
    data, off = common.strings(pa.array(["A b c d e f", "a B c d e", None, "x y", "x  y ", " "]))
    row, h = common.shingles(data, off)
    assert np.bincount(row, minlength=6).tolist() == [2, 1, 0, 1, 1, 0]
    assert h[row == 1][0] in h[row == 0] and h[row == 3][0] == h[row == 4][0]


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (3, 2), (3, 4), (9, 8), (8, 7), (5, 5)], "a long, b long")
    assert {r["node"]: r["component"] for r in common.components(e).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 7: 7, 8: 7, 9: 7}


def test_pipeline(spark, sf):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in p.STAGES[:-1]:
        before, docs = docs, common.table(stage(spark, docs, sf), f"t-{name}")
        assert docs.columns == before.columns and 0 < docs.count() <= before.count()
        if name == "near_copies":
            c = {r["doc_id"]: r["component_id"] for r in jaccard_join.classes(before).collect()}
            assert {r["doc_id"] for r in docs.collect()} == {i for i, m in c.items() if i == m}
    out = p.STAGES[-1][1](spark, docs, sf)
    assert out.select("doc_id").distinct().count() == docs.count()


def test_pipeline_repeated_rows(spark):
    """Rows repeated whole, two texts of one id and rows without an id: one row of each component, and each row's own text."""
    import corpus_pipeline as p

    text = {k: " ".join(f"{k}{i * 7919 % 997}" for i in range(80)) for k in "abcdef"}
    rows = [(1, text["a"]), (1, text["a"]), (2, text["b"]), (2, text["c"]), (3, text["d"]), (3, text["d"] + " tail"), (4, text["d"]), (5, text["a"]), (None, text["e"]), (None, text["e"]), (6, ""), (6, ""), (7, None)]
    shared = "one passage of two texts that is longer than two hundred bytes " * 4
    rows += [(8, "head " + text["f"] + " " + shared), (8, " ".join(f"g{i}" for i in range(80)) + " " + shared)]
    docs = common.table(spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(3), "t-rows")
    one = common.table(p.join_near_copies(spark, docs, ""), "t-one")
    got = sorted(((r["doc_id"], r["text"]) for r in one.collect()), key=repr)
    d = min((text["d"], text["d"] + " tail"), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert got == sorted([(1, text["a"]), (2, text["b"]), (2, text["c"]), (3, d), (None, text["e"]), (6, ""), (7, None), *rows[-2:]], key=repr)
    raw = [(i, (t or "").encode()) for i, t in got]
    count = collections.Counter(b[k : k + 200] for _, b in raw for k in range(len(b) - 199))
    want = []
    for i, b in raw:
        cover = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            if count[b[k : k + 200]] > 1:
                cover[k : k + 200] = True
        want.append((i, np.frombuffer(b, np.uint8)[~cover].tobytes().decode()))
    assert sorted(((r["doc_id"], r["text"] or "") for r in p.drop_repeats(spark, one, "").collect()), key=repr) == sorted(want, key=repr)
    assert sum(len(t) for _, t in want) < sum(len(b) for _, b in raw)
    masked = p.mask_personal_data(spark, one, "")
    assert sorted(((r["doc_id"], r["text"]) for r in masked.collect()), key=repr) == got


def test_registry():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES if re.match(r"op\d+_", n)) == list(range(1, 14))
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
