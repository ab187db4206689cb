"""Personal data spans by weak supervision.

Method: candidate spans come from strict patterns (the contract's), from wider ones, from word lists (mail providers,
dialling codes) and from the words before them.  Labelers vote on each: patterns and check digits (regex), word lists
and number plans (gazetteer), the words before a span and the characters beside it (context).  Votes are counted by
pattern over the whole corpus; expectation-maximisation (Dawid-Skene with one reliability per labeler and class) finds
how far each is to be trusted.  The posteriors train a span classifier, a logistic model over what the labelers do not
look at: the span's shape and grouping, its first digits, the words around it.  The classifier decides every
candidate, so a labeler that errs on one shape of span does not take it along.  What the strict patterns find is kept
whatever the classifier says; of other candidates that overlap, the likeliest stays.

A candidate's votes are one small code (at most CODES values), so what EM sees is a histogram of bounded size, counted
over all texts by Spark; the classifier is fitted on at most about SAMPLE candidates, chosen by a hash.

Cases: null and empty texts have no spans; offsets are code points, end exclusive; repeated ids are separate rows, rows
without an id are left out of spans; other columns may have any name and are kept by `mask_documents`, which keeps
all rows; without candidates nothing is learned and the strict patterns stand.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "check", "gazetteer", "context", "surroundings")
CODES = len(KINDS) * 3 ** len(LABELERS)
ACCEPT = 0.9  # of spans beyond the strict patterns
SAMPLE, BUCKETS = 20_000, 1 << 12  # candidates that the classifier is fitted on; weights that it has

_LOCAL = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(48, 58)])) + "._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
#: Words before a span that speak for its kind, in the corpus's languages.
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "correo", "courriel", "kontakt", "contacto"),
    "ip": ("ip", "host", "server", "address", "adresse", "servidor", "serveur"),
    "card": ("card", "visa", "mastercard", "amex", "payment", "karte", "tarjeta", "carte", "kreditkarte"),
    "phone": ("phone", "tel", "telephone", "mobile", "cell", "fax", "call", "telefon", "telefono", "téléphone", "teléfono", "handy", "móvil"),
}
AGAINST = ("version", "isbn", "issn", "doi", "section", "chapter", "page", "pages", "vol", "no", "figure", "fig", "table", "order", "id")
SUFFIXES = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at", "us", "ca", "mx")
DIALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98")
PROVIDERS = ("gmail", "googlemail", "yahoo", "hotmail", "outlook", "icloud", "gmx", "web", "proton", "protonmail", "mail", "live", "aol")
#: Wider shapes: kind, pattern, and a string without which a text has none; the span is the last group, or the whole match.
_WIDE = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]{2,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]{2,63}){1,4}"), "at"),
    ("ip", re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"), ":"),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])"), "."),
    ("phone", re.compile(r"(?<![0-9A-Za-z+.(-])\(?[0-9]{2,4}\)?(?:[ .-][0-9]{2,5}){2,4}(?![0-9A-Za-z]|[.-][0-9])"), None),
    ("card", re.compile(r"(?<![0-9A-Za-z.])[0-9]{4}(?:[./][0-9]{4}){3}(?![0-9A-Za-z])"), None),
    ("email", re.compile(r"[A-Za-z0-9._%+-]{2,64} at (?:" + "|".join(PROVIDERS) + r")(?: dot |\.)[a-z]{2,4}(?![A-Za-z])"), " at "),
    ("phone", re.compile(r"(?<![0-9A-Za-z.+-])00(?:" + "|".join(DIALLING) + r")[ ./-]?\(?[0-9][0-9 ()./-]{4,14}[0-9](?![0-9A-Za-z])"), "00"),
)
#: What may stand after a context word, by kind.
_AFTER = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{2,64} ?(?:@|\[@\]| AT ) ?[A-Za-z0-9-]{1,63}(?: ?\. ?[A-Za-z0-9-]{2,63}){1,4}"),
    "ip": re.compile(r"[0-9]{1,3}(?: ?[.,] ?[0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"[0-9](?:[ ./-]?[0-9]){12,18}(?![0-9])"),
    "phone": re.compile(r"\(?[0-9](?:[ ()./-]{0,2}[0-9]){5,13}(?![0-9])"),
}
_CUE = re.compile(r"\b(?:" + "|".join(f"(?P<{k}>{'|'.join(v)})" for k, v in CONTEXT.items()) + r")\b(?: ?(?:number|no\.?|nr\.?|num\.?))?[:#=]? {0,2}(?=[0-9(A-Za-z])")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the contract's patterns, in order; linear in the text's length but for an address' digits."""
    out = []
    at, end = text.find("@"), 0
    while at >= 0:
        before = text[max(end, text.rfind("@", end, at) + 1) : at]
        start = at - (len(before) - len(before.rstrip(_LOCAL)))
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((0, start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGITS.sub("", m[0])) <= 15]
    return out


def votes(text: str, kind: int, start: int, end: int, strict: bool) -> int:
    """Code of the labelers' votes (0 against, 1 abstain, 2 for) and of the span's shape."""
    span, name = text[start:end], KINDS[kind]
    digits = _DIGITS.sub("", span)
    v = [2 if strict else 1]
    if kind == 0:
        v.append(2 if re.search(r"[.)\]] ?[A-Za-z]{2,}$", span) else 0)
        v.append(2 if re.split(r"[.\])] ?", span)[-1].lower() in SUFFIXES else 1)
    elif kind == 1:
        v.append(2 if ":" in span or not span.startswith("0.") else 0)
        v.append(0 if span in ("127.0.0.1", "0.0.0.0", "255.255.255.255") else 1)
    elif kind == 2:
        v.append(2 if 13 <= len(digits) <= 19 and luhn(digits) else 0)
        v.append(2 if digits[:1] in "3456" and digits[:1] else 0)
    else:
        v.append(2 if 9 <= len(digits) <= 15 else 0)
        v.append(2 if span[0] == "+" and (digits[:1] in DIALLING or digits[:2] in DIALLING) else 2 if re.match(r"\([0-9]{3}\)", span) else 1)
    before = re.findall(r"[^\W\d_]+", text[max(0, start - 32) : start].lower())[-3:]
    v.append(2 if any(w in CONTEXT[name] for w in before) else 0 if any(w in AGAINST for w in before) else 1)
    beside = text[start - 1 : start] + text[end : end + 1]
    v.append(0 if re.search(r"[\w/=]", beside) else 1)
    code = kind
    for x in v:
        code = code * 3 + x
    return code


def traits(text: str, kind: int, start: int, end: int) -> list[int]:
    """What the classifier sees of a span: hashed features of the span and of the words about it, none of them a vote."""
    span, name = text[start:end], KINDS[kind]
    shape = re.sub(r"[a-z]+", "a", re.sub(r"[A-Z]+", "A", re.sub(r"[0-9]", "9", span)))[:24]
    groups = re.split(r"[^0-9]+", span.strip("()+ "))
    before = re.findall(r"\w+", text[max(0, start - 40) : start].lower())[-2:]
    after = re.findall(r"\w+", text[end : end + 40].lower())[:1]
    seen = [
        f"shape {shape}", f"groups {len(groups)}", f"sizes {'-'.join(str(len(g)) for g in groups[:6])}", f"digits {sum(map(str.isdigit, span))}", f"marks {''.join(sorted(set(re.sub('[0-9A-Za-z]', '', span))))[:6]}",
        f"head {span[:2]}", f"last {span[-3:].lower() if kind == 0 else ''}", f"beside {text[start - 1 : start] if start else ''}|{text[end : end + 1]}", *(f"{'one' if i else 'two'} before {w}" for i, w in enumerate(before)), *(f"after {w}" for w in after),
    ]
    return sorted({zlib.crc32(f"{name} {x}".encode()) % BUCKETS for x in (*seen, "bias")})


def candidates(text: str) -> list[tuple[int, int, int, bool, int, list[int]]]:
    """(kind, start, end, strict, code, traits) of a text's strict spans and of wider candidates that overlap none of them."""
    strict = base_spans(text)
    wide = set()
    for name, pattern, needs in _WIDE:
        if needs is None or needs in text:
            wide.update((KINDS.index(name), m.start(), m.end()) for m in pattern.finditer(text))
    low = text.lower()
    if len(low) == len(text):  # lower case has other lengths for a few letters; then cues are sought as they stand
        cues = _CUE.finditer(low)
    else:
        cues = _CUE.finditer(text)
    for m in cues:
        found = _AFTER[m.lastgroup].match(text, m.end())
        if found:
            wide.add((KINDS.index(m.lastgroup), found.start(), found.end()))
    ends = sorted((s, e) for _, s, e in strict)
    starts, reach = [s for s, _ in ends], list(accumulate((e for _, e in ends), max))
    spans = [(k, s, e, True) for k, s, e in strict]
    for k, s, e in sorted(wide):
        before = bisect_left(starts, e)  # strict spans that start before this one ends
        if not before or reach[before - 1] <= s:
            spans.append((k, s, e, False))
    return [(*x, votes(text, *x), traits(text, *x[:3])) for x in spans]


SPANS = "array<struct<kind:int,start:int,end:int,strict:boolean,code:int,traits:array<int>>>"


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every text: strict spans and candidates with votes and traits."""
    one = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("strict", pa.bool_()), ("code", pa.int32()), ("traits", pa.list_(pa.int32()))])

    def run(batches):
        for b in batches:
            out = []
            for text in b.column("text").to_pylist():
                out.append(candidates(text))
            at = np.append(0, np.cumsum([len(x) for x in out])).astype(np.int32)
            flat = list(zip(*(y for x in out for y in x), strict=True)) or [()] * len(one)
            values = pa.StructArray.from_arrays([pa.array(v, f.type) for v, f in zip(flat, one, strict=True)], fields=list(one))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(pa.array(at), values)], names=["doc_id", "spans"])

    return c.id_text(docs, id_col, text_col).transform(c.mapped, run, f"doc_id long, spans {SPANS}")


def unpack(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kind, and votes (-1, 0, 1 by labeler), of codes."""
    v, rest = np.zeros((len(codes), len(LABELERS)), np.int64), codes
    for k in range(len(LABELERS) - 1, -1, -1):
        v[:, k] = rest % 3 - 1
        rest = rest // 3
    return rest, v


def expect(votes_: np.ndarray, n: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over counted vote patterns: posterior of each, (class, labeler, vote) rates, prior."""
    post = 1 / (1 + np.exp(-1.5 * votes_.sum(axis=1)))
    prior, rates = 0.5, None
    for _ in range(rounds):
        w = np.stack([n * (1 - post), n * post])
        prior = float(np.clip((w[1].sum() + 1) / (w.sum() + 2), 0.02, 0.98))
        rates = np.array([[[(w[y][votes_[:, k] == v].sum() + (3 if v == 2 * y - 1 else 1)) / (w[y].sum() + 5) for v in (-1, 0, 1)] for k in range(votes_.shape[1])] for y in (0, 1)])
        like = np.log([[1 - prior], [prior]]) + np.array([[sum(np.log(rates[y, k, v + 1]) for k, v in enumerate(row)) for row in votes_] for y in (0, 1)])
        post = 1 / (1 + np.exp(np.clip(like[0] - like[1], -50, 50)))
    return post, rates, prior


def posteriors(spans: DataFrame) -> dict[int, float]:
    """Probability of each pattern of votes, by EM over the corpus' counts; each kind has reliabilities of its own."""
    rows = spans.select(F.explode("spans.code").alias("code")).groupBy("code").agg(F.count("*").alias("n")).collect()  # at most CODES
    codes, n = (np.array([r[k] for r in sorted(rows)]) for k in ("code", "n"))
    out: dict[int, float] = {}
    if len(codes):
        kind, v = unpack(codes)
        for k in np.unique(kind):
            own = kind == k
            out |= dict(zip(codes[own].tolist(), expect(v[own], n[own].astype(float))[0].tolist(), strict=True))
    return out


def fit(rows: list[list[int]], target: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Weights of a logistic model over hashed traits, by gradient steps that shrink with what a weight has moved; targets are probabilities."""
    size = np.array([len(r) for r in rows], np.int64)
    flat, row = np.array([x for r in rows for x in r], np.int64), np.repeat(np.arange(len(rows)), size)
    w, moved = np.zeros(BUCKETS), np.full(BUCKETS, 1e-6)
    for _ in range(rounds if len(rows) else 0):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[flat], minlength=len(rows)), -30, 30)))
        g = np.bincount(flat, (p - target)[row], minlength=BUCKETS) / len(rows) + 1e-5 * w
        moved += g * g
        w -= 0.3 * g / np.sqrt(moved)
    return w


def train(spans: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """The classifier's weights, from posteriors of at most about `sample` candidates of the whole corpus."""
    known = posteriors(spans)
    each = spans.select("doc_id", F.explode("spans").alias("s"))
    share = min(1.0, sample / max(1, each.count()))
    picked = each.where(F.pmod(F.xxhash64("doc_id", "s.start", "s.kind"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("s.code", "s.traits").collect()
    picked = sorted((r["code"], r["traits"]) for r in picked)
    return fit([t for _, t in picked], np.array([known[k] for k, _ in picked], float))


def chosen(spans: list, w: np.ndarray, accept: float) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, strict) in order: strict spans, and of the candidates that the classifier takes those that overlap no likelier one."""
    out, wide = [], []
    for kind, start, end, strict, _, seen in spans:
        if strict:
            out.append((kind, start, end, True))
        else:
            p = 1 / (1 + np.exp(-w[seen].sum()))
            if p >= accept:
                wide.append((-p, start, kind, end))
    taken: list[tuple[int, int]] = []
    for _, start, kind, end in sorted(wide):
        at = bisect_left(taken, (start, end))
        if (at == len(taken) or taken[at][0] >= end) and (not at or taken[at - 1][1] <= start):
            insort(taken, (start, end))
            out.append((kind, start, end, False))
    return sorted(out)


def spans_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """(doc_id, spans array<struct<kind,start,end,strict>>) ordered by kind and start: strict spans, and candidates that the classifier takes."""
    every = c.table(found(docs, id_col, text_col), "spans")
    w = every.sparkSession.sparkContext.broadcast(train(every))
    one = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("strict", pa.bool_())])

    def run(batches):
        for b in batches:
            rows = [[dict(zip(one.names, x, strict=True)) for x in chosen([tuple(s.values()) for s in spans], w.value, accept)] for spans in b.column("spans").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(rows, pa.list_(one))], names=["doc_id", "spans"])

    return every.transform(c.mapped, run, "doc_id long, spans array<struct<kind:int,start:int,end:int,strict:boolean>>")


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with spans (start, end, kind) replaced by their kinds; what overlaps is replaced once."""
    parts, at = [], 0
    for s, e, k in sorted(spans):
        if e > at:
            parts.append(text[at:s] + f"<{KINDS[k].upper()}>" if s >= at else "")
            at = e
    return "".join(parts) + text[at:]


def mask_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """The documents, all columns, with personal data masked: a first pass trains on their votes, a second rewrites texts where spans are."""
    with c.scratch():
        weights = train(c.table(found(docs, id_col, text_col), "spans"))
    w = docs.sparkSession.sparkContext.broadcast(weights)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            texts = []
            for text in b.column(at).to_pylist():
                spans = [(s, e, k) for k, s, e, _ in chosen(candidates(text), w.value, accept)] if text else []
                texts.append(mask(text, spans) if spans else text)
            yield pa.RecordBatch.from_arrays([pa.array(texts, b.schema.field(i).type) if i == at else x for i, x in enumerate(b.columns)], schema=b.schema)

    return docs.transform(c.mapped, run, docs.schema)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = spans_of(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    name = F.array(*map(F.lit, KINDS))
    text = lambda x: F.concat_ws(":", name[x["kind"]], x["start"].cast("string"), x["end"].cast("string"))
    base = F.filter("spans", lambda x: x["strict"])
    of = lambda k: F.size(F.filter(base, lambda x: x["kind"] == k))
    counts = [of(k).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return spans.select("doc_id", *counts, F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"), F.array_join(F.transform("spans", text), ",").alias("spans"))
