"""Repair of the structure of conversations by least edits.

Method: a conversation's rows and the automaton of legal orders, `(s?(ua)+)?` over the first letters of roles, make a
graph whose nodes are (rows consumed, state) and whose arcs are the edits Keep, Rerole, Delete and Insert.  Least costs
from the front and from the back name the tight arcs, those on some cheapest path; from the set of nodes reached so
far, the least letter that a tight arc carries is taken, step by step, which gives the least of all cheapest edit texts.

A conversation may be of any length.  Rows are sorted in ranges, equal rows counted first, and a task packs the rows of
a conversation into pieces of bounded size.  One that lies whole inside a task's range as one piece is repaired there.
For others, each piece gives a 4 x 4 matrix of least costs from state to state, a few numbers for thousands of rows;
the pieces of a conversation are chained by these, and then each is repaired between the costs at its ends, in order, one
piece at a time, because the digest of all repaired lines can only be made in order.

Cases: null ids are one conversation; null roles and texts are one space; null turns come first; rows of one turn go by
role, then by the MD5 and the bytes of the text; a row whose role is empty or begins with another letter cannot be kept as it is.
Rows of a conversation that are equal in turn, role and text count as repeats, without a limit.  Further columns are not read.
No rows: no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3  # costs; CUT is added for a truncated row that stays
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})  # state by state: nothing yet, system, user, assistant
ENDS = (0, 3)
ROLE = {"u": "user", "a": "assistant"}
NAMES = (None, None, "user", "assistant")  # of what an edit made, by the state it leads to
FAR = 1 << 60
ROWS, BYTES = 4096, 1 << 22  # of a piece
CLEAN, TRUNCATED, GONE = 0, 1, 2
BLANK = "[^\\x20\\x09-\\x0D]"


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, n: rows after damage by a hash of their place; n is 0 for a dropped row, whose role and text are null."""
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(place.cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.when(kind != 0, F.when(kind == 4, F.lit("user")).otherwise(role)).alias("role"), F.when(kind != 0, text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def faulted(rows: DataFrame) -> DataFrame:
    """Distinct rows (conv_id, turn, role, text) with their number n, and whether each is blank, truncated and the first of its role and text.

    Copies are counted before they are moved, and the first turn of a text is an aggregate too, so a text that fills a
    conversation is one row for each turn.
    """
    key = ["conv_id", "role", "text"]
    first = rows.where("n > 0").groupBy(*key).agg(F.min("turn").alias("turn"), F.max(F.col("turn").isNull()).alias("none"))
    first = first.select("conv_id", F.when(~F.col("none"), F.col("turn")).alias("turn"), "role", "text", F.lit(0).cast("long").alias("n"), F.lit(1).alias("first"))
    all_ = rows.withColumn("first", F.lit(0)).unionByName(first).groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"), (F.max("first") == 1).alias("first"))
    blank = ~F.col("text").rlike(BLANK)
    return all_.withColumns({"blank": F.coalesce(blank, F.lit(False)), "truncated": F.coalesce(~F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z"), F.lit(False))})


def _arcs(code: int) -> list[tuple[str, int, int, int]]:
    """(letter, from, to, cost) of the edits of a row; code: 4 * its role's place in "sua" or 3, + its fault."""
    symbol, fault = "sua-"[code // 4], code % 4
    found = [("D", q, q, DELETE) for q in range(4)]
    if fault != GONE:
        more = CUT * (fault == TRUNCATED)
        found += [("K", q, NEXT[q][symbol], KEEP + more) for q in range(4) if symbol in NEXT[q]]
        found += [("R", q, NEXT[q][x], REROLE + more) for q in range(4) for x in ROLE if x in NEXT[q]]
    return found


ARCS = tuple(_arcs(code) for code in range(16))
INSERTS = tuple(("I", q, NEXT[q][x], INSERT) for q in range(4) for x in ROLE if x in NEXT[q])
Costs = tuple[int, int, int, int]


def _closed(costs: list[int], back: bool) -> Costs:
    """Inserts between two rows: two passes are enough, as a third insert leads back to a state already reached."""
    for _ in range(2):
        for _, q, to, w in INSERTS:
            a, b = (to, q) if back else (q, to)
            costs[b] = min(costs[b], costs[a] + w)
    return tuple(min(x, FAR) for x in costs)


@lru_cache(1 << 16)
def _moved(costs: Costs, code: int, back: bool) -> Costs:
    out = [FAR] * 4
    for _, q, to, w in ARCS[code]:
        a, b = (to, q) if back else (q, to)
        out[b] = min(out[b], costs[a] + w)
    return _closed(out, back)


def passed(costs: Costs, codes: bytes, back: bool = False) -> list[Costs]:
    """Least costs at each boundary of the rows, from the front or from the back; what all states have in common is set aside, so that few steps are new."""
    out, base, rel = [costs], min(costs), tuple(min(x - min(costs), FAR) for x in costs)
    for code in reversed(codes) if back else codes:
        step = _moved(rel, code, back)
        low = min(step)
        base, rel = base + low, tuple(x - low if x < FAR else FAR for x in step)
        out.append(tuple(min(x + base, FAR) for x in rel))
    return out[::-1] if back else out


FRONT = _closed([0, FAR, FAR, FAR], False)
BACK = _closed([0 if q in ENDS else FAR for q in range(4)], True)


def matrix(codes: bytes) -> list[int]:
    """Least costs from each state before the rows to each state behind them."""
    return [x for q in range(4) for x in passed(tuple(0 if p == q else FAR for p in range(4)), codes)[-1]]


def letters(codes: bytes, front: list[Costs], back: list[Costs], best: int, at: set[int], last: bool) -> Iterator[tuple[str, int, int, set[int]]]:
    """(letter, row, state led to, nodes reached) along tight arcs: the least letter of the set at each step."""
    i = 0
    while i < len(codes) or last and not any(q in ENDS and back[i][q] == 0 for q in at):
        choices: dict[str, set[int]] = {}
        for letter, q, to, w in (*INSERTS, *(ARCS[codes[i]] if i < len(codes) else ())):
            behind = back[i] if letter == "I" else back[i + 1]
            if q in at and front[i][q] + w + behind[to] == best:
                choices.setdefault(letter, set()).add(to)
        letter = min(choices)
        at = choices[letter]
        yield letter, i, min(at), at
        i += letter != "I"


class _Piece:
    """Rows of one conversation in order, as codes, and role and text of those that may stay."""

    def __init__(self, most_rows: int = ROWS, most_bytes: int = BYTES):
        self.most_rows, self.most_bytes = most_rows, most_bytes
        self.codes, self.roles, self.texts, self.size = bytearray(), [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.head = self.tail = None

    def add(self, turn, role: str, text: str, n: int, first: bool, blank: bool, cut: bool) -> int:
        """Takes as many of n equal rows as it has room for; returns how many are left."""
        took = min(n, self.most_rows - len(self.codes))
        z = role[:1]
        kind = 4 * ("sua".index(z) if z and z in "sua" else 3)
        stays = int(first and not blank)
        self.blank += took * blank
        self.duplicate += (took - stays) * (not blank)
        self.truncated += stays * cut
        if stays:
            self.codes.append(kind + (TRUNCATED if cut else CLEAN))
            self.roles.append(role)
            self.texts.append(text)
            self.size += len(text) + len(role)
        self.codes.extend(bytes([kind + GONE]) * (took - stays))
        self.illegal += took - 1 + (self.tail is not None and _illegal(self.tail, z))
        self.head, self.tail = z if self.head is None else self.head, z
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        return n - took

    def full(self) -> bool:
        return len(self.codes) >= self.most_rows or self.size >= self.most_bytes

    def lines(self, front: Costs, back: Costs, best: int, at: set[int], last: bool) -> Iterator[tuple[str, str | None, set[int]]]:
        """(letter, repaired line or None, nodes reached) of each edit."""
        own = iter(zip(self.roles, self.texts, strict=True))
        seen, row = -1, None
        codes = bytes(self.codes)
        for letter, i, to, at_ in letters(codes, passed(front, codes), passed(back, codes, True), best, at, last):
            if letter != "I" and i != seen and codes[i] % 4 != GONE:
                seen, row = i, next(own)
            yield letter, None if letter == "D" else f"{NAMES[to]}:" if letter == "I" else f"{row[0] if letter == 'K' else NAMES[to]}:{row[1]}", at_


def _illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au") or not a or not b


def repaired(piece: _Piece) -> tuple[int, str, str]:
    """Cost, edits and digest of a whole conversation."""
    best, digest, audit, begun = passed(BACK, bytes(piece.codes), True)[0][0], hashlib.sha256(), [], False
    for letter, line, _ in piece.lines(FRONT, BACK, best, {0}, True):
        audit.append(letter)
        if line is not None:
            digest.update(b"\n" * begun + line.encode())
            begun = True
    return best, "".join(audit), digest.hexdigest()


COUNTS = "blank long, duplicate long, truncated long, illegal long, turns long, low long, high long"
PIECES = f"part int, k long, whole boolean, {COUNTS}, head string, tail string, codes binary, roles array<string>, texts array<string>, cost long, audit string, repaired_sha256 string"


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def _packed(batches, kind: pa.DataType, most: tuple[int, int]):
    """Pieces of the sorted rows of one range; those of the first and last conversation may go on elsewhere."""
    names = ["conv_id", *(x.split()[0] for x in PIECES.split(", "))]
    types = [kind, pa.int32(), pa.int64(), pa.bool_(), *[pa.int64()] * 7, pa.string(), pa.string(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.string()), pa.int64(), pa.string(), pa.string()]
    part, k, rows, size, now, piece, sole = TaskContext.get().partitionId(), 0, [], 0, None, None, False

    def put(piece: _Piece, whole: bool):
        nonlocal k, size
        done = repaired(piece) if whole else (None, None, None)
        rest = (None, None, None) if whole else (bytes(piece.codes), piece.roles, piece.texts)
        rows.append((now, part, k, whole, piece.blank, piece.duplicate, piece.truncated, piece.illegal, piece.turns, piece.low, piece.high, piece.head, piece.tail, *rest, *done))
        k, size = k + 1, size + (200 if whole else piece.size + len(piece.codes))

    for b in batches:
        for conv, turn, role, text, n, first, blank, cut in zip(*(b.column(x).to_pylist() for x in ("conv_id", "turn", "role", "text", "n", "first", "blank", "truncated")), strict=True):
            if piece is None or conv != now:
                if piece is not None:
                    put(piece, sole)
                piece, sole, now = _Piece(*most), piece is not None, conv  # the first of a range may have begun before it
            while n:
                if piece.full():
                    put(piece, False)
                    piece, sole = _Piece(*most), False
                n, first = piece.add(turn, role, text, n, first, blank, cut), False
            if size > BYTES or len(rows) >= ROWS:
                yield _batch(rows, names, types)
                rows.clear()
                size = 0
    if piece is not None:
        put(piece, False)
    if rows:
        yield _batch(rows, names, types)


def _summed(batches, kind: pa.DataType):
    for b in batches:
        costs = pa.array([matrix(x) for x in b.column("codes").to_pylist()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*(b.column(x) for x in CHAIN), costs], [*CHAIN, "costs"])


CHAIN = ["conv_id", "part", "k", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "head", "tail"]


def _chained(table: pa.Table) -> pa.Table:
    """The pieces of one conversation, in order: costs before the first row and behind the last of each, and the sums at the last."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["k"]))
    front, back = [FRONT], [BACK]
    for r in rows:
        front.append(tuple(min(FAR, *(front[-1][q] + r["costs"][4 * q + p] for q in range(4))) for p in range(4)))
    for r in reversed(rows):
        back.append(_closed([min(back[-1][p] + r["costs"][4 * q + p] for p in range(4)) for q in range(4)], True))
    back = back[::-1]
    total = {x: sum(r[x] for r in rows) for x in ("blank", "duplicate", "truncated", "illegal", "turns")}
    low = high = tail = None
    for r in rows:
        if r["low"] is not None:
            total["turns"] -= r["low"] == high
            low, high = r["low"] if low is None else low, r["high"]
        if r["head"] is not None:
            total["illegal"] += tail is not None and _illegal(tail, r["head"])
            tail = r["tail"]
    end = {**total, "low": low, "high": high, "cost": back[0][0]}
    out = [{"part": r["part"], "k": r["k"], "front": list(front[i]), "back": list(back[i + 1]), "last": i + 1 == len(rows), **{f"all_{x}": v for x, v in end.items()}} for i, r in enumerate(rows)]
    return pa.Table.from_pylist(out, CHAINED_TYPES)


ENDINGS = ["blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "cost"]
CHAINED = "part int, k long, front array<long>, back array<long>, last boolean, " + ", ".join(f"all_{x} long" for x in ENDINGS)
CHAINED_TYPES = pa.schema([("part", pa.int32()), ("k", pa.int64()), ("front", pa.list_(pa.int64())), ("back", pa.list_(pa.int64())), ("last", pa.bool_()), *((f"all_{x}", pa.int64()) for x in ENDINGS)])


def _followed(batches, kind: pa.DataType):
    """Repairs pieces in order; what is held of a conversation is one piece, its edits and the state of its digest."""
    names, types = ["conv_id", *ENDINGS, "audit", "repaired_sha256"], [kind, *[pa.int64()] * 8, pa.string(), pa.string()]
    at, digest, audit, begun = {0}, hashlib.sha256(), [], False
    for b in batches:
        for r in b.to_pylist():
            piece = _Piece()
            piece.codes, piece.roles, piece.texts = r["codes"], r["roles"], r["texts"]
            for letter, line, at in piece.lines(tuple(r["front"]), tuple(r["back"]), r["all_cost"], at, r["last"]):
                audit.append(letter)
                if line is not None:
                    digest.update(b"\n" * begun + line.encode())
                    begun = True
            audit = ["".join(audit)]
            if r["last"]:
                yield _batch([(r["conv_id"], *(r[f"all_{x}"] for x in ENDINGS), audit[0], digest.hexdigest())], names, types)
                at, digest, audit, begun = {0}, hashlib.sha256(), [], False


def repair(rows: DataFrame, most_rows: int = ROWS, most_bytes: int = BYTES) -> DataFrame:
    """One row a conversation of rows (conv_id, turn, role, text, n), as `damaged` gives them: counts of faults, least cost, edits, digest of the repaired lines.

    A piece of a conversation holds `most_rows` rows, and no more after `most_bytes` of text.
    """
    c.settle(rows.sparkSession)
    name = rows.schema["conv_id"].dataType.simpleString()
    kind = rows.select("conv_id").limit(0).toArrow().schema.field("conv_id").type
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.md5(F.col("text").cast("binary"))]
    ordered = faulted(rows).repartitionByRange(*order).sortWithinPartitions(*order, "text")
    pieces = c.table(c.mapped(ordered, lambda batches: _packed(batches, kind, (most_rows, most_bytes)), f"conv_id {name}, {PIECES}"), "turns", keep=True)
    whole, open_ = pieces.where("whole"), pieces.where("not whole")
    sums = c.mapped(open_.select(*CHAIN, "codes"), lambda batches: _summed(batches, kind), f"conv_id {name}, part int, k long, {COUNTS}, head string, tail string, costs array<long>")
    chained = sums.groupBy("conv_id").applyInArrow(_chained, CHAINED)
    parts = open_.select("conv_id", "part", "k", "codes", "roles", "texts").join(chained, ["part", "k"])
    sorted_ = parts.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "k")
    followed = c.mapped(sorted_, lambda batches: _followed(batches, kind), f"conv_id {name}, {', '.join(f'{x} long' for x in ENDINGS)}, audit string, repaired_sha256 string")
    columns = ["conv_id", *ENDINGS, "audit", "repaired_sha256"]
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long")
    return whole.select(*columns).unionByName(followed.select(*columns)).select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op13_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


CRC32_SQL = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: xor(({table})[(xor(a, b) & 255) + 1], a >> 8)), 4294967295)"""
CRC32_TABLE_SQL = """SELECT list(list_reduce(list_prepend(b, range(8)), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY b) AS t FROM range(256) r(b)"""

#: Least (cost, edits) to the end, from the last row to the first, in place of two passes and a walk.
OP13_SQL = f"""
WITH RECURSIVE crc AS ({CRC32_TABLE_SQL}),
d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {CRC32_SQL.format(text="coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')", table="crc.t")} % 20 AS g FROM conversations, crc),
a AS (SELECT conv_id, turn, CASE g WHEN 4 THEN 'user' ELSE role END AS role, CASE g WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE g WHEN 3 THEN 2 ELSE 1 END)) AS again FROM d WHERE g <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), text, again) AS i, count(*) OVER (PARTITION BY conv_id) AS n,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, again) AS nth FROM a),
f AS (SELECT conv_id, turn, role, text, i, n, left(role, 1) AS z, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'b' WHEN nth > 1 THEN 'd'
  WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 't' ELSE '' END AS fault FROM r),
b AS (
  SELECT DISTINCT conv_id, n AS i, {{'c': 0, 'a': ''}} AS s0, {{'c': 6, 'a': 'II'}} AS s1, {{'c': 3, 'a': 'I'}} AS s2, {{'c': 0, 'a': ''}} AS s3 FROM f
  UNION ALL
  SELECT conv_id, i, list_min([e0, {{'c': e2.c + 3, 'a': 'I' || e2.a}}, {{'c': e3.c + 6, 'a': 'II' || e3.a}}]), list_min([e1, {{'c': e2.c + 3, 'a': 'I' || e2.a}}, {{'c': e3.c + 6, 'a': 'II' || e3.a}}]),
    list_min([e2, {{'c': e3.c + 3, 'a': 'I' || e3.a}}]), list_min([e3, {{'c': e2.c + 3, 'a': 'I' || e2.a}}])
  FROM (SELECT b.conv_id, b.i - 1 AS i,
      {", ".join(f"list_min([{{'c': s{q}.c + 4, 'a': 'D' || s{q}.a}}, {{'c': s{to}.c + 3 + o, 'a': 'R' || s{to}.a}}, {keep}]) AS e{q}" for q, to, keep in (
        (0, 2, "CASE z WHEN 's' THEN {'c': s1.c + o, 'a': 'K' || s1.a} WHEN 'u' THEN {'c': s2.c + o, 'a': 'K' || s2.a} END"), (1, 2, "CASE z WHEN 'u' THEN {'c': s2.c + o, 'a': 'K' || s2.a} END"),
        (2, 3, "CASE z WHEN 'a' THEN {'c': s3.c + o, 'a': 'K' || s3.a} END"), (3, 2, "CASE z WHEN 'u' THEN {'c': s2.c + o, 'a': 'K' || s2.a} END")))}
    FROM b JOIN (SELECT *, CASE fault WHEN '' THEN 0 WHEN 't' THEN 3 ELSE 1000000000 END AS o FROM f) f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i)),
best AS (SELECT conv_id, s0.c AS cost, s0.a AS audit FROM b WHERE i = 0),
p AS (SELECT conv_id, pos, audit[pos] AS letter FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS pos FROM best)),
o AS (SELECT *, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w AS k FROM p WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
l AS (SELECT o.conv_id, o.pos, o.letter, o.k, CASE WHEN o.letter <> 'I' THEN f.text ELSE '' END AS text, CASE WHEN o.letter = 'K' THEN f.role END AS role,
    (max(CASE WHEN o.letter = 'K' AND o.k = 1 AND f.z = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY o.conv_id))::BIGINT AS led
  FROM o LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM o.conv_id AND f.i = o.i WHERE o.letter <> 'D'),
h AS (SELECT conv_id, sha256(string_agg(coalesce(role, CASE WHEN (k - led) % 2 = 1 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY pos)) AS repaired FROM l GROUP BY 1),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
  count(*) FILTER (y IS NOT NULL AND y || z NOT IN ('su', 'ua', 'au')) AS illegal FROM (SELECT *, lag(z) OVER (PARTITION BY conv_id ORDER BY i) AS y FROM f) GROUP BY 1)
SELECT c.conv_id, coalesce(g.gaps, 0)::BIGINT AS gaps, coalesce(g.blank, 0)::BIGINT AS blank, coalesce(g.duplicate, 0)::BIGINT AS duplicate, coalesce(g.truncated, 0)::BIGINT AS truncated,
  coalesce(g.illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit, coalesce(h.repaired, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id
  LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM c.conv_id"""
