"""Repair of conversations against dynamic programming over edit texts, and against all edits of short ones."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from quire.llm import registry, turns

SCHEMA = "conv_id long, turn long, role string, text string, n string, key string"
SPACE = " \t\n\v\f\r"


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text, role = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text, "user" if kind == 4 else role
        out.setdefault(conv, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest(), r[2])
    return {k: sorted(v, key=order) for k, v in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        left = text.strip(SPACE)
        out.append("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def legal(initials):
    return re.fullmatch("(s?(ua)+)?", initials) is not None


def cheapest(rows, fault):
    """(cost, edits) by the least text from each row on, whatever stands before: a state is what has been given so far."""
    steps = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = {("", len(rows)): (0, ""), ("a", len(rows)): (0, ""), ("u", len(rows)): (3, "I"), ("s", len(rows)): (6, "II")}
    for i in range(len(rows) - 1, -1, -1):
        here = {}
        for q in steps:
            c, t = best[q, i + 1]
            options = [(c + 4, "D" + t)]
            if fault[i] in ("", "truncated"):
                more = 3 * (fault[i] == "truncated")
                z = rows[i][1][:1]
                if z in steps[q]:
                    options.append((best[steps[q][z], i + 1][0] + more, "K" + best[steps[q][z], i + 1][1]))
                options += [(best[to, i + 1][0] + 3 + more, "R" + best[to, i + 1][1]) for x, to in steps[q].items() if x in "ua"]
            here[q] = min(options)
        for _ in range(3):
            for q in steps:
                here[q] = min([here[q], *((here[to][0] + 3, "I" + here[to][1]) for x, to in steps[q].items() if x in "ua")])
        best |= {(q, i): v for q, v in here.items()}
    return best["", 0]


def apply(rows, audit):
    out, i = [], 0
    for letter in audit:
        role, text = rows[i][1:] if letter != "I" else (None, "")
        if letter != "D":
            led = bool(out) and out[0][0][:1] == "s"
            out.append((role if letter == "K" else ("user", "assistant")[(len(out) - led) % 2], text))
        i += letter != "I"
    return out


def brute(rows):
    got = []
    for conv, mine in damage(rows).items():
        fault = faults(mine)
        cost, audit = cheapest(mine, fault)
        found = [t for t, _, _ in mine if t is not None]
        initials = [r[:1] for _, r, _ in mine]
        lines = apply(mine, audit)
        assert legal("".join(r[:1] for r, _ in lines))
        got.append((
            conv, max(found) - min(found) + 1 - len(set(found)) if found else 0, *(fault.count(x) for x in ("blank", "duplicate", "truncated")),
            sum(x + y not in ("su", "ua", "au") for x, y in itertools.pairwise(initials)), cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest(),
        ))
    return sorted(got, key=repr)


def some_rows(seed, conversations=40, longest=9):
    rng = random.Random(seed)
    texts = ["yes.", "no", "", " \n", "A question?", "one. two", "end! \t", "x" * 50 + "."]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
            role = "system" if turn == 0 and rng.random() < 0.4 else rng.choice(["tool", "", "usr", None]) if rng.random() < 0.07 else role
            rows.append((conv, turn * rng.choice([1, 1, 2]), role, rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}."))
    rows += [(None, 0, "user", "a."), (None, 1, "assistant", "b."), (900, None, "user", "c."), (900, None, "assistant", None), (901, None, None, None)]
    rows += [(902, 5, "user", "same.")] * 30 + [(903, i, "user", "same.") for i in range(30)] + [(904, 1, "user", "z" * 300_000 + "."), (904, 2, "assistant", "ok.")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "n", "k") for r in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("most", [(4096, 1 << 22), (3, 1 << 22), (1, 10), (4096, 40)])
def test_repair(spark, most):
    """Odd rows, long and repeated ones; pieces of any size give the same result."""
    rows = some_rows(most[0])
    got = turns.repair(turns.damaged(frame(spark, rows)), *most)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_one_long_conversation(spark):
    """All rows in one conversation, cut over tasks and pieces."""
    rng = random.Random(11)
    rows = [(1, i, rng.choice(["user", "assistant", "system"]), rng.choice(["same.", f"t{i}.", f"t{i}", ""])) for i in range(3000)]
    got = turns.repair(turns.damaged(frame(spark, rows)), 100)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_least_edits_are_those_of_all_edits():
    """Each text of edits of short conversations, tried one by one."""
    rng = random.Random(2)
    for _ in range(150):
        rows = [(i, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b", "", f"{i}."])) for i in range(rng.randint(0, 3))]
        fault, best = faults(rows), None
        for size in range(0, 3 * len(rows) + 3):
            for audit in itertools.product("DIKR", repeat=size):
                if sum(x != "I" for x in audit) != len(rows):
                    continue
                own = [x for x in audit if x != "I"]
                if any(x != "D" and f in ("blank", "duplicate") for x, f in zip(own, fault, strict=True)):
                    continue
                cost = sum({"D": 4, "I": 3, "K": 0, "R": 3}[x] for x in audit) + sum(3 for x, f in zip(own, fault, strict=True) if x != "D" and f == "truncated")
                if (best is None or (cost, audit) < best) and cost <= 4 * len(rows):
                    for roles in itertools.product("ua", repeat=sum(x in "IR" for x in audit)):
                        made, kept = iter(roles), iter(zip(own, rows, strict=True))
                        out = ""
                        for x in audit:
                            row = next(kept)[1] if x != "I" else None
                            out += next(made) if x in "IR" else row[1][:1] if x == "K" else ""
                        if legal(out):
                            best = (cost, audit)
                            break
        codes = bytes(4 * ("sua".index(r[1][0]) if r[1][0] in "sua" else 3) + {"": 0, "truncated": 1}.get(f, 2) for r, f in zip(rows, fault, strict=True))
        front, back = turns.passed(turns.FRONT, codes), turns.passed(turns.BACK, codes, True)
        audit = tuple(x[0] for x in turns.letters(codes, front, back, back[0][0], {0}, True))
        assert (back[0][0], audit) == best == (front[-1] and (min(front[-1][0], front[-1][3]), best[1]))


def test_query(spark, tmp_path):
    rows = some_rows(8)
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = registry.QUERIES["op13_turns"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
