"""Repairs against an exhaustive search over all edits; cut conversations; hot ones; odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from storyloom.llm import turn_repair
from storyloom.llm.turn_repair import Chain, damage, items_of, repair, solve, transfer

SCHEMA = "key string, conv_id long, turn long, role string, text string, first boolean"
WS = " \t\n\x0b\x0c\r"
LEGAL = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub("[.!?]", "", text)
        if h == 4:
            role = "user"
        out += [(c, t, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(WS)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, fs):
    """Over all sequences of edits: first the least cost, then the least audit."""
    best = None
    kinds = [[("D", None)] if f in ("blank", "duplicate") else
             [("K", None), ("R", "user"), ("R", "assistant"), ("D", None)] for f in fs]
    inserts = ["", "u", "a", "ua", "au"]
    for edits in itertools.product(*kinds):
        base = sum({"K": 0, "R": 1, "D": 2}[e] + (5 if f == "truncated" and e != "D" else 0) for (e, _), f in zip(edits, fs))
        if best and base > best[0]:
            continue
        for gaps in itertools.product(inserts, repeat=len(rows) + 1):
            cost = base + 5 * sum(map(len, gaps))
            if best and cost > best[0]:
                continue
            audit, lines, initials = "", [], ""
            for i, gap in enumerate(gaps):
                for g in gap:
                    audit, initials = audit + "I", initials + g
                    lines.append({"u": "user:", "a": "assistant:"}[g])
                if i < len(rows):
                    (e, to), (role, text) = edits[i], rows[i]
                    audit += e
                    if e != "D":
                        role = to or role
                        initials += role[:1] or "?"
                        lines.append(f"{role}:{text}")
            if LEGAL.fullmatch(initials) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, lines
    return best


def program(rows, fs):
    """A plain dynamic program over all prefixes, for long conversations."""
    state = {"": (0, "", [])}  # the last legal initial: "", s, u, a

    def better(d, k, v):
        if k not in d or v[:2] < d[k][:2]:
            d[k] = v

    def follow(s, i):
        return {"s": s == "", "u": s in ("", "s", "a"), "a": s == "u"}.get(i, False)

    def inserted(d):
        d = dict(d)
        for _ in range(2):
            for s, (c, a, ls) in list(d.items()):
                for i, name in (("u", "user"), ("a", "assistant")):
                    if follow(s, i):
                        better(d, i, (c + 5, a + "I", ls + [name + ":"]))
        return d
    for (role, text), f in zip(rows, fs):
        new = {}
        for s, (c, a, ls) in inserted(state).items():
            better(new, s, (c + 2, a + "D", ls))
            if f in ("blank", "duplicate"):
                continue
            c += 5 if f == "truncated" else 0
            if role and follow(s, role[0]):
                better(new, role[0], (c, a + "K", ls + [f"{role}:{text}"]))
            for name in ("user", "assistant"):
                if follow(s, name[0]):
                    better(new, name[0], (c + 1, a + "R", ls + [f"{name}:{text}"]))
        state = new
    return min((v for s, v in inserted(state).items() if s in ("", "a")), key=lambda v: v[:2])


def model(rows, search):
    out = []
    after = damaged(rows)
    for conv in {r[0] for r in rows}:
        own = [r for r in after if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
        turns = [r[1] for r in own if r[1] is not None]
        pairs = [(r[2], r[3]) for r in own]
        fs = faults(pairs)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        cost, audit, lines = search(pairs, fs) if pairs else (0, "", [])
        out.append((conv, gaps, fs.count("blank"), fs.count("duplicate"), fs.count("truncated"), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([("k", *r, False) for r in rows], SCHEMA)
    out = repair(damage(df), df)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


ROLES = ["user", "assistant", "system", "tool", "user", "assistant"]


def some_rows(seed, convs, most):
    rnd = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rnd.randrange(1, most + 1)):
            role = rnd.choice(ROLES) if rnd.random() < 0.5 else ("user", "assistant")[t % 2]
            rows.append((c, t + (t > 2), role, rnd.choice(["Yes.", "no", "Ça va ?  ", " \t", "x!\ny", f"t{t}."])))
    return rows


def test_the_search_equals_all_edits():
    rnd = random.Random(0)
    for _ in range(150):
        n = rnd.randrange(0, 4)
        rows = [(rnd.choice(ROLES + [""]), rnd.choice(["a.", "b", " ", f"{i}."])) for i in range(n)]
        fs = faults(rows)
        assert solve(items_of([(r, t, 1, f) for (r, t), f in zip(rows, fs)])) == cheapest(rows, fs)[:2] == program(rows, fs)[:2]


@pytest.mark.parametrize("size", [1, 3, 7])
def test_segments_give_the_same_as_the_whole(size):
    rnd = random.Random(size)
    for _ in range(60):
        rows = [(rnd.choice(ROLES), rnd.choice(["a.", "b", " ", f"{i}."])) for i in range(rnd.randrange(1, 30))]
        fs = faults(rows)
        each = [(r, t, 1, f) for (r, t), f in zip(rows, fs)]
        chain = Chain()
        for a in range(0, len(each), size):
            chain.add(transfer(items_of(each[a:a + size])))
        assert chain.finish()[:2] == solve(items_of(each)) == program(rows, fs)[:2]


@pytest.mark.parametrize("segment", [3, 128])
def test_conversations_with_nulls_ties_repeats_and_hot_ones(spark, monkeypatch, segment):
    monkeypatch.setattr(turn_repair, "SEGMENT", segment)
    rows = some_rows(1, 120, 8)
    rows += [(500, t, ("user", "assistant")[t % 2], f"line {t}" + "." * (t % 3)) for t in range(700)]  # a long one
    rows += [(501, 1, "user", "again.")] * 300  # equal rows
    rows += [(501, 2, "assistant", "one."), (501, 2, "assistant", "two."), (501, 2, "user", "three.")]  # one turn
    rows += [(502, t, "user", "again.") for t in range(200)]
    rows += [(None, 0, "user", "x."), (None, None, "assistant", "y."), (None, None, None, None), (503, None, "user", "z."),
             (503, None, "assistant", None), (504, 3, "", "no role."), (505, 9, "user", "long. " * 50_000)]
    gone = next(i for i in range(600, 2000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "x.")]
    got = run(spark, rows)
    assert got == model(rows, program)
    assert (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got


def test_empty_table(spark):
    assert run(spark, []) == []
