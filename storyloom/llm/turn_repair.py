"""Repair of the turn structure of conversations by bidirectional Dijkstra over the edit lattice (operator 12).

A conversation's rows, in order, are repaired by edits so that the initials of its roles match
``(s?(ua)+)?``: Keep 0, Rerole to user or assistant 1, Delete 2, Insert an empty user or assistant turn 5; a truncated
row that stays costs 5 more, and a blank or duplicate row must go. The *edit lattice* has a node for each
number of rows passed and each of four states (nothing yet, after s, after u, after a). A forward heap
starts at the first node, a reverse heap at the last; they settle nodes by cost (equal costs in the order of
rows, since Keep is free) with the least audit from or to each. Every edge from a forward-settled to a reverse-settled
node is a crossing. The search goes on until the sum of both heaps' least costs exceeds the best crossing, so that all
equal-cost crossings are known; the ASCII-least concatenated audit of them is the answer. It fixes the repair.

*At scale.* Rows equal in conversation, turn, role and text are counted before they are shuffled; a run of rows that
must go is one edge. First occurrences come from an aggregate by (conversation, role, text hash), joined on a key that
no two rows share. Rows are then dealt by ranges of (conversation, turn, role, text hash), so a conversation of any
share of the rows is spread over tasks, and a task reads its rows as a stream. A conversation that lies inside a task
and fits ``SEGMENT`` rows is finished there. Others are cut into segments: each gives the least cost and audit
from every state to every state, by the same search. Inserts stand before a row, never at a segment's end, so
the audits of two ways through a segment are never prefixes of one another and least audits concatenate. One pass
over a conversation's segments (not rows) picks the way. Segments are then repaired in
parallel, and one stream in order hashes their texts. What a task holds of one conversation is bounded by a
constant times its audit, which is one value of the result anyhow.

Defined results: a null role or text reads as one space; a null turn comes first and has no part in gaps; a
null conv_id is a conversation of its own. Rows of one turn follow role, then the SHA-256 of the text. A role that is empty
has no initial and is no legal one. A conversation without rows after damage: zeros, empty audit, hash of nothing.
Repeated rows are rows (duplicates). Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.arrow import give_back
from storyloom.operators.materialize import materialize

#: Rows (equal ones count once) of a segment.
SEGMENT = 128
SPACE = " \t\n\x0b\x0c\r"
#: States: nothing yet, after system, after user, after assistant.
E, S, U, A = range(4)
#: The state after an inserted or reroled turn, and after a kept one by its initial.
NEXT = {E: U, S: U, U: A, A: U}
KEEP = {"s": {E: S}, "u": {E: U, S: U, A: U}, "a": {U: A}}
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 1, 2, 5, 5
#: What ends a conversation in each state.
CLOSING = {E: (0, ""), S: (2 * INSERT_COST, "II"), U: (INSERT_COST, "I"), A: (0, "")}


def damage(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` with planted faults, by crc32 of ``conv_id:turn`` modulo 20."""
    def or_space(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    text = or_space("text")
    return (rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.when(kind == 4, "user").otherwise(or_space("role")).alias("role"),
                        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
                        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"))
            .withColumn("times", F.explode(F.slice(F.array(F.lit(1), F.lit(2)), F.lit(1), F.col("times")))).drop("times"))


# ---- the lattice -------------------------------------------------------------------------------------------------

def items_of(rows: list[tuple]) -> list[tuple]:
    """Steps of the lattice from rows (role, text, copies, fault): ``("gone", k)`` for a run of k rows that must
    go, ``(initial, truncated)`` for a row with a choice; copies after the first must go."""
    out: list[tuple] = []

    def gone(k):
        if k and out and out[-1][0] == "gone":
            out[-1] = ("gone", out[-1][1] + k)
        elif k:
            out.append(("gone", k))
    for role, _, copies, fault in rows:
        if fault in ("blank", "duplicate"):
            gone(copies)
        else:
            out.append((role[:1], fault == "truncated"))
            gone(copies - 1)
    return out


class Lattice:
    """Edges of a row sequence. ``closed``: inserts after the last row and a last node that E and A reach."""

    def __init__(self, items: list[tuple], closed: bool):
        n = len(items)
        self.ahead: list[list] = [[] for _ in range(4 * (n + 2))]
        self.back: list[list] = [[] for _ in range(4 * (n + 2))]
        self.end = 4 * (n + 1)
        for i in range(n + 1):
            if i < n or closed:
                for s in (E, S, U, A):
                    self._edge(4 * i + s, 4 * i + NEXT[s], INSERT_COST, "I")
            if i == n:
                break
            for s in (E, S, U, A):
                at, after = 4 * i + s, 4 * i + 4
                if items[i][0] == "gone":
                    self._edge(at, after + s, DELETE_COST * items[i][1], "D" * items[i][1])
                    continue
                initial, truncated = items[i]
                more = TRUNCATED_COST if truncated else 0
                to = KEEP.get(initial, {}).get(s)
                if to is not None:
                    self._edge(at, after + to, KEEP_COST + more, "K")
                self._edge(at, after + NEXT[s], REROLE_COST + more, "R")
                self._edge(at, after + s, DELETE_COST, "D")
        if closed:
            self._edge(4 * n + E, self.end, 0, "")
            self._edge(4 * n + A, self.end, 0, "")

    def _edge(self, a: int, b: int, cost: int, label: str) -> None:
        self.ahead[a].append((b, cost, label))
        self.back[b].append((a, cost, label))

    def least(self, source: int, target: int) -> tuple[int, str] | None:
        """Least cost and the ASCII-least audit of it, or None if the target can't be reached."""
        if source == target:
            return 0, ""
        # (cost, order of rows, node); labels: node -> (cost, audit)
        fore, hind = [(0, source // 4, source)], [(0, -(target // 4), target)]
        to, fro = {source: (0, "")}, {target: (0, "")}
        settled_to: set[int] = set()
        settled_fro: set[int] = set()
        best, crossings = None, []
        while fore and hind and (best is None or fore[0][0] + hind[0][0] <= best):
            forward = fore[0][0] <= hind[0][0]
            cost, _, v = heapq.heappop(fore if forward else hind)
            mine, done, other = (to, settled_to, settled_fro) if forward else (fro, settled_fro, settled_to)
            if v in done:
                continue
            done.add(v)
            audit = mine[v][1]
            for w, c, label in (self.ahead if forward else self.back)[v]:
                if w in other:
                    whole = cost + c + (fro if forward else to)[w][0]
                    if best is None or whole < best:
                        best, crossings = whole, []
                    if whole == best:
                        crossings.append((v, label, w) if forward else (w, label, v))
                new = (cost + c, audit + label if forward else label + audit)
                if w not in done and (w not in mine or new < mine[w]):
                    mine[w] = new
                    heapq.heappush(fore if forward else hind, (new[0], w // 4 if forward else -(w // 4), w))
        if best is None:
            return None
        return best, min(to[v][1] + label + fro[w][1] for v, label, w in crossings)


def solve(items: list[tuple]) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    lattice = Lattice(items, closed=True)
    return lattice.least(E, lattice.end)


def transfer(items: list[tuple]) -> list:
    """Of a segment, for each state before and after it: least cost and audit, or None."""
    lattice, n = Lattice(items, closed=False), len(items)
    return [[lattice.least(s, 4 * n + t) for t in (E, S, U, A)] for s in (E, S, U, A)]


class Chain:
    """The least way through the segments of a conversation, one after another."""

    def __init__(self):
        # of each state that can be reached: cost, and the rank of its audit among them
        self.now: dict[int, tuple[int, int]] = {E: (0, 0)}
        self.steps: list[dict[int, tuple[int, str]]] = []

    def add(self, way: list) -> None:
        found = {}
        for t in (E, S, U, A):
            ways = [(self.now[s][0] + way[s][t][0], self.now[s][1], way[s][t][1], s)
                    for s in self.now if way[s][t] is not None]
            if ways:
                found[t] = min(ways)
        order = sorted(found, key=lambda t: found[t][1:3])
        self.now = {t: (found[t][0], rank) for rank, t in enumerate(order)}
        self.steps.append({t: (f[3], f[2]) for t, f in found.items()})

    def finish(self) -> tuple[int, str, list[tuple[int, str]]]:
        """Cost, audit, and of each segment the state before it and its audit; the last one's audit has the
        closing inserts."""
        cost, _, end = min((c + CLOSING[t][0], rank, t) for t, (c, rank) in self.now.items())
        state, ways = end, []
        for step in reversed(self.steps):
            state, audit = step[state]
            ways.append((state, audit))
        ways.reverse()
        if ways:
            ways[-1] = (ways[-1][0], ways[-1][1] + CLOSING[end][1])
        return cost, "".join(a for _, a in ways), ways


def repaired(rows: list[tuple], state: int, audit: str) -> list[str]:
    """``role:text`` of the rows that an audit leaves, from the state before them."""
    out, each = [], ((role, text) for role, text, copies, _ in rows for _ in range(copies))
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(each)
        if edit == "D":
            continue
        if edit == "K":
            state = KEEP[role[:1]][state]
        else:
            state = NEXT[state]
            role = "user" if state == U else "assistant"
        out.append(f"{role}:{text}")
    return out


# ---- conversations as streams -----------------------------------------------------------------------------------------

def fault_of(text: str, first: bool) -> str:
    own = text.strip(SPACE)
    if not own:
        return "blank"
    return "duplicate" if not first else "" if own[-1] in ".!?" else "truncated"


LEGAL = {"su", "ua", "au"}


class Tally:
    """Counts of a row sequence that can be joined with those of the next one."""
    NAMES = ("low", "high", "turns", "last_turn", "first_turn", "blank", "duplicate", "truncated", "illegal", "head", "tail")

    def __init__(self, **own):
        self.low = self.high = self.last_turn = self.first_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.head = self.tail = None
        self.__dict__.update(own)

    def row(self, turn, role: str, copies: int, fault: str) -> None:
        initial = role[:1]
        self.illegal += copies - 1 + (self.tail is not None and self.tail + initial not in LEGAL)
        if self.head is None:
            self.head = initial
        self.tail = initial
        self.blank += copies if fault == "blank" else 0
        self.duplicate += copies if fault == "duplicate" else copies - 1 if fault != "blank" else 0
        self.truncated += fault == "truncated"
        if turn is not None:
            self.turns += turn != self.last_turn
            self.low = turn if self.low is None else self.low
            self.first_turn = self.low
            self.high = self.last_turn = turn

    def join(self, after: Tally) -> None:
        self.illegal += after.illegal + (self.tail is not None and after.head is not None
                                         and self.tail + after.head not in LEGAL)
        for k in ("blank", "duplicate", "truncated", "turns"):
            setattr(self, k, getattr(self, k) + getattr(after, k))
        if after.first_turn is not None:
            self.turns -= after.first_turn == self.last_turn
            self.low = after.low if self.low is None else self.low
            self.first_turn = self.low
            self.high, self.last_turn = after.high, after.last_turn
        self.head = after.head if self.head is None else self.head
        self.tail = after.tail if after.tail is not None else self.tail

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


FOUND = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_FOUND = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
          ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
_KEY = [("c", pa.int64()), ("cn", pa.bool_())]
_ROWS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string()), ("copies", pa.int64()), ("fault", pa.string())]))
_WAY = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))
_TALLY = pa.struct([(k, pa.string() if k in ("head", "tail") else pa.int64()) for k in Tally.NAMES])
_PIECE = pa.schema([*_KEY, ("part", pa.int64()), ("seq", pa.int64()), ("found", pa.struct(_FOUND)),
                    ("rows", _ROWS), ("way", _WAY), ("tally", _TALLY)])
PIECE = ("c long, cn boolean, part long, seq long, found struct<" + FOUND.replace(" long", ": long").replace(" string", ": string")
         + ">, rows array<struct<role: string, text: string, copies: long, fault: string>>, way array<struct<cost: long, "
         "audit: string>>, tally struct<" + ", ".join(f"{k}: {'string' if k in ('head', 'tail') else 'long'}" for k in Tally.NAMES) + ">")


def _each(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[dict]:
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield from batch.slice(a, rows).to_pylist()


def _buffered(rows: Iterator[dict], schema: pa.Schema, weight) -> Iterator[pa.RecordBatch]:
    """Batches of bounded weight."""
    held, total = [], 0
    for r in rows:
        held.append(r)
        total += weight(r)
        if total >= 1 << 20:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _found(tally: Tally, cost: int, audit: str, sha: str | None) -> dict:
    return {"gaps": tally.gaps(), "blank": tally.blank, "duplicate": tally.duplicate, "truncated": tally.truncated,
            "illegal": tally.illegal, "cost": cost, "audit": audit, "repaired_sha256": sha}


def _pieces(segment: int):
    """Sorted rows to finished conversations, and segments of those that may go on in another task or are long."""
    def piece(key, part, seq, rows, tally):
        way = [x for w in transfer(items_of(rows)) for x in w]
        return {"c": key[0], "cn": key[1], "part": part, "seq": seq, "found": None,
                "rows": [dict(zip(("role", "text", "copies", "fault"), r)) for r in rows],
                "way": [w and {"cost": w[0], "audit": w[1]} for w in way],
                "tally": {k: getattr(tally, k) for k in Tally.NAMES}}

    def each(batches):
        part, seq = TaskContext.get().partitionId(), 0
        key, rows, tally, cut, edge = None, [], Tally(), False, True
        for r in _each(batches):
            if key != (r["c"], r["cn"]):
                if rows and (cut or edge):
                    yield piece(key, part, (seq := seq + 1), rows, tally)
                elif rows:
                    cost, audit = solve(items_of(rows))
                    sha = hashlib.sha256("\n".join(repaired(rows, E, audit)).encode("utf-8", "surrogatepass")).hexdigest()
                    yield {"c": key[0], "cn": key[1], "part": part, "seq": 0, "found": _found(tally, cost, audit, sha),
                           "rows": None, "way": None, "tally": None}
                edge = key is None  # a task's first and last conversation may have rows in its neighbours
                key, rows, tally, cut = (r["c"], r["cn"]), [], Tally(), False
            elif len(rows) >= segment:
                yield piece(key, part, (seq := seq + 1), rows, tally)
                rows, tally, cut = [], Tally(), True
            fault = fault_of(r["text"], r["first"])
            rows.append((r["role"], r["text"], r["copies"], fault))
            tally.row(r["t"] if r["tn"] else None, r["role"], r["copies"], fault)
        if rows:
            yield piece(key, part, seq + 1, rows, tally)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _buffered(each(batches), _PIECE, lambda r: 2000 + sum(len(x["text"]) for x in r["rows"] or ()))
        give_back()
    return run


_CHOSEN = pa.schema([*_KEY, ("part", pa.int64()), ("seq", pa.int64()), ("state", pa.int64()), ("own", pa.string()),
                     ("found", pa.struct(_FOUND))])
CHOSEN = "c long, cn boolean, part long, seq long, state long, own string, " + PIECE[PIECE.index("found"):PIECE.index(", rows")]


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted segments (without texts) to the way through each, and a row for each conversation."""
    def close(key, places, chain, tally):
        cost, audit, ways = chain.finish()
        for (part, seq), (state, own) in zip(places, ways):
            yield {"c": key[0], "cn": key[1], "part": part, "seq": seq, "state": state, "own": own, "found": None}
        yield {"c": key[0], "cn": key[1], "part": None, "seq": None, "state": None, "own": None,
               "found": _found(tally, cost, audit, None)}

    def run():
        key, places, chain, tally = None, [], Chain(), Tally()
        for r in _each(batches, 16):
            if key != (r["c"], r["cn"]):
                if places:
                    yield from close(key, places, chain, tally)
                key, places, chain, tally = (r["c"], r["cn"]), [], Chain(), Tally()
            places.append((r["part"], r["seq"]))
            way = [w and (w["cost"], w["audit"]) for w in r["way"]]
            chain.add([way[4 * s:4 * s + 4] for s in range(4)])
            tally.join(Tally(**r["tally"]))
        if places:
            yield from close(key, places, chain, tally)
    yield from _buffered(run(), _CHOSEN, lambda r: 200 + len(r["own"] or r["found"]["audit"]))
    give_back()


_LINES = pa.schema([*_KEY, ("part", pa.int64()), ("seq", pa.int64()), ("lines", pa.binary())])


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def run():
        for r in _each(batches, 16):
            rows = [(x["role"], x["text"], x["copies"], x["fault"]) for x in r["rows"]]
            lines = repaired(rows, r["state"], r["own"])
            if lines:
                yield {"c": r["c"], "cn": r["cn"], "part": r["part"], "seq": r["seq"],
                       "lines": "\n".join(lines).encode("utf-8", "surrogatepass")}
    yield from _buffered(run(), _LINES, lambda r: 100 + len(r["lines"]))
    give_back()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces of text to the hash of each conversation's repaired text, read as a stream."""
    schema = pa.schema([*_KEY, ("sha", pa.string())])

    def run():
        key, sha = None, None
        for r in _each(batches, 16):
            if key != (r["c"], r["cn"]):
                if key:
                    yield {"c": key[0], "cn": key[1], "sha": sha.hexdigest()}
                key, sha = (r["c"], r["cn"]), hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(r["lines"])
        if key:
            yield {"c": key[0], "cn": key[1], "sha": sha.hexdigest()}
    yield from _buffered(run(), schema, lambda r: 100)
    give_back()


def repair(rows: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of each conversation of
    ``rows(conv_id, turn, role, text)``, and of each conv_id of ``originals`` that has no rows there."""
    conv = [F.coalesce("conv_id", F.lit(0).cast("long")).alias("c"), F.col("conv_id").isNull().alias("cn")]
    turn = [F.coalesce("turn", F.lit(0).cast("long")).alias("t"), F.col("turn").isNotNull().alias("tn")]
    own = rows.select(*conv, *turn, F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")) \
        .withColumn("key", F.sha2("text", 256))
    whole = ["c", "cn", "tn", "t", "role", "key"]
    counted = own.groupBy(*whole).agg(F.count("*").alias("copies"), F.first("text").alias("text"))
    firsts = own.groupBy("c", "cn", "role", "key").agg(F.min(F.struct("tn", "t")).alias("at")) \
        .select("c", "cn", "at.tn", "at.t", "role", "key", F.lit(True).alias("first"))
    marked = counted.join(firsts, whole, "left").withColumn("first", F.coalesce("first", F.lit(False)))
    pieces = materialize(marked.repartitionByRange(*whole).sortWithinPartitions(*whole)
                         .select("c", "cn", "t", "tn", "role", "text", "copies", "first").mapInArrow(_pieces(SEGMENT), PIECE), "turn-pieces")
    cut = pieces.where("found is null")
    order = ["c", "cn", "part", "seq"]
    chosen = materialize(cut.select(*order, "way", "tally").repartition("c", "cn").sortWithinPartitions(*order)
                         .mapInArrow(_choose, CHOSEN), "turn-ways")
    lines = (cut.select(*order, "rows").join(chosen.where("found is null").select(*order, "state", "own"), order)
             .mapInArrow(_render, "c long, cn boolean, part long, seq long, lines binary"))
    hashed = (lines.repartition("c", "cn").sortWithinPartitions(*order)
              .mapInArrow(_digest, "c long, cn boolean, sha string"))
    names = [n for n, _ in _FOUND]
    nothing = hashlib.sha256(b"").hexdigest()
    joined = chosen.where("found is not null").select("c", "cn", "found.*").join(hashed, ["c", "cn"], "left") \
        .withColumn("repaired_sha256", F.coalesce("sha", F.lit(nothing))).select("c", "cn", *names)
    got = pieces.where("found is not null").select("c", "cn", "found.*").unionByName(joined)
    every = (originals if originals is not None else rows).select("conv_id").distinct().select(
        F.col("conv_id").cast("long").alias("conv_id"), F.coalesce("conv_id", F.lit(0)).cast("long").alias("c"),
        F.col("conv_id").isNull().alias("cn"))
    zero = [F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in names[:6]]
    return every.join(got, ["c", "cn"], "left").select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
