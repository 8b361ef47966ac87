"""Line dedup (operator 3), in DataFrame functions only: a deletion-neighbourhood join.

Lines are compared by their words (white space collapsed). Two lines are duplicates if they are equal,
or, with ``MIN_WORDS`` words or more, if their edit distance over words is at most one (a word replaced,
inserted or left out). A line is dropped if an earlier one (by document id, then line number) is its duplicate.

1. *Equal lines* share a 128-bit hash; the earliest of each is found by a minimum that combines before the
   shuffle, so a line of a third of all documents is one row a task.
2. *Blocks.* Variants are emitted only where they can meet another line's. One edit leaves the first or the
   last half of ``MIN_WORDS`` words as it was: distinct lines that share neither with another one end here. Of
   the rest, each line is cut into ``PARTS`` parts, and the hash of the line without a part must be shared;
   only the words of such parts are left out one by one. An edit lies in some part, so no pair is lost.
3. *Neighbourhood.* A line's hash is a sum of hashes of its words, so a variant with one word left out costs
   one subtraction whatever the line's length. For a replaced word the words' hashes depend on their
   positions, which stay; for an inserted one they don't, and the longer line's variant is looked up among
   the hashes of whole lines.
4. *Join.* Lines equal but for word i meet in one group; each is paired with the group's earliest, never
   with each other. Variants of longer lines meet the line they are equal to.
5. *Verify.* Pairs are kept if the words' common beginning and end cover all but one word.

Groups are reduced by minima and joined back, so no group is collected and skewed joins can be split. Texts
are picked by a broadcast of ids only if these are few (``BROADCAST_LINES``), else by a shuffle.

A line is known by its hash; its place, which rows that repeat an id or have none share, only orders it.

Defined results: blank lines stay. A null text stays null; an empty one stays empty. Rows that repeat an
id and text share their decisions; lines with the same id and number in different texts are equally
early, and both stay. A null id comes first. Other columns stay as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.storage import free_shuffles
from storyloom.operators.materialize import materialize

MIN_WORDS = 10
#: Parts of a line whose rest must be shared before their words are left out.
PARTS = 4
#: Line numbers that may be broadcast to pick lines from the documents; more are joined by a shuffle.
BROADCAST_LINES = 1_000_000
MASK = (1 << 62) - 1


def _sum(x: str) -> str:
    """SQL: the sum of an array of longs, modulo 2**62."""
    return f"aggregate({x}, 0L, (a, y) -> (a + y) & {MASK}L)"


def _rows(docs: DataFrame) -> DataFrame:
    """One row per document with its key."""
    return docs.select(F.xxhash64("doc_id", "text").alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), "text")


def _normal(line: str) -> str:
    """SQL: white space collapsed; most lines need no change, which plain searches tell."""
    odd = " OR ".join(f"contains({line}, {c})" for c in ("'  '", *(f"chr({k})" for k in (9, 11, 12, 13))))
    return (f"CASE WHEN {odd} THEN trim(regexp_replace({line}, '[\\\\x20\\\\x09-\\\\x0D]+', ' ')) "
            f"ELSE trim({line}) END")


def _place(no: str):
    """Where a line stands: earlier lines have smaller numbers."""
    return (F.coalesce("doc_id", F.lit(-(1 << 63))).cast("decimal(38,0)") * F.lit(1 << 32).cast("decimal(11,0)")
            + F.col(no)).cast("decimal(38,0)")


def lines(docs: DataFrame) -> DataFrame:
    """``(doc, no, place, h1, h2, n, head, tail)`` of each line that is not blank."""
    half = MIN_WORDS // 2
    each = _rows(docs).select("doc", "doc_id", F.posexplode(F.split("text", "\n")).alias("no", "raw")) \
        .select("doc", "no", _place("no").alias("place"), F.expr(_normal("raw")).alias("line")).where("line <> ''")
    n = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    return each.select("doc", "no", "place", F.xxhash64("line").alias("h1"),
                       F.xxhash64(F.lit(1), "line").alias("h2"), n.alias("n"),
                       F.xxhash64(F.substring_index("line", " ", half)).alias("head"),
                       F.xxhash64(F.substring_index("line", " ", -half)).alias("tail"))


def _near_candidates(distinct: DataFrame) -> DataFrame:
    """``(h1, h2)`` of the distinct lines that share their first or last words with another one."""
    keyed = distinct.where(F.col("n") >= MIN_WORDS).select(
        "h1", "h2", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("head").alias("key")),
                                   F.struct(F.lit(1).alias("side"), F.col("tail").alias("key")))).alias("x")) \
        .select("h1", "h2", "x.side", "x.key")
    shared = keyed.groupBy("side", "key").agg(F.count("*").alias("lines")).where("lines > 1").select("side", "key")
    return keyed.join(shared, ["side", "key"]).select("h1", "h2").distinct()


def _hashed(words: DataFrame) -> DataFrame:
    """``(id, place, n, h, u, th, tu)``: the words' hashes with and without their position, and their sums."""
    return words.select(
        "id", "place", F.size("w").alias("n"),
        F.expr(f"transform(w, (x, k) -> xxhash64(x, k) & {MASK}L)").alias("h"),
        F.expr(f"transform(w, x -> xxhash64(x) & {MASK}L)").alias("u")) \
        .withColumns({"th": F.expr(_sum("h")), "tu": F.expr(_sum("u"))})


def _parts(hashed: DataFrame) -> DataFrame:
    """``(id, kind, m, k, role, v)``: each line without its part k. Kind 0 is for replaced words; kind 1
    for inserted ones, where a line is the shorter (role 0) and the longer (role 1, a word more in each part)
    of lines of m and m + 1 words."""
    rows = []
    for k in range(PARTS):
        for kind, m, x, role in ((0, "n", "h", 0), (1, "n", "u", 0), (1, "(n - 1)", "u", 1)):
            first, end = f"({m} * {k} div {PARTS})", f"({m} * {k + 1} div {PARTS})"
            part = f"slice({x}, cast({first} + 1 AS int), cast({end} - {first} + {role} AS int))"
            rows.append(f"named_struct('kind', {kind}, 'm', {m}, 'k', {k}, 'role', {role}, "
                        f"'v', (t{x} - {_sum(part)}) & {MASK}L)")
    return hashed.select("id", F.explode(F.expr(f"array({', '.join(rows)})")).alias("x")).select("id", "x.*")


def _variants(hashed: DataFrame) -> DataFrame:
    """``(id, place, kind, m, i, v)``: the lines without one word, for the words of parts whose rest is shared."""
    parts = materialize(_parts(hashed), "parts")
    shared = parts.groupBy("kind", "m", "k", "v").agg(
        F.min("id").alias("i0"), F.max("id").alias("i1"), F.min("role").alias("r0"), F.max("role").alias("r1")) \
        .where("if(kind = 0, i0 < i1, r0 < r1)").select("kind", "m", "k", "v")
    open_parts = parts.where("kind = 0 or role = 1").join(shared, ["kind", "m", "k", "v"]) \
        .groupBy("id").agg(F.collect_set(F.struct("kind", "m", "k")).alias("parts"))  # 2 * PARTS at most
    which = f"sequence(cast(x.m * x.k div {PARTS} AS int), cast(x.m * (x.k + 1) div {PARTS} + x.kind - 1 AS int))"
    return hashed.join(open_parts, "id") \
        .select("id", "place", "h", "u", "th", "tu", F.explode("parts").alias("x")) \
        .select("id", "place", "x.kind", "x.m", "h", "u", "th", "tu", F.explode(F.expr(which)).alias("i")) \
        .select("id", "place", "kind", "m", "i", F.expr(
            f"if(kind = 0, th - h[i], tu - u[i]) & {MASK}L").alias("v"))


def _near(words: DataFrame) -> DataFrame:
    """Pairs ``(id, earlier)`` of lines ``(id, place, w)`` within one edit, verified. Places only say which is earlier."""
    hashed = _hashed(words)
    v = materialize(_variants(hashed), "variants")
    one = v.where("kind = 0").select("id", "place", "m", "i", "v")
    group = one.groupBy("m", "i", "v").agg(F.min("place").alias("p0"), F.max("place").alias("p1"),
                                           F.min_by("id", "place").alias("earlier")) \
        .where("p0 < p1").drop("p1")
    replaced = one.join(group, ["m", "i", "v"]).where("place > p0").select("id", "earlier")
    whole = hashed.select(F.col("id").alias("short"), F.col("place").alias("at"), F.col("n").alias("m"), F.col("tu").alias("v"))
    inserted = v.where("kind = 1").select("id", "place", "m", "v").distinct().join(whole, ["m", "v"]) \
        .where("place <> at").select(F.expr("if(place > at, id, short)").alias("id"),
                                     F.expr("if(place > at, short, id)").alias("earlier"))
    pairs = replaced.unionByName(inserted).distinct()
    same = "coalesce(nullif(array_position(zip_with({0}, {1}, (x, y) -> coalesce(x <> y, true)), true), 0) - 1, greatest(size({0}), size({1})))"
    return (pairs.join(words.select("id", "w"), "id")
            .join(words.select(F.col("id").alias("earlier"), F.col("w").alias("e")), "earlier")
            .where(f"{same.format('w', 'e')} + {same.format('reverse(w)', 'reverse(e)')} >= greatest(size(w), size(e)) - 1")
            .select("id", "earlier"))


def _few(table: DataFrame, numbers: str) -> DataFrame:
    """The table, to be broadcast if its arrays hold few line numbers in all."""
    held = table.agg(F.coalesce(F.sum(F.size(numbers) + 1), F.lit(0))).first()[0]
    return F.broadcast(table) if held <= BROADCAST_LINES else table


def dropped_lines(docs: DataFrame) -> DataFrame:
    """``(doc, gone, near)``: of each document that loses lines, their numbers, and how many of them
    had no equal earlier line but a near one."""
    every = materialize(lines(docs), "lines")
    # one row per distinct line, at its earliest place, in one document that has it there
    distinct = materialize(every.groupBy("h1", "h2").agg(
        F.min("place").alias("place"), F.min_by("doc", "place").alias("doc"), F.first("n").alias("n"),
        F.first("head").alias("head"), F.first("tail").alias("tail")), "distinct-lines")
    # numbered, as lines of rows that repeat an id, or have none, share places
    candidates = materialize(distinct.join(_near_candidates(distinct), ["h1", "h2"])
                             .select("h1", "h2", "place", "doc", F.monotonically_increasing_id().alias("id")), "near-candidates")
    no = F.pmod("place", F.lit(1 << 32).cast("decimal(11,0)")).cast("int").alias("no")
    where = materialize(candidates.groupBy("doc").agg(F.collect_list(F.struct(no, "id", "place")).alias("at")), "near-places")
    free_shuffles(docs.sparkSession)
    words = materialize(
        _rows(docs).select("doc", "text").join(_few(where, "at"), "doc")
        .select(F.expr("transform(array(split(text, '\\n')), parts -> transform(at, x -> "
                       "named_struct('id', x.id, 'place', x.place, 'raw', parts[x.no])))[0]").alias("at"))
        .select(F.explode("at").alias("x"))
        .select("x.id", "x.place", F.split(F.expr(_normal("x.raw")), " ").alias("w")), "words")  # twice if a row repeats
    near = materialize(_near(words).select("id").distinct(), "near")
    free_shuffles(docs.sparkSession)
    found = candidates.join(near, "id").select("h1", "h2", F.lit(True).alias("near"))
    verdict = materialize(distinct.join(found, ["h1", "h2"], "left").select(
        "h1", "h2", F.col("place").alias("first"), F.coalesce("near", F.lit(False)).alias("near")), "verdicts")
    gone = every.select("doc", "no", "place", "h1", "h2").join(verdict, ["h1", "h2"]).where("near or place > first")
    return materialize(
        gone.select("doc", "no", (F.col("near") & (F.col("place") == F.col("first"))).cast("long").alias("near"))
        .distinct().groupBy("doc").agg(F.collect_list("no").alias("gone"), F.sum("near").alias("near")), "gone")


def _kept_text() -> str:
    """SQL: the lines whose numbers are not in ``gone``, in order."""
    return """CASE WHEN gone IS NULL THEN text ELSE transform(array(split(text, '\\n')), parts -> array_join(
        transform(array_except(sequence(0, size(parts) - 1), gone), k -> parts[k]), '\\n'))[0] END"""


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents without their dropped lines, ``n_chars`` (if present) counted again, plus
    ``n_lines``, ``n_dropped``, ``n_near`` in a struct column ``line_dedup``."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select(F.xxhash64("doc_id", "text").alias("doc"), "doc_id", "text",
                       F.struct(*[f"`{c}`" for c in rest]).alias("rest") if rest else F.lit(None).alias("rest"))
    full = rows.join(_few(dropped_lines(docs), "gone"), "doc", "left") \
        .withColumn("kept", F.expr(_kept_text()))
    count = {"n_chars": F.length("kept").cast(docs.schema["n_chars"].dataType)} if "n_chars" in rest else {}
    n_lines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    stats = F.struct(F.coalesce(n_lines, F.lit(0)).cast("long").alias("n_lines"),
                     F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
                     F.coalesce("near", F.lit(0)).cast("long").alias("n_near"))
    return full.select(*[F.col("kept").alias("text") if c == "text" else F.col(c) if c == "doc_id"
                         else count.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns],
                       stats.alias("line_dedup"))


def keep_first_lines(docs: DataFrame) -> DataFrame:
    """The documents without dropped lines; documents that had words and lost all of them go."""
    out = dedup_lines(docs)
    emptied = (F.col("line_dedup.n_dropped") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return out.where(~F.coalesce(emptied, F.lit(False))).drop("line_dedup")
