"""Personal data and the terms that reveal it (operator 10), in DataFrame functions only.

*Base spans*: e-mail addresses, IPv4 addresses, payment card numbers (Luhn) and phone numbers, each
kind matched leftmost and without overlap; matches that fail their test are dropped.
The pattern forms below match what the plain forms match but read a run of characters once: possessive
repeats, and a look-behind that lets a match begin only at a run's start or where the last one ended.

*Offsets*: splitting a text at a pattern gives the gaps between its matches; a match starts where the
lengths of the gaps and matches before it add up to. Lengths are in code points.

*Revealing terms*: over all documents, for a protected entity e (a base value) and a term t (a word of
letters of any length, anywhere in the document),

    disclosure(t, e) = PMI(t; e) / IC(e) = log(c(t,e) N / (c(t) c(e))) / log(N / c(e))

with documents as the unit, the share of the information in e that t gives away: 1 if t never occurs
without e. A pair counts if t was seen in documents that hold e in at least ``MIN_CONTEXTS`` different surroundings
(``CONTEXT_CHARS`` characters on both sides of its first mention), so
copies of one passage are one observation. In documents that hold e, terms with a disclosure of
``REMOVE`` or more are removed; from ``GENERALISE`` on, they are cut to their first letter, or removed if
they have no other. Documents without personal data are never changed.

Counts combine before they are shuffled: a word, entity or passage of a third of all rows is one row a
task. The join back to the documents is on the id.

Defined results: a null or empty text has no spans. Rows with a null id get base spans only; rows that
repeat an id share the terms of that id. Other columns are kept as they are (``sanitise``) or ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storyloom.llm.storage import free_shuffles
from storyloom.operators.materialize import materialize

#: Kinds in the order of the digest, and their marks in sanitised text.
KINDS = ("email", "ip", "card", "phone")
MARKS = {k: f"[{k.upper()}]" for k in KINDS}
REMOVED = "[TERM]"
#: Before a term's pattern: not the word in a mark.
NO_MARK = r"(?!(?<=\\[)(?-i:%s)\\])" % "|".join(m[1:-1] for m in (*MARKS.values(), REMOVED))

PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Texts without these have no match of the kind.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"(?:[0-9][\x20-]?){13}[0-9]", "phone": r"\+[0-9]"}
TERM = r"\p{L}++"

CONTEXT_CHARS = 80
MIN_CONTEXTS = 3
GENERALISE = 0.7
REMOVE = 0.9


def _lit(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _valid(kind: str, t: str) -> str:
    """SQL: does the matched text ``t`` pass the kind's test?"""
    if kind == "email":
        return "true"
    if kind == "ip":
        return (f"forall(split({t}, '[.]'), p -> length(ltrim('0', p)) <= 3 "
                "AND coalesce(try_cast(ltrim('0', p) AS int), 0) <= 255)")
    digits = f"regexp_replace({t}, '[^0-9]+', '')"
    if kind == "phone":
        return f"length({digits}) BETWEEN 10 AND 15"
    return (f"length({digits}) BETWEEN 14 AND 19 AND aggregate(split(reverse({digits}), ''), "
            "named_struct('s', 0, 'i', 0), (a, c) -> named_struct('s', a.s + "
            "if(a.i % 2 = 0, coalesce(try_cast(c AS int), 0), "
            "if(coalesce(try_cast(c AS int), 0) > 4, 2 * coalesce(try_cast(c AS int), 0) - 9, "
            "2 * coalesce(try_cast(c AS int), 0))), 'i', a.i + 1), a -> a.s % 10 = 0)")


def _add_matches(df: DataFrame, patterns: dict[str, str | None]) -> DataFrame:
    """Columns ``m_name`` (matches) and ``g_name`` (gaps around them; one more) for each name in ``patterns``: a kind,
    or another name with a column of patterns. All names go into one projection, as each ``withColumn`` has the driver
    analyse the plan below it anew."""
    sql = {n: p or _lit(PATTERNS[n]) for n, p in patterns.items()}
    need = {n: f"text rlike {_lit(NEEDS[n])}" if p is None else f"{p} IS NOT NULL" for n, p in patterns.items()}
    found = df.withColumns({f"m_{n}": F.expr(f"CASE WHEN {need[n]} THEN regexp_extract_all(text, {p}, 0) END")
                            for n, p in sql.items()})
    return found.withColumns({f"g_{n}": F.expr(f"CASE WHEN size(m_{n}) > 0 THEN split(text, {p}, -1) END")
                              for n, p in sql.items()})


SPAN = "struct<s:bigint,k:int,e:bigint,t:string,around:string>"


def _in_blocks(name: str) -> Column:
    """An array cut into about sqrt(n) blocks of about sqrt(n) elements: folds that collect results over
    blocks, and over each block, copy n * sqrt(n) elements in all, not n * n."""
    wide = f"cast(ceil(sqrt(size({name}))) as int)"
    return F.expr(f"CASE WHEN size({name}) > 0 THEN transform(sequence(0, (size({name}) - 1) div {wide}), "
                  f"j -> slice({name}, j * {wide} + 1, {wide})) END")


def _locate(df: DataFrame, orders: dict[str, tuple[str, int]]) -> DataFrame:
    """From ``m_name`` and ``g_name``: adds ``at_name``, an array of (s, k, e, t, around) of the matches that pass the test of a
    kind, for each name in ``orders``, with that kind and k. A match's start is the sum of the lengths before it, of
    all blocks before its own and of what stands before it there."""
    half = CONTEXT_CHARS
    df = df.withColumns({f"parts_{n}": F.expr(
        f"zip_with(zip_with(m_{n}, slice(g_{n}, 1, size(m_{n})), (t, b) -> named_struct('t', t, 'b', b, 'n', length(t) + length(b))), "
        f"slice(g_{n}, 2, size(m_{n})), (x, a) -> named_struct('t', x.t, 'n', x.n, 'm', length(x.t), "
        f"'around', concat(right(x.b, {half}), ' ', left(a, {half}))))") for n in orders})
    df = df.withColumns({f"blocks_{n}": _in_blocks(f"parts_{n}") for n in orders})
    df = df.withColumns({f"begin_{n}": F.expr(
        f"aggregate(transform(blocks_{n}, b -> aggregate(b, 0L, (s, x) -> s + x.n)), named_struct('at', 0L, 'out', "
        "cast(array() AS array<bigint>)), (a, n) -> named_struct('at', a.at + n, 'out', concat(a.out, array(a.at))), a -> a.out)")
        for n in orders})
    return df.withColumns({f"at_{n}": F.expr(f"""
        CASE WHEN blocks_{n} IS NULL THEN cast(array() AS array<{SPAN}>) ELSE filter(flatten(zip_with(blocks_{n}, begin_{n}, (b, at) ->
          aggregate(b, named_struct('at', at, 'out', cast(array() AS array<{SPAN}>)),
            (a, x) -> named_struct('at', a.at + x.n, 'out', concat(a.out, array(named_struct(
              's', a.at + x.n - x.m, 'k', {order}, 'e', a.at + x.n, 't', x.t, 'around', x.around)))),
            a -> a.out))), x -> {_valid(kind, 'x.t')}) END""") for n, (kind, order) in orders.items()}) \
        .drop(*[f"{c}_{n}" for n in orders for c in ("m", "g", "parts", "blocks", "begin")])


def _base(docs: DataFrame) -> DataFrame:
    """``spans``: all base spans by start, then kind."""
    df = _locate(_add_matches(docs, dict.fromkeys(KINDS)), {k: (k, i) for i, k in enumerate(KINDS)})
    spans = F.array_sort(F.concat(*[f"at_{k}" for k in KINDS]))
    return df.withColumn("spans", spans).drop(*[f"at_{k}" for k in KINDS])


def _entity() -> Column:
    """The value of a span without case and separators."""
    return F.concat(F.col("x.k").cast("string"), F.lit(":"),
                    F.when(F.col("x.k") == 0, F.lower("x.t"))
                    .when(F.col("x.k") == 1, F.col("x.t"))
                    .otherwise(F.regexp_replace("x.t", "[^0-9]+", "")))


def _words(text: str) -> Column:
    """The different words of letters of a text, in lower case."""
    return F.explode(F.expr(f"array_distinct(regexp_extract_all(lower({text}), {_lit(TERM)}, 0))"))


def revealing_terms(docs: DataFrame, mentions: DataFrame) -> DataFrame:
    """``(entity, term, disclosure)`` of the terms that reveal an entity beyond GENERALISE.
    ``mentions``: (doc_id, entity, around), one of each entity in a document.

    As c(t,e) <= c(e), a disclosure of d or more means c(t) <= N^(1-d) c(e)^d; and a pair needs ``MIN_CONTEXTS``
    documents. So only terms within these bounds, and only entities of so many documents, are joined: common
    words of the corpus meet common entities at most. The bounds lose no pair."""
    n = docs.count()
    held = mentions.groupBy("entity").agg(F.count("*").alias("c_e")).where(F.col("c_e") >= MIN_CONTEXTS)
    of_doc = materialize(mentions.join(held, "entity")
                         .select("doc_id", "entity", "c_e", F.xxhash64(F.lower("around")).alias("context")), "holders")
    most = of_doc.agg(F.max("c_e")).first()[0]
    none = docs.sparkSession.createDataFrame([], "entity string, term string, disclosure double")
    if not most:
        return none

    def bound(c_e):  # a little more, as powers are rounded
        return 1.000001 * F.pow(F.lit(float(n)), F.lit(1 - GENERALISE)) * F.pow(c_e, F.lit(GENERALISE))
    spread = materialize(docs.select(_words("text").alias("term")).groupBy("term").agg(F.count("*").alias("c_t"))
                         .where((F.col("c_t") >= MIN_CONTEXTS) & (F.col("c_t") <= bound(F.lit(float(most))))), "terms")
    # an id may be on several rows
    said = (docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .join(of_doc.select("doc_id").distinct(), "doc_id", "left_semi")
            .select("doc_id", _words("text").alias("term")).distinct().join(spread, "term"))
    pair = (said.join(of_doc, "doc_id").where(F.col("c_t") <= bound(F.col("c_e")))
            .groupBy("entity", "term", "c_e", "c_t").agg(F.count("*").alias("both"), F.countDistinct("context").alias("contexts"))
            .where(F.col("contexts") >= MIN_CONTEXTS))
    score = F.log(F.col("both") * n / (F.col("c_t") * F.col("c_e"))) / F.nullif(F.log(n / F.col("c_e")), F.lit(0.0))
    return pair.select("entity", "term", score.alias("disclosure")).where(F.col("disclosure") >= GENERALISE)


def _mentions(rows: DataFrame) -> DataFrame:
    """``(doc_id, entity, around)``: the first mention of each entity in a document.

    Empty arrays are exploded to a null and dropped after it. A condition on the array itself, stated or inferred by a plain
    ``explode``, would move below the projections that build it, with all of them written out in it again and again."""
    return (_base(rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL"))
            .select("doc_id", F.explode_outer("spans").alias("x")).where("x IS NOT NULL")
            .groupBy("doc_id", _entity().alias("entity")).agg(F.min(F.struct("x.s", "x.k", "x.around")).alias("first"))
            .select("doc_id", "entity", F.col("first.around").alias("around")))


def find(docs: DataFrame) -> DataFrame:
    """Adds to ``docs(doc_id, text, ...)`` the columns ``spans`` (base: s, k, e, t, around) and
    ``terms`` (array<struct<term, removed>> of the document's revealing terms, or null)."""
    rows = docs.withColumn("text", F.coalesce("text", F.lit("")))
    mentions = materialize(_mentions(rows), "mentions")
    free_shuffles(docs.sparkSession)  # here and below also what the driver needed to plan the step
    of_doc = materialize(
        mentions.select("doc_id", "entity").join(revealing_terms(rows, mentions), "entity")
        .groupBy("doc_id", "term").agg((F.max("disclosure") >= REMOVE).alias("removed"))
        .groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("term", "removed"))).alias("terms")), "terms")
    free_shuffles(docs.sparkSession)
    own = of_doc.withColumnRenamed("doc_id", "terms_of")
    return _base(rows).join(own, F.col("doc_id").cast("long") == F.col("terms_of"), "left").drop("terms_of")


def _term_pattern(which: str = "true") -> str:
    """SQL: a pattern of the row's terms as whole words (letters only, so nothing to quote)."""
    return ("CASE WHEN exists(terms, x -> {w}) THEN concat('(?iu)(?<![\\\\p{{L}}])(?:', array_join(transform("
            "filter(terms, x -> {w}), x -> x.term), '|'), ')(?![\\\\p{{L}}])') END").format(w=which)


def spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)``: base and term spans, by start, then kind (term last): s, k, e, t."""
    found = find(docs.select("doc_id", "text")).withColumn("pattern", F.expr(_term_pattern()))
    found = _locate(_add_matches(found, {"term": "pattern"}), {"term": ("email", len(KINDS))})  # a term needs no test
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("spans").alias("base"),
                        F.array_sort(F.concat("spans", "at_term")).alias("spans"))


def _joined(column: str) -> Column:
    names = ", ".join(f"'{k}'" for k in (*KINDS, "term"))
    return F.expr(f"array_join(transform({column}, x -> concat(array({names})[x.k], ':', x.s, ':', x.e)), ',')")


def digest(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term)``."""
    found = spans(docs)
    return found.select(
        "doc_id", *[F.expr(f"size(filter(base, x -> x.k = {i}))").cast("long").alias(f"n_{k}")
                    for i, k in enumerate(KINDS)],
        F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"),
        F.expr(f"size(filter(spans, x -> x.k = {len(KINDS)}))").cast("long").alias("n_term"))


def sanitise(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced by marks and revealing terms generalised or
    removed; all columns are kept, and ``n_chars``, if present, is counted again."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    found = _cuts(find(docs.select("doc_id", "text", F.struct(*[f"`{c}`" for c in rest]).alias("rest") if rest
                                   else F.lit(None).cast("int").alias("rest"))))
    done = None
    # a cut may set a span free that failed its test with its neighbour. This ends: a cut takes a letter, digit or @ that
    # is in no mark away, and marks hold nothing to cut
    while True:
        found = materialize(_cuts(_base(_without_cuts(found)), NO_MARK), "sanitised")
        free_shuffles(docs.sparkSession)
        clean = found.where("size(cuts) = 0")
        done = clean if done is None else done.unionByName(clean)
        found = found.where("size(cuts) > 0")
        if found.isEmpty():
            break
    count = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in rest else {}
    return done.select(*[F.col(c) if c not in rest else count.get(c, F.col(f"rest.`{c}`")).alias(c)
                         for c in docs.columns])


def _cuts(found: DataFrame, guard: str = "") -> DataFrame:
    """``cuts`` in place of ``spans``: what must go from the text, as disjoint (s, e, k, t) in order. Spans that
    overlap are one; it has the kind of the longest base span in it. Kinds after KINDS: removed, cut terms.
    A term of one letter is removed, as a cut to its first letter leaves it whole, to be found in the next pass again."""
    whole = "(x.removed OR length(x.term) = 1)"
    df = found.withColumns({f"p_{i}": F.expr(f"concat('{guard}', {_term_pattern(which)})")
                            for i, which in enumerate((whole, f"NOT {whole}"))})
    df = _locate(_add_matches(df, {"0": "p_0", "1": "p_1"}), {str(i): ("email", len(KINDS) + i) for i in (0, 1)}).drop("p_0", "p_1")
    one = "struct<s:bigint,e:bigint,k:int,t:string,n:bigint>"
    none = f"cast(array() AS array<{one}>)"
    # the open span goes from block to block; closed ones are collected by block
    merged = F.expr(f"""
        CASE WHEN blocks IS NULL THEN {none} ELSE
        aggregate(blocks, named_struct('done', cast(array() AS array<array<{one}>>), 'last', cast(null AS {one})),
          (b, block) -> aggregate(block, named_struct('out', {none}, 'last', b.last),
            (a, y) -> aggregate(array(named_struct('s', y.s, 'e', y.e, 'k', y.k, 't', y.t,
                                                   'n', if(y.k < {len(KINDS)}, y.e - y.s, 0L))), a,
              (a2, x) -> CASE WHEN a2.last IS NULL THEN named_struct('out', a2.out, 'last', x)
               WHEN x.s >= a2.last.e THEN named_struct('out', concat(a2.out, array(a2.last)), 'last', x)
               ELSE named_struct('out', a2.out, 'last', named_struct(
                  's', a2.last.s, 'e', greatest(a2.last.e, x.e), 'k', if(x.n > a2.last.n, x.k, a2.last.k),
                  't', if(x.n > a2.last.n, x.t, a2.last.t), 'n', greatest(a2.last.n, x.n))) END),
            a -> named_struct('done', concat(b.done, array(a.out)), 'last', a.last)),
          b -> concat(flatten(b.done), array(b.last))) END""")
    return df.withColumn("every", F.array_sort(F.concat("spans", "at_0", "at_1"))) \
        .withColumn("blocks", _in_blocks("every")).withColumn("cuts", merged).drop("spans", "every", "blocks", "at_0", "at_1")


def _without_cuts(df: DataFrame) -> DataFrame:
    """``text`` with its ``cuts`` replaced, in one pass over the text they were located in. The text is first cut into
    the stretches of blocks of cuts, as finding a place in a long text means reading it up to there."""
    marks = ", ".join(f"'{m}'" for m in (*MARKS.values(), REMOVED))
    wide = "cast(ceil(sqrt(size(cuts))) as int)"
    begin = f"if(j = 0, 0L, cuts[greatest(j * {wide} - 1, 0)].e)"
    df = df.withColumn("blocks", _in_blocks("cuts")).withColumn("pieces", F.expr(f"""
        transform(blocks, (b, j) -> named_struct('b', b, 'at', {begin},
            'text', substring(text, cast({begin} + 1 AS int), cast(element_at(b, -1).e - {begin} AS int))))"""))
    return df.withColumn("text", F.expr(f"""CASE WHEN blocks IS NULL THEN text ELSE concat(
        array_join(transform(pieces, p -> array_join(transform(p.b, (x, i) -> concat(
            substring(p.text, cast(if(i = 0, p.at, p.b[greatest(i - 1, 0)].e) - p.at + 1 AS int),
                      cast(x.s - if(i = 0, p.at, p.b[greatest(i - 1, 0)].e) AS int)),
            if(x.k > {len(KINDS)}, concat(left(x.t, 1), '***'), get(array({marks}), x.k)))), '')), ''),
        substring(text, cast(element_at(cuts, -1).e + 1 AS int))) END""")).drop("blocks", "pieces", "cuts")
