"""Line dedup against all pairs of lines in plain Python."""

import random
import re

from storyloom.llm import line_dedup
from storyloom.llm.line_dedup import dedup_lines, keep_first_lines


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    short, long_ = sorted((a, b), key=len)
    return any(long_[:i] + long_[i + 1:] == short for i in range(len(long_)))


def brute(rows):
    seen, gone = [], []
    every = sorted((d, k, re.sub(r"[\x20\x09-\x0D]+", " ", part).strip(" "))
                   for d, t in rows if t is not None for k, part in enumerate(t.split("\n")))
    for d, k, line in every:
        if not line:
            continue
        w = line.split(" ")
        if any(line == o or (len(w) >= 10 and len(o.split(" ")) >= 10 and one_edit(w, o.split(" "))) for o in seen):
            gone.append((d, k))
        seen.append(line)
    out = {}
    for d, t in rows:
        out[d] = None if t is None else "\n".join(p for k, p in enumerate(t.split("\n")) if (d, k) not in gone)
    return out


def texts(seed):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)]
    base = [[r.choice(vocab) for _ in range(r.choice([4, 9, 10, 11, 12, 25]))] for _ in range(12)]
    rows = []
    for d in range(40):
        lines = []
        for _ in range(r.randint(0, 5)):
            w = list(r.choice(base))
            kind = r.random()
            if kind < 0.3:
                w[r.randrange(len(w))] = r.choice(vocab)
            elif kind < 0.45:
                w.insert(r.randrange(len(w) + 1), r.choice(vocab))
            elif kind < 0.6:
                w.pop(r.randrange(len(w)))
            elif kind < 0.7:
                w.append(w.pop(0))
            lines.append((" " if r.random() < 0.8 else "\t ").join(w))
        if r.random() < 0.3:
            lines.insert(r.randrange(len(lines) + 1), "")
        rows.append((d, "\n".join(lines)))
    return rows


def test_same_lines_as_all_pairs(spark):
    for seed in (1, 2, 3):
        rows = texts(seed) + [(50, None), (51, ""), (52, "\n \n"), (53, "a a a a a a a a a a\na a a a a a a a a a a")]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r["doc_id"]: r["text"] for r in dedup_lines(df.repartition(3)).collect()}
        assert got == brute(rows)


def test_every_place_of_an_edit_is_found(spark):
    base = [f"v{i}" for i in range(11)]
    rows = []
    for k in range(11):
        one = [f"r{k}x{w}" for w in base]
        rows += [(len(rows), " ".join(one)), (len(rows) + 1, " ".join(one[:k] + ["new"] + one[k + 1:])),
                 (len(rows) + 2, " ".join(one[:k] + ["extra"] + one[k:])), (len(rows) + 3, " ".join(one[:k] + one[k + 1:]))]
    one = [f"end{w}" for w in base]
    rows += [(100, " ".join(one)), (101, " ".join(one + ["extra"])), (102, " ".join(one[1:] + one[:1]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in dedup_lines(df).collect()}
    assert got == brute(rows)
    assert [d for d, t in got.items() if t] == [4 * k for k in range(11)] + [100, 102]


def test_many_ids_are_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 0)
    rows = texts(4)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in dedup_lines(df).collect()} == brute(rows)


def test_other_columns_stay_and_emptied_documents_go(spark):
    rows = [(1, "some line of text", 17, "p"), (2, "some line of text", 17, "q"), (3, "", 0, "r"),
            (4, "some line of text\nnew", 21, "s"), (None, "null id", 7, "t"), (4, "some line of text\nnew", 21, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, gone string")
    kept = keep_first_lines(df)
    assert kept.columns == df.columns and kept.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    assert sorted([tuple(r) for r in kept.collect()], key=str) == sorted(
        [rows[0], rows[2], (4, "new", 3, "s"), (4, "new", 3, "s"), rows[4]], key=str)
    assert keep_first_lines(df.limit(0)).collect() == []


def brute_rows(rows):
    """The kept text of each row, where ids repeat or are null: a line goes for one at an earlier (id, number)."""
    every = [(-1 if d is None else d, k, re.sub(r"[\x20\x09-\x0D]+", " ", part).strip(" "))
             for d, t in rows for k, part in enumerate(t.split("\n"))]
    def same(a, b):
        return a == b or (min(len(a.split(" ")), len(b.split(" "))) >= 10 and one_edit(a.split(" "), b.split(" ")))
    first = {}
    for d, k, line in every:
        first[line] = min(first.get(line, (d, k)), (d, k))
    near = {a for a in first if any(first[b] < first[a] and same(a, b) for b in first if a and b)}
    gone = {(d, k, line) for d, k, line in every if line and (line in near or (d, k) > first[line])}
    out = []
    for d, t in rows:
        i = -1 if d is None else d
        out.append((d, "\n".join(p for k, p in enumerate(t.split("\n"))
                                 if (i, k, re.sub(r"[\x20\x09-\x0D]+", " ", p).strip(" ")) not in gone)))
    return out


def test_repeated_and_null_ids_with_different_texts(spark):
    near = " ".join(f"w{i}" for i in range(12))
    rows = [(None, near + "\nown line"), (None, "short one\n" + near + " more"), (None, "other\nclean line here"),
            (None, "other\nclean line here"), (3, near + " again"), (3, "unique text"), (3, "x y\nz"),
            (4, near.replace("w3", "v")), (4, "kept too")]
    kept = sorted(map(str, brute_rows(rows)))
    got = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(str((r["doc_id"], r["text"])) for r in dedup_lines(got).collect()) == kept
    assert str((None, "other\nclean line here")) in kept and str((3, "unique text")) in kept and str((4, "kept too")) in kept
    for seed in (5, 6):
        r = random.Random(seed)
        rows = [(r.choice([None, None, 1, 2, d]), t) for d, t in texts(seed)]
        got = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        assert sorted(str((x["doc_id"], x["text"])) for x in dedup_lines(got).collect()) == sorted(map(str, brute_rows(rows)))
