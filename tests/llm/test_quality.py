"""Quality measures against plain Python."""

import random
import re

from storyloom.llm.quality import RULES, Rule, quality


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    win = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    hit = {p for i, g in enumerate(win) if win.count(g) > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit),
            n < 10 or 100 * len(hit) > 20 * n)


def test_measures_equal_plain_python(spark):
    r = random.Random(1)
    texts = [None, "", " \n\t", "one", "# * $ % & | < >", "a\x0bb\x0cc\rd", "é ü 漢字 😀", "x " * 3000,
             "a b c d e f " * 3, "same line\nsame line\n\nsame line ", "a b c d e a b c d e"]
    for _ in range(60):
        vocab = [f"w{i}" for i in range(r.choice([2, 5, 200]))]
        texts.append("".join(r.choice(vocab) + r.choice([" ", "  ", "\n", "\t"]) for _ in range(r.randint(1, 80))))
    df = spark.createDataFrame([(i, t, 1, "w") for i, t in enumerate(texts)], "doc_id long, text string, g int, w string")
    got = {x["doc_id"]: (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"],
                         x["base_failed"]) for x in quality(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_no_user_function_and_no_shuffle(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = quality(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_rules_name_what_failed(spark):
    prose = "the quick fox and the lazy dog went to the river in the morning of a long day"
    df = spark.createDataFrame([(1, prose), (2, prose + " " + "# " * 10), (3, "\n".join([prose] * 3)),
                                (None, prose), (5, "\n".join("- " + prose + f" {i}" for i in range(4)))],
                               "doc_id long, text string")
    got = {x["doc_id"]: (x["kept"], x["failed"]) for x in quality(df).collect()}
    assert got[1] == (True, []) and got[None] == (True, [])
    assert got[2] == (False, ["symbols"]) and not got[3][0] and "duplicate_lines" in got[3][1]
    own = quality(df.where("doc_id = 1"), RULES + (Rule("short", "n_words", most=3),)).first()
    assert own["failed"] == ["short"] and not own["kept"]
    assert quality(df.limit(0)).collect() == []
