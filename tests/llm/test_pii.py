"""Personal data and revealing terms against plain Python."""

import hashlib
import math
import random
import re

from storyloom.llm import pii

KINDS = ("email", "ip", "card", "phone")
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def passes(kind, t):
    d = re.sub("[^0-9]", "", t)
    return {"email": True, "ip": all(int(p) <= 255 for p in t.split(".")) if kind == "ip" else None,
            "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]


def base(text):
    return sorted((m.start(), k, m.end(), m.group()) for k, kind in enumerate(KINDS)
                  for m in re.finditer(PLAIN[kind], text or "") if passes(kind, m.group()))


def entity(k, t):
    return (k, t.lower() if k == 0 else t if k == 1 else re.sub("[^0-9]", "", t))


def around(text, s, e, matches):
    before = max([m.end() for m in matches if m.end() <= s], default=0)
    after = min([m.start() for m in matches if m.start() >= e], default=len(text))
    return text[max(before, s - 80):s] + " " + text[e:min(after, e + 80)]


def revealing(rows):
    """{doc: {term: removed}} by the definition, over all documents."""
    first, said, docs_of = {}, {}, {}
    for d, t in rows:
        terms = set(re.findall(r"[^\W\d_]+", (t or "").lower()))
        for term in terms:
            docs_of[term] = docs_of.get(term, 0) + 1
        said.setdefault(d, set()).update(terms)
        for s, k, e, m in base(t):
            ctx = around(t, s, e, list(re.finditer(PLAIN[KINDS[k]], t))).lower()
            first.setdefault(entity(k, m), {}).setdefault(d, ctx)
    out = {}
    for ent, contexts in first.items():
        for term in set().union(*(said[d] for d in contexts)):
            both = [d for d in contexts if term in said[d]]
            n, ce = len(rows), len(contexts)
            if len({contexts[d] for d in both}) >= 3 and n > ce:
                score = math.log(len(both) * n / (docs_of[term] * ce)) / math.log(n / ce)
                if score >= 0.7:
                    for d in contexts:
                        out.setdefault(d, {})[term] = out.get(d, {}).get(term, False) or score >= 0.9
    return out


def corpus():
    r = random.Random(8)
    vocab = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "theta"]
    rows = []
    for d in range(80):
        w = [r.choice(vocab) for _ in range(r.randint(5, 30))]
        if d % 9 == 0:
            w[2:2] = ["Müllername", f"jo.hn+{d % 2}@Mail-x.example.com", r.choice(vocab), "projektx"]
        if d % 7 == 0:
            w.append(r.choice(["10.0.0.1", "256.1.1.1", "1.2.3.4.5.6.7.8", "001.002.003.0255"]))
        if d % 5 == 0:
            w.append(r.choice(["4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (415) 555-0100", "+12 34", "+49 30 1234567 "]))
        rows.append((d, r.choice([" ", "\n"]).join(w)))
    rows += [(200, None), (201, ""), (202, "é😀 a@b.c_d@e.f x@y@d.e a@b c@d.e. 1.1.1.1@2.2.2.2"),
             (203, "a" * 3000 + "@" + "b" * 3000 + " " + "1" * 4000), (204, "+1" * 50 + "4155550100 +4155550100"),
             (205, "9" * 30 + "-4111111111111111 4111111111111111"), (206, "müllername alone here"),
             (207, "1.2.3.4 " * 200)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, len(t or ""), "k", 5) for d, t in rows],
                                 "doc_id long, text string, n_chars long, spans string, m int")


def test_base_spans_equal_plain_matching(spark):
    rows = corpus()
    got = {r["doc_id"]: r for r in pii.digest(frame(spark, rows)).collect()}
    for d, t in rows:
        want = base(t)
        text = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in want)
        r = got[d]
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(sum(x[1] == k for x in want) for k in range(4)), d
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest(), d
        assert set(filter(None, text.split(","))) <= set(r["spans"].split(","))


def test_terms_are_those_of_the_definition(spark):
    rows = corpus()
    want = revealing(rows)
    assert any(want.values())
    got = {r["doc_id"]: {x["term"]: x["removed"] for x in r["terms"] or []}
           for r in pii.find(frame(spark, rows).select("doc_id", "text")).collect()}
    assert {d: t for d, t in got.items() if t} == {d: t for d, t in want.items() if t}


def test_sanitised_texts_hold_no_personal_data_and_clean_ones_are_untouched(spark):
    rows = corpus()
    df = frame(spark, rows)
    out = pii.sanitise(df)
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    got = {r["doc_id"]: r for r in out.collect()}
    terms = revealing(rows)
    for d, t in rows:
        r = got[d]
        assert (r["spans"], r["m"]) == ("k", 5) and r["n_chars"] == len(r["text"] or "")
        if not base(t):
            assert (r["text"] or "") == (t or "")
        else:
            assert not [x for x in base(r["text"]) if x[3] in t], d
            for term in terms.get(d, {}):
                assert not re.search(rf"(?<![^\W\d_]){term}(?![^\W\d_])", r["text"].lower())


def test_spans_that_overlap_are_cut_whole_from_the_original_text(spark):
    rows = [(1, "call +33.1.42.68.53.00 now"), (2, "é +1 415 555 0100 10.0.0.1 x"), (3, "1.1.1.1@2.2.2.2 +1.2.3.4.5678901"),
            (4, "a 4111 1111 1111 1111, b@c.de"), (5, None)]
    got = {r["doc_id"]: r["text"] for r in pii.sanitise(frame(spark, rows)).collect()}
    # in 2, the phone passes its test only when the address after it has gone
    assert got == {1: "call [PHONE] now", 2: "é [PHONE] [IP] x", 3: "[EMAIL] [PHONE]", 4: "a [CARD], [EMAIL]", 5: ""}


def test_terms_that_are_words_of_marks(spark):
    words = ["alpha", "beta", "gamma", "delta"]
    rows = [(d, f"the {w} email term jo@x.de") for d, w in enumerate(words)] + [(d, "other words here") for d in range(10, 60)]
    got = {r["doc_id"]: r["text"] for r in pii.sanitise(frame(spark, rows)).collect()}
    assert all(got[d].endswith("[TERM] [TERM] [EMAIL]") for d in range(4))


def test_repeats_null_ids_and_no_rows(spark):
    rows = [(None, "x me@a.example y"), (1, "a@b.example"), (1, "a@b.example"), (2, "none")]
    got = sorted((str(r["doc_id"]), r["n_email"]) for r in pii.digest(frame(spark, rows)).collect())
    assert got == [("1", 1), ("1", 1), ("2", 0), ("None", 1)]
    assert pii.digest(frame(spark, rows).limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = pii.digest(frame(spark, corpus()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_name_far_from_its_address_and_short_names(spark):
    rows = [(d, f"Signed by Ng Okonkwoski.\n{'filler words ' * 20}{'abcdefg'[d]}{d} reach me at jo@x.example {d}") for d in range(7)]
    rows += [(d, f"filler words reach me at signed by {d}") for d in range(10, 200)]
    got = {r["doc_id"]: {x["term"] for x in r["terms"] or []} for r in pii.find(frame(spark, rows).select("doc_id", "text")).collect()}
    assert all(got[d] == {"ng", "okonkwoski", "jo", "x", "example"} for d in range(7))
    assert not any(got[d] for d in range(10, 200)) and got == {d: set(revealing(rows).get(d, {})) for d, _ in rows}


def test_one_text_with_many_addresses(spark):
    text = " ".join(f"user{i}@mail.example 10.0.{i % 256}.{i // 256}" for i in range(1000))
    df = frame(spark, [(1, text)])
    (r,) = pii.digest(df).collect()
    want = base(text)
    assert (r["n_email"], r["n_ip"]) == (1000, 1000)
    assert r["base_sha256"] == hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, _ in want).encode()).hexdigest()
    (r,) = pii.sanitise(df).collect()
    assert r["text"] == " ".join(["[EMAIL] [IP]"] * 1000)


def test_plan_of_mentions_does_not_repeat_its_projections(spark):
    """Each pattern is looked for once, so that the plan and its code stay small; texts without a match have no rows."""
    rows = spark.createDataFrame([(1, "a@b.de and 1.2.3.4"), (2, "none"), (3, ""), (None, "c@d.de")], "doc_id long, text string")
    found = pii._mentions(rows)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") <= 2 * len(pii.KINDS) and len(plan) < 40_000
    assert {(r["doc_id"], r["entity"]) for r in found.collect()} == {(1, "0:a@b.de"), (1, "1:1.2.3.4")}


def test_driver_analyses_few_projections(spark):
    """All kinds share their projections: with one or more a kind and step, the driver's memory for the plan of a pass of
    ``sanitise`` was several times the present one."""
    rows = spark.createDataFrame([(1, "a@b.de or +49 30 1234567, 1.2.3.4 and 4111 1111 1111 1111", None)],
                                 "doc_id long, text string, terms array<struct<term: string, removed: boolean>>")
    found = pii._cuts(pii._base(rows))
    assert found._jdf.queryExecution().analyzed().toString().count("Project [") <= 25
    assert [x["t"] for x in found.first()["cuts"]] == ["a@b.de", "+49 30 1234567", "1.2.3.4", "4111 1111 1111 1111"]


def test_terms_of_one_letter_do_not_come_back_pass_after_pass(spark, monkeypatch):
    """Cut to its first letter, such a term stays whole: it was found and cut again in each pass, without an end."""
    passes = []

    def materialize(df, label):
        passes.append(label)
        assert passes.count("sanitised") < 6
        return write(df, label)
    write = pii.materialize
    monkeypatch.setattr(pii, "materialize", materialize)
    rows = [(d, f"{'abcdefg'[d] * 3}{d} Q and qrs said jo@x.example {d}") for d in range(7)]
    rows += [(d, "q or qrs, with others") for d in range(10, 15)] + [(d, f"and said others {d}") for d in range(20, 208)]
    assert {revealing(rows)[d][t] for d in range(7) for t in ("q", "qrs")} == {False}  # both are to be cut, not removed
    got = {r["doc_id"]: r["text"] for r in pii.sanitise(frame(spark, rows)).collect()}
    assert got == {d: f"{'abcdefg'[d] * 3}{d} [TERM] and [TERM]*** said [EMAIL] {d}" if d < 10 else t for d, t in rows}
