"""Toxic spans and document toxicity by a linear-chain conditional random field (operator 7).

Two states a token (0 clean, 1 toxic). A token's potential is the sum of the weights of its
features (the word without outer punctuation, in lower case, its first 3 to 6 characters, its last
3, each with its kind), looked up in a table of fixed size; a 2 x 2 transition matrix and a start
vector join neighbours. Forward-backward gives every token its marginal probability of being toxic.

*Labels of tokens* come from the documents' labels. For each term (word or word beginning) its different
neighbours to the left, to the right, and documents, in toxic and in clean documents are counted. The smallest of
the three counts for it, so that neither copies of a document, edited or not, nor a document that repeats a
word count more than once; the largest counts against it. A term
marks toxic tokens if it has ``MIN_CONTEXTS`` toxic occurrences or more, ``RATIO`` times the rate of clean ones,
and a split that chance would give to ``CHANCE`` of all terms at most. Tokens
of clean documents are clean.

*Documents*: the largest marginal and the log of the sum of squared marginals go into a logistic
model, fitted to the documents' labels, which gives the score.

Fitting uses a bounded, documented sample: about ``SAMPLE_DOCS`` documents of each class or those of about
``SAMPLE_CHARS`` characters together, whichever is less, chosen by a hash of id and text, so texts of any length take part
as their share is (one longer than twice the bound of all does not). Scoring reads every whole text.

The chain runs over a slice of many documents at once: the slice is cut into sqrt(n) chunks, each
chunk's product of 2 x 2 matrices is built in step with the others, the chunks' vectors are carried
from one to the next, and a second pass fills in the positions. A document's first token has a
matrix that forgets what came before, so documents may share or span chunks; results are exact.

Defined results: a null or empty text has no tokens and the score of a text without any sign of
toxicity. Without labelled toxic rows every score is 0. If no term passes the test, all tokens of toxic
documents count as toxic in the fit; if no toxic document has a token, the score is the share of toxic rows. Repeated label rows of one id count as
toxic if any of them is. A null id is not held out. Repeated rows give a row each; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storyloom.llm.arrow import column, give_back, slices, text_column, words

FEATURES_LOG2 = 18
#: Labelled rows of a class that a model is fitted to, and their characters: what is expected. Twice the
#: characters are the bound, and what a single text may have.
SAMPLE_DOCS = 2000
SAMPLE_CHARS = 4_000_000
#: Tokens that a step of the fit holds arrays for.
FIT_TOKENS = 1 << 16
MIN_CONTEXTS = 4
RATIO = 10
#: Terms that chance may mark, by expectation.
CHANCE = 1
ROUNDS = 30
#: Text bytes scored at once: some 60 times as much in arrays.
SCORE_BYTES = 1 << 20
#: Words whose potentials a Python worker remembers.
CACHE_WORDS = 150_000

WORD = re.compile(r"[^\x20\x09-\x0D]+")
OUTER = ".,;:!?\"'()[]{}<>«»…-*_~`"


def word_features(word: str) -> list[int]:
    """Indices of a token's features in the weight table."""
    w = word.lower().strip(OUTER)
    mask = (1 << FEATURES_LOG2) - 1
    keys = [f"w{w}", f"s{w[-3:]}"] + [f"{k}{w[:k]}" for k in (3, 4, 5, 6) if len(w) >= k]
    return [zlib.crc32(k.encode("utf-8", "surrogatepass")) & mask for k in keys]


def terms(word: str) -> list[str]:
    """What may mark a toxic token: the word and its beginnings."""
    w = word.lower().strip(OUTER)
    return [w] + [w[:k] + "-" for k in (4, 5, 6) if len(w) > k]


@dataclass
class Crf:
    weights: np.ndarray
    trans: np.ndarray = field(default_factory=lambda: np.array([[0.0, -2.0], [0.0, 0.0]]))
    start: np.ndarray = field(default_factory=lambda: np.array([0.0, -2.0]))
    bias: float = -2.0
    doc: np.ndarray = field(default_factory=lambda: np.zeros(3))
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def _scan(lo: np.ndarray, hi: np.ndarray, fresh: np.ndarray, a: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Normalised forward vectors (n x 2). Position t's matrix is ``a · diag(lo_t, hi_t)``, or
    ``1 · (first * (lo_t, hi_t))`` where ``fresh``."""
    n = len(lo)
    steps = max(1, math.isqrt(n))
    wide = -(-n // steps)
    def grid(x, fill):
        return np.concatenate((x, np.full(steps * wide - n, fill, x.dtype))).reshape(wide, steps).T.copy()
    lo, hi, fresh = grid(lo, 1.0), grid(hi, 1.0), grid(fresh, False)
    a00, a01, a10, a11 = a.ravel()
    f0, f1 = first
    # the row vectors (1,0) and (0,1) carried through each chunk side by side
    x0 = np.concatenate((np.ones(wide), np.zeros(wide)))
    x1 = 1.0 - x0
    for t in range(steps):
        l2, h2, s2 = np.tile(lo[t], 2), np.tile(hi[t], 2), np.tile(fresh[t], 2)
        mass = x0 + x1
        y0 = np.where(s2, mass * f0, x0 * a00 + x1 * a10) * l2
        y1 = np.where(s2, mass * f1, x0 * a01 + x1 * a11) * h2
        both = y0 + y1
        if t % 4 == 3:  # a common factor for both rows of a chunk
            both = both[:wide] + both[wide:]
            y0 /= np.tile(both, 2)
            y1 /= np.tile(both, 2)
        x0, x1 = y0, y1
    carry = np.empty((wide, 2))
    v0, v1 = 0.5, 0.5
    for k in range(wide):
        carry[k] = v0, v1
        v0, v1 = v0 * x0[k] + v1 * x0[wide + k], v0 * x1[k] + v1 * x1[wide + k]
        s = v0 + v1
        v0, v1 = v0 / s, v1 / s
    out = np.empty((steps, wide, 2))
    x0, x1 = carry[:, 0], carry[:, 1]
    for t in range(steps):
        mass = x0 + x1
        y0 = np.where(fresh[t], mass * f0, x0 * a00 + x1 * a10) * lo[t]
        y1 = np.where(fresh[t], mass * f1, x0 * a01 + x1 * a11) * hi[t]
        s = y0 + y1
        x0, x1 = y0 / s, y1 / s
        out[t, :, 0], out[t, :, 1] = x0, x1
    return out.transpose(1, 0, 2).reshape(-1, 2)[:n]


def marginals(m: Crf, e: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each token its probability of state 1; and the normalised forward and backward vectors.
    ``e``: the tokens' potentials; ``fresh``: where documents begin."""
    a, first = np.exp(m.trans), np.exp(m.start)
    hi = np.exp(np.clip(e, -30, 30))
    one = np.ones(len(e))
    alpha = _scan(one, hi, fresh, a, first)
    # backward: the same recursion from the end, on the vectors psi_t * beta_t
    ends = np.concatenate((fresh[1:], [True]))
    back = _scan(one, hi[::-1], ends[::-1], a.T, np.ones(2))[::-1]  # psi_t(i) beta_t(i)
    beta = back / np.stack((one, hi), 1)
    both = alpha * beta
    return both[:, 1] / both.sum(1), alpha, beta


def _marked_words(names: list[str], word_id: np.ndarray, fresh: np.ndarray, of_doc: np.ndarray) -> np.ndarray:
    """Which words mark toxic tokens: those with a term seen in enough surroundings of toxic documents
    and hardly any of clean ones."""
    before = np.concatenate(([-1], word_id[:-1]))
    before[fresh] = -1
    after = np.concatenate((word_id[1:], [-1]))
    after[np.concatenate((fresh[1:], [True]))] = -1
    doc = np.cumsum(fresh)
    wide = max(len(names), int(doc[-1])) + 2
    number: dict[str, int] = {}
    of_term = [[number.setdefault(t, len(number)) for t in terms(w) if len(t) > 2] for w in names]
    many = np.array([len(t) for t in of_term])
    flat, first = np.array([t for ts in of_term for t in ts], np.int64), np.cumsum(many) - many
    seen = []
    for which in (of_doc, ~of_doc):
        sides = []
        for beside in (before, after, doc):
            # each word's different neighbours first, then those of its terms, a part at a time
            own = np.unique(word_id[which] * wide + beside[which] + 1)
            pairs = np.empty(0, np.int64)
            for part in np.array_split(own, len(own) // 100_000 + 1):
                w, each = part // wide, many[part // wide]
                term = flat[np.repeat(first[w] - (np.cumsum(each) - each), each) + np.arange(int(each.sum()))]
                pairs = np.union1d(pairs, term * wide + np.repeat(part % wide, each))
            sides.append(np.bincount(pairs // wide, minlength=len(number)))
        seen.append(sides)
    bad, good = np.min(seen[0], axis=0), np.max(seen[1], axis=0)
    # by chance, a surrounding is one of a toxic document with the share r of toxic tokens
    r = min(max(float(of_doc.mean()), 1e-6), 1 - 1e-6)
    need = math.log(len(number) / CHANCE)
    ok = np.zeros(len(number), bool)
    for t in np.flatnonzero(bad >= MIN_CONTEXTS).tolist():
        b, g = int(bad[t]), int(good[t])
        if b / r < RATIO * (g + 0.5) / (1 - r):
            continue
        surprise = -(math.lgamma(b + g + 1) - math.lgamma(b + 1) - math.lgamma(g + 1)
                     + b * math.log(r) + g * math.log(1 - r))
        ok[t] = surprise >= need
    return np.array([any(ok[t] for t in ts) for ts in of_term])


def _gradient(m: Crf, e: np.ndarray, fresh: np.ndarray, y: np.ndarray, seen: np.ndarray):
    """Marginals of a stretch of tokens, and its part of the gradient of the transitions and the start.
    ``seen``: the labelled transitions of the stretch."""
    p, alpha, beta = marginals(m, e, fresh)
    inner = np.flatnonzero(~fresh)
    hi = np.exp(np.clip(e[inner], -30, 30))
    # the four expected transitions of each place, one array at a time
    own = [[alpha[inner - 1, i] * math.exp(m.trans[i, j]) * (beta[inner, j] * hi if j else beta[inner, j])
            for j in (0, 1)] for i in (0, 1)]
    total = own[0][0] + own[0][1] + own[1][0] + own[1][1]
    expected = np.array([[(x / total).sum() for x in row] for row in own])
    start = np.array([(p[fresh] - y[fresh]).sum(), (y[fresh] - p[fresh]).sum()])
    return p, seen - expected, start


def _train(texts: list[str], toxic: np.ndarray) -> Crf | None:
    """Fit by gradient ascent (AdaGrad) on the conditional log-likelihood of the token labels. Tokens are taken
    ``FIT_TOKENS`` at a time, so that the arrays of a round are small whatever the sample; a document
    that goes on in the next stretch begins anew there."""
    if not len(toxic) or not toxic.any():
        return None
    number: dict[str, int] = {}
    word_id, lengths = array("i"), []
    for t in texts:
        ws = WORD.findall(t)
        lengths.append(len(ws))
        word_id.extend(number.setdefault(w, len(number)) for w in ws)
    word_id, lengths = np.frombuffer(word_id, np.int32), np.array(lengths)
    m = Crf(np.zeros(1 << FEATURES_LOG2))
    begin = np.concatenate(([0], np.cumsum(lengths)))
    if len(word_id):
        of_doc = np.repeat(toxic.astype(bool), lengths)
        fresh = np.zeros(len(word_id), bool)
        fresh[begin[:-1][lengths > 0]] = True
        y = _marked_words(list(number), word_id.astype(np.int64), fresh, of_doc)[word_id] & of_doc
        if not y.any():  # no term tells: every token of a toxic document counts
            y = of_doc
        p = _ascend(m, list(number), word_id, fresh, y)
    else:
        p = np.empty(0, np.float32)
    _fit_documents(m, signs(p, begin), toxic.astype(float))
    return m


def _ascend(m: Crf, names: list[str], word_id: np.ndarray, fresh: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Fit the chain; returns the tokens' marginals under the fitted model."""
    features = [word_features(w) for w in names]
    of_word = np.repeat(np.arange(len(features), dtype=np.int32), [len(f) for f in features])
    flat = np.concatenate([np.array(f, np.int32) for f in features])
    del features
    cuts = [slice(a, min(a + FIT_TOKENS, len(word_id))) for a in range(0, len(word_id), FIT_TOKENS)]
    for c in cuts:
        fresh[c.start] = True
    seen = []
    for c in cuts:
        inner = np.flatnonzero(~fresh[c]) + c.start
        was, now = y[inner - 1], y[inner]
        seen.append(np.array([[(~was & ~now).sum(), (~was & now).sum()], [(was & ~now).sum(), (was & now).sum()]], float))
    right = np.bincount(word_id, weights=y, minlength=len(names))
    past = {k: 1e-6 for k in ("t", "s", "b")}
    past["w"] = np.full_like(m.weights, 1e-6)

    def potentials():
        return m.bias + np.bincount(of_word, weights=m.weights[flat], minlength=len(names))
    for _ in range(ROUNDS):
        of_name, g_word = potentials(), right.copy()
        g_t, g_s, g_b = np.zeros((2, 2)), np.zeros(2), 0.0
        for c, pairs in zip(cuts, seen):
            p, t, s = _gradient(m, of_name[word_id[c]], fresh[c], y[c], pairs)
            g_word -= np.bincount(word_id[c], weights=p, minlength=len(names))
            g_t, g_s, g_b = g_t + t, g_s + s, g_b + float((y[c] - p).sum())
        g_w = np.bincount(flat, weights=g_word[of_word], minlength=len(m.weights)) - 0.02 * m.weights
        for k, g in (("w", g_w), ("t", g_t), ("s", g_s), ("b", g_b)):
            past[k] = past[k] + g * g
        m.weights += 0.5 * g_w / np.sqrt(past["w"])
        m.trans += 0.2 * g_t / np.sqrt(past["t"])
        m.start += 0.2 * g_s / np.sqrt(past["s"])
        m.bias += 0.2 * g_b / math.sqrt(past["b"])
    of_name, out = potentials(), np.empty(len(word_id), np.float32)
    for c in cuts:
        out[c] = marginals(m, of_name[word_id[c]], fresh[c])[0]
    return out


def signs(p: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Of each document (tokens ``begin[i]:begin[i + 1]``): the largest marginal and the log of the
    sum of the squared ones, which many small marginals of a long text hardly move."""
    full = np.flatnonzero(np.diff(begin))
    out = np.zeros((len(begin) - 1, 2))
    out[:, 1] = math.log(1e-3)
    if len(full):
        out[full, 0] = np.maximum.reduceat(p, begin[full])
        out[full, 1] = np.log(1e-3 + np.add.reduceat(p * p, begin[full]))
    return out


def _fit_documents(m: Crf, x: np.ndarray, y: np.ndarray) -> None:
    """Logistic regression by Newton steps with a small ridge."""
    z = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(3)
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (q * (1 - q))[:, None]).T @ z + 0.5 * np.eye(3)
        w += np.linalg.solve(h, z.T @ (y - q) - 0.5 * w)
    m.doc = w


def held_out(id_column: str):
    """Rows whose labels are never learnt: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Crf | None:
    """A model from the labelled rows that are not held out; None without toxic ones. Both the number of
    sampled rows and their characters are bounded, for each class."""
    known = (labels.where("doc_id is not null and toxic is not null").where(~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    # rows with a label; rows equal in id and text are one
    own = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(own).alias("of_text"), F.length(own).alias("chars")).join(known, "doc_id").distinct()
    size = {r["toxic"]: (r["n"], r["chars"]) for r in
            rows.groupBy("toxic").agg(F.count("*").alias("n"), F.sum("chars").alias("chars")).collect()}
    if not size.get(1):
        return None
    # a row of class c is in the sample if its hash is in the class's share of all hashes
    part = F.pmod(F.xxhash64("doc_id", "of_text"), F.lit(1 << 30)) / float(1 << 30)
    share = {c: min(sample_docs / n, sample_chars / max(chars, 1)) for c, (n, chars) in size.items()}
    wanted = rows.withColumn("part", part).where(F.col("part") < F.when(F.col("toxic") == 1, share[1])
                                                 .otherwise(share.get(0, 0.0)))
    chosen, total = [], {0: 0, 1: 0}
    for r in wanted.orderBy("part", "doc_id", "of_text").limit(4 * sample_docs).collect():
        if total[r["toxic"]] + r["chars"] <= 2 * sample_chars:
            total[r["toxic"]] += r["chars"]
            chosen.append((r["doc_id"], r["of_text"], r["toxic"]))
    spark = docs.sparkSession
    few = F.broadcast(spark.createDataFrame(chosen, "doc_id long, of_text long, toxic int"))  # 4 x sample_docs at most
    got = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(few.select("doc_id").distinct()), "doc_id")
           .withColumn("of_text", F.xxhash64("text")).join(few, ["doc_id", "of_text"])
           .select("text", "toxic").distinct().toArrow())
    texts = sorted(zip(got.column("text").to_pylist(), got.column("toxic").to_pylist()))
    del got
    m = _train([t for t, _ in texts], np.array([x for _, x in texts], int))
    del texts
    give_back()
    return m


_CACHE: dict[str, dict[str, float]] = {}


def _potentials(m: Crf, distinct: list[str]) -> np.ndarray:
    """The words' potentials, remembered between slices of a worker."""
    known = _CACHE.get(m.key)
    if known is None:
        _CACHE.clear()
        known = _CACHE[m.key] = {}
    out = np.empty(len(distinct))
    for i, w in enumerate(distinct):
        e = known.get(w)
        if e is None:
            e = m.bias + sum(m.weights[word_features(w)].tolist())
            if len(known) >= CACHE_WORDS:
                known.clear()
            known[w] = e
        out[i] = e
    return out


def _spans(text: str, p: np.ndarray) -> list[dict]:
    """Runs of tokens with a marginal of 0.5 or more, as code points, with their largest marginal."""
    out, hot = [], p >= 0.5
    for i, found in enumerate(WORD.finditer(text)):
        if hot[i]:
            if i and hot[i - 1]:
                out[-1]["end"], out[-1]["p"] = found.end(), max(out[-1]["p"], float(p[i]))
            else:
                out.append({"start": found.start(), "end": found.end(), "p": float(p[i])})
    return out


SPANS = "array<struct<start: long, end: long, p: double>>"
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, "text", SCORE_BYTES):
                texts = text_column(part, "text")
                flat, begin = words(texts, lower=False)
                spans: list[list[dict]] = [[] for _ in range(part.num_rows)]
                p = np.empty(0)
                if len(flat):
                    coded = pc.dictionary_encode(flat)
                    e = _potentials(m, coded.dictionary.to_pylist())[np.asarray(coded.indices)]
                    fresh = np.zeros(len(e), bool)
                    fresh[begin[:-1][np.diff(begin) > 0]] = True
                    p = marginals(m, e, fresh)[0]
                    hot = np.unique(np.searchsorted(begin, np.flatnonzero(p >= 0.5), side="right") - 1)
                    for i in hot.tolist():
                        spans[i] = _spans(texts[i].as_py(), p[begin[i]:begin[i + 1]])
                x = signs(p, begin)
                score = 1 / (1 + np.exp(-(m.doc[0] + x @ m.doc[1:])))
                yield pa.RecordBatch.from_arrays(
                    [column(part, "doc_id").cast(pa.int64()), pa.array(score), pa.array(spans, _ARROW_SPANS)],
                    ["doc_id", "score", "spans"])
        give_back()
    return run


def score(docs: DataFrame, m: Crf | None) -> DataFrame:
    """``(doc_id, score, spans)`` of each row of ``docs(doc_id, text)``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if m is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"), F.array().cast(SPANS).alias("spans"))
    shared = docs.sparkSession.sparkContext.broadcast(m)
    return rows.mapInArrow(_score(shared), f"doc_id long, score double, spans {SPANS}")


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents whose score is below the threshold. Rows with a null id stay if their text
    is clean; the rows that go are decided in the scoring pass itself, so no join is needed."""
    m = fit(docs, labels)
    if m is None:
        return docs
    shared, schema = docs.sparkSession.sparkContext.broadcast(m), docs.schema
    judge = _score(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                own = pa.RecordBatch.from_arrays([pa.nulls(part.num_rows, pa.int64()), column(part, "text")],
                                                 ["doc_id", "text"])
                got = np.concatenate([np.asarray(column(x, "score")) for x in judge(iter([own]))])
                yield part.filter(pa.array(got < threshold))
    return docs.mapInArrow(run, schema)
