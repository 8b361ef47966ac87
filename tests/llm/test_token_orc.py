"""Token ids written to ORC and read back, against the tokenizer on whole texts."""

import zlib

import numpy as np
import pyarrow.orc as orc
import pytest
from tokenizers import Tokenizer

from storyloom.llm.queries import tokenizer_file
from storyloom.llm.token_orc import read_tokens, token_digest, write_tokens

PATH = tokenizer_file("word_bpe_49k.json")
TEXTS = [None, "", " \n ", "Hello world", "hello  WORLD\n\tit's 42", "é é 漢字 😀 x y", "<|endoftext|>a <|startoftext|>",
         "x" * 5000, "word " * 4000, "\x00 a\x0bb\x0cc\x85d", "don't we'll I'm'", "á ́b"]


def expected(rows):
    tok, at, out = Tokenizer.from_file(PATH), 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.fixture(scope="module")
def rows():
    return [((i * 37) % 101, t) for i, t in enumerate(TEXTS * 3)] + [(None, "null id"), (500, "twice"), (500, "twice")]


def test_files_hold_the_ids_of_whole_texts(spark, rows, tmp_path):
    out = str(tmp_path / "ids")
    df = spark.createDataFrame([(d, t, 7, 8) for d, t in rows], "doc_id long, text string, part int, at int")
    write_tokens(df.repartition(5), out, PATH)
    got = sorted((tuple(r) for r in token_digest(spark, out).collect()), key=lambda r: r[1])
    assert got == expected(rows)
    assert read_tokens(spark, out, [500]).count() == 2


def test_file_layout(spark, tmp_path):
    out = str(tmp_path / "ids")
    df = spark.range(5000).selectExpr("id AS doc_id", "concat('some words ', id) AS text")
    write_tokens(df, out, PATH)
    low = []
    for f in sorted(tmp_path.glob("ids/*.orc")):
        x = orc.ORCFile(f)
        assert x.row_index_stride == 1000 and x.nstripes >= 1
        ids = x.read(["doc_id"])["doc_id"].to_pylist()
        assert ids == sorted(ids)
        low += ids[:1]
    assert low == sorted(low)
    plan = read_tokens(spark, out, [7, 9])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(doc_id" in plan


def test_empty_table(spark, tmp_path):
    out = str(tmp_path / "ids")
    write_tokens(spark.createDataFrame([], "doc_id long, text string"), out, PATH)
    assert token_digest(spark, out).collect() == []
