"""BPE: ids and decoded texts equal those of the library on whole documents."""

from __future__ import annotations

import hashlib

from tokenizers import Tokenizer

from strata.llm.bpe import decode, encode
from strata.llm.bpe_queries import op3_bpe, tokenizer_path

ODD = ["", None, "   ", "Hello  World's <|endoftext|> a<|EndOfText|>b <|startoftext|>", "ÀÉ İß ΑΣ Σας 世界 😀 x​y é",
       "a\x1cb\x00c\x85d\xa0e f", "don't''s!!!'re 'll've ½²٣ a1b22", "word " * 30000, "՘₏a<|endoftext|><|endoftext|>",
       "’quoted’ — dash", "é" * 5000]


def expected(texts):
    tok = Tokenizer.from_file(tokenizer_path())
    ids = [tok.encode(t or "", add_special_tokens=False).ids for t in texts]
    return [(i, tok.decode(i, skip_special_tokens=False)) for i in ids]


def test_odd_texts_equal_the_library(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(ODD)] + [(0, "again", "x", 2)],
                          "doc_id long, text string, ids string, block int").write.parquet(path)
    out = decode(encode(spark.read.parquet(path), tokenizer_path()), tokenizer_path()).collect()
    got = sorted((r.doc_id, list(r.ids), r.decoded) for r in out)
    at_once = encode(spark.read.parquet(path), tokenizer_path(), decoded_col="decoded")
    assert sorted((r.doc_id, list(r.ids), r.decoded) for r in at_once.collect()) == got
    plan = at_once._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan  # decoding has no Python worker of its own
    want = sorted([(i, *e) for i, e in enumerate(expected(ODD))] + [(0, *expected(["again"])[0])])
    assert got == want


def test_equal_blocks_stay_apart(spark, tmp_path):
    texts = [f"word{i} the cat {i * i} sat on" for i in range(300)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(path)
    docs = spark.read.parquet(path)
    got = sorted((r.doc_id, list(r.ids)) for r in encode(docs.union(docs), tokenizer_path()).collect())
    assert got == sorted(2 * [(i, e[0]) for i, e in enumerate(expected(texts))])


def test_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = dict(zip(docs, expected(docs.values())))
    rows = op3_bpe(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids, text = want[r.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_empty_table_and_unknown_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert encode(empty, tokenizer_path()).collect() == []
    rows = spark.createDataFrame([([3306, 10 ** 6, None, -1, 1002],), (None,), ([],)], "ids array<int>")
    assert sorted(r.decoded for r in decode(rows, tokenizer_path()).collect()) == ["", "", "hello</w> world</w>"]
