"""The pipeline's stages, each against brute force on its own input."""

from __future__ import annotations

import hashlib

from tokenizers import Tokenizer

import corpus_pipeline
from strata.llm.bpe_queries import tokenizer_path
from tests.llm.test_decontaminate import best
from tests.llm.test_jaccard import brute

SF = "/root/testdata/sf0.001"


def test_stages_on_documents_and_odd_rows(spark, tmp_path):
    real = spark.read.parquet(f"{SF}/documents.parquet")
    first = real.first()
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    odd = spark.createDataFrame(
        [(900001, None, "en", "s", 0), (900002, "", None, "s", 0), (900003, "12 34 %%", None, None, 8),
         (900004, first.text + " x", first.lang, first.source, 1), (900005, "Dies. " + item + " Ende", "en", None, None),
         (900006, first.text * 40, first.lang, first.source, 1), (900006, first.text * 40, first.lang, first.source, 1)], real.schema)
    docs, names = real.unionByName(odd), [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "bpe"]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        before, docs = docs.collect(), spark.read.parquet(path)
        after = docs.collect()
        texts, kept = {r.doc_id: r.text for r in before}, [r.doc_id for r in after]
        if name != "bpe":
            assert docs.columns == real.columns
            assert {tuple(r) for r in after} <= {tuple(r) for r in before}
        if name == "language_id":
            assert not {900001, 900002, 900003} & set(kept) and len(kept) >= 0.98 * real.count()
        if name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            good = [i for i in texts if labels.get(i) == 1]
            assert len(set(good) & set(kept)) >= 0.85 * len(good)
        if name == "ngram_jaccard_join":
            assert sorted(kept) == sorted(i for i, (_, root) in brute(texts).items() if root == i)
        if name == "benchmark_decontamination":
            items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert sorted(kept) == sorted(i for i, t in texts.items() if max(best(t, x) for x in items) < 0.75)
        if name == "bpe":
            tok = Tokenizer.from_file(tokenizer_path())
            for r in after:
                ids = tok.encode(texts[r.doc_id], add_special_tokens=False).ids
                assert list(r.ids) == ids and r.n_tokens == len(ids)
                decoded = tok.decode(ids, skip_special_tokens=False)
                assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
            assert sorted(kept) == sorted(texts)


def test_empty_documents_and_clashing_columns(spark):
    real = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, real.limit(0), SF).collect() == [], name
    clash = real.limit(60).selectExpr("*", "1 as score", "'x' as lang_pred", "2 as keep", "3 as node", "4 as _n")
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, clash, SF)
        assert out.columns == clash.columns
        assert {(r.score, r.lang_pred, r.keep, r.node, r._n) for r in out.collect()} <= {(1, "x", 2, 3, 4)}, name


def test_repeated_ids_keep_one_row_of_each_group_of_copies(spark):
    real = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [f"{i} " + " ".join(f"w{i}x{k}" for k in range(30)) for i in range(4)]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[1] + " more"), (2, texts[2]), (None, texts[3]), (None, texts[3] + " end"),
            (3, texts[0]), (1, texts[0]), (None, texts[2]), (5, ""), (6, ""), (5, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], real.schema)
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept if r.doc_id is not None) == sorted(
        [(1, texts[0]), (1, texts[1]), (2, texts[2]), (5, ""), (6, "")])
    assert [r.text[:1] for r in kept if r.doc_id is None] == ["3"]
