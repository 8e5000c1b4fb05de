"""The pipeline's stages one after the other, each against its operator's brute force."""

from __future__ import annotations

import public_tokenizers

import corpus_pipeline
from prismcube.llm import byte_bpe
from tests.llm.test_operators import brute_components, brute_quality, brute_secrets, texts

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF)
        assert docs.columns == columns, name
        docs = docs.cache()
        seen.append((dict(texts(before)), dict(texts(docs))))
    (all_, good), (_, single), (_, clean), (_, masked) = seen
    assert {*good} <= {*all_} and not any(brute_quality(t)[-1] for t in good.values())
    assert {*single} == {c for _, c in brute_components([*good.items()]).values()}
    assert {*clean} <= {*single} and len(clean) >= 0.8 * len(single)
    assert {*masked} == {*clean} and not any(brute_secrets(t.replace("[SECRET]", "!")) for t in masked.values())
    assert all(masked[d] == t for d, t in clean.items() if not brute_secrets(t))
    bpe = byte_bpe.coder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in out} == {*masked}
    assert all(bpe.decode_bytes(r["ids"]).decode() == masked[r["doc_id"]] and r["n_tokens"] == len(r["ids"]) for r in out)


def test_stages_on_odd_rows(spark):
    """Nulls, repeated rows, an empty text and columns whose names operators use; an empty table."""
    words = " ".join(f"Word{i} and thing{i}," for i in range(30))
    data = [(1, words, "en", "a", 9), (1, words, "en", "a", 9), (2, words + " more", None, None, None), (3, None, "de", "b", 0), (4, "", "de", "b", 0), (None, words.replace("thing", "stone"), "fr", "c", 1), (5, words.replace("and", "token=abcdef123456 or"), "fr", "c", 1)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS cls", "'x' AS sig", "2 AS blob", "3 AS kept")
    for docs in (df, df.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            before, docs = docs, stage(spark, docs, SF)
            assert docs.columns == df.columns
            assert before.count() >= docs.count()
            docs = docs.cache()
        out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert out.count() == docs.count()
    assert corpus_pipeline.STAGES[1][1](spark, df, SF).filter("doc_id = 2").count() == 0
    kept = corpus_pipeline.STAGES[1][1](spark, df, SF)
    assert kept.filter("doc_id = 1").count() == 2 and kept.filter("doc_id IS NULL").count() == 1 and kept.filter("doc_id IN (3, 4, 5)").count() == 3
    masked = corpus_pipeline.STAGES[3][1](spark, df, SF)
    assert masked.filter("text LIKE '%[SECRET]%'").select("doc_id").collect() == [(5,)]
