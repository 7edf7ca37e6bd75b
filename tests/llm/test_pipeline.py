"""The pipeline's stages one after the other against plain versions, and what they do with odd rows."""

import public_tokenizers

import corpus_pipeline
from gridmix.llm import secrets, toxicity
from tests.llm.conftest import sf
from tests.llm.test_counts import check_packing
from tests.llm.test_near import plain_contained
from tests.llm.test_similar import plain_kept


def test_pipeline(spark):
    d = sf()
    docs = spark.read.parquet(f"{d}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    scores = toxicity.toxicity(docs, spark.read.parquet(f"{d}/labels.parquet")).collect()
    kept = {r["doc_id"]: texts[r["doc_id"]] for r in scores if r["score"] < 0.7}
    kept = {i: kept[i] for i in plain_kept(list(kept.items()))}  # one of each group of four fifths of five-word shingles
    items = [tuple(r) for r in spark.read.parquet(f"{d}/benchmark.parquet").select("item_id", "text").collect()]
    for i, *_ in plain_contained(list(kept.items()), items):
        kept.pop(i, None)
    enc = secrets.encoding(public_tokenizers.path(secrets.VOCABULARY))
    kept = {i: secrets.masked(t, secrets.spans(t, enc)) for i, t in kept.items()}
    rows = corpus_pipeline.run(spark, d).collect()
    assert {r["doc_id"] for r in rows} == set(kept) and len(kept) < len(texts)
    check_packing(rows, kept)


def test_stages_keep_columns_and_odd_rows(spark, docs, empty):
    for frame in (docs, empty):
        wide = frame.withColumnRenamed("source", "score").selectExpr("*", "1 AS _row", "2 AS _row0", "lang AS fp")
        out = wide
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, sf())
            assert out.columns == wide.columns, name
        last = corpus_pipeline.STAGES[-1][1](spark, out, sf())
        assert (last.count() == 0) == (frame is empty)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
