"""Row numbers hold when the input's splits change between the jobs of an operator."""

from gridmix.llm import repeats, simhash
from tests.llm.test_near import near_rows, plain_components, plain_repeats, repeat_texts


def with_new_splits(spark, make):
    """Rows of make() when the files are cut finer after its first jobs."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, str(64 << 20))
        lazy = make()
        spark.conf.set(key, "4k")
        return lazy.collect()
    finally:
        spark.conf.set(key, before)


def stored(spark, rows, folder):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    frame.write.option("parquet.block.size", "4096").parquet(str(folder))
    return spark.read.parquet(str(folder))


def test_repeats_with_new_splits(spark, tmp_path):
    texts = repeat_texts()
    df = stored(spark, list(enumerate(texts)), tmp_path / "r")
    rows = {r["doc_id"]: r for r in with_new_splits(spark, lambda: repeats.digests(repeats.repeats(df)))}
    for i, want in enumerate(plain_repeats(texts)):
        r = rows[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want, i


def test_keep_one_with_new_splits(spark, tmp_path):
    rows = [r for r in near_rows() if r[0] is not None]
    df = stored(spark, rows, tmp_path / "k")
    kept = with_new_splits(spark, lambda: simhash.keep_one(df))
    assert sorted(r["doc_id"] for r in kept) == sorted({c for _, _, c in plain_components(rows)})
