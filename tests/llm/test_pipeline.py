"""The pipeline's stages over the smallest tables, each held against its own input."""

from pyspark.sql import functions as F

from galetrack.llm import bpe, common, mixing
from galetrack.llm.common import materialise

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, seen = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = materialise(stage(spark, docs, DIR), f"test-{name}")
        seen[name] = (before.count(), docs.count())
        if i + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "toxicity", "near_duplicates", "mix", "encode"]
    assert seen["language"][1] >= 0.95 * seen["language"][0]
    assert 0.7 * seen["toxicity"][0] < seen["toxicity"][1] < seen["toxicity"][0]
    assert seen["near_duplicates"][1] < seen["near_duplicates"][0]
    assert seen["mix"][1] == seen["encode"][1] == seen["encode"][0]
    assert all(r["n_tokens"] == len(r["ids"]) for r in docs.collect())


def test_odd_rows(spark):
    """Null, empty, repeated, very long and clashing rows, and no rows, through every stage."""
    import corpus_pipeline

    good = spark.read.parquet(f"{DIR}/documents.parquet")
    columns = good.columns
    text = good.first()["text"]
    odd = [(None, text, None, None, None), (1, None, "en", "s", 0), (2, "", "en", None, 0), (3, "?? 12", None, "s", 5), (4, " ".join([text] * 200), "en", "s", 9), (5, text, "en", "s", 1), (5, text, "en", "s", 1)]
    rows = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long").select(*columns)
    rows = rows.withColumns({"__uid": F.lit(1), "row": F.lit("x"), "uid": F.lit(2), "times": F.lit(3), "__text": F.lit("y")})
    more = good.where("doc_id >= 100").limit(60).withColumns({"__uid": F.lit(1), "row": F.lit("x"), "uid": F.lit(2), "times": F.lit(3), "__text": F.lit("y")})
    docs = rows.unionByName(more)
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, materialise(stage(spark, docs, DIR), f"odd-{name}")
        if i + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == before.columns
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name == "language":
            assert not ids & {1, 2, 3} and {None, 4, 5} <= ids
        if name == "near_duplicates":
            assert docs.where("doc_id = 5 or doc_id is null").count() <= 1
    none = good.where("false")
    for name, stage in corpus_pipeline.STAGES:
        none = materialise(stage(spark, none, DIR), f"none-{name}")
        assert none.count() == 0


def test_the_plan_of_a_mix_needs_no_python_workers(spark):
    """The list of sources is part of the plan, not an RDD of Python rows."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    assert "ExistingRDD" not in mixing.mix(docs)._jdf.queryExecution().toString()


def test_what_a_worker_holds_is_small():
    """Caches keep four bytes an id; a stage that is over keeps nothing."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        encoder = common.per_worker("test", lambda: bpe.Encoder(bpe.Vocabulary(f.read())))
    for i in range(300):
        encoder.digest(f"word{i} Word{i}, <|endoftext|>")
    kept = [v for cache in (encoder.cache, encoder.known) for v in cache.values()]
    assert len(kept) > 300 and all(isinstance(v, bytes) and len(v) % 4 == 0 for v in kept)
    common.release()
    assert not common._WORKER


def test_batches_of_texts_end_at_a_number_of_bytes(spark):
    import public_tokenizers

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    spark.conf.unset(name)
    bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    assert int(spark.conf.get(name)) == common.BATCH_BYTES
    spark.conf.set(name, "12345678")
    bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    assert spark.conf.get(name) == "12345678"
    spark.conf.unset(name)
