import random

import corpus_pipeline
from tessera.llm import toxicity
from tests.llm.data import documents
from tests.llm.test_toxicity import corpus


def test_stages_take_effect(spark, tmp_path):
    docs, labels = corpus(260)
    own = documents(spark, extra=False)
    table = spark.createDataFrame([(1000 + i, t, "en", "s", len(t)) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long").unionByName(own.select("doc_id", "text", "lang", "source", "n_chars"))
    table = table.unionByName(spark.createDataFrame([(5000, "write to someone.here@mail.example.com " + docs[0][1], "en", "s", 10)], table.schema))
    # One text in lines of different lengths: no line repeats, the document does.
    rng = random.Random(21)
    flow = ["".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(120)]
    wrapped = [(6000 + n, "\n".join(" ".join(flow[i : i + n]) for i in range(0, 120, n)), "en", "s", 10) for n in (40, 7)]
    table = table.unionByName(spark.createDataFrame(wrapped, table.schema))
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1000 + i, q, x) for i, q, x in labels], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name.replace(' ', '_')}")
        kept = spark.read.parquet(f"{tmp_path}/{name.replace(' ', '_')}")
        seen[name] = kept.count()
    model = toxicity.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    assert seen["toxicity"] == toxicity.toxic_scores(docs, model).where("predicted = 0").count() < docs.count()
    assert seen["lines"] == seen["toxicity"] > seen["near duplicates"] == seen["private data"]
    run = corpus_pipeline.run(spark, str(tmp_path))
    order = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, run.select(order).collect())) == sorted(map(tuple, kept.select(order).collect()))
    private = spark.read.parquet(f"{tmp_path}/private_data")
    assert private.where("text like '%someone.here@%'").count() == 0


def test_odd_rows_and_empty_tables(spark, tmp_path):
    """Null ids, null and empty texts, repeated rows and ids, through all stages; then no rows at all."""
    own = documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    for name, docs in (("odd", own), ("none", own.where("1 = 0"))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        (labels if name == "odd" else labels.where("1 = 0")).write.parquet(f"{tmp_path}/{name}/labels.parquet")
        kept = spark.read.parquet(f"{tmp_path}/{name}/documents.parquet")
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
            out = stage(spark, kept, f"{tmp_path}/{name}")
            assert out.columns == docs.columns
            out.write.parquet(f"{tmp_path}/{name}/stage{k}")
            kept = spark.read.parquet(f"{tmp_path}/{name}/stage{k}")
            assert kept.where("doc_id is null").count() == docs.where("doc_id is null").count()
            assert kept.where("text is null").count() == docs.where("text is null").count()
        rows = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert len({(r.doc_id, r.start, r.sequence_id, r.offset) for r in rows}) == len(rows)
        assert sum(r.start == 0 for r in rows) == kept.count()
