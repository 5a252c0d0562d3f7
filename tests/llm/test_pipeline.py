from pyspark.sql import functions as F

import corpus_pipeline
from tablescout.llm import langid
from tablescout.llm.common import ARROW_BYTES, stored

SF = "/root/testdata/sf0.001"


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF))
        assert docs.columns == columns, name
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.7 * sizes[0]
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.min("offset").alias("first")).collect()
    assert max(r.n for r in fill) <= 1024 and all(r.first == 0 for r in fill)


def test_language_id_sends_texts_once_in_small_batches(spark, monkeypatch):
    monkeypatch.setattr(langid, "fit", lambda docs, **k: langid.build([("x", "aaaaa", 1)]))
    rows = [(i, f"{i} " + "a b" * 40_000, "x") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").coalesce(1)
    size, batches, slices = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0), langid.arrow_slices

    def counted(found, **limits):
        for batch in found:
            size.add(batch.nbytes), batches.add(1)
            yield from slices(iter([batch]), **limits)

    monkeypatch.setattr(langid, "arrow_slices", counted)
    assert corpus_pipeline.language_id(spark, docs, SF).count() == 200
    text = sum(len(t) for _, t, _ in rows)
    assert text <= size.value < 1.1 * text and size.value / batches.value < 1.1 * ARROW_BYTES
