from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import langid, quality, queries


def test_stages_keep_columns_and_decide(spark, docs, tmp_path):
    root = f"file://{tmp_path}"
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (4, 1, 0), (13, 0, 0), (16, 1, 0), (12, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    now = spark.read.parquet(f"{root}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, root)
        assert out.columns == now.columns
        before, after = ({(r.doc_id, r.text) for r in x.collect()} for x in (now, out))
        assert after <= before
        if name == "language":
            model = queries.op8_language_model(spark.read.parquet(f"{root}/documents.parquet"))
            names, scores, _ = langid.label_texts([t or "" for _, t in before], langid.WordScores(model))
            assert after == {d for d, n, s in zip(before, names, scores) if n != "und" and s >= corpus_pipeline.MIN_LANGUAGE_SHARE}
        if name == "quality":
            model, terms = queries.op4_quality_model(spark, root), quality.Terms()
            assert after == {d for d in before if model.scores(terms.row(d[1] or "")[None, :])[0] >= quality.THRESHOLD}
        if name == "near_dedup":
            assert not {2} & {d for d, _ in after}
        now = out
    packed = corpus_pipeline.run(spark, root)
    assert packed.select("doc_id").distinct().count() == now.select("doc_id").distinct().count()
    assert packed.agg(F.sum("length")).first()[0] == packed.select("doc_id", "doc_tokens").distinct().agg(F.sum("doc_tokens")).first()[0]
