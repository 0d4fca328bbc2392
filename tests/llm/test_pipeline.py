"""The pipeline's stages on a small corpus with planted cases."""

import corpus_pipeline
from tests.llm.test_operators import changed, frame, text_of


def test_stages_act_in_turn(spark, tmp_path):
    item, passage = text_of("item", 30), text_of("passage", 70)
    clean = {i: text_of(i, 120) for i in (1, 2, 3, 40)}
    rows = [
        *clean.items(), (5, clean[1]), (6, changed(clean[2], 2, 1)), (7, text_of(7, 50) + " " + item), (8, "123 !!"), (9, None),
        (10, text_of(10, 90) + " " + passage), (11, text_of(11, 90) + " " + passage), (3, clean[3]),
    ]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id BIGINT, text STRING").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / f"stage-{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage-{k}"))
        seen.append(sorted(r.doc_id for r in docs.collect()))
        assert docs.columns == columns or name == "pieces"
    assert seen == [
        [1, 2, 3, 3, 5, 6, 7, 10, 11, 40], [1, 2, 3, 7, 10, 11, 40], [1, 2, 3, 7, 10, 11, 40], [1, 2, 3, 10, 11, 40], [1, 2, 3, 10, 11, 40]
    ]
    cut = {r.doc_id: r for r in spark.read.parquet(str(tmp_path / "stage-2")).collect()}
    assert passage in cut[10].text and passage not in cut[11].text and cut[11].n_chars == len(cut[11].text)
    assert cut[1].text == clean[1] and all(r.round_trip for r in docs.collect())


def test_run_equals_the_stages(spark, tmp_path):
    frame(spark, [(1, text_of(1, 60)), (2, text_of(2, 60)), (3, text_of(1, 60))]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id BIGINT, text STRING").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == [1, 2]
