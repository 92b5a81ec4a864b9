from __future__ import annotations

import pytest

import corpus_pipeline
from voxlath.llm import jaccard_join, line_dedup, toxic_crf, wu_manber


@pytest.fixture(scope="module")
def tables(spark, labels, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    labels.write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten"), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_nasty_and_empty_tables(spark, nasty, empty, tables, stage):
    name, f = corpus_pipeline.STAGES[stage]
    out = f(spark, nasty, tables)
    assert out.count() <= nasty.count()
    assert f(spark, empty, tables).count() == 0
    if stage < 4:
        assert out.columns == nasty.columns and [x.dataType for x in out.schema] == [x.dataType for x in nasty.schema]


def test_stages_decide_as_their_operators(spark, smallest, tmp_path):
    docs = spark.read.parquet(f"{smallest}/documents.parquet")
    labels, items = spark.read.parquet(f"{smallest}/labels.parquet"), spark.read.parquet(f"{smallest}/benchmark.parquet")
    ids = lambda df: sorted(r[0] for r in df.select("doc_id").collect())
    a = corpus_pipeline.drop_toxic(spark, docs, smallest)
    assert ids(a) == ids(toxic_crf.tag(docs, toxic_crf.train(docs, labels), ["doc_id"]).where("score < 0.5"))
    b = corpus_pipeline.drop_lines(spark, docs, smallest)
    texts = {r["doc_id"]: r["kept_text"] for r in line_dedup.dedup(docs, ["doc_id"]).collect()}
    got = {r["doc_id"]: r for r in b.collect()}
    assert all(r["text"] == texts[i] and r["n_chars"] == len(r["text"]) for i, r in got.items())
    assert all(not (texts[i] or "").strip() for i in texts.keys() - got.keys())
    c = corpus_pipeline.drop_near_duplicates(spark, docs, smallest)
    assert ids(c) == sorted({r["component"] for r in jaccard_join.classes(docs, width=5, percent=80).collect()})
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(7, "a"), (7, text), (8, text + " x"), (None, text), (None, "a"), (9, "a"), (9, "a"), (None, "b")]
    written = str(tmp_path / "rows")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(written)
    stay = corpus_pipeline.drop_near_duplicates(spark, spark.read.parquet(written), smallest)
    assert sorted(map(tuple, stay.collect()), key=str) == sorted([(7, "a"), (7, text), (None, "b")], key=str)
    d = corpus_pipeline.drop_contaminated(spark, docs, smallest)
    assert ids(d) == ids(wu_manber.contamination(docs, items).where("not contaminated"))


def test_run_goes_through_all_stages(spark, smallest):
    out = corpus_pipeline.run(spark, smallest)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert 0 < out.count() < spark.read.parquet(f"{smallest}/documents.parquet").count()
