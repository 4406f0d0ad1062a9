import os

import corpus_pipeline
from lexharbor.llm import mixing, toxicity
from lexharbor.llm.queries import ORACLE, QUERIES
from lexharbor.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_stages_equal_their_operators(spark, make):
    """Every decision of a stage takes effect on rows and nothing else changes."""
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(1, "alpha " + passage), (2, "alpha " + passage + " beta"), (3, None), (None, "lone row"),
            (4, "x " * 30), (4, "x " * 30), (5, " ".join(f"q{i}" for i in range(30)))]
    docs = make(rows)
    kept = corpus_pipeline.near_duplicates_out(spark, docs, SF)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "4", "5", "None"]
    assert kept.columns == docs.columns
    folder = scratch_path(spark, "bench")
    spark.createDataFrame([(9, passage), (10, "absent words are here now")],
                          "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    clean = corpus_pipeline.benchmark_out(spark, docs, folder)
    assert sorted(str(r.doc_id) for r in clean.collect()) == ["3", "4", "4", "5", "None"]
    out = corpus_pipeline.mixed(spark, docs, SF)
    assert out.columns == docs.columns and out.count() > 0
    empty = make([])
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, empty, SF).count() == 0


def test_null_and_repeated_ids_are_judged_row_by_row(spark, make):
    passage = " ".join(f"p{i}" for i in range(40))
    lone, other = (" ".join(f"{c}{i}" for i in range(20)) for c in "ab")
    rows = [(None, "alpha " + passage), (None, lone), (None, None), (5, passage + " x"), (5, other)]
    folder = scratch_path(spark, "bench")
    spark.createDataFrame([(9, passage)], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")

    def texts(out):
        return sorted((str(r.doc_id), r.text or "") for r in out.collect())

    clean = corpus_pipeline.benchmark_out(spark, make(rows), folder)
    assert texts(clean) == [("5", other), ("None", ""), ("None", lone)]
    rows += [(None, lone), (None, lone + " z"), (None, None), (7, other + " z")]
    kept = corpus_pipeline.near_duplicates_out(spark, make(rows), SF)
    assert [x for x in texts(kept) if not x[1].startswith(lone)] == [
        ("5", other), ("5", passage + " x"), ("None", ""), ("None", "")]
    assert sum(t.startswith(lone) for _, t in texts(kept)) == 1


def test_columns_of_the_stages_own_names_keep_their_values(spark, make):
    """Inputs may have columns called like a stage's key or the classifier's."""
    passage = " ".join(f"p{i}" for i in range(40))
    folder = scratch_path(spark, "bench")
    for name in ("labels", "documents"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    spark.createDataFrame([(9, passage)], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    docs = (make([(i, f"plain words number {i} stand here") for i in range(6)] + [(7, passage)])
            .selectExpr("*", "10 * doc_id AS stage_key", "'s' AS Predicted", "-doc_id AS flagged",
                        "doc_id + 1 AS mix_copy", "'r' AS mix_repeats", "1 AS stage_key_"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows, name
        assert all((r.stage_key, r.Predicted, r.flagged, r.mix_copy, r.mix_repeats, r.score)
                   == (10 * r.doc_id, "s", -r.doc_id, r.doc_id + 1, "r", 0.5) for r in rows), name


def test_rows_without_id_are_mixed_each_for_itself(spark, make):
    docs = make([(None if i % 3 else 7, "w " * (i % 9 + 1), f"s{i % 2}") for i in range(80)])
    out = corpus_pipeline.mixed(spark, docs, SF).collect()
    assert sum(len(r.text.split()) for r in out) == sum(r.taken for r in mixing.mix(docs).collect())


def test_toxic_stage_keeps_what_scores_low(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    left = {r.doc_id for r in corpus_pipeline.toxic_out(spark, docs, SF).collect()}
    scored = toxicity.scored(docs, labels).collect()
    assert left == {r.doc_id for r in scored if r.predicted == 0} and len(left) > 100


def test_run_writes_and_reads_tokens(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    ordered = sorted(rows, key=lambda r: r.start)
    assert ordered[0].start == 0
    assert all(a.start + a.n_tokens == b.start for a, b in zip(ordered, ordered[1:]))


def test_every_operator_is_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(ORACLE) <= set(QUERIES)
    assert os.path.exists(corpus_pipeline.__file__) and len(corpus_pipeline.STAGES) == 5
