import corpus_pipeline
from aeroweave.llm import decontaminate, simhash

PASSAGE = "a passage of the benchmark that is long enough to be told from chance and that nothing else holds at all"


def text(i):
    return " ".join(f"{w}{i * 7 + k}" for k, w in enumerate("sun rain wind cloud storm hail snow frost thaw mist fog dew heat".split() * 3))


def test_stages_on_planted_cases(spark, documents, tmp_path):
    rows = [(i, text(i), f"s{i % 4}") for i in range(60)]
    rows += [(100 + i, text(3), f"s{i % 3}") for i in range(5)]  # exact copies
    rows += [(200, text(9) + " " + PASSAGE, "s1"), (300, "too short", "s1"), (301, None, "s2"), (302, "", None), (303, "spam and spam " * 30, "s1")]
    docs = documents(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "near-dedup", "decontamination", "mixing"]
    now, ids = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, str(tmp_path))
        rows_now = now.collect()
        ids[name] = [r.doc_id for r in rows_now]
        assert now.columns == docs.columns + ["copy"] * (name == "mixing")
        now = spark.createDataFrame(rows_now, now.schema)
    assert sorted(ids["quality rules"]) == [*range(60), 100, 101, 102, 103, 104, 200]
    assert sorted(ids["line dedup"]) == sorted(ids["quality rules"])
    assert sorted(ids["near-dedup"]) == [*range(60), 200] and sorted(ids["decontamination"]) == [*range(60)]
    assert set(ids["mixing"]) <= set(range(60)) and 30 < len(ids["mixing"]) < 100
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == sorted(ids["mixing"])
    assert corpus_pipeline.ORACLE_SQL is None


def test_cut_lines_counts_characters_anew(spark, documents):
    rows = [(i, f"{text(i)}\nshared by many sites", f"s{i}") for i in range(12)] + [(50, "shared by many sites", "s1"), (51, "", "s1")]
    found = {r.doc_id: r for r in corpus_pipeline.cut_lines(spark, documents(rows), "").collect()}
    assert sorted(found) == [*range(12), 51]
    assert all(r.n_chars == len(r.text) for r in found.values())
    assert found[0].text.endswith("sites") and found[1].text == text(1)


def test_pipeline_on_an_empty_table(spark, documents, tmp_path):
    documents([(1, "x", "s")]).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_stage_agrees_with_the_groups_of_its_operator(documents):
    rows = [(i, text(i % 7), "s") for i in range(30)]
    groups = {r.component for r in simhash.near_groups(documents(rows)).collect()}
    assert {r.doc_id for r in simhash.keep_one(documents(rows)).collect()} == groups
    assert decontaminate.plain(" A\n b ") == "a b"
