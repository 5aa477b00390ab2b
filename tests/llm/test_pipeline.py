from collections import Counter

import corpus_pipeline
import __spark_entry__ as entry
from billetic.llm import crf, decontamination, mixing, simhash
from billetic.llm._common import table

SF = "/root/testdata/sf0.001"


def test_stages_and_registration():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_near_dedup", "benchmark_decontamination", "mixing", "sharding"]
    queries = entry.queries()
    assert queries["pipeline"] is corpus_pipeline.run
    assert {int(q[2:].split("_")[0]) for q in queries if q.startswith("op")} == set(range(1, 14))


def test_each_stage_on_its_own_input(spark):
    df = table(spark, SF, "documents")
    stages, columns = dict(corpus_pipeline.STAGES), df.columns
    total = Counter(tuple(r) for r in df.collect())

    spoken = stages["language_id"](spark, df, SF)
    assert spoken.columns == columns
    und = {r.doc_id for r in crf.identify(df).filter("lang_pred = 'und' or score < 1/3").collect()}
    assert Counter(tuple(r) for r in spoken.collect()) == Counter(
        {r: n for r, n in total.items() if r[0] not in und})

    single = stages["simhash_near_dedup"](spark, df, SF)
    own = {r.doc_id for r in simhash.near_duplicates(df).filter("doc_id = component_id").collect()}
    assert single.columns == columns and sorted(r.doc_id for r in single.collect()) == sorted(own)

    clean = stages["benchmark_decontamination"](spark, df, SF)
    bad = {r.doc_id for r in decontamination.leaks(df, table(spark, SF, "benchmark")).collect()}
    assert clean.columns == columns and bad
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r[0] for r in total if r[0] not in bad)

    mix = stages["mixing"](spark, df, SF)
    copies = {r.doc_id: r.copies for r in mixing.mix(df).collect() if r.copies}
    assert mix.columns == columns and Counter(r.doc_id for r in mix.collect()) == copies


def test_whole_run(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    slots = Counter(r.shard for r in got)
    assert got and all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in slots.items())


def test_odd_documents(spark, tmp_path):
    schema = table(spark, SF, "documents").schema
    odd = [(1, None, None, None, None), (2, "", "en", None, 0), (None, "the and of that", "en", "a", 15),
           (None, "the and of that", "en", "a", 15), (3, "x " * 40_000, None, "b", 1), (3, "x " * 40_000, None, "b", 1),
           *[(i, f"the thing and that number {i} " * 5, "en", "a", 1) for i in range(10, 40)]]
    for name, rows in (("odd", odd), ("empty", [])):
        d = f"{tmp_path}/{name}"
        spark.createDataFrame(rows, schema).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        out = corpus_pipeline.run(spark, d)
        assert out.columns[0] == "doc_id" and (out.count() > 0) == (name == "odd")
