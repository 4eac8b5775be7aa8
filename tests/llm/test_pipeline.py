import re

import public_tokenizers as P
import numpy as np
import pyarrow as pa
import tiktoken

import corpus_pipeline
from tallyline.llm import bpe, common, decontaminate, jaccard

PATH = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    columns = docs.columns
    held = {}
    for name, stage in corpus_pipeline.STAGES:
        held[name] = stage(spark, docs, PATH).cache()
        if name != "encoded":
            assert held[name].columns == columns, name
            before = {r.doc_id for r in docs.collect()}
            assert {r.doc_id for r in held[name].collect()} <= before
            docs = held[name]
    good = {r.doc_id for r in spark.read.parquet(f"{PATH}/labels.parquet").where("quality = 1").collect()}
    bad = {r.doc_id for r in spark.read.parquet(f"{PATH}/labels.parquet").where("quality = 0").collect()}
    kept = {r.doc_id for r in held["quality"].collect()}
    assert len(good & kept) >= 0.97 * len(good) and len(bad & kept) <= 0.25 * len(bad)
    groups = {r.doc_id: r.component_id for r in jaccard.join(held["quality"]).collect()}
    assert {r.doc_id for r in held["near_copies"].collect()} == {d for d, c in groups.items() if d == c}
    items = [decontaminate.plain(r.text) for r in spark.read.parquet(f"{PATH}/benchmark.parquet").collect()]
    clean = held["decontaminated"].collect()
    assert len(clean) < held["near_copies"].count() and not any(i in decontaminate.plain(r.text) for r in clean for i in items)
    masked = {r.doc_id: r.text for r in held["sanitised"].collect()}
    assert set(masked) == {r.doc_id for r in clean} and not any("@mail" in t for t in masked.values())
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    for r in held["encoded"].collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(masked[r.doc_id])


def test_empty_tables_and_other_columns(spark, tmp_path):
    shape = "doc_id long, text string, lang string, source string, n_chars long, __text string, score double, n int, component_id long, block int"
    rows = [(k, f"some words of a text {k} " * 20, "en", "s", 5, "x", 0.5, 1, 2, 3) for k in range(30)]
    for name, data in (("none", []), ("some", rows)):
        path = f"{tmp_path}/{name}"
        spark.createDataFrame(data, shape).write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
        docs = spark.read.parquet(f"{path}/documents.parquet")
        for stage, function in corpus_pipeline.STAGES[:-1]:
            docs = function(spark, docs, path)
            assert docs.columns == [c.split(" ")[0] for c in shape.split(", ")], stage
        assert corpus_pipeline.run(spark, path).count() == (0 if not data else docs.count())


def test_run_and_odd_rows(spark, tmp_path):
    rows = [(1, "one two three four five six seven", "en", None, 5), (2, None, None, None, None), (3, "", "en", "s", 0), (None, "no id", "en", "s", 5), (1, "one two three four five six seven", "en", None, 5)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = [r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert len(got) == len(set(got)) == 4 and set(got) == {None, 1, 2, 3}


def test_driver_gives_freed_memory_back(spark):
    jvm = spark._jvm

    def held():
        with open(f"/proc/{jvm.java.lang.ProcessHandle.current().pid()}/smaps_rollup") as f:
            return int(re.search(r"\nPss_Anon:\s+(\d+)", f.read())[1]) / 1024

    common.materialize(spark.range(1), "one")
    used = [jvm.java.util.zip.Deflater() for _ in range(1500)]
    for x in used[:-1]:  # the last one stays above what the others free
        x.end()
    before = held()
    common.materialize(spark.range(1), "one")
    assert held() < before - 50
    used[-1].end()


def test_a_stage_begins_by_giving_back_what_the_one_before_left(spark):
    cores = spark.sparkContext.defaultParallelism
    docs = spark.read.parquet(f"{PATH}/documents.parquet")

    def collections():  # of the whole heap, after which it shrinks
        every = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(x.getCollectionCount() for x in every if "Young" not in x.getName())

    def keep(batches):
        common.kept("another", (), lambda: 1)
        yield from batches

    def left(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(common._KEPT)] * len(batch), pa.int64())], names=["n"])

    for stage in (corpus_pipeline.decontaminated, corpus_pipeline.encoded):
        spark.range(0, cores, 1, cores).mapInArrow(keep, "id long").collect()
        before = collections()
        stage(spark, docs, PATH)
        assert collections() > before
        assert not any(r.n for r in spark.range(0, cores, 1, cores).mapInArrow(left, "n long").collect())
    spark.range(0, cores, 1, cores).mapInArrow(keep, "id long").collect()
    before = collections()
    corpus_pipeline.unburden(spark, workers=False)
    assert collections() > before and any(r.n for r in spark.range(0, cores, 1, cores).mapInArrow(left, "n long").collect())
