"""The pipeline stage by stage against plain versions, and run() against the stages."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from heliograph.llm import decontam, outliers, quality
from heliograph.llm.common import read
from heliograph.llm.oracles import MIXING
from tests.llm.test_brute_force import _plain_components


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """(input, output) rows of each stage, written and read again as the driver does."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), read(spark, sf, "documents"), []
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        path = str(folder / str(k))
        f(spark, docs, sf).write.parquet(path)
        found = spark.read.parquet(path)
        out.append((docs, found))
        docs = found
    return out


def _ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_names_and_columns(stages, spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "quality rules", "MinHash near-dedup", "benchmark decontamination", "mixing sources to target weights"]
    for _, found in stages[:-1]:
        assert found.columns == read(spark, sf, "documents").columns


def test_quality_stages_follow_the_operators(stages, spark, sf):
    docs, found = stages[0]
    assert _ids(found) == _ids(quality.classify(docs, read(spark, sf, "labels")).filter("predicted = 1"))
    docs, found = stages[1]
    assert _ids(found) == _ids(outliers.judge(docs).filter("kept"))


def test_dedup_keeps_one_of_each_group(stages):
    docs, found = stages[2]
    rows = [(r.doc_id, " ".join(r.text.encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).decode().split(None))) for r in docs.collect()]
    first = _plain_components(rows, 5, 0.8)
    assert _ids(found) == sorted(i for i in first if first[i] == i)


def test_decontamination_drops_what_holds_a_window(stages, spark, sf):
    docs, found = stages[3]
    windows = set()
    for r in read(spark, sf, "benchmark").collect():
        w = decontam.words_of(r.text)
        windows |= {tuple(w[i : i + 10]) for i in range(max(0, len(w) - 10) + 1 if w else 0)}
    sizes = {len(w) for w in windows}
    clean = []
    for r in docs.collect():
        w = decontam.words_of(r.text)
        if not any(tuple(w[i : i + k]) in windows for k in sizes for i in range(len(w) - k + 1)):
            clean.append(r.doc_id)
    assert _ids(found) == sorted(clean)


def test_mix_agrees_with_sql(stages, sf):
    docs, found = stages[4]
    c = duckdb.connect()
    documents = docs.select("doc_id", "source", "text").toPandas()  # noqa: F841  DuckDB reads it by name
    c.execute(f"create view labels as select * from '{sf}/labels.parquet'")
    want = sorted((r[0], r[1], r[2], f"{r[3]:.9g}", r[4]) for r in c.execute(MIXING).fetchall())
    assert sorted((r.doc_id, r.size, r.source_size, f"{r.target:.9g}", r.taken) for r in found.collect()) == want


def test_run_is_the_stages_in_turn(stages, spark, sf):
    assert sorted(map(str, corpus_pipeline.run(spark, sf).collect())) == sorted(map(str, stages[-1][1].collect()))


def test_odd_rows_pass_every_stage(spark, sf, tmp_path):
    rng = random.Random(0)
    text = lambda: " ".join(rng.choice("abcdefghij") * rng.randrange(1, 6) for _ in range(80))
    same = text()
    rows = [(1, same, "en", "s", 1), (1, same, "en", "s", 1), (None, text(), None, None, None), (3, None, "en", "s", 0), (4, "", "en", None, 0), (5, text() * 50, "en", "s", 9), (6, same, "en", "t", 1)]
    rows += [(7, "word " * 200_000, "en", "s", 1), (8, same, "en", "s", None), (9, " \n\t", None, "t", 3)]
    names = ["row", "text_key", "kept", "size", "k", "__s"]
    for k, some in enumerate((rows, [])):
        docs = spark.createDataFrame(some, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit(c) for c in names})
        given = {tuple(r) for r in docs.collect()}
        for i, (_, f) in enumerate(corpus_pipeline.STAGES):
            before = docs
            f(spark, docs, sf).write.parquet(path := str(tmp_path / f"{k}-{i}"))
            docs = spark.read.parquet(path)
            if i < 4:
                assert docs.columns == before.columns and {tuple(r) for r in docs.collect()} <= given
        assert docs.count() == before.count() and docs.filter("taken > 2 * size").count() == 0


def test_what_odd_rows_come_to(spark, sf):
    """Null, blank and repeated rows, stage by stage, as the docstrings say."""
    same = "one two three four five six seven"
    docs = spark.createDataFrame([(2, same), (2, same), (1, same), (3, None), (4, " ")], "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s")})
    left = {name: sorted(r.doc_id for r in f(spark, docs, sf).collect()) for name, f in corpus_pipeline.STAGES}
    assert left["quality rules"] == [] and left["MinHash near-dedup"] == [1, 3, 4] and left["benchmark decontamination"] == left["mixing sources to target weights"] == [1, 2, 2, 3, 4]
