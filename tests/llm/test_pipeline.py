import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from opinara.llm import decontaminate, near_dup, quality_rules

SF_DIR = "/root/testdata/sf0.001"


def staged(spark, docs):
    """What went into each stage and what came out of it."""
    made = []
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.materialise(stage(spark, docs, SF_DIR), "stage")
        made.append((name, docs, out))
        docs = out
    return made


@pytest.fixture(scope="module")
def stages(spark):
    """All documents, some of them twice, some without a text, a language, a source or a key."""
    docs = corpus_pipeline.documents(spark, SF_DIR)
    n = F.col("doc_id")
    gaps = docs.where(n % 10 == 3).select(
        F.when(n % 3 > 0, n + 50_000).alias("doc_id"),
        *[F.when(n % 4 != i, F.col(c)).alias(c) for i, c in enumerate(c for c in docs.columns if c != "doc_id")],
    )
    blank = docs.limit(1).select(*[F.lit(None).cast(t).alias(c) for c, t in docs.dtypes])
    every = docs.union(docs.where(n % 10 == 4)).union(gaps.select(*docs.columns)).union(blank).union(blank)
    return staged(spark, corpus_pipeline.materialise(every, "docs"))


def pairs(df):
    return sorted(map(str, df.select("doc_id", "text").distinct().collect()))


def test_every_stage_keeps_rows_and_columns(stages):
    for name, docs, out in stages:
        assert out.count() > 100, name
        if name != "token records":
            assert out.columns == docs.columns


def test_a_stage_drops_what_its_operator_says(stages):
    (_, docs, passed), (_, _, single), (_, _, clean) = stages[:3]
    kept = quality_rules.judge(docs, judged=("text", "lang")).where("kept")
    same = (F.col("doc_id").eqNullSafe(F.col("_id"))) & (F.xxhash64("text", "lang") == F.col("_judged"))
    wanted = docs.join(kept.select(F.col("doc_id").alias("_id"), "_judged").distinct(), same, "left_semi")
    assert sorted(map(str, passed.collect())) == sorted(map(str, wanted.collect()))

    named = near_dup.near_duplicates(passed, shingle=near_dup.SHINGLE).where("kept")
    names = {r["doc_id"] for r in named.collect()}
    assert pairs(single) == sorted(str(r) for r in passed.select("doc_id", "text").distinct().collect() if r["doc_id"] in names)
    assert single.count() == single.select("doc_id", "text").distinct().count() < passed.count()

    benchmark = single.sparkSession.read.parquet(f"{SF_DIR}/benchmark.parquet")
    found = decontaminate.contaminated(single, benchmark).where("not contaminated")
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(r["doc_id"]) for r in found.collect())


def test_an_empty_table(spark):
    docs = corpus_pipeline.documents(spark, SF_DIR).where("false")
    for name, _, out in staged(spark, docs):
        assert out.count() == 0, name


def test_other_columns_with_names_of_the_stages_own(spark):
    names = ["id", "key", "row", "_id", "_judged", "component", "k1", "grp", "kept", "items", "size", "source_size"]
    docs = corpus_pipeline.documents(spark, SF_DIR).where("doc_id % 2 = 0")
    plain = [sorted(map(str, out.select(*docs.columns).collect())) for _, _, out in staged(spark, docs)[:4]]
    more = docs.withColumns({name: F.lit("x") for name in names})
    for (name, given, out), rows in zip(staged(spark, more)[:4], plain, strict=True):
        assert out.columns == given.columns, name
        assert sorted(map(str, out.select(*docs.columns).collect())) == rows, name
