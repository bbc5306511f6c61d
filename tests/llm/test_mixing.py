from collections import defaultdict

import pytest
from compare import compare, connect
from pyspark.sql import functions as F

from opinara.llm import mixing, queries

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, source string, text string, extra int"


def filled(sizes, weights=(3, 1, 2), share=1.5, repeats=2):
    """Targets by sharing again and again until no source is above its bound."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > repeats * sizes[s]}
        if not full:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in full:
            target[s] = repeats * sizes[s]
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


def sums(rows):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    return sizes, taken


def near_targets(rows, slots):
    sizes, taken = sums(rows)
    targets = filled(sizes)
    total = sum(targets.values())
    assert total == pytest.approx(1.5 * sum(sizes.values()))
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 2 * r.size
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 24 * max(1, total / slots) + 1
    return taken


def test_equals_the_sql(spark):
    name = "op3_mixing"
    sql = queries.ORACLES[name]
    assert not compare(spark, connect(SF_DIR), queries.QUERIES[name], sql, SF_DIR)


def test_takes_what_the_targets_say(spark):
    rows = mixing.mix(queries.documents(spark, SF_DIR)).collect()
    assert sum(near_targets(rows, mixing.SLOTS).values()) > 1.4 * sum(r.size for r in rows)


def test_few_slots_still_come_near(spark):
    rows = mixing.mix(queries.documents(spark, SF_DIR), slots=1 << 12).collect()
    near_targets(rows, 1 << 12)


def test_edge_rows(spark):
    rows = [
        (1, "a", "x " * 50, 1), (1, "a", "x " * 50, 1), (2, "a", None, 2), (3, "b", "", 3), (4, None, "y z", 4),
        (None, None, "one two three", 5), (5, "null", "w " * 900, 6), (6, "c", "long " * 20_000, 7),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    near_targets(found, mixing.SLOTS)
    assert {r.taken for r in found if r.size == 0} == {0}
    again = mixing.mix(docs.orderBy(F.rand())).collect()
    assert sorted(found, key=repr) == sorted(again, key=repr)


def test_mixed_documents_hold_what_is_taken(spark):
    docs = queries.documents(spark, SF_DIR)
    taken = mixing.mix(docs).agg(F.sum("taken")).first()[0]
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == taken
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] == 2


def test_nothing_to_take(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    wordless = spark.createDataFrame([(1, "a", " \n", 1), (2, None, None, 2)], SCHEMA)
    assert [r.taken for r in mixing.mix(wordless).collect()] == [0, 0]
    assert mixing.mixed_documents(wordless).count() == 0


def test_no_python_in_the_plan(spark):
    plan = mixing.mix(queries.documents(spark, SF_DIR))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
