import pytest
from pyspark.sql import functions as F

from opinara.operators import rates as R
from opinara.operators import report
from opinara.sources import write_table


@pytest.fixture(scope="module")
def scored(spark):
    rows = [
        ("a", "t trump", 1.0, 0.0), ("a", "t trump", 0.0, 1.0), ("a", "Trump", None, 1.0),
        ("b", None, 1.0, 1.0), (None, "x", 0.0, 0.0), ("n", "y", None, None),
    ]
    return spark.createDataFrame(rows, "k string, title string, pos double, neg double")


def test_rates_leave_missing_flags_out(scored):
    found = R.rates(scored, ["k"], report.BOTH, [F.asc_nulls_first("k")], support="n")
    assert [tuple(r) for r in found.collect()] == [
        (None, 0.0, 0.0, 1), ("a", 0.5, 2 / 3, 3), ("b", 1.0, 1.0, 1), ("n", None, None, 1),
    ]


def test_rates_do_not_depend_on_partitions(scored):
    once = R.rates(scored, ["k"], report.BOTH).collect()
    again = R.rates(scored.repartition(5), ["k"], report.BOTH).collect()
    assert set(map(tuple, once)) == set(map(tuple, again))


def test_compare_subset(scored):
    row = R.compare_subset(scored, F.contains("title", F.lit("trump")), report.BOTH).first()
    assert row.asDict() == {
        "positive_subset": 0.5, "positive_all": 0.5, "negative_subset": 0.5, "negative_all": 0.6,
    }


def test_top_groups_breaks_ties_by_key(scored):
    top = R.top_groups(scored, ["k"], "neg", k=2)
    assert [(r.k, r.rate) for r in top.collect()] == [("b", 1.0), ("a", 2 / 3)]
    assert [r.k for r in R.top_groups(scored, ["k"], "neg", min_support=2).collect()] == ["a"]
    tied = R.top_groups(scored.where("k <> 'a'").fillna(1.0), ["k"], "neg", k=3).collect()
    assert [r.k for r in tied] == ["b", "n"]


def test_counts(scored, tmp_path):
    assert R.stage_counts(scored, ["pos", "neg"]).first() == (6, 2, 3)
    stages = R.count_stages({"all": scored, "known": scored.where("k IS NOT NULL")})
    assert {tuple(r) for r in stages.collect()} == {("all", 6), ("known", 5)}
    observed, counts = R.observe_counts(scored, ["pos"])
    write_table(observed, str(tmp_path / "t"))
    assert counts.get == {"n_rows": 6, "pos": 2}


def test_rate_report_and_shades(scored):
    both = report.rate_report(scored, "state", exclude=["n"], key_column=F.col("k"))
    assert {r.state for r in both.collect()} == {None, "a", "b"}
    shade = report.shading(both, "positive", 0.0, 1.0, skip=["a"])
    assert {tuple(r) for r in shade.collect()} == {(None, 1.0), ("b", 0.0)}
    shades = report.shade_report(both, {"positive": (0.0, 1.0), "negative": (0.0, 1.0)}, ["a"])
    assert shades.count() == 4 and shades.columns == ["state", "measure", "shade"]


def test_stored_tallies_equal_rates_of_all_rows(spark, tmp_path):
    """Days appended, corrected and emptied; other days' files stay as they are."""
    path = str(tmp_path / "tallies")
    schema = "day string, key string, f double"
    first = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 0.0), ("b", "x", None), (None, "x", 1.0), ("c", "x", 1.0)], schema)
    R.store_tally(first, path, "day", ["key"], {"rate": "f"})

    def files(day):
        return sorted(p.name for p in (tmp_path / "tallies" / f"day={day}").glob("*.parquet"))

    before = files("a")
    changed = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 0.0), ("b", "z", 1.0), ("b", "x", 0.0), (None, "x", 1.0), ("d", "x", 0.0)], schema)
    R.store_tally(changed, path, "day", ["key"], {"rate": "f"}, ["b", "c", "d"])
    assert files("a") == before
    stored = spark.read.schema("key string, n_rows long, rate_sum double, rate_count long, day string").parquet(path)
    for keys in (["day"], ["key"], ["day", "key"]):
        found = R.stored_rates(stored, keys, ["rate"], support="n").select(*keys, "rate", "n")
        wanted = R.rates(changed, keys, {"rate": "f"}, support="n").select(*keys, "rate", "n")
        assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, wanted.collect()), key=repr)
