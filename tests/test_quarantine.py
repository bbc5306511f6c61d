import json

import pytest
from pyspark.sql.types import IntegerType, StringType, StructType

from opinara.sources import schemas
from opinara.sources.quarantine import TooManyBadLines, ingest_csv, ingest_json

LABELS = StructType().add("Input_id", StringType()).add("labeldem", IntegerType())


def test_json_lines_are_parted(spark, tmp_path):
    lines = [
        '{"id": "a", "score": "7", "body": "two\\nlines", "more": [1]}',
        "",
        '{"id": "b", "score": 8',
        "no json",
        '{"id": "c", "score": "many", "created_utc": "soon"}',
        '{"id": "d", "body": null, "score": null}',
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines[:3]) + "\n")
    (tmp_path / "in" / "b.json").write_text("\n".join(lines[3:]) + "\n")
    held = ingest_json(spark, str(tmp_path / "in"), schemas.COMMENTS, str(tmp_path / "out"), most_bad=0.7)
    assert held.good.schema == schemas.COMMENTS
    assert sorted((r["id"], r["score"], r["body"]) for r in held.good.collect()) == [
        ("a", 7, "two\nlines"), ("d", None, None),
    ]
    bad = {r["line"]: r for r in held.bad.collect()}
    assert bad[lines[2]]["reason"] == bad[lines[3]]["reason"] == "malformed"
    assert bad[lines[2]]["file"].endswith("a.json") and bad[lines[3]]["file"].endswith("b.json")
    assert {r["block"] for r in bad.values()} == {0}
    (unfit,) = [json.loads(line) for line, r in bad.items() if r["reason"].startswith("field")]
    assert unfit == {"id": "c", "score": "many", "created_utc": "soon"}
    assert sorted(map(tuple, held.by_reason().collect())) == [("field created_utc", 1), ("malformed", 2)]


def test_too_many_bad_lines_fail_and_stay(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"id": "a"}\nx\n')
    with pytest.raises(TooManyBadLines) as caught:
        ingest_json(spark, str(tmp_path / "in.json"), schemas.SUBMISSIONS, str(tmp_path / "out"))
    assert (caught.value.bad, caught.value.lines) == (1, 2)
    assert spark.read.parquet(caught.value.path).where("_bad = 'true'").first()["_line"] == "x"


def test_blocks_tell_where_a_line_lay(spark, tmp_path):
    (tmp_path / "in.json").write_text("".join(f'{{"id": "{i}"}}\n' if i % 100 else "x\n" for i in range(2000)))
    with_blocks = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(with_blocks)
    spark.conf.set(with_blocks, "4096")
    try:
        held = ingest_json(spark, str(tmp_path / "in.json"), schemas.SUBMISSIONS, str(tmp_path / "out"), most_bad=0.05)
        assert held.good.count() == 1980 and held.bad.count() == 20
        blocks = {r["block"] for r in held.bad.collect()}
        assert len(blocks) > 2 and max(blocks) < (tmp_path / "in.json").stat().st_size
    finally:
        spark.conf.set(with_blocks, before)


def test_no_lines(spark, tmp_path):
    (tmp_path / "in.json").write_text("\n\n")
    held = ingest_json(spark, str(tmp_path / "in.json"), schemas.SUBMISSIONS, str(tmp_path / "out"), most_bad=0)
    assert held.good.count() == held.bad.count() == 0


def test_csv_fields_and_types(spark, tmp_path):
    (tmp_path / "in.csv").write_text("n,labeldem,Input_id\n0,1,a\n0,,b\n0,1\n0,1,c,9\n0,one,d\n\n")
    held = ingest_csv(spark, str(tmp_path / "in.csv"), LABELS, str(tmp_path / "out"), most_bad=0.9)
    assert held.good.schema == LABELS
    assert sorted(map(tuple, held.good.collect())) == [("a", 1), ("b", None)]
    found = {(r["reason"], r["line"]) for r in held.bad.collect()}
    assert found == {
        ("malformed", "0,1"), ("malformed", "0,1,c,9"), ("field labeldem", '{"Input_id":"d","labeldem":"one"}'),
    }


def test_what_cannot_be_read(spark, tmp_path):
    (tmp_path / "in.csv").write_text("Input_id\na\n")
    with pytest.raises(ValueError, match="labeldem"):
        ingest_csv(spark, str(tmp_path / "in.csv"), LABELS, str(tmp_path / "out"))
    with pytest.raises(ValueError, match="_line"):
        ingest_json(spark, "x", StructType().add("_line", StringType()), str(tmp_path / "out"))
