"""The Merkle manifest against one built by hand, with edge rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from opinara.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, tree int, pos int, node int"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)]
    return digest("".join(parts))


def levels(nodes):
    built = [nodes]
    while len(built[-1]) > 1:
        below = built[-1]
        built.append([digest("".join(below[i : i + 3])) for i in range(0, len(below), 3)])
    return built


def climb(built, place, folded):
    siblings = ""
    for level in built[:-1]:
        first = place // 3 * 3
        run = level[first : first + 3]
        at = place - first
        siblings += "".join(run[:at] + run[at + 1 :])
        folded = digest("".join(run[:at] + [folded] + run[at + 1 :]))
        place //= 3
    return siblings, folded


def by_hand(rows):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    ordered = {
        s: sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
        for s in sources
    }
    trees = {s: levels([leaf(r, r[4]) for r in ordered[s]]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    found = []
    for i, source in enumerate(sources):
        for place, row in enumerate(ordered[source]):
            text = row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            lower, folded = climb(trees[source], place, leaf(row, text))
            upper, folded = climb(top, i, folded)
            found.append(
                (row[0], leaf(row, row[4]), trees[source][-1][0], top[-1][0], digest(lower + upper), folded, folded == top[-1][0])
            )
    return sorted(found, key=repr)


def verified(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "clash", 1, 2, 3) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in merkle.verify(docs, **options).collect()), key=repr)


def rows_of(n, sources):
    texts = [None, "", "one\ntwo", "long " * 20_000, "é\n\n日本", "no feed"]
    return [
        (i * 7 % 1000 + i // 1000, sources[i % len(sources)], None if i % 5 == 0 else "en", None if i % 7 == 0 else i, texts[i % 6])
        for i in range(n)
    ]


@pytest.mark.parametrize("n", [1, 3, 4, 10, 28, 40, 90])
def test_one_source(spark, n):
    rows = rows_of(n, ["s"])
    assert verified(spark, rows) == by_hand(rows)


def test_many_sources_of_all_sizes(spark):
    rows = rows_of(300, ["a", "b", None, "", "é", "z", "a", "a", "Z", "\U0001f600"])
    rows += [(None, "a", "en", 1, "x\ny"), (None, "a", "en", 1, "x\ny"), (3, "alone", None, None, None)]
    rows += [(5, "b", "en", 1, "same\nrow")] * 3 + [(5, "b", "en", 1, "another")]
    assert verified(spark, rows) == by_hand(rows)


def test_a_source_over_several_blocks(spark):
    rows = rows_of(2 * merkle.BLOCK + 7, ["a", "a", "a", "b"])
    assert verified(spark, rows) == by_hand(rows)


def test_each_source_its_own_row(spark):
    rows = [(i, f"s{i}", "en", 1, "a\nb") for i in range(30)]
    assert verified(spark, rows) == by_hand(rows)


def test_untampered_rows_verify_and_any_change_does_not(spark):
    rows = rows_of(50, ["a", "b"])
    assert all(r[-1] for r in verified(spark, rows, text=F.col("text")))
    changed = verified(spark, rows, text=F.concat(F.coalesce("text", F.lit("")), F.lit("!")))
    assert not any(r[-1] for r in changed)


def test_an_empty_table_has_no_root(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.verify(empty).collect() == [] and merkle.build(empty).root is None
