"""Spelling variants against all pairs, with edge rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from opinara.llm import queries, variants

SCHEMA = "doc_id long, text string, word string, n int, key string, form string"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(x, y):
    if len(x) == len(y):
        return sum(p != q for p, q in zip(x, y, strict=True)) == 1
    short, long_ = sorted((x, y), key=len)
    return len(long_) == len(short) + 1 and any(long_[:i] + long_[i + 1 :] == short for i in range(len(long_)))


def by_hand(rows):
    counts = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    by_length = {}
    for word in counts:
        by_length.setdefault(len(word), []).append(word)
    forms, result = {}, {}
    for word, n in counts.items():
        others = [y for m in (-1, 0, 1) for y in by_length.get(len(word) + m, []) if y != word and near(word, y)]
        best = min(others, key=lambda y: (-counts[y], y), default=None)
        if best is not None and counts[best] >= 2 * n:
            forms[word] = best
        result[word] = (forms.get(word), n, len(others), counts[forms[word]] if word in forms else None)
    found = set()
    for word, (form, n, n_near, form_n) in result.items():
        root = word
        while root in forms:
            root = forms[root]
        found.add((word, form, root, n, n_near, form_n))
    return found


@pytest.fixture(scope="module")
def rows(spark):
    held = [(r.doc_id, r.text) for r in queries.documents(spark, "/root/testdata/sf0.001").collect()][:60]
    rng = random.Random(5)
    close = ["".join(rng.choice("abé") for _ in range(rng.randint(4, 7))) for _ in range(900)]
    edge = [
        None, "", " \n\t", "1234 !!", "HELLO Hello hello hallo hallo hallo hello hello hello", "z" * 3000, "z" * 3000,
        "z" * 3000 + " " + "z" * 2999, "z" * 2999, "z" * 2999, "straße strasse straße straße Straße Àéîõü× ÷abcde",
        " ".join(close), " ".join(close[::-1]), "日本abcdef日本 abcdef abcdef abcdeg",
    ]
    held += [(100_000 + i, text) for i, text in enumerate(edge)]
    return held + [(None, "hello hello hallo"), (100_004, edge[4]), (100_004, edge[4])]


def answer(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "clash", 1, "clash", "clash") for r in rows], SCHEMA)
    made = variants.group_variants(docs, **options)
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in made.collect()]


def test_variants_equal_all_pairs(spark, rows):
    wanted = by_hand(rows)
    found = answer(spark, rows)
    assert len(found) == len(wanted) and set(found) == wanted
    assert any(form for _, form, *_ in wanted)


def test_splitting_groups_loses_no_pair(spark, rows):
    found = answer(spark, rows, largest=3)
    assert set(found) == by_hand(rows)


def test_an_empty_table_has_no_words(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert variants.group_variants(empty).collect() == []


def test_a_root_is_reached_over_a_long_chain(spark):
    letters = "abcdefghij"
    # Each word differs from the next by one character.
    chain, word = [], list("qqqqqqqqqq")
    for i in range(9):
        chain.append(("".join(word), 3 * 2**i))
        word[i] = letters[i]
    docs = spark.createDataFrame([(1, " ".join([w] * n)) for w, n in chain], "doc_id long, text string")
    found = {r.word: r.root for r in variants.group_variants(docs).collect()}
    wanted = by_hand([(1, " ".join([w] * n)) for w, n in chain])
    assert found == {word: root for word, _, root, *_ in wanted}


def test_index_extends_to_either_side():
    words = ["banana", "bandana", "ananas"]
    letters = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
    index = variants.BidirectionalIndex(letters, np.array([0, 6, 13, 19]))
    state = index.whole(np.zeros(1, dtype=np.int64))
    for char, right in (("n", False), ("a", True), ("a", False), ("n", True), ("a", True)):
        state = index.extend(state, index.symbol[np.array([ord(char)])].astype(np.int64), right)
    assert state.size[0] == sum("".join(w)[i : i + 5] == "anana" for w in words for i in range(len(w)))
