"""Operators against brute force on small tables, with edge rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from opinara.llm import text as T
from opinara.llm import (
    decontaminate,
    line_dedup,
    log_bilinear,
    near_dup,
    quality_lm,
    quality_rules,
    queries,
    suffix_dedup,
    token_records,
    warc,
)

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, h string, key int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"w{i}" for i in range(130))


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


@pytest.fixture(scope="module")
def rows(spark):
    held = [(r.doc_id, r.text, r.lang) for r in queries.documents(spark, SF_DIR).collect()][:120]
    edge = [
        None, "", " \n\t", "one", "a b c", BASE, BASE, BASE.replace("w7 ", "v7 "), BASE.upper(), "long " * 30_000,
        "A line of six words here\nA line of seven words here now\na line of six words here",
        "\n".join(f"the same words but number {i} here" for i in range(40)), "é ü \x1c *#$",
    ]
    held += [(100_000 + i, text, None if i % 3 else "xx") for i, text in enumerate(edge)]
    return held + [(100_005, BASE, "en")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, "clash", "clash", 1) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def linked_by_hand(rows):
    """Each key's set and component, from all pairs."""
    sets = {}
    for key, text, _ in rows:
        words = WORD.findall(lower(text or ""))
        grams = [tuple(words)] if 0 < len(words) < 4 else [tuple(words[i : i + 4]) for i in range(len(words) - 3)]
        sets[key] = set(grams)
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (len(sets[k]), find(k)) for k in keys}


def test_near_duplicates(docs, empty, rows):
    expected = linked_by_hand(rows)
    found = near_dup.near_duplicates(docs, shingle=4).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n_shingles, r.component_id) == expected[r.doc_id]
        assert r.kept == (r.component_id == r.doc_id)
    assert near_dup.near_duplicates(empty).count() == 0


def test_near_duplicates_in_dense_regions(spark):
    """Copies with one to nine changed words, so that some are linked only through others."""
    rng = np.random.default_rng(5)
    rows = []
    for key in range(260):
        words = BASE.split()
        for at in rng.choice(len(words), 1 + key % 9, replace=False):
            words[at] = f"v{rng.integers(3)}"
        rows.append((key, " ".join(words), "en"))
    expected = linked_by_hand(rows)
    assert len({component for _, component in expected.values()}) > 5
    docs = spark.createDataFrame([(*r, "s", 1, "clash", "clash", 1) for r in rows], SCHEMA)
    found = near_dup.near_duplicates(docs, shingle=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected


def test_near_duplicates_held_by_single_links(spark):
    """2000 edits of one template: 50 centres, each linked at 80 to 82 % to 39 others that are no links."""
    rng = np.random.default_rng(8)
    template = [f"t{i}" for i in range(300)]

    def edited(words, n):
        words = list(words)
        for at in rng.choice(74, n, replace=False) * 4 + 3:
            words[at] = f"v{rng.integers(60)}"
        return words

    texts = []
    for _ in range(50):
        centre = edited(template, 14)
        texts += [centre, *(edited(centre, 8) for _ in range(39))]
    keys = rng.permutation(len(texts))
    shingles = {}
    held = np.zeros((len(texts), 60_000), dtype=np.float32)
    for row, words in enumerate(texts):
        for i in range(len(words) - 3):
            held[row, shingles.setdefault(tuple(words[i : i + 4]), len(shingles))] = 1
    common = held @ held.T
    sizes = held.sum(axis=1)
    likeness = common / (sizes[:, None] + sizes[None] - common)
    linked = 100 * common >= 80 * (sizes[:, None] + sizes[None] - common)
    component = np.array(keys)
    while True:
        least = np.where(linked, component[None], len(texts)).min(axis=1)
        if (least == component).all():
            break
        component = least
    assert len(set(component)) >= 50 and (likeness[linked & (likeness < 0.82)].size > 2000)
    rows = [(int(k), " ".join(w), "en", "s", 1, "clash", "clash", 1) for k, w in zip(keys, texts, strict=True)]
    found = near_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA), shingle=4).collect()
    assert {r.doc_id: r.component_id for r in found} == dict(zip(keys.tolist(), component.tolist(), strict=True))


def test_near_duplicates_of_an_unlike_first(spark):
    """Links between texts that share a boilerplate with a smaller key's, and little else."""
    rng = np.random.default_rng(9)
    shared = " ".join(f"b{i}" for i in range(70))
    rows = []
    for family in range(60):
        own = [f"f{family}x{i}" for i in range(60 + family)]
        for copy in range(3):
            words = list(own)
            words[int(rng.integers(len(words)))] = f"c{copy}"
            rows.append((family * 3 + copy, shared + " " + " ".join(words), "en"))
    expected = linked_by_hand(rows)
    docs = spark.createDataFrame([(*r, "s", 1, "clash", "clash", 1) for r in rows], SCHEMA)
    found = near_dup.near_duplicates(docs, shingle=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected


def test_quality_rules(docs, empty, rows):
    wanted = Counter()
    for key, text, _ in rows:
        text = text or ""
        words = WORD.findall(text)
        lines = [line for line in text.split("\n") if WORD.search(line)]
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        wanted[
            key, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered), failed,
        ] += 1
    found = quality_rules.judge(docs).collect()
    assert Counter(tuple(r)[:7] for r in found) == wanted
    assert not any(r.kept for r in found if r.base_failed)
    assert quality_rules.judge(empty).count() == 0


@pytest.mark.parametrize("most", [0, 1, 900])
def test_rare_grams_beyond_what_a_task_holds_are_joined(spark, docs, most):
    def judged(**options):
        rows = quality_rules.judge(docs, **options).collect()
        names = [(*tuple(r)[:8], r.lang, None if r.perplexity is None else float(f"{r.perplexity:.9g}")) for r in rows]
        return Counter(names)

    assert judged(most=most) == judged()


def test_kneser_ney_sums_to_one():
    data = np.frombuffer(b"abcabcabdabca", np.uint8)
    starts, ends = np.array([0, 3, 6, 9]), np.array([3, 6, 9, 13])
    made = quality_rules.word_grams(data, starts, ends, np.ones(4, np.uint64))
    grams, counts = np.unique(np.choose(made.reach - 1, made.grams), return_counts=True)
    model = quality_rules.estimate(grams, counts)
    for context in (b"", b"a", b"ab", b"abc", b"bd"):
        total = 0.0
        for symbol in [*range(256), None]:
            word = context if symbol is None else context + bytes([symbol])
            own = np.frombuffer(word or b"\0", np.uint8)
            own = quality_rules.word_grams(own, np.array([0]), np.array([len(word)]), np.ones(1, np.uint64))
            total += math.exp(model.score(own)[len(context)])
        assert total == pytest.approx(1, abs=1e-4)


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(
        [(1, "http://a/\r\nb", "<html lang=fr><title>T &amp; U</title><p>x<b>y</b></p><script>z</script>é"),
         (2, None, None), (1, "http://a/", ""), (None, "u", "<a href='/l'>k</a>")],
        "page_id long, url string, html string",
    )
    derived = warc.derivatives(warc.page_responses(pages))
    found = derived.collect()
    assert [r.text for r in found if r.n_links == 0 and r.text][0] == "T & U\nxy\né"
    assert len({r.metadata_id for r in found}) == 4 and not any(r.error for r in found)
    for r in found:
        headers, block = warc.parse(bytes(r.conversion))
        assert headers["warc-refers-to"] == r.response_id and block.decode() == r.text
        assert headers["warc-block-digest"] == warc.digest(block) and headers["warc-concurrent-to"] == r.metadata_id
        assert ("warc-target-uri" in headers) == (r.target_uri is not None)
    written = warc.write_records(derived, str(tmp_path)).collect()
    assert sum(r.n_records for r in written) == 8
    read = warc.read_records(spark, str(tmp_path)).collect()
    assert {r.record_id for r in read} == {x for r in found for x in (r.metadata_id, r.conversion_id)}
    broken = spark.createDataFrame([(7, bytearray(b"WARC/1.1\r\nno")), (8, None)], warc.RESPONSES)
    assert all(r.error for r in warc.derivatives(broken).collect())


def test_line_dedup(spark, docs, empty, rows):
    seen, earlier, wanted = set(), {}, {}
    for key, text in sorted({(k, t or "") for k, t, _ in rows}):
        gone = []
        for i, line in enumerate(text.split("\n")):
            words = tuple(line.encode().lower().split())
            if not words:
                continue
            if words in seen:
                gone.append(i)
                continue
            seen.add(words)
            if len(words) >= line_dedup.LEAST_WORDS and len(words) < 200:
                variants = [words, *[words[:j] + words[j + 1 :] for j in range(len(words))]]
                near = {o for v in variants for o in earlier.get(v, ())}
                if any(line_dedup.within_one_edit(list(o), list(words)) for o in near):
                    gone.append(i)
                for v in variants:
                    earlier.setdefault(v, set()).add(words)
        wanted[key] = gone
    found = {r.doc_id: list(r.removed) for r in line_dedup.removed_lines(docs).collect()}
    assert {k: v for k, v in found.items() if v} == {k: v for k, v in wanted.items() if v}
    cut = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert cut[100_011].count("\n") == 0 and cut[100_000] is None
    assert line_dedup.removed_lines(empty).count() == 0


def test_quality_lm(spark, docs, empty):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    every = queries.documents(spark, SF_DIR)
    found = quality_lm.judge(every, labels)
    assert found.count() == every.count()
    joined = found.join(labels.where("quality = 1 and toxic = 0"), "doc_id").agg({"kept": "count"}).first()[0]
    kept = found.where("kept").join(labels.where("quality = 1 and toxic = 0"), "doc_id").count()
    assert kept >= 0.9 * joined
    assert quality_lm.judge(docs, labels).where("n_tokens = 1 and kept").count() == 0
    with pytest.raises(ValueError):
        quality_lm.judge(every, labels.where("false"))
    assert quality_lm.judge(empty, labels).collect() == []
    assert quality_lm.judge(empty, labels.where("false")).collect() == []


def test_quality_lm_learns_from_every_trusted_text(spark):
    """Texts of words of their own: those of the half that is learnt from are all known alike."""
    n = 8600
    docs = spark.createDataFrame([(i, f"a{i} b{i} c{i}", "en") for i in range(n)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(n)], "doc_id long, quality int, toxic int")
    taught = {i for i in range(n) if int(hashlib.md5(str(i).encode()).hexdigest()[0], 16) % 2 == 0}
    found = {r.doc_id: r.perplexity for r in quality_lm.judge(docs, labels).collect()}
    assert len(taught) > 4200 and len(found) == n
    least = min(found[i] for i in found if i not in taught)
    assert all(found[i] < 0.9 * least for i in taught)


def test_quality_lm_keeps_the_model_off_the_driver(spark, docs, monkeypatch):
    """Small shards and groups give the sums of one shard, and no table is fetched."""

    def refuse(self):
        raise AssertionError("the model went to the driver")

    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    every = queries.documents(spark, SF_DIR).unionByName(docs.selectExpr("doc_id", "text", "lang", "source", "n_chars"))
    monkeypatch.setattr(type(every), "toArrow", refuse)
    found = []
    for entries, size in ((1 << 40, 1 << 40), (1 << 13, 1 << 16)):
        monkeypatch.setattr(quality_lm, "SHARD_ENTRIES", entries)
        monkeypatch.setattr(quality_lm, "GROUP_BYTES", size, raising=False)
        found.append(sorted((r.doc_id, r.n_tokens, r.perplexity, r.kept) for r in quality_lm.judge(every, labels).collect()))
    assert len(found[0]) == len(found[1]) == every.count()
    for a, b in zip(*found, strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-4) and a[3] == b[3]


def test_encoder_equals_the_tokenizer(monkeypatch):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    texts = [
        "", " \t\n", "It's A.B.C. rock'n'roll, don't CAN'T!!", "a<|b <|end|> <|endoftext|>x X<|", "é É é İ ﬁ Ⅷ ǅ ß ẞ",
        "中文字 mixed中文 a\u0085b a b  ", "x" * 5000 + "...", "12,345 a1b2! ...!? don't.", "naïve. über- ça,", "''' 's 't",
        "\x00a\x00 ​z \U0001f600!", "Word word, word. word", "'s's it's's",
    ]
    tokenizer = Tokenizer.from_file(path)
    wanted = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    column = pa.array([None, *[t.encode() for t in texts]], pa.binary())
    for remembered, limit in ((400_000, 1 << 20), (5, 40), (5, 1 << 20)):
        monkeypatch.setattr(token_records, "REMEMBERED", remembered)
        encoder, found = token_records.Encoder(path, 2), []
        for part in T.slices(column, limit):
            found += encoder.encode(part)
        assert found == [b"", *wanted]


def test_token_records(spark, docs, empty, rows, tmp_path):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    found = token_records.encoded_documents(docs, path, str(tmp_path / "r")).orderBy("start").collect()
    wanted = Counter()
    for key, text, _ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        wanted[key, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == wanted
    assert [r.doc_id for r in found] == sorted(r[0] for r in rows)
    start = 0
    for r in found:
        assert r.start == start
        start += r.n_tokens
    shard = found[0].shard
    index = token_records.read_index(str(tmp_path / "r"), shard)
    key, ids = token_records.fetch(str(tmp_path / "r"), shard, int(index["offset"][-1]), 2)
    assert key == index["key"][-1] and len(ids) == index["n_tokens"][-1]
    data = bytearray((tmp_path / "r" / f"{shard}.rec").read_bytes())
    data[20] ^= 1
    with pytest.raises(token_records.CorruptRecord):
        list(token_records.frames(bytes(data)))
    assert token_records.encoded_documents(empty, path).count() == 0


def test_log_bilinear(docs, empty, rows):
    tokens = {(k, t): [*WORD.findall(lower(t or "")), None] for k, t, _ in rows}
    texts = [(k, tokens[k, t]) for k, t, _ in rows]
    counts = Counter(w for k, ws in texts if zlib.crc32(str(k).encode()) % 7 != 2 for w in ws)
    total = sum(counts.values())
    wanted = {k: sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in ws) for k, ws in texts}
    found = log_bilinear.score_texts(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.base_score == pytest.approx(wanted[r.doc_id]) and r.train_tokens == total
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) and r.score < 0
    assert log_bilinear.score_texts(empty).count() == 0
    table = log_bilinear.train(np.random.default_rng(1).integers(0, 5, (9, 8)), steps=20)
    assert np.allclose(np.exp(table).sum(axis=1), 1)


def test_suffix_dedup(docs, empty, rows):
    n, seen = suffix_dedup.LENGTH, Counter()
    texts = [(k, (t or "").encode()) for k, t, _ in rows]
    for _, b in texts:
        seen.update(hash(b[p : p + n]) for p in range(len(b) - n + 1))
    wanted = Counter()
    for key, b in texts:
        gone = np.zeros(len(b) + 1, dtype=int)
        for p in range(len(b) - n + 1):
            if seen[hash(b[p : p + n])] > 1:
                gone[p] += 1
                gone[p + n] -= 1
        gone = np.cumsum(gone)[: len(b)] > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        left = np.frombuffer(b, np.uint8)[~gone].tobytes()
        wanted[key, len(b), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()] += 1
    assert Counter(map(tuple, suffix_dedup.removed_repeats(docs).collect())) == wanted
    assert suffix_dedup.removed_repeats(empty).count() == 0


def test_loser_tree_merges_runs():
    rng = np.random.default_rng(4)
    runs = [sorted({bytes(rng.integers(97, 99, rng.integers(1, 9)).astype(np.uint8)) for _ in range(30)}) for _ in range(5)]
    coded = []
    for run in runs:
        shared, rests = suffix_dedup.front_coded(run)
        coded.append(suffix_dedup._Run(shared.tobytes(), b"".join(rests), np.array([len(r) for r in rests], "<u2").tobytes()))
    out = list(suffix_dedup.merged(coded))
    strings = [runs[r][i] for r, i, _, _ in out]
    assert strings == sorted(s for run in runs for s in run)
    for a, b, (_, _, _, shared) in zip(strings, strings[1:], out[1:], strict=False):
        assert shared == suffix_dedup.common_prefix(a, b)


def test_decontaminate(spark, docs, empty, rows):
    item = "Which river runs through the old town? The long green river runs there, slowly and quietly."
    items = spark.createDataFrame(
        [(1, item, "x"), (2, None, "x"), (3, " ", "x"), (4, BASE, "x")], "item_id long, text string, doc_id string"
    )
    near = item.replace("old", "very old").replace(" slowly", "").replace("Which", "What")
    extra = [(200_000, f"{BASE[:90]} {item} some more words follow", "en"), (200_001, f"so {near} and more", "en")]
    more = spark.createDataFrame([(*r, "s", 1, "c", "c", 1) for r in extra], SCHEMA)
    found = {r.doc_id: list(r["items"]) for r in decontaminate.contaminated(docs.unionByName(more), items).collect()}
    assert found[200_000] == [1] and found[200_001] == [1] and found[100_005] == [4] and found[100_000] == []
    assert decontaminate.contaminated(empty, items).count() == 0
    assert decontaminate.contaminated(docs, items.where("false")).where("contaminated").count() == 0


@pytest.mark.parametrize("n", [1_000, 10_000])
def test_decontaminate_finds_copies_whatever_the_number_of_items(spark, n):
    """Verbatim, with every seventh word dropped, and with a word added after each."""
    rng = np.random.default_rng(11)
    words = np.array([f"w{i}" for i in range(30_000)])
    items = [" ".join(words[rng.integers(0, len(words), 12 + i % 40)]) + "." for i in range(n)]
    rows = []
    for key in range(300):
        own = items[key * n // 300].split()
        own = [own, [w for i, w in enumerate(own) if i % 7 != 3], [x for w in own for x in (w, "and")]][key % 3]
        around = words[rng.integers(0, len(words), 200)]
        rows.append((key, " ".join([*around[:100], *own, *around[100:]]), "en", "s", 1, "c", "c", 1))
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = decontaminate.contaminated(spark.createDataFrame(rows, SCHEMA), table).collect()
    assert {r.doc_id: list(r["items"]) for r in found} == {key: [key * n // 300] for key in range(300)}


def test_decontaminate_finds_paraphrases_of_items_without_an_answer(spark):
    common = [f"c{i}" for i in range(22)]
    rare = [f"r{i}" for i in range(8)]
    item = [w for i, r in enumerate(rare) for w in (r, *common[3 * i : 3 * i + 3])][:30]
    changed = [f"x{i}" if i in (1, 5, 9, 13, 17, 21, 25, 26, 27, 29) else w for i, w in enumerate(item)]
    without = [f"x{i}" if w in rare else w for i, w in enumerate(item)]
    texts = [changed, without, item[::-1], *[common] * 40]
    rows = [(i, " ".join(["before", *t, "after"]), "en", "s", 1, "c", "c", 1) for i, t in enumerate(texts)]
    table = spark.createDataFrame([(1, " ".join(item) + ".")], "item_id long, text string")
    found = decontaminate.contaminated(spark.createDataFrame(rows, SCHEMA), table).collect()
    held = {r.doc_id: r.likeness for r in found if list(r["items"]) == [1]}
    assert list(held) == [0] and held[0] == pytest.approx(20 / 30)
