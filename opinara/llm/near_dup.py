"""Near-duplicates by an LSH forest over MinHash signatures.

A document is the set of its word shingles. Its MinHash signature is read in
several orders; in each order documents stand sorted, and those that share a
prefix of ``DEPTH`` hashes form a region. Neighbours in a region, by longest
common prefix, are candidates:

1. Documents with equal sets are one class from the start, named by its smallest
   key, so copies never become pairs.
2. In each region every class is compared with the region's first. Links found
   make components.
3. Regions that still hold several components are where the prefix alone says too
   little. Classes that meet in them form groups, and each group is joined exactly,
   whatever its size, on what its members have different from most of the group
   (see ``_unlike``): hardly any two edited copies of one text that are no link share
   enough of their edits to become a candidate.

Every link is confirmed on the full sets. A pair with similarity 0.8 escapes all of the
24 orders with probability 1e-4, one with 0.85 with 2e-9; inside a group nothing is
missed. No number of partners or candidates is limited.

Text: null or without words gives the empty set, linked with nothing. With fewer
words than a shingle has, the whole sequence is the one shingle. Rows with a null
key stay alone and have a null component. Rows with equal keys are one document;
if their texts differ, a link of any of them counts. An empty table gives no
rows. Columns of other names are ignored. Texts are read whole, one at a time
within a slice of memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opinara.llm import text as T
from opinara.llm.components import components
from opinara.session import materialise

SHINGLE = 5
PERCENT = 80
HASHES = 96
DEPTH = 4
# Least number of equal hashes of a region's member that is compared with the first: 10
# deviations below what similarity 0.8 gives, 4.5 below what 0.6 gives, so what is not
# compared is less alike than 0.6.
AGREEING = 36
# Members at least as unlike to a region's first as this meet in a group of their own.
UNSEEN = 0.6

SIGNED = "id long, n_shingles long, k1 long, k2 long, signature binary"
_seeds = np.random.default_rng(11)
_XOR = _seeds.integers(1, 1 << 32, HASHES, dtype=np.uint32)
_MULTIPLY = _seeds.integers(1, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
# The hashes that each order reads first.
ORDERS = np.arange(HASHES).reshape(-1, DEPTH)
# Shingles of a batch sent on at a time.
PIECE = 200_000


def shingle_sets(texts: T.Texts, n: int) -> list[np.ndarray]:
    """Each text's distinct shingle hashes in ascending order."""
    texts = T.lowered(texts)
    words = T.split_words(texts)
    hashes = T.word_hashes(texts, words)
    every, first = T.grams(hashes, words, n)
    sets = []
    for i, count in enumerate(words.counts):
        if 0 < count < n:
            own = T.sequence_hashes(hashes[words.first[i] : words.first[i + 1]], int(count))
        else:
            own = every[first[i] : first[i + 1]]
        sets.append(np.unique(own))
    return sets


def _signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two fingerprints of each set and its signature; the sets are not empty."""
    every = np.concatenate(sets)
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    k1 = np.add.reduceat(T.mix(every + np.uint64(1)), first)
    k2 = np.bitwise_xor.reduceat(T.mix(every * np.uint64(0xD6E8FEB86659FD93)), first)
    short = (every >> np.uint64(32)).astype(np.uint32)
    signature = np.empty((len(sets), HASHES), dtype="<u4")
    for i in range(HASHES):
        signature[:, i] = np.minimum.reduceat((short ^ _XOR[i]) * _MULTIPLY[i], first)
    return k1.view(np.int64), k2.view(np.int64), signature


def _sign(n: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in T.slices(batch.column(1)):
                sets = shingle_sets(texts, n)
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                k1, k2 = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
                rows = np.zeros((len(sets), HASHES), dtype="<u4")
                full = np.flatnonzero(sizes)
                if len(full):
                    k1[full], k2[full], rows[full] = _signatures([sets[i] for i in full])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(texts.low, texts.high - texts.low),
                        pa.array(sizes), pa.array(k1), pa.array(k2),
                        pa.array([r.tobytes() for r in rows], pa.binary()),
                    ],
                    names=["id", "n_shingles", "k1", "k2", "signature"],
                )

    return sign


def _order_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each class and order: the hashed prefix and the class's key."""
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4").reshape(-1, HASHES)
        rows = rows.astype(np.uint64)
        for order, columns in enumerate(ORDERS, 1):
            total = np.full(len(rows), order, dtype=np.uint64)
            for column in columns:
                total = T.mix(total * np.uint64(0x9E3779B97F4A7C15) + rows[:, column] + np.uint64(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(total.view(np.int64)), batch.column(1)], names=["key", "id"]
            )


def _agreeing(least: int):
    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u4").reshape(-1, HASHES)
                for i in (2, 3)
            )
            close = (one == other).sum(axis=1) >= least
            yield batch.select([0, 1]).filter(pa.array(close))

    return agreeing


def _compared(percent: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar, linked = [], []
            for one, other in zip(batch.column(2), batch.column(3), strict=True):
                x = np.frombuffer(one.as_py(), np.uint64)
                y = np.frombuffer(other.as_py(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                union = len(x) + len(y) - common
                similar.append(common / union)
                linked.append(100 * common >= percent * union)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(similar, pa.float64()), pa.array(linked, pa.bool_())],
                names=["a", "b", "similarity", "linked"],
            )

    return compare


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """``key, n_shingles, component_id, kept`` for each row of ``docs``.

    Documents are linked when ``100 * intersection >= percent * union``. The
    component is named by its smallest key, and that document is kept.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary").alias("text"))
    signed = materialise(rows.mapInArrow(_sign(shingle), SIGNED), "signatures")
    filled = signed.where("n_shingles > 0 and id is not null")
    classes = materialise(
        filled.groupBy("k1", "k2", "n_shingles").agg(
            F.min("id").alias("id"), F.first("signature").alias("signature")
        ),
        "classes",
    )
    signatures = classes.select("id", "signature")
    entered = signatures.select("signature", "id").mapInArrow(_order_keys, "key long, id long")
    # Keys alone first: few regions hold more than one class.
    regions = entered.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("leader"))
    # Written first, so that both sides of the join come from a shuffle and a hot region is split.
    regions = materialise(regions.where("n > 1"), "region_leaders")
    members = materialise(entered.join(regions, "key"), "regions")

    wanted = materialise(members.select("id").distinct(), "compared")
    texts = rows.join(wanted, "id")
    sets = materialise(texts.mapInArrow(_sets_of(shingle), "id long, shingles binary"), "sets")

    def agreeing(pairs: DataFrame) -> DataFrame:
        one = signatures.select(F.col("id").alias("a"), F.col("signature").alias("sa"))
        other = signatures.select(F.col("id").alias("b"), F.col("signature").alias("sb"))
        both = pairs.join(one, "a").join(other, "b").select("a", "b", "sa", "sb")
        return both.mapInArrow(_agreeing(AGREEING), "a long, b long").distinct()

    def confirm(pairs: DataFrame) -> DataFrame:
        one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
        other = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
        both = pairs.join(one, "a").join(other, "b").select("a", "b", "sa", "sb")
        found = both.mapInArrow(_compared(percent), "a long, b long, similarity double, linked boolean")
        return materialise(found, "confirmed")

    starred = members.where("id != leader").select(F.col("leader").alias("a"), F.col("id").alias("b"))
    first = confirm(agreeing(starred.distinct()))
    links = first.where("linked").select("a", "b")
    joined = materialise(components(links), "components")
    grouped = _groups(members, joined, first)
    if not grouped.isEmpty():
        unlike, about = _unlike(grouped, sets, percent / 100)
        centred = confirm(_to_centres(about, percent / 100)).where("linked").select("a", "b")
        links = links.unionByName(centred)
        joined = materialise(components(links), "components")
        links = links.unionByName(
            confirm(_across(unlike, about, joined, percent / 100)).where("linked").select("a", "b")
        )
        joined = components(links)
    named = classes.select("k1", "k2", "n_shingles", "id").join(joined, "id", "left").select(
        "k1", "k2", "n_shingles", F.coalesce("component", "id").alias("component")
    )
    return signed.join(named, ["k1", "k2", "n_shingles"], "left").select(
        F.col("id").alias(key),
        "n_shingles",
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
        (F.col("id").isNull() | (F.coalesce("component", "id") == F.col("id"))).alias("kept"),
    )


def _sets_of(n: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in T.slices(batch.column(1)):
                sets = [s.tobytes() for s in shingle_sets(texts, n)]
                ids = batch.column(0).slice(texts.low, texts.high - texts.low)
                yield pa.RecordBatch.from_arrays([ids, pa.array(sets, pa.binary())], names=["id", "shingles"])

    return made


def _groups(members: DataFrame, joined: DataFrame, compared: DataFrame) -> DataFrame:
    """``grp, id, component``: classes among which a link may be left between components.

    Classes compared with the first of a region are in one group with it, and so, step
    by step, are all that such comparisons connect. Two classes of a region of which
    one is too unlike its first to have been compared meet in a group of the region's
    own, with all that are hardly like the first. A group of two has been compared.
    """
    blobs = components(compared.select("a", "b"))
    blob = F.xxhash64(F.lit(0), "component")
    together = blobs.select(blob.alias("grp"), "id")

    likeness = compared.select(F.col("a").alias("leader"), F.col("b").alias("id"), "similarity")
    others = members.where("id != leader and n > 2").select("key", "id", "leader")
    placed = others.join(likeness, ["leader", "id"], "left").where(
        F.col("similarity").isNull() | (F.col("similarity") < UNSEEN)
    )
    strays = placed.groupBy("key").agg(
        F.count("*").alias("n"), F.count_if(F.col("similarity").isNull()).alias("unseen")
    )
    strays = strays.where("n > 1 and unseen > 0").select("key")
    apart = placed.join(strays, "key", "left_semi").select(F.xxhash64(F.lit(1), "key").alias("grp"), "id")

    every = together.unionByName(apart).join(joined, "id", "left")
    every = every.withColumn("component", F.coalesce("component", "id"))
    open_groups = every.groupBy("grp").agg(
        F.count("*").alias("n"), F.min("component").alias("_l"), F.max("component").alias("_m")
    )
    by_region = F.xxhash64(F.lit(1), "key").alias("grp")
    small = open_groups.where("n = 2").join(strays.select(by_region), "grp", "left_anti").select("grp")
    open_groups = open_groups.where("_l != _m").join(small, "grp", "left_anti").select("grp", "n")
    return materialise(every.join(open_groups, "grp"), "groups")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of each member, with its group."""
    for batch in batches:
        groups, held = [], []
        size = 0
        for grp, shingles in zip(batch.column(0).to_numpy(), batch.column(1), strict=True):
            held.append(np.frombuffer(shingles.as_py(), np.int64))
            groups.append(np.full(len(held[-1]), grp))
            size += len(held[-1])
            if size >= PIECE:
                yield _piece(groups, held)
                groups, held, size = [], [], 0
        if held:
            yield _piece(groups, held)


def _piece(groups: list[np.ndarray], held: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(groups)), pa.array(np.concatenate(held))], names=["grp", "e"]
    )


UNLIKE = "grp long, id long, component long, weight double, size long, common long, e long"


def _differences(near: float):
    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            ids = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            for (grp, id_, component), shingles, most in zip(ids, batch.column(3), batch.column(4), strict=True):
                own = np.frombuffer(shingles.as_py(), np.int64)
                common = np.empty(0, np.int64) if most.as_py() is None else most.values.to_numpy()
                lacking = np.setdiff1d(common, own, assume_unique=True)
                added = np.setdiff1d(own, common, assume_unique=True)
                weight = len(lacking) + near * len(added)
                unlike = np.concatenate([lacking, added])
                rows.append((grp, id_, component, weight, len(unlike), len(common), unlike))
                size += len(unlike) + 1
                if size >= PIECE:
                    yield _difference_rows(rows)
                    rows, size = [], 0
            if rows:
                yield _difference_rows(rows)

    return differ


def _difference_rows(rows: list[tuple]) -> pa.RecordBatch:
    """A row without a shingle for each member, then one for each shingle in which it differs."""
    repeats = np.array([row[4] for row in rows]) + 1
    kinds = (np.int64, np.int64, np.int64, np.float64, np.int64, np.int64)
    columns = [
        pa.array(np.repeat(np.array([row[i] for row in rows], dtype=kind), repeats))
        for i, kind in enumerate(kinds)
    ]
    heads = np.concatenate([[0], np.cumsum(repeats)[:-1]])
    shingles = np.concatenate([np.concatenate([[0], row[6]]) for row in rows]).astype(np.int64)
    absent = np.zeros(len(shingles), dtype=bool)
    absent[heads] = True
    names = [field.split()[0] for field in UNLIKE.split(", ")]
    return pa.RecordBatch.from_arrays([*columns, pa.array(shingles, mask=absent)], names=names)


def _unlike(grouped: DataFrame, sets: DataFrame, near: float) -> tuple[DataFrame, DataFrame]:
    """Each member's differences from its group, and a row about each member.

    What at least half of a group's members have is common to it; there are at most
    twice as many such shingles as a member has on average. A member differs by the
    common ones it lacks and the others it adds. Let a member's weight be those it
    lacks and ``near`` times those it adds, and ``common`` the number of common ones.
    Two members with weights v and w that share s differences have a similarity of at
    least ``near`` just when ``(1 + near) * s >= v + w - (1 - near) * common``.
    """
    joined = grouped.join(sets, "id")
    counted = joined.select("grp", "shingles").mapInArrow(_pieces, "grp long, e long")
    counted = counted.groupBy("grp", "e").agg(F.count("*").alias("c"))
    sizes = grouped.groupBy("grp").agg(F.count("*").alias("n"))
    most = counted.where("c > 1").join(sizes, "grp").where("2 * c >= n")
    most = materialise(most.groupBy("grp").agg(F.collect_list("e").alias("most")), "common")
    with_most = joined.join(most, "grp", "left").select("grp", "id", "component", "shingles", "most")
    made = materialise(with_most.mapInArrow(_differences(near), UNLIKE), "differences")
    return made.where("e is not null").drop("component"), made.where("e is null").drop("e")


def _needed(weights, near: float):
    """Shared differences that a link needs, less what rounding may take."""
    return (weights - F.lit(1 - near) * F.col("common")) / F.lit(1 + near) - F.lit(1e-6)


def _to_centres(about: DataFrame, near: float) -> DataFrame:
    """Each member with its group's lightest, where they may be linked.

    Two members that may be linked without sharing a difference are both linked to
    the lightest.
    """
    lightest = about.groupBy("grp").agg(F.min(F.struct("weight", "id", "size", "component")).alias("m"))
    placed = about.join(lightest, "grp").where("component != m.component")
    able = F.least("size", "m.size") >= _needed(F.col("weight") + F.col("m.weight"), near)
    pair = placed.where(able).select(
        F.least("id", "m.id").alias("a"), F.greatest("id", "m.id").alias("b")
    )
    return pair.distinct()


def _across(unlike: DataFrame, about: DataFrame, joined: DataFrame, near: float) -> DataFrame:
    """Pairs of members of different components that may share as many differences as a link needs.

    A member's differences stand in order, those that few members have first. Of two
    members the first difference they share tells how many more they can share, and it
    lies in both their prefixes, which end where too few are left for any link.
    """
    current = about.drop("component").join(joined, "id", "left")
    current = current.withColumn("component", F.coalesce("component", "id"))
    current = materialise(current, "members")
    main = current.groupBy("grp").agg(
        F.min(F.struct("weight", "id", "component")).alias("m"),
        F.min("component").alias("_l"), F.max("component").alias("_m"),
    )
    main = main.where("_l != _m").select(
        "grp", F.col("m.component").alias("main"), F.col("m.weight").alias("main_least")
    )
    placed = current.join(main, "grp")
    rest = placed.where("component != main").groupBy("grp").agg(F.min("weight").alias("rest_least"))
    inside = F.col("component") == F.col("main")
    partner = F.when(inside, F.col("rest_least")).otherwise(F.col("main_least"))
    placed = placed.join(rest, "grp").select(
        "grp", "id", "component", inside.alias("inside"),
        F.greatest(F.lit(1), F.ceil(_needed(F.col("weight") + partner, near))).alias("least"),
    )
    shared = unlike.groupBy("grp", "e").agg(F.count("*").alias("c")).where("c > 1")
    by_member = Window.partitionBy("grp", "id")
    ranked = unlike.join(shared, ["grp", "e"]).withColumn(
        "left", F.row_number().over(by_member.orderBy(F.desc("c"), F.desc("e")))
    )
    # ``left`` counts a difference and those behind it, the ones no other member has being first.
    prefixes = ranked.join(placed, ["grp", "id"]).where("left >= least")
    prefixes = materialise(
        prefixes.select("grp", "e", "id", "component", "inside", "weight", "common", "left"), "prefixes"
    )
    x, y = prefixes.where("not inside").alias("x"), prefixes.alias("y")
    same = (F.col("x.grp") == F.col("y.grp")) & (F.col("x.e") == F.col("y.e"))
    across = (F.col("x.component") != F.col("y.component")) & (F.col("y.inside") | (F.col("x.id") < F.col("y.id")))
    weights = F.col("x.weight") + F.col("y.weight") - F.lit(1 - near) * F.col("x.common")
    enough = F.lit(1 + near) * F.least("x.left", "y.left") >= weights - F.lit(1e-6)
    pairs = x.join(y, same & across & enough)
    pair = pairs.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
    return pair.distinct()
