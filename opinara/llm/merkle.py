"""Merkle manifest of a table: a digest for each row, source and table, and proofs.

``H`` is SHA-256 of the inputs one after the other, digests written as lower-case
hexadecimal text. A row's leaf is ``H`` of ``doc_id, source, lang, n_chars, text``,
each ``-`` if null and else its number of UTF-8 bytes, ``:`` and the value. The leaves
of a source, in ascending ``doc_id``, are joined three by three into a tree whose
top is the source's subroot; the subroots, null first and then bytewise, are joined
likewise into the root.

Leaves are numbered through the whole table, source after source, so each node stands
over an unbroken run of leaves. The built levels are stored as node rows, two levels
to a row: a node's number, the digests of its children and of their children, and a
link to its own parent row, which also says where below that the node is. A node over
many leaves is stored once for each block of ``BLOCK`` leaves below it, so that a source
with a third of all rows climbs on many keys.

A proof is read off by a recursive query: from each leaf it ascends along the links,
appends at each node row the digests beside the way, and folds the given digest into the
node's. If the last is the root, the row is as it was.

Digests travel as 32 bytes. No task holds more than one node's children or one leaf's
way; only the number of steps and the root come to the driver.

Rows with equal ``doc_id`` go by their leaf; null ``doc_id`` comes first. Equal rows
have equal leaves and each its own place. Empty texts have the length 0. An empty
table has no root and gives no rows. Other columns are neither read nor in the way.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opinara.operators.ranges import in_ranges
from opinara.session import materialise

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Fixed value: how many nodes have one parent.
ARITY = 3
# Leaves that share a key when they meet the same node.
BLOCK = 243
# A node row holds two levels.
SPAN = ARITY * ARITY
# A node's number: its step above so many bits, the first leaf's number and place below.
PLACE_BITS = 50
# A link: a node's number above so many bits, the place among its children's children below.
SLOT_BITS = 4
# Steps of the tree over the sources are numbered from here.
SOURCES_STEP = 32
NODES = "node long, block long, link long, mids array<binary>, children array<binary>, single boolean"
# Above log9 of any number of rows, twice.
MOST_STEPS = 60


def digest(text: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def hex_text(of: Column) -> Column:
    return F.lower(F.hex(of))


def leaf_digest(values: dict[str, Column]) -> Column:
    """The leaf of a row whose fields are ``values``, as 32 bytes."""
    parts = []
    for field in FIELDS:
        value = values[field].cast("string")
        framed = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(framed, F.lit("-")))
    return digest(F.concat(*parts))


@dataclass
class Manifest:
    """The written leaves and nodes of a table, and its root in hexadecimal.

    ``leaves``: ``leaf_no, doc_id, leaf, other, subroot, link``; ``nodes``: ``node, block, link,
    mids, children, single``. ``other`` is whatever digest the leaf is to be checked with.
    """

    leaves: DataFrame
    nodes: DataFrame
    root: str | None


def _numbered(rows: DataFrame) -> DataFrame:
    """Each leaf's number, its source's number and its place there, without one task for all.

    Rows are cut into ranges of source and key; a range's rows of one source are
    counted, and the counts before it give the number of its first.
    """
    order = [F.asc_nulls_first("source"), F.asc_nulls_first("doc_id"), F.asc("leaf"), F.asc("other")]
    placed = in_ranges(materialise(rows, "leaves"), order, "leaf_ranges")
    runs = materialise(placed.groupBy("_range", "source").agg(F.count("*").alias("n")), "leaf_runs")
    # One row for each range and source, and of a source at most one for each range.
    before = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    sources = runs.groupBy("source").agg(F.sum("n").alias("n_leaves"))
    ranked = in_ranges(materialise(sources, "sources"), [F.asc_nulls_first("source")], "source_ranges")
    own = ranked.groupBy("_range").agg(F.count("*").alias("n"), F.sum("n_leaves").alias("leaves"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = own.select(
        "_range",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("trees_before"),
        F.coalesce(F.sum("leaves").over(earlier), F.lit(0)).alias("leaves_before"),
    )
    inside = Window.partitionBy("_range").orderBy(F.asc_nulls_first("source"))
    ahead = inside.rowsBetween(Window.unboundedPreceding, -1)
    numbered = ranked.join(starts, "_range").select(
        F.col("source").alias("_source"),
        "n_leaves",
        (F.col("trees_before") + F.row_number().over(inside) - 1).alias("tree"),
        (F.col("leaves_before") + F.coalesce(F.sum("n_leaves").over(ahead), F.lit(0))).alias("first"),
    )
    runs = runs.join(numbered, F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("_range").alias("_run_range"), "_source", "before", "n_leaves", "tree", "first"
    )
    same = (F.col("_range") == F.col("_run_range")) & F.col("source").eqNullSafe(F.col("_source"))
    within = Window.partitionBy("_range", "source").orderBy(*order[1:])
    # The place before the join: its window keeps the rows of a range where they are.
    found = placed.withColumn("_place", F.row_number().over(within) - 1).join(runs, same)
    return found.select(
        "doc_id", "leaf", "other", "tree", "first", "n_leaves", (F.col("before") + F.col("_place")).alias("pos")
    )


def _link(step: int, place: Column, slot: Column) -> Column:
    """The link to a node and a place below it."""
    node = F.lit(step << PLACE_BITS) + place
    return F.shiftleft(node, SLOT_BITS) + slot


def _linked(step: int, top: Column) -> Column:
    """The link of a node of ``step``, or a leaf; ``top`` is that of a tree's last node."""
    up = F.col("first") + F.floor(F.col("pos") / SPAN)
    return F.when(F.col("n") > 1, _link(step + 1, up, F.col("pos") % SPAN)).otherwise(top)


def _joined(digests: Column) -> Column:
    return digest(F.concat_ws("", F.transform(digests, hex_text)))


def _steps(nodes: DataFrame, step: int, most: int, top: Column) -> list[DataFrame]:
    """``nodes`` and the steps above them, each written, with the link of every node.

    ``nodes``: ``tree, first, n, pos, digest, low, high`` with ``n`` nodes of ``tree`` on this
    step, whose numbers begin at ``first``, above the leaves ``low`` to ``high``.
    """
    built = []
    while True:
        node = F.lit(step << PLACE_BITS) + F.col("first") + F.col("pos")
        built.append(nodes.withColumns({"node": node, "link": _linked(step, top)}))
        if most <= 1:
            return built
        child = F.struct("pos", "digest")
        grouped = nodes.where("n > 1").groupBy("tree", "first", "n", F.floor(F.col("pos") / SPAN).alias("up")).agg(
            F.transform(F.sort_array(F.collect_list(child)), lambda c: c["digest"]).alias("children"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
        runs = F.transform(
            F.sequence(F.lit(0), F.floor((F.size("children") - 1) / ARITY).cast("int")),
            lambda i: _joined(F.slice("children", i * ARITY + 1, F.lit(ARITY))),
        )
        grouped = grouped.withColumns({"mids": runs, "single": F.col("n") <= ARITY})
        nodes = materialise(
            grouped.select(
                "tree", "first", F.ceil(F.col("n") / SPAN).alias("n"), F.col("up").alias("pos"),
                F.when(F.col("single"), F.element_at("mids", 1)).otherwise(_joined(F.col("mids"))).alias("digest"),
                "mids", "children", "single", "low", "high",
            ),
            "merkle_step",
        )
        step, most = step + 1, -(-most // SPAN)


def build(docs: DataFrame, other: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``; ``other`` replaces fields in the digests to check the leaves with."""
    own = {field: F.col(field) for field in FIELDS}
    rows = docs.select(
        "doc_id", "source", leaf_digest(own).alias("leaf"), leaf_digest(own | (other or {})).alias("other")
    )
    numbered = materialise(_numbered(rows), "numbered_leaves")
    size = numbered.agg(F.max("n_leaves"), F.max("tree") + 1).first()
    n_trees = size[1] or 0
    leaf_no = F.col("first") + F.col("pos")
    no_link = F.lit(None).cast("long")
    up = F.floor(F.col("tree") / SPAN)
    top = _link(SOURCES_STEP + 1, up, F.col("tree") % SPAN) if n_trees > 1 else no_link
    leaves = numbered.withColumnRenamed("n_leaves", "n")
    level = leaves.select(
        "tree", "first", "n", "pos", F.col("leaf").alias("digest"), leaf_no.alias("low"), leaf_no.alias("high")
    )
    lower = _steps(level, 0, size[0] or 0, top)
    subroots = _union([rows.where("n = 1").select("tree", "digest", "low", "high") for rows in lower])
    subroots = materialise(subroots, "subroots")
    nothing = F.lit(0).cast("long")
    trees = subroots.select(
        nothing.alias("tree"), nothing.alias("first"), F.lit(n_trees).cast("long").alias("n"),
        F.col("tree").alias("pos"), "digest", "low", "high",
    )
    upper = _steps(trees, SOURCES_STEP, n_trees, no_link)
    # Leaves and subroots themselves, the first of either list, are stored with what is above them.
    kept = ["node", "link", "mids", "children", "single", "low", "high"]
    nodes = _union([rows.select(kept) for rows in lower[1:] + upper[1:]])
    if nodes is None:
        nodes = docs.sparkSession.createDataFrame([], NODES)
    else:
        nodes = nodes.select("node", _blocks("low", "high"), "link", "mids", "children", "single")
    last = upper[-1].where("n = 1").select("digest").first()
    root = bytes(last[0]).hex() if last else None
    by_block = subroots.select(F.col("tree").alias("_tree"), F.col("digest").alias("subroot"), _blocks("low", "high"))
    same = (F.col("tree") == F.col("_tree")) & (F.floor(F.col("leaf_no") / BLOCK) == F.col("block"))
    found = leaves.select(leaf_no.alias("leaf_no"), "doc_id", "leaf", "other", "tree", _linked(0, top).alias("link"))
    found = found.join(by_block, same).select("leaf_no", "doc_id", "leaf", "other", "subroot", "link")
    return Manifest(materialise(found, "merkle_leaves"), materialise(nodes, "merkle_nodes"), root)


def _blocks(low: str, high: str) -> Column:
    """The blocks of leaves between two numbers, a row each, as ``block``."""
    return F.explode(F.sequence(F.floor(F.col(low) / BLOCK), F.floor(F.col(high) / BLOCK))).alias("block")


def _union(tables: list[DataFrame]) -> DataFrame | None:
    whole = None
    for table in tables:
        whole = table if whole is None else whole.unionByName(table)
    return whole


@contextmanager
def _unlimited_recursion(spark: SparkSession):
    """Every leaf ascends; Spark's own limit on rows is meant for queries that never end."""
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


CLIMB = f"""
WITH RECURSIVE climb (leaf_no, link, folded, siblings) MAX RECURSION LEVEL {MOST_STEPS} AS (
    SELECT leaf_no, link, other, CAST('' AS BINARY) FROM {{leaves}}
    UNION ALL
    SELECT leaf_no, link,
           if(single, mid, unhex(sha2(concat_ws('', transform(mids, (d, i) -> lower(hex(if(i = run, mid, d))))), 256))),
           unhex(concat(concat_ws('', transform(filter(own, (d, i) -> i <> place), d -> hex(d))),
                        if(single, '', concat_ws('', transform(filter(mids, (d, i) -> i <> run), d -> hex(d))))))
    FROM (
        SELECT *, unhex(sha2(concat_ws('', transform(own, (d, i) -> lower(hex(if(i = place, folded, d))))), 256)) AS mid
        FROM (
            SELECT c.leaf_no, n.link, c.folded, n.single, n.mids, slot % {ARITY} AS place, slot DIV {ARITY} AS run,
                   slice(n.children, CAST(slot DIV {ARITY} * {ARITY} + 1 AS INT), {ARITY}) AS own
            FROM (SELECT *, link & {(1 << SLOT_BITS) - 1} AS slot FROM climb) c
            JOIN {{nodes}} n ON n.node = shiftright(c.link, {SLOT_BITS}) AND n.block = c.leaf_no DIV {BLOCK}))
)
SELECT leaf_no, folded, siblings, coalesce(link, {(1 << 63) - 1}) AS reached FROM climb"""


def proofs(manifest: Manifest) -> DataFrame:
    """``leaf_no, proof, folded``: ``H`` of each leaf's siblings, and what its check folds to.

    Links rise along the way, and the last is null.
    """
    spark = manifest.leaves.sparkSession
    with _unlimited_recursion(spark):
        climbed = spark.sql(CLIMB, leaves=manifest.leaves, nodes=manifest.nodes)
        # A leaf has one row for each step.
        steps = F.sort_array(F.collect_list(F.struct("reached", "siblings")))
        gathered = climbed.groupBy("leaf_no").agg(steps.alias("steps"), F.max_by("folded", "reached").alias("folded"))
        siblings = F.concat_ws("", F.transform("steps", lambda s: hex_text(s["siblings"])))
        return materialise(gathered.select("leaf_no", digest(siblings).alias("proof"), "folded"), "proofs")


def without_line_feeds(docs: DataFrame) -> Column:
    """The text with its line feeds deleted in rows whose key's CRC-32 is even, else as it is."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(chosen, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def verify(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """Each row's leaf, subroot, root and proof, and whether the row with ``text`` still verifies."""
    changed = {"text": without_line_feeds(docs) if text is None else text}
    manifest = build(docs, changed)
    held = manifest.leaves.join(proofs(manifest), "leaf_no")
    return held.select(
        "doc_id",
        hex_text(F.col("leaf")).alias("leaf"),
        hex_text(F.col("subroot")).alias("subroot"),
        F.lit(manifest.root).cast("string").alias("root"),
        hex_text(F.col("proof")).alias("proof_sha256"),
        hex_text(F.col("folded")).alias("folded_root"),
        (hex_text(F.col("folded")) == F.lit(manifest.root)).alias("verified"),
    )
