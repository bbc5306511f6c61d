"""The operators as queries over the documents and pages tables, with SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import (
    decontaminate,
    line_dedup,
    log_bilinear,
    merkle,
    mixing,
    near_dup,
    quality_lm,
    quality_rules,
    suffix_dedup,
    token_records,
    toxicity,
    variants,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(made: Query) -> Query:
        QUERIES[name] = made
        if oracle is not None:
            ORACLES[name] = oracle
        return made

    return register


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_near_dup")
def op1_near_dup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf), shingle=4)


@query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf))


# Every block is taken as often as slots rank onto it; the rest is that rule in other words.
_MIX = rf"""
WITH sized AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
    FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no
    FROM sized GROUP BY source),
bounded AS (
    SELECT *, [3.0, 1.0, 2.0][source_no % 3 + 1]::DOUBLE AS w, 2.0::DOUBLE * source_size AS bound,
           1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS wanted
    FROM sources),
reached AS (
    SELECT *, (wanted - coalesce(sum(bound) OVER (ORDER BY bound / w, source_no
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(w) OVER (ORDER BY bound / w, source_no
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM bounded),
targeted AS (
    SELECT source, source_no, source_size,
           least(bound, coalesce(max(CASE WHEN bound / w >= level THEN level END) OVER (),
                                 'inf'::DOUBLE) * w) AS target
    FROM reached),
cut AS (
    SELECT *, CASE WHEN target > 0 THEN ceil(source_size * {float(mixing.SLOTS)}::DOUBLE
                  / sum(target) OVER ())::BIGINT END AS blocks,
           floor(sum(target) OVER (ORDER BY source_no) / sum(target) OVER ()
                 * {float(1 << mixing.POINT_BITS)}::DOUBLE)::BIGINT AS high
    FROM targeted),
intervals AS (
    SELECT *, lag(high, 1, 0) OVER (ORDER BY source_no) AS low FROM cut),
slots AS (
    SELECT list_sum([((i >> b) & 1) * (1::BIGINT << ({mixing.POINT_BITS - 1} - b))
                     for b in range(20)])::BIGINT AS point
    FROM range({mixing.SLOTS}) r(i)),
counted AS (
    SELECT source_no, least(count(*), 2 * any_value(blocks)) AS n
    FROM slots JOIN intervals ON point >= low AND point < high GROUP BY source_no),
placed AS (
    SELECT s.*, i.source_no, i.source_size, i.target, i.blocks, coalesce(n, 0) AS n,
           coalesce(sum(size) OVER (PARTITION BY i.source_no ORDER BY h, doc_id, size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS p
    FROM sized s JOIN intervals i ON s.source IS NOT DISTINCT FROM i.source
    LEFT JOIN counted c ON c.source_no = i.source_no),
edged AS (
    SELECT *, ((n % blocks)::HUGEINT * source_size // blocks) AS edge FROM placed)
SELECT doc_id, size, source, source_size, target,
       CASE WHEN size = 0 OR blocks IS NULL THEN 0 ELSE
            (n // blocks) * size + greatest(least(p + size, edge) - p, 0) END::BIGINT AS taken
FROM edged"""


@query("op3_mixing", _MIX)
def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(documents(spark, sf))


@query("op7_token_records")
def op7_token_records(spark: SparkSession, sf: str) -> DataFrame:
    return token_records.encoded_documents(documents(spark, sf), tokenizer_path())


@query("op8_log_bilinear")
def op8_log_bilinear(spark: SparkSession, sf: str) -> DataFrame:
    return log_bilinear.score_texts(documents(spark, sf))


@query("op10_decontaminate")
def op10_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    return decontaminate.contaminated(documents(spark, sf), benchmark)


@query("op5_line_dedup")
def op5_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.removed_lines(documents(spark, sf))


@query("op6_quality_lm")
def op6_quality_lm(spark: SparkSession, sf: str) -> DataFrame:
    return quality_lm.judge(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))


@query("op4_warc")
def op4_warc(spark: SparkSession, sf: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    derived = warc.derivatives(warc.page_responses(pages))
    return derived.select(
        "page_id", "response_id", "metadata_id", "conversion_id", "refers_to", "target_uri", "payload_digest",
        "block_digest", "n_links", F.length("text").cast("long").alias("text_chars"),
        F.sha2(F.col("metadata"), 256).alias("metadata_sha256"),
        F.sha2(F.col("conversion"), 256).alias("conversion_sha256"), "error",
    )


@query("op9_suffix_dedup")
def op9_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.removed_repeats(documents(spark, sf))


# CRC-32 by its table, over the bytes of a text of characters up to U+07FF.
_CRC_TABLE = "crc_table AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda c, _: " \
    "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v FROM range(256) r(i)))"


def _crc_sql(text: str) -> str:
    octets = f"""flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) < 128
        THEN [unicode(c)::BIGINT] ELSE [(192 + unicode(c) // 64)::BIGINT, (128 + unicode(c) % 64)::BIGINT] END))"""
    return f"""xor(list_reduce({octets}, lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295)"""


def _variants_sql() -> str:
    links = " LEFT JOIN ".join(
        ["forms f0", *(f"forms f{i} ON f{i}.word = f{i - 1}.form" for i in range(1, 24))]
    )
    root = ", ".join(f"f{i}.form" for i in range(23, -1, -1))
    return rf"""
WITH {_CRC_TABLE},
runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
distinct_runs AS (
    SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY ALL),
hashed AS MATERIALIZED (
    SELECT run, n, {_crc_sql("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM distinct_runs, crc_table),
words AS (
    SELECT CASE WHEN h % 97 = 0 THEN run[1:(h % length(run))] || run[(h % length(run) + 2):] ELSE run END AS word, n
    FROM hashed),
vocabulary AS MATERIALIZED (
    SELECT word, sum(n)::BIGINT AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
shorter AS MATERIALIZED (
    SELECT word, i, word[1:i - 1] || word[i + 1:] AS part
    FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)),
pairs AS (
    SELECT a.word, b.word AS near FROM shorter a JOIN shorter b USING (i, part) WHERE a.word <> b.word
    UNION SELECT word, part FROM shorter SEMI JOIN vocabulary v ON v.word = part
    UNION SELECT part, word FROM shorter SEMI JOIN vocabulary v ON v.word = part),
ranked AS (
    SELECT p.word, p.near, v.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
           row_number() OVER (PARTITION BY p.word ORDER BY v.n DESC, encode(p.near)) AS place
    FROM pairs p JOIN vocabulary v ON v.word = p.near),
forms AS MATERIALIZED (
    SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
           CASE WHEN near_n >= 2 * v.n THEN near END AS form, CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n
    FROM vocabulary v LEFT JOIN ranked r ON r.word = v.word AND place = 1)
SELECT f0.word, f0.form, coalesce({root}, f0.word) AS root, f0.n, f0.n_near, f0.form_n
FROM {links}"""


@query("op11_spelling_variants", _variants_sql())
def op11_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return variants.group_variants(documents(spark, sf))


# Levels that the SQL below builds; Spark's query has no such bound.
_LEAF_LEVELS, _SOURCE_LEVELS = 14, 8


def _merkle_sql() -> str:
    def leaf(text: str) -> str:
        fields = [
            f"coalesce(strlen({value}) || ':' || {value}, '-')"
            for value in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
        ]
        return f"sha256({' || '.join(fields)})"

    def climb(name: str, level: int, tree: str, start: str) -> str:
        """Builds a level, and takes each leaf from the one below up to it."""
        here, below, before = f"{name}{level}", f"{name}{level - 1}", f"{name}_way{level - 1}" if level > 1 else start
        return f"""
{here}_runs AS MATERIALIZED (
    SELECT {tree} tree, pos // 3 AS up, list(h ORDER BY pos) AS run, any_value(n) AS n FROM {below} GROUP BY ALL),
{here} AS MATERIALIZED (
    SELECT tree, up AS pos, CASE WHEN n > 1 THEN sha256(array_to_string(run, '')) ELSE run[1] END AS h,
           (n + 2) // 3 AS n FROM {here}_runs),
{name}_way{level} AS MATERIALIZED (
    SELECT w.* REPLACE (
        w.place // 3 AS place,
        CASE WHEN r.n > 1 THEN siblings || array_to_string(
            list_filter(run, lambda h, i: i <> w.place % 3 + 1), '') ELSE siblings END AS siblings,
        CASE WHEN r.n > 1 THEN sha256(array_to_string(
            list_transform(run, lambda h, i: CASE WHEN i = w.place % 3 + 1 THEN folded ELSE h END), ''))
            ELSE folded END AS folded)
    FROM {before} w JOIN {here}_runs r ON r.up = w.place // 3 AND r.tree = w.tree)"""

    lower = ",".join(climb("leaf", k, "tree,", "start") for k in range(1, _LEAF_LEVELS + 1))
    upper = ",".join(climb("src", k, "tree,", "middle") for k in range(1, _SOURCE_LEVELS + 1))
    return rf"""
WITH {_CRC_TABLE},
changed AS (
    SELECT *, CASE WHEN {_crc_sql("doc_id::VARCHAR")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other
    FROM documents, crc_table),
leaves AS (
    SELECT doc_id, {leaf("text")} AS leaf, {leaf("other")} AS folded,
           dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos,
           count(*) OVER (PARTITION BY source) AS n
    FROM changed),
leaf0 AS MATERIALIZED (SELECT tree, pos, leaf AS h, n FROM leaves),
start AS MATERIALIZED (
    SELECT doc_id, leaf, folded, '' AS siblings, tree, pos AS place, 0::BIGINT AS source_no, '' AS subroot FROM leaves),
{lower},
middle AS MATERIALIZED (
    SELECT doc_id, leaf, folded, siblings, 0::BIGINT AS tree, tree AS place, tree AS source_no, h AS subroot
    FROM leaf_way{_LEAF_LEVELS} JOIN leaf{_LEAF_LEVELS} USING (tree)),
src0 AS MATERIALIZED (SELECT 0::BIGINT AS tree, tree AS pos, h, count(*) OVER () AS n FROM leaf{_LEAF_LEVELS}),
{upper}
SELECT doc_id, leaf, subroot, h AS root, sha256(siblings) AS proof_sha256, folded AS folded_root, folded = h AS verified
FROM src_way{_SOURCE_LEVELS} CROSS JOIN src{_SOURCE_LEVELS}"""


@query("op12_merkle_manifest", _merkle_sql())
def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.verify(documents(spark, sf))


@query("op13_toxicity")
def op13_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.score_texts(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))
