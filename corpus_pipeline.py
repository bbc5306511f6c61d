"""From raw documents to token records: rules, near-dedup, decontamination, mix, records.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows the stage before
kept. All but the last return the columns of ``documents``. Stage results are written
to the shared folder and read back, so a lost executor costs one stage's tasks.

Rows may repeat and any column may be null; what a stage makes of such rows its operator
states. An empty table gives no rows. Other columns pass through up to the mix, under any
names but those the mix works with (``_k``, ``_s``, ``_n``, ``_size``, ``_taken``, ``_copy``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm import decontaminate, mixing, near_dup, quality_rules, token_records
from opinara.llm.queries import documents, tokenizer_path
from opinara.session import materialise


def _free(docs: DataFrame, name: str) -> str:
    """The name, longer if ``docs`` has a column of that name."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _kept(docs: DataFrame, verdicts: DataFrame, kept: str, judged: tuple[str, ...]) -> DataFrame:
    """The rows of ``docs`` whose ``judged`` columns are those of a kept verdict.

    ``verdicts`` has a hash of the judged columns, ``_judged``, beside the document's key.
    """
    id_, hash_ = _free(docs, "_id"), _free(docs, "_judged")
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64(*judged) == F.col(hash_))
    wanted = verdicts.where(kept).select(F.col("doc_id").alias(id_), F.col("_judged").alias(hash_)).distinct()
    return docs.join(wanted, same, "left_semi").select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the rules and lie in their language's perplexity band."""
    verdicts = quality_rules.judge(docs, judged=("text", "lang"))
    return _kept(docs, verdicts, "kept", ("text", "lang"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest key.

    Rows with equal keys and texts are one document, and one row of them stays.
    """
    found = near_dup.near_duplicates(docs, shingle=near_dup.SHINGLE)
    id_ = _free(docs, "_id")
    names = found.where("kept").select(F.col("doc_id").alias(id_)).distinct()
    kept = docs.join(names, F.col("doc_id").eqNullSafe(F.col(id_)), "left_semi").select(*docs.columns)
    return kept.dropDuplicates(["doc_id", "text"])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_items(docs, benchmark).withColumnRenamed("row", "_judged")
    return _kept(docs, found, "size(items) = 0", ("text",))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them, some twice, some in part, some not at all."""
    return mixing.mixed_documents(docs)


def records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records of the mix, digested from the files."""
    return token_records.encoded_documents(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality),
    ("near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("token records", records),
]

# The perplexity bands and the latent search have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
