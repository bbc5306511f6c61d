"""Every query by name, with the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.functions import (
    epoch_date,
    label_value,
    link_key,
    parse_date,
    rate_diff,
    title_matches,
)
from opinara.operators import evaluate, features, joins, models, prep, report
from opinara.operators import rates as R
from opinara.operators.late import attach_labels_late
from opinara.operators.ledger import stage_ledger, survivors, write_stages
from opinara.operators.many_models import Fit, cross_validate_all, fit_all, pack
from opinara.operators.stages import Flow
from opinara.operators.stored_links import linked, store_comments, store_submissions
from opinara.operators.words import with_text, with_words
from opinara.plans import flows, sql
from opinara.plans import oracles as O
from opinara.plans import standins as S
from opinara.session import materialise, scratch_path
from opinara.sources import (
    load_model,
    read_comments,
    read_labels,
    read_submissions,
    read_table,
    save_model,
    schemas,
    write_json_lines,
    write_report_csv,
    write_table,
)
from opinara.sources.quarantine import Ingested, ingest_csv, ingest_json

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Places of the test tables that stand for the states of the flair.
PLACES = ("src0", "src1", "src2", "src3", "src4", "src5", "src6", "src7")
OFF_THE_MAP = ("src3", "src5")
TITLE_TERM = "the"
STATE_TABLE = "SELECT 'src' || n_nationkey AS state FROM nation WHERE n_regionkey < 3"


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(made: Query) -> Query:
        QUERIES[name] = made
        if oracle is not None:
            ORACLES[name] = oracle
        return made

    return register


# Sources and sinks


@query(
    "src_json_roundtrip",
    f"""SELECT id, body, link_id, CAST(com_score * 86400 AS BIGINT) AS created_utc,
               author_flair_text, com_score AS score FROM {O.THREADS}""",
)
def src_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "comments-json")
    raw = S.threads(spark, sf).select(
        "id",
        "body",
        "link_id",
        (F.col("com_score") * 86400).alias("created_utc"),
        "author_flair_text",
        F.col("com_score").alias("score"),
    )
    write_json_lines(raw, path)
    return read_comments(spark, path)


@query(
    "src_json_submissions",
    f"SELECT sub_id AS id, title, sub_score AS score FROM {O.SUBMISSIONS}",
)
def src_json_submissions(spark: SparkSession, sf: str) -> DataFrame:
    """Scores written in quotes come back as numbers."""
    path = scratch_path(spark, "submissions-json")
    raw = S.submissions(spark, sf).select(
        F.col("sub_id").alias("id"), "title", F.col("sub_score").cast("string").alias("score")
    )
    write_json_lines(raw, path)
    return read_submissions(spark, path)


@query("src_csv_labels", f"SELECT * FROM {O.LABEL_ROWS}")
def src_csv_labels(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "labels-csv")
    written = S.label_rows(spark, sf)
    # In another order and among other columns: the reader goes by name.
    written = written.select(F.lit(0).alias("n"), *reversed(written.columns))
    write_report_csv(written, path)
    return read_labels(spark, path)


# Some lines cut short, some with a number that is none. Numbered by thread and turn.
_LINE_NO = "(CAST(substr(link_id, 4) AS BIGINT) * 5 + com_score) % 10"


def _doubtful_threads(spark: SparkSession, sf: str) -> Ingested:
    number = (F.substring("link_id", 4, 18).cast("long") * 5 + F.col("com_score")) % 10
    score = F.when(number == 1, F.lit("many")).otherwise(F.col("com_score").cast("string"))
    time = F.when(number == 2, F.lit("soon")).otherwise((F.col("com_score") * 86400).cast("string"))
    line = F.to_json(
        F.struct(
            "id", "body", "link_id", time.alias("created_utc"), "author_flair_text", score.alias("score")
        )
    )
    cut = F.when(number == 0, F.left(line, F.length(line) - 1)).otherwise(line)
    path = scratch_path(spark, "doubtful-json")
    S.threads(spark, sf).select(cut.alias("value")).write.option("compression", "bzip2").text(path)
    return ingest_json(spark, path, schemas.COMMENTS, scratch_path(spark, "ingested"), most_bad=0.5)


@query(
    "src_json_quarantine",
    f"""SELECT CASE {_LINE_NO} WHEN 0 THEN 'malformed' WHEN 1 THEN 'field score'
                    ELSE 'field created_utc' END AS reason, count(*) AS n_lines
        FROM {O.THREADS} WHERE {_LINE_NO} < 3 GROUP BY 1""",
)
def src_json_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """The lines set aside, counted by reason."""
    return _doubtful_threads(spark, sf).by_reason()


@query(
    "src_json_kept_lines",
    f"""SELECT id, body, link_id, CAST(com_score * 86400 AS BIGINT) AS created_utc,
               author_flair_text, com_score AS score FROM {O.THREADS} WHERE {_LINE_NO} >= 3""",
)
def src_json_kept_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The rows left when bad lines have been set aside."""
    return _doubtful_threads(spark, sf).good


@query(
    "src_csv_quarantine",
    f"""SELECT CASE CAST("Input_id" AS BIGINT) % 10 WHEN 2 THEN 'field labeldem' ELSE 'malformed' END AS reason,
               CASE CAST("Input_id" AS BIGINT) % 10 WHEN 0 THEN "Input_id" || ',' || labeldem || ',' || labelgop
                    WHEN 1 THEN "Input_id" || ',' || labeldem || ',' || labelgop || ',' || labeldjt || ',1'
                    ELSE '{{"Input_id":"' || "Input_id" || '","labeldem":"x","labelgop":"' || labelgop ||
                         '","labeldjt":"' || labeldjt || '"}}' END AS line
        FROM {O.LABEL_ROWS} WHERE CAST("Input_id" AS BIGINT) % 10 < 3""",
)
def src_csv_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Label lines with a field too few or too many, or a value of another type, as they stand."""
    number = F.col("Input_id").cast("long") % 10
    fields = [
        F.col("Input_id"),
        F.when(number == 2, "x").otherwise(F.col("labeldem")),
        F.col("labelgop"),
        F.when(number == 1, F.concat("labeldjt", F.lit(",1"))).when(number != 0, F.col("labeldjt")),
    ]
    lines = S.label_rows(spark, sf).select(
        F.concat_ws(",", *fields).alias("Input_id,labeldem,labelgop,labeldjt")
    )
    path = scratch_path(spark, "doubtful-csv")
    # One column whose name is the header, with a separator that no line holds.
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "").csv(path)
    schema = "Input_id string, labeldem int, labelgop int, labeldjt string"
    held = ingest_csv(
        spark, path, spark.createDataFrame([], schema).schema, scratch_path(spark, "ingested"), most_bad=0.5
    )
    return held.bad.select("reason", "line")


@query(
    "src_parquet_scan",
    "SELECT doc_id, source, length(text) AS n FROM documents WHERE lang = 'en'",
)
def src_parquet_scan(spark: SparkSession, sf: str) -> DataFrame:
    documents = read_table(spark, f"{sf}/documents.parquet")
    return documents.where(F.col("lang") == "en").select(
        "doc_id", "source", F.length("text").cast("long").alias("n")
    )


@query("snk_parquet_roundtrip", f"SELECT id, pos, neg, com_score, date FROM {O.SCORED_EVENTS}")
def snk_parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "scored")
    scored = S.event_days(spark, sf).select("id", "pos", "neg", "com_score", "date")
    write_table(scored, path, partition_by=["date"])
    return read_table(spark, path).select("id", "pos", "neg", "com_score", "date")


def _through_csv(spark: SparkSession, table: DataFrame) -> DataFrame:
    """A report written as CSV and read back with its own types."""
    path = scratch_path(spark, "report-csv")
    write_report_csv(table, path)
    return spark.read.schema(table.schema).option("header", True).csv(path)


@query("snk_csv_roundtrip", O.both_rates("date", O.SCORED_EVENTS))
def snk_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    days = report.rate_report(S.event_days(spark, sf), "date")
    text = _through_csv(spark, days.withColumn("date", F.col("date").cast("string")))
    return text.withColumn("date", parse_date(F.col("date")))


@query("snk_resumed_flow", O.both_rates("date", O.SCORED_EVENTS))
def snk_resumed_flow(spark: SparkSession, sf: str) -> DataFrame:
    """One run that stops after scoring, and a second that goes on to the report from its table."""
    folder = scratch_path(spark, "flow")
    for last in ("scored", "by_day"):
        flow = Flow(spark, folder)
        flow.add("scored", lambda events: events, S.event_days(spark, sf), passing=True)
        flow.add("by_day", lambda scored: report.rate_report(scored, "date"), "scored")
        rows = flow.table(last)
    if (flow.made, flow.reused) != (["by_day"], ["scored"]):
        raise AssertionError(f"made {flow.made}, reused {flow.reused}")
    flow.finish()
    return rows


@query("snk_csv_submission_score", O.both_rates("sub_score", O.SCORED_LINES))
def snk_csv_submission_score(spark: SparkSession, sf: str) -> DataFrame:
    return _through_csv(spark, report.rate_report(S.scored_lines(spark, sf), "sub_score"))


@query("snk_csv_comment_score", O.both_rates("com_score", O.SCORED_EVENTS))
def snk_csv_comment_score(spark: SparkSession, sf: str) -> DataFrame:
    return _through_csv(spark, report.rate_report(S.scored_events(spark, sf), "com_score"))


# Projections


@query("prj_comment_slim", f"SELECT * FROM {O.THREADS}")
def prj_comment_slim(spark: SparkSession, sf: str) -> DataFrame:
    raw = S.threads(spark, sf).withColumnRenamed("com_score", "score")
    columns = {k: v for k, v in prep.COMMENT_COLUMNS.items() if k != "created_utc"}
    return prep.slim(raw, columns)


@query(
    "prj_label_rename",
    f"""SELECT "Input_id" AS iid, labeldem AS "Democrat", labelgop AS "Republican",
               labeldjt AS "Trump" FROM {O.LABEL_ROWS}""",
)
def prj_label_rename(spark: SparkSession, sf: str) -> DataFrame:
    return prep.slim(S.label_rows(spark, sf), prep.LABEL_COLUMNS)


@query(
    "prj_label_cast",
    f'SELECT "Input_id" AS iid, TRY_CAST(labeldjt AS INTEGER) AS label FROM {O.LABEL_ROWS}',
)
def prj_label_cast(spark: SparkSession, sf: str) -> DataFrame:
    return S.label_rows(spark, sf).select(
        F.col("Input_id").alias("iid"), label_value(F.col("labeldjt")).alias("label")
    )


@query("prj_link_key", f"SELECT sub_id, 't3_' || sub_id AS link_id FROM {O.SUBMISSIONS}")
def prj_link_key(spark: SparkSession, sf: str) -> DataFrame:
    return S.submissions(spark, sf).select("sub_id", link_key(F.col("sub_id")).alias("link_id"))


@query(
    "lbl_one_vs_rest",
    f"""SELECT iid, label, CASE WHEN label = 1 THEN 1 ELSE 0 END AS poslabel,
               CASE WHEN label = -1 THEN 1 ELSE 0 END AS neglabel
        FROM (SELECT "Input_id" AS iid, TRY_CAST(labeldjt AS INTEGER) AS label
              FROM {O.LABEL_ROWS})""",
)
def lbl_one_vs_rest(spark: SparkSession, sf: str) -> DataFrame:
    labels = prep.slim(S.label_rows(spark, sf), {"Input_id": "iid", "labeldjt": "label"})
    return prep.one_vs_rest(labels)


@query("prj_epoch_date", f"SELECT id, created_utc, date FROM {O.SCORED_EVENTS}")
def prj_epoch_date(spark: SparkSession, sf: str) -> DataFrame:
    events = S.scored_events(spark, sf)
    return events.select("id", "created_utc", epoch_date(F.col("created_utc")).alias("date"))


@query(
    "prj_parse_date",
    """SELECT o_orderkey, CAST(TRY_STRPTIME(CASE WHEN o_orderstatus = 'P' THEN o_orderpriority
              ELSE strftime(o_orderdate, '%Y-%m-%d') END, '%Y-%m-%d') AS DATE) AS date
       FROM orders""",
)
def prj_parse_date(spark: SparkSession, sf: str) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    return S.table(spark, sf, "orders").select("o_orderkey", parse_date(text).alias("date"))


# Filters


@query(
    "flt_drop_quotes",
    f"""SELECT id, author_flair_text, body FROM {O.MARKED_COMMENTS}
        WHERE NOT body LIKE '%&gt;%' AND NOT body LIKE '%/s%'""",
)
def flt_drop_quotes(spark: SparkSession, sf: str) -> DataFrame:
    """Both marks, as given, over bodies of which some hold one, or no text."""
    return prep.drop_marked(S.marked_comments(spark, sf))


@query(
    "flt_drop_sarcasm",
    "SELECT page_id, url FROM pages WHERE NOT url LIKE '%&gt;%' AND NOT url LIKE '%/s%'",
)
def flt_drop_sarcasm(spark: SparkSession, sf: str) -> DataFrame:
    return prep.drop_marked(S.table(spark, sf, "pages").select("page_id", "url"), "url")


@query(
    "flt_drop_sarcasm_token",
    r"""SELECT page_id, html FROM pages WHERE NOT html LIKE '%&gt;%'
        AND NOT regexp_matches(html, '(^|[ \t\n\x0b\f\r])de([ \t\n\x0b\f\r]|$)')""",
)
def flt_drop_sarcasm_token(spark: SparkSession, sf: str) -> DataFrame:
    pages = S.table(spark, sf, "pages").select("page_id", "html")
    return prep.drop_marked(pages, "html", sarcasm="de", mode="token")


@query("flt_positive_count", f"SELECT count(*) AS n_rows FROM {O.SCORED_EVENTS} WHERE pos = 1")
def flt_positive_count(spark: SparkSession, sf: str) -> DataFrame:
    return R.stage_counts(prep.with_flag(S.scored_events(spark, sf), "pos"))


_PLACE_LIST = ", ".join(f"'{p}'" for p in PLACES)


@query(
    "flt_state_in",
    f"SELECT * FROM {O.SCORED_DOCUMENTS} WHERE author_flair_text IN ({_PLACE_LIST})",
)
def flt_state_in(spark: SparkSession, sf: str) -> DataFrame:
    return prep.in_list(S.scored_documents(spark, sf), "author_flair_text", PLACES)


@query("flt_title_like", f"SELECT * FROM {O.SUBMISSIONS} WHERE title LIKE '%{TITLE_TERM}%'")
def flt_title_like(spark: SparkSession, sf: str) -> DataFrame:
    return S.submissions(spark, sf).where(title_matches(F.col("title"), TITLE_TERM))


@query("flt_title_ilike", f"SELECT * FROM {O.SUBMISSIONS} WHERE title ILIKE '%{TITLE_TERM}%'")
def flt_title_ilike(spark: SparkSession, sf: str) -> DataFrame:
    return S.submissions(spark, sf).where(title_matches(F.col("title"), TITLE_TERM, True))


@query(
    "flt_exclude_date",
    f"""SELECT id, date FROM {O.SCORED_EVENTS}
        WHERE date IS DISTINCT FROM DATE '2024-01-05'""",
)
def flt_exclude_date(spark: SparkSession, sf: str) -> DataFrame:
    days = S.event_days(spark, sf).select("id", "date")
    return prep.exclude_keys(days, "date", [F.lit("2024-01-05").cast("date")])


# Joins


@query(
    "join_labeled",
    f"""SELECT id, body, author_flair_text, "Input_id" AS iid, labeldjt AS "Trump"
        FROM {O.COMMENTS} c JOIN {O.LABEL_ROWS} l ON c.id = l."Input_id" """,
)
def join_labeled(spark: SparkSession, sf: str) -> DataFrame:
    labels = prep.slim(S.label_rows(spark, sf), {"Input_id": "iid", "labeldjt": "Trump"})
    return joins.attach_labels(S.comments(spark, sf), labels)


_LINKED = f"""SELECT id, body, link_id, author_flair_text, com_score, sub_id, title, sub_score
    FROM {O.THREADS} c JOIN {O.SUBMISSIONS} s ON c.link_id = 't3_' || s.sub_id"""


@query("join_comment_submission", _LINKED)
def join_comment_submission(spark: SparkSession, sf: str) -> DataFrame:
    return joins.link_join(S.threads(spark, sf), S.submissions(spark, sf))


@query("join_comment_submission_salted", _LINKED)
def join_comment_submission_salted(spark: SparkSession, sf: str) -> DataFrame:
    return joins.link_join(S.threads(spark, sf), S.submissions(spark, sf), salts=16)


@query("join_stored_links", _LINKED)
def join_stored_links(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows from tables stored in buckets of the link key, without a shuffle."""
    comments, submissions = scratch_path(spark, "comments"), scratch_path(spark, "submissions")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    store_comments(S.threads(spark, sf), comments, buckets)
    store_submissions(S.submissions(spark, sf), submissions, comments)
    return linked(spark, comments, submissions)


@query(
    "join_labeled_late",
    """SELECT d.doc_id, d.text, d.source, l.doc_id AS iid, l.quality, l.toxic
       FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
)
def join_labeled_late(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents, ids first, texts from the row groups that hold such ids."""
    documents = S.table(spark, sf, "documents").select("doc_id", "text", "source")
    labels = S.table(spark, sf, "labels").select(F.col("doc_id").alias("iid"), "quality", "toxic")
    return attach_labels_late(documents, labels, ("doc_id", "iid"))


@query(
    "join_scored_threeway",
    f"""SELECT a.id, a.pos, a.neg, c.com_score, s.sub_score
        FROM {O.SCORED_THREADS} a JOIN {O.THREADS} c ON a.id = c.id
        JOIN {O.SUBMISSIONS} s ON c.link_id = 't3_' || s.sub_id""",
)
def join_scored_threeway(spark: SparkSession, sf: str) -> DataFrame:
    scored = S.scored_threads(spark, sf).select("id", "pos", "neg")
    slim = {"id": "com_id", "link_id": "link_id", "com_score": "com_score"}
    comments = prep.slim(S.threads(spark, sf), slim)
    titles = S.submissions(spark, sf).select("sub_id", "sub_score")
    joined = joins.rejoin_scores(scored, comments, titles)
    return joined.select("id", "pos", "neg", "com_score", "sub_score")


@query(
    "join_state_semi",
    f"""SELECT * FROM {O.SCORED_DOCUMENTS}
        WHERE author_flair_text IN (SELECT state FROM ({STATE_TABLE}))""",
)
def join_state_semi(spark: SparkSession, sf: str) -> DataFrame:
    nations = S.table(spark, sf, "nation").where(F.col("n_regionkey") < 3)
    states = nations.select(F.concat(F.lit("src"), F.col("n_nationkey")).alias("state"))
    return joins.in_table(S.scored_documents(spark, sf), "author_flair_text", states, "state")


_KEYED = f"""(SELECT CASE WHEN author_flair_text = 'src0' THEN NULL
                     ELSE author_flair_text END AS state, pos, neg FROM {O.SCORED_DOCUMENTS})"""


@query(
    "join_rates",
    f"""SELECT p.state, positive, negative
        FROM (SELECT state, sum(pos) / count(pos) AS positive FROM {_KEYED} GROUP BY 1) p
        JOIN (SELECT state, sum(neg) / count(neg) AS negative FROM {_KEYED} GROUP BY 1) n
        ON p.state IS NOT DISTINCT FROM n.state""",
)
def join_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Rates by place where one source counts as having no place."""
    state = F.nullif(F.col("author_flair_text"), F.lit("src0")).alias("state")
    scored = S.scored_documents(spark, sf).select(state, "pos", "neg")
    positive = R.rates(scored, ["state"], {"positive": "pos"})
    negative = R.rates(scored, ["state"], {"negative": "neg"})
    return joins.join_rates(positive, negative, "state")


# Counts and rates


@query(
    "agg_stage_counts",
    f"""SELECT 'comments' AS stage, count(*) AS n_rows FROM {O.THREADS}
        UNION ALL SELECT 'submissions', count(*) FROM {O.SUBMISSIONS}
        UNION ALL SELECT 'labels', count(*) FROM labels
        UNION ALL SELECT 'labelled', count(*) FROM documents JOIN labels USING (doc_id)
        UNION ALL SELECT 'linked', count(*) FROM {O.LINKED_THREADS}
        UNION ALL SELECT 'unmarked', count(*) FROM ({_LINKED})
            WHERE NOT body LIKE '%&gt;%' AND NOT body LIKE '%/s%'""",
)
def agg_stage_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The last two stages come out of one join, of counts by submission."""
    comments, submissions = S.threads(spark, sf), S.submissions(spark, sf)
    labels = prep.slim(S.label_rows(spark, sf), {"Input_id": "iid"})
    flagged = comments.select(
        "link_id", prep.is_unmarked(F.col("body")).cast("int").alias("unmarked")
    )
    linked = joins.linked_tally(flagged, submissions, {"unmarked": "unmarked"}).agg(
        F.sum("n_rows").alias("linked"), F.sum("unmarked_sum").alias("unmarked")
    )
    counts = R.count_stages(
        {
            "comments": comments,
            "submissions": submissions,
            "labels": labels,
            "labelled": joins.attach_labels(S.comments(spark, sf), labels),
        }
    )
    return counts.unionByName(
        linked.unpivot([], ["linked", "unmarked"], "stage", "n_rows")
    )


# The filters of the flows over comments, one after the other.
_STAGES = ("has_text", "unquoted", "not_sarcastic", "in_place")
_STAGED = f"""(
    SELECT id, body, author_flair_text,
           CASE WHEN body IS NULL THEN 'has_text' WHEN body LIKE '%&gt;%' THEN 'unquoted'
                WHEN body LIKE '%/s%' THEN 'not_sarcastic'
                WHEN (author_flair_text IN ({_PLACE_LIST})) IS NOT TRUE THEN 'in_place' END AS gone
    FROM {O.MARKED_COMMENTS})"""


def _written_stages(spark: SparkSession, sf: str) -> str:
    body, path = F.col("body"), scratch_path(spark, "staged")
    conditions = (
        body.isNotNull(),
        ~F.contains(body, F.lit(prep.QUOTE_MARK)),
        ~F.contains(body, F.lit(prep.SARCASM_MARK)),
        F.col("author_flair_text").isin(*PLACES),
    )
    write_stages(S.marked_comments(spark, sf), path, dict(zip(_STAGES, conditions, strict=True)), ["id"])
    return path


@query(
    "agg_stage_ledger",
    f"""WITH staged AS (SELECT coalesce(list_position({list(_STAGES)}, gone), 9) AS n FROM {_STAGED}),
             stages AS (SELECT unnest({["read", *_STAGES]}) AS stage, unnest(range(5)) AS i)
        SELECT stage, count(*) FILTER (WHERE n > i) AS n_rows, count(*) FILTER (WHERE n = i) AS n_dropped
        FROM stages, staged GROUP BY stage""",
)
def agg_stage_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Rows left and dropped by every filter of a flow, out of its one write."""
    return stage_ledger(spark, _written_stages(spark, sf), _STAGES)


@query("flow_stage_survivors", f"SELECT id, body, author_flair_text FROM {_STAGED} WHERE gone IS NULL")
def flow_stage_survivors(spark: SparkSession, sf: str) -> DataFrame:
    """What that write holds of the rows that passed every filter."""
    return survivors(spark, _written_stages(spark, sf))


@query(
    "agg_flag_counts",
    f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE pos = 1) AS pos,
               count(*) FILTER (WHERE neg = 1) AS neg FROM {O.SCORED_LINES}""",
)
def agg_flag_counts(spark: SparkSession, sf: str) -> DataFrame:
    return R.stage_counts(S.scored_lines(spark, sf), ["pos", "neg"])


@query(
    "rate_by_day",
    O.both_rates("date", O.SCORED_EVENTS, "pos_percent", "neg_percent") + " ORDER BY date",
)
def rate_by_day(spark: SparkSession, sf: str) -> DataFrame:
    day = epoch_date(F.col("created_utc")).alias("date")
    measures = {"pos_percent": "pos", "neg_percent": "neg"}
    return R.rates(S.scored_events(spark, sf), [day], measures, [F.asc("date")])


def _one_rate(flag: str, key: str, source: str) -> str:
    """One side's rate by key, highest first."""
    return f"""SELECT {key}, sum({flag}) / count({flag}) AS {flag}_percent FROM {source}
        GROUP BY 1 ORDER BY 2 DESC, 1"""


def _ordered_rate(df: DataFrame, key: str, flag: str) -> DataFrame:
    rate = f"{flag}_percent"
    return R.rates(df, [key], {rate: flag}, [F.desc(rate), F.asc(key)])


_PLACED = f"{O.SCORED_DOCUMENTS} WHERE author_flair_text IN ({_PLACE_LIST})"


def _placed(spark: SparkSession, sf: str) -> DataFrame:
    placed = prep.in_list(S.scored_documents(spark, sf), "author_flair_text", PLACES)
    return placed.withColumnRenamed("author_flair_text", "state")


@query("rate_by_state", _one_rate("pos", "author_flair_text AS state", _PLACED))
def rate_by_state(spark: SparkSession, sf: str) -> DataFrame:
    return _ordered_rate(_placed(spark, sf), "state", "pos")


@query("rate_by_state_negative", _one_rate("neg", "author_flair_text AS state", _PLACED))
def rate_by_state_negative(spark: SparkSession, sf: str) -> DataFrame:
    return _ordered_rate(_placed(spark, sf), "state", "neg")


@query("rate_by_comment_score", _one_rate("pos", "com_score", O.SCORED_EVENTS))
def rate_by_comment_score(spark: SparkSession, sf: str) -> DataFrame:
    return _ordered_rate(S.scored_events(spark, sf), "com_score", "pos")


@query("rate_by_comment_score_negative", _one_rate("neg", "com_score", O.SCORED_EVENTS))
def rate_by_comment_score_negative(spark: SparkSession, sf: str) -> DataFrame:
    return _ordered_rate(S.scored_events(spark, sf), "com_score", "neg")


@query(
    "rate_flag_vs_all",
    f"""SELECT avg(pos) FILTER (WHERE lang = 'en') AS positive_subset, avg(pos) AS positive_all,
               avg(neg) FILTER (WHERE lang = 'en') AS negative_subset, avg(neg) AS negative_all
        FROM {O.SCORED_DOCUMENTS}""",
)
def rate_flag_vs_all(spark: SparkSession, sf: str) -> DataFrame:
    return R.compare_subset(S.scored_documents(spark, sf), F.col("lang") == "en", report.BOTH)


@query(
    "topk_quantities",
    f"""SELECT sub_score, sum(pos) / count(pos) AS rate, count(*) AS support
        FROM {O.SCORED_LINES} GROUP BY 1 HAVING count(*) >= 2
        ORDER BY rate DESC, sub_score LIMIT 10""",
)
def topk_quantities(spark: SparkSession, sf: str) -> DataFrame:
    return R.top_groups(S.scored_lines(spark, sf), ["sub_score"], "pos", min_support=2)


@query("rate_by_submission_score", _one_rate("neg", "sub_score", O.SCORED_LINES))
def rate_by_submission_score(spark: SparkSession, sf: str) -> DataFrame:
    return _ordered_rate(S.scored_lines(spark, sf), "sub_score", "neg")


@query("rate_by_submission_score_positive", _one_rate("pos", "sub_score", O.SCORED_LINES))
def rate_by_submission_score_positive(spark: SparkSession, sf: str) -> DataFrame:
    return _ordered_rate(S.scored_lines(spark, sf), "sub_score", "pos")


def _tallied_threads(spark: SparkSession, sf: str) -> DataFrame:
    scored, submissions = S.scored_threads(spark, sf), S.submissions(spark, sf)
    return joins.linked_tally(scored, submissions, report.BOTH)


@query("rate_by_story", O.both_rates("sub_score, title", O.LINKED_THREADS))
def rate_by_story(spark: SparkSession, sf: str) -> DataFrame:
    return R.rates_of_tally(_tallied_threads(spark, sf), ["sub_score", "title"], report.BOTH)


@query(
    "rate_title_match",
    f"""SELECT sum(pos) / count(pos) AS pos_percent, sum(neg) / count(neg) AS neg_percent
        FROM {O.LINKED_THREADS} WHERE title LIKE '%{TITLE_TERM}%'""",
)
def rate_title_match(spark: SparkSession, sf: str) -> DataFrame:
    matching = _tallied_threads(spark, sf).where(title_matches(F.col("title"), TITLE_TERM))
    rates = R.rates_of_tally(matching, [], report.BOTH)
    return prep.slim(rates, {"positive": "pos_percent", "negative": "neg_percent"})


@query(
    "rate_per_title",
    O.both_rates("title", f"{O.LINKED_THREADS} WHERE title LIKE '%{TITLE_TERM}%'"),
)
def rate_per_title(spark: SparkSession, sf: str) -> DataFrame:
    matching = _tallied_threads(spark, sf).where(title_matches(F.col("title"), TITLE_TERM))
    return R.rates_of_tally(matching, ["title"], report.BOTH)


@query(
    "rate_subset_vs_all",
    f"""SELECT avg(pos) FILTER (WHERE title LIKE '%{TITLE_TERM}%') AS positive_subset,
               avg(pos) AS positive_all,
               avg(neg) FILTER (WHERE title LIKE '%{TITLE_TERM}%') AS negative_subset,
               avg(neg) AS negative_all FROM {O.LINKED_THREADS}""",
)
def rate_subset_vs_all(spark: SparkSession, sf: str) -> DataFrame:
    match = title_matches(F.col("title"), TITLE_TERM)
    return R.compare_subset_of_tally(_tallied_threads(spark, sf), match, report.BOTH)


def _top_sql(support: int) -> str:
    return f"""SELECT title, sub_score, sum(neg) / count(neg) AS rate, count(*) AS support
        FROM {O.LINKED_THREADS} GROUP BY title, sub_score HAVING count(*) >= {support}
        ORDER BY rate DESC, title, sub_score LIMIT 10"""


def _top_stories(spark: SparkSession, sf: str, min_support: int) -> DataFrame:
    keys = ["title", "sub_score"]
    stories = R.rates_of_tally(
        _tallied_threads(spark, sf), keys, ["negative"], support="support"
    )
    return R.top_rates(
        stories.withColumnRenamed("negative", "rate"), keys, min_support=min_support
    )


@query("topk_stories", _top_sql(1))
def topk_stories(spark: SparkSession, sf: str) -> DataFrame:
    return _top_stories(spark, sf, min_support=1)


@query("topk_stories_supported", _top_sql(3))
def topk_stories_supported(spark: SparkSession, sf: str) -> DataFrame:
    return _top_stories(spark, sf, min_support=3)


# Text


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return S.spread(S.table(spark, sf, "documents").select("doc_id", F.col("text").alias("body")))


def _text(spark: SparkSession, sf: str, part: str) -> DataFrame:
    return with_text(_documents(spark, sf), "body", [part]).drop("body")


def _text_sql(select: str, source: str) -> str:
    return f"WITH {O.DOCUMENT_TEXT} SELECT id AS doc_id, {select} FROM {source}"


@query("txt_normalise", _text_sql("n AS normalised", "norm"))
def txt_normalise(spark: SparkSession, sf: str) -> DataFrame:
    return _text(spark, sf, "normalised")


@query("txt_unigrams", _text_sql("u AS unigrams", "uni"))
def txt_unigrams(spark: SparkSession, sf: str) -> DataFrame:
    return _text(spark, sf, "unigrams")


@query("txt_bigrams", _text_sql("b AS bigrams", "grams"))
def txt_bigrams(spark: SparkSession, sf: str) -> DataFrame:
    return _text(spark, sf, "bigrams").withColumn("bigrams", F.array_join("bigrams", " "))


@query("txt_trigrams", _text_sql("t AS trigrams", "grams"))
def txt_trigrams(spark: SparkSession, sf: str) -> DataFrame:
    return _text(spark, sf, "trigrams").withColumn("trigrams", F.array_join("trigrams", " "))


@query("txt_word_tokens", _text_sql("word_tokens", "grams"))
def txt_word_tokens(spark: SparkSession, sf: str) -> DataFrame:
    words = _text(spark, sf, "word_tokens")
    return words.withColumn("word_tokens", F.array_join("word_tokens", " "))


@query("txt_combined", _text_sql("combined", "whole"))
def txt_combined(spark: SparkSession, sf: str) -> DataFrame:
    return _text(spark, sf, "combined")


@query(
    "txt_tokens",
    _text_sql("array_to_string(string_split(combined, ' '), chr(10)) AS token_lines", "whole"),
)
def txt_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """One token on each line; no token holds a line feed."""
    worded = with_words(_documents(spark, sf))
    return worded.select("doc_id", F.array_join("words", "\n").alias("token_lines"))


@query(
    "txt_token_count",
    _text_sql(
        """len(string_split(combined, ' ')) AS n_tokens,
        len(list_filter(string_split(combined, ' '), lambda w: w = '')) AS n_empty,
        len(list_distinct(string_split(combined, ' '))) AS n_distinct""",
        "whole",
    ),
)
def txt_token_count(spark: SparkSession, sf: str) -> DataFrame:
    worded = with_words(_documents(spark, sf))
    filled = F.array_size(F.array_remove("words", ""))
    return worded.select(
        "doc_id",
        F.array_size("words").cast("long").alias("n_tokens"),
        (F.array_size("words") - filled).cast("long").alias("n_empty"),
        F.array_size(F.array_distinct("words")).cast("long").alias("n_distinct"),
    )


# Features


def _labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    labels = S.table(spark, sf, "labels").select("doc_id")
    return with_words(_documents(spark, sf).join(labels, "doc_id"))


_LABELLED_TERMS = f"""WITH {O.LABELLED_TEXT},
    terms AS (SELECT id, unnest(string_split(combined, ' ')) AS term FROM whole),
    counted AS (SELECT term, count(DISTINCT id) AS doc_freq, count(*) AS term_count
                FROM terms GROUP BY term HAVING count(DISTINCT id) >= 5),
    kept AS (SELECT * FROM counted ORDER BY term_count DESC, term LIMIT 262144)"""


@query("fea_vocabulary", f"{_LABELLED_TERMS} SELECT term, doc_freq, term_count FROM kept")
def fea_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return features.vocabulary(_labelled_documents(spark, sf))


_DOC_FREQ = f"""WITH {O.DOCUMENT_TEXT}
        SELECT term, count(DISTINCT id) AS doc_freq
        FROM (SELECT id, unnest(string_split(combined, ' ')) AS term FROM whole)
        GROUP BY term HAVING count(DISTINCT id) >= 5"""


@query("fea_doc_freq", _DOC_FREQ)
def fea_doc_freq(spark: SparkSession, sf: str) -> DataFrame:
    return features.document_frequency(with_words(_documents(spark, sf)))


@query("fea_doc_freq_pruned", _DOC_FREQ)
def fea_doc_freq_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """Terms that a sketch rules out never enter the shuffle."""
    words = materialise(with_words(_documents(spark, sf)).select("words"), "words")
    sketch = materialise(features.count_sketch(words), "sketch")
    return features.document_frequency(words, sketch=sketch)


@query(
    "fea_presence",
    f"{_LABELLED_TERMS} SELECT DISTINCT id AS doc_id, term FROM terms SEMI JOIN kept USING (term)",
)
def fea_presence(spark: SparkSession, sf: str) -> DataFrame:
    labelled = materialise(_labelled_documents(spark, sf), "labelled_words")
    return features.presence(labelled, features.vocabulary(labelled), id="doc_id")


# Models


def _labelled_words(spark: SparkSession, sf: str) -> DataFrame:
    labels = prep.slim(S.label_rows(spark, sf), prep.LABEL_COLUMNS)
    comments = S.comments(spark, sf).join(labels.select("iid"), F.col("id") == F.col("iid"), "left_semi")
    return flows.labelled_words(comments.repartition(spark.sparkContext.defaultParallelism), labels)


def _trained(
    spark: SparkSession, sf: str, names: tuple[str, ...] = ("pos", "neg")
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """The best models of the cross-validation with the fixed parameters."""
    targets = {name: models.TARGETS[name] for name in names}
    return flows.train_models(_labelled_words(spark, sf), targets)


def _held_out_scores(
    spark: SparkSession, sf: str, names: tuple[str, ...] = ("pos", "neg")
) -> DataFrame:
    """The held-out half with predictions and probabilities, written once for all readers."""
    fitted, held_out = _trained(spark, sf, names)
    scored = models.score(held_out, fitted).drop("words")
    return materialise(models.with_probability(scored, names), "held_out_scores")


_HALF = O.hash_bucket("doc_id", 10_000, models.SEED) + " < 5000"

# Fitted numbers have no SQL form. The queries below give keys, labels and counts as
# they are, and say of each fitted value whether it is what its definition demands.
_TARGET_ROWS = f"""(SELECT CAST(doc_id AS VARCHAR) AS id, {_HALF} AS training,
        CASE WHEN toxic IS DISTINCT FROM 1 AND quality = 1 THEN 1 ELSE 0 END AS poslabel,
        CASE WHEN toxic = 1 THEN 1 ELSE 0 END AS neglabel
    FROM labels JOIN documents USING (doc_id) WHERE text IS NOT NULL)"""


def _within_unit(column: str) -> Column:
    return F.coalesce(F.col(column).between(0.0, 1.0), F.lit(False))


def _is_flag(name: str) -> Column:
    return F.coalesce(F.col(name).isin(0.0, 1.0), F.lit(False)).alias(f"{name}_is_flag")


def _checked_scores(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Held-out ids and labels, and whether flag and probability are sound and agree."""
    target, p = models.TARGETS[name], f"{name}_probability"
    ruled = (F.col(name) == 1) == (F.col(p) > target.threshold)
    return _held_out_scores(spark, sf, (name,)).select(
        "id", target.label, _is_flag(name), _within_unit(p).alias("in_range"), ruled.alias("as_ruled")
    )


def _checked_scores_sql(name: str) -> str:
    return f"""SELECT id, {models.TARGETS[name].label}, TRUE AS {name}_is_flag, TRUE AS in_range,
        TRUE AS as_ruled FROM {_TARGET_ROWS} WHERE NOT training"""


@query("ml_train_positive", _checked_scores_sql("pos"))
def ml_train_positive(spark: SparkSession, sf: str) -> DataFrame:
    return _checked_scores(spark, sf, "pos")


@query("ml_train_negative", _checked_scores_sql("neg"))
def ml_train_negative(spark: SparkSession, sf: str) -> DataFrame:
    return _checked_scores(spark, sf, "neg")


def _area_as_evaluated(scored: DataFrame, name: str, target: models.Target) -> DataFrame:
    """Class sizes, and whether the rank area is the evaluator's area under the curve."""
    probability = f"{name}_probability"
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol=probability, labelCol=target.label, numBins=0
    )
    same = F.abs(F.col("auc") - F.lit(evaluator.evaluate(scored))) < 1e-9
    return evaluate.auc(scored, probability, target.label).select(
        F.lit(name).alias("model"), "n_pos", "n_neg", same.alias("as_evaluated")
    )


def _by_model(sql: str) -> str:
    """``sql`` for both models, with MODEL and LABEL for name and label."""
    return " UNION ALL ".join(
        sql.replace("MODEL", name).replace("LABEL", target.label)
        for name, target in models.TARGETS.items()
    )


@query(
    "ml_evaluate",
    _by_model(
        f"""SELECT 'MODEL' AS model, count(*) FILTER (WHERE LABEL = 1) AS n_pos,
            count(*) FILTER (WHERE LABEL = 0) AS n_neg, TRUE AS as_evaluated
            FROM {_TARGET_ROWS} WHERE NOT training"""
    ),
)
def ml_evaluate(spark: SparkSession, sf: str) -> DataFrame:
    scored = _held_out_scores(spark, sf)
    areas = [_area_as_evaluated(scored, name, target) for name, target in models.TARGETS.items()]
    return areas[0].unionByName(areas[1])


_GRID = (0.1, 1.0)


def _validated(spark: SparkSession, sf: str, reg_params: tuple[float, ...]) -> DataFrame:
    """By model, penalty and fold: the fold's classes, the rows trained on, and whether there is an area."""
    labelled = _labelled_words(spark, sf)
    training, _ = models.hash_split(labelled, "id")
    folded = features.fit_vocabulary(labelled).transform(training).withColumn("fold", models.fold_of("id"))
    labels = {name: target.label for name, target in models.TARGETS.items()}
    found, _ = cross_validate_all(
        folded.drop("words"), labels, reg_params, models.FOLDS, most_steps=models.MAX_ITERATIONS
    )
    everything = found.groupBy("model", "reg_param").agg(F.sum(F.col("n_pos") + F.col("n_neg")).alias("n_all"))
    return found.join(everything, ["model", "reg_param"]).select(
        "model", "reg_param", "fold", "n_pos", "n_neg",
        (F.col("n_all") - F.col("n_pos") - F.col("n_neg")).alias("n_training"),
        F.col("auc").between(0.0, 1.0).alias("has_area"),
    )


def _validated_sql(reg_params: tuple[float, ...]) -> str:
    values = ", ".join(f"({value}::DOUBLE)" for value in reg_params)
    fold = O.hash_bucket("id", models.FOLDS, models.SEED + 1)
    return _by_model(
        f"""SELECT 'MODEL' AS model, reg_param, fold, n_pos, n_neg,
            CAST(sum(n_pos + n_neg) OVER (PARTITION BY reg_param) - n_pos - n_neg AS BIGINT) AS n_training,
            CASE WHEN n_pos > 0 AND n_neg > 0 THEN TRUE END AS has_area
            FROM (SELECT CAST({fold} AS INTEGER) AS fold, count(*) FILTER (WHERE LABEL = 1) AS n_pos,
                         count(*) FILTER (WHERE LABEL = 0) AS n_neg
                  FROM {_TARGET_ROWS} WHERE training GROUP BY 1)
            CROSS JOIN (VALUES {values}) AS grid(reg_param)"""
    )


@query("ml_cross_validate", _validated_sql(models.REG_PARAMS))
def ml_cross_validate(spark: SparkSession, sf: str) -> DataFrame:
    return _validated(spark, sf, models.REG_PARAMS)


@query("ml_grid", _validated_sql(_GRID))
def ml_grid(spark: SparkSession, sf: str) -> DataFrame:
    return _validated(spark, sf, _GRID)


# Of one-of-many features without a penalty, the optimum is known: differences of log odds.
_SEGMENTS = ("AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _saturated_sql() -> str:
    fold = O.hash_bucket("c_custkey", models.FOLDS, models.SEED + 1)
    odds = "ln(sum(y)::DOUBLE / (count(*) - sum(y)))"
    return f"""
        WITH marked AS (
            SELECT c_mktsegment AS segment, {fold} AS fold, unnest([
                {{'model': 'rich', 'y': (c_acctbal > 4500)::INT}}, {{'model': 'even', 'y': (c_nationkey % 2 = 0)::INT}}
            ]) AS m FROM customer),
        fitted AS (
            SELECT m.model, f.fold::INT AS fold, segment, ln(sum(m.y)::DOUBLE / (count(*) - sum(m.y))) AS odds
            FROM marked JOIN (SELECT unnest(range({models.FOLDS})) AS fold) f ON marked.fold <> f.fold GROUP BY ALL)
        SELECT model, fold, segment, round(a.odds - coalesce(b.odds, 0), 4) AS weight
        FROM fitted a LEFT JOIN (SELECT model, fold, odds FROM fitted WHERE segment = 'BUILDING') b
        USING (model, fold) WHERE segment <> 'BUILDING'"""


@query("ml_joint_optimum", _saturated_sql())
def ml_joint_optimum(spark: SparkSession, sf: str) -> DataFrame:
    """Two targets and all folds over market segments, fitted together: weights against one segment."""
    flags = {f"_{s}": (F.col("c_mktsegment") == s).cast("double") for s in _SEGMENTS}
    assembler = VectorAssembler(inputCols=list(flags), outputCol="features")
    rows = assembler.transform(S.table(spark, sf, "customer").withColumns(flags))
    rows = rows.select(
        "features", (F.col("c_acctbal") > 4500).cast("int").alias("rich"), (F.col("c_nationkey") % 2 == 0).cast("int").alias("even"),
        models.fold_of("c_custkey").alias("fold"),
    )
    plan = [Fit(label, 0.0, fold) for label in ("rich", "even") for fold in range(models.FOLDS)]
    fitted = fit_all(pack(rows, ["rich", "even"], "fold"), plan)
    found = [
        (fit.label, fit.without, segment, round(float(fitted.coefficients[j, i]), 4))
        for i, fit in enumerate(fitted.fits)
        for j, segment in enumerate(_SEGMENTS)
    ]
    return spark.createDataFrame(found, "model string, fold int, segment string, weight double")


@query(
    "ml_split",
    f"""SELECT CAST(doc_id AS VARCHAR) AS id,
               CASE WHEN {_HALF} THEN 'train' ELSE 'test' END AS part FROM labels""",
)
def ml_split(spark: SparkSession, sf: str) -> DataFrame:
    labels = S.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("id"))
    training, held_out = models.hash_split(labels, "id")
    return training.withColumn("part", F.lit("train")).unionByName(
        held_out.withColumn("part", F.lit("test"))
    )


@query(
    "ml_folds",
    f"""SELECT CAST(doc_id AS VARCHAR) AS id,
               CAST({O.hash_bucket("doc_id", models.FOLDS, models.SEED + 1)} AS INTEGER) AS fold
        FROM labels""",
)
def ml_folds(spark: SparkSession, sf: str) -> DataFrame:
    labels = S.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("id"))
    return labels.withColumn("fold", models.fold_of("id"))


_HELD_OUT = f"""(SELECT CAST(doc_id AS VARCHAR) AS id FROM labels JOIN documents USING (doc_id)
                 WHERE NOT {_HALF})"""


@query(
    "ml_threshold_rule",
    f"SELECT id, TRUE AS pos_as_ruled, TRUE AS neg_as_ruled FROM {_HELD_OUT}",
)
def ml_threshold_rule(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each held-out prediction is 1 just where its probability is above the bound."""
    scored = _held_out_scores(spark, sf)
    rules = [
        ((F.col(name) == 1) == (F.col(f"{name}_probability") > target.threshold)).alias(
            f"{name}_as_ruled"
        )
        for name, target in models.TARGETS.items()
    ]
    return scored.select("id", *rules)


@query(
    "ml_score",
    """SELECT CAST(doc_id AS VARCHAR) AS id, text IS NOT NULL AS pos_is_flag,
              text IS NOT NULL AS neg_is_flag FROM documents""",
)
def ml_score(spark: SparkSession, sf: str) -> DataFrame:
    """Every document scored by both models; one without text has no flag."""
    fitted, _ = _trained(spark, sf)
    worded = with_words(S.spread(S.comments(spark, sf)))
    return models.score(worded, fitted).select("id", _is_flag("pos"), _is_flag("neg"))


@query(
    "score_probability",
    f"""SELECT id, poslabel, neglabel, TRUE AS pos_in_range, TRUE AS neg_in_range
        FROM {_TARGET_ROWS} WHERE NOT training""",
)
def score_probability(spark: SparkSession, sf: str) -> DataFrame:
    scored = _held_out_scores(spark, sf)
    sound = [_within_unit(f"{n}_probability").alias(f"{n}_in_range") for n in models.TARGETS]
    return scored.select("id", "poslabel", "neglabel", *sound)


@query("model_roundtrip", f"SELECT id, TRUE AS same FROM {_HELD_OUT}")
def model_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Whether a saved and loaded model scores each held-out row as before.

    Each loaded model is scored by itself: its vectoriser has the saved one's name, and
    beside it would be given the saved one's vectors.
    """
    fitted, held_out = _trained(spark, sf)
    scored = models.score(held_out, {f"{name}_before": model for name, model in fitted.items()})
    every, same = [], F.lit(True)
    for name, model in fitted.items():
        path = scratch_path(spark, "model")
        save_model(model, path)
        scored = models.score(scored, {f"{name}_after": load_model(path)})
        every += [f"{name}_before", f"{name}_after"]
        before, after = (
            F.struct(f"{name}_{time}", f"{name}_{time}_probability") for time in ("before", "after")
        )
        same &= before == after
    return models.with_probability(scored, every).select("id", same.alias("same"))


_UNMARKED = f"({_LINKED}) WHERE NOT body LIKE '%&gt;%' AND NOT body LIKE '%/s%'"


@query(
    "end_to_end_rates",
    f"""SELECT sub_score, title, count(*) AS n_comments, TRUE AS positive_in_range,
               TRUE AS negative_in_range FROM {_UNMARKED} GROUP BY sub_score, title""",
)
def end_to_end_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Train on labelled documents, score all threads, report rates by story."""
    fitted, _ = _trained(spark, sf)
    comments = S.spread(S.threads(spark, sf))
    flagged = flows.flag_comments(comments, fitted)
    tallied = joins.linked_tally(flagged, S.submissions(spark, sf), report.BOTH)
    rates = R.rates_of_tally(tallied, ["sub_score", "title"], report.BOTH, support="n_comments")
    sound = [_within_unit(side).alias(f"{side}_in_range") for side in report.BOTH]
    return rates.select("sub_score", "title", "n_comments", *sound)


@query(
    "flow_scored_comments",
    f"""SELECT id, author_flair_text, com_score, title, sub_score, TRUE AS pos_is_flag,
               TRUE AS neg_is_flag FROM {_UNMARKED}""",
)
def flow_scored_comments(spark: SparkSession, sf: str) -> DataFrame:
    """Every filtered thread comment with both predictions and its submission."""
    fitted, _ = _trained(spark, sf)
    comments = S.spread(S.threads(spark, sf))
    scored = flows.score_comments(comments, S.submissions(spark, sf), fitted)
    kept = ["id", "author_flair_text", "com_score", "title", "sub_score"]
    return scored.select(*kept, _is_flag("pos"), _is_flag("neg"))


# Evaluation


def _orders(spark: SparkSession, sf: str, status: str) -> DataFrame:
    label = (F.col("o_orderstatus") == status).cast("int").alias("label")
    return S.table(spark, sf, "orders").select(F.col("o_totalprice").alias("score"), label)


def _balances(spark: SparkSession, sf: str) -> DataFrame:
    """Rounded balances, so that many rows of both classes share a score."""
    label = (F.col("c_mktsegment") == "BUILDING").cast("int").alias("label")
    score = F.floor(F.col("c_acctbal") / 100).cast("double").alias("score")
    return S.table(spark, sf, "customer").select(score, label)


_BALANCES = """(SELECT CAST(floor(c_acctbal / 100) AS DOUBLE) AS score,
                       c_mktsegment = 'BUILDING' AS label FROM customer)"""


@query("eval_auc", O.area("orders", "o_totalprice", "(o_orderstatus = 'F')"))
def eval_auc(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.auc(_orders(spark, sf, "F"), "score", "label")


@query("eval_auc_ties", O.area(_BALANCES, "score", "label"))
def eval_auc_ties(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.auc(_balances(spark, sf), "score", "label")


@query("eval_roc_points", O.roc_points("orders", "o_totalprice", "o_orderstatus = 'F'"))
def eval_roc_points(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.roc(_orders(spark, sf, "F"), "score", "label")


@query("eval_roc_corners", O.roc_corners("orders", "o_totalprice", "o_orderstatus = 'F'"))
def eval_roc_corners(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.roc_corners(_orders(spark, sf, "F"), "score", "label")


@query("eval_roc_corners_ties", O.roc_corners(_BALANCES, "score", "label"))
def eval_roc_corners_ties(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.roc_corners(_balances(spark, sf), "score", "label")


@query("eval_auc_histogram", O.histogram_area("orders", "o_totalprice", "(o_orderstatus = 'F')", 0, 500_000, 512))
def eval_auc_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.auc_from_histogram(_orders(spark, sf, "F"), "score", "label", 0, 500_000, 512)


@query(
    "eval_auc_by_source",
    f"""SELECT lang, n_pos, n_neg, (rank_sum - n_pos * (n_pos + 1) / 2.0::DOUBLE) / nullif(n_pos * n_neg, 0) AS auc
        FROM (SELECT lang, count(*) FILTER (WHERE y = 1) AS n_pos, count(*) FILTER (WHERE y = 0) AS n_neg,
                     sum(r) FILTER (WHERE y = 1) AS rank_sum
              FROM (SELECT lang, quality AS y, rank() OVER (PARTITION BY lang ORDER BY n_chars)
                           + (count(*) OVER (PARTITION BY lang, n_chars) - 1) / 2.0::DOUBLE AS r
                    FROM documents JOIN labels USING (doc_id)) GROUP BY lang)""",
)
def eval_auc_by_source(spark: SparkSession, sf: str) -> DataFrame:
    """How well a text's length tells its quality, for each language, in one ranking."""
    lengths = S.table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    labelled = lengths.join(S.table(spark, sf, "labels"), "doc_id")
    return evaluate.areas(labelled, "lang", "n_chars", "quality")


@query(
    "eval_score_label",
    """SELECT o_totalprice AS score,
              CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
       FROM orders""",
)
def eval_score_label(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.score_label(_orders(spark, sf, "F"), "score", "label")


@query(
    "rpt_roc",
    f"""SELECT 'pos' AS model, * FROM ({O.roc_points(_BALANCES, "score", "label")})
        UNION ALL
        SELECT 'neg', *
        FROM ({O.roc_points("orders", "o_totalprice", "o_orderstatus = 'O'")})""",
)
def rpt_roc(spark: SparkSession, sf: str) -> DataFrame:
    return report.roc_report({"pos": _balances(spark, sf), "neg": _orders(spark, sf, "O")})


@query(
    "snk_csv_roc_input",
    f"SELECT CAST(score AS DOUBLE) AS score, CAST(label AS DOUBLE) AS label FROM {_BALANCES}",
)
def snk_csv_roc_input(spark: SparkSession, sf: str) -> DataFrame:
    return _through_csv(spark, evaluate.score_label(_balances(spark, sf), "score", "label"))


@query(
    "rpt_roc_models",
    _by_model("SELECT 'MODEL' AS model, TRUE AS starts, TRUE AS ends, TRUE AS falls"),
)
def rpt_roc_models(spark: SparkSession, sf: str) -> DataFrame:
    """Whether both trained models' curves over the held-out half are curves.

    They start at (0, 0), end at (1, 1), and fall as the threshold rises.
    """
    scored = _held_out_scores(spark, sf)
    points = report.roc_report(
        {
            name: evaluate.score_label(scored, f"{name}_probability", target.label)
            for name, target in models.TARGETS.items()
        }
    )
    lowest = F.min(F.struct("fpr", "tpr")) == F.struct(F.lit(0.0), F.lit(0.0))
    highest = F.max(F.struct("fpr", "tpr")) == F.struct(F.lit(1.0), F.lit(1.0))
    by_threshold = F.corr("threshold", F.col("fpr") + F.col("tpr")) < 0
    return points.groupBy("model").agg(
        lowest.alias("starts"), highest.alias("ends"), by_threshold.alias("falls")
    )


# Reports


@query("rate_by_day_stored", O.both_rates("date", O.SCORED_EVENTS))
def rate_by_day_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Rates from stored tallies: all days but the last two, then the last three anew."""
    events, path = S.event_days(spark, sf), scratch_path(spark, "tallies")
    days = [r.date for r in events.select("date").distinct().orderBy(F.desc("date")).limit(3).collect()]
    R.store_tally(events.where(~F.col("date").isin(days[:2])), path, "date", ["com_score"], report.BOTH)
    R.store_tally(events, path, "date", ["com_score"], report.BOTH, days)
    return R.stored_rates(spark.read.parquet(path), ["date"], report.BOTH)


@query(
    "rpt_time",
    O.both_rates(
        "date", f"{O.SCORED_EVENTS} WHERE date IS DISTINCT FROM DATE '2024-01-30'"
    ),
)
def rpt_time(spark: SparkSession, sf: str) -> DataFrame:
    day = epoch_date(F.col("created_utc"))
    last = F.lit("2024-01-30").cast("date")
    return report.rate_report(
        S.scored_events(spark, sf), "date", exclude=[last], key_column=day
    )


_STATE_RATES = f"""(SELECT author_flair_text AS state, sum(pos) / count(pos) AS positive,
                           sum(neg) / count(neg) AS negative
                    FROM {O.SCORED_DOCUMENTS} WHERE author_flair_text IN ({_PLACE_LIST})
                    GROUP BY 1)"""


def _state_rates(spark: SparkSession, sf: str) -> DataFrame:
    placed = prep.in_list(S.scored_documents(spark, sf), "author_flair_text", PLACES)
    rates = report.rate_report(placed, "state", key_column=F.col("author_flair_text"))
    return rates.withColumn("diff", rate_diff(F.col("positive"), F.col("negative")))


@query("rpt_state_diff", f"SELECT *, negative - positive AS diff FROM {_STATE_RATES}")
def rpt_state_diff(spark: SparkSession, sf: str) -> DataFrame:
    return _state_rates(spark, sf)


@query("snk_csv_state", f"SELECT *, negative - positive AS diff FROM {_STATE_RATES}")
def snk_csv_state(spark: SparkSession, sf: str) -> DataFrame:
    return _through_csv(spark, _state_rates(spark, sf))


# Colour scales that fit the rates of the test tables.
_SCALES = {"positive": (0.6, 1.0), "negative": (0.0, 0.4), "diff": (-1.0, -0.5)}


def _shade_sql(measure: str) -> str:
    lo, hi = _SCALES[measure]
    share = f"(m - ({lo}::DOUBLE)) / {hi - lo}::DOUBLE"
    return f"""SELECT state, '{measure}' AS measure,
        1 - sqrt(least(greatest({share}, 0.0::DOUBLE), 1.0::DOUBLE)) AS shade
        FROM (SELECT state, {"negative - positive" if measure == "diff" else measure} AS m
              FROM {_STATE_RATES}) WHERE state NOT IN ('src3', 'src5')"""


@query("rpt_state_intensity", " UNION ALL ".join(_shade_sql(m) for m in _SCALES))
def rpt_state_intensity(spark: SparkSession, sf: str) -> DataFrame:
    return report.shade_report(_state_rates(spark, sf), _SCALES, skip=OFF_THE_MAP)


@query("rpt_submission_score", O.both_rates("sub_score", O.SCORED_LINES))
def rpt_submission_score(spark: SparkSession, sf: str) -> DataFrame:
    return report.rate_report(S.scored_lines(spark, sf), "sub_score")


@query("rpt_comment_score", O.both_rates("com_score", O.SCORED_EVENTS))
def rpt_comment_score(spark: SparkSession, sf: str) -> DataFrame:
    return report.rate_report(S.scored_events(spark, sf), "com_score")


# SQL surface


@query(
    "sql_surface_daily",
    O.both_rates("date", O.SCORED_EVENTS, "pos_percent", "neg_percent") + " ORDER BY date",
)
def sql_surface_daily(spark: SparkSession, sf: str) -> DataFrame:
    sql.register_views(spark, {"scored": S.scored_events(spark, sf)})
    return spark.sql(sql.DAILY_RATES)


@query(
    "sql_surface_title",
    f"""SELECT title, sub_score, sum(neg) / count(neg) AS neg_percent
        FROM {O.LINKED_THREADS} WHERE title LIKE '%{TITLE_TERM}%'
        GROUP BY sub_score, title ORDER BY neg_percent DESC, title, sub_score LIMIT 10""",
)
def sql_surface_title(spark: SparkSession, sf: str) -> DataFrame:
    sql.register_views(spark, {"tallied": _tallied_threads(spark, sf)})
    return spark.sql(sql.TITLE_RATES, {"pattern": f"%{TITLE_TERM}%", "n": 10})


@query(
    "sql_surface_state",
    f"""SELECT author_flair_text AS state, sum(pos) / count(pos) AS pos_percent,
               sum(neg) / count(neg) AS neg_percent
        FROM {O.SCORED_DOCUMENTS} WHERE author_flair_text IN ({_PLACE_LIST}) GROUP BY 1""",
)
def sql_surface_state(spark: SparkSession, sf: str) -> DataFrame:
    states = spark.createDataFrame([(place,) for place in PLACES], "state string")
    sql.register_views(spark, {"scored": S.scored_documents(spark, sf), "states": states})
    return spark.sql(sql.STATE_RATES)


@query(
    "sql_surface_comment_score",
    O.both_rates("com_score", O.SCORED_EVENTS, "pos_percent", "neg_percent"),
)
def sql_surface_comment_score(spark: SparkSession, sf: str) -> DataFrame:
    sql.register_views(spark, {"scored": S.scored_events(spark, sf)})
    return spark.sql(sql.score_rates("com_score"))


@query(
    "sql_surface_submission_score",
    O.both_rates("sub_score", O.SCORED_LINES, "pos_percent", "neg_percent"),
)
def sql_surface_submission_score(spark: SparkSession, sf: str) -> DataFrame:
    sql.register_views(spark, {"scored": S.scored_lines(spark, sf)})
    return spark.sql(sql.score_rates("sub_score"))


@query(
    "sql_functions",
    f"""WITH {O.text_tables("conversations", "conv_id || '_' || turn", "text")}
        SELECT whole.id, n AS normalised, len(string_split(combined, ' ')) AS n_tokens
        FROM whole JOIN norm ON whole.id = norm.id""",
)
def sql_functions(spark: SparkSession, sf: str) -> DataFrame:
    sql.register_functions(spark)
    sql.register_views(spark, {"turns": S.spread(S.table(spark, sf, "conversations"))})
    return spark.sql(
        """SELECT id, normalised, CAST(size(words_of(normalised)) AS BIGINT) AS n_tokens
           FROM (SELECT concat_ws('_', conv_id, turn) AS id, normalise(text) AS normalised
                 FROM turns)"""
    )


# The flagship: opinion by place over the filtered comments


@query(
    "opinion_by_place",
    f"""WITH {O.DOCUMENT_TEXT}
        SELECT d.source AS state, avg(CAST(l.quality AS DOUBLE)) AS positive,
               avg(CAST(l.toxic AS DOUBLE)) AS negative,
               CAST(sum(len(string_split(combined, ' '))) AS BIGINT) AS n_tokens
        FROM documents d JOIN labels l USING (doc_id) JOIN whole ON whole.id = d.doc_id
        WHERE NOT d.text LIKE '%&gt;%' AND NOT d.text LIKE '%/s%'
        GROUP BY 1""",
)
def opinion_by_place(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens are counted where the text lies; only ids, places and counts are joined."""
    worded = with_words(prep.drop_marked(S.spread(S.comments(spark, sf))))
    counted = worded.select(
        "id", "author_flair_text", F.array_size("words").cast("long").alias("n_words")
    )
    labels = prep.slim(
        S.label_rows(spark, sf), {"Input_id": "iid", "labeldem": "pos", "labelgop": "neg"}
    )
    labelled = joins.attach_labels(counted, labels)
    return labelled.groupBy(F.col("author_flair_text").alias("state")).agg(
        F.avg(label_value(F.col("pos"))).alias("positive"),
        F.avg(label_value(F.col("neg"))).alias("negative"),
        F.sum("n_words").alias("n_tokens"),
    )
