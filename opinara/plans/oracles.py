"""SQL for the text stage without look-around, to check the column functions.

Written for an engine whose regular expressions know neither look-around nor
back-references, so it takes other steps to the same text.
"""

from __future__ import annotations

_SPACE = r"\x{0009}-\x{000d}\x{001c}-\x{0020}\x{0085}\p{Z}"
_WORD = r"\p{L}\p{N}_"
_KEPT = r".,:!?;''$%"
_DIGIT = r"\p{Nd}"
_OTHER = f"[^{_KEPT}{_WORD}]"
# The same without the space, which stays a space anyway.
_OTHER_VISIBLE = f"[^ {_KEPT}{_WORD}]"

NORMALISE_STEPS = [
    (r"[\r\n\t]", " "),
    (r"\.{2,}", " . "),
    (r"!{2,}", " ! "),
    (r"\?{2,}", " ? "),
    (r",{2,}", " , "),
    (rf"\(?(https?://|www\.)[^{_SPACE}]*", " "),
    (rf"^[{_SPACE}]+|[{_SPACE}]+$", ""),
    (r"$", " "),
    (r"([.,:!?;]) ", r" \1  "),
    (f"{_OTHER}{{2,}}", " "),
    (f"(^|[{_KEPT}]){_OTHER_VISIBLE}", r"\1 "),
    (f"{_OTHER_VISIBLE}([{_KEPT}]|$)", r" \1"),
    (rf"\$+(\${_DIGIT})", r" \1"),
    (rf"\$+([^{_DIGIT}$]|$)", r" \1"),
    (rf"({_DIGIT}%)%+", r"\1 "),
    (rf"(^|[^{_DIGIT}%])%+", r"\1 "),
    (r"\(", " "),
    (r" +", " "),
]


def normalise(text: str) -> str:
    for pattern, by in NORMALISE_STEPS:
        text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
    return f"lower(trim({text}))"


def text_tables(source: str, id: str, body: str) -> str:
    """WITH tables: norm(id, n), uni(id, u), grams(id, b, t, word_tokens)."""
    return f"""
        norm AS (SELECT {id} AS id, {normalise(body)} AS n FROM {source}),
        uni AS (
            SELECT id, regexp_replace(
                regexp_replace(n, ' [.!?,;:] ', ' ', 'g'), ' [.!?,;:]$', '') AS u
            FROM norm),
        parts AS (
            SELECT id, unnest(string_split_regex(n, '[{_SPACE}]+')) AS word,
                   generate_subscripts(string_split_regex(n, '[{_SPACE}]+'), 1) AS i
            FROM norm),
        marked AS (
            SELECT id, i, word, word IN ('.', ',', ':', '!', '?', ';') AS mark
            FROM parts WHERE word <> ''),
        ahead AS (
            SELECT id, i, word, mark,
                   lead(word, 1) OVER w AS word2, lead(mark, 1) OVER w AS mark2,
                   lead(word, 2) OVER w AS word3, lead(mark, 2) OVER w AS mark3
            FROM marked WINDOW w AS (PARTITION BY id ORDER BY i)),
        found AS (
            SELECT id,
                   string_agg(word || '_' || word2, ' ' ORDER BY i)
                       FILTER (WHERE NOT mark AND NOT mark2) AS b,
                   string_agg(word || '_' || word2 || '_' || word3, ' ' ORDER BY i)
                       FILTER (WHERE NOT mark AND NOT mark2 AND NOT mark3) AS t,
                   string_agg(word, ' ' ORDER BY i) AS word_tokens
            FROM ahead GROUP BY id),
        grams AS (
            SELECT norm.id, coalesce(b, '') AS b, coalesce(t, '') AS t,
                   coalesce(word_tokens, '') AS word_tokens
            FROM norm LEFT JOIN found ON norm.id = found.id),
        whole AS (
            SELECT uni.id, u || ' ' || b || ' ' || t AS combined
            FROM uni JOIN grams ON uni.id = grams.id)"""


DOCUMENT_TEXT = text_tables("documents", "doc_id", "text")

LABELLED_TEXT = text_tables(
    "(SELECT documents.* FROM documents JOIN labels USING (doc_id))", "doc_id", "text"
)

COMMENTS = """(
    SELECT CAST(doc_id AS VARCHAR) AS id, text AS body, source AS author_flair_text
    FROM documents)"""

MARKED_COMMENTS = """(
    SELECT CAST(doc_id AS VARCHAR) AS id, source AS author_flair_text,
           CASE doc_id % 7 WHEN 0 THEN '&gt; they said' || chr(10) || chr(10) || text
                WHEN 1 THEN text || ' /s'
                WHEN 2 THEN 'see https://example.org/story ' || text
                WHEN 3 THEN NULL
                WHEN 4 THEN text || ' > &gt' ELSE text END AS body
    FROM documents)"""

THREADS = """(
    SELECT conv_id || '_' || turn AS id, text AS body, 't3_' || conv_id AS link_id,
           role AS author_flair_text, turn AS com_score
    FROM conversations WHERE turn > 0)"""

SUBMISSIONS = """(
    SELECT CAST(conv_id AS VARCHAR) AS sub_id, text AS title,
           CAST(length(text) AS BIGINT) AS sub_score
    FROM conversations WHERE turn = 0)"""

LABEL_ROWS = """(
    SELECT CAST(doc_id AS VARCHAR) AS "Input_id", CAST(quality AS VARCHAR) AS labeldem,
           CAST(toxic AS VARCHAR) AS labelgop,
           CASE WHEN toxic = 1 THEN '-1' WHEN quality = 1 THEN '1' ELSE 'none' END AS labeldjt
    FROM labels)"""

SCORED_DOCUMENTS = """(
    SELECT CAST(doc_id AS VARCHAR) AS id, CAST(quality AS DOUBLE) AS pos,
           CAST(toxic AS DOUBLE) AS neg, source AS author_flair_text, lang
    FROM documents JOIN labels USING (doc_id))"""

SCORED_EVENTS = """(
    SELECT CAST(event_id AS VARCHAR) AS id,
           CASE WHEN event_type = 'purchase' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS pos,
           CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS neg,
           CAST(floor(epoch(ts)) AS BIGINT) AS created_utc,
           CAST(ts AS DATE) AS date,
           CAST(floor("value") AS BIGINT) AS com_score
    FROM events)"""

SCORED_LINES = """(
    SELECT CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS pos,
           CASE WHEN l_returnflag = 'A' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS neg,
           CAST(l_quantity AS BIGINT) AS sub_score
    FROM lineitem)"""

SCORED_THREADS = f"""(
    SELECT id, link_id, com_score,
           CASE WHEN author_flair_text = 'assistant' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS pos,
           CASE WHEN length(body) > 300 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS neg
    FROM {THREADS})"""

LINKED_THREADS = f"""(
    SELECT * FROM {SCORED_THREADS} c JOIN {SUBMISSIONS} s ON c.link_id = 't3_' || s.sub_id)"""


def both_rates(
    key: str, source: str, positive: str = "positive", negative: str = "negative"
) -> str:
    return (
        f"SELECT {key}, sum(pos) / count(pos) AS {positive}, "
        f"sum(neg) / count(neg) AS {negative} FROM {source} GROUP BY ALL"
    )


def roc_points(source: str, score: str, label: str) -> str:
    """Threshold, fpr and tpr for each distinct score, and the start of the curve."""
    return f"""
        SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
        UNION ALL
        SELECT score AS threshold,
               CAST(sum(n) OVER w AS DOUBLE) / nullif(sum(n) OVER (), 0) AS fpr,
               CAST(sum(p) OVER w AS DOUBLE) / nullif(sum(p) OVER (), 0) AS tpr
        FROM (SELECT CAST({score} AS DOUBLE) AS score,
                     count(*) FILTER (WHERE {label}) AS p,
                     count(*) FILTER (WHERE NOT {label}) AS n
              FROM {source} WHERE {score} IS NOT NULL GROUP BY 1)
        WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""


def area(source: str, score: str, label: str) -> str:
    """Area under the curve from average ranks."""
    return f"""
        SELECT n_pos, n_neg,
               (rank_sum - n_pos * (n_pos + 1) / 2.0::DOUBLE) / (n_pos * n_neg) AS auc
        FROM (SELECT count(*) FILTER (WHERE y) AS n_pos, count(*) FILTER (WHERE NOT y) AS n_neg,
                     sum(mean_rank) FILTER (WHERE y) AS rank_sum
              FROM (SELECT {label} AS y,
                           rank() OVER (ORDER BY {score})
                               + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0::DOUBLE
                               AS mean_rank
                    FROM {source} WHERE {score} IS NOT NULL))"""


def hash_bucket(value: str, buckets: int, seed: int) -> str:
    return f"('0x' || substr(md5('{seed}:' || {value}), 1, 8))::BIGINT % {buckets}"


def roc_corners(source: str, score: str, label: str) -> str:
    """The points where the next step differs from the last, and the start at infinity."""
    return f"""
        SELECT 'infinity'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
        UNION ALL
        SELECT score, CAST(n_reached AS DOUBLE) / nullif(n_all, 0), CAST(p_reached AS DOUBLE) / nullif(p_all, 0)
        FROM (SELECT score, sum(n) OVER w AS n_reached, sum(p) OVER w AS p_reached,
                     sum(n) OVER () AS n_all, sum(p) OVER () AS p_all,
                     row_number() OVER w = 1 OR row_number() OVER w = count(*) OVER ()
                     OR lead(n) OVER w <> n OR lead(p) OVER w <> p AS corner
              FROM (SELECT CAST({score} AS DOUBLE) AS score, count(*) FILTER (WHERE {label}) AS p,
                           count(*) FILTER (WHERE NOT {label}) AS n
                    FROM {source} WHERE {score} IS NOT NULL GROUP BY 1)
              WINDOW w AS (ORDER BY score DESC))
        WHERE corner"""


def histogram_area(source: str, score: str, label: str, low: float, high: float, bins: int) -> str:
    """Area and its bound from counts of both classes in equal parts of the scores."""
    share = f"floor(({score} - {float(low)}::DOUBLE) / {float(high) - float(low)}::DOUBLE * {float(bins)}::DOUBLE)"
    return f"""
        SELECT sum(p)::BIGINT AS n_pos, sum(n)::BIGINT AS n_neg,
               sum(p * (2 * below + n))::DOUBLE / (2.0::DOUBLE * sum(p)::DOUBLE * sum(n)::DOUBLE) AS auc,
               sum(p * n)::DOUBLE / (2.0::DOUBLE * sum(p)::DOUBLE * sum(n)::DOUBLE) AS bound
        FROM (SELECT p, n, coalesce(sum(n) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
              FROM (SELECT greatest(least({share}, {bins - 1}), 0) AS bin, count(*) FILTER (WHERE {label}) AS p,
                           count(*) FILTER (WHERE NOT {label}) AS n
                    FROM {source} WHERE {score} IS NOT NULL GROUP BY 1))"""
