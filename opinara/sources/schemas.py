"""Schemas of the input tables; reading never infers types."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


COMMENTS = _struct(
    id=T.StringType(),
    body=T.StringType(),
    link_id=T.StringType(),
    created_utc=T.LongType(),
    author_flair_text=T.StringType(),
    score=T.LongType(),
)
SUBMISSIONS = _struct(id=T.StringType(), title=T.StringType(), score=T.LongType())
LABELS = _struct(
    Input_id=T.StringType(),
    labeldem=T.StringType(),
    labelgop=T.StringType(),
    labeldjt=T.StringType(),
)
