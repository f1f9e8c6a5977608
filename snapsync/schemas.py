"""Schemas of the tables that the engine reads and writes."""

from pyspark.sql import types as T


def _schema(**columns):
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


STRING, LONG, INT, TIME = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampNTZType()

KEY = ("type", "class_id", "short_name")

CATALOG_OBJECTS = _schema(
    source_db=STRING, type=STRING, class_id=STRING, short_name=STRING, modified=TIME
)
SOURCE_LINES = _schema(source_db=STRING, object_id=LONG, part_type=STRING, line=INT, text=STRING)
DIARY = _schema(
    source_db=STRING, object_id=LONG, time=TIME, action=STRING, user_id=STRING, seq=LONG
)
CHANGE_ROWS = _schema(
    source_db=STRING,
    type=STRING,
    class_id=STRING,
    short_name=STRING,
    modified=TIME,
    user_modified=STRING,
    extention=STRING,
    text=STRING,
)
OBJECT_VERSIONS = _schema(
    source_db=STRING,
    epoch=STRING,
    poll=STRING,
    type=STRING,
    class_id=STRING,
    short_name=STRING,
    path=STRING,
    modified=TIME,
    user_modified=STRING,
    text_sha=STRING,
    # The poll that brought the text: a hash and its poll name one stored text.
    text_poll=STRING,
    changeset_id=LONG,
    removed=T.BooleanType(),
)
TEXTS = _schema(poll=STRING, text_sha=STRING, text=STRING)
CHANGESETS = _schema(
    source_db=STRING,
    epoch=STRING,
    poll=STRING,
    changeset_id=LONG,
    author=STRING,
    author_email=STRING,
    committer=STRING,
    author_time=STRING,
    n_rows=LONG,
    n_messages=LONG,
)
MESSAGES = _schema(
    source_db=STRING,
    epoch=STRING,
    poll=STRING,
    changeset_id=LONG,
    message_no=LONG,
    n_objects=LONG,
    message=STRING,
)
CONTROL = _schema(
    source_db=STRING,
    epoch=STRING,
    poll=STRING,
    poll_no=LONG,
    high_water=TIME,
    updated_at=TIME,
)
# Control rows of the polls that a fold holds.
FOLDED = T.StructType([*CONTROL.fields, T.StructField("fold", STRING), T.StructField("fold_no", LONG)])
DIARY_STATE = _schema(
    source_db=STRING,
    id=LONG,
    action_time=TIME,
    last_seq=LONG,
    newest=_schema(time=TIME, seq=LONG, user_id=STRING),
)
# Segments of a diary's state that a fold holds.
DIARY_COVERED = _schema(fold_no=LONG, fold=STRING, segment=STRING)
