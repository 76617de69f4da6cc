"""Table schemas used at the boundaries."""

from pyspark.sql import types as T

#: CSV layout of a session file: every column is text.
SESSION_TEXT = T.StructType(
    [
        T.StructField(name, T.StringType(), True)
        for name in (
            "id",
            "date",
            "chamber",
            "type",
            "raw_text",
            "clean_text",
            "intervention_pairs",
            "interventions",
        )
    ]
)

SPANS = "doc string, page int, block int, line int, span int, text string, font string"
SESSIONS = "session_id string, date date, chamber string"
CLUSTERS = "intervention_id string, embeddings array<double>, cluster int"
