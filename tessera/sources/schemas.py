"""Schemas and fixed names."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw interaction columns, in file order.
INTERACTION_COLUMNS = ["user_id", "item_id", "is_read", "rating", "is_reviewed"]
INTERACTIONS_DDL = "user_id BIGINT, item_id BIGINT, is_read INT, rating INT, is_reviewed INT"

# --- Fixed values (must equal the genre documents' field names) -------------
# Keys of the nested ``genres`` object in the genre JSON documents, and the
# column each one becomes, in this order.
GENRE_KEYS = [
    "children",
    "comics, graphic",
    "fantasy, paranormal",
    "fiction",
    "history, historical fiction, biography",
    "mystery, thriller, crime",
    "non-fiction",
    "poetry",
    "romance",
    "young-adult",
]
GENRE_COLUMNS = [
    "children",
    "comics_graphic",
    "fantasy_paranormal",
    "fiction",
    "history_historical_fiction_biography",
    "mystery_thriller_crime",
    "non_fiction",
    "poetry",
    "romance",
    "young_adult",
]
# -----------------------------------------------------------------------------

GENRE_JSON_SCHEMA = T.StructType(
    [
        T.StructField("book_id", T.StringType(), True),
        T.StructField(
            "genres",
            T.StructType([T.StructField(k, T.LongType(), True) for k in GENRE_KEYS]),
            True,
        ),
    ]
)

ID_MAP_COLUMNS = ["item_id", "real_item_id"]
