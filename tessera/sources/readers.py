"""Readers, writers and the cleaning step.

All readers declare their schema: no inference pass over the data, and
columns are extracted by name, never by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.schemas import (
    GENRE_COLUMNS,
    GENRE_JSON_SCHEMA,
    GENRE_KEYS,
    ID_MAP_COLUMNS,
    INTERACTION_COLUMNS,
    INTERACTIONS_DDL,
)


def renamed(df: DataFrame, names: dict[str, str] | None) -> DataFrame:
    """``df`` with its own column names (values) read as the library's (keys)."""
    for ours, theirs in (names or {}).items():
        df = df.withColumnRenamed(theirs, ours)
    return df


def read_interactions(spark: SparkSession, path: str, names: dict[str, str] | None = None) -> DataFrame:
    """Parquet interactions with the five integer columns.

    ``names`` gives the names of the stored columns, e.g. ``{"item_id": "book_id"}``."""
    return renamed(spark.read.parquet(path), names).select(*INTERACTION_COLUMNS)


def clean_interactions(df: DataFrame, keys=("user_id", "item_id", "rating")) -> DataFrame:
    """Cast the interaction columns to whole numbers and drop rows whose keys are null.

    ``try_cast`` turns malformed values into NULL instead of failing under ANSI
    mode; rows without user, item or rating are then removed.  Ids are cast to
    64 bits, so no well-formed id is lost (``features.dense_ids`` makes ids that
    do not fit 32 bits fit for ALS); the other columns to 32.  Columns that are
    already int are left alone, so parquet filter pushdown still applies.
    """
    kinds = dict(df.dtypes)
    present = [c for c in INTERACTION_COLUMNS if c in df.columns]
    wide = {"user_id", "item_id"}
    cast = lambda c: F.col(c) if kinds[c] == "int" or kinds[c] == "bigint" and c in wide else F.col(c).try_cast("bigint" if c in wide else "int")
    return df.select(*[cast(c).alias(c) for c in present]).dropna(subset=[k for k in keys if k in present])


def explicit_ratings(df: DataFrame, rating: str = "rating") -> DataFrame:
    """Rows with a real rating; 0 means 'not rated' (P3)."""
    return df.filter(F.col(rating) != 0)


def read_interactions_csv(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Interactions from CSV with the declared schema, ids of 64 bits.

    A field that is no number reads as null; ``quarantine_csv`` keeps such lines apart and counts them."""
    return spark.read.csv(path, header=header, schema=INTERACTIONS_DDL, mode="PERMISSIVE")


#: Why a line is kept apart.
MALFORMED, NO_KEY = "malformed", "missing key"


def _quarantined(rows: DataFrame, line, lacking, table_path: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their raw text in ``_corrupt`` where they could not be read -> (good rows, rejects), written in one pass."""
    columns = [c for c in rows.columns if c != "_corrupt"]
    reason = F.when(F.col("_corrupt").isNotNull(), F.lit(MALFORMED)).when(lacking, F.lit(NO_KEY)).otherwise(F.lit("none"))
    out = rows.withColumn("_line", F.coalesce("_corrupt", line)).withColumn("_reason", reason).drop("_corrupt")
    out = out.withColumn("_line", F.when(F.col("_reason") != "none", F.col("_line")))
    out.write.mode("errorifexists").partitionBy("_reason").parquet(table_path)
    stored = rows.sparkSession.read.schema(out.schema).parquet(table_path)
    good = stored.filter(F.col("_reason") == "none").select(*columns)
    return good, stored.filter(F.col("_reason") != "none").select(F.col("_line").alias("line"), F.col("_reason").alias("reason"))


def quarantine_csv(spark: SparkSession, csv_path: str, table_path: str, header: bool = False, keys=("user_id", "item_id", "rating")) -> tuple[DataFrame, DataFrame]:
    """CSV interactions stored as parquet -> (good rows, rejects (line, reason)).

    A line with a field that doesn't fit its type, or with too few or too many fields, is ``malformed``; one whose keys are
    empty is of ``missing key``.  Nothing is lost: every line is a good row or a reject.  The text is read once; both
    results are partitions of one written table.
    """
    rows = spark.read.csv(csv_path, header=header, schema=f"{INTERACTIONS_DDL}, _corrupt STRING", mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt")
    line = F.to_csv(F.struct(*INTERACTION_COLUMNS))
    return _quarantined(rows, line, F.greatest(*[F.col(k).isNull() for k in keys]), table_path)


def quarantine_genre_json(spark: SparkSession, json_path: str, table_path: str) -> tuple[DataFrame, DataFrame]:
    """Genre documents stored as parquet -> (good documents, rejects (line, reason)) (S5): lines that are no such document are
    ``malformed``, documents without an id of ``missing key``."""
    schema = T.StructType([*GENRE_JSON_SCHEMA.fields, T.StructField("_corrupt", T.StringType())])
    rows = spark.read.schema(schema).option("columnNameOfCorruptRecord", "_corrupt").json(json_path)
    # Parquet takes no commas in field names of older readers: the genres become columns.
    flat = rows.select("book_id", *[F.col("genres").getField(k).alias(c) for k, c in zip(GENRE_KEYS, GENRE_COLUMNS)], "_corrupt")
    return _quarantined(flat, F.to_json(F.struct("book_id")), F.col("book_id").try_cast("bigint").isNull(), table_path)


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Rejected lines by reason."""
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n_lines"))


def read_id_map(spark: SparkSession, path: str, fmt: str = "csv", names: dict[str, str] | None = None) -> DataFrame:
    """The id dictionary (item_id, real_item_id) from CSV with a header or from parquet.

    ``names`` gives the stored names, e.g. ``{"item_id": "book_id_csv", "real_item_id": "real_book_id"}``.
    Ids are 64-bit; rows without either id go."""
    stored = spark.read.parquet(path) if fmt == "parquet" else spark.read.option("header", "true").csv(path)
    df = renamed(stored, names)
    return df.select(*[F.col(c).try_cast("bigint").alias(c) for c in ID_MAP_COLUMNS]).dropna()


def read_string_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV with a header row whose columns are read as strings (S3)."""
    ddl = ", ".join(f"`{c}` STRING" for c in columns)
    return spark.read.csv(path, header=True, schema=ddl, enforceSchema=False)


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str, header: bool = True) -> DataFrame:
    """Convert raw CSV interactions to parquet once; fails if the target exists (S4, K1).  With lines that may be
    malformed, use ``quarantine_csv``."""
    read_interactions_csv(spark, csv_path, header=header).write.mode("errorifexists").parquet(parquet_path)
    return spark.read.parquet(parquet_path)


def read_genre_json(spark: SparkSession, path: str) -> DataFrame:
    """Nested genre documents ``{book_id, genres: {name: count}}``."""
    return spark.read.schema(GENRE_JSON_SCHEMA).json(path)


def flatten_genres(docs: DataFrame, id_col: str = "book_id", out_id: str = "real_item_id") -> DataFrame:
    """Struct of genre counts -> ten int columns, absent or null -> 0, by name."""
    return docs.select(
        F.col(id_col).try_cast("bigint").alias(out_id),
        *[
            F.coalesce(F.col("genres").getField(k), F.lit(0)).cast("int").alias(c)
            for k, c in zip(GENRE_KEYS, GENRE_COLUMNS)
        ],
    ).dropna(subset=[out_id])


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", str(header).lower()).csv(path)
