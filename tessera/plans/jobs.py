"""Path-in, path-out jobs with the shape of the original scripts.

Each job reads its inputs from storage, runs the DataFrame plan and writes
its outputs; nothing but small summaries returns to the driver.  ``names`` maps
the library's column names to those of the stored tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import models as M
from tessera.operators import splits as S
from tessera.plans import factor_map as FM
from tessera.plans.coldstart import cold_start
from tessera.plans.evaluate import holdout_report
from tessera.plans.tune import tune_als
from tessera.sources import readers as R


def down_sample(
    spark: SparkSession, input_path: str, output_path: str, fraction: float, min_interactions: int = 10, names: dict[str, str] | None = None
) -> None:
    """All rows of a reproducible ``fraction`` of the active users; fails if the output exists (L1)."""
    rows = R.read_interactions(spark, input_path, names)
    S.sample_users(rows, fraction, min_interactions).write.mode("errorifexists").parquet(output_path)


def train_test_split(spark: SparkSession, input_path: str, output_path: str, fractions=(0.6, 0.2, 0.2), names: dict[str, str] | None = None) -> None:
    """Clean, split by user, halve held-out users; one table partitioned by ``part`` (L2).

    Read the four tables back with ``splits.read_part(spark, output_path, name)``
    for ``final_train_val``, ``final_train_test``, ``final_val``, ``final_test``.
    """
    rows = R.clean_interactions(R.renamed(spark.read.parquet(input_path), names))
    S.write_parts(S.assign_parts(rows, fractions), output_path)


def tune(
    spark: SparkSession,
    parts_path: str,
    report_path: str,
    model_path: str,
    ranks=(10, 15, 20),
    max_iters=(10, 15, 20),
    reg_params=(0.1, 0.15, 0.2),
    parallelism: int = 8,
    metric: str = "rmse",
) -> DataFrame:
    """Grid search on final_train_val / final_val; report as CSV, best model saved (L3)."""
    report, _, _ = tune_als(
        S.read_part(spark, parts_path, "final_train_val"),
        S.read_part(spark, parts_path, "final_val"),
        ranks,
        max_iters,
        reg_params,
        parallelism,
        report_path=report_path,
        model_path=model_path,
        metric=metric,
    )
    return report


def evaluate(spark: SparkSession, parts_path: str, metrics_path: str, params: dict, k: int = 500) -> DataFrame:
    """Top-k ranking metrics for validation and test users, appended to a metrics table (L4)."""
    parts = spark.read.parquet(parts_path)
    return holdout_report(parts, params, k, metrics_path)


def evaluate_saved_model(spark: SparkSession, model_path: str, rows_path: str, k: int = 500, for_: str = "users") -> DataFrame:
    """Ranking metrics of a saved model on held-out rows."""
    return M.evaluate_topk(M.load_model(model_path), spark.read.parquet(rows_path), k, for_)


def cold_start_job(
    spark: SparkSession,
    ratings_path: str,
    genre_json_path: str,
    id_map_path: str,
    radius: float = 1.5,
    names: dict[str, str] | None = None,
    id_map_names: dict[str, str] | None = None,
    id_map_format: str = "csv",
    **params,
) -> DataFrame:
    """Cold-start experiment from stored ratings, genre documents and the id dictionary.

    The dictionary is CSV with a header or parquet.  ``params`` go to ``cold_start``,
    e.g. ``method="lsh", radius=0.8, num_hash_tables=5``.
    """
    from tessera.operators.features import genre_array, remap_ids

    ratings = R.clean_interactions(R.renamed(spark.read.parquet(ratings_path), names))
    genres = R.flatten_genres(R.read_genre_json(spark, genre_json_path))
    id_map = R.read_id_map(spark, id_map_path, id_map_format, id_map_names)
    feats = genre_array(remap_ids(genres, id_map)).select("item_id", "features")
    return cold_start(ratings, feats, radius=radius, **params)


def factor_map_job(
    spark: SparkSession,
    model_path: str,
    id_map_path: str,
    labels_path: str,
    output_path: str,
    keep_labels: list[str] | None = None,
    id_map_names: dict[str, str] | None = None,
    label_names: dict[str, str] | None = None,
    id_map_format: str = "csv",
    positions_path: str | None = None,
) -> DataFrame:
    """Saved model's item factors joined to labels, exported wide; label medians in 2-D.

    With ``positions_path`` every item's 2-D position is written too, with its label and
    label code, label by label: (item_id, real_item_id, genre, label, x, y).
    """
    model = M.load_model(model_path)
    id_map = R.read_id_map(spark, id_map_path, id_map_format, id_map_names)
    labels = R.renamed(spark.read.option("header", "true").csv(labels_path), label_names).select("real_item_id", "genre")
    mapped = FM.factor_genre_map(model.itemFactors, id_map, labels, keep_labels)
    FM.export_wide(mapped, model.rank, output_path)
    projected = FM.project_2d(mapped).select("item_id", "real_item_id", "genre", "x", "y")
    if positions_path:
        coded = FM.index_labels(projected).select("item_id", "real_item_id", "genre", "label", "x", "y")
        FM.sort_by_label(coded).write.mode("overwrite").parquet(positions_path)
        projected = spark.read.parquet(positions_path).select(*[F.col(c) for c in projected.columns])
    return FM.label_medians(projected, "genre", "x", "y")
