"""Queries: genre documents, id remapping, feature vectors."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tessera.operators import features as FE
from tessera.plans import oracle as O
from tessera.plans.catalog import register
from tessera.session import scratch_path
from tessera.sources import fixtures as fx
from tessera.sources import readers as R
from tessera.sources.schemas import GENRE_COLUMNS

GCOLS = ", ".join(GENRE_COLUMNS)


def _stored_genres(spark, sf_dir):
    """Genre documents written as JSON lines and read back."""
    path = scratch_path(spark, "genres-json")
    fx.genre_documents(fx.item_genres(spark, sf_dir)).write.mode("overwrite").json(path)
    return R.flatten_genres(R.read_genre_json(spark, path))


@register(
    "genre_features",
    O.with_(O.ITEM_GENRES) + f"SELECT CAST(item_id * 7 + 3 AS BIGINT) AS real_item_id, {GCOLS} FROM item_genres",
)
def genre_features(spark, sf_dir):
    return _stored_genres(spark, sf_dir)


@register("item_id_remap", O.with_(O.ITEM_GENRES) + f"SELECT CAST(item_id AS BIGINT) AS item_id, {GCOLS} FROM item_genres")
def item_id_remap(spark, sf_dir):
    """The id dictionary comes from CSV with a header."""
    path = scratch_path(spark, "idmap-csv")
    R.write_csv(fx.item_id_map(spark, sf_dir), path, header=True)
    return FE.remap_ids(_stored_genres(spark, sf_dir), R.read_id_map(spark, path))


@register(
    "genre_vectors",
    O.with_(O.ITEM_GENRES)
    + " UNION ALL ".join(
        f"SELECT item_id, CAST({i} AS INTEGER) AS pos, CAST({c} AS DOUBLE) AS value FROM item_genres"
        for i, c in enumerate(GENRE_COLUMNS)
    ),
)
def genre_vectors(spark, sf_dir):
    vecs = FE.assemble_vectors(fx.item_genres(spark, sf_dir))
    return vecs.select("item_id", F.posexplode(vector_to_array("features")).alias("pos", "value"))
