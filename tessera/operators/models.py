"""Matrix factorisation with Spark MLlib ALS (M1-M7).

The solver itself is MLlib's; this module fixes the conventions the
pipelines rely on: explicit seeds, ``coldStartStrategy='drop'`` so unseen
ids never turn an RMSE into NaN, non-negative factors by default, and
periodic checkpointing of the factor lineage into the shared checkpoint
directory.
"""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.products import _stored, top_k_products
from tessera.operators.ranking import ranking_metrics
from tessera.session import checkpoint_dir


#: Ratings of one training block while there are few blocks, and beyond.
SMALL_BLOCK, BLOCK = 100_000, 5_000_000
#: Blocks that small data may use, and the most there are: MLlib makes user blocks x item blocks
#: builders in every task, so this product must not grow with the cluster.
SMALL_BLOCKS, MOST_BLOCKS = 32, 1_000


def block_count(rows: int) -> int:
    """Training blocks for a number of ratings, whatever the cluster: about 100,000 ratings a block for
    small data, 5 million for large."""
    return max(1, min(SMALL_BLOCKS, -(-rows // SMALL_BLOCK)), min(MOST_BLOCKS, -(-rows // BLOCK)))


#: Iterations between checkpoints; each one lets MLlib delete the shuffle files of those before it.
CHECKPOINT_INTERVAL = 4
#: Blocks of one fit until they hold more than ``FULL_BLOCK`` ratings each.
FEW_BLOCKS, FULL_BLOCK = 6, 30_000_000
#: Ratings beyond which the fits of one job run in turn, and the most of a block then.
TOGETHER, TURN_BLOCK = 50_000_000, 13_000_000


def fits_together(rows: int, fits: int) -> dict[str, int]:
    """How ``fits`` fits of one job on about ``rows`` ratings run: what ``fit_als`` takes, ``fits`` the number at a time.

    A task holds all ratings of a block several times over while it sorts them, and every running fit keeps its
    own blocks.  Large fits therefore run one after another, each in blocks that use the cluster by itself."""
    return {"fits": fits} if rows <= TOGETHER else {"fits": 1, "full_block": TURN_BLOCK}


def fit_blocks(rows: int, fits: int = 1, full_block: int | None = None) -> int:
    """Blocks of one of ``fits`` concurrent fits.

    Every half iteration MLlib ships a factor to each block of the other side that rates it, so what a
    fit writes grows with blocks x ids until a block has no two ratings of an id.  Few blocks
    keep that small, and concurrent fits share the cluster between them; beyond ``full_block`` (``FULL_BLOCK``) ratings
    a block the number follows the data, never above ``block_count``."""
    few = max(2, -(-FEW_BLOCKS // fits))
    return min(block_count(rows), max(few, -(-rows // (full_block or FULL_BLOCK))))


def make_als(
    rank: int = 10,
    max_iter: int = 10,
    reg_param: float = 0.1,
    nonnegative: bool = True,
    seed: int = 1,
    user: str = "user_id",
    item: str = "item_id",
    rating: str = "rating",
    cold_start_strategy: str = "drop",
    num_blocks: int = 10,
    checkpoint_interval: int = CHECKPOINT_INTERVAL,
    num_item_blocks: int | None = None,
) -> ALS:
    """MLlib ALS with the library's conventions.

    ``num_blocks`` sets user and item blocks of training (``fit_als`` derives it
    from the number of ratings), ``num_item_blocks`` the item side alone.
    """
    als = ALS(
        rank=rank,
        maxIter=max_iter,
        regParam=reg_param,
        nonnegative=nonnegative,
        seed=seed,
        userCol=user,
        itemCol=item,
        ratingCol=rating,
        coldStartStrategy=cold_start_strategy,
        checkpointInterval=checkpoint_interval,
    )
    return als.setNumUserBlocks(num_blocks).setNumItemBlocks(num_item_blocks or num_blocks)


def fit_als(train: DataFrame, fits: int = 1, full_block: int | None = None, **params) -> ALSModel:
    """Fit on (user, item, rating) rows; the rating is used as a float.  ``fits``: how many run at a time;
    ``full_block``: the most ratings of a block, as in ``fit_blocks``."""
    checkpoint_dir(train.sparkSession)
    rating = params.get("rating", "rating")
    user = params.get("user", "user_id")
    item = params.get("item", "item_id")
    rows = train.select(user, item, F.col(rating).cast("float").alias(rating))
    if not params.get("num_blocks"):
        params["num_blocks"] = fit_blocks(rows.count(), fits, full_block)
    return make_als(**params).fit(rows)


def predict(model: ALSModel, rows: DataFrame) -> DataFrame:
    """Rows plus ``prediction``; rows with an unseen user or item are dropped."""
    return model.transform(rows)


def rmse_of(model: ALSModel, rows: DataFrame, label: str = "rating") -> float:
    return RegressionEvaluator(metricName="rmse", labelCol=label, predictionCol="prediction").evaluate(
        predict(model, rows.withColumn(label, F.col(label).cast("double")))
    )


def recommend(model: ALSModel, k: int, entities: DataFrame | None = None, for_: str = "users") -> DataFrame:
    """Top-k per entity as rows (entity, target, score, pos) (O3).

    ``for_='users'`` ranks items for each user; ``for_='items'`` ranks users
    for each item.  With ``entities`` only those ids are scored, which is far
    cheaper than scoring every id when only a held-out subset is evaluated.
    The factors are scored by ``products.top_k_products``: its blocks follow the
    number of factors, so a larger cluster does not make the result larger.
    """
    user, item = model.getUserCol(), model.getItemCol()
    entity, target = (user, item) if for_ == "users" else (item, user)
    sources, targets = (model.userFactors, model.itemFactors) if for_ == "users" else (model.itemFactors, model.userFactors)
    if entities is not None:
        sources = sources.join(entities.select(F.col(entity).alias("id")).distinct(), "id", "left_semi")
    return top_k_products(sources, targets, k, entity, target)


def evaluate_topk(model: ALSModel, truth: DataFrame, k: int = 500, for_: str = "users") -> DataFrame:
    """Ranking metrics of the model's top-k lists against held-out rows (L4).

    Only entities that have truth rows are scored; seen training items are
    not removed from the lists (R13); any rating counts as relevant (R11).
    """
    user, item = model.getUserCol(), model.getItemCol()
    entity, target = (user, item) if for_ == "users" else (item, user)
    ids = truth.select(entity).distinct()
    preds = _stored(recommend(model, k, ids, for_).select(entity, target, "pos"), "top-k")  # read twice
    return ranking_metrics(preds, truth, k, user=entity, item=target)


def evaluate_sets(model: ALSModel, sets: dict[str, DataFrame], k: int = 500, for_: str = "users") -> DataFrame:
    """``evaluate_topk`` for several held-out sets at once: one row per set.

    The entities of all sets are scored in a single top-k call and the
    metrics of every set come from one grouped pass, instead of one model
    scan and one metrics job per set.
    """
    user, item = model.getUserCol(), model.getItemCol()
    entity, target = (user, item) if for_ == "users" else (item, user)
    truth = None
    for name, rows in sets.items():
        t = rows.select(F.lit(name).alias("split"), entity, target)
        truth = t if truth is None else truth.unionByName(t)
    ids = truth.select(entity).distinct()
    preds = _stored(recommend(model, k, ids, for_).select(entity, target, "pos"), "top-k")  # read twice
    return ranking_metrics(preds, truth, k, user=entity, item=target, by=["split"])


def factor_table(model: ALSModel, which: str = "items") -> DataFrame:
    """(id, features array<float>) of the fitted model (M7)."""
    return model.itemFactors if which == "items" else model.userFactors


def save_model(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    return ALSModel.load(path)
