"""Radius similarity joins between two sets of feature vectors.

Exact join
    Feature vectors repeat heavily (many items share one genre profile), so
    the join runs on distinct vectors and only then expands to ids.  The key is
    the vector itself as ``array<double>`` with -0.0 read as 0.0.

    Whole-numbered vectors with a small radius: every neighbour of ``v`` within
    radius r is ``v + d`` for an integer offset ``d`` with ``|d|^2 < r^2``.  Each
    left vector is expanded by that (data-independent) offset list and equi-joined
    on the shifted vector, so candidates are exactly the matches.

    All others: a grid of cell width r on the few coordinates that differ most.
    A neighbour lies in the same or an adjacent cell on each of them; the distance
    over all coordinates decides.  Both ways give the same pairs; the number of
    offsets only picks the cheaper one.

Expansion to ids
    The ids of a vector are packed in chunks of bounded size.  A pair of vectors becomes
    one row for every pair of chunks, the rows are dealt over the cluster,
    and each expands to a bounded number of id pairs.  A vector that a third of all items
    share is written by many tasks.

Folded join
    ``class_join`` expands nothing: it gives pairs of classes (the ids of one vector) and every id with its class and its number of
    links.  ``radius_neighbors_lsh`` returns this form; pairs of ids grow with the square of a class.

Approximate join
    Random projections in buckets, on distinct vectors: a table of (projections, bucket) keys, in which a
    left vector probes its own bucket and the adjacent ones.  Candidates are verified, so the result is a subset of the
    exact join, and a pair is reported by the first table that finds it.

Crowded keys
    A grid cell or a bucket may hold very many vectors.  Sizes are counted first; a key
    above ``CROWD`` is cut into parts on both sides, and every pair of parts is joined by itself.

Distances are Euclidean and strictly less than the radius.  Vectors that are null or hold
a null or NaN component have no distance to anything and give no pairs.
"""

from __future__ import annotations

import itertools
import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import squared_distance
from tessera.operators.products import _stored

#: Offsets up to which shifting a vector is cheaper than a grid.
LATTICE_OFFSETS = 2_000
#: Coordinates of the grid: 3^4 = 81 adjacent cells.
GRID_COORDINATES = 4
#: Vectors of one key that are joined as they stand; larger keys are cut into parts of about so many.
CROWD = 1 << 12
#: Ids of one chunk; a pair of chunks expands to at most its square.
CHUNK_IDS = 1_000


def lattice_offsets(dim: int, radius: float, most: int | None = None) -> list[list[int]] | None:
    """All integer vectors d in Z^dim with |d|^2 < radius^2; None if there are more than ``most``."""
    if radius <= 0 or dim <= 0:
        raise ValueError(f"radius and dim must be positive, got radius={radius}, dim={dim}")
    limit, top = radius * radius, int(math.floor(radius))
    partial: list[tuple[tuple[int, ...], int]] = [((), 0)]
    for _ in range(dim):
        partial = [((*d, v), used + v * v) for d, used in partial for v in range(-top, top + 1) if used + v * v < limit]
        if most is not None and len(partial) > most:
            return None
    return [list(d) for d, _ in partial]


def _constant(rows: list[list[int]]) -> Column:
    """A list of int lists as one constant (a folded JSON literal), not one expression node per value."""
    return F.from_json(F.lit(json.dumps(rows, separators=(",", ":"))), "array<array<int>>")


def canonical(vec: str | Column) -> Column:
    """The vector as array<double> with -0.0 as 0.0, null if it is null or holds a null or NaN."""
    c = vec if isinstance(vec, Column) else F.col(vec)
    v = F.transform(c, lambda x: x.cast("double") + F.lit(0.0))
    return F.when(F.forall(v, lambda x: F.coalesce(~F.isnan(x), F.lit(False))), v)


def _vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(_id, _vec) of the rows that take part."""
    return df.select(F.col(id_col).alias("_id"), canonical(vec_col).alias("_vec")).filter("_vec IS NOT NULL")


def _profile(vecs: DataFrame) -> tuple[int, bool]:
    """Largest dimension and whether all components are whole numbers that shift exactly (one scalar action)."""
    odd = F.exists("_vec", lambda x: (x != F.rint(x)) | (F.abs(x) > F.lit(2.0**52)))
    r = vecs.agg(F.max(F.size("_vec")).alias("dim"), F.max(odd).alias("odd")).first()
    return int(r["dim"] or 0), not r["odd"]


def _grid_coordinates(vecs: DataFrame, dim: int, radius: float) -> list[int]:
    """The coordinates with the most cells (one row of counts)."""
    cells = [F.approx_count_distinct(F.floor(F.get(F.col("_vec"), i) / F.lit(float(radius)))).alias(str(i)) for i in range(dim)]
    r = vecs.agg(*cells).first()
    return sorted(sorted(range(dim), key=lambda i: (-r[str(i)], i))[:GRID_COORDINATES])


def vector_pairs(left: DataFrame, right: DataFrame, radius: float, integral: bool | None = None, dim: int | None = None) -> DataFrame:
    """Distinct (left_vec, right_vec, distance) with distance < radius, from (_vec) columns.

    Only distinct vectors take part, so the cost grows with the number of
    distinct profiles, not with the number of ids.  Vectors of different length
    are no pair.
    """
    if radius <= 0:
        raise ValueError(f"radius must be positive, got {radius}")
    lv = left.select(F.col("_vec").alias("left_vec")).distinct()
    rv = right.select(F.col("_vec").alias("right_vec")).distinct()
    if integral is None or dim is None:
        profile = _profile(left.select("_vec").unionByName(right.select("_vec")))
        dim = profile[0] if dim is None else dim
        integral = profile[1] if integral is None else integral
    far = F.sqrt(squared_distance("left_vec", "right_vec")).alias("distance")
    offsets = lattice_offsets(dim, radius, LATTICE_OFFSETS) if integral and dim else None
    if offsets is not None:
        shift = F.zip_with("left_vec", "_off", lambda a, b: a + b)
        moved = lv.select("left_vec", F.explode(_constant(offsets)).alias("_off")).filter(F.size("left_vec") == dim)
        pairs = moved.select("left_vec", shift.alias("right_vec")).join(rv, "right_vec")
        return pairs.select("left_vec", "right_vec", far).filter(F.col("distance") < radius)
    where = _grid_coordinates(right, dim, radius)
    cell = lambda v: F.array(*[F.floor(F.get(F.col(v), i) / F.lit(float(radius))).cast("long") for i in where])
    around = _constant([list(o) for o in itertools.product((-1, 0, 1), repeat=len(where))])
    # A component shorter than a grid coordinate has a null cell and can match nothing there.
    lcell = lv.select("left_vec", cell("left_vec").alias("_c"), F.explode(around).alias("_off")).select("left_vec", F.zip_with("_c", "_off", lambda a, b: a + b).alias("_cell"))
    rcell = rv.select("right_vec", cell("right_vec").alias("_cell"))
    pairs = _crowded_join(lcell, rcell, "_cell", "left_vec", "right_vec").filter(F.size("left_vec") == F.size("right_vec"))
    return pairs.select("left_vec", "right_vec", far).filter(F.col("distance") < radius)


def _crowded_join(left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str, crowd: int = CROWD) -> DataFrame:
    """Inner join on ``key`` of rows told apart by ``left_id`` and ``right_id``, no part of which takes more than about
    ``crowd`` rows of either side."""
    n_left = left.groupBy(key).agg(F.count(F.lit(1)).alias("_nl"))
    n_right = right.groupBy(key).agg(F.count(F.lit(1)).alias("_nr"))
    sizes = n_left.join(n_right, key).filter(F.greatest("_nl", "_nr") > crowd)
    parts = sizes.select(key, F.ceil(F.col("_nl") / crowd).cast("long").alias("_pl"), F.ceil(F.col("_nr") / crowd).cast("long").alias("_pr"))
    if not parts.limit(1).count():
        return left.join(right, key)
    one = F.lit(1).cast("long")

    def cut(side: DataFrame, ident: str, own: str, other: str, own_no: str, other_no: str) -> DataFrame:
        split = side.join(parts, key, "left").withColumns({own: F.coalesce(own, one), other: F.coalesce(other, one)})
        split = split.withColumn(own_no, F.pmod(F.xxhash64(ident), F.col(own)))
        return split.withColumn(other_no, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))).drop(own, other)

    return cut(left, left_id, "_pl", "_pr", "_l", "_r").join(cut(right, right_id, "_pr", "_pl", "_r", "_l"), [key, "_l", "_r"]).drop("_l", "_r")


def _chunks(vecs: DataFrame, side: str, chunk_ids: int) -> DataFrame:
    """(side_vec, side_chunk, side_ids): the distinct ids of a vector in chunks of bounded size."""
    ids = vecs.select("_vec", "_id").distinct()
    size = ids.groupBy("_vec").agg(F.ceil(F.count(F.lit(1)) / chunk_ids).alias("_chunks"))
    cut = ids.join(size, "_vec").withColumn("_chunk", F.pmod(F.xxhash64("_id"), F.col("_chunks")))
    packed = cut.groupBy("_vec", "_chunk").agg(F.collect_list("_id").alias("_ids"))
    return packed.select(F.col("_vec").alias(f"{side}_vec"), F.col("_chunk").alias(f"{side}_chunk"), F.col("_ids").alias(f"{side}_ids"))


def _expanded(pairs: DataFrame, lvecs: DataFrame, rvecs: DataFrame, left_name: str, right_name: str, chunk_ids: int = CHUNK_IDS, digits: int | None = None) -> DataFrame:
    """Vector pairs -> id pairs, dealt out by pair of chunks before anything is expanded.

    With ``digits`` the distance is rounded here, once a pair of vectors and not once a pair of ids."""
    if digits is not None:
        pairs = pairs.withColumn("distance", F.round("distance", digits))
    chunked = pairs.join(_chunks(lvecs, "left", chunk_ids), "left_vec").join(_chunks(rvecs, "right", chunk_ids), "right_vec")
    n = chunked.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = chunked.repartition(int(n), "left_vec", "left_chunk", "right_vec", "right_chunk")
    return dealt.select(F.explode("left_ids").alias(left_name), "right_ids", "distance").select(left_name, F.explode("right_ids").alias(right_name), "distance")


def class_pairs(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    id_col: str = "item_id",
    vec_col: str = "features",
    find=vector_pairs,
    **how,
) -> DataFrame:
    """(left_vec, right_vec, distance, n_pairs): the pairs of vectors that a radius join finds and how many pairs of ids each stands for.

    ``find`` is ``vector_pairs`` or ``approximate_vector_pairs``, ``how`` its parameters.  The ids of a vector are its
    class; a join's rows are the products of classes, so sums over ``n_pairs`` are sums over all of its rows."""
    lvecs, rvecs = _vectors(left, id_col, vec_col), _vectors(right, id_col, vec_col)
    sized = lambda vecs, side: vecs.distinct().groupBy(F.col("_vec").alias(f"{side}_vec")).agg(F.count("_id").alias(f"_n_{side}"))
    pairs = find(lvecs, rvecs, radius, **how).join(sized(lvecs, "left"), "left_vec").join(sized(rvecs, "right"), "right_vec")
    return pairs.select("left_vec", "right_vec", "distance", (F.col("_n_left") * F.col("_n_right")).alias("n_pairs"))


def class_join(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    id_col: str = "item_id",
    vec_col: str = "features",
    left_name: str = "left",
    right_name: str = "right",
    find=vector_pairs,
    **how,
) -> DataFrame:
    """A radius join with copies folded: (kind, id, class_id, other_class, distance, n_links).

    The distinct ids of one vector on one side are a class, named after its smallest id.
    ``kind`` ``link``: a pair of classes within the radius, ``id`` and ``class_id`` the left one, ``other_class`` the
    right one, ``n_links`` the pairs of ids that it stands for.  ``kind`` ``left_name`` or ``right_name``: an id of that side
    with its class, distance 0 to it, and in ``n_links`` how many ids of the other side lie within the radius.  Every pair of the join
    is a member of a link's left class with a member of its right one, so nothing is lost, and rows grow with ids and
    pairs of distinct vectors.  Ids whose vector is null or holds a null or NaN component have no row.  An id with several vectors has a row
    for each; a class whose ids are all null has a null name.  ``find`` and ``how``: as in ``class_pairs``.
    """
    sides = [_vectors(df, id_col, vec_col) for df in (left, right)]
    named = [v.distinct().groupBy("_vec").agg(F.min("_id").alias("_name"), F.count(F.lit(1)).alias("_n")) for v in sides]
    lc, rc = [n.select(*[F.col(c).alias(f"{side}{c}") for c in ("_vec", "_name", "_n")]) for n, side in zip(named, ("left", "right"))]
    # Pairs of vectors are far fewer than rows and are read three times.
    pairs = _stored(find(*sides, radius, **how).join(lc, "left_vec").join(rc, "right_vec"), "class-pairs")
    none = F.lit(None).cast(left.schema[id_col].dataType)
    links = pairs.select(F.lit("link").alias("kind"), F.col("left_name").alias("id"), F.col("left_name").alias("class_id"), F.col("right_name").alias("other_class"), "distance", (F.col("left_n") * F.col("right_n")).alias("n_links"))
    out = links
    for kind, vecs, names, own, other in ((left_name, sides[0], named[0], "left", "right"), (right_name, sides[1], named[1], "right", "left")):
        sums = pairs.groupBy(F.col(f"{own}_vec").alias("_vec")).agg(F.sum(f"{other}_n").alias("n_links"))
        label = names.join(sums, "_vec", "left").select("_vec", "_name", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
        member = vecs.distinct().join(label, "_vec")
        out = out.unionByName(member.select(F.lit(kind).alias("kind"), F.col("_id").alias("id"), F.col("_name").alias("class_id"), none.alias("other_class"), F.lit(0.0).alias("distance"), "n_links"))
    return out


def exact_radius_join(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    id_col: str = "item_id",
    vec_col: str = "features",
    left_name: str = "left_id",
    right_name: str = "right_id",
    integral: bool | None = None,
    dim: int | None = None,
    digits: int | None = None,
) -> DataFrame:
    """All (left_id, right_id, distance) with Euclidean distance < radius.

    Inputs may repeat ids (one row per rating): pairs are returned once.  ``digits`` rounds the distance.
    ``integral`` / ``dim`` save the pass that finds out whether every component
    is a whole number and how long the vectors are; ``integral=False`` is always right.
    """
    lvecs, rvecs = _vectors(left, id_col, vec_col), _vectors(right, id_col, vec_col)
    return _expanded(vector_pairs(lvecs, rvecs, radius, integral, dim), lvecs, rvecs, left_name, right_name, digits=digits)


def approximate_radius_join(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    id_col: str = "item_id",
    vec_col: str = "features",
    left_name: str = "left_id",
    right_name: str = "right_id",
    bucket_length: float = 2.0,
    num_hash_tables: int = 3,
    seed: int = 1,
    probes: int = 1,
    digits: int | None = None,
) -> DataFrame:
    """LSH radius join (M8), on distinct vectors, expanded to ids; parameters as in ``approximate_vector_pairs``, ``digits`` rounds the distance."""
    lvecs, rvecs = _vectors(left, id_col, vec_col), _vectors(right, id_col, vec_col)
    pairs = approximate_vector_pairs(lvecs, rvecs, radius, bucket_length, num_hash_tables, seed, probes)
    return _expanded(pairs, lvecs, rvecs, left_name, right_name, digits=digits)


#: Projections that make one key.
PROJECTIONS = 2


def approximate_vector_pairs(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    bucket_length: float = 2.0,
    num_hash_tables: int = 3,
    seed: int = 1,
    probes: int = 1,
    projections: int = PROJECTIONS,
    crowd: int = CROWD,
) -> DataFrame:
    """As ``vector_pairs``, found by random projections (M8).

    Each of ``num_hash_tables`` tables keys a vector by the buckets (of ``bucket_length``) of ``projections`` random unit
    directions; a left vector probes up to ``probes`` buckets to either side on each.  A projection never lengthens
    a distance: where probes x bucket_length reaches the radius, one table finds every pair and no other is built.
    Vectors of other than the largest length take no part.
    """
    lv, rv = left.select(F.col("_vec").alias("left_vec")).distinct(), right.select(F.col("_vec").alias("right_vec")).distinct()
    dim, _ = _profile(left.select("_vec").unionByName(right.select("_vec")))
    tables = 1 if probes * bucket_length >= radius else num_hash_tables
    directions = np.random.default_rng(seed).standard_normal((tables * projections, max(1, dim)))
    directions /= np.linalg.norm(directions, axis=1, keepdims=True)
    plane = F.from_json(F.lit(json.dumps(directions.tolist())), "array<array<double>>")

    def buckets(vec: str) -> Column:
        dot = lambda d: F.aggregate(F.zip_with(d, F.col(vec), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        return F.transform(plane, lambda d: F.floor(dot(d) / F.lit(float(bucket_length))).cast("long"))

    around = _constant([list(o) for o in itertools.product(range(-probes, probes + 1), repeat=projections)])
    number = F.explode(F.sequence(F.lit(0), F.lit(tables - 1)))
    own = F.slice(F.col("_h"), F.col("_t") * projections + 1, projections)
    rkeys = rv.filter(F.size("right_vec") == dim).select("right_vec", buckets("right_vec").alias("_hr")).withColumn("_t", number)
    rkeys = rkeys.withColumnRenamed("_hr", "_h").select("right_vec", F.col("_h").alias("_hr"), F.struct("_t", own.alias("b")).alias("_key"))
    lkeys = lv.filter(F.size("left_vec") == dim).select("left_vec", buckets("left_vec").alias("_h")).withColumn("_t", number)
    lkeys = lkeys.select("left_vec", F.col("_h").alias("_hl"), "_t", own.alias("_b"), F.explode(around).alias("_o"))
    lkeys = lkeys.select("left_vec", "_hl", F.struct("_t", F.zip_with("_b", "_o", lambda a, b: a + b).alias("b")).alias("_key"))
    met = _crowded_join(lkeys, rkeys, "_key", "left_vec", "right_vec", crowd)
    near = F.zip_with("_hl", "_hr", lambda a, b: F.abs(a - b) <= probes)
    earlier = F.lit(False)
    for t in range(tables - 1):
        earlier = earlier | ((F.col("_key._t") > t) & F.forall(F.slice(near, t * projections + 1, projections), lambda x: x))
    far = F.sqrt(squared_distance("left_vec", "right_vec")).alias("distance")
    return met.filter(~earlier).select("left_vec", "right_vec", far).filter(F.col("distance") < radius)


def neighbor_counts(pairs: DataFrame, left_name: str = "left_id") -> DataFrame:
    """Neighbours per left id of an existing pair table (A5)."""
    return pairs.groupBy(left_name).agg(F.count(F.lit(1)).alias("n_neighbors"))


def count_neighbors(
    left: DataFrame,
    right: DataFrame,
    radius: float,
    id_col: str = "item_id",
    vec_col: str = "features",
    left_name: str = "left_id",
    integral: bool | None = None,
    dim: int | None = None,
) -> DataFrame:
    """Neighbours per left id without listing a pair of ids (A5).

    Right ids are counted per distinct vector, the counts are summed over a
    left vector's matches, and every left id takes the sum of its vector.  Left ids
    without a neighbour have no row, as in the pair table.
    """
    lvecs, rvecs = _vectors(left, id_col, vec_col), _vectors(right, id_col, vec_col)
    sizes = rvecs.distinct().groupBy(F.col("_vec").alias("right_vec")).agg(F.count(F.lit(1)).alias("_n"))
    sums = vector_pairs(lvecs, rvecs, radius, integral, dim).join(sizes, "right_vec").groupBy("left_vec").agg(F.sum("_n").alias("_n"))
    ids = lvecs.distinct().select(F.col("_id").alias(left_name), F.col("_vec").alias("left_vec"))
    # An id that occurs with several vectors sums them, as its pairs would.
    return ids.join(sums, "left_vec").groupBy(left_name).agg(F.sum("_n").alias("n_neighbors"))


def neighbor_count_extremes(counts: DataFrame) -> DataFrame:
    """Smallest and largest neighbour count in one pass."""
    return counts.agg(F.min("n_neighbors").alias("min_count"), F.max("n_neighbors").alias("max_count"))
