"""Mixing sources to target weights.

Every document gets a hash-random key.  Inside a source the documents stand in
key order; a document is taken while the running total of words stays inside
the source's budget, after as many full passes ("epochs") as the budget holds.

The order is cut into key ranges (by leading hex digits of the key, so many that there
are about as many ranges as rows in one).  Key ranges of a uniform hash are even, so this is a
range partitioning that needs no sampling and that every rerun repeats.  The
running total is distributed: totals per (source, range), offsets over those
few rows, then a window inside each range.  A source with a third of all rows
is spread over all its ranges.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, free_name, text_or_empty, written

#: Weights by position of the source in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Copies of one row that a task expands at a time.
COPIES = 10_000


def word_count(col: str = "text"):
    return F.regexp_count(text_or_empty(col), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, share: float, max_epochs: float, weights=WEIGHTS) -> DataFrame:
    """(source, source_size) -> (source, source_size, target), water filling.

    Targets are proportional to the weights and stop at ``max_epochs`` times
    the source's size; what lies above is shared again by weight.  The final
    level is found directly: sources in the order of cap / weight are capped
    as long as the level over the remaining weight lies above theirs.
    One row a source, so these windows see metadata only.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    base = sizes.withColumn("w", w).withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
    ratio = F.col("cap") / F.col("w")
    asc = Window.orderBy(ratio.asc(), F.col("source").asc_nulls_last())
    upto = asc.rowsBetween(Window.unboundedPreceding, -1)
    rest = asc.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    total = F.lit(float(share)) * F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))) / F.sum("w").over(rest)
    found = (
        base.withColumn("ratio", ratio)
        .withColumn("level", level)
        .withColumn("final", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything))
    )
    target = F.when(F.col("final").isNull() | (F.col("ratio") < F.col("final.ratio")), F.col("cap")).otherwise(F.least("cap", F.col("w") * F.col("final.level")))
    return found.select("source", "source_size", target.alias("target"))


def _place(groups: DataFrame, share: float, max_epochs: int, weights, seed: int, digits: int | None) -> DataFrame:
    """(source, id, size, n) groups of equal rows -> with source_size, target, epochs and ``reach``:
    the words of its source's remaining budget that begin with this group (below 0: none)."""
    if digits is None:  # as many ranges as rows in one: both windows then see about sqrt(rows) at most
        digits = math.ceil(math.log(max(groups.count(), 1), 16) / 2)
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    keyed = groups.withColumn("key", key).withColumn("range", F.substring("key", 1, digits) if digits else F.lit(""))
    words = F.col("size") * F.col("n")
    targets = source_targets(groups.groupBy("source").agg(F.sum(words).alias("source_size")), share, max_epochs, weights)
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    in_range = keyed.groupBy("source", "range").agg(F.sum(words).alias("range_size"))
    offsets = in_range.select("source", "range", F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("offset"))
    plan = offsets.alias("o").join(targets.alias("t"), F.expr("o.source <=> t.source")).select("o.source", "range", "offset", "source_size", "target")
    inside = Window.partitionBy("source", "range").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("before", F.coalesce(F.sum(words).over(inside), F.lit(0)))
    joined = placed.alias("g").join(plan.alias("p"), F.expr("g.source <=> p.source AND g.range = p.range"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    reach = F.floor("target").cast("long") - epochs * F.col("source_size") - F.col("offset") - F.col("before")
    return joined.select("g.*", "source_size", "target", epochs.alias("epochs"), reach.alias("reach"))


def _numbered(groups: DataFrame, first: str, count: str, out: str) -> DataFrame:
    """One row for every number from ``first`` to before ``count``, in chunks: a group with very many
    rows is dealt to many tasks before it is expanded."""
    chunk = F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / COPIES).cast("long"))
    rows = groups.filter(F.col(count) > F.col(first)).withColumn("chunk__", F.explode(chunk))
    if groups.filter(F.col(count) > COPIES).limit(1).count():
        rows = rows.repartition(F.col("key"), F.col("chunk__"))
    low = F.greatest(F.col(first), F.col("chunk__") * COPIES)
    high = F.least(F.col(count), (F.col("chunk__") + 1) * COPIES) - 1
    return rows.filter(low <= high).withColumn(out, F.explode(F.sequence(low, high))).drop("chunk__")


def mix(
    items: DataFrame,
    share: float = 1.5,
    max_epochs: int = 2,
    weights=WEIGHTS,
    seed: int = 7,
    digits: int | None = None,
) -> DataFrame:
    """(doc_id, source, size) -> the same rows with source_size, target and taken.

    ``taken`` counts the words that the mix takes from a row, repeats included:
    ``epochs * size`` plus what the remaining budget reaches into it, so the
    words taken of a source are exactly ``floor(target)``.

    Nulls: a null source is a source of its own, last in order; a null size
    counts 0; rows with a null doc_id take part under one common key.  Repeated
    rows are collapsed with their number before anything is shuffled and
    expanded at the end.  Empty input gives no rows.  Columns besides the three
    are ignored.
    """
    rows = items.select(F.col("doc_id").alias("id"), F.col("source"), F.coalesce(F.col("size").cast("long"), F.lit(0)).alias("size"))
    groups = written(rows.groupBy("source", "id", "size").agg(F.count(F.lit(1)).alias("n")), "mix-groups")
    placed = _place(groups, share, max_epochs, weights, seed, digits).withColumn("none", F.lit(0).cast("long"))
    copies = _numbered(placed, "none", "n", "copy")
    left = F.col("reach") - F.col("copy") * F.col("size")
    taken = F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(left, F.col("size")))
    return copies.select(F.col("id").alias("doc_id"), "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, share: float = 1.5, max_epochs: int = 2, weights=WEIGHTS, seed: int = 7, digits: int | None = None) -> DataFrame:
    """Documents repeated as the mix takes them, with the columns of ``docs``.

    A document taken ``e`` times whole stands in the result ``e`` times.  The one
    document per source that the budget cuts is kept up to that word (its words
    joined by single spaces) and its ``n_chars`` is set anew.  Documents without
    words hold no budget and are left out.  Rows equal in every column are one group,
    so the same documents give the same result whatever order they are stored in.
    """
    cols = docs.columns
    taken: list[str] = list(cols)
    rid, size, ident = [taken.append(n) or n for n in (free_name(taken, "row_no"), free_name(taken, "n_words"), free_name(taken, "row_hash"))]
    every = [F.col(f"`{c}`") for c in cols]
    hashed = F.concat(F.hex(F.xxhash64(*every)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), *every)))
    whole = written(docs.withColumns({rid: F.monotonically_increasing_id(), size: word_count(), ident: hashed}), "mix-docs", "zstd")
    groups = whole.select("source", F.col(ident).alias("id"), F.col(size).alias("size"), F.col(rid).alias("rid")).filter("size > 0")
    groups = written(groups.groupBy("source", "id", "size").agg(F.count(F.lit(1)).alias("n"), F.min("rid").alias("rid")), "mix-groups")
    placed = _place(groups, share, max_epochs, weights, seed, digits)
    reach = F.greatest(F.lit(0), F.least(F.col("reach"), F.col("size") * F.col("n")))
    extra = F.floor(reach / F.col("size")).cast("long")
    part = (reach % F.col("size")).cast("int")
    takes = placed.select(F.col("rid").alias("rid__"), F.col("key"), (F.col("epochs") * F.col("n") + extra).alias("full__"), part.alias("part__"))
    takes = takes.filter("full__ > 0 OR part__ > 0").withColumn("rows__", F.col("full__") + (F.col("part__") > 0).cast("long"))
    # Names of the plan first, so that no column of docs can clash with them.
    body = whole.select(F.col(rid).alias("rid__"), F.struct(*every).alias("doc__"))
    rows = _numbered(takes.join(body, "rid__").withColumn("none__", F.lit(0).cast("long")), "none__", "rows__", "copy__")
    text = F.col("doc__.text")
    cut = F.when(F.col("copy__") == F.col("full__"), F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), F.greatest("part__", F.lit(1))), " "))
    out = []
    for c in cols:
        value = F.col("doc__").getField(c)
        if c == "text":
            value = F.coalesce(cut, text)
        elif c == "n_chars":
            value = F.when(F.col("copy__") == F.col("full__"), F.length(cut).cast(docs.schema[c].dataType)).otherwise(value)
        out.append(value.alias(c))
    return rows.select(*out)
