"""SimHash near-duplicates by multi-index hashing.

Fingerprints of 64 bits are cut into two segments of 32 bits.  If two
fingerprints differ in at most 2 bits, then the first segments differ in at
most 1 bit or the second segments are equal; so one small Hamming ball (33 keys)
in the first segment and the exact key in the second find every link.  Table
matches are verified on all 64 bits.

Work runs on distinct fingerprints, so a group of exact copies is one entry.
A table bucket may still hold very many different fingerprints (a large group of
near copies shares a segment).  Buckets above ``bucket`` entries are not joined
against themselves: every fingerprint that owns or probes such a bucket emits
the 65 points of its own one-bit ball, and fingerprints that share a point are
linked in a star.  Two fingerprints share a point exactly if they differ in at
most 2 bits, so no link is lost and no pairs are listed.

Keys that very many fingerprints own are few (``HEAVY``); they and the keys in
their balls are broadcast, and what meets at such a key is dealt over ``SALTS`` tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tessera.llm.common import text_or_empty, written
from tessera.llm.graph import components, join_by_key

SEED = 42
MAX_BITS = 2
#: Entries of one table bucket that are matched one by one; larger buckets take the star way.
BUCKET = 64
#: A key is heavy if more than this share of all fingerprints (and at least HEAVY_FLOOR) own it: at most
#: 2 x HEAVY keys are, and at most 2 x 33 x HEAVY lie in their balls.  Any other key has at most
#: 33 / HEAVY of all probes.
HEAVY, HEAVY_FLOOR = 2048, 256
#: Tasks over which the probes of a heavy ball's key are dealt.
SALTS = 32
#: Shingle hashes whose bits are counted at a time: bounds memory for very long texts.
BLOCK = 1 << 15


def fingerprint(text: str | None, width: int = 3, seed: int = SEED) -> int:
    """Majority bits of the XXH64 of all word shingles, as an unsigned integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    n = len(words) - width + 1
    if n <= 1:
        return digest(line, seed)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    start = np.concatenate(([0], np.cumsum(size)))
    first, last = start[:n].tolist(), (start[width:] - 1).tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        stop = min(n, at + BLOCK)
        h = np.fromiter((digest(line[a:b], seed) for a, b in zip(first[at:stop], last[at:stop])), np.uint64, stop - at)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (counts * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint_column(col, width: int = 3, seed: int = SEED):
    """The fingerprint as a (signed) long column."""

    @pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width, seed) for t in texts], np.uint64).view(np.int64))

    return fp(col)


def links(fps: DataFrame, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """Distinct fingerprints (fp long) -> links (a, b) whose transitive closure holds
    every pair at most ``max_bits`` bits apart; each link itself is such a pair, or (in
    crowded buckets) a fingerprint and the smallest one that shares a ball point with it."""
    if max_bits != 2:
        raise ValueError("the segments and balls here are laid out for 2 bits")
    high = F.shiftrightunsigned(F.col("fp"), 32)
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    owned = fps.select("fp", F.explode(F.array(F.struct(F.lit(0).alias("seg"), high.alias("key")), F.struct(F.lit(1).alias("seg"), low.alias("key")))).alias("s")).select("fp", "s.seg", "s.key")
    ball = F.transform(F.array(F.lit(0), *[F.lit(1 << i) for i in range(32)]), lambda m: F.struct(F.lit(0).alias("seg"), high.bitwiseXOR(m.cast("long")).alias("key")))
    probes = fps.select("fp", F.explode(F.concat(ball, F.array(F.struct(F.lit(1).alias("seg"), low.alias("key"))))).alias("s")).select("fp", "s.seg", "s.key")

    # Few keys are crowded; what follows reads their written table, so that no plan counts keys again.
    big = written(owned.groupBy("seg", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket), "simhash-crowded")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))

    def matches(probes: DataFrame, entries: DataFrame, on: list[str]) -> DataFrame:
        met = probes.withColumnRenamed("fp", "a").join(entries.withColumnRenamed("fp", "b"), on)
        return met.filter((F.col("a") != F.col("b")) & (apart <= max_bits)).select("a", "b")

    def ordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    if not big.limit(1).count():
        return ordered(matches(probes, owned, ["seg", "key"]))
    heavy = big.filter(F.col("n") > max(HEAVY_FLOOR, bucket, fps.count() // HEAVY)).select("seg", "key")
    near = F.when(F.col("seg") == 0, F.transform(F.array(F.lit(0), *[F.lit(1 << i) for i in range(32)]), lambda m: F.col("key").bitwiseXOR(m.cast("long")))).otherwise(F.array("key"))
    hot = written(heavy.select("seg", F.explode(near).alias("key")).distinct().withColumn("salts", F.lit(SALTS)), "simhash-hot")

    def dealt(side: DataFrame, salt) -> DataFrame:
        return side.join(F.broadcast(hot), ["seg", "key"], "left").withColumn("salt", salt(F.coalesce("salts", F.lit(1)))).drop("salts")

    def everywhere(salts):
        return F.explode(F.sequence(F.lit(0), salts - 1))

    probes = dealt(probes, lambda salts: F.pmod(F.xxhash64("fp"), salts).cast("int"))
    crowded = dealt(big.select("seg", "key"), everywhere)
    light = owned.join(F.broadcast(heavy), ["seg", "key"], "left_anti")
    thin = dealt(light.join(big.select("seg", "key"), ["seg", "key"], "left_anti"), everywhere)
    meet = ["seg", "key", "salt"]
    matched = matches(probes, thin, meet)

    touching = written(probes.join(crowded, meet, "left_semi").select("fp").distinct(), "simhash-touching")
    points = F.transform(F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64) if i == 63 else 1 << i).cast("long") for i in range(64)]), lambda m: F.col("fp").bitwiseXOR(m))
    around = touching.select("fp", F.explode(points).alias("z"))
    hub = around.groupBy("z").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("z", "b")
    stars = around.withColumnRenamed("fp", "a").join(hub, "z").filter("a != b").select("a", "b")
    return ordered(matched.unionByName(stars))


def near_duplicates(rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, fp) rows -> (rows with component_id, nothing dropped).

    ``component_id`` is the smallest non-null id among all rows that are reachable
    over links; it is null only if every id of the component is null.
    """
    fps = written(rows.groupBy("fp").agg(F.min(id_col).alias("first_id"), F.count(F.lit(1)).alias("n")), "simhash-fps")
    edges = written(links(fps.select("fp")), "simhash-links")
    label = components(edges)
    grouped = written(label.join(fps, label["node"] == fps["fp"]).select("fp", "component", "first_id"), "simhash-grouped")
    smallest = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    linked = join_by_key(grouped.select("fp", "component"), smallest, "component", grouped.count()).select("fp", "component_id")
    all_fps = fps.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id"), "n")
    return join_by_key(rows, all_fps, "fp", rows.count())


def simhash_dedup(docs: DataFrame, width: int = 3) -> DataFrame:
    """documents -> one row a document: doc_id, fingerprint (16 hex digits), component_id.

    Null texts count as empty; empty texts have fingerprint zero and are linked like any
    other.  Texts with fewer words than ``width`` hash their whole word sequence.  Repeated
    rows come back as often as they stand.  Empty input gives no rows.
    """
    rows = written(docs.select("doc_id", fingerprint_column(text_or_empty(), width).alias("fp")), "simhash-rows")
    out = near_duplicates(rows)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = 3) -> DataFrame:
    """One document of each component: that with the smallest doc_id (null last), first in
    row order among repeated ids.  Columns are those of ``docs``."""
    from tessera.llm.common import free_name

    cols = docs.columns
    rid = free_name(cols, "row_no")
    fp = free_name([*cols, rid], "fp")
    whole = written(docs.withColumn(rid, F.monotonically_increasing_id()).withColumn(fp, fingerprint_column(text_or_empty(), width)), "simhash-docs", "zstd")
    rows = whole.select(F.col(rid).alias("rid"), "doc_id", F.col(fp).alias("fp"))
    fps = written(rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("rid"))).alias("first_id")), "simhash-first")
    label = components(written(links(fps.select("fp")), "simhash-links"))
    named = fps.join(label, fps["fp"] == label["node"], "left").select(F.coalesce("component", "fp").alias("component"), "first_id")
    kept = named.groupBy("component").agg(F.min("first_id").alias("f")).select(F.col("f.rid").alias(rid))
    return whole.join(kept, rid, "left_semi").select(*[F.col(f"`{c}`") for c in cols])
