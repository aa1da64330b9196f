"""SimHash fingerprints of 128 bits and a search within a Hamming radius. Native.

The terms of a text are its five-word shingles (A-Z lower-cased; fewer words are one term),
weighted by how often they occur. Each term's two 64-bit hashes vote on 128 bits. Votes are
counted two bits to a long, 32 bits each, while shingles stream by; nothing is collected.

Search: fingerprints are cut into so many blocks that two within the radius differ in at most
``SPARE`` bits on one block at least, so a table of fingerprints for each block, asked for the
block and all that differ in so few bits, holds every partner.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlane.session import materialize, slice_count

SHINGLE = 5
BITS = 128
LANE = 0x0000000100000001
# Bits in which two texts with a Jaccard similarity of 0.8 may differ: 19 on average, and a margin.
RADIUS = 23
# Bits in which a block may differ from the one that is asked for.
SPARE = 2


def terms(text: Column) -> Column:
    """Array of structs of five word hashes, one for each shingle."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.array_remove(F.split(lowered, r"[\x20\x09-\x0D]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _shingles(hashes: Column) -> Column:
    """Five arrays, each a word further on, side by side; short texts are filled up with zeros."""
    missing = F.greatest(F.lit(0), F.lit(SHINGLE) - F.size(hashes))
    filled = F.when(F.size(hashes) > 0, F.concat(hashes, F.array_repeat(F.lit(0).cast("long"), missing)))
    count = F.size(filled) - (SHINGLE - 1)
    return F.arrays_zip(*[F.slice(filled, k + 1, count).alias(f"w{k}") for k in range(SHINGLE)])


def fingerprints(rows: DataFrame, keys: list[str], text_column: str) -> DataFrame:
    """(keys, high, low): the two halves of each row's fingerprint; texts without words get zeros.

    ``keys`` must tell the rows apart. If ``rows`` are already partitioned by some of the
    keys, no further shuffle is needed.
    """
    exploded = (rows.select(*keys, terms(F.col(text_column)).alias("hashes"))
                .select(*keys, F.inline_outer(_shingles(F.col("hashes")))))
    words = [F.col(f"w{k}") for k in range(SHINGLE)]
    hashed = exploded.select(*keys, F.when(F.col("w0").isNotNull(), F.xxhash64(*words)).alias("h"))
    both = hashed.select(*keys, "h", F.when(F.col("h").isNotNull(), F.xxhash64(F.col("h"), F.lit(1))).alias("g"))
    votes = [F.sum(F.shiftrightunsigned(F.col(c), i).bitwiseAND(F.lit(LANE))).alias(f"{c}{i}")
             for c in ("h", "g") for i in range(32)]
    counted = both.groupBy(*keys).agg(F.count("h").alias("n"), *votes)
    return counted.select(*keys, _signed("h").alias("high"), _signed("g").alias("low"))


def _signed(name: str) -> Column:
    """Bits for which more than half of the weight voted."""
    value = F.lit(0).cast("long")
    for i in range(32):
        ones = F.coalesce(F.col(f"{name}{i}"), F.lit(0))
        for bit, count in ((i, ones.bitwiseAND(F.lit(0xFFFFFFFF))), (i + 32, F.shiftrightunsigned(ones, 32))):
            mask = (1 << bit) - (1 << 64 if bit == 63 else 0)
            value = value.bitwiseOR(F.when(count * 2 > F.col("n"), F.lit(mask).cast("long")).otherwise(F.lit(0).cast("long")))
    return value


def distance(high: Column, low: Column, other_high: Column, other_low: Column) -> Column:
    """Bits in which two fingerprints differ."""
    return F.bit_count(high.bitwiseXOR(other_high)) + F.bit_count(low.bitwiseXOR(other_low))


def likeness(bits: Column) -> Column:
    """Cosine of the angle that so many different bits stand for, 0 at least."""
    return F.greatest(F.lit(0.0), F.cos(bits * F.lit(math.pi / BITS)))


def written(high: Column, low: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def with_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (slice, place, guest, doc_id, text, next_text) in ascending order of integer ids.

    Documents are dealt to slices by cut points of the ids, and each slice gets the first
    document of the next one as a guest, so that no order over the whole table is needed;
    the last document is followed by the first. Null ids come last; rows with one id are
    ordered by their text. Only cut points and the first ids of the slices reach the driver.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    slices = slice_count(docs.sparkSession)
    found = rows.agg(F.percentile_approx("doc_id", [k / slices for k in range(1, slices)] or [0.5], 100 * slices)).first()[0]
    cuts = sorted(set(found or []))
    dealt = rows.withColumn("slice", _place(F.col("doc_id"), cuts))
    firsts = [tuple(r) for r in dealt.groupBy("slice").agg(F.min("doc_id"), F.count("*")).orderBy("slice").collect()]
    guest_of = [(firsts[k - 1][0], first) for k, (_, first, _) in enumerate(firsts)]
    # One row per slice; broadcast, as slices are few by definition.
    named = docs.sparkSession.createDataFrame(guest_of, "host int, first long")
    guests = (rows.join(F.broadcast(named), F.col("doc_id").eqNullSafe(F.col("first")))
              .groupBy("host", "first").agg(F.min("text").alias("text"))
              .select(F.col("first").alias("doc_id"), "text", F.col("host").alias("slice")))
    everything = dealt.withColumn("guest", F.lit(0)).unionByName(guests.withColumn("guest", F.lit(1)))
    order = Window.partitionBy("slice").orderBy("guest", F.col("doc_id").asc_nulls_last(), "text")
    return everything.select("slice", "guest", "doc_id", "text", F.row_number().over(order).alias("place"),
                             F.lead("text").over(order).alias("next_text"))


def _place(value: Column, cuts: list[int]) -> Column:
    """How many cut points lie at or below the value, by halving; null goes to the last slice."""
    if not cuts:
        return F.lit(0)
    depth = len(cuts).bit_length()
    table = F.array(*[F.lit(c).cast("long") for c in cuts])

    def step(at: Column, width: Column) -> Column:
        probe = at + width
        return F.when((probe <= len(cuts)) & (F.try_element_at(table, probe) <= value), probe).otherwise(at)

    steps = F.array(*[F.lit(1 << k) for k in reversed(range(depth))])
    return F.when(value.isNull(), F.lit(len(cuts))).otherwise(F.aggregate(steps, F.lit(0), step))


def edited(text: Column, following: Column) -> Column:
    """The last floor(n / 2) code points replaced by the first as many of the next text."""
    size = F.length(text)
    half = F.floor(size / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), size - half), F.substring(following, F.lit(1), half))


def fingerprint_rows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(slice, place, doc_id, n_chars, edited_sha256, high, low, edited_high, edited_low,
    next_high, next_low), one row per document; null texts are empty, extra columns are left out."""
    rows = with_next(docs, id_column, text_column)
    changed = edited(F.col("text"), F.col("next_text"))
    both = F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("body")),
                   F.struct(F.lit(1).alias("kind"), changed.alias("body")))
    kinds = F.when(F.col("guest") == 1, F.slice(both, 1, 1)).otherwise(both)
    keys = ["slice", "place", "guest", "doc_id", "kind", "n_chars", "sha"]
    split = (rows.select("slice", "place", "guest", "doc_id", F.length("text").alias("n_chars"), F.inline(kinds))
             .withColumn("sha", F.when(F.col("kind") == 1, F.sha2(F.col("body"), 256)).otherwise("")))
    printed = fingerprints(split, keys, "body")
    pick = lambda c, k: F.max(F.when(F.col("kind") == k, F.col(c)))
    joined = printed.groupBy("slice", "guest", "place", "doc_id", "n_chars").agg(
        pick("sha", 1).alias("edited_sha256"), pick("high", 0).alias("high"), pick("low", 0).alias("low"),
        pick("high", 1).alias("edited_high"), pick("low", 1).alias("edited_low"))
    order = Window.partitionBy("slice").orderBy("guest", "place")
    return (joined.withColumn("next_high", F.lead("high").over(order)).withColumn("next_low", F.lead("low").over(order))
            .filter("guest = 0").drop("guest"))


def within_radius(prints: DataFrame, queries: DataFrame, radius: int = 3) -> DataFrame:
    """(high, low, near_high, near_low, bits, doc_id, docs): all pairs of a distinct query
    fingerprint and a distinct fingerprint of ``prints`` within the radius, and their distance.

    Both have columns high and low, ``prints`` doc_id too; equal fingerprints are one class before
    they are joined, with its least doc_id and its number of rows. Blocks take up to ``SPARE``
    different bits: of ``radius // (SPARE + 1) + 1`` blocks one has no more than that in each
    pair, so a query asks each table for its block and all blocks that near. Nothing within the
    radius is missed. A pair that meets in several tables counts at the first of them.
    """
    spare = min(SPARE, radius // 4)
    blocks = radius // (spare + 1) + 1
    # The bits (high before low) are cut into blocks of nearly equal width; none crosses the halves.
    per_half = max(2, -(-blocks // 2))
    edges = [64 * k // per_half for k in range(per_half + 1)]
    parts = [(half, at, end - at) for half in (0, 1) for at, end in zip(edges, edges[1:])]

    def block(k: int, high: str, low: str) -> Column:
        half, at, width = parts[k]
        return F.shiftrightunsigned(F.col(low if half else high), at).bitwiseAND(F.lit((1 << width) - 1))

    def table(high: str, low: str) -> Column:
        return F.inline(F.array(*[F.struct(F.lit(k).alias("table"), block(k, high, low).alias("block"))
                                  for k in range(len(parts))]))

    def asked_blocks(high: str, low: str) -> Column:
        """The blocks of a fingerprint with up to ``spare`` bits turned over."""
        lists = []
        for k, (_, _, width) in enumerate(parts):
            turned = [sum(1 << b for b in chosen) for n in range(spare + 1) for chosen in combinations(range(width), n)]
            masks = F.split(F.lit(",".join(map(str, turned))), ",").cast("array<bigint>")
            own = F.transform(masks, block(k, high, low).bitwiseXOR)
            lists.append(F.struct(F.lit(k).alias("table"), own.alias("asked")))
        return F.inline(F.array(*lists))

    index = (prints.groupBy("high", "low").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("docs"))
             .select(F.col("high").alias("near_high"), F.col("low").alias("near_low"), "doc_id", "docs",
                     table("high", "low")))
    asked = (queries.select("high", "low").distinct().select("high", "low", asked_blocks("high", "low"))
             .select("high", "low", "table", F.explode("asked").alias("block")))
    # Spark takes the exploded side for as small as the queries; both sides are dealt out instead.
    met = asked.hint("merge").join(index, ["table", "block"])
    bits = distance(F.col("high"), F.col("low"), F.col("near_high"), F.col("near_low"))
    first = F.lit(True)
    for k in range(len(parts)):
        apart = F.bit_count(block(k, "high", "low").bitwiseXOR(block(k, "near_high", "near_low")))
        first = first & ((F.col("table") <= k) | (apart > spare))
    return met.filter((bits <= radius) & first).select(
        "high", "low", "near_high", "near_low", bits.cast("int").alias("bits"), "doc_id", "docs")


def report(docs: DataFrame, radius: int = 3, every: int = 100) -> DataFrame:
    """Fingerprints and likenesses of all documents; for those whose id is divisible by ``every``
    also the partners within the radius, as (bits, doc_id, docs) for each distinct fingerprint, and
    how many documents these are, the document itself included in both."""
    rows = materialize(fingerprint_rows(docs), "fingerprints")
    asked = rows.filter(F.col("doc_id") % every == 0)
    pairs = within_radius(rows.select("doc_id", "high", "low"), asked.select("high", "low"), radius)
    found = pairs.groupBy("high", "low").agg(
        F.sum("docs").alias("n_near"), F.sort_array(F.collect_list(F.struct("bits", "doc_id", "docs"))).alias("partners"))
    others = rows.filter((F.col("doc_id") % every != 0) | F.col("doc_id").isNull())
    part = asked.join(found, ["high", "low"], "left").unionByName(others, allowMissingColumns=True)
    here = (F.col("high"), F.col("low"))
    return part.select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", written(*here).alias("fingerprint"),
        written(F.col("edited_high"), F.col("edited_low")).alias("edited_fingerprint"),
        likeness(distance(*here, F.col("edited_high"), F.col("edited_low"))).alias("near_edited"),
        likeness(distance(*here, F.col("next_high"), F.col("next_low"))).alias("near_next"), "n_near", "partners")
