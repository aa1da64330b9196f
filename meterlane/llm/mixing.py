"""Mixing sources to target weights by capped water-filling, with seeded repetitions.

Native: sizes, source totals, the water level and the running sums are DataFrame operations.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlane.llm.words import WORD_PATTERN
from meterlane.operators.ordered import row_number
from meterlane.session import materialize

EPOCHS = 3
SEED = "mix-1"
# Documents of a source that one task adds up in order.
BUCKET_DOCS = 500


def source_targets(sized: DataFrame, epochs: int = EPOCHS, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(key, source_size, docs, weight, target) from rows (key, source, size).

    Sources take the weights in turn, by code point, null last, and share the sum of all
    sizes. A source never gets more than ``epochs`` times its size; what exceeds that is
    shared by weight among the others until none is above. The level rises with each turn
    and stays when no further source is clamped, so there are at most as many turns as
    sources. Whole numbers decide, so every engine finds the same level.
    """
    totals = sized.groupBy("key", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    ranked = row_number(totals, [F.col("source").asc_nulls_last()], name="place")
    turn = F.array(*[F.lit(w) for w in weights])
    capped = materialize(ranked.select(
        "key", "source_size", "docs", F.element_at(turn, ((F.col("place") - 1) % len(weights) + 1).cast("int")).cast("long").alias("weight"),
        (F.col("source_size") * epochs).alias("cap")), "sources")
    everything, weight_sum = capped.agg(F.sum("source_size"), F.sum("weight")).first()
    rest, free = everything or 0, weight_sum or 0
    while free:
        clamped = _above(rest, free)
        taken, still = capped.agg(F.sum(F.when(clamped, F.col("cap")).otherwise(0)),
                                  F.sum(F.when(clamped, 0).otherwise(F.col("weight")))).first()
        if (everything - taken, still) == (rest, free):
            break
        rest, free = everything - taken, still
    share = F.when(_above(rest, free), F.col("cap").cast("double")).otherwise(
        (F.col("weight").cast("decimal(38,0)") * F.lit(rest).cast("decimal(38,0)")).cast("double") / F.lit(float(max(free, 1))))
    return capped.withColumn("target", share)


def _above(rest: int, free: int):
    """Whether a source's share of the rest reaches its cap."""
    if not free:
        return F.lit(True)
    wide = "decimal(38,0)"
    return F.col("weight").cast(wide) * F.lit(rest).cast(wide) >= F.col("cap").cast(wide) * F.lit(free).cast(wide)


def repetitions(docs: DataFrame, epochs: int = EPOCHS, weights: tuple[int, ...] = (1, 2, 3), seed: str = SEED,
                whole_documents: bool = False, id_column: str = "doc_id", text_column: str = "text",
                source_column: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row, and ``keep`` columns.

    ``size`` counts words. A source's documents are all taken as many whole times as fit
    its target. For the rest they are taken once more in a seeded order until the target is
    reached; the last of them is taken in part, or with ``whole_documents`` if at least half
    of it fits. Null texts have size 0 and take 0; a source of size 0 has target 0. Rows
    that repeat count each; equal rows may change places, which changes no result. Null
    ids are ordered first among equals. An empty table gives no rows.
    """
    size = F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    name = F.col(source_column).cast("string")
    sized = docs.select(
        F.col(id_column).alias("doc_id"), name.alias("source"), size.alias("size"),
        *([F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept")] if keep else []),
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("key"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))).alias("draw"))
    if not keep:
        sized = materialize(sized, "sizes")
    sources = source_targets(sized.select("key", "source", "size"), epochs, weights)
    rows = sources.agg(F.sum("docs")).first()[0] or 0
    digits = min(8, max(1, math.ceil(math.log(max(rows / BUCKET_DOCS, 1), 16))))
    bucket = F.substring("draw", 1, digits)
    per = sized.select("key", "size", bucket.alias("bucket")).groupBy("key", "bucket").agg(F.sum("size").alias("in_bucket"))
    # At most 16 ** digits rows per source, whatever its size.
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    quota = F.floor(F.col("target") + 0.5)
    placed = (per.withColumn("earlier", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)))
              .join(sources.select("key", "source_size", "target"), "key")
              .withColumn("times", F.coalesce(F.floor(quota / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)).cast("long"))
              .withColumn("extra", quota - F.col("times") * F.col("source_size"))
              .select("key", "bucket", "source_size", "target", "times", "extra", "earlier"))
    inside = (Window.partitionBy("key", "bucket").orderBy("draw", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    joined = sized.withColumn("bucket", bucket).join(placed, ["key", "bucket"])
    so_far = F.col("earlier") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    left = F.col("extra") - so_far
    part = F.when(2 * left >= F.col("size"), F.when(left > 0, F.col("size")).otherwise(0)).otherwise(0) if whole_documents \
        else F.greatest(F.lit(0), F.least(left, F.col("size")))
    return joined.select("doc_id", *(["kept.*"] if keep else []), "size", "source_size", "target",
                         (F.col("size") * F.col("times") + part).cast("long").alias("taken"))


#: The same for DuckDB over ``documents``, with the defaults.
SQL = f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
                  md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw FROM documents),
s AS (SELECT source, CAST(sum(size) AS HUGEINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, {EPOCHS} * source_size AS cap,
             CAST((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS HUGEINT) AS weight FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY cap / weight, weight) AS k FROM r),
p AS (SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS free FROM o),
c AS (SELECT *, weight * rest >= cap * free AS clamped FROM p),
l AS (SELECT min(rest) FILTER (NOT clamped) AS low, max(rest) FILTER (NOT clamped) AS rest,
             max(free) FILTER (NOT clamped) AS free FROM c),
t AS (SELECT c.source, c.source_size,
             CASE WHEN c.clamped THEN CAST(c.cap AS DOUBLE) ELSE CAST(c.weight * l.rest AS DOUBLE) / CAST(l.free AS DOUBLE) END AS target
      FROM c, l),
q AS (SELECT *, CAST(floor(target + 0.5) AS HUGEINT) AS quota FROM t),
e AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE quota // source_size END AS times FROM q)
SELECT d.doc_id, d.size, CAST(e.source_size AS BIGINT) AS source_size, e.target,
       CAST(d.size * e.times + greatest(0, least(d.size, e.quota - e.times * e.source_size - coalesce(
            sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.doc_id, d.size
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS BIGINT) AS taken
FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
"""
