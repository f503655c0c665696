"""Mixing sources to target weights by capped water-filling.

Every source gets words in proportion to its weight until it reaches ``max_epochs`` times
its own size; what it cannot take is shared again among the others by weight. With sources
sorted by ``cap / weight`` the capped ones come first, so one pass of running sums over the
per-source totals finds the level, in exact integers.

A source that must give ``r`` times its size repeats all documents ``floor(r)`` times. The
fraction that is left takes documents in the order of a seeded digest until it is used up, so
a source misses its target by less than half of its document at the edge, and reruns agree.
Digest order is cut into ranges (``bits`` leading bits) that are summed on their own first: a
source that holds most rows is never ordered in one task.

Only the per-source totals (one row per source) and the range totals of one source (at most
``2 ** bits`` rows) meet in a window. Null texts have size 0; a null source is a source of its
own and comes last; rows with size 0 are kept and take 0 words; repeated rows count as often as
they occur; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusml.functions.text import digest_bits
from corpusml.llm.common import WORD
from corpusml.storage import materialize

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3


def size_in_words(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` out of ``(source, source_size)``.

    Weights repeat over the sources in code-point order, null last. All sources together share
    the sum of all sizes.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pattern = F.array(*[F.lit(w) for w in weights])
    ranked = sizes.withColumn("_w", F.get(pattern, (F.row_number().over(by_name) - 1) % len(weights)).cast("decimal(38,0)"))
    ranked = ranked.withColumn("_cap", (F.col("source_size") * max_epochs).cast("decimal(38,0)"))
    by_need = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    after = by_need.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    filled = (
        ranked.withColumn("_left", F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_shares", F.sum("_w").over(after))
        .withColumn("_capped", F.col("_cap") * F.col("_shares") <= F.col("_w") * F.col("_left"))
    )
    # Those that reach their cap are a prefix; the rest share what the prefix leaves.
    open_left = F.sum("source_size").over(everything) - F.sum(F.when(F.col("_capped"), F.col("_cap")).otherwise(0)).over(everything)
    open_shares = F.sum(F.when(F.col("_capped"), 0).otherwise(F.col("_w"))).over(everything)
    share = (F.col("_w") * open_left).cast("double") / open_shares.cast("double")
    target = F.when(F.col("_capped"), F.col("_cap").cast("double")).otherwise(share)
    return filled.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, idx: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0,
        weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, bits: int = 16) -> DataFrame:
    """``(doc_id, source, text_hash, size, source_size, target, copies, taken)``: one row for each row of ``docs``."""
    digest = digest_bits(F.concat_ws(":", F.lit(str(seed)), F.col(idx).cast("string")))
    rows = docs.select(F.col(idx).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(text).alias("text_hash"), size_in_words(text).alias("size"), digest.alias("_digest"))
    rows = materialize(rows.withColumn("_range", F.shiftright("_digest", 32 - bits)), "mix-sizes")
    ranges = rows.groupBy("source", "_range").agg(F.sum("size").alias("_sum"))
    plan = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    running = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        F.col("source").alias("_source"), F.col("_range").alias("_r"), F.coalesce(F.sum("_sum").over(running), F.lit(0)).alias("_start")
    ).join(plan, F.col("_source").eqNullSafe(plan.source)).drop("source")
    inside = Window.partitionBy("source", "_range").orderBy("_digest", "doc_id", "size")
    before = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = rows.withColumn("_before", before).join(starts, rows.source.eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_r")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.col("target") - F.col("_whole") * F.col("source_size")
    extra = (2 * (F.col("_start") + F.col("_before")) + F.col("size")).cast("double") <= 2 * rest
    copies = F.col("_whole") + F.when(extra & (F.col("size") > 0), 1).otherwise(0)
    mixed = joined.withColumn("_whole", whole).withColumn("copies", copies.cast("long"))
    return mixed.select("doc_id", "source", "text_hash", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


#: The same rows in DuckDB; takes the documents as ``{docs}``.
SQL = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         substr(md5('0:' || doc_id), 1, 8) AS digest
  FROM {docs}),
sizes AS (
  SELECT source, sum(size)::HUGEINT AS source_size,
         1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS w
  FROM docs GROUP BY source),
running AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS everything,
         sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
         sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS shares
  FROM sizes WINDOW o AS (ORDER BY 3 * source_size / w, source ASC NULLS LAST)),
capped AS (SELECT *, cap * shares <= w * left_over AS is_capped FROM running),
targets AS (
  SELECT source, source_size,
         CASE WHEN is_capped THEN cap::DOUBLE
              ELSE (w * (everything - coalesce(sum(cap) FILTER (is_capped) OVER (), 0)))::DOUBLE
                   / (sum(w) FILTER (NOT is_capped) OVER ())::DOUBLE END AS target
  FROM capped),
ordered AS (
  SELECT docs.doc_id, docs.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size::DOUBLE) ELSE 0 END AS whole,
         coalesce(sum(docs.size) OVER (PARTITION BY docs.source ORDER BY digest, doc_id, docs.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs JOIN targets t ON docs.source IS NOT DISTINCT FROM t.source)
"""

OP_SQL = SQL.replace("{docs}", "documents") + """
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (size * (whole + CASE WHEN size > 0 AND (2 * before + size)::DOUBLE <= 2 * (target - whole * source_size::DOUBLE)
                             THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered"""
