"""Mixing sources to target weights (operator 3).

Every document gets a hash-random key; each source is cut into key ranges
("cells", about the square root of its rows, so a source with a third of the
corpus is spread over many tasks and no cell grows with the whole source).
Rows that agree in source, key, doc_id and size are one row with a count from the
start, so many equal rows without an id fill no cell; they are written out again
at the end. Prefix sums of word counts run inside the cells and over the cells'
totals, and the source is cut at its exact budget. A budget beyond the source's
size takes whole epochs first.

Edge cases: a null text has no words; null sources form one source, last; a
document without words takes nothing; a corpus without words has targets 0; an
empty table gives an empty result; of rows
that repeat the first ones are taken, and as they are alike reruns agree. Only doc_id, text and source are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, numbered_copies

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix against the words of the corpus.
SHARE = 1.5
#: Most epochs of a source.
MAX_EPOCHS = 2

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and the hash-random key (60 bits of an MD5; rows
    without an id are spread by their text)."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.coalesce("text", F.lit(""))))
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"),
                       F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long").alias("key"))


def targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Water-filling over one row per source: every source gets weight x level,
    at most its cap. Sources reach their cap in the order of cap / weight, so
    the level follows from running sums over that order."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("at") % len(weights) + 1).cast("int"))
    ranked = (totals.withColumn("at", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
              .withColumn("weight", weight)
              .withColumn("cap", F.col("source_size") * F.lit(float(max_epochs))))
    order = W.orderBy(F.col("cap") / F.col("weight"), "at")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    running = (ranked
               .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
               .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
               .withColumn("all_size", F.sum("source_size").over(everything))
               .withColumn("all_weight", F.sum("weight").over(everything)))
    level = ((F.col("all_size") * F.lit(float(share)) - F.col("cap_before"))
             / (F.col("all_weight") - F.col("weight_before")))
    levelled = running.withColumn("level", F.when(level * F.col("weight") <= F.col("cap"), level))
    found = F.first("level", ignorenulls=True).over(
        order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return (levelled.withColumn("found", found)
            .select("source", "source_rows", "source_size",
                    F.when(F.col("found").isNull(), F.col("cap"))
                    .otherwise(F.least(F.col("weight") * F.col("found"), F.col("cap"))).alias("target")))


def mix(spark: SparkSession, docs: DataFrame, weights=WEIGHTS, share: float = SHARE,
        max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, epochs
    (whole copies), part (words of one more, cut copy), taken."""
    scratch = Scratch(spark, "mixing")
    rows = scratch.table(sized(docs).groupBy("source", "key", "doc_id", "size").agg(F.count(F.lit(1)).alias("rows")), "sized")
    totals = rows.groupBy("source").agg(F.sum("rows").alias("source_rows"),
                                        F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    plan = scratch.table(targets(totals, weights, share, max_epochs), "targets")
    names = [F.col(c).alias("_t_" + c) for c in plan.columns]
    share_of = F.col("key") / F.lit(float(1 << 60))
    celled = (rows.join(plan.select(*names), F.col("source").eqNullSafe(F.col("_t_source")))
              .withColumn("n_cells", F.ceil(F.sqrt(F.col("_t_source_rows"))))
              .withColumn("cell", F.floor(share_of * F.col("n_cells")))
              .withColumn("words", F.col("size") * F.col("rows")))
    inside = W.partitionBy("source", "cell").orderBy("key", "doc_id", "size")
    local = scratch.table(celled.withColumn("upto", F.sum("words").over(inside.rowsBetween(W.unboundedPreceding, 0)))
                          .drop("n_cells", "key", "_t_source"), "local")
    cells = local.groupBy("source", "cell").agg(F.sum("words").alias("cell_size"))
    starts = cells.select(F.col("source").alias("_c_source"), F.col("cell").alias("_c_cell"),
                          (F.sum("cell_size").over(W.partitionBy("source").orderBy("cell"))
                           - F.col("cell_size")).alias("cell_start"))
    starts = scratch.table(starts, "starts")
    placed = local.join(starts, F.col("source").eqNullSafe(F.col("_c_source")) & (F.col("cell") == F.col("_c_cell")))
    budget = F.round("_t_target").cast("long")
    whole = F.when(F.col("_t_source_size") > 0, F.floor(budget / F.col("_t_source_size"))).otherwise(F.lit(0))
    cut = budget - whole * F.col("_t_source_size")
    groups = placed.select("doc_id", "source", "size", F.col("_t_source_size").alias("source_size"),
                           F.col("_t_target").alias("target"), whole.cast("long").alias("epochs"),
                           (cut - F.col("cell_start") - F.col("upto") + F.col("words")).alias("_left"), "rows")
    # what of the cut is left at the group, less what the row's earlier copies take
    part = F.least(F.greatest(F.col("_left") - F.col("_copy") * F.col("size"), F.lit(0)), F.col("size"))
    return (numbered_copies(groups, "rows", "_copy")
            .select("doc_id", "source", "size", "source_size", "target", "epochs", part.cast("long").alias("part"))
            .withColumn("taken", F.col("epochs") * F.col("size") + F.col("part")))
