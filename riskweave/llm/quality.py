"""Quality selection by importance resampling (operator 2).

Two bag-of-n-grams models over ``BUCKETS`` hash buckets (unigrams and bigrams of
words and punctuation runs), one of target text (documents labelled as good) and
one of the raw corpus, give every document a log importance weight

    log w = sum over its n-grams of log p_target - log p_raw.

Sampling k documents without replacement in proportion to w is taking the k
largest of log w + Gumbel noise (Xie et al., "Data Selection for Language Models
via Importance Resampling", 2023). The noise is a hash of the id, the text and
the number of the copy among rows that repeat both, so reruns agree and equal
rows are drawn one by one. By default k is the labelled share of good documents times the corpus.

Raw counts cover all documents; they are added up per task and then by bucket.
The target model counts every document labelled as good. The cut at rank k is found from histograms of fixed size
that narrow down on it, so nothing is sorted as a whole.

Edge cases: null and empty texts have log weight 0; without labelled good
documents all log weights are 0 and everything is selected; rows without an id
take part, with the noise of their text; of equal keys the smaller doc_id goes
first (null last); an empty table gives an empty result. Extra columns are not
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, Tokens, chunks, column, constants, mix, numbered_copies

BUCKETS = 1 << 14
#: Added to each bucket's count.
SMOOTHING = 1.0
#: Cells of a histogram, and rows of the boundary cell that are ranked one by one.
CELLS = 4096
BOUNDARY_ROWS = 50000


def ngram_buckets(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and document of every unigram and bigram."""
    h = t.hashes(9)
    docs = t.doc_of_word()
    pair = mix(h[:-1] * constants(61, 1)[0] + h[1:])[docs[1:] == docs[:-1]] if len(h) else h
    whose = docs[:-1][docs[1:] == docs[:-1]] if len(h) else docs
    grams = np.concatenate((h, pair))
    return (grams % np.uint64(BUCKETS)).astype(np.int64), np.concatenate((docs, whose))


def _count(batches):
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for b in chunks(batches):
        buckets, docs = ngram_buckets(Tokens(column(b, "text"), punctuation=True))
        good = column(b, "good").to_numpy(zero_copy_only=False).astype(bool)
        raw += np.bincount(buckets, minlength=BUCKETS)
        target += np.bincount(buckets[good[docs]], minlength=BUCKETS)
    held = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(raw[held].astype(np.int64)),
                                      pa.array(target[held].astype(np.int64))], names=["bucket", "raw", "target"])


def log_ratios(docs: DataFrame, good_ids: DataFrame) -> np.ndarray:
    """log p_target - log p_raw of each bucket; all of ``good_ids`` count."""
    named = good_ids.select(F.col("doc_id").alias("_good")).distinct()
    flagged = (docs.select("doc_id", "text").where("doc_id IS NOT NULL")
               .join(named.hint("merge"), F.col("doc_id") == F.col("_good"), "left")
               .select("text", F.col("_good").isNotNull().alias("good"))
               .unionByName(docs.where("doc_id IS NULL").select("text", F.lit(False).alias("good"))))
    counts = (flagged.mapInArrow(_count, "bucket long, raw long, target long")
              .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect())
    raw, target = np.full(BUCKETS, SMOOTHING), np.full(BUCKETS, SMOOTHING)
    for r in counts:
        raw[r.bucket] += r.raw
        target[r.bucket] += r.target
    if target.sum() <= SMOOTHING * BUCKETS:
        return np.zeros(BUCKETS)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def _weigh(ratio: np.ndarray):
    def run(batches):
        for b in chunks(batches):
            t = Tokens(column(b, "text"), punctuation=True)
            buckets, docs = ngram_buckets(t)
            weight = np.bincount(docs, weights=ratio[buckets], minlength=t.n_docs)
            yield pa.RecordBatch.from_arrays(
                [column(b, "doc_id").cast(pa.int64()), column(b, "text_key"), pa.array(weight, pa.float64())],
                names=["doc_id", "text_key", "log_weight"])
    return run


def gumbel(doc_id, text_key, copy) -> F.Column:
    """Standard Gumbel noise from a hash of the row."""
    name = F.concat_ws(":", F.lit("gumbel"), F.coalesce(doc_id.cast("string"), F.lit("")),
                       F.hex(text_key), copy.cast("string"))
    u = (F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double")
         + 0.5) / F.lit(float(1 << 52))
    return -F.log(-F.log(u))


def _boundary(scored: DataFrame, k: int) -> tuple[float, float, int]:
    """(low, high, above): the k-th largest key lies in [low, high], and
    ``above`` rows have a key over ``high``."""
    low, high = scored.agg(F.min("key"), F.max("key")).first()
    above = 0
    while low < high:
        width = (high - low) / CELLS
        cell = F.least(F.floor((F.col("key") - F.lit(low)) / F.lit(width)), F.lit(CELLS - 1))
        found = sorted(((r.cell, r.n, r.least, r.most) for r in
                        scored.where(F.col("key").between(F.lit(low), F.lit(high)))
                        .groupBy(cell.alias("cell"))
                        .agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("least"), F.max("key").alias("most"))
                        .collect()), reverse=True)
        for _, n, least, most in found:
            if above + n >= k:
                low, high = least, most
                break
            above += n
        if n <= BOUNDARY_ROWS:
            break
    return low, high, above


def resample(spark: SparkSession, docs: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """One row per document: doc_id, log_weight, key (log weight plus noise) and
    whether it is among the k that the sample takes."""
    scratch = Scratch(spark, "quality")
    named = (labels.select("doc_id", "quality").where("doc_id IS NOT NULL AND quality IS NOT NULL")
             .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    good_share, = named.agg(F.avg((F.col("quality") == 1).cast("double"))).first()
    good = named.where("quality = 1").select("doc_id")
    ratio = log_ratios(docs, good)
    text_key = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    groups = scratch.table(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_key.alias("text_key"))
        .mapInArrow(_weigh(ratio), "doc_id long, text_key binary, log_weight double")
        .groupBy("doc_id", "text_key", "log_weight").agg(F.count(F.lit(1)).alias("rows")), "groups")
    scored = scratch.table(
        numbered_copies(groups, "rows", "copy")
        .select("doc_id", "log_weight", (F.col("log_weight") + gumbel(F.col("doc_id"), F.col("text_key"), F.col("copy")))
                .alias("key")), "scored")
    if k is None:
        k = round((good_share or 1.0) * scored.count())
    if scored.isEmpty() or k <= 0:
        return scored.withColumn("selected", F.lit(False))
    low, high, above = _boundary(scored, k)
    inside = F.col("key").between(F.lit(low), F.lit(high))
    edge = (scored.where(inside)
            .withColumn("place", F.row_number().over(W.orderBy(F.col("key").desc(), F.col("doc_id").asc_nulls_last())))
            .withColumn("selected", F.col("place") <= F.lit(k - above)).drop("place"))
    return scored.where(~inside).withColumn("selected", F.col("key") > F.lit(high)).unionByName(edge)
