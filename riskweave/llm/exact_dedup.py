"""Exact deduplication against a persistent digest index (operator 4).

The index is a table of one row per distinct text, bucketed and sorted by the
digest. A batch is ingested in two parts, longer texts first, so that of equal
texts the one with the most code points is in the index before the shorter ones
are looked up. Each part is reduced to one winner per digest, winners that the
index already has (of an earlier batch or of the first part) are found by a
sort-merge anti join that does not shuffle the index, and the rest is appended
as new bucket files. Only DataFrame functions are used.

Entries carry the batch that made them, and a batch ignores its own entries and
appends only what is missing: a batch that failed half-way, or whose result was
lost, is ingested again under the same name with the same result. A name stands
for fixed rows; another name is another batch.

Edge cases: a null text counts as empty; empty texts are equal to one another;
of equal texts the one with the most code points stays, then the smallest
doc_id (null last), then one arbitrary but fixed row of fully repeated rows; an
empty table gives an empty result; columns other than doc_id and text are not
read, so clashing names do no harm.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, Scratch, spare_name

#: Buckets of the index: files that later batches merge-join without a shuffle.
INDEX_BUCKETS = 64


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest and code points of each row, with a row number that is
    fixed once the frame is written."""
    return docs.select(
        "doc_id", F.unhex(digest(F.col("text"))).alias("digest"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("points"),
        F.monotonically_increasing_id().alias("row"))


def winners(rows: DataFrame) -> DataFrame:
    """One row per digest: partial aggregation runs before the shuffle, so a
    digest that a third of all rows share moves one row per task."""
    rank = F.struct(F.col("points"), (-F.col("doc_id")).alias("neg_id"), (-F.col("row")).alias("neg_row"))
    best = rows.groupBy("digest").agg(F.max(rank).alias("best"), F.count(F.lit(1)).alias("group_size"))
    return best.select("digest", (-F.col("best.neg_id")).alias("keep_id"),
                       (-F.col("best.neg_row")).alias("keep_row"), "group_size")


class DigestIndex:
    """A bucketed, sorted table of known digests under ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = INDEX_BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.name = "digest_index_" + hashlib.sha256(self.path.encode()).hexdigest()[:40]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} "
                  f"(digest BINARY, keep_id BIGINT, batch STRING, part INT) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'")

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def before(self, batch: str, part: int = 0) -> DataFrame:
        """Entries that a part of a batch meets: other batches' and those of
        its own earlier parts."""
        return self.table().where((F.col("batch") != batch) | (F.col("part") < part))

    def unknown(self, candidates: DataFrame, batch: str, part: int = 0) -> DataFrame:
        """Candidates whose digest the index lacks; the index side is read
        bucket by bucket, only the candidates are shuffled."""
        return candidates.join(self.before(batch, part).select("digest").hint("merge"), "digest", "left_anti")

    def append(self, new: DataFrame, batch: str, part: int = 0) -> None:
        """Add entries, but for those that an earlier run of the batch left."""
        left = self.table().where((F.col("batch") == batch) & (F.col("part") == part))
        (new.select("digest", "keep_id").join(left.select("digest").hint("merge"), "digest", "left_anti")
            .withColumn("batch", F.lit(batch)).withColumn("part", F.lit(part))
            .repartition(self.buckets, "digest")
            .write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
            .option("path", self.path).saveAsTable(self.name))

    def close(self) -> None:
        """Forget the catalog entry; the files stay for a later session."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def parts(rows: DataFrame) -> list[DataFrame]:
    """The rows of mean length or more, then the shorter ones. The mean is
    exact, so a repeated batch has the same parts."""
    total, n = rows.agg(F.coalesce(F.sum("points"), F.lit(0)), F.count(F.lit(1))).first()
    mean = total // max(n, 1)
    return [rows.where(F.col("points") >= mean), rows.where(F.col("points") < mean)]


def ingest(spark: SparkSession, docs: DataFrame, index_path: str | None = None, batch: str | None = None,
           scratch: Scratch | None = None) -> DataFrame:
    """Deduplicate ``docs`` within themselves and against the index, append
    what is new, and return one row per input row: doc_id, keep_id, group_size
    (rows of this batch), kept, text_sha256, points. Rows whose text an earlier
    batch had are not kept and name that batch's document. ``batch`` names these
    rows for a repeated run; without it they are a batch of their own. The
    result reads tables of ``scratch``, which also holds an index without a path."""
    scratch = scratch or Scratch(spark, "exact-dedup")
    index = DigestIndex(spark, index_path or scratch.path("index"))
    batch = batch or uuid.uuid4().hex
    rows = scratch.table(digests(docs), "digests")
    best, fresh = [], []
    for k, part in enumerate(parts(rows)):
        best.append(scratch.table(winners(part), f"winners-{k}"))
        fresh.append(scratch.table(index.unknown(best[k], batch, k), f"fresh-{k}"))
        index.append(fresh[k], batch, k)
    sizes = scratch.table(best[0].unionByName(best[1]).groupBy("digest")
                          .agg(F.sum("group_size").alias("group_size")), "sizes")
    # A digest is fresh in one part at most; the others are earlier batches'.
    new = fresh[0].unionByName(fresh[1]).select("digest", "keep_id", "keep_row")
    known = (index.before(batch).select("digest", "keep_id").hint("merge")
             .join(sizes.select("digest"), "digest").withColumn("keep_row", F.lit(None).cast("long")))
    decided = scratch.table(sizes.join(new.unionByName(known).hint("merge"), "digest"), "decided")
    index.close()
    scratch.drop("winners-0", "winners-1", "fresh-0", "fresh-1", "sizes")
    # Both sides are plain files here, so AQE may split a digest with very many rows.
    return (rows.join(decided, "digest")
            .select("doc_id", "keep_id", "group_size",
                    F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256"), "points"))


def drop_copies(spark: SparkSession, docs: DataFrame, index_path: str | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, all columns, one row of each text.

    A kept decision names (doc_id, digest, points); rows that agree in all
    three are copies of one another, and only such repeated rows are compared
    further.
    """
    scratch, ingested = Scratch(spark, "exact-dedup-keep"), Scratch(spark, "exact-dedup")
    made = ingest(spark, docs, index_path, scratch=ingested)
    doc, sha, points, copies = (spare_name(docs, "_kept_" + c) for c in ("doc", "sha", "points", "copies"))
    length = F.length(F.coalesce("text", F.lit("")))
    kept = scratch.table(
        made.groupBy(F.col("doc_id").alias(doc), F.col("text_sha256").alias(sha), F.col("points").alias(points))
        .agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias(copies)).where("kept").drop("kept"), "kept")
    ingested.clear()  # with it an index that no later batch can name

    def of(ids: DataFrame) -> DataFrame:
        return docs.join(ids.hint("merge"), F.col("doc_id").eqNullSafe(F.col(doc))
                         & (digest(F.col("text")) == F.col(sha)) & (length == F.col(points)), "left_semi")

    several = kept.where(F.col(copies) > 1)
    if several.isEmpty():
        return of(kept)
    repeated = (of(several).withColumn(points, length).withColumn(sha, digest(F.col("text")))
                .dropDuplicates(["doc_id", sha, points]).drop(sha, points))
    return of(kept.where(F.col(copies) == 1)).unionByName(repeated)
