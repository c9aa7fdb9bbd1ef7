"""Parquet / CSV sources and the Parquet sink (operators A1–A3)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..scratch import delete_path, replace_path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A2: Parquet scan; filters and projections are pushed into it by Catalyst."""
    return spark.read.parquet(path)


def load_tables(spark: SparkSession, sf_dir: str,
                names: tuple[str, ...] = ("region", "nation", "customer", "part",
                                          "orders", "lineitem")) -> dict[str, DataFrame]:
    return {n: read_table(spark, f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def read_raw_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A1: CSV with header; malformed values become NULL (PERMISSIVE).

    A declared schema avoids the extra inference pass over the input and makes
    column types independent of the data. Without one, types are inferred as
    the reference does.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_checked_csv(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """A1 with quarantine: the rows of a CSV that fit the declared schema, and
    the rejects as (raw_line, file). A line is rejected if a value cannot be read
    as its column's type or if it has more or fewer values than the header.

    All columns are parsed for both outputs, whatever a query selects: pruned
    columns would hide their malformed values."""
    from pyspark.sql.types import StringType
    from pyspark.sql.types import StructType as Struct

    fields = Struct.fromDDL(schema) if isinstance(schema, str) else schema
    corrupt = "_corrupt_record"
    while corrupt in fields.names:
        corrupt += "_"
    rows = (spark.read.option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", corrupt)
            .schema(Struct([*fields.fields, StructField(corrupt, StringType())])).csv(path)
            .withColumn(f"{corrupt}file", F.input_file_name()))
    # always true, and needs every column: what a query does not need is not parsed
    rows = rows.where(F.concat_ws("", *[F.col(f"`{n}`").cast("string") for n in fields.names]) >= "")
    good = rows.where(F.col(corrupt).isNull()).select(*[F.col(f"`{n}`") for n in fields.names])
    bad = rows.where(F.col(corrupt).isNotNull()).select(F.col(corrupt).alias("raw_line"),
                                                        F.col(f"{corrupt}file").alias("file"))
    return good, bad


def write_result(df: DataFrame, base: str, name: str) -> str:
    """A3: one Parquet directory per result, replaced when the new one is
    complete. The rows go to a staging folder beside it (hidden from readers of
    the base folder); a job that fails leaves the old result as it was."""
    spark = df.sparkSession
    path = f"{base.rstrip('/')}/{name}"
    staging = f"{base.rstrip('/')}/_staging-{uuid.uuid4().hex[:12]}"
    try:
        df.write.parquet(staging)
        replace_path(spark, staging, path)
    except BaseException:
        delete_path(spark, staging)
        raise
    return path


def write_csv(df: DataFrame, path: str, compression: str = "none", file_rows: int = 0) -> str:
    """CSV with header, values written verbatim (Spark's CSV writer trims
    surrounding whitespace by default; raw input must keep it). A compressed
    file cannot be split when it is read, so ``file_rows`` bounds its rows
    (0: no bound); every file has the header."""
    (df.write.mode("overwrite").option("header", True)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .option("compression", compression).option("maxRecordsPerFile", file_rows)
       .csv(path))
    return path


def register_fact(df: DataFrame, name: str = "supply_chain") -> DataFrame:
    """A4: expose the (processed) fact to ``spark.sql`` users as a temp view."""
    df.createOrReplaceTempView(name)
    return df
