"""Read semi-structured files and seeds."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEED_DIR = Path(__file__).resolve().parent.parent / "seeds"

BAND_SCHEMA = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("min_kg", T.IntegerType()),
        T.StructField("max_kg", T.IntegerType()),
    ]
)
CURATED_SCHEMA = T.StructType(
    [T.StructField("tag", T.StringType()), T.StructField("sort_order", T.IntegerType())]
)


def read_json(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """JSON with an inferred schema, which takes a pass over all files before the first row. ``multiline``
    is for array files, one task per file."""
    return spark.read.json(path, multiLine=multiline)


def read_variants(spark: SparkSession, path: str, column: str = "doc") -> DataFrame:
    """JSON lines as one variant column: files split at any size, and no schema is inferred or asked for.
    Types are those of each value (``variant_fields`` sums them up); a line that is no JSON is an error."""
    return spark.read.option("singleVariantColumn", column).option("mode", "FAILFAST").json(path)


def read_documents(spark: SparkSession, path: str, array_files: bool = False) -> DataFrame:
    """One row per record with the record's own text in ``payload``.

    Records come as JSON lines, which split at any size. ``array_files`` is for payloads that arrive as
    many small files, each one JSON array: a file is one cell of one task, so it has to be far below
    2 GB and only their number spreads the work. Its elements keep their key order, re-written without
    spaces.
    """
    if not array_files:
        lines = spark.read.text(path).withColumnRenamed("value", "payload")
        return lines.where(F.trim("payload") != "")
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", "array<string>", {"mode": "FAILFAST"})).alias("payload"))


def describe(df: DataFrame) -> DataFrame:
    """The schema as rows (position, column_name, column_type)."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, column_type string")


def infer_json_fields(df: DataFrame, column: str) -> DataFrame:
    """The top-level fields of a JSON text column with the type that holds all their values."""
    return variant_fields(df.select(F.try_parse_json(F.col(column)).alias(column)), column)


def variant_fields(df: DataFrame, column: str = "doc") -> DataFrame:
    """The top-level fields of the objects in a variant column with the type that holds all their values."""
    doc = F.col(column)
    view = df.select(F.when(F.schema_of_variant(doc).startswith("OBJECT"), doc).alias("doc"))
    fields = view.lateralJoin(view.sparkSession.tvf.variant_explode(F.col("doc").outer()))
    return fields.groupBy(F.col("key").alias("column_name")).agg(
        F.schema_of_variant_agg("value").alias("column_type"), F.count(F.lit(1)).alias("n_rows")
    )


def read_seed(spark: SparkSession, path: str, schema: T.StructType, order_by: str | None = None) -> DataFrame:
    """A typed CSV with a header; ordered when it is read for display."""
    seed = spark.read.csv(path, schema=schema, header=True, mode="FAILFAST")
    return seed.orderBy(F.col(order_by).asc_nulls_last()) if order_by else seed


def packaged_seed(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """A seed that ships with the package. Its few lines are read where the program runs, because
    the executors of a cluster do not see the package's folder; Spark parses and types them."""
    lines = (SEED_DIR / name).read_text(encoding="utf-8").splitlines()
    rows = spark.createDataFrame([(line,) for line in lines[1:]], "line string")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    return rows.select(F.from_csv("line", ddl, {"mode": "FAILFAST"}).alias("row")).select("row.*")


def size_bands(spark: SparkSession) -> DataFrame:
    return packaged_seed(spark, "size_bands.csv", BAND_SCHEMA)


def curated_tags(spark: SparkSession) -> DataFrame:
    return packaged_seed(spark, "curated_tags.csv", CURATED_SCHEMA)
