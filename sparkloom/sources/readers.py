"""Readers for sheets, nested JSON, dictionaries and logs.  Schemas are given, never inferred over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import file_stem

BOM = "\ufeff"


def read_text_csv(spark: SparkSession, path: str, *, blanks: bool = True, schema: T.StructType | None = None) -> DataFrame:
    """A CSV file with a header, every column a string; line breaks in quotes, a byte-order mark and spaces around
    names are taken care of.  With ``blanks`` missing cells are '', else null.  A schema makes typed columns."""
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
    if schema is not None:
        return reader.schema(schema).option("mode", "FAILFAST").csv(path)
    df = reader.option("inferSchema", False).csv(path)
    df = df.toDF(*[c.strip().replace(BOM, "") for c in df.columns])
    return df.na.fill("") if blanks else df


def read_seeds(spark: SparkSession, path: str, *, row_id: str = "id", start: int = 0) -> DataFrame:
    """Crawl seeds from the given id on; ids are digits."""
    df = read_text_csv(spark, path)
    return df.where(F.col(row_id).try_cast("long") >= start)


def read_category_json(spark: SparkSession, path: str, schema: T.StructType, *, marker: str | None = "completion_rate") -> DataFrame:
    """JSON arrays, one file for each category; the file's stem becomes ``category``.  Header records that carry the
    marker field are left out."""
    wanted = schema if marker is None or marker in schema.names else T.StructType([*schema.fields, T.StructField(marker, T.StringType())])
    df = spark.read.schema(wanted).option("multiLine", True).json(path).withColumn("category", file_stem("_metadata.file_name"))
    return df if marker is None else df.where(F.col(marker).isNull()).drop(marker)


def read_nested_json(spark: SparkSession, path: str, schema: T.StructType, array: str) -> DataFrame:
    """One JSON object that holds an array of records: a row for each record."""
    return spark.read.schema(schema).option("multiLine", True).json(path).select(F.inline(array))


def read_dictionary_json(spark: SparkSession, path: str, value: str) -> DataFrame:
    """A JSON object read as (key, value...); value is the type of its values, as DDL."""
    df = spark.read.text(path, wholetext=True).select(F.from_json("value", f"map<string,{value}>").alias("m"))
    out = df.select(F.explode("m").alias("key", "value"))
    return out.select("key", "value.*") if value.startswith("struct") else out


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value): lines of text files; line_no is increasing within a file."""
    return spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line_no"), "value")
