"""Scans with declared schemas: nothing is inferred, so no file is read twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from seriesloom.functions.dates import slash_to_date
from seriesloom.sources import schemas


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers arrive as NaN from some writers; every later step tests for null."""
    fixed = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name))
        for f in df.schema
        if isinstance(f.dataType, (DoubleType, FloatType))
    }
    return df.withColumns(fixed) if fixed else df


def read_csv(spark: SparkSession, path: str, schema: StructType, sep: str = ",") -> DataFrame:
    """A headed text table. The header is checked against the schema's column names."""
    reader = spark.read.schema(schema).option("header", True).option("sep", sep)
    return nan_to_null(reader.option("enforceSchema", False).csv(path))


def read_measurements(spark: SparkSession, path: str) -> DataFrame:
    """The labelled measurement table."""
    return read_csv(spark, path, schemas.MEASUREMENTS)


def read_daily(spark: SparkSession, path: str, date: str, value: str, features: list[str]) -> DataFrame:
    """A daily table with its date text parsed to a real date."""
    table = read_csv(spark, path, schemas.daily_schema(date, value, features))
    return table.withColumn(date, slash_to_date(F.col(date)))


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """The stored article table."""
    return spark.read.schema(schemas.ARTICLES).parquet(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the known Parquet tables of a folder."""
    return spark.read.schema(schemas.TABLES[name]).parquet(f"{folder}/{name}.parquet")
