"""Stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def table_scan(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def query(spark: SparkSession, sql: str, tables: dict[str, DataFrame], **args) -> DataFrame:
    """Run parameterised SQL; tables are named in the text as {name}, values as :name."""
    return spark.sql(sql, args=args or None, **tables)


def jdbc_scan(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Table of an outside database; give partitionColumn, lowerBound, upperBound, numPartitions to read in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def evolve_schema(rows: DataFrame, schema: StructType) -> DataFrame:
    """The rows with exactly the schema's columns and types; columns they lack are NULL."""
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
