"""Layer databases and listings of tables and columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LAYERS

_KIND = {"MANAGED": "BASE TABLE", "EXTERNAL": "BASE TABLE"}


def ensure_layers(spark: SparkSession) -> list[str]:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    return list(LAYERS)


def list_tables(
    spark: SparkSession,
    names: list[str] | None = None,
    with_rows: bool = False,
    schemas: list[str] | None = None,
) -> DataFrame:
    """Catalog, schema, name and type of the visible tables and views.

    `schemas` lists those of some databases, such as the layers, instead of what is
    visible without a database name. `with_rows` adds the row count of each, read
    from the tables themselves; an empty table has 0.
    """
    listed = spark.catalog.listTables() if schemas is None else [
        t for schema in schemas for t in spark.catalog.listTables(schema) if not t.isTemporary
    ]
    found = [
        (t.catalog, ".".join(t.namespace or []) or None, t.name, _KIND.get(t.tableType, "VIEW"))
        for t in listed
        if names is None or t.name in names
    ]
    columns = "table_catalog string, table_schema string, table_name string, table_type string"
    if not with_rows:
        return spark.createDataFrame(found, columns)
    counted = [
        spark.table(f"{row[1]}.{row[2]}" if row[1] else row[2])
        .agg(F.count("*").alias("table_rows"))
        .select(
            *[
                F.lit(value).cast("string").alias(name)
                for name, value in zip("table_catalog table_schema table_name table_type".split(), row)
            ],
            "table_rows",
        )
        for row in found
    ]
    if not counted:
        return spark.createDataFrame([], columns + ", table_rows bigint")
    return reduce(DataFrame.unionByName, counted)


def list_columns(df: DataFrame, with_nulls: bool = False) -> DataFrame:
    """Name, type, nullability and text length of each column of a table.

    `with_nulls` adds the number of missing values per column, all in one pass.
    """
    spark = df.sparkSession
    fields = [
        (
            f.name,
            f.dataType.simpleString(),
            "YES" if f.nullable else "NO",
            f.metadata.get("max_length"),
        )
        for f in df.schema.fields
    ]
    schema = T.StructType(
        [
            T.StructField("column_name", T.StringType()),
            T.StructField("data_type", T.StringType()),
            T.StructField("is_nullable", T.StringType()),
            T.StructField("character_maximum_length", T.IntegerType()),
        ]
    )
    if not with_nulls:
        return spark.createDataFrame(fields, schema)
    missing = df.agg(*[(F.count("*") - F.count(f"`{n}`")).alias(f"m{i}") for i, (n, *_) in enumerate(fields)])
    rows = [
        F.struct(
            *[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)],
            F.col(f"m{i}").alias("null_rows"),
        )
        for i, row in enumerate(fields)
    ]
    return missing.select(F.inline(F.array(*rows)))
