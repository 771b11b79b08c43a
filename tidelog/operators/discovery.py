"""What a source has: tables, keys, columns, publications; and what is configured of it."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import normalise_filter

SYSTEM_SCHEMAS = ("pg_catalog", "information_schema")
SETTINGS = ("primary_key", "updated_at_column", "soft_delete", "soft_delete_column", "where_clause")


def base_tables(tables: DataFrame) -> DataFrame:
    """information_schema.tables (table_schema, table_name, table_type) -> `schema.table` of base tables, in order."""
    own = tables.where((F.col("table_type") == "BASE TABLE") & ~F.col("table_schema").isin(*SYSTEM_SCHEMAS))
    return own.select(F.concat_ws(".", "table_schema", "table_name").alias("name")).orderBy("name")


def catalog_tables(spark: SparkSession, database: str) -> list[str]:
    """The same of Spark's own catalog."""
    return sorted(f"{database}.{t.name}" for t in spark.catalog.listTables(database) if not t.isTemporary and t.tableType != "VIEW")


def resolved(configured: DataFrame, defaults: dict, found: DataFrame, keys: DataFrame) -> DataFrame:
    """Settings of configured tables: their own, else the defaults', else the key that the source has; and `problem` if there is one.

    configured: (name, primary_key, updated_at_column, soft_delete, soft_delete_column, where_clause); found: (name);
    keys: (name, column, position) of primary keys.
    """
    k = keys.groupBy(F.col("name").alias("_k")).agg(F.count("*").alias("_n"), F.min_by("column", "position").alias("_column"))
    f = found.select(F.col("name").alias("_f")).distinct()
    rows = configured.join(f, F.col("name") == F.col("_f"), "left").join(k, F.col("name") == F.col("_k"), "left")
    own = {c: F.coalesce(F.col(c), F.lit(defaults.get(c)).cast(configured.schema[c].dataType)) for c in SETTINGS}
    key = F.coalesce(own["primary_key"], F.when(F.col("_n") == 1, F.col("_column")))
    problem = F.when(F.col("_f").isNull(), "table is missing").when(own["primary_key"].isNull() & (F.col("_n") > 1), "composite primary key").when(key.isNull(), "no primary key")
    out = {**own, "primary_key": key, "soft_delete": F.coalesce(own["soft_delete"], F.lit(False))}
    return rows.select("name", *[out[c].alias(c) for c in SETTINGS], problem.alias("problem"))


def checked(tables: DataFrame) -> DataFrame:
    """Resolved tables; a problem of any is an error."""
    fine = F.assert_true(F.col("problem").isNull(), F.concat_ws(": ", "name", "problem")).isNull()
    return tables.where(fine).drop("problem")


def table_columns(columns: DataFrame, keys: DataFrame) -> DataFrame:
    """Catalog columns (name, column, data_type, nullable, position) with whether each is of its table's primary key, in the table's order."""
    k = keys.select(F.col("name").alias("_k"), F.col("column").alias("_c"), F.lit(True).alias("_key"))
    rows = columns.join(k, (F.col("name") == F.col("_k")) & (F.col("column") == F.col("_c")), "left")
    return rows.select("name", "column", "data_type", "nullable", "position", F.coalesce("_key", F.lit(False)).alias("is_key"))


def schema_rows(df: DataFrame, name: str) -> DataFrame:
    """The columns of a DataFrame in the same form."""
    rows = [(name, f.name, f.dataType.simpleString(), f.nullable, i) for i, f in enumerate(df.schema, 1)]
    return df.sparkSession.createDataFrame(rows, "name string, column string, data_type string, nullable boolean, position int")


def normal_filter(text: Column) -> Column:
    """Row filters that mean the same, spelled alike. One row a table, so Python may read them."""

    @F.pandas_udf("string")
    def read(s: pd.Series) -> pd.Series:
        return s.map(normalise_filter, na_action="ignore")

    return read(text)


def publication_problems(configured: DataFrame, published: DataFrame) -> DataFrame:
    """(name, where_clause) configured against (name, row_filter) published -> (name, problem): not published, or with another filter."""
    p = published.select(F.col("name").alias("_p"), normal_filter(F.col("row_filter")).alias("_published"))
    c = configured.select("name", normal_filter(F.col("where_clause")).alias("_wanted"))
    same = F.col("_wanted").eqNullSafe(F.col("_published"))
    problem = F.when(F.col("_p").isNull(), "not in the publication").when(~same & F.col("_wanted").isNull(), "unexpected row filter").when(~same & F.col("_published").isNull(), "row filter is missing").when(~same, "row filter differs")
    return c.join(p, F.col("name") == F.col("_p"), "left").select("name", problem.alias("problem")).where("problem IS NOT NULL")
