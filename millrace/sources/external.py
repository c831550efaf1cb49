"""External files and DataFrames under a SQL name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_delimited(spark: SparkSession, name: str, path: str, schema: str, sep: str = "|") -> DataFrame:
    """A delimited file or folder as a named table with a declared schema."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {name} ({schema}) USING csv "
        f"OPTIONS (path '{path}', sep '{sep}', header 'false')"
    )
    return spark.table(name)


def register_view(df: DataFrame, name: str, *fields: str) -> DataFrame:
    """Publish `df` under a name with a field list such as `"id", "ts AS times"`; works on streams too."""
    view = df.selectExpr(*fields) if fields else df
    view.createOrReplaceTempView(name)
    return view.sparkSession.table(name)
