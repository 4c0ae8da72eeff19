"""SQL surface: temp views over the tables (X2) and the clock / cleaning
helpers as SQL functions (X1).

The reference registers Python UDFs; here every function is a SQL-bodied
temporary function, which Catalyst inlines into the plan (no Python worker,
whole-stage codegen). Each body computes the same value as the Column
function of the same name in ``isobar.functions`` (checked in tests).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SQL_FUNCTIONS = {
    "to_int": "(x STRING) RETURNS INT RETURN try_cast(try_cast(x AS DOUBLE) AS INT)",
    "percent": "(x STRING) RETURNS STRING RETURN replace(x, '%', '')",
    "slug": "(x STRING) RETURNS STRING RETURN lower(replace(x, ' ', ''))",
    "prettify": "(x STRING) RETURNS STRING RETURN initcap(replace(x, '_', ' '))",
    "hhmm": ("(h STRING, m STRING) RETURNS STRING RETURN "
             "CASE WHEN concat(h, ':', m) = ':' THEN '' ELSE concat(h, ':', m) END"),
    "offset_seconds": (
        "(o STRING) RETURNS BIGINT RETURN "
        "CAST(try_cast(try_cast(o AS DOUBLE) AS INT) / 100 AS BIGINT) * 3600 + "
        "CAST(try_cast(try_cast(o AS DOUBLE) AS INT) % 100 AS BIGINT) * 60"),
    "local_date": (
        "(e BIGINT, o STRING) RETURNS STRING RETURN "
        "CAST(date_from_unix_date(CAST(floor((e + offset_seconds(o)) / 86400) AS INT)) AS STRING)"),
    "local_time": (
        "(e BIGINT, o STRING) RETURNS STRING RETURN "
        "concat(lpad(CAST(CAST(floor(pmod(e + offset_seconds(o), 86400) / 60) / 60 AS INT) "
        "AS STRING), 2, '0'), ':', lpad(CAST(CAST(floor(pmod(e + offset_seconds(o), 86400) "
        "/ 60) % 60 AS INT) AS STRING), 2, '0'))"),
    "epoch_of": (
        "(d STRING, t STRING) RETURNS BIGINT RETURN "
        "unix_seconds(try_to_timestamp(concat(d, 'T', t, 'Z'), 'yyyy-MM-dd''T''H:mX'))"),
    "epoch_hour": "(d STRING, t STRING) RETURNS BIGINT RETURN "
                  "floor(epoch_of(d, t) / 3600) * 3600",
    "lead_hours": ("(d STRING, t STRING, fd STRING, ft STRING) RETURNS INT RETURN "
                   "CAST((epoch_hour(fd, ft) - epoch_hour(d, t)) / 3600 AS INT)"),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create the helpers as temporary SQL functions (dependencies
    first: the dict is in dependency order)."""
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(SQL_FUNCTIONS)


def register_views(tables: dict[str, DataFrame]) -> list[str]:
    """One temp view per table, named as the table."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)
