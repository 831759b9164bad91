"""The retail tables in Spark's catalog: definitions, rows and marts in SQL.

``definitions`` gives a ``CREATE TABLE`` for each table, from the schemas of
``tillflow.schema`` (Parquet, the sales-team mart partitioned by month and
store).  ``create`` runs them in a database of its own, ``insert`` fills a table
with ``INSERT INTO ... SELECT`` from any DataFrame by column name, missing
columns as NULL, ``insert_values`` with literal rows.  The two monthly marts are
``INSERT OVERWRITE`` statements over those tables, so a user who knows SQL only can
run, read and change them.

Spark's catalog has no generated keys: an id comes with the rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.schema import (CUSTOMER_MART_SCHEMA, CUSTOMER_TABLE_SCHEMA, LEDGER_SCHEMA, PRODUCT_SCHEMA,
                             SALES_SCHEMA, SALES_TEAM_MART_SCHEMA, SALES_TEAM_TABLE_SCHEMA, STORE_TABLE_SCHEMA)

#: Table: schema and partition columns.
TABLES: dict[str, tuple[T.StructType, tuple[str, ...]]] = {
    "product_staging": (LEDGER_SCHEMA, ()),
    "customer": (CUSTOMER_TABLE_SCHEMA, ()),
    "store": (STORE_TABLE_SCHEMA, ()),
    "product": (PRODUCT_SCHEMA, ()),
    "sales_team": (SALES_TEAM_TABLE_SCHEMA, ()),
    "sales": (SALES_SCHEMA, ()),
    "customers_data_mart": (CUSTOMER_MART_SCHEMA, ()),
    "sales_team_data_mart": (SALES_TEAM_MART_SCHEMA, ("sales_month", "store_id")),
}

CUSTOMERS_DATA_MART = """
INSERT OVERWRITE {db}.customers_data_mart (customer_id, full_name, address, phone_number, sales_date_month, total_sales)
SELECT customer_id, concat(first_name, ' ', last_name), address, phone_number, sales_date_month,
       CAST(sum(amount) OVER (PARTITION BY customer_id, sales_date_month) AS DECIMAL(18,2))
FROM (
  SELECT c.customer_id, c.first_name, c.last_name, c.address, c.phone_number,
         date_format(s.sales_date, 'yyyy-MM') AS sales_date_month, sum(s.total_cost) AS amount
  FROM {db}.sales s
  JOIN {db}.customer c ON s.customer_id = c.customer_id
  JOIN {db}.store r ON r.id = s.store_id
  JOIN {db}.sales_team t ON t.id = s.sales_person_id
  GROUP BY ALL)"""

SALES_TEAM_DATA_MART = """
INSERT OVERWRITE {db}.sales_team_data_mart (store_id, sales_person_id, full_name, sales_month, total_sales, incentive)
SELECT store_id, sales_person_id, full_name, sales_month, total_sales,
       CASE WHEN rank() OVER (PARTITION BY store_id, sales_month ORDER BY total_sales DESC NULLS LAST) = 1
            THEN round(total_sales * 0.01BD, 2) ELSE 0 END
FROM (
  SELECT s.store_id, s.sales_person_id, concat(t.first_name, ' ', t.last_name) AS full_name,
         date_format(s.sales_date, 'yyyy-MM') AS sales_month, CAST(sum(s.total_cost) AS DECIMAL(18,2)) AS total_sales
  FROM {db}.sales s
  JOIN {db}.customer c ON s.customer_id = c.customer_id
  JOIN {db}.store r ON r.id = s.store_id
  JOIN {db}.sales_team t ON t.id = s.sales_person_id
  GROUP BY ALL)"""


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def definition(db: str, name: str) -> str:
    """``CREATE TABLE`` of one table."""
    schema, by = TABLES[name]
    columns = ",\n  ".join(f"{_quoted(f.name)} {f.dataType.simpleString().upper()}" + ("" if f.nullable else " NOT NULL")
                           for f in schema)
    parts = f"\nPARTITIONED BY ({', '.join(map(_quoted, by))})" if by else ""
    return f"CREATE TABLE IF NOT EXISTS {db}.{name} (\n  {columns}\n) USING parquet{parts}"


def create(spark: SparkSession, db: str, location: str | None = None) -> None:
    """The database, at ``location`` or in the warehouse, with all tables."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}" + (f" LOCATION '{location}'" if location else ""))
    for name in TABLES:
        spark.sql(definition(db, name))


def insert(rows: DataFrame, db: str, name: str) -> None:
    """``INSERT INTO`` by column name."""
    schema, by = TABLES[name]
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns
               else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    rows = rows.select(columns)
    rows.sparkSession.sql(f"INSERT INTO {db}.{name} ({', '.join(map(_quoted, schema.fieldNames()))}) "
                          f"SELECT * FROM {{rows}}", rows=rows)


def insert_values(spark: SparkSession, db: str, name: str, columns: list[str], rows: Iterable[tuple]) -> None:
    """Literal rows of some columns, with the types of the table."""
    schema = TABLES[name][0]
    insert(spark.createDataFrame(list(rows), T.StructType([schema[c] for c in columns])), db, name)


def build_marts(spark: SparkSession, db: str) -> None:
    """Both marts, from the tables of the database."""
    for statement in (CUSTOMERS_DATA_MART, SALES_TEAM_DATA_MART):
        spark.sql(statement.format(db=db))
