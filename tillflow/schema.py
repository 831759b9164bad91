"""Schemas and fixed names of the retail model."""

from __future__ import annotations

from pyspark.sql import types as T

# Money is exact: decimal everywhere, so sums do not depend on task order and
# a tie for the top seller cannot flip between runs.
MONEY = T.DecimalType(18, 2)

# Amounts as files carry them: kept in full until a total is rounded to MONEY.
RAW_MONEY = T.DecimalType(24, 6)

# The mandatory sales columns, in the order the sales files carry them.
MANDATORY_COLUMNS = [
    "customer_id",
    "store_id",
    "product_name",
    "sales_date",
    "sales_person_id",
    "price",
    "quantity",
    "total_cost",
]

# Name of the column that holds folded extra columns, and its separator.
ADDITIONAL_COLUMN = "additional_column"
FOLD_SEPARATOR = ", "

SALES_COLUMNS = MANDATORY_COLUMNS + [ADDITIONAL_COLUMN]

# Keys coming from the driver tables are 64-bit; a cluster-sized customer or
# supplier table does not fit in an int.
MANDATORY_TYPES: dict[str, T.DataType] = {
    "customer_id": T.LongType(),
    "store_id": T.IntegerType(),
    "product_name": T.StringType(),
    "sales_date": T.DateType(),
    "sales_person_id": T.LongType(),
    "price": RAW_MONEY,
    "quantity": T.IntegerType(),
    "total_cost": RAW_MONEY,
}

SALES_SCHEMA = T.StructType(
    [T.StructField(c, MANDATORY_TYPES[c], True) for c in MANDATORY_COLUMNS]
    + [T.StructField(ADDITIONAL_COLUMN, T.StringType(), True)]
)

CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.LongType(), False),
        T.StructField("first_name", T.StringType(), True),
        T.StructField("last_name", T.StringType(), True),
        T.StructField("address", T.StringType(), True),
        T.StructField("pincode", T.StringType(), True),
        T.StructField("phone_number", T.StringType(), True),
    ]
)

STORE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType(), False),
        T.StructField("address", T.StringType(), True),
        T.StructField("store_manager_name", T.StringType(), True),
    ]
)

SALES_TEAM_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("first_name", T.StringType(), True),
        T.StructField("last_name", T.StringType(), True),
        T.StructField("manager_id", T.LongType(), True),
        T.StructField("is_manager", T.StringType(), True),
        T.StructField("address", T.StringType(), True),
        T.StructField("pincode", T.StringType(), True),
    ]
)

# Columns that the tables have beyond those the marts read.
CUSTOMER_TABLE_SCHEMA = T.StructType(
    CUSTOMER_SCHEMA.fields + [T.StructField("customer_joining_date", T.DateType(), True)])

STORE_TABLE_SCHEMA = T.StructType(
    STORE_SCHEMA.fields
    + [
        T.StructField("store_pincode", T.StringType(), True),
        T.StructField("store_opening_date", T.DateType(), True),
        T.StructField("reviews", T.StringType(), True),
    ]
)

SALES_TEAM_TABLE_SCHEMA = T.StructType(
    SALES_TEAM_SCHEMA.fields + [T.StructField("joining_date", T.DateType(), True)])

PRODUCT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("name", T.StringType(), True),
        T.StructField("current_price", MONEY, True),
        T.StructField("old_price", MONEY, True),
        T.StructField("created_date", T.TimestampType(), True),
        T.StructField("updated_date", T.TimestampType(), True),
        T.StructField("expiry_date", T.DateType(), True),
    ]
)

# The two monthly marts as they are stored.
CUSTOMER_MART_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.LongType(), True),
        T.StructField("full_name", T.StringType(), True),
        T.StructField("address", T.StringType(), True),
        T.StructField("phone_number", T.StringType(), True),
        T.StructField("sales_date_month", T.StringType(), True),
        T.StructField("total_sales", MONEY, True),
    ]
)

SALES_TEAM_MART_SCHEMA = T.StructType(
    [
        T.StructField("store_id", T.LongType(), True),
        T.StructField("sales_person_id", T.LongType(), True),
        T.StructField("full_name", T.StringType(), True),
        T.StructField("sales_month", T.StringType(), True),
        T.StructField("total_sales", MONEY, True),
        T.StructField("incentive", MONEY, True),
    ]
)

# Ledger of sales files: an append-only event log; the current state of a file
# is its latest event.  Fixed values: A = active (being processed), I = inactive (done).
STATUS_ACTIVE = "A"
STATUS_INACTIVE = "I"

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("file_name", T.StringType(), False),
        T.StructField("file_location", T.StringType(), True),
        T.StructField("status", T.StringType(), False),
        T.StructField("event_ts", T.TimestampType(), False),
        T.StructField("seq", T.IntegerType(), False),
        T.StructField("run_id", T.StringType(), True),
    ]
)

# Columns of the two row-level extracts.
CUSTOMER_EXTRACT_COLUMNS = [
    "customer_id",
    "first_name",
    "last_name",
    "address",
    "pincode",
    "phone_number",
    "sales_date",
    "total_cost",
]

SALES_TEAM_EXTRACT_COLUMNS = [
    "store_id",
    "sales_person_id",
    "sales_person_first_name",
    "sales_person_last_name",
    "store_manager_name",
    "manager_id",
    "is_manager",
    "sales_person_address",
    "sales_person_pincode",
    "sales_date",
    "total_cost",
    "sales_month",
]
