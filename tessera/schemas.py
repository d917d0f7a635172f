"""Table schemas of the three layers and a schema check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# The data contract's columns and types.
# The raw and cleaned sales record; every field nullable, the cleaned layer
# changes values, not types.
SALES_SCHEMA = StructType([
    StructField("id", IntegerType(), True),
    StructField("sale_date", DateType(), True),
    StructField("product_id", IntegerType(), True),
    StructField("product_name", StringType(), True),
    StructField("customer_id", IntegerType(), True),
    StructField("region", StringType(), True),
    StructField("quantity", IntegerType(), True),
    StructField("unit_price", DoubleType(), True),
    StructField("created_at", TimestampType(), True),
])

SALES_COLUMNS = [f.name for f in SALES_SCHEMA.fields]


def sales_schema(*, timestamp_ntz: bool = False) -> StructType:
    """The sales schema; ``timestamp_ntz`` types ``created_at`` without a zone
    (what the Parquet test tables hold), otherwise as a session-zone timestamp."""
    if not timestamp_ntz:
        return SALES_SCHEMA
    return StructType([StructField(f.name, TimestampNTZType(), True) if f.name == "created_at" else f
                       for f in SALES_SCHEMA.fields])

# The contract's column names.
# Columns that must all be present for a row to enter the cleaned layer.
CRITICAL_COLUMNS = ["id", "sale_date", "product_id", "customer_id", "quantity", "unit_price"]

DIM_DATE_COLUMNS = ["date_key", "full_date", "year", "quarter", "month", "day"]
DIM_PRODUCT_COLUMNS = ["product_key", "product_id", "product_name"]
DIM_CUSTOMER_COLUMNS = ["customer_key", "customer_id"]
DIM_REGION_COLUMNS = ["region_key", "region_name"]
FACT_COLUMNS = ["sale_id", "date_key", "product_key", "customer_key", "region_key",
                "quantity", "unit_price", "total_amount", "created_at"]

FACT_AMOUNT_TYPE = DecimalType(18, 2)

_STAR_TYPES = {"full_date": DateType(), "product_name": StringType(), "region_name": StringType(),
               "unit_price": DoubleType(), "total_amount": FACT_AMOUNT_TYPE, "created_at": TimestampType()}
#: Schema of each star table: keys, ids and date parts are integers.
STAR_SCHEMAS = {
    table: StructType([StructField(c, _STAR_TYPES.get(c, IntegerType()), True) for c in columns])
    for table, columns in (("dim_date", DIM_DATE_COLUMNS), ("dim_product", DIM_PRODUCT_COLUMNS),
                           ("dim_customer", DIM_CUSTOMER_COLUMNS), ("dim_region", DIM_REGION_COLUMNS),
                           ("fact_sales", FACT_COLUMNS))}

STAR_TABLES = ("dim_date", "dim_product", "dim_customer", "dim_region", "fact_sales")


class SchemaMismatch(ValueError):
    pass


def schema_problems(df: DataFrame, expected: StructType, *, check_types: bool = True,
                    ignore_timestamp_zone: bool = True) -> list[str]:
    """List every difference between ``df``'s columns and ``expected`` (names in
    order, then types).  Empty list = match.  Pure metadata, no Spark job."""
    problems: list[str] = []
    got = df.schema.fields
    want_names = [f.name for f in expected.fields]
    got_names = [f.name for f in got]
    if got_names != want_names:
        missing = [n for n in want_names if n not in got_names]
        extra = [n for n in got_names if n not in want_names]
        if missing:
            problems.append(f"missing columns: {missing}")
        if extra:
            problems.append(f"unexpected columns: {extra}")
        if not missing and not extra:
            problems.append(f"column order {got_names} != {want_names}")
    if check_types:
        by_name = {f.name: f.dataType for f in got}
        for f in expected.fields:
            have = by_name.get(f.name)
            if have is None:
                continue
            same = have == f.dataType
            if not same and ignore_timestamp_zone:
                same = {have.typeName(), f.dataType.typeName()} <= {"timestamp", "timestamp_ntz"}
            if not same:
                problems.append(f"{f.name}: {have.simpleString()} != {f.dataType.simpleString()}")
    return problems


def check_schema(df: DataFrame, expected: StructType, **kw) -> DataFrame:
    """Raise ``SchemaMismatch`` naming all differences; return ``df`` unchanged."""
    problems = schema_problems(df, expected, **kw)
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df
