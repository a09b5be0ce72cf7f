"""Warehouse table contracts: typed columns, key, and the checking cast."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.checks import require_columns
from millrace.operators.clean import parse_time


@dataclass(frozen=True)
class Contract:
    name: str
    key: str
    schema: T.StructType


STRING, INT, LONG, BOOL = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()
TIME, DECIMAL = T.TimestampNTZType(), T.DecimalType(10, 4)
REQUIRED = False  # not nullable

# Column names, types, order and nullability of the four warehouse tables.
DIM_MACHINES = T.StructType(
    [
        T.StructField("machine_id", STRING, REQUIRED),
        T.StructField("machine_name", STRING, REQUIRED),
        T.StructField("machine_type", STRING, REQUIRED),
        T.StructField("location", STRING, REQUIRED),
        T.StructField("status", STRING),
        T.StructField("created_at", TIME),
        T.StructField("updated_at", TIME),
        T.StructField("_delta_version", LONG, REQUIRED),
    ]
)
DIM_SENSORS = T.StructType(
    [
        T.StructField("sensor_id", STRING, REQUIRED),
        T.StructField("machine_id", STRING),
        T.StructField("sensor_type", STRING, REQUIRED),
        T.StructField("measurement_unit", STRING, REQUIRED),
        T.StructField("created_at", TIME),
        T.StructField("updated_at", TIME),
        T.StructField("_delta_version", LONG, REQUIRED),
    ]
)
FACT_PRODUCTION_ORDERS = T.StructType(
    [
        T.StructField("order_id", STRING, REQUIRED),
        T.StructField("machine_id", STRING),
        T.StructField("product_sku", STRING, REQUIRED),
        T.StructField("target_qty", INT, REQUIRED),
        T.StructField("actual_qty", INT),
        T.StructField("status", STRING),
        T.StructField("start_time", TIME),
        T.StructField("end_time", TIME),
        T.StructField("created_at", TIME),
        T.StructField("updated_at", TIME),
        T.StructField("_delta_version", LONG, REQUIRED),
    ]
)
FACT_SENSOR_READINGS = T.StructType(
    [
        T.StructField("reading_id", LONG, REQUIRED),
        T.StructField("sensor_id", STRING),
        T.StructField("reading_value", DECIMAL, REQUIRED),
        T.StructField("is_anomaly", BOOL),
        T.StructField("reading_timestamp", TIME, REQUIRED),
        T.StructField("created_at", TIME),
        T.StructField("updated_at", TIME),
        T.StructField("_delta_version", LONG, REQUIRED),
    ]
)
CONTRACTS: dict[str, Contract] = {
    c.name: c
    for c in (
        Contract("dim_machines", "machine_id", DIM_MACHINES),
        Contract("dim_sensors", "sensor_id", DIM_SENSORS),
        Contract("fact_production_orders", "order_id", FACT_PRODUCTION_ORDERS),
        Contract("fact_sensor_readings", "reading_id", FACT_SENSOR_READINGS),
    )
}

# Fillers that only make the column NOT NULL to the optimizer: the check before them always raises
# first. A type without one is checked all the same.
_FILLER = {
    "string": "''",
    "int": "0",
    "bigint": "0L",
    "decimal(10,4)": "0.0000BD",
    "timestamp_ntz": "timestamp_ntz'1970-01-01 00:00:00'",
}


# Wide enough to hold every value of the types that are compared after a cast.
_WIDE = "decimal(38,10)"


def _exact(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """Whether the cast of a value that is not NULL kept it."""
    out = c.try_cast(target)
    numeric = isinstance(target, T.NumericType)
    if numeric and isinstance(source, (T.FloatType, T.DoubleType)):
        return F.coalesce(out.cast("double") == c.cast("double"), F.lit(False))
    if isinstance(target, (T.DecimalType, T.IntegralType)) and isinstance(source, (T.NumericType, T.StringType)):
        return F.coalesce(out.try_cast(_WIDE) == c.try_cast(_WIDE), F.lit(False)) & (
            c.try_cast("double").isNull() | (F.abs(out.cast("double") - c.try_cast("double")) <= F.abs(c.try_cast("double")) * 1e-12)
        )
    return out.isNotNull()


def _cast(table: str, c: Column, source: T.DataType, field: T.StructField) -> Column:
    """The value in the contract's type; one that does not fit, or would be rounded, raises."""
    dtype = field.dataType
    if source == dtype or isinstance(source, T.NullType):
        return c.cast(dtype)
    if isinstance(dtype, T.TimestampNTZType) and isinstance(source, T.StringType):
        return parse_time(c, f"{table}.{field.name}")
    problem = F.raise_error(
        F.concat(F.lit(f"{table}.{field.name} would lose "), c.cast("string"), F.lit(f" as {dtype.simpleString()}"))
    ).cast(dtype)
    kept = F.when(_exact(c, source, dtype), c.try_cast(dtype)).otherwise(problem)
    return F.when(c.isNull(), F.lit(None).cast(dtype)).otherwise(kept)


def _checked(table: str, source: T.DataType, field: T.StructField) -> Column:
    dtype = field.dataType
    c = _cast(table, F.col(field.name), source, field)
    if field.nullable:
        return c.alias(field.name)
    problem = F.raise_error(F.lit(f"NULL in {table}.{field.name}")).cast(dtype)
    filler = _FILLER.get(dtype.simpleString())
    fillers = [] if filler is None else [F.expr(filler).cast(dtype)]
    return F.coalesce(c, problem, *fillers).alias(field.name)


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select the contract's columns in order, cast them, and fail on NULL where none is allowed.

    Missing and unknown columns raise before any job runs. The rest is checked row by row inside the
    same scan that writes the table: a value that does not fit its type, or that the cast would round,
    raises under any session setting.
    """
    contract = CONTRACTS[name]
    wanted = contract.schema.fieldNames()
    require_columns(df, *wanted)
    unknown = [c for c in df.columns if c not in wanted]
    if unknown:
        raise ValueError(f"unknown column(s) for {name}: {', '.join(unknown)}")
    return df.select(*[_checked(name, df.schema[f.name].dataType, f) for f in contract.schema.fields])
