"""Dashboard queries over mart states.

Each takes the states of its mart, stored or computed on the fly, so filters on mart keys reach the
Parquet scan of the mart. Sort keys end in a unique column: rows that share the first one can then be
spread over several tasks, and the order is always the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.ratio import band, pct
from millrace.operators.states import merge
from millrace.plans.marts import MARTS, MONTH, month_of


# Where the panels turn orange and red.
SENSOR_LIMITS = (90, 95)
ANOMALY_LIMITS = (5, 10)


def time_range(df: DataFrame, col: str, start: object, end: object) -> DataFrame:
    """Rows whose time lies in the dashboard's range; both ends belong to it.

    Of stored states only the folders of the range's months are read.
    """
    dtype = df.schema[col].dataType

    def bound(v: object) -> Column:
        return F.lit(str(v)).cast(dtype)

    if MONTH in df.columns:
        df = df.filter(F.col(MONTH).between(month_of(bound(start)), month_of(bound(end))))
    return df.filter(F.col(col).between(bound(start), bound(end)))


def panel_production(states: DataFrame) -> DataFrame:
    """Orders, target, actual and gap per day."""
    return (
        merge(states, MARTS["mv_production_daily"])
        .select(
            "order_date",
            F.col("order_count").alias("orders"),
            F.col("target_total").alias("target_qty"),
            F.col("actual_total").alias("actual_qty"),
            F.col("gap_total").alias("gap"),
        )
        .orderBy("order_date")
    )


def panel_machine(states: DataFrame, machine: str | None = None) -> DataFrame:
    """Utilisation per machine, most produced first; no ``machine`` means all of them."""
    if machine is not None:
        states = states.filter(F.col("machine_id") == F.lit(machine))
    return (
        merge(states, MARTS["mv_machine_daily"], by=["machine_id"])
        .select(
            "machine_id",
            F.col("order_count").alias("orders"),
            F.col("target_total").alias("target_qty"),
            F.col("actual_total").alias("actual_qty"),
            pct(F.col("actual_total"), F.col("target_total"), 1).alias("utilization_pct"),
        )
        .orderBy(F.desc_nulls_last("actual_qty"), "machine_id")
    )


def panel_sensor(states: DataFrame, sensor: str | None = None) -> DataFrame:
    """Hourly average, maximum and minimum per sensor; no ``sensor`` means all of them."""
    if sensor is not None:
        states = states.filter(F.col("sensor_id") == F.lit(sensor))
    return (
        merge(states, MARTS["mv_sensor_hourly"])
        .select(
            "reading_hour",
            "sensor_id",
            F.col("avg_val").alias("avg_value"),
            F.col("max_val").alias("max_value"),
            F.col("min_val").alias("min_value"),
        )
        .orderBy("reading_hour", "sensor_id")
    )


def panel_anomaly(states: DataFrame) -> DataFrame:
    """Anomalies, readings and anomaly rate per day."""
    return (
        merge(states, MARTS["mv_anomaly_daily"])
        .select(
            "reading_date",
            F.col("anomaly_count").alias("anomalies"),
            "total_readings",
            pct(F.col("anomaly_count"), F.col("total_readings"), 2).alias("anomaly_rate_pct"),
        )
        .orderBy("reading_date")
    )


def sensor_bands(panel: DataFrame) -> DataFrame:
    """Colours of the sensor panel's values."""
    values = ("avg_value", "max_value", "min_value")
    bands = [band(F.col(c), *SENSOR_LIMITS).alias(f"{c}_band") for c in values]
    return panel.select("reading_hour", "sensor_id", *bands)


def anomaly_band(panel: DataFrame) -> DataFrame:
    """Colour of each day's anomaly rate."""
    return panel.select("reading_date", "anomaly_rate_pct", band(F.col("anomaly_rate_pct"), *ANOMALY_LIMITS).alias("rate_band"))


def picker(states: DataFrame, column: str) -> DataFrame:
    """Distinct values of a mart key for a dashboard variable."""
    return states.select(column).distinct()
