from millrace.plans.contracts import CONTRACTS, Contract, conform
from millrace.plans.marts import (
    MARTS,
    build_mart,
    fold_mart,
    latest_table,
    marts_of,
    read_mart,
    read_states,
    read_table,
    refresh_mart,
    refresh_marts,
)
from millrace.plans.panels import (
    anomaly_band,
    panel_anomaly,
    panel_machine,
    panel_production,
    panel_sensor,
    picker,
    sensor_bands,
    time_range,
)
from millrace.plans.pipeline import (
    load_versions,
    run_extract,
    run_load,
    run_pipeline,
    run_stage,
    start_load,
    stream_load,
)

__all__ = [
    "CONTRACTS",
    "Contract",
    "MARTS",
    "anomaly_band",
    "build_mart",
    "conform",
    "fold_mart",
    "latest_table",
    "load_versions",
    "marts_of",
    "panel_anomaly",
    "panel_machine",
    "panel_production",
    "panel_sensor",
    "picker",
    "read_mart",
    "read_states",
    "read_table",
    "refresh_mart",
    "refresh_marts",
    "run_extract",
    "run_load",
    "run_pipeline",
    "run_stage",
    "sensor_bands",
    "start_load",
    "stream_load",
    "time_range",
]
