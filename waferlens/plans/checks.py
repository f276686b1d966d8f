"""The data-quality suite every run must pass before its marts are published."""

from __future__ import annotations

from waferlens.operators.dq import Check

# What is promised about each table.
PIPELINE_CHECKS = [
    Check("not_null", "staged_readings", "wafer_id"),
    Check("not_null", "staged_readings", "sensor_id"),
    Check("not_null", "staged_labels", "wafer_id"),
    Check("unique", "staged_labels", "wafer_id"),
    Check("not_null", "staged_labels", "yield_status"),
    Check("accepted_values", "staged_labels", "yield_status", ("pass", "fail")),
    Check("not_null", "staged_labels", "is_fail"),
    Check("accepted_values", "staged_labels", "is_fail", (0, 1)),
    Check("not_null", "staged_labels", "tested_at"),
    Check("not_null", "sensor_quality", "sensor_id"),
    Check("unique", "sensor_quality", "sensor_id"),
    Check("not_null", "wafer_features", "wafer_id"),
    Check("unique", "wafer_features", "wafer_id"),
    Check("not_null", "daily_yield", "test_date"),
    Check("unique", "daily_yield", "test_date"),
    Check("not_null", "yield_summary", "total_wafers"),
    Check("not_null", "ml_features", "wafer_id"),
    Check("unique", "ml_features", "wafer_id"),
    Check("not_null", "ml_features", "is_fail"),
]
