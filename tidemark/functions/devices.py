"""Sensor and device expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import _c

# Normal range per sensor type, ends included.
NORMAL_RANGES = {
    "temperature": (18.0, 25.0),
    "humidity": (30.0, 70.0),
    "pressure": (1000.0, 1020.0),
    "light": (100.0, 800.0),
    "motion": (0.0, 1.0),
    "sound": (30.0, 60.0),
    "vibration": (0.1, 2.0),
    "air_quality": (0.0, 50.0),
}


def degradation_factor(days_since_maintenance) -> Column:
    """Wear from 0 to 1, full after 180 days without maintenance."""
    return F.least(_c(days_since_maintenance) / F.lit(180.0), F.lit(1.0))


def health_score(battery, signal, days_since_maintenance) -> Column:
    return (
        _c(battery) / F.lit(100.0) * F.lit(0.4)
        + (_c(signal) + F.lit(100)) / F.lit(70.0) * F.lit(0.3)
        + (F.lit(1.0) - degradation_factor(days_since_maintenance)) * F.lit(0.3)
    ) * F.lit(100.0)


def device_status(is_active, score) -> Column:
    return F.when(_c(is_active) & (_c(score) > 20), "active").otherwise("inactive")


def in_normal_range(sensor_type, value, ranges=None) -> Column:
    """Whether a reading lies in its sensor's range; null for an unknown sensor."""
    out = F.lit(None).cast("boolean")
    for name, (low, high) in (ranges or NORMAL_RANGES).items():
        out = F.when(_c(sensor_type) == name, _c(value).between(low, high)).otherwise(out)
    return out


def device_health(devices: DataFrame) -> DataFrame:
    score = health_score("battery_level", "signal_strength", "days_since_maintenance")
    return devices.withColumn("health_score", F.round(score, 1)).withColumn(
        "status", device_status("is_active", score)
    )
