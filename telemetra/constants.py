"""Fixed values that must equal the behaviour being reproduced.

Everything here is data, not logic: names, limits and defaults in natural order.
"""
from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: sensor types -------------------------------------------------
SENSOR_TYPES = ("analog", "counter", "state", "alarm")

# --- fixed values: metric -> sensor type (used when sensor_type is absent) --------
METRIC_TYPE = {
    "temperature": "analog",
    "humidity": "analog",
    "co2": "analog",
    "voltage": "analog",
    "water": "counter",
    "electricity": "counter",
    "door": "state",
    "oven": "state",
    "move": "alarm",
    "alarm": "state",
    "fridge": "analog",
    "smoke": "alarm",
}

# --- fixed value: reason of a payload that can't be decoded ------------------------
DECODE_FAILED = "decode_failed"

# --- fixed values: hardware-fault limits (fault if min < low, else if max > high) --
FAULT_LIMITS = {
    "temperature": (-50.0, 120.0),
    "humidity": (0.0, 100.0),
    "co2": (0.0, 10000.0),
    "voltage": (0.0, 500.0),
    "fridge": (-50.0, 100.0),
}

# --- fixed values: detector settings ---------------------------------------------
ANOMALY_THRESHOLD = 0.85
MIN_SAMPLES_FOR_ANOMALY = 100
MIN_SAMPLES_FOR_DRIFT = 30
DRIFT_COOLDOWN = 20
SNAPSHOT_EVERY = 2_000
HST_TREES = 25
HST_HEIGHT = 6
HST_WINDOW = 100
HST_SEED = 42
HST_LIMIT = 3.0
ADWIN_DELTA = 0.001
ADWIN_CLOCK = 32
ADWIN_GRACE = 30
ADWIN_MIN_WINDOW = 30

# --- fixed values: feature names per detector branch -----------------------------
FEATURES = {
    "analog": ("average", "min_value", "max_value", "spread", "time", "day_of_week"),
    "counter": ("delta", "rate", "time", "day_of_week"),
    "state": ("distinct_counts", "time", "day_of_week"),
    "motion": ("activity_level", "time", "day_of_week"),
}

# --- fixed values: uuid5 namespaces (RFC 4122 appendix C) --------------------------
NAMESPACE_DNS_HEX = "6ba7b8109dad11d180b400c04fd430c8"
NAMESPACE_URL_HEX = "6ba7b8119dad11d180b400c04fd430c8"

# --- fixed values: measurement names and constants of the point writers -----------
MEASUREMENT_PROCESSED = "processed_data"
MEASUREMENT_LATE = "late_events"
MEASUREMENT_DLQ = "dlq_metrics"
MEASUREMENT_ANOMALY = "anomalies"
MEASUREMENT_DRIFT = "concept_drift"
DLQ_STAGE = "flink_decoder"
GARBAGE_PAYLOAD = "totally_invalid_avro_garbage_123456789"
BROKEN_TIME = "2026-99-99 broken-time"


@dataclass(frozen=True)
class WindowSpec:
    """Tumbling-window timing, all in epoch milliseconds."""

    window_ms: int = 10_000
    bound_ms: int = 2_000
    lateness_ms: int = 15_000

    @property
    def fire_offset(self) -> int:
        # a record with event_ms >= window_end + fire_offset moves the watermark to
        # window_end - 1 or beyond (watermark = max event - bound - 1)
        return self.bound_ms

    @property
    def expire_offset(self) -> int:
        # a record with event_ms >= window_end + expire_offset moves the watermark to
        # window_end + lateness or beyond: the window's state is dropped
        return self.lateness_ms + self.bound_ms + 1


# Reference timing: 10 s windows, 2 s bound, 15 s lateness.
REFERENCE_SPEC = WindowSpec(10_000, 2_000, 15_000)
# The events fixture is sparse (30 days), so its times are the reference's x 4,320.
FIXTURE_SPEC = WindowSpec(43_200_000, 8_640_000, 64_800_000)
# Detector input uses plain one-hour windows over the fixture.
HOUR_MS = 3_600_000
