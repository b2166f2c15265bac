"""Column-expression building blocks (all JVM-side, codegen friendly)."""
from telemetra.functions.timeparse import iso_to_millis, is_iso_datetime, millis_to_iso, hms_label
from telemetra.functions.typing import type_by_sensor_type, type_by_metric, type_by_value, identify_type
from telemetra.functions.keys import uuid5_expr, datastream_key, thing_key
from telemetra.functions.text import py_strip, is_blank

__all__ = [
    "iso_to_millis", "is_iso_datetime", "millis_to_iso", "hms_label",
    "type_by_sensor_type", "type_by_metric", "type_by_value", "identify_type",
    "uuid5_expr", "datastream_key", "thing_key", "py_strip", "is_blank",
]
