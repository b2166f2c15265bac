"""Sensor-type identification (T1-T4) as column expressions."""
from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from telemetra.constants import METRIC_TYPE, SENSOR_TYPES


def _metric_map() -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(METRIC_TYPE.items())])


def type_by_sensor_type(sensor_type: Column) -> Column:
    """The declared type if it is one of the four names, else NULL."""
    return F.when(sensor_type.isin(*SENSOR_TYPES), sensor_type)


def type_by_value(value_kind: Column) -> Column:
    """String -> state, bool -> alarm, anything else (number, null) -> analog."""
    return (F.when(value_kind == "string", F.lit("state"))
            .when(value_kind == "bool", F.lit("alarm"))
            .otherwise(F.lit("analog")))


def type_by_metric(metric: Column, value_kind: Column) -> Column:
    """Fixed metric table, falling back to T3."""
    return F.coalesce(F.element_at(_metric_map(), metric), type_by_value(value_kind))


def identify_type(sensor_type: Column, metric: Column, value_kind: Column) -> Column:
    """T4: T1, else T2, else T3."""
    return F.coalesce(type_by_sensor_type(sensor_type), type_by_metric(metric, value_kind))
