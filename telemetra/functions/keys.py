"""RFC 4122 name-based (SHA-1, version 5) UUIDs as Spark expressions (K1, K2)."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from telemetra.constants import NAMESPACE_DNS_HEX, NAMESPACE_URL_HEX


def uuid5_expr(namespace_hex: str, name: Column) -> Column:
    """uuid5(namespace, name) in canonical 8-4-4-4-12 lower-case form."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(name, "UTF-8")))
    h = F.substring(digest, 1, 32)
    # version nibble -> 5; variant bits of byte 8 -> 10xx
    ver = F.concat(F.lit("5"), F.substring(h, 14, 3))
    var_nibble = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int")
                                .bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))))
    var = F.concat(var_nibble, F.substring(h, 18, 3))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), ver, var,
                       F.substring(h, 21, 12))


def datastream_key(thing_id: Column, metric: Column) -> Column:
    """K1: uuid5(NAMESPACE_URL, '{thing_id}:{metric}')."""
    return uuid5_expr(NAMESPACE_URL_HEX, F.concat(thing_id, F.lit(":"), metric))


def thing_key(device_type: Column, device_index: Column) -> Column:
    """K2: uuid5(NAMESPACE_DNS, 'iot-simulator:{type}:{index}')."""
    return uuid5_expr(NAMESPACE_DNS_HEX, F.concat(F.lit("iot-simulator:"), device_type, F.lit(":"),
                                                  device_index.cast("string")))
