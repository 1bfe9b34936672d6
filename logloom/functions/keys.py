"""Partition keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key(option: str, data: Column, path: Column) -> Column:
    """RANDOM_INT, RANDOM_DOUBLE, FILE_NAME, DETERMINISTIC (digest of the payload), or the text
    itself; a comma-separated list of these gives keys joined by commas."""
    if "," in option:
        return F.concat_ws(",", *[key(o.strip(), data, path) for o in option.split(",")])
    if option == "RANDOM_INT":
        return F.floor(F.rand() * 1_000_000).cast("string")
    if option == "RANDOM_DOUBLE":
        return (F.rand() * 1_000_000).cast("string")
    if option == "FILE_NAME":
        return F.regexp_extract(path, r"([^/]*)$", 1)
    if option == "DETERMINISTIC":
        return F.md5(F.coalesce(data, F.lit("")))
    return F.lit(option)
