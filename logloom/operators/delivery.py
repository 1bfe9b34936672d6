"""What is known after sending: last sequences, error counts, object keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_sequences(results: DataFrame) -> DataFrame:
    """The largest sequence of each shard among accepted rows."""
    return results.where(F.col("error_code").isNull()).groupBy("shard").agg(F.max("sequence").alias("last_sequence"))


def error_histogram(results: DataFrame) -> DataFrame:
    """How many rows failed with each code and message."""
    failed = results.where(F.col("error_code").isNotNull())
    return failed.groupBy(F.concat_ws(" ", "error_code", "error_message").alias("error")).agg(F.count("*").alias("n"))


def object_key(directory: str | None, name: Column) -> Column:
    """The directory without a leading slash and with one at its end, then the name."""
    head = (directory or "").replace("\\", "/").strip("/")
    return F.concat(F.lit(f"{head}/" if head else ""), F.regexp_replace(name, "^/+", ""))


#: Status codes that no retry mends.
FATAL_CODES = (400, 401, 403, 441)
FATAL_KINDS = (ValueError, TypeError, KeyError, AttributeError, AssertionError, NotImplementedError)


def retriable(error: BaseException | None) -> bool:
    """Whether sending again may help: not for rejected credentials and requests, errors of the
    program, or unknown hosts, be it the error itself or what caused it."""
    import socket

    while error is not None:
        if getattr(error, "status", None) in FATAL_CODES or isinstance(error, (*FATAL_KINDS, socket.gaierror, InterruptedError)):
            return False
        error = error.__cause__
    return True
