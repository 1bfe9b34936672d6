"""A streaming source whose offsets are polls: each trigger gives one row, the time of the poll.

What a poll finds isn't known before it is made, so the query's offsets are times only; a replayed
micro-batch gets the same time again.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType


class Poll(InputPartition):
    def __init__(self, at_ms: int):
        self.at_ms = at_ms


class PollReader(DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"poll_ms": 0}

    def latestOffset(self) -> dict:
        return {"poll_ms": int(time.time() * 1000)}

    def partitions(self, start: dict, end: dict) -> list[Poll]:
        return [Poll(end["poll_ms"])] if end["poll_ms"] > start["poll_ms"] else []

    def read(self, partition: Poll) -> Iterator[tuple]:
        yield (partition.at_ms,)

    def commit(self, end: dict) -> None:
        pass


class PollSource(DataSource):
    """spark.readStream.format("polls").load()"""

    @classmethod
    def name(cls) -> str:
        return "polls"

    def schema(self) -> str:
        return "poll_ms long"

    def streamReader(self, schema: StructType) -> PollReader:
        return PollReader()


def register(spark) -> None:
    spark.dataSource.register(PollSource)
