"""Vendor back ends as Python data sources: rows come from an injected function, so that tests and replays need no network.

Options: backend = module:function, items = JSON list of requests, partitions. The function takes one request and yields tuples of the
schema; a rate limit belongs into it, with one partition.
"""

from __future__ import annotations

import importlib
import json
import random
import re
import time
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


class _Slice(InputPartition):
    def __init__(self, items: list):
        self.items = items


class VendorReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[_Slice]:
        items, n = json.loads(self.options["items"]), max(1, int(self.options.get("partitions", "1")))
        return [_Slice(items[i::n]) for i in range(n) if items[i::n]]

    def read(self, partition: _Slice) -> Iterator[tuple]:
        module, name = self.options["backend"].split(":")
        fetch = getattr(importlib.import_module(module), name)
        for item in partition.items:
            yield from fetch(item)


class VendorSource(DataSource):
    """spark.read.format('tidemark_vendor').schema(...).option('backend', 'pkg.mod:fn').option('items', '[...]')"""

    @classmethod
    def name(cls) -> str:
        return "tidemark_vendor"

    def reader(self, schema: StructType) -> VendorReader:
        return VendorReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(VendorSource)


# What a rate limit looks like, and how long to wait
RATE_LIMITED = ("401", "429", "999", "too many", "rate limit")
FIRST_WAIT, LONGEST_WAIT, FLOOR_AFTER_TWO, JITTER = 2.0, 120.0, 60.0, 0.25

#: Whatever follows these names in an error message is a secret.
SECRET = re.compile(r"(?i)\b(token|secret|password|api[_-]?key|authorization|crumb|cookie)(\"?\s*[=:]\s*\"?)(bearer\s+)?[^\s\"&,;]+")


def redacted(message: str) -> str:
    """An error message without the secrets that URLs and headers in it carry."""
    return SECRET.sub(r"\1\2***", message)


def retryable(message: str) -> bool:
    """Whether an error is worth another try: rate limits are, refusals aren't."""
    text = message.lower()
    return any(t in text for t in RATE_LIMITED) and "permission" not in text


def backoff(failures: int, rng: random.Random | None = None, base: float = FIRST_WAIT, most: float = LONGEST_WAIT, floor_after_two: float = FLOOR_AFTER_TWO, jitter: float = JITTER) -> float:
    """Seconds to wait after so many failures in a row, and up to `jitter` more."""
    wait = min(most, base * 2 ** max(0, failures - 1))
    if failures > 2:
        wait = max(wait, floor_after_two)
    return wait + jitter * (rng or random).random()


def with_retries(call: Callable[[], object], tries: int = 3, sleep: Callable[[float], None] = time.sleep) -> object:
    for n in range(1, tries + 1):
        try:
            return call()
        except Exception as e:  # noqa: BLE001
            if n == tries or not retryable(str(e)):
                raise
            sleep(backoff(n))
    raise RuntimeError("no tries")


def has_payload(value: object) -> bool:
    """Whether a decoded payload holds anything: empty containers, nested ones too, and nulls don't count."""
    if value is None or value == "":
        return False
    if isinstance(value, dict):
        return any(has_payload(v) for v in value.values())
    if isinstance(value, list):
        return any(has_payload(v) for v in value)
    return True
