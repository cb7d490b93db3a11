"""Settings of the session that hold for one write."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def preset(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for as long as the block runs; those the session has stay as they are."""
    ours = {name: v for name, v in values.items() if spark.conf.get(name, None) is None}
    for name, value in ours.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in ours:
            spark.conf.unset(name)
