"""Count rows while they are written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run ``write`` on ``df`` and return the rows written.

    The count is taken in the tasks that write, after any shuffle, where Spark
    counts a task once even if it had to be repeated.
    """
    observation = Observation()
    write(df.observe(observation, F.count(F.lit(1)).alias("rows")))
    return observation.get["rows"]


def clustered(df: DataFrame, columns: list[str]) -> DataFrame:
    """Bring the rows of an output partition together before a write.

    ``rebalance`` lets Spark split a large output partition over several tasks
    and merge small ones, where ``repartition`` would give each one task.
    """
    return df.hint("rebalance", *columns) if columns else df
