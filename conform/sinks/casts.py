"""Casts that are written together with what they lose, and counted on the way."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from conform.operators.schema import cast_or_null

#: Marks the rows that lose a value; the folder of written rows is parted by it.
_LOSSY, _LOST = "__lossy", "__lost"


@dataclass(frozen=True)
class CastCounts:
    """How many values of a column a cast kept, changed and lost; nulls are kept."""

    kept: int
    changed: int
    lost: int


@dataclass(frozen=True)
class WrittenCast:
    """What a write with casts left: the rows, the rows that lost a value, and the counts.

    ``lost`` has the rows as cast, and in ``lost_values`` the text of each value that
    was lost, by column.
    """

    rows: DataFrame
    lost: DataFrame
    written: int
    counts: dict[str, CastCounts]


def write_casts(
    df: DataFrame,
    casts: Mapping[str, DataType | str],
    location: str,
    truncate: bool = False,
) -> WrittenCast:
    """Cast columns and write the rows to ``location``, which must be unused.

    One job reads ``df`` once: the tasks that write count, for every column, what its
    cast keeps, changes and loses, and rows that lose a value go to a folder of their
    own, with the values. Both folders together are the rows. A cast that Spark does not
    have loses all values. Columns that are not cast stay as they are.
    """
    cast = {name: cast_or_null(df, name, kind, truncate) for name, kind in casts.items()}
    texts = {name: F.col(f"`{name}`").cast("string") for name in casts}
    both = df.select(
        *(
            F.struct(
                F.col(f"`{n}`").alias("old"), cast[n].alias("new"), texts[n].alias("text")
            ).alias(n)
            if n in casts
            else F.col(f"`{n}`")
            for n in df.columns
        )
    )
    metrics = [F.count(F.lit(1)).alias("rows")]
    for number, name in enumerate(casts):
        old, new, text = (F.col(f"`{name}`.{part}") for part in ("old", "new", "text"))
        lost = old.isNotNull() & new.isNull()
        changed = F.coalesce(new.cast("string") != text, F.lit(False))
        metrics += [
            F.count_if(~lost & ~changed).alias(f"kept{number}"),
            F.count_if(changed).alias(f"changed{number}"),
            F.count_if(lost).alias(f"lost{number}"),
        ]
    observed = Observation()
    values = F.array(
        *(
            F.when(
                F.col(f"`{n}`.old").isNotNull() & F.col(f"`{n}`.new").isNull(),
                F.struct(F.lit(n).alias("column"), F.col(f"`{n}`.text").alias("value")),
            )
            for n in casts
        )
    )
    out = both.observe(observed, *metrics).withColumn(_LOST, F.array_compact(values))
    out = out.select(
        *(F.col(f"`{n}`.new").alias(n) if n in casts else F.col(f"`{n}`") for n in df.columns),
        _LOST,
        (F.size(_LOST) > 0).alias(_LOSSY),
    )
    out.write.mode("error").partitionBy(_LOSSY).parquet(location)
    found = observed.get
    written = df.sparkSession.read.schema(out.schema).parquet(location)
    return WrittenCast(
        rows=written.drop(_LOST, _LOSSY),
        lost=written.where(F.col(_LOSSY)).drop(_LOSSY).withColumnRenamed(_LOST, "lost_values"),
        written=found["rows"],
        counts={
            name: CastCounts(found[f"kept{n}"], found[f"changed{n}"], found[f"lost{n}"])
            for n, name in enumerate(casts)
        },
    )
