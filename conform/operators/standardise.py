"""Replace local codes by standard ones through a table of rules.

A rules table has the columns ``codigo_id`` (the standard code),
``homologacion`` (the local value), ``tabla`` (the table, in upper case) and
optionally ``columna``. Rules are joined without a hint: Spark broadcasts them
while they are under its threshold, and beyond that shuffles and splits hot
values at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conform.operators.joins import equi_join

CODE = "codigo_id"
VALUE = "homologacion"
TABLE = "tabla"
COLUMN = "columna"

_MATCH = "__value"
_STANDARD = "__code"
_OTHER = "__other"

#: What `standardise` may do with a value that has several codes.
CONFLICTS = ("all", "first", "report", "refuse")


def rules_for(rules: DataFrame, table: str, column: str | None = None) -> DataFrame:
    """The distinct rules of one table, optionally of one of its columns."""
    chosen = rules.where(F.col(TABLE) == table.upper())
    if column is not None:
        chosen = chosen.where(F.col(COLUMN) == column)
    return chosen.select(CODE, VALUE, TABLE).distinct()


def standardise(
    df: DataFrame, rules: DataFrame, column: str, how: str = "inner", conflicts: str = "all"
) -> DataFrame:
    """Replace a column's values by their codes; the column moves to the end.

    With ``inner`` rows without a rule are left out, with ``left`` they stay
    with a null code (`unmatched_values` lists them). ``conflicts`` says what becomes of
    a value that has several codes: with ``all`` its rows come once for each code, with
    ``first`` they get the least one, with ``report`` none, as if the value had no rule,
    and with ``refuse`` the query fails and names the value. `rule_conflicts` lists them.
    """
    if conflicts not in CONFLICTS:
        raise ValueError(f"conflicts is one of {', '.join(CONFLICTS)}")
    pairs = rules.select(F.col(VALUE).alias(_MATCH), F.col(CODE).alias(_STANDARD))
    if conflicts != "all":
        # One row for each value, settled before the join; rules meet in part beforehand.
        settled = pairs.groupBy(_MATCH).agg(
            F.min(_STANDARD).alias(_STANDARD), F.max(_STANDARD).alias(_OTHER)
        )
        several = F.col(_STANDARD) != F.col(_OTHER)
        if conflicts == "report":
            settled = settled.where(several.isNull() | ~several)
        elif conflicts == "refuse":
            told = F.concat(F.lit("several codes for "), F.col(_MATCH).cast("string"))
            code = F.when(several, F.raise_error(told)).otherwise(F.col(_STANDARD))
            settled = settled.withColumn(_STANDARD, code)
        pairs = settled.drop(_OTHER)
    return _replace(df, pairs, column, how)


def rule_conflicts(rules: DataFrame) -> DataFrame:
    """The values that have several codes, with their number, the least and the greatest."""
    known = rules.where(F.col(VALUE).isNotNull()).select(VALUE, CODE).distinct()
    found = known.groupBy(VALUE).agg(
        F.count(CODE).alias("codes"), F.min(CODE).alias("first"), F.max(CODE).alias("last")
    )
    return found.where("codes > 1")


def standardise_any(
    df: DataFrame,
    rules: DataFrame,
    column: str,
    match: Sequence[str],
    output: str,
    how: str = "inner",
) -> DataFrame:
    """As `standardise`, with rules that list several local values in ``match``.

    A rule applies once to a row however many of its columns hold the value.
    Each rule is spread to one row per different value first, so that this is
    an equality join and not one over all pairs.
    """
    values = F.array_distinct(F.array(*(F.col(name).cast("string") for name in match)))
    pairs = rules.select(F.explode(values).alias(_MATCH), F.col(output).alias(_STANDARD))
    return _replace(df, pairs, column, how)


def unmatched_values(df: DataFrame, rules: DataFrame, column: str) -> DataFrame:
    """The values of a column that no rule covers, with their row counts."""
    lone = equi_join(df.select(column), rules.select(VALUE), [(column, VALUE)], "leftanti")
    return lone.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def _replace(df: DataFrame, pairs: DataFrame, column: str, how: str) -> DataFrame:
    if how not in ("inner", "left"):
        raise ValueError("how is 'inner' or 'left'")
    joined = equi_join(df, pairs.where(F.col(_MATCH).isNotNull()), [(column, _MATCH)], how)
    return joined.drop(column, _MATCH).withColumnRenamed(_STANDARD, column)
