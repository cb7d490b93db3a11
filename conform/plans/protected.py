"""Load a catalog table: standardise, protect, keep the vault, write, audit."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from conform.functions import cipher_key
from conform.operators import (
    control_columns,
    control_pairs,
    protect,
    rule_conflicts,
    rules_for,
    standardise,
    vault_delta,
)
from conform.operators.protect import VAULT_SCHEMA
from conform.operators.standardise import VALUE
from conform.plans.audit import AuditRun
from conform.sinks import EmptyWriteError, insert, save, save_run, update_flag
from conform.sinks.runs import published_partitions, run_rows
from conform.sources import kept, read_table, read_table_or_empty

#: Values without a rule, or with several, that the audit names.
_NAMED = 5
_WAS = "__was"


@dataclass(frozen=True)
class LoadResult:
    """The rows read, the rows written, and the keys added to the vault."""

    rows_read: int
    rows_loaded: int
    keys_added: int


def standardise_columns(
    df: DataFrame,
    rules: DataFrame,
    table: str,
    columns: Sequence[str],
    by_column: bool = False,
    how: str = "inner",
    conflicts: str = "all",
) -> DataFrame:
    """Standardise several columns by the rules of one table.

    ``by_column`` keeps each column to the rules that name it; otherwise all
    rules of the table apply to all of the columns. ``how`` and ``conflicts`` are those of
    `standardise`.
    """
    for column in columns:
        chosen = rules_for(rules, table, column if by_column else None)
        df = standardise(df, chosen, column, how, conflicts)
    return df


def protected_load(
    spark: SparkSession,
    source: str,
    target: str,
    target_location: str,
    vault: str,
    vault_location: str,
    rules: DataFrame,
    standard_columns: Sequence[str] | None = None,
    groups: Sequence[Sequence[str]] | None = None,
    key: str | bytes = "",
    condition: Column | str | None = None,
    rules_name: str | None = None,
    by_column: bool = False,
    flag_location: str | None = None,
    audit_table: str | None = None,
    run_name: str | None = None,
    control: DataFrame | None = None,
    conflicts: str = "first",
    target_format: str = "parquet",
    target_partitions: Sequence[str] = (),
) -> LoadResult:
    """Load the rows of ``source`` that meet ``condition`` into ``target``.

    ``standard_columns`` are replaced by their codes, under the rules for
    ``rules_name`` (the source's own name if not given), the columns of ``groups``
    by hashes; keys not in the vault yet are added to it, encrypted. Where one of the two
    is not given, it comes from a ``control`` table, see `control_columns` and
    `control_pairs`. A value with several codes gets the least one and the run warns of
    it, unless ``conflicts`` says otherwise, see `standardise`; no row is loaded twice.

    With a ``flag_location`` the source rows are flagged as loaded, see `update_flag`. Rows
    with a value that no rule covers are neither loaded nor flagged, and the run
    warns of them. With an ``audit_table`` the run is recorded there.

    The source is read and standardised once; its rows stay on the executors for the
    counts, the vault and the target, and are let go at the end. The vault is written
    first: if a later step fails, a second run finds its keys there and adds none twice.
    With a ``run_name`` the target is partitioned by runs, see `save_run`, and a load
    that failed at any step can be repeated under its name: what was published is not
    written again, and only the flags that are missing are set. The source must be the
    same for all tries. Without one a repeated load adds its rows again. The target, its
    vault and the flags of the source must have one writer at a time. A vault that
    does not exist yet is made without buckets, see `create_vault`.
    """
    run = AuditRun(spark, source, target, "protected load")
    added = loaded = 0
    try:
        frame = read_table(spark, source, condition)
        if standard_columns is None:
            standard_columns = _from(control, control_columns, frame)
        if groups is None:
            groups = _from(control, control_pairs, frame)
        named = rules_name or source.rpartition(".")[2]
        covered = {
            column: rules_for(rules, named, column if by_column else None)
            for column in standard_columns
        }
        if run_name and published_partitions(spark, target, run_name):
            run.rows_origin = frame.count()
            loaded = run_rows(spark, target, run_name)
            run.info(f"{run_name} was published before", keep=True)
        else:
            with kept(_coded(frame, covered, conflicts)) as rows:
                run.rows_origin = rows.count()
                warnings = _warnings(rows, covered, conflicts)
                ready = _loadable(rows, covered)
                secret = cipher_key(spark, key)
                known = read_table_or_empty(spark, vault, VAULT_SCHEMA)
                delta = vault_delta(ready, groups, secret, known)
                added = _append_keys(delta, vault, vault_location)
                if not added:
                    run.info("no new keys", keep=True)
                hashed = protect(ready, groups, drop=True)
                to = (target, target_location)
                if run_name:
                    loaded = save_run(hashed, *to, run_name, target_format, target_partitions)
                else:
                    loaded = _write(hashed, *to, target_format, target_partitions)
                for told in warnings:
                    run.warn(told, keep=True)
        run.rows_loaded = loaded
        if flag_location is not None:
            update_flag(
                spark,
                source,
                F.lit(True) if condition is None else condition,
                flag_location,
                among=[(column, chosen.select(VALUE)) for column, chosen in covered.items()],
                resume=run_name is not None,
            )
    except Exception as failure:  # a failed job is no PySparkException
        raise run.fail(f"could not load {target}: {failure}", audit_table) from failure
    run.append()
    if audit_table is not None:
        run.save(audit_table)
    return LoadResult(run.rows_origin, loaded, added)


def _from(control: DataFrame | None, read: Callable, frame: DataFrame) -> list:
    if control is None:
        raise ValueError("give the columns to work on or a control table")
    return read(control, frame.columns)


def _coded(frame: DataFrame, covered: dict[str, DataFrame], conflicts: str) -> DataFrame:
    """The rows with codes in place of values, null without a rule, and the values aside."""
    for number, (column, chosen) in enumerate(covered.items()):
        frame = frame.withColumn(f"{_WAS}{number}", F.col(f"`{column}`"))
        frame = standardise(frame, chosen, column, "left", conflicts)
    return frame


def _loadable(rows: DataFrame, covered: dict[str, DataFrame]) -> DataFrame:
    """The rows whose values all have a code, as `_coded` made them."""
    for column in covered:
        rows = rows.where(F.col(f"`{column}`").isNotNull())
    return rows.drop(*(f"{_WAS}{number}" for number in range(len(covered))))


def _warnings(
    rows: DataFrame, covered: dict[str, DataFrame], conflicts: str
) -> list[str]:
    """Which values no rule covers, on how many rows, and which rules conflict; few by name."""
    if not covered:
        return []
    names = list(covered)
    marks = F.array(
        *(
            F.struct(
                F.lit(number).alias("at"),
                F.col(f"{_WAS}{number}").cast("string").alias("value"),
                F.col(f"`{name}`").isNull().alias("lost"),
            )
            for number, name in enumerate(names)
        )
    )
    lost = rows.select(F.explode(F.filter(marks, lambda mark: mark["lost"])).alias("mark"))
    values = lost.groupBy("mark.at", "mark.value").agg(F.count("*").alias("rows"))
    # A row for each column at most; the names are cut to the first few in every task.
    totals = values.groupBy("at").agg(F.count("*").alias("values"), F.sum("rows").alias("rows"))
    first = Window.partitionBy("at").orderBy("value")
    some = values.where("value is not null").withColumn("place", F.row_number().over(first))
    found = totals.orderBy("at").collect()
    told: dict[int, list[str]] = {row["at"]: [] for row in found}
    if found:
        for row in some.where(F.col("place") <= _NAMED).orderBy("at", "place").collect():
            told[row["at"]].append(row["value"])
    texts = [
        f"{names[row['at']]}: {row['rows']} rows with {row['values']} values without a rule "
        f"({'; '.join(told[row['at']])})"
        for row in found
    ]
    if conflicts in ("first", "report"):
        for name, chosen in covered.items():
            several = rule_conflicts(chosen).orderBy(VALUE).limit(_NAMED).collect()
            if several:
                listed = "; ".join(str(row[VALUE]) for row in several)
                texts.append(f"{name}: values with several codes ({listed})")
    return texts


def _append_keys(keys: DataFrame, vault: str, location: str) -> int:
    try:
        return _write(keys, vault, location)
    except EmptyWriteError:
        return 0


def _write(
    df: DataFrame,
    table: str,
    location: str,
    table_format: str = "parquet",
    partitions: Sequence[str] = (),
) -> int:
    if df.sparkSession.catalog.tableExists(table):
        return insert(df, table)
    return save(df, table, location, table_format, partitions)
