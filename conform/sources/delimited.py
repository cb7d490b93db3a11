"""Delimited text files."""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from conform.sources.rows import empty_frame

#: The line of a rejected row, in what `read_delimited_checked` returns, the file it is
#: in, and where in the file the stretch of bytes begins that its task read.
RECORD, FILE, BLOCK = "rejected_record", "rejected_file", "rejected_block"


class TooManyRejectedError(ValueError):
    """More lines were rejected than a load may leave out."""


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = "|",
    schema: StructType | str | None = None,
    infer: bool = False,
    null_token: str = "null",
    **options: str | bool | int,
) -> DataFrame:
    """Read delimited files with a header; ``path`` may be a glob.

    Give a ``schema`` for anything large. ``infer=True`` costs one more pass
    over all the files; with neither, every column is a string.

    All files of a glob are read by position, so each file's own header is
    checked against the schema (``enforceSchema=False``): a file with its
    columns in another order fails instead of landing under wrong names. Further
    ``options`` go to Spark's reader (``encoding``, ``quote``, ``escape``, ``mode``, …).
    A field that does not fit its type is null; see `read_delimited_checked`.
    """
    if schema is not None and infer:
        raise ValueError("give a schema or infer=True, not both")
    reader = spark.read.options(
        header=True,
        sep=sep,
        nullValue=null_token,
        enforceSchema=False,
        inferSchema=infer,
    ).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_delimited_checked(
    spark: SparkSession,
    path: str | list[str],
    sep: str,
    schema: StructType | str,
    null_token: str = "null",
    **options: str | bool | int,
) -> tuple[DataFrame, DataFrame]:
    """The rows that fit the schema, and those that do not.

    A row is rejected if a field does not fit its type or if it has too few or too
    many fields. Rejected rows come with what could be read of them, the whole line
    in ``rejected_record``, its file in ``rejected_file`` and in ``rejected_block`` the
    byte from which the task read that had it. Each of the two frames reads the files
    when it is used. `refuse_rejected` stops a load that leaves out too many.
    """
    kinds = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    marked = StructType([*kinds.fields]).add(RECORD, StringType())
    rows = read_delimited(
        spark,
        path,
        sep,
        marked,
        null_token=null_token,
        **{**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RECORD},
    )
    # Always true, but it names every column: Spark judges only the fields it reads.
    rows = rows.where(F.xxhash64(*(F.col(f"`{name}`") for name in kinds.names)) >= -(1 << 63))
    good = rows.where(F.col(RECORD).isNull()).drop(RECORD)
    rejected = rows.where(F.col(RECORD).isNotNull()).select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
    )
    return good, rejected


def refuse_rejected(rejected: DataFrame, most: int) -> int:
    """The number of rejected rows, at most ``most``; beyond that an error with examples.

    Reading stops soon after the limit is passed.
    """
    shown = rejected.select(FILE, RECORD).limit(most + 1)
    count = shown.count()
    if count > most:
        examples = "; ".join(f"{row[FILE]}: {row[RECORD]}" for row in shown.limit(3).collect())
        raise TooManyRejectedError(f"more than {most} lines do not fit ({examples})")
    return count


def read_delimited_by_header(
    spark: SparkSession,
    path: str | list[str],
    sep: str = "|",
    schema: StructType | str | None = None,
    null_token: str = "null",
    **options: str | bool | int,
) -> DataFrame:
    """Read delimited files whose headers differ, and put their columns together by name.

    The header of every file is read first, by a pass over the lines as text. Files
    with the same header, blanks around names aside, are read together by it, and the
    groups are joined by name; a column that a file lacks is null there. With a
    ``schema`` the result has its columns and types, and others are left out; without,
    it has all columns, as text, in the order in which sorted headers name them. Headers
    may spell names in other case. The driver gets the files' names, as it does to list
    them. A file without any line is left out; without any file with a header the
    result has no rows.
    """
    quote = str(options.get("quote", '"'))
    kinds = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    lines = spark.read.text(path, **_text_options(options)).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    # A file's first stretch is read by one task, in order, so its least number is the first.
    first = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "place").alias("header"))
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in first.orderBy("file").collect():
        names = next(csv.reader([row["header"]], delimiter=sep, quotechar=quote))
        key = tuple(name.strip().lstrip("\ufeff") for name in names)
        groups.setdefault(key, []).append(unquote(row["file"]))
    wanted = kinds or _all_names(groups)
    known = {field.name.lower(): field for field in wanted}
    parts = []
    for names, files in sorted(groups.items()):
        fields = [known.get(n.lower(), StructField(n, StringType())) for n in names]
        given = StructType([StructField(f.name, f.dataType) for f in fields])
        # The header was matched already, and the reader need not compare it again.
        settings = {"enforceSchema": True, **options}
        part = read_delimited(spark, files, sep, given, null_token=null_token, **settings)
        parts.append(part.select(*(f"`{f.name}`" for f in fields if f.name.lower() in known)))
    none = empty_frame(spark, wanted)
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts, none)
    return united.select(*(f"`{name}`" for name in wanted.names))


def _all_names(groups: dict[tuple[str, ...], list[str]]) -> StructType:
    fields: dict[str, StructField] = {}
    for names in sorted(groups):
        for name in names:
            fields.setdefault(name.lower(), StructField(name, StringType()))
    return StructType(list(fields.values()))


def _text_options(options: dict) -> dict:
    """What a reader of lines needs to know of the options for delimited files."""
    return {name: options[name] for name in ("encoding", "lineSep") if name in options}
