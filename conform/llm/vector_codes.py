"""Vectors as short codes: each part's nearest entry in a codebook, found by a tree."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conform.llm.gnat import Gnat
from conform.llm.tables import stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
_MOST = (1 << 63) - 1
#: Sums of components, which may have 42 digits and more, travel in two parts.
_LOW = 10**30


@dataclass(frozen=True)
class Codebooks:
    """For each part of a vector its entries, whole numbers held as floats."""

    entries: list[np.ndarray]

    @property
    def width(self) -> int:
        return sum(book.shape[1] for book in self.entries)

    def decode(self, codes: list[str]) -> np.ndarray:
        """The vectors that codes stand for, as ``scale`` times their components."""
        numbers = [list(bytes.fromhex(code)) for code in codes]
        return np.array(
            [np.concatenate([b[n] for b, n in zip(self.entries, row)]) for row in numbers]
        ).reshape(len(codes), self.width)

    def digest(self) -> str:
        """SHA-256 of all components in order, as decimals joined by commas."""
        values = (x for book in self.entries for x in book.ravel().tolist())
        return hashlib.sha256(",".join(str(int(x)) for x in values).encode()).hexdigest()


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows whose vector and components are neither null nor infinite nor NaN."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * float(SCALE)) < float("inf"))
    )
    return df.where(F.col(vector).isNotNull() & finite)


def _scaled(column: pa.Array, width: int, scale: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(values * scale).reshape(len(column), width)


def _assigned(trees: list[Gnat], rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    pieces = np.split(rows, len(trees), axis=1)
    return [tree.nearest(piece) for tree, piece in zip(trees, pieces, strict=True)]


def _moved(rows: DataFrame, vector: str, books: Codebooks, scale: int) -> Codebooks:
    """The codebooks after one round; entries without any part stay as they are.

    A task sums up its rows by entry, so what is shuffled and what the driver gets is
    as many rows as there are entries, whatever the number of vectors.
    """
    width, parts = books.width, len(books.entries)
    size = width // parts
    schema = (
        "part int, entry int, held long, tops array<decimal(38,0)>, sums array<decimal(38,0)>"
    )
    types = pa.schema(
        [
            ("part", pa.int32()),
            ("entry", pa.int32()),
            ("held", pa.int64()),
            ("tops", pa.list_(pa.decimal128(38, 0))),
            ("sums", pa.list_(pa.decimal128(38, 0))),
        ]
    )
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in shared.value.entries]
        held = [np.zeros(len(book), np.int64) for book in shared.value.entries]
        totals = [[[0] * size for _ in book] for book in shared.value.entries]
        for batch in batches:
            block = _scaled(batch.column(0), width, scale)
            exact = np.abs(block).max(initial=0.0) * max(len(block), 1) < 2.0**53
            pieces = np.split(block, parts, axis=1)
            for part, (found, _) in enumerate(_assigned(trees, block)):
                held[part] += np.bincount(found, minlength=len(held[part]))
                order = np.argsort(found, kind="stable")
                starts = np.flatnonzero(np.diff(found[order], prepend=-1))
                piece = pieces[part][order]
                if not exact:
                    piece = np.array([[int(x) for x in row] for row in piece.tolist()], object)
                for entry, sums in zip(found[order][starts], np.add.reduceat(piece, starts)):
                    total = totals[part][entry]
                    totals[part][entry] = [a + int(b) for a, b in zip(total, sums)]
        found = [
            (
                part,
                entry,
                int(count),
                [Decimal(x // _LOW) for x in totals[part][entry]],
                [Decimal(x % _LOW) for x in totals[part][entry]],
            )
            for part, counts in enumerate(held)
            for entry, count in enumerate(counts)
            if count
        ]
        columns = list(zip(*found, strict=True)) if found else [()] * len(types)
        arrays = [pa.array(c, type=f.type) for c, f in zip(columns, types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, schema=types)

    sums = [
        F.sum(F.col(name)[at]).alias(f"{name}{at}")
        for name in ("tops", "sums")
        for at in range(size)
    ]
    met = rows.select(vector).mapInArrow(summed, schema).groupBy("part", "entry")
    moved = [book.copy() for book in books.entries]
    # As many rows as the codebooks have entries.
    for row in met.agg(F.sum("held").alias("held"), *sums).collect():
        total = [int(row[f"tops{at}"]) * _LOW + int(row[f"sums{at}"]) for at in range(size)]
        moved[row["part"]][row["entry"]] = [float(x // row["held"]) for x in total]
    return Codebooks(moved)


def trained(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Codebooks | None:
    """Codebooks of `usable` rows, None without any.

    They start as the parts of the rows with the smallest keys; of equal keys the row
    with the smaller vector comes first, null keys come last. The driver holds no more
    than the codebooks.
    """
    first = rows.select(key, vector).orderBy(F.asc_nulls_last(key), vector).limit(entries)
    start = [row[vector] for row in first.collect()]
    if not start:
        return None
    whole = np.floor(np.array(start, np.float64) * scale)
    books = Codebooks([piece.copy() for piece in np.split(whole, parts, axis=1)])
    for _ in range(rounds):
        books = _moved(rows, vector, books, scale)
    return books


def encoded(
    rows: DataFrame,
    books: Codebooks,
    columns: list[str],
    vector: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """The given columns with ``code`` and ``error``, every row by itself.

    An error too large for a long is given as the largest one.
    """
    shared = rows.sparkSession.sparkContext.broadcast(books)
    kept = rows.select(*columns, vector)
    fields = [f"`{name}` {kind}" for name, kind in kept.dtypes[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(book) for book in shared.value.entries]
        for batch in batches:
            block = _scaled(batch.column(len(columns)), shared.value.width, scale)
            found = _assigned(trees, block)
            numbers = np.stack([n for n, _ in found], axis=1).astype(np.uint8)
            error = [min(sum(map(int, row)), _MOST) for row in zip(*(e for _, e in found))]
            arrays = [
                *batch.columns[: len(columns)],
                pa.array([row.tobytes().hex() for row in numbers], type=pa.string()),
                pa.array(error, type=pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "code", "error"])

    return kept.mapInArrow(run, ", ".join([*fields, "code string", "error long"]))


def vector_codes(
    embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """Codes of all usable vectors, their errors, and the digest of the codebooks.

    Components become ``floor(1024 x)``. Rows whose vector is null or has null or
    non-finite components are left out, and so are those that have another length than
    most (the longest, of equally frequent lengths) or one that does not make four equal
    parts, as no codebook fits them. Repeated rows and keys stay, each with its code. Equal
    labels share the sum of their errors, null labels too. An empty table gives an empty
    result. Other columns are not looked at.
    """
    sized = usable(embeddings, vector).select(key, vector, label)
    sized = stored(sized.withColumn("_width", F.size(vector)), "vectors")
    whole = sized.where(f"_width > 0 and _width % {PARTS} = 0")
    common = whole.groupBy("_width").count().orderBy(F.desc("count"), F.desc("_width")).first()
    rows = whole.where(F.col("_width") == (common["_width"] if common else 0))
    books = trained(rows, key, vector)
    if books is None:
        empty = rows.select(key, label).withColumns(
            {"code": F.lit(""), "error": F.lit(0).cast("long")}
        )
        return _told(empty, key, label, "")
    return _told(encoded(rows, books, [key, label], vector), key, label, books.digest())


def _told(codes: DataFrame, key: str, label: str, digest: str) -> DataFrame:
    codes = stored(codes, "codes")
    # Partial sums meet before the shuffle, however many rows share a label.
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_MOST))
    by_label = codes.groupBy(F.col(label).alias("_label")).agg(
        total.cast("long").alias("label_error")
    )
    joined = codes.join(by_label, F.col(label).eqNullSafe(F.col("_label")))
    return joined.select(
        F.col(key), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
