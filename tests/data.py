"""Small literal inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from conform.sources import rows_frame

SHIP = "struct<maker:string,series:string,hull:string>"


def ships(spark: SparkSession) -> DataFrame:
    """Nested rows with trailing blanks, an empty number, and a crew that is none."""
    rows = [
        (("Norda ", "", "K-12"), "PX-204", "cargo", 18),
        (("Velu", "Mark II", ""), "PX-377", "ferry", 42),
        (("Ostrava ", "", "T-9"), "", "tug", -5),
        (("Velu", "Mark I", "K-3"), "PX-118", "ferry", 42),
    ]
    return rows_frame(spark, rows, f"ship {SHIP}, number string, kind string, crew int")


def routes(spark: SparkSession) -> DataFrame:
    """Nested rows with arrays that share items."""
    rows = [
        (("Norda", "", "K-12"), ["Bergen", "Oslo"], "north", "cargo"),
        (("Velu", "Mark II", ""), ["Oslo", "Kiel", "Riga"], "east", "ferry"),
        (("Velu", "Mark I", "K-3"), ["Kiel", "Riga"], "east", "cargo"),
        (("Ostrava", "", "T-9"), ["Bergen"], "north", "tug"),
        (("Ostrava", "", "T-10"), [], "east", "cargo"),
    ]
    return rows_frame(spark, rows, f"ship {SHIP}, ports array<string>, sea string, kind string")


def parcels(spark: SparkSession) -> DataFrame:
    """Depots as text; two parcels go to depots that are not listed, one follows no other."""
    rows = [
        (101, "lamp", None, "7", 250),
        (102, "desk", 101, "7", 900),
        (103, "vase", 101, "9", 120),
        (104, "rug", 103, "31", 900),
        (105, "sofa", 103, "7", -1),
        (106, "bowl", 999, "44", 60),
        (107, "sofa", 102, "12", 300),
    ]
    return rows_frame(
        spark, rows, "parcel int, item string, follows int, depot string, price int"
    )


def depots(spark: SparkSession) -> DataFrame:
    """Depots as numbers; one gets no parcel."""
    rows = [("Hafen", 7), ("Nord", 9), ("Markt", 12), ("West", 18)]
    return rows_frame(spark, rows, "place string, depot_id int")


def tuples(df: DataFrame) -> list[tuple]:
    """The rows as sorted tuples, nulls first."""
    rows = [tuple(row) for row in df.collect()]
    return sorted(rows, key=lambda row: [(value is not None, str(value)) for value in row])


def plan_of(df: DataFrame, capsys, mode: str = "formatted") -> str:
    capsys.readouterr()
    df.explain(mode)
    return capsys.readouterr().out
