"""Ingest clients with their products: clean, look up, join, route, hash, write."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.functions import value_map
from conform.operators import clean_headers, equi_join, hash_and_drop
from conform.sinks import write_partitioned
from conform.sinks.settings import preset
from conform.sources import read_delimited, read_delimited_checked, refuse_rejected
from conform.sources.delimited import RECORD

# Column names, codes and texts of the input and output files.
CLIENT_SCHEMA = (
    "`ID_CLIENTE` string, `TIPO_ID` int, `NOMBRE CLIENTE` string, "
    "`CORREO ELECTRONICO` string, `CIUDAD` string, `NUMERO CUENTA` string, "
    "`FECHA ACTIVACION` string, `ID_PROUCTO` bigint"
)
PRODUCT_SCHEMA = (
    "`ID_PRODUCTO` bigint, `NOMBRE_PRODUCTO` string, `FECHA_CREACION` string, `ESTADO` int"
)
CODE_SCHEMA = "`TIPO_ID` int, `VALOR` string"
STATUS_TEXT = {1: "Activo", 0: "Inactivo"}
OTHER_STATUS = "Unknown"
DOCUMENT_TEXT = {
    1: "Cedula de Ciudadania",
    2: "Cedula de Extrangeria",
    3: "Pasaporte",
    4: "Tarjeta de Identidad",
}
ROUTE = """
    case when ESTADO = 0 then 'Maestro'
         when ESTADO = 1 then 'Transaccion'
         else 'N/A' end
"""
ROUTE_COLUMN = "SCHEMA"
HASH_COLUMN = "SHA-256"
# Where products are too many to broadcast, a task holds its share of them in a hash table
# and streams clients by, instead of sorting both. Spark does so only where products are
# far fewer than clients and their share fits a broadcast; otherwise it sorts.
STREAMED = {"spark.sql.join.preferSortMergeJoin": "false"}


def document_types(codes: DataFrame) -> DataFrame:
    """The identity document codes under clear names, with a description."""
    return codes.withColumnsRenamed(
        {"VALOR": "TIPO_IDENTIFICACION", "TIPO_ID": "ID_TIPO"}
    ).withColumn("DESCRIPCION", value_map(F.col("ID_TIPO"), DOCUMENT_TEXT))


def described_products(products: DataFrame) -> DataFrame:
    return products.withColumn(
        "DESC_ESTADO", value_map(F.col("ESTADO"), STATUS_TEXT, OTHER_STATUS)
    )


def client_product(clients: DataFrame, codes: DataFrame, products: DataFrame) -> DataFrame:
    """One row per client and product, routed, the identity hashed.

    A client without a known document type or product is left out.
    """
    typed = equi_join(
        clean_headers(clients), document_types(codes), [("TIPO_ID", "ID_TIPO")]
    ).select(
        "ID_CLIENTE",
        "TIPO_IDENTIFICACION",
        F.col("NOMBRE_CLIENTE").alias("NOMBRE"),
        F.col("CORREO_ELECTRONICO").alias("EMAIL"),
        "CIUDAD",
        "NUMERO_CUENTA",
        "FECHA_ACTIVACION",
        "ID_PROUCTO",
    )
    joined = equi_join(typed, described_products(products), [("ID_PROUCTO", "ID_PRODUCTO")])
    return joined.withColumn(ROUTE_COLUMN, F.expr(ROUTE)).transform(
        hash_and_drop,
        ["TIPO_IDENTIFICACION", "ID_CLIENTE"],
        HASH_COLUMN,
        drop=["ID_CLIENTE", "TIPO_IDENTIFICACION", "ID_PROUCTO", "ID_PRODUCTO"],
    )


def ingest(
    spark: SparkSession,
    clients: str,
    codes: str,
    products: str,
    output: str,
    rejected: str | None = None,
    most_rejected: int | None = None,
) -> int:
    """Read the three kinds of files and write the result, partitioned by route.

    Returns the rows written. ``clients`` may be a glob. Fields that do not fit their
    column are null. With ``rejected``, a path, lines with such fields, or with too few
    or too many, are left out and written there as Parquet, each with its kind of file;
    the load stops before it writes its output if one kind has more than
    ``most_rejected`` of them.
    """
    files = {
        "clients": (clients, "|", CLIENT_SCHEMA),
        "codes": (codes, ";", CODE_SCHEMA),
        "products": (products, ";", PRODUCT_SCHEMA),
    }
    if rejected is None:
        frames = [read_delimited(spark, *file) for file in files.values()]
    else:
        checked = {kind: read_delimited_checked(spark, *file) for kind, file in files.items()}
        frames = [good for good, _ in checked.values()]
        lines = [
            bad.select(F.lit(kind).alias("file"), F.col(RECORD).alias("record"))
            for kind, (_, bad) in checked.items()
        ]
        reduce(DataFrame.unionByName, lines).write.mode("overwrite").parquet(rejected)
        if most_rejected is not None:
            for _, bad in checked.values():
                refuse_rejected(bad, most_rejected)
    joined = client_product(*frames)
    # There are three routes, so gathering each would move all rows to save few files.
    with preset(spark, STREAMED):
        return write_partitioned(joined, output, [ROUTE_COLUMN], cluster=False)
