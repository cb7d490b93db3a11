"""The two loads, and what they leave in the vault and the audit table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.functions import cipher_key, decrypt
from conform.operators.protect import CIPHER, HASH
from conform.plans import (
    AUDIT_SCHEMA,
    AuditRun,
    RunFailed,
    client_product,
    ingest,
    protected_load,
)
from conform.queries.registry import fresh_name, query, scratch, table
from conform.queries.shared import RULES_SQL, TRIAL_KEY, catalog_table, rules_table
from conform.sinks import EmptyWriteError, save
from conform.sources import rows_frame

# The identity document codes.
_DOCUMENT_CODES = [(1, "CC"), (2, "CE"), (3, "PS"), (4, "TI")]

_CLIENT_PRODUCT_SQL = """
    with clients as (
        select case when l_linenumber = 3 then 'AB' else '' end || l_orderkey as id,
               l_linenumber as kind, 'Client ' || l_suppkey as "NOMBRE",
               'client' || l_suppkey || '@example.com' as "EMAIL", l_returnflag as "CIUDAD",
               cast(l_orderkey as varchar) as "NUMERO_CUENTA",
               strftime(l_shipdate, '%d/%m/%Y') as "FECHA_ACTIVACION", l_partkey as product
        from lineitem),
    products as (
        select p_partkey as id, p_name as "NOMBRE_PRODUCTO", p_brand as "FECHA_CREACION",
               case when p_type in ('STANDARD', 'PROMO') then 1
                    when p_type in ('ECONOMY', 'SMALL') then 0 else 2 end as "ESTADO"
        from part),
    codes as (
        select * from (values (1, 'CC'), (2, 'CE'), (3, 'PS'), (4, 'TI')) as c (id, code))
    select "NOMBRE", "EMAIL", "CIUDAD", "NUMERO_CUENTA", "FECHA_ACTIVACION", "NOMBRE_PRODUCTO",
           "FECHA_CREACION", "ESTADO",
           case "ESTADO" when 1 then 'Activo' when 0 then 'Inactivo' else 'Unknown' end
               as "DESC_ESTADO",
           case "ESTADO" when 0 then 'Maestro' when 1 then 'Transaccion' else 'N/A' end
               as "SCHEMA",
           sha256(code || c.id) as "SHA-256"
    from clients c
    join codes on c.kind = codes.id
    join products p on c.product = p.id
"""


def _client_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    supplier = F.col("l_suppkey").cast("string")
    order = F.col("l_orderkey").cast("string")
    letters = F.when(F.col("l_linenumber") == 3, "AB").otherwise("")  # as passports have
    clients = table(spark, sf_dir, "lineitem").select(
        F.concat(letters, order).alias("ID_CLIENTE"),
        F.col("l_linenumber").alias("TIPO_ID"),
        F.concat(F.lit("Client "), supplier).alias("NOMBRE CLIENTE"),
        F.concat(F.lit("client"), supplier, F.lit("@example.com")).alias("CORREO ELECTRONICO"),
        F.col("l_returnflag").alias("CIUDAD"),
        order.alias("NUMERO CUENTA"),
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("FECHA ACTIVACION"),
        F.col("l_partkey").alias("ID_PROUCTO"),
    )
    status = (
        F.when(F.col("p_type").isin("STANDARD", "PROMO"), 1)
        .when(F.col("p_type").isin("ECONOMY", "SMALL"), 0)
        .otherwise(2)
    )
    products = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ID_PRODUCTO"),
        F.col("p_name").alias("NOMBRE_PRODUCTO"),
        F.col("p_brand").alias("FECHA_CREACION"),
        status.alias("ESTADO"),
    )
    codes = rows_frame(spark, _DOCUMENT_CODES, "TIPO_ID int, VALOR string")
    return clients, codes, products


@query(_CLIENT_PRODUCT_SQL, name="client_product")
def joined_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return client_product(*_client_inputs(spark, sf_dir))


@query(_CLIENT_PRODUCT_SQL)
def client_product_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [scratch(spark, name) for name in ("clients", "codes", "products")]
    for df, path, sep in zip(_client_inputs(spark, sf_dir), paths, "|;;"):
        df.write.options(header=True, sep=sep, nullValue="null").csv(path)
    output = scratch(spark, "output")
    ingest(spark, *paths, output)
    return spark.read.parquet(output)


_SOURCE = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]

_LOADED_SQL = f"""
    with rules as (select distinct codigo_id, homologacion, columna from ({RULES_SQL}) as r
                   where tabla = 'ORDERS'),
    loaded as (
        select o_orderkey, o_totalprice, p.codigo_id as o_orderpriority,
               s.codigo_id || cast(o_custkey as varchar) as plain
        from orders
        join rules as p on p.columna = 'o_orderpriority' and p.homologacion = o_orderpriority
        join rules as s on s.columna = 'o_orderstatus' and s.homologacion = o_orderstatus
        where o_orderstatus <> 'P')
"""


def _load(spark: SparkSession, sf_dir: str, fail: bool = False, **more) -> dict[str, str]:
    """Load all orders but pending ones; the names of the tables written.

    With ``fail`` a first try has a place for its flags that no file system serves.
    """
    orders = table(spark, sf_dir, "orders").select(*_SOURCE).withColumn("flag", F.lit("0"))
    audit = fresh_name("audit")
    _create_audit_table(spark, audit)
    names = {
        "source": catalog_table(spark, orders, "orders"),
        "target": fresh_name("protected_orders"),
        "vault": fresh_name("vault"),
    }
    settings = {
        "target_location": scratch(spark, "target"),
        "vault_location": scratch(spark, "vault"),
        "rules": rules_table(spark, sf_dir),
        "standard_columns": ["o_orderpriority", "o_orderstatus"],
        "groups": [["o_orderstatus", "o_custkey"]],
        "key": TRIAL_KEY,
        "condition": "o_orderstatus <> 'P'",
        "rules_name": "orders",
        "by_column": True,
        "audit_table": audit,
    } | more
    if fail:
        try:
            protected_load(spark, **names, **settings, flag_location="nowhere://flags")
        except RunFailed:
            pass
        else:
            raise AssertionError("the first try should have failed")
    protected_load(spark, **names, **settings, flag_location=scratch(spark, "flagged"))
    return names | {"audit": audit}


def _create_audit_table(spark: SparkSession, name: str) -> None:
    spark.catalog.createTable(
        name, path=scratch(spark, "audit"), source="parquet", schema=AUDIT_SCHEMA
    )


@query(
    _LOADED_SQL
    + """
    select o_orderkey, o_totalprice, '0' as flag, o_orderpriority, sha256(plain) as "HashValue1"
    from loaded
    """,
    name="protected_load",
)
def loaded_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_load(spark, sf_dir)["target"])


@query(
    _LOADED_SQL
    + """
    select 'target' as written, o_orderkey, o_totalprice, '0' as flag, o_orderpriority,
           sha256(plain) as "HashValue1", 'monday' as load_run
    from loaded
    union all
    select 'vault', null, null, null, null, hashvalue, null
    from (select distinct sha256(plain) as hashvalue from loaded where plain is not null)
    union all
    select 'flagged', o_orderkey, null, '1', null, null, null
    from orders where o_orderkey in (select o_orderkey from loaded)
    """
)
def protected_load_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target, vault and flags after a try that failed at its flags and a second one."""
    names = _load(spark, sf_dir, fail=True, run_name="monday")
    rows = spark.table(names["target"]).withColumn("written", F.lit("target"))
    keys = spark.table(names["vault"]).select(
        F.lit("vault").alias("written"), F.col(HASH).alias("HashValue1")
    )
    flags = spark.table(names["source"]).where("flag = '1'")
    flags = flags.select(F.lit("flagged").alias("written"), "o_orderkey", "flag")
    return rows.unionByName(keys, True).unionByName(flags, True)


def _control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A control table as long as lineitem, with names that orders does not have."""
    lines = table(spark, sf_dir, "lineitem")
    number = F.col("l_linenumber")
    other = F.concat(F.lit("c"), F.col("l_orderkey").cast("string"))
    return lines.select(
        F.lit("orders").alias("source"),
        F.when(number == 1, "O_CUSTKEY").otherwise(other).alias("first"),
        F.when(number == 1, "o_orderstatus")
        .otherwise(F.concat(other, F.lit(",o_orderpriority")))
        .alias("second"),
    )


@query(
    _LOADED_SQL.replace(
        "s.codigo_id || cast(o_custkey as varchar)", "cast(o_custkey as varchar) || s.codigo_id"
    )
    + """
    select o_orderkey, o_totalprice, '0' as flag, o_orderpriority, sha256(plain) as "HashValue1"
    from loaded
    """
)
def protected_load_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = _control(spark, sf_dir)
    names = _load(spark, sf_dir, standard_columns=None, groups=None, control=control)
    return spark.table(names["target"])


@query(
    _LOADED_SQL
    + "select distinct sha256(plain) as hashvalue, plain from loaded where plain is not null"
)
def protected_load_vault(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = cipher_key(spark, TRIAL_KEY)
    vault = spark.table(_load(spark, sf_dir)["vault"])
    return vault.select(HASH, decrypt(F.col(CIPHER), key).alias("plain"))


@query(
    f"""
    with rules as (select * from ({RULES_SQL}) as r where tabla = 'ORDERS')
    select {", ".join(_SOURCE)},
           case when o_orderstatus <> 'P'
                and exists (select 1 from rules where columna = 'o_orderpriority'
                            and homologacion = o_orderpriority)
                then '1' else '0' end as flag
    from orders
    """
)
def protected_load_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_load(spark, sf_dir)["source"])


_AUDIT_COLUMNS = [
    "nombreProceso",
    "estado",
    "descripcion",
    "cantidadRegistrosOrigen",
    "cantidadRegistrosCargados",
    "cargaForzada",
]


@query(
    _LOADED_SQL
    + """
    select 'DataTransformation' as "nombreProceso", 'Init' as estado,
           'protected load' as descripcion, 0 as "cantidadRegistrosOrigen",
           0 as "cantidadRegistrosCargados", false as "cargaForzada", true as dated
    union all
    select 'DataTransformation', 'WARN',
           (select 'o_orderpriority: ' || count(*) || ' rows with '
                   || (count(distinct o_orderpriority)
                       + max(case when o_orderpriority is null then 1 else 0 end))
                   || ' values without a rule ('
                   || string_agg(distinct o_orderpriority, '; ' order by o_orderpriority) || '), '
            from orders
            where o_orderstatus <> 'P' and (o_orderpriority is null or o_orderpriority like '5%')),
           (select count(*) from orders where o_orderstatus <> 'P'),
           (select count(*) from loaded), false, true
    """
)
def audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = spark.table(_load(spark, sf_dir)["audit"])
    dated = F.col("fechaEvento") == F.to_date("timestampEvento")
    return audit.select(*_AUDIT_COLUMNS, dated.alias("dated"))


@query(
    """
    select estado, descripcion, "cantidadRegistrosOrigen", "cantidadRegistrosCargados"
    from (values (0, 'Init', 'refused load', 0), (1, 'WARN', 'first try, ', 1),
                 (2, 'KO', 'no lines to load', 1))
             as v (seq, estado, descripcion, counted),
         lateral (select v.counted * count(*) as "cantidadRegistrosOrigen",
                         cast(0 as bigint) as "cantidadRegistrosCargados" from lineitem) as c
    """
)
def audit_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = fresh_name("audit")
    _create_audit_table(spark, audit)
    lines = table(spark, sf_dir, "lineitem")
    run = AuditRun(spark, "lineitem", "nowhere", "refused load")
    run.rows_origin = lines.count()
    run.warn("first try", keep=True)
    run.append()
    try:
        save(lines.where("l_quantity < 0"), fresh_name("lines"), scratch(spark, "lines"))
    except EmptyWriteError:
        failed: RunFailed = run.fail("no lines to load", audit)
        assert isinstance(failed, RunFailed)
    return spark.table(audit).select(*_AUDIT_COLUMNS[1:5])
