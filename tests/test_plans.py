from __future__ import annotations

import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from conform.functions import cipher_key, decrypt
from conform.plans import (
    AUDIT_SCHEMA,
    AuditRun,
    LoadResult,
    RunFailed,
    client_product,
    ingest,
    protected_load,
)
from conform.plans.clients import DOCUMENT_TEXT, document_types
from conform.sinks import save
from conform.sources import rows_frame
from tests.data import tuples

CLIENTS = (
    "ID_CLIENTE|TIPO_ID|NOMBRE CLIENTE|CORREO ELECTRONICO|CIUDAD|NUMERO CUENTA|"
    "FECHA ACTIVACION|ID_PROUCTO\r\n"
)
PRODUCTS = "ID_PRODUCTO;NOMBRE_PRODUCTO;FECHA_CREACION;ESTADO\r\n"
CODES = "TIPO_ID;VALOR\r\n1;CC\r\n2;CE\r\n3;PS\r\n4;TI\r\n"


@pytest.fixture
def inputs(tmp_path):
    (tmp_path / "ods_clientes_2018.csv").write_bytes(
        (CLIENTS + "83120457|1|Ana Ruiz|ana@x.co|Medellín|11|02/03/2018|1\r\n"
                   "7|4|Luz|null|Cali|12|1/01/2018|2\r\n").encode()
    )
    (tmp_path / "ods_clientes_2019.csv").write_bytes(
        (CLIENTS + "8|9|Eva|eva@x.co|Cali|13|02/03/2019|1\r\n"
                   "9|2|Sol|sol@x.co|Cali|14|02/03/2019|99\r\n"
                   "AB10|3|Paz|paz@x.co|Neiva|15|02/03/2019|3\r\n").encode()
    )
    (tmp_path / "productos.csv").write_bytes(
        (PRODUCTS + "1;Ahorros;1/01/2010;1\r\n2;CDT;2/01/2010;0\r\n3;Otro;3/01/2010;5\r\n").encode()
    )
    (tmp_path / "codigos.csv").write_bytes(CODES.encode())
    return tmp_path


def test_ingest(spark, inputs):
    out = inputs / "output"
    rows = ingest(
        spark, f"{inputs}/ods_clientes*.csv", f"{inputs}/codigos.csv",
        f"{inputs}/productos.csv", str(out),
    )
    assert rows == 3  # one client has an unknown document type, one an unknown product
    assert {path.name for path in out.iterdir() if path.is_dir()} == {
        "SCHEMA=Maestro", "SCHEMA=Transaccion", "SCHEMA=N%2FA"
    }
    df = spark.read.parquet(str(out)).orderBy("NUMERO_CUENTA")
    assert sorted(df.columns) == sorted([
        "NOMBRE", "EMAIL", "CIUDAD", "NUMERO_CUENTA", "FECHA_ACTIVACION", "NOMBRE_PRODUCTO",
        "FECHA_CREACION", "ESTADO", "DESC_ESTADO", "SCHEMA", "SHA-256",
    ])
    first = df.first().asDict()
    assert first == {
        "NOMBRE": "Ana Ruiz",
        "EMAIL": "ana@x.co",
        "CIUDAD": "Medellín",
        "NUMERO_CUENTA": "11",
        "FECHA_ACTIVACION": "02/03/2018",
        "NOMBRE_PRODUCTO": "Ahorros",
        "FECHA_CREACION": "1/01/2010",
        "ESTADO": 1,
        "DESC_ESTADO": "Activo",
        "SCHEMA": "Transaccion",
        "SHA-256": "a20011168dbc433f470293d6731e2ec607f717ba8aaaca2e019c309af4096bfe",
    }
    passport = df.where("NOMBRE = 'Paz'").first()["SHA-256"]
    assert passport == hashlib.sha256(b"PSAB10").hexdigest()
    others = df.select("EMAIL", "DESC_ESTADO", "SCHEMA").collect()[1:]
    assert others == [(None, "Inactivo", "Maestro"), ("paz@x.co", "Unknown", "N/A")]


def test_ingest_streams_clients_past_products(spark, inputs, monkeypatch, capsys):
    from conform.plans import clients

    lines = [f"{n}|1|Ana|a@x.co|Cali|{n}|02/03/2018|{n % 100}\r\n" for n in range(4000)]
    (inputs / "ods_clientes_2018.csv").write_text(CLIENTS + "".join(lines), newline="")
    lines = [f"{n % 100};Ahorros;1/01/2010;{n % 3}\r\n" for n in range(200)]
    (inputs / "productos.csv").write_text(PRODUCTS + "".join(lines), newline="")
    plans, write = [], clients.write_partitioned

    def explained(df, *args, **more):
        capsys.readouterr()
        df.explain()
        plans.append(capsys.readouterr().out)
        return write(df, *args, **more)

    monkeypatch.setattr(clients, "write_partitioned", explained)
    paths = (f"{inputs}/ods_clientes_2018.csv", f"{inputs}/codigos.csv", f"{inputs}/productos.csv")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2KB")
    try:
        rows = ingest(spark, *paths, str(inputs / "output"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == 8000
    assert "ShuffledHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]
    assert spark.conf.get("spark.sql.join.preferSortMergeJoin", None) is None


def test_ingest_sets_lines_that_do_not_fit_aside(spark, inputs):
    (inputs / "productos.csv").write_bytes(
        (PRODUCTS + "1;Ahorros;1/01/2010;1\r\ntwo;CDT;2/01/2010;0\r\n3;Otro\r\n").encode()
    )
    out, rejected = str(inputs / "output"), str(inputs / "rejected")
    paths = (f"{inputs}/ods_clientes*.csv", f"{inputs}/codigos.csv", f"{inputs}/productos.csv")
    assert ingest(spark, *paths, out, rejected) == 1
    assert sorted(map(tuple, spark.read.parquet(rejected).collect())) == [
        ("products", "3;Otro"), ("products", "two;CDT;2/01/2010;0")
    ]


def test_column_order_of_the_joined_clients(spark):
    clients = rows_frame(
        spark, [(1, 1, "n", "e", "c", 1, "d", 1)],
        "ID_CLIENTE int, TIPO_ID int, `NOMBRE CLIENTE` string, `CORREO ELECTRONICO` string, "
        "CIUDAD string, `NUMERO CUENTA` int, `FECHA ACTIVACION` string, ID_PROUCTO int",
    )
    codes = rows_frame(spark, [(1, "CC")], "TIPO_ID int, VALOR string")
    products = rows_frame(
        spark, [(1, "p", "f", 1)],
        "ID_PRODUCTO int, NOMBRE_PRODUCTO string, FECHA_CREACION string, ESTADO int",
    )
    assert client_product(clients, codes, products).columns == [
        "NOMBRE", "EMAIL", "CIUDAD", "NUMERO_CUENTA", "FECHA_ACTIVACION", "NOMBRE_PRODUCTO",
        "FECHA_CREACION", "ESTADO", "DESC_ESTADO", "SCHEMA", "SHA-256",
    ]


def test_document_types(spark):
    codes = rows_frame(spark, [(1, "CC"), (4, "TI"), (5, "XX")], "TIPO_ID int, VALOR string")
    assert tuples(document_types(codes)) == [
        (1, "CC", DOCUMENT_TEXT[1]), (4, "TI", DOCUMENT_TEXT[4]), (5, "XX", None)
    ]


@pytest.fixture
def audit_table(spark, tmp_path):
    name = f"audit_{uuid.uuid4().hex}"
    spark.catalog.createTable(name, str(tmp_path / name), "parquet", AUDIT_SCHEMA)
    yield name
    spark.sql(f"drop table if exists {name}")


def test_audit_statuses(spark, audit_table):
    run = AuditRun(spark, "a", "b", "start", forced=True)
    run.rows_origin, run.rows_loaded = 5, 4
    run.info("seen")
    run.info("kept", keep=True)
    run.append()
    run.warn("careful", keep=True)
    run.append()
    run.append("OK", "own text")
    assert run.save(audit_table)
    rows = spark.table(audit_table).orderBy("timestampEvento").collect()
    assert [(row.estado, row.descripcion, row.cantidadRegistrosCargados) for row in rows] == [
        ("Init", "start", 0), ("OK", "kept, ", 4), ("WARN", "kept, careful, ", 4),
        ("OK", "own text", 4),
    ]
    assert run.save(audit_table)
    assert spark.table(audit_table).count() == 4
    assert {row.idProceso for row in rows} == {run.run_id}
    assert all(row.cargaForzada and row.fechaEvento is not None for row in rows)


def test_the_date_is_that_of_the_session(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    run = AuditRun(spark, "a", "b")
    try:
        for other in ("Pacific/Kiritimati", "Pacific/Niue"):
            spark.conf.set("spark.sql.session.timeZone", other)
            same = F.expr("fechaEvento = to_date(timestampEvento)")
            assert run.rows().select(same).first()[0]
            assert run.rows().select(F.expr("fechaEvento = current_date()")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_failed_run(spark, audit_table):
    run = AuditRun(spark, "a", "b")
    run.rows_loaded = 9
    with pytest.raises(RunFailed, match="broken"):
        raise run.fail("broken", audit_table)
    last = spark.table(audit_table).where("estado = 'KO'").first()
    assert (last.descripcion, last.cantidadRegistrosCargados) == ("broken", 0)


def test_saving_the_audit_never_fails_the_run(spark, tmp_path):
    run = AuditRun(spark, "a", "b")
    assert not run.save("there_is_no_such_table")
    assert run.status == "WARN"
    name = f"other_{uuid.uuid4().hex}"
    save(spark.range(1), name, str(tmp_path / "t"))
    spark.sql(f"alter table {name} add columns (missing string)")
    assert not run.save(name)


@pytest.fixture
def load(spark, tmp_path, audit_table):
    rows = [("1", 10, "Ana", "0"), ("1", 11, "Luz", "0"), ("2", 10, "Eva", "0"),
            ("1", 10, "Ana", "0"), ("9", 12, "Sol", "0"), ("1", None, "Paz", "0")]
    source = f"clients_{uuid.uuid4().hex}"
    save(rows_frame(spark, rows, "tipo string, id int, nombre string, flag string"),
         source, str(tmp_path / "source"))
    rules = rows_frame(
        spark, [("CC", "1", "CLIENTES", "tipo"), ("CE", "2", "CLIENTES", "tipo")],
        "codigo_id string, homologacion string, tabla string, columna string",
    )
    names = {"source": source, "target": f"target_{uuid.uuid4().hex}",
             "vault": f"vault_{uuid.uuid4().hex}"}

    def run(**more) -> LoadResult:
        settings = {
            "target_location": str(tmp_path / "target"),
            "vault_location": str(tmp_path / "vault"), "rules": rules,
            "rules_name": "clientes", "standard_columns": ["tipo"],
            "groups": [["tipo", "id"]], "key": "0123456789abcdef", "audit_table": audit_table,
        }
        return protected_load(spark, **names, **(settings | more))

    yield run, names
    for name in names.values():
        spark.sql(f"drop table if exists {name}")


def test_protected_load(spark, load, audit_table, tmp_path):
    run, names = load
    assert run(flag_location=str(tmp_path / "flagged")) == LoadResult(6, 5, 3)
    target = spark.table(names["target"])
    assert target.columns == ["nombre", "flag", "HashValue1"]
    assert target.where("HashValue1 is null").select("nombre").collect() == [("Paz",)]
    key = cipher_key(spark, "0123456789abcdef")
    plain = spark.table(names["vault"]).select(decrypt(F.col("aesvalue"), key))
    assert tuples(plain) == [("CC10",), ("CC11",), ("CE10",)]
    assert spark.table(names["source"]).where("flag = '1'").count() == 5
    closed = spark.table(audit_table).where("estado = 'WARN'").first()
    assert closed.descripcion == "tipo: 1 rows with 1 values without a rule (9), "
    assert (closed.cantidadRegistrosOrigen, closed.cantidadRegistrosCargados) == (6, 5)


def test_a_second_load_adds_no_key_twice(spark, load, audit_table):
    run, names = load
    assert run(condition="id = 10").keys_added == 2
    assert run() == LoadResult(6, 5, 1)
    assert run() == LoadResult(6, 5, 0)
    assert spark.table(names["vault"]).count() == 3
    assert spark.table(audit_table).where("descripcion like 'no new keys, %'").count() == 1


def test_a_load_that_fails_after_the_vault_can_be_run_again(spark, load, audit_table, tmp_path):
    run, names = load
    save(rows_frame(spark, [(1,)], "other int"), names["target"], str(tmp_path / "wrong"))
    with pytest.raises(RunFailed, match="other"):
        run(flag_location=str(tmp_path / "flagged"))
    assert spark.table(names["vault"]).count() == 3
    assert spark.table(names["source"]).where("flag = '1'").count() == 0
    spark.sql(f"drop table {names['target']}")
    assert run() == LoadResult(6, 5, 0)
    assert spark.table(names["vault"]).count() == 3
    states = [row.estado for row in spark.table(audit_table).orderBy("timestampEvento").collect()]
    assert states == ["Init", "KO", "Init", "WARN"]


def test_a_load_without_rows_fails_and_is_recorded(spark, load, audit_table):
    run, names = load
    with pytest.raises(RunFailed):
        run(condition="id > 1000")
    assert not spark.catalog.tableExists(names["target"])
    assert spark.table(audit_table).where("estado = 'KO'").count() == 1


def test_the_key_is_not_in_the_audit_or_the_log(load, audit_table, spark, caplog):
    run, _ = load
    with caplog.at_level("DEBUG"):
        run()
    assert "0123456789abcdef" not in caplog.text
    text = spark.table(audit_table).select(F.to_json(F.struct("*"))).collect()
    assert "0123456789abcdef" not in str(text)


def test_a_named_load_is_repeated_until_it_is_whole(spark, load, audit_table, tmp_path):
    run, names = load
    with pytest.raises(RunFailed, match="nowhere"):
        run(run_name="r1", flag_location="nowhere://flags")
    assert spark.table(names["target"]).count() == 5
    assert spark.table(names["source"]).where("flag = '1'").count() == 0
    for _ in range(2):
        result = run(run_name="r1", flag_location=str(tmp_path / "flagged"))
        assert result == LoadResult(6, 5, 0)
    target = spark.table(names["target"])
    assert target.columns == ["nombre", "flag", "HashValue1", "load_run"]
    assert target.count() == 5 and spark.table(names["vault"]).count() == 3
    assert spark.table(names["source"]).where("flag = '1'").count() == 5
    told = spark.table(audit_table).where("descripcion like 'r1 was published before, %'")
    assert told.count() == 2
    assert run(run_name="r2", condition="id = 10").rows_loaded == 3
    assert spark.table(names["target"]).count() == 8


def test_a_load_lets_its_rows_go_and_takes_no_row_twice(spark, load, audit_table, tmp_path):
    run, names = load
    cache = spark._jsparkSession.sharedState().cacheManager()
    rules = rows_frame(
        spark, [("CC", "1", "CLIENTES"), ("XX", "1", "CLIENTES"), ("CE", "2", "CLIENTES")],
        "codigo_id string, homologacion string, tabla string",
    )
    assert run(rules=rules, target_format="orc", target_partitions=["flag"]) == LoadResult(6, 5, 3)
    assert cache.isEmpty()
    closed = spark.table(audit_table).where("estado = 'WARN'").first()
    assert "tipo: values with several codes (1)" in closed.descripcion
    about = spark.sql(f"describe extended {names['target']}")
    assert about.where("col_name = 'Provider'").first()["data_type"] == "orc"
    with pytest.raises(RunFailed, match="several codes for 1"):
        run(rules=rules, conflicts="refuse")
    assert cache.isEmpty()
    with pytest.raises(RunFailed, match="control table"):
        run(standard_columns=None)


def test_a_load_driven_by_a_control_table(spark, load):
    run, names = load
    control = rows_frame(
        spark, [("clients", "ID", "tipo"), ("clients", "other", "tipo,none"), ("x", None, None)],
        "a string, b string, c string",
    )
    assert run(standard_columns=None, groups=None, control=control) == LoadResult(6, 5, 3)
    target = spark.table(names["target"])
    assert target.columns == ["nombre", "flag", "HashValue1"]
    expected = hashlib.sha256(b"10CC").hexdigest()
    assert target.where("nombre = 'Ana'").first()["HashValue1"] == expected
