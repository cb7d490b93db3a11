"""Vector codes against plain Python, and the tree against all pairs."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from conform.llm import ORACLE_SQL
from conform.llm.gnat import Gnat
from conform.llm.vector_codes import encoded, trained, usable, vector_codes
from tests.oracle import connect, differences

SCHEMA = "vec_id long, embedding array<float>, label int, code string, _width int"


def vectors():
    draw = random.Random(11)
    rows = [
        (i, [round(draw.uniform(-1, 1), 3) for _ in range(8)], draw.choice([1, 2, None]), "c", 1)
        for i in range(400)
    ]
    rows[7] = (7, None, 1, "c", 1)
    rows[8] = (8, [1.0, None] * 4, 1, "c", 1)
    rows[9] = (9, [float("nan")] + [0.0] * 7, None, "c", 1)
    rows[10] = (10, [float("-inf")] + [0.0] * 7, 2, "c", 1)
    rows[12] = (12, *rows[11][1:])  # equal vectors
    rows[14] = (13, *rows[14][1:])  # a repeated id
    rows += [rows[20], rows[20]]  # repeated rows
    return rows


def expected(rows):
    def bad(v):
        return v is None or any(x is None or not math.isfinite(x) for x in v)

    held = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in v], label)
        for i, v, label, *_ in sorted(rows, key=lambda r: (r[0], str(r[1])))
        if not bad(v)
    ]
    held.sort(key=lambda r: (r[0], r[1]))
    size = len(held[0][1]) // 4
    parts = [[v[p * size : (p + 1) * size] for _, v, _ in held] for p in range(4)]
    books = [[list(v) for v in part[:256]] for part in parts]

    def nearest(book, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), n) for n, e in enumerate(book))

    for _ in range(4):
        for p in range(4):
            found = [nearest(books[p], v)[1] for v in parts[p]]
            for n in set(found):
                own = [v for v, f in zip(parts[p], found) if f == n]
                books[p][n] = [sum(column) // len(own) for column in zip(*own)]
    near = [[nearest(books[p], v) for v in parts[p]] for p in range(4)]
    errors = [sum(near[p][i][0] for p in range(4)) for i in range(len(held))]
    by_label: dict = {}
    for (_, _, label), error in zip(held, errors):
        by_label[label] = by_label.get(label, 0) + error
    digest = ",".join(str(x) for book in books for entry in book for x in entry)
    digest = hashlib.sha256(digest.encode()).hexdigest()
    return sorted(
        (i, "".join(f"{near[p][n][1]:02x}" for p in range(4)), errors[n], by_label[label], digest)
        for n, (i, _, label) in enumerate(held)
    )


def test_vector_codes_match_plain_python(spark):
    rows = vectors()
    found = vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, found.collect())) == expected(rows)


def test_awkward_vectors(spark, tmp_path):
    rows = [
        (None, [0.5] * 8, None, "c", 1),
        (2, [0.25] * 8, 3, "c", 1),
        (3, [0.5] * 12, 3, "c", 1),  # another length
        (4, [0.5] * 7, 3, "c", 1),  # no four parts
        (5, [], 3, "c", 1),
        (6, [3e38] * 8, 4, "c", 1),  # an error beyond any long
        (7, [-3e38] * 8, 4, "c", 1),
    ]
    found = vector_codes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.vec_id or 0 for r in found) == [0, 2, 6, 7]
    assert {r.error for r in found} == {0}
    only_bad = spark.createDataFrame(rows[3:5], SCHEMA)
    assert vector_codes(only_bad).collect() == []


def test_codes_stand_for_near_vectors(spark, sf_dir):
    rows = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    books = trained(rows)
    found = encoded(rows.limit(20), books, ["vec_id", "embedding"]).collect()
    vectors = books.decode([r.code for r in found])
    for r, near in zip(found, vectors):
        whole = np.floor(np.array(r.embedding, float) * 1024)
        assert ((whole - near) ** 2).sum() == r.error


@pytest.mark.parametrize("reach", [2, 300, 1 << 26, 1 << 40])
def test_tree_finds_what_all_pairs_find(reach):
    draw = np.random.default_rng(reach)
    points = np.floor(draw.normal(size=(256, 3)) * reach)
    points[200:] = points[:56]  # equal points: the first counts
    queries = np.floor(draw.normal(size=(300, 3)) * reach)
    queries[:50] = points[100:150]
    found, apart = Gnat(points).nearest(queries)
    for q, number, squared in zip(queries.tolist(), found, apart):
        all_pairs = [sum(int(a - b) ** 2 for a, b in zip(q, p)) for p in points.tolist()]
        assert int(squared) == min(all_pairs)
        assert number == all_pairs.index(min(all_pairs))


def test_tree_leaves_subtrees_out():
    draw = np.random.default_rng(3)
    centres = draw.integers(-50_000, 50_000, (16, 16))
    points = np.repeat(centres, 16, axis=0) + draw.integers(-50, 50, (256, 16))
    tree = Gnat(points)
    tree.looked = 0
    queries = points[draw.permutation(256)] + 1
    found, _ = tree.nearest(queries)
    apart = ((queries[:, None] - points[None]) ** 2).sum(2)
    assert (found == apart.argmin(1)).all()
    assert tree.looked < 256 * 256 / 3


def test_points_all_alike():
    found, apart = Gnat(np.ones((256, 4))).nearest(np.zeros((3, 4)))
    assert found.tolist() == [0, 0, 0] and apart.tolist() == [4, 4, 4]
    found, _ = Gnat(np.ones((5, 4))).nearest(np.zeros((0, 4)))
    assert len(found) == 0


def test_sql_with_other_rows(spark, tmp_path):
    rows = [r for r in vectors() if r[0] not in (13, 20)]
    path = f"{tmp_path}/embeddings.parquet"
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(path)
    connection = connect(str(tmp_path))
    connection.execute(f"create or replace view embeddings as from '{path}/*.parquet'")
    found = vector_codes(spark.read.parquet(path))
    assert differences(found, connection, ORACLE_SQL["op11_vector_codes"]) is None
