"""Documents that share most of their word n-grams, and the groups they form.

Three ideas carry the join. The n-grams' global order is cut into ranges, and a task
counts in how many documents each n-gram of its range comes; a document of whose
n-grams too few come elsewhere is done with. The rest meet through their rarest
n-grams, but within a list only with the document of the list that can be closest to
most; whoever is not in that document's group afterwards meets all the others. The
overlap of a pair is counted in fragments of the order, each by itself, and summed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from conform.llm.arrow import arrow_schema, blocks
from conform.llm.components import components
from conform.llm.hashing import shingles
from conform.llm.tables import free_name, numbered, stored

WORDS = 5
#: Similarity from which documents link, in hundredths.
PERCENT = 80
#: Text that one chunk holds, in bytes, if it is more than one row; and rows that it holds.
CHUNK_BYTES, CHUNK_ROWS = 16 << 20, 60_000
#: Fragments in which overlaps are counted.
FRAGMENTS = 4
_MANY = 0xFFFF
_ENTRIES = "key long, chunk long, kind int, grams binary, whose binary, counts binary"
_REPLIES = "chunk long, kind int, grams binary, whose binary, counts binary"
_SETS = "node long, doc_id long, n long, shared long, grams binary, counts binary"
_MEETING = "gram long, node long, n long, shared long, at long"
_DOCS, _LOCAL, _SINGLE, _REPEATED = range(4)


def _rows(schema: str, rows: list[tuple]) -> pa.Table:
    arrow = arrow_schema(schema)
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in arrow]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], arrow)


def _ids(values: list) -> bytes:
    """Identifiers that may be null, as Arrow writes them."""
    batch = pa.record_batch([pa.array(values, pa.int64())], names=["id"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _chunk(
    chunk: int, ids: list, sizes: np.ndarray, grams: np.ndarray, whose: np.ndarray, parts: int
) -> list[tuple]:
    """What a chunk of documents sends to each range of the order, and what it keeps.

    An n-gram that comes in several of its documents is sent once with their number,
    so that a range gets a frequent one once from each chunk.
    """
    own = -1 - chunk
    rows = [(own, chunk, _DOCS, _ids(ids), sizes.astype("<u4").tobytes(), b"")]
    order = np.argsort(grams, kind="stable")
    grams, whose = grams[order], whose[order].astype("<u2")
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else []
    times = np.diff(np.concatenate([first, [len(grams)]])).astype("<u4")
    many = np.repeat(times > 1, times)
    if many.any():
        rows.append((own, chunk, _LOCAL, grams[many].tobytes(), whose[many].tobytes(), b""))
    heads = grams[first]
    sent = np.where(times > 1, _MANY, whose[first]).astype("<u2")
    part = ((heads >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    cuts = np.searchsorted(part, np.arange(parts + 1))
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if a < b:
            data = heads[a:b].tobytes(), sent[a:b].tobytes(), times[a:b][times[a:b] > 1].tobytes()
            rows.append((k, chunk, _SINGLE, *data))
    return rows


def _counted(table: pa.Table) -> pa.Table:
    """For one range of the order: what repeats, back to the chunks it came from."""
    if table.column("key")[0].as_py() < 0:
        return table.drop_columns(["key"])
    chunks = table.column("chunk").to_pylist()
    lists = {
        name: [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]
        for name, kind in (("grams", "<u8"), ("whose", "<u2"), ("counts", "<u4"))
    }
    grams = np.concatenate(lists["grams"])
    times = np.ones(len(grams), np.int64)
    times[np.concatenate(lists["whose"]) == _MANY] = np.concatenate(lists["counts"])
    _, place = np.unique(grams, return_inverse=True)
    total = np.bincount(place, weights=times)[place].astype("<u4")
    rows, start = [], 0
    for chunk, own, whose in zip(chunks, lists["grams"], lists["whose"], strict=True):
        count = total[start : start + len(own)]
        start += len(own)
        many = whose == _MANY
        single = ~many & (count > 1)
        if single.any():
            data = own[single].tobytes(), whose[single].tobytes(), count[single].tobytes()
            rows.append((chunk, _SINGLE, *data))
        if many.any():
            rows.append((chunk, _REPEATED, own[many].tobytes(), b"", count[many].tobytes()))
    return _rows(_REPLIES, rows)


def _assembled(table: pa.Table) -> pa.Table:
    """For one chunk: each document's shared n-grams, of those that share enough."""
    of = {kind: [] for kind in (_DOCS, _LOCAL, _SINGLE, _REPEATED)}
    for row in table.select(["kind", "grams", "whose", "counts"]).to_pylist():
        of[row["kind"]].append(row)

    def joined(kind: int, name: str, dtype: str) -> np.ndarray:
        return np.concatenate(
            [np.empty(0, dtype), *(np.frombuffer(row[name], dtype) for row in of[kind])]
        )

    chunk = table.column("chunk")[0].as_py()
    docs = of[_DOCS][0]
    ids = pa.ipc.open_stream(docs["grams"]).read_all().column(0).to_pylist()
    n = np.frombuffer(docs["whose"], "<u4")
    known, counts = joined(_REPEATED, "grams", "<u8"), joined(_REPEATED, "counts", "<u4")
    order = np.argsort(known)
    known, counts = known[order], counts[order]
    local = joined(_LOCAL, "grams", "<u8")
    grams = np.concatenate([local, joined(_SINGLE, "grams", "<u8")])
    whose = np.concatenate([joined(_LOCAL, "whose", "<u2"), joined(_SINGLE, "whose", "<u2")])
    count = np.concatenate(
        [counts[np.searchsorted(known, local)], joined(_SINGLE, "counts", "<u4")]
    )
    order = np.lexsort((grams, whose))
    grams, whose, count = grams[order], whose[order], count[order]
    ends = np.searchsorted(whose, np.arange(len(ids) + 1))
    rows = []
    for i, doc_id in enumerate(ids):
        a, b = ends[i], ends[i + 1]
        enough = b > a and 100 * (b - a) >= PERCENT * int(n[i])
        data = (grams[a:b].tobytes(), count[a:b].tobytes()) if enough else (None, None)
        rows.append((chunk * (_MANY + 1) + i, doc_id, int(n[i]), int(b - a), *data))
    return _rows(_SETS, rows)


def _shared(entries: DataFrame) -> DataFrame:
    """Every document with its number of n-grams and of those that others have too.

    Those that share enough to link with any come with these n-grams in order, and
    in how many documents each comes; the others with nulls.
    """
    replies = entries.groupBy("key").applyInArrow(_counted, _REPLIES)
    return replies.groupBy("chunk").applyInArrow(_assembled, _SETS)


def _parts(df: DataFrame) -> int:
    return 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_sets(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """Shared n-grams of whole texts; columns as of ``_shared``, a ``node`` for each row."""
    return _text_sets(documents, "doc_id", lambda texts: shingles(texts, words), True)


def repeated_of_rows(rows: DataFrame, key: str, hashes) -> DataFrame:
    """Hashes that come again in the same or another text: ``key, grams`` of rows with any.

    ``hashes`` gives those of a list of texts and whose each is.
    """
    found = _text_sets(rows, key, hashes, False).where("grams is not null")
    return found.select(F.col("doc_id").alias(key), "grams")


def _text_sets(documents: DataFrame, key: str, hashes, sized: bool) -> DataFrame:
    parts = _parts(documents)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 20
        ids, grams, whose, held = [], [], [], 0

        def emit():
            owners = np.concatenate(whose)
            sizes = np.bincount(owners, minlength=len(ids)) * sized
            rows = _chunk(number, ids, sizes, np.concatenate(grams), owners, parts)
            return _rows(_ENTRIES, rows).to_batches()

        for block in blocks(batches, "text"):
            for at in range(0, len(block), CHUNK_ROWS):
                piece = block.slice(at, CHUNK_ROWS)
                texts = [(x or "").encode() for x in piece.column("text").to_pylist()]
                size = sum(map(len, texts))
                if ids and (held + size > CHUNK_BYTES or len(ids) + len(texts) > CHUNK_ROWS):
                    yield from emit()
                    number += 1
                    ids, grams, whose, held = [], [], [], 0
                found, owner = hashes(texts)
                grams.append(found)
                whose.append(owner + len(ids))
                ids += piece.column(key).to_pylist()
                held += size
        if ids:
            yield from emit()

    return _shared(documents.select(key, "text").mapInArrow(run, _ENTRIES))


def set_sets(sets: DataFrame) -> DataFrame:
    """The same for sets of which some n-grams are given; ``doc_id`` is the node it was.

    Columns ``node, n, grams``: n counts those left out as well.
    """
    parts = _parts(sets)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 20
        for block in blocks(batches, "grams"):
            for at in range(0, len(block), CHUNK_ROWS):
                piece = block.slice(at, CHUNK_ROWS)
                grams = [np.frombuffer(x, "<u8") for x in piece.column("grams").to_pylist()]
                whose = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
                nodes, sizes = piece.column("node").to_pylist(), piece.column("n").to_numpy()
                rows = _chunk(number, nodes, sizes, np.concatenate(grams), whose, parts)
                yield from _rows(_ENTRIES, rows).to_batches()
                number += 1

    return _shared(sets.select("node", "n", "grams").mapInArrow(run, _ENTRIES))


def _rarest(sets: DataFrame) -> DataFrame:
    """The n-grams by which a set meets others: rarest first, as many as a link can miss, and one.

    Two sets that link share one of these. Those that no other set has come first;
    ``at`` is the place in this order, from 0.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                least = -(-PERCENT * row["n"] // 100)
                take = row["n"] - least + 1 - (row["n"] - row["shared"])
                grams = np.frombuffer(row["grams"], "<u8")
                order = np.lexsort((grams, np.frombuffer(row["counts"], "<u4")))[: max(0, take)]
                rows += [
                    (gram, row["node"], row["n"], row["shared"], at)
                    for at, gram in enumerate(
                        grams[order].view("<i8").tolist(), row["n"] - row["shared"]
                    )
                ]
            yield from _rows(_MEETING, rows).to_batches()

    return sets.select("node", "n", "shared", "grams", "counts").mapInArrow(run, _MEETING)


def _fragments(sets: DataFrame) -> DataFrame:
    """Sets cut at the same places of the order (``node, fragment, grams``)."""

    cuts = np.arange(1, FRAGMENTS, dtype=np.uint64) * np.uint64((1 << 64) // FRAGMENTS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                grams = np.frombuffer(row["grams"], "<u8")
                cut = np.searchsorted(grams, cuts)
                for k, part in enumerate(np.split(grams, cut)):
                    rows.append((row["node"], row["n"], k, part.tobytes()))
            yield from _rows("node long, n long, fragment int, grams binary", rows).to_batches()

    return sets.select("node", "n", "grams").mapInArrow(
        run, "node long, n long, fragment int, grams binary"
    )


@F.pandas_udf(LongType())
def _overlap(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series(
        [
            len(np.intersect1d(np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8"), True))
            for a, b in zip(left, right, strict=True)
        ],
        dtype="int64",
    )


def _overlaps(pairs: DataFrame, fragments: DataFrame) -> DataFrame:
    """What the pairs ``a, b`` have in common: partial overlaps of fragments, summed."""
    left = fragments.select(
        F.col("node").alias("a"), "fragment", F.col("grams").alias("_left"), F.col("n").alias("_n")
    )
    right = fragments.select(
        F.col("node").alias("b"), "fragment", F.col("grams").alias("_right"), F.col("n").alias("_m")
    )
    partial = pairs.join(left, "a").join(right, ["b", "fragment"])
    partial = partial.select("a", "b", "_n", "_m", _overlap("_left", "_right").alias("_both"))
    return partial.groupBy("a", "b", "_n", "_m").agg(F.sum("_both").alias("_both"))


def _links(overlaps: DataFrame) -> DataFrame:
    """The pairs that are similar enough."""
    return overlaps.where(f"100 * _both >= {PERCENT} * (_n + _m - _both)").select("a", "b")


def _may_link(n: str, shared: str, m: str, other: str) -> str:
    """Whether two sets can link, by how many n-grams they have and share with any."""
    return f"{100 + PERCENT} * least({shared}, {other}) >= {PERCENT} * ({n} + {m})"


def similar_sets(sets: DataFrame) -> DataFrame:
    """Groups among different sets (``node, n, grams``): ``node, root``, of those in any.

    N-grams that no other set has may be left out of ``grams``, though n counts them.

    Nothing is said twice: once a group is known, pairs within it are left out, so a
    large group of near copies costs what its members do and not its pairs. Pairs
    between groups are all counted that may link.
    """
    known = stored(set_sets(sets).where("grams is not null").drop("node"), "sets")
    known = known.withColumnRenamed("doc_id", "node")
    meeting = stored(_rarest(known), "meeting")
    lists = stored(
        meeting.groupBy("gram")
        .agg(
            F.count("*").alias("_size"),
            F.min(F.struct((-F.col("shared") / F.col("n")).alias("_rank"), "node", "n", "shared")).alias(
                "_best"
            ),
            F.min("n").alias("_least"),
        )
        .where("_size > 1")
        .select("gram", "_best.node", "_best.n", "_best.shared", "_least")
        .toDF("gram", "_best", "_best_n", "_best_shared", "_least"),
        "lists",
    )
    fragments = stored(_fragments(known), "fragments")
    listed = meeting.join(lists, "gram")
    near = listed.where("node <> _best").where(_may_link("n", "shared", "_best_n", "_best_shared"))
    near = stored(
        near.select(F.col("node").alias("a"), F.col("_best").alias("b")).distinct(), "pairs"
    )
    near = stored(_overlaps(near, fragments), "overlaps")
    links = stored(_links(near), "links")
    roots = components(links)
    root = F.coalesce("root", "node")
    rooted = meeting.join(roots, "node", "left").withColumn("root", root)
    of_best = roots.select(F.col("node").alias("_best"), F.col("root").alias("_best_root"))
    lists = lists.join(of_best, "_best", "left").withColumn(
        "_best_root", F.coalesce("_best_root", "_best")
    )
    # Of what two sets share, a part lies in their list's best set and a part does not.
    inside = near.select(F.col("a").alias("node"), F.col("b").alias("_best"), "_both")
    rooted = rooted.join(stored(lists, "lists"), "gram").join(inside, ["node", "_best"], "left")
    rooted = rooted.withColumn("_in", F.expr("if(node = _best, shared, _both)"))
    rooted = stored(
        rooted.select("gram", "node", "n", "shared", "at", "root", "_best_root", "_least", "_in"),
        "rooted",
    )
    outside = rooted.where("root <> _best_root").where(
        f"{100 + PERCENT} * shared >= {PERCENT} * (n + _least)"
    )
    others = rooted.select(
        "gram",
        F.col("node").alias("_node"),
        F.col("n").alias("_n"),
        F.col("shared").alias("_shared"),
        F.col("at").alias("_at"),
        F.col("root").alias("_root"),
        F.col("_in").alias("_other_in"),
    )
    far = stored(outside, "outside").join(others, "gram").where("root <> _root")
    far = far.where("_root = _best_root or node < _node")
    most = (
        "if(_in is null or _other_in is null, least(shared, _shared), "
        "least(_in, _other_in) + least(shared - _in, _shared - _other_in))"
    )
    far = far.where(f"{100 + PERCENT} * {most} >= {PERCENT} * (n + _n)")
    # From the first n-gram that two sets share on, each has all that they share.
    far = far.where(f"{100 + PERCENT} * least(n - at, _n - _at) >= {PERCENT} * (n + _n)")
    far = stored(
        far.select(
            F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b")
        ).distinct(),
        "pairs",
    )
    return components(links.unionByName(stored(_links(_overlaps(far, fragments)), "links")))


def _grouped(rows: DataFrame) -> DataFrame:
    """The group of each row of ``text_sets`` that may be in one: ``node, component_id, _first``.

    ``_first`` is the row that stands for the group: of the least identifier.
    """
    whole = rows.where("grams is not null").withColumn(
        "_key", F.when(F.col("shared") == F.col("n"), F.sha2("grams", 256))
    )
    whole = whole.withColumn("_key", F.coalesce("_key", F.col("node").cast("string")))
    place = F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "node")
    firsts = stored(
        whole.groupBy("_key").agg(F.min("node").alias("_set"), F.min(place).alias("_least")),
        "firsts",
    )
    sets = whole.select("node", "n", "grams").join(
        firsts.select(F.col("_set").alias("node")), "node", "left_semi"
    )
    roots = similar_sets(stored(sets, "sets"))
    groups = firsts.join(roots.withColumnRenamed("node", "_set"), "_set", "left")
    groups = stored(groups.withColumn("_root", F.coalesce("root", "_set")), "groups")
    least = groups.groupBy("_root").agg(F.min("_least").alias("_least"))
    named = groups.select("_key", "_root").join(least, "_root").select("_key", "_least")
    return stored(
        whole.select("node", "_key")
        .join(stored(named, "named"), "_key")
        .select("node", F.col("_least.doc_id").alias("component_id"), F.col("_least.node").alias("_first")),
        "components",
    )


def similar_documents(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """Every document with its number of shingles and the group it is in.

    Columns ``doc_id, n_shingles, component_id``, the latter the least identifier that
    links lead to. Documents with equal sets are one to the join, so copies cost no
    pairs. Rows that repeat an identifier count as documents of their own; a null
    identifier never names a group that has another. A null text, or one without
    words, has no shingles and links with nothing. An empty table gives an empty one;
    other columns are not read. Beyond the 64 bits of a shingle's hash all is exact.
    """
    rows = stored(text_sets(documents, words), "shared")
    return rows.join(_grouped(rows), "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def without_similar(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Of each group of similar documents the row with the least identifier; all columns.

    Rows that link with nothing stay. Of rows that repeat an identifier and are alike
    one stays: the first in the order of their files and places there.
    """
    names, at = docs.columns, free_name(docs, "_at")
    rows = numbered(docs, at)
    sets = text_sets(rows.select(F.col(at).alias("doc_id"), "text"), words)
    sets = stored(sets.withColumnRenamed("doc_id", "_at"), "shared")
    ids = stored(rows.select("doc_id", F.col(at).alias("_at")), "ids")
    groups = _grouped(sets.where("grams is not null").join(ids, "_at"))
    dropped = groups.where("node <> _first").join(sets, "node").select(F.col("_at").alias(at))
    return rows.join(stored(dropped, "dropped"), at, "left_anti").select(*names)
