"""How the words of each source depart from those of the others, by an index built in one pass.

Tasks gather counts in memory, write them out as runs sorted by term whenever memory is
full, and runs are merged by a heap for each shard of terms. A table of term frequencies is
left, from which divergences follow: what two sources would give each other if no term
came in either, plus corrections for the terms that do.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from conform.llm.tables import stored, text_or_empty

#: A term is kept in a language if so many of its documents hold it.
DOCUMENTS = 3
#: Chances are whole numbers out of this many.
WHOLE = 1_000_000_000
#: Terms reported of each group.
RANKS = 200
#: Counts held in memory before a run is written, terms in a piece of a run, pieces taken
#: up at a time, pairs of sources of one term worked out at once, and sums of pairs held
#: before they are handed on.
HELD, PIECE, WINDOW = 600_000, 128, 256
PAIRS, SUMS = 1_000_000, 1_000_000

# All but ASCII letters and what is not ASCII parts words; bytes beyond ASCII stay.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

_RUN = pa.schema(
    [
        ("shard", pa.int32()),
        ("lang", pa.string()),
        ("first", pa.binary()),
        ("terms", pa.list_(pa.binary())),
        ("documents", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int32())),
        ("names", pa.list_(pa.string())),
        ("owners", pa.list_(pa.int32())),
        ("counts", pa.list_(pa.int64())),
    ]
)
_RUN_DDL = (
    "shard int, lang string, first binary, terms array<binary>, documents array<bigint>, "
    "ends array<int>, names array<string>, owners array<int>, counts array<bigint>"
)


def terms(text: str) -> list[bytes]:
    """The terms of a text: letters A-Z in lower case and characters beyond ASCII."""
    return text.encode().translate(_LETTERS).split()


class Postings:
    """Occurrences by language, source and term, and documents by language and term."""

    def __init__(self) -> None:
        self.counts: dict[str, dict[str | None, Counter]] = {}
        self.held = 0

    def add(self, lang: str, source: str, text: str) -> None:
        words = terms(text)
        groups = self.counts.setdefault(lang, {})
        for name, found in ((source, words), (None, set(words))):
            counter = groups.setdefault(name, Counter())
            before = len(counter)
            counter.update(found)
            self.held += len(counter) - before

    def run(self, shards: int) -> Iterator[pa.RecordBatch]:
        """All counts in pieces of at most `PIECE` terms of one shard, sorted by term; then none.

        A piece lists its terms, in how many documents each comes, where its postings
        end, and all postings: which of the named sources, and how often.
        """
        for lang, groups in self.counts.items():
            within = groups.pop(None)
            if within:
                yield _run(lang, within, groups, shards)
        self.counts, self.held = {}, 0


def _run(lang: str, within: Counter, groups: dict[str, Counter], shards: int) -> pa.RecordBatch:
    found = pa.array(list(chain.from_iterable(groups.values())), pa.binary()).dictionary_encode()
    known, number = found.dictionary, found.indices.to_numpy()
    counts = np.fromiter(chain.from_iterable(c.values() for c in groups.values()), np.int64)
    owners = np.repeat(np.arange(len(groups)), [len(c) for c in groups.values()])
    listed, salt = known.to_pylist(), zlib.crc32(lang.encode())
    shard = np.fromiter((zlib.crc32(term, salt) % shards for term in listed), np.int32)
    documents = np.fromiter((within[term] for term in listed), np.int64)
    rank = np.empty(len(known), np.int64)
    rank[pc.array_sort_indices(known).to_numpy()] = np.arange(len(known))
    order = np.lexsort((rank, shard))
    place = np.empty(len(known), np.int64)
    place[order] = np.arange(len(known))
    # Postings by the place of their terms.
    by_term = np.argsort(place[number], kind="stable")
    owners, counts = owners[by_term], counts[by_term]
    ends = np.cumsum(np.bincount(place[number], minlength=len(known)))
    shard, words = shard[order], known.take(pa.array(order))
    edges = np.flatnonzero(np.diff(shard, prepend=-1))
    width = np.diff(np.append(edges, len(shard)))
    starts = np.concatenate([e + np.arange(0, w, PIECE) for e, w in zip(edges, width)])
    cuts = np.append(starts, len(shard))
    first = np.concatenate([[0], ends])[cuts]
    names, all_names = [], list(groups)
    for begin, end in zip(first[:-1], first[1:]):
        own, owners[begin:end] = np.unique(owners[begin:end], return_inverse=True)
        names.append([all_names[n] for n in own])

    def listed_at(offsets: np.ndarray, values, kind: pa.DataType) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))

    return pa.RecordBatch.from_arrays(
        [
            pa.array(shard[starts], pa.int32()),
            pa.array([lang] * len(starts), pa.string()),
            words.take(pa.array(starts)),
            listed_at(cuts, words, pa.binary()),
            listed_at(cuts, documents[order], pa.int64()),
            listed_at(cuts, ends - np.repeat(first[:-1], np.diff(cuts)), pa.int32()),
            pa.array(names, pa.list_(pa.string())),
            listed_at(first, owners, pa.int32()),
            listed_at(first, counts, pa.int64()),
        ],
        schema=_RUN,
    )


@dataclass
class _Piece:
    """A piece of a run, read up to the term at ``at``."""

    terms: pa.BinaryArray
    documents: np.ndarray
    ends: np.ndarray
    owners: np.ndarray
    counts: np.ndarray
    at: int = 0

    def before(self, border: bytes | None) -> tuple:
        """What is left below a border, which is then passed."""
        begin, end = self.at, len(self.terms)
        if border is not None:
            end = bisect_left(range(end), border, begin, key=lambda n: self.terms[n].as_py())
        edges = np.concatenate([[0], self.ends])
        self.at = end
        first, last = edges[begin], edges[end]
        return (
            self.terms.slice(begin, end - begin),
            self.documents[begin:end],
            np.diff(edges[begin : end + 1]),
            self.owners[first:last],
            self.counts[first:last],
        )


def _pieces(
    batches: Iterable[pa.RecordBatch], sources: dict[str, int]
) -> Iterator[tuple[str, bytes, _Piece]]:
    """Language, first term and contents of each piece; sources get numbers of the task's."""

    def listed(column: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
        offsets = column.offsets.to_numpy()
        return column.flatten(), offsets - offsets[0]

    for batch in batches:
        langs, names = batch["lang"].to_pylist(), batch["names"].to_pylist()
        terms, edge = listed(batch["terms"])
        documents, _ = listed(batch["documents"])
        ends, _ = listed(batch["ends"])
        owners, posting = listed(batch["owners"])
        counts, _ = listed(batch["counts"])
        documents, ends, owners, counts = (
            column.to_numpy() for column in (documents, ends, owners, counts)
        )
        for row, (lang, own) in enumerate(zip(langs, names)):
            number = np.array([sources.setdefault(name, len(sources)) for name in own])
            at, to, first, last = edge[row], edge[row + 1], posting[row], posting[row + 1]
            yield lang, terms[at].as_py(), _Piece(
                terms.slice(at, to - at),
                documents[at:to],
                ends[at:to],
                number[owners[first:last]],
                counts[first:last],
            )


def merged(pieces: Iterable[tuple[bytes, _Piece]]) -> Iterator[tuple]:
    """Blocks of terms in order, from the pieces of all runs in the order of their firsts.

    A heap holds the open pieces by their next terms. Some pieces are taken up at a time;
    whatever lies before the first term of the next one is final, and only pieces that
    reach below that border are read, up to it. A block has its terms, the documents of
    each, and for its postings the number of the term, the source and the count, sorted.
    """
    heap: list[tuple[bytes, int, _Piece]] = []
    ahead = iter(pieces)
    following = next(ahead, None)
    number = 0
    while heap or following:
        for _ in range(WINDOW):
            if following is None:
                break
            heapq.heappush(heap, (following[0], number, following[1]))
            following = next(ahead, None)
            number += 1
        border = following[0] if following else None
        read = []
        while heap and (border is None or heap[0][0] < border):
            _, order, piece = heap[0]
            read.append(piece.before(border))
            if piece.at < len(piece.terms):
                heapq.heapreplace(heap, (piece.terms[piece.at].as_py(), order, piece))
            else:
                heapq.heappop(heap)
        if read:
            yield _summed(*zip(*read))


def _summed(terms, documents, sizes, owners, counts) -> tuple:
    """Entries of equal terms, and their postings of equal sources, as one."""
    found = pa.concat_arrays(terms).dictionary_encode()
    known, number = found.dictionary, found.indices.to_numpy()
    rank = np.empty(len(known), np.int64)
    order = pc.array_sort_indices(known)
    rank[order.to_numpy()] = np.arange(len(known))
    number = rank[number]
    within = np.bincount(number, np.concatenate(documents), len(known)).astype(np.int64)
    term = np.repeat(number, np.concatenate(sizes))
    owner, count = np.concatenate(owners), np.concatenate(counts)
    sort = np.lexsort((owner, term))
    term, owner, count = term[sort], owner[sort], count[sort]
    heads = np.flatnonzero(
        (np.diff(term, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0)
    )
    return known.take(order), within, term[heads], owner[heads], np.add.reduceat(count, heads)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            block = batch.slice(at, 256)
            yield from zip(*(column.to_pylist() for column in block.columns), strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def made() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield made()
            held = []
    if held:
        yield made()


def frequencies(documents: DataFrame, shards: int | None = None) -> DataFrame:
    """The kept terms: ``lang, term, source, n, total, head``, one row where a source has one.

    ``n`` counts the source's occurrences, ``total`` the language's, and ``head`` marks
    one row of each term. ``documents`` has ``lang``, ``source`` and ``text`` without
    nulls. ``shards`` are 4 times ``spark.sql.shuffle.partitions`` unless given; a task
    merges its shards with one piece of each run open at most.
    """
    spark = documents.sparkSession
    dealt = shards or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        postings = Postings()
        for lang, source, text in _rows(batches):
            postings.add(lang, source, text)
            if postings.held >= HELD:
                yield from postings.run(dealt)
        yield from postings.run(dealt)

    kept = pa.schema(
        [
            ("lang", pa.string()),
            ("term", pa.string()),
            ("source", pa.string()),
            ("n", pa.int64()),
            ("total", pa.int64()),
            ("head", pa.bool_()),
        ]
    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sources: dict[str, int] = {}
        for lang, own in groupby(_pieces(batches, sources), key=lambda piece: piece[0]):
            for words, within, term, owner, n in merged(piece[1:] for piece in own):
                total = np.bincount(term, n, len(words)).astype(np.int64)
                frequent = within[term] >= DOCUMENTS
                term, owner, n = term[frequent], owner[frequent], n[frequent]
                named = pa.array(list(sources), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(term), pa.string()),
                        words.take(pa.array(term)).cast(pa.string()),
                        named.take(pa.array(owner)),
                        pa.array(n),
                        pa.array(total[term]),
                        pa.array(np.diff(term, prepend=-1) != 0),
                    ],
                    schema=kept,
                )

    runs = documents.select("lang", "source", "text").mapInArrow(index, _RUN_DDL)
    by_shard = runs.repartition("shard").sortWithinPartitions("lang", "first")
    return by_shard.drop("shard", "first").mapInArrow(
        merge, "lang string, term string, source string, n long, total long, head boolean"
    )


def _chance(count: Column, mass: Column) -> Column:
    """``1 + floor(WHOLE * (count + 1) / mass)``, exact for any long."""
    share = (count + 1).cast("decimal(20,0)") * F.lit(WHOLE).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", share, mass.cast("decimal(20,0)"))


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _corrections(postings: DataFrame) -> DataFrame:
    """``lang, source, item, value``: what terms in both add to the sum of their separate parts.

    With p and q the chances of a term in two sources and p0 and q0 those of a term
    that is not there, the correction is f(p,q) - f(p,q0) - f(p0,q) + f(p0,q0). Postings
    come by term; a block of whole terms is worked out at a time, `PAIRS` pairs at once,
    and the sums of pairs of sources are handed on whenever there are many.
    """
    out = pa.schema(
        [
            ("lang", pa.string()),
            ("source", pa.string()),
            ("item", pa.string()),
            ("value", pa.int64()),
        ]
    )

    def correct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple, int] = {}
        # The last term of a batch may go on in the next one.
        waiting: list[pa.RecordBatch] = []

        def handed() -> Iterator[pa.RecordBatch]:
            rows = ((*pair, value) for pair, value in totals.items() if value)
            yield from _batches(rows, out, 8192)
            totals.clear()

        def added(block: pa.Table) -> Iterator[pa.RecordBatch]:
            for pairs in _block(block.combine_chunks()):
                for pair, value in pairs.items():
                    totals[pair] = totals.get(pair, 0) + value
                if len(totals) >= SUMS:
                    yield from handed()

        for batch in batches:
            if not batch.num_rows:
                continue
            last = _heads(pa.Table.from_batches([batch]))[-1]
            if last:
                yield from added(pa.Table.from_batches([*waiting, batch.slice(0, last)]))
                waiting = []
            waiting.append(batch.slice(last))
        if waiting:
            yield from added(pa.Table.from_batches(waiting))
        yield from handed()

    shared = postings.where("not alone").repartition("lang", "term")
    ready = shared.sortWithinPartitions("lang", "term")
    ready = ready.select("lang", "term", "source", "p", "p0")
    found = ready.mapInArrow(correct, "lang string, source string, item string, value long")
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _heads(rows: pa.Table) -> np.ndarray:
    """Where a new term begins."""
    new = np.ones(rows.num_rows, bool)
    if rows.num_rows > 1:
        one, two = rows.slice(1), rows.slice(0, rows.num_rows - 1)
        other = pc.or_(
            pc.not_equal(one["term"], two["term"]), pc.not_equal(one["lang"], two["lang"])
        )
        new[1:] = other.to_numpy()
    return np.flatnonzero(new)


def _block(rows: pa.Table) -> Iterator[dict[tuple, int]]:
    """Sums of corrections by ordered pair of sources, a bounded number of pairs at a time."""
    sizes = np.diff(np.append(_heads(rows), rows.num_rows))
    langs, sources = (
        rows[name].combine_chunks().dictionary_encode() for name in ("lang", "source")
    )
    codes = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary)
    group, whose = np.unique(codes + sources.indices.to_numpy(), return_inverse=True)
    named = [divmod(int(code), len(sources.dictionary)) for code in group]
    langs, sources = langs.dictionary.to_pylist(), sources.dictionary.to_pylist()
    names = [(langs[lang], sources[source]) for lang, source in named]
    p, p0 = rows["p"].to_numpy(), rows["p0"].to_numpy()
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    width = np.repeat(sizes, sizes)
    reach = np.cumsum(width)
    at = 0
    while at < len(p):
        done = reach[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(reach, done + PAIRS, "right")))
        left = np.repeat(np.arange(at, stop), width[at:stop])
        before = np.cumsum(width[at:stop]) - width[at:stop]
        right = np.arange(len(left)) - np.repeat(before - start[at:stop], width[at:stop])
        left, right = left[left != right], right[left != right]
        at = stop
        if not len(left):
            continue
        value = np.zeros(len(left), np.int64)
        for sign, over, under in ((1, p, p), (-1, p, p0), (-1, p0, p), (1, p0, p0)):
            q = under[right]
            value += sign * ((over[left] - q) ** 2 // q)
        pair = whose[left] * len(names) + whose[right]
        order = np.argsort(pair, kind="stable")
        heads = np.flatnonzero(np.diff(pair[order], prepend=-1))
        sums = np.add.reduceat(value[order], heads)
        yield {
            (names[k // len(names)][0], names[k // len(names)][1], names[k % len(names)][1]): v
            for k, v in zip(pair[order][heads].tolist(), sums.tolist(), strict=True)
        }


def source_divergence(documents: DataFrame, shards: int | None = None) -> DataFrame:
    """For each source of each language its divergence from the others, and the terms it leans to.

    Part ``pair`` has every other source of the language, part ``term`` the `RANKS` terms
    that depart most from the whole language. Null texts, languages and sources count as
    empty ones; an empty text has no terms but its group is there; repeated rows count
    as often as they come; without any kept term all values are 0. An empty table gives
    an empty result, other columns are not looked at, equal values come in the order of
    their items.
    """
    ready = documents.select(
        F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce("source", F.lit("")).alias("source"),
        text_or_empty().alias("text"),
    )
    kept = stored(frequencies(ready, shards), "frequencies")
    occurring = ready.select("lang", "source").distinct()
    masses = kept.groupBy("lang", "source").agg(F.sum("n").alias("mass"))
    sizes = kept.groupBy("lang").agg(
        F.sum("n").alias("whole_mass"), F.count_if("head").alias("size")
    )
    nothing = F.lit(0).cast("long")
    groups = (
        occurring.join(masses, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .select(
            "lang",
            "source",
            F.coalesce("mass", nothing).alias("mass"),
            F.coalesce("whole_mass", nothing).alias("whole_mass"),
            F.coalesce("size", nothing).alias("size"),
        )
        .withColumn("p0", F.when(F.col("size") > 0, _chance(nothing, F.expr("mass + size"))))
    )
    groups = stored(groups, "groups")
    with_chances = kept.join(groups, ["lang", "source"]).select(
        "lang",
        "term",
        "source",
        "p0",
        (F.col("n") == F.col("total")).alias("alone"),
        _chance(F.col("n"), F.expr("mass + size")).alias("p"),
        _chance(F.col("total"), F.expr("whole_mass + size")).alias("q"),
    )
    postings = stored(with_chances, "postings")
    return _pairs(groups, postings).unionByName(_terms(postings))


def _pairs(groups: DataFrame, postings: DataFrame) -> DataFrame:
    """Every two sources of a language: the result has as many rows."""
    one = groups.select("lang", "source", "size", F.col("p0").alias("left0"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("right0"))
    both = one.join(other, "lang").where("source <> item")
    neither = _apart(F.col("left0"), F.col("right0"))
    base = both.select("lang", "source", "item", (F.col("size") * neither).alias("value"))
    # Terms of one source count by their chance, and chances are few.
    alike = postings.groupBy("lang", "source", "p").agg(F.count("*").alias("held"))
    left = both.join(alike, ["lang", "source"]).select(
        "lang",
        "source",
        "item",
        (F.col("held") * (_apart(F.col("p"), F.col("right0")) - neither)).alias("value"),
    )
    right = both.join(alike.withColumnRenamed("source", "item"), ["lang", "item"]).select(
        "lang",
        "source",
        "item",
        (F.col("held") * (_apart(F.col("left0"), F.col("p")) - neither)).alias("value"),
    )
    parts = base.unionByName(left).unionByName(right).unionByName(_corrections(postings))
    # Sums of parts may pass a long, the whole does not.
    summed = parts.groupBy("lang", "source", "item").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value")
    )
    summed = summed.withColumn("value", F.coalesce("value", F.lit(0).cast("long")))
    return _ranked(summed, "pair")


def _terms(postings: DataFrame) -> DataFrame:
    leaning = postings.where("p > q").select(
        "lang", "source", F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value")
    )
    # Spark keeps the first ranks of each task before it shuffles.
    return _ranked(leaning, "term").where(F.col("rank") <= RANKS)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select(
        "lang",
        "source",
        F.lit(part).alias("part"),
        "item",
        "value",
        F.row_number().over(order).alias("rank"),
    )
