"""Documents' tokens packed into as few sequences as bin completion finds."""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conform.llm.arrow import map_blocks, texts
from conform.llm.tables import ordered, stored

CAPACITY = 2048
#: Looks between two orderings of a bin's fillings, and bins that the search may fill in all.
FILLINGS, STEPS = 400, 8_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """Bytes and ids of a file's tokens, and its special ones; None if ids are not ranks.

    They are if the file is plain byte-level BPE whose merges make the ids in order.
    A byte is written as the character of its number if that can be seen, the others
    as the characters from 256 on.
    """
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    model, split = stored["model"], stored["pre_tokenizer"] or {}
    vocabulary, special = model["vocab"], {t["content"]: t["id"] for t in stored["added_tokens"]}
    made = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    if (
        (model["type"], split.get("type"), split.get("add_prefix_space")) != ("BPE", "ByteLevel", False)
        or stored["normalizer"]
        or model["dropout"]
        or any(vocabulary.get(token) != 256 + at for at, token in enumerate(made))
        or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in stored["added_tokens"])
    ):
        return None
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in seen}
    byte |= {chr(256 + at): b for at, b in enumerate(sorted({*range(256)}.difference(seen)))}
    ranks = {
        bytes(map(byte.__getitem__, token)): i
        for token, i in vocabulary.items()
        if token not in special
    }
    return ranks, special


class Tokens:
    """Ids by a tokenizer's file, as little-endian unsigned 32-bit numbers.

    Where the file's ids are the ranks of its merges, tiktoken finds the same ids in
    a fourth of the time. Its pattern gives up on runs of very many blanks; such
    texts, and files of another kind, go to the tokenizers library.
    """

    def __init__(self, path: str, pattern: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        found = _ranks(path)
        self.encoding = found and tiktoken.Encoding(
            "file", pat_str=pattern, mergeable_ranks=found[0], special_tokens=found[1]
        )

    def ids(self, text: str) -> bytes:
        if self.encoding:
            try:
                return self.encoding.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
            except ValueError:
                pass
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()


@lru_cache(maxsize=2)
def tokens(path: str, pattern: str) -> Tokens:
    return Tokens(path, pattern)


def cut(ids: bytes, capacity: int) -> list[tuple[int, int, int]]:
    """Start, length and checksum of each piece; only the first may be shorter than full."""
    count = len(ids) // 4
    first = (count - 1) % capacity + 1
    starts = [0, *range(first, count, capacity)]
    return [
        (start, end - start, zlib.crc32(ids[4 * start : 4 * end]))
        for start, end in zip(starts, [*starts[1:], count], strict=True)
    ]


def least_bins(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer bins: large items need one each, and all bytes must fit.

    For each limit, items above capacity less the limit stand alone, those above half
    stand apart, and what the latter leave free takes the items from the limit on.
    """
    best = -(-sum(n * c for n, c in counts.items()) // capacity)
    for limit in range(capacity // 2 + 1):
        alone = sum(c for n, c in counts.items() if n > capacity - limit)
        halves = [(n, c) for n, c in counts.items() if capacity // 2 < n <= capacity - limit]
        small = sum(n * c for n, c in counts.items() if limit <= n <= capacity // 2)
        free = sum((capacity - n) * c for n, c in halves)
        best = max(
            best, alone + sum(c for _, c in halves) + max(0, -(-(small - free) // capacity))
        )
    return best


def _fillings(
    counts: dict[int, int], sizes: list[int], room: int, held: int, look: Callable[[], bool]
) -> Iterator[tuple[int, tuple]]:
    """Ways to fill ``room`` beside an item ``held``, with their waste, one after the other.

    Items are taken in falling order. A filling to which something could be added, or
    in which a larger item of those left fits in place of another, is left out. Ends
    early only when ``look``, called for each item laid in, says no.
    """
    used = Counter([held])
    chosen: list[int] = []
    # For each item laid in: the next smaller size to try, the room left, and if nothing fitted.
    stack = [[bisect_right(sizes, room), room, True]]
    while stack:
        place = stack[-1]
        place[0] -= 1
        if place[0] >= 0:
            size = sizes[place[0]]
            if counts[size] <= used[size]:
                continue
            if not look():
                return
            place[2] = False
            used[size] += 1
            chosen.append(size)
            free = place[1] - size
            stack.append([bisect_right(sizes, min(size, free)), free, True])
            continue
        _, free, maximal = stack.pop()
        if maximal and not any(
            counts[x] > used[x]
            for item in set(chosen)
            for x in sizes[bisect_right(sizes, item) : bisect_right(sizes, item + free)]
        ):
            yield free, tuple(chosen)
        if chosen:
            used[chosen.pop()] -= 1


def _best_fit(counts: dict[int, int], sizes: list[int], room: int) -> tuple:
    """The largest item that fits, again and again."""
    chosen: list[int] = []
    while (at := bisect_right(sizes, room)) > 0:
        size = next((s for s in reversed(sizes[:at]) if counts[s] > chosen.count(s)), None)
        if size is None:
            break
        chosen.append(size)
        room -= size
    return tuple(chosen)


def pack(
    counts: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS
) -> list[tuple[tuple, int]]:
    """Bin completion: fillings and how many bins get each, for items counted by length.

    A bin starts with the largest item left; all fillings of the rest that no other
    dominates are tried, and what was packed before plus the least bins for what is
    left prunes a branch that cannot beat the best packing known. Of the fillings that
    ``FILLINGS`` looks find, those with least waste come first, then those of the next
    looks. Best-fit is the first packing known. A filling goes to as many bins as its
    items allow, so that the work depends on the number of lengths, not of items; when
    all have been tried so, each goes to a single bin. One packing with the least bins
    ends the search, or that nothing is left to try; else the best one known stands
    after ``steps`` fillings or ``FILLINGS`` times as many looks.
    """
    counts = {n: c for n, c in counts.items() if c}
    goal = least_bins(counts, capacity)

    def apply(left: dict, sizes: list, filling: tuple) -> int:
        times = min(left[n] // filling.count(n) for n in set(filling))
        for n in set(filling):
            left[n] -= times * filling.count(n)
            if not left[n]:
                del left[n]
                sizes.remove(n)
        return times

    def greedy(left: dict, fill) -> list:
        left, sizes, packed = dict(left), sorted(left), []
        while left:
            largest = sizes[-1]
            left[largest] -= 1
            rest = fill(left, sizes, capacity - largest)
            left[largest] += 1
            filling = (largest, *rest)
            packed.append((filling, apply(left, sizes, filling)))
        return packed

    def bins(packed: list) -> int:
        return sum(times for _, times in packed)

    best = greedy(counts, _best_fit)
    spent = looks = 0

    def look() -> bool:
        nonlocal looks
        looks += 1
        return looks <= steps * FILLINGS

    def by_waste(sizes: list) -> Iterator[tuple]:
        largest = sizes[-1]
        room = capacity - largest
        left[largest] -= 1
        fit = _best_fit(left, sizes, room)
        left[largest] += 1
        exact = sum(fit) == room
        if exact:
            yield fit
        some, until = [], looks + FILLINGS
        for waste, rest in _fillings(left, sizes, room, largest, look):
            if not (exact and rest == fit):
                some.append((waste, rest))
            if looks >= until or not waste:
                yield from (r for _, r in sorted(some, key=lambda x: x[0]))
                some, until = [], looks + FILLINGS
        yield from (r for _, r in sorted(some, key=lambda x: x[0]))

    def options() -> Iterator[tuple[tuple, int]]:
        sizes = sorted(n for n, c in left.items() if c)
        for single in (False, True):
            for rest in by_waste(sizes):
                filling = (sizes[-1], *rest)
                times = min(left[n] // c for n, c in Counter(filling).items())
                if not single or times > 1:
                    yield filling, 1 if single else times

    def change(filling: tuple, times: int) -> None:
        for n in filling:
            left[n] += times

    # Depth first. What is left is one table: a step back puts its items back, so a
    # level's options always go on from what they began with.
    left, path, used = dict(counts), [], 0
    waiting = sum(n * c for n, c in left.items())
    levels = [options()] if left else []
    while levels and bins(best) > goal and spent < steps and looks < steps * FILLINGS:
        step = next(levels[-1], None)
        if step is None:
            levels.pop()
            if path:
                filling, times = path.pop()
                change(filling, times)
                used, waiting = used - times, waiting + times * sum(filling)
            continue
        filling, times = step
        spent += 1
        change(filling, -times)
        path.append(step)
        used, waiting = used + times, waiting - times * sum(filling)
        if not waiting and used < bins(best):
            best = list(path)
        if waiting and used + -(-waiting // capacity) < bins(best):
            levels.append(options())
        else:
            levels.append(iter(()))
    return best


def pieces(documents: DataFrame, path: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents: their ids, then id 0, cut where longer than a sequence."""

    def encoded(block):
        rows = []
        ids, end = tokens(path, pattern).ids, np.uint32(0).tobytes()
        for doc_id, text in zip(block.column("doc_id").to_pylist(), texts(block), strict=True):
            for number, (start, length, crc) in enumerate(cut(ids(text) + end, capacity)):
                rows.append((doc_id, number, start, length, crc))
        return list(map(list, zip(*rows, strict=True)))

    return map_blocks(documents.select("doc_id", "text"), "text", encoded, PIECES)


def packed(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Rows with ``length`` and what tells them apart, put into sequences.

    Adds ``sequence_id`` and ``offset``. The driver plans with the number of rows of
    each length, ``capacity`` lengths at most; rows take places in the order of their
    lengths, and a plan's filling owns a stretch of places for each of its lengths.
    """
    rows = stored(rows, "pieces")
    names = rows.columns
    keys = ["length", *(c for c in rows.columns if c != "length")]
    counted = rows.groupBy("length").count().orderBy("length").collect()
    counts = {row["length"]: row["count"] for row in counted}
    free, place = {}, 0
    for length, count in counts.items():
        free[length] = place
        place += count
    stretches, sequence = [], 0
    for filling, times in pack(counts, capacity):
        offset = 0
        for length in sorted(set(filling), reverse=True):
            each = filling.count(length)
            stretches.append((free[length], sequence, each, offset))
            free[length] += times * each
            offset += each * length
        sequence += times
    plan = np.array(sorted(stretches), dtype=np.int64).reshape(-1, 4)
    # A stretch for each filling and length, so it is bounded as the plan is.
    shared = rows.sparkSession.sparkContext.broadcast(plan)

    def assigned(batches):
        import pyarrow as pa

        starts, first, each, offset = shared.value.T
        for batch in batches:
            spot = batch.column("place").to_numpy()
            length = batch.column("length").to_numpy()
            at = np.searchsorted(starts, spot, side="right") - 1
            inside = spot - starts[at]
            sequence = first[at] + inside // each[at]
            where = offset[at] + inside % each[at] * length
            kept = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(where)],
                names=[*names, "sequence_id", "offset"],
            )

    kinds = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return (
        ordered(rows, keys)
        .select(*rows.columns, "place")
        .mapInArrow(assigned, f"{kinds}, sequence_id long, offset long")
    )


def document_sequences(
    documents: DataFrame, path: str, pattern: str, capacity: int = CAPACITY
) -> DataFrame:
    """Where each piece of each document lies; the columns of the query.

    A null or empty text is the id 0 alone. Repeated rows are packed each; pieces
    alike in all columns may swap places. An empty table gives an empty one; other
    columns are not read.
    """
    return packed(pieces(documents, path, pattern, capacity), capacity)
