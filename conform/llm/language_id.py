"""Languages of texts by error-correcting output codes over binary n-gram classifiers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Lengths in bytes of n-grams, and the buckets their hashes are counted in.
GRAMS, BUCKETS = (1, 2, 3, 4), 4096
#: Documents that the classifiers are fitted on: of each language at most the first,
#: and of all together at most about the second, those with the least hashes.
PER_LANGUAGE, SAMPLE = 500, 2000
#: Bytes of the fragment by which each of them is also learnt, for the sake of short texts.
FRAGMENT = 48
#: Up to so many languages the codewords hold every way to part them.
EXHAUSTIVE = 5
#: Weight of the squared weights, and rounds of fitting.
PENALTY, TURNS = 1e-4, 150
#: Below this the nearest codeword is not told well from the next.
AMBIGUOUS = 0.6

# Bytes of ASCII that are no letters part words; others are letters in lower case.
_WORDS = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def normalised(text: str) -> bytes:
    """Words in lower case between single blanks, as UTF-8; empty without any letter."""
    if not any(map(str.isalpha, text)):
        return b""
    return b" " + b" ".join(text.lower().encode().translate(_WORDS).split()) + b" "


def grams(data: bytes) -> np.ndarray:
    """The root of each bucket's share of the n-grams, of length 1 unless there are none."""
    letters = np.frombuffer(data, np.uint8).astype(np.uint32)
    counts = np.zeros(BUCKETS)
    for size in GRAMS:
        full = len(letters) - size + 1
        if full < 1:
            break
        value = np.full(full, size, np.uint32)
        for at in range(size):
            value *= np.uint32(0x01000193)
            value ^= letters[at : at + full]
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x2C1B3C6D)
        counts += np.bincount(value >> np.uint32(20), minlength=BUCKETS)
    total = counts.sum()
    return np.sqrt(counts / total) if total else counts


def codewords(languages: int) -> np.ndarray:
    """A word of -1 and 1 for each language, far from one another.

    A few languages are parted in every possible way. For more, columns are drawn at
    random, fixed by their number, and of several draws the one is taken whose two
    nearest words differ most.
    """
    if languages < 2:
        return np.ones((languages, 0))
    if languages <= EXHAUSTIVE:
        ways = range(1, 1 << (languages - 1))
        return np.array(
            [[-1 if l and way >> (l - 1) & 1 else 1 for way in ways] for l in range(languages)]
        )
    bits = int(np.ceil(10 * np.log2(languages)))
    draw = np.random.Generator(np.random.PCG64(languages))
    best, apart = None, -1
    for _ in range(50):
        words = draw.choice([-1, 1], (languages, bits))
        same = np.abs(words.sum(0)) == languages
        words[0, same] *= -1
        nearest = int((bits - (words @ words.T - 2 * bits * np.eye(languages)).max()) // 2)
        if nearest > apart:
            best, apart = words, nearest
    return best


@dataclass(frozen=True)
class Identifier:
    """Languages with their codewords, and a linear classifier for each bit.

    ``trust`` weighs a bit's loss by how well it was told on documents left out.
    """

    languages: list[str]
    words: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray
    trust: np.ndarray

    def losses(self, vectors: np.ndarray) -> np.ndarray:
        """The weighted logistic loss of each language's codeword for each text."""
        margins = vectors @ self.weights + self.offsets
        weighed = self.trust / max(self.trust.sum(), 1e-9)
        right = np.logaddexp(0, -margins) * weighed
        wrong = np.logaddexp(0, margins) * weighed
        return right @ (self.words.T > 0) + wrong @ (self.words.T < 0)

    def identify(self, texts: list[str | None]) -> list[tuple]:
        """``(language, score, next best, ambiguous)`` of each text.

        The score is the chosen language's share of all, were chances to fall with the
        loss. Of equally near codewords the first language's is taken.
        """
        found: list[tuple] = [(UNKNOWN, 0.0, None, True)] * len(texts)
        words = [normalised(text or "") for text in texts]
        some = [n for n, word in enumerate(words) if word]
        if not some or not self.languages:
            return found
        losses = self.losses(np.stack([grams(words[n]) for n in some]))
        share = np.exp(-len(self.languages) * (losses - losses.min(1, keepdims=True)))
        share /= share.sum(1, keepdims=True)
        order = np.argsort(losses, axis=1, kind="stable")
        for row, n in enumerate(some):
            first, *others = order[row]
            score = float(share[row, first])
            second = self.languages[others[0]] if others else None
            found[n] = (self.languages[first], score, second, score < AMBIGUOUS)
        return found


def fit(vectors: np.ndarray, owners: np.ndarray, languages: list[str]) -> Identifier:
    """All bits' logistic regressions at once; a fifth of the rows is left out to weigh them.

    ``owners`` numbers each row's language. Languages weigh alike however many rows
    they have.
    """
    words = codewords(len(languages))
    bits = words.shape[1]
    if not bits:
        return Identifier(languages, words, np.zeros((BUCKETS, 0)), np.zeros(0), np.zeros(0))
    share = 1.0 / np.bincount(owners, minlength=len(languages))[owners]
    out = np.arange(len(owners)) % 5 == 4
    weights, offsets = _regressions(vectors[~out], words[owners[~out]], share[~out])
    missed = np.zeros(bits)
    if out.any():
        wrong = (vectors[out] @ weights + offsets) * words[owners[out]] <= 0
        missed = (wrong * share[out, None]).sum(0) / share[out].sum()
    weights, offsets = _regressions(vectors, words[owners], share)
    return Identifier(languages, words, weights, offsets, np.maximum(1 - 2 * missed, 0.01))


def _regressions(
    vectors: np.ndarray, targets: np.ndarray, share: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    vectors = np.asarray(vectors, np.float32)
    targets = np.asarray(targets, np.float32)
    share = (share / share.sum()).astype(np.float32)[:, None]
    weights = np.zeros((vectors.shape[1] + 1, targets.shape[1]), np.float32)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for turn in range(1, TURNS + 1):
        margins = (vectors @ weights[:-1] + weights[-1]) * targets
        pull = -targets * share / (1 + np.exp(np.clip(margins, -60, 60)))
        slope = np.vstack([vectors.T @ pull + PENALTY * weights[:-1], pull.sum(0)])
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        step = (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-8)
        weights -= 0.5 * step
    return weights[:-1].astype(float), weights[-1].astype(float)


def _fragment(words: bytes, place: int) -> bytes:
    """Some whole words from the middle of a text."""
    if len(words) <= FRAGMENT:
        return words
    start = words.find(b" ", place % (len(words) - FRAGMENT))
    end = words.find(b" ", start + FRAGMENT)
    return words[start : end + 1 or len(words)]


def train(
    documents: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang"
) -> Identifier:
    """An identifier learnt from rows with a text and a language.

    The driver gets the languages with their counts, and the n-gram shares of `SAMPLE`
    documents and as many fragments, or of 20 documents of each language if there are
    that many languages. What makes the choice are hashes of key and text.
    """
    known = documents.where(F.col(text).isNotNull() & F.col(language).isNotNull())
    held = {row[0]: row[1] for row in known.groupBy(language).count().collect()}
    if not held:
        return fit(np.zeros((0, BUCKETS)), np.zeros(0, int), [])
    each = min(PER_LANGUAGE, max(SAMPLE // max(len(held), 1), 20))
    # About three times as many as are wanted go by their hash alone, before any shuffle.
    whole = 1 << 31
    shares_of = {name: min(whole, 3 * each * whole // count + 1) for name, count in held.items()}
    below = F.create_map(*(F.lit(x) for item in shares_of.items() for x in item))
    place = Window.partitionBy("language").orderBy("hash", "words")
    chosen = (
        known.select(
            F.col(language).alias("language"),
            F.xxhash64(key, text).alias("hash"),
            F.col(text).alias("words"),
        )
        .where(F.pmod("hash", F.lit(whole)) < below[F.col("language")])
        .withColumn("place", F.row_number().over(place))
        .where(F.col("place") <= each)
        .select("language", "hash", "words")
    )

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, hashes, words = (column.to_pylist() for column in batch.columns)
            found = []
            for name, place, raw in zip(names, hashes, words, strict=True):
                data = normalised(raw)
                for part, piece in enumerate((data, _fragment(data, place)) if data else ()):
                    found.append((name, place, part, grams(piece).astype(np.float32).tobytes()))
            columns = list(zip(*found, strict=True)) if found else [(), (), (), ()]
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)],
                names=["language", "hash", "part", "share"],
            )

    schema = "language string, hash long, part int, share binary"
    rows = chosen.mapInArrow(shares, schema).collect()
    rows.sort(key=lambda row: (row["hash"], row["part"], row["language"]))
    languages = sorted({row["language"] for row in rows})
    number = {name: n for n, name in enumerate(languages)}
    vectors = np.zeros((len(rows), BUCKETS), np.float32)
    for at, row in enumerate(rows):
        vectors[at] = np.frombuffer(row["share"], np.float32)
    return fit(vectors, np.array([number[r["language"]] for r in rows], int), languages)


def identified(documents: DataFrame, model: Identifier, columns: list[str]) -> DataFrame:
    """The given columns with ``lang_pred``, ``score``, ``lang_next`` and ``ambiguous``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kept = documents.select(*columns, "text")
    names = ["lang_pred", "score", "lang_next", "ambiguous"]
    kinds = (pa.string(), pa.float64(), pa.string(), pa.bool_())
    fields = [f"`{name}` {kind}" for name, kind in kept.dtypes[:-1]]
    fields += ["lang_pred string", "score double", "lang_next string", "ambiguous boolean"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                block = batch.slice(at, 256)
                found = shared.value.identify(block.column(len(columns)).to_pylist())
                told = [pa.array(c, type=k) for c, k in zip(zip(*found), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*block.columns[: len(columns)], *told], names=[*columns, *names]
                )

    return kept.mapInArrow(run, ", ".join(fields))


def document_languages(documents: DataFrame) -> DataFrame:
    """The language of every document, and whether it was held out from learning.

    Held out are documents for which the checksum of ``doc_id``, as text, leaves 2 when
    divided by 4; a null ``doc_id`` counts as empty text. Of the others those with a text
    and a language are learnt from. Whole texts are read, of any length; a text that is
    null or has no letter gets `UNKNOWN` with score 0, and so does every text if there is
    nothing to learn from. Repeated rows stay, each by itself. An empty table gives an
    empty result; other columns are not looked at.
    """
    checksum = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = documents.select("doc_id", "text", "lang", (checksum % 4 == 2).alias("held_out"))
    model = train(rows.where("not held_out"))
    return identified(rows, model, ["doc_id", "held_out"])
