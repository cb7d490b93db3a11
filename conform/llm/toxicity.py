"""Severity of toxic text by cumulative-link ordinal regression over sparse features."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conform.llm.arrow import map_blocks, texts
from conform.llm.tables import stored

WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6, 7)
#: Labelled documents that the model is fitted on, at most; those with the least hashes.
SAMPLE_DOCUMENTS = 12_000
#: Features that the model holds, at most; each must be so many times as frequent among
#: toxic documents as among others, and come in so many toxic ones.
FEATURES, RATIO, SUPPORT = 5000, 8.0, 3
GRADES = 3
#: Weight of the squared weights in what is minimised.
PENALTY = 0.1
#: Expected severity from which a document is rejected.
REJECT = 0.5


def features(text: str) -> set[str]:
    """Words in lower case, and with a mark the starts of longer ones."""
    words = set(WORD.findall(text.lower()))
    return words.union(f"{w[:n]}-" for n in STEMS for w in words if len(w) > n)


@dataclass
class Severity:
    """Weights shared by all thresholds, and the thresholds in rising order.

    The chance of a grade up to k is ``sigmoid(thresholds[k] - sum of weights)``.
    """

    weights: dict[str, float]
    thresholds: list[float]

    def grades(self, text: str) -> list[float]:
        score = sum(self.weights[f] for f in features(text) & self.weights.keys())
        up_to = [1 / (1 + np.exp(-np.clip(t - score, -500, 500))) for t in self.thresholds]
        return list(np.diff([0.0, *up_to, 1.0]))


def fit(
    rows: list[list[int]], grades: list[int], names: list[str], rounds: int = 400
) -> Severity:
    """Thresholds and weights of the greatest penalised likelihood.

    ``rows`` hold the features of each document by number. Thresholds stay in order,
    as each is the one before plus a positive step. Without any document, or with
    one grade only, or without features, every document gets grade 0.
    """
    grade = np.array(grades, dtype=int)
    if len(set(grades)) < 2 or not names:
        return Severity({}, [500.0] * (GRADES - 1))
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.array([i for r in rows for i in r], dtype=int)
    weight = np.zeros(len(names))
    first, steps = 0.0, np.zeros(GRADES - 2)
    memory = [np.zeros(len(names) + GRADES - 1) for _ in range(2)]
    for turn in range(1, rounds + 1):
        score = np.bincount(owner, weights=weight[column], minlength=len(rows))
        cuts = first + np.concatenate([[0.0], np.cumsum(np.exp(steps))])
        ends = np.concatenate([[-np.inf], cuts, [np.inf]])
        upper = 1 / (1 + np.exp(-np.clip(ends[grade + 1] - score, -500, 500)))
        lower = 1 / (1 + np.exp(-np.clip(ends[grade] - score, -500, 500)))
        chance = np.maximum(upper - lower, 1e-12)
        up, low = upper * (1 - upper) / chance, lower * (1 - lower) / chance
        by_score = up - low
        by_cut = np.array(
            [low[grade == k + 1].sum() - up[grade == k].sum() for k in range(GRADES - 1)]
        )
        by_steps = np.array([by_cut[k:].sum() for k in range(1, GRADES - 1)]) * np.exp(steps)
        slope = np.concatenate(
            [
                np.bincount(column, weights=by_score[owner], minlength=len(names)) + PENALTY * weight,
                [by_cut.sum()],
                by_steps,
            ]
        )
        memory[0] = 0.9 * memory[0] + 0.1 * slope
        memory[1] = 0.99 * memory[1] + 0.01 * slope**2
        move = 0.1 * (memory[0] / (1 - 0.9**turn)) / (np.sqrt(memory[1] / (1 - 0.99**turn)) + 1e-8)
        weight -= move[: len(names)]
        first -= move[len(names)]
        steps -= move[len(names) + 1 :]
    cuts = first + np.concatenate([[0.0], np.cumsum(np.exp(steps))])
    return Severity(dict(zip(names, weight.tolist(), strict=True)), cuts.tolist())


def train(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> Severity:
    """A model of the labelled documents' severity.

    Labels say only yes or no. Grade 0 is no; a toxic document is grade 2 if it has
    more than the usual number of features that lean to toxic ones, else grade 1.
    A document with several labels counts as toxic if one says so, and so do equal
    texts, which count once; of several texts of one identifier the least counts, and
    null texts or labels not at all. What reaches the driver is bounded by the sample
    and the number of features.
    """
    known = (
        labels.where("toxic is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # As many rows as the sample has.
    chosen = documents.select("doc_id", "text").where("text is not null")
    chosen = chosen.join(F.broadcast(known), "doc_id")
    chosen = chosen.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    chosen = chosen.groupBy("text").agg(
        F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")
    )

    def listed(block):
        rows = [
            (doc_id, toxic, name)
            for doc_id, toxic, text in zip(
                block.column("doc_id").to_pylist(),
                block.column("toxic").to_pylist(),
                texts(block),
                strict=True,
            )
            for name in ["", *features(text)]
        ]
        return list(map(list, zip(*rows, strict=True))) if rows else [[], [], []]

    rows = stored(
        map_blocks(
            chosen.select("doc_id", F.col("toxic").cast("long").alias("toxic"), "text"),
            "text",
            listed,
            "doc_id long, toxic long, feature string",
        ),
        "features",
    )
    totals = rows.where("feature = ''").groupBy("toxic").count().collect()
    total = {row["toxic"]: row["count"] for row in totals}
    yes, no = sum(c for t, c in total.items() if t), total.get(0, 0)
    counts = rows.where("feature <> ''").groupBy("feature").agg(
        F.sum((F.col("toxic") != 0).cast("long")).alias("yes"),
        F.sum((F.col("toxic") == 0).cast("long")).alias("no"),
    )
    ratio = (F.col("yes") / max(yes, 1)) / ((F.col("no") + 0.5) / max(no, 1))
    leaning = (
        counts.where((F.col("yes") >= SUPPORT) & (ratio >= RATIO))
        .orderBy(F.desc("yes"), "feature")
        .limit(FEATURES)
        .select("feature")
    )
    names = sorted(row["feature"] for row in leaning.collect())
    held = (
        rows.join(F.broadcast(leaning), "feature", "left_semi")
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_set("feature")).alias("held"))
    )
    listed_rows = (
        rows.where("feature = ''").join(held, "doc_id", "left").orderBy("doc_id", "toxic").collect()
    )
    number = {name: i for i, name in enumerate(names)}
    inside = [[number[f] for f in row["held"] or ()] for row in listed_rows]
    sizes = [len(r) for r, row in zip(inside, listed_rows, strict=True) if row["toxic"]]
    usual = np.median(sizes) if sizes else 0
    grades = [
        (2 if len(r) > usual else 1) if row["toxic"] else 0
        for r, row in zip(inside, listed_rows, strict=True)
    ]
    return fit(inside, grades, names)


def scored(documents: DataFrame, model: Severity, columns: list[str]) -> DataFrame:
    """Given columns of documents with the chance of each grade and the expected severity.

    A null or empty text has no features and gets what a text without any gets; whole
    texts are read, of any length, and every row by itself.
    """
    kinds = dict(documents.dtypes)
    kept = ", ".join(f"{c} {'long' if kinds[c] == 'bigint' else kinds[c]}" for c in columns)
    schema = f"{kept}, {', '.join(f'grade_{k} double' for k in range(GRADES))}, severity double"
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def graded(block):
        grades = [shared.value.grades(text) for text in texts(block)]
        severity = [sum(k * p for k, p in enumerate(row)) for row in grades]
        return [
            *(block.column(c) for c in columns), *map(list, zip(*grades, strict=True)), severity
        ]

    return map_blocks(documents.select(*columns, "text"), "text", graded, schema)


def document_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Expected severity of every document, and whether it is rejected."""
    rows = scored(documents, train(documents, labels), ["doc_id"])
    return rows.withColumn("toxic", F.col("severity") >= REJECT)


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with all their columns; null texts stay."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    @F.pandas_udf("double")
    def severity(text: pd.Series) -> pd.Series:
        grades = (shared.value.grades(x or "") for x in text)
        return pd.Series([sum(k * p for k, p in enumerate(row)) for row in grades], dtype=float)

    return docs.where(severity(F.col("text")) < REJECT)
