"""Quality scores: kernel ridge regression over document statistics, calibrated.

Random Fourier features approximate a Gaussian kernel over the statistics of a text. Each partition sums its part of
the normal equations; the sums are solved for the ridge scores; isotonic regression on training rows that the ridge
has not seen turns scores into probabilities.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.folds import held_out, training_labels
from barloom.llm.scratch import Scratch
from barloom.llm.words import LETTERS, U64, Words, grams, text_bytes, within, word_slices

FOLDS, FOLD = 3, 1
#: Labelled rows that are learned from, at most.
SAMPLE = 100_000
#: One training row in so many calibrates instead of entering the ridge.
CALIBRATION = 4
FEATURES, WIDTH, RIDGE, SEED = 256, 4.0, 1e-3, 7

CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "symbol": b"#$%&*@^~+=<>", "bang": b"!?", "bar": b"|\\/_", "stop": b".",
    "comma": b",;:", "quote": b"\"'()[]{}", "dash": b"-", "line": b"\n", "space": b" \t\r",
}
STATISTICS = [
    "log_bytes", "log_words", "word_bytes", "one_byte_words", "long_words", "beyond_ascii", *CLASSES, "same_as_before", "distinct_words",
    "distinct_grams", "distinct_lines", "words_per_line",
]
_TABLES = [np.isin(np.arange(256), np.frombuffer(chars, np.uint8)) for chars in CLASSES.values()]
_NOT_LINE_END = np.arange(256) != 10


def _distinct(text: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """How many different hashes each text has (44 bits of them are looked at)."""
    keys = np.sort((text.astype(U64) << U64(44)) | (hashes >> U64(20)))
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    return np.bincount((keys[first] >> U64(44)).astype(np.int64), minlength=n)


def statistics(words: Words, lines: Words, raw: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """A row of numbers per text of a slice; ``lines`` are the same texts cut at line ends."""
    n = words.last - words.first
    size, counts, hashes = np.diff(borders), words.per_text, words.hashes()
    at_least = lambda x: np.maximum(1, x)
    count = lambda which: np.bincount(words.text[which], minlength=n)
    places = borders - borders[0]

    def share(table):
        return np.diff(np.concatenate([[0], np.cumsum(table[raw])])[places]) / at_least(size)

    length = words.end - words.begin
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (words.text[1:] == words.text[:-1])
    triple = within(words.text, 3)
    return np.column_stack([
        np.log1p(size), np.log1p(counts), np.bincount(words.text, length, n) / at_least(counts), count(length == 1) / at_least(counts),
        count(length > 12) / at_least(counts), share(np.arange(256) >= 128), *[share(t) for t in _TABLES], count(again) / at_least(counts),
        _distinct(words.text, hashes, n) / at_least(counts),
        _distinct(words.text[: len(triple)][triple], grams(hashes, 3)[triple], n) / at_least(counts - 2),
        _distinct(lines.text, lines.hashes(), n) / at_least(lines.per_text), np.log1p(counts / at_least(lines.per_text)),
    ])


def document_statistics(documents: DataFrame) -> DataFrame:
    """(doc_id, s) of every row: its statistics, in the order of ``STATISTICS``. Null and empty texts have zeros."""
    m = len(STATISTICS)

    def batches(stream):
        for batch in stream:
            data, offsets = text_bytes(batch.column(1))
            rows = [np.empty((0, m))]
            for words, lines in zip(word_slices(batch.column(1), LETTERS), word_slices(batch.column(1), _NOT_LINE_END), strict=True):
                borders = offsets[words.first : words.last + 1]
                rows.append(statistics(words, lines, data[borders[0] : borders[-1]], borders))
            s = np.concatenate(rows)
            lists = pa.ListArray.from_arrays(np.arange(0, s.size + 1, m, dtype=np.int32), pa.array(s.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "s"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("text").cast("string")).mapInArrow(batches, f"doc_id {kind}, s array<double>")


class Fourier:
    """cos(xW + b): inner products of such rows approximate exp(-|x - y|^2 / (2 * WIDTH^2)) over standardised
    statistics."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, features: int = FEATURES, width: float = WIDTH, seed: int = SEED):
        random = np.random.default_rng(seed)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.w = random.normal(0, 1 / width, (len(mean), features))
        self.b = random.uniform(0, 2 * np.pi, features)

    def __call__(self, s: np.ndarray) -> np.ndarray:
        x = np.clip((s - self.mean) / self.spread, -8, 8)
        return np.column_stack([np.sqrt(2 / len(self.b)) * np.cos(x @ self.w + self.b), np.ones(len(s))])


def _matrix(column: pa.Array, m: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=float).reshape(-1, m)


def normal_equations(rows: DataFrame, fourier: Fourier) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y of rows (s, label). Each partition sums its own; the sums are added up in Spark, so what reaches
    the driver depends on the number of features alone."""
    m, d = len(fourier.mean), len(fourier.b) + 1
    upper = np.triu_indices(d + 1)

    def batches(stream):
        total = np.zeros((d + 1, d + 1))
        for batch in stream:
            z = np.column_stack([fourier(_matrix(batch.column(0), m)), batch.column(1).to_numpy().astype(float)])
            total += z.T @ z
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), pa.array(total[upper])], names=["i", "j", "v"]
        )

    sums = rows.select("s", "label").mapInArrow(batches, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    whole = np.zeros((d + 1, d + 1))
    whole[sums["i"], sums["j"]] = sums["v"]
    whole = np.triu(whole) + np.triu(whole, 1).T
    return whole[:d, :d], whole[:d, d]


def _scored(rows: DataFrame, fourier: Fourier, weights: np.ndarray, steps: tuple[np.ndarray, np.ndarray] | None, keep: list[str]) -> DataFrame:
    """``keep`` columns and the score: the ridge's, or the calibrated one."""
    m = len(fourier.mean)

    def batches(stream):
        for batch in stream:
            ridge = fourier(_matrix(batch.column(0), m)) @ weights
            score = ridge if steps is None else calibrated(ridge, steps)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(score)], names=[*keep, "score"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select("s", *keep).mapInArrow(batches, f"{kinds}, score double")


def calibrated(ridge: np.ndarray, steps: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Probability by the isotonic steps; within a step a hundredth of the ridge score keeps the order."""
    return 0.99 * np.interp(ridge, *steps) + 0.01 * np.clip(ridge, 0, 1)


def quality_scores(documents: DataFrame, labels: DataFrame, folds: int = FOLDS, fold: int = FOLD, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text): doc_id, row (its number), held_out, score, predicted.

    Null and empty texts are scored by their statistics, all zero. Repeated rows score alike; null ids are held out.
    Without a training label every score is 0. Other columns are ignored; an empty table gives an empty one.
    """
    scratch = Scratch(documents.sparkSession)
    seen = scratch.store(document_statistics(documents).withColumn("row", F.monotonically_increasing_id()))
    out = held_out(F.col("doc_id"), folds, fold)
    train = scratch.store(
        seen.join(training_labels(labels, "quality", folds, fold, sample), "doc_id").select(
            "s", "label", (F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(CALIBRATION)) == 0).alias("calibrates")
        )
    )
    if train.isEmpty():
        return seen.select("doc_id", "row", out.alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    m = len(STATISTICS)
    moments = seen.agg(*[f(F.col("s")[i]).alias(f"{n}{i}") for n, f in (("a", F.avg), ("d", F.stddev_pop)) for i in range(m)]).toPandas().to_numpy(float)[0]
    fourier = Fourier(moments[:m], moments[m:])
    gram, right = normal_equations(train.where("NOT calibrates"), fourier)
    weights = np.linalg.solve(gram + RIDGE * max(1.0, gram[-1, -1]) * np.eye(len(gram)), right)
    held = train.where("calibrates")
    held = train if held.isEmpty() else held
    ridge = _scored(held, fourier, weights, None, ["label"]).select(F.col("score").alias("features"), F.col("label").cast("double").alias("label"))
    fitted = IsotonicRegression().fit(ridge)
    steps = (np.array(fitted.boundaries.toArray()), np.array(fitted.predictions.toArray()))
    scored = _scored(seen, fourier, weights, steps, ["doc_id", "row"])
    return scored.select("doc_id", "row", out.alias("held_out"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
