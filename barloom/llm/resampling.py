"""Importance resampling towards a target distribution: hashed word runs, Gumbel scores, an exact cut by bisection.

Two passes over the texts: one counts the buckets of the corpus and of the target, the other scores every document with
the array of gains. Everything after that works on the stored scores, a few numbers a document.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.crc import crc32_extend, crc32_of_words, crc32_with_blank
from barloom.llm.scratch import Scratch, ship_package
from barloom.llm.words import LETTERS, Words, within, word_slices
from barloom.session import local_rows

BUCKETS = 10_000
LONGEST_RUN = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
#: Thresholds that one counting job tries: four halvings of what is left.
TRIED = 15


def feature_buckets(words: Words, longest_run: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, number of the text within the slice) of every run of 1, 2, ... words within one text, ascending by text.
    The checksum of a run goes on from that of the run one word shorter."""
    n, crc = len(words.begin), crc32_of_words(words.data, words.begin, words.end)
    for run in range(1, longest_run + 1):
        if run > 1:
            n = max(0, len(words.begin) - run + 1)
            crc = crc32_extend(crc32_with_blank(crc[:n]), words.data, words.begin[run - 1 :], words.end[run - 1 :])
        inside = within(words.text, run)
        yield (crc[inside] % np.uint32(buckets)).astype(np.int64), words.text[:n][inside]


def bucket_counts(texts: DataFrame, longest_run: int = LONGEST_RUN, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all features of a column ``text``, repeats counted. Each task adds up one array and hands on its
    buckets once, so what is shuffled does not depend on how many texts there are. Null and empty texts have none."""
    ship_package(texts.sparkSession)

    def counted(stream):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in stream:
            for words in word_slices(batch.column(0), LETTERS):
                for bucket, _ in feature_buckets(words, longest_run, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    parts = texts.select(F.col("text").cast("string")).mapInArrow(counted, "bucket bigint, n bigint")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_array(counts: DataFrame, buckets: int) -> list[int]:
    """The counts as one array. Its size is the number of buckets, a parameter."""
    out = [0] * buckets
    for row in counts.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """Thousandths of the log ratio of a bucket's smoothed share in the target to that in the corpus, rounded down."""
    n, s_all, t_all = len(corpus), sum(corpus), sum(target)
    return [
        math.floor(1000 * math.log(float((t + 1) * (s_all + n)) / float((s + 1) * (t_all + n))))
        for s, t in zip(corpus, target, strict=True)
    ]


def gumbel(seed: int, doc_id: str) -> int:
    """A document's own draw from the Gumbel distribution, in thousandths: taking the largest sums of weight and draw is
    sampling without replacement in proportion to exp(weight)."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(documents: DataFrame, gain: list[int], longest_run: int = LONGEST_RUN, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row; nothing is shuffled."""
    ship_package(documents.sparkSession)
    names = ["n_words", "n_features", "weight"]

    def batches(stream):
        values = np.array(gain, dtype=np.int64)
        for batch in stream:
            out = {name: np.zeros(batch.num_rows, dtype=np.int64) for name in names}
            for words in word_slices(batch.column(2), LETTERS):
                here, n = slice(words.first, words.last), words.last - words.first
                out["n_words"][here] = words.per_text
                for bucket, text in feature_buckets(words, longest_run, len(values)):
                    sums = np.concatenate([[0], np.cumsum(values[bucket])])
                    border = np.searchsorted(text, np.arange(n + 1))
                    out["n_features"][here] += np.diff(border)
                    out["weight"][here] += sums[border[1:]] - sums[border[:-1]]
            draw = np.array([gumbel(seed, name or "") for name in batch.column(1).to_pylist()], dtype=np.int64)
            columns = [pa.array(out[name]) for name in names]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array(out["weight"] + draw)], names=["doc_id", *names, "score"]
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", F.col("doc_id").cast("string").alias("name"), F.col("text").cast("string")).mapInArrow(
        batches, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint, score bigint"
    )


def threshold(rows: DataFrame, key: Column, n: int) -> tuple[int, int, int]:
    """(value, below, upto): the least value that at least ``n`` rows do not exceed, how many are below it, and how many
    do not exceed it. ``n`` is at most the number of rows. Every round is one exact count job over the stored rows that
    tries several values and keeps the interval in which the count passes ``n``."""
    first = rows.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(key).alias("n")).first()
    low, high, below, upto = first["low"], first["high"], 0, first["n"]
    while low < high:
        tried = sorted({low + (high - low) * i // (TRIED + 1) for i in range(1, TRIED + 1)})
        counts = rows.agg(*[F.count_if(key <= F.lit(t)).alias(str(i)) for i, t in enumerate(tried)]).first()
        for t, count in zip(tried, counts, strict=True):
            if count >= n:
                high, upto = t, count
                break
            low, below = t + 1, count
    return low, below, upto


def first_rows(rows: DataFrame, keys: list[Column], n: int) -> Column:
    """A condition that exactly the first ``n`` rows in ascending order of the whole-number keys meet; the keys tell any
    two rows apart. Rows that tie with the last one are told apart by the next key."""
    if n <= 0:
        return F.lit(False)
    chosen, tied = F.lit(False), F.lit(True)
    for key in keys:
        value, below, upto = threshold(rows.where(tied), key, n)
        chosen, tied, n = chosen | (tied & (key < F.lit(value))), tied & (key == F.lit(value)), n - below
        if upto - below == n:
            break
    return chosen | tied


def order_keys(rows: DataFrame) -> list[Column]:
    """Whole-number keys for: score descending, doc_id ascending with null last, and the stored row number for rows that
    agree in both. Ids of text compare by their bytes, seven at a time."""
    doc_id, keys = F.col("doc_id"), [-F.col("score"), F.col("doc_id").isNull().cast("bigint")]
    if isinstance(rows.schema["doc_id"].dataType, T.IntegralType):
        keys.append(F.coalesce(doc_id.cast("bigint"), F.lit(0)))
    else:
        name = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
        longest = rows.agg(F.max(F.octet_length(name)).alias("n")).first()["n"] or 0
        for at in range(0, longest, 7):
            part = F.rpad(F.hex(F.substring(name, at + 1, 7)), 14, "0")
            keys.append(F.conv(part, 16, 10).cast("bigint"))
        keys.append(F.octet_length(name).cast("bigint"))
    return [*keys, F.col("row")]


def ranked(scratch: Scratch, rows: DataFrame, keys: list[Column]) -> DataFrame:
    """The rows with their ``rank``: they are dealt to ranges and numbered within them; a range begins where the ones
    before it end. Only the sizes of the ranges come to the driver, one number per shuffle partition."""
    order = [key.asc() for key in keys]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = scratch.store(dealt.withColumn("place", F.monotonically_increasing_id()))
    part, within_part = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    begins, total = [], 0
    for row in sorted(placed.groupBy(part.alias("part")).count().collect()):
        begins.append((row["part"], total))
        total += row["count"]
    begin = F.broadcast(local_rows(scratch.spark, begins, "part bigint, begin bigint"))
    joined = placed.withColumn("part", part).join(begin, "part")
    return joined.withColumn("rank", F.col("begin") + within_part + 1).drop("part", "begin", "place")


def resample(
    documents: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    longest_run: int = LONGEST_RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document: of those with ``least_words`` words or more,
    ``percent`` in a hundred are drawn, the highest scores first, ties to the smaller doc_id; ``rank`` is null where a
    document is not drawn.

    Null and empty texts have no features and weight 0; a null doc_id draws as the empty text and ties after all others.
    Texts of any length count whole. Repeated rows score and are drawn each for itself; those that agree in score and
    doc_id are told apart by their stored row number. Without target texts the gains come from the corpus alone; without
    documents there are no rows. Only ``doc_id`` and ``text`` are read, other columns are ignored."""
    scratch = Scratch(documents.sparkSession)
    documents, target = documents.select("doc_id", "text"), target.select("text")
    corpus = bucket_array(bucket_counts(documents, longest_run, buckets), buckets)
    wanted = bucket_array(bucket_counts(target, longest_run, buckets), buckets)
    scores = scored(documents, gains(corpus, wanted), longest_run, seed)
    rows = scratch.store(scores.withColumn("row", F.monotonically_increasing_id()))
    eligible = F.col("n_words") >= least_words
    fit = rows.where(eligible)
    keys = order_keys(rows)
    drawn = first_rows(fit, keys, percent * fit.count() // 100)
    rest = rows.where(~(eligible & drawn)).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked(scratch, fit.where(drawn), keys).unionByName(rest).drop("row")
