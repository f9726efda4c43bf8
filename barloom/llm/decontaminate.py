"""Benchmark decontamination by winnowing: find the words of a document that repeat a passage of a benchmark.

A passage is a run of ``window`` consecutive words of an item; an item of fewer words, but not none, is one passage.
Of every run of ``window`` words, winnowing keeps the smallest hash of its k-grams. Two equal runs keep the same one,
so a join of the kept hashes finds every shared passage. Each joined pair is then extended word by word, to both
sides, and counts if the equal words reach a whole window. Words are compared as text, so a hash collision adds
nothing.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.scratch import Scratch, without_rows
from barloom.llm.words import LETTERS, U64, grams, mix, within, word_slices

WINDOW = 10
GRAM = 5
#: Bits of the sieve that keeps hashes no item has out of the shuffle: 8 MB, whatever the size of the benchmark.
SIEVE_BITS = 26

CANDIDATE = "struct<n:int,hash:bigint,at:array<int>,gram:array<string>,before:array<string>,after:array<string>>"
_ARROW_CANDIDATE = pa.struct(
    [("n", pa.int32()), ("hash", pa.int64()), ("at", pa.list_(pa.int32()))]
    + [(side, pa.list_(pa.string())) for side in ("gram", "before", "after")]
)


def winnow(hashes: np.ndarray, text: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Which k-grams are the smallest of some run of ``window`` words within one text (all of them, if several are)."""
    span = window - gram + 1  # k-grams of one run
    runs = within(text, window)
    if not len(runs):
        return np.zeros(len(hashes), dtype=bool)
    least = hashes[: len(runs)].copy()
    for j in range(1, span):
        np.minimum(least, hashes[j : j + len(runs)], out=least)
    kept = np.zeros(len(hashes), dtype=bool)
    for j in range(span):
        kept[j : j + len(runs)] |= runs & (hashes[j : j + len(runs)] == least)
    return kept


def _salted(hashes: np.ndarray, n: int) -> np.ndarray:
    return mix(hashes + U64(n + 1))


def _candidates(words, window: int, gram: int, short: list[int], sieve: np.ndarray | None) -> dict[int, list]:
    """Per text of a slice, the k-grams to join: winnowed ones (n = 0) with the words around them, and for each length
    in ``short`` (the word counts of short items) all runs of that many words."""
    found: dict[int, dict] = defaultdict(dict)
    hashes, borders, text = words.hashes(), words.borders, words.text
    for n in [0, *short]:
        size = n or gram
        runs = _salted(grams(hashes, size), n)
        keep = within(text, size) if n else winnow(runs, text, window, gram)
        if sieve is not None:
            keep &= sieve[(runs >> U64(64 - SIEVE_BITS + 3)).astype(np.int64)] >> ((runs >> U64(64 - SIEVE_BITS)) & U64(7)).astype(np.uint8) & 1 == 1
        reach = 0 if n else window - gram
        for i in np.flatnonzero(keep).tolist():
            t = int(text[i])
            low, high = max(int(borders[t]), i - reach), min(int(borders[t + 1]), i + size + reach)
            around = tuple(words.string(w) for w in range(low, high))
            key = (n, int(runs[i].astype(np.int64)), i - low, around)
            found[t].setdefault(key, []).append(i - int(borders[t]))
    return {
        t: [
            {"n": n, "hash": h, "at": at, "gram": list(a[lead : lead + (n or gram)]), "before": list(a[:lead][::-1]), "after": list(a[lead + (n or gram) :])}
            for (n, h, lead, a), at in runs.items()
        ]
        for t, runs in found.items()
    }


def _read(frame: DataFrame, id_column: str, window: int, gram: int, items: bool, short=(), sieve=None) -> DataFrame:
    """(id, digest of the text, n_words, candidates) of every row. An item shorter than the window has one candidate,
    all of its words."""

    def batches(stream):
        bits = sieve.value if sieve is not None else None
        for batch in stream:
            counts, lists = [], []
            for words in word_slices(batch.column(1), LETTERS):
                sizes = words.per_text
                lengths = sorted({int(n) for n in sizes if 0 < n < window}) if items else list(short)
                found = _candidates(words, window, gram, lengths, bits)
                counts.append(sizes)
                for t, n in enumerate(sizes.tolist()):
                    own = found.get(t, [])
                    lists.append([c for c in own if c["n"] == (n if n < window else 0)] if items else own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(np.concatenate([*counts, np.empty(0, np.int64)]), pa.int64()), pa.array(lists, pa.list_(_ARROW_CANDIDATE))],
                names=["id", "digest", "n_words", "candidates"],
            )

    kind = frame.schema[id_column].dataType.simpleString()
    return frame.select(F.col(id_column).alias("id"), F.col("text").cast("string"), F.xxhash64(F.col("text").cast("string"))).mapInArrow(
        batches, f"id {kind}, digest bigint, n_words bigint, candidates array<{CANDIDATE}>"
    )


def _sieve(grams_of_items: DataFrame) -> np.ndarray:
    """A bitmap of the items' hashes. At most 2**(SIEVE_BITS - 5) rows reach the driver, however large the benchmark."""
    place = F.shiftrightunsigned("hash", 64 - SIEVE_BITS)
    rows = (
        grams_of_items.groupBy(F.shiftright(place, 5).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(pmod({0}, 32) AS INT))".format(f"shiftrightunsigned(hash, {64 - SIEVE_BITS})"))).alias("bits"))
        .toPandas()
    )
    words = np.zeros(1 << (SIEVE_BITS - 5), dtype="<u4")
    words[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).astype("<u4")
    return words.view(np.uint8)


def _equal_words(left: str, right: str) -> Column:
    """How many words two lists share from their start on."""
    differ = F.expr(f"array_position(zip_with({left}, {right}, (x, y) -> coalesce(x = y, false)), false)")
    return F.when(differ == 0, F.expr(f"size({left})")).otherwise(differ - 1)


def contaminated_words(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text): its place ``row``, doc_id, ``digest`` of the text, n_words,
    ``spans`` (array of begin and end, in words, of what repeats a passage; joined where they overlap or touch),
    n_hit, ``items`` (ids of the items, as sorted strings).

    Null and empty texts have no words and no hits. Repeated rows and null ids are rows of their own; an item that is
    repeated counts once per item_id, one with a null id hits but has no name. Other columns of both tables are
    ignored. An empty benchmark hits nothing.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark)
    items = scratch.store(
        _read(benchmark, "item_id", window, gram, items=True)
        .select(F.col("id").cast("string").alias("item"), F.explode("candidates").alias("c"))
        .select("item", "c.*")
        .drop("at")
    )
    short = sorted(r[0] for r in items.where("n > 0").select("n").distinct().collect())  # fewer than a window of them
    sieve = spark.sparkContext.broadcast(_sieve(items))
    read = scratch.store(
        _read(documents, "doc_id", window, gram, items=False, short=short, sieve=sieve).withColumn(
            "row", F.monotonically_increasing_id()
        )
    )
    theirs = items.select(
        "n", "hash", F.col("gram").alias("gram2"), F.col("before").alias("before2"), F.col("after").alias("after2"), "item"
    ).distinct()
    pairs = (
        read.select("row", F.explode("candidates").alias("c"))
        .select("row", "c.*")
        .join(theirs, ["n", "hash"])
        .where("gram = gram2")
        .select(
            "row", "item", "n", "at", _equal_words("before", "before2").alias("left"), _equal_words("after", "after2").alias("right")
        )
        .where(F.expr(f"n > 0 OR {gram} + left + right >= {window}"))
    )
    size = F.when(F.col("n") > 0, F.col("n")).otherwise(gram)
    hits = scratch.store(
        pairs.select("row", "item", "left", (size + F.col("right")).alias("right"), F.explode("at").alias("at"))
        .select("row", "item", (F.col("at") - F.col("left")).cast("int").alias("b"), (F.col("at") + F.col("right")).cast("int").alias("e"))
        .distinct()
    )
    union = F.expr(
        "aggregate(array_sort(spans), CAST(array() AS array<struct<b:int,e:int>>), (done, s) ->"
        " if(size(done) > 0 AND done[size(done) - 1].e >= s.b,"
        " concat(slice(done, 1, size(done) - 1),"
        " array(struct(done[size(done) - 1].b AS b, greatest(done[size(done) - 1].e, s.e) AS e))),"
        " concat(done, array(s))))"
    )
    spans = (
        hits.select("row", F.struct("b", "e").alias("s")).distinct().groupBy("row").agg(F.collect_list("s").alias("spans"))
    ).select("row", union.alias("spans"))
    names = hits.select("row", "item").distinct().groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    return (
        read.select("row", F.col("id").alias("doc_id"), "digest", "n_words")
        .join(spans, "row", "left")
        .join(names, "row", "left")
        .select(
            "row",
            "doc_id",
            "digest",
            "n_words",
            F.coalesce("spans", F.expr("CAST(array() AS array<struct<b:int,e:int>>)")).alias("spans"),
            F.coalesce(F.expr("aggregate(spans, 0L, (n, s) -> n + s.e - s.b)"), F.lit(0).cast("bigint")).alias("n_hit"),
            F.coalesce("items", F.expr("CAST(array() AS array<string>)")).alias("items"),
        )
    )


def clean_documents(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``documents``, with their columns whatever their names, in which no passage of the benchmark occurs."""
    return without_rows(documents, contaminated_words(documents, benchmark, window).where("n_hit > 0"))
