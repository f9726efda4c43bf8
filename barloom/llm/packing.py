"""Best-fit packing into sequences of several permitted lengths."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.scratch import Scratch

CAPACITIES = (512, 1024, 2048, 4096)
#: What a sequence costs besides its capacity, in tokens.
OVERHEAD = 16
#: Pieces that are packed together.
GROUP = 20_000


class _Lengths:
    """A multiset of lengths that finds the largest one up to a limit: a counter, and a number whose bits say which
    lengths are there."""

    def __init__(self, lengths: Sequence[int], top: int):
        self.count = [0] * (top + 1)
        self.bits = 0
        for n in lengths:
            self.count[n] += 1
        for n, k in enumerate(self.count):
            if k:
                self.bits |= 1 << n

    def take(self, n: int) -> None:
        self.count[n] -= 1
        if not self.count[n]:
            self.bits &= ~(1 << n)

    def filled(self, free: int) -> int:
        """How many tokens fit into ``free``, the largest lengths first."""
        left, used = free, {}
        while left:
            fitting = self.bits & ((1 << (left + 1)) - 1)
            n = fitting.bit_length() - 1
            while n > 0 and used.get(n, 0) >= self.count[n]:
                fitting &= ~(1 << n)
                n = fitting.bit_length() - 1
            if n <= 0:
                break
            k = min(self.count[n] - used.get(n, 0), left // n)
            used[n] = used.get(n, 0) + k
            left -= k * n
        return free - left


def best_fit(lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD) -> list[tuple[int, int, int]]:
    """For each length, in the given order: its bin, its place in the bin, and the bin's final capacity.

    Longest first, each goes into the open bin that it leaves least space in. If none has room, a bin is opened: of
    all permitted sizes the one that costs least per token, if it is filled with the largest of the lengths still to
    come. Last, each bin shrinks to the smallest permitted size that holds its contents. Equal lengths keep their
    order; every length is 1 to the largest capacity.
    """
    capacities = sorted(capacities)
    top = capacities[-1]
    ahead = _Lengths(lengths, top)
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    free: list[list[int]] = [[] for _ in range(top + 1)]  # open bins by the space they have
    spaces = 0
    content: list[int] = []
    room: list[int] = []
    put = [(0, 0)] * len(lengths)
    for i in order:
        n = lengths[i]
        ahead.take(n)
        fitting = spaces >> n
        if fitting:
            space = n + (fitting & -fitting).bit_length() - 1
            b = free[space].pop()
            if not free[space]:
                spaces &= ~(1 << space)
        else:
            b = len(content)
            sizes = capacities[bisect_left(capacities, n) :]
            space = min(sizes, key=lambda c: ((c + overhead) / (n + ahead.filled(c - n)), -c))
            content.append(0), room.append(space)
        put[i] = (b, content[b])
        content[b] += n
        space -= n
        if space:
            free[space].append(b)
            spaces |= 1 << space
    final = [capacities[bisect_left(capacities, n)] for n in content]
    return [(b, at, final[b]) for b, at in put]


def pack(lengths: DataFrame, capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD, group: int = GROUP) -> DataFrame:
    """One row per piece of each row of ``lengths`` (doc_id, n_tokens): doc_id, piece, token_begin, token_end, bin,
    bin_offset, capacity.

    A document longer than the largest capacity is cut into pieces of that many tokens and a rest; nothing is dropped.
    A row without tokens (0 or null) is one empty piece without a bin. Repeated rows and null ids are packed like any
    others. Other columns are ignored; an empty table gives an empty one.

    Pieces are dealt evenly, by their number, into groups of about ``group``, and each group is packed by itself, so
    the memory of a task does not grow with the data.
    """
    top = max(capacities)
    scratch = Scratch(lengths.sparkSession)
    pieces = (
        lengths.select("doc_id", F.coalesce(F.col("n_tokens"), F.lit(0)).cast("bigint").alias("n_tokens"))
        .withColumn("piece", F.explode(F.expr(f"sequence(0L, greatest(0L, (n_tokens - 1) div {top}))")))
        .select(
            "doc_id",
            "piece",
            (F.col("piece") * top).alias("token_begin"),
            F.least(F.col("n_tokens"), (F.col("piece") + 1) * top).alias("token_end"),
            F.monotonically_increasing_id().alias("number"),
        )
    )
    pieces = scratch.store(pieces)
    groups = F.greatest(F.lit(1), F.ceil(pieces.agg(F.count("*") / group).scalar()))
    kind = pieces.schema["doc_id"].dataType.simpleString()

    def packed(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("number", kind="stable")
        sizes = (rows["token_end"] - rows["token_begin"]).tolist()
        placed = best_fit(sizes, capacities, overhead)
        rows["bin"] = [(int(key[0]) << 32) + b for b, _, _ in placed]
        rows["bin_offset"] = [at for _, at, _ in placed]
        rows["capacity"] = [c for _, _, c in placed]
        return rows[["doc_id", "piece", "token_begin", "token_end", "bin", "bin_offset", "capacity"]]

    schema = f"doc_id {kind}, piece bigint, token_begin bigint, token_end bigint, bin bigint, bin_offset bigint, capacity bigint"
    full = pieces.where("token_end > token_begin").withColumn("group", F.pmod(F.col("number"), groups))
    empty = pieces.where("token_end <= token_begin").selectExpr(
        "doc_id", "piece", "token_begin", "token_end", "CAST(NULL AS bigint) bin", "CAST(NULL AS bigint) bin_offset", "CAST(NULL AS bigint) capacity"
    )
    return full.groupBy("group").applyInPandas(packed, schema).unionByName(empty)
