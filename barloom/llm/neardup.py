"""Near-duplicate documents: MinHash with banding, verification on the full sets, connected components.

A document's set is its distinct 5-word shingles. Documents with equal sets are one class from the start. ``BANDS``
groups of ``ROWS`` minima each make band keys: two sets with a similarity of 0.75 share none of them once in four
million pairs.

Classes with a common band key are compared without listing a bucket's pairs. First every class is held against the
smallest class of each of its buckets, by signature, and the most similar one is verified; the links make components.
Then only buckets that still hold several components are compared within themselves, in tiles of bounded size, and
pairs across components whose signatures agree well enough are verified there. Pairs within a component need no check:
they could not change the result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.components import connected_components
from barloom.llm.scratch import Scratch, fresh
from barloom.llm.words import U64, UNSPACED, Words, grams, mix, numbers, within, word_slices

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 40, 4
#: Pairs whose signatures agree less are not verified: a pair at the limit has less once in forty million, far more
#: rarely than it shares no band.
LEAST_ESTIMATE = 0.55
#: Members of a star that one task verifies together, and classes on each side of a tile.
STAR, TILE = 256, 512
#: A key with more than this share of the rows is met by broadcast; there are fewer such keys than this number.
HEAVY = 10_000

_FACTORS = numbers(BANDS * ROWS, 101)[:, None] | U64(1)
_SHIFTS = numbers(BANDS * ROWS, 202)[:, None]
_BAND_FACTORS = numbers(ROWS, 303) | U64(1)
_BAND_SALTS = numbers(BANDS, 404)


def shingle_sets(words: Words):
    """The sorted, distinct shingle hashes of each text of a slice. Fewer words than a shingle has make one, no words
    none."""
    hashes, borders = words.hashes(), words.borders
    runs = grams(hashes, SHINGLE)
    for t in range(words.last - words.first):
        begin, end = int(borders[t]), int(borders[t + 1])
        if end - begin >= SHINGLE:
            yield np.unique(runs[begin : end - SHINGLE + 1])
        elif end > begin:
            yield grams(hashes[begin:end], end - begin)
        else:
            yield np.empty(0, dtype=U64)


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each of the universal hashes (a * x + b modulo 2**64, upper half) over a set that is not
    empty."""
    low = shingles & U64(0xFFFFFFFF)
    out = np.full(BANDS * ROWS, 2**64 - 1, dtype=U64)
    for at in range(0, len(low), 1024):
        np.minimum(out, (_FACTORS * low[at : at + 1024] + _SHIFTS).min(axis=1), out=out)
    return out >> U64(32)


def band_keys(least: np.ndarray) -> np.ndarray:
    return mix((least.reshape(BANDS, ROWS) * _BAND_FACTORS).sum(axis=1, dtype=U64) + _BAND_SALTS)


def signatures(numbered: DataFrame) -> DataFrame:
    """(doc_id, row, n_shingles, key, bands, signature) of every row of ``numbered`` (doc_id, text, row); an empty set
    has null in the last three. The signature keeps eight bits of each minimum."""

    def batches(stream):
        for batch in stream:
            sizes, keys, bands, signs = [], [], [], []
            for words in word_slices(batch.column(1), UNSPACED):
                for shingles in shingle_sets(words):
                    sizes.append(len(shingles))
                    if not len(shingles):
                        keys.append(None), bands.append(None), signs.append(None)
                        continue
                    least = minima(shingles)
                    keys.append(set_key(shingles))
                    bands.append(band_keys(least).astype(np.int64))
                    signs.append((least & U64(255)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(signs, pa.binary())],
                names=["doc_id", "row", "n_shingles", "key", "bands", "signature"],
            )

    kind = numbered.schema["doc_id"].dataType.simpleString()
    return numbered.select("doc_id", "text", "row").mapInArrow(
        batches, f"doc_id {kind}, row bigint, n_shingles bigint, key binary, bands array<bigint>, signature binary"
    )


def _agreement(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Estimated similarity of each pair of signatures; two different minima have equal low bits once in 256."""
    shape = (len(left), BANDS * ROWS)
    a = np.frombuffer(b"".join(left.to_pylist()), np.uint8).reshape(shape)
    b = np.frombuffer(b"".join(right.to_pylist()), np.uint8).reshape(shape)
    return ((a == b).mean(axis=1) - 1 / 256) * 256 / 255


def _met(rows: DataFrame, others: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """A join that moves texts, signatures or band keys. It sorts and merges at every size, so that what is measured on
    a small table holds for a large one, where neither side could be broadcast."""
    return rows.join(others.hint("merge"), key, how)


def _alike(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(center, member, estimate) of the pairs whose signatures agree well enough."""
    signs = classes.select("class", "signature")
    both = _met(_met(pairs, signs.toDF("center", "s1"), "center"), signs.toDF("member", "s2"), "member")

    def batches(stream):
        for batch in stream:
            estimate = _agreement(batch.column(2), batch.column(3))
            keep = np.flatnonzero(estimate >= LEAST_ESTIMATE)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(keep), batch.column(1).take(keep), pa.array(estimate[keep])], names=["center", "member", "estimate"]
            )

    return both.select("center", "member", "s1", "s2").mapInArrow(batches, "center bigint, member bigint, estimate double")


def _verified(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (center, member) that are similar by their full sets.

    ``texts`` (class, text) has one row per class at least. The texts of a center and its members meet in one partition,
    the center first; only its set is held while the members stream by. A center with many members is met in several
    parts.
    """
    sized = pairs.groupBy("center").agg(F.ceil(F.count("*") / STAR).alias("parts"))
    parted = pairs.join(sized, "center").select("center", "member", F.expr("pmod(xxhash64(member), parts)").alias("part"))
    wanted = sized.select("center", F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"), F.lit(0).alias("role"), F.col("center").alias("class"))
    wanted = wanted.unionByName(parted.select("center", "part", F.lit(1).alias("role"), F.col("member").alias("class")))
    met = (
        _met(texts, wanted, "class")
        .select("center", "part", "role", "class", "text")
        .repartition("center", "part")
        .sortWithinPartitions("center", "part", "role")
    )

    def batches(stream):
        center, part, first, size = None, None, None, 0
        for batch in stream:
            ids, parts, roles, members = (batch.column(i).to_pylist() for i in range(4))
            left, right, row = [], [], 0
            for words in word_slices(batch.column(4), UNSPACED):
                for shingles in shingle_sets(words):
                    if roles[row] == 0:
                        center, part, first, size = ids[row], parts[row], shingles, len(shingles)
                    elif (center, part) == (ids[row], parts[row]):
                        common = len(np.intersect1d(first, shingles, assume_unique=True))
                        if 100 * common >= PERCENT * (size + len(shingles) - common):
                            left.append(center), right.append(members[row])
                    row += 1
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["center", "member"])

    return met.mapInArrow(batches, "center bigint, member bigint").distinct()


def _tiled(open_buckets: DataFrame, classes: DataFrame) -> DataFrame:
    """(band, tile1, tile2, class, partners): the classes that must be verified against others of their tile, and
    against which.

    A bucket is dealt into blocks of about ``TILE`` classes, those of its largest component apart from the rest, and
    each pair of blocks that can hold classes of different components is one tile: the rest with the rest, and the
    rest with the largest component, never the latter with itself. No task holds a whole bucket. A pair is a
    partnership if its components differ and its signatures agree well enough, in the first band that it shares.
    """
    sizes = open_buckets.groupBy("band", "component").agg(F.count("*").alias("n"))
    sized = sizes.groupBy("band").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"),
        F.ceil(F.max("n") / TILE).alias("main_blocks"),
        F.ceil((F.sum("n") - F.max("n")) / TILE).alias("rest_blocks"),
    )
    in_main = F.col("component") == F.col("main")
    place = F.xxhash64("class")
    own = F.when(in_main, F.col("rest_blocks") + F.pmod(place, F.col("main_blocks"))).otherwise(F.pmod(place, F.col("rest_blocks")))
    placed = (
        open_buckets.join(sized, "band")
        .withColumn("block", own)
        .withColumn("others", F.when(in_main, F.col("rest_blocks")).otherwise(F.col("rest_blocks") + F.col("main_blocks")))
        .withColumn("other", F.explode(F.expr("sequence(0L, others - 1)")))
        .select("band", F.least("block", "other").alias("tile1"), F.greatest("block", "other").alias("tile2"), "block", "component", "class")
    )
    dealt = (
        _met(placed, classes.select("class", "signature", "bands"), "class")
        .select("band", "tile1", "tile2", "block", "component", "class", "signature", "bands")
        .repartition("band", "tile1", "tile2")
        .sortWithinPartitions("band", "tile1", "tile2")
    )

    def tiles(stream):
        """Whole tiles, though a tile may lie across batches."""
        rest = None
        for batch in stream:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
            keys = np.stack([table.column(i).to_numpy() for i in range(3)])
            borders = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            edges = [0, *borders.tolist()]
            for begin, end in zip(edges[:-1], edges[1:], strict=True):
                yield table.slice(begin, end - begin)
            rest = table.slice(edges[-1])
        if rest is not None and rest.num_rows:
            yield rest

    def partners_of(tile: pa.Table) -> dict[int, list[int]]:
        n = tile.num_rows
        band, first, second, block, component, ids = (tile.column(i).to_numpy() for i in range(6))
        signs = np.frombuffer(b"".join(tile.column("signature").to_pylist()), np.uint8).reshape(n, BANDS * ROWS)
        bands = tile.column("bands").combine_chunks().flatten().to_numpy().reshape(n, BANDS)
        left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
        found: dict[int, list[int]] = {}
        for i in left.tolist():
            other = right[component[right] != component[i]]
            if first[0] == second[0]:
                other = other[ids[other] > ids[i]]
            if len(other):
                estimate = ((signs[other] == signs[i]).mean(axis=1) - 1 / 256) * 256 / 255
                other = other[estimate >= LEAST_ESTIMATE]
                other = other[bands[i][(bands[other] == bands[i]).argmax(axis=1)] == band[0]]
                if len(other):
                    found.setdefault(int(ids[i]), []).extend(ids[other].tolist())
                    for j in ids[other].tolist():
                        found.setdefault(j, [])
        return found

    def batches(stream):
        for tile in tiles(stream):
            found = partners_of(tile)
            if found:
                key = [pa.array(np.full(len(found), tile.column(i)[0].as_py(), np.int64)) for i in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [*key, pa.array(found.keys(), pa.int64()), pa.array(found.values(), pa.list_(pa.int64()))],
                    names=["band", "tile1", "tile2", "class", "partners"],
                )

    return dealt.mapInArrow(batches, "band bigint, tile1 bigint, tile2 bigint, class bigint, partners array<bigint>")


def _verified_tiles(texts: DataFrame, tiled: DataFrame) -> DataFrame:
    """Pairs (center, member) that are similar by their full sets and connect all partners of a tile that verified
    links connect.

    The texts of a tile's classes meet in one partition, once each however many partners they have, and only their
    sets are held, of one tile at a time. Partners that links found before already connect need no check.
    """
    met = (
        _met(texts, tiled, "class")
        .select("band", "tile1", "tile2", "class", "partners", "text")
        .repartition("band", "tile1", "tile2")
        .sortWithinPartitions("band", "tile1", "tile2")
    )

    def links(sets: dict[int, np.ndarray], partners: dict[int, list[int]]):
        root = {c: c for c in sets}

        def top(c):
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        for a, others in partners.items():
            for b in others:
                if a in sets and b in sets and top(a) != top(b):
                    common = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                    if 100 * common >= PERCENT * (len(sets[a]) + len(sets[b]) - common):
                        root[top(a)] = top(b)
                        yield min(a, b), max(a, b)

    def batches(stream):
        now, sets, partners = None, {}, {}
        for batch in stream:
            tile, found = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)), []
            ids, lists, row = batch.column(3).to_pylist(), batch.column(4), 0
            for words in word_slices(batch.column(5), UNSPACED):
                for shingles in shingle_sets(words):
                    if tile[row] != now:
                        found += links(sets, partners)
                        now, sets, partners = tile[row], {}, {}
                    sets[ids[row]], partners[ids[row]] = shingles, lists[row].as_py()
                    row += 1
            yield _pairs(found)
        yield _pairs(list(links(sets, partners)))

    return met.mapInArrow(batches, "center bigint, member bigint").distinct()


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["center", "member"])


def _looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row for each ``key`` of them and their number ``n``.

    Keys with more than one row in ``HEAVY`` are fewer than ``HEAVY``, however many rows there are: their entries are
    broadcast and their rows stay where they are. The rows of all others meet their entries by a shuffle.
    """
    least = F.coalesce(table.agg(F.sum("n") / HEAVY).scalar(), F.lit(0))
    heavy = F.broadcast(table.where(F.col("n") > least).drop("n"))
    others = rows.join(F.broadcast(table.where(F.col("n") > least).select(key)), key, "left_anti")
    return rows.join(heavy, key).unionByName(others.join(table.where(F.col("n") <= least).drop("n"), key))


def near_duplicates(documents: DataFrame, row: str | None = None) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text): its number ``row``, doc_id, n_shingles, component_id, keeper.

    ``row`` may name a column of ``documents`` that numbers its rows, the same at each reading; else they are numbered
    and stored first. ``component_id`` is the smallest doc_id that verified links reach, the row's own included.
    ``keeper`` marks one row of each component: the one with that doc_id, the first of them if the id is repeated. Null
    ids come last: a row without an id takes its component's smallest id, null if there is none. Null texts and texts
    without words are linked with nothing. Texts of any length are read whole. Repeated rows are linked like any copies.
    Other columns are ignored, an empty table gives an empty one.
    """
    scratch = Scratch(documents.sparkSession)
    text = F.col("text").cast("string").alias("text")
    if row:
        numbered = documents.select("doc_id", text, F.col(row).alias("row"))
    else:
        numbered = scratch.store(documents.select("doc_id", text, F.monotonically_increasing_id().alias("row")))
    rows = scratch.store(signatures(numbered))
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    copies = rows.where("key IS NOT NULL").groupBy("key")
    keyed = scratch.store(copies.agg(F.min("row").alias("class"), F.min(first).alias("head"), F.count("*").alias("n")))
    classes = scratch.store(_met(rows, keyed.select(F.col("class").alias("row")), "row", "left_semi").withColumnRenamed("row", "class"))
    texts = numbered.select(F.col("row").alias("class"), "text")

    banded = classes.select("class", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("class").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    buckets = scratch.store(_met(banded, shared, "band"))  # members of buckets with two classes at least
    stars = buckets.where("class != least").select(F.col("least").alias("center"), F.col("class").alias("member")).distinct()
    best = _alike(stars, classes).groupBy("member").agg(F.max_by("center", F.struct("estimate", -F.col("center"))).alias("center"))
    links = scratch.store(_verified(texts, scratch.store(best.select("center", "member"))))
    found = connected_components(links, scratch)

    placed = buckets.join(found.withColumnRenamed("node", "class"), "class", "left").select(
        "band", "class", F.coalesce("component", "class").alias("component")
    )
    placed = scratch.store(placed)
    scratch.drop(buckets)
    several = placed.groupBy("band").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a != b").select("band")
    tiled = scratch.store(_tiled(placed.join(several, "band", "left_semi"), classes))
    more = _verified_tiles(texts, tiled)
    found = connected_components(links.unionByName(more), scratch)
    for done in (placed, tiled, classes):
        scratch.drop(done)

    # Each class takes its component's head, then each row that of its class; unlinked classes have their own.
    linked = scratch.store(
        keyed.join(found.unionByName(found.select(F.col("component").alias("node"), "component").distinct()).withColumnRenamed("node", "class"), "class")
        .select("key", "component", F.col("head").alias("own"))
    )
    components = scratch.store(linked.groupBy("component").agg(F.min("own").alias("of_all"), F.count("*").alias("n")))
    headed = _looked_up(linked.select("key", "component"), components, "component").select("key", "of_all")
    table = scratch.store(keyed.join(headed, "key", "left").select("key", F.coalesce("of_all", "head").alias("head"), "n"))
    known = rows.select("row", "doc_id", "n_shingles", "key")
    placed = _looked_up(known.where("key IS NOT NULL"), table, "key").select(
        "row", "doc_id", "n_shingles", F.col("head.doc_id").alias("component_id"), (F.col("head.row") == F.col("row")).alias("keeper")
    )
    alone = known.where("key IS NULL").select("row", "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("keeper"))
    return placed.unionByName(alone)


def one_of_each(documents: DataFrame) -> DataFrame:
    """The rows of ``documents``, with their columns, without all but one of each group of near-duplicates."""
    number = fresh("row", documents.columns)
    numbered = Scratch(documents.sparkSession).store(documents.withColumn(number, F.monotonically_increasing_id()))
    keepers = near_duplicates(numbered, number).where("keeper").select(F.col("row").alias(number))
    return numbered.join(keepers, number, "left_semi").select(*documents.columns)
