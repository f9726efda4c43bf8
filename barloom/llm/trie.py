"""A prefix trie over sequences of turns by recursion on depth.

Sequences are cut at half depth; the cut prefixes are named; the pieces above the cuts form the upper trie, those below
one forest per cut, and both go the same way in parallel until a piece is one turn. A name is the digest of the name at
the piece's root and of the content above the cut, so equal prefixes have equal names wherever they are found, and no
row waits for another. Pieces of up to ``HEIGHT`` turns are cut within a row; the recursion above that runs over rows of
such pieces, one shuffle per level, so a sequence may be of any length. At the end the totals of the lower forests are
grafted to everything above their roots.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.scratch import Scratch
from barloom.session import local_rows

#: Turns of a piece that is cut within a row; a power of two.
HEIGHT = 64
LEVEL = HEIGHT.bit_length() - 1
#: Bytes of a digest that are kept as a name.
NAME = 16
ROOT = bytes(NAME)
#: Rows of one sequence that share a join key at most.
SHARE = 4096
#: A node with more than one in so many of all nodes as its children counts as heavy: there are fewer heavy ones.
HEAVY = 10_000
#: Ids that one row of a list holds.
IDS = 8192


def _digest(a: bytes, b: bytes) -> bytes:
    return hashlib.sha256(a + b).digest()[:NAME]


def _digest_column(text: Column) -> Column:
    return F.substring(F.unhex(F.sha2(text, 256)), 1, NAME)


def named(root: bytes, keys: list[bytes], height: int = HEIGHT) -> tuple[list[bytes], bytes | None]:
    """Names of the prefixes of 1, 2, ... turns below ``root``, and the content of the whole piece if it is complete. The
    prefix of all ``height`` turns is a cut of the recursion above and has no name here."""
    if height == 1:
        return [], (keys[0] if keys else None)
    half = height // 2
    upper, content = named(root, keys[:half], half)
    if content is None:
        return upper, None
    cut = _digest(root, content)
    lower, rest = named(cut, keys[half:], half)
    return [*upper, cut, *lower], (_digest(content, rest) if rest is not None else None)


# ---------------------------------------------------------------- sequences


def turn_rows(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, key, words) without texts. A null role or text is empty; rows without a conv_id belong to no
    conversation and are left out."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        _digest_column(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("key"),
        F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]++")).cast("bigint").alias("words"),
    )


def numbered(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """(conv_id, pos, key, words): each conversation's turns from 0 on, by turn (null first), rows of one turn by their
    digest. Rows are dealt to ranges, so that a conversation of any length is spread; a range learns from the ends of
    those before it where its first conversation goes on."""
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("key").asc()]

    def count_up(stream):
        last, count = None, 0
        for batch in stream:
            if not batch.num_rows:
                continue
            ids = batch.column(0)
            new = np.ones(batch.num_rows, dtype=bool)
            new[1:] = pc.not_equal(ids[1:], ids[:-1]).to_numpy(zero_copy_only=False)
            new[0] = ids[0].as_py() != last
            place = np.arange(batch.num_rows)
            start = np.maximum.accumulate(np.where(new, place, -1))
            pos = np.where(start >= 0, place - start, place + count)
            last, count = ids[-1].as_py(), int(pos[-1]) + 1
            yield pa.RecordBatch.from_arrays([ids, pa.array(pos), batch.column(1), batch.column(2)], names=["conv_id", "pos", "key", "words"])

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "key", "words")
    counted = dealt.mapInArrow(count_up, "conv_id bigint, pos bigint, key binary, words bigint")
    placed = scratch.store(counted.withColumn("part", F.spark_partition_id()))
    edges = placed.groupBy("part").agg(
        F.min("conv_id").alias("first"),
        F.max("conv_id").alias("last"),
        (F.max_by("pos", F.struct("conv_id", "pos")) + 1).alias("n"),
    )
    shifts, before, open_id = [], 0, None
    for part, first, last, n in sorted(tuple(row) for row in edges.collect()):  # one row per shuffle partition
        before = before if first == open_id else 0
        if before:
            shifts.append((part, first, before))
        before, open_id = (before + n if first == last else n), last
    moved = F.broadcast(local_rows(scratch.spark, shifts, "part int, conv_id bigint, shift bigint"))
    pos = (F.col("pos") + F.coalesce("shift", F.lit(0))).alias("pos")
    return placed.join(moved, ["part", "conv_id"], "left").select("conv_id", pos, "key", "words")


def sequences(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The numbered turns as they are, and (conv_id, n) of their conversations."""
    return rows, rows.groupBy("conv_id").agg(F.count("*").alias("n"))


def rebuilt(rows: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Every conversation with its first turns taken from the first conversation of its group: (conv_id, pos, key, words)
    and (conv_id, n) of all conversations, those without turns too. h, how many turns are replaced, is the checksum of
    the id modulo ``most``; a shorter or absent first conversation gives what it has.

    Turns meet their conversation's row in shares of ``SHARE`` turns, so that no key is hot."""
    conv_id = F.col("conv_id")
    h = F.crc32(conv_id.cast("string").cast("binary")) % most
    heads = rows.where((conv_id % group == 0) & (F.col("pos") < most - 1))
    have = heads.groupBy(conv_id.alias("base")).agg(F.count("*").alias("have"))
    _, sizes = sequences(rows)
    sizes = sizes.withColumn("base", conv_id - conv_id % group).withColumn("h", h).join(have, "base", "left")
    sizes = sizes.withColumn("taken", F.least("h", F.coalesce("have", F.lit(0))))
    shares = sizes.select(
        "conv_id", "h", "taken", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / SHARE))).alias("share")
    )
    own = rows.withColumn("share", F.floor(F.col("pos") / SHARE)).join(shares, ["conv_id", "share"]).where(F.col("pos") >= F.col("h"))
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "key", "words")
    first = heads.withColumnRenamed("conv_id", "base").join(sizes.select("conv_id", "base", "taken"), "base")
    first = first.where(F.col("pos") < F.col("taken")).select("conv_id", "pos", "key", "words")
    n = F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return own.unionByName(first), sizes.select("conv_id", n.alias("n"))


# ---------------------------------------------------------------- names


def pieces(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """(conv_id, piece, items, ends): the turns of depth ``piece`` * HEIGHT on, at most HEIGHT of them, and whether the
    conversation ends with them. A conversation without turns has one empty piece."""
    item = F.struct("pos", "key", "words")
    rows = turns.select("conv_id", F.floor(F.col("pos") / HEIGHT).alias("piece"), item.alias("item"), F.lit(False).alias("ends"))
    last = F.floor(F.greatest(F.col("n") - 1, F.lit(0)) / HEIGHT)
    marks = sizes.select("conv_id", last.alias("piece"), F.lit(None).cast(rows.schema["item"].dataType).alias("item"), F.lit(True).alias("ends"))
    grouped = rows.unionByName(marks).groupBy("conv_id", "piece")
    return grouped.agg(F.array_sort(F.collect_list("item")).alias("items"), F.bool_or("ends").alias("ends"))


def cut_names(scratch: Scratch, cut: DataFrame, longest: int) -> DataFrame:
    """(conv_id, piece, root, next) of the conversations with HEIGHT turns or more: names of the prefixes before and
    after each complete piece. Contents of aligned runs of pieces are joined pairwise from below, then the cuts are named
    from the largest run down: a prefix that ends with an odd run of its level follows one named before."""

    def contents(stream):
        for batch in stream:
            found = [named(ROOT, keys)[1] for keys in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["conv_id", "run", "content"])

    full = cut.where(F.size("items") == HEIGHT).select("conv_id", "piece", F.col("items.key").alias("keys"))
    runs = [scratch.store(full.mapInArrow(contents, "conv_id bigint, run bigint, content binary"))]
    while (longest // HEIGHT) >> len(runs):
        pair = runs[-1].groupBy("conv_id", F.shiftright("run", 1).alias("run")).agg(
            F.concat(F.min_by("content", "run"), F.max_by("content", "run")).alias("both"), F.count("*").alias("n")
        )
        runs.append(scratch.store(pair.where("n = 2").select("conv_id", "run", _digest_column(F.col("both")).alias("content"))))
    cuts = None
    for level in reversed(range(len(runs))):
        odd = runs[level].where(F.col("run") % 2 == 0).select(
            "conv_id", F.shiftleft("run", level).alias("cut"), F.shiftleft(F.col("run") + 1, level).alias("end"), "content"
        )
        root = F.lit(ROOT)
        if cuts is not None:
            odd = odd.join(cuts.select("conv_id", "cut", "name"), ["conv_id", "cut"], "left")
            root = F.coalesce("name", root)
        new = odd.select("conv_id", F.col("end").alias("cut"), _digest_column(F.concat(root, F.col("content"))).alias("name"))
        cuts = scratch.store(new if cuts is None else cuts.unionByName(new))
    nothing = F.lit(None).cast("binary")
    before = cuts.select("conv_id", F.col("cut").alias("piece"), F.col("name").alias("root"), nothing.alias("next"))
    after = cuts.select("conv_id", (F.col("cut") - 1).alias("piece"), nothing.alias("root"), F.col("name").alias("next"))
    return before.unionByName(after).groupBy("conv_id", "piece").agg(F.max("root").alias("root"), F.max("next").alias("next"))


def chains(scratch: Scratch, turns: DataFrame, sizes: DataFrame) -> tuple[DataFrame, int]:
    """(conv_id, piece, ends, root, names, words): the names along each piece of each conversation, stored; and the
    turns that the pieces of the longest conversation may hold."""
    cut = scratch.store(pieces(turns, sizes))
    longest = HEIGHT * (cut.agg(F.max("piece").alias("p")).first()["p"] or 0) + HEIGHT
    full = cut.where(F.size("items") == HEIGHT)
    root = F.lit(ROOT).alias("root")
    if full.isEmpty():
        rooted = cut.select("*", root, F.lit(None).cast("binary").alias("next"))
    else:
        rooted = cut.join(cut_names(scratch, cut, longest), ["conv_id", "piece"], "left").withColumn("root", F.coalesce("root", root))

    def batches(stream):
        for batch in stream:
            names = []
            for start, keys, follower in zip(batch.column(3).to_pylist(), batch.column(5).to_pylist(), batch.column(6).to_pylist(), strict=True):
                own, _ = named(start, keys)
                names.append([*own, follower] if len(keys) == HEIGHT else own)
            columns = [*(batch.column(i) for i in range(5)), pa.array(names, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "piece", "ends", "root", "words", "names"])

    shaped = rooted.select("conv_id", "piece", "ends", "root", F.col("items.words").alias("words"), F.col("items.key").alias("keys"), "next")
    columns = "conv_id bigint, piece bigint, ends boolean, root binary, words array<bigint>, names array<binary>"
    return scratch.store(shaped.mapInArrow(batches, columns)), longest


# ---------------------------------------------------------------- the trie


def nodes_of(scratch: Scratch, chain: DataFrame) -> DataFrame:
    """(depth, name, parent, conv_id, n_convs, words, n_children, own) of every node below the root, stored: one grouped
    pass that combines before its shuffle, however many conversations share a prefix."""
    size = F.size("names")
    parents = F.concat(F.array("root"), F.slice("names", F.lit(1), F.greatest(size - 1, F.lit(0))))
    listed = chain.where(size > 0).select(
        "conv_id", "piece", F.posexplode(F.arrays_zip(F.col("names").alias("name"), parents.alias("parent"), F.col("words").alias("words")))
    )
    nodes = listed.groupBy((F.col("piece") * HEIGHT + F.col("pos") + 1).alias("depth"), F.col("col.name").alias("name")).agg(
        F.max("col.parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("col.words").alias("words")
    )
    nodes = scratch.store(nodes)
    children = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    counted = nodes.join(children, ["depth", "name"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    return scratch.store(counted.withColumn("own", (F.col("n_convs") - 1) * F.col("words")))


def totals_of(scratch: Scratch, chain: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """(depth, name, saved_tokens, n_leaves): totals of every subtree below the root.

    A node's own values stand on the chain of its smallest member, which passes all nodes above it. Within a piece
    they are summed from below; the total of a lower half is then grafted to every piece of the upper half, level by
    level, and the nodes sum what has arrived on the chains through them."""
    leaf = (F.col("n_children") == 0).cast("bigint")
    value = F.struct((F.col("depth") - 1).alias("at"), "own", leaf.alias("leaf"))
    piece = F.floor((F.col("depth") - 1) / HEIGHT).alias("piece")
    values = nodes.groupBy("conv_id", piece).agg(
        F.collect_list(value).alias("values"), F.sum("own").alias("own"), F.sum(leaf).alias("leaves")
    )
    values = scratch.store(values)
    nothing = F.lit(0).cast("bigint")
    carried = values.select("conv_id", "piece", "values", nothing.alias("own"), nothing.alias("leaves"))
    total, level = values.select("conv_id", F.col("piece").alias("run"), "own", "leaves"), 0
    while (longest // HEIGHT - 1) >> level:
        lower = total.where(F.col("run") % 2 == 1)
        above = F.sequence(F.shiftleft(F.col("run") - 1, level), F.shiftleft("run", level) - 1)
        none = F.lit(None).cast(values.schema["values"].dataType).alias("values")
        carried = carried.unionByName(lower.select("conv_id", F.explode(above).alias("piece"), none, "own", "leaves"))
        total = total.groupBy("conv_id", F.shiftright("run", 1).alias("run")).agg(F.sum("own").alias("own"), F.sum("leaves").alias("leaves"))
        total, level = scratch.store(total), level + 1
    arrived = carried.groupBy("conv_id", "piece").agg(
        F.first("values", ignorenulls=True).alias("values"), F.sum("own").alias("own"), F.sum("leaves").alias("leaves")
    )

    def batches(stream):
        for batch in stream:
            depth, name, saved, leaves = [], [], [], []
            for piece_, names, values_, own, more in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                first = piece_ * HEIGHT
                here = {v["at"] - first: v for v in values_ or ()}
                for i in range(len(names) - 1, -1, -1):
                    if i in here:
                        own, more = own + here[i]["own"], more + here[i]["leaf"]
                    depth.append(first + i + 1)
                    name.append(names[i])
                    saved.append(own)
                    leaves.append(more)
            yield pa.RecordBatch.from_arrays(
                [pa.array(depth, pa.int64()), pa.array(name, pa.binary()), pa.array(saved, pa.int64()), pa.array(leaves, pa.int64())],
                names=["depth", "name", "saved", "leaves"],
            )

    chained = chain.select("conv_id", "piece", "names").join(arrived, ["conv_id", "piece"]).select("piece", "names", "values", "own", "leaves")
    summed = chained.mapInArrow(batches, "depth bigint, name binary, saved bigint, leaves bigint")
    return summed.groupBy("depth", "name").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))


def ends_of(chain: DataFrame) -> DataFrame:
    """(depth, name, ends_sha256) of the nodes where conversations end. Ids are dealt to ranges and joined there, up to
    ``IDS`` of them in a row; a digest then takes a node's rows in order, holding one at a time."""
    depth = F.col("piece") * HEIGHT + F.size("names")
    ends = chain.where("ends").select(depth.alias("depth"), F.coalesce(F.try_element_at("names", F.lit(-1)), "root").alias("name"), "conv_id")

    def joined(stream):
        node, ids = None, []

        def row():
            return pa.RecordBatch.from_pylist(
                [{"depth": node[0], "name": node[1], "first": ids[0], "ids": ",".join(map(str, ids))}],
                schema=pa.schema([("depth", pa.int64()), ("name", pa.binary()), ("first", pa.int64()), ("ids", pa.string())]),
            )

        for batch in stream:
            for d, n, conv_id in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if ids and (node != (d, n) or len(ids) == IDS):
                    yield row()
                    ids = []
                node = (d, n)
                ids.append(conv_id)
        if ids:
            yield row()

    def digested(stream):
        node, digest = None, None
        out = []

        def rows():
            return pa.RecordBatch.from_pylist(out, schema=pa.schema([("depth", pa.int64()), ("name", pa.binary()), ("ends_sha256", pa.string())]))

        for batch in stream:
            for d, n, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if node == (d, n):
                    digest.update(b",")
                else:
                    if digest:
                        out.append({"depth": node[0], "name": node[1], "ends_sha256": digest.hexdigest()})
                    node, digest = (d, n), hashlib.sha256()
                digest.update(ids.encode())
            yield rows()
            out.clear()
        if digest:
            out.append({"depth": node[0], "name": node[1], "ends_sha256": digest.hexdigest()})
            yield rows()

    order = ["depth", "name", "conv_id"]
    listed = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(joined, "depth bigint, name binary, first bigint, ids string")
    by_node = listed.repartition("depth", "name").sortWithinPartitions("depth", "name", "first").select("depth", "name", "ids")
    return by_node.mapInArrow(digested, "depth bigint, name binary, ends_sha256 string")


def with_parents(nodes: DataFrame, root_conv: int) -> DataFrame:
    """The nodes with the smallest member of their parent. Children of heavy nodes, of which there are fewer than
    ``HEAVY`` at any size, meet them by broadcast, the others by a join in which no key has more than one in ``HEAVY``
    of the rows; those of the root need neither."""
    n = nodes.count()
    known = nodes.select((F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    heavy = F.col("n_children") * HEAVY > n
    below = nodes.where("depth > 1")
    met = below.join(F.broadcast(known.where(heavy).drop("n_children")), ["depth", "parent"], "left")
    met = met.select(*nodes.columns, "parent_conv_id")
    light = met.where("parent_conv_id IS NULL").drop("parent_conv_id").join(known.where(~heavy).drop("n_children"), ["depth", "parent"])
    top = nodes.where("depth = 1").withColumn("parent_conv_id", F.lit(root_conv).cast("bigint"))
    return met.where("parent_conv_id IS NOT NULL").unionByName(light.select(*met.columns)).unionByName(top)


def prefix_trie(scratch: Scratch, turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row per node of the trie over the sequences ``turns`` (conv_id, pos, key, words) of all conversations of
    ``sizes`` (conv_id, n): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, and ``name``, which nodes of equal prefixes have in common.

    The root is there if there is a conversation; without any there are no rows. Conversations without turns are members
    of the root alone. Equal conversations share all their nodes, as many as they may be; sequences may be of any
    length."""
    chain, longest = chains(scratch, turns, sizes)
    nodes = nodes_of(scratch, chain)
    all_convs = chain.where("ends").agg(F.count("*").alias("n"), F.min("conv_id").alias("first")).first()
    totals = totals_of(scratch, chain, nodes, longest)
    ends = scratch.store(ends_of(chain))
    rows = with_parents(nodes, all_convs["first"]).join(totals, ["depth", "name"], "left")
    none = F.lit(hashlib.sha256().hexdigest())
    columns = ["name", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    below = rows.join(ends, ["depth", "name"], "left").select(*columns, F.coalesce("ends_sha256", none).alias("ends_sha256"))
    whole = nodes.agg(
        F.coalesce(F.count_if(F.col("depth") == 1), F.lit(0)).alias("n_children"),
        F.greatest(F.count_if(F.col("n_children") == 0), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum("own"), F.lit(0)).alias("saved_tokens"),
    )
    root = whole.select(
        F.lit(ROOT).alias("name"),
        F.lit(all_convs["first"]).cast("bigint").alias("conv_id"),
        F.lit(0).cast("bigint").alias("depth"),
        F.lit(None).cast("bigint").alias("parent_conv_id"),
        F.lit(all_convs["n"]).cast("bigint").alias("n_convs"),
        "n_children",
        "n_leaves",
        "saved_tokens",
    )
    at_root = ends.where("depth = 0").first()  # one row at most
    root = root.withColumn("ends_sha256", F.lit(at_root["ends_sha256"]) if at_root else none)
    return below.unionByName(root.where("n_convs > 0"))


def conversation_trie(turns: DataFrame, group: int | None = None) -> DataFrame:
    """The prefix trie of a table (conv_id, turn, role, text); other columns are ignored. conv_id is a whole number; rows
    without one are left out. Turns go by ``turn``, null first; rows of one turn go by the digest of role and text, so
    that repeated rows are turns of their own and the result does not depend on the input's order. Null roles and texts
    are empty, texts of any length count whole. With ``group``, conversations are first rebuilt (see ``rebuilt``)."""
    scratch = Scratch(turns.sparkSession)
    rows = scratch.store(numbered(scratch, turn_rows(turns)))
    return prefix_trie(scratch, *(rebuilt(rows, group) if group else sequences(rows)))
