"""Document fingerprints: every shingle hash below a fixed fraction of the range.

The size of such a sketch follows the size of the text, so sketches of very unequal documents can be held against
each other, and the sketch of several texts is the union of theirs. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.scratch import fresh

SHINGLE = 5
#: One hash in so many is kept. A text of k distinct shingles has none below the limit once in 2**k.
SCALE = 2
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """What stands between white space (the blank and 0x09 to 0x0D), A-Z lower-cased. Null has no words."""
    plain = F.translate(F.coalesce(text, F.lit("")), CAPITALS, SMALL)
    return F.filter(F.split(plain, r"[\x20\x09-\x0D]+"), lambda word: word != "")


def shingle_hashes(words: Column) -> Column:
    """A hash for each run of five words; fewer words make one, none none."""
    runs = F.greatest(F.size(words) - (SHINGLE - 1), F.least(F.size(words), F.lit(1)))
    places = F.when(runs > 0, F.sequence(F.lit(1), runs)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(F.slice(words, i, F.lit(SHINGLE))))


def sketch_of(hashes: Column, scale: int = SCALE) -> Column:
    """The distinct hashes below the threshold, sorted. A text of few shingles that has none below it keeps its smallest
    hash, so that texts with words have no empty sketch and are told apart; that hash is in no sketch of a longer text.
    Sketches still merge: by their union, less what is above the threshold if anything is below."""
    limit = -(1 << 63) + (1 << 64) // scale
    low = F.filter(hashes, lambda h: h < F.lit(limit))
    return F.when(F.size(low) > 0, F.array_sort(F.array_distinct(low))).otherwise(
        F.when(F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(F.array().cast("array<bigint>"))
    )


def merge_sketches(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The sketch of two texts' shingles together."""
    return sketch_of(F.concat(a, b), scale)


def containment(a: Column, b: Column) -> Column:
    """The share of the smaller sketch that the larger one holds, 0 to 1. Two empty ones are alike, an empty and
    another not. Arrays of all distinct hashes give the exact share, sketches an estimate of it, whose error falls with
    the number of hashes in the smaller one."""
    smaller = F.least(F.size(a), F.size(b))
    return F.when(smaller > 0, F.size(F.array_intersect(a, b)) / smaller).otherwise((F.size(a) == F.size(b)).cast("double"))


def written(sketch: Column) -> Column:
    """A sketch as text: its hashes in hexadecimal, comma-joined."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.hex(h))), ",")


def fingerprints(documents: DataFrame, text: Column | str = "text", sketch: str = "sketch", scale: int = SCALE) -> DataFrame:
    """The frame with a column ``sketch``. Row by row, nothing is shuffled.

    Null and empty texts have an empty sketch, texts of any length are taken whole, repeated rows have equal sketches, an
    empty table stays empty. A column that already has the name of ``sketch`` is replaced; all others are kept."""
    text = F.col(text) if isinstance(text, str) else text
    # Columns of their own: words are looked up again for every shingle, and hashes several times.
    words, hashes = (fresh(n, [*documents.columns, sketch]) for n in ("_words", "_hashes"))
    hashed = documents.withColumn(words, words_of(text)).withColumn(hashes, shingle_hashes(F.col(words)))
    return hashed.withColumn(sketch, sketch_of(F.col(hashes), scale)).drop(words, hashes)


def with_next(documents: DataFrame, columns: list[str], blocks: int) -> DataFrame:
    """Each row of ``documents`` with ``next``, a struct of ``columns`` of the row that follows by doc_id (then text;
    the first one follows the last). Null ids come first.

    The ids are cut into ``blocks`` ranges of about equal counts; each range is one partition's window, and takes a
    copy of the next range's first row along. The texts move once.
    """
    ids = documents.select("doc_id")
    cuts = ids.agg(F.percentile_approx("doc_id", [i / blocks for i in range(1, blocks)], 10 * blocks)).first()[0] if blocks > 1 else []
    cuts = sorted(set(cuts or []))
    # Nested in chunks, so that a row is not held against every cut.
    block = F.lit(0)
    if cuts:
        chunk = max(1, int(len(cuts) ** 0.5))
        parts = [cuts[i : i + chunk] for i in range(0, len(cuts), chunk)]
        heads = F.array(*[F.lit(p[0]) for p in parts])
        at = F.size(F.filter(heads, lambda c: c <= F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))))
        rows = F.array(*[F.array(*[F.lit(c) for c in p]) for p in parts])
        inner = F.size(F.filter(F.element_at(rows, F.greatest(at, F.lit(1))), lambda c: c <= F.col("doc_id")))
        block = F.when(at == 0, F.lit(0)).otherwise((at - 1) * chunk + inner)
    placed = documents.withColumn("_block", block)
    # The first row of each range: one per range at most, whatever the data, so the list may be broadcast.
    unnamed = F.max(F.col("doc_id").isNull().cast("int")) == 1
    starts = documents.select("doc_id", block.alias("_block")).groupBy("_block").agg(
        F.when(unnamed, F.lit(None)).otherwise(F.min("doc_id")).alias("first_id")
    )
    starts = starts.agg(F.array_sort(F.collect_list(F.struct("_block", "first_id"))).alias("all"))
    starts = starts.select(F.posexplode("all").alias("i", "start"), "all").select(
        F.col("start.first_id").alias("_first"), F.expr("element_at(all, if(i = 0, size(all), i))._block").alias("_before")
    )
    guests = (
        documents.join(F.broadcast(starts), F.col("doc_id").eqNullSafe(F.col("_first")))
        .groupBy("_before", "_first")
        .agg(F.min_by(F.struct(*documents.columns), F.coalesce("text", F.lit(""))).alias("_row"))
        .select("_row.*", F.col("_before").alias("_block"), F.lit(True).alias("_guest"))
    )
    rank = [F.col("_guest"), F.col("doc_id").asc_nulls_first(), F.coalesce("text", F.lit(""))]
    window = Window.partitionBy("_block").orderBy(*rank)
    return (
        placed.withColumn("_guest", F.lit(False))
        .unionByName(guests)
        .withColumn("next", F.lead(F.struct(*columns)).over(window))
        .where("NOT _guest")
        .drop("_block", "_guest")
    )


def edited(text: Column, following: Column) -> Column:
    """A text whose last half (rounded down, in code points) is replaced by as much of the beginning of the following
    one."""
    text, following = F.coalesce(text, F.lit("")), F.coalesce(following, F.lit(""))
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - half), F.substr(following, F.lit(1), half))


def edited_fingerprints(documents: DataFrame, blocks: int, scale: int = SCALE) -> DataFrame:
    """(doc_id, text, edited, sketch, edited_sketch, near_edited, near_next) of every row of ``documents``: its sketch,
    that of its text with the last half replaced by the beginning of the next document's (see ``with_next`` and
    ``edited``), and the containment of the sketch in the edited text's and in the next document's.

    Both likenesses follow from the sketches alone. Texts move once, to their ranges of ids; hashes are taken there and
    never move. Nulls are empty texts; other columns are ignored."""
    paired = with_next(documents.select("doc_id", "text"), ["text"], blocks).withColumn("edited", edited(F.col("text"), F.col("next.text")))
    sketched = fingerprints(fingerprints(paired, "text", scale=scale), "edited", "edited_sketch", scale)
    sketched = fingerprints(sketched, F.col("next.text"), "next_sketch", scale)
    return sketched.select(
        "doc_id", "text", "edited", "sketch", "edited_sketch",
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
