import random
import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).resolve().parent))

from barloom.llm.components import connected_components  # noqa: E402
from barloom.llm.scratch import Scratch  # noqa: E402
from barloom.llm.words import LETTERS, PIECE_BYTES, UNSPACED, grams, hash_parts, within, word_slices  # noqa: E402
from plain import arrow, blank_words, groups, letter_words  # noqa: E402

TEXTS = [None, "", "  ", "One two, THREE", "é1 ß-ß\x0b\x0cÉ", "x", "end ", " begin", "a" * 40, "\u20ac5 \x00 z\x7fz", "", "last"]


def test_words_are_those_of_the_pattern():
    for member, plain in ((LETTERS, letter_words), (UNSPACED, blank_words)):
        for size in (1, 7, 1 << 20):
            found = [[] for _ in TEXTS]
            for words in word_slices(arrow(TEXTS), member, size):
                for i, t in enumerate(words.text.tolist()):
                    found[words.first + t].append(words.string(i))
            assert found == [plain(t) for t in TEXTS]


def test_sliced_columns():
    column = arrow(["zero", "one two", None, "three"]).slice(1, 3)
    (words,) = word_slices(column, LETTERS)
    assert [words.string(i) for i in range(len(words.text))] == ["one", "two", "three"] and words.per_text.tolist() == [2, 0, 1]


def test_hash_depends_on_the_word_alone():
    long = "q" * (2 * PIECE_BYTES + 5)
    parts = []
    for text in ([f"ab cd {long} ab"], ["x " * 999 + "ab", f"cd ab {long}"]):
        (words,) = word_slices(arrow(text), LETTERS, 1 << 30)
        parts.append({words.string(i): h for i, h in enumerate(words.hashes().tolist())})
    assert all(parts[0][w] == parts[1][w] for w in ("ab", "cd", long)) and len(set(parts[0].values())) == 3


def test_hashes_and_grams_do_not_collide():
    vocabulary = [f"{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"] + ["a" * n for n in range(1, 400) if n != 3]
    (words,) = word_slices(arrow([" ".join(vocabulary)]), LETTERS, 1 << 30)
    h = words.hashes()
    assert len(np.unique(h)) == len(vocabulary)
    pairs = np.concatenate([grams(h, n) for n in (1, 2, 5)])
    assert len(np.unique(pairs)) == len(pairs)
    assert len(grams(h[:3], 5)) == 0 and within(words.text[:3], 5).size == 0
    assert hash_parts(words.data, words.begin[:0], words.end[:0]).size == 0


def test_components(spark):
    rng = random.Random(3)
    nodes = list(range(300))
    edges = [(a, a + 1) for a in range(100, 160)] + [(7, x) for x in range(200, 260)] + [(rng.choice(nodes), rng.choice(nodes)) for _ in range(60)]
    edges += edges[:30] + [(5, 5)] + [(b, a) for a, b in edges[:20]]
    scratch = Scratch(spark)
    frame = spark.createDataFrame([*edges, (None, 4), (9, None)], "a long, b long")
    found = {r["node"]: r["component"] for r in connected_components(frame, scratch).collect()}
    want = groups(nodes, edges)
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert all(found.get(n, n) == want[n] for n in linked) and set(found) <= linked
    names = spark.createDataFrame([("b", "a"), ("c", "b"), ("z", "y")], "x string, y string")
    assert {tuple(r) for r in connected_components(names, scratch).collect()} == {("b", "a"), ("c", "a"), ("z", "y")}
    assert connected_components(names.limit(0), scratch).count() == 0
