import math
import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import barloom.llm.neardup as neardup  # noqa: E402
from barloom.llm.neardup import near_duplicates, one_of_each  # noqa: E402
from plain import documents, near_groups, shingles  # noqa: E402


def words(rng, n):
    return [f"w{rng.randrange(4000)}" for _ in range(n)]


def changed(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out


def corpus():
    rng = random.Random(8)
    texts = [None, "", " \n", "one", "ONE", "one two three four", "One  two three\tfour", "one two three four five", "a b c d e a b c d e"]
    for size, copies in ((60, 12), (200, 30), (400, 25)):
        base = words(rng, size)
        for _ in range(copies):
            texts.append(" ".join(changed(rng, base, rng.randrange(size // 40, size // 14))))
    walk = words(rng, 300)  # neighbours are alike, the ends are not
    for _ in range(25):
        walk = changed(rng, walk, 4)
        texts.append(" ".join(walk))
    shared = words(rng, 60)  # a common passage, else nothing
    texts += [" ".join([*words(rng, 40), *shared, *words(rng, 40)]) for _ in range(20)]
    texts += [texts[20], texts[20], texts[60].upper()]
    rng.shuffle(texts)
    return texts


def test_components_are_those_of_all_pairs(spark):
    texts = corpus()
    want = near_groups(texts)
    found = near_duplicates(documents(spark, texts, extra="row class component key")).collect()
    assert len(found) == len(texts)
    for r in found:
        assert r["component_id"] == want[r["doc_id"]] and r["n_shingles"] == len(shingles(texts[r["doc_id"]]))
        assert r["keeper"] == (r["doc_id"] == r["component_id"])


def test_small_stars_and_tiles_give_the_same(spark, monkeypatch):
    texts = corpus()
    want = near_groups(texts)
    monkeypatch.setattr(neardup, "STAR", 3)
    monkeypatch.setattr(neardup, "TILE", 4)
    # Without the first round of links, everything is left to the tiles.
    monkeypatch.setattr(neardup, "_alike", lambda pairs, classes: pairs.limit(0).selectExpr("center", "member", "0D estimate"))
    found = near_duplicates(documents(spark, texts)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == want


def test_rows_meet_their_heads_by_broadcast_or_shuffle(spark, monkeypatch):
    texts = [*corpus(), *["the same text many times over"] * 90]
    want = near_groups(texts)
    for heavy in (1, 4):  # no key is met by broadcast, some are
        monkeypatch.setattr(neardup, "HEAVY", heavy)
        found = near_duplicates(documents(spark, texts)).collect()
        assert {r["doc_id"]: r["component_id"] for r in found} == want
        assert sum(r["keeper"] for r in found) == len(set(want.values()))


def test_rows_without_ids_meet_only_their_own_text(spark, monkeypatch):
    rng = random.Random(3)
    bases = [words(rng, 200) for _ in range(100)]
    texts = [" ".join(changed(rng, base, 1)) for base in bases for _ in range(3)]
    met = []
    verified = neardup._verified

    def counted(texts, pairs):
        met.append(texts.join(pairs.selectExpr("center class").distinct().unionByName(pairs.selectExpr("member class")), "class").count())
        return verified(texts, pairs)

    monkeypatch.setattr(neardup, "_verified", counted)
    found = near_duplicates(documents(spark, texts, [None] * 300)).collect()
    assert sum(r["keeper"] for r in found) == 100 and all(r["component_id"] is None for r in found)
    assert met[0] <= 600


def test_repeated_and_missing_ids(spark):
    text = "this is a text with several words in it"
    docs = documents(spark, [text, text, text, None, "alone in the world", text + " x"], [7, 7, None, None, None, 9])
    found = {(r["doc_id"], r["component_id"], r["keeper"]) for r in near_duplicates(docs).collect()}
    assert {(7, 7, True), (7, 7, False), (None, 7, False), (None, None, True), (9, 7, False)} == found
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["text"]) for r in kept.collect()) == sorted([text, "None", "alone in the world"])
    assert near_duplicates(docs.limit(0)).count() == 0 and one_of_each(docs.limit(0)).count() == 0


def test_the_estimate_loses_pairs_more_rarely_than_the_bands():
    """A pair at the limit: the chance that too few of its minima agree, by the binomial distribution, and that of no band."""
    n, same = neardup.BANDS * neardup.ROWS, neardup.PERCENT / 100
    agree = same + (1 - same) / 256  # signatures have 8 bits
    passes = [(m / n - 1 / 256) * 256 / 255 >= neardup.LEAST_ESTIMATE for m in range(n + 1)]
    lost = sum(math.comb(n, m) * agree**m * (1 - agree) ** (n - m) for m in range(n + 1) if not passes[m])
    assert lost < (1 - same**neardup.ROWS) ** neardup.BANDS / 5
