import hashlib
import sys
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from barloom.llm.fingerprints import SCALE, containment, edited, fingerprints, merge_sketches, with_next  # noqa: E402
from barloom.llm.queries import op5_fingerprints  # noqa: E402
from plain import SF, documents, nodes_of, shingles  # noqa: E402


def test_next_row_over_all_blocks(spark):
    ids = [None, -5, 3, 3, 8, 9, 10, 10**12, 10**12 + 1, 77]
    docs = documents(spark, [f"t{i}" for i in range(len(ids))], ids, extra="_guest_")
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, f"t{i}"))
    want = {f"t{i}": f"t{order[(k + 1) % len(order)]}" for k, i in enumerate(order)}
    for blocks in (1, 2, 5, 40):
        found = with_next(docs, ["text"], blocks).collect()
        assert {r["text"]: r["next"]["text"] for r in found} == want and len(found) == len(ids)
    alone = with_next(docs.where("doc_id = 8"), ["text"], 8).collect()
    assert [(r["text"], r["next"]["text"]) for r in alone] == [("t4", "t4")]
    assert with_next(docs.limit(0), ["text"], 4).count() == 0


def test_edit(spark):
    cases = [("abcde", "XYZ", "abcXY"), ("abcdef", "X", "abcX"), ("", "X", ""), (None, "X", ""), ("éé𝄞𝄞", None, "éé"), ("a", "b", "a")]
    frame = spark.createDataFrame(cases, "t string, n string, want string")
    assert frame.where(~edited(F.col("t"), F.col("n")).eqNullSafe(F.col("want"))).count() == 0


def test_sketches(spark):
    base = " ".join(f"w{i}" for i in range(4000))
    half = " ".join(f"w{i}" for i in range(1000, 3000)) + " " + " ".join(f"v{i}" for i in range(2000))
    texts = [base, half, " ".join(f"w{i}" for i in range(300)), "", None, "One two", "one  two", "other words"]
    s = {r["doc_id"]: r["sketch"] for r in fingerprints(documents(spark, texts)).collect()}
    assert s[3] == s[4] == [] and len(s[5]) == 1 and s[5] == s[6] != s[7]
    assert abs(len(s[0]) / (4000 / SCALE) - 1) < 0.1 and s[0] == sorted(set(s[0]))
    frame = spark.createDataFrame([(s[a], s[b], len(shingles(texts[a]) & shingles(texts[b])) / min(len(shingles(texts[a])), len(shingles(texts[b])))) for a, b in ((0, 1), (0, 2), (0, 0), (5, 6), (5, 7))], "a array<long>, b array<long>, want double")
    assert frame.where(F.abs(containment(F.col("a"), F.col("b")) - F.col("want")) > 0.12).count() == 0
    empty = spark.createDataFrame([([], [], 1.0), ([], [1], 0.0)], "a array<long>, b array<long>, want double")
    assert empty.where(containment(F.col("a"), F.col("b")) != F.col("want")).count() == 0
    # The sketch of two texts together is that of their sketches.
    joined = spark.createDataFrame([(s[0], s[1])], "a array<long>, b array<long>").select(merge_sketches(F.col("a"), F.col("b"))).first()[0]
    assert joined == sorted({*s[0], *s[1]})


def test_query(spark):
    frame = op5_fingerprints(spark, SF)
    plan = nodes_of(frame)
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow")) and "CartesianProduct" not in plan
    rows = {r["doc_id"]: r for r in frame.collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(texts)
    for i, j in zip(ids, [*ids[1:], ids[0]], strict=True):
        half = len(texts[i]) // 2
        new = texts[i][: len(texts[i]) - half] + texts[j][:half]
        r = rows[i]
        assert r["n_chars"] == len(texts[i]) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        # The likenesses are those of the fingerprints as they are printed.
        own, changed, following = ({h for h in f.split(",") if h} for f in (r["fingerprint"], r["edited_fingerprint"], rows[j]["fingerprint"]))
        share = lambda a, b: len(a & b) / min(len(a), len(b)) if a and b else float(a == b)
        assert r["near_edited"] == share(own, changed) and r["near_next"] == share(own, following)
        assert (r["fingerprint"] == r["edited_fingerprint"]) or shingles(texts[i]) != shingles(new)


def test_short_texts_in_long_ones(spark, tmp_path):
    """A text is followed by one that holds it whole, or in part; short ones have few hashes below the limit, or none."""
    texts = []
    for k in (1, 4, 5, 6, 9, 10, 14, 30, 80, 200, 700):
        for copy in range(6):
            own = [f"k{k}c{copy}w{i}" for i in range(k)]
            long = " ".join([*(f"x{k}c{copy}w{i}" for i in range(1500)), *own[: k - copy % 2 * (k // 3)], *own[:1]])
            texts += [" ".join(own), long] if copy < 4 else [" ".join(own * (4000 // k)), " ".join(own)]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in op5_fingerprints(spark, str(tmp_path)).collect()}
    share = lambda a, b: len(a & b) / min(len(a), len(b))
    for i, text in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        new = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        sets = [shingles(t) for t in (text, new, following)]
        for name, other in (("near_edited", sets[1]), ("near_next", sets[2])):
            # Of n hashes about n / SCALE are kept; four deviations, and nothing is promised below a handful of them.
            n = min(len(sets[0]), len(other)) / SCALE
            assert n < 8 or abs(rows[i][name] - share(sets[0], other)) < 2 / n**0.5, (i, name, rows[i][name])
