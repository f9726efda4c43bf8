"""Importance resampling against plain code."""

import hashlib
import math
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from barloom.llm.crc import crc32_extend, crc32_of_words, crc32_with_blank  # noqa: E402
from barloom.llm.resampling import first_rows, resample  # noqa: E402
from plain import SF, documents, letter_words, table  # noqa: E402


def plain_resample(rows, target, percent, least_words, longest_run, buckets, seed):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text) rows, in order of the rows."""

    def features(text):
        w = letter_words(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest_run + 1) for i in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    s_all, t_all = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))

    out = []
    for doc_id, text in rows:
        f = features(text)
        weight = sum(map(gain, f))
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = [i for i, (_, text) in enumerate(rows) if len(letter_words(text)) >= least_words]
    fit.sort(key=lambda i: (-out[i][3], out[i][0] is None, out[i][0] if out[i][0] is not None else 0))
    for rank, i in enumerate(fit[: percent * len(fit) // 100], 1):
        out[i][4] = rank
    return sorted(map(tuple, out), key=str)


def collected(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_checksums_of_words():
    words = ["", "a", "été", "x" * 63, "y" * 64, "z" * 65, "long" * 500]
    data, ends = np.frombuffer("".join(words).encode(), np.uint8), np.cumsum([len(w.encode()) for w in words])
    begins = np.concatenate([[0], ends[:-1]])
    crc = crc32_of_words(data, begins, ends)
    assert crc.tolist() == [zlib.crc32(w.encode()) for w in words]
    both = crc32_extend(crc32_with_blank(crc), data, begins[::-1], ends[::-1])
    assert both.tolist() == [zlib.crc32(f"{a} {b}".encode()) for a, b in zip(words, words[::-1])]
    assert crc32_of_words(data, begins[:0], ends[:0]).tolist() == []


@pytest.mark.parametrize(("percent", "least_words", "longest_run"), [(30, 0, 1), (10, 3, 3), (100, 1, 2), (0, 0, 1)])
def test_against_plain(spark, percent, least_words, longest_run):
    texts = [None, "", "one", "One  two-three", "Été été x", "a " * 3000, "w" * 5000 + " tail", *["same words in every copy"] * 20]
    texts += [" ".join(f"w{(i * j) % 17}" for j in range(i)) for i in range(1, 40)]
    ids = [None, *range(-2, 4), *[7] * 10, *range(100, 110), *range(200, 239)]
    docs = documents(spark, texts, ids, extra="score rank row weight place part bucket").repartition(7)
    target = table(spark, [(1, "w1 w2 w3 same words"), (2, None), (3, "w1")], "item_id int, text string")
    found = collected(resample(docs, target, percent, least_words, longest_run, 50, 9))
    assert found == plain_resample(list(zip(ids, texts)), ["w1 w2 w3 same words", None, "w1"], percent, least_words, longest_run, 50, 9)


def test_whole_table(spark):
    docs, target = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "benchmark"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert collected(resample(docs, target)) == plain_resample(rows, [r["text"] for r in target.collect()], 10, 20, 1, 10_000, 2024)


def test_ids_of_text_and_empty_tables(spark):
    rows = [(name, "same words here") for name in ("b", "a", "a longer name than seven", "a longer name", "é", "a\x00", "", "b")]
    docs, none = table(spark, rows, "doc_id string, text string"), table(spark, [], "text string")
    drawn = resample(docs, none, 50, 1).where("rank IS NOT NULL").orderBy("rank").collect()
    order = sorted((r["score"] for r in resample(docs, none, 50, 1).collect()), reverse=True)
    assert [r["score"] for r in drawn] == order[:4] and [r["rank"] for r in drawn] == [1, 2, 3, 4]
    assert resample(docs.limit(0), none).count() == 0


def test_cut_among_ties(spark):
    """Equal scores are cut at any place by the next keys, text ids in the order of their bytes."""
    from barloom.llm.resampling import order_keys

    names = sorted({"", "a", "a\x00", "ab", "abcdefg", "abcdefgh", "abcdefgi", "é", "zz", "zzzzzzzzzzzzzzzz"}, key=lambda n: n.encode())
    rows = table(spark, [(n, 5) for n in reversed(names)] + [(None, 5)], "doc_id string, score long").withColumn("row", F.monotonically_increasing_id())
    for n in range(len(names) + 2):
        kept = {r["doc_id"] for r in rows.where(first_rows(rows, order_keys(rows), n)).collect()}
        assert kept == {*names, None} if n > len(names) else kept == set(names[:n])
