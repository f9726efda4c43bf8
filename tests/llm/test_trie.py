"""The prefix trie of conversations against plain code."""

import hashlib
import random
import sys
import zlib
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from barloom.llm.trie import conversation_trie  # noqa: E402
from plain import SF, blank_words, table  # noqa: E402

TURNS = "conv_id bigint, turn bigint, role string, text string"


def plain_trie(rows, group=None):
    """One tuple per node, by trying every prefix of every conversation."""
    convs = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs[conv_id].append((turn is not None, turn or 0, key, (role, text)))
    convs = {c: [said for *_, said in sorted(turns)] for c, turns in convs.items()}
    if group:
        h = {c: zlib.crc32(str(c).encode()) % 4 for c in convs}
        convs = {c: convs.get(c - int(c % group if c >= 0 else -(-c % group)), [])[: h[c]] + turns[h[c] :] for c, turns in convs.items()}
    nodes = [{"depth": 0, "above": None, "words": 0, "convs": [], "below": {}, "ends": []}]
    for c, turns in sorted(convs.items()):
        at = 0
        nodes[0]["convs"].append(c)
        for said in turns:
            if said not in nodes[at]["below"]:
                nodes[at]["below"][said] = len(nodes)
                nodes.append({"depth": nodes[at]["depth"] + 1, "above": at, "words": len(blank_words(said[1])), "convs": [], "below": {}, "ends": []})
            at = nodes[at]["below"][said]
            nodes[at]["convs"].append(c)
        nodes[at]["ends"].append(c)
    for node in reversed(nodes):  # a node stands behind the one above it
        node["saved"] = node.get("saved", 0) + (len(node["convs"]) - 1) * node["words"]
        node["leaves"] = node.get("leaves", 0) or 1
        if node["above"] is not None:
            above = nodes[node["above"]]
            above["saved"] = above.get("saved", 0) + node["saved"]
            above["leaves"] = above.get("leaves", 0) + node["leaves"]
    return sorted(
        (
            min(n["convs"]), n["depth"], min(nodes[n["above"]]["convs"]) if n["depth"] else -(10**6), len(n["convs"]), len(n["below"]), n["leaves"], n["saved"],
            hashlib.sha256(",".join(map(str, sorted(n["ends"]))).encode()).hexdigest(),
        )
        for n in nodes
        if n["convs"]
    )


def collected(frame):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-(10**6) if v is None else v for v in r) for r in frame.select(*names).collect())


def test_whole_table(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    for group in (None, 20):
        assert collected(conversation_trie(turns, group)) == plain_trie(rows, group)


def test_odd_rows(spark):
    rows = [
        (20, 0, "user", "a b"), (20, 1, "bot", "c"), (21, None, None, None), (21, 0, "user", "a b"), (21, 0, "user", "a b"),
        (22, 5, "user", "x" * 20_000 + " y"), (25, 0, "user", "a b"), (40, 0, "", ""), (41, None, "", ""), (41, None, "u", "same turn"), (-3, 0, "user", "a b"), (-20, 0, "x", "y z"),
        (None, 0, "user", "no conversation"), (63, 0, "a", "b"), (64, 0, "a", "b"), (65, 0, "a", "b"), (65, 1, "ab", ""), (66, 0, "a", "b"), (66, 1, "a", "b"), (66, 2, "", "ab"),
    ]
    turns = table(spark, [(*r, "x", "y") for r in rows], TURNS + ", depth string, name string").repartition(5)
    for group in (None, 20):
        assert collected(conversation_trie(turns, group)) == plain_trie(rows, group)
    assert conversation_trie(turns.limit(0), 20).count() == 0
    # Only turns that are replaced by those of an absent conversation: all are members of the root alone.
    gone = [(c, 0, "u", "t") for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 > 0]
    found = collected(conversation_trie(table(spark, gone, TURNS), 20))
    assert found == plain_trie(gone, 20) and len(found) == 1


def test_long_conversations(spark):
    """Sequences of many pieces that part within, at and after the cuts, and one that holds most of all rows."""
    rng = random.Random(5)
    rows = []
    for c, (shared, n) in enumerate([(0, 63), (63, 64), (64, 64), (64, 65), (64, 128), (128, 128), (128, 200), (200, 256), (256, 257), (256, 700), (700, 700), (511, 640), (640, 645), (1, 1), (0, 0)]):
        rows += [(c, t, "user" if t % 2 else "bot", f"word {t}" if t < shared else f"word {c} {rng.random()}") for t in range(n)]
    rows += [(100 + c, t, "user", f"word {t}") for c in range(3) for t in range(130)] + [(200, t, "u", f"t {t % 7}") for t in range(9000)]
    rows.sort(key=lambda r: hash(r))
    found = collected(conversation_trie(table(spark, rows, TURNS).repartition(11)))
    assert found == plain_trie([r for r in rows])


def test_many_equal_conversations(spark):
    """More members and ends in one node than one row of ids holds, and a node with more children than count as light."""
    rows = [(c, 0, "u", "hello there") for c in range(20_000)] + [(c, 1, "u", f"own {c}") for c in range(9000, 20_000)]
    frame = spark.createDataFrame(rows, TURNS).repartition(6)
    assert collected(conversation_trie(frame)) == plain_trie(rows)
