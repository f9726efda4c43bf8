"""Plain versions of what the operators compute, and small tables."""

import re
from collections import defaultdict

import pyarrow as pa

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, ids=None, extra=""):
    """A documents table; ``extra`` names string columns that may clash with an operator's own."""
    ids = list(range(len(texts))) if ids is None else ids
    names = [n for n in extra.split() if n]
    rows = [(i, t, "en", "s", None if t is None else len(t), *["x"] * len(names)) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCUMENT + "".join(f", `{n}` string" for n in names))


def table(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def letter_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text):
    w = blank_words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def hit_words(text, items):
    """(places of hit words, names of the items that occur) by trying every passage everywhere."""
    words, places, names = letter_words(text), set(), set()
    for item, passage in items:
        own = letter_words(passage)
        k = min(10, len(own))
        passages = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if k else set()
        for i in range(len(words) - k + 1):
            if tuple(words[i : i + k]) in passages:
                places.update(range(i, i + k))
                names.add(str(item))
    return places, names


def groups(nodes, links):
    """Smallest node that each one reaches."""
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b), near[b].add(a)
    out = {}
    for n in sorted(nodes):
        if n not in out:
            todo = [n]
            while todo:
                x = todo.pop()
                if x not in out:
                    out[x] = n
                    todo += near[x]
    return out


def near_groups(texts):
    """Component of each text's number by comparing all sets."""
    sets = [shingles(t) for t in texts]
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    return groups(range(len(texts)), links)


def nodes_of(frame):
    """Text of the plan, to look for operators."""
    return frame._jdf.queryExecution().explainString(frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def arrow(strings):
    return pa.array(strings, pa.string())
