"""Toxicity by weak supervision.

Many voters, each a lexicon or a pattern, fire or stay silent on a text. A generative label model, fitted on how often
each combination of votes occurs in all documents, estimates how accurate the voters are and how they depend on each
other; its posterior labels train a linear classifier, which scores every text. Given labels enter twice, from
training rows only: lexicons are induced from a bounded sample of them, and they anchor the label model's two classes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.folds import held_out, training_labels
from barloom.llm.scratch import Scratch, without_rows
from barloom.llm.words import LETTERS, U64, Words, hash_parts, mix, text_bytes, word_slices
from barloom.session import local_rows

FOLDS, FOLD = 5, 0
#: Labelled rows that lexicons are induced from, at most, and terms of all lexicons; if more pass, an error is raised.
SAMPLE, TERMS = 20_000, 20_000
#: Labelled rows that a term must be in, and how much more often it must be in toxic ones than in others.
SUPPORT, RATIO = 4, 50.0

#: Views of a word, each with lexicons of its own: the whole word, and its first bytes.
VIEWS = (0, 4, 5, 6)
LEXICONS = ("word_a", "word_b", "start4", "start5", "start6")
#: The last one speaks for class 0. All but the first two know nothing of labels.
PATTERNS = ("several", "dense", "shouting", "symbols", "exclaiming", "stretched", "even")
VOTERS = LEXICONS + PATTERNS

_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#$%&*@^~", np.uint8))
_BANG = np.arange(256) == ord("!")
_LETTER = np.isin(np.arange(256), np.frombuffer(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8))

#: What given labels weigh in the label model, as a share of what all documents weigh.
ANCHOR = 0.25
#: Two voters may depend on each other if they share so much information (in nats) within the classes, and of n rows at
#: least CHANCE / n: independent voters share more once in 20,000 times.
LEAST_INFORMATION, CHANCE = 1e-3, 10


def view_hashes(words: Words) -> list[np.ndarray]:
    """Per view, a hash of each word; 0 where the word is too short for the view."""
    out = []
    for view in VIEWS:
        if not view:
            out.append(words.hashes())
            continue
        h = hash_parts(words.data, words.begin, np.minimum(words.end, words.begin + view))
        out.append(np.where(words.end - words.begin > view, mix(h + U64(view)), U64(0)))
    return out


def _term_counts(rows: DataFrame) -> DataFrame:
    """(view, hash, docs): in how many texts of ``rows`` each term is."""

    def batches(stream):
        for batch in stream:
            for words in word_slices(batch.column(0), LETTERS):
                for view, h in enumerate(view_hashes(words)):
                    keep = h != 0
                    pairs = np.unique(np.stack([words.text[keep].astype(U64), h[keep]], axis=1), axis=0) if keep.any() else np.empty((0, 2), U64)
                    found, docs = np.unique(pairs[:, 1], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(found), view, np.int32)), pa.array(found.astype(np.int64)), pa.array(docs.astype(np.int64))],
                        names=["view", "hash", "docs"],
                    )

    return rows.select("text").mapInArrow(batches, "view int, hash bigint, docs bigint").groupBy("view", "hash").agg(F.sum("docs").alias("docs"))


def _member(h: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes are among the sorted terms, and where."""
    if not len(terms):
        return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
    place = np.minimum(np.searchsorted(terms, h), len(terms) - 1)
    return terms[place] == h, place


def induce_lexicons(rows: DataFrame, terms: int = TERMS) -> list[np.ndarray]:
    """Per view, the sorted hashes of its terms, from labelled rows (text, label). A term is in ``SUPPORT`` toxic
    texts at least, and ``RATIO`` times as often in toxic ones as in others. Both tests are made in Spark, on all terms;
    if more than ``terms`` pass, a ValueError is raised."""
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic = _term_counts(rows.where("label = 1")).where(F.col("docs") >= SUPPORT)
    other = _term_counts(rows.where("label = 0")).withColumnRenamed("docs", "docs_other")
    docs_other = F.coalesce("docs_other", F.lit(0)) + 0.5
    ratio = (F.col("docs") / max(1, sizes.get(1, 0))) / (docs_other / max(1, sizes.get(0, 0)))
    found = toxic.join(other, ["view", "hash"], "left").where(ratio >= RATIO).select("view", "hash").limit(terms + 1).toPandas()
    if len(found) > terms:
        raise ValueError(f"more than {terms} terms pass the tests of the lexicons")
    return [np.sort(found.loc[found["view"] == v, "hash"].to_numpy(np.int64).astype(U64)) for v in range(len(VIEWS))]


def evidence(words: Words, raw: np.ndarray, borders: np.ndarray, lexicons: list[np.ndarray]) -> np.ndarray:
    """A row per text: hits of each lexicon, all words that some lexicon has, words, shares of capitals, symbols,
    exclamation marks, and of letters after three equal ones."""
    n = words.last - words.first
    count = lambda which: np.bincount(words.text[which], minlength=n).astype(float)
    hashes = view_hashes(words)
    hits = [_member(h, terms)[0] & (h != 0) for h, terms in zip(hashes, lexicons, strict=True)]
    half = (hashes[0] & U64(1)).astype(bool)
    any_hit = np.logical_or.reduce(hits)
    size = np.maximum(1, np.diff(borders))

    places = borders - borders[0]

    def share(flags):
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[places]) / size

    stretched = _LETTER[raw]
    for back in (1, 2, 3):
        stretched[back:] &= raw[back:] == raw[:-back]
        early = places[:-1] + back - 1  # a text's first letters have none before them
        stretched[early[early < len(raw)]] = False
    columns = [count(hits[0] & half), count(hits[0] & ~half), *[count(h) for h in hits[1:]], count(any_hit), words.per_text.astype(float)]
    return np.stack([*columns, share(_UPPER[raw]), share(_SYMBOL[raw]), share(_BANG[raw]), share(stretched)], axis=1)


def votes_of(e: np.ndarray) -> np.ndarray:
    """One bit per voter."""
    hits, words = e[:, 5], np.maximum(1, e[:, 6])
    even = (e[:, 6] >= 30) & (e[:, 7] < 0.1) & (e[:, 8] < 0.005) & (e[:, 9] < 0.005)
    fired = [e[:, i] > 0 for i in range(5)] + [hits >= 2, hits / words >= 0.02, e[:, 7] > 0.5, e[:, 8] > 0.05, e[:, 9] > 0.05, e[:, 10] > 0, even]
    return sum(f.astype(np.int64) << i for i, f in enumerate(fired))


def classifier_input(e: np.ndarray) -> np.ndarray:
    words = np.maximum(1, e[:, 6])
    return np.column_stack([np.log1p(e[:, :6]), np.sqrt(e[:, 5] / words), np.log1p(e[:, 6]), e[:, 7:10], (e[:, 5] > 0).astype(float)])


def _features(documents: DataFrame, lexicons: list[np.ndarray]) -> DataFrame:
    """(doc_id, digest of the text, votes, x) of every row."""

    def batches(stream):
        for batch in stream:
            data, offsets = text_bytes(batch.column(1))
            votes, inputs = [np.empty(0, np.int64)], [np.empty((0, INPUTS))]
            for words in word_slices(batch.column(1), LETTERS):
                borders = offsets[words.first : words.last + 1]
                e = evidence(words, data[borders[0] : borders[-1]], borders, lexicons)
                votes.append(votes_of(e)), inputs.append(classifier_input(e))
            x = np.concatenate(inputs)
            lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, INPUTS, dtype=np.int32), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(np.concatenate(votes)), lists], names=["doc_id", "digest", "votes", "x"]
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("digest", F.xxhash64("text"))
    return texts.mapInArrow(batches, f"doc_id {kind}, digest bigint, votes bigint, x array<double>")


INPUTS = 12


@dataclass
class LabelModel:
    """Two classes. In each, voters depend on each other along a tree: a voter fires with one probability if its parent
    does and with another if not. A voter that only repeats its parent then adds nothing to the posterior."""

    prior: float
    fires: np.ndarray  # voters x classes
    parent: np.ndarray  # per voter; -1: none
    given: np.ndarray  # voters x vote of the parent x classes

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of class 1 for rows of 0/1 votes."""
        gap = np.full(len(votes), math.log(self.prior / (1 - self.prior)))
        for i, above in enumerate(self.parent):
            vote = votes[:, above].astype(int) if above >= 0 else np.zeros(len(votes), int)
            p = np.clip(self.given[i][vote], 1e-6, 1 - 1e-6)
            log = np.where(votes[:, i, None] > 0, np.log(p), np.log(1 - p))
            gap += log[:, 1] - log[:, 0]
        return 1 / (1 + np.exp(-np.clip(gap, -500, 500)))

    def accuracies(self) -> np.ndarray:
        """Per voter, how often it is right if firing means class 1."""
        return self.prior * self.fires[:, 1] + (1 - self.prior) * (1 - self.fires[:, 0])


def dependence_tree(votes: np.ndarray, mass: np.ndarray, least: float = LEAST_INFORMATION) -> np.ndarray:
    """Each voter's parent (-1: none) in the forest of pairs that share most information within the classes. ``mass``
    (rows x classes) says how often each row of votes occurs in each class; pairs below ``least`` are none."""
    n, share = votes.shape[1], mass / mass.sum()
    information = np.zeros((n, n))
    for c in range(2):
        whole = share[:, c].sum()
        states = [1 - votes, votes]
        alone = [s.T @ share[:, c] for s in states]
        for a in range(2):
            for b in range(2):
                joint = (states[a] * share[:, c, None]).T @ states[b]
                with np.errstate(divide="ignore", invalid="ignore"):
                    part = joint * np.log(joint * whole / np.outer(alone[a], alone[b]))
                information += np.where(joint > 0, part, 0)
    group, near = list(range(n)), [[] for _ in range(n)]
    pairs = sorted(((information[i, j], i, j) for i in range(n) for j in range(i)), reverse=True)
    for value, i, j in pairs:
        if value >= least and group[i] != group[j]:
            near[i].append(j), near[j].append(i)
            old, new = group[i], group[j]
            group = [new if g == old else g for g in group]
    parent, seen = np.full(n, -1), set()
    for root in range(n):
        todo = [root] if root not in seen else []
        seen.add(root)
        while todo:
            i = todo.pop()
            for j in near[i]:
                if j not in seen:
                    seen.add(j), todo.append(j)
                    parent[j] = i
    return parent


def fit_label_model(votes: np.ndarray, counts: np.ndarray, anchored: np.ndarray, rounds: int = 4, steps: int = 40, anchor: float = ANCHOR) -> LabelModel:
    """Expectation maximisation over combinations of votes (rows of 0/1) that occur ``counts`` times. ``anchored``
    (rows x classes) are those with a known class; together they weigh ``anchor`` times as much as all others. The tree of
    the voters' dependences is that of the known rows; its probabilities are estimated with all others. Without known
    rows, voters are independent in the first round, and after each the tree is taken anew from the classes as they are
    then."""
    n = votes.shape[1]
    known = anchored.sum()
    scale = anchor * counts.sum() / known if known else 0.0
    mass = anchored + 0.01 if known else np.stack([counts * (votes.sum(1) == 0), counts * (votes.sum(1) > 0)], axis=1) + 0.01
    model = LabelModel(0.5, np.empty((n, 2)), np.full(n, -1), np.empty((n, 2, 2)))
    if known:
        model.parent = dependence_tree(votes, anchored, max(LEAST_INFORMATION, CHANCE / known))

    def maximise():
        total = mass.sum(axis=0) + 2
        model.prior = float(np.clip(total[1] / total.sum(), 1e-4, 1 - 1e-4))
        model.fires = (votes.T @ mass + 1) / total
        for i, above in enumerate(model.parent):
            for vote in range(2):
                there = mass * (votes[:, above] == vote)[:, None] if above >= 0 else mass
                model.given[i, vote] = (votes[:, i] @ there + 2 * model.fires[i]) / (there.sum(axis=0) + 2)

    maximise()
    for k in range(rounds):
        for _ in range(steps):
            p = model.posterior(votes)
            mass = np.stack([1 - p, p], axis=1) * counts[:, None] + anchored * scale
            maximise()
        if not known and k + 1 < rounds:
            model.parent = dependence_tree(votes, mass)
            maximise()
    return model


def model_of_votes(seen: DataFrame, known: DataFrame) -> tuple[LabelModel, DataFrame]:
    """The label model of rows ``seen`` (doc_id, votes) with ``known`` labels (doc_id, label), and (votes, p): its
    probability of class 1 for each combination of votes that occurs, 2**len(VOTERS) rows at most."""
    counts = seen.groupBy("votes").count().toPandas().set_index("votes")["count"]
    labelled = seen.select("doc_id", "votes").join(known, "doc_id").groupBy("votes", "label").count().toPandas()
    labelled = labelled.pivot_table(index="votes", columns="label", values="count", fill_value=0)
    labelled = labelled.reindex(counts.index, fill_value=0).reindex(columns=[0, 1], fill_value=0)
    bits = ((counts.index.to_numpy()[:, None] >> np.arange(len(VOTERS))) & 1).astype(float)
    model = fit_label_model(bits, counts.to_numpy(float), labelled.to_numpy(float))
    rows = zip(counts.index.tolist(), model.posterior(bits).tolist(), strict=True)
    return model, local_rows(seen.sparkSession, rows, "votes bigint, p double")


@dataclass
class ToxicityModel:
    lexicons: list[np.ndarray]
    label_model: LabelModel | None
    weights: list[float]
    intercept: float

    def score(self, x: Column) -> Column:
        z = F.aggregate(F.zip_with(x, F.array(*[F.lit(w) for w in self.weights]), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        return 1 / (1 + F.exp(-(z + F.lit(self.intercept))))


def toxicity_scores(documents: DataFrame, labels: DataFrame, folds: int = FOLDS, fold: int = FOLD, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text): doc_id, row (its number), digest (of the text), held_out,
    score, predicted.

    Null and empty texts are scored like texts without words. Repeated rows score alike; null ids are held out.
    Without any training label of one of the classes nothing can be learned: every score is 0. Other columns are
    ignored; an empty table gives an empty one. Texts of any length are read whole.
    """
    scratch = Scratch(documents.sparkSession)
    train = training_labels(labels, "toxic", folds, fold, sample)
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = scratch.store(texts.join(train, "doc_id").select("doc_id", "text", "label"))
    both = {r[0] for r in rows.select("label").distinct().collect()}
    out = held_out(F.col("doc_id"), folds, fold)
    if both != {0, 1}:
        return texts.select("doc_id", F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("digest"), out.alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    lexicons = induce_lexicons(rows)
    scratch.drop(rows)
    seen = scratch.store(_features(texts, lexicons).withColumn("row", F.monotonically_increasing_id()))

    label_model, posterior = model_of_votes(seen, train)
    soft = (
        seen.where(~out)
        .join(F.broadcast(posterior), "votes")
        .select("x", F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("p").alias("weight")), F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("weight")))).alias("y"))
        .where("y.weight > 1e-6")
        .select(array_to_vector("x").alias("features"), "y.label", "y.weight")
    )
    fitted = LogisticRegression(weightCol="weight", maxIter=30, regParam=1e-4, aggregationDepth=2).fit(soft)
    model = ToxicityModel(lexicons, label_model, [float(w) for w in fitted.coefficients], float(fitted.intercept))
    return seen.select("doc_id", "row", "digest", out.alias("held_out"), model.score(F.col("x")).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents``, with their columns whatever their names, that are not predicted to be toxic."""
    return without_rows(documents, toxicity_scores(documents, labels).where("predicted = 1"))
