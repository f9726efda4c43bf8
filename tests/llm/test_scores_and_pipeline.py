import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline  # noqa: E402
from barloom.llm.folds import held_out, training_labels  # noqa: E402
from barloom.llm.queries import op8_toxicity, op9_quality  # noqa: E402
from barloom.llm.quality import STATISTICS, WIDTH, Fourier, calibrated, normal_equations, quality_scores  # noqa: E402
from barloom.llm.toxicity import VOTERS, _features, dependence_tree, fit_label_model, induce_lexicons, model_of_votes, toxicity_scores, without_toxic  # noqa: E402
from plain import SF, documents, hit_words, near_groups, table  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

LARGER = "/root/testdata/sf0.1"


def judged(spark, query, label, folds, fold):
    found = {r["doc_id"]: r for r in query(spark, LARGER).collect()}
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").collect()
    assert len(found) == spark.read.parquet(f"{LARGER}/documents.parquet").count()
    for i, r in found.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % folds == fold)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    return [(found[r["doc_id"]]["score"], r[label]) for r in labels if r["doc_id"] in found and found[r["doc_id"]]["held_out"]]


def accuracy(pairs):
    """Share that is right, the classes weighed alike."""
    return sum(sum((s >= 0.5) == y for s, y in pairs if y == c) / sum(y == c for _, y in pairs) for c in (0, 1)) / 2


def test_toxicity_on_held_out_rows(spark):
    assert accuracy(judged(spark, op8_toxicity, "toxic", 5, 0)) > 0.93


def test_quality_on_held_out_rows(spark):
    assert accuracy(judged(spark, op9_quality, "quality", 3, 1)) > 0.95


def test_label_model_finds_good_and_repeated_voters():
    rng = np.random.default_rng(1)
    y = rng.random(20_000) < 0.2
    good = np.where(rng.random(len(y)) < 0.9, y, ~y)
    votes = np.stack([good, good, np.where(rng.random(len(y)) < 0.8, y, ~y), rng.random(len(y)) < 0.5], axis=1).astype(float)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    known = np.stack([[((votes[:500] == p).all(axis=1) & (y[:500] == c)).sum() for c in (0, 1)] for p in patterns]).astype(float)
    model = fit_label_model(patterns, counts.astype(float), known)
    assert {int(model.parent[0]), int(model.parent[1])} == {-1, 0} or model.parent[0] == 1  # the copied voter
    assert model.parent[2] == model.parent[3] == -1
    assert np.mean((model.posterior(votes) >= 0.5) == y) > 0.88
    assert abs(model.fires[3, 0] - model.fires[3, 1]) < 0.1
    # Plain: the copy adds nothing, so the posterior is that of two independent voters of the true rates.
    odds = 0.25 * np.where(patterns[:, 0] > 0, 9, 1 / 9) * np.where(patterns[:, 2] > 0, 4, 1 / 4)
    alike = patterns[:, 0] == patterns[:, 1]
    assert np.abs(model.posterior(patterns) - odds / (1 + odds))[alike].max() < 0.08
    assert np.abs(model.accuracies() - (votes == y[:, None]).mean(axis=0)).max() < 0.03


def test_tree_joins_voters_that_depend_on_each_other():
    rng = np.random.default_rng(5)
    y = rng.random(40_000) < 0.3
    a = rng.random(len(y)) < np.where(y, 0.7, 0.1)
    b = np.where(rng.random(len(y)) < 0.8, a, rng.random(len(y)) < 0.5)
    c = rng.random(len(y)) < np.where(y, 0.6, 0.05)
    votes = np.stack([c, b, a], axis=1).astype(float)
    mass = np.stack([~y, y], axis=1).astype(float)
    assert dependence_tree(votes, mass).tolist() == [-1, -1, 1]


def test_voters_are_estimated_as_accurate_as_they_are(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    train = training_labels(labels, "toxic", 5, 0, 20_000)
    lexicons = induce_lexicons(docs.select("doc_id", "text").join(train, "doc_id"))
    seen = _features(docs, lexicons).select("doc_id", "votes").cache()
    model, posterior = model_of_votes(seen, train)
    rows = seen.join(labels.select("doc_id", "toxic"), "doc_id").where("toxic IS NOT NULL").select("votes", "toxic").toPandas()
    bits = (rows["votes"].to_numpy()[:, None] >> np.arange(len(VOTERS))) & 1
    true = (bits == rows["toxic"].to_numpy()[:, None]).mean(axis=0)
    print(dict(zip(VOTERS, zip(model.accuracies().round(3), true.round(3)), strict=True)), model.parent)
    assert np.abs(model.accuracies() - true).max() < 0.06
    assert posterior.count() == seen.select("votes").distinct().count()
    seen.unpersist()


def test_stretched_letters_stay_within_a_text(spark):
    texts = ["noooo", "nooo", "o", "ooo", "o", "", "aaaa", "1111 ----", None]
    bit = VOTERS.index("stretched")
    found = {r["doc_id"]: r["votes"] >> bit & 1 for r in _features(documents(spark, texts), [np.empty(0, np.uint64)] * 4).collect()}
    assert [found[i] for i in range(len(texts))] == [1, 0, 0, 0, 0, 0, 1, 0, 0]


def test_normal_equations_are_those_of_all_rows(spark):
    rng = np.random.default_rng(2)
    s, y = rng.normal(size=(400, len(STATISTICS))), rng.integers(0, 2, 400)
    fourier = Fourier(s.mean(axis=0), s.std(axis=0))
    rows = spark.createDataFrame([(row.tolist(), int(v)) for row, v in zip(s, y, strict=True)], "s array<double>, label int").repartition(5)
    gram, right = normal_equations(rows, fourier)
    z = fourier(s)
    assert np.allclose(gram, z.T @ z) and np.allclose(right, z.T @ y)
    # Inner products of many features approximate the Gaussian kernel.
    wide = Fourier(s.mean(axis=0), s.std(axis=0), features=20_000)
    x = (s[:40] - s.mean(axis=0)) / s.std(axis=0)
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * WIDTH**2))
    inner = wide(s[:40])[:, :-1]
    assert np.abs(inner @ inner.T - kernel).max() < 0.05


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(3)
    texts, labels = [], []
    for i in range(300):
        bad = i % 3 == 0
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 60))]
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(["nasty", "vile", "rotten"]))
        texts.append(" ".join(words))
        labels.append((i, 1 - int(bad), int(bad), "x"))
    labels += [(0, None, None, "x"), (None, 1, 1, "x"), (10**9, 0, 1, "x")]
    texts += [None, "", "vile " * 20_000, texts[0], "so nasty and vile"]
    docs = documents(spark, texts, [*range(303), 0, None], extra="label votes score held_out quality toxic")
    return docs, table(spark, labels, "doc_id long, quality int, toxic int, text string")


def test_rare_terms_are_tested_among_many_ordinary_words(spark):
    ordinary = " ".join(f"ka{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300))
    rows = [(f"{ordinary} zorgle" if i < 5 else ordinary, 1) for i in range(12)] + [(ordinary, 0)] * 100
    labelled = table(spark, rows, "text string, label int")
    # The whole word and its first 4 and 5 letters; far more ordinary terms than the bound are in more toxic texts.
    assert [len(v) for v in induce_lexicons(labelled, 50)] == [1, 1, 1, 0]
    assert [len(v) for v in induce_lexicons(labelled, 3)] == [1, 1, 1, 0]
    with pytest.raises(ValueError, match="more than 2 terms"):
        induce_lexicons(labelled, 2)


@pytest.mark.parametrize("score", [toxicity_scores, quality_scores])
def test_odd_rows(spark, odd, score):
    docs, labels = odd
    found = score(docs, labels).collect()
    assert len(found) == 305 and all(r["score"] is not None and 0 <= r["score"] <= 1 for r in found)
    assert len({r["score"] for r in found if r["doc_id"] == 0}) == 1
    assert [r["held_out"] for r in found if r["doc_id"] is None] == [True]
    assert score(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in score(docs, labels.limit(0)).collect()} == {0.0}


def test_toxic_rows_go(spark, odd):
    docs, labels = odd
    kept = without_toxic(docs, labels)
    assert kept.columns == docs.columns
    texts = [r["text"] for r in kept.collect()]
    bad = lambda t: any(w in (t or "") for w in ("nasty", "vile", "rotten"))
    assert sum(map(bad, texts)) <= 2 and sum(not bad(t) for t in texts) == 202


def test_calibration_keeps_the_order():
    ridge = np.linspace(-1, 2, 500)
    out = calibrated(ridge, (np.array([0.0, 0.4, 0.6, 1.0]), np.array([0.1, 0.1, 0.9, 0.9])))
    assert (np.diff(out) >= 0).all() and len(np.unique(out[200:300])) == 100


def test_fold_of_a_missing_id(spark):
    frame = spark.createDataFrame([(1,), (None,)], "i long").select(held_out(F.col("i"), 5, 0)).collect()
    assert [r[0] for r in frame] == [zlib.crc32(b"1") % 5 == 0, True]


def test_pipeline(spark):
    """Each stage on what the one before has kept, against plain versions."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "pii", "packing"]
    stage = dict(corpus_pipeline.STAGES)
    toxic = {r["doc_id"] for r in toxicity_scores(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()}
    rows = [r for r in docs.collect() if r["doc_id"] not in toxic]
    rows.sort(key=lambda r: r["doc_id"])
    group = near_groups([r["text"] for r in rows])
    rows = [r for i, r in enumerate(rows) if group[i] == i]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [r for r in rows if not hit_words(r["text"], items)[0]]
    assert toxic and len(rows) < docs.count() - len(toxic)
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in out} == {r["doc_id"] for r in rows}
    clean = stage["pii"](spark, docs, SF)
    assert clean.schema == docs.schema and clean.where("text LIKE '%@%.%' OR n_chars != length(text)").count() == 0


def test_stages_keep_columns_with_clashing_names(spark):
    names = "found_id found_digest own_digest pii_spans row digest score label votes hash"
    texts = ["plain words that nobody minds here", "write to some.body@mail.example.org now", None, ""] * 3
    docs = documents(spark, texts, extra=names)
    stage = dict(corpus_pipeline.STAGES)
    for name in ("toxicity", "near_duplicates", "decontamination", "pii"):
        out = stage[name](spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r[n] == "x" for r in rows for n in names.split()), name
