"""Held-out accuracy on planted insults, and odd tables."""

import random

import numpy as np
import pytest

from tickloom.llm import toxicity


def planted(n, seed=1, share=0.15):
    rng = random.Random(seed)
    syllables = "an er th on ti ou st ha re nd ing en at ed es or he is".split()
    insults = ["grobnak", "vileworm", "scumbelt"]
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 80))]
        toxic = rng.random() < share
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = rng.choice(insults) + rng.choice(["", "s", "ed", "!"])
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return (
        spark.createDataFrame([(i, t, "en", 0.5) for i, t in docs], "doc_id long, text string, lang string, score double"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_planted_insults_of_the_held_out_quarter(spark):
    docs, labels = planted(1500)
    truth = {i: t for i, _, t in labels}
    got = [(r.held_out, r.score >= 0.3, truth[r.doc_id]) for r in toxicity.scores(*frames(spark, docs, labels)).collect()]
    held = [(p, t) for h, p, t in got if h]
    assert 0.15 < len(held) / len(got) < 0.35
    assert sum(p for p, t in held if t) >= 0.97 * sum(t for _, t in held)
    assert sum(p for p, t in held if not t) <= 0.01 * len(held)


def test_held_out_labels_teach_nothing(spark):
    import zlib

    docs, labels = planted(400, seed=5)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    first, second = ({r.doc_id: r.score for r in toxicity.scores(*frames(spark, docs, x)).collect()} for x in (labels, turned))
    assert first == second


def test_odd_tables(spark):
    docs = [(1, None), (2, ""), (3, "12 %%"), (None, "text here"), (5, "word " * 100_000), (5, "word")]
    for labels in ([], [(1, 0, 1)], [(1, 0, 0), (2, 1, 0)], [(None, 0, 1), (3, 0, None), (5, 0, 7)], [(1, 0, 1), (2, 0, 0), (3, 0, 1), (5, 0, 0), (5, 0, 1)]):
        got = toxicity.scores(*frames(spark, docs, labels)).collect()
        assert len(got) == len(docs)
        assert all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    assert toxicity.scores(*frames(spark, [], [(1, 0, 1)])).collect() == []


def test_bounded_sample(spark):
    docs, labels = planted(400, seed=3)
    rows = toxicity.training_rows(*frames(spark, docs, labels), sample_rows=100).count()
    assert 60 < rows < 140


def test_shared_probabilities_sum_to_one():
    words = ["anna", "ann", "banana", "bandana", "nab"]
    runs = np.array(sorted({r for w in words for r in toxicity.runs_of(w)}), f"U{toxicity.CONTEXT + 1}")
    letters = {r[-1] for r in runs}
    wide = np.array([f"xan{c}" for c in letters], runs.dtype)
    value = toxicity.shared_probabilities(np.concatenate([runs, wide]))
    assert value.min() > 0 and value.max() <= 1
    single = {str(r)[1:]: v for r, v in zip(runs, toxicity.shared_probabilities(runs), strict=True) if len(r) == 2}
    assert sum(single.values()) <= 1 + 1e-9


def test_logistic_separates():
    slope, offset = toxicity.logistic([(0.1, 0, 500), (0.3, 0, 100), (1.5, 1, 60), (1.2, 1, 5)])

    def score(x):
        return 1 / (1 + np.exp(-(slope * x + offset)))

    assert score(0.3) < 0.1 and score(1.2) > 0.5
    assert toxicity.logistic([(0.0, 1, 3), (0.0, 0, 3)])[0] == pytest.approx(0, abs=1e-6)


def test_every_run_of_the_fitted_rows_is_kept(spark, monkeypatch):
    docs, labels = planted(400, seed=3)
    whole = {r.doc_id: r.score for r in toxicity.scores(*frames(spark, docs, labels)).collect()}
    monkeypatch.setattr(toxicity, "MODEL_RUNS", 50, raising=False)  # a bound on runs, if there is one
    assert {r.doc_id: r.score for r in toxicity.scores(*frames(spark, docs, labels)).collect()} == whole


def test_the_scoring_fit_alone_gives_the_same_evidence(monkeypatch):
    texts = [t for _, t in planted(200)[0]] + [None, "", "1 2 3"]
    runs = sorted({r for t in texts[:100] for w in toxicity.words_of(t) for r in toxicity.runs_of(w)})
    n = np.arange(len(runs)) % 7 + 1.0
    tables = toxicity.fit(np.array(runs).astype("U6"), [(n, n[::-1]), (n, np.roll(n, 3))])
    whole, last = toxicity.Model(*tables), toxicity.Scorer(*tables)
    monkeypatch.setattr(toxicity.Scorer, "words", 5)  # emptied within texts
    assert [last.text(t, 0) for t in texts] == [whole.text(t, 1) for t in texts]
    assert len(last.caches[0]) <= 5
