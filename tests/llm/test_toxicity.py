import tracemalloc

import numpy as np

from paceline.llm import toxicity as T


def test_weights_meet_the_optimum():
    rng = np.random.default_rng(1)
    found = [sorted(rng.choice(12, rng.integers(0, 6), replace=False).tolist()) for _ in range(400)]
    x = T.Chain([], {}, []).rows(found)
    dense = np.zeros((400, 12))
    for i, f in enumerate(found):
        dense[i, f] = 1
    extra = rng.normal(size=(400, 1))
    y = (rng.random(400) < T.sigmoid(dense @ rng.normal(size=12) + extra[:, 0])).astype(float)
    w, v = T.fit_linear(x, extra, y, 12, steps=3000, ridge=0.5)
    r = T.sigmoid(dense @ w + extra @ v[:1] + v[1]) - y
    assert np.allclose(dense.T @ r + 0.5 * w, 0, atol=1e-3) and abs(r.sum()) < 1e-3
    assert np.allclose(x.dot(w), dense @ w) and np.allclose(x.take(np.arange(5, 90)).dot(w), dense[5:90] @ w)


def test_later_models_learn_from_earlier_ones():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2, 600)
    texts = [("rude " if k else "kind ") + " ".join(rng.choice(["one", "two", "three", "four"], 3)) for k in a]
    chain = T.fit_chain(texts, {"first": a, "second": a})
    assert abs(chain.models[1][1][0]) > 0.05  # the weight of the first category's probability
    p = chain.probabilities(["rude one", "kind one", ""])
    assert (p[0] > 0.8).all() and (p[1] < 0.2).all() and p.shape == (3, 2)


def test_words_of_one_text_take_no_memory():
    letters = np.random.default_rng(3).integers(97, 123, (400, 250, 12), np.uint8)
    texts = [("rude " if i % 2 else "kind ") + " ".join(w.tobytes().decode() for w in own) for i, own in enumerate(letters)]
    tracemalloc.start()
    chain = T.fit_chain(texts, {"rude": np.arange(400) % 2})
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6  # 100,000 words
    assert {"=rude", "=kind"} <= set(chain.vocabulary)


def newton(dense, y, ridge):
    """Ridge logistic regression, the last column (the constant) without a penalty."""
    w, penalty = np.zeros(dense.shape[1]), np.append(np.full(dense.shape[1] - 1, ridge), 0)
    for _ in range(60):
        p = 1 / (1 + np.exp(-dense @ w))
        w = w - np.linalg.solve((dense * (p * (1 - p))[:, None]).T @ dense + np.diag(penalty) + 1e-12 * np.eye(len(w)), dense.T @ (p - y) + penalty * w)
    return w


def test_chain_against_a_plain_one():
    rng = np.random.default_rng(7)
    texts = [" ".join(rng.choice(["bad", "vile", "kind", "mild", "calm", "odd"], rng.integers(1, 5))) for _ in range(120)]
    labels = {"first": np.array([("bad" in t) ^ (rng.random() < 0.15) for t in texts]).astype(int), "second": np.array([("vile" in t or "bad" in t) ^ (rng.random() < 0.15) for t in texts]).astype(int)}
    chain = T.fit_chain(texts, labels, folds=3, steps=6000, ridge=0.5)

    def design(rows, names):
        return np.array([[float(f in {x for w in T.words_of(texts[r]) for x in T.features_of_word(w)}) for f in names] for r in rows])

    def names_of(rows):
        listed = sorted({x for r in rows for w in T.words_of(texts[r]) for x in T.features_of_word(w)})
        of = [np.array([k for k, f in enumerate(listed) if f in {x for w in T.words_of(texts[r]) for x in T.features_of_word(w)}]) for r in rows]
        return sorted({f for y in labels.values() for f in T._telling(of, listed, y[rows], T.FEATURES)})

    every = np.arange(120)
    one = np.ones((120, 1))
    handed = np.zeros(120)
    for k in range(3):
        learn, held = every[every % 3 != k], every[every % 3 == k]
        names = names_of(learn)
        w = newton(np.hstack([design(learn, names), one[learn]]), labels["first"][learn], 0.5)
        handed[held] = T.sigmoid(np.hstack([design(held, names), one[held]]) @ w)
    x = design(every, names_of(every))
    first = T.sigmoid(np.hstack([x, one]) @ newton(np.hstack([x, one]), labels["first"], 0.5))
    w = newton(np.hstack([x, handed[:, None], one]), labels["second"], 0.5)
    second = T.sigmoid(np.hstack([x, first[:, None], one]) @ w)
    assert np.allclose(chain.probabilities(texts), np.stack([first, second], 1), atol=2e-3)


def test_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    chain = T.fit(docs, labels, T.CATEGORIES, sample=2500)
    fitted = {r.doc_id for r in labels.selectExpr("doc_id", "xxhash64(doc_id) h").orderBy("h", "doc_id").limit(2500).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.doc_id not in fitted}
    rows = T.score(docs, chain).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r.rejected for r in rows}
    caught = sum(by[i] for i, t in truth.items() if t)
    wrong = sum(by[i] for i, t in truth.items() if not t)
    print("caught", caught, "of", sum(truth.values()), "wrong", wrong, "of", len(truth) - sum(truth.values()))
    assert caught >= 0.9 * sum(truth.values()) and wrong <= 0.005 * len(truth)


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 1), (9, 1, 1), (None, 1, 1), (7, None, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    chain = T.fit(odd, labels, T.CATEGORIES)
    rows = T.score(odd, chain).collect()
    assert len(rows) == odd.count() and all(0 <= r.p_toxic <= 1 for r in rows)
    kept = T.keep_clean(odd, chain)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if not r.rejected)
    assert T.score(odd.limit(0), T.fit(odd.limit(0), labels.limit(0), T.CATEGORIES)).collect() == []
