"""The classifier: held-out labels, the prior, odd rows."""

import numpy as np
from pyspark.sql import functions as F

from fieldlens.llm import quality as q
from fieldlens.llm.language import held_out


def test_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    rows = q.op4_quality(spark, d).filter("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 50
    right = np.mean([r.predicted == r.quality for r in rows])
    pos, neg = ([r.score for r in rows if r.quality == k] for k in (1, 0))
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert right >= 0.93 and auc >= 0.95
    assert q.op4_quality(spark, d).count() == docs.count()


def test_prior_and_risk(spark):
    rng = np.random.default_rng(3)
    good = rng.random(4000) < 0.7
    x = rng.random((4000, len(q.FEATURES))) + good[:, None] * 0.5
    rows = [(v.tolist(), bool(g and k % 2)) for k, (v, g) in enumerate(zip(x, good))]
    train = spark.createDataFrame(rows, "features array<float>, positive boolean").repartition(4)
    first = q.fit_weights(train, q.START_PRIOR)
    prior = q.estimate_prior(train, first)
    assert 0.6 < prior < 0.8
    w = q.fit_weights(train, prior, first)
    said = q.expanded(x.astype(np.float32)) @ w > 0
    assert np.mean(said == good) > 0.9


def test_sums_equal_a_plain_loop(spark):
    """Risk, gradients and curvature of the non-negative risk, row by row; and that a Newton step lowers it."""
    rng = np.random.default_rng(5)
    rows = [(rng.random(len(q.FEATURES)).tolist(), bool(k % 3 == 0)) for k in range(90)]
    train = spark.createDataFrame(rows, "features array<float>, positive boolean").repartition(7)
    w = rng.normal(size=q.WIDTH) / 4
    got = np.zeros(4 + 3 * q.WIDTH + q.WIDTH ** 2)
    for r in train.mapInArrow(q._sums(w), "i int, v double").collect():
        got[r.i] += r.v
    want = np.zeros_like(got)
    for features, positive in rows:
        x = [1.0, *np.float32(features).astype(float)]
        x += [v * v / 4 for v in x[1:]]
        x = np.array(x)
        z = sum(a * b for a, b in zip(x, w))
        p = 1 / (1 + np.exp(-z))
        loss_negative = -np.log(1 - p)
        want += np.concatenate([[1, positive, loss_negative, loss_negative * positive], p * x, x * positive, p * x * positive,
                                (p * (1 - p) * np.outer(x, x)).ravel()])
    assert np.allclose(got, want, rtol=1e-9)

    def risk(weights, prior):
        """The non-negative estimator: prior * R_p+ + max(0, R_u- - prior * R_p-)."""
        z = np.array([q.expanded(np.float32([f]))[0] @ weights for f, _ in rows])
        y = np.array([p for _, p in rows])
        plus, minus = np.logaddexp(0, -z), np.logaddexp(0, z)
        return prior * plus[y].mean() + max(0.0, minus.mean() - prior * minus[y].mean()) + q.RIDGE * weights @ weights / 2

    fitted = q.fit_weights(train, 0.4)
    assert risk(fitted, 0.4) < risk(np.zeros(q.WIDTH), 0.4)
    for k in range(q.WIDTH):        # a minimum, unless the negative part was raised again
        moved = fitted.copy()
        moved[k] += 0.3
        assert risk(moved, 0.4) >= risk(fitted, 0.4) - 1e-3


def test_query_equals_a_plain_run(spark, small):
    """op4_quality on a small table against the same steps in one process, over all rows at once."""
    import zlib

    docs = spark.read.parquet(f"{small}/documents.parquet").toPandas()
    labels = spark.read.parquet(f"{small}/labels.parquet").toPandas()
    out = docs["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    good = set(labels[labels["quality"] == 1]["doc_id"]) - set(docs[out]["doc_id"])
    x = q.expanded(np.concatenate([q.text_features([t]) for t in docs["text"]]))
    learn, positive = ~out.to_numpy(), docs["doc_id"].isin(good).to_numpy()

    def newton(prior, w):
        for _ in range(q.STEPS):
            z, u = x[learn] @ w, x[learn]
            p, y = 1 / (1 + np.exp(-z)), positive[learn]
            curve = (u * (p * (1 - p))[:, None]).T @ u / len(u) + q.RIDGE * np.eye(q.WIDTH)
            if np.logaddexp(0, z).mean() - prior * np.logaddexp(0, z[y]).mean() < 0:
                step = np.linalg.solve(curve, p @ u / len(u) - prior * (p[y] @ u[y]) / y.sum())
            else:
                step = -np.linalg.solve(curve, p @ u / len(u) - prior * u[y].mean(axis=0) + q.RIDGE * w)
            step *= min(1.0, 4.0 / np.abs(step).max())
            w = w + step
            if np.abs(step).max() < 1e-3:
                return w
        return w

    first = newton(q.START_PRIOR, np.zeros(q.WIDTH))
    s = np.floor(1 / (1 + np.exp(-(x[learn] @ first))) * 999)
    shares = [((s >= t).mean(), (s[positive[learn]] >= t).mean()) for t in range(1000)]
    prior = np.clip(min(a / b for a, b in shares if b >= 0.1) - q.SLACK, 0.02, 0.98)
    score = dict(zip(docs["doc_id"], 1 / (1 + np.exp(-(x @ newton(prior, first))))))
    rows = q.op4_quality(spark, small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert abs(r.score - score[r.doc_id]) < 1e-6 and r.predicted == (r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_features_of_junk():
    rows = q.text_features(["Plain words stand here, in order.", "A!! B!! C!!", "x | y | z", "na na na na na na", None, "", "#$ %& ##"])
    at = {f: i for i, f in enumerate(q.FEATURES)}
    assert rows[1, at["exclamations"]] > 1 and rows[2, at["bars"]] > 1 and rows[3, at["doubled"]] > 1 and rows[6, at["symbols"]] > 1
    assert not rows[4].any() and not rows[5].any() and rows[0, at["bars"]] == 0


def test_odd_rows(make, odd, empty):
    df = make(odd).withColumn("features", F.lit(1))
    learn = lambda i: i.isNotNull() & ~held_out(i, 5, 0)
    rows = q.classify(df, df.filter("doc_id = 7").select("doc_id"), learn).collect()
    assert len(rows) == len(odd) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert {r.score for r in q.classify(df, df.limit(0).select("doc_id"), learn).collect()} == {0.5}
    assert q.classify(empty, empty.select("doc_id"), learn).count() == 0
