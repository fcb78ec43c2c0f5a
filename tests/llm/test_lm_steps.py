"""Slopes and sums by id of the language model against plain versions."""

import numpy as np
from pyspark.sql import functions as F

from scorelake.llm import lm


def test_lm_slopes_hold_only_the_rows_of_the_batch():
    """Slopes as small differences give them; those of token vectors are rows of the batch, no table of the whole vocabulary."""
    rng = np.random.default_rng(1)
    counts = rng.integers(1, 50, 5000)
    model = lm.AttentionLM(counts, 4999, counts)
    context, target = rng.integers(0, 40, (3, lm.WINDOW)), rng.integers(0, 40, (3, lm.WINDOW))
    target[1, 5:] = -1
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}

    def loss():
        z = model.windows(context)
        return -np.take_along_axis(z, model.cls[np.maximum(target, 0)][:, :, None], 2)[:, :, 0][target >= 0].mean()

    keep: dict = {}
    g = model.gradients(context, target, keep)
    assert abs(keep["hit"][target >= 0].mean() + loss()) < 1e-5
    ids, slopes = g["emb"]
    assert len(ids) <= 40 and slopes.shape == (len(ids), lm.DIM)
    places = [(n, (i, j), g[n][i, j]) for n in ("q", "k", "v", "own", "out", "pos") for i, j in ((0, 1), (3, 2))] + [("bias", (2,), g["bias"][2]), ("emb", (ids[3], 4), slopes[3, 4])]
    for name, at, slope in places:
        w, keep_w = model.p[name], model.p[name][at]
        w[at] = keep_w + 1e-4
        up = loss()
        w[at] = keep_w - 1e-4
        assert abs((up - loss()) / 2e-4 - slope) < 2e-4, name
        w[at] = keep_w


def test_lm_sums_by_id(spark):
    """Counts from the landed ids as plain counts give them, with more texts than go side by side."""
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 30, rng.integers(1, 50)).astype(np.uint16) for _ in range(3 * lm.SIDE + 5)]
    marks = [np.concatenate([[1], rng.integers(0, 2, len(t) - 1)]).astype(np.uint8) for t in texts]
    rows = spark.createDataFrame([(i, bytearray(t.tobytes()), bytearray(m.tobytes())) for i, (t, m) in enumerate(zip(texts, marks))], "h long, ids binary, marks binary")
    n, begins, often = lm.count_subwords(rows.select("h", F.col("h").alias("doc_id"), "ids", "marks").repartition(3), "<u2", 31)
    every = np.concatenate(texts)
    assert n.tolist() == np.bincount(every, minlength=31).tolist()
    assert begins.tolist() == np.bincount(every[np.concatenate(marks) == 1], minlength=31).tolist()
    assert often.tolist() == [sum(i in t for t in texts) for i in range(31)]


def test_lm_scores_with_large_and_small_exponents():
    """Scores equal the plain windows whether exponents are shifted or not; a bound on all parameters no longer decides for every block."""
    rng = np.random.default_rng(6)
    counts = rng.integers(1, 50, 500)
    context, target = rng.integers(0, 400, (5, lm.WINDOW)), rng.integers(0, 400, (5, lm.WINDOW))
    for scale in (1, 40):  # one far vector that no window holds; then exponents that would overflow
        model = lm.AttentionLM(counts, 499, counts)
        model.p["emb"][450] = 1e3
        model.p["q"] *= scale
        plain = np.take_along_axis(model.windows(context), model.cls[target][:, :, None], 2)[:, :, 0] + model.inside[target]
        if scale == 1:
            model.mask = None  # shifted exponents would need it
        assert np.allclose(model.class_scores(context, target, 0), plain, atol=1e-3)
        assert np.allclose(model.class_scores(context, target, 6), plain[:, 6:], atol=1e-3)
