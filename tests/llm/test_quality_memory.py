"""What the driver holds while it fits the quality classifier."""

import tracemalloc

import numpy as np

from tradewind.llm import quality


def test_the_fit_holds_no_second_copy_of_its_samples():
    rng = np.random.default_rng(4)
    some = rng.random((6000, quality.WIDTH), dtype=np.float32) ** 3
    tracemalloc.start()
    try:
        model = quality.fit_nnpu(some[::4], some, prior=0.5)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < some.size * 8  # one copy in double precision
    assert np.isfinite(model.weights).all()


def test_drawn_rows_are_scaled_in_double_precision():
    rng = np.random.default_rng(5)
    some = (rng.random((300, 70)) * 9).astype(np.float32)
    mean, deviation = quality.moments(some)
    wide = some.astype(np.float64)
    assert (mean == wide.mean(axis=0)).all() and (deviation == wide.std(axis=0)).all()
    at = rng.integers(0, 300, 50)
    want = np.hstack([np.clip((wide - mean) / (deviation + 1e-3), -6, 6), np.ones((300, 1))])
    design = quality.Design(some, mean, deviation + 1e-3)
    assert (design.rows(at) == want[at]).all() and (design.half(1).rows(slice(None)) == want[1::2]).all()
    assert np.allclose(design.margins(np.arange(71.0)), want @ np.arange(71.0))


def test_sampled_features_come_in_the_order_of_their_ids(spark):
    texts = {i: f"{'word ' * (i % 7)}{i}" for i in range(200)}
    rows = spark.createDataFrame([(i * 7919 % 200, texts[i * 7919 % 200]) for i in range(200)], "id long, text string")
    got = quality._matrix(rows.repartition(5), "id", "text")
    assert got.dtype == np.float32 and (got == np.stack([quality.features(texts[i].encode()) for i in range(200)])).all()
    assert quality._matrix(rows.limit(0), "id", "text").shape == (0, quality.WIDTH)
