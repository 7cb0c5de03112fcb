"""Work of the language model: tasks that run at once, and places predicted once."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import mixing_lm

WORDS = [b"", b"a", b"ab", b"abc", b"abcd", b"abx", b"b", b"ba", b"\xff" * 30, b"\xff" * 29 + b"\x01"]


@pytest.mark.parametrize("words", [WORDS, sorted(WORDS), sorted(WORDS)[::-1], [b"z"], [b"ab", b"ab", b"abc", b"ab"]])
def test_a_place_is_predicted_once_after_the_same_bytes(words):
    layout = mixing_lm.Layout.of(words)
    places, number = layout.places()
    strings = [w + b" " for w in words]
    path = [s[: i + 1] for s in strings for i in range(len(s))]
    assert [path[places[n]] for n in number] == path
    if words == sorted(set(words)):
        assert len(places) == len(set(path)) and len(set(path)) < len(path) or len(words) == 1


def trained_model():
    rng = np.random.default_rng(3)
    words = sorted({bytes(rng.integers(97, 101, rng.integers(1, 7)).astype(np.uint8)) for _ in range(900)})
    counts = rng.integers(1, 50, len(words))
    tables = [np.zeros(2 << b, dtype=np.int32) for b in mixing_lm.SIZES]
    mixing_lm.count_tables(words, counts, 1000, tables)
    return words, counts, tables, mixing_lm.Prefixes.of([w + b" " for w in words], counts)


def test_shared_places_do_not_change_what_is_learned_or_scored(monkeypatch):
    words, counts, tables, prefixes = trained_model()
    common = (words[:5], counts[:5], prefixes.rows(np.arange(5)))
    seen, which = [], np.random.default_rng(4).permutation(np.arange(5, len(words)))

    def run():
        mixer, cells = mixing_lm.Mixer(), np.zeros((2, 8 * mixing_lm.BINS))
        some = [words[i] for i in which]
        mixing_lm.learn_mixing(some, counts[which], prefixes, which, common, 0.01, tables, mixer, cells)
        refined = (cells[0] + 1) / (cells[1] + 2)
        return mixer.weights, cells, mixing_lm.Model(tables, mixer.weights, refined).prepared().log10(words, prefixes)

    kept = mixing_lm.Layout.step
    monkeypatch.setattr(mixing_lm.Layout, "step", lambda self, k: seen.append(len(self.data)) or kept(self, k))
    once, some = run(), sum(seen)
    seen.clear()
    monkeypatch.setattr(mixing_lm.Layout, "places", lambda self: (np.arange(len(self.data)),) * 2)
    every, most = run(), sum(seen)
    assert some < 0.7 * most
    for a, b in zip(once, every, strict=True):
        assert np.allclose(a, b, rtol=1e-6, atol=1e-6)


def test_tasks_learn_at_once(spark, monkeypatch, tmp_path):
    """Two tasks each wait until the other has begun."""
    kept, folder = mixing_lm.learn_mixing, str(tmp_path)

    def waits(*args):
        from pathlib import Path

        from pyspark import TaskContext

        Path(folder, str(TaskContext.get().partitionId())).touch()
        late = time.time() + 20
        while len(list(Path(folder).iterdir())) < 2:
            if time.time() > late:
                raise TimeoutError("no other task learns")
            time.sleep(0.05)
        kept(*args)

    monkeypatch.setattr(mixing_lm, "learn_mixing", waits)
    monkeypatch.setattr(mixing_lm, "COMMON", 2)
    words = spark.range(2000).select(F.concat(F.lit("w"), F.col("id")).cast("binary").alias("word"), F.lit(3).cast("long").alias("trained"))
    monkeypatch.setattr(mixing_lm, "HEAD_WORDS", 50)
    heads = spark.sparkContext.broadcast(mixing_lm.count_heads(words))
    shared, weights, refined = mixing_lm.train(words, heads, 2)
    assert np.isfinite(weights).all() and ((refined > 0) & (refined < 1)).all()


def test_sums_by_text(monkeypatch):
    monkeypatch.setattr(mixing_lm, "SUMMED", 7)
    rng = np.random.default_rng(2)
    text, which, values = rng.integers(0, 9, 100), rng.integers(0, 5, 100), rng.random((5, 3))
    want = np.column_stack([np.bincount(text, column[which], 12) for column in values.T])
    assert np.allclose(mixing_lm.sums_by_text(text, values, which, 12), want)
    assert not mixing_lm.sums_by_text(text[:0], values, which[:0], 4).any()
