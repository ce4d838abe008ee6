"""The block fold against a plain event-by-event reading of the documented semantics."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewarden.learning.adwin import AdaptiveWindow
from tidewarden.learning.detector import Detector, fold_block
from tidewarden.learning.kernel import model_of_row, row_of_model
from tidewarden.schema import DetectorOptions


class PlainModel:
    def __init__(self):
        self.n, self.mean, self.sd = 0, [0.0] * 14, [0.0] * 14
        self.weights, self.rules = [1 / 14] * 14, []
        self.correct = self.seen = 0

    def score(self, x):
        if self.n == 0 or not self.rules:
            return 0.5
        return self.trained_score(x)

    def trained_score(self, x):
        linear = 0.0
        for i in range(14):
            z = 0.0 if self.sd[i] == 0 else (x[i] - self.mean[i]) / self.sd[i]
            linear += z * self.weights[i]
        for rule in self.rules:
            if sum(abs(a - b) < 0.1 for a, b in zip(x, rule)) >= 7:
                return 0.7 * 0.8 + 0.3 * linear
        return linear

    def train(self, x, is_bot, options):
        n = self.n + 1
        for i in range(14):
            old = self.mean[i]
            self.mean[i] = old + (x[i] - old) / n
            if n > 1:
                part = (n - 2) * self.sd[i] ** 2 + (x[i] - old) * (x[i] - self.mean[i])
                self.sd[i] = math.sqrt(max(part / (n - 1), 0))
        if self.n % options.grace_period == 0 and 0.8 > options.split_confidence:
            self.rules = (self.rules + [list(x)])[-options.max_rules :]
        score = 0.5 if self.n == 0 or not self.rules else self.trained_score(x)
        if (score > 0.7) != is_bot:
            sign = 1 if is_bot else -1
            moved = [
                max(0.0, min(1.0, w + sign * 0.01 * abs(v * w))) for v, w in zip(x, self.weights)
            ]
            total = sum(moved)
            self.weights = [m / total for m in moved] if total > 0 else moved
        self.n += 1


def plain_fold(xs, labels, copies, options):
    models = [PlainModel() for _ in range(options.n_models)]
    window, out = AdaptiveWindow(options.drift_delta), []
    for x, label, ks in zip(xs, labels, copies):
        scores = [m.score(x) for m in models]
        bots = [s > 0.7 for s in scores]
        vote = sum(bots) > len(bots) - sum(bots)
        confidence = sum(abs(s - 0.5) * 2 for s in scores) / len(scores)
        if options.vote == "weighted":
            accuracy = [m.correct / m.seen if m.seen else 0.0 for m in models]
            if sum(accuracy) > 0:
                bot = sum(a for a, b in zip(accuracy, bots) if b)
                vote, confidence = bot > sum(accuracy) - bot, bot / sum(accuracy)
        flagged = bool(vote and confidence >= options.threshold)
        for m, bot, k in zip(models, bots, ks):
            m.seen += 1
            m.correct += bot == label
            for _ in range(k):
                m.train(x, label, options)
        drift = options.drift_enabled and window.add(float(flagged != label))
        if drift:
            worst = 0
            if options.vote == "weighted":
                worst = min(range(len(models)), key=lambda i: (models[i].correct / models[i].seen, i))
            models[worst] = PlainModel()
            window = AdaptiveWindow(options.drift_delta)
        out.append((flagged, bool(vote), confidence, sum(bots), drift))
    return out, models


def sample(rows, seed, n_models):
    rng = np.random.default_rng(seed)
    is_bot = rng.random(rows) < 0.3
    human = np.column_stack([
        rng.integers(1, 6, rows), rng.uniform(100, 300, rows), rng.integers(3, 13, rows),
        rng.uniform(0.6, 0.95, rows), rng.uniform(0.4, 0.9, rows), rng.integers(60, 660, rows),
        rng.uniform(3, 10, rows), rng.integers(0, 3, rows), rng.uniform(1000, 6000, rows),
        rng.integers(10, 15, rows), rng.random(rows) > 0.05, rng.random(rows) > 0.1,
        rng.integers(1920, 2920, rows), np.ones(rows),
    ])
    bot = np.column_stack([
        rng.integers(10, 50, rows), rng.uniform(10, 60, rows), rng.integers(5, 35, rows),
        np.full(rows, 0.1), np.zeros(rows), rng.integers(10, 110, rows),
        rng.uniform(10, 50, rows), rng.integers(5, 15, rows), rng.uniform(50, 250, rows),
        rng.integers(3, 8, rows), np.zeros(rows), np.zeros(rows),
        rng.integers(1024, 1524, rows), np.ones(rows),
    ])
    x = np.where(is_bot[:, None], bot, human).astype(float)
    # Halfway the labels flip for a while, so that drift has something to find.
    labels = is_bot.copy()
    labels[rows // 2 : rows * 3 // 4] ^= True
    return x, labels, rng.poisson(1.0, (rows, n_models))


@pytest.mark.parametrize("vote", ["majority", "weighted"])
@pytest.mark.parametrize("block", [1, 7, 250, 600])
def test_fold_equals_plain_reading(vote, block):
    options = DetectorOptions(
        n_models=3, vote=vote, grace_period=20, max_rules=4, threshold=0.5, drift_delta=0.05
    )
    x, labels, copies = sample(600, 3, 3)
    expected, models = plain_fold(x, labels, copies, options)
    detector, rows = Detector.fresh(options), []
    for at in range(0, 600, block):
        part = slice(at, at + block)
        out = fold_block(detector, x[part], labels[part], copies[part], options)
        rows += list(zip(*[out[c].tolist() for c in ("is_bot_pred", "vote", "confidence", "bot_votes", "drift")]))
    assert any(row[4] for row in expected)
    for mine, theirs in zip(rows, expected):
        assert mine[:2] == theirs[:2] and mine[3:] == theirs[3:]
        assert mine[2] == pytest.approx(theirs[2], abs=1e-7)
    for mine, theirs in zip(detector.models, models):
        assert (mine.n, mine.seen, mine.correct) == (theirs.n, theirs.seen, theirs.correct)
        assert np.allclose(mine.weights, theirs.weights, atol=1e-9)
        assert np.allclose(mine.mean, theirs.mean)
        assert np.array_equal(mine.rules, np.array(theirs.rules).reshape(-1, 14))


def test_no_rules_stays_neutral():
    options = DetectorOptions(n_models=1, split_confidence=0.9)
    x, labels, copies = sample(50, 1, 1)
    detector = Detector.fresh(options)
    out = fold_block(detector, x, labels, copies, options)
    assert not out["vote"].any() and (out["confidence"] == 0).all()


def test_model_row_round_trip():
    options = DetectorOptions(n_models=1, grace_period=10)
    x, labels, copies = sample(80, 2, 1)
    detector = Detector.fresh(options)
    fold_block(detector, x, labels, copies, options)
    row = row_of_model(0, 0, 1, detector.models[0])
    assert row_of_model(0, 0, 1, model_of_row(row)) == row


def errors(rate, rows, seed):
    return (np.random.default_rng(seed).random(rows) < rate).astype(float)


def test_window_finds_a_step_and_ignores_a_constant_rate():
    for seed in range(5):
        window = AdaptiveWindow(0.002)
        assert not any([window.add(e) for e in errors(0.07, 4000, seed)])
        assert any([window.add(e) for e in errors(0.5, 500, seed + 100)])
        assert window.width < 3000 and window.estimate > 0.1


def test_window_of_blocks_keeps_totals():
    window = AdaptiveWindow(0.002)
    for _ in range(300):
        window.add(7.0, 100)
    assert window.width == 30_000 and window.estimate == pytest.approx(0.07)
    assert sum(len(row) for row in window.rows) < 50
    assert any([window.add(30.0, 100) for _ in range(40)])


def test_resumed_fold_equals_one_fold(spark, traffic, tmp_path):
    """Detectors saved after each third go on as if never stopped: drift window, zone and counters included."""
    from tidewarden.learning.exact import detections_of, exact_fold, final_detectors
    from tidewarden.sources.model_store import load_detectors, save_detectors

    options = DetectorOptions(n_models=3, drift_delta=0.3)
    whole = detections_of(exact_fold(traffic, options))
    cuts = traffic.agg(F.percentile_approx("ts", [0.33, 0.66], 10000)).first()[0]
    parts = (F.col("ts") < cuts[0], (F.col("ts") >= cuts[0]) & (F.col("ts") < cuts[1]), F.col("ts") >= cuts[1])
    found, start = None, None
    for version, part in enumerate(parts):
        exact_fold(traffic.filter(part), options, start).write.parquet(str(tmp_path / f"fold{version}"))
        folded = spark.read.parquet(str(tmp_path / f"fold{version}"))
        found = detections_of(folded) if found is None else found.unionByName(detections_of(folded))
        save_detectors(final_detectors(folded), str(tmp_path / "store"), version)
        start = load_detectors(spark, str(tmp_path / "store"))
    columns = ("event_id", "is_bot_pred", "vote", "instance_number", "drift", "warning", "window_length", "in_warning_zone")
    assert found.count() == traffic.count()
    assert found.select(*columns).exceptAll(whole.select(*columns)).isEmpty()

    idle = exact_fold(traffic.limit(0), options, start)
    kept = {r["shard"]: r["detector"] for r in start.collect()}
    assert {r["shard"]: r["detector"] for r in final_detectors(idle).collect()} == kept
