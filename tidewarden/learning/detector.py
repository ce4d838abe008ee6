"""A detector's state and its test-then-train fold over a block of ordered events."""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np

from tidewarden.learning.adwin import AdaptiveWindow
from tidewarden.learning.kernel import Model, model_of_row, row_of_model, train_block, train_blocks
from tidewarden.schema import MODEL_THRESHOLD, DetectorOptions

BLOCK_ROWS = 2048


@dataclass
class Detector:
    models: list[Model]
    window: AdaptiveWindow
    in_warning_zone: bool = False
    checks: int = 0

    @staticmethod
    def fresh(options: DetectorOptions) -> "Detector":
        return Detector(
            [Model() for _ in range(options.n_models)], AdaptiveWindow(options.drift_delta)
        )


def detector_to_json(detector: Detector) -> str:
    """Text form of a detector; doubles are written so that they read back equal."""
    return json.dumps(
        {
            "models": [row_of_model(0, m, 0, model) for m, model in enumerate(detector.models)],
            "rows": detector.window.rows,
            "ticks": detector.window.ticks,
            "in_warning_zone": detector.in_warning_zone,
            "checks": detector.checks,
        }
    )


def detector_from_json(text: str, options: DetectorOptions) -> Detector:
    kept = json.loads(text)
    return Detector(
        [model_of_row(row) for row in kept["models"]],
        AdaptiveWindow(options.drift_delta, kept["rows"], kept["ticks"]),
        kept["in_warning_zone"],
        kept["checks"],
    )


def ensemble_votes(
    scores: np.ndarray, accuracy: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vote, confidence, bot votes) per event from (events, models) scores.

    ``accuracy`` weights the votes; where it is absent or sums to zero the plain majority
    and the mean confidence decide. A tie is human.
    """
    bots = scores > MODEL_THRESHOLD
    bot_votes = bots.sum(axis=1)
    vote = bot_votes > scores.shape[1] - bot_votes
    confidence = (np.abs(scores - 0.5) * 2).mean(axis=1)
    if accuracy is not None:
        total = accuracy.sum(axis=1)
        bot = (accuracy * bots).sum(axis=1)
        weighted = total > 0
        vote = np.where(weighted, bot > total - bot, vote)
        confidence = np.where(weighted, bot / np.where(weighted, total, 1.0), confidence)
    return vote, confidence, bot_votes


def _watch(
    detector: Detector, errors: np.ndarray, out: dict, at: int, options, watched: np.ndarray | None
) -> int | None:
    """Feed errors from ``at`` on; stop at the first drift and return its position.

    Rows that ``watched`` leaves out are not observed and change nothing.
    """
    window = detector.window
    for i in range(at, len(errors)):
        if watched is not None and not watched[i]:
            out["instance_number"][i] = detector.checks
            continue
        detector.checks += 1
        drift = window.add(float(errors[i]))
        rate = window.estimate
        entered = not drift and rate > options.warning_level and not detector.in_warning_zone
        if drift:
            detector.in_warning_zone = False
        else:
            detector.in_warning_zone = rate > options.warning_level
        out["error_rate"][i] = rate
        out["window_length"][i] = window.width
        out["warning"][i] = entered
        out["drift"][i] = drift
        out["in_warning_zone"][i] = detector.in_warning_zone
        out["instance_number"][i] = detector.checks
        if drift:
            return i
    return None


def fold_block(
    detector: Detector, x: np.ndarray, is_bot: np.ndarray, copies: np.ndarray, options: DetectorOptions,
    threshold: np.ndarray | None = None, drift_on: np.ndarray | None = None,
) -> dict[str, np.ndarray]:
    """Detect and learn over a block, in order; updates ``detector`` and returns columns.

    ``threshold`` and ``drift_on`` hold, row by row, instead of the options' own.

    The models learn independently of each other, so each is run over the whole block.
    A drift replaces one model, and only that one is run again from the next event on.
    """
    rows, n_models = len(x), len(detector.models)
    scores = np.empty((rows, n_models))
    seen = np.empty((rows, n_models))
    correct = np.empty((rows, n_models))

    def take(m: int, model: Model, start: int, scored: np.ndarray, trained: Model) -> None:
        part = slice(start, None)
        scores[part, m] = scored
        right = (scores[part, m] > MODEL_THRESHOLD) == is_bot[part]
        seen[part, m] = model.seen + np.arange(rows - start)
        correct[part, m] = model.correct + np.cumsum(right) - right
        trained.seen = model.seen + rows - start
        trained.correct = model.correct + int(right.sum())
        detector.models[m] = trained

    for m, found in enumerate(train_blocks(detector.models, x, is_bot, copies, options)):
        take(m, detector.models[m], 0, *found)
    out = {
        "error_rate": np.zeros(rows),
        "window_length": np.zeros(rows, np.int32),
        "instance_number": np.arange(detector.checks + 1, detector.checks + rows + 1),
        **{name: np.zeros(rows, bool) for name in ("warning", "drift", "in_warning_zone")},
    }
    at: int | None = 0
    while True:
        accuracy = correct / np.maximum(seen, 1) if options.vote == "weighted" else None
        vote, confidence, bot_votes = ensemble_votes(scores, accuracy)
        flagged = vote & (confidence >= (options.threshold if threshold is None else threshold))
        if not (options.drift_enabled if drift_on is None else drift_on.any()):
            break
        drift = _watch(detector, flagged != is_bot, out, at, options, drift_on)
        if drift is None:
            break
        at = drift + 1
        worst = 0
        if options.vote == "weighted":
            right = (scores[drift] > MODEL_THRESHOLD) == is_bot[drift]
            worst = int(np.argmin((correct[drift] + right) / (seen[drift] + 1)))
        detector.window = AdaptiveWindow(options.drift_delta)
        if at == rows:
            detector.models[worst] = Model()
            break
        take(worst, Model(), at, *train_block(Model(), x[at:], is_bot[at:], copies[at:, worst], options))
    return {
        "is_bot_pred": flagged,
        "vote": vote,
        "confidence": confidence,
        "bot_votes": bot_votes.astype(np.int32),
        "human_votes": (n_models - bot_votes).astype(np.int32),
        **out,
    }
