"""One model's arrays, its scores over a block of events, and its training step.

Within a block only the weights depend on earlier mistakes. Means, deviations and rules
follow from the inputs alone and are computed for the whole block at once; the weights
are then walked from mistake to mistake, or, where mistakes are frequent, copy by copy
for several models at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np

from tidewarden.schema import (
    LEARNING_RATE,
    MODEL_THRESHOLD,
    N_FEATURES,
    NEUTRAL_SCORE,
    RULE_CONFIDENCE,
    RULE_SHARE,
    RULE_TOLERANCE,
    DetectorOptions,
)

_MATCH_ROWS = 256
#: What a model's walk to its next mistake costs, as a share of one copy's step by several models together.
_WALK_SHARE = 0.8


@dataclass
class Model:
    """``clock`` is the training index that times new rules; it equals ``n`` unless the
    model is a copy that trains on a later part of the same stream."""

    n: int = 0
    mean: np.ndarray = field(default_factory=lambda: np.zeros(N_FEATURES))
    m2: np.ndarray = field(default_factory=lambda: np.zeros(N_FEATURES))
    weights: np.ndarray = field(default_factory=lambda: np.full(N_FEATURES, 1.0 / N_FEATURES))
    rules: np.ndarray = field(default_factory=lambda: np.zeros((0, N_FEATURES)))
    rule_seq: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    rule_bot: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    correct: int = 0
    seen: int = 0
    clock: int = 0


def deviations(m2: np.ndarray, n) -> np.ndarray:
    n = np.asarray(n, float)
    return np.sqrt(np.maximum(m2, 0.0) / np.maximum(n - 1, 1.0)) * (n > 1)


def zscores(x: np.ndarray, mean: np.ndarray, sd: np.ndarray) -> np.ndarray:
    return np.where(sd == 0, 0.0, (x - mean) / np.where(sd == 0, 1.0, sd))


def distinct_values(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each feature its distinct values and where each event's stands among them."""
    return [np.unique(x[:, i], return_inverse=True) for i in range(N_FEATURES)]


def rule_hits(x: np.ndarray, rules: np.ndarray, distinct: list | None = None) -> np.ndarray:
    """(events, rules) booleans: at least half of the features within the tolerance.

    Many features repeat few values, so each distinct value meets the rules once
    (``distinct``: what :func:`distinct_values` gave for ``x``).
    """
    hits = np.zeros((len(x), len(rules)), bool)
    if not hits.size:
        return hits
    close = []
    for (values, place), of_rules in zip(distinct or distinct_values(x), np.ascontiguousarray(rules.T)):
        apart = values[:, None] - of_rules
        np.abs(apart, out=apart)
        close.append(((apart < RULE_TOLERANCE).view(np.int8), place))
    for at in range(0, len(x), _MATCH_ROWS):
        part = slice(at, at + _MATCH_ROWS)
        count = np.zeros(hits[part].shape, np.int8)
        for table, place in close:
            count += table[place[part]]
        np.greater_equal(count, N_FEATURES // 2, out=hits[part])
    return hits


def blend(matched: np.ndarray, linear: np.ndarray) -> np.ndarray:
    return np.where(
        matched, RULE_SHARE * RULE_CONFIDENCE + (1 - RULE_SHARE) * linear, linear
    )


def frozen_scores(model: Model, x: np.ndarray) -> np.ndarray:
    """Scores of a block under an unchanging model."""
    if model.n == 0 or not len(model.rules):
        return np.full(len(x), NEUTRAL_SCORE)
    linear = zscores(x, model.mean, deviations(model.m2, model.n)) @ model.weights
    return blend(rule_hits(x, model.rules).any(axis=1), linear)


def moved_weights(weights: np.ndarray, x: np.ndarray, is_bot: bool) -> np.ndarray:
    """Weights after one mistake: up for a missed bot, down for a false alarm."""
    # plain ufuncs in place: this runs once a mistake, where the call overhead is most of its time
    step = x * weights
    np.abs(step, out=step)
    step *= LEARNING_RATE
    moved = np.add(weights, step, out=step) if is_bot else np.subtract(weights, step, out=step)
    np.maximum(moved, 0.0, out=moved)
    np.minimum(moved, 1.0, out=moved)
    total = np.add.reduce(moved)
    return moved / total if total > 0 else moved


@dataclass
class _Block:
    """A block as one model meets it: what is known of its training copies before the weights are.

    A copy's score is ``given + share * (z @ weights)``; ``finish`` gives the events' scores and the trained
    model from the weights and the states since which each of them hold.
    """

    x: np.ndarray
    bots: np.ndarray
    z: np.ndarray
    share: np.ndarray
    given: np.ndarray
    finish: Callable[[Sequence[np.ndarray], Sequence[int]], tuple[np.ndarray, Model]]


def train_blocks(
    models: list[Model], x: np.ndarray, is_bot: np.ndarray, copies: np.ndarray, options: DetectorOptions
) -> list[tuple[np.ndarray, Model]]:
    """:func:`train_block` for several models, with their ``copies`` in columns."""
    distinct = distinct_values(x)
    blocks = [_prepared(m, x, is_bot, copies[:, i], options, distinct) for i, m in enumerate(models)]
    weights = [model.weights for model in models]
    walks = [_walked(block, w) for block, w in zip(blocks[:1], weights)]  # its mistakes stand for the others'
    rest = blocks[1:]
    if rest and len(walks[0][0]) * len(rest) * _WALK_SHARE > max(len(block.z) for block in rest):
        walks += _walked_together(rest, weights[1:])
    else:
        walks += [_walked(block, w) for block, w in zip(rest, weights[1:])]
    return [block.finish(*walk) for block, walk in zip(blocks, walks)]


def train_block(
    model: Model, x: np.ndarray, is_bot: np.ndarray, copies: np.ndarray, options: DetectorOptions
) -> tuple[np.ndarray, Model]:
    """Score each event before training on it ``copies`` times; returns scores and model."""
    return train_blocks([model], x, is_bot, copies[:, None], options)[0]


def _walked(block: _Block, weights: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
    """The weights of one model after each mistake, and the states since which they hold."""
    bots, total = block.bots.tolist(), len(block.z)
    changes, kept = [0], [weights]
    at, span = 0, 16
    while at < total:
        part = slice(at, at + span)
        score = block.z[part] @ weights
        score *= block.share[part]
        score += block.given[part]
        wrong = (score > MODEL_THRESHOLD) != block.bots[part]
        first = int(wrong.argmax())
        if not wrong[first]:
            at, span = at + span, span * 2
            continue
        at, span = at + first, 16
        weights = moved_weights(weights, block.x[at], bots[at])
        at += 1
        changes.append(at)
        kept.append(weights)
    return kept, changes


def _walked_together(blocks: list[_Block], weights: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """:func:`_walked` for several models at once, copy by copy: every call serves all models that err."""
    longest = max(len(block.z) for block in blocks)

    def stacked(name: str) -> np.ndarray:
        parts = [getattr(block, name) for block in blocks]
        whole = np.zeros((longest, len(parts), *parts[0].shape[1:]), parts[0].dtype)
        for m, part in enumerate(parts):
            whole[: len(part), m] = part
        return whole  # past a model's end it scores 0 a human, which is right

    x, z, share, given, bots = (stacked(name) for name in ("x", "z", "share", "given", "bots"))
    rate = np.where(bots, LEARNING_RATE, -LEARNING_RATE)[:, :, None]
    now = np.array(weights)
    states, erring, moves = [0], [np.arange(len(blocks))], [now.copy()]
    for at, (of_z, of_share, of_given, of_bots) in enumerate(zip(z, share, given, bots)):
        score = np.einsum("ij,ij->i", of_z, now)
        score *= of_share
        score += of_given
        (err,) = ((score > MODEL_THRESHOLD) != of_bots).nonzero()
        if not len(err):
            continue
        # as in moved_weights
        old = now.take(err, axis=0)
        step = x[at].take(err, axis=0)
        step *= old
        np.abs(step, out=step)
        step *= rate[at].take(err, axis=0)
        step += old
        np.maximum(step, 0.0, out=step)
        np.minimum(step, 1.0, out=step)
        total = np.add.reduce(step, axis=1, keepdims=True)
        if not np.minimum.reduce(total, axis=None) > 0:
            total = np.where(total > 0, total, 1.0)
        step /= total
        now[err] = step
        states.append(at + 1)
        erring.append(err)
        moves.append(step)
    state = np.repeat(states, [len(err) for err in erring])
    model, kept = np.concatenate(erring), np.concatenate(moves)
    return [(kept[model == m], state[model == m]) for m in range(len(blocks))]


def _prepared(
    model: Model, x: np.ndarray, is_bot: np.ndarray, copies: np.ndarray, options: DetectorOptions, distinct: list
) -> _Block:
    """State ``s`` means the model after ``s`` of the block's training copies."""
    rows = np.repeat(np.arange(len(x)), copies)
    before = np.cumsum(copies) - copies  # state in which each event is scored
    total = len(rows)
    trained_x, trained_bot = x[rows], is_bot[rows]

    # Statistics in every state, around the old mean (or the first value).
    centre = model.mean if model.n or not total else trained_x[0]
    n = model.n + np.arange(total + 1)
    shifted = np.vstack([np.zeros((1, N_FEATURES)), trained_x - centre])
    s1, s2 = shifted.cumsum(axis=0), (shifted * shifted).cumsum(axis=0)
    counts = np.maximum(n, 1)[:, None]
    mean, m2 = centre + s1 / counts, model.m2 + s2 - s1 * s1 / counts
    sd = deviations(m2, n[:, None])

    # Rules: each is active from the state that adds it until max_rules newer ones exist.
    keeps_rules = RULE_CONFIDENCE > options.split_confidence
    clock = model.clock + np.arange(total)
    added = np.flatnonzero(clock % options.grace_period == 0) if keeps_rules else rows[:0]
    rules = np.vstack([model.rules, trained_x[added]])
    rule_seq = np.concatenate([model.rule_seq, clock[added]])
    rule_bot = np.concatenate([model.rule_bot, trained_bot[added]])
    begins = np.concatenate([np.zeros(len(model.rules), np.int64), added + 1])
    ends = np.full(len(rules), total + 1)
    if len(rules) > options.max_rules:
        ends[: -options.max_rules] = begins[options.max_rules :]
    hits = rule_hits(x, rules, distinct)
    lasting = (begins == 0) & (ends > total)  # most rules are active in every state
    always, passing = hits[:, lasting].any(axis=1), hits[:, ~lasting]
    opens, closes = begins[~lasting], ends[~lasting]

    def matched(row: np.ndarray, state: np.ndarray) -> np.ndarray:
        state = state[:, None]
        return always[row] | (passing[row] & (opens <= state) & (state < closes)).any(axis=1)

    # Training scores see the new statistics and rule but the weights before the update;
    # the very first copy is still neutral.
    states = np.arange(1, total + 1)
    z = zscores(trained_x, mean[1:], sd[1:])
    ruled = matched(rows, states)
    first_rule = begins.min() if len(rules) else total + 1
    neutral = (n[:-1] == 0) | (states < first_rule)
    # A score is given + share * linear, which is what blend() and the neutral score come to.
    share = np.where(neutral, 0.0, np.where(ruled, 1 - RULE_SHARE, 1.0))
    given = np.where(neutral, NEUTRAL_SCORE, np.where(ruled, RULE_SHARE * RULE_CONFIDENCE, 0.0))

    def finish(kept: Sequence[np.ndarray], changes: Sequence[int]) -> tuple[np.ndarray, Model]:
        # Prequential scores: the state and weights each event met.
        in_force = np.asarray(kept)[np.searchsorted(changes, before, side="right") - 1]
        linear = np.einsum("ij,ij->i", zscores(x, mean[before], sd[before]), in_force)
        scores = blend(matched(np.arange(len(x)), before), linear)
        scores[(n[before] == 0) | (before < first_rule)] = NEUTRAL_SCORE

        live = slice(max(len(rules) - options.max_rules, 0), None)
        trained = Model(
            n=int(n[-1]),
            mean=mean[-1] if n[-1] else model.mean,
            m2=np.maximum(m2[-1], 0.0),
            weights=kept[-1],
            rules=rules[live],
            rule_seq=rule_seq[live],
            rule_bot=rule_bot[live],
            correct=model.correct,
            seen=model.seen,
            clock=model.clock + total,
        )
        return scores, trained

    return _Block(trained_x, trained_bot, z, share, given, finish)


def row_of_model(shard: int, model_id: int, version: int, model: Model) -> dict:
    """A ``model_state`` row."""
    return {
        "shard": int(shard),
        "model_id": int(model_id),
        "version": int(version),
        "n": int(model.n),
        "mean": model.mean.tolist(),
        "m2": model.m2.tolist(),
        "weights": model.weights.tolist(),
        "rules": [
            {"seq": int(s), "thresholds": t.tolist(), "outcome": bool(b)}
            for s, t, b in zip(model.rule_seq, model.rules, model.rule_bot)
        ],
        "correct": int(model.correct),
        "seen": int(model.seen),
    }


def model_of_row(row) -> Model:
    """The inverse of :func:`row_of_model`, for a Row or a dict."""
    rules = row["rules"] if row["rules"] is not None else []
    return Model(
        n=int(row["n"]),
        mean=np.array(row["mean"], float),
        m2=np.array(row["m2"], float),
        weights=np.array(row["weights"], float),
        rules=np.array([r["thresholds"] for r in rules], float).reshape(-1, N_FEATURES),
        rule_seq=np.array([r["seq"] for r in rules], np.int64),
        rule_bot=np.array([r["outcome"] for r in rules], bool),
        correct=int(row["correct"]),
        seen=int(row["seen"]),
        clock=int(row["n"]),
    )
