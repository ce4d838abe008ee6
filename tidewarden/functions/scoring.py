"""Scoring of one event by one model and by an ensemble, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewarden.functions.features import standard_deviations, zscores
from tidewarden.schema import (
    MODEL_THRESHOLD,
    N_FEATURES,
    NEUTRAL_SCORE,
    RULE_CONFIDENCE,
    RULE_SHARE,
    RULE_TOLERANCE,
    RULE_WEIGHT,
)


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def feature_score(z: Column, weights: Column) -> Column:
    """Weighted sum of z-scores; unbounded."""
    return F.aggregate(
        F.zip_with(z, weights, lambda a, w: a * w), F.lit(0.0), lambda acc, v: acc + v
    )


def close_features(x: Column, thresholds: Column) -> Column:
    """How many features lie strictly within the tolerance of a rule's thresholds."""
    distances = F.zip_with(x, thresholds, lambda a, t: F.abs(a - t))
    return F.size(F.filter(distances, lambda d: d < RULE_TOLERANCE))


def rule_matches(x: Column, thresholds: Column) -> Column:
    return close_features(x, thresholds) >= N_FEATURES // 2


def any_rule_matches(x: Column, rules: Column) -> Column:
    return F.exists(rules, lambda r: rule_matches(x, r["thresholds"]))


def rule_score(x: Column, rules: Column) -> Column:
    """Weighted mean confidence of the matching rules, null without a match.

    All rules share one weight and one confidence, so the mean is that confidence.
    """
    constant = RULE_WEIGHT * RULE_CONFIDENCE / RULE_WEIGHT
    return F.when(any_rule_matches(x, rules), F.lit(constant))


def blend(rule: Column, linear: Column) -> Column:
    """Rule score and feature score together; the feature score alone without a rule."""
    return F.when(
        rule.isNotNull(), RULE_SHARE * rule + (1 - RULE_SHARE) * linear
    ).otherwise(linear)


def is_neutral(n: Column, rules: Column) -> Column:
    return (n == 0) | (F.size(rules) == 0)


def model_score(x: Column, model: Column) -> Column:
    """Score of a vector under a ``model_state`` struct."""
    z = zscores(x, model["mean"], standard_deviations(model["m2"], model["n"]))
    blended = blend(rule_score(x, model["rules"]), feature_score(z, model["weights"]))
    return F.when(is_neutral(model["n"], model["rules"]), NEUTRAL_SCORE).otherwise(blended)


def says_bot(score: Column) -> Column:
    return score > MODEL_THRESHOLD


def score_confidence(score: Column) -> Column:
    """Distance from neutral, doubled; not clamped, so it may exceed 1."""
    return F.abs(score - 0.5) * 2


def model_votes(x: Column, models: Column) -> Column:
    """Per model, in the array's order: id, score, vote, confidence, accuracy so far."""
    scored = F.transform(
        models,
        lambda m: F.struct(
            m["model_id"].alias("model_id"),
            model_score(x, m).alias("score"),
            F.when(m["seen"] > 0, m["correct"] / m["seen"]).otherwise(0.0).alias("accuracy"),
        ),
    )
    return F.transform(
        scored,
        lambda s: F.struct(
            s["model_id"].alias("model_id"),
            s["score"].alias("score"),
            says_bot(s["score"]).alias("bot"),
            score_confidence(s["score"]).alias("confidence"),
            s["accuracy"].alias("accuracy"),
        ),
    )


def all_predictions(votes: Column) -> Column:
    return F.transform(votes, lambda v: v["bot"])


def bot_vote_count(votes: Column) -> Column:
    return F.size(F.filter(votes, lambda v: v["bot"]))


def majority(bot_votes: Column, human_votes: Column) -> Column:
    """A tie is human."""
    return bot_votes > human_votes


def mean_confidence(votes: Column) -> Column:
    """Mean over all models, those voting human included."""
    total = F.aggregate(votes, F.lit(0.0), lambda acc, v: acc + v["confidence"])
    return total / F.size(votes)


def weighted_vote(votes: Column) -> Column:
    """Struct of bot weight, human weight and total, weighted by model accuracy."""

    def weight_of(keep) -> Column:
        return F.aggregate(
            F.filter(votes, keep), F.lit(0.0), lambda acc, v: acc + v["accuracy"]
        )

    bot = weight_of(lambda v: v["bot"])
    human = weight_of(lambda v: ~v["bot"])
    return F.struct(bot.alias("bot"), human.alias("human"))


def detection(vote: Column, confidence: Column, threshold: float) -> Column:
    return vote & (confidence >= threshold)
