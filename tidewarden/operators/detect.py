"""Detection of events against a fixed ``model_state``, with no learning.

``native`` joins each event with its shard's models and scores with column expressions.
``arrow`` broadcasts the models and scores Arrow batches with numpy, which is several
times faster once models hold many rules. ``auto`` takes ``arrow`` while the state is
small enough to broadcast and ``native``, which has no size limit, beyond that.

Events of a shard that has no models are scored by fresh ones: neutral, hence human.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewarden.functions import scoring
from tidewarden.functions.features import feature_value, with_features
from tidewarden.learning.detector import ensemble_votes
from tidewarden.learning.exact import FEATURE_COLUMNS
from tidewarden.learning.kernel import Model, frozen_scores, model_of_row
from tidewarden.operators.ensemble import fresh_models
from tidewarden.schema import (
    DETECTION_SCHEMA,
    FEATURES,
    MODEL_THRESHOLD,
    N_FEATURES,
    DetectorOptions,
)
from tidewarden.session import ship_package

BROADCAST_BYTES = 64 * 1024 * 1024
_ARROW_SCHEMA = T.StructType(
    DETECTION_SCHEMA.fields + [T.StructField("model_bots", T.ArrayType(T.BooleanType()))]
)


def models_by_shard(state: DataFrame) -> DataFrame:
    """One row per shard with its models as an array ordered by model id."""
    names = [c for c in state.columns if c not in ("shard", "version")]
    model = F.struct(*names)
    return state.groupBy("shard").agg(
        F.array_sort(
            F.collect_list(model), lambda a, b: a["model_id"] - b["model_id"]
        ).alias("models")
    )


def state_bytes(state: DataFrame) -> int:
    """Size of a state as raw doubles, counted in Spark."""
    per_model = (F.size("rules") + 4) * N_FEATURES * 8
    return state.agg(F.coalesce(F.sum(per_model), F.lit(0))).first()[0]


def vote_events(
    featured: DataFrame, state: DataFrame, broadcast: bool | None = None, n_models: int = 10
) -> DataFrame:
    """Add ``votes``: per model its score, vote and confidence, all inside the row.

    A shard without models is given ``n_models`` fresh ones.
    """
    models = models_by_shard(state)
    if broadcast is None:
        broadcast = state_bytes(state) <= BROADCAST_BYTES
    models = F.broadcast(models) if broadcast else models
    fresh = fresh_models(n_models, [f.name for f in models.schema["models"].dataType.elementType])
    own = F.coalesce(F.col("models"), fresh)
    return featured.join(models, "shard", "left").select(
        *featured.columns, scoring.model_votes(F.col("features"), own).alias("votes")
    )


def decide(voted: DataFrame, options: DetectorOptions) -> DataFrame:
    """Ensemble vote, confidence and thresholded detection from ``votes``."""
    votes = F.col("votes")
    bots = scoring.bot_vote_count(votes)
    counted = voted.withColumns(
        {"bot_votes": bots.cast("int"), "human_votes": (F.size(votes) - bots).cast("int")}
    )
    vote = scoring.majority(F.col("bot_votes"), F.col("human_votes"))
    confidence = scoring.mean_confidence(votes)
    if options.vote == "weighted":
        weight = scoring.weighted_vote(votes)
        total = weight["bot"] + weight["human"]
        vote = F.when(total > 0, weight["bot"] > weight["human"]).otherwise(vote)
        confidence = F.when(total > 0, weight["bot"] / total).otherwise(confidence)
    decided = counted.withColumns({"vote": vote, "confidence": confidence})
    return decided.withColumn(
        "is_bot_pred",
        scoring.detection(F.col("vote"), F.col("confidence"), options.threshold),
    )


def _detect_native(
    events: DataFrame, state: DataFrame, options: DetectorOptions, broadcast: bool, keep: tuple[str, ...]
) -> DataFrame:
    voted = vote_events(with_features(events, keep), state, broadcast, options.n_models)
    return decide(voted, options).select(
        *DETECTION_SCHEMA.fieldNames(),
        *keep,
        scoring.all_predictions(F.col("votes")).alias("model_bots"),
    )


def _detect_arrow(
    events: DataFrame, state: DataFrame, options: DetectorOptions, keep: tuple[str, ...]
) -> DataFrame:
    """Only for a state whose size :func:`detect` has checked."""
    spark = events.sparkSession
    ship_package(spark)
    by_shard: dict[int, list] = {}
    for row in sorted(state.collect(), key=lambda r: (r["shard"], r["model_id"])):
        by_shard.setdefault(row["shard"], []).append(model_of_row(row))
    shared = spark.sparkContext.broadcast(by_shard)
    schema = T.StructType(_ARROW_SCHEMA.fields + [events.schema[name] for name in keep])
    names = schema.fieldNames()
    fresh = [Model() for _ in range(options.n_models)]

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard, part in frame.groupby("shard", sort=False):
                models = shared.value.get(shard, fresh)
                x = part[FEATURE_COLUMNS].to_numpy(float)
                scores = np.stack([frozen_scores(m, x) for m in models], axis=1)
                accuracy = None
                if options.vote == "weighted":
                    accuracy = np.array([[m.correct / max(m.seen, 1) for m in models]])
                    accuracy = np.repeat(accuracy, len(part), axis=0)
                vote, confidence, bot_votes = ensemble_votes(scores, accuracy)
                yield part.assign(
                    is_bot_pred=vote & (confidence >= options.threshold),
                    vote=vote,
                    confidence=confidence,
                    bot_votes=bot_votes.astype(np.int32),
                    human_votes=(len(models) - bot_votes).astype(np.int32),
                    model_bots=list(scores > MODEL_THRESHOLD),
                )[names]

    flat = events.select(
        "event_id",
        "shard",
        "ts",
        "is_bot",
        *[feature_value(f).alias(c) for f, c in zip(FEATURES, FEATURE_COLUMNS)],
        *keep,
    )
    return flat.mapInPandas(score, schema)


def detect(
    events: DataFrame,
    state: DataFrame,
    options: DetectorOptions,
    engine: str = "auto",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Detections of all events, with the events' columns named in ``keep``; events are
    never shuffled while the state is small enough to broadcast."""
    fits = state_bytes(state) <= BROADCAST_BYTES
    if engine == "arrow" and not fits:
        raise ValueError("the state is too large to broadcast; use the native engine")
    if engine == "native" or not fits:
        return _detect_native(events, state, options, fits, keep)
    return _detect_arrow(events, state, options, keep)
