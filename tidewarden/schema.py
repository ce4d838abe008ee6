"""Schemas, feature order and detector options shared by every module."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# The feature vector's order (snake_case column -> wire name).
FEATURE_WIRE_NAMES = {
    "requests_per_second": "requestsPerSecond",
    "avg_response_time": "avgResponseTime",
    "unique_endpoints": "uniqueEndpoints",
    "click_rate": "clickRate",
    "scroll_depth": "scrollDepth",
    "session_duration": "sessionDuration",
    "page_views_per_session": "pageViewsPerSession",
    "error_rate": "errorRate",
    "time_between_requests": "timeBetweenRequests",
    "distinct_headers": "distinctHeaders",
    "javascript_enabled": "javascriptEnabled",
    "cookies_enabled": "cookiesEnabled",
    "screen_resolution": "screenResolution",
    "http_version": "httpVersion",
}
FEATURES = tuple(FEATURE_WIRE_NAMES)
N_FEATURES = len(FEATURES)

# Scoring and learning constants.
RULE_TOLERANCE = 0.1
RULE_CONFIDENCE = 0.8
RULE_WEIGHT = 1.0
RULE_SHARE = 0.7
MODEL_THRESHOLD = 0.7
NEUTRAL_SCORE = 0.5
LEARNING_RATE = 0.01
MAX_RULES = 100

_INT = T.IntegerType()
_DOUBLE = T.DoubleType()
_BOOL = T.BooleanType()
_STRING = T.StringType()

FEATURE_TYPES = {
    "requests_per_second": _INT,
    "avg_response_time": _DOUBLE,
    "unique_endpoints": _INT,
    "click_rate": _DOUBLE,
    "scroll_depth": _DOUBLE,
    "session_duration": _INT,
    "page_views_per_session": _DOUBLE,
    "error_rate": _INT,
    "time_between_requests": _DOUBLE,
    "distinct_headers": _INT,
    "javascript_enabled": _BOOL,
    "cookies_enabled": _BOOL,
    "screen_resolution": _INT,
    "http_version": _STRING,
}

# JSON record on the wire.
WIRE_SCHEMA = T.StructType(
    [
        T.StructField("sessionId", _STRING),
        T.StructField("timestamp", T.LongType()),
        T.StructField("ipAddress", _STRING),
        T.StructField("userAgent", _STRING),
        *[T.StructField(wire, FEATURE_TYPES[name]) for name, wire in FEATURE_WIRE_NAMES.items()],
        T.StructField("isBot", _BOOL),
        T.StructField("confidence", _DOUBLE),
        T.StructField("metadata", T.MapType(_STRING, _STRING)),
    ]
)

WIRE_TO_COLUMN = {
    "sessionId": "session_id",
    "timestamp": "ts",
    "ipAddress": "ip_address",
    "userAgent": "user_agent",
    **{wire: name for name, wire in FEATURE_WIRE_NAMES.items()},
    "isBot": "is_bot",
    "confidence": "confidence",
    "metadata": "metadata",
}

RULE_TYPE = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("thresholds", T.ArrayType(_DOUBLE)),
        T.StructField("outcome", _BOOL),
    ]
)

# One row per (shard, model). m2 is the sum of squared deviations, so rows merge.
MODEL_STATE_SCHEMA = T.StructType(
    [
        T.StructField("shard", _INT),
        T.StructField("model_id", _INT),
        T.StructField("version", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("mean", T.ArrayType(_DOUBLE)),
        T.StructField("m2", T.ArrayType(_DOUBLE)),
        T.StructField("weights", T.ArrayType(_DOUBLE)),
        T.StructField("rules", T.ArrayType(RULE_TYPE)),
        T.StructField("correct", T.LongType()),
        T.StructField("seen", T.LongType()),
    ]
)

DETECTION_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("shard", _INT),
        T.StructField("ts", T.TimestampType()),
        T.StructField("is_bot_pred", _BOOL),
        T.StructField("vote", _BOOL),
        T.StructField("confidence", _DOUBLE),
        T.StructField("bot_votes", _INT),
        T.StructField("human_votes", _INT),
        T.StructField("is_bot", _BOOL),
    ]
)

DRIFT_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("shard", _INT),
        T.StructField("instance_number", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("error_rate", _DOUBLE),
        T.StructField("type", _STRING),
    ]
)


@dataclass(frozen=True)
class DetectorOptions:
    """Settings of one detector; every shard runs one detector with these.

    ``threshold`` is clamped to [0, 1]. ``vote`` is ``majority`` (plain votes) or
    ``weighted`` (votes weighted by each model's accuracy so far).
    """

    n_models: int = 10
    threshold: float = 0.6
    update_frequency: int = 1000
    drift_enabled: bool = True
    drift_delta: float = 0.002
    warning_level: float = 0.05
    grace_period: int = 200
    split_confidence: float = 1e-4
    max_rules: int = MAX_RULES
    vote: str = "majority"
    seed: int = 7

    def __post_init__(self) -> None:
        object.__setattr__(self, "threshold", max(0.0, min(1.0, self.threshold)))
        if self.vote not in ("majority", "weighted"):
            raise ValueError(f"vote must be majority or weighted, not {self.vote!r}")

    def with_(self, **changes) -> "DetectorOptions":
        return replace(self, **changes)
