"""Labelled test traffic drawn from the keys of a timed table, with the ranges of FIXTURES.md, section 5."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.functions.draws import shard_of, uniforms
from tidewarden.operators.augment import add_noise, noise_factor
from tidewarden.schema import FEATURE_TYPES, FEATURES

# User agents per class.
HUMAN_AGENTS = (
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/537.36",
    "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 14_0 like Mac OS X) AppleWebKit/605.1.15",
)
BOT_AGENTS = (
    "Mozilla/5.0 (compatible; Googlebot/2.1)",
    "Python-urllib/3.8",
    "curl/7.68.0",
    "Scrapy/2.5.0",
    "Bot/1.0",
)
PHASES = 3
DRAWS = 21
PHASE_STEP = 0.2


@dataclass(frozen=True)
class TrafficOptions:
    """``phase_seconds=None`` switches evolution off (always phase 0)."""

    bot_ratio: float = 0.3
    start: str = "2024-01-01 00:00:00"
    phase_seconds: int | None = 864_000
    shards: int = 8


def epoch(options: TrafficOptions) -> Column:
    """Index of the behaviour period an event falls in."""
    if options.phase_seconds is None:
        return F.lit(0).cast("bigint")
    start = F.lit(options.start).cast("timestamp")
    micros = F.unix_micros("ts") - F.unix_micros(start)
    return F.greatest(F.lit(0), F.floor(micros / (options.phase_seconds * 1_000_000)))


def phase(options: TrafficOptions) -> Column:
    return (epoch(options) % PHASES).cast("int")


def _pick(values: tuple[str, ...], u: Column) -> Column:
    index = F.floor(u * len(values)).cast("int") + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), index)


def _u(i: int) -> Column:
    return F.col("u")[i]


def _drawn_values(s: Column) -> dict[str, tuple[Column, Column]]:
    """(human, bot) value per feature before noise; ``s`` is the sophistication."""
    u = {i: _u(i) for i in range(1, 17)}
    floor = F.floor
    # The range of every feature, of humans and of bots.
    return {
        "requests_per_second": (floor(5 * u[1]) + 1, floor((10 + floor(40 * u[1])) * (1 - 0.5 * s))),
        "avg_response_time": (100 + 200 * u[2], 10 + 50 * u[2]),
        "unique_endpoints": (floor(10 * u[3]) + 3, floor(30 * u[3]) + 5),
        "click_rate": (0.6 + 0.35 * u[4], 0.1 + 0.5 * s),
        "scroll_depth": (0.4 + 0.5 * u[5], 0.4 * s),
        "session_duration": (60 + floor(600 * u[6]), 10 + floor(u[6] * (100 + floor(400 * s)))),
        "page_views_per_session": (3 + 7 * u[7], 10 + 40 * u[7]),
        "error_rate": (floor(3 * u[8]), floor(10 * u[8]) + 5),
        "time_between_requests": (1000 + 5000 * u[9], (50 + 200 * u[9]) * (1 + 2 * s)),
        "distinct_headers": (floor(5 * u[10]) + 10, floor(5 * u[10]) + 3),
        "javascript_enabled": (u[11] > 0.05, u[11] < s),
        "cookies_enabled": (u[12] > 0.1, u[12] < 0.8 * s),
        "screen_resolution": (1920 + floor(1000 * u[13]), 1024 + floor(500 * u[13])),
        "http_version": (F.when(u[14] > 0.3, "HTTP/2").otherwise("HTTP/1.1"), F.lit("HTTP/1.1")),
    }


def traffic_without_noise(
    keyed: DataFrame, options: TrafficOptions = TrafficOptions()
) -> DataFrame:
    draws = keyed.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        uniforms("event_id", DRAWS).alias("u"),
    ).withColumns({"phase": phase(options)})
    classed = draws.withColumns(
        {"is_bot": _u(0) < options.bot_ratio, "sophistication": F.col("phase") * PHASE_STEP}
    )
    bot = F.col("is_bot")
    values = _drawn_values(F.col("sophistication"))
    octets = [F.floor(_u(i) * 256).cast("string") for i in range(17, 21)]
    return classed.select(
        "event_id",
        shard_of("event_id", options.shards).alias("shard"),
        "ts",
        "phase",
        F.md5(F.col("event_id").cast("string")).alias("session_id"),
        F.concat_ws(".", *octets).alias("ip_address"),
        F.when(bot, _pick(BOT_AGENTS, _u(16)))
        .otherwise(_pick(HUMAN_AGENTS, _u(16)))
        .alias("user_agent"),
        *[
            F.when(bot, values[name][1])
            .otherwise(values[name][0])
            .cast(FEATURE_TYPES[name])
            .alias(name)
            for name in FEATURES
        ],
        "is_bot",
    )


def labelled_traffic(
    keyed: DataFrame, options: TrafficOptions = TrafficOptions()
) -> DataFrame:
    """Labelled events for every row of a table with ``event_id`` and ``ts``."""
    return add_noise(traffic_without_noise(keyed, options), noise_factor())
