"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidewarden.plans import queries as plans
from tidewarden.schema import DetectorOptions
from tidewarden.session import build_session
from tidewarden.sources.codec import encode_events
from tidewarden.sources.streams import read_event_stream
from tidewarden.streaming.exact import exact_stream
from tidewarden.streaming.pipeline import decoded_stream, write_detections

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "g1_labelled_traffic",
    "g4_session_features",
    "a4_split_bad_records",
    "d1_feature_stats",
    "d10_precision_recall_f1",
    "e2_running_feature_stats",
    "e4_periodic_metrics",
    "e12_rolling_metrics",
    "f9_drift_cut_scan",
    "f7_detect_with_drift",
    "f7_detect_mixing",
)


def stream_replay(spark, folder: str) -> float:
    """Seconds for the whole table through decoding and exact detection as a stream."""
    root = tempfile.mkdtemp(prefix="bench-stream-")
    events = plans.events(spark, folder)
    encode_events(events).select("value").write.text(f"{root}/in")
    start = time.time()
    records = read_event_stream(spark, "text", f"{root}/in", maxFilesPerTrigger="4")
    good, _ = decoded_stream(records, shards=8)
    found = exact_stream(good, DetectorOptions())
    writer = write_detections(found, f"{root}/out", f"{root}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return time.time() - start


def main() -> None:
    spark = build_session(f"local[{CPUS}]", int(CPUS), "16g")
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.streaming.metricsEnabled", "false")
    rows = plans.read_table(spark, FOLDER, "events").count()
    plans.QUERIES["d12_prequential_accuracy"](spark, FOLDER).write.format("noop").mode(
        "overwrite"
    ).save()  # start the JVM's and Python's workers before timing
    seconds = {}
    for name in HEADLINE:
        start = time.time()
        plans.QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    seconds["stream_replay"] = round(stream_replay(spark, FOLDER), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": FOLDER.rstrip("/").split("sf")[-1],
                "events": rows,
                "events_per_second": {n: round(rows / s) for n, s in seconds.items()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
