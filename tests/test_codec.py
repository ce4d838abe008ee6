from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidewarden.sources import codec

GOOD = {"sessionId": "a", "timestamp": 1000, "requestsPerSecond": 3, "httpVersion": "HTTP/2",
        "isBot": True, "metadata": {"k": "v"}, "other": 1}


def decoded(spark, *texts):
    rows = [(i, t if t is None or isinstance(t, str) else json.dumps(t)) for i, t in enumerate(texts)]
    return codec.decode_events(spark.createDataFrame(rows, "id int, value string"))


def test_bad_records_are_kept_apart(spark):
    frame = decoded(
        spark, GOOD, "{bad", "null", None, {**GOOD, "errorRate": "zz"}, {**GOOD, "errorRate": 5.5},
        {"sessionId": "b"}, {**GOOD, "httpVersion": "http/2"},
    )
    good, rejected = codec.split_bad_records(frame)
    assert [r["id"] for r in good.orderBy("id").collect()] == [0, 7]
    reasons = {r["id"]: r["reason"] for r in rejected.collect()}
    assert reasons == {
        1: "unparsable", 2: "null_event", 3: "null_event", 4: "unparsable", 5: "unparsable",
        6: "missing_http_version",
    }
    assert codec.skip_null_events(frame).count() == 6


def test_defaults(spark):
    at = F.lit("2024-01-01").cast("timestamp")
    bare = {"sessionId": "b", "httpVersion": "HTTP/1.1"}
    row = codec.apply_defaults(decoded(spark, bare), at).first()
    assert row["requests_per_second"] == 0 and row["avg_response_time"] == 0.0
    assert row["is_bot"] is False and row["javascript_enabled"] is False
    assert row["metadata"] == {} and row["confidence"] == 0.0
    assert row["ts"].isoformat() == "2024-01-01T00:00:00"
    assert codec.labelled_only(decoded(spark, bare, GOOD)).count() == 1
    assert codec.apply_defaults(decoded(spark, bare)).first()["ts"] is not None


def test_text_is_parsed_once(spark):
    plan = codec.apply_defaults(decoded(spark, GOOD))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_encode_decode_round_trip(spark, traffic):
    back = codec.apply_defaults(codec.decode_events(codec.encode_events(traffic, "event_id")))
    columns = [c for c in traffic.columns if c in back.columns and c != "ts"]
    assert back.count() == 1000
    assert back.select(columns).exceptAll(traffic.select(columns)).isEmpty()
