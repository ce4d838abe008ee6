"""URL verdicts, whitening and conversation repair against plain versions, on awkward rows too."""

from __future__ import annotations

import collections
import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewarden.llm import conversations, queries, urls, whitening

FOLDER = "/root/testdata/sf0.001"


# URLs

URLS = [
    "http://Example.NET/en/1", "https://a.example.net/en/", "https://a.example.net/en", "http://net/", "http://net", "http://x.net?q=/en/",
    "http://example.com/de/x", "http://notexample.com/de/x", "https://m.example.org/fr/1#top", "https://example.org/de/1", "http://a.org/fr", "no address",
    "", None, "://", ":///only/path", "a://b://c/d", "http://www.spam.example.com:80/a/b.html?utm_source=x&b=2&a=1#frag", "https://spam.example.com/a/b/?a=1&b=2",
    "https://m.spam.example.com/index.html", "http://spam.example.com", "http://spam.example.com/?ref=1", "http://ÄÖ.example.com/\nline", "http://user@h:80/p",
    "http://spam.example.com/" + "x" * 100_000,
]


def plain_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    end = re.search(r"[/?#]", rest)
    host = rest[: end.start()] if end else rest
    tail = rest[len(host):]
    path = re.split(r"[?#]", tail)[0]
    query = tail[len(path):].split("#")[0][1:] if tail[len(path):].startswith("?") else ""
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    short = re.sub(r":(80|443)$", "", re.sub(r"^(www|m)\.", "", host))
    kept = sorted(p for p in query.split("&") if not re.match(r"^(utm_[^=]*|ref|gclid|fbclid)?(=|$)", p))
    name = short + re.sub(r"/+$", "", re.sub(r"(/index)?\.html?$", "", path)) + ("?" + "&".join(kept) if kept else "")
    return host, path, name if short else None


def plain_verdict(url, rules, listed):
    host, path, name = plain_url(url)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fit:
        rule = max(fit, key=lambda r: (len(r.text), len(r.host), r.verdict == "block"))
        return host, path, rule.text, rule.verdict
    return host, path, None, "block" if name in listed else "allow"


@pytest.mark.parametrize("options", [urls.UrlOptions(), urls.UrlOptions(max_blocks=1)])
def test_verdicts_equal_the_plain_reading(spark, options):
    """With one block the filter passes nearly everything, and the exact join must decide."""
    rows = [(i, u, "x", "y", 1) for i, u in enumerate(URLS + ["http://spam.example.com"] * 50)] + [(None, "http://net/a", "x", "y", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, canonical string, block int")
    listed = {plain_url(u)[2] for u in URLS if u and "spam" in u} | {f"unseen{i}.example.com" for i in range(300)}
    given = spark.createDataFrame([(u,) for u in [*listed, *listed, None]], "canonical string")
    found = urls.judge(pages, queries.URL_RULES, given, options).collect()
    assert sorted(map(repr, found)) == sorted(
        repr(type(found[0])(page_id=i, host=v[0], path=v[1], rule=v[2], verdict=v[3])) for i, v in ((r[0], plain_verdict(r[1], queries.URL_RULES, listed)) for r in rows))
    assert {r["verdict"] for r in found} == {"allow", "block"}


def test_longest_rule_decides(spark):
    rules = [urls.Rule("block", "b.c"), urls.Rule("allow", "c", "/aa"), urls.Rule("block", "c", "/aa"), urls.Rule("allow", "a.b.c", "/x")]
    pages = spark.createDataFrame([(1, "s://a.b.c/x"), (2, "s://a.b.c/y"), (3, "s://c/aab"), (4, "s://c/a")], "page_id int, url string")
    nothing = spark.createDataFrame([], "canonical string")
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in urls.judge(pages, rules, nothing).collect()}
    assert found == {1: ("a.b.c/x", "allow"), 2: ("b.c", "block"), 3: ("c/aa", "block"), 4: (None, "allow")}
    assert urls.judge(pages.where("false"), rules, nothing).count() == 0
    assert {r["verdict"] for r in urls.judge(pages, [], nothing).collect()} == {"allow"}


def test_filter_misses_nothing_and_is_bounded(spark):
    keys = spark.range(5000).select(F.concat(F.lit("h.example.com/"), "id").alias("canonical"))
    blocks = urls.filter_blocks(5000, urls.UrlOptions())
    found = urls.bloom_filter(keys, blocks)
    assert found.count() <= blocks == 512 and urls.filter_blocks(10**9, urls.UrlOptions()) == 1 << 18
    bits = urls._bits(F.col("canonical"))

    def share(names):
        probed = names.withColumn("block", urls._block(F.col("canonical"), blocks)).join(found, "block")
        inside = [F.col(f"w{w}").bitwiseAND(b) == b for w, b in enumerate(bits)]
        return probed.where(inside[0] & inside[1] & inside[2] & inside[3]).count() / names.count()

    assert share(keys) == 1
    assert share(spark.range(5000, 25_000).select(F.concat(F.lit("h.example.com/"), "id").alias("canonical"))) < 0.01


# Whitening


def plain_whitening(vectors):
    x = np.floor(1024 * vectors) + 100_000
    n, centred = len(x), x - x.mean(axis=0)
    values, columns = np.linalg.eigh(centred.T @ centred / n)
    values, columns = values[::-1], columns[:, ::-1]
    whole = [[int(v) for v in row] for row in x]
    sums = [sum(c) for c in zip(*whole)]
    far = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in whole]
    return centred @ columns / np.sqrt(np.maximum(values, 1e-300)), values / values.sum(), far


@pytest.mark.parametrize("block_bytes", [16 << 20, 300 * 12 * 8])
def test_whitening_against_numpy(spark, block_bytes):
    draw = np.random.default_rng(5)
    vectors = (draw.standard_normal((1300, 12)) @ draw.standard_normal((12, 12))).astype(np.float32)
    vectors[1200:] = vectors[0]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    odd = [(2000, None, 0), (2001, [], 0), (2002, [None] + [1.0] * 11, 0), (2003, [float("inf")] * 12, 0), (2004, [float("nan")] * 12, 0), (2005, [1.0, 2.0], 0), (2006, [3e38] * 12, 0)]
    rows[7] = (None, rows[7][1], 0)
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, index int").withColumn("task", F.lit("t"))
    found = whitening.whiten(table.repartition(5), whitening.WhiteningOptions(block_bytes=block_bytes)).collect()
    plain, shares, far = plain_whitening(vectors.astype(float))
    assert len(found) == 1300 * 8 and {r["n"] for r in found} == {1300}
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-9
    signs = {}
    for r in found:
        at, c = (7 if r["vec_id"] is None else r["vec_id"]), r["component"] - 1
        assert r["deviation"] == far[at] and abs(r["explained"] / shares[c] - 1) < 1e-9
        signs.setdefault(c, []).append((r["whitened"], plain[at, c]))
    for pairs in signs.values():
        mine, theirs = np.array(pairs).T
        assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) < 1e-8


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], schema)).count() == 0
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 5.0]) for i in range(9)], schema)).collect()
    assert {r["component"] for r in line} == {1} and abs(sum(r["whitened"] ** 2 for r in line) / 9 - 1) < 1e-9


def test_deviation_beyond_a_long_is_null_and_large_ones_are_exact(spark):
    vectors = [[1e6, 0.0], [-1e6, 0.5], [3.0, 1e12], [3.0, -1e12]]
    found = whitening.whiten(spark.createDataFrame(list(enumerate(vectors)), "vec_id int, embedding array<double>")).collect()
    far = plain_whitening(np.array(vectors))[2]
    assert {(r["vec_id"], r["deviation"]) for r in found} == {(i, f if f < 1 << 63 else None) for i, f in enumerate(far)}
    assert None in {r["deviation"] for r in found}


# Conversations


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        hit = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        out += [(conv, turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return out


def plain_order(rows):
    mark = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).hexdigest()
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, mark(r)))


def plain_repair(rows):
    """Shortest path over (turns read, legal symbols so far), cheapest and then ASCII-least."""
    faults, seen = [], set()
    for _, _, role, text in rows:
        body = text.strip(conversations.BLANKS)
        faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    heap, done = [(0, "", 0, "")], set()
    while True:
        cost, audit, at, top = heapq.heappop(heap)
        if at == len(rows) and top in ("", "a"):
            break
        if (at, top) in done:
            continue
        done.add((at, top))
        for symbol in {"": "su", "s": "u", "u": "a", "a": "u"}[top]:
            if symbol != "s":
                heapq.heappush(heap, (cost + 3, audit + "I", at, symbol))
            if at < len(rows) and faults[at] in ("", "t"):
                extra = 3 if faults[at] else 0
                if rows[at][2][:1] == symbol:
                    heapq.heappush(heap, (cost + extra, audit + "K", at + 1, symbol))
                if symbol != "s":
                    heapq.heappush(heap, (cost + extra + 3, audit + "R", at + 1, symbol))
        if at < len(rows):
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, top))
    said, at = [], 0
    for edit in audit:
        top = said[-1][0][:1] if said else ""
        given = "assistant" if top == "u" else "user"
        if edit == "I":
            said.append((given, ""))
            continue
        if edit != "D":
            said.append((rows[at][2] if edit == "K" else given, rows[at][3]))
        at += 1
    initials = [r[2][:1] for r in rows]
    turns = [r[1] for r in rows if r[1] is not None]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        "blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), "cost": cost, "audit": audit,
    }, [f"{r}:{t}" for r, t in said]


def drawn_conversations(seed, count=120):
    draw = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "What now?", "cut off", "", " \t", None, "naïve 漢字.", "Ends. \n"]
    rows = []
    for conv in range(count):
        rows += [(conv, draw.choice([k, k, k, 2, None]), draw.choice(roles), draw.choice(texts) if draw.random() < 0.4 else f"Text {draw.randint(0, 99)}.") for k in range(draw.randint(1, 14))]
    rows += [(None, k, "user" if k % 2 else "assistant", f"null {k}.") for k in range(5)]
    rows += [(900, k, ("user", "assistant")[k % 2], f"Said {k % 7}." + "x" * (100_000 if k == 3 else 0) + "!") for k in range(60)]
    return rows


CONV = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("options", [conversations.RepairOptions(), conversations.RepairOptions(chunk_turns=3, piece_rows=2)])
def test_repair_is_the_cheapest(spark, options):
    rows = drawn_conversations(3)
    table = spark.createDataFrame(rows, CONV).withColumn("chunk", F.lit("c")).withColumn("mark", F.lit(1)).withColumn("kind", F.lit(1))
    found = conversations.repair(table, options)
    said = collections.defaultdict(list)
    for r in sorted(found.rows.collect(), key=lambda r: (r["chunk"], r["at"])):
        if r["edit"] != "D":
            said[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    digests = {r["conv_id"]: r["repaired_sha256"] for r in conversations.digests(found.rows).collect()}
    summary = {r["conv_id"]: r.asDict() for r in found.summary.collect()}
    groups = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((conv, turn, " " if role is None else role, " " if text is None else text))
    assert set(summary) == set(groups)
    for conv, own in groups.items():
        counts, lines = plain_repair(plain_order(own))
        assert summary[conv] == counts | {"conv_id": conv}, own
        assert said[conv] == lines and digests[conv] == hashlib.sha256("\n".join(lines).encode()).hexdigest()
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))


def test_damage_and_query_over_odd_rows(spark, tmp_path):
    rows = drawn_conversations(8, 40) + [(7777, 1, "user", "A."), (7777, 1, "user", "A.")]
    found = conversations.damage(spark.createDataFrame(rows, CONV).withColumn("copy", F.lit(1))).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, plain_damage(rows)))
    spark.createDataFrame(rows, CONV).write.parquet(f"{tmp_path}/conversations.parquet")
    whole = {r["conv_id"]: r.asDict() for r in queries.op13_generalised_lr_repair(spark, str(tmp_path)).collect()}
    groups = collections.defaultdict(list)
    for r in plain_damage(rows):
        groups[r[0]].append(r)
    assert set(whole) == {r[0] for r in rows}
    for conv, row in whole.items():
        counts, lines = plain_repair(plain_order(groups[conv]))
        assert row == counts | {"conv_id": conv, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def test_repair_nothing(spark):
    found = conversations.repair(spark.createDataFrame([], CONV))
    assert found.rows.count() == 0 and found.summary.count() == 0 and conversations.digests(found.rows).count() == 0
