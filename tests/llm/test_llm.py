"""The training-data operators on small and awkward inputs, against brute force."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import time
import tracemalloc
import types
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewarden.llm import components, decontaminate, embedding, jaccard, language, lm, packing, pii, substrings, toxicity, warc
from tidewarden.llm.common import remainder

FOLDER = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
#: null, empty and blank texts, no letters, one word, a long text, repeated rows, odd characters
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "12 34 ... !!"), (5, "word"), (6, LONG), (6, LONG), (7, "naïve 漢字     text 🙂 end"),
       (8, "one  two\n\nthree \r\n four"), (None, "no id here"), (None, None), (9, "a b c"), (10, "a b c"), (11, "A B C")]
SCHEMA = "doc_id long, text string, lang string, tell string, marks string, id string, part string, route string, n long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Awkward rows with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, None, "x", "y", "z", "p", "r", 5) for i, t in ODD], SCHEMA)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


def letters(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_components(spark):
    edges = [(1, 2), (3, 2), (9, 8), (5, 5), (None, 4)] + [(100, 100 + k) for k in range(1, 50)] + [(149, 7)]
    found = {r["id"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found[3] == 1 and found[9] == 8 and found[120] == 7 and 5 not in found
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_packing_places_every_id(spark, odd, docs):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path("byte_bpe_50k.json"))
    for table in (odd, docs):
        rows = packing.pack(packing.cut(table)).collect()
        by_id = collections.defaultdict(list)
        for r in rows:
            by_id[r["id"]].append(r)
        for i, text in {(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect() if r["doc_id"] not in (None, 6)}:
            ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
            assert b"".join(r["ids"] for r in sorted(by_id[i], key=lambda r: r["piece"])) == ids
        room = collections.defaultdict(list)
        for r in rows:
            room[r["sequence_id"]].append((r["offset"], r["length"]))
        for places in room.values():
            places.sort()
            assert places[0][0] == 0 and sum(n for _, n in places) <= 2048
            assert all(a + n == b for (a, n), (b, _) in itertools.pairwise(places))
        assert len(room) <= math.ceil(sum(r["length"] for r in rows) / 2048) + 1


def test_added_tokens_get_their_own_ids(spark):
    """A text that spells an added token is encoded as the named tokenizer does it."""
    from public_tokenizers import path
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path("byte_bpe_50k.json"))
    token = next(iter(whole.get_added_tokens_decoder().values())).content
    texts = [f"a {token} b", token, f"{token}{token}", f"  {token}\n\n", f"x{token[:-1]}", f"naïve {token} 漢字"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in packing.cut(table).collect():
        assert r["ids"] == np.array(whole.encode(texts[r["id"]], add_special_tokens=False).ids + [0], "<u4").tobytes()


def test_fullest_combination_is_the_best():
    draw = random.Random(1)
    for _ in range(200):
        items = [draw.randint(1, 20) for _ in range(draw.randint(1, 8))]
        counts, room = collections.Counter(items), draw.randint(1, 60)
        best = max(sum(c) for k in range(len(items) + 1) for c in itertools.combinations(items, k) if sum(c) <= room)
        taken = packing.fullest(counts, sorted(counts, reverse=True), room)
        assert sum(a * n for a, n in taken) == best and all(n <= counts[a] for a, n in taken)


def test_packing_nothing(empty):
    assert packing.pack(packing.cut(empty)).count() == 0


def vectors_of(spark):
    draw = np.random.default_rng(2)
    base = draw.standard_normal((30, 16))
    rows = [(i, (base[i % 30] + 0.12 * draw.standard_normal(16)).tolist(), int(i % 3)) for i in range(150)]
    rows += [(500 + i, base[0].tolist(), 0) for i in range(40)]
    rows += [(600, None, 0), (601, [], 0), (602, [0.0] * 16, 0), (603, [None, 1.0], 0), (604, [float("nan")] * 16, 0), (605, base[0].tolist(), None),
             (606, base[0][:8].tolist(), 0), (None, base[0].tolist(), 0)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("rep", F.lit(1)).withColumn("raw", F.lit(2))


@pytest.mark.parametrize("bucket", [8192, 8])
def test_vectors_against_all_pairs(spark, bucket):
    rows, table = vectors_of(spark)
    found = {r["vec_id"]: r for r in embedding.near_duplicates(table, embedding.VectorOptions(bucket=bucket, block=32)).collect()}
    assert len(found) == len(rows)
    good = [(i, np.array(v), k) for i, v, k in rows if i is not None and k is not None and v and None not in v and 0 < np.linalg.norm(v) < np.inf]
    linked = collections.defaultdict(set)
    for (i, v, k), (j, w, m) in itertools.combinations(good, 2):
        if k == m and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93:
            linked[i].add(j)
            linked[j].add(i)
    for i in found:
        if i is not None:
            seen, todo = {i}, [i]
            while todo:
                new = linked[todo.pop()] - seen
                seen |= new
                todo += new
            assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (len(linked[i]), min(seen), min(seen) == i)
    assert embedding.near_duplicates(table.where("false")).count() == 0


def test_code_bound_never_under_the_truth():
    draw = np.random.default_rng(3)
    a = draw.standard_normal((300, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    rotated, code, factor = embedding.codes(a, embedding.rotation(64, 0, embedding.VectorOptions()))
    assert (embedding.upper_bounds(code, factor, rotated, 6.0) >= a @ a.T).all()


def test_substrings_against_brute_force(spark, docs, odd, empty):
    draw = random.Random(4)
    passage = [f"p{k}" for k in range(45)]
    texts = []
    for i in range(60):
        own = [f"q{draw.randint(0, 400)}" for _ in range(draw.randint(0, 60))]
        cut = draw.randint(0, 20)
        texts.append((i, " ".join(own[:20] + passage[cut : cut + draw.randint(5, 40)] + own[20:] + (["same"] * 70 if i % 7 == 0 else []))))
    made = spark.createDataFrame(texts, "doc_id long, text string")
    for table in (made, docs.select("doc_id", "text"), odd.where("doc_id is not null")):
        want = substrings.brute_force([tuple(r) for r in table.select("doc_id", "text").collect()], 20)
        rows = substrings.remove_repeats(table, substrings.SubstringOptions(flush=500)).withColumn("h", F.sha2("kept", 256)).collect()
        assert len(rows) == table.count()
        for r in rows:
            assert (r["n_words"], r["n_removed"], r["h"]) == want[r["doc_id"]]
            assert sum(f["words"] for f in r["factors"]) == r["n_removed"]
    assert substrings.remove_repeats(odd).where("doc_id is null").count() == 2
    assert substrings.remove_repeats(empty).count() == 0


def test_substrings_of_repeated_rows(spark):
    """Copies of a row are one document; texts of one id are told apart; cost follows the number of copies."""
    draw = random.Random(8)
    made = lambda n: " ".join(f"w{draw.randint(0, 300)}" for _ in range(n))
    first, second, third = made(500), made(500), made(60)
    mixed = " ".join(second.split()[100:140] + third.split() + first.split()[200:260])
    rows = [(1, first), (3, mixed), (None, third), (None, third), (None, second)]

    def run(copies: int) -> tuple[float, list]:
        copied = spark.range(copies).select(F.lit(2).cast("long").alias("doc_id"), F.lit(first + " " + second).alias("text"))
        table = spark.createDataFrame(rows, "doc_id long, text string").union(copied).repartition(8)
        begin = time.monotonic()
        out = substrings.remove_repeats(table, substrings.SubstringOptions(flush=20_000)).drop("factors").collect()
        return time.monotonic() - begin, out

    want = substrings.brute_force([(1, first), (2, first + " " + second), (3, mixed)], 20)
    few, _ = run(200)
    many, found = run(2000)
    assert many < 10 * few + 5
    assert len(found) == 2005
    for r in found:
        if r["doc_id"] is not None:
            assert (r["n_words"], r["n_removed"], hashlib.sha256(r["kept"].encode()).hexdigest()) == want[r["doc_id"]]
        else:  # all words stand earlier, under 2 and 3
            assert r["n_removed"] == r["n_words"]


@pytest.mark.parametrize("options", [jaccard.JaccardOptions(), jaccard.JaccardOptions(hot=4, block=8, leaf=4, shingle=3, at_least=80)])
def test_jaccard_against_all_pairs(spark, docs, odd, empty, options):
    draw = random.Random(5)
    base = [f"v{draw.randint(0, 900)}" for _ in range(200)]
    near = []
    for i in range(40):
        text = list(base)
        for _ in range(draw.randint(0, 9)):
            text[draw.randrange(len(text))] = f"z{i}"
        near.append((1000 + i, " ".join(text)))
    table = docs.select("doc_id", "text").union(odd.select("doc_id", "text").where("doc_id is not null")).union(spark.createDataFrame(near, "doc_id long, text string"))
    table = table.groupBy("doc_id").agg(F.max("text").alias("text")).withColumn("low", F.lit(1)).withColumn("key", F.lit(1))
    k, sets = options.shingle, {}
    for r in table.collect():
        w = words(letters(r["text"]))
        sets[r["doc_id"]] = {tuple(w[s : s + k]) for s in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for a, b in itertools.combinations(sorted(sets), 2):
        n = len(sets[a] & sets[b])
        if n and options.of * n >= options.at_least * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    for r in jaccard.similar_documents(table, options).collect():
        assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), root(r["doc_id"]))
    assert jaccard.similar_documents(odd).where("doc_id is null and component_id is null").count() == 2
    assert jaccard.similar_documents(empty).count() == 0


def test_sets_of_a_template_are_compared_in_bulk():
    """A block of sets that share most of their shingles, few of which link."""
    draw = np.random.default_rng(5)
    common = draw.integers(0, 2**62, 240).astype(np.uint64)
    sets = [np.unique(np.concatenate([common, draw.integers(0, 2**62, 60).astype(np.uint64)])) for _ in range(512)]
    for k in range(0, 512, 64):
        sets[k + 1] = np.unique(np.concatenate([sets[k][:-10], draw.integers(0, 2**62, 10).astype(np.uint64)]))
    sets[400] = sets[401] = sets[3][:-2]
    options = jaccard.JaccardOptions()
    begin = time.process_time()
    got = embedding.roots(len(sets), *jaccard.verify(sets, np.zeros(512, np.int64), options))
    assert time.process_time() - begin < 4
    pairs = [(i, j) for i in range(512) for j in range(i) if 100 * (n := len(np.intersect1d(sets[i], sets[j], True))) >= 85 * (len(sets[i]) + len(sets[j]) - n)]
    want = embedding.roots(512, np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    assert (got == want).all() and 9 <= len(pairs) < 100
    side = np.arange(512) % 2
    across = [p for p in pairs if side[p[0]] != side[p[1]]]
    got = embedding.roots(512, *jaccard.verify(sets, side, options))
    want = embedding.roots(512, np.array([p[0] for p in across]), np.array([p[1] for p in across]))
    assert (got == want).all()


def test_jaccard_of_a_text_that_many_share(spark):
    """Texts of a shared part and 19 % of their own, beside a group of 320 copies and near copies of it, each meet the group."""
    draw = random.Random(10)
    base = [f"b{draw.randint(0, 10**6)}" for _ in range(120)]
    rows = []
    for i in range(320):
        text = list(base)
        text[i % 120] = f"c{i}" if i else text[0]
        rows.append((i, " ".join(text)))
    rows += [(1000 + i, " ".join([*base, *(f"own{i}x{j}" for j in range(28))])) for i in range(200)]
    options = jaccard.JaccardOptions(at_least=80)
    found = jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), options).collect()
    assert len(found) == 520 and {r["component_id"] for r in found} == {0}


def test_language(spark, docs, odd, empty):
    held_out = remainder(5) == 0
    model = language.learn(docs.where(~held_out))
    found = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(held_out).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.95 * len(found)
    rows = language.identify(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3, 4)} == {"und"}
    nothing = language.learn(empty)
    assert {r["lang_pred"] for r in language.identify(odd, nothing).collect()} == {"und"}
    kept = language.keep_identified(odd, model)
    assert kept.columns == odd.columns and {r["doc_id"] for r in kept.collect()} & {1, 2, 3, 4} == set()
    both = spark.createDataFrame([(1, docs.where("lang = 'en'").first()["text"] + " " + docs.where("lang = 'de'").first()["text"])], "doc_id long, text string")
    assert {"en", "de"} <= set(language.identify(both, model).first()["languages"])


def test_personal_data(spark, docs, odd, empty):
    model = pii.train(docs)
    text = "Mail ann.b-1@mail.example.com or 10.0.0.255, 10.0.0.256; card 4111 1111 1111 1111, call +1 (415) 555-0123. ann[at]mail.example.com"
    base, added = pii.find_spans(text, model)
    assert [(pii.KINDS[k], text[s:e]) for k, s, e in base] == [
        ("email", "ann.b-1@mail.example.com"), ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (415) 555-0123")]
    assert [(pii.KINDS[k], text[s:e]) for k, s, e in added] == [("email", "ann[at]mail.example.com")]
    rows = pii.personal_data(odd, model).collect()
    assert len(rows) == len(ODD) and not any(r["base"] or r["added"] for r in rows)
    clean = pii.redact(spark.createDataFrame([(1, text, 3), (2, None, 4)], "doc_id long, text string, start int"), model).orderBy("doc_id").collect()
    assert "@" not in clean[0]["text"] and "[CARD]" in clean[0]["text"] and clean[1]["text"] is None
    assert pii.train(empty).weights == {} and pii.personal_data(empty, model).count() == 0
    for r in docs.collect():  # the base equals the patterns as they are written down
        t = r["text"] or ""
        want = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        assert [(pii.KINDS[k], s, e) for k, s, e in pii.base_spans(t) if k == 0] == want


def test_leaks(spark, odd, empty):
    draw = random.Random(6)
    item = " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 8))) for _ in range(40))
    edited = list(item)
    for at in range(5, len(edited), 30):
        edited[at] = "Q"
    other = "".join(draw.choice("abcdefghij ") for _ in range(4000))
    rows = [(1, other), (2, other + item + other), (3, "é" * 50 + item.upper().replace(" ", "\n ") + other), (4, other[:999] + "".join(edited)),
            (5, item[:60] + other), (6, None), (7, other + item[20:220])]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit(3)).withColumn("edits", F.lit(3))
    bench = spark.createDataFrame([(7, item), (8, None), (9, "short"), (7, item)], "item_id long, text string").withColumn("doc_id", F.lit(1))
    found = decontaminate.leaks(table, bench).collect()
    assert {r["doc_id"] for r in found} == {2, 3, 4, 7}
    texts = dict(rows)
    for r in found:
        part = re.sub(r"\s+", " ", texts[r["doc_id"]][r["start"] : r["end"]].lower())
        want = item[r["item_start"] : r["item_start"] + 120]
        assert r["edits"] <= 8 and (r["edits"] > 0 or part == want)
    assert {r["doc_id"] for r in decontaminate.drop_leaked(table, bench).collect()} == {1, 5, 6}
    several = decontaminate.leaks(table, bench, decontaminate.LeakOptions(block_bytes=100))
    assert several.count() == len(found)
    assert decontaminate.leaks(table, bench.where("false")).count() == 0
    assert decontaminate.leaks(odd, bench).count() == 0 and decontaminate.drop_leaked(empty, bench).count() == 0


def test_leaks_at_any_offset():
    draw = random.Random(11)
    item = "".join(draw.choice("abcdefghij") for _ in range(390))
    other = "".join(draw.choice("klmnopqrst ") for _ in range(500))
    edited = lambda part: part[:40] + "Z" + part[41:80] + part[81:]
    texts = [other + item[at : at + 120] + other for at in range(271)] + [other + edited(item[at : at + 122]) + other for at in range(0, 268, 7)]
    texts += [other + item[at : at + 70] + other for at in range(0, 320, 40)]
    index = decontaminate.build_index([0], [item], decontaminate.LeakOptions())
    found = collections.defaultdict(list)
    for t, _, w, start, end, edits in decontaminate.find_leaks(pa.array(texts), index, decontaminate.LeakOptions()):
        assert edits == min(distance(item[w : w + 120], texts[t][start : end]), edits) and edits <= 8
        found[t].append(w)
    assert set(found) == set(range(len(texts) - 8))
    short = ["yes", "what is red?", "name the ninth planet", ""]
    index = decontaminate.build_index(short, short, decontaminate.LeakOptions())
    texts = ["oh Yes, no", "yesterday eyes", "say: What  is red? ", "x name the nineth planet", "name a planet", None, ""]
    rows = {(t, i, texts[t][s:e], k) for t, i, _, s, e, k in decontaminate.find_leaks(pa.array(texts), index, decontaminate.LeakOptions())}
    assert rows == {(0, 0, "Yes", 0), (2, 1, "What  is red?", 0), (3, 2, "name the nineth planet", 1)}


def test_leaks_against_all_windows():
    """A text leaks an item if any window of the item is somewhere in it with at most k edits."""
    draw = random.Random(23)
    options = decontaminate.LeakOptions(window=40, q=8, bytes_per_edit=20, least=20)
    items = ["".join(draw.choice("abcd ") for _ in range(90)).strip() + "." for _ in range(6)]
    index = decontaminate.build_index(list(range(6)), items, options)

    def spoilt(text: str, n: int) -> str:
        out = list(text)
        for _ in range(n):
            at = draw.randrange(len(out))
            out[at : at + draw.randint(0, 1)] = draw.choice(["", "x", "yz"])
        return "".join(out)

    texts = []
    for _ in range(120):
        item = draw.choice(items)
        begin = draw.randint(0, 45)
        part = spoilt(item[begin : begin + draw.randint(35, 60)], draw.randint(0, 5))
        texts.append("".join(draw.choice("efgh ") for _ in range(30)) + part + "".join(draw.choice("efgh ") for _ in range(30)))

    def leaks(text: bytes, item: bytes) -> bool:
        windows = np.array([list(item[w : w + 40]) for w in range(len(item) - 39)])
        cost = np.zeros((len(windows), len(text) + 1), np.int64)
        steps = np.arange(len(text) + 1)
        letters_ = np.frombuffer(text, np.uint8)
        for i in range(40):
            new = cost + 1
            new[:, 1:] = np.minimum(new[:, 1:], cost[:, :-1] + (letters_ != windows[:, i, None]))
            cost = np.minimum.accumulate(new - steps, axis=1) + steps
        return bool((cost.min(axis=1) <= 2).any())

    found = {(t, i) for t, i, *_ in decontaminate.find_leaks(pa.array(texts), index, options)}
    plain = [re.sub(r"\s+", " ", t.lower()).encode() for t in texts]
    want = {(t, i) for t in range(len(texts)) for i in range(6) if leaks(plain[t], index.texts[i])}
    assert found == want and 20 < len(want) < 110


def test_leaks_of_a_template():
    """A phrase that all items and texts have is no leak, and costs no alignment."""
    draw = random.Random(29)
    made = lambda n: " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 8))) for _ in range(n))
    phrase = "which of the following statements about "
    items = [phrase + made(40) for _ in range(500)]
    texts = [made(30) + " " + phrase + made(40) for _ in range(500)]
    for t in range(0, 500, 50):
        texts[t] += items[t][30:160]
    index = decontaminate.build_index(list(range(500)), items, decontaminate.LeakOptions())
    begin = time.process_time()
    found = {(t, i) for t, i, *_ in decontaminate.find_leaks(pa.array(texts), index, decontaminate.LeakOptions())}
    assert time.process_time() - begin < 10
    assert found == {(t, t) for t in range(0, 500, 50)}


def test_alignment_is_the_edit_distance():
    draw = random.Random(7)
    for _ in range(100):
        window = bytes(draw.choice(b"abc") for _ in range(draw.randint(5, 15)))
        region = bytes(draw.choice(b"abc") for _ in range(draw.randint(5, 25)))
        best = min(distance(window, region[s:e]) for s in range(len(region) + 1) for e in range(s, len(region) + 1))
        found = decontaminate.align(window, region, -len(window), len(region) + len(window) + 1, 99)
        assert found[0] == best == distance(window, region[found[1] : found[2]])


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_word_counts_and_code_lengths(spark, docs, odd, empty):
    for table in (docs, odd.where("doc_id is not null")):
        rows = [(r["doc_id"], r["text"]) for r in table.collect()]
        out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
        counts = collections.Counter(w for i, t in rows if not out(i) for w in [*words(letters(t)), "\n"])
        total, kinds = sum(counts.values()), len(counts)
        found = lm.score(table, remainder(7) == 2, lm.LmOptions(batch_bytes=50_000)).collect()
        assert len(found) == len(rows)
        by_id = {r["doc_id"]: r for r in found}
        for i, t in rows:
            tokens = [*words(letters(t)), "\n"]
            base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens)
            r = by_id[i]
            assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(tokens), sum(counts[w] > 0 for w in tokens), total, out(i))
            assert abs(r["base_score"] - base) < 1e-6 * max(1, abs(base)) and r["score"] <= 0
    long = [r for r in lm.score(docs, remainder(7) == 2).where("held_out and n_tokens > 50").collect()]
    assert sum(r["bits_per_byte"] for r in long) / len(long) < 4
    assert lm.score(odd, F.lit(True)).where("train_tokens = 0").count() == len(ODD) and lm.score(empty, F.lit(False)).count() == 0


def test_trie_lengths_are_probabilities():
    data = b"abracadabra banana bandana"
    codes3, codes4 = collections.Counter(), collections.Counter()
    padded = b"\0\0\0" + data
    for k in range(len(data)):
        codes4[int.from_bytes(padded[k : k + 4], "big")] += 1
        codes3[int.from_bytes(padded[k + 1 : k + 4], "big")] += 1
    split = lambda c: (np.array(sorted(c)), np.array([c[x] for x in sorted(c)]))
    trie = lm.lay_out(*split(codes3), *split(codes4))
    assert ((2.0 ** -trie.three.astype(float)).sum(axis=1) <= 1.0001).all() and ((2.0 ** -trie.two.reshape(-1, 256).astype(float)).sum(axis=1) <= 1.0001).all()
    # after "ban" came "a" and "d" once each: two followers, four parts, half of them the escape
    assert abs(lm.code_lengths(pa.array(["xban" + "a"]), trie)[0] - lm.code_lengths(pa.array(["xban"]), trie)[0] - 2.0) < 1e-5


def test_every_learned_context_counts(spark):
    """More three-byte contexts than 32,768: scores equal those of the whole trie laid out in memory."""
    draw = random.Random(12)
    texts = ["".join(chr(draw.randrange(0x4E00, 0x9FA0)) for _ in range(1500)) for _ in range(24)]
    codes3, codes4 = collections.Counter(), collections.Counter()
    for text in texts[:16]:
        padded = b"\0\0\0" + text.encode()
        codes4.update(int.from_bytes(padded[k : k + 4], "big") for k in range(len(padded) - 3))
    for code, n in codes4.items():
        codes3[code & 0xFFFFFF] += n
    assert len({code >> 8 for code in codes4}) > 1 << 15
    split = lambda c: (np.array(sorted(c)), np.array([c[x] for x in sorted(c)]))
    want = lm.code_lengths(pa.array(texts), lm.lay_out(*split(codes3), *split(codes4)))
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in lm.score(table, F.col("doc_id") >= 16, lm.LmOptions(batch_bytes=30_000)).collect():
        assert abs(r["score"] / -math.log10(2) - want[r["doc_id"]]) < 1e-4 * want[r["doc_id"]]


def asks(texts):
    """What a task of the vocabulary reads: one batch of texts, of which every seventh teaches nothing."""
    return pa.RecordBatch.from_arrays([pa.array([3] * len(texts), pa.int32()), pa.array(texts), pa.array([i % 7 != 2 for i in range(len(texts))])], names=["batch", "text", "teaches"])


def test_arrays_of_a_task_stay_small_beside_its_text():
    """A batch of 8 MB in one piece: what is built to find its words and strings is a few bytes for each of a slice, not of the batch."""
    draw = random.Random(5)
    vocabulary = ["".join(draw.choices("etaoinshrdlu", k=draw.randint(2, 9))) for _ in range(4000)]
    batch = asks([" ".join(draw.choices(vocabulary, k=2000)) for _ in range(600)])
    assert batch.nbytes > 7 << 20
    tracemalloc.start()
    try:
        n = sum(len(found) for found in lm._vocabulary(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n > 4000 and peak < 60 << 20


def test_language_model_steps_in_parts(monkeypatch):
    """Asking when much is held, and lengths of some shares at a time, give the same sums and lengths."""
    draw = random.Random(8)
    texts = [None, "", *(" ".join("".join(draw.choices("abcdeé", k=3)) for _ in range(80)) for _ in range(60))]
    batch = asks(texts)
    want = collections.Counter()
    for i, text in enumerate(texts):
        padded = b"\0\0\0" + (text or "").encode()
        for k in range(len(padded) - 3):
            want[int.from_bytes(padded[k : k + 4], "big")] += i % 7 != 2
    c2 = np.zeros((256, 256))
    for code, n in want.items():
        c2[code >> 8 & 255, code & 255] += n
    codes = np.array(sorted(want))
    whole = dict(zip(codes.tolist(), lm.lengths(codes, np.array([want[c] for c in codes]), c2)))
    for held, shared, piece in ((1 << 22, 1 << 16, 1 << 19), (500, 20, 2000)):
        for name, value in (("HELD", held), ("SHARED", shared), ("SLICE", piece)):
            monkeypatch.setattr(lm, name, value)
        found, asked = collections.Counter(), 0
        for part in lm._vocabulary(iter([batch])):
            assert set(part["batch"].to_pylist()) == {3}
            for kind, word, n in zip(*(part[name].to_pylist() for name in ("kind", "word", "n"))):
                found[word] += n if kind else 0
                asked += kind
        assert {c: found[c] for c in want} == dict(want) and (asked > len(want)) == (held == 500)
        rows = sorted((c >> 8 & 0xFFFF, c, n) for c, n in want.items())
        parts = [pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows[k : k + 50])], names=["share", "word", "n"]) for k in range(0, len(rows), 50)]
        out = [*lm._lengths(types.SimpleNamespace(value=c2))(iter(parts))]
        assert (len(out) > 1) == (shared == 20)
        got = {w: x for part in out for w, x in zip(part["word"].to_pylist(), part["n"].to_pylist())}
        assert got.keys() == whole.keys() and all(abs(got[w] - whole[w]) < 1e-9 for w in whole)


def test_copies_of_one_row_are_not_loaded_together(spark):
    """Copies of one id and text go to one task; they are scored as they come, so no group of rows is held for them."""
    texts = [(1, "the same words again")] * 400 + [(None, None), (2, "other words"), (None, "the same words again")]
    table = spark.createDataFrame(texts, "doc_id long, text string")
    found = lm.score(table, F.col("doc_id") == 2, lm.LmOptions(batch_bytes=1000))
    assert "CoGroups" not in found._jdf.queryExecution().toString()
    rows = found.collect()
    assert len(rows) == len(texts) and len({round(r["score"], 9) for r in rows if r["doc_id"] == 1}) == 1
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in rows} == {(1, 5, 5, 2000), (2, 3, 2, 2000), (None, 1, 1, 2000), (None, 5, 5, 2000)}


def test_texts_that_begin_alike_are_dealt_apart(spark):
    """Without ids, texts that share a long beginning still go to many tasks."""
    texts = [(None, "the same long beginning of every text, a template of a site " * 3 + f"and then {i}") for i in range(60)]
    found = lm.score(spark.createDataFrame(texts, "doc_id long, text string"), F.lit(False), lm.LmOptions(batch_bytes=1000))
    assert found.count() == 60 and found.select(F.spark_partition_id()).distinct().count() > 3


def test_archive_audit(spark):
    rows = [(i, f"http://x/{i}", f"<p>{i}</p>\r\n\r\nWARC/1.0\r\n" * (i % 5)) for i in range(300)] + [(400, None, None), (None, "u", "h"), (401, "a\r\nb", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("segment", F.lit(1)).withColumn("value", F.lit("v"))
    options = warc.ArchiveOptions(file_bytes=4000, fanout=4)
    from tidewarden.session import scratch_path

    n, ours, theirs = warc.segments_of(pages, options), scratch_path(spark, "t"), scratch_path(spark, "t")
    assert n > 3
    warc.write_archive(pages, ours, n)
    hurt = pages.where("page_id is null or page_id <> 17").withColumn("html", F.when(F.col("page_id") == 23, "y" * 8).otherwise(F.col("html")))
    hurt = hurt.union(pages.where("page_id = 5").withColumn("page_id", F.lit(999).cast("long")))
    warc.write_archive(hurt, theirs, n)
    a, b = warc.tree(spark, ours, options), warc.tree(spark, theirs, options)
    assert a.where("level = 0").count() == len(rows)
    found = {(r["record_id"], r["status"]) for r in warc.audit(a, b, options).where("status <> 'moved'").collect()}
    assert found == {("<urn:page:17>", "missing"), ("<urn:page:23>", "changed"), ("<urn:page:999>", "extra")}
    assert warc.audit(a, a, options).count() == 0
    whole = b"".join(warc.START + f"WARC-Record-ID: <{k}>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n".encode() for k in range(4))
    assert [x[0] for x in warc.parse(whole)] == ["<0>", "<1>", "<2>", "<3>"]
    assert [x[0] for x in warc.parse(whole.replace(b"Content-Length: 3\r\n\r\nabc", b"Content-Length: 9\r\n\r\nabc", 1))] == ["<0>", "<1>", "<2>", "<3>"]


def test_toxicity(spark, odd, empty):
    draw = random.Random(8)
    stems = ["grubble", "snark", "vexen"]
    rows = []
    for i in range(500):
        text = ["".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 9))) for _ in range(draw.randint(0, 90))]
        bad = i % 4 == 0
        for _ in range(3 if bad else 0):
            text.insert(draw.randint(0, len(text)), draw.choice(stems) + draw.choice(["", "s", "ing", "ly"]))
        rows.append((i, " ".join(text), int(bad)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int").withColumn("score", F.lit(1))
    weights = toxicity.train(table, table.where(remainder(5) != 0))
    found = toxicity.toxicity(table, weights).join(table.select("doc_id", "toxic"), "doc_id").where(remainder(5) == 0).collect()
    assert sum((r["score"] >= 0.5) == (r["toxic"] == 1) for r in found) >= 0.95 * len(found)
    out = toxicity.toxicity(odd, weights).collect()
    assert len(out) == len(ODD) and all(0 <= r["score"] <= 1 for r in out)
    for none in (empty.withColumn("toxic", F.lit(1)), table.where("toxic = 0")):
        assert len({r["score"] for r in toxicity.toxicity(odd, toxicity.train(none, none)).collect()}) == 1


def test_gradients_follow_differences():
    options = toxicity.ToxicityOptions(hidden=3, word_size=2, gram_size=2)
    weights = {k: v.astype(np.float64) for k, v in toxicity.begin(options).items()}
    draw = np.random.default_rng(9)
    vector, windows, wanted = draw.standard_normal((6, 4)), draw.integers(0, 6, (5, 4)), np.array([0, 1, 1, 0, 1.0])
    loss = lambda: float(np.mean(np.logaddexp(0, -(2 * wanted - 1) * toxicity.forward(weights, vector, windows))))
    grad, _ = toxicity._gradients(weights, vector, windows, wanted)
    for name in ("turn_f", "in_b", "look", "out", "add_f"):
        flat = weights[name].reshape(-1)
        flat[1] += 1e-2
        up = loss()
        flat[1] -= 2e-2
        down = loss()
        flat[1] += 1e-2
        assert abs((up - down) / 2e-2 - grad[name].reshape(-1)[1]) < 2e-3


def test_pipeline(spark, odd, tmp_path):
    import corpus_pipeline

    item = " ".join(f"bench{k}mark" for k in range(30))
    plain = lambda k: " ".join(f"the{(k * 7 + j * j) % 101}and of" for j in range(60))
    rows = [(20, plain(1)), (21, plain(1)), (22, plain(1) + " more"), (23, "x " + item), (24, plain(2) + " a@b.example.com"), (25, plain(3)), (26, "12 34")]
    table = odd.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    table = table.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    docs = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == table.columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(names) == 5 and {20, 24, 25} <= set(kept) and not {21, 22, 23, 26, 1, 2, 3, 4} & set(kept)
    assert kept[24].endswith("[EMAIL]")
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(kept)


def test_damaged_copy_of_any_first_character(spark, tmp_path):
    """Pages that begin with a byte-order mark or a letter of several bytes are damaged like others."""
    names = [i for i in range(4000) if hashlib.md5(str(i).encode()).hexdigest()[:2] in ("00", "01")][:12]
    starts = ["\ufeff<html>", "ü", "漢字", "🙂", "", "plain"]
    rows = [(i, f"http://h/{i}", starts[k % len(starts)] + " rest\nof it") for k, i in enumerate(names)] + [(-5, None, "kept")]
    found = {r["record_id"]: r["status"] for r in warc.drill(spark.createDataFrame(rows, "page_id long, url string, html string")).where("status <> 'moved'").collect()}
    plain = {f"<urn:page:{i}>": "changed" if hashlib.md5(str(i).encode()).hexdigest()[:2] == "00" else "missing" for i in names}
    assert found == plain and set(plain.values()) == {"changed", "missing"}


def test_a_document_of_eight_languages():
    """As many languages as are learned may take part in one text."""
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    names = [f"l{k}" for k in range(8)]
    draw = random.Random(3)
    own = {n: ["".join(draw.choices(alphabet[3 * k : 3 * k + 3], k=6)) for _ in range(40)] for k, n in enumerate(names)}
    counts = np.zeros((8, 1 << language.BUCKET_BITS))
    for k, n in enumerate(names):
        for at in language._buckets(np.frombuffer((" " + " ".join(own[n] * 5) + " ").encode(), np.uint8)):
            counts[k, at] += 1
    log_p = np.log((counts + 1e-3) / (counts + 1e-3).sum(axis=1, keepdims=True)).astype(np.float32)
    text = " ".join(w for n in names for w in own[n])
    shares = language.mixtures(pa.array([text, " ".join(own["l2"])]), language.LanguageModel(names, log_p), language.LanguageOptions())
    assert (shares[0] > 0.05).all() and (shares[1] > 0).sum() == 1


def test_address_finders_equal_their_patterns():
    """The linear finders give the leftmost matches of the patterns that define them."""
    draw = random.Random(1)
    parts = ["a", "b1", "7", "255", "256", ".", ".", "@", " ", "-", "+", " at ", "[at]", " dot ", "(dot)", "é", "\n", "(at)"]
    spelt = re.compile(r"[A-Za-z0-9._%+-]+ ?" + pii.SPELT_DOMAIN.pattern)
    for _ in range(5000):
        text = "".join(draw.choices(parts, k=draw.randint(1, 22)))
        assert list(pii.emails(text)) == [m.span() for m in pii.EMAIL.finditer(text)]
        assert list(pii.addresses(text)) == [m.span() for m in pii.IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
        assert list(pii.spelt(text)) == [m.span() for m in spelt.finditer(text)]


def test_long_texts_take_linear_time():
    start = time.time()
    for text in ("1" * 1_000_000, "a" * 1_000_000 + "@x.de", "a@b.cd " * 40_000):
        pii.find_spans(text, pii.Field({}, 21))
    assert time.time() - start < 10
