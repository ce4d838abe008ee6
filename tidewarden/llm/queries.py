"""Queries of the operators, each over whole tables with production parameters, and check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.llm import (
    conversations, decontaminate, embedding, jaccard, language, lm, packing, pii, substrings, toxicity, urls, warc, whitening,
)
from tidewarden.llm.common import remainder, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_min_bin_slack_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.cut(table(spark, folder, "documents"))
    lean = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    packed = packing.pack(lean)
    return packed.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op2_rotation_code_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return embedding.near_duplicates(table(spark, folder, "embeddings"))


@query
def op3_lempel_ziv_substring_removal(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_signature_tree_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, folder, "documents"))


@query
def op5_mixture_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.learn(docs.where(remainder(5) != 0))
    held_out = F.coalesce(remainder(5) == 0, F.lit(True)).alias("held_out")
    return language.identify(docs, model).select("doc_id", held_out, "lang_pred", "score")


@query
def op6_semi_markov_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = pii.personal_data(docs, pii.train(docs))
    order = F.array(*[F.lit(k) for k in pii.KINDS])
    ranked = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(
        F.array_position(order, s["kind"]).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")  # noqa: E731
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")  # noqa: E731
    return found.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(ranked).alias("spans"))


@query
def op7_qgram_band_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op8_partial_matching_lm(spark: SparkSession, folder: str) -> DataFrame:
    found = lm.score(table(spark, folder, "documents"), remainder(7) == 2)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op9_merkle_fixity_audit(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.drill(table(spark, folder, "pages")).where("status <> 'moved'")
    page = F.regexp_extract("record_id", r"urn:page:(-?\d+)", 1).cast("long")
    return found.select(page.alias("page_id"), "status")


@query
def op10_gated_network_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").where(remainder(5) != 0)
    weights = toxicity.train(docs, labels)
    held_out = F.coalesce(remainder(5) == 0, F.lit(True)).alias("held_out")
    found = toxicity.toxicity(docs, weights)
    return found.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "worst_word")


#: Which addresses net/ and the others of the longest fitting rule decide.
URL_RULES = (
    urls.Rule("block", "net", "/"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
)
#: Hosts whose pages make up the list of unwanted URLs.
LISTED_HOSTS = r"(?:^|\.)(?:spam-farm|casino-win|free-bets|cheap-pills|ads-track)\."


@query
def op11_bloom_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    host, _ = urls.host_and_path(F.col("url"))
    listed = pages.where(host.rlike(LISTED_HOSTS)).select(urls.canonical_url(F.col("url")).alias("canonical"))
    return urls.judge(pages, URL_RULES, listed)


@query
def op12_block_matrix_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


@query
def op13_generalised_lr_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    found = conversations.repair(conversations.damage(turns))
    whole = turns.select("conv_id").distinct().alias("c")
    summary, digest = found.summary.alias("s"), conversations.digests(found.rows).alias("d")
    joined = whole.join(summary, F.expr("c.conv_id <=> s.conv_id"), "left").join(digest, F.expr("c.conv_id <=> d.conv_id"), "left")
    zero = lambda name: F.coalesce(f"s.{name}", F.lit(0).cast("bigint")).alias(name)  # noqa: E731
    return joined.select(
        "c.conv_id", *[zero(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], F.coalesce("s.audit", F.lit("")).alias("audit"),
        F.coalesce("d.repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the rows of the queries that SQL can express."""
    words = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
    reach = """
    , recursive_reach(a, b) AS (
        SELECT a, b FROM links UNION SELECT r.a, l.b FROM recursive_reach r JOIN links l ON r.b = l.a)"""
    return {
        "op2_rotation_code_near_duplicates": """
            WITH RECURSIVE v AS (
                SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
                WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
                  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                  AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
            links AS (
                SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
                WHERE list_dot_product(x.e, y.e) / (sqrt(list_dot_product(x.e, x.e)) * sqrt(list_dot_product(y.e, y.e))) >= 0.93)"""
        + reach + """,
            low AS (SELECT a, min(b) AS m FROM recursive_reach GROUP BY a),
            many AS (SELECT a, count(*) AS n FROM links GROUP BY a)
            SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(m, e.vec_id)) AS component_id,
                   e.vec_id = least(e.vec_id, coalesce(m, e.vec_id)) AS kept
            FROM embeddings e LEFT JOIN low ON low.a = e.vec_id LEFT JOIN many ON many.a = e.vec_id""",
        "op3_lempel_ziv_substring_removal": f"""
            WITH w AS (SELECT doc_id, {words.format("coalesce(text, '')")} AS ws FROM documents),
            win AS (
                SELECT doc_id, s, md5(array_to_string(ws[s + 1 : s + 20], ' ')) AS h
                FROM (SELECT doc_id, ws, unnest(range(0, greatest(len(ws) - 19, 0))) AS s FROM w)),
            firsts AS (SELECT h, min(struct_pack(d := doc_id, s := s)) AS f FROM win GROUP BY h),
            gone AS (
                SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS k FROM win JOIN firsts USING (h)
                WHERE struct_pack(d := doc_id, s := s) <> f),
            each AS (SELECT doc_id, unnest(ws) AS word, unnest(range(0, len(ws))) AS k FROM w),
            kept AS (
                SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.k) AS t, count(*) AS n
                FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.k = g.k GROUP BY e.doc_id)
            SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
            FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id""",
        "op4_signature_tree_jaccard": f"""
            WITH RECURSIVE w AS (
                SELECT doc_id, {words.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
            sh AS (
                SELECT DISTINCT doc_id, array_to_string(ws[s + 1 : s + 4], ' ') AS x
                FROM (SELECT doc_id, ws, unnest(range(0, CASE WHEN len(ws) = 0 THEN 0 ELSE greatest(len(ws) - 3, 1) END)) AS s FROM w)),
            n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
            pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b USING (x) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
            links AS (
                SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i))"""
        + reach + """,
            low AS (SELECT a, min(b) AS m FROM recursive_reach GROUP BY a)
            SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id
            FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN low ON low.a = w.doc_id""",
        "op9_merkle_fixity_audit": """
            SELECT page_id, CASE WHEN md5(page_id::VARCHAR) LIKE '00%' THEN 'changed' ELSE 'missing' END AS status
            FROM pages WHERE md5(page_id::VARCHAR) LIKE '00%' OR md5(page_id::VARCHAR) LIKE '01%'""",
        "op11_bloom_url_filter": _URL_SQL,
        "op13_generalised_lr_repair": _repair_sql(),
    }


_URL_SQL = r"""
    WITH parts AS (
        SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
               list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'),
                                     lambda p: NOT regexp_matches(p, '^(utm_[^=]*|ref|gclid|fbclid)?(=|$)'))) AS query
        FROM pages),
    named AS (
        SELECT *, regexp_replace(regexp_replace(host, '^(www|m)\.', ''), ':(80|443)$', '')
                  || regexp_replace(regexp_replace(path, '(/index)?\.html?$', ''), '/+$', '')
                  || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS canonical,
               CASE WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
                    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
                    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
                    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
        FROM parts),
    listed AS (
        SELECT DISTINCT canonical FROM named
        WHERE host <> '' AND regexp_matches(host, '(^|\.)(spam-farm|casino-win|free-bets|cheap-pills|ads-track)\.'))
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                WHEN host <> '' AND l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
    FROM named n LEFT JOIN listed l ON l.canonical = n.canonical"""


def _repair_sql() -> str:
    """The cheapest edits by a step for each turn over the four tops, each {c: cost, a: audit}."""
    plus = lambda top, cost, letter: f"{{'c': {top}.c + {cost}, 'a': {top}.a || '{letter}'}}"  # noqa: E731
    never = "{'c': 1000000000, 'a': ''}"
    best = lambda *tops: f"list_min([{', '.join(tops)}])"  # noqa: E731
    more = lambda source: f"""
        SELECT * REPLACE ({best('a', plus('u', 3, 'I'))} AS a) FROM (
        SELECT * REPLACE ({best('u', plus('o', 3, 'I'), plus('s', 3, 'I'), plus('a', 3, 'I'))} AS u) FROM {source})"""  # noqa: E731

    def shifted(top: str, role: str) -> list[str]:
        keep = f"CASE WHEN kind IN ('', 't') AND initial = '{role}' THEN {plus(top, 'extra', 'K')} ELSE {never} END"
        rerole = f"CASE WHEN kind IN ('', 't') THEN {plus(top, '3 + extra', 'R')} ELSE {never} END"
        return [keep] if role == "s" else [keep, rerole]

    step = f"""
        SELECT conv_id, n, {plus('o', 4, 'D')} AS o, {best(plus('s', 4, 'D'), *shifted('o', 's'))} AS s,
               {best(plus('u', 4, 'D'), *shifted('o', 'u'), *shifted('s', 'u'), *shifted('a', 'u'))} AS u,
               {best(plus('a', 4, 'D'), *shifted('u', 'a'))} AS a"""
    return rf"""
    WITH RECURSIVE src AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
    hashed AS (
        SELECT *, xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(key, ''),
                   lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                   lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) ELSE xor(acc >> 1, CASE WHEN acc & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END) END)) % 20 AS hit
        FROM src),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
               CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM hashed, range(2) r(copy) WHERE hit <> 0 AND (copy = 0 OR hit = 3)),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || ':' || text)) AS n,
               left(role, 1) AS initial FROM damaged),
    judged AS (
        SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'b'
                       WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'd'
                       WHEN NOT regexp_matches(text, '[.!?][ 	-]*$') THEN 't' ELSE '' END AS kind,
               lag(initial) OVER (PARTITION BY conv_id ORDER BY n) AS before
        FROM placed),
    turns AS (SELECT *, CASE WHEN kind = 't' THEN 3 ELSE 0 END AS extra FROM judged),
    counted AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count_if(kind = 'b')::BIGINT AS blank,
               count_if(kind = 'd')::BIGINT AS duplicate, count_if(kind = 't')::BIGINT AS truncated,
               count_if(before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal, count(*) AS last
        FROM turns GROUP BY conv_id),
    tops AS (
        SELECT DISTINCT conv_id, 0::BIGINT AS n, {{'c': 0, 'a': ''}} AS o, {never} AS s, {never} AS u, {never} AS a FROM turns
        UNION ALL {step} FROM (
        SELECT m.conv_id, t.n, kind, initial, extra, o, s, u, a FROM ({more('tops')}) m
        JOIN turns t ON t.conv_id IS NOT DISTINCT FROM m.conv_id AND t.n = m.n + 1)),
    ends AS (
        SELECT m.conv_id, {best('o', 'a')} AS e FROM ({more('tops')}) m
        JOIN counted c ON c.conv_id IS NOT DISTINCT FROM m.conv_id AND c.last = m.n),
    letters AS (
        SELECT conv_id, i, e.a[i] AS edit, len(replace(e.a[1:i], 'I', '')) AS n, len(replace(e.a[1:i], 'D', '')) AS k
        FROM (SELECT conv_id, e, unnest(range(1, len(e.a) + 1)) AS i FROM ends)),
    kept AS (
        SELECT l.*, t.role, t.text, t.initial FROM letters l
        LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM l.conv_id AND t.n = l.n AND l.edit <> 'I' WHERE edit <> 'D'),
    opened AS (SELECT *, max(CASE WHEN k = 1 AND edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS opener FROM kept),
    said AS (
        SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (k - opener) % 2 = 1 THEN 'user' ELSE 'assistant' END
                               || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY i)) AS said
        FROM opened GROUP BY conv_id)
    SELECT w.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.c, 0)::BIGINT AS cost, coalesce(e.a, '') AS audit,
           coalesce(said, sha256('')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) w
    LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id
    LEFT JOIN ends x ON x.conv_id IS NOT DISTINCT FROM w.conv_id
    LEFT JOIN said d ON d.conv_id IS NOT DISTINCT FROM w.conv_id"""
