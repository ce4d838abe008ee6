"""URL verdicts: host and path rules first, then a list of canonical URLs behind a blocked Bloom filter.

All steps are DataFrame functions. Only the filter is broadcast, and its size is bounded by
``UrlOptions.max_blocks``; a longer list makes it pass more rows to the exact join, never fewer.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.session import written

WORDS = 4
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class UrlOptions:
    """``bits_per_key`` sizes the filter; ``max_blocks`` (a power of two, of 256 bits each) bounds it."""

    bits_per_key: int = 16
    max_blocks: int = 1 << 18


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with all its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str = ""

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


def ascii_lower(column: Column) -> Column:
    return F.translate(column, _UPPER, _UPPER.lower())


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) between the first ``://`` and the next ``/``, ``?``, ``#`` or the end,
    and the path from there to ``?``, ``#`` or the end. Both are empty for a null or a text without ``://``."""
    part = lambda n: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", n), F.lit(""))
    return ascii_lower(part(1)), part(2)


def canonical_url(url: Column) -> Column:
    """One text for the addresses of the same page; null where there is no host.

    Dropped are the scheme, a leading ``www.`` or ``m.``, default ports, the fragment, ``.html`` and
    ``/index.html``, closing slashes and tracking parameters (``utm_*``, ``ref``, ``gclid``,
    ``fbclid``); the other parameters are sorted.
    """
    host, path = host_and_path(url)
    host = F.regexp_replace(F.regexp_replace(host, r"^(?:www|m)\.", ""), r":(?:80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(path, r"(?:/index)?\.html?$", ""), r"/+$", "")
    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))
    kept = F.filter(F.split(query, "&"), lambda p: ~p.rlike(r"^(?:utm_[^=]*|ref|gclid|fbclid)?(?:=|$)"))
    query = F.array_join(F.array_sort(kept), "&")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def judged_by_rules(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, null where none does. Of equally long ones the
    longer host goes first, then ``block``."""
    order = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.verdict != "block", r.text))
    outcomes = [F.when(r.fits(host, path), F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in order]
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*outcomes, none)


def _bits(key: Column) -> list[Column]:
    """Two bits in each of the words of a block, taken from one 64-bit hash."""
    drawn = F.xxhash64(F.lit("bits"), key)
    one = lambda at: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(drawn, at).bitwiseAND(63).cast("int"))
    return [one(12 * w).bitwiseOR(one(12 * w + 6)) for w in range(WORDS)]


def _block(key: Column, blocks: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 24).bitwiseAND(blocks - 1)


def filter_blocks(keys: int, options: UrlOptions) -> int:
    """How many blocks of 256 bits the filter of so many keys has."""
    wanted = max(1, -(-keys * options.bits_per_key // 256))
    return min(options.max_blocks, 1 << (wanted - 1).bit_length())


def bloom_filter(listed: DataFrame, blocks: int, key: str = "canonical") -> DataFrame:
    """(block, w0 .. w3): the blocks that hold a key, ``blocks`` rows at most."""
    words = [F.bit_or(bits).alias(f"w{w}") for w, bits in enumerate(_bits(F.col(key)))]
    return listed.groupBy(_block(F.col(key), blocks).alias("block")).agg(*words)


def judge(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, options: UrlOptions = UrlOptions()) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url).

    A rule decides where one fits; otherwise a page whose canonical URL is in ``listed``
    (canonical; repeats and nulls do no harm) is blocked and all others are allowed. Rows that
    the filter lets through are joined with the list itself, so no verdict depends on the
    filter. Only rows without a rule are hashed, only those it lets through are shuffled, and
    a URL that very many pages share is split by the skew handling of the join.

    Null and malformed URLs have an empty host and path, no rule, and are allowed; repeated rows
    and null ids are kept one by one; an empty list allows, an empty table returns no rows. Other
    columns of ``pages``, whatever their names, are not looked at.
    """
    listed = written(listed.select("canonical").where("canonical is not null").distinct(), "listed")
    blocks = filter_blocks(listed.count(), options)
    host, path = host_and_path(F.col("url"))
    seen = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    seen = seen.withColumn("rule", judged_by_rules(F.col("host"), F.col("path"), rules))
    columns = ["page_id", "host", "path", F.col("rule.rule").alias("rule")]
    ruled = seen.where("rule is not null").select(*columns, F.col("rule.verdict").alias("verdict"))

    rest = seen.where("rule is null").withColumn("canonical", canonical_url(F.col("url")))
    words = [F.col(f"w{w}").bitwiseAND(bits) == bits for w, bits in enumerate(_bits(F.col("canonical")))]
    met = words[0]
    for word in words[1:]:
        met = met & word
    probed = (
        rest.withColumn("block", _block(F.col("canonical"), blocks))
        .join(F.broadcast(bloom_filter(listed, blocks)), "block", "left")
        .withColumn("possible", F.coalesce(met & F.col("canonical").isNotNull(), F.lit(False)))
    )
    clear = probed.where("not possible").select(*columns, F.lit("allow").alias("verdict"))
    known = listed.withColumn("found", F.lit(True)).hint("shuffle_hash")
    checked = probed.where("possible").join(known, "canonical", "left")
    exact = checked.select(*columns, F.when(F.col("found"), "block").otherwise("allow").alias("verdict"))
    return ruled.unionByName(clear).unionByName(exact)
