"""WARC archives of pages and a Merkle fixity audit between two replicas.

Every record of an archive file is hashed, and ranges of consecutive records are hashed
into nodes with the offsets they span, up to one root a file. Two replicas are compared at
the roots; only the branches that differ are followed down, and the records below them are
matched by their ids.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.session import scratch_path, ship_package, written

HEAD = re.compile(rb"WARC/1\.0\r\n((?:[^\r\n]+\r\n)*)\r\n")
START = b"WARC/1.0\r\n"


@dataclass(frozen=True)
class ArchiveOptions:
    """``file_bytes``: uncompressed size of an archive file, about; ``fanout``: children of a node."""

    file_bytes: int = 8 << 20
    fanout: int = 16


def record(id_col: Column, url: Column, payload: Column) -> Column:
    """A WARC resource record without its last line feed, which the text writer adds."""
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(id_col.cast("string"), F.lit("null")),
        F.lit(">\r\nWARC-Target-URI: "), F.regexp_replace(F.coalesce(url, F.lit("-")), r"[\r\n]", ""), F.lit("\r\nContent-Length: "),
        F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"), payload, F.lit("\r\n\r"))


def segments_of(pages: DataFrame, options: ArchiveOptions = ArchiveOptions(), payload_col: str = "html") -> int:
    """How many files an archive of these pages has: its bytes by ``file_bytes``, 1 at least."""
    size = pages.agg(F.sum(F.coalesce(F.octet_length(payload_col), F.lit(0)) + 200)).first()[0] or 0
    return max(1, -(-size // options.file_bytes))


def write_archive(pages: DataFrame, path: str, segments: int, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html") -> None:
    """Write gzipped WARC files, one per segment, pages in order of id, address and payload.

    A page's segment is a hash of its id and address. A null payload is empty, a null
    address is ``-`` and a null id ``null``; repeated rows are records of their own; no
    pages write no files. Other columns are not archived.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.pmod(F.xxhash64(F.col(id_col), F.col(url_col)), F.lit(segments)).cast("int").alias("segment"),
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), record(F.col(id_col), F.col(url_col), payload).alias("value"))
    ordered = rows.repartition("segment").sortWithinPartitions("segment", "id", "url", "value")
    ordered.select("segment", "value").write.partitionBy("segment").option("compression", "gzip").mode("overwrite").text(path)


def parse(content: bytes) -> Iterator[tuple[str, int, int, str]]:
    """(record id, offset, length, sha256) of a file's records; bytes that are no record are
    passed over until the next one starts, and belong to the record before."""
    at = content.find(START)
    while at >= 0:
        head = HEAD.match(content, at)
        fields = dict(line.split(b": ", 1) for line in head[1].split(b"\r\n") if b": " in line) if head else {}
        size = fields.get(b"Content-Length", b"")
        stop = head.end() + int(size) + 4 if head and size.isdigit() and len(size) < 19 else -1
        if not (stop == len(content) or 0 < stop and content.startswith(START, stop)):
            after = content.find(START, at + 1)
            stop = len(content) if after < 0 else after
        name = fields.get(b"WARC-Record-ID", b"").decode(errors="replace")
        yield name, at, stop - at, hashlib.sha256(content[at:stop]).hexdigest()
        at = stop if stop < len(content) else -1


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(segment, content) of an archive's files; the segment is taken from the path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").load(path)
    return files.select(F.regexp_extract("path", r"segment=(\d+)", 1).cast("int").alias("segment"), "content")


def leaves(spark: SparkSession, path: str) -> DataFrame:
    """(segment, n, record_id, offset, length, hash) of every record of an archive, in file order."""
    ship_package(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for segment, content in zip(batch["segment"], batch["content"], strict=True):
                found = list(parse(gzip.decompress(content)))
                yield pd.DataFrame({"segment": segment, "n": range(len(found)), "record_id": [x[0] for x in found], "offset": [x[1] for x in found],
                                    "length": [x[2] for x in found], "hash": [x[3] for x in found]})

    return _files(spark, path).mapInPandas(run, "segment int, n long, record_id string, offset long, length long, hash string")


def tree(spark: SparkSession, path: str, options: ArchiveOptions = ArchiveOptions()) -> DataFrame:
    """(segment, level, n, hash, offset, length, record_id) of all nodes, written; level 0 holds records.

    A node's hash covers its children's hashes in order and the offsets that they span.
    """
    level = written(leaves(spark, path), "leaves").withColumn("level", F.lit(0))
    columns = ["segment", "level", "n", "hash", "offset", "length", "record_id"]
    nodes, height = level.select(columns), 0
    most = level.agg(F.max("n")).first()[0] or 0
    while most:
        height += 1
        child = F.struct("n", "hash", F.col("offset"), F.col("length"))
        grouped = level.groupBy("segment", F.floor(F.col("n") / options.fanout).alias("up")).agg(F.sort_array(F.collect_list(child)).alias("parts"))
        offset = F.col("parts")[0]["offset"]
        length = F.expr("parts[size(parts) - 1].offset + parts[size(parts) - 1].length") - offset
        text = F.concat_ws("|", F.transform("parts", lambda p: p["hash"]), offset.cast("string"), length.cast("string"))
        level = grouped.select("segment", F.lit(height).alias("level"), F.col("up").alias("n"), F.sha2(text, 256).alias("hash"),
                               offset.alias("offset"), length.alias("length"), F.lit(None).cast("string").alias("record_id"))
        nodes = nodes.union(level.select(columns))
        most //= options.fanout
    return written(nodes, "nodes")


def audit(ours: DataFrame, theirs: DataFrame, options: ArchiveOptions = ArchiveOptions()) -> DataFrame:
    """Where two trees differ: (record_id, status, segment, offset, length, other_offset, other_length).

    status is ``changed`` (same id, other bytes), ``missing`` (in ours only), ``extra`` (in
    theirs only) or ``moved`` (same bytes at another offset). Equal copies of a record are
    matched one by one in file order. Trees without nodes miss everything.
    """
    join = ["segment", "level", "n"]
    height = max(t.agg(F.max("level")).first()[0] or 0 for t in (ours, theirs))
    a = ours.select(*join, "hash", "offset", "length", "record_id")
    b = theirs.select(*join, "hash", "offset", "length", "record_id")
    suspects = None
    for level in range(height, 0, -1):
        left, right = (t.where(F.col("level") == level).select(*join, "hash") for t in (a, b))
        if suspects is not None:
            left, right = (t.join(suspects, ["segment", "n"], "left_semi") for t in (left, right))
        both = left.join(right.withColumnRenamed("hash", "other"), join, "full_outer")
        differ = both.where(~F.col("hash").eqNullSafe(F.col("other"))).select("segment", "n")
        children = F.explode(F.sequence(F.col("n") * options.fanout, F.col("n") * options.fanout + (options.fanout - 1)))
        suspects = written(differ.select("segment", children.alias("n")).distinct(), "suspects")
    left, right = (t.where("level = 0") for t in (a, b))
    if suspects is not None:
        left, right = (t.join(suspects, ["segment", "n"], "left_semi") for t in (left, right))
    counted = lambda t: t.groupBy("segment", "record_id").agg(F.sort_array(F.collect_list(F.struct("hash", "offset", "length"))).alias("found"))
    both = counted(left).join(counted(right).withColumnRenamed("found", "others"), ["segment", "record_id"], "full_outer")
    # equal records first, then what is left by order; an id is repeated a few times at most
    zipped = both.select("segment", "record_id", F.explode(F.arrays_zip(
        F.coalesce("found", F.expr("array()")).alias("found"), F.coalesce("others", F.expr("array()")).alias("others"))).alias("p"))
    pair = zipped.select("segment", "record_id", F.col("p.found").alias("x"), F.col("p.others").alias("y"))
    status = (F.when(F.col("y").isNull(), "missing").when(F.col("x").isNull(), "extra").when(F.col("x.hash") != F.col("y.hash"), "changed")
              .when(F.col("x.offset") != F.col("y.offset"), "moved"))
    return pair.withColumn("status", status).where("status is not null").select(
        "record_id", "status", "segment", F.col("x.offset").alias("offset"), F.col("x.length").alias("length"),
        F.col("y.offset").alias("other_offset"), F.col("y.length").alias("other_length"))


def damaged_copy(spark: SparkSession, path: str, copy: str) -> None:
    """Copy an archive file by file, with one record in 256 changed and one in 256 left out.

    Which ones follows from a hash of the page id in the record's name. No page is shuffled.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for segment, packed in zip(batch["segment"], batch["content"], strict=True):
                content, values = gzip.decompress(packed), []
                for name, at, length, _ in parse(content):
                    mark = hashlib.md5(name.removeprefix("<urn:page:").removesuffix(">").encode()).hexdigest()[:2]
                    part = content[at : at + length - 1]  # the writer adds the last line feed
                    text = part.decode()
                    if mark == "00":  # the first character of the payload, at the same number of bytes
                        body = len(HEAD.match(part)[0].decode())
                        text = text[:body] + "~" * max(1, len(text[body : body + 1].encode())) + text[body + 1 :]
                    if mark != "01" or name == "<urn:page:null>":
                        values.append(text)
                yield pd.DataFrame({"segment": segment, "n": range(len(values)), "value": values})

    ship_package(spark)
    records = _files(spark, path).mapInPandas(run, "segment int, n long, value string").sortWithinPartitions("segment", "n")
    records.select("segment", "value").write.partitionBy("segment").option("compression", "gzip").mode("overwrite").text(copy)


def drill(pages: DataFrame, options: ArchiveOptions = ArchiveOptions(), id_col: str = "page_id", payload_col: str = "html") -> DataFrame:
    """Archive the pages, make a damaged replica of the archive, and audit one against the other."""
    spark = pages.sparkSession
    ours, theirs = scratch_path(spark, "replica"), scratch_path(spark, "replica")
    write_archive(pages, ours, segments_of(pages, options, payload_col), id_col, payload_col=payload_col)
    damaged_copy(spark, ours, theirs)
    return audit(tree(spark, ours, options), tree(spark, theirs, options), options)
