"""WARC archives written and read by Spark; reading verifies the chain of record boundaries.

Writing: one record per page through Spark's text writer (any file system, committed as a
whole).  The block is an HTTP message whose body is the page's html in UTF-8.  Of pages with
equal payloads of at least ``MIN_REVISIT`` bytes the one with the smallest id becomes a
response, the others revisits without block.

Archives are written uncompressed unless asked otherwise: a compressed file cannot be split,
so one task would read it and no jump would be needed.

Reading: the text source splits archives at the record magic, so that large uncompressed
files are read by many tasks (a gzip file by one).  Magic also occurs inside payloads, so a
piece is only a candidate.

1. Each task sums the bytes of its pieces and emits, per candidate, its offset in the split,
   the offset of its successor by Content-Length, and where the chain through its own split
   leaves the split.  Offsets in the file follow from the bytes of the file's earlier splits.
2. From the file's start, pointer jumping over (entry of a split -> entry of a later split)
   doubles its reach each round until nothing new is reached.
3. In each split the chain from the reached entry is walked; other candidates are magic
   inside payloads and are rejected.
4. A record whose payload holds magic lies in several pieces; these are read again, only for
   such records, and joined.

Reading ends in a file where the chain breaks: at a record without a valid Content-Length or
one that does not end where it says.  Null html counts as empty, null url gives no target
URI, null page ids are kept (and are never the one that others refer to unless all are
null).  Rows that repeat the response's id are responses too.  No rows give an archive
without records.  Other columns are not read.  Payload sizes are bounded by Spark's 2 GB
limit of a value.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, prepare, stored

MAGIC = "WARC/1.1\r\n"
END = b"\r\n\r\n"
MIN_REVISIT = 100
MARKS = 1 << 18
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIELDS = ("record_type string, page_id long, url string, refers_to long, "
          "payload_bytes long, payload_digest string, payload binary")


def _referred(pages: DataFrame) -> DataFrame:
    """Pages with html (null: empty), size, digest and ``first_id``, the smallest id of an equal
    payload (null if there is no other).

    Payloads are moved only if they may be repeated: digests of repeated ones are marked in
    ``MARKS`` buckets, a table of bounded size that every task gets, and the pages of other
    buckets stay where they are read.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.octet_length(html).alias("size"),
                        F.sha2(html.cast("binary"), 256).alias("digest"))
    first = rows.where(f"size >= {MIN_REVISIT}").groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # Written first, so that a small table is broadcast and else the join is between two plain
    # shuffles and a hot payload can be split.
    first = stored(first, "warc-first")
    mark = F.pmod(F.xxhash64("digest"), F.lit(MARKS)).alias("mark")
    marks = F.broadcast(cut(first.select(mark).distinct()))  # at most MARKS numbers
    rows = rows.select("*", mark)
    alone = rows.join(marks, "mark", "left_anti").withColumn("first_id", F.lit(None).cast(pages.schema["page_id"].dataType))
    shared = rows.join(marks, "mark", "left_semi").join(first, "digest", "left")
    return alone.unionByName(shared).drop("mark")


def write(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", compression: str = "none") -> None:
    """Archives of ``pages`` (page_id, url, html) below ``path``."""
    rows = _referred(pages)
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))

    def urn(c):
        return F.concat(F.lit("<urn:x-page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">\r\n"))

    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    block = F.when(revisit, F.lit("")).otherwise(F.concat(F.lit(HTTP_HEAD), F.col("html")))
    record = F.concat(
        F.lit(MAGIC),
        F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), urn(F.col("page_id")),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), url, F.lit("\r\n")), F.lit("")),
        F.lit(f"WARC-Date: {date}\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.lit("\r\nX-Payload-Length: "), F.col("size").cast("string"), F.lit("\r\n"),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), urn(F.col("first_id"))))
        .otherwise(F.lit("Content-Type: application/http;msgtype=response\r\n")),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block, F.lit("\r\n"))
    # The separator is the second half of the blank lines that end a record.
    rows.select(record.alias("value")).write.option("lineSep", "\r\n").option("compression", compression).text(path)


def parse_head(piece: bytes) -> tuple[dict[str, str], int, int] | None:
    """Header fields, offset of the block and its length; None if it is no record."""
    end = piece.find(END)
    if end < 0:
        return None
    fields = {}
    for line in piece[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        return None
    return fields, end + len(END), int(length)


def _number(value: str | None) -> int | None:
    value = (value or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(value) if value.lstrip("-").isdigit() else None


def parse_record(piece: bytes, payloads: bool) -> tuple:
    """The values of FIELDS for a whole record (what follows its magic)."""
    fields, at, length = parse_head(piece)
    block = piece[at:at + length]
    kind = fields.get("warc-type")
    if kind == "revisit":
        digest, size, payload = fields.get("warc-payload-digest", "").partition(":")[2], _number(fields.get("x-payload-length")), None
    else:
        payload = block.partition(END)[2] if fields.get("content-type", "").startswith("application/http") else block
        digest, size = hashlib.sha256(payload).hexdigest(), len(payload)
    return (kind, _number(fields.get("warc-record-id")), fields.get("warc-target-uri"),
            _number(fields.get("warc-refers-to")), size, digest, payload if payloads else None)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("piece"))


def _splits(batches):
    """(path, split, offset in the split, piece) in order; offsets restart with every split."""
    now, offset = None, 0
    for batch in batches:
        for path, split, piece in zip(*(c.to_pylist() for c in batch.columns)):
            if (path, split) != now:
                now, offset = (path, split), 0
            yield path, split, offset, piece
            offset += len(piece) + len(MAGIC)


CANDIDATE = f"path string, split long, at long, taken long, next long, leaves long, whole boolean, {FIELDS}"


def _candidates(payloads: bool):
    """One row per piece: ``at`` and ``next`` count from the split's first byte; ``at`` is the
    place of the magic before the piece; ``leaves``: where the chain leaves the split."""
    def rows_of(rows):
        leaves = {}
        for row in reversed(rows):
            if row[4] is not None:
                leaves[row[2]] = row[5] = leaves.get(row[4], row[4])
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    names = [c.split()[0] for c in CANDIDATE.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    types = [kinds[c.split()[1]] for c in CANDIDATE.split(", ")]

    def run(batches):
        rows, now = [], None
        for path, split, offset, piece in _splits(batches):
            if rows and (path, split) != now:
                yield rows_of(rows)
                rows = []
            now = (path, split)
            head = parse_head(piece)
            following, whole, values = None, False, (None,) * 7
            if head is not None:
                size = head[1] + head[2] + len(END)
                following, whole = offset + size, size <= len(piece)
                if whole:
                    values = parse_record(piece, payloads)
            rows.append([path, split, offset - len(MAGIC), len(piece) + len(MAGIC), following, None, whole, *values])
        if rows:
            yield rows_of(rows)

    return run


def _reached(nodes: DataFrame) -> DataFrame:
    """(path, start) of the split entries on the chain from offset 0 of each file."""
    targets = nodes.where("leaves is not null").select("path", F.col("leaves").alias("start")).distinct()
    jumps = cut(nodes.where("leaves is not null").select("path", "start", "leaves")
                .join(targets.unionByName(nodes.where("start = 0").select("path", "start")).distinct(), ["path", "start"]))
    reached = cut(jumps.where("start = 0").select("path", "start"))
    n = reached.count()
    while n:
        more = reached.join(jumps, ["path", "start"]).select("path", F.col("leaves").alias("start"))
        more = more.join(jumps.select("path", "start"), ["path", "start"], "left_semi")
        reached = cut(reached.unionByName(more).distinct())
        if (grown := reached.count()) == n:
            break
        n = grown
        on = jumps.select("path", F.col("start").alias("leaves"), F.col("leaves").alias("beyond"))
        jumps = cut(jumps.join(on, ["path", "leaves"], "left").select(
            "path", "start", F.coalesce("beyond", "leaves").alias("leaves")))
    return reached


def _walk(group: pd.DataFrame) -> pd.DataFrame:
    """The candidates of one split that lie on the chain from its reached entry."""
    group = group.sort_values("start").reset_index(drop=True)
    where = {s: i for i, s in enumerate(group["start"])}
    out, entry = [], group.index[group["entry"]]
    i = int(entry[0]) if len(entry) else None
    while i is not None:
        out.append(i)
        i = where.get(group.at[i, "next"])
    return group.loc[out, ["path", "split", "start", "next"]].astype({"next": "int64"})


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Records below ``path``: file, offset and FIELDS; ``payload`` (binary) is null unless asked for."""
    prepare(spark)
    pieces = cut(_pieces(spark, path).mapInArrow(_candidates(payloads), CANDIDATE))
    sizes = pieces.groupBy("path", "split").agg(F.sum("taken").alias("taken"))
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = cut(sizes.select("path", "split", F.coalesce(F.sum("taken").over(before), F.lit(0)).alias("base")))
    placed = pieces.join(bases, ["path", "split"]).withColumns(
        {"start": F.col("base") + F.col("at"), "next": F.col("base") + F.col("next"), "leaves": F.col("base") + F.col("leaves")})
    nodes = cut(placed.where("next is not null and start >= 0").select("path", "split", "start", "next", "leaves"))
    entries = _reached(nodes).withColumn("entry", F.lit(True))
    thin = nodes.join(entries, ["path", "start"], "left").select("path", "split", "start", "next", F.coalesce("entry", F.lit(False)).alias("entry"))
    chain = cut(thin.groupBy("path", "split").applyInPandas(_walk, "path string, split long, start long, next long"))
    names = [c.split()[0] for c in FIELDS.split(", ")]
    records = placed.join(chain.select("path", "split", "start"), ["path", "split", "start"])
    whole = records.where("whole").select("path", F.col("start").alias("offset"), *names)
    split_up = chain.join(placed.where("not whole").select("path", "split", "start"), ["path", "split", "start"]).select("path", "start", "next")
    split_up = cut(split_up)
    if split_up.isEmpty():
        return whole
    return whole.unionByName(_joined(spark, path, bases, split_up, payloads))


def _joined(spark: SparkSession, path: str, bases: DataFrame, records: DataFrame, payloads: bool) -> DataFrame:
    """Records whose payload holds magic, joined from their pieces in a second reading."""
    def offsets(batches):
        rows = []
        for path, split, offset, piece in _splits(batches):
            rows.append((path, split, offset - len(MAGIC), piece))
            if len(rows) >= 256:
                yield pa.RecordBatch.from_pylist([dict(zip(("path", "split", "at", "piece"), r)) for r in rows])
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(("path", "split", "at", "piece"), r)) for r in rows])

    pieces = _pieces(spark, path).mapInArrow(offsets, "path string, split long, at long, piece binary")
    pieces = pieces.join(bases, ["path", "split"]).withColumn("place", F.col("base") + F.col("at"))
    # Their size is known once written: a small table is broadcast, a large one joined by file.
    wanted = stored(records, "warc").withColumnRenamed("path", "file")
    found = pieces.join(wanted, F.expr("path = file and place >= start and place < next"))
    lists = found.groupBy("path", "start").agg(F.sort_array(F.collect_list(F.struct("place", "piece"))).alias("pieces"))

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                whole = MAGIC.encode().join(p["piece"] for p in row["pieces"])
                _, at, length = parse_head(whole)
                if at + length + len(END) <= len(whole):
                    out.append((row["path"], row["start"], *parse_record(whole, payloads)))
            if out:
                yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=names), schema, preserve_index=False)

    names = ["path", "offset", *[c.split()[0] for c in FIELDS.split(", ")]]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([("path", pa.string()), ("offset", pa.int64()),
                        *[(c.split()[0], kinds[c.split()[1]]) for c in FIELDS.split(", ")]])
    return lists.mapInArrow(run, f"path string, offset long, {FIELDS}")
