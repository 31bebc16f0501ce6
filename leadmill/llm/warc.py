"""WARC archives and their capture index.

Writing: one record a page.  Of pages with equal payloads of at least REVISIT_BYTES, the one with the smallest page_id
is a response and the others are revisits that refer to it.  Records are strings that Spark's text writer puts
into gzip-compressed archives, through whatever file system the shared folder is on.  An archive holds at most ARCHIVE_RECORDS
records and about ARCHIVE_BYTES: pages of other sizes go to archives of their own, with fewer records each.

Reading: an archive is inflated as it is walked, by Content-Length, record by record, and gives one capture a record; a task holds one
compressed archive and one record.  The captures of an archive leave it sorted by URL key, timestamp and page: a run.

Index: runs are dealt to key ranges, at most RANGES, and within a range a loser tree merges its k runs, which arrive sorted.  The
composite key (url key, timestamp, page) splits the captures of one hot URL over several ranges.  Counts of the ranges
turn the place within a range into the position in the whole history.

Defined results: null html is an empty payload; null urls have an empty key; a null page_id is written as an empty
number, never the response of others if any has a number, and read back as null; repeated rows are separate
records, and of rows equal in page_id and payload all are responses or all revisits; payloads of any length are written
whole; other columns are not read; an empty
table gives no rows.  A revisit names its response by WARC-Refers-To, its URL and date, and by page number in X-Refers-To-Page.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import scratch, written

REVISIT_BYTES, ARCHIVE_RECORDS, ARCHIVE_BYTES = 100, 2000, 1 << 28
#: Sizes of pages whose archives hold ever fewer records: each is this much larger than the one before.
LARGER = 16
CRLF = "\r\n"
RESPONSE, REVISIT = "response", "revisit"


def url_key(url: Column) -> Column:
    """Sort-friendly key: host labels reversed by commas, then path and query, lower-cased; no scheme, port, www or fragment."""
    bare = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://", "")
    bare = F.regexp_replace(bare, "#.*$", "")
    host = F.regexp_replace(F.regexp_replace(F.regexp_extract(bare, "^[^/?]*", 0), r":\d+$", ""), r"^www\d*\.", "")
    rest = F.regexp_extract(bare, "^[^/?]*(.*)$", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(rest == "", "/").otherwise(rest))


def captured(page_id: Column) -> Column:
    """The tables have no capture times: a page's number in seconds after a fixed day stands for it."""
    return F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.coalesce(page_id, F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def typed(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, record_type, refers_to and refers_to_url of every page."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2(F.encode("payload", "UTF-8"), 256))
    large = F.octet_length("payload") >= REVISIT_BYTES
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")).where(large).select("page_id", "url", F.sha2(F.encode("payload", "UTF-8"), 256).alias("digest"))
    several = narrow.groupBy("digest").agg(F.min(F.struct(F.col("page_id").isNull(), "page_id", "url")).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first.page_id", "first.url")
    # Written, so that the join has no grouping right below it and a digest that many pages share can be split; small
    # payloads never meet it, and their rows are dealt by a key of their own.
    several = written(several.select(F.col("digest").alias("key"), F.col("page_id").alias("first"), F.col("url").alias("first_url")), "several")
    apart = F.concat_ws("-", F.lit("small"), "page_id", F.xxhash64("url"))
    rows = rows.withColumn("key", F.when(large, F.col("digest")).otherwise(apart)).join(several, "key", "left")
    again = F.coalesce(F.col("first") != F.coalesce("page_id", F.lit(-1)), F.lit(False))
    return rows.select("page_id", "url", "payload", "digest", F.when(again, REVISIT).otherwise(RESPONSE).alias("record_type"), F.when(again, F.col("first")).alias("refers_to"), F.when(again, F.col("first_url")).alias("refers_to_url"))


def record_id(page_id: Column, url: Column, digest: Column) -> Column:
    """The id of a page's record, made of what it holds, so that a revisit can name its response."""
    number = F.coalesce(page_id.cast("string"), F.lit(""))
    hexed = F.substr(F.sha2(F.concat_ws("|", number, url, digest), 256), F.lit(1), F.lit(32))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(hexed, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def records(rows: DataFrame) -> DataFrame:
    """The text of every record, but for the line end that the writer adds."""
    number = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    target = lambda url: F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]+", "")
    revisit = F.col("record_type") == REVISIT
    body = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length("payload").cast("string"), F.lit(CRLF + CRLF), F.when(revisit, "").otherwise(F.col("payload")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    head = F.concat(
        F.lit("WARC/1.1" + CRLF), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", record_id(F.col("page_id"), F.col("url"), F.col("digest"))),
        line("WARC-Date", captured(F.col("page_id"))), line("WARC-Target-URI", target(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))), line("X-Page", number), line("X-URL-Key", F.regexp_replace(url_key(F.col("url")), r"[\r\n]+", "")),
        F.when(revisit, F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", record_id(F.col("refers_to"), F.col("refers_to_url"), F.col("digest"))),
            line("WARC-Refers-To-Target-URI", target(F.col("refers_to_url"))), line("WARC-Refers-To-Date", captured(F.col("refers_to"))), line("X-Refers-To-Page", F.col("refers_to").cast("string")),
        )).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", F.octet_length("body").cast("string")),
    )
    return rows.withColumn("body", body).select(F.concat(head, F.lit(CRLF), F.col("body"), F.lit(CRLF)).alias("value"))


def write(rows: DataFrame, path: str) -> str:
    """Archives of the typed pages under path.  The largest payload says how many sizes of archives there are: one, where pages are small."""
    bytes_ = F.octet_length("payload")
    low, high = -1, max(1, ARCHIVE_BYTES // ARCHIVE_RECORDS)
    largest = rows.agg(F.max(bytes_)).first()[0] or 0
    while low < largest or low < 0:
        some = rows if low < 0 and largest <= high else rows.where((bytes_ > low) & (bytes_ <= high))
        records(some).write.mode("append").option("lineSep", CRLF).option("compression", "gzip").option("maxRecordsPerFile", max(1, ARCHIVE_BYTES // high)).text(path)
        low, high = high, high * LARGER
    return path


def inflated(packed: bytes, piece: int = 1 << 20) -> Iterator[bytes]:
    """A gzip file in pieces, one member after the other."""
    view, at = memoryview(packed), 0
    member = zlib.decompressobj(31)
    while at < len(view) or member.unconsumed_tail:
        source = member.unconsumed_tail or view[at : at + piece]
        at += 0 if member.unconsumed_tail else len(source)
        yield member.decompress(source, piece)
        if member.eof:
            at -= len(member.unused_data)
            member = zlib.decompressobj(31)


def parsed(archive: bytes | Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """(headers, block, offset) of the records of an uncompressed archive, or of its pieces: no more than a record and a piece is held."""
    pieces = iter([archive] if isinstance(archive, bytes) else archive)
    held, start, at = bytearray(), 0, 0  # held[start:] is what is not read yet, at is its offset in the archive

    def more() -> bool:
        nonlocal start
        piece = next(pieces, None)
        if piece is None:
            return False
        if start:
            del held[:start]
            start = 0
        held.extend(piece)
        return True

    while True:
        while (end := held.find(b"\r\n\r\n", start)) < 0:
            if not more():
                if len(held) > start:
                    raise ValueError(f"no record at {at}")
                return
        lines = held[start:end].decode("utf-8", "surrogatepass").split(CRLF)
        if not lines[0].startswith("WARC/1."):
            raise ValueError(f"no record at {at}")
        head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        block, size = end + 4 - start, int(head["Content-Length"])
        while len(held) < start + block + size:
            if not more():
                raise ValueError(f"half a record at {at}")
        yield head, bytes(held[start + block : start + block + size]), at
        step = block + size + 4
        while len(held) < start + step and more():
            pass
        start, at = start + step, at + step


CAPTURES = pa.schema([("run", pa.string()), ("url_key", pa.string()), ("captured_at", pa.string()), ("page_id", pa.int64()), ("offset", pa.int64()), ("record_type", pa.string()), ("digest", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])
CAPTURES_DDL = "run string, url_key string, captured_at string, page_id long, offset long, record_type string, digest string, payload_bytes long, payload_digest string, refers_to long"


def order_of(row) -> tuple:
    """url key, timestamp, page, run and offset: total, so equal captures merge alike on every run."""
    return row[1], row[2], -1 if row[3] is None else row[3], row[0], row[4]


def read(spark, path: str) -> DataFrame:
    """A row for every record, archive by archive, each a sorted run.  Payload columns are null for revisits."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")

    def each(batches):
        for b in batches:
            for name, content in zip(b.column(0), b.column(1), strict=True):
                run, rows = name.as_py().rsplit("/", 1)[-1], []
                for head, block, at in parsed(inflated(content.as_py())):
                    payload = block.split(b"\r\n\r\n", 1)[1] if head["WARC-Type"] == RESPONSE else None
                    number = lambda key: int(head[key]) if head.get(key) else None  # noqa: E731, B023
                    rows.append((run, head["X-URL-Key"], head["WARC-Date"], number("X-Page"), at, head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha256:"), None if payload is None else len(payload), None if payload is None else hashlib.sha256(payload).hexdigest(), number("X-Refers-To-Page")))
                if rows:
                    rows.sort(key=order_of)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), CAPTURES.types, strict=True)], schema=CAPTURES)

    return files.mapInArrow(each, CAPTURES_DDL)


def merged(runs: list[list]) -> Iterator:
    """A loser tree over sorted runs: each inner node holds the loser of its match, so a step costs log2(k) comparisons."""
    k = max(1, len(runs))
    at = [0] * k
    heads: list = [order_of(r[0]) if r else None for r in runs] or [None]
    loses = lambda a, b: heads[a] is None or (heads[b] is not None and (heads[b], b) < (heads[a], a))
    tree = [-1] * k

    def enter(leaf: int) -> None:
        node, winner = (leaf + k) // 2, leaf
        while node:
            if tree[node] < 0:
                tree[node] = winner  # waits for its opponent
                return
            if loses(winner, tree[node]):
                winner, tree[node] = tree[node], winner
            node //= 2
        tree[0] = winner

    for leaf in range(k):
        enter(leaf)
    while heads[tree[0]] is not None:
        w = tree[0]
        yield runs[w][at[w]]
        at[w] += 1
        heads[w] = order_of(runs[w][at[w]]) if at[w] < len(runs[w]) else None
        node, winner = (w + k) // 2, w
        while node:
            if loses(winner, tree[node]):
                winner, tree[node] = tree[node], winner
            node //= 2
        tree[0] = winner


#: Captures of one merge task, about, and most such tasks.
RANGE_ROWS, RANGES = 50_000, 20_000


def index(captures: DataFrame, rows: int) -> DataFrame:
    """The captures with position: counted from 0 in the order of URL key, time and page."""
    order = ["url_key", "captured_at", "page_id", "run", "offset"]
    ranges = captures.repartitionByRange(min(RANGES, max(1, -(-rows // RANGE_ROWS))), *order).sortWithinPartitions("run", *order[:3], "offset")

    def each(batches):
        table = pa.Table.from_batches(list(batches), CAPTURES)  # a range: its rows stay in columns, only their keys are objects
        keys = [table[c].to_pylist() for c in ("run", "url_key", "captured_at", "page_id", "offset")]
        runs: dict[str, list] = {}
        for k, row in enumerate(zip(*keys, strict=True)):
            runs.setdefault(row[0], []).append((*row, k))
        took = pa.array([row[5] for row in merged([runs[k] for k in sorted(runs)])], pa.int64())
        for start in range(0, len(took), 10_000):
            part = table.take(took.slice(start, 10_000)).append_column("place", pa.array(range(start, min(start + 10_000, len(took))), pa.int64()))
            yield from part.combine_chunks().to_batches()

    # Ranges are drawn from a sample, so the merged rows are written before anything is counted by range.
    placed = written(ranges.mapInArrow(each, f"{CAPTURES_DDL}, place long").withColumn("merge_range", F.spark_partition_id()), "index")
    before = F.coalesce(F.sum("n").over(W.orderBy("merge_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = placed.groupBy("merge_range").agg(F.count("*").alias("n")).select("merge_range", before.alias("start"))  # a row a range, RANGES at most
    return placed.join(starts, "merge_range").withColumn("position", F.col("start") + F.col("place")).drop("merge_range", "place", "start")


def digests(pages: DataFrame) -> DataFrame:
    """Write every page, read the archives back, merge their index; a revisit's payload is that of its response."""
    spark = pages.sparkSession
    captures = written(read(spark, write(typed(pages), scratch(spark, "warc"))), "captures")
    ordered = index(captures, captures.count())
    revisited = captures.where(f"record_type = '{REVISIT}'").select(F.col("refers_to").alias("id"), F.col("digest").alias("d")).distinct()
    kept = captures.where(f"record_type = '{RESPONSE}'").join(revisited, (F.col("page_id") == F.col("id")) & (F.col("digest") == F.col("d")), "left_semi").groupBy(F.col("page_id").alias("id"), F.col("digest").alias("d")).agg(F.first("payload_bytes").alias("b"), F.first("payload_digest").alias("p"))
    kept = written(kept, "kept")  # no grouping right below the join: a response with many revisits can be split
    rows = ordered.join(kept, (F.col("refers_to") == F.col("id")) & (F.col("digest") == F.col("d")), "left")
    return rows.select("page_id", F.coalesce("payload_bytes", "b").alias("payload_bytes"), F.coalesce("payload_digest", "p").alias("payload_digest"), "record_type", "refers_to", "url_key", "captured_at", "position")
