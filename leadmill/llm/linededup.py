"""Line dedup by winnowing over line hashes, extended to maximal repeated runs of words.

Line feeds move when a text is wrapped anew, and passages begin and end inside lines; so a line here is LINE words in a
row, one from every word on, and line feeds are white space.  A run of words counts as a repeat from MIN_WORDS words
on.  Every stretch of MIN_WORDS words is a window; the least line hash in it is its fingerprint (ties: the last line).
Fingerprints depend on a window's words alone, so a run of MIN_WORDS words that occurs twice has a fingerprint in both
places: none is missed.

The windows in a row that select one line are kept together as one row: the fingerprint, its place, and a hash of all
words these windows cover, the context.  Fingerprints that occur once are dropped by a grouped count.  The others are
joined, and matches are extended both ways in two steps.  From here on a place is one number: documents in their order take
as many numbers as they have words, and one, so the least place is the first one.

1. Places whose whole contexts agree: each is joined to the first of them, a grouped minimum, so a passage in a third
   of all documents costs a row a task and no pairs are made.  All windows of a context that is not first have
   occurred before.
2. Where a fingerprint has several contexts, matches end within them.  There the first place of every context (and
   those that follow in the same document) is cut into its single windows, and each is joined to its first place.

Windows that have occurred before are deleted, and overlapping ones are one run.  A run of MIN_WORDS words or more that
occurs earlier is the union of its windows, so what goes are the maximal repeated runs, to the word and however long.

Defined results: first means the least doc_id (null last), then text hash, then place.  Where a window overlaps its
first place in the same document, the first place stays.  Words are compared exactly; null texts stay null, and null
and empty texts have no words; runs under MIN_WORDS words stay; rows equal in doc_id and text are one document and are
treated alike; an empty table gives no rows.  A removed run takes the white space after it along; a document whose
every word goes has the empty text, and one that loses nothing keeps its text as it is.  Long texts are read whole, in
pieces of PIECE bytes that overlap by a window, so memory is bounded by PIECE.  Other columns stay; columns named
n_words, removed_words or removed are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACE, removed, written, written_at
from .licenses import shingles

MIN_WORDS, LINE = 50, 16
#: Bytes of text whose words are held at a time.
PIECE = 1 << 19
#: Windows that leave a task together.
TOGETHER = 1 << 16
WORD = r"[^\x20\x09-\x0D]++"
KEY = "doc_id long, h long"
SPAN = "array<struct<start: int, end: int>>"
#: An odd base of the polynomial hashes, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
BLANKS = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: The first k bytes of eight.
BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
MIX = np.uint64(0xD6E8FEB86659FD93)


def word_hashes(raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the words of some texts that lie one behind the other in raw and begin at cuts.

    A word is hashed eight bytes at a time, all words at once; every step is invertible, so words of up to eight bytes never
    share a hash with others of their length.
    """
    n = len(raw)
    word = ~BLANKS[raw]
    edge = np.zeros(n + 1, bool)
    edge[cuts] = True
    apart = np.empty(n + 1, bool)  # whether a word can't go on from the byte before
    apart[0] = apart[n] = True
    apart[1:n] = ~(word[1:] & word[:-1])
    apart |= edge
    start, end = np.flatnonzero(word & apart[:n]), np.flatnonzero(word & apart[1:]) + 1
    size = end - start
    lanes = np.ndarray((n + 1,), "<u8", np.append(raw, np.zeros(8, np.uint8)), strides=(1,))
    h = size.astype(np.uint64) * np.uint64(BASE)
    more, k = np.arange(len(start)), 0
    while len(more):
        x = (h[more] ^ (lanes[start[more] + k] & BYTES[np.minimum(size[more] - k, 8)])) * MIX
        h[more] = x ^ x >> np.uint64(32)
        k += 8
        more = more[size[more] > k]
    return h, np.diff(np.append(np.searchsorted(start, cuts), len(start)))


def word_groups(texts: pa.Array, least: int):
    """(rows, offsets, counts, words) of a column of texts: the word hashes of some rows together, and where in its text each row's words begin.

    Texts of more than PIECE bytes come by themselves, in pieces that overlap by least - 1 words, so every window lies in one piece.
    """
    column = texts.fill_null("").cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    size, row = np.diff(bounds), 0
    while row < len(column):
        if size[row] <= PIECE:
            end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + PIECE, "right")) - 1)
            words, counts = word_hashes(data[bounds[row] : bounds[end]], bounds[row:end] - bounds[row])
            yield np.arange(row, end), np.zeros(end - row, np.int64), counts, words
            row = end
            continue
        at, offset, held = int(bounds[row]), 0, np.zeros(0, np.uint64)
        while at < bounds[row + 1]:
            end = int(bounds[row + 1])
            if end - at > PIECE:
                found = at + PIECE
                while found < end and not (blanks := BLANKS[data[found : found + 4096]]).any():
                    found += 4096
                end = end if found >= end else min(end, found + int(blanks.argmax()) + 1)
            own, _ = word_hashes(data[at:end], np.zeros(1, np.int64))
            words = np.concatenate([held, own])
            yield np.array([row]), np.array([offset]), np.array([len(words)]), words
            kept = min(len(words), least - 1)
            at, offset, held = end, offset + len(words) - kept, words[len(words) - kept :]
        row += 1


def least_lines(lines: np.ndarray, width: int) -> np.ndarray:
    """For every place the position of the least of `width` hashes from there on, the last of equal ones."""
    value, at, held = lines, np.arange(len(lines)), 1
    while held < width:
        step = min(held, width - held)  # two stretches of `held`, overlapping where the width is no power of two
        right, right_at = value[step:], at[step:]
        value, at = value[: len(right)], at[: len(right)]
        take = right <= value
        value, at, held = np.where(take, right, value), np.where(take, right_at, at), held + step
    return at


class Sums:
    """Polynomial hashes of any stretch of words, equal for equal words wherever they stand."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.power, self.inverse = (np.cumprod(np.append(np.uint64(1), np.full(n, b, np.uint64))) for b in (BASE, INVERSE))
        self.sums = np.append(np.uint64(0), np.cumsum(words * self.power[:n]))

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64)
        x = (x ^ x >> np.uint64(32)) * MIX
        return (x ^ x >> np.uint64(32)).view(np.int64)


def prints(words: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(start, n, fingerprint, context) of every run of windows with one fingerprint; `ends` is each word's end of text."""
    line = min(LINE, least)
    if len(words) < least:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    lines = shingles(words, line)
    chosen = least_lines(lines[: len(words) - line + 1], least - line + 1)
    starts = np.flatnonzero(np.arange(len(chosen)) + least <= ends[: len(chosen)])
    new = np.flatnonzero(np.diff(chosen[starts], prepend=-1) != 0)
    first, n = starts[new], np.diff(np.append(new, len(starts)))
    return first, n, lines[chosen[first]].view(np.int64), Sums(words)(first, first + n - 1 + least)


PRINT = pa.struct([("g", pa.int64()), ("c", pa.int64()), ("start", pa.int32()), ("n", pa.int32())])
PRINTS = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("upto", pa.int64()), ("prints", pa.list_(PRINT))])
WINDOWS = pa.schema([("g", pa.int64()), ("w", pa.int64()), ("doc", pa.int64()), ("start", pa.int32())])
NUMBERS = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("n", pa.int64()), ("range", pa.int32()), ("doc", pa.int64())])


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, h, text): documents are told apart by number and text hash."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"), text.alias("text"))


def print_table(docs: DataFrame, least: int) -> DataFrame:
    """(doc_id, h, upto, prints): of every piece of a text, the words up to its end, and its fingerprints with place and context."""

    def each(batches):
        for b in batches:
            ids = [c.to_numpy(zero_copy_only=False) if not c.null_count else None for c in b.columns[:2]]
            for rows, offsets, counts, words in word_groups(b.column(2), least):
                edges = np.append(0, np.cumsum(counts))
                start, n, g, c = prints(words, np.repeat(edges[1:], counts), least)
                cuts = np.searchsorted(start, edges)
                at = (start + np.repeat(offsets - edges[:-1], np.diff(cuts))).astype(np.int32)
                found = pa.StructArray.from_arrays([pa.array(g), pa.array(c), pa.array(at), pa.array(n.astype(np.int32))], fields=list(PRINT))
                lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), found)
                own = [pa.array(x[rows]) if x is not None else b.column(k).take(pa.array(rows)) for k, x in enumerate(ids)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(offsets + counts), lists], schema=PRINTS)

    return _keyed(docs).mapInArrow(each, f"{KEY}, upto long, prints array<struct<g: long, c: long, start: int, n: int>>")


def numbered(table: DataFrame) -> DataFrame:
    """(doc_id, h, n, doc), written: every document of a `print_table` with its words, and the number of its first word in the order of all documents.

    Ranges are sorted by themselves, and each starts behind the words of those before it; what one task sees of all ranges is a sum each.
    """
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("h")]
    docs = table.groupBy("doc_id", "h").agg(F.max("upto").alias("n")).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id())

    def each(batches):
        upto = 0
        for b in batches:
            ends = upto + np.cumsum(b.column(2).to_numpy() + 1)  # one more, so that documents without words differ as well
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.append(upto, ends)[:-1], pa.int64())], schema=NUMBERS)
            upto = int(ends[-1]) if len(ends) else upto

    found = written(docs.mapInArrow(each, f"{KEY}, n long, range int, doc long"), "numbers")
    sums = found.groupBy("range").agg(F.sum(F.col("n") + 1).alias("all"))  # a row a range
    starts = sums.select("range", F.coalesce(F.sum("all").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    return written(found.join(F.broadcast(starts), "range").select("doc_id", "h", "n", (F.col("first") + F.col("doc")).alias("doc")), "documents")


def single_windows(rows: DataFrame, least: int) -> DataFrame:
    """(g, w, doc, start) of (doc, text, at): a hash of every window of the runs in `at` (g, start, n)."""

    def each(batches):
        for b in batches:
            lists = b.column(2)
            g, first, n = (lists.values.field(k).to_numpy(zero_copy_only=False) for k in ("g", "start", "n"))
            bounds, doc = lists.offsets.to_numpy(), b.column(0).to_numpy()
            for rows_, offsets, counts, words in word_groups(b.column(1), least):
                # All windows of these rows, one by one; those that this piece of a long text holds.
                a, z = bounds[rows_[0]], bounds[rows_[-1] + 1]
                many = n[a:z].astype(np.int64)
                start = np.repeat(first[a:z] - np.cumsum(many) + many, many) + np.arange(many.sum())
                fingerprint = np.repeat(g[a:z], many)
                of = np.repeat(np.repeat(np.arange(len(rows_)), np.diff(bounds[rows_[0] : rows_[-1] + 2])), many)
                here = (start >= offsets[of]) & (start + least <= offsets[of] + counts[of])
                start, fingerprint, of = start[here], fingerprint[here], of[here]
                edges = np.append(0, np.cumsum(counts))
                place, sums = start - offsets[of] + edges[of], Sums(words)
                for low in range(0, len(start), TOGETHER):
                    part = slice(low, low + TOGETHER)
                    yield pa.RecordBatch.from_arrays([pa.array(fingerprint[part]), pa.array(sums(place[part], place[part] + least)), pa.array(doc[rows_[of[part]]]), pa.array(start[part].astype(np.int32))], schema=WINDOWS)

    return rows.select("doc", "text", "at").mapInArrow(each, "g long, w long, doc long, start int")


def repeated(docs: DataFrame, table: DataFrame, numbers: DataFrame, least: int = MIN_WORDS) -> tuple[DataFrame, list[str]]:
    """(doc, removed) of documents that lose words: removed has the maximal runs, words from 0, ends exclusive; table is their `print_table`, numbers
    are its documents.  Also the paths of what this frame reads, for removal once it is written."""
    same = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.h") == F.col(f"{b}.h"))
    rows = table.alias("t").join(numbers.alias("d"), same("t", "d")).select("d.doc", F.inline("t.prints"))
    # Grouped sides are written before they are joined, so a hot key of the join can be split.
    again = table.select(F.inline("prints")).groupBy("g").agg(F.count("*").alias("k"), F.min("c").alias("low"), F.max("c").alias("high")).where("k > 1")
    again, again_path = written_at(again.select("g", (F.col("low") != F.col("high")).alias("several")), "again")
    rows, rows_path = written_at(rows.join(again, "g"), "repeated")
    place = F.col("doc") + F.col("start")
    here = F.col("first") >= F.col("doc")  # the first place is never behind this one
    begin = F.when(F.col("here"), F.greatest(F.col("start").cast("long"), F.col("first") - F.col("doc") + least)).otherwise(F.col("start")).cast("int").alias("start")
    firsts, firsts_path = written_at(rows.groupBy("g", "c").agg(F.min(place).alias("first")), "first")
    met, met_path = written_at(rows.join(firsts, ["g", "c"]).withColumn("here", here), "met")
    for path in (again_path, rows_path, firsts_path):  # what follows reads met alone
        removed(docs.sparkSession, path)
    whole = met.where((~F.col("here")) | (~F.col("several") & (place != F.col("first")))).select("doc", begin, (F.col("start") + F.col("n") - 1 + least).alias("end"))
    # Matches that end within a context, window by window.
    wanted = met.where("here and several").groupBy("doc").agg(F.collect_set(F.struct("g", "start", "n")).alias("at"))
    wanted = written(wanted.join(numbers, "doc").select("doc_id", "h", "doc", "at"), "wanted").alias("a")
    texts = _keyed(docs).alias("t").join(wanted, same("t", "a")).select("a.doc", "t.text", "a.at")
    found, found_path = written_at(single_windows(texts, least), "windows")
    firsts, firsts_path = written_at(found.groupBy("g", "w").agg(F.min(place).alias("first"), F.count("*").alias("k")).where("k > 1").drop("k"), "first")
    later = found.join(firsts, ["g", "w"]).withColumn("here", here).where((~F.col("here")) | (place != F.col("first"))).select("doc", begin, (F.col("start") + least).alias("end"))
    # Windows that overlap or touch become runs.
    by = W.partitionBy("doc").orderBy("start", "end")
    runs = whole.unionByName(later).where("start < end").withColumn("upto", F.max("end").over(by.rowsBetween(W.unboundedPreceding, -1)))
    runs = runs.withColumn("run", F.count_if(F.col("upto").isNull() | (F.col("start") > F.col("upto"))).over(by.rowsBetween(W.unboundedPreceding, 0)))
    runs = runs.groupBy("doc", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("removed")), [met_path, found_path, firsts_path]


def deduplicated(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """docs with the repeated runs gone from text, and n_words, removed_words and removed (array<struct<start, end>>)."""
    kept = [c for c in docs.columns if c not in ("n_words", "removed_words", "removed")]
    # The row is a struct on the way, so its columns may have any name.
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("h", F.xxhash64(text))
    table, table_path = written_at(print_table(docs, least), "prints")
    numbers = numbered(table)
    lost, paths = repeated(docs, table, numbers, least)
    removed(docs.sparkSession, table_path)  # its rows that count are in other tables
    gone = numbers.join(lost, "doc", "left").select(F.col("doc_id").alias("gone_id"), F.col("h").alias("gone_h"), "n", F.col("removed").alias("spans"))
    gone = written(gone, "removed")  # so that a document in many rows can be split in the join
    for path in paths:
        removed(docs.sparkSession, path)
    rows = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("h") == F.col("gone_h")), "left")
    # Words with the white space behind them; what lies between the removed runs stays.
    rows = rows.withColumn("words", F.when(F.col("spans").isNotNull(), F.regexp_extract_all(text, F.lit(WORD + SPACE[:-1] + "*"), F.lit(0))))
    none, n = F.array().cast(SPAN), F.coalesce("n", F.lit(0)).cast("int")
    runs = F.coalesce("spans", none)
    left = F.zip_with(F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: r["end"])), F.concat(F.transform(runs, lambda r: r["start"]), F.array(n)), lambda a, b: F.slice("words", a + 1, b - a))
    count = F.aggregate(runs, F.lit(0).cast("long"), lambda k, r: k + r["end"] - r["start"])
    rows = rows.withColumns({"n_words": n.cast("long"), "removed_words": count, "removed": runs})
    lead = F.regexp_extract(text, "^" + SPACE[:-1] + "*", 0)
    new = F.when(F.col("removed_words") == 0, F.col("text")).when(F.col("removed_words") == F.col("n_words"), "").otherwise(F.concat(lead, F.array_join(F.flatten(left), "")))
    return rows.select(*[(new if c == "text" else F.col("row")[c]).alias(c) for c in kept], "n_words", "removed_words", "removed")


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, text, n_words, removed_words, removed): the runs that went as "start-end;..." in words from 0, ends exclusive."""
    spans = F.transform("removed", lambda r: F.concat(r["start"].cast("string"), F.lit("-"), r["end"].cast("string")))
    return deduplicated(docs.select("doc_id", "text")).withColumn("removed", F.array_join(spans, ";"))
