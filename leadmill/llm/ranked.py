"""Ranked lexical search as a blocked sparse matrix product.

Scores are the product of two sparse matrices: item by term (how often the item asks for the term) and term by document
(int64 impacts).  A first pass over the documents counts what the impacts need (documents with terms, all terms, documents
holding each term); a second one reads them again where they lie.  A task cuts its documents into blocks of BLOCK, builds the
block's term rows as compressed arrays, and merges, for every item, the rows of its terms (Gustavson): products are added into
the item's row of the block, in chunks of TOGETHER.  Of every block only documents that can reach an item's best `top` stay, so
a task returns at most `top` rows an item, and these are reduced by salted windows and then by item.  Neither postings nor
scores of all documents are ever a table.

The item matrix goes to the tasks in parts of at most MOST entries (or one item, where that alone is larger); more items mean more
passes over the documents.

score = sum over the item's terms of times * w * ((1000000000 * tf) div (1000 * tf + 20 * m)), with w = floor(1000 * ln((2N + 2) /
(2df + 1))) and m = 50 + ((50 * n * N) div L), all integers but the logarithm.

Defined results: terms are runs of ASCII letters and digits and of all characters beyond ASCII, with only A-Z lower-cased; null and
empty texts, and those of separators alone, have none, and are not counted in N.  Rows of one item_id are one item, whose terms
are those of all its rows; a null item_id is an item as well.  Documents are rows: repeated ones are counted and ranked
each for itself.  Equal scores rank by doc_id, null last.  Items without a term that any document holds give no rows, and so do
empty tables.  Texts are read whole, in pieces of PIECE bytes; further columns are not read.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import union_all, written

TOP = 50
#: Entries (item, term) that go to the tasks at once, documents in a block, and products that are added at once.
MOST, BLOCK, TOGETHER = 1 << 18, 512, 1 << 20
#: Bytes of text whose terms are held at a time.
PIECE = 1 << 20
#: Parts of an item's candidates in the first reduction.
SALTS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: What stands between terms becomes a blank, A-Z become a-z.
CUT = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()
BLANK = re.compile(rb"[^0-9A-Za-z\x80-\xFF]")
DOCS, TERMS = -1, -2


def item_terms(items: DataFrame, once: bool) -> DataFrame:
    """(item_id, term, times): how often an item asks for each of its terms."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    terms = items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(F.regexp_extract_all(text, F.lit(TERM), F.lit(0))).alias("term"))
    return terms.groupBy("item_id", "term").agg((F.lit(1).cast("long") if once else F.count("*")).alias("times"))


def item_blocks(terms: DataFrame) -> list[DataFrame]:
    """The written item terms in blocks of whole items, of at most MOST entries, or of one item."""
    own = written(terms.groupBy("item_id").agg(F.count("*").alias("k")), "items")
    total = own.agg(F.sum("k")).first()[0] or 0
    if total <= MOST:
        return [terms] if total else []
    blocks = 2 * math.ceil(total / MOST)
    of = lambda n: F.pmod(F.xxhash64("item_id", F.lit(3)), F.lit(n))
    while own.groupBy(of(blocks).alias("b")).agg(F.sum("k").alias("k"), F.count("*").alias("n")).where((F.col("k") > MOST) & (F.col("n") > 1)).limit(1).count():
        blocks *= 2
    return [terms.where(of(blocks) == b) for b in range(blocks)]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))


def pieces(raw: bytes):
    """The terms of a text, piece by piece; a piece ends between terms."""
    at = 0
    while True:
        end = len(raw)
        if end - at > PIECE:
            blank = BLANK.search(raw, at + PIECE)
            end = blank.end() if blank else end
        yield raw[at:end].translate(CUT).split()
        if end == len(raw):
            return
        at = end


class Postings:
    """Terms of some documents that the items ask for, and all terms counted."""

    def __init__(self, known: dict[bytes, int]):
        self.known, self.clear = known, self._clear
        self._clear()

    def _clear(self):
        self.ids, self.of, self.n, self.size = [], [], [], 0

    def add(self, raw: bytes) -> None:
        """The next document."""
        n, k = 0, len(self.n)
        for terms in pieces(raw):
            n += len(terms)
            found = np.fromiter((i for i in map(self.known.get, terms) if i is not None), np.int64)
            if len(terms):
                # counted per piece, so that a long text holds one entry a term and piece
                ids, times = np.unique(found, return_counts=True)
                self.ids.append(np.stack([ids, times]))
                self.of.append(np.full(len(ids), k))
        self.n.append(n)
        self.size += len(raw)

    def rows(self) -> tuple[np.ndarray, ...]:
        """(term, document, tf) sorted by term, and the number of terms of each document."""
        n = np.array(self.n, np.int64)
        if not self.ids:
            return *(np.zeros(0, np.int64) for _ in range(3)), n
        (ids, times), of = np.concatenate(self.ids, axis=1), np.concatenate(self.of)
        key, at = np.unique(ids * max(len(n), 1) + of, return_inverse=True)
        tf = np.zeros(len(key), np.int64)
        np.add.at(tf, at, times)
        return key // len(n), key % len(n), tf, n


def counted(docs: DataFrame, known: dict[bytes, int]) -> DataFrame:
    """(id, k): the documents holding each known term, and under DOCS and TERMS the documents with terms and all their terms."""

    def each(batches):
        df, total = np.zeros(len(known), np.int64), np.zeros(2, np.int64)
        held = Postings(known)

        def flush():
            term, _, _, n = held.rows()
            df[:] += np.bincount(term, minlength=len(known))
            total[:] += np.count_nonzero(n), n.sum()
            held.clear()

        for b in batches:
            for x in b.column(0):
                held.add(x.as_py())
                if len(held.n) >= BLOCK or held.size >= 4 * PIECE:
                    flush()
        flush()
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, [DOCS, TERMS])), pa.array(np.append(df[some], total))], ["id", "k"])

    return _texts(docs).select("text").mapInArrow(each, "id long, k long").groupBy("id").agg(F.sum("k").alias("k"))


def merged_rows(first: np.ndarray, last: np.ndarray, at: np.ndarray, times: np.ndarray, doc: np.ndarray, value: np.ndarray, out: np.ndarray) -> None:
    """Add, into row at[e] of out, the values in the stretch [first[e], last[e]) of the term rows, times times[e]."""
    size = last - first
    keep = size > 0
    first, size, at, times = first[keep], size[keep], at[keep], times[keep]
    upto, flat, width = np.cumsum(size), out.reshape(-1), out.shape[1]
    begin = 0
    while begin < len(size):
        done = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, done + TOGETHER, "right")))
        k = size[begin:end]
        place = np.repeat(first[begin:end] - np.cumsum(k) + k, k) + np.arange(k.sum())
        np.add.at(flat, np.repeat(at[begin:end] * width, k) + doc[place], value[place] * np.repeat(times[begin:end], k))
        begin = end


class Best:
    """The `top` best documents of every item, met block by block."""

    def __init__(self, items: int, top: int):
        self.items, self.top = items, top
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.null = np.zeros(0, bool)
        self.least = np.ones(items, np.int64)

    def meet(self, item, score, doc, null) -> None:
        item, score, doc, null = (np.concatenate(x) for x in ((self.item, item), (self.score, score), (self.doc, doc), (self.null, null)))
        by = np.lexsort((doc, null, -score, item))
        item, score, doc, null = item[by], score[by], doc[by], null[by]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        full = rank == self.top - 1
        self.least[item[full]] = score[full]
        keep = rank < self.top
        self.item, self.score, self.doc, self.null = item[keep], score[keep], doc[keep], null[keep]


def scored(docs: DataFrame, known: dict[bytes, int], weight: np.ndarray, n_docs: int, n_terms: int, entries: tuple[np.ndarray, ...], items: int, top: int) -> DataFrame:
    """(item, doc_id, score): of every task, the `top` best of its documents for each item."""
    item, term, times = entries  # sorted by item
    lanes = 256  # items whose rows of a block are merged together

    def each(batches):
        held, ids, null, best = Postings(known), [], [], Best(items, top)

        def flush():
            of, doc, tf, n = held.rows()
            exact = n if 50 * int(n.max()) * n_docs < 1 << 62 else n.astype(object)  # beyond 64 bits, in Python's numbers
            m = 50 + ((50 * exact * n_docs) // n_terms).astype(np.int64)
            value = weight[of] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
            cuts = np.searchsorted(of, np.arange(len(known) + 1))
            number, missing = np.array(ids, np.int64), np.array(null, bool)
            for low in range(0, items, lanes):
                a, z = np.searchsorted(item, (low, low + lanes))
                out = np.zeros((min(lanes, items - low), len(n)), np.int64)
                merged_rows(cuts[term[a:z]], cuts[term[a:z] + 1], item[a:z] - low, times[a:z], doc, value, out)
                row, column = np.nonzero(out >= best.least[low : low + len(out), None])
                if len(row):
                    best.meet(row + low, out[row, column], number[column], missing[column])
            held.clear()
            ids.clear()
            null.clear()

        for b in batches:
            for d, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                held.add(x.as_py())
                ids.append(0 if d is None else d)
                null.append(d is None)
                if len(ids) >= BLOCK or held.size >= 4 * PIECE:
                    flush()
        if ids:
            flush()
        yield pa.RecordBatch.from_arrays([pa.array(best.item), pa.array(best.doc, mask=best.null), pa.array(best.score)], ["item", "doc_id", "score"])

    return _texts(docs).mapInArrow(each, "item long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, once: bool = True) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's `top` best documents with a score above 0; once: an item asks once for each of its terms."""
    spark = docs.sparkSession
    found = []
    for block in item_blocks(written(item_terms(items, once), "terms")):
        t = block.toArrow()  # bounded by item_blocks
        names, term = np.unique(np.array(t["term"].to_pylist(), object), return_inverse=True)
        known = {w.encode(): k for k, w in enumerate(names.tolist())}
        ids = t["item_id"].to_pylist()
        distinct = sorted(set(ids), key=lambda x: (x is None, x or 0))
        place = {x: k for k, x in enumerate(distinct)}
        item = np.array([place[x] for x in ids], np.int64)
        by = np.argsort(item, kind="stable")
        entries = item[by], term.reshape(-1)[by], t["times"].to_numpy()[by]
        counts = {r.id: r.k for r in counted(docs, known).collect()}  # a row a known term
        n_docs, n_terms = counts.get(DOCS, 0), counts.get(TERMS, 0)
        if not n_docs:
            continue
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counts.get(k, 0) + 1))) for k in range(len(known))], np.int64)
        best = scored(docs, known, weight, n_docs, n_terms, entries, len(distinct), top)
        names = spark.createDataFrame(pa.table({"item": pa.array(range(len(distinct)), pa.int64()), "item_id": pa.array(distinct, pa.int64())}))
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        salted = W.partitionBy("item", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).orderBy(*order)
        best = best.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
        best = best.withColumn("rank", F.row_number().over(W.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
        found.append(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return union_all(found)


def digests(docs: DataFrame, items: DataFrame) -> DataFrame:
    return ranked(docs, items)
