"""Token counts by rank-synchronous merging of ragged arrays.

The vocabulary is a byte-level BPE with word ends (a `tokenizers` file).  A text is cut at ASCII white space, which no
pre-token crosses; words that a task has not met are collected over many texts, normalized (NFC, lower case), cut into
pre-tokens and held as one ragged numpy array of symbols.  In a round every sequence finds the lowest rank among
its pairs, and all its places of that rank merge at once, left before right where they overlap; what survives the rounds is
counted.  A merge only makes pairs of higher rank than its own (`Merges` checks this of the file), so merging a rank at once
is merging one by one.  Pre-tokens of more than LONG symbols go rank by rank instead, by lists of places, so a round costs what it merges and not
the length of the sequence.  Only words with characters that are newer than this Python's Unicode are cut by the library, whose tables decide.

A task keeps the counts of the last words it met, at most KNOWN.  Texts are read whole in pieces of PIECE bytes, so memory is
bounded by a piece, or by the longest run without white space.  Nothing is shuffled; the vocabulary, some MB, goes along with the tasks.

Defined results: null and empty texts have no tokens; a null doc_id stays; repeated rows give equal rows; strings of special
tokens inside a text are one token each, as the library takes them by default; none are added; other columns are not
read; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import unicodedata
from bisect import insort
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, LONG, KNOWN = 2048, 256, 1_000_000
#: Bytes of text whose words are held at a time, and symbols that merge together.
PIECE, TOGETHER = 1 << 20, 1 << 18
BLANK = re.compile(rb"[\x20\x09-\x0D]")
#: Pre-tokens of the vocabulary's file (fixed values); white space is Unicode's.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+"
END = "</w>"
NONE = np.int64(1 << 40)


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves, the others from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(plain)))}
    return [chr(others.get(b, b)) for b in range(256)]


class Merges:
    """The vocabulary as arrays: symbols of bytes, pairs sorted by key, their ranks and what they become."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            d = json.load(f)
        model, ids = d["model"], d["model"]["vocab"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != END or model["continuing_subword_prefix"] or model["unk_token"]:
            raise ValueError("a byte-level BPE with word ends is needed")
        self.special = [t["content"] for t in d["added_tokens"]]
        self.cut = json.dumps(d | {"added_tokens": [], "model": {**model, "vocab": {}, "merges": []}})
        self.plain, self.last = (np.array([ids[c + end] for c in byte_symbols()], np.int64) for end in ("", END))
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made: dict[str, int] = {}
        for rank, (a, b) in enumerate(pairs):
            made[a + b] = rank  # the last rank that makes it
        if any(max(made.get(a, -1), made.get(b, -1)) >= rank for rank, (a, b) in enumerate(pairs)):
            raise ValueError("a merge needs what a later one makes")
        key = np.array([ids[a] << 20 | ids[b] for a, b in pairs], np.int64)
        order = np.argsort(key)
        self.key, self.rank, self.new = key[order], order.astype(np.int64), np.array([ids[a + b] for a, b in pairs], np.int64)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        want = a << 20 | b
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where(self.key[at] == want, self.rank[at], NONE)


def alternate(chain: np.ndarray) -> np.ndarray:
    """Of places in order, where chain says that one overlaps the place before it: those that merge, left before right."""
    n = np.arange(len(chain))
    return (n - np.maximum.accumulate(np.where(chain, 0, n))) % 2 == 0


def merged(symbols: np.ndarray, owner: np.ndarray, n: int, m: Merges) -> np.ndarray:
    """How many symbols survive in each of n sequences; owner is ascending."""
    counts = np.zeros(n, np.int64)
    while len(symbols):
        rank = np.full(len(symbols), NONE)
        rank[:-1] = np.where(owner[:-1] == owner[1:], m.ranks(symbols[:-1], symbols[1:]), NONE)
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        least = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.append(starts, len(symbols)))
        done = np.repeat(least == NONE, sizes)
        counts += np.bincount(owner[done], minlength=n)
        hit = np.flatnonzero((rank == np.repeat(least, sizes)) & ~done)
        hit = hit[alternate(np.diff(hit, prepend=-2) == 1)]
        symbols[hit] = m.new[rank[hit]]
        done[hit + 1] = True
        symbols, owner = symbols[~done], owner[~done]
    return counts


def merged_long(symbols: np.ndarray, m: Merges) -> int:
    """How many symbols of one long sequence survive, rank by rank over lists of places."""
    n = len(symbols)
    after, before, left = np.arange(1, n + 1), np.arange(-1, n - 1), n
    places: dict[int, list[np.ndarray]] = {}
    order: list[int] = []

    def add(at):
        at = at[(at >= 0) & (after[at] < n)]
        rank = m.ranks(symbols[at], symbols[np.minimum(after[at], n - 1)])
        at, rank = at[rank < NONE], rank[rank < NONE]
        by = np.argsort(rank, kind="stable")
        for part in np.split(by, np.flatnonzero(np.diff(rank[by])) + 1) if len(by) else ():
            r = int(rank[part[0]])
            if r not in places:
                places[r] = []
                insort(order, -r)
            places[r].append(at[part])

    add(np.arange(n - 1))
    while order:
        r = -order.pop()
        at = np.unique(np.concatenate(places.pop(r)))
        at = at[(symbols[at] >= 0) & (after[at] < n)]
        at = at[m.ranks(symbols[at], symbols[after[at]]) == r]  # pairs that have changed since are elsewhere
        if not len(at):
            continue
        at = at[alternate(np.concatenate([[False], after[at[:-1]] == at[1:]]))]
        gone = after[at]
        symbols[at], symbols[gone] = m.new[r], -1
        after[at] = after[gone]
        inside = after[at] < n
        before[after[at[inside]]] = at[inside]
        left -= len(at)
        add(np.unique(np.concatenate([at, before[at]])))
    return left


class Counter:
    """Tokens of words, batch by batch."""

    def __init__(self, m: Merges):
        self.m, self.known = m, {}
        self.split = re.compile("|".join(map(re.escape, m.special)) or r"(?!)")
        self.tokens, self.ascii = regex.compile(PATTERN), re.compile(ASCII_PATTERN)
        self.byte = {c: b for b, c in enumerate(byte_symbols())}

    @cached_property
    def library(self):
        """The library's own normalizer and pre-tokenizer, without vocabulary."""
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.m.cut)

    def unassigned(self, text: str) -> list[bytes]:
        """Pre-tokens of text with characters that this Python's Unicode lacks: what they are is a matter of the library's version."""
        normal = self.library.normalizer.normalize_str(text)
        return [bytes(map(self.byte.__getitem__, t)) for t, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def pretokens(self, text: str) -> tuple[int, list[bytes]]:
        """Special tokens in a word, and the pre-tokens of what lies between them."""
        parts = self.split.split(text)
        found: list[bytes] = []
        for p in parts:
            if p.isascii():
                found += map(str.encode, self.ascii.findall(p.lower()))
            elif "Cn" in map(unicodedata.category, p):
                found += self.unassigned(p)
            else:  # one character at a time, so no sigma is a final one
                found += map(str.encode, self.tokens.findall(unicodedata.normalize("NFC", p).replace("Σ", "σ").lower()))
        return len(parts) - 1, found

    def symbols(self, raw: bytes, ends: np.ndarray) -> np.ndarray:
        b = np.frombuffer(raw, np.uint8)
        s = self.m.plain[b]
        s[ends - 1] = self.m.last[b[ends - 1]]
        return s

    def learn(self, words: list[bytes]) -> None:
        at = 0
        while at < len(words):
            held, of, size, first = [], [], 0, at
            extra: list[int] = []
            while at < len(words) and size < TOGETHER:
                special, own = self.pretokens(words[at].decode())
                for t in own:
                    if len(t) > LONG:
                        special += merged_long(self.symbols(t, np.array([len(t)])), self.m)
                    else:
                        held.append(t)
                        of.append(at - first)
                        size += len(t)
                extra.append(special)
                at += 1
            counts = np.array(extra, np.int64)
            if held:
                sizes = np.fromiter(map(len, held), np.int64, len(held))
                alive = merged(self.symbols(b"".join(held), np.cumsum(sizes)), np.repeat(np.arange(len(held)), sizes), len(held), self.m)
                counts += np.bincount(of, alive, len(extra)).astype(np.int64)
            self.known.update(zip(words[first:at], counts.tolist(), strict=True))

    def __call__(self, texts: list[list[bytes]]) -> list[int]:
        """The tokens of some lists of words."""
        if len(self.known) > KNOWN:
            self.known.clear()
        new = set().union(*texts) - self.known.keys()
        self.learn(list(new))
        get = self.known.__getitem__
        return [sum(map(get, words)) for words in texts]


def pieces(raw: bytes):
    """The words of a text, in pieces that end at white space."""
    at = 0
    while True:
        end = len(raw)
        if end - at > PIECE:
            blank = BLANK.search(raw, at + PIECE)
            end = blank.end() if blank else end
        yield raw[at:end].split(), end - at
        if end == len(raw):
            return
        at = end


@cache
def merges(file: str) -> Merges:
    return Merges(file)


def default_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_counts(docs: DataFrame, file: str | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; file is the vocabulary, read on the driver."""
    m = merges(file or default_file())

    def each(batches):
        count = Counter(m)
        for b in batches:
            total, held, of, size = np.zeros(b.num_rows, np.int64), [], [], 0
            for k, x in enumerate(b.column(1)):
                for words, n in pieces(x.as_py()):
                    held.append(words)
                    of.append(k)
                    size += n
                    if size >= PIECE:
                        np.add.at(total, of, count(held))
                        held, of, size = [], [], 0
            if held:
                np.add.at(total, of, count(held))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.fromiter((len(x.as_buffer()) for x in b.column(1)), np.int64, b.num_rows)), pa.array(total)], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(each, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def digests(docs: DataFrame) -> DataFrame:
    return token_counts(docs)
