"""Telephony audio columns: mu-law, A-law and IMA ADPCM in WAV, expanded and stored as resampled PCM.

The stored form is a mono 8 kHz WAV file.  mu-law and A-law carry one sample a byte and expand by 256-entry
lookup tables.  IMA ADPCM carries two samples a byte in blocks of 196 bytes (4 of header, 192 of nibbles); the
blocks are independent, so decoding walks the 384 nibbles of a block once for all blocks of a file or batch.

Files and PCM are columns: `stored` makes the files, `decoded` reads them back and adds the PCM.  A task holds PORTION
bytes of texts or files at a time, or one longer text, with what is made of them.

Defined results: null text is empty text; an empty text is one unit of blanks; null media gives null results;
media that is not such a WAV raises ValueError in `read_wav` and gives null results in `decoded`.
Texts of any length are cut into pieces for decoding, never shortened; PCM of more than MOST_PCM bytes is no single value but a
table of SEGMENT bytes a row (`segments`), which `digests` writes to the shared folder and names in pcm_table; its features are complete all the same.  Equal bytes give equal results; repeated rows stay; an empty table gives no rows.
`decoded` keeps other columns and replaces those it adds; `stored` reads its two columns only.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, written

UNIT, HEADER, RATE, OUT_RATE = 192, 4, 8000, 16000
ULAW, ALAW, IMA = "ulaw", "alaw", "ima"
#: WAVE format tags, fixed by the container's registry.
TAGS = {ALAW: 6, ULAW: 7, IMA: 17}
CODECS = {v: k for k, v in TAGS.items()}
#: IMA ADPCM index adjustments and step sizes, fixed by the format.
INDEX_STEP = np.array([-1, -1, -1, -1, 2, 4, 6, 8, -1, -1, -1, -1, 2, 4, 6, 8], np.int32)
STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118,
    130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060,
    1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132,
    7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767], np.int32)
#: Samples that are expanded at a time.
PIECE = 1 << 20
#: Bytes of texts or files that a task turns into rows at a time.
PORTION = 1 << 20
#: PCM of more bytes is kept in segments.
MOST_PCM, SEGMENT = 1 << 26, 1 << 23
#: Bytes of PCM that a byte of payload becomes.
EXPANDS = {ULAW: 4, ALAW: 4, IMA: 8}


def ulaw_table() -> np.ndarray:
    """G.711 mu-law: byte -> 16-bit sample."""
    b = ~np.arange(256, dtype=np.int32) & 0xFF
    size = (((b & 0x0F) << 3) + 0x84 << (b >> 4 & 7)) - 0x84
    return np.where(b & 0x80, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    """G.711 A-law: byte -> 16-bit sample."""
    b = np.arange(256, dtype=np.int32) ^ 0x55
    exponent, size = b >> 4 & 7, (b & 0x0F) << 4
    size = np.where(exponent == 0, size + 8, size + 0x108 << np.maximum(exponent - 1, 0))
    return np.where(b & 0x80, size, -size).astype(np.int16)


TABLES = {ULAW: ulaw_table(), ALAW: alaw_table()}
#: (step index, nibble) -> signed difference, and -> next step index.
_NIBBLE = np.arange(16)
_DIFF = (STEPS[:, None] >> 3) + np.where(_NIBBLE & 1, STEPS[:, None] >> 2, 0) + np.where(_NIBBLE & 2, STEPS[:, None] >> 1, 0) + np.where(_NIBBLE & 4, STEPS[:, None], 0)
DIFF = np.where(_NIBBLE & 8, -_DIFF, _DIFF).astype(np.int32).ravel()
NEXT = (np.clip(np.arange(89)[:, None] + INDEX_STEP, 0, 88) * 16).astype(np.int32).ravel()


def payload_of(text: str | None) -> tuple[int, bytes]:
    """UTF-8 bytes of the text, blanks appended up to a positive multiple of UNIT."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw.ljust(max(1, -(-len(raw) // UNIT)) * UNIT, b" ")


def codec_for(payload: bytes) -> str:
    """The codec depends on the bytes alone, so equal texts are stored alike."""
    return (ULAW, ALAW, IMA)[zlib.crc32(payload) % 3]


def wav(payload: bytes, codec: str) -> bytes:
    """A WAV file whose sample bytes (or nibble bytes of the ADPCM blocks) are the payload."""
    data, block, samples = payload, 1, len(payload)
    if codec == IMA:
        block, samples = HEADER + UNIT, len(payload) // UNIT * (2 * UNIT + 1)
        blocks = np.zeros((len(payload) // UNIT, block), np.uint8)
        blocks[:, HEADER:] = np.frombuffer(payload, np.uint8).reshape(-1, UNIT)
        data = blocks.tobytes()
    extra = struct.pack("<HH", 2, 2 * UNIT + 1) if codec == IMA else struct.pack("<H", 0)
    fmt = struct.pack("<HHIIHH", TAGS[codec], 1, RATE, RATE * block // (2 * UNIT + 1) if codec == IMA else RATE, block, 4 if codec == IMA else 8) + extra
    chunks = b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"fact" + struct.pack("<II", 4, samples) + b"data" + struct.pack("<I", len(data)) + data + b"\0" * (len(data) & 1)
    return b"RIFF" + struct.pack("<I", 4 + len(chunks)) + b"WAVE" + chunks


def read_wav(media: bytes) -> tuple[str, int, bytes]:
    """(codec, block size, data) of a stored file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, codec, block = 12, None, 1
    while at + 8 <= len(media):
        name, size = media[at : at + 4], int.from_bytes(media[at + 4 : at + 8], "little")
        if name == b"fmt ":
            tag, block = struct.unpack_from("<H10xH", media, at + 8)
            codec = CODECS.get(tag)
        if name == b"data" and codec:
            return codec, block, media[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    raise ValueError("no telephony samples")


def payload_back(media: bytes) -> bytes:
    codec, block, data = read_wav(media)
    return np.frombuffer(data, np.uint8).reshape(-1, block)[:, HEADER:].tobytes() if codec == IMA else data


def ima_decode(data: bytes, block: int) -> np.ndarray:
    """All blocks at once: step k of every block is one numpy operation."""
    rows = np.frombuffer(data, np.uint8).reshape(-1, block)
    value = rows[:, 0].astype(np.int32) | rows[:, 1].astype(np.int8).astype(np.int32) << 8
    index = np.minimum(rows[:, 2], 88).astype(np.int32) * 16
    codes = np.ascontiguousarray(rows[:, HEADER:].T)
    out = np.empty((2 * (block - HEADER) + 1, len(rows)), np.int16)
    out[0] = value
    for k, byte in enumerate(codes):
        for half, nibble in enumerate((byte & 15, byte >> 4)):
            at = index + nibble
            value = np.clip(value + DIFF[at], -32768, 32767)
            index = NEXT[at]
            out[2 * k + 1 + half] = value
    return out.T.ravel()


def expand(media: bytes) -> Iterator[np.ndarray]:
    """Pieces of the file's 16-bit samples."""
    codec, block, data = read_wav(media)
    step = PIECE // (2 * block) * block or block
    for at in range(0, len(data), step):
        part = data[at : at + step]
        yield ima_decode(part, block) if codec == IMA else TABLES[codec][np.frombuffer(part, np.uint8)]


def expanded(files: list[bytes | None]) -> Iterator[Iterator[np.ndarray] | None]:
    """`expand` of every file (None where it can't be read); the blocks of short ADPCM files are decoded together."""
    at = 0
    while at < len(files):
        end, blocks = at, 0  # files[at:end] hold up to PIECE bytes of short files
        while end < len(files) and (end == at or blocks + len(files[end] or b"") <= PIECE):
            blocks += len(files[end] or b"")
            end += 1
        parts = []
        for raw in files[at:end]:
            try:
                parts.append(None if raw is None else read_wav(raw))
            except ValueError:
                parts.append(None)
        short = [k for k, x in enumerate(parts) if x and x[0] == IMA and x[1] == HEADER + UNIT and len(x[2]) <= PIECE]
        samples = ima_decode(b"".join(parts[k][2] for k in short), HEADER + UNIT) if short else None
        used = 0
        for k, x in enumerate(parts):
            if k in short:
                n = len(x[2]) // x[1] * (2 * UNIT + 1)
                yield iter([samples[used : used + n]] if n else [])
                used += n
            else:
                yield expand(files[at + k]) if x else None
        at = end


#: Half-band interpolator by windowed sinc, in 1/32768; sums to 32768.
_TAPS = np.sinc(np.arange(-3.5, 4)) * np.hamming(8)
TAPS = np.round(_TAPS / _TAPS.sum() * 32768).astype(np.int64)


def resampled(pieces: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """8 kHz to 16 kHz: the samples as they are, and between them the interpolated ones; ends count as silence."""
    held = np.zeros(3, np.int16)
    last = None
    for piece in pieces:
        if last is not None:
            yield _doubled(held, last, piece[:4])
            held = np.concatenate([held, last])[-3:]
        last = piece
    if last is not None:
        yield _doubled(held, last, np.zeros(4, np.int16))


def _doubled(before: np.ndarray, x: np.ndarray, after: np.ndarray) -> np.ndarray:
    padded = np.concatenate([before, x, after, np.zeros(4 - len(after), np.int16)]).astype(np.int32)
    mid = np.zeros(len(x), np.int64)
    for k, tap in enumerate(TAPS):
        mid += tap * padded[k : k + len(x)]
    out = np.empty(2 * len(x), np.int16)
    out[0::2] = x
    out[1::2] = np.clip(mid + 16384 >> 15, -32768, 32767)
    return out


def features(codec: str, pieces: Iterator[np.ndarray], keep: bool = False) -> tuple[str, bytes | None]:
    """Features of a file's resampled samples, and these as bytes if asked for."""
    n = energy = crossings = peak = crc = 0
    sign, kept = None, []
    for y in resampled(pieces):
        wide = y.astype(np.int64)
        n += len(y)
        energy += int(np.dot(wide, wide))
        peak = max(peak, int(np.abs(wide).max(initial=0)))
        negative = np.signbit(wide.astype(np.float32))
        crossings += int(np.count_nonzero(negative[1:] != negative[:-1])) + int(sign is not None and bool(negative[0]) != sign)
        sign = bool(negative[-1])
        raw = y.astype("<i2").tobytes()
        crc = zlib.crc32(raw, crc)
        if keep:
            kept.append(raw)
    text = f"codec={codec};rate={OUT_RATE};samples={n};rms={(energy / max(n, 1)) ** 0.5:.4f};peak={peak};crossings={crossings};pcm_crc32={crc}"
    return text, b"".join(kept) if keep else None


def portions(b: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose texts or files hold about PORTION bytes, a longer one by itself."""
    upto = np.cumsum(np.nan_to_num(pc.binary_length(b.column(column)).to_numpy(zero_copy_only=False)))
    start = 0
    while start < b.num_rows:
        end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + PORTION, side="right")))
        yield b.slice(start, end - start)
        start = end


def stored(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, media): every text as a telephony file."""

    def each(batches):
        for b in batches:
            for part in portions(b, 1):
                made = [payload_of(x) for x in part.column(1).to_pylist()]
                files = [wav(payload, codec_for(payload)) for _, payload in made]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([n for n, _ in made], pa.int64()), pa.array(files, pa.binary())], ["key", "n_bytes", "media"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")).mapInArrow(each, f"key {kind}, n_bytes long, media binary").withColumnRenamed("key", key)


#: What is known of a file once it is read: its payload, the file itself, its samples.
READ = {"payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string(), "pcm": pa.binary()}
READ_DDL = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, pcm binary"


def _read(raw: bytes | None, pieces: Iterator[np.ndarray] | None) -> tuple:
    if pieces is None:
        return (None,) * len(READ)
    back, codec = payload_back(raw), read_wav(raw)[0]
    feature, pcm = features(codec, pieces, keep=EXPANDS[codec] * len(back) <= MOST_PCM)
    return len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(raw), hashlib.sha256(raw).hexdigest(), feature, pcm


def decoded(files: DataFrame, media: str = "media") -> DataFrame:
    """files with the columns of READ: pcm is 16-bit little-endian mono at OUT_RATE; all null where a file can't be read."""
    kept = [c for c in files.columns if c not in READ and c != media]

    def each(batches):
        for b in batches:
            for part in portions(b, 0):
                raw = part.column(0).to_pylist()
                rows = [_read(x, pieces) for x, pieces in zip(raw, expanded(raw), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array([r[k] for r in rows], t) for k, t in enumerate(READ.values()))], [*part.schema.names, *READ])

    rows = files.select(F.col(f"`{media}`").alias("__media"), *[F.col(f"`{c}`").alias(f"__{k}") for k, c in enumerate(kept)])
    out = rows.mapInArrow(each, ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in rows.schema] + [READ_DDL]))
    return out.select(*[F.col(f"__{k}").alias(c) for k, c in enumerate(kept)], F.col("__media").alias(media), *READ)


def segments(files: DataFrame, media: str = "media", key: str = "doc_id") -> DataFrame:
    """(key, media_sha256, part, pcm): the PCM of every file in parts of SEGMENT bytes, whatever its length; none of a file that can't be read."""

    def each(batches):
        for b in batches:
            for k in range(b.num_rows):
                raw = b.column(1)[k].as_py()
                (pieces,) = expanded([raw])
                if pieces is None:
                    continue
                sha, part, held, size = hashlib.sha256(raw).hexdigest(), 0, [], 0
                row = lambda pcm, part: pa.RecordBatch.from_arrays([b.column(0).slice(k, 1), pa.array([sha]), pa.array([part], pa.int64()), pa.array([pcm], pa.binary())], ["key", "media_sha256", "part", "pcm"])  # noqa: E731, B023
                for y in resampled(pieces):
                    held.append(y.astype("<i2").tobytes())
                    size += len(held[-1])
                    if size >= SEGMENT:
                        whole = b"".join(held)
                        for at in range(0, size - SEGMENT + 1, SEGMENT):
                            yield row(whole[at : at + SEGMENT], part)
                            part += 1
                        held, size = [whole[size - size % SEGMENT :]], size % SEGMENT
                if size:
                    yield row(b"".join(held), part)

    kind = files.schema[key].dataType.simpleString()
    return files.select(F.col(f"`{key}`"), F.col(f"`{media}`")).mapInArrow(each, f"key {kind}, media_sha256 string, part long, pcm binary").withColumnRenamed("key", key)


def digests(docs: DataFrame) -> DataFrame:
    """Every text stored as a file, read back from the table that holds it, expanded and resampled: its digests, the file and its PCM,
    or the table that holds this in segments."""
    files = written(stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")), "media")
    long, place = files.where(F.col("n_bytes") > MOST_PCM // max(EXPANDS.values()) - UNIT), F.lit(None).cast("string")
    if long.limit(1).count():
        path = scratch(docs.sparkSession, "pcm")
        segments(long).write.parquet(path)
        place = F.when(F.col("pcm").isNull(), path)
    rows = decoded(files).withColumn("pcm_table", place)
    return rows.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "media", "pcm", "pcm_table")
