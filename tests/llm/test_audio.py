import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from leadmill.llm import audio


def test_tables_are_g711():
    # Known codes of the two laws.
    u, a = audio.TABLES[audio.ULAW], audio.TABLES[audio.ALAW]
    assert (u[0x00], u[0x80], u[0xFF], u[0x7F]) == (-32124, 32124, 0, 0)
    assert (a[0xD5], a[0x55], a[0xAA], a[0x2A]) == (8, -8, 32256, -32256)
    assert len(np.unique(np.abs(u.astype(int)))) == 128 and len(np.unique(a)) == 256


def slow_ima(block: bytes) -> list[int]:
    value, index = int.from_bytes(block[:2], "little", signed=True), min(block[2], 88)
    out = [value]
    for byte in block[audio.HEADER :]:
        for n in (byte & 15, byte >> 4):
            step = int(audio.STEPS[index])
            diff = (step >> 3) + (step >> 2 if n & 1 else 0) + (step >> 1 if n & 2 else 0) + (step if n & 4 else 0)
            value = max(-32768, min(32767, value - diff if n & 8 else value + diff))
            index = max(0, min(88, index + int(audio.INDEX_STEP[n])))
            out.append(value)
    return out


def test_ima_across_blocks_is_the_plain_decoder():
    rng = np.random.default_rng(0)
    blocks = rng.integers(0, 256, (7, audio.HEADER + audio.UNIT), dtype=np.uint8)
    blocks[:, 2] %= 89
    want = [x for b in blocks for x in slow_ima(b.tobytes())]
    assert audio.ima_decode(blocks.tobytes(), blocks.shape[1]).tolist() == want


@pytest.mark.parametrize("codec", [audio.ULAW, audio.ALAW, audio.IMA])
@pytest.mark.parametrize("size", [192, 192 * 40, 192 * 9000])
def test_round_trip_and_pieces(codec, size):
    payload = np.random.default_rng(size).integers(0, 256, size, dtype=np.uint8).tobytes()
    media = audio.wav(payload, codec)
    assert audio.payload_back(media) == payload
    whole, (pieces,) = np.concatenate(list(audio.expand(media))), audio.expanded([media])
    assert np.array_equal(whole, np.concatenate(list(pieces)))
    halves = audio.resampled(iter([whole[: len(whole) // 3], whole[len(whole) // 3 :]]))
    assert np.array_equal(np.concatenate(list(audio.resampled(iter([whole])))), np.concatenate(list(halves)))


def test_operator(spark):
    texts = [None, "", "a" * 192, "x" * 193, "é€" * 50_000, "a" * 192]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, media string")
    got = {r.doc_id: r for r in audio.digests(docs).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        padded = raw.ljust(max(1, -(-len(raw) // 192)) * 192, b" ")
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-16:]))
    assert got[2].asDict() | {"doc_id": 0} == got[5].asDict() | {"doc_id": 0} and got[2].pcm
    files = audio.stored(docs)
    assert {r.doc_id: (r.media, len(r.media), hashlib.sha256(r.media).hexdigest()) for r in files.collect()} == {k: (r.media, r.media_bytes, r.media_sha256) for k, r in got.items()}
    assert all(f"pcm_crc32={zlib.crc32(r.pcm)}" in r.feature for r in got.values())
    odd = spark.createDataFrame([(1, None, "a"), (2, bytearray(b"no wav"), "b"), (3, bytearray(b""), None)], "doc_id long, media binary, feature string").withColumn("and `more`", F.lit(1))
    back = audio.decoded(odd.withColumnRenamed("and `more`", "more"))
    assert back.columns == ["doc_id", "more", "media", *audio.READ] and all(r.pcm is None and r.feature is None for r in back.collect()) and back.count() == 3
    assert audio.digests(docs.limit(0)).count() == 0


def plain_features(payload: bytes, codec: str) -> str:
    """Expansion, interpolation and features sample by sample."""
    if codec == audio.IMA:
        x = [v for at in range(0, len(payload), audio.UNIT) for v in slow_ima(bytes(audio.HEADER) + payload[at : at + audio.UNIT])]
    else:
        x = [int(audio.TABLES[codec][b]) for b in payload]
    taps = [int(t) for t in audio.TAPS]
    y, at = [], lambda k: x[k] if 0 <= k < len(x) else 0
    for k, v in enumerate(x):
        y += [v, max(-32768, min(32767, (sum(t * at(k + j - 3) for j, t in enumerate(taps)) + 16384) >> 15))]
    crossings = sum((a < 0) != (b < 0) for a, b in zip(y, y[1:], strict=False))
    crc = zlib.crc32(struct.pack(f"<{len(y)}h", *y))
    return f"codec={codec};rate={audio.OUT_RATE};samples={len(y)};rms={(sum(v * v for v in y) / len(y)) ** 0.5:.4f};peak={max(map(abs, y))};crossings={crossings};pcm_crc32={crc}"


@pytest.mark.parametrize("codec", [audio.ULAW, audio.ALAW, audio.IMA])
def test_features_beside_plain_python(codec):
    payload = np.random.default_rng(4).integers(0, 256, 192 * 6, dtype=np.uint8).tobytes()
    feature, pcm = audio.features(codec, audio.expand(audio.wav(payload, codec)), keep=True)
    assert feature == plain_features(payload, codec) and len(pcm) % 4 == 0


def test_portions_bound_what_a_task_holds(spark, monkeypatch):
    b = pa.record_batch([pa.array(["a" * 400, None, "b" * 700, "c" * 5000, "", "d"])], ["t"])
    monkeypatch.setattr(audio, "PORTION", 1000)
    parts = [p.column(0).to_pylist() for p in audio.portions(b, 0)]
    assert [x for p in parts for x in p] == b.column(0).to_pylist() and all(len(p) == 1 or sum(len(x or "") for x in p) <= 1000 for p in parts)


def test_long_pcm_is_kept_in_segments(spark, monkeypatch):
    texts = {1: "a" * 192, 2: "long " * 500, 3: "other " * 300, 4: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = {r.doc_id: r for r in audio.digests(docs).collect()}
    assert all(r.pcm and r.pcm_table is None for r in want.values())
    monkeypatch.setattr(audio, "MOST_PCM", 1600)
    monkeypatch.setattr(audio, "SEGMENT", 700)
    got = {r.doc_id: r for r in audio.digests(docs).collect()}
    assert all(got[k].feature == r.feature and got[k].media_sha256 == r.media_sha256 for k, r in want.items())
    assert {2, 3} <= {k for k, r in got.items() if r.pcm is None} and got[4].pcm is None or got[4].pcm == want[4].pcm
    kept = {}
    for r in spark.read.parquet(got[2].pcm_table).orderBy("doc_id", "part").collect():
        kept.setdefault(r.doc_id, []).append(r.pcm)
    for k, r in got.items():
        assert r.pcm == want[k].pcm if r.pcm is not None else b"".join(kept[k]) == want[k].pcm
    assert all(len(p) == 700 for parts in kept.values() for p in parts[:-1])
