"""Telephony audio columns: G.711 mu-law and A-law by lookup tables, IMA ADPCM decoded with numpy across blocks, and linear
resampling to 16-bit PCM.

A media column holds WAV files. 8-bit companded samples keep any bytes as they are; decoding and resampling run in batches.
Resampled PCM is stored as its own table, in planes that compress, and features are computed from what is read back.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LARGE_ROWS, fresh, in_batches, written

#: WAVE format tags (fixed values).
PCM, A_LAW, MU_LAW, IMA_ADPCM = 1, 6, 7, 17
#: Samples of one numpy step.
STEP = 1 << 20
#: Writer options of the stored tables: a higher level and larger pages than the defaults take a twelfth off the disk.
STORED = {**LARGE_ROWS, "compression": "zstd", "parquet.compression.codec.zstd.level": "9", "parquet.page.size": str(4 << 20)}
#: IMA ADPCM step-index changes by the code's low three bits (fixed values).
INDEX_STEP = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int64)
#: IMA ADPCM step sizes (fixed values).
STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449,
    494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442,
    11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767], np.int64)


def mu_law_table() -> np.ndarray:
    """The 16-bit sample of each mu-law byte: complemented sign, 3-bit exponent, 4-bit mantissa, bias 132."""
    code = ~np.arange(256) & 0xFF
    size = (((code & 15) << 3) + 132 << (code >> 4 & 7)) - 132
    return np.where(code & 128, -size, size).astype(np.int16)


def a_law_table() -> np.ndarray:
    """The 16-bit sample of each A-law byte: even bits inverted, sign, 3-bit exponent, 4-bit mantissa."""
    code = np.arange(256) ^ 0x55
    exponent, mantissa = code >> 4 & 7, (code & 15) << 4
    size = np.where(exponent == 0, mantissa + 8, mantissa + 264 << np.maximum(exponent - 1, 0))
    return np.where(code & 128, size, -size).astype(np.int16)


TABLES = {MU_LAW: mu_law_table(), A_LAW: a_law_table()}


def wav(data: bytes, tag: int, rate: int = 8000, block: int = 1) -> bytes:
    """A mono WAV file around data: 8-bit samples for companded formats, 16-bit for PCM, blocks of 4-bit codes for ADPCM."""
    bits = {PCM: 16, IMA_ADPCM: 4}.get(tag, 8)
    align = {PCM: 2, IMA_ADPCM: block}.get(tag, 1)
    per_block = (block - 4) * 2 + 1
    extra = struct.pack("<HH", 2, per_block) if tag == IMA_ADPCM else struct.pack("<H", 0) if tag != PCM else b""
    fmt = struct.pack("<HHIIHH", tag, 1, rate, rate * align // (per_block if tag == IMA_ADPCM else 1), align, bits) + extra
    chunks = b"".join(struct.pack("<4sI", name, len(body)) + body + b"\0" * (len(body) & 1) for name, body in ((b"fmt ", fmt), (b"data", data)))
    return struct.pack("<4sI4s", b"RIFF", 4 + len(chunks), b"WAVE") + chunks


def parse_wav(media: bytes) -> tuple[int, int, int, bytes]:
    """Format tag, rate, block size and data of a mono WAV file; ValueError if its headers or lengths don't hold together."""
    if len(media) < 12 or media[:4] != b"RIFF" or media[8:12] != b"WAVE" or struct.unpack_from("<I", media, 4)[0] + 8 != len(media):
        raise ValueError("not a RIFF WAVE file of the stated length")
    at, fmt, data = 12, None, None
    while at + 8 <= len(media):
        name, size = struct.unpack_from("<4sI", media, at)
        if at + 8 + size > len(media):
            raise ValueError(f"chunk {name!r} passes the end")
        body = media[at + 8 : at + 8 + size]
        fmt, data = (body, data) if name == b"fmt " else (fmt, body) if name == b"data" else (fmt, data)
        at += 8 + size + (size & 1)
    if fmt is None or data is None or len(fmt) < 16:
        raise ValueError("no fmt or data chunk")
    tag, channels, rate, _, align, bits = struct.unpack_from("<HHIIHH", fmt)
    if channels != 1 or {PCM: 16, A_LAW: 8, MU_LAW: 8, IMA_ADPCM: 4}.get(tag) != bits:
        raise ValueError(f"format {tag} with {channels} channels of {bits} bits isn't read")
    return tag, rate, align, data


def decode_ima(data: bytes, block: int) -> np.ndarray:
    """Samples of mono IMA ADPCM: the k-th code of all blocks is decoded in one step, so Python loops over a block's codes only."""
    if block < 5 or len(data) % block:
        raise ValueError("ADPCM data isn't whole blocks")
    blocks = np.frombuffer(data, np.uint8).reshape(-1, block)
    value = blocks[:, :2].copy().view("<i2")[:, 0].astype(np.int64)
    index = np.minimum(blocks[:, 2].astype(np.int64), 88)
    out = np.empty((len(blocks), (block - 4) * 2 + 1), np.int16)
    out[:, 0] = value
    codes = np.empty((len(blocks), (block - 4) * 2), np.uint8)
    codes[:, 0::2], codes[:, 1::2] = blocks[:, 4:] & 15, blocks[:, 4:] >> 4
    for k in range(codes.shape[1]):
        code, step = codes[:, k].astype(np.int64), STEPS[index]
        diff = (step >> 3) + np.where(code & 1, step >> 2, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 4, step, 0)
        value = np.clip(np.where(code & 8, value - diff, value + diff), -32768, 32767)
        index = np.clip(index + INDEX_STEP[code & 7], 0, 88)
        out[:, k + 1] = value
    return out.ravel()


def decode(media: bytes) -> tuple[np.ndarray, int]:
    """16-bit samples and rate of a WAV file in any of the four formats."""
    tag, rate, block, data = parse_wav(media)
    if tag == IMA_ADPCM:
        return decode_ima(data, block), rate
    if tag == PCM:
        return np.frombuffer(data[: len(data) & ~1], "<i2"), rate
    return TABLES[tag][np.frombuffer(data, np.uint8)], rate


def resample(samples: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Linear interpolation in integers (rounded down), the last sample held: the same result on every machine."""
    n = len(samples)
    if rate == target or not n:
        return samples
    total = -(-n * target // rate)
    if target == 2 * rate:  # the common telephony case without index arrays
        out = np.empty(total, np.int16)
        out[0::2] = samples
        wide = samples.astype(np.int32)
        out[1:-1:2] = (wide[:-1] + wide[1:]) >> 1
        out[-1] = samples[-1]
        return out
    at = np.arange(total, dtype=np.int64) * rate
    left, part = at // target, at % target
    a, b = samples[left].astype(np.int64), samples[np.minimum(left + 1, n - 1)].astype(np.int64)
    return (a + (b - a) * part // target).astype(np.int16)


def media_column(df: DataFrame, payload_col: str, media_col: str = "media", tag: int = MU_LAW, rate: int = 8000) -> DataFrame:
    """df with media_col: a WAV file whose 8-bit samples are the bytes of payload_col (null: none). Losslessly read back by
    read_media(). Other columns pass through; media_col is replaced if there."""
    keep = [c for c in df.columns if c != media_col]
    (raw,) = fresh(df, "raw")
    schema = df.select(*keep).schema.add(media_col, "binary")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            media = pa.array([wav(b or b"", tag, rate) for b in batch.column(len(keep)).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], media], names=schema.names)

    return df.select(*keep, F.col(payload_col).cast("binary").alias(raw)).transform(in_batches, made, schema)


def features(pcm: np.ndarray, rate: int) -> str:
    """Length, loudness, peak and zero crossings of samples, and a checksum of their bytes; taken a STEP at a time."""
    energy = peak = crossings = crc = 0
    for at in range(0, len(pcm), STEP):
        wide = pcm[at : at + STEP + 1].astype(np.int64)  # one more, for the crossing into the next step
        crossings += int(np.count_nonzero((wide[1:] < 0) != (wide[:-1] < 0)))
        wide = wide[:STEP]
        energy, peak = energy + int(wide @ wide), max(peak, int(np.abs(wide).max()))
        crc = zlib.crc32(wide.astype("<i2").tobytes(), crc)
    return f"rate={rate};n={len(pcm)};energy={energy // max(1, len(pcm))};peak={peak};crossings={crossings};crc={crc}"


def _between(even: np.ndarray) -> np.ndarray:
    """For each sample of even places, its mean with the next, by which the odd place after it is predicted."""
    wide = even.astype(np.int32)
    return (wide + np.append(wide[1:], wide[-1:]) >> 1).astype(np.int16)


def planes(pcm: np.ndarray) -> bytes:
    """Samples in a form that compresses: those of even places, then what those of odd places differ (modulo 2^16) from the
    mean of their neighbours, which is nothing where the rate was doubled. samples() is the exact way back."""
    even, odd = pcm[0::2], pcm[1::2]
    return even.astype("<i2").tobytes() + (odd - _between(even)[: len(odd)]).astype("<i2").tobytes()


def samples(stored: bytes) -> np.ndarray:
    both = np.frombuffer(stored, "<i2")
    even, odd = both[: -(-len(both) // 2)], both[-(-len(both) // 2) :]
    out = np.empty(len(both), np.int16)
    out[0::2], out[1::2] = even, odd + _between(even)[: len(odd)]
    return out


def read_media(df: DataFrame, media_col: str = "media", target: int = 16000, form: Callable[[np.ndarray], bytes] = bytes) -> DataFrame:
    """df with the stored bytes of media_col read back: payload_bytes, payload_sha256, tail_crc32 (last 64), media_bytes,
    media_sha256, pcm (samples resampled to target, as little-endian 16 bits or in another form, such as planes) and
    media_error, null or why the file can't be read, in which case what depends on its inside is null.

    Null media are files of zero bytes: an error. So is a file whose PCM takes over 2^30 samples, which no binary value holds.
    Rows are independent, so repeats, ties and lengths don't matter; other columns pass through, those named like results are
    replaced; empty tables give empty tables.
    """
    names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "pcm", "media_error"]
    kinds = ["long", "string", "long", "long", "string", "binary", "string"]
    keep = [c for c in df.columns if c not in [*names, media_col]]
    schema = df.select(*keep).schema
    for name, kind in zip(names, kinds):
        schema = schema.add(name, kind)
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def row(media: bytes | None) -> list:
        media = media or b""
        outer = [len(media), hashlib.sha256(media).hexdigest()]
        try:
            _, _, _, data = parse_wav(media)
            pcm, rate = decode(media)
            if len(pcm) * target > rate << 30:
                raise ValueError("more samples than a value holds")
        except ValueError as e:
            return [None, None, None, *outer, None, str(e)]
        return [len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]), *outer, form(resample(pcm, rate, target).astype("<i2")), None]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                rows = [row(x.as_py()) for x in part.column(len(keep))]
                columns = [pa.array([r[i] for r in rows], types[kind]) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *columns], names=schema.names)

    return df.select(*keep, F.col(media_col).cast("binary")).transform(in_batches, read, schema)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in rows of a quarter of its size or one row each, as samples take four times the bytes of their codes."""
    step = max(1, batch.num_rows // 4)
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def with_features(df: DataFrame, pcm_col: str = "pcm", feature_col: str = "feature", rate: int = 16000, read: Callable[[bytes], np.ndarray] = samples) -> DataFrame:
    """df with pcm_col, as stored in the form that `read` reads, replaced by feature_col (null: null), see features(). Other
    columns pass through, also on repeats; empty tables give empty tables."""
    keep = [c for c in df.columns if c not in (pcm_col, feature_col)]
    schema = df.select(*keep).schema.add(feature_col, "string")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [features(read(x.as_buffer()), rate) if x.is_valid else None for x in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(told, pa.string())], names=schema.names)

    return df.select(*keep, pcm_col).transform(in_batches, made, schema)


def padded(text, unit: int = 64):
    """Text (null: empty) in UTF-8 with bytes 0 up to a positive multiple of unit."""
    raw = F.coalesce(text, F.lit("")).cast("binary")
    size = F.octet_length(raw)
    to = F.greatest(F.lit(unit), F.ceil(size / unit).cast("int") * unit)
    return F.when(size == to, raw).otherwise(F.concat(raw, F.expr(f"cast(repeat('\\0', {unit}) as binary)").substr(F.lit(1), to - size)))


def op2_telephony(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    made = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), padded(F.col("text")).alias("payload"))
    media = written(media_column(made, "payload").drop("payload"), "media", **STORED)
    pcm = written(read_media(media, form=planes).drop("media_error"), "pcm", **STORED)
    return with_features(pcm)
