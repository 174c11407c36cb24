import hashlib
import wave
import zlib

import numpy as np
import pytest

from tickloom.llm import telephony as t


def one_mu(code):
    code = ~code & 255
    size = (((code & 15) * 2 + 33) << (code >> 4 & 7)) * 4 - 132
    return -size if code & 128 else size


def one_a(code):
    code ^= 0x55
    e, m = code >> 4 & 7, code & 15
    size = (m * 2 + 1) << 3 if e == 0 else (m * 2 + 33) << (e + 2)
    return size if code & 128 else -size


def test_tables():
    assert t.TABLES[t.MU_LAW].tolist() == [one_mu(i) for i in range(256)]
    assert t.TABLES[t.A_LAW].tolist() == [one_a(i) for i in range(256)]
    assert [t.TABLES[t.MU_LAW][i] for i in (0, 0x7F, 0x80, 0xFF)] == [-32124, 0, 32124, 0]
    assert [t.TABLES[t.A_LAW][i] for i in (0x55, 0xD5, 0xAA, 0x2A)] == [-8, 8, 32256, -32256]


def ima_by_sample(data, block):
    out = []
    for b in range(0, len(data), block):
        part = data[b : b + block]
        value, index = int.from_bytes(part[:2], "little", signed=True), min(part[2], 88)
        out.append(value)
        for byte in part[4:]:
            for code in (byte & 15, byte >> 4):
                step = int(t.STEPS[index])
                diff = step >> 3
                for bit, part_step in ((1, step >> 2), (2, step >> 1), (4, step)):
                    diff += part_step if code & bit else 0
                value = max(-32768, min(32767, value - diff if code & 8 else value + diff))
                index = max(0, min(88, index + int(t.INDEX_STEP[code & 7])))
                out.append(value)
    return out


def test_adpcm_across_blocks():
    data = np.random.default_rng(1).integers(0, 256, 256 * 40, np.uint8).tobytes()
    assert t.decode_ima(data, 256).tolist() == ima_by_sample(data, 256)
    samples, rate = t.decode(t.wav(data, t.IMA_ADPCM, 8000, 256))
    assert samples.tolist() == ima_by_sample(data, 256) and rate == 8000
    with pytest.raises(ValueError):
        t.decode_ima(data[:-1], 256)


def test_resampling():
    s = np.array([0, 100, -7, 32767, -32768], np.int16)
    at = lambda i, rate, to: (lambda a, b, p: a + (b - a) * p // to)(int(s[i * rate // to]), int(s[min(i * rate // to + 1, 4)]), i * rate % to)
    for to in (8000, 11025, 16000, 48000, 6000):
        assert t.resample(s, 8000, to).tolist() == [at(i, 8000, to) for i in range(-(-5 * to // 8000))]
    assert len(t.resample(s[:0], 8000, 16000)) == 0 and t.resample(s[:1], 8000, 16000).tolist() == [0, 0]


def test_wav_files(tmp_path):
    (tmp_path / "a.wav").write_bytes(t.wav(np.arange(5, dtype="<i2").tobytes(), t.PCM))
    with wave.open(str(tmp_path / "a.wav")) as w:
        assert (w.getnframes(), w.getframerate(), w.getsampwidth()) == (5, 8000, 2)
    good = t.wav(b"abc", t.MU_LAW)
    assert t.parse_wav(good) == (t.MU_LAW, 8000, 1, b"abc")
    for bad in (b"", good[:-1], good[:20], good.replace(b"data", b"dada"), b"X" + good[1:], good + b"\0\0"):
        with pytest.raises(ValueError):
            t.parse_wav(bad)


def want(text):
    raw = (text or "").encode()
    data = raw + b"\0" * (max(64, -(-len(raw) // 64) * 64) - len(raw))
    media = t.wav(data, t.MU_LAW)
    wide = [one_mu(b) for b in data]
    pcm = [x for i, a in enumerate(wide) for x in (a, (a + (wide[i + 1] if i + 1 < len(wide) else a)) >> 1)]
    crossings = sum((a < 0) != (b < 0) for a, b in zip(pcm, pcm[1:]))
    feature = f"rate=16000;n={len(pcm)};energy={sum(x * x for x in pcm) // len(pcm)};peak={max(map(abs, pcm))};crossings={crossings};crc={zlib.crc32(np.array(pcm, '<i2').tobytes())}"
    return len(raw), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature


def test_query_against_plain_python(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r[0]: tuple(r[1:]) for r in t.op2_telephony(spark, sf).collect()}
    assert got == {i: want(x) for i, x in texts.items()}


def test_hard_rows(spark, tmp_path):
    rows = [(1, None), (1, ""), (None, "x" * 64), (2, "é" * 33), (3, "\0"), (4, "z" * 3_000_000), (3, "\0")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, t.op2_telephony(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted([(i, *want(x)) for i, x in rows], key=str)


def test_stored_planes():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 8, 4097):
        pcm = rng.integers(-32768, 32768, n).astype(np.int16)
        assert t.samples(t.planes(pcm)).tolist() == pcm.tolist() and len(t.planes(pcm)) == 2 * n
        doubled = t.resample(pcm, 8000, 16000)
        assert t.planes(doubled) == pcm.astype("<i2").tobytes() + bytes(2 * n) and t.samples(t.planes(doubled)).tolist() == doubled.tolist()


def test_features_in_steps(monkeypatch):
    pcm = np.random.default_rng(4).integers(-32768, 32768, 1000).astype(np.int16)
    whole = t.features(pcm, 8000)
    for step in (1, 7, 999, 1000):
        monkeypatch.setattr(t, "STEP", step)
        assert t.features(pcm, 8000) == whole
    assert t.features(pcm[:0], 8000) == "rate=8000;n=0;energy=0;peak=0;crossings=0;crc=0"


def test_columns(spark):
    df = spark.createDataFrame([(bytearray(t.wav(b"ab", t.A_LAW)), 1, "p"), (None, 2, "q"), (bytearray(b"junk"), 3, "r")], "media binary, k int, pcm string")
    read = t.read_media(df, target=8000)
    out = {r.k: r for r in read.collect()}
    assert bytes(out[1].pcm) == np.array([one_a(97), one_a(98)], "<i2").tobytes() and out[1].media_error is None
    assert out[2].media_error and out[3].media_error and out[2].pcm is None and out[2].media_bytes == 0
    told = {r.k: r.feature for r in t.with_features(read, rate=8000, read=lambda b: np.frombuffer(b, "<i2")).collect()}
    assert told == {1: t.features(np.array([one_a(97), one_a(98)], np.int16), 8000), 2: None, 3: None}
    assert t.read_media(df.limit(0)).count() == 0 and t.media_column(df.limit(0), "pcm").count() == 0 and t.with_features(read.limit(0)).count() == 0
