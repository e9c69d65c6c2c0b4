"""The data source of WAV files: heads only, ranges of long files, several globs."""

import io
import time
import wave

import numpy as np
import pytest

from cadenza.operators import segments, waves
from cadenza.sources import wav, wavsource


def _file(path, x, sr=8000, channels=1, width=2):
    with wave.open(str(path), "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(sr)
        w.writeframes(x)


def test_headers_read_no_samples(spark, tmp_path):
    """Ten thousand files that claim 40 MB each (sparse, 400 GB in all): their heads take seconds, and only heads are read."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(44100)
        w.writeframes(b"")
    head = out.getvalue()
    n = 20_000_000
    head = head[:4] + (36 + 2 * n).to_bytes(4, "little") + head[8:40] + (2 * n).to_bytes(4, "little")
    for k in range(10_000):
        with open(tmp_path / f"{k:05d}.wav", "wb") as f:
            f.write(head)
            f.truncate(44 + 2 * n)
    start = time.perf_counter()
    rows = wavsource.headers(spark, str(tmp_path))
    got = rows.selectExpr("count(*) as n", "sum(head_bytes) as b", "min(frames) as low", "max(frames) as high", "count(error) as bad").first()
    assert (got["n"], got["low"], got["high"], got["bad"]) == (10_000, n, n, 0) and got["b"] == 10_000 * wavsource.HEAD
    assert time.perf_counter() - start < 60 and rows.rdd.getNumPartitions() == 20


def test_globs_and_bad_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("b_2.wav", "a_1.WAV", "sub/c_3.wav", "other.txt"):
        _file(tmp_path / name, bytes(20))
    (tmp_path / "bad.wav").write_bytes(b"RIFF....nothing")
    (tmp_path / "empty.wav").write_bytes(b"")
    paths = wavsource.headers(spark, str(tmp_path), ("*.wav", "*_?.wav", "*.WAV")).where("error is null").select("path")
    assert {r["idx"]: r["path"].rsplit("/", 1)[1] for r in segments.episode_index(paths).collect()} == {"000": "a_1.WAV", "001": "b_2.wav", "002": "c_3.wav"}
    assert {r["sid"]: r["error"] for r in wavsource.headers(spark, str(tmp_path)).where("error is not null").collect()} == {"bad": "not a WAV file", "empty": "not a WAV file"}
    assert wavsource.headers(spark, str(tmp_path), ("nothing*",)).count() == 0
    with pytest.raises(Exception, match="not a WAV file"):
        wav.read_headers(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="no such columns"):
        spark.read.format("wav").schema("nope string").load(str(tmp_path)).collect()


@pytest.mark.parametrize(("channels", "width"), [(1, 1), (1, 2), (2, 2), (1, 3), (2, 4)])
def test_chunks_equal_whole_files(spark, tmp_path, channels, width):
    """All sample widths; chunks are what the decoder of whole files gives."""
    raw = np.random.default_rng(width).integers(0, 256, 1001 * channels * width, np.uint8).tobytes()
    _file(tmp_path / "x.wav", raw, channels=channels, width=width)
    found = wavsource.chunks(spark, str(tmp_path), samples=100)
    assert found.count() == 11
    got = np.frombuffer(bytes(waves.joined(found).first()["pcm"]), "<i2").astype(int)
    if width == 3:
        want = np.frombuffer(raw, "u1").reshape(-1, 3)[:, 1:].copy().view("<i2")[:, 0]
    else:
        want = wav.decode((tmp_path / "x.wav").read_bytes())[1] * 32768
    assert len(got) == 1001 and np.abs(got - want).max() <= 1


def test_long_files_are_several_partitions(tmp_path):
    """Ranges of bytes meet each chunk once; a chunk of metadata longer than the head is passed over."""
    x = np.arange(60_000, dtype="<i2")
    _file(tmp_path / "x.wav", x.tobytes())
    data = (tmp_path / "x.wav").read_bytes()
    long = data[:36] + b"LIST" + (50_000).to_bytes(4, "little") + bytes(50_000) + data[36:]
    (tmp_path / "y.wav").write_bytes(long)
    before, wavsource.BYTES = wavsource.BYTES, 25_000
    try:
        reader = wavsource.Reader({"path": str(tmp_path), "samples": "1000"}, wavsource.StructType.fromDDL("sid string, chunk long, pcm binary"))
        parts = reader.partitions()
        rows = [r for p in parts for r in reader.read(p)]
    finally:
        wavsource.BYTES = before
    assert len(parts) == 5 + 7 + 1
    for name in "xy":
        own = sorted(r for r in rows if r[0] == name)
        assert [r[1] for r in own] == list(range(60)) and b"".join(r[2] for r in own) == x.tobytes()


class Doubled:
    """A decoder of a format of its own: a rate and bytes, one for each sample."""

    batch = 2

    def __call__(self, inputs):
        out = []
        for x in inputs:
            if x["content"][:1] != b"d":
                raise ValueError("not mine")
            out.append({"sr": 100, "pcm": np.frombuffer(x["content"][1:], "u1").astype("<i2").tobytes()})
        return out


def test_decoders_plug_in(spark, tmp_path):
    for name, content in (("a.dbl", b"d" + bytes(range(10))), ("b.dbl", b"dxyz"), ("c.dbl", b"nope"), ("d.txt", b"dno")):
        (tmp_path / name).write_bytes(content)
    done = spark.createDataFrame([("b",)], "sid string")
    from cadenza import providers
    from cadenza.sources import decode

    before = providers.apply.__defaults__
    providers.apply.__defaults__ = (2, 0.0)
    try:
        chunks, failed = decode.decoded(spark, str(tmp_path), ("*.dbl", "a.*"), Doubled, done, size=4)
    finally:
        providers.apply.__defaults__ = before
    assert [(r["sid"], r["chunk"], len(r["pcm"]) // 2) for r in chunks.orderBy("chunk").collect()] == [("a", 0, 4), ("a", 1, 4), ("a", 2, 2)]
    assert [(r["sid"], r["error"]) for r in failed.collect()] == [("c", "ValueError: not mine")]
    assert np.frombuffer(bytes(waves.joined(chunks).first()["pcm"]), "<i2").tolist() == list(range(10))
