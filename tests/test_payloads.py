import bz2
import gzip
import random
import tracemalloc
import zlib

import zstandard
from pyspark.sql import functions as F

from blockloom.operators import payloads


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, value binary")


def samples():
    rng = random.Random(2)
    return [b"", b"x", b"a" * 127, b"a" * 128, rng.randbytes(127), rng.randbytes(128), rng.randbytes(5000), b"ab" * 9000, None] + [
        bytes(rng.choices(b"abcdef \n", k=rng.randrange(3000))) for _ in range(60)
    ]


def test_round_trip_and_smallest(spark, setting):
    setting("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    values = samples()
    encoded = payloads.encode_payloads(frame(spark, values))
    rows = {r["id"]: r for r in encoded.collect()}
    size = {
        "none": len,
        "bzip2": lambda v: len(bz2.compress(v, 9)),
        "gzip": lambda v: len(gzip.compress(v, 6)),
        "zstd": lambda v: len(zstandard.ZstdCompressor(write_content_size=False).compress(v)),
    }
    for i, value in enumerate(values):
        row = rows[i]
        if value is None:
            assert row["codec"] is None and row["value"] is None
            continue
        expected = "none" if len(value) < 128 else min(payloads.CODECS, key=lambda c: size[c](value))
        assert row["codec"] == expected
        assert bytes(row["value"][:4]) == payloads.CODECS.index(expected).to_bytes(4, "little")
        assert len(row["value"]) == size[expected](value) + 4
    decoded = {r["id"]: r for r in payloads.decode_payloads(encoded.drop("codec")).collect()}
    for i, value in enumerate(values):
        assert decoded[i]["payload"] == (None if value is None else bytearray(value))
        assert (decoded[i]["error"] is None) == (value is not None)


def test_bad_values_are_set_apart(spark):
    text = b"some text " * 50
    good = [
        b"\0\0\0\0",
        b"\1\0\0\0" + bz2.compress(text),
        b"\2\0\0\0" + gzip.compress(text),
        b"\3\0\0\0" + zstandard.ZstdCompressor().compress(text) + zstandard.ZstdCompressor().compress(text),
    ]
    bad = [b"", b"abc", b"\x09\0\0\0x", b"\1\0\0\0not bzip2", good[1][:-9], good[2][:-9], good[3][:-9], b"\3\0\0\0", b"\2\0\0\0"]
    rows = {r["id"]: r for r in payloads.decode_payloads(frame(spark, good + bad)).collect()}
    assert [rows[i]["payload"] for i in range(4)] == [b"", text, text, text * 2]
    assert all(rows[i]["error"] is None for i in range(4))
    assert all(rows[i]["error"] and rows[i]["payload"] is None for i in range(4, 4 + len(bad)))


def test_report_adds_up(spark):
    values = samples()
    report = payloads.codec_report(frame(spark, values)).where(F.col("codec").isNotNull()).collect()
    kept = [v for v in values if v is not None]
    assert sum(r["rows"] for r in report) == len(kept)
    assert sum(r["bytes_in"] for r in report) == sum(map(len, kept))


def bomb(codec, size):
    """A value of few bytes that decodes to very many."""
    stream = {"bzip2": bz2.BZ2Compressor, "gzip": lambda: zlib.compressobj(wbits=31), "zstd": lambda: zstandard.ZstdCompressor().compressobj()}[codec]()
    parts = [stream.compress(bytes(1 << 20)) for _ in range(size >> 20)]
    return payloads.CODECS.index(codec).to_bytes(4, "little") + b"".join(parts) + stream.flush()


def test_bombs_are_rejected_in_flat_memory(spark):
    values = [bomb(codec, size) for codec, size in (("bzip2", 128 << 20), ("gzip", 256 << 20), ("zstd", 1 << 30))]
    assert max(map(len, values)) < 1 << 19
    for value in values:
        tracemalloc.start()
        payload, error = payloads._decode(value, 4 << 20)
        _, peak = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert payload is None and "more than 4194304 bytes" in error and peak < 80 << 20
    found = payloads.decode_payloads(frame(spark, values)).collect()
    assert [r["error"].split(": ")[1] for r in found] == ["more than 104857600 bytes"] * 3


def test_the_limit_can_be_raised(spark):
    values = [b"\0\0\0\0" + b"x" * 1000] + [bomb(codec, 1 << 20) for codec in ("bzip2", "gzip", "zstd")]

    def failed(limit):
        return [r["payload"] is None for r in payloads.decode_payloads(frame(spark, values), limit=limit).collect()]

    assert failed(999) == [True] * 4
    assert failed(1000) == [False, True, True, True]
    assert failed((1 << 20) - 1) == [False, True, True, True]
    assert failed(1 << 20) == [False] * 4


def test_bzip2_of_short_values_has_the_bytes_of_the_highest_level():
    draw = random.Random(5)
    for size in (0, 1, 128, 5_000, 79_000, 80_000, 100_000, 200_000, 1_000_000):
        for data in (draw.randbytes(size), b"a" * size, (b"aaaab" * size)[:size], (b"block %d" % size * size)[:size]):
            assert payloads._bzip2(data) == bz2.compress(data, 9)


def test_zstd_values_share_a_compressor():
    """The bytes are those of a compressor of their own."""
    import zstandard

    values = [b"", b"a", b"abc" * 1000, bytes(range(256)) * 9] * 2
    alone = [zstandard.ZstdCompressor(write_content_size=False).compress(v) for v in values]
    assert [payloads._ENCODE["zstd"](v) for v in values] == alone
    assert payloads._zstd() is payloads._zstd()
