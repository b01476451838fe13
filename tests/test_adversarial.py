"""Damaged files: every case gives a named error, and the undamaged one reads."""

import random
import struct

import pyarrow as pa
import pytest
from fixtures import drawn, put, put_cut, supported

import brindle
from brindle.errors import ArrowIpcError, CompressedBody
from brindle.functions.metadata import OpenedFile


@pytest.fixture(scope="module")
def good(tmp_path_factory):
    rng = random.Random("damage")
    t = pa.table({f"{i}": drawn(rng, k, 480, 0.25) for i, k in enumerate(supported()) if k not in (pa.timestamp("ns"), pa.duration("ns"))})
    path = put_cut(tmp_path_factory.mktemp("g") / "x.arrow", t, [100, 100, 333])
    return open(path, "rb").read()


def _refused(spark, path):
    """A named error, at once or from the task that meets the damage."""
    with pytest.raises(Exception) as e:
        brindle.read_arrow(spark, str(path)).collect()
    assert isinstance(e.value, ArrowIpcError) or "brindle.errors." in str(e.value), e.value


def test_control(spark, good, tmp_path):
    (tmp_path / "x.arrow").write_bytes(good)
    assert brindle.read_arrow(spark, str(tmp_path / "x.arrow")).count() == 480
    assert brindle.stream_arrow(spark, str(tmp_path / "x.arrow"), str(tmp_path / "db"), format="splay") == 480


def _damaged(data: bytes) -> dict[str, bytes]:
    n = len(data)
    out = {f"cut{k}": data[: n * k // 20] for k in range(1, 20)} | {f"short{k}": data[:-k] for k in (1, 5, 9, 10, 11)}
    for at in (0, 3, n - 1, n - 6):
        out[f"magic{at}"] = data[:at] + bytes([data[at] ^ 0xFF]) + data[at + 1 :]
    for name, v in (("zero", 0), ("negative", -1), ("huge", 2**31 - 1), ("size", n), ("nearly", n - 17)):
        out[f"footer_{name}"] = data[:-10] + v.to_bytes(4, "little", signed=True) + data[-6:]
    return out | {"empty": b"", "magic_only": b"ARROW1\0\0ARROW1", "zeros": bytes(4096), "double": b"ARROW1\0\0" + data}


def test_damage(spark, good, tmp_path):
    for name, data in _damaged(good).items():
        path = tmp_path / f"{name}.arrow"
        path.write_bytes(data)
        _refused(spark, path)
        with pytest.raises(ArrowIpcError):
            brindle.stream_arrow(spark, str(path), str(tmp_path / "never"), format="splay")
        assert not (tmp_path / "never").exists(), name


def test_batches_that_the_footer_misplaces(spark, tmp_path):
    """Blocks of the footer that point elsewhere, or say too much."""
    path = put(tmp_path / "x.arrow", pa.table({"v": pa.array(range(900), pa.int64())}), 3)
    data = open(path, "rb").read()
    with OpenedFile(path, "x") as f:
        blocks = f.blocks()["record batch"]
        assert len(blocks) == 3 and [f.facts(b, False)[0] for b in blocks] == [300] * 3
    raw = [struct.pack("<qi4xq", *b) for b in blocks]
    assert all(data.count(r) == 1 for r in raw)
    begin, size, body = blocks[1]
    for k, other in enumerate(((begin + 8, size, body), (begin, size + (1 << 20), body), (begin, size, body + 64), (-8, size, body), (begin, 0, body), (begin, size, 1 << 60), (8, size, body))):
        bad = tmp_path / f"{k}.arrow"
        bad.write_bytes(data.replace(raw[1], struct.pack("<qi4xq", *other)))
        _refused(spark, bad)
        with pytest.raises(ArrowIpcError):
            brindle.arrow_batches(str(bad))


def test_planning_reads_no_bodies(tmp_path):
    """Of a file with large batches only the frame, the footer and the batches' metadata are read."""
    t = pa.table({"v": pa.array(range(1_000_000), pa.int64()), "s": [f"word {i % 1000}" for i in range(1_000_000)]})
    path = put(tmp_path / "x.arrow", t, 40)

    class Counting:
        def __init__(self, source):
            self.source, self.read, self.close = source, 0, source.close

        def read_at(self, n, at):
            self.read += n
            return self.source.read_at(n, at)

    with OpenedFile(path, "x") as f:
        f.source, kept = Counting(f.source), f.source
        assert [b.rows for b in f.batches()] == [25_000] * 40
        assert 0 < f.source.read < 60_000 < f.size // 100
        f.source = kept


@pytest.mark.parametrize("codec", ["zstd", "lz4"])
def test_compressed(spark, tmp_path, codec):
    path = put(tmp_path / "x.arrow", pa.table({"a": list(range(1000)), "d": pa.array(["x"] * 1000).dictionary_encode()}), 2, compression=codec)
    with pytest.raises(CompressedBody):
        brindle.read_arrow(spark, path)
    with pytest.raises(CompressedBody):
        brindle.stream_arrow(spark, path, str(tmp_path / "never"))


def test_flipped_bytes_never_kill_a_worker(spark, good, tmp_path):
    """Any single flipped byte gives data or a named error."""
    for k in range(0, len(good), max(1, len(good) // 60)):
        path = tmp_path / f"{k}.arrow"
        path.write_bytes(good[:k] + bytes([good[k] ^ 0x5A]) + good[k + 1 :])
        try:
            brindle.read_arrow(spark, str(path)).write.format("noop").mode("overwrite").save()
        except Exception as e:
            assert isinstance(e, ArrowIpcError) or "brindle.errors." in str(e), (k, e)


def test_arguments(spark):
    for bad in (None, 7, "", ":"):
        with pytest.raises(brindle.BadArgument):
            brindle.read_arrow(spark, bad)
    with pytest.raises(brindle.BadArgument):
        brindle.read_arrow(spark, "/nowhere", nulls="maybe")
    with pytest.raises(brindle.OpenError):
        brindle.read_arrow(spark, "/nowhere/x.arrow")
    with pytest.raises(brindle.BadArgument):
        brindle.stream_arrow(spark, "a", 3)
    with pytest.raises(brindle.CreateError):
        brindle.write_arrow(spark.range(1), "/proc/nowhere/x.arrow")
