"""Opening, decoding and failing over and over in one process stays within a bound of memory."""

import gc
import os
import random

import pyarrow as pa
import pytest
from fixtures import drawn, put_cut, supported

from brindle.errors import ArrowIpcError
from brindle.functions.metadata import OpenedFile
from brindle.sources.arrow_ipc import Options, decoded, ranges

BOUND = 32 << 20


def _resident() -> int:
    return int(open(f"/proc/{os.getpid()}/statm").read().split()[1]) * os.sysconf("SC_PAGE_SIZE")


def test_bounded_memory(tmp_path):
    """A table of all types of about four megabytes; a leak of one copy in each turn would soon pass the bound."""
    rng = random.Random("leaks")
    t = pa.table({str(i): pa.concat_arrays([drawn(rng, k, 500, 0.2)] * 40) for i, k in enumerate(supported()) if not pa.types.is_dictionary(k)})
    path, bad = put_cut(tmp_path / "x.arrow", t, [3_000, 11_000, 19_999]), tmp_path / "bad.arrow"
    bad.write_bytes(open(path, "rb").read()[: t.nbytes // 2])
    o = Options(nanos="long")

    def turn():
        for part in ranges([path], o):
            assert sum(b.num_rows for b in decoded(part, o)) == t.num_rows
        with pytest.raises(ArrowIpcError):
            OpenedFile(str(bad), "x")

    for _ in range(25):
        turn()
    gc.collect()
    before = _resident()
    for _ in range(60):
        turn()
    gc.collect()
    assert t.nbytes * 60 > 4 * BOUND and _resident() - before < BOUND
