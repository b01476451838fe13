"""Randomised tables of all types: written by pyarrow in batches of uneven lengths, read here, written here, read by pyarrow."""

import datetime
import random

import pyarrow as pa
import pyarrow.ipc as ipc
import pytest
from fixtures import collected, drawn, expected, put_cut, supported

import brindle


def _case(k: int):
    """Lengths around the edges of bitmap words and batches; every type twice, in an order of its own."""
    rng = random.Random(f"matrix {k}")
    n = rng.choice((63, 64, 65, 1023, 3001)) if k > 1 else k
    types = supported() * 2
    rng.shuffle(types)
    table = pa.table({f"{i} {t}": drawn(rng, t, n, rng.choice((0, 0.3, 0.9, 1))) for i, t in enumerate(types)})
    cuts = sorted(rng.randint(0, n) for _ in range(rng.randrange(9))) if n else []
    return table, cuts


def _ticks(values):
    """Times as milliseconds; all else as it is."""
    return [((v.hour * 60 + v.minute) * 60 + v.second) * 1000 + v.microsecond // 1000 if isinstance(v, datetime.time) else v for v in values]


def test_the_type_map_is_what_it_was():
    assert len(supported()) == 23 and pa.uint8() in supported() and pa.int8() not in supported()


@pytest.mark.parametrize("k", range(14))
def test_foreign_file_round_trips(spark, tmp_path, k):
    table, cuts = _case(k)
    path = put_cut(tmp_path / "in.arrow", table, cuts)
    df = brindle.read_arrow(spark, path, nanos="long", row_index=True, target_bytes=20_000)
    want = {n: expected(table.column(n)) for n in table.column_names}
    for n, got in zip(table.column_names, collected(df, table.column_names), strict=True):
        assert _ticks(got) == want[n], n
    back = str(tmp_path / "out.arrow")
    brindle.write_arrow(df.orderBy("__row_index").drop("__row_index"), back)
    again = ipc.open_file(back).read_all()
    assert again.column_names == table.column_names
    for n in table.column_names:
        assert expected(again.column(n)) == want[n], n
