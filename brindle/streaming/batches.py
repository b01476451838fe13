"""Arrow files as a Structured Streaming source: each trigger takes the files that came since the last."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import nulls as null_forms
from ..functions.paths import plain, qualified
from ..operators.interchange import _nulls, register
from ..sources.arrow_ipc import ROW_INDEX


def read_arrow_stream(spark: SparkSession, path: str, *, nulls: str = "compat", strict: bool = True, nanos: str = "error", row_index: bool = False) -> DataFrame:
    """A streaming DataFrame over a folder's files (or one file). Files that appear later are taken in later triggers, whatever their names.

    A file is known by its name, size and time, and is read once; a file that is replaced counts as new.
    row_index adds the row's number within its file.
    """
    compat = _nulls(nulls, "arrow_stream")
    register(spark)
    reader = spark.readStream.format("arrow_ipc").option("strict", str(strict)).option("nanos", nanos).option("row_index", str(row_index)).option("operation", "arrow_stream")
    df = reader.load(qualified(spark, plain(path, "arrow_stream")))
    return null_forms.apply(df, lambda f: None if f.name == ROW_INDEX else null_forms.on_read(f)) if compat else df
