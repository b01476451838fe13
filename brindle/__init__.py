"""A Spark-native engine for columnar interchange and corpus preparation."""

import sys

from pyspark import cloudpickle

# functions and classes of this package travel with the tasks, so executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from .errors import ArrowIpcError, BadArgument, BatchParseError, CompressedBody, CreateError, OpenError, UnsupportedColumn  # noqa: E402
from .functions.paths import sweep  # noqa: E402
from .operators.interchange import arrow_batches, arrow_schema, as_uint8, read_arrow, read_splay, register, stream_arrow, timestamp_of_days, write_arrow, write_splay  # noqa: E402
from .streaming.batches import read_arrow_stream  # noqa: E402

__all__ = ["ArrowIpcError", "BadArgument", "BatchParseError", "CompressedBody", "CreateError", "OpenError", "UnsupportedColumn", "arrow_batches", "arrow_schema", "as_uint8", "read_arrow", "read_arrow_stream", "read_splay", "register", "stream_arrow", "sweep", "timestamp_of_days", "write_arrow", "write_splay"]
