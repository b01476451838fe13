"""What an Arrow IPC file tells without decoding its data: validity, schema, batches, compression."""

from __future__ import annotations

import struct
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.ipc as ipc

from ..errors import BatchParseError, CompressedBody, OpenError
from .paths import open_file

#: fixed values of the format
MAGIC, CONTINUATION = b"ARROW1", b"\xff\xff\xff\xff"
LEAST_SIZE = 22  # both magics, padding, an empty schema's length
MESSAGE_KIND, MESSAGE_HEADER, MESSAGE_BODY, BATCH_LENGTH, BATCH_COMPRESSION = 1, 2, 3, 0, 3  # field numbers in Message and RecordBatch
DICTIONARY_KIND, BATCH_KIND = 2, 3  # values of MESSAGE_KIND
DICTIONARY_DATA = 1  # field number of the batch in DictionaryBatch
DICTIONARIES, BATCHES = 2, 3  # field numbers of the vectors of blocks in Footer
BLOCK, BLOCK_SIZE = "<qi4xq", 24  # where a message begins, bytes of its metadata, bytes of its body
READERS = 16  # metadata of so many batches is fetched at once from a remote file


@dataclass(frozen=True)
class BatchInfo:
    batch: int
    rows: int
    row_offset: int
    body_bytes: int


class OpenedFile:
    """A file whose frame has been checked: both magics, footer length, schema with at least one column."""

    def __init__(self, path: str, operation: str):
        self.path, self.operation = path, operation
        self.source = open_file(path, operation)
        try:
            size = self.source.size()
            if size < LEAST_SIZE:
                raise OpenError(operation, f"{path} has only {size} bytes")
            head = self.source.read_at(6, 0)
            tail = self.source.read_at(10, size - 10)
            footer = struct.unpack("<i", tail[:4])[0]
            if head != MAGIC or tail[4:] != MAGIC:
                raise OpenError(operation, f"{path} lacks the magic of an Arrow file")
            if not 0 < footer <= size - 18:
                raise OpenError(operation, f"{path} has a footer of {footer} bytes")
            self.reader = ipc.open_file(self.source)
            self.schema = self.reader.schema
            self.size = size
            self.footer = (size - 10 - footer, footer)
        except (OSError, pa.ArrowException, struct.error, UnicodeDecodeError) as e:
            self.source.close()
            raise OpenError(operation, f"{path}: {e}") from e
        except OpenError:
            self.source.close()
            raise
        if not len(self.schema):
            self.source.close()
            raise OpenError(operation, f"{path} has no columns")

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.source.close()

    def blocks(self) -> dict[str, list[tuple[int, int, int]]]:
        """(begin, bytes of metadata, bytes of body) of each dictionary and record batch, as the footer tells."""
        at, size = self.footer
        data = self.source.read_at(size, at)
        try:
            root = _follow(data, 0)
            out = {kind: _vector(data, _place(data, root, n)) for kind, n in (("dictionary", DICTIONARIES), ("record batch", BATCHES))}
        except (struct.error, ValueError, IndexError) as e:
            raise BatchParseError(self.operation, f"{self.path}: {e}") from e
        for begin, metadata, body in (b for kind in out.values() for b in kind):
            if begin < 8 or metadata < 8 or body < 0 or begin + metadata + body > at:
                raise BatchParseError(self.operation, f"{self.path}: a batch at {begin} of {metadata} + {body} bytes")
        return out

    def facts(self, block: tuple[int, int, int], dictionary: bool) -> tuple[int, bool]:
        """(rows, whether compressed) of a batch; reads its metadata only."""
        begin, size, body = block
        try:
            data = self.source.read_at(size, begin)
            skip = 8 if data[:4] == CONTINUATION else 4  # files of old writers lack the mark
            n = struct.unpack_from("<i", data, skip - 4)[0]
            if not 0 < n <= len(data) - skip:
                raise ValueError(f"a message of {n} bytes")
            return _batch_facts(data[skip : skip + n], dictionary, body)
        except (OSError, pa.ArrowException, struct.error, ValueError, IndexError) as e:
            raise BatchParseError(self.operation, f"{self.path}: {e}") from e

    def batches(self, strict: bool = True) -> list[BatchInfo]:
        """All record batches; a compressed one, or a compressed dictionary, is an error unless strict is off. No body is read."""
        blocks = self.blocks()
        own = blocks["record batch"]
        if len(own) != self.reader.num_record_batches:
            raise BatchParseError(self.operation, f"{self.path} has {len(own)} of {self.reader.num_record_batches} batches")
        wanted = [(b, False) for b in own] + ([(b, True) for b in blocks["dictionary"]] if strict else [])
        if isinstance(self.source, pa.MemoryMappedFile) or len(wanted) < 2:
            facts = [self.facts(*w) for w in wanted]
        else:
            with ThreadPoolExecutor(min(READERS, len(wanted))) as pool:
                facts = list(pool.map(lambda w: self.facts(*w), wanted))
        if strict and any(compressed for _, compressed in facts):
            raise CompressedBody(self.operation, self.path)
        out, upto = [], 0
        for (_, _, body), (rows, _) in zip(own, facts, strict=False):
            out.append(BatchInfo(len(out), rows, upto, body))
            upto += rows
        return out


def _place(data: bytes, table: int, number: int) -> int:
    """Where a table's field lies; 0 if it isn't there."""
    vtable = table - struct.unpack_from("<i", data, table)[0]
    if vtable < 0 or 4 + 2 * number >= struct.unpack_from("<H", data, vtable)[0]:
        return 0
    off = struct.unpack_from("<H", data, vtable + 4 + 2 * number)[0]
    return table + off if off else 0


def _follow(data: bytes, at: int) -> int:
    return at + struct.unpack_from("<I", data, at)[0]


def _vector(data: bytes, at: int) -> list[tuple[int, int, int]]:
    if not at:
        return []
    at = _follow(data, at)
    n = struct.unpack_from("<I", data, at)[0]
    if at + 4 + n * BLOCK_SIZE > len(data):
        raise ValueError(f"a list of {n} batches")
    return [struct.unpack_from(BLOCK, data, at + 4 + i * BLOCK_SIZE) for i in range(n)]


def _batch_facts(data: bytes, dictionary: bool, body: int) -> tuple[int, bool]:
    message = _follow(data, 0)
    kind, size = _place(data, message, MESSAGE_KIND), _place(data, message, MESSAGE_BODY)
    if not kind or data[kind] != (DICTIONARY_KIND if dictionary else BATCH_KIND) or (struct.unpack_from("<q", data, size)[0] if size else 0) != body:
        raise ValueError("the footer points at another message")
    table = _follow(data, _place(data, message, MESSAGE_HEADER))
    if dictionary:
        table = _follow(data, _place(data, table, DICTIONARY_DATA))
    at = _place(data, table, BATCH_LENGTH)
    rows = struct.unpack_from("<q", data, at)[0] if at else 0
    if rows < 0:
        raise ValueError(f"a batch of {rows} rows")
    return rows, bool(_place(data, table, BATCH_COMPRESSION))
