"""10. Line dedup by a segment-partition edit join.

Lines of at least ``MIN_CHARS`` characters are near copies if their edit distance is at most ``EDITS``.
A line is cut into EDITS + 1 segments, so of two near copies the shorter has a segment that stands
unchanged in the longer, at a place that the lengths and the edits to its left and right bound. Every
distinct line stores its segments under (length, segment number, content) and probes the substrings
that could be such a segment of a line of its own or one or two characters less length.

The join has three steps. Keys are hashes made while the documents stream past, a line once for each
task. Keys that only one line has are dropped; what is left names the lines that may have a near copy.
Only those lines' texts are then read and dealt out by key, where they are verified by a banded edit
distance: the 2 * EDITS + 1 diagonals are compared bit-parallel, as whole-line XORs, and the furthest
reach of each number of edits is extended along them. A task emits one link for a line that joins a
cluster, never all pairs. A key with more than ``HOT`` lines is cut into blocks, each two of which are one
task's work, so none is lost and no task holds more.

Links and equal lines form classes (connected components). Of a class the first line, by doc_id, text and
place, stays; shorter lines are only compared for equality, blank lines stay.

Every row of the table is a document of its own, numbered as it is read, also where doc_ids are null or
repeated; of equal rows one comes first. Nulls: a null or empty text has no lines. A null doc_id sorts
first. Empty tables give empty tables. Lines are named by 128 bits; only the search for keys that two
lines share makes do with half of them, and there a collision loses nothing but the two lines' own link.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, join_unique, keep, numbered, runs, texts
from .components import components

EDITS = 2
MIN_CHARS = 20
LIVE = 1_000_000  # up to so many line ids are broadcast
HOT = 8_192  # lines of a key that are verified in one task; more are cut into blocks
HOT_CHARS = 32_000_000  # characters of a key's lines, likewise
HELD = 400_000  # line ids that a task remembers, to send a line's keys once


def line_id(line: str) -> tuple[int, int]:
    """A line's name: two signed longs."""
    return struct.unpack("<qq", xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass")))


def segments(length: int, edits: int = EDITS) -> list[tuple[int, int]]:
    """(start, size) of edits + 1 segments of about equal size, the later ones the longer."""
    n = edits + 1
    out, at = [], 0
    for i in range(n):
        size = length // n + (i >= n - length % n)
        out.append((at, size))
        at += size
    return out


def probes(length: int, edits: int = EDITS) -> list[tuple[int, int, int, int]]:
    """(length of the shorter line, segment, start, size) of the substrings a line has to look up.

    For segment i at p of a line shorter by d, at most i edits are left of it and at most edits - i
    to its right (one of the segments keeps to both), which bounds how far it can have moved.
    """
    out = []
    for d in range(edits + 1):
        short = length - d
        if short < MIN_CHARS:
            continue
        for i, (p, size) in enumerate(segments(short, edits)):
            low = max(0, p - i, p + d - (edits - i))
            high = min(length - size, p + i, p + d + (edits - i))
            out += [(short, i, at, size) for at in range(low, high + 1)]
    return out


def within(a: str, b: str, edits: int = EDITS) -> bool:
    """Whether the edit distance is at most `edits`: furthest reach on each diagonal of the band."""
    n, m = len(a), len(b)
    if abs(n - m) > edits:
        return False
    s = int.from_bytes(a.encode("utf-32-le", "surrogatepass"), "little")
    t = int.from_bytes(b.encode("utf-32-le", "surrogatepass"), "little")
    differ: dict[int, int] = {}

    def slide(i: int, d: int) -> int:
        """From a[i], b[i + d], how far down a the two stay equal."""
        x = differ.get(d)
        if x is None:
            x = differ[d] = s ^ (t >> 32 * d if d >= 0 else t << -32 * d)
        end = min(n, m - d)
        x >>= 32 * i
        return end if not x else min(end, i + ((x & -x).bit_length() - 1) // 32)

    reach = {0: slide(0, 0)}
    for _ in range(edits):
        if reach.get(m - n) == n:
            return True
        nxt: dict[int, int] = {}
        for d, i in reach.items():
            for to, j in ((d, i + 1), (d - 1, i + 1), (d + 1, i)):
                if j <= n and 0 <= j + to <= m and abs(to) <= edits and j > nxt.get(to, -1):
                    nxt[to] = j
        reach = {d: slide(i, d) for d, i in nxt.items()}
    return reach.get(m - n) == n


def split_lines(text: str | None) -> list[str]:
    return text.split("\n") if text else []


_PROBES: dict[int, list] = {}


def _line_keys(line: str) -> list[tuple[int, bool]]:
    """(key, whether the line is stored under it) for the line's own segments and its probes."""
    n = len(line)
    shape = _PROBES.get(n)
    if shape is None:
        own = {(n, i, p, size) for i, (p, size) in enumerate(segments(n))}
        shape = [(*x, x in own) for x in probes(n)]
        if len(_PROBES) < 10_000:
            _PROBES[n] = shape
    return [(xxhash.xxh64_intdigest(line[at : at + size].encode("utf-8", "surrogatepass"), short * 8 + i), own) for short, i, at, size, own in shape]


def _keys(batches):
    seen: set[int] = set()
    keys, ids, stored = [], [], []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(ids, pa.int64()), pa.array(stored, pa.bool_())], names=["key", "line", "stored"])

    for b in batches:
        for some in texts(b.column(0)):
            for t in some:
                for line in split_lines(t):
                    if len(line) < MIN_CHARS:
                        continue
                    h = line_id(line)[0]
                    if h in seen:
                        continue
                    if len(seen) >= HELD:
                        seen.clear()
                    seen.add(h)
                    own = _line_keys(line)
                    keys += [k for k, _ in own]
                    stored += [s for _, s in own]
                    ids += [h] * len(own)
                    if len(keys) > 200_000:
                        yield batch()
                        keys, ids, stored = [], [], []
    yield batch()


class _Run:
    """A key's run of rows that may lie across batches: its lines are held back until a second one, and a stored one, is seen."""

    def __init__(self):
        self.lines = np.zeros(0, np.int64)
        self.stored = self.passed = False

    def add(self, line: np.ndarray, stored: np.ndarray) -> np.ndarray:
        """The lines to pass on now."""
        own = np.unique(line)
        self.stored = self.stored or bool(stored.any())
        if self.passed:
            return own
        self.lines = np.unique(np.concatenate((self.lines, own)))
        if len(self.lines) < 2 or not self.stored:
            return own[:0]
        self.passed, held, self.lines = True, self.lines, own[:0]
        return held


def _shared_keys(batches):
    """Sorted by key, then line -> (key, line) of keys that two or more lines have, one of them stored."""
    at, run = None, _Run()
    for b in batches:
        if not b.num_rows:
            continue
        key, line = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        stored = b.column(2).to_numpy(zero_copy_only=False)
        starts, sizes = runs(key)
        out = []
        goes_on = at is not None and key[0] == at
        if goes_on:
            out.append((key[0], run.add(line[: sizes[0]], stored[: sizes[0]])))
        # runs that lie whole inside this batch, all at once; the last one may go on in the next
        inner = np.arange(int(goes_on), len(starts) - 1)
        if len(inner):
            s, n = starts[inner], sizes[inner]
            with_stored = np.add.reduceat(stored[: starts[inner[-1] + 1]].astype(np.int64), s) > 0
            good = (line[s] != line[s + n - 1]) & with_stored
            out += [(key[i], np.unique(line[i : i + c])) for i, c in zip(s[good].tolist(), n[good].tolist(), strict=True)]
        if len(starts) > 1 or not goes_on:
            at, run = key[-1], _Run()
            out.append((at, run.add(line[starts[-1] :], stored[starts[-1] :])))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array([k for k, _ in out]), [len(x) for _, x in out])), pa.array(np.concatenate([x for _, x in out]))], names=["key", "line"])


def _texts_of(batches):
    """(line, check, text) of lines long enough, once for each task as far as it remembers."""
    seen: set[tuple[int, int]] = set()

    def batch(ids, out):
        return pa.RecordBatch.from_arrays([pa.array([h for h, _ in ids], pa.int64()), pa.array([c for _, c in ids], pa.int64()), pa.array(out, pa.string())], names=["line", "check", "text"])

    for b in batches:
        ids, out, size = [], [], 0
        for some in texts(b.column(0)):
            for t in some:
                for line in split_lines(t):
                    if len(line) >= MIN_CHARS and (h := line_id(line)) not in seen:
                        if len(seen) >= HELD:
                            seen.clear()
                        seen.add(h)
                        ids.append(h)
                        out.append(line)
                        size += len(line)
                if len(ids) > 5_000 or size > 4_000_000:
                    yield batch(ids, out)
                    ids, out, size = [], [], 0
        yield batch(ids, out)


def _verify(batches):
    """Rows of a key stand together -> links (a, b). A line is compared with a cluster until one member is near."""
    at, clusters = None, []
    done: dict[tuple[int, int], None] = {}
    for b in batches:
        left, right = [], []
        for k, line, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            if k != at:
                at, clusters = k, []
            near = []
            for c in clusters:
                for i, (other, words) in enumerate(c):
                    pair = (other, line) if other < line else (line, other)
                    known = pair in done
                    if known or within(words, text):
                        if i:  # a member that matches is likely to match again
                            c.insert(0, c.pop(i))
                        if not known and other != line:
                            if len(done) > 200_000:
                                done.clear()
                            done[pair] = None
                            left.append(other)
                            right.append(line)
                        near.append(c)
                        break
            if near:
                home = near[0]
                for c in near[1:]:
                    home.extend(c)
                    clusters.remove(c)
                home.append((line, text))
            else:
                clusters.append([(line, text)])
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def _in_blocks(shared: DataFrame) -> DataFrame:
    """shared(key, node, size) -> (key, node): lines of a key with more than HOT of them, or HOT_CHARS characters, in blocks. A key for each two blocks, so every two lines still meet."""
    blocks = F.ceil(F.greatest(F.col("n") * 2 / HOT, F.col("chars") * 2 / HOT_CHARS)).cast("int")
    hot = shared.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("chars")).where((F.col("n") > HOT) | (F.col("chars") > HOT_CHARS) & (F.col("n") > 2))
    hot = keep(hot.select(F.col("key").alias("hot"), F.least(blocks, F.col("n").cast("int")).alias("blocks")), "hot_line_keys")
    if hot.isEmpty():
        return shared.select("key", "node")
    rows = shared.join(F.broadcast(hot) if bounded(hot, LIVE) else hot, F.col("key") == F.col("hot"), "left")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.xxhash64("key", F.least(own, j), F.greatest(own, j)))
    return rows.select(F.explode(F.when(F.col("hot").isNull(), F.array("key")).otherwise(pair)).alias("key"), "node")


def near_lines(docs: DataFrame) -> DataFrame:
    """docs(text) -> (line, check, root), written: lines near another one, and the number of their class."""
    keyed = docs.select("text").mapInArrow(_keys, "key long, line long, stored boolean")
    shared = keyed.repartition("key").sortWithinPartitions("key", "line").mapInArrow(_shared_keys, "key long, line long")
    shared = keep(shared, "line_keys")
    live = keep(shared.select("line").distinct(), "live_lines")
    near = F.broadcast(live) if bounded(live, LIVE) else live
    found = docs.select("text").mapInArrow(_texts_of, "line long, check long, text string").join(near, "line", "left_semi")
    found = found.groupBy("line", "check").agg(F.first("text").alias("text"))
    found = keep(found.select(F.monotonically_increasing_id().alias("node"), "line", "check", "text", F.length("text").alias("size")), "line_texts")
    spots = shared.join(found.select("node", "line", "size"), "line")
    dealt = _in_blocks(spots.select("key", "node", "size")).join(found.select("node", "text"), "node").select("key", "node", "text")
    links = dealt.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_verify, "a long, b long")
    return keep(components(links).join(found, "node").select("line", "check", "root"), "line_classes")


def _occurrences(batches):
    """All lines of each row, or where it has none a row without a place."""
    for b in batches:
        keys = [b.column(b.schema.get_field_index(n)) for n in ("row", "doc_id", "k1")]
        at = 0
        for some in texts(b.column(b.schema.get_field_index("text")), 32):
            own, place, line, check, size = [], [], [], [], []
            for j, t in enumerate(some):
                for i, x in enumerate(split_lines(t) or [None]):
                    h, c = line_id(x) if x and x.strip() else (None, None)
                    own.append(at + j)
                    place.append(None if x is None else i)
                    line.append(h)
                    check.append(c)
                    size.append(len(x or ""))
            at += len(some)
            where = pa.array(own, pa.int64())
            yield pa.RecordBatch.from_arrays([*(k.take(where) for k in keys), *(pa.array(x, pa.int64()) for x in (place, line, check, size))], names=["row", "doc_id", "k1", "place", "line", "check", "size"])


def marked_lines(rows: DataFrame) -> DataFrame:
    """rows(row, doc_id, text), row being unique where it is read once -> row, doc_id, place, size, repeated: all lines, and whether an earlier one of their class stays; a row without lines has one with a null place."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    each = rows.select("row", "doc_id", F.xxhash64("text").alias("k1"), "text").mapInArrow(_occurrences, f"row long, doc_id {kind}, k1 long, place long, line long, check long, size long")
    each = keep(each, "lines")
    full, blank = each.where("line is not null"), each.where("line is null")
    names = ["line", "check"]
    kinds = keep(full.groupBy(*names).agg(F.min(F.struct("doc_id", "k1", "row", "place")).alias("first"), F.count("*").alias("n")), "kinds")
    classes = near_lines(rows)
    classes = F.broadcast(classes) if bounded(classes, LIVE) else classes
    # lines that stand once and are near no other are never repeats
    kinds = keep(kinds.join(classes, names, "left").where("n > 1 or root is not null"), "shared_lines")
    alone = kinds.where("root is null").select(*names, "first", "n")
    first = kinds.where("root is not null").groupBy("root").agg(F.min("first").alias("first"))
    linked = kinds.where("root is not null").drop("first").join(first, "root").select(*names, "first", "n")
    firsts = keep(alone.unionAll(linked), "firsts")
    out = join_unique(full, firsts, names, full.count())
    later = F.col("first").isNotNull() & ~((F.col("first.row") == F.col("row")) & (F.col("first.place") == F.col("place")))
    return out.select("row", "doc_id", "place", "size", later.alias("repeated")).unionAll(blank.select("row", "doc_id", "place", "size", F.lit(False)))


def op10(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, n_lines, n_repeated, kept_chars."""
    lines = marked_lines(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"))
    sums = (F.count("place").alias("n_lines"), F.sum(F.col("repeated").cast("long")).alias("n_repeated"), F.sum(F.when(F.col("repeated"), 0).otherwise(F.col("size"))).cast("long").alias("kept_chars"))
    return lines.groupBy("row").agg(F.first("doc_id").alias("doc_id"), *sums).drop("row")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """docs with repeated lines taken out of their texts."""
    inner, back = numbered(docs, "doc_id", "text")
    inner = keep(inner.withColumn("row", F.monotonically_increasing_id()), "line_rows")
    gone = marked_lines(inner.select("row", "doc_id", "text")).where("repeated").groupBy("row").agg(F.collect_set("place").alias("gone_"))
    rest = F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains("gone_", i.cast("long")))
    out = inner.join(gone, "row", "left")
    return out.withColumn("text", F.when(F.col("gone_").isNull(), F.col("text")).otherwise(F.array_join(rest, "\n"))).select(*back)
