"""5. Benchmark decontamination as a prefix-filtered set join over item-sized windows.

Every window of ``WINDOW`` item words (a shorter item is one window) is a set of shingles of up to
``SHINGLE`` words. A document that holds the window holds each of its shingles, so it is enough to look
for one: the rarest, by counts over all documents. The join is on that prefix shingle; a hit at
position p means the window can only start at p minus the shingle's offset, it must fit into the
document (length and positional bound), and its words must be equal (exact verification).

The distinct windows are a distributed table. The documents stream past twice, once to count shingles and
once for the hits, whatever the benchmark's size; their texts are not shuffled.

* Up to ``BLOCK_WINDOWS`` windows are broadcast (their number and bytes are checked), and hits are found
  and verified where the document is.
* Beyond that a bitmap of the windows' shingles, of at most 2 ** ``MOST_BITS`` bits, is broadcast. Shingles
  that pass it are counted in a table; each window's rarest one is its prefix. In the second pass the
  places that pass a bitmap of the prefixes are sent to the join on the prefix shingle, with the few words
  around them that a window can cover, and verified there.

Nulls: a null text, of a document or an item, has no words. Empty texts likewise. Items with equal
texts or equal ids count by id once. Null item_id: its windows count as hits but name no item.
Repeated documents are answered each. Empty tables give an empty table, or no hits.
"""

from __future__ import annotations

import numpy as np
import xxhash
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SMALL, bounded, keep, numbered, opened, share, texts, with_columns

WINDOW = 10
SHINGLE = 5
BLOCK_WINDOWS = 100_000
BLOCK_BYTES = 32_000_000
MOST_BITS = 27
CACHED = 300_000  # words whose hash a task remembers

#: 0-9, A-Z (lowered), a-z and everything from 0x80 are parts of words
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_P = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22  # of the bitmap that most positions are dismissed by


def split_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def _chain(ids: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n ids in a row; ids of 0 aren't words of any item."""
    m = len(ids) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = ids[:m].copy()
    for i in range(1, n):
        h = (h ^ (h >> np.uint64(29))) * _P + ids[i : i + m]
    return h ^ (h >> np.uint64(32))


class Block:
    """Windows, given as (item, words), with the words they use and, once counts are known, their prefix shingles."""

    def __init__(self, items: list[tuple]):
        self.words: dict[bytes, int] = {}
        self.windows: list[tuple[int, ...]] = []
        self.items: list[set] = []
        at: dict[tuple[int, ...], int] = {}
        for item, words in items:
            win = tuple(self.words.setdefault(w, len(self.words) + 1) for w in words)
            k = at.setdefault(win, len(self.windows))
            if k == len(self.windows):
                self.windows.append(win)
                self.items.append(set())
            self.items[k].add(item)
        self.sizes = sorted({min(SHINGLE, len(w)) for w in self.windows})
        self.keys = {n: np.unique(np.concatenate([_chain(np.array(w, np.uint64), n) for w in self.windows if min(SHINGLE, len(w)) == n])) for n in self.sizes}
        self.bits = {}
        for n, keys in self.keys.items():
            bits = np.zeros(1 << _BITS, bool)
            bits[(keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True
            self.bits[n] = bits
        self.prefix: dict[int, dict[int, list[tuple[int, int]]]] = {}

    def ids(self, words: list[bytes]) -> np.ndarray:
        get = self.words.get
        return np.fromiter((get(w, 0) for w in words), np.uint64, len(words))

    def found(self, ids: np.ndarray, n: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of shingles of n words whose hash is in keys (sorted), and which it is."""
        h = _chain(ids, n)
        at = np.flatnonzero(self.bits[n][(h >> np.uint64(64 - _BITS)).astype(np.int64)])
        if not len(at) or not len(keys):
            return at[:0], at[:0]
        where = np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)
        good = keys[where] == h[at]
        return at[good], where[good]

    def order(self, counts: dict[int, np.ndarray]) -> None:
        """Give every window its rarest shingle; of equally rare ones, the first."""
        for n in self.sizes:
            by: dict[int, list[tuple[int, int]]] = {}
            for k, w in enumerate(self.windows):
                if min(SHINGLE, len(w)) == n:
                    h = _chain(np.array(w, np.uint64), n)
                    where = np.searchsorted(self.keys[n], h)
                    off = int(np.argmin(counts[n][where]))
                    by.setdefault(int(h[off]), []).append((k, off))
            self.prefix[n] = by
            self.keys[n] = np.array(sorted(by), np.uint64)
            self.bits[n] = np.zeros(1 << _BITS, bool)
            self.bits[n][(self.keys[n] >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def hits(self, words: list[bytes]) -> list[tuple[int, int]]:
        """(start, window) of all occurrences in a document."""
        ids, out = self.ids(words), []
        total = len(words)
        for n in self.sizes:
            keys, by = self.keys[n], self.prefix[n]
            for p, k in zip(*(x.tolist() for x in self.found(ids, n, keys)), strict=True):
                for w, off in by[int(keys[k])]:
                    win, start = self.windows[w], p - off
                    if start >= 0 and start + len(win) <= total and tuple(ids[start : start + len(win)].tolist()) == win:
                        out.append((start, w))
        return out


def _count(docs: DataFrame, block: Block, shared) -> dict[int, np.ndarray]:
    """How often each shingle of the block occurs in all documents."""

    def run(batches):
        block = opened(shared)
        counts = {n: np.zeros(len(k), np.int64) for n, k in block.keys.items()}
        for b in batches:
            for part in texts(b.column(0)):
                for t in part:
                    ids = block.ids(split_words(t))
                    for n in block.sizes:
                        _, where = block.found(ids, n, block.keys[n])
                        if len(where):
                            counts[n] += np.bincount(where, minlength=len(counts[n]))
        for n, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), n), pa.int32()), pa.array(at, pa.int64()), pa.array(c[at], pa.int64())], names=["n", "k", "c"])

    out = {n: np.zeros(len(k), np.int64) for n, k in block.keys.items()}
    # as many rows as the block has shingles, at most
    for r in docs.select("text").mapInArrow(run, "n int, k long, c long").groupBy("n", "k").agg(F.sum("c").alias("c")).toLocalIterator():
        out[r["n"]][r["k"]] = r["c"]
    return out


def _windows(batches):
    """(item, win, size) of every window of every item; a window is its words with spaces between."""

    def batch(items, wins, sizes):
        return pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(wins, pa.string()), pa.array(sizes, pa.int32())], names=["item", "win", "size"])

    for b in batches:
        items, wins, sizes = [], [], []
        names = b.column(0).to_pylist()
        at = 0
        for some in texts(b.column(1)):
            for t in some:
                words = [w.decode("utf-8") for w in split_words(t)]
                size = min(WINDOW, len(words))
                for i in range(len(words) - size + 1 if words else 0):
                    items.append(names[at])
                    wins.append(" ".join(words[i : i + size]))
                    sizes.append(size)
                    if len(wins) >= 20_000:
                        yield batch(items, wins, sizes)
                        items, wins, sizes = [], [], []
                at += 1
        yield batch(items, wins, sizes)


ADDED = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("item_ids", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(T.LongType()))]


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """docs (with its columns) plus n_words, n_hit, spans (start, length), item_ids (sorted as strings)."""
    spark = docs.sparkSession
    new = {f.name for f in ADDED}
    docs = docs.select(*[F.col(f"`{n}`") for n in docs.columns if n not in new])
    windows = keep(benchmark.select(F.col("item_id").cast("string"), "text").mapInArrow(_windows, "item string, win string, size int").distinct(), "windows")
    n, size = windows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("win")), F.lit(0))).first()
    if n > block_windows or size > BLOCK_BYTES:
        return _joined(docs, windows)
    schema = T.StructType([*docs.schema.fields, *ADDED])
    if not n:
        return docs.mapInArrow(_mark(None), schema)
    rows = windows.select("item", "win").toArrow()
    block = Block([(i, w.encode("utf-8").split()) for i, w in zip(*(rows.column(c).to_pylist() for c in ("item", "win")), strict=True)])
    shared = share(spark, block)
    block.order(_count(docs, block, shared))
    shared.unpersist()
    return docs.mapInArrow(_mark(share(spark, block)), schema)


# --- beyond a block: the same by joins ---


class _Hashes(dict):
    """Word -> its hash, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _window_shingles(batches):
    """win_id, win -> (win_id, off, h) of all shingles of a window."""
    hashes = _Hashes()
    for b in batches:
        out = []
        for k, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            words = w.encode("utf-8").split()
            h = _chain(hashes.of(words), min(SHINGLE, len(words))).view(np.int64)
            out += [(k, off, x) for off, x in enumerate(h.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int32()), pa.array([r[2] for r in out], pa.int64())], names=["win_id", "off", "h"])


def _bitmap(hashes: DataFrame, n: int) -> np.ndarray:
    """A bit for the upper bits of each of n hashes (h): about 16 bits for each, 2 ** MOST_BITS in all at most."""
    bits = min(MOST_BITS, max(10, (16 * n).bit_length()))
    rows = hashes.select(F.shiftrightunsigned("h", 64 - bits).alias("place")).select(F.shiftright("place", 6).alias("at"), F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit"))
    rows = rows.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def _passing(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    place = h >> np.uint64(64 - (len(bitmap).bit_length() + 5))
    return np.flatnonzero(bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1))


def _shingle_counts(shared, sizes: list[int]):
    """(h, c): how often shingles that pass the bitmap occur, summed for a task."""

    def run(batches):
        bitmap, hashes, parts, n = opened(shared), _Hashes(), [], 0

        def batch():
            h, c = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
            total = np.bincount(c, weights=np.concatenate([p for _, p in parts]), minlength=len(h)).astype(np.int64)
            return h, total

        for b in batches:
            for some in texts(b.column(0)):
                for t in some:
                    ids = hashes.of(split_words(t))
                    for k in sizes:
                        h = _chain(ids, k)
                        h = h[_passing(bitmap, h)] if len(h) else h
                        if len(h):
                            parts.append((h, np.ones(len(h), np.int64)))
                            n += len(h)
                if n > 1_000_000:
                    parts = [batch()]
                    n = len(parts[0][0])
                    if n > 500_000:  # more than a task should hold
                        yield pa.RecordBatch.from_arrays([pa.array(parts[0][0].view(np.int64)), pa.array(parts[0][1])], names=["h", "c"])
                        parts, n = [], 0
        if parts:
            h, c = batch()
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], names=["h", "c"])

    return run


def _places(shared, sizes: list[int]):
    """A row with n_words for each document, and one for each place that passes: position, hash, the words from `reach` before it to WINDOW after, and reach."""

    def run(batches):
        bitmap, hashes = opened(shared), _Hashes()
        reach = WINDOW - SHINGLE
        for b in batches:
            ids = b.column(0).to_pylist()
            at = 0
            for some in texts(b.column(1), 64):
                out = []
                for t in some:
                    words = split_words(t)
                    own = hashes.of(words)
                    out.append((ids[at], len(words), None, None, None, None))
                    for k in sizes:
                        h = _chain(own, k)
                        for p in _passing(bitmap, h).tolist() if len(h) else []:
                            lo = max(0, p - reach)
                            out.append((ids[at], None, p, int(h[p].view(np.int64)), b" ".join(words[lo : p + WINDOW]).decode("utf-8"), p - lo))
                    at += 1
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["row", "n_words", "pos", "h", "around", "reach"])

    return run


def _joined(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """windows(item, win, size), written. What stands in docs, found by joins on prefix shingles."""
    spark = docs.sparkSession
    names = docs.columns
    docs = keep(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    wins = keep(windows.select("win", "size").distinct().withColumn("win_id", F.monotonically_increasing_id()), "distinct_windows")
    owners = keep(windows.where("item is not null").join(wins, ["win", "size"]).select("win_id", "item"), "owners")
    sizes = sorted({min(SHINGLE, r["size"]) for r in wins.select("size").distinct().collect()})
    shingles = keep(wins.select("win_id", "win").mapInArrow(_window_shingles, "win_id long, off int, h long"), "shingles")
    bitmap = share(spark, _bitmap(shingles, shingles.count()))
    counts = docs.select("text").mapInArrow(_shingle_counts(bitmap, sizes), "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    # a window with a shingle that no document has can't occur
    rarest = shingles.join(counts, "h", "left").groupBy("win_id").agg(F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "off", "h")).alias("r")).where("r.c > 0")
    prefixes = keep(rarest.join(wins, "win_id").select("r.h", "r.c", "r.off", "win_id", "win", "size"), "prefixes")
    bitmap.unpersist()
    marks = share(spark, _bitmap(prefixes, prefixes.count()))
    seen = keep(docs.select("_row", "text").mapInArrow(_places(marks, sizes), "row long, n_words long, pos long, h long, around string, reach int"), "places")
    places = seen.where("pos is not null")
    # prefixes that very many places share are broadcast, so that no key of the join is hot
    limit = places.count() // 10_000
    hot = keep(prefixes.where(F.col("c") > limit), "hot_prefixes")
    if bounded(hot, SMALL):
        met = places.join(F.broadcast(hot), "h").unionByName(places.join(prefixes.where(F.col("c") <= limit), "h"))
    else:
        met = places.join(prefixes, "h")
    start = F.col("reach") - F.col("off")
    same = F.array_join(F.slice(F.split("around", " "), F.greatest(start, F.lit(0)) + 1, F.col("size")), " ") == F.col("win")
    hits = keep(met.where((start >= 0) & same).select("row", (F.col("pos") - F.col("off")).alias("start"), F.col("size").cast("long").alias("size"), "win_id"), "hits")
    spans = hits.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "size"))).alias("found"))
    cover = lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0), x["start"] + x["size"] - F.greatest(x["start"], acc["upto"]))).alias("n"), F.greatest(acc["upto"], x["start"] + x["size"]).alias("upto"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    spans = spans.select("row", F.aggregate("found", zero, cover, lambda acc: acc["n"]).alias("n_hit"), F.flatten(F.transform("found", lambda x: F.array(x["start"], x["size"]))).alias("spans"))
    named = hits.select("row", "win_id").distinct().join(owners, "win_id").select("row", "item").distinct().groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("item_ids"))
    found = keep(spans.join(named, "row", "left"), "found")
    found = F.broadcast(found) if bounded(found, SMALL // 10) else found
    words = seen.where("pos is null").select("row", "n_words").join(found, "row", "left")
    none = lambda kind: F.array().cast(f"array<{kind}>")
    words = words.select(F.col("row").alias("_row"), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("item_ids", none("string")).alias("item_ids"), F.coalesce("spans", none("bigint")).alias("spans"))
    return docs.join(words, "_row").select(*[F.col(f"`{n}`") for n in names], *[f.name for f in ADDED])


def _mark(shared):
    """Adds what is found of a block."""

    def run(batches):
        block = opened(shared) if shared else None
        for b in batches:
            at, step = b.schema.get_field_index("text"), 2048
            for lo in range(0, b.num_rows, step):
                part = b.slice(lo, step)
                n_words, n_hit, items, spans = [], [], [], []
                for t in (t for some in texts(part.column(at)) for t in some):
                    words = split_words(t)
                    found = block.hits(words) if block else []
                    covered, upto, flat = 0, 0, []
                    for s, k in sorted({(s, len(block.windows[w])) for s, w in found}):
                        covered += max(0, s + k - max(s, upto))
                        upto = max(upto, s + k)
                        flat += [s, k]
                    n_words.append(len(words))
                    n_hit.append(covered)
                    items.append(sorted({x for _, w in found for x in block.items[w] if x is not None}))
                    spans.append(flat)
                yield with_columns(part, n_words=pa.array(n_words, pa.int64()), n_hit=pa.array(n_hit, pa.int64()), item_ids=pa.array(items, pa.list_(pa.string())), spans=pa.array(spans, pa.list_(pa.int64())))

    return run


def op5(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    out = decontaminate(docs.select("doc_id", "text"), benchmark)
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any hit, with docs' columns."""
    inner, back = numbered(docs, "text")
    return decontaminate(inner, benchmark).where("n_hit = 0").select(*back)
