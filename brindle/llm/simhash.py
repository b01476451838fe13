"""6. SimHash near-dedup by a generalised pigeonhole.

Fingerprints: every bit of the XXH64 of each 3-word shingle votes; a bit is 1 if over half are.
Equal fingerprints are one node from there on, so groups of copies never meet as rows.

Search: bits that vary together are grouped into parts (from the correlation of all fingerprints). If
the parts' thresholds t_i add up to K - m + 1, two fingerprints that differ in at most K bits differ in
at most t_i bits of some part i. Which thresholds (-1: part unused) cost least is found by dynamic
programming over candidate counts, estimated for each part from a sample; several m are compared. A
fingerprint is stored under each used part's value and probes all values within t_i of its own.
Candidates are verified by popcount where they meet, and each task emits only a spanning forest of the
links it finds.

A value that more than ``HOT`` stored rows share is not compared pair by pair: those rows go through
another level, where the bits not yet used are cut into four new parts, and so on until few bits are
left. No pair is lost and no task works on more than ``HOT`` rows of a value at once.

``op6`` stops there: fingerprints of 3-word shingles, links at 3 bits. ``dedup`` looks for near copies in
the sense of five-word shingles with a Jaccard similarity of ``SIMILAR`` or more. Its fingerprints are
made of a text's distinct words, as one changed word turns five shingles but only one word: texts that
similar then differ in few bits, so ``NEAR`` bits suffice for nearly all (README has the figures). The
components that the links give are only candidates; inside each, texts are verified by their exact sets
of shingles. A component of more than ``BLOCK`` texts is first compared with one text, its centre; only
texts unlike the centre are then compared with all others, in blocks, so none is left out and no task
holds more than two blocks.

Nulls: a null or blank text has fingerprint 0, linked like any other; texts without words are all alike.
Null doc_id: its row gets a fingerprint; the component's id is the smallest doc_id that isn't null, and
in ``dedup`` such a row comes after all that have one. Repeated rows are answered each by ``op6``; of rows
alike in doc_id and text ``dedup`` keeps one. Texts are told apart by 128 bits. Empty tables give empty
tables.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SMALL, Forest, bounded, join_unique, keep, numbered, runs, text_keys, texts
from .components import components

K = 3
SHINGLE = 3
SEED = 42
HOT = 4096
NEAR = 7  # bits that near copies may differ in, for dedup
WORDS = 5  # of the shingles that dedup verifies by
SIMILAR = 0.8
BLOCK = 512  # texts of a component that are verified at once
CENTRES = 2_000  # up to so many centres are broadcast, if their shingles are at most
CENTRE_WORDS = 4_000_000
SAMPLE = 20_000  # fingerprints from which candidate counts are estimated
ROW_COST, PAIR_COST = 2.6e-6, 9e-9  # seconds of a core for a row that is dealt out, for a pair that is compared; measured on one machine


def split(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _shingles(words: list[bytes], size: int, step: int = 65_536):
    """Hashes of all shingles, some at a time, so that those of a long text aren't all held at once."""
    size = min(size, len(words))
    for lo in range(0, len(words) - size + 1 if words else 0, step):
        part = words[lo : lo + step + size - 1]
        yield np.fromiter((xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(*(part[i:] for i in range(size)), strict=False)), np.uint64)


def _vote(hashes) -> int:
    votes, n = np.zeros(64, np.int64), 0
    for h in hashes:
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def fingerprint(text: str | None) -> int:
    return _vote(_shingles(split(text), SHINGLE))


def word_fingerprint(text: str | None) -> int:
    """Of the distinct words, each with one vote."""
    return _vote(_shingles(list(dict.fromkeys(split(text))), 1))


def shingle_set(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles; texts without words have one that they share."""
    parts = list(_shingles(split(text), size))
    return np.unique(np.concatenate(parts)) if parts else np.zeros(1, np.uint64)


def _fingerprints(of):
    def run(batches):
        for b in batches:
            fps = np.fromiter((of(t) for some in texts(b.column(b.schema.get_field_index("text"))) for t in some), np.uint64, b.num_rows)
            names = [n for n in b.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(n)) for n in names] + [pa.array(fps.view(np.int64))], names=[*names, "fp"])

    return run


def fingerprints(docs: DataFrame, of=fingerprint) -> DataFrame:
    """(doc_id, k1, k2, fp): the text's keys, and fp as a signed long."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", *text_keys(F.col("text")), "text").mapInArrow(_fingerprints(of), f"doc_id {kind}, k1 long, k2 long, fp long")


# --- the plan: parts of correlated bits, thresholds by dynamic programming ---


def _together(batches):
    """How often two bits are set together, and (in the last row) the number of fingerprints, of one task."""
    sums, n = np.zeros((64, 64)), 0
    for b in batches:
        fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
        for lo in range(0, len(bits), 65_536):
            sums += bits[lo : lo + 65_536].T @ bits[lo : lo + 65_536]
        n += len(bits)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4097), pa.int32()), pa.array(np.append(sums.ravel(), n).astype(np.int64))], names=["cell", "n"])


def correlations(fps: DataFrame) -> tuple[np.ndarray, int]:
    """|correlation| of the 64 bits over all fingerprints, and their number; 4,097 rows reach the driver."""
    rows = fps.select("fp").mapInArrow(_together, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    got = np.zeros(4097)
    for r in rows:
        got[r["cell"]] = r["n"]
    n = max(1.0, got[4096])
    both = got[:4096].reshape(64, 64) / n
    p = both.diagonal()
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return np.abs((both - np.outer(p, p)) / np.outer(sd, sd)), int(got[4096])


def parts_of(corr: np.ndarray, m: int) -> list[list[int]]:
    """m parts of about equal width: each grows from a free bit by the free bit most correlated with it."""
    free, parts = set(range(64)), []
    for i in range(m):
        width = 64 // m + (i < 64 % m)
        seed = max(free, key=lambda b: (sum(corr[b][c] for c in free), -b))
        part = [seed]
        free.discard(seed)
        while len(part) < width:
            best = max(free, key=lambda b: (sum(corr[b][c] for c in part), -b))
            part.append(best)
            free.discard(best)
        parts.append(sorted(part))
    return parts


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _flips(bits: list[int], t: int) -> np.ndarray:
    return np.array([_mask(list(c)) for r in range(t + 1) for c in combinations(bits, r)], np.uint64)


def costs(sample: np.ndarray, n: int, bits: list[int], k: int) -> dict[int, float]:
    """Estimated seconds of using a part with threshold t: rows dealt out, and stored rows compared with all rows of their value, or dealt out anew where these are more than HOT."""
    values, counts = np.unique(sample & np.uint64(_mask(bits)), return_counts=True)
    scale, out = n / max(1, len(sample)), {-1: 0.0}
    for t in (0, 1, 2):
        flips = _flips(bits, t)
        if len(flips) > 600:
            break
        probes = np.zeros(len(values), np.int64)
        for f in flips[1:] if len(values) else []:
            at = np.minimum(np.searchsorted(values, values ^ f), len(values) - 1)
            probes += np.where(values[at] == values ^ f, counts[at], 0)
        hot = (counts + probes) * scale > HOT
        pairs = float((counts * (counts / 2 + probes))[~hot].sum())
        again = float((counts + probes)[hot].sum()) * (k + 1)
        out[t] = (n * len(flips) + again * scale) * ROW_COST + pairs * scale**2 * PAIR_COST
    return out


def allocate(by_part: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds that add up to total at the least cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in by_part:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for s, (c, ts) in best.items():
            for t, x in cost.items():
                if s + t not in nxt or c + x < nxt[s + t][0]:
                    nxt[s + t] = (c + x, [*ts, t])
        best = nxt
    return best.get(total, (float("inf"), []))


def plan(fps: DataFrame, k: int = K) -> list[tuple[int, int]]:
    """(mask of the part, its threshold) for every part that is used."""
    corr, n = correlations(fps)
    share = min(1.0, SAMPLE / max(1, n))
    picked = fps.where(F.pmod(F.xxhash64("fp"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000) + 1)).select("fp").limit(2 * SAMPLE)
    sample = np.array([r["fp"] for r in picked.collect()], np.int64).view(np.uint64)
    tried = []
    for m in range(2, k + 4):
        parts = parts_of(corr, m)
        cost, ts = allocate([costs(sample, n, p, k) for p in parts], k - m + 1)
        if ts:
            tried.append((cost, m, [(_mask(p), t) for p, t in zip(parts, ts, strict=True) if t >= 0]))
    return min(tried)[2]


# --- the search ---

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _key(value: np.ndarray, salt: int) -> np.ndarray:
    h = (value ^ np.uint64(salt * 0xD6E8FEB86659FD93 & (1 << 64) - 1)) * _MIX
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def _rows(key, fp, probe, left):
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp.view(np.int64)), pa.array(probe), pa.array(left.view(np.int64))], names=["key", "fp", "probe", "left_bits"])


def _first_keys(used: list[tuple[int, int]]):
    """A stored row for each part, and probes for the values around it."""

    def run(batches):
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i, (mask, t) in enumerate(used):
                bits = [k for k in range(64) if mask >> k & 1]
                for f in _flips(bits, t):
                    key = _key((fps & np.uint64(mask)) ^ f, i + 1)
                    yield _rows(key, fps, np.full(len(fps), bool(f)), np.full(len(fps), ~np.uint64(mask)))

    return run


def _next_keys(k: int):
    """The bits not used so far, in k + 1 parts of threshold 0, under the hot key they were found in."""

    def run(batches):
        for b in batches:
            key, fps, left = (b.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(3))
            for mask in np.unique(left):
                own = left == mask
                bits = [i for i in range(64) if int(mask) >> i & 1]
                for j in range(k + 1):
                    sub = np.uint64(_mask(bits[j :: k + 1]))
                    yield _rows(_key((fps[own] & sub) ^ _key(key[own], 77), j + 1), fps[own], np.zeros(own.sum(), bool), np.full(own.sum(), mask & ~sub))

    return run


def _compare(fps: np.ndarray, probe: np.ndarray, starts: np.ndarray, lengths: np.ndarray, forest: Forest, k: int) -> None:
    """Joins all links within each run. Short runs together, by distance; long ones in blocks."""
    short = lengths <= 48
    at, room = starts[short], lengths[short]
    pos = np.repeat(at, room) + (np.arange(room.sum()) - np.repeat(np.cumsum(room) - room, room)) if len(at) else np.zeros(0, np.int64)
    end = np.repeat(at + room, room) if len(at) else pos
    d = 1
    while len(pos):
        live = pos + d < end
        pos, end = pos[live], end[live]
        if not len(pos):
            break
        a, c = fps[pos], fps[pos + d]
        good = (np.bitwise_count(a ^ c) <= k) & ~(probe[pos] & probe[pos + d])
        for x, y in zip(a[good].view(np.int64).tolist(), c[good].view(np.int64).tolist(), strict=True):
            forest.join(x, y)
        d += 1
    for s, n in zip(starts[~short].tolist(), lengths[~short].tolist(), strict=True):
        asks = probe[s : s + n]
        stored = fps[s : s + n][~asks]
        own = np.concatenate((stored, fps[s : s + n][asks]))
        for lo in range(0, len(stored), 256):  # probes needn't be compared with each other
            x, y = np.nonzero(np.bitwise_count(stored[lo : lo + 256, None] ^ own[None, lo:]) <= k)
            good = y > x
            for p, q in zip(stored[lo + x[good]].view(np.int64).tolist(), own[lo + y[good]].view(np.int64).tolist(), strict=True):
                forest.join(p, q)


def _meet(last: bool, k: int):
    """Rows sorted by key -> links (a, b), or rows of hot keys (a: fp, b: key, left_bits: bits for the next level)."""

    def flush(parts, forest, whole):
        key, fp, probe, left = (np.concatenate(x) for x in zip(*parts, strict=True))
        starts, lengths = runs(key)
        rest = []
        if not whole:  # the last run may go on
            s = starts[-1]
            rest = [tuple(x[s:].copy() for x in (key, fp, probe, left))]
            starts, lengths = starts[:-1], lengths[:-1]
        more = lengths > 1
        starts, lengths = starts[more], lengths[more]
        hot = (lengths > HOT) & ~np.full(len(lengths), last)
        _compare(fp, probe, starts[~hot], lengths[~hot], forest, k)
        out = [_hot(fp[s : s + n], key[s : s + n], left[s : s + n]) for s, n in zip(starts[hot], lengths[hot], strict=True)]
        return rest, out

    def _hot(fp, key, left):
        return pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(key.view(np.int64)), pa.array(left.view(np.int64))], names=["a", "b", "left_bits"])

    def links(forest):
        a, b = forest.stars()
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.nulls(len(a), pa.int64())], names=["a", "b", "left_bits"])

    def run(batches):
        forest, parts, n, spilling = Forest(), [], 0, None
        for b in batches:
            if not b.num_rows:
                continue
            key, fp, left = (b.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1, 3))
            probe = b.column(2).to_numpy(zero_copy_only=False)
            if spilling is not None:  # within a hot key's rows
                own = key == spilling
                if own.any():
                    yield _hot(fp[own], key[own], left[own])
                if own.all():
                    continue
                key, fp, probe, left = key[~own], fp[~own], probe[~own], left[~own]
                spilling = None
            parts.append((key, fp, probe, left))
            n += len(key)
            if n >= 65_536:
                parts, out = flush(parts, forest, False)
                yield from out
                n = sum(len(p[0]) for p in parts)
                if n > HOT and not last:
                    yield _hot(parts[0][1], parts[0][0], parts[0][3])
                    spilling, parts, n = parts[0][0][0], [], 0
            if len(forest.up) > 500_000:
                yield links(forest)
                forest = Forest()
        if parts:
            _, out = flush(parts, forest, True)
            yield from out
        yield links(forest)

    return run


def links(fps: DataFrame, k: int = K) -> DataFrame:
    """fps(fp), distinct -> (a, b): links whose components are those of all pairs that differ in at most k bits."""
    used = plan(fps, k)
    rows = fps.select("fp").mapInArrow(_first_keys(used), "key long, fp long, probe boolean, left_bits long")
    found, bits = [], 64 - min(bin(m).count("1") for m, _ in used)
    while True:
        last = bits <= max(12, k)  # few different values are left
        dealt = rows.repartition("key").sortWithinPartitions("key").mapInArrow(_meet(last, k), "a long, b long, left_bits long")
        got = keep(dealt, "simhash")
        found.append(got.where("left_bits is null").select("a", "b"))
        hot = got.where("left_bits is not null")
        if last or hot.isEmpty():
            break
        rows = hot.select(F.col("b").alias("key"), F.col("a").alias("fp"), "left_bits").distinct().mapInArrow(_next_keys(k), "key long, fp long, probe boolean, left_bits long")
        bits -= max(1, bits // (k + 1))
    out = found[0]
    for f in found[1:]:
        out = out.unionAll(f)
    return out


def _components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((doc_id, k1, k2, fp), (fp, component_id, n)), both written; n rows have fp."""
    each = keep(fingerprints(docs), "fingerprints")
    nodes = keep(each.groupBy("fp").agg(F.min("doc_id").alias("id"), F.count("*").alias("n")), "nodes")
    roots = components(links(nodes)).select(F.col("node").alias("fp"), "root")
    named = keep(nodes.join(roots, "fp", "left").select("fp", "id", "n", "root"), "named")
    size = F.count("*").alias("n")
    linked = named.where("root is not null")
    ids = keep(linked.groupBy("root").agg(F.min("id").alias("component_id"), size), "ids")
    told = join_unique(linked, ids, ["root"], linked.count()).select("fp", "component_id", "n")
    return each, keep(told.unionAll(named.where("root is null").select("fp", "id", "n")), "classes")


def op6(docs: DataFrame) -> DataFrame:
    each, classes = _components(docs)
    return join_unique(each, classes, ["fp"], each.count()).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# --- near copies by exact sets of shingles, for dedup ---


def alike(a: np.ndarray, b: np.ndarray, similar: float = SIMILAR) -> bool:
    """Whether two sets, as sorted arrays, have a Jaccard similarity of at least `similar`."""
    if min(len(a), len(b)) < similar * max(len(a), len(b)):
        return False
    both = len(a) + len(b) - len(np.union1d(a, b))
    return both >= similar * (len(a) + len(b) - both) - 1e-9


def _sets(similar_of: str):
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                sets = [shingle_set(t).view(np.int64) for some in texts(part.column(part.schema.get_field_index(similar_of))) for t in some]
                names = [n for n in part.schema.names if n != similar_of]
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(n)) for n in names] + [pa.array(sets, pa.list_(pa.int64()))], names=[*names, "words"])

    return run


def _set_of(column: pa.Array, i: int) -> np.ndarray:
    return column[i].values.to_numpy(zero_copy_only=False)


def _to_centre(batches):
    """root, node, words, centre, centre_words -> root, node, words, and whether the text is unlike the centre."""
    for b in batches:
        own, centre = b.column(2), b.column(4)
        unlike = [not alike(_set_of(own, i), _set_of(centre, i)) for i in range(b.num_rows)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), own, b.column(3), pa.array(unlike, pa.bool_())], names=["root", "node", "words", "centre", "fringe"])


def _verify(batches):
    """Rows of a key stand together -> links (a, b). A text is compared with a cluster until one member is near; two of side 1 never are."""
    at, clusters = None, []
    for b in batches:
        left, right = [], []
        key, node, side = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()
        for r, (k, n, s) in enumerate(zip(key, node, side, strict=True)):
            if k != at:
                at, clusters = k, []
            own, near = _set_of(b.column(3), r), []
            for c in clusters:
                for i, (other, words, t) in enumerate(c):
                    if not (s and t) and alike(words, own):
                        if i:  # a member that matches is likely to match again
                            c.insert(0, c.pop(i))
                        left.append(other)
                        right.append(n)
                        near.append(c)
                        break
            home = near[0] if near else []
            for c in near[1:]:
                home.extend(c)
                clusters.remove(c)
            home.append((n, own.copy(), s))
            if not near:
                clusters.append(home)
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def verified(members: DataFrame) -> DataFrame:
    """members(root, node, words) -> (a, b): links whose components are those of all pairs of a root's texts that are alike."""
    sizes = members.groupBy("root").agg(F.count("*").alias("n"), F.min("node").alias("centre"))
    large = keep(sizes.where(F.col("n") > BLOCK), "large_groups")
    found = None
    if large.isEmpty():
        dealt = members.select(F.col("root").alias("key"), "node", F.lit(0).alias("side"), "words")
    else:
        mine = F.broadcast(large) if bounded(large, SMALL) else large
        centres = keep(members.join(mine, "root").where("node = centre").select("root", "centre", F.col("words").alias("centre_words")), "centres")
        held = centres.agg(F.coalesce(F.sum(F.size("centre_words")), F.lit(0)).alias("n")).first()["n"]
        near = F.broadcast(centres) if held <= CENTRE_WORDS and bounded(centres, CENTRES) else centres
        told = members.join(near, "root").select("root", "node", "words", "centre", "centre_words")
        told = keep(told.mapInArrow(_to_centre, "root long, node long, words array<long>, centre long, fringe boolean"), "to_centre")
        found = told.where("not fringe and node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b"))
        shape = told.groupBy("root").agg(F.sum(F.col("fringe").cast("long")).alias("f"), F.count("*").alias("n"))
        blocks = lambda n: F.ceil(n * 2 / BLOCK).cast("int")
        shape = keep(shape.where("f > 0").select("root", blocks(F.col("f")).alias("fb"), blocks(F.col("n") - F.col("f")).alias("cb")), "shape")
        rows = told.join(F.broadcast(shape) if bounded(shape, SMALL) else shape, "root")
        of = lambda n: F.pmod(F.xxhash64("node"), F.greatest(F.col(n), F.lit(1))).cast("int")
        own, other = of("fb"), of("cb")
        upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
        with_fringe = F.transform(upto("fb"), lambda j: F.xxhash64("root", F.lit(0), F.least(own, j), F.greatest(own, j)))
        with_core = F.transform(upto("cb"), lambda j: F.xxhash64("root", F.lit(1), own, j))
        from_core = F.transform(upto("fb"), lambda j: F.xxhash64("root", F.lit(1), j, other))
        key = F.explode(F.when(F.col("fringe"), F.concat(with_fringe, with_core)).otherwise(from_core)).alias("key")
        dealt = members.join(mine, "root", "left_anti").select(F.xxhash64("root", F.lit(2)).alias("key"), "node", F.lit(0).alias("side"), "words")
        dealt = dealt.unionAll(rows.select(key, "node", F.when(F.col("fringe"), 0).otherwise(1).alias("side"), "words"))
    links_ = dealt.repartition("key").sortWithinPartitions("key", "side", "node").mapInArrow(_verify, "a long, b long")
    return links_ if found is None else links_.unionAll(found)


def near_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """docs(doc_id, text) -> ((doc_id, k1, k2, n): rows alike, (k1, k2, doc_id, class): texts with their smallest doc_id and the node that names their class), both written."""
    entries = fingerprints(docs, word_fingerprint).groupBy("doc_id", "k1", "k2").agg(F.min("fp").alias("fp"), F.count("*").alias("n"))
    entries = keep(entries, "entries")
    each = entries.groupBy("k1", "k2").agg(F.min("fp").alias("fp"), F.min("doc_id").alias("doc_id"))
    each = keep(each.withColumn("node", F.monotonically_increasing_id()), "texts")
    fps = keep(each.groupBy("fp").agg(F.count("*").alias("n")), "fps")
    roots = components(links(fps, NEAR)).select(F.col("node").alias("fp"), "root")
    # only fingerprints that two texts have, or that are linked, make candidates
    shared = keep(fps.join(roots, "fp", "left").where("n > 1 or root is not null").select("fp", "n", F.coalesce("root", "fp").alias("root")), "shared")
    wanted = keep(join_unique(each, shared, ["fp"], each.count()).where("root is not null").select("root", "node", "k1", "k2"), "candidates")
    near = F.broadcast(wanted) if bounded(wanted, SMALL) else wanted
    some = docs.select("text", *text_keys(F.col("text"))).join(near, ["k1", "k2"]).select("root", "node", "text")
    sets = some.mapInArrow(_sets("text"), "root long, node long, words array<long>").groupBy("root", "node").agg(F.first("words").alias("words"))
    classes = components(verified(keep(sets, "shingles"))).select("node", F.col("root").alias("class"))
    return entries, keep(each.join(classes, "node", "left").select("k1", "k2", "doc_id", F.coalesce("class", "node").alias("class")), "near_classes")


def dedup(docs: DataFrame) -> DataFrame:
    """One row of docs for each class of near copies, with docs' columns: that of the smallest doc_id (null last), and of its texts the one with the smallest key.

    A doc_id with different texts may so stay for several classes, once for each. Rows alike in doc_id and
    text are one; if their other columns differ, a hash of the row decides which stays.
    """
    entries, classes = near_classes(docs.select("doc_id", "text"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")).alias("best")
    first = classes.groupBy("class").agg(best).select("best.doc_id", "best.k1", "best.k2", F.lit(True).alias("stays"))
    row = [entries[n].eqNullSafe(first[n]) for n in ("doc_id", "k1", "k2")]
    odd = entries.join(first, row[0] & row[1] & row[2], "left").where("n > 1 or stays is null")
    odd = keep(odd.select(entries["doc_id"].alias("odd_id"), entries["k1"].alias("odd_1"), entries["k2"].alias("odd_2"), F.coalesce("stays", F.lit(False)).alias("stays")), "not_single")
    inner, back = numbered(docs, "doc_id", "text")
    few = F.broadcast(odd) if bounded(odd, SMALL) else odd
    k1, k2 = text_keys(inner["text"])
    same = inner["doc_id"].eqNullSafe(F.col("odd_id")) & (k1 == F.col("odd_1")) & (k2 == F.col("odd_2"))
    # rows that stand once and stay pass by; of repeated ones that stay, one does
    single = inner.join(few, same, "left_anti").select(*back)
    if odd.where("stays").isEmpty():
        return single
    names = inner.columns
    again = inner.join(few.where("stays"), same, "left_semi").groupBy("doc_id", *text_keys(F.col("text"))).agg(F.min_by(F.struct(*names), F.xxhash64(*names)).alias("row"))
    return single.unionAll(again.select("row.*").select(*back))


def signed(spark: SparkSession, values: list[int]) -> DataFrame:
    """Fingerprints given as unsigned numbers, for trying links() alone."""
    return spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
