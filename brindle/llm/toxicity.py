"""3. Toxicity by a lexicon trie intersected with Levenshtein automata.

The lexicon is learned from labelled rows: words, and word beginnings, that stand in toxic documents
far more often than chance allows. They form a trie. A word of a text is read by the product of that
trie with the Levenshtein automata of its terms, made deterministic step by step as words ask for it: a
state is the set of (trie node, edits so far) that the letters read can have reached, and most words
leave it after a few letters. Whole terms may be misspelled by one edit (two from ``LONG`` letters on);
a swap of neighbours is one edit. Beginnings must be exact.

Every match is then seen in its context window: a term between quotation marks, or after a word that
reports speech, counts apart from one that is used. A logistic model over these counts gives the score.

Fitting uses a bounded sample of labelled rows (``FIT_ROWS``, chosen by a hash of doc_id) outside the
held-out fold; any word of it, short or long, frequent or not, is tried as a term, and the evidence alone
decides. Scoring sees every whole text, and only the text.

Nulls: a null text is scored like an empty one; a null doc_id is never labelled. A document labelled
more than once counts as toxic if any label says so; of a doc_id with several texts one is fitted on. No
labels: score 0 for all. Extra columns with
clashing names are dropped by ``op3`` and kept by ``clean``.
"""

from __future__ import annotations

import re
from collections import Counter
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, numbered, texts, with_columns

FIT_ROWS = 20_000
CHANCE = 0.5  # terms that chance alone may bring into the lexicon; sets the evidence (G squared) that a term needs
PRECISION = 0.6  # share of a term's documents that are toxic, at least
SURE = 0.9  # the same for a beginning
LONG = 9
THRESHOLD = 0.3
AROUND = 80  # characters of context on either side
STEMS = (3, 4, 5, 6, 7, 8)  # letters of a beginning
HELD = 2_000_000  # entries of the automaton's states, and CACHED words, that a task remembers; it forgets all beyond
CACHED = 200_000

_WORD = re.compile(r"\w+")
_QUOTES = "\"'“”„«»‘’‹›"
_SAYS = re.compile(r"\b(said|says|wrote|called|quot\w*|sagte|schrieb|nannte|dit|écrit|appelé|dijo|escribió|llamó)\b")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


# --- trie and automaton ---


class Matcher:
    """Reads words; term -> (weight, is a beginning)."""

    def __init__(self, terms: dict[tuple[str, bool], float]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: dict[int, tuple[float, bool, int]] = {}
        for (term, stem), weight in sorted(terms.items()):
            node = 0
            for c in term:
                nxt = self.children[node].get(c)
                if nxt is None:
                    nxt = len(self.children)
                    self.children.append({})
                    self.children[node][c] = nxt
                node = nxt
            allowed = 0 if stem or len(term) < 4 else 2 if len(term) >= LONG else 1
            old = self.ends.get(node)
            if old is None or old[1] and not stem:
                self.ends[node] = (weight, stem, allowed)
        # most edits that any term below a node allows: lets hopeless states die early
        self.allowed = [0] * len(self.children)
        for node in range(len(self.children) - 1, -1, -1):
            own = self.ends.get(node, (0, 0, 0))[2]
            self.allowed[node] = max([own, *(self.allowed[x] for x in self.children[node].values())])
        self.reset()

    def reset(self) -> None:
        self.held = 0  # entries of all states
        self.names: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.begun: list[tuple[float, int] | None] = []  # a beginning that ends here
        self.ended: list[tuple[float, int] | None] = []  # the best term if the word ends here
        self.start = self._state({(0, 0, "")})

    def _state(self, states: set) -> int:
        """Number of a set of (node, edits, letter awaited by a swap), closed under missing letters; -1 if empty."""
        todo, best = list(states), {}
        while todo:
            node, e, swap = todo.pop()
            if e > self.allowed[node] or best.get((node, swap), 99) <= e:
                continue
            best[node, swap] = e
            if not swap and e < self.allowed[node]:
                todo += [(x, e + 1, "") for x in self.children[node].values()]
        if not best:
            return -1
        key = frozenset((n, e, s) for (n, s), e in best.items())
        k = self.names.setdefault(key, len(self.sets))
        if k == len(self.sets):
            self.sets.append(key)
            self.held += len(key) + 1
            self.moves.append({})
            ends = [(*self.ends[n], e) for n, e, s in key if not s and n in self.ends]
            self.begun.append(max(((w, 2) for w, stem, _, e in ends if stem and e == 0), default=None))
            found = [(w, -2 if stem else -int(e > 0)) for w, stem, allowed, e in ends if e <= allowed]
            self.ended.append((max(found)[0], -max(found)[1]) if found else None)
        return k

    def _move(self, k: int, c: str) -> int:
        out = set()
        for node, e, swap in self.sets[k]:
            kids = self.children[node]
            if swap:  # the letter before stood for the second of two; now the first must come
                if c == swap[0]:
                    out.add((self.children[kids[swap[0]]][swap[1]], e, ""))
                continue
            if c in kids:
                out.add((kids[c], e, ""))
            if e < self.allowed[node]:
                out.add((node, e + 1, ""))
                out |= {(x, e + 1, "") for y, x in kids.items() if y != c}
                out |= {(node, e + 1, y + c) for y, x in kids.items() if y != c and c in self.children[x]}
        to = self._state(out)
        self.moves[k][c] = to
        return to

    def find(self, word: str) -> tuple[float, int] | None:
        """(weight, kind) of the best match: kind 0 exact, 1 misspelled, 2 a beginning."""
        if self.held > HELD:
            self.reset()
        k, best, moves, begun = self.start, None, self.moves, self.begun
        for c in word:
            to = moves[k].get(c)
            k = self._move(k, c) if to is None else to
            if k < 0:
                break
            if begun[k] and (best is None or begun[k] > best):
                best = begun[k]
        else:
            end = self.ended[k]
            if end and (best is None or (end[0], -end[1]) > (best[0], -best[1])):
                best = end
        return best


class _Cache(dict):
    def __init__(self, matcher):
        super().__init__()
        self.matcher = matcher

    def __missing__(self, word):
        found = self.matcher.find(word)
        if len(word) <= 100:
            if len(self) > CACHED:
                self.clear()
            self[word] = found
        return found


# --- features and model ---

FEATURES = 9


def features(text: str | None, cache: _Cache) -> np.ndarray:
    out = np.zeros(FEATURES)
    out[0] = 1
    if not text:
        return out
    low = text.lower()
    words = _WORD.findall(low)
    found = [x for x in map(cache.__getitem__, words) if x]
    if not found:
        return out
    n, quoted, best, kinds = 0, 0, 0.0, [0, 0, 0]
    for m in _WORD.finditer(low):
        hit = cache[m[0]]
        if not hit:
            continue
        before, after = low[max(0, m.start() - AROUND) : m.start()], low[m.end() : m.end() + AROUND]
        said = any(q in before for q in _QUOTES) and any(q in after for q in _QUOTES) or bool(_SAYS.search(before))
        n += 1
        quoted += said
        if not said:
            kinds[hit[1]] += 1
            best = max(best, hit[0])
    out[1:4] = np.log1p(kinds)
    out[4] = best
    out[5] = np.log1p(quoted)
    out[6] = sum(kinds) / (len(words) + 20) * 10
    out[7] = float(sum(kinds) > 0)
    out[8] = float(sum(kinds) > 1)
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 30) -> np.ndarray:
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + penalty * w
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _sketches(batches):
    """The smallest hash of a text's runs of four words."""
    for b in batches:
        out = []
        for some in texts(b.column(0)):
            for t in some:
                words = t.encode("utf-8", "surrogatepass").lower().split()
                out.append(min((xxhash.xxh64_intdigest(b" ".join(r)) for r in zip(words, words[1:], words[2:], words[3:], strict=False)), default=xxhash.xxh64_intdigest(b" ".join(words))) >> 1)
        yield with_columns(b, sketch=pa.array(out, pa.int64()))


def _terms(batches):
    """Documents of each label that hold a word or beginning, summed for a task."""
    seen: list[Counter] = [Counter(), Counter()]
    for b in batches:
        labels = b.column(1).to_pylist()
        at = 0
        for some in texts(b.column(0)):
            for t in some:
                words = set(_WORD.findall(t.lower())) if t else set()
                own = {f"w{w}" for w in words}
                own |= {f"s{w[:n]}" for w in words for n in STEMS if len(w) > n}
                seen[labels[at]].update(own)
                at += 1
    names = list(seen[0].keys() | seen[1].keys())
    for lo in range(0, len(names), 50_000):
        part = names[lo : lo + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([seen[1][t] for t in part], pa.int64()), pa.array([seen[0][t] for t in part], pa.int64())], names=["term", "pos", "neg"])


def _g2(a: float, b: float, n1: float, n0: float) -> float:
    """G squared of a term in a of n1 toxic documents and b of n0 others."""
    rate = (a + b) / (n1 + n0)
    of = lambda x, n, p: x * np.log(x / (n * p)) if x > 0 else 0.0
    return 2 * sum(of(k, n, rate) + of(n - k, n, 1 - rate) for k, n in ((a, n1), (b, n0)))


def evidence(spread: dict[int, int], n1: float, n0: float) -> float:
    """G squared that a term needs, if `spread` says how many terms stand in so many documents.

    A term in few documents can't reach it even if all of them are toxic, so it isn't a trial (Tarone's
    correction): the need is set by the number of terms that stand in at least k documents, for the least
    k at which they could meet it.
    """
    tried, need = 0, float("inf")
    for k in sorted(spread, reverse=True):
        tried += spread[k]
        own = NormalDist().inv_cdf(1 - min(0.5, CHANCE / tried) / 2) ** 2
        if _g2(min(k, n1), max(0, k - n1), n1, n0) < own:
            break
        need = own
    return need


def lexicon(sample: DataFrame) -> dict[tuple[str, bool], float]:
    """sample(text, toxic) -> weights of terms by smoothed log odds: all that the evidence speaks for."""
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    pos_n, neg_n = n.get(1, 0), n.get(0, 0)
    if not pos_n or not neg_n:
        return {}
    a, b, n1, n0 = F.col("pos").cast("double"), F.col("neg").cast("double"), F.lit(float(pos_n)), F.lit(float(neg_n))
    rate = (a + b) / (n1 + n0)

    def part(k: Column, n: Column) -> Column:
        of = lambda x, p: F.when(x > 0, x * F.log(x / (n * p))).otherwise(0.0)
        return of(k, rate) + of(n - k, 1 - rate)

    odds = F.log((a + 0.5) / (n1 - a + 0.5)) - F.log((b + 0.5) / (n0 - b + 0.5))
    found = sample.select("text", "toxic").mapInArrow(_terms, "term string, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    tried = keep(found, "toxic_terms")
    spread = {r["k"]: r["n"] for r in tried.groupBy((F.col("pos") + F.col("neg")).alias("k")).agg(F.count("*").alias("n")).collect()}  # no more than documents in the sample
    need = evidence(spread, pos_n, neg_n)
    found = tried.where((a / n1 > b / n0) & (a / (a + b) >= PRECISION)).withColumn("g2", 2 * (part(a, n1) + part(b, n0))).where(F.col("g2") >= need)
    rows = found.withColumn("weight", odds).collect()
    return chosen([(r["term"][1:], r["term"][0] == "s", r["pos"], r["neg"], r["weight"]) for r in rows])


def chosen(rows: list[tuple[str, bool, int, int, float]]) -> dict[tuple[str, bool], float]:
    """Of terms (text, is a beginning, toxic documents, others, weight): beginnings that many words share stand for
    these words; a beginning that owes most of its documents to one word goes, so that word can be misspelled."""
    words = {t: (pos, w) for t, stem, pos, _, w in rows if not stem}
    most: Counter = Counter()
    for t, (pos, _) in words.items():
        for n in STEMS:
            most[t[:n]] = max(most[t[:n]], pos)
    stems: dict[str, float] = {}
    for t, stem, pos, neg, w in sorted(rows, key=lambda r: (len(r[0]), r[0])):
        if stem and pos >= SURE * (pos + neg) and most[t] < 0.8 * pos and not any(t.startswith(s) for s in stems):
            stems[t] = w
    covered = tuple(stems)
    return {(t, True): w for t, w in stems.items()} | {(t, False): w for t, (_, w) in words.items() if not t.startswith(covered)}


def fit(docs: DataFrame, labels: DataFrame) -> tuple[dict, np.ndarray]:
    """The lexicon and the model's weights, from at most about FIT_ROWS labelled rows outside the held-out fold."""
    spark = docs.sparkSession
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic"))
    share = min(1.0, FIT_ROWS / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000)).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).limit(2 * FIT_ROWS)
    # one text for each doc_id, so that repeated ids don't outgrow the bound
    sample = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(known), "doc_id")
    sample = sample.groupBy("doc_id").agg(F.max_by("text", F.xxhash64("text")).alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic")
    # copies and most near copies count once, or the words of a much copied document would pass for telling ones
    sketched = sample.mapInArrow(_sketches, "text string, toxic int, sketch long").groupBy("sketch").agg(F.max_by("text", F.xxhash64("text")).alias("text"), F.max("toxic").alias("toxic"))
    sample = keep(sketched.select("text", "toxic"), "toxic_sample")
    terms = lexicon(sample)
    if not terms:
        return {}, np.zeros(0)
    shared = spark.sparkContext.broadcast(terms)

    def run(batches):
        cache = _Cache(Matcher(shared.value))
        for b in batches:
            rows = [features(t, cache) for some in texts(b.column(0)) for t in some]
            yield pa.RecordBatch.from_arrays([pa.array([r.tolist() for r in rows], pa.list_(pa.float64())), b.column(1)], names=["x", "y"])

    rows = sample.select("text", "toxic").mapInArrow(run, "x array<double>, y int").collect()
    x = np.array([r["x"] for r in rows])
    return terms, fit_logistic(x, np.array([r["y"] for r in rows], float))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs (with text and its other columns, none named toxic_score) plus toxic_score, 0 to 1."""
    spark = docs.sparkSession
    terms, weights = fit(docs, labels)
    shared = spark.sparkContext.broadcast((terms, weights))

    def run(batches):
        terms, w = shared.value
        cache = _Cache(Matcher(terms))
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                part = b.slice(lo, 2048)
                column = part.column(part.schema.get_field_index("text"))
                if not terms:
                    yield with_columns(part, toxic_score=pa.array(np.zeros(part.num_rows)))
                    continue
                z = np.array([float(features(t, cache) @ w) for some in texts(column) for t in some])
                yield with_columns(part, toxic_score=pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30)))))

    out = docs.withColumn("toxic_score", F.lit(0.0).cast("double"))
    return docs.mapInArrow(run, out.schema)


def op3(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = score(docs.select("doc_id", "text"), labels)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= THRESHOLD).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those scored toxic, with docs' columns."""
    inner, back = numbered(docs, "doc_id", "text")
    return score(inner, labels).where(F.col("toxic_score") < THRESHOLD).select(*back)
