"""9. Quality classifier: an interpolated modified Kneser-Ney model of characters.

The model is trained on trusted text (documents labelled quality 1, but for a part that is set aside):
counts of all ``ORDER``-grams of characters, and continuation counts below that, are distributed tables,
made with partial sums. For scoring, the distinct grams of all documents are collected in the same way,
and their probabilities are found by joining them with the count tables, sharded by gram, order by order.
The documents then stream once past the most frequent of these grams, at most ``HEAD`` of them, which are
broadcast; what a document has of the others is joined with the rest of the table and summed by document.
So the probability table may have any size, and texts are never shuffled. A document is kept if its
perplexity lies between two quantiles of its language. These are taken from the trusted documents that
were set aside, as text that the model has seen is no measure; the documents it was trained on are kept.

Characters are numbered in 12 bits, so a gram is a long: code points below ``PLAIN`` as they are, any other
as two symbols (its upper and its lower ten bits), so no two characters are mistaken for each other.

Nulls: a null or empty text has no characters, perplexity null, and isn't kept. A null language is a
language of its own; languages without trusted documents set aside use the quantiles of all languages,
and without any, every document that has characters is kept. Rows that share a doc_id share its label.
Repeated rows are answered each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, keep, opened, share, texts

ORDER = 5
LOW, HIGH = 0.002, 0.995  # quantiles of the trusted documents of a language that bound what is kept
HEAD = 2_000_000  # grams that are broadcast
ASIDE = 4  # one of so many trusted texts is set aside to take the quantiles from
LABELS = 1_000_000  # up to so many trusted ids are broadcast
LANGUAGES = 100_000  # up to so many languages' quantiles are broadcast
VOCABULARY = 4096
_BITS, PLAIN = 12, 4096 - 1088 - 1024  # 1,088 upper halves of code points, 1,024 lower ones
PIECE = 1_000_000  # characters that a task works on at a time


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[list[tuple[int, str, str]]]:
    """(row, characters before, characters) of all texts, at most `limit` characters at a time."""
    held, n, row = [], 0, 0
    for some in texts(column, 64):
        for t in some:
            t = t or ""
            for at in range(0, len(t), limit):
                part = t[at : at + limit]
                if held and n + len(part) > limit:
                    yield held
                    held, n = [], 0
                held.append((row, t[max(0, at - ORDER + 1) : at].rjust(ORDER - 1, "\x01"), part))
                n += len(part)
            row += 1
    if held:
        yield held


def symbols(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points as symbols below VOCABULARY, and how many each takes."""
    wide = c >= PLAIN
    size = np.where(wide, 2, 1)
    out = np.repeat(c, size)
    at = np.cumsum(size) - size
    out[at[wide]] = PLAIN + (c[wide] >> 10)
    out[at[wide] + 1] = PLAIN + 1088 + (c[wide] & 1023)
    return out, size


def codes(some: list[tuple[int, str, str]]) -> tuple[np.ndarray, np.ndarray]:
    """(the gram that ends at each symbol, its row) for some pieces."""
    sizes = np.array([len(t) for _, _, t in some], np.int64)
    c = np.frombuffer("".join(before + t for _, before, t in some).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    starts = np.cumsum(sizes + ORDER - 1) - (sizes + ORDER - 1)
    real = np.ones(len(c), bool)
    real[(starts[:, None] + np.arange(ORDER - 1)).ravel()] = False
    g, size = symbols(c)
    real, rows = np.repeat(real, size), np.repeat(np.repeat(np.array([r for r, _, _ in some]), sizes + ORDER - 1), size)
    whole = g.copy()
    for i in range(1, ORDER):
        whole[i:] |= g[:-i] << (_BITS * i)
    return whole[real], rows[real]


def _grams(batches):
    """Grams and their counts, summed for a task."""
    table = pd.Series(dtype=np.int64)
    parts, n = [], 0
    for b in batches:
        for some in pieces(b.column(0)):
            g, _ = codes(some)
            where, kinds = pd.factorize(g)
            parts.append(pd.Series(np.bincount(where, minlength=len(kinds)), index=kinds))
            n += len(kinds)
            if n > 3_000_000:
                table = pd.concat([table, *parts]).groupby(level=0).sum()
                parts, n = [], 0
                if len(table) > 2_000_000:  # more than a task should hold: pass it on
                    yield from _batches(table)
                    table = table[:0]
    if parts:
        yield from _batches(pd.concat([table, *parts]).groupby(level=0).sum())
    elif len(table):
        yield from _batches(table)


def _batches(table: pd.Series):
    for lo in range(0, len(table), 100_000):
        part = table.iloc[lo : lo + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(part.index.to_numpy(np.int64)), pa.array(part.to_numpy(np.int64))], names=["gram", "n"])


def gram_counts(text: DataFrame) -> DataFrame:
    """text(text) -> (gram, n)"""
    return text.mapInArrow(_grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def suffix(gram: Column, k: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << _BITS * k) - 1))


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """D1, D2 and D3+ from the counts of counts."""
    r = counts.agg(*[F.sum(F.when(F.col("n") == i, 1).otherwise(0)).alias(f"n{i}") for i in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (float(r[f"n{i}"] or 0) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    d = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return tuple(min(max(x, 0.05), i + 0.95) for i, x in enumerate(d))


class Model:
    """Count tables of all orders, highest first made from text, the others from what they follow."""

    def __init__(self, top: DataFrame):
        self.counts = {ORDER: keep(top, "grams5")}
        for k in range(ORDER - 1, 0, -1):
            lower = self.counts[k + 1].groupBy(suffix(F.col("gram"), k).alias("gram")).agg(F.count("*").alias("n"))
            self.counts[k] = keep(lower, f"grams{k}")
        self.discounts = {k: discounts(t) for k, t in self.counts.items()}

    def contexts(self, k: int) -> DataFrame:
        """(h, total, gamma): what follows each context of k - 1 characters."""
        d = self.discounts[k]
        n = F.col("n")
        taken = F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])
        return self.counts[k].groupBy(F.shiftright("gram", _BITS).alias("h")).agg(F.sum("n").alias("total"), (F.sum(taken) / F.sum("n")).alias("gamma"))

    def probabilities(self, wanted: DataFrame) -> DataFrame:
        """wanted(gram), distinct, of the highest order -> (gram, p)."""
        levels = {ORDER: wanted}
        for k in range(ORDER - 1, 0, -1):
            levels[k] = keep(levels[k + 1].select(suffix(F.col("gram"), k).alias("gram")).distinct(), f"wanted{k}")
        below = None
        for k in range(1, ORDER + 1):
            d = self.discounts[k]
            rows = levels[k].select("gram", F.shiftright("gram", _BITS).alias("h"), suffix(F.col("gram"), k - 1).alias("low"))
            rows = rows.join(self.counts[k], "gram", "left").join(self.contexts(k), "h", "left")
            if below is None:
                rows = rows.withColumn("q", F.lit(1.0 / VOCABULARY))
            else:
                rows = rows.join(below.select(F.col("gram").alias("low"), F.col("p").alias("q")), "low")
            n = F.col("n")
            cut = F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])
            p = F.when(F.col("total").isNull(), F.col("q")).otherwise(F.coalesce((n - cut) / F.col("total"), F.lit(0.0)) + F.col("gamma") * F.col("q"))
            below = keep(rows.select("gram", p.alias("p")), f"p{k}")
        return below


def _sums(shared):
    """For each document a row with what the grams of the broadcast table give it, and a row for each other gram of it, with its count."""

    def run(batches):
        grams, logs = opened(shared)
        for b in batches:
            column, ids = b.column(b.schema.get_field_index("text")), b.column(b.schema.get_field_index("row"))
            out = np.zeros(b.num_rows)
            for some in pieces(column):
                g, own = codes(some)
                where, kinds = pd.factorize(g)
                value, known = np.zeros(len(kinds)), np.zeros(len(kinds), bool)
                if len(grams) and len(kinds):
                    order = np.argsort(kinds)
                    spot = np.empty(len(kinds), np.int64)
                    spot[order] = np.minimum(np.searchsorted(grams, kinds[order]), len(grams) - 1)
                    known = grams[spot] == kinds
                    value = np.where(known, logs[spot], 0.0)
                out += np.bincount(own, weights=value[where], minlength=len(out))
                rest = ~known[where]
                if rest.any():
                    pair, n = np.unique(np.stack((own[rest], g[rest])), axis=1, return_counts=True)
                    k = pa.nulls(len(n), pa.int64())
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(pair[0])), k, pa.nulls(len(n), b.schema.field("lang").type), k, pa.nulls(len(n), pa.float64()), pa.nulls(len(n), pa.bool_()), pa.array(pair[1]), pa.array(n)], names=NAMES)
            size = pc.fill_null(pc.cast(pc.utf8_length(column), pa.int64()), 0)
            none = pa.nulls(b.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([ids, *(b.column(b.schema.get_field_index(n)) for n in ("doc_id", "lang")), size, pa.array(out), b.column(b.schema.get_field_index("aside")), none, none], names=NAMES)

    return run


NAMES = ["row", "doc_id", "lang", "size", "log_sum", "aside", "gram", "n"]


def head(table: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(grams, logs) of the most frequent of table(gram, n, l), at most `limit`; and the count below which a gram isn't among them."""
    step = F.floor(F.log2("n") * 16).cast("int")
    least, upto = 1 << 62, 0
    for r in sorted(table.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min("n").alias("least")).collect(), key=lambda r: -r["step"]):  # some hundred rows
        upto += r["n"]
        if upto > limit:
            break
        least = r["least"]
    part = table.where(F.col("n") >= least).select("gram", F.col("l").cast("float").alias("l")).toArrow()
    grams, logs = (part.column(n).to_numpy() for n in ("gram", "l"))
    order = np.argsort(grams)
    return grams[order], logs[order], least


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()


def perplexities(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs(doc_id, lang, text) -> doc_id, lang, size, perplexity, trusted, aside (trusted, and not trained on)."""
    spark = docs.sparkSession
    ids = keep(trusted_ids(labels).withColumnRenamed("doc_id", "known"), "trusted")
    near = F.broadcast(ids) if bounded(ids, LABELS) else ids
    # copies of a text are on the same side
    aside = F.coalesce(F.pmod(F.xxhash64(F.lit(9), "text"), F.lit(ASIDE)) == 0, F.lit(False))
    top = gram_counts(docs.join(near, docs["doc_id"] == near["known"], "left_semi").where(~aside).select("text"))
    model = Model(top)
    wanted = keep(gram_counts(docs.select("text")), "wanted5")
    table = keep(model.probabilities(wanted.select("gram")).join(wanted, "gram").select("gram", "n", F.log("p").alias("l")), "logs")
    grams, logs, least = head(table, HEAD)
    kind = docs.schema["doc_id"].dataType.simpleString()
    plain = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "lang", "text", aside.alias("aside"))
    # rows are numbered and read once, so a lost executor's are numbered alike
    seen = plain.mapInArrow(_sums(share(spark, (grams, logs))), f"row long, doc_id {kind}, lang string, size long, log_sum double, aside boolean, gram long, n long")
    seen = keep(seen, "sums")
    out = seen.where("gram is null").select("row", "doc_id", "lang", "size", "log_sum", "aside")
    if len(grams) < table.count():
        rest = seen.where("gram is not null").select("row", "gram", "n").join(table.where(F.col("n") < least).select("gram", "l"), "gram")
        rest = rest.groupBy("row").agg(F.sum(F.col("n") * F.col("l")).alias("rest"))
        out = out.join(rest, "row", "left").withColumn("log_sum", F.col("log_sum") + F.coalesce("rest", F.lit(0.0)))
    out = out.select("doc_id", "lang", "size", F.when(F.col("size") > 0, F.exp(-F.col("log_sum") / F.col("size"))).alias("perplexity"), "aside")
    known = F.col("known").isNotNull()
    return out.join(near, out["doc_id"] == near["known"], "left").select("doc_id", "lang", "size", "perplexity", known.alias("trusted"), (known & F.col("aside")).alias("aside"))


def op9(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, size, perplexity, low, high, kept."""
    scored = keep(perplexities(docs, labels), "perplexity")
    both = lambda: F.percentile_approx("perplexity", F.array(F.lit(LOW), F.lit(HIGH)), F.lit(10_000)).alias("q")
    fine = scored.where("aside and perplexity is not null")
    by_lang = keep(fine.groupBy(F.col("lang").alias("l")).agg(both()), "quantiles")
    by_lang = F.broadcast(by_lang) if bounded(by_lang, LANGUAGES) else by_lang
    any_ = fine.agg(both()).first()["q"] or [0.0, float("inf")]
    out = scored.join(by_lang, scored["lang"].eqNullSafe(F.col("l")), "left")
    low, high = F.coalesce(F.col("q")[0], F.lit(float(any_[0]))), F.coalesce(F.col("q")[1], F.lit(float(any_[1])))
    fits = (F.col("perplexity") >= low) & (F.col("perplexity") <= high) | F.col("trusted") & ~F.col("aside") & F.col("perplexity").isNotNull()
    return out.select("doc_id", "lang", "size", "perplexity", low.alias("low"), high.alias("high"), F.coalesce(fits, F.lit(False)).alias("kept"))
