"""Connected components of a graph given as pairs of longs, by contraction.

Each round every node points at its smallest neighbour (a partial aggregate, so a node with very many
links isn't gathered in one task), pointers are followed until they rest on roots, and the links are
rewritten between roots. Links inside a component vanish; the rounds end when none are left, after a
number that grows with the logarithm of the nodes. All tables stay distributed and each round is
written to the shared scratch folder, so nothing depends on executors that may be lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep


def _pointers(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("node"), F.col("b").alias("to")).unionAll(links.select("b", "a"))
    return both.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("root"))


def _jump(pointers: DataFrame) -> DataFrame:
    """One doubling of the pointers: node -> root of its root."""
    above = pointers.select(F.col("node").alias("root"), F.col("root").alias("far"))
    return pointers.join(above, "root", "left").select("node", F.coalesce("far", "root").alias("root"))


def components(links: DataFrame) -> DataFrame:
    """links(a long, b long) -> (node, root): every node of a link and the smallest node it can reach.

    Self links and repeated links do no harm; a null end is no link. An empty table gives an empty table.
    """
    links = keep(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    known = None
    while not links.isEmpty():
        pointers = keep(_pointers(links), "pointers")
        while True:
            pointers = keep(_jump(pointers), "pointers")
            roots = pointers.where("node = root").select(F.col("node").alias("root"))
            if pointers.join(roots, "root", "left_anti").isEmpty():
                break
        left = pointers.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = pointers.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        half = keep(links.join(left, "a").select("ra", "b"), "half")
        rest = half.join(right, "b").where("ra <> rb")
        links = keep(rest.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
        if known is None:
            known = pointers
        else:
            now = pointers.select(F.col("node").alias("root"), F.col("root").alias("now"))
            known = keep(known.join(now, "root", "left").select("node", F.coalesce("now", "root").alias("root")), "known")
    if known is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return known
