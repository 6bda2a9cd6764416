"""Connected components of a link table, by rounds of stars kept as tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filehaul.storage import delete_stored, store_once


def _stored(links: DataFrame) -> tuple[DataFrame, dict]:
    """Links as a table, with their number and a digest that tells two tables apart."""
    digest = F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))
    return store_once(links, "links", {"links": F.count("*"), "digest": digest})


def _round(links: DataFrame) -> DataFrame:
    """Tie the neighbours above every node, then those below it and itself, to the smallest node around it.

    Links go from the smaller to the larger end, before and after.
    """

    def least(of: DataFrame) -> DataFrame:
        return of.groupBy(F.col("v").alias("at")).agg(F.min("u").alias("least"))

    # A node's smallest neighbour, if below it, is the least of the links that end there.
    up = links.join(least(links), F.col("u") == F.col("at"), "left").select(F.coalesce("least", "u").alias("u"), "v")
    both = F.inline(F.array(F.struct(F.col("least").alias("u"), F.col("u").alias("v")), F.struct(F.col("least").alias("u"), "v")))
    return up.join(least(up), F.col("v") == F.col("at")).select(both).where("u <> v").distinct()


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of the links ``u, v``; root is the smallest node of its component.

    Links with a null end or with equal ends add nothing; an empty table gives
    an empty result. Every round is written to the shared folder, so a lost
    executor costs the running round only; the last stays, for
    ``delete_stored``. Raises if ``max_rounds`` do not do.
    """
    stars = links.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    stars, seen = _stored(stars)
    for _ in range(max_rounds):
        if not seen["links"]:
            break
        before = stars
        stars, found = _stored(_round(before))
        delete_stored(before)
        if found == seen:
            break
        seen = found
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    members = stars.select(F.col("v").alias("node"), F.col("u").alias("root"))
    roots = members.unionByName(stars.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())
    roots.stored_path = stars.stored_path
    return roots
