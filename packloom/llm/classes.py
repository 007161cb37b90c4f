"""Classes of equal rows: pairs between differing spellings of a class, and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packloom.functions.session import delete, settle


def spelled_pairs(rows: DataFrame, group: list[str]) -> DataFrame:
    """Pairs (*group, ``a`` < ``b``) of keys ``k`` of one class ``group`` whose ``raw`` differs.

    Exact copies are joined as one, so a class that a third of all rows belong to costs no more than its result.
    """
    many = rows.groupBy(*group).agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).where("lo < hi").select(*group)
    members, _ = settle(rows.select(*group, "raw", "k").join(many, group, "left_semi"))  # few: most classes have one spelling
    spelled = members.groupBy(*group, "raw").agg(F.min("k").alias("least")).drop("least")
    links = spelled.join(spelled.withColumnRenamed("raw", "raw2"), group).where("raw < raw2")
    one = members.join(links, [*group, "raw"]).select(*group, F.col("raw2").alias("raw"), F.col("k").alias("k1"))
    both = one.join(members, [*group, "raw"])
    return both.select(*group, F.least("k1", "k").alias("a"), F.greatest("k1", "k").alias("b")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Nodes of ``edges`` with the least node of their component: (``node``, ``component``).

    Alternating large-star and small-star: each round links every node's larger neighbours, then its smaller ones,
    to the least node near it, until the set of links stays as it is. A round is settled as a table in the shared
    folder. Stars are aggregated before they are joined, so a hub costs as many rows as it has links. Null ends and
    loops are left out; repeated edges count once; no edges give no rows. More than ``rounds`` rounds, which a
    logarithmic number of rounds should never need, raise RuntimeError.
    """
    spark = edges.sparkSession
    links, path = settle(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct())
    paths = [path]
    for _ in range(rounds):
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        # large star: every larger neighbour goes to the least one
        big = links.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v"))
        big = big.where("u > v").distinct()
        # small star: every smaller neighbour, and the node itself, goes to the least of them
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        after, path = settle(small.where("u > v").distinct())
        sums = [F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")]
        same = links.agg(*sums).first() == after.agg(*sums).first()
        links = after
        paths.append(path)
        if len(paths) > 2:
            delete(spark, paths.pop(0))
        if same:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(links.select("v", "v").distinct())
    raise RuntimeError("components did not converge")
