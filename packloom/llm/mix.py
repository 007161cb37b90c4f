"""Problem 8: mixing sources to target weights.

Method: hash-random keys, range-sort within each source, distributed prefix sums of token counts, a cut at each
source's exact budget, and repeated epochs where a source is too small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from packloom.functions.session import settle
from packloom.functions.text import not_blank

TOKENS = "greatest(1, length({0}) div 4)"
PER_RANGE = 50_000
"""Rows of a range of keys; the ranges' sums are added up first, so no task orders more than about this many rows."""


def _ranges(n: int) -> int:
    return max(1, -(-n // PER_RANGE))


def sized(documents: DataFrame, doc: str = "doc_id", source: str = "source", text: str = "text", seed: int = 7) -> DataFrame:
    """(``doc``, ``source``, ``tokens``, ``before``): where each document's tokens begin in its source's random order.

    Null and blank texts and null keys or sources are left out. Repeated rows of one key count as one document of
    the least text. Ties of the random key go to the smaller key.
    """
    rows = documents.where(F.col(doc).isNotNull() & F.col(source).isNotNull() & not_blank(text))
    rows = rows.select(F.col(doc).alias("doc"), F.col(source).alias("source"), F.expr(TOKENS.format(f"`{text}`")).cast("long").alias("tokens"))
    rows = rows.groupBy("doc", "source").agg(F.min("tokens").alias("tokens"))
    n = documents.count()
    # the upper bits of a row's random key name its range; the rest orders it within
    rows = rows.withColumn("key", F.xxhash64(F.lit(seed), "doc")).withColumn("range", F.expr(f"cast(floor((cast(key as double) / 18446744073709551616.0 + 0.5) * {_ranges(n)}) as int)"))
    order = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("source", "range").agg(F.sum("tokens").alias("s")).withColumn("base", F.coalesce(F.sum("s").over(order), F.lit(0))).drop("s")
    within = Window.partitionBy("source", "range").orderBy("key", "doc").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
    return settle(rows.join(sums, ["source", "range"]).select("doc", "source", "tokens", (F.col("base") + F.col("inner")).alias("before")))[0]


def plan(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Each target's budget: (``mix_id``, ``source``, ``share``, ``budget``, ``own``, ``most``, ``epochs``, ``rest``, ``short``).

    ``rows`` is the result of ``sized``. A source's budget is its share of the weights times the tokens of all
    documents of the mix's sources; ``epochs`` whole passes and a ``rest`` of tokens fill it, within ``max_repeats``
    passes. ``short``: the source can't reach its budget. Null or negative weights count as 0, null repeats as 1, a
    source without documents has no tokens; of repeated (mix, source) rows the largest weight holds.
    """
    own = rows.groupBy("source").agg(F.sum("tokens").alias("own"))
    t = targets.where("mix_id is not null and source is not null").groupBy("mix_id", "source")
    t = t.agg(F.greatest(F.max("weight"), F.lit(0.0)).alias("weight"), F.greatest(F.max(F.coalesce("max_repeats", F.lit(1))), F.lit(0)).alias("repeats"))
    t = t.withColumn("weight", F.coalesce("weight", F.lit(0.0))).join(own, "source", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    mix = Window.partitionBy("mix_id")
    share = F.when(F.sum("weight").over(mix) > 0, F.col("weight") / F.sum("weight").over(mix)).otherwise(0.0)
    t = t.withColumn("share", share).withColumn("budget", F.col("share") * F.sum("own").over(mix)).withColumn("most", F.col("repeats") * F.col("own"))
    given = F.least("budget", F.col("most").cast("double"))
    epochs = F.when(F.col("own") > 0, F.floor(given / F.col("own"))).otherwise(0).cast("long")
    t = t.withColumn("epochs", epochs).withColumn("rest", given - F.col("epochs") * F.col("own"))
    return t.select("mix_id", "source", "share", "budget", "own", "most", "epochs", "rest", (F.col("budget") > F.col("most")).alias("short"))


def mixture(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(``mix_id``, ``source``, ``doc_id``, ``tokens``, ``repeats``): how often each document is in each mix.

    Whole passes, and one more for the documents up to the cut; the one that the cut falls into is taken if more
    than half of it lies before. Documents repeated no times are left out.
    """
    chosen = plans.where("epochs > 0 or rest > 0").select("mix_id", "source", "epochs", "rest")
    once = ((2 * F.col("before") + F.col("tokens")) < 2 * F.col("rest")).cast("long")
    out = rows.join(chosen, "source").select("mix_id", "source", F.col("doc").alias("doc_id"), "tokens", (F.col("epochs") + once).alias("repeats"))
    return out.where("repeats > 0")


def shares(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The report: each (``mix_id``, ``source``) with its target share, budget, tokens reached, actual share and ``short``."""
    got = mixture(rows, plans).groupBy("mix_id", "source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("reached"), F.count("*").alias("documents"))
    out = plans.join(got, ["mix_id", "source"], "left").withColumns({"reached": F.coalesce("reached", F.lit(0)), "documents": F.coalesce("documents", F.lit(0))})
    total = F.sum("reached").over(Window.partitionBy("mix_id"))
    actual = F.when(total > 0, F.col("reached") / total).otherwise(0.0)
    return out.select("mix_id", "source", "share", "budget", "reached", "documents", actual.alias("actual_share"), "short")
