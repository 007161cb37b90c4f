"""Lexical retrieval: TF-IDF over one- and two-word terms, fitted and searched as joins and aggregates."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packloom.functions import stopwords
from packloom.functions.session import settle, ship

TOKEN = r"[\p{L}\p{N}_]{2,}"


def kept_words(text: Column | str, stop: tuple[str, ...] | None = None) -> Column:
    """The lower-cased words of a text, without stop words."""
    low = F.lower(F.col(text) if isinstance(text, str) else text)
    unwanted = list(stop if stop is not None else stopwords.load())
    words = F.regexp_extract_all(low, F.lit(TOKEN), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(unwanted)) if unwanted else words


def grams(words: str, ngrams: tuple[int, int] = (1, 2)) -> Column:
    """All n-grams of an array column of words; words on either side of a stop word are neighbours."""
    parts, longer = [], F.col(words)
    for n in range(1, ngrams[1] + 1):
        if n > 1:
            m = F.greatest(F.size(words) - (n - 1), F.lit(0))
            longer = F.zip_with(F.slice(longer, F.lit(1), m), F.slice(F.col(words), F.lit(n), m), lambda a, b: F.concat_ws(" ", a, b))
        if n >= ngrams[0]:
            parts.append(longer)
    return F.concat(*parts)


@dataclass
class Fitted:
    """A fitted corpus: ``vocabulary`` (term, feature_index, df, ctf, idf) and ``weights`` (chunk_index, term, tf, weight)."""

    vocabulary: DataFrame
    weights: DataFrame
    ngrams: tuple[int, int] = (1, 2)
    stop: tuple[str, ...] | None = None


def _words(rows: DataFrame, key: str, text: str, out: str, stop: tuple[str, ...] | None) -> DataFrame:
    return rows.where(F.col(text).isNotNull()).select(F.col(key).cast("long").alias(out), kept_words(text, stop).alias("words"))


def _weighted(batches: Iterator[pa.RecordBatch], terms: dict[str, tuple[int, float]], ngrams: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """(key, words) -> (key, place, tf, weight) of the terms in the vocabulary, weights of length 1 in each row."""
    for batch in batches:
        at, place, tf, weight = [], [], [], []
        for i, own in enumerate(batch.column(1).to_pylist()):
            counts: dict[tuple[int, float], int] = {}
            for n in range(ngrams[0], ngrams[1] + 1):
                for term in own if n == 1 else map(" ".join, zip(*(own[j:] for j in range(n)), strict=False)):
                    if (known := terms.get(term)) is not None:
                        counts[known] = counts.get(known, 0) + 1
            raw = [c * idf for (_, idf), c in counts.items()]
            norm = math.sqrt(math.fsum(x * x for x in raw))
            at += [i] * len(raw)
            place += [p for p, _ in counts]
            tf += counts.values()
            weight += [x / norm for x in raw]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(place, pa.int32()), pa.array(tf, pa.int64()), pa.array(weight, pa.float64())], ["k", "feature_index", "tf", "weight"])


def _weights(rows: DataFrame, vocabulary: DataFrame, ngrams: tuple[int, int], out: str) -> DataFrame:
    """The weights of rows (key, words). The vocabulary, as many rows as its parameter allows, goes to the tasks."""
    spark = rows.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast({r.term: (r.feature_index, r.idf) for r in vocabulary.select("term", "feature_index", "idf").collect()})
    found = rows.mapInArrow(lambda it: _weighted(it, sent.value, ngrams), "k long, feature_index int, tf long, weight double")
    return found.join(F.broadcast(vocabulary.select("feature_index", "term")), "feature_index").select(F.col("k").alias(out), "term", "tf", "weight")


def vocabulary(words: DataFrame, n: Column | int, max_features: int, ngrams: tuple[int, int] = (1, 2)) -> DataFrame:
    """The ``max_features`` terms of most occurrences in the ``words`` of ``n`` chunks, ties to the smaller term, with their idf.

    A row's terms are sorted in the row, so the first of each term counts for its chunks and nothing but counts by term is shuffled.
    """
    terms = F.array_sort(grams("words", ngrams))
    firsts = F.zip_with(terms, F.concat(F.array(F.lit("")), F.slice(terms, 1, F.greatest(F.size(terms) - 1, F.lit(0)))), lambda t, before: F.struct(t.alias("term"), (t != before).alias("first")))
    each = words.select(F.explode(F.filter(firsts, lambda x: x["term"].isNotNull())).alias("x"))
    totals = each.groupBy(F.col("x.term").alias("term")).agg(F.count_if("x.first").alias("df"), F.count("*").alias("ctf"))
    top = totals.orderBy(F.desc("ctf"), "term").limit(max_features)  # at most max_features rows from here on
    index = F.row_number().over(Window.orderBy("term")) - 1
    return top.select("term", index.alias("feature_index"), "df", "ctf", (F.log((F.lit(1.0) + n) / (1 + F.col("df"))) + 1).alias("idf"))


def fit(rows: DataFrame, key: str = "doc_id", text: str = "text", max_features: int = 5000, ngrams: tuple[int, int] = (1, 2), stop: tuple[str, ...] | None = None) -> Fitted:
    """Fit the corpus. Null texts count as chunks without terms; a corpus without any term raises ValueError.

    Keys are whole numbers, one for each row; repeated rows are weighted each. Rows are counted and weighted where
    they lie: only counts by term are shuffled.
    """
    if max_features < 1:
        raise ValueError("max_features must be at least 1")
    words = _words(rows, key, text, "chunk_index", stop)
    terms, _ = settle(vocabulary(words, rows.count(), max_features, ngrams))
    if not terms.limit(1).count():
        raise ValueError("empty vocabulary")
    return Fitted(terms, _weights(words, terms, ngrams, "chunk_index"), ngrams, stop)


def topk(model: Fitted, queries: DataFrame, k: int, key: str = "query_id", text: str = "text") -> DataFrame:
    """The ``k`` best chunks of each query: (``query_id``, ``rank``, ``chunk_index``, ``score``).

    Scores are cosines with 6 decimals above 0, ties go to the smaller index. Unknown words are ignored.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    asked = _weights(_words(queries, key, text, "query_id", model.stop), model.vocabulary, model.ngrams, "query_id").select("query_id", "term", F.col("weight").alias("q"))
    scores = model.weights.join(asked, "term").groupBy("query_id", "chunk_index").agg(F.round(F.sum(F.col("q") * F.col("weight")), 6).alias("score")).where("score > 0")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "chunk_index")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "chunk_index", "score")


def top_features(model: Fitted, k: int = 10) -> DataFrame:
    """The ``k`` heaviest terms of each chunk, by weight with 6 decimals, ties to the smaller term."""
    order = Window.partitionBy("chunk_index").orderBy(F.desc("weight"), "term")
    out = model.weights.select("chunk_index", "term", F.round("weight", 6).alias("weight"))
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("chunk_index", "rank", "term", "weight")


def export(model: Fitted, path: str) -> None:
    """Write the fitted corpus beside a pack, as two tables."""
    model.vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")
    model.weights.write.mode("overwrite").parquet(f"{path}/weights")


def load(spark, path: str, ngrams: tuple[int, int] = (1, 2), stop: tuple[str, ...] | None = None) -> Fitted:
    """Read what ``export`` wrote."""
    return Fitted(spark.read.parquet(f"{path}/vocabulary"), spark.read.parquet(f"{path}/weights"), ngrams, stop)


def compare(dense: DataFrame, lexical: DataFrame) -> DataFrame:
    """Both results side by side, with a ``method`` column."""
    return dense.withColumn("method", F.lit("dense")).unionByName(lexical.withColumn("method", F.lit("lexical")))
