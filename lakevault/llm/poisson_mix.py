"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate: its share of the target divided by its share of the rows.
A document's count is drawn from a Poisson distribution of that mean by inverting its distribution
function at a uniform number hashed from seed and id, so the draw needs no state, is the same on
every retry, and documents are independent of each other. Documents are exploded by their count and
dealt by a hashed key over all partitions, sorted by it inside each.

Only the rates (one row per source) are joined to the documents. They are stored first, so that
Spark knows their size and broadcasts them only if they are small; otherwise the join shuffles by
source and a hot source is split.

Defined results
---------------
* a null source is a source of its own; a null id draws like any other value
* a source without a target weight gets rate 0; weights are relative, negative ones are an error
* rows repeated as a whole draw the same count
* texts are carried, never read: empty, null and very long ones are alike
* input columns named like the two added ones (``copy``, ``shuffle_key``) are replaced, all others stay
* empty documents: an empty result
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import stored, unused

#: a rate above this is drawn as a sum of independent draws, each of at most this mean
PIECE_MEAN = 8.0
#: the distribution function of a mean of at most PIECE_MEAN reaches 1 in double precision before this
TERMS = 64


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 52 bits, hashed from the parts."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def target_rates(docs: DataFrame, weights: Mapping[str, float] | None, power: float, total: float | None, source_col: str) -> DataFrame:
    """``(source, rate)`` per source: target share times total, over the source's rows."""
    if weights is not None and any(w < 0 for w in weights.values()):
        raise ValueError("target weights are not negative")
    sizes = stored(docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("rows")), "mix-sizes")
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow(F.col("rows").cast("double"), F.lit(power)))
    else:
        given = docs.sparkSession.createDataFrame([*weights.items()], "name string, weight double")
        weighed = sizes.join(given, F.col("source").eqNullSafe(F.col("name")), "left").select("source", "rows", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    sums = weighed.agg(F.sum("weight"), F.sum("rows")).first()
    mass, rows = (sums[0] or 0.0), (sums[1] or 0)
    wanted = float(rows if total is None else total)
    share = F.col("weight") / F.lit(mass) if mass else F.lit(0.0)
    return weighed.select("source", (share * F.lit(wanted) / F.col("rows")).alias("rate"))


def with_distribution(rates: DataFrame) -> DataFrame:
    """Adds ``pieces`` and ``cdf``, the distribution function of one piece."""
    pieces = F.greatest(F.lit(1.0), F.ceil(F.col("rate") / F.lit(PIECE_MEAN)).cast("double"))
    parts = rates.withColumn("pieces", pieces.cast("int")).withColumn("__mean", F.col("rate") / F.col("pieces"))
    terms = F.expr(
        f"""aggregate(sequence(1, {TERMS - 1}),
            named_struct('p', exp(-__mean), 'c', exp(-__mean), 'cdf', array(exp(-__mean))),
            (s, k) -> named_struct('p', s.p * __mean / k, 'c', s.c + s.p * __mean / k, 'cdf', concat(s.cdf, array(s.c + s.p * __mean / k))),
            s -> s.cdf)"""
    )
    return parts.withColumn("cdf", terms).drop("__mean")


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    power: float = 0.7,
    total: float | None = None,
    seed: int = 17,
    id_col: str = "doc_id",
    source_col: str = "source",
    copy_col: str = "copy",
    key_col: str = "shuffle_key",
) -> DataFrame:
    """The mixed documents: all input columns, ``copy_col`` (from 1) and ``key_col``.

    ``weights``: target share per source; without it a source weighs its rows to ``power`` (1 leaves
    the mix as it is, 0 evens the sources out). ``total``: expected rows out, as many as in by default.
    """
    spread = with_distribution(target_rates(docs, weights, power, total, source_col))
    origin, pieces, cdf, n = (unused(docs, c) for c in ("mix_source", "mix_pieces", "mix_cdf", "mix_count"))
    rates = stored(spread.select(F.col("source").alias(origin), F.col("pieces").alias(pieces), F.col("cdf").alias(cdf)), "mix-rates")
    joined = docs.drop(copy_col, key_col).join(rates, F.col(source_col).eqNullSafe(F.col(origin)))
    draws = F.transform(F.sequence(F.lit(1), F.col(pieces)), lambda i: uniform(F.lit(seed), F.col(id_col), i))
    count = F.aggregate(draws, F.lit(0), lambda n, u: n + F.size(F.filter(F.col(cdf), lambda c: c <= u)))
    counted = joined.withColumn(n, count).drop(origin, pieces, cdf).filter(F.col(n) > 0)
    copies = counted.withColumn(copy_col, F.explode(F.sequence(F.lit(1), F.col(n)))).drop(n)
    key = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit("order"), F.lit(seed), F.col(id_col), F.col(copy_col))), 1, 15), 16, 10).cast("long")
    keyed = copies.withColumn(key_col, key)
    return keyed.repartition(key_col).sortWithinPartitions(key_col)
