"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A document of source s is wanted ``rate`` = weight_s x size / rows_s times on average. A uniform number from a
hash of its id and the seed is looked up in the Poisson distribution of that rate; the document is exploded by the
count found, and all copies are shuffled globally by another hash. Rates above ``STEP`` are split into equal
parts with a number each, since Poisson counts add up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedweave.session import stage

STEP = 4.0
# The distribution of a part's count ends here; beyond it lies less than 1e-17.
LONGEST = 40


def uniform(*parts) -> F.Column:
    """A number in [0, 1) from the MD5 of the parts as text, parted by '|'."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("~"))
                                      for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, exponent: float = 0.5,
                 size: int | None = None, source_col: str = "source") -> DataFrame:
    """``source, n, rate``, one row per source: how often a document of it is wanted on average.

    ``weights`` are the targets by source name, 0 for sources that are not named; without them a source's weight
    is its number of rows to the power ``exponent``. ``size`` is the wanted number of rows, by default as many as
    there are. A null source is a source of its own.
    """
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weighted = counts.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(float(exponent))))
    else:
        named = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
        weighted = counts.withColumn("w", F.coalesce(F.try_element_at(named, F.col("source")), F.lit(0.0)).cast("double"))
    # Totals over the sources, of which there is a row each.
    every = Window.partitionBy()
    wanted = F.sum("n").over(every) if size is None else F.lit(size)
    rate = F.try_divide(F.col("w") * wanted, F.sum("w").over(every) * F.col("n"))
    return weighted.select("source", "n", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def poisson_count(rate, *seed) -> F.Column:
    """The inverse of the Poisson distribution of ``rate`` at a uniform number hashed from ``seed``."""
    steps = F.greatest(F.lit(1), F.ceil(rate / STEP).cast("int"))
    part = rate / steps
    start = F.struct(F.exp(-part).alias("p"), F.exp(-part).alias("sum"), F.lit(0).alias("k"))

    def inverted(u):
        def further(s, k):
            p = s.p * part / k
            beyond = s.sum <= u
            return F.struct(p.alias("p"), F.when(beyond, s.sum + p).otherwise(s.sum).alias("sum"),
                            F.when(beyond, s.k + 1).otherwise(s.k).alias("k"))

        return F.aggregate(F.sequence(F.lit(1), F.lit(LONGEST)), start, further, lambda s: s.k)

    drawn = F.transform(F.sequence(F.lit(1), steps), lambda step: uniform(*seed, step))
    return F.aggregate(F.transform(drawn, inverted), F.lit(0), lambda a, b: a + b)


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, exponent: float = 0.5,
                size: int | None = None, seed: int = 7, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """The columns of ``docs`` with ``mix_copy`` (from 1) and ``mix_key``; rows are dealt and sorted by ``mix_key``.

    Each row of ``docs`` is drawn for itself; rows that share an id get the same count. A null id is drawn as
    one id. Columns of ``docs`` that are named as one of the two are replaced. An empty table gives no rows.
    """
    rates = source_rates(docs, weights, exponent, size, source_col)
    kept = [F.col(f"d.`{c}`") for c in docs.columns if c not in ("mix_copy", "mix_key")]
    # A row for each source, written first: the engine then knows its size before it plans the join, so it deals the documents
    # out by source only if there are more sources than it would broadcast.
    rates = stage(rates, "rates")
    joined = docs.alias("d").join(rates.select(F.col("source").alias("_source"), F.col("rate").alias("_rate")).alias("r"),
                                  F.col(f"d.`{source_col}`").eqNullSafe(F.col("r._source")))
    count = poisson_count(F.col("r._rate"), F.col(f"d.`{id_col}`"), F.lit(seed))
    copies = joined.select(*kept, F.posexplode(F.array_repeat(F.lit(True), count)).alias("_at", "_one"))
    copies = copies.withColumn("mix_copy", F.col("_at") + 1).drop("_at", "_one")
    key = F.md5(F.concat_ws("|", F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("~")), F.lit(f"order{seed}"),
                            F.col("mix_copy").cast("string")).cast("binary"))
    return copies.withColumn("mix_key", key).orderBy("mix_key")
