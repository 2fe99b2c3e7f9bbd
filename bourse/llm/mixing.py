"""Mixing sources to target weights by Poisson replication.

Every source has a target share of the mixed corpus. Its repetition rate is
the target share times the size of the mix over the source's own size; each
document's number of copies inverts the Poisson distribution of that mean at a
uniform number hashed from the seed and the document's id. So a document's
copies depend on nothing but its id, its source's rate and the seed, and the
expected size of every source is exact. Copies are exploded where the document
lies and then dealt over all partitions by a hash and sorted by it: one
exchange gives a global shuffle, and no source, however large, stays together.

Results for odd rows: a null source counts as the source ``''``; a null or
empty text has size 0; a source without any text keeps rate ``epochs``; rows
that repeat an id get the same number of copies; an empty table gives an empty
table. Columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage


def uniform(seed: int, *cols: Column) -> Column:
    """A number in [0, 1) with 52 bits from md5 of the seed and the columns."""
    key = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def poisson_cdf(rate: Column) -> Column:
    """The distribution function at 0, 1, 2, ... up to where the rest is below
    1e-16, from logarithms so that large rates do not underflow."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    p0 = F.exp(-rate)
    zero = F.struct((-rate).alias("logp"), p0.alias("cum"), F.array(p0).alias("out"))

    def step(a, k):
        logp = a["logp"] + F.log(rate) - F.log(k.cast("double"))
        cum = a["cum"] + F.exp(logp)
        return F.struct(logp.alias("logp"), cum.alias("cum"), F.array_append(a["out"], cum).alias("out"))

    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(1), last), zero, step, lambda a: a["out"])).otherwise(F.array(F.lit(1.0)))


def source_rates(docs: DataFrame, weights: dict[str, float], alpha: float, epochs: float,
                 source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(_source, chars, rate, cdf)`` per source, sizes over all documents.

    ``weights`` fixes the share of the sources it names (they must sum to at
    most 1); the others share the rest in proportion to their size to the
    power ``alpha``. Shares are scaled to sum to 1 where a named source does
    not occur. The mix has ``epochs`` times the size of ``docs``."""
    named = sum(weights.values())
    if min([0.0, *weights.values()]) < 0 or named > 1:
        raise ValueError("weights must be positive and sum to at most 1")
    sizes = stage(docs.groupBy(F.coalesce(F.col(source_col), F.lit("")).alias("_source"))
                  .agg(F.sum(F.coalesce(F.length(text_col), F.lit(0)).cast("long")).alias("chars")), "sizes")
    fixed = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]) if weights else F.create_map().cast("map<string,double>")
    sizes = sizes.withColumn("_fixed", F.when(F.col("chars") > 0, F.element_at(fixed, F.col("_source"))))
    sizes = sizes.withColumn("_free", F.when((F.col("chars") > 0) & F.col("_fixed").isNull(), F.pow(F.col("chars").cast("double"), F.lit(alpha))).otherwise(0.0))
    total, present, free = sizes.agg(F.sum("chars"), F.sum("_fixed"), F.sum("_free")).first()
    total, present, free = float(total or 0), float(present or 0), float(free or 0)
    rest = 1.0 - named if free > 0 else 0.0
    scale = (present + rest) or 1.0
    share = F.coalesce(F.col("_fixed"), F.col("_free") * (rest / free if free > 0 else 0.0)) / scale
    rate = F.when(F.col("chars") > 0, share * F.lit(total * epochs) / F.col("chars")).otherwise(F.lit(float(epochs)))
    return stage(sizes.select("_source", "chars", rate.alias("rate")).withColumn("cdf", poisson_cdf(F.col("rate"))), "rates")


def mix(docs: DataFrame, weights: dict[str, float], alpha: float = 0.7, epochs: float = 1.0, seed: int = 17,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` replicated and shuffled: each row as the struct ``row`` with
    ``copy`` (1, 2, ...), ``copies`` and ``shuffle_key``, the hash it is
    shuffled by."""
    rates = source_rates(docs, weights, alpha, epochs, source_col, text_col)
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(id_col).cast("string").alias("id"),
                       F.coalesce(F.col(source_col), F.lit("")).alias("_source"), uniform(seed, F.col(id_col)).alias("u"))
    counted = rows.join(rates.select("_source", "cdf"), "_source").withColumn("copies", F.size(F.filter("cdf", lambda c: c < F.col("u"))))
    copies = counted.where(F.col("copies") > 0).select("row", "id", "copies", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    key = F.md5(F.concat_ws(":", F.lit(f"{seed}:order"), F.coalesce("id", F.lit("")), F.col("copy")))
    return copies.select("row", "copy", "copies", key.alias("shuffle_key")).repartition("shuffle_key").sortWithinPartitions("shuffle_key")
