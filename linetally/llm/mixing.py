"""Mixing sources to target weights by Poisson replication.

A source of size s that should make up the share w of a corpus of size t is repeated t * w / s
times on average.  Every document draws its number of copies from the Poisson distribution of
that mean, by inversion of a uniform number that a hash of seed, doc_id and text gives; the draw
depends on nothing else, so any task can repeat it.  Copies are then shuffled globally by a hash
of seed, doc_id, text and copy.

Everything runs on DataFrame functions.  Sizes are summed on the map side; the tables that go to
every task have one row per named source, of which there may be ``MAX_SOURCES``.  Sources
without a weight, and null sources, form one group of their own, the rest.

Defined cases: a null text has size 0 and is hashed like an empty one; a group of size 0 is repeated
once on average.  Rows without doc_id, or with equal ones, draw by their texts.  Rows that are equal in both
draw by their places in the input as well, so that a row which makes up a third of a corpus neither
vanishes nor multiplies as a whole; which of them are copied does not matter, as they are alike but for
columns that mixing does not look at.  Texts of any length are hashed whole.  An empty table gives an
empty result.  All columns are kept, whatever their names and types; ``mixed_copies`` adds ``copy``
(1, 2, ...), in place of a column that has that name in any case.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetally.llm.names import quoted
from linetally.llm.store import stored

MAX_SOURCES = 10_000
REST = "rest"
# One inversion covers means up to this; larger means are sums of several draws.
MEAN_PER_DRAW = 16.0
# More copies than that from one draw are less likely than 1e-25.
MOST_PER_DRAW = 80
UNIT_BITS = 52


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) with 52 bits, from a hash of the parts."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, UNIT_BITS // 4), 16, 10).cast("double") / float(2**UNIT_BITS)


def named_weights(docs: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """(source, weight) of the named sources."""
    if not weights or len(weights) > MAX_SOURCES:
        raise ValueError(f"between 1 and {MAX_SOURCES} sources need weights")
    pairs = [F.lit(x) for name, weight in weights.items() for x in (name, float(weight))]
    return docs.sparkSession.range(1).select(F.explode(F.create_map(*pairs)).alias("source", "weight"))


def _grouped(docs: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """(doc, mix_id, mix_group, size): whole rows with what mixing needs."""
    named = named_weights(docs, weights).select(F.col("source").alias("mix_source"))
    rows = docs.select(
        F.struct(*map(quoted, docs.columns)).alias("doc"),
        F.concat_ws(
            ":",
            F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
            F.md5(F.coalesce("text", F.lit("")).cast("binary")),
        ).alias("mix_id"),
        F.col("source").alias("of_source"),
        F.coalesce(F.octet_length("text").cast("bigint"), F.lit(0)).alias("size"),
    )
    group = F.when(F.col("mix_source").isNotNull(), F.concat(F.lit("source "), "mix_source")).otherwise(F.lit(REST))
    # At most MAX_SOURCES names.
    return rows.join(F.broadcast(named), F.col("of_source") == F.col("mix_source"), "left").select(
        "doc", "mix_id", group.alias("mix_group"), "size"
    )


def _told_apart(grouped: DataFrame) -> DataFrame:
    """Rows whose mix_id repeats get their place in the input added to it.

    A repeat is found from the ids alone, summed where they are read; the list of repeated ids is
    empty in a corpus that has none.
    """
    ids = grouped.groupBy("mix_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = stored(ids.select(F.col("mix_id").alias("repeated_id")), "mix-repeated")
    place = F.concat_ws(":", "mix_id", F.col("place").cast("string"))
    return (
        grouped.withColumn("place", F.monotonically_increasing_id())
        .join(repeated, F.col("mix_id") == F.col("repeated_id"), "left")
        .withColumn("mix_id", F.when(F.col("repeated_id").isNotNull(), place).otherwise(F.col("mix_id")))
        .drop("place", "repeated_id")
    )


def group_rates(
    docs: DataFrame, weights: Mapping[str, float], rest_weight: float = 1.0, epochs: float = 1.0
) -> DataFrame:
    """(mix_group, rate, draws, cdf): the mean copies of each group's documents.

    ``cdf`` holds the Poisson distribution function of rate / draws at 0, 1, 2, ...
    """
    sizes = stored(
        _grouped(docs, weights).groupBy("mix_group").agg(F.sum("size").alias("size")), "mix-sizes"
    )
    total = sizes.agg(F.sum("size")).first()[0] or 0
    everything = float(sum(float(w) for w in weights.values()) + rest_weight)
    own = named_weights(docs, weights).select(F.concat(F.lit("source "), "source").alias("mix_group"), "weight")
    weight = F.coalesce(F.col("weight"), F.lit(float(rest_weight)))
    rate = F.when(F.col("size") == 0, F.lit(1.0)).otherwise(
        F.lit(float(total)) * F.lit(float(epochs)) * weight / (F.lit(everything) * F.col("size").cast("double"))
    )
    draws = F.greatest(F.ceil(F.col("rate") / MEAN_PER_DRAW), F.lit(1).cast("bigint"))
    mean = F.col("rate") / F.col("draws")
    first = F.exp(-mean)
    steps = F.sequence(F.lit(1), F.lit(MOST_PER_DRAW - 1))
    grown = F.aggregate(
        steps,
        F.struct(first.alias("p"), F.array(first).alias("cdf")),
        lambda acc, k: F.struct(
            (acc["p"] * mean / k).alias("p"),
            F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + acc["p"] * mean / k)).alias("cdf"),
        ),
    )
    return (
        sizes.join(F.broadcast(own), "mix_group", "left")
        .select("mix_group", rate.alias("rate"))
        .withColumn("draws", draws)
        .select("mix_group", "rate", "draws", grown["cdf"].alias("cdf"))
    )


def _copies(seed: str) -> Column:
    """How many copies a document gets: for each draw, the values its uniform number has passed."""

    def passed(total: Column, draw: Column) -> Column:
        unit = _unit(F.lit(seed), F.col("mix_id"), draw.cast("string"))
        number = F.transform(F.array(unit), lambda u: F.size(F.filter("cdf", lambda c: c <= u)))[0]
        return total + number.cast("bigint")

    return F.aggregate(F.sequence(F.lit(1).cast("bigint"), F.col("draws")), F.lit(0).cast("bigint"), passed)


def _numbers(copies: Column) -> Column:
    """1, 2, ... up to the number of copies; nothing for 0."""
    return F.filter(F.sequence(F.lit(0).cast("bigint"), copies), lambda n: n > 0)


def _mixed(
    docs: DataFrame, weights: Mapping[str, float], rest_weight: float, epochs: float, seed: str
) -> DataFrame:
    """(doc, mix_copy): the copies of all documents, shuffled globally."""
    rates = stored(group_rates(docs, weights, rest_weight, epochs), "mix-rates")
    copies = (
        _told_apart(_grouped(docs, weights))
        .join(F.broadcast(rates.select("mix_group", "draws", "cdf")), "mix_group")  # one row per named source
        .select("doc", "mix_id", F.explode(_numbers(_copies(seed))).alias("mix_copy"))
    )
    key = F.md5(F.concat_ws(":", F.lit(f"{seed} order"), "mix_id", F.col("mix_copy").cast("string")).cast("binary"))
    return copies.withColumn("mix_key", key).repartition("mix_key").sortWithinPartitions("mix_key")


def mixed_copies(
    docs: DataFrame, weights: Mapping[str, float], rest_weight: float = 1.0, epochs: float = 1.0, seed: str = "mix"
) -> DataFrame:
    """The copies of all documents, shuffled globally, with their number ``copy``.

    The order within and between partitions follows a hash, so reading the result as written is
    reading a random permutation; the one exchange of the texts deals them out by it.
    """
    others = [name for name in docs.columns if name.lower() != "copy"]
    return _mixed(docs, weights, rest_weight, epochs, seed).select(
        *[F.col("doc")[name].alias(name) for name in others], F.col("mix_copy").alias("copy")
    )


def mix(
    docs: DataFrame, weights: Mapping[str, float], rest_weight: float = 1.0, epochs: float = 1.0, seed: str = "mix"
) -> DataFrame:
    """The mixed documents with the columns of docs, each copy a row of its own."""
    names = [F.col("doc")[name].alias(name) for name in docs.columns]
    return _mixed(docs, weights, rest_weight, epochs, seed).select(*names)
