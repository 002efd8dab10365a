"""Mix sources to target weights.

Tokens are aggregated per source; a mixture's size is the largest at which every source that is there reaches its share within
its cap, which gives each source a repetition rate.  Each document is emitted floor(rate) times, and once more if
its hash, seeded, falls below the fraction.

Scale.  One partial/final aggregation of tokens; the rates (one row per mix and source in the targets, checked against MAX_TARGETS) are
broadcast, so no document is shuffled and a source of any weight is mixed where it lies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.session import bounded_rows

MAX_TARGETS = 100_000


def rates(sizes: DataFrame, targets: DataFrame, source: str = "source", size: str = "n_tokens") -> DataFrame:
    """mix_id, source, target_share, max_repeats, tokens, rate.  Absent sources have tokens 0 and rate 0; null caps bind nothing."""
    have = sizes.groupBy(source).agg(F.sum(size).alias("tokens"))
    # equal lines of one mix and source count as one target
    t = targets.filter("target_share > 0").groupBy("mix_id", F.col("source").alias(source)).agg(F.sum("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats"))
    x = t.join(have, source, "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    w = Window.partitionBy("mix_id")
    # null caps never bind; if no cap binds at all, every document is taken once at least
    reach = F.min(F.when((F.col("tokens") > 0) & F.col("max_repeats").isNotNull(), F.col("tokens") * F.col("max_repeats") / F.col("target_share"))).over(w)
    free = F.max(F.when(F.col("tokens") > 0, F.col("tokens") / F.col("target_share"))).over(w)
    total = F.coalesce(reach, free)
    rate = F.when(F.col("tokens") > 0, F.col("target_share") * total / F.col("tokens")).otherwise(0.0)
    rate = F.least(rate, F.coalesce(F.col("max_repeats").cast("double"), rate))
    return x.select("mix_id", F.col(source).alias("source"), "target_share", "max_repeats", "tokens", rate.alias("rate"))


def mix(sizes: DataFrame, targets: DataFrame, seed: int = 11, id_col: str = "doc_id", source: str = "source", size: str = "n_tokens") -> DataFrame:
    """mix_id, source, doc_id, copy_no (from 1), n_tokens.

    Documents without a source, and empty ones, are in no mixture; repeated texts are separate documents; an empty table or no
    targets give no rows.
    """
    spark = sizes.sparkSession
    rows = bounded_rows(rates(sizes, targets, source, size), MAX_TARGETS, "mix targets")
    r = spark.createDataFrame([(x["mix_id"], x["source"], float(x["rate"])) for x in rows if x["rate"] > 0], "mix_id string, source string, rate double")
    docs = sizes.filter(F.col(size) > 0).select(F.col(id_col).alias("doc_id"), F.col(source).alias("source"), F.col(size).alias("n_tokens"))
    u = F.pmod(F.xxhash64(F.lit(seed), "mix_id", "doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    copies = (F.floor("rate") + (u < F.col("rate") - F.floor("rate")).cast("bigint")).cast("int")
    return (
        docs.join(F.broadcast(r), "source").withColumn("copies", copies).filter("copies > 0")
        .select("mix_id", "source", "doc_id", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy_no"), "n_tokens")
    )


def shares(mixed: DataFrame, rates_: DataFrame) -> DataFrame:
    """mix_id, source, target_share, actual_share, tokens, most_copies, short: what each source really reached."""
    got = mixed.groupBy("mix_id", "source").agg(F.sum("n_tokens").alias("tokens"), F.max("copy_no").alias("most_copies"))
    x = rates_.select("mix_id", "source", "target_share").join(got, ["mix_id", "source"], "left")
    tokens = F.coalesce("tokens", F.lit(0))
    actual = tokens / F.sum(tokens).over(Window.partitionBy("mix_id"))
    return x.select(
        "mix_id", "source", "target_share", F.coalesce(actual, F.lit(0.0)).alias("actual_share"), tokens.alias("tokens"),
        F.coalesce("most_copies", F.lit(0)).alias("most_copies"), (F.coalesce(actual, F.lit(0.0)) < F.col("target_share") * 0.95).alias("short"))
