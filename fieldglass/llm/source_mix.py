"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

Every source gets a mean repetition rate, its target share of the output over its share of the input.  Each document's
count is the Poisson quantile, at that rate, of a uniform number hashed from the seed and the document: the same document
gets the same count on any cluster, and counts of different documents are independent.  Documents are exploded by their
counts and dealt out by a second hash, by which the rows of every partition are then sorted.

The sources' sizes are one aggregate of a row for each source.  The quantile steps of the listed sources are a literal in
the plan: nothing is joined, so a source with a third of all rows is no hot key.  A count at a rate beyond ``PIECE`` is the
sum of counts at equal parts of it, each from a number of its own, which is Poisson at the whole rate: steps are no more
than some hundreds for each weight given, however rare its source.

Defined results: sources without a target weight (null among them) keep rate 1; a listed source without documents yields
none; repeated rows get the same count each; null texts are replicated as they are; a weight of 0 drops its source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldglass.llm._shared import columns, free

SEED = 20
#: The mixture that the registered query makes: an over-full source brought down, the next ones raised by rank.
TARGETS = {"src0": 0.10} | {f"src{k}": 0.9 * w / sum(range(1, 20)) for k, w in zip(range(1, 20), range(19, 0, -1), strict=True)}
#: Quantiles beyond this tail probability are not told apart; a 52-bit uniform number doesn't reach them.
TAIL = 2.0**-53
#: The highest rate that one uniform number is inverted at.
PIECE = 256.0


def steps(rate: float) -> list[float]:
    """Cumulative Poisson probabilities at 0, 1, ...; the quantile of u is the number of those below u."""
    out, total, k = [], 0.0, 0
    while rate > 0:
        step = math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        total = min(1.0, total + step)
        out.append(total)
        k += 1
        if k > rate and step < TAIL:
            break
    return out


def rates(docs: DataFrame, targets: dict[str, float], size: float | None = None) -> dict[str, float]:
    """Mean repetitions of a document of each listed source that has any: target documents over documents.

    size is the number of documents that the listed sources yield in all, by default as many as they have."""
    n = {r[0]: r[1] for r in docs.where(F.col("source").isin(*targets)).groupBy("source").agg(F.count(F.lit(1))).collect()}
    size, weight = sum(n.values()) if size is None else size, sum(targets.values())
    return {s: size * targets[s] / weight / n[s] for s in sorted(n)}


def uniform(*of: Column | str) -> Column:
    """A number in [0, 1) from the first 52 bits of the MD5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *of)), 1, 13), 16, 10).cast("double") / 2.0**52


def mix(
    docs: DataFrame, targets: dict[str, float], seed: int = SEED, key: str = "doc_id", size: float | None = None, partitions: int | None = None,
    copy: str = "copy", shuffle_key: str = "shuffle_key",
) -> DataFrame:
    """docs' columns and those named copy (from 0) and shuffle_key, by which the rows are dealt to partitions and sorted in
    them.  Columns of docs with these two names are replaced: give other names to keep them."""
    of = rates(docs, targets, size)
    drawn = free(docs, "_u")
    parts = {s: max(1, math.ceil(r / PIECE)) for s, r in of.items()}
    id_ = F.coalesce(F.col(key).cast("string"), F.lit(""))
    rest = [c for c in docs.columns if c not in (copy, shuffle_key)]
    own = columns(rest)
    n_copies, n_drawn = F.lit(1), F.lit(1)
    if of:
        of_source = lambda values: F.create_map(*(x for s in of for x in (F.lit(s), values(s))))[F.col("source")]
        n_drawn = F.coalesce(of_source(lambda s: F.lit(parts[s])), n_drawn)
        below = of_source(lambda s: F.array(*map(F.lit, steps(of[s] / parts[s]))).cast("array<double>"))
        # A number's count is the number of steps that it reaches.
        reached = F.aggregate(drawn, F.lit(0), lambda k, u: k + F.size(F.filter(below, lambda x: x <= u)))
        n_copies = F.when(F.col("source").isin(*of), reached).otherwise(n_copies)
    numbers = F.transform(F.sequence(F.lit(0), n_drawn - 1), lambda j: uniform(F.when(j == 0, str(seed)).otherwise(F.concat(F.lit(f"{seed}-"), j.cast("string"))), id_))
    copies = (
        docs.withColumn(drawn, numbers)
        .select(*own, n_copies.alias(drawn))
        .select(*own, F.explode(F.when(F.col(drawn) > 0, F.sequence(F.lit(0), F.col(drawn) - 1))).alias(copy))
        .select(*own, copy, F.md5(F.concat_ws(":", F.lit(f"{seed}-order"), id_, F.col(copy).cast("string"))).alias(shuffle_key))
    )
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return copies.repartition(n, shuffle_key).sortWithinPartitions(shuffle_key)


def op4_source_mix(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), TARGETS)
