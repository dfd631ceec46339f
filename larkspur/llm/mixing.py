"""Mixing sources to target weights: raking by iterative proportional fitting, then sampling.

Tokens are summed by cell (one value for each dimension: source, language, topic). Raking scales the
cells of one dimension after another until all marginals are the targets, and no cell above the tokens that it
has: a document is then kept with the probability of its cell, weight by tokens, and the sample is expected to
have the targets' marginals. The budget is the most at which every value can reach its target. DataFrame
functions only: documents are read once for the sums and once for the sample, and everything
between works on cells: up to ``CELLS_TO_A_TASK`` of them lie in one partition and are raked by windows, without a shuffle or a
broadcast in any round; more are raked by sums and joins that shrink before they are shuffled. Single
aggregate rows go to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
#: So many cells are raked by one task; more are dealt out.
CELLS_TO_A_TASK = 100_000


class Settings(NamedTuple):
    """``keep`` is the greatest share of all tokens to expect in the sample, ``slack`` what stays below the most that the targets allow."""

    keep: float = 0.8
    slack: float = 0.02
    rounds: int = 60
    tolerance: float = 1e-3
    seed: int = 17


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def topic_of(text: Column) -> Column:
    """What kind of text it is, from the share of its signs: empty, numeric, marked, listed or prose."""
    size = F.length(text)
    count = lambda signs: F.regexp_count(text, F.lit(signs))
    return (
        F.when(text.isNull() | (size == 0), "empty")
        .when(count("[0-9]") * 50 >= size, "numeric")
        .when(count("[#*$%&|<>=_!]") * 100 >= size, "marked")
        .when(F.size(F.split(text, "\n")) * 60 > size, "listed")
        .otherwise("prose")
    )


def tempered(cells: DataFrame, dimension: str, exponent: float) -> DataFrame:
    """Targets that lie between the shares as they are (1) and equal ones (0): ``dimension, share``."""
    sums = cells.groupBy(dimension).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    return sums.select(dimension, F.pow(F.col("tokens").cast("double"), F.lit(exponent)).alias("share"))


def _shares(cells: DataFrame, targets: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The targets of the values that have tokens, to a sum of 1 for each dimension: ``wanted, share``."""
    shares = {}
    for d, wanted in targets.items():
        values = cells.where("tokens > 0").select(d).distinct()
        share = wanted.groupBy(F.col(d).alias("value")).agg(F.sum("share").alias("share")).where("share > 0")
        present = cut_lineage(cells.sparkSession, share.join(values, F.col("value").eqNullSafe(F.col(d)), "left_semi"), "target")
        whole = present.agg(F.sum("share").alias("s")).first()["s"]
        shares[d] = present.select(F.col("value").alias("wanted"), (F.col("share") / F.lit(whole or 1.0)).alias("share"))
    return shares


def reachable(cells: DataFrame, shares: Mapping[str, DataFrame]) -> float:
    """The most tokens of a sample in which every value has its target: the least, over values, of its tokens by its share."""
    most = float(cells.agg(F.sum("tokens").alias("t")).first()["t"] or 0)
    for d, share in shares.items():
        tokens = cells.groupBy(F.col(d).alias("value")).agg(F.sum("tokens").alias("tokens"))
        held = tokens.join(share, F.col("value").eqNullSafe(F.col("wanted"))).agg(F.min(F.col("tokens") / F.col("share")).alias("m")).first()["m"]
        most = min(most, most if held is None else held)
    return most


def _with_sums(cells: DataFrame, dimension: str, sums: Mapping[str, Column], few: bool) -> DataFrame:
    """Each cell with the sums over the cells of its value; by windows if all lie in one partition."""
    if few:
        value = Window.partitionBy(dimension)
        return cells.withColumns({name: F.sum(x).over(value) for name, x in sums.items()})
    by_value = cells.groupBy(F.col(dimension).alias("_value")).agg(*[F.sum(x).alias(name) for name, x in sums.items()])
    return cells.join(by_value, F.col(dimension).eqNullSafe(F.col("_value"))).drop("_value")


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], settings: Settings = Settings(), bounded: bool = False) -> DataFrame:
    """``cells`` (the dimensions and ``tokens``) with the raked ``weight`` of each.

    Without a bound the weights sum to the tokens. With it no weight passes its cell's tokens: cells that are full stay so while
    the others of a value make up for them, and the sum is the most that the targets allow, less the slack, and at most ``keep`` of
    all. Targets need not sum to 1. A value without a target, or with one of 0, weighs nothing; a target whose value has no
    tokens is spread over the others. Marginals that contradict each other end as near as the last round came; see ``marginals``.
    """
    spark = cells.sparkSession
    dims = list(targets)
    sums = cells.agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).first()
    total, few = float(sums["t"] or 0), sums["n"] <= CELLS_TO_A_TASK

    def together(frame: DataFrame) -> DataFrame:
        return frame.coalesce(1) if few else frame

    cells = together(cells)
    shares = _shares(cells, targets)
    budget = min(settings.keep * total, (1 - settings.slack) * reachable(cells, shares)) if bounded else total
    weighted = cells.select(*dims, "tokens", (F.col("tokens") * F.lit(budget / total if total else 0.0)).alias("weight"))
    for d in dims:
        aimed = (F.coalesce("share", F.lit(0.0)) * F.lit(budget)).alias(f"_aim_{d}")
        weighted = weighted.join(shares[d], F.col(d).eqNullSafe(F.col("wanted")), "left").select(*weighted.columns, aimed)
    weighted = together(cut_lineage(spark, weighted, "aimed"))
    aims = [f"_aim_{d}" for d in dims]
    full = F.col("weight") >= F.col("tokens") * (1 - 1e-12)
    for _ in range(settings.rounds):
        gaps = []
        for d in dims:
            held = F.when(full, F.col("weight")).otherwise(0.0) if bounded else F.lit(0.0)
            weighted = _with_sums(weighted, d, {"_now": F.col("weight"), "_full": held}, few)
            aim, now, fixed = F.col(f"_aim_{d}"), F.col("_now"), F.col("_full")
            change = F.when((aim > now) & (now > fixed), (aim - fixed) / (now - fixed))
            change = change.when(now > 0, aim / now).otherwise(0.0)
            off = F.when(now > 0, F.abs(aim / now - 1)).otherwise(0.0)
            raised = F.col("weight") * change
            gap = F.when(F.col("weight") > 0, off).otherwise(0.0)
            weighted = weighted.select(
                *dims, "tokens", *aims, *gaps, (F.least(F.col("tokens").cast("double"), raised) if bounded else raised).alias("weight"), gap.alias(f"_gap_{d}")
            )
            gaps.append(f"_gap_{d}")
        weighted = together(cut_lineage(spark, weighted, "raked"))
        worst = weighted.agg(F.max(F.greatest(*gaps) if len(gaps) > 1 else F.col(gaps[0])).alias("m")).first()["m"]
        weighted = weighted.drop(*gaps)
        if worst is None or worst <= settings.tolerance:
            break
    return weighted.drop(*aims)


def marginals(raked: DataFrame, targets: Mapping[str, DataFrame]) -> DataFrame:
    """``dimension, value, share, target``: what the weights give each value, and what it should have; tells what could not be reached."""
    out = []
    for d, share in _shares(raked, targets).items():
        sums = raked.groupBy(F.col(d).cast("string").alias("value")).agg(F.sum("weight").alias("weight"))
        whole = raked.agg(F.sum("weight").alias("w")).first()["w"] or 1.0
        met = sums.join(share, F.col("value").eqNullSafe(F.col("wanted")), "left")
        out.append(met.select(F.lit(d).alias("dimension"), "value", (F.col("weight") / whole).alias("share"), F.coalesce("share", F.lit(0.0)).alias("target")))
    return reduce(DataFrame.unionByName, out)


def probabilities(raked: DataFrame) -> DataFrame:
    """The raked cells with the ``probability`` of a document: weight by tokens, which the bound keeps from passing 1."""
    return raked.withColumn("probability", F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.col("weight") / F.col("tokens"))).otherwise(0.0))


def chance(*columns: Column, seed: int) -> Column:
    """A number from 0 up to 1 that depends on the values and the seed alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) / F.lit(float(1 << 53))


def mix(
    docs: DataFrame, dimensions: Mapping[str, Column], exponents: Mapping[str, float] | None = None,
    targets: Mapping[str, DataFrame] | None = None, id_column: str = "doc_id", text: str = "text", settings: Settings = Settings(),
) -> DataFrame:
    """Every row of ``docs`` as a struct ``row``, with its dimensions, ``tokens``, ``probability`` and ``kept``.

    Targets for a dimension are given as (value, share), or by an exponent for its own shares. Nulls are a value
    of their own. Rows without words have probability 0 and are not kept. The choice depends on the id and the text,
    so repeated rows share their lot and a run can be repeated. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    names = list(dimensions)
    words = count_words(F.col(text))
    sums = docs.select(*[c.alias(n) for n, c in dimensions.items()], words.alias("tokens")).groupBy(*names).agg(F.sum("tokens").alias("tokens"))
    cells = cut_lineage(spark, sums, "cells")
    wanted = {n: (targets or {}).get(n, None) for n in names}
    wanted = {n: tempered(cells, n, (exponents or {}).get(n, 1.0)) if t is None else t for n, t in wanted.items()}
    calibrated = probabilities(rake(cells, wanted, settings, bounded=True))
    calibrated = cut_lineage(spark, calibrated.select(*[F.col(n).alias(f"_{n}") for n in names], "probability"), "probabilities")
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), *[c.alias(n) for n, c in dimensions.items()], words.alias("tokens"),
        chance(F.col(id_column), F.col(text), seed=settings.seed).alias("_chance"),
    )
    match = reduce(lambda a, b: a & b, (F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names))
    likely = F.when(F.col("tokens") > 0, F.col("probability")).otherwise(0.0)
    return rows.join(calibrated, match).select(
        "row", *names, "tokens", likely.alias("probability"), (F.col("_chance") < likely).alias("kept")
    )
