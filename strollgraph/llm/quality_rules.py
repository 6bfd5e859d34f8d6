"""Quality rules by robust multivariate outliers.

Every text gives a vector of four statistics: logarithms of word length, marks (symbols among them), capitals and stutters (a word equal to
the one before) per word.  Each language and source has its own centre and scatter by the minimum covariance determinant: of
two starts, concentration steps keep the three quarters of the rows that are nearest to the current
estimate and estimate again; the start that ends with the smaller determinant wins.  Texts with a Mahalanobis distance
beyond the cutoff are rejected.

A concentration step is one aggregation: rows fall into bins of their distance, bins carry counts and moments, and the
nearest bins that hold three quarters of a group are added up.  No group is ever gathered, and a hot group is
just partial sums.

Small groups tell little about themselves, so every estimate is drawn towards the wider one: a language and source of n usable rows
counts n / (n + ``STEADY``) against its language, and that by the same rule against all rows.  Nothing switches at any size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
import math
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strollgraph.llm.text import arrow_rows, whole_row
from strollgraph.llm.textstats import counts
from strollgraph.session import cut

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks", "n_capitals", "n_stutters")
#: Numerator of each statistic, and the words' worth of the corpus rate that steadies short texts.
RATES = (("word_chars", 30), ("n_marks", 30), ("n_capitals", 30), ("n_stutters", 60))
#: Standard deviations below which no statistic is trusted.
FLOORS = (0.02, 0.1, 0.1, 0.3)
DIMS = len(RATES)
#: Rows of a group at which its own estimate counts half.
STEADY = 200.0
CORE = 0.75
STEPS = 5
#: Share of normal rows beyond the cutoff.
TAIL = 1e-8


def chi2_tail(x: float, dims: int) -> float:
    """P(chi-square of an even number of degrees > x)."""
    return math.exp(-x / 2) * sum((x / 2) ** j / math.factorial(j) for j in range(dims // 2))


def chi2_point(tail: float, dims: int) -> float:
    low, high = 0.0, 400.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_tail(mid, dims) > tail else (low, mid)
    return low


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [counts((t.as_py() or "").encode()) for t in batch.column("_text")]
        rest = [n for n in batch.schema.names if n != "_text"]
        cols = [pa.array(c, pa.int64()) for c in zip(*found)] if found else [pa.array([], pa.int64())] * len(COUNTS)
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), *cols], names=[*rest, *COUNTS])


def measure(docs: DataFrame, *keep: Column) -> DataFrame:
    """``keep`` and the counts of the whole text of every row; all zero for a null text."""
    picked = arrow_rows(docs).select(*keep, F.col("text").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.drop("_text").schema)
    return picked.mapInArrow(_count_batches, schema + "".join(f", {c} bigint" for c in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


@dataclass
class Fit:
    """What the corpus says: the rates, and the estimate of every language and source."""

    rates: dict[str, float]
    estimates: DataFrame


def _rates(measured: DataFrame) -> dict[str, float]:
    sums = measured.where(~base_failed()).agg(*[F.sum(c).alias(c) for c in COUNTS]).first()
    n = max(1, sums["n_words"] or 0)
    return {c: max(1e-6, (sums[c] or 0) / n) for c, _ in RATES}


def _vectors(measured: DataFrame, rates: dict[str, float]) -> DataFrame:
    """Rows with the statistics ``x0``, ``x1``, ..."""
    return measured.select("*", *[
        F.log((F.col(c) + F.lit(m * rates[c])) / (F.col("n_words") + m)).alias(f"x{i}") for i, (c, m) in enumerate(RATES)
    ])


def _levels() -> Column:
    """Names of the three groups of a row: its language and source, its language, everything."""
    return F.array(F.to_json(F.array("lang", "source")), F.to_json(F.array("lang")), F.lit("[]"))


def _fit_rows(rows: DataFrame) -> DataFrame:
    """The usable rows once for each level."""
    return cut(rows.where(~base_failed()).select(*[f"x{i}" for i in range(DIMS)], F.explode(_levels()).alias("_group")))


def _shrunk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Means and scatters drawn towards the language's and that of all rows, and inverted."""
    for frame in frames:
        out = []
        for r in frame.itertuples(index=False):
            mean, cov = np.array(r.mean2), np.array(r.cov2).reshape(DIMS, DIMS)
            for own_mean, own_cov, n in ((r.mean1, r.cov1, r.n1), (r.mean0, r.cov0, r.n0)):
                own = n / (n + STEADY)
                mean, cov = own * np.array(own_mean) + (1 - own) * mean, own * np.array(own_cov).reshape(DIMS, DIMS) + (1 - own) * cov
            out.append((r.lang, r.source, mean.tolist(), np.linalg.inv(cov).ravel().tolist()))
        yield pd.DataFrame(out, columns=["_l", "_s", "mean", "inverse"])


def _by_source(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """``_l, _s, mean, inverse`` for every language and source of ``rows``, also those without a usable row."""
    levels = _levels()
    groups = rows.groupBy("lang", "source").agg(F.max(F.lit(1)).alias("_one")).select("lang", "source", *[levels[k].alias(f"_g{k}") for k in range(3)])
    for k in range(3):
        side = estimates.select(F.col("_group").alias(f"_g{k}"), F.col("mean").alias(f"mean{k}"), F.col("cov").alias(f"cov{k}"), F.col("n").alias(f"n{k}"))
        groups = groups.join(side, f"_g{k}", "left")
    # A group without usable rows counts nothing; the wider one stands in for what it lacks.
    for k in (1, 0):
        groups = groups.withColumns({
            f"n{k}": F.coalesce(f"n{k}", F.lit(0)), f"mean{k}": F.coalesce(f"mean{k}", f"mean{k + 1}"), f"cov{k}": F.coalesce(f"cov{k}", f"cov{k + 1}")
        })
    kinds = rows.schema
    schema = f"_l {kinds['lang'].dataType.simpleString()}, _s {kinds['source'].dataType.simpleString()}, mean array<double>, inverse array<double>"
    return cut(groups.where("mean2 is not null").drop("_g0", "_g1", "_g2").mapInPandas(_shrunk, schema))


_PARAMS = "_group string, _start int, mean array<double>, cov array<double>, inverse array<double>, logdet double, n bigint"


def _inverted(cov: np.ndarray) -> tuple[list[float], list[float], float]:
    cov = cov + np.diag(np.square(FLOORS))
    return cov.ravel().tolist(), np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1])


def _estimates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Centre and scatter from moments about a centre near the data."""
    pairs = [(i, j) for i in range(DIMS) for j in range(i, DIMS)]
    for frame in frames:
        out = []
        for r in frame.itertuples(index=False):
            first = np.array(r.first) / r.n
            second = np.zeros((DIMS, DIMS))
            for (i, j), v in zip(pairs, r.second):
                second[i, j] = second[j, i] = v / r.n - first[i] * first[j]
            out.append((r.group, r.start, (np.array(r.about) + first).tolist(), *_inverted(second), r.all_rows))
        yield pd.DataFrame(out, columns=["_group", "_start", "mean", "cov", "inverse", "logdet", "n"])


def _starts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Two starts from medians and quartiles: independent statistics, and the correlations of squashed scores."""
    pairs = [(i, j) for i in range(DIMS) for j in range(i, DIMS)]
    for frame in frames:
        out = []
        for r in frame.itertuples(index=False):
            scale = np.maximum(np.array(r.scale), FLOORS)
            tanh = np.zeros((DIMS, DIMS))
            for (i, j), v in zip(pairs, r.second):
                tanh[i, j] = tanh[j, i] = v / r.n
            unit = np.sqrt(np.maximum(np.diag(tanh), 1e-9))
            for start, cov in ((0, np.diag(scale**2)), (1, tanh / np.outer(unit, unit) * np.outer(scale, scale))):
                out.append((r.group, start, list(r.about), *_inverted(cov), r.n))
        yield pd.DataFrame(out, columns=["_group", "_start", "mean", "cov", "inverse", "logdet", "n"])


def _squared_distance() -> Column:
    dx = [F.col(f"x{i}") - F.col("mean")[i] for i in range(DIMS)]
    return reduce(add, [F.col("inverse")[i * DIMS + j] * dx[i] * dx[j] for i in range(DIMS) for j in range(DIMS)])


def robust_estimates(rows: DataFrame) -> DataFrame:
    """``_group, mean, cov, inverse, n``: the minimum-covariance-determinant estimate of every ``_group`` of ``rows`` (``x0`` ...) and its rows."""
    x = [f"x{i}" for i in range(DIMS)]
    pairs = [(i, j) for i in range(DIMS) for j in range(i, DIMS)]
    quartiles = cut(
        rows.groupBy("_group").agg(*[F.percentile_approx(c, [0.25, 0.5, 0.75], 1000).alias(c) for c in x]).select(
            F.col("_group"), F.array(*[F.col(c)[1] for c in x]).alias("about"),
            F.array(*[(F.col(c)[2] - F.col(c)[0]) / 1.349 for c in x]).alias("scale"),
        )
    )
    squash = [F.tanh((F.col(c) - F.col("about")[i]) / F.greatest(F.col("scale")[i], F.lit(FLOORS[i]))) for i, c in enumerate(x)]
    moments = (
        rows.join(quartiles, "_group")
        .select("_group", "about", "scale", *[s.alias(f"t{i}") for i, s in enumerate(squash)])
        .groupBy("_group").agg(
            F.first("about").alias("about"), F.first("scale").alias("scale"), F.count("*").alias("n"),
            F.array(*[F.sum(F.col(f"t{i}") * F.col(f"t{j}")) for i, j in pairs]).alias("second"),
        ).withColumnRenamed("_group", "group")
    )
    params = cut(moments.mapInPandas(_starts, _PARAMS))
    for _ in range(STEPS):
        near = rows.join(params.drop("n", "cov"), "_group").withColumn("_d", _squared_distance())
        bins = near.groupBy("_group", "_start", F.floor(F.log2(F.col("_d") + 1e-9) * 16).alias("_bin")).agg(
            F.count("*").alias("n"), F.first("mean").alias("about"),
            *[F.sum(F.col(f"x{i}") - F.col("mean")[i]).alias(f"s{i}") for i in range(DIMS)],
            *[F.sum((F.col(f"x{i}") - F.col("mean")[i]) * (F.col(f"x{j}") - F.col("mean")[j])).alias(f"s{i}_{j}") for i, j in pairs],
        )
        group = Window.partitionBy("_group", "_start")
        core = bins.withColumn("_upto", F.sum("n").over(group.orderBy("_bin"))).withColumn("_all", F.sum("n").over(group)).where(
            F.col("_upto") - F.col("n") < CORE * F.col("_all")
        )
        summed = core.groupBy(F.col("_group").alias("group"), F.col("_start").alias("start")).agg(
            F.sum("n").alias("n"), F.first("about").alias("about"), F.first("_all").alias("all_rows"),
            F.array(*[F.sum(f"s{i}") for i in range(DIMS)]).alias("first"),
            F.array(*[F.sum(f"s{i}_{j}") for i, j in pairs]).alias("second"),
        )
        params = cut(summed.mapInPandas(_estimates, _PARAMS))
    best = params.groupBy("_group").agg(F.min_by(F.struct("mean", "cov", "inverse", "n"), F.struct("logdet", "_start")).alias("_best"))
    return cut(best.select("_group", "_best.*"))


def fit(measured: DataFrame) -> Fit:
    """Rates and estimates from the counts of all rows; ``measured`` is read several times."""
    rates = _rates(measured)
    rows = _vectors(measured, rates)
    return Fit(rates, _by_source(rows, robust_estimates(_fit_rows(rows))))


def judge(measured: DataFrame, known: Fit) -> DataFrame:
    """``measured`` (lang, source and counts) with ``base_failed``, ``distance`` (squared, robust) and ``kept``.

    A row is kept unless it fails the base rules or its distance exceeds the chi-square point of ``TAIL``.  Null
    languages and sources are groups like any other; null or empty texts fail the base; repeated rows are judged
    alike; if no row passes the base there is nothing to estimate and nothing is kept.
    """
    # The core alone is too narrow: scale to the normal distribution's whole.
    core_point = chi2_point(1 - CORE, DIMS)
    widen = CORE / (1 - chi2_tail(core_point, DIMS + 2))
    same = F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s"))
    rows = _vectors(measured, known.rates).join(known.estimates, same, "left").drop("_l", "_s")
    judged = rows.withColumn("distance", _squared_distance() / widen)
    kept = ~base_failed() & F.coalesce(F.col("distance") <= chi2_point(TAIL, DIMS), F.lit(False))
    return judged.withColumn("base_failed", base_failed()).withColumn("kept", kept).drop(
        "mean", "inverse", *[f"x{i}" for i in range(DIMS)]
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source``, the counts, ``base_failed``, ``distance`` and ``kept`` for every row of ``docs``."""
    measured = cut(measure(docs, F.col("doc_id"), F.col("lang"), F.col("source")))
    return judge(measured, fit(measured))


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns.

    Rows are counted once for the estimates and once more to be judged where they are read, so texts are never shuffled.
    """
    group = [F.col("lang"), F.col("source")]
    known = fit(cut(measure(docs, *group)))
    return judge(measure(docs, whole_row(docs).alias("_row"), *group), known).where("kept").select("_row.*")
