"""Repeatable folds and the out-of-fold loop."""

from __future__ import annotations

from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_of(key: Column, k: int, seed: str = "") -> Column:
    """Fold 0..k-1 of a row from a hash of its key: the same on any cluster, for any partitioning."""
    digest = F.md5(F.concat(F.lit(seed), key.cast("string")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(k)).cast("int")


def add_fold(df: DataFrame, k: int, key: str = "sample_id", column: str = "fold", seed: str = "") -> DataFrame:
    return df.withColumn(column, fold_of(F.col(key), k, seed))


def in_parallel(spark, jobs: list[Callable], threads: int) -> list:
    """Run independent fits from a few driver threads, so that small stages of one fill gaps of another."""
    if threads <= 1 or len(jobs) <= 1:
        return [job() for job in jobs]
    wrap = inheritable_thread_target(spark)
    with ThreadPool(min(threads, len(jobs))) as pool:
        return pool.map(lambda job: wrap(job)(), jobs)


def out_of_fold(
    df: DataFrame,
    fitters: dict[str, Callable],
    k: int,
    threads: int = 3,
    fold: str = "fold",
    ready: dict[str, list[Callable]] | None = None,
    by_fold: dict[str, Callable] | None = None,
) -> DataFrame:
    """Wide out-of-fold predictions: each row gets ``oof_<model>`` from models that did not see its fold.

    A fitter maps a training frame to a function DataFrame, output column -> DataFrame.  The held-out rows of
    a fold pass through all its models at once and the folds are stacked, so nothing is joined or pivoted.  ``ready``
    has such functions, one a fold, of models that need no fit here; a fitter in ``by_fold`` takes the held-out fold's number.
    """
    by_fold = by_fold or {}
    names = [*fitters, *by_fold]

    def fit(i: int, name: str):
        return by_fold[name](i) if name in by_fold else fitters[name](df.where(F.col(fold) != i))

    jobs = [(lambda i=i, name=name: fit(i, name)) for i in range(k) for name in names]
    fitted = in_parallel(df.sparkSession, jobs, threads)
    stacked = None
    for i in range(k):
        held = df.where(F.col(fold) == i)
        for name, predict in zip(names, fitted[i * len(names):(i + 1) * len(names)]):
            held = predict(held, f"oof_{name}")
        for name, predict in (ready or {}).items():
            held = predict[i](held, f"oof_{name}")
        stacked = held if stacked is None else stacked.unionByName(held)
    return stacked
