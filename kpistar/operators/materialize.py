"""Materialised dimension layer.

Organisation-sized dimensions (region chains, staff hierarchies, salon
geography, venues, educators) are built once per domain and written as
parquet into the shared checkpoint folder (``spark.checkpoint.dir``), then
read back.  Three things follow:

* lineage is cut: later plans start from a file scan instead of re-analysing
  a deep join tree on the driver for every report, and a lost executor costs a
  re-read, not a recomputation;
* the optimizer's size statistics of the written table are its real (file)
  size, so the broadcast check in ``kpistar.operators.joins`` is a measured
  bound, not a guess (an outer-join tree has no usable estimate);
* plan strings stay short.
"""

from __future__ import annotations

import functools
import gc
import inspect
import uuid

from pyspark.sql import DataFrame

from kpistar.session import ensure_checkpoint_dir


def materialize(df: DataFrame, name: str = "dim") -> DataFrame:
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/kpistar-tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark) -> None:
    """Have the shuffle files of finished plans deleted now: Spark's cleaner does so when the driver
    collects its garbage, which may not come before the next plan has written its own."""
    gc.collect()
    spark._jvm.System.gc()


def fact_rows(fn):
    """``dimension`` for rows of a fact's size: the shuffle files that made them go once they are written."""
    return dimension(fn, release_after=True)


def dimension(fn, release_after: bool = False):
    """Memoise ``fn(domain, *args)`` on the domain object and materialise the result."""

    sig = inspect.signature(fn)

    @functools.wraps(fn)
    def wrapper(d, *args, **kwargs):
        memo = d.__dict__.setdefault("_dimension_memo", {})
        # bind with defaults so f(d) and f(d, <default>) share one written table
        bound = sig.bind(d, *args, **kwargs)
        bound.apply_defaults()
        key = (fn.__module__, fn.__name__, tuple(list(bound.arguments.items())[1:]))
        if key not in memo:
            memo[key] = materialize(fn(d, *args, **kwargs), fn.__name__)
            if release_after:
                release(memo[key].sparkSession)
        return memo[key]

    return wrapper
