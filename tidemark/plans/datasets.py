"""Jobs of several datasets side by side, each to its own end."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from contextvars import copy_context

from pyspark import InheritableThread
from pyspark.sql import SparkSession

POOL = "spark.scheduler.pool"


def side_by_side(spark: SparkSession, jobs: Mapping[str, Callable[[], int]]) -> dict[str, int]:
    """Run the job of every dataset at the same time, in a scheduler pool of its name; returns what each returned.

    One that fails stops no other. When all are done the first failure (in the order given) is
    raised, with a note on how every dataset ended, and ``datasets`` of those that are complete. Pools share the
    executors evenly where the session schedules by ``FAIR``.
    """
    done: dict[str, int] = {}
    failed: dict[str, Exception] = {}

    def run(name: str, job: Callable[[], int]) -> None:
        spark.sparkContext.setLocalProperty(POOL, name)
        try:
            done[name] = job()
        except Exception as e:  # noqa: BLE001  raised below
            failed[name] = e

    contexts = {name: copy_context() for name in jobs}
    threads = [InheritableThread(contexts[name].run, args=(run, name, job)) for name, job in jobs.items()]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    if failed:
        first = next(failed[name] for name in jobs if name in failed)
        first.datasets = dict(done)
        first.add_note("; ".join(f"{n}: {done[n]} rows" if n in done else f"{n}: failed ({failed[n]!s:.200})" for n in jobs))
        raise first
    return {name: done[name] for name in jobs}
