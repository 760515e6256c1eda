"""Independent flows side by side."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_EXCEPTION, Future, ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def side_by_side(
    spark: SparkSession, flows: Sequence, work: Callable, *, name: Callable[[object], str], waits: Callable[[object, object], bool], most: int
) -> None:
    """``work`` for every flow, up to ``most`` at once; a flow starts behind the earlier ones that ``waits(flow, earlier)`` names.

    Every flow has a scheduler pool of its own name, which a fair scheduler shares the cluster among. The first failure cancels
    the jobs of the others, keeps those that wait from starting, and is raised.
    """
    if most < 2 or len(flows) < 2:
        for flow in flows:
            work(flow)
        return
    context, tag = spark.sparkContext, f"flows-{uuid.uuid4().hex}"
    started: list[Future] = []

    def run(flow, before: list[Future]) -> None:
        # Flows wait for earlier ones only, which the pool takes first, so the earliest can always go on.
        for other in before:
            other.result()
        context.setLocalProperty("spark.scheduler.pool", name(flow))
        context.addJobTag(tag)
        work(flow)

    with ThreadPoolExecutor(most) as pool:
        for k, flow in enumerate(flows):
            before = [started[i] for i in range(k) if waits(flow, flows[i])]
            started.append(pool.submit(inheritable_thread_target(spark)(run), flow, before))
        wait(started, return_when=FIRST_EXCEPTION)
        failed = [f for f in started if f.done() and not f.cancelled() and f.exception()]
        if failed:
            for future in started:
                future.cancel()
            context.cancelJobsWithTag(tag)
    if failed:
        raise failed[0].exception()
