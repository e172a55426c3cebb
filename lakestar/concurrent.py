"""Submit independent Spark actions together.

Spark schedules jobs from several driver threads at once, so actions that
do not depend on each other (writing the tables of one load version,
building two dimensions) share the cluster instead of queueing; small jobs
no longer leave most executors idle.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor


def run_together(*actions: Callable[[], object]) -> list:
    """Run the callables concurrently; results in call order. The first
    failure is raised after all have finished (no half-cancelled writes)."""
    if len(actions) <= 1:
        return [a() for a in actions]
    with ThreadPoolExecutor(max_workers=len(actions)) as pool:
        futures = [pool.submit(a) for a in actions]
        errors = [f.exception() for f in futures]
    for e in errors:
        if e is not None:
            raise e
    return [f.result() for f in futures]
