"""Submit independent Spark jobs side by side.

Gold consists of two dozen small tables; written one after the other they would leave most of a
cluster idle. Spark schedules jobs submitted from several threads together.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

T = TypeVar("T")


def run_all(tasks: Mapping[str, Callable[[], T]], width: int = 4) -> dict[str, T]:
    """Results by name, in the order given; the first failure is raised once all have ended."""
    with ThreadPoolExecutor(max_workers=width) as pool:
        running = {name: pool.submit(task) for name, task in tasks.items()}
    return {name: future.result() for name, future in running.items()}
