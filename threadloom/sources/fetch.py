"""Calls to the outside: page fetches and model calls, with retries, spread over tasks. What is called is a parameter."""

from __future__ import annotations

import random
import time
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def linear(k: int) -> float:
    """2, 4, 6 ... seconds."""
    return 2.0 * (k + 1)


def exponential(k: int) -> float:
    """2, 4, 8 ... seconds."""
    return 2.0 ** (k + 1)


def jittered(k: int, most: float = 120.0) -> float:
    """2, 4, 8 ... seconds, half as long or as much again, at most `most`."""
    return min(most, 2.0 * 2**k * random.uniform(0.5, 1.5))


class Limiter:
    """At most so many calls and tokens in any 60 seconds; `clock` and `sleep` can be replaced in tests."""

    def __init__(self, calls: int, tokens: int, clock=time.monotonic, sleep=time.sleep):
        self.calls, self.tokens, self.clock, self.sleep, self.past = calls, tokens, clock, sleep, deque()

    def take(self, tokens: int) -> None:
        while True:
            now = self.clock()
            while self.past and self.past[0][0] <= now - 60:
                self.past.popleft()
            if not self.past or (len(self.past) < self.calls and sum(t for _, t in self.past) + tokens <= self.tokens):
                self.past.append((now, tokens))
                return
            self.sleep(max(0.01, self.past[0][0] + 60 - now))


def with_retries(call: Callable[[str], str], tries: int, wait: Callable[[int], float], give_up_with_null: bool, sleep=time.sleep) -> Callable[[str], str | None]:
    def run(x: str) -> str | None:
        for k in range(tries):
            try:
                return call(x)
            except Exception:
                if k + 1 == tries:
                    if give_up_with_null:
                        return None
                    raise
                sleep(wait(k))
        return None

    return run


def call_each(rows: DataFrame, key: str, argument: str, result: str, call: Callable[[str], str], tries: int = 3, wait: Callable[[int], float] = linear, give_up_with_null: bool = True, calls_per_minute: int | None = None, tokens_per_minute: int = 1 << 60) -> DataFrame:
    """(key, result): `call` of every argument. Limits hold for each task, so divide a service's by the number of tasks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        once, limit = with_retries(call, tries, wait, give_up_with_null), Limiter(calls_per_minute, tokens_per_minute) if calls_per_minute else None
        for b in batches:
            out = []
            for x in b[argument]:
                if limit and x is not None:
                    limit.take(max(1, -(-len(x) // 4)))
                out.append(None if x is None else once(x))
            yield pd.DataFrame({key: b[key], result: out})

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, argument).mapInPandas(run, f"`{key}` {kind}, `{result}` string")
