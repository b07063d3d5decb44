"""Several queries at once, named routines, retries, operations that can be told apart and stopped."""

from __future__ import annotations

import logging
import random
import re
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ..session import cut

log = logging.getLogger("tabulark")


class Cancelled(RuntimeError):
    """The caller stopped the operation."""


class Token:
    """A caller's wish to stop. Jobs of operations that were started with it are cancelled."""

    def __init__(self):
        self._stop, self._calls = threading.Event(), []

    @property
    def stopped(self) -> bool:
        return self._stop.is_set()

    def on_stop(self, call: Callable[[], None]) -> None:
        self._calls.append(call)
        if self.stopped:
            call()

    def stop(self) -> None:
        self._stop.set()
        for call in self._calls:
            call()


@contextmanager
def operation(spark: SparkSession, name: str, token: Token | None = None) -> Iterator[str]:
    """Jobs within carry an id (a tag, shown in Spark's UI and logs), which the log names at start and end. If the token
    stops, they are cancelled, and whatever error that causes is raised as Cancelled."""
    id_ = f"{name}-{uuid.uuid4().hex[:12]}"
    context = spark.sparkContext
    context.addJobTag(id_)
    began, done = time.time(), threading.Event()
    log.info("start %s", id_)

    def interrupt() -> None:
        """Again and again: the wish to stop may come between two jobs."""
        while not done.is_set():
            context.cancelJobsWithTag(id_)
            done.wait(0.3)

    if token:
        token.on_stop(lambda: threading.Thread(target=interrupt, daemon=True).start())
        if token.stopped:
            done.set()
            context.removeJobTag(id_)
            raise Cancelled(id_)
    try:
        yield id_
    except Exception as error:
        log.warning("end %s after %.3f s: %s", id_, time.time() - began, type(error).__name__)
        if token and token.stopped:
            raise Cancelled(id_) from error
        raise
    else:
        log.info("end %s after %.3f s", id_, time.time() - began)
    finally:
        done.set()
        context.removeJobTag(id_)


def stream_rows(df: DataFrame, token: Token | None = None, opened: Callable[[], Any] | None = None, transient: Callable[[Exception], bool] = lambda e: False) -> Iterator[Any]:
    """Rows, a partition at a time. Opening is repeated on transient errors (rows that were handed out never are); a
    stopped token ends the stream."""
    if opened:
        with_retry(opened, transient)
    with operation(df.sparkSession, "stream", token):
        for row in df.toLocalIterator(prefetchPartitions=True):
            if token and token.stopped:
                raise Cancelled("stream")
            yield row


def run_queries(spark: SparkSession, texts: list[str], degree: int = 8, args: list[dict] | None = None) -> list[DataFrame]:
    """Each query computed and kept as a table, in the order given; at most `degree` run at a time. Results stay on the
    cluster. The first failure is raised, after those that run have ended."""
    if degree < 1:
        raise ValueError("degree must be at least 1")
    given = args or [{} for _ in texts]
    with ThreadPoolExecutor(degree) as pool:
        return list(pool.map(inheritable_thread_target(spark)(lambda text, own: cut(spark.sql(text, args=own))), texts, given))


class Routines:
    """Named procedures: functions of (session, parameters) that give result sets and outputs."""

    def __init__(self):
        self._known: dict[str, Callable[..., tuple[dict[str, DataFrame], dict[str, Any]]]] = {}

    def register(self, name: str, routine: Callable) -> None:
        self._known[name.lower()] = routine

    def call(self, spark: SparkSession, name: str, **parameters: Any) -> tuple[dict[str, DataFrame], dict[str, Any]]:
        if name.lower() not in self._known:
            raise KeyError(f"no routine named {name}")
        return self._known[name.lower()](spark, **parameters)


def with_retry(action: Callable[[], Any], transient: Callable[[Exception], bool], attempts: int = 3, base: float = 0.2, most: float = 30.0, sleep: Callable[[float], None] = time.sleep, changes: bool = False, retry_changes: bool = False) -> Any:
    """Repeat what fails transiently, with doubled and jittered waits. For calls to sources; Spark retries tasks. What
    changes something is repeated only if that is asked for: it may have happened before it failed."""
    if attempts < 1:
        raise ValueError("attempts must be at least 1")
    if changes and not retry_changes:
        attempts = 1
    for attempt in range(attempts):
        try:
            return action()
        except Exception as error:
            if attempt + 1 == attempts or not transient(error):
                raise
            sleep(min(most, base * 2**attempt * (0.5 + random.random() / 2)))
    return None


PARAMETER = r"(?<![:\w]):([A-Za-z_]\w*)"
#: SQL types that a parameter may be given.
TYPES = {"boolean", "int", "bigint", "double", "decimal(38,18)", "string", "date", "timestamp", "timestamp_ntz", "binary"}


def query(spark: SparkSession, text: str, values: dict[str, Any] | None = None, types: dict[str, str] | None = None, outputs: dict[str, str] | None = None) -> tuple[DataFrame, dict[str, Any]]:
    """A query with named parameters (:name), found ignoring case, of given types where they are given; and outputs: the
    value of an expression over its result, for each name (one row of aggregates)."""
    from pyspark.sql import functions as F

    kinds = {k.lower(): v for k, v in (types or {}).items()}
    if unknown := set(kinds.values()) - TYPES:
        raise ValueError(f"unknown types: {sorted(unknown)}")
    used = {}
    bound = {k.lstrip("@:").lower(): v for k, v in (values or {}).items()}
    for name in set(re.findall(PARAMETER, text)):
        if name.lower() not in bound:
            raise KeyError(f"no value for :{name}")
        used[name] = bound[name.lower()]
    typed = re.sub(PARAMETER, lambda m: f"CAST(:{m[1]} AS {kinds[m[1].lower()]})" if m[1].lower() in kinds else m[0], text)
    df = spark.sql(typed, args=used)
    found = df.agg(*[F.expr(e).alias(n) for n, e in outputs.items()]).first().asDict() if outputs else {}
    return df, found
