"""Named datasets with declared inputs.

A dataset is a function from inputs to a DataFrame. It asks for an input by
name; that call is the declaration. Each dataset is built once per run and
its lineage is recorded on the way.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from threading import Lock, get_ident, local

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.latest import first_per_key
from tidemill.session import work_path

KINDS = ("view", "table", "incremental", "ephemeral")


class _Waits(Exception):
    """A dataset asked for an input that is not built yet."""


@dataclass(frozen=True)
class Outcome:
    """What became of a dataset: ``built``, ``failed`` (with the error) or ``skipped`` (with the input that is missing)."""

    state: str
    rows: DataFrame | None = None
    reason: str | None = None


class Project:
    """Datasets and sources of one run.

    ``view`` registers a temporary view, ``table`` is written out and read
    back, ``ephemeral`` stays a plan inside its readers, and ``incremental``
    adds what a run brings: with a ``key`` the rows that are new or changed,
    of which readers see the last one per key; with a ``cursor`` alone the rows
    past the highest value stored, for inputs that never arrive late.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or work_path(spark, "project")
        self.models: dict[str, tuple[Callable[[Project], DataFrame], str, str | None, list[str] | None]] = {}
        self.sources: dict[str, DataFrame] = {}
        self.built: dict[str, DataFrame] = {}
        self.edges: list[tuple[str, str]] = []
        self._thread = local()
        self._lock = Lock()

    def source(self, name: str, df: DataFrame) -> None:
        self.sources[name] = df

    def dataset(self, kind: str = "view", cursor: str | None = None, key: list[str] | None = None):
        """Decorator: register a function under its own name."""
        if kind not in KINDS:
            raise ValueError(f"kind must be one of {KINDS}")
        if (kind == "incremental") != (cursor is not None or key is not None):
            raise ValueError("an incremental dataset, and no other, names its cursor column or its key")

        def register(fn):
            self.models[fn.__name__] = (fn, kind, cursor, key)
            return fn

        return register

    @property
    def _open(self) -> list[str]:
        """The datasets that this thread is building, the innermost last."""
        if not hasattr(self._thread, "open"):
            self._thread.open = []
        return self._thread.open

    def ref(self, name: str) -> DataFrame:
        """An input by name; builds it first if needed and notes who asked."""
        if self._open:
            edge = (self._open[-1], name)
            with self._lock:
                if edge not in self.edges:
                    self.edges.append(edge)
        if name in self.sources:
            return self.sources[name]
        if getattr(self._thread, "side_by_side", False) and name in self.models and name not in self.built:
            raise _Waits(name)
        if name in self._open:
            raise ValueError("cycle: " + " -> ".join([*self._open, name]))
        if name not in self.built:
            if name not in self.models:
                raise KeyError(f"no dataset or source named {name}")
            fn, kind, cursor, key = self.models[name]
            self._open.append(name)
            try:
                self.built[name] = self._store(name, fn(self), kind, cursor, key)
            finally:
                self._open.pop()
        return self.built[name]

    def run(self, *names: str) -> dict[str, DataFrame]:
        """Build the named datasets (all by default) and whatever they need."""
        return {name: self.ref(name) for name in names or self.models}

    def run_side_by_side(self, *names: str, threads: int = 4) -> dict[str, Outcome]:
        """Build datasets that don't need each other at the same time, each driver thread in a scheduler pool of its own.

        A dataset that asks for one that is not built yet is set aside and called
        again when that is there, so its function should do no more than build a
        DataFrame. A dataset that fails stops only what needs it. With
        ``spark.scheduler.mode`` FAIR the pools share the executors.
        """
        done: dict[str, Outcome] = {n: Outcome("built", df) for n, df in self.built.items()}
        waiting: dict[str, list[str]] = {}
        running: dict[Future, str] = {}
        context = self.spark.sparkContext

        def build(name: str) -> DataFrame:
            self._thread.side_by_side = True
            context.setLocalProperty("spark.scheduler.pool", f"datasets-{get_ident()}")
            fn, kind, cursor, key = self.models[name]
            self._open.append(name)
            try:
                return self._store(name, fn(self), kind, cursor, key)
            finally:
                self._open.pop()

        with ThreadPoolExecutor(threads) as pool:

            def start(name: str) -> None:
                running[pool.submit(build, name)] = name

            def settle(name: str, outcome: Outcome) -> None:
                done[name] = outcome
                for reader in waiting.pop(name, []):
                    if outcome.state == "built":
                        start(reader)
                    else:
                        settle(reader, Outcome("skipped", reason=name))

            asked = set()
            for name in names or self.models:
                if name not in self.models:
                    raise KeyError(f"no dataset or source named {name}")
                if name not in done:
                    asked.add(name)
                    start(name)
            while running:
                for ended in wait(running, return_when=FIRST_COMPLETED).done:
                    name, error = running.pop(ended), ended.exception()
                    if error is None:
                        self.built[name] = ended.result()
                        settle(name, Outcome("built", self.built[name]))
                    elif not isinstance(error, _Waits):
                        settle(name, Outcome("failed", reason=f"{type(error).__name__}: {error}"))
                    elif (needed := error.args[0]) in done:
                        start(name) if done[needed].state == "built" else settle(name, Outcome("skipped", reason=needed))
                    else:
                        waiting.setdefault(needed, []).append(name)
                        if needed not in asked:
                            asked.add(needed)
                            start(needed)
        if waiting:
            raise ValueError("cycle among " + ", ".join(sorted(n for readers in waiting.values() for n in readers)))
        return done

    def lineage(self) -> DataFrame:
        return self.spark.createDataFrame(self.edges, "dataset string, input string")

    def _store(self, name: str, df: DataFrame, kind: str, cursor: str | None, key: list[str] | None) -> DataFrame:
        if kind == "view":
            df.createOrReplaceTempView(name)
            return df
        if kind == "ephemeral":
            return df
        path = f"{self.folder}/{name}"
        if kind == "table":
            df.write.mode("overwrite").parquet(path)
        elif key is not None:
            return merge_rows(df, path, key)
        else:
            append_new(df, path, cursor)
        return self.spark.read.schema(df.schema).parquet(path)


RUN = "_run"


def _stored_rows(spark: SparkSession, schema, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as err:
        if "PATH_NOT_FOUND" not in str(err):
            raise
        return None


def merge_rows(df: DataFrame, path: str, key: list[str]) -> DataFrame:
    """Add the rows of this run that are new or differ, and return the last row per key.

    Late rows and rows with nulls count like any other. What is stored is never
    rewritten: each run appends under its number, and the newest row of a key
    stands. Within a run the keys should be unique; of repeated ones the first
    in the order of the other columns is taken. What is stored meets the run as
    key and digest, the newest per key picked before the shuffle.
    """
    spark, rest = df.sparkSession, [c for c in df.columns if c not in key]
    once = first_per_key(df, key, [F.col(c) for c in rest])
    stored_schema = T.StructType([*df.schema.fields, T.StructField(RUN, T.LongType())])
    held = _stored_rows(spark, stored_schema, path)
    if held is None:
        once.withColumn(RUN, F.lit(0).cast("long")).write.parquet(path)
    else:
        digest = F.sha2(F.to_json(F.struct(*[F.col(c) for c in rest]), {"ignoreNullFields": "false"}), 256) if rest else F.lit("")
        last = held.groupBy(*key).agg(F.max_by(digest, RUN).alias("_last")).select(*[F.col(c).alias(f"_k_{c}") for c in key], "_last")
        same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in key]
        run = held.agg(F.max(RUN)).first()[0]
        changed = once.withColumn("_now", digest).join(last, same, "left").filter(F.col("_last").isNull() | (F.col("_last") != F.col("_now")))
        fresh = changed.select(*once.columns).withColumn(RUN, F.lit(0 if run is None else run + 1).cast("long"))
        fresh.write.mode("append").parquet(path)
    return first_per_key(_stored_rows(spark, stored_schema, path), key, [F.desc(RUN)]).drop(RUN)


def append_new(df: DataFrame, path: str, cursor: str) -> None:
    """Append the rows whose ``cursor`` lies past the highest one stored.

    The bound is a single value, so it reaches the scan as a pushed filter. For
    inputs whose cursor only grows: rows that arrive late or without a cursor
    value need ``merge_rows``, so they raise an error instead of being lost.
    """
    spark = df.sparkSession
    held = _stored_rows(spark, df.schema, path)
    if not df.filter(F.col(cursor).isNull()).isEmpty():
        raise ValueError(f"rows without {cursor}: name a key and merge")
    if held is None:
        df.write.parquet(path)
        return
    high = held.agg(F.max(cursor).alias("high")).first()["high"]
    if high is not None:
        seen = held.groupBy(cursor).agg(F.count("*").alias("n"))
        now = df.filter(F.col(cursor) <= F.lit(high)).groupBy(cursor).agg(F.count("*").alias("m"))
        if not now.join(seen, cursor, "left").filter(F.col("m") > F.coalesce("n", F.lit(0))).isEmpty():
            raise ValueError(f"rows arrived late for {cursor}: name a key and merge")
        df = df.filter(F.col(cursor) > F.lit(high))
    df.write.mode("append").parquet(path)
