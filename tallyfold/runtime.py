"""Session helpers: staging, size-checked lookups and concurrent Spark jobs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, nullcontext
from functools import partial, reduce
from threading import Lock

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.util import inheritable_thread_target

# A lookup side above this many rows is joined by shuffle instead of broadcast.
MAX_LOOKUP_ROWS = 100_000
# The same for its size: rows may be wide.
MAX_LOOKUP_BYTES = 64 << 20

# A key with at least one row in so many is joined apart from the others.
HEAVY_SHARE = 1000

# Shuffle files otherwise stay until the driver happens to collect its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PARTITION_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

_held: dict[str, list[str | None]] = {}
_held_lock = Lock()
_local_stage: dict[str, str] = {}
_staged: dict[str, list[str]] = {}


def build_session(app: str = "tallyfold", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def stage_root(spark: SparkSession) -> str:
    """Folder for staged tables: ``spark.checkpoint.dir``, or a temp folder in local mode only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if sc.applicationId not in _local_stage:
        _local_stage[sc.applicationId] = tempfile.mkdtemp(prefix="tallyfold-")
    return _local_stage[sc.applicationId]


def new_stage_path(spark: SparkSession, name: str) -> str:
    path = f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


@contextmanager
def held(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting for the writes started inside; the caller's comes back with the last of several that overlap."""
    with _held_lock:
        outer = _held.setdefault(key, [])
        outer.append(None if outer else spark.conf.get(key, None))
        spark.conf.set(key, value)
    try:
        yield
    finally:
        with _held_lock:
            if len(outer) > 1:
                outer.pop()
            else:
                before = outer.pop()
                spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stage(df: DataFrame, name: str = "stage", partition_bytes: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a frame feeds several jobs: it cuts the lineage, survives executor loss and, unlike
    a checkpointed RDD, keeps column pruning and size statistics. Its shuffle files are deleted when it is written.
    ``partition_bytes`` is the size up to which adaptive execution joins small partitions of its exchanges.
    """
    spark = df.sparkSession
    path = new_stage_path(spark, name)
    with held(spark, DROP_SHUFFLES, "true"), held(spark, PARTITION_BYTES, partition_bytes) if partition_bytes else nullcontext():
        df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._is_staged, staged._stage_path = True, path
    return staged


def reread(staged: DataFrame) -> DataFrame:
    """A table of :func:`stage` as a frame of its own, which can be joined with the first."""
    return staged.sparkSession.read.schema(staged.schema).parquet(staged._stage_path)


def stage_parts(tasks: Iterable[Callable[[], DataFrame]], name: str, spark: SparkSession) -> DataFrame:
    """Write frames of one schema into one staged table, each as its own job from a small pool.

    Reading the table is one scan, however many frames there were; a union would carry the plan of each.
    """
    path = new_stage_path(spark, name)

    def write(i: int, task: Callable[[], DataFrame]) -> T.StructType:
        frame = task()
        frame.write.parquet(f"{path}/piece={i}")
        return frame.schema

    schemas = run_jobs([partial(write, i, task) for i, task in enumerate(tasks)])
    staged = spark.read.schema(schemas[0]).parquet(path).select(*schemas[0].names)
    staged._is_staged = True
    return staged


def staged_once(df: DataFrame, name: str = "stage") -> DataFrame:
    """``df`` itself if it is a staged table already."""
    return df if getattr(df, "_is_staged", False) else stage(df, name)


def release_staged(spark: SparkSession) -> int:
    """Delete the tables this session staged; frames still reading them become invalid."""
    paths = _staged.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)


def release(df: DataFrame) -> None:
    """Delete a staged table that nothing will read any more; a frame that :func:`stage` did not return is left alone."""
    path = getattr(df, "_stage_path", None)
    if path is not None:
        _delete(df.sparkSession, path)
        known = _staged.get(df.sparkSession.sparkContext.applicationId, [])
        if path in known:
            known.remove(path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def bounded_rows(df: DataFrame, limit: int = MAX_LOOKUP_ROWS) -> list[Row] | None:
    """The rows of ``df`` if there are at most ``limit`` of them, else ``None``."""
    rows = getattr(df, "_local_rows", None)
    if rows is None:
        rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def settle(df: DataFrame, name: str = "settled", limit: int = MAX_LOOKUP_ROWS) -> DataFrame:
    """Evaluate a table expected to be small once: a local relation, or a staged one beyond ``limit``."""
    rows = bounded_rows(df, limit)
    return stage(df, name) if rows is None else local_frame(df.sparkSession, rows, df.schema)


def lookup_join(
    big: DataFrame, small: DataFrame, on: list[str], how: str = "left", limit: int = MAX_LOOKUP_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Join a per-group table onto a large frame.

    The small side is evaluated once. Within ``limit`` rows and MAX_LOOKUP_BYTES it is broadcast as a local relation;
    beyond that the join is left to a shuffle join, where adaptive execution splits skewed keys. Null keys match null keys.
    ``rows`` is its row count if the caller knows it, which saves a probe of a side that is too large.
    """
    if rows is not None and rows > limit:
        return null_safe_join(big, small, on, how)
    if not hasattr(small, "_local_rows"):
        found = bounded_rows(small, limit)
        if found is None:
            return null_safe_join(big, small, on, how)
        small = local_frame(big.sparkSession, found, small.schema)
    fits = len(small._local_rows) <= limit and small._local_bytes <= MAX_LOOKUP_BYTES
    return null_safe_join(big, small, on, how, fits)


def skewed_join(big: DataFrame, small: DataFrame, on: list[str], counts: DataFrame, n: str, limit: int = MAX_LOOKUP_ROWS) -> DataFrame:
    """Left join of a per-key table whose keys may be very unevenly frequent in ``big``; null keys match null keys.

    ``counts`` has one row per key with its rows ``n`` in ``big``. Keys that hold at least one row in HEAVY_SHARE, so at most
    HEAVY_SHARE of them, are broadcast with their values. Where they hold most rows, these stay where they are and only the others are
    shuffled, at the price of a second scan; else they find no partner in the shuffle join of the others and are dealt out evenly. A
    table within ``limit`` rows is broadcast whole.
    """
    seen = counts.agg(F.count("*").alias("keys"), F.sum(n).alias("rows")).first()
    if seen["keys"] <= limit:
        return lookup_join(big, small, on, "left", limit, rows=seen["keys"])
    frequent = counts.where(F.col(n) * HEAVY_SHARE >= seen["rows"])
    heavy = frequent.select(*on)
    known = null_safe_join(small, heavy, on, "left_semi")
    values = [c for c in small.columns if c not in on]
    marks = local_frame(big.sparkSession, known.collect(), known.schema).withColumnsRenamed({c: f"__heavy_{c}" for c in values})
    if 2 * (frequent.agg(F.sum(n)).first()[0] or 0) > seen["rows"]:
        names = [F.col(f"`{c}`") for c in big.columns]
        apart = null_safe_join(big, marks, on, "inner", broadcast=True)
        rest = null_safe_join(null_safe_join(big, marks, on, "left_anti", broadcast=True), small, on, "left")
        return rest.select(*names, *values).unionByName(apart.select(*names, *[F.col(f"__heavy_{c}").alias(c) for c in values]))
    marked = null_safe_join(big, marks.withColumn("__is_heavy", F.lit(True)), on, "left", broadcast=True)
    apart = F.when(F.col("__is_heavy"), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20)) + 1).otherwise(0)
    joined = null_safe_join(marked.withColumn("__salt", apart), small.withColumn("__salt", F.lit(0).cast("long")), [*on, "__salt"], "left")
    picked = [F.when(F.col("__is_heavy"), F.col(f"__heavy_{c}")).otherwise(F.col(c)).alias(c) for c in values]
    return joined.select(*[F.col(f"`{c}`") for c in big.columns], *picked)


def null_safe_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", broadcast: bool = False) -> DataFrame:
    """Equi-join in which a null key is a key like any other; the key columns of ``big`` stay."""
    small = small.withColumnsRenamed({c: f"__on_{c}" for c in on})
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`__on_{c}`")) for c in on]
    joined = big.join(F.broadcast(small) if broadcast else small, reduce(Column.__and__, same), how)
    return joined.drop(*[f"__on_{c}" for c in on])


def local_frame(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    # Relax nullability: outer joins and driver-side rows make the original flags meaningless.
    relaxed = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    records = [r.asDict() if isinstance(r, Row) else dict(zip(relaxed.names, r)) for r in rows]
    # An Arrow table becomes a local relation: joins see its exact size and reading it needs no job.
    table = pa.Table.from_pylist(records, schema=to_arrow_schema(relaxed))
    frame = spark.createDataFrame(table, relaxed)
    frame._local_rows, frame._local_bytes = rows, table.nbytes
    return frame


def run_jobs(tasks: Iterable[Callable], width: int = 4) -> list:
    """Run independent Spark actions from a bounded thread pool, results in task order.

    Each action is still a distributed job; the pool only keeps executors busy while another
    job is in its short driver-side or low-parallelism phase.
    """
    with ThreadPoolExecutor(max_workers=max(1, width)) as pool:
        futures = [pool.submit(inheritable_thread_target(task)) for task in tasks]
        return [f.result() for f in futures]
