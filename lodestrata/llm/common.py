"""What the operators of this subpackage share: tables, storage, hashing."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space; every operator splits words at exactly these.
SPACE = " \t\n\x0b\x0c\r"
#: Sorts null ids after all others.
LAST_ID = 2**63 - 1


_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_CACHES: list[dict] = []
_SCRATCH: list[list[DataFrame]] = []


def cache_of(worker_cache: dict) -> dict:
    """A cache of one Python worker; workers outlive stages, so one that starts to be used empties the others."""
    if not any(c is worker_cache for c in _CACHES):
        _CACHES.append(worker_cache)
    for c in _CACHES:
        if c and c is not worker_cache:
            c.clear()
    return worker_cache


def _returned() -> None:
    """Give freed memory back to the system: workers are used again, and executors count what they hold."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def _started(owner: str) -> None:
    for c in _CACHES:
        if type(c).__module__.rsplit(".", 1)[-1] != owner:
            c.clear()


def tidy(function: Callable, owner: str = "") -> Callable:
    """A worker's function over batches that starts without the caches of other modules than owner and leaves no freed memory behind."""

    def run(batches: Iterator) -> Iterator:
        _started(owner)
        try:
            yield from function(batches)
        finally:
            _returned()

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers started from here on import this package.

    On a cluster the package is installed or given as --py-files; this covers
    local sessions whose driver found it through ``sys.path``.
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    # rows hold whole texts, so fewer go to a worker at a time than Spark's 10,000, unless the session says otherwise
    if spark.conf.get(_ROWS, "10000") == "10000":
        spark.conf.set(_ROWS, "1000")
    # one allocator, with few arenas, that gives memory back
    env.setdefault("ARROW_DEFAULT_MEMORY_POOL", "system")
    env.setdefault("MALLOC_ARENA_MAX", "2")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    One is set here only where the session has none and runs locally.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = "file:///tmp/checkpoints"
        spark.sparkContext.setCheckpointDir(where)
    return where


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: lineage ends here and executors may go."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lodestrata-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    for made in _SCRATCH[-1:]:
        made.append(out)
    return out


def free_name(name: str, columns: list[str]) -> str:
    """name, with underscores in front until no column has it (Spark doesn't tell cases apart)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


@contextmanager
def scratch(keep: list[DataFrame]) -> Iterator[None]:
    """Deletes, at the end, the tables that written() made meanwhile, but those in keep; what was read from them has to be stored by then."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for df in _SCRATCH.pop():
            if not any(df is k for k in keep):
                dropped(df)


def dropped(df: DataFrame) -> None:
    """Delete a table that written() made."""
    spark = df.sparkSession
    if files := df.inputFiles():  # none if it was deleted already
        path = spark._jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder(column: Column, modulus: int) -> Column:
    """crc32 of the id as text, mod modulus; a null id counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def sha256_hex(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case, all else as it is.

    lower() does that for texts of ASCII alone, with a fast path in the JVM.
    """
    plain = F.octet_length(column) == F.char_length(column)
    mapped = F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(plain, F.lower(column)).otherwise(mapped)
