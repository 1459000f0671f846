"""Shared plumbing: tables, staged results, Arrow batches, packed groups."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Just under a slice of texts as encoders take them (``tokenids.SLICE_CHARS``).
TEXT_BATCH = "3900k"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def bound_batches(spark: SparkSession) -> None:
    """Cut the Arrow batches of this session by bytes, not by rows alone: a
    task holds its batch several times over outside the heap, and its worker
    once more. A limit that the session has already stays."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, TEXT_BATCH)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.
    Only a local session without that setting gets a folder of its own."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-shared-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/strata-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: a lost executor never makes earlier steps run again.
    Shuffle files of the steps before are released right after, not when the
    driver next happens to collect its garbage."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    release(spark)
    return out


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffles and broadcasts nothing refers to."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a staged table that this process wrote and no longer reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: Column) -> Column:
    """The evaluation fold: crc32 of the id as text is divisible by 5. A null
    id belongs to no fold and counts as not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of ``df`` has, whatever its columns."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n = "_" + n
        have.add(n.lower())
        out.append(n)
    return out


#: What operators keep in a worker between tasks, and how to drop it. A worker
#: serves many operators in turn; a task drops what others than its own keep.
_KEPT: dict[str, Callable[[], None]] = {}


def kept_in_worker(name: str, drop: Callable[[], None]) -> None:
    _KEPT[name] = drop


def begin_task(uses: str | None) -> None:
    for name, drop in _KEPT.items():
        if name != uses:
            drop()


def text_slices(batch: pa.RecordBatch, text_col: str, max_chars: int) -> Iterator[tuple[int, int, list[str]]]:
    """Rows lo to hi of a batch and their whole texts (null: empty), about
    ``max_chars`` bytes at a time; only one slice is decoded at once."""
    column = batch.column(text_col)
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).tolist()
    lo, size = 0, 0
    for i, n in enumerate([*sizes, None]):
        if i > lo and (n is None or size + n > max_chars):
            yield lo, i, [t or "" for t in column.slice(lo, i - lo).to_pylist()]
            lo, size = i, 0
        size += n or 0


def text_ranges(texts: list[str], max_chars: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of about ``max_chars``; a longer text stands alone."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > max_chars:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def map_texts(
    df: DataFrame,
    fn: Callable[[pa.RecordBatch, list[str]], pa.RecordBatch | list | dict | None],
    schema: str,
    text_col: str = "text",
    max_chars: int = 1_000_000,
    uses: str | None = None,
) -> DataFrame:
    """Apply ``fn(rows, texts)`` to slices of about ``max_chars`` bytes of
    whole texts (null: empty). ``fn`` returns columns (a dict) or None.
    ``uses`` names what ``fn`` keeps in the worker (``kept_in_worker``)."""
    ship(df.sparkSession)
    out_schema = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task(uses)
        for batch in batches:
            for lo, hi, texts in text_slices(batch, text_col, max_chars):
                cols = fn(batch.slice(lo, hi - lo), texts)
                if cols is not None:
                    yield record_batch(cols, out_schema)
        trim()

    return df.mapInArrow(run, schema)


def trim() -> None:
    """Give memory that a task no longer uses back to the system: idle workers
    stay, and what they hold would add up over the steps of a session."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not on every system
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_arrow(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str, uses: str | None = None
) -> DataFrame:
    """``mapInArrow`` whose function yields dicts of columns."""
    ship(df.sparkSession)
    out_schema = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task(uses)
        for cols in fn(batches):
            yield record_batch(cols, out_schema)
        trim()

    return df.mapInArrow(run, schema)


def record_batch(cols: dict, schema: pa.Schema) -> pa.RecordBatch:
    arrays = []
    for field in schema:
        v = cols[field.name]
        v = v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v
        arrays.append(v.cast(field.type) if isinstance(v, pa.Array) else pa.array(v, type=field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def ids_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names: other
    columns of any name cannot clash with what it adds."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def id_type(docs: DataFrame, id_col: str = "doc_id") -> str:
    return docs.schema[id_col].dataType.simpleString()


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows of partitions sorted by ``key``, cut where the key changes: each
    table holds whole key groups, whatever the Arrow batch size."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key)
        last = k[-1].as_py()
        cut = batch.num_rows
        while cut and k[cut - 1].as_py() == last:
            cut -= 1
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        elif held and held[0].column(key)[0].as_py() != last:
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)
