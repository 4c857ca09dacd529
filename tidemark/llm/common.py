"""Tables, shared storage and folds used by every operator of the subpackage."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that end a word: space and the ASCII controls 9 to 13 (fixed values).
WORD_BREAKS = b" \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows that Python code gets at once where an action is the library's own.
BATCH_ROWS = 500
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table by its folder and name."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset and all runs on
    one machine, as in tests, a temporary folder is set as the checkpoint folder.
    """
    context = spark.sparkContext
    if (found := context.getCheckpointDir()) is None:
        named = spark.conf.get("spark.checkpoint.dir", "")
        if not named and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemark-"))
        found = context.getCheckpointDir()
    return found


@contextmanager
def settings(spark: SparkSession, **to: str) -> Iterator[None]:
    """Session settings for the actions inside, put back afterwards; ``__`` in a name stands for a dot."""
    names = {k.replace("__", "."): v for k, v in to.items()}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def batches_of(spark: SparkSession, rows: int = BATCH_ROWS):
    """Actions inside hand Python at most so many rows at once: long texts of many rows would else meet in one buffer."""
    return settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(rows))


def sliced(batches: Iterator, rows: int = BATCH_ROWS) -> Iterator:
    """Record batches in parts of at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def stored(frame: DataFrame, what: str, rows: int = BATCH_ROWS) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage and survives lost executors.

    Its shuffles are freed, as they aren't read again; ``rows`` bounds the batches its Python code gets.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    with batches_of(spark, rows), settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        frame.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(frame.schema).parquet(path)
    back._tidemark_path = path
    return back


def is_written(frame: DataFrame) -> bool:
    """Whether a frame is a table that ``stored`` wrote."""
    return hasattr(frame, "_tidemark_path")


def written(frame: DataFrame, what: str) -> DataFrame:
    """The frame, stored unless it is a written table already."""
    return frame if is_written(frame) else stored(frame, what)


def forget(*frames: DataFrame) -> None:
    """Delete what ``stored`` wrote, once no later step reads it."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(frame._tidemark_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def picked(wide: DataFrame, keys: DataFrame, column: str, how: str = "left_semi", *, most: int = 1 << 20) -> DataFrame:
    """Wide rows semi- or anti-joined with a written table of distinct keys; the wide rows stay where they are.

    More than ``most`` keys (8 MB) are broadcast by ranges, each for the rows within it; a table written
    in the keys' order is still read about once, as files without such keys are passed over.
    """
    n = keys.count()
    if n <= most:
        return wide.join(F.broadcast(keys), column, how)
    parts = -(-n // most)
    cuts = sorted(set(keys.agg(F.percentile_approx(column, [k / parts for k in range(1, parts)], 10_000)).first()[0]))  # a few numbers
    of = F.col(column)
    within = [of < cuts[0], *((of >= low) & (of < high) for low, high in zip(cuts, cuts[1:], strict=False)), of >= cuts[-1]]
    out = [wide.where(some).join(F.broadcast(keys.where(some)), column, how) for some in within]
    return reduce(DataFrame.unionByName, out if how == "left_semi" else [*out, wide.where(of.isNull())])


class Scratch:
    """Tables written on the way to a result; all are deleted at the end of the ``with`` block, by when the result must be written."""

    def __init__(self) -> None:
        self.frames: list[DataFrame] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        forget(*self.frames)

    def stored(self, frame: DataFrame, what: str, rows: int = BATCH_ROWS) -> DataFrame:
        self.frames.append(stored(frame, what, rows))
        return self.frames[-1]

    def drop(self, *frames: DataFrame) -> None:
        """Delete some before the others."""
        forget(*frames)
        self.frames = [f for f in self.frames if not any(f is g for g in frames)]


def fold_of(doc_id, folds: int) -> int:
    """crc32 of the id as decimal text, modulo ``folds``; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds


def fold(column: str | Column, folds: int) -> Column:
    """The same on the JVM."""
    column = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; ``bytes.split`` parts at just the bytes of WORD_BREAKS."""
    return text.encode("utf-8", "surrogatepass").split() if text else []
