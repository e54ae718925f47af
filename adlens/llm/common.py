"""Small helpers shared by the operators: scratch tables, folds, row-wise UDFs.

Every operator takes DataFrames and column names, selects what it needs, and
returns a DataFrame. A result column replaces an input column of the same name
(compared case-insensitively, as Spark resolves names).
"""

from __future__ import annotations

import ctypes
import gc
import sys
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.session import checkpoint_root

# A-Z are lower-cased; digits, a-z and every non-ASCII byte stay; all other
# ASCII bytes separate words: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ on UTF-8 bytes.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def word_list(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words of a text as UTF-8 bytes; none for NULL."""
    return text.encode("utf-8").translate(_WORD_BYTES).split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/adlens_llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later readers
    neither recompute it nor depend on the executors that made it."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the written table(s) behind a frame of :func:`stored` that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/adlens_llm/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def freed(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs deleted now. Spark deletes them once the driver's JVM has collected their
    plans as garbage; left alone that can be long after, when later jobs' files lie beside them. What the last job
    held is found to be garbage by the second collection only."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()


def small_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Bound the bytes of the Arrow batches that Python workers are handed (a batch is 10,000
    rows otherwise, whatever these hold), unless the session was configured with a bound of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.sparkContext.getConf().get(key, None) is None:
        spark.conf.set(key, str(size))


def released() -> None:
    """Give a worker's freed memory back: it stays alive beside the JVM between tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Columns of ``df`` that do not clash with ``names``."""
    gone = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in gone]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def with_struct(df: DataFrame, result: Column, fields: list[str]) -> DataFrame:
    """Add the fields of a struct-valued column as columns, replacing clashes."""
    keep = [F.col(quoted(c)) for c in without(df, fields)]
    tmp = "_r_" + uuid.uuid4().hex[:8]
    return (df.select(*keep, result.alias(tmp))
            .select(*keep, *[F.col(f"{tmp}.{f}").alias(f) for f in fields]))


_HELD: dict[tuple, object] = {}


def held(kind: str, key: object, make: Callable[[], Any]) -> Any:
    """What a Python worker remembers between tasks (models, caches), of one operator at a time:
    Spark keeps workers alive and hands them the next operator's tasks, when the last one's memory is no use."""
    if (kind, key) not in _HELD:
        forget_others(kind)
        _HELD[kind, key] = make()
    return _HELD[kind, key]


def forget_others(kind: str) -> None:
    gone = [k for k in _HELD if k[0] != kind]
    for k in gone:
        del _HELD[k]
    if gone:
        released()


def slices(batches: Iterator, rows: int = 500, kind: str = "") -> Iterator:
    """Arrow batches (arrays, tuples of arrays or record batches) in smaller
    slices, so Python holds few rows' objects at a time. ``kind``: the operator whose
    remembered things stay (see :func:`held`)."""
    forget_others(kind)
    for batch in batches:
        n = len(batch[0]) if isinstance(batch, tuple) else len(batch)
        for k in range(0, n, rows):
            yield tuple(a.slice(k, rows) for a in batch) if isinstance(batch, tuple) else batch.slice(k, rows)
    released()


def fold(doc_id: str) -> Column:
    """crc32 of the id as text, mod 5; fold 0 is held out. NULL ids are held out."""
    crc = F.crc32(F.col(quoted(doc_id)).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(5)), F.lit(0)).cast("int")


def share(fraction: float, *cols: str) -> Column:
    """A deterministic hash sample holding about ``fraction`` of the keys."""
    h = F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in cols]), F.lit(1 << 30))
    return h < F.lit(int(fraction * (1 << 30)))
