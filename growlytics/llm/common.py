"""Helpers shared by the training-data operators.

Text helpers run inside Python tasks on one slice of texts at a time, so the
memory of a task is bounded by ``SLICE`` characters plus the longest single
text.  Nothing here collects rows to the driver.
"""

from __future__ import annotations

import gc
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growlytics.session import ensure_checkpoint_dir, shared_path

#: A word, everywhere in this subpackage: a run of anything but these six characters.
WORD = r"[^\x20\x09-\x0D]+"
SLICE = 1 << 18
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def by_value(name: str) -> None:
    """Ship a module's functions with the task, so that executors need no
    copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


by_value(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; Arrow batches are kept small for long texts."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **types: str) -> DataFrame:
    """Exactly the named columns, cast to the given types.  Names are matched
    by case and by position, so that extra columns whose names clash (also in
    another case) do no harm."""
    cols = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(cols))])
    return plain.select(*[F.col(f"c{cols.index(n)}").cast(t).alias(n) for n, t in types.items()])


def plain(df: DataFrame, **types: str) -> tuple[DataFrame, dict[str, str]]:
    """All columns under the names c0, c1, ... (the named ones cast), and
    where the named ones are; :func:`restored` undoes it."""
    names = df.columns
    out = df.toDF(*[f"c{i}" for i in range(len(names))])
    at = {n: f"c{names.index(n)}" for n in types}
    for n, t in types.items():
        if dict(out.dtypes)[at[n]] != t:
            out = out.withColumn(at[n], F.col(at[n]).cast(t))
    return out, at


def restored(df: DataFrame, names: list[str], *extra: str, **replaced) -> DataFrame:
    """c0, c1, ... under their old names; ``replaced`` gives new values for
    some; ``extra`` columns of ``df`` follow."""
    return df.select(*[replaced.get(n, F.col(f"c{i}")).alias(n) for i, n in enumerate(names)], *extra)


def staged(df: DataFrame, what: str) -> DataFrame:
    """Cut the lineage: written to the shared folder and read again.  The
    garbage collection lets Spark remove the shuffle files behind it."""
    spark = df.sparkSession
    path = shared_path(spark, "llm", what)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


#: Largest size of a table, as written, that is sent to all tasks.
BROADCAST_BYTES = 24 << 20


def small(df: DataFrame) -> DataFrame:
    """A staged table, marked for broadcast if its files' size is at most
    ``BROADCAST_BYTES``; beyond that Spark's own choice (a shuffled join)
    holds."""
    spark = df.sparkSession
    files = df.inputFiles()
    if not files:
        return F.broadcast(df)
    if len(files) > 4096:
        return df
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return F.broadcast(df) if fs.getContentSummary(path).getLength() <= BROADCAST_BYTES else df


def held_out(doc_id: str, folds: int):
    """True where crc32(doc_id as text) mod ``folds`` is 0; a null id has the
    text ''."""
    return (F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds) == 0


def row_key(*cols: str):
    """A 64-bit key of a row's content: repeated rows share it."""
    return F.xxhash64(*[F.col(c) for c in cols])


def spread(df: DataFrame) -> int:
    """Shuffle partitions in use: how many ways to split work by hash."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def appended(df: DataFrame, inputs: list[str], fn, fields: dict[str, str], without: tuple[str, ...] = (), arrays: tuple[str, ...] = ()) -> DataFrame:
    """``df`` (whose names are distinct) and new columns that ``fn`` makes of
    the input columns of a batch: lists, in the order of ``fields``; the
    columns in ``without`` do not come back.  Inputs in ``arrays`` (lists of
    numbers, none null) are numpy arrays, without an object per number."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    at = [df.columns.index(c) for c in inputs]
    new = StructType.fromDDL(", ".join(f"{n} {t}" for n, t in fields.items()))
    types = [f.type for f in to_arrow_schema(new)]
    back = [i for i, c in enumerate(df.columns) if c not in without]

    def run(batches):
        for b in batches:
            got = fn(*[_numbers(b.column(i)) if n in arrays else b.column(i).to_pylist() for i, n in zip(at, inputs)])
            made = [pa.array(v, t) for v, t in zip(got, types)]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in back], *made], [*[b.schema.names[i] for i in back], *new.names])

    return df.mapInArrow(run, StructType([df.schema.fields[i] for i in back] + new.fields))


def _numbers(column) -> list:
    """The lists of a column as numpy arrays; None for a null."""
    values, bounds = column.values.to_numpy(), column.offsets.to_pylist()
    there = column.is_valid().to_pylist()
    return [values[a:z] if ok else None for a, z, ok in zip(bounds, bounds[1:], there)]


def shipped(spark: SparkSession, thing):
    """A broadcast of an object's fields (plain data, so that tasks need no
    copy of this package); :func:`revived` makes the object of them."""
    return spark.sparkContext.broadcast(vars(thing))


def revived(kind, shared):
    thing = kind.__new__(kind)
    vars(thing).update(shared.value)
    return thing


def added(rows: DataFrame) -> DataFrame:
    """Sums vectors: (i, v array<double>) to one row per i, in two steps, so
    that no task meets all partitions' vectors at once."""
    def add(f):
        import pandas as pd

        return pd.DataFrame({"i": f["i"].iloc[:1], "v": [np.sum(np.array(f["v"].tolist()), axis=0).tolist()]})

    schema = "i long, v array<double>"
    return rows.groupBy("i", F.spark_partition_id() % 64).applyInPandas(add, schema).groupBy("i").applyInPandas(add, schema)


# ---------------------------------------------------------------- text slices


def slices(texts, limit: int = SLICE):
    """Index ranges of consecutive texts of at most ``limit`` characters
    together (a longer text is alone)."""
    lo = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if size + n > limit and i > lo:
            yield lo, i
            lo, size = i, 0
        size += n
    if len(texts) > lo:
        yield lo, len(texts)


def words(text) -> list[bytes]:
    """The words of a text, as UTF-8 (bytes.split knows the same six
    separators as ``WORD``)."""
    return text.encode("utf-8", "replace").split() if text else []


def flags(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_BLANK = flags(b"\x20\x09\x0a\x0b\x0c\x0d")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15


class _Powers:
    """Powers of an odd base modulo 2**64, and of its inverse, as far as
    needed so far; travels without them."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __reduce__(self):
        return _Powers, ()

    def __call__(self, n: int):
        if len(self.up) <= n:
            for name, x in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
                run = np.full(max(n, SLICE) + 4096, x, np.uint64)
                run[0] = 1
                setattr(self, name, np.cumprod(run, dtype=np.uint64))
        return self.up, self.down


_powers = _Powers()


class Tokens:
    """All words of a slice of texts without a Python object per word.

    ``bytes``: the texts as UTF-8, joined by line ends; ``start``, ``end``:
    each word in it; ``offsets``: the words of each text; ``begin``: the first
    byte of each text."""

    def __init__(self, texts, lower: bool = False):
        parts = [t.encode("utf-8", "replace") if t else b"" for t in texts]
        self.raw = b"\n".join([*parts, b""])
        self.bytes = np.frombuffer(self.raw, np.uint8)
        if lower:
            self.bytes = _LOWER[self.bytes]
        size = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        self.begin = np.concatenate([[0], np.cumsum(size)])
        inside = ~_BLANK[self.bytes]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[::2], edge[1::2]
        self.offsets = np.searchsorted(self.start, self.begin)

    def __len__(self):
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the words, by a polynomial over their bytes."""
        return hashed(self.bytes, self.start, self.end)

    def sizes(self) -> np.ndarray:
        return np.diff(self.offsets)

    def of(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.sizes())


def hashed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges, alike wherever the bytes stand."""
    up, down = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    v = data.astype(np.uint64)
    v += np.uint64(1)
    v *= up[:len(data)]
    np.cumsum(v, out=total[1:])
    out = total[end]
    out -= total[start]
    out *= down[start]
    return mix(out)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (finaliser of a public hash)."""
    y = x >> _S33
    y ^= x
    y *= _M1
    t = y >> _S33
    y ^= t
    y *= _M2
    np.right_shift(y, _S33, out=t)
    y ^= t
    return y


def rolled(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive (already spread) hashes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, k):
        out *= np.uint64(_BASE)
        out += h[i:i + n]
    return mix(out + np.uint64(k))


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each offsets range (0 for an empty one), along axis 0."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]))
    some = np.flatnonzero(np.diff(offsets))
    if len(some):
        out[some] = np.add.reduceat(values.astype(np.float64, copy=False), offsets[:-1][some], axis=0)
    return out


# ------------------------------------------------------- connected components


def components(edges: DataFrame, what: str = "components") -> DataFrame:
    """(node, comp) for every node of ``edges`` (columns a, b: long): comp is
    the smallest node of its connected component.

    Alternating large-star and small-star steps; each step groups by node
    with partial minima and joins, so that a hub with millions of neighbours
    is never held in one task (the join splits skewed keys)."""
    def print_of(f: DataFrame):
        """Number of edges and two sums of their hashes: no shuffle of rows."""
        sums = [F.sum(F.xxhash64("a", "b", F.lit(i)).cast("decimal(20,0)")) for i in (0, 1)]
        return tuple(f.agg(F.count("*"), *sums).first())

    e = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), what)
    state = print_of(e)
    while True:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.where("a <> b").distinct(), what)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
        small = staged(small.where("a <> b").distinct(), what)
        e, before, state = small, state, print_of(small)
        if state == before:
            break
    heads = e.select(F.col("b").alias("node")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(heads.select("node", F.col("node").alias("comp")))
