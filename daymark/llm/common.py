"""Helpers that several operators share: stored intermediate tables and words as numbers."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: ASCII white space; a word is a longest run of other characters.
SPACES = " \t\n\v\f\r"
#: The same class inside a Java or RE2 pattern.
WORD = r"[^\x20\x09-\x0D]+"
SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Bytes of text that numpy code looks at together; longer texts stand alone.
CHUNK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES.encode())] = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Python workers of this session will find this package where
    the driver has it; on a cluster it is installed or sent with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one in the warehouse where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/daymark_work"
    return folder.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends here, and a lost
    executor costs nothing that was written."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown when a text needs more."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, CHUNK_BYTES + 4096)
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            with np.errstate(over="ignore"):
                cls.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE)]), dtype=np.uint64)
                cls.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, inverse)]), dtype=np.uint64)
        return cls.up, cls.down


def chunks(texts: list[str | None], most: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Encoded texts in runs of about ``most`` bytes, each with the index of its first text."""
    run: list[bytes] = []
    first, size = 0, 0
    for i, text in enumerate(texts):
        data = b"" if text is None else text.encode("utf-8", "surrogatepass")
        if run and size + len(data) > most:
            yield first, run
            run, first, size = [], i, 0
        run.append(data)
        size += len(data)
    if run:
        yield first, run


def word_numbers(run: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit number for each word of each text, and where each text's words begin.

    Equal words have equal numbers. The hash (xxh3) is not linear in its bytes, so no
    pattern of long words makes different ones collide. The second array has one entry more
    than there are texts.
    """
    words: list[bytes] = []
    begins = np.zeros(len(run) + 1, np.int64)
    for i, data in enumerate(run):
        words += data.split()
        begins[i + 1] = len(words)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), begins


def feature_numbers(run: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The same for features of a classifier, which may share a number: words are not told
    apart for certain.

    Words are hashed by differences of one running polynomial sum, so the cost is a few
    vector operations per byte. The second array has one entry more than there are texts.
    """
    data = np.frombuffer(b"\n".join(run) + b"\n", np.uint8)
    space = _IS_SPACE[data]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edge[0::2], edge[1::2]
    up, down = _Powers.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * down[starts]
    numbers = mixed(raw + (ends - starts).astype(np.uint64) * _STEP)
    begins = np.zeros(len(run) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in run], out=begins[1:])
    return numbers, np.searchsorted(starts, begins)


def gram_numbers(numbers: np.ndarray, n: int) -> np.ndarray:
    """A number for each run of ``n`` consecutive entries."""
    size = max(0, len(numbers) - n + 1)
    total = np.zeros(size, np.uint64)
    for k in range(n):
        total = total * _BASE + numbers[k : k + size]
    return mixed(total)


def slices(batch: pa.RecordBatch, column: int, most: int = 4 * CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``most`` bytes in one of its columns, so that what a task
    makes of a part is bounded by bytes; a longer value stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes, dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for first, end in zip(cuts, cuts[1:]):
        if end > first:
            yield batch.slice(first, end - first)
    pa.default_memory_pool().release_unused()


def distinct_texts(rows: DataFrame, *labels: str) -> DataFrame:
    """h (the text's hash), the labels and ``copies``, the number of rows that share them."""
    return stored(rows.groupBy(F.xxhash64("text").alias("h"), *labels).agg(F.count("*").alias("copies")), "texts")


def picked_texts(rows: DataFrame, texts: DataFrame, most: int, *labels: str) -> DataFrame:
    """h, the labels, text and copies of at most ``most`` distinct texts of each label, picked
    by a hash; ``texts`` are the ``distinct_texts`` of ``rows``. Each task gives a text once, so
    what is computed from the rows still has to go through ``dropDuplicates`` by h and labels."""
    names = list(labels)
    totals = F.broadcast(texts.groupBy(*names).agg(F.count("*").alias("of")))
    near = texts.join(totals, names) if names else texts.crossJoin(totals)
    place = F.pmod(F.xxhash64("h"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    near = near.withColumn("place", place).where(F.col("place") * F.col("of") < 2 * most + 100).toPandas()
    near = near.sort_values(["place", "h"], kind="stable")
    near = near.groupby(names).head(most) if names else near.head(most)
    keys = texts.sparkSession.createDataFrame(pa.Table.from_pandas(near[["h", *names, "copies"]], to_arrow_schema(texts.schema), preserve_index=False), texts.schema)
    found = rows.select(F.xxhash64("text").alias("h"), *names, "text").join(F.broadcast(keys), ["h", *names])
    schema = found.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in batches:
            fresh = []
            for key in zip(*[batch.column(i).to_pylist() for i in range(1 + len(names))], strict=True):
                fresh.append(key not in seen)
                seen.add(key)
            yield batch.filter(pa.array(fresh, pa.bool_()))

    return found.mapInArrow(run, schema)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns whose names, in any case, are among ``names``."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def with_computed(df: DataFrame, text: str, ddl: str, compute: Callable) -> DataFrame:
    """``df`` with the columns of ``ddl``, which ``compute`` makes from lists of texts.

    ``compute`` gets a list of texts (None for null) and returns one list per column.
    Columns of ``df`` with the same names are replaced.
    """
    added = T.StructType.fromDDL(ddl)
    df = without(df.withColumn("__text_of_row", F.col(f"`{text}`")), added.names)
    own = df.drop("__text_of_row")
    schema = T.StructType(own.schema.fields + added.fields)
    types = to_arrow_schema(added).types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1):
                texts = part.column(part.num_columns - 1).to_pylist()
                columns = [part.column(i) for i in range(part.num_columns - 1)]
                made = [pa.array(c, t) for c, t in zip(compute(texts), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns + made, names=schema.names)

    return df.mapInArrow(run, schema)
