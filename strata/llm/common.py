"""Shared helpers of the text operators: staging, sizing, batching, word splitting.

Python code below runs inside Arrow batches that Spark partitions; every helper works on
one batch or one document at a time, so memory is bounded by a batch, not by the corpus.
"""

from __future__ import annotations

import ctypes
import math
import pickle
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_dir

#: Bytes of text that one step of a batch works on at a time.
SLICE_BYTES = 4 << 20
#: What a row counts for besides its text: its other columns, as Python values.
ROW_BYTES = 512


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it back. Cuts the
    lineage: a lost executor costs at most the tasks that were writing."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark, f'llm-{name}')}/data"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts (one distributed sum)."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def parts_for(n_bytes: int, each: int, least: int = 1) -> int:
    """How many parts of about ``each`` bytes hold ``n_bytes``."""
    return max(least, math.ceil(n_bytes / each))


#: Bytes of one Arrow batch. Documents are wide; batches of Spark's 10,000 rows hold tens of
#: megabytes, several copies of which are kept on both sides.
ARROW_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Limit the session's Arrow batches to ARROW_BYTES unless it was started with another limit."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(name):
        spark.conf.set(name, str(ARROW_BYTES))


def give_back() -> None:
    """Return freed memory of this worker to the system; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def arrow_schema(schema: str | T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    struct = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    return to_arrow_schema(struct)


def map_rows(
    df: DataFrame,
    per_slice: Callable[[dict[str, list]], dict[str, list]],
    schema: str,
    slice_bytes: int = SLICE_BYTES,
    text: str = "text",
) -> DataFrame:
    """``mapInArrow`` in slices of whole rows with about ``slice_bytes`` of text each.

    ``per_slice`` gets {column: python list} and returns {column: list or array}."""
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in gathered(batches, text, slice_bytes):
            table = pa.Table.from_batches(parts)
            out = per_slice({name: table.column(name).to_pylist() for name in table.column_names})
            yield to_batch(out, target)
        give_back()

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def to_batch(out: dict, target: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(out[f.name], type=f.type) for f in target], schema=target)


class Shared:
    """A broadcast of a bounded object of this package: sent as bytes that hold the classes by
    value, opened once per task."""

    def __init__(self, spark: SparkSession, what: object) -> None:
        from pyspark import cloudpickle

        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(what))

    def __getstate__(self) -> dict:
        return {"_sent": self._sent}

    def get(self):
        if "_own" not in self.__dict__:
            self._own = pickle.loads(self._sent.value)
        return self._own


def _sizes(batch: pa.RecordBatch, text: str) -> np.ndarray:
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
    return sizes.to_numpy(zero_copy_only=False).astype(np.int64) + ROW_BYTES


def slices(batch: pa.RecordBatch, text: str, limit: int) -> Iterator[tuple[pa.RecordBatch, int]]:
    """Whole rows, about ``limit`` bytes at a time (one row at least), and their bytes: those of the
    text and ROW_BYTES a row."""
    if batch.num_rows == 0:
        return
    ends = np.cumsum(_sizes(batch, text))
    start = 0
    while start < batch.num_rows:
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start), int(ends[stop - 1]) - before
        start = stop


def gathered(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Slices of one or several batches that make up about ``limit`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for part, n in slices(batch, text, limit):
            if held and size + n > limit:
                yield held
                held, size = [], 0
            held.append(part)
            size += n
    if held:
        yield held


def blank_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8. ``bytes.split()`` splits at exactly
    these six characters; none of them occurs inside a multi-byte character."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


#: Bytes that end a word of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z.
_NOT_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_TO_BLANK = bytes(0x20 if b in _NOT_ALNUM else b for b in range(256))


def alnum_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, then words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` as UTF-8."""
    if not text:
        return []
    return text.encode("utf-8", "surrogatepass").lower().translate(_TO_BLANK).split()


_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply) on unsigned integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


class Vocabulary:
    """Word -> small integer, with a 64-bit content hash per word; lives for one slice."""

    def __init__(self) -> None:
        self.codes: defaultdict[bytes, int] = defaultdict()
        self.codes.default_factory = self.codes.__len__

    def encode(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words))

    def hashes(self) -> np.ndarray:
        import xxhash

        return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in self.codes), np.uint64, len(self.codes))


_STEP = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(word_hash: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words (order matters); shorter: none."""
    n = len(word_hash) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.zeros(n, np.uint64)
    for k in range(size):
        acc = acc * _STEP + word_hash[k:k + n]
    return mix64(acc)


def has_letter(text: str | None) -> bool:
    """Whether a character of Unicode category L occurs. (Numerals such as the superscript two are word
    characters too, but no letters.)"""
    return bool(text) and any(category(m[0])[0] == "L" for m in re.finditer(r"[^\W\d_]", text))


def crc_fold(column: str, mod: int) -> F.Column:
    """crc32 of the id's decimal text, modulo ``mod``; null ids give null."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(mod))
