"""What several text operators share: staging, tokens as integer codes, files in the shared folder.

Operators take any frame that has the columns they name; other columns, whatever they are called, are
ignored, so extra columns cannot clash with the columns an operator adds.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from itertools import chain
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.session import scratch_dir, settle

__all__ = ["ids_and_texts", "settle", "scratch_dir"]

_LOWER = bytes(range(ord("A"), ord("Z") + 1))
#: A-Z to a-z, all other bytes as they are.
LOWER_ASCII = bytes.maketrans(_LOWER, _LOWER.lower())
#: A-Z to a-z; ASCII other than letters and digits to a space; bytes of non-ASCII characters stay.
WORD_BYTES = bytes(
    ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else (b if b >= 128 else 32) for b in range(256)
)

#: Bytes of text that are worked on at a time.
TEXT_BYTES = 1 << 22

_MIX = np.uint64(0x9E3779B97F4A7C15)


def ids_and_texts(df: DataFrame, key: str = "doc_id", text: str = "text", *more: str) -> DataFrame:
    """Only the columns named, the key as a long and a missing text as an empty one."""
    return df.select(
        F.col(key).cast("long").alias(key), F.coalesce(F.col(text), F.lit("")).alias(text), *more
    )


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a string column, without decoding them."""
    column = batch.column(batch.schema.get_field_index(name))
    wide = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(wide).to_pylist()


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def slices(batch: pa.RecordBatch, name: str = "text") -> Iterator[pa.RecordBatch]:
    """Runs of rows of about TEXT_BYTES of text; a longer text is a run of its own."""
    ends = np.cumsum(pc.binary_length(column_of(batch, name)).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        start = ends[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(ends, start + TEXT_BYTES, side="right")))
        yield batch.slice(first, end - first)
        first = end


def text_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of all batches; then what Arrow keeps is given back, as the worker lives on for other stages."""
    for batch in batches:
        yield from slices(batch)
    batch = None
    pa.default_memory_pool().release_unused()


class TokenCodes(dict):
    """Token bytes to 64-bit hashes, remembered up to a bound that only saves time."""

    BOUND = 400_000

    def __missing__(self, token: bytes) -> int:
        if len(self) >= self.BOUND:
            self.clear()
        code = self[token] = xxhash.xxh64_intdigest(token)
        return code

    def array(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    v = values ^ (values >> np.uint64(31))
    v = v * np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v = v * np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(33)
    return v


def windows(codes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` codes; none if there are fewer codes."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * _MIX + codes[i : i + n]
    return mix(out)


def flat(lists: Iterable[list]) -> list:
    return list(chain.from_iterable(lists))


def as_long(values: np.ndarray) -> pa.Array:
    """Unsigned 64-bit hashes as Spark longs of the same bits."""
    return pa.array(np.ascontiguousarray(values, np.uint64).view(np.int64))


def shared_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder of the cluster's shared storage."""
    return pafs.FileSystem.from_uri(uri if urlparse(uri).scheme else f"file://{uri}")


def publish_file(folder: str, name: str, chunks: Iterator[bytes]) -> str:
    """Writes a file under a name of this attempt alone, so that repeated and speculative tasks never
    meet; only the attempt whose rows Spark keeps is ever read. Returns the file's full name."""
    fs, path = shared_fs(folder)
    fs.create_dir(path, recursive=True)
    full = f"{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(f"{path}/{full}") as out:
        for chunk in chunks:
            out.write(chunk)
    return full


def open_shared(folder: str, name: str) -> pa.NativeFile:
    """Memory-mapped where the shared folder is mounted, else streamed from its store."""
    fs, path = shared_fs(folder)
    if isinstance(fs, pafs.LocalFileSystem):
        return pa.memory_map(f"{path}/{name}")
    return fs.open_input_file(f"{path}/{name}")


def salt(n: int, *columns: str) -> Column:
    """A number below ``n`` that spreads the rows of one hot key, the same in each attempt."""
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


FILTER_BITS = 1 << 24


def hash_filter(values: DataFrame, bits: int = FILTER_BITS, mixed: bool = False) -> np.ndarray:
    """A bitmap of fixed size (a power of two) over the longs in column ``value``; at most bits / 64 numbers reach
    the driver. Values that are ``mixed`` already are not hashed again.

    What it lets pass may be too much, never too little: a join decides. It only saves moving rows.
    """
    spread = "value" if mixed else "xxhash64(value)"
    slot = F.pmod(F.expr(spread), F.lit(bits))
    found = (
        values.select((slot / 64).cast("long").alias("word"), F.expr(f"shiftleft(1L, cast(pmod({spread}, 64) as int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("held"))
    ).toArrow()
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[found["word"].to_numpy()] = found["held"].to_numpy()
    return bitmap.view(np.uint64)


def spark_hash(values: np.ndarray, seed: int = 42) -> np.ndarray:
    """Spark's xxhash64 of longs, for arrays."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
    ))
    v = values.astype(np.int64).view(np.uint64)

    def turn(x: np.ndarray, r: int) -> np.ndarray:
        return (x << np.uint64(r)) | (x >> np.uint64(64 - r))

    h = np.full(len(v), np.uint64(seed)) + p5 + np.uint64(8)
    h ^= turn(v * p2, 31) * p1
    h = turn(h, 27) * p1 + p4
    h ^= h >> np.uint64(33)
    h *= p2
    h ^= h >> np.uint64(29)
    h *= p3
    return h ^ (h >> np.uint64(32))


def in_filter(bitmap: np.ndarray, values: np.ndarray, mixed: bool = False) -> np.ndarray:
    slot = (values if mixed else spark_hash(values)) & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
