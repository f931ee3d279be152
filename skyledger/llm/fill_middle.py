"""Fill-in-middle: texts cut at two code points and written with the middle last.

A batch of texts is one run of UTF-8 bytes, viewed as 64-bit words. Arithmetic on whole words marks
each byte that ends a code point; counting bits gives the code points per word, and their running sum
turns "the k-th code point" into a search for its word and a selection inside it, for all documents of the
batch at once. No text is decoded, and each document costs two cuts however long it is.

Rows are transformed where they lie: no shuffle. A missing text is empty and stays as it is (``plain``), like
texts that hold a marker themselves; a missing id is written as no digits in the text that is hashed. Equal
rows give equal results, an empty table an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import column_of, ids_and_texts, texts_of

# Markers and names of forms.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

HIGH = np.uint64(0x8080808080808080)
ONES = np.uint64(0x0101010101010101)


class UnitIndex:
    """Where the code points of a run of UTF-8 bytes end."""

    def __init__(self, data: bytes) -> None:
        n = len(data)
        # At least one zero byte follows, which counts as the start of another code point.
        words = np.frombuffer(data + bytes(16 - n % 8), "<u8")
        continued = words & HIGH & ~(words << np.uint64(1))
        starts = continued ^ HIGH
        ends = starts >> np.uint64(8)
        ends[:-1] |= starts[1:] << np.uint64(56)
        ends[n // 8] &= np.uint64((1 << (n % 8 * 8)) - 1)
        ends[n // 8 + 1 :] = 0
        self.ends = ends
        self.sums = np.concatenate([[0], np.cumsum(np.bitwise_count(ends), dtype=np.int64)])

    def units_before(self, offsets: np.ndarray) -> np.ndarray:
        """Number of code points that end before each byte offset."""
        word = offsets >> 3
        below = (np.uint64(1) << (offsets & 7).astype(np.uint64) * np.uint64(8)) - np.uint64(1)
        return self.sums[word] + np.bitwise_count(self.ends[word] & below)

    def end_of(self, units: np.ndarray) -> np.ndarray:
        """Byte offset behind each code point, counted from 0."""
        word = np.minimum(np.searchsorted(self.sums, units, side="right"), len(self.ends)) - 1
        rank = (units - self.sums[word]).astype(np.uint64)
        # Byte j of the product holds the number of ends in bytes 0 to j; those at most ``rank`` come before.
        sums = (self.ends[word] >> np.uint64(7)) * ONES
        before = ((rank * ONES | HIGH) - sums) & HIGH
        return word * 8 + np.bitwise_count(before) + 1


def numbers_of(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers below 2^32 from a document's id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4]) for i in (0, 4, 8, 12)]


def rearrange(
    ids: list[int | None], texts: list[bytes], fim_percent: int, spm_percent: int, seed: int
) -> Iterator[tuple[int, str, int | None, int | None, bytes]]:
    """(n, form, code points of the prefix, of the middle, output) of each text."""
    bounds = np.concatenate([[0], np.cumsum([len(text) for text in texts], dtype=np.int64)])
    index = UnitIndex(b"".join(texts))
    marks = index.units_before(bounds)
    counts = np.diff(marks)
    numbers = np.array([numbers_of(doc_id, seed) for doc_id in ids], np.int64).reshape(-1, 4)
    cuts = np.sort(numbers[:, :2] % (counts + 1)[:, None], axis=1)
    # A cut behind the last of no units is the text's own start.
    places = np.where(cuts > 0, index.end_of(np.maximum(marks[:-1, None] + cuts - 1, 0)), bounds[:-1, None]) - bounds[:-1, None]
    for text, n, (_, _, h3, h4), (a, b), (i, j) in zip(
        texts, counts.tolist(), numbers.tolist(), cuts.tolist(), places.tolist()
    ):
        if not text or h3 % 100 >= fim_percent or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
            yield n, PLAIN, None, None, text
        elif h4 % 100 < spm_percent:
            yield n, SPM, a, b - a, b"".join((SUFFIX, text[j:], PREFIX, text[:i], MIDDLE, text[i:j]))
        else:
            yield n, PSM, a, b - a, b"".join((PREFIX, text[:i], SUFFIX, text[j:], MIDDLE, text[i:j]))


RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def fill_in_middle(docs: DataFrame, fim_percent: int = 90, spm_percent: int = 20, seed: int = 1) -> DataFrame:
    """One row per document: its code points, the form taken, where it was cut, and the text to train on."""
    names = [part.split()[0] for part in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = column_of(batch, "doc_id").to_pylist()
            n, form, prefix, middle, output = zip(*rearrange(ids, texts_of(batch), fim_percent, spm_percent, seed))
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                pa.array(output, pa.binary()).cast(pa.string()),
            ], names)

    return ids_and_texts(docs).mapInArrow(run, RESULT)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made from.

    A marker cannot begin inside another or in a text without markers, so the output falls into four parts.
    """
    parts = F.split(output, "<[PSM]>")
    psm, spm = F.concat(parts[1], parts[3], parts[2]), F.concat(parts[2], parts[3], parts[1])
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def round_trip(docs: DataFrame) -> DataFrame:
    """What became of each document, its output and the text restored from that as digests."""
    return fill_in_middle(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
