"""Line dedup: content-defined chunks of lines, globally repeated ones removed after byte comparison.

A rolling hash over the hashes of two neighbouring lines decides whether a chunk ends between them: where
it is divisible by ``DIVISOR``, and where it is rarer in the whole table than one of its two lines. Both
depend on these two lines alone, so boundaries move with the text; and as a chunk holds only lines that
always stand together, a repeated line lies in a chunk that is repeated whole, whatever its neighbours and
however long or short the passage is. Chunks joined by repeated line pairs are a run; runs of less than
``MIN_WORDS`` words are left alone. Of equal chunks in the others the first stays (smallest document id,
then hash of its text, then place); the rest go where an unbroken part of a run that may go has
``MIN_WORDS`` words. Lines without words belong to the line before them and are not compared.

1. Hashes of lines and of line pairs are counted, combined in each batch and before the shuffle.
2. Places of hashes that occur more than once are gathered per document: its lines at most. A filter of
   fixed size keeps the others from moving; false positives only move more, a join decides.
3. Documents meet their places by id and text; texts of chunks that may go are compared byte by byte with
   the text of their first place, in a join that Spark may split.
4. Documents meet their removed chunks and are rewritten where they lie.

A line of a third of all documents is one row per batch in step 1; in steps 2 and 3 its places are sides of
joins. Missing texts are empty; rows equal in id and text are one document and are treated alike; a missing
id is the smallest. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import as_long, column_of, hash_filter, ids_and_texts, in_filter, mix, settle, texts_of

DIVISOR = 8
MIN_WORDS = 20
_ROWS = 20_000


def worded_lines(text: bytes) -> tuple[list[bytes], list[int], np.ndarray]:
    """All lines, the places of those with words, and these lines' numbers of words."""
    lines = text.split(b"\n")
    sizes = [len(line.split()) for line in lines]
    places = [i for i, size in enumerate(sizes) if size]
    return lines, places, np.array([sizes[i] for i in places], np.int64)


def hashes(lines: list[bytes], places: list[int]) -> np.ndarray:
    """Hashes of the lines at even places, rolling hashes over two neighbours between them."""
    own = np.fromiter((xxhash.xxh64_intdigest(lines[i]) for i in places), np.uint64, len(places))
    out = np.empty(max(2 * len(own) - 1, 0), np.uint64)
    out[::2] = own
    out[1::2] = mix(own[:-1] * np.uint64(3) + own[1:])
    return out


def repeated_runs(values: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> list[list[tuple[int, int]]]:
    """Runs of chunks of repeated lines as (first, end), of at least MIN_WORDS words; ``counts`` as ``hashes``."""
    single, pair = counts[::2], counts[1::2]
    runs: list[list[tuple[int, int]]] = []
    first, chunks = 0, []
    for i in range(len(single)):
        last = i + 1 == len(single)
        linked = not last and pair[i] > 1
        if last or pair[i] < max(single[i], single[i + 1]) or values[2 * i + 1] % np.uint64(DIVISOR) == 0:
            if single[i] > 1:
                chunks.append((first, i + 1))
            first = i + 1
            if not linked:
                if chunks and sizes[chunks[0][0] : chunks[-1][1]].sum() >= MIN_WORDS:
                    runs.append(chunks)
                chunks = []
    return runs


def counted_hashes(docs: DataFrame) -> DataFrame:
    """(hash, n) of the lines and line pairs that occur more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [hashes(*worded_lines(text)[:2]) for text in texts_of(batch)]
            values, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *found]), return_counts=True)
            yield pa.RecordBatch.from_arrays([as_long(values), pa.array(counts, pa.int64())], ["hash", "n"])

    rows = ids_and_texts(docs).select("text").mapInArrow(run, "hash long, n long")
    return rows.groupBy("hash").agg(F.sum("n").alias("n")).where("n > 1")


def repeated_places(docs: DataFrame, counted: DataFrame) -> DataFrame:
    """(d, h, marks: place and count of the repeated hashes) of documents that have some."""
    shared = docs.sparkSession.sparkContext.broadcast(hash_filter(counted.select(F.col("hash").alias("value"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [hashes(*worded_lines(text)[:2]) for text in texts_of(batch)]
            rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
            places = np.concatenate([np.empty(0, np.int64), *(np.arange(len(f)) for f in found)])
            values = np.concatenate([np.empty(0, np.uint64), *found])
            keep = np.flatnonzero(in_filter(shared.value, values.view(np.int64)))
            yield pa.RecordBatch.from_arrays([
                column_of(batch, "doc_id").take(pa.array(rows[keep])), column_of(batch, "own").take(pa.array(rows[keep])),
                pa.array(places[keep], pa.int32()), as_long(values[keep]),
            ], ["d", "h", "place", "hash"])

    texts = ids_and_texts(docs).withColumn("own", F.xxhash64("text"))
    found = texts.mapInArrow(run, "d long, h long, place int, hash long")
    return found.join(counted, "hash").groupBy("d", "h").agg(F.collect_set(F.struct("place", "n")).alias("marks"))


def _with(docs: DataFrame, other: DataFrame, how: str) -> DataFrame:
    """Documents beside their row of the other frame. Both sides are shuffled at any size: whether the
    other frame is small changes with the corpus."""
    texts = ids_and_texts(docs).withColumn("own", F.xxhash64("text"))
    return texts.join(other.hint("merge"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("own") == F.col("h")), how)


def repeated_chunks(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Chunks of repeated lines with their texts: rows (doc_id, text_hash, first, end, run, hash, size, chunk_text)."""
    names = ["doc_id", "text_hash", "first", "end", "run", "hash", "size", "chunk_text"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays([*arrays[:-1], arrays[-1].cast(pa.string())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            ids, owns = column_of(batch, "doc_id").to_pylist(), column_of(batch, "own").to_pylist()
            for doc_id, own, text, found in zip(ids, owns, texts_of(batch), column_of(batch, "marks")):
                lines, places, sizes = worded_lines(text)
                values = hashes(lines, places)
                counts = np.ones(len(values), np.int64)
                counts[found.values.field("place").to_numpy()] = found.values.field("n").to_numpy()
                for chunks in repeated_runs(values, counts, sizes):
                    for first, end in chunks:
                        body = b"\n".join(lines[i] for i in places[first:end])
                        value = xxhash.xxh64_intdigest(body) - (1 << 63)
                        rows.append((doc_id, own, first, end, chunks[0][0], value, len(body), body))
                if len(rows) > _ROWS:
                    yield table(rows)
                    rows = []
            if rows:
                yield table(rows)

    schema = "doc_id long, text_hash long, first int, end int, run int, hash long, size int, chunk_text string"
    return _with(docs, marks, "inner").select("doc_id", "own", "text", "marks").mapInArrow(run, schema)


def removed_chunks(docs: DataFrame) -> DataFrame:
    """(d, h, removed: first, end and run of repeated chunks but the first of equal ones), per document."""
    counted = settle(counted_hashes(docs), "line-hashes")
    chunks = settle(repeated_chunks(docs, repeated_places(docs, counted)), "line-chunks")
    place = F.struct("doc_id", "text_hash", "first")
    firsts = chunks.groupBy("hash", "size").agg(F.min(place).alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1")
    both = chunks.join(firsts.select("hash", "size", "original"), ["hash", "size"])
    at_first = place.eqNullSafe(F.col("original"))
    texts = both.where(at_first).select("hash", "size", F.col("chunk_text").alias("original_text")).dropDuplicates(["hash", "size"])
    return (
        both.where(~at_first).join(texts, ["hash", "size"]).where(F.col("chunk_text") == F.col("original_text"))
        .groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"))
        .agg(F.sort_array(F.collect_set(F.struct("first", "end", "run"))).alias("removed"))
    )


RESULT = "doc_id long, n_lines long, n_removed_chunks long, n_removed_lines long, n_removed_words long, text string"


def without_chunks(text: bytes, removed: list[dict]) -> tuple[int, int, int, int, bytes]:
    """Lines, chunks, lines and words that went, and the text that stays; short runs of chunks stay."""
    lines, places, sizes = worded_lines(text)
    spans: list[list[int]] = []
    for chunk in removed:
        if spans and spans[-1][1] == chunk["first"] and spans[-1][2] == chunk["run"]:
            spans[-1][1], spans[-1][3] = chunk["end"], spans[-1][3] + 1
        else:
            spans.append([chunk["first"], chunk["end"], chunk["run"], 1])
    spans = [span for span in spans if sizes[span[0] : span[1]].sum() >= MIN_WORDS]
    if not spans:
        return len(lines), 0, 0, 0, text
    kept, at = [], 0
    for first, end, _, _ in spans:
        kept += lines[at : places[first]]
        at = places[end] if end < len(places) else len(lines)
    kept += lines[at:]
    n_lines, n_words = sum(end - first for first, end, _, _ in spans), sum(int(sizes[s[0] : s[1]].sum()) for s in spans)
    return len(lines), sum(span[3] for span in spans), n_lines, n_words, b"\n".join(kept)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """One row per document: counts of what went (lines with words), and the text that stays."""
    removed = settle(removed_chunks(docs), "line-removals")
    names = [part.split()[0] for part in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = column_of(batch, "removed").to_pylist()
            rows = [without_chunks(text, list(chunks or ())) for text, chunks in zip(texts_of(batch), gone)]
            columns = list(zip(*rows)) or [()] * 5
            counts = [pa.array(c, pa.int64()) for c in columns[:4]]
            text = pa.array(columns[4], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([column_of(batch, "doc_id"), *counts, text], names)

    return _with(docs, removed, "left").select("doc_id", "text", "removed").mapInArrow(run, RESULT)
