"""LM scoring with an Elias-Fano bigram trie, built and queried by Spark tasks.

Levels of the trie are files in the cluster's shared folder, memory-mapped by the tasks that score.

* Level 1, by range of 64-bit word hashes: sorted hashes and counts; a word's id is its place over all
  ranges. Beside it, for each word, how many distinct words follow it.
* Level 2, in segments: the distinct contexts (Elias-Fano), pointers to their ranges (Elias-Fano), the
  followers of each context made monotone by adding the last value of the context before (Elias-Fano), and
  one byte per bigram, its discounted log probability in 256 steps. A query looks up its context, takes the
  range between two pointers and searches the successor of ``follower + base`` in it.
  A context's followers are dealt over segments by blocks of ids, so a word that stands before a third of all
  words fills no segment by itself.

Probability of a word w after v, interpolated with absolute discounting:

    p(w | v) = max(c(v w) - D, 0) / c(v) + D * followers(v) / c(v) * p(w),   p(w) = (c(w) + 1) / (N + V + 1)

and p(w) if v was never seen. A text begins after a start mark and ends with an end mark, which is a token.
Counts come from every training document. Tasks count their own words and bigrams first and shuffle packed
blocks of sorted keys; ranges and segments are merged as blocks arrive. Per-range and per-segment file
names and totals (a few numbers per shuffle partition) are all that reaches the driver.

Missing texts are empty (one token, the end mark). A missing id counts as an empty one when documents are
held out. Repeated rows count and are scored each. Ids are below 2^32. An empty table gives an empty result;
without training documents every word is unknown.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.common import (
    LOWER_ASCII, TokenCodes, column_of, ids_and_texts, mix, open_shared, publish_file, scratch_dir, settle, texts_of,
)
from skyledger.llm.elias_fano import EliasFano

_U = np.uint64
#: Marks contain a space, which no word does.
START = xxhash.xxh64_intdigest(b"start mark")
END = xxhash.xxh64_intdigest(b"end mark")
DISCOUNT = 0.75
BLOCK_BITS = 12
#: One step of a quantised log10 probability; 255 steps reach down to 10^-8.
QUANTUM = 8.0 / 255
_PENDING = 1 << 21
_TEXT_BYTES = 1 << 22

# Packed blocks: sorted keys as differences, byte planes of both columns deflated.


def pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    steps = np.diff(keys, prepend=_U(0))
    planes = steps.view(np.uint8).reshape(-1, 8).T.tobytes() + counts.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()
    return zlib.compress(planes, 1)


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(zlib.decompress(blob), np.uint8)
    n = len(data) // 12
    steps = np.ascontiguousarray(data[: 8 * n].reshape(8, n).T).view(_U).ravel()
    counts = np.ascontiguousarray(data[8 * n :].reshape(4, n).T).view(np.uint32).ravel()
    return np.cumsum(steps, dtype=_U), counts.astype(np.int64)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their counts added up."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[starts], np.add.reduceat(counts, starts)


class Tally:
    """Adds blocks of keys and counts, merging whenever enough have come."""

    def __init__(self) -> None:
        self.keys, self.counts, self.held = [], [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)
        if self.held > _PENDING and len(self.keys) > 1 and self.held > 2 * len(self.keys[0]):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate(self.keys) if self.keys else np.empty(0, _U)
        counts = np.concatenate(self.counts) if self.counts else np.empty(0, np.int64)
        keys, counts = summed(keys, counts)
        self.keys, self.counts, self.held = [keys], [counts], len(keys)
        return keys, counts


def dealt(part: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Splits sorted keys by the part each belongs to."""
    order = np.argsort(part, kind="stable")
    part, keys, counts = part[order], keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else []
    for first, end in zip(starts, [*starts[1:], len(part)]):
        yield int(part[first]), pack(keys[first:end], counts[first:end])


def held_out_column() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of a few megabytes of text, so that tokens of one fit in little memory."""
    for batch in batches:
        sizes = np.cumsum([len(x) for x in texts_of(batch)])
        first = 0
        while first < len(sizes):
            before = sizes[first - 1] if first else 0
            end = max(first + 1, int(np.searchsorted(sizes, before + _TEXT_BYTES)))
            yield batch.slice(first, end - first)
            first = end


def coded(texts: list[bytes], codes: TokenCodes) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each closed by the end mark, and where each text ends."""
    words = [text.translate(LOWER_ASCII).split() for text in texts]
    ends = np.cumsum([len(w) + 1 for w in words])
    out = np.full(int(ends[-1]) if len(ends) else 0, _U(END))
    first = 0
    for own, end in zip(words, ends):
        out[first : end - 1] = codes.array(own)
        first = end
    return out, ends


class Vocabulary:
    """Level 1: hashes in order over files by range; ids are places in that order."""

    def __init__(self, spec: dict):
        self.folder, self.bits = spec["folder"], spec["bits"]
        self.offsets = np.array(spec["offsets"], np.int64)
        self.total, self.size, self.texts = spec["total"], spec["size"], spec["texts"]
        self.files, self.followers = spec["files"], spec.get("followers", {})
        self.held: dict[int, tuple] = {}

    def _range(self, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        if part not in self.held:
            data = _mapped(self.folder, self.files[part])
            n = len(data) // 16
            followers = None
            if part in self.followers:
                followers = np.frombuffer(_mapped(self.folder, self.followers[part]), np.int64)
            self.held[part] = np.frombuffer(data, _U, n), np.frombuffer(data, np.int64, n, 8 * n), followers
        return self.held[part]

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For sorted hashes: ids (-1 if unknown), counts, distinct followers."""
        ids, counts, followers = np.full(len(codes), -1, np.int64), np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        parts = (codes >> _U(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(codes), np.int64)
        starts = np.flatnonzero(np.concatenate(([True], parts[1:] != parts[:-1]))) if len(parts) else []
        for first, end in zip(starts, [*starts[1:], len(parts)]):
            part = int(parts[first])
            if part not in self.files:
                continue
            keys, own_counts, own_followers = self._range(part)
            place = np.searchsorted(keys, codes[first:end])
            place = np.minimum(place, len(keys) - 1)
            known = keys[place] == codes[first:end]
            ids[first:end] = np.where(known, place + self.offsets[part], -1)
            counts[first:end] = np.where(known, own_counts[place], 0)
            if own_followers is not None:
                followers[first:end] = np.where(known, own_followers[place], 0)
        return ids, counts, followers


def _mapped(folder: str, name: str) -> memoryview:
    return memoryview(open_shared(folder, name).read_buffer())


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    """Segment of bigram keys (context << 32 | follower): by context and block of followers."""
    return (mix(keys >> _U(BLOCK_BITS)) % _U(segments)).astype(np.int64)


def build_segment(keys: np.ndarray, counts: np.ndarray, context_counts: np.ndarray, discount: float) -> list[bytes]:
    """The bytes of one level-2 segment; keys sorted, a count of its context beside each key."""
    contexts, followers = keys >> _U(32), keys & _U(0xFFFFFFFF)
    starts = np.flatnonzero(np.concatenate(([True], contexts[1:] != contexts[:-1])))
    lasts = followers[np.append(starts[1:], len(keys)) - 1]
    bases = np.concatenate((np.zeros(1, _U), np.cumsum(lasts, dtype=_U)[:-1]))
    monotone = followers + np.repeat(bases, np.diff(np.append(starts, len(keys))))
    logs = np.log10(np.maximum(counts - discount, 1e-9) / np.maximum(context_counts, 1))
    quantised = np.clip(np.rint(-logs / QUANTUM), 0, 255).astype(np.uint8)
    parts = []
    for values in (contexts[starts], np.append(starts, len(keys)), monotone):
        parts += EliasFano.build(values).dump()
    return [*parts, quantised.tobytes()]


class Segment:
    def __init__(self, data: memoryview):
        self.contexts, at = EliasFano.load(data, 0)
        self.pointers, at = EliasFano.load(data, at)
        self.followers, at = EliasFano.load(data, at)
        self.quantised = np.frombuffer(data, np.uint8, self.followers.n, at)

    def probability(self, keys: np.ndarray) -> np.ndarray:
        """Discounted probability of each of the sorted bigram keys, 0 if it was never seen."""
        out = np.zeros(len(keys))
        context, follower = keys >> _U(32), keys & _U(0xFFFFFFFF)
        # Each context's range is looked up once.
        starts = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1])))
        place, known = self.contexts.find(context[starts])
        begin, end = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        begin[known] = self.pointers.access(place[known])
        end[known] = self.pointers.access(place[known] + 1)
        base = np.zeros(len(starts), _U)
        later = begin > 0
        base[later] = self.followers.access(begin[later] - 1)
        sizes = np.diff(np.append(starts, len(keys)))
        inside = np.flatnonzero(np.repeat(known, sizes))
        begin, end, base = (np.repeat(column, sizes)[inside] for column in (begin, end, base))
        want = follower[inside] + base
        found, equal = self.followers.find(want)
        # Follower 0 equals the base, which is the last value of the context before.
        early = np.flatnonzero(found < begin)
        found[early] = begin[early]
        equal[early] = self.followers.access(begin[early]) == want[early]
        ok = equal & (found < end)
        out[inside[ok]] = np.power(10.0, -QUANTUM * self.quantised[found[ok]])
        return out


def _partition_count(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _merged(blocks: DataFrame, parts: int, finish, schema: str) -> DataFrame:
    """Deals blocks (part, blob) to tasks and merges those of a part as they arrive; ``finish(part, keys,
    counts)`` gives the rows of a part."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in schema.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tally = None, Tally()

        def out() -> Iterator[pa.RecordBatch]:
            for row in finish(part, *tally.merge()):
                yield pa.RecordBatch.from_pylist([dict(zip(fields.names, row))], fields)

        for batch in batches:
            for number, blob in zip(column_of(batch, "part").to_pylist(), column_of(batch, "blob")):
                if part is not None and number != part:
                    yield from out()
                    tally = Tally()
                part = number
                tally.add(*unpack(blob.as_buffer()))
        if part is not None:
            yield from out()

    return blocks.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(run, schema)


def build_vocabulary(docs: DataFrame, folder: str) -> dict:
    """Counts words of training texts; returns where the ranges are and the totals."""
    spark = docs.sparkSession
    parts = _partition_count(spark)
    bits = max(0, (parts - 1).bit_length())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, tally, texts = TokenCodes(), Tally(), 0
        for batch in sliced(batches):
            found, _ = coded(texts_of(batch), codes)
            texts += batch.num_rows
            tally.add(*(x if x.dtype == _U else x.astype(np.int64) for x in np.unique(found, return_counts=True)))
        keys, counts = tally.merge()
        part = (keys >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
        rows = list(dealt(part, keys, counts))
        if rows:
            numbers, blobs = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary())], ["part", "blob"])

    def finish(part: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[tuple]:
        name = publish_file(folder, f"words-{part}", iter([keys.tobytes(), counts.tobytes()]))
        ends = int(counts[keys == _U(END)].sum())
        yield part, name, len(keys), int(counts.sum()), ends

    blocks = docs.where(~held_out_column()).select("text").mapInArrow(count, "part int, blob binary")
    ranges = _merged(blocks, parts, finish, "part int, file string, n long, total long, texts long").collect()
    offsets, sofar = [0] * (1 << bits), 0
    for row in sorted(ranges, key=lambda r: r["part"]):
        offsets[row["part"]] = sofar
        sofar += row["n"]
    return {
        "folder": folder, "bits": bits, "offsets": offsets, "files": {r["part"]: r["file"] for r in ranges},
        "size": sofar, "total": sum(r["total"] for r in ranges), "texts": sum(r["texts"] for r in ranges),
    }


def bigram_keys(found: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary) -> tuple:
    """Distinct hashes with ids, counts and followers; and per token its own and its context's index."""
    words, inverse = np.unique(found, return_inverse=True)
    ids, counts, followers = vocabulary.find(words)
    before = np.empty(len(inverse), np.int64)
    before[1:] = inverse[:-1]
    before[np.concatenate(([0], ends[:-1])).astype(np.int64)] = -1  # begins a text: after the start mark
    return ids, counts, followers, inverse, before


def build_segments(docs: DataFrame, spec: dict, discount: float) -> dict:
    """Counts bigrams of training texts into level-2 segments; adds them and the followers to the spec."""
    spark = docs.sparkSession
    parts, folder = _partition_count(spark), spec["folder"]
    start_id = spec["size"]  # the start mark is a context only

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, vocabulary, tally = TokenCodes(), Vocabulary(spec), Tally()

        def out() -> Iterator[pa.RecordBatch]:
            keys, counts = tally.merge()
            rows = list(dealt(segment_of(keys, parts), keys, counts))
            if rows:
                numbers, blobs = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary())], ["part", "blob"])

        for batch in sliced(batches):
            found, ends = coded(texts_of(batch), codes)
            ids, _, _, inverse, before = bigram_keys(found, ends, vocabulary)
            context = np.where(before < 0, start_id, ids[before])
            keys = (context.astype(_U) << _U(32)) | ids[inverse].astype(_U)
            keys, counts = np.unique(keys, return_counts=True)
            tally.add(keys, counts.astype(np.int64))
            if tally.held > 4 * _PENDING:
                yield from out()
                tally = Tally()
        yield from out()

    def finish(part: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[tuple]:
        contexts, place = np.unique(keys >> _U(32), return_inverse=True)
        totals = IdCounts(spec)(contexts.astype(np.int64))
        name = publish_file(folder, f"bigrams-{part}", iter(build_segment(keys, counts, totals[place], discount)))
        yield part, name, len(keys), -1, None
        followers = np.bincount(place, minlength=len(contexts))
        real = contexts < _U(start_id)
        bounds = IdCounts(spec).part_of(contexts[real].astype(np.int64))
        for number, blob in dealt(bounds, contexts[real], followers[real]):
            yield part, None, 0, number, blob
        if not real.all():
            yield part, None, int(followers[~real].sum()), -2, None

    blocks = docs.where(~held_out_column()).select("text").mapInArrow(count, "part int, blob binary")
    built = settle(
        _merged(blocks, parts, finish, "part int, file string, n long, range int, blob binary"), "trie-segments"
    )

    def finish_followers(part: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[tuple]:
        first = spec["offsets"][part]
        out = np.zeros(IdCounts(spec).sizes[part], np.int64)
        out[keys.astype(np.int64) - first] = counts
        yield part, publish_file(folder, f"followers-{part}", iter([out.tobytes()]))

    followers = _merged(
        built.where("range >= 0").select(F.col("range").alias("part"), "blob"), parts, finish_followers, "part int, file string"
    ).collect()
    segments = built.where("file IS NOT NULL").select("part", "file", "n").collect()
    begins = built.where("range = -2").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return spec | {
        "segments": {r["part"]: r["file"] for r in segments}, "parts": parts, "bigrams": sum(r["n"] for r in segments),
        "followers": {r["part"]: r["file"] for r in followers}, "start_followers": begins, "discount": discount,
    }


class IdCounts:
    """Counts of words by id, from the ranges of level 1."""

    def __init__(self, spec: dict):
        self.spec, self.vocabulary = spec, Vocabulary(spec)
        self.parts = sorted(spec["files"])
        self.starts = np.array([spec["offsets"][p] for p in self.parts], np.int64)
        self.sizes = dict(zip(self.parts, np.diff(np.append(self.starts, spec["size"])).tolist()))

    def part_of(self, ids: np.ndarray) -> np.ndarray:
        return np.array(self.parts, np.int64)[np.searchsorted(self.starts, ids, side="right") - 1]

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        """The start mark, whose id follows the last word's, counts once per text."""
        out = np.full(len(ids), self.spec["texts"], np.int64)
        words = ids < self.spec["size"]
        parts = self.part_of(ids[words])
        found = np.empty(len(parts), np.int64)
        for part in np.unique(parts):
            own = parts == part
            found[own] = self.vocabulary._range(int(part))[1][ids[words][own] - self.spec["offsets"][int(part)]]
        out[words] = found
        return out


class Model:
    def __init__(self, spec: dict):
        self.spec, self.vocabulary = spec, Vocabulary(spec)
        self.held: dict[int, Segment] = {}

    def seen(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys))
        segment = segment_of(keys, self.spec["parts"])
        order = np.argsort(segment, kind="stable")
        starts = np.flatnonzero(np.concatenate(([True], np.diff(segment[order]) != 0))) if len(keys) else []
        for first, end in zip(starts, [*starts[1:], len(keys)]):
            part = int(segment[order[first]])
            if part not in self.spec["segments"]:
                continue
            if part not in self.held:
                self.held[part] = Segment(_mapped(self.spec["folder"], self.spec["segments"][part]))
            own = order[first:end]
            out[own] = self.held[part].probability(keys[own])
        return out

    def score(self, found: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: known tokens, base log10 score, log10 probability under the trie."""
        spec, discount = self.spec, self.spec["discount"]
        ids, counts, followers, inverse, before = bigram_keys(found, ends, self.vocabulary)
        single = (counts + 1.0) / (spec["total"] + spec["size"] + 1.0)
        context = np.where(before < 0, spec["size"], ids[before])
        own = ids[inverse]
        both = (context >= 0) & (own >= 0)
        keys, place = np.unique((context[both].astype(_U) << _U(32)) | own[both].astype(_U), return_inverse=True)
        seen = np.zeros(len(found))
        seen[both] = self.seen(keys)[place]
        rate = np.where(counts > 0, discount * followers / np.maximum(counts, 1), 1.0)
        start_rate = discount * spec["start_followers"] / spec["texts"] if spec["texts"] else 1.0
        back_off = np.where(before < 0, start_rate, rate[before])
        back_off = np.where(context < 0, 1.0, back_off)
        smoothed = np.log10(seen + back_off * single[inverse])
        starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
        add = np.add.reduceat
        return add((counts > 0)[inverse].astype(np.int64), starts), add(np.log10(single)[inverse], starts), add(smoothed, starts)


SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def train(docs: DataFrame, discount: float = DISCOUNT) -> dict:
    """Builds the trie from the documents that are not held out; the spec names its files."""
    rows = ids_and_texts(docs)
    spec = build_vocabulary(rows, scratch_dir(docs.sparkSession, "ngram-trie"))
    return build_segments(rows, spec, discount)


def score(docs: DataFrame, spec: dict) -> DataFrame:
    """One row per document, by the trie that ``spec`` names."""
    names = [field.split()[0] for field in SCORES.split(", ")]
    total = spec["total"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, model = TokenCodes(), Model(spec)
        for batch in sliced(batches):
            found, ends = coded(texts_of(batch), codes)
            known, base, smoothed = model.score(found, ends)
            lengths = np.diff(np.concatenate(([0], ends)))
            yield pa.RecordBatch.from_arrays([
                column_of(batch, "doc_id"), column_of(batch, "held_out"), pa.array(lengths), pa.array(known),
                pa.array(np.full(len(known), total, np.int64)), pa.array(base), pa.array(smoothed),
            ], names)

    return ids_and_texts(docs, "doc_id", "text", held_out_column().alias("held_out")).mapInArrow(run, SCORES)


def perplexity(scores: DataFrame, column: str = "score") -> float:
    """Of the held-out documents, per token."""
    total, tokens = scores.where("held_out").agg(F.sum(column), F.sum("n_tokens")).first()
    return math.pow(10.0, -total / tokens)


def score_documents(docs: DataFrame, discount: float = DISCOUNT) -> DataFrame:
    return score(docs, train(docs, discount))
