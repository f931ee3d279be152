"""Substring dedup: suffix trees of groups of suffixes that share prefixes, deep nodes of which are repeats.

A suffix matters if at least ``WINDOW`` words follow from its start. Its prefix reaches from there to the end
of the run of ``RUN`` words with the least hash among its first ``WINDOW`` words: it is between 10 and 50 words
long, and suffixes that begin with the same 50 words have the same prefix. Neighbouring suffixes whose
prefixes end in the same run travel together, as one stretch of text (about 70 words for 20 suffixes).

1. Runs are counted, one row per stretch and no text. Suffixes whose run stands in one document only are leaves of
   the tree and go.
2. Stretches of the others, equal ones combined before the shuffle, meet by run. A task takes as many runs as fit
   its memory and builds their trees from the root down, in elastic steps of 32, 16 and 2 words: suffixes that
   stand alone at a step leave. What is left at 50 words are deep nodes; each knows its least document.
3. A run with more than ``HOT`` different stretches (a passage in very many surroundings) is not gathered: its
   suffixes take the longest prefix, all 50 words, and a node is one key of an aggregate.
4. Nodes go back to the places of their stretches, and documents to the list of their repeats.

Symbols of the trees are 64-bit word hashes. Step 1 leaves a bitmap of fixed size, so that most text does not
move; what it lets pass is settled in step 2, so a full bitmap costs time and no result. Missing texts have no
words; a missing id is the smallest; rows equal in id and text are one document and are treated alike, and
repeats between rows of one id stay. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import (
    TokenCodes, as_long, column_of, hash_filter, ids_and_texts, in_filter, mix, settle, texts_of, windows,
)

WINDOW = 50
RUN = 10
HOT = 20_000
#: Words whose trees a task builds at once, and bytes of text it looks at together.
TREE_WORDS = 1_000_000
CHUNK_BYTES = 2_000_000
FILTER_BITS = 1 << 26

_SMALLEST = -(1 << 63)
_K = np.uint64(0x9E3779B97F4A7C15)


def least_runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Place of the least hash among ``size`` neighbours, the leftmost of equal ones, for each start."""
    at, reach = np.arange(len(hashes)), 1
    while reach < size:
        step = min(reach, size - reach)
        left, right = at[:-step], at[step:]
        at = np.where(hashes[left] <= hashes[right], left, right)
        reach += step
    return at


def find_stretches(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, first start, last start, run hash) of each stretch of texts that stand one behind the other."""
    ends = np.cumsum(lengths)
    if len(codes) < WINDOW:
        return tuple(np.empty(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64))
    runs = windows(codes, RUN)
    least = least_runs(runs, WINDOW - RUN + 1)
    text = np.repeat(np.arange(len(lengths)), lengths)[: len(least)]
    starts = np.flatnonzero(np.arange(len(least)) + WINDOW <= ends[text])
    text, least = text[starts], least[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return text[first], starts[first], starts[last], runs[least[first]]


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[bytes]]]:
    """Ids and texts of a batch, a bounded number of bytes (or one text) at a time."""
    ids, texts, held = [], [], 0
    for doc, text in zip(column_of(batch, "doc").to_pylist(), texts_of(batch)):
        ids.append(doc)
        texts.append(text)
        held += len(text)
        if held > CHUNK_BYTES:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _keyed(docs: DataFrame) -> DataFrame:
    return ids_and_texts(docs).select("doc_id", F.coalesce("doc_id", F.lit(_SMALLEST)).alias("doc"), "text")


def run_counts(docs: DataFrame) -> DataFrame:
    """(value): hashes of runs that stand in several documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = TokenCodes()
        for batch in batches:
            for ids, texts in _chunks(batch):
                words = [text.split() for text in texts]
                lengths = np.array([len(w) for w in words], np.int64)
                text, _, _, runs = find_stretches(codes.array([w for own in words for w in own]), lengths)
                if len(text):
                    docs_of = np.array(ids, np.int64)[text]
                    yield pa.RecordBatch.from_arrays([as_long(runs), pa.array(docs_of)], ["value", "doc"])

    found = _keyed(docs).select("doc", "text").mapInArrow(run, "value long, doc long")
    return found.groupBy("value").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").select("value")


def _stretch_rows(docs: DataFrame, wanted: np.ndarray, with_text: bool) -> DataFrame:
    """Stretches whose run may stand in several documents, with their text or with their place."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)
    names = ["run", "h", "doc", *(["n", "stretch"] if with_text else ["own", "start"])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = TokenCodes()
        for batch in batches:
            for ids, texts in _chunks(batch):
                own_words = [text.split() for text in texts]
                words = [w for own in own_words for w in own]
                lengths = np.array([len(w) for w in own_words], np.int64)
                text, first, last, runs = find_stretches(codes.array(words), lengths)
                pick = in_filter(shared.value, runs)
                text, first, last, runs = text[pick], first[pick], last[pick], runs[pick]
                if not len(text):
                    continue
                bodies = [b" ".join(words[a : b + WINDOW]) for a, b in zip(first.tolist(), last.tolist())]
                hashes = np.fromiter(map(xxhash.xxh64_intdigest, bodies), np.uint64, len(bodies))
                arrays = [as_long(runs), as_long(hashes), pa.array(np.array(ids, np.int64)[text])]
                if with_text:
                    arrays += [pa.array((last - first + 1).astype(np.int32)), pa.array(bodies, pa.binary()).cast(pa.string())]
                else:
                    owns = np.array([xxhash.xxh64_intdigest(t, 42) for t in texts], np.uint64)
                    before = np.cumsum(lengths) - lengths
                    arrays += [as_long(owns[text]), pa.array(first - before[text])]
                yield pa.RecordBatch.from_arrays(arrays, names)

    kinds = "run long, h long, doc long, " + ("n int, stretch string" if with_text else "own long, start long")
    return _keyed(docs).select("doc", "text").mapInArrow(run, kinds)


def deep_nodes(bodies: list[bytes], counts: np.ndarray, least: np.ndarray, codes: TokenCodes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(stretch, start in it, least document of the node at ``WINDOW`` words) of every suffix.

    ``counts`` are the suffixes of each stretch, ``least`` their least documents.
    """
    lengths = counts + WINDOW - 1
    before = np.cumsum(lengths) - lengths
    names = [codes.array([word for body in bodies for word in body.split()])]
    for level in range(5):
        shorter, step = names[-1], 1 << level
        names.append(mix(shorter[:-step] * _K + shorter[step:]))
    stretch = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(len(stretch)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = before[stretch] + start
    found = least[stretch].copy()
    # From the root down: suffixes alone in their node have met their leaf.
    live, node, depth = np.arange(len(stretch)), np.zeros(len(stretch), np.uint64), 0
    for level in (5, 4, 1):
        keys = mix(node * _K + names[level][place[live] + depth])
        _, inverse, sizes = np.unique(keys, return_inverse=True, return_counts=True)
        several = sizes[inverse] > 1
        live, node = live[several], inverse[several].astype(np.uint64)
        depth += 1 << level
    if len(live):
        order = np.argsort(node, kind="stable")
        nodes, firsts = np.unique(node[order], return_index=True)
        leasts = np.minimum.reduceat(found[live[order]], firsts)
        found[live] = leasts[np.searchsorted(nodes, node)]
    return stretch, start, found


def _tree_rows(distinct: DataFrame) -> DataFrame:
    """(run, h, first, last, least): suffixes of stretches that begin earlier, in document ``least``."""
    names = ["run", "h", "first", "last", "least"]

    def grow(rows: list[tuple], codes: TokenCodes) -> Iterator[pa.RecordBatch]:
        runs, hashes, counts, least, most, bodies = zip(*rows)
        counts = np.array(counts, np.int64)
        most = np.array(most, np.int64)
        stretch, start, found = deep_nodes(list(bodies), counts, np.array(least, np.int64), codes)
        pick = found < most[stretch]
        stretch, start, found = stretch[pick], start[pick], found[pick]
        if not len(stretch):
            return
        new = np.ones(len(stretch), bool)
        new[1:] = (stretch[1:] != stretch[:-1]) | (start[1:] != start[:-1] + 1) | (found[1:] != found[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(stretch)) - 1
        at = stretch[first]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.array(runs, np.int64)[at]), pa.array(np.array(hashes, np.int64)[at]),
            pa.array(start[first].astype(np.int32)), pa.array(start[last].astype(np.int32)), pa.array(found[first]),
        ], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, rows, held, current = TokenCodes(), [], 0, None
        for batch in batches:
            columns = [column_of(batch, name).to_pylist() for name in ("run", "h", "n", "least", "most")]
            for key, h, n, least, most, body in zip(*columns, texts_of(batch, "stretch")):
                # Trees are cut between runs only.
                if held > TREE_WORDS and key != current:
                    yield from grow(rows, codes)
                    rows, held = [], 0
                rows.append((key, h, n, least, most, body))
                held += n + WINDOW
                current = key
        if rows:
            yield from grow(rows, codes)

    rows = distinct.select("run", "h", "n", "least", "most", "stretch").repartition("run").sortWithinPartitions("run")
    return rows.mapInArrow(run, "run long, h long, first int, last int, least long")


def _long_prefixes(distinct: DataFrame) -> DataFrame:
    """As ``_tree_rows``, for stretches of hot runs: every suffix under its longest prefix, all ``WINDOW`` words."""
    names = ["prefix", "run", "h", "first", "least", "most"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = TokenCodes()
        for batch in batches:
            lists = [column_of(batch, name).to_pylist() for name in ("run", "h", "least", "most")]
            for key, h, least, most, body in zip(*lists, texts_of(batch, "stretch")):
                prefixes = windows(codes.array(body.split()), WINDOW)
                n = len(prefixes)
                yield pa.RecordBatch.from_arrays(
                    [as_long(prefixes), *(pa.array(np.full(n, x, np.int64)) for x in (key, h)),
                     pa.array(np.arange(n, dtype=np.int32)), *(pa.array(np.full(n, x, np.int64)) for x in (least, most))],
                    names,
                )

    rows = distinct.select("run", "h", "least", "most", "stretch").mapInArrow(
        run, "prefix long, run long, h long, first int, least long, most long"
    )
    nodes = rows.groupBy("run", "prefix").agg(F.min("least").alias("node_least"))
    return rows.join(nodes, ["run", "prefix"]).where("node_least < most").select(
        "run", "h", "first", F.col("first").alias("last"), F.col("node_least").alias("least")
    )


def repeated_spans(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc, own, start, end, least): words of a document from ``start`` to before ``end`` that begin earlier, in
    document ``least``. Each is one node's part of a repeat; spans of a repeat overlap."""
    wanted = hash_filter(run_counts(docs), FILTER_BITS)
    distinct = settle(
        _stretch_rows(docs, wanted, True).groupBy("run", "h", "n", "stretch")
        .agg(F.min("doc").alias("least"), F.max("doc").alias("most")),
        "stretches",
    )
    # Few rows by nature: each stands for more than ``hot`` stretches. Spark broadcasts them or not by their size.
    crowded = settle(distinct.groupBy("run").count().where(F.col("count") > hot).select("run"), "hot-runs")
    nodes = settle(
        _tree_rows(distinct.join(crowded, "run", "left_anti"))
        .unionByName(_long_prefixes(distinct.join(crowded, "run", "left_semi"))),
        "nodes",
    )
    return (
        _stretch_rows(docs, wanted, False).join(nodes, ["run", "h"]).where(F.col("least") < F.col("doc"))
        .select(
            "doc", "own", (F.col("start") + F.col("first")).alias("start"),
            (F.col("start") + F.col("last") + WINDOW).alias("end"), "least",
        )
    )


RESULT = "doc_id long, n_words long, n_removed long, text string"


def covered(spans: Iterable[dict], n: int) -> np.ndarray:
    """Which of ``n`` words lie in some span."""
    steps = np.zeros(n + 1, np.int64)
    for span in spans:
        steps[span["start"]] += 1
        steps[span["end"]] -= 1
    return np.cumsum(steps[:n]) > 0


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """One row per document: its words, how many of them went, and those that stay, joined by single spaces."""
    spans = settle(
        repeated_spans(docs, hot).groupBy("doc", "own")
        .agg(F.collect_list(F.struct("start", "end")).alias("spans")),
        "spans",
    )
    names = [part.split()[0] for part in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans_of in zip(texts_of(batch), column_of(batch, "spans").to_pylist()):
                words = text.split()
                if spans_of:
                    gone = covered(spans_of, len(words))
                    kept = [word for word, out in zip(words, gone.tolist()) if not out]
                else:
                    kept = words
                rows.append((len(words), len(words) - len(kept), b" ".join(kept)))
            n, removed, kept = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([
                column_of(batch, "doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ], names)

    texts = _keyed(docs).withColumn("own", F.xxhash64("text"))
    # Both sides are shuffled at any size: whether the list of spans is small changes with the corpus.
    return texts.join(spans.hint("merge"), ["doc", "own"], "left").select("doc_id", "text", "spans").mapInArrow(run, RESULT)


def digests(docs: DataFrame) -> DataFrame:
    """``remove_repeats`` with a digest in place of the text."""
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
