"""MinHash near-dedup by order MinHash, verified by banded alignment.

Texts are lower-cased words. For each of ``BANDS`` hash functions the ``PICKED`` least hashes of the
text's occurrence-labelled runs of two words are kept in text order and hashed into one key (Marçais
et al., 2019): equal keys need the same runs in the same order. Every fifth word replaced, the most a
near duplicate may differ, leaves run Jaccard similarity 0.43: a key agrees with probability about 0.08,
so some key of 80 agrees but for 2 in 1,000 long texts (1 in 56 at 15 words); with one word in ten
replaced (0.67) for fewer than 1 in 10^11. Texts of at most ``SHORT`` words also have a key for each way to
leave out as many words as they may differ by: two near duplicates of that length always have a common key.

A candidate is a near duplicate if its edit similarity, 1 - word edits / longer length, is at least
``SIMILARITY`` (0.8), decided by alignment in a band that is widened until the answer is certain.

* Equal texts are one class, found by a 128-bit hash; only one document of a class is compared.
* In each bucket of equal keys every class is compared with the bucket's leader, the class with the most
  bucket mates, not with every other. Links give components; a class that its bucket's leader did not
  draw in is then compared with all classes of the bucket that are in other components. So every pair of
  a bucket is compared or already in one component. Pairs that cannot reach the similarity are not compared:
  those whose lengths differ too much, those whose words differ in too many of 256 parities (one edit
  changes two at most), and, word edits being a metric, those of which one is close to the leader and the
  other farther from it than both that and the allowed edits. A pair meets in the least of its common
  buckets only. Classes of one bucket that lie just beyond the similarity of each other are all compared:
  their number of pairs grows with its square.
* Components by alternating large and small stars on edges; nothing is collected. Buckets, classes and
  stars of any size are rows of joins that Spark may split.
* Only token codes of candidate texts move, chosen by a filter of fixed size over document ids.

A missing text counts as empty; texts without words are compared as equal texts only. A document without
an id is not compared and stays. Rows that share an id are told apart by their text. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import (
    WORD_BYTES, TokenCodes, as_long, column_of, hash_filter, ids_and_texts, in_filter, mix, settle, text_runs, texts_of, windows,
)

SHINGLE = 2
PICKED = 3
BANDS = 80
SIMILARITY = 0.8
#: Longest text that has keys of its shortened forms; at SIMILARITY two words may go.
SHORT = 14
PARITIES = 4
#: Texts of more words than this have finer parities too, of at least four classes a word up to MOST_FINE.
FINE_FROM = 256
MOST_FINE = 1 << 16
_BLOCK = 1 << 20


def _band_keys(bands: int) -> np.ndarray:
    return mix(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def labelled(runs: np.ndarray) -> np.ndarray:
    """Runs told apart by their occurrence: the second of equal runs is another run."""
    ordered = np.sort(runs)
    if len(runs) < 2 or not (ordered[1:] == ordered[:-1]).any():
        return runs
    order = np.argsort(runs, kind="stable")
    values = runs[order]
    starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    nth = np.arange(len(runs)) - np.repeat(starts, np.diff(np.append(starts, len(runs))))
    out = np.empty_like(runs)
    out[order] = mix(values + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) * (nth > 0) + values * (nth == 0)
    return out


def sketch(codes: np.ndarray, bands: int = BANDS, picked: int = PICKED) -> np.ndarray:
    """One key per band; none for a text without words."""
    if not len(codes):
        return np.empty(0, np.uint64)
    runs = labelled(windows(codes, min(SHINGLE, len(codes))))
    keys = _band_keys(bands)
    count, out = min(picked, len(runs)), np.empty(bands, np.uint64)
    step = max(1, _BLOCK // len(runs))
    for first in range(0, bands, step):
        own = keys[first : first + step, None]
        hashed = (runs[None, :] ^ (runs[None, :] >> np.uint64(29))) * own
        hashed ^= hashed >> np.uint64(32)
        places = np.argpartition(hashed, count - 1, axis=1)[:, :count] if count < len(runs) else np.broadcast_to(
            np.arange(count), (len(own), count)
        )
        chosen = runs[np.sort(places, axis=1)]
        value = own[:, 0].copy()
        for i in range(count):
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + chosen[:, i])
        out[first : first + step] = value
    return out


@cache
def _shortened(n: int, most: int) -> list[np.ndarray]:
    """Places that stay when up to ``most`` of ``n`` words go."""
    return [np.array(list(combinations(range(n), n - gone)), np.intp) for gone in range(min(most, n - 1) + 1)]


def short_keys(codes: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """Keys of the forms of a short text that it may have in common with near duplicates of at most SHORT words."""
    n = len(codes)
    if not 0 < n <= SHORT:
        return np.empty(0, np.uint64)
    # A near duplicate has at most n / similarity words, and their common words are that less the edits.
    longest = min(SHORT, int(n / similarity + 1e-9))
    most = min(int((1.0 - similarity) * longest + 1e-9), 2)
    forms = []
    for places in _shortened(n, most):
        value = np.full(len(places), places.shape[1], np.uint64)
        for column in codes[places].T:
            value = mix(value * np.uint64(0x9E3779B97F4A7C15) + column)
        forms.append(value)
    return np.unique(np.concatenate(forms))


def fine_classes(words: int) -> int:
    """Classes of the finer parities of a text: a power of four, 0 for a short text."""
    size = 1024
    while size < min(4 * words, MOST_FINE):
        size *= 4
    return size if words > FINE_FROM else 0


def parities(codes: np.ndarray, size: int = 64 * PARITIES) -> np.ndarray:
    """Whether the words of each of ``size`` classes are odd in number, as bits."""
    odd = np.bincount((mix(codes) % np.uint64(size)).astype(np.intp), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def _band(a: list[np.ndarray], b: list[np.ndarray], width: int) -> np.ndarray:
    """Edit distances of pairs sorted by len(a), right where at most ``width``; rows of the alignment are
    computed for all pairs at once, the row's own minimum by a running minimum."""
    lengths = np.array([len(x) for x in a])
    left = np.full((len(a), lengths.max(initial=0)), -2, np.int32)
    right = np.full((len(a), left.shape[1] + 2 * width + 1), -1, np.int32)
    for i, (x, y) in enumerate(zip(a, b)):
        left[i, : len(x)] = x
        kept = y[: right.shape[1] - width]
        right[i, width : width + len(kept)] = kept
    offsets = np.arange(2 * width + 1, dtype=np.int32)
    big = np.int32(1 << 28)
    ends = np.clip(np.array([len(y) for y in b]) - lengths + width, 0, 2 * width)
    now = np.broadcast_to(np.where(offsets < width, big, offsets - width), (len(a), len(offsets))).astype(np.int32)
    out = np.empty(len(a), np.int64)
    active = 0
    for i in range(left.shape[1] + 1):
        if i:
            cost = right[active:, i - 1 : i + 2 * width] != left[active:, i - 1 : i]
            step = now + cost
            np.minimum(step[:, :-1], now[:, 1:] + 1, out=step[:, :-1])
            step -= offsets
            np.minimum.accumulate(step, axis=1, out=step)
            step += offsets
            now = step
        done = int(np.searchsorted(lengths, i, side="right"))
        if done > active:
            rows = np.arange(done - active)
            out[active:done] = now[rows, ends[active:done]]
            now, active = now[done - active :], done
    return out


def _trim(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    start = int(differ[0]) if len(differ) else n
    a, b, n = a[start:], b[start:], n - start
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    end = int(differ[0]) if len(differ) else n
    return a[: len(a) - end], b[: len(b) - end]


def _least_edits(a: np.ndarray, b: np.ndarray) -> int:
    """A lower bound of the edit distance: words that the other text has not."""
    values, counts = np.unique(np.concatenate((a, b)), return_inverse=True)
    own = np.bincount(counts[: len(a)], minlength=len(values))
    other = np.bincount(counts[len(a) :], minlength=len(values))
    return max(len(a), len(b)) - int(np.minimum(own, other).sum())


def measured(pairs: list[tuple[np.ndarray, np.ndarray]], similarity: float = SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """Whether each pair reaches ``similarity``; its word edits if it does, else a lower bound of them."""
    edits, reached = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
    open_pairs = []
    for i, (a, b) in enumerate(pairs):
        most = int((1.0 - similarity) * max(len(a), len(b)) + 1e-9)
        a, b = _trim(a, b)
        least = max(len(a), len(b)) if not len(a) or not len(b) else max(abs(len(a) - len(b)), _least_edits(a, b))
        edits[i] = least
        if not len(a) or not len(b):
            reached[i] = least <= most
        elif least <= most:
            open_pairs.append((i, most, *((a, b) if len(a) <= len(b) else (b, a))))
    width = 16
    while open_pairs:
        open_pairs.sort(key=lambda p: len(p[2]))
        left = []
        first = 0
        while first < len(open_pairs):
            end = first
            while end < len(open_pairs) and (end == first or (end + 1 - first) * (len(open_pairs[end][2]) + 6 * width) <= 1 << 21):
                end += 1
            group = open_pairs[first:end]
            for pair, found in zip(group, _band([p[2] for p in group], [p[3] for p in group], width)):
                i, most = pair[:2]
                if found <= min(width, most) and abs(len(pair[3]) - len(pair[2])) <= width:
                    edits[i], reached[i] = found, True
                elif width < most:
                    left.append(pair)
                else:
                    edits[i] = max(edits[i], most + 1)
            first = end
        open_pairs, width = left, width * 4
    return edits, reached


def near(pairs: list[tuple[np.ndarray, np.ndarray]], similarity: float = SIMILARITY) -> np.ndarray:
    """Edit similarity of each pair, or -1 where it is below ``similarity``."""
    edits, reached = measured(pairs, similarity)
    longest = np.array([max(len(a), len(b), 1) for a, b in pairs])
    return np.where(reached, 1.0 - edits / longest, -1.0) if len(pairs) else np.empty(0)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), as_long(np.concatenate(arrays) if arrays else np.empty(0, np.uint64)))


def fine_edits(one: str, other: str) -> Column:
    """Fewest edits that the finer parities of two texts (words, fine, coarse) allow, 0 where they have none in common."""
    def edits(left: Column, right: Column) -> Column:
        differ = F.zip_with(left, right, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
        differ = F.aggregate(differ, F.lit(0), lambda total, n: total + n)
        return F.ceil((differ + F.abs(F.col(f"{one}.words") - F.col(f"{other}.words"))) / 2).cast("int")

    a, b = F.col(f"{one}.fine"), F.col(f"{other}.fine")
    a_coarse, b_coarse = F.col(f"{one}.coarse"), F.col(f"{other}.coarse")
    return F.coalesce(
        F.when(F.size(a) == F.size(b), edits(a, b))
        .when(F.size(a_coarse) == F.size(b), edits(a_coarse, b))
        .when(F.size(a) == F.size(b_coarse), edits(a, b_coarse)),
        F.lit(0),
    )


def sketches(docs: DataFrame, bands: int = BANDS, picked: int = PICKED, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, 128-bit hash of the text (h1, h2), Spark's hash of it, its word parities and its keys; one scan, no shuffle."""
    odd_names = [f"odd{i}" for i in range(PARITIES)]
    schema = (
        f"doc_id long, text_hash long, h1 long, h2 long, words int, {', '.join(f'{name} long' for name in odd_names)}, "
        "keys array<long>, fine array<long>, coarse array<long>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = TokenCodes()
        for batch in text_runs(batches):
            texts = texts_of(batch)
            digests = [xxhash.xxh3_128_intdigest(text) for text in texts]
            found = [codes.array(text.translate(WORD_BYTES).split()) for text in texts]
            keys = [np.concatenate((sketch(own, bands, picked), short_keys(own, similarity))) for own in found]
            odd = np.array([parities(own) for own in found], np.uint64).reshape(len(found), PARITIES)
            words = [len(own) for own in found]
            sizes = [fine_classes(n) for n in words]
            # The second of equal words is another word here, so that counts differ by more than parity.
            found = [labelled(own) if size else own for own, size in zip(found, sizes)]
            fine = [parities(own, size) if size else own[:0] for own, size in zip(found, sizes)]
            # As a text with a fourth of the classes has them, for pairs of the two.
            coarse = [parities(own, size // 4) if size > 1024 else own[:0] for own, size in zip(found, sizes)]
            yield pa.RecordBatch.from_arrays([
                column_of(batch, "doc_id"), column_of(batch, "text_hash"),
                as_long(np.array([d >> 64 for d in digests], np.uint64)),
                as_long(np.array([d & 0xFFFFFFFFFFFFFFFF for d in digests], np.uint64)),
                pa.array(words, pa.int32()),
                *(as_long(odd[:, i]) for i in range(PARITIES)),
                _lists(keys), _lists(fine), _lists(coarse),
            ], ["doc_id", "text_hash", "h1", "h2", "words", *odd_names, "keys", "fine", "coarse"])

    texts = ids_and_texts(docs).where("doc_id IS NOT NULL").withColumn("text_hash", F.xxhash64("text"))
    return texts.mapInArrow(run, schema)


def token_codes(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(node, codes) of documents whose id passes the filter: four bytes per word."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = TokenCodes()
        for batch in text_runs(batches):
            ids = column_of(batch, "doc_id")
            keep = in_filter(shared.value, ids.to_numpy(zero_copy_only=False))
            part = batch.filter(pa.array(keep))
            packed = [
                (codes.array(text.translate(WORD_BYTES).split()) >> np.uint64(33)).astype(np.int32).tobytes()
                for text in texts_of(part)
            ]
            if packed:
                yield pa.RecordBatch.from_arrays([column_of(part, "doc_id"), pa.array(packed, pa.binary())], ["node", "codes"])

    return ids_and_texts(docs).where("doc_id IS NOT NULL").mapInArrow(run, "node long, codes binary")


def verified(pairs: DataFrame, codes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) as alignment finds them: ``near``, and the word edits or else a lower bound of them."""
    both = pairs.join(codes.withColumnsRenamed({"node": "a", "codes": "left"}), "a").join(
        codes.withColumnsRenamed({"node": "b", "codes": "right"}), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = column_of(batch, "left"), column_of(batch, "right")
            edits, reached = measured(
                [(np.frombuffer(x.as_buffer(), np.int32), np.frombuffer(y.as_buffer(), np.int32)) for x, y in zip(a, b)],
                similarity,
            )
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "a"), column_of(batch, "b"), pa.array(edits, pa.int32()), pa.array(reached)],
                ["a", "b", "edits", "near"],
            )

    return both.select("a", "b", "left", "right").mapInArrow(run, "a long, b long, edits int, near boolean")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for nodes of undirected links (a, b) that are no roots; the root is the least node reached."""
    edges = settle(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "stars"
    )
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = settle(large.where("u <> v").distinct(), "stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now


def least_edits(one: str, other: str) -> Column:
    """Fewest edits that two looks (words and parities) allow; a missing look allows any."""
    differ = sum(
        (F.bit_count(F.col(f"{one}.odd{i}").bitwiseXOR(F.col(f"{other}.odd{i}"))) for i in range(PARITIES)), F.lit(0)
    )
    # Edits are at least the words that either has beyond the other: half of both, and half the lengths' difference.
    longer = F.abs(F.col(f"{one}.words") - F.col(f"{other}.words"))
    return F.coalesce(F.greatest(longer, F.ceil((differ + longer) / 2).cast("int")), F.lit(0))


def most_edits(one: str, other: str, similarity: float) -> Column:
    """Most edits that two looks of near duplicates may have; any with a missing look."""
    longest = F.when(F.col(one).isNotNull() & F.col(other).isNotNull(), F.greatest(f"{one}.words", f"{other}.words"))
    return F.coalesce(F.lit(1 - similarity) * longest + 1e-6, F.lit(1e9))


def meetings(placed: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs (x, y) of different components that have a bucket in common and may be near duplicates, a row each.

    ``placed`` has a row per bucket and node: key, node, root, apart (from the leader's component), least (edits
    from the leader at least), edits (if it is close to the leader), look, fine and keys, all keys of the node's rows.
    """
    names = ["key", "node", "root", "look", "least", "fine", "keys"]
    x = placed.where("apart").select(*[F.col(name).alias("x" if name == "node" else f"x_{name}") for name in names])
    y = placed.withColumnsRenamed({"node": "y", "look": "y_look", "fine": "y_fine"})
    most = most_edits("x_look", "y_look", similarity)
    meet = (
        (F.col("x_key") == F.col("key")) & (F.col("x_root") != F.col("root")) & (~F.col("apart") | (F.col("x") < F.col("y")))
        & (F.col("x_least") - F.coalesce("edits", F.lit(1 << 30)) <= most)
        & (least_edits("x_look", "y_look") <= most)
        # A bound that excludes the pair in one bucket holds in all, so the least common bucket decides for them.
        & (F.array_min(F.array_intersect("x_keys", "keys")) == F.col("key"))
        & (fine_edits("x_fine", "y_fine") <= most)
    )
    return x.join(y, meet).select("x", "y")


def _grouped(
    docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, picked: int = PICKED
) -> DataFrame:
    """What near_duplicates gives, with Spark's hash of the row's text."""
    def looked(frame: DataFrame, node: str, look: str) -> DataFrame:
        return frame.join(looks.withColumnsRenamed({"node": node, "look": look}), node)

    rows = settle(sketches(docs, bands, picked, similarity), "omh-sketches")
    classes = settle(rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("class_id")), "omh-classes")
    c = classes.select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), "class_id")
    nodes = rows.join(c, (F.col("doc_id") == F.col("class_id")) & (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")))
    nodes = nodes.select(F.col("class_id").alias("node"), F.struct("words", *[f"odd{i}" for i in range(PARITIES)]).alias("look"), "keys")
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    buckets = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("mates")).where("mates > 1")
    members = settle(keyed.join(buckets, "key").distinct(), "omh-members")
    degrees = members.groupBy("node").agg(F.sum("mates").alias("degree"))
    met = hash_filter(members.select(F.col("node").alias("value")).distinct())
    # Texts that share an id have no look of their own.
    looks = settle(
        nodes.join(degrees.select("node"), "node", "left_semi").groupBy("node").agg(F.min("look").alias("look"), F.max("look").alias("other"))
        .select("node", F.when(F.col("look") == F.col("other"), F.col("look")).alias("look")),
        "omh-looks",
    )
    leaders = (
        members.join(degrees, "node").groupBy("key").agg(F.max(F.struct("degree", (-F.col("node")).alias("minus"))).alias("top"))
        .select("key", (-F.col("top.minus")).alias("leader"))
    )
    codes = settle(token_codes(docs, met), "omh-codes")
    led = settle(members.select("key", "node").join(leaders, "key").where("node <> leader"), "omh-led")
    ends = (F.greatest("node", "leader").alias("a"), F.least("node", "leader").alias("b"))
    first = settle(
        looked(looked(led.select(*ends).distinct(), "a", "look_a"), "b", "look_b")
        .select("a", "b", least_edits("look_a", "look_b").alias("least"), (least_edits("look_a", "look_b") <= most_edits("look_a", "look_b", similarity)).alias("open")),
        "omh-first",
    )
    tested = settle(verified(first.where("open").select("a", "b"), codes, similarity), "omh-tested")
    found = tested.where("near").select("a", "b")
    held = settle(components(found), "omh-components")

    def rooted(frame: DataFrame, node: str, root: str) -> DataFrame:
        own = held.withColumnsRenamed({"node": node, "root": root})
        return frame.join(own, node, "left").withColumn(root, F.coalesce(root, node))

    # What the leader did not draw in meets the rest of its bucket, unless they are in one component. Edits are a
    # metric: who is far from the leader is far from those close to it, and is not compared with them.
    known = tested.groupBy("a", "b").agg(F.min("edits").alias("fewest"), F.max("edits").alias("edits"), F.bool_and("near").alias("near"))
    bounds = first.join(known, ["a", "b"], "left").select(
        "a", "b", F.greatest("least", "fewest").alias("least"), F.when(F.col("near"), F.col("edits")).alias("edits")
    )
    placed = rooted(rooted(led, "node", "root"), "leader", "leader_root").withColumn("apart", F.col("root") != F.col("leader_root"))
    some = placed.where("apart").select("key").distinct()
    placed = placed.join(some, "key", "left_semi").withColumns({"a": ends[0], "b": ends[1]}).join(bounds, ["a", "b"])
    placed = looked(placed.select("key", "node", "root", "apart", "least", "edits"), "node", "look")
    placed = settle(placed, "omh-placed")
    shared = placed.groupBy("node").agg(F.collect_set("key").alias("keys"))
    fine = rows.withColumnRenamed("doc_id", "node").join(shared.select("node"), "node", "left_semi")
    fine = fine.select("node", F.struct("h1", "h2", "words", "fine", "coarse").alias("fine")).groupBy("node").agg(
        F.min("fine").alias("fine"), F.max("fine").alias("other")
    ).where("fine = other").where(F.size("fine.fine") > 0).select("node", "fine")
    placed = settle(placed.join(shared.join(fine, "node", "left"), "node"), "omh-met")
    second = meetings(placed, similarity).select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).join(
        first, ["a", "b"], "left_anti"
    )
    links = settle(found.unionByName(verified(second, codes, similarity).where("near").select("a", "b")), "omh-all-links")
    roots = components(links)
    linked = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    named = (
        classes.withColumn("node", F.col("class_id")).join(roots, "node", "left").join(linked, "node", "left")
        .select("h1", "h2", "class_id", F.coalesce("root", "class_id").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    without_id = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NULL").select(
        "doc_id", F.lit(None).cast("long").alias("class_id"), F.lit(None).cast("long").alias("group_id"),
        F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("kept"), F.lit(None).cast("long").alias("text_hash"),
    )
    return rows.join(named, ["h1", "h2"]).select(
        "doc_id", "class_id", "group_id", "n_links", (F.col("doc_id") == F.col("group_id")).alias("kept"), "text_hash"
    ).unionByName(without_id)


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, class_id (least id with the same text), group_id (least id of its
    near duplicates), n_links (confirmed links of its class), kept (it is the document that stays)."""
    return _grouped(docs, **options).drop("text_hash")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents that stay, with their own columns. Rows equal in id and text stay or go together."""
    gone = _grouped(docs, **options).where(~F.col("kept")).select(
        F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")
    ).distinct()
    # As for any size of the list, so that a growing corpus does not change the plan.
    return docs.join(
        gone.hint("merge"),
        (F.col("doc_id").cast("long") == F.col("gone_id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("gone_hash")),
        "left_anti",
    )
