"""Phrase collocations from an FM-index per shard, over word ids.

A shard holds about ``SHARD_BYTES`` of one language's text, pieces of it parted by a mark. Its index is
the Burrows-Wheeler transform of the ids and that of the reversed ids, both sorted to the depth of the longest
phrase. An interval pair stands for all places of a phrase; extending it by a word on one side is a rank
query on that side and a count on the other, done for all phrases of a length at once. The ends of an interval tell
how often a phrase is preceded and followed by another word of its piece.

1. Shards are written once to the shared folder and read by every later step.
2. Words and pairs, then phrases whose pairs are all frequent, are listed by each shard under a 64-bit hash; counts
   are combined before the shuffle and summed over shards. A phrase that is frequent has frequent parts, so none
   is lost. What is frequent reaches the shards as a bitmap of fixed size; what that lets pass too much is counted
   like the rest and found too rare.
3. Of the shards that hold a frequent phrase the one of least number spells it out, so texts move once each.

Missing texts have no words, a missing language is ``und``; repeated rows count as often as they stand there; ids
play no part. An empty table gives an empty result. The text of a document is never cut, so a shard may be longer
by one document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import (
    LOWER_ASCII, as_long, column_of, hash_filter, in_filter, mix, scratch_dir, settle, spark_hash,
    texts_of,
)

LONGEST = 5
LEAST_COUNT = 100
TOP = 2000
#: Small enough that several shards, both sides of each, fit a worker and the buffers on its way.
SHARD_BYTES = 1 << 20
SHARDS_PER_FILE = 16
#: Rows of text that are taken out of a batch together.
SLICE = 500
FILTER_BITS = 1 << 26
NO_LANGUAGE = "und"

_K = np.uint64(0x9E3779B97F4A7C15)
#: A-Z to a-z, tabs to spaces, marks that end a piece to line ends.
_PIECES = LOWER_ASCII.translate(bytes.maketrans(b"\t.,;:!?\x0b\x0c\r", b" " + b"\n" * 9))
#: Id of the end of a piece.
END = 0


def word_ids(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Words, and their ids from 1 in the order of the texts, each piece between two ends."""
    joined = b"\n".join([b"", *(text.translate(_PIECES) for text in texts), b""]).replace(b"\n", b" \n ")
    tokens = pc.split_pattern(pa.array([joined], pa.large_binary()), b" ").flatten().dictionary_encode()
    listed = tokens.dictionary.to_pylist()
    # Places between two spaces are no words.
    number = np.cumsum([token not in (b"", b"\n") for token in listed], dtype=np.int32)
    number[[i for i, token in enumerate(listed) if token == b""]] = -1
    number[[i for i, token in enumerate(listed) if token == b"\n"]] = END
    found = number[tokens.indices.to_numpy()]
    return [token for token in listed if token not in (b"", b"\n")], found[found >= 0]


def _order(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of (high, low), equal ones by place, and the keys compared."""
    key = high.astype(np.int64) * (int(low.max()) + 1) + low
    bits = len(key).bit_length()
    if int(key.max()).bit_length() + bits <= 63:
        return np.sort(key << bits | np.arange(len(key))) & ((1 << bits) - 1), key
    return np.argsort(key, kind="stable"), key


def _ranks(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    order, key = _order(high, low)
    ranks = np.empty(len(key), np.int64)
    ordered = key[order]
    ranks[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
    return ranks


def transform(text: np.ndarray) -> np.ndarray:
    """The id before each suffix, suffixes ordered by their first five ids; the text is a ring."""
    two = _ranks(text, np.roll(text, -1))
    four = _ranks(two, np.roll(two, -2))
    order, _ = _order(four, np.roll(text, -4))
    return text[order - 1]


class ShardIndex:
    """Interval pairs over a shard: rows (place in the one order, place in the other, size)."""

    def __init__(self, before: np.ndarray, after: np.ndarray, n_ids: int) -> None:
        self.n_ids = n_ids
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(before, minlength=n_ids))])
        self.sides = (self._side(before), self._side(after))

    @staticmethod
    def _side(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        places = np.sort(symbols.astype(np.int64) << 32 | np.arange(len(symbols)))
        return symbols, places, np.concatenate([[0], np.cumsum(symbols != END)])

    def words(self) -> np.ndarray:
        """The interval pairs of all words, by id from 1."""
        first = self.starts[1:-1]
        return np.stack([first, first, np.diff(self.starts)[1:]], axis=1)

    def neighbours(self, pairs: np.ndarray, side: int) -> np.ndarray:
        """How often each phrase has a word of its piece on a side (0: before it, 1: behind it)."""
        sums = self.sides[side][2]
        return sums[pairs[:, side] + pairs[:, 2]] - sums[pairs[:, side]]

    def extend(self, pairs: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which phrase, word, new pair) for each word that stands on a side of each phrase."""
        symbols, places, _ = self.sides[side]
        owner = np.repeat(np.arange(len(pairs)), pairs[:, 2])
        at = np.arange(len(owner)) + np.repeat(pairs[:, side] - (np.cumsum(pairs[:, 2]) - pairs[:, 2]), pairs[:, 2])
        keys = np.sort(owner * self.n_ids + symbols[at])
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
        size = np.diff(np.append(new, len(keys)))
        owner, word = np.divmod(keys[new], self.n_ids)
        # The words of a phrase's interval are sorted, so the words before one are the rows before it.
        first = np.searchsorted(owner, np.arange(len(pairs)))
        offset = new - new[first[owner]] if len(new) else new
        # The word's own interval begins with the places whose phrase comes earlier in the order.
        moved = np.searchsorted(places, word << 32 | pairs[owner, side]) if len(new) else new
        grown = np.empty((len(new), 3), np.int64)
        # Places are sorted by word, so the place in the list is the place in the order.
        grown[:, side] = moved
        grown[:, 1 - side] = pairs[owner, 1 - side] + offset
        grown[:, 2] = size
        inside = word != END
        return owner[inside], word[inside], grown[inside]


SHARD = "lang string, shard long, n long, words binary, before binary, after binary"
COUNTED = "value long, shard long, f long, before long, after long"
SPELT = "value long, lang string, phrase string"


def build_shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Index shards: the number of words, the different ones in order of their ids, and both transforms."""
    names = [part.split()[0] for part in SHARD.split(", ")]

    def close(lang: str, texts: list[bytes], number: int) -> pa.RecordBatch:
        words, ids = word_ids(texts)
        kind = _kind(len(words) + 1)
        before, after = transform(ids).astype(kind), transform(ids[::-1]).astype(kind)
        return pa.RecordBatch.from_arrays([
            pa.array([lang], pa.string()), pa.array([number], pa.int64()), pa.array([np.count_nonzero(ids)], pa.int64()),
            *(pa.array([value], pa.binary()) for value in (b"\n".join(words), before.tobytes(), after.tobytes())),
        ], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        sizes: Counter[str] = Counter()
        numbers = count(TaskContext.get().partitionId() << 32)
        for part in (batch.slice(at, SLICE) for batch in batches for at in range(0, batch.num_rows, SLICE)):
            for lang, text in zip(column_of(part, "lang").to_pylist(), texts_of(part)):
                held.setdefault(lang, []).append(text)
                sizes[lang] += len(text) + 1
                # The longest goes as well where many languages are open.
                full = lang if sizes[lang] >= shard_bytes else max(sizes, key=sizes.get) if sizes.total() >= 8 * shard_bytes else None
                if full is not None:
                    yield close(full, held.pop(full), next(numbers))
                    del sizes[full]
        for lang, texts in held.items():
            yield close(lang, texts, next(numbers))

    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    ).mapInArrow(run, SHARD)


def _kind(n_ids: int) -> type:
    return np.uint16 if n_ids <= 1 << 16 else np.int32


@dataclass
class Shard:
    """A shard as it is read back."""

    lang: str
    number: int
    words: list[bytes]
    codes: np.ndarray
    index: ShardIndex


def _shards_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    for batch in batches:
        for row in range(batch.num_rows):
            lang, number, _, words, before, after = (batch.column(i)[row].as_py() for i in range(6))
            words = words.split(b"\n") if words else []
            codes = np.concatenate([[np.uint64(0)], np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))])
            sides = [np.frombuffer(side, _kind(len(codes))) for side in (before, after)]
            yield Shard(lang, number, words, codes, ShardIndex(*sides, len(codes)))


def _phrase_hashes(shard: Shard, phrases: np.ndarray) -> np.ndarray:
    value = np.full(len(phrases), xxhash.xxh64_intdigest(shard.lang), np.uint64)
    for word in phrases.T:
        value = mix(value * _K + shard.codes[word])
    return value


def list_phrases(shard: Shard, held: list[np.ndarray | None], longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(word ids, hashes, interval pairs) of a shard's phrases of 1, 2, ... words.

    Filter k of ``held``, if there is one, says which phrases of k words may be frequent. Phrases pass that of their
    own length, or else of as many of their first words as there is one for; so do all their parts.
    """
    phrases, pairs = np.arange(1, len(shard.codes))[:, None], shard.index.words()
    for n in range(1, longest + 1):
        if n > 1:
            owner, word, pairs = shard.index.extend(pairs, 0)
            phrases = np.concatenate([word[:, None], phrases[owner]], axis=1)
        values = _phrase_hashes(shard, phrases)
        if held:
            first = values if n <= len(held) else _phrase_hashes(shard, phrases[:, : len(held)])
            wanted = held[min(n, len(held)) - 1]
            if wanted is not None:
                pick = in_filter(wanted, first)
                phrases, values, pairs = phrases[pick], values[pick], pairs[pick]
        if not len(phrases):
            return
        yield phrases, values, pairs


def _frequent(shards: DataFrame, held: list[np.ndarray | None], longest: int, least: int) -> DataFrame:
    """Hashes and counts of frequent phrases longer than there are filters, and the least shard that has them."""
    names = [part.split()[0] for part in COUNTED.split(", ")]
    shared = shards.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards_of(batches):
            for _, values, pairs in islice(list_phrases(shard, shared.value, longest), len(shared.value), None):
                yield pa.RecordBatch.from_arrays([
                    as_long(values), pa.array(np.full(len(values), shard.number)), pa.array(pairs[:, 2]),
                    *(pa.array(shard.index.neighbours(pairs, side)) for side in (0, 1)),
                ], names)

    counts = shards.mapInArrow(run, COUNTED).groupBy("value").agg(
        F.min("shard").alias("shard"), *[F.sum(name).alias(name) for name in names[2:]]
    )
    return settle(counts.where(F.col("f") >= least), "phrase-counts")


def _spelt(shards: DataFrame, held: list[np.ndarray | None], longest: int, frequent: DataFrame) -> DataFrame:
    """The texts of frequent phrases, each from the shard named for it."""
    names = [part.split()[0] for part in SPELT.split(", ")]
    named = hash_filter(frequent.select(F.xxhash64("shard", "value").alias("value")), FILTER_BITS)
    shared = shards.sparkSession.sparkContext.broadcast((held, named))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, named = shared.value
        for shard in _shards_of(batches):
            seed = int(spark_hash(np.array([shard.number]))[0])
            vocabulary = pa.array([b"", *shard.words], pa.binary())
            for phrases, values, _ in list_phrases(shard, held, longest):
                pick = in_filter(named, spark_hash(values, seed))
                text = pc.binary_join_element_wise(*(vocabulary.take(pa.array(word)) for word in phrases[pick].T), b" ")
                yield pa.RecordBatch.from_arrays(
                    [as_long(values[pick]), pa.array([shard.lang] * len(text), pa.string()), text.cast(pa.string())], names
                )

    # A filter may let several shards spell a phrase.
    return shards.mapInArrow(run, SPELT).groupBy("value").agg(F.min("lang").alias("lang"), F.min("phrase").alias("phrase"))


def frequent_phrases(
    docs: DataFrame, least: int = LEAST_COUNT, longest: int = LONGEST, shard_bytes: int = SHARD_BYTES
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f, before, after) of all phrases that occur often enough, and (lang, n) of all words."""
    spark = docs.sparkSession
    path = f"{scratch_dir(spark, 'phrase-shards')}/table"
    build_shards(docs, shard_bytes).write.option("maxRecordsPerFile", SHARDS_PER_FILE).parquet(path)
    shards = spark.read.schema(SHARD).parquet(path)
    totals = shards.groupBy("lang").agg(F.sum("n").alias("n"))

    def bitmap(counts: DataFrame) -> np.ndarray:
        return hash_filter(counts.select("value"), FILTER_BITS)

    # A word of a frequent pair is frequent itself, so words need no filter of their own.
    frequent = _frequent(shards, [], min(2, longest), least)
    pairs = bitmap(frequent)
    held = [None, pairs]
    if longest > 2:
        longer = _frequent(shards, held, longest, least)
        held += [bitmap(longer)] * (longest - 2)
        frequent = frequent.unionByName(longer)
    # Here words are wanted too, those of the first filter.
    spelt = _spelt(shards, [pairs, *held[1:]], longest, frequent)
    found = settle(spelt.join(frequent, "value").select("lang", "phrase", "f", "before", "after"), "phrases")
    return found, totals


def _part(first: Column | int, size: Column) -> Column:
    return F.array_join(F.slice("words", first, size), " ")


def collocations(docs: DataFrame, least: int = LEAST_COUNT, longest: int = LONGEST, top: int = TOP, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Each language's best phrases by how much likelier they are than their weakest cut into two parts.

    A phrase goes where a longer one that contains it is as frequent; such a longer one may be taken to
    be one word longer, since what lies between has the same count.
    """
    found, totals = frequent_phrases(docs, least, longest, shard_bytes)
    counts = found.select("lang", "phrase", "f")
    words = F.split("phrase", " ")
    phrases = found.select("*", words.alias("words"), F.size(words).alias("n_words")).where("n_words > 1")

    size = F.size("words") - 1
    inside = (
        phrases.where("n_words > 2")
        .select("lang", F.explode(F.array(_part(1, size), _part(2, size))).alias("phrase"), F.col("f").alias("longer"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    )
    kept = phrases.join(inside, ["lang", "phrase"], "left").where("longer IS NULL OR longer < f").drop("longer")

    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k")).select(
        "lang", "phrase", "f", "before", "after", "k",
        _part(1, F.col("k")).alias("first"), _part(F.col("k") + 1, F.col("n_words") - F.col("k")).alias("rest"),
    )
    score = F.expr(
        "(cast(1000 as decimal(38,0)) * cast(f as decimal(19,0)) * cast(n as decimal(19,0)))"
        " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    )
    scored = (
        cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
        .join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
        .join(totals, "lang")
        .groupBy("lang", "phrase", F.col("f").alias("a"), "n", "before", "after")
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", "before", "after")
    )
    # A language may have any number of phrases: each of its parts gives up all but its best first.
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    best = scored.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= top).drop("rank")
    return (
        best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
        .where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "before", "after")
    )
