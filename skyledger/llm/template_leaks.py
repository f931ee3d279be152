"""Benchmark decontamination by template canonicalisation.

Words become a template: numbers, names (capitalised words inside a sentence) and units turn into typed
placeholders, all others into their lower-case form. Windows of eight template words of documents and
benchmark items are hash-joined. A window of an item with fewer literals than placeholders is no evidence
as a template. Every window of an item is also hashed by its written values in lower case and the signs between
them, so copies match whatever their case, and whatever that makes of names. Matching windows of one alignment
(same shift between document and item) must fill their slots consistently: one value of the item stands for one
value of the document, the one that most of its places have. Windows with a slot that disagrees, or whose value
has no such reading, do not count unless they are verbatim. An item leaked into a document if consistent windows
cover at least ``SHARE`` of its windows, or of its template windows, so re-parameterised questions are caught with
their verbatim copies.

Items of fewer than eight words are one window of their own length, which must match by its written values
if they are fewer than four. Only windows that pass a filter of fixed size, built from all items, leave the
scan; the join decides. A leak of m of an item's t windows has one of any t - m + 1 of them, so pairs of
document and item are sought by the item's rarest windows alone (rows of documents times items that have them)
and only these pairs are compared by all windows: a window that stands in very many documents and items pairs
them only where nearly all of the item is as common.

Missing texts are empty and match nothing; rows that share an id are told apart by their text; a missing
id stays missing in the result. Empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import as_long, column_of, hash_filter, ids_and_texts, in_filter, mix, settle, texts_of

WINDOW = 8
LEAST_ITEM = 4
SHARE = 0.5

#: Words that measure; a unit may be replaced by another.
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons pound pounds "
    "ounce ounces ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks "
    "month months year years dollar dollars euro euros cent cents percent degree degrees meter meters metre metres "
    "kilometer kilometers kilometre kilometres watt watts volt volts mph kmh".split()
)
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
_NUMBER = re.compile(r"[0-9][0-9.,/:]*[0-9]|[0-9]")
_EDGES = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
_SIGNS = frozenset("+-*/=<>^%×÷−")
_NONE, _LITERAL, _NUM, _UNIT, _CAPITAL = range(5)
#: Kinds of words written in lower-case letters alone, unless literals.
_PLAIN = {word.encode(): kind for words, kind in ((UNITS, _UNIT), (NUMBER_WORDS, _NUM)) for word in words}
#: Marks beside a kind.
_ENDS, _SIGNED = 8, 16
_HOLDERS = np.array([0, 0, 11, 13, 17], np.uint64)
_BASE = 0x9E3779B97F4A7C15


class TemplateWords(dict):
    """Written tokens to rows of a table: kind with marks (ends a sentence, has a sign), code of the lower-case
    form, code of the sign."""

    BOUND = 300_000

    def __init__(self) -> None:
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.kinds, self.codes, self.signs, self.filled = [], [], [], 0
        self.arrays = tuple(np.empty(4096, kind) for kind in (np.uint8, np.uint64, np.uint64))

    def __missing__(self, token: bytes) -> int:
        place = self[token] = len(self.kinds)
        if token.isalpha() and token.islower():
            # Most words: nothing to strip, to lower or to mark.
            self.kinds.append(_PLAIN.get(token, _LITERAL))
            self.codes.append(xxhash.xxh64_intdigest(token))
            self.signs.append(0)
            return place
        text = token.decode("utf-8", "replace")
        word = text.strip(_EDGES)
        lower = word.lower()
        if not word:
            kind = _NONE
        elif _NUMBER.fullmatch(word) or lower in NUMBER_WORDS:
            kind = _NUM
        elif lower in UNITS:
            kind = _UNIT
        else:
            kind = _CAPITAL if len(word) > 1 and word[0].isupper() and word[1:].islower() else _LITERAL
        self.codes.append(xxhash.xxh64_intdigest(lower.encode()))
        sign = text if not word and set(text) <= _SIGNS else text[:1] if kind == _NUM and text[:1] in _SIGNS else ""
        self.signs.append(xxhash.xxh64_intdigest(sign.encode()) if sign else 0)
        ends = text.rstrip("\"')]»”")[-1:] in (".", "!", "?", ":")
        self.kinds.append(kind | (_ENDS if ends else 0) | (_SIGNED if sign else 0))
        return place

    def template(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Template codes, value codes, whether each word is a slot, and codes of the signs since the word before."""
        if len(self) > self.BOUND:
            self.reset()
        tokens = text.split()
        places = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        marked, codes, signs = self._columns()
        marked, codes = marked[places], codes[places]
        kinds, starts = marked & np.uint8(_ENDS - 1), np.ones(len(places), bool)
        starts[1:] = marked[:-1] & np.uint8(_ENDS) > 0
        kinds[(kinds == _CAPITAL) & starts] = _LITERAL
        worded = kinds != _NONE
        if (marked & np.uint8(_SIGNED)).any():
            summed = np.concatenate((np.zeros(1, np.uint64), np.cumsum(signs[places], dtype=np.uint64)))
            before = np.diff(summed[np.concatenate(([0], np.flatnonzero(worded) + 1))])
        else:
            before = np.zeros(int(worded.sum()), np.uint64)
        if not worded.all():
            kinds, codes = kinds[worded], codes[worded]
        slots = kinds > _LITERAL
        template = codes.copy()
        template[slots] = _HOLDERS[kinds[slots]]
        return template, codes, slots, before

    def _columns(self) -> tuple[np.ndarray, ...]:
        """The table as arrays, grown in place as rows are added."""
        done, now = self.filled, len(self.kinds)
        if now > len(self.arrays[0]):
            room = max(2 * len(self.arrays[0]), now)
            self.arrays = tuple(np.resize(column, room) for column in self.arrays)
        for column, rows in zip(self.arrays, (self.kinds, self.codes, self.signs)):
            column[done:now] = rows[done:now]
        self.filled = now
        return self.arrays


def runs(codes: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hashes of all runs of ``size`` codes, put together from those of their halves."""
    if size == 1:
        return codes
    left, n = size // 2, len(codes) - size + 1
    first = runs(codes, left)
    second = first if size == 2 * left else runs(codes, size - left)
    return first[:n] * np.uint64(pow(_BASE, size - left, 1 << 64)) + second[left : left + n]


def template_windows(template: np.ndarray, slots: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows, and which of them have at least as many literals as placeholders."""
    if len(template) < size:
        return np.empty(0, np.uint64), np.empty(0, bool)
    held = np.concatenate(([0], np.cumsum(slots)))
    return mix(runs(template, size)) ^ np.uint64(size), 2 * (held[size:] - held[:-size]) <= size


def written_windows(codes: np.ndarray, signs: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows by written values and the signs between them, not the sign before the first."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    if not signs.any():
        return mix(runs(codes, size)) ^ np.uint64(1024 + size)
    extra = mix(signs) * (signs > 0)
    return mix(runs(codes + extra, size) - extra[:n] * np.uint64(pow(_BASE, size - 1, 1 << 64))) ^ np.uint64(1024 + size)


WINDOWS = "id long, own long, hash long, place int, total int, templates int, written boolean, evident boolean, slots array<long>, at array<int>"


def _window_rows(rows: DataFrame, key: str, sizes: list[tuple[int, bool]] | None, wanted: np.ndarray | None) -> DataFrame:
    """Windows of every text: of the sizes given, by template or (True) as written; or, of items, of the item's
    own size up to WINDOW, as written, and by their template where that is evidence (``evident``). ``templates``
    counts these; windows as written have no slots."""
    names = [part.split()[0] for part in WINDOWS.split(", ")]
    shared = rows.sparkSession.sparkContext.broadcast(wanted) if wanted is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = TemplateWords()
        bits = shared.value if shared else None
        for batch in batches:
            out = []
            for row_id, text in zip(column_of(batch, key).to_pylist(), texts_of(batch)):
                template, codes, slots, signs = words.template(text)
                own, size = None, min(WINDOW, len(template))
                for size, written in sizes if sizes is not None else [(size, False), (size, True)] if size else []:
                    if len(template) < size:
                        continue
                    hashes, usable = template_windows(template, slots, size)
                    if size < LEAST_ITEM:
                        usable = np.zeros(len(hashes), bool)
                    total, templates, evident = len(hashes), int(usable.sum()), usable
                    if written:
                        hashes, usable = written_windows(codes, signs, size), np.ones(total, bool)
                    if bits is not None:
                        usable = usable & in_filter(bits, hashes, mixed=True)
                    found = np.flatnonzero(usable)
                    if not len(found):
                        continue
                    own = xxhash.xxh64_intdigest(text, 42) if own is None else own
                    for place in found.tolist():
                        span = slice(place, place + size)
                        values = [] if written else codes[span][slots[span]].view(np.int64).tolist()
                        at = [] if written else (place + np.flatnonzero(slots[span])).tolist()
                        out.append((row_id, own, int(hashes[place]), place, total, templates, written, bool(evident[place]), values, at))
            if out:
                ids, own, hashes, places, totals, templates, written, evident, values, at = zip(*out)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), as_long(np.array(own, np.uint64)), as_long(np.array(hashes, np.uint64)),
                    pa.array(places, pa.int32()), pa.array(totals, pa.int32()), pa.array(templates, pa.int32()),
                    pa.array(written, pa.bool_()), pa.array(evident, pa.bool_()), pa.array(values, pa.list_(pa.int64())), pa.array(at, pa.list_(pa.int32())),
                ], names)

    return ids_and_texts(rows, key).mapInArrow(run, WINDOWS)


def find_leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """One row per (document, item) that leaked: doc_id, text_hash, item_id, n_windows of the item's
    item_windows, n_slots compared, n_changed of them with another value."""
    items = settle(_window_rows(benchmark, "item_id", None, None), "leak-items")
    short = _window_rows_sizes(benchmark)
    wanted = hash_filter(items.select(F.col("hash").alias("value")).distinct(), mixed=True)
    found = settle(
        _window_rows(docs, "doc_id", short, wanted).select(F.col("id").alias("doc_id"), F.col("own").alias("text_hash"), "hash", "place", "slots"),
        "leak-found",
    )
    sought = _pairs_by_rarest(found, items, share).withColumnsRenamed({"item_id": "s_id", "item_own": "s_own", "doc_id": "s_doc", "text_hash": "s_text"})
    i = items.select(
        F.col("id").alias("item_id"), F.col("own").alias("item_own"), F.col("hash").alias("item_hash"), F.col("place").alias("item_place"),
        F.col("total").alias("item_windows"), F.col("templates").alias("item_templates"), "evident",
        F.col("slots").alias("item_slots"), "at",
    ).distinct()
    pairs = settle(
        sought.join(i, F.col("item_id").eqNullSafe(F.col("s_id")) & (F.col("item_own") == F.col("s_own")))
        .join(found, F.col("doc_id").eqNullSafe(F.col("s_doc")) & (F.col("text_hash") == F.col("s_text")) & (F.col("hash") == F.col("item_hash")))
        .where(F.size("slots") == F.size("item_slots"))
        .withColumn("shift", F.col("place") - F.col("item_place")).drop("s_id", "s_own", "s_doc", "s_text", "item_hash"),
        "leak-windows",
    )
    line = ["doc_id", "text_hash", "item_id", "item_own", "shift"]
    # A place of the item counts once, in however many windows it is.
    filled = pairs.select(*line, F.explode(F.arrays_zip("at", "item_slots", "slots")).alias("v")).select(
        *line, F.col("v.at").alias("at"), F.col("v.item_slots").alias("item_value"), F.col("v.slots").alias("value")
    ).distinct()
    values = filled.groupBy(*line, "item_value", "value").agg(F.count(F.lit(1)).alias("n"))
    # Of readings with equally many places one is the greatest and another the least: then none is the reading.
    bound = values.groupBy(*line, "item_value").agg(
        F.max(F.struct("n", "value")).alias("most"),
        F.max(F.struct(F.col("n"), F.bitwise_not("value").alias("value"))).alias("other"),
        F.max((F.col("item_value") != F.col("value")).cast("int")).alias("changed"),
    ).groupBy(*line).agg(
        # As many entries at most as the item has different values in slots.
        F.map_from_entries(F.collect_list(F.struct("item_value", F.when(
            F.col("most.value") == F.bitwise_not("other.value"), F.col("most.value")
        ).alias("reading")))).alias("readings"),
        F.count(F.lit(1)).alias("n_slots"), F.sum("changed").alias("n_changed"),
    )
    b = bound.select(*[F.col(c).alias(f"b_{c}") for c in line], "readings", "n_slots", "n_changed")
    same = F.lit(True)
    for c in line:
        same = same & F.col(c).eqNullSafe(F.col(f"b_{c}"))
    agrees = F.expr(
        "slots = item_slots OR forall(arrays_zip(item_slots, slots), v -> coalesce(readings[v.item_slots] = v.slots, false))"
    )
    consistent = settle(
        pairs.join(b, same, "left").where(agrees)
        .select(*line, "item_windows", "item_templates", "evident", "item_place", "n_slots", "n_changed").distinct(),
        "leak-consistent",
    )
    item = ["doc_id", "text_hash", "item_id", "item_own", "item_windows", "item_templates"]
    # A place of the item counts once, at however many shifts it is found; slots count once per shift.
    places = consistent.select(*item, "evident", "item_place", F.lit(0).alias("n_slots"), F.lit(0).alias("n_changed")).distinct()
    shifts = consistent.select(
        *line, "item_windows", "item_templates", F.coalesce("n_slots", F.lit(0)).alias("n_slots"), F.coalesce("n_changed", F.lit(0)).alias("n_changed")
    ).distinct().select(*item, F.lit(False).alias("evident"), F.lit(None).cast("int").alias("item_place"), "n_slots", "n_changed")
    return (
        places.unionByName(shifts).groupBy(*item).agg(
            F.count("item_place").alias("n_windows"), F.count_if("evident").alias("n_templates"),
            F.sum("n_slots").alias("n_slots"), F.sum("n_changed").alias("n_changed"),
        )
        .where(
            (F.col("n_windows") >= F.lit(share) * F.col("item_windows"))
            | ((F.col("n_templates") > 0) & (F.col("n_templates") >= F.lit(share) * F.col("item_templates")))
        )
        .select("doc_id", "text_hash", "item_id", "n_windows", F.col("item_windows").cast("long").alias("item_windows"), "n_slots", "n_changed")
    )


def _pairs_by_rarest(found: DataFrame, items: DataFrame, share: float) -> DataFrame:
    """Pairs (doc_id, text_hash, item_id, item_own) that share one of the item's rarest windows. A leak has at
    least ``need`` of the item's ``total`` windows, so one of any ``total - need + 1``."""
    cost = (
        items.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
        .join(found.groupBy("hash").agg(F.count(F.lit(1)).alias("n_docs")), "hash").select("hash", (F.col("n") * F.col("n_docs")).alias("cost"))
    )
    rank = F.row_number().over(Window.partitionBy("id", "own").orderBy("cost", "place"))
    need = F.least(
        F.ceil(F.lit(share) * F.col("total") - 1e-9),
        F.when(F.col("templates") > 0, F.ceil(F.lit(share) * F.col("templates") - 1e-9)),
    )
    kept = (
        items.join(cost, "hash", "left").groupBy("id", "own", "place", "total", "templates")
        .agg(F.sum(F.coalesce("cost", F.lit(0))).alias("cost"), F.collect_set(F.when(F.col("cost").isNotNull(), F.col("hash"))).alias("hashes"))
        .withColumn("rank", rank).where(F.col("rank") <= F.col("total") - F.greatest(need, F.lit(1)) + 1)
    )
    rarest = kept.select(F.col("id").alias("item_id"), F.col("own").alias("item_own"), F.explode("hashes").alias("hash"))
    return found.select("doc_id", "text_hash", "hash").distinct().join(rarest, "hash").drop("hash").distinct()


def _window_rows_sizes(benchmark: DataFrame) -> list[tuple[int, bool]]:
    """The window sizes that occur, as written and, where one is evidence, by template: WINDOW, and the lengths
    of shorter items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = TemplateWords()
        for batch in batches:
            sizes = set()
            for text in texts_of(batch):
                template, _, slots, _ = words.template(text)
                if size := min(WINDOW, len(template)):
                    usable = template_windows(template, slots, size)[1] & (size >= LEAST_ITEM)
                    sizes |= {(size, True)} | ({(size, False)} if usable.any() else set())
            size, written = zip(*sorted(sizes)) if sizes else ((), ())
            yield pa.RecordBatch.from_pydict({"size": pa.array(size, pa.int32()), "written": pa.array(written, pa.bool_())})

    found = ids_and_texts(benchmark, "item_id").mapInArrow(run, "size int, written boolean").distinct()
    return sorted({(row["size"], row["written"]) for row in found.collect()})


def drop_leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """The documents into which no item leaked, with their own columns."""
    gone = find_leaks(docs, benchmark, share).select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct()
    return docs.join(
        gone,
        F.col("doc_id").cast("long").eqNullSafe(F.col("gone_id"))
        & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("gone_hash")),
        "left_anti",
    )
