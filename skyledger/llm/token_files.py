"""Token-id files: frequency-ranked ids, byte-aligned variable length, control bytes apart.

A file is a sequence of blocks of whole documents. In a block the distinct ids are ranked by how often they
occur there, and each token is stored as its rank in one to four bytes. The lengths, two bits each, four to
a control byte, lie in front of the data bytes, so decoding is a table lookup per control byte, a running
sum for the places, and gathers. Layout (little-endian):

    "RANKVB01", documents, tokens, ranks, data bytes (four 64-bit numbers)
    document ids (64-bit), validity of the ids (1 byte each), tokens per document (64-bit)
    id of each rank (32-bit), control bytes, data bytes

Documents are ordered over all files by id, missing ids first, then by a hash of the text; a range shuffle
deals them, so equal ids, or missing ones, may fill several files. Each task writes one file, block by
block, under a name of its attempt, and only committed names are read. Missing and empty texts are only
the end id. Repeated rows are written each. An empty table gives no files and an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import column_of, ids_and_texts, open_shared, publish_file, scratch_dir, settle, text_runs

MAGIC = b"RANKVB01"
END_ID = 0
BLOCK_TOKENS = 1 << 20
#: Remembered pieces; only time depends on it.
PIECES = 400_000
#: How byte-level vocabularies write a space.
_SPACE = "\u0120"


def _byte_level(character: str) -> str:
    """How byte-level vocabularies write a character: its UTF-8 bytes, those that do not print from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return "".join(chr(byte if byte in shown else 256 + hidden.index(byte)) for byte in character.encode())


#: The space and the Latin letters beyond ASCII.
_BYTE_LEVEL = {n: _byte_level(chr(n)) for n in (32, *range(0xC0, 0x100))}

# By first byte, characters that are no white space for certain: letters and closing marks apart, 0 for all others.
_OTHER, _LETTER, _MARK = 1, 2, 3
_KINDS = np.zeros(256, np.uint8)
_KINDS[[*range(0x21, 0x7F), *range(0xC3, 0xE1), *range(0xE4, 0xF5)]] = _OTHER
_KINDS[[*range(65, 91), *range(97, 123)]] = _LETTER
_KINDS[[ord(mark) for mark in ".,;:!?"]] = _MARK

_LENGTHS = np.array([[(control >> (2 * i) & 3) + 1 for i in range(4)] for control in range(256)], np.uint8)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of 32-bit numbers."""
    ranks = ranks.astype(np.uint32)
    codes = ((ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)).astype(np.uint8)
    padded = np.zeros((len(ranks) + 3) // 4 * 4, np.uint8)
    padded[: len(ranks)] = codes
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    places = np.cumsum(codes, dtype=np.int64) + np.arange(len(ranks)) - codes
    data = np.zeros(len(ranks) + int(codes.sum(dtype=np.int64)), np.uint8)
    for byte in range(4):
        own = np.flatnonzero(codes >= byte) if byte else slice(None)
        data[places[own] + byte] = ranks[own] >> np.uint32(8 * byte) & np.uint32(255)
    return control.tobytes(), data.tobytes()


def decode_ranks(control: np.ndarray, data: np.ndarray, count: int) -> np.ndarray:
    lengths = _LENGTHS[control].ravel()[:count]
    places = np.cumsum(lengths, dtype=np.int64) - lengths
    out = data[places].astype(np.uint32)
    for byte in range(1, 4):
        own = np.flatnonzero(lengths > byte)
        if not len(own):
            break
        out[own] |= data[places[own] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return out


def encode_block(doc_ids: list[int | None], counts: np.ndarray, tokens: np.ndarray) -> bytes:
    seen = np.bincount(tokens)
    order = np.lexsort((np.arange(len(seen)), -seen))
    ids = order[: int(np.count_nonzero(seen))].astype(np.uint32)
    rank = np.zeros(len(seen), np.uint32)
    rank[ids] = np.arange(len(ids), dtype=np.uint32)
    control, data = encode_ranks(rank[tokens])
    head = np.array([len(doc_ids), len(tokens), len(ids), len(data)], np.int64)
    held = np.array([x is not None for x in doc_ids], np.uint8)
    numbers = np.array([x or 0 for x in doc_ids], np.int64)
    return b"".join([
        MAGIC, head.tobytes(), numbers.tobytes(), held.tobytes(), counts.astype(np.int64).tobytes(), ids.tobytes(), control, data
    ])


def read_blocks(source: pa.NativeFile) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(document ids, tokens per document, tokens) of each block."""
    def take(size: int, kind: type) -> np.ndarray:
        return np.frombuffer(source.read_buffer(size), kind)

    while magic := source.read(len(MAGIC)):
        if bytes(magic) != MAGIC:
            raise ValueError("not a block of token ids")
        docs, tokens, ranks, size = take(32, np.int64).tolist()
        numbers, held, counts = take(8 * docs, np.int64), take(docs, np.uint8), take(8 * docs, np.int64)
        ids = take(4 * ranks, np.uint32)
        control, data = take((tokens + 3) // 4, np.uint8), take(size, np.uint8)
        names = [int(n) if h else None for n, h in zip(numbers, held)]
        yield names, counts, ids[decode_ranks(control, data, tokens)]


class Pieces:
    """Texts to ids through pieces, which are encoded alone and remembered.

    A byte-level tokenizer cuts before a space and around a line end that stand between two other
    characters, and between a letter and a mark, whatever comes before and after: texts are cut at such places
    and at no other. Texts with the text of a special token are one piece, and so is every text where
    the tokenizer cuts in another way. A run of texts looks up each of its different pieces once.
    """

    #: What the model takes as one input: Latin letters, perhaps after a space.
    _PLAIN = re.compile(r" ?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model, cuts = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.apart = (
            isinstance(cuts, pre_tokenizers.ByteLevel) and cuts.use_regex and not cuts.add_prefix_space
            and self.tokenizer.normalizer is None
        )
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.reset()

    def reset(self) -> None:
        self.places: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.ids, self.used = np.zeros(1 << 18, np.uint32), 1
        self.ids[0], self.lengths[0], self.next = END_ID, 1, 1  # piece 0 is the end id

    def _learn(self, texts: list[str]) -> None:
        """Encodes new pieces."""
        first = self.next
        self.next += len(texts)
        self.places.update(zip(texts, range(first, self.next)))
        for name in ("starts", "lengths"):
            column = getattr(self, name)
            if self.next > len(column):
                setattr(self, name, np.resize(column, max(self.next, 2 * len(column))))
        tokenize, plain = self.model.tokenize, self._PLAIN.fullmatch
        words, ids, ends, others = [], [], [], []
        for place, text in enumerate(texts, first):
            if self.apart and plain(text) and text not in self.special:
                shown = text.replace(" ", _SPACE) if text.isascii() else text.translate(_BYTE_LEVEL)
                ids += [token.id for token in tokenize(shown)]
                words.append(place)
                ends.append(len(ids))
            else:
                others.append((place, text))
        if words:
            self._store(np.array(words), np.array(ids, np.uint32), np.diff(ends, prepend=0))
        for start in range(0, len(others), 1000):
            places, some = zip(*others[start : start + 1000])
            found = [e.ids for e in self.tokenizer.encode_batch_fast(list(some), add_special_tokens=False)]
            self._store(np.array(places), np.fromiter(chain.from_iterable(found), np.uint32), np.array([len(own) for own in found]))

    def _store(self, places: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        if self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, max(self.used + len(ids), 2 * len(self.ids)))
        self.ids[self.used : self.used + len(ids)] = ids
        self.lengths[places] = lengths
        self.starts[places] = self.used + np.cumsum(lengths) - lengths
        self.used += len(ids)

    def gather(self, places: np.ndarray) -> np.ndarray:
        lengths = self.lengths[places]
        ends = np.cumsum(lengths)
        return self.ids[np.repeat(self.starts[places] - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens per text, its end id with them, and all tokens."""
        lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(lengths)
        data = _bytes_of(texts, int(lengths.sum()))
        cut = _cuts(data) if self.apart else np.zeros(len(data), bool)
        for special in self.special if self.apart else ():
            for row in np.flatnonzero(pc.match_substring(texts, special).to_numpy(zero_copy_only=False)):
                cut[ends[row] - lengths[row] : ends[row]] = False
        cut[(ends - lengths)[lengths > 0]] = True
        first = np.flatnonzero(cut)
        bounds = np.append(first, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        different = coded.dictionary.to_pylist()
        self._learn([text for text in different if text not in self.places])
        known = np.fromiter(map(self.places.__getitem__, different), np.int64, len(different))
        # Each text's pieces, and the end id, piece 0.
        upto = np.searchsorted(first, ends)
        out = np.insert(known[coded.indices.to_numpy()], upto, 0)
        counts_from = np.concatenate(([0], upto + 1 + np.arange(len(upto))))[:-1]
        tokens = self.gather(out)
        counts = np.add.reduceat(self.lengths[out], counts_from) if len(out) else np.empty(0, np.int64)
        if self.next > PIECES or self.used > 8 * PIECES:
            self.reset()
        return counts, tokens


def _bytes_of(texts: pa.Array, size: int) -> np.ndarray:
    """The bytes of all texts, one after the other."""
    _, offsets, data = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    start = int(np.frombuffer(offsets, kind)[texts.offset]) if size else 0
    return np.frombuffer(data, np.uint8)[start : start + size] if size else np.empty(0, np.uint8)


def _cuts(data: np.ndarray) -> np.ndarray:
    """Whether a piece may begin at each byte, except for the ends of texts."""
    kind = _KINDS[data]
    # Bytes that go on with a character are what the one before is; of U+00C0 to U+00FF two are no letters.
    goes_on = data & 0xC0 == 0x80
    held, letter = kind > 0, kind == _LETTER
    for _ in range(3):
        held[1:] |= goes_on[1:] & held[:-1]
    letter[1:] |= goes_on[1:] & (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    cut = np.zeros(len(data), bool)
    between = held[:-2] & held[2:]
    cut[1:-1] = between & ((data[1:-1] == 32) | (data[1:-1] == 10))
    cut[2:] |= between & (data[1:-1] == 10)
    cut[1:] |= letter[:-1] & (kind[1:] == _MARK)
    return cut


_PIECES: dict[str, Pieces] = {}


def write_token_files(docs: DataFrame, folder: str, tokenizer: str) -> DataFrame:
    """Writes one file per range of document ids; returns (part, file, n_docs, n_tokens), settled."""
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = ids_and_texts(docs).withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _PIECES.get(tokenizer) or _PIECES.setdefault(tokenizer, Pieces(tokenizer))
        written = np.zeros(2, np.int64)

        def blocks() -> Iterator[bytes]:
            held: list[tuple[list, np.ndarray, np.ndarray]] = []
            size = 0
            for part in text_runs(batches):
                ids = column_of(part, "doc_id").to_pylist()
                counts, tokens = pieces.encode(column_of(part, "text"))
                held.append((ids, counts, tokens))
                size += len(tokens)
                written[:] += len(ids), len(tokens)
                if size >= BLOCK_TOKENS:
                    yield _block(held)
                    held, size = [], 0
            if held:
                yield _block(held)

        chunks = blocks()
        first = next(chunks, None)
        if first is not None:
            part = TaskContext.get().partitionId()
            name = publish_file(folder, f"tokens-{part:06d}", _chain(first, chunks))
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "file": [name], "n_docs": [int(written[0])], "n_tokens": [int(written[1])],
            })

    return settle(
        ordered.select("doc_id", "text").mapInArrow(run, "part int, file string, n_docs long, n_tokens long"), "token-files"
    )


def _chain(first: bytes, rest: Iterator[bytes]) -> Iterator[bytes]:
    yield first
    yield from rest


def _block(held: list[tuple[list, np.ndarray, np.ndarray]]) -> bytes:
    ids, counts, tokens = zip(*held)
    return encode_block([i for own in ids for i in own], np.concatenate(counts), np.concatenate(tokens))


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_token_files(files: DataFrame, folder: str) -> DataFrame:
    """One row per document read back: its place among all tokens, its length and the checksum of its ids."""
    # A row per file: one range of the shuffle each, so the running sum is over a short list.
    placed = files.select(
        "file", (F.sum("n_tokens").over(Window.orderBy("part")) - F.col("n_tokens")).alias("start")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(column_of(batch, "file").to_pylist(), column_of(batch, "start").to_pylist()):
                with open_shared(folder, name) as source:
                    for ids, counts, tokens in read_blocks(source):
                        data, ends = tokens.astype("<u4").tobytes(), np.cumsum(counts)
                        checks = [
                            zlib.crc32(memoryview(data)[4 * int(e - n) : 4 * int(e)]) for e, n in zip(ends, counts)
                        ]
                        yield pa.RecordBatch.from_arrays([
                            pa.array(ids, pa.int64()), pa.array(start + ends - counts), pa.array(counts),
                            pa.array(checks, pa.int64()),
                        ], ["doc_id", "start", "n_tokens", "ids_crc32"])
                        start += int(ends[-1])

    return placed.repartition(max(1, files.count())).mapInArrow(run, READ)


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Writes all documents and reads the files back."""
    folder = scratch_dir(docs.sparkSession, "token-ids")
    return read_token_files(write_token_files(docs, folder, tokenizer), folder)
