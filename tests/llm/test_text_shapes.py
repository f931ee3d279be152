"""Fill-in-middle, substring dedup and phrase collocations against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import fill_middle, phrase_index, suffix_trees

DOCUMENTS = "doc_id long, text string, lang string"


# Fill-in-middle

def cut(doc_id, text):
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(text), "plain", None, None, text
    if h4 % 100 < 20:
        return len(text), "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return len(text), "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_cuts_equal_cuts_of_decoded_text():
    rng = random.Random(1)
    for _ in range(400):
        texts = ["".join(rng.choice("aé漢🙂<PSM>\n ") for _ in range(rng.choice((0, 1, 7, 8, 9, 30)))) for _ in range(rng.randint(1, 6))]
        ids = [rng.choice((None, rng.randint(-5, 10**6))) for _ in texts]
        got = fill_middle.rearrange(ids, [text.encode() for text in texts], 90, 20, 1)
        for doc_id, text, row in zip(ids, texts, got, strict=True):
            assert (*row[:4], row[4].decode()) == cut(doc_id, text)


def test_units_are_counted_and_found_at_every_byte():
    text = "aé漢🙂" * 9 + "x"
    data = text.encode()
    index = fill_middle.UnitIndex(data)
    ends = np.cumsum([len(c.encode()) for c in text])
    assert index.end_of(np.arange(len(text))).tolist() == ends.tolist()
    offsets = np.arange(len(data) + 1)
    assert index.units_before(offsets).tolist() == [int((ends <= o).sum()) for o in offsets]


def test_outputs_restore_their_texts(spark, messy, nothing):
    out = fill_middle.fill_in_middle(messy).withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    rows = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out.collect()]
    want = [(r.doc_id, *cut(r.doc_id, r.text or "")) for r in messy.collect()]
    assert Counter(rows) == Counter(want)
    assert Counter(r.back for r in out.collect()) == Counter(r.text or "" for r in messy.collect())
    assert fill_middle.round_trip(nothing).count() == 0


# Substring dedup

def kept_words(rows):
    """(doc_id, words, words that stay) of each row; a missing id is the smallest."""
    rank = lambda doc_id: -1 if doc_id is None else doc_id
    texts = [(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for doc_id, text in rows]
    least = {}
    for doc_id, words in texts:
        for p in range(len(words) - 49):
            window = tuple(words[p : p + 50])
            least[window] = min(least.get(window, rank(doc_id)), rank(doc_id))
    out = []
    for doc_id, words in texts:
        gone = set()
        for p in range(len(words) - 49):
            if least[tuple(words[p : p + 50])] < rank(doc_id):
                gone.update(range(p, p + 50))
        out.append((doc_id, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return Counter(out)


def planted(seed=3):
    rng = random.Random(seed)
    draw = lambda n, size=400: [f"w{rng.randrange(size)}" for _ in range(n)]
    passages = [draw(n) for n in (49, 50, 51, 60, 90, 200)]
    rows = []
    for doc_id in range(60):
        words = draw(rng.randrange(0, 80))
        for passage in rng.sample(passages, rng.randrange(0, 3)):
            start = rng.randrange(0, 5)
            words += passage[start:] + draw(rng.randrange(0, 30))
        rows.append((doc_id, " \n".join(words)))
    periodic = ["a", "b"] * 60
    rows += [(70, " ".join(periodic)), (71, " ".join(periodic[1:])), (72, " ".join(["z"] * 130)), (73, " ".join(["z"] * 51))]
    rows += [rows[5], rows[7], (None, rows[9][1]), (3, rows[20][1])]
    return rows


@pytest.mark.parametrize("hot", [suffix_trees.HOT, 0, 3])
def test_repeats_equal_all_windows(spark, hot):
    rows = planted()
    got = suffix_trees.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), hot)
    assert Counter(tuple(r) for r in got.collect()) == kept_words(rows)


def test_trees_are_cut_between_runs_only(spark, monkeypatch):
    rows = planted(4)
    monkeypatch.setattr(suffix_trees, "TREE_WORDS", 100)
    monkeypatch.setattr(suffix_trees, "CHUNK_BYTES", 500)
    got = suffix_trees.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == kept_words(rows)


def test_a_full_filter_costs_no_result(spark, monkeypatch):
    rows = planted(5)
    monkeypatch.setattr(suffix_trees, "FILTER_BITS", 64)
    got = suffix_trees.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == kept_words(rows)


def test_repeats_of_odd_rows(spark, messy, nothing):
    got = suffix_trees.remove_repeats(messy)
    assert Counter(tuple(r) for r in got.collect()) == kept_words([(r.doc_id, r.text) for r in messy.collect()])
    assert suffix_trees.digests(nothing).count() == 0


def test_least_runs_are_the_leftmost():
    rng = np.random.default_rng(5)
    for size in (1, 2, 3, 41):
        hashes = rng.integers(0, 6, 200).astype(np.uint64)
        want = [i + int(np.argmin(hashes[i : i + size])) for i in range(len(hashes) - size + 1)]
        assert suffix_trees.least_runs(hashes, size).tolist() == want


# Phrase collocations

def pieces(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered)]


def ranked(rows, least, longest, top):
    counts, sides, totals = Counter(), Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    key = lang, tuple(words[i : i + n])
                    counts[key] += 1
                    sides[key, 0] += i > 0
                    sides[key, 1] += i + n < len(words)
    candidates = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}

    def inside(lang, short, long):
        return len(long) > len(short) and any(long[i : i + len(short)] == short for i in range(len(long) - len(short) + 1))

    out = {}
    for (lang, phrase), a in candidates.items():
        if any(l == lang and f >= a and inside(lang, phrase, other) for (l, other), f in candidates.items()):
            continue
        cuts = []
        for k in range(1, len(phrase)):
            l, r = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
            cuts.append((1000 * a * totals[lang] // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        key = lang, phrase
        out.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), l, r, sides[key, 0], sides[key, 1]))
    return {
        (lang, rank, phrase.decode(), -a, l, r, totals[lang], -score, before, after)
        for lang, found in out.items()
        for rank, (score, a, phrase, l, r, before, after) in enumerate(sorted(found)[:top], 1)
    }


@pytest.mark.parametrize("shard_bytes", [phrase_index.SHARD_BYTES, 150])
def test_phrases_equal_all_windows(spark, shard_bytes):
    rng = random.Random(8)
    rows = []
    for _ in range(80):
        words = [rng.choice("abcdeÉ") if rng.random() < 0.7 else "the Quick brown fox jumps" for _ in range(rng.randrange(0, 30))]
        rows.append((rng.choice(("x", "y", None)), "".join(word + rng.choice((" ", " ", "\t ", ", ", "\n", ".")) for word in words)))
    rows += rows[:5] + [("z", None), ("z", ""), (None, None)]
    frame = spark.createDataFrame([(i, text, lang) for i, (lang, text) in enumerate(rows)], DOCUMENTS)
    got = phrase_index.collocations(frame, least=4, longest=4, top=25, shard_bytes=shard_bytes)
    assert {tuple(r) for r in got.collect()} == ranked(rows, 4, 4, 25)


def test_a_full_filter_adds_no_phrase(spark, monkeypatch):
    monkeypatch.setattr(phrase_index, "FILTER_BITS", 64)
    rows = [("x", "a b a b c d"), ("x", "a b c, d a b"), ("y", "a b a b")] * 3
    frame = spark.createDataFrame([(i, text, lang) for i, (lang, text) in enumerate(rows)], DOCUMENTS)
    got = phrase_index.collocations(frame, least=6, longest=3, top=9)
    assert {tuple(r) for r in got.collect()} == ranked(rows, 6, 3, 9)


def test_phrases_of_odd_rows(spark, messy, nothing):
    got = phrase_index.collocations(messy, least=3)
    assert {tuple(r) for r in got.collect()} == ranked([(r.lang, r.text) for r in messy.collect()], 3, 5, 2000)
    assert phrase_index.collocations(nothing).count() == 0


def test_intervals_extend_alike_on_both_sides():
    """Every phrase is found with its count whichever way it is grown, and both its intervals are its places."""
    rng = np.random.default_rng(9)
    text = rng.integers(0, 5, 300).astype(np.int32)
    text[0] = phrase_index.END
    index = phrase_index.ShardIndex(phrase_index.transform(text), phrase_index.transform(text[::-1]), 5)
    ring = np.concatenate([text, text])
    start = np.arange(1, 5)[:, None]
    for sides in ((0, 0, 0, 0), (1, 1, 1, 1), (0, 1, 1, 0), (1, 0, 0, 1)):
        phrases, pairs = start, index.words()
        for side in sides:
            owner, word, pairs = index.extend(pairs, side)
            parts = [word[:, None], phrases[owner]]
            phrases = np.concatenate(parts if side == 0 else parts[::-1], axis=1)
            n = phrases.shape[1]
            want = Counter(tuple(ring[i : i + n].tolist()) for i in range(len(text)) if (ring[i : i + n] > 0).all())
            assert {tuple(p): s for p, s in zip(phrases.tolist(), pairs[:, 2].tolist())} == want
            for side_of, at in ((0, -1), (1, n)):
                near = Counter()
                for i in range(len(text)):
                    near[tuple(ring[i : i + n].tolist())] += int(ring[(i + at) % len(text)] > 0)
                got = index.neighbours(pairs, side_of)
                assert got.tolist() == [near[tuple(p)] for p in phrases.tolist()]
