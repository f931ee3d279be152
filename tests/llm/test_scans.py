"""Operators that work document by document, against plain Python."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import cache
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyledger.llm import license_scan, line_chunks, quality_outliers, token_files
from skyledger.llm.common import TokenCodes
from skyledger.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_license(text):
    words = LICENSE_WORD.findall(lower(text or ""))
    places, labels = [], set()
    for phrase, label in license_scan.BASE_PHRASES.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_base_equals_plain_search(spark, documents, messy):
    for docs in (documents, messy):
        want = Counter((r.doc_id, *plain_license(r.text)) for r in docs.select("doc_id", "text").collect())
        rows = license_scan.scan_licenses(docs).collect()
        assert want == Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows)
        assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in rows)


def test_license_phrases_and_tags(spark):
    texts = [
        "MIT License. mit-license MIT\nLICENSE", "// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0",
        "# SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 */", "SPDX-License-Identifier: MIT AND (", "permit licensee",
    ]
    rows = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert (rows[0].n_base, rows[0].first_word, rows[0].last_word, rows[0].labels) == (3, 0, 4, "mit")
    assert (rows[1].expressions, rows[1].grade, rows[1].labels) == ("((MIT OR GPL-2.0-only) AND Apache-2.0)", "permissive", "apache-2.0,gpl-2.0-only,mit")
    assert (rows[2].expressions, rows[2].grade) == ("GPL-2.0-only WITH Classpath-exception-2.0", "weak copyleft")
    assert (rows[3].n_tags, rows[3].n_bad_tags, rows[3].labels, rows[3].score) == (1, 1, "", 0.0)
    assert (rows[4].n_base, rows[4].labels) == (0, "")


@pytest.mark.parametrize("text, postfix", [
    ("a or b and c with d", ["a", "b", "c", "d", "with", "and", "or"]), ("(a or b) and c", ["a", "b", "or", "c", "and"]), ("a", ["a"]),
])
def test_precedence(text, postfix):
    assert license_scan.to_postfix(text) == postfix


@pytest.mark.parametrize("text", ["", "and", "a and", "(a", "a)", "a b", "a or or b", "()"])
def test_malformed_expressions(text):
    with pytest.raises(license_scan.BadExpression):
        license_scan.to_postfix(text)


def plain_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts, covered = Counter(runs), set()
    for i, run in enumerate(runs):
        if counts[run] > 1:
            covered.update(range(i, i + 5))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_rules(documents, messy, nothing):
    for docs in (documents, messy):
        rows = quality_outliers.judge_documents(docs).collect()
        want = Counter((r.doc_id, *plain_statistics(r.text)) for r in docs.select("doc_id", "text").collect())
        assert want == Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
        for r in rows:
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert not (r.base_failed and r.kept)
    assert quality_outliers.judge_documents(nothing).count() == 0 and quality_outliers.keep_documents(nothing).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab #|\n\t\x0b\x1c\x85é", max_size=60))
def test_statistics_of_odd_texts(text):
    assert quality_outliers.statistics(text.encode(), TokenCodes()) == plain_statistics(text)


def plain_mcd(rows, steps):
    """The concentration steps of one group, in numpy."""
    x = np.array(rows)
    floors = np.diag(np.square(quality_outliers.FLOORS))

    def middle(values):
        ordered = np.sort(values, axis=0)
        return ordered[(len(ordered) + 1) // 2 - 1]

    centre = middle(x)
    spread = 1.4826 * middle(np.abs(x - centre))
    inverse = np.diag(1 / np.maximum(spread**2, np.square(quality_outliers.FLOORS)))

    def distances():
        d = np.maximum(np.einsum("ij,jk,ik->i", x - centre, inverse, x - centre), 0)
        return d, np.floor(np.log2(d + 1e-6) * quality_outliers.RESOLUTION).astype(int)

    for _ in range(steps):
        _, step = distances()
        half = x[step <= np.sort(step)[(len(step) + 1) // 2 - 1]]
        centre = half.mean(0)
        inverse = np.linalg.inv(half.T @ half / len(half) - np.outer(centre, centre) + floors)
    d, step = distances()
    cut = np.sort(step)[(len(step) + 1) // 2 - 1]
    return d / max(1.0, 2 ** ((cut + 1) / quality_outliers.RESOLUTION) / 4.351)


def test_outlier_distances_equal_the_estimate_in_numpy(spark):
    rng = np.random.default_rng(4)
    vocabulary = ["".join(rng.choice(list("abcdefg"), rng.integers(2, 9))) for _ in range(400)]
    rows = [(i, " ".join(rng.choice(vocabulary, rng.integers(20, 300))), "en", "s") for i in range(300)]
    rows += [(900 + i, " ".join(w + "###" for w in rng.choice(vocabulary, 60)), "en", "s") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_outliers.judge_documents(docs).collect()}
    features = {}
    for i, text, *_ in rows:
        n, chars, symbols, lines, repeats = plain_statistics(text)
        features[i] = (np.log1p(n), np.log1p(chars / n), (symbols / n) ** 0.5, (lines / n) ** 0.5, (repeats / n) ** 0.5)
    want = dict(zip(features, plain_mcd(list(features.values()), quality_outliers.STEPS)))
    assert all(abs(got[i].distance - want[i]) < 1e-4 * max(1, want[i]) for i in want)
    assert {i for i, r in got.items() if not r.kept} == set(range(900, 912))
    kept = quality_outliers.keep_documents(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.select("doc_id").collect()} == set(range(300))


def plain_dedup(rows):
    """Of runs of repeated lines, joined where neighbours stand together elsewhere too, those of 20 words count;
    in them a line goes if it stands at an earlier place of such a run, with neighbours that go, 20 words or more."""
    texts = {i: [line for line in text.split("\n") if line.split()] for i, text in rows}
    singles = Counter(line for lines in texts.values() for line in lines)
    pairs = Counter(pair for lines in texts.values() for pair in zip(lines, lines[1:]))

    def runs_of(lines, places):
        runs = []
        for k in places:
            if runs and runs[-1][-1] == k - 1 and pairs[lines[k - 1], lines[k]] > 1:
                runs[-1].append(k)
            else:
                runs.append([k])
        return {k for run in runs if sum(len(lines[k].split()) for k in run) >= 20 for k in run}

    first, result = set(), {}
    for i in sorted(texts):
        lines, later = texts[i], []
        for k in sorted(runs_of(lines, [k for k, line in enumerate(lines) if singles[line] > 1])):
            if lines[k] in first:
                later.append(k)
            first.add(lines[k])
        gone = runs_of(lines, later)
        result[i] = [line for k, line in enumerate(lines) if k not in gone], len(gone)
    return result


def dedup_result(frame):
    return {
        r.doc_id: ([line for line in r.text.split("\n") if line.split()], r.n_removed_lines)
        for r in line_chunks.dedup_lines(frame).collect()
    }


def test_line_dedup_equals_plain_removal(spark, documents):
    rows = [(r.doc_id, r.text or "") for r in documents.collect()]
    got = dedup_result(documents)
    assert got == plain_dedup(rows) and any(n for _, n in got.values())
    # Few different lines, so that passages overlap, nest and repeat within a document.
    rng = np.random.default_rng(6)
    vocabulary = [" ".join(f"w{k}" for k in range(n)) for n in (0, 1, 3, 4, 7, 12, 19, 20, 21, 30)]
    rows = [(i, "\n".join(f"{rng.choice(vocabulary)}" for _ in range(rng.integers(1, 12)))) for i in range(60)]
    rows += [(100 + i, "\n".join(f"{rng.choice(vocabulary)} {rng.integers(0, 40)}" for _ in range(40))) for i in range(60)]
    got = dedup_result(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == plain_dedup(rows) and any(n for _, n in got.values())


def test_line_dedup_finds_planted_passages_of_any_shape(spark):
    rng = np.random.default_rng(5)

    def lines(n, size):
        return [" ".join(f"v{w}" for w in rng.integers(0, 5000, size)) for _ in range(n)]

    rows, want = [], {}
    for shape in ((20, 4), (10, 6), (6, 9), (4, 15), (3, 20), (2, 30), (10, 12), (1, 49), (1, 50), (50, 1)):
        for _ in range(40):
            passage, i = lines(*shape), len(rows)
            for k in range(2):
                # Neighbours are new, blank, or one line that stands everywhere.
                before, after = ([lines(2, 9), ["", *lines(1, 5)], ["share this page"]][rng.integers(3)] for _ in range(2))
                rows.append((i + k, "\n".join(before + passage + after + lines(1, 8))))
            want[i + 1] = passage
    got = {r.doc_id: r for r in line_chunks.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    for i, text in texts.items():
        kept = got[i].text.split("\n")
        # First places stay whole; of later ones the passage goes, with no more than the line that stands everywhere.
        left = [line for line in text.split("\n") if line not in want.get(i, ())]
        if i not in want:
            assert got[i].text == text
        else:
            assert not set(kept) & set(want[i]) and {x for x in left if x.split()} - {"share this page"} <= set(kept)


def test_line_dedup_finds_shifted_passages(spark, messy, nothing):
    passage = "\n".join(f"line {k} of a passage that is repeated in several places of the corpus" for k in range(30))
    long_line = " ".join(f"w{k}" for k in range(60))
    rows = [(1, f"first\n{passage}\nend"), (2, f"a\nb\nc\n{passage}"), (3, f"x\n{long_line}\ny"), (4, f"{long_line}"), (5, "short\nlines\nhere")]
    got = {r.doc_id: r for r in line_chunks.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].n_removed_chunks == got[3].n_removed_chunks == got[5].n_removed_chunks == 0
    assert got[2].n_removed_lines >= 20 and got[2].text.startswith("a\nb") and got[4].text == ""
    assert line_chunks.dedup_lines(messy).count() == messy.count() and line_chunks.dedup_lines(nothing).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=70))
def test_rank_codes_round_trip(values):
    control, data = token_files.encode_ranks(np.array(values, np.uint32))
    back = token_files.decode_ranks(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(values))
    assert back.tolist() == values


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab Zé×÷ßñ\n\t.,!?'s1<|>\u00a0\u0085\u2003\u3000漢я🙂\x1c\x7f", max_size=25) | st.just("x<|endoftext|> y.\nz"), max_size=6))
def test_pieces_give_the_ids_of_whole_texts(texts):
    pieces = _pieces()
    counts, tokens = pieces.encode(pa.array(["", *texts], pa.string())[1:])
    want = [pieces.tokenizer.encode(text, add_special_tokens=False).ids + [0] for text in texts]
    assert counts.tolist() == [len(ids) for ids in want]
    assert tokens.tolist() == [i for ids in want for i in ids]


def test_words_are_encoded_once_beside_marks_and_line_ends():
    words = ["".join(pair) for pair in product("abcde", "fghij")]
    text = " ".join(f"{a}.\n{b}, {a}" for a in words for b in words)
    pieces = _pieces()
    pieces.reset()
    pieces.encode(pa.array([text]))
    # Each word with and without a space before it, two marks, the line end, and the end id.
    assert pieces.next == 2 * len(words) + 2 + 1 + 1


def test_remembered_pieces_take_bounded_memory():
    """Half a million different words, as numbers and names give; a worker remembers fewer."""
    pieces = _pieces()
    pieces.reset()
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    held = []
    for run in range(5):
        numbers = np.arange(run * 100_000, (run + 1) * 100_000)
        words = ["".join(letters[[n // 26**i % 26 for i in range(4)]]) for n in numbers]
        counts, tokens = pieces.encode(pa.array([" ".join(words)]))
        assert counts.tolist() == [len(tokens)]
        held.append(len(pieces.places))
    assert max(held) <= 400_000


@cache
def _pieces():
    return token_files.Pieces(tokenizer_path())


def test_token_files_hold_every_id(spark, documents, messy, nothing):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    odd = [(None, "a  b"), (3, " lead"), (3, "trail "), (4, "x<|endoftext|> y  <|endoftext|>"), (5, "tab\t b\n\n c don't  1234,5!  "), (6, "é  ü　x y")]
    for docs in (documents, messy, spark.createDataFrame(odd, "doc_id long, text string")):
        want = Counter()
        for r in docs.select("doc_id", "text").collect():
            ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
            want[r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        rows = token_files.round_trip(docs, tokenizer_path()).collect()
        assert want == Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows)
        place = 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == place
            place += r.n_tokens
        ids = [r.doc_id if r.doc_id is not None else -1 for r in sorted(rows, key=lambda r: r.start)]
        assert ids == sorted(ids)
    assert token_files.round_trip(nothing, tokenizer_path()).count() == 0


def test_licenses_of_an_empty_table(nothing):
    assert license_scan.scan_licenses(nothing).count() == 0
