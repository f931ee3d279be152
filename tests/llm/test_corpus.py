"""Operators that compare documents with each other or with the corpus, against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import compare, connect
from skyledger.llm import (
    common, elias_fano, mixing, ngram_trie, order_minhash, pii_contexts, queries, template_leaks, warc_revisits,
)

SF_DIR = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_banded_alignment_equals_full_alignment():
    rng = np.random.default_rng(2)
    pairs = []
    for _ in range(300):
        a = rng.integers(0, 30, rng.integers(1, 120)).tolist()
        b = list(a)
        for _ in range(rng.integers(0, len(a) // 3 + 2)):
            at, kind = rng.integers(0, len(b) + 1), rng.random()
            if kind < 0.4 and at < len(b):
                b[at] = int(rng.integers(0, 30))
            elif kind < 0.7 or len(b) < 2:
                b.insert(at, int(rng.integers(0, 30)))
            elif at < len(b):
                b.pop(at)
        pairs.append((np.array(a, np.int32), np.array(b, np.int32)))
    for (a, b), got in zip(pairs, order_minhash.near(pairs)):
        want = 1 - edits(a.tolist(), b.tolist()) / max(len(a), len(b))
        assert abs(got - (want if want >= 0.8 - 1e-12 else -1)) < 1e-9


def labelled_runs(tokens):
    seen, out = Counter(), set()
    for i in range(max(1, len(tokens) - 4)):
        run = tuple(tokens[i : i + 5])
        seen[run] += 1
        out.add((run, seen[run]))
    return out


def test_near_duplicates_against_all_pairs(spark):
    """Every pair with similar labelled runs in one order is linked; every group hangs together by pairs
    that full alignment confirms."""
    rng = np.random.default_rng(7)
    vocabulary = [f"w{i}" for i in range(500)]
    texts = [rng.choice(vocabulary, rng.integers(5, 120)).tolist() for _ in range(60)]
    for original in texts[:25]:
        for _ in range(4):
            copy = list(original)
            for at in rng.integers(0, len(copy), max(1, len(copy) // 60)):
                copy[at] = str(rng.choice(vocabulary))
            texts.append(copy)
    texts += [texts[0], texts[0], texts[3][::-1]]
    got = {r.doc_id: r for r in order_minhash.near_duplicates(
        spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    ).collect()}
    near = {}
    for i, a in enumerate(texts):
        for j in range(i):
            b = texts[j]
            similarity = 1 - edits(a, b) / max(len(a), len(b))
            near[i, j] = similarity >= 0.8
            x, y = labelled_runs(a), labelled_runs(b)
            if similarity >= 0.8 and len(x & y) >= 0.8 * len(x | y):
                assert got[i].group_id == got[j].group_id
    for i, r in got.items():
        members = [j for j in got if got[j].group_id == r.group_id]
        assert r.group_id == min(members) and r.kept == (i == r.group_id)
        assert len(members) == 1 or any(near[max(i, j), min(i, j)] for j in members if j != i)


def test_near_duplicates_by_edit_similarity_alone(spark):
    """All pairs of edit similarity 0.8, however few runs of words they share: up to every fifth word is another."""
    rng = np.random.default_rng(11)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts, want = [], []
    for n in (5, 6, 8, 9, 10, 12, 14, 16, 20, 30, 60, 100) * 6:
        original = rng.choice(vocabulary, n).tolist()
        copy, most = list(original), n // 5
        for at in range(4, n, 5) if n % 2 else rng.choice(n, most, replace=False):
            copy[at] = "other"
        assert 1 - edits(original, copy) / n >= 0.8 - 1e-12
        want.append((len(texts), len(texts) + 1, n))
        texts += [original, copy]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.group_id for r in order_minhash.near_duplicates(frame).collect()}
    missed = [n for a, b, n in want if got[a] != got[b]]
    assert len(missed) <= 1 and min(missed, default=99) > order_minhash.SHORT


def test_short_near_duplicates_always_have_a_common_key():
    rng = np.random.default_rng(12)
    found = 0
    for _ in range(4000):
        a = rng.integers(0, 40, rng.integers(1, 15)).tolist()
        b = list(a)
        for _ in range(rng.integers(1, 3)):
            at, kind = int(rng.integers(0, len(b) + 1)), rng.integers(0, 3)
            b[at : at + min(kind, 1)] = [] if kind == 2 else [int(rng.integers(0, 40))]
        if 0 < len(b) <= 14 and edits(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9:
            x, y = (order_minhash.short_keys(np.array(own, np.uint64)) for own in (a, b))
            found += 1
            assert np.isin(x, y).any()
    assert found > 500


def test_near_duplicates_of_odd_rows(messy, nothing):
    rows = order_minhash.near_duplicates(messy).collect()
    assert len(rows) == messy.count() and all(r.kept and r.group_id is None for r in rows if r.doc_id is None)
    assert {r.group_id for r in rows if r.doc_id in (3, 4)} == {3}  # a missing text is an empty one
    assert order_minhash.near_duplicates(nothing).count() == 0
    assert order_minhash.keep_one(messy).columns == messy.columns


def test_texts_that_share_an_id_are_removed_alone(spark):
    rows = [(3, "a text that stands here twice"), (5, "a text that stands here twice"), (5, "one that nobody else wrote")]
    kept = order_minhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [rows[0], rows[2]]


def test_long_texts_that_share_a_passage_are_told_apart_by_their_looks(spark, monkeypatch):
    """Texts of a long common passage and ends of a few frequent words of their own: just beyond the similarity."""
    rng = np.random.default_rng(3)
    passage = [f"p{i}" for i in range(560)]
    rows = [(n, " ".join([*passage, *(f"t{n}x{i}" for i in rng.integers(0, 12, 240))])) for n in range(40)]
    rows.append((40, rows[7][1] + " and a little more"))
    pairs = []
    verified = order_minhash.verified

    def counted(frame, *args):
        pairs.append(frame.count())
        return verified(frame, *args)

    monkeypatch.setattr(order_minhash, "verified", counted)
    got = order_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.group_id) for r in got if r.doc_id != r.group_id} == {(40, 7)}
    assert pairs[1] <= 5


def test_a_pair_of_many_common_buckets_meets_once(spark):
    """Two components of one bucket, and of twenty: the join itself makes a row per pair, and every pair."""
    rng = np.random.default_rng(8)
    rows, keys_of = [], {n: sorted(rng.choice(30, 20, replace=False).tolist()) for n in range(12)}
    root_of = {n: 0 if n < 4 else n - n % 2 for n in keys_of}
    for n, keys in keys_of.items():
        look = (100, 0, 0, 0, 0)
        rows += [(key, n, root_of[n], n >= 4, 30 if n >= 4 else 0, 25 if n < 4 else None, look, None, keys) for key in keys]
    look_type = "struct<words int, odd0 long, odd1 long, odd2 long, odd3 long>"
    placed = spark.createDataFrame(
        rows, f"key long, node long, root long, apart boolean, least int, edits int, look {look_type}, "
        "fine struct<words int, fine array<long>, coarse array<long>>, keys array<long>"
    )
    got = sorted(tuple(sorted((r.x, r.y))) for r in order_minhash.meetings(placed).collect())
    want = [(a, b) for a in keys_of for b in keys_of if a < b and root_of[a] != root_of[b] and set(keys_of[a]) & set(keys_of[b])]
    assert got == sorted(want)


def test_sketches_take_a_batch_in_runs_of_text(spark, monkeypatch):
    """Memory follows a run of texts, not the rows that Spark hands over at once; the sketches are the same."""
    class Held:
        def same(self, *args):
            return self

        select = where = withColumn = same

        def mapInArrow(self, run, schema):
            return run

    texts = [f"text {i} of a few words and {i * i} more" for i in range(9)]
    columns = [pa.array(range(9), pa.int64()), pa.array(texts), pa.array(range(9), pa.int64())]
    batch = pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "text_hash"])
    run = order_minhash.sketches(Held())
    whole = pa.Table.from_batches(run(iter([batch])))
    monkeypatch.setattr(common, "TEXT_BYTES", 100, raising=False)
    parts = list(run(iter([batch, batch.slice(0, 0)])))
    assert max(part.num_rows for part in parts) <= 3
    assert pa.Table.from_batches(parts).combine_chunks().equals(whole.combine_chunks())


def test_finer_parities_bound_the_edits(spark):
    """Never more than the edits, whatever the two lengths' classes."""
    rng = np.random.default_rng(4)
    texts, edits = [], []
    for n in (257, 300, 1010, 1024, 1030, 4100):
        words = rng.integers(0, 90, n).tolist()
        for gone in (1, 20, n // 5):
            places = set(rng.permutation(n)[:gone].tolist())
            texts += [words, [w for i, w in enumerate(words) if i not in places], [900 + w if i in places else w for i, w in enumerate(words)]]
            edits.append(gone)
    docs = spark.createDataFrame([(i, " ".join(map(str, t))) for i, t in enumerate(texts)], "doc_id long, text string")
    looks = order_minhash.sketches(docs).select("doc_id", F.struct("words", "fine", "coarse").alias("look"))
    one = looks.where("doc_id % 3 = 0").withColumnsRenamed({"doc_id": "a", "look": "x"})
    other = looks.where("doc_id % 3 > 0").withColumnsRenamed({"doc_id": "b", "look": "y"})
    found = one.join(other, F.floor(F.col("a") / 3) == F.floor(F.col("b") / 3)).select("a", order_minhash.fine_edits("x", "y").alias("least")).collect()
    assert len(found) == 2 * len(edits) and all(r.least <= edits[r.a // 3] for r in found)
    assert sum(r.least >= 0.8 * edits[r.a // 3] for r in found) >= len(found) / 2


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 20)] + [(100, 103), (103, 101), (7, 7), (50, 60), (60, 50)]
    got = {r.node: r.root for r in order_minhash.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 21)} | {101: 100, 103: 100, 60: 50}


def test_leaks_verbatim_and_with_new_values(spark, documents):
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    items = {r.item_id: words(r.text) for r in benchmark.collect()}
    want = set()
    for r in documents.collect():
        joined = f" {' '.join(words(r.text))} "
        want |= {(r.doc_id, i) for i, item in items.items() if f" {' '.join(item)} " in joined}
    got = template_leaks.find_leaks(documents, benchmark).collect()
    assert want and {(r.doc_id, r.item_id) for r in got} == want
    item = "Yesterday afternoon young Anna bought 31 apples and gave 9 pounds of them to Bob before leaving the market."
    benchmark = spark.createDataFrame([(7, item), (8, "too short"), (9, None)], "item_id long, text string")
    renamed = item.replace("Anna", "Peter").replace("31", "twelve").replace("pounds", "kg").replace("Bob", "Mary")
    mixed = "afternoon young Anna bought 31 apples and gave 31 pounds of them"
    docs = spark.createDataFrame([(1, f"Yes. {renamed} Peter went."), (2, mixed), (3, None), (None, item), (5, item.lower())], "doc_id long, text string")
    got = {r.doc_id: r for r in template_leaks.find_leaks(docs, benchmark).collect()}
    assert got[1].n_changed > 0 and got[None].n_changed == 0 and 3 not in got
    # 31 stands for both 31 and 9: the slots contradict nothing, as two values may become one.
    swap = spark.createDataFrame([(7, "the first of Ann was given to Bob and the last of Ann was kept by Bob himself")], "item_id long, text string")
    bad = spark.createDataFrame([(1, "the first of Joe was given to Tim and the last of Sue was kept by Tim himself")], "doc_id long, text string")
    assert template_leaks.find_leaks(bad, swap).count() == 0
    assert template_leaks.drop_leaks(docs, benchmark).count() == docs.count() - len(got)


def test_leaks_of_items_full_of_numbers(spark):
    items = ["What is 12 + 35 * 4 - 18 ?", "Add 12, 15, 18, 21, 24 and 27.", "Solve 8 + 5", "Anna Bob Carl Dora Emil Fritz Gerda Hans Ida Jon"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = [f"We asked the class: {item} Then it was time to go home." for item in items]
    docs += ["What is 12 * 35 * 4 - 18 ?", "Add 12, 15, 18, 21, 24 and 28.", "Solve 8 - 5", "the names were Anna Bob Carl Dora Emil Fritz Gerda Hans Ida Jon"]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in template_leaks.find_leaks(frame, benchmark).collect()}
    assert got == {(0, 0), (1, 1), (2, 2), (3, 3), (7, 3)}
    assert template_leaks.drop_leaks(frame, benchmark).count() == 3


def test_leaks_with_one_conflicting_mention(spark):
    item = (
        "when the harvest was over young Anna took the long road along the river to the old mill and asked the miller for "
        "bread and salt before the evening bells while the children of Anna waited by the gate of the farm until dark"
    )
    numbers = "a box holds 12 red balls and the other box that stands on the shelf by the door holds 12 blue balls so how many of them are there in the room"
    benchmark = spark.createDataFrame([(1, item), (2, numbers)], "item_id long, text string")
    docs = [item.replace("of Anna", "of Anne"), numbers.replace("12 red", "15 red").replace("12 blue", "18 blue")]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in template_leaks.find_leaks(frame, benchmark).collect()}
    assert set(got) == {(0, 1), (1, 2)}
    # Only the windows that hold the other name are missing.
    assert got[0, 1].n_windows == got[0, 1].item_windows - 8
    assert got[1, 2].n_windows < got[1, 2].item_windows


def test_leaks_in_other_case(spark):
    item = "On Monday the trader Anna sold fish to Bob while Carl and Dora watched Emil and Fritz repair a boat for Gustav"
    texts = [item, item.lower(), item.upper(), item.title(), item.replace("Anna", "Olga"), "Anna and Bob watched a boat on Monday while Carl slept"]
    docs = [(i, f"some words before it {text} and others after it") for i, text in enumerate(texts)]
    frame = spark.createDataFrame(docs + [(9, " ".join(["On Monday the trader Anna sold fish to"] * 40))], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item), (2, item.upper())], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in template_leaks.find_leaks(frame, benchmark).collect()}
    assert {d for d, item_id in got if item_id == 1} == {0, 1, 2, 3, 4}
    assert {d for d, item_id in got if item_id == 2} >= {0, 1, 2, 3}
    assert all(r.n_windows <= r.item_windows for r in got.values()) and got[1, 1].n_windows == got[1, 1].item_windows


def test_leaks_with_one_window_in_all_documents_and_items(spark):
    """Twenty million pairs have the common window; only those with rarer ones are compared."""
    hot = "what is the right answer to this question"
    items = spark.range(10_000).selectExpr("id AS item_id", f"concat('{hot} ', array_join(transform(sequence(0, 11), j -> concat('w', id, 'x', j)), ' ')) AS text")
    docs = spark.range(2_000).selectExpr(
        "id AS doc_id", f"concat('{hot} ', array_join(transform(sequence(0, 11), j -> concat(if(id % 100 = 0, 'w', 'z'), id, 'x', j)), ' ')) AS text")
    got = {(r.doc_id, r.item_id) for r in template_leaks.find_leaks(docs, items).collect()}
    assert got == {(i, i) for i in range(0, 2_000, 100)}


def test_runs_equal_plain_hashes():
    codes = np.random.default_rng(1).integers(0, 1 << 63, 50).astype(np.uint64)
    for size in range(1, 9):
        plain = [0] * (50 - size + 1)
        for at in range(len(plain)):
            for code in codes[at : at + size].tolist():
                plain[at] = (plain[at] * 0x9E3779B97F4A7C15 + code) % (1 << 64)
        assert template_leaks.runs(codes, size).tolist() == plain


def test_leaks_of_odd_rows(spark, messy, nothing):
    item = "the quick brown fox jumps over the lazy dog while seven wise men watch the river run"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = template_leaks.find_leaks(messy, benchmark)
    assert {r.doc_id for r in got.collect()} == {1, 2, None, 8}
    kept = template_leaks.drop_leaks(messy, benchmark)
    assert kept.columns == messy.columns and kept.count() == messy.count() - 5
    assert template_leaks.find_leaks(nothing, benchmark).count() == 0
    assert template_leaks.find_leaks(messy, benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_with_sql(spark, name):
    assert not compare(spark, connect(SF_DIR), queries.QUERIES[name], queries.ORACLE[name], SF_DIR)


def plain_water_fill(sizes, weights, epochs):
    total, held = sum(sizes), set()
    while True:
        free = sum(w for i, w in enumerate(weights) if i not in held)
        rest = total - sum(epochs * sizes[i] for i in held)
        target = [epochs * s if i in held else rest * w / free for i, (s, w) in enumerate(zip(sizes, weights))]
        over = {i for i, (t, s) in enumerate(zip(target, sizes)) if t > epochs * s + 1e-9}
        if not over:
            return target
        held |= over


def test_water_filling(spark):
    for sizes in ([10, 1000, 10, 500, 3, 7], [5, 5, 5], [1, 0, 2000], [100]):
        weights = [(5.0, 2.0, 1.0)[i % 3] for i in range(len(sizes))]
        frame = spark.createDataFrame([(f"s{i}", s, w) for i, (s, w) in enumerate(zip(sizes, weights))], "source string, source_size long, weight double")
        got = {r.source: r.target for r in mixing.water_fill(frame).collect()}
        assert [got[f"s{i}"] for i in range(len(sizes))] == pytest.approx(plain_water_fill(sizes, weights, 3.0), abs=1e-3)


def test_mix_of_odd_rows(spark, messy, nothing):
    rows = mixing.mix_sources(messy).collect()
    assert len(rows) == messy.count() and all(r.taken <= 3 * r.size for r in rows)
    repeated = mixing.repeat_documents(messy)
    assert repeated.columns == messy.columns and repeated.count() == sum(r.copies for r in rows)
    assert mixing.mix_sources(nothing).count() == 0 and mixing.repeat_documents(nothing).count() == 0


def test_mix_repeats_documents_of_their_own_source(spark, documents):
    """Rows of two sources that share ids and sizes, some rows twice: each source's words are those that the mix takes."""
    rows = [(i, f"{source} b c", "en", source, n) for i in range(300) for source, n in [("x", 1), ("y", 2), ("y", 2), ("z", 3)]]
    for docs in (spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), documents):
        repeated = mixing.repeat_documents(docs)
        counts = Counter((r.source, r.doc_id) for r in repeated.collect())
        sized = mixing.mix_sizes(docs, mixing.SEED)
        words = {r.source: r.n for r in repeated.groupBy("source").agg(F.sum(mixing.size_of(F.col("text"))).alias("n")).collect()}
        aim = {(r.source_size, r.target) for r in mixing.mix_sources(docs).collect()}
        largest = max(r["size"] for r in sized.collect())
        sizes = {r.source: r.n for r in sized.groupBy("source").agg(F.sum("size").alias("n")).collect()}
        for source, size in sizes.items():
            assert any(own == size and abs(words.get(source, 0) - target) <= largest for own, target in aim)
        assert sum(counts.values()) == sum(r.copies for r in mixing.mix_sources(docs).collect())


def test_mix_moves_no_texts_but_those_of_cut_buckets(documents):
    plan = mixing.repeat_documents(documents)._jdf.queryExecution().executedPlan().toString()
    most = plan.split("SortMergeJoin")[0]
    assert "FileScan" in most and "hashpartitioning" not in most


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, top in ((1, 1), (1, 10**12), (5, 3), (1000, 100), (50_000, 10**9), (30_000, 2**50)):
        values = np.sort(rng.integers(0, top, n)).astype(np.uint64)
        coded, _ = elias_fano.EliasFano.load(memoryview(b"".join(elias_fano.EliasFano.build(values).dump())), 0)
        at = rng.integers(0, n, 300)
        assert (coded.access(at) == values[at]).all()
        asked = np.concatenate([values[at], rng.integers(0, top + top // 10 + 5, 500).astype(np.uint64)])
        assert (coded.successor(asked) == np.searchsorted(values, asked)).all()


def test_trie_scores_equal_plain_counts(documents, messy, nothing):
    for docs in (documents, messy):
        rows = [(r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect()]
        tokens = [(i, bytes(c + 32 if 65 <= c <= 90 else c for c in t).split() + [b"end mark"]) for i, t in rows]
        held = [zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i, _ in tokens]
        count, pairs, contexts = Counter(), Counter(), Counter()
        for (_, own), out in zip(tokens, held):
            if not out:
                before = ["start", *own[:-1]]
                count.update(own), pairs.update(zip(before, own)), contexts.update(before)
        n, v, followers = sum(count.values()), len(count), Counter(a for a, _ in pairs)
        want = []
        for (i, own), out in zip(tokens, held):
            base = score = 0.0
            for a, b in zip(["start", *own[:-1]], own):
                single = (count[b] + 1) / (n + v + 1)
                base += math.log10(single)
                seen = max(pairs[a, b] - 0.75, 0) / contexts[a] + 0.75 * followers[a] / contexts[a] * single if contexts[a] else single
                score += math.log10(seen)
            want.append((-1 if i is None else i, out, len(own), sum(count[b] > 0 for b in own), n, base, score))
        got = [(-1 if r.doc_id is None else r.doc_id, *r[1:]) for r in ngram_trie.score_documents(docs).collect()]
        assert len(got) == len(want)
        for a, b in zip(sorted(got), sorted(want)):
            assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
            assert abs(a[6] - b[6]) <= a[2] * ngram_trie.QUANTUM / 2 + 1e-9
    scores = ngram_trie.score_documents(documents)
    assert ngram_trie.perplexity(scores) < ngram_trie.perplexity(scores, "base_score")
    assert ngram_trie.score_documents(nothing).count() == 0


RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - (9 if d > 4 else 0)
    return total % 10 == 0


def plain_pii(text):
    found = []
    for rank, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]:
                found.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))


def test_pii_base_equals_plain_rules(spark, documents, nothing):
    rng = np.random.default_rng(3)
    alphabet = list("ab1.@+- 0059%_()\n2é")
    rows = [(i, "".join(rng.choice(alphabet, rng.integers(0, 150)))) for i in range(600)]
    rows += [(9000, None), (9001, "x@y.co_z@w.de+1@q.r"), (9002, "1.2.3.4.5.6.7.8 001.002.003.255 1.2.3.256"), (9003, "a@b" + ".c" * 5000), (9004, "a" * 20_000)]
    for docs in (documents, spark.createDataFrame(rows, "doc_id long, text string")):
        texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
        for r in pii_contexts.find_pii(docs).collect():
            base = plain_pii(texts[r.doc_id])
            assert ",".join(s for s in r.spans.split(",") if s.split(":")[0] in RULES) == base
            assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [base.count(f"{k}:") for k in RULES]
    assert pii_contexts.find_pii(nothing).count() == 0


def test_pii_contexts_discover_unseen_values(spark, messy):
    rows = [(i, f"Contact sheet. Phone: +1 (555) 010-{1000 + i} and note") for i in range(8)]
    rows += [(20, "Phone: 555-0199a, ok"), (21, "Phone: none."), (22, "phone : ext99123."), (23, "Note: 555-0199a")]
    got = {r.doc_id: r.spans for r in pii_contexts.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[20] == "context_phone:7:16" and got[22] == "context_phone:8:16" and got[21] == got[23] == ""
    assert pii_contexts.find_pii(messy).count() == messy.count()


def test_pii_contexts_of_two_generations_and_in_prose(spark):
    rows, want = [], {}

    def add(text, value, kind):
        rows.append((len(rows), text))
        at = text.index(value)
        want[rows[-1][0]] = f"{kind}:{at}:{at + len(value)}" if kind else ""

    for i in range(30):
        add(f"record {i} email: user{i}@mail.org end", f"user{i}@mail.org", "email")
        add(f"the entry has email: hidden{i:02}at, as before", f"hidden{i:02}at", "context_email")
        add(f"now login=hidden{i:02}at here", f"hidden{i:02}at", "context_email")
        add(f"and login=secret{i:02}zz here", f"secret{i:02}zz", "context_email")
        add(f"please call us by phone at +1 555 020 {1000 + i} today", f"+1 555 020 {1000 + i}", "phone")
        # Identifiers that few or no known values stand beside, and words after good patterns.
        add(f"the build of version v{i}.20{i} failed", f"v{i}.20{i}", None)
        add(f"email: see page {i}", "see", None)
        add(f"seen in report 2020{i:02} and host 10.0.0.{i}" if i < 9 else f"seen in report 2020{i:02}", f"2020{i:02}", None)
    add("we met, call by phone at ext44551 or not", "ext44551", "context_phone")
    add("he met me at gate77b21", "gate77b21", None)
    # The same place twice, and an identifier in a seed, give no span of their own.
    add("email: x123456@mail.org", "x123456@mail.org", "email")
    rows.append((None, rows[1][1]))
    docs = spark.createDataFrame(rows + rows[:5], "doc_id long, text string")
    got = pii_contexts.find_pii(docs).collect()
    assert len(got) == len(rows) + 5
    for r in got:
        if r.doc_id is None:
            assert r.spans == want[1]
        else:
            found = [s for s in r.spans.split(",") if s and not s.startswith("ip:")]
            assert found == [s for s in [want[r.doc_id]] if s], rows[r.doc_id]
            assert r.n_spans == len([s for s in r.spans.split(",") if s])


def test_pii_runs_no_python(documents):
    plan = pii_contexts.find_seeds(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


PAGES = "page_id long, url string, html string"


def test_archives_round_trip(spark):
    long, other = "é" * 600, "x" * 1000
    rows = [
        (1, "http://a/ b\n", long), (5, None, long), (3, "http://c", long), (2, "u", "short"), (4, "u", "short"), (None, "u", other), (8, "u", other),
        (9, "u", None), (10, "u", "x" * 999), (11, "u", "x" * 999), (12, "u", "y" * 1500), (12, "u", "y" * 1500),
    ]
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' AS digest", "'y' AS payload", "1 AS original")
    got = Counter(tuple(r) for r in warc_revisits.round_trip(pages).collect())
    want = Counter()
    for page, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if h == html and p is not None]
        target = max(same, default=None) if len(body) >= 1000 else page
        revisit = target is not None and target > (-1 if page is None else page)
        want[page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", target if revisit else None] += 1
    assert got == want
    assert warc_revisits.round_trip(pages.limit(0)).count() == 0


def test_records_are_standard_warc():
    import gzip

    body = gzip.decompress(warc_revisits.record(3, "http://a/", b"<p>", hashlib.sha1(b"<p>").hexdigest(), None, warc_revisits.DATE))
    headers, payload = warc_revisits.parse_record(body)
    assert body.startswith(b"WARC/1.1\r\n") and body.endswith(b"\r\n\r\n") and payload == b"<p>"
    assert headers["warc-type"] == "response" and headers["warc-payload-digest"].startswith("sha1:")


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    ids = {"": {r.doc_id for r in docs.collect()}}
    before = ""
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.settle(stage(spark, docs, SF_DIR), f"test-{name}")
        if name != "tokens":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        ids[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids[name] <= ids[before]
        before = name
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "dedup", "decontaminate", "mix", "tokens"]
    assert ids["tokens"] == ids["mix"] and 0 < len(ids["mix"]) and len(ids["dedup"]) < len(ids["quality"])
