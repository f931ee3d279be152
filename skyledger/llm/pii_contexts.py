"""PII by bootstrapped contextual extraction, in DataFrame functions only.

Seed entities (email, ip, card and phone by their rules, and long hexadecimal keys) are found by regular
expressions. Beside them, tokens that look like identifiers (six characters and more, a digit) are candidates.
What stands before a seed or a candidate on its line makes its patterns: a cue, a word with ``:``, ``=`` or
``#`` such as ``account:``, and the last two and three words, such as ``by mail at``. Patterns and values form
a graph, scored in turns: a value by the patterns that precede it (seeds have score 1), a pattern by the mean
score of the known values after it, if these are ``support`` at least and ``known_share`` of all identifiers
after it. Both carry the kind of the seeds they descend from, each generation a tenth less certain, so values
found after one pattern make further patterns until the score falls under the least. Candidates after good
patterns that no rule found are added as ``context_<kind>``. Tokens that do not look like identifiers are
never marked, so they do not count against a pattern.

Positions are code points, from the lengths of the pieces between matches. No rule crosses a line or
can run over a text more than a few times: runs are possessive and begin only where a run can begin.

Everything but the graph is per document; whether a candidate lies in a seed is told by sorting the spans of a
document, not by comparing all. Graph edges are distinct (pattern, value) pairs, combined before
each shuffle; frequent patterns and values are rows of joins that Spark may split. Missing texts are empty;
rows that share an id are told apart by their text, and equal rows get equal results; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import ids_and_texts, settle

#: Rules as Java patterns. ``\G`` lets a match begin where the one before ended inside a run.
RULES = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BASE = tuple(RULES)
KEY = r"(?<![A-Za-z0-9])[0-9a-f]{32,}+(?![A-Za-z0-9])"
TOKEN = r"(?<![A-Za-z0-9_%+/@.-])(?=[A-Za-z_%+/@.-]*+[0-9])[A-Za-z0-9_%+/@.-]{5,}[A-Za-z0-9]"
#: What may stand between a pattern and its value, and the patterns, in the lower-cased text before the value.
_LEAD = r"[ \t]*+[\"'(<]?$"
CUE = r"(?<![\p{L}_])([\p{L}_]++[ \t]*+[:=#]++)" + _LEAD
WORDS = (
    r"(?<![\p{L}_'])([\p{L}_']++,?[ \t]++[\p{L}_']++[ \t]*+[:=#]*+)" + _LEAD,
    r"(?<![\p{L}_'])([\p{L}_']++,?[ \t]++[\p{L}_']++,?[ \t]++[\p{L}_']++[ \t]*+[:=#]*+)" + _LEAD,
)
#: Code points before a value in which its patterns are looked for.
REACH = 64
KINDS = (*BASE, "key", *(f"context_{kind}" for kind in (*BASE, "key")))

ROUNDS = 3
MIN_SUPPORT = 5
MIN_SCORE = 0.8
KNOWN_SHARE = 0.3
#: What a generation keeps of a score.
_KEPT = 0.9
_RUN = 256

_SPAN_ROW = "struct<start:bigint,end:bigint,kind:string,value:string>"
_SPAN = "array<struct<start:bigint,end:bigint,value:string,before:string>>"


def running_starts(lengths: Column) -> Column:
    """Sum of all lengths before each, in runs of 256 so that its cost grows with the number of lengths."""
    runs = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _RUN).cast("int"))

    def run(values: Column, b: Column) -> Column:
        return F.slice(values, b * _RUN + 1, F.lit(_RUN))

    def starts(values: Column, first: Column) -> Column:
        begin = F.struct(first.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(values, begin, lambda held, x: F.struct(
            (held["at"] + x).alias("at"), F.concat(held["out"], F.array(held["at"])).alias("out")
        ))["out"]

    sums = F.transform(runs, lambda b: F.aggregate(run(lengths, b), F.lit(0).cast("bigint"), lambda a, x: a + x))
    firsts = starts(sums, F.lit(0).cast("bigint"))
    return F.flatten(F.transform(F.arrays_zip(runs.alias("b"), firsts.alias("f")), lambda r: starts(run(lengths, r["b"]), r["f"])))


def with_matches(df: DataFrame, name: str, pattern: str, may: Column) -> DataFrame:
    """Adds ``name``: start, end and value of all matches of a pattern in ``text``, and what stands before each, up
    to the match before; ``may`` is a cheap test."""
    none = F.array().cast("array<string>")
    return (
        df.withColumn("_hits", F.when(may, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
        .withColumn("_split", F.when(F.size("_hits") > 0, F.split("text", pattern, -1)))
        .withColumn("_pieces", F.transform("_split", lambda piece: F.length(piece).cast("bigint")))
        # A step goes from one match's start to the next: the match and the piece after it.
        .withColumn("_steps", F.when(F.size("_hits") > 0, F.transform(
            "_hits", lambda hit, i: F.length(hit).cast("bigint") + F.get("_pieces", i + 1)
        )))
        .withColumn("_starts", F.when(F.size("_hits") > 0, running_starts(F.col("_steps"))))
        .withColumn(name, F.when(F.size("_hits") > 0, F.transform("_hits", lambda hit, i: F.struct(
            (F.get("_pieces", F.lit(0)) + F.get("_starts", i)).alias("start"),
            (F.get("_pieces", F.lit(0)) + F.get("_starts", i) + F.length(hit)).alias("end"),
            hit.alias("value"), F.substring(F.get("_split", i), -REACH, REACH).alias("before"),
        ))).otherwise(F.array().cast(_SPAN)))
        .drop("_hits", "_split", "_pieces", "_steps", "_starts")
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes: every second from the right counts doubled, nine less if above nine."""
    marks = F.split(F.reverse(digits), "")
    total = F.aggregate(
        F.transform(marks, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0))),
        F.lit(0), lambda a, x: a + x,
    )
    return total % 10 == 0


def accepted(kind: str, value: Column) -> Column:
    """The test a match of a rule has to pass; a match that fails is dropped."""
    if kind == "ip":
        part = F.split(value, r"\.")
        small = F.transform(part, lambda p: F.regexp_replace(p, "^0+", ""))
        return F.forall(small, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    digits = _digits(value)
    if kind == "card":
        return F.length(digits).between(14, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _test(kind: str) -> Callable[[Column], Column]:
    return lambda m: accepted(kind, m["value"])


def _named(kind: str, *more: str) -> Column:
    """The spans of a rule's column, with the rule's name."""
    return F.transform(kind, lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), F.lit(kind).alias("kind"), m["value"].alias("value"),
        *[m[field].alias(field) for field in more],
    ))


def find_seeds(docs: DataFrame) -> DataFrame:
    """doc_id, own (hash of the text), spans of each rule, and ``token``: spans that look like identifiers."""
    df = ids_and_texts(docs).withColumn("own", F.xxhash64("text"))
    df = df.withColumn("_digit", F.col("text").rlike("[0-9]"))
    tests = {
        "email": F.contains("text", F.lit("@")), "ip": F.col("_digit"), "card": F.col("_digit"),
        "phone": F.col("_digit") & F.contains("text", F.lit("+")),
    }
    for kind, pattern in RULES.items():
        df = with_matches(df, kind, pattern, tests[kind])
        df = df.withColumn(kind, F.filter(kind, _test(kind)))
    df = with_matches(df, "key", KEY, F.col("_digit"))
    df = with_matches(df, "token", TOKEN, F.col("_digit"))
    return df.select("doc_id", "own", *BASE, "key", "token")


def contexts(found: DataFrame) -> DataFrame:
    """A row per seed, and per candidate that lies in none: doc_id, own, start, end, value (lower-cased), kind (of a
    seed, else missing) and its patterns. Rows that repeat an id and its text count once."""
    spans = F.concat(*[_named(kind, "before") for kind in (*BASE, "key", "token")])
    # One row per document and text, so that the spans below are sorted where they are.
    each = (
        found.select("doc_id", "own", spans.alias("spans")).where(F.size("spans") > 0)
        .groupBy("doc_id", "own").agg(F.first("spans").alias("spans"))
        .select("doc_id", "own", F.explode("spans").alias("s")).select("doc_id", "own", "s.*")
        .withColumn("seed", F.col("kind") != "token")
    )
    order = Window.partitionBy("doc_id", "own").orderBy("start", F.col("seed").desc(), "end", "kind")
    reached = F.max(F.when(F.col("seed"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    # Candidates do not overlap, so a seed that starts in one is the next span.
    following = F.lead(F.when(F.col("seed"), F.col("start"))).over(order)
    free = F.col("seed") | ~(
        F.coalesce(reached > F.col("start"), F.lit(False)) | F.coalesce(following < F.col("end"), F.lit(False))
    )
    line = F.lower(F.regexp_extract("before", r"[^\n\r]*+$", 0))

    def pattern(rule: str) -> Column:
        return F.regexp_replace(F.regexp_replace(F.regexp_extract("line", rule, 1), r"[ \t]+(?=[:=#])", ""), r"[ \t]+", " ")

    return (
        each.withColumn("free", free).where("free").withColumn("line", line)
        .withColumn("patterns", F.array_distinct(F.filter(F.array(*[pattern(r) for r in (CUE, *WORDS)]), lambda p: p != "")))
        .where(F.size("patterns") > 0)
        .select("doc_id", "own", "start", "end", F.lower("value").alias("value"), F.when(F.col("seed"), F.col("kind")).alias("kind"), "patterns")
    )


def score_graph(edges: DataFrame, rounds: int, support: int, least: float, known_share: float = KNOWN_SHARE) -> DataFrame:
    """Patterns (pattern, kind, score) that score at least ``least`` from edges (pattern, value, kind or null)."""
    edges = settle(edges, "pii-graph")
    seeds = edges.where("kind IS NOT NULL").groupBy("value").agg(F.min("kind").alias("kind")).withColumn("score", F.lit(1.0))
    links = edges.select("pattern", "value").distinct()
    known = seeds
    for turn in range(max(rounds, 1)):
        # Kinds are summed apart, so the values of a frequent pattern are combined where they are.
        patterns = (
            links.join(known, "value", "left").groupBy("pattern", "kind")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("score", F.lit(0.0))).alias("sum"))
            .groupBy("pattern").agg(
                F.sum("n").alias("n"), F.sum(F.when(F.col("kind").isNotNull(), F.col("n")).otherwise(0)).alias("known"),
                F.sum("sum").alias("sum"), F.max(F.when(F.col("kind").isNotNull(), F.struct("sum", "kind"))).alias("top"),
            )
            .where((F.col("known") >= support) & (F.col("known") >= F.lit(known_share) * F.col("n")))
            .select("pattern", F.col("top.kind").alias("kind"), F.round(F.col("sum") / F.col("known"), 6).alias("score"))
            .where(F.col("score") >= least)
        )
        good = settle(patterns, "pii-patterns")
        if turn + 1 == rounds:
            break
        # A value has the kind and, a generation on, the score of its best pattern.
        drawn = links.join(good, "pattern").groupBy("value").agg(F.max(F.struct("score", "kind")).alias("best")).select(
            "value", F.col("best.kind").alias("kind"), (F.col("best.score") * _KEPT).alias("score")
        )
        known = settle(seeds.unionByName(drawn.join(seeds.select("value"), "value", "left_anti")), "pii-values")
    return good


def discover(
    found: DataFrame, rounds: int = ROUNDS, support: int = MIN_SUPPORT, least: float = MIN_SCORE, known_share: float = KNOWN_SHARE
) -> DataFrame:
    """(doc_id, own, added: spans of candidates that good patterns introduce and no rule found)."""
    at = settle(contexts(found), "pii-contexts")
    edges = at.select(F.explode("patterns").alias("pattern"), "value", "kind").distinct()
    good = score_graph(edges, rounds, support, least, known_share)
    return (
        at.where("kind IS NULL").select("doc_id", "own", "start", "end", "value", F.explode("patterns").alias("pattern"))
        .join(good, "pattern").groupBy("doc_id", "own", "start", "end", "value").agg(F.max(F.struct("score", "kind")).alias("best"))
        .select("doc_id", "own", F.struct("start", "end", F.concat(F.lit("context_"), "best.kind").alias("kind"), "value").alias("span"))
        .groupBy("doc_id", "own").agg(F.collect_set("span").alias("added"))
    )


def _written(spans: Column) -> Column:
    order = F.create_map(*[x for i, kind in enumerate(KINDS) for x in (F.lit(kind), F.lit(i))])
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), order[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")
    )))
    return F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(
    docs: DataFrame, rounds: int = ROUNDS, support: int = MIN_SUPPORT, least: float = MIN_SCORE, known_share: float = KNOWN_SHARE
) -> DataFrame:
    """One row per document: counts of each base rule, a digest of the base spans, and all spans."""
    found = settle(find_seeds(docs), "pii-seeds")
    added = settle(discover(found, rounds, support, least, known_share), "pii-added").withColumnsRenamed({"doc_id": "d", "own": "o"})

    def spans(*kinds: str) -> Column:
        return F.concat(*[_named(kind) for kind in kinds])

    joined = found.drop("token").join(added, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("own") == F.col("o")), "left")
    more = F.coalesce("added", F.array().cast(f"array<{_SPAN_ROW}>"))
    base = F.size(BASE[0]).cast("long")
    for kind in BASE[1:]:
        base = base + F.size(kind)
    return joined.select(
        "doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in BASE],
        F.sha2(_written(spans(*BASE)), 256).alias("base_sha256"),
        _written(F.concat(spans(*BASE, "key"), more)).alias("spans"),
        (F.size("key") + F.size(more)).cast("long").alias("n_added"),
        (base + F.size("key") + F.size(more)).cast("long").alias("n_spans"),
    )
