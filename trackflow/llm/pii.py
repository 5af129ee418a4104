"""Personal data: fixed patterns, and candidates scored by boosted trees. All in Spark SQL.

Generators with high recall propose spans: digit groups with separators, written-out mail
addresses and account numbers. Features of form and context are computed by SQL expressions.
Boosted trees, trained on the driver from a bounded sample of candidates whose answer the fixed
patterns know, become CASE expressions. The threshold is the lowest score that keeps the
precision on a held-out half of the sample at ``PRECISION``; candidates above it that touch no
span of the fixed patterns are added as kind ``likely``.

Positions come from cutting the text at the matches: the pieces between them and the matches
have lengths that add up to the places. Patterns are possessive and start only where a run
starts or the last match ended, so that long runs cost linear time.

Defined results: a null text is empty and has no spans; positions count code points, ends are
exclusive. Rows are mapped one to one; other columns are ignored. The trees learn from samples of
any size and kind; no span is added only where no score keeps the precision, as without a row
that is held out.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackflow.llm.shared import text_rows

SAMPLE = 4_000
ROUNDS = 24
RATE = 0.3
PRECISION = 0.97
CONTEXT = 24

# Fixed patterns of the base kinds, in the order in which they are listed.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

# Fixed patterns of the generators, and words that announce personal data.
NUMBERS = r"(?<![A-Za-z0-9])[+(]?[0-9](?:[\x20().-]{0,2}[0-9]){7,}+"
WRITTEN = (
    r"(?i)(?<![A-Z0-9._%+-])[A-Z0-9._%+-]{1,64}+\x20?[\[(]at[\])]\x20?[A-Z0-9-]++"
    r"(?:\x20?(?:[\[(]dot[\])]|\.)\x20?[A-Z0-9-]++)++"
)
ACCOUNT = r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}\b"
GENERATORS = (NUMBERS, WRITTEN, ACCOUNT)
WORDS = r"phone|tel|call|mobile|fax|contact|card|visa|ssn|iban|account|mail|cell"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a right check digit."""

    def part(digit: Column, place: Column) -> Column:
        twice = digit.cast("int") * 2
        return F.when(place % 2 == 0, digit.cast("int")).otherwise(
            F.when(twice > 9, twice - 9).otherwise(twice)
        )

    each = F.transform(F.regexp_extract_all(F.reverse(number), F.lit("[0-9]"), F.lit(0)), part)
    return F.aggregate(each, F.lit(0), lambda s, x: s + x) % 10 == 0


def valid_ip(value: Column) -> Column:
    return value.rlike(rf"^(?:{BYTE}\.){{3}}{BYTE}$")


def valid_card(value: Column) -> Column:
    number = digits(value)
    return F.length(number).between(14, 19) & luhn(number)


def valid_phone(value: Column) -> Column:
    return F.length(digits(value)).between(10, 15)


def matches(text: Column, pattern: str) -> Column:
    """Array of start, end and value of all matches, from left to right."""
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start: int, end: int, value: string>>")

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + F.char_length(part["hit"])
        span = F.struct(start.alias("start"), end.alias("end"), part["hit"].alias("value"))
        return F.when(part["hit"].isNull(), state).otherwise(
            F.struct(end.alias("at"), F.concat(state["found"], F.array(span)).alias("found"))
        )

    parts = F.zip_with(gaps, hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    begin = F.struct(F.lit(0).alias("at"), none.alias("found"))
    return F.aggregate(parts, begin, step, lambda s: s["found"])


def _gated(text: Column, gate: Column, pattern: str) -> Column:
    """Matches of a pattern, looked for only where the text can have one."""
    none = F.array().cast("array<struct<start: int, end: int, value: string>>")
    return F.when(gate, matches(text, pattern)).otherwise(none)


def _passing(spans: Column, test: Callable[[Column], Column]) -> Column:
    return F.filter(spans, lambda s: test(s["value"]))


def _of_kind(spans: Column, kind: str) -> Column:
    """Spans as they are given out; they sort by start, then by the listed place of their kind."""
    place = KINDS.index(kind) if kind in KINDS else len(KINDS)
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(place).alias("place"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
        ),
    )


def base_spans(rows: DataFrame) -> DataFrame:
    """``doc_id, text, base``: the spans of the fixed patterns, by start and kind."""
    text = F.col("text")
    found = {
        "email": _gated(text, F.contains(text, F.lit("@")), EMAIL),
        "ip": _gated(text, text.rlike(r"[0-9]\.[0-9]"), IP),
        "card": _gated(text, text.rlike(r"[0-9]{2}|[0-9][\x20-][0-9]"), CARD),
        "phone": _gated(text, F.contains(text, F.lit("+")), PHONE),
    }
    good = {"email": None, "ip": valid_ip, "card": valid_card, "phone": valid_phone}
    raw = rows.select("doc_id", "text", *(v.alias(f"raw_{k}") for k, v in found.items()))
    kept = []
    for kind in KINDS:
        spans = F.col(f"raw_{kind}")
        kept.append(_of_kind(_passing(spans, good[kind]) if good[kind] else spans, kind))
    return raw.select("doc_id", "text", F.array_sort(F.concat(*kept)).alias("base"))


def candidates(rows: DataFrame) -> DataFrame:
    """``doc_id, text, base, proposed``: spans of the generators, which may overlap."""
    text = F.col("text")
    gates = (
        text.rlike(r"[0-9][\x20().-]{0,2}[0-9][\x20().-]{0,2}[0-9]"),
        text.rlike(r"(?i)[\[(]at[\])]"),
        text.rlike(r"[A-Z]{2}[0-9]{2}"),
    )

    def proposed(source: int) -> Column:
        spans = _gated(text, gates[source], GENERATORS[source])
        return F.transform(spans, lambda s: s.withField("source", F.lit(source)))

    found = [proposed(source) for source in range(len(GENERATORS))]
    return rows.select("*", F.concat(*found).alias("proposed"))


FEATURES = (
    "length", "digits", "groups", "dashes", "spaces", "dots", "parens", "longest", "distinct",
    "word_before", "letter_before", "letter_after", "source", "first_digit",
)


def features(text: Column, span: Column) -> Column:
    """Numbers of form and context; neither the leading plus nor check digits are among them."""
    value = F.ltrim(F.lit("+"), span["value"])
    number = digits(value)
    groups = F.split(value, "[^0-9]+")
    start = F.greatest(span["start"] - CONTEXT, F.lit(0))
    before = F.substring(text, start + 1, span["start"] - start)

    def count(pattern: str) -> Column:
        return F.char_length(value) - F.char_length(F.regexp_replace(value, pattern, ""))

    every = (
        F.char_length(value),
        F.char_length(number),
        F.size(F.filter(groups, lambda g: g != "")),
        count("-"),
        count(r"\x20"),
        count(r"\."),
        count("[()]"),
        F.array_max(F.transform(groups, F.char_length)),
        F.size(F.array_distinct(F.split(number, ""))),
        before.rlike(rf"(?i)(?:{WORDS})").cast("int"),
        F.substring(text, span["start"], F.lit(1)).rlike("[A-Za-z]").cast("int"),
        F.substring(text, span["end"] + 1, F.lit(1)).rlike("[A-Za-z]").cast("int"),
        span["source"],
        F.coalesce(F.try_to_number(F.substring(number, 1, 1), F.lit("9")).cast("int"), F.lit(-1)),
    )
    return F.array(*(F.coalesce(x, F.lit(0)).cast("double") for x in every))


def touches(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def training_sample(found: DataFrame, size: int = SAMPLE) -> DataFrame:
    """``features, answer`` of at most ``size`` candidates of digits, drawn over all rows by hash:
    whether a span of the fixed patterns covers the candidate."""
    one = found.select("doc_id", "text", "base", F.explode("proposed").alias("span"))
    one = one.where("span.source = 0")
    answer = F.exists("base", lambda b: touches(b, F.col("span")))
    return (
        one.select(
            features(F.col("text"), F.col("span")).alias("features"),
            answer.cast("int").alias("answer"),
            F.xxhash64("doc_id", "span").alias("order"),
        )
        .orderBy("order", "features", "answer")
        .limit(size)
        .select("features", "answer")
    )


Tree = tuple[int, float, float, float]  # feature, cut, value below, value from the cut on


def boost(x: np.ndarray, y: np.ndarray) -> tuple[float, list[tuple[Tree, Tree, int, float]]]:
    """Trees of depth two for the log loss: a first cut, and a cut on each side."""
    mean = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    bias = math.log(mean / (1 - mean))
    score, trees = np.full(len(y), bias), []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        slope, bend = y - p, p * (1 - p) + 1e-6
        feature, cut = _best_cut(x, slope, bend)
        below = x[:, feature] < cut
        sides = tuple(_stump(x[part], slope[part], bend[part]) for part in (below, ~below))
        trees.append((*sides, feature, cut))
        for part, (f, c, low, high) in zip((below, ~below), sides, strict=True):
            score[part] += np.where(x[part, f] < c, low, high)
    return bias, trees


def _best_cut(x: np.ndarray, slope: np.ndarray, bend: np.ndarray) -> tuple[int, float]:
    best, chosen = -1.0, (0, 0.0)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        value, g, h = x[order, f], np.cumsum(slope[order]), np.cumsum(bend[order])
        ends = np.flatnonzero(value[1:] > value[:-1])
        if len(ends):
            gain = g[ends] ** 2 / (h[ends] + 1) + (g[-1] - g[ends]) ** 2 / (h[-1] - h[ends] + 1)
            at = int(gain.argmax())
            if gain[at] > best:
                best = float(gain[at])
                chosen = f, float((value[ends[at]] + value[ends[at] + 1]) / 2)
    return chosen


def _stump(x: np.ndarray, slope: np.ndarray, bend: np.ndarray) -> Tree:
    if not len(x):
        return 0, 0.0, 0.0, 0.0
    f, cut = _best_cut(x, slope, bend)
    below = x[:, f] < cut
    low, high = (
        float(RATE * slope[part].sum() / (bend[part].sum() + 1)) for part in (below, ~below)
    )
    return f, cut, low, high


def predict(model: tuple, x: np.ndarray) -> np.ndarray:
    bias, trees = model
    score = np.full(len(x), bias)
    for low, high, feature, cut in trees:
        below = x[:, feature] < cut
        for part, (f, c, a, b) in ((below, low), (~below, high)):
            score[part] += np.where(x[part, f] < c, a, b)
    return score


def scoring(model: tuple, found: Column) -> Column:
    """The trees as one SQL expression over an array of features."""
    bias, trees = model

    def stump(tree: Tree) -> Column:
        f, c, low, high = tree
        return F.when(found[f] < c, F.lit(low)).otherwise(F.lit(high))

    total = F.lit(bias)
    for low, high, feature, cut in trees:
        total = total + F.when(found[feature] < cut, stump(low)).otherwise(stump(high))
    return total


def learn(sample: list[tuple[list[float], int]]) -> tuple[tuple, float] | None:
    """The trees and the threshold; None if no score keeps the precision on the held-out half."""
    if len(sample) < 2:  # no row is held out
        return None
    x = np.array([row[0] for row in sample], float)
    y = np.array([row[1] for row in sample], float)
    half = np.arange(len(y)) % 2 == 0
    model = boost(x[half], y[half])
    scores, answers = predict(model, x[~half]), y[~half]
    order = np.argsort(-scores, kind="stable")
    precision = np.cumsum(answers[order]) / np.arange(1, len(order) + 1)
    last = np.append(scores[order][1:] < scores[order][:-1], True)
    enough = np.flatnonzero((precision >= PRECISION) & last)
    return (model, float(scores[order][enough[-1]])) if len(enough) else None


def find_personal_data(docs: DataFrame, sample_size: int = SAMPLE) -> DataFrame:
    """``doc_id`` and ``spans``: an array of start, place of the kind, end and kind, sorted."""
    rows = candidates(base_spans(text_rows(docs)))
    sample = training_sample(rows, sample_size).collect()
    learned = learn([(r[0], r[1]) for r in sample])
    if learned is None:
        return rows.select("doc_id", F.col("base").alias("spans"))
    model, threshold = learned
    free = F.filter(
        "proposed", lambda s: ~F.exists("base", lambda b: touches(b, s))
    )
    rows = rows.select("doc_id", "text", "base", free.alias("free"))
    scored = F.transform(
        "free",
        lambda s: s.withField("features", features(F.col("text"), s)),
    )
    rows = rows.select("doc_id", "base", scored.alias("scored"))
    likely = F.filter("scored", lambda s: scoring(model, s["features"]) >= threshold)
    rows = rows.select("doc_id", "base", likely.alias("likely"))
    alone = F.filter(
        "likely",
        lambda s: ~F.exists(
            "likely", lambda o: touches(o, s) & (o["start"] < s["start"])
        ),
    )
    added = _of_kind(alone, "likely")
    return rows.select("doc_id", F.array_sort(F.concat("base", added)).alias("spans"))
