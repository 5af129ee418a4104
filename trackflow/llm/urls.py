"""URL filter: fixed rules first, and boosted trees for the URLs that no rule fits.

A rule names a host and the start of a path; it fits the host and all hosts below it, and the
longest rule that fits gives the verdict. The URLs with a rule are the labelled ones. From them
trees learn lexical features: lengths, depth, shares of digits, entropy, parameters, and for the
last label of the host and the ending of the path how many URLs have them and which part of the
labelled ones is blocked. These counts cover all rows; a labelled row is left out of its own.
The trees are trained on the driver, from at most about ``SAMPLE`` distinct labelled URLs drawn
by hash over all rows, and run as one SQL expression.

Defined results. A null URL, or one without ``://``, has an empty host and path and no rule; its
verdict is the trees'. Without labelled URLs all others are allowed, at score 0. Repeated rows get
equal results; URLs of any length are read whole; an empty table gives no rows. Columns other than
the URL stay as they are; those named like a result are replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackflow.llm import boosting
from trackflow.llm.shared import cut_lineage
from trackflow.operators.hold import hold

SAMPLE = 8_000
BLOCK_FROM = 0.5
_SEEN = 2.0  # rows that the overall share counts for in a share of blocked URLs

Rule = tuple[str, str]  # host and path as one text, verdict

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.lit(2**31 - 1))
    return F.coalesce(F.when(at > 0, rest), F.lit(""))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), r"(?s)^([^/?#]*+)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*+(/[^?#]*+)?", 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as text; null if none does."""
    found = F.lit(None).cast("string")
    for text, _ in sorted(rules, key=lambda rule: (len(rule[0]), rule[0])):
        name, slash, start = text.partition("/")
        below = (host == name) | F.endswith(host, F.lit(f".{name}"))
        fits = below & F.startswith(path, F.lit(slash + start))
        found = F.when(fits, F.lit(text)).otherwise(found)
    return found


def host_suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def path_suffix(path: Column) -> Column:
    """The ending of the last part of a path, up to eight letters and digits."""
    return F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})/?$", 1))


def entropy(text: Column) -> Column:
    """Bits per character of a text, from the runs of its sorted characters."""
    letters = F.array_sort(F.filter(F.split(text, ""), lambda c: c != ""))
    zero = F.struct(
        F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum")
    )

    def weighed(run: Column) -> Column:
        return F.when(run > 0, run * F.log2(run)).otherwise(0.0)

    def step(state: Column, letter: Column) -> Column:
        same = state["last"] == letter
        return F.struct(
            letter.alias("last"),
            F.when(same, state["run"] + 1).otherwise(F.lit(1.0)).alias("run"),
            F.when(same, state["sum"])
            .otherwise(state["sum"] + weighed(state["run"]))
            .alias("sum"),
        )

    total = F.aggregate(letters, zero, step, lambda s: s["sum"] + weighed(s["run"]))
    size = F.char_length(text)
    return F.when(size > 0, F.log2(size) - total / size).otherwise(0.0)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    size = F.char_length(url)

    def count(text: Column, letters: str) -> Column:
        return F.char_length(text) - F.char_length(F.translate(text, letters, ""))

    def part(opening: str) -> Column:
        return F.regexp_extract(url, opening, 1)

    query = part(r"(?s)\?([^#]*+)")
    return {
        "length": size,
        "host_length": F.char_length(host),
        "path_length": F.char_length(path),
        "labels": count(host, "."),
        "depth": F.size(F.filter(F.split(path, "/"), lambda p: p != "")),
        "digit_ratio": count(url, "0123456789") / F.greatest(size, F.lit(1)),
        "host_digits": count(host, "0123456789"),
        "dashes": count(url, "-_"),
        "entropy": entropy(url),
        "host_entropy": entropy(host),
        "parameters": F.when(query != "", count(query, "&") + 1).otherwise(0),
        "fragment": F.contains(url, F.lit("#")).cast("int"),
        "secure": F.startswith(F.lower(url), F.lit("https:")).cast("int"),
    }


SUFFIXES = ("host_suffix", "path_suffix")


def suffix_counts(rows: DataFrame) -> DataFrame:
    """``kind, suffix, n, labelled, blocked`` over all rows."""
    pairs = F.array(
        *(F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("suffix")) for kind in SUFFIXES)
    )
    each = rows.select(F.explode(pairs).alias("pair"), "answer")
    return each.groupBy("pair.kind", "pair.suffix").agg(
        F.count("*").alias("n"),
        F.count("answer").alias("labelled"),
        F.coalesce(F.sum("answer"), F.lit(0)).alias("blocked"),
    )


def with_features(rows: DataFrame, counts: DataFrame, share: float) -> DataFrame:
    """Adds ``features``; a labelled row does not count in the shares of its own suffixes."""
    # Left to Spark's size check: a broadcast only while the counted suffixes are few.
    for kind in SUFFIXES:
        of_kind = counts.where(F.col("kind") == kind).select(
            F.col("suffix").alias(kind),
            *(F.col(name).alias(f"{kind}_{name}") for name in ("n", "labelled", "blocked")),
        )
        rows = rows.join(of_kind, kind, "left")
    own = F.col("answer").isNotNull().cast("int")
    numbers = list(lexical(F.col("url_text"), F.col("host"), F.col("path")).values())
    for kind in SUFFIXES:
        labelled = F.col(f"{kind}_labelled") - own
        blocked = F.col(f"{kind}_blocked") - F.coalesce("answer", F.lit(0))
        numbers.append((blocked + share * _SEEN) / (labelled + _SEEN))
        numbers.append(F.log2(F.col(f"{kind}_n")))
    made = F.array(*(F.coalesce(n.cast("double"), F.lit(0.0)) for n in numbers))
    counted = [f"{kind}_{name}" for kind in SUFFIXES for name in ("n", "labelled", "blocked")]
    return hold(rows.withColumn("made", made).drop(*counted), "made", "features")


def training_rows(rows: DataFrame, size: int = SAMPLE) -> DataFrame:
    """Labelled rows whose URL is drawn by hash, each distinct one once with its ``weight``."""
    labelled = rows.where("answer IS NOT NULL")
    distinct = labelled.agg(F.approx_count_distinct("url_text")).first()[0]
    share = min(1.0, size / max(distinct, 1))
    drawn = (F.xxhash64("url_text") % 1_000_000 + 1_000_000) % 1_000_000 < share * 1_000_000
    columns = ("url_text", "host", "path", *SUFFIXES)
    return labelled.where(drawn).groupBy(*columns, "answer").agg(F.count("*").alias("weight"))


def learn(sample: list) -> boosting.Model | None:
    """Trees from rows of features, answer and weight; None without rows."""
    if not sample:
        return None
    ordered = sorted(sample, key=lambda row: (list(row[0]), row[1], row[2]))
    x, y, weight = (np.array([row[i] for row in ordered], float) for i in range(3))
    return boosting.fit(x, y, weight)


def filter_urls(
    pages: DataFrame, rules: list[Rule], url: str = "url", sample_size: int = SAMPLE
) -> DataFrame:
    """The pages with ``host``, ``path``, ``rule``, ``verdict`` and ``score``.

    ``score`` is the chance of a block that the trees see, for pages with a rule too. ``rules``
    are a list in code, tried one by one.
    """
    results = ("host", "path", "rule", "verdict", "score")
    kept = [name for name in pages.columns if name not in results]
    row = F.struct(*(F.col(f"`{name}`") for name in kept)).alias("row")
    texts = pages.select(
        row, F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url_text")
    )
    places = texts.withColumns(
        {"host": host_of(F.col("url_text")), "path": path_of(F.col("url_text"))}
    )
    rule = rule_of(F.col("host"), F.col("path"), rules)
    blocked = [text for text, verdict in rules if verdict == "block"]
    answer = F.when(F.col("rule").isNotNull(), F.col("rule").isin(*blocked).cast("int"))
    rows = places.withColumn("rule", rule).withColumns(
        {
            "answer": answer,
            "host_suffix": host_suffix(F.col("host")),
            "path_suffix": path_suffix(F.col("path")),
        }
    )
    counts = cut_lineage(suffix_counts(rows))
    totals = counts.where("kind = 'host_suffix'").agg(F.sum("blocked"), F.sum("labelled")).first()
    share = (totals[0] or 0) / max(totals[1] or 0, 1)
    drawn = with_features(training_rows(rows, sample_size), counts, share)
    model = learn(drawn.select("features", "answer", "weight").collect())
    if model is None:
        scored = rows.withColumn("score", F.lit(0.0))
    else:
        featured = with_features(rows, counts, share)
        scored = featured.withColumn("made", boosting.scoring(model, F.col("features")))
        scored = hold(scored, "made", "score")
    judged = F.when(F.col("score") >= BLOCK_FROM, "block").otherwise("allow")
    verdict = (
        F.when(F.col("answer") == 1, "block").when(F.col("answer") == 0, "allow").otherwise(judged)
    )
    return scored.select("row.*", "host", "path", "rule", verdict.alias("verdict"), "score")
