"""Quality rules with thresholds adapted to each language and source.

Every document gets counts of words, symbols, repeated lines and repeated 8-word windows.
Rates made of them are sketched per language and source.  The sketch is a histogram over
log-linear bins (relative width 1/16), kept as rows (group, measure, bin, count): sketches of
parts merge by adding counts, in any order and with the same result, so that a lost executor or
another split of the input changes nothing.  Quantiles of the sketch give each group its fences;
the fences are joined back and filter the documents.  Into every group's sketch, whatever its size, its language's is merged
with the weight of ``prior`` documents: a handful of documents is judged much like its language, some
dozens by what they are themselves, and nothing changes at any one size.

Everything runs on DataFrame functions.

Defined cases: a null text counts as empty; empty texts have 0 words and fail the base rule; texts of any
length are measured whole, in the memory of one row.  Null languages or sources form groups of their own.
Repeated rows are judged alike, each by itself.  An empty table gives an empty result.  Other columns are
ignored by ``quality_verdicts`` and kept by ``keep_good``, whatever their names and types.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linetally.llm.names import quoted
from linetally.llm.store import stored

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
GROUP = ["lang", "source"]

# Rates of a document, in whole thousandths so that all engines bin them alike.  Repeated words have
# no fence: good documents come close to the base rule's limit, below which a fence would have to lie.
RATES = {
    "symbol_rate": ("n_symbols", "word_chars"),
    "dup_line_rate": ("n_dup_lines", "n_lines"),
    "word_length": ("word_chars", "n_words"),
}
TWO_SIDED = ("word_length",)
SUB_BITS = 4


@dataclass(frozen=True)
class Fences:
    """The upper fence of a rate is its median + ``spread`` * (upper - lower quartile) + slack.

    Quartiles stand still while less than a quarter of a group is bad.  The slack (thousandths)
    keeps groups of nearly equal documents from rejecting each other over trifles.
    """

    spread: int = 6
    slack: tuple[tuple[str, int], ...] = (
        ("symbol_rate", 50),
        ("dup_line_rate", 500),
        ("word_length", 1500),
    )
    prior: int = 20


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, whatever the optimizer merges."""
    return F.transform(F.array(value), body)[0]


def _covered(places: Column) -> Column:
    """Words covered by windows that start at these ascending places."""
    widths = F.transform(
        places, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(places, j + 1), p + WINDOW) - p)
    )
    return F.aggregate(widths, F.lit(0).cast("bigint"), lambda total, w: total + w)


def _repeat_words(words: Column) -> Column:
    """Words in windows whose words occur as a window at least twice in the text."""

    def count(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.cast("bigint").alias("i"))))

        def places(ranked: Column) -> Column:
            twins = F.filter(
                ranked,
                lambda x, j: F.coalesce(x["h"] == F.get(ranked, j - 1)["h"], F.lit(False))
                | F.coalesce(x["h"] == F.get(ranked, j + 1)["h"], F.lit(False)),
            )
            return _let(F.array_sort(F.transform(twins, lambda x: x["i"])), _covered)

        unique = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(unique, F.lit(0).cast("bigint")).otherwise(_let(placed, places))

    starts = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("bigint")).otherwise(_let(hashes, count))


def _text_counts(text: Column) -> Column:
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(WORD)))
    long = F.length(text).cast("bigint")

    def without(pattern: str) -> Column:
        return F.length(F.regexp_replace(text, pattern, "")).cast("bigint")

    of_words = _let(
        words,
        lambda w: F.struct(F.size(w).cast("bigint").alias("n"), _repeat_words(w).alias("repeats")),
    )
    of_lines = _let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("bigint").alias("n"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("dups"),
        ),
    )
    return F.struct(
        of_words.alias("words"),
        of_lines.alias("lines"),
        without(r"[\x20\x09-\x0D]+").alias("word_chars"),
        (long - without(SYMBOLS)).alias("n_symbols"),
    )


def text_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs plus a struct ``measures``: the counts and ``base_failed``."""
    counts = _text_counts(F.coalesce(F.col(text), F.lit("")))

    def named(c: Column) -> Column:
        n, repeats = c["words"]["n"], c["words"]["repeats"]
        failed = (n < MIN_WORDS) | (repeats * 100 > n * MAX_REPEAT_PERCENT)
        return F.struct(
            n.alias("n_words"),
            c["word_chars"].alias("word_chars"),
            c["n_symbols"].alias("n_symbols"),
            c["lines"]["n"].alias("n_lines"),
            c["lines"]["dups"].alias("n_dup_lines"),
            repeats.alias("n_repeat_words"),
            failed.alias("base_failed"),
        )

    return docs.withColumn("measures", _let(counts, named))


def _rate(name: str) -> Column:
    part, whole = RATES[name]
    return F.coalesce(F.call_function("div", F.col(part) * 1000, F.nullif(F.col(whole), F.lit(0))), F.lit(0))


def _bin(value: Column) -> Column:
    """The log-linear bin of a whole number: its leading bits, the rest cut off.

    The bin is named by its smallest member.
    """
    shift = F.greatest(F.length(F.bin(value)) - (SUB_BITS + 1), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def rate_sketches(measured: DataFrame) -> DataFrame:
    """Sketches (lang, source, rate, bin, n) of the documents that pass the base rule."""
    rates = F.explode(
        F.array(*[F.struct(F.lit(name).alias("rate"), _bin(_rate(name)).alias("bin")) for name in RATES])
    )
    return (
        measured.where(~F.col("base_failed"))
        .select(*GROUP, rates.alias("r"))
        .groupBy(*GROUP, "r.rate", "r.bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merge_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    return sketches.groupBy(*keys, "rate", "bin").agg(F.sum("n").alias("n"))


def _exact(name: str) -> Column:
    """Counts of two sketches are multiplied, which may take more than 64 bits."""
    return F.col(name).cast("decimal(19,0)")


def with_prior(sketches: DataFrame, prior: int) -> DataFrame:
    """Sketches of languages and sources, each with its language's as if by ``prior`` more documents.

    A bin's weight is n * N + prior * m, with n documents of the group, m and N of the language in the
    bin and in all: whole numbers, so that quantiles do not depend on rounding.
    """
    of_lang = merge_sketches(sketches, ["lang"]).withColumnsRenamed({"n": "m", "lang": "of_lang"})
    totals = of_lang.groupBy("of_lang", "rate").agg(F.sum("m").alias("total"))
    groups = sketches.select(*GROUP, "rate").distinct()

    def in_lang(rows: DataFrame, wider: DataFrame) -> DataFrame:
        same = F.col("lang").eqNullSafe(F.col("of_lang")) & (rows["rate"] == wider["rate"])
        return rows.join(wider, same).drop("of_lang").drop(wider["rate"])

    own = in_lang(sketches, totals).select(*GROUP, "rate", "bin", (_exact("n") * _exact("total")).alias("n"))
    added = in_lang(groups, of_lang).select(
        *GROUP, "rate", "bin", (_exact("m") * F.lit(prior).cast("decimal(19,0)")).alias("n")
    )
    return merge_sketches(own.unionByName(added), GROUP)


def sketch_fences(sketches: DataFrame, keys: list[str], fences: Fences) -> DataFrame:
    """One row per group with the fences low_<rate> and high_<rate>.

    A group has at most a few hundred bins per rate, whatever it holds.
    """
    from pyspark.sql import Window

    names = [*keys, "rate"]
    ordered = Window.partitionBy(*names).orderBy("bin")
    ranked = sketches.withColumn("upto", F.sum("n").over(ordered)).withColumn(
        "total", F.sum("n").over(Window.partitionBy(*names))
    )

    def quantile(quarter: int) -> Column:
        return F.min(F.when(F.col("upto") * 4 >= F.col("total") * quarter, F.col("bin")))

    slack = F.create_map(*[F.lit(x) for pair in fences.slack for x in pair])[F.col("rate")]
    reach = (F.col("q3") - F.col("q1")) * fences.spread + slack
    bounds = (
        ranked.groupBy(*names)
        .agg(quantile(1).alias("q1"), quantile(2).alias("q2"), quantile(3).alias("q3"))
        .select(*names, (F.col("q2") - reach).alias("low"), (F.col("q2") + reach).alias("high"))
    )
    columns = []
    for name in RATES:
        is_rate = F.col("rate") == name
        columns.append(F.max(F.when(is_rate, F.col("high"))).alias(f"high_{name}"))
        if name in TWO_SIDED:
            columns.append(F.max(F.when(is_rate, F.col("low"))).alias(f"low_{name}"))
    return bounds.groupBy(*keys).agg(*columns)


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[f"of_{key}"])
    return condition


def adaptive_fences(measured: DataFrame, fences: Fences = Fences()) -> DataFrame:
    """The fences of each language and source (as of_lang, of_source)."""
    sketches = stored(rate_sketches(measured), "rate-sketches")
    own = sketch_fences(with_prior(sketches, fences.prior), GROUP, fences)
    return own.withColumnsRenamed({k: f"of_{k}" for k in GROUP})


def _verdict() -> Column:
    """Within all fences.  A group without fences has no document that passes the base rule."""
    inside = ~F.col("base_failed")
    for name in RATES:
        inside = inside & (_rate(name) <= F.col(f"high_{name}"))
        if name in TWO_SIDED:
            inside = inside & (_rate(name) >= F.col(f"low_{name}"))
    return F.coalesce(inside, F.lit(False))


def _small(docs: DataFrame) -> DataFrame:
    return text_measures(docs).select("doc_id", *GROUP, "measures.*")


def quality_verdicts(docs: DataFrame, fences: Fences = Fences()) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed and kept.

    The texts are read once; only counts are written for the second pass.
    """
    measured = stored(_small(docs), "measures")
    bounds = stored(adaptive_fences(measured, fences), "fences")
    return measured.join(bounds, _same(measured, bounds, GROUP), "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        _verdict().alias("kept"),
    )


def keep_good(docs: DataFrame, fences: Fences = Fences()) -> DataFrame:
    """The documents that pass, with all their columns.

    The counts for the fences are written, as the optimizer would compute them anew in every
    filter on them.  Fences are small (one row per language and source), so that Spark joins them
    without moving texts.  Texts are measured again for the filter: storing them with their counts takes half the
    time, but most of an executor's memory.
    """
    bounds = stored(adaptive_fences(stored(_small(docs), "measures"), fences), "fences")
    whole = docs.select(F.struct(*map(quoted, docs.columns)).alias("doc"), "text", *GROUP)
    measured = text_measures(whole).select("doc", *GROUP, "measures.*")
    names = [F.col("doc")[name].alias(name) for name in docs.columns]
    return measured.join(bounds, _same(measured, bounds, GROUP), "left").where(_verdict()).select(*names)
