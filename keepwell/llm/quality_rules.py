"""Quality rules with adaptive thresholds, in Spark expressions only.

Thresholds are not fixed numbers: each feature's distribution is kept per language and source
as a mergeable quantile sketch (logarithmic bins with their counts, relative error `ERROR`), and
a document is rejected when it lies far outside its own group's spread. Sketches of small groups
are merged with their language's, those with the whole corpus's.

Defined cases: a null text counts as empty; a document with fewer than MIN_WORDS words fails the
base rule; a null language or source is a group of its own; repeated rows are judged one by one
and alike; texts of any length are judged whole; an empty table gives an empty result. keep_good carries other columns
along whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.llm.staging import carried, stage

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
ERROR = 0.01
# Sketches over fewer documents than this are merged into the next wider group's.
MIN_GROUP = 50

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Feature:
    """A ratio, how many spreads from the median are normal, and the least spread to assume."""

    name: str
    top: str
    bottom: str
    width: float
    least_spread: float
    two_sided: bool = False

    def value(self) -> Column:
        return F.col(self.top) / F.greatest(F.col(self.bottom), F.lit(1))


FEATURES = (
    Feature("symbol_ratio", "n_symbols", "n_words", 3.0, 0.03),
    Feature("dup_line_ratio", "n_dup_lines", "n_lines", 3.0, 0.2),
    Feature("repeat_ratio", "n_repeat_words", "n_words", 3.0, 0.1),
    Feature("word_length", "word_chars", "n_words", 8.0, 0.3, two_sided=True),
)


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once, also where body uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _covered(windows: Column) -> Column:
    """Words inside windows that occur twice or more; windows: hash of the window at each position."""

    def from_sorted(pairs: Column) -> Column:
        same = lambda j, k: F.coalesce(F.get(pairs, j)["h"] == F.get(pairs, k)["h"], F.lit(False))
        flagged = F.filter(pairs, lambda p, j: same(j, j - 1) | same(j, j + 1))
        places = F.sort_array(F.transform(flagged, lambda p: p["i"]))
        return _let(
            places,
            lambda at: F.aggregate(
                F.transform(at, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - x, F.lit(WINDOW)))),
                F.lit(0),
                lambda total, n: total + n,
            ),
        )

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(_let(pairs, from_sorted))


def _word_metrics(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))

    def counted(words: Column) -> Column:
        hashes = F.transform(words, lambda w: F.xxhash64(w))
        windows = _let(
            hashes,
            lambda h: F.when(
                F.size(h) >= WINDOW,
                F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW))),
            ).otherwise(F.array().cast("array<bigint>")),
        )
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            _let(windows, _covered).cast("long").alias("n_repeat_words"),
        )

    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))
    return _let(words, counted)


def _line_metrics(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    return _let(
        lines,
        lambda kept: F.struct(
            F.size(kept).cast("long").alias("n_lines"),
            (F.size(kept) - F.size(F.array_distinct(kept))).cast("long").alias("n_dup_lines"),
        ),
    )


def with_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with one more struct column `_quality` holding METRICS, base_failed and the features' values."""
    plain = F.coalesce(F.col(text), F.lit(""))
    base = docs.withColumns(
        {
            "_quality_w": _word_metrics(plain),
            "_quality_l": _line_metrics(plain),
            "_quality_c": F.length(F.regexp_replace(plain, "[ \\t-\\r]+", "")).cast("long"),
            "_quality_s": F.length(F.regexp_replace(plain, "[^#*$%&|<>]+", "")).cast("long"),
        }
    )
    words, repeats = F.col("_quality_w.n_words"), F.col("_quality_w.n_repeat_words")
    return base.withColumn(
        "_quality",
        F.struct(
            words.alias("n_words"),
            F.col("_quality_c").alias("word_chars"),
            F.col("_quality_s").alias("n_symbols"),
            F.col("_quality_l.n_dup_lines").alias("n_dup_lines"),
            repeats.alias("n_repeat_words"),
            F.col("_quality_l.n_lines").alias("n_lines"),
            ((words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)).alias("base_failed"),
        ),
    ).drop("_quality_w", "_quality_l", "_quality_c", "_quality_s")


_GAMMA = (1 + ERROR) / (1 - ERROR)
_LEAST = 1e-6


def _bin(value: Column) -> Column:
    """Bin of a value in the sketch; bin -10000 holds what counts as zero."""
    return F.when(value < _LEAST, F.lit(-10000)).otherwise(F.ceil(F.log(value) / F.log(F.lit(_GAMMA))).cast("int"))


def _bin_value(number: Column) -> Column:
    return F.when(number == -10000, F.lit(0.0)).otherwise(2 * F.pow(F.lit(_GAMMA), number) / (_GAMMA + 1))


def sketches(judged: DataFrame) -> DataFrame:
    """(lang, source, feature, bin, n) of the documents that pass the base rule; adding n merges sketches."""
    features = F.array(*[F.struct(F.lit(f.name).alias("feature"), _bin(f.value()).alias("bin")) for f in FEATURES])
    return (
        judged.filter("not base_failed")
        .select("lang", "source", F.explode(features).alias("f"))
        .groupBy("lang", "source", "f.feature", "f.bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _quantiles(counts: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """One row for each key: {prefix}_n and the {prefix}_<feature> struct of quartiles."""
    merged = counts.groupBy(*keys, "feature", "bin").agg(F.sum("n").alias("n"))
    # a group's bins are as many as the sketch's resolution allows, whatever the number of documents
    series = merged.groupBy(*keys, "feature").agg(
        F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins"), F.sum("n").alias("total")
    )

    def quantile(q: float) -> Column:
        found = F.aggregate(
            F.col("bins"),
            F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("int").alias("bin")),
            lambda acc, b: F.struct(
                (acc["seen"] + b["n"]).alias("seen"),
                F.coalesce(acc["bin"], F.when(acc["seen"] + b["n"] >= q * F.col("total"), b["bin"])).alias("bin"),
            ),
        )
        return _bin_value(found["bin"])

    quartiles = series.select(
        *keys, "feature", "total",
        F.struct(quantile(0.25).alias("low"), quantile(0.5).alias("mid"), quantile(0.75).alias("high")).alias("q"),
    )
    return quartiles.groupBy(*keys).agg(
        F.max("total").alias(f"{prefix}_n"),
        *[F.max(F.when(F.col("feature") == f.name, F.col("q"))).alias(f"{prefix}_{f.name}") for f in FEATURES],
    )


def thresholds(counts: DataFrame) -> DataFrame:
    """(lang, source, <feature>_low, <feature>_high) for each group that has documents."""
    own = _quantiles(counts, ["lang", "source"], "own")
    wide = _quantiles(counts, ["lang"], "lang").withColumnRenamed("lang", "l")
    everything = _quantiles(counts.withColumn("everything", F.lit(1)), ["everything"], "all")
    joined = own.join(wide, own["lang"].eqNullSafe(wide["l"])).withColumn("everything", F.lit(1))
    joined = joined.join(everything, "everything")
    out = ["lang", "source"]
    for f in FEATURES:
        q = (
            F.when(F.col("own_n") >= MIN_GROUP, F.col(f"own_{f.name}"))
            .when(F.col("lang_n") >= MIN_GROUP, F.col(f"lang_{f.name}"))
            .otherwise(F.col(f"all_{f.name}"))
        )
        spread = f.width * F.greatest(q["high"] - q["low"], F.lit(f.least_spread))
        out.append((q["high"] + spread).alias(f"{f.name}_high"))
        out.append((q["low"] - spread if f.two_sided else F.lit(-1.0)).alias(f"{f.name}_low"))
    return joined.select(*out)


def verdicts(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", keep_text: bool = True
) -> DataFrame:
    """docs with the struct column `_quality` (METRICS, base_failed) and the boolean `_kept`.

    One pass over the texts; metrics are staged with the columns of docs, so pass only those that
    are needed afterwards. The thresholds, one row per language and source, are staged too: their
    size is then known and the planner broadcasts them only below its limit.
    """
    judged = stage(with_metrics(docs, text).drop(*([] if keep_text else [text])), "quality")
    flat = judged.select(F.col(lang).alias("lang"), F.col(source).alias("source"), "_quality.*")
    limits = stage(thresholds(sketches(flat)), "thresholds")
    limits = limits.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), F.struct(
        *[c for c in limits.columns if c not in ("lang", "source")]).alias("_limits"))
    joined = judged.join(limits, judged[lang].eqNullSafe(limits["_l"]) & judged[source].eqNullSafe(limits["_s"]), "left")

    def inside(f: Feature) -> Column:
        value = F.col(f"_quality.{f.top}") / F.greatest(F.col(f"_quality.{f.bottom}"), F.lit(1))
        return value.between(F.col(f"_limits.{f.name}_low"), F.col(f"_limits.{f.name}_high"))

    fits = reduce(lambda x, y: x & y, [inside(f) for f in FEATURES])
    kept = ~F.col("_quality.base_failed") & F.coalesce(fits, F.lit(True))
    return joined.withColumn("_kept", kept).drop("_l", "_s", "_limits")


def quality_report(docs: DataFrame) -> DataFrame:
    """Per document: the base metrics, whether the base rule failed, and whether it is kept."""
    judged = verdicts(docs.select("doc_id", "lang", "source", "text"), keep_text=False)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return judged.select("doc_id", *[F.col(f"_quality.{n}").alias(n) for n in names], F.col("_kept").alias("kept"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns, whatever these are called."""
    rows = carried(docs, text=F.col("text"), lang=F.col("lang"), source=F.col("source"))
    return verdicts(rows, keep_text=False).filter("_kept").select("row.*")  # the row holds its text
