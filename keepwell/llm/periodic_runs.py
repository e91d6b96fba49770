"""Periodic runs of words, by recursive frequency splitting and a lag scan.

A run is a stretch of words with smallest period q, at least COPIES * q and at least LEAST words long, which
no word beside it prolongs. Every word of a run therefore stands in it COPIES times or more. So a segment (at
first the whole text) is split at all words that occur less often in it; the pieces are segments of their
own, in which words occur less often than before, and are split again until nothing changes. In common text nothing
is left after a few rounds. What survives is scanned for every lag q: a run of period q makes at least
three adjacent multiples of q agree with the word q further on, so only those places are looked at first,
n / q of them for a lag.

Splitting works on all texts of a batch at once, and a round handles only segments that changed.

Defined cases: null and empty texts have no words and no runs; rows stand for themselves, also repeated
ones; very long texts are handled whole, in time of about n log n; of equally long runs none is preferred here;
an empty table gives an empty result; other columns are not looked at. Words are runs of characters other
than space and \\x09-\\x0D and are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.staging import small_batches
from keepwell.llm.words import text_buffer, words_of

COPIES = 4
LEAST = 6
WORD = r"[^\x20\x09-\x0D]+"
# The texts of one id in so many get a planted loop, see looped().
LOOP_EVERY = 10


def surviving_segments(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the segments in which every word occurs COPIES times or more.

    words: hashes of all texts' words, text i's from at[i] to at[i + 1].
    """
    starts, ends = at[:-1].astype(np.int64), at[1:].astype(np.int64)
    stable: list[tuple[np.ndarray, np.ndarray]] = []
    while len(starts):
        long_enough = ends - starts >= LEAST
        starts, ends = starts[long_enough], ends[long_enough]
        sizes = ends - starts
        segment = np.repeat(np.arange(len(starts)), sizes)
        place = np.arange(len(segment)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)
        often = _often(segment, words[place])
        changed = np.zeros(len(starts), dtype=bool)
        changed[segment[~often]] = True
        stable.append((starts[~changed], ends[~changed]))
        held = often & changed[segment]
        place, segment = place[held], segment[held]
        new = np.ones(len(place), dtype=bool)
        new[1:] = (place[1:] != place[:-1] + 1) | (segment[1:] != segment[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(place))[: len(first)] - 1
        starts, ends = place[first], place[last] + 1
    if not stable:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([s for s, _ in stable]), np.concatenate([e for _, e in stable])


def _often(segment: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Whether each word occurs COPIES times or more in its segment."""
    order = np.lexsort((words, segment))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (segment[order[1:]] != segment[order[:-1]]) | (words[order[1:]] != words[order[:-1]])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(order)))
    out = np.empty(len(order), dtype=bool)
    out[order] = np.repeat(counts >= COPIES, counts)
    return out


def _agreeing(words: np.ndarray, lag: int, place: int) -> tuple[int, int]:
    """The widest range of places around `place` whose words agree with those `lag` further on."""
    n = len(words) - lag
    hi, step = place + 1, 64
    while hi < n:
        other = np.flatnonzero(words[hi : min(hi + step, n)] != words[hi + lag : min(hi + step, n) + lag])
        if len(other):
            hi += int(other[0])
            break
        hi, step = min(hi + step, n), 2 * step
    lo, step = place, 64
    while lo > 0:
        from_ = max(lo - step, 0)
        other = np.flatnonzero(words[from_:lo] != words[from_ + lag : lo + lag])
        if len(other):
            lo = from_ + int(other[-1]) + 1
            break
        lo, step = from_, 2 * step
    return lo, hi


def lag_scan(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, in order of start and period.

    Lags rise, so a stretch is found at its smallest period first; at a multiple it is the same stretch.
    """
    n = len(words)
    found: dict[tuple[int, int], int] = {}
    # end and period of the first run found over each place
    run_end = np.zeros(n, dtype=np.int64)
    run_period = np.zeros(n, dtype=np.int64)
    for lag in range(1, n // COPIES + 1):
        same = words[: n - lag : lag] == words[lag::lag]
        seeds = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * lag
        at = 0
        while at < len(seeds):
            place = int(seeds[at])
            period, end = int(run_period[place]), int(run_end[place])
            if period and lag % period == 0 and place + lag < end:
                at = int(np.searchsorted(seeds, end - lag))  # still inside a run known by a smaller period
                continue
            lo, hi = _agreeing(words, lag, place)
            stop = hi + lag
            if stop - lo >= max(LEAST, COPIES * lag) and (lo, stop) not in found:
                found[lo, stop] = lag
                free = run_period[lo:stop] == 0
                run_end[lo:stop][free] = stop
                run_period[lo:stop][free] = lag
            at = int(np.searchsorted(seeds, hi))
    return sorted((a, b - a, q) for (a, b), q in found.items())


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(ident, n_words, runs, collapsed) for every row.

    runs: (start, length, period) in words, by start and period. collapsed: the words joined by one space,
    without those that a run contains after its first period.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            words, _, _, at = words_of(*text_buffer(texts), fold_case=False)
            runs: list[list[dict]] = [[] for _ in range(len(texts))]
            dropped: dict[int, np.ndarray] = {}
            for a, b in zip(*surviving_segments(words, at), strict=True):
                i = int(np.searchsorted(at, a, side="right")) - 1
                for start, length, period in lag_scan(words[a:b]):
                    start += int(a - at[i])
                    runs[i].append({"start": start, "length": length, "period": period})
                    dropped.setdefault(i, np.zeros(at[i + 1] - at[i], dtype=bool))[start + period : start + length] = True
            collapsed = []
            for i, value in enumerate(texts):
                pieces = value.as_buffer().to_pybytes().split() if value.is_valid else []
                if i in dropped:
                    pieces = [pieces[k] for k in np.flatnonzero(~dropped[i])]
                    runs[i].sort(key=lambda r: (r["start"], r["period"]))
                collapsed.append(b" ".join(pieces).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(at)), pa.array(runs, pa.list_(RUN)), pa.array(collapsed, pa.string())],
                names=["ident", "n_words", "runs", "collapsed"],
            )

    rows = docs.select(F.col(ident).cast("long").alias("ident"), F.col(text).alias("text"))
    out = rows.mapInArrow(run, "ident long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return out.select(F.col("ident").alias(ident), "n_words", "runs", "collapsed")


def looped(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with a planted loop in some texts, so that corpora without repetition have some.

    Of h = crc32 of the id in decimal, h % LOOP_EVERY chooses the texts and g = h // LOOP_EVERY place and
    period: from word g % n on the text repeats its first p words from there. Without an id a text stays.
    """
    h = F.crc32(F.col(ident).cast("long").cast("string").cast("binary"))
    chosen = F.coalesce(F.pmod(h, F.lit(LOOP_EVERY)) == 0, F.lit(False)) & F.coalesce(F.col(text).rlike(WORD), F.lit(False))
    rows = docs.select(
        F.col(ident).alias("ident"), F.col(text).alias("text"), chosen.alias("chosen"), F.floor(h / LOOP_EVERY).alias("g")
    )
    start, period, n = F.col("start"), F.col("period"), F.col("n")
    # null, and so next to free, in the rows that stay
    words = rows.withColumn("words", F.when(F.col("chosen"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    sized = words.withColumn("n", F.when(F.col("chosen"), F.size("words").cast("long"))).withColumn("start", F.pmod("g", n))
    timed = sized.withColumn("period", 1 + F.floor((n - start) / (3 + F.pmod("g", F.lit(8)))))
    source = F.transform(
        F.sequence(F.lit(0).cast("long"), n - 1),
        lambda i: F.when(i < start, i).otherwise(start + F.pmod(i - start, period)),
    )
    loop = F.transform(source, lambda i: F.element_at("words", (i + 1).cast("int")))
    value = F.when(F.col("chosen"), F.array_join(loop, " ")).otherwise(F.col("text"))
    return timed.select(F.col("ident").alias(ident), value.alias(text))


def run_report(docs: DataFrame) -> DataFrame:
    """Runs of every document, some with a planted loop: their number, the longest one, and digests of all of them."""
    found = periodic_runs(looped(docs))
    # longest first, then the one that starts first; the least struct is the one sought
    ranked = F.transform("runs", lambda r: F.struct((-r.length).alias("less"), r.start.alias("start"), r.period.alias("period")))
    line = lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n"))
    best = F.col("best")
    return found.withColumn("best", F.array_min(ranked)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.start.alias("start"),
        (-best.less).alias("length"),
        best.period.alias("period"),
        F.floor(F.lit(1000) * -best.less / best.period).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
