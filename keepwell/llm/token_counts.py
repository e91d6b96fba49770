"""Exact token counts of every prefix by dynamic programming over last tokens.

In byte pair encoding a sequence of tokens is the encoding of its bytes exactly if every two
neighbours, taken alone, encode to themselves. So the encoding of a prefix ends in the one token whose
own prefix's encoding ends in a token that it can follow, and

    count[i] = count[i - length of last[i]] + 1.

One pass over a piece of text gives the count of every prefix. Pieces are what the splitting pattern
matches; counts of pieces add up. A table of the counts of all prefixes then answers how many tokens
the first n characters have, and where a text must end to keep a budget, without encoding again.

Defined cases: a null text is empty and has 0 tokens; the special string counts as one token wherever
it stands, as the library does by default; texts are counted whole, whatever their length; repeated rows give
equal rows; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import json
import os
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.staging import small_batches

# Pieces, and pairs of neighbours, that a Python worker remembers; beyond that it starts anew.
REMEMBERED = 800_000
# Pieces before a place that are looked at again when a prefix ends there.
SETTLED = 3


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes for themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    rest = [b for b in range(256) if b not in set(printable)]
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter(dict):
    """Token counts of pieces, remembered by piece: self[piece]."""

    def __init__(self, path: str, pattern: str) -> None:
        super().__init__()
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        letters = byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        self.rank = {}  # of what two tokens merge into
        for i, merge in enumerate(told["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.rank.setdefault(as_bytes(a) + as_bytes(b), i)
        self.tokens = {*self.rank, *(bytes([b]) for b in range(256))}
        self.specials = [t["content"] for t in told["added_tokens"]]
        self.split_specials = regex.compile("|".join(map(regex.escape, self.specials)) or "(?!)")
        self.pieces_of = regex.compile(pattern).findall
        self.find_pieces = regex.compile(pattern).finditer
        self.follows: dict[tuple[bytes, bytes], bool] = {}

    def _alone(self, data: bytes) -> list[bytes]:
        """Encoding of a few bytes by merging the best pair again and again."""
        parts = [data[i : i + 1] for i in range(len(data))]
        rank, none = self.rank, len(self.rank)
        while len(parts) > 1:
            ranks = [rank.get(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def counts(self, data: bytes) -> list[int]:
        """Tokens of data[:i] for every i."""
        last, count = [b""], [0]
        start = 0
        for end in range(1, len(data) + 1):
            # mostly the last token grows by a byte or a new one begins; only one start can be right
            if not self._ends(last[start], data[start:end]):
                tried, start = start, end - 1
                while start == tried or not self._ends(last[start], data[start:end]):
                    start -= 1
            last.append(data[start:end])
            count.append(count[start] + 1)
        return count

    def _ends(self, before: bytes, token: bytes) -> bool:
        """Whether token can come last after a prefix that ends in `before`."""
        if token not in self.tokens:
            return False
        known = self.follows.get((before, token))
        if known is None:
            if len(self.follows) >= REMEMBERED:
                self.follows.clear()
            known = self.follows[before, token] = self._alone(before + token) == ([before, token] if before else [token])
        return known

    def __missing__(self, piece: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        n = self[piece] = self.counts(piece.encode())[-1]
        return n

    def table(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The prefix table at the borders of pieces: code points and tokens up to each, from 0 and 0 on."""
        lengths, counts = [0], [0]
        at = 0
        for found in [*self.split_specials.finditer(text), None]:
            pieces = self.pieces_of(text[at : found.start()] if found else text[at:])
            lengths += map(len, pieces)
            counts += map(self.__getitem__, pieces)
            if found:
                lengths.append(found.end() - found.start())
                counts.append(1)
                at = found.end()
        return np.cumsum(lengths), np.cumsum(counts)

    def longest(self, text: str, table: tuple[np.ndarray, np.ndarray], budget: int) -> int:
        """Code points of the longest prefix of text with at most `budget` tokens.

        Every piece has a token at least, so the answer lies in or right behind the last piece that begins within
        the budget. Only there the counts inside pieces are worked out.
        """
        ends, counts = table
        if counts[-1] <= budget:
            return len(text)
        if self.split_specials.search(text):
            return fits(self.prefix_counts(text), budget)
        k = int(np.searchsorted(counts, budget, side="left"))
        # an end of a prefix can change the pieces of white space just before it
        first = max(0, k - SETTLED)
        last = min(len(ends) - 1, k + 1)
        inside = np.full(int(ends[last]) + 1, np.iinfo(np.uint32).max, dtype=np.uint32)
        self._fill(text, int(ends[first]), int(ends[last]), int(counts[first]), inside)
        return fits(inside, budget)

    def prefix_counts(self, text: str) -> np.ndarray:
        """Tokens of text[:i] for i = 0 .. len(text)."""
        out = np.zeros(len(text) + 1, dtype=np.uint32)
        base, at = 0, 0
        for found in [*self.split_specials.finditer(text), None]:
            end = found.start() if found else len(text)
            self._fill(text, at, end, base, out)
            base = int(out[end])
            if found:
                # inside the special string the prefix ends in ordinary text
                for i in range(found.start() + 1, found.end()):
                    out[i] = out[at] + sum(map(self.__getitem__, self.pieces_of(text[at:i])))
                base += 1
                out[found.end()] = base
                at = found.end()
        return out

    def _fill(self, text: str, start: int, stop: int, base: int, out: np.ndarray) -> None:
        """Counts of the prefixes that end in text[start:stop], a part without special strings."""
        done = settled = start  # settled: where the last piece began that no end of a prefix can change
        count = settled_count = base
        out[start] = base
        for match in self.find_pieces(text, start, stop):
            piece = match.group()
            if not piece.isspace():
                inner = self.counts(piece.encode())
                place = 0
                plain = not piece.startswith("'") and done == settled
                for k, ch in enumerate(piece, 1):
                    place += len(ch.encode())
                    if plain and not (k == 1 and ch == " "):
                        out[done + k] = count + inner[place]
                    else:
                        out[done + k] = settled_count + sum(
                            map(self.__getitem__, self.pieces_of(text[settled : done + k]))
                        )
                count += inner[-1]
                done = settled = match.end()
                settled_count = count
            else:
                for i in range(match.start() + 1, match.end() + 1):
                    out[i] = settled_count + sum(map(self.__getitem__, self.pieces_of(text[settled:i])))
                count += self[piece]
                done = match.end()


def _counter(path: str, pattern: str) -> PrefixCounter:
    """The worker's counter: kept from task to task while the file stays the same, so a piece is worked out once."""
    kept = vars(sys).setdefault("_token_counters", {})
    state = os.stat(path)
    key = (path, state.st_mtime_ns, state.st_size, pattern)
    if key not in kept:
        kept.clear()
        kept[key] = PrefixCounter(path, pattern)
    return kept[key]


def fits(counts: np.ndarray, budget: int) -> int:
    """Length of the longest prefix with at most `budget` tokens."""
    return int(np.flatnonzero(counts <= budget)[-1])


def count_tokens(
    docs: DataFrame, path: str, pattern: str, budget: int, ident: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(ident, n_bytes, n_chars, n_tokens, fit_chars) of every whole text, from its prefix table.

    n_tokens: the table's last count; fit_chars: code points of the longest prefix with at most `budget` tokens.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, pattern)
        for batch in batches:
            sizes, totals, fitting = [], [], []
            for value in batch.column(2):
                text = value.as_py() or ""
                table = counter.table(text)
                sizes.append(len(text))
                totals.append(int(table[1][-1]))
                fitting.append(counter.longest(text, table, budget))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(v, pa.int64()) for v in (sizes, totals, fitting))],
                names=["ident", "n_bytes", "n_chars", "n_tokens", "fit_chars"],
            )

    kind = docs.schema[ident].dataType.simpleString()
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    return docs.select(F.col(ident).alias("ident"), size.alias("n_bytes"), F.col(text).alias("text")).mapInArrow(
        run, f"ident {kind}, n_bytes long, n_chars long, n_tokens long, fit_chars long"
    ).withColumnRenamed("ident", ident)


def prefix_table(docs: DataFrame, path: str, pattern: str, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(ident, counts): tokens of the first 0, 1, 2 ... code points, as 32-bit integers in one binary value."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, pattern)
        for batch in batches:
            tables = [counter.prefix_counts(t.as_py() or "").astype("<u4").tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tables, pa.binary())], names=["ident", "counts"])

    kind = docs.schema[ident].dataType.simpleString()
    return docs.select(F.col(ident).alias("ident"), F.col(text).alias("text")).mapInArrow(
        run, f"ident {kind}, counts binary"
    ).withColumnRenamed("ident", ident)


LIMIT = 1024


def count_report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: bytes, tokens, whether a prefix of LIMIT tokens leaves something over, and that prefix's code points."""
    return count_tokens(docs, path, pattern, LIMIT).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("fit_chars") < F.col("n_chars")).alias("over_limit"), "fit_chars"
    )
