"""Byte-level BPE as a monoid: halves of a text are encoded on their own and joined.

A text is cut in halves down to leaves. Two encoded neighbours are joined by re-encoding a window
around the seam. The window grows to both sides until it ends at hard borders: places where, whatever
stands before or after, the splitting pattern must end one match and begin another. No token crosses
such a place, so the tokens outside the window are those of the joined text. Decoding concatenates the
tokens' bytes up the same tree.

Hard borders: before white space that follows another character (in the pattern, white space begins
matches or fills them, it never continues one), and before punctuation that follows a letter (a letter
is followed by letters only).

Defined cases: a null text is empty and has no tokens; texts of any length are encoded whole, a text
without a hard border near its seam by a window as large as needed; repeated rows give equal rows; an
empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell.llm.staging import small_batches

# Code points of a leaf, and of the first window on either side of a seam.
LEAF = 4096
WINDOW = 32
SPACES = frozenset(" \t\n\x0b\x0c\r")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _hard(before: str, after: str) -> bool:
    if after in SPACES:
        return not before.isspace()
    return unicodedata.category(before)[0] == "L" and unicodedata.category(after)[0] == "P"


def last_border(text: str) -> int:
    """The last hard border inside text, found in growing windows from its end; 0 if there is none."""
    high, width = len(text), WINDOW
    while high > 1:
        low = max(1, len(text) - width)
        for i in range(high - 1, low - 1, -1):
            if _hard(text[i - 1], text[i]):
                return i
        high, width = low, 2 * width
    return 0


def first_border(text: str) -> int:
    """The first hard border inside text; its length if there is none."""
    for i in range(1, len(text)):
        if _hard(text[i - 1], text[i]):
            return i
    return len(text)


class TreeCodec:
    """Encodes and decodes by tree reduction; leaves and windows by the rank file's encoder."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF) -> None:
        import tiktoken

        self.plain = tiktoken.Encoding("tree", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.leaf = leaf

    def _flat(self, text: str) -> np.ndarray:
        return self.plain.encode_to_numpy(text, disallowed_special=())

    def encode(self, text: str) -> np.ndarray:
        """Token ids of the whole text."""
        if len(text) <= self.leaf:
            return self._flat(text)
        middle = len(text) // 2
        left, right = text[:middle], text[middle:]
        return self.join(left, self.encode(left), right, self.encode(right))

    def join(self, left: str, left_ids: np.ndarray, right: str, right_ids: np.ndarray) -> np.ndarray:
        """Ids of left + right from the ids of both."""
        if not left or not right:
            return left_ids if left else right_ids
        tail, head = left[last_border(left) :], right[: first_border(right)]
        kept = len(left_ids) - len(self._flat(tail))
        skipped = len(self._flat(head))
        return np.concatenate([left_ids[:kept], self._flat(tail + head), right_ids[skipped:]])

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the ids, concatenated up the tree."""
        if len(ids) <= self.leaf:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


def encode_texts(docs: DataFrame, path: str, pattern: str, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(ident, ids): the ids as little-endian unsigned 32-bit integers in one binary value."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = TreeCodec(read_ranks(path), pattern)
        for batch in batches:
            ids = [codec.encode(t.as_py() or "").astype("<u4").tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["ident", "ids"])

    kind = docs.schema[ident].dataType.simpleString()
    return docs.select(F.col(ident).alias("ident"), F.col(text).alias("text")).mapInArrow(
        run, f"ident {kind}, ids binary"
    ).withColumnRenamed("ident", ident)


def decode_ids(encoded: DataFrame, path: str, pattern: str, ident: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(ident, ids, decoded): the bytes that the ids stand for."""
    small_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = TreeCodec(read_ranks(path), pattern)
        for batch in batches:
            raw = [codec.decode(np.frombuffer(x.as_py(), dtype="<u4").tolist()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(raw, pa.binary())], names=["ident", "ids", "decoded"]
            )

    kind = encoded.schema[ident].dataType.simpleString()
    return encoded.select(F.col(ident).alias("ident"), F.col(ids).alias("ids")).mapInArrow(
        run, f"ident {kind}, ids binary, decoded binary"
    ).withColumnRenamed("ident", ident)


def codec_report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document: number and digest of its ids, digest of what they decode to."""
    decoded = decode_ids(encode_texts(docs, path, pattern), path, pattern)
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids, n_tokens and the text that the ids decode to."""
    decoded = decode_ids(encode_texts(docs, path, pattern), path, pattern)
    return decoded.select(
        "doc_id", "ids", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.decode("decoded", "UTF-8").alias("text"),
    )
