"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Long texts are cut before encoding where the split pattern ends a match in any case: between a character that is no
white space and a following blank or line feed. No alternative of the pattern goes on over white space once it
has taken something else, none looks back, and the one that looks ahead stands in white space only, so the
pieces' ids are the text's ids. A run without such a place stays whole.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnsmith.llm.text import blocks

#: Texts longer than this (code points) are encoded in pieces of about this size.
PIECE_CHARS = 65_536
#: Rows that are decoded at a time.
ROWS = 256
_SAFE = regex.compile(r"(?<=[^\s\x1c-\x1f\x85])[ \n]")


def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The encoder of a rank file: a line holds a token in base64 and its id."""
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text cut at safe places, about ``size`` characters apart."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def _lists(values: list[list[int]]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.fromiter(chain.from_iterable(values), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def encode(docs: DataFrame, rank_file: str, pattern: str, text_column: str = "text", ids_column: str = "ids",
           bytes_column: str | None = None) -> DataFrame:
    """The rows with one more column: the token ids of the whole text, an array of ints. ``bytes_column`` names another, the bytes
    that these ids decode to (as ``decode`` gives them): both in one pass, with one encoder and one Python worker a task.

    No special tokens; each match of the pattern is merged on its own. A null or empty text has an empty array.
    Repeated rows and null ids stay; an empty table stays empty. A column that has the new one's name is replaced.
    """
    docs = docs.drop(ids_column, *([bytes_column] if bytes_column else []))
    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(rank_file, pattern)
        for batch in blocks(batches, text_column):  # ids are Python objects for one block at a time
            ids = [[t for p in pieces(text) for t in encoder.encode_ordinary(p)] if text and len(text) > PIECE_CHARS
                   else encoder.encode_ordinary(text or "") for text in batch.column(place).to_pylist()]
            made = {ids_column: _lists(ids)}
            if bytes_column:
                made[bytes_column] = pa.array([encoder.decode_bytes(x) for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, *made.values()], names=[*batch.schema.names, *made])

    return docs.mapInArrow(run, _with(docs, **{ids_column: "array<int>"}, **({bytes_column: "binary"} if bytes_column else {})))


def decode(docs: DataFrame, rank_file: str, pattern: str, ids_column: str = "ids", bytes_column: str = "decoded") -> DataFrame:
    """The rows with one more column: the bytes of the token ids. A null array gives null.

    Bytes, not text: ids cut anywhere need not end a character. An id that the ranks lack fails the job. A column that
    has the new one's name is replaced.
    """
    docs = docs.drop(bytes_column)
    place = docs.columns.index(ids_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(rank_file, pattern)
        for batch in (b.slice(low, ROWS) for b in batches for low in range(0, b.num_rows, ROWS)):
            column = batch.column(place)
            column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
            out = [None if not x.is_valid else encoder.decode_bytes(x.values.to_numpy().tolist()) for x in column]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())],
                                             names=[*batch.schema.names, bytes_column])

    return docs.mapInArrow(run, _with(docs, **{bytes_column: "binary"}))


def _with(docs: DataFrame, **kinds: str):
    return docs.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]).schema
