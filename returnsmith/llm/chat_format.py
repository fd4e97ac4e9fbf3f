"""Conversations rendered to one text, encoded once, with a loss mask by offsets.

A turn is ``<turn ROLE>``, line feed, the text, ``</turn>``, line feed. In roles and texts ``\\`` becomes ``\\\\``, ``<`` becomes
``\\l`` and ``>`` becomes ``\\g`` (in roles a line feed becomes ``\\n``), so that no mark of the template occurs in them and
all is read back as it was. The whole text is encoded once with offsets; turn spans and token spans are both sorted, and a
binary search finds the tokens that meet an assistant's text. A token that reaches over an edge counts with the
part inside.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, processors

LOSS_ROLE = "assistant"
_TURN = re.compile(r"<turn ([^<>\n]*)>\n([^<>]*)</turn>\n")
_BACK = {"\\": "\\", "l": "<", "g": ">", "n": "\n"}


def escape(text: str, line_feeds: bool = False) -> str:
    text = text.replace("\\", "\\\\").replace("<", "\\l").replace(">", "\\g")
    return text.replace("\n", "\\n") if line_feeds else text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _BACK[m[1]], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and where each turn's text stands in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<turn {escape(role, True)}>\n", escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, "</turn>\n"]
        at += len(head) + len(body) + 8
    return "".join(out), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def masked_parts(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens meet a span, and rows (span, start, end) of each token's part in it; all lists ascend."""
    mask = np.zeros(len(starts), bool)
    parts = [np.zeros((0, 3), np.int32)]
    for k, (low, high) in enumerate(spans):
        a, b = np.searchsorted(ends, low, "right"), np.searchsorted(starts, high, "left")
        if a < b:
            mask[a:b] = True
            parts.append(np.stack([np.full(b - a, k), np.maximum(low, starts[a:b]), np.minimum(high, ends[a:b])], 1).astype(np.int32))
    return mask, np.concatenate(parts)


def loss_texts(formatted: str, parts: np.ndarray) -> list[str]:
    """The unescaped text under the mask, span by span; tokens that share a character give it once."""
    out: dict[int, list[str]] = {}
    at = 0
    for k, start, end in parts.tolist():
        piece = out.setdefault(k, [])
        piece.append(formatted[max(at, start):max(at, end)])
        at = max(at, end)
    return [unescape("".join(p)) for p in out.values()]


def tokenizer(path: str) -> Tokenizer:
    encoder = Tokenizer.from_file(path)
    encoder.encode_special_tokens = True  # their strings in a text are ordinary text
    encoder.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets with their leading blanks
    return encoder


#: Conversations that are held as Python objects at a time.
SLICE = 128


def _lists(values: list[np.ndarray], flat: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)]).astype(np.int32)), flat)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, SLICE):
            yield batch.slice(low, SLICE)


def format_chats(chats: DataFrame, tokenizer_file: str, loss_role: str = LOSS_ROLE) -> DataFrame:
    """(conv_id, formatted, ids, loss, parts) of every conversation, turns in order.

    ``loss`` marks the tokens that meet a text of ``loss_role``; ``parts`` are their places in ``formatted`` (code points).
    Turns are ordered by turn, then role and text, nulls first; equal rows all stay. A null role or text is empty. Rows without a
    conversation id are one conversation. Other columns are not looked at. An empty table gives none. A conversation
    is the unit of work: one is rendered in one task, all of them in as many as there are.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(tokenizer_file)
        for batch in _slices(batches):
            texts, ids, losses, places = [], [], [], []
            for turns in batch.column("turns").to_pylist():
                turns = [(t["role"] or "", t["text"] or "") for t in turns]
                formatted, spans = render(turns)
                encoded = encoder.encode(formatted, add_special_tokens=False)
                offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2)
                wanted = [k for k, (role, _) in enumerate(turns) if role == loss_role]
                mask, parts = masked_parts(offsets[:, 0], offsets[:, 1], [spans[k] for k in wanted])
                texts.append(formatted)
                ids.append(np.array(encoded.ids, np.int32))
                losses.append(mask)
                parts[:, 0] = np.array(wanted, np.int32)[parts[:, 0]]
                places.append(parts)
            flat = np.concatenate(places)
            struct = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, j])) for j in range(3)], names=["turn", "start", "end"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(texts, pa.string()), _lists(ids, pa.array(np.concatenate(ids))),
                 _lists(losses, pa.array(np.concatenate(losses))), _lists(places, struct)],
                names=["conv_id", "formatted", "ids", "loss", "parts"])

    grouped = chats.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    return grouped.mapInArrow(run, "conv_id bigint, formatted string, ids array<int>, loss array<boolean>, "
                                   "parts array<struct<turn:int,start:int,end:int>>")


def digests(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from the output alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            out = []
            for text, parts in zip(batch.column("formatted").to_pylist(), batch.column("parts"), strict=True):
                turns = read_back(text)
                rows = np.stack([parts.values.field(j).to_numpy() for j in range(3)], 1)
                loss = "".join(loss_texts(text, rows))
                whole = "".join(f"{role}\n{body}\n" for role, body in turns)
                out.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                            hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *(pa.array([r[j] for r in out], pa.string() if j in (1, 3)
                                              else pa.int64()) for j in range(5))], names=["conv_id", *names])

    return formatted.select("conv_id", "formatted", "parts").mapInArrow(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
