"""Secrets in texts: patterns for the common kinds, and structural confirmation for encoded ones.

Assignments, access keys and hex runs are reported as they match. A base64 or hex run that could be more than
noise is decoded, and reported only if its bytes parse: an ASN.1 key whose nested lengths fit exactly, an SSH key made of
length-prefixed fields, or a signed token whose header and body are JSON objects. Base64 is read in both alphabets, behind
``NAME=``, and over lines of any width from 24 on that are parted by line feeds or by their escapes, indented or not.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from returnsmith.llm.text import blocks

#: Kinds in the order that settles spans with one start.
KINDS = ("assign", "access", "hex", "token", "der", "ssh")
BASE_KINDS = KINDS[:3]

# The contract's patterns. Runs are greedy, so a minimum length in the pattern equals a later test.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_CHARS = 6

TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)(?![A-Za-z0-9_-])")
#: What parts the lines of a wrapped run: a line feed, or its escape in JSON and source texts, with indentation.
BREAK = re.compile(r"[ \t]*(?:(?:\\+r)?\\+n|\r\n?|\n)(?:[ \t]|\\+t)*")
#: Runs of each base64 alphabet, over the breaks of a wrapped block too. What stands before or after a key in such a run
#: is told apart by the lines at which the key's own lengths begin and end.
RUNS = tuple(re.compile(rf"(?<![{c}])[{c}]{{24,}}(?:{BREAK.pattern}[{c}]+)*={{0,2}}") for c in ("A-Za-z0-9+/", "A-Za-z0-9_-"))
ANY_HEX = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{48,}(?![0-9A-Fa-f])")
_CHEAP = re.compile(r"[A-Za-z0-9+/_-]{24}")
_KEY_TYPE = re.compile(rb"\0\0\0.(?:ssh|ecdsa|sk)-", re.DOTALL)
_OPENSSH = base64.b64encode(b"openssh-key-v1\0").decode()


def decoded(run: str) -> bytes | None:
    """The bytes of a base64 run (either alphabet, padding optional), or None."""
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(run) % 4 == 1:
        return None
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except binascii.Error:
        return None


def _der_items(body: bytes, low: int, high: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the elements that fill body[low:high] exactly, or None."""
    out = []
    while low < high:
        if low + 2 > high:
            return None
        tag, size, at = body[low], body[low + 1], low + 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > high or body[at] == 0:
                return None
            size = int.from_bytes(body[at:at + width], "big")
            if size < 0x80:
                return None
            at += width
        if at + size > high:
            return None
        out.append((tag, at, at + size))
        low = at + size
    return out


def is_der_key(body: bytes) -> bool:
    """One SEQUENCE that fills the bytes, whose parts nest exactly and hold an integer and key material."""
    top = _der_items(body, 0, len(body))
    if not top or len(top) != 1 or top[0][0] != 0x30 or top[0][2] - top[0][1] < 14:
        return False
    parts = _der_items(body, top[0][1], top[0][2])
    if not parts or len(parts) < 2:
        return False
    nested, held = list(parts), {t for t, _, _ in parts}
    while nested:
        tag, low, high = nested.pop()
        if tag in (0x30, 0xA0, 0xA1):
            inner = _der_items(body, low, high)
            if inner is None:
                return False
            held |= {t for t, _, _ in inner}
            nested += inner
    return bool(held & {0x02, 0x06}) and bool(held & {0x02, 0x03, 0x04})


def is_ssh_key(body: bytes) -> bool:
    """An OpenSSH private key, or length-prefixed fields that fill the bytes and begin with a key type."""
    if body.startswith(b"openssh-key-v1\0"):
        at, names = 15, 0
        while names < 3 and at + 4 <= len(body):
            size = int.from_bytes(body[at:at + 4], "big")
            if at + 4 + size > len(body):
                return False
            at, names = at + 4 + size, names + 1
        return names == 3
    at, fields = 0, []
    while at < len(body):
        size = int.from_bytes(body[at:at + 4], "big")
        if at + 4 > len(body) or at + 4 + size > len(body):
            return False
        fields.append(body[at + 4:at + 4 + size])
        at += 4 + size
    return len(fields) >= 2 and re.match(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+$", fields[0]) is not None


def _size_at(symbols: str, low: int, at: int) -> int | None:
    """The four-byte number at byte ``at`` of what is encoded from ``low`` on."""
    low += at // 3 * 4
    body = (decoded(symbols[low:low + 8]) or b"")[at % 3:at % 3 + 4]
    return int.from_bytes(body, "big") if len(body) == 4 else None


def _skip(symbols: str, low: int, at: int, fields: int = 1) -> int | None:
    """The byte after so many length-prefixed fields, or None if they do not fit."""
    for _ in range(fields):
        size = _size_at(symbols, low, at)
        if size is None or at + 4 + size > (len(symbols) - low) * 3 // 4:
            return None
        at += 4 + size
    return at


def _key_at(symbols: str, low: int, ends: list[int]) -> tuple[str, int] | None:
    """(kind, last line) of the key that begins at ``low`` and ends with a line, or None; only as much as it claims is decoded."""
    def line(size: int) -> int | None:
        high = low - (-size * 4 // 3)
        at = bisect_left(ends, high)
        return at if at < len(ends) and ends[at] == high else None

    head = decoded(symbols[low:low + 16]) or b""
    if head[:1] == b"\x30" and len(head) >= 6:
        width = head[1] & 0x7F if head[1] & 0x80 else 0
        size = 2 + width + (int.from_bytes(head[2:2 + width], "big") if width else head[1])
        at = line(size) if width <= 4 else None
        if at is not None and is_der_key(decoded(symbols[low:ends[at]]) or b""):
            return "der", at
    elif _KEY_TYPE.match(head):
        at, fields, found = _skip(symbols, low, 0), 1, None
        while at is not None and (at := _skip(symbols, low, at)) is not None:
            fields += 1
            if (last := line(at)) is not None:
                found = last
                if _KEY_TYPE.match(decoded(symbols[ends[last]:ends[last] + 16]) or b""):
                    break  # the next line is a key of its own
        if found is not None and is_ssh_key(decoded(symbols[low:ends[found]]) or b""):
            return "ssh", found
    elif symbols.startswith(_OPENSSH, low):
        at = _skip(symbols, low, 15, 3)
        if at is None:
            return None
        sealed = re.search(r"gcm|poly1305", (decoded(symbols[low:low + 80]) or b"").decode("latin-1")) is not None
        after = _skip(symbols, low, at + 4, (_size_at(symbols, low, at) or 0) + 1)
        if after is None:
            return "ssh", len(ends) - 1  # a key cut off: all of the run
        return "ssh", min(len(ends) - 1, bisect_left(ends, low - (-(after + 16 * sealed) * 4 // 3)))
    return None


def _encoded_keys(text: str, runs: re.Pattern) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of the base64 keys in the text that begin and end with a line of a run."""
    for m in runs.finditer(text):
        run = m[0].rstrip("=")
        breaks = [b.span() for b in BREAK.finditer(run)] if "\n" in run or "\r" in run or "\\" in run else []
        starts = [0, *(b for _, b in breaks)]
        stops = [*(a for a, _ in breaks), len(run)]
        if m.start() and text[m.start() - 1] == "\\" and run[0] in "nrt":
            starts[0] = 1  # the letter of an escape
        symbols = "".join(run[a:b] for a, b in zip(starts, stops, strict=True))
        ends = list(accumulate(b - a for a, b in zip(starts, stops, strict=True)))
        i = 0
        while i < len(ends):
            found = _key_at(symbols, ends[i - 1] if i else 0, ends)
            if found:
                kind, last = found
                yield kind, m.start() + starts[i], m.end() if last == len(ends) - 1 else m.start() + stops[last]
                i = last
            i += 1


def is_signed_token(header: str, body: str) -> bool:
    """Header and body decode to JSON objects, and the header names an algorithm."""
    try:
        head, claims = (json.loads((decoded(x) or b"").decode()) for x in (header, body))
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(claims, dict)


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed, then end."""
    if not text:
        return []
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_CHARS]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    if "eyJ" in text:
        out += [("token", m.start(), m.end()) for m in TOKEN.finditer(text) if is_signed_token(m[1], m[2])]
    if _CHEAP.search(text):
        keys: dict[tuple[str, int], int] = {}
        for kind, start, end in (k for runs in RUNS for k in _encoded_keys(text, runs)):
            keys[kind, start] = max(end, keys.get((kind, start), 0))  # the other alphabet may see a part of it only
        out += [(kind, start, end) for (kind, start), end in keys.items()]
        for m in ANY_HEX.finditer(text):
            if len(m[0]) % 2 == 0 and is_der_key(bytes.fromhex(m[0])):
                out.append(("der", m.start(), m.end()))
    return sorted(set(out), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redact(text: str, found: list[tuple[str, int, int]], mark: str) -> str:
    """The text with each united span replaced by the mark."""
    out, at = [], 0
    for _, start, end in sorted(found, key=lambda s: s[1]):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPAN = "array<struct<kind:string,start:int,end:int>>"


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", mark: str | None = None) -> DataFrame:
    """(id, spans) of every row, or with ``mark`` (id, spans, clean): the text with its secrets replaced.

    A null or empty text has no spans; a null text stays null when cleaned. Repeated rows and rows with a null id
    each give a row. Whole texts are searched; other columns are not looked at. An empty table gives none.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in blocks(batches):
            texts = batch.column("text").to_pylist()
            found = [spans(t) for t in texts]
            columns = [batch.column("id"), pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in f] for f in found], kind)]
            if mark is not None:
                columns.append(pa.array([redact(t, f, mark) if f else t for t, f in zip(texts, found, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["id", "spans", "clean"][:len(columns)])

    source = docs.selectExpr(f"`{id_column}` id", f"`{text_column}` text")
    schema = f"id {source.schema['id'].dataType.simpleString()}, spans {SPAN}" + ", clean string" * (mark is not None)
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_column)


def clean(docs: DataFrame, text_column: str = "text", mark: str = "[secret]") -> DataFrame:
    """The rows with the secrets in their texts replaced by the mark, all other columns as they are.

    A null text stays null, an empty one empty; repeated rows and rows with a null id each give their row. An empty table gives none.
    """
    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, place):
            texts = [redact(t, f, mark) if t and (f := spans(t)) else t for t in batch.column(place).to_pylist()]
            columns = list(batch.columns)
            columns[place] = pa.array(texts, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
