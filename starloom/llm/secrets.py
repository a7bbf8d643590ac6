"""Secrets in texts and in whatever is encoded inside them, by a worklist of decoded layers.

A text is the first layer.  Every layer is scanned by the same rules and searched for encoded
parts: lines with URL or Unicode escapes are decoded in place, base64 runs and compressed
streams become layers of their own.  The list is empty when no layer holds anything encoded
any more.  A layer keeps a function from its bytes to those of the layer that it came from, so
that whatever is found there leads back to a span of the text.  A layer with the bytes and the
span of an earlier one is a cycle and is not opened again.
"""

from __future__ import annotations

import binascii
import bz2
import lzma
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructType

KINDS = ("assign", "access", "hex")
# What counts as a secret; the first pattern reads texts in lower case.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")  # of 18 characters or more
HEX = re.compile(rb"[0-9a-f]{16,}")
LEAST_VALUE = 12  # characters of an assigned value

# One escape; a percent sign or backslash that is itself escaped any number of times is one, too.
ESCAPE = re.compile(rb"""%(?:25)*(?P<url>[0-9A-Fa-f]{2})|%(?:25)*u(?P<js>[0-9A-Fa-f]{4})
  |\\(?:u005[cC])*(?:u(?P<u>[0-9A-Fa-f]{4})|u\{(?P<braced>[0-9A-Fa-f]{1,6})\}|U(?P<long>[0-9A-Fa-f]{8})|x(?P<x>[0-9A-Fa-f]{2}))|\\(?P<quoted>["'/\\])
  |&\#[xX](?P<ref>[0-9A-Fa-f]{1,6});|&\#(?P<decimal>[0-9]{1,7});""", re.VERBOSE)
RUN = re.compile(rb"[A-Za-z0-9+/_-]{22,}={0,2}")  # 16 bytes: the least that can hold a secret
WRAPPED = re.compile(rb"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}+(?:\r?\n[A-Za-z0-9+/_-]++)+={0,2}")  # tried once a run
CONTROL = re.compile(rb"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
STREAM = re.compile(rb"\x1f\x8b\x08|BZh[1-9]1AY&SY|\xfd7zXZ\x00|\x28\xb5\x2f\xfd|\A\x78[\x01\x5e\x9c\xda]")
LAYER_BYTES, LAYER_SHARE = 64 << 20, 16  # decoded bytes of one text: so many, and so many times its own size

Span = tuple[int, int]


@dataclass
class Layer:
    """Decoded bytes, the way to them, and from a span of them to one of the parent."""

    data: bytes
    name: str = ""
    parent: Layer | None = None
    back: Callable[[int, int], Span] | None = None

    def in_text(self, start: int, end: int) -> Span:
        layer = self
        while layer.parent is not None:
            start, end = layer.back(start, end)
            layer = layer.parent
        return start, end

    def path(self) -> str:
        names, layer = [], self
        while layer.parent is not None:
            names.append(layer.name)
            layer = layer.parent
        return ">".join(reversed(names))


@dataclass(frozen=True, order=True)
class Finding:
    """A secret of some kind (index into KINDS); offsets are code points of the text, the end not included."""

    start: int
    kind: int
    end: int
    layers: str
    value: bytes


def matches(data: bytes) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of all rules in the bytes of one layer."""
    for m in ASSIGN.finditer(data.lower()):
        if m.end(2) - m.start(2) >= LEAST_VALUE:
            yield 0, m.start(), m.end()
    for m in ACCESS.finditer(data):
        yield 1, m.start(), m.end()
    for m in HEX.finditer(data):
        yield 2, m.start(), m.end()


def unescaped(m: re.Match) -> bytes:
    if m["url"]:
        return bytes([int(m["url"], 16)])
    if m["quoted"]:
        return m["quoted"]
    code = int(m["decimal"]) if m["decimal"] else int(m[m.lastgroup], 16)
    return chr(code).encode("utf-8", "surrogatepass") if code <= 0x10FFFF else m[0]


def escaped_lines(data: bytes) -> Iterator[tuple[str, bytes, Callable]]:
    """Each line with escapes, decoded once; no rule reaches over the end of a line."""
    done = 0
    for found in ESCAPE.finditer(data) if b"%" in data or b"\\" in data or b"&#" in data else ():
        if found.start() < done:
            continue
        begin, done = data.rfind(b"\n", 0, found.start()) + 1, data.find(b"\n", found.start())
        done = len(data) if done < 0 else done
        parts, at, size, names = [], begin, 0, set()
        to, upto, came, went = [], [], [], []  # of every escape: where it is in the line, and where it was
        for m in ESCAPE.finditer(data, found.start(), done):
            new = unescaped(m)
            if new == m[0]:
                continue
            parts += [data[at:m.start()], new]
            size += m.start() - at
            to.append(size)
            size += len(new)
            upto.append(size)
            came.append(m.start())
            at = m.end()
            went.append(at)
            names.add("url" if m["url"] else "unicode")
        if not to:
            continue
        parts.append(data[at:done])

        def back(start, end, begin=begin, to=to, upto=upto, came=came, went=went):
            i, j = bisect_right(to, start) - 1, bisect_right(to, end - 1) - 1
            first = begin + start if i < 0 else came[i] if start < upto[i] else went[i] + start - upto[i]
            last = begin + end if j < 0 else went[j] + max(end - upto[j], 0)
            return first, last

        yield "+".join(sorted(names)), b"".join(parts), back


def from_base64(run: bytes) -> bytes | None:
    """Text or a compressed stream; nothing for runs that only look like base64."""
    plain = run.rstrip(b"=").translate(bytes.maketrans(b"-_", b"+/"))
    if len(plain) % 4 == 1:
        return None
    try:
        data = binascii.a2b_base64(plain + b"=" * (-len(plain) % 4))
        if STREAM.match(data):
            return data
        data.decode()
    except ValueError:
        return None
    return None if CONTROL.search(data) else data


def wrapped_runs(data: bytes) -> Iterator[list[Span]]:
    """Lines of equal length and a last one no longer, with and without that last one."""
    for m in WRAPPED.finditer(data):
        lines = [(m.start() + x.start(), m.start() + x.end()) for x in re.finditer(rb"[^\r\n]+", m[0])]
        width, full = lines[0][1] - lines[0][0], 1
        while full < len(lines) and lines[full][1] - lines[full][0] == width:
            full += 1
        if full < len(lines) and lines[full][1] - lines[full][0] < width:
            yield lines[:full + 1]
        if full > 1:
            yield lines[:full]


def base64_runs(data: bytes) -> Iterator[tuple[str, bytes, Callable]]:
    for lines in wrapped_runs(data):
        new = from_base64(b"".join(data[a:b] for a, b in lines))
        if new is None:
            continue
        where = np.concatenate([np.arange(a, b) for a, b in lines])
        yield "base64", new, lambda s, e, where=where: (int(where[s * 8 // 6]), int(where[(e * 8 - 1) // 6]) + 1)
    for m in RUN.finditer(data):
        new = from_base64(m[0])
        if new is not None:
            yield "base64", new, lambda s, e, base=m.start(): (base + s * 8 // 6, base + (e * 8 - 1) // 6 + 1)


def inflated(data: bytes, most: int) -> tuple[bytes, int]:
    """What a stream holds, up to ``most`` bytes, and its length; a damaged one gives what comes before the damage."""
    out, used, tools = b"", len(data), {b"BZ": bz2.BZ2Decompressor, b"\xfd7": lzma.LZMADecompressor}
    try:
        if data[:2] == b"\x28\xb5":
            tool, used = zstandard.ZstdDecompressor().decompressobj(), 0
            while used < len(data) and len(out) < most and not tool.eof:
                out += tool.decompress(data[used:used + 4096])
                used = min(used + 4096, len(data))
        else:
            tool = tools.get(data[:2], lambda: zlib.decompressobj(47))()
            piece = tool.decompress(data, min(most, 1 << 20))
            while piece:
                out += piece
                rest = getattr(tool, "unconsumed_tail", b"")
                piece = b"" if tool.eof or len(out) >= most else tool.decompress(rest, min(most - len(out), 1 << 20))
        used -= len(tool.unused_data)
    except (EOFError, OSError, ValueError, zlib.error, lzma.LZMAError, zstandard.ZstdError):
        pass
    return out, used


def streams(data: bytes, most: int) -> Iterator[tuple[str, bytes, Callable]]:
    for m in STREAM.finditer(data):
        new, used = inflated(data[m.start():], most)
        if new:
            yield "compressed", new, lambda s, e, span=(m.start(), m.start() + used): span


def search(text: bytes, share: int = LAYER_SHARE, room: int = LAYER_BYTES) -> tuple[list[Finding], int]:
    """All secrets of a UTF-8 text, and the number of layers that were too large to open.

    The bytes of all decoded layers of a text are bounded by ``room`` and ``share`` times the
    text, against streams that inflate without end; a layer beyond it is counted, not lost silently.
    """
    left = room + share * len(text)
    spans, seen, refused = {}, set(), 0
    work = [Layer(text)]
    while work:
        layer = work.pop()
        for kind, start, end in matches(layer.data):
            span = (kind, *layer.in_text(start, end))
            if span not in spans:
                spans[span] = layer.path(), layer.data[start:end]
        inner = [*escaped_lines(layer.data), *base64_runs(layer.data)]
        if layer.parent is not None:
            inner += streams(layer.data, left + 1)
        for name, data, back in inner:
            new = Layer(data, name, layer, back)
            key = sha256(data).digest(), new.in_text(0, len(data))
            if key in seen or not data:
                continue
            seen.add(key)
            if len(data) > left:
                refused += 1
                continue
            left -= len(data)
            work.append(new)
    if not spans:
        return [], refused
    if text.isascii():
        place = lambda b: b
    else:
        points = np.concatenate([[0], np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)])
        # an end inside a character takes the whole of it: its first byte is counted already
        place = lambda b: int(points[b])
    return sorted(Finding(place(start), kind, place(end), *rest) for (kind, start, end), rest in spans.items()), refused


def listed(found: list[Finding]) -> str:
    return ",".join(f"{KINDS[f.kind]}:{f.start}:{f.end}" for f in found)


def texts_of(column: pa.Array) -> Iterator[bytes]:
    for value in column:
        yield value.as_buffer().to_pybytes() if value.is_valid else b""


def report_rows(batches):
    for batch in batches:
        rows = []
        for text in texts_of(batch.column("text")):
            found, refused = search(text)
            base = [f for f in found if not f.layers]
            rows.append([*(sum(f.kind == k for f in base) for k in range(len(KINDS))), sha256(listed(base).encode()).hexdigest(), listed(found), len(found) - len(base), refused])
        names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_decoded", "n_refused"]
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        arrays = [pa.array(list(c), pa.string() if n in ("base_sha256", "spans") else pa.int64()) for n, c in zip(names, columns, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", *names])


def secret_report(docs: DataFrame) -> DataFrame:
    """Per document the counts and digest of the secrets in plain sight, and the spans of all of them.

    A null text is an empty one, without secrets; a null or repeated id makes no difference, as
    every row is judged alone.  Spans found in decoded layers have the kinds of the rules and
    cover the encoded part of the text; where a layer finds a plain one again it counts as plain.
    """
    schema = StructType().add("doc_id", docs.schema["doc_id"].dataType)
    for name in ("n_assign", "n_access", "n_hex"):
        schema = schema.add(name, LongType())
    schema = schema.add("base_sha256", StringType()).add("spans", StringType()).add("n_decoded", LongType()).add("n_refused", LongType())
    return docs.select("doc_id", "text").mapInArrow(report_rows, schema)


def finding_rows(batches):
    for batch in batches:
        ids, kinds, starts, ends, layers, values = [], [], [], [], [], []
        for i, text in enumerate(texts_of(batch.column("text"))):
            for f in search(text)[0]:
                ids.append(i)
                kinds.append(KINDS[f.kind])
                starts.append(f.start)
                ends.append(f.end)
                layers.append(f.layers)
                values.append(f.value.decode("utf-8", "replace"))
        arrays = [batch.column("doc_id").take(pa.array(ids, pa.int64())), pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()),
                  pa.array(layers, pa.string()), pa.array(values, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "kind", "start", "end", "layers", "value"])


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per secret: its kind, its span in the text, the layers around it and what it reads there."""
    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(finding_rows, f"doc_id {key}, kind string, start bigint, end bigint, layers string, value string")


def masked(text: str, found: list[Finding]) -> str:
    """Every stretch that spans cover, overlapping ones together, becomes its first kind in brackets."""
    parts, at = [], 0
    for f in found:
        if f.start >= at:
            parts += [text[at:f.start], f"[{KINDS[f.kind]}]"]
        at = max(at, f.end)
    return "".join([*parts, text[at:]])


def mask_secrets(docs: DataFrame) -> DataFrame:
    """The same rows and columns, secrets masked in ``text``; null texts stay null."""

    def mask(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            new = [masked(t.decode(), search(t)[0]) if v.is_valid else None for t, v in zip(texts_of(batch.column(at)), batch.column(at), strict=True)]
            yield batch.set_column(at, "text", pa.array(new, pa.string()))

    return docs.mapInArrow(mask, docs.schema)
