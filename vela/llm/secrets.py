"""Secret scan with a recursive decoding worklist.

Three kinds are looked for in the text itself (the base spans) and in every layer that
decoding it yields:

* ``%XX`` escapes and ``\\uXXXX`` / ``\\xXX`` escapes: the whole layer, decoded in place;
* base64 runs (both alphabets), each line and lines that follow each other joined: their bytes as text, and what gzip
  (every member) or zlib data among them inflates to: each a layer of its own.

Bytes that are not UTF-8 and lone surrogates become U+FFFD; what stands around them is read all the same.

The worklist goes on until no layer yields a new one; a layer whose content was met
before in the same text with the same origin of every character is not entered again, so cycles
end and a secret encoded twice is found at both places.  Every layer keeps, for each
of its characters, the span of the original text it came from; a secret found in a layer
is reported with the original span that covers it, equal spans once.  Data is inflated in blocks
of ``BLOCK`` bytes, to its end or to where it is damaged, and scanned in windows that end where no match can
lie across.  Only a window of more than ``MAX_LAYER`` characters without such an end is not
read: the span it came from is then reported as ``unread`` and redacted as a whole, and the text is flagged ``cut``.

One Arrow pass without shuffle; texts are handled one by one, so memory follows the longest text
and one window per level of nesting.

Edge cases: null and empty texts have no spans and the SHA-256 of the empty string; repeated rows give equal results; an empty table gives an empty result; extra
columns pass through ``redact`` and are ignored by ``report``.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the task.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # leftmost runs of 24 or more are the runs of [0-9a-f]+ that pass
ASSIGN_VALUE, ACCESS_LENGTH = 6, 20

UNREAD = len(KINDS)  # kind of a span whose content was not read to its end
MAX_LAYER = 1 << 26
BLOCK = 1 << 20
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2})+")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]+)*={0,2}")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
_STRANGE = re.compile("[\ud800-\udfff]")
#: The last place that no match of any pattern lies across: after a character of none, or a space between words.
_LAST_END = re.compile(r"""(?s:.*)(?:[^A-Za-z0-9+/_=.%\\"' :\r\n\t-]|(?<=[A-Za-z0-9])\x20(?=[A-Za-z0-9]))""")
_URLSAFE = str.maketrans("-_", "+/")
REDACTED = "[REDACTED]"

_HEX_BYTE = np.zeros(256, dtype=bool)
_HEX_BYTE[list(b"0123456789abcdef")] = True


@dataclass
class Layer:
    """A text and, per character or for all of it, the original span it came from (neither: the original itself)."""

    text: str
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    span: tuple[int, int] | None = None

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.span:
            return self.span
        if self.low is None:
            return start, end
        return int(self.low[start:end].min()), int(self.high[start:end].max())

    def key(self) -> bytes:
        """Digest of the content and of where each character came from."""
        h = hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=16)
        h.update(repr(self.span).encode())
        if self.low is not None:
            h.update(np.ascontiguousarray(self.low))
            h.update(np.ascontiguousarray(self.high))
        return h.digest()


def find(text: str) -> list[tuple[int, int, int]]:
    """Base matches as (start, kind, end) in code points, sorted."""
    out = []
    if "=" in text or ":" in text:
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    if _has_run(text, _HEX_BYTE, 24):
        out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _has_run(text: str, inside: np.ndarray, least: int) -> bool:
    """Whether some run of characters of an ASCII class is that long."""
    if len(text) < least:
        return False
    hit = inside[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    # a run of `least` covers a multiple of least // 2 and the next one
    step = least // 2
    grid = hit[::step]
    if not (grid[:-1] & grid[1:]).any():
        return False
    gaps = np.flatnonzero(np.concatenate(([True], ~hit, [True])))
    return bool((np.diff(gaps) > least).any())


_B64_BYTE = np.zeros(256, dtype=bool)
_B64_BYTE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")] = True


def _spliced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every match decoded in place."""
    parts, low, high, at = [], [], [], 0
    if layer.span:
        text = pattern.sub(lambda m: decode(m[0])[0], layer.text)
        return Layer(text, span=layer.span) if text != layer.text else None
    n = len(layer.text)
    own_low = np.arange(n) if layer.low is None else layer.low
    own_high = np.arange(1, n + 1) if layer.high is None else layer.high
    for m in pattern.finditer(layer.text):
        text, starts, ends = decode(m[0])
        parts += [layer.text[at:m.start()], text]
        low += [own_low[at:m.start()], own_low[m.start() + starts]]
        high += [own_high[at:m.start()], own_high[m.start() + ends - 1]]
        at = m.end()
    if not parts:
        return None
    parts.append(layer.text[at:])
    return Layer("".join(parts), np.concatenate([*low, own_low[at:]]), np.concatenate([*high, own_high[at:]]))


def _decoded(raw: bytes) -> tuple[str, np.ndarray]:
    """UTF-8 bytes as text, each bad byte as one U+FFFD, and the bytes of each character."""
    text = raw.decode("utf-8", "surrogateescape")
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    widths = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
    widths[(code >= 0xD800) & (code < 0xE000)] = 1
    return _STRANGE.sub("\ufffd", text), widths


def _percent(run: str):
    text, widths = _decoded(bytes.fromhex(run.replace("%", "")))
    ends = 3 * np.cumsum(widths)
    return text, np.concatenate(([0], ends[:-1])), ends


def _escape(run: str):
    units = [(m.end() - m.start(), int(m[0][2:], 16)) for m in re.finditer(r"\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}", run)]
    text, widths = [], []
    k = 0
    while k < len(units):
        width, code = units[k]
        if 0xD800 <= code < 0xDC00 and k + 1 < len(units) and 0xDC00 <= units[k + 1][1] < 0xE000:
            width, code = width + units[k + 1][0], 0x10000 + ((code - 0xD800) << 10) + units[k + 1][1] - 0xDC00
            k += 1
        text.append("\ufffd" if 0xD800 <= code < 0xE000 else chr(code))
        widths.append(width)
        k += 1
    ends = np.cumsum(widths)
    return "".join(text), ends - widths, ends


def _packed(head: bytes) -> bool:
    """Whether bytes may begin gzip or zlib data."""
    return head[:2] == b"\x1f\x8b" or (len(head) > 1 and head[0] & 15 == 8 and (head[0] * 256 + head[1]) % 31 == 0)


def _blocks(raw: bytes) -> Iterator[bytes]:
    """Inflated bytes of every member in blocks, then the bytes behind the last; up to where the data is damaged."""
    while _packed(raw):
        d, data = zlib.decompressobj(47 if raw[:2] == b"\x1f\x8b" else 15), raw
        while not d.eof:
            before = d.copy()
            try:
                out = d.decompress(data, BLOCK)
            except zlib.error:
                out = _until_damage(before, data)
                if out:
                    yield out
                return
            data = d.unconsumed_tail
            if out:
                yield out
            elif not data and not d.eof:
                return  # it ends too early
        raw = d.unused_data.lstrip(b"\0")
    if raw:
        yield raw


def _until_damage(d, data: bytes) -> bytes:
    """What a decompressor gives before the byte that it cannot read."""
    out = bytearray()
    try:
        for k in range(len(data)):
            out += d.decompress(data[k:k + 1])
            if len(out) > BLOCK:
                break
    except zlib.error:
        pass
    return bytes(out)


def _windows(raw: bytes) -> Iterator[str | None]:
    """Inflated text in windows that no match lies across; None for one longer than MAX_LAYER, which is left out."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    held, size, lost = [], 0, False
    for block in _blocks(raw):
        text = decoder.decode(block)
        end = m.end() if (m := _LAST_END.match(text)) else 0
        if end:
            if not lost:
                yield "".join([*held, text[:end]])
            held, size, lost = [], 0, False
        held.append(text[end:])
        size += len(text) - end
        if size > MAX_LAYER:
            if not lost:
                yield None
            held, lost = [], True
    if not lost and (text := "".join([*held, decoder.decode(b"", True)])):
        yield text


def _worth(text: str) -> bool:
    """Whether a text holds anything to report or to decode."""
    return bool(find(text) or _PERCENT.search(text) or _ESCAPE.search(text) or _has_run(text, _B64_BYTE, 16))


def _from_base64(layer: Layer) -> Iterator[Layer | tuple[int, int]]:
    """Layers that the base64 runs of a layer give; the original span of what was not read."""
    if not _has_run(layer.text, _B64_BYTE, 16):
        return
    for m in _BASE64.finditer(layer.text):
        lines = [x.span() for x in _LINE.finditer(layer.text, m.start(), m.end())]
        whole = set()  # lines whose packed data ended in them
        for a, b in lines:
            if b - a >= 16:
                yield from _from_lines(layer, [(a, b)], m.end() if b == lines[-1][1] else b, whole, len(lines) > 1)
        if len(lines) > 1:
            yield from _from_lines(layer, lines, m.end(), whole, True)


def _from_lines(layer: Layer, lines: list[tuple[int, int]], end: int, whole: set[int], several: bool) -> Iterator[Layer | tuple[int, int]]:
    """Layers of lines joined; text may begin with any of them, so every phase that one begins with is decoded."""
    chars = "".join(layer.text[a:b] for a, b in lines).translate(_URLSAFE)
    before = np.concatenate(([0], np.cumsum([b - a for a, b in lines])[:-1])).tolist()
    for phase in sorted({c % 4 for c in before}):
        text, widths = _decoded(_bytes(chars[phase:]))
        if _worth(text):
            if layer.span:
                yield Layer(text, span=layer.span)
                continue
            at = np.concatenate([np.arange(a, b) for a, b in lines])[phase:]
            ends = np.cumsum(widths)
            starts = ends - widths
            low = at[starts // 3 * 4 + starts % 3]
            high = at[(ends - 1) // 3 * 4 + (ends - 1) % 3 + 1] + 1
            if layer.low is not None:
                low, high = layer.low[low], layer.high[high - 1]
            yield Layer(text, low, high)
    for c, (a, _) in zip(before, lines):
        if a in whole or not _packed(_bytes(chars[c:c + 4])):
            continue
        raw = _bytes(chars[c:])
        origin = layer.origin(a, end)
        for window in _windows(raw):
            if window is None:
                yield origin
            elif _worth(window):
                yield Layer(window, span=origin)
        if several and _ends(raw):
            whole.add(a)
            if len(lines) > 1:
                break  # the lines left are part of it


def _bytes(run: str) -> bytes:
    run = run[: len(run) - (len(run) % 4 == 1)]
    return base64.b64decode(run + "=" * (-len(run) % 4))


def _ends(raw: bytes) -> bool:
    """Whether packed data is whole members and nothing else."""
    while _packed(raw):
        d, data = zlib.decompressobj(47 if raw[:2] == b"\x1f\x8b" else 15), raw
        try:
            while not d.eof:
                out, data = d.decompress(data, BLOCK), d.unconsumed_tail
                if not out and not data and not d.eof:
                    return False
        except zlib.error:
            return False
        raw = d.unused_data.lstrip(b"\0")
    return not raw


def spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]], bool]:
    """Base spans, all spans (both sorted by start, kind, end) and whether some span was not read."""
    base = find(text)
    found = set(base)
    seen, work = set(), [iter([Layer(text)])]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if isinstance(layer, tuple):
            found.add((layer[0], UNREAD, layer[1]))
            continue
        if layer.low is not None or layer.span:
            if (key := layer.key()) in seen:
                continue
            seen.add(key)
            found |= {(a, kind, b) for s, kind, e in find(layer.text) for a, b in [layer.origin(s, e)]}
        work.append(_next_layers(layer))
    return base, sorted(found), any(kind == UNREAD for _, kind, _ in found)


def _next_layers(layer: Layer) -> Iterator[Layer | tuple[int, int]]:
    for sign, pattern, decode in (("%", _PERCENT, _percent), ("\\", _ESCAPE, _escape)):
        if sign in layer.text and (spliced := _spliced(layer, pattern, decode)) is not None:
            yield spliced
    yield from _from_base64(layer)


def _written(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{(*KINDS, 'unread')[k]}:{s}:{e}" for s, k, e in found)


_RESULT = "struct<n_assign:bigint,n_access:bigint,n_hex:bigint,base_sha256:string,spans:string,cut:boolean>"


def scan(text: Column) -> Column:
    """Struct of base counts, base_sha256, all spans as text and cut."""
    @F.arrow_udf(_RESULT)
    def run(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts:
            base, every, cut = spans(t.as_py() or "")
            kinds = [k for _, k, _ in base]
            rows.append({"n_assign": kinds.count(0), "n_access": kinds.count(1), "n_hex": kinds.count(2),
                         "base_sha256": hashlib.sha256(_written(base).encode()).hexdigest(), "spans": _written(every), "cut": cut})
        return pa.array(rows, pa.struct([("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                                         ("base_sha256", pa.string()), ("spans", pa.string()), ("cut", pa.bool_())]))

    return run(text)


def redacted(text: str | None) -> str | None:
    """The text with every found span (overlapping ones as one) replaced."""
    if not text:
        return text
    out, at = [], 0
    end = None
    for s, _, e in [*spans(text)[1], (len(text) + 1, 0, 0)]:
        if end is not None and s < end:
            end = max(end, e)
            continue
        if end is not None:
            out += [text[at:start], REDACTED]
            at = end
        start, end = s, e
    out.append(text[at:])
    return "".join(out)


def redact(docs: DataFrame) -> DataFrame:
    """docs with the secrets of its text replaced."""
    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([redacted(t.as_py()) for t in texts], pa.string())

    return docs.withColumn("text", run(F.col("text"))).select(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row."""
    return docs.select("doc_id", scan(F.col("text")).alias("_r")).select(
        "doc_id", "_r.n_assign", "_r.n_access", "_r.n_hex", "_r.base_sha256", "_r.spans")
