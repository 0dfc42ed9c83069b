"""Secret scans: base patterns over each text and over every layer that decoding uncovers."""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import html
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.shared import slices

KINDS = ("assign", "access", "hex")
#: Shortest base64 run that can hold a secret (12 bytes).
RUN = 16
#: Uncompressed bytes that are read at once, and what is read again with the next: secrets inside inflated data may lie
#: anywhere; encoded runs inside inflated data of more than one window are whole up to the overlap's size.
WINDOW = 1 << 25
OVERLAP = 1 << 20
_ORDER = {kind: n for n, kind in enumerate(KINDS)}


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token")) + f"|{_any_case('api')}_?{_any_case('key')}"
ASSIGN = re.compile(rf"""({_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_KEY_BYTES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
#: Escapes with what quote() leaves bare between and around them.
_STRETCH = re.compile(r"(?<![A-Za-z0-9_.~/+-])[A-Za-z0-9_.~/+-]*+(?:%[0-9A-Fa-f]{2}[A-Za-z0-9_.~/+-]*+)+")
_XRUN = re.compile(r"(?:\\x[0-9A-Fa-f]{2}){12,}")
#: Where compressed data can begin, and stretches of other bytes that are long enough for a secret.
_MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
_PARTS = re.compile(rb"[\t\n\r\x20-\x7e]{12,}")
_UTF16 = re.compile(rb"(?:[\t\n\r\x20-\x7e]\x00){12,}|(?:\x00[\t\n\r\x20-\x7e]){12,}")
_WIDE = re.compile(rb"\x00[\t\n\r\x20-\x7e]\x00")
_PLAIN = np.zeros(256, bool)
_PLAIN[[9, 10, 13, *range(32, 127)]] = True
_LONG_SPACES, _SPACES = re.compile(rb" {256,}"), b" " * 255
_UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{[0-9A-Fa-f]{1,6}\}|(?:\\x[0-9A-Fa-f]{2})+|\\U[0-9A-Fa-f]{8}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
_ESCAPE = re.compile(rb"%[0-9A-Fa-f]{2}|\\[uUx][0-9A-Fa-f{]|&#[0-9xX]")
_BASE64 = re.compile(rf"[A-Za-z0-9+/_-]{{{RUN},}}={{0,2}}")
#: The same over line ends: wrapped base64, with indents.
_WRAPPED = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{RUN},}}+(?:\r?\n[ \t]*+[A-Za-z0-9+/_-]++)+={{0,2}}")
_B64_TABLE = np.zeros(256, bool)
_B64_TABLE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")] = True
#: Hexadecimal digits in either case and their values.
_DIGIT, _VALUE, _LOST = np.zeros(256, bool), np.zeros(256, np.uint8), re.compile("[\udc80-\udcff]")
for _n, _c in enumerate(b"0123456789abcdef"):
    _DIGIT[[_c, ord(chr(_c).upper())]], _VALUE[[_c, ord(chr(_c).upper())]] = True, _n
_HEX_TABLE = np.zeros(256, bool)
_HEX_TABLE[list(b"0123456789abcdef")] = True


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base patterns; matches that are too short are consumed and dropped."""
    found = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], _ORDER[s[1]], s[2]))


@dataclass
class Layer:
    """A text and the spans of the outermost text that its characters come from: an array of starts and one of ends,
    two numbers where all come from one span, or nothing where it is the outermost text itself."""

    text: str
    low: np.ndarray | int | None = None
    high: np.ndarray | int | None = None

    def up(self, start: int, end: int) -> tuple[int, int]:
        if self.low is None:
            return start, end
        if isinstance(self.low, int):
            return self.low, self.high
        return int(self.low[start]), int(self.high[end - 1])

    def below(self, text: str, start: np.ndarray, end: np.ndarray) -> Layer:
        """A layer whose characters come from stretches of this one."""
        if self.low is None:
            return Layer(text, start, end)
        if isinstance(self.low, int):
            return Layer(text, self.low, self.high)
        return Layer(text, self.low[start], self.high[np.maximum(end, 1) - 1])


@dataclass
class Inflated:
    """Uncompressed bytes, all of which come from one span of the outermost text."""

    data: bytes
    low: int
    high: int


def _unpack(data: bytes, at: int) -> Iterator[bytes | int]:
    """Uncompressed bytes, in pieces, of the gzip, zlib, bzip2, xz or zstandard member at a place; last the place after
    it, or after its first byte if it was broken or none."""
    head = data[at : at + 6]
    try:
        if head[:2] == b"\x1f\x8b" or head[:1] == b"\x78" and int.from_bytes(head[:2]) % 31 == 0:
            d, piece = zlib.decompressobj(47), 1 << 20
            while not d.eof and at < len(data):
                yield d.decompress(data[at : at + piece], piece)
                at += min(piece, len(data) - at)
                while d.unconsumed_tail and not d.eof:
                    yield d.decompress(d.unconsumed_tail, piece)
            yield at - len(d.unused_data) if d.eof else len(data)
            return
        if head[:3] == b"BZh" or head == b"\xfd7zXZ\x00":
            d, piece = bz2.BZ2Decompressor() if head[:3] == b"BZh" else lzma.LZMADecompressor(), 1 << 20
            while not d.eof and (at < len(data) or not d.needs_input):
                new = data[at : at + piece] if d.needs_input else b""
                at += len(new)
                yield d.decompress(new, piece)
            yield at - len(d.unused_data) if d.eof else len(data)
            return
        if head[:4] == b"\x28\xb5\x2f\xfd":
            d, piece = zstandard.ZstdDecompressor().decompressobj(), 1 << 10  # in small pieces, as it takes no bound; one gives 32 MiB at most
            while not d.eof and at < len(data):
                yield d.decompress(data[at : at + piece])
                at += min(piece, len(data) - at)
            yield at - len(d.unused_data) if d.eof else len(data)
            return
    except (zlib.error, OSError, ValueError, EOFError, lzma.LZMAError, zstandard.ZstdError):
        pass
    yield -1


def _inflated(data: bytes, at: int, window: int) -> Iterator[tuple[bytes, int]]:
    """Uncompressed bytes of the member at a place in windows that overlap, so that no secret lies across the end of
    one, each with 0; the last, which may be empty, with the place where the search for further members goes on."""
    held, size, more, stop = [], 0, False, at + 1
    for piece in _unpack(data, at):
        if isinstance(piece, int):
            stop = max(piece, stop)
            break
        held.append(piece)
        size += len(piece)
        if size > window:
            whole = _LONG_SPACES.sub(_SPACES, b"".join(held))
            yield whole, 0
            held, more = [whole[-OVERLAP:]], True
            size = len(held[0])
    del data  # a chain of many layers holds none but the last
    yield b"".join(held) if size and (not more or size > OVERLAP or len(held) > 1) else b"", stop


def _members(data: bytes, window: int) -> Iterator[tuple[bytes, int, int]]:
    """What compressed data inflates to, wherever it begins, window by window: (bytes, first byte of the member, byte
    after it, or after all of the data where its end isn't known yet)."""
    found = _MAGIC.search(data)
    while found:
        first = found.start()
        found = None
        for whole, stop in _inflated(data, first, window):
            size = len(data)
            if stop:
                found = _MAGIC.search(data, stop)
                if not found:
                    data = b""
            if whole:
                yield whole, first, max(first + 1, stop or size)


def _plain(data: bytes) -> bool:
    """Whether _PARTS has a match, told in a few passes of numpy."""
    run = _PLAIN[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 4):  # runs of 2, 4, 8 and 12
        run = run[:-step] & run[step:]
    return bool(run.any())


def readable(data: bytes) -> tuple[str, np.ndarray, np.ndarray] | None:
    """The readable stretches of some bytes, also as UTF-16, as one text: (text, first byte of each character, byte
    after it); None if there are none."""
    parts, places = [], []
    for m in _PARTS.finditer(data) if _plain(data) else ():
        parts.append(m[0])
        places.append((m.start(), 1))
    for m in _UTF16.finditer(data) if _WIDE.search(data) else ():
        at = m.start() + (data[m.start()] == 0)
        parts.append(data[at : m.end() : 2])
        places.append((at, 2))
    if not parts:
        return None
    start = np.concatenate([at + step * np.arange(len(p) + 1) for p, (at, step) in zip(parts, places)])
    step = np.concatenate([np.full(len(p) + 1, step) for p, (_, step) in zip(parts, places)])
    return (b"\0".join(parts) + b"\0").decode(), start, np.minimum(start + step, len(data))


def _from_base64(run: str) -> bytes:
    """Bytes of as many whole base64 characters as there are; a lone last character is left out."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    body = body[: len(body) - (len(body) % 4 == 1)]
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4))
    except (binascii.Error, ValueError):
        return b""


def _unescaped(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The text with every run of the pattern decoded, runs that don't decode left as they are."""
    text, out, at = layer.text, [], 0
    low, high, start, end = [], [], [], []  # arrays, and what comes next in them

    def plain(a: int, b: int) -> None:
        out.append(text[a:b])
        if b - a < 16:
            start.extend(range(a, b)), end.extend(range(a + 1, b + 1))
        else:
            flush()
            low.append(np.arange(a, b)), high.append(np.arange(a + 1, b + 1))

    def flush() -> None:
        if start:
            low.append(np.array(start)), high.append(np.array(end))
            start.clear(), end.clear()

    for m in pattern.finditer(text):
        if not (made := decode(m[0])):
            continue
        plain(at, m.start())
        chars, size = made
        out.append(chars)
        if isinstance(size, int):  # of each character
            start.extend(range(m.start(), m.end(), size)), end.extend(range(m.start() + size, m.end() + 1, size))
        else:
            edges = list(accumulate(size, initial=m.start()))
            start.extend(edges[:-1]), end.extend(edges[1:])
        at = m.end()
    if not out:
        return None
    plain(at, len(text))
    flush()
    return layer.below("".join(out), *(np.concatenate(x) if x else np.empty(0, np.int64) for x in (low, high)))


def _percents(layer: Layer) -> Layer | None:
    """The text with every percent escape decoded, in one pass over its bytes; None if it has none. A byte that is no
    text becomes U+FFFD, which parts what is around it."""
    codes = np.frombuffer(layer.text.encode(errors="replace"), np.uint8)
    padded = np.append(codes, np.zeros(2, np.uint8))
    at = np.flatnonzero((codes == 37) & _DIGIT[padded[1:-1]] & _DIGIT[padded[2:]])
    if not len(at):
        return None
    data, keep = codes.copy(), np.ones(len(codes), bool)
    data[at] = _VALUE[codes[at + 1]] * 16 + _VALUE[codes[at + 2]]
    keep[at + 1] = keep[at + 2] = False
    text = data[keep].tobytes().decode(errors="surrogateescape")
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    lost = (points >= 0xDC80) & (points <= 0xDCFF)
    sizes = np.where(lost, 1, 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))
    byte = np.append(np.flatnonzero(keep), len(codes))[np.r_[0, np.cumsum(sizes)]]
    place = np.append(np.cumsum((codes & 0xC0) != 0x80) - 1, len(layer.text))[byte]
    if lost.any():
        text = _LOST.sub("\ufffd", text)
    return layer.below(text, place[:-1], place[1:])


def _unicode(run: str) -> tuple[str, int | list[int]] | None:
    if run[0] == "&":
        chars = html.unescape(run)
        return (chars[:1], len(run)) if chars != run and chars else None
    if run[:3] == "\\u{" or run[1] == "U":
        code = int(run.strip("\\uU{}"), 16)
        return (chr(code), len(run)) if code < 0x110000 and not 0xD800 <= code < 0xE000 else None
    if run[1] == "x":
        return bytes.fromhex(run.replace("\\x", "")).decode("latin-1"), 4
    if len(run) == 6:
        code = int(run[2:], 16)
        return chr(code) if not 0xD800 <= code < 0xE000 else "\ufffd", 6
    chars, size, units = [], [], [int(u, 16) for u in run.split("\\u")[1:]]
    i = 0
    while i < len(units):
        c, n = units[i], 1
        if 0xD800 <= c < 0xDC00 and i + 1 < len(units) and 0xDC00 <= units[i + 1] < 0xE000:
            c, n = 0x10000 + (c - 0xD800 << 10) + units[i + 1] - 0xDC00, 2
        chars.append(chr(c) if not 0xD800 <= c < 0xE000 else "\ufffd")
        size.append(6 * n)
        i += n
    return "".join(chars), size


def _escaped_bytes(run: str, mark: str) -> tuple[bytes, np.ndarray]:
    """Bytes of a stretch of ASCII with escapes (the mark and two digits), and where each begins, and the end."""
    codes = np.frombuffer(run.encode(), np.uint8)
    at = np.flatnonzero(codes == ord(mark[0]))
    first = at + len(mark)
    keep = np.ones(len(codes), bool)
    for i in range(1, len(mark) + 2):
        keep[at + i] = False
    out = codes.copy()
    digit = np.where(codes <= 57, codes & 15, (codes & 7) + 9)
    out[at] = digit[first] * 16 + digit[first + 1]
    return out[keep].tobytes(), np.append(np.flatnonzero(keep), len(codes))


def _children(layer: Layer, window: int) -> Iterator[Layer | Inflated]:
    """All that one step of decoding gives."""
    text = layer.text
    for made in (_percents(layer) if "%" in text else None, _unescaped(layer, _UNICODE, _unicode) if "\\" in text or "&#" in text else None):
        if made is not None:
            yield made

    def views(data: bytes, outer) -> Iterator[Layer | Inflated]:
        if plain := readable(data):
            yield layer.below(plain[0], *outer(*plain[1:]))
        for inner, first, last in _members(data, window):
            low, high = outer(np.array([first]), np.array([last]))
            yield Inflated(inner, *layer.up(int(low[0]), int(high[0])))

    for pattern, mark in ((_STRETCH, "%"), (_XRUN, "\\x")):
        for m in pattern.finditer(text) if mark in text else ():
            if m.end() - m.start() < 8:  # five bytes at most, which hold no secret in any form
                continue
            data = unquote_to_bytes(m[0]) if mark == "%" else bytes.fromhex(m[0].replace(mark, ""))
            if _MAGIC.search(data) or _UTF16.search(data):
                data, edges = _escaped_bytes(m[0], mark)
                yield from views(data, lambda a, b, edges=edges + m.start(): (edges[a], edges[b]))
    for pattern in (_BASE64, _WRAPPED):
        for m in pattern.finditer(text):
            whole = m[0]
            places = np.arange(m.start(), m.end())
            if pattern is _WRAPPED:
                places = places[[not c.isspace() for c in whole]]
                whole = "".join(whole.split())
            body = len(whole.rstrip("="))
            for skip in range(4):  # what stands before a run can be of the same characters
                data = _from_base64(whole[skip:])

                def outer(a, b, skip=skip, size=len(data), places=places, body=body, count=len(whole)):
                    high = np.minimum(body, skip - (-b * 4 // 3))
                    high = np.where(b >= size, count, high)  # the padding belongs to the last character
                    return places[np.minimum(skip + a * 4 // 3, body - 1)], places[high - 1] + 1

                yield from views(data, outer)


def _below(inflated: Inflated, window: int) -> Iterator[Layer | Inflated]:
    """What can be read in uncompressed bytes, and what they inflate to in turn."""
    data, low, high = inflated.data, inflated.low, inflated.high
    del inflated
    if plain := readable(data):
        yield Layer(plain[0], low, high)
    del plain
    members = _members(data, window)
    del data
    for inner, _, _ in members:
        yield Inflated(inner, low, high)


def all_spans(text: str, window: int = WINDOW) -> list[tuple[int, str, int]]:
    """Base spans of a text and of all layers below it, the latter as the spans of the text that they come from.

    A worklist of layers: each is scanned, then unwrapped in every way (percent and Unicode escapes, base64 runs at
    every alignment and over line ends, compressed data wherever it begins, UTF-16) until nothing new comes out. Layers
    of characters and of bytes are known by digest and place, and one seen before at the same place is not followed
    again, so that data which inflates to itself comes to an end; nesting can be of any depth. Base spans of the text
    itself stay, whatever the layers add. What inflates beyond a window is taken window by window, OVERLAP bytes of each
    again in the next."""
    found = set(base_spans(text))
    work, seen = [_children(Layer(text), window)], set()
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if isinstance(layer, Inflated):
            key = (hashlib.blake2b(layer.data, digest_size=16).digest(), layer.low, layer.high)
            new = key not in seen and _below(layer, window)
        else:
            key = (layer.text if len(layer.text) < 64 else hashlib.blake2b(layer.text.encode(), digest_size=16).digest(), *layer.up(0, 1)) if layer.text else ()
            new = layer.text and key not in seen and _children(layer, window)
        if not new:
            continue
        seen.add(key)
        if isinstance(layer, Layer):
            for start, kind, end in base_spans(layer.text):
                low, high = layer.up(start, end)
                found.add((low, kind, high))
        work.append(new)
    return sorted(found, key=lambda s: (s[0], _ORDER[s[1]], s[2]))


def _runs(flags: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of at least that length."""
    gaps = np.flatnonzero(~flags)
    edges = np.r_[-1, gaps, len(flags)]
    long = np.flatnonzero(np.diff(edges) > least)
    return edges[long] + 1, edges[long + 1]


def _readable(data: bytes) -> bool:
    """Whether readable() can give anything."""
    return bool(_PARTS.search(data) or _MAGIC.search(data) or _WIDE.search(data) and _UTF16.search(data))


def _suspects(raw: list[bytes]) -> np.ndarray:
    """Which texts can have any span: the others are plain beyond doubt and skip the scan."""
    joined = b"\n".join(raw)
    bounds = np.cumsum([len(r) + 1 for r in raw])
    flag = np.zeros(len(raw), bool)
    codes = np.frombuffer(joined, np.uint8)
    starts, _ = _runs(_HEX_TABLE[codes], 24)
    flag[np.searchsorted(bounds, starts, "right")] = True
    starts, ends = _runs(_B64_TABLE[codes], RUN)
    for n, s, e in zip(np.searchsorted(bounds, starts, "right").tolist(), starts.tolist(), ends.tolist()):
        if not flag[n]:
            run = joined[s:e].decode()
            flag[n] = joined[e : e + 1] in (b"\r", b"\n") and e + 1 < bounds[n] or any(_readable(_from_base64(run[skip:])) for skip in range(4))
    for n in np.flatnonzero(~flag):
        low = raw[n].lower()
        flag[n] = any(k in low for k in _KEY_BYTES) or b"AKIA" in raw[n] or b"%" in low and _ESCAPE.search(low) or (b"\\" in low or b"&#" in low) and _ESCAPE.search(low) is not None
    return flag


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            raw = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            base, every = [], []
            for suspect, r in zip(_suspects(raw), raw):
                text = r.decode(errors="replace") if suspect else ""
                base.append([dict(zip(("start", "kind", "end"), s)) for s in base_spans(text)])
                every.append([dict(zip(("start", "kind", "end"), s)) for s in all_spans(text)] if suspect else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, kind), pa.array(every, kind)], ["doc_id", "base", "spans"])


_SPANS = "array<struct<start:int,kind:string,end:int>>"


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans) for every row: spans of the base patterns, and these with what decoding uncovers.

    Positions are code points, ends exclusive; sorted by start, kind, end. Null and empty texts have no spans; rows
    that repeat, and rows with null ids, get a result each; other columns are ignored."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_scan, f"doc_id long, base {_SPANS}, spans {_SPANS}")


def _joined(col: str):
    return F.concat_ws(",", F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def secret_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans): counts and digest of base spans, and all spans."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return find_secrets(docs, id_col, text_col).select("doc_id", *map(count, KINDS), F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def redact(text: str, spans: list[tuple[int, str, int]], mark: str = "[secret]") -> str:
    """The text with its spans, joined where they overlap, replaced by a mark."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs, columns and rows as they are, with all secrets in text_col replaced by a mark; null texts stay null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at = batch.schema.names.index(text_col)
            raw = [t or b"" for t in batch.column(at).cast(pa.binary()).to_pylist()]
            flags = np.concatenate([_suspects(raw[i : i + 256]) for i in range(0, len(raw), 256)]) if raw else []
            old = batch.column(at).to_pylist()
            new = [redact(t, all_spans(t)) if flag and t else t for t, flag in zip(old, flags)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
