"""Token counts of sections: whole documents are encoded once and tokens are attributed by their character spans."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RULES = ("start", "end", "majority")
#: White space of the pattern's engine (Python's \\s has more), and the longest stretch of it that goes to that engine,
#: which backtracks once a character and would overflow its stack.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_SPACE = 4096
_LONG = re.compile(f"[{_SPACE}]{{{LONG_SPACE},}}")
#: How the pattern has to take white space for long stretches to be cut out: all but the last character is one piece
#: if a word follows, and all of it at the end.
_SPACE_RULE = r"\s+(?!\S)|\s+"
_SCHEMA = "doc_id long, section int, start int, stop int, n_tokens long, n_crossing long"


@lru_cache(maxsize=2)
def _encoding(spec: bytes, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray, tiktoken.Encoding | None]:
    """Coder, size of each token, and a coder that takes a whole text for one piece (if white space can be cut out)."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, spec.splitlines())}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    whole = tiktoken.Encoding("whole", pat_str="(?s:.+)", mergeable_ranks=ranks, special_tokens={}) if pattern.endswith(_SPACE_RULE) else None
    return tiktoken.Encoding("counting", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes, whole


def encode(encoding: tuple, text: str) -> list[int]:
    """Ids of a text of any length. Very long stretches of white space, whose bounds the pattern fixes whatever stands
    around them, are encoded by themselves."""
    coder, _, whole = encoding
    if whole is None or len(text) < LONG_SPACE or not (stretch := _LONG.search(text)):
        return coder.encode_ordinary(text)
    ids, at = [], 0
    while stretch:
        stop = stretch.end() if stretch.end() == len(text) else stretch.end() - 1
        ids += coder.encode_ordinary(text[at : stretch.start()])
        ids += whole.encode_ordinary(text[stretch.start() : stop])
        at = stop
        stretch = _LONG.search(text, max(at, stretch.end()))
    return ids + coder.encode_ordinary(text[at:])


def token_bytes(encoding: tuple, text: str) -> np.ndarray:
    """Byte offsets at which tokens begin, and the text's size at the end."""
    return np.r_[0, np.cumsum(encoding[1][encode(encoding, text)])].astype(np.int64)


def lines(text: str) -> list[int]:
    """Ends, in characters, of the sections of a text: its lines, each with its line feed."""
    ends = [m.end() for m in re.finditer("\n", text)]
    return ends if ends and ends[-1] == len(text) else [*ends, len(text)]


def attribute(edges: np.ndarray, ends: np.ndarray, rule: str = "start") -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section, and how many of them also reach into another section.

    edges: byte offsets where tokens begin, and the end; ends: byte offsets where sections end, covering the text. A
    token within one section is counted there. One that crosses a boundary goes, by rule, to the section of its first
    byte (start), of its last (end), or to the one that holds most of its bytes, the first of equals (majority)."""
    first = np.searchsorted(ends, edges[:-1], "right")
    last = np.searchsorted(ends, edges[1:] - 1, "right")
    own = {"start": first, "end": last, "majority": first.copy()}[rule]
    crossing = np.flatnonzero(first != last)
    if rule == "majority":
        for t in crossing.tolist():
            cuts = np.r_[edges[t], ends[first[t] : last[t]], edges[t + 1]]
            own[t] = first[t] + int(np.diff(cuts).argmax())
    n = len(ends)
    return np.bincount(own, minlength=n), np.bincount(own[crossing], minlength=n)


def byte_places(text: str, places: np.ndarray) -> np.ndarray:
    """Byte offsets of some character offsets."""
    if text.isascii():
        return places
    codes = np.frombuffer(text.encode(), np.uint8)
    return np.append(np.flatnonzero((codes & 0xC0) != 0x80), len(codes))[places]


def section_tokens(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", rule: str = "start") -> DataFrame:
    """(doc_id, section, start, stop, n_tokens, n_crossing) for every line of every row's whole text, in characters.

    The counts of a document's sections add up to the tokens of the document as a whole. Null and empty texts have one
    section without tokens; rows that repeat or have null ids are counted each by themselves. Texts can be of any
    length and kind under patterns that end in _SPACE_RULE; under others the engine sets the limit."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    with open(vocabulary, "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # its size does not depend on the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(spec.value, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                cols = [[] for _ in range(6)]
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    text = text or ""
                    ends = np.array(lines(text), np.int64)
                    n, crossing = attribute(token_bytes(encoding, text), byte_places(text, ends), rule)
                    for c, v in zip(cols, (pa.array([doc_id] * len(ends), pa.int64()), np.arange(len(ends)), np.r_[0, ends[:-1]], ends, n, crossing)):
                        c.append(v)
                ids = pa.concat_arrays(cols[0]) if cols[0] else pa.array([], pa.int64())
                rest = [pa.array(np.concatenate(c) if c else [], t) for c, t in zip(cols[1:], (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([ids, *rest], [f.split()[0] for f in _SCHEMA.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, _SCHEMA)


def field_tokens(docs: DataFrame, fields: list[str], vocabulary: str, pattern: str, id_col: str = "doc_id", separator: str = "\n", rule: str = "start") -> DataFrame:
    """(doc_id, field, n_tokens, n_crossing) for every row and named text column: the fields are joined by the separator,
    the whole is encoded once, and tokens are attributed to fields.

    A separator belongs to the field before it, so that counts add up to the tokens of the whole. Null fields are empty
    and, like empty ones, hold no tokens but those of their separator; rows that repeat or have null ids are counted
    each by themselves; an empty table gives an empty result."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    if not fields:
        raise ValueError("no fields are named")
    with open(vocabulary, "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(spec.value, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                ids, names, counts, crossings = [], [], [], []
                for doc_id, *texts in zip(*(c.to_pylist() for c in batch.columns)):
                    parts = [(t or "") + separator for t in texts[:-1]] + [texts[-1] or ""]
                    ends = np.cumsum([len(p.encode()) for p in parts])
                    own = np.flatnonzero(np.diff(ends, prepend=0))  # empty parts have no bytes and no tokens
                    n, crossing = np.zeros((2, len(parts)), np.int64)
                    if len(own):
                        n[own], crossing[own] = attribute(token_bytes(encoding, "".join(parts)), ends[own], rule)
                    ids += [doc_id] * len(parts)
                    names += fields
                    counts.append(n), crossings.append(crossing)
                flat = [pa.array(np.concatenate(c) if c else [], pa.int64()) for c in (counts, crossings)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names, pa.string()), *flat], ["doc_id", "field", "n_tokens", "n_crossing"])

    texts = [F.col(c).cast("string").alias(f"f{i}") for i, c in enumerate(fields)]
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), *texts).mapInArrow(run, "doc_id long, field string, n_tokens long, n_crossing long")
