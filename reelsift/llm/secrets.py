"""Secrets in texts: stated patterns, and random-looking strings found by how badly they compress into tokens.

Ordinary words and names take few tokens for their length; keys and passwords take many. A run of key characters whose
characters per token fall under a limit is reported, unless it is a known harmless kind: digests of the usual
lengths, UUIDs, and dotted or dashed numbers (dates, versions, addresses, telephone numbers). Letters of one case, which
long words and names joined by separators are, too, have a stricter limit. Of a run with a stated pattern inside, what
is outside the pattern is judged: parts of full length by themselves, shorter ones together.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.llm.common import slices

#: Kinds of the stated patterns, in the order that breaks ties; then the kind of the method.
KINDS = ("assign", "access", "hex")
METHOD_KIND = "dense"
MIN_LENGTH = 20
MAX_CHARS_PER_TOKEN = 2.2
#: For runs whose parts are each in one case, capitalized or digits: rare compounds have 1.91 and more, 20 random letters 1.67 in the median.
MAX_ONE_CASE = 1.9

_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # runs are taken whole, so shorter ones drop out
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_LENGTH)
_DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64})\Z")
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
_NUMBER = re.compile(r"[0-9+/_=-]+\Z")
_SCHEMA = "doc_id long, kind string, start int, end int, value string, chars_per_token double"
#: Evidence that any pattern of ``_ASSIGN`` needs; cheaper to look for than the pattern itself.
_NEEDED = re.compile(r"[:=]")


def _base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the stated patterns."""
    found = []
    if _NEEDED.search(text):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def harmless(run: str) -> bool:
    """Known digests, identifiers and numbers."""
    return bool(_DIGEST.match(run) or _UUID.match(run) or _NUMBER.match(run))


def in_one_case(run: str) -> bool:
    """Whether each part between separators is lower-case, upper-case, capitalized or a number, as words are."""
    return all(p.isalpha() and (p.islower() or p.isupper() or p.istitle()) or p.isdigit() or not p for p in re.split(r"[+/_=-]+", run))


class TokenRatio:
    """Characters per token of a string under a byte-level vocabulary given as ranks."""

    def __init__(self, ranks: str, pattern: str):
        import base64

        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("spans", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def __call__(self, run: str) -> float:
        return len(run) / len(self.encoding.encode_ordinary(run))


_RATIOS: dict[tuple[str, str], TokenRatio] = {}


def _ratio(ranks: str, pattern: str) -> TokenRatio:
    if (ranks, pattern) not in _RATIOS:
        _RATIOS[ranks, pattern] = TokenRatio(ranks, pattern)
    return _RATIOS[ranks, pattern]


def _outside(start: int, end: int, base: list[tuple[int, int, int]], low: int) -> list[tuple[int, int]]:
    """The parts of ``[start, end)`` that no stated pattern covers; ``base`` is sorted by start, those before ``low`` end before."""
    parts = []
    for k in range(low, len(base)):
        a, _, b = base[k]
        if a >= end:
            break
        if start < b:
            if a > start:
                parts.append((start, a))
            start = b
    return [*parts, (start, end)] if start < end else parts


def _dense(parts: list[str], ratio, limit: float) -> float | None:
    """Characters per token of parts of one run if they are under the limit."""
    if sum(map(len, parts)) < MIN_LENGTH or all(map(harmless, parts)):
        return None
    r = sum(map(len, parts)) / sum(len(p) / ratio(p) for p in parts)
    return r if r < (min(limit, MAX_ONE_CASE) if all(map(in_one_case, parts)) else limit) else None


def text_spans(text: str, ratio, limit: float = MAX_CHARS_PER_TOKEN) -> list[tuple[int, int, int, float | None]]:
    """(start, kind, end, ratio) of everything found in a text; the method's spans have no base span inside or around them."""
    base = _base_spans(text)
    spans: list[tuple[int, int, int, float | None]] = [(a, k, b, None) for a, k, b in base]
    low = 0
    for m in _RUN.finditer(text):
        # Runs and base spans both go on through the text, so each is passed once.
        while low < len(base) and base[low][2] <= m.start():
            low += 1
        parts = _outside(m.start(), m.end(), base, low)
        groups = [[p] for p in parts if p[1] - p[0] >= MIN_LENGTH] + [[p for p in parts if p[1] - p[0] < MIN_LENGTH]]
        for spots in groups:
            if (r := _dense([text[a:b] for a, b in spots], ratio, limit)) is not None:
                spans += [(a, len(KINDS), b, r) for a, b in spots]
    return sorted(spans, key=lambda s: s[:3])


def find_secrets(docs: DataFrame, ranks: str, pattern: str, limit: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """One row per span: ``doc_id, kind, start, end`` (code points, end exclusive), ``value`` and, for kind ``dense``, its ratio.

    Whole texts; a null text has no spans. ``ranks`` is the path of a rank file and ``pattern`` its splitting pattern.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = _ratio(ranks, pattern)
        for part in slices(batches, "text"):
            rows = [
                (i, (*KINDS, METHOD_KIND)[k], a, b, t[a:b], r)
                for i, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True)
                for a, k, b, r in text_spans(t or "", ratio, limit)
            ]
            columns = list(zip(*rows, strict=True)) or [()] * 6
            types = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "kind", "start", "end", "value", "chars_per_token"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(scan, _SCHEMA)


def secrets_per_document(docs: DataFrame, ranks: str, pattern: str, limit: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """One row per document: ``doc_id``, counts of each kind, ``base_sha256`` over the stated patterns' spans, ``spans``, ``n_dense``.

    ``spans`` has every span as ``kind:start:end``, by start and then kind, joined by commas. Nothing is shuffled: a
    row of the input is a row of the result, repeated ``doc_id`` included.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio, names = _ratio(ranks, pattern), (*KINDS, METHOD_KIND)
        for part in slices(batches, "text"):
            counts: list[list[int]] = [[] for _ in names]
            shas, told = [], []
            for text in part.column("text").to_pylist():
                spans = text_spans(text or "", ratio, limit)
                for k, c in enumerate(counts):
                    c.append(sum(s[1] == k for s in spans))
                shas.append(hashlib.sha256(",".join(f"{names[k]}:{a}:{b}" for a, k, b, _ in spans if k < len(KINDS)).encode()).hexdigest())
                told.append(",".join(f"{names[k]}:{a}:{b}" for a, k, b, _ in spans))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(shas), pa.array(told)],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_dense", "base_sha256", "spans"],
            )

    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_dense long, base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(scan, schema)


def redacted(docs: DataFrame, ranks: str, pattern: str, mark: str = "[secret]", limit: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark``, overlapping spans by one; other columns stay, null texts too."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = _ratio(ranks, pattern)
        for part in slices(batches, "text"):
            texts = []
            for text in part.column("text").to_pylist():
                out, at = [], 0
                for a, _, b, _ in text_spans(text or "", ratio, limit):
                    if a >= at:
                        out += [text[at:a], mark]
                    at = max(at, b)
                texts.append(None if text is None else "".join(out) + text[at:])
            names = part.schema.names
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else part.column(c) for c in names], names)

    return docs.mapInArrow(scan, docs.schema)
