"""Secret scans through a trigram index.

Each rule's regular expression yields a Boolean query over the trigrams every match must
contain. A batch of texts is indexed by the trigrams that the rules ask for (one posting
bitmap per trigram), postings are intersected and united as the query says, and only the
candidates meet the regular expression. A rule without mandatory trigrams reads every text.

Null and empty texts have no spans. Repeated rows are scanned one by one. Texts are read
whole; the index of a batch takes a few bytes per byte of text. Spans count code points.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from re import _constants as ops, _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from prospectra.llm.common import text_slices

# A key block runs to its END line if that is the next marker. Else it takes header lines and runs of base64 in
# lines, quotes or escaped line ends, and at most two short last lines. Nothing in it steps back.
_KEY = r"[A-Z0-9 ]{0,20}PRIVATE KEY(?: BLOCK)?-----"
_GLUE = r"(?:\\+[nrt]?|<br ?/?>|[\s\"'>#*|,;+])"
_EOL = r"(?:\\+r)?(?:\\+n|[\r\n])"
_HEADERS = rf"(?:{_GLUE}*+[A-Za-z][A-Za-z0-9-]*+:[^\r\n\\]*+(?={_EOL}))*+"
_SHORT = rf"(?:[\x20\t\"',;]*+{_EOL}[\s\"'>#*|]*+[A-Za-z0-9+/=]{{1,15}}+(?=[\x20\t\"',;+]*+(?:\Z|{_EOL}))){{0,2}}+"
PRIVATE_KEY = (
    rf"-----BEGIN {_KEY}(?:(?>[^-]+|-(?!----(?:BEGIN|END) ))*+-----END {_KEY}"
    rf"|(?:{_HEADERS}(?:{_GLUE}*+[A-Za-z0-9+/=]{{16,}}+)++{_SHORT})?)"
)
# Kind, pattern, group that must reach a length, that length. The first three are the base kinds.
RULES = (
    ("assign", r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("slack", r"xox[baprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("google", r"AIza[0-9A-Za-z_-]{35}", 0, 0),
    ("stripe", r"[sr]k_live_[0-9A-Za-z]{16,}", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 0),
    ("private_key", PRIVATE_KEY, 0, 0),
)
BASE = ("assign", "access", "hex")
#: Literal variants followed while reading a pattern; beyond it the run of literals ends there.
VARIANTS = 64
ANY = ("any",)


def _all(parts: list) -> tuple:
    parts = [p for p in parts if p != ANY]
    return ANY if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _either(parts: list) -> tuple:
    return ANY if not parts or ANY in parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _grams(literal: str) -> tuple:
    return _all([("gram", literal[i:i + 3]) for i in range(len(literal) - 2)])


def _literals(item) -> set[str] | None:
    """All lower-cased strings an element of a parsed pattern stands for, or None if they are too many."""
    op, arg = item
    if op is ops.LITERAL:
        return {chr(arg).lower()} if arg < 128 else None
    if op is ops.IN and all(x[0] is ops.LITERAL and x[1] < 128 for x in arg):
        return {chr(x[1]).lower() for x in arg}
    if op is ops.SUBPATTERN:
        return _joined(arg[3])
    if op is ops.BRANCH:
        branches = [_joined(b) for b in arg[1]]
        return None if None in branches else set().union(*branches)
    if op is ops.MAX_REPEAT and arg[1] != ops.MAXREPEAT and arg[1] <= 4:
        inner, out = _joined(arg[2]), set()
        if inner is None:
            return None
        for n in range(arg[0], arg[1] + 1):
            now = {""}
            for _ in range(n):
                now = {a + b for a in now for b in inner}
            out |= now
        return out if len(out) <= VARIANTS else None
    return None


def _joined(items) -> set[str] | None:
    out = {""}
    for item in items:
        more = _literals(item)
        if more is None or len(out) * len(more) > VARIANTS:
            return None
        out = {a + b for a in out for b in more}
    return out


def trigram_query(pattern: str) -> tuple:
    """A Boolean query of lower-case ASCII trigrams that holds in every text with a match."""
    def read(items) -> tuple:
        found, run = [], {""}
        for item in items:
            more = _literals(item)
            if more is not None and len(run) * len(more) <= VARIANTS:
                run = {a + b for a in run for b in more}
                continue
            found.append(_either([_grams(s) for s in sorted(run)]))
            run = more if more is not None else {""}
            if more is None:
                op, arg = item
                if op is ops.SUBPATTERN:
                    found.append(read(arg[3]))
                elif op is ops.BRANCH:
                    found.append(_either([read(b) for b in arg[1]]))
                elif op is ops.MAX_REPEAT and arg[0] > 0:
                    found.append(read(arg[2]))
        return _all([*found, _either([_grams(s) for s in sorted(run)])])

    return read(parser.parse(pattern))


def _mentioned(query: tuple) -> set[str]:
    return {query[1]} if query[0] == "gram" else set().union(*map(_mentioned, query[1:])) if query != ANY else set()


class Scanner:
    """The rules, their trigram queries, and the index of a batch."""

    def __init__(self, rules=RULES):
        self.rules = [(kind, re.compile(p), group, least, trigram_query(p)) for kind, p, group, least in rules]
        grams = sorted(set().union(*(_mentioned(q) for *_, q in self.rules)))
        self.place = {g: i for i, g in enumerate(grams)}
        self.lookup = np.zeros(1 << 24, np.uint16)
        for g, i in self.place.items():
            a, b, c = g.encode("ascii")
            self.lookup[a << 16 | b << 8 | c] = i + 1
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        self.lower = lower.tobytes()

    def postings(self, texts: list[str]) -> np.ndarray:
        """One row per trigram asked for, one flag per text."""
        parts = [t.encode("utf-8", "surrogatepass").translate(self.lower) for t in texts]
        raw = np.frombuffer(b"\0\0".join(parts) + b"\0\0", np.uint8).astype(np.uint32)
        out = np.zeros((len(self.place), len(texts)), bool)
        gram = self.lookup[raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]]
        hits = np.flatnonzero(gram)
        ends = np.cumsum([len(p) + 2 for p in parts])
        out[gram[hits].astype(np.int64) - 1, np.searchsorted(ends, hits, "right")] = True
        return out

    def candidates(self, query: tuple, postings: np.ndarray) -> np.ndarray:
        if query == ANY:
            return np.ones(postings.shape[1], bool)
        if query[0] == "gram":
            return postings[self.place[query[1]]]
        parts = [self.candidates(q, postings) for q in query[1:]]
        return (np.logical_and if query[0] == "and" else np.logical_or).reduce(parts)

    def scan(self, texts: list[str | None]) -> list[list[tuple[str, int, int]]]:
        """Spans ``(kind, start, end)`` of every text, by kind as listed, then start."""
        out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        whole = [t or "" for t in texts]
        postings = self.postings(whole)
        for kind, pattern, group, least, query in self.rules:
            for i in np.flatnonzero(self.candidates(query, postings)).tolist():
                for m in pattern.finditer(whole[i]):
                    if m.end(group) - m.start(group) >= least:
                        out[i].append((kind, m.start(), m.end()))
        return out


SPANS = "array<struct<kind:string,start:long,end:long>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def by_start(spans: list[tuple[str, int, int]], kinds: tuple[str, ...]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0])))


def secret_spans(text: Column, rules=RULES) -> Column:
    """All secret spans of a text column, by start, then kind as listed."""
    kinds = tuple(r[0] for r in rules)

    @F.arrow_udf(SPANS)
    def scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(rules)
        for texts in batches:
            yield pa.array([
                [dict(zip(("kind", "start", "end"), s)) for s in by_start(spans, kinds)]
                for part in text_slices(texts) for spans in scanner.scan(part)
            ], SPAN_TYPE)

    return scanned(text)


def _marked(whole: str | None, spans: list[tuple[int, int]], mark: str) -> str | None:
    parts, at = [], 0
    for start, end in spans:
        if start >= at:
            parts += [whole[at:start], mark]
        at = max(at, end)
    return "".join([*parts, whole[at:]]) if parts else whole


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, overlapping ones joined, replaced by a mark."""
    @F.arrow_udf("string")
    def redacted(texts: pa.Array, found: pa.Array) -> pa.Array:
        return pa.array([
            _marked(whole, [(s["start"], s["end"]) for s in spans or ()], mark)
            for whole, spans in zip(texts.to_pylist(), found.to_pylist())
        ], pa.string())

    return redacted(text, spans)


def without_secrets(text: Column, rules=RULES, mark: str = "[SECRET]") -> Column:
    """The redacted text, null where nothing was found: spans and their removal in one worker, the text sent once."""
    kinds = tuple(r[0] for r in rules)

    @F.arrow_udf("string")
    def cleaned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(rules)
        for texts in batches:
            yield pa.array([
                _marked(whole, [s[1:] for s in by_start(spans, kinds)], mark) if spans else None
                for part in text_slices(texts) for whole, spans in zip(part, scanner.scan(part))
            ], pa.string())

    return cleaned(text)


def span_digests(spans: Column, base: tuple[str, ...] = BASE) -> Column:
    """Counts per base kind, the digest of the base spans and all spans as text, from spans in their order."""

    def shown(kept: Column) -> Column:
        return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return F.struct(
        *map(count, base), F.sha2(shown(F.filter(spans, lambda s: s["kind"].isin(*base))), 256).alias("base_sha256"),
        shown(spans).alias("spans"),
    )


def scan_secrets(docs: DataFrame, rules=RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, spans`` of every row; other columns are left out."""
    return docs.select(key, secret_spans(F.col(text), rules).alias("spans"))
