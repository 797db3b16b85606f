"""Quality rules by repetition coverage.

Words of a batch of texts become 64-bit hashes in one numpy array. A rolling hash over n
of them, salted with the text, names every n-gram; equal names inside a text mark its
duplicated n-grams, and the characters under the marks are measured, for several n and for
whole lines. A text fails when it is short, or when a measure passes its limit.

Null and empty texts have no words and fail. Repeated rows are judged one by one. The
arrays of a batch grow with its text, so any length fits that the text itself fits.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from prospectra.llm.common import WORD_SPACE, fields, mix, text_slices

SPACES = WORD_SPACE.encode()
SYMBOLS = b"#*$%&|<>"
#: The share of characters that may lie in duplicated n-grams, by n, and in duplicated lines: the published
#: limits of this rule, which fall with n. The base rule lets 20 % of words through, so each of them decides.
NGRAM_LIMITS = {5: 0.15, 7: 0.13, 10: 0.10}
LINE_LIMIT = 0.20
#: The share of symbols among the characters of words. Prose with mark-up or code reaches 0.13 and is wanted,
#: runs of symbols begin at a third; the limit lies between.
SYMBOL_LIMIT = 0.20
MIN_WORDS = 10
#: Words a repeated window counts over, and the percentage of words they may hold.
WINDOW, WINDOW_PERCENT = 5, 20
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars")


def repeated(words: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Marks the words inside n-grams that occur twice or more in their text."""
    out = np.zeros(len(words), bool)
    count = len(words) - n + 1
    if count < 2:
        return out
    rolled = np.zeros(count, np.uint64)
    for i in range(n):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + words[i:count + i]
    name = mix(rolled ^ mix(owner[:count].astype(np.uint64) + np.uint64(1)))
    inside = np.flatnonzero(owner[:count] == owner[n - 1:])
    name = name[inside]
    order = np.argsort(name, kind="stable")
    same = name[order][1:] == name[order][:-1]
    double = np.zeros(len(name), bool)
    double[order[1:]] |= same
    double[order[:-1]] |= same
    step = np.zeros(len(words) + 1, np.int64)
    starts = inside[double]
    np.add.at(step, starts, 1)
    np.add.at(step, starts + n, -1)
    return np.cumsum(step[:-1]) > 0


def measure(texts: list[str | None], lengths=tuple(NGRAM_LIMITS)) -> dict[str, np.ndarray]:
    """The measures of a batch of texts, ``dup_chars_n`` for every length among them."""
    out = {m: np.zeros(len(texts), np.int64) for m in MEASURES}
    hashes: list[int] = []
    sizes: list[int] = []
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        words = raw.split()
        out["n_words"][i] = len(words)
        if not words:
            continue
        out["word_chars"][i] = len(text) - sum(map(raw.count, (SPACES[j:j + 1] for j in range(len(SPACES)))))
        out["n_symbols"][i] = len(raw) - len(raw.translate(None, SYMBOLS))
        lines = Counter(line for line in raw.split(b"\n") if not line.isspace() and line)
        for line, n in lines.items():
            if n > 1:
                out["n_dup_lines"][i] += n - 1
                out["dup_line_chars"][i] += n * len(b"".join(line.split()).decode("utf-8", "surrogatepass"))
        hashes += map(hash, words)
        sizes += [len(w) if w.isascii() else len(w.decode("utf-8", "surrogatepass")) for w in words]
    words = mix(np.array(hashes, np.int64))
    owner = np.repeat(np.arange(len(texts)), out["n_words"])
    chars = np.array(sizes, np.int64)
    total = lambda marks, weight: np.bincount(owner[marks], weight[marks], len(texts)).astype(np.int64)
    out["n_repeat_words"] = total(repeated(words, owner, WINDOW), np.ones(len(words)))
    for n in lengths:
        out[f"dup_chars_{n}"] = total(repeated(words, owner, n), chars)
    return out


def verdicts(
    m: dict[str, np.ndarray], ngram_limits: dict[int, float] = NGRAM_LIMITS,
    line_limit: float = LINE_LIMIT, symbol_limit: float = SYMBOL_LIMIT,
) -> dict[str, np.ndarray]:
    """``base_failed`` and ``kept`` from the measures."""
    base = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > WINDOW_PERCENT * m["n_words"])
    failed = base | (m["n_symbols"] > symbol_limit * m["word_chars"]) | (m["dup_line_chars"] > line_limit * m["word_chars"])
    for n, share in ngram_limits.items():
        failed |= m[f"dup_chars_{n}"] > share * m["word_chars"]
    return {"base_failed": base, "kept": ~failed}


def quality(text: Column, ngram_limits: dict[int, float] = NGRAM_LIMITS, **limits: float) -> Column:
    """Measures and verdict of a text column as one struct."""
    names = [*MEASURES, *(f"dup_chars_{n}" for n in ngram_limits)]
    schema = "struct<" + ",".join([f"{n}:long" for n in names] + ["base_failed:boolean", "kept:boolean"]) + ">"

    @F.arrow_udf(schema)
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [measure(s, tuple(ngram_limits)) for s in text_slices(texts)] or [measure([], tuple(ngram_limits))]
            parts = [p | verdicts(p, ngram_limits, **limits) for p in parts]
            yield pa.StructArray.from_arrays(
                [pa.array(np.concatenate([p[n] for p in parts])) for n in [*names, "base_failed", "kept"]],
                [*names, "base_failed", "kept"],
            )

    return judged(text)


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """``key`` and all measures and verdicts of every row; other columns are left out."""
    return fields(docs.select(key, quality(F.col(text), **limits).alias("_q")), [key], "_q")
