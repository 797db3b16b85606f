"""Language identification by cross-parsing.

From a bounded sample of labelled text per language a suffix automaton is built. A text is
parsed against each language from left to right into longest matches: a phrase goes on while
the automaton has a transition and ends where it has none. The language that needs the
fewest phrases per character wins; ties go to the first in code point order.

Texts are parsed in lanes of equal pieces, all pieces and languages of a batch stepping
through dense transition tables together. Cutting a text into pieces adds at most one phrase
per piece and language. Null texts and texts without a letter are ``und`` with score 0.
Repeated rows are judged one by one. Without a labelled row every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from prospectra.llm.common import fields, text_slices

#: Documents and characters of training text per language; documents come in the order of a hash of their id.
TRAIN_DOCS, TRAIN_CHARS, DOC_CHARS = 400, 40_000, 400
SAMPLE_BUCKETS = 64
#: Characters of a piece of text in a lane.
PIECE = 512
UNKNOWN = "und"


class Automaton:
    """A suffix automaton over small integers, as a dense table; -1 where there is no transition."""

    def __init__(self, sequence: list[int], symbols: int):
        moves: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in sequence:
            now = len(moves)
            moves.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and c not in moves[p]:
                moves[p][c] = now
                p = link[p]
            if p != -1:
                q = moves[p][c]
                if length[p] + 1 == length[q]:
                    link[now] = q
                else:
                    copy = len(moves)
                    moves.append(dict(moves[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and moves[p].get(c) == q:
                        moves[p][c] = copy
                        p = link[p]
                    link[q] = link[now] = copy
            last = now
        self.table = np.full((len(moves), symbols), -1, np.int32)
        for state, row in enumerate(moves):
            for c, to in row.items():
                self.table[state, c] = to


class Parser:
    """Automata of all languages over one alphabet, and the parsing of batches."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        kept = sorted({c for t in samples.values() for c in self.clean(t)})
        # One symbol per character of the samples; everything else is the last one, which no automaton knows.
        self.symbols = {c: i for i, c in enumerate(kept)}
        self.other = len(kept)
        tables = [Automaton([self.symbols[c] for c in self.clean(t)], self.other + 1).table for _, t in sorted(samples.items())]
        self.bases = np.cumsum([0, *(len(t) for t in tables[:-1])]).astype(np.int64)
        self.table = np.concatenate([np.where(t >= 0, t + np.int32(b), np.int32(-1)) for t, b in zip(tables, self.bases)]) if tables else np.zeros((0, 1), np.int32)
        self.lookup = np.full(0x110000, self.other, np.uint16)
        for c, i in self.symbols.items():
            self.lookup[ord(c)] = i

    @staticmethod
    def clean(text: str) -> str:
        """Lower-cased words, one space between them."""
        return " ".join(text.lower().split())

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases per text and language."""
        codes = [self.lookup[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)] for t in map(self.clean, texts)]
        pieces = [(i, c[k:k + PIECE]) for i, c in enumerate(codes) for k in range(0, len(c), PIECE)]
        pieces.sort(key=lambda p: -len(p[1]))
        sizes = np.array([len(p) for _, p in pieces], np.int64)
        lanes = np.full((PIECE, len(pieces)), self.other, np.uint16)
        for lane, (_, piece) in enumerate(pieces):
            lanes[:len(piece), lane] = piece
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        owner = np.array([i for i, _ in pieces], np.int64)
        flat, width = self.table.ravel(), self.table.shape[1]
        for k, base in enumerate(self.bases.tolist()):
            unknown = self.table[base] < 0  # such a character is a phrase of its own
            root = np.maximum(self.table[base], base)
            state = np.full(len(pieces), base, np.int32)
            count = np.zeros(len(pieces), np.int64)
            for step in range(PIECE):
                live = np.searchsorted(-sizes, -step, "left")
                if not live:
                    break
                symbol = lanes[step, :live]
                to = flat[state[:live].astype(np.int64) * width + symbol]
                missed = to < 0
                count[:live] += (missed & (state[:live] != base)).astype(np.int64) + (missed & unknown[symbol])
                state[:live] = np.where(missed, root[symbol], to)
            out[:, k] = np.bincount(owner, count + (state != base), len(texts)) if len(pieces) else 0
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        whole = [t or "" for t in texts]
        count = self.phrases(whole) if self.languages else np.zeros((len(texts), 0))
        out = []
        for text, row in zip(whole, count):
            if not len(row) or not any(map(str.isalpha, text)):
                out.append((UNKNOWN, 0.0))
                continue
            best = int(np.argmin(row))
            rest = np.delete(row, best)
            # How much shorter the parse is than the next language's.
            out.append((self.languages[best], float(1 - row[best] / rest.min()) if len(rest) else 1.0))
        return out


def training_samples(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
                     train_docs: int = TRAIN_DOCS, train_chars: int = TRAIN_CHARS, doc_chars: int = DOC_CHARS) -> dict[str, str]:
    """Text per language: pieces of up to ``doc_chars`` of the first ``train_docs`` documents by hash of their id.

    The rows collected are bounded by languages times ``train_docs`` times ``doc_chars``. A language
    is first cut down in ``SAMPLE_BUCKETS`` by the hash, so the task that ranks it gets a bounded
    number of rows, however large it is. The bound on a document keeps one long text from being
    the whole sample.
    """
    code = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("_lang"), code.alias("_code"), F.substring(F.col(text), 1, doc_chars).alias("_text"))
    # A row of the first ``train_docs`` is among the first of its bucket.
    bucket = F.pmod(F.xxhash64("_code"), F.lit(SAMPLE_BUCKETS))
    picked = rows.withColumn("_bucket", bucket)
    for keys in (["_lang", "_bucket"], ["_lang"]):
        first = Window.partitionBy(*keys).orderBy("_code", "_text")
        picked = picked.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= train_docs).drop("_n")
    picked = picked.drop("_bucket").collect()
    out: dict[str, str] = {}
    for row in sorted(picked):
        held = out.get(row["_lang"], "")
        if len(held) < train_chars:
            out[row["_lang"]] = held + "\n" + row["_text"]
    return {k: v[:train_chars] for k, v in out.items()}


def language(text: Column, samples: dict[str, str]) -> Column:
    """``lang_pred`` and ``score`` of a text column."""
    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def identified(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        parser = Parser(samples)
        for texts in batches:
            found = [x for part in text_slices(texts) for x in parser.predict(part)]
            yield pa.StructArray.from_arrays(
                [pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], ["lang_pred", "score"])

    return identified(text)


def identify(docs: DataFrame, learn_from: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", **bounds: int) -> DataFrame:
    """``key, lang_pred, score`` of every row, learnt from the labelled rows that ``learn_from`` admits."""
    samples = training_samples(docs.filter(learn_from), key, text, lang, **bounds)
    return fields(docs.select(key, language(F.col(text), samples).alias("_l")), [key], "_l")
