"""Token counts by rank-synchronous merging of many pre-tokens at once.

Distinct pre-tokens of a batch lie in one ragged numpy array of symbol ids. Each
round finds the lowest-rank pair of every sequence, applies it in all of them
together, and looks up ranks again only beside a merge. A sequence without a
pair is finished; its surviving symbols are its token count.

Null and empty texts have no tokens. Repeated rows are counted one by one. Texts
of any length are handled whole; there is no truncation.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from prospectra.llm.common import text_slices

NONE = np.int32(2**31 - 1)
#: Counts of chunks a worker remembers; beyond it the memory starts anew. A cache only: results do not depend on it.
REMEMBERED = 600_000
# The contractions the vocabulary keeps apart.
CONTRACTIONS = r"'s|'t|'re|'ve|'m|'ll|'d"


def byte_symbols() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if printable, else the next from 256."""
    shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class WordMerges:
    """The merge table of a word-end vocabulary and the merging of batches."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.specials = [t["content"] for t in spec["added_tokens"]]
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.final = np.array([vocab[s + end] for s in symbols], np.int64)
        self.width = max(vocab.values()) + 1
        pairs = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in spec["model"]["merges"]], np.int64)
        keys = pairs[:, 0] * self.width + pairs[:, 1]
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int32), pairs[:, 2]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NONE)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Symbols left in each of the non-empty words."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        out = np.ones(len(words), np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(lengths)
        ids = self.inner[raw]
        ids[ends - 1] = self.final[raw[ends - 1]]
        owner = np.repeat(np.arange(len(words)), lengths)
        rank = np.full(len(ids), NONE, np.int32)
        if len(ids) > 1:
            rank[:-1] = self.rank(ids[:-1], ids[1:])
        rank[ends - 1] = NONE
        while len(ids):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(ids)])
            best = np.minimum.reduceat(rank, starts)
            live = best != NONE
            out[owner[starts[~live]]] = sizes[~live]
            if not live.any():
                break
            if not live.all():
                keep = np.repeat(live, sizes)
                ids, owner, rank = ids[keep], owner[keep], rank[keep]
                best, sizes = best[live], sizes[live]
            hit = np.flatnonzero(rank == np.repeat(best, sizes))
            # A run of touching hits, as in "aaaa", merges at its first, third, ... place.
            run = np.maximum.accumulate(np.where(np.r_[True, np.diff(hit) != 1], np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
            ids[hit] = self.made[rank[hit]]
            rank[hit] = rank[hit + 1]  # NONE where the merged pair closed its word
            last = owner[np.minimum(hit + 2, len(ids) - 1)] != owner[hit]
            last |= hit + 2 >= len(ids)
            stay = np.ones(len(ids), bool)
            stay[hit + 1] = False
            new = hit - np.arange(len(hit))  # places after the removals
            ids, owner, rank = ids[stay], owner[stay], rank[stay]
            rank[new[last]] = NONE
            for at in (new[~last], new[new > 0] - 1):
                at = at[owner[at] == owner[np.minimum(at + 1, len(ids) - 1)]]
                at = at[at + 1 < len(ids)]
                rank[at] = self.rank(ids[at], ids[at + 1])
        return out


def plain(text: str) -> bool:
    """Whether own and library rules for letters, digits and white space agree: Latin-1 without 1C to 1F."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return not any(c in text for c in "\x1c\x1d\x1e\x1f")


class TokenCounter:
    """Pre-tokens of texts and the sum of their merged sizes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.merges = WordMerges(path)
        self.library = Tokenizer.from_file(path)
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.merges.specials, key=len, reverse=True))) or r"(?!)")
        space = r"\t-\r \x85\xa0"
        self.words = regex.compile(rf"{CONTRACTIONS}|\p{{L}}+|\p{{N}}|[^{space}\p{{L}}\p{{N}}]+")
        self.symbol_bytes = {s: b for b, s in enumerate(byte_symbols())}
        self.known: dict[str, int] = {}

    def chunks(self, text: str) -> list[str]:
        """Normalised runs between white space, which no pre-token crosses; beyond plain text by the library's rules."""
        if plain(text):
            return text.lower().split()
        return [c for c in self.library.normalizer.normalize_str(text).split(" ") if c]

    def split(self, chunk: str) -> list[bytes]:
        """The pre-tokens of a chunk as bytes; the first two cases only save the pattern's time."""
        if plain(chunk):
            if chunk.isalpha():
                return [chunk.encode()]
            if chunk[:-1].isalpha():
                return [chunk[:-1].encode(), chunk[-1].encode()]
            return [w.encode() for w in self.words.findall(chunk)]
        pieces = self.library.pre_tokenizer.pre_tokenize_str(chunk)
        return [bytes(map(self.symbol_bytes.__getitem__, piece)) for piece, _ in pieces]

    def learn(self, chunks: list[str]) -> None:
        """Counts new chunks, all their pre-tokens in one merge."""
        words = list(map(self.split, chunks))
        distinct = list({w for ws in words for w in ws})
        each = dict(zip(distinct, self.merges.counts(distinct).tolist())) if distinct else {}
        self.known.update((c, sum(map(each.__getitem__, ws))) for c, ws in zip(chunks, words))

    def count(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        if len(self.known) > REMEMBERED:
            self.known = {}
        held: list[tuple[int, list[str]]] = []
        new: set[str] = set()
        for i, text in enumerate(texts):
            if not text:
                continue
            pieces = [text]
            if "<|" in text and self.special.search(text):
                out[i] = len(self.special.findall(text))
                pieces = self.special.split(text)
            for piece in pieces:
                chunks = self.chunks(piece)
                new.update(set(chunks).difference(self.known))
                held.append((i, chunks))
        if new:
            self.learn(list(new))
        for i, chunks in held:
            out[i] += sum(map(self.known.__getitem__, chunks))
        return out


@functools.lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    """One counter per worker and vocabulary."""
    return TokenCounter(path)


def n_tokens(text: Column, path: str) -> Column:
    """Token count of a text column; 0 for null."""
    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        parts = [counter(path).count(s) for s in text_slices(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64))

    return counted(text)


def token_counts(docs: DataFrame, path: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of every row; other columns are left out."""
    counted = docs.select(key, F.col(text).alias("_text")).select(
        key, F.coalesce(F.octet_length("_text"), F.lit(0)).cast("long").alias("n_bytes"),
        n_tokens(F.col("_text"), path).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
