"""Many plain patterns at once: an Aho-Corasick automaton per set of patterns, one pass per text.

Positions count characters from 0. Empty and NULL patterns find nothing; a NULL text holds
nothing. A pattern that stands several times in a set is found under each of its numbers.
"""

from __future__ import annotations

import functools
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

HITS = "array<struct<k:int,start:int,left:boolean,right:boolean>>"
_HIT = pa.struct([("k", pa.int32()), ("start", pa.int32()), ("left", pa.bool_()), ("right", pa.bool_())])
# Fixed value: the characters that regular expressions count as part of a word.
WORD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_")


@functools.lru_cache(maxsize=64)
def automaton(patterns: tuple[str | None, ...]) -> ahocorasick.Automaton | None:
    """The automaton of a set; a value holds the pattern's length and all its numbers."""
    numbers: dict[str, list[int]] = {}
    for k, pattern in enumerate(patterns):
        if pattern:
            numbers.setdefault(pattern, []).append(k)
    if not numbers:
        return None
    made = ahocorasick.Automaton()
    for pattern, ks in numbers.items():
        made.add_word(pattern, (len(pattern), ks))
    made.make_automaton()
    return made


def pattern_hits(text: Column, patterns: Column) -> Column:
    """Every place of every pattern of an array in a text, by place.

    ``k`` is the pattern's place in the array; ``left`` and ``right`` tell whether a word
    character stands right before and after it. Rows of equal patterns share an automaton.
    """
    @F.arrow_udf(HITS)
    def found(texts: pa.Array, sets: pa.Array) -> pa.Array:
        sizes, ks, starts, lefts, rights = array("i", [0]), array("i"), array("i"), bytearray(), bytearray()
        last, search = None, None
        for text, own in zip(texts, sets):  # a row at a time: the texts of a batch are never all objects of Python
            text, own = text.as_py(), own.as_py()
            if own != last:
                last, search = own, automaton(tuple(own)) if own else None
            if text and search is not None:
                for end, (size, numbers) in search.iter(text):
                    start = end + 1 - size
                    left, right = start > 0 and text[start - 1] in WORD, end + 1 < len(text) and text[end + 1] in WORD
                    for k in numbers:
                        ks.append(k)
                        starts.append(start)
                        lefts.append(left)
                        rights.append(right)
            sizes.append(len(ks))
        number = lambda a: pa.array(np.frombuffer(a, np.int32))
        flag = lambda a: pa.array(np.frombuffer(a, np.bool_))
        flat = pa.StructArray.from_arrays([number(ks), number(starts), flag(lefts), flag(rights)], fields=list(_HIT))
        return pa.ListArray.from_arrays(number(sizes), flat)

    return found(text, patterns)


def found_patterns(text: Column, patterns: Column) -> Column:
    """The patterns of an array that stand anywhere in a text, each once, in the array's order."""
    @F.arrow_udf("array<string>")
    def found(texts: pa.Array, sets: pa.Array) -> pa.Array:
        out, last, search = [], None, None
        for text, own in zip(texts, sets):
            text, own = text.as_py(), own.as_py()
            if own != last:
                last, search = own, automaton(tuple(own)) if own else None
            hit = {numbers[0] for _, (_, numbers) in search.iter(text)} if text and search is not None else ()
            out.append([own[k] for k in sorted(hit)])
        return pa.array(out, pa.list_(pa.string()))

    return found(text, patterns)


def replace_longest(text: Column, names: dict[str, str]) -> Column:
    """Every key replaced by its name in one pass; where keys overlap the longest goes first, then the leftmost."""
    keys = tuple(k for k in names if k)
    if not keys:
        return text

    @F.arrow_udf("string")
    def replaced(texts: pa.Array) -> pa.Array:
        search, out = automaton(keys), []
        for text in texts.to_pylist():
            hits = sorted((-size, end + 1 - size, numbers[0]) for end, (size, numbers) in search.iter(text)) if text else []
            if not hits:
                out.append(text)
                continue
            taken, chosen = bytearray(len(text)), []
            for size, start, k in hits:
                if not any(taken[start:start - size]):
                    taken[start:start - size] = b"\1" * -size
                    chosen.append((start, start - size, names[keys[k]]))
            parts, at = [], 0
            for start, end, name in sorted(chosen):
                parts += [text[at:start], name]
                at = end
            out.append("".join([*parts, text[at:]]))
        return pa.array(out, pa.string())

    return replaced(text)
