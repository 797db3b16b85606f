"""Phrase collocations from sorted count streams.

Counts: texts are scanned three times, for words, for hashes of pairs and for phrases, each
time as numpy arrays of word numbers with breaks between pieces. A phrase can only be
frequent if its words are, and its pairs, so a scan leaves out what the one before ruled out.
It asks a bit map of fixed size for that: a wrong yes costs a row that is cut later, a wrong
no can't happen, and counts of frequent phrases are exact. Most pairs are rare, so the second
scan sends no words: a pair is a cell, its count is added to the cell's, and a task packs the
cells of each part into one row. Parts grow in number with the text, so that one stays small
and cells stay nearly empty; the last scan counts the pairs of the cells that reach the limit.

Scores: the counts of all frequent phrases lie in two streams, one in prefix order (by
words) and one in suffix order (by words from the last). A stream is read in lockstep with
itself: the counts of a phrase's beginnings stand above it on a stack, the word total of
its language below all. So prefix order gives the left counts and the largest extension to
the right, suffix order the right counts and the largest extension to the left, without
lookups. Where a range of a stream starts, the at most ``longest`` counts above its first
phrase are fetched, one small row per range.

A phrase lies in a longer one with as many occurrences exactly if it does in one that is a
single word longer, since counts never grow with length.

Null texts are empty, a null language is named ``und``. Repeated rows count each time. A text
of any length is cut into slices between words and counted across them; a single word may
have any length. An empty table, or one without frequent phrases, gives no rows. Columns
beyond language and text are left out. Ties are ordered by the phrase.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from prospectra.llm.common import SLICE_BYTES, cut, in_ranges, mix, ranged

LONGEST = 5
LEAST = 100
TOP = 2000
#: Words after which a task's counts are handed on.
FLUSH = 3_000_000
#: Size of a bit map.
BITS = 1 << 27
#: Words of text for each part of the pairs' cells, and the bits that number a cell within its part.
PART_WORDS = 2_000_000
CELL_BITS = 24
TOKEN = re.compile(rb"[^ \t.,;:!?\n-\r]+|[.,;:!?\n-\r]")
EDGE = re.compile(rb"[ \t.,;:!?\n-\r]")
BREAKS = [bytes([c]) for c in b".,;:!?\n\x0b\x0c\r"]
#: Joins words: the one character, besides the space, that no word holds.
TAB = "\t"


class Words(dict):
    """Numbers of words from 1; 0 is a break."""

    def __init__(self):
        super().__init__(dict.fromkeys(BREAKS, 0))
        self.list: list[bytes] = [b""]

    def __missing__(self, word: bytes) -> int:
        self[word] = k = len(self.list)
        self.list.append(word)
        return k


class Run:
    """The word numbers of one language; the first ``known`` were counted before."""

    def __init__(self, words: list[bytes] = ()):
        self.words = Words()
        self.parts = [np.array([self.words[w] if w else 0 for w in words], np.int64)]
        self.known = len(words)

    def add(self, data: bytes) -> int:
        ids = list(map(self.words.__getitem__, TOKEN.findall(data.lower())))
        self.parts.append(np.array(ids, np.int64))
        return len(ids)

    def close(self, tail: int) -> tuple[np.ndarray, Run]:
        """All numbers, and the run that goes on after them."""
        ids = np.concatenate(self.parts)
        return ids, Run([self.words.list[k] for k in ids[max(0, len(ids) - tail):].tolist()] if tail else [])


def slices(data: bytes, limit: int = SLICE_BYTES) -> Iterator[bytes]:
    """A text in parts that end between words."""
    at = 0
    while len(data) - at > limit:
        edge = EDGE.search(data, at + limit)
        if not edge:
            break
        yield data[at:edge.start()]
        at = edge.start()
    yield data[at:]


def _distinct(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One place of each key, how often it stands, and the number of every key."""
    _, first, number, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return at[first], count, number


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    head = lang.encode() + b"\t"
    return np.frombuffer(b"".join(hashlib.blake2b(head + w, digest_size=8).digest() for w in words), "<u8")


def pair_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


def _probes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return hashes % np.uint64(BITS), (hashes >> np.uint64(32)) % np.uint64(BITS)


def cells_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The cells of pairs, a part's number above its own."""
    count = np.uint64(parts)
    return hashes % count << np.uint64(CELL_BITS) | hashes // count % np.uint64(1 << CELL_BITS)


def may_hold(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    out = np.ones(len(hashes), bool)
    for place in _probes(hashes):
        out &= (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return out


#: Per length of phrases: places where one begins and how often, of one language's numbers.
Found = list[tuple[int, np.ndarray, np.ndarray]]


def single(lang: str, words: list[bytes], ids: np.ndarray, known: int, bits: np.ndarray | None) -> Found:
    at = known + np.flatnonzero(ids[known:])
    places, count, _ = _distinct(ids[at], at)
    return [(1, places, count)]


def _pairs(ids: np.ndarray, ok: np.ndarray) -> np.ndarray:
    """Places where a pair of allowed words begins."""
    allowed = ok[ids]
    return np.flatnonzero(allowed[:-1] & allowed[1:])


def pairs(lang: str, words: list[bytes], ids: np.ndarray, known: int, bits: np.ndarray) -> np.ndarray:
    """The hash of every new pair of allowed words."""
    hashes = word_hashes(lang, words)
    ok = may_hold(bits, hashes)
    ok[0] = False
    at = _pairs(ids, ok)
    at = at[at + 1 >= known]
    return pair_hashes(hashes[ids[at]], hashes[ids[at + 1]])


def phrases(longest: int, parts: int) -> Callable:
    def longer(lang: str, words: list[bytes], ids: np.ndarray, known: int, bits: np.ndarray) -> Found:
        whole = np.ones(len(words), bool)
        whole[0] = False
        hashes = word_hashes(lang, words)
        at = _pairs(ids, whole)
        at = at[may_hold(bits, mix(cells_of(pair_hashes(hashes[ids[at]], hashes[ids[at + 1]]), parts)))]
        starts = np.zeros(len(ids) + longest, bool)
        starts[at] = True
        number = np.zeros(len(ids) + longest, np.int64)
        number[at] = _distinct(ids[at] * len(words) + ids[at + 1], at)[2]
        out = []
        for k in range(2, longest + 1):
            if k > 2:
                at = at[starts[at + k - 2]]
                _, _, number[at] = _distinct(number[at] * len(words) + ids[at + k - 1], at) if len(at) else (None, None, 0)
            new = at[at + k > known]  # places whose last word is new
            places, count, _ = _distinct(number[new], new)
            out.append((k, places, count))
        return out

    return longer


def _rows(found: Iterator[tuple[str, list[bytes], np.ndarray, Found]]) -> Iterator[pa.RecordBatch]:
    for lang, words, ids, phrases in found:
        words = pa.array(words, pa.binary()).cast(pa.string())
        for length, places, count in phrases:
            if len(places):
                flat = ids[places[:, None] + np.arange(length)].ravel()
                lists = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, length, np.int32), words.take(pa.array(flat)))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(places)), pc.binary_join(lists, TAB), pa.array(count.astype(np.int64))], ["lang", "phrase", "n"])


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers byte by byte, lowest bytes first: the upper ones are nearly all 0, which Spark's shuffle compresses."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def packed(cells: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending cells of a part, as steps, and their counts."""
    return _planes(np.diff(cells, prepend=cells.dtype.type(0))) + _planes(counts)


def unpacked(packet: pa.Buffer) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = (x.T.copy().view("<u4").ravel().astype(np.int64) for x in np.frombuffer(packet, np.uint8).reshape(2, 4, -1))
    return np.cumsum(steps), counts


def scanned(texts: DataFrame, find: Callable, hand: Callable, schema: str, tail: int, bits, flush: int) -> DataFrame:
    """The rows that ``hand`` makes of what ``find`` finds in the words of each flush; ``tail`` words are shared by flushes."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: dict[str, Run] = {}
        held = 0
        allowed = bits.value if bits else None

        def found() -> Iterator[tuple]:
            for lang, run in runs.items():
                ids, rest = run.close(tail)
                yield lang, run.words.list, ids, find(lang, run.words.list, ids, run.known, allowed)
                runs[lang] = rest

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                run = runs.setdefault(lang, Run())
                for part in slices(text.as_buffer().to_pybytes() if text.is_valid else b""):
                    held += run.add(part)
                    if held >= flush:
                        yield from hand(found())
                        run, held = runs[lang], 0
                held += run.add(b"\n")
        yield from hand(found())

    return texts.mapInArrow(scan, schema)


def counted(texts: DataFrame, find: Callable, tail: int, bits=None, flush: int = FLUSH) -> DataFrame:
    """``lang, phrase, n`` of the phrases that ``find`` finds, words joined by tabs."""
    return scanned(texts, find, _rows, "lang string, phrase string, n long", tail, bits, flush).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def pair_packets(texts: DataFrame, bits, parts: int, flush: int = FLUSH) -> DataFrame:
    """``part, packet``: the cells of the pairs of allowed words, a row per flush and part."""
    def packets(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        hashes = np.concatenate([np.zeros(0, np.uint64), *(f[3] for f in found)])
        cells, counts = np.unique(cells_of(hashes, parts), return_counts=True)
        part = (cells >> np.uint64(CELL_BITS)).astype(np.int32)
        edges = np.flatnonzero(np.diff(part, prepend=-1, append=-1)).tolist() if len(part) else []
        cells &= np.uint64((1 << CELL_BITS) - 1)
        rows = [packed(cells[a:b], counts[a:b]) for a, b in zip(edges, edges[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(part[edges[:-1]], pa.int32()), pa.array(rows, pa.binary())], ["part", "packet"])

    return scanned(texts, pairs, packets, "part int, packet binary", 1, bits, flush)


def frequent_cells(packets: DataFrame, least: int) -> DataFrame:
    """``cell`` of those whose pairs occur ``least`` times together."""
    def summed(keys: tuple, rows: pa.Table) -> pa.Table:
        cells, counts = zip(*(unpacked(p.as_buffer()) for p in rows.column("packet")))
        cells, which = np.unique(np.concatenate(cells), return_inverse=True)
        often = cells[np.bincount(which, np.concatenate(counts)) >= least]
        return pa.table({"cell": pa.array((keys[0].as_py() << CELL_BITS) + often, pa.int64())})

    return packets.groupBy("part").applyInArrow(summed, "cell long")


def bit_map(frequent: DataFrame, words: int):
    """A broadcast bit map of words, or of pairs' cells; its size is fixed, so it bounds what the driver gets."""
    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if words == 1:
                hashes = [word_hashes(lang, [p.encode()]) for lang, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
                hashes = np.concatenate([np.zeros(0, np.uint64), *hashes])
            else:
                hashes = mix(batch.column(0).to_numpy())
            for place in _probes(hashes):
                bit = (np.uint64(1) << (place & np.uint64(63))).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array((place >> np.uint64(6)).astype(np.int64)), pa.array(bit)], ["cell", "bits"])

    cells = frequent.select(*["lang", "phrase"] if words == 1 else ["cell"]).mapInArrow(marks, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(BITS // 64, np.uint64)
    out[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy().view(np.uint64)
    return frequent.sparkSession.sparkContext.broadcast(out)


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, text: str = "text", lang: str = "lang", flush: int = FLUSH) -> DataFrame:
    """``lang, words, f`` of every phrase of up to ``longest`` words with ``least`` occurrences, and of no words, the total."""
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    often = F.col("n") >= least
    every = cut(counted(texts, single, 0, flush=flush), "words")
    streams = [every.groupBy("lang").agg(F.sum("n").alias("n")).select("lang", F.lit("").alias("phrase"), "n"), every.filter(often)]
    if longest > 1:
        parts = -(-(every.agg(F.sum("n")).first()[0] or 0) // PART_WORDS) or 1
        cells = frequent_cells(pair_packets(texts, bit_map(streams[1], 1), parts, flush), least)
        streams.append(counted(texts, phrases(longest, parts), longest - 1, bit_map(cells, 2), flush).filter(often))
    out = streams[0]
    for more in streams[1:]:
        out = out.unionByName(more)
    words = F.when(F.col("phrase") == "", F.array().cast("array<string>")).otherwise(F.split("phrase", TAB))
    return cut(out.select("lang", words.alias("words"), F.col("n").alias("f")), "phrases")


def above(stream: DataFrame) -> DataFrame:
    """``lang, words, f, parts, more``: the counts of a phrase's beginnings and of its commonest longer form, in lockstep.

    A phrase whose longer forms lie in several ranges has several rows, ``f`` and ``parts`` null in all but one.
    """
    order = ["lang", "words"]
    rows = ranged(stream, order, "phrase-stream")
    # The first phrase of every range, and the counts that stand above it: at most a row per range and word.
    opens = rows.groupBy("_part").agg(F.min(F.struct(*order)).alias("_o"))
    begin = opens.select("_part", F.col("_o.lang").alias("lang"), F.explode(F.expr("transform(sequence(0, size(_o.words)), k -> slice(_o.words, 1, k))")).alias("words"))
    begin = begin.join(opens, "_part").filter(F.size("words") < F.size("_o.words")).drop("_o")
    held = stream.join(F.broadcast(begin), order).groupBy("_part").agg(F.sort_array(F.collect_list(F.struct(F.size("words").alias("k"), "f"))).alias("_above"))
    held = cut(held, "range-starts")

    def lockstep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[list] = []  # words, count, commonest longer form, counts above, whether the row is of this range
        part, lang = None, None

        def drop(depth: int) -> Iterator[tuple]:
            while len(stack) > depth:
                words, f, more, parts, own = stack.pop()
                if own or more is not None:
                    yield lang, words, f if own else None, parts if own else None, more

        for batch in batches:
            out = []
            for p, now, words, f, start in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if p != part:
                    out += drop(0)
                    part, lang = p, now
                    for x in start or []:
                        stack.append([words[:x["k"]], x["f"], None, [y[1] for y in stack], False])
                elif now != lang:
                    out += drop(0)
                    lang = now
                depth = len(stack)
                while depth and stack[depth - 1][0] != words[:len(stack[depth - 1][0])]:
                    depth -= 1
                out += drop(depth)
                if stack:
                    stack[-1][2] = max(stack[-1][2] or 0, f)
                stack.append([words, f, None, [y[1] for y in stack], True])
            yield _batch(out)
        yield _batch(list(drop(0)))

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64()), pa.int64())
        columns = zip(*out) if out else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["lang", "words", "f", "parts", "more"])

    # As many rows as ranges.
    placed = in_ranges(rows.join(F.broadcast(held), "_part", "left"), order).select("_part", "lang", "words", "f", "_above")
    return placed.mapInArrow(lockstep, "lang string, words array<string>, f long, parts array<long>, more long")


def scored(stream: DataFrame) -> DataFrame:
    """``lang, words, a, l, r, n, score`` of the phrases that no longer one covers."""
    back = above(stream.select("lang", F.reverse("words").alias("words"), "f"))
    none = F.lit(None).cast("array<long>")
    both = above(stream).select("lang", "words", "f", F.col("parts").alias("_l"), none.alias("_r"), "more").unionByName(
        back.select("lang", F.reverse("words").alias("words"), F.lit(None).cast("long").alias("f"), none.alias("_l"), F.col("parts").alias("_r"), "more"))
    rows = both.groupBy("lang", "words").agg(F.max("f").alias("a"), F.max("_l").alias("_l"), F.max("_r").alias("_r"), F.max("more").alias("more"))
    rows = rows.filter((F.size("words") > 1) & (F.coalesce("more", F.lit(0)) < F.col("a")))
    # The parts begin with the word total. Decimals of 38 digits hold the products, and div cuts exactly.
    cuts = F.expr("""
        transform(sequence(1, size(words) - 1), k -> named_struct(
            'score', CAST(1000 * CAST(a AS DECIMAL(18, 0)) * CAST(_l[0] AS DECIMAL(18, 0)) AS DECIMAL(38, 0))
                div CAST(CAST(_l[k] AS DECIMAL(18, 0)) * CAST(_r[size(words) - k] AS DECIMAL(18, 0)) AS DECIMAL(38, 0)),
            'k', k, 'l', _l[k], 'r', _r[size(words) - k]))
    """)
    rows = rows.select("lang", "words", "a", F.col("_l")[0].alias("n"), F.array_min(cuts).alias("_c"))
    return rows.select("lang", "words", "a", F.col("_c.l").alias("l"), F.col("_c.r").alias("r"), "n", F.col("_c.score").alias("score"))


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, **options) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language by their lowest-scoring cut."""
    rows = scored(frequent_phrases(docs, longest, least, **options)).withColumn("phrase", F.array_join("words", " "))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return rows.withColumn("rank", place).filter(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
