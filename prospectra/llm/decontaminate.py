"""Benchmark decontamination with training suffix arrays.

The documents are the shards: each slice of them becomes one array of word numbers with a
suffix array over it. Benchmark suffixes are binary-searched in every shard. The interval
found holds all places where the window that begins there occurs; from these places matches
are followed word by word, which gives the longest verbatim match and its place.

A shard first says which pairs and fours of words it shares with the benchmark. Only suffixes
that begin with a shared one are searched, and only places that begin one are sorted, so a
shard without benchmark text costs a look-up per word and a glance per benchmark suffix.

Benchmark items are cut by id and text into parts of a checked size. Spark tasks number
their words, name their windows and write them to the shared folder; executors fetch the
files and hold one part at a time, so neither the driver nor a broadcast grows with the
benchmark.

Words are maximal runs of ASCII letters and digits (lower-cased) and of everything beyond
ASCII. Items and documents that are null or hold no word match nothing; repeated rows are
searched one by one; an item repeated in the benchmark counts once by its id. Items without
id are searched too: their words are hit, but they are neither counted nor listed. Among
equally long matches the first in the document, then in the item, is told. A slice ends
between texts: a text of any length is one shard, of about 40 times its bytes. Columns beyond
key and text are left out, or kept by ``decontaminate``; an empty table gives no rows, and an
empty benchmark no hits.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, functions as F

from prospectra.llm.common import text_slices
from prospectra.session import new_path

WINDOW = 10
#: Bytes of benchmark text in one part.
PART_BYTES = 16 << 20
#: Bytes of documents in one shard; a longer single text is a shard of its own.
SHARD_BYTES = 2 << 20
_KEEP = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_KEEP).split()


def suffix_array(ids: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The places ``at`` ordered by their next ``depth`` numbers, by doubling named pairs."""
    rank = np.append(ids.astype(np.int64), 0)
    reach = 1
    while reach < depth:
        right = np.zeros(len(rank), np.int64)
        right[:-reach] = rank[reach:]
        rank = np.unique(rank * (rank.max() + 1) + right, return_inverse=True)[1].astype(np.int64)
        reach *= 2
    return at[np.argsort(rank[at], kind="stable")]


def common_length(left: np.ndarray, a: np.ndarray, right: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """How many numbers agree from places ``a`` and ``b`` on, ends (0) and ``most`` being stops."""
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    while len(live):
        x = left[np.minimum(a[live] + out[live], len(left) - 1)]
        y = right[np.minimum(b[live] + out[live], len(right) - 1)]
        live = live[(x == y) & (x > 0) & (out[live] < most)]
        out[live] += 1
        live = live[out[live] < most]
    return out


def _looked_up(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted key stands in a sorted table, -1 where it doesn't."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


class Benchmark:
    """A part of the benchmark as word numbers, with the windows to search for.

    ``ids`` has the items end to end, 0 after each. Every distinct window has a first place, a
    length, all its places and items (``place_of``, ``items_of`` with ends), and a gate: the
    four, pair or single word that it begins with.
    """

    ARRAYS = ("ids", "first", "needs", "level", "gate", "place_of", "place_end", "items_of", "items_end", "pairs", "fours", "begins")

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        vocabulary: dict[bytes, int] = {}
        self.names: list[str | None] = []
        parts, lengths = [], []
        for name, text in items:
            words = words_of(text)
            if words:
                parts.append(np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words] + [0], np.int64))
                lengths.append(len(words))
                self.names.append(name)
        self.window, self.vocabulary = window, vocabulary
        self.ids = np.concatenate([*parts, np.zeros(1, np.int64)])
        lengths = np.array(lengths, np.int64)
        self.begins = np.cumsum(lengths + 1) - lengths - 1
        needs = np.minimum(lengths, window)
        counts = lengths - needs + 1
        owner = np.repeat(np.arange(len(lengths)), counts)
        starts = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + self.begins[owner] if len(lengths) else np.zeros(0, np.int64)
        needs = needs[owner] if len(lengths) else needs
        self._tables()
        name = self._window_names(starts, needs)
        _, first, which = np.unique(name, return_index=True, return_inverse=True)
        self.first, self.needs = starts[first], needs[first]
        order = np.argsort(which, kind="stable")
        self.place_of, self.place_end = starts[order], np.cumsum(np.bincount(which, minlength=len(first))).astype(np.int64)
        size = len(lengths) + 1
        held = np.unique(which * size + owner)
        self.items_of, self.items_end = held % size, np.cumsum(np.bincount(held // size, minlength=len(first))).astype(np.int64)
        self.level = np.where(self.needs >= 4, 4, np.where(self.needs >= 2, 2, 1))
        pair, four = self.shared(self.ids)
        self.gate = np.where(self.level == 4, four[self.first], np.where(self.level == 2, pair[self.first], self.ids[self.first]))

    def _tables(self) -> None:
        """The distinct pairs of neighbouring words, and fours as pairs of pairs."""
        self.width = len(self.vocabulary) + 1
        inside = (self.ids[:-1] > 0) & (self.ids[1:] > 0)
        keys = self.ids[:-1] * self.width + self.ids[1:]
        self.pairs = np.unique(keys[inside])
        self.fours = np.zeros(0, np.int64)
        pair, _ = self.shared(self.ids)
        far = np.append(pair[2:], [-1, -1])
        both = (pair >= 0) & (far >= 0)
        self.fours = np.unique(pair[both] * (len(self.pairs) + 1) + far[both])

    def shared(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every place the number of the pair and the four of words that begin there, -1 if the benchmark has none."""
        pair, four = np.full(len(ids), -1, np.int64), np.full(len(ids), -1, np.int64)
        at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        pair[at] = _looked_up(self.pairs, ids[at] * self.width + ids[at + 1])
        at = np.flatnonzero((pair[:-2] >= 0) & (pair[2:] >= 0)) if len(ids) > 2 else np.zeros(0, np.int64)
        four[at] = _looked_up(self.fours, pair[at] * (len(self.pairs) + 1) + pair[at + 2])
        return pair, four

    def _window_names(self, starts: np.ndarray, needs: np.ndarray) -> np.ndarray:
        """A number per distinct sequence of the next ``needs`` words, by doubling."""
        name = np.zeros(len(starts), np.int64)
        rank, reach = np.append(self.ids, 0), 1
        done = np.zeros(len(starts), np.int64)
        while reach <= self.window:
            take = np.flatnonzero(needs & reach)
            name[take] = name[take] * (rank.max() + 1) + rank[starts[take] + done[take]]
            done[take] += reach
            name = np.unique(name * (self.window + 1) + needs, return_inverse=True)[1].astype(np.int64)
            right = np.zeros(len(rank), np.int64)
            right[:-reach] = rank[reach:]
            rank = np.unique(rank * (rank.max() + 1) + right, return_inverse=True)[1].astype(np.int64)
            reach *= 2
        return name

    def row(self) -> dict[str, bytes | list]:
        """The part as one row of binary columns."""
        words = sorted(self.vocabulary, key=self.vocabulary.get)
        return {a: getattr(self, a).astype("<i8").tobytes() for a in self.ARRAYS} | {"words": b" ".join(words), "names": self.names, "window": self.window}

    @classmethod
    def of(cls, row: dict) -> Benchmark:
        made = cls.__new__(cls)
        for a in cls.ARRAYS:
            setattr(made, a, np.frombuffer(row[a], "<i8"))
        made.vocabulary = {w: k for k, w in enumerate(row["words"].split(), 1)}
        made.names, made.window, made.width = row["names"], row["window"], len(made.vocabulary) + 1
        return made

    def shard(self, words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of a slice, 0 for words no item has and after each text, and where each text begins."""
        parts, begins, at = [], [], 0
        for own in words:
            parts.append(np.fromiter(map(self.vocabulary.get, own, repeat(0)), np.int64, len(own)))
            parts.append(np.zeros(1, np.int64))
            begins.append(at)
            at += len(own) + 1
        return np.concatenate([*parts, np.zeros(1, np.int64)]), np.array([*begins, at], np.int64)

    def bisect(self, ids: np.ndarray, order: np.ndarray, starts: np.ndarray, reach: np.ndarray, after: bool) -> np.ndarray:
        """The first place in the order not below (or above) the item suffixes cut to ``reach`` words."""
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(order), np.int64)
        while (open_ := np.flatnonzero(low < high)).size:
            mid = (low[open_] + high[open_]) // 2
            place, start = order[mid], starts[open_]
            same = np.minimum(common_length(ids, place, self.ids, start, int(reach.max())), reach[open_])
            x = ids[np.minimum(place + same, len(ids) - 1)]
            y = self.ids[np.minimum(start + same, len(self.ids) - 1)]
            below = np.where(same == reach[open_], after, x < y)
            low[open_] = np.where(below, mid + 1, low[open_])
            high[open_] = np.where(below, high[open_], mid)
        return low

    def search(self, words: list[list[bytes]]) -> dict[int, dict]:
        """Of the texts with hits: stretches of hit words, items found, and each item's longest match."""
        if not len(self.first):
            return {}
        ids, begins = self.shard(words)
        pair, four = self.shared(ids)
        asked, opens = np.zeros(len(self.first), bool), np.zeros(len(ids), bool)
        for level, own, size in ((4, four, len(self.fours)), (2, pair, len(self.pairs)), (1, np.where(ids > 0, ids, -1), self.width)):
            mine = self.level == level
            if mine.any():
                here = own >= 0
                seen = np.zeros(size, bool)
                seen[own[here]] = True
                asked[mine] = seen[self.gate[mine]]
                opens |= here
        asked = np.flatnonzero(asked)
        if not len(asked):
            return {}
        order = suffix_array(ids, np.flatnonzero(opens), self.window)
        low, high = (self.bisect(ids, order, self.first[asked], self.needs[asked], after) for after in (False, True))
        sizes = high - low
        which = np.repeat(asked, sizes)
        if not len(which):
            return {}
        place = order[np.repeat(low, sizes) + np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
        step = np.zeros(len(ids) + 1, np.int64)
        np.add.at(step, place, 1)
        np.add.at(step, place + self.needs[which], -1)
        edges = np.diff(np.r_[0, np.cumsum(step[:-1]) > 0, 0].astype(np.int8))
        first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        out: dict[int, dict] = {}
        for text, a, b in zip((np.searchsorted(begins, first, "right") - 1).tolist(), first.tolist(), last.tolist()):
            out.setdefault(text, {"stretches": [], "items": set(), "longest": {}})["stretches"].append({"start": a - int(begins[text]), "length": b - a})
        for text, u in np.unique(np.stack([np.searchsorted(begins, place, "right") - 1, which], 1), axis=0).tolist():
            out[text]["items"].update(self.items_of[self.items_end[u - 1] if u else 0:self.items_end[u]].tolist())
        self._longest(ids, begins, place, which, out)
        for found in out.values():
            found["items"] = sorted({self.names[i] for i in found["items"]} - {None})
        return out

    def _longest(self, ids: np.ndarray, begins: np.ndarray, place: np.ndarray, which: np.ndarray, out: dict[int, dict]) -> None:
        """Follows matches from the places where they begin: those before which text and item differ."""
        begin = np.where(which > 0, self.place_end[which - 1], 0)
        sizes = self.place_end[which] - begin
        a = np.repeat(place, sizes)
        b = self.place_of[np.repeat(begin, sizes) + np.arange(len(a)) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
        left, above = ids[a - 1] * (a > 0), self.ids[b - 1] * (b > 0)
        new = (left != above) | (left == 0)
        a, b = a[new], b[new]
        length = common_length(ids, a, self.ids, b, len(self.ids))
        text, item = np.searchsorted(begins, a, "right") - 1, np.searchsorted(self.begins, b, "right") - 1
        for i in np.lexsort((b, a, -length)).tolist():
            name = self.names[item[i]]
            if name is not None:
                found = {"item": name, "n_words": int(length[i]), "item_start": int(b[i] - self.begins[item[i]]), "doc_start": int(a[i] - begins[text[i]])}
                out[int(text[i])]["longest"].setdefault(name, found)


MATCH = "struct<item:string,n_words:long,item_start:long,doc_start:long>"
FOUND = f"struct<n_words:long,stretches:array<struct<start:long,length:long>>,items:array<string>,longest:array<{MATCH}>>"
_STRETCHES = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
_MATCHES = pa.list_(pa.struct([("item", pa.string()), ("n_words", pa.int64()), ("item_start", pa.int64()), ("doc_start", pa.int64())]))
_FOUND = pa.struct([("n_words", pa.int64()), ("stretches", _STRETCHES), ("items", pa.list_(pa.string())), ("longest", _MATCHES)])


def benchmark_parts(benchmark: DataFrame, key: str, text: str, window: int, part_bytes: int) -> list[str]:
    """Writes the benchmark in searchable parts of about ``part_bytes`` and has executors fetch them; returns the files' names."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(key).cast("string").alias("_id"), F.col(text).alias("_text"))
    total = items.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    count = -(-total // part_bytes) or 1
    part = F.pmod(F.xxhash64("_id", "_text"), F.lit(count)).cast("int")
    schema = "part int, " + ", ".join(f"{a} binary" for a in Benchmark.ARRAYS) + ", words binary, names array<string>, window int"

    def prepared(keys: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("_id", "ascending"), ("_text", "ascending")])
        made = Benchmark(list(zip(rows.column("_id").to_pylist(), rows.column("_text").to_pylist())), window).row()
        kinds = [pa.int32()] + [pa.binary()] * (len(Benchmark.ARRAYS) + 1) + [pa.list_(pa.string()), pa.int32()]
        return pa.table({n: pa.array([v], t) for (n, v), t in zip((("part", keys[0].as_py()), *made.items()), kinds)})

    folder = new_path(spark, "llm-benchmark")
    made = items.withColumn("part", part).groupBy("part").applyInArrow(prepared, schema)
    made.write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(folder)
    files = sorted(r[0] for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder).select("path").collect())  # a name per part
    for file in files:
        spark.sparkContext.addFile(file)
    return [os.path.basename(f) for f in files]


@functools.lru_cache(maxsize=1)
def part_of(file: str) -> Benchmark | None:
    """The part in a fetched file, one held per worker."""
    rows = pq.read_table(SparkFiles.get(file)).to_pylist()
    return Benchmark.of(rows[0]) if rows else None


def _joined(found: list[dict]) -> dict:
    """What several parts found in one text."""
    merged: list[dict] = []
    for s in sorted((s for f in found for s in f["stretches"]), key=lambda s: s["start"]):
        if merged and s["start"] <= merged[-1]["start"] + merged[-1]["length"]:
            merged[-1]["length"] = max(merged[-1]["start"] + merged[-1]["length"], s["start"] + s["length"]) - merged[-1]["start"]
        else:
            merged.append(dict(s))
    longest: dict[str, dict] = {}
    for m in (m for f in found for m in f["longest"].values()):
        held = longest.get(m["item"])
        if held is None or (-m["n_words"], m["doc_start"], m["item_start"]) < (-held["n_words"], held["doc_start"], held["item_start"]):
            longest[m["item"]] = m
    return {"stretches": merged, "items": sorted({i for f in found for i in f["items"]}), "longest": [longest[k] for k in sorted(longest)]}


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW,
            item_key: str = "item_id", item_text: str = "text", part_bytes: int = PART_BYTES) -> Column:
    """Number of words, hit stretches, items and each item's longest match of each text of ``docs``, as one struct column."""
    files = benchmark_parts(benchmark, item_key, item_text, window, part_bytes)

    @F.arrow_udf(FOUND)
    def searched(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found: list[list[dict]] = [[] for _ in range(len(texts))]
            sizes = np.zeros(len(texts), np.int64)
            # The words of one shard are held at a time; with several parts they are cut anew for each.
            for file in files or [None]:
                known, at = part_of(file) if file else None, 0
                for part in text_slices(texts, SHARD_BYTES):
                    shard = [words_of(t) for t in part]
                    sizes[at:at + len(shard)] = [len(w) for w in shard]
                    for k, hit in (known.search(shard) if known else {}).items():
                        found[at + k].append(hit)
                    at += len(shard)
            none = {"stretches": [], "items": [], "longest": []}
            yield pa.array([{"n_words": n} | (_joined(f) if f else none) for n, f in zip(sizes.tolist(), found)], _FOUND)

    return searched(F.col(text))


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``key, n_words, n_hit, n_items, items_sha256, contaminated``, the longest match and all details of every row.

    ``longest_item``, ``longest_words``, ``longest_item_start`` and ``longest_doc_start`` tell the
    longest verbatim match with an item that has an id, null and 0 without one.
    """
    found = docs.select(key, matches(docs, benchmark, text, **options).alias("_m"))
    lengths = F.transform("_m.stretches", lambda s: s["length"])
    order = lambda m: F.struct((-m["n_words"]).alias("n"), m["doc_start"].alias("d"), m["item"].alias("i"), m["item_start"].alias("s"))
    top = F.array_min(F.transform("_m.longest", order))
    return found.select("*", top.alias("_top")).select(
        key, F.col("_m.n_words").alias("n_words"),
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_hit"),
        F.size("_m.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_m.items", ","), 256).alias("items_sha256"),
        (F.size("_m.stretches") > 0).alias("contaminated"),
        F.coalesce(F.array_max(lengths), F.lit(0)).cast("long").alias("longest_stretch"),
        F.col("_top.i").alias("longest_item"), F.coalesce(-F.col("_top.n"), F.lit(0)).cast("long").alias("longest_words"),
        F.col("_top.s").alias("longest_item_start"), F.col("_top.d").alias("longest_doc_start"),
        F.col("_m.stretches").alias("stretches"), F.col("_m.items").alias("items"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns kept, in which no benchmark window occurs."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("_row"), matches(docs, benchmark, text, **options).alias("_m"))
    return rows.filter(F.size("_m.stretches") == 0).select("_row.*")


def longest_matches(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per item with an id its longest verbatim match of a window or more: ``item, n_words, item_start, doc_key, doc_start``."""
    rows = docs.select(F.col(key).cast("string").alias("doc_key"), F.explode(matches(docs, benchmark, text, **options)["longest"]).alias("_l")) \
        .select("doc_key", "_l.*")
    order = F.struct(-F.col("n_words"), "doc_key", "doc_start", "item_start")
    names = ("n_words", "item_start", "doc_key", "doc_start")
    return rows.groupBy("item").agg(F.min_by(F.struct(*names), order).alias("_b")).select("item", "_b.*")
