"""Removal of repeated byte strings by difference-cover sampling of suffixes.

Every text keeps the suffixes that start at a difference cover modulo V: powers of two
modulo 73, nine of 73 places, in which every difference occurs. Whatever two places share
a string of ``length`` bytes, some shift below V lands both on sampled places, whose
prefixes of ``length - V + 1`` bytes are then equal.

1. Sampled prefixes are named (a rolling hash from running sums) and names are compared
   across all texts, in buckets.
2. The remaining suffixes merge in only where a sampled one after them, less than V bytes
   on, shares its prefix with another: their ``length``-byte prefixes are named by two hashes
   and compared in the same way. Equal names mark the bytes to remove.

Texts lie in groups of about ``SOURCE_BYTES``; a group sends each distinct name once per
bucket, sorted and packed, and gets back one bit per name. Equal texts meet in one group and
are worked on once; copies of a text that would overfill a group are spread over several.

A text is worked on whole; a task needs about 100 times the bytes of its longest text where all of it repeats, 20 times
where nothing does.

Null texts are empty. Texts shorter than ``length`` keep all bytes. Repeated rows repeat each
other, so their bytes go. Columns beyond key and text are left out; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from prospectra.llm.common import cut, mix

LENGTH = 200
COVER_MODULO = 73
#: Powers of two modulo 73 form a perfect difference set: each difference occurs exactly once.
COVER = sorted({pow(2, i, COVER_MODULO) for i in range(9)})
SOURCE_BYTES = 4 << 20
#: Bytes of a name sent beside its bucket. A false match of samples costs work only. One of windows would cost
#: bytes, so a second, independent hash picks their bucket: 56 bits, and those of the number of buckets.
SAMPLE_WIDTH, WINDOW_WIDTH = 4, 7
#: Byte tables and bases of the two hashes.
_HASHES = tuple(
    (mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(step)), base)
    for step, base in ((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93), (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F))
)


#: Places hashed at a time, so that the running sums stay in a processor's cache.
STRETCH = 1 << 14
#: Bytes of an Arrow column at most; more makes several chunks.
CHUNK_BYTES = 1 << 30


@cache
def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def names_of(raw: np.ndarray, length: int, at: np.ndarray, which: int = 0) -> np.ndarray:
    """Names of the strings of a length at ascending places where they fit.

    Running sums of bytes times powers of the base: a difference of two, shifted back by the base's inverse, is the
    hash of the string between. Stretches without a place are skipped.
    """
    table, base = _HASHES[which]
    up, down = _powers(base, STRETCH + length), _powers(pow(base, -1, 1 << 64), STRETCH)
    sums, out, begin = np.zeros(STRETCH + length + 1, np.uint64), np.empty(len(at), np.uint64), 0
    while begin < len(at):
        first = int(at[begin])
        end = int(np.searchsorted(at, first + STRETCH))
        here = at[begin:end] - first
        n = int(here[-1]) + length
        np.cumsum(table[raw[first:first + n]] * up[:n], out=sums[1:n + 1])
        out[begin:end] = mix((sums[here + length] - sums[here]) * down[here])
        begin = end
    return out


def _counted(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """From each first as many numbers as its count says, one run after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - counts), counts)


def _packed(data: np.ndarray, ends: np.ndarray) -> pa.Array | pa.ChunkedArray:
    """Binary values that lie one after the other in bytes."""
    if len(data) > CHUNK_BYTES:
        return pa.chunked_array([pa.array([data[a:b].tobytes()], pa.binary()) for a, b in zip([0, *ends.tolist()], ends.tolist())], pa.binary())
    offsets = np.r_[0, ends].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _unpacked(values: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of binary values one after the other, and the size of each."""
    parts, sizes = [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)]
    for chunk in values.cast(pa.binary()).chunks:
        if len(chunk):
            ends = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset:chunk.offset + len(chunk) + 1].astype(np.int64)
            sizes.append(np.diff(ends))
            if ends[-1] > ends[0]:
                parts.append(np.frombuffer(chunk.buffers()[2], np.uint8)[ends[0]:ends[-1]])
    return np.concatenate(parts), np.concatenate(sizes)


class Packets:
    """Names of a group by bucket, as sent, and the way back to their places.

    Names are sorted by a hash without its last bits, which hold the place. Where other strings share the rest, a name
    may be sent twice; it does occur twice then.
    """

    def __init__(self, names: np.ndarray, copied: np.ndarray, buckets: int, width: int, more: np.ndarray | None = None):
        """``copied`` tells of which places the text has copies. ``more`` are independent hashes of the same strings, to pick the buckets."""
        hashes = names if more is None else more
        low = np.uint64(len(names).bit_length())
        keys = (hashes >> low << low) | np.arange(len(names), dtype=np.uint64)
        keys.sort()
        self.order = (keys & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
        names = names[self.order]
        new = np.ones(len(names), bool)
        np.not_equal(names[1:], names[:-1], out=new[1:])
        if more is not None:
            more = more[self.order]
            new[1:] |= more[1:] != more[:-1]
        first = np.flatnonzero(new)
        self.places = np.diff(np.r_[first, len(names)])
        self.own = self.places > 1
        if len(first) and copied.any():
            self.own |= np.logical_or.reduceat(copied[self.order], first)
        self.value, self.width = names[first], width
        # In the order of the keys, as they begin with the bits that pick the bucket.
        bucket = ((keys[first] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        self.ends = np.flatnonzero(np.r_[bucket[1:] != bucket[:-1], True][:len(bucket)]) + 1
        self.bucket = bucket[self.ends - 1]

    def rows(self) -> tuple[np.ndarray, pa.Array | pa.ChunkedArray]:
        """Buckets, and the names sent to each."""
        data = np.ascontiguousarray(self.value.view(np.uint8).reshape(-1, 8)[:, :self.width]).ravel()
        return self.bucket, _packed(data, self.ends * self.width)

    def repeated(self, replies: pa.Table) -> np.ndarray:
        """For every place whether its name occurs again, here or in another group."""
        again = self.own.copy()
        if len(replies):
            bits, sizes = _unpacked(replies.column("bits"))
            row = np.searchsorted(self.bucket, replies.column("bucket").to_numpy())
            counts = np.diff(np.r_[0, self.ends])[row]
            answered = np.unpackbits(bits)[_counted(8 * (np.cumsum(sizes) - sizes), counts)]
            again[_counted((self.ends[row] - counts), counts)] |= answered.astype(bool)
        out = np.empty(len(self.order), bool)
        out[self.order] = np.repeat(again, self.places)
        return out


class Group:
    """The distinct texts of a group, end to end."""

    def __init__(self, texts: list[bytes], length: int, buckets: int):
        copies = Counter(texts)
        self.texts, self.length, self.buckets = list(copies), length, buckets
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.raw = np.frombuffer(b"".join(self.texts), np.uint8)
        self.copied = np.array([copies[t] > 1 for t in self.texts], bool)

    def samples(self) -> tuple[np.ndarray, np.ndarray, Packets]:
        """Sampled places, the texts they lie in, and their names."""
        reach = self.length - COVER_MODULO + 1
        turns, rest = np.divmod(np.maximum(self.sizes - reach + 1, 0), COVER_MODULO)
        counts = turns * len(COVER) + np.searchsorted(COVER, rest)
        place = (np.arange(turns.max(initial=0) + 1)[:, None] * COVER_MODULO + np.array(COVER)).ravel()
        owner = np.repeat(np.arange(len(counts)), counts)
        at = place[_counted(np.zeros(len(counts), np.int64), counts)] + self.starts[owner]
        return at, owner, Packets(names_of(self.raw, reach, at), self.copied[owner], self.buckets, SAMPLE_WIDTH)

    def windows(self, replies: pa.Table) -> tuple[np.ndarray, np.ndarray, Packets]:
        """Places less than V before a repeated sample, the texts they lie in, and their names."""
        at, owner, sent = self.samples()
        again = sent.repeated(replies)
        at, owner = at[again], owner[again]
        low, high = np.maximum(at - COVER_MODULO + 1, self.starts[owner]), np.minimum(at, self.ends[owner] - self.length)
        fits = high >= low
        low, high, owner = low[fits], high[fits], owner[fits]
        low[1:] = np.maximum(low[1:], high[:-1] + 1)
        counts = np.maximum(high - low + 1, 0)
        at, owner = _counted(low, counts), np.repeat(owner, counts)
        names, more = (names_of(self.raw, self.length, at, which) for which in (0, 1))
        return at, owner, Packets(names, self.copied[owner], self.buckets, WINDOW_WIDTH, more)

    def kept(self, samples: pa.Table, windows: pa.Table) -> dict[bytes, tuple[int, int, bytes]]:
        """Per text the removed bytes, their runs, and what stays."""
        at, owner, sent = self.windows(samples)
        again = sent.repeated(windows)
        at, owner = at[again], owner[again]
        first = np.ones(len(at), bool)
        first[1:] = (at[1:] > at[:-1] + self.length) | (owner[1:] != owner[:-1])
        last = np.r_[first[1:], True][:len(at)]
        own = owner[first]
        gone: dict[int, list[tuple[int, int]]] = {}
        for k, a, b in zip(own.tolist(), (at[first] - self.starts[own]).tolist(), (at[last] + self.length - self.starts[own]).tolist()):
            gone.setdefault(k, []).append((a, b))
        out = {}
        for k, text in enumerate(self.texts):
            runs, rest, done = gone.get(k, []), [], 0
            for a, b in runs:
                rest.append(text[done:a])
                done = b
            out[text] = (sum(b - a for a, b in runs), len(runs), b"".join([*rest, text[done:]]) if runs else text)
        return out


def _texts(table: pa.Table) -> list[bytes]:
    return [t or b"" for t in table.column("_text").cast(pa.binary()).to_pylist()]


SENT = "bucket long, source long, names binary"
REPLY = "source long, round int, bucket long, bits binary"


def _sent(source, packets: Packets) -> pa.Table:
    bucket, names = packets.rows()
    return pa.table({"bucket": bucket, "source": np.full(len(bucket), source, np.int64), "names": names})


def _bits(table: pa.Table, round_: int) -> pa.Table:
    return table.filter(pc.equal(table.column("round"), round_))


def _compared(sent: DataFrame, width: int, round_: int) -> DataFrame:
    """One bit per name that came from several groups; buckets are independent of each other."""
    def compare(rows: pa.Table) -> pa.Table:
        data, sizes = _unpacked(rows.column("names"))
        wide = np.zeros((len(data) // width, 8), np.uint8)
        wide[:, :width] = data.reshape(-1, width)
        value = wide.view(np.uint64).ravel()
        order = np.argsort(value)
        value = value[order]
        same = value[1:] == value[:-1]
        again = np.zeros(len(value), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        counts = sizes // width
        held = (counts + 7) // 8
        bits = np.zeros(8 * held.sum(), bool)
        bits[_counted(8 * (np.cumsum(held) - held), counts)] = again
        reply = pa.table({
            "source": rows.column("source"), "round": np.full(len(rows), round_, np.int32), "bucket": rows.column("bucket"),
            "bits": _packed(np.packbits(bits), np.cumsum(held)),
        })
        return reply.filter(pa.array(np.logical_or.reduceat(again, np.cumsum(counts) - counts)))

    return sent.groupBy("bucket").applyInArrow(compare, REPLY)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                   source_bytes: int = SOURCE_BYTES, with_text: bool = False) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``, the remaining bytes) of every row."""
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    place = F.xxhash64("_text")
    total = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    groups = int(total // source_bytes) + 1
    full = cut(
        rows.select(place.alias("_hash"), F.octet_length("_text").cast("long").alias("_n")).groupBy("_hash")
        .agg(F.sum("_n").alias("_all")).filter(F.col("_all") > source_bytes), "large-copies",
    )
    salt = F.coalesce(F.pmod(F.xxhash64("_key"), F.ceil(F.col("_all") / source_bytes)), F.lit(0))
    dealt = rows.withColumn("_hash", place).join(full, "_hash", "left").select(
        F.pmod(F.col("_hash") + salt * 7919, F.lit(groups)).alias("source"), "_key", "_text"
    )
    grouped = dealt.groupBy("source")
    key_type = dealt.schema["_key"].dataType.simpleString()

    def first(keys: tuple, table: pa.Table) -> pa.Table:
        return _sent(keys[0].as_py(), Group(_texts(table), length, groups).samples()[-1])

    samples = _compared(grouped.applyInArrow(first, SENT), SAMPLE_WIDTH, 1)

    def second(keys: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        return _sent(keys[0].as_py(), Group(_texts(table), length, groups).windows(_bits(replies, 1))[-1])

    windows = _compared(grouped.cogroup(samples.groupBy("source")).applyInArrow(second, SENT), WINDOW_WIDTH, 2)
    # One plan for all three steps: the texts move once, as their exchange is used again.
    replies = samples.unionAll(windows)

    def last(table: pa.Table, replies: pa.Table) -> pa.Table:
        texts = _texts(table)
        found = Group(texts, length, groups).kept(_bits(replies, 1), _bits(replies, 2)) if texts else {}
        rows = [found[t] for t in texts]
        out = {
            "_key": table.column("_key"), "n_bytes": pa.array(map(len, texts), pa.int64()),
            "n_removed": pa.array([r[0] for r in rows], pa.int64()), "n_spans": pa.array([r[1] for r in rows], pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string()),
        }
        return pa.table(out | ({"kept": pa.array([r[2] for r in rows], pa.binary())} if with_text else {}))

    schema = f"_key {key_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    return grouped.cogroup(replies.groupBy("source")).applyInArrow(last, schema).withColumnRenamed("_key", key)
