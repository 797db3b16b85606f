"""The trie of conversation prefixes by vertical bitmaps.

A node is a distinct sequence of first turns (role and text). Conversations are dealt to
ranges of their id, and every range to shards of bounded size. A shard indexes each
(position, turn) by the bitset of its conversations that have that turn there. From the set
of all its conversations it descends depth first: a set ANDed with the postings of the next
position gives the children, their bits the members, and those whose turns are used up the
conversations that end there.

Shards then meet by node, in the order of their ids: members are added, the smallest member is
the node's name, and the ids that end there are digested, in one stream. A node is owned by the
shard of its smallest member; owners' values, summed over each shard's subtrees and then over
shards, give sums over whole subtrees, however deep. A node's parent lies in its owner's shard too,
so children are counted and parents named there.

A node's key is the sum, modulo 2^128, of a 128-bit hash of every (position, turn) on its
path. So a conversation of any length may lie in several shards and ranges: each piece
starts from the sum of the earlier ones, which like all that passes between ranges are
figures of one row per range.

Rows without a conversation id belong to none and are left out; null roles and texts are
empty; turns go by number, nulls first, then by the hash of their content. Repeated rows are
turns of their own. Texts of any length count. Columns beyond the four are left out. A table
without conversations gives no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from prospectra.llm.common import cut, in_ranges, ranged

#: Turns and conversations from which a shard is closed.
SHARD_TURNS, SHARD_CONVERSATIONS = 20_000, 4096
ORDER = ["_conv", "_kind", "_turn", "_digest", "_row"]
WHOLE = 1 << 128
EMPTY = hashlib.sha256(b"").hexdigest()
PARTIALS = (
    "_part int, _shard int, _pre int, _over int, _size int, name binary, depth long, n long, conv long, words long, "
    "ends binary, _in long, _out long"
)
#: Of all rows; what follows ``_out`` counts at the owner's row, and the last three are NULL elsewhere.
OWNED = (
    "_part int, _shard int, _pre int, _over int, _size int, name binary, _counts boolean, conv_id long, _in long, _out long, "
    "n_leaves long, saved_tokens long, depth long, n_convs long, ends_sha256 string"
)
NODES = (
    "name binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string"
)


def listed(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per turn with its place, the hash of its content and its words, and a row without hash per conversation."""
    role_, text_ = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    content = F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_)
    rows = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("_conv"), F.lit(1).alias("_kind"), F.struct(F.col(turn).isNotNull().alias("known"), F.col(turn).cast("long").alias("turn")).alias("_turn"),
        F.unhex(F.substring(F.sha2(content, 256), 1, 32)).alias("_digest"), F.regexp_count(text_, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("_words"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return cut(rows, "turns")


def with_starts(rows: DataFrame) -> DataFrame:
    """The turns and one row before them for each conversation, which a conversation without turns has as well."""
    return rows.unionByName(_starts(rows.select("_conv").distinct()))


def _starts(convs: DataFrame) -> DataFrame:
    none = F.struct(F.lit(False).alias("known"), F.lit(None).cast("long").alias("turn"))
    return convs.select("_conv", F.lit(-1).alias("_kind"), none.alias("_turn"), F.lit(None).cast("binary").alias("_digest"),
                        F.lit(0).cast("long").alias("_words"), F.lit(0).cast("long").alias("_row"))


def branched(rows: DataFrame, step: int = 20, most: int = 4) -> DataFrame:
    """Conversations rebuilt from a trunk: the first turns of another, then the own ones after as many.

    ``crc32(id) % most`` turns come from the conversation whose id is the next multiple of
    ``step`` towards zero; all of them if it has fewer, none if it is absent.
    """
    place = Window.partitionBy("_conv").orderBy("_turn", "_digest", "_row")
    first = cut(rows.withColumn("_at", F.row_number().over(place)).filter(F.col("_at") < most), "first-turns")
    convs = first.filter("_at = 1").select("_conv", (F.crc32(F.col("_conv").cast("string")) % most).alias("_h"), (F.col("_conv") - F.col("_conv") % step).alias("_trunk"))
    trunk = first.select(F.col("_conv").alias("_trunk"), "_at", "_digest", "_words")
    heads = convs.join(trunk, "_trunk").filter("_at <= _h").select(
        "_conv", F.lit(0).alias("_kind"), F.struct(F.lit(True).alias("known"), F.col("_at").cast("long").alias("turn")).alias("_turn"),
        "_digest", "_words", F.lit(0).cast("long").alias("_row"),
    )
    gone = first.filter(F.col("_at") <= F.crc32(F.col("_conv").cast("string")) % most).select("_row")
    own = rows.join(gone, "_row", "left_anti").select(rows.columns)
    return own.unionByName(heads).unionByName(_starts(convs.select("_conv")))


def _hash(position: int, digest: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(position.to_bytes(8, "little") + digest, digest_size=16).digest(), "little")


def _limbs(value: int) -> list[int]:
    return [(value >> s) & 0xFFFFFFFF for s in (0, 32, 64, 96)]


def _value(limbs) -> int:
    return sum(int(x) << (32 * k) for k, x in enumerate(limbs)) % WHOLE


def _carries(rows: DataFrame) -> DataFrame:
    """Per range: the conversation that comes from the range before, its turns and key so far, and the one that goes on."""
    # One row per range, in these tables and windows, so one task has them all.
    by_part = Window.orderBy("_part")
    ends = rows.groupBy("_part").agg(F.min("_conv").alias("_first"), F.max("_conv").alias("_last")).coalesce(1)
    before, after = F.lag("_last").over(by_part), F.lead("_first").over(by_part)
    cuts = cut(ends.select(
        "_part", F.when(before == F.col("_first"), F.col("_first")).alias("_in"), F.when(after == F.col("_last"), F.col("_last")).alias("_out"),
    ), "range-cuts")
    counts = rows.join(F.broadcast(cuts.filter("_out IS NOT NULL")), "_part").filter("_conv = _out").groupBy("_part").agg(F.count("_digest").alias("_n")).coalesce(1)
    so_far = F.sum("_n").over(Window.partitionBy("_out").orderBy("_part"))
    edges = cuts.coalesce(1).join(F.broadcast(counts), "_part", "left").withColumn("_sum", so_far).select(
        "_part", "_in", F.when(F.col("_in").isNotNull(), F.lag("_sum").over(by_part)).otherwise(0).cast("long").alias("_from"), "_out",
    )
    edges = cut(edges, "range-edges")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, total = None, 0, 0
        for batch in batches:
            out = []
            for p, digest, begin in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if p != part:
                    out += [(part, *_limbs(total))] if part is not None else []
                    part, at, total = p, begin, 0
                if digest is not None:
                    total = (total + _hash(at, digest)) % WHOLE
                    at += 1
            yield _rows(out)
        if part is not None:
            yield _rows([(part, *_limbs(total))])

    def _rows(out: list) -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:])], ["_part", "l0", "l1", "l2", "l3"])

    going = edges.filter("_out IS NOT NULL").select("_part", F.col("_out").alias("_conv"), F.when(F.col("_in") == F.col("_out"), F.col("_from")).otherwise(0).alias("_begin"))
    # At most one row per range.
    held = in_ranges(rows.join(F.broadcast(going), ["_part", "_conv"]), ORDER).select("_part", "_digest", "_begin")
    limbs = [f"l{k}" for k in range(4)]
    done = held.mapInArrow(sums, "_part int, l0 long, l1 long, l2 long, l3 long").groupBy("_part").agg(*(F.sum(c).alias(c) for c in limbs)).coalesce(1)
    on_path = Window.partitionBy("_out").orderBy("_part")
    known = edges.coalesce(1).join(F.broadcast(done), "_part", "left").withColumns({c: F.sum(F.coalesce(c, F.lit(0))).over(on_path) for c in limbs})
    key = F.lag(F.struct(*limbs)).over(by_part)  # the range before is where the conversation went on from
    return cut(known.withColumn("_key", F.when(F.col("_in").isNotNull(), key)).select("_part", "_in", "_from", "_out", "_key"), "range-carries")


class Shard:
    """Postings of a run of conversations in ascending order of their id."""

    def __init__(self):
        self.convs: list[int] = []
        self.turns: list[list[int]] = []  # postings of a conversation, by position
        self.ends: list[bool] = []
        self.place: dict[tuple[int, bytes], int] = {}
        self.members: list[list[int]] = []
        self.hashes: list[int] = []
        self.words: list[int] = []
        self.count = 0
        self.top: tuple[int, int] | None = None  # position and key at which the first conversation goes on

    def begin(self, conv: int) -> None:
        self.convs.append(conv)
        self.turns.append([])
        self.ends.append(True)

    def add(self, digest: bytes, words: int) -> None:
        own = self.turns[-1]
        position = len(own) + (self.top[0] if self.top and len(self.turns) == 1 else 0)
        k = self.place.setdefault((position, digest), len(self.members))
        if k == len(self.members):
            self.members.append([])
            self.hashes.append(_hash(position, digest))
            self.words.append(words)
        self.members[k].append(len(self.convs) - 1)
        own.append(k)
        self.count += 1

    def postings(self) -> list[int]:
        """The bitset of every posting."""
        width = (len(self.convs) + 7) // 8
        out = []
        for members in self.members:
            if len(members) < 8:
                out.append(sum(1 << i for i in members))
            else:
                bits = np.zeros(8 * width, np.uint8)
                bits[members] = 1
                out.append(int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little"))
        return out

    def nodes(self, part: int, number: int) -> list[tuple]:
        """The rows of ``PARTIALS``, depth first."""
        postings, convs, turns = self.postings(), self.convs, self.turns
        skip = [self.top[0] if self.top and i == 0 else 0 for i in range(len(convs))]
        every = (1 << len(convs)) - 1
        rows: list[list] = []
        # bits, depth, key, words, row above, whether the node's members count here
        stack = [(every & ~1 if self.top else every, 0, 0, 0, -1, True)]
        if self.top:
            stack.append((1, self.top[0], self.top[1], 0, -1, False))
        comes = convs[0] if self.top else None
        while stack:
            bits, depth, key, words, over, counts = stack.pop()
            if not bits:
                continue
            at = len(rows)
            done, goes, left, children = [], None, bits, []
            while left:
                low = left & -left
                i = low.bit_length() - 1
                if len(turns[i]) + skip[i] == depth:
                    if self.ends[i]:
                        done.append(convs[i])
                    else:
                        goes = convs[i]
                    left ^= low
                    continue
                k = turns[i][depth - skip[i]]
                child = bits & postings[k]
                left &= ~child
                children.append((child, depth + 1, (key + self.hashes[k]) % WHOLE, self.words[k], at, True))
            first = convs[(bits & -bits).bit_length() - 1]
            rows.append([part, number, at, over, 1, key, depth, bits.bit_count() if counts else 0, first if counts else None, words,
                         ",".join(map(str, done)).encode() if done else None, comes if bits & 1 else None, goes])
            stack += reversed(children)
        for at in range(len(rows) - 1, -1, -1):
            if rows[at][3] >= 0:
                rows[rows[at][3]][4] += rows[at][4]
        return rows


_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}


def _batch(rows: list, schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")))
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[t]) for c, t in zip(columns, kinds)], list(names))


def _partials(rows: list[list]) -> pa.RecordBatch:
    for r in rows:
        r[5] = r[5].to_bytes(16, "little")
    return _batch(rows, PARTIALS)


def _descend(turns: int, convs: int):
    """The partial nodes of sorted rows, shard by shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part, number, conv, goes_on = None, None, 0, None, None

        def close(open_: bool) -> pa.RecordBatch:
            shard.ends[-1] = not open_
            return _partials(shard.nodes(part, number))

        for batch in batches:
            for p, c, digest, words, comes, begin, key, out in zip(*(batch.column(k).to_pylist() for k in range(8))):
                if p != part:
                    if shard:
                        yield close(conv == goes_on)
                    shard, part, number, conv, goes_on = Shard(), p, 0, None, out
                    if comes is not None:
                        shard.top = (begin, _value(key.values()))
                if shard.count >= turns or len(shard.convs) >= convs:
                    same = c == conv
                    if same:
                        own = shard.turns[-1]
                        before = shard.top if shard.top and len(shard.turns) == 1 else (0, 0)
                        top = (before[0] + len(own), (before[1] + sum(shard.hashes[k] for k in own)) % WHOLE)
                    yield close(same)
                    shard, number = Shard(), number + 1
                    if same:
                        shard.top = top
                        shard.begin(c)
                if c != conv:
                    shard.begin(c)
                    conv = c
                if digest is not None:
                    shard.add(digest, words)
        if shard:
            yield close(conv == goes_on)

    return run


def _owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of ``OWNED`` from those of ``PARTIALS`` sorted by name and shard; a name's first row with members is its owner's."""
    name, owner, members, inner, words, state = None, None, 0, False, 0, None

    def closed() -> tuple:
        return (*owner[:-1], int(not inner), (members - 1) * words, owner[-1], members, state.hexdigest() if state else EMPTY)

    for batch in batches:
        out = []
        for part, shard, pre, over, size, n, depth, count, conv, w, ends, comes, goes in zip(*(c.to_pylist() for c in batch.columns)):
            if n != name:
                out += [closed()] if owner else []
                name, owner, members, inner, state = n, None, 0, False, None
            members += count
            inner |= size > 1
            if ends is not None:
                if state:
                    state.update(b",")
                else:
                    state = hashlib.sha256()
                state.update(ends)
            if owner is None and conv is not None:
                owner, words = (part, shard, pre, over, size, n, True, conv, comes, goes, depth), w
            else:
                out.append((part, shard, pre, over, size, n, conv is not None, owner and owner[7], comes, goes, 0, 0, None, None, None))
        yield _batch(out, OWNED)
    if owner:
        yield _batch([closed()], OWNED)


def _subtrees(rows: pa.Table) -> pa.Table:
    """Sums of a shard's own values over the subtree of each of its nodes; the children it owns, and their parents."""
    rows = rows.sort_by("_pre")
    over, size = (rows.column(c).to_numpy() for c in ("_over", "_size"))
    at = np.arange(len(size))
    out = {c: rows.column(c) for c in ("name", "conv_id", "depth", "n_convs", "ends_sha256")}
    below = rows.column("depth").is_valid().to_numpy() & (over >= 0)
    out["n_children"] = pa.array(np.bincount(over[below], minlength=len(at)).astype(np.int64))
    out["parent_conv_id"] = rows.column("conv_id").take(pa.array(np.maximum(over, 0), mask=~below))
    for c in ("n_leaves", "saved_tokens"):
        total = np.r_[0, np.cumsum(rows.column(c).to_numpy())]
        # What later pieces of a conversation hold counts at the node where this piece stops, so not at the row where a later one starts.
        out[c] = pa.array(np.where(rows.column("_counts").to_numpy(), total[at + size] - total[at], 0))
    return pa.table({c: out[c] for c in (x.split()[0] for x in NODES.split(", "))})


def trie(rows: DataFrame, shard_turns: int = SHARD_TURNS, shard_conversations: int = SHARD_CONVERSATIONS) -> DataFrame:
    """The nodes of turns as ``with_starts`` or ``branched`` gives them."""
    rows = ranged(rows, ORDER, "trie-ranges")
    carries = _carries(rows)
    # One row per range, so as many as a shuffle has partitions.
    placed = in_ranges(rows.join(F.broadcast(carries), "_part"), ORDER)
    columns = ["_part", "_conv", "_digest", "_words", "_in", "_from", "_key", "_out"]
    partials = cut(placed.select(columns).mapInArrow(_descend(shard_turns, shard_conversations), PARTIALS), "trie-partials")

    # As many rows of a node as there are shards, at most.
    by_node = partials.repartition("name").sortWithinPartitions("name", "_part", "_shard", "_pre")
    own = cut(by_node.mapInArrow(_owned, OWNED), "trie-owned")
    sums = ["n_leaves", "saved_tokens"]
    later = own.filter("_in IS NOT NULL").groupBy(F.col("_in").alias("_c"), "_part", "_shard").agg(*(F.sum(c).alias(c) for c in sums), F.lit(1).alias("_held"))
    asks = own.filter("_out IS NOT NULL").select(F.col("_out").alias("_c"), "_part", "_shard", *(F.lit(0).cast("long").alias(c) for c in sums), F.lit(0).alias("_held"))
    after = Window.partitionBy("_c").orderBy(F.desc("_part"), F.desc("_shard"), "_held").rowsBetween(Window.unboundedPreceding, -1)
    extra = later.unionByName(asks).withColumns({f"_{c}": F.coalesce(F.sum(c).over(after), F.lit(0)) for c in sums}).filter("_held = 0")
    extra = extra.select("_part", "_shard", *(f"_{c}" for c in sums))  # one row of a shard at most, as one conversation goes on
    own = own.join(extra, ["_part", "_shard"], "left").withColumns({c: F.col(c) + F.when(F.col("_out").isNotNull(), F.coalesce(f"_{c}", F.lit(0))).otherwise(0) for c in sums})
    below = own.drop("_in", "_out", *(f"_{c}" for c in sums)).groupBy("_part", "_shard").applyInArrow(_subtrees, NODES)
    once = ["conv_id", "depth", "parent_conv_id", "n_convs", "ends_sha256"]
    whole = below.groupBy("name").agg(*(F.max(c).alias(c) for c in once), *(F.sum(c).alias(c) for c in ["n_children", *sums]))
    return whole.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(conversations: DataFrame, **columns) -> DataFrame:
    """The nodes of whole conversations as they stand."""
    return trie(with_starts(listed(conversations, **columns)))
