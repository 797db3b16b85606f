"""Near-duplicate classes by HyperMinHash.

Texts become sets of word shingles. Equal sets are one class. A class keeps a sketch: per
bucket the leading zeros of its smallest hash and a few bits of mantissa. Bands of four
registers are the keys of candidate buckets.

1. In every bucket the class that shares most (the sum of its buckets' sizes) is the head;
   head and members whose estimated similarity, corrected for chance collisions, is not far
   below the limit are compared on their full sets. Proven links give components.
2. Buckets that still hold several components are compared in blocks of bounded size:
   sketches first, then full sets of those that may be linked across components. So every
   pair of a bucket is either inside one component or was judged; no cap, no pair list.

Null texts and texts without words have no set, link to nothing and are kept. Repeated rows
and rows that share an id are one document. Rows without an id follow their class and are
kept if the class has no id at all. Columns beyond key and text are left out. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from prospectra.llm.common import cut, text_slices
from prospectra.llm.components import components
from prospectra.llm.shingles import BUCKETS, WORDS, jaccard_estimate, registers, shingle_sets

BAND = 4
#: Similarity in percent from which documents are linked.
PERCENT = 75
#: Pairs estimated this far below the limit are not compared: over four deviations of an estimate from 128 registers.
SLACK = 0.2
#: Classes on either side of one block of comparisons.
BLOCK = 1024
#: Pairs of sketches compared at once.
PAIRS = 25_000
SKETCH = "struct<n_shingles:long,signature:binary,registers:binary>"


def sketch(text: Column, words: int = WORDS) -> Column:
    """Set size, signature of the set, and registers; the last two null for an empty set."""
    @F.arrow_udf(SKETCH)
    def sketched(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            sizes, names, regs = [], [], []
            for part in text_slices(texts):
                sets = shingle_sets(part, words)
                rows = iter(registers([s for s in sets if len(s)]))
                sizes += map(len, sets)
                names += [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                regs += [next(rows).tobytes() if len(s) else None for s in sets]
            yield pa.StructArray.from_arrays(
                [pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(regs, pa.binary())],
                ["n_shingles", "signature", "registers"],
            )

    return sketched(text)


def full_set(text: Column, words: int = WORDS) -> Column:
    """The sorted shingle hashes as bytes."""
    @F.arrow_udf("binary")
    def made(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([s.tobytes() for part in text_slices(texts) for s in shingle_sets(part, words)], pa.binary())

    return made(text)


def _stack(regs) -> np.ndarray:
    return np.frombuffer(b"".join(regs), "<u2").reshape(-1, BUCKETS)


def estimate(a: Column, b: Column, n: Column, m: Column) -> Column:
    """Estimated similarity of two sketches."""
    @F.arrow_udf("double")
    def estimated(a: pa.Array, b: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
        if not len(a):
            return pa.array([], pa.float64())
        sizes = (np.array(n.to_pylist()), np.array(m.to_pylist()))
        return pa.array(jaccard_estimate(_stack(a.to_pylist()), _stack(b.to_pylist()), *sizes))

    return estimated(a, b, n, m)


def linked(a: Column, b: Column, percent: int = PERCENT) -> Column:
    """Whether two full sets are similar enough."""
    @F.arrow_udf("boolean")
    def judged(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pa.array(out, pa.bool_())

    return judged(a, b)


def members_of(classes: DataFrame) -> DataFrame:
    """``band, node, held``: classes in buckets with others, and how many a bucket holds."""
    step = 2 * BAND
    band = lambda b: F.xxhash64(b, F.substring("registers", b * step + 1, F.lit(step)))
    rows = classes.select("node", F.explode(F.transform(F.sequence(F.lit(0), F.lit(BUCKETS // BAND - 1)), band)).alias("band"))
    held = rows.groupBy("band").agg(F.count("*").alias("held")).filter("held > 1")
    return rows.join(held, "band")


def _blocks(members: DataFrame) -> DataFrame:
    """Members of buckets with several components, dealt to blocks that hold bounded shares of a bucket.

    ``asks`` marks the members outside their bucket's largest component: every pair that
    crosses components has one. They are the one side, in ``i`` blocks, all members the other.
    """
    tops = members.groupBy("band", "component").agg(F.count("*").alias("_n")).groupBy("band").agg(
        F.max(F.struct("_n", "component"))["component"].alias("_top"), F.sum("_n").alias("_all"),
        F.max("_n").alias("_most"), F.count("*").alias("_kinds"),
    ).filter("_kinds > 1")
    asks = F.col("component") != F.col("_top")
    own = F.pmod(F.xxhash64("node"), F.lit(1 << 30))
    i, j = F.ceil((F.col("_all") - F.col("_most")) / BLOCK), F.ceil(F.col("_all") / BLOCK)
    rows = members.join(tops, "band").select("*", asks.alias("asks"), i.alias("_i"), j.alias("_j"), own.alias("_own"))
    as_asking = F.transform(F.sequence(F.lit(0), F.col("_j") - 1), lambda k: F.struct(
        F.pmod("_own", "_i").cast("long").alias("i"), k.cast("long").alias("j"), F.lit(True).alias("left")))
    as_member = F.transform(F.sequence(F.lit(0), F.col("_i") - 1), lambda k: F.struct(
        k.cast("long").alias("i"), F.pmod("_own", "_j").cast("long").alias("j"), F.lit(False).alias("left")))
    places = F.concat(F.when(F.col("asks"), as_asking).otherwise(F.slice(as_member, F.lit(1), F.lit(0))), as_member)
    dealt = rows.withColumn("_p", F.explode(places)).select("*", "_p.*")
    return dealt.drop("_top", "_all", "_most", "_kinds", "_i", "_j", "_own", "_p", "asks")


def _by_block(members: DataFrame, judge, schema: str) -> DataFrame:
    """``judge`` over whole blocks, many small ones at once: rows come sorted by block, its columns as arrays."""
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            held = now if held is None else pa.concat_tables([held, now])
            edge = _edges(held)
            if len(edge) > 2:
                yield from judge(held.slice(0, int(edge[-2])), edge[:-1]).to_batches()
                held = held.slice(int(edge[-2]))
        if held is not None and len(held):
            yield from judge(held, _edges(held)).to_batches()

    blocks = ["band", "i", "j"]
    return _blocks(members).repartition(*blocks).sortWithinPartitions(*blocks).mapInArrow(runs, schema).distinct()


def _edges(table: pa.Table) -> np.ndarray:
    """Where the blocks of a sorted table begin, and its end."""
    cols = [table.column(c).to_numpy() for c in ("band", "i", "j")]
    new = np.any([c[1:] != c[:-1] for c in cols], axis=0) if len(table) else np.zeros(0, bool)
    return np.r_[0, np.flatnonzero(new) + 1, len(table)]


def _sides(table: pa.Table, edge: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the pairs across components, block by block, in runs of bounded size."""
    left, component = table.column("left").to_numpy(zero_copy_only=False), table.column("component").to_numpy()
    asking, others = np.flatnonzero(left), np.flatnonzero(~left)
    block = np.searchsorted(edge, np.arange(len(left)), "right") - 1
    low, high = np.searchsorted(block[others], block[asking], "left"), np.searchsorted(block[others], block[asking], "right")
    count = high - low
    cuts = np.searchsorted(np.cumsum(count), np.arange(1, count.sum() // PAIRS + 1) * PAIRS, "left")
    for part in np.split(np.arange(len(asking)), np.unique(cuts)):
        n = count[part]
        x = np.repeat(asking[part], n)
        y = others[np.repeat(low[part] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())] if len(part) else x
        cross = component[x] != component[y]
        yield x[cross], y[cross]


def may_link(members: DataFrame, least: float) -> DataFrame:
    """``band, node`` of members whose sketch comes near one of another component in a shared bucket."""
    def near(table: pa.Table, edge: np.ndarray) -> pa.Table:
        regs, sizes = _stack(table.column("registers").to_pylist()), table.column("n_shingles").to_numpy()
        hit = np.zeros(len(table), bool)
        for x, y in _sides(table, edge):
            close = jaccard_estimate(regs[x], regs[y], sizes[x], sizes[y]) >= least
            hit[x[close]] = hit[y[close]] = True
        return table.select(["band", "node"]).filter(pa.array(hit))

    return _by_block(members, near, "band long, node long")


def across(members: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between members of different components of a bucket, one per member and other component."""
    def prove(table: pa.Table, edge: np.ndarray) -> pa.Table:
        node, kind = table.column("node").to_numpy(), table.column("component").to_numpy()
        left = table.column("left").to_numpy(zero_copy_only=False)
        out = set()
        for begin, end in zip(edge[:-1].tolist(), edge[1:].tolist()):
            asking, others = begin + np.flatnonzero(left[begin:end]), begin + np.flatnonzero(~left[begin:end])
            if not len(asking) or not len(others):
                continue
            sets = [np.frombuffer(s.as_buffer(), "<u8") for s in table.column("shingles").slice(begin, end - begin)]
            flat = np.concatenate([sets[k - begin] for k in others])
            sizes = np.array([len(sets[k - begin]) for k in others])
            owner = np.repeat(np.arange(len(others)), sizes)
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            for k in asking.tolist():
                own = sets[k - begin]
                low, high = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
                at = np.repeat(low - np.r_[0, np.cumsum(high - low)[:-1]], high - low) + np.arange((high - low).sum())
                both = np.bincount(owner[at], minlength=len(others))
                hit = others[(100 * both >= percent * (sizes + len(own) - both)) & (kind[others] != kind[k])]
                for other in np.unique(kind[hit]).tolist():
                    out.add((int(node[k]), int(node[hit[kind[hit] == other]].min())))
        links = sorted(out)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return _by_block(members, prove, "a long, b long")


def classed(rows: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``n_shingles, signature, component`` beside the columns of ``rows`` but ``_text``; the component is its smallest ``_key``."""
    beside = [c for c in rows.columns if c != "_text"]
    sketches = cut(rows.select(*beside, sketch(F.col("_text"), words).alias("_s")).select(*beside, "_s.*"), "sketches")
    classes = cut(
        sketches.filter("signature IS NOT NULL").groupBy("signature")
        .agg(F.min("_key").alias("node"), F.first("registers").alias("registers"), F.first("n_shingles").alias("n_shingles")),
        "classes",
    )
    named = classes.filter("node IS NOT NULL").drop("signature")
    members = cut(members_of(named), "members")
    sets = cut(
        rows.join(members.select(F.col("node").alias("_key")).distinct(), "_key", "left_semi")
        .select(F.col("_key").alias("node"), full_set(F.col("_text"), words).alias("shingles")), "sets",
    )

    score = members.groupBy("node").agg(F.sum("held").alias("score"))
    heads = members.join(score, "node").groupBy("band").agg(F.max(F.struct("score", (-F.col("node")).alias("_h")))["_h"].alias("_h"))
    heads = heads.select("band", (-F.col("_h")).alias("head"))
    star = members.join(heads, "band").filter("node <> head").select("head", "node").distinct()
    least = percent / 100 - SLACK
    at_head = named.select(F.col("node").alias("head"), F.col("registers").alias("_r"), F.col("n_shingles").alias("_n"))
    near = star.join(named, "node").join(at_head, "head").filter(
        estimate(F.col("registers"), F.col("_r"), F.col("n_shingles"), F.col("_n")) >= least
    ).select("head", "node")
    proven = near.join(sets, "node").join(sets.select(F.col("node").alias("head"), F.col("shingles").alias("_s")), "head")
    links = cut(proven.filter(linked(F.col("shingles"), F.col("_s"), percent)).select(F.col("head").alias("a"), F.col("node").alias("b")), "stars")
    found = cut(components(links), "components")

    def with_component(rows: DataFrame) -> DataFrame:
        return rows.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))

    open_ = cut(may_link(with_component(members.select("band", "node")).join(named, "node"), least), "open")
    more = cut(across(with_component(open_).join(sets, "node"), percent), "across")
    found = cut(components(links.unionAll(more)), "components")

    ends = classes.join(found, "node", "left").select("signature", F.coalesce("component", "node").alias("component"))
    return sketches.drop("registers").join(ends, "signature", "left")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``key, n_shingles, component_id, kept`` of every row."""
    rows = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))
    out = classed(rows, words, percent).select(
        F.col("_key").alias(key), "n_shingles", F.when(F.col("signature").isNull(), F.col("_key")).otherwise(F.col("component")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.col("component_id").isNull()))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each class of near-duplicates, all columns kept, and all rows without words.

    Rows are told apart by a number of their own, written with them, so rows that share an id,
    or have none, are judged by their texts alone. The row with the smallest id stays, rows
    without an id last, then by the hash of the text. Input columns may have any names.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = cut(docs.select(row.alias("_row"), F.monotonically_increasing_id().alias("_key")), "rows")
    own = F.col("_row").getField(text)
    judged = classed(rows.select("_key", F.col("_row").getField(key).alias("_id"), F.xxhash64(own).alias("_hash"), own.alias("_text")), words, percent)
    order = F.struct(F.col("_id").isNull().alias("none"), "_id", "_hash", "_key")
    stay = judged.groupBy(F.coalesce("component", "_key").alias("_class")).agg(F.min(order)["_key"].alias("_key")).select("_key")
    return rows.join(stay, "_key", "left_semi").select("_row.*")
