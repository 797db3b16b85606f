"""Collocations against brute force."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from prospectra.llm import collocations

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, phrase string, n string, words string, rank long"


def brute(rows, longest, least, top):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        held = {p: a for p, a in f.items() if 1 < len(p) <= longest and a >= least}
        mine = []
        for p, a in held.items():
            inside = (q for q in held if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if any(100 * held[q] >= 100 * a for q in inside):
                continue
            score, _, left, right = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            mine.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(mine)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def corpus(seed, count=150):
    pick = random.Random(seed)
    vocabulary = ["a", "b", "Ab", "é", "the", "\x01", "x\x01", "\x00", "日本", "A", "\x0e", "b\xa0c"]
    seps = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0c"]
    rows = []
    for _ in range(count):
        words = [pick.choice(vocabulary) for _ in range(pick.randint(0, 40))]
        text = "".join(w + pick.choice(seps) for w in words)
        rows.append((pick.choice(["en", "en", "fr", None, "und", ""]), pick.choice([text, text, "a b the A b " * 3 + text])))
    return rows + [("en", None), (None, ""), ("fr", " "), ("en", "long words " * 400), ("en", "q" * 5000)]


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(i, t, g, "x", "y", "z", 1) for i, (g, t) in enumerate(rows)], SCHEMA).repartition(parts)


@pytest.mark.parametrize("seed, longest, least, top, flush", [(1, 5, 10, 2000, 3_000_000), (2, 5, 3, 50, 97), (3, 3, 8, 9, 10), (4, 2, 5, 2000, 50)])
def test_collocations_equal_brute_force(spark, seed, longest, least, top, flush):
    rows = corpus(seed)
    got = collocations.collocations(frame(spark, rows), longest, least, top, flush=flush)
    assert sorted(map(tuple, got.collect())) == brute(rows, longest, least, top)


def test_streams_of_many_ranges(spark, monkeypatch):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        rows = corpus(5, 60)
        assert sorted(map(tuple, collocations.collocations(frame(spark, rows), 5, 2).collect())) == brute(rows, 5, 2, 2000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_products_pass_64_bits(spark):
    a, n, left, right = 3 * 10**11 + 7, 4 * 10**13 + 1, 5 * 10**12 + 3, 7 * 10**11 + 9
    rows = [("en", [], n), ("en", ["x"], left), ("en", ["y"], right), ("en", ["x", "y"], a)]
    got = collocations.scored(spark.createDataFrame(rows, "lang string, words array<string>, f long")).collect()
    assert [(r.a, r.l, r.r, r.n, r.score) for r in got] == [(a, left, right, n, 1000 * a * n // (left * right))]


def test_a_full_bit_map_changes_nothing(spark, monkeypatch):
    rows = corpus(6, 60)
    want = sorted(map(tuple, collocations.collocations(frame(spark, rows), 4, 5).collect()))
    assert want == brute(rows, 4, 5, 2000)
    full = lambda frequent, words: frequent.sparkSession.sparkContext.broadcast(~collocations.np.zeros(collocations.BITS // 64, "u8"))
    monkeypatch.setattr(collocations, "bit_map", full)
    assert sorted(map(tuple, collocations.collocations(frame(spark, rows), 4, 5).collect())) == want


def test_pairs_leave_a_scan_as_a_row_per_flush_and_part(spark, monkeypatch):
    rows = corpus(7)
    texts = frame(spark, rows, 3).select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    full = spark.sparkContext.broadcast(~collocations.np.zeros(collocations.BITS // 64, "u8"))
    packets = collocations.pair_packets(texts, full, 4)
    assert 0 < packets.count() <= 3 * 4
    kinds = collections.Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            kinds.update(("und" if lang is None else lang, *p) for p in zip(words, words[1:]))
    for least in (1, 5, 20):
        assert collocations.frequent_cells(packets, least).count() == sum(n >= least for n in kinds.values())
    monkeypatch.setattr(collocations, "PART_WORDS", 40)
    assert sorted(map(tuple, collocations.collocations(frame(spark, rows), 5, 9, flush=60).collect())) == brute(rows, 5, 9, 2000)


def test_long_texts_are_cut_between_words():
    data = b"ab cd,ef " * 50 + b"x" * 100 + b" tail"
    for limit in (1, 5, 17, 120, 10_000):
        parts = list(collocations.slices(data, limit))
        assert b"".join(parts) == data
        assert all(collocations.EDGE.match(p) for p in parts[1:])


def test_empty_tables(spark):
    for rows in ([], [("en", None)], [("en", "a b c")]):
        df = spark.createDataFrame([(1, t, g, "x", "y", "z", 1) for g, t in rows], SCHEMA)
        assert collocations.collocations(df).collect() == []
    assert collocations.frequent_phrases(spark.createDataFrame([(1, "a", None, "x", "y", "z", 1)], SCHEMA)).select("lang", F.size("words"), "f").collect() == [("und", 0, 1)]
