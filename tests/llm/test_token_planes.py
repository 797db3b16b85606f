"""Files of token ids against the library and through exact round trips."""

import functools
import random
import zlib

import numpy as np
import pytest

from prospectra.llm import token_planes
from prospectra.session import new_path

P = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, start string, key long, n_tokens string"
PARTS = ["a", "Word", " ", "  ", "\n", "\t", "'ll", "'S", "12", "²", "é", "ß", "日本", "🐶", "\x85", "\xa0", "\x1c", " ", "<|endoftext|>", "<|", "!!", "…", "_", "ª"]


@functools.lru_cache
def library(vocabulary="byte_bpe_50k.json"):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path(vocabulary))


def texts(seed, count=150):
    pick = random.Random(seed)
    return ["".join(pick.choice(PARTS) for _ in range(pick.randint(0, 40))) for _ in range(count)] + [None, "", " ", "x" * 70_000, "ab " * 40_000]


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_of_whole_texts(vocabulary):
    tokens, encoder = library(vocabulary), token_planes.IdEncoder(P.path(vocabulary))
    rows = texts(1, 1500)
    for text, got in zip(rows, encoder.encode(rows)):
        assert np.frombuffer(got, "<u4").tolist() == tokens.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    pick = np.random.default_rng(2)
    for n in (0, 1, 7, 8, 1000):
        ids = pick.integers(0, 1 << 32, n, dtype=np.uint32)
        planes = token_planes.to_planes(ids, kind)
        assert len(planes) == token_planes.PLANES[kind]
        assert token_planes.from_planes(planes, n, kind).tolist() == ids.tolist()


def expected(rows, end=0):
    """Key, start, count and checksum of rows in their order."""
    tokens, out, start = library(), [], 0
    for key, text in rows:
        ids = np.array([*tokens.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes()), ids.tolist()))
        start += len(ids)
    return out


@pytest.mark.parametrize("kind, chunk, most", [("byte", 1 << 16, 1 << 22), ("bit", 100, 300), ("byte", 7, 50)])
def test_files_give_back_every_id(spark, kind, chunk, most):
    rows = list(enumerate(texts(3)))
    df = spark.createDataFrame([(i, t, "x", 7, "y") for i, t in rows], SCHEMA).repartition(5)
    path = new_path(spark, "ids")
    token_planes.write_ids(df, path, P.path("byte_bpe_50k.json"), kind=kind, chunk_ids=chunk, file_ids=most)
    got = sorted(tuple(r) for r in token_planes.read_ids(spark, path).collect())
    assert got == [(k, s, n, c, ids) for k, s, n, c, ids in expected(rows)]
    files = spark.read.format("binaryFile").load(path).collect()
    assert most > 1000 or len(files) > 10
    for row in files:
        file = token_planes.IdFile(bytes(row.content))
        for d in file.documents.to_pylist():
            begin, end = d["at"], d["at"] + d["n_tokens"]
            ids = file.ids(begin, end)
            assert ids.tolist() == expected([rows[d["key"]]])[0][4]
        assert len(file.chunk(0)) == min(chunk, file.about["n_ids"])


def test_equal_and_null_keys(spark):
    rows = [(None, "b c"), (None, "b c"), (None, None), (5, "a"), (5, "zz z"), (5, "a"), (2, "q")] * 8
    df = spark.createDataFrame([(i, t, "x", 7, "y") for i, t in rows], SCHEMA).repartition(6)
    paths = [new_path(spark, "ids") for _ in range(2)]
    for path in paths:
        token_planes.write_ids(df, path, P.path("byte_bpe_50k.json"), file_ids=9)
    first, second = (sorted(token_planes.read_ids(spark, path, with_ids=False).collect(), key=lambda r: r.start) for path in paths)
    assert first == second
    assert [r.key for r in first] == [None] * 24 + [2] * 8 + [5] * 24
    start = 0
    for r in first:
        assert r.start == start
        start += r.n_tokens
    each = {(k, e[0][2], e[0][3]) for k, t in rows for e in [expected([(k, t)])]}
    assert {(r.key, r.n_tokens, r.ids_crc32) for r in first} == each


def test_empty_table_and_damage(spark):
    path = new_path(spark, "ids")
    token_planes.write_ids(spark.createDataFrame([], SCHEMA), path, P.path("byte_bpe_50k.json"))
    assert token_planes.read_ids(spark, path).collect() == []
    import pyarrow as pa

    data = token_planes.to_file(pa.array([1, 2]), [b"\1\0\0\0" * 5, b"\2\0\0\0"], "byte", 0, 0) + b"\n"
    assert [x.tolist() for x in token_planes.IdFile(data).texts()] == [[1] * 5, [2]]
    for bad in (data[:-1], data[:40] + b"?" + data[41:-60] + b"?" + data[-59:], b""):
        with pytest.raises(ValueError):
            token_planes.IdFile(bad)
