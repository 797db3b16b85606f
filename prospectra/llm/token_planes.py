"""Token ids of documents in bit-plane shuffled files.

Texts are dealt to ranges of the key, encoded there and written in ascending key order, an
end id after every document. A file holds whole documents, their ids cut into chunks of a
fixed count. A chunk's little-endian 32-bit ids are transposed into planes (the four bytes,
or the 32 bits of every id, each gathered), and each plane is compressed with zstandard.
Planes of high bytes are nearly constant, so byte planes are the smaller ones here.

A file, numbers little-endian:

* ``IDPLANE1``;
* the compressed planes, chunk by chunk;
* the index: an Arrow stream of one row per document (``key, at, n_tokens``, ``at`` counted in
  the file), then one of one row per chunk (``first_id, n_ids, offset, planes``; the sizes of
  its compressed planes);
* a JSON object: kind of planes, range and number of the file, ids, sizes of both tables;
* its length and the CRC-32 of both tables and it (8 and 4 bytes), ``IDPLANE1`` again, and a
  line feed, which Spark's text writer adds.

So files land in any store that Spark writes to, through its committer, and a reader finds
any chunk or document from the end of the file.

Null and empty texts give the end id alone. Null keys come first; rows of equal keys follow
each other by the hash of their text, so reruns agree, and equal rows are written one by one.
A text is encoded in pieces, of any length; a file grows beyond its count of ids only by one
document. An empty table gives no file with documents. Columns beyond key and text are left out.
"""

from __future__ import annotations

import functools
import io
import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from prospectra.llm.common import cut, text_slices
from prospectra.llm.token_counts import byte_symbols, plain

MAGIC = b"IDPLANE1"
#: Ids in a chunk.
CHUNK_IDS = 1 << 16
#: Ids from which a file is closed after a document.
FILE_IDS = 1 << 22
#: Planes of a 32-bit id by their kind.
PLANES = {"byte": 4, "bit": 32}
#: Encoded pieces of text a worker remembers; beyond it the memory starts anew. A cache only.
REMEMBERED = 600_000
#: Characters handed to the library at once.
PIECE = 1 << 16
AFTER_SPACE = re.compile(r"\s |^ ")
# Letters, digits and white space of Latin-1, and the pre-tokens of byte-level vocabularies.
LETTER, DIGIT, SPACE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
PRE_TOKEN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{DIGIT}]+| ?[^{SPACE}{LETTER}{DIGIT}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


class IdEncoder:
    """Ids of texts as the library gives them, from ids of remembered pieces.

    A byte-level vocabulary joins nothing across pre-tokens. Latin-1 texts are cut into these,
    and the library's model merges each. Other texts are cut at spaces that follow a visible
    character, where a pre-token always ends; other vocabularies get whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre, special = spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
        self.divides = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer")
            and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in special)
        )
        self.library.no_truncation()
        self.library.no_padding()
        self.specials = [t["content"] for t in special]
        self.model = self.library.model
        self.symbols = {b: s for b, s in enumerate(byte_symbols())}
        self.known: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        """Parts of a text that are encoded apart."""
        if not self.divides:
            return [text]
        if plain(text) and not any(s in text for s in self.specials):
            return PRE_TOKEN.findall(text)
        words = text.split(" ")
        if not AFTER_SPACE.search(text):
            return [words[0], *[" " + w for w in words[1:]]]
        out = [words[0]]
        for word in words[1:]:
            if out[-1] and not out[-1][-1].isspace():
                out.append(" " + word)
            else:
                out[-1] += " " + word
        return out

    def learn(self, pieces: list[str]) -> None:
        """Encodes new pieces: single pre-tokens by the model, the rest by the whole library."""
        rest = []
        for piece in pieces:
            if self.divides and PRE_TOKEN.fullmatch(piece) and plain(piece) and len(piece) < PIECE:
                symbols = piece.encode().decode("latin-1").translate(self.symbols)
                self.known[piece] = array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()
            else:
                rest.append(piece)
        pieces, first, held = rest, 0, 0
        for i, piece in enumerate([*pieces, None]):
            if piece is None or (held and held + len(piece) > PIECE):
                found = self.library.encode_batch_fast(pieces[first:i], add_special_tokens=False) if i > first else []
                self.known.update((p, array("I", e.ids).tobytes()) for p, e in zip(pieces[first:i], found))
                first, held = i, 0
            held += len(piece or "")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        parts = [self.pieces(t) if t else [] for t in texts]
        self.learn(list({p for ps in parts for p in ps}.difference(self.known)))
        return [b"".join(map(self.known.__getitem__, ps)) for ps in parts]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> IdEncoder:
    """One encoder per worker and vocabulary."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is the one it was given
    return IdEncoder(path)


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of a chunk, lowest first."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [p.tobytes() for p in np.packbits(bits.T, axis=1, bitorder="little")]


def from_planes(planes: list[bytes], count: int, kind: str) -> np.ndarray:
    rows = np.stack([np.frombuffer(p, np.uint8) for p in planes])
    if kind == "bit":
        rows = np.packbits(np.unpackbits(rows, axis=1, count=count, bitorder="little").T, axis=1, bitorder="little").T
    return np.ascontiguousarray(rows.T).view("<u4").ravel()


def _stream(table: pa.Table) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue()


def to_file(keys: pa.Array, ids: list[bytes], kind: str, part: int, number: int, chunk_ids: int = CHUNK_IDS) -> bytes:
    """The bytes of a file of documents, without the last line feed."""
    flat = np.frombuffer(b"".join(ids), "<u4")
    sizes = np.array([len(b) // 4 for b in ids], np.int64)
    squeeze = zstandard.ZstdCompressor(level=3)
    body, offset, places = [MAGIC], len(MAGIC), []
    for first in range(0, len(flat), chunk_ids):
        chunk = flat[first:first + chunk_ids]
        planes = [squeeze.compress(p) for p in to_planes(chunk, kind)]
        places.append((first, len(chunk), offset, [len(p) for p in planes]))
        body += planes
        offset += sum(map(len, planes))
    documents = _stream(pa.table({"key": keys, "at": np.cumsum(sizes) - sizes, "n_tokens": sizes}))
    columns = zip(*places) if places else [[]] * 4
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
    chunks = _stream(pa.table({n: pa.array(c, t) for n, c, t in zip(("first_id", "n_ids", "offset", "planes"), columns, kinds)}))
    about = json.dumps({"planes": kind, "part": part, "number": number, "n_ids": len(flat), "tables": [len(documents), len(chunks)]}).encode()
    checked = documents + chunks + about
    return b"".join([*body, checked, struct.pack("<QI", len(about), zlib.crc32(checked)), MAGIC])


class IdFile:
    """Access to the documents and chunks of one file."""

    def __init__(self, data: bytes):
        self.data = memoryview(data)
        tail = len(data) - 1 - len(MAGIC)
        if len(data) < 2 * len(MAGIC) + 13 or data[:len(MAGIC)] != MAGIC or data[tail:] != MAGIC + b"\n":
            raise ValueError("not a file of token ids, or cut short")
        length, crc = struct.unpack("<QI", self.data[tail - 12:tail])
        self.about = json.loads(bytes(self.data[tail - 12 - length:tail - 12]))
        sizes = self.about["tables"]
        begin = tail - 12 - length - sum(sizes)
        if zlib.crc32(self.data[begin:tail - 12]) != crc:
            raise ValueError("the index of a file of token ids is damaged")
        self.documents = pa.ipc.open_stream(self.data[begin:begin + sizes[0]]).read_all()
        self.chunks = pa.ipc.open_stream(self.data[begin + sizes[0]:begin + sum(sizes)]).read_all()

    def chunk(self, k: int) -> np.ndarray:
        """The ids of one chunk; nothing else is unpacked."""
        place = self.chunks.slice(k, 1).to_pylist()[0]
        planes, at, unpack = [], place["offset"], zstandard.ZstdDecompressor()
        for size in place["planes"]:
            planes.append(unpack.decompress(self.data[at:at + size]))
            at += size
        return from_planes(planes, place["n_ids"], self.about["planes"])

    def ids(self, begin: int, end: int) -> np.ndarray:
        """The ids of a stretch, from the chunks that it touches."""
        starts = self.chunks.column("first_id").to_numpy()
        if begin >= end:
            return np.zeros(0, "<u4")
        first, last = (int(np.searchsorted(starts, x, "right")) - 1 for x in (begin, end - 1))
        return np.concatenate([self.chunk(k) for k in range(first, last + 1)])[begin - starts[first]:end - starts[first]]

    def texts(self) -> Iterator[np.ndarray]:
        """The ids of every document in turn, each chunk unpacked once."""
        held, first, next_chunk = np.zeros(0, "<u4"), 0, 0
        for at, n in zip(self.documents.column("at").to_pylist(), self.documents.column("n_tokens").to_pylist()):
            parts = [held[at - first:]]
            have = len(parts[0])
            while have < n:
                parts.append(self.chunk(next_chunk))
                next_chunk += 1
                have += len(parts[-1])
            held, first = np.concatenate(parts) if len(parts) > 1 else parts[0], at
            yield held[:n]


def write_ids(docs: DataFrame, path: str, vocabulary: str, key: str = "doc_id", text: str = "text", end_id: int = 0,
              kind: str = "byte", chunk_ids: int = CHUNK_IDS, file_ids: int = FILE_IDS) -> None:
    """Writes the ids of every document into files under a new folder, in ascending order of the key."""
    if kind not in PLANES:
        raise ValueError(f"planes are one of {', '.join(PLANES)}")
    end = np.array([end_id], "<u4").tobytes()

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held, size, number, part = [], [], 0, 0, None

        def close() -> pa.RecordBatch:
            nonlocal number
            whole = pa.concat_arrays(keys)
            keys.clear()
            data = to_file(whole, held, kind, part, number, chunk_ids)
            held.clear()
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["value"])

        for batch in batches:
            at = 0
            part = batch.column(2)[0].as_py() if len(batch) and part is None else part
            for texts in text_slices(batch.column(1)):
                for ids in encoder(vocabulary).encode(texts):
                    keys.append(batch.column(0).slice(at, 1))
                    held.append(ids + end)
                    at += 1
                    size += len(ids) // 4 + 1
                    if size >= file_ids:
                        yield close()
                        size = 0
        if held:
            yield close()

    row = [F.col("_key").asc_nulls_first(), "_hash", "_row"]
    rows = docs.select(
        F.col(key).alias("_key"), F.col(text).alias("_text"), F.xxhash64(F.col(text)).alias("_hash"), F.monotonically_increasing_id().alias("_row"),
    )
    # The row number lets ranges divide a hot key; rows that it alone tells apart are equal.
    sorted_rows = rows.repartitionByRange(*row).sortWithinPartitions(*row).select("_key", "_text", F.spark_partition_id().alias("_part"))
    made = sorted_rows.mapInArrow(files, "value binary")
    made.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)


def read_ids(spark: SparkSession, path: str, key_type: str = "long", with_ids: bool = True) -> DataFrame:
    """``key, start, n_tokens, ids_crc32`` and the ``ids`` of every document, read from the files of a folder.

    ``start`` counts the ids of all documents before it: those of earlier ranges, of earlier
    files of its range, and of its file. The first two are sums over files, not documents.
    """
    schema = f"_key {key_type}, _part int, _number int, _at long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                file = IdFile(data.as_buffer().to_pybytes())
                n = len(file.documents)
                sums, lists = [], []
                for ids in file.texts():
                    sums.append(zlib.crc32(ids.tobytes()))
                    if with_ids:
                        lists.append(ids.astype(np.int64))
                columns = [
                    file.documents.column("key").combine_chunks(), pa.array(np.full(n, file.about["part"], np.int32)), pa.array(np.full(n, file.about["number"], np.int32)),
                    file.documents.column("at").combine_chunks(), file.documents.column("n_tokens").combine_chunks(), pa.array(sums, pa.int64()),
                ]
                columns += [pa.array(lists, pa.list_(pa.int64()))] if with_ids else []
                yield pa.RecordBatch.from_arrays(columns, ["_key", "_part", "_number", "_at", "n_tokens", "ids_crc32", "ids"][:len(columns)])

    rows = spark.read.format("binaryFile").load(path).select("content").mapInArrow(read, schema)
    rows = rows if with_ids else cut(rows, "ids-read")
    files = rows.groupBy("_part", "_number").agg(F.sum("n_tokens").alias("_ids"))
    parts = files.groupBy("_part").agg(F.sum("_ids").alias("_ids"))
    # One row per range of the writer, so as many as its tasks.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_base"))
    earlier = Window.partitionBy("_part").orderBy("_number").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_part", "_number", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).alias("_inside")).join(parts, "_part")
    out = rows.join(files, ["_part", "_number"]).withColumn("start", F.col("_base") + F.col("_inside") + F.col("_at"))
    return out.select(F.col("_key").alias("key"), "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
