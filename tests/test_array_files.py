"""Files of JSON arrays as a batch and a stream source, and counts beside rows."""

import json
import os

from pyspark.sql import functions as F

from prospectra.operators.observe import batch_counts, observed, observed_stream
from prospectra.session import new_path
from prospectra.sources.array_files import ArrayFiles, dealt, listed


def folder_of(tmp_path, files):
    for k, (name, text) in enumerate(files.items()):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(text if isinstance(text, bytes) else text.encode())
        os.utime(path, ns=(10**18 + k, 10**18 + k))
    return str(tmp_path)


FILES = {
    "a.json": '[{"x": 1}, {"x": "é"}, 3, null]', "b.json": "[]", "c.json": '{"x": 1}', "d.json": "[1, 2", "e.json": b"\xff\xfe[", "f.json": "", "deep/g.json": "﻿[[1]]",
    "_hidden.json": "[9]", "h.txt": "[9]",
}


def test_bad_files_are_named_rows(spark, tmp_path):
    folder = folder_of(tmp_path, FILES)
    spark.dataSource.register(ArrayFiles)
    rows = spark.read.format("array_files").option("taskBytes", 20).load(folder).collect()
    good = sorted((os.path.relpath(r.file, folder), r.position, json.loads(r.element)) for r in rows if r.error is None)
    assert [(f, k, v) for f, k, v in good] == [("a.json", 0, {"x": 1}), ("a.json", 1, {"x": "é"}), ("a.json", 2, 3), ("a.json", 3, None), ("deep/g.json", 0, [1])]
    bad = {os.path.relpath(r.file, folder): r.error.split(":")[0] for r in rows if r.error}
    assert bad == {"c.json": "ValueError", "d.json": "JSONDecodeError", "e.json": "UnicodeDecodeError", "f.json": "JSONDecodeError"}
    assert all(r.position is None and r.element is None for r in rows if r.error)
    assert len(dealt(listed(folder, ".json"), 20)) == 3
    (tmp_path / "none").mkdir()
    assert spark.read.format("array_files").load(str(tmp_path / "none")).collect() == []


def test_the_stream_takes_each_file_once(spark, tmp_path):
    spark.dataSource.register(ArrayFiles)
    out, mark = new_path(spark, "array-rows"), new_path(spark, "array-progress")
    seen = []
    for lot in (dict(list(FILES.items())[:3]), FILES, FILES):
        folder = folder_of(tmp_path, lot)
        stream = observed_stream(spark.readStream.format("array_files").load(folder), {"bad": F.col("error").isNotNull()})
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start()
        query.awaitTermination()
        seen += batch_counts(query)
    rows = spark.read.parquet(out)
    assert rows.count() == 9 and rows.filter("error IS NOT NULL").select("file").distinct().count() == 4
    assert [(s["rows"], s["bad"]) for s in seen] == [(5, 1), (4, 3)]


def test_counts_come_from_the_pass_that_writes(spark):
    rows, seen = observed(spark.range(100), {"even": F.col("id") % 2 == 0, "none": F.col("id") < 0}, "beside")
    rows.filter("id > 10").write.parquet(new_path(spark, "observed"))
    assert seen.get == {"rows": 100, "even": 50, "none": 0}
