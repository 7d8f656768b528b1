"""Token-id output: flat unsigned integer files with 64-bit document offsets.

The rows are dealt out by ranges of doc_id, so that the parts in order are the corpus in
ascending doc_id order.  Each part is two flat files in the shared folder:

* ``part-NNNNN.ids``: the ids, 2 bytes each where the vocabulary fits, else 4, little-endian
* ``part-NNNNN.idx``: little-endian 64-bit integers, the count n, n + 1 offsets into the ids,
  then n doc_ids

A part's place in the whole is the prefix sum of the id counts of the parts before it.  A
task writes under a name of its own attempt and renames at the end: a repeated task replaces
the file with the same bytes.

Defined results: null text is encoded as empty (only the end id); null doc_id sorts first and
reads back as null; repeated doc_ids follow in text order; an empty table writes no file.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from scribeflow.llm.common import local_path, slices, texts
from scribeflow.llm.encoding import Encoder
from scribeflow.session import scratch_path

_NULL_ID = np.iinfo(np.int64).min


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, spaced: bool = False) -> list[dict]:
    """Write the files; returns one entry per part (bounded by the number of tasks)."""
    folder = local_path(folder)
    os.makedirs(folder, exist_ok=True)

    def part(batches):
        task = TaskContext.get()
        stem = f"{folder}/part-{task.partitionId():05d}"
        mine = f"{stem}.{task.taskAttemptId()}"
        encoder, counts, ids = Encoder.of(tokenizer, spaced), [], []
        end = np.array([end_id], encoder.dtype).tobytes()
        with open(f"{mine}.ids", "wb") as out:
            for batch in slices(batches):
                ids += [_NULL_ID if x is None else x for x in batch.column("doc_id").to_pylist()]
                for packed in encoder.encode(batch.column("text").to_pylist()):
                    out.write(packed)
                    out.write(end)
                    counts.append(len(packed) // encoder.dtype.itemsize + 1)
        if not counts:
            os.remove(f"{mine}.ids")
            return
        offsets = np.concatenate(([0], np.cumsum(counts)))
        with open(f"{mine}.idx", "wb") as out:
            out.write(np.concatenate(([len(counts)], offsets, ids)).astype("<i8").tobytes())
        for kind in ("ids", "idx"):
            os.replace(f"{mine}.{kind}", f"{stem}.{kind}")
        yield pa.RecordBatch.from_pydict({"part": pa.array([task.partitionId()], pa.int32()), "stem": [stem],
                                          "n_ids": pa.array([int(offsets[-1])], pa.int64()),
                                          "width": pa.array([encoder.dtype.itemsize], pa.int32())})

    rows = (texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
            .mapInArrow(part, "part int, stem string, n_ids long, width int").collect())
    base, out = 0, []
    for r in sorted(rows, key=lambda r: r["part"]):
        out.append({"stem": r["stem"], "base": base, "width": r["width"]})
        base += r["n_ids"]
    return out


def read(spark, parts: list[dict]) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the mapped files."""

    def part(batches):
        for batch in batches:
            for row in batch.to_pylist():
                idx = np.memmap(f"{row['stem']}.idx", dtype="<i8", mode="r")
                n = int(idx[0])
                offsets, ids = idx[1:n + 2], idx[n + 2:2 * n + 2]
                flat = np.memmap(f"{row['stem']}.ids", dtype=f"<u{row['width']}", mode="r")
                for a in range(0, n, 4096):
                    b = min(n, a + 4096)
                    crc = [zlib.crc32(flat[offsets[k]:offsets[k + 1]].astype("<u4").tobytes()) for k in range(a, b)]
                    own = ids[a:b]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(own, pa.int64(), mask=own == _NULL_ID),
                        "start": pa.array(offsets[a:b] + row["base"], pa.int64()),
                        "n_tokens": pa.array(np.diff(offsets[a:b + 1]), pa.int64()),
                        "ids_crc32": pa.array(crc, pa.int64())})

    manifest = spark.createDataFrame([(p["stem"], p["base"], p["width"]) for p in parts], "stem string, base long, width int")
    return manifest.repartition(max(1, len(parts))).mapInArrow(
        part, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1, spaced: bool = False) -> DataFrame:
    spark = docs.sparkSession
    return read(spark, write(docs, scratch_path(spark, "token-files"), tokenizer, end_id, spaced))
