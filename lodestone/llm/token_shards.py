"""Token-id output: texts to ids to patched frame-of-reference shard files in ascending doc_id order, and back.

Documents are dealt out by ranges of doc_id, so each task writes files of consecutive documents and a
document's place is its file's start plus its place in there; only one row per file and one total per
task are ever summed. Files go to a folder that all executors share, under names no other attempt uses;
a file counts only if the manifest, which Spark commits, names it.

Defined results: a null or empty text has just the end id; rows with a null doc_id come first; equal
doc_ids follow each other in an order of their texts' hashes; an empty table gives no files and no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import pfor, tokens
from .common import Scratch, tokenizer_path

END_ID = 2
#: Ids after which a task begins its next file; a document is never cut.
FILE_IDS = 2_000_000
_MANIFEST = "path string, task int, part int, n_docs long, n_ids long"
_ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write(docs: DataFrame, out: str, scratch: Scratch, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write docs (doc_id, text) to shard files below `out`; the committed manifest, a row per file."""
    path = path or tokenizer_path()
    end = np.array([end_id], "<u4").tobytes()

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(out)
        store.create_dir(root, recursive=True)
        task, encode = TaskContext.get().partitionId(), tokens.encoder(path)
        doc_ids, lengths, buffer, held, part = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal doc_ids, lengths, buffer, held, part
            name = f"{root}/{task:06d}-{part:04d}-{uuid.uuid4().hex}.pfr"
            with store.open_output_stream(name) as f:
                f.write(pfor.dump(doc_ids, lengths, np.frombuffer(b"".join(buffer), "<u4")))
            row = {"path": [name], "task": [task], "part": [part], "n_docs": [len(doc_ids)], "n_ids": [held]}
            doc_ids, lengths, buffer, held, part = [], [], [], 0, part + 1
            return pa.RecordBatch.from_pydict(
                row, pa.schema([("path", "string"), ("task", "int32"), ("part", "int32"), ("n_docs", "int64"), ("n_ids", "int64")])
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text) + end
                doc_ids.append(doc_id)
                lengths.append(len(ids) // 4)
                buffer.append(ids)
                held += len(ids) // 4
                if held >= FILE_IDS:
                    yield flush()
        if doc_ids:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # The hash and the random number split the rows of one id, equal ones too; no range bound holds a text.
    order = ("doc_id", "_hash", "_random")
    keyed = rows.withColumns({"_hash": F.xxhash64("text"), "_random": F.rand(5)})
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return scratch.table("manifest", dealt.mapInArrow(files, _MANIFEST))


def read(manifest: DataFrame, out: str) -> DataFrame:
    """A row per document of the files that the manifest names, in the form of _ROWS."""
    totals = manifest.groupBy("task").agg(F.sum("n_ids").alias("n"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    # One row per task of the writing job: few, whatever the data.
    bases = totals.select("task", F.coalesce(F.sum("n").over(before.orderBy("task")), F.lit(0)).alias("base"))
    in_task = F.sum("n_ids").over(before.partitionBy("task").orderBy("part"))
    placed = manifest.join(bases, "task").select("path", (F.col("base") + F.coalesce(in_task, F.lit(0))).alias("start"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(out)
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_stream(name) as f:
                    doc_ids, lengths, ids = pfor.load(f.read())
                raw, ends = ids.astype("<u4").tobytes(), np.cumsum(lengths)
                begins = ends - lengths
                crcs = [tokens.crc(raw[4 * a : 4 * b]) for a, b in zip(begins, ends, strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": pa.array(doc_ids, "int64"), "start": begins + start, "n_tokens": lengths, "ids_crc32": pa.array(crcs, "int64")}
                )

    files = manifest.count()
    return placed.repartition(max(1, min(files, 4096)), "path").mapInArrow(documents, _ROWS)
