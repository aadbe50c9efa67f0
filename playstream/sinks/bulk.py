"""Documents as bulk files, each batch exactly once (K3, K4, K6).

Tasks write files of their own, which count for nothing; the driver then
publishes one ledger entry that names a batch's files.  A batch that is
killed before that leaves nothing a reader sees, one that runs again after it
finds the entry and removes what it has written twice.  A line pair of a file
is an index bulk request: an action with the document's id, and the document.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from playstream import files


BULK_BYTES = 1 << 23   # of a file, about; a bulk request of its own


@dataclass
class Written(WriterCommitMessage):
    """A task's files."""
    files: list[str]
    rows: int


class _Files:
    """What both kinds of writers do; file systems by the path's own scheme."""

    def __init__(self, path: str) -> None:
        self.path = path.rstrip("/")

    def _at(self):
        from pyarrow import fs
        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path.removeprefix("file:"))

    def write(self, iterator: Iterator[Row]) -> Written:
        system, root = self._at()
        names, rows, out = [], 0, None
        try:
            for row in iterator:
                if out is None:
                    if not names:
                        system.create_dir(f"{root}/files", recursive=True)
                    names.append(f"{uuid.uuid4().hex}.ndjson")
                    out = system.open_output_stream(f"{root}/files/{names[-1]}")
                out.write((json.dumps({"index": {"_id": row["doc_id"]}}) + "\n" + row["value"] + "\n").encode())
                rows += 1
                if out.tell() >= BULK_BYTES:
                    out.close()
                    out = None
        finally:
            if out is not None:
                out.close()
        return Written(names, rows)

    def _publish(self, messages: Sequence[Written | None], batch: int) -> None:
        from pyarrow import fs
        system, root = self._at()
        entry, done = f"{root}/_ledger/{batch}.json", [m for m in messages if m is not None]
        if system.get_file_info(entry).type != fs.FileType.NotFound:
            self._remove(done)   # this batch was there already
            return
        system.create_dir(f"{root}/_ledger", recursive=True)
        hidden = f"{root}/_ledger/.{uuid.uuid4().hex}"
        with system.open_output_stream(hidden) as f:
            f.write(json.dumps({"batch": batch, "files": [f for m in done for f in m.files], "rows": sum(m.rows for m in done)}).encode())
        system.move(hidden, entry)

    def _remove(self, messages: Sequence[Written | None]) -> None:
        system, root = self._at()
        for m in messages:
            for name in m.files if m is not None else []:
                system.delete_file(f"{root}/files/{name}")


class _StreamWriter(_Files, DataSourceStreamWriter):
    def commit(self, messages, batchId: int) -> None:
        self._publish(messages, batchId)

    def abort(self, messages, batchId: int) -> None:
        self._remove(messages)


class _BatchWriter(_Files, DataSourceWriter):
    def __init__(self, path: str, batch: int) -> None:
        super().__init__(path)
        self.batch = batch

    def commit(self, messages) -> None:
        self._publish(messages, self.batch)

    def abort(self, messages) -> None:
        self._remove(messages)


class BulkDocuments(DataSource):
    """Sink ``bulk_documents`` for rows ``(doc_id, value)``; a batch write names its number in the option ``batch``."""

    @classmethod
    def name(cls) -> str:
        return "bulk_documents"

    def writer(self, schema: StructType, overwrite: bool) -> _BatchWriter:
        return _BatchWriter(self.options["path"], int(self.options["batch"]))

    def streamWriter(self, schema: StructType, overwrite: bool) -> _StreamWriter:
        return _StreamWriter(self.options["path"])


def documents(df: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, value)``: every row's id, and its other columns as JSON."""
    return df.select(F.col(doc_id), F.to_json(F.struct(*[c for c in df.columns if c != doc_id])).alias("value"))


def bulk_writer(path: str) -> Callable[[DataFrame, int], None]:
    """A ``(df, batch_id)`` writer for ``foreachBatch``: the batch's rows, with a ``doc_id``, exactly once."""
    def write(df: DataFrame, batch_id: int) -> None:
        df.sparkSession.dataSource.register(BulkDocuments)
        documents(df).write.format("bulk_documents").option("batch", batch_id).mode("append").save(path)
    return write


def read_bulk(spark: SparkSession, path: str) -> DataFrame:
    """``(batch, doc_id, value)`` of the documents that the ledger names."""
    entries = [n for n in files.names(spark, f"{path}/_ledger") if n.endswith(".json") and not n.startswith(".")]
    if not entries:
        return spark.createDataFrame([], "batch long, doc_id string, value string")
    ledger = (spark.read.schema("batch long, files array<string>").json([f"{path}/_ledger/{n}" for n in entries])
              .select("batch", F.explode("files").alias("file")))
    # whole files, so that a document stays with the line before it
    if not files.names(spark, f"{path}/files"):
        return spark.createDataFrame([], "batch long, doc_id string, value string")
    lines = spark.read.option("pathGlobFilter", "*.ndjson").text(f"{path}/files", wholetext=True)
    rows = lines.select(F.col("_metadata.file_name").alias("file"), F.split("value", "\n").alias("l")).join(ledger, "file")
    pairs = rows.select("batch", F.explode(F.transform(F.sequence(F.lit(0), F.size("l") - 3, F.lit(2)), lambda i: F.struct(
        F.get("l", i).alias("a"), F.get("l", i + 1).alias("value")))).alias("p"))   # the last line ends with a break
    return pairs.select("batch", F.get_json_object("p.a", "$.index._id").alias("doc_id"), "p.value")


def sweep_bulk(spark: SparkSession, path: str) -> int:
    """Remove files that no ledger entry names, when no batch is being written; how many there were."""
    named = set()
    for n in files.names(spark, f"{path}/_ledger"):
        if n.endswith(".json") and not n.startswith("."):
            named |= set(json.loads(files.read_text(spark, f"{path}/_ledger/{n}"))["files"])
    lost = [n for n in files.names(spark, f"{path}/files") if not n.startswith(".") and n not in named]
    for n in lost:
        files.remove(spark, f"{path}/files/{n}")
    return len(lost)
