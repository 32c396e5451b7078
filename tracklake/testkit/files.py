"""Write rows (path, content) as files, from the tasks that hold them."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame


def write_files(files: DataFrame, folder: str) -> int:
    """Write every file below the shared ``folder``; returns how many."""
    uri = "file://" + quote("/" + folder.removeprefix("file:").lstrip("/")) if folder.startswith(("/", "file:")) else folder

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pafs.FileSystem.from_uri(uri)
        system.create_dir(root, recursive=True)
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                with system.open_output_stream(f"{root}/{name.as_py()}") as out:
                    out.write(content.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], names=["n"])

    return files.select("path", "content").mapInArrow(put, "n bigint").agg({"n": "sum"}).first()[0]
