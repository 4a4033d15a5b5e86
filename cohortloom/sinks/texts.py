"""Many text files of one table, one for each name, written by the tasks themselves.

Spark's own partitioned text writer makes a folder, a file and a checksum file for each name, sets their modes one by one and has a
committer move them: tens of milliseconds a name. Here a task opens a name's file, copies its lines as they lie in the Arrow batch, and renames it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Name of the file of lines that have none.
NAMELESS = "__HIVE_DEFAULT_PARTITION__"


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, memoryview]]:
    """(name, text) of consecutive lines of one name; their text is one piece of the batch's buffer."""
    text = batch.column(1).cast(pa.large_binary())
    _, places, data = text.buffers()
    ends = np.frombuffer(places, np.int64)[text.offset:text.offset + len(text) + 1]
    names = pc.run_end_encode(batch.column(0))
    begin = 0
    for name, end in zip(names.values.to_pylist(), names.run_ends.to_pylist(), strict=True):
        yield name, memoryview(data)[ends[begin]:ends[end]]
        begin = end


def write_texts(rows: DataFrame, path: str, top: str = "", prefix: str = "", file: str = "file", line: str = "line") -> int:
    """Writes the lines of each ``file`` below ``top``, as ``path``/``prefix`` + its name; returns the number of files.

    The lines of a file are in no order. A file is written under a hidden name and renamed when it is whole, so an attempt that fails leaves no
    file, and a second attempt puts the same lines in the place of the first. A file's lines go through one task, a batch at a time.
    """
    fs, root = pafs.FileSystem.from_uri(path)
    fs.create_dir(root)
    head = top.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(path)
        now, out, staged, done = None, None, f"{root}/_{uuid.uuid4().hex}", 0

        def finish() -> int:
            if out is None:
                return 0
            out.close()
            fs.move(staged, f"{root}/{prefix}{now}")
            return 1

        for batch in batches:
            for name, text in _runs(batch) if len(batch) else ():
                if name != now:
                    done += finish()
                    now, out = name, fs.open_output_stream(staged)
                    out.write(head)
                out.write(text)
        yield pa.RecordBatch.from_arrays([pa.array([done + finish()], pa.int64())], names=["files"])

    ended = rows.select(F.coalesce(file, F.lit(NAMELESS)).alias("file"), F.concat(F.coalesce(line, F.lit("")), F.lit("\n")).alias("line"))
    placed = ended.repartition("file").sortWithinPartitions("file")
    return placed.mapInArrow(run, "files bigint").agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]
