"""A Spark sink for case archives: one tar per (project, shard), and an index table of its members.

Tasks write into a staging folder. The job's commit gives the archives their names, then the index; its
abort, and a task that fails, delete what they staged. So an archive is there in whole or not at all, whichever
executor is lost, and reading the index afterwards writes nothing.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import tarfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

INDEX = "project string, shard bigint, tar string, member string, md5sum string, md5sum_member string, n_bytes bigint"
_INDEX = pa.schema([
    ("project", pa.string()), ("shard", pa.int64()), ("tar", pa.string()), ("member", pa.string()), ("md5sum", pa.string()),
    ("md5sum_member", pa.string()), ("n_bytes", pa.int64()),
])


@dataclass
class Staged(WriterCommitMessage):
    """(staged path, final path) of a task's archives, and its piece of the index."""

    moves: list[tuple[str, str]] = field(default_factory=list)
    index: str | None = None


def _read(path: str) -> bytes:
    fs, path = pafs.FileSystem.from_uri(path)
    with fs.open_input_stream(path) as f:
        return f.read()


class ArchiveWriter(DataSourceArrowWriter):
    """Rows (project, shard, member, gzipped, source), a shard's rows together and in order; source is content or a path."""

    def __init__(self, out_dir: str, write_id: str):
        self.out_dir, self.write_id = out_dir, write_id

    def _root(self) -> tuple[pafs.FileSystem, str, str]:
        fs, root = pafs.FileSystem.from_uri(self.out_dir)
        return fs, root, f"{root}/_staging-{self.write_id}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        fs, root, staging = self._root()
        mine, done = f"{staging}/{uuid.uuid4().hex}", Staged()
        tar = stream = open_key = None
        records: dict[str, list] = {f.name: [] for f in _INDEX}
        try:
            for batch in iterator:
                for r in batch.to_pylist():
                    key = (r["project"], r["shard"])
                    if key != open_key:
                        if tar is not None:
                            tar.close()
                            stream.close()
                        fs.create_dir(mine, recursive=True)
                        staged = f"{mine}/{len(done.moves):06d}.tar"
                        final = f"{root}/{r['project']}/{str(r['project']).lower()}-{int(r['shard']):06d}.tar"
                        stream = fs.open_output_stream(staged)
                        tar = tarfile.open(fileobj=stream, mode="w|", format=tarfile.GNU_FORMAT)
                        done.moves.append((staged, final))
                        open_key = key
                    raw = r["source"] if isinstance(r["source"], bytes) else _read(r["source"])
                    data = gzip.compress(raw, 6, mtime=0) if r["gzipped"] else raw
                    info = tarfile.TarInfo(r["member"])
                    info.size = len(data)
                    tar.addfile(info, io.BytesIO(data))
                    row = (*key, done.moves[-1][1], r["member"], hashlib.md5(raw).hexdigest(), hashlib.md5(data).hexdigest(), len(data))
                    for name, value in zip(records, row, strict=True):
                        records[name].append(value)
            if tar is not None:
                tar.close()
                stream.close()
                done.index = f"{mine}/index.parquet"
                pq.write_table(pa.table(records, schema=_INDEX), done.index, filesystem=fs)
            return done
        except BaseException:
            if stream is not None and not stream.closed:
                stream.close()
            if fs.get_file_info(mine).type != pafs.FileType.NotFound:
                fs.delete_dir(mine)
            raise

    def commit(self, messages: list[Staged | None]) -> None:
        fs, root, staging = self._root()
        index = f"{root}/_index/{self.write_id}"
        fs.create_dir(index, recursive=True)
        for folder in {final.rpartition("/")[0] for m in messages if m for _, final in m.moves}:
            fs.create_dir(folder, recursive=True)
        for n, m in enumerate(m for m in messages if m and m.moves):
            for staged, final in m.moves:
                if fs.get_file_info(final).type != pafs.FileType.NotFound:
                    fs.delete_file(final)
                fs.move(staged, final)
            fs.move(m.index, f"{index}/part-{n:06d}.parquet")
        self._clear(fs, staging)

    def abort(self, messages: list[Staged | None]) -> None:
        fs, _, staging = self._root()
        self._clear(fs, staging)

    @staticmethod
    def _clear(fs: pafs.FileSystem, staging: str) -> None:
        if fs.get_file_info(staging).type != pafs.FileType.NotFound:
            fs.delete_dir(staging)


class ArchiveSource(DataSource):
    """``df.write.format("case_archives").option("write_id", ...).save(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "case_archives"

    def writer(self, schema, overwrite: bool) -> ArchiveWriter:
        return ArchiveWriter(self.options["path"], self.options["write_id"])


def save_archives(rows: DataFrame, out_dir: str) -> DataFrame:
    """Write the archives of ``rows`` now; returns the index table of what was written."""
    spark, write_id = rows.sparkSession, uuid.uuid4().hex
    spark.dataSource.register(ArchiveSource)
    out_dir = out_dir.rstrip("/")
    rows.write.format(ArchiveSource.name()).option("write_id", write_id).mode("append").save(out_dir)
    return spark.read.schema(INDEX).parquet(f"{out_dir}/_index/{write_id}")


def archive_rows(rows: DataFrame, project: str, case: str, n_tasks: int | None = None) -> DataFrame:
    """Members in the form and order the sink takes: a shard is one task's, by case."""
    source = "content" if "content" in rows.columns else "path"
    flat = rows.select(F.col(project).cast("string").alias("project"), "shard", F.col(case).alias("case"), "member", "gzipped", F.col(source).alias("source"))
    placed = flat.repartition(n_tasks, "project", "shard") if n_tasks else flat.repartition("project", "shard")
    return placed.sortWithinPartitions("project", "shard", "case", "member").drop("case")
