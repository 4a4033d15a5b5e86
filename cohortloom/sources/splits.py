"""Delimited text files, read once and in parallel, by each file's own header.

Files are cut into byte ranges, which Spark deals to tasks. A task reads the leading bytes of a file for its header,
once, and then only the lines that begin in its ranges; of these it takes the wanted cells alone, as Arrow text. So
there is one full read, no sort, no join, and a large file is spread over tasks. Compressed files are one range.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE_BYTES, BLOCK_BYTES, LEAD_BYTES = 64 << 20, 8 << 20, 1 << 16
#: Files up to this size are read in one piece, and the lines of several are cut into cells together, some such size at once.
SMALL_BYTES = 1 << 20
#: Files a task reads, or some more.
FILES_A_TASK = 2_000
PACKED = (".gz", ".bz2", ".zst")


@dataclass
class Layout:
    """Where a file's rows begin and which cell each wanted column is."""

    begin: int
    cells: list[int]


def _open(path: str):
    fs, where = pafs.FileSystem.from_uri(path)
    packed = where.endswith(PACKED)
    # A packed stream has no places to go to; it is read from its beginning.
    return (fs.open_input_stream(where, compression="detect"), True) if packed else (fs.open_input_file(where), False)


def files_below(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of a file, or of the files anywhere below a folder; hidden ones are none, nor is what is not there."""
    path = path.rstrip("/")
    fs, where = pafs.FileSystem.from_uri(path)
    info = fs.get_file_info(where)
    if info.type == pafs.FileType.File:
        return [(path, info.size)]
    if info.type == pafs.FileType.NotFound:
        return []
    found = fs.get_file_info(pafs.FileSelector(where, recursive=True, allow_not_found=True))
    named = [(f.path[len(where):], f) for f in found if f.type == pafs.FileType.File]
    return [(path + rest, f.size) for rest, f in named if not any(p.startswith((".", "_")) for p in rest.split("/"))]


def _listed(names: DataFrame, n_tasks: int) -> DataFrame:
    """(path, length) of the files under each name, listed by ``n_tasks`` tasks: Spark left to itself takes one, for names are few bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [f for p in batch.column(0).to_pylist() if p is not None for f in files_below(p)]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int64())], names=["path", "length"])

    return names.repartition(n_tasks, *names.columns).distinct().mapInArrow(run, "path string, length bigint")


def layout_of(path: str, columns: Sequence[str], header: Sequence[str] | None, comment: str | None, sep: str, stream=None) -> Layout | None:
    """Reads leading bytes, of ``stream`` if it is given, until the header is whole; None for a file without one."""
    if header is not None:
        return Layout(0, [list(header).index(c) for c in columns])
    stream = stream or _open(path)[0]
    mark, lead, begin = comment.encode() if comment else None, b"", 0
    with stream:
        while True:
            end = lead.find(b"\n", begin)
            if end < 0:
                more = stream.read(LEAD_BYTES)
                if more:
                    lead += more
                    continue
                end = len(lead)
                if begin == end:
                    return None
            line = lead[begin:end].rstrip(b"\r")
            begin = end + 1
            if mark is None or not line.startswith(mark):
                break
    names = line.decode().split(sep)
    for c in columns:
        if c not in names:
            raise ValueError(f"no column {c} in {path}")
    return Layout(begin, [names.index(c) for c in columns])


def _blocks(path: str, start: int, end: int | None, begin: int) -> Iterator[tuple[int, bytes]]:
    """(offset, whole lines) of the lines that begin in ``start:end`` and not before ``begin``."""
    stream, packed = _open(path)
    with stream:
        at = 0 if packed else max(start, begin)
        # A range begins with the first line that begins in it.
        if at > begin:
            stream.seek(at - 1)
            rest, skip = b"", True
            at -= 1
        else:
            if not packed:
                stream.seek(at)
            rest, skip = b"", False
        drop = begin if packed else 0
        while True:
            more = stream.read(BLOCK_BYTES)
            buf = rest + more
            if drop:
                cut = min(drop, len(buf))
                buf, drop, at = buf[cut:], drop - cut, at + cut
            if skip:
                cut = buf.find(b"\n") + 1
                if not cut and more:
                    at, rest = at + len(buf), b""
                    continue
                buf, at, skip = buf[cut:] if cut else b"", at + (cut or len(buf)), False
            last = buf.rfind(b"\n") + 1 if more else len(buf)
            lines, rest = buf[:last], buf[last:]
            if end is not None and at + len(lines) > end:
                # Of the lines here, those that begin before the range's end.
                stop = lines.find(b"\n", max(end - at - 1, 0)) + 1 if end > at else 0
                if end <= at or stop:
                    if end > at:
                        yield at, lines[:stop]
                    return
            if lines:
                yield at, lines
            at += len(lines)
            if not more:
                return


def cells_of(buf: bytes, cells: Sequence[int], sep: str, nulls: Sequence[str]) -> tuple[np.ndarray, list[pa.Array]]:
    """Offsets of the lines that are not blank, and the wanted cells of each as text."""
    data = np.frombuffer(buf if buf.endswith(b"\n") else buf + b"\n", np.uint8)
    stops = np.flatnonzero(data == 10)
    starts = np.concatenate([np.zeros(1, np.int64), stops[:-1] + 1])
    ends = stops - ((data[np.maximum(stops - 1, 0)] == 13) & (stops > starts))
    some = ends > starts
    starts, ends = starts[some], ends[some]
    tabs = np.flatnonzero(data == ord(sep))
    first, last = np.searchsorted(tabs, starts), np.searchsorted(tabs, ends)
    fence = np.append(tabs, [len(data)] * (max(cells, default=0) + 2))
    out = []
    for j in cells:
        has = last - first >= j
        lo = starts if j == 0 else np.where(has, fence[first + j - 1] + 1, starts)
        hi = np.where(has, np.where(last - first > j, fence[first + j], ends), lo)
        size = hi - lo
        total = np.cumsum(size)
        take = np.repeat(lo - (total - size), size) + np.arange(size.sum())
        offsets = np.concatenate([np.zeros(1, np.int32), total.astype(np.int32)])
        text = pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[take].tobytes()))
        missing = pa.array(~has) if not nulls else pc.or_(pa.array(~has), pc.is_in(text, pa.array(list(nulls), pa.string())))
        out.append(pc.if_else(missing, pa.scalar(None, pa.string()), text))
    return starts, out


def _joined(parts: list[tuple[str, int, bytes]], cells: Sequence[int], sep: str, nulls: Sequence[str]) -> tuple[pa.Array, np.ndarray, list[pa.Array]]:
    """(label, offset, cells) of the lines of several (label, offset, lines)."""
    lines = [b if b.endswith(b"\n") else b + b"\n" for _, _, b in parts]
    first = np.cumsum([0, *map(len, lines)])[:-1]
    starts, found = cells_of(b"".join(lines), cells, sep, nulls)
    of = np.searchsorted(first, starts, "right") - 1
    at = starts - first[of] + np.array([begin for _, begin, _ in parts], np.int64)[of]
    return pa.array([label for label, _, _ in parts], pa.string()).take(pa.array(of)), at, found


def read_delimited(
    spark: SparkSession, path: str | list[str] | DataFrame, columns: Sequence[str], *, header: Sequence[str] | None = None, comment: str | None = "#",
    nulls: Sequence[str] = ("",), rename: dict[str, str] | None = None, sep: str = "\t", name: str = r"([^/]+)$", range_bytes: int = RANGE_BYTES,
    distinct: bool = False,
) -> DataFrame:
    """(file_name, at, columns...): text cells of whole files; ``at`` orders the lines of a file.

    A file's header is its first line that is no comment; its columns are found by name, in whatever order they
    stand, and a file that lacks one is refused. Comment lines count as such only before the header. With ``header``,
    files have no header line and these columns. Blank lines are no rows, cells a short line lacks are null, as are ``nulls``.
    ``rename`` maps header names to output names, ``name`` picks the file's name from its path.
    With ``distinct`` rows are (file_name, columns...), and a task gives equal rows of what it cuts at once only once: what goes to
    a ``distinct()`` need not leave the task line by line.

    Spark's driver lists ``path``, a folder or several, and holds that list. Where there are many files, ``path`` is a table of one
    column, each a file or folder: then the tasks list them. Spark takes the rows to be as few as the files' names, so
    a join to them has to say that they are not sent around.
    """
    cores = spark.sparkContext.defaultParallelism
    listing = _listed(path, cores) if isinstance(path, DataFrame) else spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    total, n_files = listing.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count(F.lit(1))).first()
    whole = F.lit(False)
    for suffix in PACKED:
        whole = whole | F.col("path").endswith(suffix)
    begins = F.when(whole, F.array(F.lit(0).cast("bigint"))).otherwise(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("bigint")))
    ranges = listing.select("path", whole.alias("whole"), (~whole & (F.col("length") <= min(SMALL_BYTES, range_bytes))).alias("small"), F.explode(begins).alias("start"))
    n_tasks = max(cores, -(-int(total) // range_bytes), -(-n_files // FILES_A_TASK))
    rename, columns = rename or {}, list(columns)
    out_names = ["file_name", "at", *[rename.get(c, c) for c in columns]]
    pattern = re.compile(name)

    def label_of(path: str) -> str:
        found = pattern.search(path)
        return found[1] if found else path

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[tuple[str, int, bytes]]]]:
        """Cells, and (label, offset, lines) of a block of a file or of several small files that have those cells."""
        known: tuple[str, Layout | None] = ("", None)
        cells, parts, held = [], [], 0
        for batch in batches:
            for r in batch.to_pylist():
                if r["small"]:
                    stream, _ = _open(r["path"])
                    with stream:
                        data = stream.read()
                    layout = layout_of(r["path"], columns, header, comment, sep, io.BytesIO(data))
                    if layout is None or layout.begin >= len(data):
                        continue
                    if parts and (layout.cells != cells or held >= SMALL_BYTES):
                        yield cells, parts
                        parts, held = [], 0
                    cells = layout.cells
                    parts.append((label_of(r["path"]), layout.begin, data[layout.begin:]))
                    held += len(data)
                    continue
                if r["path"] != known[0]:
                    known = (r["path"], layout_of(r["path"], columns, header, comment, sep))
                if known[1] is None:
                    continue
                end = None if r["whole"] else r["start"] + range_bytes
                for at, lines in _blocks(r["path"], r["start"], end, known[1].begin):
                    yield known[1].cells, [(label_of(r["path"]), at, lines)]
        if parts:
            yield cells, parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cells, parts in pieces(batches):
            label, at, found = _joined(parts, cells, sep, nulls)
            if distinct:
                names = [out_names[0], *out_names[2:]]
                yield from pa.table([label, *found], names=names).group_by(names).aggregate([]).select(names).to_batches()
            else:
                yield pa.RecordBatch.from_arrays([label, pa.array(at), *found], names=out_names)

    schema = "file_name string" + ("" if distinct else ", at bigint") + "".join(f", `{n}` string" for n in out_names[2:])
    return ranges.repartition(n_tasks).mapInArrow(run, schema)
