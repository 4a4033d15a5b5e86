"""Per-case archives: member lists, shard plan and tar writing."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.scalars import COMPRESSION_SUFFIXES, file_suffix
from cohortloom.operators.skew import SLICE_ROWS, running
from cohortloom.sinks.archive import archive_rows, save_archives

SHARD_BYTES = 512 * 1024 * 1024
CHUNK_SHARDS, GROUP_CHUNKS = 64, 1000
# Formats that are compressed already and stay as they are.
COMPRESSED = (*COMPRESSION_SUFFIXES, "pdf")


def case_bytes(files: DataFrame, case: str, size: str) -> DataFrame:
    """File count and byte sum per case."""
    return files.groupBy(case).agg(
        F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum(size), F.lit(0)).alias("n_bytes")
    )


def _chain(entry: np.ndarray, out: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Compose jump functions: from each ``entry`` on, the shards opened and where the next one opens.

    ``entry`` is sorted; a jump from it opens ``n`` shards and goes on at the first entry at or beyond
    ``out``. Pointers double until they leave the chunk, so the work is n log n.
    """
    size = len(entry)
    jump = np.append(np.searchsorted(entry, out), size)
    total, end = np.append(n, 0), np.append(out, 0)
    while (jump[:size] < size).any():
        on = jump < size
        end = np.where(on, end[jump], end)
        total = total + total[jump]
        jump = jump[jump]
    return total[:size], end[:size]


def _walk(entry: np.ndarray, out: np.ndarray, start: int) -> list[int]:
    """Indices that a walk from ``start`` visits."""
    jump, path = np.searchsorted(entry, out).tolist(), []
    while start < len(entry):
        path.append(start)
        start = jump[start]
    return path


def shard_plan(
    cases: DataFrame, project: str, key: str, size: str, target: int = SHARD_BYTES,
    chunk_shards: int = CHUNK_SHARDS, group_chunks: int = GROUP_CHUNKS, slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Shard number per case: cases in key order, a new shard once the open one has
    reached ``target`` bytes. A null size counts as 0.

    With S the bytes before a case, a shard that opens at S is followed by the one that opens at the first case
    with S + ``target`` or more. So a chunk of ``chunk_shards`` times ``target`` bytes is a
    function: from the place where its first shard opens, to the number of shards it opens and the bytes at which the
    next may open. That place lies in the chunk's first ``target`` bytes, whatever came before, so the
    function is a small table. Functions of ``group_chunks`` chunks are composed by one task, the few
    groups of a project by another; then the places go back down to the chunks, and each case counts the
    openings of its chunk up to its own S. One plan, whatever the size: no rounds, nothing written.
    """
    width, span = chunk_shards * target, chunk_shards * target * group_chunks
    rows = running(
        cases.select(project, key, F.coalesce(F.col(size).cast("bigint"), F.lit(0)).alias("__size")),
        [project], [F.col(key)], {"__upto": F.col("__size")}, slice_rows,
    ).withColumn("__s", F.col("__upto") - F.col("__size")).withColumn("__chunk", F.expr(f"__s div {width}"))
    name, kind = "__p", dict(rows.dtypes)[project]
    places = rows.select(F.col(project).alias(name), "__chunk", "__s").distinct()
    jumps_type = f"{name} {kind}, `at` bigint, entry bigint, n bigint, `out` bigint"

    def jumps(lowest: int, pdf: pd.DataFrame, at: int, entry: np.ndarray, out: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        # The first place to be reached is at the lower end's first ``target`` bytes, or the next one after.
        few = int(np.searchsorted(entry, lowest + target)) + 1
        total, end = _chain(entry, out, n)
        return pd.DataFrame({name: pdf[name].iloc[:1].repeat(len(total[:few])).to_numpy(), "at": at, "entry": entry[:few], "n": total[:few], "out": end[:few]})

    def of_chunk(pdf: pd.DataFrame) -> pd.DataFrame:
        s, at = np.sort(pdf["__s"].to_numpy()), int(pdf["__chunk"].iloc[0])
        return jumps(at * width, pdf, at, s, s + target, np.ones(len(s), np.int64))

    def of_group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, at = pdf.sort_values("entry"), int(pdf["group"].iloc[0])
        return jumps(at * span, pdf, at, pdf["entry"].to_numpy(), pdf["out"].to_numpy(), pdf["n"].to_numpy())

    def opened(pdf: pd.DataFrame, start: int, before: int) -> pd.DataFrame:
        """Per chunk or group ``at``: where its first shard opens (null: none does) and the shards opened before."""
        pdf = pdf.sort_values("entry")
        path = pdf.iloc[_walk(pdf["entry"].to_numpy(), pdf["out"].to_numpy(), start)]
        path = path.assign(before=before + path["n"].cumsum() - path["n"]).set_index("at")
        every = np.unique(pdf["at"])
        after = pd.Series(path["before"] + path["n"]).reindex(every).ffill().fillna(before).astype("int64")
        first = path["entry"].reindex(every)
        known = first.notna().to_numpy()
        out = pd.DataFrame({name: pdf[name].iloc[:1].repeat(len(every)).to_numpy(), "at": every})
        out["entry"] = first.astype("Int64").to_numpy()
        out["before"] = np.where(known, path["before"].reindex(every).fillna(0).to_numpy(), after.to_numpy()).astype("int64")
        return out

    opened_type = f"{name} {kind}, `at` bigint, entry bigint, before bigint"
    chunks = places.groupBy(name, "__chunk").applyInPandas(of_chunk, jumps_type).withColumn("group", F.expr(f"`at` div {group_chunks}"))
    groups = chunks.groupBy(name, "group").applyInPandas(of_group, jumps_type)
    top = groups.groupBy(name).applyInPandas(lambda pdf: opened(pdf, 0, 0), opened_type)
    top = top.select(F.col(name).alias("__g"), F.col("at").alias("__at"), F.col("entry").alias("first"), F.col("before").alias("begun"))

    def in_group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("entry")
        first, entry = pdf["first"].iloc[0], pdf["entry"].to_numpy()
        start = len(entry) if pd.isna(first) else int(np.searchsorted(entry, int(first)))
        return opened(pdf, start, int(pdf["begun"].iloc[0]))

    placed = chunks.join(top, F.col(name).eqNullSafe(F.col("__g")) & (F.col("group") == F.col("__at"))).drop("__g", "__at")
    per_chunk = placed.groupBy(name, "group").applyInPandas(in_group, opened_type).select(
        F.col(name).alias("__c"), "at", F.col("entry").alias("first"), "before"
    )

    def openings(pdf: pd.DataFrame) -> pd.DataFrame:
        s, first = np.sort(pdf["__s"].to_numpy()), pdf["first"].iloc[0]
        start = len(s) if pd.isna(first) else int(np.searchsorted(s, int(first)))
        return pd.DataFrame({name: pdf[name].iloc[:1], "at": pdf["at"].iloc[:1], "opens": [s[_walk(s, s + target, start)].tolist()], "before": pdf["before"].iloc[:1]})

    found = places.join(per_chunk, F.col(name).eqNullSafe(F.col("__c")) & (F.col("__chunk") == F.col("at"))).drop("__c")
    found = found.groupBy(name, "__chunk").applyInPandas(openings, f"{name} {kind}, `at` bigint, opens array<bigint>, before bigint")
    here = rows.join(found, F.col(project).eqNullSafe(F.col(name)) & (F.col("__chunk") == F.col("at")))
    shard = F.col("before") + F.size(F.filter("opens", lambda x: x <= F.col("__s"))) - 1
    return here.select(project, key, shard.cast("bigint").alias("shard"))


def members(files: DataFrame, case: str, data_type: str, file_id: str, file_name: str) -> DataFrame:
    """Archive member name per file and whether the writer compresses it."""
    suffix = file_suffix(F.col(file_name))
    packed = F.element_at(F.split(suffix, r"\."), -1).isin(*COMPRESSED)
    name = F.concat_ws(".", F.col(case).cast("string"), data_type, F.col(file_id).cast("string"), suffix)
    return files.withColumn("gzipped", ~packed).withColumn(
        "member", F.when(packed, name).otherwise(F.concat(name, F.lit(".gz")))
    )


def write_shards(rows: DataFrame, out_dir: str, project: str, case: str, n_tasks: int | None = None) -> DataFrame:
    """Write one tar per (project, shard) now, and return the index: a record per member.

    ``rows`` holds project, shard, case, member, gzipped and either ``content`` or
    ``path``. With ``path`` only names are shuffled and the task that writes a shard
    reads the files itself. A shard streams through one task in case order. Any file
    system pyarrow knows can hold the shards.
    """
    index = save_archives(archive_rows(rows, project, case, n_tasks), out_dir)
    return index.withColumnRenamed("project", project)


def cases_index(plan: DataFrame, sizes: DataFrame, project: str, key: str) -> DataFrame:
    """Case-grain index with the shard's path."""
    path = F.concat(F.lit("data/"), project, F.lit("/"), F.lower(project), F.lit("-"), F.lpad(F.col("shard").cast("string"), 6, "0"), F.lit(".tar"))
    s = sizes.select(F.col(key).alias("__k"), "n_files", "n_bytes")
    j = plan.join(s, F.col(key) == F.col("__k"), "left")
    zero = lambda x: F.coalesce(F.col(x), F.lit(0)).alias(x)
    return j.select(project, key, path.alias("shard"), zero("n_files"), zero("n_bytes"))


def files_index(members: DataFrame, plan: DataFrame, project: str, key: str, file_id: str, also: list[str]) -> DataFrame:
    """File-grain index: each member with its case's shard path, by project, case and file.

    Files whose case has no shard are refused: an index must not point nowhere.
    """
    p = plan.select(F.col(key).alias("__k"), F.col(project).alias("__p"), "shard")
    j = members.join(p, F.col(key) == F.col("__k"), "left")
    path = F.concat(F.lit("data/"), F.col("__p"), F.lit("/"), F.lower("__p"), F.lit("-"), F.lpad(F.col("shard").cast("string"), 6, "0"), F.lit(".tar"))
    sure = F.when(F.col("shard").isNull(), F.raise_error(F.concat(F.lit("no shard holds case "), F.col(key).cast("string")))).otherwise(path)
    return j.select(F.col("__p").alias(project), key, F.col(file_id), *also, sure.alias("shard"), "member")
