"""Interaction of five text filters, over a stream of files with retractions.

All files of a documents table are read as available-now micro-batches. Four filters depend on a
text alone; the fifth, "identical to a text of a smaller id", depends on the whole table. Its state is
kept per text (its key is 128 bits of SHA-256): the smallest id so far, and how many rows of which part
have it. Texts share a state row by buckets of keys, as a row of its own costs milliseconds each. A later row of a smaller id takes the place, and the rows that lose it are retracted from the
counters of their old failure mask and counted under the new one. A micro-batch's changes are summed
by (part, mask, labels) and written under the batch's number, so a batch that is run again after a
failure replaces its own file. The counters, at most 128 a part, answer every order of the filters.

Before the shuffle by text, each task sums its rows by (text, part, labels), so the copies of one text
are a row or two of a task however many there are.

Null texts are empty; a null id is smaller than nothing and has nothing smaller. Rows of one id and text
are not copies of each other. A null part is the empty string. Several label rows of one id
count as one: 1 where any of them is 1. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import pairwise, permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from cohortloom.llm.common import NON_SPACE, SAME, Words, blocks, text_bytes
from cohortloom.llm.registry import query, table
from cohortloom.session import shared_dir

FILTERS = "ABCDE"
LAST = 1 << FILTERS.index("E")
GOOD, TOXIC = 32, 64
#: Label rows are repeated so often, and documents dealt over as many shares, so that no one id (or null) holds up the join.
SHARES = 4


def _totals(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text are flagged."""
    sums = np.concatenate([np.zeros(1, np.int64), np.cumsum(flags, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


SYMBOLS = np.isin(np.arange(256), [ord(c) for c in "#$%&*|"])


def text_masks(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of the failure conditions A to D of each text."""
    words = Words(data, offsets, NON_SPACE, SAME)
    order = np.lexsort((words.hash, words.doc))
    doc, h = words.doc[order], words.hash[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    distinct = np.bincount(doc[fresh], minlength=len(words.count))
    upper, points = _totals((data >= 65) & (data <= 90), offsets), _totals((data & 0xC0) != 0x80, offsets)
    return (
        (words.count < 100) + 2 * (100 * distinct < 80 * words.count) + 4 * (100 * upper > 10 * points) + 8 * (_totals(SYMBOLS[data], offsets) > 0)
    ).astype(np.int32)


MASKED = "k1 bigint, k2 bigint, part string, mask int, doc_id bigint, share int"


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, text, doc_id) with 128 bits of the text's SHA-256 and its mask in place of the text."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        raw = data.tobytes()
        keys = np.frombuffer(b"".join(hashlib.sha256(raw[a:b]).digest()[:16] for a, b in pairwise(offsets.tolist())), np.int64).reshape(-1, 2)
        masks = [text_masks(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]) for lo, hi in blocks(offsets)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys[:, 0]), pa.array(keys[:, 1]), batch.column("part"), pa.array(np.concatenate([np.zeros(0, np.int32), *masks])),
                batch.column("doc_id"), pa.array((keys[:, 0] % SHARES).astype(np.int32)),
            ],
            names=["k1", "k2", "part", "mask", "doc_id", "share"],
        )


KIND = ["k1", "k2", "part", "flags"]
PARTIAL = "k1 bigint, k2 bigint, part string, flags int, low bigint, at_low bigint, n bigint"
_PARTIAL = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("part", pa.string()), ("flags", pa.int32()), ("low", pa.int64()), ("at_low", pa.int64()), ("n", pa.int64())])
DELTA = "part string, flags int, n bigint"


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k1, k2, part, flags, doc_id) of a task by text, part and flags: smallest id, rows that have it, all rows.

    Rows without an id are counted apart, with -1 in place of the rows at the smallest id.
    """
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        least = rows.group_by(KIND).aggregate([("doc_id", "min"), ("doc_id", "count"), ([], "count_all")])
        same = rows.group_by([*KIND, "doc_id"]).aggregate([([], "count_all")]).rename_columns([*KIND, "doc_id", "same"])
        both = least.join(same, [*KIND, "doc_id_min"], [*KIND, "doc_id"], "left outer")
        kind, zeros = [both[c] for c in KIND], pa.array([0] * len(both), pa.int64())
        known = [*kind, pc.fill_null(both["doc_id_min"], 0), pc.fill_null(both["same"], 0), both["doc_id_count"]]
        none = [*kind, zeros, pc.subtract(zeros, 1), pc.subtract(both["count_all"], both["doc_id_count"])]
        found = pa.concat_tables([pa.table(known, schema=_PARTIAL), pa.table(none, schema=_PARTIAL)])
        yield from found.filter(pc.greater(found["n"], 0)).combine_chunks().to_batches()


def _merge(held: pd.DataFrame, rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """State (k1, k2, part, flags, low, n) after ``rows``, and the changes (part, flags, n) of the counters.

    ``n`` of the state counts the rows that have the smallest id of their text.
    """
    anonymous, rows = rows[rows.at_low < 0], rows[rows.at_low >= 0]
    lows = pd.concat([held[["k1", "k2", "low"]], rows[["k1", "k2", "low"]]]).groupby(["k1", "k2"], as_index=False)["low"].min().rename(columns={"low": "least"})
    held, rows = held.merge(lows, on=["k1", "k2"]), rows.merge(lows, on=["k1", "k2"])
    lost = held[held.low > held.least]
    rows = rows.assign(first=np.where(rows.low == rows.least, rows.at_low, 0))
    now = pd.concat([held[held.low == held.least], rows[rows["first"] > 0].assign(n=lambda r: r["first"])])
    now = now.groupby(KIND, as_index=False).agg(low=("least", "min"), n=("n", "sum"))
    changes = pd.concat([
        lost.assign(n=-lost.n), lost.assign(flags=lost["flags"] | LAST), anonymous,
        rows.assign(n=rows["first"]), rows.assign(n=rows.n - rows["first"], flags=rows["flags"] | LAST),
    ])
    changes = changes.groupby(["part", "flags"], as_index=False)["n"].sum()
    return now, changes[changes.n != 0]


_STATE = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("part", pa.string()), ("flags", pa.int32()), ("low", pa.int64()), ("n", pa.int64())])


def _changes(key, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Counter changes of one bucket of texts, whose state is an Arrow table."""
    held = pa.ipc.open_stream(state.get[0]).read_all() if state.exists else _STATE.empty_table()
    held, changes = _merge(held.to_pandas(), pd.concat(list(parts)))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _STATE) as out:
        out.write_table(pa.Table.from_pandas(held, _STATE, preserve_index=False))
    state.update((sink.getvalue().to_pybytes(),))
    yield changes[["part", "flags", "n"]]


def _pattern(path: str) -> str:
    """A pattern that matches ``path`` alone: a stream takes a folder or a pattern, never one file."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def failure_counts(
    spark: SparkSession, path: str, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    part_col: str = "lang", batches: int = 4, bucket_rows: int = 20_000,
) -> DataFrame:
    """(part, flags, n): documents of the Parquet table at ``path`` by part, failure mask (bits 1 to 16), good (32) and toxic (64).

    Whole ``path`` is read, in about ``batches`` micro-batches of as many files each. A batch reads and writes
    the whole state once, some 60 bytes a text; buckets of ``bucket_rows`` texts keep one
    piece of it near 1 MB. State, progress and counters are in the shared folder; between
    batches, executors hold the state as the session's ``spark.sql.streaming.stateStore.providerClass`` says
    (in memory unless set; on a large cluster, set the RocksDB provider).
    """
    root, still = shared_dir(spark, "filter-audit"), spark.read.parquet(path)
    files, partitions = max(1, len(still.inputFiles())), int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = max(4 * partitions, still.count() // bucket_rows)
    columns = still.select(id_col, text_col, part_col)
    stream = spark.readStream.schema(columns.schema).option("maxFilesPerTrigger", -(-files // batches)).parquet(_pattern(path))
    rows = stream.select(
        F.coalesce(F.col(part_col), F.lit("")).alias("part"), F.col(text_col).alias("text"), F.col(id_col).cast("bigint").alias("doc_id")
    ).mapInArrow(_masks, MASKED)
    flagged = (
        labels.filter("quality = 1 or toxic = 1").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg((F.max(F.when(F.col("quality") == 1, GOOD).otherwise(0)) + F.max(F.when(F.col("toxic") == 1, TOXIC).otherwise(0))).alias("label"))
        .withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
    )
    rows = rows.join(flagged, ["doc_id", "share"], "left")
    rows = rows.select("k1", "k2", "part", (F.col("mask") + F.coalesce("label", F.lit(0))).cast("int").alias("flags"), "doc_id")
    changes = rows.mapInArrow(_summed, PARTIAL).withColumn("bucket", F.pmod("k1", F.lit(n_buckets))).groupBy("bucket").applyInPandasWithState(
        _changes, DELTA, "entries binary", "update", GroupStateTimeout.NoTimeout
    )

    def keep(batch: DataFrame, number: int) -> None:
        batch.groupBy("part", "flags").agg(F.sum("n").alias("n")).coalesce(1).write.mode("overwrite").parquet(f"{root}/counters/batch={number}")

    run = changes.writeStream.outputMode("update").option("checkpointLocation", f"{root}/progress").trigger(availableNow=True).foreachBatch(keep).start()
    run.awaitTermination()
    # An empty table has no batch; the pattern below would then match no folder.
    spark.createDataFrame([], DELTA).write.parquet(f"{root}/counters/batch=-1")
    counters = spark.read.schema(DELTA).parquet(f"{root}/counters")
    return counters.groupBy("part", "flags").agg(F.sum("n").cast("bigint").alias("n")).filter("n <> 0")


def _steps() -> Column:
    """All (filter_order, step, bit, earlier) as one literal array: the orders of the filters and the bits ahead of each step."""
    steps = []
    for order in permutations(FILTERS):
        earlier = 0
        for k, f in enumerate(order, 1):
            bit = 1 << FILTERS.index(f)
            steps.append({"filter_order": "".join(order), "step": k, "bit": bit, "earlier": earlier})
            earlier |= bit
    return F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,bit:int,earlier:int>>")


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from :func:`failure_counts`."""
    mask, n = F.col("flags").bitwiseAND(31), F.col("n")
    rows = counts.select("part", mask.alias("mask"), "flags", "n", F.explode(_steps()).alias("s")).select("part", "mask", "flags", "n", "s.*")
    fails, gone = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("earlier")) != 0

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(0))

    out = rows.groupBy("part", "filter_order", "step", "bit").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(fails & ~gone & (F.col("flags").bitwiseAND(GOOD) != 0)).alias("good_lost"),
        total(fails & ~gone & (F.col("flags").bitwiseAND(TOXIC) != 0)).alias("toxic_lost"),
    )
    shares = out.groupBy("part", "bit").agg(F.sum("removed").alias("shapley"))
    return out.join(shares, ["part", "bit"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


SQL = r"""
with d as (select coalesce(text, '') as t, coalesce(lang, '') as part, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
l as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic from labels group by doc_id),
m as (select part, coalesce(good, 0) as good, coalesce(l.toxic, 0) as toxic,
    case when len(w) < 100 then 1 else 0 end + case when 100 * len(list_distinct(w)) < 80 * len(w) then 2 else 0 end
    + case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) then 4 else 0 end
    + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
    + case when min(d.doc_id) over (partition by t) < d.doc_id then 16 else 0 end as mask
  from d left join l using (doc_id)),
c as (select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from m group by part, mask),
f as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v (name, bit)),
o as (select a.name || b.name || c.name || d.name || e.name as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from f a, f b, f c, f d, f e where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s as (select filter_order, cast(k as integer) as step, bits[k] as bit, coalesce(list_sum(bits[1:k - 1]), 0)::integer as earlier from o, range(1, 6) r (k)),
r as (select part, filter_order, step, bit,
    sum(case when mask & bit = 0 and mask & earlier = 0 then n else 0 end) as kept,
    sum(case when mask & bit > 0 and mask & earlier = 0 then n else 0 end) as removed,
    sum(case when mask & bit > 0 and mask & earlier > 0 then n else 0 end) as redundant,
    sum(case when mask = bit then n else 0 end) as unique_fails,
    sum(case when mask & bit > 0 and mask & earlier = 0 then good else 0 end) as good_lost,
    sum(case when mask & bit > 0 and mask & earlier = 0 then toxic else 0 end) as toxic_lost
  from c, s group by all)
select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant, unique_fails::bigint as unique_fails,
  good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, bit))::bigint as shapley from r
"""


@query("op13_filter_audit", SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(failure_counts(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels")))
