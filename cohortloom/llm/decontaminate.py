"""Benchmark decontamination by a broadcast hash set of test n-grams.

Items are cut into windows of ``n`` words (an item with fewer words is one window).
Their hashes are broadcast as sorted arrays behind a bitmap; documents are scanned
window by window, and every hash hit is verified word for word. The scan is a map:
nothing is shuffled.

The broadcast is bounded: items are dealt into blocks of about ``block_bytes`` of text,
and documents are scanned once per block. Several blocks are joined by carrying what is
found so far along with each row, through a table in the shared folder.

Null and empty texts have no words: such documents are clean, such items match nothing.
Repeated rows are judged one by one; repeated item ids count once per document.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.common import ALNUM, U, Words, blocks, cut, scan, text_bytes
from cohortloom.llm.registry import query, table

BITS = 22


class WindowSet:
    """Windows of one length: sorted hashes, and for each its text and the items that have it."""

    def __init__(self, length: int, found: dict[bytes, set[str]], hashes: dict[bytes, int]):
        self.length = length
        by_hash: dict[int, list[bytes]] = defaultdict(list)
        for text in found:
            by_hash[hashes[text]].append(text)
        self.keys = np.array(sorted(by_hash), U)
        self.texts = [[(t, sorted(found[t])) for t in by_hash[int(k)]] for k in self.keys]
        self.bitmap = np.zeros(1 << BITS, bool)
        self.bitmap[self.keys >> U(64 - BITS)] = True

    def hits(self, words: Words) -> Iterator[tuple[int, list[str]]]:
        """(word, items) of each verified occurrence."""
        h, ok = words.windows(self.length)
        maybe = np.flatnonzero(self.bitmap[h >> U(64 - BITS)] & ok)
        slot = np.searchsorted(self.keys, h[maybe])
        same = slot < len(self.keys)
        same[same] = self.keys[slot[same]] == h[maybe][same]
        for i, k in zip(maybe[same].tolist(), slot[same].tolist(), strict=True):
            text = words.text(i, i + self.length)
            for known, items in self.texts[k]:
                if known == text:
                    yield i, items


def window_sets(ids: list[str], texts: list[str | None], n: int) -> list[WindowSet]:
    data, offsets = text_bytes(pa.array(texts, pa.large_string()))
    words = Words(data, offsets, ALNUM)
    found: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
    hashes: dict[int, dict[bytes, int]] = defaultdict(dict)
    by_length = {k: words.windows(k)[0] for k in {min(n, int(c)) for c in words.count if c}}
    for d, item in enumerate(ids):
        lo, hi = int(words.first[d]), int(words.first[d + 1])
        size = min(n, hi - lo)
        for i in range(lo, hi - size + 1) if size else ():
            text = words.text(i, i + size)
            found[size][text].add(item)
            hashes[size][text] = int(by_length[size][i])
    return [WindowSet(k, found[k], hashes[k]) for k in sorted(found)]


def _scanner(sets, schema: pa.Schema, id_col: str, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sets.value
        for batch, words in scan(batches, ALNUM):
            count = batch.num_rows
            spans, items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            cover = np.zeros(len(words.hash) + 1, np.int64)
            touched: dict[int, set[str]] = {}
            for one in known:
                for i, names in one.hits(words):
                    cover[i] += 1
                    cover[i + one.length] -= 1
                    touched.setdefault(int(words.doc[i]), set()).update(names)
            for d in touched:
                for s in spans[d]:
                    cover[words.first[d] + s["start"]] += 1
                    cover[words.first[d] + s["end"]] -= 1
            hit = np.cumsum(cover)[:-1] > 0
            for d, names in touched.items():
                lo, hi = int(words.first[d]), int(words.first[d + 1])
                inside = np.zeros(hi - lo + 2, np.int8)
                inside[1:-1] = hit[lo:hi]
                step = np.diff(inside)
                starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
                spans[d] = [{"start": int(a), "end": int(b)} for a, b in zip(starts, ends, strict=True)]
                items[d] = sorted(names.union(items[d]))
            out = {id_col: batch.column("doc_id"), "n_words": pa.array(words.count, pa.int64())}
            if keep_text:
                out["text"] = batch.column("text")
            out |= {"spans": pa.array(spans, schema.field("spans").type), "items": pa.array(items, schema.field("items").type)}
            yield pa.RecordBatch.from_arrays([out[f.name].cast(f.type) for f in schema], schema=schema) if count else pa.RecordBatch.from_pylist([], schema)

    return run


SPANS, ITEMS = "array<struct<start:bigint,end:bigint>>", "array<string>"
_ARROW = {"spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), "items": pa.list_(pa.string())}


def _blocks_of(spark: SparkSession, items: DataFrame, n: int, item_col: str, item_text_col: str, block_bytes: int) -> Iterator[tuple[bool, object]]:
    """(whether it is the last, broadcast windows) of each block of items."""
    tests = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("words")).filter("words is not null")
    total = tests.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-int(total) // block_bytes))
    for k in range(n_blocks):
        rows = tests.filter(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == k).collect()
        yield k == n_blocks - 1, spark.sparkContext.broadcast(window_sets([r[0] or "" for r in rows], [r[1] for r in rows], n))


def contamination(
    docs: DataFrame, items: DataFrame, *, n: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 32_000_000,
) -> DataFrame:
    """Per document row: id, n_words, spans (merged ranges of hit words), items (ids with occurring windows, as strings)."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType
    found = docs.select(
        F.col(id_col).alias("doc_id"), F.lit(0).cast("bigint").alias("n_words"), F.col(text_col).alias("text"),
        F.array().cast(SPANS).alias("spans"), F.array().cast(ITEMS).alias("items"),
    )
    for last, sets in _blocks_of(spark, items, n, item_col, item_text_col, block_bytes):
        fields = [("doc_id", to_arrow_type(id_type)), ("n_words", pa.int64())] + ([] if last else [("text", pa.string())]) + list(_ARROW.items())
        ddl = f"doc_id {id_type.simpleString()}, n_words bigint, {'' if last else 'text string, '}spans {SPANS}, items {ITEMS}"
        found = found.mapInArrow(_scanner(sets, pa.schema(fields), "doc_id", not last), ddl)
        if not last:
            found = cut(found, "decontaminate")
    return found.withColumnRenamed("doc_id", id_col)


def n_hit(spans: str = "spans") -> Column:
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])


def drop_contaminated(
    docs: DataFrame, items: DataFrame, *, n: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 32_000_000,
) -> DataFrame:
    """``docs`` without the rows that contain a window of an item; all columns stay as they are.

    A map: each row is judged by its own text, once per block of items, whatever its id.
    """
    spark, at = docs.sparkSession, docs.columns.index(text_col)
    for _, sets in _blocks_of(spark, items, n, item_col, item_text_col, block_bytes):

        def run(batches: Iterator[pa.RecordBatch], sets=sets) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, offsets = text_bytes(batch.column(at))
                clean = np.ones(batch.num_rows, bool)
                for lo, hi in blocks(offsets):
                    words = Words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], ALNUM)
                    for one in sets.value:
                        for i, _ in one.hits(words):
                            clean[lo + words.doc[i]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def cut_spans(text: str | None, spans: list, kind: np.ndarray = ALNUM) -> str | None:
    """One text without the words of ``spans``; what stands between words of a span goes with them."""
    if not text or not spans:
        return text
    data, offsets = text_bytes(pa.array([text], pa.large_string()))
    words, out, at = Words(data, offsets, kind), [], 0
    raw = text.encode()
    for s in spans:
        out.append(raw[at : words.start[s["start"]]])
        at = int(words.end[s["end"] - 1])
    return b"".join([*out, raw[at:]]).decode()


WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SQL = rf"""
with d as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as w from documents),
i as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as w from benchmark),
iw as (select distinct item_id, least(10, len(w)) as n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') as x
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) as p from i)),
dw as (select r, n, p, array_to_string(w[p:p + n - 1], ' ') as x
  from (select r, n, w, unnest(range(1, len(w) - n + 2)) as p from d, (select distinct n from iw))),
hit as (select r, p, iw.n, item_id from dw join iw on dw.x = iw.x and dw.n = iw.n),
covered as (select r, count(*) as n_hit from (select distinct r, unnest(range(p, p + n)) as q from hit) group by r),
named as (select r, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct r, cast(item_id as varchar) as item from hit) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (r) left join named using (r)
"""


@query("op2_decontaminate", SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (F.size("items") > 0).alias("contaminated"),
    )
