"""Exact n-gram Jaccard join in size-banded tiles with bitmap signatures.

A document's set is its distinct word shingles (64-bit hashes). Two sets link when
``den * intersection >= num * union``.

1. Documents with equal sets are one node; only nodes go on.
2. Shingles are ordered by how often a fixed-size table of hashed counters has seen them, rarest
   first. Linked sets share one of their first n - ceil(t n) + 1 shingles, so nodes are dealt into
   groups by those. A common passage comes last in the order and makes no group.
   The first one they share also stands early enough in both for the rest to make up the overlap,
   which most pairs that only come close to linking fail, before anything else is looked at.
3. Inside a group, each band of sizes is a tile. Every node of a tile is compared with one leader
   of it, and components are formed; then, in groups that still hold several, with a few leaders of
   other components, in ``ROUNDS`` rounds. This is linear in the group and joins most copies.
4. What still holds several components is compared in full across components, in square
   tiles of bounded size, so that no link between different components is lost. Pairs inside one
   component are never made.
5. Every pair passes two tests before its texts are fetched: sizes, and bitmaps. A bit that one
   bitmap has and the other lacks is a shingle that is not shared, which bounds the overlap from
   above. What remains is intersected exactly, as sorted arrays.

Null texts and texts without words have empty sets and link with nothing. Texts with fewer words
than a shingle have one shingle, all their words. Rows are told apart by set: repeated rows and
repeated ids are members like any other; a component's id is its smallest doc_id (null if it has
none), and an empty document's is its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.common import LOWER, NON_SPACE, U, Words, blobs, cut, mix, scan, shingles, text_bytes
from cohortloom.llm.components import components
from cohortloom.llm.registry import query, table

SLOT_BITS, SLOT_CHUNK = 18, 1 << 12
#: Keys that one bucket holds at about, and nodes along one side of a tile.
BUCKET, SIDE = 1_000_000, 1024
#: Rounds of, and number of, leaders in groups of several components.
ROUNDS, LEADERS = 2, 16


def sets_of(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash), each once, sorted."""
    doc, h = shingles(words, n)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    return doc[new], h[new]


def _nodes(doc: np.ndarray, h: np.ndarray, n_docs: int) -> np.ndarray:
    """A 64-bit number for each document's set; 0 for the empty one."""
    firsts = np.searchsorted(doc, np.arange(n_docs + 1))
    size = np.diff(firsts)
    out = np.zeros(n_docs, U)
    if len(h):
        one, two = mix(h + U(0x51ED270B)), mix(h ^ U(0xA5A5A5A55A5A5A5A))
        out[size > 0] = mix(np.add.reduceat(one, firsts[:-1][size > 0]) ^ mix(np.bitwise_xor.reduceat(two, firsts[:-1][size > 0])))
    return out.view(np.int64)


def _summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    def add(t: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(b, np.int64) for b in t.column("counts").to_pylist()], axis=0, dtype=np.int64)
        return pa.table({**{k: t.column(k)[:1] for k in keys}, "counts": pa.array([total.tobytes()], pa.binary())})

    return rows.select(*keys, "counts").groupBy(*keys).applyInArrow(add, ", ".join(f"{k} int" for k in keys) + ", counts binary")


def counters(texts: DataFrame, n: int) -> np.ndarray:
    """Occurrences of shingles by the high bits of their hash, over all documents; its size is fixed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.int64)
        some = 0
        for batch, words in scan(batches, NON_SPACE):
            total += np.bincount((sets_of(words, n)[1] >> U(64 - SLOT_BITS)).astype(np.int64), minlength=len(total))
            some = int(batch.column("lot")[0].as_py()) if batch.num_rows else some
        parts = total.reshape(-1, SLOT_CHUNK)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts), dtype=np.int32)), pa.array(np.full(len(parts), some, np.int32)), pa.array([p.tobytes() for p in parts], pa.binary())], names=["chunk", "lot", "counts"])

    each = texts.select("text", F.pmod(F.spark_partition_id(), F.lit(64)).cast("int").alias("lot")).mapInArrow(run, "chunk int, lot int, counts binary")
    rows = _summed(_summed(each, ["chunk", "lot"]), ["chunk"]).collect()
    out = np.zeros(1 << SLOT_BITS, np.int64)
    for r in rows:
        out[r["chunk"] * SLOT_CHUNK : (r["chunk"] + 1) * SLOT_CHUNK] = np.frombuffer(r["counts"], np.int64)
    return out


def _bitmaps(doc: np.ndarray, h: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of four to eight bits for each shingle (a power of two, 64 at least), end to end, and their first bytes."""
    bits = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(4 * size, 1))).astype(np.int64))
    firsts = np.append(0, np.cumsum(bits // 8))
    out = np.zeros(firsts[-1], np.uint8)
    bit = (h & (bits[doc] - 1).astype(U)).astype(np.int64)
    np.bitwise_or.at(out, firsts[doc] + bit // 8, (1 << (bit % 8)).astype(np.uint8))
    return out, firsts


def prepared(texts: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(doc_id, node, n, keys, bitmap) of every row; keys are the first shingles in order of rarity."""
    counts = texts.sparkSession.sparkContext.broadcast(counters(texts, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = counts.value
        for batch, words in scan(batches, NON_SPACE):
            doc, h = sets_of(words, n)
            size = np.bincount(doc, minlength=batch.num_rows)
            node = _nodes(doc, h, batch.num_rows)
            bitmap, firsts = _bitmaps(doc, h, size)
            bitmap = pa.array([bitmap[a:b].tobytes() for a, b in zip(firsts, firsts[1:], strict=False)], pa.binary())
            order = np.lexsort((h, rare[(h >> U(64 - SLOT_BITS)).astype(np.int64)], doc))
            rank = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
            own = np.where(size > 0, size + (-num * size // den) + 1, 0)
            keys = h[order][rank < own[doc]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(node), pa.array(size, pa.int64()), blobs(keys, np.append(0, np.cumsum(own))), bitmap], names=["doc_id", "node", "n", "keys", "bitmap"])

    return texts.select("doc_id", "text").mapInArrow(run, "doc_id bigint, node bigint, n bigint, keys binary, bitmap binary")


DEALT = "bucket int, keys binary, nodes binary, sizes binary, rooms binary, roots binary"


def _dealt(nodes: DataFrame, n_buckets: int) -> DataFrame:
    """Keys of all nodes, dealt into buckets by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [np.frombuffer(b, U) for b in batch.column("keys").to_pylist()]
            if not each:
                continue
            keys, count = np.concatenate(each), np.array([len(k) for k in each])
            node, n, root = (np.repeat(batch.column(c).to_numpy(zero_copy_only=False), count) for c in ("node", "n", "root"))
            # What can still be shared if this key is the first one that is.
            room = n - (np.arange(len(keys)) - np.repeat(np.cumsum(count) - count, count))
            cols = (node, n, room, root)
            bucket = ((keys >> U(20)) % U(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            firsts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            some = np.flatnonzero(np.diff(firsts))
            v = [x[order] for x in (keys, *cols)]
            cut_up = lambda x: pa.array([x[firsts[b] : firsts[b + 1]].tobytes() for b in some], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *map(cut_up, v)], names=["bucket", "keys", "nodes", "sizes", "rooms", "roots"])

    return nodes.select("node", "n", "root", "keys").mapInArrow(run, DEALT)


def _arrays(t: pa.Table) -> tuple[np.ndarray, ...]:
    """Keys, nodes, sizes, rooms and roots of a bucket, by key and size."""
    k, *rest = (np.frombuffer(b"".join(t.column(c).to_pylist()), U if c == "keys" else np.int64) for c in ("keys", "nodes", "sizes", "rooms", "roots"))
    order = np.lexsort((rest[0], rest[1], k))
    return k[order], *(x[order] for x in rest)


def _largest_partner(size: np.ndarray, room: np.ndarray, num: int, den: int) -> np.ndarray:
    """The largest set with which one of this size and room can link."""
    return np.minimum(room * (num + den) // num - size, size * den // num)


def _pairs_table(a: np.ndarray, b: np.ndarray) -> pa.Table:
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return pa.table({"a": pa.array(both[:, 0], pa.int64()), "b": pa.array(both[:, 1], pa.int64())})


def _leaders(num: int, den: int):
    def pairs(t: pa.Table) -> pa.Table:
        k, node, size, room, _ = _arrays(t)
        band = np.floor(np.log(size) / np.log(den / num)).astype(np.int64)
        most = _largest_partner(size, room, num, den)
        order = np.lexsort((node, most < size, band, k))
        k, node, size, most, band = k[order], node[order], size[order], most[order], band[order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (band[1:] != band[:-1])
        lead = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
        ok = ~new & (size[lead] <= most) & (size <= most[lead])
        return _pairs_table(node[lead[ok]], node[ok])

    return pairs


def _mixed(num: int, den: int):
    """(key, node, n, room) of groups with several components, of nodes with a partner in size and room."""

    def rows(t: pa.Table) -> pa.Table:
        k, node, size, room, root = _arrays(t)
        most = _largest_partner(size, room, num, den)
        keep = np.ones(len(k), bool)
        for _ in range(2):
            k, node, size, room, root, most = (x[keep] for x in (k, node, size, room, root, most))
            first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
            count = np.diff(np.append(first, len(k)))
            if not len(k):
                keep = np.zeros(0, bool)
                break
            several = np.repeat(np.minimum.reduceat(root, first) != np.maximum.reduceat(root, first), count)
            # Rows are sorted by group and size, so partners are a range.
            place = np.repeat(np.arange(len(first)), count).astype(float) * 2.0**32
            among = np.searchsorted(place + size, place + most, "right") - np.searchsorted(place + size, place - (-size * num // den), "left")
            keep = several & (among > ((most >= size) & (size >= -(-size * num // den))))
        k, node, size, room = k[keep], node[keep], size[keep], room[keep]
        return pa.table({"key": pa.array(k.view(np.int64)), "node": pa.array(node), "n": pa.array(size), "room": pa.array(room)})

    return rows


def _some_leaders(seed: int, num: int, den: int):
    """Pairs of each node of a group with a few leaders, drawn by hash, of other components."""

    def pairs(t: pa.Table) -> pa.Table:
        key, node, n, room, root = (t.column(c).to_numpy() for c in ("key", "node", "n", "room", "root"))
        order = np.lexsort((mix(node.view(U) + U(seed)), key))
        key, node, n, room, root = (x[order] for x in (key, node, n, room, root))
        most = _largest_partner(n, room, num, den)
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.append(new, len(key)))
        a, b = [], []
        for k in range(LEADERS):
            lead = np.repeat(new + np.minimum(k, count - 1), count)
            ok = (root != root[lead]) & (n[lead] <= most) & (n <= most[lead])
            a.append(node[lead[ok]])
            b.append(node[ok])
        return _pairs_table(np.concatenate(a), np.concatenate(b))

    return pairs


def _least_overlap(a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """The smallest intersection with which sets of these sizes link."""
    return -(-num * (a + b) // (num + den))


def _folded(bitmaps: list[bytes], n_bytes: int) -> np.ndarray:
    """Bitmaps as rows of 64-bit words, larger ones folded to ``n_bytes``."""
    out = np.zeros((len(bitmaps), n_bytes // 8), U)
    for k, b in enumerate(bitmaps):
        np.bitwise_or.reduce(np.frombuffer(b, U).reshape(-1, n_bytes // 8), axis=0, out=out[k])
    return out


def _may_link(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, num: int, den: int) -> np.ndarray:
    """From bitmaps (rows broadcast against each other): can the sets link?"""
    most = np.minimum(nx - np.bitwise_count(x & ~y).sum(axis=-1, dtype=np.int64), ny - np.bitwise_count(y & ~x).sum(axis=-1, dtype=np.int64))
    return most >= _least_overlap(nx, ny, num, den)


def _tiles(num: int, den: int):
    """Pairs across components of the tiles (key, i, j) in one bucket that pass sizes and bitmaps."""

    def pairs(t: pa.Table) -> pa.Table:
        key, i, j, side, node, n, room, root = (t.column(c).to_numpy() for c in ("key", "i", "j", "side", "node", "n", "room", "root"))
        most = _largest_partner(n, room, num, den)
        width = np.array([len(b.as_buffer()) for b in t.column("bitmap").combine_chunks()] if len(t) else [], np.int64)
        bitmaps = t.column("bitmap").to_pylist()
        order = np.lexsort((n, side, j, i, key))
        new = np.flatnonzero(np.r_[True, np.any([c[order][1:] != c[order][:-1] for c in (key, i, j)], axis=0)]) if len(order) else []
        found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lo, hi in zip(new, np.append(new[1:], len(order)), strict=True):
            rows = order[lo:hi]
            left, right = (rows[side[rows] == 0], rows[side[rows] == 1]) if i[rows[0]] != j[rows[0]] else (rows, rows)
            for r in left:
                fits = right[(root[right] != root[r]) & (n[right] <= most[r]) & (n[r] <= most[right])]
                fits = fits[node[fits] > node[r]] if left is right else fits
                for w in np.unique(width[fits]):
                    some = fits[width[fits] == w]
                    small = int(min(w, width[r]))
                    ok = _may_link(_folded([bitmaps[r]], small), _folded([bitmaps[s] for s in some], small), n[r], n[some], num, den)
                    found_a.append(np.full(int(ok.sum()), node[r]))
                    found_b.append(node[some[ok]])
        return _pairs_table(np.concatenate(found_a), np.concatenate(found_b))

    return pairs


PAIRS = "a bigint, b bigint"


def _bitmap_test(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    side = lambda s: nodes.select(F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("bitmap").alias(f"m{s}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            ma, mb = batch.column("ma").to_pylist(), batch.column("mb").to_pylist()
            small = np.array([min(len(x), len(y)) for x, y in zip(ma, mb, strict=True)], np.int64)
            ok = np.zeros(len(na), bool)
            for w in np.unique(small).tolist():
                for lo in range(0, len(at := np.flatnonzero(small == w)), 4096):
                    r = at[lo : lo + 4096]
                    ok[r] = _may_link(_folded([ma[k] for k in r], w), _folded([mb[k] for k in r], w), na[r], nb[r], num, den)
            yield batch.filter(pa.array(ok)).select(["a", "b"])

    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "ma", "mb")
    return joined.mapInArrow(run, PAIRS)


def verified(pairs: DataFrame, texts: DataFrame, nodes: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Those of the written ``pairs`` that link, by exact intersection."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    asked = nodes.select("node", "doc_id").join(wanted, "node").withColumnRenamed("node", "want")

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows with one id may hold several sets; keep the one that was asked for.
        for batch, words in scan(batches, NON_SPACE):
            same = _nodes(*sets_of(words, n), batch.num_rows) == batch.column("want").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column("want"), batch.column("text")], names=["node", "text"]).filter(pa.array(same))

    held = texts.join(asked, texts["doc_id"].eqNullSafe(asked["doc_id"])).select("want", "text").mapInArrow(named, "node bigint, text string")
    held = cut(held.dropDuplicates(["node"]), "node-texts")
    side = lambda s: held.select(F.col("node").alias(s), F.col("text").alias(f"t{s}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                batch = whole.slice(lo, 256)
                (da, ha), (db, hb) = (sets_of(Words(*text_bytes(batch.column(c)), NON_SPACE, LOWER), n) for c in ("ta", "tb"))
                na, nb = (np.bincount(d, minlength=batch.num_rows) for d in (da, db))
                doc, h = np.concatenate([da, db]), np.concatenate([ha, hb])
                order = np.lexsort((h, doc))
                doc, h = doc[order], h[order]
                twice = (doc[1:] == doc[:-1]) & (h[1:] == h[:-1])
                both = np.bincount(doc[1:][twice], minlength=batch.num_rows)
                yield batch.filter(pa.array(den * both >= num * (na + nb - both))).select(["a", "b"])

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb").mapInArrow(run, PAIRS)


def join_components(docs: DataFrame, *, n: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    rows = cut(prepared(texts, n, num, den), "sets")
    first = lambda c: F.first(c).alias(c)
    nodes = cut(rows.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), first("n"), first("keys"), first("bitmap")), "nodes")
    total = nodes.agg(F.coalesce(F.sum(F.octet_length("keys")), F.lit(0))).first()[0] // 8
    n_buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET))

    def linked(pairs: DataFrame) -> DataFrame:
        kept = cut(_bitmap_test(pairs.distinct(), nodes, num, den), "pairs")
        return cut(verified(kept, texts, nodes, n, num, den), "links")

    def grown(new: DataFrame) -> DataFrame:
        """``roots`` with the links of a written table added: a component so far is a star, its old links are not needed."""
        return roots if new.isEmpty() else components(roots.select(F.col("u").alias("a"), F.col("root").alias("b")).union(new))

    def rooted(some: DataFrame) -> DataFrame:
        return some.join(roots, some["node"] == roots["u"], "left").withColumn("root", F.coalesce("root", "node")).drop("u")

    links = linked(_dealt(nodes.withColumn("root", F.col("node")), n_buckets).groupBy("bucket").applyInArrow(_leaders(num, den), PAIRS))
    roots = components(links)
    mixed = _dealt(rooted(nodes.select("node", "n", "keys")), n_buckets).groupBy("bucket").applyInArrow(_mixed(num, den), "key bigint, node bigint, n bigint, room bigint")
    mixed = cut(mixed, "mixed")
    by_key = F.pmod(F.xxhash64("key"), F.lit(n_buckets)).alias("bucket")
    for seed in range(ROUNDS):
        rows_now = rooted(mixed).select("*", by_key)
        roots = grown(linked(rows_now.groupBy("bucket").applyInArrow(_some_leaders(seed, num, den), PAIRS)))
    now = cut(rooted(mixed), "mixed")
    several = now.groupBy("key").agg(F.count("*").alias("members"), F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b")
    sides = F.ceil(F.col("members") / SIDE).cast("int")
    block = F.pmod(F.xxhash64("node"), sides).cast("int")
    placed = now.join(several.select("key", "members"), "key").select("key", "node", "room", "root", sides.alias("s"), block.alias("own"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
    placed = placed.select("key", "node", "room", "root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"))
    tiles = placed.join(nodes.select("node", "n", "bitmap"), "node").withColumn("bucket", F.pmod(F.xxhash64("key", "i", "j"), F.lit(n_buckets)))
    across = cut(tiles.groupBy("bucket").applyInArrow(_tiles(num, den), PAIRS).distinct(), "pairs")
    roots = grown(cut(verified(across, texts, nodes, n, num, den), "links"))
    of_node = rooted(nodes.select("node", "doc_id"))
    least = of_node.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    label = cut(of_node.join(least, "root").select("node", "component_id"), "labels")
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("node")).alias("node")).join(label, "node", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def drop_near_copies(docs: DataFrame, *, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component left, that with its smallest id (null ids last); columns stay.

    Rows are told apart by numbers of their own, written with them, so rows of one id or of none are
    judged each by itself. Rows without words stay.
    """
    numbered = cut(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    found = join_components(numbered, n=n, num=num, den=den, id_col="__row", text_col=text_col)
    member = found.filter("n_shingles > 0").select(F.col("doc_id").alias("__member"), F.col("component_id").alias("__component"))
    ids = numbered.select(F.col("__row").alias("__own"), F.col(id_col).isNull().alias("__last"), F.col(id_col).alias("__id"))
    member = member.join(ids, member["__member"] == ids["__own"]).drop("__own")
    first = member.groupBy("__component").agg(F.min(F.struct("__last", "__id", "__member")).alias("__first"))
    shared = member.groupBy(F.col("__component").alias("__c")).agg(F.count("*").alias("__n")).filter("__n > 1")
    several = member.join(shared, member["__component"] == shared["__c"]).drop("__c", "__n")
    gone = several.join(first, "__component").filter(F.col("__member") != F.col("__first.__member")).select(F.col("__member").alias("__gone"))
    return numbered.join(gone, numbered["__row"] == gone["__gone"], "left_anti").select(*docs.columns)


SQL = r"""
with recursive d as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct r, array_to_string(w[p:p + least(4, len(w)) - 1], ' ') as x from (select r, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) as p from d)),
n as (select r, count(*) as n from s group by r),
set_of as (select r, md5(string_agg(x, chr(10) order by x)) as k from s group by r),
rep as (select k, min(r) as r from set_of group by k),
u as (select s.* from s join rep using (r)),
o as (select a.r as a, b.r as b, count(*) as i from u a join u b on a.x = b.x and a.r < b.r group by a.r, b.r),
l as (select a, b from o join n na on na.r = a join n nb on nb.r = b where 100 * i >= 85 * (na.n + nb.n - i)),
e as (select a, b from l union select b, a from l),
walk as (select r as a, r as b from rep union select walk.a, e.b from walk join e on walk.b = e.a),
least_of as (select rep.k, min(doc_id) as component_id from rep join walk on walk.a = rep.r join set_of on set_of.k = (select k from rep p where p.r = walk.b) join d on d.r = set_of.r group by rep.k)
select doc_id, coalesce(n, 0) as n_shingles, coalesce(component_id, doc_id) as component_id
from d left join n using (r) left join set_of using (r) left join least_of using (k)
"""


@query("op8_jaccard_join", SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_components(table(spark, sf_dir, "documents"))
