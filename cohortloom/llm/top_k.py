"""Exact inner-product search: vectors by descending length, rotated partial sums, residual bounds.

The index is a written table of every vector, longest first. A rotation (the right singular vectors
of a bounded sample) moves most of a vector's length into its first coordinates, and
leaves inner products as they are. For a tile of queries and vectors the products are summed over
growing prefixes of coordinates; by Cauchy-Schwarz what is missing is at most the product of the
two residual lengths, and a pair that cannot reach its query's k-th best so far is given up. The pairs
that are left get their score in whole numbers, so the answer does not depend on the rotation's
sample or on rounding.

Queries are taken in blocks of ``block`` rows, which bounds what is sent to the tasks; each block reads the index once
(only row groups long enough to matter). Its first bounds come from the ``head`` longest vectors.

Components become floor(256 * x). Vectors that are null or hold a null or a non-finite component take no
part, nor do rows without an id; a shorter vector has zeros beyond its end. Rows of the query's id are the
query's own and never answers to it. Repeated query rows are answered each; repeated rows are so many candidates. Scores
beyond 64 bits are set to the nearest long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import blobs, cut
from cohortloom.llm.registry import query, table
from cohortloom.session import shared_dir

#: Vectors of a tile; 1,000 queries by 2,048 vectors are 16 MB.
TILE_QUERIES, TILE_VECTORS = 1000, 2048
#: Pairs whose exact score is taken at once.
EXACT = 32_768
#: Rounding of float64 sums, as a share of the product of both lengths; far above what occurs.
SLACK = 1e-9
#: Bound of what one block of queries, or the sample, holds.
BLOCK_BYTES = 2**26
LEAST = np.iinfo(np.int64).min


def _whole_numbers(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector").cast(pa.large_list(pa.float64()))
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten()
            values = pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(size)), size)
            usable = np.bincount(row[~np.isfinite(values)], minlength=len(size)) == 0
            usable &= lists.is_valid().to_numpy(zero_copy_only=False) & batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
            place = np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)
            dense = np.zeros((len(size), width))
            dense[row, place] = np.floor(256.0 * np.where(np.isfinite(values), values, 0))
            dense = dense[usable]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").filter(pa.array(usable)),
                    blobs(dense.reshape(-1), np.arange(len(dense) + 1) * width), pa.array(np.sqrt((dense * dense).sum(1))),
                ],
                names=["vec_id", "v", "norm"],
            )

    return run


def build_index(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, int]:
    """Written table (vec_id, v, norm), longest first, of every usable vector; and their width."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vector"))
    width = int(rows.agg(F.coalesce(F.max(F.size("vector")), F.lit(0))).first()[0])
    width = max(width, 1)
    whole = rows.mapInArrow(_whole_numbers(width), "vec_id bigint, v binary, norm double")
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Equal lengths may be many: the id's hash deals them out.
    dealt = whole.repartitionByRange(parts, F.col("norm").desc(), F.xxhash64("vec_id")).sortWithinPartitions(F.col("norm").desc())
    return cut(dealt, "top-k-index"), width


def _matrix(values, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.float64).reshape(-1, width)


def rotation(sample: np.ndarray, width: int) -> np.ndarray:
    """Right singular vectors of ``sample``, all ``width`` of them, by falling singular value."""
    if not len(sample):
        return np.eye(width)
    scale = max(1.0, float(np.abs(sample).max()))
    return np.linalg.svd(sample / scale, full_matrices=True)[2].T


def dots(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row by row inner products of whole numbers."""
    out = (np.where(np.abs(q) < 2.0**62, q, 0).astype(np.int64) * np.where(np.abs(x) < 2.0**62, x, 0).astype(np.int64)).sum(1)
    for k in np.flatnonzero(~(np.abs(q).max(1, initial=0) * np.abs(x).max(1, initial=0) * q.shape[1] < 2.0**62)):
        out[k] = min(max(sum(int(a) * int(b) for a, b in zip(q[k], x[k], strict=True)), LEAST), -LEAST - 1)
    return out


def prefixes(width: int) -> list[int]:
    """Ends of the prefixes: an eighth, a quarter, half, all."""
    return sorted({max(1, width // 8), max(1, width // 4), max(1, width // 2), width})


class Block:
    """Queries of one pass with their best answers so far."""

    def __init__(self, number: np.ndarray, ids: np.ndarray, v: np.ndarray, turn: np.ndarray, k: int):
        self.number, self.ids, self.v, self.turn, self.k = number, ids, v, turn, k
        self.rotated = v @ turn
        self.ends = prefixes(v.shape[1])
        self.norm = np.sqrt((v * v).sum(1))
        self.rest = self._rests(self.rotated)
        self.score = np.full((len(ids), k), LEAST, np.int64)
        self.answer = np.full((len(ids), k), np.iinfo(np.int64).max, np.int64)
        self.floor = np.full(len(ids), LEAST, np.int64)

    def _rests(self, rotated: np.ndarray) -> list[np.ndarray]:
        """Residual lengths beyond each prefix."""
        return [np.sqrt((rotated[:, e:] ** 2).sum(1)) for e in self.ends]

    def add(self, ids: np.ndarray, v: np.ndarray) -> None:
        """Take ``v`` as candidates, tile by tile."""
        rotated = v @ self.turn
        norm, rest = np.sqrt((v * v).sum(1)), self._rests(rotated)
        for a in range(0, len(ids), TILE_VECTORS):
            x = np.arange(a, min(a + TILE_VECTORS, len(ids)))
            for b in range(0, len(self.ids), TILE_QUERIES):
                self._tile(np.arange(b, min(b + TILE_QUERIES, len(self.ids))), x, ids, v, rotated, norm, rest)

    def _tile(self, q, x, ids, v, rotated, norm, rest) -> None:
        bound = np.maximum(self.floor, self.score[:, -1])
        bound = np.where(bound > LEAST, bound.astype(np.float64), -np.inf)
        # Longest first: where even the longest vector of the tile falls short, its query is through with it.
        q = q[~(self.norm[q] * norm[x].max() * (1 + SLACK) < bound[q])]
        begin, sums = 0, np.zeros((len(q), len(x)))
        for end, mine, theirs in zip(self.ends, self.rest, rest, strict=True):
            if not (len(q) and len(x)):
                return
            sums = sums + self.rotated[q, begin:end] @ rotated[x, begin:end].T
            most = sums + np.outer(mine[q], theirs[x]) + SLACK * np.outer(self.norm[q], norm[x])
            open_ = ~(most < bound[q][:, None])
            rows, columns = open_.any(1), open_.any(0)
            q, x, sums, open_, begin = q[rows], x[columns], sums[np.ix_(rows, columns)], open_[np.ix_(rows, columns)], end
        open_ &= self.ids[q][:, None] != ids[x]
        if len(x) > self.k and open_.sum() > 4 * self.k * len(q):
            # The sums are whole now: the k-th best of this tile is a bound as well.
            slack = SLACK * np.outer(self.norm[q], norm[x])
            best = np.partition(np.where(open_, sums - slack, -np.inf), len(x) - self.k, axis=1)[:, len(x) - self.k]
            open_ &= ~(sums + slack < best[:, None])
        qi, xi = np.nonzero(open_)
        for a in range(0, len(qi), EXACT):
            i, j = q[qi[a : a + EXACT]], x[xi[a : a + EXACT]]
            self._take(i, ids[j], dots(self.v[i], v[j]))

    def _take(self, q: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        enough = score >= np.maximum(self.floor, self.score[:, -1])[q]
        q, ids, score = q[enough], ids[enough], score[enough]
        some = np.unique(q)
        q = np.concatenate([q, np.repeat(some, self.k)])
        ids, score = np.concatenate([ids, self.answer[some].ravel()]), np.concatenate([score, self.score[some].ravel()])
        order = np.lexsort((ids, ~score, q))
        q, ids, score = q[order], ids[order], score[order]
        first = np.searchsorted(q, some)
        best = first[:, None] + np.arange(self.k)
        self.score[some], self.answer[some] = score[best], ids[best]

    def rows(self) -> pa.RecordBatch:
        q, r = np.nonzero((self.score > LEAST) | (self.answer < np.iinfo(np.int64).max))
        return pa.RecordBatch.from_arrays(
            [pa.array(self.number[q]), pa.array(self.ids[q]), pa.array(self.answer[q, r]), pa.array(self.score[q, r])],
            names=["number", "query_id", "vec_id", "score"],
        )


FOUND = "part int, number bigint, query_id bigint, vec_id bigint, score bigint"


def _search(sent, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, v, turn, k, floor = sent.value
        block = Block(number, ids, v, turn, k)
        block.floor = floor
        for batch in batches:
            if len(batch):
                block.add(batch.column("vec_id").to_numpy(), _matrix(batch.column("v").to_pylist(), width))
        yield block.rows()

    return run


def top_k(
    vectors: DataFrame, is_query: str, k: int = 5, *, id_col: str = "vec_id", vec_col: str = "embedding",
    block: int = 16_384, head: int = 2048, sample: int = 4096,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for every row where the SQL condition ``is_query`` holds (over ``vec_id``)."""
    spark = vectors.sparkSession
    index, width = build_index(vectors, id_col=id_col, vec_col=vec_col)
    block, sample = (max(1, min(n, BLOCK_BYTES // (8 * width))) for n in (block, sample))
    turn = rotation(_matrix([r.v for r in index.orderBy(F.xxhash64("vec_id", "v")).limit(sample).select("v").collect()], width), width)
    longest = index.orderBy(F.col("norm").desc(), "vec_id").limit(head).select("vec_id", "v").collect()
    head_ids, head_v = np.array([r.vec_id for r in longest], np.int64), _matrix([r.v for r in longest], width)
    # Repeated query rows are searched once; a hash deals the others into blocks of about a quarter less than ``block``.
    asked = index.filter(is_query).groupBy("vec_id", "v").agg(F.count("*").alias("copies"))
    asked = cut(asked, "top-k-queries")
    parts = max(1, -(-asked.count() * 4 // (3 * block)))
    within = Window.partitionBy("part").orderBy("vec_id", "v")
    asked = asked.withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts)).cast("int")).withColumn("number", F.row_number().over(within).cast("bigint"))
    asked = cut(asked, "top-k-queries")
    root = shared_dir(spark, "top-k")
    spark.createDataFrame([], FOUND).write.parquet(f"{root}/none")
    for part in range(parts):
        for n, piece in enumerate(_pieces(asked.filter(F.col("part") == part), block)):
            first = Block(np.array([r.number for r in piece], np.int64), np.array([r.vec_id for r in piece], np.int64), _matrix([r.v for r in piece], width), turn, k)
            if len(head_ids):
                first.add(head_ids, head_v)
            floor = first.score[:, -1]
            sent = spark.sparkContext.broadcast((first.number, first.ids, first.v, turn, k, floor))
            # A query without k answers so far needs every vector.
            with np.errstate(divide="ignore", invalid="ignore"):
                least = float(np.where(floor > 0, floor / first.norm, -np.inf).min()) * (1 - SLACK)
            reach = index.filter(F.col("norm") >= least) if least > 0 else index
            found = reach.select("vec_id", "v").mapInArrow(_search(sent, width), FOUND.replace("part int, ", ""))
            found.withColumn("part", F.lit(part)).write.mode("overwrite").parquet(f"{root}/{part}-{n}")
            sent.destroy()
    found = spark.read.schema(FOUND).option("recursiveFileLookup", "true").parquet(root)
    best = Window.partitionBy("part", "number").orderBy(F.col("score").desc(), "vec_id")
    found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    found = found.join(asked.select("part", "number", "copies"), ["part", "number"])
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select("query_id", "rank", "vec_id", "score")


def _pieces(rows: DataFrame, block: int) -> Iterator[list]:
    """The rows of one share, at most ``block`` at a time."""
    done = 0
    while piece := rows.filter((F.col("number") > done) & (F.col("number") <= done + block)).collect():
        yield piece
        done += block


SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from s qualify row_number() over (partition by query_id order by score desc, vec_id) <= 5
"""


@query("op11_top_k", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")
