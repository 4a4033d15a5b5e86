"""Language-model scores by masked pseudo-likelihood.

A small network predicts each word of a text from its two neighbours on either side, the word
itself being masked; a text's score is the sum of the log-probabilities of all its words.

1. Words are counted over all documents: distinct per task, then summed. The ``kept`` most frequent
   ones are classes of their own; the others fall into ``rest`` hashed classes. A word's probability
   is that of its class given its neighbours times its share of the class, its own count over the
   class's, and what the corpus tells grows with the corpus. A word that the corpus lacks counts
   as met once.
2. The network is trained in numpy on every word of every document: an embedding for each class and
   place, added up, a tanh layer, a softmax over classes. In a round each task takes stochastic
   gradient steps through all its documents, from the weights all tasks share; then the weights are
   averaged, by words. What tasks send is of the network's fixed size. Tasks hold ``shard`` words or
   more each, by joining partitions of small inputs. There are ``rounds`` of them, one unless the caller says
   more, whatever the size. The seed is fixed, so equal input in equal partitions gives an equal
   model (but for the last bits of sums); scores follow the partitioning in their second digit or so.
3. All documents are scored in one map with the broadcast network, whose size is fixed. Counts of
   words, as many as the corpus has, are not broadcast: each block of documents sends the hashes of its
   distinct words of hashed classes, once and in buckets, to where the counts of a bucket are, and
   gets their logarithms back.

A text without words has n_words 0, log_prob 0 and a null mean. Repeated rows are scored each.
Without any words in the corpus nothing is trained, and all rows have that result.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.common import ALNUM, U, Words, blobs, cut, mix, scan
from cohortloom.llm.registry import query, table

SIDE = (-2, -1, 1, 2)
#: Tasks that add up weights.
ADDERS = 8
#: Distinct words of the corpus for each bucket of counts.
BUCKET_WORDS = 50_000
#: In place of a bucket: a document's row, and the row that tells which documents hold a block's words.
DOC, HELD = -2, -1


def word_counts(docs: DataFrame, text_col: str = "text", flush: int = 2_000_000) -> DataFrame:
    """(word, n): occurrences of each word (by hash) in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            h, back = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
            return h, np.bincount(back, np.concatenate([n for _, n in held])).astype(np.int64)

        for _, words in scan(batches, ALNUM):
            held.append(np.unique(words.hash, return_counts=True))
            if sum(len(x) for x, _ in held) > flush:
                held = [merged()]
                if len(held[0][0]) > flush // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(held[0][0].view(np.int64)), pa.array(held[0][1])], names=["word", "n"])
                    held = []
        if held:
            h, n = merged()
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["word", "n"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def bucket_of(word: np.ndarray, n_buckets: int) -> np.ndarray:
    """Rises with the (unsigned) hash."""
    return ((word >> U(40)) * U(n_buckets) >> U(24)).astype(np.int64)


class Vocabulary:
    """Classes 0 .. kept - 1 are single words, the next ``rest`` ones hold all others; the last number is no word."""

    def __init__(self, words: np.ndarray, met: np.ndarray):
        self.words = np.sort(words)
        self.rest = len(met)
        self.pad = len(self.words) + self.rest
        #: log of the share that a word met once has of its class
        self.share = np.concatenate([np.zeros(len(self.words)), -np.log(np.maximum(met, 1))])

    def __call__(self, words: Words) -> np.ndarray:
        h = words.hash
        slot = np.minimum(np.searchsorted(self.words, h), max(len(self.words) - 1, 0))
        own = self.words[slot] == h if len(self.words) else np.zeros(len(h), bool)
        return np.where(own, slot, len(self.words) + (mix(h) % U(self.rest)).astype(np.int64))


def neighbours(ids: np.ndarray, words: Words, pad: int) -> np.ndarray:
    """(words x 4) classes on both sides, ``pad`` beyond the document."""
    out = np.full((len(ids), len(SIDE)), pad, np.int32)
    for k, s in enumerate(SIDE):
        a, b = (slice(-s, None), slice(None, s)) if s < 0 else (slice(None, -s), slice(s, None))
        if len(ids) > abs(s):
            same = words.doc[a] == words.doc[b]
            out[a, k] = np.where(same, ids[b], pad)
    return out


class Network:
    """log p(class | neighbours) = log softmax(W tanh(sum of embeddings) + b)."""

    def __init__(self, vocabulary: Vocabulary, width: int = 24, seed: int = 7):
        rng = np.random.default_rng(seed)
        n = vocabulary.pad
        self.vocabulary = vocabulary
        self.embed = (rng.standard_normal((len(SIDE), n + 1, width)) * 0.1).astype(np.float32)
        self.out = (rng.standard_normal((width, n)) * 0.1).astype(np.float32)
        self.bias = np.zeros(n, np.float32)
        #: words the last round learned from
        self.learned = 0
        #: (word, n) of the corpus, a table of the driver's session; None: all words count as met once
        self.counts: DataFrame | None = None
        #: distinct words of the corpus
        self.distinct = 0

    def __getstate__(self) -> dict:
        return {**self.__dict__, "counts": None}

    def hidden(self, near: np.ndarray) -> np.ndarray:
        h = self.embed[0].take(near[:, 0], axis=0)
        for k in range(1, len(SIDE)):
            h += self.embed[k].take(near[:, k], axis=0)
        return np.tanh(h, out=h)

    def _layer(self) -> np.ndarray:
        """Weights with the bias as the row of a unit that is always 1."""
        return np.concatenate([self.out, self.bias[None]])

    def _with_one(self, h: np.ndarray) -> np.ndarray:
        return np.concatenate([h, np.ones((len(h), 1), np.float32)], axis=1)

    def log_probs(self, ids: np.ndarray, near: np.ndarray, step: int = 2048) -> np.ndarray:
        """Of each class, given its neighbours."""
        out, layer, ones = np.empty(len(ids)), self._layer(), np.ones(len(self.bias), np.float32)
        for lo in range(0, len(ids), step):
            part = slice(lo, lo + step)
            logits = self._with_one(self.hidden(near[part])) @ layer
            mine = logits[np.arange(len(logits)), ids[part]].astype(float)
            # Weights are bounded in training, so that no exponential overflows.
            out[part] = mine - np.log(np.exp(logits, out=logits) @ ones)
        return out

    def fit(self, ids: np.ndarray, near: np.ndarray, rates: tuple[float, float], rng: np.random.Generator, batch: int = 512) -> None:
        """Stochastic gradient steps through all words once, at a rate that falls from the first to the second."""
        order = rng.permutation(len(ids))
        n, width = self.embed.shape[1:]
        layer, ones = self._layer(), np.ones(len(self.bias), np.float32)
        flat = self.embed.reshape(-1)
        place = np.arange(len(SIDE))[:, None] * (n * width) + np.arange(width)
        for lo in range(0, len(ids), batch):
            at = order[lo : lo + batch]
            lr = rates[0] + (rates[1] - rates[0]) * lo / len(ids)
            mine, share = near[at], np.float32(1 / len(at))
            h = self.hidden(mine)
            one = self._with_one(h)
            p = one @ layer
            np.exp(p, out=p)
            p *= (share / (p @ ones))[:, None]
            p[np.arange(len(at)), ids[at]] -= share
            back = (p @ layer[:-1].T) * (1 - h * h)
            layer -= lr * (one.T @ p)
            back *= lr * len(SIDE) * 8
            # Rows of one class are added up, all sides at once.
            cell = mine[:, :, None].astype(np.int64) * width + place
            flat -= np.bincount(cell.ravel(), np.repeat(back[:, None], len(SIDE), axis=1).ravel(), minlength=len(flat)).astype(np.float32)
            np.clip(layer[:-1], -3, 3, out=layer[:-1])
            np.clip(layer[-1], -12, 12, out=layer[-1])
        self.out, self.bias = layer[:-1].copy(), layer[-1].copy()

    def weights(self) -> np.ndarray:
        return np.concatenate([self.embed.ravel(), self.out.ravel(), self.bias])

    def set_weights(self, flat: np.ndarray) -> None:
        at = 0
        for name in ("embed", "out", "bias"):
            old = getattr(self, name)
            setattr(self, name, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size


def trained_round(texts: DataFrame, network: Network, words: float, rates: tuple[float, float], seed: int) -> int:
    """One pass over all of ``texts``: steps in each task, then the mean of the tasks' weights. Words that were learned from.

    ``words`` is about what a task holds; the rate falls with it.
    """
    shared = texts.sparkSession.sparkContext.broadcast(network)
    form = "part int, n bigint, weights binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A worker keeps the broadcast value for its next task: steps go to a copy.
        net, part, done = copy.deepcopy(shared.value), TaskContext.get().partitionId(), 0
        rng = np.random.default_rng((seed, part))
        at = lambda n: rates[0] + (rates[1] - rates[0]) * min(n / words, 1.0)
        for _, w in scan(batches, ALNUM):
            ids = net.vocabulary(w)
            net.fit(ids, neighbours(ids, w, net.vocabulary.pad), (at(done), at(done + len(ids))), rng)
            done += len(ids)
        if done:
            yield pa.RecordBatch.from_pylist([{"part": part, "n": done, "weights": (net.weights().astype(float) * done).tobytes()}], pa.schema([("part", pa.int32()), ("n", pa.int64()), ("weights", pa.binary())]))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, total = 0, 0, None
        for batch in batches:
            for row in batch.to_pylist():
                mine = np.frombuffer(row["weights"])
                part, n, total = row["part"], n + row["n"], mine if total is None else total + mine
        if n:
            yield pa.RecordBatch.from_pylist([{"part": part, "n": n, "weights": total.tobytes()}], pa.schema([("part", pa.int32()), ("n", pa.int64()), ("weights", pa.binary())]))

    # Added up in a few tasks first, so that the driver gets a few rows, however many tasks there were.
    rows = texts.mapInArrow(run, form).repartition(ADDERS, F.col("part") % ADDERS).mapInArrow(added, form).collect()
    shared.unpersist()
    n = sum(r["n"] for r in rows)
    if n:
        network.set_weights(sum(np.frombuffer(r["weights"]) for r in sorted(rows, key=lambda r: r["part"])) / n)
    return n


def train(docs: DataFrame, *, kept: int = 192, rest: int = 64, shard: int = 200_000, rounds: int = 1, rate: float = 0.4, text_col: str = "text") -> Network | None:
    counts = cut(word_counts(docs, text_col), "words")
    total = counts.agg(F.sum("n")).first()[0]
    if not total:
        return None
    top = counts.orderBy(F.col("n").desc(), "word").limit(kept).collect()
    frequent = [r["word"] for r in top]
    words = np.array(frequent, np.int64).view(U)

    @F.pandas_udf("int")
    def class_of(word: pd.Series) -> pd.Series:
        return pd.Series((mix(word.to_numpy(np.int64).view(U)) % U(rest)).astype(np.int32))

    met = np.zeros(len(words) + rest)
    others = counts.join(F.broadcast(counts.sparkSession.createDataFrame([(w,) for w in frequent], "word bigint")), "word", "left_anti")
    for r in others.groupBy(class_of("word").alias("c")).agg(F.sum("n").alias("n")).collect():
        met[len(words) + r["c"]] = r["n"]
    network = Network(Vocabulary(words, met[len(words) :]))
    network.counts, network.distinct = counts, counts.count()
    by_word = {r["word"]: r["n"] for r in top}
    met[: len(words)] = [by_word[w] for w in network.vocabulary.words.view(np.int64).tolist()]
    network.bias[:] = np.log((met + 1) / (total + len(met)))
    texts = docs.select(F.col(text_col).alias("text"))
    shards = max(1, total // shard)
    # A plan's number of partitions is known without running it; joining some of them moves no rows.
    shards = min(shards, texts.rdd.getNumPartitions())
    texts = texts.coalesce(shards)
    for k in range(rounds):
        falls = tuple(rate * (1 - (k + j) / rounds) + 0.01 for j in (0, 1))
        network.learned = trained_round(texts, network, total / shards, falls, 11 + k)
    return network


def score(docs: DataFrame, network: Network | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, log_prob (natural, summed), mean_log_prob."""
    id_type = docs.schema[id_col].dataType.simpleString()
    if network is None:
        return docs.select(F.col(id_col), F.lit(0).cast("bigint").alias("n_words"), F.lit(0.0).alias("log_prob"), F.lit(None).cast("double").alias("mean_log_prob"))
    shared = docs.sparkSession.sparkContext.broadcast(network)
    n_buckets = max(32, network.distinct // BUCKET_WORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, g = shared.value, TaskContext.get().partitionId() << 32
        for batch, words in scan(batches, ALNUM):
            g += 1
            ids, n = net.vocabulary(words), batch.num_rows
            each = net.log_probs(ids, neighbours(ids, words, net.vocabulary.pad)) + net.vocabulary.share[ids]
            total = np.bincount(words.doc, each, minlength=n).astype(float)
            rare = ids >= len(net.vocabulary.words)
            own, back = np.unique(words.hash[rare], return_inverse=True)
            pair, times = np.unique(back.astype(np.int64) * n + words.doc[rare], return_counts=True)
            held = [np.bincount(pair // n, minlength=len(own)), pair % n, times]
            b = bucket_of(own, n_buckets)
            first = np.flatnonzero(np.diff(b, prepend=-1))
            # Rows of documents, then one that tells whose words are in which documents, then hashes by bucket.
            rows = {
                "g": np.full(n + 1 + len(first), g), "bucket": np.concatenate([np.full(n, DOC), [HELD], b[first]]).astype(np.int32),
                "k": np.concatenate([np.arange(n), np.zeros(1 + len(first))]).astype(np.int32),
            }
            more = 1 + len(first)
            yield pa.RecordBatch.from_arrays([
                *(pa.array(x) for x in rows.values()),
                pa.concat_arrays([batch.column("id"), pa.nulls(more, batch.column("id").type)]),
                pa.concat_arrays([pa.array(words.count, pa.int64()), pa.nulls(more, pa.int64())]),
                pa.concat_arrays([pa.array(total), pa.nulls(more, pa.float64())]),
                pa.concat_arrays([pa.nulls(n, pa.binary()), pa.array([np.concatenate(held).astype("<u4").tobytes()], pa.binary()), blobs(own, np.append(first, len(own)))]),
            ], names=["g", "bucket", "k", "id", "n_words", "log_prob", "data"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = cut(picked.mapInArrow(run, f"g bigint, bucket int, k int, id {id_type}, n_words bigint, log_prob double, data binary"), "word-scores")
    asked = rows.filter(F.col("bucket") >= 0).select("g", "bucket", "data")
    if network.counts is None:
        counts = docs.sparkSession.createDataFrame([], "bucket int, word bigint, n bigint")
    else:
        place = F.floor(F.shiftrightunsigned("word", 40) * F.lit(n_buckets) / F.lit(1 << 24)).cast("int")
        counts = network.counts.select(place.alias("bucket"), "word", "n")

    def answer(rows: pa.Table, counts: pa.Table) -> pa.Table:
        word, n = counts.column("word").to_numpy().view(U), counts.column("n").to_numpy()
        order = np.argsort(word)
        word, logs = word[order], np.log(n[order])
        out = []
        for data in rows.column("data"):
            mine = np.frombuffer(data.as_buffer(), U)
            slot = np.minimum(np.searchsorted(word, mine), max(len(word) - 1, 0))
            out.append((np.where(word[slot] == mine, logs[slot], 0.0) if len(word) else np.zeros(len(mine))).tobytes())
        return pa.table({"g": rows.column("g"), "bucket": rows.column("bucket"), "logs": pa.array(out, pa.binary())})

    answers = asked.groupBy("bucket").cogroup(counts.groupBy("bucket")).applyInArrow(answer, "g bigint, bucket int, logs binary")

    def whole(rows: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("bucket")
        logs = np.concatenate([np.zeros(0), *(np.frombuffer(x.as_buffer()) for x in answers.column("logs"))])
        held = rows.filter(pc.equal(rows.column("bucket"), HELD)).column("data")[0].as_buffer()
        docs = rows.filter(pc.equal(rows.column("bucket"), DOC))
        held = np.frombuffer(held, "<u4")
        runs, pairs = held[: len(logs)], held[len(logs) :]
        doc, times = pairs[: len(pairs) // 2], pairs[len(pairs) // 2 :]
        more = np.bincount(doc.astype(np.int64), np.repeat(logs, runs) * times, minlength=docs.num_rows)
        count = docs.column("n_words").to_numpy()
        total = docs.column("log_prob").to_numpy() + more[docs.column("k").to_numpy()]
        mean = pa.array(total / np.maximum(count, 1), mask=count == 0)
        return pa.table({id_col: docs.column("id"), "n_words": pa.array(count), "log_prob": pa.array(total), "mean_log_prob": mean})

    by_block = rows.filter(F.col("bucket") < 0).groupBy("g")
    return by_block.cogroup(answers.groupBy("g")).applyInArrow(whole, f"`{id_col}` {id_type}, n_words bigint, log_prob double, mean_log_prob double")


@query("op9_pseudo_likelihood")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs))
