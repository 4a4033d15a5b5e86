"""Language identification by prediction by partial matching.

For each language a variable-order byte model is counted: contexts of three bytes down to none,
with escapes by method C (a context seen n times with q different followers gives c/(n + q) to a
follower seen c times and q/(n + q) to an escape) and full exclusion; below all orders bytes are
uniform. Counts are frozen after training, so the code length of every follower in every context
is a table, and a text is scored with one look-up per byte for all languages at once, whatever its
length. The language with the shortest code wins.

Training reads a bounded sample of the labelled rows: about ``sample_docs`` documents of each
language, chosen by a hash of their ids, each whole. The model's size depends on that bound only.
Contexts met fewer than ``min_count`` times in every language are left to their shorter ones.

A null text, or one without a letter, is ``und`` with score 0. Otherwise the score is the
probability of the chosen language, all being equally likely beforehand. Ties go to the first name
in order. Without any labelled row all texts are ``und``. Rows with null ids never train and are
not held out. Repeated rows get the same answer each.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.common import blocks, text_bytes
from cohortloom.llm.registry import query, table

ORDER, SPACE = 3, 0x20
#: Bits by which a text may exceed the limit of its language, whatever its length.
SPARE = 64


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


LOTS = 1 << 53


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with three blanks before each text, and where each byte of the texts now is."""
    n = np.diff(offsets)
    at = np.arange(len(data)) + ORDER * (np.repeat(np.arange(len(n)), n) + 1)
    out = np.full(len(data) + ORDER * len(n), SPACE, np.uint8)
    out[at] = data
    return out, at


def gram_counts(docs: DataFrame, *, sample_docs: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(lang, gram, n): four-byte grams of the training sample, a gram being a big-endian number.

    Languages are counted first; their shares, a number for each column of the model, go to the scan, which picks texts
    by the hash of their id. No text is shuffled.
    """
    rows = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    sizes = rows.groupBy(F.col(lang_col).alias("name")).agg(F.count("*").alias("n")).collect()
    # Lots are fine enough for any number of rows: a whole long of lots would not fit a double.
    below = {r["name"]: min(LOTS, int(LOTS * sample_docs / r["n"])) for r in sizes}
    lot = F.pmod(F.xxhash64(id_col), F.lit(LOTS))
    limit = F.try_element_at(F.from_json(F.lit(json.dumps(below)), "map<string,bigint>"), F.col(lang_col))
    picked = rows.filter(lot < limit).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in sorted(set(langs)):
                data, offsets = text_bytes(pc.filter(batch.column("text"), pa.array(langs == lang)))
                for lo, hi in blocks(offsets):
                    b, at = _padded(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                    b = b.astype(np.int64)
                    gram, n = np.unique(b[at - 3] << 24 | b[at - 2] << 16 | b[at - 1] << 8 | b[at], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    return picked.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Code lengths in bits: ``cost[state, symbol]`` holds one for each language.

    ``symbol`` maps bytes to classes (the last class: bytes never seen); ``state`` maps three classes
    to the longest context that the model keeps.
    """

    def __init__(self, langs: list[str], grams: np.ndarray, counts: np.ndarray, lang_of: np.ndarray, min_count: int):
        self.langs = langs
        parts = np.stack([grams >> s & 255 for s in (24, 16, 8, 0)], axis=1)
        seen = np.unique(np.append(parts.ravel(), SPACE))
        self.size = a = len(seen) + 1
        self.symbol = np.full(256, a - 1, np.int64)
        self.symbol[seen] = np.arange(a - 1)
        c = self.symbol[parts]
        keys, self.state = [np.zeros(1, np.int64)], np.zeros(a**3, np.int32)
        context = {k: sum((c[:, 3 - k + j] * a ** (k - 1 - j) for j in range(k)), np.zeros(len(c), np.int64)) for k in range(1, ORDER + 1)}
        first = [0]
        for k in range(1, ORDER + 1):
            most = np.zeros(a**k, np.int64)
            for lang in range(len(langs)):
                most = np.maximum(most, np.bincount(context[k][lang_of == lang], counts[lang_of == lang], minlength=a**k).astype(np.int64))
            keys.append(np.flatnonzero(most >= (1 if k < 2 else min_count)))
            first.append(first[-1] + len(keys[k - 1]))
            by_suffix = self.state.reshape(-1, a**k)
            by_suffix[:, keys[k]] = first[k] + np.arange(len(keys[k]))
        n_states = first[-1] + len(keys[-1])
        self.cost = np.empty((n_states, a, len(langs)), np.float32)
        for lang in range(len(langs)):
            mine = lang_of == lang
            ctx, sym, n = {k: v[mine] for k, v in context.items()}, c[mine, 3], counts[mine]
            ctx[0] = np.zeros(len(sym), np.int64)
            tables = {k: _followers(ctx[k], sym, n, keys[k], a) for k in range(ORDER + 1)}
            for k in range(ORDER + 1):
                for lo in range(0, len(keys[k]), 4096):
                    own = keys[k][lo : lo + 4096]
                    chain = [tables[j][np.searchsorted(keys[j], own % a**j)] * np.isin(own % a**j, keys[j])[:, None] for j in range(k, -1, -1)]
                    self.cost[first[k] + lo : first[k] + lo + len(own), :, lang] = _code_lengths(chain)
        self.cost = self.cost.reshape(n_states * a, len(langs))

    def bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(texts x languages) code lengths."""
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        some = np.flatnonzero(np.diff(offsets))
        if len(some):
            b, at = _padded(data, offsets)
            c, a = self.symbol[b], self.size
            state = self.state[(c[at - 3] * a + c[at - 2]) * a + c[at - 1]].astype(np.int64)
            out[some] = np.add.reduceat(self.cost[state * a + c[at]], offsets[some], axis=0)
        return out


def _followers(ctx: np.ndarray, sym: np.ndarray, n: np.ndarray, keys: np.ndarray, a: int) -> np.ndarray:
    """(contexts x symbols) counts; one more row of zeros for contexts that are not kept."""
    row = np.searchsorted(keys, ctx)
    ok = row < len(keys)
    ok[ok] = keys[row[ok]] == ctx[ok]
    return np.bincount(row[ok] * a + sym[ok], n[ok], minlength=(len(keys) + 1) * a).reshape(len(keys) + 1, a).astype(np.float32)


def _code_lengths(chain: list[np.ndarray]) -> np.ndarray:
    """Bits of every symbol, given the followers' counts from the longest context to the empty one."""
    left = np.ones(len(chain[0]))
    p = np.zeros(chain[0].shape)
    out = np.zeros(chain[0].shape, bool)
    for counts in chain:
        c = np.where(out, 0, counts)
        n, q = c.sum(axis=1), (c > 0).sum(axis=1)
        total = np.maximum(n + q, 1)
        p += (left / total)[:, None] * c
        left = np.where(q > 0, left * q / total, left)
        out |= c > 0
    rest = left / (256 - out.sum(axis=1))
    return -np.log2(np.where(out, p, rest[:, None]))


def train(docs: DataFrame, *, sample_docs: int = 500, min_count: int = 8, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    rows = gram_counts(docs, sample_docs=sample_docs, id_col=id_col, text_col=text_col, lang_col=lang_col).toPandas()
    if rows.empty:
        return None
    langs = sorted(rows["lang"].unique())
    return Model(langs, rows["gram"].to_numpy(), rows["n"].to_numpy(), rows["lang"].map({v: k for k, v in enumerate(langs)}).to_numpy(), min_count)


def _bits(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(texts x languages) code lengths, and bytes of each text."""
    data, offsets = text_bytes(texts)
    bits = [model.bits(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]) for lo, hi in blocks(offsets)]
    return np.concatenate(bits or [np.zeros((0, len(model.langs)))]), np.diff(offsets)


def _judged(model: Model, texts: pa.Array, letters: np.ndarray) -> tuple[list[str], np.ndarray]:
    bits, _ = _bits(model, texts)
    best = bits.argmin(axis=1)
    score = 1 / np.exp2(np.clip(bits.min(axis=1)[:, None] - bits, -1000, 0)).sum(axis=1)
    return [model.langs[b] if ok else "und" for b, ok in zip(best, letters, strict=True)], np.where(letters, score, 0.0)


def has_letter(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score. A map: the model is broadcast, texts are not shuffled."""
    id_type = docs.schema[id_col].dataType.simpleString()
    if model is None:
        return docs.select(F.col(id_col), F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score = _judged(shared.value, batch.column("text"), batch.column("letter").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(lang, pa.string()), pa.array(score)], names=[id_col, "lang_pred", "score"])

    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), has_letter(text_col).alias("letter"))
    return picked.mapInArrow(run, f"`{id_col}` {id_type}, lang_pred string, score double")


def limits(docs: DataFrame, model: Model | None, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, float]:
    """Bits a byte that a text of each language needs at most, far outliers left out.

    From all labelled texts that the model did not learn from, each coded in its own language: the
    third quartile plus three times the distance of the quartiles, or plus 1 where that is more. A
    language without such a text has no limit.
    """
    if model is None:
        return {}
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = {x: k for k, x in enumerate(model.langs)}
    rows = docs.filter(held_out(id_col) & F.col(lang_col).isin(model.langs) & has_letter(text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, n = _bits(shared.value, batch.column("text"))
            own = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(bits[np.arange(len(own)), own] / n)], names=["lang", "rate"])

    rates = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInArrow(run, "lang string, rate double")
    found = rates.groupBy("lang").agg(F.percentile_approx("rate", [0.25, 0.75]).alias("q")).collect()
    return {r["lang"]: r["q"][1] + max(3 * (r["q"][1] - r["q"][0]), 1.0) for r in found}


def keep_identified(docs: DataFrame, model: Model | None, *, wanted: list[str] | None = None, most: dict[str, float] | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose language is ``und`` or, if ``wanted`` is given, not among those; columns stay.

    With ``most`` (see ``limits``), rows go as well whose shortest code is ``SPARE`` bits or more above
    the limit of its language: texts in no learned language. Short texts thus stay. Without a model nothing was
    learned, and every row with a letter stays.
    """
    if model is None:
        return docs.filter(has_letter(text_col))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)
    known = np.array([wanted is None or x in wanted for x in model.langs])
    limit = np.array([(most or {}).get(x, np.inf) for x in model.langs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, n = _bits(shared.value, batch.column(at))
            best = bits.argmin(axis=1)
            yield batch.filter(pa.array(known[best] & (bits.min(axis=1) < limit[best] * n + SPARE)))

    return docs.filter(has_letter(text_col)).mapInArrow(run, docs.schema)


@query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
