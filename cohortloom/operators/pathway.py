"""Rank-based single-sample pathway scores and their reference distributions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.operators.skew import SLICE_ROWS, hot_keys, ranked, running

ALPHA = 0.25
# Immune receptor gene biotypes scored next to protein_coding.
IMMUNE_RECEPTOR_TYPES = (
    "IG_V_gene", "IG_C_gene", "IG_D_gene", "IG_J_gene",
    "TR_V_gene", "TR_C_gene", "TR_D_gene", "TR_J_gene",
)


def gene_universe(
    df: DataFrame,
    gene_id: str = "gene_id",
    gene_type: str = "gene_type",
    kept: tuple[str, ...] = ("protein_coding", *IMMUNE_RECEPTOR_TYPES),
    excluded_mark: str = "PAR_Y",
) -> DataFrame:
    return df.filter(F.col(gene_type).isin(*kept) & ~F.col(gene_id).contains(excluded_mark))


def expr_matrix_long(
    expr: DataFrame, axis: DataFrame, sample: str, symbol: str, value: str
) -> DataFrame:
    """Duplicate symbols collapse to their maximum; symbols off the axis are dropped."""
    best = expr.groupBy(sample, symbol).agg(F.max(value).alias(value))
    return best.join(axis, symbol)


def average_rank(
    df: DataFrame, sample: str, value: str, name: str = "avg_rank", slice_rows: int = SLICE_ROWS,
    hot: list[tuple] | None = None,
) -> DataFrame:
    """Ascending rank per sample, values equal in single precision sharing their mean rank."""
    if hot is None:
        hot = hot_keys(df, [sample], slice_rows)
    if not hot:
        # Rank and tie count read one sort: ties are the current row's peers.
        w = Window.partitionBy(sample).orderBy(F.col(value).cast("float"))
        ties = F.count(F.lit(1)).over(w.rangeBetween(Window.currentRow, Window.currentRow))
        return df.withColumn(name, F.rank().over(w) + (ties - 1) / 2.0)
    hist = df.groupBy(sample, F.col(value).cast("float").alias("__f")).agg(F.count(F.lit(1)).alias("__c"))
    cum = running(hist, [sample], [F.col("__f")], {"__cum": F.col("__c")}, slice_rows)
    ranks = cum.select(
        F.col(sample).alias("__s"),
        F.col("__f").alias("__v"),
        (F.col("__cum") - F.col("__c") + (F.col("__c") + 1) / 2.0).alias(name),
    )
    return df.join(ranks, (F.col(sample) == F.col("__s")) & F.col(value).cast("float").eqNullSafe(F.col("__v"))).drop("__s", "__v")


def ssgsea_scores(
    expr: DataFrame,
    sets: DataFrame,
    sample: str = "sample_id",
    gene: str = "gene_id",
    value: str = "value",
    gene_order: str = "gene_id",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Raw enrichment score per (sample, pathway), in closed form.

    With ``q`` a gene's ascending position (ties: later genes first) and
    ``w = trunc(rank) ** 0.25``, a set of ``k`` out of ``n`` genes scores
    ``sum(w q)/sum(w) - (n(n+1)/2 - sum(q)) / (n - k)``. Values are compared in single
    precision, as expression tables store them. ``gene_order`` may be of any type with an
    order; text ids are numbered first.
    """
    later = F.col(gene_order)
    if dict(expr.dtypes)[gene_order] in ("string", "binary", "date", "timestamp"):
        places = ranked(expr.select(F.col(gene_order).alias("__id")).distinct(), [], [F.col("__id")], "__place")
        expr = expr.join(places, F.col(gene_order) == F.col("__id")).drop("__id")
        later = F.col("__place")
    hot = hot_keys(expr, [sample], slice_rows)
    # Mean ranks of different values are at least 1 apart, so truncation keeps the
    # order: positions by rank are positions by value. Placing the genes first lets
    # ranks and the gene count reuse that sort and its partitioning.
    pos = ranked(expr, [sample], [F.col(value).cast("float"), -later], "__q", slice_rows, hot)
    pos = average_rank(pos, sample, value, "__r", slice_rows, hot).withColumn("__r", F.floor("__r"))
    if not hot:
        pos = pos.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(sample)))
    w = F.pow(F.abs(F.col("__r")).cast("double"), F.lit(ALPHA))
    sums = (
        pos.join(sets.select(gene, "pathway"), gene)
        .groupBy(sample, "pathway")
        .agg(
            F.sum(w * F.col("__q")).alias("wq"),
            F.sum(w).alias("w"),
            F.sum("__q").alias("q"),
            F.count(F.lit(1)).alias("k"),
            *([] if hot else [F.max("__n").alias("__n")]),
        )
    )
    if hot:
        sums = sums.join(expr.groupBy(sample).agg(F.count(F.lit(1)).alias("__n")), sample)
    n = F.col("__n").cast("double")
    score = F.col("wq") / F.col("w") - F.try_divide(n * (n + 1) / 2 - F.col("q"), n - F.col("k"))
    return sums.select(sample, "pathway", F.col("k").alias("n_genes"), score.alias("score_raw"))


def map_gene_sets(
    sets: DataFrame, genes: DataFrame, gene: str, minimum: int, maximum: int
) -> DataFrame:
    """Distinct members, how many the gene axis has, and whether the set is scored."""
    # Members become distinct before the set size is counted: no set-sized state per task.
    members = sets.select("pathway", gene).distinct()
    hit = members.join(
        genes.select(F.col(gene).alias("__g")).distinct(), F.col(gene) == F.col("__g"), "left"
    )
    g = hit.groupBy("pathway").agg(F.count(F.lit(1)).alias("members"), F.count("__g").alias("matched"))
    return g.withColumn("fraction", F.round(F.col("matched") / F.col("members"), 6)).withColumn(
        "kept", F.col("matched").between(minimum, maximum)
    )


#: Buckets of a value's logarithm, for each factor of e: a bucket spans half a percent.
BUCKETS_PER_E = 200


def _bucket(v: Column) -> Column:
    """A whole number that never falls as ``v`` rises."""
    step = lambda x: F.floor(F.log1p(x) * BUCKETS_PER_E)
    return F.when(v >= 0, step(v)).otherwise(-1 - step(-v))


def score_stats(
    scores: DataFrame, project: str, sample_type: str, pathway: str, value: str, pan: str = "pan", every: str = "all",
) -> DataFrame:
    """Reference distribution per (population, sample type or all, pathway).

    Scores are read once, into a histogram of (project, type, pathway, value). It is summed by value bucket, and
    GROUPING SETS merge the buckets of all four kinds of populations; the moments are their sums, taken
    from the pathway's smallest score. A quantile lies in the bucket where the running count
    passes its place; only those buckets are read again by value. No group is held by a task:
    running counts go over a group's buckets, or the values of one bucket.
    """
    hist = (
        scores.select(F.col(project).alias("__p"), F.col(sample_type).alias("__t"), F.col(pathway).alias("__g"), F.col(value).cast("double").alias("v"))
        .filter(F.col("v").isNotNull()).groupBy("__p", "__t", "__g", "v").agg(F.count(F.lit(1)).alias("c"))
    )
    base = hist.groupBy(F.col("__g").alias("__b")).agg(F.min("v").alias("base"))
    hist = hist.join(base, F.col("__g").eqNullSafe(F.col("__b"))).drop("__b").withColumn("b", _bucket(F.col("v")))
    off = F.col("v") - F.col("base")
    cells = hist.groupBy("__p", "__t", "__g", "b").agg(
        F.sum("c").alias("n"), F.sum(F.col("c") * off).alias("s1"), F.sum(F.col("c") * off * off).alias("s2"),
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.max("base").alias("base"),
    )
    kinds = [["__p", "__t", "__g", "b"], ["__p", "__g", "b"], ["__t", "__g", "b"], ["__g", "b"]]
    merged = cells.groupingSets(kinds, "__p", "__t", "__g", "b").agg(
        F.grouping("__p").alias("any_p"), F.grouping("__t").alias("any_t"), F.sum("n").alias("n"), F.sum("s1").alias("s1"), F.sum("s2").alias("s2"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("base").alias("base"),
    )
    group = ["population", "type", "pathway"]
    merged = merged.select(
        F.when(F.col("any_p") == 1, pan).otherwise(F.col("__p")).alias("population"),
        F.when(F.col("any_t") == 1, every).otherwise(F.col("__t")).alias("type"), F.col("__g").alias("pathway"), "b", "n", "s1", "s2", "lo", "hi", "base",
    )
    whole = Window.partitionBy(*group)
    merged = merged.withColumn("total", F.sum("n").over(whole)).withColumn("upto", F.sum("n").over(whole.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)))
    # Places of the quartiles, from 0: both neighbours of q * (n - 1).
    place = lambda q: F.lit(q) * (F.col("total") - 1)
    ends = [(name, f, g(place(q)).cast("bigint")) for name, q in (("q25", 0.25), ("median", 0.5), ("q75", 0.75)) for f, g in (("low", F.floor), ("high", F.ceil))]
    wanted = F.array(*[F.struct(F.lit(f"{name}_{f}").alias("which"), k.alias("k")) for name, f, k in ends])
    begun = F.col("upto") - F.col("n")
    inside = merged.withColumn("w", F.explode(F.filter(wanted, lambda x: (x["k"] >= begun) & (x["k"] < F.col("upto")))))
    targets = inside.select(*group, "b", F.col("w.which").alias("which"), (F.col("w.k") - begun).alias("k"))
    keys = [F.col(c).alias(f"__{c}") for c in group]
    values = hist.select(
        F.explode(F.array(F.col("__p"), F.lit(pan))).alias("population"), "__t", F.col("__g").alias("pathway"), "b", "v", "c"
    ).select("population", F.explode(F.array(F.col("__t"), F.lit(every))).alias("type"), "pathway", "b", "v", "c")
    asked = targets.groupBy(*keys, F.col("b").alias("__b")).agg(F.collect_list(F.struct("which", "k")).alias("ask"))
    same = F.col("b") == F.col("__b")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    values = values.join(asked, same).groupBy(*group, "b", "v").agg(F.sum("c").alias("c"), F.any_value("ask").alias("ask"))
    upto = Window.partitionBy(*group, "b").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    values = values.withColumn("upto", F.sum("c").over(upto))
    hit = values.withColumn("a", F.explode(F.filter("ask", lambda x: (x["k"] < F.col("upto")) & (x["k"] >= F.col("upto") - F.col("c")))))
    found = hit.groupBy(*keys).agg(*[F.max(F.when(F.col("a.which") == f"{name}_{f}", F.col("v"))).alias(f"{name}_{f}") for name, f, _ in ends])
    n, s1 = F.sum("n"), F.sum("s1")
    spread = F.greatest(F.lit(0.0), F.sum("s2") - s1 * s1 / n)
    plain = merged.groupBy(*group).agg(
        n.alias("n"), (F.max("base") + s1 / n).alias("mean"), F.when(n > 1, F.sqrt(spread / (n - 1))).alias("sd"), F.min("lo").alias("min"), F.max("hi").alias("max")
    )
    match = F.lit(True)
    for c in group:
        match = match & F.col(c).eqNullSafe(F.col(f"__{c}"))
    both = plain.join(found, match)

    def between(name: str, q: float) -> Column:
        p = F.lit(q) * (F.col("n") - 1)
        low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
        return (low + (p - F.floor(p)) * (high - low)).alias(name)

    return both.select(
        "population", "type", F.col("pathway").alias(pathway), between("q25", 0.25), between("median", 0.5), between("q75", 0.75), "n", "mean", "sd", "min", "max"
    )


def normalize_global(scores: DataFrame, value: str, name: str = "score") -> DataFrame:
    """Divide by the range over all scores; a degenerate range is refused."""
    span = scores.agg((F.max(value) - F.min(value)).alias("span"))
    checked = span.select(
        F.when(F.col("span") > 0, F.col("span")).otherwise(
            F.raise_error(F.lit("score range is zero")).cast("double")
        ).alias("span")
    )
    return scores.withColumn(name, F.col(value) / checked.scalar())


def zscore(scores: DataFrame, stats: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Distance from the reference mean in reference standard deviations."""
    ref = stats.select(*keys, "mean", "sd")
    z: Column = F.try_divide(F.col(value) - F.col("mean"), F.col("sd"))
    return scores.join(ref, keys).withColumn("z", z)


#: Memberships sent to the tasks at once, 4 bytes each; more sets are scored in further passes.
MEMBERSHIPS = 5_000_000
#: Scores a task hands over at once.
ROWS_OUT = 50_000


class SetBlock:
    """Gene sets as places on the axis, end to end."""

    def __init__(self, names: list, members: list, n_axis: int):
        self.names, self.n_axis = names, n_axis
        self.first = np.cumsum([0, *map(len, members)])[:-1]
        self.places = np.concatenate([np.zeros(0, np.int64), *[np.sort(np.asarray(m, np.int64)) for m in members]])
        self.size = np.array([len(m) for m in members], np.int64)
        # Places in one rising order over all sets, and each set's sum of the axis genes after its members.
        self.begin = np.arange(len(names), dtype=np.int64) * n_axis
        self.keys = self.places + np.repeat(self.begin, self.size)
        self.after = np.add.reduceat(n_axis - 1 - self.places, self.first) if names else np.zeros(0, np.int64)

    def scores(self, place: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Raw score of every set for one sample that has ``value`` at ``place``; the axis' other genes are 0.

        The genes a sample lacks are one block of ties with its zeros: they share a rank, and a gene's position in the block is
        the number of axis genes after it less the non-zero ones, so they are never listed. Where the sets
        have more members than the sample has pairs of a set and a non-zero gene, members are not listed either: their sums are taken
        over the sets, less what the sample's own genes take away.
        """
        order = np.argsort(place)
        place, value = place[order], value[order].astype(np.float32)
        n, m = self.n_axis, len(place)
        lacking, below, zeros = n - m, int((value < 0).sum()), int((value == 0).sum())
        nonzero = place[value != 0]
        later = lambda p: (n - 1 - p) - (len(nonzero) - np.searchsorted(nonzero, p, "right"))
        by_value = np.lexsort((-place, value))
        q = np.empty(m, np.int64)
        q[by_value] = np.arange(1, m + 1)
        _, group, size = np.unique(value, return_inverse=True, return_counts=True)
        rank = (np.cumsum(size) - (size - 1) / 2)[group]
        rank, q = np.where(value > 0, rank + lacking, rank), np.where(value > 0, q + lacking, q)
        tie = below + (zeros + lacking + 1) / 2
        rank, q = np.where(value == 0, tie, rank), np.where(value == 0, below + 1 + later(place), q)
        if len(self.names) * len(nonzero) < len(self.places):
            own = value != 0
            return self._by_own_genes(nonzero, q[own], np.floor(rank[own]) ** ALPHA, below + 1, np.floor(tie) ** ALPHA)
        at = np.minimum(np.searchsorted(place, self.places), max(m - 1, 0))
        has = place[at] == self.places if m else np.zeros(len(self.places), bool)
        some = lambda own, other: np.where(has, own[at] if m else 0, other)
        q = some(q, below + 1 + later(self.places))
        w = np.floor(some(rank, tie)) ** ALPHA
        total = lambda x: np.add.reduceat(x.astype(np.float64), self.first)
        return self._score(total(w * q), total(w), total(q))

    def _by_own_genes(self, place: np.ndarray, q: np.ndarray, w: np.ndarray, least: int, tied: float) -> np.ndarray:
        """The same from the sample's non-zero genes; the block of ties begins at position ``least`` with weight ``tied``."""
        n, m = self.n_axis, len(place)
        asked = self.begin[:, None] + place
        at = np.searchsorted(self.keys, asked)
        member = self.keys[np.minimum(at, len(self.keys) - 1)] == asked
        # Pairs of a member and a non-zero gene after it, by the gene; those of two non-zero genes are no pairs of the block.
        pairs = (at - self.first[:, None]).sum(axis=1) - member @ np.arange(m - 1, -1, -1)
        others = self.size - member.sum(axis=1)
        block = others * least + self.after - member @ (n - 1 - place) - pairs
        return self._score(member @ (w * q) + tied * block, member @ w + tied * others, member @ q + block)

    def _score(self, wq: np.ndarray, w: np.ndarray, q: np.ndarray) -> np.ndarray:
        n = self.n_axis
        rest = (n - self.size).astype(np.float64)
        return wq / w - np.divide(n * (n + 1) / 2 - q, rest, out=np.full(len(rest), np.nan), where=rest > 0)


def ssgsea_scores_on_axis(
    expr: DataFrame, axis: DataFrame, sets: DataFrame, sample: str = "sample_id", gene: str = "gene_id", value: str = "value",
    gene_order: str = "gene_id", memberships: int = MEMBERSHIPS, slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Raw enrichment score per (sample, pathway) over all genes of ``axis``; a gene without a value counts as 0.

    Genes off the axis are dropped, several values of a gene collapse to their maximum, missing values are no values.
    ``axis`` holds each gene once, ordered by ``gene_order``. A sample's row is bounded by the axis; no gene x sample
    product is built. Sets go to the tasks in blocks of ``memberships`` entries at most (or one set).
    """
    spark = expr.sparkSession
    placed = ranked(axis.select(F.col(gene).alias("__g"), F.col(gene_order).alias("__o")), [], [F.col("__o")], "__place", slice_rows)
    placed = placed.select("__g", (F.col("__place") - 1).alias("place"))
    n_axis = axis.count()
    v = F.col(value).cast("float")
    rows = expr.filter(v.isNotNull() & ~F.isnan(v)).groupBy(sample, gene).agg(F.max(v).alias("v")).join(placed, F.col(gene) == F.col("__g"))
    rows = rows.groupBy(sample).agg(F.collect_list("place").alias("places"), F.collect_list("v").alias("values"))
    members = sets.select("pathway", gene).distinct().join(placed, F.col(gene) == F.col("__g"))
    members = members.groupBy("pathway").agg(F.collect_list("place").alias("members"))
    n_blocks = max(1, -(-int(members.agg(F.coalesce(F.sum(F.size("members")), F.lit(0))).first()[0]) // memberships))
    kind = dict(expr.dtypes)[sample]
    names = dict(sets.dtypes)["pathway"]
    out = None
    for k in range(n_blocks):
        block = members.filter(F.pmod(F.xxhash64("pathway"), F.lit(n_blocks)) == k).collect()
        if not block and n_blocks > 1:
            continue
        sent = spark.sparkContext.broadcast(SetBlock([r.pathway for r in block], [r.members for r in block], n_axis))

        def run(batches, sent=sent):
            sets_ = sent.value
            k = len(sets_.names)
            step = max(1, ROWS_OUT // max(k, 1))
            for pdf in batches:
                for i in range(0, len(pdf) if k else 0, step):
                    some = pdf.iloc[i:i + step]
                    scored = [sets_.scores(np.asarray(p), np.asarray(v)) for p, v in zip(some["places"], some["values"], strict=True)]
                    yield pd.DataFrame({sample: some[sample].repeat(k).array, "pathway": sets_.names * len(some), "n_genes": np.tile(sets_.size, len(some)), "score_raw": np.concatenate(scored)})

        part = rows.mapInPandas(run, f"`{sample}` {kind}, pathway {names}, n_genes bigint, score_raw double")
        out = part if out is None else out.unionAll(part)
    return out.withColumn("score_raw", F.when(~F.isnan("score_raw"), F.col("score_raw")))
