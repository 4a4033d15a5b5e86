"""Foreign-key resolution: specimens, pairs, manifests, files index."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.operators.skew import nest, pick_by, ranked


def prefixed(df: DataFrame, prefix: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Rename (and keep only) columns, so that joins stay unambiguous."""
    return df.select(*[F.col(c).alias(prefix + c) for c in (cols or df.columns)])


def lookup(
    df: DataFrame, dim: DataFrame, on: str, dim_key: str, take: dict[str, str], how: str = "left"
) -> DataFrame:
    """Add ``take`` = {dim column: new name} from the dimension row with equal key."""
    d = dim.select(F.col(dim_key).alias("__dk"), *[F.col(c).alias(n) for c, n in take.items()])
    return df.join(d, F.col(on) == F.col("__dk"), how).drop("__dk")


def attach_records(
    cases: DataFrame,
    records: DataFrame,
    key: str,
    order: Sequence[Column],
    fields: Sequence[str],
    name: str,
    page_rows: int | None = None,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Nest records under their case; a case without any gets an empty array.

    With ``page_rows`` a case comes in pages, told apart by ``page`` and ``offset``.
    """
    nested = prefixed(nest(records, [key], order, fields, name, page_rows, count_on=count_on), "__n_")
    j = cases.join(nested, F.col(key) == F.col(f"__n_{key}"), "left")
    empty = F.expr(f"CAST(array() AS {dict(nested.dtypes)['__n_' + name]})")
    places = [] if page_rows is None else ["page", "offset"]
    return j.select(
        *cases.columns,
        *[F.coalesce(f"__n_{p}", F.lit(0).cast("bigint")).alias(p) for p in places],
        F.coalesce(F.col("__n_" + name), empty).alias(name),
    )


def fallback_pair(
    df: DataFrame, dim: DataFrame, dim_key: str, first: str, second: str, take: dict[str, str]
) -> DataFrame:
    """Resolve by ``first``, else by ``second``; all taken columns from one dim row."""
    flagged = dim.withColumn("__hit", F.lit(True))
    a = lookup(df, flagged, first, dim_key, {"__hit": "__hit", **{c: f"__a_{n}" for c, n in take.items()}})
    b = lookup(a, dim, second, dim_key, {c: f"__b_{n}" for c, n in take.items()})
    hit = F.col("__hit").isNotNull()
    out = {n: F.when(hit, F.col(f"__a_{n}")).otherwise(F.col(f"__b_{n}")) for n in take.values()}
    return b.withColumns(out).select(*df.columns, *take.values())


def single_entity(df: DataFrame, keys: Sequence[str], entity: str, name: str) -> DataFrame:
    """The one distinct entity per key; null when there are several.

    Minimum and maximum agree exactly when there is one, so nothing is collected.
    """
    lo, hi = F.min(entity), F.max(entity)
    return df.groupBy(*keys).agg(F.when(lo == hi, lo).alias(name))


def only_item(ids: Column) -> Column:
    """The element of a one-element array (after removing repeats), else null."""
    d = F.array_distinct(ids)
    return F.when(F.size(d) == 1, d[0])


def paired_normal(ids: Column, tumor: Column) -> Column:
    """The one other id beside the tumour's, else null."""
    other = F.array_except(ids, F.array(tumor))
    return F.when(F.size(other) == 1, other[0])


def unordered_pair(a: Column, b: Column) -> Column:
    """A key equal for (a, b) and (b, a)."""
    return F.array_sort(F.array(a, b))


def unordered_pair_join(
    df: DataFrame, pairs: DataFrame, same: str, left: tuple[str, str], right: tuple[str, str], take: Sequence[str]
) -> DataFrame:
    """Inner equi-join on (``same``, unordered pair)."""
    l = df.withColumns(
        {"__lo": F.least(*left), "__hi": F.greatest(*left)}
    )
    r = pairs.select(
        F.col(same).alias("__s"), F.least(*right).alias("__rlo"), F.greatest(*right).alias("__rhi"), *take
    )
    on = (F.col(same) == F.col("__s")) & (F.col("__lo") == F.col("__rlo")) & (F.col("__hi") == F.col("__rhi"))
    return l.join(r, on).drop("__s", "__lo", "__hi", "__rlo", "__rhi")


def merge_by_key(left: DataFrame, right: DataFrame, key: str, prefer: str = "right") -> DataFrame:
    """Full outer join; a column on both sides takes the preferred side's value first."""
    r = prefixed(right, "__r_")
    j = left.join(r, F.col(key) == F.col(f"__r_{key}"), "full")
    out = [F.coalesce(F.col(key), F.col(f"__r_{key}")).alias(key)]
    for c in [*left.columns, *[c for c in right.columns if c not in left.columns]]:
        if c == key:
            continue
        if c in left.columns and c in right.columns:
            pair = [F.col(f"__r_{c}"), F.col(c)]
            out.append(F.coalesce(*(pair if prefer == "right" else pair[::-1])).alias(c))
        else:
            out.append((F.col(c) if c in left.columns else F.col(f"__r_{c}")).alias(c))
    return j.select(*out)


def require_both_or_neither(left: DataFrame, right: DataFrame) -> None:
    """Exactly one empty half means a truncated fetch; refuse it."""
    a, b = left.isEmpty(), right.isEmpty()
    if a != b:
        raise ValueError(f"the {'left' if a else 'right'} half is empty, the other is not")


def curated_join(df: DataFrame, curated: DataFrame, key: str, take: Sequence[str], complete: Column) -> DataFrame:
    """Left join with the audit flags ``matched`` and ``complete``."""
    c = prefixed(curated, "__c_", [key, *take])
    j = df.join(c, F.col(key) == F.col(f"__c_{key}"), "left")
    matched = F.col(f"__c_{key}").isNotNull()
    j = j.select(*df.columns, matched.alias("matched"), *[F.col(f"__c_{c}").alias(c) for c in take])
    return j.withColumn("complete", F.coalesce(complete, F.lit(False)))


def clause_column(clause: dict) -> Column:
    """Compile a nested ``{op, content}`` filter (``=``, ``in``, ``and``) to a predicate."""
    op, content = clause["op"], clause["content"]
    if op == "and":
        return reduce(lambda a, b: a & b, [clause_column(c) for c in content])
    field, value = F.col(content["field"]), content["value"]
    if op == "=":
        return field == (value[0] if isinstance(value, list) else value)
    if op == "in":
        return field.isin(*value)
    raise ValueError(f"unknown filter operator {op!r}")


def rule_join(df: DataFrame, rules: DataFrame, on: str, wildcards: Sequence[str]) -> DataFrame:
    """Rows meeting a rule of their ``on`` value; a null rule attribute matches anything."""
    r = prefixed(rules, "__r_")
    cond = F.col(on) == F.col(f"__r_{on}")
    for w in wildcards:
        cond = cond & (F.col(f"__r_{w}").isNull() | (F.col(f"__r_{w}") == F.col(w)))
    return df.join(r, cond, "left_semi")


def manifest_walk(manifest: DataFrame, listing: DataFrame, cases: DataFrame, name: str, ids: str, case: str) -> DataFrame:
    """Entries whose bytes are present and that name exactly one known case."""
    present = manifest.join(prefixed(listing, "__l_", [name]), F.col(name) == F.col(f"__l_{name}"), "left_semi")
    one = present.withColumn("__case", only_item(F.col(ids))).filter(F.col("__case").isNotNull())
    known = prefixed(cases, "__c_", [case])
    return one.join(known, F.col("__case") == F.col(f"__c_{case}"), "left_semi").withColumnRenamed("__case", case)


def local_files(manifests: Sequence[DataFrame], key: str, order: Sequence[str], status: str = "status") -> DataFrame:
    """All manifests together, listing-only entries dropped, the last entry per file."""
    every = reduce(
        lambda a, b: a.unionByName(b), [m.withColumn("__src", F.lit(i)) for i, m in enumerate(manifests)]
    )
    real = every.filter(~F.col(status).eqNullSafe("manifest_only"))
    return pick_by(real, [key], [F.col("__src"), *[F.col(c) for c in order]], last=True).drop("__src")


def manifest_status(
    hits: DataFrame, cached: DataFrame, versions: DataFrame, key: str, group: str, maximum: int
) -> DataFrame:
    """Download budget per group: cached files stay, the first free places go to
    uncached hits in key order, the rest are listed only; superseded by version."""
    c = cached.select(F.col(key).alias("__ck")).distinct()
    j = hits.join(c, F.col(key) == F.col("__ck"), "left").withColumn("__hit", F.col("__ck").isNotNull())
    n_cached = j.groupBy(group).agg(F.count_if("__hit").alias("__n")).withColumnRenamed(group, "__g")
    order = ranked(j, [group, "__hit"], [F.col(key)], "__rn")
    room = F.greatest(F.lit(0), F.lit(maximum) - F.col("__n"))
    status = F.when(F.col("__hit"), "cached").when(F.col("__rn") <= room, "downloaded").otherwise("manifest_only")
    out = order.join(n_cached, F.col(group) == F.col("__g")).withColumn("status", status)
    v = versions.select(F.col(key).alias("__vk"), F.col("latest_id").alias("__latest"))
    out = out.join(v, F.col(key) == F.col("__vk"), "left")
    sup = F.coalesce(F.col("__latest") != F.col(key), F.lit(False))
    return out.withColumn("superseded", sup).select(*hits.columns, "status", "superseded")


def files_index(
    listing: DataFrame | None, local: DataFrame, key: str, fill: Sequence[str], table_of: dict[str, str | None],
    modality: str, url: Column,
) -> DataFrame:
    """Spine = the full listing, enriched by the local manifest; null listing values
    fall back to it. Without a listing the local manifest is the spine."""
    spine = local if listing is None else listing
    l = prefixed(local, "__l_", [key, *fill, modality])
    j = spine.drop(modality).join(l, F.col(key) == F.col(f"__l_{key}"), "left")
    own = F.col(f"__l_{modality}")
    pairs = [F.lit(x) for kv in table_of.items() for x in kv]
    table = F.create_map(*pairs)[own]
    return j.select(
        *[F.coalesce(F.col(c), F.col(f"__l_{c}")).alias(c) if c in fill else F.col(c) for c in spine.columns if c != modality],
        F.col(f"__l_{key}").isNotNull().alias("in_dataset"),
        table.alias("dataset_table"),
        url.alias("url"),
    )


def nest_children(
    parents: DataFrame, children: DataFrame, parent_key: str, child_key: str,
    order: Sequence[Column], fields: Sequence[str], name: str, page_rows: int | None = None,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Children as an ordered array column of their parent (see :func:`attach_records`).

    A child whose parent does not exist is an error when its row is reached.
    """
    renamed = children.withColumn(parent_key, F.col(child_key)) if child_key != parent_key else children
    nested = prefixed(nest(renamed, [parent_key], order, fields, name, page_rows, count_on=count_on), "__n_")
    known = parents.withColumn("__known", F.lit(True))
    j = known.join(nested, F.col(parent_key) == F.col(f"__n_{parent_key}"), "full")
    lost = F.concat(F.lit(f"{child_key} refers to a {parent_key} that does not exist: "), F.col(f"__n_{parent_key}").cast("string"))
    checked = lambda c, kind: F.when(F.col("__known").isNull(), F.raise_error(lost).cast(kind)).otherwise(c)
    kinds = dict(nested.dtypes)
    values = {name: F.coalesce(F.col("__n_" + name), F.array().cast(kinds["__n_" + name]))}
    places = {} if page_rows is None else {p: F.coalesce(f"__n_{p}", F.lit(0).cast("bigint")) for p in ("page", "offset")}
    # The guard sits in the key and in every new column, so none can be read without it.
    own = [checked(F.col(c), dict(parents.dtypes)[c]).alias(c) if c == parent_key else F.col(c) for c in parents.columns]
    return j.select(*own, *[checked(v, kinds["__n_" + n]).alias(n) for n, v in {**places, **values}.items()])


def orphans(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    """Children whose parent does not exist."""
    p = prefixed(parents, "__p_", [parent_key])
    return children.join(p, F.col(child_key) == F.col(f"__p_{parent_key}"), "left_anti")


def refuse_orphans(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str) -> None:
    if not orphans(parents, children, parent_key, child_key).isEmpty():
        raise ValueError(f"{child_key} refers to a {parent_key} that does not exist")


def with_provenance(rows: DataFrame, files: DataFrame, file_key: str, take: Sequence[str]) -> DataFrame:
    """Join source-file columns; a row whose file is not in the manifest is an error."""
    f = prefixed(files, "__f_", [file_key, *take])
    j = rows.join(f, F.col(file_key) == F.col(f"__f_{file_key}"), "left")
    known = F.when(
        F.col(f"__f_{file_key}").isNull(),
        F.raise_error(F.concat(F.lit("file not in manifest: "), F.col(file_key).cast("string"))).cast("string"),
    )
    # The guard sits in a taken column, so it is evaluated for every row kept.
    return j.select(
        *rows.columns,
        *[F.coalesce(known.cast(dict(files.dtypes)[c]), F.col(f"__f_{c}")).alias(c) for c in take],
    )


def carry_forward(old: DataFrame, new: DataFrame, scope: str) -> DataFrame:
    """Keep rows of scopes that were not rebuilt, add the rebuilt ones."""
    rebuilt = new.select(F.col(scope).alias("__s")).distinct()
    return old.join(rebuilt, F.col(scope) == F.col("__s"), "left_anti").unionByName(new)
