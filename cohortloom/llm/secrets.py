r"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found by pattern: assignments to a secret's name, access keys, long hexadecimal
runs, and long mixed tokens. Each candidate's value is hashed, and the corpus is asked in how
many repositories and by how many owners that hash occurs. What several owners have is a widely
copied example; what one owner has looks live, in however many of its repositories.

Patterned kinds (assign, access, hex) are always reported. A mixed token (``owned``: 20 or more of
``[A-Za-z0-9+/_-]`` with a small letter, a capital and a digit, outside the patterned spans) is
reported only where its value belongs to one owner. Values are kept as hashes as soon as they are found: none
is written in clear.

Counting is two-step: (hash, owner, repository) is made distinct and counted per owner, then per
hash; both aggregate before they shuffle, so a value in a third of all texts is no hot spot. What
is joined back is a written table of owner-specific hashes.

Offsets are code points, ends exclusive. Null texts are empty; null owners and repositories
count as one each. Rows with equal ids get the same owned values, each judged on its own text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.common import cut
from cohortloom.llm.registry import query, table

#: kind: (pattern, group of the value, least length of the value, a cheap test that a text may match).
#: Runs of one class that are long enough are the long ones among all runs of that class.
KINDS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6, lambda t: t.contains("=") | t.contains(":")),
    "access": (r"AKIA[A-Z0-9]+", 0, 20, lambda t: t.contains("AKIA")),
    "hex": (r"[0-9a-f]{24,}", 0, 24, lambda t: t.rlike("[0-9a-f]{24}")),
    "owned": (r"[A-Za-z0-9+/_-]{20,}", 0, 20, lambda t: t.rlike("[A-Za-z0-9+/_-]{20}")),
}
BASE = ("assign", "access", "hex")
SPAN = "array<struct<start:int,rank:int,stop:int,kind:string,value:string>>"


def _hashed(spans: Column) -> Column:
    """Spans with the SHA-256 of their value in its place."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind"), F.unhex(F.sha2(s["value"], 256)).alias("hash")))


def _matches(text: Column, kind: str) -> Column:
    """Spans of one kind: leftmost matches that do not overlap, too short ones left out."""
    pattern, group, least, may = KINDS[kind]
    found = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("all"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    rank = list(KINDS).index(kind)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        stop = start + F.length(x["all"])
        span = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), stop.alias("stop"), F.lit(kind).alias("kind"), x["value"].alias("value")))
        return F.struct(F.coalesce(stop, acc["at"]).alias("at"), F.when(F.length(x["value"]) >= least, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))
    return F.when(may(text), F.aggregate(found, begin, step, lambda acc: acc["out"])).otherwise(F.array().cast(SPAN))


def _mixed(value: Column) -> Column:
    return value.rlike("[a-z]") & value.rlike("[A-Z]") & value.rlike("[0-9]")


def candidates(docs: DataFrame, *, id_col: str, text_col: str, owner_col: str, repo_col: str) -> DataFrame:
    """(id, owner, repo, base, extra): spans of the patterned kinds and of mixed tokens outside them, sorted."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(owner_col).cast("string").alias("owner"), F.col(repo_col).cast("string").alias("repo"), text.alias("text"))
    rows = rows.select("id", "owner", "repo", *[_matches(F.col("text"), k).alias(k) for k in KINDS])
    rows = rows.withColumn("base", F.array_sort(F.concat(*[F.col(k) for k in BASE])))
    apart = lambda x: ~F.exists("base", lambda b: (b["start"] < x["stop"]) & (x["start"] < b["stop"])) & _mixed(x["value"])
    return rows.select("id", "owner", "repo", _hashed(F.col("base")).alias("base"), _hashed(F.filter("owned", apart)).alias("extra"))


def ownership(found: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repos) of every candidate value."""
    once = found.select("owner", "repo", F.explode(F.array_distinct(F.transform(F.concat("base", "extra"), lambda s: s["hash"]))).alias("hash")).distinct()
    per_owner = once.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return per_owner.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repos"))


def scan_secrets(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str | None = None,
) -> DataFrame:
    """Per row: id, base (patterned spans), spans (with owned tokens), n_live (spans whose value looks live),
    n_example (the others). A repository is the row's id unless ``repo_col`` names it; :func:`ownership` counts them."""
    found = cut(candidates(docs, id_col=id_col, text_col=text_col, owner_col=owner_col, repo_col=repo_col or id_col), "secrets")
    live = cut(ownership(found).filter(F.col("n_owners") == 1).select("hash"), "secrets-live")
    value = found.select("id", F.explode(F.array_distinct(F.transform(F.concat("base", "extra"), lambda s: s["hash"]))).alias("hash"))
    mine = value.join(live, "hash", "left_semi").groupBy(F.col("id").alias("live_id")).agg(F.collect_set("hash").alias("live"))
    rows = found.join(mine, found["id"].eqNullSafe(mine["live_id"]), "left").withColumn("live", F.coalesce("live", F.array().cast("array<binary>")))
    own = F.filter("extra", lambda s: F.array_contains(F.col("live"), s["hash"]))
    spans = F.array_sort(F.concat("base", own))
    n_live = F.size(F.filter(spans, lambda s: F.array_contains(F.col("live"), s["hash"])))
    return rows.select(F.col("id").alias(id_col), "base", spans.alias("spans"), n_live.alias("n_live"), (F.size(spans) - n_live).alias("n_example"))


def joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _sql_kind(kind: str, pattern: str, group: int) -> str:
    least, rank = KINDS[kind][2], list(KINDS).index(kind)
    return f"""select r, doc_id, source, kind, rank, start, start + length(a) as stop, value from (
      select r, doc_id, source, '{kind}' as kind, {rank} as rank, a, v as value,
        cast(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) as bigint) as start
      from (select r, doc_id, source, gaps, hits, unnest(range(1, len(hits) + 1)) as i, unnest(hits) as a, unnest(vals) as v from (
        select r, doc_id, source, regexp_split_to_array(t, '{pattern}') as gaps, regexp_extract_all(t, '{pattern}') as hits, regexp_extract_all(t, '{pattern}', {group}) as vals from d
        where regexp_matches(t, '{pattern}')))) where length(value) >= {least}"""


_NAME = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
SQL = f"""
with d as (select row_number() over () as r, doc_id, source, coalesce(text, '') as t from documents),
base as ({_sql_kind("assign", _NAME + r'''["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)''', 2)}
  union all {_sql_kind("access", "AKIA[A-Z0-9]+", 0)}
  union all {_sql_kind("hex", "[0-9a-f]+", 0)}),
extra as (select * from ({_sql_kind("owned", "[A-Za-z0-9+/_-]{20,}", 0)}) e
  where regexp_matches(value, '[a-z]') and regexp_matches(value, '[A-Z]') and regexp_matches(value, '[0-9]')
  and not exists (select 1 from base b where b.r = e.r and b.start < e.stop and e.start < b.stop)),
every as (select * from base union all select * from extra),
live as (select value from every group by value having count(distinct coalesce(source, '')) = 1),
spans as (select * from base union all select * from extra where value in (select value from live)),
b as (select r, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
  string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) as s from base group by r),
s as (select r, string_agg(kind || ':' || start || ':' || stop, ',' order by start, rank) as spans,
  count(*) filter (value in (select value from live)) as n_live, count(*) filter (value not in (select value from live)) as n_example from spans group by r)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(b.s, '')) as base_sha256,
  coalesce(spans, '') as spans, coalesce(n_live, 0) as n_live, coalesce(n_example, 0) as n_example
from d left join b using (r) left join s using (r)
"""


@query("op10_secrets", SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[of(k) for k in BASE], F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"),
        F.col("n_live").cast("bigint").alias("n_live"), F.col("n_example").cast("bigint").alias("n_example"),
    )
