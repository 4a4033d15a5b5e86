r"""Line dedup by a deletion-neighbourhood join, in DataFrame functions only.

A line is what stands between newlines; it is compared in lower case, tabs and carriage
returns read as blanks, outer blanks taken away, as a sequence of words parted by single
blanks. Lines without words are never removed. A line goes when an earlier line of the corpus
(by doc_id, then line number) is equal, or, where both have ``min_words`` words or more, differs
by one word put in, left out or replaced. Whether the earlier line is itself removed does not
matter, so the result does not depend on any order of work.

1. Equal lines meet by digest; each distinct line keeps its first place.
2. Two lines within one edit share the first or the last half of the shorter one's words.
   Only lines that share such a half with another go on. This drops no match.
3. Every variant with one word deleted, and the line itself, is emitted as a hashed key: the
   xor of word hashes with their positions, so a line of n words has n variants in n steps.
4. Lines that share a key are within two edits. They are compared with the earliest line of the
   key (same deleted place: one word replaced; line against variant: one word in or out), and the
   words around the places are compared themselves.

No pairs within a key are made, every group is reduced to its earliest member, and what is joined
back is a written table, so Spark knows its size and can split its large keys.

Null texts have no lines and stay null. Null ids come last. Rows equal in id and text are one
document here: none removes from the other. Column names of the caller are kept apart from ours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import cut
from cohortloom.llm.registry import query, table

_LAST = 2**63 - 1


def _v(norm: Column, n: Column, i: Column) -> tuple[Column, Column]:
    """What stands before and after word ``i`` of ``n``."""
    return F.call_function("substring_index", norm, F.lit(" "), i), F.call_function("substring_index", norm, F.lit(" "), i + 1 - n)


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, lines): id and th (the text's hash) name the document."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LAST)).alias("id"), F.xxhash64(text_col).alias("th"), F.split(F.col(text_col), "\n", -1).alias("lines"),
    )


def _normal(line: Column) -> Column:
    return F.trim(F.lower(F.replace(F.replace(line, F.lit("\t"), F.lit(" ")), F.lit("\r"), F.lit(" "))))


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, no, norm): non-blank lines."""
    # The text itself must not go along with each of its lines: it is hashed and split before they are told apart.
    # The outer form, as for the other one Spark splits again to see whether there is a line.
    rows = _documents(docs, id_col, text_col).select("id", "th", F.posexplode_outer("lines").alias("no", "line"))
    # Trimming one side tells a blank line as well as both do, and reads up to the first other character only.
    return rows.filter(F.ltrim("line", F.lit(" \t\r")) != "").select("id", "th", "no", _normal(F.col("line")).alias("norm"))


def _digest(norm: str = "norm") -> Column:
    """96 bits of a line, as two numbers."""
    return F.struct(F.xxhash64(norm).alias("a"), F.hash(norm).alias("b"))


def _n_words(norm: str = "norm") -> Column:
    """Words of a line that is not blank and has single blanks at its ends nowhere: its blanks and one."""
    return F.octet_length(norm) - F.octet_length(F.replace(F.col(norm), F.lit(" "), F.lit(""))) + 1


def _with_halves(lines: DataFrame, min_words: int) -> DataFrame:
    """Adds ``halves``: hashes of the halves by which a line may meet one of as many, one fewer or one more words.

    Cutting a text at a word reads it, so the halves for n - 1 words are taken over where they are those for n.
    """
    n = F.col("n")
    k, fewer = F.floor((n - 1) / 2).cast("int"), F.floor((n - 2) / 2).cast("int")

    def cut_at(k: Column) -> Column:
        part = lambda k: F.call_function("substring_index", F.col("norm"), F.lit(" "), k)
        return F.struct(part(k).alias("head"), part(-k).alias("tail"))

    def both(m: Column, s: str) -> Column:
        return F.array(F.xxhash64(F.lit(0), m, F.col(f"{s}.head")), F.xxhash64(F.lit(1), m, F.col(f"{s}.tail")))

    out = lines.withColumn("__own", F.when(n >= min_words, cut_at(k)))
    out = out.withColumn("__fewer", F.when(n > min_words, F.when(k == fewer, F.col("__own")).otherwise(cut_at(fewer))))
    hashes = F.when(n > min_words, F.concat(both(n, "__own"), both(n - 1, "__fewer"))).when(n == min_words, both(n, "__own"))
    return out.withColumn("halves", hashes.otherwise(F.array().cast("array<bigint>"))).drop("__own", "__fewer")


def _keys(lines: DataFrame) -> DataFrame:
    """(key, h, i): hashed deletion variants (i: the deleted place) and the line itself (i = -1)."""
    w = Window.partitionBy("h")
    words = lines.select("h", "n", F.posexplode(F.split("norm", " ", -1)).alias("i", "word"))
    words = words.select("h", "n", "i", F.xxhash64("word", "i").alias("here"), F.xxhash64("word", F.col("i") - 1).alias("moved"))
    before = w.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = words.select(
        "h", "n", "i", F.bit_xor("here").over(before).alias("ph"), F.bit_xor("moved").over(before).alias("pm"), "here",
        F.bit_xor("moved").over(w).alias("tm"),
    )
    # Words before i keep their place, words after it move one down.
    variant = F.col("ph").bitwiseXOR(F.col("here")).bitwiseXOR(F.col("tm")).bitwiseXOR(F.col("pm"))
    last = F.col("i") == F.col("n") - 1
    made = F.array(
        F.struct(F.xxhash64(variant, F.col("n") - 1).alias("key"), F.col("i").alias("i")),
        F.when(last, F.struct(F.xxhash64("ph", "n").alias("key"), F.lit(-1).alias("i"))),
    )
    return after.select("h", F.inline(F.filter(made, lambda s: s.isNotNull())))


def _near(lines: DataFrame, texts: DataFrame) -> DataFrame:
    """(h): distinct lines that come after one within one edit."""
    halves = lines.select("h", F.explode("halves").alias("half"))
    twice = halves.groupBy("half").agg(F.count("*").alias("c")).filter("c > 1").select("half")
    going = cut(halves.join(twice, "half", "left_semi").select("h").distinct(), "line-halves")
    # Only candidates need their words: fetched from the documents where they stand first.
    asked = lines.select("h", "ord", "n").join(going, "h", "left_semi").groupBy(F.col("ord.id").alias("at"), F.col("ord.th").alias("ath"))
    asked = asked.agg(F.collect_list(F.struct("h", "ord", "n")).alias("asked"))
    found = texts.join(asked, (F.col("id") == F.col("at")) & (F.col("th") == F.col("ath")))
    norm = lambda s: F.struct(s["h"].alias("h"), s["ord"].alias("ord"), s["n"].alias("n"), _normal(F.get("lines", s["ord"]["no"])).alias("norm"))
    kept = cut(found.select(F.inline(F.transform("asked", norm))).dropDuplicates(["h"]), "line-candidates")
    keys = _keys(kept)
    met = keys.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a <> b").select("key")
    shared = cut(keys.join(met, "key", "left_semi"), "line-keys")
    rows = cut(shared.join(kept, "h"), "line-rows")
    one = F.struct("ord", "norm", "n", "i")
    whole = rows.filter("i = -1").groupBy("key").agg(F.min(one).alias("other"))
    gone = rows.filter("i >= 0").groupBy("key").agg(F.min(one).alias("other"))
    same = rows.filter("i >= 0").groupBy("key", "i").agg(F.min(one).alias("other"))

    def later(mine: DataFrame, other: DataFrame, on: list[str], equal: Column) -> DataFrame:
        return mine.join(other, on).filter((F.col("other.ord") < F.col("ord")) & equal).select("h")

    def left_out(norm: str, n: str, i: str) -> Column:
        """The line without word ``i``."""
        a, b = _v(F.col(norm), F.col(n), F.col(i))
        return F.concat_ws(" ", F.when(a != "", a), F.when(b != "", b))

    replaced = left_out("norm", "n", "i") == left_out("other.norm", "other.n", "other.i")
    longer = left_out("norm", "n", "i") == F.col("other.norm")
    shorter = F.col("norm") == left_out("other.norm", "other.n", "other.i")
    found = later(rows.filter("i >= 0"), same, ["key", "i"], replaced)
    found = found.union(later(rows.filter("i >= 0"), whole, ["key"], longer))
    return found.union(later(rows.filter("i = -1"), gone, ["key"], shorter)).distinct()


def removed_lines(docs: DataFrame, *, min_words: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, gone): for each document that loses lines, the sorted numbers of those lines."""
    lines = _lines(docs, id_col, text_col)
    place = F.struct("id", "th", "no")
    counted = _with_halves(lines.withColumn("n", _n_words()), min_words)
    counted = counted.select(_digest().alias("h"), place.alias("place"), "n", "halves")
    first = lambda c: F.first(c).alias(c)
    distinct = cut(counted.groupBy("h").agg(F.min("place").alias("ord"), F.count("*").alias("c"), first("n"), first("halves")), "lines")
    near = _near(distinct, _documents(docs, id_col, text_col)).withColumn("near", F.lit(True))
    verdict = distinct.select("h", "ord", "c").join(near, "h", "left").filter("near or c > 1")
    verdict = cut(verdict.select("h", "ord", F.coalesce("near", F.lit(False)).alias("near")), "line-verdict")
    hit = lines.select("id", "th", "no", _digest().alias("h")).join(verdict, "h").filter(F.col("near") | (place != F.col("ord")))
    return hit.groupBy("id", "th").agg(F.sort_array(F.collect_set("no")).alias("gone"))


def dedup_lines(docs: DataFrame, *, min_words: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated lines of ``text_col`` cut out and all other columns as they are; no row is dropped.

    A removed line goes with its newline. Two columns come last: n_lines and n_removed.
    """
    gone = removed_lines(docs, min_words=min_words, id_col=id_col, text_col=text_col)
    key = (F.coalesce(docs[id_col].cast("bigint"), F.lit(_LAST)) == gone["id"]) & (F.xxhash64(docs[text_col]) == gone["th"])
    lines = F.split(docs[text_col], "\n", -1)
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains(gone["gone"], i)), "\n")
    text = F.when(gone["gone"].isNull(), docs[text_col]).otherwise(kept)
    return docs.join(gone, key, "left").select(
        *[text.alias(c) if c == text_col else docs[c] for c in docs.columns],
        F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias("n_lines"), F.coalesce(F.size(gone["gone"]), F.lit(0)).cast("bigint").alias("n_removed"),
    )


SQL = r"""
with d as (select distinct doc_id, text from documents where text is not null),
l as (select doc_id, unnest(range(0, len(string_split(text, chr(10))))) as no, unnest(string_split(text, chr(10))) as line from d),
a as (select doc_id, no, line, trim(lower(translate(line, chr(9) || chr(13), '  ')), ' ') as norm from l),
u as (select norm, min((doc_id, no)) as ord, string_split(norm, ' ') as w, len(string_split(norm, ' ')) as n from a where norm <> '' group by norm),
k as (select norm, ord, w, n, m, kind, case kind when 'h' then array_to_string(w[1:(m - 1) // 2], ' ') else array_to_string(w[n - (m - 1) // 2 + 1:n], ' ') end as half
  from (select *, unnest([n, n - 1]) as m from u where n >= 8), (values ('h'), ('t')) t(kind) where m >= 8),
p as (select distinct x.norm, x.w as xw, x.n as xn, y.w as yw, y.n as yn from k x join k y on x.m = y.m and x.kind = y.kind and x.half = y.half and y.ord < x.ord and abs(x.n - y.n) <= 1),
near as (select distinct norm from (select *,
    coalesce(list_position(list_transform(range(1, least(xn, yn) + 1), lambda i: xw[i] <> yw[i]), true), least(xn, yn) + 1) - 1 as pre,
    coalesce(list_position(list_transform(range(0, least(xn, yn)), lambda i: xw[xn - i] <> yw[yn - i]), true), least(xn, yn) + 1) - 1 as suf from p)
  where pre + suf >= greatest(xn, yn) - 1),
j as (select a.doc_id, a.no, a.line, a.norm <> '' and ((a.doc_id, a.no) <> u.ord or near.norm is not null) as gone from a left join u on a.norm = u.norm left join near on a.norm = near.norm),
r as (select doc_id, count(*) as n_lines, count(*) filter (gone) as n_removed, string_agg(line, chr(10) order by no) filter (gone is not true) as kept from j group by doc_id)
select documents.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed, case when documents.text is not null then sha256(coalesce(kept, '')) end as kept_sha256
from documents left join r using (doc_id)
"""


@query("op6_line_dedup", SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
