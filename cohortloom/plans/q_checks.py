"""Data-quality checks, over clean bindings and over bindings with planted faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortloom.checks import quality as dq
from cohortloom.operators.sets import source_digest
from cohortloom.plans.q_survival_stats import DEAL, STATUS, dealt
from cohortloom.plans.registry import query
from cohortloom.plans.views import Tables, with_

c = F.col


def shown(df):
    return df.withColumn("examples", F.array_join("examples", ","))


def rows_sql(name: str, x: str, suffix: str = "x") -> str:
    """The check row over a relation ``suffix(k, bad)``."""
    return f"""SELECT '{name}' AS "check", count_if(bad) = 0 AS passed, count(*) AS n_checked, count_if(bad)::BIGINT AS n_bad,
 coalesce((SELECT string_agg(k, ',' ORDER BY k) FROM (SELECT DISTINCT k FROM {suffix} WHERE bad ORDER BY k LIMIT 5)), '') AS examples FROM {suffix}"""


def check(name: str, cte: str, label: str | None = None):
    label = label or name

    def wrap(fn):
        query(name, f"WITH {cte}\n{rows_sql(label, '')}")(lambda t: shown(fn(t, label)))
        return fn

    return wrap


@check("chk_fk", """a AS (SELECT DISTINCT l_orderkey AS id FROM lineitem), b AS (SELECT DISTINCT doc_id * 16 AS id FROM documents), o AS (SELECT o_orderkey AS id FROM orders),
x AS (SELECT 'aliquots:' || id AS k, id NOT IN (SELECT id FROM o) AS bad FROM a UNION ALL SELECT 'reports:' || id, id NOT IN (SELECT id FROM o) FROM b)""")
def _fk(t: Tables, name: str):
    dim = t.samples.select("sample_id")
    tables = {
        "aliquots": t.aliquots.select("sample_id"),
        "reports": t.documents.select((c("doc_id") * 16).alias("sample_id")),
        "labels": t.labels,
    }
    return dq.foreign_keys(tables, "sample_id", dim, name)


@check("chk_file_coverage", """w AS (SELECT lang, count(*) AS n FROM documents WHERE lang <> 'es' GROUP BY 1), h AS (SELECT lang, count(*) AS n, count_if(source = 'src3') AS holes FROM documents JOIN labels USING (doc_id) GROUP BY 1),
x AS (SELECT coalesce(w.lang, h.lang) AS k, NOT coalesce(w.n = h.n AND h.holes = 0, false) AS bad FROM w FULL JOIN h ON w.lang = h.lang)""")
def _coverage(t: Tables, name: str):
    have = t.documents.join(t.labels, "doc_id").select("lang", F.when(c("source") != "src3", c("source")).alias("url"))
    return dq.coverage(have, t.documents, name, "lang", "url", ["es"])


@check("chk_manifest", """x AS (SELECT d.doc_id::VARCHAR AS k, NOT coalesce(md5(d.text) = md5(d.text) AND (CASE WHEN p.page_id % 40 = 7 THEN d.n_chars + 1 ELSE d.n_chars END) = d.n_chars, false) AS bad FROM documents d JOIN pages p ON p.page_id = d.doc_id
 UNION ALL SELECT doc_id::VARCHAR, true FROM documents WHERE doc_id NOT IN (SELECT page_id FROM pages))""")
def _manifest(t: Tables, name: str):
    want = t.files.select("file_id", "md5sum", "file_size")
    have = want.join(t.pages.select("page_id"), c("file_id") == c("page_id")).select(
        "file_id", "md5sum", (c("file_size") + (c("file_id") % 40 == 7).cast("int")).alias("file_size")
    )
    return dq.same_rows(want, have, name, ["file_id"], ["md5sum", "file_size"])


@check("chk_md5", "x AS (SELECT doc_id::VARCHAR AS k, doc_id % 97 = 5 AS bad FROM documents)")
def _md5(t: Tables, name: str):
    content = t.documents.select("doc_id", c("text").cast("binary").alias("content"))
    recorded = t.documents.select("doc_id", F.when(c("doc_id") % 97 == 5, "0").otherwise(F.md5(c("text").cast("binary"))).alias("md5sum"))
    return dq.rehash(content, recorded, name, "doc_id", "md5sum")


@check("chk_cases", """w AS (SELECT DISTINCT c_custkey AS id FROM customer), h AS (SELECT DISTINCT o_custkey + (CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) AS id FROM orders),
x AS (SELECT coalesce(w.id, h.id)::VARCHAR AS k, w.id IS NULL OR h.id IS NULL AS bad FROM w FULL JOIN h ON w.id = h.id)""")
def _cases(t: Tables, name: str):
    have = t.orders.select((c("o_custkey") + (c("o_orderpriority") == "5-LOW").cast("int")).alias("id"))
    return dq.same_sets(t.customer.select(c("c_custkey").alias("id")), have, name, "id")


@check("chk_axis", "x AS (SELECT vec_id::VARCHAR AS k, len(embedding) <> 64 AS bad FROM embeddings)")
def _axis(t: Tables, name: str):
    return dq.axis(t.embeddings, "vec_id", name, F.size("embedding"), 64)


@check("chk_gene_axis", """x AS (SELECT p_partkey::VARCHAR AS k, p_partkey % 500 = 1 OR p_brand = 'Brand#9' AS bad FROM part)""")
def _gene_axis(t: Tables, name: str):
    want = t.genes.select("gene_id", "gene_name", "gene_type", "size")
    have = want.join(t.genes.filter("pathway <> 'Brand#9'").select(c("gene_id").alias("kept")), c("gene_id") == c("kept")).select(
        "gene_id", "gene_name", F.when(c("gene_id") % 500 != 1, c("gene_type")).alias("gene_type"), "size"
    )
    return dq.same_rows(want, have, name, ["gene_id"], ["gene_name", "gene_type", "size"])


@check("chk_metadata", """d AS (SELECT doc_id, CASE WHEN doc_id % 90 = 1 THEN 'nothex' ELSE md5(text) END AS m, CASE WHEN doc_id % 120 = 3 THEN -1 ELSE n_chars END AS n FROM documents),
x AS (SELECT concat_ws(':', nullif(concat_ws('+', CASE WHEN NOT regexp_full_match(m, '[0-9a-f]{32}') THEN 'md5' END, CASE WHEN n < 0 THEN 'negative' END), ''), doc_id) AS k, NOT regexp_full_match(m, '[0-9a-f]{32}') OR n < 0 AS bad FROM d)""")
def _metadata(t: Tables, name: str):
    d = t.documents.select(
        "doc_id", F.when(c("doc_id") % 90 == 1, "nothex").otherwise(F.md5(c("text").cast("binary"))).alias("md5sum"),
        F.when(c("doc_id") % 120 == 3, -1).otherwise(c("n_chars")).alias("n"),
    )
    return dq.no_faults(d, name, "doc_id", {
        "null_id": c("doc_id").isNull(), "md5": ~c("md5sum").rlike("^[0-9a-f]{32}$"), "negative": c("n") < 0,
    })


@check("chk_source_rows", """e AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings), x AS (SELECT vec_id || '/' || i AS k, vec_id % 100 = 4 AND i = 9 AS bad FROM e)""")
def _source_rows(t: Tables, name: str):
    from cohortloom.operators.matrix import pack

    source = t.embeddings.select("vec_id", F.posexplode("embedding").alias("i", "v"))
    moved = F.when((c("vec_id") % 100 == 4) & (c("i") == 9), c("v") + 1).otherwise(c("v") + 1e-8)
    packed = pack(source.withColumn("v", moved), "vec_id", "i", "v")
    back = packed.select("vec_id", F.posexplode("values").alias("i", "v"))
    return dq.same_rows(source, back, name, ["vec_id", "i"], ["v"], tolerance=1e-6)


@query("chk_currency", """WITH o AS (SELECT doc_id AS id, md5(text) AS m, 1 AS v FROM documents WHERE lang <> 'de'),
n AS (SELECT doc_id AS id, CASE WHEN doc_id % 90 = 11 THEN 'other' ELSE md5(text) END AS m, CASE WHEN doc_id % 50 = 0 THEN 2 ELSE 1 END AS v FROM documents WHERE lang <> 'fr'),
x AS (SELECT CASE WHEN o.id IS NULL THEN 'added:' WHEN n.id IS NULL THEN 'withdrawn:' WHEN o.m <> n.m OR o.v <> n.v THEN 'changed:' ELSE '' END || coalesce(o.id, n.id) AS k, NOT coalesce(o.m = n.m AND o.v = n.v, false) AS bad FROM o FULL JOIN n ON o.id = n.id)
SELECT 'chk_currency' AS "check", count_if(bad) = 0 AS passed, count(*) AS n_checked, count_if(bad)::BIGINT AS n_bad, coalesce((SELECT string_agg(k, ',' ORDER BY k) FROM (SELECT k FROM x WHERE bad ORDER BY k LIMIT 15)), '') AS examples FROM x""")
def _currency(t: Tables):
    f = t.files.select("file_id", "md5sum", "data_type")
    old = f.filter("data_type <> 'de'").withColumn("version", F.lit(1))
    new = f.filter("data_type <> 'fr'").withColumn("version", F.when(c("file_id") % 50 == 0, 2).otherwise(1))
    new = new.withColumn("md5sum", F.when(c("file_id") % 90 == 11, "other").otherwise(c("md5sum")))
    return shown(dq.current(old, new, "chk_currency", "file_id", ["md5sum", "version"], "md5sum"))


@query("listing_changes", """WITH o AS (SELECT doc_id AS id, md5(text) AS m FROM documents WHERE lang <> 'de'), n AS (SELECT doc_id AS id, CASE WHEN doc_id % 90 = 11 THEN 'other' ELSE md5(text) END AS m FROM documents WHERE lang <> 'fr')
SELECT coalesce(o.id, n.id) AS file_id, CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'withdrawn' WHEN o.m <> n.m THEN 'changed' END AS kind FROM o FULL JOIN n ON o.id = n.id""")
def _listing_changes(t: Tables):
    f = t.files.select("file_id", "md5sum", "data_type")
    new = f.filter("data_type <> 'fr'").withColumn("md5sum", F.when(c("file_id") % 90 == 11, "other").otherwise(c("md5sum")))
    return dq.listing_changes(f.filter("data_type <> 'de'"), new, "file_id", ["md5sum"])


def diff_sql(name: str, n: str) -> str:
    """The check row over x(k), one row per differing key."""
    return f"""SELECT '{name}' AS "check", count(*) = 0 AS passed, ({n}) AS n_checked, count(*) AS n_bad, coalesce((SELECT string_agg(k, ',' ORDER BY k) FROM (SELECT DISTINCT k FROM x ORDER BY k LIMIT 5)), '') AS examples FROM x"""


@query("chk_matrix_reread", "WITH x AS (SELECT CASE WHEN vec_id % 90 = 7 THEN 'missing:' ELSE 'changed:' END || vec_id || '/' || g AS k FROM (SELECT vec_id, unnest(range(64)) AS g FROM embeddings) WHERE vec_id % 90 = 7 OR (vec_id % 100 = 4 AND g = 9)) "
       + diff_sql("chk_matrix_reread", "SELECT count(*) * 64 FROM embeddings"))
def _matrix_reread(t: Tables):
    # Six quantifications out of one build, unpacked again and held against the rows they came from: a value was moved, a sample lost.
    from cohortloom.operators.matrix import build
    from cohortloom.plans.q_matrix import SIX

    v = c("v").cast("double")
    source = t.embeddings.select("vec_id", F.posexplode("embedding").alias("g", "v")).select("vec_id", c("g").cast("bigint").alias("g"), *[(v * (k + 1)).alias(n) for k, n in enumerate(SIX)])
    moved = source.filter("vec_id % 90 <> 7").withColumn("fpkm", F.when((c("vec_id") % 100 == 4) & (c("g") == 9), c("fpkm") + 1).otherwise(c("fpkm")))
    axis = t.spark.range(64).select(c("id").alias("g"), c("id").alias("gene_index"))
    back = build(moved, axis, "vec_id", "g", SIX).select("vec_id", F.posexplode(F.arrays_zip(*SIX)).alias("g", "z")).select("vec_id", "g", "z.*")
    return shown(dq.same_multiset(source, back, "chk_matrix_reread", ["vec_id", "g"], list(SIX)))


@query("chk_aligned", """WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos, CASE doc_id % 100 WHEN 10 THEN doc_id + 1 WHEN 11 THEN doc_id - 1 ELSE doc_id END AS other FROM documents),
x AS (SELECT pos || ':' || CASE WHEN doc_id = other THEN doc_id::VARCHAR ELSE least(doc_id::VARCHAR, other::VARCHAR) || '/' || greatest(doc_id::VARCHAR, other::VARCHAR) END AS k, doc_id <> other AS bad FROM d)
""" + rows_sql("chk_aligned", ""))
def _aligned(t: Tables):
    # Three configs over one axis, each of several files; in one of them, neighbours changed places.
    from cohortloom.session import shared_dir

    swapped = F.when(c("doc_id") % 100 == 10, c("doc_id") + 1).when(c("doc_id") % 100 == 11, c("doc_id") - 1).otherwise(c("doc_id"))
    configs = {}
    for name, key, files in (("folds", c("doc_id"), 3), ("values", swapped, 5), ("labels", c("doc_id"), 1)):
        path = shared_dir(t.spark, f"config-{name}")
        rows = t.documents.select("doc_id", key.alias("key")).repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id")
        rows.select("key").write.parquet(path)
        configs[name] = dq.positions(t.spark, path, "key")
    return shown(dq.aligned(configs, "chk_aligned", "at", "key"))


def suites() -> dq.Suites:
    """The five suites by name."""
    out = dq.Suites()
    out.add("project", dq.Check("aliquot_ids", "aliquots", c("aliquot_id").rlike("^[0-9]+(-[0-9]+){4}$"), "aliquot_id"), dq.Check("quantities", "aliquots", c("quantity").between(1, 49), "aliquot_id"), dq.Check("segments", "cases", c("segment") != "MACHINERY", "case_id"))
    out.add("expression", dq.Check("widths", "vectors", F.size("embedding") == 64, "vec_id"), dq.Check("labels", "vectors", c("label") < 9, "vec_id"), dq.Check("gene_sizes", "genes", c("size") > 0, "gene_id"))
    out.add("curated", dq.Check("statuses", "samples", c("sample_type").isin("F", "O", "P"), "sample_id"), dq.Check("weights", "samples", c("weight") > 0, "sample_id"))
    out.add("study", dq.Check("sizes", "files", c("file_size") > 20, "file_id"), dq.Check("checksums", "files", c("md5sum").rlike("^[0-9a-f]{32}$"), "file_id"), dq.Check("languages", "files", c("data_type") != "de", "file_id", 10))
    out.add("folds", dq.Check("fold_10", "folds", c("fold_10").between(0, 9), "case_id"), dq.Check("nested", "folds", c("fold_5") == c("fold_10") % 5, "case_id"), dq.Check("first", "folds", c("fold_10") > 0, "case_id"))
    return out


def suite_sql(table: str, checks: dict[str, tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{{0}}' AS suite, '{n}' AS "check", count_if(NOT coalesce({good}, false)) = 0 AS passed, count(*) AS n_checked, count_if(NOT coalesce({good}, false))::BIGINT AS n_bad, coalesce(min({key}::VARCHAR) FILTER (WHERE NOT coalesce({good}, false)), '') AS examples FROM {table}"""
        for n, (good, key) in checks.items()
    )


query("chk_suites", with_("endpoints", "aliquots", "genes", body="," + STATUS + DEAL + "\n" + " UNION ALL ".join([
    suite_sql("aliquots", {"aliquot_ids": ("true", "aliquot_id"), "quantities": ("quantity BETWEEN 1 AND 49", "aliquot_id")}).replace("{0}", "project"),
    suite_sql("cases", {"segments": ("segment <> 'MACHINERY'", "case_id")}).replace("{0}", "project"),
    suite_sql("embeddings", {"widths": ("len(embedding) = 64", "vec_id"), "labels": ("label < 9", "vec_id")}).replace("{0}", "expression"),
    suite_sql("genes", {"gene_sizes": ("size > 0", "gene_id")}).replace("{0}", "expression"),
    suite_sql("samples", {"statuses": ("sample_type IN ('F', 'O', 'P')", "sample_id"), "weights": ("weight > 0", "sample_id")}).replace("{0}", "curated"),
    suite_sql("documents", {"sizes": ("n_chars > 20", "doc_id"), "checksums": ("true", "doc_id"), "languages": ("lang <> 'de'", "doc_id")}).replace("{0}", "study"),
    suite_sql("folds", {"fold_10": ("fold_10 BETWEEN 0 AND 9", "case_id"), "nested": ("fold_5 = fold_10 % 5", "case_id"), "first": ("fold_10 > 0", "case_id")}).replace("{0}", "folds"),
])))(lambda t: _all_suites(t))


def _all_suites(t: Tables):
    tables = {"aliquots": t.aliquots, "cases": t.cases, "vectors": t.embeddings, "genes": t.genes, "samples": t.samples, "files": t.files, "folds": dealt(t)}
    made = suites()
    parts = [made.run(n, tables).withColumn("suite", F.lit(n)) for n in made.names()]
    return shown(dq.suite(parts))


@check("chk_cells", """s AS (SELECT o_orderkey AS no, unnest(['a', 'b', 'c']) AS f, CASE WHEN o_orderkey % 777 = 0 THEN true ELSE false END AS planted FROM orders), x AS (SELECT no || '/' || f AS k, planted AND f = 'b' AS bad FROM s)""")
def _cells(t: Tables, name: str):
    sheet = t.orders.select(c("o_orderkey").alias("no"), c("o_orderstatus").alias("a"), c("o_orderpriority").alias("b"), F.when(c("o_orderstatus") != "P", c("o_custkey").cast("string")).alias("c"))
    built = sheet.withColumn("b", F.when(c("no") % 777 != 0, c("b")))
    long = lambda d: d.unpivot(["no"], ["a", "b", "c"], "f", "v")
    return dq.same_rows(long(sheet), long(built), name, ["no", "f"], ["v"])


@check("chk_keys", """d AS (SELECT c_custkey AS id, count(*) OVER (PARTITION BY CASE WHEN c_custkey % 400 = 1 THEN c_name || 'x' ELSE c_name END) AS n FROM customer), x AS (SELECT CASE WHEN id % 400 = 1 THEN 'shape:Customer#' || lpad(id::VARCHAR, 9, '0') || 'x' ELSE 'Customer#' || lpad(id::VARCHAR, 9, '0') END AS k, id % 400 = 1 AS bad FROM d)""")
def _keys(t: Tables, name: str):
    k = F.when(c("c_custkey") % 400 == 1, F.concat("c_name", F.lit("x"))).otherwise(c("c_name"))
    per = t.customer.groupBy(k.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return dq.no_faults(per, name, "key", {"shape": ~c("key").rlike("^Customer#[0-9]{9}$"), "repeat": c("n") > 1})


query("chk_fold_keys", with_("endpoints", body="," + STATUS + DEAL + """, x AS (SELECT CAST(case_id AS VARCHAR) AS k, fold_10 NOT BETWEEN 0 AND 9 OR fold_5 NOT BETWEEN 0 AND 4 OR pfi_status NOT IN ('event', 'censored', 'missing') AS bad FROM folds)
""" + rows_sql("chk_fold_keys", "")))(
    lambda t: shown(dq.no_faults(dealt(t), "chk_fold_keys", "case_id", {
        "fold_10": ~c("fold_10").between(0, 9), "fold_5": ~c("fold_5").between(0, 4),
        "status": ~c("pfi_status").isin("event", "censored", "missing") | ~c("os_status").isin("event", "censored", "missing"),
    }))
)


@query("chk_study_cells", "WITH x AS (SELECT CASE WHEN c_custkey % 301 = 9 THEN 'missing:' ELSE 'changed:' END || c_custkey AS k FROM customer WHERE c_custkey % 301 = 9 OR c_custkey % 211 = 4) " + diff_sql("chk_study_cells", "SELECT count(*) FROM customer"))
def _study_cells(t: Tables):
    # The table is parsed from text and held against the source's own columns; cells were moved and rows lost.
    from cohortloom.plans.q_sources import money, study_lines
    from cohortloom.sources.typed import read_study_table

    table = read_study_table(study_lines(t), "clinical_patient", ["no", "sub"], keep=["no"])
    k = c("c_custkey")
    source = t.customer.select(
        k.alias("no"), c("c_name").alias("PATIENT_ID"), c("c_mktsegment").alias("GENDER"), money("c_acctbal").alias("BALANCE"), (k % 10).cast("string").alias("GLEASON"),
        F.when(c("c_nationkey") != 3, (k * 7).cast("string")).alias("N"),
    )
    # Numbers are compared as decimals, text as text.
    back = table.select("no", "PATIENT_ID", "GENDER", c("BALANCE").cast("decimal(18,2)").cast("string").alias("BALANCE"), "GLEASON", c("N").cast("string").alias("N"))
    back = back.filter("no % 301 <> 9").withColumn("BALANCE", F.when(c("no") % 211 == 4, "0.001").otherwise(c("BALANCE")))
    return shown(dq.same_multiset(source, back, "chk_study_cells", ["no"], ["PATIENT_ID", "GENDER", "BALANCE", "GLEASON", "N"], buckets=64))


@check("chk_tree", """w AS (SELECT DISTINCT source || '/' || lang AS f FROM documents WHERE lang <> 'es'), h AS (SELECT DISTINCT source || '/' || lang AS f FROM documents JOIN labels USING (doc_id)),
x AS (SELECT coalesce(w.f, h.f) AS k, w.f IS NULL OR h.f IS NULL AS bad FROM w FULL JOIN h ON w.f = h.f)""")
def _tree(t: Tables, name: str):
    path = F.concat_ws("/", "source", "lang").alias("f")
    want = t.documents.filter("lang <> 'es'").select(path)
    have = t.documents.join(t.labels, "doc_id").select(path)
    return dq.same_sets(want, have, name, "f")


@check("chk_pinned", "x AS (SELECT r_name AS k, r_name = 'ASIA' AS bad FROM region)")
def _pinned(t: Tables, name: str):
    import hashlib

    names = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    hashes = {n: hashlib.sha256((n if n != "ASIA" else "other").encode()).hexdigest() for n in names}
    content = t.region.select("r_name", c("r_name").cast("binary").alias("content"))
    return dq.pinned(content, name, "r_name", hashes)


@check("chk_gene_model_same", """x AS (SELECT DISTINCT 'NATION_' || c_nationkey AS k, c_nationkey = 9 AS bad FROM customer)""")
def _gene_model_same(t: Tables, name: str):
    # Every project carries the five-segment model once; one project lacks a segment.
    seg = t.customer.select(F.concat(F.lit("NATION_"), c("c_nationkey").cast("string")).alias("project"), "c_mktsegment", "c_nationkey").distinct()
    model = seg.filter(~((c("c_nationkey") == 9) & (c("c_mktsegment") == "MACHINERY"))).select("project", "c_mktsegment", F.lit("gene").alias("v"))
    per = source_digest(model, ["project"], "c_mktsegment", "v")
    return dq.one_value(per, name, "project", "digest")


@query("chk_invariants", """
WITH d AS (SELECT c_custkey AS id, c_acctbal AS b, -(20000 + c_custkey * 7 % 15000) AS birth, CASE WHEN c_custkey % 30 = 2 THEN 3 ELSE 0 END AS dxday FROM customer),
a AS (SELECT id::VARCHAR AS k, birth >= 0 AS bad FROM d), b AS (SELECT id::VARCHAR AS k, dxday <> 0 AS bad FROM d),
x3 AS (SELECT id::VARCHAR AS k, id % 333 = 5 AS bad FROM d), x4 AS (SELECT id::VARCHAR AS k, false AS bad FROM d)
""" + rows_sql("birth_day_negative", "", "a") + " UNION ALL SELECT 'primary_at_day_zero', count_if(bad) < 0.05 * count(*), count(*), count_if(bad)::BIGINT, '' FROM b UNION ALL "
+ rows_sql("age_consistent", "", "x3") + " UNION ALL " + rows_sql("case_id_unique", "", "x4"))
def _invariants(t: Tables):
    k = c("c_custkey")
    d = t.customer.select(k.alias("id"), (-(20000 + k * 7 % 15000)).alias("birth"), F.when(k % 30 == 2, 3).otherwise(0).alias("dxday"))
    d = d.withColumn("age_days", -c("birth") + c("dxday") + (c("id") % 333 == 5).cast("int"))
    return shown(dq.suite([
        dq.check_rows(d, "birth_day_negative", c("birth") < 0, "id"),
        dq.share_at_most(d, "primary_at_day_zero", c("dxday") != 0, 0.05),
        dq.check_rows(d, "age_consistent", c("age_days") == -c("birth") + c("dxday"), "id"),
        dq.unique(d, "case_id_unique", "id"),
    ]))


@query("chk_suite", """
WITH o AS (SELECT count_if(l_orderkey NOT IN (SELECT o_orderkey FROM orders)) = 0 AS a FROM lineitem), p AS (SELECT count(*) = count(DISTINCT p_partkey) AS b FROM part),
q AS (SELECT count_if(n_chars < 0) = 0 AS c FROM documents), r AS (SELECT count_if(o_custkey NOT IN (SELECT user_id FROM events)) = 0 AS d FROM orders)
SELECT a AND b AND c AND d AS passed, 4::BIGINT AS n_checks, (NOT a)::BIGINT + (NOT b)::BIGINT + (NOT c)::BIGINT + (NOT d)::BIGINT AS n_failed,
 concat_ws(',', CASE WHEN NOT a THEN 'aliquots_known' END, CASE WHEN NOT d THEN 'cases_have_forms' END, CASE WHEN NOT b THEN 'genes_unique' END, CASE WHEN NOT c THEN 'sizes' END) AS failed FROM o, p, q, r""")
def _suite(t: Tables):
    results = dq.suite([
        dq.foreign_keys({"aliquots": t.aliquots}, "sample_id", t.samples, "aliquots_known"),
        dq.unique(t.part, "genes_unique", "p_partkey"),
        dq.check_rows(t.documents, "sizes", c("n_chars") >= 0, "doc_id"),
        dq.foreign_keys({"samples": t.samples}, "case_id", t.forms, "cases_have_forms"),
    ])
    return dq.gate(results).withColumn("failed", F.array_join("failed", ","))
