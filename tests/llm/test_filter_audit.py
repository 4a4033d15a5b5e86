"""Counters of the stream against the conditions read one document after the other."""

import re
from collections import Counter
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from fixtures import odd_rows, prose

from cohortloom.llm import common, filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def mask(t):
    w = WORD.findall(t)
    a, b = len(w) < 100, 100 * len(set(w)) < 80 * len(w)
    return a + 2 * b + 4 * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t)) + 8 * bool(re.search(r"[#$%&*|]", t))


def masks(rows):
    """(part, mask, doc_id) of rows (doc_id, text, lang)."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    return [(lang or "", mask(t or "") + 16 * (i is not None and least[t or ""] < i), i) for i, t, lang in rows]


def expected(rows, labels):
    good, toxic = ({i for i, *x in labels if x[k] == 1} for k in (0, 1))
    docs, out = masks(rows), {}
    for part in {p for p, *_ in docs}:
        own = [(m, i in good, i in toxic) for p, m, i in docs if p == part]
        removed = Counter()
        for order in permutations("ABCDE"):
            ahead = 0
            for step, f in enumerate(order, 1):
                bit = 1 << "ABCDE".index(f)
                here = [x for x in own if x[0] & bit and not x[0] & ahead]
                removed[f] += len(here)
                out[part, "".join(order), step] = (
                    sum(not x[0] & (ahead | bit) for x in own), len(here), sum(bool(x[0] & bit and x[0] & ahead) for x in own),
                    sum(x[0] == bit for x in own), sum(x[1] for x in here), sum(x[2] for x in here),
                )
                ahead |= bit
        for key in [k for k in out if k[0] == part and len(out[k]) == 6]:
            out[key] = (*out[key], removed[key[1][key[2] - 1]])
    return out


def write(spark, rows, path, files):
    schema = "doc_id bigint, text string, lang string, part int, flags int, n int, low int"
    for k in range(files):
        spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows[k::files]], schema).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture(scope="module")
def rows():
    import random

    rnd = random.Random(8)
    words = [f"w{k}" for k in range(400)]
    out = [(i, t, s) for i, t, s in odd_rows()]
    out += [(1000 + k, prose(rnd, rnd.choice((50, 120, 300)), words) + rnd.choice(("", " #", " ABC " * 60)), rnd.choice(("en", "de", None))) for k in range(60)]
    # Copies whose smallest id comes last, repeated rows of one id, and copies in other parts.
    out += [(3000 - k, out[90][1], ("en", "de")[k % 2]) for k in range(30)] + [(2000, out[90][1], "fr"), (2000, out[90][1], "fr"), (2**60 + 1, out[90][1], "en"), (2**60, "big", "en"), (2**60 + 1, "big", "en")]
    return out


@pytest.mark.parametrize(("files", "batches"), [(7, 7), (3, 1)])
def test_audit(spark, rows, tmp_path, files, batches):
    path, labels = str(tmp_path / "documents.parquet"), [(i, k % 2, (k // 2) % 2) for k, (i, *_) in enumerate(rows)] + [(5, 1, None), (5, 0, 1), (None, 1, 1)]
    write(spark, rows, path, files)
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    counts = filter_audit.failure_counts(spark, path, frame, batches=batches)
    got = {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in filter_audit.audit(counts).collect()}
    assert got == expected(rows, [x for x in labels if x[0] is not None])
    assert sum(r.n for r in counts.collect()) == len(rows)


def test_one_file_and_none(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    out = filter_audit.failure_counts(spark, f"{sf}/documents.parquet", spark.read.parquet(f"{sf}/labels.parquet"))
    assert sum(r.n for r in out.collect()) == spark.read.parquet(f"{sf}/documents.parquet").count()
    path = str(tmp_path / "none.parquet")
    spark.createDataFrame([], "doc_id bigint, text string, lang string").write.parquet(path)
    none = filter_audit.audit(filter_audit.failure_counts(spark, path, spark.read.parquet(f"{sf}/labels.parquet").limit(0)))
    assert none.count() == 0


def test_masks_of_texts(rows):
    texts = [t or "" for _, t, _ in rows] + ["É" * 9 + "A", "a" * 9 + "A", "A", "x|", "", "\v\f a"]
    data, offsets = common.text_bytes(pa.array(texts))
    assert filter_audit.text_masks(data, offsets).tolist() == [mask(t) for t in texts]


def test_state_does_not_depend_on_the_batches():
    rnd = np.random.default_rng(2)
    rows = pd.DataFrame({"k1": rnd.integers(0, 5, 200), "k2": 0, "part": rnd.choice(["", "en"], 200), "flags": rnd.choice([1, 33], 200), "low": rnd.integers(0, 40, 200), "at_low": 1, "n": 1})
    totals = []
    for size in (200, 50, 9):
        held, total = filter_audit._STATE.empty_table().to_pandas(), Counter()
        for k in range(0, 200, size):
            held, changes = filter_audit._merge(held, rows[k : k + size])
            for r in changes.itertuples():
                total[r.part, r[2]] += r.n
        totals.append(({k: n for k, n in total.items() if n}, held.sort_values(list(held)).values.tolist()))
    assert totals[0] == totals[1] == totals[2]
