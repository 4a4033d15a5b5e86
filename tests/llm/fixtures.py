"""Small odd tables for the training-data operators."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, spans int, h double, key string, n_lines string"
WORDS = "alpha beta gamma delta Été straße naïve x1 42 foo bar baz qux quux tea milk Œuvre".split()


def prose(rnd: random.Random, n: int, words=WORDS) -> str:
    return " ".join(rnd.choice(words) for _ in range(n))


def wide(rows):
    """Rows (doc_id, text[, source]) with further columns whose names the operators use inside."""
    out = []
    for r in rows:
        i, t, source = (*r, "s0")[:3]
        out.append((i, t, None if i == 3 else "en", source, None if t is None else len(t), "n", 1, 0.5, None, "l"))
    return out


def table(spark, rows):
    return spark.createDataFrame(wide(rows), SCHEMA)


def odd_rows(seed=1):
    """Nulls, blanks, ties, repeated rows, one very long text, copies and near copies."""
    rnd = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "ñu", "pé", "Ra", "st") for b in ("r", "s", "tion", "x", "7", "ß", "lo")]
    base = [prose(rnd, rnd.randrange(1, 120), vocabulary) for _ in range(30)]
    rows = [(k, t, f"s{k % 4}") for k, t in enumerate(base)]
    for k in range(12):
        words = base[k].split(" ")
        words[rnd.randrange(len(words))] = "edited"
        rows.append((100 + k, " ".join(words), "s1"))
        rows.append((200 + k, base[k] + "\n" + base[(k + 1) % 30], None))
    rows += [(50, None, "s0"), (51, "", "s0"), (52, "   \n\t ", None), (53, "!!! ...", "s2"), (54, "short", "s0"), (55, "short", "s0")]
    rows += [(60, base[0], "s3"), (60, base[0], "s3"), (None, base[1], "s0"), (None, None, "s1")]
    rows.append((70, "\n".join(base * 12), "s0"))
    return rows
