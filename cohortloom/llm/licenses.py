"""License scan by template-markup matching.

A template is a license notice with markup: ``[[words]]`` may be missing, ``{{name:k}}`` stands for
up to k words of any kind, ``{{a|b}}`` is one of several wordings; the rest is mandatory and must
match word for word. Each template is compiled into an automaton over words. Places where a
template's first two mandatory words stand next to each other are found for a whole block of
documents in numpy, and the automaton runs from there; the longest acceptance is a match.

Plain phrases are counted at every place where their words stand next to each other.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are made small. The score is 1 if a label was
found, else the largest part of a template's mandatory words that was accepted, in order, from a
place where it begins (0 if none). Null and empty texts have no words, no labels, score 0. Rows are
judged one by one; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.common import ALNUM, Words, scan
from cohortloom.llm.registry import query, table

# Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Public notices and license texts, as templates.
TEMPLATES = {
    "mit-notice": "{{released|licensed|distributed|available}} under [[the terms of]] the mit license",
    "apache-2-notice": "licensed under the apache license [[version]] 2 0 [[the license you may not use this file except in compliance with the license]]",
    "cc-by-nc-4": "licensed under [[{{a|the}}]] [[creative commons]] cc by nc 4 0 [[international]] [[license]]",
    "gpl-3": "this {{work:3}} is licensed under the gnu general public license [[as published by the free software foundation]] [[either]] version 3 [[of the license]] [[or at your option any later version]]",
    "gpl-2": "this {{work:3}} is licensed under the gnu general public license [[as published by the free software foundation]] [[either]] version 2 [[of the license]] [[or at your option any later version]]",
    "reserved": "all rights reserved",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this {{software:4}} and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "isc-text": "permission to use copy modify and or distribute this {{software:4}} for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
}


class Automaton:
    """A template's words as states; state ``i`` may read the words of ``edges[i]`` (None: any word)."""

    def __init__(self, template: str):
        self.edges: list[list[tuple[bytes | None, int]]] = [[]]
        self.free: list[set[int]] = [set()]
        self.mandatory: list[int] = [0]
        self.plain: list[bytes] = []
        self._build(template)
        self.need = max(1, self.mandatory[-1])
        heads: list[list[bytes]] = [[]]
        for token in re.findall(r"\{\{[^}]*\}\}|\[\[|\]\]|\S+", template):
            if token in ("[[", "]]") or min(len(h) for h in heads) >= 2:
                break
            words = [w.encode() for w in token.strip("{}").split("|")] if "|" in token else [None] if ":" in token else [token.encode()]
            heads = [[*h, w] for h in heads for w in words]
        #: Word sequences that every match begins with (one or two words).
        self.heads = [tuple(h[: h.index(None)] if None in h else h)[:2] for h in heads]
        if not all(self.heads):
            raise ValueError("a template begins with a mandatory word")

    def _state(self, need: int) -> int:
        self.edges.append([])
        self.free.append(set())
        self.mandatory.append(need)
        return len(self.edges) - 1

    def _build(self, template: str) -> None:
        at, opens = 0, []
        for token in re.findall(r"\{\{[^}]*\}\}|\[\[|\]\]|[^\s\[\]]+", template):
            if token == "[[":
                opens.append(at)
            elif token == "]]":
                self.free[opens.pop()].add(at)
            elif token.startswith("{{") and ":" in token:
                first = at
                for _ in range(int(token[2:-2].split(":")[1])):
                    new = self._state(self.mandatory[at])
                    self.edges[at].append((None, new))
                    at = new
                ends, last = range(first + 1, at), at
                for s in ends:
                    self.free[s].add(last)
            else:
                new = self._state(self.mandatory[at] + (not opens))
                for word in token.strip("{}").split("|"):
                    self.edges[at].append((word.encode(), new))
                at = new
        self.last = at

    def _closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.free[todo.pop()] - states:
                states.add(s)
                todo.append(s)
        return states

    def run(self, words: Iterator[bytes]) -> tuple[int, float]:
        """(number of words of the longest acceptance or 0, part of the mandatory words read)."""
        states, read, end, best = self._closed({0}), 0, 0, 0
        for word in words:
            states = self._closed({to for s in states for want, to in self.edges[s] if want is None or want == word})
            if not states:
                break
            read += 1
            best = max(best, *(self.mandatory[s] for s in states))
            if self.last in states:
                end = read
        return end, 1.0 if end else min(best, self.need - 1) / self.need


def _phrase_hash(words: list[bytes]) -> int:
    joined = b" ".join(words)
    one = Words(np.frombuffer(joined, np.uint8), np.array([0, len(joined)]), ALNUM)
    return int(one.windows(len(words))[0][0])


def scan_licenses(docs: DataFrame, *, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, places (starts of phrases, with label), matches (accepted templates: start, end, label), part."""
    id_type = docs.schema[id_col].dataType
    automata = {label: Automaton(t) for label, t in templates.items()}
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("label", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length: dict[int, dict[int, list]] = {}
        for text, label in phrases.items():
            words = text.encode().split()
            by_length.setdefault(len(words), {}).setdefault(_phrase_hash(words), []).append((words, label, None))
        for label, auto in automata.items():
            for head in set(auto.heads):
                by_length.setdefault(len(head), {}).setdefault(_phrase_hash(list(head)), []).append((list(head), label, auto))
        for batch, words in scan(batches, ALNUM):
            places: list[list] = [[] for _ in range(batch.num_rows)]
            matches: list[list] = [[] for _ in range(batch.num_rows)]
            part = np.zeros(batch.num_rows)
            for n, wanted in by_length.items():
                h, ok = words.windows(n)
                for key, known in wanted.items():
                    for i in np.flatnonzero((h == np.uint64(key)) & ok).tolist():
                        d = int(words.doc[i])
                        at, stop = i - int(words.first[d]), int(words.first[d + 1])
                        for head, label, auto in known:
                            if words.text(i, i + n) != b" ".join(head):
                                continue
                            if auto is None:
                                places[d].append({"start": at, "stop": at + n, "label": label})
                                continue
                            read, done = auto.run(words.data[words.start[k] : words.end[k]].tobytes() for k in range(i, stop))
                            part[d] = max(part[d], done)
                            if read:
                                matches[d].append({"start": at, "stop": at + read, "label": label})
            part[[bool(p) for p in places]] = 1.0
            for rows in (places, matches):
                for r in rows:
                    r.sort(key=lambda s: (s["start"], s["label"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(words.count, pa.int64()), pa.array(places, pa.list_(span)), pa.array(matches, pa.list_(span)), pa.array(part)],
                names=[id_col, "n_words", "places", "matches", "part"],
            )

    spans = "array<struct<start:bigint,stop:bigint,label:string>>"
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(run, f"`{id_col}` {id_type.simpleString()}, n_words bigint, places {spans}, matches {spans}, part double")


@query("op4_licenses")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    labels = lambda *cols: F.array_join(F.array_sort(F.array_distinct(F.transform(F.concat(*cols), lambda s: s["label"]))), ",")
    starts = F.transform("places", lambda s: s["start"])
    return found.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels("places").alias("base_labels"), labels("places", "matches").alias("labels"), F.col("part").alias("score"),
    )
