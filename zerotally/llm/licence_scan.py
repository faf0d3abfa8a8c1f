"""Licence scan over a positional index of rare words.

Templates are short runs of words. Each is indexed under its rarest words (highest inverse document frequency over the
scanned table) with their positions. A file looks up the words it shares with the index, rarest first; every
occurrence votes for the template and the place in the file where it would begin, so that postings meet at a common relative
position. A place with two votes (one, where a template has one indexed word) is compared with the template word
by word, and its mandatory phrases must stand in full near their places.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zerotally.llm.frames import binary_text

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
INDEXED_WORDS = 3
SIMILAR = 0.6


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    keys: tuple[tuple[int, tuple[bytes, ...]], ...]  # (position in the template, words) of mandatory phrases
    base: bool


def template(label: str, text: str, keys: Sequence[str] = (), base: bool = False) -> Template:
    """A template whose mandatory phrases are `keys`; without keys, all of it is mandatory."""
    words = tuple(WORD.findall(text.encode().lower()))
    phrases = []
    for key in keys or (text,):
        part = tuple(WORD.findall(key.encode().lower()))
        at = next(i for i in range(len(words)) if words[i:i + len(part)] == part)
        phrases.append((at, part))
    return Template(label, words, tuple(phrases), base)


# The phrases and labels that are asked for, then the method's own.
TEMPLATES = (
    template("gpl", "gnu general public license", base=True),
    template("apache", "apache license", base=True),
    template("cc-by", "cc by", base=True),
    template("mit", "mit license", base=True),
    template("cc-by-nc", "cc by nc"),
    template("cc-by-sa", "cc by sa"),
    template("cc-by", "creative commons attribution"),
    template("lgpl", "gnu lesser general public license"),
    template("agpl", "gnu affero general public license"),
    template("mpl", "mozilla public license"),
    template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
             ["free software", "general public license"]),
    template("apache", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license",
             ["may not use this file except in compliance"]),
    template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
             ["permission is hereby granted", "obtaining a copy"]),
    template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             ["redistribution and use in source and binary forms"]),
    template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
             ["permission to use copy modify", "is hereby granted"]),
)


def document_frequencies(docs: DataFrame, text_col: str, templates: Sequence[Template]) -> tuple[int, dict[bytes, int]]:
    """Number of documents, and for every template word the number that hold it. Each task sends one row per word."""
    vocabulary = frozenset(w for t in templates for w in t.words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for text in binary_text(batch):
                found.update(vocabulary.intersection(WORD.findall(text.lower())))
                found[b""] += 1
        if found:
            yield pa.RecordBatch.from_pydict({"word": list(found), "n": list(found.values())},
                                             schema=pa.schema([("word", pa.binary()), ("n", pa.int64())]))

    rows = (docs.select(F.col(text_col).alias("text")).mapInArrow(count, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).collect())  # a row per template word at most
    found = {bytes(r["word"]): r["n"] for r in rows}
    return found.pop(b"", 0), found


class Index:
    """Postings of each template's rarest words; finds the places of all templates in a list of words."""

    def __init__(self, templates: Sequence[Template], n_docs: int, frequencies: dict[bytes, int]):
        self.templates = templates
        self.idf = {w: math.log((n_docs + 1) / (frequencies.get(w, 0) + 1)) for t in templates for w in t.words}
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.need = []
        for number, t in enumerate(templates):
            rare = sorted(set(t.words), key=lambda w: (-self.idf[w], w))[:INDEXED_WORDS]
            places = [(w, at) for at, w in enumerate(t.words) if w in rare]
            for w, at in places:
                self.postings[w].append((number, at))
            self.need.append(min(2, len(places)))
        self.words = frozenset(self.postings)

    def matches(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, place of its first word, share of its words that agree), in file order."""
        if self.words.isdisjoint(words):
            return []
        occurrences: dict[bytes, list[int]] = defaultdict(list)
        for at, w in enumerate(words):
            if w in self.words:
                occurrences[w].append(at)
        votes: Counter[tuple[int, int]] = Counter()
        for w in sorted(occurrences, key=lambda w: (-self.idf[w], w)):
            for number, place in self.postings[w]:
                votes.update((number, at - place) for at in occurrences[w])
        found = []
        for (number, start), n in votes.items():
            if n >= self.need[number] and (share := self.verify(words, number, start)) > 0:
                found.append((number, start, share))
        return sorted(found, key=lambda f: (f[1], f[0]))

    def verify(self, words: list[bytes], number: int, start: int) -> float:
        t = self.templates[number]
        for at, phrase in t.keys:
            reach = 0 if len(phrase) == len(t.words) else 3 + len(t.words) // 4
            places = range(max(0, start + at - reach), min(len(words), start + at + reach + 1))
            if start + at < 0 or not any(tuple(words[p:p + len(phrase)]) == phrase for p in places):
                return 0.0
        agree = sum(0 <= start + i < len(words) and words[start + i] == w for i, w in enumerate(t.words)) / len(t.words)
        return agree if agree >= SIMILAR else 0.0


def scan_licences(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places where a base template stands word for word, first_word and last_word are the smallest and
    largest of them (null without any), labels join the distinct labels in order with commas (empty without any), and
    score is the best share of agreeing words (0 without a match). Null text counts as empty. Repeated rows are scanned
    each; an empty table gives no rows.
    """
    index = Index(templates, *document_frequencies(docs, text_col, templates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in binary_text(batch):
                words = WORD.findall(text.lower())
                found = index.matches(words)
                base = [(number, at) for number, at, _ in found if templates[number].base]
                places = [at for _, at in base]
                names = lambda numbers: ",".join(sorted({templates[k].label for k in numbers}))
                rows.append((len(words), len(base), min(places, default=None), max(places, default=None),
                             names(k for k, _ in base), names(k for k, _, _ in found), max((s for _, _, s in found), default=0.0)))
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, type=f.type) for c, f in zip(columns, list(out)[1:])]], schema=out)

    out = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                     ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                             "base_labels string, labels string, score double"))
