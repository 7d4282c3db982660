"""Licence scan: a suffix automaton of licence texts is streamed over every document.

At each word the automaton knows the longest run of words ending there that stands in a licence text (the matching
statistics). Runs of `MIN_MATCH` words or more that can not be extended, and whole phrases, are matches; matches of one
licence text that follow each other in both texts, at most `MAX_GAP` words apart, are chained. A chain that covers
`MIN_COVER` of a licence text gives its label and a span.

Words are runs of letters A-Z (lower-cased), digits and non-ASCII characters. Only stretches in which neighbouring words
are neighbours in some licence text are streamed: elsewhere no run is longer than one word. Missing and empty texts have
no words; repeated rows are scanned each; other columns are not read. Work is linear in the text.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import keyed_text, per_text
from .suffix_automaton import SuffixAutomaton

MIN_MATCH = 4
MAX_GAP = 12
MIN_COVER = 0.6

# fixed values: phrases whose places are all counted, with their labels
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

# fixed values: parts of published licences and the usual notices, with the labels that the scan gives them
TEXTS = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "Released under the MIT License"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
            "later version"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "GNU Lesser General Public License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form "
                    "or by any means, without the prior written permission of the publisher"),
)

# lower-cases A-Z and puts a blank for every other ASCII character that is not a digit or letter
WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(WORD_BYTES).split()


class Scanner:
    def __init__(self, phrases: Sequence[tuple[str, str]] = PHRASES, texts: Sequence[tuple[str, str]] = TEXTS):
        known: dict[bytes, int] = {}
        number = lambda w: known.setdefault(w, len(known) + 1)  # noqa: E731  0 is any other word
        self.phrases = [([number(w) for w in words_of(p)], label) for p, label in phrases]
        self.texts = [([number(w) for w in words_of(t)], label) for label, t in texts]
        self.known = known
        self.automaton = SuffixAutomaton([(t, None) for t, _ in self.texts] + [(p, label) for p, label in self.phrases])
        size = len(known) + 1
        self.size = size
        self.pairs = np.zeros(size * size, dtype=bool)
        for sequence, _ in self.texts + self.phrases:
            for a, b in zip(sequence, sequence[1:]):
                self.pairs[a * size + b] = True
        # where the strings of a state end: (text, place); a state's links hold its suffixes, which end there too
        self.places: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for k, (sequence, _) in enumerate(self.texts):
            state = matched = 0
            for end, symbol in enumerate(sequence, 1):
                state, matched = self.automaton.step(state, matched, symbol)
                at = state
                while at > 0:
                    self.places[at].add((k, end))
                    at = self.automaton.link[at]

    def stretches(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Start and end of the stretches in which all neighbours are neighbours in a licence text."""
        if len(ids) < 2:
            return
        hits = np.flatnonzero(self.pairs[ids[:-1].astype(np.int64) * self.size + ids[1:]])
        if len(hits) == 0:
            return
        cuts = np.flatnonzero(np.diff(hits) > 1)
        for a, b in zip(np.concatenate(([0], cuts + 1)), np.concatenate((cuts, [len(hits) - 1]))):
            yield int(hits[a]), int(hits[b]) + 2

    def scan(self, text: str) -> dict:
        words = words_of(text)
        ids = np.fromiter(map(self.known.get, words, [0] * len(words)), dtype=np.int32, count=len(words))
        base: list[tuple[int, str]] = []
        matches: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # text: (start, start in it, words)
        automaton = self.automaton
        for start, end in self.stretches(ids):
            state = matched = 0
            previous = (0, 0)
            stretch = ids[start:end].tolist()
            for at, symbol in enumerate(stretch + [0], start + 1):
                if at <= end:
                    state, matched = automaton.step(state, matched, symbol)
                else:
                    state = matched = 0
                if previous[1] >= MIN_MATCH and matched <= previous[1]:
                    self._keep(matches, at - 1, *previous)
                previous = state, matched
                for length, label in automaton.ending(state, matched):
                    if label is not None:
                        base.append((at - length, label))
        spans = self._spans(matches)
        base_labels = sorted({label for _, label in base})
        covers = [s["cover"] for s in spans] + ([1.0] if base else [])
        found = [s for s in spans if s["cover"] >= MIN_COVER]
        return {"n_words": len(words), "n_base": len(base), "first_word": min((b for b, _ in base), default=None),
                "last_word": max((b for b, _ in base), default=None), "base_labels": base_labels,
                "labels": sorted({*base_labels, *(s["label"] for s in found)}), "score": max(covers, default=0.0), "spans": found}

    def _keep(self, matches: dict, end: int, state: int, matched: int) -> None:
        for text, place in self.places[state]:
            matches[text].append((end - matched, place - matched, matched))

    def _spans(self, matches: dict) -> list[dict]:
        """Chains of matches, by text; the best cover of a text starts a new chain wherever the last one can not go on."""
        spans = []
        for text, found in matches.items():
            sequence, label = self.texts[text]
            chain: list[tuple[int, int, int]] = []
            for match in sorted(found):
                if chain:
                    at, place, n = chain[-1]
                    if match[0] >= at + n and match[0] - at - n <= MAX_GAP and match[1] >= place + n:
                        chain.append(match)
                        continue
                    if match[0] < at + n and match[2] <= n:
                        continue
                    spans.append(self._span(chain, label, len(sequence)))
                chain = [match]
            spans.append(self._span(chain, label, len(sequence)))
        return spans

    def _span(self, chain: list[tuple[int, int, int]], label: str, size: int) -> dict:
        return {"label": label, "first_word": chain[0][0], "last_word": chain[-1][0] + chain[-1][2] - 1,
                "cover": sum(m[2] for m in chain) / size}


SPAN = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("cover", pa.float64())])
FIELDS = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                    ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())),
                    ("score", pa.float64()), ("spans", pa.list_(SPAN))])
DDL = ("id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, "
       "score double, spans array<struct<label:string,first_word:long,last_word:long,cover:double>>")


def scan(df: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES, texts: Sequence[tuple[str, str]] = TEXTS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each text: number of words; number, first and last word of the phrases' places; their labels; all
    labels; the best cover of a licence text (1 where a phrase stands); spans as (label, first word, last word, cover)."""
    def make():
        scanner = Scanner(phrases, texts)

        def work(ids, contents):
            rows = [scanner.scan(t) for t in contents]
            return [ids] + [[r[f.name] for r in rows] for f in list(FIELDS)[1:]]
        return work

    keyed = keyed_text(df, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    return per_text(keyed, make, FIELDS, DDL).withColumnRenamed("id", id_col)
