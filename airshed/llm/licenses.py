"""Licence scans with a generalised suffix automaton of licence tokens.

The automaton holds every template, word by word. A text is streamed through it once: at each
word it gives the length of the longest run of words ending there that also stands in a template
(the matching statistic) and the state, hence the templates that hold this run. Runs that
cannot grow and have MIN_MATCH words or more are chained, per template, into the best cover whose
places rise in both texts; a template covered to MIN_COVER or more is a find.
Plain phrases (PHRASES) label as well, wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from airshed.llm.common import as_id, as_text

# The phrases of the contract, and openings of public licence texts and notices.
PHRASES = (("mit license", "mit"), ("apache license", "apache"),
           ("general public license", "gpl"))
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the "
            "Software without restriction, including without limitation the rights to use, copy, "
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "Released under the MIT License."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
               "this file except in compliance with the License. You may obtain a copy of the "
               "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the "
            "terms of the GNU General Public License as published by the Free Software Foundation, "
            "either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International "
              "License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                 "International License."),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 "
                 "International License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
                 "International License."),
    ("cc-by-nc-sa", "This work is licensed under a Creative Commons "
                    "Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("cc-by-nc-nd", "This work is licensed under a Creative Commons "
                    "Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc0", "To the extent possible under law, the author has dedicated all copyright and related "
            "and neighboring rights to this software to the public domain worldwide."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the "
             "terms of the GNU Lesser General Public License as published by the Free Software "
             "Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the "
             "terms of the GNU Affero General Public License as published by the Free Software "
             "Foundation, either version 3 of the License, or (at your option) any later version."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with "
            "or without fee is hereby granted, provided that the above copyright notice and this "
            "permission notice appear in all copies."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no "
             "event will the authors be held liable for any damages arising from the use of this "
             "software."),
    ("bsl", "Permission is hereby granted, free of charge, to any person or organization obtaining "
            "a copy of the software and accompanying documentation covered by this license (the "
            "\"Software\") to use, reproduce, display, distribute, execute, and transmit the "
            "Software"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone "
                  "is free to copy, modify, publish, use, compile, sell, or distribute this software"),
    ("epl", "This program and the accompanying materials are made available under the terms of the "
            "Eclipse Public License 2.0"),
)
MIN_MATCH = 4
MIN_COVER = 0.6
GAP = 0.1  # covered words that a word between two runs costs

#: Bytes of a text to the bytes of its words: A-Z lower-cased, letters, digits and non-ASCII kept.
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128
                  else 32 for c in range(256))


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TO_WORDS).split()


class Automaton:
    """Generalised suffix automaton over sequences of token ids. Per state: ``next`` (token to
    state), ``link``, ``longest``; ``ends``: (template, position after its last token) of one
    occurrence per template."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.longest = [-1], [0]
        self.ends: list[dict[int, int]] = [{}]
        for t, tokens in enumerate(sequences):
            last = 0
            for i, token in enumerate(tokens):
                last = self._add(last, token)
                self.ends[last].setdefault(t, i + 1)
        for s in sorted(range(1, len(self.next)), key=lambda s: -self.longest[s]):
            for t, end in self.ends[s].items():  # a suffix ends where the longer run ends
                self.ends[self.link[s]].setdefault(t, end)

    def _state(self, longest: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.longest.append(longest)
        self.ends.append({})
        return len(self.next) - 1

    def _split(self, p: int, token: int, q: int) -> int:
        """The state of the runs of q that are no longer than one token more than p's."""
        copy = self._state(self.longest[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = copy
            p = self.link[p]
        return copy

    def _add(self, last: int, token: int) -> int:
        q = self.next[last].get(token)
        if q is not None:
            return q if self.longest[q] == self.longest[last] + 1 else self._split(last, token, q)
        new = self._state(self.longest[last] + 1, {}, 0)
        p = last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][token]
            fits = self.longest[q] == self.longest[p] + 1
            self.link[new] = q if fits else self._split(p, token, q)
        return new

    def matches(self, tokens: Iterable[int | None], least: int) -> Iterator[tuple[int, int, int]]:
        """(end, length, state) of each run of ``least`` tokens or more that the next token does not
        continue."""
        follow, link, longest = self.next, self.link, self.longest
        state = length = i = 0
        for i, token in enumerate(tokens):  # noqa: B007
            if token is None:
                if length >= least:
                    yield i, length, state
                state = length = 0
                continue
            to = follow[state].get(token)
            if to is None:
                if length >= least:
                    yield i, length, state
                while state and token not in follow[state]:
                    state = link[state]
                length = longest[state] if state else 0
                to = follow[state].get(token)
                if to is None:
                    state = length = 0
                    continue
            state, length = to, length + 1
        if length >= least:
            yield i + 1, length, state


class Scanner:
    def __init__(self, templates=TEMPLATES, phrases=PHRASES):
        self.phrases = [(split_words(p), label) for p, label in phrases]
        self.labels = [label for label, _ in templates]
        texts = [split_words(t) for _, t in templates]
        self.vocabulary: dict[bytes, int] = {}
        tokens = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in t] for t in texts]
        self.lengths = [len(t) for t in tokens]
        self.automaton = Automaton(tokens)

    def base(self, words: list[bytes]) -> list[tuple[int, str]]:
        """(first word, label) of each place where a phrase stands."""
        found = []
        for phrase, label in self.phrases:
            at = -1
            try:
                while True:  # from one last word of the phrase to the next
                    at = words.index(phrase[-1], at + 1)
                    start = at - len(phrase) + 1
                    if start >= 0 and words[start:at + 1] == phrase:
                        found.append((start, label))
            except ValueError:
                pass
        return sorted(found)

    def cover(self, words: list[bytes]) -> dict[str, tuple[float, int, int]]:
        """label -> (covered part of its best template, first word, word after the last), of the labels
        covered to MIN_COVER. A find inside a larger one, with more covered words, is part of it: the
        notice of one licence is often that of another with words put in."""
        ids = [self.vocabulary.get(w, -1) for w in words]
        runs: dict[int, list[tuple[int, int, int]]] = {}
        for end, length, state in self.automaton.matches(ids, MIN_MATCH):
            for t, at in self.automaton.ends[state].items():
                runs.setdefault(t, []).append((end - length, at - length, length))
        best: dict[str, tuple[float, int, int, int]] = {}
        for t, found in runs.items():
            total, first, after = chain(found, self.lengths[t])
            part = total / self.lengths[t]
            if part >= MIN_COVER and (part, total) > best.get(self.labels[t], (0.0, 0, 0, 0))[::3]:
                best[self.labels[t]] = (part, first, after, total)
        return {x: c[:3] for x, c in best.items() if not any(
            o[3] > c[3] and o[1] <= c[1] and c[2] <= o[2] for o in best.values())}


def chain(found: list[tuple[int, int, int]], length: int) -> tuple[int, int, int]:
    """The best chain of runs (first word in the text, first in the template, words) that rise in both
    without overlap: (covered words, first word, word after the last).

    Best is most covered words less GAP for each word left out between runs, so a chain ends where the
    next run is too far away, and one of a repeated licence is not drawn out over its copies. A Fenwick
    tree over the template's places holds the best chains that end there: all runs of a text are seen, in
    time linear in them but for a logarithm of the template's length.
    """
    found = sorted(found)
    by_end = sorted(range(len(found)), key=lambda i: found[i][0] + found[i][2])
    value, total, first = ([0.0] * len(found), [0] * len(found), [0] * len(found))
    tree: list[int | None] = [None] * (length + 2)  # run with the best value + GAP * end
    rank = lambda j: value[j] + GAP * (found[j][0] + found[j][2])
    seen, best = 0, None
    for i, (a, b, n) in enumerate(found):
        while seen < len(by_end):
            j = by_end[seen]
            if found[j][0] + found[j][2] > a:
                break
            at = found[j][1] + found[j][2] + 1
            while at < len(tree):
                if tree[at] is None or rank(j) > rank(tree[at]):
                    tree[at] = j
                at += at & -at
            seen += 1
        at, before = b + 1, None
        while at:
            if tree[at] is not None and (before is None or rank(tree[at]) > rank(before)):
                before = tree[at]
            at -= at & -at
        gain = rank(before) - GAP * a if before is not None else 0.0
        value[i], total[i], first[i] = n + max(gain, 0.0), n, a
        if gain > 0:
            total[i], first[i] = n + total[before], first[before]
        if best is None or value[i] > value[best]:
            best = i
    return (total[best], first[best], found[best][0] + found[best][2]) if found else (0, 0, 0)


SCHEMA = ("doc_id string, n_words long, n_base long, first_word long, last_word long, "
          "base_labels string, labels string, score double, spans string")


def scan_documents(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word and last_word (starts of base places, else null),
    base_labels, labels (with those of covered templates), score (1 with a base place, else the
    largest cover that reaches MIN_COVER, else 0) and spans (label:first:end of covered templates).
    A null or empty text has no words and no labels."""
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(templates, phrases)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                words = split_words(text)
                base = scanner.base(words)
                covers = scanner.cover(words)
                own = {label for _, label in base}
                out.append((doc_id, len(words), len(base), base[0][0] if base else None,
                            base[-1][0] if base else None, ",".join(sorted(own)),
                            ",".join(sorted(own | set(covers))),
                            1.0 if base else max((min(1.0, c[0]) for c in covers.values()),
                                                 default=0.0),
                            ",".join(f"{x}:{c[1]}:{c[2]}" for x, c in sorted(covers.items()))))
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])
            yield frame.astype({"first_word": "Int64", "last_word": "Int64"})

    found = docs.select(as_text("doc_id"), "text").mapInPandas(scan, SCHEMA)
    return found.select(as_id("doc_id"), *found.columns[1:])
