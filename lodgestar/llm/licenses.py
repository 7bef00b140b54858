"""License notices by winnowed fingerprints and banded alignment."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Mapping
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgestar.llm.substring_dedup import phrase_hashes, word_hashes
from lodgestar.llm.text import by_batch

#: Words of a fingerprint; of so many neighbours the smallest is kept (winnowing).
PHRASE, WINNOW = 3, 2
#: Places by which template and text may drift apart.
BAND = 8
COVERAGE = 0.8

# Short notices and openings of common licenses (fixed values); whole texts and headers are the files
# of ``license_texts``.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files (the Software), to deal in the Software without "
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the License); you may not use "
    "this file except in compliance with the License. You may obtain a copy of the License at",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the "
    "terms of the GNU General Public License as published by the Free Software Foundation",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
} | {
    path.stem: path.read_text(encoding="utf-8")
    for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
}

_MARKS = re.compile(r"[^\w\s]+|_+")


def plain_words(text: str | None) -> list[bytes]:
    """Words in lower case without marks."""
    return _MARKS.sub("", (text or "").lower()).encode().split()


def winnowed(hashes: np.ndarray) -> np.ndarray:
    """Positions of the smallest of each ``WINNOW`` consecutive hashes."""
    if len(hashes) <= WINNOW:
        return np.arange(len(hashes))[hashes == hashes.min()] if len(hashes) else np.arange(0)
    views = np.lib.stride_tricks.sliding_window_view(hashes, WINNOW)
    return np.unique(views.argmin(axis=1) + np.arange(len(views)))


def align(template: list[bytes], words: list[bytes], start: int) -> tuple[int, int, int]:
    """Matched words, and the range of ``words`` that the matches span.

    The template is laid on ``words`` at ``start`` and may drift by ``BAND`` places; leading and
    trailing words of the text are free, a skipped word costs what a match gains.
    """
    width = 2 * BAND + 1
    # best[i][j]: template words before i, text up to start + i + j - BAND.
    best = np.zeros((len(template) + 1, width), np.int32)
    step = np.zeros_like(best)
    for i, word in enumerate(template, 1):
        for j in range(width):
            at = start + i + j - BAND - 1
            same = 0 <= at < len(words) and words[at] == word
            options = [(best[i - 1, j] + (1 if same else -1), 1 if same else 2)]
            if j + 1 < width:
                options.append((best[i - 1, j + 1] - 1, 3))
            if j:
                options.append((best[i, j - 1] - 1, 4))
            best[i, j], step[i, j] = max(options, key=lambda o: o[0])
    i, j = len(template), int(best[-1].argmax())
    matched: list[int] = []
    while i:
        move = step[i, j]
        if move == 1:
            matched.append(start + i + j - BAND - 1)
        if move in (1, 2):
            i -= 1
        elif move == 3:
            i, j = i - 1, j + 1
        else:
            j -= 1
    if not matched:
        return 0, start, start
    return len(matched), matched[-1], matched[0] + 1


@dataclass
class Index:
    names: list[str]
    words: list[list[bytes]]
    hashes: np.ndarray  # sorted; with the template and position of each
    owner: np.ndarray
    at: np.ndarray
    #: Per word the templates and positions that it is a key of.
    keys: dict[bytes, list[tuple[int, int]]]
    counts: list[Counter[bytes]]

    @classmethod
    def of(cls, templates: Mapping[str, str], coverage: float = COVERAGE) -> Index:
        names = sorted(templates)
        words = [plain_words(templates[n]) for n in names]
        parts = [phrase_hashes(word_hashes(w), PHRASE, 31) for w in words]
        kept = [winnowed(p) for p in parts]
        hashes = np.concatenate([p[k] for p, k in zip(parts, kept)] or [np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(names)), [len(k) for k in kept])
        at = np.concatenate(kept or [np.zeros(0, np.int64)])
        order = np.argsort(hashes, kind="stable")
        # An alignment leaves out fewer words than a template has keys, so it holds one of them. Long
        # words are rare ones.
        keys = defaultdict(list)
        for number, w in enumerate(words):
            size = math.floor(len(w) * (1 - coverage) + 1e-9) + 1
            for place in sorted(range(len(w)), key=lambda n: (-len(w[n]), n))[:size]:
                keys[w[place]].append((number, place))
        counts = [Counter(w) for w in words]
        return cls(names, words, hashes[order], owner[order], at[order], dict(keys), counts)

    def key_seeds(self, words: list[bytes], coverage: float) -> set[tuple[int, int, int]]:
        """Template, start and position of each key, where enough words of the template are near."""
        have = Counter(words)
        possible = {
            n
            for n, c in enumerate(self.counts)
            if sum(min(k, have[w]) for w, k in c.items()) >= coverage * len(self.words[n])
        }
        if not possible:
            return set()
        near: dict[tuple[int, int], bool] = {}
        found = set()
        for position, word in enumerate(words):
            for number, place in self.keys.get(word, ()):
                if number not in possible:
                    continue
                spot = (number, position - place)
                if spot not in near:
                    size = len(self.words[number])
                    window = Counter(words[max(0, spot[1] - BAND) : max(0, spot[1] + size + BAND)])
                    same = sum(min(k, window[w]) for w, k in self.counts[number].items())
                    near[spot] = same >= coverage * size
                if near[spot]:
                    found.add((*spot, position))
        return found

    def notices(self, words: list[bytes], coverage: float) -> list[tuple[str, float, int, int, int]]:
        """Template, coverage, matched words and span of each notice; spans of one do not overlap."""
        parts = phrase_hashes(word_hashes(words), PHRASE, 31)
        kept = winnowed(parts)
        wanted = parts[kept]
        low = np.searchsorted(self.hashes, wanted, "left")
        high = np.searchsorted(self.hashes, wanted, "right")
        seeds = sorted(
            {
                (int(self.owner[k]), int(kept[n]) - int(self.at[k]), int(kept[n]))
                for n in np.flatnonzero(high > low)
                for k in range(low[n], high[n])
            }
            | self.key_seeds(words, coverage)
        )
        found: list[tuple[str, float, int, int, int]] = []
        for number in dict.fromkeys(s[0] for s in seeds):
            template = self.words[number]
            tried: set[int] = set()
            spans: list[tuple[int, int, int]] = []
            for _, start, _ in (s for s in seeds if s[0] == number):
                if start in tried:
                    continue
                tried.add(start)
                matched, first, last = align(template, words, start)
                if matched >= coverage * len(template):
                    spans.append((matched, first, last))
            end = -1
            # Of overlapping spans the fullest stays.
            chosen: list[tuple[int, int, int]] = []
            for matched, first, last in sorted(spans, key=lambda s: (-s[0], s[2] - s[1], s[1])):
                if all(last <= a or first >= b for _, a, b in chosen):
                    chosen.append((matched, first, last))
            for matched, first, last in sorted(chosen, key=lambda s: s[1]):
                found.append((self.names[number], matched / len(template), matched, first, last))
                end = max(end, last)
        return found


@lru_cache(maxsize=2)
def _index(templates: tuple[tuple[str, str], ...], coverage: float) -> Index:
    return Index.of(dict(templates), coverage)


def scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    coverage: float = COVERAGE,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(key, license, coverage, matched_words, first_word, last_word)`` per notice found.

    Every whole text is winnowed and looked up in the inverted index of the templates; a common
    fingerprint makes a candidate, as does one of the key words that no alignment of ``coverage`` can
    leave out all of, and banded alignment decides. Words are compared in lower case
    without marks, ``last_word`` is exclusive. Documents without a notice, null and empty texts
    have no row. Repeated rows are reported as often as they come.
    """
    chosen = tuple(sorted(templates.items()))
    names = ("id", "license", "coverage", "matched_words", "first_word", "last_word")

    def handle(rows: dict[str, list]) -> dict[str, list]:
        index = _index(chosen, coverage)
        found = [
            (doc, *notice)
            for doc, body in zip(rows["id"], rows["text"], strict=True)
            for notice in index.notices(plain_words(body), coverage)
        ]
        return {name: [row[n] for row in found] for n, name in enumerate(names)}

    types = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
    narrow = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    result = narrow.mapInArrow(
        by_batch(handle, pa.schema(list(zip(names, types)))),
        "id long, license string, coverage double, matched_words long, first_word long, last_word long",
    )
    return result.withColumnRenamed("id", key)
