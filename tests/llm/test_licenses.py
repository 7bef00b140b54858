"""License notices against an alignment of all templates everywhere."""

import random

import pytest

from lodgestar.llm import licenses
from lodgestar.llm.licenses import BAND, COVERAGE, TEMPLATES, Index, align, plain_words

INDEX = Index.of(TEMPLATES)


def _found(text):
    return {(name, matched) for name, _, matched, *_ in INDEX.notices(plain_words(text), COVERAGE)}


def _brute(words, names):
    best = {}
    for name in names:
        template = plain_words(TEMPLATES[name])
        for start in range(-BAND, len(words) + BAND):
            matched = align(template, words, start)[0]
            if matched >= COVERAGE * len(template):
                best[name] = max(matched, best.get(name, 0))
    return set(best.items())


@pytest.mark.parametrize(
    ("text", "license", "matched"),
    [
        ("Released under our MIT License", "MIT", 4),
        ("Licensed under the CC BY-NC 4.0", "CC-BY-NC-4.0", 5),
    ],
)
def test_short_notices_with_a_changed_word(text, license, matched):
    assert (license, matched) in _found(text)


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_whole_texts_are_found_whole(name):
    words = plain_words(f"some words before {TEMPLATES[name]} and after")
    found = {n: (first, last) for n, _, _, first, last in INDEX.notices(words, COVERAGE)}
    assert found[name] == (3, len(words) - 2)


def test_notices_equal_alignment_everywhere():
    draw = random.Random(1)
    short = [name for name in TEMPLATES if len(plain_words(TEMPLATES[name])) <= 14]
    for _ in range(40):
        words = TEMPLATES[draw.choice(short)].split()
        for _ in range(draw.randint(0, 2)):
            words[draw.randrange(len(words))] = draw.choice(["our", "and", "license"])
        words.insert(draw.randrange(len(words)), "new")
        text = " ".join(["filler"] * 4 + words + ["filler"] * 4)
        found = {(n, m) for n, m in _found(text) if n in short}
        assert found == _brute(plain_words(text), short), text
