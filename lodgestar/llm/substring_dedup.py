"""Removal of repeated passages by automata of recurring phrases.

A window is ``WINDOW`` consecutive words. Its anchor is its phrase of ``ANCHOR`` words with the smallest
hash; equal windows have equal anchors, so only anchors have to be counted over the corpus, a fifth of
the words. The smallest document with an anchor owns it. Then:

1. *Confirm*: anchors that occur in two documents recur; the windows around them are the passages.
2. *Compile*: phrases of the owners' passages, such that every window holds one, are compiled into
   Aho-Corasick automata, sharded by owner. A phrase carries the words around it in its passages and
   the smallest document that holds each of these windows.
3. *Stream*: every passage of every other document is read by the automaton of its owner's shard, which
   locates all occurrences of the phrases. A window around one is repeated if its words are those of a
   window of a smaller document; nothing else decides.
4. Passages may share an anchor with its owner but not the window. Windows that no automaton has found
   and that recur among themselves are confirmed by their own hash, owned by their smallest document,
   and go through steps 2 and 3 again, until none is left.

Hashes only bring equal windows together; words are compared by the automata. Documents without a
recurring anchor have no repeated window and are not read again before the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgestar.llm.text import by_batch, split_words
from lodgestar.session import stage

WINDOW = 13
ANCHOR = 5
#: Words of a phrase of the automata, and the distance of phrases such that every window holds one.
PHRASE = 9
STEP = WINDOW - PHRASE + 1
#: Characters of passages that are searched together.
SHARD_CHARS = 1 << 20
#: Words are spelled by this many signs, so that an automaton has one node for a word.
SIGNS = 0xD000

_BASE = 0x9E3779B97F4A7C15
_WORD, _PHRASE, _FULL = 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F


# --- hashes -------------------------------------------------------------------------------------


def _mixed(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all bits."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(_WORD)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(_WORD)
    return values ^ (values >> np.uint64(32))


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, up to a power of two of them."""

    def table(base: int) -> np.ndarray:
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    return table(_BASE), table(pow(_BASE, -1, 1 << 64))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, computed over the bytes of all words at once."""
    if not words:
        return np.zeros(0, np.uint64)
    joined = np.frombuffer(b" ".join(words), dtype=np.uint8).astype(np.uint64)
    power, inverse = _powers(max(1 << 16, 1 << int(len(joined)).bit_length()))
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum((joined + np.uint64(1)) * power[: len(joined)], out=sums[1:])
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    polynomial = (sums[starts + lengths] - sums[starts]) * inverse[starts]
    return _mixed(polynomial + lengths.astype(np.uint64) * np.uint64(_PHRASE))


def phrase_hashes(words: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hashes of all phrases of ``size`` consecutive word hashes."""
    count = max(0, len(words) - size + 1)
    total = np.zeros(count, np.uint64)
    for at in range(size):
        total = total * np.uint64(base) + words[at : at + count]
    return _mixed(total)


def anchors(words: np.ndarray) -> np.ndarray:
    """Per window the hash of its anchor."""
    least = phrase_hashes(words, ANCHOR, _PHRASE)
    span = WINDOW - ANCHOR + 1
    if len(least) < span:
        return np.zeros(0, np.uint64)
    width = 1  # phrases over which the minimum is taken so far
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return least


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Ranges (first word, word after the last) that windows at sorted ``starts`` cover."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > WINDOW) + 1
    return [(int(p[0]), int(p[-1]) + WINDOW) for p in np.split(starts, breaks)]


# --- 1. confirm ---------------------------------------------------------------------------------


def _anchor_rows(docs: DataFrame) -> DataFrame:
    def handle(rows: dict[str, list]) -> dict[str, list]:
        hashes, ids = [], []
        for doc, text in zip(rows["id"], rows["text"], strict=True):
            own = np.unique(anchors(word_hashes(split_words(text))))
            hashes.append(own)
            ids.append(np.full(len(own), doc, np.int64))
        return {"h": np.concatenate(hashes).view(np.int64), "id": np.concatenate(ids)}

    schema = pa.schema([("h", pa.int64()), ("id", pa.int64())])
    return docs.select("id", "text").mapInArrow(by_batch(handle, schema), "h long, id long")


_PIECES = [("owner", pa.int64()), ("id", pa.int64()), ("content", pa.int64()), ("at", pa.int64())]


def _by_anchor(words: list[bytes]) -> np.ndarray:
    """The hash of each window's anchor."""
    return anchors(word_hashes(words))


def _by_window(words: list[bytes]) -> np.ndarray:
    """The hash of each window."""
    return phrase_hashes(word_hashes(words), WINDOW, _FULL)


def _passages(docs: DataFrame, marks: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    """Passages of documents with their recurring marks ``(h, owner)``: one row per owner and run.

    ``marks`` gives the hash by which a window is told to recur.
    """

    def handle(rows: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {n: [] for n in ("owner", "id", "content", "at", "piece")}
        columns = (rows[n] for n in ("id", "content", "text", "h", "owner"))
        for doc, content, text, hashes, owners in zip(*columns, strict=True):
            words = split_words(text)
            known = np.array(hashes, np.int64).view(np.uint64)
            order = np.argsort(known)
            known, owner_of = known[order], np.array(owners, np.int64)[order]
            wanted = marks(words)
            place = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            recurs = known[place] == wanted
            owner_at = owner_of[place]
            for owner in np.unique(owner_at[recurs]).tolist():
                for first, last in _runs(np.flatnonzero(recurs & (owner_at == owner))):
                    out["owner"].append(owner)
                    out["id"].append(doc)
                    out["content"].append(content)
                    out["at"].append(first)
                    out["piece"].append(b" ".join(words[first:last]).decode())
        return out

    schema = pa.schema([*_PIECES, ("piece", pa.string())])
    columns = ("id", "content", "text", "h", "owner")
    return docs.select(*columns).mapInArrow(
        by_batch(handle, schema), "owner long, id long, content long, at long, piece string"
    )


# --- 2. and 3. compile and stream ----------------------------------------------------------------


class Phrases:
    """Phrases of owners' passages as an automaton over words, with the words around them.

    Of a passage every ``STEP``-th phrase of ``PHRASE`` words is in the automaton, so each of its
    windows holds exactly one of them. The words of the window before and after the phrase are kept
    beside it. Each word of the passages is spelled by one sign, or by two where there are too many;
    all other words are spelled alike by a sign that no phrase holds.
    """

    def __init__(self, passages: list[list[bytes]], holders: list[int]) -> None:
        self.codes: dict[bytes, int] = {}
        for words in passages:
            for word in words:
                self.codes.setdefault(word, len(self.codes) + 1)
        self.width = 1 if len(self.codes) < SIGNS - 1 else 2
        self.automaton = ahocorasick.Automaton()
        numbers: list[int] = []  # of the phrases, in the order of their places
        places = [np.zeros((3, 0), np.int64)]
        begin, coded = 0, [np.zeros(0, np.int64)]
        for words in passages:
            own = self._coded(words)
            text, size = self._spelled(own), PHRASE * self.width
            at = np.arange(0, max(0, len(words) - PHRASE + 1), STEP)
            for start in at.tolist():
                phrase = text[start * self.width : start * self.width + size]
                number = self.automaton.get(phrase, len(self.automaton))
                if number == len(self.automaton):
                    self.automaton.add_word(phrase, number)
                numbers.append(number)
            ends = np.full(len(at), begin + len(words))
            places.append(np.stack([at + begin, np.full(len(at), begin), ends]))
            coded.append(own)
            begin += len(words)
        self.automaton.make_automaton()
        self.base = len(self.codes) + 1
        at, begins, ends = np.concatenate(places, axis=1)
        of = np.repeat(np.array(holders, np.int64), [len(p[0]) for p in places[1:]])
        all_coded, number = np.concatenate(coded), np.array(numbers, np.int64)
        self.around = []
        for before in range(STEP):
            some = (at - before >= begins) & (at - before + WINDOW <= ends)
            tables, level = [], number[some]
            for away in _around(before):
                keys = level * self.base + all_coded[at[some] + away]
                table, level = np.unique(keys, return_inverse=True)
                tables.append(table)
            smallest = np.full(len(tables[-1]), np.iinfo(np.int64).max)
            np.minimum.at(smallest, level, of[some])
            self.around.append((tables, smallest))

    def _coded(self, words: list[bytes]) -> np.ndarray:
        code = self.codes.get
        return np.array([code(word, 0) for word in words], np.int64)

    def _spelled(self, codes: np.ndarray) -> str:
        if self.width == 2:
            codes = np.stack([codes // SIGNS, codes % SIGNS], axis=1).ravel()
        return codes.astype("<u2").tobytes().decode("utf-16-le")

    def occurrences(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """First word and smallest holder of every window of ``words`` that a passage has."""
        starts, smallest = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if not len(self.automaton):
            return starts[0], smallest[0]
        codes = self._coded(words)
        kind = [("end", np.int64), ("number", np.int64)]
        found = np.fromiter(self.automaton.iter(self._spelled(codes)), kind)
        found = found[(found["end"] + 1) % self.width == 0]
        at = (found["end"] + 1) // self.width - PHRASE
        for before, (tables, holders) in enumerate(self.around):
            fits = (at >= before) & (at - before + WINDOW <= len(codes))
            here, level = at[fits], found["number"][fits]
            for away, table in zip(_around(before), tables):
                if not len(table):
                    here = here[:0]
                    break
                keys = level * self.base + codes[here + away]
                level = np.minimum(np.searchsorted(table, keys), len(table) - 1)
                known = table[level] == keys
                here, level = here[known], level[known]
            if len(here):
                starts.append(here - before)
                smallest.append(holders[level])
        return np.concatenate(starts), np.concatenate(smallest)


def _around(before: int) -> list[int]:
    """Places, counted from a phrase, of the other words of the window that starts ``before`` it."""
    return [*range(-before, 0), *range(PHRASE, WINDOW - before)]


#: Stands between passages that are read as one text; no word is empty.
_BREAK = b""


def _joined(pieces: pd.Series) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All passages as one list of words, and per window its passage and whether it is in one."""
    parts = [piece.encode().split(b" ") for piece in pieces]
    words = [word for part in parts for word in (*part, _BREAK)][:-1]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    piece = np.repeat(np.arange(len(parts)), sizes + 1)[:-1]
    ends = np.cumsum(sizes + 1) - 1  # where the breaks are
    starts = np.arange(max(0, len(words) - WINDOW + 1))
    return words, piece[starts], starts + WINDOW <= ends[piece[starts]]


_NOTHING = {"id": [], "content": [], "starts": [], "ends": [], "h": []}


def _search(group: pd.DataFrame) -> pd.DataFrame:
    """Of the passages of one shard, repeated ranges, and windows that no phrase has matched."""
    is_own = group["id"] == group["owner"]
    own, stream = group[is_own], group[~is_own]
    if not len(stream):
        return pd.DataFrame(_NOTHING)
    phrases = Phrases([p.encode().split(b" ") for p in own["piece"]], own["id"].tolist())
    words, piece, whole = _joined(stream["piece"])
    ids, contents, firsts = (stream[n].to_numpy() for n in ("id", "content", "at"))
    # Word 0 of each passage in the joined list, to which breaks add one word each.
    sizes = np.fromiter((p.count(" ") + 2 for p in stream["piece"]), np.int64, len(stream))
    offset = firsts - np.concatenate([[0], np.cumsum(sizes)[:-1]])
    repeated = np.zeros(len(piece), bool)
    at, holders = phrases.occurrences(words)
    # A window may be found by several phrases, each with holders of its own.
    repeated[at[holders < ids[piece[at]]]] = True
    out = []
    at = np.flatnonzero(repeated)
    if len(at):
        new = (np.diff(at) > WINDOW) | (np.diff(piece[at]) > 0)
        first = at[np.concatenate([[True], new])]
        last = at[np.concatenate([new, [True]])]
        own_of = piece[first]
        found = (ids[own_of], contents[own_of], first + offset[own_of], last + offset[own_of] + WINDOW)
        ranges = pd.DataFrame(dict(zip(_NOTHING, found)))
        # Not through floating point, which would round hashes.
        out.append(ranges.assign(h=pd.array([None] * len(ranges), dtype="Int64")))
    open_ = np.flatnonzero(whole & ~repeated)
    own_of = piece[open_]
    start = open_ + offset[own_of]
    left = {
        "id": ids[own_of],
        "content": contents[own_of],
        "starts": start,
        "ends": start + WINDOW,
        "h": pd.array(
            phrase_hashes(word_hashes(words), WINDOW, _FULL)[open_].view(np.int64), dtype="Int64"
        ),
    }
    return pd.concat([*out, pd.DataFrame(left)], ignore_index=True)


_FOUND = "id long, content long, starts long, ends long, h long"


def _sharded(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``shard`` and ``salt`` so that a group holds about ``SHARD_CHARS`` characters.

    A passage that very many documents share has one owner: its readers are spread over salts, and
    the owner's passages, of one document's length at most, go to each of them.
    """
    sizes = pieces.groupBy("owner").agg(F.sum(F.length("piece")).alias("chars"))
    sizes = stage(sizes, "passage-sizes")
    total = sizes.agg(F.sum("chars")).first()[0] or 0
    shards = max(1, -(-total // SHARD_CHARS))
    large = sizes.where(F.col("chars") > SHARD_CHARS).select(
        "owner", F.ceil(F.col("chars") / SHARD_CHARS).cast("int").alias("salts")
    )
    joined = pieces.join(stage(large, "large-passages"), "owner", "left")
    salts = F.coalesce("salts", F.lit(1))
    every = F.sequence(F.lit(0), salts - 1)
    one = F.array(F.pmod(F.xxhash64("id", "content", "at"), salts).cast("int"))
    # Large owners have shards of their own.
    shard = F.when(F.col("salts").isNull(), F.pmod(F.xxhash64("owner"), F.lit(shards)))
    return joined.select(
        "owner",
        "id",
        "content",
        "at",
        "piece",
        shard.alias("shard"),
        F.when(F.col("salts").isNotNull(), F.col("owner")).alias("large"),
        F.explode(F.when(F.col("id") == F.col("owner"), every).otherwise(one)).alias("salt"),
    )


# --- all ----------------------------------------------------------------------------------------


def _marks() -> Column:
    # No more than a document has words.
    return F.collect_list(F.struct("h", "owner")).alias("held")


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """``(id, content, starts, ends)``: word ranges of ``docs (id, content, text)`` that repeat."""
    named = docs.where("id IS NOT NULL")
    rows = stage(_anchor_rows(named), "anchor-rows")
    recurring = rows.groupBy("h").agg(F.min("id").alias("owner"), F.max("id").alias("last"))
    recurring = stage(recurring.where("owner < last").select("h", "owner"), "anchors")
    held = rows.join(recurring, "h").groupBy("id").agg(_marks())
    held = stage(held.selectExpr("id", "held.h AS h", "held.owner AS owner"), "anchors-held")
    pieces = _passages(named.join(held, "id"), _by_anchor)
    ranges = None
    while True:
        groups = _sharded(stage(pieces, "passages")).groupBy("shard", "large", "salt")
        found = stage(groups.applyInPandas(_search, _FOUND), "passages-found")
        repeated = found.where("h IS NULL").drop("h")
        ranges = repeated if ranges is None else ranges.union(repeated)
        left = found.where("h IS NOT NULL")
        among = left.groupBy("h").agg(F.min("id").alias("owner"), F.max("id").alias("last"))
        among = stage(among.where("owner < last").drop("last"), "windows-left")
        if among.isEmpty():
            break
        held = left.select("id", "content", "h").distinct().join(among, "h")
        held = held.groupBy("id", "content").agg(_marks())
        held = held.selectExpr("id", "content", "held.h AS h", "held.owner AS owner")
        pieces = _passages(named.join(stage(held, "windows-held"), ["id", "content"]), _by_window)
    listed = ranges.groupBy("id", "content").agg(
        F.collect_list(F.struct("starts", "ends")).alias("r")
    )
    return listed.selectExpr("id", "content", "r.starts AS starts", "r.ends AS ends")


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, n_removed, kept_sha256)`` for every row of ``docs``.

    Removes each word that is covered by a window of 13 words whose words also start somewhere in a
    document with a smaller id. Windows are judged on the input. The kept words, joined by a space,
    are hashed.

    Null and empty texts have no words. A null id is not smaller than any and has no smaller one.
    Rows of equal id are the same document to each other, whatever their texts.
    """
    base = docs.select(
        F.col(key).cast("long").alias("id"), F.xxhash64(text).alias("content"), F.col(text).alias("text")
    )
    ranges = stage(repeated_ranges(base), "repeated-ranges")
    joined = base.join(ranges, ["id", "content"], "left").select("id", "text", "starts", "ends")

    def handle(rows: dict[str, list]) -> dict[str, list]:
        counts, removed, digests = [], [], []
        for text_, starts, ends in zip(rows["text"], rows["starts"], rows["ends"], strict=True):
            words = split_words(text_)
            if starts:
                depth = np.zeros(len(words) + 1, np.int64)
                np.add.at(depth, starts, 1)
                np.add.at(depth, ends, -1)
                keep = np.cumsum(depth[:-1]) == 0
                kept = [words[i] for i in np.flatnonzero(keep)]
            else:
                kept = words
            counts.append(len(words))
            removed.append(len(words) - len(kept))
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        return {"id": rows["id"], "n_words": counts, "n_removed": removed, "kept_sha256": digests}

    schema = pa.schema(
        [("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64())]
        + [("kept_sha256", pa.string())]
    )
    result = joined.mapInArrow(
        by_batch(handle, schema), "id long, n_words long, n_removed long, kept_sha256 string"
    )
    return result.withColumnRenamed("id", key)
