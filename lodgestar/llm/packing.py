"""Packing of token sequences into fixed lengths by shortest-pack-first over the length histogram."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodgestar.llm.text import by_batch
from lodgestar.session import stage

LENGTH = 1024
END_ID = 0
#: Rows that are numbered together.
RANK_ROWS = 20_000

# --- tokens -------------------------------------------------------------------------------------

# A text of other characters is encoded by ``tokenizers`` itself: there the two libraries could
# differ in what they take for letters, digits and spaces.
_PLAIN = r"[\t\n\r -~À-ÖØ-öø-ſ]*"
# The split of byte-level tokenizers of this kind (fixed value).
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """The characters by which vocabulary files of byte-level tokenizers write bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Encoder:
    """Ids of texts by a byte-level ``tokenizers`` file.

    The ids are those of ``tokenizers`` as the file is loaded, so a text that holds a special token
    has that token's id. Plain texts without one take the same vocabulary through ``tiktoken``,
    which is about four times as fast.
    """

    def __init__(self, path: str) -> None:
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = regex.compile(_PLAIN)
        byte_of = _byte_of()
        special = {token.content for token in self.tokenizer.get_added_tokens_decoder().values()}
        self.special = regex.compile("|".join(map(regex.escape, sorted(special))) or "(?!)")
        ranks = {
            bytes(byte_of[c] for c in token): number
            for token, number in self.tokenizer.get_vocab().items()
            if token not in special
        }
        self.fast = tiktoken.Encoding(
            "plain", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={}
        )

    def __call__(self, text: str) -> np.ndarray:
        if self.plain.fullmatch(text) and not self.special.search(text):
            return self.fast.encode_to_numpy(text)
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype=np.uint32)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process, which Spark uses for many tasks."""
    return Encoder(path)


def token_pieces(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", length: int = LENGTH
) -> DataFrame:
    """``(key, start, length, ids_crc32, doc_tokens)`` per piece of at most ``length`` ids.

    The ids of a text (null: empty) end with the id 0. Full pieces are cut from the front.
    """

    def handle(rows: dict[str, list]) -> dict[str, list]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = encoder(tokenizer)
        out: dict[str, list] = {name: [] for name in ("id", "start", "length", "crc", "total")}
        for doc, body in zip(rows["id"], rows["text"], strict=True):
            ids = np.append(encode(body or ""), np.uint32(END_ID)).astype("<u4")
            for start in range(0, len(ids), length):
                piece = ids[start : start + length]
                out["id"].append(doc)
                out["start"].append(start)
                out["length"].append(len(piece))
                out["crc"].append(zlib.crc32(piece.tobytes()))
                out["total"].append(len(ids))
        return out

    narrow = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    schema = pa.schema([(c, pa.int64()) for c in ("id", "start", "length", "crc", "total")])
    rows = narrow.mapInArrow(
        by_batch(handle, schema, 64), "id long, start long, length long, crc long, total long"
    )
    return rows.selectExpr(
        f"id AS `{key}`", "start", "length", "crc AS ids_crc32", "total AS doc_tokens"
    )


# --- patterns -----------------------------------------------------------------------------------


@dataclass
class Pattern:
    """``count`` sequences that hold the same lengths, as (length, times) in order."""

    count: int
    parts: list[tuple[int, int]]

    def with_piece(self, count: int, length: int) -> Pattern:
        parts = list(self.parts)
        if parts and parts[-1][0] == length:
            parts[-1] = (length, parts[-1][1] + 1)
        else:
            parts.append((length, 1))
        return Pattern(count, parts)


def pack_histogram(histogram: dict[int, int], length: int = LENGTH) -> list[Pattern]:
    """Packs for ``{piece length: number}``: longest first, each into the emptiest pack.

    The work is on patterns with counts, never on pieces, so it depends on the number of lengths
    only: placing a length uses up a pattern or the length, and splits one pattern at most.
    """
    open_packs: dict[int, list[Pattern]] = {}  # by free space
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            space = max((s for s in open_packs if s >= size), default=None)
            if space is None:
                # As many of this length as a sequence holds; the rest opens one more.
                times = length // size
                whole, rest = divmod(left, times)
                for count, number in ((whole, times), (1, rest)):
                    if count and number:
                        made = Pattern(count, [(size, number)])
                        open_packs.setdefault(length - size * number, []).append(made)
                break
            pattern = open_packs[space].pop()
            if not open_packs[space]:
                del open_packs[space]
            used = min(left, pattern.count)
            if used < pattern.count:
                kept = Pattern(pattern.count - used, pattern.parts)
                open_packs.setdefault(space, []).append(kept)
            open_packs.setdefault(space - size, []).append(pattern.with_piece(used, size))
            left -= used
    return [p for space in sorted(open_packs) for p in open_packs[space]]


def _slots(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """Per length its places, as rows (first rank, first sequence, sequences, offset)."""
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for pattern in patterns:
        offset = 0
        for size, times in pattern.parts:
            for _ in range(times):
                rank = ranks.get(size, 0)
                slots.setdefault(size, []).append((rank, sequence, pattern.count, offset))
                ranks[size] = rank + pattern.count
                offset += size
        sequence += pattern.count
    return {size: np.array(rows, dtype=np.int64) for size, rows in slots.items()}


# --- join back ----------------------------------------------------------------------------------


def _ranked(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``rank`` from 0 within each length, without a task per length.

    A length may have most pieces, so it is cut into groups by hash. Groups are counted, their
    first ranks are prefix sums of counts, and only within a group rows are sorted.
    """
    groups = max(1, pieces.count() // RANK_ROWS)
    order = [F.col(name) for name in pieces.columns]
    pieces = pieces.withColumn("group_", F.pmod(F.xxhash64(*order), F.lit(groups)))
    counts = pieces.groupBy("length", "group_").agg(F.count("*").alias("n_"))
    upto = Window.partitionBy("length").orderBy("group_")
    offsets = counts.select("length", "group_", (F.sum("n_").over(upto) - F.col("n_")).alias("at_"))
    within = Window.partitionBy("length", "group_").orderBy(*order)
    numbered = pieces.withColumn("rank_", F.row_number().over(within) - 1)
    return numbered.join(offsets, ["length", "group_"]).withColumn(
        "rank", F.col("rank_") + F.col("at_")
    )


def pack(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    Only the histogram of lengths (``length`` rows at most) and the patterns made from it meet on
    the driver. Equal rows of ``pieces`` take different places. No pieces, no sequences.
    """
    columns = pieces.columns
    counted = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    patterns = pack_histogram({row["length"]: row["n"] for row in counted}, length)
    slots = pieces.sparkSession.sparkContext.broadcast(_slots(patterns))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            sequence = np.zeros(len(rows), dtype=np.int64)
            offset = np.zeros(len(rows), dtype=np.int64)
            sizes = rows["length"].to_numpy()
            ranks = rows["rank"].to_numpy()
            order = np.argsort(sizes, kind="stable")
            cuts = np.flatnonzero(np.diff(sizes[order])) + 1
            for part in np.split(order, cuts) if len(rows) else []:
                table = slots.value[int(sizes[part[0]])]
                at = np.searchsorted(table[:, 0], ranks[part], side="right") - 1
                sequence[part] = table[at, 1] + ranks[part] - table[at, 0]
                offset[part] = table[at, 3]
            rows = rows[columns]
            yield rows.assign(sequence_id=sequence, offset=offset)

    ranked = _ranked(pieces).select(*columns, "rank")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInPandas(place, schema + ", sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", length: int = LENGTH
) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most ``length`` ids.

    Null and empty texts are the end id alone. Repeated rows are packed as often as they come. A
    null id stays null. Extra columns of ``docs`` are not needed and not returned.
    """
    return pack(stage(token_pieces(docs, tokenizer, key, text, length), "token-pieces"), length)
