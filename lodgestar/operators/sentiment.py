"""Lexicon rating of reviews."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgestar.functions.rating import rating, words

# Rows of the Bloom filter: two longs each, so at most 4 MiB are broadcast whatever the lexicon's size.
BLOOM_ROWS = 1 << 18

# No word of a text and no entry of a lexicon that may match one.
END_OF_TEXT = " "


def fits_broadcast(lexicon: DataFrame) -> bool:
    """Whether Spark's own estimate of the lexicon is below its broadcast threshold."""
    session = lexicon.sparkSession
    threshold = session._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    estimate = lexicon._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return estimate <= threshold


def _bloom_row(word: Column) -> Column:
    return F.xxhash64(word).bitwiseAND(F.lit(BLOOM_ROWS - 1).cast("long"))


def _bloom_bits(word: Column) -> Column:
    """Three of the 64 bits of a word's row, from parts of its hash that do not choose the row."""
    bits = F.lit(0).cast("long")
    for start in (20, 26, 32):
        place = F.shiftrightunsigned(F.xxhash64(word), start).bitwiseAND(F.lit(63).cast("long"))
        one = F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))
        bits = bits.bitwiseOR(one)
    return bits


def bloom_filter(lexicon: DataFrame) -> DataFrame:
    """``(bloom_row, bloom_bits)``: all words of the lexicon in at most ``BLOOM_ROWS`` rows."""
    return lexicon.groupBy(_bloom_row(F.col("word")).alias("bloom_row")).agg(
        F.bit_or(_bloom_bits(F.col("word"))).alias("bloom_bits")
    )


def possible_hits(
    texts: DataFrame, lexicon: DataFrame, *, key: str, text: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Words per text that the lexicon may hold, with their number: key, ``keep``, word, n.

    All other words of a text become one row, whose word starts with a space and has the key, so
    that these rows spread over the join that follows. The Bloom filter is tested and words are
    counted in the task that read the text, before anything is shuffled.
    """
    tokens = texts.select(key, *keep, F.explode_outer(words(F.col(text))).alias("word"))
    word = F.col("word")
    tested = tokens.join(
        F.broadcast(bloom_filter(lexicon)), _bloom_row(word) == F.col("bloom_row"), "left"
    )
    possible = F.col("bloom_bits").bitwiseAND(_bloom_bits(word)) == _bloom_bits(word)
    others = F.concat(F.lit(" "), F.coalesce(F.col(key).cast("string"), F.lit("")))
    kept = tested.select(key, *keep, F.when(possible, word).otherwise(others).alias("word"))
    return kept.groupBy(key, *keep, "word").agg(F.count("*").alias("n"))


def _marked_words(
    texts: DataFrame, *, key: str, text: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Words per text in their order, then one mark: key, ``keep``, word."""
    end = F.lit(END_OF_TEXT)
    found = F.coalesce(F.array_append(words(F.col(text)), end), F.array(end))
    return texts.select(key, *keep, F.explode_outer(found).alias("word"))


def _hashed(lexicon: DataFrame) -> DataFrame:
    # A join on a number takes half the time of one on words; the words decide.
    return lexicon.select(
        F.xxhash64("word").alias("entry_hash"), F.col("word").alias("entry"), "positive", "negative"
    )


def count_hits(
    texts: DataFrame,
    lexicon: DataFrame,
    *,
    key: str,
    text: str,
    keep: Sequence[str] = (),
    prefilter: bool | None = None,
) -> DataFrame:
    """Number of positive and negative words per text: key, ``keep``, positive, negative.

    Words are exploded, looked up and counted again per key. The lexicon has one row per word. While
    Spark broadcasts it, the count before the shuffle brings a text back to one narrow row in the
    task that read it, so no text and no word is shuffled. A lexicon above the threshold is first
    reduced to a Bloom filter of bounded size, and only words that pass it are shuffled to the
    lexicon, once per text with their number; AQE splits hot ones. ``prefilter`` chooses the way,
    which :func:`fits_broadcast` does otherwise. Texts without any hit stay: only hits and one mark per
    text are counted, as most words are no hits.
    """
    if prefilter is None:
        prefilter = not fits_broadcast(lexicon)
    # Words of a text hold no spaces.
    lexicon = lexicon.where(~F.contains("word", F.lit(" ")))
    if prefilter:
        tokens = possible_hits(texts, lexicon, key=key, text=text, keep=keep)
        number = F.col("n")
        hits = tokens.join(lexicon, "word", "left")
    else:
        end = F.lit(END_OF_TEXT)
        tokens = _marked_words(texts, key=key, text=text, keep=keep)
        number = F.when(F.col("word") == F.col("entry"), 1)
        entries = _hashed(lexicon)
        met = tokens.join(entries, F.xxhash64("word") == F.col("entry_hash"), "left")
        hits = met.where((F.col("word") == F.col("entry")) | (F.col("word") == end))
    return hits.groupBy(key, *keep).agg(
        F.coalesce(F.sum(F.col("positive") * number), F.lit(0)).alias("positive"),
        F.coalesce(F.sum(F.col("negative") * number), F.lit(0)).alias("negative"),
    )


def count_in_task(
    texts: DataFrame, lexicon: DataFrame, *, key: str, text: str, keep: str
) -> DataFrame:
    """As :func:`count_hits` of a lexicon that fits a broadcast, without a shuffle: ``keep`` may be wide.

    A task has the words of a text in their order with the text's mark behind them, and the join
    keeps that order as its other side is broadcast, so one pass over the hits adds them up. ``keep``
    goes with the mark alone. Hits that are not in this order fail the job.
    """
    word, end = F.col("word"), F.lit(END_OF_TEXT)
    tokens = _marked_words(texts, key=key, text=text, keep=[keep])
    entries = _hashed(lexicon.where(~F.contains("word", F.lit(" "))))
    # A mark meets no entry, so each text has one.
    number = F.when(word != end, F.xxhash64(word))
    met = tokens.join(F.broadcast(entries), number == F.col("entry_hash"), "left")
    hits = met.where((word == F.col("entry")) | (word == end)).select(
        key,
        (word == end).alias("is_end"),
        *[F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name) for name in ("positive", "negative")],
        F.when(word == end, F.col(keep)).alias(keep),
    )
    names = (key, keep, "positive", "negative")
    return hits.mapInArrow(_add_up(names), T.StructType([hits.schema[name] for name in names]))


def _add_up(names: Sequence[str]):
    """Sums of the last two columns up to each mark; the first column tells which text a row is of."""
    key, keep, *measures = names

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, before = None, dict.fromkeys(measures, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy()
            ends = batch.column("is_end").to_numpy(zero_copy_only=False)
            mixed = (keys[1:] != keys[:-1]) & ~ends[:-1]
            if mixed.any() or open_key not in (None, keys[0]):
                raise RuntimeError("the words of a text do not follow each other")
            marks = np.flatnonzero(ends)
            sums = {}
            for name in measures:
                total = np.cumsum(batch.column(name).to_numpy()) + before[name]
                sums[name] = np.diff(total[marks], prepend=0)
                before[name] = total[-1] - (total[marks[-1]] if len(marks) else 0)
            open_key = None if ends[-1] else keys[-1]
            taken = pa.array(marks)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key).take(taken),
                    batch.column(keep).take(taken),
                    *[pa.array(sums[name], pa.int64()) for name in measures],
                ],
                names=list(names),
            )
        if open_key is not None:
            raise RuntimeError("a text has no mark")

    return add


def rate_texts(
    texts: DataFrame,
    lexicon: DataFrame,
    *,
    key: str,
    text: str,
    keep: Sequence[str] = (),
    prefilter: bool | None = None,
) -> DataFrame:
    """One row per text: key, ``keep``, positive, negative, rating."""
    counts = count_hits(texts, lexicon, key=key, text=text, keep=keep, prefilter=prefilter)
    return counts.withColumn("rating", rating(F.col("positive"), F.col("negative")))


def pack_copies(rows: DataFrame, *, key: str, text: str) -> DataFrame:
    """Rows with equal texts in one: key (that of the first), text, ``rows`` (the other columns, key
    included, of each).

    Only rows of one Arrow batch are put together, in the task that has them: nothing is shuffled,
    and a packed row is bounded by the batch. Further batches may hold the same text again.
    """
    others = [name for name in rows.columns if name != text]
    fields = T.StructType([rows.schema[name] for name in others])
    schema = T.StructType(
        [rows.schema[key], rows.schema[text], T.StructField("rows", T.ArrayType(fields))]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = pc.dictionary_encode(batch.column(text), null_encoding="encode")
            places = texts.indices.to_numpy()
            order = np.argsort(places, kind="stable")
            starts = np.searchsorted(places[order], np.arange(len(texts.dictionary) + 1))
            taken = pa.array(order)
            members = pa.StructArray.from_arrays(
                [batch.column(name).take(taken) for name in others], names=others
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key).take(taken.take(pa.array(starts[:-1]))),
                    texts.dictionary,
                    pa.ListArray.from_arrays(pa.array(starts, pa.int32()), members),
                ],
                names=[key, text, "rows"],
            )

    return rows.select(*others, text).mapInArrow(pack, schema)


def rate_reviews(
    reviews: DataFrame, lexicon: DataFrame, *, in_task: bool = False
) -> DataFrame:
    """Parsed reviews -> review_id, listing_id, date, rating (and reject); one row per review.

    Reviews of one text that a task reads near each other are rated once. A lexicon above the
    threshold, for which rows per word are shuffled, takes them one by one, so those rows stay narrow.
    ``in_task`` shuffles nothing below that threshold, for reviews with columns too wide for it.
    """
    keep = [name for name in ("listing_id", "date", "reject") if name in reviews.columns]
    names = ["review_id", *keep]
    reviews = reviews.select(*names, "comment")
    if not fits_broadcast(lexicon):
        rated = rate_texts(
            reviews, lexicon, key="review_id", text="comment", keep=keep, prefilter=True
        )
        return rated.select(*names, "rating")
    packed = pack_copies(reviews, key="review_id", text="comment")
    if in_task:
        counts = count_in_task(packed, lexicon, key="review_id", text="comment", keep="rows")
        rated = counts.withColumn("rating", rating(F.col("positive"), F.col("negative")))
    else:
        rated = rate_texts(
            packed, lexicon, key="review_id", text="comment", keep=["rows"], prefilter=False
        )
    return rated.select(F.explode("rows").alias("row"), "rating").select(
        *[F.col(f"row.{name}").alias(name) for name in names], "rating"
    )
