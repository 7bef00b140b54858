"""Secrets in texts: candidates by form, false positives removed by a random forest."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgestar.llm.findings import WORDS, example_texts
from lodgestar.session import stage

#: Findings of each class that the forest learns from.
SAMPLE = 5_000
#: A dictionary word is a run of at least four letters in this share of the different texts, in two at
#: least. So there are at most as many words as a thousand texts hold, whatever the corpus.
COMMON = 0.001
#: Relative error of the counts of different texts.
_ERROR = 0.1

# A noncharacter stands before each value of a secret-like name.
_MARK = "\uFDD0"
_KEY = r"[A-Za-z0-9_\-+/]"
# Each maximal run of key characters is tried once, at its start, wherever it stands; with it come
# the dotted parts on both sides and the padding of base64.
_TOKEN = (
    rf"(?<!{_KEY})(?:{_KEY}{{1,15}}+\.){{0,8}}+{_KEY}{{16,}}+(?:\.{_KEY}++){{0,8}}+"
    rf"(?:={{1,2}}(?![^\s\"'`,;)}}\]&<])(?![\s\"'`]{{0,9}}{_MARK}))?+"
)
_JWT = r"^eyJ[A-Za-z0-9_\-]+(\.[A-Za-z0-9_\-]*){2,4}$"
_SPACE = r"[ \t\r\n]{0,8}+"
_NAMED = (
    r"((?i:token|secret|passw|api[_-]?key|auth|credential)[A-Za-z0-9_\-.]{0,64}+[\"'`\])]{0,2}+"
    rf"{_SPACE}(?:=>|:=|={{1,3}}|:){_SPACE}(?:(?i:bearer|basic|token)[ \t]++)?+[\"'`]?+)(?=[^\s\"'`])"
)
# To the closing quote, else to white space or the next such value.
_QUOTED = "|".join(
    rf"(?<={q}{_MARK})[^{q}\r\n{_MARK}]*+(?:(?<=\\){q}[^{q}\r\n{_MARK}]*+){{0,99}}+(?={q})"
    for q in "\"'`"
)
_VALUE = rf"{_MARK}(?:{_QUOTED}|[^\s{_MARK}]*+)"
# A value without quotes may end before these signs.
_HEAD = r"^[^&;,<>(){}\[\]\"'`]++"
#: Characters before a candidate of which its context is read.
CONTEXT = 64
# The name of an assignment or the word before, then signs.
_CONTEXT = r"((?:\S*\s*[=:]+>?\s*(?:(?i:bearer|basic|token)\s+)?|\S+\s+)?[^\s\w]*)$"
# Only an assignment's signs, so its name is the run before.
_SIGNS = r"^[\"'`\])]*\s*[=:]+>?\s*(?:(?i:bearer|basic|token)\s+)?[\"'`]?$"
_KEYWORD = r"token|secret|passw|api[_-]?key|auth|credential"
# Names of secrets as words of their own, or as the last part of a name.
_SECRET_NAME = (
    r"(?:token|secret|passwo?r?d|passphrase|pwd|(?:api|access|private|secret)[_-]?key|authorization|"
    r"credentials?|bearer)(?![a-z])"
)
# Names of values that only look random.
_OTHER_NAME = (
    r"(?<![a-z])(?:commit|checkout|rev(?:ision)?|sha-?\d*(?:sum)?|md5|checksum|digest|hash|etag|integrity|"
    r"uuid|guid|id|cid|image|base64|src|href|path|file|order|card|page|model|author|version|v)(?![a-z])"
)
# Weight of a pair of letters that no word has.
_RARE = -5.0
_VENDOR = (
    r"^(?:AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|github_pat_|sk-[A-Za-z0-9_\-]{20}|[sr]k_live_|xox[abprs]-|"
    r"AIza[A-Za-z0-9_\-]{35}|glpat-|eyJ[A-Za-z0-9_\-]{8,}\.)"
)

FEATURES = [
    "length",
    "digits",
    "capitals",
    "signs",
    "hexadecimal",
    "transitions",
    "pairs",
    "distinct",
    "dictionary",
    "path",
    "vendor",
    "keyword",
    "other_name",
    "assigned",
    "quoted",
]


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, number, candidate, before)``: possible keys and what stands before each.

    A candidate is a token with at least 16 key characters in a row, whole with its dotted parts and
    padding, or the value of a secret-like name, of any length, to its closing quote or white space.
    Of a value without quotes, what stands before its first delimiter is one too, and so are the
    tokens within a value and the long parts of a dotted token that is no JWT.

    ``number`` counts the candidates of a text from 0. Null and empty texts have none. The context
    ends at the candidate before, which is never part of it unless it is the name assigned to.
    """
    # Steps, so that each text is marked, searched and cut once.
    marked = docs.select(key, F.regexp_replace(F.col(text), _NAMED, f"$1{_MARK}").alias("marked"))
    cut = marked.select(key, *_cut(F.col("marked"), f"{_VALUE}|{_TOKEN}"))
    found = F.flatten(F.transform(_with_context(F.col("matches"), F.col("gaps")), _parts))
    return cut.select(key, F.posexplode(found).alias("number", "found")).select(
        key, "number", "found.candidate", "found.before"
    )


def _parts(block: Column) -> Column:
    """Candidates in a match of a value or a token."""

    def row(candidate: Column, before: Column) -> Column:
        return F.struct(candidate.alias("candidate"), before.alias("before"))

    before = block["before"]
    value = F.translate(block["candidate"], _MARK, "")
    named = block["candidate"].startswith(_MARK)
    # A token ends by itself.
    quoted = block["closed"] | ~named
    whole = F.when(named & ~quoted, F.regexp_replace(value, r"[)\]}>\"'`,;.:]+$", "")).otherwise(value)
    # Base64 has whole groups of four; other signs at the end are an assignment's.
    unpadded = F.when(
        ~named & (F.length(whole) % 4 != 0), F.regexp_replace(whole, "=+$", "")
    ).otherwise(whole)
    head = F.when(quoted, unpadded).otherwise(
        F.regexp_replace(F.regexp_extract(unpadded, _HEAD, 0), "[.,:;]+$", "")
    )
    first = F.array_distinct(F.array(unpadded, head))
    tokens = F.transform(_with_context(*_cut(value, _TOKEN)), lambda r: row(r["candidate"], r["before"]))
    inner = F.when(named, tokens).otherwise(
        F.transform(F.split(unpadded, r"\."), lambda part: row(part, before))
    )
    # What begins the value has the value's own context.
    inner = F.transform(
        inner, lambda r: row(r["candidate"], F.when(r["before"] == "", before).otherwise(r["before"]))
    )
    long = F.filter(
        inner, lambda r: r["candidate"].rlike(f"{_KEY}{{16}}") & ~F.array_contains(first, r["candidate"])
    )
    wanted = F.filter(first, lambda c: c.rlike(r"[\p{L}\p{N}]"))
    return F.concat(
        F.transform(wanted, lambda c: row(c, before)),
        F.when(unpadded.rlike(_JWT), F.slice(long, 1, 0)).otherwise(long),
    )


def _cut(text: Column, pattern: str) -> tuple[Column, Column]:
    """Matches of a pattern, and the text before, between and after them."""
    matches = F.regexp_extract_all(text, F.lit(f"({pattern})"), 1)
    return matches.alias("matches"), F.split(text, pattern, -1).alias("gaps")


def _with_context(matches: Column, gaps: Column) -> Column:
    """Array of ``(candidate, before, closed)``: matches, the lower-case text that ends before each,
    and whether a quote before it comes again right after it."""
    both = F.arrays_zip(
        matches.alias("m"),
        F.transform(gaps, lambda gap: F.right(gap, F.lit(CONTEXT))).alias("g"),
        F.concat(F.array(F.lit("")), matches).alias("p"),
        F.transform(F.slice(gaps, F.lit(2), F.size(gaps)), lambda gap: F.left(gap, F.lit(1))).alias("n"),
    )

    def one(row: Column) -> Column:
        gap, previous = row["g"], F.right(row["p"], F.lit(CONTEXT))
        whole = F.when(gap.rlike(_SIGNS), F.concat(previous, gap)).otherwise(gap)
        return F.struct(
            row["m"].alias("candidate"),
            F.lower(F.regexp_extract(whole, _CONTEXT, 1)).alias("before"),
            (gap.rlike("[\"'`]$") & (F.right(gap, F.lit(1)) == row["n"])).alias("closed"),
        )

    # The last gap has no candidate behind it.
    return F.transform(F.slice(both, F.lit(1), F.size(matches)), one)


def dictionary(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(run, texts)``: letter runs of at least four in a share ``COMMON`` of the different texts.

    Copies of a text count once: a sketch per run counts the hashes of the texts that hold it. The
    words of the labelled findings belong to every dictionary.
    """
    runs = F.regexp_extract_all(F.lower(F.col(text)), F.lit("([a-z]{4,})"), 1)
    # The hash is made before the explode, once per text and not once per run of its letters.
    hashed = docs.select(F.xxhash64(text).alias("hash"), F.array_distinct(runs).alias("runs"))
    exploded = hashed.select("hash", F.explode("runs").alias("run"))
    counted = exploded.groupBy("run").agg(F.approx_count_distinct("hash", _ERROR).alias("texts"))
    every = docs.agg(F.approx_count_distinct(F.xxhash64(text), _ERROR).alias("every"))
    bar = F.greatest(F.lit(2.0), every.select(F.col("every") * COMMON).scalar())
    known = docs.sparkSession.range(1).select(
        F.explode(F.split(F.lit(WORDS), " ")).alias("run"), F.lit(1).cast("long").alias("texts")
    )
    common = counted.where(F.col("texts") >= bar).union(known)
    return common.groupBy("run").agg(F.sum("texts").alias("texts"))


def letter_pairs(words: DataFrame) -> DataFrame:
    """``(pair, weight)``: logarithm of how often the second letter follows the first in words.

    At most 676 rows.
    """
    pairs = words.select(F.explode(_pairs(F.col("run"))).alias("pair"), "texts")
    counted = pairs.groupBy("pair").agg(F.sum("texts").alias("n"))
    first = counted.groupBy(F.left("pair", F.lit(1)).alias("first")).agg(F.sum("n").alias("all"))
    both = counted.join(first, F.left("pair", F.lit(1)) == F.col("first"))
    return both.select("pair", F.log((F.col("n") + 1) / (F.col("all") + 26)).alias("weight"))


def _pairs(run: Column) -> Column:
    """Pairs of letters that follow each other."""
    return F.regexp_extract_all(run, F.lit("(?=([a-z][a-z]))"), 1)


def _share(pattern: str) -> Column:
    return F.regexp_count("candidate", F.lit(pattern)) / F.length("candidate")


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with the columns ``FEATURES``."""
    # Each distinct candidate is looked up once; a candidate may be in very many documents. Its parts
    # carry a digest, as a very long candidate has very many.
    found = found.withColumn("digest_", F.md5("candidate"))
    distinct = found.groupBy("digest_").agg(F.lower(F.min("candidate")).alias("candidate"))
    distinct = stage(distinct, "secret-distinct")
    runs = distinct.select(
        "digest_", F.explode(F.regexp_extract_all("candidate", F.lit("([a-z]{4,})"), 1)).alias("run")
    )
    covered = runs.join(words, "run").groupBy("digest_").agg(F.sum(F.length("run")).alias("covered_"))
    # At most 676 rows are broadcast.
    pairs = distinct.select("digest_", F.explode(_pairs(F.col("candidate"))).alias("pair"))
    pairs = pairs.join(F.broadcast(letter_pairs(words)), "pair", "left").groupBy("digest_").agg(
        F.avg(F.coalesce("weight", F.lit(_RARE))).alias("pairs_")
    )
    looked_up = stage(pairs.join(covered, "digest_", "full"), "secret-coverage")
    joined = found.join(looked_up, "digest_", "left")
    length = F.length("candidate")
    classes = r"[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+"
    made = {
        "length": length,
        "digits": _share("[0-9]"),
        "capitals": _share("[A-Z]"),
        "signs": _share("[^A-Za-z0-9]"),
        "hexadecimal": _share("[0-9a-f]"),
        "transitions": _share(classes),
        "pairs": F.coalesce("pairs_", F.lit(_RARE)),
        "distinct": F.size(F.array_distinct(F.split("candidate", ""))) / length,
        "dictionary": F.coalesce("covered_", F.lit(0)) / length,
        "path": F.regexp_count("candidate", F.lit("/")) + F.col("before").rlike(r"[/.\\]$").cast("int"),
        "vendor": F.col("candidate").rlike(_VENDOR),
        "keyword": F.col("before").rlike(_SECRET_NAME),
        "other_name": F.col("before").rlike(_OTHER_NAME),
        "assigned": F.col("before").rlike(r"[=:]\s*[\"']?$"),
        "quoted": F.col("before").rlike(r"[\"']$"),
    }
    made = {name: made[name].cast("double") for name in FEATURES}
    return joined.withColumns(made).drop("digest_", "covered_", "pairs_")


def labelled(found: DataFrame) -> DataFrame:
    """Labels where form and context leave no doubt: 1 for keys, 0 for words and numbers.

    A key has a vendor's form, or is assigned to a name of the kind and mixes digits with letters. A
    finding of only letters or only digits without such a name is none. Others get no label.
    """
    named = F.col("before").rlike(_KEYWORD) & F.col("before").rlike(r"[=:]")
    mixed = F.col("candidate").rlike("[0-9]") & F.col("candidate").rlike("[A-Za-z]")
    vendor = F.col("candidate").rlike("^(AKIA[A-Z0-9]{16}|ghp_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{32,})$")
    label = F.when(vendor | (named & mixed), 1.0).when(~named & ~mixed, 0.0)
    return found.withColumn("label", label).where(F.col("label").isNotNull())


def examples(spark: SparkSession) -> DataFrame:
    """Labelled findings of the texts of :func:`example_texts`, found as those of a corpus are.

    A candidate that holds the value has the label of its form; others, such as names, are none.
    """
    found = candidates(example_texts(spark), "example")
    value = F.col("example.value")
    inside = F.contains("candidate", value) | F.contains(value, "candidate")
    return found.select("candidate", "before", F.when(inside, F.col("example.label")).otherwise(0.0).alias("label"))


def fit(findings: DataFrame) -> RandomForestClassificationModel | None:
    """A forest on at most ``SAMPLE`` labelled findings of each class, drawn by a hash.

    ``findings`` has ``FEATURES``, ``candidate``, ``before`` and ``label``. None without both classes.
    """
    order = [F.xxhash64("candidate", "before"), *[F.col(name) for name in FEATURES]]
    findings = findings.select(*FEATURES, "candidate", "before", F.col("label").cast("double"))
    drawn = [
        findings.where(F.col("label") == value).orderBy(*order).limit(SAMPLE) for value in (0.0, 1.0)
    ]
    sample = stage(drawn[0].union(drawn[1]).select(*FEATURES, "label"), "secret-sample")
    if sample.select("label").distinct().count() < 2:
        return None
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    forest = RandomForestClassifier(numTrees=30, maxDepth=8, seed=1, featureSubsetStrategy="onethird")
    return forest.fit(vectors)


def scan(
    docs: DataFrame,
    findings: DataFrame | None = None,
    threshold: float = 0.5,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(key, number, shown, sha256, score)`` per finding that the forest keeps.

    Built-in expressions and Spark's own forest only. ``findings`` are labelled findings to learn
    from, with ``candidate``, ``before`` and ``label``; without them :func:`examples`, vendors' keys,
    tokens and passwords against commit ids, sums, paths, encoded data, names and prose. A secret is
    not shown whole: its first four characters, and a hash. Where ``findings`` have one label only
    there is no forest, and the result are the findings that :func:`labelled` takes for keys, with
    score 1. Rows that repeat are scanned each; other columns are not read. An empty table has an
    empty result.
    """
    words = stage(dictionary(docs, text), "secret-dictionary")
    found = stage(candidates(docs, key, text), "secret-candidates")
    found = stage(features(found, words), "secret-features")
    if findings is None:
        findings = stage(examples(docs.sparkSession), "secret-examples")
    model = fit(features(findings, words))
    if model is None:
        sure = labelled(found)
        scored = sure.withColumn("score", F.col("label"))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
        scored = model.transform(vectors).withColumn(
            "score", F.get(vector_to_array("probability"), F.lit(1))
        )
    return scored.where(F.col("score") >= threshold).select(
        key,
        "number",
        F.left("candidate", F.lit(4)).alias("shown"),
        F.sha2("candidate", 256).alias("sha256"),
        "score",
    )
