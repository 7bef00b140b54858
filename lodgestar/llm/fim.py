"""Fill-in-the-middle documents: texts cut at two unit borders found by one repeated-capture match."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgestar.llm.text import by_batch

#: Signs before prefix, suffix and middle.
SIGNS = ("<P>", "<S>", "<M>")
#: A unit between two of which a text may be cut: any code point.
CODE_POINT = r"(?s:.)"
#: Of 100 documents so many stay plain, and of 100 others so many start with the suffix.
PLAIN_PERCENT = 10
SPM_PERCENT = 20
#: Starts the text whose digest decides how a document is cut; another one gives other cuts.
SALT = "1:"


@dataclass(frozen=True)
class Cutter:
    """How texts are cut: the unit, the signs, the shares of the forms and the salt."""

    unit: str = CODE_POINT
    signs: tuple[str, str, str] = SIGNS
    plain_percent: int = PLAIN_PERCENT
    spm_percent: int = SPM_PERCENT
    salt: str = SALT

    def __post_init__(self) -> None:
        alike = any(
            a[i:].startswith(b) or b.startswith(a[i:])
            for a in self.signs
            for b in self.signs
            for i in range(len(a))
            if i or a is not b
        )
        if len(set(self.signs)) < 3 or not all(self.signs) or alike:
            raise ValueError(f"signs must be three texts none of which overlaps another: {self.signs}")

    def cut(self, key: str, text: str) -> tuple[int, str, int | None, int | None, str]:
        """Units, form, length of prefix and middle in code points, and the new text."""
        match = regex.fullmatch(f"({self.unit})*", text)
        if match is None:
            raise ValueError(f"the unit {self.unit!r} does not cover the text of document {key}")
        ends = match.ends(1)
        n = len(ends)
        digest = hashlib.sha256((self.salt + key).encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[at : at + 8], 16) for at in (0, 8, 16, 24))
        if not text or h3 % 100 >= 100 - self.plain_percent or any(s in text for s in self.signs):
            return n, "plain", None, None, text
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = (ends[k - 1] if k else 0 for k in (low, high))
        p, s, m = self.signs
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h4 % 100 < self.spm_percent:
            return n, "spm", a, b - a, s + suffix + p + prefix + m + middle
        return n, "psm", a, b - a, p + prefix + s + suffix + m + middle


def transform(
    docs: DataFrame, key: str = "doc_id", text: str = "text", cutter: Cutter | None = None
) -> DataFrame:
    """``(key, n, form, prefix_chars, middle_chars, output)`` for every document.

    ``n`` is the number of units of the text; prefix and middle end after a number of units given
    by the digest of the key, so reruns agree and rows of equal key and text have equal results.
    A null text is empty, an empty one plain with an empty output; a text that holds a sign stays
    plain, as it could not be restored. A null key takes part with an empty text in its place. A
    unit that does not cover a text fails the job. Other columns are not read. An empty table has
    an empty result.

    One match keeps every repetition of the unit, about 80 bytes a unit, for one text at a time.
    """
    cutter = cutter or Cutter()

    def handle(rows: dict[str, list]) -> dict[str, list]:
        found = [cutter.cut(k or "", t or "") for k, t in zip(rows["id"], rows["text"])]
        columns = zip(*found) if found else [[]] * 5
        names = ("n", "form", "prefix_chars", "middle_chars", "output")
        return {"id": rows["id"], **{n: list(c) for n, c in zip(names, columns)}}

    # The key goes along as text, so that it may be of any plain type.
    kind = docs.select(key).dtypes[0][1]
    chosen = docs.select(F.col(key).cast("string").alias("id"), F.col(text).alias("text"))
    fields = "id string, n long, form string, prefix_chars long, middle_chars long, output string"
    cut = chosen.mapInArrow(by_batch(handle, _RESULT), fields)
    return cut.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", key)


_RESULT = pa.schema(
    [
        ("id", pa.string()),
        ("n", pa.int64()),
        ("form", pa.string()),
        ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()),
        ("output", pa.string()),
    ]
)


def restored(form: Column, output: Column, signs: tuple[str, str, str] = SIGNS) -> Column:
    """The text from which ``transform`` made ``output``, from the output and its form alone."""
    pattern = "|".join("\\Q" + sign + "\\E" for sign in signs)
    parts = F.split(output, pattern, -1)  # the first part is before the first sign, so empty
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )
