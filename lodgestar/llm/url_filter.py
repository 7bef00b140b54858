"""URL filter: list rules first, then a weighted vocabulary found by an Aho-Corasick automaton."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgestar.llm.text import by_batch

#: A URL whose terms weigh this much together is blocked.
LIMIT = 2.0
#: One of these is enough. A blank stands for any one character that no word has.
STRICT_TERMS = (
    "buy followers",
    "casino",
    "cheap pills",
    "escort",
    "hardcore",
    "hentai",
    "link farm",
    "malware",
    "nude",
    "payday loan",
    "phishing",
    "porn",
    "porno",
    "spam",
    "viagra",
    "warez",
    "xxx",
)
#: Of these it takes several different ones.
SOFT_TERMS = (
    "adult",
    "bet",
    "bonus",
    "cheap",
    "cialis",
    "crack",
    "deal",
    "deals",
    "discount",
    "free",
    "gambling",
    "keygen",
    "loan",
    "loans",
    "pill",
    "pills",
    "poker",
    "serial",
    "sex",
    "slots",
    "torrent",
    "win",
)
#: The list is sent to every task, so it must be small.
MOST_RULES = 100_000

# Words are made of ASCII letters and digits and of everything beyond ASCII.
_BLANKS = {c: " " for c in range(128) if not chr(c).isalnum()}
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def vocabulary(
    strict: Sequence[str] = STRICT_TERMS, soft: Sequence[str] = SOFT_TERMS
) -> dict[str, float]:
    """Weight of each term: a strict one weighs the limit, a soft one half of it."""
    return {**dict.fromkeys(soft, LIMIT / 2), **dict.fromkeys(strict, LIMIT)}


@dataclass(frozen=True)
class Rule:
    """``verdict`` for URLs of ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str = ""

    def __post_init__(self) -> None:
        if self.verdict not in ("allow", "block") or not self.host:
            raise ValueError(f"a rule needs a host and the verdict allow or block: {self}")


@dataclass
class Filter:
    """Rules by host, and the automaton of the terms; one is built per task."""

    rules: Sequence[Rule]
    terms: Mapping[str, float]
    by_host: dict[str, list[Rule]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for rule in self.rules:
            self.by_host.setdefault(rule.host.translate(_LOWER), []).append(rule)
        for rules in self.by_host.values():
            rules.sort(key=lambda rule: -len(rule.path))
        self.automaton = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            plain = words(term)
            self.automaton.add_word(plain, (plain, weight))
        self.automaton.make_automaton()

    def rule(self, host: str, path: str) -> Rule | None:
        """The longest rule that fits, host and path together; then the one of the longer host."""
        best, at = None, 0
        while host:
            part = host[at:]
            fits = (r for r in self.by_host.get(part, ()) if path.startswith(r.path))
            rule = next(fits, None)
            # Hosts get shorter, so of equally long rules the first has the longer host.
            if rule and (best is None or _length(rule) > _length(best)):
                best = rule
            at = host.find(".", at) + 1
            if not at:
                break
        return best

    def hits(self, url: str) -> dict[str, float]:
        """Different terms that stand as whole words in the URL, with their weights."""
        if not len(self.automaton):
            return {}
        text, found = f" {words(url)} ", {}
        for end, (term, weight) in self.automaton.iter(text):
            if text[end - len(term)] == " " and text[end + 1] == " ":
                found[term] = weight
        return found


def _length(rule: Rule) -> int:
    return len(rule.host) + len(rule.path)


def words(text: str) -> str:
    """Lower case A-Z; each ASCII character that is no letter or digit as a blank."""
    return text.translate(_LOWER).translate(_BLANKS)


def judge(
    pages: DataFrame,
    rules: Sequence[Rule] = (),
    terms: Mapping[str, float] | None = None,
    key: str = "page_id",
    url: str = "url",
    limit: float = LIMIT,
) -> DataFrame:
    """``(key, host, path, rule, verdict, strict_terms, soft_terms, weight)`` for every page.

    The host is what stands between the first ``://`` and the next ``/``, ``?``, ``#`` or end,
    with A-Z in lower case; the path goes from there to ``?``, ``#`` or end. Both are empty
    without ``://`` and for a null URL. A rule fits its host and all subdomains where the path
    starts with the rule's; the longest decides. Else the terms in the whole URL do: a term counts
    once, where no letter, digit or character beyond ASCII stands beside it, and the URL is
    blocked if the weights reach ``limit``, that is for one strict or several different soft terms.
    ``weight`` and the terms are given for URLs that a rule decides as well.

    Equal rows have equal results; null keys, empty and very long URLs are rows like others. Other
    columns are not read. An empty table has an empty result. Rules and terms are sent to the
    tasks, at most ``MOST_RULES`` of each.
    """
    terms = vocabulary() if terms is None else dict(terms)
    if max(len(rules), len(terms)) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules or terms")
    rules = list(rules)

    def work(batches):
        sieve = Filter(rules, terms)

        def handle(rows: dict[str, list]) -> dict[str, list]:
            fits = [sieve.rule(h, p) for h, p in zip(rows["host"], rows["path"])]
            hits = [sieve.hits(u or "") for u in rows["url"]]
            weights = [float(sum(found.values())) for found in hits]
            return {
                "id": rows["id"],
                "host": rows["host"],
                "path": rows["path"],
                "rule": [r and r.host.translate(_LOWER) + r.path for r in fits],
                "verdict": [
                    r.verdict if r else "block" if w >= limit else "allow"
                    for r, w in zip(fits, weights)
                ],
                "strict_terms": [sorted(t for t, w in f.items() if w >= limit) for f in hits],
                "soft_terms": [sorted(t for t, w in f.items() if w < limit) for f in hits],
                "weight": weights,
            }

        return by_batch(handle, _RESULT, rows=4_096)(batches)

    # The key goes along as text, so that it may be of any plain type.
    kind = pages.select(key).dtypes[0][1]
    found = F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)([^?#]*)", 2)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    split = pages.select(
        F.col(key).cast("string").alias("id"),
        F.col(url).alias("url"),
        F.coalesce(F.translate(found, upper, lower), F.lit("")).alias("host"),
        F.coalesce(path, F.lit("")).alias("path"),
    )
    judged = split.mapInArrow(
        work,
        "id string, host string, path string, rule string, verdict string,"
        " strict_terms array<string>, soft_terms array<string>, weight double",
    )
    return judged.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", key)


_RESULT = pa.schema(
    [
        ("id", pa.string()),
        ("host", pa.string()),
        ("path", pa.string()),
        ("rule", pa.string()),
        ("verdict", pa.string()),
        ("strict_terms", pa.list_(pa.string())),
        ("soft_terms", pa.list_(pa.string())),
        ("weight", pa.float64()),
    ]
)
