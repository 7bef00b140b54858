"""Toxicity by a support vector machine over a subsequence string kernel.

The kernel of two strings counts their common subsequences of ``ORDER`` characters, each weighted by
``DECAY`` to the length it spans in both (Lodhi et al., 2002). Gaps and inserted characters only lower
it, so ``i-d-i-o-t`` stays close to ``idiot``. A Nyström map on landmark strings makes it linear: a
sentence is the largest kernel value of its words per landmark, times the inverse root of the
landmarks' own kernel matrix. Values are scaled by the landmark's kernel with itself, so 1 means
that a word holds the landmark, with whatever around it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgestar.llm.text import by_batch

ORDER = 4
DECAY = 0.7
#: Kernel values are raised to this power (again a kernel): distant words then add up to little.
POWER = 2
#: Of the landmarks, those that set toxic documents apart, and ordinary words.
TELLING, ORDINARY = 28, 2
#: Lengths of the parts of words that may become telling landmarks.
PARTS = (4, 10)
#: A telling part is so many times as frequent in toxic documents.
APART = 30
#: It stands for words of so many toxic documents, as a share.
LEAST = 0.02
#: A sentence of a toxic document is an example if a word has this kernel value with a landmark.
CLEAR = 0.8
#: Weight of an example with an inserted letter.
SPOILT = 0.1
#: Weight of a sentence without words, as a share of all sentences.
BLANK = 0.1
#: Labelled documents of each class that are learned from, and their greatest length.
SAMPLE, SAMPLE_CHARS = 1_500, 20_000
#: Longer strings are cut into windows of this length that overlap by half.
WINDOW = 24
ROUNDS = 4
_REMEMBERED = 600_000
_NONE = 0xFFFFFFFF  # no character
_TOKENS = 100_000  # of which vectors are gathered at once

_SENTENCE_END = re.compile(r"[.!?\n]+(?=\s|$)|\n")
_SPELLED = re.compile(r"(?:(?<=\s)|^)\S(?:[^\S\n]\S){2,}(?=\s|$)")
_MARKS = re.compile(r"[^\w\s]+|_+")


# --- kernel -------------------------------------------------------------------------------------


def _codes(strings: list[str], width: int, fill: int = 0) -> np.ndarray:
    """Character codes (position, string), padded with ``fill``."""
    codes = np.array(strings, dtype=f"<U{width}").view(np.uint32).reshape(len(strings), width)
    codes = codes.T.copy()
    codes[codes == 0] = fill
    return codes


def _before(values: np.ndarray, out: np.ndarray, decay: np.float32) -> np.ndarray:
    """Along the first axis, what lies before each position, times ``decay`` per step."""
    out[0] = 0
    for at in range(1, len(values)):
        np.add(out[at - 1], values[at - 1], out=out[at])
        out[at] *= decay
    return out


def _raw_kernel(words: np.ndarray, mark: np.ndarray, order: int, decay: float) -> np.ndarray:
    """Of strings (position, string) with one; every step runs over whole blocks of strings."""
    step = np.float32(decay)
    same = (words[:, None, :] == mark[None, :, :]).astype(np.float32)
    chains = same * (step * step)
    one, two = np.empty_like(same), np.empty_like(same)
    for _ in range(order - 1):
        _before(chains, one, step)
        _before(one.swapaxes(0, 1), two.swapaxes(0, 1), step)
        np.multiply(same, two, out=chains)
    return chains.sum(axis=(0, 1))


def kernel(
    strings: list[str], landmarks: list[str], order: int = ORDER, decay: float = DECAY
) -> np.ndarray:
    """Kernel values of ``strings`` (rows) with ``landmarks``, scaled by the landmarks', 1 at most.

    0 for strings shorter than ``order``. Strings of over ``WINDOW`` characters have the largest
    value of their windows, so no text is too long.
    """
    pieces, owner = [], []
    for number, string in enumerate(strings):
        for at in range(0, max(1, len(string) - WINDOW // 2), WINDOW // 2):
            pieces.append(string[at : at + WINDOW])
            owner.append(number)
    out = np.zeros((len(strings), len(landmarks)), dtype=np.float32)
    if not strings or not landmarks:
        return out
    owners = np.array(owner)
    lengths = np.array([len(p) for p in pieces])
    marks = [_codes([z], len(z), _NONE) for z in landmarks]
    own = [_raw_kernel(_codes([z], len(z)), m, order, decay)[0] for z, m in zip(landmarks, marks)]
    for low, high in ((order, 5), (6, 7), (8, 9), (10, 12), (13, 16), (17, WINDOW)):
        chosen = np.flatnonzero((lengths >= low) & (lengths <= high))
        for start in range(0, len(chosen), 4096):
            some = chosen[start : start + 4096]
            codes = _codes([pieces[i] for i in some], high)
            folded = codes & 63
            for column, landmark in enumerate(landmarks):
                # A common subsequence needs as many common characters, each as often as both
                # strings hold it; without those the kernel is 0.
                common = np.zeros(len(some), dtype=np.int32)
                for code, times in Counter(ord(c) & 63 for c in landmark).items():
                    common += np.minimum((folded == code).sum(axis=0), times)
                at = np.flatnonzero(common >= order)
                if len(at) and own[column] > 0:
                    raw = _raw_kernel(codes[:, at], marks[column], order, decay)
                    value = np.minimum(raw / own[column], 1) ** POWER
                    np.maximum.at(out[:, column], owners[some[at]], value)
    return out


# --- text ---------------------------------------------------------------------------------------


def sentences(text: str | None) -> list[list[str]]:
    """Words of each sentence in lower case, without marks. Letters set apart are one word."""
    lower = _SENTENCE_END.sub("\n", (text or "").lower())
    lower = _MARKS.sub("", lower)
    lower = _SPELLED.sub(lambda found: re.sub(r"\s", "", found.group()), lower)
    return [words for part in lower.split("\n") if (words := part.split())]


@dataclass
class Model:
    """A linear decision on the Nyström map, and its scale from margins to probabilities."""

    landmarks: list[str]
    weights: np.ndarray  # on kernel values, the map included
    bias: float
    slope: float
    offset: float

    def probability(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -30, 30)))


@dataclass
class Featurizer:
    """Kernel values of words, remembered within a worker."""

    landmarks: list[str]
    known: dict[str, int] = field(default_factory=dict)
    values: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))

    def _learn(self, words: list[str]) -> None:
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if not new:
            return
        if len(self.known) + len(new) > _REMEMBERED:
            self.known.clear()
            new = list(dict.fromkeys(words))
        found = kernel(new, self.landmarks)
        base = len(self.known)
        self.known.update({w: base + n for n, w in enumerate(new)})
        if len(self.values) < len(self.known):
            grown = np.zeros(
                (max(2 * len(self.values), len(self.known)), len(self.landmarks)), np.float32
            )
            if base:
                grown[:base] = self.values[:base]
            self.values = grown
        self.values[base : len(self.known)] = found

    def pooled(self, parts: list[list[str]]) -> np.ndarray:
        """Per sentence, the largest value of its words for each landmark."""
        out = np.zeros((len(parts), len(self.landmarks)), np.float32)
        at = 0
        while at < len(parts):
            end, total = at, 0
            while end < len(parts) and (end == at or total + len(parts[end]) <= _TOKENS):
                total += len(parts[end])
                end += 1
            words = [w for part in parts[at:end] for w in part]
            starts = np.cumsum([0] + [len(p) for p in parts[at : end - 1]])
            for block in range(0, len(words), _TOKENS):  # of one sentence that is longer
                some = words[block : block + _TOKENS]
                self._learn(some)
                rows = self.values[np.fromiter(map(self.known.__getitem__, some), int, len(some))]
                if end - at == 1:
                    out[at] = np.maximum(out[at], rows.max(axis=0))
                else:
                    out[at:end] = np.maximum.reduceat(rows, starts, axis=0)
            at = end
        return out


_featurizers: dict[tuple[str, ...], Featurizer] = {}


def featurizer(landmarks: list[str]) -> Featurizer:
    """One per worker process and set of landmarks; the last set stays."""
    key = tuple(landmarks)
    if key not in _featurizers:
        _featurizers.clear()
        _featurizers[key] = Featurizer(landmarks)
    return _featurizers[key]


# --- learning -----------------------------------------------------------------------------------


def _parts(word: str) -> set[str]:
    low, high = PARTS
    return {
        word[at : at + n] for n in range(low, high + 1) for at in range(max(0, len(word) - n + 1))
    }


def _apart(part: str, held: Counter, against: Counter, n: list[int]) -> bool:
    return held[part] / n[1] > APART * (against[part] + 0.5) / n[0]


def choose_landmarks(texts: list[str], toxic: list[int]) -> list[str]:
    """Parts of words that set toxic documents apart; then common words.

    Parts, as an insult may be a stem with endings. Each is the one that the most words not yet
    accounted for have in common; longer parts, being more specific, win over somewhat more
    frequent ones. A part counts against itself in every
    other document that holds a word with it.
    """
    held: list[list[set[str]]] = [[], []]
    for text, label in zip(texts, toxic, strict=True):
        words = {w[:WINDOW] for part in sentences(text) for w in part}
        held[label].append({w for w in words if len(w) >= PARTS[0]})
    n = [max(1, len(h)) for h in held]
    clean = Counter(w for words in held[0] for w in words)
    marked = Counter(w for words in held[1] for w in words)
    # Words that are no more frequent in toxic documents hold no telling part of their own.
    apart = {w for w, k in marked.items() if k / n[1] > 3 * clean.get(w, 0) / n[0]}
    repeated = Counter(p for words in held[1] for p in {p for w in words & apart for p in _parts(w)})
    candidates = {p for p, k in repeated.items() if k >= max(3, 0.004 * n[1])}
    against: Counter = Counter()
    for word, times in clean.items():
        for part in _parts(word) & candidates:
            against[part] += times

    # Words that a part accounts for; later parts are for words that no part holds yet.
    holders = {p: [w for w in apart if p in w] for p in candidates if _apart(p, repeated, against, n)}
    open_words = set(apart)
    chosen: list[str] = []
    while len(chosen) < TELLING:
        worth = {p: sum(marked[w] for w in ws if w in open_words) for p, ws in holders.items()}
        best = max(worth, key=lambda p: (worth[p] * min(len(p), 6) ** 1.5, len(p), p), default=None)
        if best is None or worth[best] < LEAST * n[1]:
            break
        chosen.append(best)
        open_words -= set(holders.pop(best))
    common = sorted(clean.items(), key=lambda x: (-x[1], x[0]))
    return chosen + [w for w, _ in common if w not in chosen][:ORDINARY]


def _nystroem(landmarks: list[str]) -> np.ndarray:
    own = kernel(landmarks, landmarks).astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    root = np.where(values > 1e-3, 1 / np.sqrt(np.maximum(values, 1e-3)), 0.0)
    return vectors * root


def _linear_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 100) -> np.ndarray:
    """Squared hinge loss by damped Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    sign = np.where(y > 0, 1.0, -1.0)
    keep = np.ones(x.shape[1])
    keep[-1] = 1e-6
    w = np.zeros(x.shape[1])

    def loss(v: np.ndarray) -> float:
        gap = np.maximum(0, 1 - sign * (x @ v))
        return 0.5 * (keep * v * v).sum() + (cost * gap * gap).sum()

    for _ in range(steps):
        gap = 1 - sign * (x @ w)
        active = gap > 0
        slope = keep * w - 2 * x.T @ (cost * sign * np.maximum(gap, 0))
        curve = np.diag(keep) + 2 * (x[active].T * cost[active]) @ x[active]
        step = np.linalg.solve(curve, slope)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w


def _with_gap(words: list[str], features: Featurizer, telling: int) -> list[str]:
    """The sentence with a letter inserted in the word that looks worst."""
    looks = features.pooled([[w] for w in words])[:, :telling].max(axis=1)
    at = int(looks.argmax())
    word = words[at]
    place = 1 + zlib.crc32(word.encode()) % max(1, len(word) - 1)
    letter = "xqzkjw"[len(word) % 6]
    return [*words[:at], word[:place] + letter + word[place:], *words[at + 1 :]]


def train(texts: list[str], toxic: list[int], share: float = 0.5) -> Model:
    """Learns from sentences of whole documents.

    Of a toxic document, the sentences with a clear landmark are examples, also with a letter
    inserted, and the one that looks worst, chosen again after each round. All sentences of the
    other documents are counterexamples. ``share`` is that of toxic documents among all, to which
    the probabilities are fitted. Without both classes, or without a
    telling landmark, everything scores 0.
    """
    if not any(toxic) or all(toxic):
        return Model([], np.zeros(0), 0.0, 0.0, -30.0)
    landmarks = choose_landmarks(texts, toxic)
    if len(landmarks) <= ORDINARY:  # nothing sets toxic documents apart
        return Model([], np.zeros(0), 0.0, 0.0, -30.0)
    turn = _nystroem(landmarks)
    parts = [sentences(t) or [[]] for t in texts]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    y = np.array(toxic)
    features = Featurizer(landmarks)
    values = features.pooled([s for p in parts for s in p])
    mapped = values @ turn
    telling = max(1, len(landmarks) - ORDINARY)
    looks = values[:, :telling].max(axis=1).astype(np.float64)
    starts = np.searchsorted(owner, np.arange(len(parts)))
    clear = (looks >= CLEAR) & (y[owner] == 1)
    flat = [s for p in parts for s in p]
    spoilt = features.pooled([_with_gap(flat[i], features, telling) for i in np.flatnonzero(clear)])
    spoilt = spoilt @ turn
    worst = looks
    for _ in range(ROUNDS):
        top = np.maximum.reduceat(worst, starts)
        example = ((worst >= top[owner]) & (y[owner] == 1)) | clear
        rows = example | (y[owner] == 0)
        w = _linear_svm(
            # The last row is a sentence without words: not toxic, whatever clean texts share.
            np.vstack([mapped[rows], spoilt, np.zeros((1, mapped.shape[1]))]),
            np.concatenate([example[rows].astype(int), np.ones(len(spoilt), int), [0]]),
            np.concatenate(
                [np.ones(rows.sum()), np.full(len(spoilt), SPOILT), [BLANK * rows.sum()]]
            ),
        )
        worst = mapped @ w[:-1] + w[-1]
    margin = np.maximum.reduceat(worst, starts)
    scale = _linear_scale(margin, y, share)
    return Model(landmarks, turn @ w[:-1], float(w[-1]), *scale)


def _linear_scale(margin: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Logistic regression of the label on the margin, with smoothed targets (Platt, 1999)."""
    high, low = (y.sum() + 1) / (y.sum() + 2), 1 / ((y == 0).sum() + 2)
    target = np.where(y == 1, high, low)
    weight = len(y) * np.where(y == 1, share / max(1, y.sum()), (1 - share) / (y == 0).sum())
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    w = np.zeros(2)

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return (weight * (np.logaddexp(0, z) - target * z)).sum() + 5e-4 * (v * v).sum()

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - target)) + 1e-3 * w
        curve = (x.T * (weight * p * (1 - p) + 1e-9)) @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


# --- Spark --------------------------------------------------------------------------------------


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> Model:
    """Trains on at most ``SAMPLE`` documents of each class, drawn by a hash of the id.

    The ids are drawn from the narrow label table; only their texts of at most ``SAMPLE_CHARS``
    characters come to the driver. Labels other than 0 and 1, ids labelled both ways and
    null texts are left out.
    """
    known = labels.groupBy(key).agg(F.min(label).alias("low"), F.max(label).alias("high"))
    known = known.where(F.col("low") == F.col("high")).select(key, F.col("low").alias("label"))
    known = known.where(F.col(key).isNotNull())
    drawn = [
        known.where(F.col("label") == value).orderBy(F.xxhash64(key), key).limit(SAMPLE)
        for value in (0, 1)
    ]
    # Two times SAMPLE short rows.
    sample = F.broadcast(drawn[0].union(drawn[1]))
    usable = docs.where(F.length(text) <= SAMPLE_CHARS).select(key, text)
    rows = usable.join(sample, key).select(text, "label").toPandas()
    rows = rows.sort_values([text, "label"], ignore_index=True)
    share = known.agg(F.avg(F.when(F.col("label").isin(0, 1), F.col("label")))).first()[0]
    return train(rows[text].tolist(), rows["label"].astype(int).tolist(), float(share or 0.5))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The columns of ``docs`` with ``score``: the probability of the sentence that looks worst.

    Whole texts are read, in the order they are stored, without a shuffle. Null and empty texts
    score as a sentence without words.
    """
    names = [c for c in docs.columns if c != "score"]
    docs = docs.select(*names)

    def handle(rows: dict[str, list]) -> dict[str, list]:
        parts = [sentences(t) or [[]] for t in rows[text]]
        if model.landmarks:
            values = featurizer(model.landmarks).pooled([s for p in parts for s in p])
            margins = values @ model.weights + model.bias
        else:
            margins = np.zeros(sum(map(len, parts)))
        starts = np.cumsum([0] + [len(p) for p in parts[:-1]])
        worst = np.maximum.reduceat(margins, starts) if parts else margins
        return {**rows, "score": model.probability(worst).tolist()}

    schema = docs.schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema).append(pa.field("score", pa.float64()))
    return docs.mapInArrow(by_batch(handle, arrow, 64), fields + ", score double")


def without_toxic(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.5, key: str = "doc_id"
) -> DataFrame:
    """``docs`` that score below ``threshold`` by a model of all labelled ones."""
    columns = docs.columns
    return score(docs, fit(docs, labels, key)).where(F.col("score") < threshold).select(*columns)
