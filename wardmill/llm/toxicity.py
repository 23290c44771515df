"""Toxicity of texts by a support vector machine on a subsequence string kernel.

The kernel compares two words by their common subsequences of three letters: each occurrence counts
``DECAY`` to the power of the letters it skips, up to a span of ``SPAN``, so insults with gaps or
inserted letters still match. Word ends are letters of their own. Values are divided by the norm a
word of this length has, which keeps it a kernel. ``LANDMARKS`` words span the Nyström features of
all others, and a linear machine is trained on those.

Training data are sentences of labelled texts. A toxic text holds at least one toxic sentence, and a
sentence is as toxic as its most toxic word; which one is not known, so the machine is trained in
rounds: words that mark toxic texts beyond chance stand for their texts, else the word that the last round scored highest, against words of the other texts and the highest of each. A text's score is that of its highest sentence, as a probability.

As the machine is linear over features that are linear in the subsequences, it folds into one weight
per subsequence; scoring a word is a sum over its own ones, equal to the sum over landmarks.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DECAY, SPAN = 0.7, 5
LETTERS = 64
LANDMARKS = 256
ROUNDS = 3
# First letters that may mark a family of words.
STEM = 4
# Most labelled texts of each label that the machine is trained on.
TRAIN_TEXTS = 2000
# Most words that stand for the other texts.
TRAIN_WORDS = 8_000
KEPT_WORDS = 400_000
REJECT = 0.7

_NOT_LETTERS = re.compile(r"[\W_]+")
_STEPS = [(j, k) for j in range(1, SPAN) for k in range(j + 1, SPAN)]
_WEIGHTS = np.array([DECAY ** (k - 2) for _, k in _STEPS], np.float32)


def clean_word(token: str) -> str:
    """A word's letters and digits; marks between them go."""
    return token if token.isalnum() else _NOT_LETTERS.sub("", token)


def sentence_words(text: str) -> set[str]:
    """The words of a text; single letters in a row are one word, as in a spaced-out insult."""
    tokens = text.lower().split()
    found = set(tokens)
    if any(len(t) == 1 for t in found):
        run = ""
        for token in tokens:
            letter = clean_word(token)
            if len(letter) == 1:
                run += letter
            elif letter:
                if len(run) > 2:
                    found.add(run)
                run = ""
        if len(run) > 2:
            found.add(run)
    return found


def _letter(char: str) -> int:
    """1 is the mark of a word's ends, 2 to 27 are a to z, the others share the rest; 0 is none."""
    code = ord(char)
    return code - 95 if 97 <= code <= 122 else 28 + code % (LETTERS - 28)


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, subsequence, weight) of every occurrence, words given as ``clean_word`` does.

    Words of like length are handled together, so a very long one widens no other.
    """
    parts = []
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    for begin in range(0, len(order), 4096):
        some = order[begin: begin + 4096]
        width = len(words[some[-1]]) + 2 + SPAN
        table = np.zeros((len(some), width), np.int32)
        for row, i in enumerate(some):
            table[row, : len(words[i]) + 2] = [1, *map(_letter, words[i]), 1]
        size = width - SPAN
        first = table[:, :size]
        numbers = np.repeat(np.array(some), size)
        for (j, k), weight in zip(_STEPS, _WEIGHTS):
            third = table[:, k: k + size]
            real = ((first > 0) & (third > 0)).ravel()
            feature = ((first * LETTERS + table[:, j: j + size]) * LETTERS + third).ravel()
            parts.append((numbers[real], feature[real], np.full(int(real.sum()), weight, np.float32)))
    if not parts:
        return np.empty(0, int), np.empty(0, int), np.empty(0, np.float32)
    return tuple(np.concatenate(x) for x in zip(*parts))


def norms(words: list[str]) -> np.ndarray:
    """The norm of a word of each word's length whose subsequences all differ."""
    size = np.array([len(w) + 2 for w in words], np.float64)
    total = sum(w * w * np.maximum(0, size - k) for (_, k), w in zip(_STEPS, _WEIGHTS.astype(np.float64)))
    return np.sqrt(np.maximum(total, 1e-9))


class Landmarks:
    """Words whose subsequences others are compared with; ``values`` are kernel values with each."""

    def __init__(self, words: list[str]):
        self.words = words
        number, feature, weight = subsequences(words)
        self.features, place = np.unique(feature, return_inverse=True)
        self.table = np.zeros((len(self.features) + 1, len(words)))
        np.add.at(self.table, (place, number), weight / norms(words)[number])
        self.place = np.full(LETTERS**3, len(self.features))
        self.place[self.features] = np.arange(len(self.features))

    def values(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.words)))
        for begin in range(0, len(words), 128):  # bounds the table of occurrences by landmarks
            some = words[begin: begin + 128]
            number, feature, weight = subsequences(some)
            known = self.place[feature] < len(self.features)
            order = np.flatnonzero(known)[np.argsort(number[known], kind="stable")]
            if len(order):
                own = number[order]
                starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                rows = self.table[self.place[feature[order]]] * weight[order, None]
                out[begin + own[starts]] = np.add.reduceat(rows, starts, axis=0)
        return out / norms(words)[:, None]

    def folded(self, weights: np.ndarray) -> np.ndarray:
        """One weight per subsequence for a linear function of the kernel values."""
        out = np.zeros(LETTERS**3, np.float32)
        out[self.features] = self.table[:-1] @ weights
        return out


def train_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 30) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by damped Newton steps over the rows inside the margin."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6

    def loss(v: np.ndarray) -> float:
        return v @ ridge @ v + (cost * np.maximum(0, 1 - y * (x @ v)) ** 2).sum()

    now = loss(w)
    for _ in range(steps):
        active = y * (x @ w) < 1
        a = x[active]
        move = np.linalg.solve(ridge + a.T @ (a * cost[active, None]), a.T @ (y * cost)[active]) - w
        part = 1.0
        while part > 1e-3 and loss(w + part * move) > now:
            part /= 2
        w = w + part * move
        before, now = now, loss(w)
        if now > before * (1 - 1e-6):
            break
    return w[:-1], float(w[-1])


class Machine:
    """A trained scorer of words and texts."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.weights, self.bias, self.slope, self.offset = weights, bias, slope, offset
        self.known: dict[str, float] = {}

    def word_scores(self, words: list[str]) -> np.ndarray:
        out = np.zeros(len(words))
        for begin in range(0, len(words), 8192):
            some = words[begin: begin + 8192]
            number, feature, weight = subsequences(some)
            sums = np.bincount(number, self.weights[feature] * weight, len(some))
            out[begin: begin + 8192] = sums / norms(some)
        return out + self.bias

    def margins(self, texts: list[str]) -> np.ndarray:
        """The highest word of each text; a text without words has the score of an empty word."""
        found = [sentence_words(t) or {""} for t in texts]
        fresh = list(set().union(*found) - self.known.keys())
        if len(self.known) + len(fresh) > KEPT_WORDS:
            self.known.clear()
            fresh = list(set().union(*found))
        self.known.update(zip(fresh, self.word_scores([clean_word(t) for t in fresh]).tolist()))
        return np.array([max(map(self.known.__getitem__, f)) for f in found])

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(texts) + self.offset, -30, 30)))


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve from margins to probabilities, with softened labels, by Newton steps."""
    up, down = int((y > 0).sum()), int((y < 0).sum())
    goal = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    x, w = np.c_[margin, np.ones(len(margin))], np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        change = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - goal) + 1e-3 * (w - [1, 0]))
        w = w - np.clip(change, -2, 2)
    return max(float(w[0]), 1e-3), float(w[1])


def surprise(up: float, down: float, share: float) -> float:
    """How much likelier ``up`` of the texts with a word are toxic than at the usual share, as a logarithm."""
    part = up / (up + down)
    if part <= share:
        return 0.0
    return up * np.log(part / share) + (down * np.log((1 - part) / (1 - share)) if down else 0.0)


def sure_words(toxic_bags: list[set[str]], other: Counter, other_begins: Counter, share: float) -> set[str]:
    """Words that mark toxic texts beyond chance, or whose first letters do.

    ``other`` and ``other_begins`` count the other texts with a word and with a beginning.

    Copies of a text are one piece of evidence: bags with the same least word hash, as near copies
    mostly have, share one vote.
    """
    marks = [min(zlib.crc32(w.encode()) for w in bag) for bag in toxic_bags]
    votes = Counter(marks)

    def sure(parts: list[set[str]], others: Counter) -> set[str]:
        counts: dict[str, float] = {}
        for own, mark in zip(parts, marks):
            for part in own:
                counts[part] = counts.get(part, 0.0) + 1 / votes[mark]
        least = np.log(len(counts.keys() | others.keys())) + 5  # chance alone gives hardly any
        return {p for p, n in counts.items() if surprise(n, others[p], share) > least}

    whole = sure(toxic_bags, other)
    begun = sure([{w[:STEM] for w in bag if len(w) > STEM} for bag in toxic_bags], other_begins)
    return whole | {w for bag in toxic_bags for w in bag if w[:STEM] in begun and len(w) > STEM and not other[w]}


def train(texts: list[str], labels: list[int]) -> Machine:
    """Train on whole texts with labels 0 and 1; with one label only, scores are that share."""
    y = np.where(np.array(labels) == 1, 1.0, -1.0)
    if not len(y) or abs(y.sum()) == len(y):
        share = float((y > 0).mean()) if len(y) else 0.0
        return Machine(np.zeros(LETTERS**3, np.float32), 0.0, 1e-3, float(np.clip(np.log((share + 1e-9) / (1 - share + 1e-9)), -30, 30)))
    shared: dict[str, str] = {}  # one object per word, however many texts hold it
    bags = [{shared.setdefault(w, w) for w in map(clean_word, sentence_words(x))} or {""} for x in texts]
    toxic, other = Counter(), Counter()
    for bag, sign in zip(bags, y):
        (toxic if sign > 0 else other).update(bag)
    up, down = (y > 0).sum(), (y < 0).sum()
    odds = {w: n * np.log((n / up) / ((other[w] + 0.5) / down)) for w, n in toxic.items()}
    toxic_bags = [b for b, s in zip(bags, y) if s > 0]
    other_begins = Counter(p for b, s in zip(bags, y) if s < 0 for p in {w[:STEM] for w in b if len(w) > STEM})
    strong = sure_words(toxic_bags, other, other_begins, up / (up + down))
    ranked = sorted(odds, key=lambda w: (-odds[w], w))
    by_hash = sorted(other.keys() - strong, key=lambda w: (zlib.crc32(w.encode()), w))
    negatives = by_hash[:TRAIN_WORDS]
    marks = list(dict.fromkeys(ranked[: LANDMARKS // 2] + by_hash[: LANDMARKS // 2]))
    landmarks = Landmarks(marks)
    values, vectors = np.linalg.eigh(landmarks.values(marks))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    others = landmarks.values(negatives) @ root

    def fit(positives: Counter, more: Counter) -> Machine:
        counts = [positives, Counter(negatives), more]
        x = np.concatenate([landmarks.values(list(positives)) @ root, others, landmarks.values(list(more)) @ root])
        times = np.array([n for c in counts for n in c.values()], np.float64)
        signs = np.where(np.arange(len(x)) < len(positives), 1.0, -1.0)
        share = np.where(signs > 0, times[signs > 0].sum(), times[signs < 0].sum())
        w, bias = train_svm(x, signs, 5.0 * times.sum() * times / share)
        return Machine(landmarks.folded(root @ w), bias, 1.0, 0.0)

    words = sorted(set().union(*bags))
    # Sure words stand for a text; elsewhere the machine picks.
    sure = Counter(w for b in toxic_bags for w in sorted(b & strong))
    machine = fit(sure or Counter(ranked[: max(1, len(ranked) // 50)]), Counter())
    for _ in range(ROUNDS):
        score = dict(zip(words, machine.word_scores(words).tolist()))
        picked = [max(sorted(b), key=score.__getitem__) for b in toxic_bags if not b & strong]
        positives = sure + Counter(w for w in picked if not other[w]) or Counter(picked)
        hardest = Counter(max(sorted(b - strong) or [""], key=lambda w: score.get(w, -9.0)) for b, s in zip(bags, y) if s < 0)
        machine = fit(positives, hardest)
    margins = [machine.margins(texts[i: i + 100]) for i in range(0, len(texts), 100)]
    machine.slope, machine.offset = _platt(np.concatenate(margins), y)
    machine.known = {}
    return machine


def is_held_out(id_column: Column) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAIN_TEXTS) -> DataFrame:
    """Rows (toxic, text) of at most ``most`` labelled rows of each label that are not held out.

    Rows are picked by a hash of their id from the labels alone; the texts are then joined to them.
    """
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~is_held_out(F.col("id"))
    ).distinct()
    ranked = F.xxhash64(F.col("id").cast("string"))
    picked = known.filter("toxic = 1").orderBy(ranked, "id").limit(most).unionByName(
        known.filter("toxic = 0").orderBy(ranked, "id").limit(most)
    )
    return docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).join(
        F.broadcast(picked), "id"  # at most twice ``most`` rows
    ).distinct().select("toxic", "text")


def _fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    rows = sorted((text, toxic) for batch in batches for text, toxic in zip(batch["text"], batch["toxic"]))
    machine = train([t for t, _ in rows], [y for _, y in rows])
    yield pd.DataFrame({
        "weights": [machine.weights.tobytes()], "bias": [machine.bias], "slope": [machine.slope], "offset": [machine.offset],
    })


def fitted(rows: DataFrame) -> Machine:
    """The machine trained on rows (toxic, text), of which there is a bounded number, in one task."""
    kind = "weights binary, bias double, slope double, offset double"
    row = rows.repartition(1).mapInPandas(_fit, kind).first()
    if row is None:
        return train([], [])
    return Machine(np.frombuffer(row["weights"], np.float32), row["bias"], row["slope"], row["offset"])


def toxicity(docs: DataFrame, labels: DataFrame, most: int = TRAIN_TEXTS):
    """A function of a text column, the probability that a text is toxic, trained on labelled rows.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic (0 or 1; other values are no labels).
    Rows whose crc32(doc_id as text) mod 3 is 1 are held out of training. Only the text is scored.

    * Null and empty texts get the score of a text without words.
    * No labelled rows: 0 for all texts (within 1e-12); one label only: near that label for all.
    * Null ids are in no training set; repeated rows are learnt once. Long texts are scored whole.
    """
    machine = fitted(training_rows(docs, labels, most))
    parts = machine.weights, machine.bias, machine.slope, machine.offset

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Machine(*parts)
        for texts in batches:
            values = texts.tolist()
            yield pd.Series(np.concatenate([own.scores(values[i: i + 500]) for i in range(0, len(values), 500)] or [np.empty(0)]))

    return lambda text: score(F.coalesce(text, F.lit("")))
