"""Problem 10: abusive, hateful and sexually explicit wording.

Texts are brought to one spelling and cut into windows of words; a factorization machine over hashed words and word pairs
scores every window, learning which terms matter together, such as an insult and a group. A document scores as its worst
window. It is trained on labelled documents as bags of windows: in an abusive one the worst window is the example, in a
clean one all are; labels that a machine trained on the other half contradicts firmly are set aside.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .normal import canonical, without_accents

SLOTS, FACTORS = 1 << 17, 8  # hashed terms, and latent factors per term
WINDOW, STRIDE = 14, 7  # words per window, and between windows
TERMS = 2 * WINDOW - 1  # a window's words and neighbouring pairs
LABELLED = 20_000  # documents the model is fitted on at most, chosen by hash
EPOCHS, RATE, BATCH, LEAST_STEPS = 10, 0.4, 512, 8
SPREAD = 256  # windows over which a gradient is averaged at most, so that an epoch moves as far whatever the batch
MISSED, SEEN = -1.5, 0.5  # raw scores at which the other half's machine contradicts a label of abuse, or of none
RELIABLE = 0.6  # part of each kind of label that the other half's machine must agree with before it contradicts any: raters err
TELLING = 1.0  # mean log odds of a window's terms from which it is an example by itself
UNKNOWN = 0.1  # by how much the cut lies above the raw score of a window of unknown words, at least
KNOWN = 1 << 19  # spellings that a worker remembers before it begins anew
_LEET = str.maketrans("013457@$", "oieastas")
_TAG = re.compile(r"<[^<>]{0,200}>")
_SPACED = re.compile(r"(?<![\w'])[^\W\d_]([ .\-])(?:[^\W\d_]\1)+[^\W\d_](?![\w'])")
_TOKEN = re.compile(r"[^\W_][\w*@$'ऀ-ॣ]*\u0f0b?|\*+\w[\w*]*", re.UNICODE)
_SENTENCE = re.compile(r"[.!?;:\n।…]+(?=\s|$)")
BETWEEN = "\x01"  # stands between sentences while a text is normalised
JOINED = "\u0f0b"
_RUN = re.compile(r"([^\W\d_])\1+")


def _word(token: str) -> str:
    """One spelling of a token: no repeated letters, digits as the letters they stand for, plain numbers as 0."""
    if token.isdigit():
        return "0"
    if any(c in "013457@$" for c in token) and any(c.isalpha() for c in token) and not any(c in "2689" for c in token):
        token = token.translate(_LEET)
    return _RUN.sub(r"\1", token.replace("'", ""))


def _joined(match: re.Match) -> str:
    """A spaced-out word, marked, because several words in a row may have been spaced out alike."""
    return match.group().replace(match.group(1), "") + JOINED


def tokens(text: str) -> list[list[str]]:
    """Sentences as raw tokens, after removal of markup and joining of spaced-out words."""
    form = _TAG.sub(" ", text) if "<" in text else text
    # sentences are parted before normalisation, which changes their marks and line ends; what keeps a word from its parts
    # is taken out before spaced-out letters are looked for
    plain = _SPACED.sub(_joined, without_accents(canonical(_SENTENCE.sub(BETWEEN, form))))
    return [found for sentence in plain.split(BETWEEN) if (found := _TOKEN.findall(sentence))]


class Masks:
    """The words of the labelled texts, with which masked (b**d) and spaced-out (b a d) words are read."""

    def __init__(self, counts: Counter, pairs: Counter):
        self.counts = Counter({w: n for w, n in counts.items() if "*" not in w and not w.endswith(JOINED)})
        self.pairs = pairs
        self.by = defaultdict(list)
        for word in sorted(self.counts):
            self.by[len(word)].append(word)
        self.longest = max(self.by, default=0)
        self.total = sum(self.counts.values()) + 1
        self.seen: dict[str, list[str]] = {}

    def _fitting(self, token: str) -> list[str]:
        pattern = re.compile(re.sub(r"\\\*", ".", re.escape(token)))
        return [w for w in self.by[len(token)] if pattern.fullmatch(w)]

    def _split(self, text: str) -> list[str]:
        """The likeliest words whose letters in a row are the text, or the text itself."""
        if self.counts[text] > 1:
            return [text]
        best: list[tuple[float, int] | None] = [(0.0, 0)] + [None] * len(text)
        for end in range(1, len(text) + 1):
            for start in range(max(0, end - self.longest), end):
                n = self.counts.get(text[start:end])
                if n and best[start]:
                    cost = best[start][0] - np.log(n / self.total)
                    if best[end] is None or cost < best[end][0]:
                        best[end] = (cost, start)
        if not best[-1]:
            return [text]
        out, end = [], len(text)
        while end:
            start = best[end][1]
            out.append(text[start:end])
            end = start
        return out[::-1]

    def read(self, sentence: list[str]) -> list[str]:
        """The words of a sentence's tokens: of the words that fit a mask the one most often found after the word before."""
        if not any("*" in t or t.endswith(JOINED) for t in sentence):
            return sentence
        out: list[str] = []
        for t in sentence:
            if "*" not in t and not t.endswith(JOINED):
                out.append(t)
                continue
            if t not in self.seen:
                if len(self.seen) > KNOWN:
                    self.seen.clear()
                self.seen[t] = self._split(t[:-1]) if t.endswith(JOINED) else self._fitting(t)
            words = self.seen[t]
            if t.endswith(JOINED):
                out += words
            elif words:
                out.append(max(words, key=lambda w: (self.pairs.get((out[-1] if out else "", w), 0), self.counts[w])))
            else:
                out.append(t.replace("*", ""))
        return out


_HASHES: dict[str, int] = {}  # of tokens this worker has seen


def _hash(token: str) -> int:
    found = _HASHES.get(token)
    if found is None:
        if len(_HASHES) > KNOWN:
            _HASHES.clear()
        found = _HASHES[token] = xxhash.xxh3_64_intdigest(_word(token).encode("utf-8", "surrogatepass"))
    return found


def encode_all(texts: Iterable[list[list[str]]]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, at): the term slots of every window of each text, given as sentences, and the text's place for each window.

    A window has WINDOW words of one sentence, STRIDE apart; a sentence of one word is a window of its own. Slots are of
    words and of neighbouring pairs, each once; slot 0 is padding.
    """
    hashes, lengths, owners = [], [], []
    for place, sentences in enumerate(texts):
        for s in sentences:
            hashes += map(_hash, s)
            lengths.append(len(s))
            owners.append(place)
    if not lengths:
        return np.zeros((0, TERMS), np.int32), np.zeros(0, np.int64)
    word, length = np.array(hashes, np.uint64), np.array(lengths)
    begins = np.cumsum(length) - length
    many = np.maximum(1, -(-(length - STRIDE) // STRIDE))
    first = np.repeat(np.cumsum(many) - many, many)
    offset = (np.arange(many.sum()) - first) * STRIDE
    start, left = np.repeat(begins, many) + offset, np.repeat(length, many) - offset
    at = start[:, None] + np.arange(WINDOW)
    there = np.arange(WINDOW) < left[:, None]
    own = word[np.minimum(at, len(word) - 1)]
    with np.errstate(over="ignore"):
        pair = own[:, :-1] * np.uint64(0x9E3779B97F4A7C15) + own[:, 1:] * np.uint64(0xC2B2AE3D27D4EB4F)
        pair ^= pair >> np.uint64(29)
    slots = lambda h: (h % np.uint64(SLOTS - 1) + np.uint64(1)).astype(np.int32)
    ids = np.sort(np.concatenate([slots(own) * there, slots(pair) * there[:, 1:]], axis=1), axis=1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = 0
    return ids, np.repeat(np.array(owners), many)


_ROW = np.random.default_rng(1).integers(1, 1 << 62, TERMS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each different window once, told apart by a 64-bit hash, and how often it stands there."""
    with np.errstate(over="ignore"):
        _, first, n = np.unique((ids.astype(np.uint64) * _ROW).sum(1), return_index=True, return_counts=True)
    return ids[first], n


@dataclass
class Machine:
    """Bias, weights and factors of the hashed terms, and the words for masked tokens."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    masks: Masks
    cut: float = 0.0  # raw score from which a window counts as abusive

    def raw(self, ids: np.ndarray, chunk: int = 8192) -> np.ndarray:
        out = np.empty(len(ids), np.float32)
        for i in range(0, len(ids), chunk):
            out[i : i + chunk] = _forward(self, ids[i : i + chunk])[0]
        return out

    def worst(self, texts: Iterable[list[list[str]]], n: int) -> np.ndarray:
        """The greatest raw score of each of n texts given as sentences; -inf for a text without words."""
        ids, at = encode_all(texts)
        out = np.full(n, -np.inf)
        np.maximum.at(out, at, self.raw(ids))
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Score of each text; texts are encoded and scored a batch at a time."""
        out, begin, size = np.zeros(len(texts)), 0, 0
        for end, text in enumerate(texts, 1):
            size += len(text or "")
            if size > 2_000_000 or end == len(texts):  # a long text must not be held as windows along with many others
                part = [[self.masks.read(s) for s in tokens(t)] if t else [] for t in texts[begin:end]]
                worst = self.worst(part, len(part))
                out[begin:end] = np.where(np.isfinite(worst), 1 / (1 + np.exp(-np.clip(worst - self.cut, -30, 30))), 0.0)
                begin, size = end, 0
        return out


def _forward(machine: Machine, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(raw score, value of each of its terms, sum of its factors) of each window; a window's values have length one together."""
    here = ids > 0
    x = (1 / np.sqrt(np.maximum(here.sum(1), 1))).astype(np.float32)
    v = machine.factors[ids]  # padding's are zero
    total = v.sum(1) * x[:, None]
    squares = np.einsum("ntf,ntf->n", v, v) * x * x
    return machine.bias + machine.weights[ids].sum(1) * x + 0.5 * ((total * total).sum(1) - squares), x, total


def _first_scores(bags: list[np.ndarray], labels: np.ndarray, shrink: float = 4.0) -> np.ndarray:
    """How much each term speaks for abuse, by the documents it is in, drawn towards nothing where they are few."""
    clean, bad = np.zeros(SLOTS), np.zeros(SLOTS)
    for ids, y in zip(bags, labels):
        (bad if y >= 0.5 else clean)[np.unique(ids)] += 1
    part = (labels >= 0.5).mean()
    odds = np.log(bad + shrink * part) - np.log(clean + shrink * (1 - part)) - np.log(part / (1 - part))
    odds[0] = 0
    return odds


class _Batch:
    """Windows with what a gradient step needs to know of them: their terms in order, and where each term begins."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        flat = ids.ravel()
        order = np.argsort(flat)
        order = order[np.searchsorted(flat[order], 1) :]
        self.rows = order // ids.shape[1]
        self.used, self.begins = np.unique(flat[order], return_index=True)


def fit(bags: list[np.ndarray], labels: np.ndarray, masks: Masks, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """A machine fitted to labelled bags of windows by adaptive gradient steps on the logistic loss."""
    rng = np.random.default_rng(seed)
    machine = Machine(0.0, np.zeros(SLOTS, np.float32), rng.normal(0, 0.05, (SLOTS, FACTORS)).astype(np.float32), masks)
    machine.factors[0] = 0
    kept = [(ids, y) for ids, y in zip(bags, labels) if len(ids)]
    bad, clean = [x for x in kept if x[1] >= 0.5], [x for x in kept if x[1] < 0.5]
    if not bad or not clean:
        machine.bias = 6.0 if bad else -6.0
        return machine
    odds = _first_scores([x[0] for x in kept], np.array([x[1] for x in kept]))
    negative, often = distinct(np.concatenate([ids for ids, _ in clean]))
    # empty windows are clean: a window of unknown words must not stand near the cut
    blank = np.zeros((1 + len(negative) // 10, TERMS), np.int32)
    # a clean window weighs as often as it is said, the empty ones together a tenth of that
    often = np.concatenate([often, np.full(len(blank), max(1.0, often.sum() / 10 / len(blank)))]).astype(np.float32)
    negative = np.concatenate([negative, blank])
    worst_of = np.concatenate([[0], np.cumsum([len(ids) for ids, _ in bad])])
    every = np.concatenate([ids for ids, _ in bad])
    # besides its worst window, windows of an abusive document whose terms speak for abuse by themselves are examples too
    told = (odds[every] * (every > 0)).sum(1) / np.maximum((every > 0).sum(1), 1)
    telling = np.flatnonzero(told >= TELLING)
    grown = [np.full(SLOTS, 1e-2, np.float32), np.full((SLOTS, FACTORS), 1e-2, np.float32), 1e-2]
    for epoch in range(epochs):
        scores = told if epoch == 0 else machine.raw(every)
        worst = [low + int(np.argmax(scores[low:high])) for low, high in zip(worst_of, worst_of[1:])]
        chosen = np.union1d(telling, worst)
        ids = np.concatenate([every[chosen], negative])
        y = np.concatenate([np.ones(len(chosen), np.float32), np.zeros(len(negative), np.float32)])
        # abusive documents weigh as much as clean windows do, up to a limit
        weight = np.concatenate([np.full(len(chosen), min(8.0, max(1.0, 0.5 * often.sum() / len(chosen))), np.float32), often])
        order = rng.permutation(len(ids))
        n_steps = max(min(LEAST_STEPS, len(ids)), -(-len(ids) // BATCH))
        for at in np.array_split(order, n_steps):
            _step(machine, grown, _Batch(ids[at]), y[at], weight[at])
    return machine


def _step(machine: Machine, grown: list, batch: _Batch, y: np.ndarray, weight: np.ndarray, rate: float = RATE, decay: float = 2e-5) -> None:
    raw, x, total = _forward(machine, batch.ids)
    off = ((1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y) * weight / min(SPREAD, len(y))).astype(np.float32)
    share = off * x
    sums = np.add.reduceat(np.concatenate([share[:, None], (share * x)[:, None], share[:, None] * total], axis=1)[batch.rows], batch.begins) if len(batch.used) else np.zeros((0, FACTORS + 2), np.float32)
    used = batch.used
    factors = machine.factors[used]
    gw = sums[:, 0] + decay * machine.weights[used]
    gv = sums[:, 2:] - sums[:, 1:2] * factors + decay * factors
    grown[0][used] += gw * gw
    grown[1][used] += gv * gv
    g = float(off.sum())
    grown[2] += g * g
    machine.weights[used] -= rate * gw / np.sqrt(grown[0][used])
    machine.factors[used] = factors - rate * gv / np.sqrt(grown[1][used])
    machine.bias -= rate * g / np.sqrt(grown[2])


def _best_cut(raw: np.ndarray, abusive: np.ndarray) -> float:
    """The raw score that parts abusive from clean best: the greatest harmonic mean of precision and recall."""
    order = np.argsort(-raw)
    hit = np.cumsum(abusive[order])
    f = 2 * hit / (np.arange(1, len(raw) + 1) + max(1, abusive.sum()))
    at = int(np.argmax(f))
    beyond = raw[order[at + 1]] if at + 1 < len(raw) else raw[order[at]] - 1
    return float((raw[order[at]] + beyond) / 2)


def train(texts: list[str], labels: list[float], epochs: int = EPOCHS) -> Machine:
    """A machine from labelled texts (labels are shares of raters who found abuse).

    Two machines fitted on a half each judge the other half, twice. Where the judging machine agrees with nearly all
    labels of either kind, labels that it contradicts firmly are set aside, and raters' ties are decided where it is sure;
    a machine that knows too little contradicts nothing. The cut lies midway between the labels that were kept, as the
    machine fitted on them scores them and, where these judged, as the halves' machines do.
    """
    counts, pairs = Counter(), Counter()
    cut = [tokens(t or "") for t in texts]
    for sentences in cut:
        for s in sentences:
            counts.update(set(s))
            pairs.update(zip(["", *s], s))
    masks = Masks(counts, pairs)
    ids, at = encode_all([[masks.read(s) for s in x] for x in cut])
    ends = np.searchsorted(at, np.arange(len(texts) + 1))
    bags = [distinct(ids[low:high])[0] for low, high in zip(ends, ends[1:])]
    given = np.array(labels, dtype=np.float32)
    used = np.array([len(b) > 0 for b in bags], bool)
    half, clear = np.arange(len(bags)) % 2, used & ((given <= 0.25) | (given >= 0.75))
    y, keep = given.copy(), clear.copy()
    for again in range(2):
        raw, sure = np.zeros(len(bags)), np.zeros(len(bags), bool)
        for part in (0, 1):
            other, judged = np.flatnonzero((half != part) & keep), np.flatnonzero((half == part) & used)
            if not len(judged) or len(set(y[other] >= 0.5)) < 2:
                continue
            machine = fit([bags[i] for i in other], y[other], masks, epochs, seed=7 + again)
            raw[judged] = [machine.raw(bags[i]).max() for i in judged]
            told = judged[clear[judged]]
            agreed = [np.mean((raw[told] > 0)[(given[told] >= 0.5) == kind] == kind) if ((given[told] >= 0.5) == kind).any() else 0.0 for kind in (True, False)]
            sure[judged] = min(agreed) >= RELIABLE
        y = np.where(clear, given, np.where(sure, raw > 0, given >= 0.5)).astype(np.float32)
        wrong = sure & (((y >= 0.5) & (raw < MISSED)) | ((y < 0.5) & (raw > SEEN)))
        keep = used & ~wrong & (clear | (sure & (np.abs(raw) > 1.0)))
    chosen = np.flatnonzero(keep)
    machine = fit([bags[i] for i in chosen], y[chosen], masks, epochs)
    if len(set(y[chosen] >= 0.5)) == 2:
        # what is known of no word must not count as abusive
        told = labels_of(y[chosen])
        cuts = [_best_cut(np.array([machine.raw(bags[i]).max() for i in chosen]), told)] + ([_best_cut(raw[chosen], told)] if sure[chosen].all() else [])
        machine.cut = max(machine.bias + UNKNOWN, float(np.mean(cuts)))
    return machine


def labels_of(y: np.ndarray) -> np.ndarray:
    return (y >= 0.5).astype(np.int64)


def abuse_scores(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", bound: int = LABELLED, threshold: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """(key, columns to keep, score, flagged) of every document, by a machine fitted to the labelled ones.

    labels has the key and `abusive` (0 or 1), with a row per rater; rows with a null in either are left out. At most
    `bound` labelled documents, chosen by hash, are brought to the driver for fitting; every document is scored, whole.
    Null, blank and wordless texts score 0. Without labels of both kinds all documents with words score alike. Other
    columns are not read.
    """
    spark = documents.sparkSession
    voted = labels.where(F.col(key).isNotNull() & F.col("abusive").isNotNull()).groupBy(key).agg(F.avg(F.col("abusive").cast("double")).alias("_y"))
    sample = documents.select(key, F.col(text).alias("_t")).join(voted, key).where("_t IS NOT NULL").orderBy(F.xxhash64(key), key).limit(bound).select("_t", "_y").toPandas()
    machine = spark.sparkContext.broadcast(train(sample["_t"].tolist(), sample["_y"].tolist()))

    @F.pandas_udf(T.DoubleType())
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(machine.value.scores(texts.tolist()), dtype="float64")

    return documents.select(key, *(keep or []), scored(F.col(text)).alias("score")).withColumn("flagged", F.col("score") > threshold)
