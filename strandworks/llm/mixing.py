"""Problem 9: a mix of sources at target shares of its tokens.

A classifier fitted to the labelled table predicts how much each document belongs to every domain. A projected gradient
finds each document's rate between 0 and its source's cap such that the expected tokens of all domains match their
targets: every step is one aggregation over all documents, and the driver holds only a few numbers per domain. Since
targets are defined on the sources that documents state, steps of the same kind then move the rates of each stated source
until its tokens match too. Rates become whole numbers of copies by a hash of the document, with a cut-off per source.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed
from .normal import words

TERMS = 4096  # hashed words of the classifier
FITTED = 3000  # documents the classifier is fitted on at most, chosen by hash
BINS = 4096  # bins in which a source's cut-off is sought
STEPS, NEAR = 12, 0.002  # steps of the gradient at most, and the relative distance of totals from targets at which it ends


@lru_cache(maxsize=1 << 18)
def _slot(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) % TERMS


def features(text: str | None) -> np.ndarray:
    """Slots of a text's distinct words."""
    return np.array(sorted(set(map(_slot, words(text or "").split()))), dtype=np.int64)


class Membership:
    """A multinomial logistic classifier over hashed words, by batch gradient steps."""

    def __init__(self, texts: list[str | None], domains: list[str]):
        self.names = sorted(set(domains))
        place = {name: i for i, name in enumerate(self.names)}
        x = np.zeros((len(texts), TERMS), np.float32)
        for row, t in zip(x, texts):
            at = features(t)
            if len(at):
                row[at] = 1 / np.sqrt(len(at))
        y = np.zeros((len(texts), len(self.names)), np.float32)
        y[np.arange(len(texts)), [place[d] for d in domains]] = 1
        self.weights, self.bias = np.zeros((TERMS, len(self.names)), np.float32), np.zeros(len(self.names), np.float32)
        for _ in range(120):
            off = (_softmax(x @ self.weights + self.bias) - y) / max(1, len(texts))
            self.weights -= 8 * (x.T @ off + 1e-5 * self.weights)
            self.bias -= 2 * off.sum(0)

    def posteriors(self, text: str | None) -> np.ndarray:
        at = features(text)
        raw = self.bias + (self.weights[at].sum(0) / np.sqrt(len(at)) if len(at) else 0)
        return _softmax(raw[None])[0]


def _softmax(raw: np.ndarray) -> np.ndarray:
    e = np.exp(raw - raw.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def attainable(share: np.ndarray, most: np.ndarray, total: float) -> np.ndarray:
    """Tokens aimed at per source: shares of the total, where what a source lacks at its cap goes to the others by their shares."""
    goal, free = np.zeros(len(share)), np.ones(len(share), bool)
    for _ in range(len(share) + 1):
        left = share * free
        if left.sum() <= 0:
            break
        goal = np.where(free, left / left.sum() * max(0.0, total - goal[~free].sum()), goal)
        short = free & (goal > most)
        if not short.any():
            break
        goal[short], free = most[short], free & ~short
    return np.minimum(goal, most)


def fit_rates(documents: DataFrame, shares: list, goal: np.ndarray, steps: int = STEPS) -> DataFrame:
    """documents with their column `rate`, in [0, cap], moved until the sums of rate x tokens x share match the goal per domain.

    Projected gradient steps on the squared distance of the totals, each scaled by the tokens that can still move. A step
    sums over all documents on the cluster; rates are expressions of the steps' few numbers, so nothing is shuffled but the
    sums. It ends when all totals are NEAR their goal, when no total comes nearer, or after the given number of steps.
    """
    best = np.inf
    for _ in range(steps):
        sums = [F.sum(F.col("rate") * F.col("_tokens") * p).alias(f"d{i}") for i, p in enumerate(shares)]
        # what can move: all that is not held at the bound towards which it would go
        low = [F.sum(F.when(F.col("rate") < F.col("cap"), F.col("_tokens") * p)).alias(f"up{i}") for i, p in enumerate(shares)]
        high = [F.sum(F.when(F.col("rate") > 0, F.col("_tokens") * p)).alias(f"down{i}") for i, p in enumerate(shares)]
        row = documents.agg(*sums, *low, *high).first()
        off = np.array([float(row[f"d{i}"] or 0) - g for i, g in enumerate(goal)])
        movable = np.array([float(row[f"{'up' if x < 0 else 'down'}{i}"] or 0) for i, x in enumerate(off)])
        worst = float(np.max(np.abs(off) * (movable > 0) / np.maximum(goal, goal.sum() * 1e-3)))
        if worst <= NEAR or worst > best * 0.98:
            break
        best = worst
        step = np.where(movable > 0, off / np.maximum(movable, 1e-9), 0.0)
        move = sum((p * F.lit(float(x)) for p, x in zip(shares, step)), F.lit(0.0))
        documents = documents.withColumn("rate", F.greatest(F.lit(0.0), F.least(F.col("cap").cast("double"), F.col("rate") - move)))
    return documents


def mix(documents: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", tokens: str = "tokens", total: float | None = None, fitted: int = FITTED) -> DataFrame:
    """(key, source, tokens, copies, posterior) of every document used at least once; posteriors are in the order of the sorted sources.

    targets has `source`, `target_share` and `max_repeats` for each of boundedly many sources. The mix aims at `total`
    tokens, those of all documents if not given. A document's own source counts; documents whose source is null or has no
    target are used only so far as predicted domains ask for them, at most once. A source whose documents don't suffice at
    their cap is used at its cap. Documents without tokens are not used. Each key should be unique, as document ids are;
    texts are read whole. Other columns are not read.
    """
    spark = documents.sparkSession
    wanted = targets.where("source IS NOT NULL").select("source", "target_share", "max_repeats").orderBy("source").collect()
    names = [r["source"] for r in wanted]
    usable = documents.select(key, F.col(text).alias("_text"), F.col(source).alias("_source"), F.col(tokens).alias("_tokens"))
    known = documents.where(F.col(source).isin(names) & (F.trim(F.col(text)) != "")).select(key, F.col(text).alias("_text"), F.col(source).alias("_source"))
    sample = known.orderBy(F.xxhash64(key), key).limit(fitted).select("_text", "_source").toPandas() if names else []
    if not len(sample):  # no source, or none of its documents
        return usable.select(key, F.col("_source").alias("source"), F.col("_tokens").alias("tokens"), F.lit(0).alias("copies"), F.array().cast("array<double>").alias("posterior")).limit(0)
    model = spark.sparkContext.broadcast(Membership(sample["_text"].tolist(), sample["_source"].tolist()))
    present = [model.value.names.index(n) if n in model.value.names else -1 for n in names]

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def posteriors(texts: pd.Series) -> pd.Series:
        p = np.array([model.value.posteriors(t) for t in texts], np.float64).reshape(-1, len(model.value.names))
        return pd.Series(list(np.concatenate([p, np.zeros((len(p), 1))], axis=1)[:, present]))

    order = F.array(*[F.lit(n) for n in names])
    own = F.coalesce(F.when(F.col("_source").isin(names), F.array_position(order, F.col("_source"))), F.lit(0)).cast("int") - 1
    cap = F.coalesce(F.element_at(F.array(*[F.lit(int(r["max_repeats"] or 0)) for r in wanted], F.lit(1)), F.when(F.col("own") >= 0, F.col("own") + 1).otherwise(len(names) + 1)), F.lit(1))
    # texts are read once, for tokens and posteriors together; a filter on tokens before would count them twice
    kept = checkpointed(usable.select(key, "_source", "_tokens", own.alias("own"), posteriors("_text").alias("_p"))).where("_tokens > 0").withColumn("cap", cap)
    share = np.array([float(r["target_share"] or 0) for r in wanted])
    held = {r["own"]: float(r["t"]) for r in kept.groupBy("own").agg(F.sum("_tokens").alias("t")).collect()}  # one row per source
    caps = np.array([float(r["max_repeats"] or 0) for r in wanted])
    most = np.array([held.get(i, 0.0) for i in range(len(names))]) * caps
    goal = attainable(share, most, float(total) if total is not None else sum(held.values()))
    soft = [F.col("_p")[i] for i in range(len(names))]
    hard = [(F.col("own") == i).cast("double") for i in range(len(names))]
    used = fit_rates(kept.withColumn("rate", F.least(F.lit(1.0), F.col("cap"))), soft, goal)
    used = fit_rates(used, hard, goal)
    loose = used.where("own < 0").agg(F.sum(F.col("rate") * F.col("_tokens"))).first()[0] or 0.0
    # a uniform number of each document decides on its last copy
    uniform = F.pmod(F.xxhash64(F.lit("mix"), key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    spread = used.withColumn("_base", F.floor("rate").cast("int")).withColumn("_over", uniform - (F.col("rate") - F.floor("rate")))
    bins = spread.withColumn("_bin", F.floor((F.col("_over") + 1) / 2 * BINS).cast("int"))
    room = F.when(F.col("_base") < F.col("cap"), F.col("_tokens")).otherwise(0)
    counted = bins.groupBy("own", "_bin").agg(F.sum(F.col("_base") * F.col("_tokens")).alias("base"), F.sum(room).alias("more")).orderBy("own", "_bin").collect()
    cuts = []
    for s in sorted({r["own"] for r in counted}):
        mine = [r for r in counted if r["own"] == s]
        base = sum(r["base"] for r in mine)
        want = goal[s] if s >= 0 else float(loose)
        reached, cut = base, -1
        for r in mine:
            if abs(reached + r["more"] - want) > abs(reached - want):
                break
            reached, cut = reached + r["more"], r["_bin"]
        cuts.append((int(s), int(cut)))
    chosen = bins.join(F.broadcast(spark.createDataFrame(cuts, "own int, _cut int")), "own")
    copies = F.col("_base") + ((F.col("_bin") <= F.col("_cut")) & (F.col("_base") < F.col("cap"))).cast("int")
    return chosen.select(key, F.col("_source").alias("source"), F.col("_tokens").alias("tokens"), copies.alias("copies"), F.col("_p").alias("posterior")).where("copies > 0")


def share_report(mixed: DataFrame, documents: DataFrame, targets: DataFrame, source: str = "source", tokens: str = "tokens") -> DataFrame:
    """Per source: target share, the share reached by stated sources and the one expected by posteriors, documents, copies and tokens used, the cap, and whether the target can be met."""
    used = mixed.groupBy("source").agg(F.count("*").alias("n_documents"), F.sum("copies").alias("n_copies"), F.sum(F.col("copies") * F.col("tokens")).alias("n_tokens"), F.max("copies").alias("most_copies"))
    there = documents.groupBy(F.col(source).alias("source")).agg(F.sum(tokens).alias("held"))
    names = [r[0] for r in targets.where("source IS NOT NULL").select("source").distinct().orderBy("source").collect()]
    each = mixed.select(F.posexplode("posterior").alias("_i", "_p"), (F.col("copies") * F.col("tokens")).alias("_t")).groupBy("_i").agg(F.sum(F.col("_p") * F.col("_t")).alias("expected"))
    named = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("_i") + 1) if names else F.lit(None).cast("string")
    # sources are few: one row each
    joined = targets.join(used, "source", "full").join(there, "source", "left").join(each.select(named.alias("source"), "expected"), "source", "left")
    everything = Window.partitionBy()
    reached = F.coalesce("n_tokens", F.lit(0)) / F.sum("n_tokens").over(everything)
    expected = F.coalesce("expected", F.lit(0.0)) / F.sum("n_tokens").over(everything)
    possible = F.col("target_share") * F.sum("held").over(everything) <= F.col("held") * F.col("max_repeats")
    return joined.select("source", "target_share", F.round(reached, 6).alias("reached_share"), F.round(expected, 6).alias("expected_share"), "max_repeats", F.coalesce("most_copies", F.lit(0)).alias("most_copies"), F.coalesce("n_documents", F.lit(0)).alias("n_documents"), F.coalesce("n_copies", F.lit(0)).alias("n_copies"), F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), possible.alias("can_be_met"))
