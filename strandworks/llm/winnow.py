"""Problem 2: records of evaluation splits that stand, exactly or nearly, in the training split.

Texts are reduced to winnowing fingerprints: the minima of rolling hashes over sliding windows, so that any common run of
WINDOW + GRAM - 1 characters gives a common fingerprint. Selected hashes are joined across splits, within records that
state the same facts; the common seeds of a pair are chained along diagonals, extended by alignment, and give the coverage.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed
from .normal import per_distinct, words

GRAM, WINDOW = 8, 6  # characters per rolling hash, hashes per window
COVERAGE = 0.7  # least covered part of the less covered text
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = T.ArrayType(T.StructType([T.StructField("fp", T.LongType()), T.StructField("pos", T.IntegerType())]))


def fingerprints(text: str, gram: int = GRAM, window: int = WINDOW) -> list[tuple[int, int]]:
    """(hash, position) of the selected grams, each hash at its first position.

    A text shorter than a gram is one gram; a text shorter than a window gives its least gram; an empty text none.
    """
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    if not len(codes):
        return []
    gram = min(gram, len(codes))
    with np.errstate(over="ignore"):
        powers = np.power(_BASE, np.arange(gram, dtype=np.uint64))
        rolled = (np.lib.stride_tricks.sliding_window_view(codes, gram) * powers).sum(axis=1, dtype=np.uint64)
        rolled = (rolled ^ (rolled >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        rolled ^= rolled >> np.uint64(29)
    window = min(window, len(rolled))
    least = np.lib.stride_tricks.sliding_window_view(rolled, window).argmin(axis=1) + np.arange(len(rolled) - window + 1)
    chosen, first = np.unique(least), {}
    for hash_, at in zip(rolled[chosen].view(np.int64).tolist(), chosen.tolist()):
        first.setdefault(hash_, at)
    return list(first.items())


def facts_key(text: str | None) -> int:
    """Hash of a JSON text's facts: order of members and elements, spacing, letter case and null members don't matter.

    Text that isn't JSON is compared by its words; null is its own fact.
    """

    def canon(value):
        if isinstance(value, dict):
            return "{" + ",".join(sorted(f"{k.casefold()}:{canon(x)}" for k, x in value.items() if x is not None)) + "}"
        if isinstance(value, list):
            return "[" + ",".join(sorted(map(canon, value))) + "]"
        if isinstance(value, str):
            return json.dumps(" ".join(unicodedata.normalize("NFKC", value).casefold().split()))
        return json.dumps(value)

    if text is None:
        form = "\x00"
    else:
        try:
            form = canon(json.loads(text))
        except (ValueError, RecursionError):
            form = "\x01" + words(text)
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(form.encode("utf-8", "surrogatepass")))))


def _extend(a: str, b: str, i: int, j: int, step: int, drop: int = 6) -> tuple[int, int]:
    """How far (i, j) reach in one direction by matching, with skips of up to three characters, before the score falls by drop."""
    score = best = 0
    reach = (i, j)
    while 0 <= i < len(a) and 0 <= j < len(b):
        if a[i] == b[j]:
            i, j, score = i + step, j + step, score + 1
            if score > best:
                best, reach = score, (i, j)
            continue
        score -= 2
        if best - score > drop:
            break
        for skip in (1, 2, 3):
            ahead_a, ahead_b = i + step * skip, j + step * skip
            if 0 <= ahead_a < len(a) and 0 <= ahead_b < len(b) and a[ahead_a] == b[ahead_b]:
                i, j = ahead_a, ahead_b
                break
            if 0 <= ahead_a < len(a) and a[ahead_a] == b[j] and a[min(max(ahead_a + step, 0), len(a) - 1)] == b[min(max(j + step, 0), len(b) - 1)]:
                i = ahead_a
                break
            if 0 <= ahead_b < len(b) and a[i] == b[ahead_b] and a[min(max(i + step, 0), len(a) - 1)] == b[min(max(ahead_b + step, 0), len(b) - 1)]:
                j = ahead_b
                break
        else:
            break
    return reach


def _union(spans: list[tuple[int, int]]) -> int:
    total, end = 0, -1
    for lo, hi in sorted(spans):
        total += max(0, hi - max(lo, end))
        end = max(end, hi)
    return total


def coverage(a: str, b: str, seeds: list[tuple[int, int]], gram: int = GRAM, gap: int = 60, band: int = 12) -> tuple[float, float]:
    """Covered part of a and of b: seeds chained along diagonals, extended at both ends of each chain.

    A chain takes the next seed if both texts move forward by at most gap characters and drift apart by at most band; what
    lies between chained seeds counts as covered. Several chains may cover a pair, so moved sentences count.
    """
    chains: list[list[tuple[int, int]]] = []
    for i, j in sorted(seeds):
        for chain in reversed(chains):
            p, q = chain[-1]
            if 0 < i - p <= gap + gram and 0 < j - q <= gap + gram and abs((i - p) - (j - q)) <= band:
                chain.append((i, j))
                break
        else:
            chains.append([(i, j)])
    over_a, over_b = [], []
    for chain in chains:
        (i, j), (p, q) = chain[0], chain[-1]
        left = _extend(a, b, i - 1, j - 1, -1)
        right = _extend(a, b, p + gram, q + gram, 1) if p + gram <= len(a) and q + gram <= len(b) else (len(a), len(b))
        over_a.append((left[0] + 1, right[0]))
        over_b.append((left[1] + 1, right[1]))
    return _union(over_a) / max(1, len(a)), _union(over_b) / max(1, len(b))


@F.pandas_udf(T.StringType())
def _words(texts: pd.Series) -> pd.Series:
    return per_distinct(texts, words)


@F.pandas_udf(T.LongType())
def _facts(texts: pd.Series) -> pd.Series:
    return pd.Series([facts_key(x) for x in texts], dtype="int64")


@F.pandas_udf(_SEEDS)
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([[{"fp": h, "pos": p} for h, p in fingerprints(x)] for x in texts])


@F.pandas_udf(T.StructType([T.StructField("a", T.DoubleType()), T.StructField("b", T.DoubleType())]))
def _coverage(a: pd.Series, b: pd.Series, seeds: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([coverage(x, y, [(s["pa"], s["pb"]) for s in z]) for x, y, z in zip(a, b, seeds)], columns=["a", "b"])


def split_classes(records: DataFrame, key: str, split: str, text: str, facts: str, train: str = "train") -> tuple[DataFrame, DataFrame]:
    """(members, classes): records with the class of equal words and facts, and one row per class.

    members: id, is_train, class. classes: class (its smallest id), facts, words, with_train, with_eval.
    """
    own = records.where(F.col(key).isNotNull() & F.col(text).isNotNull() & F.col(split).isNotNull())
    formed = own.select(F.col(key).alias("id"), (F.col(split) == train).alias("is_train"), _words(F.col(text)).alias("words"), _facts(F.col(facts)).alias("facts")).where("words <> ''")
    formed = checkpointed(formed.withColumn("h", F.xxhash64("words")).withColumn("h2", F.hash("words")))
    by = ["facts", "h", "h2"]
    grouped = formed.groupBy(*by).agg(F.min("id").alias("class"), F.max("is_train").alias("with_train"), F.max(~F.col("is_train")).alias("with_eval"))
    members = formed.select("id", "is_train", *by).join(grouped.select(*by, "class"), by).select("id", "is_train", "class")
    classes = grouped.select("class", "facts", "with_train", "with_eval").join(formed.select(F.col("id").alias("class"), "words"), "class")
    return members, classes


def class_overlaps(classes: DataFrame, least: float = COVERAGE) -> DataFrame:
    """(class_a, class_b, coverage): classes with training records and classes with evaluation records that are the same or nearly so."""
    # only facts that stand in classes of both sides, and in more than one class, can overlap: nothing else is cut
    sides = classes.groupBy("facts").agg(F.max("with_train").alias("_t"), F.max("with_eval").alias("_e"), F.count("*").alias("_n")).where("_t AND _e AND _n > 1")
    shared = checkpointed(classes.join(sides.select("facts"), "facts", "left_semi").select("class", "facts", "with_train", "with_eval", "words"))
    cut = shared.withColumn("s", F.explode(_fingerprints("words"))).select("class", "facts", "with_train", "with_eval", "s.fp", "s.pos")
    a = cut.where("with_train").select("facts", "fp", F.col("class").alias("class_a"), F.col("pos").alias("pa"))
    b = cut.where("with_eval").select("facts", "fp", F.col("class").alias("class_b"), F.col("pos").alias("pb"))
    seeds = a.join(b, ["facts", "fp"]).where("class_a <> class_b").groupBy("class_a", "class_b").agg(F.collect_list(F.struct("pa", "pb")).alias("seeds"))
    texts = shared.select("class", "words")
    both = seeds.join(texts.select(F.col("class").alias("class_a"), F.col("words").alias("wa")), "class_a").join(texts.select(F.col("class").alias("class_b"), F.col("words").alias("wb")), "class_b")
    near = both.withColumn("c", _coverage("wa", "wb", "seeds")).select("class_a", "class_b", F.least("c.a", "c.b").alias("coverage")).where(F.col("coverage") >= least)
    same = classes.where("with_train AND with_eval").select(F.col("class").alias("class_a"), F.col("class").alias("class_b"), F.lit(1.0).alias("coverage"))
    return same.unionByName(near)


def cross_split_overlaps(records: DataFrame, key: str, split: str, text: str, facts: str, train: str = "train", least: float = COVERAGE) -> DataFrame:
    """(train_id, eval_id, coverage) of every training record and evaluation record that are the same or nearly so.

    Both state the same facts (see facts_key), and the chained, extended seeds cover at least `least` of either text's
    words. Equal texts are compared as one class, so copies, however many, never meet as pairs before the result, which
    has every pair of members. Records without key, split or words overlap with nothing; null facts equal null facts.
    Long texts are read whole. Other columns are not read.
    """
    members, classes = split_classes(records, key, split, text, facts, train)
    overlaps = class_overlaps(classes, least)
    trained = members.where("is_train").select(F.col("id").alias("train_id"), F.col("class").alias("class_a"))
    evaluated = members.where("NOT is_train").select(F.col("id").alias("eval_id"), F.col("class").alias("class_b"))
    return overlaps.join(trained, "class_a").join(evaluated, "class_b").select("train_id", "eval_id", "coverage")
