"""Problem 6: values typed by people, mapped to the entry of a reference list that they mean.

Distinct values are normalised and meet the list's forms in an inverted index of character n-grams. The weighted cosine of
all their n-grams ranks the entries; the best is accepted if its cosine reaches a threshold and leads the next entry's by
a margin, and if an exact check of the words against that entry's forms finds no word that means something else.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed
from .normal import per_distinct, without_accents, words

COSINE = 0.2  # least weighted cosine of an accepted entry
MARGIN = 0.005  # by how much the best entry's cosine must lead the next entry's
COMMON = COSINE * COSINE  # part of a value's squared weight, in its commonest n-grams, that finds no candidates by itself
INDEX_ROWS = 500_000  # rows of the index, each under a hundred bytes, up to which it is broadcast
# Words that people add to a name, and ways to write the kind of an entity.
NOISE = frozenset("the,our,my,a,an,old,new,prod,team,tv,hd,uhd,sd,4k,live,channel,get,id,for,by,of,and".split(","))
KINDS = {"service": "svc,serv,srv,services", "workflow": "wf,flow,workflows", "endpoint": "ep,api,endpt,endpoints", "rule": "rl,rules", "policy": "pol,plcy,policies", "concept": "concepts"}
_KIND = {short: kind for kind, shorts in KINDS.items() for short in [kind, *shorts.split(",")]}
NONE = "none"


@lru_cache(maxsize=400_000)
def edits(a: str, b: str, limit: int) -> int:
    """Optimal string alignment distance (transpositions count once), or limit + 1 where it is larger."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    before, above = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            least = min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                least = min(least, before[j - 2] + 1)
            row.append(least)
        if min(row) > limit:
            return limit + 1
        before, above = above, row
    return min(above[-1], limit + 1)


def allowed(token: str) -> int:
    return 0 if len(token) < 3 else 1 if len(token) < 5 else 2 if len(token) < 10 else 3


def value_form(text: str) -> str:
    """The words of a value without accents; noise and kinds stay for the check."""
    return words(without_accents(text))


def is_code(form: str) -> bool:
    """A short name without vowels to speak of, such as XKMM9: it is right or another one."""
    joined = form.replace(" ", "")
    return " " not in form and 4 <= len(joined) <= 8 and (any(c.isdigit() for c in joined) or sum(c in "aeiouy" for c in joined) <= 1)


def _content(tokens: list[str]) -> list[str]:
    return [t for t in tokens if t not in NOISE and t not in _KIND]


def _peel(joined: str, wanted: list[str]) -> tuple[str, list[str], int]:
    """(what is left of joined words, the words not found in them, edits): words are taken off either end, the likest first.

    Nothing is taken from what is no joining: a single word with less than two letters beside it. Beside a single word that
    was taken, what is left must be told from its misspelling, so it is taken with one edit at most.
    """
    rest, left, total, taken = joined, list(wanted), 0, 0
    while left:
        best = None
        for w in left:
            limit = 1 if len(w) < 6 else 2
            for length in (len(w), len(w) - 1, len(w) + 1):
                for end in (False, True):
                    part = rest[max(0, len(rest) - length) :] if end else rest[:length]
                    d = edits(part, w, limit)
                    if d <= limit and len(part) > 2 and (best is None or (d, abs(length - len(w))) < best[0]):
                        best = ((d, abs(length - len(w))), w, rest[: max(0, len(rest) - length)] if end else rest[length:])
        if best is None:
            break
        total += best[0][0]
        taken += 1
        left.remove(best[1])
        rest = best[2]
    if taken > 1 or taken == 1 and len(rest) > 1 and total <= 1:
        return rest, left, total
    return joined, wanted, 0


def _spare(token: str) -> int | None:
    """Edits that turn a token into noise or a kind, or the letters of a short one; None where it says something else."""
    near = [edits(token, n, 1) for n in NOISE if len(n) > 1 and len(token) + len(n) > 3]
    least = min([*near, *(edits(token, k, 1 if len(k) == 3 else 2) for k in _KIND if len(k) > 2), len(token)])
    return least if least <= (1 if len(token) < 5 else 2) else None


def check(value: str, form: str, known: frozenset[str]) -> int | None:
    """Number of edits that turn the value into the form, or None where it means something else.

    Words may stand in any order and be joined; noise and kinds may be left out or added. Each other word must be the
    form's word but for a few edits; a word that the list knows is no misspelling of another.
    """
    typed, wanted = value.split(), form.split()
    if "".join(typed) == "".join(wanted):
        return 0
    v, f = _content(typed), _content(wanted)
    if is_code(form):
        return 0 if "".join(v) == "".join(wanted) else None
    if not v or not f:
        return None
    total, left, rest = 0, list(f), []
    for t in v:
        near = min(((d, w) for w in left if (w == t or t not in known) and (d := edits(t, w, allowed(w))) <= allowed(w)), default=None)
        if near:
            total += near[0]
            left.remove(near[1])
        else:
            rest.append(t)
    if left and rest:  # words that were typed as one, or one that was typed in parts
        over, found = [], left
        for t in rest:
            remains, still, d = _peel(t, found) if t not in known else (t, found, 0)
            if len(still) < len(found):
                found, total = still, total + d
                over += [remains] if remains else []
            else:
                over.append(t)
        if found and len(over) > 1:
            remains, still, d = _peel("".join(over), found)
            if len(still) < len(found):
                found, over, total = still, [remains] if remains else [], total + d
        left, rest = found, over
    if left:
        return None
    for t in rest:
        spare = None if t in known else _spare(t)
        if spare is None and not (t in NOISE or t in _KIND):
            return None
        total += spare or 0
    return total


def grams(form: str) -> list[str]:
    """Character pairs and triples of each word with its ends marked, and runs of three and four letters of the words joined."""
    marked, joined = [f"^{t}$" for t in form.split()], "".join(form.split())
    inside = {w[i : i + n] for w in marked for n in (2, 3) for i in range(len(w) - n + 1)}
    return sorted(inside | {"~" + joined[i : i + n] for n in (3, 4) for i in range(len(joined) - n + 1)})


@F.pandas_udf(T.StringType())
def _forms(texts: pd.Series) -> pd.Series:
    return per_distinct(texts, value_form)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _grams(forms: pd.Series) -> pd.Series:
    return pd.Series([grams(x) for x in forms])


@F.pandas_udf(T.IntegerType())
def _check(values: pd.Series, forms: pd.Series, known: pd.Series) -> pd.Series:
    return pd.Series([check(v, f, frozenset(k if k is not None else ())) for v, f, k in zip(values, forms, known)], dtype="Int32")


def reference_forms(entries: DataFrame) -> DataFrame:
    """(list, entity, form): the distinct forms of a reference list given as (list, entity, name); null and blank names give none."""
    return entries.where("entity IS NOT NULL AND name IS NOT NULL").select("list", "entity", _forms("name").alias("form")).where("form <> ''").distinct()


def candidates(values: DataFrame, forms: DataFrame, cosine: float = COSINE, margin: float = MARGIN) -> DataFrame:
    """(list, value, entity, form, cosine) of the forms that may be a value's best or next best, with the cosine of all n-grams.

    An n-gram weighs by how few forms of its list have it, or how few values if that weighs less: what people add to any
    name tells little. Pairs meet on all n-grams of a value but its commonest ones, which hold COMMON of its squared
    weight. That loses nothing: by the inequality of Cauchy and Schwarz the others can add no more than the root of COMMON
    to a cosine, so who meets on none of the rest stays below the threshold, and only pairs that fall short of the value's
    best by more are left out before the cosine is computed in full. No list of candidates is capped.
    """
    slack = COMMON**0.5
    known = forms.withColumn("fid", F.xxhash64("list", "entity", "form"))
    asked = values.withColumn("vid", F.xxhash64("list", "value"))
    sizes = forms.groupBy("list").agg(F.count("*").alias("n_forms")).join(values.groupBy("list").agg(F.count("*").alias("n_values")), "list")
    posted = known.select("list", "fid", F.explode(_grams("form")).alias("gram"))
    typed = checkpointed(asked.select("list", "vid", F.explode(_grams("value")).alias("gram")))
    both = posted.select("list", "gram", F.lit(1).alias("f"), F.lit(0).alias("v")).unionByName(typed.select("list", "gram", F.lit(0).alias("f"), F.lit(1).alias("v")))
    spread = both.groupBy("list", "gram").agg(F.sum("f").alias("df"), F.sum("v").alias("dv")).join(sizes, "list")
    weight = F.least(F.log(1 + F.col("n_forms") / F.greatest("df", F.lit(1))), F.log(1 + F.col("n_values") / F.greatest("dv", F.lit(1))))
    weights = checkpointed(spread.select("list", "gram", weight.alias("w"), (F.col("df") > 0).alias("listed")))
    whole = Window.partitionBy("fid")
    indexed = checkpointed(posted.join(weights, ["list", "gram"]).select("list", "gram", "fid", (F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(whole))).alias("wf")))
    square, own = F.col("w") * F.col("w"), Window.partitionBy("vid")
    upto = own.orderBy("w", "gram").rowsBetween(Window.unboundedPreceding, 0)
    scaled = typed.join(weights, ["list", "gram"]).withColumn("_all", F.sum(square).over(own)).withColumn("_upto", F.sum(square).over(upto))
    scaled = checkpointed(scaled.select("list", "vid", "gram", "listed", (F.col("w") / F.sqrt("_all")).alias("wq"), (F.col("_upto") > COMMON * F.col("_all")).alias("meets")))
    # an index of few rows goes to where the values are, so that pairs need no shuffle; a larger one is joined by n-gram
    index = F.broadcast(indexed) if indexed.count() <= INDEX_ROWS else indexed
    dots = scaled.where("meets AND listed").select("list", "vid", "gram", "wq").repartition("vid").join(index, ["list", "gram"]).groupBy("vid", "fid").agg(F.sum(F.col("wq") * F.col("wf")).alias("part"))
    best = F.max("part").over(Window.partitionBy("vid"))
    near = checkpointed(dots.withColumn("_best", best).where(F.col("part") + slack >= F.greatest(F.lit(cosine), F.col("_best") - margin)).select("vid", "fid", "part"))
    common = scaled.where("listed AND NOT meets").select("list", "vid", "gram", "wq")
    rest = near.select("vid", "fid").join(common, "vid").join(index, ["list", "gram", "fid"]).groupBy("vid", "fid").agg(F.sum(F.col("wq") * F.col("wf")).alias("rest"))
    full = near.join(rest, ["vid", "fid"], "left").select("vid", "fid", (F.col("part") + F.coalesce("rest", F.lit(0.0))).alias("cosine")).where(F.col("cosine") >= cosine)
    return full.join(asked, "vid").join(known.drop("list"), "fid").select("list", "value", "entity", "form", "cosine")


def map_values(entries: DataFrame, reference: DataFrame, cosine: float = COSINE, margin: float = MARGIN) -> DataFrame:
    """(entry_id, entity_id, cosine, edits) of every entry; entity_id is "none" where the value means nothing in its list.

    entries has entry_id, list and entered; reference has list, entity and name, with a row for each way to name an entity.
    Null, blank and unmatched values, and values that fit two entities equally, are "none". Work is done once per distinct
    value. An entry id given twice is mapped twice.
    """
    own = checkpointed(entries.select("entry_id", "list", _forms("entered").alias("value")))
    values = own.where("value IS NOT NULL AND value <> ''").select("list", "value").distinct()
    forms = checkpointed(reference_forms(reference))
    vocabulary = forms.select("list", F.explode(F.split("form", " ")).alias("token")).distinct()
    tokens = values.select("list", "value", F.explode(F.split("value", " ")).alias("token"))
    known = tokens.join(vocabulary, ["list", "token"]).groupBy("list", "value").agg(F.collect_set("token").alias("known"))
    near = candidates(values, forms, cosine, margin).groupBy("list", "value", "entity").agg(F.max("cosine").alias("cosine"))
    order = Window.partitionBy("list", "value").orderBy(F.desc("cosine"), "entity")
    ranked = near.withColumn("place", F.row_number().over(order)).withColumn("next", F.lead("cosine").over(order)).where("place = 1")
    led = ranked.where(F.col("next").isNull() | (F.col("cosine") - F.col("next") >= margin)).select("list", "value", "entity", "cosine")
    checked = led.join(forms, ["list", "entity"]).join(known, ["list", "value"], "left").withColumn("edits", _check("value", "form", "known")).where("edits IS NOT NULL")
    meant = checked.groupBy("list", "value").agg(F.first("entity").alias("entity_id"), F.first("cosine").alias("cosine"), F.min("edits").alias("edits"))
    return own.join(meant, ["list", "value"], "left").select("entry_id", F.coalesce("entity_id", F.lit(NONE)).alias("entity_id"), "cosine", "edits")
