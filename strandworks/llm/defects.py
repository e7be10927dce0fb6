"""Problem 4: responses that fail to answer their prompt: empty, truncated, refusing, copying, or in another language.

Shortened responses are found by sorting all distinct responses by text (in ranges, without a global task) and comparing
neighbours' common prefixes, by how often the corpus ends where the response ends, and by spikes at a length limit.
"""

from __future__ import annotations

import json
import re

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed
from .normal import canonical, words

SUPPORT = 5  # occurrences of an ending from which its statistics count
RARE_END = 0.2  # part of an ending's occurrences at the end of a response below which it breaks off
ALL, LONGEST = 0, 5  # the group of all responses, in which those of 2^n to 2^(n+1) words, n up to 5, show what is usual
SPIKE = 4.0  # how many times the neighbouring lengths' mean a length limit must hold

# Texts that stand for no answer.
PLACEHOLDERS = frozenset("n a,na,nan,none,null,nil,todo,tbd,tba,blank,empty,no output,no answer,no response,no content,undefined,placeholder,missing,unknown,not available,not applicable,to be done,to do,fixme,xxx,string,text here,your answer here,ninguno,keine,keine antwort,aucun,aucune,sin respuesta".split(","))
LABELS = frozenset("input,instruction,prompt,question,query,request,user,q,a,answer,response,output,assistant,system,text,message".split(","))
# How a responder declines in its own name.
REFUSAL = re.compile(
    r"\bi(?:'m| am) (?:sorry|afraid|really sorry|so sorry),?(?: but| that)? i\b"
    r"|\bi(?:'m| am) (?:un(?:able|willing)|not (?:able|allowed|permitted|comfortable|willing|authorised|authorized|in a position)|afraid i)\b"
    r"|\bi (?:can(?:no|')?t|can not|won't|will not|must decline|have to decline|need to decline|refuse|decline|must refuse|shouldn't|should not)\b"
    r"|\bi (?:do not|don't) (?:feel comfortable|have (?:the ability|access|permission)|think i should|want to)\b"
    r"|\bi have to (?:refuse|decline)\b"
    r"|\bas an? (?:\w+ ){0,2}(?:ai|assistant|language model|chatbot|bot)\b"
    r"|\b(?:against|outside|beyond)(?: of)? (?:my|what i)\b"
    r"|\bnot be appropriate (?:for me|to)\b|\bnot able to (?:answer|help|assist|respond|comply)\b"
    r"|\b(?:kann|darf|will|möchte|werde) ich (?:\w+ ){0,3}nicht\b|\bich (?:kann|darf|will|werde|möchte) (?:\w+ ){0,6}nicht (?:\w+ ){0,2}(?:helfen|beantworten|antworten|bearbeiten|unterstützen|erfüllen)\b"
    r"|\bje (?:ne (?:peux|puis|suis|saurais|veux)|refuse|dois (?:refuser|décliner))\b|\bje suis (?:vraiment )?désolée?\b"
    r"|\b(?:lo siento, )?no (?:puedo|me es posible|estoy autorizad[oa]|tengo permiso)\b|\bdebo (?:negarme|rechazar)\b"
    r"|मैं .{0,60}नहीं .{0,20}(?:सकता|सकती)|(?:माफ़|माफ|क्षमा) (?:कर|कीजि)|\bmain .{0,60}nahi .{0,20}(?:sakta|sakti)\b|\b(?:maaf|kshama) kar"
)
ECHO = re.compile(r"\b(?:repeat|echo|verbatim|unchanged|copy (?:the|this)|exactly as (?:given|it is|written)|wiederhole|répète[rz]?|repite|repita)\b|दोहरा")
ASKS_REFUSAL = re.compile(r"\b(?:refus\w*|decline\w*|reject\w*|turn down|say no|ablehn\w*|absage\w*|rechaz\w*|denegar)\b")
TRANSLATES = re.compile(r"\b(?:translat\w*|übersetz\w*|traduis\w*|traduire|traduce|traducir|traduzca)\b|अनुवाद")
LANGUAGES = {"en": "english,englisch,anglais,inglés,अंग्रेज़ी", "de": "german,deutsch,deutsche,allemand,alemán", "fr": "french,französisch,français,francés", "es": "spanish,spanisch,espagnol,español", "hi": "hindi,हिंदी,हिन्दी"}
# Frequent function words that mark a language; hi in Latin script.
FREQUENT = {
    "en": "the,is,are,was,to,you,your,for,and,of,we,will,be,with,on,at,that,have,has,been,this,it,in,because,please,an,not,until,when,from,by,our,i,if,can,which,who,what,does,or,as,any,more,than",
    "de": "der,die,das,und,ist,für,mit,auf,ein,eine,wir,haben,sie,ihre,ihr,am,an,wurde,weil,nicht,bis,zu,dem,den,des,im,von,kann,ich,es,war,sind,auch,oder,wird,bei,nach",
    "fr": "le,la,les,des,et,une,un,est,pour,que,dans,sur,votre,vous,nous,avons,au,aux,jusqu,ne,pas,à,été,où,du,ce,cette,il,je,sera,était,parce,avec,par,de,en",
    "es": "el,los,las,del,que,en,y,con,para,por,está,ha,se,su,sus,una,un,porque,hasta,lo,no,es,la,de,qué,le,al",
    "hi": "hai,hain,ka,ki,ke,ko,aur,mein,me,se,nahi,ab,gaya,gayi,tha,thi,par,wo,woh,aapka,aapki,kyunki,ho,ek,kya,yeh,kar,raha,tak,liye",
}
_FREQUENT = {lang: frozenset(x.split(",")) for lang, x in FREQUENT.items()}
# Words after which no sentence ends.
OPEN_WORDS = frozenset("the,a,an,and,or,but,of,to,for,with,that,because,if,than,is,are,be,been,was,will,your,our,my,their,so,as,until,der,die,das,den,dem,und,oder,ein,eine,mit,für,dass,weil,ist,wurde,le,la,les,des,et,ou,un,une,de,du,que,pour,avec,est,sera,el,los,las,y,o,una,del,con,para,por,porque,está".split(","))
_OPENERS, _CLOSERS = "\"'([{*_“‘«<-•–—#> \t\r\n\xa0", "\"')]}*_”’»`> \t\r\n\xa0"
_DEVANAGARI = re.compile("[ऀ-ॿ]")
_DIGITS = re.compile(r"\d+(?:[\-:.]\w+)*")

RULED = T.StructType([T.StructField("defect", T.StringType()), T.StructField("words", T.StringType()), T.StructField("ended", T.BooleanType()), T.StructField("size", T.IntegerType())])


def language_of(text: str, least: int = 2) -> str | None:
    """en, de, fr, es or hi (in either script), or None where frequent words don't tell."""
    if len(_DEVANAGARI.findall(text)) >= max(3, 0.2 * sum(c.isalpha() for c in text)):
        return "hi"
    tokens = words(text).split()
    hits = sorted(((sum(t in marks for t in tokens), lang) for lang, marks in _FREQUENT.items()), reverse=True)
    return hits[0][1] if hits[0][0] >= least and hits[0][0] > hits[1][0] else None


def _expected(instruction: str, prompt: str, lang: str | None) -> str | None:
    asked = canonical(instruction)
    if TRANSLATES.search(asked):
        named = set(words(instruction).split())
        targets = [code for code, names in LANGUAGES.items() if named.intersection(names.split(","))]
        return targets[-1] if len(targets) == 1 else None
    return lang or language_of(f"{instruction} {prompt}")


def _echoes(output: str, instruction: str, prompt: str) -> bool:
    out = output.split()
    bare = out[1:] if len(out) > 1 and out[0] in LABELS else out
    bare = bare[:-1] if len(bare) > 1 and bare[-1] in LABELS and len(bare) < len(out) else bare
    whole, parts = "".join(out), "".join(bare)
    ask = "".join(instruction.split())
    given = "".join(prompt.split())
    both = {ask + given, given + ask}
    for label in ("input", "question", "q"):
        both |= {ask + label + given}
    wanted = {x for x in both if x}
    if not ECHO.search(instruction):
        wanted |= {x for x in (ask, given) if x}
    elif ask:
        wanted = {x for x in wanted | {ask} if x != given}
    return whole in wanted or parts in wanted


def rule(instruction: str | None, prompt: str | None, output: str | None, lang: str | None) -> tuple[str | None, str, bool, int]:
    """(defect by a rule of its own, masked words, whether it ends like a sentence or a structure, length)."""
    instruction, prompt = instruction or "", prompt or ""
    if output is None:
        return "empty", "", True, 0
    said, ask = words(output), words(instruction)
    if not said or (said in PLACEHOLDERS and f" {said} " not in f" {ask} "):
        return "empty", "", True, len(output)
    if _echoes(said, ask, words(prompt)):
        return "copy", said, True, len(output)
    form = canonical(output).replace("’", "'")
    if REFUSAL.search(form) and not ASKS_REFUSAL.search(canonical(instruction)):
        return "refusal", said, True, len(output)
    body = output.strip().lstrip("\"'(*` ")
    if body[:1] in "{[":
        try:
            json.loads(output.strip())
            return None, "", True, len(output)
        except (ValueError, RecursionError):
            if body.count("{") + body.count("[") > body.count("}") + body.count("]") or body.count('"') % 2:
                return "truncated", "", False, len(output)
    tail = form.rstrip(_CLOSERS)
    ended = bool(tail) and tail[-1] in ".!?।॥" and not tail.endswith("...")
    masked = words(_DIGITS.sub("0", form))
    expected = _expected(instruction, prompt, lang)
    spoken = language_of(output, 3 if expected == "en" else 2)
    defect = "language" if expected and spoken and spoken != expected else None
    return defect, masked, ended, len(output)


@F.pandas_udf(RULED)
def _ruled(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([rule(*x) for x in zip(a, b, c, d)], columns=["defect", "words", "ended", "size"]).astype({"ended": bool, "size": "int32"})


def _gram(group: int, tokens: list[str]) -> int:
    value = xxhash.xxh3_64_intdigest(" ".join(tokens).encode("utf-8", "surrogatepass"), group & 0xFFFFFFFFFFFFFFFF)
    return value - ((value >> 63) << 64)


_GRAMS = T.StructType([T.StructField("inside", T.ArrayType(T.LongType())), T.StructField("last", T.ArrayType(T.LongType())), T.StructField("open", T.BooleanType())])


@F.pandas_udf(_GRAMS)
def _grams(group: pd.Series, text: pd.Series) -> pd.DataFrame:
    """Hashes of the runs of one to three words before which and at which a text goes on, those at its end, longest first."""
    rows = []
    for g, t in zip(group, text):
        w = t.split()
        inside = {_gram(g, w[i - n : i]) for i in range(1, len(w)) for n in (1, 2, 3) if i >= n}
        last = [_gram(g, w[len(w) - n :]) for n in (3, 2, 1) if len(w) >= n]
        rows.append((sorted(inside), last, bool(w) and w[-1] in OPEN_WORDS))
    return pd.DataFrame(rows, columns=["inside", "last", "open"])


_NEXT = T.StructType([T.StructField("text", T.StringType()), T.StructField("next", T.StringType()), T.StructField("part", T.IntegerType()), T.StructField("place", T.StringType())])


def _successors(batches):
    """Each text with the one after it in its range; the range's first and last text are marked for the ranges beside it."""
    from pyspark import TaskContext

    part, held = TaskContext.get().partitionId(), None
    for batch in batches:
        texts = batch["text"].tolist()
        if not texts:
            continue
        rows = [] if held is not None else [(texts[0], None, part, "first")]
        shifted = ([held] if held is not None else []) + texts
        # of a neighbour only what can show a shortening is kept: the text itself and the words that follow
        rows += [(x, y if y.startswith(x) else None, part, "inner") for x, y in zip(shifted, shifted[1:])]
        held = texts[-1]
        yield pd.DataFrame(rows, columns=["text", "next", "part", "place"])
    if held is not None:
        yield pd.DataFrame([(held, None, part, "last")], columns=["text", "next", "part", "place"])


def shortened(texts: DataFrame) -> DataFrame:
    """(text, within_word): texts that are a proper prefix of another text, by comparing neighbours in sort order.

    texts has the column `text`. All extensions of a text follow it directly in byte order, so comparing with the next
    text suffices. Texts are made distinct first, so a hot text takes one place. Sorting is by ranges; only the first and
    last text of each range meet in one task.
    """
    ordered = texts.select("text").distinct().repartitionByRange("text").sortWithinPartitions("text")
    marked = checkpointed(ordered.mapInPandas(_successors, _NEXT))
    # one row per range and end: the number of ranges bounds this window
    borders = marked.where("place <> 'inner'").withColumn("_first", F.when(F.col("place") == "first", F.col("text")))
    following = F.first("_first", ignorenulls=True).over(Window.orderBy("part", F.when(F.col("place") == "first", 0).otherwise(1)).rowsBetween(1, Window.unboundedFollowing))
    last = borders.withColumn("next", following).where("place = 'last' AND startswith(next, text)")
    pairs = marked.where("place = 'inner' AND next IS NOT NULL").select("text", "next").unionByName(last.select("text", "next")).where("text <> next AND text <> ''")
    return pairs.select("text", F.expr("substring(next, length(text) + 1, 1)").alias("_c")).select("text", (F.col("_c") != " ").alias("within_word"))


def length_spikes(unfinished: DataFrame) -> DataFrame:
    """(size,) at which unfinished responses pile up against the lengths around: a length limit cut them."""
    counts = unfinished.groupBy("size").agg(F.count("*").alias("n"))
    around = F.explode(F.sequence(F.col("size") - 3, F.col("size") + 3))
    spread = counts.select(around.alias("at"), F.col("size").alias("from"), "n").where("at <> from").groupBy(F.col("at").alias("size")).agg((F.sum("n") / 6).alias("beside"))
    return counts.join(spread, "size", "left").where((F.col("n") >= SUPPORT) & (F.col("n") >= SPIKE * F.coalesce("beside", F.lit(0.0)))).select("size")


def defective_pairs(rows: DataFrame, key: str, instruction: str, prompt: str, output: str, lang: str, evidence: bool = False) -> DataFrame:
    """(key, defect) of each row whose response fails to answer, with one of empty, copy, refusal, truncated, language.

    With evidence also what showed it: for truncated responses the first of prefix (a neighbour goes on), limit (a spike of
    lengths), structure (open brackets or quotes), ending (the corpus goes on there), unseen (nothing ends there) and
    open_word; for the others "rule".

    A null, blank or placeholder response is empty unless the instruction names the placeholder; an echo or a refusal that
    the instruction asks for is none. A null instruction or prompt counts as blank, a null language is told from the
    prompt's words. Rows without a key are left out; a key given twice is judged twice. Texts are read whole. Other
    columns are not read.
    """
    own = rows.where(F.col(key).isNotNull())
    judged = own.select(F.col(key).alias("_key"), F.xxhash64(F.coalesce(F.lower(F.trim(F.col(instruction))), F.lit(""))).alias("group"), _ruled(F.col(instruction), F.col(prompt), F.col(output), F.col(lang)).alias("_r")).select("_key", "group", "_r.*")
    judged = checkpointed(judged)
    plain = judged.where("(defect IS NULL OR defect = 'language') AND words <> ''").withColumn("_words", F.size(F.split("words", " ")))
    # a row is judged by the responses to its instruction, or, where those are too few, by all responses
    groups = plain.groupBy("group").agg(F.count("*").alias("n_group"))
    alone = F.col("n_group") < SUPPORT
    shared = F.least(F.floor(F.log2("_words")).cast("int"), F.lit(LONGEST))
    mine, all_ = F.struct("group", F.lit(-1).alias("length"), F.lit(True).alias("asks")), F.struct(F.lit(ALL).alias("group"), shared.alias("length"), alone.alias("asks"))
    pools = F.when(alone, F.array(all_)).otherwise(F.array(mine, all_))
    pooled = plain.join(groups, "group").select("_key", "ended", "size", "words", "_words", F.explode(pools).alias("_p")).select("_key", "ended", "size", "words", "_words", "_p.*")
    grams = checkpointed(pooled.select("*", _grams("group", "words").alias("_g")).select(*pooled.columns, "_g.*"))
    # how a group's responses usually end; where that is like a sentence, only those that do show natural ends
    lengths = grams.groupBy("group", "length").agg(F.sum(F.col("ended").cast("int")).alias("_e"), F.count("*").alias("_n"))
    # a length with few responses is judged with the longer ones, which its own may have been cut from, and one of under
    # four words, which may well be whole, as no prose; at most LONGEST + 1 rows a window
    longer = Window.partitionBy("group").orderBy(F.desc("length"))
    few = F.col("_n") < SUPPORT
    n_group, n_ended = (F.when(few, F.sum(x).over(longer)).otherwise(F.col(x)) for x in ("_n", "_e"))
    part = F.when(few & F.col("length").between(0, 1), 0.0).otherwise(n_ended / n_group)
    usual = lengths.select("group", "length", part.alias("usual"), n_group.alias("n_group"))
    natural = grams.join(usual, ["group", "length"]).where(F.col("ended") | (F.col("usual") < 0.5))
    seen = grams.select(F.explode("inside").alias("gram"), F.lit(1).alias("on"), F.lit(0).alias("end")).unionByName(natural.select(F.explode("last").alias("gram"), F.lit(0).alias("on"), F.lit(1).alias("end")))
    unfinished = grams.where("NOT ended AND asks")
    asked = unfinished.select("_key", F.posexplode("last").alias("place", "gram"))
    counts = seen.groupBy("gram").agg(F.sum("on").alias("on"), F.sum("end").alias("end"))
    known = asked.join(counts, "gram").where(F.col("on") + F.col("end") >= SUPPORT)
    rates = known.groupBy("_key").agg(F.min_by(F.col("end") / (F.col("on") + F.col("end")), "place").alias("rate"))
    # responses to one instruction are neighbours, so "No" is no shortened "None" of another question
    placed = F.concat_ws(" ", F.hex("group"), "words")
    cut = shortened(grams.select(placed.alias("text")))
    spikes = length_spikes(unfinished).withColumn("at_limit", F.lit(True))
    joined = (
        unfinished.select("_key", "group", "length", "size", "_words", placed.alias("text"), "open").join(usual, ["group", "length"]).join(rates, "_key", "left")
        .join(cut, "text", "left").join(spikes, "size", "left")
    )
    prose = F.col("usual") >= 0.5
    # among answers to other questions only prose breaks off: a name may well end where a sentence goes on
    apart = F.col("length") >= 0
    rare = F.coalesce(F.col("rate") < RARE_END, F.lit(False)) & (prose | ~apart)
    unseen = F.col("rate").isNull() & prose & (F.col("n_group") >= SUPPORT)
    unusual = F.coalesce(F.col("rate") < 0.5, F.lit(True))  # responses don't mostly go on to end here
    extended = unusual & (F.col("within_word") | (F.col("within_word").isNotNull() & prose)) & (~apart | (prose & (F.col("_words") >= 3)))
    at_limit = unusual & F.col("at_limit").isNotNull() & prose
    shown = F.when(F.coalesce(extended, F.lit(False)), "prefix").when(at_limit, "limit").when(rare, "ending").when(unseen, "unseen").when(F.col("open"), "open_word")
    truncated = joined.select("_key", shown.alias("_t")).where("_t IS NOT NULL")
    found = judged.join(truncated, "_key", "left").select(F.col("_key").alias(key), F.when(F.col("_t").isNotNull(), "truncated").otherwise(F.col("defect")).alias("defect"), F.coalesce("_t", F.when(F.col("defect") == "truncated", "structure").otherwise("rule")).alias("evidence"))
    found = found.where("defect IS NOT NULL")
    return found if evidence else found.drop("evidence")
