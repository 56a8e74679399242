"""Mapping free-entered values to the closest entry of a reference list.

Distinct values are normalised and read in a bounded number of ways (without a bracket, without a style word,
either side of a dash ...).  A reading that spells an entry's code scores 1; all readings retrieve candidates from
an inverted index of the list by character n-grams and are scored by the weighted cosine of the n-gram vectors.
A value is accepted when its best entry passes the threshold and leads the next entry by the margin.  The few
values left open (cut or abbreviated words share few n-grams) are scored again by a weighted cosine over aligned
words; what stays open after that is unmatched (``canon_id`` 0), unless one of its words spells the code of
exactly one entry.

Scale: values are deduplicated before anything is joined, so a value that holds a third of all rows costs
one row.  The index join is an equi-join on n-grams; per reading only the n-grams up to the point where the
rest can no longer reach the retrieval cosine are looked up (an exact prefix bound).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resinv.llm.text import fold, osa, unaccent
from resinv.operators.lineage import cut

# Words that carry no meaning of their own in the names of organisations and countries, and
# styles that free-entered values put around a name.
STOP_WORDS = "of for the and a de la in on at to".split()
STYLES = ["republic of", "rep of", "kingdom of", "federal republic of", "federal rep", "p r", "pr", "state of"]
TAILS = ["grant", "grants", "mainland", "award", "republic of", "kingdom of"]

_DOTTED = re.compile(r"^(?:[^\W\d_]\.\s*){2,}[^\W\d_]?\.?$")
_BRACKET = re.compile(r"^(.*?)\(([^()]*)\)\s*(.*)$", re.S)


def readings(value: str) -> list[str]:
    """The folded ways to read a value; the first is the whole value."""
    value = unaccent(value).strip()
    raw = [value]
    if m := _BRACKET.match(value):
        raw += [f"{m[1]} {m[3]}", m[2]]
    if " - " in value:
        raw += value.split(" - ", 1)
    out: list[str] = []
    for r in raw:
        r = r.strip()
        text = re.sub(r"[^\w]+", "", r).lower() if _DOTTED.match(r) else fold(r)
        forms = [text]
        for style in STYLES:
            if text.startswith(style + " "):
                forms.append(text[len(style) + 1 :])
        if text.startswith("the "):
            forms.append(text[4:])
        for f in list(forms):
            for tail in TAILS:
                if f.endswith(" " + tail):
                    forms.append(f[: -len(tail) - 1])
        for f in list(forms):
            head, _, last = f.rpartition(" ")
            if head and 2 <= len(last) <= 3 and last == head.replace(" ", "")[: len(last)]:
                forms.append(head)  # "Utopia UTO"
        out += [f for f in forms if f and f not in STYLES and f not in TAILS]
    return list(dict.fromkeys(out))


def grams(text: str) -> list[str]:
    """Distinct character 2- and 3-grams of the words, padded at both ends."""
    out: set[str] = set()
    for w in text.split():
        if w not in STOP_WORDS:
            p = f"^{w}$"
            out.update(p[i : i + n] for n in (2, 3) for i in range(len(p) - n + 1))
    return sorted(out)


def _alike(v: str, c: str, loose: bool = False) -> float:
    """How far the typed word v can stand for the listed word c, from 0 to 1; loose among many words."""
    if v == c:
        return 1.0
    limit = (int(0.34 * len(c) + 0.67) if loose else max(1, round(0.3 * len(c)))) if len(c) > 2 else 0
    near = 0.0
    if limit and (d := osa(v, c, limit)) <= limit:
        near = 1 - d / max(len(v), len(c))
    if v[0] == c[0] and len(v) < len(c):
        if len(v) >= 2 and c.startswith(v):
            near = max(near, 0.9)
        elif 2 <= len(v) <= 5 and _subsequence(v, c):
            near = max(near, 0.75)
        elif len(v) >= 3 and osa(v, c[: len(v)], 1) <= 1:
            near = max(near, 0.65)
        elif len(v) >= 4 and any(osa(v, c[: len(v) + k], 1) <= 1 for k in (-1, 1)):
            near = max(near, 0.65)
    elif 2 <= len(v) <= 5 and len(v) < len(c) and sorted(v[:2]) == sorted(c[:2]):
        near = max(near, 0.6 if _subsequence(v[1::-1] + v[2:], c) else 0.0)
    return near


def _stop_typo(v: str) -> bool:
    return 2 <= len(v) <= 4 and any(osa(v, s, 1) <= 1 for s in ("of", "for", "the", "and"))


def _subsequence(v: str, c: str) -> bool:
    it = iter(c)
    return all(ch in it for ch in v)


def aligned_cosine(value: str, entry: str, weight: dict[str, float], rare: float) -> float:
    """Weighted cosine of two folded names over one-to-one aligned words."""
    vs = [w for w in value.split() if w not in STOP_WORDS and not (w not in weight and _stop_typo(w))]
    cs = [w for w in entry.split() if w not in STOP_WORDS]
    if not vs or not cs:
        return 0.0
    if len(value) >= 5 and len(vs) < len(cs) + 1 and entry.startswith(value) and len(vs[-1]) < len(cs[len(vs) - 1]):
        return 0.9  # the beginning of the name, cut within a word
    loose = len(cs) >= 3
    pairs = sorted(((_alike(v, c, loose), -abs(i / len(vs) - j / len(cs)), i, j) for i, v in enumerate(vs) for j, c in enumerate(cs)), reverse=True)
    used_v: dict[int, float] = {}
    used_c: set[int] = set()
    dot = 0.0
    for s, _, i, j in pairs:
        if s < 0.5:
            break
        if i in used_v or j in used_c:
            continue
        w = weight.get(cs[j], rare)
        used_v[i] = w
        used_c.add(j)
        dot += s * w * w
    nv = sum(used_v.get(i, min(rare, weight.get(v, rare))) ** 2 for i, v in enumerate(vs))
    nc = sum(weight.get(c, rare) ** 2 for c in cs)
    return dot / math.sqrt(nv * nc)


_READINGS = T.ArrayType(T.StructType([T.StructField("reading", T.StringType()), T.StructField("grams", T.ArrayType(T.StringType()))]))


@F.pandas_udf(_READINGS)
def _read(values: pd.Series) -> pd.Series:
    return pd.Series([[{"reading": r, "grams": grams(r)} for r in readings(v)] for v in values], dtype=object)


@F.pandas_udf(T.StructType([T.StructField("entry", T.StringType()), T.StructField("grams", T.ArrayType(T.StringType()))]))
def _entry(names: pd.Series) -> pd.DataFrame:
    folded = [fold(n) for n in names]
    return pd.DataFrame({"entry": folded, "grams": [grams(f) for f in folded]})


def _decide(scored: DataFrame, threshold: float, margin: float) -> DataFrame:
    """``(list, value, eid, score)`` of the values whose best entry passes the threshold and leads by the margin."""
    w = Window.partitionBy("list", "value").orderBy(F.desc("score"), "eid")
    two = scored.withColumn("rn", F.row_number().over(w)).filter("rn <= 2")
    per = two.groupBy("list", "value").agg(F.max(F.when(F.col("rn") == 1, F.col("eid"))).alias("eid"), F.max("score").alias("score"), F.coalesce(F.max(F.when(F.col("rn") == 2, F.col("score"))), F.lit(0.0)).alias("next"))
    return per.withColumn("sure", (F.col("score") >= threshold) & (F.col("next") <= F.col("score") - margin)).drop("next")


def map_to_list(
    values: DataFrame,
    value_col: str,
    entries: DataFrame,
    entry_id: str,
    entry_name: str,
    entry_codes: list[str],
    threshold: float = 0.5,
    margin: float = 0.05,
    retrieval: float = 0.1,
    checked: tuple[float, float] = (0.55, 0.02),
    list_col: str | None = None,
) -> DataFrame:
    """``(value, canon_id, score)`` for every distinct non-blank value, canon_id 0 where no entry is meant.

    Null and blank values are dropped, nulls in the list are no entries, repeated values give one row, ties
    between entries leave the value unmatched (no margin), an empty list leaves every value unmatched, an
    empty table gives no row.  Other columns of either table are not read.  With ``list_col``, a column of both
    tables, every value is held against the entries of its own list and the column comes first in the result.
    """
    own = F.col(list_col) if list_col else F.lit("")
    codes_of = F.array(*[F.lower(F.trim(F.col(c).cast("string"))) for c in entry_codes]).cast("array<string>")
    listed = entries.select(own.alias("list"), F.col(entry_id).cast("long").alias("eid"), F.col(entry_name).alias("name"), codes_of.alias("codes")).filter("eid is not null and name is not null and list is not null")
    distinct = values.select(own.alias("list"), F.col(value_col).alias("value")).filter("value is not null and trim(value) <> '' and list is not null").distinct()
    read = cut(distinct.withColumn("r", F.explode(_read("value"))).select("list", "value", "r.reading", "r.grams"))

    listed = cut(listed.withColumn("e", _entry("name")).select("list", "eid", "codes", "e.entry", "e.grams"))
    codes = listed.select("list", "eid", F.explode("codes").alias("code")).filter("code is not null and length(code) >= 2").distinct()
    by_code = read.join(codes.withColumnRenamed("code", "reading"), ["list", "reading"]).select("list", "value", "eid", F.lit(1.0).alias("score"))

    # weighted character n-grams: the weight of one is log(1 + entries / entries that have it), by list
    totals = listed.groupBy("list").agg(F.countDistinct("eid").alias("total"))
    postings = listed.select("list", "eid", F.explode("grams").alias("gram"))
    idf = postings.groupBy("list", "gram").agg(F.countDistinct("eid").alias("df")).join(totals, "list").select("list", "gram", F.log1p(F.col("total") / F.col("df")).alias("w"))
    vectors = listed.select("list", "eid", "entry", F.explode("grams").alias("gram")).join(idf, ["list", "gram"])
    vectors = vectors.groupBy("list", "eid", "entry").agg(F.map_from_entries(F.collect_list(F.struct("gram", (F.col("w") * F.col("w")).alias("ww")))).alias("weights"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("entry_norm"))

    once = read.select("list", "reading", "grams").distinct()
    weighed = once.select("list", "reading", F.explode("grams").alias("gram")).join(idf, ["list", "gram"], "left").join(totals, "list").withColumn("w", F.coalesce("w", F.log1p("total")))
    whole = Window.partitionBy("list", "reading")
    square = F.col("w") * F.col("w")
    weighed = weighed.select("list", "reading", "gram", square.alias("ww"), F.sum(square).over(whole).alias("norm2"), F.sum(square).over(whole.orderBy(F.desc("w"), "gram")).alias("upto"))
    # n-grams behind the point where the rest of the vector cannot reach the retrieval cosine find no new entry
    prefix = weighed.filter(F.col("norm2") - F.col("upto") + F.col("ww") >= F.lit(retrieval**2) * F.col("norm2"))
    candidates = prefix.join(postings, ["list", "gram"]).groupBy("list", "reading", "eid").agg(F.first("norm2").alias("norm2"))
    shared = F.array_intersect("grams", F.map_keys("weights"))
    dot = F.aggregate(shared, F.lit(0.0), lambda acc, g: acc + F.element_at("weights", g))
    paired = candidates.join(once, ["list", "reading"]).join(vectors, ["list", "eid"])
    cosines = paired.select("list", "reading", "eid", "entry", (dot / F.sqrt("norm2") / F.col("entry_norm")).alias("score")).filter(F.col("score") >= retrieval)
    scored = cut(cosines.join(read.select("list", "value", "reading"), ["list", "reading"]).select("list", "value", "reading", "eid", "entry", "score"))
    best = scored.select("list", "value", "eid", "score").unionByName(by_code).groupBy("list", "value", "eid").agg(F.max("score").alias("score"))
    first = cut(_decide(best, threshold, margin))

    # what the cosine leaves open is scored over aligned words, in which a word may be misspelt or abbreviated
    words = listed.select("list", "eid", F.explode(F.array_distinct(F.split("entry", " "))).alias("word")).groupBy("list", "word").agg(F.countDistinct("eid").alias("df")).join(totals, "list").select("list", "word", F.log1p(F.col("total") / F.col("df")).alias("w"), F.log1p("total").alias("unseen"))
    entry_words = listed.select("list", "eid", F.explode(F.array_distinct(F.split("entry", " "))).alias("word")).join(words, ["list", "word"]).groupBy("list", "eid").agg(F.map_from_entries(F.collect_list(F.struct("word", "w"))).alias("weights"), F.max("unseen").alias("unseen"))

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            s = [aligned_cosine(r, e, dict(w), u) for r, e, w, u in zip(pdf.reading, pdf.entry, pdf.weights, pdf.unseen)]
            yield pd.DataFrame({"list": pdf["list"], "value": pdf["value"], "eid": pdf["eid"], "score": s})

    open_ = first.filter("not sure").select("list", "value")
    spread = scored.join(open_, ["list", "value"], "left_semi").select("list", "value", "reading", "eid", "entry").join(entry_words, ["list", "eid"])
    tasks = max(1, int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    aligned = cut(spread.repartition(tasks, "value", "eid")).mapInPandas(align, "list string, value string, eid long, score double")
    again = aligned.unionByName(by_code.join(open_, ["list", "value"], "left_semi")).groupBy("list", "value", "eid").agg(F.max("score").alias("score"))
    second = _decide(again, *checked)
    # last, a code among the words of a value that nothing else explains ("UK MRC")
    coded = read.select("list", "value", F.explode(F.split("reading", " ")).alias("code")).filter("length(code) >= 3").join(codes, ["list", "code"])
    coded = coded.groupBy("list", "value").agg(F.countDistinct("eid").alias("n"), F.min("eid").alias("coded")).filter("n = 1").select("list", "value", "coded")
    f = first.select("list", "value", F.when(F.col("sure"), F.col("eid")).alias("e1"), F.col("score").alias("s1"))
    g = second.select("list", "value", F.when(F.col("sure"), F.col("eid")).alias("e2"), F.col("score").alias("s2"))
    out = distinct.join(f, ["list", "value"], "left").join(g, ["list", "value"], "left").join(coded, ["list", "value"], "left")
    score = F.when(F.col("e1").isNotNull(), F.col("s1")).when(F.col("e2").isNull() & F.col("coded").isNotNull(), 1.0).otherwise(F.coalesce("s2", "s1", F.lit(0.0)))
    named = [F.col("list").alias(list_col)] if list_col else []
    return out.select(*named, "value", F.coalesce("e1", "e2", "coded", F.lit(0)).cast("long").alias("canon_id"), score.alias("score"))
