"""Per-document text quality statistics, and the documents that are not natural prose.

Two passes over the corpus.  The first counts, per language, in how many distinct texts each word and each pair
of neighbouring words occurs and keeps the *common* ones - those in at least a given share of the language's
texts, so their number is bounded by the mean length of a document over that share.  The second computes
the statistics of every document: counts, ratios and, for each way in which text is not prose, the share of
its non-blank characters written in that way.  Each statistic is summarised per language in a mergeable KLL
quantile sketch; values become percentiles and robust z-scores.  A document is flagged by its own share alone,
not by its place in the language, since a language may be junk for the most part.
"""

from __future__ import annotations

import re
import string
import sys
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resinv.operators.lineage import cut

_WORD = re.compile(r"[^\W_]+")
_MARK = re.compile(r"^\s*(?:[-+*•–—·‣◦>»]+\s+|\(?\d{1,3}[.):]\)?\s+|\[\d{1,4}\]\s*|\(?[a-zA-Z][.)]\s+|[^\W\d_]{2,12}:\s+\S)")
_LABEL = re.compile(r"^\s*(?:[\w-]+\s){0,3}[\w-]+\s*(?::|=|\.{3,}|\t)\s*\S")
_CLOSERS = "\"”’»)]"
_INNER_END = re.compile(r"(?<!\.\.)[.!?][\"”’»)\]]*\s+[^\W\da-z_]")
_TEASER = re.compile(r"\.{3,}|…|>>|»|\[[^\W\d_]{2,10}\]")
_GAP = re.compile(r"\S\s{3,}\S")
_DELIMITERS = "|\t;,"

#: Statistics of which only large values are unusual, as shares of a document's non-blank characters.
SHARES = ("alien_words", "alien_order", "codes", "list_items", "table_rows", "label_rows", "fragments", "repeats")
#: Distinct texts a language needs before words and their order can be held against its texts.
LEARNT = 10
STATISTICS = ("words", "mean_word", "symbol_ratio", "digit_ratio", "ended_lines", "common_words", *SHARES, "not_prose")


@lru_cache(1 << 17)
def shape(word: str) -> str:
    """The word with its digits made alike: numbers and codes are each one word to the counts."""
    return "#" if word.isdigit() else "g#" if any(c.isdigit() for c in word) else word


def _shapes(text: str) -> list[str]:
    return [shape(w) for w in _WORD.findall(text.lower())]


def _ended(text: str) -> bool:
    """Whether a text ends with a sentence: a mark, perhaps closing quotes or brackets, but no dots cut short."""
    t = text.rstrip().rstrip(_CLOSERS)
    return t[-1:] in (".", "!", "?") and not t[:-1].endswith("..")


def _solid(text: str) -> int:
    return len("".join(text.split()))


_DIGITS, _UPPER, _LOWER = string.digits.encode(), string.ascii_uppercase.encode(), string.ascii_lowercase.encode()
_OTHER = re.compile(r"[^\x00-\x7f]")


def _kinds(text: str) -> tuple[int, int, int, int]:
    """How many characters of a text are digits, upper-case letters, letters, and letters or digits."""
    plain = text.encode("ascii", "ignore")
    n = len(plain)
    digits, upper = n - len(plain.translate(None, _DIGITS)), n - len(plain.translate(None, _UPPER))
    letters = upper + n - len(plain.translate(None, _LOWER))
    both = letters + digits
    if n < len(text):
        for c in _OTHER.findall(text):
            digits += c.isdigit()
            upper += c.isupper()
            letters += c.isalpha()
            both += c.isalnum()
    return digits, upper, letters, both


def units(text: str) -> list[tuple[str, str]]:
    """The text in units of layout: (unit, structure); wrapped lines are joined, structure '' is running text."""
    lines = [x for x in re.split(r"[\r\n\x0b\x0c  ]+", text) if x.strip()]
    cut: list[bool] = []
    pieces: list[str] = []
    for x in lines:  # teasers: beginnings of sentences strung together
        n = len(_TEASER.findall(x)) if "..." in x or "…" in x or ">>" in x or "»" in x or "[" in x else 0
        teased = n >= 3 and "\t" not in x and len(x.split()) < 9 * n
        for p in _TEASER.split(x) if teased else [x]:
            if p.strip():
                pieces.append(p)
                cut.append(teased)
    lines = pieces
    _, capitals, letters, _ = _kinds(text)
    upper = capitals > 0.6 * max(1, letters)
    width = max((len(x.rstrip()) for x in lines), default=0)
    counts = [[x.count(c) for c in _DELIMITERS] for x in lines]
    labels = sum(bool(_LABEL.match(x)) and not _ended(x) for x in lines) >= 3
    full = lambda a, b: len(a.rstrip()) + 1 + len(b.split(maxsplit=1)[0]) > width and len(a.split()) >= 3
    open_ends = [full(a, b) for a, b in zip(lines, lines[1:]) if not _ended(a)]
    wraps = 20 <= width <= 130 and sum(open_ends) >= 0.7 * len(open_ends)
    out: list[list[str]] = []
    before = None
    for i, line in enumerate(lines):
        s = line.strip()
        ended = _ended(s)
        near = [k for k in range(max(0, i - 2), min(len(lines), i + 3)) if k != i]
        table = not ended and any(c >= 2 and sum(counts[k][j] == c for k in near) >= 2 for j, c in enumerate(counts[i]))
        if table or _GAP.search(line):
            structure = "table_rows"
        elif _MARK.match(line):
            structure = "list_items"
        elif labels and _LABEL.match(line):
            structure = "label_rows"
        else:
            structure = "fragments" if cut[i] else ""
        wrapped = before is not None and wraps and full(before, line)
        follows = s[0].islower() or (upper and before is not None and before == before.upper()) or s[0].isdigit() or s[0] in '("'
        if out and not structure and not _ended(out[-1][0]) and ((out[-1][1] == "" and (follows or wrapped)) or (out[-1][1] == "list_items" and wrapped)):
            out[-1][0] += " " + s
        else:
            out.append([s, structure])
        before = line.rstrip()
    return [(a, b) for a, b in out]


def judge(unit: str, structure: str, words: set[str] | None, pairs: set[tuple[str, str]] | None) -> str:
    """In which of the SHARES ways the unit is not prose; '' if it is.  Without words (None) only its form counts."""
    w = _shapes(unit)
    plain = [x for x in w if x not in ("#", "g#")]
    if not w or (words is not None and sum(map(words.__contains__, plain)) < 0.6 * len(plain)):
        return "alien_words"
    if words is not None and len(w) >= 4 and sum(map(pairs.__contains__, zip(w, w[1:]))) < 0.45 * (len(w) - 1):
        return "alien_order"
    coded = len(w) - len(plain)
    if coded > 0.5 * len(w) and (len(w) - coded < 5 or coded > 0.85 * len(w)):
        return "codes"
    ended = _ended(unit)
    if structure and not (ended and len(w) >= 8) and not (len(w) >= 15 and _INNER_END.search(unit)):
        return structure
    if not ended and len(w) < 15 and (len(w) < 6 or not unit[0].islower()) and not _INNER_END.search(unit):
        return "fragments"
    return ""


def statistics(text: str | None, words: set[str] | None, pairs: set[tuple[str, str]] | None, run: int = 8) -> dict[str, float]:
    """All STATISTICS of one text; those of an empty or null text are 0."""
    text = text or ""
    low = _WORD.findall(text.lower())
    solid = _solid(text)
    lines = [x for x in text.splitlines() if x.strip()]
    out = dict.fromkeys(STATISTICS, 0.0)
    if not solid:
        return out
    shares: Counter[str] = Counter()
    total = 0
    for unit, structure in units(text):
        n = _solid(unit)
        total += n
        shares[judge(unit, structure, words, pairs)] += n
    run = min(run, max(5, len(low) // 20))  # short texts repeat shorter runs
    runs = Counter(tuple(low[i : i + run]) for i in range(len(low) - run + 1))
    repeats = sum(c for c in runs.values() if c > 1) / max(1, sum(runs.values()))
    out.update({k: shares[k] / max(1, total) for k in SHARES})
    out["repeats"] = repeats
    out["not_prose"] = max(1 - shares[""] / max(1, total), repeats)
    out["words"] = float(len(low))
    out["mean_word"] = sum(map(len, low)) / max(1, len(low))
    digits, _, _, both = _kinds(text)
    out["symbol_ratio"] = (solid - both) / solid
    out["digit_ratio"] = digits / solid
    out["ended_lines"] = sum(_ended(x) for x in lines) / max(1, len(lines))
    out["common_words"] = sum(map(words.__contains__, map(shape, low))) / max(1, len(low)) if words is not None else 0.0
    return out


def _common(docs: DataFrame, sizes: dict[str, int], word_share: float, pair_share: float, limit: int) -> dict[str, tuple[set[str], set[tuple[str, str]]]]:
    """By language, the words and the pairs in at least a share of its distinct texts (three at least).

    ``docs`` holds (lang, t), t the words of a distinct text; words and pairs are counted in one pass.  A language
    with too few texts for its shares to say more than that floor, and texts without a language, get the terms
    of all languages.
    """
    pairs = F.zip_with(F.slice("t", F.lit(1), F.size("t") - 1), F.slice("t", F.lit(2), F.size("t") - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    terms = F.when(F.size("t") > 1, F.concat(F.array_distinct("t"), F.array_distinct(pairs))).otherwise(F.col("t"))
    counted = docs.select("lang", F.explode(terms).alias("term")).groupBy("lang", "term").agg(F.count("*").alias("n"))
    least = lambda share: F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(max(3.0, share * n)))])[F.col("lang")]
    enough = F.when(F.col("term").contains(" "), F.col("n") >= least(pair_share)).otherwise(F.col("n") >= least(word_share))
    common = cut(counted.filter(enough).select("lang", "term"))
    n = common.count()
    if n > limit:  # cannot be while documents have fewer than limit * share / languages terms on average
        raise ValueError(f"{n} common terms: texts are too long for the shares {word_share} and {pair_share}")
    own: dict[str, set[str]] = {k: set() for k in sizes}
    for r in common.collect():
        own[r.lang].add(sys.intern(r.term))
    parted = lambda found: ({t for t in found if " " not in t}, {tuple(t.split(" ")) for t in found if " " in t})
    pool = parted(set().union(*own.values()))
    return {k: pool if k == "und" or pair_share * n < 3 else parted(own[k]) for k, n in sizes.items()}


def _at_most(column: str):
    return lambda x: x <= F.col(column)


def quality(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    word_share: float = 0.002,
    pair_share: float = 0.004,
    term_limit: int = 3_000_000,
    max_languages: int = 500,
) -> DataFrame:
    """One row per document row: id, lang, all STATISTICS, for each its percentile and robust z within the
    language, and ``prose`` (false where ``not_prose`` is over one half, however many such texts the language has).

    Documents without a language form a group of their own.  Null and empty texts have statistics of 0 and
    are prose (nothing speaks against them); in a language of fewer than LEARNT distinct texts words and their order
    are not judged, so ``alien_order`` is 0 there and ``alien_words`` the share without any word; a null id keeps its row; repeated rows stay repeated; an empty
    table gives an empty result.  Texts are read whole and all documents are counted.
    """
    docs = documents.select(F.col(id_col).alias("id"), F.coalesce(F.nullif(F.trim(F.lower(lang_col)), F.lit("")), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    shaped = F.transform(
        F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), 1),
        lambda w: F.when(w.rlike(r"^\p{Nd}+$"), "#").when(w.rlike(r"\p{Nd}"), "g#").otherwise(w),
    )
    # copies of a text count once: what is copied often teaches no words
    texts = cut(docs.select("lang", F.concat_ws(" ", shaped).alias("t")).distinct())
    per_language = texts.groupBy("lang").agg(F.count_if(F.col("t") != "").alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages + 1).collect()
    if len(per_language) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    sizes = {r.lang: r.n for r in per_language} or {"und": 0}
    known = _common(texts.filter("t <> ''").select("lang", F.split("t", " ").alias("t")), sizes, word_share, pair_share, term_limit)
    # texts without a language are in any of the languages
    learnt = {k for k, n in sizes.items() if (sum(sizes.values()) if k == "und" else n) >= LEARNT}
    context = documents.sparkSession.sparkContext
    shared = context.broadcast({k: known[k] if k in learnt else (None, None) for k in known})  # bounded: checked against term_limit

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = shared.value
        for pdf in batches:
            rows = pd.DataFrame([statistics(t, *terms[k]) for t, k in zip(pdf["text"], pdf["lang"])], columns=list(STATISTICS))
            yield pd.concat([pdf[["id", "lang"]].reset_index(drop=True), rows], axis=1)

    kind = docs.schema["id"].dataType.simpleString()
    measured = cut(docs.mapInPandas(measure, f"id {kind}, lang string, " + ", ".join(f"{s} double" for s in STATISTICS)))
    sketches = measured.groupBy("lang").agg(*[F.kll_sketch_agg_double(s).alias(s) for s in STATISTICS])
    grid = F.array(*[F.lit(i / 100) for i in range(1, 100)])
    grids = sketches.select("lang", *[F.kll_sketch_get_quantile_double(s, grid).alias(f"_q_{s}") for s in STATISTICS])
    # 99 numbers a statistic for each language: at most max_languages rows, checked above
    scored = measured.join(F.broadcast(grids), "lang")
    columns = [F.col("id").alias(id_col), "lang", *STATISTICS]
    for s in STATISTICS:
        q = F.col(f"_q_{s}")
        floor = 0.05 if s not in ("words", "mean_word") else 1.0
        spread = F.greatest((q[74] - q[24]) / 1.349, F.lit(floor))
        columns.append((F.size(F.filter(q, _at_most(s))) / 100).alias(f"{s}_percentile"))
        columns.append(((F.col(s) - q[49]) / spread).alias(f"{s}_z"))
    out = scored.select(*columns)
    return out.withColumn("prose", F.col("not_prose") <= 0.5)
