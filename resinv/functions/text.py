"""Column functions on text: blanks, markup, keyword and pattern scores, titles."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from resinv.functions import fixed as X


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def total(columns: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def is_blank(x: Column | str) -> Column:
    """Null, empty, or one of the placeholders that mean nothing."""
    return c(x).isNull() | F.lower(F.trim(c(x))).isin(*X.BLANKS)


def filled(x: Column | str) -> Column:
    return F.coalesce(c(x), F.lit(""))


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """Whether any word is a substring; the text must be lower-cased by the caller."""
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def count_contained(text: Column, words: Iterable[str]) -> Column:
    return total([text.contains(w).cast("int") for w in words])


def matches_any(text: Column, patterns: Iterable[str], ignore_case: bool = True) -> Column:
    """Whether any pattern is found; one alternation, so the text is scanned by one compiled pattern."""
    flag = "(?i)" if ignore_case else ""
    return text.rlike(flag + "|".join(f"(?:{p})" for p in patterns))


def strip_xml(x: Column | str) -> Column:
    """A header tag between words becomes a space; other simple tags are dropped."""
    spaced = F.regexp_replace(c(x), r"([\w.?!])</?h\d>(?=\w)", "$1 ")
    return F.regexp_replace(spaced, r"<[\w/]+>", "")


def strip_newlines(x: Column | str) -> Column:
    return F.regexp_replace(c(x), r"\n", "")


def plain_fulltext(x: Column | str, limit: int = 100_000) -> Column:
    """Tags to spaces, white space collapsed, cut; null stays null."""
    return F.substring(F.trim(F.regexp_replace(F.regexp_replace(c(x), r"<[^>]+>", " "), r"\s+", " ")), 1, limit)


def add_period(x: Column | str) -> Column:
    text = filled(x)
    return F.when(text == "", "").when(text.rlike(r"[.?!]$"), text).otherwise(F.concat(text, F.lit(".")))


def title_abstract(title: Column | str, abstract: Column | str) -> Column:
    return F.concat(add_period(title), F.lit(" "), filled(abstract))


def classifier_text(title: Column | str, abstract: Column | str) -> Column:
    """Title, a blank line, abstract; the one that is there where the other is blank."""
    t, a = filled(title), filled(abstract)
    return F.when((t != "") & (a != ""), F.concat(t, F.lit("\n\n"), a)).when(t != "", t).otherwise(a)


def linguistic_score(title: Column | str, abstract: Column | str) -> dict[str, Column]:
    """The seven fields of the rule-based score; nulls count as ''.

    Two for any introduction pattern, one for any title pattern, one for a URL in the abstract, half a point
    per implementation keyword up to two, minus half a point per usage keyword up to two.
    """
    t, a = filled(title), filled(abstract)
    text = F.lower(F.concat(t, F.lit(" "), a))
    intro = matches_any(text, X.INTRODUCTION_PATTERNS)
    in_title = matches_any(F.lower(t), X.TITLE_PATTERNS)
    url = a.rlike("(?i)" + X.URL_PATTERN)
    build, usage = count_contained(text, X.IMPLEMENTATION_KEYWORDS), count_contained(text, X.USAGE_KEYWORDS)
    score = intro.cast("int") * 2 + in_title.cast("int") + url.cast("int") + F.least(build * 0.5, F.lit(2.0)) - F.least(usage * 0.5, F.lit(2.0))
    parts = F.array_compact(
        F.array(
            F.when(intro, "intro_pattern"),
            F.when(in_title, "title_pattern"),
            F.when(url, "has_url"),
            F.when(build > 0, F.concat(F.lit("impl_kw="), build.cast("string"))),
            F.when(usage > 0, F.concat(F.lit("usage_kw="), usage.cast("string"))),
        )
    )
    return {
        "ling_score": score.cast("double"),
        "ling_evidence": F.when(F.size(parts) > 0, F.array_join(parts, "; ")).otherwise("none"),
        "ling_has_intro_pattern": intro,
        "ling_has_title_pattern": in_title,
        "ling_has_url": url,
        "ling_impl_keywords": build,
        "ling_usage_keywords": usage,
    }


def score_tier(score: Column, high: float = X.HIGH_THRESHOLD, low: float = X.LOW_THRESHOLD) -> Column:
    return F.when(score >= high, "high").when(score < low, "low").otherwise("medium")


def title_modifier(title: Column | str) -> tuple[Column, Column]:
    """+1 for a title with a data word, -1 for one of a method without, else 0; and the reason."""
    t = F.lower(filled(title))
    data, method = contains_any(t, X.DATA_RESOURCE_WORDS), matches_any(t, X.METHODOLOGY_PATTERNS, False)
    value = F.when(t == "", 0).when(data, 1).when(method, -1).otherwise(0)
    reason = F.when(t == "", "no_title").when(data, "data_resource_boost").when(method, "methodology_penalty").otherwise("neutral")
    return value, reason


def truthy(x: Column) -> Column:
    return F.coalesce(F.lower(F.trim(x.cast("string"))).isin("true", "1", "yes"), F.lit(False))


def passes_profile(profile: str | dict, title: Column, ling_score: Column, setfit: Column, has_url: Column) -> Column:
    """Whether a paper passes a filter profile, a built-in one by name or any by its values; the bypass decides
    alone where it applies."""
    p = X.PROFILES[profile] if isinstance(profile, str) else profile
    url_ok = truthy(has_url) if p["require_url"] else F.lit(True)
    bypass = ling_score.isNotNull() & (ling_score + title_modifier(title)[0] >= p["bypass"])
    keyword = contains_any(F.lower(filled(title)), p["keywords"])
    sure = setfit.isNull() | (setfit >= p["setfit"])
    return F.when(bypass, url_ok).otherwise(keyword & sure & url_ok)


def title_entity(title: Column | str) -> Column:
    """The resource a title names before its first colon, without article, numbers and bracketed acronym."""
    t = filled(title)
    e = F.trim(F.substring_index(t, ":", 1))
    for article in ("The ", "A ", "An "):
        e = F.when(e.startswith(article), F.trim(F.substring(e, len(article) + 1, 100000))).otherwise(e)
    e = F.regexp_replace(e, r"(?i)\bv?\d+\.?\d*\b", "")
    e = F.regexp_replace(e, r"(?i)\bversion\s+\d+\.?\d*\b", "")
    e = F.regexp_replace(e, r"\s*\([^)]+\)\s*$", "")
    return F.when(t.contains(":"), F.trim(F.regexp_replace(e, r"\s+", " "))).otherwise("")


def has_db_keyword(title: Column | str) -> Column:
    return contains_any(F.lower(filled(title)), X.DB_KEYWORDS)


def db_keyword_score(title: Column | str) -> Column:
    t = F.lower(filled(title))
    return total([t.contains(w).cast("int") * n for w, n in X.DB_WEIGHTS.items()])


def normal_entity(x: Column | str) -> Column:
    return F.lower(F.trim(filled(x)))


def loose_entity(x: Column | str) -> Column:
    """Lower-cased, with ``_ - .`` as spaces and white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(normal_entity(x), r"[_\-.]", " "), r"\s+", " "))


def is_short_form(x: Column | str) -> Column:
    s = c(x)
    return ((s == F.upper(s)) & (s != F.lower(s))) | (F.length(s) <= 6)


def clean_id(x: Column | str) -> Column:
    """A paper id without white space and a float's ``.0``; null unless it is all digits."""
    t = F.regexp_replace(F.trim(c(x).cast("string")), r"\.0+$", "")
    return F.when(t.rlike(r"^\d+$"), t)


def paper_ids(x: Column | str) -> Column:
    """The paper ids in a text, in order: every run of seven or eight digits that is a word of its own."""
    return F.regexp_extract_all(filled(x), F.lit(r"\b\d{7,8}\b"), F.lit(0))


def flag_to_int(x: Column | str) -> Column:
    """Y/true is 1, N/false/blank 0, a whole number itself, anything else 0."""
    t = F.trim(filled(x))
    return F.when(t.isin("Y", "True", "true"), 1).when(t.isin("", "N", "False", "false"), 0).otherwise(F.coalesce(t.try_cast("int"), F.lit(0)))


def json_list(x: Column | str) -> Column:
    """A JSON array of strings without its nulls; [] for anything else."""
    parsed = F.from_json(c(x), "array<string>", {"mode": "PERMISSIVE"})
    return F.coalesce(F.when(F.trim(c(x)).startswith("["), F.array_compact(parsed)), F.array().cast("array<string>"))


def literal_list(x: Column | str) -> Column:
    """A list literal with single or double quotes as an array; null for any other text.

    Quotes are swapped to those of JSON only where the text has no double quote, so that an apostrophe inside a
    double-quoted element stays.
    """
    t = F.trim(c(x))
    swapped = F.when(t.contains('"'), t).otherwise(F.replace(t, F.lit("'"), F.lit('"')))
    return F.when(t.startswith("[") & t.endswith("]"), F.from_json(swapped, "array<string>", {"mode": "PERMISSIVE"}))


def split_list(x: Column | str, separator: str = ",") -> Column:
    """The trimmed non-blank pieces of a delimited cell; [] for null."""
    pieces = F.transform(F.split(filled(x), F.lit(f"[{separator}]")), lambda x: F.trim(x))
    return F.filter(pieces, lambda p: p != "")


def join_list(x: Column, separator: str = ", ") -> Column:
    """Non-blank elements joined."""
    return F.array_join(F.filter(x, lambda p: F.trim(p) != ""), separator)


def smart_title_case(x: Column | str) -> Column:
    """Words that are all lower case get a capital, others stay."""
    words = F.split(F.trim(c(x)), r"\s+")
    return F.array_join(F.transform(words, lambda w: F.when((w == F.lower(w)) & w.rlike(r"[a-z]"), F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 100000))).otherwise(w)), " ")
