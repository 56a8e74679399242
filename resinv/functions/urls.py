"""Column functions on URLs: parts, normal forms, triage, extraction from text, scoring, similarity."""

from __future__ import annotations

import difflib
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resinv.functions import fixed as X
from resinv.functions.text import c, contains_any, filled, is_blank, matches_any, total

_HTTP = r"https?://[^\s<>\"',)]+"
_WWW = r"www\.[a-zA-Z0-9][-a-zA-Z0-9.]*\.[a-zA-Z]{2,}(?:/[^\s<>\"',)]*)?"
_FTP = r"ftp://[^\s<>\"',)]+"
_BARE = r"[a-zA-Z0-9][-a-zA-Z0-9.]*\.[a-zA-Z]{2,}(?:/[^\s<>\"',)]*)?"
_RECOVERY = r"https?://[^\s<>\"')\]}]+"


def authority(url: Column | str) -> Column:
    """What stands between ``//`` and the path, lower-cased; '' without a scheme."""
    return F.lower(F.regexp_extract(F.trim(filled(url)), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def url_path(url: Column | str) -> Column:
    return F.regexp_extract(F.trim(filled(url)), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def with_scheme(url: Column | str) -> Column:
    u = F.trim(filled(url))
    return F.when(u == "", "").when(u.rlike(r"^(https?|ftp)://"), u).otherwise(F.concat(F.lit("http://"), u))


def url_components(url: Column | str, flavour: str = "dedup") -> dict[str, Column]:
    """protocol, subdomain, domain, tld, path, full_domain (and base_domain); all '' for a blank URL.

    ``dedup`` keeps ``www`` and a leading dot on the ending; ``match`` drops ``www.``, knows more compound
    endings, drops index files and gives '' for a host of one label.
    """
    match = flavour == "match"
    full = with_scheme(url)
    host = authority(full)
    path = F.lower(F.regexp_replace(url_path(full), r"/+$", ""))
    if match:
        host = F.regexp_replace(host, r"^www\.", "")
        path = F.replace(F.replace(path, F.lit("/index.html"), F.lit("")), F.lit("/index.php"), F.lit(""))
    parts = F.split(host, r"\.")
    n = F.size(parts)
    suffixes = X.COMPOUND_SUFFIXES_MATCH if match else X.COMPOUND_SUFFIXES_DEDUP
    at = lambda k: F.coalesce(F.try_element_at(parts, F.lit(-k)), F.lit(""))
    compound = (n >= 3) & at(2).isin(*suffixes)
    dot = "" if match else "."
    tld = F.when(compound, F.concat(F.lit(dot), at(2), F.lit("."), at(1))).otherwise(F.concat(F.lit(dot), at(1)))
    domain = F.when(compound, at(3)).when(n >= 2, at(2)).otherwise(host)
    head = F.when(compound, n - 3).when(n >= 2, n - 2).otherwise(0)
    sub = F.when(head > 0, F.array_join(F.slice(parts, F.lit(1), F.greatest(head, F.lit(1))), ".")).otherwise("")
    none = (full == "") | ((n < 2) if match else F.lit(False))
    blank = lambda x: F.when(none, "").otherwise(x)
    out = {
        "protocol": blank(F.lower(F.regexp_extract(full, r"^([A-Za-z]+)://", 1))),
        "subdomain": blank(sub),
        "domain": blank(domain),
        "tld": blank(tld),
        "path": blank(path),
        "full_domain": blank(host),
    }
    if match:
        out["base_domain"] = blank(F.concat(domain, F.lit("."), tld))
    return out


def normal_strict(url: Column | str) -> Column:
    u = F.lower(F.trim(filled(url)))
    for pattern, to in ((r"^https?://", ""), (r"^ftp://", ""), (r"^www\.", ""), (r"/+$", ""), (r"/index\.(html?|php|asp)$", "")):
        u = F.regexp_replace(u, pattern, to)
    return F.regexp_replace(u, r":80($|/)", "$1")


def normal_light(url: Column | str) -> Column:
    u = F.lower(F.trim(filled(url)))
    for pattern in (r"^https?://", r"^www\.", r"/+$"):
        u = F.regexp_replace(u, pattern, "")
    return u


def normal_aggressive(url: Column | str) -> Column:
    p = url_components(url)
    sub = F.when(p["subdomain"] == "www", "").otherwise(F.regexp_replace(F.regexp_replace(p["subdomain"], r"\.www$", ""), r"^www\.", ""))
    tail = F.concat(p["domain"], p["tld"], p["path"])
    return F.when(F.trim(filled(url)) == "", "").when(sub != "", F.concat(sub, F.lit("."), tail)).otherwise(tail)


def _ends(x: Column, ends: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [x.endswith(e) for e in ends])


def is_generic_domain(base: Column) -> Column:
    return _ends(base, X.GENERIC_DOMAINS)


def is_platform(host: Column) -> Column:
    return _ends(host, X.PLATFORMS)


def effective_domain(host: Column, base: Column) -> Column:
    """The whole host on platforms, else the registered domain; both as ``url_components(.., "match")`` gives them."""
    return F.when(is_platform(host), host).otherwise(base)


def is_excluded_domain(url: Column | str) -> Column:
    host = authority(url)
    host = F.regexp_replace(F.when(host == "", F.lower(filled(url))).otherwise(host), r"^www\.", "")
    return contains_any(host, X.EXCLUDED_DOMAINS)


def triage(url: Column | str) -> Column:
    u = F.lower(filled(url))
    return F.when(matches_any(u, X.BLOCKED_PATTERNS, False), "blocked").when(matches_any(u, X.REVIEW_PATTERNS, False), "review").otherwise("ok")


def exclusion_reason(url: Column | str) -> Column:
    """The first reason by which a URL is excluded, '' if none."""
    u = F.lower(filled(url))
    out = F.when((u == "") | (c(url) == "NOT_FOUND"), "")
    for pattern, reason in X.EXCLUSION_REASONS:
        out = out.when(u.rlike(pattern), reason)
    return out.otherwise("")


def recovery_reason(url: Column | str, name: Column | str) -> Column:
    """Why a recovered URL is left out, '' if it is kept."""
    u, n = F.lower(filled(url)), F.lower(filled(name))
    out = F.when(F.lit(False), "")
    for d in X.RECOVERY_EXCLUDED:
        out = out.when(u.contains(d), f"excluded_domain:{d}")
    out = out.when(u.startswith("ftp://"), "ftp_protocol")
    ours = (n != "") & F.contains(u, n)
    for d in X.REFERENCE_DATABASES:
        out = out.when(u.contains(d) & ours, "").when(u.contains(d), f"reference_db:{d}")
    for d in X.INSTITUTIONAL:
        last = F.element_at(F.split(u, d.replace(".", r"\.")), -1)
        out = out.when((u.endswith(d) | ~u.contains(d + "/")) & u.contains(d) & ~last.contains("/"), f"generic_institutional:{d}")
    return out.otherwise("")


def recovery_quality(url: Column | str, name: Column | str, long_name: Column | str) -> Column:
    u, n = F.lower(filled(url)), F.lower(filled(name))
    words = F.slice(F.filter(F.split(F.lower(filled(long_name)), r"\s+"), lambda w: F.length(w) > 4), 1, 3)
    some = F.exists(F.filter(F.split(n, ""), lambda ch: ch.rlike(r"^[\p{L}\p{N}]$")), lambda ch: F.contains(u, ch))
    return F.when((F.length(n) > 2) & F.contains(u, n), "HIGH").when(F.exists(words, lambda w: F.contains(u, w)), "HIGH").when(some, "MEDIUM").otherwise("LOW")


def unique_keep_order(urls: Column) -> Column:
    """Elements whose lower-cased form has not come before, in order."""
    lower = F.transform(urls, F.lower)
    return F.filter(urls, lambda x, i: F.array_position(lower, F.lower(x)) == i.cast("long") + 1)


def extract_urls(text: Column | str) -> Column:
    """URLs of a text in order of pattern: http(s), www, ftp, then bare domains after a telling phrase."""
    t = filled(text)
    found = [F.regexp_extract_all(t, F.lit(f"(?i)({p})"), 1) for p in (_HTTP, _WWW, _FTP)]
    found += [F.regexp_extract_all(t, F.lit(rf"(?i){phrase}\s+({_BARE})"), 1) for phrase in X.CONTEXT_PHRASES]
    cleaned = F.transform(F.flatten(F.array(*found)), lambda u: F.regexp_replace(F.regexp_replace(u, r"[.,;:)\]]+$", ""), r"^[\[\](){}]+|[\[\](){}]+$", ""))
    kept = F.filter(cleaned, lambda u: ~(u.contains("@") & ~u.startswith("http")) & (F.length(u) >= 8))
    return unique_keep_order(F.transform(kept, lambda u: F.when(u.startswith("www."), F.concat(F.lit("http://"), u)).otherwise(u)))


def url_context(text: Column | str, url: Column, window: int = 50) -> Column:
    """The text around the first mention of a URL, with ``...`` where it is cut; '' if it is not there."""
    t = filled(text)
    at = F.position(F.lower(url), F.lower(t))  # from 1, 0 if absent
    begin = F.greatest(F.lit(0), at - 1 - window)
    end = F.least(F.length(t), at - 1 + F.length(url) + window)
    core = F.trim(F.substring(t, begin + 1, end - begin))
    return F.when(at == 0, "").otherwise(F.concat(F.when(begin > 0, "...").otherwise(""), core, F.when(end < F.length(t), "...").otherwise("")))


def url_score(url: Column, context: Column, abstract: Column | str) -> Column:
    """How likely a URL is the resource's own; -1000 for excluded domains."""
    u, a = F.lower(url), F.lower(filled(abstract))
    host = F.when(authority(url) == "", u).otherwise(authority(url))
    at = F.position(u, a)
    score = (
        contains_any(F.lower(context), X.CONTEXT_PHRASES).cast("int") * 10
        + contains_any(u, X.RESOURCE_KEYWORDS).cast("int") * 8
        + contains_any(u, X.ACADEMIC_TLDS).cast("int") * 5
        + contains_any(host, X.RESOURCE_SUBDOMAINS).cast("int") * 3
        + ((at > 0) & ((at - 1) < F.length(a) / 2)).cast("int") * 2
    )
    return F.when(is_excluded_domain(url), -1000.0).otherwise(score.cast("double"))


def scored_urls(abstract: Column | str) -> Column:
    """array<struct<url, score, context>> of an abstract's URLs, in order."""

    def one(u: Column) -> Column:
        context = url_context(abstract, u)
        return F.struct(u.alias("url"), url_score(u, context, abstract).alias("score"), context.alias("context"))

    return F.transform(extract_urls(abstract), one)


def resource_url(scored: Column) -> dict[str, Column]:
    """all_urls, resource_url, has_resource_url and url_context from ``scored_urls``; the first of the best wins."""
    good = F.filter(scored, lambda s: s["score"] >= 0)
    top = F.array_max(F.transform(good, lambda s: s["score"]))
    best = F.try_element_at(F.filter(good, lambda s: s["score"] == top), F.lit(1))
    some = F.size(good) > 0
    listed = F.when(some, good).otherwise(scored)
    return {
        "all_urls": F.array_join(F.transform(listed, lambda s: s["url"]), " | "),
        "resource_url": F.when(some, best["url"]).otherwise(""),
        "has_resource_url": some,
        "url_context": F.when(some, best["context"]).otherwise(""),
    }


def extract_urls_recovery(text: Column | str) -> Column:
    """Distinct http(s) URLs of more than eight characters without trailing punctuation, sorted."""
    raw = F.regexp_extract_all(filled(text), F.lit(f"(?i)({_RECOVERY})"), 1)
    return F.array_sort(F.array_distinct(F.filter(F.transform(raw, lambda u: F.regexp_replace(u, r"[.,;:!?)\]}]+$", "")), lambda u: F.length(u) > 8)))


def filter_url_list(urls: Column | str, separator: str = "|") -> tuple[Column, Column]:
    """The kept URLs of a packed list, NOT_FOUND if none is, and the reasons of the others."""
    pieces = F.filter(F.transform(F.split(filled(urls), f"[{separator}]"), lambda x: F.trim(x)), lambda u: u != "")
    tagged = F.transform(pieces, lambda u: F.struct(u.alias("u"), exclusion_reason(u).alias("r")))
    kept = F.transform(F.filter(tagged, lambda s: s["r"] == ""), lambda s: s["u"])
    reasons = F.transform(F.filter(tagged, lambda s: s["r"] != ""), lambda s: s["r"])
    blank = is_blank(urls)
    return F.when(blank | (F.size(kept) == 0), "NOT_FOUND").otherwise(F.array_join(kept, separator)), F.when(blank, F.array().cast("array<string>")).otherwise(reasons)


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio; two empty texts are alike, null counts as ''."""
    return pd.Series([1.0 if x == y else difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)], dtype="float64")


def ratio_within_reach(a: Column, b: Column, least: float) -> Column:
    """Whether ``sequence_ratio`` of two texts can be ``least`` or more, by edit distance, without Python.

    The ratio is twice the matched letters over all letters n, and what is matched is a common subsequence, so at most
    (1 - least) * n letters are unmatched, and no more edits than that lead from one text to the other.
    """
    x, y = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    most = F.floor((F.length(x) + F.length(y)) * (1 - least) + 1e-6).cast("int")
    return (F.abs(F.length(x) - F.length(y)) <= most) & (F.levenshtein(x, y) <= most)


def reached_ratio(a: Column, b: Column, least: float) -> Column:
    """``sequence_ratio`` where it can be ``least`` or more, else 0; Python gets nulls, which cost nothing, for the rest."""
    able = ratio_within_reach(a, b, least)
    return F.when(able, sequence_ratio(F.when(able, a), F.when(able, b))).otherwise(0.0)


def url_similarity(a: dict[str, Column], b: dict[str, Column], equal: Column, domain_sim: Column, path_sim: Column, sub_sim: Column) -> Column:
    """Similarity of two URLs from their parts and the ratios of their parts."""
    same = (a["domain"] == b["domain"]) & (a["tld"] == b["tld"])
    first = F.lit(0.8) + F.when(a["path"] == b["path"], 0.2).when(path_sim > 0.8, 0.15).when(sub_sim > 0.8, 0.1).otherwise(0.0)
    second = F.lit(0.5) + F.when(a["tld"] == b["tld"], 0.2).otherwise(0.0) + F.when(path_sim > 0.8, 0.2).otherwise(0.0)
    within = F.contains(a["full_domain"], b["full_domain"]) | F.contains(b["full_domain"], a["full_domain"])
    third = F.when(within, F.lit(0.6) + path_sim * 0.3).otherwise(domain_sim * 0.4)
    none = (a["full_domain"] == "") | (b["full_domain"] == "")
    return F.when(equal, 1.0).when(none, 0.0).when(same, first).when(domain_sim > 0.85, second).otherwise(third)


#: Fixed value: a meta refresh and its target.
REFRESH = r"(?is)<meta[^>]*http-equiv=[\"']?refresh[\"']?[^>]*url=[\"']?([^\"'>\s]+)"


def meta_refresh(html: Column | str) -> Column:
    """The target of a meta refresh, '' if there is none."""
    return F.trim(F.regexp_extract(filled(html), REFRESH, 1))


def resolved(target: Column, base: Column) -> Column:
    """A target as an absolute URL, seen from the page ``base``; '' stays ''.  Dot segments stay as they are."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    bare = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.when(F.length(bare) > F.length(origin), F.regexp_replace(bare, r"[^/]*$", "")).otherwise(F.concat(origin, F.lit("/")))
    return (
        F.when((target == "") | target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(origin, target))
        .when(target.startswith("?"), F.concat(bare, target))
        .when(target.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), target))
        .otherwise(F.concat(folder, target))
    )


def page_title(html: Column | str) -> Column:
    raw = F.regexp_extract(filled(html), r"(?is)<title[^>]*>(.*?)</title>", 1)
    for entity, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        raw = F.replace(raw, F.lit(entity), F.lit(ch))
    return raw


def page_scores(content: Column | str, title: Column | str) -> dict[str, Column]:
    """base and total score of a page, title bonus and the terms found; a term counts once."""
    text, t = F.lower(F.substring(filled(content), 1, X.PAGE_CUT)), F.lower(filled(title))
    hit = {w: t.contains(w.lower()) | text.contains(w.lower()) for w in X.PAGE_TERMS}
    base = total([hit[w].cast("int") * n for w, n in X.PAGE_TERMS.items()])
    bonus = F.when(contains_any(t, X.PAGE_TITLE_WORDS), X.PAGE_TITLE_BONUS).otherwise(0)
    found = F.array_join(F.array_compact(F.array(*[F.when(hit[w], w) for w in X.PAGE_TERMS])), ", ")
    return {"base_score": base, "title_bonus": bonus, "total_score": base + bonus, "indicators_found": found}


def likelihood(score: Column) -> Column:
    return F.when(score >= 15, "CRITICAL").when(score >= 10, "HIGH").when(score >= 5, "MEDIUM").when(score >= 1, "LOW").otherwise("VERY LOW")


def snapshot_date(stamp: Column | str) -> Column:
    s = c(stamp)
    return F.when(F.length(s) >= 8, F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))).otherwise("")
