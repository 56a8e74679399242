"""Column functions on names: cleaning, recovery from a URL, capitalisation, comparison."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resinv.functions import fixed as X
from resinv.functions.text import c, filled
from resinv.functions.urls import authority, url_path


def first_of_pipes(name: Column | str) -> Column:
    n = filled(name)
    return F.when(n.contains("|"), F.trim(F.substring_index(n, "|", 1))).otherwise(n)


def without_tags(name: Column) -> Column:
    """Without whole and broken tags and stray brackets."""
    out = name
    for pattern in (r"<[^>]+>", r"^[a-zA-Z]+>", r"</[a-zA-Z]+$", r"/[a-zA-Z]+$", r"[<>]"):
        out = F.regexp_replace(out, pattern, "")
    return F.trim(out)


@F.pandas_udf(T.StringType())
def to_ascii(names: pd.Series) -> pd.Series:
    """Special characters by their ASCII writing, the rest by compatibility decomposition."""
    table = str.maketrans(X.ASCII_WRITING)
    return names.map(lambda n: None if n is None else unicodedata.normalize("NFKD", n.translate(table)).encode("ascii", "ignore").decode("ascii").strip())


def name_from_url(url: Column | str) -> Column:
    """The resource a URL names: a mixed-case segment, one in capitals, the last telling one, or the host's first label."""
    path = F.regexp_replace(url_path(url), r"/+$", "")
    segments = F.filter(F.split(path, "/"), lambda s: (s != "") & ~s.startswith("~"))
    plain = F.transform(segments, lambda s: F.regexp_replace(F.substring_index(F.substring_index(s, "?", 1), "=", 1), r"(?i)\.(php|html|aspx|jsp|htm)$", ""))
    telling = F.filter(plain, lambda s: ~F.lower(s).isin(*X.SKIP_SEGMENTS) & (F.length(s) > 1))
    first = lambda a: F.try_element_at(a, F.lit(1))
    mixed = first(F.filter(telling, lambda s: s.rlike("[a-z]") & s.rlike("[A-Z]")))
    capital = first(F.filter(telling, lambda s: (s == F.upper(s)) & (s != F.lower(s)) & (F.length(s) >= 3)))
    last = F.try_element_at(telling, F.lit(-1))
    host = F.replace(F.regexp_extract(F.trim(filled(url)), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("www."), F.lit(""))
    label = F.split(host, r"\.")[0]
    label_ok = host.contains(".") & ~F.lower(label).isin(*X.SKIP_SEGMENTS) & (F.length(label) >= 3)
    return F.coalesce(mixed, capital, F.when(F.length(last) >= 3, last), F.when(label_ok, label), F.regexp_replace(label, r"[^a-zA-Z0-9]", ""), F.lit(""))


def in_url(name: Column, url: Column | str, least: int = 5) -> Column:
    """Whether the name, its core without a database suffix, or its first letters stand in the URL."""
    n, u = F.lower(filled(name)), F.lower(filled(url))
    core = F.regexp_replace(F.regexp_replace(n, r"[-_]?(db|base|database|server|portal|tool|hub)$", ""), r"^[-_]+|[-_]+$", "")
    start = F.substring(n, 1, least)
    by_start = (F.length(n) >= least) & start.rlike(r"^[\p{L}\p{N}]+$") & F.contains(u, start)
    return (n != "") & (u != "") & (F.contains(u, n) | ((F.length(core) >= 3) & F.contains(u, core)) | by_start)


def subdomain_of(url: Column | str) -> Column:
    """A telling first label of a host of three or more labels, else ''."""
    host = F.regexp_extract(F.trim(filled(url)), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    parts = F.split(host, r"\.")
    ok = (F.size(parts) >= 3) & ~F.lower(parts[0]).isin(*X.SKIP_SUBDOMAINS) & (F.length(parts[0]) >= 3)
    return F.when(ok, parts[0]).otherwise("")


def auto_capital(name: Column) -> Column:
    return F.when(F.trim(name).rlike(r"^[a-z]{1,6}$"), F.upper(F.trim(name))).otherwise(F.trim(name))


def sanitise(df, name: str, url: str, out: str = "best_name"):
    """The table with the cleaned name ``out``, ``<out>_original`` and ``name_modification_flags``.

    The steps run in one fixed order: pipes, tags, characters (recovering from the URL a name that no longer
    stands in it), empty names, one-letter names, short names, capitals.  A null name counts as ''.
    """
    raw = filled(name)
    d = df.withColumn("_0", raw).withColumn("_1", first_of_pipes("_0")).withColumn("_2", F.when(F.col("_1") == "", F.col("_1")).otherwise(without_tags(F.col("_1"))))
    d = d.withColumn("_3", to_ascii("_2")).withColumn("_u", name_from_url(url))
    sanitised = F.col("_3") != F.col("_2")
    recovered = sanitised & ~in_url(F.col("_3"), url, 4) & (F.length("_u") >= 3)
    d = d.withColumn("_4", F.when(recovered, F.col("_u")).otherwise(F.col("_3")))
    empty = F.trim("_4") == ""
    d = d.withColumn("_5", F.when(empty, F.when(F.col("_u") != "", F.col("_u")).otherwise("[No Name Extracted]")).otherwise(F.col("_4")))
    single = F.length(F.trim("_5")) == 1
    replaced = single & (F.length("_u") > 1)
    d = d.withColumn("_6", F.when(replaced, F.col("_u")).otherwise(F.col("_5")))
    short = (F.length(F.trim("_6")) < 3) & ~single
    d = d.withColumn("_7", auto_capital(F.col("_6")))
    flags = F.array_compact(
        F.array(
            F.when(F.col("_0").contains("|"), "PIPE_CLEANED"),
            F.when(F.col("_2") != F.col("_1"), "HTML_REMOVED"),
            F.when(sanitised, "CHARS_SANITIZED"),
            F.when(recovered, "NAME_RECOVERED_FROM_URL"),
            F.when(empty, "POPULATED_FROM_URL"),
            F.when(replaced, "SHORT_NAME_REPLACED"),
            F.when(single & ~replaced, "SHORT_NAME_NO_URL"),
            F.when(short, "SHORT_NAME_FLAGGED"),
            F.when(F.trim("_6").rlike(r"^[a-z]{1,6}$"), "CAPITALIZED"),
        )
    )
    d = d.withColumn("_f", F.array_join(flags, ","))
    keep = [x for x in df.columns if x not in (out, f"{out}_original", "name_modification_flags")]
    return d.select(*keep, F.col("_7").alias(out), F.col("_0").alias(f"{out}_original"), F.col("_f").alias("name_modification_flags"))


def digits_only_differ(a: Column, b: Column) -> Column:
    x, y = F.regexp_replace(F.lower(a), r"\d+", ""), F.regexp_replace(F.lower(b), r"\d+", "")
    return (F.lower(a) != F.lower(b)) & (x == y) & (F.length(x) >= 2)


def database_suffix_differs(a: Column, b: Column) -> Column:
    x, y = F.lower(a), F.lower(b)
    cut = lambda v, s: F.when(v.endswith(s), F.substring(v, F.lit(1), F.length(v) - len(s))).otherwise(v)
    same = [(cut(x, s) == cut(y, s)) & (F.length(cut(x, s)) >= 2) for s in ("db", "database", "base")]
    return same[0] | same[1] | same[2]


def is_initials(short: Column, long: Column) -> Column:
    words = F.regexp_extract_all(c(long), F.lit(r"\b([A-Za-z]\w*)"), 1)
    initials = F.lower(F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), ""))
    capitals = F.regexp_replace(long, r"[^A-Z]", "")
    return (F.length(short) >= 2) & (F.size(words) >= 2) & ((F.lower(short) == initials) | ((F.upper(short) == capitals) & (F.length(capitals) >= 2)))


def containment(shorter: Column, longer: Column) -> Column:
    """How strongly one name stands in another: as a token, a large part, its initials, or loosely."""
    s, t = F.lower(shorter), F.lower(longer)
    token = F.array_contains(F.regexp_extract_all(t, F.lit(r"\b(\w+)\b"), 1), s)
    return (
        F.when((F.length(s) < 3) | (F.length(t) < 3) | ~F.contains(t, s), 0.0)
        .when(token, 0.8)
        .when(F.length(s) / F.length(t) >= 0.6, 0.6)
        .when(is_initials(shorter, longer), 0.7)
        .otherwise(0.3)
    )


def disambiguate(df: DataFrame, name: str, flags: str, subdomain: str) -> DataFrame:
    """Names that several rows have get their sub-domain behind them, where it says something else, and a flag."""
    sizes = df.groupBy(name).agg(F.count("*").alias("_c"))
    d = df.join(sizes, name)
    take = (F.col("_c") > 1) & (F.col(subdomain) != "") & (F.lower(subdomain) != F.lower(name))
    flag = F.when(filled(flags) != "", F.concat(F.col(flags), F.lit(",DISAMBIGUATED"))).otherwise("DISAMBIGUATED")
    return d.withColumns({name: F.when(take, F.concat(name, F.lit(" ("), subdomain, F.lit(")"))).otherwise(F.col(name)), flags: F.when(take, flag).otherwise(filled(flags))}).drop("_c")
