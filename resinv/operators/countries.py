"""Countries named in running text, and the countries that codes or names mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resinv.functions import fixed as X
from resinv.functions.text import filled

FORMATS = {"full": "name", "alpha-2": "alpha2", "alpha-3": "alpha3", "id": "country_id"}


def plain(x: Column | str) -> Column:
    return F.trim(F.regexp_replace(F.lower(filled(x)), r"[^a-z0-9]+", " "))


def runs(words: Column, sizes: list[int]) -> Column:
    """All runs of the given numbers of neighbouring words."""
    none = F.array().cast("array<string>")
    of = lambda n: F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(none)
    return F.flatten(F.array(*map(of, sizes))) if sizes else none


def _sizes(terms: DataFrame) -> list[int]:
    """The numbers of words that the terms have: one row per length, at most the words of the longest name."""
    return sorted(r.n for r in terms.select(F.size(F.split("term", " ")).alias("n")).distinct().collect())


def extract_countries(df: DataFrame, key: str, text: str, countries: DataFrame, form: str = "full") -> DataFrame:
    """``(key, countries)``: the countries a text names, in the given format, sorted and joined by ``', '``.

    Names and alpha-3 codes count as whole words whatever their case, the fixed abbreviations only as written.
    The text is cut into runs of as many words as the list's names have and joined by equality, so no row is
    compared with every country.  Null and blank texts name none; an abbreviation of a country that is not in
    the list finds nothing.
    """
    out = FORMATS[form]
    listed = countries.select(F.col(out).cast("string").alias("out"), F.explode(F.array(plain("name"), F.lower("alpha3"))).alias("term")).filter("term <> ''").distinct()
    terms = df.select(F.col(key), F.explode(F.array_distinct(runs(F.split(plain(text), " "), _sizes(listed)))).alias("term"))
    found = terms.join(listed, "term").select(key, "out")
    full = F.create_map(*[F.lit(x) for pair in X.COUNTRY_ABBREVIATIONS.items() for x in pair])
    cased = df.select(F.col(key), F.explode(F.array_distinct(F.regexp_extract_all(filled(text), F.lit(r"\b(" + "|".join(X.COUNTRY_ABBREVIATIONS) + r")\b"), F.lit(1)))).alias("a"))
    cased = cased.select(key, plain(full[F.col("a")]).alias("term")).join(countries.select(plain("name").alias("term"), F.col(out).cast("string").alias("out")), "term").select(key, "out")
    per = found.unionByName(cased).groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("out")), ", ").alias("countries"))  # at most the countries of the list
    return df.select(key).join(per, key, "left").na.fill({"countries": ""})


def standard_country(df: DataFrame, key: str, code: str, countries: DataFrame, form: str = "full") -> DataFrame:
    """``(key, country)``: a code or name in the given format.

    Codes and names match as a whole; else a text that is a run of words of a name means the country whose name
    has it first, the smaller name among several; a text that means none is given as stored, a blank as ''.
    """
    out = FORMATS[form]
    c = countries.select("name", F.col(out).cast("string").alias("out"), "alpha2", "alpha3")
    whole = c.select("out", F.explode(F.array(F.upper("alpha2"), F.upper("alpha3"), F.upper("name"))).alias("_k"), "name").groupBy("_k").agg(F.min(F.struct("name", "out"))["out"].alias("_whole"))
    sizes = _sizes(c.select(plain("name").alias("term")))
    parts = c.select("name", "out", F.posexplode(runs(F.split(plain("name"), " "), sizes)).alias("pos", "_p")).filter("_p <> ''")
    parts = parts.groupBy("_p").agg(F.min(F.struct("pos", "name", "out"))["out"].alias("_part"))
    rows = df.select(F.col(key), F.col(code).alias("_stored"), F.upper(F.trim(code)).alias("_k"), plain(code).alias("_p"))
    found = rows.join(whole, "_k", "left").join(parts, "_p", "left")
    return found.select(key, F.coalesce("_whole", "_part", F.nullif(F.trim("_stored"), F.lit("")), F.lit("")).alias("country"))
