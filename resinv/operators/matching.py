"""Entity resolution between extracted and baseline names: blocked candidates, scored pairs, one-to-one matches.

Both sides are reduced to one row per name first.  Candidates come from equi-joins on block keys - name
prefixes with and without digits, effective domain, and, for names that contain one another, the shorter name
against every substring token and every prefix or suffix of the longer - never from comparing all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from resinv.functions import names as nx
from resinv.functions import urls as ux
from resinv.operators.relational import keep_first

LIKELY, MAYBE, LEAST = 2.0, 1.0, 0.5


def sides(df: DataFrame, name: str, long: str, url: str, order: str, prefix: str) -> DataFrame:
    """One row per lower-cased name: ``<p>_name, _long, _url, _low`` and the parts of the URL; blanks are left out."""
    rows = df.select(F.col(name).alias("name"), F.col(long).alias("long"), F.col(url).alias("url"), F.col(order).alias("o")).withColumn("low", F.lower(F.trim("name"))).filter("low <> ''")
    one = keep_first(rows, ["low"], ["o", "name"])
    p = ux.url_components("url", "match")
    parts = one.select("name", "long", "url", "low", p["base_domain"].alias("base"), p["full_domain"].alias("host"), p["path"].alias("path"), p["subdomain"].alias("sub"))
    out = parts.withColumn("eff", ux.effective_domain(F.col("host"), F.col("base"))).withColumn("strict", ux.normal_strict("url"))
    return out.select(*[F.col(c).alias(f"{prefix}_{c}") for c in out.columns])


def exact_matches(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.join(b, a["a_low"] == b["b_low"])


def _keys(low: Column, eff: Column) -> Column:
    """Block keys: the first two letters, the first two without digits, and the effective domain.

    Names that share three letters share two, so longer prefixes would add nothing.
    """
    bare = F.regexp_replace(low, r"\d+", "")
    prefix = lambda x: F.when(F.length(x) >= 2, F.concat(F.lit("p:"), F.substring(x, 1, 2)))
    return F.array_distinct(F.array_compact(F.array(prefix(low), prefix(bare), F.when(eff != "", F.concat(F.lit("d:"), eff)))))


def _windows(low: Column, length: Column) -> Column:
    """All substrings of a given length of a name."""
    return F.transform(F.sequence(F.lit(1), F.length(low) - length + 1), lambda i: F.substring(low, i, length))


def candidates(a: DataFrame, b: DataFrame, least: int = 4, salts: int = 8) -> DataFrame:
    """``(a_low, b_low)`` of distinct different names that share a block key or contain one another.

    A block of a common prefix or domain is spread over ``salts`` tasks: the extracted side by a hash of the
    name, the baseline side repeated.  Containment is an equi-join on the first ``least`` letters of the shorter name: every window of that many
    letters of the longer name is looked up, and the hit is verified.
    """
    ka = a.select("a_low", F.explode(_keys(F.col("a_low"), F.col("a_eff"))).alias("k"), F.pmod(F.xxhash64("a_low"), F.lit(salts)).cast("int").alias("salt"))
    kb = b.select("b_low", F.explode(_keys(F.col("b_low"), F.col("b_eff"))).alias("k")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    blocked = ka.hint("merge").join(kb, ["k", "salt"]).select("a_low", "b_low")
    n = F.lit(least)
    wa = a.filter(F.length("a_low") >= least).select("a_low", F.explode(F.array_distinct(_windows(F.col("a_low"), n))).alias("k"))
    wb = b.filter(F.length("b_low") >= least).select("b_low", F.explode(F.array_distinct(_windows(F.col("b_low"), n))).alias("k"))
    ha = a.filter(F.length("a_low") >= least).select("a_low", F.substring("a_low", 1, least).alias("k"))
    hb = b.filter(F.length("b_low") >= least).select("b_low", F.substring("b_low", 1, least).alias("k"))
    inside = wa.hint("merge").join(hb, "k").filter(F.contains(F.col("a_low"), F.col("b_low"))).select("a_low", "b_low").unionByName(ha.hint("merge").join(wb, "k").filter(F.contains(F.col("b_low"), F.col("a_low"))).select("a_low", "b_low"))
    return blocked.unionByName(inside).filter("a_low <> b_low").distinct()


def score_pairs(pairs: DataFrame, least: float | None = None) -> DataFrame:
    """The pairs with score, signals, edit_distance, confidence, is_match and review_flags.

    With ``least``, pairs whose score cannot reach it may be left out: the long names, which Python compares, add 0.8 or
    0.4 at most, and only where their edit distance lets them be so alike.
    """
    x, y = F.col("a_low"), F.col("b_low")
    same = (F.col("a_eff") != "") & (F.col("a_eff") == F.col("b_eff"))
    generic = same & ux.is_generic_domain(F.col("a_base"))
    ed = F.levenshtein(x, y)
    la, lb = F.lower(F.coalesce("a_long", F.lit(""))), F.lower(F.coalesce("b_long", F.lit("")))
    inner = F.when(F.contains(y, x), nx.containment(x, y)).when(F.contains(x, y), nx.containment(y, x)).otherwise(0.0)
    inner = F.when((F.length(x) >= 4) & (F.length(y) >= 4), inner).otherwise(0.0)
    has_urls = (F.coalesce("a_url", F.lit("")) != "") & (F.coalesce("b_url", F.lit("")) != "")
    alike = (F.col("a_strict") != "") & (F.col("a_strict") == F.col("b_strict"))
    d = pairs.withColumn("edit_distance", ed).withColumn("_in", inner).withColumn("_same", same).withColumn("_generic", generic)
    d = d.withColumn("_digits", nx.digits_only_differ(x, y)).withColumn("_suffix", nx.database_suffix_differs(x, y))
    d = d.withColumn("_url", F.when(has_urls & alike, 2.0).when(has_urls & (F.col("a_base") == F.col("b_base")) & (F.col("a_base") != ""), F.when(F.col("a_path") == F.col("b_path"), 1.0).otherwise(0.6)).otherwise(0.0))
    long_ok = (F.coalesce("a_long", F.lit("")) != "") & (F.coalesce("b_long", F.lit("")) != "")
    e = F.col("edit_distance")
    by_edit = F.when(e == 0, 3.0).when((e == 1) & (F.length(x) >= 3), 1.0).when((e == 2) & (F.length(x) >= 4), 0.6).when((e == 3) & (F.length(x) >= 5), 0.3).otherwise(0.0)
    domain = F.when(F.col("_generic"), 0.25).when(F.col("_same"), 0.75).otherwise(0.0)
    base = domain + F.when(F.col("_digits"), 1.5).otherwise(0.0) + F.when(F.col("_suffix"), 1.0).otherwise(0.0) + by_edit + F.col("_in") + F.col("_url")
    if least is not None:
        reach = F.when(~long_ok, 0.0).when(ux.ratio_within_reach(la, lb, 0.9), 0.8).when(ux.ratio_within_reach(la, lb, 0.7), 0.4).otherwise(0.0)
        d = d.filter((base >= least - 0.006) | (base + reach >= least - 0.006))  # the score is rounded to two places
    d = d.withColumn("_ls", F.when(long_ok, ux.reached_ratio(la, lb, 0.7)).otherwise(0.0))
    by_long = F.when(F.col("_ls") >= 0.9, 0.8).when(F.col("_ls") >= 0.7, 0.4).otherwise(0.0)
    score = base + by_long
    signals = F.array_compact(
        F.array(
            F.when(F.col("_generic"), "SAME_DOMAIN_GENERIC").when(F.col("_same"), "SAME_DOMAIN_SPECIFIC"),
            F.when(F.col("_digits"), "DIGIT_VERSION_DIFF"),
            F.when(F.col("_suffix"), "DB_SUFFIX_DIFF"),
            F.when(e == 0, "EXACT_NAME").when(by_edit > 0, F.concat(F.lit("EDIT_DIST_"), e.cast("string"))),
            F.when(F.col("_in") > 0, F.concat(F.lit("CONTAINS_"), F.col("_in").cast("string"))),
            F.when(F.col("_url") == 2.0, "URL_EXACT_MATCH").when(F.col("_url") > 0, "URL_SIMILAR"),
            F.when(by_long > 0, "LONG_SIMILAR"),
        )
    )
    d = d.withColumn("score", F.round(score, 2)).withColumn("signals", signals)
    strong = F.size(F.filter("signals", lambda s: ~s.startswith("SAME_DOMAIN")))
    s = F.col("score")
    d = d.withColumn("signal_count", strong).withColumn("confidence", F.when((s >= LIKELY) & (strong >= 1), "HIGH").when(s >= MAYBE, "MEDIUM").when(s >= LEAST, "LOW").otherwise("NONE"))
    d = d.withColumn("is_match", F.when(F.col("confidence") == "HIGH", "Y").when(F.col("confidence") == "MEDIUM", "MAYBE").otherwise("N"))
    flags = F.array_compact(
        F.array(
            F.when(F.col("_generic"), "GENERIC_DOMAIN"),
            F.when((e > 10) & (F.col("is_match") == "Y"), "HIGH_ED_MATCH"),
            F.when(F.col("_same") & (strong == 0), "SAME_DOMAIN_ONLY"),
            F.when((s >= 1.9) & (s < 2.1), "THRESHOLD_EDGE"),
        )
    )
    return d.withColumn("review_flags", F.array_join(flags, ",")).drop("_in", "_same", "_generic", "_digits", "_suffix", "_url", "_ls")


def best_candidates(scored: DataFrame, least: float = LEAST) -> DataFrame:
    """The best candidate of each extracted name; ties go to the smaller edit distance, then the smaller name."""
    return keep_first(scored.filter(F.col("score") >= least), ["a_low"], [F.desc("score"), "edit_distance", "b_low"])


def one_to_one(best: DataFrame) -> DataFrame:
    """Every baseline name keeps one match; the others become CONFLICT and name the winner."""
    w = Window.partitionBy("b_low").orderBy(F.desc("score"), "edit_distance", "a_low")
    sure = best.filter("is_match = 'Y'").withColumn("_rn", F.row_number().over(w)).withColumn("_winner", F.first("a_name").over(w))
    lost = F.col("_rn") > 1
    sure = sure.withColumn("is_match", F.when(lost, "CONFLICT").otherwise(F.col("is_match"))).withColumn("confidence", F.when(lost, "REJECTED").otherwise(F.col("confidence"))).withColumn("winner", F.when(lost, F.col("_winner")))
    return sure.drop("_rn", "_winner").unionByName(best.filter("is_match <> 'Y'").withColumn("winner", F.lit(None).cast("string")))


def fuzzy_match(extracted: DataFrame, baseline: DataFrame) -> DataFrame:
    """The whole operator on two tables made by ``sides``: exact names first, the rest by best candidate, one to one."""
    exact = exact_matches(extracted, baseline).withColumn("edit_distance", F.lit(0)).withColumn("score", F.lit(10.0)).withColumn("signals", F.array(F.lit("EXACT")))
    exact = exact.withColumn("signal_count", F.lit(1)).withColumn("confidence", F.lit("HIGH")).withColumn("is_match", F.lit("Y")).withColumn("review_flags", F.lit(""))
    rest = extracted.join(baseline, extracted["a_low"] == baseline["b_low"], "left_anti")
    pairs = candidates(rest, baseline).join(rest, "a_low").join(baseline, "b_low")
    best = best_candidates(score_pairs(pairs, LEAST)).select(*exact.columns)
    return one_to_one(exact.unionByName(best))
