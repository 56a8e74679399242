"""Canonical rewritings of whole names, and the links between classes that spell the same rewriting.

A name is rewritten by four rules and their combinations: *nicknames* (customary short words are spelt out),
*legal forms* (``Database``, ``Portal`` ... may be left out), *token order* (the words are sorted) and *initials*
(one letter a word, with or without small words and legal form, a final ``database`` also as ``db``).  Short names,
and those in brackets behind a long one, are rewritten to themselves.

Rewritings are exploded and joined by equality.  The score of a link is the rarity of the rewriting, one over the
number of classes that spell it out: a rewriting of one class only is accepted; one of several classes, or of two
letters, is accepted for the class that shares most rows with the short name, and for none if no row speaks for any.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resinv.llm.names import KINDS, SMALL
from resinv.llm.text import fold
from resinv.operators.components import components
from resinv.operators.lineage import cut

# Customary short words of names, spelt out.
NICKNAMES = {
    "natl": "national", "nat": "national", "intl": "international", "int": "international", "univ": "university", "inst": "institute", "dept": "department", "assoc": "association",
    "soc": "society", "fdn": "foundation", "found": "foundation", "ctr": "center", "centre": "center", "cent": "center", "info": "information", "mol": "molecular", "biol": "biology",
    "sci": "science", "med": "medical", "env": "environmental", "chem": "chemical", "gen": "genome", "exp": "expression", "prot": "protein", "struct": "structure", "seq": "sequence",
    "eur": "european", "amer": "american", "us": "united states", "uk": "united kingdom", "db": "database", "kb": "knowledgebase", "lib": "library", "reg": "registry", "repo": "repository",
}
#: Fewest letters of a short name that may stand for initials, and fewest without a row that holds both names.
LEAST_INITIALS, SURE_INITIALS = 2, 3

_BRACKET = re.compile(r"^(.{3,}?)\s*[(\[]([^()\[\]]*)[)\]]\s*$")


def rewritings(name: str | None) -> list[str]:
    """Distinct rewritings of a name: ``o:`` sorted words, ``i:`` initials, ``s:`` the short name itself, ``b:`` a
    short name in brackets behind its long one.  None for null and blank names."""
    if name is None or not name.strip():
        return []
    out: list[str] = []
    long, short = name, None
    if m := _BRACKET.match(name.strip()):
        long, short = m[1], m[2]
    words = [x for w in fold(long).split() for x in NICKNAMES.get(w, w).split()]
    content = [w for w in words if w not in SMALL] or words
    core = [w for w in content if w not in KINDS]
    if len(words) == 1:
        flat = "".join(fold(long).split())
        if len(flat) >= LEAST_INITIALS:
            out.append(f"s:{flat}")
    else:
        if len(core) >= 2:
            out.append("o:" + " ".join(sorted(core)))
        for part in (words, content, core):
            initials = "".join(w[0] for w in part)
            if len(initials) >= LEAST_INITIALS:
                out.append(f"i:{initials}")
            for kind, letters in (("database", "db"), ("knowledgebase", "kb")):
                if part[-1:] == [kind] and len(initials) >= 2:
                    out.append(f"i:{initials[:-1]}{letters}")
    if short is not None and len(short.split()) == 1 and len(words) > 1:
        flat = "".join(fold(short).split())
        if len(flat) >= 2:
            out.append(f"b:{flat}")
    return list(dict.fromkeys(out))


def link_classes(occ: DataFrame, classes: DataFrame, forms: DataFrame) -> DataFrame:
    """``(name, class)`` with the classes joined that spell one rewriting; ``forms`` holds (name, form).

    All is counted by class and form first, so a form that a third of all names share is one row per class; the
    classes of one word set are linked to the smallest of them, never pairwise.  No side has a bound, so none is broadcast.
    """
    spelt = cut(forms.hint("merge").join(classes, "name").select("name", "class", F.substring("form", 1, 1).alias("rule"), F.expr("substring(form, 3)").alias("form")))
    per = spelt.select("class", "rule", "form").distinct()
    words = per.filter("rule = 'o'")
    star = words.hint("merge").join(words.groupBy("form").agg(F.min("class").alias("least")), "form").filter("class <> least").select(F.col("class").alias("a"), F.col("least").alias("b"))
    short = per.filter("rule = 's'").select(F.col("class").alias("short"), "form")
    wanted = short.select("form").distinct()
    long = per.filter("rule in ('i', 'b')").select(F.col("class").alias("long"), "form", (F.col("rule") == "b").alias("stated")).groupBy("form", "long").agg(F.max("stated").alias("stated"))
    long = long.hint("merge").join(wanted, "form", "left_semi")
    # a class that spells the form both ways says itself what it means
    rare = long.groupBy("form").agg(F.count("*").alias("n"), F.min("long").alias("one"), F.min(F.when(F.col("stated"), F.col("long"))).alias("said"), F.count_if("stated").alias("says"))
    clear = F.when(F.col("says") == 1, F.col("said")).when((F.col("n") == 1) & (F.length("form") >= SURE_INITIALS), F.col("one"))
    rare = cut(rare.select("form", clear.alias("long")))  # read by four branches
    sure = rare.filter("long is not null")
    open_ = rare.filter("long is null").select("form")
    shorts = spelt.filter("rule = 's'").hint("merge").join(open_, "form", "left_semi").select("name", F.col("class").alias("short"), "form")
    longs = spelt.filter("rule in ('i', 'b')").hint("merge").join(open_, "form", "left_semi").select("name", F.col("class").alias("long"), "form").distinct()
    seen = occ.hint("merge").join(shorts, "name").select("row", "form", "short").distinct().hint("merge").join(occ.hint("merge").join(longs, "name").select("row", "form", "long").distinct(), ["row", "form"])
    voted = seen.groupBy("form", "short", "long").agg(F.count("*").alias("v")).groupBy("form", "short").agg(F.max_by("long", F.struct("v", "long")).alias("long"))
    links = short.hint("merge").join(sure, "form").select(F.col("short").alias("a"), F.col("long").alias("b")).unionByName(voted.select(F.col("short").alias("a"), F.col("long").alias("b"))).unionByName(star)
    links = cut(links.filter("a <> b").distinct())
    if links.isEmpty():
        return classes
    found = components(links)
    joined = classes.join(found.hint("merge"), classes["class"] == found["node"], "left").select("name", F.coalesce("component", "class").alias("class"))
    return joined
