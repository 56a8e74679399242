"""Variant spellings of names: classes of the names that mean one resource.

Every distinct name is rewritten to its canonical parts by rule (``names.read_name``): token order, legal
form, initials, tails, accents.  Rewritings are exploded into forms and joined by equality:

* *flat* forms join short names that nobody can cut by themselves (``gotafermirdo``) to the stem and code
  that other names spell out;
* *deletion* forms (a stem without one or two of its letters) join misspelt stems; the exact distance is
  verified and the link is scored by the rarity of what both sides share - a shared row or a shared subject or
  code is rare, the bare stem alone is taken only at distance one;
* *initial* forms join codes to the subjects they abbreviate within one stem; a form that several subjects of
  a family produce is not rare and links nothing;
* *whole-name* rewritings (``rewritings``) join names of no common stem: initials of all words, sorted words,
  words spelt out, short names in brackets.

Only distinct names and their parts are shuffled, so a name that fills a third of all rows costs one row.  All
joins are merge joins: every side grows with the names, and the planner, which takes an array for one element,
would broadcast what is exploded from one (the rewritings) at a tenth of its size and less.  The
last step works on the distinct (subject, kind, code) readings of one stem, greedily against the subjects found
so far - never on all pairs, never on rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resinv.llm.names import KINDS, SUFFIXES, read_name
from resinv.llm.rewritings import link_classes, rewritings
from resinv.llm.text import osa
from resinv.operators.lineage import cut

OPEN = -2  # a reading that any subject of a family could own
_STRINGS = T.ArrayType(T.StringType())
_PARSED = T.StructType([T.StructField(n, _STRINGS if n == "subject" else T.StringType()) for n in ("stem", "subject", "kind", "code", "flat")] + [T.StructField("forms", _STRINGS)])


@F.pandas_udf(_PARSED)
def _parse(names: pd.Series) -> pd.DataFrame:
    rows = []
    for n in names:
        p = read_name(n)
        rows.append((p.stem, list(p.subject), p.kind, p.code, p.flat, rewritings(n)) if p and p.stem else (None, [], None, None, None, []))
    return pd.DataFrame(rows, columns=["stem", "subject", "kind", "code", "flat", "forms"])


@F.pandas_udf(_STRINGS)
def _initial_forms(subjects: pd.Series, kinds: pd.Series) -> pd.Series:
    return pd.Series([initial_forms(s, k) for s, k in zip(subjects, kinds)], dtype=object)


def initial_forms(subject, kind: str | None) -> list[str]:
    """The codes that a subject can be shortened to, with and without the first letter of the kind."""
    words = [w for w in subject if w]
    out = []
    for n in range(1, min(3, len(words)) + 1):
        if n == 1 and len(words) > 2:
            continue
        code = "".join(w[0] for w in words[-n:])
        out += [code, code + kind[0]] if kind else [code]
        if kind in ("database", "knowledgebase"):
            out.append(code + ("db" if kind == "database" else "kb"))
    return out


@F.pandas_udf(_STRINGS)
def _deletions(stems: pd.Series) -> pd.Series:
    return stems.map(deletions)


def deletions(stem: str) -> list[str]:
    """The stem and every form of it without one letter, of long stems also without two."""
    if len(stem) < 5:
        return []
    one = {stem[:i] + stem[i + 1 :] for i in range(len(stem))}
    out = {stem} | one
    if 8 <= len(stem) <= 40:
        out |= {s[:i] + s[i + 1 :] for s in one for i in range(len(s))}
    return sorted(out)


@F.pandas_udf(T.IntegerType())
def _distance(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([osa(x, y, 2) for x, y in zip(a, b)], dtype="int32")


def _word_alike(a: str, b: str) -> bool:
    if a == b:
        return True
    short, long = sorted((a, b), key=len)
    if len(short) >= 3 and long.startswith(short):
        return True
    limit = 1 if len(long) <= 5 else 2 if len(long) <= 8 else 3
    if osa(a, b, limit) <= limit:
        return True
    return len(short) >= 3 and len(short) < len(long) - 1 and osa(short, long[: len(short)], 1) <= 1


def _subject_alike(a: list[str], b: list[str]) -> bool:
    """Whether two subjects agree word by word from the end, one perhaps with more words in front."""
    n = min(len(a), len(b))
    if n == 0:
        return False
    if n == 1 and max(len(a), len(b)) > 2:
        return False
    return all(_word_alike(x, y) for x, y in zip(a[-n:], b[-n:])) or sorted(a) == sorted(b)


def _is_plain(code: str) -> bool:
    return not code or code in SUFFIXES or (len(code) == 2 and code[1].isdigit())


def classes_of_stem(readings: list[tuple[tuple[str, ...], str, str, int]]) -> list[int]:
    """For each distinct (subject, kind, code, rows) reading of one stem, the number of its class.

    Subjects are taken by falling frequency, each joining the first like subject found before.  Codes join
    the one subject they can abbreviate; readings without subject and code join the only class there is, or
    the only one of their kind; where that is not one, they stay ``OPEN``.
    """
    order = sorted(range(len(readings)), key=lambda i: (-readings[i][3], readings[i]))
    centres: list[dict] = []
    label = [-1] * len(readings)

    def add(i: int, at: int) -> None:
        subject, kind, code, _ = readings[i]
        label[i] = at
        if kind:
            centres[at]["kinds"].add(kind)
        centres[at]["codes"].update([code] if not _is_plain(code) else [])

    for i in order:
        subject, kind, code, _ = readings[i]
        if not subject:
            continue
        tries = [list(subject)] if kind or len(subject) < 3 else [list(subject), list(subject[:-1])]  # the last word may be a kind beyond recognition
        found = next((c for t in tries for c, centre in enumerate(centres) if _subject_alike(t, centre["subject"])), None)
        if found is None:
            centres.append({"subject": list(subject), "kinds": set(), "codes": set(), "forms": set(), "strong": set()})
            found = len(centres) - 1
        centres[found]["forms"].update(initial_forms(subject, kind))
        centres[found]["strong"].update(f for f in initial_forms(subject, kind) if len(subject) > 1 and len(f) > 1 and f[:2] == subject[-2][:1] + subject[-1][:1])
        add(i, found)
    for i in order:
        subject, kind, code, _ = readings[i]
        if label[i] >= 0 or _is_plain(code):
            continue
        fits = [c for c, centre in enumerate(centres) if code in centre["forms"] or code in centre["codes"]]
        if len(fits) != 1:
            fits = [c for c in fits if kind in centres[c]["kinds"]] or fits
        if not fits:
            kinds_first = {k[0] for k in KINDS} | {"d", "k"}
            fits = [
                c
                for c, centre in enumerate(centres)
                if any((code.startswith(f) and code[len(f) :] in ({"db", "kb"} | kinds_first)) or (f.startswith(code) and f[len(code) :] in ({"db", "kb"} | kinds_first)) for f in centre["strong"] | centre["codes"] if len(f) > 1 and len(code) > 1)
            ]
        if not fits and len(code) >= 3:  # one letter too many
            fits = [c for c, centre in enumerate(centres) if any(len(f) == len(code) - 1 >= 2 and osa(code, f, 1) == 1 for f in centre["strong"] | centre["codes"])]
        if len(fits) == 1:
            add(i, fits[0])
        elif not fits and code not in ("d", "k", "b", "bd", "bk"):  # a suffix cut short is no initial
            centres.append({"subject": [], "kinds": set(), "codes": set(), "forms": set(), "strong": set()})
            add(i, len(centres) - 1)
    for i in order:
        if label[i] >= 0:
            continue
        subject, kind, code, _ = readings[i]
        fits = list(range(len(centres)))
        if len(fits) > 1 and kind:
            fits = [c for c in fits if kind in centres[c]["kinds"]]
        elif len(fits) > 1 and len(code) == 2 and code[1].isdigit():
            fits = [c for c in fits if any(k[0] == code[0] for k in centres[c]["kinds"])]
        if len(fits) == 1:
            add(i, fits[0])
        elif centres:
            label[i] = OPEN
        else:
            label[i] = 0
    return label


def name_classes(occurrences: DataFrame, row_col: str = "row", name_col: str = "name") -> DataFrame:
    """``(name, class)`` for every distinct name; equal class means one resource.

    ``occurrences`` holds one line per row and name; names of one row name one resource.  Null, blank,
    ``N/A`` and ``-`` are no names and give no line, repeated lines count once per row, an empty table gives
    an empty result, other columns are not read.  A class is named by the smallest name in it.
    """
    occ = occurrences.select(F.col(row_col).cast("string").alias("row"), F.col(name_col).cast("string").alias("name")).filter(F.col("name").isNotNull() & (F.trim("name") != ""))
    counted = occ.groupBy("name").agg(F.count("*").alias("n"))
    parsed = cut(counted.withColumn("p", _parse("name")).select("name", "n", "p.*").filter("stem is not null"))
    whole = parsed.select("name", F.explode("forms").alias("form"))

    # 1. flat forms: short names that cannot be cut by themselves
    spelt = parsed.filter((F.size("subject") > 0) | (F.col("code") != "") | (F.col("kind") != ""))
    from_subject = spelt.filter(F.size("subject") > 0).select("stem", "n", F.explode(_initial_forms("subject", "kind")).alias("code"))
    from_code = spelt.filter("code <> ''").select("stem", "n", "code")
    from_rule = spelt.select("stem", "n", F.explode(F.array(*map(F.lit, SUFFIXES))).alias("code"))
    forms = from_subject.unionByName(from_code).unionByName(from_rule).groupBy("stem", "code").agg(F.sum("n").alias("w")).withColumn("form", F.concat("stem", "code"))
    plain = parsed.filter((F.size("subject") == 0) & (F.col("code") == "") & (F.col("kind") == ""))
    cuts = plain.select(F.col("stem").alias("form")).distinct().hint("merge").join(forms, "form").groupBy("form").agg(F.max(F.struct(F.length("stem").alias("l"), "w", "stem", "code")).alias("best"))
    cuts = cuts.select("form", F.col("best.stem").alias("cut_stem"), F.col("best.code").alias("cut_code"))
    parsed = (
        parsed.withColumn("form", F.when((F.size("subject") == 0) & (F.col("code") == "") & (F.col("kind") == ""), F.col("stem")))
        .join(cuts.hint("merge"), "form", "left")
        .select("name", "n", F.coalesce("cut_stem", "stem").alias("stem"), "subject", "kind", F.coalesce("cut_code", "code").alias("code"))
    )
    parsed = cut(parsed)

    # 2. deletion forms: misspelt stems.  Codes and initials have a bounded alphabet and length.
    keyed = parsed.select("stem", "n", F.array_union(F.array("code"), _initial_forms("subject", "kind")).alias("keys"))
    stems = keyed.groupBy("stem").agg(F.sum("n").alias("support"), F.array_distinct(F.flatten(F.collect_set("keys"))).alias("keys"))
    stems = cut(stems)
    exploded = stems.select("stem", F.explode(_deletions("stem")).alias("form"))
    a, b = exploded.select(F.col("stem").alias("a"), "form"), exploded.select(F.col("stem").alias("b"), "form")
    # exploded forms are far larger than the planner believes, so the join must not broadcast them
    # two edits are at most three plain edits unless both are swaps, which keep the letters
    letters = lambda x: F.array_sort(F.split(x, ""))
    close = (F.levenshtein("a", "b", 3) >= 0) | ((F.length("a") == F.length("b")) & (letters("a") == letters("b")))
    # what several branches read is cut: one plan of all of them repeats it per branch and fills the driver's memory
    near = cut(a.hint("merge").join(b, "form").filter("a < b").select("a", "b").distinct().filter(close).withColumn("d", _distance("a", "b")).filter("d <= 2"))
    # short forms without the last syllable: the longer stem must be the only one, or share a row
    has_subject = parsed.groupBy("stem").agg(F.max((F.size("subject") > 0) | (F.col("kind") != "")).alias("long"))
    bare = has_subject.filter("not long and length(stem) >= 5").select(F.col("stem").alias("a"))
    longer = stems.select(F.col("stem").alias("b"), F.explode(F.sequence(F.lit(2), F.lit(5))).alias("k")).filter("length(b) - k >= 5").select("b", F.expr("substring(b, 1, length(b) - k)").alias("a"))
    shortened = cut(bare.hint("merge").join(longer, "a").select("a", "b"))
    with_rows = occ.hint("merge").join(parsed.select("name", "stem"), "name").select("row", "stem").distinct()
    ra, rb = with_rows.select("row", F.col("stem").alias("a")), with_rows.select("row", F.col("stem").alias("b"))
    asked = near.select("a", "b").unionByName(shortened).distinct()
    together = cut(asked.join(ra.hint("merge"), "a").join(rb.hint("merge"), ["row", "b"]).select("a", "b").distinct().withColumn("together", F.lit(True)))
    links = (
        near.join(together.hint("merge"), ["a", "b"], "left")
        .join(stems.select(F.col("stem").alias("a"), F.col("support").alias("sa"), F.col("keys").alias("ka")).hint("merge"), "a")
        .join(stems.select(F.col("stem").alias("b"), F.col("support").alias("sb"), F.col("keys").alias("kb")).hint("merge"), "b")
    )
    shared = F.size(F.filter(F.array_intersect("ka", "kb"), lambda k: F.length(k) >= 2)) > 0
    links = links.filter((F.col("d") == 1) | F.col("together").isNotNull() | shared)
    only = Window.partitionBy("a")
    cutoff = shortened.join(together.hint("merge"), ["a", "b"], "left").withColumn("choices", F.count("*").over(only)).filter("together or choices = 1")
    cutoff = cut(cutoff.join(stems.select(F.col("stem").alias("b"), F.col("support").alias("ts")).hint("merge"), "b").selectExpr("a as s", "b as t", "-1L as ss", "ts", "1 as d", "together", "a as a_", "b as b_"))
    pair = cutoff.select(F.least("a_", "b_").alias("a"), F.greatest("a_", "b_").alias("b")).distinct()
    links = cut(links.join(pair.hint("merge"), ["a", "b"], "left_anti"))  # such a pair has one direction only, from short to long
    cutoff = cutoff.drop("a_", "b_")
    both = links.selectExpr("a as s", "b as t", "sa as ss", "sb as ts", "d", "together").unionByName(links.selectExpr("b as s", "a as t", "sb as ss", "sa as ts", "d", "together")).unionByName(cutoff)
    up = both.filter("ts > ss or (ts = ss and t < s)").groupBy("s").agg(F.max(F.struct(F.col("together").isNotNull().alias("g"), (-F.col("d")).alias("nd"), "ts", "t")).alias("m")).select("s", F.col("m.t").alias("t"))
    up = cut(up)
    while True:  # every step leads to a better supported stem, so chains have no cycle and their length halves
        nxt = up.select(F.col("s").alias("t"), F.col("t").alias("tt"))
        stepped = cut(up.join(nxt.hint("merge"), "t", "left").select("s", F.coalesce("tt", "t").alias("t"), F.col("tt").isNotNull().alias("moved")))
        up = stepped.select("s", "t")
        if stepped.filter("moved").isEmpty():
            break
    parsed = parsed.join(up.withColumnRenamed("s", "stem").hint("merge"), "stem", "left").select("name", "n", F.coalesce("t", "stem").alias("stem"), "subject", "kind", "code")
    parsed = cut(parsed)

    # 3. initial forms: subjects and codes within a stem, on distinct readings
    readings = parsed.groupBy("stem", "subject", "kind", "code").agg(F.sum("n").alias("n"))

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []

        def close() -> list[tuple]:
            parts = classes_of_stem([(tuple(s), k, c, int(n)) for _, s, k, c, n in held])
            return [(stem, s, k, c, p) for (stem, s, k, c, _), p in zip(held, parts)]

        names = ["stem", "subject", "kind", "code", "part"]
        for pdf in batches:
            done: list[tuple] = []
            for row in zip(pdf.stem, pdf.subject, pdf.kind, pdf.code, pdf.n):
                if held and held[0][0] != row[0]:
                    done += close()
                    held = []
                held.append(row)
            yield pd.DataFrame(done, columns=names)
        if held:
            yield pd.DataFrame(close(), columns=names)

    # one stem's readings are neighbours after the sort; the stream holds one stem at a time
    tasks = max(1, int(occurrences.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    labelled = readings.repartition(tasks, "stem").sortWithinPartitions("stem").mapInPandas(label, "stem string, subject array<string>, kind string, code string, part int")
    keyed = cut(parsed.hint("merge").join(labelled, ["stem", "subject", "kind", "code"]).select("name", "stem", "part"))
    # a family's bare names belong to the subject they share most rows with
    ours = occ.hint("merge").join(keyed.filter(F.col("part") == OPEN).select("name", "stem"), "name").select("row", "name", "stem")
    theirs = occ.hint("merge").join(keyed.filter(F.col("part") >= 0).withColumnRenamed("name", "other"), occ.name == F.col("other")).select("row", "stem", "part").distinct()
    votes = ours.hint("merge").join(theirs, ["row", "stem"]).groupBy("name", "stem", "part").agg(F.count("*").alias("v"))
    won = cut(votes.groupBy("name").agg(F.max(F.struct("v", (-F.col("part")).alias("np"))).alias("m")).select("name", (-F.col("m.np")).alias("won")))
    keyed = keyed.join(won.hint("merge"), "name", "left").select("name", "stem", F.coalesce("won", "part").alias("part"))
    least = keyed.groupBy("stem", "part").agg(F.min("name").alias("class"))
    classes = cut(keyed.hint("merge").join(least, ["stem", "part"]).select("name", "class"))
    # 4. whole-name rewritings: initials, word order, nicknames
    linked = cut(link_classes(occ, classes, whole))
    return linked.hint("merge").join(linked.groupBy("class").agg(F.min("name").alias("least")), "class").select("name", F.col("least").alias("class"))


def as_pairs(classes: DataFrame) -> DataFrame:
    """``(name_a, name_b)``, name_a the smaller, for the different names of each class."""
    a, b = classes.select("class", F.col("name").alias("name_a")), classes.select("class", F.col("name").alias("name_b"))
    return a.hint("merge").join(b, "class").filter("name_a < name_b").select("name_a", "name_b")
