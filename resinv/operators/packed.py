"""Several values packed in one field: delimiter inference, split and explode with position.

A *source* is the set of cells of one field that are written with the same hard marks (line breaks, bars, semicolons,
slashes between spaces, tabs; what stands in quotes does not count).  Which of a source's marks end a value is
inferred from all its cells together: every subset of the marks is scored by

* piece type regularity - the share of pieces that look like the type of the field (id, person, organisation,
  title), and
* piece count consistency - the share of cells whose number of pieces is the one that another column states or,
  where none does, is at least two.

The scores are one aggregate over the scan, one row per source and subset.  The cells are then split, and commas and
conjunctions, which may also stand within a value, end one where that makes the values of the cell more regular.

Splitting runs inside one ``mapInPandas`` over the scan: no shuffle, one output row per value.  Cells of any length
are read whole; the cost is linear in the cell except for the soft-delimiter decision, which is a dynamic programme
over runs of at most four atoms.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Name particles, and nouns by which the name of an organisation is known.
PARTICLES = "van von de der den di da del la le ter ten bin al".split()
ORG_NOUNS = (
    "council fund funds trust foundation agency institute board university ministry society centre center "
    "department programme program commission academy association office donor ltd inc gmbh company "
    "consortium charity college hospital corporation grant grants award fellowship scholarship"
).split()
ORG_ABBREVIATIONS = "inst found fdn counc ag bd univ dept soc assoc fnd agcy tr co".split()

_QUOTED = re.compile(r'"(?:[^"\\]|""|\\.)*"', re.S)
_HARD = re.compile(r"[ \t]*(?:\r?\n|\t|\|+|;+|(?<=\s)/(?=\s|$)|(?:(?<=^)/(?=\s)))[ \t]*")
_HARD_KINDS = ("\n", "|", ";", "/", "\t")
_SOFT = re.compile(r"\s*,\s*(?![^(]*\))")
_AND = re.compile(r"\s+(?:and|&)\s+|^(?:and|&)\s+", re.I)
_P = "(?:(?:" + "|".join(PARTICLES) + r")\s+)*"
_W = r"[^\W\d_][\w'’]*(?:-[^\W\d_][\w'’]*)*"
_INITIALS = r"[^\W\d_]\.?(?:[\s.-]*[^\W\d_]\.?){0,3}"
_PERSON = re.compile(
    rf"(?:(?:[^\W\d_]\.[\s-]*)+{_P}{_W}(?:\s+{_W})?"
    rf"|{_P}{_W}(?:\s+{_W})?\s+[A-Z]{{1,3}}"
    rf"|{_W}(?:\s+[^\W\d_]\.)*\s+{_P}{_W}(?:\s+{_W})?)"
)
_PERSON_INVERTED = re.compile(rf"{_P}{_W}(?:\s+{_W})?\s*,\s*(?:{_INITIALS}|{_W}(?:\s+{_W}|\s+[^\W\d_]\.)?)")
_ID = re.compile(r"[\w.:-]+")
_NUM = re.compile(r"\d[\d.]*")


def _near(word: str, target: str) -> bool:
    """Edit distance at most 1 (2 for words of six letters or more), swaps counting once."""
    limit = 2 if len(target) >= 6 else 1
    if abs(len(word) - len(target)) > limit:
        return False
    before: list[int] = []
    row = list(range(len(target) + 1))
    for i, a in enumerate(word, 1):
        older, before, row = before, row, [i]
        for j, b in enumerate(target, 1):
            cost = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (a != b))
            if older and j > 1 and word[i - 2] == b and a == target[j - 2]:
                cost = min(cost, older[j - 2] + 1)
            row.append(cost)
    return row[-1] <= limit


_org_cache: dict[str, bool] = {}


def _org_noun(word: str) -> bool:
    word = word.lower().strip(".,'\"()")
    if word not in _org_cache:
        if len(_org_cache) > 50_000:
            _org_cache.clear()
        _org_cache[word] = word in ORG_ABBREVIATIONS or word in ORG_NOUNS or any(_near(word, a) for a in ORG_ABBREVIATIONS if len(a) > 4) or len(word) > 3 and any(_near(word, noun) for noun in ORG_NOUNS if len(noun) > 3)
    return _org_cache[word]


def _conjunction(word: str) -> bool:
    return 2 <= len(word) <= 4 and _near(word, "and")


def _badness_org(atoms: list[str]) -> float:
    """0 for a sound organisation made of these comma-separated atoms, more the less it looks like one."""
    nouns = [any(_org_noun(w) for w in a.split()) for a in atoms]
    first, last = atoms[0].split(), atoms[-1].split()
    if len(atoms) == 1:
        if nouns[0] or (len(first) == 1 and (first[0].upper() == first[0] or first[0].lower() == first[0] or "." in first[0])):
            return 0.0
        return 0.45 if len(first) >= 3 else 0.5 if first and first[0].lower() == first[0] else 1.0
    tail = len(last) == 1 and last[0][:1].isupper() and not _acronym(last[0]) and not nouns[-1]
    core = nouns[:-1] if tail else nouns
    listed = len(core) == 1 or any(w == "&" or _conjunction(w.lower()) for w in atoms[len(core) - 1].split()[1:])  # "Health, Education and Welfare"
    if atoms[0][:1].islower() and atoms[-1][:1].isupper():
        listed = False  # "none declared" before a name
    if sum(core) == 1 and (core[-1] or core[0]) and listed and all(len(a.split()) <= 5 for a in atoms[: len(core) - 1]):
        return 0.0
    return 1.2 * (len(atoms) - 1)


def _acronym(word: str) -> bool:
    return len(word) > 1 and (word.upper() == word or word.lower() == word or bool(re.fullmatch(r"(?:\w\.)+", word)))


def _badness_person(atoms: list[str]) -> float:
    if len(atoms) == 1:
        return 0.0 if _PERSON.fullmatch(atoms[0]) else 1.0 if len(atoms[0].split()) < 3 else 0.6
    return 0.0 if len(atoms) == 2 and _PERSON_INVERTED.fullmatch(", ".join(atoms)) else 1.5 * (len(atoms) - 1)


def _badness_id(atoms: list[str]) -> float:
    return 0.0 if len(atoms) == 1 and _ID.fullmatch(atoms[0]) else float(len(atoms))


def _badness_title(atoms: list[str]) -> float:
    return 0.0  # the comma is part of a title's language, so no comma ever ends one


KINDS = {
    "id": (_badness_id, True, True),
    "person": (_badness_person, True, True),
    "organisation": (_badness_org, True, False),
    "title": (_badness_title, False, False),
    "place": (_badness_title, False, False),
}


def _mask(text: str) -> tuple[str, list[str]]:
    """The text with each quoted value replaced by a private-use character, and those values."""
    held: list[str] = []

    def hold(m: re.Match) -> str:
        before, after = text[: m.start()].rstrip(" "), text[m.end() :].lstrip(" ")
        opens = not before or before[-1] in "|;,/\n\t[" or re.search(r"(?:^|\W)(?:and|&)$", before)
        closes = not after or after[0] in "|;,/\n\t]" or re.match(r"(?:and|&)\s", after)
        if not (opens and closes):
            return m.group()
        held.append(m.group()[1:-1])
        return f"\ue000{len(held) - 1}\ue001"

    return _QUOTED.sub(hold, text), held


def _unescape(value: str) -> str:
    value = value.replace('""', '"')
    return re.sub(r"\\(u[0-9a-fA-F]{4}|.)", lambda m: chr(int(m[1][1:], 16)) if len(m[1]) == 5 else {"n": "\n", "t": "\t"}.get(m[1], m[1]), value, flags=re.S)


_LIST_ITEM = re.compile(r"""\s*(?:"((?:[^"\\]|\\.)*)"|'((?:[^'\\]|\\.)*)'(?=\s*(?:,|$))|([^,]*?))\s*(?:,|$)""", re.S)


def _list_literal(text: str) -> list[str] | None:
    """The values of a JSON array or a Python list, None if the text is neither."""
    if len(text) < 2 or text[0] + text[-1] not in ("[]", "{}", "()"):
        return None
    body, at, values = text[1:-1].strip(), 0, []
    quoted = body[:1] in "\"'"
    if not quoted and not re.fullmatch(r"[\w.\s,-]*", body):
        return None
    while at < len(body):
        m = _LIST_ITEM.match(body, at)
        if not m or m.end() == at:
            return None
        value = next((g for g in m.groups() if g is not None), "")
        values.append(_unescape_literal(value) if m[3] is None else value)
        at = m.end()
    return values


def _unescape_literal(value: str) -> str:
    return re.sub(r"\\(u[0-9a-fA-F]{4}|x[0-9a-fA-F]{2}|.)", lambda m: chr(int(m[1][1:], 16)) if len(m[1]) > 1 else {"n": "\n", "t": "\t"}.get(m[1], m[1]), value, flags=re.S)


def _atoms(piece: str, kind: str) -> list[str]:
    """Cuts a piece at its soft delimiters where that makes the values more regular."""
    badness, comma, conjunction = KINDS[kind]
    if not comma or ("," not in piece and not (conjunction and _AND.search(piece))):
        return [piece]
    parts = [p for x in _SOFT.split(piece) for p in (_AND.split(x) if conjunction else [x])]
    parts = [p for p in (p.strip() for p in parts) if p]
    if not parts:
        return []
    sealed = [bool(re.fullmatch("\ue000\\d+\ue001", p)) for p in parts]
    best: list[tuple[float, int, int]] = [(0.0, 0, 0)]
    for end in range(1, len(parts) + 1):
        options = []
        for start in range(max(0, end - 4), end):
            run = parts[start:end]
            bad = 0.0 if len(run) == 1 and sealed[start] else 99.0 * (len(run) - 1) if any(sealed[start:end]) else badness(run)
            options.append((best[start][0] + bad, best[start][1] - 1, start))
        best.append(min(options))
    cuts, end = [], len(parts)
    while end:
        cuts.append((best[end][2], end))
        end = best[end][2]
    return [", ".join(parts[a:b]) if b - a > 1 else parts[a] for a, b in reversed(cuts)]


def _read(text: str, held: list[str], hard: tuple[str, ...], kind: str) -> list[str]:
    def cut(m: re.Match) -> str:
        mark = m.group().strip(" ")[:1] or m.group()[:1]
        return "\ue002" if ("\n" if mark in "\r\n" else mark) in hard else m.group()

    pieces = [p.strip() for p in _HARD.sub(cut, text).split("\ue002")]
    return [v for p in pieces if p for v in _atoms(p, kind)]


def _regularity(values: list[str], kind: str) -> float:
    badness = KINDS[kind][0]
    if kind == "title":
        return 1.0
    if not values:
        return 0.0
    good = [1.0 if v.startswith("\ue000") else max(0.0, 1 - badness(_SOFT.split(v))) for v in values]
    return sum(good) / len(good)


def _best_reading(masked: str, held: list[str], present: tuple[str, ...], kind: str, expected: int | None) -> list[str]:
    """The values of a cell by the subset of its marks that scores best on it alone."""
    best: tuple[float, list[str]] | None = None
    for size in range(len(present), -1, -1):
        for hard in combinations(present, size):
            values = _read(masked, held, hard, kind)
            count = 1.0 if expected is None or len(values) == expected else 0.0
            score = _regularity(values, kind) + 0.5 * count + _bonus(kind) * size + 0.01 * min(len(values), 9)
            if best is None or score > best[0] + 1e-9:
                best = (score, values)
    return best[1] if best else []


def _bonus(kind: str) -> float:
    """What a mark that ends values is worth: less in titles, which may hold any of them."""
    return 0.05 if kind == "title" else 0.6


Marks = tuple[str, ...]


def split_cell(text: str | None, kind: str = "organisation", expected: int | None = None, sources: dict[Marks, Marks] | None = None) -> list[str]:
    """The values of one cell, in order, trimmed, without enclosing quotes and with quote escapes undone.

    Null, empty and blank cells hold no value; neither do empty elements.  ``sources`` says which of the marks of a
    cell end its values.  A cell whose marks it does not know is a source of its own: all subsets are scored on it
    alone, ``expected`` being the piece count that another column states.
    """
    if text is None or not text.strip():
        return []
    text = text.strip()
    values = _list_literal(text)
    if values is not None:
        return [v.strip() for v in values if v.strip()]
    if kind == "id":
        text = re.sub(r"[\s/]+", ";", re.sub(r"[\[\]{}]", " ", text).strip())
    if kind == "place":
        text = text.replace(",", ";")
    masked, held = _mask(text)
    marks = {("\n" if m in "\r\n" else m) for m in (x.group().strip(" ")[:1] or x.group()[:1] for x in _HARD.finditer(masked))}
    present = tuple(k for k in _HARD_KINDS if k in marks)
    if sources and present in sources:
        values = _read(masked, held, sources[present], kind)
    else:
        values = _best_reading(masked, held, present, kind, expected)
    out = []
    for v in values:
        v = re.sub("\ue000(\\d+)\ue001", lambda m: _unescape(held[int(m[1])]) if m.group() == v else f'"{held[int(m[1])]}"', v)
        v = v.strip()
        if v:
            out.append(v)
    return out


# One character for each hard mark, in the order of _HARD_KINDS, and what a regular piece of each kind looks like.
_STAND_INS = "\n|;\ue003\t"
_REGULAR = {"id": r"^[\w.:-]+$", "person": r"^[^|;\n\t\ue003]*\p{L}{2}[^|;\n\t\ue003]*$", "organisation": r"^[^|;\n\t\ue003]*\p{L}{2}[^|;\n\t\ue003]*$", "title": r"\p{L}", "place": r"^[^|;\n\t\ue003]*\p{L}{2}[^|;\n\t\ue003]*$"}


def infer_sources(df: DataFrame, fields: dict[str, str], counts: dict[str, str] | None = None) -> dict[str, dict[Marks, Marks]]:
    """Per field, for every set of marks that its cells are written with, those that end values.

    One aggregate over all cells; it has at most one row per field, set of marks and subset of it.
    """
    counts = counts or {}
    cells = []
    for name, kind in fields.items():
        t = F.trim(F.col(name).cast("string"))
        t = F.when(t.rlike(r"(?s)^\[.*\]$|^\{.*\}$|^\(.*\)$") & (F.lit(kind) != "id"), None).otherwise(t)  # a list literal says itself where values end
        t = F.regexp_replace(t, r'"(?:[^"\\]|""|\\.)*"', "Quoted")
        if kind == "id":
            t = F.regexp_replace(F.trim(F.regexp_replace(t, r"[\[\]{}]", " ")), r"[\s/]+", ";")
        if kind == "place":
            t = F.replace(t, F.lit(","), F.lit(";"))
        t = F.regexp_replace(F.regexp_replace(t, r"\r?\n", "\n"), r"(?<=\s)/(?=\s|$)", "\ue003")
        cells.append(F.struct(F.lit(name).alias("field"), F.lit(kind).alias("kind"), t.alias("t"), (F.col(counts[name]).cast("int") if name in counts else F.lit(None).cast("int")).alias("n")))
    marks = F.concat(*[F.when(F.contains(F.col("t"), F.lit(m)), F.lit(m)).otherwise(F.lit("")) for m in _STAND_INS])
    subsets = ["".join(c) for size in range(len(_STAND_INS) + 1) for c in combinations(_STAND_INS, size)]
    each = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*").filter("t is not null and t <> ''").withColumn("marks", marks).filter("marks <> ''")
    inside = F.filter(F.array(*map(F.lit, subsets)), lambda x: F.call_function("translate", x, F.col("marks"), F.lit("")) == "")
    each = each.withColumn("subset", F.explode(inside))
    pieces = F.filter(F.transform(F.split(F.call_function("translate", F.col("t"), F.col("subset"), F.repeat(F.lit("\ue002"), F.length("subset"))), "\ue002"), lambda p: F.trim(p)), lambda p: p != "")
    each = each.withColumn("pieces", pieces)
    regular = F.lit(0.0)
    for kind, pattern in _REGULAR.items():
        regular = F.when(F.col("kind") == kind, F.size(F.filter("pieces", lambda p: p.rlike(pattern))) / F.greatest(F.size("pieces"), F.lit(1))).otherwise(regular)
    consistent = F.when(F.col("n").isNotNull(), F.size("pieces") == F.col("n")).otherwise(F.size("pieces") >= 2).cast("int")
    scores = each.groupBy("field", "kind", "marks", "subset").agg(F.avg(regular).alias("regular"), F.avg(consistent).alias("consistent")).collect()  # at most fields * 3^5 rows
    best: dict[tuple[str, str], tuple[float, str]] = {}
    for r in scores:
        score = r.regular + 0.5 * r.consistent + _bonus(r.kind) * len(r.subset)
        if (r.field, r.marks) not in best or (score, r.subset) > best[r.field, r.marks]:
            best[r.field, r.marks] = (score, r.subset)
    named = lambda x: tuple(k for k, m in zip(_HARD_KINDS, _STAND_INS) if m in x)
    out: dict[str, dict[Marks, Marks]] = {f: {(): ()} for f in fields}
    for (field, written), (_, chosen) in best.items():
        out[field][named(written)] = named(chosen)
    return out


def split_packed(df: DataFrame, key: str, fields: dict[str, str], counts: dict[str, str] | None = None) -> DataFrame:
    """One row ``(key, field, pos, value)`` for every value packed in the given fields.

    ``fields`` maps a column to its piece type (``id``, ``person``, ``organisation``, ``title``, ``place``);
    ``counts`` maps a column to another one that states how many values it holds.  Positions start at 1 and
    skip empty elements.  The delimiters are inferred here, by one job over the cells.  Null, empty or blank cells give no row, repeated rows give repeated values, an
    empty table gives an empty result and columns not named are never read.
    """
    counts = counts or {}
    names = list(fields)
    cells = [F.col(c).cast("string").alias(f"v{i}") for i, c in enumerate(names)]
    stated = [(F.col(counts[c]).cast("double") if c in counts else F.lit(None).cast("double")).alias(f"n{i}") for i, c in enumerate(names)]
    narrow = df.select(F.col(key).alias("k"), *cells, *stated)
    kinds = [fields[c] for c in names]
    sources = infer_sources(df, fields, counts)

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, name in enumerate(names):
                for k, text, n in zip(pdf["k"], pdf[f"v{i}"], pdf[f"n{i}"]):
                    if text is not None and text == text:
                        values = split_cell(text, kinds[i], None if n is None or n != n else int(n), sources[name])
                        rows.extend((k, name, pos, v) for pos, v in enumerate(values, 1))
            yield pd.DataFrame(rows, columns=[key, "field", "pos", "value"])

    kind = narrow.schema["k"].dataType.simpleString()
    return narrow.mapInPandas(explode, schema=f"`{key}` {kind}, field string, pos int, value string")
