"""Reading a typed resource name: stem, subject, legal form (the kind of resource) and code.

``Gotafermir: Disease Ontology Portal``, ``Portal of Gotafermir Disease Ontology``, ``Gotafermir DO Portal``
and ``Gotafermir-DO v2`` are four rewritings of one name.  The reader undoes, by rule, what people do to a
name: token order, legal forms and their abbreviations, initials, versions and other tails, quotes, markup,
accents, and digits typed for letters.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

from resinv.llm.text import osa, unaccent

# The kinds of resource that end a name like a legal form, their usual short writings, the
# suffixes of short names, and tails that people add to a name.
KINDS = "atlas archive browser catalogue compendium collection database knowledgebase library map platform portal registry repository resource server warehouse".split()
KIND_SHORT = {
    "db": "database", "kb": "knowledgebase", "base": "database", "catalog": "catalogue", "cat": "catalogue", "repo": "repository",
    "arch": "archive", "res": "resource", "reg": "registry", "regi": "registry", "port": "portal", "brow": "browser", "atl": "atlas",
    "lib": "library", "know": "knowledgebase", "knowl": "knowledgebase", "data": "database", "coll": "collection", "serv": "server",
}
SUFFIXES = "db kb base".split()
TAILS = "v project server beta alpha online website web site the official version release".split()
SMALL = "of for the a an and in on at by".split()

_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_LEET = str.maketrans({"0": "o", "1": "l", "3": "e", "5": "s"})
_TOKEN = re.compile(r"[^\W_]+\.?")
_CODE = re.compile(r"^(.*?[^\W\d_]{4,}?)-?((?:DB|KB|Base|base)|[A-Z]{1,5}\d?|[A-Z]\d+)$")


@dataclass(frozen=True)
class Name:
    """What a name says.  ``subject`` is empty where the name has none, ``code`` where it has no initials."""

    stem: str
    subject: tuple[str, ...] = ()
    kind: str = ""
    code: str = ""
    flat: str = ""


@lru_cache(100_000)
def kind_of(token: str) -> str:
    """The legal form that a token means, '' if none; typos of up to two letters are undone."""
    t = token.lower().rstrip(".")
    if t in KINDS:
        return t
    if t in KIND_SHORT:
        return KIND_SHORT[t]
    if len(t) < 4:
        return ""
    for k in KINDS:
        limit = 2 if len(k) >= 7 else 1
        if len(k) >= 5 and osa(t, k, limit) <= limit:
            return k
        if 4 <= len(t) <= 6 and k.startswith(t) and token.endswith("."):
            return k
    return ""


def _clean(raw: str) -> str:
    text = unaccent(_TAG.sub(" ", raw)).strip()
    while len(text) > 1 and text[0] in "\"'“”«‘([{" and text[-1] in "\"'“”»’)]}":
        text = text[1:-1].strip()
    text = re.sub(r"\b(?=\w*[^\W\d_]{3})([^\W\d_]+)([0135])(?=[a-z])", lambda m: m[1] + m[2].translate(_LEET), text)
    text = re.sub(r"\b[01](?=[a-z])", lambda m: m[0].translate(_LEET), text)
    return re.sub(r"\s+", " ", text)


def read_name(raw: str | None) -> Name | None:
    """The parts of a name; None for null, blank, ``N/A`` and ``-``."""
    if raw is None or raw.strip() in ("", "-") or raw.strip().upper() == "N/A":
        return None
    text = _clean(raw)
    if m := re.match(r"^(.{3,}?)\s*[(\[]([^()\[\]]*)[)\]]\s*$", text):
        text = m[1]  # a short name in brackets behind a long one
    text = re.sub(r"[\s,;:-]*\bv?\.?\s?\d+(?:\.\d+)+$|[\s,;:-]+(?:v|version|release)\.?\s?\d+$|\s+\d+$", "", text, flags=re.I)
    if re.match(r"^\S+$", text) and text.count("-") >= 2:
        text = text.replace("-", " ")
    comma = re.match(r"^(.+),\s*([^\s,]+)$", text)
    colon = re.match(r"^([^\s:]+(?:\s[A-Z]+)?)\s*:\s*(.+)$", text)
    if comma:
        text = f"{comma[2]} {comma[1]}"
    elif colon:
        text = f"{colon[1]} {colon[2]}"
    words = text.split()
    while len(words) > 1 and words[-1].lower().strip(".") in TAILS:
        words.pop()
    if len(words) > 1 and words[0].lower() == "the":
        words = words[1:]
    if not words:
        return None
    if len(words) == 1 or (len(words) == 2 and words[1].lower() == "database" and _is_short(words[0])):
        return _short(words[0])
    return _long(words)


def _is_short(word: str) -> bool:
    return bool(re.search(r"[a-z](?:[A-Z]{1,5}|Base|base|[A-Z]?\d+)$|-[A-Za-z]{0,3}\d*$", word))


def _flat(text: str) -> str:
    return re.sub(r"[\W_]+", "", text).lower()


def _short(word: str) -> Name:
    word = word.strip(".,:;'\"")
    word = re.sub(r"(?<=[A-Za-z0-9])db$", "", word) if re.search(r"(?:[A-Z]{1,5}|[A-Z]\d+|Base)db$", word) else word
    flat = _flat(word)
    if m := re.match(r"^([^\W\d_]{4,})-([^\W_]{1,5})$", word):
        return Name(m[1].lower(), (), "", m[2].lower(), flat)
    if m := re.match(r"^(.*[a-z]{3,})(DB|KB|Base|BASE)$", word):
        return Name(m[1].lower(), (), "", m[2].lower(), flat)
    if m := re.match(r"^(.*[a-z]{3,})([A-Z]{1,6}|[A-Z][A-Za-z]{1,3}[A-Z])$", word):
        return Name(m[1].lower(), (), "", m[2].lower(), flat)
    if (m := re.match(r"^(.*[a-z]{4,})(B[a-z]{2,4})$", word)) and osa(m[2].lower(), "base", 1) <= 1:
        return Name(m[1].lower(), (), "", "base", m[1].lower() + "base")
    return Name(flat, (), "", "", flat)


def _long(words: list[str]) -> Name:
    tokens = [t for w in words for t in _TOKEN.findall(w.replace("-", " ") if not re.match(r"^\w+-\w{1,3}$", w) else w.replace("-", ""))]
    joined = " ".join(t.lower() for t in tokens)
    joined = re.sub(r"\bdata base\b", "database", re.sub(r"\bknowledge base\b", "knowledgebase", joined))
    kinds = [kind_of(t) for t in joined.split()]
    originals = tokens if len(tokens) == len(kinds) else joined.split()
    low = joined.split()
    upper = [len(t) > 1 and t.isupper() for t in originals] if not all(t.isupper() for t in originals) else [False] * len(low)
    small = [t.rstrip(".") in SMALL or (len(t) <= 3 and not upper[i] and not t.endswith(".") and t not in KIND_SHORT and any(osa(t, s, 1) <= 1 for s in ("of", "for"))) for i, t in enumerate(low)]
    if kinds[0] and len(low) > 1:  # "Portal of Stem Subject", "Portal Stem for Subject"
        at = 1
        while at < len(low) - 1 and small[at]:
            at += 1
        stem, rest, kind = at, [i for i in range(at + 1, len(low)) if not small[i]], kinds[0]
    else:
        last = max((i for i, k in enumerate(kinds) if k and i > 0), default=0)
        if last and last < len(low) - 1 and last + 2 <= len(low) and small[last + 1] and last + 2 == len(low) - 1:
            stem, rest, kind = last + 2, [i for i in range(last) if not small[i]], kinds[last]  # "Subject Portal of Stem"
        else:
            kind = kinds[last] if last else ""
            stem, rest = 0, [i for i in range(1, len(low)) if i != last and not small[i]]
    code, subject = "", []
    for i in rest:
        original = originals[i].rstrip(".")
        if not subject and not code and len(rest) <= 2 and (m := re.match(r"^([A-Z]{1,4}?)(DB|KB|Res|Repo|Arch|Regi?|Cat|Port|Brow|Atl|Know|Coll|Lib)?$", original)) and not kind_only(original):
            code = m[1].lower()
            kind = kind or KIND_SHORT.get((m[2] or "").lower(), "")
        elif not subject and not code and len(rest) == 1 and re.match(r"^[A-Z]\d+$", original):
            code = original.lower()
        else:
            subject.append(low[i].rstrip("."))
    head = _short(originals[stem]) if _is_short(originals[stem]) else None
    base = head.stem if head else low[stem].rstrip(".")
    if head and head.code and not code:
        code = head.code
    if not subject and not code and kind and len(low) == 2 and low[1].rstrip(".") in SUFFIXES:
        return Name(base, (), "", low[1].rstrip("."), base + low[1].rstrip("."))
    return Name(base, tuple(subject), kind, code, _flat(base + code) if code or not subject else "")


def kind_only(token: str) -> bool:
    return token.lower() in ("db", "kb")
