"""Text normalisation shared by the operators of this subpackage."""

from __future__ import annotations

import re
import unicodedata

_WORD = re.compile(r"[^\W_]+")
_GAP = re.compile(r"[\W_]+")


def unaccent(text: str) -> str:
    """The text in compatibility form without combining marks."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def fold(text: str) -> str:
    """Unaccented, lower-cased, with every run of other characters than letters and digits as one space."""
    return _GAP.sub(" ", unaccent(text).lower()).strip()


def words(text: str | None) -> list[str]:
    """Lower-cased maximal runs of letters and digits; null counts as ''."""
    return _WORD.findall(text.lower()) if text else []


def osa(a: str, b: str, limit: int) -> int:
    """Optimal string alignment distance (swaps of neighbours count once), or limit + 1 if it is more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    older: list[int] = []
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i in range(1, len(a) + 1):
        older, before, row = before, row, [i]
        ca = a[i - 1]
        for j in range(1, len(b) + 1):
            cb = b[j - 1]
            cost = before[j - 1] + (ca != cb)
            if before[j] + 1 < cost:
                cost = before[j] + 1
            if row[j - 1] + 1 < cost:
                cost = row[j - 1] + 1
            if i > 1 and j > 1 and ca == b[j - 2] and a[i - 2] == cb and older[j - 2] + 1 < cost:
                cost = older[j - 2] + 1
            row.append(cost)
        if min(row) > limit and (not before or min(before) > limit):
            return limit + 1
    return min(row[-1], limit + 1)
