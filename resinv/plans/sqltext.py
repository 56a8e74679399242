"""Pieces of SQL that the twins of several queries share."""

from __future__ import annotations

from collections.abc import Iterable

from resinv.functions import fixed as X


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def some(expr: str, words: Iterable[str]) -> str:
    return "(" + " OR ".join(f"contains({expr}, {q(w)})" for w in words) + ")"


def ends(expr: str, words: Iterable[str]) -> str:
    return "(" + " OR ".join(f"suffix({expr}, {q(w)})" for w in words) + ")"


def matched(expr: str, patterns: Iterable[str], ignore_case: bool = True) -> str:
    flag = "(?i)" if ignore_case else ""
    return f"regexp_matches({expr}, {q(flag + '|'.join(f'(?:{p})' for p in patterns))})"


def weighed(expr: str, weights: dict[str, int]) -> str:
    return "(" + " + ".join(f"CASE WHEN contains({expr}, {q(w.lower())}) THEN {n} ELSE 0 END" for w, n in weights.items()) + ")"


def counted(expr: str, words: Iterable[str]) -> str:
    return weighed(expr, dict.fromkeys(words, 1))


def inlist(expr: str, words: Iterable[str]) -> str:
    return f"{expr} IN ({', '.join(q(w) for w in words)})"


# one row per paper: the first harvested of each non-blank id
PAPERS = """papers AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY harvested_at, title, abstract) AS rn
    FROM papers_metadata WHERE trim(coalesce(id, '')) <> '') WHERE rn = 1)"""

# one row per scanned paper
SCANS = """scans AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY pmid ORDER BY scanned_at DESC NULLS LAST, url_scanner_score DESC NULLS LAST, resource_url NULLS FIRST) AS rn
    FROM papers_with_scanner_scores) WHERE rn = 1)"""

# the parts of the URL u of a table
NORMAL_STRICT = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim({u})),
  '^https?://', ''), '^ftp://', ''), '^www\.', ''), '/+$', ''), '/index\.(html?|php|asp)$', ''), ':80($|/)', '\1')"""


def normal_strict(u: str) -> str:
    return NORMAL_STRICT.format(u=u)


def host(u: str) -> str:
    return rf"lower(regexp_extract(trim({u}), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"


def with_scheme(u: str) -> str:
    return f"CASE WHEN trim({u}) = '' THEN '' WHEN regexp_matches(trim({u}), '^(https?|ftp)://') THEN trim({u}) ELSE 'http://' || trim({u}) END"


def modifier(title: str) -> str:
    t = f"lower(coalesce({title}, ''))"
    return f"CASE WHEN {t} = '' THEN 0 WHEN {some(t, X.DATA_RESOURCE_WORDS)} THEN 1 WHEN {matched(t, X.METHODOLOGY_PATTERNS, False)} THEN -1 ELSE 0 END"


def profile(name: str, title: str, score: str, setfit: str, url: str) -> str:
    p = X.PROFILES[name]
    url_ok = f"coalesce(lower(trim(CAST({url} AS VARCHAR))) IN ('true', '1', 'yes'), false)" if p["require_url"] else "true"
    keyword = some(f"lower(coalesce({title}, ''))", p["keywords"])
    return (
        f"CASE WHEN {score} IS NOT NULL AND {score} + ({modifier(title)}) >= {p['bypass']} THEN {url_ok} "
        f"ELSE ({keyword} AND ({setfit} IS NULL OR {setfit} >= CAST({p['setfit']} AS DOUBLE)) AND {url_ok}) END"
    )
