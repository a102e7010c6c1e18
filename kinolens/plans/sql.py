"""Building blocks of the SQL twins, written for DuckDB.

Each block states a definition on its own terms; nothing here is used by the
Spark side. What both sides share are fixed values: label names and stop words,
and the suffix tables of the stemmer, which ``tests/test_functions.py`` holds
against published examples.
"""

from __future__ import annotations

from kinolens.functions.porter import STEP_2, STEP_3, STEP_4
from kinolens.labels import COMMON_TOP, ENGLISH_STOP_WORDS, LABELS_14, LABELS_18, STOP_PUNCTUATION


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def values(labels) -> str:
    return ", ".join(f"({i}, '{x}')" for i, x in enumerate(labels))


LABELS = f"label_names(pos, label) AS (VALUES {values(LABELS_14)})"
LABELS_FULL = f"label_names(pos, label) AS (VALUES {values(LABELS_18)})"
STOPS = f"({quoted(ENGLISH_STOP_WORDS + STOP_PUNCTUATION)})"
#: Words that the plain word list drops; punctuation stays there.
STOP_WORDS = f"({quoted(ENGLISH_STOP_WORDS)})"

FILMS = f"""
{LABELS},
films AS (
  SELECT title_url,
         list_transform(range(14), lambda j: CASE WHEN (k*7 + 3*j + (k*j)%3) % 4 = 0 THEN 1 ELSE 0 END) AS genre_vec
  FROM (SELECT DISTINCT source AS title_url, CAST(substr(source, 4) AS INT) AS k FROM documents)
),
film_labels AS (
  SELECT title_url, pos, label FROM films, label_names WHERE genre_vec[pos + 1] = 1
)"""

REVIEW_SCORES = (
    FILMS
    + """,
scores AS (
  SELECT id, label, actual, CASE WHEN actual = 1 THEN h ELSE h / 2 END AS p
  FROM (
    SELECT d.doc_id AS id, n.label, f.genre_vec[n.pos + 1] AS actual,
           CAST(('0x' || substr(md5(d.doc_id || n.label), 1, 4)) AS BIGINT) / 65535 AS h
    FROM documents d JOIN films f ON f.title_url = d.source, label_names n
  )
)"""
)


def cleaned(expr: str, ascii_only: bool = False) -> str:
    """Text with spaced symbols, before numbers are folded."""
    if ascii_only:
        expr = rf"regexp_replace({expr}, '[^\x00-\x7F]', ' ', 'g')"
    return rf"regexp_replace(regexp_replace(lower({expr}), '[''\-]', '', 'g'), '([^\pL\pN_]+)', ' \1 ', 'g')"


def fold(word: str) -> str:
    return rf"CASE WHEN regexp_full_match({word}, '\d+|\w\d+|\d+\w') THEN '000' ELSE {word} END"


def clean_list(expr: str, ascii_only: bool = False, space: str | None = None) -> str:
    """List of cleaned words."""
    space = space or (r"\s+" if ascii_only else r"[\s\pZ]+")
    words = f"list_filter(regexp_split_to_array({cleaned(expr, ascii_only)}, '{space}'), lambda w: w <> '')"
    return f"list_transform({words}, lambda w: {fold('w')})"


def letters_list(expr: str) -> str:
    return (
        f"list_filter(string_split(lower(regexp_replace({expr}, '[^a-zA-Z]', ' ', 'g')), ' '), lambda w: w <> '')"
    )


def words_of(name: str, table: str, keys: str, words: str) -> str:
    """CTE with one row per word."""
    return f"{name} AS (SELECT {keys}, unnest({words}) AS word FROM {table})"


ASCII_TOKENS = words_of("tokens", "documents", "doc_id, source", clean_list("text", ascii_only=True))

LABEL_WORDS = (
    FILMS
    + ",\n"
    + ASCII_TOKENS
    + f""",
label_words AS (
  SELECT l.label, t.word, count(*) AS n
  FROM tokens t JOIN film_labels l ON l.title_url = t.source
  WHERE t.word NOT IN {STOPS}
  GROUP BY ALL
)"""
)

RANKED = (
    LABEL_WORDS
    + """,
ranked AS (
  SELECT label, word, n, row_number() OVER (PARTITION BY label ORDER BY n DESC, word) AS rank FROM label_words
)"""
)

#: The dictionaries without the words common to all labels, ranked anew.
SECOND = (
    RANKED
    + f""",
common AS (SELECT word FROM ranked WHERE rank <= {COMMON_TOP} GROUP BY word HAVING count(*) = {len(LABELS_14)}),
second AS (
  SELECT label, word, n, row_number() OVER (PARTITION BY label ORDER BY n DESC, word) AS rank
  FROM label_words WHERE word NOT IN (SELECT word FROM common)
)"""
)

SENTENCES = r"""
list_filter(string_split(regexp_replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), '([.!?])\s+', '\1' || chr(1), 'g'),
            chr(1)), lambda s: s <> '')"""


def stripped(expr: str) -> str:
    """Markup removed, entities decoded (those that the tables use)."""
    bare = (
        rf"regexp_replace(regexp_replace(regexp_replace({expr},"
        r" '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g'),"
        r" '(?s)<!--.*?-->', '', 'g'), '(?s)<[!/a-zA-Z][^>]*>', '', 'g')"
    )
    for name, char in [("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")]:
        bare = f"replace({bare}, '&{name};', '{char}')"
    return bare


# ---- the suffix stripper on a table of words ----

_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_M0 = f"^({_C})?{_V}{_C}"
_M1 = f"^({_C})?{_V}{_C}({_V})?$"
_MM = f"^({_C})?{_V}{_C}{_V}{_C}"
_HASV = f"^({_C})?[aeiouy]"
_CVC = f"^{_C}[aeiouy][^aeiouwxy]$"


def _like(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, '{pattern}')"


def _cut(x: str, k: int) -> str:
    return f"left({x}, length({x}) - {k})"


def _rules(rules, measure: str) -> str:
    whens = []
    for suffix, new in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        k = 3 if suffix in ("sion", "tion") else len(suffix)
        stem = _cut("w", k)
        whens.append(
            f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN {_like(stem, measure)} THEN {stem} || '{new}' ELSE w END"
        )
    return "CASE " + " ".join(whens) + " ELSE w END"


def stem_ctes(source: str) -> str:
    """CTEs ``stems(word, stem)`` for the words of ``source(word)``."""
    steps = [
        f"""CASE WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN {_cut('w', 2)}
                 WHEN ends_with(w, 'ss') THEN w WHEN ends_with(w, 's') THEN {_cut('w', 1)} ELSE w END""",
        f"""CASE WHEN ends_with(w, 'eed') THEN CASE WHEN {_like(_cut('w', 3), _M0)} THEN {_cut('w', 1)} ELSE w END
                 WHEN ends_with(w, 'ed')
                   THEN CASE WHEN {_like(_cut('w', 2), _HASV)} THEN {_cut('w', 2)} || '+' ELSE w END
                 WHEN ends_with(w, 'ing')
                   THEN CASE WHEN {_like(_cut('w', 3), _HASV)} THEN {_cut('w', 3)} || '+' ELSE w END
                 ELSE w END""",
        f"""CASE WHEN NOT ends_with(w, '+') THEN w
                 WHEN {_like('w', '(at|bl|iz)[+]$')} THEN {_cut('w', 1)} || 'e'
                 WHEN length(w) > 2 AND w[-2] = w[-3] AND {_like('w', '[^aeiouylsz][+]$')} THEN {_cut('w', 2)}
                 WHEN {_like(_cut('w', 1), _CVC)} THEN {_cut('w', 1)} || 'e' ELSE {_cut('w', 1)} END""",
        f"CASE WHEN ends_with(w, 'y') AND {_like(_cut('w', 1), _HASV)} THEN {_cut('w', 1)} || 'i' ELSE w END",
        _rules(STEP_2, _M0),
        _rules(STEP_3, _M0),
        _rules([(s, "") for s in STEP_4], _MM),
        f"""CASE WHEN ends_with(w, 'e') AND ({_like(_cut('w', 1), _MM)}
                   OR ({_like(_cut('w', 1), _M1)} AND NOT {_like(_cut('w', 1), _CVC)}))
                 THEN {_cut('w', 1)} ELSE w END""",
        f"CASE WHEN ends_with(w, 'll') AND {_like('w', _MM)} THEN {_cut('w', 1)} ELSE w END",
    ]
    ctes = [f"step0 AS (SELECT DISTINCT word, word AS w FROM {source})"]
    for i, body in enumerate(steps):
        ctes.append(f"step{i + 1} AS (SELECT word, {body} AS w FROM step{i})")
    ctes.append(
        f"stems AS (SELECT word, CASE WHEN length(word) > 2 THEN w ELSE word END AS stem FROM step{len(steps)})"
    )
    return ",\n".join(ctes)


def mean_of(score: str, weight: str = "1") -> str:
    """Weighted mean from whole billionths, not rounded."""
    total = f"sum(CAST(round({score} * 1000000000) AS BIGINT) * {weight})"
    return f"({total} / (sum({weight}) * 1000000000))"
