"""DuckDB SQL snippets for the oracles (same fixed values as the Spark side)."""

from __future__ import annotations

from duelframe.functions.keys import (
    ASCII_PUNCTUATION, COUNTRY_ABBREVIATIONS, PLACE_FIXUPS, TRANSLIT_DROPPED, TRANSLIT_FROM,
    TRANSLIT_MULTI, TRANSLIT_TO,
)


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def translit(x: str) -> str:
    e = (f"regexp_replace(translate({x}, {lit(TRANSLIT_FROM)}, {lit(TRANSLIT_TO)}), "
         f"{lit(TRANSLIT_DROPPED)}, '', 'g')")
    for a, b in TRANSLIT_MULTI:
        e = f"replace({e}, {lit(a)}, {lit(b)})"
    return e


def normalize_name(x: str) -> str:
    return translit(strip_ws(f"lower(translate({x}, {lit(ASCII_PUNCTUATION)}, ''))"))


def word_pairs(relation: str, *cols: str) -> str:
    """Every two neighbouring words of ``text``: cols, pos (from 0), a, b."""
    keep = ", ".join(cols)
    return (f"(SELECT {keep}, CAST(i - 1 AS INTEGER) AS pos, w[i] AS a, w[i + 1] AS b FROM ("
            f"SELECT {keep}, w, unnest(range(1, len(w))) AS i FROM ("
            f"SELECT {keep}, string_split(text, ' ') AS w FROM {relation})))")


def sorted_words(x: str) -> str:
    return (f"array_to_string(list_sort(list_filter(string_split_regex({x}, '\\s+'), "
            f"lambda w: w <> '')), ' ')")


def pair_key(a: str, b: str) -> str:
    return f"array_to_string(list_sort([{sorted_words(a)}, {sorted_words(b)}]), ' ')"


def place_key(x: str) -> str:
    for a, b in PLACE_FIXUPS:
        x = f"(CASE WHEN {x} = {lit(a)} THEN {lit(b)} ELSE {x} END)"
    parts = f"string_split({x}, ',')"
    return f"concat_ws(', ', {translit(strip_ws(parts + '[1]'))}, {translit(strip_ws(parts + '[-1]'))})"


def expand_abbreviations(x: str) -> str:
    for a, b in COUNTRY_ABBREVIATIONS:
        x = f"replace({x}, {lit(a)}, {lit(b)})"
    return x


def lcs_length(a: str, b: str) -> str:
    return (f"(CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE list_reduce("
            f"range(1, length({a}) + 1), lambda prev, i: list_reduce(range(1, length({b}) + 1), "
            f"lambda cur, j: list_append(cur, CASE WHEN substr({a}, i, 1) = substr({b}, j, 1) "
            f"THEN prev[j] + 1 ELSE greatest(prev[j + 1], cur[-1]) END), [0]), "
            f"list_transform(range(length({b}) + 1), lambda z: 0))[-1] END)")


def indel_ratio(a: str, b: str) -> str:
    return (f"(CASE WHEN length({a}) + length({b}) = 0 THEN 1.0 ELSE "
            f"2.0 * {lcs_length(a, b)} / (length({a}) + length({b})) END)")
