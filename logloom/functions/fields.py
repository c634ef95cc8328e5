"""Reading contents by key, tokenising values and the predicates of a search."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from logloom.model import IndexKey, IndexLine

# A decimal number as a whole value. A cast alone would also take '1d', '2f' and 'NaN'.
_DECIMAL = r"\A\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"

_COMPARE = {
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    "=": lambda a, b: a == b,
}


def _array(contents: str | Column) -> Column:
    return F.col(contents) if isinstance(contents, str) else contents


def field(key: str | Column, contents: str | Column = "contents") -> Column:
    """Value of `key`; the last one wins, NULL when the key is absent.

    Plain array functions instead of a lambda keep the expression inside generated code.
    """
    contents = _array(contents)
    from_end = F.nullif(F.array_position(F.reverse(contents["key"]), key), F.lit(0))
    return F.try_element_at(contents["value"], (-from_end).cast("int"))


def field_map(contents: str | Column = "contents") -> Column:
    """Contents as a flat map, the last value of a repeated key winning."""
    contents = _array(contents)
    keys = F.array_distinct(contents["key"])
    return F.map_from_arrays(keys, F.transform(keys, lambda k: field(k, contents)))


def make_contents(pairs: Sequence[tuple[str, Column]]) -> Column:
    """Contents array from (key, value) pairs."""
    return F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in pairs])


def _plain(delimiters: Sequence[str]) -> bool:
    """All delimiters are single characters without case, so folding before splitting is the same."""
    return all(len(d) == 1 and d.lower() == d.upper() for d in delimiters)


def _delimiter_regex(delimiters: Sequence[str]) -> str:
    if all(len(d) == 1 for d in delimiters):
        return "[" + "".join(re.escape(d) for d in delimiters) + "]"
    # longest first, so that a delimiter that starts with another one is still found
    return "|".join(re.escape(d) for d in sorted(set(delimiters), key=len, reverse=True))


def tokens(value: Column, delimiters: Sequence[str], case_sensitive: bool = False) -> Column:
    """Non-empty tokens of a value; every delimiter is a literal, none means the whole value."""
    fold_first = not case_sensitive and _plain(delimiters)
    value = F.lower(value) if fold_first else value
    parts = F.split(value, _delimiter_regex(delimiters)) if delimiters else F.array(value)
    parts = F.array_remove(parts, "")
    return parts if case_sensitive or fold_first else F.transform(parts, lambda t: F.lower(t))


def has_token(value: Column, term: str, delimiters: Sequence[str], case_sensitive: bool = False) -> Column:
    """Whether some token of the value equals the term. False, never NULL."""
    wanted = term if case_sensitive else term.lower()
    folded = value if case_sensitive else F.lower(value)
    if not wanted:
        return F.lit(False)
    if not delimiters:
        return F.coalesce(folded == wanted, F.lit(False))
    # A byte search rejects most values before anything is split or matched.
    maybe = F.contains(folded, F.lit(wanted))
    if _plain(delimiters):
        if any(d in wanted for d in delimiters):
            return F.lit(False)
        # Tokens are the runs between one-character delimiters, so the bounded match is exact.
        edge = _delimiter_regex(delimiters)
        hit = folded.rlike(rf"(?:\A|{edge}){re.escape(wanted)}(?:{edge}|\z)")
    else:
        hit = F.array_contains(tokens(value, delimiters, case_sensitive), wanted)
    return F.coalesce(maybe & hit, F.lit(False))


def selected_contents(line: IndexLine, contents: str | Column = "contents") -> Column:
    """Contents that a line index covers."""
    contents = _array(contents)
    if line.include_keys:
        contents = F.filter(contents, lambda c: c["key"].isin(*line.include_keys))
    if line.exclude_keys:
        contents = F.filter(contents, lambda c: ~c["key"].isin(*line.exclude_keys))
    return contents


def line_tokens(line: IndexLine, contents: str | Column = "contents") -> Column:
    """Distinct tokens of one log under a line index."""
    none = F.array().cast("array<string>")
    per_value = F.transform(
        selected_contents(line, contents),
        lambda c: F.coalesce(tokens(c["value"], line.token, line.case_sensitive), none),
    )
    return F.array_distinct(F.flatten(per_value))


def term_match(term: str, line: IndexLine, contents: str | Column = "contents") -> Column:
    """Some token of the values under a line index equals the term."""
    return F.exists(
        selected_contents(line, contents),
        lambda c: has_token(c["value"], term, line.token, line.case_sensitive),
    )


def key_term_match(key: str, term: str, index_key: IndexKey, contents: str | Column = "contents") -> Column:
    """Some token of one key's value equals the term."""
    if index_key.type != "text":
        raise ValueError(f"key {key!r} is indexed as {index_key.type}, not as text")
    return has_token(field(key, contents), term, index_key.token, index_key.case_sensitive)


def typed(value: Column, key_type: str) -> Column:
    """A value as BIGINT or DOUBLE; NULL when it is not such a number."""
    if key_type == "long":
        return value.try_cast("bigint")
    if key_type == "double":
        return F.when(value.rlike(_DECIMAL), value.try_cast("double"))
    raise ValueError(f"{key_type!r} is not a numeric key type")


def compared(value: Column, op: str, number: int | float) -> Column:
    """A typed value against a number; NULL stays NULL."""
    if op not in _COMPARE:
        raise ValueError(f"operator must be one of {sorted(_COMPARE)}, got {op!r}")
    return _COMPARE[op](value, F.lit(number))


def key_compare(key: str, op: str, number: int | float, key_type: str = "long",
                contents: str | Column = "contents") -> Column:
    """Numeric comparison of one key's value; a value that is no number does not match."""
    return F.coalesce(compared(typed(field(key, contents), key_type), op, number), F.lit(False))
