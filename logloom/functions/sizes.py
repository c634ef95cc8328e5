"""Encoded size of logs and groups in bytes, the volume a store is metered by.

Every field costs one tag byte, the length of its length in 7-bit digits, and its bytes. The formulas
are nested over logs and contents, so they are put together as SQL text; arguments are names of
columns or SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digits(n: str) -> str:
    steps = " ".join(f"WHEN {n} < {1 << (7 * d)} THEN {d}" for d in range(1, 9))
    return f"(CASE {steps} ELSE 9 END)"


def _framed(length: str) -> str:
    return f"(1L + {_digits(length)} + {length})"


def _text(value: str) -> str:
    return _framed(f"octet_length({value})")


def _total(sizes: str) -> str:
    return f"aggregate({sizes}, 0L, (total, n) -> total + {_framed('n')})"


def _log(time: str, contents: str) -> str:
    content = f"{_text('c.key')} + {_text('c.value')}"
    return f"(1L + {_digits(time)} + {_total(f'transform({contents}, c -> {content})')})"


def varint_size(n: str) -> Column:
    """Number of 7-bit digits of a non-negative number, at least one."""
    return F.expr(_digits(n))


def log_size(time: str, contents: str) -> Column:
    """Size of one log."""
    return F.expr(_log(time, contents))


def group_size(logs: str, *texts: str) -> Column:
    """Size of a group: its logs plus every optional text that is set (empty counts, NULL does not)."""
    sizes = f"transform({logs}, l -> {_log('l.time', 'l.contents')})"
    return F.expr(" + ".join([_total(sizes), *[f"coalesce({_text(t)}, 0L)" for t in texts]]))


def list_size(group: str) -> Column:
    """What a group of that size adds to a list of groups."""
    return F.expr(_framed(group))
