"""Cursors: sortable positions of groups within a shard, in the order in which groups arrive.

A cursor is the second at which the group arrived, zero padded, and a fixed-width key of the group. In a store that
numbers its puts (`sources.puts`) the key starts with the put's number. What arrives later sorts later, whatever the
times of its logs, so a reader that goes on behind the last cursor it has seen misses nothing. A position need not
be the cursor of a group.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Position before all groups.
FIRST = ""
# Fixed value: sorts after every character of a cursor.
_LAST = "~"
_SECOND_WIDTH = 10
_PUT_WIDTH, _KEY_WIDTH = 8, 32


def make_cursor(arrival: Column, identity: Column) -> Column:
    """Cursor of a group from the second of its arrival and a value only this group has."""
    return F.concat(F.lpad(arrival.cast("bigint").cast("string"), _SECOND_WIDTH, "0"), F.lit("-"), F.md5(identity))


def of_put(arrival: int, number: int, identity: Column) -> Column:
    """Cursor of a group of a numbered put, from a value only this group has in it."""
    return F.concat(F.lit(put_position(arrival, number)), F.substring(F.md5(identity), 1, _KEY_WIDTH - _PUT_WIDTH))


def put_position(arrival: int, number: int) -> str:
    """Position before all groups of a numbered put, and behind those of the puts before it."""
    return f"{arrival:0{_SECOND_WIDTH}d}-{number:0{_PUT_WIDTH}x}"


def put_of(cursor: Column) -> Column:
    """Number of the put in a cursor, as its hex digits."""
    return F.substring(cursor, _SECOND_WIDTH + 2, _PUT_WIDTH)


def part_of(cursor: Column, part: Column) -> Column:
    """Cursor of a part that is cut off a group: the same arrival and begin of the key, a rest of its own."""
    kept = _SECOND_WIDTH + 1 + _PUT_WIDTH
    return F.concat(F.substring(cursor, 1, kept), F.substring(F.md5(F.concat_ws("/", cursor, part)), 1, _KEY_WIDTH - _PUT_WIDTH))


def cursor_at(time: int) -> str:
    """Position before all groups that arrive in that second or later."""
    return f"{time:010d}-"


def after(cursor: Column) -> Column:
    """Smallest position behind a cursor; cursors share one width, so nothing lies between."""
    return F.concat(cursor, F.lit(_LAST))
