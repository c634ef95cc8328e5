"""Entities by a feed of changes that is still being written.

What is known of a name is one row: its last position, and while it exists its times and attributes. Names are dealt to
`BUCKETS` buckets, and the state of a bucket is the table of its names, so that a batch costs Python one call per
bucket and not one per name. Each batch emits only what it has changed, so what is written grows with the changes, not
with the entities.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Groups of names; a stream keeps the number it was started with. A hundred million names are 24,000 per bucket.
BUCKETS = 4096
_STATE = "names binary"
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}
_COLUMNS = ["name", "change", "position", "create_time", "modify_time", "attributes"]
_HELD = ["last", "alive", "created", "modified", "attributes"]


def _pack(held: pd.DataFrame, name: pa.DataType) -> bytes:
    columns = {"name": pa.array(held.index, name), "last": pa.array(held["last"], pa.int64()), "alive": pa.array(held["alive"], pa.bool_()),
               "created": pa.array(held["created"], pa.int64()), "modified": pa.array(held["modified"], pa.int64()),
               "attributes": pa.array(held["attributes"], pa.string())}
    table, sink = pa.table(columns), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(state: GroupState) -> pd.DataFrame:
    """Rows of the names of a bucket, by name. Times of a name that does not exist are 0 and its attributes None."""
    if not state.exists:
        return pd.DataFrame({"last": pd.Series(dtype=np.int64), "alive": pd.Series(dtype=bool), "created": pd.Series(dtype=np.int64),
                             "modified": pd.Series(dtype=np.int64), "attributes": pd.Series(dtype=object)})
    return pa.ipc.open_stream(bytes(state.get[0])).read_all().to_pandas().set_index("name").astype({"attributes": object})


def _newest(changes: pd.DataFrame) -> pd.DataFrame:
    """The change of the highest position of each name, the first of several."""
    first = changes.sort_values("position", kind="stable", ascending=False).drop_duplicates("name")
    return first[["name", "position", "attributes"]]


def _emitted(names: pd.Series, change, position, created, modified, attributes, there) -> pd.DataFrame:
    """Rows of the result; times and attributes are NULL where a name is not `there`."""
    times = pd.array(created, dtype="Int64")
    times[~there] = pd.NA
    return pd.DataFrame({"name": names, "change": change, "position": position, "create_time": times, "modify_time": modified,
                         "attributes": attributes}, columns=_COLUMNS)


def _stepper(name: pa.DataType) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """What the changes of a bucket's names in a batch come to. Of attributes only the newest of a name are held."""
        held = _unpack(state)
        parts, newest = [], []
        for frame in frames:
            at = held.index.get_indexer(frame["name"])
            known = np.full(len(frame), -1, np.int64)
            known[at >= 0] = held["last"].to_numpy()[at[at >= 0]]
            is_late = frame["position"].to_numpy(np.int64) <= known
            if is_late.any():
                late = frame[is_late]
                none = np.zeros(len(late), np.int64)
                yield _emitted(late["name"].to_numpy(), "late", late["position"].to_numpy(), none, late["time"].to_numpy(),
                               late["attributes"].to_numpy(), np.zeros(len(late), bool))
            fresh = frame[~is_late]
            if len(fresh):
                parts.append(fresh[["name", "position", "time"]].assign(gone=(fresh["op"] == "delete").to_numpy()))
                newest = [_newest(pd.concat([*newest, fresh[["name", "position", "attributes"]]], ignore_index=True))]
        if not parts:
            return
        changes = pd.concat(parts, ignore_index=True).sort_values("position", kind="stable", ignore_index=True)
        code, names = pd.factorize(changes["name"])
        position, time, gone = changes["position"].to_numpy(np.int64), changes["time"].to_numpy(np.int64), changes["gone"].to_numpy(bool)
        n = len(names)
        # Rows ascend by position. Of the living ones, behind the last deletion, the first one tells when a name came.
        last_gone = np.full(n, -1, np.int64)
        np.maximum.at(last_gone, code[gone], position[gone])
        living = np.flatnonzero(position > last_gone[code])
        alive, created = np.zeros(n, bool), np.zeros(n, np.int64)
        alive[code[living]] = True
        created[code[living[::-1]]] = time[living[::-1]]
        last = np.full(n, -1, np.int64)
        np.maximum.at(last, code, position)
        modified = np.zeros(n, np.int64)
        top = np.flatnonzero(position == last[code])[::-1]
        modified[code[top]] = time[top]
        attributes = newest[0].set_index("name")["attributes"].reindex(names).to_numpy(object)
        at = held.index.get_indexer(names)
        old = held.iloc[at[at >= 0]]
        was = np.zeros(n, bool)
        was[at >= 0] = old["alive"].to_numpy(bool)
        stays = alive & was & (last_gone < 0)
        before = np.zeros(n, np.int64)
        before[at >= 0] = old["created"].to_numpy(np.int64)
        created = np.where(stays, before, created)
        attributes[~alive] = None
        now = pd.DataFrame({"last": last, "alive": alive, "created": np.where(alive, created, 0), "modified": np.where(alive, modified, 0),
                            "attributes": attributes}, index=pd.Index(names, name="name"))
        rest = held.drop(index=held.index[at[at >= 0]])
        state.update((_pack(pd.concat([rest, now]) if len(rest) else now, name),))
        told = alive | was
        if told.any():
            yield _emitted(np.asarray(names)[told], np.where(alive, "upsert", "delete")[told], last[told], created[told], modified[told],
                           attributes[told], alive[told])

    return step


def entity_changes(changes: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """What a stream of changes (name, op, time, position, attributes...) does to the entities of `entity_snapshot`: a row
    (name, change, position, create_time, modify_time, attributes...) for each name that a batch has changed.

    `change` is `upsert` or `delete`; an entity that comes and goes within one batch makes no row. `position` is a
    BIGINT from 0 that orders the feed. A name's changes come in that order from batch to batch, in any order
    within one; one that comes behind its successor alters nothing and is passed on as `late`, and so is one that is sent
    again. A deleted name leaves its position in the state, by which such changes are known. Changes without name,
    time or position are left out, others than `create`, `update` and `delete` count as updates.
    """
    fields = T.StructType([changes.schema[a] for a in attributes])
    rows = changes.filter("name is not null and time is not null and position >= 0").select(
        "name", F.coalesce("op", F.lit("update")).alias("op"), F.col("time").cast("bigint").alias("time"),
        F.col("position").cast("bigint").alias("position"), F.to_json(F.struct(*attributes), _JSON).alias("attributes"))
    out = T.StructType([rows.schema["name"]]).add("change", T.StringType()).add("position", T.LongType()).add(
        "create_time", T.LongType()).add("modify_time", T.LongType()).add("attributes", T.StringType())
    step = _stepper(to_arrow_type(rows.schema["name"].dataType))
    bucket = F.pmod(F.xxhash64("name"), F.lit(BUCKETS))
    stepped = rows.withColumn("bucket", bucket).groupBy("bucket").applyInPandasWithState(step, out, _STATE, "append", GroupStateTimeout.NoTimeout)
    held = F.from_json("attributes", fields, _JSON)
    return stepped.withColumn("_held", held).select(*_COLUMNS[:-1], *[F.col(f"_held.`{a}`").alias(a) for a in attributes])


def entities_of(emitted: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Entities that exist after the emitted changes, as `entity_snapshot` has them. A row that was written twice counts once."""
    values = ["change", "create_time", "modify_time", *attributes]
    latest = emitted.filter("change <> 'late'").groupBy("name").agg(F.max_by(F.struct(*values), "position").alias("v"))
    return latest.filter("v.change = 'upsert'").select("name", *[F.col(f"v.`{c}`").alias(c) for c in values[1:]])
