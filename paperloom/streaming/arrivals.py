"""First arrivals across micro-batches.

A paper that lands again in a later batch keeps the attributes of its first arrival and gains the later sources.  What is known of
an id is keyed state of the stream: its first arrival, its attributes as JSON, and its set of source names.  An id that has not landed for
``keep`` is forgotten, as the watermark over landing times passes it, so state holds what landed within that time and
not the whole history.  An id that comes back later starts anew.

Calling Python costs far more than merging a row, so ids are dealt by hash into groups and a call merges all of a group:
a batch has at most so many calls, however many ids land.  A batch writes the groups anew that it touches; a group goes when the last of its ids
is forgotten, and drops others as it is touched.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from paperloom import schemas

LANDED = "landed_at"
#: Groups that ids are dealt into.
GROUPS = 1 << 13
_ORDER = ["landed", *schemas.ARRIVAL_COLUMNS]
_STATE = "ids string"
_OUT = "paper_id string, paper string, sources array<string>"


def _merge(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """State is a list of (id, until, first arrival, sources): an id whose ``until`` the watermark has passed is forgotten."""
    if state.hasTimedOut:
        state.remove()
        return
    passed = state.getCurrentWatermarkMs()
    kept = json.loads(state.get[0]) if state.exists else []
    known = {paper: (until, tuple(first), names) for paper, until, first, names in kept if until >= passed}
    landed: dict[str | None, list] = {}
    for part in parts:
        for row in map(json.loads, part["row"]):
            here = (*(int(row[c]) for c in _ORDER), row["paper"])
            seen = landed.setdefault(row["paper_id"], [here[0], here, set()])
            seen[0], seen[1] = max(seen[0], here[0]), min(seen[1], here)
            seen[2].update(row["sources"])
    for paper, (newest, first, sources) in landed.items():
        if paper in known:
            first, sources = min(known[paper][1], first), sources.union(known[paper][2])
        known[paper] = (max(newest // 1000, passed + 1), first, sorted(sources))
    state.update((json.dumps([(paper, *rest) for paper, rest in known.items()]),))
    state.setTimeoutTimestamp(max(until for until, *_ in known.values()))
    now = [(paper, known[paper]) for paper in landed]
    yield pd.DataFrame(
        {"paper_id": [paper for paper, _ in now], "paper": [x[1][-1] for _, x in now], "sources": [x[2] for _, x in now]}
    )


def first_arrivals(candidates: DataFrame, keep: str = "30 days", groups: int = GROUPS) -> DataFrame:
    """A stream of papers, each with all sources known by then, once per batch in which it landed.

    ``candidates`` is a stream with ``landed_at`` (timestamp), the arrival columns, ``paper_id``, ``sources`` and the
    attributes.  The first arrival is the one that landed first, then by the arrival columns.  Rows that
    landed more than ``keep`` before the newest ones are late and left out.  To be written in update mode.
    ``groups`` belongs to a checkpoint like ``keep``: more of them cost more calls and write less state anew.
    """
    rest = [c for c in candidates.columns if c not in {"paper_id", "sources", LANDED, *schemas.ARRIVAL_COLUMNS}]
    kept = T.StructType([candidates.schema[c] for c in rest])
    every = {"ignoreNullFields": "false"}
    row = F.struct(
        "paper_id",
        F.unix_micros(LANDED).alias("landed"),
        *schemas.ARRIVAL_COLUMNS,
        F.to_json(F.struct(*rest), every).alias("paper"),
        "sources",
    )
    group = F.pmod(F.xxhash64("paper_id"), F.lit(groups)).cast("int").alias("group")
    rows = candidates.withWatermark(LANDED, keep).select(group, LANDED, F.to_json(row, every).alias("row"))
    merged = rows.groupBy("group").applyInPandasWithState(
        _merge, _OUT, _STATE, "update", GroupStateTimeout.EventTimeTimeout
    )
    return merged.select("paper_id", F.from_json("paper", kept).alias("_paper"), "sources").select(
        "paper_id", "_paper.*", "sources"
    )
