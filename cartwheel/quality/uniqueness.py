"""Uniqueness of a key, kept up to date as files are added to a versioned table.

A full check shuffles all keys on every scan. Here each scan counts the keys of the files that are new since the last one, asks
the key filters of all other files which of them may hold one of these keys, and reads only those. The keys that occur more
than once are a small table of their own. The result is that of a full count; where files checked before are gone
(compacted, say) the count starts anew.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.versions import Draft, Store


@dataclass(frozen=True)
class Uniqueness:
    duplicates: int  # keys that occur more than once
    opened: list[str]  # older files read


def repeated_keys(store: Store, table: str) -> DataFrame:
    """(key, n) of the keys that the last ``scan_uniqueness`` found more than once."""
    return store.read(f"{table}_repeated")


def scan_uniqueness(store: Store, table: str, key: str) -> Uniqueness:
    """Bring the count of repeated keys of ``table`` up to date. Its files need key filters (``append(..., key=...)``)."""
    draft: Draft = store.draft()
    state = draft.base.tables[table]
    live = {f.path for f in state.files}
    checked_name, repeated_name = f"{table}_checked", f"{table}_repeated"
    checked = set()
    if checked_name in draft.base.tables:
        checked = {r["path"] for r in draft.read(checked_name).collect()}  # one row a file
    if not checked <= live:
        checked = set()
    new = [f for f in state.files if f.path not in checked]
    column = F.col(key).cast("string").alias("key")

    def counted(files) -> DataFrame:
        return store.open(state, files).where(F.col(key).isNotNull()).select(column)

    added = counted(new).groupBy("key").agg(F.count("*").alias("n")).checkpoint(eager=True)
    known = replace(state, files=tuple(f for f in state.files if f.path in checked))
    opened = draft.files_with(known, store.open(state, new), key) if checked and new else []
    total = added
    if opened:
        older = counted([f for f in known.files if f.path in opened]).join(added.select("key"), "key", "left_semi")
        older = older.groupBy("key").agg(F.count("*").alias("n"))
        total = added.union(older).groupBy("key").agg(F.sum("n").alias("n"))
    repeated = total.where("n > 1")
    if checked and repeated_name in draft.base.tables:
        repeated = repeated.union(draft.read(repeated_name).join(added.select("key"), "key", "left_anti"))
    repeated = repeated.checkpoint(eager=True)
    fresh = store.spark.createDataFrame([(p,) for p in sorted(live)], "path string")
    for name, rows in ((checked_name, fresh), (repeated_name, repeated)):
        held = draft.state(name, rows)
        draft.tables[name] = replace(held, files=tuple(draft.stage(name, rows, None)))
    draft.commit()
    return Uniqueness(repeated.count(), opened)
