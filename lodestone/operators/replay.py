"""Replay of cheap stages: which stored parses are current, which can be brought up to date from where they differ, which must be made anew.

An engine is written `reader+stage.version+stage.version ...`, in order. A stored parse is current if its engine is today's. If the reader is the same and the first
difference lies in a stage that can be replayed, with everything behind it, only those stages run on its blocks. Anything else is parsed anew. A replay is one
batch of the stored table: it swaps the rows of the parses it brought up to date, and is honoured once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.sources.stored import StoredTable


def engine_of(reader: str, stages: list[tuple[str, str]]) -> str:
    return "+".join([reader, *[f"{n}.{v}" for n, v in stages]])


def first_difference(engine: Column, reader: str, stages: list[tuple[str, str]]) -> Column:
    """Number of the first stage (from 0) in which an engine differs from today's; -1 if none does, null if the reader differs or there are more stages than today's."""
    parts = F.split(engine, r"\+")
    at = F.lit(-1)
    for k in range(len(stages) - 1, -1, -1):
        name, version = stages[k]
        at = F.when(F.coalesce(F.get(parts, F.lit(k + 1)), F.lit("")) != f"{name}.{version}", k).otherwise(at)
    return F.when((F.get(parts, F.lit(0)) == reader) & (F.size(parts) <= len(stages) + 1), at)


def planned(parses: DataFrame, reader: str, stages: list[tuple[str, str]], cheap: set[str]) -> DataFrame:
    """parses (sha256, engine, status) with action (current, replay, reparse, none) and from_stage.

    Of several good parses of one text only one is acted on: a current one makes the others `none`; else the one that needs the fewest stages is replayed. Failed and skipped parses are left alone."""
    from pyspark.sql import Window as W

    first = first_difference(F.col("engine"), reader, stages)
    least = min([k for k in range(len(stages)) if all(n in cheap for n, _ in stages[k:])], default=len(stages))
    p = parses.withColumn("_d", F.when(F.col("status") == "ok", first))
    able = F.when(F.col("_d") == -1, len(stages)).when(F.col("_d") >= least, F.col("_d"))
    p = p.withColumn("_able", able)
    rank = F.row_number().over(W.partitionBy("sha256").orderBy(F.col("_able").desc_nulls_last(), F.desc("engine")))
    good = F.col("status") == "ok"
    action = F.when(~good, "none").when(rank > 1, "none").when(F.col("_able").isNull(), "reparse").when(F.col("_able") == len(stages), "current").otherwise("replay")
    out = p.withColumn("action", action).withColumn("from_stage", F.when(F.col("action") == "replay", F.col("_able")).cast("int"))
    return out.drop("_d", "_able")


def replay(table: StoredTable, reader: str, stages: list[tuple[str, str]], run: dict[str, Callable[[DataFrame], DataFrame]]) -> int:
    """Brings the stored parses (columns sha256, engine, status and what stages read and write) up to date; how many were replayed.

    run holds the stages that can be replayed: functions from rows to rows of the same columns. Each stage sees only the rows that need it."""
    goal = engine_of(reader, stages)
    plan = planned(table.read(), reader, stages, set(run))
    todo = plan.filter("action = 'replay'")
    n = todo.count()
    if not n:
        return 0

    def merge(old: DataFrame) -> DataFrame:
        marked = planned(old, reader, stages, set(run))
        rest, rows = marked.filter("action != 'replay'").select(*old.columns), marked.filter("action = 'replay'")
        for k, (name, _) in enumerate(stages):
            if name in run:
                ready = rows.filter(F.col("from_stage") <= k)
                done = run[name](ready.select(*old.columns)).withColumn("from_stage", F.lit(0)).withColumn("action", F.lit("replay"))
                rows = done.select(*rows.columns).unionByName(rows.filter(F.col("from_stage") > k))
        return rest.unionByName(rows.withColumn("engine", F.lit(goal)).select(*old.columns))

    return n if table.commit(f"replay {goal} of version {table.version()}", merge) else 0
