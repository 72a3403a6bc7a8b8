"""A stored index of the state over time: any point is read from one snapshot and its deltas.

Everything that holds for a while (an entry of the timetable, the best travel of a route,
an active or a waiting request) is a row with the ``seq`` it holds from and the one it
ends at.  The index cuts ``seq`` into blocks of ``every``: a block's folder has the rows
that begin in it (the deltas) and those that begin earlier and still hold at its start
(the snapshot).  A point is answered from its own block, so the cost of a question does not
grow with the history; the snapshots repeat long-lived rows once per block, so ``every``
weighs space against reading.

Building is one pass over the history: no step joins a route with itself, and rows are
written by the tasks that hold them, one folder per block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waycast import schemas as S
from waycast.operators import snapshots, timetable
from waycast.operators.chunks import GROUP, ROWS_PER_CHUNK, first_row_of_next_chunk
from waycast.operators.matching import History
from waycast.session import staged

COLUMNS = [*S.ROUTE, "item", "travel_id", "from_seq", "to_seq"]
SCHEMA = "state string, departure_location string, arrival_location string, item string, travel_id string, from_seq long, to_seq long, block long"


def _best(history: History) -> DataFrame:
    """The best travel of each route from a timetable event up to the next."""
    rows = history.timeline.select(*GROUP, "last_chunk", "seq", F.col("after.travel_id").alias("travel_id"), F.lit(True).alias("own"))
    if history.cut.is_cut:
        rows = rows.unionByName(first_row_of_next_chunk(history.cut.cut_only(rows), S.ROUTE, "seq"), allowMissingColumns=True)
    until = F.lead("seq").over(Window.partitionBy(*GROUP).orderBy("seq"))
    return history.cut.dealt(rows).withColumn("to_seq", until).filter("own and travel_id is not null").withColumnRenamed("seq", "from_seq")


def spans(history: History) -> DataFrame:
    """(state, route, item, travel_id, from_seq, to_seq): what holds from when to when; ``to_seq`` is null for what still does."""
    entries = timetable.intervals(history.cut).withColumnsRenamed({"update_id": "item", "valid_from": "from_seq", "valid_to": "to_seq"})
    lives = snapshots.request_lifetimes(history).withColumnRenamed("id", "item")
    waits = F.col("started_at").isNull() | (F.col("started_at") > F.col("seq"))
    early = lives.filter(waits).withColumns({"from_seq": F.col("seq"), "to_seq": F.least("started_at", "replaced_at")})
    active = lives.filter(F.col("started_at").isNotNull()).withColumns({"from_seq": F.col("started_at"), "to_seq": F.least("closed_at", "replaced_at")})
    parts = [("timetable", entries), ("best", _best(history)), ("early", early), ("active", active)]
    none = F.lit(None).cast("string")
    named = [
        frame.withColumns({c: none for c in ("item", "travel_id") if c not in frame.columns}).select(F.lit(name).alias("state"), *COLUMNS)
        for name, frame in parts
    ]
    return named[0].unionByName(named[1]).unionByName(named[2]).unionByName(named[3])


def build(history: History, path: str, every: int = 100_000) -> None:
    """Writes the index of ``history`` to the new folder ``path``, one folder per block of ``every`` numbers."""
    # computed once; the sort by block then runs apart from the sorts of the windows, in tasks of a bounded number of rows
    rows = staged(spans(history), "spans")
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // ROWS_PER_CHUNK)
    rows = rows.repartition(tasks, "state", "from_seq")
    newest = rows.agg(F.max(F.greatest("from_seq", F.coalesce("to_seq", "from_seq")))).first()[0]
    block = F.expr(f"from_seq div {every}")
    last = F.when(F.col("to_seq").isNull(), F.lit(newest)).otherwise(F.col("to_seq") - 1)
    blocks = F.explode(F.sequence(block, F.greatest(block, (last / every).cast("long"))))
    rows.withColumn("block", blocks).write.partitionBy("block").parquet(path)


def at(spark: SparkSession, path: str, points: list[int], every: int = 100_000) -> DataFrame:
    """(point, state, route, item, travel_id): timetable, active and waiting requests right after each of the ``points``.

    Only the folders of the points' blocks are read.  An active request has the travel
    that is the best of its route.
    """
    index = spark.read.schema(SCHEMA).parquet(path).filter(F.col("block").isin(sorted({p // every for p in points})))
    asked = spark.createDataFrame([(p, p // every) for p in sorted(set(points))], "point long, block long")
    holds: Column = (F.col("from_seq") <= F.col("point")) & (F.col("to_seq").isNull() | (F.col("to_seq") > F.col("point")))
    # a stated list of points: the small side by its making
    found = index.join(F.broadcast(asked), "block").filter(holds)
    best = found.filter("state = 'best'").select("point", *S.ROUTE, F.col("travel_id").alias("best"))
    rest = found.filter("state <> 'best'").join(best, ["point", *S.ROUTE], "left")
    travel = F.when(F.col("state") == "active", F.col("best")).otherwise(F.col("travel_id"))
    return rest.select("point", "state", *S.ROUTE, "item", travel.alias("travel_id"))
