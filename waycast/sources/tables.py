"""The four event streams, projected from the ``events`` table.

Views become train updates, clicks plane updates, signups requests and
purchases departures; other rows carry no travel event.  The projection is
plain column arithmetic, so filters and column pruning reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waycast import schemas as S
from waycast.functions import keys, times

# Which raw event plays which part.
KIND_OF = {
    "view": S.TRAIN,
    "click": S.PLANE,
    "signup": S.REQUEST,
    "purchase": S.DEPARTURE,
}

# How a row maps to a connection: 50 shared ones, one per user, one per user and
# day (many short-lived connections), or a single one.
ROUTES = {
    "shared": ("user_id % 25", "user_id % 25 + 1 + (user_id div 25) % 2"),
    "per_user": ("user_id", "user_id + 1"),
    "daily": ("user_id", "user_id * 100 + day(ts)"),
    "single": ("user_id % 1", "user_id % 1 + 1"),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def project_events(raw: DataFrame, routes: str = "shared", repeat_ids: bool = False, parse_once: bool = False) -> DataFrame:
    """Raw event rows, batch or streaming, as one tagged event frame.

    ``parse_once`` puts the number taken from the text behind a one-element explode:
    filters on what is derived from it stay above and see the value, however often they
    mention it.  Without it, queries that do not need the text do not read it.
    """
    departure, arrival = ROUTES[routes]
    kind = F.lit(None)
    for event_type, part in KIND_OF.items():
        kind = F.when(F.col("event_type") == event_type, part).otherwise(kind)
    parsed, k = F.get_json_object("props", "$.k").cast("int"), F.col("k")
    is_request = F.col("kind") == S.REQUEST

    def unless_request(column: Column) -> Column:
        return F.when(~is_request, column)

    travel_type = F.when(F.col("kind") != S.DEPARTURE, F.col("kind")).when(
        F.floor(k / 10) % 2 == 0, S.TRAIN
    ).otherwise(S.PLANE)
    departs = F.col("ts") + times.minutes(k)
    return (
        raw.filter(F.col("event_type").isin(*KIND_OF))
        .select(
            kind.alias("kind"),
            F.col("event_id").alias("seq"),
            "ts", "user_id", "value",
            F.concat(F.lit("S"), F.expr(departure)).alias("departure_location"),
            F.concat(F.lit("S"), F.expr(arrival)).alias("arrival_location"),
            F.explode(F.array(parsed)).alias("k") if parse_once else parsed.alias("k"),
        )
        .select(
            "kind", "seq", "ts",
            F.when(is_request & F.lit(repeat_ids), F.concat(F.lit("C"), F.col("user_id")))
            .when(is_request, F.concat(F.lit("R"), F.col("seq")))
            .when(F.col("kind") == S.DEPARTURE, F.concat(F.lit("D"), F.col("seq")))
            .otherwise(F.concat(F.lit("U"), F.col("seq"))).alias("id"),
            "departure_location", "arrival_location",
            unless_request(
                keys.travel_id("departure_location", "arrival_location", k % 4, travel_type)
            ).alias("travel_id"),
            unless_request(departs).alias("departure_time"),
            unless_request(
                times.hour_start(departs) + times.hours((F.floor("value") % 15 + 1).cast("int"))
            ).alias("arrival_time"),
        )
    )


def read_events(spark: SparkSession, sf_dir: str, routes: str = "shared", repeat_ids: bool = False, parse_once: bool = False) -> DataFrame:
    return project_events(read_table(spark, sf_dir, "events"), routes, repeat_ids, parse_once)


def requests(events: DataFrame) -> DataFrame:
    return events.filter(F.col("kind") == S.REQUEST).select(*S.REQUEST_SCHEMA.fieldNames())


def updates(events: DataFrame, kind: str) -> DataFrame:
    return (
        events.filter(F.col("kind") == kind)
        .withColumnRenamed("id", "update_id")
        .select(*S.UPDATE_SCHEMA.fieldNames())
    )


def departures(events: DataFrame) -> DataFrame:
    return (
        events.filter(F.col("kind") == S.DEPARTURE)
        .withColumnsRenamed({
            "departure_time": "effective_departure_time",
            "arrival_time": "expected_arrival_time",
        })
        .select(*S.DEPARTURE_SCHEMA.fieldNames())
    )
