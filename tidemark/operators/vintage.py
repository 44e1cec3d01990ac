"""The vintage store: sparse change and removal events, latest, as-of, revisions, catalogue and release decisions.

Snapshots are (series_id, period, vintage_id, publication_date, value); events add is_deleted. A release filter always
runs before ranking, tombstones leave after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.periods import bounds

KEY = ("series_id", "period")
TOLERANCE = 1e-12


def newest_first() -> list[Column]:
    return [F.col("publication_date").desc_nulls_last(), F.col("vintage_id").desc()]


def _statements(snapshots: DataFrame, vintages: DataFrame) -> DataFrame:
    """What each vintage states of a key against the vintage just before it: the rows that exist, and after a row that the
    next vintage lacks a removal in that vintage. One shuffle by key; absent rows are told by the vintages' numbers."""
    in_order = Window.orderBy("vintage_id")
    numbered = vintages.select("vintage_id", "publication_date", F.row_number().over(in_order).alias("_nth"), F.lead(F.struct("vintage_id", "publication_date")).over(in_order).alias("_next"))
    rows = snapshots.filter("value is not null").select(*KEY, "vintage_id", "value").join(numbered, "vintage_id")
    by_key = Window.partitionBy(*KEY).orderBy("_nth")
    before = F.lag(F.struct("_nth", "value", "vintage_id")).over(by_key)
    placed = rows.withColumn("_before", F.when(before["_nth"] == F.col("_nth") - 1, before)).withColumn("_after", F.lead("_nth").over(by_key))
    own = F.struct("vintage_id", "publication_date", "value", F.col("_before.value").alias("previous"), F.col("_before.vintage_id").alias("previous_vintage"))
    gone = F.struct(F.col("_next.vintage_id").alias("vintage_id"), F.col("_next.publication_date").alias("publication_date"), F.lit(None).cast("double").alias("value"), F.col("value").alias("previous"), F.col("vintage_id").alias("previous_vintage"))
    lost = F.col("_next").isNotNull() & (F.col("_after").isNull() | (F.col("_after") > F.col("_nth") + 1))
    return placed.select(*KEY, F.explode(F.when(lost, F.array(own, gone)).otherwise(F.array(own))).alias("_s")).select(*KEY, "_s.*")


def sparse_events(snapshots: DataFrame, vintages: DataFrame) -> DataFrame:
    """J01 over a whole history of full snapshots: first values, changes beyond the tolerance, removals."""
    same = F.col("value").isNotNull() & F.col("previous").isNotNull() & (F.abs(F.col("value") - F.col("previous")) <= TOLERANCE)
    return _statements(snapshots, vintages).filter(~same).select(*KEY, "vintage_id", "publication_date", "value", F.col("value").isNull().alias("is_deleted"))


def incremental_events(latest_all: DataFrame, snapshot: DataFrame) -> DataFrame:
    """J01 for one new vintage against the latest values of every loaded vintage, accepted or not."""
    old = latest_all.select(*KEY, F.col("value").alias("old"))
    new = snapshot.join(old, [*KEY], "left").filter(F.col("old").isNull() | (F.abs(F.col("value") - F.col("old")) > TOLERANCE))
    vintage = snapshot.select("vintage_id", "publication_date").distinct()
    gone = old.join(snapshot, [*KEY], "left_anti").crossJoin(F.broadcast(vintage)).select(*KEY, "vintage_id", "publication_date", F.lit(None).cast("double").alias("value"))
    return new.select(*KEY, "vintage_id", "publication_date", "value").unionByName(gone).withColumn("is_deleted", F.col("value").isNull())


def revisions(snapshots: DataFrame, vintages: DataFrame) -> DataFrame:
    """Values that a later vintage changed or removed."""
    moved = F.col("previous").isNotNull() & (F.col("value").isNull() | (F.abs(F.col("value") - F.col("previous")) > TOLERANCE))
    return _statements(snapshots, vintages).filter(moved).select(
        *KEY, F.col("previous_vintage"), F.col("vintage_id").alias("new_vintage"), F.col("previous").alias("previous_value"), F.col("value").alias("new_value"),
        F.abs(F.col("value") - F.col("previous")).alias("absolute_revision"), F.when(F.col("value").isNull(), "removed").otherwise("changed").alias("kind"),
    )


def latest(events: DataFrame, accepted: DataFrame | None = None) -> DataFrame:
    """The newest publication's statement for each key over the accepted vintages (all where none are named)."""
    rows = events.join(F.broadcast(accepted.select("vintage_id")), "vintage_id", "left_semi") if accepted is not None else events
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*KEY).orderBy(*newest_first())))
    after = F.col("publication_date").isNotNull() & (F.col("period") > F.col("publication_date"))
    return ranked.filter((F.col("_rank") == 1) & ~F.col("is_deleted")).select(*KEY, "value", "vintage_id", "publication_date", F.when(after, "after_publication").otherwise("observed").alias("observation_status"))


def realised(statement: DataFrame) -> DataFrame:
    """J05."""
    return statement.filter("observation_status = 'observed'")


def projections(statement: DataFrame) -> DataFrame:
    """J06."""
    return statement.filter("observation_status = 'after_publication'")


def as_of(events: DataFrame, ever_accepted: DataFrame, day, statement: bool = False) -> DataFrame:
    """What was known on a day, over every vintage that was ever accepted; available_at decides, and what was a
    projection when it was published is left out, both before ranking (statement: projections stay)."""
    after = F.col("publication_date").isNotNull() & (F.col("period") > F.col("publication_date"))
    rows = events.join(F.broadcast(ever_accepted.select("vintage_id", "available_at")), "vintage_id").filter(F.col("available_at") <= F.lit(day).cast("date"))
    rows = rows.withColumn("observation_status", F.when(after, "after_publication").otherwise("observed"))
    rows = rows if statement else rows.filter("observation_status = 'observed'")
    order = [F.col("available_at").desc(), *newest_first()]
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*KEY).orderBy(*order))).filter((F.col("_rank") == 1) & ~F.col("is_deleted"))
    return ranked.select(*KEY, "value", "vintage_id", "available_at", "observation_status")


def catalogue(rows: DataFrame) -> DataFrame:
    """Coverage of each series."""
    return rows.groupBy("series_id").agg(F.count("*").alias("n_observations"), F.min("period").alias("first_period"), F.max("period").alias("last_period"), F.max("publication_date").alias("last_publication"))


def observations(rows: DataFrame, series: DataFrame, dates: DataFrame) -> DataFrame:
    """Period bounds, value in base units (null where the scale is unknown), availability."""
    begins, ends = bounds(F.col("period"), F.col("frequency"))
    return (
        rows.join(series, "series_id")
        .join(F.broadcast(dates), "vintage_id", "left")
        .select("series_id", "period", "vintage_id", "value", begins.alias("period_start"), ends.alias("period_end"), (F.col("value") * F.col("scale_multiplier")).alias("value_in_base_units"), "available_at")
    )


def availability(vintages: DataFrame, provenance: DataFrame) -> DataFrame:
    """Provenance date, else publication date, else first ingestion."""
    known = vintages.join(F.broadcast(provenance), "vintage_id", "left")
    at = F.coalesce("provenance_date", "publication_date", "ingested_on")
    status = F.when(F.col("provenance_date").isNotNull(), "complete").when(F.col("publication_date").isNotNull(), "published_only").otherwise("ingestion_only")
    return known.select("vintage_id", at.alias("available_at"), status.alias("completeness"))


def publication_dates(candidates: DataFrame) -> DataFrame:
    """The candidate of the highest authority (registry 3, file name 2, content 1), the latest of equals."""
    return candidates.filter("candidate is not null").groupBy("vintage_id").agg(
        F.max_by("candidate", F.struct("authority", "candidate")).alias("publication_date"), F.max("authority").alias("authority")
    )


def admitting_release(links: DataFrame, decisions: DataFrame) -> DataFrame:
    """The first accepted release that holds each vintage."""
    accepted = links.join(F.broadcast(decisions.filter("decision = 'accepted'")), "release_id")
    return accepted.groupBy("vintage_id").agg(F.min_by("release_id", F.struct("decided_at", "release_id")).alias("release_id"), F.min("decided_at").alias("admitted_at"))


def decide(flags: DataFrame, releases: DataFrame, decided: DataFrame | None = None) -> DataFrame:
    """A release with an error is blocked; releases decided before keep their decision."""
    errors = flags.groupBy("release_id").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    fresh = releases if decided is None else releases.join(decided, "release_id", "left_anti")
    counted = fresh.join(errors, "release_id", "left").na.fill(0, ["errors", "warnings"])
    return counted.withColumn("decision", F.when(F.col("errors") > 0, "blocked").otherwise("accepted"))


def promoted(decisions: DataFrame) -> DataFrame:
    """Decisions with the one that the active pointer names, the last accepted one; a blocked release never moves it."""
    pointer = decisions.filter("decision = 'accepted'").agg(F.max_by("release_id", F.struct("decided_at", "release_id")).alias("_active"))
    return decisions.join(pointer, F.col("release_id") == F.col("_active"), "left").select(*decisions.columns, F.col("_active").isNotNull().alias("is_active"))


def registered(series: DataFrame, found: DataFrame, defaults: dict[str, str]) -> DataFrame:
    """The series dimension with the series that it lacks, their unnamed fields at the defaults; known rows stay as they are."""
    fresh = found.select("series_id").distinct().join(series, "series_id", "left_anti")
    filled = [F.lit(defaults.get(c)).cast(series.schema[c].dataType).alias(c) for c in series.columns if c != "series_id"]
    return series.unionByName(fresh.select("series_id", *filled))


def append_new(stored: DataFrame, snapshot: DataFrame) -> DataFrame:
    """The rows of vintages that aren't stored yet."""
    return snapshot.join(F.broadcast(stored.select("vintage_id").distinct()), "vintage_id", "left_anti")


def surrogate_keys(known: DataFrame, ids: DataFrame) -> DataFrame:
    """Known keys stay, new ids follow the largest. Numbers within a range of ids, so no single task sees every id."""
    fresh = ids.select("series_id").distinct().join(known, "series_id", "left_anti")
    top = known.agg(F.coalesce(F.max("series_sk"), F.lit(0)).alias("top"))
    placed = fresh.withColumn("_b", F.substring(F.md5("series_id"), 1, 2))
    sizes = placed.groupBy("_b").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    number = F.row_number().over(Window.partitionBy("_b").orderBy("series_id"))
    new = placed.join(F.broadcast(before), "_b").crossJoin(F.broadcast(top)).select("series_id", (F.col("top") + F.col("_before") + number).cast("long").alias("series_sk"))
    return known.select("series_id", F.col("series_sk").cast("long").alias("series_sk")).unionByName(new)
