"""Identifiers across releases: matching, classifying, alias closure and resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.stored import saved


def shared_cells(before: DataFrame, after: DataFrame, *cell: str) -> DataFrame:
    """Pairs of old and new identifiers that name the same cell and period."""
    o = before.select(*cell, F.col("sid").alias("old_id"))
    n = after.select(*cell, F.col("sid").alias("new_id"))
    return o.join(n, list(cell)).groupBy("old_id", "new_id").agg(F.count("*").alias("shared"))


def relations(pairs: DataFrame) -> DataFrame:
    """Identical, renamed, merged, split or both, from how many partners each side has."""
    s = pairs.groupBy("old_id").agg(F.countDistinct("new_id").alias("s"))
    p = pairs.groupBy("new_id").agg(F.countDistinct("old_id").alias("p"))
    kind = (
        F.when(F.col("old_id") == F.col("new_id"), "identical").when((F.col("s") > 1) & (F.col("p") > 1), "split_and_merged")
        .when(F.col("p") > 1, "merged").when(F.col("s") > 1, "split").otherwise("renamed")
    )
    return pairs.join(s, "old_id").join(p, "new_id").select("old_id", "new_id", "shared", kind.alias("relation"))


def migration(before: DataFrame, after: DataFrame, *cell: str) -> DataFrame:
    """Every identifier of either release once with its relation; those without a partner as dropped or new.

    Both releases are read once: one full join by cell is counted by pair and saved, with a null for the side that lacks a cell.
    """
    o, n = before.select(*cell, F.col("sid").alias("old_id")), after.select(*cell, F.col("sid").alias("new_id"))
    whole = saved(o.join(n, list(cell), "full_outer").groupBy("old_id", "new_id").agg(F.count("*").alias("shared")), "pairs")
    alone = lambda own, other: whole.filter(F.col(own).isNotNull()).groupBy(own).agg(F.count(other).alias("_k")).filter("_k = 0")
    zero = F.lit(0).cast("long").alias("shared")
    return (
        relations(whole.filter("old_id is not null and new_id is not null"))
        .unionByName(alone("old_id", "new_id").select("old_id", F.lit(None).cast("string").alias("new_id"), zero, F.lit("dropped").alias("relation")))
        .unionByName(alone("new_id", "old_id").select(F.lit(None).cast("string").alias("old_id"), "new_id", zero, F.lit("new").alias("relation")))
    )


def curated_pairs(before: DataFrame, after: DataFrame) -> DataFrame:
    """Pairs by normalised label and frequency, null-safe."""
    b = before.select(F.col("sid").alias("old_id"), F.col("label").alias("l"), F.col("frequency").alias("f"))
    a = after.select(F.col("sid").alias("new_id"), F.col("label").alias("m"), F.col("frequency").alias("g"))
    return b.join(a, (F.col("l") == F.col("m")) & F.col("f").eqNullSafe(F.col("g"))).select("old_id", "new_id")


def resolution(mapped: DataFrame) -> DataFrame:
    """For each old identifier its candidates, and one identifier only where there is just one."""
    by_old = mapped.filter("old_id is not null").groupBy("old_id").agg(F.countDistinct("new_id").alias("n_candidates"), F.array_sort(F.collect_set("new_id")).alias("candidates"))
    return by_old.select("old_id", "n_candidates", F.array_join("candidates", ";").alias("candidates"), F.when(F.col("n_candidates") == 1, F.element_at(F.col("candidates"), 1)).alias("resolved_id"))


def closure(aliases: DataFrame) -> DataFrame:
    """All (old_id, new_id) that steps of aliases reach. Ends when a round adds nothing; a cycle ends too.

    Each round joins what is reached with itself once and is written once, so the rounds follow the logarithm of the
    longest chain and no round reads more than one table.
    """
    reach = saved(aliases.select("old_id", "new_id").distinct(), "closure")
    size = reach.count()
    while True:
        on = reach.select(F.col("old_id").alias("_via"), F.col("new_id").alias("_to"))
        further = reach.join(on, F.col("new_id") == F.col("_via")).select("old_id", F.col("_to").alias("new_id"))
        longer = saved(reach.unionByName(further).distinct(), "closure")
        now = longer.count()
        if now == size:
            return longer
        reach, size = longer, now


def in_cycle(parents: DataFrame, child: str, parent: str, peels: int = 12) -> DataFrame:
    """identifiers that reach themselves through their parents.

    Links into or out of nothing are on no cycle: they are peeled off first, for up to ``peels`` rounds, and only what is
    left is closed. The number of peels changes the work, not the rows.
    """
    links = saved(parents.filter(F.col(parent).isNotNull()).select(F.col(child).alias("old_id"), F.col(parent).alias("new_id")).distinct(), "links")
    size = links.count()
    for _ in range(peels):
        goes_on = links.join(links.select(F.col("old_id").alias("new_id")), "new_id", "left_semi").join(links.select(F.col("new_id").alias("old_id")), "old_id", "left_semi")
        links = saved(goes_on.select("old_id", "new_id"), "links")
        now = links.count()
        if now == size:
            break
        size = now
    return closure(links).filter("old_id = new_id").select(F.col("old_id").alias(child))


def migration_job(before: DataFrame, after: DataFrame, *cell: str) -> tuple[DataFrame, DataFrame]:
    """The map from the identifiers of one store to those of another, saved once, with each old one's resolution; and
    its summary by relation."""
    mapped = saved(migration(before, after, *cell), "migration")
    whole = mapped.join(resolution(mapped).select("old_id", "resolved_id"), "old_id", "left")
    return whole, mapped.groupBy("relation").agg(F.count_distinct("old_id").alias("n_old"), F.count_distinct("new_id").alias("n_new"), F.sum("shared").cast("long").alias("shared_cells"))
