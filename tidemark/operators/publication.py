"""Published shapes: coordinates, snapshots in force, comparability, store comparison, substring resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def coordinates(cells: DataFrame, offsets: DataFrame) -> DataFrame:
    """Rows and columns of a cropped sheet as A1 references; a sheet without an offset starts at A1."""
    placed = cells.join(offsets, "source_sheet", "left")
    row = F.coalesce("first_row", F.lit(1)) - 1 + F.col("row_id")
    column = F.coalesce("first_column", F.lit(1)) - 1 + F.col("column_id")
    # Letters count without a zero, so each place takes one off before it is divided; a sheet has columns up to XFD.
    second = F.floor((column - 1) / 26)
    third = F.floor((second - 1) / 26)
    letter = lambda place: F.when(place > 0, F.char(65 + (place - 1) % 26)).otherwise("")
    letters = F.concat(letter(third), letter(second), letter(column))
    return placed.select("source_sheet", "row_id", "column_id", F.concat(letters, row.cast("string")).alias("a1"))


def inventory(links: DataFrame, values: DataFrame) -> DataFrame:
    """Every vintage's cells from sheet versions that are stored once."""
    return links.join(values, "sheet_version_id")


def newest_snapshot(rows: DataFrame, accepted: DataFrame) -> DataFrame:
    """All rows of the newest accepted vintage."""
    newest = rows.join(F.broadcast(accepted), "vintage_id", "left_semi").agg(F.max(F.struct("publication_date", "vintage_id")).alias("m"))
    return rows.join(F.broadcast(newest), rows["vintage_id"] == F.col("m.vintage_id")).drop("m")


def comparability(members: DataFrame) -> DataFrame:
    """Canonical groups whose members differ in unit, or that hold one member only."""
    counted = members.groupBy("concept_id").agg(F.count("*").alias("n_members"), F.countDistinct(F.struct("unit")).alias("n_units"))
    return counted.withColumn("problem", F.when(F.col("n_units") > 1, "mixed_units").when(F.col("n_members") == 1, "vacuous"))


def only_substring(texts: DataFrame, text: str, codes: DataFrame, code: str, gram: int = 4) -> DataFrame:
    """The one code that a distinct text contains; several or none leave it open. An empty code is contained in nothing.

    Codes meet texts by their rarest stretch of ``gram`` characters (whole codes, where they are shorter), so a text is
    compared with the codes that share such a stretch, not with all of them.
    """
    own = texts.select(text).distinct()
    asked = codes.select(F.col(code).alias("_code")).filter("_code <> ''").distinct()
    size = F.least(F.char_length("_code"), F.lit(gram))
    stretches = lambda c, n: F.array_distinct(F.transform(F.sequence(F.lit(1), F.char_length(c) - n + 1), lambda i: F.substring(c, i, n)))
    each = asked.select("_code", size.alias("_n"), F.explode(stretches(F.col("_code"), size)).alias("_g"))
    common = each.groupBy("_g").agg(F.count("*").alias("_c"))
    key = each.join(common, "_g").groupBy("_code", "_n").agg(F.min_by("_g", F.struct("_c", "_g")).alias("_g"))
    sizes = F.array(*(F.lit(n) for n in range(1, gram + 1)))
    lengths = own.filter(F.col(text).isNotNull()).select(text, F.explode(sizes).alias("_n")).filter(F.char_length(text) >= F.col("_n"))
    grams = lengths.join(F.broadcast(key.select("_n").distinct()), "_n", "left_semi").select(text, F.explode(stretches(F.col(text), F.col("_n"))).alias("_g"))
    hits = grams.join(key, "_g").filter(F.col(text).contains(F.col("_code"))).groupBy(text).agg(F.count("*").alias("n_hits"), F.max("_code").alias("_one"))
    return own.join(hits, text, "left").select(text, F.coalesce("n_hits", F.lit(0).cast("long")).alias("n_hits"), F.when(F.col("n_hits") == 1, F.col("_one")).alias(code))


def store_difference(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Keys that were lost or recovered, or whose value changed, null-safe."""
    a, b = old.select(*key, F.col("value").alias("old")), new.select(*key, F.col("value").alias("new"))
    both = a.withColumn("_a", F.lit(True)).join(b.withColumn("_b", F.lit(True)), key, "full_outer")
    kind = F.when(F.col("_b").isNull(), "lost").when(F.col("_a").isNull(), "recovered").when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    return both.select(*key, "old", "new", kind.alias("kind")).filter("kind is not null")


def active_release(decisions: DataFrame, linked: DataFrame | None = None) -> DataFrame:
    """The last accepted decision (of one day the greatest id), how many are accepted, and how many vintages are linked to the active one."""
    accepted = decisions.filter("decision = 'accepted'").agg(F.max_by("release_id", F.struct("decided_at", "release_id")).alias("active"), F.count("*").alias("n_accepted"))
    if linked is None:
        return accepted
    counted = linked.groupBy("release_id").agg(F.count_distinct("vintage_id").alias("n_vintages"))
    return accepted.join(counted, F.col("active") == F.col("release_id"), "left").select("active", "n_accepted", F.coalesce("n_vintages", F.lit(0).cast("long")).alias("n_vintages"))


def incomplete(rows: DataFrame, fields: list[str], key: str) -> DataFrame:
    """(key, field) where a required field is missing."""
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).isNull().alias("gone")) for f in fields))).alias("e")
    return rows.select(key, each).filter("e.gone").select(key, F.col("e.field").alias("field"))


def claims(notes: DataFrame, measured: DataFrame, key: str) -> DataFrame:
    """Numbers that notes claim against measured ones."""
    claimed = notes.select(key, F.regexp_extract("note", "([0-9][0-9.,]*) series", 1).alias("c")).withColumn("claimed", F.regexp_replace("c", "[.,]", "").try_cast("long"))
    return claimed.join(measured, key).select(key, "claimed", "measured", (F.col("claimed") == F.col("measured")).alias("agrees"))


def table_status(sheets: DataFrame, register: DataFrame) -> DataFrame:
    """A sheet's status is that of its register entry with evidence; without evidence it is a draft."""
    entry = register.withColumn("_s", F.when((F.col("status") == "validated") & (F.coalesce("evidence", F.lit("")) == ""), "draft").otherwise(F.col("status"))).select("source_sheet", "_s")
    return sheets.select("source_sheet").distinct().join(F.broadcast(entry), "source_sheet", "left").select("source_sheet", F.coalesce("_s", F.lit("unreviewed")).alias("status"))


def running_number(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The ordinal of equal rows within their key."""
    return rows.withColumn("ordinal", F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("long"))


def resolved_tables(catalogue: DataFrame, spec: DataFrame) -> DataFrame:
    """The one table of a sheet with a role's columns in order; where several have them, the one that the hint names."""
    hits = spec.join(catalogue, ["source_sheet", "columns"], "left").groupBy("role", "source_sheet").agg(
        F.count("source_table").alias("n_tables"), F.max("source_table").alias("_one"), F.count_if(F.col("source_table") == F.col("hint")).alias("_hinted"), F.max("hint").alias("_hint")
    )
    state = F.when(F.col("n_tables") == 0, "missing").when((F.col("n_tables") == 1) | (F.col("_hinted") == 1), "resolved").otherwise("ambiguous")
    return hits.select("role", "source_sheet", "n_tables", F.when(F.col("n_tables") == 1, F.col("_one")).when(F.col("_hinted") == 1, F.col("_hint")).alias("source_table"), state.alias("state"))


def metadata_rows(read: DataFrame, sources: DataFrame) -> DataFrame:
    """A row for each file that was read, and a stub for each source of which none was."""
    stubs = sources.select("source_id").distinct().join(read, "source_id", "left_anti")
    return read.select("source_id", "file_name", "n_rows", F.lit("read").alias("state")).unionByName(stubs.select("source_id", F.lit(None).cast("string").alias("file_name"), F.lit(0).cast("long").alias("n_rows"), F.lit("failed").alias("state")))
