"""Registers of human decisions: checked entry by entry, applied whole or not at all.

Problems are worked out in one pass over the register and a few joins with what it names; whether a register is applied is
decided in the plan, by the count of its problems.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank

# Words that the registers may use.
REVIEW_WORDS = {
    "stock_flow": ["stock", "flow", "rate", "index", "not_applicable"],
    "nominal_real": ["nominal", "real", "not_applicable"],
    "hierarchy_role": ["total", "component", "standalone"],
    "comparability": ["comparable", "break", "not_comparable"],
}
REVIEW_REQUIRED = ["series_id", "definition", "reviewed_by", "reviewed_at"]
CONTINUITY_RELATIONSHIPS = ["continues", "replaces", "splits_into", "merges_into"]
CONTINUITY_RULES = ["direct_splice", "ratio_splice_on_overlap", "level_shift_on_overlap", "no_splice_compare_only"]


def applied_whole(register: DataFrame, problems: DataFrame) -> DataFrame:
    """The register where nothing is wrong with it, else none of its rows."""
    n = problems.agg(F.count("*").alias("_n"))  # one row
    return register.crossJoin(F.broadcast(n)).filter("_n = 0").drop("_n")


def _told(rows: DataFrame, key: str, tests: list[tuple[Column, str]]) -> DataFrame:
    """(entry, problem): each test that a row fails."""
    failed = F.filter(F.array(*(F.when(test, problem) for test, problem in tests)), lambda x: x.isNotNull())
    return rows.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("entry"), F.explode(failed).alias("problem"))


def _common(required: list[str], words: dict[str, list[str]]) -> list[tuple[Column, str]]:
    tests = [(blank(F.col(c)), f"{c} is blank") for c in required]
    tests += [(~blank(F.col(c)) & ~F.trim(c).isin(allowed), f"{c} is none of its words") for c, allowed in words.items()]
    return [*tests, (~blank(F.col("reviewed_at")) & F.col("reviewed_at").try_cast("date").isNull(), "reviewed_at is no date")]


def _repeated(register: DataFrame, key: str) -> DataFrame:
    again = register.filter(~blank(F.col(key))).groupBy(key).agg(F.count("*").alias("c")).filter("c > 1")
    return again.select(F.col(key).cast("string").alias("entry"), F.lit(f"{key} stands more than once").alias("problem"))


def review_problems(register: DataFrame, series: DataFrame, words: dict[str, list[str]] = REVIEW_WORDS, quote: int = 20) -> DataFrame:
    """(entry, problem) of a register of series reviews against series (series_id, frequency).

    Blank required fields, words outside their vocabulary, a scale that is no number, a review date that is none, a definition of
    fewer than ``quote`` characters, what real prices, components and breaks need beside them, series and parents that
    don't exist, another frequency than the series has, and a series that is reviewed twice.
    """
    known = series.select(F.col("series_id").alias("_id"), F.col("frequency").alias("_frequency")).distinct()
    rows = register.join(known, F.trim("series_id") == F.col("_id"), "left").join(known.select(F.col("_id").alias("_parent")).distinct(), F.trim("parent_series_id") == F.col("_parent"), "left")
    is_ = lambda c, word: F.coalesce(F.trim(c) == word, F.lit(False))
    tests = [
        *_common(REVIEW_REQUIRED, words),
        (~blank(F.col("scale_multiplier")) & F.col("scale_multiplier").try_cast("double").isNull(), "scale_multiplier is no number"),
        (~blank(F.col("definition")) & (F.length(F.trim("definition")) < quote), "definition is too short to quote the publisher"),
        (is_("nominal_real", "real") & blank(F.col("price_base_year")), "real without price_base_year"),
        (is_("hierarchy_role", "component") & blank(F.col("parent_series_id")), "component without parent_series_id"),
        (~blank(F.col("comparability")) & ~is_("comparability", "comparable") & blank(F.col("methodology_regime_id")), "not comparable without methodology_regime_id"),
        (~blank(F.col("series_id")) & F.col("_id").isNull(), "series_id names no series"),
        (~blank(F.col("parent_series_id")) & F.col("_parent").isNull(), "parent_series_id names no series"),
        (~blank(F.col("frequency")) & F.col("_frequency").isNotNull() & (F.trim("frequency") != F.col("_frequency")), "frequency is another than the series has"),
    ]
    return _told(rows, "series_id", tests).unionByName(_repeated(register, "series_id"))


def concordance_problems(register: DataFrame, relationships: list[str]) -> DataFrame:
    """(entry, problem) of a concordance of classifications (concordance_id, from_scheme, from_code, to_scheme, to_code, relationship, evidence, reviewed_by, reviewed_at)."""
    required = ["concordance_id", "from_scheme", "from_code", "to_scheme", "to_code", "relationship", "evidence", "reviewed_by", "reviewed_at"]
    same = (F.col("from_scheme") == F.col("to_scheme")) & (F.col("from_code") == F.col("to_code"))
    tests = [*_common(required, {"relationship": relationships}), (F.coalesce(same, F.lit(False)), "a code that stands for itself")]
    return _told(register, "concordance_id", tests).unionByName(_repeated(register, "concordance_id"))


def continuity_problems(decisions: DataFrame, resolved: DataFrame) -> DataFrame:
    """(entry, problem) of continuity decisions; both ends must be published identifiers that name exactly one series.

    resolved has (old_id, resolved_id), null where an identifier names none or several.
    """
    required = ["continuity_id", "concept_key", "from_series_id", "to_series_id", "relationship", "overlap_rule", "evidence", "reviewed_by", "reviewed_at"]
    one = resolved.filter("resolved_id is not null").select(F.col("old_id").alias("_id")).distinct()
    rows = decisions.join(one.withColumnRenamed("_id", "_from"), F.col("from_series_id") == F.col("_from"), "left").join(one.withColumnRenamed("_id", "_to"), F.col("to_series_id") == F.col("_to"), "left")
    tests = [
        *_common(required, {"relationship": CONTINUITY_RELATIONSHIPS, "overlap_rule": CONTINUITY_RULES}),
        *((~blank(F.col(f"{end}_series_id")) & F.col(f"_{end}").isNull(), f"{end}_series_id names no single series") for end in ("from", "to")),
        (F.coalesce(F.col("from_series_id") == F.col("to_series_id"), F.lit(False)), "a series that continues itself"),
    ]
    return _told(rows, "continuity_id", tests).unionByName(_repeated(decisions, "continuity_id"))
