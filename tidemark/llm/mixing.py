"""Mixing sources to target weights: iterative proportional fitting of token weights to source, language and topic
marginals, then a sample of documents by the calibrated probabilities. DataFrame operations only."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved

DIMENSIONS = ("source", "lang", "topic")
#: Topics by the first expression that a text matches; the rest is "prose".
TOPICS = (("table", r" \| "), ("legal", r"[Ll]icen[cs]ed?\b"), ("contact", r"@|\+[0-9]"), ("figures", r"[0-9]{4}"))
SMOOTHING, ROUNDS = 0.7, 10
#: Share of all token weight that the sample is to hold.
KEEP = 0.7
#: Cells of the contingency table that the driver fits at once; a larger table is fitted by joins.
DRIVER_CELLS = 100_000


def topic_of(text: Column) -> Column:
    out = F.lit("prose")
    for name, pattern in reversed(TOPICS):
        out = F.when(text.rlike(pattern), name).otherwise(out)
    return out


def marks(id_col: str = "doc_id", text_col: str = "text", tokens_col: str | None = None) -> list[Column]:
    """_source, _lang, _topic ('' for null), _tokens (tokens_col where given, else white-space words; at least 1) and _u (uniform by id)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    tokens = F.col(tokens_col) if tokens_col else F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    digits = F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), 1, 8)
    return [
        F.coalesce("source", F.lit("")).alias("_source"),
        F.coalesce("lang", F.lit("")).alias("_lang"),
        topic_of(text).alias("_topic"),
        F.greatest(tokens, F.lit(1)).cast("long").alias("_tokens"),
        (F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)).alias("_u"),
    ]


def smoothed(mass: dict[str, float], alpha: float) -> dict[str, float]:
    """Target shares in proportion to observed shares to the power alpha: small categories gain, large ones lose."""
    total = sum(mass.values())
    powered = {k: (v / total) ** alpha for k, v in mass.items()}
    return {k: v / sum(powered.values()) for k, v in powered.items()}


def _targets(given: dict | None, mass: dict[str, float], alpha: float) -> dict[str, float]:
    """Given shares over the observed categories, those without one getting none; or smoothed ones."""
    if not given:
        return smoothed(mass, alpha)
    own = {k: max(0.0, float(given.get(k, 0.0))) for k in mass}
    total = sum(own.values())
    return {k: v / total for k, v in own.items()} if total else smoothed(mass, alpha)


def rates(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None, alpha: float = SMOOTHING, rounds: int = ROUNDS, keep: float = KEEP, driver_cells: int = DRIVER_CELLS) -> DataFrame:
    """(_source, _lang, _topic, probability) from the token mass of each cell.

    The fit starts at the masses and scales them to each marginal in turn, ``rounds`` times. A cell's rate is fitted over
    observed mass; a probability is the rate times one factor, and 1 at most, with the factor calibrated so that the
    expected weight of the sample is ``keep`` of all. The mix is the fitted one but for cells that are kept whole.
    """
    spark, keys = cells.sparkSession, [f"_{d}" for d in DIMENSIONS]
    targets = targets or {}
    cells = saved(cells, "cells")
    if cells.count() <= driver_cells:
        rows = sorted((*(r[k] for k in keys), float(r["mass"])) for r in cells.collect())
        fitted = [r[3] for r in rows]
        goals = []
        for i, d in enumerate(DIMENSIONS):
            mass: dict = defaultdict(float)
            for r in rows:
                mass[r[i]] += r[3]
            goals.append(_targets(targets.get(d), mass, alpha))
        for _ in range(rounds):
            for i in range(3):
                now: dict = defaultdict(float)
                for r, w in zip(rows, fitted):
                    now[r[i]] += w
                fitted = [w * goals[i][r[i]] / now[r[i]] if now[r[i]] else 0.0 for r, w in zip(rows, fitted)]
        rated = [(w / r[3], r[3]) for r, w in zip(rows, fitted)]
        factor = _factor(keep, lambda f: tuple(map(sum, zip((0.0, 0.0, 0.0), *((m, m * (f * r > 1), r * m * (f * r <= 1)) for r, m in rated)))))
        out = [(*row[:3], min(1.0, factor * r)) for row, (r, _) in zip(rows, rated)]
        return F.broadcast(spark.createDataFrame(out, "_source string, _lang string, _topic string, probability double"))
    now = cells.withColumn("w", F.col("mass").cast("double"))
    goals = []
    for k, d in zip(keys, DIMENSIONS):
        shares = cells.groupBy(k).agg(F.sum("mass").cast("double").alias("m"))
        if targets.get(d):
            given = spark.createDataFrame([(c, float(v)) for c, v in targets[d].items()], f"{k} string, g double")
            shares = shares.join(given, k, "left").select(k, F.greatest(F.coalesce("g", F.lit(0.0)), F.lit(0.0)).alias("p"))
        else:
            total = shares.agg(F.sum("m").alias("t")).first()["t"]
            shares = shares.select(k, F.pow(F.col("m") / total, alpha).alias("p"))
        whole = shares.agg(F.sum("p").alias("t")).first()["t"]
        goals.append(saved(shares.select(k, (F.col("p") / whole).alias("goal")), "goal"))
    for _ in range(rounds):
        for k, goal in zip(keys, goals):
            have = now.groupBy(k).agg(F.sum("w").alias("have"))
            now = now.join(have.join(goal, k), k).select(*keys, "mass", F.when(F.col("have") > 0, F.col("w") * F.col("goal") / F.col("have")).otherwise(0.0).alias("w"))
        now = saved(now, "fit")
    rate = F.col("w") / F.col("mass")
    whole = lambda f: F.lit(f) * rate > 1
    sums = lambda f: tuple(x or 0.0 for x in now.agg(F.sum("mass").cast("double"), F.sum(F.when(whole(f), F.col("mass"))).cast("double"), F.sum(F.when(~whole(f), F.col("w")))).first())
    return now.select(*keys, F.least(F.lit(1.0), F.lit(_factor(keep, sums)) * rate).alias("probability"))


def _factor(keep: float, sums) -> float:
    """The factor f with sum(min(mass, f * fitted)) = keep * sum(mass); sums(f): all mass, mass of cells kept whole, fitted weight of the others.

    The set of whole cells only grows from step to step, so this ends after as many steps as it grows, in practice a few.
    """
    factor = 0.0
    while True:
        mass, whole, fitted = sums(factor)
        new = (min(1.0, keep) * mass - whole) / fitted if fitted else factor
        if new <= factor * (1 + 1e-12):
            return factor
        factor = new


def _drawn(docs: DataFrame, targets: dict | None, id_col: str, text_col: str, tokens_col: str | None, fit: dict) -> DataFrame:
    """Each row of docs as a struct _doc, beside its marks, probability and selected: no name of docs can meet one of these."""
    every = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"), *marks(id_col, text_col, tokens_col))
    keys = [f"_{d}" for d in DIMENSIONS]
    cells = every.groupBy(*keys).agg(F.sum("_tokens").alias("mass"))
    return every.join(rates(cells, targets, **fit), keys).withColumn("selected", F.col("_u") < F.col("probability"))


def mixed(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, id_col: str = "doc_id", text_col: str = "text", tokens_col: str | None = None, **fit) -> DataFrame:
    """docs with _source, _lang, _topic, _tokens, _u, probability, and selected (_u below probability).

    The draw is a function of the id alone, so rows of an id share it and a job that is run again selects the same. A null
    source or language is a category of its own (''); a null or empty text weighs one token; an empty table gives none.
    Columns of docs by one of the names above give way to them. Only a count by cell is shuffled, after map-side sums; a
    hot source costs nothing.
    """
    out = _drawn(docs, targets, id_col, text_col, tokens_col, fit)
    new = [c for c in out.columns if c != "_doc"]
    return out.select(*(F.col("_doc").getField(c).alias(c) for c in docs.columns if c not in new), *new)


def sample(docs: DataFrame, targets: dict[str, dict[str, float]] | None = None, id_col: str = "doc_id", text_col: str = "text", tokens_col: str | None = None, **fit) -> DataFrame:
    """The selected rows of docs, with its columns, whatever their names; nulls, repeats and empty tables as in mixed()."""
    return _drawn(docs, targets, id_col, text_col, tokens_col, fit).filter("selected").select("_doc.*")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its cell, words, calibrated probability and draw; nulls and repeats as in mixed()."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    # The marks are a few bytes a row: kept, so texts are read once.
    narrow = saved(docs.select("doc_id", *marks()), "marks")
    keys = [f"_{d}" for d in DIMENSIONS]
    fitted = rates(narrow.groupBy(*keys).agg(F.sum("_tokens").alias("mass")))
    out = narrow.join(fitted, keys)
    return out.select(
        "doc_id", F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"),
        F.round("probability", 6).alias("probability"), (F.col("_u") < F.col("probability")).alias("selected"),
    )


def mixing_sql() -> str:
    """The same in DuckDB's SQL: one common table expression for each scaling step."""
    topic = " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{n}'" for n, p in TOPICS)
    steps, last = [], "w0"
    for i in range(ROUNDS * 3):
        d = DIMENSIONS[i % 3]
        steps.append(f"w{i + 1} AS MATERIALIZED (SELECT source, lang, topic, mass, w * goal / sum(w) OVER (PARTITION BY {d}) AS w FROM {last} JOIN goal_{d} USING ({d}))")
        last = f"w{i + 1}"
    goals = ", ".join(
        f"p_{d} AS (SELECT {d}, pow(sum(mass) / (SELECT sum(mass) FROM cells), {SMOOTHING}) AS p FROM cells GROUP BY {d}), goal_{d} AS MATERIALIZED (SELECT {d}, p / (SELECT sum(p) FROM p_{d}) AS goal FROM p_{d})"
        for d in DIMENSIONS
    )
    digits = " + ".join(f"(strpos('0123456789abcdef', substr(md5(coalesce(doc_id::VARCHAR, '')), {i}, 1)) - 1) * {16 ** (8 - i)}" for i in range(1, 9))
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS t FROM documents),
marks AS MATERIALIZED (SELECT doc_id, source, lang, CASE {topic} ELSE 'prose' END AS topic,
  greatest(len(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')), 1)::BIGINT AS n_tokens,
  ({digits}) / 4294967296.0 AS u FROM d),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS mass FROM marks GROUP BY ALL),
{goals},
w0 AS MATERIALIZED (SELECT *, mass AS w FROM cells),
{", ".join(steps)},
s AS (SELECT source, lang, topic, mass, w, w / mass AS rate, {KEEP} * sum(mass) OVER () AS k, sum(w) OVER () AS all_w,
  coalesce(sum(mass) OVER o, 0) AS whole, coalesce(sum(w) OVER o, 0) AS gone FROM {last} WINDOW o AS (ORDER BY w / mass DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT max((k - whole) / (all_w - gone)) AS f FROM s WHERE (k - whole) / (all_w - gone) * rate <= 1),
r AS (SELECT source, lang, topic, least(1.0, f * rate) AS p FROM s, f)
SELECT doc_id, source, lang, topic, n_tokens, round(p, 6) AS probability, u < p AS selected FROM marks JOIN r USING (source, lang, topic)"""
