"""Units, scales and economic meaning from published wording, with reviewed values over derived ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_match, normalized, only_match

# Wording rules; the first match gives the value.
UNITS = [(r"porcentaje|percent|%|tasa", "percent"), (r"indice|index", "index"), (r"usd|dolares|dollar", "usd"), (r"guaranies|pyg", "pyg")]
SCALES = [(r"miles de millones|billion", 1e9), (r"millones|million", 1e6), (r"miles|thousand", 1e3)]
STOCK_FLOW = [(r"saldo|stock|posicion", "stock"), (r"flujo|flow|variacion", "flow")]
TRANSFORMATIONS = [(r"variacion interanual|year.on.year", "year_on_year"), (r"variacion mensual|month.on.month", "month_on_month"), (r"acumulad|year.to.date", "cumulative"), (r"promedio movil|moving average", "moving_average"), (r"en niveles|in levels", "level")]
ADJUSTMENT = [(r"desestacionaliz|seasonally adjusted", "adjusted"), (r"serie original|not adjusted", "original")]


def scale_multiplier(text: Column) -> Column:
    """Null where the wording names no scale."""
    out = F.lit(None).cast("double")
    for pattern, value in reversed(SCALES):
        out = F.when(text.rlike(pattern), value).otherwise(out)
    return out


def snippet(text: Column, rules) -> Column:
    """The quoted words that a rule matched, with up to 12 characters on either side."""
    pattern = "|".join(f"(?:{p})" for p, _ in rules)
    return F.nullif(F.regexp_extract(text, f".{{0,12}}(?:{pattern}).{{0,12}}", 0), F.lit(""))


def derived(series: DataFrame, label: str = "label") -> DataFrame:
    """Meaning of each distinct wording, worked out once and joined back."""
    worded = series.select(label).distinct().withColumn("_t", normalized(F.col(label)))
    meant = worded.select(
        label, first_match(F.col("_t"), UNITS).alias("unit"), scale_multiplier(F.col("_t")).alias("scale_multiplier"),
        only_match(F.col("_t"), STOCK_FLOW).alias("stock_flow"), only_match(F.col("_t"), ADJUSTMENT).alias("adjustment"), snippet(F.col("_t"), STOCK_FLOW).alias("evidence"),
    )
    return series.join(meant, series[label].eqNullSafe(meant[label]), "left").drop(meant[label])


def reviewed(rows: DataFrame, register: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """A reviewed value beats the derived one, field by field, and the basis says which it was."""
    over = register.select(key, *(F.col(f).alias(f"_{f}") for f in fields))
    joined = rows.join(F.broadcast(over), key, "left")
    out = [c for c in rows.columns if c not in fields]
    for f in fields:
        out += [F.coalesce(f"_{f}", f).alias(f), F.when(F.col(f"_{f}").isNotNull(), "reviewed").when(F.col(f).isNotNull(), "derived").otherwise("unknown").alias(f"{f}_basis")]
    return joined.select(*out)


def completeness(rows: DataFrame, fields: list[str]) -> DataFrame:
    """For each field, rows in all and rows with a value."""
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).isNotNull().alias("known")) for f in fields))).alias("e")
    return rows.select(each).groupBy("e.field").agg(F.count("*").alias("n_rows"), F.count_if(F.col("e.known")).alias("n_known"))


def register_problems(register: DataFrame, required: list[str], key: list[str], vocabulary: dict[str, list[str]]) -> DataFrame:
    """Every defect of a register as a row; a register with any is applied not at all."""
    parts = [register.filter(F.col(c).isNull() | (F.trim(F.col(c)) == "")).select(F.concat_ws("|", *key).alias("entry"), F.lit(f"blank {c}").alias("problem")) for c in required]
    parts += [register.filter(F.col(c).isNotNull() & ~F.col(c).isin(v)).select(F.concat_ws("|", *key).alias("entry"), F.lit(f"unknown {c}").alias("problem")) for c, v in vocabulary.items()]
    parts.append(register.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").select(F.concat_ws("|", *key).alias("entry"), F.lit("duplicate").alias("problem")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def evidence(rows: DataFrame, key: str, fields: list[str], quote: str = "evidence") -> DataFrame:
    """(key, field, value, quote) of every derived value."""
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields))).alias("e")
    return rows.select(key, quote, each).filter("e.value is not null").select(key, F.col("e.field").alias("field"), F.col("e.value").alias("value"), F.col(quote).alias("quote"))


def measurement(series: DataFrame, found: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """A column and its basis for each field, from evidence rows (key, field, value, basis); reviewed beats derived."""
    best = F.struct(F.when(F.col("basis") == "reviewed", 1).otherwise(0).alias("_r"), "value", "basis")
    one = found.filter(F.col("field").isin(fields)).groupBy(key).agg(*(F.max(F.when(F.col("field") == f, best)).alias(f"_{f}") for f in fields))
    shown = [c for f in fields for c in (F.col(f"_{f}.value").alias(f), F.coalesce(f"_{f}.basis", F.lit("unknown")).alias(f"{f}_basis"))]
    return series.select(key).distinct().join(one, key, "left").select(key, *shown)


def transformation(text: Column) -> Column:
    """How the published figure was made from the level, where just one wording says so."""
    return only_match(text, TRANSFORMATIONS)


def base_year(text: Column) -> Column:
    """The base year of 'base 1994', 'base = 1994' or 'ano base 1994'."""
    return F.regexp_extract(text, r"base\s*=?\s*((?:19|20)[0-9]{2})", 1).try_cast("int")


def real_or_nominal(text: Column) -> Column:
    """Real where prices are constant or a base year is named."""
    return F.when(text.rlike("constante|constant|real") | base_year(text).isNotNull(), "real").otherwise("nominal")


def measures(series: DataFrame, label: str = "label", title: str = "title") -> DataFrame:
    """Unit, scale and base year of each distinct pair of label and title, the label's wording first, joined back null-safe."""
    pairs = series.select(label, title).distinct()
    a, b = normalized(F.coalesce(F.col(label), F.lit(""))), normalized(F.coalesce(F.col(title), F.lit("")))
    meant = pairs.select(
        F.col(label).alias("_l"), F.col(title).alias("_t"), F.coalesce(first_match(a, UNITS), first_match(b, UNITS)).alias("unit"),
        F.coalesce(scale_multiplier(a), scale_multiplier(b)).alias("scale_multiplier"), F.coalesce(base_year(a), base_year(b)).alias("base_year"),
    )
    return series.join(meant, F.col(label).eqNullSafe(F.col("_l")) & F.col(title).eqNullSafe(F.col("_t"))).drop("_l", "_t")
