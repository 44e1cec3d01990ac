"""Worksheets of single sources, laid out by Spark from the driver's tables; one function for each source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .derived import summed_once, table

WORDS = "Enero Febrero Marzo Abril Mayo Junio Julio Agosto Setiembre Octubre Noviembre Diciembre".split()


def _lines(s: SparkSession, d: str) -> DataFrame:
    """Quantities by all that the sheets are laid out by: as many rows as days, flags, statuses, line numbers and sides make."""
    day = F.to_date("l_shipdate")
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    lines = table(s, d, "lineitem").select(F.col("l_returnflag").alias("f"), F.col("l_linestatus").alias("st"), flag.alias("fi"), F.year(day).alias("y"), F.month(day).alias("m"), F.quarter(day).alias("q"), F.day(day).alias("d"), F.col("l_linenumber").alias("ln"), (F.col("l_suppkey") % 2).alias("side"), F.last_day(day).alias("me"), F.col("l_quantity").cast("decimal(18,2)").alias("v"))
    return summed_once(lines, "lines")


def _sum(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.sum("v").cast("double").alias("v"))


def _part(rows: DataFrame, sheet, r, c, text=None, num=None, day=None) -> DataFrame:
    none = F.lit(None)
    pick = lambda x, kind: (none if x is None else F.lit(x) if isinstance(x, str) else x).cast(kind)
    at = lambda x: (F.lit(x) if isinstance(x, int) else x).cast("long")
    return rows.select(pick(sheet, "string").alias("source_sheet"), at(r).alias("row_id"), at(c).alias("column_id"), pick(text, "string").alias("text"), pick(num, "double").alias("num"), pick(day, "date").alias("date")).distinct()


def _all(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _month(column):
    return F.element_at(F.array(*(F.lit(w) for w in WORDS)), column)


def fiscal(s, d):
    li = _lines(s, d).withColumn("fy", F.col("y") + F.when(F.col("m") > 6, 1).otherwise(0))
    name, r, c = F.concat(F.lit("FY_"), "f"), 4 + F.col("fy") - 1990, 1 + F.col("ln")
    span = F.concat_ws("-", (F.col("fy") - 1).cast("string"), F.col("fy").cast("string"))
    return _all(_part(li, name, 4, 1, "Ejercicio"), _part(li.filter("ln in (1, 4)"), name, 2, c, F.when(F.col("ln") == 1, "Activos").otherwise("Pasivos")), _part(li, name, 4, c, F.concat(F.lit("Line "), "ln")), _part(li, name, r, 1, span), _part(_sum(li, "f", "fy", "ln"), name, r, c, num=F.col("v")))


def quotes(s, d):
    li = _lines(s, d)
    name, top = F.concat(F.lit("DQ_"), "f"), ((F.col("y") - 1990) * 12 + F.col("m")) * 40
    c = 2 + F.when(F.col("st") == "F", 0).otherwise(2)
    at = c + F.col("side")
    return _all(_part(li, name, top, 1, F.concat_ws("/", _month(F.col("m")), F.col("y").cast("string"))), _part(li, name, top + 2, c, F.when(F.col("st") == "F", "Dólar").otherwise("Real")), _part(li, name, top + 3, at, F.when(F.col("side") == 0, "Compra").otherwise("Venta")), _part(li, name, top + 3 + F.col("d"), 1, num=F.col("d")), _part(_sum(li, "f", "y", "m", "d", "st", "side"), name, top + 3 + F.col("d"), at, num=F.col("v") + 100))


def histories(s, d):
    li = _lines(s, d)
    name, b = F.concat(F.lit("YB_"), "f"), F.floor((F.col("y") - 1990) / 3)
    top, c = 2 + b * 20, 2 + ((F.col("y") - 1990) % 3) * 2
    years = li.select("f").distinct().crossJoin(F.broadcast(li.select(F.explode(F.sequence(F.lit(1990), F.lit(2004))).alias("y")).distinct()))
    sides = years.select("f", "y", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    return _all(_part(years, name, top, c, F.col("y").cast("string")), _part(sides, name, top + 1, c + F.col("side"), F.when(F.col("side") == 0, "Compra").otherwise("Venta")), _part(li, name, top + 1 + F.col("m"), 1, _month(F.col("m"))), _part(_sum(li, "f", "y", "m", "side"), name, top + 1 + F.col("m"), c + F.col("side"), num=F.col("v")))


def confidence(s, d):
    li = _lines(s, d)
    name, r = F.concat(F.lit("AN_"), "st"), 8 + (F.col("y") - 1990) * 12 + F.col("m")
    return _all(_part(li, name, 2, 1, "Índice de confianza"), _part(li, name, 7, 3, "Período"), _part(li, name, 7, 4 + F.col("fi"), F.col("f")), _part(li, name, r, 3, day=F.col("me")), _part(_sum(li, "st", "fi", "y", "m"), name, r, 4 + F.col("fi"), num=F.col("v")))


def expectations(s, d):
    li = _lines(s, d)
    name, r, c = F.concat(F.lit("EV_"), "st"), 5 + F.col("fi") * 10 + F.col("ln"), 3 + (F.col("y") - 1990) * 12 + F.col("m")
    variable = F.when(F.col("ln") == 7, "Casos descartados").otherwise(F.concat(F.lit("Variable "), "ln"))
    return _all(_part(li, name, 3, c, day=F.col("me")), _part(li.filter("ln = 1"), name, r, 1, F.concat(F.lit("Bloque "), "f")), _part(li, name, r, 2, variable), _part(_sum(li, "st", "fi", "ln", "y", "m"), name, r, c, num=F.col("v")))


def credit(s, d):
    li = _lines(s, d)
    name, r, c = F.concat(F.lit("CS_"), "st"), 5 + F.col("fi") * 10 + F.col("ln"), 3 + (F.col("y") - 1990) * 4 + F.col("q")
    roman = F.element_at(F.array(*(F.lit(x) for x in ("I", "II", "III", "IV"))), F.col("q"))
    return _all(_part(li, name, 3, c, F.concat_ws("-", roman, F.col("y").cast("string"))), _part(li.filter("ln = 1"), name, r, 1, F.concat(F.lit("Pregunta "), "f")), _part(li, name, r, 2, F.concat(F.lit("Respuesta "), "ln")), _part(_sum(li, "st", "fi", "ln", "y", "q"), name, r, c, num=F.col("v")))


def operations(s, d):
    li = _lines(s, d).withColumn("si", F.when(F.col("st") == "F", 0).otherwise(1))
    c, year = 2 + F.col("fi") * 2 + F.col("si"), 5 + (F.col("y") - 1990) * 20
    quarter = year + F.col("q") * 4 - 3
    month = quarter + (F.col("m") - 1) % 3 + 1
    roman = F.element_at(F.array(*(F.lit(x) for x in ("I", "II", "III", "IV"))), F.col("q"))
    heads = li.groupBy("f", "fi").agg(F.min("si").alias("si"))
    return _all(_part(heads, "FX", 3, c, F.concat(F.lit("Sector "), "f")), _part(li, "FX", 4, c, F.concat(F.lit("Operacion "), "st")), _part(li, "FX", year, 1, F.col("y").cast("string")), _part(li, "FX", quarter, 1, F.concat(F.lit("Trimestre "), roman)), _part(li, "FX", month, 1, _month(F.col("m"))),
                _part(_sum(li, "fi", "si", "y"), "FX", year, c, num=F.col("v")), _part(_sum(li, "fi", "si", "y", "q"), "FX", quarter, c, num=F.col("v")), _part(_sum(li, "fi", "si", "y", "q", "m"), "FX", month, c, num=F.col("v")))


def houses(s, d):
    """Nations across, months and flags down; a month's date stands in its first row."""
    li = table(s, d, "lineitem").join(table(s, d, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    rows = li.select(F.col("l_linestatus").alias("st"), F.col("l_returnflag").alias("f"), F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2).alias("fi"), F.last_day("l_shipdate").alias("me"), (F.year("l_shipdate") * 12 + F.month("l_shipdate") - 23880).alias("k"), F.col("s_nationkey").alias("n"), F.col("l_quantity").cast("decimal(18,2)").alias("v"))
    rows = summed_once(rows, "houses")
    named = rows.select("st", "n").distinct().join(table(s, d, "nation").select(F.col("n_nationkey").alias("n"), F.lower("n_name").alias("name")), "n")
    name, r, c = F.concat(F.lit("EP_"), "st"), 3 + F.col("k") * 4 + F.col("fi"), 3 + F.col("n")
    first = rows.groupBy("st", "k", "me").agg(F.min("fi").alias("fi"))
    return _all(_part(named, name, 1, c, F.col("name")), _part(first, name, r, 1, day=F.col("me")), _part(rows, name, r, 2, F.concat(F.lit("Rubro "), "f")), _part(_sum(rows, "st", "k", "fi", "n"), name, r, c, num=F.col("v")))


def plain(s, d):
    """Dates across (HD), years down (VY) and years with months down (VB), and a sheet of numbers without any axis (ZZ)."""
    li = _lines(s, d)
    row = 5 + (F.col("y") - 1990) * 13 + F.col("m")
    return _all(
        _part(li, "HD", 2, 2 + (F.col("y") - 1990) * 12 + F.col("m"), day=F.col("me")), _part(li, "HD", 4 + F.col("fi"), 1, F.concat(F.lit("Row "), "f")), _part(_sum(li, "fi", "y", "m"), "HD", 4 + F.col("fi"), 2 + (F.col("y") - 1990) * 12 + F.col("m"), num=F.col("v")),
        _part(li, "VY", 3, 2 + F.col("fi"), F.concat(F.lit("Column "), "f")), _part(li, "VY", 5 + F.col("y") - 1990, 1, F.col("y").cast("string")), _part(_sum(li, "fi", "y"), "VY", 5 + F.col("y") - 1990, 2 + F.col("fi"), num=F.col("v")),
        _part(li, "VB", 3, 3 + F.col("fi"), F.concat(F.lit("Block "), "f")), _part(li, "VB", 5 + (F.col("y") - 1990) * 13, 1, F.col("y").cast("string")), _part(li, "VB", row, 2, _month(F.col("m"))), _part(_sum(li, "fi", "y", "m"), "VB", row, 3 + F.col("fi"), num=F.col("v")),
        _part(_sum(li, "fi", "ln"), "ZZ", 1 + F.col("fi"), F.col("ln"), num=F.col("v")),
    )


def events(s, d):
    """A sheet for each flag and month: a market's name, a header and a row for each line, for either status."""
    day = F.to_date("l_shipdate")
    li = table(s, d, "lineitem").select(F.concat_ws("_", F.lit("RE"), "l_returnflag", F.date_format(day, "yyyyMM")).alias("sheet"), F.col("l_linestatus").alias("st"), day.alias("day"), F.concat(F.lit("P"), F.col("l_suppkey").cast("string")).alias("who"), F.col("l_quantity").cast("double").alias("a"), F.col("l_extendedprice").cast("double").alias("b"), "l_orderkey", "l_linenumber", "l_partkey")
    placed = li.withColumn("k", F.row_number().over(Window.partitionBy("sheet", "st").orderBy("day", "who", "l_orderkey", "l_linenumber", "l_partkey", "a", "b")))
    top = F.when(F.col("st") == "F", 0).otherwise(10**12)  # below any number of lines of the other market
    cell = lambda r, c, text=None, num=None, day=None: F.struct(r.cast("long").alias("row_id"), F.lit(c).cast("long").alias("column_id"), F.lit(text).cast("string").alias("text"), F.lit(num).cast("double").alias("num"), F.lit(day).cast("date").alias("date"))
    heads = F.array(cell(top + 1, 1, F.concat(F.lit("Mercado "), "st")), *(cell(top + 2, i, x) for i, x in enumerate(("Fecha", "Participante", "Cantidad", "Precio"), 1)))
    r = top + 2 + F.col("k")
    line = F.array(cell(r, 1, day=F.col("day")), cell(r, 2, F.col("who")), cell(r, 3, num=F.col("a")), cell(r, 4, num=F.col("b")))
    # One pass: the first line of a sheet's market brings the cells above it too.
    cells = placed.select(F.col("sheet").alias("source_sheet"), F.explode(F.when(F.col("k") == 1, F.concat(heads, line)).otherwise(line)).alias("c"))
    return cells.select("source_sheet", "c.*")


def sales(s, d):
    """Months under years; a total and its components by status, with a total that is off in every third month."""
    li = _lines(s, d)
    name, r = F.concat(F.lit("CV_"), "f"), 4 + (F.col("y") - 1990) * 13
    c = 3 + F.when(F.col("st") == "F", 0).otherwise(1)
    total = _sum(li, "f", "y", "m")
    template = li.select("f", "y", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("m")).distinct()
    return _all(_part(li, name, 2, 2, "Total"), _part(li, name, 2, c, F.concat(F.lit("Parte "), "st")), _part(li, name, r, 1, F.col("y").cast("string")), _part(template, name, r + F.col("m"), 1, _month(F.col("m"))), _part(total, name, r + F.col("m"), 2, num=F.col("v") + F.when(F.col("m") % 3 == 0, 1).otherwise(0)), _part(_sum(li, "f", "st", "y", "m"), name, r + F.col("m"), c, num=F.col("v")))


def payments(s, d):
    """Suppliers' codes in a column of remarks, some of which name two."""
    su = table(s, d, "supplier")
    return _all(_part(su, F.concat(F.lit("PP_"), F.col("s_nationkey").cast("string")), 1 + F.col("s_suppkey"), 1, F.concat(F.lit("P"), F.lpad(F.col("s_suppkey").cast("string"), 8, "0"), F.when(F.col("s_suppkey") % 4 == 0, " y otro").otherwise(""))))


def turnovers(s, d):
    """Years over buying and selling across; for either status a parent row, its lines and their total down."""
    li = _lines(s, d)
    name, c = F.concat(F.lit("FT_"), "f"), 2 + (F.col("y") - 1990) * 2
    parent = 5 + F.when(F.col("st") == "F", 0).otherwise(20)
    years = li.select("f", "y").distinct()
    sides = years.select("f", "y", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    return _all(_part(years, name, 2, c, F.col("y").cast("string")), _part(sides, name, 3, c + F.col("side"), F.when(F.col("side") == 0, "Compra").otherwise("Venta")), _part(li, name, parent, 1, F.concat(F.lit("Mercado "), "st")), _part(li, name, parent + F.col("ln"), 1, F.concat(F.lit("Line "), "ln")), _part(li, name, parent + 10, 1, "Total"),
                _part(_sum(li, "f", "st", "ln", "y", "side"), name, parent + F.col("ln"), c + F.col("side"), num=F.col("v")), _part(_sum(li, "f", "st", "y", "side"), name, parent + 10, c + F.col("side"), num=F.col("v")))


def stocks(s, d):
    """Quarters under years, each block closed by its year: levels whose year is its last quarter. One label of A is a naked digit,
    every other line of N has years of about twice the amount, far outside the check's relative tolerance at any size of the table, and
    in R the years stand a block too early."""
    li = _lines(s, d)
    name, c = F.concat(F.lit("SQ_"), "f"), 2 + (F.col("y") - 1990) * 5
    roman = F.element_at(F.array(*(F.lit(x) for x in ("I", "II", "III", "IV"))), F.col("k"))
    blocks = li.select("f", "y").distinct()
    quarters = blocks.withColumn("k", F.explode(F.array(*map(F.lit, (1, 2, 3, 4)))))
    level = _sum(li, "f", "ln", "y", "q")
    return _all(
        _part(blocks, name, 3, c, (F.col("y") + F.when(F.col("f") == "R", 1).otherwise(0)).cast("string")), _part(quarters, name, 4, c + F.col("k") - 1, F.when((F.col("f") == "A") & (F.col("y") == 1994) & (F.col("k") == 3), "3").otherwise(roman)),
        _part(blocks, name, 4, c + 4, F.col("y").cast("string")), _part(li, name, 5 + F.col("ln"), 1, F.concat(F.lit("Line "), "ln")), _part(level, name, 5 + F.col("ln"), c + F.col("q") - 1, num=F.col("v")),
        _part(level.filter("q = 4"), name, 5 + F.col("ln"), c + 4, num=F.col("v") + F.when((F.col("f") == "N") & (F.col("ln") % 2 == 1), F.abs("v") + 1).otherwise(0)),
    )


def dealings(s, d):
    """Days down, with all that H05 tells apart. DE: months, operations beneath each June, a year's row after December, a column of the
    last three months, a merged header over a thin column, a headed one with one number, and a number under nothing. DB: lines under a month."""
    li = _lines(s, d).withColumn("k", (F.col("y") - 1990) * 12 + F.col("m"))
    last = li.agg(F.min("k").alias("since"), F.max("k").alias("last"))
    li = li.crossJoin(F.broadcast(last))
    r, b = 10 + (F.col("k") - F.col("since")) * 4, 5 + (F.col("k") - F.col("since")) * 4
    months, half = li.select("k", "since", "last", "me", "m", "y").distinct(), (F.col("ln") > 3).cast("int")
    total = _sum(li, "k", "since", "last", "y", "m")
    lines = li.filter("ln <= 4")
    return _all(
        _part(li, "DE", 5, 2, "Monto"), _part(li, "DE", 5, 3, "Partes"), _part(li, "DE", 6, 2, "Total"), _part(li, "DE", 6, 3, "F"), _part(li, "DE", 6, 4, "O"), _part(li, "DE", 5, 5, "Reciente"), _part(li, "DE", 5, 6, "Grupo"), _part(li, "DE", 6, 8, "Raro"),
        _part(months, "DE", r, 1, day=F.col("me")), _part(total, "DE", r, 2, num=F.col("v")), _part(_sum(li, "k", "since", "st"), "DE", r, 3 + (F.col("st") == "O").cast("int"), num=F.col("v")),
        _part(_sum(li.filter("m = 6").withColumn("h", half), "k", "since", "h"), "DE", r + 1 + F.col("h"), 2, num=F.col("v")), _part(li.filter("m = 12"), "DE", r + 3, 1, F.col("y").cast("string")), _part(_sum(li, "y").join(li.filter("m = 12").select("y", "k", "since").distinct(), "y"), "DE", r + 3, 2, num=F.col("v")),
        _part(total.filter("k > last - 3"), "DE", r, 5, num=F.col("v") * 2), _part(total.filter("k = last - 20"), "DE", r, 6, num=F.col("v")), _part(total.filter("k = last - 30"), "DE", r, 7, num=F.col("v")), _part(total.filter("k = last - 40"), "DE", r, 8, num=F.col("v")), _part(total.filter("k = last - 50"), "DE", r, 10, num=F.col("v")),
        _part(li, "DB", 3, 3, "Importe"), _part(months, "DB", b, 1, day=F.col("me")), _part(lines, "DB", b + F.col("ln") - 1, 2, F.concat(F.lit("Line "), "ln")), _part(_sum(lines, "k", "since", "ln"), "DB", b + F.col("ln") - 1, 3, num=F.col("v")),
    )


def dealing_merges(s: SparkSession) -> DataFrame:
    """The merged header of DE: its group stands over the thin column too."""
    return s.createDataFrame([("DE", 5, 108, 6, 7), ("DE", 5, 108, 3, 4)], "source_sheet string, row_from long, row_to long, column_from long, column_to long")


def annual_histories(s, d):
    """Years down under Compra and Venta, a sheet for each flag; A's lacks Venta, and one more sheet is of a currency that no source has."""
    li = _lines(s, d)
    name = F.when(F.col("f") == "A", "Euro Fin Mes").when(F.col("f") == "N", "USD Fin Mes").otherwise("Real fin")
    r, c = 5 + F.col("y") - 1990, 3 + F.col("side")
    sides = li.filter("f <> 'A' or side = 0")
    years = li.select("f", "y").distinct()
    first = years.groupBy("f").agg(F.min("y").alias("y"))
    heads = first.join(sides.select("f", "side").distinct(), "f")
    yen = _part(years.filter("f = 'N'"), "Yen Fin Mes", r, 2, F.col("y").cast("string"))
    return _all(_part(years, name, r, 2, F.col("y").cast("string")), _part(heads, name, r - 1, c, F.when(F.col("side") == 0, "Compra").otherwise("Venta")), _part(_sum(sides, "f", "y", "side"), name, r, c, num=F.col("v")), yen)
