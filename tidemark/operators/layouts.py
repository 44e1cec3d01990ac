"""Layouts of single sources over the long cell table (source_sheet, row_id, column_id, text, num, date).

Every extractor reads all sheets of its source at once: axes and blocks are filled within a sheet, values join them by row
and column, and sheets without the layout's anchors give no rows (``unread`` names them). Windows never run beyond a sheet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import periods as P
from ..functions import text as T
from ..sources.stored import saved
from .grid import OUT, year_axes
from .publication import only_substring

# How the source writes a fiscal year.
FISCAL = r"^((?:19|20)[0-9]{2})[-/]((?:19|20)[0-9]{2})$"
# Currency names of the quotes and their codes.
CURRENCIES = {"dolar": "USD", "real": "BRL", "peso argentino": "ARS", "euro": "EUR", "yen": "JPY", "libra esterlina": "GBP"}

# How the names of the histories' sheets begin, and their currencies.
SHEET_CURRENCIES = [("usd", "USD"), ("euro", "EUR"), ("real", "BRL"), ("peso", "ARS")]


def _across(line: str = "column_id", *by: str) -> Window:
    return Window.partitionBy("source_sheet", *by).orderBy(line).rowsBetween(Window.unboundedPreceding, 0)


def _text(cells: DataFrame) -> DataFrame:
    return cells.filter(~T.blank(F.col("text"))).select("source_sheet", "row_id", "column_id", F.trim("text").alias("text"))


def _values(cells: DataFrame) -> DataFrame:
    return cells.filter("num is not null").select("source_sheet", "row_id", "column_id", F.col("num").alias("value"))


def _headers(texts: DataFrame, at: DataFrame, upper: Column, lower: Column) -> DataFrame:
    """For each column of a sheet the lower header and the upper one, which stands once and holds to the next."""
    placed = texts.join(at, "source_sheet").filter((F.col("row_id") == upper) | (F.col("row_id") == lower))
    one = placed.groupBy("source_sheet", "column_id").agg(F.max(F.when(F.col("row_id") == upper, F.col("text"))).alias("_u"), F.max(F.when(F.col("row_id") == lower, F.col("text"))).alias("section"))
    return one.select("source_sheet", "column_id", F.last("_u", ignorenulls=True).over(_across()).alias("group"), "section")


def fiscal_years(cells: DataFrame) -> DataFrame:
    """Years ending on 30 June down the one column that holds most of them; sections across under merged groups."""
    texts = _text(cells)
    years = texts.withColumn("y", F.regexp_extract("text", FISCAL, 2).try_cast("int")).filter("y is not null")
    counted = years.groupBy("source_sheet", "column_id").agg(F.count("*").alias("n"), F.min("row_id").alias("first_row"))
    best = counted.groupBy("source_sheet").agg(F.max("n").alias("n"))
    axis = counted.join(best, ["source_sheet", "n"]).groupBy("source_sheet").agg(F.count("*").alias("k"), F.max("column_id").alias("axis"), F.min("first_row").alias("first_row")).filter("k = 1")
    named = texts.filter(T.normalized(F.col("text")) == "ejercicio").groupBy("source_sheet").agg(F.count("*").alias("anchors"), F.min("row_id").alias("anchor"))
    at = axis.join(named, "source_sheet", "left").filter("coalesce(anchors, 0) < 2").select("source_sheet", "axis", F.coalesce("anchor", F.col("first_row") - 1).alias("header_row"))
    heads = _headers(texts, at, F.greatest(F.lit(1), F.col("header_row") - 2), F.col("header_row")).filter("section is not null")
    rows = years.join(at, "source_sheet").filter("column_id = axis and row_id > header_row").select("source_sheet", "row_id", "axis", F.make_date("y", F.lit(6), F.lit(30)).alias("period"))
    joined = _values(cells).join(rows, ["source_sheet", "row_id"]).filter("column_id > axis").join(heads, ["source_sheet", "column_id"])
    return joined.select("source_sheet", T.path(F.col("group"), F.col("section")).alias("series"), *OUT[2:])


def _blocks(cells: DataFrame, titles: DataFrame) -> DataFrame:
    """Cells with the title of the block that they stand under: titles are (source_sheet, title_row, ...fields)."""
    fields = [c for c in titles.columns if c != "source_sheet"]
    marked = titles.select("source_sheet", F.col("title_row").alias("row_id"), F.struct(*fields).alias("_t"))
    rows = cells.select("source_sheet", "row_id").distinct().join(marked, ["source_sheet", "row_id"], "left")
    held = rows.select("source_sheet", "row_id", F.last("_t", ignorenulls=True).over(_across("row_id")).alias("_t")).filter("_t is not null")
    return cells.join(held, ["source_sheet", "row_id"]).select(*cells.columns, "_t.*").withColumn("rel", F.col("row_id") - F.col("title_row"))


def daily_quotes(cells: DataFrame) -> DataFrame:
    """Blocks under a month's title; currencies two rows below, buying and selling below them, days down the column
    that holds most of the numbers from 1 to 31. Days that a month lacks and currencies without a code are left out."""
    month = r"^(?:.*\s)?([a-z]+)[/ -](20[0-9]{2}|19[0-9]{2})$"
    named = _text(cells).select("source_sheet", F.col("row_id").alias("title_row"), "column_id", F.regexp_extract(T.normalized(F.col("text")), month, 1).alias("w"), F.regexp_extract(T.normalized(F.col("text")), month, 2).try_cast("int").alias("year"))
    titles = named.withColumn("month", T.month_number(F.col("w"))).filter("year is not null and month is not null").groupBy("source_sheet", "title_row").agg(F.min_by("year", "column_id").alias("year"), F.min_by("month", "column_id").alias("month"))
    placed = _blocks(cells, titles)
    heads = placed.filter("rel in (2, 3) and text is not null").groupBy("source_sheet", "title_row", "column_id").agg(F.max(F.when(F.col("rel") == 2, T.normalized(F.col("text")))).alias("_c"), F.max(F.when(F.col("rel") == 3, T.normalized(F.col("text")))).alias("measure"))
    codes = F.create_map(*(F.lit(x) for pair in CURRENCIES.items() for x in pair))
    quoted = heads.withColumn("code", F.try_element_at(codes, F.last("_c", ignorenulls=True).over(_across("column_id", "title_row")))).filter("measure in ('compra', 'venta') and code is not null").select("source_sheet", "title_row", "column_id", "code", "measure")
    body = placed.filter("rel > 3 and num is not null")
    days = body.filter("num between 1 and 31 and num = floor(num)")
    axis = days.groupBy("source_sheet", "title_row", "column_id").agg(F.count("*").alias("n")).groupBy("source_sheet", "title_row").agg(F.max_by("column_id", F.struct("n", -F.col("column_id"))).alias("axis"))
    day = days.join(axis, ["source_sheet", "title_row"]).filter("column_id = axis").select("source_sheet", "row_id", "axis", F.try_to_date(F.format_string("%04d-%02d-%02d", "year", "month", F.col("num").cast("int")), "yyyy-MM-dd").alias("period")).filter("period is not null")
    joined = body.join(day, ["source_sheet", "row_id"]).filter("column_id <> axis").join(quoted, ["source_sheet", "title_row", "column_id"])
    return joined.select("source_sheet", F.concat_ws(" ", "code", "measure").alias("series"), "period", F.col("num").alias("value"), "row_id", "column_id")


def year_blocks(cells: DataFrame) -> DataFrame:
    """Blocks under a row of at least two consecutive years; each year holds the columns to the next one, buying and
    selling below it, months down the leftmost column."""
    heads = year_axes(cells, "row_id", "column_id", least=2, widest_gap=1).select("source_sheet", F.col("row_id").alias("title_row"))
    placed = _blocks(cells, heads)
    top = placed.filter("rel in (0, 1) and text is not null").groupBy("source_sheet", "title_row", "column_id").agg(F.max(F.when(F.col("rel") == 0, T.year_label(F.col("text")))).alias("_y"), F.max(F.when(F.col("rel") == 1, T.normalized(F.col("text")))).alias("measure"))
    axis = top.withColumn("year", F.last("_y", ignorenulls=True).over(_across("column_id", "title_row"))).filter("measure in ('compra', 'venta') and year is not null").select("source_sheet", "title_row", "column_id", "year", "measure")
    months = placed.filter("rel > 1 and text is not null").groupBy("source_sheet", "row_id").agg(F.min_by("text", "column_id").alias("t")).select("source_sheet", "row_id", T.month_number(F.col("t")).alias("month")).filter("month is not null")
    joined = placed.filter("rel > 1 and num is not null").join(axis, ["source_sheet", "title_row", "column_id"]).join(months, ["source_sheet", "row_id"])
    return joined.select("source_sheet", F.col("measure").alias("series"), P.month_end(F.col("year"), F.col("month")).alias("period"), F.col("num").alias("value"), "row_id", "column_id")


def _year_column(cells: DataFrame) -> DataFrame:
    """(sheet, axis, row_id, year, header_row): the fullest column of at least three rising years, the first of equals, and the row above them."""
    fullest = year_axes(cells, "column_id", "row_id").groupBy("source_sheet").agg(F.max_by("column_id", F.struct("n", -F.col("column_id"))).alias("axis"))
    years = cells.join(F.broadcast(fullest), "source_sheet").filter("column_id = axis").select("source_sheet", "axis", "row_id", T.year_label(F.col("text")).alias("year")).filter("year is not null")
    return years.withColumn("header_row", F.min("row_id").over(Window.partitionBy("source_sheet")) - 1)


def _annual(cells: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Year rows, the columns headed Compra or Venta, and one judged row for each sheet of the annual form of H14."""
    years = _year_column(cells)
    heads = _text(cells).join(years.select("source_sheet", "header_row").distinct(), "source_sheet").filter("row_id = header_row")
    heads = heads.select("source_sheet", "column_id", T.normalized(F.col("text")).alias("measure")).filter("measure in ('compra', 'venta')")
    counted = heads.groupBy("source_sheet").agg(F.count("*").alias("n"), F.count_distinct("measure").alias("kinds"))
    code = lambda sheet: T.first_match(T.normalized(sheet), [(f"^{word}", code) for word, code in SHEET_CURRENCIES])
    sheets = cells.select("source_sheet").distinct().withColumn("code", code(F.col("source_sheet")))
    judged = sheets.join(years.groupBy("source_sheet").agg(F.count("*").alias("years")), "source_sheet", "left").join(counted, "source_sheet", "left")
    reason = F.when(F.col("code").isNull(), "unsupported currency").when(F.col("years").isNull(), "no coherent year column").when((F.coalesce("n", F.lit(0)) != 2) | (F.col("kinds") != 2), "not one Compra and one Venta")
    return years, heads, judged.withColumn("reason", reason)


def annual_quotes(cells: DataFrame) -> DataFrame:
    """H14, annual form: years down, one buying and one selling column, the currency in the sheet's name; annual_problems names the sheets that aren't read."""
    years, heads, judged = _annual(cells)
    good = judged.filter("reason is null").select("source_sheet", "code")
    joined = _values(cells).join(heads, ["source_sheet", "column_id"]).join(years, ["source_sheet", "row_id"]).join(F.broadcast(good), "source_sheet")
    return joined.select("source_sheet", F.concat_ws(" ", "code", "measure").alias("series"), F.make_date("year", F.lit(12), F.lit(31)).alias("period"), "value", "row_id", "column_id")


def annual_problems(cells: DataFrame) -> DataFrame:
    """(source_sheet, reason) of the sheets that the annual form can't be read from."""
    return _annual(cells)[2].filter("reason is not null").select("source_sheet", "reason")


def anchored(cells: DataFrame, anchor: str) -> DataFrame:
    """A table to the right of and below the one cell that says ``anchor``; a sheet with none or several isn't read."""
    texts = _text(cells)
    at = texts.filter(T.normalized(F.col("text")) == anchor).groupBy("source_sheet").agg(F.count("*").alias("k"), F.min("row_id").alias("top"), F.min("column_id").alias("axis")).filter("k = 1")
    heads = texts.join(at, "source_sheet").filter("row_id = top and column_id > axis").select("source_sheet", "column_id", F.col("text").alias("series"))
    days = cells.filter("date is not null").join(at, "source_sheet").filter("column_id = axis and row_id > top").select("source_sheet", "row_id", F.last_day("date").alias("period"))
    return _values(cells).join(heads, ["source_sheet", "column_id"]).join(days, ["source_sheet", "row_id"]).select(*OUT)


def _dates_across(cells: DataFrame) -> DataFrame:
    """The row that holds most dates, as (source_sheet, column_id, period, header_row)."""
    days = cells.filter("date is not null").select("source_sheet", "row_id", "column_id", F.last_day("date").alias("period"))
    row = days.groupBy("source_sheet", "row_id").agg(F.count("*").alias("n")).groupBy("source_sheet").agg(F.max_by("row_id", F.struct("n", -F.col("row_id"))).alias("header_row"))
    return days.join(row, "source_sheet").filter("row_id = header_row").select("source_sheet", "column_id", "period", "header_row")


def variable_blocks(cells: DataFrame, discarded: str | None = None) -> DataFrame:
    """H20, and dates across in H06: a variable in each row's last text, under a block name that stands once; rows whose
    variable matches ``discarded`` go."""
    axis = _dates_across(cells)
    top = axis.select("source_sheet", "header_row").distinct()
    names = _text(cells).join(top, "source_sheet").filter("row_id > header_row").groupBy("source_sheet", "row_id").agg(F.max_by("text", "column_id").alias("variable"), F.min_by("text", "column_id").alias("_first"), F.count("*").alias("_n"))
    rows = names.select("source_sheet", "row_id", "variable", F.last(F.when(F.col("_n") > 1, F.col("_first")), ignorenulls=True).over(_across("row_id")).alias("block"))
    kept = rows.filter(~F.col("variable").rlike(discarded)) if discarded else rows
    return _values(cells).join(axis, ["source_sheet", "column_id"]).join(kept, ["source_sheet", "row_id"]).filter("row_id > header_row").select("source_sheet", T.path(F.col("block"), F.col("variable")).alias("series"), *OUT[2:])


def survey(cells: DataFrame) -> DataFrame:
    """Answers by quarter; a question stands in its first row, the quarters ('II-1999') across in the fullest row."""
    texts = _text(cells)
    label = texts.select("source_sheet", "row_id", "column_id", T.quarter_number(F.split_part("text", F.lit("-"), F.lit(1))).alias("q"), F.split_part("text", F.lit("-"), F.lit(2)).try_cast("int").alias("y")).filter("q is not null and y is not null")
    row = label.groupBy("source_sheet", "row_id").agg(F.count("*").alias("n")).groupBy("source_sheet").agg(F.max_by("row_id", F.struct("n", -F.col("row_id"))).alias("header_row"))
    axis = label.join(row, "source_sheet").filter("row_id = header_row").select("source_sheet", "column_id", "header_row", P.quarter_end(F.col("y"), F.col("q")).alias("period"))
    asked = texts.join(row, "source_sheet").filter("row_id > header_row").groupBy("source_sheet", "row_id").agg(F.max_by("text", "column_id").alias("answer"), F.min_by("text", "column_id").alias("_first"), F.count("*").alias("_n"))
    rows = asked.select("source_sheet", "row_id", "answer", F.last(F.when(F.col("_n") > 1, F.col("_first")), ignorenulls=True).over(_across("row_id")).alias("question"))
    return _values(cells).join(axis, ["source_sheet", "column_id"]).join(rows, ["source_sheet", "row_id"]).filter("row_id > header_row").select("source_sheet", T.path(F.col("question"), F.col("answer")).alias("series"), *OUT[2:])


def last_survey_quarter(rows: DataFrame) -> DataFrame:
    """The quarter of a survey's last header with answers."""
    return rows.groupBy("source_sheet").agg(F.max("period").alias("publication_quarter"))


def mixed_rows(cells: DataFrame, header_row: int) -> DataFrame:
    """Rows of years, quarters and months in one column, each under its year; sectors above operations across.

    The frequency is that of the row; a month or a quarter before any year isn't read.
    """
    texts = _text(cells)
    at = cells.select("source_sheet").distinct().withColumn("header_row", F.lit(header_row))
    heads = _headers(texts, at, F.col("header_row") - 1, F.col("header_row")).filter("section is not null")
    label = texts.filter(F.col("row_id") > header_row).groupBy("source_sheet", "row_id").agg(F.min_by("text", "column_id").alias("t"))
    word = T.normalized(F.col("t"))
    judged = label.select("source_sheet", "row_id", T.year_label(F.col("t")).alias("_y"), T.quarter_number(F.regexp_replace(word, "^trimestre ", "")).alias("q"), T.month_number(word).alias("m"))
    rows = judged.withColumn("y", F.last("_y", ignorenulls=True).over(_across("row_id"))).filter("y is not null")
    frequency = F.when(F.col("_y").isNotNull(), "annual").when(F.col("q").isNotNull(), "quarterly").when(F.col("m").isNotNull(), "monthly")
    month = F.when(F.col("_y").isNotNull(), 12).when(F.col("q").isNotNull(), F.col("q") * 3).otherwise(F.col("m"))
    dated = rows.select("source_sheet", "row_id", frequency.alias("frequency"), P.month_end(F.col("y"), month).alias("period")).filter("frequency is not null")
    return _values(cells).join(heads, ["source_sheet", "column_id"]).join(dated, ["source_sheet", "row_id"]).select("source_sheet", T.path(F.col("group"), F.col("section")).alias("series"), "frequency", *OUT[2:])


def turnover(cells: DataFrame) -> DataFrame:
    """Years above sides across, parents without numbers above their rows down; a row that says total is told apart."""
    top = year_axes(cells, "row_id", "column_id", least=2, widest_gap=1).groupBy("source_sheet").agg(F.max_by("row_id", F.struct("n", -F.col("row_id"))).alias("header_row"))
    texts = _text(cells)
    heads = _headers(texts, top, F.col("header_row"), F.col("header_row") + 1).select("source_sheet", "column_id", T.year_label(F.col("group")).alias("y"), "section").filter("y is not null and section is not null")
    label = texts.join(top, "source_sheet").filter("row_id > header_row + 1").groupBy("source_sheet", "row_id").agg(F.min_by("text", "column_id").alias("label"))
    counted = cells.groupBy("source_sheet", "row_id").agg(F.count("num").alias("_n"))
    rows = label.join(counted, ["source_sheet", "row_id"]).select("source_sheet", "row_id", "label", F.last(F.when(F.col("_n") == 0, F.col("label")), ignorenulls=True).over(_across("row_id")).alias("parent"))
    kind = F.when(T.normalized(F.col("label")).startswith("total"), "total").otherwise("detail")
    joined = _values(cells).join(heads, ["source_sheet", "column_id"]).join(rows, ["source_sheet", "row_id"])
    return joined.select("source_sheet", T.path(F.col("parent"), F.col("label"), F.col("section")).alias("series"), kind.alias("kind"), F.make_date("y", F.lit(12), F.lit(31)).alias("period"), "value", "row_id", "column_id")


def entity_panel(cells: DataFrame, entities: DataFrame) -> DataFrame:
    """Entities across, dates and items down; an entity by its normalised name, else by the one registered name that the
    heading contains. match tells name, contained, ambiguous and unresolved apart."""
    texts = _text(cells)
    heads = texts.groupBy("source_sheet").agg(F.min("row_id").alias("header_row"))
    across = texts.join(heads, "source_sheet").filter("row_id = header_row").select("source_sheet", "column_id", "header_row", T.normalized(F.col("text")).alias("_name"), F.col("text").alias("entity"))
    known = entities.select(T.normalized(F.col("name")).alias("_name"), "entity_id")
    exact = across.join(known, "_name", "left")
    held = only_substring(exact.filter("entity_id is null"), "_name", known.select(F.col("_name").alias("_part")), "_part")
    held = held.join(known.select(F.col("_name").alias("_part"), F.col("entity_id").alias("_id")), "_part", "left").select("_name", "n_hits", "_id")
    match = F.when(F.col("entity_id").isNotNull(), "name").when(F.col("n_hits") == 1, "contained").when(F.col("n_hits") > 1, "ambiguous").otherwise("unresolved")
    named = exact.join(held, "_name", "left").select("source_sheet", "column_id", "header_row", "entity", F.coalesce("entity_id", "_id").alias("entity_id"), match.alias("match"))
    item = texts.join(heads, "source_sheet").filter("row_id > header_row").groupBy("source_sheet", "row_id").agg(F.min_by("text", "column_id").alias("item"))
    marked = cells.groupBy("source_sheet", "row_id").agg(F.last_day(F.max("date")).alias("_d"))
    dated = marked.select("source_sheet", "row_id", F.last("_d", ignorenulls=True).over(_across("row_id")).alias("period"))
    return _values(cells).join(named, ["source_sheet", "column_id"]).join(item, ["source_sheet", "row_id"]).join(dated, ["source_sheet", "row_id"]).filter("row_id > header_row").select("source_sheet", "item", "entity", "entity_id", "match", "period", "value")


def row_events(cells: DataFrame) -> DataFrame:
    """Events in rows under repeated headers that begin with 'Fecha'; a lone text above them is the state that holds to
    the next one. Equal events of a state, day and participant are told apart by their ordinal in reading order."""
    texts = _text(cells)
    first = texts.groupBy("source_sheet", "row_id").agg(F.min_by("text", "column_id").alias("_t"), F.count("*").alias("_n"))
    filled = cells.groupBy("source_sheet", "row_id").agg((F.count("num") + F.count("date")).alias("_v"), F.max("date").alias("day")).join(first, ["source_sheet", "row_id"], "left")
    header = T.normalized(F.col("_t")) == "fecha"
    lone = (F.col("_n") == 1) & (F.col("_v") == 0) & ~header
    down = _across("row_id")
    rows = filled.select("source_sheet", "row_id", "day", F.col("_t").alias("participant"), F.last(F.when(lone, F.col("_t")), ignorenulls=True).over(down).alias("state"), F.last(F.when(header, F.col("row_id")), ignorenulls=True).over(down).alias("title_row")).filter("day is not null and title_row is not null")
    # Few rows are headers: only their texts are looked at again, and a small table of them is sent to the values.
    rows = saved(rows, "event-rows")
    titles = saved(rows.select("source_sheet", F.col("title_row").alias("row_id")).distinct(), "event-titles")
    names = saved(texts.join(titles, ["source_sheet", "row_id"]).select("source_sheet", F.col("row_id").alias("title_row"), "column_id", T.normalized(F.col("text")).alias("measure")), "event-headers")
    joined = _values(cells).join(rows, ["source_sheet", "row_id"]).join(names, ["source_sheet", "title_row", "column_id"])
    nth = F.row_number().over(Window.partitionBy("source_sheet", "state", "day", "participant", "measure").orderBy("row_id"))
    return joined.select("source_sheet", "state", "day", "participant", "measure", "value", nth.cast("long").alias("ordinal"))


def component_blocks(cells: DataFrame, tolerance: float = 0.01, gaps: bool = False) -> DataFrame:
    """Months under their year, a total and its components across; each month with whether the components make the total.

    A template runs on past the published months: the months behind the last one with a number are its tail and give no row. A
    month without numbers before that is a gap; with ``gaps`` it stays, with nulls.
    """
    texts = _text(cells)
    label = texts.groupBy("source_sheet", "row_id").agg(F.min_by("text", "column_id").alias("t"), F.min("column_id").alias("axis"))
    judged = label.select("source_sheet", "row_id", T.year_label(F.col("t")).alias("_y"), T.month_number(T.normalized(F.col("t"))).alias("m"))
    dated = judged.withColumn("y", F.last("_y", ignorenulls=True).over(_across("row_id"))).filter("_y is null and m is not null and y is not null").select("source_sheet", "row_id", P.month_end(F.col("y"), F.col("m")).alias("period"))
    total = texts.filter(T.normalized(F.col("text")) == "total").groupBy("source_sheet").agg(F.min_by("column_id", "row_id").alias("total_column"))
    # Of the months from the end backwards those before the first with a number: E10's trailing suffix.
    filled = dated.join(_values(cells).select("source_sheet", "row_id", F.lit(True).alias("_held")).distinct(), ["source_sheet", "row_id"], "left")
    back = Window.partitionBy("source_sheet").orderBy(F.desc("row_id")).rowsBetween(Window.unboundedPreceding, 0)
    dated = filled.withColumn("_in", F.bool_or(F.coalesce("_held", F.lit(False))).over(back)).filter("_in").select("source_sheet", "row_id", "period")
    parts = dated.join(total, "source_sheet").join(_values(cells), ["source_sheet", "row_id"], "left" if gaps else "inner")
    amount = F.col("value").cast("decimal(38,6)")
    summed = parts.groupBy("source_sheet", "period").agg(F.sum(F.when(F.col("column_id") == F.col("total_column"), amount)).alias("t"), F.sum(F.when(F.col("column_id") > F.col("total_column"), amount)).alias("c"))
    return summed.select("source_sheet", "period", F.col("t").cast("double").alias("total"), F.col("c").cast("double").alias("components"), (F.abs(F.col("t") - F.col("c")) <= tolerance).alias("holds"))


def participants(cells: DataFrame, pattern: str) -> DataFrame:
    """The distinct codes of participants that whole cells hold."""
    return _text(cells).select(F.regexp_extract("text", f"^(?:{pattern})$", 0).alias("code")).filter("code <> ''").distinct()


def unread(cells: DataFrame, observations: DataFrame) -> DataFrame:
    """Sheets with numbers of which none became an observation, with how many numbers stay unread."""
    read = observations.select("source_sheet").distinct()
    return cells.groupBy("source_sheet").agg(F.count("num").alias("n_numbers")).filter("n_numbers > 0").join(read, "source_sheet", "left_anti")


def sheet_catalogue(cells: DataFrame, observations: DataFrame) -> DataFrame:
    """A row for each sheet with its extent, its observations and whether it was read."""
    read = observations.groupBy("source_sheet").agg(F.count("*").alias("n_observations"), F.count_distinct("series").alias("n_series"), F.min("period").alias("first_period"), F.max("period").alias("last_period"))
    extent = cells.groupBy("source_sheet").agg(F.max("row_id").alias("n_rows"), F.max("column_id").alias("n_columns"), F.count("num").alias("n_numbers"))
    joined = extent.join(read, "source_sheet", "left").na.fill(0, ["n_observations", "n_series"])
    return joined.withColumn("parse_status", F.when(F.col("n_observations") > 0, "read").when(F.col("n_numbers") > 0, "unread").otherwise("no_numbers"))


def contract_problems(catalogue: DataFrame, contract: DataFrame) -> DataFrame:
    """Sheets that a contract (source_sheet, least_observations, earliest) requires and that are missing, thin or too old."""
    problem = F.when(F.col("n_observations").isNull(), "missing").when(F.col("n_observations") < F.col("least_observations"), "too few").when(F.col("first_period") < F.col("earliest"), "implausible date")
    return contract.join(catalogue, "source_sheet", "left").select("source_sheet", problem.alias("problem")).filter("problem is not null")


def structure(cells: DataFrame, row: int, expected: DataFrame) -> DataFrame:
    """The texts of a header row in order against the expected ones (source_sheet, tokens), as check rows."""
    listed = _text(cells).filter(F.col("row_id") == row).groupBy("source_sheet").agg(F.transform(F.sort_array(F.collect_list(F.struct("column_id", T.normalized(F.col("text")).alias("t")))), lambda x: x["t"]).alias("_seen"))
    return expected.join(listed, "source_sheet", "left").select("source_sheet", F.array_join("_seen", "|").alias("observed"), F.array_join("tokens", "|").alias("expected"), F.coalesce(F.col("_seen") == F.col("tokens"), F.lit(False)).alias("agrees"))
