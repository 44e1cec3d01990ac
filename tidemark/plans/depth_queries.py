"""Queries of layouts, registers, dimensions and stored grids that go beyond single tables, with the SQL they equal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import sql_functions
from ..operators import accounting as A
from ..operators import dated as W
from ..operators import dimensions as K
from ..operators import governance as V
from ..operators import grid as G
from ..operators import identity as I
from ..operators import layouts as L
from ..operators import publication as B
from ..operators import quality as Q
from ..operators import registers as R
from ..operators import screens
from ..operators import semantics as M
from ..operators.reuse import reused
from ..sources import derived as D
from ..sources import files
from ..sources import special as S
from ..sources.derived import F1, F2, F4
from ..sources.stored import saved, shared_dir
from .primitive_queries import _FILES, _files
from .relational_queries import LINES, ORDERS, PARTS
from .review_queries import _DEC, _decisions
from .vintage_queries import AS_OF, _events, _realised

_LI = "li AS (SELECT l_returnflag AS f, l_linestatus AS st, year(l_shipdate) AS y, month(l_shipdate) AS m, quarter(l_shipdate) AS q, l_linenumber AS ln, last_day(CAST(l_shipdate AS DATE)) AS me, (year(l_shipdate)-1990)*12+month(l_shipdate) AS k, CAST(l_quantity AS DECIMAL(18,2)) AS v FROM lineitem)"


def _stock(s, d):
    return saved(S.stocks(s, d), "stocks")


def quarter_labels(s, d):
    return G.quarter_axis(_stock(s, d)).filter("quarter is not null").select("source_sheet", F.col("column_id").cast("long").alias("column_id"), "year", F.col("quarter").cast("int").alias("quarter"), "inferred")


def block_closing(s, d):
    cells = _stock(s, d)
    return G.quarter_closing(cells, G.quarter_axis(cells))


def h05(s, d):
    return W.vertical_dates(saved(S.dealings(s, d), "dealings"), S.dealing_merges(s)).select("source_sheet", "series", "period", "value", "kind")


def h05_columns(s, d):
    cells = saved(S.dealings(s, d), "dealings")
    return W.data_columns(cells, W.dated_rows(cells), S.dealing_merges(s)).select("source_sheet", F.col("column_id").cast("long").alias("column_id"), "why")


def _counted(name: str, register: DataFrame, problems: DataFrame) -> DataFrame:
    """(register, outcome, n): its problems by kind, and how many of its rows are applied."""
    problems = saved(problems, "problems")
    told = problems.groupBy(F.col("problem").alias("outcome")).agg(F.count("*").alias("n"))
    applied = R.applied_whole(register, problems).agg(F.lit("applied rows").alias("outcome"), F.count("*").alias("n"))
    return told.unionByName(applied).select(F.lit(name).alias("register"), "outcome", "n")


def n23(s, d):
    """Reviews of all parts as series: a register without faults is applied, one with a few is not at all."""
    key = F.col("p_partkey")
    name = F.concat(F.lit("part:"), key.cast("string"))
    known = PARTS(s, d).select(name.alias("series_id"), F.when(F.col("p_size") % 2 == 0, "monthly").otherwise("quarterly").alias("frequency"))
    none = F.lit(None).cast("string")
    clean = PARTS(s, d).select(
        key, name.alias("series_id"), F.concat(F.lit("Published as quantity of "), "p_name").alias("definition"), F.lit("reviewer").alias("reviewed_by"), F.lit("2024-01-31").alias("reviewed_at"),
        F.when(F.col("p_size") % 2 == 0, "stock").otherwise("flow").alias("stock_flow"), F.lit("nominal").alias("nominal_real"), F.when(F.col("p_size") % 5 == 0, "component").otherwise("standalone").alias("hierarchy_role"),
        F.when(F.col("p_size") % 5 == 0, "part:1").alias("parent_series_id"), F.lit("comparable").alias("comparability"), none.alias("methodology_regime_id"), none.alias("price_base_year"), F.lit("1000").alias("scale_multiplier"),
        F.when(F.col("p_size") % 2 == 0, "monthly").otherwise("quarterly").alias("frequency"),
    )
    faulty = clean.withColumn("nominal_real", F.when(key % 500 == 1, "real").otherwise(F.col("nominal_real"))).withColumn("frequency", F.when(key == 7, "annual").otherwise(F.col("frequency")))
    faulty = faulty.withColumn("series_id", F.when(key == 9, "part:x9").otherwise(F.col("series_id"))).withColumn("reviewed_at", F.when(key == 11, "soon").otherwise(F.col("reviewed_at")))
    faulty = faulty.unionByName(faulty.filter(key == 12))
    return _counted("clean", clean, R.review_problems(clean, known)).unionByName(_counted("faulty", faulty, R.review_problems(faulty, known)))


_N23 = """SELECT 'clean' AS register, 'applied rows' AS outcome, count(*) AS n FROM part UNION ALL SELECT 'faulty', 'applied rows', 0
UNION ALL SELECT 'faulty', 'real without price_base_year', count(*) FROM part WHERE p_partkey%500=1 HAVING count(*)>0 UNION ALL SELECT 'faulty', 'frequency is another than the series has', count(*) FROM part WHERE p_partkey=7 HAVING count(*)>0
UNION ALL SELECT 'faulty', 'series_id names no series', count(*) FROM part WHERE p_partkey=9 HAVING count(*)>0 UNION ALL SELECT 'faulty', 'reviewed_at is no date', count(*) FROM part WHERE p_partkey=11 HAVING count(*)>0
UNION ALL SELECT 'faulty', 'series_id stands more than once', count(*) FROM part WHERE p_partkey=12 HAVING count(*)>0"""


def _resolved(s, d):
    return saved(I.resolution(I.migration(*D.releases(s, d), "sheet", "r", "c", "period")), "resolution")


def m15_continuity(s, d):
    """Identifiers that name one series each continue into the first of them; with those that name none or several nothing is applied."""
    resolved = _resolved(s, d)
    first = resolved.filter("resolved_id is not null").agg(F.min("old_id").alias("to_series_id"))
    all_ = resolved.crossJoin(F.broadcast(first)).filter("old_id <> to_series_id").select(
        F.concat(F.lit("c:"), "old_id").alias("continuity_id"), F.lit("quantity").alias("concept_key"), F.col("old_id").alias("from_series_id"), "to_series_id", F.lit("continues").alias("relationship"),
        F.lit("direct_splice").alias("overlap_rule"), F.lit("notes of the release").alias("evidence"), F.lit("reviewer").alias("reviewed_by"), F.lit("2024-01-31").alias("reviewed_at"), "resolved_id",
    )
    single = all_.filter("resolved_id is not null")
    return _counted("single", single, R.continuity_problems(single, resolved)).unionByName(_counted("all", all_, R.continuity_problems(all_, resolved)))


_M15C = f"""WITH {F4}, r AS (SELECT old_id, count(DISTINCT new_id) AS c FROM cl WHERE old_id IS NOT NULL GROUP BY 1), t AS (SELECT min(old_id) AS m FROM r WHERE c=1), o AS (SELECT r.* FROM r, t WHERE old_id <> m)
SELECT 'single' AS register, 'applied rows' AS outcome, count(*) AS n FROM o WHERE c=1 UNION ALL SELECT 'all', 'applied rows', CASE WHEN count(*) FILTER (WHERE c<>1) > 0 THEN 0 ELSE count(*) END FROM o
UNION ALL SELECT 'all', 'from_series_id names no single series', count(*) FROM o WHERE c<>1 HAVING count(*)>0"""


def m15_concordance(s, d):
    """Brands against kinds of parts, an entry for each part, some of them faulty."""
    rows = PARTS(s, d).select(
        F.col("p_partkey").cast("string").alias("concordance_id"), F.lit("brand").alias("from_scheme"), F.col("p_brand").alias("from_code"), F.lit("kind").alias("to_scheme"), F.split_part("p_type", F.lit(" "), F.lit(1)).alias("to_code"),
        F.when(F.col("p_size") == 1, "like").otherwise("part_of").alias("relationship"), F.col("p_name").alias("evidence"), F.lit("reviewer").alias("reviewed_by"), F.when(F.col("p_partkey") % 97 == 0, "soon").otherwise("2024-01-31").alias("reviewed_at"),
    )
    good = rows.filter("relationship = 'part_of' and reviewed_at <> 'soon'")
    words = ["part_of", "equivalent"]
    return _counted("good", good, R.concordance_problems(good, words)).unionByName(_counted("all", rows, R.concordance_problems(rows, words)))


_M15D = """SELECT 'good' AS register, 'applied rows' AS outcome, count(*) AS n FROM part WHERE p_size<>1 AND p_partkey%97<>0 UNION ALL SELECT 'all', 'applied rows', CASE WHEN count(*) FILTER (WHERE p_size=1 OR p_partkey%97=0)>0 THEN 0 ELSE count(*) END FROM part
UNION ALL SELECT 'all', 'relationship is none of its words', count(*) FROM part WHERE p_size=1 HAVING count(*)>0 UNION ALL SELECT 'all', 'reviewed_at is no date', count(*) FROM part WHERE p_partkey%97=0 HAVING count(*)>0"""


def _functions(s, d):
    """The SQL interface over the store of d."""
    resolved = _resolved(s, d).withColumn("candidates", F.filter(F.split("candidates", ";"), lambda x: x != ""))
    sql_functions.create_functions(s, _events(s, d), D.accepted(s), resolved)
    resolved.createOrReplaceTempView("published_ids")
    return s


def k03(s, d):
    """Titles and labels of parts in two sources; an even size is of the annex."""
    size, annex = F.col("p_size"), F.col("p_size") % 2 == 0
    trade = F.when(size % 3 == 0, "Exportaciones por tipo de bienes").when(size % 3 == 1, "Importaciones según niveles de procesamiento").otherwise("Exportaciones e importaciones")
    finance = F.when(size % 3 == 0, "Cuadro Nº 4 - Saldos por plazo").otherwise("Cuadro Nº 1.1 - Tasas de interés. Ponderación sobre saldos")
    series = PARTS(s, d).select(
        F.col("p_partkey").alias("series_id"), F.when(annex, "annex").otherwise("indicators").alias("source_id"), F.concat(F.lit("S"), (size % 4).cast("string")).alias("source_sheet"),
        F.when(annex, trade).otherwise(finance).alias("title"), F.concat("p_brand", F.when(F.col("p_partkey") % 2 == 0, " — Importación registrada").otherwise(" Consumo interno")).alias("label"),
    )
    own = ["S0", "S2"]
    entries = K.rules(s, [
        ("trade_flow", "title", "annex", own, "export", "exportaciones"), ("trade_flow", "title", "annex", own, "import", "importaciones"), ("trade_classification", "title", "annex", own, "processing_level", "niveles de procesamiento"),
        ("trade_classification", "title", "annex", own, "goods_type", "tipo de bienes"), ("trade_regime", "label", "annex", ["S2"], "registered", "importacion registrada"), ("trade_regime", "label", "annex", ["S2"], "domestic_use", "consumo interno"),
        ("measure", "title", "indicators", [], "rate", r"^cuadro n\S* [0-9.]+ - tasas de interes"), ("measure", "title", "indicators", [], "outstanding_amount", r"^cuadro n\S* [0-9.]+ - saldos"),
    ])
    found = K.derived_dimensions(series, entries).unionByName(K.products(series, "annex", own))
    return found.select("series_id", "dimension", "value", "basis", (F.length("evidence") > 3).alias("quoted"))


_K03 = """WITH p AS (SELECT p_partkey AS series_id, p_size AS z, p_brand AS b, p_partkey%2=0 AS even FROM part)
SELECT series_id, 'trade_flow' AS dimension, CASE z%3 WHEN 0 THEN 'export' ELSE 'import' END AS value, 'published_title' AS basis, TRUE AS quoted FROM p WHERE z%2=0 AND z%3<2
UNION ALL SELECT series_id, 'trade_classification', CASE z%3 WHEN 0 THEN 'goods_type' ELSE 'processing_level' END, 'published_title', TRUE FROM p WHERE z%2=0 AND z%3<2
UNION ALL SELECT series_id, 'trade_regime', CASE WHEN even THEN 'registered' ELSE 'domestic_use' END, 'published_label', TRUE FROM p WHERE z%4=2
UNION ALL SELECT series_id, 'measure', CASE z%3 WHEN 0 THEN 'outstanding_amount' ELSE 'rate' END, 'published_title', TRUE FROM p WHERE z%2=1
UNION ALL SELECT series_id, 'product', CASE WHEN even THEN b ELSE b||' Consumo interno' END, 'published_label', TRUE FROM p WHERE z%2=0"""


def l09_reused(s, d):
    """The grid built, built again from the same rows, and after one series has changed."""
    path, rows = shared_dir(s, "expected-grid"), saved(_realised(s, d).select("series_id", "period", "value"), "rows")
    first = rows.agg(F.min("series_id").alias("_first"))
    later = rows.crossJoin(F.broadcast(first)).withColumn("value", F.when(F.col("series_id") == F.col("_first"), F.col("value") + 1).otherwise(F.col("value"))).drop("_first")
    out = []
    for run, inputs in enumerate((rows, rows, later), 1):
        told = reused(inputs, screens.expected_grid, path, "series_id")
        out.append(told.table.agg(F.lit(run).cast("long").alias("run"), F.lit(told.rebuilt).cast("long").alias("rebuilt"), F.lit(told.kept).cast("long").alias("kept"), F.count("*").alias("grid_rows"), F.count_if("observed").alias("observed")))
        out[-1] = saved(out[-1], "run")  # before the next run writes over the table
    return reduce(DataFrame.unionByName, out)


_L09 = f"""WITH {F1}, sp AS (SELECT series_id, min(period) AS a, max(period) AS b, count(*) AS n FROM realised GROUP BY 1), g AS (SELECT CAST(coalesce(sum(datediff('month', a, b) + 1) FILTER (WHERE n>1), 0) AS BIGINT) AS grid_rows, CAST(coalesce(sum(n) FILTER (WHERE n>1), 0) AS BIGINT) AS observed, count(*) AS s FROM sp)
SELECT CAST(1 AS BIGINT) AS run, s AS rebuilt, CAST(0 AS BIGINT) AS kept, grid_rows, observed FROM g UNION ALL SELECT 2, 0, s, grid_rows, observed FROM g UNION ALL SELECT 3, 1, s-1, grid_rows, observed FROM g"""


def a01(s, d):
    """Nations as registered files, one of them not there."""
    path, nations = shared_dir(s, "files"), D.table(s, d, "nation")
    nations.select(F.col("n_nationkey").cast("string").alias("file_name"), F.concat_ws(";", "n_name", F.col("n_regionkey").cast("string")).alias("value")).write.partitionBy("file_name").text(path)
    registry = nations.select(F.col("n_nationkey").cast("string").alias("file_name"), F.concat(F.lit("src:"), "n_name").alias("source_id")).unionByName(s.createDataFrame([("x", "src:x")], "file_name string, source_id string"))
    return files.manifest(s, registry, f"{path}/*/*.txt", name="file_name=([^/]+)/", largest=10).select("source_id", F.col("length").alias("n_bytes"), "sha256", "vintage_id", "state")


_A01 = """WITH f AS (SELECT 'src:'||n_name AS source_id, n_name||';'||n_regionkey||chr(10) AS t FROM nation), h AS (SELECT source_id, CAST(strlen(t) AS BIGINT) AS n_bytes, CASE WHEN strlen(t)<=10 THEN sha256(t) END AS sha256 FROM f)
SELECT source_id, n_bytes, sha256, CASE WHEN sha256 IS NOT NULL THEN source_id||':'||substr(sha256,1,24) END AS vintage_id, CASE WHEN sha256 IS NULL THEN 'too large' ELSE 'found' END AS state FROM h UNION ALL SELECT 'src:x', NULL, NULL, NULL, 'missing'"""


def a03_places(s, d):
    doubled = _files(s, d).unionByName(_files(s, d).withColumn("path", F.concat("path", F.lit("-copy"))))
    return files.replay_places(doubled).select("source_id", "sha256", F.col("place").cast("long").alias("place"))


def l14_drift(s, d):
    """A vintage later AF hides rows, N sheets have one formula more, and RF's values are others, which is no drift."""
    cells = D.grid(s, d).select("source_sheet", "row_id", "column_id", F.col("tok").alias("text"), "num", F.col("period").alias("date"))
    state = cells.groupBy("source_sheet").agg(F.count_if(F.col("column_id") == 3).alias("formula_cells"), F.lit(0).alias("hidden_rows"), F.lit(2).alias("hidden_columns"), F.count_distinct(F.when(F.col("row_id").between(10, 14), F.col("row_id"))).alias("_h"))
    content = lambda c: G.version_ids(c).select("source_sheet", F.col("sheet_version_id").alias("content"))
    later = cells.withColumn("num", F.when(F.col("source_sheet") == "RF", F.col("num") + 1).otherwise(F.col("num")))
    changed = state.withColumn("hidden_rows", F.when(F.col("source_sheet").isin("AF", "RF"), F.col("_h")).otherwise(F.col("hidden_rows"))).withColumn("formula_cells", F.col("formula_cells") + F.col("source_sheet").startswith("N").cast("int"))
    return A.behaviour_drift(content(cells).join(state, "source_sheet"), content(later).join(changed, "source_sheet"))


_L14 = f"""WITH {F2}, t AS (SELECT source_sheet, count(*) FILTER (WHERE column_id=3) AS fc, count(DISTINCT CASE WHEN row_id BETWEEN 10 AND 14 THEN row_id END) AS h FROM cells GROUP BY 1)
SELECT source_sheet, 'hidden_rows' AS state, CAST(0 AS BIGINT) AS before, h AS after FROM t WHERE source_sheet='AF' AND h>0 UNION ALL SELECT source_sheet, 'formula_cells', fc, fc+1 FROM t WHERE source_sheet LIKE 'N%'"""


def h15_tail(s, d):
    return L.component_blocks(saved(S.sales(s, d), "sheets"), gaps=True)


_H15 = f"""WITH {_LI}, t AS (SELECT DISTINCT f, y FROM li), m AS (SELECT f, y, unnest(generate_series(1, 12)) AS m FROM t), v AS (SELECT f, y, m, CAST(sum(v) AS DOUBLE) AS c FROM li GROUP BY 1, 2, 3), z AS (SELECT f, max(k) AS last FROM li GROUP BY 1)
SELECT 'CV_'||m.f AS source_sheet, last_day(make_date(m.y, CAST(m.m AS INT), 1)) AS period, c + CASE WHEN m.m%3=0 THEN 1 ELSE 0 END AS total, c AS components, CASE WHEN c IS NOT NULL THEN m.m%3<>0 END AS holds FROM m JOIN z ON z.f=m.f AND (m.y-1990)*12+m.m <= last LEFT JOIN v ON v.f=m.f AND v.y=m.y AND v.m=m.m"""


def h18_fallback(s, d):
    """Five nations are registered, and one by a part of its name: headings hold one registered name, several or none."""
    entities = D.table(s, d, "nation").filter("n_nationkey <= 4").select(F.col("n_name").alias("name"), F.col("n_nationkey").cast("long").alias("entity_id")).unionByName(s.createDataFrame([("TION_13", 113)], "name string, entity_id long"))
    return L.entity_panel(saved(S.houses(s, d), "sheets"), entities).groupBy("source_sheet", "entity", "entity_id", "match").agg(F.count("*").alias("n"))


_H18 = """WITH reg AS (SELECT lower(n_name) AS nm, CAST(n_nationkey AS BIGINT) AS id FROM nation WHERE n_nationkey<=4 UNION ALL SELECT 'tion_13', 113), x AS (SELECT 'EP_'||l_linestatus AS source_sheet, lower(n_name) AS entity, l_returnflag AS f, last_day(CAST(l_shipdate AS DATE)) AS p FROM lineitem JOIN supplier ON l_suppkey=s_suppkey JOIN nation ON s_nationkey=n_nationkey),
g AS (SELECT source_sheet, entity, count(DISTINCT (f, p)) AS n FROM x GROUP BY 1, 2), m AS (SELECT e.entity, max(CASE WHEN nm=e.entity THEN id END) AS exact, count(*) FILTER (WHERE contains(e.entity, nm)) AS hits, max(CASE WHEN contains(e.entity, nm) THEN id END) AS one FROM (SELECT DISTINCT entity FROM g) e, reg GROUP BY 1)
SELECT source_sheet, entity, coalesce(exact, CASE WHEN hits=1 THEN one END) AS entity_id, CASE WHEN exact IS NOT NULL THEN 'name' WHEN hits=1 THEN 'contained' WHEN hits>1 THEN 'ambiguous' ELSE 'unresolved' END AS match, n FROM g JOIN m USING (entity)"""


def n07_rest(s, d):
    """Lines as survey observations: sources are flags; every fourth part has a positional id, every fifth no unit; R's answers end at 45."""
    part = F.col("l_partkey")
    rows = LINES(s, d).select(F.col("l_returnflag").alias("source_id"), part.alias("series_id"), F.when(part % 4 == 0, "positional").otherwise("stable").alias("stability"), F.when((part % 5 != 0) | (F.col("l_returnflag") == "A"), "percent").alias("unit"), F.col("l_quantity").cast("double").alias("value"))
    return Q.documented_source(rows, s.createDataFrame([("R", 0.0, 45.0), ("N", 0.0, 100.0)], "source_id string, low double, high double"))


_N07 = """WITH l AS (SELECT l_returnflag AS source_id, l_partkey AS p, l_quantity AS v FROM lineitem), c AS (SELECT source_id, count(DISTINCT p) AS n, count(DISTINCT CASE WHEN p%4=0 THEN p END) AS pos, count(DISTINCT CASE WHEN p%5=0 AND source_id<>'A' THEN p END) AS unk, count(*) AS rows, count(*) FILTER (WHERE source_id='R' AND v>45 OR source_id='N' AND v>100) AS o FROM l GROUP BY 1)
SELECT source_id, 'positional_ids' AS check_name, pos AS failing, n AS "of" FROM c UNION ALL SELECT source_id, 'unknown_units', CASE WHEN unk>0.15*n THEN unk ELSE 0 END, n FROM c UNION ALL SELECT source_id, 'outside_range', o, rows FROM c"""


def k01_transformation(s, d):
    """How figures were made, from the wording of parts' labels."""
    size = F.col("p_size") % 6
    text = F.when(size == 0, "Variación interanual del índice").when(size == 1, "Variación  mensual").when(size == 2, "Saldo acumulado").when(size == 3, "Promedio móvil, variación mensual").when(size == 4, "Serie en niveles").otherwise(F.col("p_brand"))
    from ..functions.text import normalized

    return PARTS(s, d).select("p_partkey", M.transformation(normalized(text)).alias("transformation"))


_K01 = "SELECT p_partkey, CASE p_size%6 WHEN 0 THEN 'year_on_year' WHEN 1 THEN 'month_on_month' WHEN 2 THEN 'cumulative' WHEN 4 THEN 'level' ELSE 'not_reviewed' END AS transformation FROM part"


def n19_linked(s, d):
    links = ORDERS(s, d).select(F.date_format("o_orderdate", "yyyy-MM").alias("release_id"), F.concat_ws(":", "o_orderpriority", (F.col("o_custkey") % 50).cast("string")).alias("vintage_id"))
    return B.active_release(_decisions(s, d), links)


def n31_failed(s, d):
    """Vintages of nations as sources: those that failed to be read stop the gate beside the empty ones."""
    files_ = D.table(s, d, "nation").select(F.col("n_name").alias("source_id"), F.when(F.col("n_nationkey") % 6 == 0, "failed").when(F.col("n_nationkey") % 6 == 1, "unresolved").otherwise("ingested").alias("ingestion_status"))
    return V.gate({"failed_sources": V.failed_sources(files_), "unresolved_sources": files_.filter("ingestion_status = 'unresolved'")})


_DE = f"""WITH {_LI}, z AS (SELECT max(k) AS last FROM li), t AS (SELECT k, y, me, CAST(sum(v) AS DOUBLE) AS value FROM li GROUP BY 1, 2, 3)
SELECT 'DE' AS source_sheet, 'Monto — Total' AS series, me AS period, value, 'dated' AS kind FROM t
UNION ALL SELECT 'DE', 'Partes — '||st, me, CAST(sum(v) AS DOUBLE), 'dated' FROM li GROUP BY st, me
UNION ALL SELECT 'DE', 'Monto — Total — operacion '||row_number() OVER (PARTITION BY me ORDER BY h), me, value, 'operation' FROM (SELECT me, CASE WHEN ln > 3 THEN 1 ELSE 0 END AS h, CAST(sum(v) AS DOUBLE) AS value FROM li WHERE m = 6 AND me < (SELECT max(me) FROM li) GROUP BY 1, 2)
UNION ALL SELECT 'DE', 'Monto — Total', make_date(y,12,31), CAST(sum(v) AS DOUBLE), 'annual' FROM li WHERE y IN (SELECT y FROM li WHERE m = 12) GROUP BY y
UNION ALL SELECT 'DE', 'Reciente — O', me, value*2, 'dated' FROM t, z WHERE k > last - 3
UNION ALL SELECT 'DE', 'Grupo', me, value, 'dated' FROM t, z WHERE k IN (last - 20, last - 30)
UNION ALL SELECT 'DE', 'Grupo — Raro', me, value, 'dated' FROM t, z WHERE k = last - 40
UNION ALL SELECT 'DB', 'Line '||ln||' — Importe', me, CAST(sum(v) AS DOUBLE), 'block' FROM li WHERE ln <= 4 GROUP BY ln, me"""

_Q = {
    "H05_all_rows_and_columns": (h05, _DE),
    "H05_data_columns": (h05_columns, "SELECT * FROM (VALUES ('DE',CAST(2 AS BIGINT),'dense'),('DE',3,'dense'),('DE',4,'dense'),('DE',5,'late'),('DE',6,'headed'),('DE',7,'merged'),('DE',8,'headed'),('DB',3,'dense')) AS x(source_sheet, column_id, why) WHERE EXISTS (SELECT 1 FROM lineitem)"),
    "N23_review_register": (n23, _N23),
    "M15_continuity": (m15_continuity, _M15C),
    "M15_concordance": (m15_concordance, _M15D),
    "J10_sql_as_of": (lambda s, d: _functions(s, d).sql(f"SELECT * FROM series_as_of_date(DATE '{AS_OF}')"), f"WITH {F1} SELECT series_id, period, value, vintage_id, publication_date AS available_at, 'observed' AS observation_status FROM (SELECT *, row_number() OVER (PARTITION BY series_id, period ORDER BY publication_date DESC, vintage_id DESC) AS k FROM fact WHERE vintage_id IN ('v1','v2','v3') AND publication_date <= DATE '2000-12-31' AND period <= publication_date) WHERE k = 1 AND NOT is_deleted"),
    "J10_sql_statement": (lambda s, d: _functions(s, d).sql(f"SELECT * FROM series_statement_as_of_date(DATE '{AS_OF}')"), f"WITH {F1} SELECT series_id, period, value, vintage_id, publication_date AS available_at, CASE WHEN period > publication_date THEN 'after_publication' ELSE 'observed' END AS observation_status FROM (SELECT *, row_number() OVER (PARTITION BY series_id, period ORDER BY publication_date DESC, vintage_id DESC) AS k FROM fact WHERE vintage_id IN ('v1','v2','v3') AND publication_date <= DATE '2000-12-31') WHERE k = 1 AND NOT is_deleted"),
    "M06_sql_scalar": (lambda s, d: _functions(s, d).sql("SELECT old_id, resolve_series_id(old_id) AS current_id FROM published_ids"), f"WITH {F4} SELECT old_id, CASE WHEN count(DISTINCT new_id)=1 THEN min(new_id) END AS current_id FROM cl WHERE old_id IS NOT NULL GROUP BY 1"),
    "M06_sql_table": (lambda s, d: _functions(s, d).sql("SELECT r.* FROM published_ids p, LATERAL resolve_series_ids(p.old_id) r"), f"WITH {F4}, n AS (SELECT old_id, CAST(count(DISTINCT new_id) AS INTEGER) AS candidate_count FROM cl WHERE old_id IS NOT NULL GROUP BY 1) SELECT DISTINCT old_id AS published_series_id, new_id AS current_series_id, candidate_count FROM cl JOIN n USING (old_id) WHERE new_id IS NOT NULL"),
    "K03_economic_dimensions": (k03, _K03),
    "L09_reused_grid": (l09_reused, _L09),
    "A01_manifest": (a01, _A01),
    "A03_replay_places": (a03_places, f"WITH {_FILES}, x AS (SELECT source_id, sha256, t, CASE WHEN o_orderstatus <> 'P' THEN last_day(t) END AS pd FROM fl JOIN orders ON o_orderkey = k) SELECT source_id, sha256, row_number() OVER (PARTITION BY source_id ORDER BY pd NULLS LAST, t, sha256) AS place FROM x"),
    "L14_behaviour_drift": (l14_drift, _L14),
    "H14_annual_quotes": (lambda s, d: L.annual_quotes(saved(S.annual_histories(s, d), "sheets")).select(*G.OUT[:4]), "WITH li AS (SELECT l_returnflag AS f, year(l_shipdate) AS y, l_suppkey%2 AS side, CAST(l_quantity AS DECIMAL(18,2)) AS v FROM lineitem) SELECT CASE f WHEN 'N' THEN 'USD Fin Mes' ELSE 'Real fin' END AS source_sheet, CASE f WHEN 'N' THEN 'USD' ELSE 'BRL' END||CASE side WHEN 0 THEN ' compra' ELSE ' venta' END AS series, make_date(y,12,31) AS period, CAST(sum(v) AS DOUBLE) AS value FROM li WHERE f<>'A' GROUP BY f, side, y"),
    "H14_annual_problems": (lambda s, d: L.annual_problems(saved(S.annual_histories(s, d), "sheets")), "SELECT 'Euro Fin Mes' AS source_sheet, 'not one Compra and one Venta' AS reason FROM lineitem WHERE l_returnflag='A' GROUP BY 1 UNION ALL SELECT 'Yen Fin Mes', 'unsupported currency' FROM lineitem WHERE l_returnflag='N' GROUP BY 1"),
    "H15_template_tail": (h15_tail, _H15),
    "H18_contained_names": (h18_fallback, _H18),
    "N07_ids_units_ranges": (n07_rest, _N07),
    "K01_transformation": (k01_transformation, _K01),
    "N19_linked_vintages": (n19_linked, f"WITH {_DEC}, a AS (SELECT release_id FROM dec WHERE decision='accepted' ORDER BY decided_at DESC, release_id DESC LIMIT 1) SELECT (SELECT release_id FROM a) AS active, (SELECT count(*) FROM dec WHERE decision='accepted') AS n_accepted, (SELECT count(DISTINCT o_orderpriority||':'||(o_custkey%50)) FROM orders WHERE strftime(o_orderdate,'%Y-%m')=(SELECT release_id FROM a)) AS n_vintages"),
    "N31_failed_sources": (n31_failed, "SELECT 'failed_sources' AS check_name, count(*) FILTER (WHERE n_nationkey%6=0) AS failing FROM nation UNION ALL SELECT 'unresolved_sources', count(*) FILTER (WHERE n_nationkey%6=1) FROM nation"),
    "H08_contextual_quarters": (quarter_labels, f"WITH {_LI}, b AS (SELECT DISTINCT f, y FROM li) SELECT 'SQ_'||f AS source_sheet, CAST(2+(y-1990)*5+q-1 AS BIGINT) AS column_id, CAST(y + CASE WHEN f='R' THEN 1 ELSE 0 END AS INTEGER) AS year, CAST(q AS INTEGER) AS quarter, f='A' AND y=1994 AND q=3 AS inferred FROM b, (VALUES (1),(2),(3),(4)) AS x(q)"),
    "H08_block_closing": (block_closing, f"WITH {_LI}, b AS (SELECT f, count(DISTINCT y) AS annual_columns FROM li GROUP BY 1), c AS (SELECT f, count(*) AS n, count(*) FILTER (WHERE f<>'N' OR ln%2=0) AS ok FROM (SELECT DISTINCT f, ln, y FROM li WHERE q=4) GROUP BY 1) SELECT 'SQ_'||f AS source_sheet, annual_columns, CASE WHEN f='R' THEN 0 ELSE n END AS compared, CASE WHEN f='R' THEN 0 ELSE ok END AS agreed, CASE f WHEN 'R' THEN 'no block is of its annual column''s year' WHEN 'N' THEN 'fourth quarters differ from the years that they close' END AS reason FROM b JOIN c USING (f)"),
    "H08_closed_blocks": (
        lambda s, d: G.read_as(_stock(s, d), "horizontal_year_quarter").select(*G.OUT[:4]),
        f"WITH {_LI} SELECT 'SQ_A' AS source_sheet, 'Line '||ln AS series, last_day(make_date(y, q*3, 1)) AS period, CAST(sum(v) AS DOUBLE) AS value FROM li WHERE f='A' GROUP BY ln, y, q UNION ALL SELECT 'SQ_A', 'Line '||ln||' — anual', make_date(y,12,31), CAST(sum(v) AS DOUBLE) FROM li WHERE f='A' AND q=4 GROUP BY ln, y",
    ),
}


def queries():
    return {k: v[0] for k, v in _Q.items()}


def oracle_sql():
    return {k: v[1] for k, v in _Q.items()}
