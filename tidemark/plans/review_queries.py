"""Queries of reviews, registers, gates and read helpers, with the SQL they equal."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import accounting as A
from ..operators import governance as G
from ..operators import grid as H
from ..operators import identity as I
from ..operators import marts as M
from ..operators import publication as B
from ..operators import quality as Q
from ..operators import screens
from ..operators import semantics as S
from ..operators import vintage as V
from ..reader import Store
from ..sources import derived as D
from ..sources.derived import F1, F2, F4, F6, F7
from ..sources.files import direct_panel, registry
from ..sources.stored import replace_vintages, shared_dir
from .accounting_queries import CLASSED, _grid
from .governance_queries import _OUT, _mapped, _regions
from .relational_queries import _DERIVED, _L, LINES, ORDERS, PARTS, aliases, labels
from .vintage_queries import AS_OF, _events, _realised


def _store(s, d):
    return Store(_events(s, d), D.accepted(s), _mapped(s, d).select("series_id", "concept_id"))


SOME = "orders:1-URGENT:F", "orders:5-LOW:O"
_SOME = "('orders:1-URGENT:F','orders:5-LOW:O')"
_AS_OF_SQL = f"WITH {F1} SELECT series_id, period, value, vintage_id, publication_date AS available_at, 'observed' AS observation_status FROM (SELECT *, row_number() OVER (PARTITION BY series_id, period ORDER BY publication_date DESC, vintage_id DESC) AS k FROM fact WHERE vintage_id IN ('v1','v2','v3') AND publication_date <= DATE '2000-12-31' AND series_id IN {_SOME}) WHERE k = 1 AND NOT is_deleted AND period <= publication_date"


def j03(s, d):
    """The dimension knows the series of the first vintage as daily; the others come with the defaults."""
    snaps = D.snapshots(s, d)
    known = snaps.filter("vintage_id = 'v1' and series_id like '%:O'").select("series_id", F.lit("daily").alias("frequency"), F.lit("a").alias("owner")).distinct()
    return V.registered(known, snaps, {"frequency": "monthly"})


def _decisions(s, d):
    """A release for each month of orders, decided at its last day, blocked where more than a third of its urgent orders is still open."""
    o = ORDERS(s, d)
    urgent = F.col("o_orderpriority") == "1-URGENT"
    open_ = F.count_if(urgent & (F.col("o_orderstatus") == "P")) * 3 > F.count_if(urgent)
    return o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("release_id")).agg(F.max(F.to_date("o_orderdate")).alias("decided_at"), F.when(open_, "blocked").otherwise("accepted").alias("decision"))


_DEC = "dec AS (SELECT strftime(o_orderdate,'%Y-%m') AS release_id, max(CAST(o_orderdate AS DATE)) AS decided_at, CASE WHEN 3*count(*) FILTER (WHERE o_orderstatus='P' AND o_orderpriority='1-URGENT')>count(*) FILTER (WHERE o_orderpriority='1-URGENT') THEN 'blocked' ELSE 'accepted' END AS decision FROM orders GROUP BY 1)"


def j14(s, d):
    return V.promoted(_decisions(s, d))


def j15(s, d):
    """Vintages are priorities, held by the releases of the months in which they have a large order."""
    links = ORDERS(s, d).filter("o_totalprice > 200000").select(F.date_format("o_orderdate", "yyyy-MM").alias("release_id"), F.concat_ws(":", "o_orderpriority", (F.col("o_custkey") % 50).cast("string")).alias("vintage_id")).distinct()
    return V.admitting_release(links, _decisions(s, d))


def j16(s, d):
    rows = _realised(s, d)
    return rows.filter(F.col("series_id").like("orders:1-URGENT:%") & (F.month("period") == 12)).select("series_id", F.year("period").alias("year"), "value")


def _worded(s, d):
    return PARTS(s, d).select("p_partkey", T.normalized(F.concat(F.when(F.col("p_size") % 3 == 0, "Guaraníes constantes, base ").when(F.col("p_size") % 3 == 1, "USD  Millones, base = ").otherwise("Miles de "), F.when(F.col("p_size") % 2 == 0, "1994").otherwise("unidades"))).alias("t"))


def k01(s, d):
    t = F.col("t")
    return _worded(s, d).select("p_partkey", T.first_match(t, S.UNITS).alias("unit"), S.scale_multiplier(t).alias("scale_multiplier"), S.base_year(t).alias("base_year"), S.real_or_nominal(t).alias("prices"))


_K01 = "SELECT p_partkey, CASE p_size%3 WHEN 0 THEN 'pyg' WHEN 1 THEN 'usd' END AS unit, CASE p_size%3 WHEN 1 THEN 1e6 WHEN 2 THEN 1e3 END AS scale_multiplier, CASE WHEN p_size%2=0 AND p_size%3<2 THEN 1994 END AS base_year, CASE WHEN p_size%3=0 OR (p_size%3=1 AND p_size%2=0) THEN 'real' ELSE 'nominal' END AS prices FROM part"


def k03(s, d):
    """Dimensions in long form, then one column each."""
    long = S.evidence(S.derived(labels(s, d)), "series_id", ["unit", "stock_flow", "adjustment"])
    return long.groupBy("series_id").pivot("field", ["unit", "stock_flow", "adjustment"]).agg(F.max("value"))


def _found(s, d):
    """Derived evidence, and reviewed units for every seventh series."""
    derived = S.evidence(S.derived(labels(s, d)), "series_id", ["unit", "stock_flow"]).withColumn("basis", F.lit("derived"))
    return derived.unionByName(labels(s, d).filter("series_id % 7 = 0").select("series_id", F.lit("unit").alias("field"), F.lit("pyg").alias("value"), F.lit("checked").alias("quote"), F.lit("reviewed").alias("basis")))


def k07(s, d):
    return S.measurement(labels(s, d), _found(s, d), "series_id", ["unit", "stock_flow"])


def k08(s, d):
    return S.evidence(S.derived(labels(s, d)), "series_id", ["unit", "scale_multiplier", "stock_flow"]).select("series_id", "field", F.when(F.col("field") != "scale_multiplier", F.col("value")).alias("value"), "quote")


def _sheet_reviews(s, d):
    """A status for each sheet that lineitem has: N sheets are drafts."""
    return D.grid(s, d).select("source_sheet").distinct().withColumn("status", F.when(F.col("source_sheet").startswith("N"), "draft").otherwise("validated"))


def l07(s, d):
    """Open cells of each sheet beside its review status."""
    open_ = A.classified(A.unmapped(*_grid(s, d)), D.rules(s)).filter("classification = 'unclassified'").groupBy("source_sheet").agg(F.count("*").alias("n_open"))
    return _sheet_reviews(s, d).join(open_, "source_sheet", "left").na.fill(0)


def l08(s, d):
    cells, obs = _grid(s, d)
    judged = A.classified(A.unmapped(cells, obs), D.rules(s))
    open_ = judged.filter("classification = 'unclassified'").select("source_sheet", F.lit("open cells").alias("reason"))
    defects = judged.filter("classification = 'parser_defect'").select("source_sheet", F.lit("parser defects").alias("reason"))
    out = G.outside(cells, _regions(s)).filter("num is not null").select("source_sheet", F.lit("numbers outside regions").alias("reason"))
    return A.blocked_families(_sheet_reviews(s, d), open_, defects, out)


def l11(s, d):
    """Missing periods that a token of their cell explains, with the token's meaning."""
    cells, obs = _grid(s, d)
    spans = obs.groupBy("series_id").agg(F.min("period").alias("a"), F.max("period").alias("b"))
    grid = spans.select("series_id", F.explode(F.sequence(F.trunc("a", "month"), F.trunc("b", "month"), F.expr("interval 1 month"))).alias("m")).select("series_id", F.last_day("m").alias("period"))
    meaning = F.when(F.col("reason") == "not_meaningful", "published as not meaningful").otherwise("left blank by the publisher")
    return A.missing(grid, obs, cells).filter("reason in ('not_meaningful', 'blank_cell')").select("series_id", "period", meaning.alias("meaning"))


def l12(s, d):
    register = _sheet_reviews(s, d).filter("status = 'draft'").select("source_sheet", F.lit("").alias("tok")).unionByName(s.createDataFrame([("*", "s/m")], "source_sheet string, tok string"))
    return A.token_problems(D.grid(s, d), register)


def l14(s, d):
    """Sheets where more than a twentieth of the observations come from hidden rows 40 to 44."""
    obs = _grid(s, d)[1]
    spans = _sheet_reviews(s, d).select("source_sheet", F.lit(40).alias("lo"), F.lit(44).alias("hi"))
    total = obs.groupBy("source_sheet").agg(F.count("*").alias("n"))
    return A.hidden(obs, spans).join(total, "source_sheet").filter("hidden_observations * 20 > n")


def _series_sheets(s, d):
    return LINES(s, d).select(F.col("l_orderkey").alias("series_id"), F.concat("l_returnflag", "l_linestatus").alias("source_sheet")).distinct()


_SS = "ss AS (SELECT DISTINCT l_orderkey AS series_id, l_returnflag||l_linestatus AS source_sheet FROM lineitem), rg AS (SELECT DISTINCT l_returnflag||l_linestatus AS source_sheet, CASE WHEN l_returnflag='N' THEN 'draft' ELSE 'validated' END AS status FROM lineitem WHERE l_returnflag||l_linestatus<>'AF'), st AS (SELECT ss.*, coalesce(status,'validated') AS status FROM ss LEFT JOIN rg USING (source_sheet))"


def _status_register(s, d):
    """A sheet's own entry where there is one; AF has none and takes that of '*'."""
    return _sheet_reviews(s, d).filter("source_sheet <> 'AF'").unionByName(s.createDataFrame([("*", "validated")], "source_sheet string, status string"))


def m12(s, d):
    reviewed = _series_sheets(s, d).filter("series_id % 3 > 0").select("series_id").distinct()
    return M.research_gate(_series_sheets(s, d), _status_register(s, d), reviewed)


def m13(s, d):
    """Orders' clerkless domains: a customer's priorities are sheets, two domains among them."""
    sheets = ORDERS(s, d).filter("o_totalprice > 150000").select(F.col("o_custkey").alias("series_id"), F.col("o_orderpriority").alias("source_sheet")).distinct()
    domains = sheets.select("source_sheet").distinct().filter("source_sheet <> '3-MEDIUM'").select("source_sheet", F.when(F.col("source_sheet") < "3", "prices").otherwise("money").alias("domain"))
    return M.classified_domains(sheets, domains)


def m14(s, d):
    """Members named by the identifiers of the release before, resolved into the one in force."""
    before, after = D.releases(s, d)
    resolved = I.resolution(I.migration(before, after, "sheet", "r", "c", "period"))
    register = before.select(F.concat(F.lit("canonical:"), "sheet").alias("canonical_id"), F.col("sid").alias("member_id")).distinct()
    return M.membership(register, resolved)


def m15(s, d):
    """Regimes of customers: one for each order, to the day before the next of its status; some words are unknown."""
    o = ORDERS(s, d).select(F.col("o_custkey").alias("series_id"), F.when(F.col("o_orderstatus") == "P", "other").otherwise(F.concat(F.lit("regime "), "o_orderstatus")).alias("regime"), F.to_date("o_orderdate").alias("valid_from"), F.date_add("o_orderdate", (F.col("o_orderkey") % 90 - 5).cast("int")).alias("valid_to"), "o_orderkey")
    return M.regime_problems(o.groupBy("series_id", "valid_from").agg(F.max_by(F.struct("regime", "valid_to"), "o_orderkey").alias("x")).select("series_id", "valid_from", "x.*"), ["regime F", "regime O"])


_M15 = "WITH o AS (SELECT o_custkey AS series_id, CASE WHEN o_orderstatus='P' THEN 'other' ELSE 'regime '||o_orderstatus END AS regime, CAST(o_orderdate AS DATE) AS valid_from, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 - 5 AS INT) AS valid_to, row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS k FROM orders), r AS (SELECT *, lag(valid_to) OVER (PARTITION BY series_id ORDER BY valid_from) AS b FROM o WHERE k=1), p AS (SELECT series_id, regime, valid_from, CASE WHEN regime NOT IN ('regime F','regime O') THEN 'unknown regime' WHEN valid_to<valid_from THEN 'ends before it starts' WHEN valid_from<=b THEN 'overlaps' END AS problem FROM r) SELECT * FROM p WHERE problem IS NOT NULL"


def m18(s, d):
    """Candidates for the canonical core: of each brand, the twelve parts with the most lines."""
    counted = LINES(s, d).groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n_lines"))
    rows = PARTS(s, d).select("p_partkey", "p_brand").join(counted, "p_partkey")
    return M.top_of_each(rows, "p_brand", [F.col("n_lines").desc(), "p_partkey"], 12).select("p_brand", "p_partkey", "n_lines", F.col("rank").cast("long").alias("rank"))


def m19(s, d):
    """Series whose history another one repeats: each series is there under its own name and, for one status, a second one."""
    rows = _realised(s, d).select("series_id", "period", "value")
    doubled = rows.unionByName(rows.filter("series_id like '%:F'").withColumn("series_id", F.concat("series_id", F.lit(":again"))))
    return screens.duplicate_histories(doubled).filter("n_series > 1").select("first_series", "n_series", "n_observations")


def m20(s, d):
    """A register of reviews by supplier and day with blanks, doubles and unknown words."""
    register = LINES(s, d).groupBy((F.col("l_suppkey") % 40).alias("supplier"), F.col("l_partkey").alias("part")).agg(F.min("l_returnflag").alias("state"), F.min("l_linenumber").alias("n"))
    rows = register.select(F.when(F.col("part") % 60 == 0, " ").otherwise(F.concat(F.lit("p"), F.col("part").cast("string"))).alias("entry_name"), F.col("supplier").cast("string").alias("supplier"), "state")
    return S.register_problems(rows, ["entry_name"], ["supplier", "entry_name"], {"state": ["A", "N"]}).groupBy("problem").agg(F.count("*").alias("n"))


_M20 = "WITH r AS (SELECT l_suppkey%40 AS s, l_partkey AS p, min(l_returnflag) AS state FROM lineitem GROUP BY 1,2), e AS (SELECT CASE WHEN p%60=0 THEN ' ' ELSE 'p'||p END AS nm, s, state FROM r) SELECT 'blank entry_name' AS problem, count(*) AS n FROM e WHERE nm=' ' HAVING count(*)>0 UNION ALL SELECT 'unknown state', count(*) FROM e WHERE state NOT IN ('A','N') HAVING count(*)>0 UNION ALL SELECT 'duplicate', count(*) FROM (SELECT 1 FROM e GROUP BY s, nm HAVING count(*)>1) HAVING count(*)>0"


def n04(s, d):
    unit = F.when(F.col("p_size") % 4 == 0, "pyg").when(F.col("p_size") % 4 == 1, "usd").when(F.col("p_size") % 4 == 2, "percent")
    currency = F.when(F.col("p_partkey") % 3 == 0, "PYG").when(F.col("p_partkey") % 3 == 1, "USD")
    return Q.currency_semantics(PARTS(s, d).select(F.col("p_partkey").alias("series_id"), currency.alias("currency"), unit.alias("unit")), "PYG")


_N04 = "WITH p AS (SELECT p_partkey AS series_id, CASE p_partkey%3 WHEN 0 THEN 'PYG' WHEN 1 THEN 'USD' END AS currency, CASE p_size%4 WHEN 0 THEN 'pyg' WHEN 1 THEN 'usd' WHEN 2 THEN 'percent' END AS unit FROM part), q AS (SELECT *, CASE WHEN currency IS NULL AND unit IN ('pyg','usd') THEN 'currency missing' WHEN currency IS NOT NULL AND unit IN ('percent','index') THEN 'currency on a ratio' WHEN currency='PYG' AND unit IS DISTINCT FROM 'pyg' THEN 'native currency in another unit' END AS problem FROM p) SELECT * FROM q WHERE problem IS NOT NULL"


def n07(s, d):
    """Lines as documented observations: sources are flags, series parts, periods months."""
    unit = F.when(F.col("l_partkey") % 5 == 0, "percent").when((F.col("l_partkey") % 5 == 1) & (F.col("l_suppkey") % 2 == 0), "usd").when(F.col("l_partkey") % 5 < 4, "pyg")
    return Q.documented(LINES(s, d).select(F.col("l_returnflag").alias("source_id"), F.col("l_partkey").alias("series_id"), F.last_day("l_shipdate").alias("period"), unit.alias("unit"), F.when(F.col("l_partkey") % 10 == 0, 1000.0).otherwise(1.0).alias("scale_multiplier")))


_N07 = "WITH l AS (SELECT l_returnflag AS source_id, l_partkey AS sid, last_day(CAST(l_shipdate AS DATE)) AS period, CASE WHEN l_partkey%5=0 THEN 'percent' WHEN l_partkey%5=1 AND l_suppkey%2=0 THEN 'usd' WHEN l_partkey%5<4 THEN 'pyg' END AS unit FROM lineitem), k AS (SELECT source_id, count(*) AS n_dup FROM (SELECT source_id, sid, period FROM l GROUP BY 1,2,3 HAVING count(*)>1) GROUP BY 1), m AS (SELECT source_id, count(*) FILTER (WHERE u>1) AS mixed, count(*) FILTER (WHERE u1='percent' AND sid%10=0) AS scaled FROM (SELECT source_id, sid, count(DISTINCT unit) AS u, min(unit) AS u1 FROM l GROUP BY 1,2) GROUP BY 1), t AS (SELECT source_id, count(*) AS n, count(*) FILTER (WHERE unit IS NULL) AS w FROM l GROUP BY 1) SELECT source_id, CAST(n AS BIGINT) AS n_rows, CAST(coalesce(n_dup,0) AS BIGINT) AS duplicate_keys, mixed AS mixed_units, scaled AS scaled_ratios, CAST(w AS BIGINT) AS without_unit FROM t JOIN m USING (source_id) LEFT JOIN k USING (source_id)"


def n18(s, d):
    """Reasons in use against the declared ones; a cell that was not read is always a finding."""
    cells, obs = _grid(s, d)
    spans = obs.groupBy("series_id").agg(F.min("period").alias("a"), F.max("period").alias("b"))
    grid = spans.select("series_id", F.explode(F.sequence(F.trunc("a", "month"), F.trunc("b", "month"), F.expr("interval 1 month"))).alias("m")).select("series_id", F.last_day("m").alias("period"))
    return G.undeclared(A.missing(grid, obs, cells), s.createDataFrame([("not_meaningful",), ("blank_cell",), ("series_ended",)], "reason string"), "reason")


_LOCATED = "sp AS (SELECT series_id, source_sheet, source_column, min(period) AS a, max(period) AS b FROM obs GROUP BY 1,2,3), g AS (SELECT series_id, source_sheet, source_column, last_day(CAST(unnest(generate_series(date_trunc('month',a), date_trunc('month',b), INTERVAL 1 MONTH)) AS DATE)) AS period FROM sp), ab AS (SELECT g.* FROM g WHERE NOT EXISTS (SELECT 1 FROM obs o WHERE o.series_id=g.series_id AND o.period=g.period)), ax AS (SELECT DISTINCT source_sheet, period, row_id FROM cells), lc AS (SELECT ab.series_id, ab.period, CASE WHEN ax.row_id IS NULL THEN 'period_not_in_sheet' WHEN c.num IS NOT NULL THEN 'unread_cell' WHEN c.tok='s/m' THEN 'not_meaningful' WHEN c.tok='' THEN 'blank_cell' ELSE 'absent_cell' END AS reason FROM ab LEFT JOIN ax ON ax.source_sheet=ab.source_sheet AND ax.period=ab.period LEFT JOIN cells c ON c.source_sheet=ab.source_sheet AND c.row_id=ax.row_id AND c.column_id=ab.source_column)"


def n19(s, d):
    return B.active_release(_decisions(s, d))


def n31(s, d):
    """Checks over the whole store: days without a place, concepts missing, incomplete reviews, undeclared status words."""
    o = ORDERS(s, d)
    return G.gate({
        "days_out_of_span": o.filter(~F.to_date("o_orderdate").between(date(1990, 1, 1), date(2000, 6, 30))),
        "series_without_concept": G.own_concepts(_realised(s, d), _mapped(s, d).filter("concept_id <> 'P'")),
        "sheets_unreviewed": M.sheet_status(_series_sheets(s, d), _sheet_reviews(s, d).filter("source_sheet <> 'AF'")).filter("status = 'unreviewed'"),
        "undeclared_status": o.filter(~F.col("o_orderstatus").isin("F", "O")),
    })


def a10(s, d):
    """Sheet versions of every worksheet once; the sheet HY is stored already, under its own version."""
    versions = H.version_ids(D.worksheets(s, d))
    return H.new_versions(versions, versions.filter("source_sheet = 'HY'").select("sheet_version_id")).select("source_sheet")


def a13(s, d):
    """Which worksheets changed their header text since a vintage in which one sheet's texts were upper case and another's differed."""
    now = D.worksheets(s, d)
    then = now.withColumn("text", F.when(F.col("source_sheet") == "HY", F.upper("text")).when((F.col("source_sheet") == "VD") & (F.col("row_id") == 2), F.concat("text", F.lit("x"))).otherwise(F.col("text")))
    return H.header_changes(then, now).select("source_sheet", "changed")


def a17(s, d):
    """Customers of two vintages: odd ones were known in v1 under another segment."""
    now = D.table(s, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"), F.lit("v2").alias("first_vintage_id")).filter("c_custkey % 5 <> 0")
    old = D.table(s, d, "customer").filter("c_custkey % 2 = 1").select("c_custkey", F.lit("OLD").alias("segment"), F.lit("v1").alias("first_vintage_id"))
    return M.upserted(old, now, "c_custkey")


def a19(s, d):
    """Fingerprints of a table, of its rows in another order, and of it with one value changed: which equal the first."""
    rows = D.table(s, d, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    parts = {"same": rows.orderBy(F.col("s_name").desc()), "changed": rows.withColumn("s_acctbal", F.when(F.col("s_suppkey") == 1, 0).otherwise(F.col("s_acctbal")))}
    prints = [M.content_fingerprint(r).select(F.lit(n).alias("state"), "n_rows", "hash_sum") for n, r in parts.items()]
    first = M.content_fingerprint(rows).select(F.col("hash_sum").alias("_first"))
    return prints[0].unionByName(prints[1]).crossJoin(F.broadcast(first)).select("state", "n_rows", (F.col("hash_sum") == F.col("_first")).alias("equal"))


def _text_grid(s, d):
    return D.grid(s, d).select("source_sheet", "row_id", "column_id", F.col("tok").alias("text"), "num", F.col("period").alias("date"))


def a07(s, d):
    """The entity panel with its codes as spreadsheets hold them, as numbers."""
    raw = D.panel(s, d).withColumn("codigo_entidad", F.col("codigo_entidad").cast("double"))
    return direct_panel(raw, ["fecha", "codigo_entidad", "codigo_moneda", "sub_rubro", "importe"], ["codigo_entidad", "codigo_moneda"], vintage_id="v3", source_id="panel")


def a21(s, d):
    """Formula cells of two vintages; the second is recorded again for one sheet alone and replaced as a whole."""
    path = shared_dir(s, "formulas")
    cells = D.grid(s, d).filter("column_id = 9 and row_id % 4 = 0").select("source_sheet", "row_id", "column_id")
    replace_vintages(cells.withColumn("vintage_id", F.lit("v2")).unionByName(cells.withColumn("vintage_id", F.lit("v3"))), path)
    replace_vintages(cells.filter("source_sheet = 'AF'").withColumn("vintage_id", F.lit("v3")), path)
    return s.read.schema("source_sheet string, row_id long, column_id long, vintage_id string").parquet(path)


def a24(s, d):
    """A registry written as text and read typed, counted by month."""
    path = shared_dir(s, "registry")
    ORDERS(s, d).select(F.col("o_custkey").alias("source_id"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("sha256"), F.to_date("o_orderdate").alias("publication_date")).write.option("header", True).csv(path)
    return registry(s, path).groupBy(F.last_day("publication_date").alias("month")).agg(F.count("*").alias("n_files"), F.count_distinct("source_id").alias("n_sources"), F.min("sha256").alias("first_hash"))


def a15(s, d):
    """Tables are parts, sheets brands, columns the words of a type; each brand asks for its first type, hinting at its first part."""
    named = F.concat(F.lit("t"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"))
    catalogue = PARTS(s, d).select(F.col("p_brand").alias("source_sheet"), named.alias("source_table"), F.replace("p_type", F.lit(" "), F.lit("|")).alias("columns"))
    return B.resolved_tables(catalogue, catalogue.groupBy("source_sheet").agg(F.min("columns").alias("columns"), F.min("source_table").alias("hint")).withColumn("role", F.lit("accounts")))


def a22(s, d):
    """The worklist as a written report, read again."""
    path = shared_dir(s, "worklist")
    big = ORDERS(s, d).filter("o_totalprice > 100000").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    screens.worklist(big, [F.col("price").desc(), "o_orderkey"], 25).write.option("header", True).csv(path)
    return s.read.schema("o_orderkey long, price decimal(18,2), rank long, total long").option("header", True).csv(path).withColumn("price", F.col("price").cast("double"))


def a23(s, d):
    read = LINES(s, d).filter("l_suppkey % 4 <> 1").groupBy(F.col("l_suppkey").alias("source_id")).agg(F.concat(F.lit("f"), F.max("l_partkey").cast("string")).alias("file_name"), F.count("*").alias("n_rows"))
    return B.metadata_rows(read, LINES(s, d).select(F.col("l_suppkey").alias("source_id")))


def a26(s, d):
    """All vintages are stored, then the second is stored again with other values: it alone is replaced."""
    path = shared_dir(s, "reference")
    snaps = D.snapshots(s, d).select("vintage_id", "series_id", "period", "value")
    replace_vintages(snaps, path)
    replace_vintages(snaps.filter("vintage_id = 'v2' and series_id like '%:F'").withColumn("value", F.lit(0.0)), path)
    return s.read.schema(snaps.schema).parquet(path).groupBy("vintage_id").agg(F.count("*").alias("n_rows"), F.count_if(F.col("value") == 0).alias("n_zero"))


def b10(s, d):
    """One source's rows with the names that its codes stand for; unknown codes keep their row."""
    nations = D.table(s, d, "nation").filter("n_nationkey <> 7").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return D.table(s, d, "customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey", "c_nationkey").join(nations, "c_nationkey", "left")


def h22(s, d):
    size = F.col("p_size") % 3
    label = F.when(size == 0, "Índice, base 1994").when(size == 1, "Saldo").otherwise(None)
    return S.measures(PARTS(s, d).select("p_partkey", label.alias("label"), F.when(F.col("p_partkey") % 2 == 0, "Millones de USD").alias("title"))).select("p_partkey", "unit", "scale_multiplier", "base_year")


def n24(s, d):
    """Records of parts' names; every tenth file holds other bytes, every 25th is gone, and every 30th record."""
    name = F.concat(F.lit("f"), F.col("p_partkey").cast("string")).alias("file_name")
    found = PARTS(s, d).filter("p_partkey % 25 <> 0").select(name, F.sha2(F.concat("p_name", F.when(F.col("p_partkey") % 10 == 0, "!").otherwise("")), 256).alias("sha256"))
    return Q.archive_problems(found, PARTS(s, d).filter("p_partkey % 30 <> 0").select(name, F.sha2("p_name", 256).alias("sha256")))


_Q = {
    "A07_direct_panel": (a07, f"WITH {F6} SELECT fecha, codigo_entidad, codigo_moneda, sub_rubro, importe, 'v3' AS vintage_id, 'panel' AS source_id FROM panel"),
    "A21_formula_cells": (a21, f"WITH {F2}, f AS (SELECT source_sheet, row_id, column_id FROM cells WHERE column_id=9 AND row_id%4=0) SELECT *, 'v2' AS vintage_id FROM f UNION ALL SELECT *, 'v3' FROM f WHERE source_sheet='AF'"),
    "A24_file_registry": (a24, "SELECT last_day(CAST(o_orderdate AS DATE)) AS month, count(*) AS n_files, count(DISTINCT o_custkey) AS n_sources, min(sha256(CAST(o_orderkey AS VARCHAR))) AS first_hash FROM orders GROUP BY 1"),
    "A25_report_coverage": (lambda s, d: H.report_coverage(_text_grid(s, d)).drop("sheet_version_id"), f"WITH {F2} SELECT source_sheet, max(row_id) AS last_row, max(column_id) AS last_column, count(num) AS n_numbers, count(tok) AS n_texts, count(*) AS n_cells FROM cells GROUP BY 1"),
    "A15_resolved_tables": (a15, "WITH c AS (SELECT p_brand AS source_sheet, 't'||lpad(CAST(p_partkey AS VARCHAR),9,'0') AS t, replace(p_type,' ','|') AS k FROM part), s AS (SELECT source_sheet, min(k) AS k, min(t) AS hint FROM c GROUP BY 1), j AS (SELECT source_sheet, count(*) AS n, max(t) AS one, count(*) FILTER (WHERE t=hint) AS h, max(hint) AS hint FROM s JOIN c USING (source_sheet, k) GROUP BY 1) SELECT 'accounts' AS role, source_sheet, n AS n_tables, CASE WHEN n=1 THEN one WHEN h=1 THEN hint END AS source_table, CASE WHEN n=1 OR h=1 THEN 'resolved' ELSE 'ambiguous' END AS state FROM j"),
    "A22_worklist_report": (a22, "WITH b AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders WHERE o_totalprice>100000) SELECT o_orderkey, CAST(price AS DOUBLE) AS price, row_number() OVER (ORDER BY price DESC, o_orderkey) AS rank, count(*) OVER () AS total FROM b ORDER BY price DESC, o_orderkey LIMIT 25"),
    "A23_metadata_rows": (a23, "SELECT l_suppkey AS source_id, CASE WHEN l_suppkey%4<>1 THEN 'f'||max(l_partkey) END AS file_name, CASE WHEN l_suppkey%4<>1 THEN count(*) ELSE 0 END AS n_rows, CASE WHEN l_suppkey%4<>1 THEN 'read' ELSE 'failed' END AS state FROM lineitem GROUP BY l_suppkey"),
    "A26_snapshot_per_vintage": (a26, f"WITH {F1} SELECT vintage_id, CASE WHEN vintage_id='v2' THEN count(*) FILTER (WHERE series_id LIKE '%:F') ELSE count(*) END AS n_rows, CASE WHEN vintage_id='v2' THEN count(*) FILTER (WHERE series_id LIKE '%:F') ELSE 0 END AS n_zero FROM snap GROUP BY 1"),
    "B10_source_lookups": (b10, "SELECT c_custkey, c_nationkey, CASE WHEN n_nationkey<>7 THEN n_name END AS n_name FROM customer LEFT JOIN nation ON n_nationkey=c_nationkey WHERE c_mktsegment='BUILDING'"),
    "H22_measures": (h22, "SELECT p_partkey, CASE WHEN p_size%3=0 THEN 'index' WHEN p_partkey%2=0 THEN 'usd' END AS unit, CASE WHEN p_partkey%2=0 THEN 1e6 END AS scale_multiplier, CASE WHEN p_size%3=0 THEN 1994 END AS base_year FROM part"),
    "N24_archive_integrity": (n24, "SELECT 'f'||p_partkey AS file_name, CASE WHEN p_partkey%25=0 THEN 'missing' WHEN p_partkey%30=0 THEN 'unrecorded' ELSE 'other bytes' END AS problem FROM part WHERE (p_partkey%25=0 AND p_partkey%30<>0) OR (p_partkey%25<>0 AND p_partkey%30=0) OR (p_partkey%10=0 AND p_partkey%25<>0 AND p_partkey%30<>0)"),
    "O08_migration_summary": (lambda s, d: I.migration_job(*D.releases(s, d), "sheet", "r", "c", "period")[1], f"WITH {F4} SELECT relation, count(DISTINCT old_id) AS n_old, count(DISTINCT new_id) AS n_new, CAST(sum(shared) AS BIGINT) AS shared_cells FROM cl GROUP BY 1"),
    "A10_new_versions": (a10, f"WITH {F7} SELECT DISTINCT source_sheet FROM read WHERE source_sheet <> 'HY'"),
    "A13_header_changes": (a13, f"WITH {F7} SELECT DISTINCT source_sheet, source_sheet = 'VD' AS changed FROM read"),
    "A17_upsert": (a17, "SELECT c_custkey, CASE WHEN c_custkey%5<>0 THEN c_mktsegment ELSE 'OLD' END AS segment, CASE WHEN c_custkey%2=1 THEN 'v1' ELSE 'v2' END AS first_vintage_id FROM customer WHERE c_custkey%5<>0 OR c_custkey%2=1"),
    "A19_fingerprints": (a19, "SELECT x.s AS state, (SELECT count(*) FROM supplier) AS n_rows, x.s='same' AS equal FROM (VALUES ('same'),('changed')) AS x(s)"),
    "J03_series_dimension": (j03, f"WITH {F1} SELECT DISTINCT series_id, CASE WHEN k THEN 'daily' ELSE 'monthly' END AS frequency, CASE WHEN k THEN 'a' END AS owner FROM (SELECT series_id, bool_or(vintage_id='v1' AND series_id LIKE '%:O') AS k FROM snap GROUP BY 1)"),
    "J11_series_latest": (lambda s, d: _store(s, d).latest(*SOME), f"WITH {F1} SELECT * FROM realised WHERE series_id IN {_SOME}"),
    "J11_series_as_of": (lambda s, d: _store(s, d).as_of(AS_OF, *SOME), _AS_OF_SQL),
    "J11_revision_history": (lambda s, d: _store(s, d).revision_history(*SOME), f"WITH {F1} SELECT * FROM fact WHERE vintage_id IN ('v1','v2','v3') AND series_id IN {_SOME}"),
    "J11_by_concept": (lambda s, d: _store(s, d).by_concept("F", "P"), f"WITH {F1} SELECT *, split_part(series_id,':',3) AS concept_id FROM realised WHERE split_part(series_id,':',3) IN ('F','P')"),
    "J14_promotion": (j14, f"WITH {_DEC} SELECT *, coalesce(release_id = (SELECT arg_max(release_id, (decided_at, release_id)) FROM dec WHERE decision='accepted'), FALSE) AS is_active FROM dec"),
    "J15_admitting_release": (j15, f"WITH {_DEC}, l AS (SELECT DISTINCT strftime(o_orderdate,'%Y-%m') AS release_id, o_orderpriority||':'||CAST(o_custkey%50 AS VARCHAR) AS vintage_id FROM orders WHERE o_totalprice>200000) SELECT vintage_id, arg_min(release_id, (decided_at, release_id)) AS release_id, min(decided_at) AS admitted_at FROM l JOIN dec USING (release_id) WHERE decision='accepted' GROUP BY 1"),
    "J16_annual_operations": (j16, f"WITH {F1} SELECT series_id, year(period) AS year, value FROM realised WHERE series_id LIKE 'orders:1-URGENT:%' AND month(period)=12"),
    "K01_units_scales": (k01, _K01),
    "K03_dimensions": (k03, f"WITH {_L}, v AS (SELECT {_DERIVED} FROM n) SELECT series_id, unit, stock_flow, adjustment FROM v"),
    "K07_measurement": (k07, f"WITH {_L}, v AS (SELECT {_DERIVED} FROM n) SELECT series_id, CASE WHEN series_id%7=0 THEN 'pyg' ELSE unit END AS unit, CASE WHEN series_id%7=0 THEN 'reviewed' WHEN unit IS NULL THEN 'unknown' ELSE 'derived' END AS unit_basis, stock_flow, CASE WHEN stock_flow IS NULL THEN 'unknown' ELSE 'derived' END AS stock_flow_basis FROM v"),
    "K08_evidence": (k08, f"WITH {_L}, v AS (SELECT {_DERIVED} FROM n) SELECT series_id, 'unit' AS field, unit AS value, evidence AS quote FROM v WHERE unit IS NOT NULL UNION ALL SELECT series_id, 'scale_multiplier', NULL, evidence FROM v WHERE scale_multiplier IS NOT NULL UNION ALL SELECT series_id, 'stock_flow', stock_flow, evidence FROM v WHERE stock_flow IS NOT NULL"),
    "L07_open_by_review": (l07, f"WITH {F2}, {CLASSED}, o AS (SELECT source_sheet, count(*) AS n FROM classed WHERE classification='unclassified' GROUP BY 1) SELECT source_sheet, CASE WHEN source_sheet LIKE 'N%' THEN 'draft' ELSE 'validated' END AS status, coalesce(n,0) AS n_open FROM (SELECT DISTINCT source_sheet FROM cells) LEFT JOIN o USING (source_sheet)"),
    "L08_blocked_families": (l08, f"WITH {F2}, {CLASSED}, {_OUT}, r AS (SELECT source_sheet, CASE classification WHEN 'unclassified' THEN 'open cells' ELSE 'parser defects' END AS reason FROM classed WHERE classification IN ('unclassified','parser_defect') UNION SELECT source_sheet, 'numbers outside regions' FROM out WHERE num IS NOT NULL) SELECT source_sheet, string_agg(reason, ';' ORDER BY reason) AS reasons FROM r WHERE source_sheet NOT LIKE 'N%' GROUP BY 1"),
    "L11_explained_gaps": (l11, f"WITH {F2}, {_LOCATED} SELECT series_id, period, CASE reason WHEN 'not_meaningful' THEN 'published as not meaningful' ELSE 'left blank by the publisher' END AS meaning FROM lc WHERE reason IN ('not_meaningful','blank_cell')"),
    "L12_token_register": (l12, f"WITH {F2} SELECT source_sheet, tok, count(*) AS n_cells FROM cells WHERE tok='' AND source_sheet NOT LIKE 'N%' GROUP BY 1,2"),
    "L14_hidden_share": (l14, f"WITH {F2}, h AS (SELECT source_sheet, count(*) AS n, count(*) FILTER (WHERE source_row BETWEEN 40 AND 44) AS hidden_observations, count(DISTINCT CASE WHEN source_row BETWEEN 40 AND 44 THEN source_row END) AS hidden_rows FROM obs GROUP BY 1) SELECT source_sheet, hidden_observations, hidden_rows, n FROM h WHERE hidden_observations*20>n"),
    "M05_alias_ends": (lambda s, d: I.closure(aliases(s, d)).groupBy("old_id").agg(F.min("new_id").alias("ends_in"), F.count("*").alias("n_steps")), "WITH RECURSIVE a AS (SELECT c_custkey AS old_id, c_custkey // 3 AS new_id FROM customer WHERE c_custkey>=3), r AS (SELECT old_id, new_id FROM a UNION SELECT r.old_id, a.new_id FROM r JOIN a ON a.old_id=r.new_id) SELECT old_id, min(new_id) AS ends_in, count(*) AS n_steps FROM r GROUP BY 1"),
    "M11_sheet_status": (lambda s, d: M.sheet_status(_series_sheets(s, d), _status_register(s, d)), f"WITH {_SS} SELECT * FROM st"),
    "M12_research_gate": (m12, f"WITH {_SS} SELECT series_id, count(*) AS n_sheets, count(*) FILTER (WHERE status='validated') AS n_validated FROM st WHERE series_id%3>0 GROUP BY 1 HAVING bool_and(status='validated')"),
    "M13_domains": (m13, "WITH s AS (SELECT DISTINCT o_custkey AS series_id, CASE WHEN o_orderpriority<'3' THEN 'prices' WHEN o_orderpriority<>'3-MEDIUM' THEN 'money' END AS domain FROM orders WHERE o_totalprice>150000) SELECT series_id, count(DISTINCT domain) AS n_domains, CASE WHEN count(DISTINCT domain)=1 THEN max(domain) END AS domain FROM s GROUP BY 1"),
    "M14_membership": (m14, f"WITH {F4}, n AS (SELECT old_id, count(DISTINCT new_id) AS k, max(new_id) AS one FROM cl WHERE old_id IS NOT NULL GROUP BY 1), m AS (SELECT DISTINCT 'canonical:'||sheet AS canonical_id, sid AS member_id FROM prv) SELECT canonical_id, member_id, CASE WHEN k=1 THEN one END AS resolved_id, CASE WHEN k>1 THEN 'ambiguous' WHEN k=1 THEN 'resolved' ELSE 'unresolved' END AS state FROM m LEFT JOIN n ON old_id=member_id"),
    "M15_regime_problems": (m15, _M15),
    "M18_core_candidates": (m18, "WITH c AS (SELECT l_partkey AS p_partkey, count(*) AS n_lines FROM lineitem GROUP BY 1), r AS (SELECT p_brand, p_partkey, n_lines, row_number() OVER (PARTITION BY p_brand ORDER BY n_lines DESC, p_partkey) AS rank FROM part JOIN c USING (p_partkey)) SELECT * FROM r WHERE rank<=12"),
    "M19_duplicate_histories": (m19, f"WITH {F1} SELECT series_id AS first_series, CAST(2 AS BIGINT) AS n_series, count(*) AS n_observations FROM realised WHERE series_id LIKE '%:F' GROUP BY 1"),
    "M20_register_guard": (m20, _M20),
    "N02_duplicate_keys": (lambda s, d: Q.duplicate_keys(LINES(s, d), "l_partkey", "l_suppkey", "l_linenumber"), "SELECT l_partkey, l_suppkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1,2,3 HAVING count(*)>1"),
    "N04_currency_semantics": (n04, _N04),
    "N07_documented_source": (n07, _N07),
    "N18_missing_reasons": (n18, f"WITH {F2}, {_LOCATED}, u AS (SELECT reason, count(*) AS n FROM lc GROUP BY 1) SELECT coalesce(u.reason, x.reason) AS reason, coalesce(n,0) AS n, CASE WHEN n IS NULL THEN 'unused' ELSE 'undeclared' END AS problem FROM u FULL JOIN (VALUES ('not_meaningful'),('blank_cell'),('series_ended')) AS x(reason) ON u.reason=x.reason WHERE n IS NULL OR x.reason IS NULL"),
    "N19_active_release": (n19, f"WITH {_DEC} SELECT arg_max(release_id, decided_at) AS active, count(*) AS n_accepted FROM dec WHERE decision='accepted'"),
    "N25_provenance_gaps": (lambda s, d: B.incomplete(ORDERS(s, d).select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("publication_date"), F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("authority")), ["publication_date", "authority"], "o_orderkey"), "SELECT o_orderkey, 'publication_date' AS field FROM orders WHERE o_orderstatus='P' UNION ALL SELECT o_orderkey, 'authority' FROM orders WHERE o_orderpriority='4-NOT SPECIFIED'"),
    "N29_open_regions": (lambda s, d: G.region_completeness(D.grid(s, d), _regions(s)).filter("n_numbers_outside * 4 > n_cells"), f"WITH {F2}, {_OUT}, c AS (SELECT source_sheet, count(*) AS n_cells FROM cells GROUP BY 1), o AS (SELECT source_sheet, count(*) AS n_outside, count(num) AS n_numbers_outside FROM out GROUP BY 1) SELECT * FROM c JOIN o USING (source_sheet) WHERE n_numbers_outside*4>n_cells"),
    "N31_store_checks": (n31, f"WITH {F1}, {_SS} SELECT 'days_out_of_span' AS check_name, count(*) AS failing FROM orders WHERE CAST(o_orderdate AS DATE) NOT BETWEEN DATE '1990-01-01' AND DATE '2000-06-30' UNION ALL SELECT 'series_without_concept', count(DISTINCT series_id) FROM realised WHERE series_id LIKE '%:P' UNION ALL SELECT 'sheets_unreviewed', count(*) FROM ss WHERE source_sheet='AF' UNION ALL SELECT 'undeclared_status', count(*) FROM orders WHERE o_orderstatus NOT IN ('F','O')"),
}


def queries():
    return {k: v[0] for k, v in _Q.items()}


def oracle_sql():
    return {k: v[1] for k, v in _Q.items()}
