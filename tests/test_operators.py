"""Operators on small literal tables: the cases that the driver's tables do not hold."""

from datetime import date

from pyspark.sql import functions as F

from tidemark.functions import periods as P
from tidemark.functions import text as T
from tidemark.operators import accounting as A
from tidemark.operators import identity as I
from tidemark.operators import layouts as L
from tidemark.operators import marts as M
from tidemark.operators import quality as Q
from tidemark.operators import screens
from tidemark.operators import semantics as S
from tidemark.operators import vintage as V

EVENT = "series_id string, period date, vintage_id string, publication_date date, value double, is_deleted boolean"


def d(y, m, day=1):
    return date(y, m, day)


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_latest_filters_before_ranking_and_drops_tombstones_after(spark):
    events = spark.createDataFrame(
        [
            ("a", d(2020, 1), "v1", d(2020, 2), 1.0, False),
            ("a", d(2020, 1), "v2", d(2020, 3), None, True),
            ("a", d(2020, 1), "v3", d(2020, 4), 3.0, False),
            ("b", d(2020, 6), "v1", d(2020, 2), 5.0, False),
            ("c", d(2020, 1), "v0", None, 7.0, False),
            ("c", d(2020, 1), "v1", d(2020, 2), 8.0, False),
        ],
        EVENT,
    )
    accepted = spark.createDataFrame([("v0",), ("v1",), ("v2",)], "vintage_id string")
    got = V.latest(events, accepted)
    assert rows(got, "series_id", "value", "observation_status") == [("b", 5.0, "after_publication"), ("c", 8.0, "observed")]
    assert rows(V.latest(events), "series_id", "value") == [("a", 3.0), ("b", 5.0), ("c", 8.0)]
    assert V.projections(got).count() == V.realised(got).count() == 1


def test_as_of_sees_nothing_later(spark):
    events = spark.createDataFrame([("a", d(2020, 1), f"v{i}", d(2020, 1 + i), 100.0 * i, False) for i in (1, 2, 3)], EVENT)
    known = spark.createDataFrame([("v1", d(2020, 2)), ("v2", d(2020, 3))], "vintage_id string, available_at date")
    for day, value in ((d(2020, 2, 15), 100.0), (d(2020, 12), 200.0)):
        assert rows(V.as_of(events, known, day), "value") == [(value,)]
    assert V.as_of(events, known, d(2020, 1)).count() == 0


def test_incremental_events(spark):
    latest = spark.createDataFrame([("a", d(2020, 1), 1.0), ("a", d(2020, 2), 2.0), ("b", d(2020, 1), 3.0)], "series_id string, period date, value double")
    new = spark.createDataFrame([("a", d(2020, 1), "v9", d(2021, 1), 1.0 + 1e-13), ("a", d(2020, 2), "v9", d(2021, 1), 2.5), ("c", d(2020, 1), "v9", d(2021, 1), 4.0)], "series_id string, period date, vintage_id string, publication_date date, value double")
    assert rows(V.incremental_events(latest, new).na.fill(-1.0), "series_id", "value", "is_deleted") == [("a", 2.5, False), ("b", -1.0, True), ("c", 4.0, False)]


def test_publication_date_by_authority_and_availability(spark):
    c = spark.createDataFrame([("v1", 1, d(2020, 9)), ("v1", 3, d(2020, 5)), ("v2", 2, None), ("v2", 1, d(2020, 7))], "vintage_id string, authority int, candidate date")
    assert rows(V.publication_dates(c), "vintage_id", "publication_date", "authority") == [("v1", d(2020, 5), 3), ("v2", d(2020, 7), 1)]
    v = spark.createDataFrame([("a", d(2020, 1), d(2020, 3)), ("b", None, d(2020, 3)), ("c", d(2020, 1), d(2020, 3))], "vintage_id string, publication_date date, ingested_on date")
    p = spark.createDataFrame([("c", d(2019, 12))], "vintage_id string, provenance_date date")
    assert rows(V.availability(v, p), "vintage_id", "available_at", "completeness") == [("a", d(2020, 1), "published_only"), ("b", d(2020, 3), "ingestion_only"), ("c", d(2019, 12), "complete")]


def test_release_decisions_stay(spark):
    releases = spark.createDataFrame([("r1",), ("r2",), ("r3",)], "release_id string")
    flags = spark.createDataFrame([("r1", "error"), ("r2", "warning"), ("r3", "error")], "release_id string, severity string")
    decided = spark.createDataFrame([("r3",)], "release_id string")
    assert rows(V.decide(flags, releases, decided), "release_id", "decision") == [("r1", "blocked"), ("r2", "accepted")]


def test_append_is_idempotent(spark):
    stored = spark.createDataFrame([("v1", 1)], "vintage_id string, x int")
    assert rows(V.append_new(stored, spark.createDataFrame([("v1", 2), ("v2", 3)], "vintage_id string, x int")), "x") == [(3,)]


def test_surrogate_keys_follow_the_largest(spark):
    known = spark.createDataFrame([("a", 7), ("b", 3)], "series_id string, series_sk long")
    ids = spark.createDataFrame([(c,) for c in "abcdd"], "series_id string")
    got = dict(rows(V.surrogate_keys(known, ids), "series_id", "series_sk"))
    assert got["a"] == 7 and got["b"] == 3 and {got["c"], got["d"]} == {8, 9}


def test_numbers_and_labels(spark):
    t = spark.createDataFrame([("1.234,50",), ("12,5",), ("1.23,4",), ("12abc",), ("",), (None,), ("-7",)], "t string")
    got = t.select(T.decimal_comma(F.col("t")).alias("v"), T.malformed_number(F.col("t")).alias("bad"), T.blank(F.col("t")).alias("blank")).collect()
    assert [r["v"] for r in got] == [1234.5, 12.5, None, None, None, None, -7.0]
    assert [bool(r["bad"]) for r in got] == [False, False, True, True, False, False, False]
    one = spark.range(1).select(
        T.normalized(F.lit("  Índice  de\tPRECIOS ")).alias("n"), T.slug(F.lit("Año 2020 (*)")).alias("s"), T.year_label(F.lit("2021 (*)")).alias("y"), T.year_label(F.lit("20211")).alias("no"),
        T.quarter_number(F.lit("3er. trim")).alias("q"), T.month_number(F.lit("setiembre")).alias("m"), T.column_number(F.lit("AA")).alias("c"), T.expanded_year(F.lit(39)).alias("e39"), T.expanded_year(F.lit(40)).alias("e40"),
        T.path(F.lit("a"), F.lit(None).cast("string"), F.lit(" "), F.lit("b"), F.lit("a")).alias("p"), T.only_match(F.lit("saldo y flujo"), S.STOCK_FLOW).alias("two"), T.without_footnote(F.lit("Total (1)")).alias("w"),
    ).first()
    assert tuple(one) == ("indice de precios", "ano_2020", 2021, None, 3, 9, 27, 2039, 1940, "a — b", "not_reviewed", "Total")


def test_periods(spark):
    one = spark.range(1).select(
        P.quarter_end(F.lit(2020), F.lit(1)).alias("q"), P.months_between_ends(F.lit(d(2020, 3, 1)), F.lit(d(2020, 2, 29))).alias("m"), P.serial_date(F.lit(43831)).alias("s"), P.serial_date(F.lit(5)).alias("none"),
        P.expected(F.lit(d(2020, 1, 31)), F.lit(d(2020, 7, 31)), 3).alias("e"), P.typed_date(F.lit("31/12/2019")).alias("t"),
    ).first()
    assert tuple(one) == (d(2020, 3, 31), 1, d(2020, 1, 1), None, [d(2020, 1, 31), d(2020, 4, 30), d(2020, 7, 31)], d(2019, 12, 31))


def test_rule_precedence(spark):
    cells = spark.createDataFrame([("A", 1, 1, 1.0), ("A", 5, 5, 1.0), ("B", 1, 1, 1.0)], "source_sheet string, row_id long, column_id long, num double")
    rules = spark.createDataFrame([("z", "*", 0, 1, 0, 1, "wild_small"), ("y", "A", 0, 9, 0, 9, "large"), ("x", "A", 0, 2, 0, 2, "small"), ("w", "A", 0, 2, 0, 2, "small_first")], "rule_id string, source_sheet string, row_from long, row_to long, column_from long, column_to long, classification string")
    assert rows(A.classified(cells, rules), "source_sheet", "row_id", "classification") == [("A", 1, "small_first"), ("A", 5, "large"), ("B", 1, "wild_small")]


def test_wildcard_and_spans(spark):
    cells = spark.createDataFrame([("x", "A"), ("x", "B"), ("y", "A")], "tok string, source_sheet string")
    register = spark.createDataFrame([("x", "*", "any"), ("x", "A", "exact")], "tok string, source_sheet string, meaning string")
    got = sorted((r["tok"], r["source_sheet"], r["meaning"] or "") for r in A.wildcard_join(cells, register, "tok", ["meaning"]).collect())
    assert got == [("x", "A", "exact"), ("x", "B", "any"), ("y", "A", "")]
    packed = spark.createDataFrame([("A", "3-9;20")], "source_sheet string, hidden string")
    assert rows(A.spans(packed, "hidden"), "lo", "hi") == [(3, 9), (20, 20)]
    numbers = spark.createDataFrame([("A", n) for n in (1, 2, 3, 7, 8, 10, 10)], "k string, n long")
    assert rows(A.packed(numbers, "k", "n"), "lo", "hi") == [(1, 3), (7, 8), (10, 10)]


def test_relations_and_resolution(spark):
    pairs = spark.createDataFrame([("a", "a", 1), ("b", "c", 1), ("d", "e", 1), ("d", "f", 1), ("g", "f", 1)], "old_id string, new_id string, shared long")
    got = I.relations(pairs)
    assert rows(got, "old_id", "new_id", "relation") == [("a", "a", "identical"), ("b", "c", "renamed"), ("d", "e", "split"), ("d", "f", "split_and_merged"), ("g", "f", "merged")]
    assert sorted((r["old_id"], r["resolved_id"] or "") for r in I.resolution(got).collect()) == [("a", "a"), ("b", "c"), ("d", ""), ("g", "f")]


def test_closure_and_cycles(spark):
    alias = spark.createDataFrame([("a", "b"), ("b", "c"), ("b", "d"), ("d", "e")], "old_id string, new_id string")
    assert rows(I.closure(alias), "old_id", "new_id") == [("a", "b"), ("a", "c"), ("a", "d"), ("a", "e"), ("b", "c"), ("b", "d"), ("b", "e"), ("d", "e")]
    parents = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("e", None)], "child string, parent string")
    assert rows(I.in_cycle(parents, "child", "parent"), "child") == [("a",), ("b",), ("c",)]


def test_screens(spark):
    values = [("s", d(2020, m, 28), 100.0 + m + (500 if m == 9 else 0)) for m in range(1, 13) if m != 4] + [("s", d(2021, m, 28), 112.0 + m) for m in range(1, 13)] + [("s", d(2022, m, 28), 124.0 + m) for m in range(1, 6)]
    frame = spark.createDataFrame(values, "series_id string, period date, value double")
    assert rows(screens.gaps(frame, 1), "period", "missing_periods") == [(d(2020, 5, 28), 1)]
    assert rows(screens.jumps(frame), "period") == [(d(2020, 9, 28),), (d(2020, 10, 28),)]
    assert rows(screens.worklist(frame, [F.col("value").desc()], 2), "rank", "total") == [(1, 28), (2, 28)]


def test_register_and_review(spark):
    register = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", ""), ("c", "z")], "k string, v string")
    assert rows(S.register_problems(register, ["v"], ["k"], {"v": ["x", ""]}), "entry", "problem") == [("a", "duplicate"), ("b", "blank v"), ("c", "unknown v")]
    own = spark.createDataFrame([("a", "u1"), ("b", None), ("c", None)], "k string, unit string")
    over = spark.createDataFrame([("b", "u2")], "k string, unit string")
    assert sorted((r["k"], r["unit"] or "", r["unit_basis"]) for r in S.reviewed(own, over, "k", ["unit"]).collect()) == [("a", "u1", "derived"), ("b", "u2", "reviewed"), ("c", "", "unknown")]


def test_marts(spark):
    sheets = spark.createDataFrame([("s", "A"), ("s", "B"), ("t", "A")], "series_id string, source_sheet string")
    status = spark.createDataFrame([("A", "validated")], "source_sheet string, status string")
    assert rows(M.research_gate(sheets, status), "series_id") == [("t",)]
    old = spark.createDataFrame([("a", "v1", "x"), ("b", "v1", "y")], "k string, first_vintage_id string, name string")
    new = spark.createDataFrame([("a", "v2", "z"), ("c", "v2", "w")], "k string, first_vintage_id string, name string")
    assert rows(M.upserted(old, new, "k"), "k", "first_vintage_id", "name") == [("a", "v1", "z"), ("b", "v1", "y"), ("c", "v2", "w")]
    assert not M.changed(old, old.orderBy(F.desc("k"))) and M.changed(old, new)


def test_quality_rules(spark):
    keys = spark.createDataFrame([(1, None), (1, None), (2, 1)], "a int, b int")
    found = Q.duplicate_keys(keys, "a", "b")
    assert rows(found, "a", "n_rows") == [(1, 2)]
    assert rows(Q.all_flags(Q.flags("N02", "error", found, "a", "n_rows")), "rule", "severity", "subject", "detail") == [("N02", "error", "1", "2")]


def test_events_of_gaps(spark):
    vintages = spark.createDataFrame([("v1", None), ("v2", None), ("v3", None)], "vintage_id string, publication_date date")
    snaps = spark.createDataFrame([("s", 1, "v1", 1.0), ("s", 1, "v3", 1.0), ("s", 2, "v2", 5.0), ("s", 3, "v1", None), ("s", 3, "v3", 2.0)], "series_id string, period int, vintage_id string, value double")
    events = V.sparse_events(snaps, vintages)
    assert sorted((r["period"], r["vintage_id"], r["value"], r["is_deleted"]) for r in events.collect() if not r["is_deleted"]) == [(1, "v1", 1.0, False), (1, "v3", 1.0, False), (2, "v2", 5.0, False), (3, "v3", 2.0, False)]
    assert sorted((r["period"], r["vintage_id"]) for r in events.filter("is_deleted").collect()) == [(1, "v2"), (2, "v3")]
    assert sorted((r["period"], r["previous_vintage"], r["new_vintage"], r["kind"]) for r in V.revisions(snaps, vintages).collect()) == [(1, "v1", "v2", "removed"), (2, "v2", "v3", "removed")]


def test_axis_labels(spark):
    df = spark.createDataFrame([("2001-02",), ("feb-39",), ("Feb-40",), ("31-abr-10",), ("28-feb-11",), ("abc-10",), ("",), (None,)], "t string")
    assert [str(r[0]) for r in df.select(T.axis_date(F.col("t"))).collect()] == ["2001-02-28", "2039-02-28", "1940-02-29", "None", "2011-02-28", "None", "None", "None"]
    df = spark.createDataFrame([("ene/jun",), ("jun/ene",), ("ene",), ("x/jun",), (None,)], "t string")
    assert [tuple(r) for r in df.select(*T.month_interval(F.col("t"))).collect()] == [(1, 6), (None, None), (None, None), (None, None), (None, None)]


def test_sheets_without_anchors_are_named(spark):
    cells = spark.createDataFrame([("a", 1, 1, "Periodo", None, None), ("a", 3, 1, "Periodo", None, None), ("a", 4, 2, None, 1.0, None), ("b", 1, 1, "x", None, None)], "source_sheet string, row_id long, column_id long, text string, num double, date date")
    read = L.anchored(cells, "periodo")
    assert read.count() == 0
    assert rows(L.unread(cells, read), "source_sheet", "n_numbers") == [("a", 1)]
    for layout in (L.fiscal_years, L.daily_quotes, L.year_blocks, L.survey, L.variable_blocks, L.row_events, L.component_blocks):
        assert layout(cells).count() == 0 and layout(cells.limit(0)).count() == 0


def test_status_of_sheets(spark):
    sheets = spark.createDataFrame([("s", "a"), ("s", "b"), ("t", "a")], "series_id string, source_sheet string")
    register = spark.createDataFrame([("a", "validated")], "source_sheet string, status string")
    assert rows(M.sheet_status(sheets, register), "series_id", "status") == [("s", "unreviewed"), ("s", "validated"), ("t", "validated")]
    assert rows(M.research_gate(sheets, register), "series_id") == [("t",)]


# Registers, layouts with dates and quarters, dimensions, kept tables and the SQL interface.


REVIEW = ["series_id", "definition", "reviewed_by", "reviewed_at", "stock_flow", "nominal_real", "hierarchy_role", "parent_series_id", "comparability", "methodology_regime_id", "price_base_year", "scale_multiplier", "frequency"]


def review(spark, *changes):
    whole = dict.fromkeys(REVIEW) | {"definition": "the publisher's own words here", "reviewed_by": "a", "reviewed_at": "2024-02-01", "stock_flow": "stock", "nominal_real": "nominal", "hierarchy_role": "total", "comparability": "comparable"}
    return spark.createDataFrame([tuple((whole | {"series_id": f"s{i}"} | c)[k] for k in REVIEW) for i, c in enumerate(changes)], ", ".join(f"{c} string" for c in REVIEW))


def test_review_register_is_applied_whole(spark):
    from tidemark.operators import registers as R

    known = spark.createDataFrame([(f"s{i}", "monthly") for i in range(20)], "series_id string, frequency string")
    clean = review(spark, {}, {"frequency": " monthly "}, {"hierarchy_role": "component", "parent_series_id": "s0"}, {"nominal_real": "real", "price_base_year": "1994"})
    assert R.review_problems(clean, known).isEmpty() and R.applied_whole(clean, R.review_problems(clean, known)).count() == 4
    faults = [
        ({"definition": " "}, "definition is blank"), ({"reviewed_by": None}, "reviewed_by is blank"), ({"reviewed_at": "2024-13-01"}, "reviewed_at is no date"), ({"stock_flow": "both"}, "stock_flow is none of its words"),
        ({"scale_multiplier": "many"}, "scale_multiplier is no number"), ({"definition": "short"}, "definition is too short to quote the publisher"), ({"nominal_real": "real"}, "real without price_base_year"),
        ({"hierarchy_role": "component"}, "component without parent_series_id"), ({"comparability": "break"}, "not comparable without methodology_regime_id"), ({"series_id": "zz"}, "series_id names no series"),
        ({"parent_series_id": "zz"}, "parent_series_id names no series"), ({"frequency": "annual"}, "frequency is another than the series has"),
    ]
    register = review(spark, *(c for c, _ in faults), {"series_id": "s1"})
    problems = R.review_problems(register, known)
    assert rows(problems, "problem") == sorted([(p,) for _, p in faults] + [("series_id stands more than once",)])
    assert R.applied_whole(register, problems).isEmpty()
    assert R.review_problems(register.limit(0), known).isEmpty()


def test_continuity_needs_single_series_on_both_ends(spark):
    from tidemark.operators import registers as R

    resolved = spark.createDataFrame([("a", "A"), ("b", "B"), ("split", None), ("gone", None)], "old_id string, resolved_id string")
    schema = "continuity_id string, concept_key string, from_series_id string, to_series_id string, relationship string, overlap_rule string, evidence string, reviewed_by string, reviewed_at string"
    entry = lambda i, a, b, kind="continues", rule="direct_splice": (i, "k", a, b, kind, rule, "e", "r", "2024-01-01")
    good = spark.createDataFrame([entry("1", "a", "b")], schema)
    assert R.continuity_problems(good, resolved).isEmpty()
    bad = spark.createDataFrame([entry("1", "a", "split"), entry("2", "gone", "b"), entry("3", "a", "new"), entry("4", "a", "a"), entry("5", "a", "b", "follows"), entry("6", "a", "b", rule="glue"), entry("6", "b", "a"), entry(None, "a", "b")], schema)
    got = rows(R.continuity_problems(bad, resolved), "entry", "problem")
    assert got == sorted([("1", "to_series_id names no single series"), ("2", "from_series_id names no single series"), ("3", "to_series_id names no single series"), ("4", "a series that continues itself"), ("5", "relationship is none of its words"), ("6", "overlap_rule is none of its words"), ("6", "continuity_id stands more than once"), ("", "continuity_id is blank")])


CELL = "source_sheet string, row_id long, column_id long, text string, num double, date date"


def sheet(spark, name, lines):
    """Cells of rows of values: text, number or day."""
    out = []
    for r, line in enumerate(lines, 1):
        for c, v in enumerate(line, 1):
            if v is not None:
                out.append((name, r, c, v if isinstance(v, str) else None, float(v) if isinstance(v, (int, float)) else None, v if isinstance(v, date) else None))
    return spark.createDataFrame(out, CELL)


def test_quarters_from_their_place(spark):
    from tidemark.operators import grid as G

    years = [None, "2001", None, None, None, None, "2002", None, None, None, None, "2003"]
    read = lambda labels, last=("I", "II", "III", "IV"): {r["column_id"]: (r["quarter"], r["inferred"]) for r in G.quarter_axis(sheet(spark, "S", [years, [None, *labels, *last, "Total", "I", "II", "III"], ["x", *range(1, 14)]])).collect()}
    whole = read(["I", "2", "III", "IV", "2001"])
    assert whole[3] == (2, True) and whole[2] == (1, False) and whole[6] == (None, False) and whole[11] == (None, False)
    assert 12 in whole and 14 in whole and 15 not in whole  # the last block has no annual column: three columns on at most
    assert read(["I", "2", "IV", "III", "2001"])[3] == (None, False)  # the others don't agree with their places
    assert read(["I", "2", "III", "2001", "IV"])[3] == (None, False)  # not four before the annual column


def test_blocks_that_do_not_close(spark):
    from tidemark.operators import grid as G

    years = [None, "2001", None, None, None, None, "2002", None, None, None, None, "2003", None, None, None, None]
    labels = [None] + ["I", "II", "III", "IV", "2001", "I", "II", "III", "IV", "2002", "I", "II", "III", "IV", "2003"]
    close = lambda k: [f"row {k}"] + [x for y in range(3) for x in (1, 2, 3, k + y, k + y)]
    good = sheet(spark, "good", [years, labels, *(close(k) for k in range(10))])
    flow = sheet(spark, "flow", [years, labels, *(close(k)[:5] + [99.0] + close(k)[6:] for k in range(10))])
    cells = good.unionByName(flow)
    found = {r["source_sheet"]: r for r in G.quarter_closing(cells, G.quarter_axis(cells)).collect()}
    assert (found["good"]["compared"], found["good"]["agreed"], found["good"]["reason"]) == (30, 30, None)
    assert (found["flow"]["compared"], found["flow"]["agreed"]) == (30, 20) and found["flow"]["reason"]
    assert {r["source_sheet"] for r in G.horizontal_year_quarter(cells).collect()} == {"good"}
    assert G.horizontal_year_quarter(cells).count() == 150
    assert G.quarter_axis(cells.limit(0)).isEmpty() and G.horizontal_year_quarter(cells.limit(0)).isEmpty()


def test_columns_of_dated_sheets(spark):
    from tidemark.operators import dated as W

    months = [d(2020, m) for m in range(1, 13)] + [d(2021, m) for m in range(1, 13)]
    lines = [["Titulo"], [None, "A", None, "Nuevo", "Nota"], [None, "alta", "baja"]]
    lines += [[m, i, i + 0.5, i if i > 20 else None, None, None, 7 if i == 3 else None] for i, m in enumerate(months)]
    cells = sheet(spark, "S", lines)
    got = W.data_columns(cells, W.dated_rows(cells))
    assert rows(got, "column_id", "why") == [(2, "dense"), (3, "dense"), (4, "dense")]
    series = {r["series"] for r in W.vertical_dates(cells).collect()}
    assert series == {"A — alta", "A — baja", "Nuevo — baja"}
    assert {r["period"] for r in W.vertical_dates(cells).filter("row_id = 4").collect()} == {d(2020, 1, 31)}
    daily = sheet(spark, "D", [[None, "x"], *([d(2020, 1, k), k] for k in range(1, 9))])
    assert sorted(r["period"] for r in W.vertical_dates(daily).collect()) == [d(2020, 1, k) for k in range(1, 9)]
    assert W.vertical_dates(sheet(spark, "N", [["a", 1], ["b", 2]])).isEmpty() and W.vertical_dates(cells.limit(0)).isEmpty()


def test_dimensions_abstain(spark):
    from tidemark.operators import dimensions as K

    entries = K.rules(spark, [("flow", "title", "x", ["1"], "export", "export"), ("flow", "title", "x", ["1"], "import", "import"), ("kind", "label", "x", [], "rate", "^tasa")])
    series = spark.createDataFrame([("a", "x", "1", "Exportaciones", "Tasa"), ("b", "x", "1", "Export e import", None), ("c", "x", "2", "Exportaciones", "la tasa"), ("d", "y", "1", "Exportaciones", "Tasa"), ("e", "x", "1", "Export", "p"), ("e", "x", "1", "Import", "p")], "series_id string, source_id string, source_sheet string, title string, label string")
    assert rows(K.derived_dimensions(series, entries), "series_id", "dimension", "value", "basis") == [("a", "flow", "export", "published_title"), ("a", "kind", "rate", "published_label")]


def test_kept_tables_are_rebuilt_by_key(spark):
    from tidemark.operators.reuse import reused
    from tidemark.sources.stored import shared_dir

    path, made = shared_dir(spark, "reused"), []

    def derive(inputs):
        made.append(rows(inputs, "k"))
        return inputs.filter("v > 0").select("k", (F.col("v") * 2).alias("w"))

    def run(data, build="1"):
        made.clear()
        told = reused(spark.createDataFrame(data, "k string, v long"), derive, path, "k", build, buckets=2)
        return rows(told.table, "k", "w"), (told.rebuilt, told.kept, told.removed), [x for m in made for (x,) in m]

    data = [("a", 1), ("a", 2), ("b", 3), ("c", 4), (None, 9)]
    whole = [("a", 2), ("a", 4), ("b", 6), ("c", 8)]
    assert run(data) == (whole, (3, 0, 0), ["a", "a", "b", "c"])
    assert run(data) == (whole, (0, 3, 0), [])
    assert run([*data[:2], ("b", 5), *data[3:]]) == ([("a", 2), ("a", 4), ("b", 10), ("c", 8)], (1, 2, 0), ["b"])
    assert run([("a", 1), ("a", 2), ("b", 5)]) == ([("a", 2), ("a", 4), ("b", 10)], (0, 2, 1), [])
    assert run([("a", -1), ("b", 5)]) == ([("b", 10)], (1, 1, 0), ["a"])  # a key without rows any more
    assert run([("b", 5)], build="2") == ([("b", 10)], (1, 0, 1), ["b"])
    assert run([]) == ([], (0, 0, 1), [])


def test_sql_functions(spark):
    from tidemark import sql_functions

    events = spark.createDataFrame([("a", d(2020, 1), "v1", d(2020, 2), 1.0, False), ("a", d(2020, 1), "v2", d(2020, 3), 2.0, False), ("a", d(2020, 6), "v2", d(2020, 3), 9.0, False), ("b", d(2020, 1), "v1", d(2020, 2), 5.0, False), ("b", d(2020, 1), "v2", d(2020, 3), None, True)], EVENT)
    accepted = spark.createDataFrame([("v1", d(2020, 2)), ("v2", d(2020, 3))], "vintage_id string, available_at date")
    resolved = spark.createDataFrame([("old", ["new"], "new"), ("split", ["x", "y"], None), ("gone", [], None)], "old_id string, candidates array<string>, resolved_id string")
    sql_functions.create_functions(spark, events, accepted, resolved, prefix="t_")
    for day, wanted in (("2020-02-15", [("a", 1.0), ("b", 5.0)]), ("2020-03-01", [("a", 2.0)]), ("2020-01-01", [])):
        assert rows(spark.sql(f"SELECT * FROM t_series_as_of_date(DATE '{day}')"), "series_id", "value") == wanted
        assert rows(V.as_of(events, accepted, day), "series_id", "value") == wanted
    assert rows(spark.sql("SELECT * FROM t_series_statement_as_of_date(DATE '2020-03-01')"), "series_id", "value", "observation_status") == [("a", 2.0, "observed"), ("a", 9.0, "after_publication")]
    got = spark.sql("SELECT id, t_resolve_series_id(id) AS now FROM VALUES ('old'), ('split'), ('gone'), ('unknown'), (NULL) AS t(id)").collect()
    assert {r["id"]: r["now"] for r in got} == {"old": "new", "split": None, "gone": None, "unknown": None, None: None}
    assert rows(spark.sql("SELECT * FROM t_resolve_series_ids('split')"), "published_series_id", "current_series_id", "candidate_count") == [("split", "x", 2), ("split", "y", 2)]


def test_projections_do_not_hide_what_was_observed(spark):
    """A later vintage's own projection of a period is not what a realised as-of shows, whatever it replaces."""
    events = spark.createDataFrame([("a", d(2020, 2), "v1", d(2020, 5), 1.0, False), ("a", d(2020, 2), "v2", d(2020, 1), 2.0, False)], EVENT)
    accepted = spark.createDataFrame([("v1", d(2020, 5)), ("v2", d(2020, 6))], "vintage_id string, available_at date")
    assert rows(V.as_of(events, accepted, "2020-12-31"), "vintage_id", "value") == [("v1", 1.0)]
    assert rows(V.as_of(events, accepted, "2020-12-31", statement=True), "vintage_id", "value") == [("v2", 2.0)]


def test_only_substring(spark):
    from tidemark.operators.publication import only_substring

    texts = spark.createDataFrame([("pay ABCD and more",), ("pay ABCD ABCX",), ("no code",), ("x7",), ("",), (None,), ("pay ABCD and more",)], "t string")
    codes = spark.createDataFrame([("ABCD",), ("ABCX",), ("x7",), ("",), (None,), ("pay ABCDE",)], "c string")
    got = {r["t"]: (r["n_hits"], r["c"]) for r in only_substring(texts, "t", codes, "c").collect()}
    assert got == {"pay ABCD and more": (1, "ABCD"), "pay ABCD ABCX": (2, None), "no code": (0, None), "x7": (1, "x7"), "": (0, None), None: (0, None)}


def test_gaps_and_tails_of_templates(spark):
    cells = sheet(spark, "S", [["m", "Total", "a"], ["2020"], ["Enero", 3, 3], ["Febrero"], ["Marzo", 4, 5], ["Abril"], ["Mayo"]])
    kept = L.component_blocks(cells, gaps=True)
    assert rows(kept.na.fill(-1.0), "period", "total", "components") == [(d(2020, 1, 31), 3.0, 3.0), (d(2020, 2, 29), -1.0, -1.0), (d(2020, 3, 31), 4.0, 5.0)]
    assert rows(L.component_blocks(cells), "period") == [(d(2020, 1, 31),), (d(2020, 3, 31),)]


def test_behaviour_drift(spark):
    schema = "source_sheet string, content string, formula_cells long, hidden_rows long, hidden_columns long"
    old = spark.createDataFrame([("a", "1", 5, 0, 0), ("b", "1", 5, 0, 0), ("c", "1", 5, None, 0), ("gone", "1", 1, 1, 1)], schema)
    new = spark.createDataFrame([("a", "1", 5, 2, 1), ("b", "2", 9, 9, 9), ("c", "1", 5, 0, 0), ("new", "1", 1, 1, 1)], schema)
    assert sorted(map(tuple, A.behaviour_drift(old, new).na.fill(-1).collect())) == [("a", "hidden_columns", 0, 1), ("a", "hidden_rows", 0, 2), ("c", "hidden_rows", -1, 0)]


def test_scopes_remove_what_was_saved_inside(spark):
    from tidemark.sources import stored

    held = lambda df: not spark.read.schema(df.schema).parquet(df.inputFiles()[0].rsplit("/", 1)[0]).isEmpty()
    before = stored.saved(spark.range(3), "before")
    with stored.scope():
        inner = stored.saved(spark.range(4), "inner")
        folder = inner.inputFiles()[0].rsplit("/", 1)[0]
        with stored.scope():
            deep = stored.saved(inner, "deep").inputFiles()[0].rsplit("/", 1)[0]
            with stored.outside():
                result = stored.saved(inner, "result")
        assert spark.read.parquet(deep).isEmpty() and result.count() == 4 and inner.count() == 4
        with stored.outside():
            stays = stored.saved(result, "stays")
        of_result = result.inputFiles()[0].rsplit("/", 1)[0]
    assert all(spark.read.parquet(f).isEmpty() for f in (folder, of_result)) and held(stays) and held(before)
    try:
        with stored.scope():
            lost = stored.saved(spark.range(2), "lost").inputFiles()[0].rsplit("/", 1)[0]
            raise KeyError
    except KeyError:
        assert spark.read.parquet(lost).isEmpty()


def test_years_of_another_amount_differ_at_any_size(spark, tmp_path):
    from datetime import datetime

    from tidemark.operators import grid as G
    from tidemark.sources import special

    lines = [(1, 1, 1, ln, 4e6, 1.0, 0.0, 0.0, "N", "O", datetime(y, m, 5)) for ln in (1, 2) for y in (1995, 1996, 1997) for m in (2, 5, 8, 11)]
    kinds = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(lines, kinds).write.parquet(f"{tmp_path}/lineitem.parquet")
    cells = special.stocks(spark, str(tmp_path))
    assert rows(G.quarter_closing(cells, G.quarter_axis(cells)), "compared", "agreed", "reason") == [(6, 3, "fourth quarters differ from the years that they close")]


def test_sheets_are_laid_out_from_one_pass_over_the_lines(spark):
    from tidemark.sources import derived, special

    for source in (derived.worksheets, special.stocks, special.dealings, special.houses):
        assert not any("lineitem" in f for f in source(spark, "/root/testdata/sf0.001").inputFiles())


def test_events_are_laid_out_in_one_pass(spark):
    from tidemark.sources import special

    cells = special.events(spark, "/root/testdata/sf0.001")
    assert cells._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1
    # the two markets of a sheet stay apart however many lines the first has
    assert cells.filter("text = 'Mercado O'").agg(F.min("row_id")).first()[0] > 10**9


def test_guarded_rows_are_numbered_without_moving_them(spark, tmp_path):
    from tidemark.sources import files

    lines = [f" a{i % 3} ;{i}" for i in range(1, 501)]
    (tmp_path / "t.csv").write_text("k;n\n" + "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        read = files.guarded(spark, str(tmp_path), ["k", "n"])
        assert rows(read, "source_row", "k") == [(i, f"a{i % 3}") for i in range(1, 501)]
        assert "row_number" not in read._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    twice = read.unionByName(read.filter("source_row <= 70"))
    assert rows(files.counted_places(twice, "k"), "k", "n_places") == [("a0", 166), ("a1", 167), ("a2", 167)]
