"""Large pages and long lists: nothing beyond a fixed size is lost."""

from formloom.operators import detect, routing, snap

BOX = "x0 double, y0 double, x1 double, y1 double"


def lines(spark, *rows):
    return spark.createDataFrame([("f", 1, *r) for r in rows], f"form_id string, page int, line_id long, text string, {BOX}")


def rects(spark, *rows, id_col="rect_id"):
    return spark.createDataFrame([("f", 1, *r) for r in rows], f"form_id string, page int, {id_col} long, {BOX}")


def test_last_heading_holds_all_below(spark):
    heads = lines(spark, (1, "Parties:", 10.0, 100.0, 60.0, 110.0), (2, "Assets:", 10.0, 300.0, 60.0, 310.0))
    fields = rects(spark, (1, 10.0, 50.0, 20.0, 60.0), (2, 10.0, 100.0, 20.0, 110.0), (3, 10.0, 299.0, 20.0, 310.0), (4, 10.0, 9000.0, 20.0, 9010.0))
    found = detect.section_span_prefix(fields, heads)
    assert {r.rect_id: r.prefix for r in found.collect()} == {2: "parties", 3: "parties", 4: "assets"}


def test_case_number_blank_far_to_the_right(spark):
    labels = lines(spark, (1, "Docket No.", 10.0, 20.0, 60.0, 30.0))
    rules = rects(spark, (7, 4800.0, 28.0, 4950.0, 28.5), id_col="rule_id")
    found = detect.case_number_line(labels, rules, ["docket"]).collect()
    assert [(r.line_id, r.rule_id) for r in found] == [(1, 7)]


def test_equal_columns_across_a_wide_page(spark):
    widgets = rects(spark, (1, 0.0, 10.0, 50.0, 20.0), (2, 1400.0, 10.0, 1450.0, 20.0), (3, 2900.0, 10.0, 2950.0, 20.0))
    margins = spark.createDataFrame([("f", 1, 0.0, 3000.0)], "form_id string, page int, left_x double, right_x double")
    found = snap.equal_columns(widgets, margins).collect()
    assert sorted(r.rect_id for r in found) == [1, 2, 3]
    assert len({round(r.col_x1 - r.col_x0, 3) for r in found}) == 1 and {r.n_columns for r in found} == {3}


def test_lone_rule_stops_at_a_far_word(spark):
    widgets = rects(spark, (1, 20.0, 100.0, 60.0, 110.0))
    rules = rects(spark, (5, 20.0, 112.0, 1400.0, 112.5), id_col="rule_id")
    words = rects(spark, (9, 900.0, 100.0, 950.0, 110.0), id_col="word_id")
    found = snap.lone_segment_snap(widgets, rules, words, page_width=3000.0).collect()
    assert [(r.rect_id, r.x1) for r in found] == [(1, 898.5)]


def test_as_many_forms_as_asked_for(spark):
    scored = spark.createDataFrame([(1, f"f{i:02d}", 5, 0.9) for i in range(30)], "event_id long, form_id string, n_fields int, score double")
    assert routing.forms_above(scored, max_forms=20).count() == 20
    assert routing.forms_above(scored, threshold=0.95).count() == 1


def test_routes_beyond_broadcast_are_salted(spark, tables, monkeypatch):
    from formloom.plans import routing as plans

    want = sorted(map(tuple, plans.scored(tables).collect()))
    monkeypatch.setattr(routing, "BROADCAST_ROUTES", 0)
    salted = plans.scored(tables)
    assert sorted(map(tuple, salted.collect())) == want
    assert "_salt" in salted._jdf.queryExecution().optimizedPlan().toString()


def test_a_word_of_all_forms_pairs_no_query_with_all_of_them(spark, tables, monkeypatch):
    """Same answers with and without common words kept apart; the plan joins
    their postings once for each set of such words, in shares."""
    from formloom.operators import routing

    n = 400
    forms = spark.range(n).selectExpr("concat('PT-', id) AS form_id", "concat('common title ', CASE WHEN id % 40 = 0 THEN 'rare' ELSE 'usual' END, ' w', id % 50) AS title", "concat('all ', CASE WHEN id % 3 = 0 THEN 'third' ELSE 'rest' END) AS category")
    asks = ["common", "common rare", "all third w30x", "usual w300 nothing", "rare third common title", "pt 77", "w049 all", "nothing at all here"]
    queries = spark.createDataFrame(list(enumerate(asks * 5)), "query_id bigint, query string")
    plain = sorted(tuple(r) for r in routing.search_forms(queries, forms, 7).collect())
    for hot in (5, 60, 200):
        monkeypatch.setattr(routing, "HOT_FORMS", hot)
        apart = routing.search_forms(queries, forms, 7)
        assert sorted(tuple(r) for r in apart.collect()) == plain
    plan = apart._jdf.queryExecution().optimizedPlan().toString()
    assert "salt" in plan and "WindowGroupLimit" in apart._jdf.queryExecution().executedPlan().toString()
