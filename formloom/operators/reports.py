"""Roll-ups of catalogues, findings, votes and evaluations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from formloom.functions import text as X
from formloom.functions import values as V
from formloom.operators.pairs import PAGE

SUFFIX = r"_\d+$"


def base_name(name: Column) -> Column:
    """A field name without its disambiguating number."""
    return F.regexp_replace(name, SUFFIX, "")


def findings_by_code(findings: DataFrame) -> DataFrame:
    return findings.groupBy("form_id", "code", "severity").agg(F.count("*").alias("n"))


def field_catalog(widgets: DataFrame) -> DataFrame:
    """One row per field occurrence, coordinates to one decimal."""
    return widgets.select(
        *PAGE, "rect_id", "field_id", "kind", *[F.round(c, 1).alias(c) for c in ("x0", "y0", "x1", "y1")]
    )


def name_uses(fields: DataFrame) -> DataFrame:
    """Long form of the name index: base, form_id and the number of its fields
    there.  A name in a third of all forms is a third of the rows, not one row."""
    used = fields.select(base_name(F.col("field_id")).alias("base"), "form_id", "field_id").distinct()
    return used.groupBy("base", "form_id").agg(F.count("*").alias("n_names"))


def name_reach(fields: DataFrame) -> DataFrame:
    """How many forms and names each base name has; both counts are taken from
    distinct rows that combine before the shuffle."""
    uses = name_uses(fields)
    return uses.groupBy("base").agg(F.count("*").alias("n_forms"), F.sum("n_names").alias("n_names"))


def cross_form_names(fields: DataFrame) -> DataFrame:
    """Long form of the cross-form map: base, form_id, field_id for bases that
    stand in two forms or more."""
    names = fields.select(base_name(F.col("field_id")).alias("base"), "form_id", "field_id").distinct()
    shared = name_reach(fields).where("n_forms > 1").select("base")
    return names.join(shared, "base", "left_semi")


def authority_uses(uses: DataFrame, authorities: DataFrame) -> DataFrame:
    """Long form of the usage: cite, kind, form_id; an authority that no form
    cites has one row without a form."""
    cited = uses.select("cite", "form_id").distinct()
    return authorities.select("cite", "kind").join(cited, "cite", "left")


def field_name_index(fields: DataFrame) -> DataFrame:
    """Base name to the forms using it, sorted: an export for catalogues, whose
    lists are as long as a name has forms (``name_uses`` is the long table)."""
    used = fields.select(base_name(F.col("field_id")).alias("base"), "form_id").distinct()
    return used.groupBy("base").agg(
        F.count("*").alias("n_forms"), F.array_join(F.sort_array(F.collect_list("form_id")), ",").alias("forms")
    )


def cross_form_map(fields: DataFrame) -> DataFrame:
    """Base name to a map of form to the names used there: an export for
    catalogues (``cross_form_names`` is the long table)."""
    names = fields.select(base_name(F.col("field_id")).alias("base"), "form_id", "field_id").distinct()
    by_form = names.groupBy("base", "form_id").agg(F.array_join(F.sort_array(F.collect_list("field_id")), ",").alias("names"))
    return by_form.groupBy("base").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("form_id", "names")))).alias("forms")
    )


def confidence_band(confidence: Column) -> Column:
    return F.when(confidence >= 0.9, "high").when(confidence >= 0.7, "medium").otherwise("low")


def quality_report(catalog: DataFrame) -> DataFrame:
    """Totals and labelled share overall and by type, category and confidence
    band, in one pass over grouping sets."""
    staged = catalog.select(
        "field_type", "category", confidence_band(F.col("confidence")).alias("band"),
        X.present(F.col("label")).alias("labelled"),
    )
    sets = [[], [F.col("field_type")], [F.col("category")], [F.col("band")]]
    grouped = staged.groupingSets(sets, "field_type", "category", "band").agg(
        F.count("*").alias("total"),
        F.count_if("labelled").alias("labelled"),
    )
    scope = (
        F.when(F.col("field_type").isNotNull(), "type")
        .when(F.col("category").isNotNull(), "category")
        .when(F.col("band").isNotNull(), "confidence")
        .otherwise("all")
    )
    return grouped.select(
        scope.alias("scope"),
        F.coalesce("field_type", "category", "band").alias("value"),
        "total",
        "labelled",
        F.round(F.col("labelled") * 100 / F.col("total"), 1).alias("pct"),
    )


def reused_names(fields: DataFrame, min_forms: int = 3) -> DataFrame:
    return field_name_index(fields).where(F.col("n_forms") >= min_forms).select("base", "n_forms")


def top_forms_by_fields(fields: DataFrame, k: int = 10) -> DataFrame:
    return fields.groupBy("form_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "form_id").limit(k)


def coverage_rollup(unbound: DataFrame, court: str, static: str) -> DataFrame:
    """Unbound widgets by category and review hint, with totals."""
    name = F.lower("field_id")
    category = F.when(name.rlike(court), "court_or_sig").when(name.rlike(static), "likely_static").otherwise("blank")
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    hint = (
        F.when(F.col("category") != "blank", "leave_unmapped")
        .when((w < 18) & (h < 18), "review_marker")
        .otherwise("candidate_input")
    )
    return (
        unbound.withColumn("category", category)
        .withColumn("hint", hint)
        .rollup("category", "hint")
        .agg(F.count("*").alias("n"))
    )


def issue_counts(issues: DataFrame, codes: Sequence[str] = ("alignment", "naming", "missing")) -> DataFrame:
    """Per form and variant: one column per code and their total."""
    return issues.groupBy("form_id", "variant").agg(
        *[F.count_if(F.col("code") == c).alias(c) for c in codes],
        F.count_if(F.col("code").isin(list(codes))).alias("total"),
    )


def winner_table(counts: DataFrame, features: DataFrame, margin: int = 5) -> DataFrame:
    """Variant 1 against variant 0: issue difference and who wins it."""
    side = lambda v: F.max(F.when(F.col("variant") == v, F.col("total")))
    both = (
        counts.groupBy("form_id")
        .agg(side(0).alias("base"), side(1).alias("fused"))
        .where("base IS NOT NULL AND fused IS NOT NULL")
        .withColumn("delta", F.col("fused") - F.col("base"))
    )
    bucket = F.when(F.col("delta") <= -margin, "fused").when(F.col("delta") >= margin, "base").otherwise("wash")
    return both.withColumn("bucket", bucket).join(features, "form_id", "left")


def bucket_means(winners: DataFrame, features: Sequence[str]) -> DataFrame:
    return winners.groupBy("bucket").agg(
        F.count("*").alias("n"), *[F.round(F.avg(f), 6).alias("mean_" + f) for f in features]
    )


def compare_models(evals: DataFrame, tie: float = 0.6) -> DataFrame:
    """Wrong and overconfident counts of two models per form, with a verdict.

    ``evals``: form_id, model (a or b), wrong, overconfident as 0/1.
    """
    cell = lambda m, c: F.coalesce(F.sum(F.when(F.col("model") == m, F.col(c))), F.lit(0))
    sums = evals.groupBy("form_id").agg(
        *[
            cell(m, c).alias(f"{c}_{m}")
            for m in ("a", "b")
            for c in ("wrong", "overconfident")
        ],
        F.count_if(F.col("model") == "a").alias("n_a"),
        F.count_if(F.col("model") == "b").alias("n_b"),
    )
    sa = F.col("wrong_a") + 0.5 * F.col("overconfident_a")
    sb = F.col("wrong_b") + 0.5 * F.col("overconfident_b")
    verdict = (
        F.when((F.col("n_a") == 0) | (F.col("n_b") == 0), "partial")
        .when(F.abs(sa - sb) < tie, "tie")
        .when(sb < sa, "b")
        .otherwise("a")
    )
    return sums.withColumn("verdict", verdict)


def compare_models_by_band(evals: DataFrame) -> DataFrame:
    """The same sums by complexity band, over forms both models scored."""
    both = (
        evals.groupBy("form_id").agg(F.count_distinct("model").alias("n_models")).where("n_models = 2").select("form_id")
    )
    return (
        evals.join(both, "form_id", "left_semi")
        .groupBy("complexity", "model")
        .agg(F.count("*").alias("n"), F.sum("wrong").alias("wrong"), F.sum("overconfident").alias("overconfident"))
    )


def page_features(lines: DataFrame, cells: DataFrame, fields: DataFrame, header: Column, symbol: str) -> DataFrame:
    """Per form: cells, distinct text indents, symbol text, section banners and
    the share of clean names."""
    text = lines.groupBy("form_id").agg(
        F.count_distinct("page").alias("n_pages"),
        F.count_distinct(F.rint("x0")).alias("n_indents"),
        F.max(F.col("text").rlike(symbol)).alias("has_symbols"),
        F.count_if(header).alias("n_banners"),
    )
    n_cells = cells.groupBy("form_id").agg(F.count("*").alias("n_cells"))
    clean = fields.groupBy("form_id").agg(
        F.round(F.avg(F.col("field_id").rlike("^[a-z][a-z0-9_]*$").cast("int")), 6).alias("clean_share")
    )
    return (
        text.join(n_cells, "form_id", "left")
        .join(clean, "form_id", "left")
        .withColumn("n_cells", F.coalesce("n_cells", F.lit(0)).cast("bigint"))
    )


def name_audit(fields: DataFrame, families: Mapping[str, str]) -> DataFrame:
    """Names that are not snake case, repeat within a form, or belong to a
    family of variants seen together across forms.

    ``families`` maps a name to its family.
    """
    from formloom.operators.naming import _lookup

    bad = fields.where(~F.col("field_id").rlike("^[a-z][a-z0-9_]*$")).groupBy("form_id", "field_id").agg(F.count("*").alias("n"))
    dup = fields.groupBy("form_id", "field_id").agg(F.count("*").alias("n")).where("n > 1")
    used = fields.select("form_id", "field_id", _lookup(families, F.col("field_id")).alias("family")).where("family IS NOT NULL").distinct()
    per_name = used.groupBy("family", "field_id").agg(F.count("*").alias("n"))
    mixed = per_name.groupBy("family").agg(F.count("*").alias("k")).where("k > 1")
    clash = per_name.join(mixed, "family").select(F.col("family").alias("form_id"), "field_id", "n")
    tag = lambda df, code: df.select(F.lit(code).alias("problem"), "form_id", "field_id", "n")
    return tag(bad, "not_snake_case").unionByName(tag(dup, "duplicate")).unionByName(tag(clash, "mixed_family"))


def group_summary(boxes: DataFrame) -> DataFrame:
    """Per group: members, pages and options."""
    pages = boxes.select("group_id", "page").distinct().groupBy("group_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("page")), lambda p: p.cast("string")), ",").alias("pages")
    )
    options = boxes.select("group_id", "group_option").distinct().groupBy("group_id").agg(
        F.array_join(F.array_sort(F.collect_list("group_option")), ",").alias("options")
    )
    n = boxes.groupBy("group_id").agg(F.count("*").alias("n"), F.count_distinct("form_id").alias("n_forms"))
    return n.join(pages, "group_id").join(options, "group_id")


def type_fit(bindings: DataFrame) -> DataFrame:
    """Per form, the candidate whose widget types contradict the field types
    least; shorter, then smaller, names win ties.

    ``bindings``: form_id, candidate, widget_type, field_type.
    """
    wrong = (F.col("widget_type") == "choice") != F.col("field_type").isin("choice", "boolean")
    counts = bindings.groupBy("form_id", "candidate").agg(F.count_if(wrong).alias("n_wrong"), F.count("*").alias("n"))
    best = F.struct("n_wrong", F.length("candidate").alias("len"), "candidate")
    return counts.groupBy("form_id").agg(F.min(best).alias("b"), F.min_by("n", best).alias("n")).select(
        "form_id", F.col("b.candidate").alias("candidate"), F.col("b.n_wrong").alias("n_wrong"), "n"
    )


def latest_by_key(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last line per key, by ``order``."""
    rest = [c for c in log.columns if c not in keys]
    return (
        log.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_l"))
        .select(*keys, "_l.*")
    )


def consensus_status() -> Column:
    """Two major votes confirm; one, or two minor ones, dispute."""
    major, minor = F.col("n_major"), F.col("n_minor")
    return F.when(major >= 2, "confirmed").when((major == 1) | (minor >= 2), "disputed").otherwise("clean")


def vote_consensus(votes: DataFrame) -> DataFrame:
    """Consensus on each key over the latest vote of each voter."""
    latest = latest_by_key(votes, ["key", "voter"], ["ts", "event_id"])
    counted = latest.groupBy("key").agg(
        F.count_if(F.col("verdict") == "major").alias("n_major"),
        F.count_if(F.col("verdict") == "minor").alias("n_minor"),
    )
    return counted.withColumn("status", consensus_status())


def evidence_units(analytic: DataFrame, ocr: DataFrame) -> DataFrame:
    """Layout and read-back flags merged per (form, field, idx).

    Both sides carry ``flag`` and ``at`` (when it was raised); the latest
    flag of each kind counts, read-backs that were fine count for nothing.
    """
    key = ["form_id", "field_id", "idx"]
    a = analytic.groupBy(*key).agg(F.max_by("flag", F.struct("at", "flag")).alias("analytic"))
    o = (
        ocr.where(~F.col("flag").isin("ok", "unreadable_small"))
        .groupBy(*key)
        .agg(F.max_by("flag", F.struct("at", "flag")).alias("ocr"))
    )
    return a.join(o, key, "full")


def panel_selection(units: DataFrame, votes: DataFrame, controls: DataFrame, strong: Sequence[str], n_controls: int, seed: int) -> DataFrame:
    """Units with a bad triage vote or strong evidence, plus a repeatable
    control sample ordered by a seeded hash."""
    bad = F.col("verdict").isin("minor", "major") | F.coalesce(F.col("flag").isin(list(strong)), F.lit(False))
    picked = units.join(votes, "key", "left").where(F.coalesce(bad, F.lit(False))).select("key", F.lit("unit").alias("why"))
    sample = (
        controls.select("key").distinct()
        .orderBy(V.seeded_order(F.col("key"), seed), "key")
        .limit(n_controls)
        .select("key", F.lit("control").alias("why"))
    )
    return picked.distinct().unionByName(sample)


def sampled_controls(rows: DataFrame, group: str, key: str, n: int, seed: int) -> DataFrame:
    """A repeatable ``n`` rows per group."""
    w = Window.partitionBy(group).orderBy(V.seeded_order(F.col(key), seed), key)
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def rebuild_worklist(consensus: DataFrame, adjudications: DataFrame, flags: DataFrame, benign: Sequence[str]) -> DataFrame:
    """Confirmed defects, by vote or adjudication, still flagged on re-sweep;
    units whose only flags are benign drop out."""
    real = consensus.where("status = 'confirmed'").select("key", F.lit("vote").alias("source")).unionByName(
        adjudications.where("verdict = 'major'").select("key", F.lit("adjudicated").alias("source"))
    )
    why = real.groupBy("key").agg(F.max("source").alias("source"))
    left = (
        flags.where(~F.col("flag").isin(list(benign)))
        .select("key", "flag").distinct()
        .groupBy("key")
        .agg(F.count("*").alias("n_flags"), F.min("flag").alias("first_flag"))
    )
    return why.join(left, "key")


def review_progress(decisions: DataFrame) -> DataFrame:
    """Latest decision per id, counted by kind."""
    return latest_by_key(decisions, ["key"], ["ts", "event_id"]).groupBy("verdict").agg(F.count("*").alias("n"))


def stage_error_totals(log: DataFrame) -> DataFrame:
    """Errors per pipeline stage, and forms whose last stage has errors."""
    totals = log.groupBy("stage").agg(F.sum("errors").alias("errors"), F.count_distinct("form_id").alias("n_forms"))
    last = log.groupBy("form_id").agg(F.max_by(F.struct("stage", "errors"), F.struct("stage_no", "event_id")).alias("l"))
    stuck = last.where("l.errors > 0").groupBy(F.col("l.stage").alias("stage")).agg(F.count("*").alias("n_last_with_errors"))
    return totals.join(stuck, "stage", "left").withColumn(
        "n_last_with_errors", F.coalesce("n_last_with_errors", F.lit(0)).cast("bigint")
    )


def chain_summary(events: DataFrame) -> DataFrame:
    """Events, filled, clean and failed per case type."""
    return events.groupBy("case_type").agg(
        F.count("*").alias("events"),
        F.count_if("filled").alias("filled"),
        F.count_if(F.col("filled") & (F.col("errors") == 0)).alias("clean"),
        F.count_if(~F.col("filled")).alias("failed"),
    )


def gap_tracker(fields: DataFrame) -> DataFrame:
    """Category and tier shares per form, and what the form is missing."""
    share = lambda c: F.round(F.count_if(c) / F.count("*"), 6)
    return fields.groupBy("form_id").agg(
        F.count("*").alias("n_fields"),
        share(F.col("category") == "financial").alias("financial_share"),
        share(F.col("tier") == "red").alias("red_share"),
        F.max(F.col("formula").isNotNull()).alias("has_formula"),
        F.max(F.col("deadline").isNotNull()).alias("has_deadline"),
        F.max(F.col("evidence") > 0).alias("has_evidence"),
    ).withColumn(
        "missing",
        F.concat_ws(
            ",",
            F.when(~F.col("has_formula"), "formula"),
            F.when(~F.col("has_deadline"), "deadline"),
            F.when(~F.col("has_evidence"), "evidence"),
        ),
    )


def authority_usage(uses: DataFrame, authorities: DataFrame) -> DataFrame:
    """Authority to the forms citing it; unused ones are listed too.  An export
    for catalogues (``authority_uses`` is the long table)."""
    forms = uses.select("cite", "form_id").distinct().groupBy("cite").agg(
        F.count("*").alias("n_forms"), F.array_join(F.array_sort(F.collect_list("form_id")), ",").alias("forms")
    )
    return authorities.select("cite", "kind").join(forms, "cite", "left").withColumn(
        "n_forms", F.coalesce("n_forms", F.lit(0)).cast("bigint")
    )


# How numbered field names are built: ``heir_2_name``,
# ``heir_name_2`` or ``heir_2``, before one line end at most.
SLOT_NAME = (
    r"^(?:([a-z]+(?:_[a-z0-9]+)*?)_(\d+)_([a-z]+(?:_[a-z]+)*)"
    r"|([a-z]+(?:_[a-z0-9]+)*?)_([a-z]+)_(\d+)"
    r"|([a-z]+(?:_[a-z]+)*?)_(\d+))(?:\r\n|[\n\r\u0085\u2028\u2029])?\z"
)
SLOT_MARK = "\x01"


def slot_parts(name: Column) -> Column:
    """(entity, idx, attr) of a numbered name: ``heir_2_name``, ``heir_name_2``
    or bare ``heir_2``; null when it is none of these."""
    return slot_of(slot_text(name), name)


def slot_text(name: Column) -> Column:
    """A numbered name rewritten to its parts by one match; other names stay."""
    return F.regexp_replace(name, SLOT_NAME, f"$1$4$7{SLOT_MARK}$2$6$8{SLOT_MARK}$3$5")


def slot_of(text: Column, name: Column) -> Column:
    """The parts in ``slot_text`` of a name; null when it is the name itself."""
    part = lambda i: F.substring_index(F.substring_index(text, SLOT_MARK, i + 1), SLOT_MARK, -1)
    attr = F.when(part(2) == "", "value").otherwise(part(2))
    return F.when(text != name, F.struct(part(0).alias("entity"), part(1).try_cast("int").alias("idx"), attr.alias("attr")))


def repeating_groups(fields: DataFrame, min_capacity: int = 2) -> DataFrame:
    """Numbered record families of a form with attributes and capacity; valid
    when every attribute exists for every index from 1."""
    s = fields.select("form_id", slot_parts(F.col("field_id")).alias("s")).where("s IS NOT NULL AND s.idx >= 1")
    slots = s.select("form_id", "s.entity", "s.idx", "s.attr").distinct()
    return (
        slots.groupBy("form_id", "entity")
        .agg(
            F.max("idx").alias("capacity"),
            F.count("*").alias("n_slots"),
            F.array_join(F.array_sort(F.collect_set("attr")), ",").alias("attrs"),
            F.count_distinct("attr").alias("n_attrs"),
        )
        .where(F.col("capacity") >= min_capacity)
        .withColumn("valid", F.col("n_slots") == F.col("capacity") * F.col("n_attrs"))
    )


def eval_evidence(scored: DataFrame) -> DataFrame:
    """Per field: how often each judgement was given.

    ``scored``: form_id, field_id, accuracy, calibration, comprehension.
    """
    n = lambda c, v: F.count_if(F.col(c) == v)
    return scored.groupBy("form_id", "field_id").agg(
        F.count("*").alias("patterns_scored"),
        n("accuracy", "wrong").alias("wrong"),
        n("accuracy", "matches").alias("matches"),
        n("accuracy", "not_applicable").alias("not_applicable"),
        n("calibration", "overconfident").alias("overconfident"),
        n("calibration", "underconfident").alias("underconfident"),
        n("comprehension", "misunderstood").alias("misunderstood"),
    )


def failure_modes(evidence: DataFrame, k: int = 8) -> DataFrame:
    """The ``k`` fields of a form most often wrong, with their symptoms."""
    symptom = F.concat_ws(
        "; ",
        *[
            F.when(F.col(c) > 0, F.concat(F.lit(word + " "), F.col(c).cast("string")))
            for c, word in (("wrong", "wrong"), ("overconfident", "overconfident"), ("misunderstood", "misunderstood"))
        ],
    )
    w = Window.partitionBy("form_id").orderBy(F.desc("wrong"), "field_id")
    return (
        evidence.where("wrong > 0 OR overconfident > 0 OR misunderstood > 0")
        .withColumn("place", F.row_number().over(w))
        .where(F.col("place") <= k)
        .select("form_id", "place", "field_id", symptom.alias("symptom"), "wrong")
    )


def cap_actions(fixes: DataFrame, max_delete: int, max_add: int) -> DataFrame:
    """At most so many deletes and adds per form and round, in order; other
    actions pass."""
    w = Window.partitionBy("form_id", "round_no").orderBy("fix_no")

    def first(action: str, cap: int) -> DataFrame:
        # a literal limit on row_number lets Spark trim each task before the shuffle
        ranked = fixes.where(F.col("action") == action).withColumn("_r", F.row_number().over(w))
        return ranked.where(F.col("_r") <= cap).drop("_r")

    rest = fixes.where(~F.col("action").isin("delete", "add"))
    return rest.unionByName(first("delete", max_delete)).unionByName(first("add", max_add))


def best_iteration(counts: DataFrame) -> DataFrame:
    """The iteration with fewest issues per form; the earliest wins a tie."""
    return counts.groupBy("form_id").agg(F.min(F.struct("issues", "iter")).alias("b")).select(
        "form_id", F.col("b.iter").alias("best_iter"), F.col("b.issues").alias("best_issues")
    )


def improvement_status(counts: DataFrame, threshold: int = 3, regression: int = 5) -> DataFrame:
    """Walk a form's iterations: converged at or under ``threshold``, rolled
    back on a jump above the best, stopped after two rounds without a gain of
    two, else needing review.

    A form has a handful of iterations, so each walk folds over one short
    sorted array.
    """
    series = counts.groupBy("form_id").agg(F.array_sort(F.collect_list(F.struct("iter", "issues"))).alias("s"))
    start = F.expr(
        "named_struct('best', CAST(NULL AS BIGINT), 'best_iter', CAST(NULL AS INT), 'streak', 0, "
        "'status', CAST(NULL AS STRING), 'final', CAST(NULL AS BIGINT), 'stop', false)"
    )

    def step(acc: Column, x: Column) -> Column:
        n = x["issues"].cast("bigint")
        first = acc["best"].isNull()
        jump = ~first & (n > acc["best"] + regression)
        done = ~jump & (n <= threshold)
        gain = first | (n < acc["best"] - 1)
        stale = ~first & ~jump & ~done & ~gain & (acc["streak"] >= 1)
        make = F.struct(
            F.when(~jump & ~done & gain, n).otherwise(acc["best"]).alias("best"),
            F.when(~jump & gain, x["iter"]).otherwise(acc["best_iter"]).alias("best_iter"),
            F.when(gain, 0).otherwise(acc["streak"] + 1).alias("streak"),
            F.when(jump, "rollback").when(done, "converged").otherwise(acc["status"]).alias("status"),
            F.when(jump, acc["best"]).when(done, n).otherwise(acc["final"]).alias("final"),
            (jump | done | stale).alias("stop"),
        )
        return F.when(acc["stop"], acc).otherwise(make)

    walked = series.select("form_id", F.aggregate("s", start, step).alias("w"))
    return walked.select(
        "form_id",
        F.coalesce("w.status", F.when(F.col("w.best") > threshold, "needs_review").otherwise("converged")).alias("status"),
        F.coalesce("w.final", "w.best").alias("final_issues"),
        F.col("w.best_iter").alias("best_iter"),
    )
