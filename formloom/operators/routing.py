"""Routing case events to forms, searching the catalogue, and case lifecycles."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from formloom.functions import values as V
from formloom.functions.text import present
from formloom.session import cut_lineage

ANY = "*"
BOOST_TYPE = "array<struct<source:string,key:string,expected:string,gate:string,delta:double>>"


def form_routes(forms: DataFrame, boosts: DataFrame) -> DataFrame:
    """The catalogue keyed by what an event must bring: its type (or any) and
    its case type (or any), with each form's boost rules attached.

    ``forms``: form_id, anchor, case_types (null: any), filer_role, satisfiers
    (null: role unknown), parties, n_fields.
    """
    rules = boosts.groupBy("form_id").agg(
        F.array_sort(F.collect_list(F.struct("source", "key", "expected", "gate", "delta"))).alias("boosts")
    )
    return (
        forms.join(rules, "form_id", "left")
        .withColumn("boosts", F.coalesce("boosts", F.array().cast(BOOST_TYPE)))
        .withColumn("route_type", F.coalesce("anchor", F.lit(ANY)))
        .withColumn("route_case", F.explode(F.coalesce("case_types", F.array(F.lit(ANY)))))
    )


def _boost(boosts: Column, event_type: Column) -> Column:
    """Sum of the boosts that apply to an event."""

    def applies(b: Column) -> Column:
        bag = F.when(b["source"] == "payload", F.try_element_at("payload", b["key"])).otherwise(
            F.try_element_at("facts", b["key"])
        )
        there = present(F.coalesce(bag, F.lit(""))) & (F.lower(bag) != "false")
        fits = b["expected"].isNull() | (F.lower(b["expected"]) == F.lower(bag))
        gate = b["gate"].isNull() | (b["gate"] == event_type)
        return gate & F.when(b["source"] == "fact_absent", ~there).otherwise(there & fits)

    return F.aggregate(F.filter(boosts, applies), F.lit(0.0), lambda s, b: s + b["delta"])


#: Routes (rows of the catalogue) up to which they are broadcast.
BROADCAST_ROUTES = 100_000
SALTS = 64


def _routed(asked: DataFrame, routes: DataFrame) -> DataFrame:
    """Events with the routes of their keys.

    Every event asks for the key of "any type, any case", so a plain shuffle
    would bring all of them to one task.  A catalogue of checked size is
    broadcast; a larger one is copied to ``SALTS`` shares of the events.
    """
    keys = ["route_type", "route_case"]
    if routes.limit(BROADCAST_ROUTES + 1).count() <= BROADCAST_ROUTES:
        return asked.join(F.broadcast(routes), keys)
    salted = asked.withColumn("_salt", F.pmod(F.xxhash64("event_id"), F.lit(SALTS)).cast("int"))
    copies = routes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, [*keys, "_salt"]).drop("_salt")


def _scoring(route: Callable[[str], Column]) -> tuple[Column, Column, Column]:
    """Whether an event may take a route, its score and what it rests on.
    ``route`` gives a column of the route, beside the columns of the event."""
    satisfiers = route("satisfiers")
    filer = F.lower(F.coalesce(route("filer_role"), F.lit("")))
    known = satisfiers.isNotNull() & (F.size(satisfiers) > 0)
    satisfied = F.arrays_overlap(F.col("filers"), satisfiers)
    filer_score = (
        F.when(satisfiers.isNull(), F.when(F.array_contains(F.col("filers"), filer), 0.1).otherwise(0.0))
        .when(known & satisfied, 0.2)
        .otherwise(0.0)
    )
    shared = F.size(F.array_intersect(F.array_distinct("roles"), route("parties")))
    boost = _boost(route("boosts"), F.col("type"))
    score = (
        F.when(route("anchor").isNotNull(), 0.5).otherwise(0.0)
        + F.when(route("case_types").isNotNull(), 0.1).otherwise(0.0)
        + filer_score
        + 0.05 * shared
        + boost
    )
    reasons = F.concat_ws(
        ";",
        F.when(route("anchor").isNotNull(), "anchor"),
        F.when(route("case_types").isNotNull(), "case_type"),
        F.when(filer_score > 0, "filer"),
        F.when(shared > 0, F.concat(F.lit("parties:"), shared.cast("string"))),
        F.when(boost != 0, "boost"),
    )
    return ~known | satisfied, F.round(score, 3), reasons


def _asked_keys() -> list[tuple[Column, Column]]:
    """What an event looks up: its type or any, with its case type or any."""
    return [(t, c) for t in (F.col("type"), F.lit(ANY)) for c in (F.col("case_type"), F.lit(ANY))]


def score_events(events: DataFrame, routes: DataFrame) -> DataFrame:
    """Scored (event, form) candidates.

    Every event looks up four keys — its own or any type, its own or any case
    type — so one equi-join finds the compatible forms; forms that reject the
    event for its type or case type are never paired with it.

    ``events``: event_id, type, case_type, filers, roles, facts, payload.
    """
    keys = F.array(*[F.struct(t.alias("route_type"), c.alias("route_case")) for t, c in _asked_keys()])
    pairs = _routed(events.select("*", F.inline(keys)), routes)
    fits, score, reasons = _scoring(F.col)
    return pairs.where(fits).select("event_id", "form_id", "n_fields", score.alias("score"), reasons.alias("reasons")).where("score <> 0")


def top_forms_in_row(events: DataFrame, routes: DataFrame, k: int) -> DataFrame:
    """``event_id, place, form_id, score`` of the best ``k`` forms, as
    ``top_forms`` over ``score_events``, without a group or window over events:
    nothing but the events themselves moves, so a stream needs no state.

    The routes of a key are one row here; a catalogue of checked size is
    broadcast, a larger one is joined by key.
    """
    columns = ["form_id", "n_fields", "anchor", "case_types", "filer_role", "satisfiers", "parties", "boosts"]
    small = routes.limit(BROADCAST_ROUTES + 1).count() <= BROADCAST_ROUTES
    found = events
    for i, (kind, case) in enumerate(_asked_keys()):
        own = routes.groupBy(F.col("route_type").alias(f"_t{i}"), F.col("route_case").alias(f"_c{i}"))
        own = own.agg(F.collect_list(F.struct(*columns)).alias(f"_routes{i}"))
        found = found.join(F.broadcast(own) if small else own, (kind == F.col(f"_t{i}")) & (case == F.col(f"_c{i}")), "left")
    listed = F.filter(F.flatten(F.array_compact(F.array(*[F.col(f"_routes{i}") for i in range(4)]))), lambda r: _scoring(r.getField)[0])

    def place(r: Column) -> Column:
        n = F.when(r["n_fields"] > 0, r["n_fields"]).otherwise(9999)
        return F.struct((-_scoring(r.getField)[1]).alias("neg"), n.alias("n"), r["form_id"].alias("form_id"))

    best = F.slice(F.array_sort(F.filter(F.transform(listed, place), lambda b: b["neg"] != 0)), 1, k)
    ranked = found.select("event_id", F.posexplode(best).alias("pos", "b"))
    return ranked.select("event_id", (F.col("pos") + 1).alias("place"), F.col("b.form_id").alias("form_id"), (-F.col("b.neg")).alias("score"))


def _best_first(scored: DataFrame):
    fields = F.when(F.col("n_fields") > 0, F.col("n_fields")).otherwise(9999)
    return Window.partitionBy("event_id").orderBy(F.desc("score"), fields, "form_id")


def top_forms(scored: DataFrame, k: int) -> DataFrame:
    return scored.withColumn("place", F.row_number().over(_best_first(scored))).where(F.col("place") <= k)


def forms_above(scored: DataFrame, threshold: float = 0.7, max_forms: int = 5) -> DataFrame:
    """Forms at or above ``threshold``, at most ``max_forms``; else the best one."""
    ranked = top_forms(scored, max(1, max_forms))
    # places are in score order, so those above come first
    keep = (F.col("score") >= threshold) & (F.col("place") <= max_forms)
    return ranked.where(keep | (F.col("place") == 1))


# Words that say nothing about a form.
STOP_WORDS = (
    "the", "a", "an", "of", "for", "to", "and", "or", "with", "in", "on", "is", "are",
    "form", "forms", "court", "file", "client", "wants", "needs", "case",
)
ID_IN_TEXT = r"(?i)\b([A-Za-z]{2,4})[-_ ]?(\d{1,3}[A-Za-z]?)(\s*\(\s*i\s*\))?"


def tokens(text: Column, stop: Sequence[str] = STOP_WORDS, short: Sequence[str] = ()) -> Column:
    """Distinct words of three letters or more (or listed short ones)."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), 0))
    kept = F.filter(words, lambda w: (F.length(w) > 2) | w.isin(list(short)) if short else F.length(w) > 2)
    return F.array_except(kept, F.array(*[F.lit(s) for s in stop]))


def id_mentions(queries: DataFrame) -> DataFrame:
    """Form ids named in a query, in order of preference.

    A bare id means the formal variant first and the informal ``(I)`` second;
    an ``(i)`` or the word informal turns that round.
    """
    g = lambda i: F.regexp_extract_all("query", F.lit(ID_IN_TEXT), i)
    said = lambda w: F.col("query").rlike(rf"(?i)\b{w}(ly)?\b")
    marked = queries.select(
        "query_id",
        (said("informal") & ~said("formal")).alias("informal"),
        F.posexplode(F.arrays_zip(g(1).alias("a"), g(2).alias("b"), g(3).alias("c"))).alias("at", "m"),
    )
    base = F.upper(F.concat_ws("-", "m.a", "m.b"))
    with_i = F.concat(base, F.lit("(I)"))
    flip = F.col("informal") | (F.col("m.c") != "")
    order = F.when(flip, F.array(with_i, base)).otherwise(F.array(base, with_i))
    return (
        marked.select("query_id", "at", F.posexplode(order).alias("variant", "mention"))
        .groupBy("query_id", "mention")
        .agg(F.min(F.struct("at", "variant")).alias("rank"))
    )


#: Forms from which on a word is common.
HOT_FORMS = 10_000


def _with_common_words(asked: DataFrame, index: DataFrame, common: DataFrame, k: int) -> DataFrame:
    """Scores of all forms that may be among the best ``k`` of a query.

    Forms that share a rare word with the query are all scored, their common
    words looked up by (word, form).  The others share common words only, so
    queries with the same common words have the same best ``k`` of them: these
    are found once for each different set of common words.  Postings of a common
    word are dealt to ``SALTS`` shares.
    """
    rare = asked.join(common, "token", "left_anti").join(index.join(common, "token", "left_anti"), "token")
    rare = rare.groupBy("query_id", "form_id").agg(F.sum("w").alias("score"))
    frequent = asked.join(common, "token", "left_semi")
    postings = index.join(common, "token", "left_semi")
    more = rare.select("query_id", "form_id").join(frequent, "query_id").join(postings, ["token", "form_id"])
    exact = rare.unionByName(more.select("query_id", "form_id", F.col("w").alias("score"))).groupBy("query_id", "form_id").agg(F.sum("score").alias("score"))

    sets = cut_lineage(frequent.groupBy("query_id").agg(F.array_sort(F.collect_set("token")).alias("words")))
    salted = sets.select("words").distinct().select("words", F.explode("words").alias("token"))
    salted = salted.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = postings.withColumn("salt", F.pmod(F.xxhash64("form_id"), F.lit(SALTS)).cast("int"))
    summed = salted.join(dealt, ["token", "salt"]).groupBy("words", "salt", "form_id").agg(F.sum("w").alias("score"))
    # The best of each share first, then the best of those.
    first = [F.desc("score"), F.col("form_id")]
    for keys in (["words", "salt"], ["words"]):
        summed = summed.withColumn("at", F.row_number().over(Window.partitionBy(*keys).orderBy(*first))).where(F.col("at") <= k)
    others = sets.join(summed, "words").select("query_id", "form_id", "score")
    return exact.unionByName(others.join(exact, ["query_id", "form_id"], "left_anti"))


def search_forms(queries: DataFrame, forms: DataFrame, k: int, short: Sequence[str] = ()) -> DataFrame:
    """Best forms for each query: named ids first, then two points per title
    word, one per category word and three for the id prefix.

    Words meet through an inverted index, so only forms sharing a word with a
    query are looked at.  Words of more than ``HOT_FORMS`` forms are kept apart
    (``_with_common_words``), so that no word pairs every query with every form.
    """
    named = id_mentions(queries).join(
        forms.select("form_id", F.upper("form_id").alias("mention")), "mention"
    ).select("query_id", "form_id", "rank")
    prefix = F.lower(F.substring_index("form_id", "-", 1))
    weighted = forms.select(
        "form_id",
        F.explode(
            F.concat(
                F.transform(tokens(F.col("title"), short=short), lambda w: F.struct(w.alias("token"), F.lit(2).alias("w"))),
                F.transform(tokens(F.col("category"), short=short), lambda w: F.struct(w.alias("token"), F.lit(1).alias("w"))),
                F.array(F.struct(prefix.alias("token"), F.lit(3).alias("w"))),
            )
        ).alias("t"),
    ).select("form_id", "t.token", "t.w")
    index = weighted.groupBy("token", "form_id").agg(F.sum("w").alias("w"))
    asked = queries.select("query_id", F.explode(tokens(F.col("query"), short=short)).alias("token"))
    common = index.groupBy("token").count().where(F.col("count") > HOT_FORMS).select("token")
    if common.isEmpty():
        scored = asked.join(index, "token").groupBy("query_id", "form_id").agg(F.sum("w").alias("score"))
    else:
        scored = _with_common_words(asked, index, cut_lineage(common), k)
    rest = scored.join(named, ["query_id", "form_id"], "left_anti").select(
        "query_id", "form_id", F.lit(False).alias("named"), F.col("score"), F.lit(None).cast("struct<at:int,variant:int>").alias("rank")
    )
    pinned = named.select("query_id", "form_id", F.lit(True).alias("named"), F.lit(0).cast("bigint").alias("score"), "rank")
    w = Window.partitionBy("query_id").orderBy(F.desc("named"), "rank", F.desc("score"), "form_id")
    return (
        pinned.unionByName(rest)
        .withColumn("place", F.row_number().over(w))
        .where(F.col("place") <= k)
        .select("query_id", "place", "form_id", "named", "score")
    )


def routing_eval(ranked: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled events: expected forms present, negative forms absent, and
    whether the first choice was expected.

    ``labels``: event_id, form_id, expected (boolean).
    """
    j = labels.join(ranked.select("event_id", "form_id", "place"), ["event_id", "form_id"], "left")
    hit = F.col("place").isNotNull()
    return j.groupBy("event_id").agg(
        F.count_if(F.col("expected") & hit).alias("expected_found"),
        F.count_if(F.col("expected") & ~hit).alias("expected_missed"),
        F.count_if(~F.col("expected") & hit).alias("negative_found"),
        F.coalesce(F.max(F.col("expected") & (F.col("place") == 1)), F.lit(False)).alias("top1"),
    )


def eval_summary(evals: DataFrame) -> DataFrame:
    return evals.agg(
        F.count("*").alias("n"),
        F.round(F.avg(F.col("top1").cast("int")), 6).alias("top1_accuracy"),
        F.round(F.avg((F.col("expected_missed") == 0).cast("int")), 6).alias("all_expected"),
        F.round(F.avg((F.col("negative_found") > 0).cast("int")), 6).alias("any_negative"),
    )


def router_menu(forms: DataFrame, hints: DataFrame) -> DataFrame:
    """One bar-separated line per form with its token estimate."""
    line = F.concat_ws(" | ", "form_id", "category", "title", "hint")
    return forms.join(hints, "form_id", "left").select(
        "form_id", line.alias("line"), F.expr("CAST(length(concat_ws(' | ', form_id, category, title, hint)) DIV 4 AS BIGINT)").alias("tokens")
    )


TEMPLATE_TYPE = (
    "array<struct<seq:int,type:string,offset_days:int,requires_fact:string,"
    "override:map<string,string>,sets:map<string,string>,copies:map<string,string>,defaults:map<string,string>>>"
)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _merge(base: Column, over: Column) -> Column:
    """Map merge, the right side winning; null values remove their key."""

    def merged(over: Column) -> Column:
        kept = F.map_filter(base, lambda k, v: ~F.map_contains_key(over, k))
        return F.map_concat(kept, F.map_filter(over, lambda k, v: v.isNotNull()))

    return _once(F.coalesce(over, F.create_map().cast("map<string,string>")), merged)


def _falsy(v: Column) -> Column:
    return ~present(F.coalesce(v, F.lit(""))) | (F.lower(v) == "false")


def expand_lifecycle(cases: DataFrame, templates: DataFrame) -> DataFrame:
    """Template rows of a case's type as dated events with the facts at hand.

    ``cases``: case_id, case_type, anchor_date, facts.  ``templates``: one row
    per case type with ``steps`` of ``TEMPLATE_TYPE``.  Overrides hold before
    an event and from then on; ``sets``, ``copies`` (target ← source, if the
    target is free) and ``defaults`` take effect after it.  A step whose fact
    is missing is left out.  Templates have tens of steps, so each case folds
    over one short array.
    """
    by_seq = lambda a, b: a["seq"] - b["seq"]
    ordered = templates.select("case_type", F.array_sort("steps", by_seq).alias("steps"))
    start = F.struct(
        F.col("facts").alias("facts"),
        F.expr("CAST(array() AS ARRAY<STRUCT<seq:INT,type:STRING,event_date:DATE,facts:MAP<STRING,STRING>>>)").alias("events"),
    )

    def step(acc: Column, s: Column) -> Column:
        skip = s["requires_fact"].isNotNull() & _falsy(F.try_element_at(acc["facts"], s["requires_fact"]))
        day = F.date_add(F.col("anchor_date"), s["offset_days"])
        return F.when(skip, acc).otherwise(_once(_merge(acc["facts"], s["override"]), lambda now: held(acc, s, day, now)))

    def held(acc: Column, s: Column, day: Column, now: Column) -> Column:
        sets = F.transform_values(
            F.coalesce(s["sets"], F.create_map().cast("map<string,string>")),
            lambda k, v: F.replace(v, F.lit("{event_date}"), F.date_format(day, "yyyy-MM-dd")),
        )
        copies = F.transform_values(
            F.map_filter(F.coalesce(s["copies"], F.create_map().cast("map<string,string>")), lambda k, v: F.map_contains_key(now, v) & ~F.map_contains_key(now, k)),
            lambda k, v: F.try_element_at(now, v),
        )
        defaults = F.map_filter(
            F.coalesce(s["defaults"], F.create_map().cast("map<string,string>")), lambda k, v: _falsy(F.try_element_at(now, k))
        )
        after = _merge(_merge(_merge(now, copies), sets), defaults)
        event = F.struct(s["seq"].alias("seq"), s["type"].alias("type"), day.alias("event_date"), now.alias("facts"))
        return F.struct(after.alias("facts"), F.array_append(acc["events"], event).alias("events"))

    return (
        cases.join(ordered, "case_type")
        .select("case_id", "case_type", F.explode(F.aggregate("steps", start, step)["events"]).alias("e"))
        .select("case_id", "case_type", "e.seq", "e.type", "e.event_date", "e.facts")
    )


def narrative(cases: DataFrame) -> DataFrame:
    """Case and event as text: a header, the event, one sentence per party
    and per fact.

    ``cases``: case_id, case_type, county, event_type, event_date, parties
    (map role → map), facts (map).
    """
    plain = lambda c: F.replace(c, F.lit("_"), F.lit(" "))
    at = lambda p, k: F.try_element_at(p, F.lit(k))
    part = lambda lead, v: F.when(present(v), F.concat(F.lit(lead), v))

    def person(e: Column) -> Column:
        p = e["value"]
        name = V.full_name(at(p, "full_name"), at(p, "first_name"), at(p, "middle_name"), at(p, "last_name"))
        bits = F.concat_ws(", ", name, part("DOB ", at(p, "dob")), part("at ", at(p, "address")), part("phone ", at(p, "phone")), part("email ", at(p, "email")))
        return F.concat(F.initcap(plain(e["key"])), F.lit(": "), bits, F.lit("."))

    people = F.transform(F.array_sort(F.map_entries("parties"), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)), person)
    facts = F.transform(
        F.array_sort(F.map_entries("facts")), lambda e: F.concat(F.upper(F.substring(plain(e["key"]), 1, 1)), F.expr("''"), F.substring(plain(e["key"]), F.lit(2), F.length(e["key"])), F.lit(": "), e["value"], F.lit("."))
    )
    head = F.concat(F.lit("Case "), F.col("case_id").cast("string"), F.lit(" ("), plain(F.col("case_type")), F.lit(")"), F.when(present(F.col("county")), F.concat(F.lit(" in "), "county", F.lit(" County"))).otherwise(""), F.lit("."))
    event = F.concat(F.lit("Triggering event: "), plain(F.col("event_type")), F.lit(" on "), "event_date", F.lit("."))
    return cases.select("case_id", F.array_join(F.concat(F.array(head, event), people, facts), "\n").alias("narrative"))
