"""Values as written on forms: dates, numbers, yes/no, names and addresses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from formloom.functions.text import present

# Words read as yes or no.
YES_WORDS = ("yes", "true", "1", "x", "checked", "y", "on")
NO_WORDS = ("no", "false", "0", "n", "off", "unchecked", "none")
MONTHS = (
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
)
# How amounts are written, alone and in prose.
MONEY = r"^-?\$?\d{1,3}(,\d{3})*(\.\d{1,2})?$|^-?\$?\d+(\.\d{1,2})?$"
MONEY_IN_TEXT = r"\$?\d{1,3}(?:,\d{3})+(?:\.\d{1,2})?|\$\d+(?:\.\d{1,2})?"


def norm(value: Column) -> Column:
    """Lower case, single spaces; null becomes empty."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(value, F.lit("")), r"\s+", " ")))


def truthy(value: Column) -> Column:
    """True, false, or null when the word is neither; blank is false."""
    v = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    return F.when(v.isin(list(YES_WORDS)), True).when(v.isin(list(NO_WORDS)) | (v == ""), False)


def _month_number(name: Column) -> Column:
    full = [x for i, m in enumerate(MONTHS, 1) for x in (F.lit(m.lower()), F.lit(i))]
    short = [x for i, m in enumerate(MONTHS, 1) if m != "May" for x in (F.lit(m[:3].lower()), F.lit(i))]
    return F.try_element_at(F.create_map(*full, *short), F.lower(name))


def parse_date_any(value: Column) -> Column:
    """Calendar date from seven written forms, else null.

    ISO, month/day/year with four or two digits, "April 2, 2025" with full or
    short month and optional comma, and "2 April 2025".
    """
    s = F.trim(value)
    part = lambda pattern, i: F.regexp_extract(s, pattern, i)
    iso, us = r"^(\d{4})-(\d{1,2})-(\d{1,2})$", r"^(\d{1,2})/(\d{1,2})/(\d{4}|\d{2})$"
    words, day_first = r"^([A-Za-z]+)\s+(\d{1,2}),?\s+(\d{4})$", r"^(\d{1,2})\s+([A-Za-z]+)\s+(\d{4})$"
    short_year = part(us, 3).try_cast("int")
    us_year = F.when(
        F.length(part(us, 3)) == 2, F.when(short_year >= 69, short_year + 1900).otherwise(short_year + 2000)
    ).otherwise(short_year)
    dashed = lambda y, m, d: F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), m.cast("string"), d.cast("string"))
    ymd = (
        F.when(s.rlike(iso), dashed(part(iso, 1), part(iso, 2), part(iso, 3)))
        .when(s.rlike(us), dashed(us_year, part(us, 1), part(us, 2)))
        .when(s.rlike(words), dashed(part(words, 3), F.coalesce(_month_number(part(words, 1)), F.lit(0)), part(words, 2)))
        .when(s.rlike(day_first), dashed(part(day_first, 3), F.coalesce(_month_number(part(day_first, 2)), F.lit(0)), part(day_first, 1)))
    )
    return F.try_to_timestamp(ymd, F.lit("yyyy-M-d")).cast("date")


def split_date(value: Column) -> Column:
    """("April 2", "25") for a printed "____, 20__" slot pair, else null."""
    d = parse_date_any(value)
    return F.when(
        d.isNotNull(),
        F.struct(
            F.date_format(d, "MMMM d").alias("month_day"), F.date_format(d, "yy").alias("year2")
        ),
    )


def date_words(value: Column) -> Column:
    """Day, month name and two-digit year of a date."""
    d = parse_date_any(value)
    return F.when(
        d.isNotNull(),
        F.struct(
            F.day(d).cast("string").alias("day"),
            F.date_format(d, "MMMM").alias("month"),
            F.date_format(d, "yy").alias("year"),
        ),
    )


def parse_number(value: Column) -> Column:
    """Decimal from text with currency signs, commas, percent and accounting
    negatives; null when it is not a number."""
    s = F.regexp_replace(F.trim(value), r"[$,%]", "")
    s = F.trim(F.replace(F.replace(s, F.lit("("), F.lit("-")), F.lit(")"), F.lit("")))
    return F.when(s != "", s).try_cast("decimal(18,2)")


def to_amount(value: Column) -> Column:
    """Like ``parse_number`` without accounting forms; blank counts as 0."""
    s = F.regexp_replace(F.coalesce(value, F.lit("")), r"[$,]", "")
    return F.when(s == "", F.lit(0).cast("decimal(18,2)")).otherwise(s.try_cast("decimal(18,2)"))


def to_double(value: Column) -> Column:
    """Like ``to_amount``, to all the places that are written, for comparisons."""
    s = F.regexp_replace(F.coalesce(value, F.lit("")), r"[$,]", "")
    plain = s.rlike(r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$")
    return F.when(s == "", F.lit(0.0)).when(plain, F.trim(s).try_cast("double"))


def is_money(value: Column) -> Column:
    return F.trim(value).rlike(MONEY)


def extract_currency(value: Column) -> Column:
    """First amount found in prose, without the sign; else empty."""
    return F.regexp_replace(F.regexp_extract(value, MONEY_IN_TEXT, 0), r"^\$+", "")


def age_on(dob: Column, day: Column) -> Column:
    """Whole years between 1 and 119 on a given day, else null."""
    years = F.year(day) - F.year(dob)
    before = (F.month(day) * 100 + F.day(day)) < (F.month(dob) * 100 + F.day(dob))
    age = years - before.cast("int")
    return F.when(age.between(1, 119), age)


def shift_date(value: Column, days: int = 0, years: int = 0) -> Column:
    moved = F.date_add(value, days) if days else value
    return F.add_months(moved, 12 * years) if years else moved


def join_present(sep: str, *parts: Column) -> Column:
    return F.concat_ws(sep, *[F.when(present(p), F.trim(p)) for p in parts])


def full_name(full: Column, first: Column, middle: Column, last: Column) -> Column:
    return F.when(present(full), F.trim(full)).otherwise(join_present(" ", first, middle, last))


def address_line(address: Column, city: Column, state: Column, zip_code: Column) -> Column:
    place = join_present(", ", address, join_present(", ", city, state))
    return F.trim(join_present(" ", place, zip_code))


def render_list(values: Column) -> Column:
    """Items joined by "; ", blanks left out."""
    return F.array_join(F.filter(values, lambda v: present(v)), "; ")


def render_records(records: Column, fields: Sequence[str]) -> Column:
    """Each record's values joined by ", ", records by "; "."""
    return render_list(F.transform(records, lambda r: join_present(", ", *[r[f] for f in fields])))


def link_status(code: Column) -> Column:
    """What an HTTP status says about a link."""
    return (
        F.when(code.between(200, 399), "live")
        .when(code.isin(404, 410), "dead")
        .when(code.isin(401, 403, 405, 429), "blocked")
        .when(code.between(500, 599), "error")
        .otherwise("inconclusive")
    )


def canonical_json(**fields: Column) -> Column:
    """Compact JSON with sorted keys."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def digest(value: Column) -> Column:
    return F.sha2(F.encode(F.coalesce(value, F.lit("")), "UTF-8"), 256)


def seeded_number(key: Column) -> Column:
    """A stable number of 32 bits from a text key."""
    return F.conv(F.substring(digest(key), 1, 8), 16, 10).cast("bigint")


def seeded_pick(key: Column, n: int) -> Column:
    """A stable choice in 0 … n-1 from a text key."""
    return (seeded_number(key) % n).cast("int")


def seeded_order(key: Column, seed: int) -> Column:
    """What a repeatable sample is ordered by."""
    return digest(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))


def seeded_choice(key: Column, bank: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(b) for b in bank]), seeded_pick(key, len(bank)) + 1)


def capacity(width: Column, char_width: float, padding: float = 2.0) -> Column:
    """Characters that fit a widget of ``width`` points, at least one."""
    return F.greatest(F.lit(1), F.floor((width - 2 * padding) / char_width)).cast("int")


def wrap_lines(text: Column, capacities: Column) -> Column:
    """Greedy word wrap over widgets of the given capacities.

    Returns ``lines`` (one per widget) and ``rest``, the words left over.  A
    word too wide for a widget moves on to the next one that can hold it.
    """
    words = F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != "")
    start = F.struct(
        F.transform(capacities, lambda c: F.lit("")).alias("lines"), F.lit(0).alias("at"), F.lit("").alias("rest")
    )

    def place(acc: Column, word: Column) -> Column:
        slots = F.sequence(F.lit(0), F.size(capacities) - 1)
        joined = lambda i: F.trim(F.concat_ws(" ", F.get(acc["lines"], i), word))
        room = F.filter(
            slots, lambda i: (i >= acc["at"]) & (F.length(joined(i)) <= F.get(capacities, i))
        )
        here = F.when(acc["rest"] == "", F.try_element_at(room, F.lit(1)))
        return F.struct(
            F.transform(acc["lines"], lambda s, i: F.when(i == here, F.trim(F.concat_ws(" ", s, word))).otherwise(s)).alias("lines"),
            F.coalesce(here, F.size(capacities)).alias("at"),
            F.when(here.isNull(), F.trim(F.concat_ws(" ", acc["rest"], word))).otherwise(acc["rest"]).alias("rest"),
        )

    return F.when(F.size(capacities) > 0, F.aggregate(words, start, place)).otherwise(
        F.struct(F.array().cast("array<string>").alias("lines"), F.lit(0).alias("at"), F.trim(text).alias("rest"))
    )


def split_address(value: Column, n_widgets: int) -> Column:
    """A comma-separated address over widgets: street first, the rest after;
    with three or more, one segment each and the tail in the last."""
    parts = F.transform(F.split(value, ","), lambda p: F.trim(p))
    if n_widgets == 1:
        return F.array(value)
    segs = [
        F.coalesce(F.get(parts, F.lit(i)), F.lit("")) for i in range(n_widgets - 1)
    ] + [F.array_join(F.when(F.size(parts) >= n_widgets, F.slice(parts, n_widgets, F.greatest(F.size(parts), F.lit(1)))).otherwise(F.array().cast("array<string>")), ", ")]
    blank = [F.lit("")] * (n_widgets - 1)
    return F.when(F.size(parts) < 2, F.array(value, *blank)).otherwise(F.array(*segs))


def recover_json_objects(text: Column, schema: str) -> Column:
    """Complete innermost objects of a truncated or fenced JSON array."""
    bodies = F.regexp_extract_all(text, F.lit(r"\{[^{}]+\}"), 0)
    parsed = F.transform(bodies, lambda b: F.from_json(F.regexp_replace(b, r",\s*\}", "}"), schema))
    return F.array_compact(parsed)


HEDGED = r"(?i)\b(e\.g\.|maybe|perhaps|or similar|something like|or\s+['\"`])"


def extract_rename(details: Column, patterns: Sequence[str]) -> Column:
    """A suggested field name from issue text, unless the text hedges."""
    found = F.coalesce(*[F.nullif(F.regexp_extract(details, p, 1), F.lit("")) for p in patterns])
    return F.when(~details.rlike(HEDGED), found)


# Look-alike hyphens and spaces, and characters that print nothing, by code point.
HYPHENS = "".join(map(chr, (0x2010, 0x2011, 0x2012, 0x2013, 0x2212)))
SPACES = "".join(map(chr, (0x00A0, 0x2007, 0x2008, 0x2009, 0x200A, 0x202F, 0x205F, 0x3000)))
INVISIBLE = "".join(
    map(
        chr,
        (0x200B, 0x200C, 0x200D, 0xFEFF, 0x2060, 0x200E, 0x200F, 0x061C, 0x202A, 0x202B,
         0x202C, 0x202D, 0x202E, 0x2066, 0x2067, 0x2068, 0x2069, 0x00AD),
    )
)


def fold_lookalikes(text: Column) -> Column:
    """Hyphen and space look-alikes to ASCII; invisible characters removed."""
    t = F.coalesce(text, F.lit(""))
    return F.translate(t, HYPHENS + SPACES + INVISIBLE, "-" * len(HYPHENS) + " " * len(SPACES))


def extract_section(text: Column, heading: str, next_heading: str, markers: Sequence[str]) -> Column:
    """From a heading to the next other heading or footer marker; the whole
    text when the heading is absent.

    ``heading`` is literal; ``next_heading`` is a regex for any heading line.
    """
    at = F.locate(heading, text)
    tail = F.substring(text, at, F.length(text))
    body = F.substring(tail, F.lit(len(heading) + 1), F.length(tail))
    stops = [F.nullif(F.regexp_instr(body, F.lit(next_heading)), F.lit(0)) + len(heading)]
    stops += [F.nullif(F.locate(m, tail), F.lit(0)) for m in markers]
    end = F.coalesce(F.least(*stops), F.length(tail) + 1) if len(stops) > 1 else F.coalesce(stops[0], F.length(tail) + 1)
    return F.when(at > 0, F.trim(F.substring(tail, F.lit(1), end - 1))).otherwise(text)


def shared_letters(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two short texts."""
    letters = lambda text: F.filter(F.split(text, ""), lambda c: c != "")

    def against(bs: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(bs) - 1)

        def line(row: Column, c: Column) -> Column:
            # row[j]: letters shared so far with the first j + 1 letters of b
            def cell(new: Column, j: Column) -> Column:
                corner = F.when(j > 0, F.get(row, j - 1)).otherwise(0)
                beside = F.when(j > 0, F.get(new, j - 1)).otherwise(0)
                return F.array_append(new, F.when(c == F.get(bs, j), corner + 1).otherwise(F.greatest(F.get(row, j), beside)))

            return F.aggregate(places, F.array().cast("array<int>"), cell)

        last = F.aggregate(letters(a), F.transform(bs, lambda _: F.lit(0)), line)
        return F.coalesce(F.element_at(last, -1), F.lit(0))

    found = F.get(F.transform(F.array(letters(b)), against), F.lit(0))
    return F.when((a == "") | (b == ""), F.lit(0)).otherwise(found)


def letter_ratio(a: Column, b: Column) -> Column:
    """Share of letters, in percent, that two texts have in common in order."""
    both = F.char_length(a) + F.char_length(b)
    return F.when(both == 0, F.lit(100.0)).otherwise(200.0 * shared_letters(a, b) / both)


def token_set_ratio(a: Column, b: Column) -> Column:
    """Similarity of two texts as sets of words, 0 to 100.

    The shared words, alone and with what either side has besides, are compared
    with one another; the best of the three comparisons counts.
    """
    words = lambda text: F.array_sort(F.array_distinct(F.filter(F.split(text, r"\s+"), lambda w: w != "")))
    joined = lambda *parts: F.array_join(F.filter(F.array(*parts), lambda p: p != ""), " ")

    def compare(p: Column) -> Column:
        shared, only_a, only_b = p["shared"], p["only_a"], p["only_b"]
        with_a, with_b = joined(shared, only_a), joined(shared, only_b)
        n = F.char_length(shared)
        # A beginning that both have needs no search for common letters.
        ahead = n + F.when((n > 0) & (only_a != "") & (only_b != ""), 1).otherwise(0)
        long = F.char_length(with_a) + F.char_length(with_b)
        rest = 200.0 * (ahead + shared_letters(only_a, only_b)) / long
        beside = lambda w: 200.0 * n / (n + F.char_length(w))
        best = F.when(n > 0, F.greatest(rest, beside(with_a), beside(with_b))).otherwise(rest)
        return F.when(long == 0, F.lit(0.0)).when((n > 0) & ((only_a == "") | (only_b == "")), F.lit(100.0)).otherwise(best)

    def parts(s: Column) -> Column:
        text = lambda c: F.array_join(c, " ")
        return F.struct(
            text(F.array_intersect(s["a"], s["b"])).alias("shared"),
            text(F.array_except(s["a"], s["b"])).alias("only_a"),
            text(F.array_except(s["b"], s["a"])).alias("only_b"),
        )

    sets = F.array(F.struct(words(a).alias("a"), words(b).alias("b")))
    return F.get(F.transform(F.transform(sets, parts), compare), F.lit(0))
