"""Layout, record and log tables derived from the given parquet tables.

The given tables hold no form layouts, so each contract is a fixed projection
of them.  ``Tables`` builds the Spark side; ``CTE`` holds the same projections
as DuckDB SQL for the oracles.  Coordinates are whole numbers stored as
doubles, so both engines compute the same bits.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_W, PAGE_H = 612.0, 792.0

#: Unique on a page and in the order of its columns; the same text in both engines.
RECT_ID = (
    "((((l_orderkey % 16) * 33554432 + l_partkey % 33554432) * 33554432 + l_suppkey % 33554432) * 8"
    " + CAST(l_linenumber AS BIGINT)) * 64 + CAST(l_quantity AS BIGINT)"
)


class Tables:
    """The given tables of one folder, and the contracts derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # ---- layouts -----------------------------------------------------------

    @cached_property
    def rect(self) -> DataFrame:
        """Widgets: one per line item, with an id packed from its columns, so
        that the table is one scan: no exchange comes before the real work."""
        base = self.raw("lineitem").select(
            F.expr("l_orderkey DIV 16").alias("form_id"),
            (F.col("l_linenumber") % 2).alias("page"),
            F.expr(RECT_ID).alias("rect_id"),
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            F.col("l_quantity").cast("bigint").alias("q"),
        )
        x0 = (20 + (F.col("l_partkey") % 28) * 20).cast("double")
        y0 = (20 + (F.col("l_suppkey") % 37) * 20).cast("double")
        return base.select(
            "form_id",
            "page",
            "rect_id",
            x0.alias("x0"),
            y0.alias("y0"),
            (x0 + 10 + F.col("q") * 4).alias("x1"),
            (y0 + 10 + (F.col("l_linenumber") % 3) * 4).alias("y1"),
            F.concat(F.lit("f"), (F.col("l_partkey") % 9).cast("string")).alias("field_id"),
            F.when(F.col("q") % 5 == 0, "choice").when(F.col("l_partkey") % 4 == 0, "date").otherwise("text").alias("kind"),
            "q",
            F.col("l_partkey").alias("part"),
            F.col("l_suppkey").alias("supp"),
            F.col("l_linenumber").alias("line_no"),
        )

    @cached_property
    def rect_b(self) -> DataFrame:
        """A second detector: the same widgets, some missing, all jittered."""
        dx = ((F.col("part") % 3) - 1).cast("double")
        dy = ((F.col("supp") % 3) - 1).cast("double")
        return self.rect.where(F.col("part") % 10 < 8).select(
            "form_id",
            "page",
            "rect_id",
            (F.col("x0") + dx).alias("x0"),
            (F.col("y0") + dy).alias("y0"),
            (F.col("x1") + dx).alias("x1"),
            (F.col("y1") + dy).alias("y1"),
            "field_id",
            "kind",
        )

    @cached_property
    def rule(self) -> DataFrame:
        """Printed horizontal rules (zero height)."""
        y = F.col("y1") + (F.col("part") % 4)
        return self.rect.where("q >= 20").select(
            "form_id",
            "page",
            F.col("rect_id").alias("rule_id"),
            "x0",
            y.alias("y0"),
            (F.col("x0") + F.col("q") * 8).alias("x1"),
            y.alias("y1"),
        )

    @cached_property
    def vrule(self) -> DataFrame:
        """Printed vertical rules (zero width)."""
        return self.rect.where("q < 20").select(
            "form_id",
            "page",
            F.col("rect_id").alias("vrule_id"),
            "x0",
            "y0",
            F.col("x0").alias("x1"),
            (F.col("y0") + 200).alias("y1"),
        )

    @cached_property
    def word(self) -> DataFrame:
        """Printed words and labels."""
        part = self.raw("part").select("p_partkey", "p_name")
        return (
            self.rect.where("line_no >= 5")
            .join(part, F.col("part") == F.col("p_partkey"))
            .select(
                "form_id",
                "page",
                F.col("rect_id").alias("line_id"),
                F.when(F.col("part") % 13 == 0, F.concat(F.lit("20__ "), "p_name"))
                .when(F.col("part") % 11 == 0, F.lit("$"))
                .when(F.col("part") % 7 == 0, F.concat((F.col("part") % 9).cast("string"), F.lit(". "), "p_name", F.lit(" information")))
                .when(F.col("part") % 5 == 0, F.concat("p_name", F.lit(" date of:")))
                .otherwise(F.col("p_name"))
                .alias("text"),
                "x0",
                "y0",
                (F.col("x0") + 10 + F.col("q") * 2).alias("x1"),
                (F.col("y0") + 10).alias("y1"),
                "q",
                "part",
            )
        )

    @cached_property
    def span(self) -> DataFrame:
        """Text spans: underscore blanks, empty box glyphs and plain words."""
        square = F.col("q") % 4 == 0
        return self.word.select(
            "form_id",
            "page",
            F.col("line_id").alias("span_id"),
            F.when(square & (F.col("part") % 2 == 0), "")
            .when(square, "□")
            .when(F.col("q") % 4 == 1, F.concat("text", F.expr("repeat('_', CAST(4 + part % 20 AS INT))"), F.lit(" or "), F.expr("repeat('_', CAST(part % 9 AS INT))")))
            .otherwise(F.col("text"))
            .alias("text"),
            "x0",
            "y0",
            F.when(square, F.col("x0") + 8 + F.col("part") % 8).otherwise(F.col("x1") + 200).alias("x1"),
            "y1",
        )

    @cached_property
    def drawing(self) -> DataFrame:
        """All drawn elements of a page: rules, vertical rules and boxes."""
        cols = ["form_id", "page", "draw_id", "kind", "x0", "y0", "x1", "y1"]
        parts = [
            self.rule.withColumnRenamed("rule_id", "draw_id").withColumn("kind", F.lit("line")),
            self.vrule.withColumnRenamed("vrule_id", "draw_id").withColumn("kind", F.lit("rect")),
            self.box.withColumnRenamed("box_id", "draw_id").withColumn("kind", F.lit("rect")),
        ]
        out = parts[0].select(cols)
        for p in parts[1:]:
            out = out.unionByName(p.select(cols))
        return out

    @cached_property
    def box(self) -> DataFrame:
        """Printed choice boxes."""
        part = self.raw("part").select("p_partkey", "p_name")
        return (
            self.rect.where("q % 5 = 0")
            .join(part, F.col("part") == F.col("p_partkey"))
            .select(
                "form_id",
                "page",
                F.col("rect_id").alias("box_id"),
                "x0",
                "y0",
                (F.col("x0") + 10 + F.col("part") % 3).alias("x1"),
                (F.col("y0") + 10).alias("y1"),
                F.col("p_name").alias("label"),
            )
        )

    @cached_property
    def page(self) -> DataFrame:
        return self.rect.select("form_id", "page").distinct().select(
            "form_id",
            "page",
            F.lit(PAGE_W).alias("width"),
            F.lit(PAGE_H).alias("height"),
        )

    # ---- schemas and records ----------------------------------------------

    @cached_property
    def field(self) -> DataFrame:
        """Schema fields: one per part."""
        return self.raw("part").select(
            F.col("p_brand").alias("form_id"),
            F.concat(
                F.regexp_replace("p_name", " ", "_"), F.lit("_"), (F.col("p_partkey") % 7).cast("string")
            ).alias("field_id"),
            F.col("p_partkey").alias("seq"),
            F.col("p_name").alias("label"),
            F.expr(
                "CASE p_type WHEN 'ECONOMY' THEN 'date' WHEN 'STANDARD' THEN 'currency' "
                "WHEN 'PROMO' THEN 'choice' WHEN 'SMALL' THEN 'boolean' ELSE 'text' END"
            ).alias("data_type"),
            F.expr(
                "CASE WHEN p_size < 10 THEN 'identity' WHEN p_size < 20 THEN 'financial' "
                "WHEN p_size < 30 THEN 'signature' WHEN p_size < 40 THEN 'narrative' "
                "ELSE 'administrative' END"
            ).alias("category"),
            F.col("p_size").alias("size"),
        )

    @cached_property
    def answer(self) -> DataFrame:
        """Record answers in long form, with bad values planted by key."""
        orders = self.raw("orders").select(
            F.col("o_orderkey").alias("record_id"),
            F.expr("o_custkey % 12").alias("form_no"),
            F.expr(
                "stack(4, 'total', CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING), "
                "'order_date', date_format(o_orderdate, 'yyyy-MM-dd'), "
                "'priority', o_orderpriority, 'status', o_orderstatus)"
            ).alias("field_id", "v"),
        )
        return orders.select(
            "record_id",
            F.concat(F.lit("FX-"), F.lpad(F.col("form_no").cast("string"), 3, "0")).alias("form_id"),
            "field_id",
            F.expr(
                "CASE WHEN record_id % 97 = 0 THEN '' "
                "WHEN field_id = 'order_date' AND record_id % 101 = 0 THEN '2024-02-31' "
                "WHEN field_id = 'total' AND record_id % 103 = 0 THEN 'about $1,200.50' "
                "ELSE v END"
            ).alias("value"),
        )

    @cached_property
    def issue(self) -> DataFrame:
        """Audit issues: events read as findings of two audit variants."""
        return self.raw("events").select(
            F.col("user_id").alias("form_id"),
            (F.col("event_id") % 2).cast("int").alias("variant"),
            F.expr(
                "CASE event_type WHEN 'click' THEN 'alignment' WHEN 'error' THEN 'naming' "
                "WHEN 'purchase' THEN 'missing' ELSE 'other' END"
            ).alias("code"),
            F.expr("CASE WHEN value > 60 THEN 'high' WHEN value > 30 THEN 'medium' ELSE 'low' END").alias("severity"),
            "event_id",
            "ts",
            F.col("value").alias("weight"),
        )

    @cached_property
    def vote(self) -> DataFrame:
        """Every vote as cast; the latest per (key, voter) counts."""
        return self.raw("events").select(
            F.col("user_id").alias("key"),
            F.col("event_type").alias("voter"),
            F.expr("CASE WHEN value > 60 THEN 'major' WHEN value > 30 THEN 'minor' ELSE 'ok' END").alias("verdict"),
            "ts",
            "event_id",
        )

    @cached_property
    def snap_a(self) -> DataFrame:
        return self.raw("pages").select(
            F.col("page_id").alias("id"), "url", F.sha2(F.encode("html", "UTF-8"), 256).alias("digest"), F.length("html").cast("bigint").alias("size")
        )

    @cached_property
    def snap_b(self) -> DataFrame:
        pages = self.raw("pages")
        changed = F.when(F.col("page_id") % 7 == 0, F.concat("html", F.lit("!"))).otherwise(F.col("html"))
        kept = pages.where("page_id % 11 <> 0").select(F.col("page_id").alias("id"), "url", changed.alias("html"))
        extra = pages.where("page_id % 13 = 0").select((F.col("page_id") + 100000).alias("id"), "url", "html")
        return kept.unionByName(extra).select(
            "id", "url", F.sha2(F.encode("html", "UTF-8"), 256).alias("digest"), F.length("html").cast("bigint").alias("size")
        )


# The same projections for DuckDB.  Each entry lists what it builds on.
CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "rect_base": (
        (),
        """SELECT form_id, page, l_partkey AS part, l_suppkey AS supp, l_linenumber AS line_no, q,
  rect_id
FROM (SELECT l_orderkey // 16 AS form_id, l_linenumber % 2 AS page, l_partkey, l_suppkey, l_linenumber,
  CAST(l_quantity AS BIGINT) AS q, """ + RECT_ID + """ AS rect_id FROM lineitem)""",
    ),
    "rect": (
        ("rect_base",),
        """SELECT form_id, page, rect_id, x0, y0, x0 + 10 + q * 4 AS x1, y0 + 10 + (line_no % 3) * 4 AS y1,
  'f' || CAST(part % 9 AS VARCHAR) AS field_id, CASE WHEN q % 5 = 0 THEN 'choice' WHEN part % 4 = 0 THEN 'date' ELSE 'text' END AS kind,
  q, part, supp, line_no
FROM (SELECT *, CAST(20 + (part % 28) * 20 AS DOUBLE) AS x0, CAST(20 + (supp % 37) * 20 AS DOUBLE) AS y0 FROM rect_base)""",
    ),
    "rect_b": (
        ("rect",),
        """SELECT form_id, page, rect_id, x0 + (part % 3) - 1 AS x0, y0 + (supp % 3) - 1 AS y0,
  x1 + (part % 3) - 1 AS x1, y1 + (supp % 3) - 1 AS y1, field_id, kind FROM rect WHERE part % 10 < 8""",
    ),
    "rule": (
        ("rect",),
        """SELECT form_id, page, rect_id AS rule_id, x0, y1 + part % 4 AS y0, x0 + q * 8 AS x1, y1 + part % 4 AS y1
FROM rect WHERE q >= 20""",
    ),
    "vrule": (
        ("rect",),
        "SELECT form_id, page, rect_id AS vrule_id, x0, y0, x0 AS x1, y0 + 200 AS y1 FROM rect WHERE q < 20",
    ),
    "word": (
        ("rect",),
        """SELECT form_id, page, rect_id AS line_id,
  CASE WHEN part % 13 = 0 THEN '20__ ' || p_name WHEN part % 11 = 0 THEN '$'
       WHEN part % 7 = 0 THEN CAST(part % 9 AS VARCHAR) || '. ' || p_name || ' information'
       WHEN part % 5 = 0 THEN p_name || ' date of:' ELSE p_name END AS text,
  x0, y0, x0 + 10 + q * 2 AS x1, y0 + 10 AS y1, q, part
FROM rect JOIN part AS p ON rect.part = p.p_partkey WHERE line_no >= 5""",
    ),
    "span": (
        ("word",),
        """SELECT form_id, page, line_id AS span_id, CASE WHEN q % 4 = 0 AND part % 2 = 0 THEN '' WHEN q % 4 = 0 THEN '□'
  WHEN q % 4 = 1 THEN text || repeat('_', CAST(4 + part % 20 AS INT)) || ' or ' || repeat('_', CAST(part % 9 AS INT)) ELSE text END AS text,
  x0, y0, CASE WHEN q % 4 = 0 THEN x0 + 8 + part % 8 ELSE x1 + 200 END AS x1, y1 FROM word""",
    ),
    "drawing": (
        ("rule", "vrule", "box"),
        """SELECT form_id, page, rule_id AS draw_id, 'line' AS kind, x0, y0, x1, y1 FROM rule
UNION ALL SELECT form_id, page, vrule_id, 'rect', x0, y0, x1, y1 FROM vrule
UNION ALL SELECT form_id, page, box_id, 'rect', x0, y0, x1, y1 FROM box""",
    ),
    "box": (
        ("rect",),
        """SELECT form_id, page, rect_id AS box_id, x0, y0, x0 + 10 + part % 3 AS x1, y0 + 10 AS y1, p_name AS label
FROM rect JOIN part AS p ON rect.part = p.p_partkey WHERE q % 5 = 0""",
    ),
    "page": (
        ("rect",),
        "SELECT DISTINCT form_id, page, CAST(612 AS DOUBLE) AS width, CAST(792 AS DOUBLE) AS height FROM rect",
    ),
    "field": (
        (),
        """SELECT p_brand AS form_id, replace(p_name, ' ', '_') || '_' || CAST(p_partkey % 7 AS VARCHAR) AS field_id,
  p_partkey AS seq, p_name AS label,
  CASE p_type WHEN 'ECONOMY' THEN 'date' WHEN 'STANDARD' THEN 'currency' WHEN 'PROMO' THEN 'choice'
       WHEN 'SMALL' THEN 'boolean' ELSE 'text' END AS data_type,
  CASE WHEN p_size < 10 THEN 'identity' WHEN p_size < 20 THEN 'financial' WHEN p_size < 30 THEN 'signature'
       WHEN p_size < 40 THEN 'narrative' ELSE 'administrative' END AS category, p_size AS size
FROM part""",
    ),
    "answer": (
        (),
        """SELECT record_id, 'FX-' || lpad(CAST(form_no AS VARCHAR), 3, '0') AS form_id, field_id,
  CASE WHEN record_id % 97 = 0 THEN '' WHEN field_id = 'order_date' AND record_id % 101 = 0 THEN '2024-02-31'
       WHEN field_id = 'total' AND record_id % 103 = 0 THEN 'about $1,200.50' ELSE v END AS value
FROM (
  SELECT o_orderkey AS record_id, o_custkey % 12 AS form_no, 'total' AS field_id,
    CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS v FROM orders
  UNION ALL SELECT o_orderkey, o_custkey % 12, 'order_date', strftime(o_orderdate, '%Y-%m-%d') FROM orders
  UNION ALL SELECT o_orderkey, o_custkey % 12, 'priority', o_orderpriority FROM orders
  UNION ALL SELECT o_orderkey, o_custkey % 12, 'status', o_orderstatus FROM orders)""",
    ),
    "issue": (
        (),
        """SELECT user_id AS form_id, CAST(event_id % 2 AS INTEGER) AS variant,
  CASE event_type WHEN 'click' THEN 'alignment' WHEN 'error' THEN 'naming' WHEN 'purchase' THEN 'missing' ELSE 'other' END AS code,
  CASE WHEN value > 60 THEN 'high' WHEN value > 30 THEN 'medium' ELSE 'low' END AS severity, event_id, ts, value AS weight
FROM events""",
    ),
    "vote": (
        (),
        """SELECT user_id AS key, event_type AS voter,
  CASE WHEN value > 60 THEN 'major' WHEN value > 30 THEN 'minor' ELSE 'ok' END AS verdict, ts, event_id FROM events""",
    ),
    "snap_a": (
        (),
        "SELECT page_id AS id, url, sha256(html) AS digest, length(html) AS size FROM pages",
    ),
    "snap_b": (
        (),
        """SELECT id, url, sha256(html) AS digest, length(html) AS size FROM (
  SELECT page_id AS id, url, CASE WHEN page_id % 7 = 0 THEN html || '!' ELSE html END AS html FROM pages WHERE page_id % 11 <> 0
  UNION ALL SELECT page_id + 100000, url, html FROM pages WHERE page_id % 13 = 0)""",
    ),
}


def oracle(uses: str, body: str) -> str:
    """``body`` prefixed with the derived tables named in ``uses``."""
    needed: list[str] = []

    def visit(name: str) -> None:
        if name in needed:
            return
        for base in CTE[name][0]:
            visit(base)
        needed.append(name)

    for name in uses.split():
        visit(name)
    body = body.strip()
    if not needed:
        return body
    ctes = ",\n".join(f"{name} AS (\n{CTE[name][1]}\n)" for name in needed)
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
