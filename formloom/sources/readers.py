"""Reading layouts, form packages, answers, logs and marked-up texts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from formloom import contracts
from formloom.functions.text import present


class Layout(NamedTuple):
    pages: DataFrame
    lines: DataFrame
    spans: DataFrame
    drawings: DataFrame


def flatten_layout(forms: DataFrame) -> Layout:
    """Nested per-form layouts as flat page, line, span and drawing tables.

    Ids are positions within the page, so a rerun gives the same ids.
    """
    page = forms.select("form_id", "category", F.explode("pages").alias("p"))
    at = [F.col("form_id"), F.col("p.page_number").alias("page")]
    rect = lambda c: [F.col(f"{c}.{k}").alias(k) for k in ("x0", "y0", "x1", "y1")]
    pages = page.select(*at, "category", "p.width", "p.height", "p.rotation")
    blocks = page.select(*at, F.posexplode("p.text_blocks").alias("b", "block"))
    lines = blocks.select("form_id", "page", "b", F.posexplode("block.lines").alias("l", "line")).withColumn(
        "line_id", F.concat_ws("-", F.col("b").cast("string"), F.col("l").cast("string"))
    )
    spans = lines.select("form_id", "page", "line_id", F.posexplode("line.spans").alias("s", "span"))
    return Layout(
        pages,
        lines.select(
            "form_id", "page", "line_id",
            F.array_join(F.transform("line.spans", lambda s: s["text"]), " ").alias("text"), *rect("line.bbox"),
        ),
        spans.select(
            "form_id", "page", "line_id",
            F.concat_ws("-", "line_id", F.col("s").cast("string")).alias("span_id"),
            "span.text", *rect("span.bbox"), "span.font", "span.size", "span.color", "span.flags",
        ),
        page.select(*at, F.posexplode("p.drawings").alias("draw_id", "d")).select(
            "form_id", "page", "draw_id", "d.kind", *rect("d.rect"), "d.stroke", "d.fill", "d.line_width", "d.points"
        ),
    )


def read_layout(spark: SparkSession, path: str) -> Layout:
    """Layout JSON, one document per file."""
    return flatten_layout(spark.read.schema(contracts.LAYOUT).json(path, multiLine=True))


def _form_id(pattern: str = r"([^/]+)/[^/]+$") -> Column:
    return F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))


class Packages(NamedTuple):
    metadata: DataFrame
    fields: DataFrame
    geometry: DataFrame


def read_form_packages(spark: SparkSession, root: str) -> Packages:
    """Form folders ``<root>/<form_id>/`` with metadata.json, fields.csv and
    fill_geometry.json; the id comes from the path."""
    meta = spark.read.schema(contracts.METADATA).json(f"{root}/*/metadata.json", multiLine=True)
    fields = spark.read.schema(contracts.SCHEMA_FIELD).csv(f"{root}/*/fields.csv", header=True, escape='"', multiLine=True)
    geometry = spark.read.schema(contracts.GEOMETRY).json(f"{root}/*/fill_geometry.json", multiLine=True)
    return Packages(
        meta.withColumn("form_id", _form_id()),
        fields.select(_form_id().alias("form_id"), "*"),
        geometry.select(_form_id().alias("form_id"), "*"),
    )


def explode_geometry(geometry: DataFrame) -> DataFrame:
    """One row per widget and per option of each field."""
    field = geometry.select("form_id", F.explode("fields").alias("field_id", "f"))
    part = lambda items, kind, value: field.select(
        "form_id", "field_id", kind.alias("kind"), F.posexplode(items).alias("idx", "w")
    ).select(
        "form_id", "field_id", "kind", "idx", F.col("w.page").alias("page"),
        *[F.get("w.rect", F.lit(i)).alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))],
        value.alias("option_value"),
    )
    return part("f.widgets", F.col("f.type"), F.lit(None).cast("string")).unionByName(
        part("f.options", F.lit("choice"), F.col("w.value"))
    )


def flatten_answers(records: DataFrame) -> DataFrame:
    """Three accepted shapes of a filled record as (record_id, field_id, value).

    ``records``: record_id and ``body`` JSON: a map under ``answers``, a list
    under ``fields``, or a flat map.
    """
    body = F.from_json("body", contracts.RECORD_SHAPES)
    flat = F.from_json("body", "map<string,string>")
    entry = lambda k, v: F.struct(k.alias("field_id"), v.alias("value"))
    pairs = (
        F.when(F.col("b.answers").isNotNull(), F.transform(F.map_entries("b.answers"), lambda e: entry(e["key"], e["value"]["value"])))
        .when(F.col("b.fields").isNotNull(), F.transform("b.fields", lambda e: entry(e["field_id"], e["value"])))
        .otherwise(F.transform(F.map_entries(flat), lambda e: entry(e["key"], e["value"])))
    )
    return (
        records.select("record_id", "body", body.alias("b"))
        .select("record_id", F.explode(pairs).alias("p"))
        .where("p.field_id IS NOT NULL")
        .select("record_id", "p.*")
    )


def parse_log_lines(lines: DataFrame, schema: str, column: str = "line") -> tuple[DataFrame, DataFrame]:
    """Good rows of a JSON-lines log, and the malformed lines."""
    full = f"{schema}, _corrupt string"
    parsed = lines.where(present(F.col(column))).withColumn(
        "_p", F.from_json(column, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    )
    bad = parsed.where("_p._corrupt IS NOT NULL").drop("_p")
    names = [f.name for f in StructType.fromDDL(schema).fields]
    keep = [c for c in lines.columns if c != column]
    good = parsed.where("_p._corrupt IS NULL").select(*keep, *[F.col(f"_p.`{n}`").alias(n) for n in names])
    return good, bad


def read_jsonl_log(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """An append-only log: good rows, and malformed lines for a report."""
    return parse_log_lines(spark.read.text(path).withColumnRenamed("value", "line"), schema)


def stream_jsonl_log(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The same log as a stream of good rows."""
    return parse_log_lines(spark.readStream.text(folder).withColumnRenamed("value", "line"), schema)[0]


def inventory_urls(urls: DataFrame, categories: DataFrame) -> DataFrame:
    """URL to a safe file name, the form id before its first space, and the
    category folder of its path segment.

    ``categories``: segment, category.
    """
    path = F.parse_url("url", F.lit("PATH"))
    raw = F.try_url_decode(F.element_at(F.split(path, "/"), -1))
    safe = F.trim(F.regexp_replace(F.replace(F.replace(raw, F.lit(","), F.lit("_")), F.lit("&"), F.lit("and")), r"\s+", " "))
    stem = F.regexp_replace(F.col("file_name"), r"\.[^.]*$", "")
    segment = F.try_url_decode(F.element_at(F.split(path, "/"), -2))
    return (
        urls.select("*", safe.alias("file_name"), F.when(F.size(F.split(path, "/")) >= 2, segment).alias("segment"))
        .join(categories, "segment", "left")
        .select(*urls.columns, "file_name", F.substring_index(stem, " ", 1).alias("form_id"), F.coalesce("category", F.lit("other")).alias("category"))
    )


def front_matter_index(texts: DataFrame, keys: Sequence[str], required: Sequence[str], overrides: DataFrame) -> DataFrame:
    """Texts that open with a ``---`` header as one row of routing columns.

    ``texts``: form_id, text.  ``overrides``: form_id and any of the keys; what
    it gives wins.  ``missing`` lists required keys left blank.
    """
    head = F.regexp_extract("text", r"(?s)^---\s*\n(.*?)\n---\s*(?:\n|$)", 1)
    value = lambda k: F.nullif(F.trim(F.regexp_extract(F.col("_head"), rf"(?m)^{k}:[ \t]*(.*)$", 1)), F.lit(""))
    unquoted = lambda c: F.regexp_replace(c, r"""^(['"])(.*)\1$""", "$2")
    parsed = texts.withColumn("_head", head).where("_head <> ''").select("form_id", *[unquoted(value(k)).alias(k) for k in keys])
    given = [c for c in overrides.columns if c != "form_id"]
    over = overrides.select("form_id", *[F.col(c).alias("o_" + c) for c in given])
    merged = parsed.join(over, "form_id", "left")
    final = {k: F.coalesce("o_" + k, k) if k in given else F.col(k) for k in keys}
    missing = F.concat_ws(",", *[F.when(final[k].isNull(), F.lit(k)) for k in required])
    return merged.select("form_id", *[c.alias(k) for k, c in final.items()], missing.alias("missing"))


def read_front_matter(spark: SparkSession, pattern: str) -> DataFrame:
    """Whole texts with the id of the folder they stand in."""
    return spark.read.text(pattern, wholetext=True).select(_form_id().alias("form_id"), F.col("value").alias("text"))
