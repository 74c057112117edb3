"""Exports: catalogues, dictionaries, JSON schemas, placements and variables."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from formloom import contracts
from formloom.functions import schema_rules as S
from formloom.functions.text import present
from formloom.session import cut_lineage

# JSON-schema types of the exchange types.
JSON_TYPES = {
    "currency": '{"type":"number"}', "date": '{"type":"string","format":"date"}',
    "boolean": '{"type":"boolean"}', "email": '{"type":"string","format":"email"}',
}


def write_catalog(df: DataFrame, path: str, sep: str = ",") -> None:
    """CSV, or TSV with ``sep``, one file per task."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_form_packages(metadata: DataFrame, fields: DataFrame, geometry: DataFrame, root: str) -> DataFrame:
    """Write what ``read_form_packages`` reads; gives (form_id, name, n_bytes).

    Each form's three files are put together by Spark and written by the task
    that holds them, under names that do not depend on the attempt, so a
    repeated task writes the same files again.  ``root`` is a folder that all
    executors share; a form's fields fit one file.
    """
    names = [f.name for f in StructType.fromDDL(contracts.SCHEMA_FIELD)]
    cells = [F.col(n).cast("string") if n in fields.columns else F.lit(None).cast("string") for n in names]
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", *[F.coalesce(quoted(c), F.lit("")) for c in cells])
    rows = F.array_sort(F.collect_list(F.struct("seq", "field_id", line.alias("line"))))["line"]
    body = F.concat_ws("\n", F.lit(",".join(names)), rows, F.lit(""))
    parts = {
        "metadata.json": metadata.select("form_id", F.to_json(F.struct(*[c for c in metadata.columns if c != "form_id"])).alias("body")),
        "fields.csv": fields.groupBy("form_id").agg(body.alias("body")),
        "fill_geometry.json": geometry.select("form_id", F.to_json(F.struct(*[c for c in geometry.columns if c != "form_id"])).alias("body")),
    }
    files = reduce(DataFrame.unionByName, [df.select(F.col("form_id").cast("string").alias("form_id"), F.lit(name).alias("name"), "body") for name, df in parts.items()])

    def write(batches):
        store, base = pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", root) if ":" in root else "file://" + root)
        for batch in batches:
            sizes = []
            for form, name, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
                store.create_dir(f"{base}/{form}", recursive=True)
                with store.open_output_stream(f"{base}/{form}/{name}") as out:
                    out.write(body.encode())
                sizes.append(len(body.encode()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64())], names=["form_id", "name", "n_bytes"])

    return cut_lineage(files.mapInArrow(write, "form_id string, name string, n_bytes long"))


def bound_fields(fields: DataFrame) -> DataFrame:
    """Schema fields with exchange type and binding."""
    b = S.binding(F.col("source"), F.col("field_id"), F.col("data_type"))
    return fields.withColumns(
        {"canonical_type": S.canonical_type(F.col("data_type"), F.col("field_type")), "_b": b}
    ).select("*", "_b.*").drop("_b")


def condition_text(tree: Column) -> Column:
    """``{"all_of": [{"field": f, "equals": v}]}`` as readable text."""
    shape = "all_of array<struct<field:string,equals:string>>, any_of array<struct<field:string,equals:string>>"
    t = F.from_json(tree, shape)
    say = lambda items, word: F.array_join(F.transform(items, lambda c: F.concat(c["field"], F.lit(" == "), c["equals"])), f" {word} ")
    wrap = lambda s, items: F.when(F.size(items) > 1, F.concat(F.lit("("), s, F.lit(")"))).otherwise(s)
    return F.when(t["all_of"].isNotNull(), wrap(say(t["all_of"], "AND"), t["all_of"])).when(
        t["any_of"].isNotNull(), wrap(say(t["any_of"], "OR"), t["any_of"])
    )


def export_dictionary(fields: DataFrame) -> DataFrame:
    """Data dictionary rows: type, role, key, token, binding and conditions."""
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return bound_fields(fields).select(
        "form_id", "seq", "field_id", "label", "canonical_type", "data_type", blank("role"), blank("key"), blank("token"),
        F.col("kind").alias("binding_kind"), F.coalesce(condition_text(F.col("required_when")), F.lit("")).alias("required_when"),
    )


def export_variables(fields: DataFrame) -> DataFrame:
    """Variables by token, the first field of a form wins."""
    token = F.coalesce("token", "field_id")
    wanted = bound_fields(fields).where(~F.col("kind").isin("manual", "signature", "routing")).withColumn("name", token)
    first = wanted.groupBy("form_id", "name").agg(
        F.min_by(F.struct("field_id", "label", "canonical_type", "role", "kind"), F.struct("seq", "field_id")).alias("v"),
        F.count("*").alias("n_fields"),
    )
    return first.select("form_id", "name", "v.*", "n_fields")


LEAF = "struct<field:string,equals:variant,ne:variant,`in`:variant,exists:boolean,gt:variant,gte:variant,lt:variant,lte:variant>"


def condition_schema(tree: Column) -> Column:
    """A condition tree (JSON text) as JSON-schema text, null without one.

    Branches all_of, any_of and none_of over leaves equals, ne, in, exists (true)
    and gt, gte, lt, lte of one field.  A tree with any other leaf has no
    counterpart and gives null.
    """
    t = F.from_json(tree, f"all_of array<{LEAF}>, any_of array<{LEAF}>, none_of array<{LEAF}>")
    raw = lambda v: F.to_json(v)
    number = lambda name, v: F.concat(F.lit(f'{{"{name}":'), raw(v), F.lit("}"))

    def said(c: Column) -> Column:
        return (
            F.when(c["equals"].isNotNull(), F.concat(F.lit('{"const":'), raw(c["equals"]), F.lit("}")))
            .when(c["ne"].isNotNull(), F.concat(F.lit('{"not":{"const":'), raw(c["ne"]), F.lit("}}")))
            .when(c["in"].isNotNull(), F.concat(F.lit('{"enum":'), raw(c["in"]), F.lit("}")))
            .when(c["gt"].isNotNull(), number("exclusiveMinimum", c["gt"]))
            .when(c["gte"].isNotNull(), number("minimum", c["gte"]))
            .when(c["lt"].isNotNull(), number("exclusiveMaximum", c["lt"]))
            .when(c["lte"].isNotNull(), number("maximum", c["lte"]))
            .when(c["exists"], "{}")
        )

    def together(leaves: Column) -> Column:
        # Of two conditions on one field the later holds.
        last = F.filter(leaves, lambda c, i: ~F.exists(F.slice(leaves, i + 2, F.size(leaves)), lambda d: d["field"] == c["field"]))
        named = F.transform(last, lambda c: F.concat(_quoted(c["field"]), F.lit(":"), said(c)))
        fields = F.transform(last, lambda c: _quoted(c["field"]))
        return F.concat(F.lit('{"properties":{'), F.array_join(named, ","), F.lit('},"required":['), F.array_join(fields, ","), F.lit("]}"))

    def one(c: Column) -> Column:
        name = _quoted(c["field"])
        return F.concat(F.lit('{"properties":{'), name, F.lit(":"), said(c), F.lit('},"required":['), name, F.lit("]}"))

    whole = lambda leaves: leaves.isNotNull() & (F.size(leaves) > 0) & F.forall(leaves, lambda c: c["field"].isNotNull() & said(c).isNotNull())
    either = lambda leaves: F.concat(F.lit('{"anyOf":['), F.array_join(F.transform(leaves, one), ","), F.lit("]}"))
    return (
        F.when(whole(t["all_of"]), together(t["all_of"]))
        .when(whole(t["any_of"]), either(t["any_of"]))
        .when(whole(t["none_of"]), F.concat(F.lit('{"not":'), either(t["none_of"]), F.lit("}")))
    )


def _quoted(text: Column) -> Column:
    """JSON text of a string."""
    listed = F.to_json(F.array(text))
    return listed.substr(F.lit(2), F.char_length(listed) - 2)


def export_json_schema(fields: DataFrame, titles: DataFrame | None = None) -> DataFrame:
    """One JSON-schema document per form: (form_id, schema).

    ``fields`` may have ``choice_group``, ``choice_value``, ``required_when`` and
    ``writable_when``; ``titles`` gives form_id and title.  A variable is a
    property of its type; choices are enumerations of their group's options, as
    arrays where several may be chosen; computed ones are read-only.  Data that
    nothing makes conditional is required; a requirement under a condition
    becomes if/then.  A form's properties are gathered into one document, so they
    are first cut to one row per variable.
    """
    for name in ("choice_group", "choice_value", "required_when", "writable_when"):
        if name not in fields.columns:
            fields = fields.withColumn(name, F.lit(None).cast("string"))
    option = F.coalesce("choice_value", "label")
    groups = fields.where("choice_group IS NOT NULL").groupBy("form_id", "choice_group").agg(
        F.transform(F.array_sort(F.collect_list(F.when(option.isNotNull(), F.struct("seq", "field_id", option.alias("o"))))), lambda x: _quoted(x["o"])).alias("options")
    )
    wanted = bound_fields(fields).where(~F.col("kind").isin("manual", "signature", "routing")).withColumn("name", F.coalesce("token", "field_id"))
    carried = ["label", "canonical_type", "kind", "choice_group", "required_when", "writable_when"]
    first = wanted.groupBy("form_id", "name").agg(F.min_by(F.struct(*carried), F.struct("seq", "field_id")).alias("v"))
    v = first.select("form_id", "name", "v.*").join(groups, ["form_id", "choice_group"], "left")

    base = F.lit('"type":"string"')
    for kind, text in JSON_TYPES.items():
        base = F.when(F.col("canonical_type") == kind, text[1:-1]).otherwise(base)
    listed = F.when(F.size("options") > 0, F.concat(F.lit(',"enum":['), F.array_join("options", ","), F.lit("]"))).otherwise("")
    chosen = F.concat(F.lit('"type":"string"'), listed)
    body = F.when(F.col("canonical_type") == "choice", chosen).when(F.col("canonical_type") == "choice_multi", F.concat(F.lit('"type":"array","items":{'), chosen, F.lit("}"))).otherwise(base)
    told = F.when(F.coalesce("label", F.lit("")) != "", F.concat(F.lit(',"description":'), _quoted(F.col("label")))).otherwise("")
    fixed = F.when(F.col("kind") == "computed", ',"readOnly":true').otherwise("")
    name = _quoted(F.col("name"))
    given = lambda c: present(F.coalesce(c, F.lit("")))
    free = (F.col("kind") == "data") & ~given("required_when") & ~given("writable_when")
    condition = condition_schema(F.col("required_when"))
    rule = F.concat(F.lit('{"if":'), condition, F.lit(',"then":{"required":['), name, F.lit("]}}"))
    parts = v.select(
        "form_id", F.struct("name", F.concat(name, F.lit(":{"), body, told, fixed, F.lit("}")).alias("text")).alias("p"),
        F.when(free, F.struct("name", name.alias("text"))).alias("r"), F.when(condition.isNotNull(), F.struct("name", rule.alias("text"))).alias("c"),
    )
    joined = lambda c: F.array_join(F.array_sort(F.collect_list(c))["text"], ",")
    docs = parts.groupBy("form_id").agg(joined("p").alias("p"), joined("r").alias("r"), joined("c").alias("c"))
    titled = docs.join(titles.select("form_id", "title"), "form_id", "left") if titles is not None else docs.withColumn("title", F.lit(None).cast("string"))
    section = lambda key, c: F.when(F.col(c) != "", F.concat(F.lit(f',"{key}":['), F.col(c), F.lit("]"))).otherwise("")
    return titled.select(
        "form_id",
        F.concat(
            F.lit('{"$schema":"https://json-schema.org/draft/2020-12/schema","title":'), _quoted(F.concat_ws(" \u2014 ", "form_id", "title")),
            F.lit(',"type":"object","properties":{'), "p", F.lit("}"), section("required", "r"), section("allOf", "c"), F.lit("}"),
        ).alias("schema"),
    )


def export_placements(widgets: DataFrame) -> DataFrame:
    """Whole-point boxes for e-sign tools, pages counted from 1."""
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    whole = lambda c: F.rint(c).cast("int")
    return widgets.select(
        "form_id", "rect_id", "field_id", (F.col("page") + 1).alias("page_no"),
        whole(x0).alias("x"), whole(y0).alias("y"), whole(x1 - x0).alias("w"), whole(F.abs(y1 - y0)).alias("h"),
    )


def export_contract(expected: DataFrame, exports: Mapping[str, DataFrame]) -> DataFrame:
    """Names of every export against the expected set: missing, unexpected,
    duplicate or null.  All tables carry form_id and name."""
    out: DataFrame | None = None
    for artefact, df in exports.items():
        named = df.where("name IS NOT NULL")
        have = named.groupBy("form_id", "name").agg(F.count("*").alias("n"))
        want = expected.select("form_id", "name").distinct().withColumn("_w", F.lit(True))
        j = have.join(want, ["form_id", "name"], "full")
        problem = F.when(F.col("n").isNull(), "missing").when(F.col("_w").isNull(), "unexpected").when(F.col("n") > 1, "duplicate")
        bad = j.select("form_id", "name", problem.alias("problem")).where("problem IS NOT NULL")
        nulls = df.where("name IS NULL").groupBy("form_id").agg(F.count("*").alias("n")).select("form_id", F.lit(None).cast("string").alias("name"), F.lit("null_name").alias("problem"))
        part = bad.unionByName(nulls).withColumn("artefact", F.lit(artefact))
        out = part if out is None else out.unionByName(part)
    return out
