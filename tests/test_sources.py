"""Reading and writing files."""

import json

from formloom.operators.reports import field_catalog
from formloom.sources import readers, writers


def test_layout_files(spark, tmp_path):
    box = {"x0": 1, "y0": 2, "x1": 3, "y1": 4}
    span = lambda s: {"text": s, "bbox": box, "font": "f", "size": 9}
    doc = {
        "form_id": "A-1", "category": "c",
        "pages": [{"page_number": 0, "width": 612, "height": 792, "rotation": 0,
                   "text_blocks": [{"lines": [{"bbox": box, "spans": [span("one"), span("two")]}]}, {"lines": []}],
                   "drawings": [{"kind": "line", "rect": box, "fill": [1, 1, 1]}]}],
    }
    (tmp_path / "a.json").write_text(json.dumps(doc, indent=1))
    layout = readers.read_layout(spark, str(tmp_path))
    assert [r.text for r in layout.lines.collect()] == ["one two"]
    assert [r.span_id for r in layout.spans.orderBy("span_id").collect()] == ["0-0-0", "0-0-1"]
    assert layout.drawings.collect()[0].fill == [1.0, 1.0, 1.0]
    assert layout.pages.collect()[0].width == 612


def test_form_packages(spark, tmp_path):
    form = tmp_path / "AA-1(I)"
    form.mkdir()
    (form / "metadata.json").write_text(json.dumps({"title": "T", "n_fields": 2}))
    (form / "fields.csv").write_text("field_id,label\nname,Name\ndate,Date\n")
    geo = {"fields": {"name": {"type": "text", "widgets": [{"page": 0, "rect": [1, 2, 3, 4]}]}, "pick": {"options": [{"page": 1, "rect": [5, 6, 7, 8], "value": "v"}]}}}
    (form / "fill_geometry.json").write_text(json.dumps(geo))
    p = readers.read_form_packages(spark, str(tmp_path))
    assert {r.form_id for r in p.metadata.collect()} == {"AA-1(I)"}
    assert sorted(r.field_id for r in p.fields.collect()) == ["date", "name"]
    got = sorted((r.field_id, r.kind, r.page, r.x0, r.option_value) for r in readers.explode_geometry(p.geometry).collect())
    assert got == [("name", "text", 0, 1.0, None), ("pick", "choice", 1, 5.0, "v")]


def test_jsonl_log_reports_bad_lines(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"key": "a", "n": 1}\n{"key": "b", "n"\n\n{"key": "c", "n": 3}\n')
    good, bad = readers.read_jsonl_log(spark, str(tmp_path), "key string, n int")
    assert sorted(r.key for r in good.collect()) == ["a", "c"]
    assert bad.count() == 1


def test_front_matter_files(spark, tmp_path):
    d = tmp_path / "F-1"
    d.mkdir()
    (d / "skill.md").write_text('---\ntitle: "A title"\nanchor:\n---\nbody\n')
    texts = readers.read_front_matter(spark, f"{tmp_path}/*/skill.md")
    over = spark.createDataFrame([("F-9", "x")], "form_id string, anchor string")
    row = readers.front_matter_index(texts, ["title", "anchor"], ["title", "anchor"], over).collect()[0]
    assert (row.form_id, row.title, row.anchor, row.missing) == ("F-1", "A title", None, "anchor")


def test_catalog_round_trip(spark, tables, tmp_path):
    path = str(tmp_path / "catalog")
    catalog = field_catalog(tables.rect)
    writers.write_catalog(catalog, path, sep="\t")
    assert spark.read.option("sep", "\t").csv(path, header=True).count() == catalog.count()


def test_json_schema_is_json(spark, tables):
    from formloom.plans.exports import _exportable

    for row in writers.export_json_schema(_exportable(tables)).collect():
        doc = json.loads(row.schema)
        assert doc["type"] == "object" and set(doc.get("required", [])) <= set(doc["properties"])
