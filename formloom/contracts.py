"""Schemas of the tables this library reads from files."""

from __future__ import annotations

RECT = "struct<x0:double,y0:double,x1:double,y1:double>"
SPAN = f"struct<text:string,bbox:{RECT},font:string,size:double,color:int,flags:int>"
LINE = f"struct<bbox:{RECT},spans:array<{SPAN}>>"
DRAWING = f"struct<kind:string,rect:{RECT},stroke:array<double>,fill:array<double>,line_width:double,points:array<array<double>>>"
PAGE = (
    f"struct<page_number:int,width:double,height:double,rotation:int,"
    f"text_blocks:array<struct<lines:array<{LINE}>>>,drawings:array<{DRAWING}>>"
)
LAYOUT = f"form_id string, filename string, category string, pages array<{PAGE}>"

WIDGET = "struct<page:int,rect:array<double>>"
OPTION = "struct<page:int,rect:array<double>,value:string>"
GEOMETRY = f"fields map<string,struct<type:string,widgets:array<{WIDGET}>,options:array<{OPTION}>>>, page_size array<double>, n_pages int"

SCHEMA_FIELD = (
    "field_id string, label string, type string, data_type string, category string, subcategory string, "
    "slot_group string, slot_index int, risk_score int, risk_tier string, fill_source string, `when` string, "
    "writable_when string, required_when string, formula string, validators string"
)
METADATA = "form_id string, title string, category string, source_url string, n_fields int"

RECORD_SHAPES = (
    "answers map<string,struct<value:string,confidence:double,reasoning:string>>, "
    "fields array<struct<field_id:string,value:string>>"
)
