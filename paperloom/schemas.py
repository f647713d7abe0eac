"""Explicit schemas of papers and their parts; nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import StructType, _parse_datatype_string

AFFILIATION = "struct<laboratory:string,institution:string,location:map<string,string>>"
AUTHOR = f"struct<first:string,middle:array<string>,last:string,suffix:string,affiliation:{AFFILIATION},email:string>"
SPAN = "struct<start:int,end:int,text:string,ref_id:string>"
EQ_SPAN = "struct<start:int,end:int,text:string,latex:string,mathml:string,ref_id:string>"
# Text of a paragraph is a string or a list, a title a string or an object, a
# table's content a string or a list: these are read as raw JSON.
PARAGRAPH = f"struct<text:string,cite_spans:array<{SPAN}>,ref_spans:array<{SPAN}>,eq_spans:array<{EQ_SPAN}>,section:string,sec_num:string>"
BIB_ENTRY = (
    f"struct<ref_id:string,title:string,authors:array<{AUTHOR}>,year:int,venue:string,volume:string,issue:string,issn:string,"
    "pages:string,other_ids:map<string,array<string>>,num:int,urls:array<string>,raw_text:string,links:array<string>,link:string>"
)
REF_ENTRY = (
    "struct<text:string,type:string,type_str:string,latex:string,mathml:string,content:string,html:string,"
    "uris:array<string>,num:string,parent:string,fig_num:string>"
)
METADATA = f"struct<title:string,authors:array<{AUTHOR}>,year:string,venue:string,identifiers:map<string,string>>"
PARSE = (
    f"struct<_pdf_hash:string,metadata:{METADATA},abstract:array<{PARAGRAPH}>,body_text:array<{PARAGRAPH}>,back_matter:array<{PARAGRAPH}>,"
    f"bib_entries:map<string,{BIB_ENTRY}>,ref_entries:map<string,{REF_ENTRY}>>"
)
# Field names of the release layouts.
PAPER_JSON_DDL = (
    f"paper_id string, _pdf_hash string, s2_pdf_hash string, metadata {METADATA}, grobid_parse {PARSE}, pdf_parse {PARSE}, "
    f"title string, authors array<{AUTHOR}>, year string, venue string, identifiers map<string,string>, "
    # A list of paragraphs, or one text in a release.
    f"abstract string, body_text array<{PARAGRAPH}>, back_matter array<{PARAGRAPH}>, "
    f"bib_entries map<string,{BIB_ENTRY}>, ref_entries map<string,{REF_ENTRY}>, _corrupt_record string"
)


def paper_json() -> StructType:
    """Schema that reads every layout."""
    return _parse_datatype_string(PAPER_JSON_DDL)
