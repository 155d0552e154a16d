"""Declared schemas of every table the engine reads or writes; empty inputs give empty tables of these."""

from __future__ import annotations





#: columns of the manifests, by corpus kind; all are read as strings
MANIFESTS = {
    "cfr": "relative_path citation section subject part part_name issue_date source_url publisher bytes sha256",
    "interpretations": "relative_path title date standards_cited identifier source_url publisher bytes sha256",
    "directives": "relative_path format title date directive_number identifier source_url publisher bytes sha256",
    "publications": "relative_path language format title publication_id source_url bytes sha256",
    "epa": "relative_path section format title source_url source_page publisher bytes sha256",
    "nfpa_public": "relative_path collection category language format title source_url source_page publisher bytes sha256",
    "nfpa_ibr": "relative_path kind title standard edition_year source_url source_details_page publisher bytes sha256",
}
AUDIT = "corpus string, relative_path string, status string, chars long, source_kb long, chars_per_kb double, note string"
OCR_RESULTS = "relative_path string, status string, chars long, note string"
EMBED_INDEX = "text_path string, corpus string, source_format string, chars long, content_sha256 string, embed string, exclude_reason string, duplicate_of string, dup_group_size long"
MASTER_INDEX = "corpus string, relative_path string, language string, format string, title string, identifier string, source_url string, source_page string, publisher string, rights string, bytes long, sha256 string"
PACK_FILE = "path string, source_path string, source_url string, source_sha256 string, title string, identifier string, language string, chars long"
PACK_SPEC = (
    "pack_id string, kind string, title string, short_title string, corpus string, publisher string, rights_tier string, rights_note string, description string, "
    "members array<string>, required_members array<string>, recommends array<string>, "
    "members_from struct<corpus: string, split_by: string, member_id: string, exclude_sections: array<string>>, "
    "refresh struct<method: string, cadence_days: int, endpoint: string, title: int, field: string, extra_check_month: int, note: string>, "
    "query_expansion map<string, array<string>>"
)
SMOKE_CASE = "id string, category string, issue string, question string, expect struct<answered: boolean, gated: boolean, no_blanket_absence: boolean, contains: array<string>, not_contains: array<string>>, rubric string, tags array<string>"


def manifest(kind: str) -> str:
    """DDL of a manifest; every column is a string, as in its file."""
    return ", ".join(f"{c} string" for c in MANIFESTS[kind].split())
