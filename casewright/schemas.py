"""Table layouts. Sheets hold text only; graph tables are typed."""

from __future__ import annotations

from pyspark.sql import types as T

SUSPECT_SHEET = (
    "case_id", "case_name", "suspect_id", "name", "phone", "address", "social_media_id",
    "narrative", "irf_case_notes", "victims_willing_to_testify", "case_status", "eminence",
    "strength_of_case", "solvability", "priority", "bio_and_location", "relationships",
    "date_relationships_updated", "date_closed",
)
POLICE_SHEET = (
    "case_id", "case_name", "suspect_id", "suspect_name", "phone", "address", "social_media_id",
    "narrative", "irf_case_notes", "victims_willing_to_testify", "case_status", "priority",
    "date_closed",
)
VICTIM_SHEET = (
    "case_id", "case_name", "victim_id", "name", "phone", "address", "social_media", "narrative",
    "irf_case_notes", "case_status", "suspects_identified_and_located", "priority", "date_closed",
)
CASE_SHEET = (
    "case_id", "case_name", "priority", "irf_case_notes", "narrative", "case_status",
    "next_action_priority",
)
# First-row cells that blank cells of a link sheet take.
LINK_HEAD = ("name", "case_id", "suspect_case_id")
LINK_SHEET = ("sheet_id", "row_no", "name", "relationship_type", "source", "target",
              "target_label", "case_id", "suspect_case_id")

# Headings a reader of the published tables sees.
DISPLAY_NAMES = {
    "case_id": "Case_ID", "case_name": "Case_Name", "suspect_id": "Suspect_ID",
    "victim_id": "Victim_ID", "name": "Name", "suspect_name": "Suspect_Name",
    "phone": "Phone Number(s)", "address": "Address", "social_media_id": "Social Media ID",
    "social_media": "Social Media", "narrative": "Narrative", "irf_case_notes": "IRF_Case_Notes",
    "victims_willing_to_testify": "Victims_Willing_to_Testify", "case_status": "Case_Status",
    "suspects_identified_and_located": "Suspects_Identified_and_Located",
    "eminence": "Eminence", "strength_of_case": "Strength_of_Case", "solvability": "Solvability",
    "priority": "Priority", "bio_and_location": "Bio_and_Location",
    "relationships": "Relationships", "date_relationships_updated": "Date_Relationships_Updated",
    "date_closed": "Date_Closed", "next_action_priority": "Next_Action_Priority",
}


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


_L, _S, _I = T.LongType(), T.StringType(), T.IntegerType()

GRAPH_TABLES = {
    "suspects": _struct(("id", _L), ("name", _S), ("first_degree_links", _L),
                        ("second_degree_links", _L), ("first_degree_case_links", _L),
                        ("second_degree_case_links", _L)),
    "accounts": _struct(("id", _L), ("account_name", _S), ("account_label", _S),
                        ("account_type_id", _I), ("suspect_id", _L)),
    "account_types": _struct(("id", _I), ("account_type", _S)),
    "edges": _struct(("id", _L), ("source_suspect_id", _L), ("source_account_id", _L),
                     ("target_account_id", _L), ("edge_type_id", _I), ("edge_direction", _I),
                     ("edge_combo_id", _S)),
    "edge_types": _struct(("id", _I), ("edge_type", _S), ("edge_type_weight", _I)),
    "cases": _struct(("id", _L), ("case_number", _S), ("case_date", T.DateType())),
    "case_suspects": _struct(("id", _L), ("case_id", _L), ("suspect_id", _L),
                             ("suspect_case_id", _S)),
}


# Intake of sheets that land in several files: first rows, and rows that wait for theirs.
INTAKE_TABLES = {
    "sheet_heads": _struct(("sheet_id", _L), *((c, _S) for c in LINK_HEAD)),
    "waiting_rows": _struct(*((c, _L if c in ("sheet_id", "row_no") else _S) for c in LINK_SHEET)),
}


def text_schema(columns) -> T.StructType:
    return _struct(*[(c, _S) for c in columns])
