"""Patterns of lines and records, written so that Java, Python's regex module and RE2 read them alike.

Fixed values: all patterns and word lists of this module.
"""

#: White space as Python's ``\s`` has it, as the inside of a class; and the same without the line feed.
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"
SPACE_IN_LINE = r"\t\x0b-\r\x1c-\x20\x85\p{Z}"
D = r"\p{Nd}"
DASH = "[-‑–—]"
ROMAN = "[IVXLCDM]+"
S = f"[{SPACE}]"
NUM = f"(?:{ROMAN}{DASH})?{D}+"

BODY_PARAGRAPH = rf"^((?:{D}+\.{D}+|{D}{{3}}(?:\.{D}+)?))\.{S}*(.*)"
APPENDIX_PARAGRAPH = rf"^(A\.{D}+)\.{S}*(.*)"
ANNEX_PARAGRAPH = rf"^({ROMAN}{DASH}{D}+)\.{S}*(.*)"
FIGURE = rf"^(?:FIG\.|Fig\.){S}+({NUM})\.{S}*(.*)"
TABLE = rf"^TABLE{S}+({NUM})\.{S}*(.*)"
REFERENCE = rf"^\[({D}+)\]{S}*(.*)"
FOOTNOTE = rf"^({D}{{1,2}}){S}+([A-Z][^\n]{{8,}}|[A-Za-z].{{8,}})"
REQUIREMENT = rf"(?i)^Requirement{S}+({D}+[A-Z]?):{S}*(.*)"
PAGE_NUMBER = rf"^{D}{{1,4}}$"
MAJOR_HEADING = rf"^({D}+)\.{S}+([A-Z].*)"
ANNEX_HEADING = rf"(?i)^Annex(?:{S}+({ROMAN}))?{S}*$"
APPENDIX_HEADING = rf"(?i)^Appendix(?:{S}+({ROMAN}))?{S}*$"
REFERENCES_HEADING = rf"^REFERENCES{S}*$"
GLOSSARY_HEADING = rf"^GLOSSARY{S}*$"
RELATED_HEADING = rf"^RELATED PUBLICATIONS{S}*$"
CONTENTS_HEADING = rf"^CONTENTS{S}*$"
BACK_MATTER_HEADING = rf"(?i)^(?:CONTRIBUTORS TO DRAFTING AND REVIEW|BODIES FOR THE ENDORSEMENT.*|ORDERING LOCALLY){S}*$"
SECTION_NAME = rf"(?i)^(?:Appendix|Annex){S}+{ROMAN}$|^REFERENCES$"
NUMBER_AND_NAME = rf"(?i)^{D}{{1,3}}{S}+(?:Appendix{S}+{ROMAN}|Annex{S}+{ROMAN}|REFERENCES)$"
SERIES_NUMBER = rf"(?i)^No\.{S}+{D}+$"
OUTLINE = rf"^{D}+(?:\.{D}+){{1,8}}\.{S}*(?:\S.*)?$"
OUTLINE_ENTRY = rf"(?i)^{D}+\.{S}+\S|^{D}+\.$|^CHAPTER{S}+{D}+[:.]{S}+\S"
TABLE_HEAD = rf"(?i)^APPENDIX{S}+{ROMAN}$|^TABLE{S}+{D}+:{S}*$"
MODAL = r"(?i)\b(?:shall|should|must|is|are|was|were|has|have|may)\b"
REQUIREMENT_INSIDE = rf"(?i)\bRequirement{S}+({D}+[A-Z]?):{S}*"
JOINERS = ("and", "or", "of", "the", "in", "to", "for", "with")
CONTENTS_ENTRY = r"\. \. \.|\.{3,}"
CONTINUED = r"(?i)\(cont\.\)"

KNOWN_HEADINGS = (
    "DRAFTING AND REVIEW", "COPYRIGHT NOTICE", "FOREWORD", "EDITORAL NOTE", "EDITORIAL NOTE", "CONTENTS", "RELATED PUBLICATIONS",
    "ORDERING LOCALLY", "CONTRIBUTORS TO DRAFTING AND REVIEW",
)
CONTINUATION_WORDS = ("OF", "THE", "AND", "FOR", "IN", "TO", "WITH", "ON", "FROM", "BY")
ELEMENT_TYPES = ("paragraph", "requirement", "figure", "table", "footnote", "heading", "text_block", "reference")
STATUSES = ("Normative", "Informative", "Informational")
REGIONS = ("FrontMatter", "Body", "Appendix", "Annex", "References", "Glossary", "BackMatter")
SUBSTANTIVE_TYPES = ("paragraph", "requirement", "figure", "table", "text_block")
APPARATUS_REGIONS = ("FrontMatter", "References", "Glossary", "BackMatter")

# quality checks of records
REQUIREMENT_MARKER = rf"(?i)\brequirement{S}+{D}+[A-Z]?:"
FOOTNOTE_BODY = rf"\b{D}{{1,2}}{S}+(?:The|In|For|See|This|Where|If|According)\b"
PAGE_FURNITURE = rf"(?i)\b{D}{{1,3}}{S}+(?:appendix{S}+[IVXLC]+|annex{S}+[IVXLC]+|references)\b"
DOT_LEADER = rf"(?:\.{S}*){{3,}}"
CONTENTS_PATH = rf"\({D}+(?:[–-]{D}+)?\){S}*{D}+$"
CONTROL = r"[\x00-\x08\x0b-\x1f\x7f]"
DAMAGE = r"[\x{fffd}\x{e000}-\x{f8ff}]"
HYPHEN_LEFT = rf"[A-Za-z]-{S}+[a-z]"
PAGE_ID_JOIN = rf"\b{D}{{3}}A\.{D}+"

# audit of exported records
WIDE_CONTROL = r"[\x00-\x08\x0b-\x1f\x7f-\x{9f}]"
PRIVATE_USE = r"[\x{e000}-\x{f8ff}]"
POUND_NUMBER = rf"£{S}*{D}"
TABLE_CONTAMINATION = rf"(?s)..*?\b(?:MARKINGS|REFERENCES|GLOSSARY|APPENDIX|ANNEX|FIG\.{S}+{D}+|{D}{{1,2}}\.{D}{{1,2}}\.{S}+[A-Z][A-Z\t-\r ]{{8,}})\b"
NEXT_SECTION = rf"\b{D}{{1,2}}\.{D}{{1,2}}\.{S}+[A-Z][A-Z\t-\r ]{{8,}}"
NOTE_THEN_PROSE = rf"(?is)\bnote:{S}+.*(?:--|—)for each package|\bnote:{S}+.*each package"
FIGURE_LABELS = ("ACTIVITY", "CONTENTS", "INDEX", "MINIMUM DIMENSION", "RADIOACTIVE")
FIGURE_LABEL = rf"^(?:{D}{{1,2}}|(?i:{D}+(?:\.{D}+)?{S}*(?:mm|cm|m)))$"
STANDALONE_HEADINGS = ("CONTENTS", "FOREWORD", "REFERENCES", "GLOSSARY", "ABBREVIATIONS", "DEFINITIONS")
ERROR_LABELS = (
    "metadata_title_mismatch", "control_or_garbage_chars", "likely_ocr_symbol_error", "table_flattened_or_contaminated",
    "figure_or_diagram_text_leakage", "heading_fragmentation", "section_status_mismatch", "record_id_collision_or_ambiguity",
)
SEVERITIES = ("critical", "high", "medium", "low")
