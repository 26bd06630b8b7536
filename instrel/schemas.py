"""Table schemas, as Spark DDL."""

RESPONSE = (
    "struct<id: int, label: string, neg_type: string, title: string, passage: string, "
    "explanation: string, why_relevant: string, confidence: double, evidence: array<string>>"
)

_PACKAGE_FIELDS = (
    "choice_index int, query string, og_positive string, instruction string, "
    f"style string, length string, responses array<{RESPONSE}>"
)


def packages(id_type: str = "bigint") -> str:
    """Schema of the nested package table with ids of this type."""
    return f"id {id_type}, {_PACKAGE_FIELDS}"


PACKAGES = packages()

# One parsed passage before its fields are typed: key -> JSON text of the value.
RAW_ITEMS = "array<map<string,string>>"
