"""The six steps of a report."""

from __future__ import annotations

# Descriptions and expected results as reports print them.
DESCRIPTIONS = {
    1: "Ingestion: One time Data Extract and Load. Ingestion pipeline will connect with the provided Source and Target and execute.",
    2: "Schema Validation: Fetch the Source and Target schema and validate the Schema. Save the schema validation result.",
    3: "Data Validation: Fetch the data from Source and Destination/Target nodes and validate the data. Save the Data Validation result.",
    4: "Record Count Validation: Fetch the record count from Source and Destination/Target nodes and validate.",
    5: "Uniqueness Validation: Fetch the data from Target and check whether the mentioned column have unique values. Save the Uniqueness Validation result.",
    6: "Not Null value Validation: Fetch the data from Target and verify if any of the mentioned column have null values. Save the Not Null value Validation result.",
}
EXPECTED = {
    1: ["Pipeline should be created and executed.", "Last Run status should be displayed as 'Succeeded'."],
    2: [
        "Mandatory fields should be filled and Validation should be successfully completed.",
        "Source and Target Schema should be validated successfully.",
        "Source and Target Data Type(s) should be validated successfully.",
    ],
    3: [
        "Mandatory fields should be filled and Validation should be successfully completed.",
        "Source and Target Data should be validated successfully.",
    ],
    4: ["Mandatory fields should be filled and validation should be successfully completed."],
    5: [
        "Mandatory fields should be filled and Validation should be successfully completed.",
        "Validate that all specified Target columns contain unique values.",
    ],
    6: [
        "Mandatory fields should be filled and Validation should be successfully completed.",
        "Validate that all specified Target columns contain non-null values.",
    ],
}
# What the older rule sets print instead, by (rule set, step).
OLDER_DESCRIPTIONS = {
    ("r1", 4): "Record Count Validation: Fetch the record count from Source and Destination/Target and validate.",
}
OLDER_EXPECTED = {
    ("r1", 5): "Validate the Target unique column count",
    ("r2", 5): "Validate the Target unique column count",
    ("r1", 6): "Validate the Target Not Null column count",
    ("r2", 6): "Validate the Target Not Null column count",
}

# Validation type of each step, in report order.
STEP_TYPES = {1: "ingestion", 2: "schema", 3: "data", 4: "row_count", 5: "uniqueness", 6: "not_null"}


def description(step: int, rules: str) -> str:
    return OLDER_DESCRIPTIONS.get((rules, step), DESCRIPTIONS[step])


def expected(step: int, rules: str) -> list[str]:
    last = OLDER_EXPECTED.get((rules, step))
    return EXPECTED[step] if last is None else [*EXPECTED[step][:-1], last]
