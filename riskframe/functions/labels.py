"""Lookup tables that turn codes and technical names into readable text."""

from __future__ import annotations

from riskframe.functions.columns import literal, text

# The code labels shown to users.
GENDER_LABELS = {1: "Male", 2: "Female"}
EDUCATION_LABELS = {
    1: "Graduate School", 2: "University", 3: "High School", 4: "Others", 5: "Unknown", 6: "Unknown",
}
MARRIAGE_LABELS = {1: "Married", 2: "Single", 3: "Others"}
PAY_LABELS = {-2: "Paid in full", -1: "No consumption", **{n: f"Pay {n}" for n in range(9)}}
VERDICT_LABELS = {0: "No Default Risk", 1: "Default Risk"}

# Readable names of the account columns.
READABLE_NAMES = {
    "LIMIT_BAL": "Credit Limit",
    "SEX": "Gender",
    "EDUCATION": "Education Level",
    "MARRIAGE": "Marital Status",
    "AGE": "Age",
    "PAY_0": "Payment Status (Current)",
    **{f"PAY_{m}": f"Payment Status ({m} months ago)" for m in range(2, 7)},
    "BILL_AMT1": "Bill Amount (Current)",
    **{f"BILL_AMT{m}": f"Bill Amount ({m} months ago)" for m in range(2, 7)},
    "PAY_AMT1": "Payment Amount (Current)",
    **{f"PAY_AMT{m}": f"Payment Amount ({m} months ago)" for m in range(2, 7)},
}


def decode(expression: str, labels: dict) -> str:
    """Label of a code as SQL text; null when the code is unknown."""
    pairs = ", ".join(f"{literal(k)}, {text(v)}" for k, v in labels.items())
    return f"try_element_at(map({pairs}), {expression})"


def readable_name(expression: str) -> str:
    """Dictionary name, else underscores to spaces with every word capitalised.

    A letter that follows a digit also starts a word, as in ``PAY_2X -> Pay 2X``: initcap only
    starts words after blanks, so a marked blank is put there and taken out again.
    """
    spaced = f"lower(replace({expression}, '_', ' '))"
    marked = f"regexp_replace({spaced}, '([^a-z])([a-z])', '$1# $2')"
    return f"coalesce({decode(expression, READABLE_NAMES)}, replace(initcap({marked}), '# ', ''))"
