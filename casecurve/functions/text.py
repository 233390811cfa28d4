"""Text column expressions: canonical forms, flags and messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Answers that count as "skin manifestation present".
SKIN_YES_WORDS = ["yes", "y", "true", "1", "rash"]
# The terminal form accepts the same list without "rash".
SKIN_YES_WORDS_TERMINAL = ["yes", "y", "true", "1"]
# Gender labels the classifier was trained on.
GENDERS = ["Male", "Female"]


def is_word(col: Column, word: str) -> Column:
    """Case-insensitive equality that still prunes parquet row groups.

    ``lower(col) = word`` cannot be pushed to the scan. Every casing of an ASCII word sorts between
    its upper- and lower-case spelling, so that range is added as a pushable condition.
    """
    lowered, raised = word.lower(), word.upper()
    same = F.lower(col) == lowered
    # The Kelvin sign lower-cases to "k" but sorts outside the range.
    if lowered.isascii() and "k" not in lowered:
        same = (col >= raised) & (col <= lowered) & same
    return same


def title_case(col: Column) -> Column:
    """Trimmed text with each word capitalised; null stays null."""
    return F.initcap(F.lower(F.trim(col.cast("string"))))


def yes_no_flag(col: Column) -> Column:
    """yes → 1, no → 0, anything else → null."""
    word = F.lower(F.trim(col.cast("string")))
    return F.when(word == "yes", 1).when(word == "no", 0)


def repaired_gender(col: Column, otherwise: str = "Female") -> Column:
    """Male/Female from free text: other text starting with m is Male, the rest ``otherwise``."""
    clean = title_case(col)
    return (
        F.when(clean.isin(GENDERS), clean)
        .when(F.lower(clean).startswith("m"), "Male")
        .otherwise(otherwise)
    )


def terminal_gender(col: Column) -> Column:
    """The terminal form's rule: anything but Male/Female is Male."""
    clean = title_case(col)
    return F.when(clean.isin(GENDERS), clean).otherwise("Male")


def skin_flag(col: Column, kind: str = "text", words: list[str] | None = None) -> Column:
    """1/0 truthiness of a skin answer held as ``text``, ``number`` or ``boolean``."""
    if kind == "boolean":
        present = col
    elif kind == "number":
        present = col > 0
    else:
        present = F.lower(F.trim(col.cast("string"))).isin(words or SKIN_YES_WORDS)
    return F.when(present, 1).otherwise(0)


def percent_text(share: Column, digits: int = 1) -> Column:
    """A share as percent text; ties round to even, which the formatter alone would not do."""
    return F.format_string(f"%.{digits}f%%", F.bround(share * 100.0, digits))


def alert_message(series: Column, ds: Column, cases: Column, z: Column, style: str = "summary") -> Column:
    """Human-readable alert line; ``style`` picks the wording of the three callers."""
    day = F.date_format(ds, "yyyy-MM-dd")
    # The message formats.
    formats = {
        "summary": "%s outbreak alert for %s: %d cases (Z=%.2f).",
        "forecast": "%s outbreak alert for %s: %d projected cases (Z=%.2f).",
        "terminal": "%s outbreak warning for %s: %d cases predicted (Z=%.2f).",
    }
    return F.format_string(formats[style], series, day, cases, F.bround(z, 2))


def screening_message(disease: Column, confidence: Column, risk: Column, z: Column) -> Column:
    """The sentence returned with a screened intake."""
    # Fixed value: the sentence.
    return F.format_string(
        "Diagnosed %s with %.1f%% confidence. "
        "Community %s surveillance status is currently '%s' (Z=%s).",
        disease, F.bround(confidence * 100.0, 1), disease, risk, z.cast("string"),
    )


def risk_label(col: Column) -> Column:
    """Any casing of critical/alert to itself in lower case, everything else to normal."""
    word = F.lower(F.coalesce(col, F.lit("")))
    return F.when(word.isin("critical", "alert"), word).otherwise("normal")
