"""Regex field extraction from free-text notes.

``regexp_extract`` returns '' when a pattern does not match; the SQL
``substring(text, pattern)`` it replaces returns NULL.  ``regex_or_null``
restores that: NULL without a match, the (possibly empty) capture otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Echo report patterns (field, pattern, kind).  kind "num" fields
# become NULL when the capture carries the de-identification mark '*'.
ECHO_TIME = r"Date/Time: [\[\]0-9*-]+ at ([0-9:]+)"
ECHO_FIELDS = (
    ("indication", r"Indication: (.*?)\n", "text"),
    ("height", r"Height: \(in\) (.*?)\n", "num"),
    ("weight", r"Weight \(lb\): (.*?)\n", "num"),
    ("bsa", r"BSA \(m2\): (.*?) m2\n", "num"),
    ("bp", r"BP \(mm Hg\): (.*?)\n", "text"),
    ("bpsys", r"BP \(mm Hg\): ([0-9]+)/[0-9]+?\n", "num"),
    ("bpdias", r"BP \(mm Hg\): [0-9]+/([0-9]+?)\n", "num"),
    ("hr", r"HR \(bpm\): ([0-9]+?)\n", "num"),
    ("status", r"Status: (.*?)\n", "text"),
    ("test", r"Test: (.*?)\n", "text"),
    ("doppler", r"Doppler: (.*?)\n", "text"),
    ("contrast", r"Contrast: (.*?)\n", "text"),
    ("technicalquality", r"Technical Quality: (.*?)\n", "text"),
)

# Every pattern begins with a label that ends so.
LABEL_END = ": "


def label_lines(text: Column, mark: str = LABEL_END) -> Column:
    """The lines of a text that hold ``mark``, in their order and with their ends.

    A pattern that begins with a label, and matches within a line and its end, has the
    same first match there as in the whole text, wherever the label stands in the line.
    """
    lines = F.split(text, "\n", -1)
    # all lines but the last of the text end in a line feed
    end = F.when(F.element_at(lines, -1).contains(mark), "").otherwise("\n")
    return F.concat(F.array_join(F.filter(lines, lambda line: line.contains(mark)), "\n"), end)


def regex_or_null(text: Column, pattern: str, group: int = 1) -> Column:
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def numeric_field(text: Column, pattern: str) -> Column:
    """Capture cast to a number; NULL when it holds '*' or is not numeric."""
    raw = regex_or_null(text, pattern)
    return F.when(raw.contains("*"), F.lit(None)).otherwise(raw.try_cast("double"))


def extract_fields(notes: DataFrame, fields=ECHO_FIELDS) -> DataFrame:
    """The fields of every note, looked up in its lines that hold a label; the chart time is
    rebuilt from date + 'at HH:MM'."""
    notes = notes.withColumn("_labelled", label_lines(F.col("text")))
    t = F.col("_labelled")
    clock = regex_or_null(t, ECHO_TIME)
    stamp = F.concat(F.date_format(F.col("chartdate"), "dd-MM-yyyy"), clock)
    charttime = F.try_to_timestamp(stamp, F.lit("dd-MM-yyyyHH:mm")).cast("timestamp_ntz")
    cols = [F.col("row_id"), F.col("subject_id"), F.col("hadm_id"), F.col("chartdate"),
            charttime.alias("charttime")]
    for name, pattern, kind in fields:
        expr = numeric_field(t, pattern) if kind == "num" else regex_or_null(t, pattern)
        cols.append(expr.alias(name))
    return notes.select(*cols)
