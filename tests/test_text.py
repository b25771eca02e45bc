"""Echo-report field extraction (X14, N16, T3) on hand-made notes."""

import datetime as dt

from pyspark.sql import functions as F

from stayframe.functions.text import extract_fields

NOTES = [
    (1, "PATIENT/TEST INFORMATION:\nIndication: Chest pain\nHeight: (in) 70\n"
        "Weight (lb): 180\nBSA (m2): 1.99 m2\nBP (mm Hg): 120/80\nHR (bpm): 75\n"
        "Status: Inpatient\nDate/Time: [**2101-1-1**] at 14:30\nTest: TTE\n"
        "Doppler: Full\nContrast: None\nTechnical Quality: Adequate\n"),
    (2, "Indication: \nHeight: (in) [**Numeric Identifier 1**]\nWeight (lb): 150\n"),
    (3, "no structured fields at all"),
]


def test_extract_fields(spark):
    df = spark.createDataFrame(
        [(i, 10 + i, None, dt.date(2024, 1, 5), "Echo", txt) for i, txt in NOTES],
        "row_id long, subject_id long, hadm_id long, chartdate date, category string, "
        "text string")
    got = {r.row_id: r for r in extract_fields(df).collect()}
    a = got[1]
    assert a.indication == "Chest pain"
    assert (a.height, a.weight, a.bsa) == (70.0, 180.0, 1.99)
    assert (a.bp, a.bpsys, a.bpdias, a.hr) == ("120/80", 120.0, 80.0, 75.0)
    assert (a.status, a.test, a.doppler, a.contrast, a.technicalquality) == \
        ("Inpatient", "TTE", "Full", "None", "Adequate")
    assert a.charttime == dt.datetime(2024, 1, 5, 14, 30)
    b = got[2]
    assert b.indication == ""          # empty capture stays '' (not NULL)
    assert b.height is None            # de-identified number -> NULL
    assert b.weight == 150.0
    assert b.charttime is None         # no time in the text
    c = got[3]
    assert c.indication is None and c.weight is None   # no match -> NULL


def test_fields_from_label_lines_equal_whole_texts(spark):
    """Labels in mid-line, twice, cut by line ends of other kinds, at the end of the text."""
    import random

    from stayframe.functions.text import ECHO_FIELDS, ECHO_TIME, label_lines, regex_or_null
    rng = random.Random(3)
    labels = ["Date/Time: ", "Indication: ", "Height: (in) ", "Weight (lb): ", "BSA (m2): ", "BP (mm Hg): ",
              "HR (bpm): ", "Status: ", "Test: ", "Doppler: ", "Contrast: ", "Technical Quality: "]
    pieces = [*labels, *(p.rstrip() for p in labels), "\n", "\n", "\r", "\r\n", " ", "120/80", "70", "m2",
              " m2\n", "[**2101-1-1**] at 10:30", " at ", "word", " ", "*", "", ": ", "12", "\n\n"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(60))) for _ in range(3000)] + ["", "\n", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("kept", label_lines(F.col("text")))
    patterns = [ECHO_TIME, *(p for _, p, _ in ECHO_FIELDS)]
    found = [regex_or_null(F.col(c), p).alias(f"{c}{i}") for i, p in enumerate(patterns) for c in ("text", "kept")]
    rows = df.select(*found).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert [r[f"text{i}"] for i in range(len(patterns))] == [r[f"kept{i}"] for i in range(len(patterns))]
    assert all(any(r[f"text{i}"] for r in rows) for i in range(len(patterns)))
