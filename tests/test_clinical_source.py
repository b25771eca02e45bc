"""Concepts run unchanged on stored clinical tables (the real-deployment source)."""

import tempfile

from stayframe.plans import registry  # noqa: F401  (registers concepts)
from stayframe.plans.base import Concepts
from stayframe.sources.clinical import CLINICAL_TABLES, ClinicalTables
from stayframe.sources.fixture import Tables

SF = "/root/testdata/sf0.001"


def test_concepts_on_stored_tables(spark):
    derived = Tables(spark, SF)
    root = tempfile.mkdtemp(prefix="stayframe-clinical-")
    for name in CLINICAL_TABLES:
        getattr(derived, name).write.parquet(f"{root}/{name}")
    stored = ClinicalTables(spark, root=root)
    for key in ("cohort", "kdigo_daily", "sofa"):
        a = sorted(Concepts(derived).output(key).collect())
        b = sorted(Concepts(stored).output(key).collect())
        assert a == b and len(a) > 0
