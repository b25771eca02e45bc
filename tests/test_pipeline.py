"""Build, store and drop concepts (K1, K4)."""

import tempfile

from stayframe.plans import pipeline

SF = "/root/testdata/sf0.001"


def test_build_save_drop(spark):
    res = pipeline.build(spark, SF, ["kdigo_daily", "sofa"])
    root = tempfile.mkdtemp(prefix="stayframe-save-")
    pipeline.save(res, path=root)
    assert spark.read.parquet(f"{root}/sofa").count() == res["sofa"].count() > 0
    pipeline.save({"sofa_t": res["sofa"]})
    assert spark.table("sofa_t").count() == res["sofa"].count()
    pipeline.drop(spark, ["sofa_t"])
    assert not spark.catalog.tableExists("sofa_t")
