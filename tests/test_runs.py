"""Run names against their pattern, and how often a listing is read."""

import re

import pytest
from pyspark.sql import functions as F

from ionweave.functions import names
from ionweave.sources import runs

GOOD = "20240101_JGI_PI_505162_Proj_final_IDX_HILICZ_USX1_POS_MS2_7_groupA_1_Rg_Run7.h5"


def test_fields_are_the_groups_of_the_pattern(spark):
    odd = [GOOD, GOOD.replace("_1_Rg_", "___"), GOOD.replace("Run7", "17"), GOOD.replace(".h5", ".mzML"), GOOD.replace(".h5", ".h5.h5"), GOOD + "x", "_" + GOOD, GOOD.replace("_PI_", "_P.I_"), GOOD.replace("_PI_", "_P\nI_"),
           GOOD.replace("POS", "pos"), GOOD.replace("_PI_", "__"), "a.h5", "", GOOD + "\n", GOOD.replace("C18", "") + ".raw", GOOD.replace("HILICZ", "C18-EP")]
    got = spark.createDataFrame([(n,) for n in odd], "n string").select("n", names.parse_run_filename(F.col("n")).alias("f")).collect()
    for r in got:
        m = re.match(names.RUN_PATTERN, r.n)
        want = m and list(m.groups())
        if want:
            want[7] = names.CHROMATOGRAPHY_ALIASES.get(want[7].lower(), want[7].lower())
        assert (r.f and list(r.f)) == want, r.n
    assert sum(r.f is not None for r in got) == 8


def test_a_listing_is_checked_in_one_pass(spark):
    read = spark.sparkContext.accumulator(0)
    n = 600

    def path(k):
        read.add(1)
        return (f"/d/{GOOD.replace('Run7', f'Run{k}')}",)

    paths = spark.createDataFrame(spark.sparkContext.parallelize(range(n), 3).map(path), "path string")
    found = runs.scan_runs(paths)
    assert read.value == n
    assert found.count() == n
    with pytest.raises(ValueError, match="failed conversions: .*x.failed"):
        runs.scan_runs(paths.union(spark.createDataFrame([("/d/x.failed",)], "path string")))


def test_filters_do_not_take_names_apart_again(spark):
    paths = spark.range(5).selectExpr(f"concat('/d/{GOOD[:-4]}', id, '.h5') as path")
    kept = runs.filter_runs(runs.parsed_runs(paths.withColumn("filename", F.substring_index("path", "/", -1))), include=["experimental"], exclude=["NEG"], chromatography="HILICZ", polarity="positive")
    assert kept.count() == 5
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 1
    none = runs.parsed_runs(spark.createDataFrame([("/d/a.h5", "a.h5")], "path string, filename string")).first()
    assert list(none) == ["/d/a.h5", "a.h5", None, None, None, None, None]
