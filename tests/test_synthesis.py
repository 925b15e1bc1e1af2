from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from mirrorset.catalog.measures import domain_tables
from mirrorset.config import Limits
from mirrorset.operators import model
from mirrorset.plans import Settings, synthesize
from mirrorset.plans.synthesis import make_animals, make_farms, make_lactations, make_visits, _clean_source
from mirrorset.schema import FOREIGN_KEYS, PRIMARY_KEYS, SCHEMAS, check_refs, check_unique
from mirrorset.sources import stage

AS_OF = date(2001, 8, 2)
SETTINGS = Settings(as_of=AS_OF, n_farms=40, seed=3, no_self_dam=True, boosting=model.Boosting(trees=2))


@pytest.fixture(scope="module")
def source(spark, sf):
    return {name: stage(df) for name, df in domain_tables(spark, sf).items()}


@pytest.fixture(scope="module")
def result(spark, source):
    return {name: stage(df) if df.columns else df for name, df in synthesize(spark, source, SETTINGS).items()}


def test_schemas_keys_and_references(result):
    for name, schema in SCHEMAS.items():
        if name not in ("CL_AIDE_ETAPE_CTRL", "CL_AIDE_TYPE_CTRL"):
            assert [(f.name, f.dataType) for f in result[name].schema] == [(f.name, f.dataType) for f in schema]
    for name, keys in PRIMARY_KEYS.items():
        assert check_unique(result[name], keys).count() == 0
    for child, key, parent, parent_key in FOREIGN_KEYS:
        assert check_refs(result[child], result[parent], key, parent_key).count() == 0
    assert check_refs(result["IDENTANV"], result["IDENTANV"], "NOANMERE", "NOAN").count() == 0


def test_sizes_and_ranges(result):
    assert result["EXPLOITATION"].count() == 40
    assert result["IDENTANV"].where("SEXEAN <> 'F' OR NOANMERE = NOAN").count() == 0
    assert result["CL_LAITCTRL"].count() == 0
    assert result["CL_LAITEXPL"].where((F.col("DATE_CTRL") > F.lit(AS_OF)) | F.col("TRAIT1").isNull()).count() == 0
    types = {r[0] for r in result["CL_LAITEXPL"].select("CD_TYPE_CTRL").distinct().collect()}
    assert types <= {1, 2, 9, 10}
    assert {r.target for r in result["metrics"].collect()} == {"lait", "mg", "prot", "pic", "persistance"}


def test_lactations_are_in_order(result):
    rows = result["CL_LAITLACT"].select("NOAN", "NOLACT", "DATE_VEL", "DATE_TAR", "LAIT", "PERSISTANCE").collect()
    assert rows
    by_animal = {}
    for r in rows:
        assert r.DATE_VEL < AS_OF and (r.DATE_TAR is None or r.DATE_TAR <= AS_OF)
        assert r.LAIT is not None and r.PERSISTANCE is not None
        by_animal.setdefault(r.NOAN, {})[r.NOLACT] = r
    for sequence in by_animal.values():
        assert sorted(sequence) == list(range(1, len(sequence) + 1))
        for n, r in sequence.items():
            after = sequence.get(n + 1)
            assert after is None or (r.DATE_TAR is None or r.DATE_TAR < after.DATE_VEL) and r.DATE_VEL <= after.DATE_VEL


def test_no_real_key_survives(source, result):
    real = source["IDENTANV"].select("NOAN")
    assert result["IDENTANV"].join(real, "NOAN", "left_semi").count() == 0


def test_small_and_large_plans_give_the_same_tables(spark, source):
    def tables(settings):
        src = _clean_source(source)
        farms = stage(make_farms(spark, src, settings))
        animals = stage(make_animals(src, farms, settings))
        return [farms, animals, make_visits(src, farms, settings), make_lactations(src, farms, animals, settings)]

    small = tables(SETTINGS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    large = tables(replace(SETTINGS, limits=Limits(small_rows=0, group_rows=0, salts=20)))
    for a, b in zip(small, large):
        assert a.dtypes == b.dtypes
        mine, theirs = (sorted(map(repr, df.collect())) for df in (a, b))
        assert mine == theirs and mine
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_jitter_moves_birth_dates(spark, source):
    src = _clean_source(source)
    farms = stage(make_farms(spark, src, SETTINGS))
    plain = make_animals(src, farms, SETTINGS).select("NOAN", F.col("DTNAISANINV").alias("old"))
    moved = make_animals(src, farms, replace(SETTINGS, jitter_days=30)).select("NOAN", "DTNAISANINV")
    both = plain.join(moved, "NOAN")
    assert both.count() == plain.count() and both.where("old <> DTNAISANINV").count() > plain.count() * 0.9
