import pytest
from pyspark.sql import functions as F

from mirrorset import schema, sources


def test_enforce_schema_fills_casts_and_orders(spark):
    df = spark.createDataFrame([("7", 8.6, "x")], "noan string, LAIT double, extra string")
    out = schema.enforce_schema(df, schema.SCHEMAS["CL_LAITLACT"])
    assert out.schema == schema.SCHEMAS["CL_LAITLACT"]
    row = out.first()
    assert row.NOAN == 7 and row.LAIT == 9 and row.LAIT305 is None and row.DATE_VEL is None


def test_every_key_column_is_declared():
    for name, keys in schema.PRIMARY_KEYS.items():
        assert set(keys) <= set(schema.SCHEMAS[name].names)
    for child, key, parent, parent_key in schema.FOREIGN_KEYS:
        assert key in schema.SCHEMAS[child].names and parent_key in schema.SCHEMAS[parent].names


def test_check_unique_and_refs(spark, hot):
    assert {r.g: r.n for r in schema.check_unique(hot, ["g"]).collect()}["hot"] == 667
    assert schema.check_unique(hot, ["id"]).count() == 0
    parents = spark.createDataFrame([("g1",), ("g2",)], "k string")
    orphans = {r.g: r.n for r in schema.check_refs(hot, parents, "g", "k").collect()}
    assert orphans["hot"] == 667 and not {"g1", "g2", None} & set(orphans)


def test_write_refuses_to_overwrite_and_appends(spark, tmp_path):
    df = spark.range(3)
    path = str(tmp_path / "t")
    assert sources.write_table(df, path).count() == 3
    with pytest.raises(Exception, match="(?i)exist"):
        sources.write_table(df, path)
    copied = sources.copy_tables({"t": df, "u": df}, ["t"], str(tmp_path))
    assert copied["t"].count() == 6


def test_load_dictionary_and_empty(spark, sf):
    tables = sources.load_tables(spark, sf, ["nation", "region"])
    sources.register_tables(tables)
    assert spark.sql("SELECT count(*) FROM nation JOIN region ON n_regionkey = r_regionkey").first()[0] == 25
    assert sources.dictionary_values(tables["nation"], "n_regionkey").count() == 5
    empty = sources.empty_like(tables["nation"])
    assert empty.count() == 0 and empty.columns == tables["nation"].columns


def test_stage_is_a_written_table(spark, hot):
    staged = sources.stage(hot.where(F.col("g") == "hot"))
    assert staged.dtypes == hot.dtypes and staged.count() == 667
    assert staged.inputFiles()[0].split("://")[-1].replace("file:", "").startswith(sources.staging_root(spark))


def test_staged_tables_are_released(spark, hot):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(sources.staging_root(spark))
    listed = lambda: {str(x.getPath()) for x in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)}
    kept = sources.stage(hot, "kept")
    before = listed()
    with sources.staging(spark):
        assert sources.stage(hot, "passing").count() == 2000 and len(listed()) == len(before) + 1
    assert listed() == before and kept.count() == 2000
