"""Rejected records and nulled values, with totals that reconcile."""
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructField, StructType

from tallyspark.sources import quarantine as QU

SCHEMA = StructType([StructField("id", IntegerType()), StructField("name", StringType()), StructField("points", DoubleType()), StructField("day", DateType())])


def test_csv_loses_no_line(spark, tmp_path):
    (tmp_path / "t").mkdir()
    lines = ["id,name,points,day", "1,a,2.5,2001-01-02", "2,b,\\N,\\N", "x,c,1,2001-01-01", "\\N,d,1,2001-01-01", "3,e", "4,f,5,2001-01-01,more", "5, g ,n/a,someday", " 6 ,h,7,2001-02-30"]
    (tmp_path / "t" / "one.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "t" / "two.csv").write_text("id,name,points,day\n7,i,8,2001-03-01\n")
    judged = QU.judge(QU.read_text_table(spark, str(tmp_path / "t"), SCHEMA.names), SCHEMA, ["id"]).cache()
    got = {r.id: r for r in QU.kept(judged).collect()}
    assert sorted(got) == [1, 2, 5, 6, 7] and QU.kept(judged).schema == SCHEMA
    assert (got[1].points, str(got[1].day), got[2].points, got[5].name, got[5].points, got[5].day, got[6].day) == (2.5, "2001-01-02", None, " g ", None, None, None)
    out = QU.rejects(judged).collect()
    assert sorted((r.level, r.reason, r.column_name, r.text) for r in out if r.level == "value") == [
        ("value", "wrong type", "day", "2001-02-30"), ("value", "wrong type", "day", "someday"), ("value", "wrong type", "points", "n/a")]
    rows = [r for r in out if r.level == "row"]
    assert sorted(r.reason for r in rows) == ["key id is no int", "malformed record", "malformed record", "missing key id"]
    assert {r.record for r in rows if r.reason == "malformed record"} == {"3,e", "4,f,5,2001-01-01,more"}
    assert all(r.file.endswith("one.csv") for r in out)
    t = QU.totals(judged).first()
    assert (t.n_read, t.n_kept, t.n_rejected, t.n_nulled) == (9, 5, 4, 3) and t.n_read == t.n_kept + t.n_rejected


def test_json_lines_and_several_keys(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"id": "1", "name": "a", "points": "2"}\n{broken\n{"name": "b"}\n{"id": "9", "points": "z"}\n')
    judged = QU.judge(QU.read_text_table(spark, str(tmp_path / "t.json"), SCHEMA.names, fmt="json"), SCHEMA, ["id", "name"])
    assert [tuple(r) for r in QU.kept(judged).collect()] == [(1, "a", 2.0, None)]
    assert sorted(r.reason for r in QU.rejects(judged).collect()) == ["malformed record", "missing key id", "missing key name"]


def test_empty_tables_and_key_only_schemas(spark):
    text = spark.createDataFrame([], "id string")
    schema = StructType([StructField("id", IntegerType())])
    t = QU.totals(QU.judge(text, schema, ["id"])).first()
    assert (t.n_read, t.n_kept, t.n_rejected, t.n_nulled) == (0, 0, 0, 0)
    one = QU.judge(spark.createDataFrame([("4",), (None,)], "id string"), schema, ["id"])
    assert [r.id for r in QU.kept(one).collect()] == [4] and QU.rejects(one).select(F.col("reason")).first().reason == "missing key id"
