"""Raw CSV readers, cleaners and sinks on generated files."""

import datetime as dt
import os

from phenolens.functions import parse_date, parse_iso_date, parse_number
from phenolens.sources import (
    infer_table_name,
    load_event_tables,
    read_allow_list,
    read_csv_table,
    read_event_tables,
    write_event_tables,
    write_feature_tuples,
    write_labels,
)
from pyspark.sql import functions as F


def write(path, text):
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_infer_table_name():
    assert infer_table_name("data\\encounter_INPUT.csv") == "encounter_INPUT"
    assert infer_table_name("/a/b/lab_results_INPUT.csv") == "lab_results_INPUT"
    assert infer_table_name("x.txt") == "txt"
    assert infer_table_name("???") == "???"


def test_malformed_lines_dropped_whatever_is_selected(spark, tmpdir_fresh):
    p = write(os.path.join(tmpdir_fresh, "t.csv"), "a,b,c\n1,2,3\n4,5\n6,7,8,9\n10,11,12\n")
    df = read_csv_table(spark, p)
    assert sorted(r.a for r in df.select("a").collect()) == ["1", "10"]
    assert df.count() == 2
    assert spark.table("t").count() == 2


def test_number_and_date_parsing(spark):
    df = spark.createDataFrame(
        [("1,234.5", "2010-01-05T00:00:00Z"), ("", "2010-01-05"), ("abc", "bad"), ("NaN", None)],
        "n string, t string")
    got = df.select(parse_number("n").alias("v"), parse_date("t").alias("d")).collect()
    assert got[0].v == 1234.5 and got[0].d == dt.date(2010, 1, 5)
    assert got[1].v is None and got[1].d == dt.date(2010, 1, 5)
    assert got[2].v is None and got[2].d is None
    assert got[3].v != got[3].v  # NaN


def test_parse_iso_date(spark):
    df = spark.createDataFrame([("2010-01-05T23:30:00Z",), ("2010-01-05T00:00:00+02:00",), ("x",)], "t string")
    got = [r.d for r in df.select(parse_iso_date("t").alias("d")).collect()]
    assert got == [dt.date(2010, 1, 5), dt.date(2010, 1, 4), None]


def _raw_folder(folder):
    write(os.path.join(folder, "encounter_INPUT.csv"),
          "Encounter_ID,Member_ID,Encounter_DateTime\n"
          "e1,p1,2010-01-05T00:00:00Z\ne2,p2,2010-02-01T00:00:00Z\ne3,,2010-02-02T00:00:00Z\n")
    write(os.path.join(folder, "encounter_dx_INPUT.csv"),
          "Encounter_ID,Code_ID\ne1,250.02\ne2,401.9\ne3,250.02\ne9,250.02\n")
    write(os.path.join(folder, "medication_orders_INPUT.csv"),
          "Encounter_ID,Order_Date,Drug_Name\ne1,2010-01-06T00:00:00Z,Lantus\ne2,2010-02-03,metformin\n"
          "e1,2010-01-07\n")
    write(os.path.join(folder, "lab_results_INPUT.csv"),
          'Member_ID,Date_Resulted,Result_Name,Numeric_Result\n'
          'p1,2010-01-05T00:00:00Z,Glucose,"1,234.5"\np2,2010-01-05,glucose,\np3,2010-01-05,glucose,abc\n'
          'p4,2010-01-05,glucose,NaN\np5,bad,glucose,90\np6,2010-01-06,hba1c,5.5\n')


def test_load_event_tables(spark, tmpdir_fresh):
    _raw_folder(tmpdir_fresh)
    t = load_event_tables(spark, tmpdir_fresh)
    assert sorted(tuple(r) for r in t.dx.collect()) == [
        ("p1", "250.02", dt.date(2010, 1, 5)), ("p2", "401.9", dt.date(2010, 2, 1))]
    assert sorted(tuple(r) for r in t.med.collect()) == [
        ("p1", dt.date(2010, 1, 6), "Lantus"), ("p2", dt.date(2010, 2, 3), "metformin")]
    assert sorted(tuple(r) for r in t.lab.collect()) == [
        ("p1", dt.date(2010, 1, 5), "Glucose", 1234.5), ("p6", dt.date(2010, 1, 6), "hba1c", 5.5)]
    out = os.path.join(tmpdir_fresh, "clean")
    write_event_tables(t, out)
    back = read_event_tables(spark, out)
    assert back.lab.count() == 2 and back.dx.count() == 2


def test_allow_list(spark, tmpdir_fresh):
    p = write(os.path.join(tmpdir_fresh, "med_filter.txt"), "Lantus\nlantus\nMetformin\n")
    assert sorted(r.term for r in read_allow_list(spark, p).collect()) == ["lantus", "metformin"]


def test_sinks(spark, tmpdir_fresh):
    labels = spark.createDataFrame([("p1", 1), ("p2", 3)], "patient_id string, label int")
    out = os.path.join(tmpdir_fresh, "labels")
    write_labels(labels, out)
    back = spark.read.option("sep", "\t").csv(out).collect()
    assert sorted(tuple(r) for r in back) == [("p1", "1"), ("p2", "3")]
    tuples = spark.createDataFrame([("p1", "x", 2.0)], "patient_id string, feature string, value double")
    out2 = os.path.join(tmpdir_fresh, "tuples")
    write_feature_tuples(tuples, out2, fmt="tsv")
    assert spark.read.option("sep", "\t").csv(out2).first()[2] == "2.0"
    write_feature_tuples(tuples, os.path.join(tmpdir_fresh, "tp"))
    assert spark.read.parquet(os.path.join(tmpdir_fresh, "tp")).where(F.col("value") == 2.0).count() == 1
