import datetime as dt

from phenolens.sources.clinical import EventTables

DX_SCHEMA = "patient_id string, code string, date date"
MED_SCHEMA = "patient_id string, date date, medicine string"
LAB_SCHEMA = "patient_id string, date date, test_name string, value double"


def d(s):
    return dt.date.fromisoformat(s) if s else None


def tables(spark, dx=(), med=(), lab=()):
    return EventTables(
        dx=spark.createDataFrame([(p, c, d(t)) for p, c, t in dx], DX_SCHEMA),
        med=spark.createDataFrame([(p, d(t), m) for p, t, m in med], MED_SCHEMA),
        lab=spark.createDataFrame([(p, d(t), n, v) for p, t, n, v in lab], LAB_SCHEMA),
    )


def as_dict(df, key="patient_id", value="label"):
    return {r[key]: r[value] for r in df.collect()}
