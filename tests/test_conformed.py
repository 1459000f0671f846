import datetime as dt
import hashlib

from strata.operators import specs_from_rows
from strata.plans.conformed import conformed_batch

KEYS = ("columnname", "colseq", "delta", "sql", "hashkeycheck", "partitionkeycheck", "clusterindexcol")


def spec(day_is_key: bool):
    return specs_from_rows(
        "ds",
        [
            dict(zip(KEYS, ("Id", "1", "int", "int", "Y", "N", "N"))),
            dict(zip(KEYS, ("day", "2", "date", "date", "Y" if day_is_key else "N", "Y", "N"))),
        ],
    )


def test_same_day_written_two_ways(spark):
    raw = spark.createDataFrame(
        [("1", "1995-01-01", "a"), ("1", "1995-01-01 00:00:00", "a"), ("1", "1995-01-01", "a")],
        "ID string, `Day` string, `Note [x]` string",
    )
    ts = dt.datetime(2024, 2, 1)
    # Partition column not a key: the two spellings normalise to one row.
    out = conformed_batch(raw, spec(False), ts).collect()
    assert len(out) == 1
    assert out[0].day == "1995-01-01" and out[0].note_ == "a"
    assert out[0].calhashkey == hashlib.sha256(b"1").hexdigest().upper()
    # Partition column is a key: the hash sees the raw text, so both stay.
    out = conformed_batch(raw, spec(True), ts).collect()
    assert sorted(r.calhashkey for r in out) == sorted(
        hashlib.sha256(t).hexdigest().upper() for t in (b"1||1995-01-01", b"1||1995-01-01 00:00:00")
    )
    assert {r.day for r in out} == {"1995-01-01"}
    assert conformed_batch(raw, spec(True), ts).columns == [
        "id", "day", "note_", "calhashkey", "calinsertdate", "calupdatedate"
    ]
