"""Tolerant delimited scan: good rows, short rows, quarantine (SRC-1…5)."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

from pyspark.sql import types as T

from strata.sources import delimited

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                       T.StructField("amount", T.DecimalType(18, 2)), T.StructField("day", T.DateType())])


def _write(text: str, name: str = "Feed_File.CSV") -> str:
    folder = tempfile.mkdtemp(prefix="strata-feed-")
    with open(os.path.join(folder, name), "w", newline="") as fh:
        fh.write(text)
    return folder


def test_quarantine_split(spark):
    text = ("id,name,amount,day\r\n"
            "1,alpha,1.50,2024-01-02\r\n"          # good, CRLF
            "2,\"b, quoted\",2.00,2024-01-03\n"     # quoted comma
            "3,short\n"                              # short: trailing NULLs, still good
            "4,long,1.00,2024-01-01,extra\n"         # too many fields
            "x5,badnum,1.00,2024-01-01\n"            # bad number
            "6,baddate,1.00,2024-13-45\n"            # bad date
            "7, padded ,,\n")                        # empty trailing fields, padding kept
    path = _write(text) + "/" + delimited.case_insensitive_glob("feed_file.csv")
    good, rejects = delimited.ingest(spark, path, SCHEMA)
    g = sorted(map(tuple, good.collect()))
    assert g == [(1, "alpha", Decimal("1.50"), dt.date(2024, 1, 2)),
                 (2, "b, quoted", Decimal("2.00"), dt.date(2024, 1, 3)),
                 (3, "short", None, None),
                 (7, " padded ", None, None)]
    r = {row["name"]: row["reject_reason"] for row in rejects.collect()}
    assert r == {"long": "too_many_fields", "badnum": "bad_id", "baddate": "bad_day"}
    assert all(row["source_file"] for row in rejects.collect())


def test_a_quote_opens_a_field_only_at_its_start(spark):
    text = ("id,name,amount,day\n"
            '1,5" pipe,1.00,2024-01-01\n'           # inside a field: a character
            '2,a "b" c" d,1.00,2024-01-01\n'
            '3,"5"" pipe, long",1.00,2024-01-01\n'  # doubled inside an enclosed field
            '4,"never closed,1.00,2024-01-01\n'
            '5,"doubled at the end"",1.00,2024-01-01\n'
            '6,x,1.00,"2024-01-01\n'                 # the last field is opened
            '7,"",1.00,"2024-01-02"\n')
    good, rejects = delimited.ingest(spark, _write(text), SCHEMA)
    assert sorted((r.id, r.name) for r in good.collect()) == [(1, '5" pipe'), (2, 'a "b" c" d'), (3, '5" pipe, long'), (7, None)]
    bad = {r._record: r.reject_reason for r in rejects.collect()}
    assert sorted(k[0] for k in bad) == ["4", "5", "6"] and all("unclosed_quote" in v for v in bad.values())
    assert '4,"never closed,1.00,2024-01-01' in bad
    long = "8," + '"' * 4001 + "z" * 50_000  # a long line neither overflows the matcher nor takes long
    assert delimited.ingest(spark, _write("id,name,amount,day\n" + long + "\n"), SCHEMA)[1].count() == 1


def test_case_insensitive_glob():
    assert delimited.case_insensitive_glob("px_cat_g1v2.csv") == "[pP][xX]_[cC][aA][tT]_[gG]1[vV]2.[cC][sS][vV]"
