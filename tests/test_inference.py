"""Type inference by a lattice: cell rules, joins in any order, keys and ids."""

import random

import pytest
from pyspark.sql import functions as F

from ledgermatch.sources import files
from ledgermatch.sources.inference import infer_types

CASES = [
    (["1", "0", "-5"], "bigint"), (["1", "00123"], "string"), (["007"], "string"), (["+49"], "string"), (["1", "1.5"], "double"), (["1e3", "2"], "double"),
    ([".5", "5."], "double"), (["9223372036854775807"], "bigint"), (["9223372036854775808"], "string"), (["12345678901234567890123", "1"], "string"),
    (["01.5"], "string"), (["true", "FALSE"], "boolean"), (["true", "1"], "string"), (["2024-02-29"], "date"), (["2023-02-29"], "string"),
    (["2024-01-01", "2024-01-01 10:20"], "timestamp_ntz"), (["2024-01-01T10:20:30.5"], "timestamp_ntz"), (["2024-01-01", "1"], "string"),
    (["x", "1"], "string"), ([None, None], "string"), ([None, "3"], "bigint"), (["nan"], "string"), (["."], "string"), (["e5"], "string"), ([" 1"], "string"),
]


def test_lattice_of_cells(spark):
    depth = max(len(c) for c, _ in CASES)
    rows = [tuple(c[k] if k < len(c) else None for c, _ in CASES) for k in range(depth)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(len(CASES))))
    assert [f.dataType.simpleString() for f in infer_types(df)] == [t for _, t in CASES]


def test_any_order_and_partitioning_gives_the_same_type(spark):
    rng = random.Random(1)
    cells = [str(i) for i in range(500)] + ["2.5"] + [None] * 20
    for parts in (1, 3, 40):
        rng.shuffle(cells)
        df = spark.createDataFrame([(c, "0" + str(i)) for i, c in enumerate(cells)], "x string, y string").repartition(parts)
        assert infer_types(df).simpleString() == "struct<x:double,y:string>"


def test_keys_and_other_types_stay(spark):
    df = spark.createDataFrame([("1", "2", 3)], "k string, v string, n int")
    assert infer_types(df, keys=("k",)).simpleString() == "struct<k:string,v:bigint,n:int>"
    assert infer_types(df.select(F.col("v").alias("a.b"))).simpleString() == "struct<a.b:bigint>"
    assert infer_types(df.select("n")).simpleString() == "struct<n:int>"
    assert infer_types(df.limit(0)).simpleString() == "struct<k:string,v:string,n:int>"


def test_scan_with_inferred_types(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("id,key,amount,date,ok\n00123,17,1.5,2024-01-01,true\n00124,18,NA,2024-01-02,\n")
    df = files.read_delimited(spark, str(p), infer_schema="lattice", keys=("key",))
    assert dict(df.dtypes) == {"id": "string", "key": "string", "amount": "double", "date": "timestamp_ntz", "ok": "boolean"}
    assert [r.id for r in df.collect()] == ["00123", "00124"]
    with pytest.raises(ValueError):
        files.read_delimited(spark, str(p), infer_schema="guess")
