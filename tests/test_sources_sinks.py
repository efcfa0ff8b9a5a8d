import glob
import gzip
import json

import pytest
from conftest import as_set, plan_of
from pyspark.sql import functions as F

from gristmill import scratch, sinks, sources


def write(path, text, packed=False):
    opener = gzip.open if packed else open
    with opener(path, "wt", encoding="utf-8", newline="") as f:
        f.write(text)
    return str(path)


def test_tsv_strings_empty_short_long(spark, tmp_path):
    path = write(
        tmp_path / "a.tsv.gz",
        'code\tname\tfat\n1\t"a ""b"", c"\t1,5\n2\t\t7\n3\tshort\n4\tlong\t9\textra\n',
        packed=True,
    )
    df = sources.read_delimited(spark, path)
    assert set(dict(df.dtypes).values()) == {"string"}
    assert as_set(df) == {
        ("1", 'a "b", c', "1,5"), ("2", None, "7"), ("3", "short", None), ("4", "long", "9"),
    }


def test_multiline_and_inference(spark, tmp_path):
    path = write(tmp_path / "m.tsv", 'id\ttext\n1\t"two\nlines, ""quoted"""\n2\tone\n')
    df = sources.read_delimited(spark, path, multiline=True)
    assert as_set(df) == {("1", 'two\nlines, "quoted"'), ("2", "one")}
    typed = sources.read_delimited(spark, path, multiline=True, infer=True)
    assert dict(typed.dtypes) == {"id": "int", "text": "string"}
    given = sources.read_delimited(spark, path, multiline=True, schema="id bigint, text string")
    assert dict(given.dtypes)["id"] == "bigint"


def test_jsonl_with_missing_fields_and_a_bad_line(spark, tmp_path):
    lines = [
        json.dumps({"code": "1", "nutriments": {"fat_100g": 1.5, "saturated-fat_100g": 2}}),
        json.dumps({"code": "2", "nutriments": {"salt_100g": 0.5}}),
        "{broken",
    ]
    df = sources.read_jsonl(spark, write(tmp_path / "a.jsonl", "\n".join(lines)))
    assert df.where("code = '2'").select("nutriments.salt_100g").first()[0] == 0.5
    good = df.where("code is not null")
    assert good.count() == 2


def test_read_any(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    paths = {
        "tsv": sinks.write_delimited(df, str(tmp_path / "t")),
        "csv": sinks.write_delimited(df, str(tmp_path / "c"), sep=","),
        "jsonl": sinks.write_jsonl(df, str(tmp_path / "j")),
        "parquet": sinks.write_parquet(df, str(tmp_path / "p")),
    }
    for name, path in paths.items():
        got = sources.read_any(spark, path, name)
        assert [str(v) for v in got.select("a", "b").first()] == ["1", "x"], name
    with pytest.raises(ValueError):
        sources.read_any(spark, paths["csv"], "xml")


def test_delimited_roundtrip_of_awkward_text(spark, tmp_path):
    texts = [' lead and trail ', 'quote " and ""', "tab\tand, comma", "line\nbreak\n", "\\ back\\", "ünï"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    path = sinks.write_delimited(df, str(tmp_path / "r"), compression="gzip")
    got = sources.read_delimited(spark, path, multiline=True)
    assert {(int(i), t) for i, t in as_set(got)} == set(enumerate(texts))


def test_spread_deals_rows_anew(spark):
    few = spark.range(0, 100, 1, 2)
    assert sources.spread(few, 5).rdd.getNumPartitions() == 5
    assert "rebalance" in plan_of(sources.spread(few)).lower()
    assert sources.spread(few).count() == 100


DAMAGED = "code\tname\tfat\n1\ta\t1,5\n2\tshort\n3\tlong\t2\textra\n4\td\t5\n"


def test_split_corrupt(spark, tmp_path):
    good, bad = sources.split_corrupt(spark, write(tmp_path / "d.tsv.gz", DAMAGED, packed=True))
    assert good.columns == ["code", "name", "fat"]
    assert as_set(good) == {("1", "a", "1,5"), ("4", "d", "5")}
    assert as_set(bad.select("code", sources.CORRUPT)) == {("2", "2\tshort"), ("3", "3\tlong\t2\textra")}
    # Narrow reads and bare counts still notice the damage.
    assert good.count() == 2 and bad.count() == 2
    assert as_set(good.select("code")) == {("1",), ("4",)}
    assert as_set(bad.select(sources.CORRUPT)) == {("2\tshort",), ("3\tlong\t2\textra",)}
    assert "InMemory" not in plan_of(good).replace("InMemoryFileIndex", "")


def test_split_corrupt_options(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'code,name\n1,"a\nb"\n,x\n2,y,z\n')
    good, bad = sources.split_corrupt(spark, path, sep=",", multiline=True)
    assert as_set(good) == {("1", "a\nb"), (None, "x")} and good.count() == 2
    assert bad.count() == 1
    typed, wrong = sources.split_corrupt(spark, path, "code int, name string", sep=",", multiline=True)
    assert dict(typed.dtypes)["code"] == "int" and wrong.count() == 1


def test_write_parquet_overwrites_and_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.range(10).withColumn("part", F.col("id") % 2)
    sinks.write_parquet(df, path)
    sinks.write_parquet(df, path, partition_by=["part"])
    assert sources.read_parquet(spark, path).count() == 10
    assert len(glob.glob(f"{path}/part=*")) == 2


def test_small_csv_is_one_part(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.range(0, 50, 1, 10).withColumn("v", F.col("id") * 0.5)
    sinks.write_small_csv(df, path)
    parts = glob.glob(f"{path}/part-*")
    assert len(parts) == 1
    with open(parts[0]) as f:
        assert f.readline().strip() == "id,v"
    assert sources.read_delimited(spark, path, sep=",").count() == 50


def test_scratch_uses_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch.folder(spark, "x"), scratch.folder(spark, "x")
    assert one.startswith(named) and one != two
    df = scratch.materialize(spark.range(5).withColumn("r", F.rand()), "x")
    assert as_set(df) == as_set(df)
    assert "Range" not in plan_of(df)


def test_scratch_where_no_folder_is_named(spark):
    context = spark.sparkContext

    class Unset:
        sparkContext = context

        class conf:
            @staticmethod
            def get(key, default):
                return default

    # The default file system of the tests is local, so there is no shared folder.
    with pytest.raises(ValueError, match="share"):
        scratch.base(Unset)
