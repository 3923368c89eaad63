"""Multi-line CSV in blocks of a few bytes against Spark's own reader in one task."""

import csv
import random

import pytest

from conftest import rows
from reelsift.sources import readers, splitcsv, writers
from workload import REGISTRY
from workload.registry import Tables

SCHEMA = "id string, text string, n int"


def made(seed, n):
    rng = random.Random(seed)
    bits = ["a", "é", '"', "\n", ",", " ", "\n\n", '""', "x" * 30, '",', '\n"', "\r\n"]
    return [(str(k), "".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) + "z", rng.randint(0, 99)) for k in range(n)]


def write(path, data, end="\n"):
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(["id", "text", "n"])
        writer.writerows(data)


@pytest.mark.parametrize("size", [7, 64, 1000, None])
def test_blocks_of_any_size_give_the_records(spark, tmp_path, size):
    for k, end in enumerate(("\n", "\r\n")):
        write(tmp_path / f"{k}.csv", made(k, 120), end)
    got = splitcsv.read_split_csv(spark, str(tmp_path), SCHEMA, block_bytes=size)
    assert rows(got, "id", "text", "n") == sorted(made(0, 120) + made(1, 120), key=repr)
    assert {f.rsplit("/", 1)[1] for f, in rows(got.select("_file").distinct())} == {"0.csv", "1.csv"}


def test_one_file_in_several_tasks_equals_the_scan(spark, tmp_path):
    data = spark.createDataFrame([(i, "y" + t.replace("\r", ""), n) for i, t, n in made(3, 400)], SCHEMA).coalesce(1)
    writers.write_csv(data, str(tmp_path / "csv"))
    whole = spark.read.schema(SCHEMA).options(**readers.CSV_DIALECT).csv(str(tmp_path / "csv"))
    split = splitcsv.read_split_csv(spark, str(tmp_path / "csv"), SCHEMA, block_bytes=512)
    assert rows(split, "id", "text", "n") == rows(whole) == rows(data)
    blocks = splitcsv.whole_records(spark, str(tmp_path / "csv"), block_bytes=512).select("block").distinct().count()
    assert blocks > 5


def test_records_longer_than_blocks(spark, tmp_path):
    data = [("1", 'line "one"\n' * 300, 1), ("2", "short", 2), ("3", "\n" * 500, 3)]
    write(tmp_path / "a.csv", data)
    got = splitcsv.read_split_csv(spark, str(tmp_path), SCHEMA, block_bytes=100)
    assert rows(got, "id", "text", "n") == data


def test_blank_lines_nulls_and_no_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,,3\n\n2,"",\n   \n"3","a\n\nb",x\n')
    got = splitcsv.read_split_csv(spark, str(tmp_path), SCHEMA, header=False, block_bytes=5)
    want = spark.read.schema(SCHEMA).options(**readers.CSV_DIALECT | {"header": False}).csv(str(tmp_path))
    assert rows(got, "id", "text", "n") == rows(want)


def test_unbalanced_quotes_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text,n\n1,"open\n2,b,3\n')
    with pytest.raises(ValueError, match="within quotes"):
        splitcsv.read_split_csv(spark, str(tmp_path), SCHEMA)


def test_country_files_split(spark, tmp_path):
    for country in ("US", "DE"):
        write(tmp_path / f"{country}_trending.csv", made(5, 30))
    split = readers.read_country_files(spark, str(tmp_path), "video_id string, title string, view_count int", split=True, block_bytes=50)
    whole = readers.read_country_files(spark, str(tmp_path), "video_id string, title string, view_count int")
    told = ("video_id", "view_count", "country_dataset")
    assert split.columns == whole.columns and rows(split, *told) == rows(whole, *told)


def test_the_query_writes_its_input_in_as_many_tasks_as_it_reads_it(spark, tmp_path, monkeypatch):
    data = spark.range(400).selectExpr("id AS doc_id", "concat('a \"quoted\"\n', id) AS text")
    data.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    tasks, write_csv = [], writers.write_csv
    monkeypatch.setattr(writers, "write_csv", lambda df, path: (tasks.append(df.rdd.getNumPartitions()), write_csv(df, path)))
    out = REGISTRY["s1_split_csv"].run(Tables(spark, str(tmp_path)))
    expected = data.selectExpr("string(doc_id)", "md5(text)", "string(doc_id)")
    assert rows(out, "video_id", "title", "channel_id") == rows(expected) and tasks[0] >= 4
