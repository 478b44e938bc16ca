"""S1-S5, S8, S10, K1-K3, K5, and the connection options of S3 and K4."""

import os
from random import Random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.schemas import RAW_OBSERVATION
from obsflow.sinks import catalog, files
from obsflow.sources import archive_csv, jdbc, tables
from tests.conftest import rows

ABC = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])


def csv(tmp_path, text):
    path = tmp_path / "export.csv"
    path.write_text(text)
    return str(path)


def test_s1_positional_text(spark, tmp_path):
    path = csv(tmp_path, '# one\n#two,x\nZ,Y,X\n1,,"q ""r"", s"\n" p ","","#n"\n#3,4,5\n"two\nlines",2.50,\n')
    got = rows(archive_csv.read_export(spark, path, ABC))
    assert got == [("1", None, 'q "r", s'), (" p ", "", "#n"), ("#3", "4", "5"), ("two\nlines", "2.50", None)]


def test_s1_heads_of_several_files(spark, tmp_path):
    """Each file's own head goes, also where one task reads several files or many tasks one."""
    for number, head in enumerate(("", "# x\n", "#x,y\n#\n")):
        body = "".join(f"#{number},{i},\n" for i in range(500))
        (tmp_path / f"{number}.csv").write_text(f"{head}a,b,c\n{body}")
    want = [(f"#{n}", str(i), None) for n in range(3) for i in range(500)]
    for size in ("200", "1000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            df = archive_csv.read_export(spark, str(tmp_path), ABC, embedded_newlines=False)
            assert sorted(rows(df)) == sorted(want)
            assert (df.rdd.getNumPartitions() > 3) == (size == "200")
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def in_parts(spark, path, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        return archive_csv.read_export_in_parts(spark, path, ABC)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("size", ["4000"])
def test_s1_quoted_line_breaks_in_several_tasks(spark, tmp_path, size):
    """The rows of the one-task read, wherever the parts of a file begin."""
    random = Random(5)
    texts = ["", '""', "x", "#x", '"a,b"', '"two\nlines"', '"say ""so""\n\n"', '"\r\n"', '"' + "long\n" * 90 + '"', " p ", '"#\n"""']
    for number, end in enumerate(("\n", "\r\n", "\n")):
        head = ("", "# x\n", "#x,y\n#\n")[number]
        body = "\n".join(",".join(random.choice(texts) for _ in "abc") + ("" if i % 9 else "\n") for i in range(120))
        (tmp_path / f"{number}.csv").write_bytes(f"{head}a,b,c\n{body}".replace("\r", "").replace("\n", end).encode())
    (tmp_path / "3.csv").write_text("# nothing but a head\n")
    want = rows(archive_csv.read_export(spark, str(tmp_path), ABC))
    got = rows(in_parts(spark, str(tmp_path), size))
    key = [[repr(v) for v in r] for r in want]
    assert sorted([repr(v) for v in r] for r in got) == sorted(key) and len(want) == 360


def test_s1_in_parts_without_records_or_with_bad_ones(spark, tmp_path):
    for text in ("", "# only\n", "a,b,c\n"):
        assert rows(in_parts(spark, csv(tmp_path, text), "1000")) == []
    for text, said in (("a,b,c\n1,2\n", "Malformed record"), ('# "x\na,b,c\n1,2,3\n', "Malformed comment"),
                       ("# x\n" * 20 + "a,b,c\n1,2,3\n", "does not fit")):
        with pytest.raises(Exception, match=said):
            in_parts(spark, csv(tmp_path, text), "1000").collect()


@pytest.mark.parametrize("text", ["", "# only\n", "a,b,c\n", "#x\na,b,c\n"])
def test_s1_no_records(spark, tmp_path, text):
    assert rows(archive_csv.read_export(spark, csv(tmp_path, text), ABC)) == []


def test_s1_a_comment_that_opens_a_quote_is_an_error(spark, tmp_path):
    df = archive_csv.read_export(spark, csv(tmp_path, '# x,"y\na,b,c\n1,2,3\n'), ABC)
    with pytest.raises(Exception, match="Malformed comment"):
        df.collect()


def test_s1_without_embedded_newlines(spark, tmp_path):
    path = csv(tmp_path, "#c\na,b,c\n1,2,3\n")
    assert rows(archive_csv.read_export(spark, path, ABC, embedded_newlines=False)) == [("1", "2", "3")]


@pytest.mark.parametrize("line", ["1,2\n", "1,2,3,4\n"])
def test_s1_other_width_fails(spark, tmp_path, line):
    df = archive_csv.read_export(spark, csv(tmp_path, "a,b,c\n1,2,3\n" + line), ABC)
    with pytest.raises(Exception, match="[Mm]alformed"):
        df.select("a").collect()


def test_s1_all_columns(spark, tmp_path):
    values = ",".join(str(i) for i in range(36))
    path = csv(tmp_path, ",".join(RAW_OBSERVATION.fieldNames()) + "\n" + values + "\n")
    row = archive_csv.read_export(spark, path).first()
    assert (row["dataproduct_type"], row["jpegURL"], row["wave_region"]) == ("0", "25", "35")


def test_s2_s4_absent_path_is_empty(spark, tmp_path):
    df = tables.read_or_empty(spark, str(tmp_path / "none"), ABC)
    assert df.schema == ABC and not tables.has_rows(df)


def test_k1_k5_write_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    assert files.write_parquet(spark.range(25), path) == 25
    assert files.write_parquet(spark.range(7), path) == 7
    assert files.write_parquet(spark.range(0), path) == 0
    assert tables.read_parquet(spark, path).count() == 0


def test_k2_replace_reads_its_own_path(spark, tmp_path):
    path = str(tmp_path / "t")
    files.replace_parquet(spark.range(5), path)
    both = spark.read.parquet(path).union(spark.range(5, 8))
    assert files.replace_parquet(both, path) == 8
    assert sorted(r[0] for r in rows(spark.read.parquet(path))) == list(range(8))
    assert os.listdir(tmp_path) == ["t"]


def test_k2_failed_write_keeps_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    files.replace_parquet(spark.range(5), path)
    broken = spark.read.parquet(path).select(F.raise_error(F.lit("broken")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        files.replace_parquet(broken, path)
    assert spark.read.parquet(path).count() == 5


def test_k2_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(6).selectExpr("id", "id % 3 AS p")
    files.replace_partitions(df, path, ["p"])
    changed = spark.read.parquet(path).filter("p = 1").union(spark.range(1).selectExpr("99L AS id", "1L AS p"))
    assert files.replace_partitions(changed, path, ["p"]) == 3
    got = rows(spark.read.parquet(path).groupBy("p").agg(F.sort_array(F.collect_list("id"))), "p")
    assert got == [(0, [0, 3]), (1, [1, 4, 99]), (2, [2, 5])]


def test_s8_s10_k3_catalog(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_parquet(spark.range(3), path)
    assert tables.catalog_table(spark, "lake.seen", path).count() == 3
    assert tables.catalog_table(spark, "lake.seen", path).count() == 3
    target = str(tmp_path / "g")
    assert catalog.publish(spark.range(4), "lake.made", target) == 4
    assert catalog.publish(spark.range(9), "lake.made", target) == 9
    assert tables.read_table(spark, "lake.made").count() == 9
    catalog.publish(spark.range(2).selectExpr("id", "'x' AS name"), "lake.made", target)
    assert tables.read_table(spark, "lake.made").columns == ["id", "name"]


def test_k2_a_replacement_that_broke_off_is_made_up_for(spark, tmp_path):
    path = str(tmp_path / "t")
    files.replace_parquet(spark.range(5), path)
    os.rename(path, f"{path}.previous-abc")
    with pytest.raises(FileNotFoundError, match="being replaced"):
        tables.read_or_empty(spark, path, ABC)
    files.recover(spark, path)
    assert spark.read.parquet(path).count() == 5
    os.rename(path, f"{path}.previous-abc")
    assert files.replace_parquet(spark.range(3), path) == 3
    assert spark.read.parquet(path).count() == 3 and os.listdir(tmp_path) == ["t"]


def test_s3_hash_split_meets_each_row_once():
    first, second, third = jdbc.HashSplit("obsid", 3).predicates()
    share = "mod(abs(CAST(hashtext(CAST(obsid AS text)) AS bigint)), 3)"
    assert (first, second, third) == (f"{share} = 0 OR obsid IS NULL", f"{share} = 1", f"{share} = 2")


def test_s3_k4_connection():
    url, properties = jdbc.connection("postgresql://me:p%40ss@db.example:5433/store")
    assert url == "jdbc:postgresql://db.example:5433/store"
    assert properties == {"user": "me", "password": "p@ss", "driver": "org.postgresql.Driver"}
    assert jdbc.connection("postgres://db.example/store")[0] == "jdbc:postgresql://db.example/store"
    with pytest.raises(ValueError, match="scheme"):
        jdbc.connection("mysql://db.example/store")
