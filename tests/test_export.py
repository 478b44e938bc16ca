"""Tables that the queries make once: the export that load_raw reads, and the gold table that pages are taken from."""

import glob
import gzip

from pyspark.sql import functions as F

from obsflow.session import scratch_path
from obsflow.sources.archive_csv import read_export
from tests.conftest import rows
from verification import REGISTRY, chain, pipeline  # noqa: F401
from verification.inputs import raw_observations


def test_files_follow_the_rows_and_each_has_its_head(spark, sf_dir):
    raw = raw_observations(spark, sf_dir).limit(500)
    path = scratch_path(spark, "export")
    chain._export(raw, path, 9)
    files = glob.glob(f"{path}/part=*/part-*")
    assert len(files) == 9 and len(glob.glob(f"{path}/part=*")) == 9
    for file in files:
        lines = open(file).read().splitlines()
        assert [line[:1] for line in lines[:2]] == ["#", "#"] and lines[2].startswith("dataproduct_type,")
        assert len(lines) < 3 + 150
    assert rows(read_export(spark, path, embedded_newlines=False), "obs_id", "proposal_id", "t_min", "s_dec") == rows(
        raw, "obs_id", "proposal_id", "t_min", "s_dec"
    )


def test_a_hot_value_does_not_fill_one_file(spark, sf_dir):
    raw = raw_observations(spark, sf_dir).limit(500).withColumn("proposal_id", F.lit(None).cast("string"))
    path = scratch_path(spark, "export")
    chain._export(raw, path, 5)
    assert max(len(open(f).readlines()) for f in glob.glob(f"{path}/part=*/part-*")) < 250


def test_a_large_export_is_compressed_and_each_file_has_its_head(spark, sf_dir, monkeypatch):
    """Before, it was plain text however large, and all of it was shuffled."""
    monkeypatch.setattr(chain, "_PLAIN_FILES", 8, raising=False)
    raw = raw_observations(spark, sf_dir).limit(500).repartition(3)
    path = scratch_path(spark, "export")
    chain._export(raw, path, 9)
    files = glob.glob(f"{path}/part=*/part-*")
    assert 9 <= len(files) <= 9 + 3 and all(file.endswith(".gz") for file in files)
    for file in files:
        lines = gzip.open(file, "rt").read().splitlines()
        assert [line[:1] for line in lines[:2]] == ["#", "#"] and lines[2].startswith("dataproduct_type,")
        assert 3 < len(lines) <= 3 + 56
    columns = "obs_id", "proposal_id", "t_min", "s_dec"
    assert rows(read_export(spark, path, embedded_newlines=False), *columns) == rows(raw, *columns)


def test_an_export_of_no_rows_is_loaded(spark, sf_dir):
    raw = raw_observations(spark, sf_dir).filter("obs_id = 'none'")
    path = scratch_path(spark, "export")
    chain._export(raw, path, 4)
    assert read_export(spark, path, embedded_newlines=False).isEmpty()


def test_query_writes_more_files_for_more_rows(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(chain, "_EXPORT_ROWS", 1000)
    made = []
    export = chain._export
    monkeypatch.setattr(chain, "_export", lambda raw, path, files: made.append(files) or export(raw, path, files))
    found = REGISTRY["load_raw"].build(spark, sf_dir)
    count = raw_observations(spark, sf_dir).count()
    assert made == [-(-count // 1000)] and made[0] > 4
    assert found.agg({"n": "sum"}).first()[0] == count


def test_pages_come_from_a_gold_table_that_was_computed_once(spark, sf_dir):
    page = REGISTRY["page_after_contaminated"].build(spark, sf_dir)
    assert page.inputFiles() and all("/contaminated-" in file for file in page.inputFiles())
