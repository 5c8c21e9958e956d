"""SC5 (JSON array rate card, dburate as string or number) and SK1-SK4."""

import json
import os

import pytest

from spendwatch import schemas as S
from spendwatch.functions.rules import ExclusionRules
from spendwatch.operators import pricing, sinks
from spendwatch.session import _private_dir, scratch_path
from spendwatch.sources.readers import rate_card_scan


def test_rate_card_json_array(spark):
    path = scratch_path(spark, "card-json").removeprefix("file:")
    os.makedirs(path)
    card = [
        {"instance": "r5d.xlarge (Photon)", "compute": "All-Purpose Compute Photon", "plan": "Premium", "dburate": "1.5"},
        {"instance": "r5d.xlarge", "compute": "All-Purpose Compute", "plan": "Premium", "dburate": 0.75},
        {"instance": "r5d.xlarge", "compute": "All-Purpose Compute", "plan": "Enterprise", "dburate": 0.75},
        {"instance": "m5.large", "compute": "Jobs Compute", "plan": "Premium", "dburate": 0.3, "extra": 1},
    ]
    with open(os.path.join(path, "AWS.json"), "w") as fh:
        json.dump(card, fh, indent=2)
    scanned = rate_card_scan(spark, path, multi_line=True)
    assert scanned.count() == 4
    kept = sorted(tuple(r) for r in pricing.all_purpose(scanned).collect())
    assert kept == [("r5d.xlarge", "All-Purpose Compute", False, 0.75),
                    ("r5d.xlarge", "All-Purpose Compute Photon", True, 1.5)]


def test_missing_table_reads_empty(spark):
    path = scratch_path(spark, "never-written")
    df = sinks.read_or_empty(spark, path, S.SEND_LOG)
    assert df.count() == 0 and df.schema == S.SEND_LOG


def test_overwrite_replaces_and_append_adds(spark):
    path = scratch_path(spark, "roundtrip")
    df = spark.createDataFrame([(1,), (2,)], "x int")
    sinks.overwrite(df, path)
    sinks.overwrite(df, path)
    assert spark.read.parquet(path).count() == 2
    sinks.append(df, path)
    assert spark.read.parquet(path).count() == 4


def test_a_large_date_is_split_over_writer_tasks(spark, monkeypatch):
    rows = spark.range(200_000).selectExpr("cast(id as string) AS cluster_id", "date'2024-01-01' AS snapshot_date")
    path = scratch_path(spark, "one-date")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        sinks.write_scores(rows, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    back = spark.read.parquet(path)
    assert back.count() == 200_000
    assert len(back.inputFiles()) > 4


def test_unset_checkpoint_folder_is_an_error_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        _private_dir("spark://host:7077")
    assert os.path.isdir(_private_dir("local[2]"))


def test_rules_come_from_a_table(spark):
    rules = ExclusionRules(ids=("9", "1"), name_patterns=("b*", "a*"), creators=("x@y",))
    assert ExclusionRules.from_frame(rules.to_frame(spark)) == rules
    bad = spark.createDataFrame([(1, "nonsense", "x")], S.EXCLUSION_RULES)
    with pytest.raises(ValueError, match="nonsense"):
        ExclusionRules.from_frame(bad)


def test_json_arrays_stay_small_however_many_rows(spark):
    """Equal rows too: each file is one array of at most so many rows, and all rows come back."""
    from spendwatch.sources.readers import rate_card_scan, write_json_arrays
    card = spark.range(0, 1000, 1, 2).selectExpr("CASE WHEN id < 900 THEN 'same \"é\"' ELSE concat('n', id) END AS instance",
                                                 "CASE WHEN id % 2 = 0 THEN 'c' END AS compute", "'Premium' AS plan", "1.5D AS dburate")
    path = write_json_arrays(card, scratch_path(spark, "card-arrays").removeprefix("file:"), rows_per_file=150)
    sizes = []
    for folder, _, files in os.walk(path):
        for name in files:
            if name.startswith("part-"):
                with open(os.path.join(folder, name)) as fh:
                    sizes.append(len(json.load(fh)))
    assert sum(sizes) == 1000 and max(sizes) <= 150
    assert sorted(map(str, rate_card_scan(spark, path).collect())) == sorted(map(str, card.collect()))
    empty = write_json_arrays(card.limit(0), scratch_path(spark, "card-arrays"))
    assert rate_card_scan(spark, empty).count() == 0


def test_json_arrays_read_as_by_the_file_reader(spark):
    """Numbers as text, indents, single objects, empty, broken and null files."""
    from spendwatch.sources import readers
    texts = ['[{"instance": "a", "dburate": 1.50}, {"instance": "é", "dburate": "2.5", "plan": null, "x": [1]}]', '{"instance": "one", "dburate": 1e2}',
             "", " \n", "[]", '[{"instance": "b"', "[\n  {\n \"compute\": 7, \"dburate\": 0.1}\n]\n", "\ufeff" + '[{"instance": "bom", "dburate": 3}]',
             '[{"instance": {"k": 1.0}, "dburate": 1.25}]']
    for k, text in enumerate(texts):
        path = scratch_path(spark, f"card-{k}").removeprefix("file:")
        os.makedirs(path)
        with open(os.path.join(path, "card.json"), "w") as fh:
            fh.write(text)
        old = spark.read.schema(readers._RATE_CARD_JSON).option("multiLine", True).json(path)
        want = old.select("instance", "compute", "plan", old.dburate.cast("double").alias("dburate")).collect()
        assert list(map(str, rate_card_scan(spark, path).collect())) == list(map(str, want)), text
