"""Tables published together: one switch, runs that end anywhere, nothing left behind."""

import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from waferlens.sources import versions


class Ended(Exception):
    pass


@pytest.fixture
def layer():
    return f"pub_{uuid.uuid4().hex[:8]}"


NAMES = ("big", "small")


def frames(spark, mark, extra=False):
    big = spark.range(20).select("id", F.lit(mark).alias("mark"))
    small = spark.range(1).select(F.lit(mark).alias("mark"))
    return {"big": big.withColumn("more", F.lit(1.5)) if extra else big, "small": small}


def run(spark, layer, mark, root=None, extra=False):
    version = versions.begin(spark, layer, "c", NAMES, root)
    built = {
        n: versions.add(df, layer, n, version, root, {"mark": "who wrote it"}, f"Table '{n}'.")
        for n, df in frames(spark, mark, extra).items()
    }
    versions.switch(spark, layer, "c", version, {n: df.columns for n, df in built.items()})
    versions.clean_up(spark, layer, "c", NAMES)
    return version


def seen(spark, layer):
    """The marks a reader finds, by a single query over both tables."""
    rows = spark.sql(f"select mark, count(*) from {layer}.big group by mark").collect()
    other = spark.sql(f"select mark from {layer}.small").collect()
    return [tuple(r) for r in rows], [r[0] for r in other]


def test_tables_switch_together_and_old_versions_go(spark, layer, tmp_path):
    root = str(tmp_path / "lake")
    found = [run(spark, layer, mark, root) for mark in range(4)]
    assert seen(spark, layer) == ([(3, 20)], [3])
    for name in NAMES:
        folders = {p.name for p in (tmp_path / "lake" / layer / f"{name}_versions").iterdir() if p.is_dir()}
        assert folders == {f"_version={v}" for v in found[-2:]}
    assert versions.read_version(spark, layer, "small", found[-2]).first()["mark"] == 2
    assert versions.current_version(spark, layer, "c") == found[-1]
    assert spark.catalog.getTable(f"{layer}.big").description == "Table 'big'."
    assert {c.name: c.description for c in spark.catalog.listColumns(f"{layer}.big")}["mark"] == "who wrote it"


STEPS = ["begin", "add", "switch", "_show", "clean_up"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("after", [False, True])
def test_a_run_that_ends_anywhere_leaves_old_or_new_whole(spark, layer, tmp_path, monkeypatch, step, after):
    root = str(tmp_path / "lake")
    run(spark, layer, 1, root)
    calls = 0
    with monkeypatch.context() as patch:
        real = getattr(versions, step)

        def ended(*args, **named):
            nonlocal calls
            calls += 1
            # Of the two tables the second one is not written, or written and then ended.
            last = calls == (2 if step == "add" else 1)
            if last and not after:
                raise Ended
            result = real(*args, **named)
            if last:
                raise Ended
            return result

        patch.setattr(versions, step, ended)
        with pytest.raises(Ended):
            run(spark, layer, 2, root, extra=True)
    rows, other = seen(spark, layer)
    assert (rows, other) in [([(1, 20)], [1]), ([(2, 20)], [2])]
    run(spark, layer, 3, root, extra=True)
    assert seen(spark, layer) == ([(3, 20)], [3])
    assert spark.table(f"{layer}.big").columns == ["id", "mark", "more"]
    published = {r["version"] for r in versions.publications(spark, layer, "c")[:2]}
    for name in NAMES:
        folders = {p.name for p in (tmp_path / "lake" / layer / f"{name}_versions").iterdir() if p.is_dir()}
        assert folders == {f"_version={v}" for v in published}


def test_files_of_an_unfinished_write_are_removed(spark, layer, tmp_path):
    root = str(tmp_path / "lake")
    run(spark, layer, 1, root)
    stray = Path(root) / layer / "big_versions" / f"{versions.VERSION}=stray"
    stray.mkdir()
    (stray / "part-0.parquet").write_bytes(b"half a file")
    run(spark, layer, 2, root)
    assert not stray.exists() and seen(spark, layer) == ([(2, 20)], [2])


def test_columns_may_come_and_go_but_not_change_type(spark, layer):
    run(spark, layer, 1, extra=True)
    run(spark, layer, 2)
    assert spark.table(f"{layer}.big").columns == ["id", "mark"]
    run(spark, layer, 3, extra=True)
    assert spark.table(f"{layer}.big").agg(F.sum("more")).first()[0] == 30.0
    version = versions.begin(spark, layer, "c", NAMES)
    other = spark.range(3).select(F.col("id").cast("string"), F.lit(4).alias("mark"))
    with pytest.raises(ValueError, match="id is bigint, not string"):
        versions.add(other, layer, "big", version)
    assert seen(spark, layer) == ([(3, 20)], [3])


def test_collections_of_a_schema_are_apart(spark, layer):
    run(spark, layer, 1)
    version = versions.begin(spark, layer, "other", ["own"])
    own = versions.add(spark.range(2), layer, "own", version)
    versions.switch(spark, layer, "other", version, {"own": own.columns})
    versions.clean_up(spark, layer, "other", ["own"])
    run(spark, layer, 2)
    assert spark.table(f"{layer}.own").count() == 2 and seen(spark, layer) == ([(2, 20)], [2])
    assert versions.current_version(spark, layer, "nothing") is None


def test_only_the_present_partition_is_read(spark, layer):
    for mark in (1, 2):
        run(spark, layer, mark)
    view = spark.table(f"{layer}.big")
    view.collect()
    text = view._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({versions.VERSION}" in text


def test_a_plain_table_of_that_name_is_replaced(spark, layer):
    spark.sql(f"create schema {layer}")
    spark.range(3).write.saveAsTable(f"{layer}.big")
    run(spark, layer, 1)
    assert seen(spark, layer) == ([(1, 20)], [1])
