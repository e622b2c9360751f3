import json
import os

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from tidewire.sources import store


def test_store(spark, tmp_path):
    assert store.load(spark, str(tmp_path / "none"), "id string").count() == 0
    store.save(spark.createDataFrame([("a",)], "id string"), str(tmp_path / "s"))
    assert [r["id"] for r in store.load(spark, str(tmp_path / "s"), "id string").collect()] == ["a"]
    runs = spark.range(5).select(F.col("id").cast("string").alias("run_id"), F.timestamp_seconds("id").alias("started_at"))
    assert {r["run_id"] for r in store.retain_runs(runs, 2).collect()} == {"3", "4"}
    assert spark.range(1).select(store.inline_json(F.struct(F.lit("</script>").alias("x"))).alias("j")).first()["j"] == '{"x":"<\\/script>"}'
    store.write_json_atomic(str(tmp_path / "d" / "a.json"), {"标题": 1})
    text = (tmp_path / "d" / "a.json").read_text("utf-8")
    assert json.loads(text) == {"标题": 1} and "标题" in text and text.endswith("}\n")


def test_a_store_that_lacks_columns_is_refused(spark, tmp_path):
    store.save(spark.createDataFrame([("a",)], "id string"), str(tmp_path / "s"))
    with pytest.raises(ValueError, match="title"):
        store.load(spark, str(tmp_path / "s"), "id string, title string")


class Killed(BaseException):
    """Not an Exception, so that nothing on the way can go on after it."""


def run_of(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("id")), {"news.json": f"news {n}\n", "meta.json": f"meta {n}\n"}


def state(spark, root):
    """What a reader sees: the number of rows and both documents."""
    s = store.Snapshots(spark, root)
    rows = store.load(spark, root, "id string").count()
    return rows, s.document("news.json"), s.document("meta.json")


def steps(monkeypatch, at):
    """Let the `at`-th change of the file system die, before or after it is made."""
    left = [at]

    def dying(real):
        def step(*args, **kw):
            left[0] -= 1
            if left[0] == 0:
                raise Killed
            out = real(*args, **kw)
            left[0] -= 1
            if left[0] == 0:
                raise Killed
            return out

        return step

    for name in ("write", "rename", "delete"):
        monkeypatch.setattr(store.Files, name, dying(getattr(store.Files, name)))
    monkeypatch.setattr(DataFrameWriter, "parquet", dying(DataFrameWriter.parquet))
    return left


def test_a_run_killed_at_any_step_leaves_a_whole_version(spark, tmp_path, monkeypatch):
    """Either the old version or the new one, never a mixture; and the next run goes through."""
    ends = []
    for at in range(1, 40):
        root = str(tmp_path / f"s{at}")
        for n in (10, 11, 12):
            store.save(*swap(run_of(spark, n), root))
        with monkeypatch.context() as patch:
            left = steps(patch, at)
            try:
                store.save(*swap(run_of(spark, 20), root))
            except Killed:
                pass
        seen = state(spark, root)
        assert seen in ((12, "news 12\n", "meta 12\n"), (20, "news 20\n", "meta 20\n"))
        ends.append(seen[0])
        store.save(*swap(run_of(spark, 30), root))
        assert state(spark, root) == (30, "news 30\n", "meta 30\n")
        store.save(*swap(run_of(spark, 31), root))
        assert len(os.listdir(tmp_path / f"s{at}" / "versions")) == store.KEEP  # what was left behind is swept
        if left[0] > 0:
            break
    assert ends[0] == 12 and ends[-1] == 20 and ends == sorted(ends)


def swap(run, root):
    return run[0], root, run[1]


def test_a_failed_job_leaves_the_store(spark, tmp_path):
    root = str(tmp_path / "s")
    store.save(*swap(run_of(spark, 10), root))
    bad = spark.range(5).select(F.when(F.col("id") < 4, F.col("id").cast("string")).otherwise(F.raise_error(F.lit("no"))).alias("id"))
    with pytest.raises(Exception, match="no"):
        store.save(bad, root)
    assert state(spark, root) == (10, "news 10\n", "meta 10\n")
    # a run may read the version that it replaces
    store.save(store.load(spark, root, "id string").where("id < 5"), root)
    assert state(spark, root)[0] == 5


def test_of_two_runs_one_publishes(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    store.save(*swap(run_of(spark, 10), root))
    write, other = store.Files.write, []

    def late(self, path, text):
        if not other:
            other.append(1)
            store.save(*swap(run_of(spark, 11), root))
        write(self, path, text)

    monkeypatch.setattr(store.Files, "write", late)
    with pytest.raises(store.Conflict):
        store.save(*swap(run_of(spark, 12), root))
    assert state(spark, root)[0] == 11


def test_damaged_and_half_written_stores_are_refused(spark, tmp_path):
    root = tmp_path / "s"
    store.save(*swap(run_of(spark, 10), str(root)))
    part = next(root.glob("versions/*/articles/part-*"))
    part.unlink()
    with pytest.raises(ValueError, match="damaged"):
        store.load(spark, str(root), "id string")
    spark.range(3).select(F.col("id").cast("string")).write.parquet(str(tmp_path / "old"))
    assert store.load(spark, str(tmp_path / "old"), "id string").count() == 3
    (tmp_path / "old" / "_SUCCESS").unlink()
    with pytest.raises(ValueError, match="half-written"):
        store.load(spark, str(tmp_path / "old"), "id string")
