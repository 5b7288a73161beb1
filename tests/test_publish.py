"""Results appear as a whole, or not at all."""

import os

import pytest

from pricenet.operators import feeds
from pricenet.plans import job, publish
from pricenet.plans.report import REPORT_FILE


def _tables(spark, value):
    return {"final_rankings": spark.createDataFrame([(1996, "x", value)], "year int, city string, score_equal double"),
            "network_evolution": spark.createDataFrame([(1996, value)], "year int, density double")}


def _values(spark, out):
    return [publish.read_published(spark, out, name).first()[at]
            for name, at in (("final_rankings", "score_equal"), ("network_evolution", "density"))]


def test_nothing_published(spark, tmpdir_path):
    assert publish.published_folder(spark, tmpdir_path) is None
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, tmpdir_path, "final_rankings")


def test_a_killed_run_leaves_the_old_result(spark, tmpdir_path, monkeypatch):
    first = publish.publish_results(_tables(spark, 1.0), "one", spark, tmpdir_path)
    assert _values(spark, tmpdir_path) == [1.0, 1.0]
    with monkeypatch.context() as m:  # both tables are written, the report is not
        m.setattr(publish, "save_report", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            publish.publish_results(_tables(spark, 2.0), "two", spark, tmpdir_path)
    assert publish.published_folder(spark, tmpdir_path) == first and _values(spark, tmpdir_path) == [1.0, 1.0]
    with open(os.path.join(first, REPORT_FILE)) as f:
        assert f.read() == "one"
    old = publish.read_published(spark, tmpdir_path, "final_rankings")
    third = publish.publish_results(_tables(spark, 3.0), "three", spark, tmpdir_path)
    assert publish.published_folder(spark, tmpdir_path) == third and _values(spark, tmpdir_path) == [3.0, 3.0]
    assert old.first().score_equal == 1.0  # a reader of the replaced run still finds its files
    fourth = publish.publish_results(_tables(spark, 4.0), "four", spark, tmpdir_path)
    kept = {os.path.basename(third), os.path.basename(fourth)}
    assert set(os.listdir(os.path.join(tmpdir_path, "runs"))) == kept  # the dead run is gone as well
    with pytest.raises(ValueError):
        publish.publish_results({}, None, spark, tmpdir_path, keep=0)


def test_failed_steps_publish_nothing(spark, tmpdir_path, monkeypatch):
    obs = spark.createDataFrame(
        [(c, 2024, "Food", f"2024-0{m}", "rice", float(m + k)) for k, c in enumerate("ABC") for m in (1, 2, 3)],
        "city string, year int, category string, month_year string, item_description string, normalized_price double")
    res = job.run_full_analysis(obs, list("ABC"), tau=0.2, output_dir=tmpdir_path, publish=True)
    assert res["failed"] == [] and res["published"] == publish.published_folder(spark, tmpdir_path)
    assert publish.read_published(spark, tmpdir_path, "final_rankings").count() == 3
    monkeypatch.setattr(job, "render_markdown", lambda *a: 1 / 0)
    res = job.run_full_analysis(obs, list("ABC"), tau=0.9, output_dir=tmpdir_path, publish=True)
    assert res["failed"] == ["report"] and "published" not in res
    assert len(os.listdir(os.path.join(tmpdir_path, "runs"))) == 1


def test_overview_counts_without_expand(spark):
    obs = spark.createDataFrame([("A", 2024, "Food"), ("A", 2024, "Food"), (None, 2025, "Food"), ("B", None, "Fuel")],
                                "city string, year int, category string")
    got = feeds.overview_counts(obs, 0.5)
    assert tuple(got.first()) == (2, 2, 2, 0.5)
    assert "Expand" not in got._jdf.queryExecution().executedPlan().toString()
    assert tuple(feeds.overview_counts(obs.where("false"), 0.5).first()) == (0, 0, 0, 0.5)
