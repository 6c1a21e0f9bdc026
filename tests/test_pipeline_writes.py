from __future__ import annotations

from strata.plans.queries import QUERIES
from strata.sources import publish
from tests.conftest import SMALL


def test_silver_is_published_from_where_its_increment_was_written(spark, monkeypatch):
    written, stage = [], publish.stage

    def noted(df, path, *rest):
        written.append(path)
        stage(df, path, *rest)

    monkeypatch.setattr(publish, "stage", noted)
    assert QUERIES["q_pipeline_late"](spark, SMALL).count() == 31
    assert len(written) == 6  # fact and daily summary of three runs
    assert [path for path in written if "/silver_staging/" in path] == []
