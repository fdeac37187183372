"""The end-to-end run: resumed after a stop, published as a whole."""
import os
import shutil

import pytest

from shelfwise.plans import run as R
from tests.conftest import SF_SMALL


def test_run_resumes_and_publishes(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}/run"
    stop = [(s, (lambda p: (_ for _ in ()).throw(KeyboardInterrupt())) if s == "transfers" else f, m) for s, f, m in R.STAGES if s != "model_metrics"]
    monkeypatch.setattr(R, "STAGES", tuple(stop))
    with pytest.raises(KeyboardInterrupt):
        R.run(spark, SF_SMALL, folder)
    assert R.published(spark, folder) == []  # nothing to see of a run that was stopped
    monkeypatch.undo()
    monkeypatch.setattr(R, "STAGES", tuple(s for s in R.STAGES if s[0] != "model_metrics"))
    manifest, computed = R.run(spark, SF_SMALL, folder)
    assert computed == ["transfers", "joint", "backtest"]
    first = {r.stage: r for r in manifest.collect()}
    assert all(r.rows == R.read_stage(spark, R.published(spark, folder)[0], s).count() for s, r in first.items())
    # a table that was not finished is made again, the others are kept
    key = R.fingerprint(spark, SF_SMALL, R.DEFAULT_SCENARIO)
    os.remove(f"{tmp_path}/run/tables/joint-{key}/_SUCCESS")
    again, computed = R.run(spark, SF_SMALL, folder)
    assert computed == ["joint"] and {r.stage: (r.rows, r.checksum) for r in again.collect()} == {s: (r.rows, r.checksum) for s, r in first.items()}
    # other inputs, other tables
    shutil.copytree(SF_SMALL, f"{tmp_path}/in")
    assert R.fingerprint(spark, f"file://{tmp_path}/in", R.DEFAULT_SCENARIO) != key
