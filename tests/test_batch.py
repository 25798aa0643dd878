"""The batch run end to end: a killed step, a restart, a torn record, other settings."""
import os

import pytest

from mixcast.plans import batch as B

SF = "/root/testdata/sf0.001"
QUICK = B.Settings(SF, profile="quick", regressors=("Linear Regression",), classifiers=("Logistic Regression",), folds=2,
                   grid={"maxIter": [2], "stepSize": [0.1], "maxDepth": [2]})
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _dying(steps, at, after=None):
    """The steps, of which the one named ``at`` dies once it has written what ``after`` leaves."""
    def die(run):
        if after is not None:
            out = after(run)
            for name, df in out.tables.items():
                df.limit(1).write.mode("overwrite").parquet(os.path.join(run.folder, at, name))
        raise KeyboardInterrupt(at)

    return [(n, die if n == at else f) for n, f in steps]


def test_killed_run_resumes_and_equals_an_undisturbed_one(spark, tmp_path, monkeypatch):
    for name in set(B.REPORTS) - {"describe", "top_roi"}:  # each report has a test of its own
        monkeypatch.delitem(B.REPORTS, name)
    root, steps = str(tmp_path), B.steps(QUICK)
    named = dict(steps)
    for at in ("prepare", "report regression"):
        with pytest.raises(KeyboardInterrupt):
            B.run_batch(spark, root, "a", QUICK, _dying(steps, at, named[at] if at == "prepare" else None))
    first = [n for n, _ in steps].index("report regression")
    before = {n: B.Run(spark, root, "a", QUICK).committed(n) for n, _ in steps[:first]}
    assert None not in before.values()
    resumed = B.run_batch(spark, root, "a", QUICK)
    assert resumed.executed == [n for n, _ in steps[first:]]  # nothing that was committed runs again
    assert {n: resumed.committed(n) for n in before} == before
    whole = B.run_batch(spark, root, "b", QUICK)
    assert whole.executed == [n for n, _ in steps]
    for name, _ in steps:
        tables = whole.committed(name)["tables"]
        assert resumed.committed(name)["tables"] == tables
        for t in tables:
            if t in ("run", "eco"):  # hold measured seconds
                continue
            a, b = resumed.table(name, t), whole.table(name, t)
            assert a.schema == b.schema and a.exceptAll(b).count() == 0, (name, t)
    assert resumed.fact("register", "best_reg_model") == whole.fact("register", "best_reg_model")
    registry = whole.table("register", "registry")
    assert sorted((r["task"], r["model"], r["tuned"]) for r in registry.collect()) == [
        ("classification", "Logistic Regression", False), ("regression", "Gradient Boosting", True),
        ("regression", "Linear Regression", False)]
    assert B.run_batch(spark, root, "b", QUICK).executed == []
    with pytest.raises(ValueError, match="folds"):
        B.Run(spark, root, "b", B.Settings(**{**vars(QUICK), "folds": 3}))


def test_torn_record_counts_as_none_and_training_rows_only(spark, tmp_path):
    path = str(tmp_path / "campaigns.csv")
    with open(path, "w") as f:
        f.write("TV,Radio,Social Media,Influencer,Sales\n")
        for i in range(300):
            f.write(f"{'' if i % 9 == 0 else i % 50},{i % 23},{i % 7},{['Mega', '', 'Nano'][i % 3]},{'' if i % 31 == 0 else i % 50 * 3 + i % 5}\n")
    settings = B.Settings(path, "csv", "train")
    run = B.run_batch(spark, str(tmp_path / "runs"), "r", settings, B.TABLE_STEPS[:2])
    assert run.committed("load")["tables"] == {"raw": 300} and run.committed("prepare")["tables"] == {"campaigns": 290}
    assert run.fact("prepare", "mode") in ("Mega", "Nano")
    record = os.path.join(run.folder, "_manifest", "prepare.json")
    text = open(record).read()
    for f in (record, os.path.join(run.folder, "_manifest", ".prepare.json.crc")):
        os.replace(f, f + ".old")
    with open(record, "w") as f:
        f.write(text[:40])
    again = B.run_batch(spark, str(tmp_path / "runs"), "r", settings, B.TABLE_STEPS[:2])
    assert again.executed == ["prepare"]
    assert again.committed("prepare")["facts"] == run.committed("prepare")["facts"]
    assert {r["step"]: r["rows"] for r in B.manifest_table(again, B.TABLE_STEPS[:2]).collect()} == {"load": 300, "prepare": 290}
