import pytest

from strataloom.operators import ledger
from strataloom.sources import files, steps


def test_steps_fold_into_a_history(spark, tmp_path):
    log = f"{tmp_path}/ledger.jsonl"
    base = lambda p, n: {"run_id": "r", "project": p, "attempt": n}
    with steps.step(log, base("a", 1), "clone") as extra:
        extra["log"] = "clone.log"
    with pytest.raises(ValueError), steps.step(log, base("a", 1), "pipeline"):
        raise ValueError("no tokens")
    steps.finish(log, base("a", 1), "failed", "pipeline")
    steps.append_rows(log, [{**base("b", 1), "step": "clone", "status": "started"}])
    rows, torn = files.ledger(spark, log)
    assert torn.count() == 0
    got = {r["project"]: (r["state"], r["failures"], r["attempts"], r["last_failed_step"], r["interrupted"]) for r in ledger.histories(rows).collect()}
    assert got == {"a": ("failed", 1, 1, "pipeline", 0), "b": ("", 0, 1, "clone (interrupted)", 1)}
    ends = {r["step"]: r["exit_code"] for r in rows.where("status = 'ended'").collect()}
    assert ends == {"clone": 0, "pipeline": 1, "project": None}
    assert [r["project"] for r in ledger.audit(rows).where("status = 'interrupted'").collect()] == ["b"]
