import fcntl
import json

import pytest

from strataloom.operators import closure, scheduling as S
from strataloom.sources import files


def test_an_attempt_by_its_steps(tmp_path):
    ledger, said = str(tmp_path / "l.jsonl"), []
    ok = lambda n, r=True: (n, lambda: said.append(n) or r)
    run = lambda steps: S.attempt(ledger, {"project": "p", "run_id": "r", "attempt": 1}, str(tmp_path / "p"), steps, str(tmp_path / "stamp"))
    assert run([ok("clone"), ok("firm", False), ok("validate")]) == "failed" and said == ["clone", "firm"]
    assert run([ok("clone"), ("bad", lambda: 1 / 0)]) == "failed"
    assert run([ok("clone"), ok("validate")]) == "done"
    with open(tmp_path / "p" / "attempt.lock") as held:
        fcntl.flock(held, fcntl.LOCK_EX)
        assert run([ok("never")]) == "deferred"
    (tmp_path / "stamp").write_text("rows=1")
    assert run([ok("never")]) == "skipped" and "never" not in said
    rows = [json.loads(x) for x in open(ledger)]
    assert [(r["state"], r["failed_step"]) for r in rows if r["step"] == "project"] == [("failed", "firm"), ("failed", "bad"), ("done", ""), ("deferred", ""), ("skipped", "")]
    assert "ZeroDivisionError" in next(r for r in rows if r["step"] == "bad" and r["status"] == "ended")["detail"]


def test_logs_have_names_of_their_own(tmp_path):
    names = []
    for _ in range(3):
        names.append(S.log_name(str(tmp_path), "p-clone"))
        open(names[-1], "w").close()
    assert [n.rsplit("/", 1)[1] for n in names] == ["p-clone.log", "p-clone-2.log", "p-clone-3.log"]


def test_passes_retry_what_failed():
    tries = {}
    run = lambda p: tries.__setitem__(p, tries.get(p, 0) + 1) or ("done" if p == "a" or p == "b" and tries[p] == 2 else "failed")
    assert S.passes(["a", "b", "c"], run, 2, 2) == {"a": "done", "b": "done", "c": "failed"} and tries == {"a": 1, "b": 2, "c": 3}
    assert S.passes([], run, 2, 2) == {}


def test_a_census_skips_defers_retries_and_gives_up():
    work = [dict(project=p, decision=d, attempt=a, failures=f) for p, d, a, f in (("done", "skip", 2, 0), ("lost", "give-up", 4, 3), ("new", "run", 1, 0), ("busy", "post", 1, 0), ("bad", "run", 2, 1))]
    seen = []

    def run(job):
        seen.append((job.name, job.attempt, job.post, job.defers))
        if job.name == "bad":
            raise OSError
        return "deferred" if job.name == "busy" and job.defers < 2 else "done"

    assert S.census(work, run, retries=2, workers=1, poll=0.01) == {"done": "skipped", "lost": "failed", "new": "done", "busy": "done", "bad": "failed"}
    assert [x for x in seen if x[0] == "busy"] == [("busy", 1, True, n) for n in range(3)] and [x[1] for x in seen if x[0] == "bad"] == [2, 3]
    assert [x[0] for x in seen][:2] == ["new", "busy"]
    assert S.census(work, run, 2, 1, 0.01, may_start=lambda: False) == {"done": "skipped", "lost": "failed"}


def test_descendants_of_a_cycle(spark):
    pairs = spark.createDataFrame([(2, 1), (3, 2), (1, 3), (4, 3), (9, 8), (None, 1), (5, None), (4, 3)], "child int, parent int")
    of = lambda *ids: {r[0] for r in closure.descendants(pairs, spark.createDataFrame([(i,) for i in ids], "id int")).collect()}
    assert of(2) == {1, 2, 3, 4} and of(8) == {9} and of(4) == set() == of(None)


def test_settings(tmp_path):
    (tmp_path / "p.cfg").write_text("[run]\nworkers = 4\nmask = 100%%x\n")
    assert files.settings(str(tmp_path / "p.cfg"), "run", {"workers": "1", "mask": "", "poll": "15"}) == {"workers": "4", "mask": "100%%x", "poll": "15"}
    assert files.settings(str(tmp_path / "none.cfg"), "run", {"a": "b"}) == {"a": "b"}
    with pytest.raises(files.InputError, match="mask"):
        files.settings(str(tmp_path / "p.cfg"), "run", {"workers": "1"})
