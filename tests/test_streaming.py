from strataloom.sources.sinks import append_rows
from strataloom.streaming import ledgers


def test_counts_go_on_where_they_stopped(spark, tmp_path):
    folder, out, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "out", "checkpoint"))
    (tmp_path / "in").mkdir()
    row = lambda p, state, step="project", status="ended": {"project": p, "step": step, "status": status, "state": state}
    append_rows(f"{folder}/1.jsonl", [row("a", "failed"), row("a", "done"), row("b", "skipped"), row("a", None, status="started"), row(None, "done")])
    ledgers.catch_up(ledgers.outcomes(ledgers.follow(spark, folder)), out, checkpoint)
    assert {tuple(r) for r in spark.read.parquet(out).collect()} == {("a", "failed", 1), ("a", "done", 1)}
    append_rows(f"{folder}/2.jsonl", [row("a", "done"), row("c", "done")])
    ledgers.catch_up(ledgers.outcomes(ledgers.follow(spark, folder)), out, checkpoint)
    assert {tuple(r) for r in spark.read.parquet(out).collect()} == {("a", "failed", 1), ("a", "done", 2), ("c", "done", 1)}
