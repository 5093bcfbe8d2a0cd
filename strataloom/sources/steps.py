"""Steps bracketed by ledger rows: one when a step starts, one when it ends, whatever ends it."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

from strataloom.sources.sinks import append_rows, append_tsv


def _now() -> str:
    return datetime.now(UTC).isoformat(timespec="seconds")


@contextmanager
def step(ledger: str, base: dict, name: str) -> Iterator[dict]:
    """Appends the rows of one step of an attempt to ``ledger``; ``base`` has what all its rows carry (run_id, project, attempt ...).

    What the body puts into the yielded dict goes into the end row. An exception makes exit_code 1 with its text as detail, and
    goes on. A process that dies leaves the start row alone: the audit shows it as interrupted.
    """
    began, extra = time.monotonic(), {}
    start = {**base, "step": name, "status": "started", "start_utc": _now()}
    append_rows(ledger, [start])
    end = {"status": "ended", "exit_code": 0}
    try:
        yield extra
    except BaseException as e:
        end |= {"exit_code": 1, "detail": f"{type(e).__name__}: {e}"}
        raise
    finally:
        append_rows(ledger, [{**start, **end, **extra, "end_utc": _now(), "duration_s": round(time.monotonic() - began, 3)}])


def finish(ledger: str, base: dict, state: str, failed_step: str = "") -> None:
    """Appends an attempt's final row."""
    append_rows(ledger, [{**base, "step": "project", "status": "ended", "state": state, "failed_step": failed_step, "end_utc": _now()}])


@contextmanager
def run(ledger: str, runs_log: str, run_id: str, command: str, flags: dict, tools: dict[str, str]) -> Iterator[dict[str, int]]:
    """Brackets a whole run: a run-start and a run-end row in ``ledger`` with what it was called with, and a start and an end line in ``runs_log``.

    The body counts outcomes in the yielded dict; they go into the end row. An exception is the stop reason of the run, and goes on.
    """
    base = {"run_id": run_id, "command": command, "tools": tools, "flags": flags}
    header = ["utc", "run_id", "event", "command", "exit_code"]
    append_rows(ledger, [{**base, "step": "run-start", "status": "started", "start_utc": _now()}])
    append_tsv(runs_log, header, [_now(), run_id, "start", command, ""])
    outcomes: dict[str, int] = {}
    code, reason = 0, ""
    try:
        yield outcomes
        code = int(bool(outcomes.get("failed")))
    except BaseException as e:
        code, reason = 1, f"{type(e).__name__}: {e}"
        raise
    finally:
        append_rows(ledger, [{**base, "step": "run-end", "status": "ended", "exit_code": code, "outcomes": outcomes, "stop_reason": reason, "end_utc": _now()}])
        append_tsv(runs_log, header, [_now(), run_id, "end", command, code])
