"""Attempts, passes and a census of projects: the decisions of a run, on the driver. What a step does is a function of its caller."""

from __future__ import annotations

import fcntl
import os
import time
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from pathlib import Path

from strataloom.operators.ledger import DONE, FAILED
from strataloom.operators.reports import deferral
from strataloom.sources.steps import finish, step

SKIPPED, DEFERRED = "skipped", "deferred"


def log_name(folder: str, name: str) -> str:
    """A path for a log in ``folder`` that isn't taken: ``name``.log, then ``name``-2.log and so on."""
    n = 1
    while (path := Path(folder) / f"{name}{'' if n == 1 else f'-{n}'}.log").exists():
        n += 1
    return str(path)


def chain(ledger: str, base: dict, steps: list[tuple[str, Callable[[], bool]]]) -> str:
    """Runs steps in order, each between its ledger rows, until one says no or raises; the name of that one, or ''."""
    for name, run in steps:
        try:
            with step(ledger, base, name) as extra:
                passed = bool(run())
                extra["exit_code"] = 0 if passed else 1
        except Exception:  # its row says what it was
            return name
        if not passed:
            return name
    return ""


def attempt(ledger: str, base: dict, folder: str, steps: list[tuple[str, Callable[[], bool]]], stamp: str) -> str:
    """One attempt at a project: DEFERRED if another holds its lock, SKIPPED if it is stamped, else DONE or FAILED by its steps; the final row is written whatever it is."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    with open(Path(folder) / "attempt.lock", "a") as lock:
        try:
            fcntl.flock(lock, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except BlockingIOError:
            finish(ledger, base, DEFERRED)
            return DEFERRED
        if os.path.exists(stamp):
            finish(ledger, base, SKIPPED)
            return SKIPPED
        failed = chain(ledger, base, steps)
        state = FAILED if failed else DONE
        finish(ledger, base, state, failed)
        return state


def passes(projects: list[str], run: Callable[[str], str], retries: int, workers: int) -> dict[str, str]:
    """Runs all projects, then those that failed again, ``retries`` times at most; name -> last outcome."""
    outcomes: dict[str, str] = {}
    left = list(projects)
    for _ in range(retries + 1):
        if not left:
            break
        with ThreadPoolExecutor(workers) as pool:
            outcomes |= dict(zip(left, pool.map(run, left)))
        left = [p for p in left if outcomes[p] == FAILED]
    return outcomes


@dataclass
class Job:
    """A project in the queue of a census."""

    pos: int
    name: str
    attempt: int
    failures: int
    post: bool
    defers: int = 0
    not_before: float = 0.0


def census(work: list[dict], run: Callable[[Job], str], retries: int, workers: int, poll: float, may_start: Callable[[], bool] = lambda: True, clock: Callable[[], float] = time.monotonic) -> dict[str, str]:
    """Runs the rows of ``reports.work`` (project, decision, attempt, failures) in their order, ``workers`` at once; name -> outcome.

    A deferred job waits, longer each time; a failed one goes to the end of the queue until it has failed more than ``retries``
    times. Nothing starts while ``may_start`` says no; if nothing runs then either, what is left is not run.
    """
    outcomes, queue = {}, []
    for pos, w in enumerate(work, 1):
        if w["decision"] in ("skip", "give-up"):
            outcomes[w["project"]] = SKIPPED if w["decision"] == "skip" else FAILED
        else:
            queue.append(Job(pos, w["project"], w["attempt"], w["failures"], w["decision"] == "post"))
    running: dict[Future, Job] = {}
    with ThreadPoolExecutor(workers) as pool:
        while queue or running:
            now, open_ = clock(), may_start()
            while open_ and len(running) < workers and (job := next((j for j in queue if j.not_before <= now), None)):
                queue.remove(job)
                running[pool.submit(run, job)] = job
                open_ = may_start()
            if not running and not open_:
                break
            done, _ = wait(running, timeout=poll, return_when=FIRST_COMPLETED) if running else (set(), time.sleep(poll))
            for f in done:
                job = running.pop(f)
                state = FAILED if f.exception() else f.result()
                outcomes[job.name] = state
                if state == DEFERRED:
                    job.not_before, job.defers = clock() + deferral(job.defers, poll), job.defers + 1
                    queue.append(job)
                elif state == FAILED:
                    job.failures, job.attempt = job.failures + 1, job.attempt + 1
                    if job.failures <= retries:
                        queue.append(job)
    return outcomes
