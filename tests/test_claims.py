from concurrent.futures import ThreadPoolExecutor

import pytest

from blockloom.operators import ranges
from blockloom.plans import archiving
from blockloom.session import scratch_path
from blockloom.sources import archive, claims, ledgers

from test_archive import cells, stored_slots


@pytest.fixture
def shared(spark):
    """A plan of ten ranges, and a job that works on it."""
    root, ledger, folder = (scratch_path(spark, name) for name in ("archive", "ledger", "claims"))
    plan = ranges.split_key_range(spark, 0, 999, 100)

    def job(**options):
        options = {"waves": 5, "lease": 600, "poll": 0.2, **options}
        archiving.archive_shared(spark, cells(spark, 1000), plan, 100, root, ledger, "sync", "blocks", folder, **options)

    def once(**options):
        archiving.archive_ranges(spark, cells(spark, 1000), plan, 100, root, ledger, "sync", "blocks", claims=folder, waves=5, **options)

    return root, ledger, job, once


def records(spark, ledger):
    return sorted(r["start_key"] for r in spark.read.parquet(ledger).where("status = 'done'").collect())


def test_a_piece_has_one_holder(spark):
    folder = scratch_path(spark, "claims")
    with ThreadPoolExecutor(6) as pool:
        got = [c for c in pool.map(lambda _: claims.take(spark, folder, "a", 600), range(6)) if c]
    assert len(got) == 1 and claims.is_held(spark, got[0])
    assert claims.take(spark, folder, "b", 600)
    claims.give_back(spark, got[0])
    assert not claims.is_held(spark, got[0])
    assert claims.take(spark, folder, "a", 600).number == 2


def test_a_claim_runs_out(spark):
    folder = scratch_path(spark, "claims")
    first = claims.take(spark, folder, "a", 0)
    second = claims.take(spark, folder, "a", 600)
    assert second.number == 1 and not claims.is_held(spark, first) and claims.is_held(spark, second)
    claims.give_back(spark, first)  # too late: it has another holder
    assert claims.is_held(spark, second)


def test_two_jobs_do_each_range_once(spark, shared, monkeypatch):
    root, ledger, job, _ = shared
    written, write = [], archive.write_archive_beside
    monkeypatch.setattr(archive, "write_archive_beside", lambda rows, *args: (written.append(1), write(rows, *args))[1])
    with ThreadPoolExecutor(2) as pool:
        [done.result() for done in [pool.submit(job), pool.submit(job)]]
    assert stored_slots(spark, root) == list(range(1000))
    assert len(records(spark, ledger)) == len(set(records(spark, ledger))) == 10 and len(written) == 5


def test_the_work_of_a_dead_job_is_taken_over(spark, shared, monkeypatch):
    root, ledger, job, once = shared
    mark, calls = ledgers.mark_ranges, []

    def dies(*args):
        calls.append(1)
        if len(calls) == 2:
            raise KeyboardInterrupt
        mark(*args)

    monkeypatch.setattr(ledgers, "mark_ranges", dies)
    with pytest.raises(KeyboardInterrupt):
        once(lease=3)  # has written two waves, recorded one, and holds the second for a while
    monkeypatch.undo()
    once()
    assert len(records(spark, ledger)) >= 8
    job()
    assert len(records(spark, ledger)) == 10 and stored_slots(spark, root) == list(range(1000))


def test_a_late_job_does_not_record(spark, shared, monkeypatch):
    root, ledger, job, once = shared
    write = archive.write_archive_beside
    taken_over = []

    def slow(rows, *args):
        write(rows, *args)
        if not taken_over:
            taken_over.append(1)
            job()  # meanwhile another one finds the claim run out, and does all

    monkeypatch.setattr(archive, "write_archive_beside", slow)
    once(lease=0)
    assert len(records(spark, ledger)) == len(set(records(spark, ledger))) == 10
    assert stored_slots(spark, root) == list(range(1000))


def test_a_failed_wave_is_free_for_others(spark, shared, monkeypatch):
    root, ledger, job, once = shared
    monkeypatch.setattr(archive, "write_archive_beside", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        once()
    monkeypatch.undo()
    job()
    assert len(records(spark, ledger)) == 10 and stored_slots(spark, root) == list(range(1000))
