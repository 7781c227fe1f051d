"""Landing of drops: late rows, repeats, restarts."""

import datetime as dt
import glob
import os

import pytest

from ledgerflow.session import scratch_path
from ledgerflow.streaming import landing as L

SCHEMA = "k long, ts timestamp, v double"


def day(n):
    return None if n is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


@pytest.fixture
def place(spark):
    base = scratch_path(spark, "stream")

    def drop(*rows):
        spark.createDataFrame([(k, day(d), v) for k, d, v in rows], SCHEMA).coalesce(1).write.mode("append").csv(f"{base}/in")

    def run(**kw):
        return L.land_files(spark, f"{base}/in", SCHEMA, f"{base}/table", f"{base}/state", "ts", ["k"], **kw)

    def rows():
        return sorted(((r.k, r.v) for r in L.landed(spark, f"{base}/table").collect()), key=str)

    return base, drop, run, rows


def test_late_and_repeated_rows_stay_out(place):
    _, drop, run, rows = place
    drop((1, 0, 1.0), (2, 1, 2.0), (2, 1, 2.0), (9, None, 1.0), (None, 1, 7.0), (None, 1, 7.0))
    assert run() == L.Landed(1, 6, 0, 2)
    drop((3, 20, 3.0), (2, 1, 2.0), (9, None, 1.0))
    assert run() == L.Landed(1, 3, 0, 1)
    drop((4, 14, 4.0), (5, 13, 5.0), (6, 5, 6.0), (3, 20, 3.5))     # the watermark is at day 13: what lies on it is late too
    assert run() == L.Landed(1, 4, 2, 1)
    assert run() == L.Landed(0, 0, 0, 0)                            # nothing new, nothing done
    assert rows() == sorted([(1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0), (9, 1.0), (9, 1.0), (None, 7.0)], key=str)


def test_a_run_that_broke_off_is_finished_once(place):
    base, drop, run, rows = place
    drop((1, 0, 1.0), (2, 1, 2.0))
    run()
    drop((3, 2, 3.0), (1, 0, 1.0))
    run()
    want = rows()
    commits = sorted((f for f in glob.glob(f"{base}/state/commits/*") if os.path.basename(f).isdigit()), key=lambda f: int(os.path.basename(f)))
    for f in commits[-2:]:                                          # written, but the driver died before it said so
        os.remove(f)
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    drop((4, 3, 4.0), (3, 2, 3.0))
    run()
    assert rows() == sorted([*want, (4, 4.0)])


def test_many_small_batches_equal_one(spark, place):
    base, drop, run, rows = place
    for n in range(5):
        drop((n, n, float(n)), (n + 1, n + 1, float(n + 1)))
    assert run(files_per_batch=1, partition_by=["v"]).batches == 5
    assert rows() == [(n, float(n)) for n in range(6)]
    totals = L.daily_totals(L.landed(spark, f"{base}/table"), "ts", "k").orderBy("day").collect()
    assert [(r.day, r.rows, r.total) for r in totals] == [(day(n).date(), 1, n) for n in range(6)]
