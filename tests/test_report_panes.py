"""The access log reports from panes: an event is held once, and is in both of its windows."""

from __future__ import annotations

from collections import defaultdict
from datetime import datetime, timedelta

from tallyforge.streaming import jobs


def test_reports_of_panes(spark):
    begin = datetime(2024, 1, 31, 23, 59, 45)
    events = [
        (begin + timedelta(seconds=s), f"10.0.0.{s % 2}", f"/e/{s % 3}", 200 + s % 2, None if s % 5 == 0 else 10 * s)
        for s in (0, 1, 4, 5, 14, 15, 16, 40, 70, 71, 71)
    ]
    logs = spark.createDataFrame(
        events, "ts timestamp, ip_address string, endpoint string, response_code int, content_size long"
    )
    panes = jobs.pane_measures(logs)
    assert sum(r.requests for r in panes.collect()) == len(events)
    held = defaultdict(list)
    for ts, *rest in events:
        pane = ts - timedelta(seconds=ts.second % 10)
        for start in (pane - timedelta(seconds=10), pane):
            held[start, start + timedelta(seconds=20)].append(rest)
    reports = jobs.window_reports(jobs.window_measures(panes))
    found = {(r.start, r.end): (r.avg_size, r.min_size, r.max_size) for r in reports["content"].collect()}
    expected = {}
    for window, rows in held.items():
        sizes = [r[3] for r in rows if r[3] is not None]
        expected[window] = (sum(sizes) // len(rows), min(sizes), max(sizes)) if sizes else (None, None, None)
    assert found == expected
    for name, place in (("status", 2), ("endpoints", 1)):
        counts = defaultdict(int)
        for window, rows in held.items():
            for row in rows:
                counts[(*window, row[place])] += 1
        column = "response_code" if name == "status" else "endpoint"
        assert {(r.start, r.end, r[column]): r.total for r in reports[name].collect()} == counts
