from collections import Counter
from datetime import datetime, timedelta

from tallyflow.plans import alerts


def test_runs_and_buckets_of_alerts(spark):
    start = datetime(2024, 1, 1, 10)
    rows = [(start + timedelta(minutes=7 * k), f"{'web' if k % 3 else 'database'}{k % 5}.host", ("cpu load", "disk is full")[k % 2]) for k in range(60)]
    table = spark.createDataFrame(rows, "time timestamp_ntz, host string, type string")
    first = {}
    for t, host, kind in rows:
        name = "".join(c for c in host if not c.isdigit()) + "_" + kind
        key = (t.date(), t.hour, name)
        first[key] = min(t, first.get(key, t))
    names = [name for (day, hour, name), t in sorted(first.items(), key=lambda e: (e[0][0], e[0][1], e[1], e[0][2]))]
    want = Counter(" > ".join(names[k : k + 6]) for k in range(len(names) - 5))
    got = {r["gram"]: r["cnt"] for r in alerts.frequent_runs(table, k=1000).collect()}
    assert got == dict(want)
    out = alerts.bucketed(table).collect()
    assert len(out) == len(rows)
    # names that are far apart have buckets of their own
    for column, source in (("host_cluster_id", "host_no_numbers"), ("alert_cluster_id", "type"), ("combined_cluster_id", "host_type_combined")):
        pairs = {(r[source], r[column]) for r in out}
        assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
