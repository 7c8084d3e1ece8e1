import contextlib
import io
import json
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyflow.operators import l1_path
from tallyflow.plans import ablation, clicks, flatten, installs, rates, separation
from tallyflow.sources import readers, schemas, sinks

START, END = date(2024, 1, 1), date(2024, 2, 1)


def event(kind, minute, message="m1", **payload):
    body = {"istest": False, "deviceid": "d1", "daysfromeulaapproval": 5, "timestamp": f"2024-01-02 10:{minute:02d}:00", "messageid": message, **payload}
    body = {k: v for k, v in body.items() if v is not None}
    return ("contentitem_" + kind, datetime(2024, 1, 2, 10, minute), 2024, message, json.dumps({"properties": body}))


def log(spark, rows):
    return spark.createDataFrame(rows, "event string, time timestamp_ntz, year int, messageid string, properties string")


LOG = [
    event("sent", 1, itemsubject="a,b", segments_attribute=["x", "y"], appbadgecount=3),
    event("sent", 0, word_count=1),
    event("sent", 2, message="m2", istest=True),
    event("sent", 2, message="m3", daysfromeulaapproval=None),
    event("sent", 2, message="None"),
    event("received", 3, agentlocale="en", devicelocale="fr"),
    event("received", 4, message="None"),
    event("view", 5), event("view", 6),
    event("timeonpage", 6, timeonpage=2.675), event("timeonpage", 5, timeonpage="1.5"),
    event("pagescroll", 6, scrolldepth=25), event("pagescroll", 7, scrolldepth="75.0"),
    event("click", 8, actionid="share"), event("click", 8, actionid="share"), event("click", 7, actionid="feedbackmodule", feedbackvalue=True),
    event("dismiss", 9, message="orphan"),
]


def test_flatten_one_plan_equals_the_joins(spark):
    events = log(spark, LOG)
    one = flatten.flatten_events(events, START, END)
    two = flatten.flatten_by_joins(events, START, END)
    assert sorted(map(str, one.select(sorted(one.columns)).collect())) == sorted(map(str, two.select(sorted(one.columns)).collect()))
    rows = {r["message_id"]: r for r in one.collect()}
    assert set(rows) == {"m1", "None"}
    m1 = rows["m1"]
    # the earliest duplicate wins; missing fields take their defaults
    assert m1["app_badge_count"] == 0 and m1["notification_loading_method"] == "fullappinitialization"
    assert (m1["received"], m1["view"], m1["dismiss"]) == (1, 1, 0)
    assert m1["dismiss_timestamp"] is None and m1["time_on_page"] == 1.5 and m1["scroll_depth"] == 75
    assert [a["action"] for a in m1["actions"]] == ["feedbackmodule", "share", "share"]
    # a literal key "None" is a key like any other
    assert rows["None"]["received"] == 1 and rows["None"]["actions"] is None


def test_a_message_with_very_many_clicks_is_one_row(spark):
    rows = [event("sent", 0)] + [event("click", i % 50, actionid=f"a{i % 7}") for i in range(500)]
    events = log(spark, rows)
    many = events.where("event like '%sent'").unionByName(events.where("event like '%click'").crossJoin(spark.range(200)).drop("id"))
    out = flatten.flatten_events(many, START, END).collect()
    assert [len(r["actions"]) for r in out] == [100_000]
    stamps = [a["timestamp"] for a in out[0]["actions"]]
    assert stamps == sorted(stamps)
    assert flatten.click_rows(flatten.parse_log(many, START, END)).agg({"repeats": "sum"}).first()[0] == 100_000


def test_the_log_is_read_once(spark):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        flatten.flatten_events(log(spark, LOG), START, END).explain()
    assert len(re.findall(r"Scan ExistingRDD", text.getvalue())) == 1


def test_late_facets_are_merged_into_older_days(spark, tmp_path):
    def at(day, row):
        return (*row[:1], row[1] + timedelta(days=day), *row[2:])

    first = [event("sent", 0, "a"), event("received", 1, "a"), event("click", 2, "a", actionid="x"), event("view", 3, "b"), event("sent", 4, "c")]
    second = [event("sent", 0, "b"), event("timeonpage", 1, "a", timeonpage="7"), event("click", 2, "a", actionid="x"), event("click", 1, "a", actionid="y"), event("sent", 9, "c")]
    days = [log(spark, [at(0, r) for r in first]), log(spark, [at(1, r) for r in second])]
    start = days[0].agg({"time": "min"}).first()[0].date()
    path, both = str(tmp_path / "days"), days[0].unionByName(days[1])
    for n in (0, 1, 1):  # the last run is repeated
        flat = flatten.update_days(days[n], path, start + timedelta(days=n), start + timedelta(days=n), delay_days=1)
    want = flatten.flatten_events(both, start, start + timedelta(days=2))
    names = [c for c in want.columns if c != "sent_day"]
    assert sorted(map(str, flat.select(names).collect())) == sorted(map(str, want.select(names).collect()))
    rows = {r["message_id"]: r for r in flat.collect()}
    assert [x["action"] for x in rows["a"]["actions"]] == ["x", "y", "x"] or len(rows["a"]["actions"]) == 3
    assert rows["a"]["time_on_page"] == 7.0 and rows["b"]["view"] == 1 and len(rows) == 3
    assert rows["a"]["sent_day"] == start and rows["b"]["sent_day"] == start + timedelta(days=1)


def test_increment_goes_on_after_the_newest_day(spark, tmp_path):
    events, path = log(spark, LOG), str(tmp_path / "flat")
    with pytest.raises(ValueError):
        flatten.flatten_increment(events, path, END)
    assert flatten.flatten_increment(events, path, END, START) == (START, END - timedelta(days=1))
    one = flatten.flatten_events(events, START, END)
    written = spark.read.schema(one.schema).parquet(path)
    assert written.count() == one.where(F.col("date") < str(END)).count() > 0
    newest = date.fromisoformat(written.agg({"date": "max"}).first()[0])
    assert flatten.flatten_increment(events, path, newest + timedelta(days=1)) is None


def test_flatten_plan_has_no_python_and_no_cartesian(spark):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        flatten.flatten_events(log(spark, LOG), START, END).explain()
    for word in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text.getvalue()


def daily(spark):
    rows = [(f"a{i % 2}", f"b{i % 14}", date(2024, 1, 1 + i % 3), 10 + i, i % 9) for i in range(140)]
    return spark.createDataFrame(rows, "a string, b string, receive_date date, trial long, success long")


def test_rate_model_levels_and_lookup(spark):
    smooth = rates.smoothed(daily(spark), 0.1)
    model = rates.rate_model(smooth, ["a", "b"], min_trials=50).collect()
    by_level = {lv: [r for r in model if r["level"] == lv] for lv in (0, 1, 2)}
    root = by_level[0][0]
    assert root["probability"] == pytest.approx(root["success_smooth"] / root["trial_smooth"])
    # two level-1 children are too few for a prior, so the level is left out and lookups fall back
    assert by_level[1] == [] and len(by_level[2]) == 14
    table = spark.createDataFrame(model, rates.rate_model(smooth, ["a", "b"], min_trials=50).schema)
    probe = spark.createDataFrame([("a0", "b0"), ("a0", "zz"), (None, "b0"), ("a0", None)], "a string, b string")
    got = [r["probability"] for r in rates.with_probability(probe, table, ["a", "b"]).collect()]
    leaf = [r["probability"] for r in by_level[2] if (r["a"], r["b"]) == ("a0", "b0")][0]
    assert sorted(got) == sorted([leaf] + [root["probability"]] * 3)


def test_separation_against_brute_force(spark):
    rows = [(u, f"d{(u * k) % 5}", float((u * 7 + k * 3) % 10)) for u in range(25) for k in range(1, 7)]
    df = spark.createDataFrame(rows, "device_id int, message_type string, m double")
    data = separation.with_percentiles(df, ["m"])
    med = {r["message_type"]: r["median_m"] for r in data.collect()}
    docs = sorted(med)
    likes = {(u, d): any(r[0] == u and r[1] == d and r[2] > med[d] for r in rows) for u in range(25) for d in docs}
    want = {}
    for i, d1 in enumerate(docs):
        for d2 in docs[i + 1 :]:
            for u in range(25):
                if likes[u, d1] == likes[u, d2]:
                    continue
                g = 1 if likes[u, d1] else 2
                for r in rows:
                    if r[0] == u and r[1] not in (d1, d2):
                        n, e = want.get((d1, d2, g, r[1]), (0, 0))
                        want[d1, d2, g, r[1]] = (n + 1, e + (r[2] > med[r[1]]))
    got = {(r["d1"], r["d2"], r["group_no"], r["message_type"]): (r["count"], r["sum"]) for r in separation.separation_test(data, "m").collect()}
    assert got == want
    with pytest.raises(Exception, match="more than 3 documents"):
        separation.separation_test(data, "m", max_documents=3).collect()


def test_device_names_skip_bad_elements(spark):
    schema = "deviceId string, packages array<struct<package:string,category:string>>"
    df = spark.createDataFrame([("d", [("a.vpl", "Food &amp; Fun"), ("b", None), (None, "x_y_z"), ("c", "x_e_z")])], schema)
    assert {r["name"] for r in installs.device_names(df, "apps").collect()} == {"b", "c"}
    assert [r["name"] for r in installs.device_names(df, "categories").collect()] == ["food_and_fun", "x_and_z", "x_and_z"]


def test_schema_rules(spark):
    schema = schemas.schema_from_example({"b": 1, "a": {"z": "s", "y": [1.0]}, "c": True})
    assert schema.simpleString() == "struct<a:struct<y:array<double>,z:string>,b:bigint,c:boolean>"
    with pytest.raises(ValueError):
        schemas.schema_from_example({"a": []})
    with pytest.raises(TypeError):
        schemas.conform(spark.createDataFrame([(True,)], "b boolean"), schema)
    wide = schemas.conform(spark.createDataFrame([(1, 2)], "n int, extra int"), schemas.schema_from_example({"n": 1.0}))
    assert wide.collect() == [(1.0,)]


def test_incremental_window_pushes_equal_bounds(spark):
    day = F.lit(date(2024, 1, 5))
    first, last = readers.incremental_window(day, F.lit(date(2024, 1, 7)))
    row = spark.range(1).select(first, last).first()
    assert (row[0], row[1]) == (date(2024, 1, 6), date(2024, 1, 7))


def test_partitioned_rewrite_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "days")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "v int, date string")
    sinks.write_partitioned(df, path)
    sinks.write_partitioned(df.where("v = 2").withColumn("v", F.lit(9)), path, mode="overwrite")
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 9]


def test_click_preparation_fills_and_joins(spark):
    spec = clicks.ClickSpec(["c"], {"cd": ["c", "d"]}, ["b"], ["h"])
    df = spark.createDataFrame([("x", None, "n", 0, 1, 2), (None, "q", "y", 1, 0, 3)], "c string, d string, b string, h int, clicks int, impressions int")
    rows = clicks.prepare(df, spec).orderBy("impressions").collect()
    assert [(r["c"], r["cd"], r["b"]) for r in rows] == [(1, 1, 0), (0, 0, 1)]
    assert rows[1]["h_cos"] == pytest.approx(-1.0)


def test_ablation_runs_two_variants(spark):
    people = spark.createDataFrame([(i, f"c{i % 2}", f"m{i % 3}", "v", int(i % 4 == 0)) for i in range(80)],
                                   "dev int, carrier_name string, device_model string, device_vendor string, y int")
    apps = [(i, f"com.app{j}") for i in range(80) for j in range(6) if (i + j) % 3 == 0 or (i % 4 == 0 and j == 0)]
    out = ablation.ablation(spark.createDataFrame(apps, "dev int, app string"), people, "dev", "y", variants=ablation.VARIANTS[:2],
                            fit=lambda rows, size: l1_path.searched_path(rows, size, points=3, folds=2), folds=2, min_devices=5, cutoff=0.99)
    rows = out.collect()
    assert len(rows) == 2 and all(0 < r["average_precision"] <= 1 and 0 <= r["kept"] <= r["features"] for r in rows)


def test_ablation_without_any_feature_is_the_intercept_alone(spark):
    people = spark.createDataFrame([(i, f"c{i % 2}", f"m{i % 3}", "v", int(i % 4 == 0)) for i in range(80)],
                                   "dev int, carrier_name string, device_model string, device_vendor string, y int")
    apps = spark.createDataFrame([(i, "com.app") for i in range(80)], "dev int, app string")
    only = ablation.Variant("common apps only", common_apps=True, models=False)
    row = ablation.ablation(apps, people, "dev", "y", variants=[only], folds=2, min_devices=5, cutoff=0.99,
                            fit=lambda rows, size: l1_path.searched_path(rows, size, points=3, folds=2)).first()
    assert (row["features"], row["kept"], row["point"]) == (0, 0, 0)
    assert row["average_precision"] == pytest.approx(0.25) and row["train_precision"] == pytest.approx(0.25)
