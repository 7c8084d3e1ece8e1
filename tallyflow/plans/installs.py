"""Installed-app features per device, in long form; pivots only with declared columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.functions.text import normal_name
from tallyflow.operators.cleaning import above_threshold, first_per_key
from tallyflow.operators.ordering import in_blocks
from tallyflow.sources.schemas import parse_json

DIMENSIONS = {"apps": "package", "categories": "category"}


def device_names(devices: DataFrame, dimension: str) -> DataFrame:
    """(deviceId, name, 1) per package or category; unusable elements are skipped.

    Virtual preloads (``.vpl``) are no apps.
    """
    field = DIMENSIONS[dimension]
    named = F.filter(F.transform("packages", lambda p: normal_name(p[field])), lambda n: n.isNotNull())
    rows = devices.select("deviceId", F.explode(named).alias("name"), F.lit(1).alias("value"))
    return rows.where(~F.col("name").endswith(".vpl")) if dimension == "apps" else rows


def frequent_names(rows: DataFrame, threshold: int) -> DataFrame:
    """Rows whose name occurs more than ``threshold`` times over all devices."""
    return above_threshold(rows, "name", threshold)


def name_totals(rows: DataFrame, binary: bool = False) -> DataFrame:
    """(deviceId, name, value) summed, or 1 for presence; the long form of the pivots."""
    total = F.max("value") if binary else F.sum("value")
    return rows.groupBy("deviceId", "name").agg(total.alias("value"))


def pivot_names(rows: DataFrame, names: Sequence[str], binary: bool = False, key: str = "deviceId") -> DataFrame:
    """One 0-filled column per declared name.

    A key moves as the map of the names that it has, and is widened afterwards, row by row.
    """
    total = F.max("value") if binary else F.sum("value")
    totals = rows.groupBy(key, "name").agg(total.alias("value"))
    known = F.when(F.col("name").isin(*names), F.struct("name", "value"))
    maps = totals.groupBy(key).agg(F.map_from_entries(F.collect_list(known)).alias("_values"))
    return maps.select(key, *[F.element_at("_values", F.lit(n)).alias(n) for n in names]).na.fill(0)


def declared_names(rows: DataFrame, limit: int = 10_000) -> list[str]:
    """The distinct names for a pivot; more than ``limit`` is an error, use the long form then."""
    found = [r[0] for r in rows.select("name").distinct().orderBy("name").limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"more than {limit} names: keep the long form")
    return found


def _android(events: DataFrame, kind: str, schema: str) -> DataFrame:
    p = parse_json(F.col("properties"), f"properties {schema}").getField("properties")
    return (
        events.where(F.col("event") == kind)
        .withColumn("p", p)
        .where(
            (F.col("p.istest") == "false")
            & (F.col("p.deviceostype") == "android")
            & F.col("p.daysfromeulaapproval").isNotNull()
        )
    )


def received_on_android(events: DataFrame, since) -> DataFrame:
    """Complete received rows of Android devices."""
    rows = _android(
        events.where(F.col("time") >= F.lit(since)),
        "contentitem_received",
        "struct<istest:string,deviceostype:string,daysfromeulaapproval:double,carriername:string,deviceid:string,"
        "programname:string,messageid:string,messagetype:string,devicevendor:string>",
    )
    return rows.select(
        F.col("p.carriername").alias("CarrierName"),
        F.col("p.deviceid").alias("DeviceId"),
        F.coalesce("p.daysfromeulaapproval", F.lit(0.0)).alias("DaysFromEulaApproval"),
        F.coalesce("p.programname", F.lit("unset")).alias("ProgramName"),
        F.col("p.messageid").alias("MessageId"),
        F.col("p.messagetype").alias("MessageType"),
        F.col("p.devicevendor").alias("DeviceVendor"),
        F.struct("time", F.xxhash64("properties")).alias("rank_key"),
    ).na.drop(subset=["CarrierName", "DeviceId", "MessageId", "MessageType", "DeviceVendor"])


def sent_on_android(events: DataFrame, start, end) -> DataFrame:
    rows = _android(
        events.where((F.col("time") >= F.lit(start)) & (F.col("time") <= F.lit(end))),
        "contentitem_sent",
        "struct<istest:string,deviceostype:string,daysfromeulaapproval:double,deviceosversion:string,deviceid:string,"
        "programname:string,timestamp:string,registrationregion:string,registrationcity:string,"
        "installationsource:string,registrationcountry:string,notificationcopyattributes:string>",
    )
    return rows.select(
        F.col("p.deviceosversion").alias("deviceOsVersion"),
        F.col("p.deviceid").alias("deviceId"),
        F.coalesce("p.daysfromeulaapproval", F.lit(0.0)).alias("daysFromEulaApproval"),
        F.coalesce("p.programname", F.lit("unset")).alias("programName"),
        F.date_format(F.try_to_timestamp("p.timestamp"), "yyyy-MM-dd").alias("date"),
        F.col("p.registrationregion").alias("registrationRegion"),
        F.col("p.registrationcity").alias("registrationCity"),
        F.col("p.installationsource").alias("installationSource"),
        F.col("p.registrationcountry").alias("registrationCountry"),
        F.col("p.notificationcopyattributes").alias("notificationCopyAttributes"),
    )


def viewed(events: DataFrame, since) -> DataFrame:
    """Message ids with a view."""
    p = parse_json(
        F.col("properties"), "properties struct<istest:string,daysfromeulaapproval:double,messageid:string>"
    ).getField("properties")
    return (
        events.where((F.col("event") == "contentitem_view") & (F.col("time") >= F.lit(since)))
        .withColumn("p", p)
        .where((F.col("p.istest") == "false") & F.col("p.daysfromeulaapproval").isNotNull() & F.col("p.messageid").isNotNull())
        .select(F.col("p.messageid").alias("ViewMessageId"))
        .distinct()
    )


def with_preview_clicks(received: DataFrame, views: DataFrame) -> DataFrame:
    joined = received.join(views, received["MessageId"] == views["ViewMessageId"], "left")
    return joined.withColumn("PreviewClicked", F.when(F.col("ViewMessageId").isNotNull(), 1).otherwise(0)).drop("ViewMessageId")


def with_device_features(events: DataFrame, features: DataFrame) -> DataFrame:
    """Inner join on the device id, kept once."""
    return events.join(features, events["DeviceId"] == features["deviceId"], "inner").drop(features["deviceId"])


def views_with_apps(devices: DataFrame, events: DataFrame, since, threshold: int = 200, names: Sequence[str] | None = None) -> DataFrame:
    """Received messages with their view flag and the device's app-category counts."""
    rows = frequent_names(device_names(devices, "categories"), threshold)
    wide = pivot_names(rows, names if names is not None else declared_names(rows))
    received = first_per_key(received_on_android(events, since), ["MessageId"], ["rank_key"]).drop("rank_key")
    return with_device_features(with_preview_clicks(received, viewed(events, since)), wide)


def latest_per_device(rows: DataFrame, device: str, order: Sequence[str | Column]) -> DataFrame:
    """The record with the greatest order key per device."""
    rest = [c for c in rows.columns if c != device]
    key = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"o{i}") for i, c in enumerate(order)])
    return rows.groupBy(device).agg(F.max_by(F.struct(*rest), key).alias("_row")).select(device, "_row.*")


def with_adjacent_later_date(rows: DataFrame, device: str, day: str, tie: Sequence[str | Column]) -> DataFrame:
    """The next later date of the device's rows, newest first; the newest row keeps its own.

    Windows run over blocks of positions with one row of overlap, so a device with very
    many rows is not one task.
    """
    blocks = in_blocks(rows.withColumn("_tie", F.struct(*tie)), [day, "_tie"], [device], reach=1)
    # ascending positions: the later neighbour is one row ahead
    ahead = Window.partitionBy(device, "_block").orderBy("idx").rowsBetween(0, 1)
    return (
        blocks.withColumn("adjacent_later_date", F.max(day).over(ahead))
        .where("_own")
        .drop("idx", "_block", "_own", "_tie")
    )


APP = (
    "struct<FirstInstallTime:bigint,IsSystemApp:boolean,LastUpdateTime:bigint,Name:string,"
    "PackageName:string,VersionCode:bigint,VersionName:string>"
)
HISTORY = (
    "struct<IsTest:boolean,CarrierName:string,DeviceId:string,DeviceModel:string,DeviceVendor:string,"
    f"AgentTimestamp:string,InstalledApps:array<{APP}>>"
)


def telemetry_history(telemetry: DataFrame, start: str, end: str, kinds: Sequence[str] = ("apps", "systemapps")) -> DataFrame:
    """Device records with their app list, from raw telemetry rows of a date range."""
    return (
        telemetry.where(
            (F.col("event_date") >= start) & (F.col("event_date") <= end) & F.col("event_name").isin(*kinds)
        )
        .withColumn("j", F.from_json("json_data", HISTORY))
        .where(F.col("j.IsTest") == F.lit(False))
        .select(
            F.col("j.CarrierName").alias("carrierName"),
            F.col("j.DeviceModel").alias("deviceModel"),
            F.col("j.DeviceVendor").alias("deviceVendor"),
            F.col("j.DeviceId").alias("deviceId"),
            F.col("event_date").alias("date"),
            F.col("j.AgentTimestamp").alias("agentTimestamp"),
            "os",
            F.col("agentversion").alias("agentVersion"),
            F.col("event_name").alias("telemetryType"),
            "uuid",
            F.col("j.InstalledApps").alias("installedApps"),
        )
    )


