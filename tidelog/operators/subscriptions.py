"""Stream subscriptions: folding handle events, expiry, requests, status and scope."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.json import params_to_json
from tidelog.functions.scalars import FULL_SYNC
from tidelog.operators.skew import lookup_join


def open_handles(events: DataFrame, clock: str = "seq") -> DataFrame:
    """One row per ``(stream, handle)`` that was subscribed after the stream's last clear.

    ``open`` says whether the handle still counts: no unsubscribe comes after its newest
    subscribe. The first one closes it; repeated unsubscribes of a handle, and those of handles older
    than the last unsubscribe-all, change nothing. ``clock`` names the column that ``closed_at`` is taken from.
    """
    kind = F.col("kind")
    opened = (
        events.where(kind == "subscribe")
        .groupBy("stream", "handle")
        .agg(F.max("seq").alias("opened"), F.max_by("ttl", "seq").alias("ttl"), F.max_by("priority", "seq").alias("priority"))
    )
    ends = events.where(kind == "unsubscribe").select("stream", "handle", "seq", F.col(clock).alias("_clock"))
    after = lookup_join(
        ends, opened.select("stream", "handle", "opened"), ["stream", "handle"], "inner", spread=F.xxhash64("seq"), key_sample=ends
    ).where(F.col("seq") > F.col("opened"))
    closed = after.groupBy("stream", "handle").agg(F.min("seq").alias("closed"), F.min_by("_clock", "seq").alias("closed_at"))
    handles = opened.join(closed, ["stream", "handle"], "left")
    cleared = events.where(kind == "unsubscribe_all").groupBy("stream").agg(F.max("seq").alias("cleared"))
    none = F.lit(-1).cast("bigint")
    return (
        lookup_join(handles, cleared, ["stream"], "left", spread=F.xxhash64("handle"), key_sample=events)
        .where(F.col("opened") > F.coalesce("cleared", none))
        .withColumn("open", F.col("closed").isNull())
        .drop("cleared")
    )


def subscription_state(events: DataFrame, clock: str = "seq") -> DataFrame:
    """Per stream that has not been cleared: open handles, newest ttl and priority, last close."""
    return (
        open_handles(events, clock)
        .groupBy("stream")
        .agg(
            F.sum(F.col("open").cast("bigint")).alias("ref_count"),
            F.max_by("ttl", "opened").alias("ttl"),
            F.max_by("priority", "opened").alias("priority"),
            F.max_by("closed_at", F.when(~F.col("open"), F.col("closed"))).alias("closed_at"),
        )
    )


def subscription_fold(events: DataFrame) -> DataFrame:
    """Active subscriptions ``(stream, ref_count, ttl, priority)``: those with an open handle."""
    return subscription_state(events).where(F.col("ref_count") > 0).drop("closed_at")


def subscription_expiry(events: DataFrame, now: Column, clock: str = "at") -> DataFrame:
    """Subscriptions kept at ``now`` (epoch seconds), with when they expire.

    ``clock`` names the events' time in epoch seconds. A referenced stream never expires; the
    others expire their ttl after the last unsubscribe, and expired ones are evicted.
    """
    expires = F.when(F.col("ref_count") == 0, F.col("closed_at") + F.col("ttl"))
    return (
        subscription_state(events, clock)
        .withColumn("expires_at", expires)
        .where((F.col("ref_count") > 0) | (F.col("expires_at") > now))
        .drop("closed_at")
    )


def request_items(subscriptions: DataFrame) -> DataFrame:
    """Adds ``item``: each subscription as it appears in a request, NULLs written out.

    ``parameters`` is a variant, a struct, or NULL.
    """
    item = F.to_json(
        F.struct(
            F.col("stream"),
            F.col("parameters"),
            F.col("priority").alias("override_priority"),
        ),
        {"ignoreNullFields": "false"},
    )
    return subscriptions.withColumn("item", item)


def subscription_request(
    subscriptions: DataFrame, client: str, include_defaults: bool = True
) -> DataFrame:
    """The one request document of each client: its different subscriptions, ordered by their text.

    The protocol sends a client's subscriptions as a whole, so a document is as large as they are.
    """
    body = F.concat(
        F.lit(f'{{"include_defaults":{str(include_defaults).lower()},"subscriptions":['),
        F.concat_ws(",", F.array_sort(F.collect_set("item"))),
        F.lit("]}"),
    )
    return request_items(subscriptions).groupBy(client).agg(body.alias("request"))


def stream_status(statuses: DataFrame, wanted: DataFrame) -> DataFrame:
    """Status of the wanted streams, matched by name and canonical parameters.

    ``statuses`` has one row per tracked stream with ``downloading``; ``parameters`` on both
    sides is canonical JSON text or NULL. Progress is shown only during a download, and a
    missing priority reads as the one of a full sync.
    """
    # Absent parameters compare as the JSON text null.
    stream_key = F.coalesce("parameters", F.lit("null")).alias("_parameters")
    named = wanted.select("name", stream_key).distinct()
    tracked = lookup_join(
        statuses.withColumn("_parameters", stream_key), named, ["name", "_parameters"], "left_semi"
    )
    shown = F.col("downloading")
    return tracked.select(
        "name",
        "parameters",
        "active",
        "is_default",
        "has_explicit_subscription",
        "expires_at",
        "last_synced_at",
        F.col("last_synced_at").isNotNull().alias("has_synced"),
        F.when(shown, F.col("downloaded")).alias("downloaded"),
        F.when(shown, F.col("total")).alias("total"),
        F.coalesce("priority", F.lit(FULL_SYNC)).alias("priority"),
    )


def stream_priority_synced(bucket_subscriptions: DataFrame, priority: int) -> DataFrame:
    """Per subscription whether completion at ``priority`` has synced it: all its buckets are at or below it."""
    return bucket_subscriptions.groupBy("sub").agg((F.max("priority") <= priority).alias("synced"))


def bucket_scope(stream: str, rows: DataFrame, user: Column) -> DataFrame:
    """The rows a stream's query gives every user, labelled with the user's bucket."""
    return rows.withColumns({"user": user, "bucket": F.concat(F.lit(f"{stream}:"), user)})


def child_scope(stream: str, children: DataFrame, parents: DataFrame, foreign_key: str, user: str) -> DataFrame:
    """Child rows in the scope of the user that owns their parent, for all users at once."""
    owners = parents.select(F.col("id").alias(foreign_key), F.col(user).alias("_user"))
    joined = lookup_join(children, owners, [foreign_key], "inner", spread=F.xxhash64("id"))
    return bucket_scope(stream, joined, F.col("_user")).drop("_user")


def default_streams(defaults: DataFrame, explicit: DataFrame, include_defaults: bool = True) -> DataFrame:
    """Tracked streams: defaults (unless turned off) and explicit subscriptions; both may hold."""
    auto = defaults.select(F.col("stream"), F.lit(True).alias("is_default"))
    asked = explicit.select("stream", F.lit(True).alias("has_explicit_subscription"))
    joined = auto.join(asked, "stream", "full_outer" if include_defaults else "right")
    return joined.select(
        "stream",
        F.coalesce("is_default", F.lit(False)).alias("is_default"),
        F.coalesce("has_explicit_subscription", F.lit(False)).alias("has_explicit_subscription"),
    )


def canonical_parameters(parameters: Mapping[str, Column]) -> Column:
    """Parameter columns as JSON text with sorted keys, fit for a join key."""
    return params_to_json({name: parameters[name] for name in sorted(parameters)})


def parameters_text(parameters: Mapping[str, object] | None) -> str | None:
    """Parameter values of a caller as the same text; no parameters are not the empty object."""
    if parameters is None:
        return None
    return json.dumps(parameters, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
