"""K38–K41 — help-desk: status events from a change log, lifecycle segments, SLA clocks, ticket 360."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldops.operators.business_time import business_minutes
from fieldops.operators.windows import bucketed_neighbours

TZ = "Europe/Paris"
EVENT = ("event_id", "ticket_id", "event_at", "event_date_paris", "event_name", "actor_id", "actor_name", "actor_type")


def property_events(history: DataFrame, infos: DataFrame, properties: Mapping[str, str]) -> DataFrame:
    """K38 — one row per change of a tracked property (``properties``: name in the log → name here), from one pass
    over the change log: who, when, previous and new value, and whether this is the first assignment.

    history: event_id, ticket_id, event_at, event_name, actor_id, actor_name, actor_type
    infos:   event_id, property_name, then property_value / _id / _name, each as the value set at creation and as
             previous and updated value: scalar properties fill the plain ones, objects (an assignee) id and name.
    The new value is the updated one, or else the one of the creation; a creation has neither previous nor
    updated value.  The facts of single properties are filters of this one."""
    wanted = infos.where(F.col("property_name").isin(*properties))
    kind = F.col("property_name")
    e = history.join(wanted, "event_id")
    own = F.coalesce("property_value", "property_value_id")
    prev, new = (F.coalesce(f"{x}_value", f"{x}_value_id") for x in ("previous", "updated"))
    return e.select(
        "event_id", "ticket_id", "event_at",
        F.to_date(F.from_utc_timestamp(F.col("event_at").cast("timestamp"), TZ)).alias("event_date_paris"),
        "event_name", "actor_id", "actor_name", "actor_type", F.coalesce(*[F.when(kind == k, F.lit(v)) for k, v in properties.items()]).alias("property"),
        prev.alias("previous"), F.col("previous_value_name").alias("previous_name"), F.coalesce(new, own).alias("new"),
        F.coalesce("updated_value_name", "property_value_name").alias("new_name"),
        (prev.isNull() & new.isNull() & own.isNotNull()).alias("is_initial"))


def priority_events(events: DataFrame) -> DataFrame:
    """K38 — changes of a ticket's priority, of property_events."""
    return events.where("property = 'priority'").select(
        *EVENT, F.col("previous").alias("prev_priority"), F.col("new").alias("new_priority"), F.col("is_initial").alias("is_initial_assignment"))


def assignee_events(events: DataFrame) -> DataFrame:
    """K38 — changes of a ticket's assignee, of property_events."""
    return events.where("property = 'assignee'").select(
        *EVENT, F.col("previous").alias("prev_assignee_id"), F.col("previous_name").alias("prev_assignee_name"),
        F.col("new").alias("new_assignee_id"), F.col("new_name").alias("new_assignee_name"), F.col("is_initial").alias("is_initial_assignment"))


def status_events(history: DataFrame, mapping: DataFrame) -> DataFrame:
    """K38 — one row per status change: new = coalesce(updated, value); creation when only a value.

    history: event_id, ticket_id, event_at, event_name, actor_id, actor_name, actor_type,
             property_value, property_value__previous_value, property_value__updated_value
    mapping: status, status_type, is_on_hold, is_closed   (a seed, looked up twice)
    """
    prev_map, new_map = (mapping.select(F.col("status").alias(f"_{k}"), *[F.col(c).alias(f"{k}_{c}") for c in (
        "status_type", "is_on_hold", "is_closed")]) for k in ("prev", "new"))
    e = history.select(
        "event_id", "ticket_id", "event_at",
        F.to_date(F.from_utc_timestamp(F.col("event_at").cast("timestamp"), TZ)).alias("event_date_paris"),
        "event_name", "actor_id", "actor_name", "actor_type",
        F.col("property_value__previous_value").alias("prev_status"),
        F.coalesce("property_value__updated_value", "property_value").alias("new_status"),
        (F.col("property_value__previous_value").isNull() & F.col("property_value__updated_value").isNull()
         & F.col("property_value").isNotNull()).alias("is_creation_event"))
    return (e.join(prev_map, e.prev_status == prev_map._prev, "left")
             .join(new_map, e.new_status == new_map._new, "left").drop("_prev", "_new"))


def lifecycle_segments(events: DataFrame, cal: DataFrame) -> DataFrame:
    """K39 — status intervals per ticket (lead → end; the open last segment has NULL durations),
    with calendar minutes and business minutes (Mon–Fri 09:00–17:30 Paris, holidays excluded).

    Events of one instant follow their id.  Order and successor are found per ticket and day, so a
    ticket with very many events is split."""
    ev = events.where(F.col("event_name").isin("TicketCreated", "TicketUpdated"))
    x = bucketed_neighbours(ev, ["ticket_id"], ["event_at", "event_id"], F.col("event_at").cast("date"),
                            leads={"next_event_at": "event_at"}, position="segment_idx")
    s = x.select("ticket_id", F.col("segment_idx").cast("int").alias("segment_idx"),
                 F.col("event_at").alias("segment_start_at"),
                 F.to_date(F.from_utc_timestamp(F.col("event_at").cast("timestamp"), TZ)).alias("segment_start_date_paris"),
                 F.col("next_event_at").alias("segment_end_at"),
                 F.col("new_status").alias("status"), F.col("new_status_type").alias("status_type"),
                 F.col("new_is_on_hold").alias("is_on_hold"), F.col("new_is_closed").alias("is_closed"))
    s = business_minutes(s, "segment_start_at", "segment_end_at", cal, out="_bm")
    open_seg = F.col("segment_end_at").isNull()
    return (s.withColumn("duration_minutes_calendar",
                         F.when(open_seg, F.lit(None)).otherwise(
                             F.timestamp_diff("MINUTE", "segment_start_at", "segment_end_at")))
             .withColumn("duration_minutes_business", F.when(open_seg, F.lit(None)).otherwise(F.col("_bm")))
             .drop("_bm"))


def ticket_sla(tickets: DataFrame, threads: DataFrame, events: DataFrame, segments: DataFrame,
               cal: DataFrame) -> DataFrame:
    """K40 — first agent reply, first/last close (transition into closed), reopens, three clocks in
    calendar and business minutes, time in status (open / on hold)."""
    th = threads.groupBy("ticket_id").agg(
        F.min(F.when((F.col("direction") == "out") & (F.col("author__type") == "AGENT")
                     & ~F.coalesce(F.col("is_description_thread"), F.lit(False)), F.col("created_time")))
         .alias("first_agent_response_at"),
        F.min(F.when(F.col("direction") == "in", F.col("created_time"))).alias("first_inbound_at"))
    into_closed = F.col("new_is_closed") & ~F.coalesce(F.col("prev_is_closed"), F.lit(False))
    cl = (events.where(F.col("event_name") == "TicketUpdated").groupBy("ticket_id").agg(
        F.min(F.when(into_closed, F.col("event_at"))).alias("first_close_at"),
        F.max(F.when(into_closed, F.col("event_at"))).alias("last_close_at"),
        F.count_if(into_closed).alias("nb_closes"),
        F.count_if(F.col("prev_is_closed") & ~F.col("new_is_closed")).alias("nb_reopens")))
    seg = segments.groupBy("ticket_id").agg(
        F.sum(F.when(F.col("status_type") == "Open", F.col("duration_minutes_calendar")).otherwise(0)).alias("_oc"),
        F.sum(F.when(F.col("status_type") == "On Hold", F.col("duration_minutes_calendar")).otherwise(0)).alias("_hc"),
        F.sum(F.when(F.col("status_type") == "Open", F.col("duration_minutes_business")).otherwise(0)).alias("_ob"),
        F.sum(F.when(F.col("status_type") == "On Hold", F.col("duration_minutes_business")).otherwise(0)).alias("_hb"))
    x = (tickets.select("ticket_id", "created_time").join(th, "ticket_id", "left").join(cl, "ticket_id", "left")
         .join(seg, "ticket_id", "left"))
    for end, out in (("first_agent_response_at", "first_response_minutes_business"),
                     ("first_close_at", "resolution_minutes_first_close_business"),
                     ("last_close_at", "resolution_minutes_last_close_business")):
        x = business_minutes(x, "created_time", end, cal, out=out, null_without_business_day=True)
    cal_min = lambda end: F.when(F.col(end).isNull(), F.lit(None)).otherwise(
        F.timestamp_diff("MINUTE", "created_time", end))
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return x.select(
        "ticket_id", "created_time", "first_agent_response_at", "first_inbound_at",
        cal_min("first_agent_response_at").alias("first_response_minutes_calendar"),
        "first_response_minutes_business", "first_close_at", "last_close_at",
        z("nb_closes").alias("nb_closes"), z("nb_reopens").alias("nb_reopens"),
        cal_min("first_close_at").alias("resolution_minutes_first_close_calendar"),
        "resolution_minutes_first_close_business",
        cal_min("last_close_at").alias("resolution_minutes_last_close_calendar"),
        "resolution_minutes_last_close_business",
        z("_oc").alias("time_in_open_minutes_calendar"), z("_hc").alias("time_in_on_hold_minutes_calendar"),
        z("_ob").alias("time_in_open_minutes_business"), z("_hb").alias("time_in_on_hold_minutes_business"),
        z("_oc").alias("resolution_excluding_hold_minutes_calendar"),
        z("_ob").alias("resolution_excluding_hold_minutes_business"))


def ticket_360(tickets: DataFrame, contacts: DataFrame, accounts: DataFrame, departments: DataFrame,
               agents: DataFrame, metrics: DataFrame) -> DataFrame:
    """K41 — ticket with its contact, account (direct, else through the contact), department,
    assignee and metrics: left joins of dimensions onto the ticket fact; the planner chooses by size."""
    c = contacts.select("contact_id", F.col("account_id").alias("_c_account"), "first_name", "email")
    a1 = accounts.select(F.col("account_id").alias("_a1"), F.col("account_name").alias("_n1"))
    a2 = accounts.select(F.col("account_id").alias("_a2"), F.col("account_name").alias("_n2"))
    d = departments.select("department_id", F.col("name").alias("department_name"))
    ag = agents.select(F.col("agent_id").alias("assignee_id"), F.col("name").alias("assignee_name"))
    j = (tickets.join(metrics, "ticket_id", "left").join(c, "contact_id", "left")
         .join(a1, F.col("account_id") == F.col("_a1"), "left")
         .join(a2, F.col("_c_account") == F.col("_a2"), "left")
         .join(d, "department_id", "left").join(ag, "assignee_id", "left"))
    return (j.withColumn("account_id", F.coalesce("account_id", "_c_account"))
             .withColumn("account_name", F.coalesce("_n1", "_n2"))
             .drop("_c_account", "_a1", "_n1", "_a2", "_n2"))
