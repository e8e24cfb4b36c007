"""Frozen periods, machine buckets, change-log events and dimensions on hand-made rows."""
import datetime as dt

from pyspark.sql import functions as F

from fieldops.operators.history import frozen_periods, period_values, scd2_snapshot
from fieldops.plans import dims, finance
from fieldops.plans import helpdesk as hd
from fieldops.plans import supply as sp
from fieldops.plans import vending as vd


def day(n, month=1):
    return dt.datetime(2024, month, n, 6)


def values(spark, rows):
    return spark.createDataFrame(rows, "name string, grp string, v int")


def test_closed_periods_never_change(spark, tmp_path):
    runs = [(day(5), [("a", None, 1), ("b", "g", 2)]), (day(20), [("a", None, 9), ("b", "g", 2), ("c", "g", 3)]), (day(25), [("b", "g", 2)]),
            (day(2, 2), [("a", None, 50), ("b", "g", 2)]), (day(9, 2), [("a", None, 51), ("b", "g", 2)])]
    history, january = None, None
    for n, (now, rows) in enumerate(runs):
        frozen_periods(history, values(spark, rows), ["name", "grp"], now).write.parquet(str(tmp_path / str(n)))
        history = spark.read.parquet(str(tmp_path / str(n)))
        got = sorted(((r.period_start.month, r.name, r.v, r.dbt_valid_from.day, r.dbt_valid_to and (r.dbt_valid_to.month, r.dbt_valid_to.day))
                      for r in history.collect()), key=str)
        if n == 3:
            january = [r for r in got if r[0] == 1]
    assert january == [(1, "a", 1, 5, (1, 20)), (1, "a", 9, 20, (1, 25)), (1, "b", 2, 5, (2, 2)), (1, "c", 3, 20, (1, 25))]
    assert [r for r in got if r[0] == 1] == january  # the last run revised February alone
    assert [r for r in got if r[0] == 2] == [(2, "a", 50, 2, (2, 9)), (2, "a", 51, 9, None), (2, "b", 2, 2, None)]
    assert frozen_periods(history, values(spark, runs[-1][1]), ["name", "grp"], day(9, 2)).count() == history.count()  # a rerun
    final = {(r.period_start.month, r.name): r.v for r in period_values(history, ["name", "grp"]).collect()}
    assert final == {(1, "a"): 9, (1, "b"): 2, (1, "c"): 3, (2, "a"): 51, (2, "b"): 2}


def test_first_value_of_a_period_stands(spark):
    one = frozen_periods(None, values(spark, [("a", "g", 1), ("b", None, 2)]), ["name", "grp"], day(5), revise=False)
    two = frozen_periods(one, values(spark, [("a", "g", 7), ("c", "g", 3)]), ["name", "grp"], day(6), revise=False)
    got = {(r.name, r.v, r.dbt_valid_to is None) for r in two.collect()}
    assert got == {("a", 1, True), ("b", 2, False), ("c", 3, True)}


def test_null_parts_of_a_key_match(spark):
    df = values(spark, [(None, "g", 1), ("a", None, 2), (None, None, 3)])
    one = scd2_snapshot(None, df, ["name", "grp"], day(1))
    again = scd2_snapshot(one, df, ["name", "grp"], day(2), invalidate_hard_deletes=True)
    assert again.count() == 3 and again.where("dbt_valid_to is not null").count() == 0


WORK = ("material_id int, material_serial_number string, client_code string, partner_name string, demand_category_name string, demand_status string, "
        "workorder_status string, is_workorder_not_done boolean, workorder_id int, workorder_number string, workorder_title string, technician_id int, "
        "demand_created_at timestamp_ntz, date_started timestamp_ntz, date_planned timestamp_ntz, date_done timestamp_ntz, "
        "is_workorder_currently_paused boolean, pause_reason string")


def test_valuation_sums_a_group_before_devices_meet_it(spark):
    devices = spark.createDataFrame(
        [(1, 1, "m", True, None), (1, 1, "m", True, None), (2, 1, "m", True, None), (3, 1, "bare", True, None), (4, 1, "m", False, None),
         (5, 1, "m", True, 1), (6, 2, "m", True, None), (None, 1, "m", True, None), (7, 1, "none", True, None)],
        "device_id int, company_id int, device_name string, is_active boolean, parent_device_id int")
    companies = spark.createDataFrame([(1, "CN01", True, "CLIENT"), (2, "XX01", True, "CLIENT")],
                                      "company_id int, company_code string, is_active boolean, company_type string")
    groups = spark.createDataFrame([("m", "G1"), ("bare", "G9"), ("none", None)], "device_name string, device_group string")
    capacity = spark.createDataFrame([("g1", "a", 2), ("G1", "b", 3), ("G1", "unknown", 5), (None, "a", 7)],
                                     "device_group string, product_code string, quantite int")
    prices = spark.createDataFrame([("a", 1), ("a", 2), ("b", 10)], "product_code string, p int").selectExpr(
        "product_code", "cast(p as decimal(18,2)) as purchase_unit_price")
    out = vd.park_valuation(devices, companies, groups, capacity, prices, "^CN")
    got = {r.device_name: (r.nombre_machines, r.valorisation_totale_machine) for r in out.collect()}
    # G1 is worth 2 * (1 + 2) + 3 * 10; the device that stands twice counts twice in the worth and once as a machine
    assert got == {"m": (2, 4 * 36), "bare": (1, None), "none": (1, None)}
    # the bill is summed by group, then by device, then by model: no join of devices with single items
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 3


def _below(plan: str, *words: str) -> str:
    """The part of a plan's text that stands below its first line with these words."""
    lines = plan.split("\n")
    depth = lambda x: next((i for i, c in enumerate(x) if c.isalpha()), 0)
    at = next(i for i, x in enumerate(lines) if all(w in x for w in words))
    end = next((i for i in range(at + 1, len(lines)) if depth(lines[i]) <= depth(lines[at])), len(lines))
    return "\n".join(lines[at + 1: end])


def test_availability_counts_days_once(spark):
    days = [("2024-01-01 08:00", "old", "a", False), ("2024-01-01 20:00", "old", "a", True), ("2024-01-31 08:00", "new", "b", True),
            ("2024-01-15 08:00", "mid", "a", None), ("2024-02-01 08:00", "new", "b", False), (None, "none", "c", False)]
    rows = [(1, "company", "P", when, code, name, out) for when, code, name, out in days] + [(1, "resource", "P", "2024-01-02 08:00", "x", "x", False)]
    stock = spark.createDataFrame(rows, "id_entity int, entity_type string, product_code string, at string, entity_code string, "
                                  "product_name string, is_out_of_stock boolean").withColumn("date_system", F.col("at").cast("timestamp_ntz"))
    out = sp.monthly_availability(stock)
    got = {r.mois and r.mois.month: (r.entity_code, r.product_name, r.jours_observes, r.jours_disponibles, r.taux_disponibilite_pct)
           for r in out.collect()}
    assert got == {1: ("new", "b", 3, 1, 33.3), 2: ("new", "b", 1, 1, 100.0), None: (None, None, 0, 0, None)}
    assert dict(out.dtypes)["jours_observes"] == dict(out.dtypes)["jours_disponibles"] == "bigint"
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "RepartitionByExpression" in plan  # rows are dealt before they are reduced


def test_consumption_without_a_device(spark):
    """Deliveries have no device: they never meet the device join, where they would be one key."""
    spark.range(40).selectExpr("1L as company_id", "id as n").createOrReplaceTempView("lines_of_test")
    line = spark.table("lines_of_test").select(
        "company_id", F.when(F.col("n") % 4 > 0, F.col("n") % 4).alias("device_id"), F.lit(1).alias("location_id"), F.lit(5).alias("product_id"),
        F.lit("").alias("task_location_info"), F.lit("2024-01-01").cast("date").alias("task_start_date"), F.lit(1.0).alias("quantity"))
    devices = spark.createDataFrame([(1, "SN1", "one", "A", "PAID", "HERE"), (2, "SN2", "two", "A", "PAID", None)],
                                    "device_id long, device_code string, device_name string, device_brand string, "
                                    "device_economic_model string, device_location string")
    products = spark.createDataFrame([(5, "p", "b", "f", "g", "T")], "product_id int, product_name string, product_brand string, "
                                     "product_family string, product_group string, product_type string")
    companies = spark.createDataFrame([(1, "C1", "c")], "company_id long, company_code string, company_name string")
    packs = spark.createDataFrame([(5, 2)], "product_id int, units_per_pack int")
    deliveries = line.drop("device_id", "location_id", "task_location_info")
    routes = [dict(types=("T",), source="TELEMETRIE")]
    out = vd.consumption_arbitration(line, line, deliveries, devices, products, companies, packs, [], routes, ("PAID",), ("T",))
    got = {(r.data_source, r.device_id): (r.device_name, r.location, r.quantity) for r in out.collect()}
    assert got == {("TELEMETRIE", None): (None, None, 10.0), ("TELEMETRIE", 1): ("one", "HERE", 10.0), ("TELEMETRIE", 2): ("two", None, 10.0),
                   ("TELEMETRIE", 3): (None, None, 10.0), ("LIVRAISON", None): ("LIVRAISON", "LIVRAISON", 80.0)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LIVRAISON" not in _below(plan, "Join LeftOuter", "device_id")


def test_machine_buckets(spark):
    def work(i, status, demand, done=None, planned=None, created=1, serial=" X_s1 ", client="x_c1", partner=" us ", category="Repair a", skipped=False,
             paused=False):
        return (1, serial, client, partner, category, demand, status, skipped, i, f"W{i}", f"t{i}", 5, day(created), None,
                planned and day(planned), done and day(done), paused, "why" if paused else None)

    rows = [work(1, "Closed", "Closed", done=10), work(2, "Closed", "Closed", done=12), work(2, "Closed", "Closed", done=3),
            work(3, "Closed", "Closed", done=4), work(4, "Closed", "Closed", done=21), work(5, "Closed", "Accepted", done=15),
            work(6, "In progress", "Accepted", created=3), work(7, "In progress", "Accepted", created=2, paused=True),
            work(8, "Scheduled", "Accepted", planned=28), work(9, "Scheduled", "Accepted", planned=2), work(10, "Scheduled", "Accepted"),
            work(11, "Closed", "Closed", done=19, skipped=True), work(12, "Closed", "Closed", done=19, partner="other"),
            work(13, "Closed", "Closed", done=19, category="Service"), work(14, "Closed", "Closed", done=19, client="x_c2"),
            work(15, "Closed", "Closed", done=19, serial=None), work(16, "In progress", "Accepted", serial="X_S2", paused=True)]
    found = vd.machine_interventions(spark.createDataFrame(rows, WORK), dt.date(2024, 1, 20), "X_", "US", "REPAIR")
    got = {(r.serial_clean, r.client_clean): r for r in found.collect()}
    r = got["S1", "C1"]
    assert (r.nb_interventions_15j, r.past_intervention_id, r.past_date_done) == (2, 2, day(12))  # the 4th is 16 days back, the 21st ahead
    assert (r.current_intervention_id, r.current_is_paused, r.future_intervention_id) == (6, False, 9)
    assert got["S1", "C2"].past_intervention_id == 14 and got["S2", "C1"].current_is_paused
    devices = spark.createDataFrame([(1, 1, "s1 "), (2, 2, "S1"), (3, 1, "s9"), (4, None, "s2")], "device_id int, company_id int, device_code string")
    companies = spark.createDataFrame([(1, " c1"), (2, "C3")], "company_id int, company_code string")
    visits = spark.createDataFrame([(1, 1, 7, day(3), "FAIT", 4, "R4", "G"), (2, 1, 7, day(25), "PREVU", 4, "R4", None), (3, 1, 7, day(9), "PREVU", 4, "R4", None)],
                                   "task_id int, device_id int, company_id int, task_start_date timestamp_ntz, task_status_code string, "
                                   "resources_roadman_id int, roadman_code string, gea_code string")
    context = vd.machine_replenishment_context(visits, day(20), devices)
    sheet = {r.device_id: r for r in vd.machine_sheet(context, devices, companies, found).collect()}
    assert len(sheet) == 4
    assert (sheet[1].company_id, sheet[1].last_appro_task_id, sheet[1].last_appro_gea_code, sheet[1].next_appro_task_id) == (1, 1, "G", 2)
    assert (sheet[1].nb_appros_realises_total, sheet[1].nb_interventions_15j, sheet[1].past_intervention_id) == (1, 2, 2)
    # no visits; repairs of a client that it is no longer with; no client at all
    assert [(sheet[i].nb_appros_realises_total, sheet[i].nb_interventions_15j, sheet[i].last_appro_date, sheet[i].current_is_paused) for i in (2, 3, 4)] == [
        (0, 0, None, False)] * 3


def test_property_events(spark):
    history = spark.createDataFrame([(i, 7, day(i), "TicketUpdated", 1, "a", "AGENT") for i in range(1, 6)],
                                    "event_id int, ticket_id int, event_at timestamp_ntz, event_name string, actor_id int, actor_name string, actor_type string")
    names = [f"{k}_value{s}" for k in ("property", "previous", "updated") for s in ("", "_id", "_name")]

    def info(event, name, **kw):
        return (event, name, *[kw.get(n) for n in names])

    infos = spark.createDataFrame(
        [info(1, "Priority", property_value="low"), info(2, "Priority", previous_value="low", updated_value="high"),
         info(3, "Priority", previous_value="high"), info(1, "Owner", property_value_id="4", property_value_name="Ann"),
         info(4, "Owner", previous_value_id="4", previous_value_name="Ann", updated_value_id="5", updated_value_name="Bo"),
         info(5, "Colour", property_value="red"), info(9, "Priority", property_value="lost")],
        "event_id int, property_name string, " + ", ".join(f"{n} string" for n in names))
    events = hd.property_events(history, infos, {"Priority": "priority", "Owner": "assignee"})
    got = {(r.event_id, r.prev_priority, r.new_priority, r.is_initial_assignment) for r in hd.priority_events(events).collect()}
    assert got == {(1, None, "low", True), (2, "low", "high", False), (3, "high", None, False)}
    got = {(r.event_id, r.prev_assignee_id, r.new_assignee_id, r.prev_assignee_name, r.new_assignee_name, r.is_initial_assignment)
           for r in hd.assignee_events(events).collect()}
    assert got == {(1, None, "4", None, "Ann", True), (4, "4", "5", "Ann", "Bo", False)}


def test_dimension_rules(spark):
    entities = spark.createDataFrame([(1, "CN01", 1), (2, "XX", 2), (3, "CP", 9), (4, None, 1)], "id int, code string, type_id int")
    links = spark.createDataFrame([(1, 10), (1, 11), (1, 20), (2, 20), (2, 20), (3, 10), (2, None)], "id int, idlabel int")
    labels = spark.createDataFrame([(10, 1, "north"), (11, 1, "south"), (20, 2, "YES")], "idlabel int, idlabel_family int, code string")
    families = spark.createDataFrame([(1, "REGION"), (2, "ACTIVE")], "idlabel_family int, code string")
    at = spark.createDataFrame([(1, 5, 1), (1, 4, 1), (1, 3, 2), (2, 3, 2)], "id int, idlocation int, idlocation_type int")
    places = spark.createDataFrame([(3, "c3"), (4, "c4"), (5, "c5")], "idlocation int, city string")
    out = dims.dimension(entities, "id", links, labels, families, {"region": "REGION", "active": "ACTIVE"}, {"region": "nowhere"},
                         {"is_active": [("active", "yes", "yes")], "is_client": [("code", "like", "CN__"), ("type_id", "is", 2)]},
                         ("type_id", (1, 2)), (at, places), label_column=("code", "region"))
    got = {r.id: (r.region, r.is_active, r.is_client, r.city, r.label) for r in out.collect()}
    assert got == {1: ("south", True, True, "c4", "CN01 - south"), 2: ("nowhere", True, True, None, "XX - nowhere"),
                   4: ("nowhere", False, False, None, None)}
    units = spark.createDataFrame([(1, 1, 1, 6, "B"), (1, 1, 1, 2, "C"), (1, 2, 1, 99, "Z"), (2, 1, 0, 6, "B")],
                                  "idproduct int, idunit_type int, isactive int, coeff_multi int, code string")
    assert [tuple(r) for r in dims.purchase_units(units).collect()] == [(1, 6, "C")]


def test_workday_ends_and_visits_with_clock(spark):
    from fieldops.plans.vending import visits_with_clock, workday_ends
    import datetime as dt
    at = lambda d, h, m=0: dt.datetime(2024, 3, d, h, m)
    clock = spark.createDataFrame([
        (1, "START_DAY", at(4, 2, 59)), (1, "START_DAY", at(4, 8)), (1, "START_DAY", at(4, 7)), (1, "END_DAY", at(4, 6)), (1, "END_DAY", at(4, 17)),
        (2, "START_DAY", at(4, 9)), (2, "END_DAY", at(4, 5)),  # the only end is before the start
        (3, "END_DAY", at(4, 17)), (None, "START_DAY", at(4, 9))],
        "resources_roadman_id int, label_code string, date_pointage timestamp_ntz")
    ends = {r[0]: (r[2], r[3]) for r in workday_ends(clock).collect()}
    assert ends == {1: (at(4, 7), at(4, 17)), 2: (at(4, 9), None), 3: (None, None)}
    visits = spark.createDataFrame([
        (1, 1, "ENCOURS", at(4, 9), at(4, 10)), (2, 1, "FAIT", at(4, 9), at(4, 9, 30)), (3, 1, "ANNULE", at(4, 9), at(4, 10)),
        (4, 3, "ANOMALIE", at(4, 9), None), (5, None, "PREVU", at(4, 9), None), (6, 1, None, at(4, 9), None)],
        "task_id int, resources_roadman_id int, task_status_code string, task_start_date timestamp_ntz, task_end_date timestamp_ntz")
    out = {r["task_id"]: r for r in visits_with_clock(visits, clock).collect()}
    assert set(out) == {1, 2, 4, 5}
    flags = lambda r: (r["task_status_code"], r["is_done"], r["is_planned"], r["is_anomaly"], r["passage_duration_min"], r["pointage_missing_flag"])
    assert flags(out[1]) == ("FAIT", 1, 1, 0, None, 0)
    assert flags(out[2]) == ("FAIT", 1, 1, 0, 30.0, 0)
    assert flags(out[4]) == ("ANOMALIE", 0, 0, 1, None, 1)
    assert flags(out[5]) == ("PREVU", 0, 1, 0, None, 1)
    assert visits_with_clock(visits.limit(0), clock).count() == 0


def test_stock_perimeters(spark):
    from fieldops.plans.supply import stock_by_store, stock_of_entities
    stock = spark.createDataFrame([
        (1, "company", "north", 0.0, None, 2.0), (1, "resource", "van", 3.0, 5.0, 2.0), (2, "resource", "person", 1.0, None, None),
        (3, "resource", "idle", 1.0, 1.0, 1.0), (9, "resource", "unknown", None, 1.0, 1.0), (4, "company", "north too", 1.0, 1.0, 1.0),
        (1, None, "north", 1.0, 1.0, 1.0)],
        "id_entity int, entity_type string, entity_name string, stock_at_date double, dpa double, purchase_price double")
    res = spark.createDataFrame([(1, "VEHICLE", True), (2, "PERSON", True), (3, "VEHICLE", False)],
                                "resources_id int, resources_type string, is_active boolean")
    inside = {(r["entity_name"], r["dpa"], r["is_out_of_stock"]) for r in stock_of_entities(stock, res, ["north"], "VEHICLE").collect()}
    assert inside == {("north", 2.0, True), ("van", 5.0, False)}
    every = [(r["entity_type"], r["entity_name"], r["is_active"], r["is_out_of_stock"]) for r in stock_of_entities(stock, res).collect()]
    assert sorted(every, key=str) == sorted([
        ("company", "north", None, True), ("resource", "van", True, False), ("resource", "person", True, False),
        ("resource", "idle", False, False), ("resource", "unknown", False, None), ("company", "north too", None, False),
        (None, "north", None, False)], key=str)
    rows = spark.createDataFrame([("a", "DEPOT X"), ("b", "bob"), (None, "DEPOT X"), ("c", None)], "reference string, nom_du_stock string")
    export = rows.selectExpr("*", "'x' as designation", "1.0 as quantite", "timestamp'2024-01-02 03:00:00' as export_date")
    assert {(r["reference"], r["type_stock"]) for r in stock_by_store(export, "^DEPOT").collect()} == {("a", "DEPOT"), ("b", "TECHNICIEN")}


def test_parts_by_job_and_opportunities(spark):
    from fieldops.plans.crm import OPPORTUNITY_NAMES, normalise_opportunities
    from fieldops.plans.service import parts_consumption_by_job
    art = spark.createDataFrame([(1, "ab", "T1", 2.0), (1, "ab", None, 1.0), (2, "cd", "T1", 1.0), (3, None, "t9", 1.0)],
                                "n_planning int, code_article string, n_tech string, quantite_article double")
    jobs = spark.createDataFrame([(1, "x", "in"), (2, "x", "out"), (3, "y", "in")], "n_planning int, etat_intervention string, agency string")
    jobs = jobs.selectExpr("*", "timestamp'2024-01-01' as date_heure_debut", "timestamp'2024-01-01' as date_heure_fin")
    people = spark.createDataFrame([(7, "t1"), (8, None)], "user_id int, nomad_id string")
    out = [(r["n_planning"], r["product_reference"], r["technician_id"]) for r in parts_consumption_by_job(art, jobs, people, ["in"], "P_").collect()]
    assert sorted(out, key=str) == sorted([(1, "P_AB", 7), (1, "P_AB", None), (3, None, None)], key=str)
    raw = spark.createDataFrame([(1, "#", "12", 40.0, "Won", "Other"), (None, "7", "x1", None, None, None)],
                                "opportunity_id long, c4c_id_account string, c4c_id_campaign string, chance_of_success double, "
                                "lifecycle_status string, role_account string")
    raw = raw.selectExpr("*", *[f"'v' as {c}" for c in OPPORTUNITY_NAMES])
    got = [(r["opp_id"], r["opp_id_client_c4c"], r["opp_campagne_id"], r["opp_probabilite"], r["opp_statut"], r["opp_role"])
           for r in normalise_opportunities(raw, {"lifecycle_status": {"Won": "w"}, "role_account": {"Customer": "c"}}).collect()]
    assert sorted(got, key=str) == sorted([("1", None, 12, 0.4, "w", "Other"), (None, "7", None, None, None, None)], key=str)


def test_pnl_names_are_arguments(spark):
    lines = spark.sql("""select * from values
        (date'2020-03-01', 'u', 'Turnover', '700', 10.00BD, false), (date'2020-03-02', 'u', 'Goods', '600', -4.00BD, false),
        (date'2020-03-03', 'u', 'Goods', '999', -1.00BD, false)
        as t(date_facturation, code_analytique_bu, macro_categorie_pnl_bu, numero_compte_general, montant_analytique_signe,
             is_missing_analytical)""")
    budget = spark.sql("select 2020 as budg_annee, 3 as budg_mois, 'u' as budg_bu, 'CA' as budg_categorie_pnl, 8.00BD as budg_valeur")
    names = finance.PnlNames(sales="Turnover", materials="Goods", with_provisions="all", without_provisions="net")
    got = {(r.scenario, r.kpi): (r.valeur, r.budget) for r in finance.pnl_by_unit(lines, budget, 2020, 2020, ("999",), names).collect()}
    assert {s for s, _ in got} == {"all", "net"} and len(got) == 12
    assert got["all", "CA"] == (10, 8) and got["all", "CONSOMMATION_MP_SSTT"][0] == -5
    assert got["net", "MARGE_BRUTE"][0] == 6
