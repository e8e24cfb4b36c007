"""The task ledger on hand-made rows: label bridge, typed ends, amounts at another grain, visit flags."""
import datetime as dt
from decimal import Decimal

import pytest

from fieldops.operators import ledger as L

T0 = dt.datetime(2024, 1, 1, 8)


@pytest.fixture(scope="module")
def bridge(spark):
    families = spark.createDataFrame([(1, "SOURCE"), (2, "STATE"), (3, "OTHER")], "idlabel_family int, code string")
    labels = spark.createDataFrame([(10, 1, "A"), (11, 1, "B"), (20, 2, "WAITING"), (21, 2, "DELIVERED"), (22, 2, "ZZ"),
                                    (30, 3, "LOADING"), (31, 3, "REMOVING"), (40, 9, "NO_FAMILY")],
                                   "idlabel int, idlabel_family int, code string")
    links = spark.createDataFrame([(1, 10), (1, 10), (1, 11), (1, 20), (1, 21), (2, 22), (2, 20), (3, 30), (3, 31), (4, 31), (5, 40),
                                   (6, 99)], "idtask int, idlabel int")
    return links, labels, families


def test_labels_are_one_row_per_task(bridge):
    got = {r.idtask: (r.source, r.state) for r in L.task_labels(*bridge, {"source": "SOURCE", "state": "STATE"}).collect()}
    assert got == {1: ("B", "WAITING"), 2: (None, "ZZ")}  # other families and unknown labels leave no row
    first = {r.idtask: r.state for r in L.task_labels(*bridge, {"state": "STATE"}, {"state": "DELIVERED"}).collect()}
    assert first == {1: "DELIVERED", 2: "WAITING"}


def test_required_and_having_labels(spark, bridge):
    tasks = spark.createDataFrame([(i,) for i in range(1, 8)], "idtask int")
    labels = L.task_labels(*bridge, {"source": "SOURCE", "state": "STATE"})
    assert L.with_labels(tasks, labels).count() == 7
    assert [r.idtask for r in L.with_labels(tasks, labels, required="source").collect()] == [1]
    assert [r.idtask for r in L.with_labels(tasks, labels, having={"state": "ZZ"}).collect()] == [2]
    assert L.with_labels(tasks, labels.where("false"), required="state").count() == 0


def test_load_direction(spark, bridge):
    flags = L.label_flags(bridge[0], bridge[1], {"up": "LOADING", "down": "REMOVING"})
    facts = spark.createDataFrame([(1, 5.0), (3, 5.0), (3, -5.0), (4, 5.0), (4, None)], "idtask int, base_unit_quantity double")
    got = [(r.idtask, r.base_unit_quantity, r.direction) for r in L.load_direction(facts.join(flags, "idtask", "left"), "up", "down").collect()]
    assert sorted(got, key=str) == sorted([(1, 5.0, None), (3, 5.0, "LOADING"), (3, -5.0, "REMOVING"), (4, 5.0, "REMOVING"),
                                           (4, None, "REMOVING")], key=str)
    assert {r.base_unit_quantity: r.direction for r in L.load_direction(facts).collect()} == {
        5.0: "LOADING", -5.0: "REMOVING", None: None}


def test_typed_ends(spark):
    companies = spark.createDataFrame([(1, "C1"), (2, None)], "idcompany int, code string")
    resources = spark.createDataFrame([(1, "R1"), (3, "R3")], "idresources int, code string")
    directory = L.typed_directory({"COMPANY": (companies, "idcompany"), "RESOURCES": (resources, "idresources")})
    rows = [(1, 1, "COMPANY", 1, "RESOURCES"), (2, 3, "COMPANY", 3, "RESOURCES"), (3, 1, "DEVICE", 1, "COMPANY"),
            (4, None, "COMPANY", 1, "COMPANY"), (5, 2, "COMPANY", 1, "COMPANY"), (6, 1, None, 1, "COMPANY")]
    tasks = spark.createDataFrame(rows, "idtask int, idproduct_source long, type_product_source string, "
                                        "idproduct_destination long, type_product_destination string")
    out = {r.idtask: (r.source_code, r.destination_code)
           for r in L.resolve_ends(tasks, directory, {"source": False, "destination": False}).collect()}
    # the same id stands for different things under different types; dangling, untyped and codeless ends are NULL
    assert out == {1: ("C1", "R1"), 2: (None, "R3"), 3: (None, "C1"), 4: (None, "C1"), 5: (None, "C1"), 6: (None, "C1")}
    assert {r.idtask for r in L.resolve_ends(tasks, directory, {"source": True, "destination": True}).collect()} == {1}
    only = L.resolve_ends(tasks, directory, {"destination": True}, ["COMPANY"]).collect()
    assert {r.idtask for r in only} == {3, 4, 5, 6}


def test_amounts_are_not_counted_twice(spark):
    tasks = spark.createDataFrame([(1,), (2,), (3,)], "idtask int")
    d = Decimal
    lines = spark.createDataFrame([(1, "COIN", d(5)), (1, "COIN", d(7)), (1, "NOTE", d(20)), (1, "TOKEN", d(99)), (2, "TOKEN", d(1)),
                                   (3, "NOTE", d(3))], "idtask int, code string, sale_amount_net decimal(18,2)")
    amounts = spark.createDataFrame([(1, d(10), d(1)), (1, d(20), d(2)), (2, d(5), d(1))],
                                    "idtask int, amount_without_tax decimal(18,2), tax_amount decimal(18,2)")
    got = {r.idtask: (r.coins, r.notes, r.amount_cash, r.amount_net, r.amount_tax)
           for r in L.cash_counts(tasks, lines, amounts, {"coins": "COIN", "notes": "NOTE"}).collect()}
    assert got == {1: (12, 20, 32, 30, 3), 3: (0, 3, 3, None, None)}  # a task of tokens alone is no count


@pytest.mark.parametrize("planned", [True, False])
def test_visit_flags(spark, planned):
    statuses = spark.createDataFrame([(1, "FAIT"), (2, "ENCOURS"), (3, "ANNULE"), (4, "VALIDE"), (5, "ANOMALIE"), (6, "PREVU")],
                                     "idtask_status int, code string")
    end = T0 + dt.timedelta(minutes=90)
    tasks = spark.createDataFrame([(i, i, T0, end if i != 7 else None) for i in range(1, 7)] + [(8, 1, T0, None), (9, 1, T0, end), (10, 77, T0, end)],
                                  "idtask int, idtask_status int, real_start_date timestamp_ntz, real_end_date timestamp_ntz")
    people = spark.createDataFrame([(i, 100 + i, f"R{i}") for i in (1, 2, 3, 4, 5, 6, 8, 10)], "idtask int, resource_id int, resource_code string")
    got = {r.idtask: (r.task_status_code, r.is_done, r.is_planned, r.is_anomaly, r.passage_duration_min)
           for r in L.visit_facts(tasks, statuses, people, planned).collect()}
    assert got == {1: ("FAIT", 1, 1, 0, 90), 2: ("FAIT", 1, 1, 0, None), 3: ("ANNULE", 0, 0, 0, None), 4: ("VALIDE", 0, 0, 0, None),
                   5: ("ANOMALIE", 0, int(planned), 1, None), 6: ("PREVU", 0, 1, 0, None), 8: ("FAIT", 1, 1, 0, None),
                   10: (None, 0, 0, 0, None)}  # 9 has no person


def test_repeated_line_rows_add_up(spark):
    task = spark.createDataFrame([(1, 101, 1, "1", T0, 7, None, None, None, None, T0, T0), (2, 101, 2, "1", T0, 7, None, None, None, None, T0, T0),
                                  (3, 101, 1, "0", T0, 7, None, None, None, None, T0, T0), (4, 101, 1, "1", None, 7, None, None, None, None, T0, T0)],
                                 "idtask int, idtask_type int, idtask_status int, code_status_record string, real_start_date timestamp_ntz, "
                                 "idcompany_peer int, idproduct_source long, idproduct_destination long, type_product_source string, "
                                 "type_product_destination string, updated_at timestamp_ntz, created_at timestamp_ntz")
    lines = spark.createDataFrame([(11, 1, 5, 2.0, 3, 1, 9.0)] * 2 + [(12, 1, 6, 1.0, 1, 1, 9.0), (21, 2, 5, 1.0, 1, 1, 9.0)],
                                  "idtask_has_product int, idtask int, idproduct int, real_quantity double, unit_coeff_multi int, "
                                  "unit_coeff_div int, net_price double")
    products = spark.createDataFrame([(5, "P5", 2.5)], "idproduct int, code string, purchase_unit_price double")
    statuses = spark.createDataFrame([(1, "FAIT")], "idtask_status int, code string")
    companies = spark.createDataFrame([(7, "C7")], "idcompany int, code string")
    got = {r.task_product_id: (r.quantity, r.valuation, r.company_code, r.product_code)
           for r in L.line_facts(L.select_tasks(task, 101), lines, products, statuses, companies).collect()}
    assert got == {11: (12.0, Decimal("30"), "C7", "P5"), 12: (1.0, None, "C7", None)}
    assert {r.task_id for r in L.line_facts(L.select_tasks(task, [101, 7], None), lines, products, statuses, companies).collect()} == {1, 2}


def test_people_of_first_lines_count(spark, tmp_path):
    """U17 reads every line: a person who stands on a task's first line alone is one of its people."""
    from fieldops.catalog import queries
    tables = {
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string", []),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double",
                     [(1, 1, 2, 1, 1.0, 1.0, 0.0), (1, 1, 4, 2, 1.0, 1.0, 0.0), (2, 1, 6, 1, 1.0, 1.0, 0.0), (2, 1, 6, 1, 1.0, 1.0, 0.0),
                      (3, 1, 3, 1, 1.0, 1.0, 0.0), (4, 1, 8, None, 1.0, 1.0, 0.0)]),
        "part": ("p_partkey long, p_retailprice double", []), "customer": ("c_custkey long", []),
        "supplier": ("s_suppkey long, s_name string", [(n, f"s{n}") for n in range(1, 9)])}
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {(r.idtask, r.resource_id, r.n_resources) for r in queries()["u17_task_person_vehicle"](spark, str(tmp_path)).collect()}
    assert got == {(1, 2, 2), (2, 6, 1), (4, 8, 1)}  # 3 has a vehicle only
