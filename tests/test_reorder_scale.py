"""K06–K11: a mart's branches deal the monthly demand once; the backtest looks months up instead of spreading them."""
import datetime as dt
import math

from pyspark.sql import functions as F

from fieldops.operators.windows import bucketed_running
from fieldops.plans import supply as sp

DEMAND = ("company_id long, product_id long, product_code string, demande_mois date, quantite_demandee double, nb_mouvements long")
AS_OF, START = dt.date(2001, 6, 1), dt.date(2001, 1, 1)


def _demand(spark):
    """A steady pair, one whose months come twice (two codes, a missing quantity), one that starts late, one without months."""
    rows = [(1, 1, "A", dt.date(2000, m, 1), float(m), 1) for m in range(1, 13)]
    rows += [(1, 1, "A", dt.date(2001, m, 1), 10.0 * m, 1) for m in (1, 3, 4)]
    rows += [(1, 2, "B", dt.date(2000, 12, 1), 3.0, 1), (1, 2, "C", dt.date(2000, 12, 1), 4.0, 1),
             (1, 2, "B", dt.date(2001, 2, 1), None, 1), (1, 2, "C", dt.date(2001, 6, 1), 99.0, 1)]
    rows += [(2, 3, "D", dt.date(2001, 4, 1), 8.0, 1), (2, 4, "E", None, 8.0, 1), (None, 5, "F", dt.date(2001, 1, 1), 8.0, 1)]
    return spark.createDataFrame(rows, DEMAND)


def _classified(spark):
    rows = [(1, 1, "moyenne_mobile"), (1, 2, "naif"), (1, 2, "exclu"), (2, 3, "reference_saisonniere"), (2, 4, "naif"), (None, 5, "naif")]
    return spark.createDataFrame([(c, p, "c", "n", f"P{p}", "x", "actif", "A", m) for c, p, m in rows],
                                 "company_id long, product_id long, company_code string, company_name string, product_code string, "
                                 "product_name string, statut_vie string, classe_abc string, methode_prevision string")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _months(d):
    return 12 * d.year + d.month - 1


def test_backtest_rows_against_plain_loops(spark):
    demand, classes = _demand(spark).collect(), _classified(spark).collect()
    want = []
    for c in classes:
        own = [r for r in demand if (r.company_id, r.product_id) == (c.company_id, c.product_id) and r.demande_mois and c.company_id]
        for t in range(_months(START), _months(AS_OF)) if own else ():
            first = min(_months(r.demande_mois) for r in own)
            if t < first:
                continue
            at = lambda a, b: [r for r in own if a <= t - _months(r.demande_mois) <= b]
            total = lambda a, b: sum(r.quantite_demandee or 0 for r in at(a, b))
            near = len(at(1, 3))
            average, season, naive = (math.floor(x * 100 + 0.5) / 100 for x in (total(1, 3) / 3, total(10, 12) / 3, total(1, 3) / max(near, 1)))
            pick = {"exclu": 0.0, "naif": naive, "reference_saisonniere": season}.get(c.methode_prevision, average)
            want.append((c.company_id, c.product_id, c.methode_prevision, t, t - first, near, float(total(0, 0)), average, season, naive,
                         pick, round(total(0, 0) - pick, 2)))
    got = [(r.company_id, r.product_id, r.methode_prevision, _months(r.mois_cible), r.nb_mois_anciennete, r.nb_mois_avec_demande,
            r.demande_reelle, r.prevision_moyenne_mobile, r.prevision_saisonniere, r.prevision_naive, r.prevision_retenue, r.erreur)
           for r in sp.backtest(_classified(spark), _demand(spark), AS_OF, START).collect()]
    assert len(want) == 17 and sorted(got) == sorted(want)


def test_backtest_spreads_no_month(spark):
    """Its errors by pair need no shuffle where demand and classes lie by pair: targets and months are not dealt."""
    pair = ["company_id", "product_id"]
    demand, classes = (x.repartition(*pair).persist() for x in (_demand(spark), _classified(spark)))
    demand.count(), classes.count()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = _plan(sp.backtest(classes, demand, AS_OF, START).groupBy(*pair).agg(F.avg("erreur")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        demand.unpersist(), classes.unpersist()
    above = [line.split("Exchange ")[1] for line in plan.splitlines() if "Exchange hashpartitioning" in line and "REPARTITION_BY" not in line]
    assert above == []


def test_running_totals_of_a_key(spark):
    rows = [(1, i, float(i)) for i in range(10)] + [(2, 3, 5.0), (None, 1, 2.0), (None, 4, 6.0)]
    df = spark.createDataFrame(rows, "k long, i long, v double")
    got = bucketed_running(df, ["k"], ["i"], F.floor(F.col("i") / 3), sums={"run": F.col("v")}, totals={"whole": "run"}).collect()
    assert len(got) == len(rows)
    for r in got:
        own = [x for x in rows if x[0] == r.k]
        assert r.run == sum(x[2] for x in own if x[1] <= r.i) and r.whole == sum(x[2] for x in own)


def test_classification_reads_depot_totals_once(spark):
    """The kept rows are made in one place, and the class by value comes out right."""
    dm = spark.createDataFrame([(1, p, f"A{p}", dt.date(2001, m, 1), float(q), 1) for p, q in ((1, 80), (2, 15), (3, 5)) for m in (3, 4, 5)], DEMAND)
    products = spark.createDataFrame([(p, "x", "OWN", None, "OUI", "OUI", "OUI", 1.0) for p in (1, 2, 3)],
                                     "product_id long, product_name string, product_owner string, product_family string, "
                                     "product_exploit string, product_planoete string, product_planohiver string, purchase_unit_price double")
    depots = spark.createDataFrame([(1, "D1", "Depot 1")], "company_id long, company_code string, company_name string")
    seasons = spark.range(1, 54).select(F.col("id").cast("int").alias("numero_semaine"), F.lit("ete").alias("saison"))
    out = sp.classify_articles(dm, products, depots, seasons, AS_OF)
    assert {r.product_id: r.classe_abc for r in out.collect()} == {1: "A", 2: "B", 3: "C"}
    assert "InMemoryTableScan" in _plan(out)
