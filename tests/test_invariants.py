"""The reference's own row invariants (its `expression_is_true` checks) asserted on our marts,
plus hand-made demand histories for the classification / forecast edge cases."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fieldops.catalog import load_all
from fieldops.plans import supply as sp

SF = "/root/testdata/sf0.001"
REG = load_all()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def bad_rows(df, cond):
    return df.where(~F.coalesce(cond, F.lit(False))).count()


def test_backtest_absolute_error(spark):
    df = REG["k10_walk_forward_backtest"].fn(spark, SF)
    assert bad_rows(df, F.col("erreur_absolue") == F.round(F.abs(F.col("erreur")), 2)) == 0


def test_reorder_packs_cover_quantity(spark):
    df = REG["k11_reorder_point"].fn(spark, SF)
    cond = F.col("quantite_a_commander_conditionnee") * F.col("coeff_conditionnement") >= F.col("quantite_a_commander") - 1e-9
    assert bad_rows(df, cond) == 0
    assert bad_rows(df, F.col("statut_reappro").isin("exclu", "rupture", "a_commander", "ok")) == 0


def test_flows_stock_total(spark):
    df = REG["k15_monthly_flows"].fn(spark, SF)
    assert bad_rows(df, F.col("stock_total") == F.col("stock_depots") + F.col("stock_vans")) == 0


def test_repair_flag_matches_rank(spark):
    df = REG["k24_repair_episodes"].fn(spark, SF)
    assert bad_rows(df, F.col("is_repair") == (F.col("episode_rank") > 1)) == 0


def _demand(spark, rows):
    return spark.createDataFrame(
        [(1, pid, f"ART{pid}", dt.date(y, m, 1), float(q), 1) for pid, y, m, q in rows],
        "company_id long, product_id long, product_code string, demande_mois date, quantite_demandee double, nb_mouvements long")


def test_classification_edge_cases(spark):
    rows = [(1, 2001, 5, 10)]                                        # one month → indetermine
    rows += [(2, 2001, 3, 10), (2, 2001, 4, 10), (2, 2001, 5, 10)]   # constant demand → CV² = 0, regular
    rows += [(3, 2000, 1, 5), (3, 2000, 7, 50), (3, 2001, 1, 5)]     # sparse & variable → lumpy
    dm = _demand(spark, rows)
    products = spark.createDataFrame([(i, f"p{i}", "OWN", None, "OUI", "OUI", "OUI", 10.0) for i in (1, 2, 3)],
                                     "product_id long, product_name string, product_owner string, product_family string, "
                                     "product_exploit string, product_planoete string, product_planohiver string, "
                                     "purchase_unit_price double")
    depots = spark.createDataFrame([(1, "D1", "Depot 1")], "company_id long, company_code string, company_name string")
    seasons = spark.range(1, 54).select(F.col("id").cast("int").alias("numero_semaine"), F.lit("ete").alias("saison"))
    cl = {r.product_id: r for r in sp.classify_articles(dm, products, depots, seasons, dt.date(2001, 6, 1)).collect()}
    assert cl[1].classe_demande == "indetermine" and cl[1].methode_prevision == "naif"
    assert cl[2].classe_demande == "regulier" and cl[2].cv2 == 0.0 and cl[2].adi == 1.0
    assert cl[3].classe_demande == "lumpy" and cl[3].statut_vie == "inactif" and cl[3].methode_prevision == "exclu"
    fc = {r.product_id: r for r in sp.forecast(sp.classify_articles(dm, products, depots, seasons, dt.date(2001, 6, 1)),
                                                dm, dt.date(2001, 6, 1)).collect()}
    assert fc[2].demande_prevue_mensuelle == 10.0          # moving average of 3 complete months
    assert fc[1].demande_prevue_mensuelle == 10.0          # naive: Σ window / max(months, 1)
    assert fc[3].demande_prevue_mensuelle == 0.0           # excluded
