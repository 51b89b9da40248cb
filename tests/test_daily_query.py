"""The registered daily run builds the marts and the quality layer too."""

from tributary.plans import queries as Q
from tributary.session import path_exists


def test_marts_and_checks(spark, monkeypatch):
    builds = []
    run = Q.run_daily
    monkeypatch.setattr(Q, "run_daily", lambda s, r: builds.append((r, run(s, r))) or builds[-1][1])
    assert Q.QUERIES["daily_run"](spark, "/root/testdata/sf0.001").count() > 0
    for given, build in builds:
        assert {"kpi_visao_geral", "vendas_vs_dolar_mensal", "ranking_lojas"} <= set(build.gold)
        assert path_exists(spark, f"{given.warehouse_root}/quality")
