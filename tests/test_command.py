"""The command on a hand-written delivery."""

from riskmart.__main__ import main

COUNTERPARTY = "lei,legal_name,country_iso2,sector,parent_lei,inception_date\n99991,A,FR,BANKS,,2010-01-01\n99992,,DE,BANKS,99991,2011-01-01\n"
EXPOSURE = (
    "exposure_id,lei,exposure_type,amount_eur,as_of_date,maturity_date,risk_weight,ifrs9_stage,internal_rating\n"
    "EXP99991,99991,LOAN,100.5,2026-03-31,2027-03-31,0.5,STAGE_1,3\n"
    "EXP99992,99991,LOAN,-50,2026-03-31,2027-03-31,-1,STAGE_1,3\n"
)
COLLATERAL = (
    "collateral_id,exposure_id,collateral_type,value_eur,haircut_pct,valuation_date,pledge_date\n"
    "COL99991,EXP99991,CASH,10,0.1,2026-03-01,2025-01-01\n"
)


def test_delivery_twice_then_nothing(spark, tmp_path, capsys):
    source = tmp_path / "in"
    source.mkdir()
    (source / "counterparty.csv").write_text(COUNTERPARTY)
    (source / "exposure.csv").write_text(EXPOSURE)
    (source / "collateral.csv").write_text(COLLATERAL)
    args = [str(source), str(tmp_path / "lake")]

    assert main(args) == 0
    out = capsys.readouterr().out
    assert "bronze: collateral=1, counterparty=2, exposure=2" in out
    assert "silver: counterparty=2, exposure=2, collateral=1" in out
    assert "fact_rwa_aggregation=1" in out and "fact_dq_scorecard=10" in out
    rows = {tuple(c.strip() for c in line.split("|")[2:-1]) for line in out.splitlines() if line.startswith("|2")}
    assert ("counterparty", "completeness", "0.5", "2", "1") in rows
    assert ("exposure", "accuracy", "0.5", "2", "1") in rows
    assert len(rows) == 10

    assert main(args) == 0
    again = capsys.readouterr().out
    assert "bronze: collateral=0, counterparty=0, exposure=0" in again
    assert "silver: counterparty=2, exposure=2, collateral=1" in again


def test_empty_delivery(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    assert main([str(tmp_path / "in"), str(tmp_path / "lake")]) == 0
    assert "no scorecard rows" in capsys.readouterr().out
