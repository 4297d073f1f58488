"""Raw to clean to marts on the smallest data set."""

import pytest

from finquarry import jobs
from finquarry.operators.quality import GateClosed, Rule
from finquarry.sources.banking import Bank

SF = "/root/testdata/sf0.001"


def test_layers_end_to_end(spark, tmp_path):
    clean, marts = str(tmp_path / "clean"), str(tmp_path / "marts")
    bank = Bank(spark, SF)
    counts = jobs.build_clean(bank, clean)
    assert counts["customers"] == bank.table("customer").count()
    assert counts == {n: df.count() for n, df in jobs.read_clean(spark, clean).items()}
    statuses = {r.rule_name: r.status for r in jobs.check_clean(spark, clean).collect()}
    assert statuses["customer_unique"] == "PASS" and statuses["email_filled"] == "FAIL"
    built = jobs.build_marts(spark, clean, marts, "2001-08-02", "2001-07-03")
    assert built["customer_360"] == counts["customers"]
    again = jobs.build_marts(spark, clean, marts, "2001-08-02", "2001-07-03")
    assert again == built == {n: spark.read.parquet(f"{marts}/{n}").count() for n in built}


def test_a_failed_blocking_rule_stops_the_run(spark, tmp_path):
    jobs.build_clean(Bank(spark, SF), str(tmp_path))
    with pytest.raises(GateClosed, match="customers.email_required"):
        jobs.check_clean(spark, str(tmp_path), [Rule("email_required", "customers", "completeness", "email", action="BLOCK")])
