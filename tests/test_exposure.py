"""Views built from a classification register; new columns stay closed."""

import pytest
from pyspark.sql import functions as F

from tidewater.plans import governance as gv
from tidewater.plans.exposure import ClassificationRegister, RoleRule, exposed_view, strictest
from tidewater.session import scratch_path

RULES = [RoleRule("analyst", {"PII": "hash"}), RoleRule("owner", {"PII": "none", "PHI": "none", "PCI": "none"}),
         RoleRule("local", {"PII": "tokenize"}, "site = current_site()")]


def classified(spark, tables, run_id, register=None):
    register = register or ClassificationRegister(spark, scratch_path(spark, "er"))
    names = gv.classify_by_name(gv.column_inventory(spark, tables))
    counts = None
    for name, df in tables.items():
        part = gv.value_match_counts(df, name)
        counts = part if counts is None else counts.unionByName(part)
    register.record(tables, gv.best_per_tag(names, gv.classify_by_values(counts)), run_id)
    return register


def people(spark):
    return spark.createDataFrame([(1, "a@b.c", "4111111111111111", "x"), (2, "d@e.f", "4111111111111112", "y")],
                                 "id int, note string, card_number string, site string")


def test_tagged_columns_are_masked_by_role_and_sensitivity(spark):
    df = people(spark)
    reg = classified(spark, {"p": df}, 1)
    # note is found by its values (email), card_number by name and value
    seen = exposed_view(df, "p", reg, RULES, "analyst", "s").orderBy("id").first()
    assert seen.note == spark.range(1).select(F.sha2(F.lit("sa@b.c"), 256)).first()[0]
    assert (seen.id, seen.card_number, seen.site) == (1, gv.MASKED, "x")
    assert exposed_view(df, "p", reg, RULES, "owner").orderBy("id").first().card_number == "4111111111111111"
    assert [r.id for r in exposed_view(df, "p", reg, RULES, "local", session={"current_site": "y"}).collect()] == [2]
    with pytest.raises(gv.AccessDenied):
        exposed_view(df, "p", reg, RULES, "nobody")
    with pytest.raises(gv.AccessDenied, match="classified"):
        exposed_view(df, "other", reg, RULES, "owner")


def test_new_and_retyped_columns_are_closed_until_classified(spark):
    df = people(spark)
    reg = classified(spark, {"p": df, "q": df}, 1)
    grown = df.withColumn("more", F.lit("free text")).withColumn("id", F.col("id").cast("long"))
    for role in ("analyst", "owner"):
        r = exposed_view(grown, "p", reg, RULES, role).first()
        assert (r.more, r.id) == (gv.MASKED, gv.MASKED)
    classified(spark, {"p": grown}, 2, reg)
    r = exposed_view(grown, "p", reg, RULES, "analyst").orderBy("id").first()
    assert (r.more, r.id) == ("free text", 1)
    assert exposed_view(df, "q", reg, RULES, "owner").count() == 2       # other tables keep their last run


def test_the_strictest_tag_decides():
    t = lambda *s: [{"sensitivity": x} for x in s]
    assert strictest(t("PII", "PCI", "PHI")) == "PCI" and strictest([]) is None and strictest(t("PCI", "NEW")) == "NEW"
    with pytest.raises(ValueError):
        RoleRule("r", {"PII": "rot13"})
