import pytest

from tests.conftest import plan
from tests.test_masks import GOLDEN, TYPES
from veilmark.functions import sql_functions as sf
from veilmark.functions.masks import MASKS

SALT = "pepper"


def cases(spark, function):
    chosen = [c for c in GOLDEN if c[0] == function]
    df = spark.createDataFrame(
        [(i, c[1]) for i, c in enumerate(chosen)], f"i int, v {TYPES.get(function, 'string')}"
    )
    return chosen, df


@pytest.mark.parametrize("function", sorted(MASKS))
def test_functions_with_a_tier(spark, function):
    sf.register_functions(spark, SALT)
    chosen, df = cases(spark, function)
    out = df.selectExpr(
        "i", *[f"{function}(v, '{t}') AS {t}" for t in ("full", "partial", "none", "other")]
    )
    for r, (_, value, partial, none) in zip(out.orderBy("i").collect(), chosen, strict=True):
        assert r["full"] == (None if value is None else str(value))
        assert (r["partial"], r["none"], r["other"]) == (partial, none, none)
    assert "EvalPython" not in plan(out)


def test_functions_that_follow_the_session(spark):
    sf.register_session_functions(spark, SALT)
    df = spark.createDataFrame([("423-55-6789",)], "v string")
    df.createOrReplaceTempView("people")
    shown = []
    for tier in (None, "full", "partial", "none", "boss"):
        if tier:
            sf.set_session_tier(spark, tier)
        shown.append(spark.sql("SELECT mask_ssn(v) FROM people").first()[0])
    assert shown == ["XXX-XX-XXXX", "423-55-6789", "***-**-6789", "XXX-XX-XXXX", "XXX-XX-XXXX"]


def test_salt_is_required(spark):
    with pytest.raises(ValueError):
        sf.register_functions(spark, "")


def test_functions_that_test_groups_themselves(spark):
    sf.register_group_function(spark)
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION shown(v STRING) RETURNS STRING RETURN "
        "if(is_account_group_member('phi_full_access'), v, 'hidden')"
    )
    spark.createDataFrame([("a",)], "v string").createOrReplaceTempView("secrets")

    def ask():
        return spark.sql("SELECT shown(v) FROM secrets").first()[0]

    assert ask() == "hidden"
    sf.set_session_groups(spark, ["x", "phi_full_access"])
    assert ask() == "a"
    sf.set_session_groups(spark, [])
    assert ask() == "hidden"
