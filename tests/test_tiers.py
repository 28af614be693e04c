from tests.conftest import rows
from veilmark.functions.tiers import group_tiers, resolve_tier, tier_of_groups


def test_tier_of_groups():
    assert tier_of_groups(["phi_partial_access", "phi_full_access"]) == "full"
    assert tier_of_groups(["phi_partial_access", "x"]) == "partial"
    assert tier_of_groups(["PHI_FULL_ACCESS"]) == "none"
    assert tier_of_groups([]) == "none"


def test_tiers_of_principals(spark):
    groups = spark.createDataFrame(
        [
            ("both", "phi_partial_access"),
            ("both", "phi_full_access"),
            ("some", "phi_partial_access"),
            ("some", None),
            ("nothing", None),
            ("other", "analysts"),
        ],
        "principal string, group_name string",
    )
    assert rows(group_tiers(groups)) == [
        ("both", "full"),
        ("nothing", "none"),
        ("other", "none"),
        ("some", "partial"),
    ]
    assert resolve_tier(groups, "both") == "full"
    assert resolve_tier(groups, "some") == "partial"
    assert resolve_tier(groups, "nobody") == "none"
