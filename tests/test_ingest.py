"""Typed loads, rejects, managed tables and the whole deployment."""

import csv
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from veilmark.functions.sql_functions import create_masked_views, register_functions
from veilmark.operators.masking import bind_mask, masked, policy_of
from veilmark.plans.deployment import deploy
from veilmark.plans.payer_views import payer_table
from veilmark.plans.queries import as_text
from veilmark.sources import ingest, model

STAMP = datetime(2025, 6, 1)


def eligibility_row(n, cobra="false", effective="2024-01-01", premium="12.50"):
    return [
        f"E-{n}", "M-1", "S-1", "P", "Plan", "LOB", "Medical", "Gold", effective, None, None,
        "G", "Group", cobra, "true", premium, None, None, None,
    ]


@pytest.fixture
def raw(spark):
    data = [
        eligibility_row(1),
        eligibility_row(2, cobra="'false'".strip("'")),
        eligibility_row(3, effective="2024-13-01"),
        eligibility_row(4, premium="twelve", cobra="perhaps"),
        eligibility_row(5, premium="123456789.00"),
    ]
    return spark.createDataFrame(data, ingest.text_schema("eligibility"))


def test_typed_rows_and_rejects(raw):
    checked = ingest.checked(raw, "eligibility", STAMP)
    good = ingest.accepted(checked)
    assert good.schema.names == model.ELIGIBILITY.schema.names
    assert [f.dataType for f in good.schema] == [f.dataType for f in model.ELIGIBILITY.schema]
    first = good.orderBy("eligibility_id").first()
    assert first["cobra_flag"] is False
    assert first["effective_date"] == date(2024, 1, 1)
    assert first["premium_amount"] == Decimal("12.50")
    assert first["created_at"] == first["updated_at"] == STAMP
    assert good.count() == 2
    bad = ingest.rejected(checked).select("eligibility_id", "reject_reasons")
    assert rows(bad) == [
        ("E-3", "effective_date"),
        ("E-4", "cobra_flag,premium_amount"),
        ("E-5", "premium_amount"),
    ]


def test_one_time_for_a_load_without_stamp(raw):
    good = ingest.accepted(ingest.checked(raw, "eligibility"))
    times = good.select("created_at", "updated_at").collect()
    assert len({t for r in times for t in r}) == 1
    assert times[0][0] is not None


def test_positional_and_missing_columns(raw):
    nameless = raw.toDF(*[f"_{i}" for i in range(len(raw.columns))])
    checked = ingest.checked(nameless, "eligibility", STAMP, positional=True)
    assert ingest.accepted(checked).count() == 2
    with pytest.raises(ValueError):
        ingest.checked(nameless, "eligibility")
    with pytest.raises(ValueError):
        ingest.checked(nameless.drop("_0"), "eligibility", positional=True)


def test_csv_and_json(spark, tmp_path):
    csv = tmp_path / "rows.csv"
    text = (
        'E-1,M-1,S-1,P,"Plan, résumé",LOB,Medical,Gold,2024-01-01,,,G,Group,{},true,12.5,,,\n'
    )
    csv.write_text(text.format("false") + text.format("true"), encoding="utf-8")
    df = ingest.accepted(
        ingest.checked(ingest.read_csv(spark, "eligibility", str(csv)), "eligibility", STAMP)
    )
    got = df.select("plan_description", "cobra_flag", "termination_date")
    assert rows(got) == [("Plan, résumé", False, None), ("Plan, résumé", True, None)]
    json = tmp_path / "rows.json"
    json.write_text(
        '{"eligibility_id": "E-1", "cobra_flag": "false", "premium_amount": 3}\n'
        '{"eligibility_id": "E-2", "cobra_flag": false, "premium_amount": "4.5"}\n'
    )
    loaded = ingest.checked(ingest.read_json(spark, "eligibility", str(json)), "eligibility", STAMP)
    got = ingest.accepted(loaded).select("eligibility_id", "cobra_flag", "premium_amount")
    assert rows(got) == [("E-1", False, Decimal("3.00")), ("E-2", False, Decimal("4.50"))]


def damaged_csv(tmp_path, header=""):
    fields = [str(v or "") for v in eligibility_row(1)]
    line = ",".join(fields)
    lines = [
        line,
        line + ",x,y",
        ",".join(fields[:4]),
        line.replace(",Plan,", ',"Plan\nof two lines",'),
        line + '"open',
        "",
    ]
    path = tmp_path / "damaged.csv"
    path.write_text("\n".join([*([header] if header else []), *lines]))
    return str(path)


def refused(df):
    typed = ingest.checked(df, "eligibility", STAMP)
    found = rows(ingest.rejected(typed).select(ingest.REASONS, ingest.RECORD))
    return ingest.accepted(typed).count(), found


def test_damaged_csv_lines_are_rejects(spark, tmp_path):
    path = damaged_csv(tmp_path)
    n, found = refused(ingest.read_csv(spark, "eligibility", path))
    assert n == 1
    assert sorted(r for r, _ in found) == ["number of fields"] * 2 + ["open quote"] * 3
    assert sum("of two lines" in t for _, t in found) == 1
    assert any(t.endswith(",x,y") for _, t in found)


def test_quoted_line_breaks_can_be_read(spark, tmp_path):
    path = damaged_csv(tmp_path)
    df = ingest.read_csv(spark, "eligibility", path, quoted_newlines=True)
    good = ingest.accepted(ingest.checked(df, "eligibility", STAMP))
    assert "Plan\nof two lines" in [r[0] for r in good.select("plan_description").collect()]
    assert [r for r, _ in refused(df)[1]] == ["number of fields"] * 2 + ["open quote"]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def quoted_files(tmp_path, n_files=2):
    """Files whose records go over several lines and splits, read by the csv module."""
    expected = []
    for f in range(n_files):
        with open(tmp_path / f"f{f}.csv", "w", newline="") as file:
            out = csv.writer(file, lineterminator="\r\n" if f else "\n")
            for i in range(400):
                row = ["" if v is None else v for v in eligibility_row(f * 1000 + i)]
                row[4] = ["plain", 'say "hi"', "two\nlines", "a\n\n\"q\"\n" + "x" * 90 * (i % 50), '"\n"'][i % 5]
                out.writerow(row)
                expected.append((row[0], row[4]))
    return expected


def test_records_go_on_over_splits(spark, tmp_path, small_splits):
    expected = quoted_files(tmp_path)
    df = ingest.read_csv(spark, "eligibility", str(tmp_path), quoted_newlines=True)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 100
    checked = ingest.checked(df, "eligibility", STAMP)
    assert rows(ingest.accepted(checked).select("eligibility_id", "plan_description")) == sorted(expected)
    assert ingest.rejected(checked).count() == 0


def test_a_quote_nobody_closes_is_no_endless_record(spark, tmp_path, monkeypatch, small_splits):
    monkeypatch.setattr(ingest, "MOST_LINES", 100)
    quoted_files(tmp_path, 1)
    with open(tmp_path / "open.csv", "w") as file:
        file.write(",".join(v or "" for v in eligibility_row(1)) + "\n")
        file.write('E-2,"never closed\n' + "more\n" * 300)
    df = ingest.read_csv(spark, "eligibility", str(tmp_path), quoted_newlines=True)
    n, found = refused(df)
    assert n == 401
    assert len(found) == 301 and {r for r, _ in found} == {"open quote"}


def test_csv_header(spark, tmp_path):
    names = ingest.text_schema("eligibility").names
    df = ingest.read_csv(spark, "eligibility", damaged_csv(tmp_path, ",".join(names)), header=True)
    assert refused(df)[0] == 1 and len(refused(df)[1]) == 5
    path = damaged_csv(tmp_path, ",".join(reversed(names)))
    with pytest.raises(Exception, match="in order"):
        ingest.read_csv(spark, "eligibility", path, header=True).collect()


def test_damaged_json_lines_are_rejects(spark, tmp_path):
    good = '{"eligibility_id": "E-1", "premium_amount": 3}'
    bad = {
        "not one object": ['{"eligibility_id": "E-', f"[{good}]", "7", "null", good + good],
        "unknown fields": ['{"eligibility_id": "E-1", "colour": "red"}'],
        "premium_amount": ['{"eligibility_id": "E-1", "premium_amount": "x"}'],
    }
    path = tmp_path / "damaged.json"
    path.write_text("\n".join([good, "", *[t for ts in bad.values() for t in ts]]))
    n, found = refused(ingest.read_json(spark, "eligibility", str(path)))
    assert n == 1
    assert found == sorted(((r, t) for r, ts in bad.items() for t in ts), key=repr)


def test_rejects_of_typed_rows_keep_their_values(raw):
    bad = ingest.rejected(ingest.checked(raw, "eligibility", STAMP))
    texts = dict(rows(bad.select("eligibility_id", ingest.RECORD)))
    assert '"effective_date":"2024-13-01"' in texts["E-3"]
    assert '"premium_amount":"twelve"' in texts["E-4"]


def test_decimals_are_rounded(spark):
    raw = spark.createDataFrame(
        [eligibility_row(1, premium="12.345")], ingest.text_schema("eligibility")
    )
    good = ingest.accepted(ingest.checked(raw, "eligibility", STAMP))
    assert good.first()["premium_amount"] == Decimal("12.35")


def test_rejects_are_kept_without_a_path(spark, raw):
    names = deploy(spark, {"eligibility": raw}, "gov_rejects", STAMP)
    kept = spark.table(names["load_rejects"])
    assert [r[:2] for r in rows(kept)] == [
        ("eligibility", "cobra_flag,premium_amount"),
        ("eligibility", "effective_date"),
        ("eligibility", "premium_amount"),
    ]


def test_deployment_is_idempotent_and_described(spark, sf_dir, tmp_path):
    raw = {t: as_text(payer_table(spark, sf_dir, t)) for t in model.TABLES}
    spoilt = as_text(payer_table(spark, sf_dir, "claims")).limit(3)
    raw["claims"] = raw["claims"].unionByName(spoilt.withColumn("billed_amount", F.lit("much")))
    for _ in range(2):
        names = deploy(spark, raw, "gov_test", STAMP, str(tmp_path / "rejects"))
    report = {r[0]: tuple(r[1:]) for r in spark.table(names["load_report"]).collect()}
    rejects = spark.read.parquet(f"{tmp_path}/rejects/claims")
    assert rows(rejects.select("reject_reasons")) == [("billed_amount",)] * 3
    for table in model.TABLES:
        stored = spark.table(names[table])
        n_rejected = 3 if table == "claims" else 0
        assert report[table] == (raw[table].count(), n_rejected)
        assert stored.count() == raw[table].count() - n_rejected
        expected = payer_table(spark, sf_dir, table).drop("created_at", "updated_at")
        assert rows(stored.drop("created_at", "updated_at")) == rows(expected)
        comments = {c.name: c.description for c in spark.catalog.listColumns(f"gov_test.{table}")}
        assert comments == {c.name: c.comment for c in model.TABLES[table].columns}
        properties = dict(
            r[:2] for r in spark.sql(f"SHOW TBLPROPERTIES gov_test.{table}").collect()
        )
        assert model.TABLES[table].properties.items() <= properties.items()
        assert spark.catalog.getTable(f"gov_test.{table}").description == (
            model.TABLES[table].comment
        )
    assert spark.table("gov_test.column_tags").count() == 182
    assert spark.table("gov_test.masking_policy").count() == 59
    assert spark.table("gov_test.data_dictionary").count() == 154


def test_append_keeps_old_rows_and_replace_does_not(spark, sf_dir):
    ingest.create_schema(spark, "gov_append")
    providers = payer_table(spark, sf_dir, "providers")
    name = ingest.replace_table(spark, "providers", schema="gov_append")
    assert spark.table(name).count() == 0
    ingest.append_rows(spark, "providers", providers, "gov_append")
    ingest.append_rows(spark, "providers", providers, "gov_append")
    assert spark.table(name).count() == 2 * providers.count()
    ingest.replace_table(spark, "providers", providers, "gov_append")
    assert rows(spark.table(name)) == rows(providers)


def test_bucketed_tables_join_without_shuffle(spark, sf_dir):
    ingest.create_schema(spark, "gov_buckets")
    for t in ("members", "claims"):
        ingest.replace_table(
            spark, t, payer_table(spark, sf_dir, t), "gov_buckets", "member_id", 4
        )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("gov_buckets.claims").join(
            spark.table("gov_buckets.members").select("member_id", "state_code"), "member_id"
        )
        text = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in text


def test_masked_views(spark, sf_dir):
    ingest.create_schema(spark, "gov_views")
    members = payer_table(spark, sf_dir, "members")
    ingest.replace_table(spark, "members", members, "gov_views")
    register_functions(spark, "s", "gov_views")
    views = create_masked_views(spark, "members", "gov_views")
    for view, tier in zip(views, ("full", "partial", "none"), strict=True):
        assert rows(spark.table(view)) == rows(masked(members, "members", tier, "s"))
    policy = bind_mask(model.masking_policy(spark), "members", "state_code", "mask_redact")
    bound = policy_of(policy, "members")
    view = create_masked_views(spark, "members", "gov_views", ("none",), bound)[0]
    assert rows(spark.table(view)) == rows(masked(members, bound, "none", "s"))
    with pytest.raises(ValueError):
        create_masked_views(spark, "members", "gov_views", policy={"snn": "mask_ssn"})


def described(spark, name):
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return [tuple(r) for r in rows if r["col_name"] not in ("Location", "Created Time", "Name", "Table")]


def test_a_failed_replace_changes_nothing(spark, sf_dir):
    ingest.create_schema(spark, "gov_failed")
    providers = payer_table(spark, sf_dir, "providers")
    name = ingest.replace_table(spark, "providers", providers, "gov_failed")
    before, facts = rows(spark.table(name)), described(spark, name)
    bad = F.when(F.col("npi") == "N-7", F.raise_error(F.lit("bad row"))).otherwise(F.col("npi"))
    with pytest.raises(Exception, match="bad row"):
        ingest.replace_table(spark, "providers", providers.withColumn("npi", bad), "gov_failed")
    assert rows(spark.table(name)) == before
    assert described(spark, name) == facts
    assert [t.name for t in spark.catalog.listTables("gov_failed")] == ["providers"]


def test_readers_that_have_begun_keep_the_old_rows(spark, sf_dir):
    ingest.create_schema(spark, "gov_readers")
    providers = payer_table(spark, sf_dir, "providers")
    name = ingest.replace_table(spark, "providers", providers, "gov_readers")
    reader = spark.table(name).select("npi")
    before = rows(reader)
    ingest.replace_table(spark, "providers", providers.limit(3), "gov_readers")
    assert rows(reader) == before
    assert spark.table(name).count() == 3
    ingest.append_rows(spark, "providers", providers.limit(2), "gov_readers")
    assert spark.table(name).count() == 5


def test_replace_brings_descriptions_and_layout_up_to_date(spark, sf_dir):
    ingest.create_schema(spark, "gov_layout")
    providers = payer_table(spark, sf_dir, "providers")
    name = ingest.replace_table(spark, "providers", providers, "gov_layout")
    facts = described(spark, name)
    spark.sql(f"COMMENT ON TABLE {name} IS 'other'")
    spark.sql(f"ALTER TABLE {name} ALTER COLUMN npi COMMENT 'other'")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('domain' = 'other')")
    assert described(spark, name) != facts
    ingest.replace_table(spark, "providers", providers, "gov_layout")
    assert described(spark, name) == facts
    ingest.replace_table(spark, "providers", providers, "gov_layout", "npi", 3)
    assert ("Num Buckets", "3", "") in described(spark, name)
    assert spark.table(name).count() == providers.count()
    ingest.replace_table(spark, "providers", providers.limit(2), "gov_layout", "npi", 3)
    assert spark.table(name).count() == 2
