import pytest
from pyspark.sql import functions as F

from tallyforge.operators import contract as ct
from tallyforge.operators import drift
from tallyforge.operators.contract import WORKOUT_INPUT, WORKOUT_TRAINING, Check, Contract, ContractError, Field
from tallyforge.session import scratch_path

GOOD = (1, "male", 30, 180.0, 80.0, 20.0, 100.0, 40.0)
NAMES = "User_ID long, Gender string, Age long, Height double, Weight double, Duration double, Heart_Rate double, Body_Temp double"


@pytest.fixture(scope="module")
def people(spark):
    bad = [(2, "m", 30, 180.0, 80.0, 20.0, 100.0, 40.0), (3, "female", 201, 20.0, 80.0, 20.0, 100.0, 40.0),
           (4, None, 30, 180.0, float("nan"), 20.0, 100.0, 42.5)]
    return spark.createDataFrame([GOOD, *bad], NAMES)


def cases(df):
    return sorted((r["User_ID"], r["column"], r["check_rule"]) for r in df.collect())


def test_failures_are_collected_in_one_scan(people):
    found = WORKOUT_INPUT.failures(people)
    assert cases(found) == [(2, "Gender", "isin"), (3, "Age", "in_range"), (3, "Height", "in_range"),
                            (4, "Gender", "not_nullable"), (4, "Weight", "not_nullable")]
    assert WORKOUT_INPUT.summary(people).first()["error_rate"] == 0.75
    assert [r["User_ID"] for r in WORKOUT_INPUT.drop_invalid(people).collect()] == [1]
    assert WORKOUT_INPUT.invalid(people).count() + WORKOUT_INPUT.drop_invalid(people).count() == people.count()


def test_structure_failures_spoil_all_rows(people):
    extra = people.withColumn("note", F.lit(1))
    report = WORKOUT_INPUT.summary(extra).first()
    assert report["unknown_index_error_count"] == 1 and report["error_rate"] == 1.0
    assert WORKOUT_TRAINING.structure_failures(people.columns) == [("Calories", "column_required")]
    assert WORKOUT_INPUT.structure_failures([*people.columns, "Age"]) == [("Age", "column_unique")]
    assert WORKOUT_INPUT.failures(extra, depth="data_only").count() == 5
    assert WORKOUT_INPUT.failures(extra, depth="schema_only").count() == 1


def test_coercion(spark):
    df = spark.createDataFrame([("1", "1.5"), ("x", "2")], "id string, v string")
    rows = Contract("c", (Field("id", "bigint"), Field("v", "double")), ("v",))
    assert [(r["column"], r["check_rule"], r["failure_value"]) for r in rows.failures(df).collect()] == [("id", "coerce_bigint", "x")]
    assert rows.summary(df).first()["invalid_record_count"] == 1
    whole = Contract("c", rows.fields, ("v",), coercion_scope="table")
    assert whole.summary(df).first()["invalid_record_count"] == 2
    assert dict(rows.drop_invalid(df).dtypes) == {"id": "bigint", "v": "double"}


def test_eager_stops_at_the_first_rule_then_key(people):
    first = WORKOUT_INPUT.first_failure(people).first()
    assert (first["User_ID"], first["column"], first["check_rule"]) == (4, "Gender", "not_nullable")


def test_route(spark, people):
    folder = scratch_path(spark, "t")
    with pytest.raises(ContractError):
        WORKOUT_INPUT.route(people, 0.5, f"{folder}/v", f"{folder}/q")
    assert spark.read.parquet(f"{folder}/q").count() == 4
    assert WORKOUT_INPUT.route(people, 0.75, f"{folder}/v", f"{folder}/q2")["invalid_record_count"] == 3
    assert spark.read.parquet(f"{folder}/v").count() == 1


def test_own_checks_and_severity(spark):
    @ct.register_check("even")
    def even(col):
        return col % 2 == 0
    df = spark.createDataFrame([(1,), (2,), (None,)], "n int")
    c = Contract("own", (Field("n", "int", (Check("even", severity="warn"),), nullable=True),), ("n",))
    assert [r["n"] for r in c.failures(df).collect()] == [1]
    assert c.drop_invalid(df).count() == 3


def test_draft_contract_accepts_its_own_data(spark, sf):
    from tallyforge.operators.profile import infer_contract
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_quantity", "l_discount", "l_returnflag")
    rules = infer_contract(lines).collect()
    drafted = ct.contract_from_rules("lines", rules, ["l_quantity"])
    assert drafted.summary(lines).first()["failure_count"] == 0
    assert "l_discount" not in [f.name for f in ct.contract_from_rules("x", rules, [], "l_discount", False).fields]


def test_tiers(spark):
    rates = spark.createDataFrame([(0.0,), (0.0099,), (0.01,), (0.05,), (0.0501,)], "r double")
    got = [r[0] for r in rates.select(ct.policy_tier(F.col("r"))).collect()]
    assert got == ["drop", "drop", "quarantine", "quarantine", "stop"]


SPLITS = ("train", "val", "test")


@pytest.mark.parametrize("share,failing,summaries,passed", [
    (0.0, None, 1, True), (0.5, None, 1, False), (0.0, "val", 1, False), (0.0, None, 0, False), (0.0, None, 2, False),
    (float("nan"), None, 1, False), (-0.1, None, 1, False)])
def test_gate(spark, share, failing, summaries, passed):
    overall = "FAILED" if failing else "PASSED"
    validation = spark.createDataFrame([(s, "FAILED" if s == failing else "PASSED", int(s == failing), overall) for s in SPLITS],
                                       "split string, status string, error_count long, overall_status string")
    summary = spark.createDataFrame([(share, 0.5)] * summaries, "drift_share double, threshold double")
    row = drift.gate(validation, summary).first()
    assert row["passed"] is passed
    missing = drift.gate(validation.where("split <> 'test'"), summary).first()
    assert missing["passed"] is False


def test_drafted_values_may_hold_commas(spark):
    from tallyforge.operators.profile import infer_contract
    df = spark.createDataFrame([(1, "a,b"), (2, 'c"d')], "id long, kind string")
    drafted = ct.contract_from_rules("t", infer_contract(df).collect(), ["id"])
    assert drafted.summary(df).first()["failure_count"] == 0


def test_group_checks_and_contracts_by_name(spark):
    @ct.register_group_check("mean_at_most")
    def mean_at_most(column, limit):
        return F.avg(column) <= limit

    df = spark.createDataFrame([(1, 4.0), (2, 8.0)], "id long, x double")
    for limit, failures in ((6.0, 0), (5.0, 1)):
        one = ct.register_contract(Contract("small", (), ("id",), group_checks=(ct.GroupCheck("mean_at_most", {"column": "x", "limit": limit}),)))
        assert ct.contract_named("small") is one
        assert one.summary(df).first()["failure_count"] == failures
    with pytest.raises(ValueError, match="unknown group check"):
        ct.GroupCheck("nothing")
    with pytest.raises(ValueError, match="unknown contract"):
        ct.contract_named("nothing")
    assert ct.contract_named("workout_input") is WORKOUT_INPUT
