import pytest

from millrace.contract import ColumnRule, ContractBook, FileContract
from millrace.operators.validation import (
    REASONS, RETRIES, STATUS, check_columns, check_files, mark_orphans, reasons_text, valid_keys, validate,
)
from millrace.sources.standard_contracts import STANDARD

ORDERS = STANDARD["orders.json"]


def order(**over):
    row = dict(order_id="o1", customer_id="1", restaurant_id="1", driver_id="1", region_id="1",
               order_amount="10.0", delivery_fee="1.0", discount_amount="0.01", total_amount="11.0",
               payment_method="cash", order_status="Delivered", order_created_at="2024-01-01 10:00:00",
               delivered_at="2024-01-01 10:30:00")
    row.update(over)
    return row


def check(spark, rows, contract=ORDERS, **options):
    df = spark.createDataFrame(rows, contract.read_schema())
    out = validate(df, contract, **options)
    return out


def reasons(df, key):
    return {r[0]: (r[1], r[2]) for r in df.select(key, STATUS, reasons_text()).collect()}


def test_edges(spark):
    rows = [order(), order(order_id="bound", discount_amount="0"),
            order(order_id="not-a-number", customer_id="NaN", delivery_fee="nan"),
            order(order_id="dec", customer_id="12.0"), order(order_id="half", customer_id="12.5"),
            order(order_id="na", order_created_at="N/A"), order(order_id="blank", order_created_at=" "),
            order(order_id="shape", order_created_at="2024-13-01 x"),
            order(order_id="enum", order_status="Lost"), order(order_id="neg", order_amount="-5"),
            order(order_id="nul", order_amount=""), order(order_id="txt", total_amount="abc")]
    got = reasons(check(spark, rows), "order_id")
    assert got["o1"] == ("VALID", "")
    assert got["bound"] == ("INVALID", "range:discount_amount")
    assert got["not-a-number"] == got["dec"] == got["blank"] == ("VALID", "")
    assert got["half"] == ("INVALID", "data_type:customer_id")
    assert got["na"] == got["shape"] == ("INVALID", "data_type:order_created_at")
    assert got["enum"] == ("INVALID", "enum:order_status")
    assert got["neg"] == ("INVALID", "range:order_amount")
    assert got["nul"] == ("INVALID", "not_allowed_nulls:order_amount")
    assert got["txt"] == ("INVALID", "data_type:total_amount")
    assert reasons(check(spark, rows, bounds="inclusive"), "order_id")["bound"] == ("VALID", "")


def test_formats_keep_leading_zero(spark):
    contract = STANDARD["customers.csv"]
    base = dict.fromkeys(contract.names)
    rows = [{**base, "customer_id": "1", "phone": "01012345678", "email": "a@b.co"},
            {**base, "customer_id": "2", "phone": "abc12345", "email": "missing@domain"},
            {**base, "customer_id": "3", "phone": "01012345678\n"}]
    got = reasons(check(spark, rows, contract), "customer_id")
    assert got[1] == ("VALID", "") and got[2] == ("INVALID", "format:email,format:phone")
    assert got[3] == ("INVALID", "format:phone")


PAIR = FileContract("pairs.csv", (ColumnRule("k", "integer", pk=True, nullable=False), ColumnRule("v", "integer")))


@pytest.mark.parametrize("policy,flagged", [("keep_last", [("a", 1), ("b", 1)]),
                                            ("all", [("a", 1), ("a", 2), ("b", 1), ("b", 2)])])
def test_duplicates(spark, policy, flagged):
    contract = FileContract("p.csv", (ColumnRule("k", pk=True), ColumnRule("v", "integer")))
    rows = [("a", "1"), ("a", "2"), ("b", "1"), ("b", "2"), ("c", "1")]
    out = check(spark, rows, contract, duplicates=policy)
    bad = out.filter(f"{STATUS} = 'INVALID'").select("k", "v").collect()
    assert sorted(map(tuple, bad)) == flagged


def test_null_keys_are_copies(spark):
    got = check(spark, [(None, "1"), (None, "2"), ("7", "1")], PAIR).select("k", reasons_text()).collect()
    assert sorted(r[1] for r in got if r[0] is None) == [
        "duplicated:k,not_allowed_nulls:k", "not_allowed_nulls:k"]


def test_identical_copies_keep_one(spark):
    out = check(spark, [("1", "5")] * 40, PAIR)
    assert out.filter(f"{STATUS} = 'VALID'").count() == 1 and out.count() == 40


def test_hot_key_against_brute_force(spark, monkeypatch):
    """Both duplicate plans give the same survivors when one key holds most rows."""
    from pyspark.sql import functions as F

    from millrace.operators import validation

    df = spark.range(3000).repartition(6).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(-1).alias("k"), (F.col("id") % 700).alias("v"),
        F.col("id").alias("w"))
    best = {}
    for r in df.collect():
        best[r.k] = max(best.get(r.k, (-1, -1)), (r.v, r.w))
    for fits in (True, False):
        monkeypatch.setattr(validation, "fits_broadcast", lambda *_: fits)
        out = validation.flag_duplicates(df, ["k"], [F.col("v"), F.col("w")]).filter("not _duplicated")
        assert {r.k: (r.v, r.w) for r in out.collect()} == best


def test_missing_column_fails_file_extra_is_kept(spark):
    df = spark.createDataFrame([("1", "x")], "k string, extra string")
    outcome = check_columns(df, PAIR)
    assert outcome.missing == ["v"] and outcome.extra == ["extra"] and not outcome.ok
    with pytest.raises(ValueError):
        validate(df, PAIR)
    wide = spark.createDataFrame([("1", "2", "x")], "k string, v string, extra string")
    assert "extra" in validate(wide, PAIR).columns


def test_file_set(spark):
    here = spark.createDataFrame([("/in/orders.json",), ("/in/notes.txt",)], "path string")
    state = dict(check_files(here, ["orders.json", "tickets.csv"]).collect())
    assert state == {"orders.json": "found", "notes.txt": "unknown", "tickets.csv": "missing"}


def test_orphans(spark):
    rows = [order(), order(order_id="o2", customer_id="99"), order(order_id="o3", customer_id=None),
            order(order_id="o4", customer_id="99", order_amount="-5")]
    parents = {"customer_id": (spark.createDataFrame([(1,), (2,)], "customer_id long"), "customer_id")}
    out = mark_orphans(check(spark, rows), parents)
    got = reasons(out, "order_id")
    assert got["o1"][0] == "VALID" and got["o3"][0] == "VALID"
    assert got["o2"] == ("ORPHAN", "orphan:customer_id")
    assert got["o4"] == ("INVALID", "range:order_amount")
    assert reasons(mark_orphans(check(spark, rows), parents, "orphan"), "order_id")["o3"][0] == "ORPHAN"
    assert {r[0] for r in valid_keys(out, ORDERS).collect()} == {"o1", "o3"}
    assert out.filter(f"{RETRIES} = 0").count() == 4 and dict(out.dtypes)[REASONS] == "map<string,array<string>>"


def test_contract_accessors():
    c = STANDARD["drivers.csv"]
    assert c.primary_keys == ["driver_id"] and c.formats == {"driver_phone": "phone"}
    assert c.ranges["rating_avg"] == (1, 5) and c.enums["shift"] == ("morning", "evening", "night")
    assert c.pii_columns == ["driver_name", "driver_phone", "national_id"]
    assert [(f.column, f.ref_table) for f in STANDARD["orders.json"].foreign_keys] == [
        ("customer_id", "DIM_CUSTOMER"), ("restaurant_id", "DIM_RESTAURANT"), ("driver_id", "DIM_DRIVER")]
    assert STANDARD["cities.csv"] is STANDARD["cities.json"]  # format by extension
    assert [c.stem for c in STANDARD.section("stream")] == ["orders", "tickets", "ticket_events"]
    assert len(STANDARD.section("master")) == 6 and STANDARD.section_for("orders.json") == "stream"


def test_contract_from_yaml(tmp_path):
    pytest.importorskip("yaml")
    text = """
batch:
  - file_name: "pets.csv"
    target_dimension: "DIM_PET"
    columns:
      - {name: "pet_id", type: "integer", pk: true, nullable: false}
      - {name: "owner", type: "integer", fk: {pk: "owner_id", target_fact: "OWNERS"}}
      - {name: "kind", expected_values: ["cat", "dog"], pii: true, format: "email"}
      - {name: "age", type: "float", range: {min: 0, max: 30}}
stream:
  - {file_name: "b.json", write_priority: 2, columns: []}
  - {file_name: "a.json", write_priority: 1, columns: []}
"""
    path = tmp_path / "c.yaml"
    path.write_text(text)
    book = ContractBook.from_yaml(str(path))
    pets = book["pets.csv"]
    assert pets.primary_keys == ["pet_id"] and pets.ranges == {"age": (0, 30)}
    assert pets.foreign_keys[0].ref_table == "OWNERS" and pets.target_dimension == "DIM_PET"
    assert [c.file_name for c in book.section("stream")] == ["a.json", "b.json"]
