"""Schema drift, column policies, history and soft-delete landing, windowed totals."""
import datetime as dt
import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.operators.landing import apply_history, apply_soft_delete, land_batch
from ledgerloom.operators.periods import windowed_totals


def test_schema_drift_and_column_policies(spark):
    landed = spark.createDataFrame([(1, 5, Decimal("1.50"), "a")], "id int, n int, price decimal(10,2), old string")
    batch = spark.createDataFrame([(2 ** 40, 1.5, Decimal("2.1234"), "x@y", "secret")],
                                  "id bigint, n double, price decimal(12,4), email string, card string")
    out = land_batch(landed, batch, hashed=["email"], blocked=["card"])
    types = dict(out.dtypes)
    assert types == {"id": "bigint", "n": "string", "price": "decimal(12,4)", "old": "string", "email": "string"}
    rows = {r.id: r for r in out.collect()}
    assert rows[1].email is None and rows[1].price == Decimal("1.5000") and rows[1].n == "5"
    assert rows[2 ** 40].email == hashlib.sha256(b"x@y").hexdigest() and rows[2 ** 40].old is None


def test_history_mode(spark):
    days = [dt.datetime(2020, 1, d) for d in (1, 2, 3, 4)]
    schema = "id int, tier string, valid_from timestamp_ntz, valid_to timestamp_ntz"
    table = spark.createDataFrame([], schema)
    batches = [[(1, "a"), (2, "b")], [(1, "a"), (2, "c")], [(2, None), (3, "x")], [(2, None)]]
    for day, rows in zip(days, batches):
        at = F.lit(day).cast("timestamp_ntz")
        table = apply_history(table, spark.createDataFrame(rows, "id int, tier string"), ["id"], at)
    got = sorted(((r.id, r.tier, r.valid_from, r.valid_to) for r in table.collect()), key=str)
    assert got == sorted([(1, "a", days[0], None), (2, "b", days[0], days[1]), (2, "c", days[1], days[2]),
                          (2, None, days[2], None), (3, "x", days[2], None)], key=str)


def test_soft_delete_mode(spark):
    schema = "id int, v string, _deleted boolean"
    landed = spark.createDataFrame([(1, "a", False), (2, "b", False), (3, "c", None)], schema)
    batch = spark.createDataFrame([(1, "a2", False), (2, None, True), (4, "d", None)], schema)
    got = {r.id: (r.v, r._deleted) for r in apply_soft_delete(landed, batch, ["id"]).collect()}
    assert got == {1: ("a2", False), 2: ("b", True), 3: ("c", None), 4: ("d", None)}


def test_windowed_totals_skip_no_calendar_period(spark):
    rows = [("a", dt.date(2020, m, 5), m) for m in (1, 2, 5, 6)] + [("b", dt.date(2020, 5, 1), 7)]
    df = spark.createDataFrame(rows, "k string, day date, v int")
    run = {(r.k, r.period.month): r.windowed for r in windowed_totals(df, "day", "v", by=["k"]).collect()}
    assert run == {("a", 1): 1, ("a", 2): 3, ("a", 5): 8, ("a", 6): 14, ("b", 5): 7}
    last = {(r.k, r.period.month): r.windowed for r in
            windowed_totals(df, "day", "v", by=["k"], trailing=3).collect()}
    assert last == {("a", 1): 1, ("a", 2): 3, ("a", 5): 5, ("a", 6): 11, ("b", 5): 7}


def test_history_mode_and_null_keys(spark):
    schema = "id int, tier string, valid_from timestamp_ntz, valid_to timestamp_ntz"
    table = spark.createDataFrame([], schema)
    for day in (1, 2, 3):
        at = F.lit(dt.datetime(2020, 1, day)).cast("timestamp_ntz")
        rows = [(None, "a" if day < 3 else "b"), (1, "x")]
        table = apply_history(table, spark.createDataFrame(rows, "id int, tier string"), ["id"], at)
    got = sorted(((r.id, r.tier, r.valid_to is None) for r in table.collect()), key=str)
    assert got == sorted([(None, "a", False), (None, "b", True), (1, "x", True)], key=str)


def test_soft_delete_of_a_key_that_is_live_and_deleted_in_one_batch(spark):
    schema = "id int, v string, _deleted boolean"
    landed = spark.createDataFrame([(1, "a", False), (None, "n", False)], schema)
    batch = spark.createDataFrame([(1, "a2", False), (1, "a3", True), (None, "n2", False), (5, "x", True)], schema)
    got = {r.id: (r.v, r._deleted) for r in apply_soft_delete(landed, batch, ["id"]).collect()}
    assert got == {1: ("a", True), None: ("n2", False)}
