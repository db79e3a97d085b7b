"""Silver entities on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sarraf.operators import conform, dedup
from sarraf.operators.ordinal import dense_ordinal, with_client
from sarraf.plans import silver

CARD_TXN = "refnum string, pan string, termid string, date string, time string, descr string, amount string"


def card_rows(spark, *given):
    base = {"refnum": "r1", "pan": "**1", "termid": " atm1 ", "date": "2024-01-02", "time": "07:00", "descr": "Retrait",
            "amount": "10"}
    return spark.createDataFrame([tuple({**base, **g}.values()) for g in given], CARD_TXN)


def test_each_bad_row_has_its_reason(spark, ctx):
    raw = card_rows(
        spark, {"refnum": "ok"}, {"refnum": "a", "termid": None}, {"refnum": "b", "amount": None},
        {"refnum": "c", "amount": "-5"}, {"refnum": None}, {"refnum": "d", "amount": "many"},
    )
    entity = silver.CARD_TRANSACTIONS
    good = silver.build(entity, raw, ctx).collect()
    bad = {r["refnum"]: r["_reason"] for r in silver.quarantine(entity, raw, ctx).collect()}
    assert [r["refnum"] for r in good] == ["ok"]
    assert bad == {"a": "null_terminal_id", "b": "null_amount", "c": "negative_amount", None: "null_refnum",
                   "d": "null_amount"}


@pytest.mark.parametrize("name", sorted(silver.ENTITIES))
def test_good_and_bad_are_all_rows(spark, ctx, name):
    """Checks never evaluate to NULL as a whole: each row is either good or bad."""
    entity = silver.ENTITIES[name]
    values = [None, "", "1", "-1", "x"]
    cells = [tuple(values[(i + j) % 5] if j != i % 9 else None for j in range(9)) for i in range(45)]
    columns = {
        "atm_master": "terminal_id", "customers": "client_id", "cards": "card_id", "card_transactions": "termid",
        "wallet_transactions": "transaction_id", "out_of_cash": "termid", "kaggle_transactions": "transaction_id",
    }
    names = [columns[name], "client_id" if name != "customers" else "gender", "amount", "transaction_amount", "refnum",
             "pan", "date", "time", "descr"]
    raw = spark.createDataFrame(cells, ", ".join(f"{n} string" for n in names))
    typed = entity.typed(raw)
    from sarraf.operators.quarantine import bad_rows, good_rows

    good = good_rows(typed, entity.checks()).count()
    bad = bad_rows(typed, entity.checks(), name, ctx.now())
    assert good + bad.count() == 45
    assert bad.filter(F.col("_reason").isNull()).count() == 0


def test_missing_columns_get_defaults(spark, ctx):
    row = silver.build(silver.CARD_TRANSACTIONS, card_rows(spark, {}), ctx).first()
    assert (row["msg_type"], row["resp_code"], row["is_successful"], row["terminal_id"]) == (210, 0, True, "ATM1")
    raw = spark.createDataFrame([("r", "t", "5 MAD")], "refnum string, termid string, amount string")
    row = silver.build(silver.OUT_OF_CASH, raw, ctx).first()
    assert (row["resp_code"], row["failure_reason"], row["is_confirmed_ooc"]) == (96, "GUICHET VIDE", True)


def test_no_raw_number_or_security_code_in_silver(spark, ctx):
    raw = spark.createDataFrame(
        [("1", "9", "4444111122223333", "123", "Crédit", "13/2020")],
        "card_id string, client_id string, card_number string, cvv string, card_type string, expires string",
    )
    row = silver.build(silver.CARDS, raw, ctx).first().asDict()
    assert not {"card_number", "cvv", "expires"} & set(row)
    assert row["card_number_masked"].endswith("3333") and "1111" not in row["card_number_masked"]
    assert (row["card_category"], row["expires_date"], row["is_expired"]) == ("CREDIT", None, None)


def test_first_synonym_wins(spark):
    raw = spark.createDataFrame(
        [("t", "A", "B", 1, 2)], "terminal_id string, governorate string, region string, extra int, _batch int"
    )
    df = conform.harmonise(raw, silver.ATM_SYNONYMS, silver.ATM_COLUMNS)
    row = df.first()
    assert row["region"] == "A" and row["extra"] == 1 and row["cash_limit"] is None and "_batch" not in df.columns


def test_colliding_names_are_an_error(spark):
    with pytest.raises(ValueError, match="collide"):
        conform.clean_columns(spark.createDataFrame([(1, 2)], ["a b", "a_b"]))


def test_wallet_flags(spark, ctx):
    raw = spark.createDataFrame(
        [("w", "ANNULATION RETRAIT", "00000 OK", "2024-01-01 10:30:00", 5.0)],
        "transaction_id string, transaction_type string, transaction_status string, transaction_date string, "
        "transaction_amount double",
    )
    row = silver.build(silver.WALLET_TRANSACTIONS, raw, ctx).first()
    assert (row["is_reversal"], row["is_cash_out"], row["is_successful"], row["transaction_hour"]) == (True, True, True, 10)


def test_text_labels_of_fraud(spark, ctx):
    raw = spark.createDataFrame([(str(i), "c", "$1.50") for i in range(4)], "id string, client_id string, amount string")
    given = spark.createDataFrame(
        [("0", True), ("1", False), ("2", True), ("2", False)], "transaction_id string, is_fraud boolean"
    )
    got = {r["transaction_id"]: r["is_fraud"] for r in silver.kaggle_transactions(raw, given, ctx).collect()}
    assert got == {"0": True, "1": False, "2": True, "3": False}


def test_equal_rows_have_one_winner_whatever_the_order(spark):
    data = [("k", dt.date(2024, 1, 1), v) for v in (3, 1, 2, None)]
    schema = "key string, day date, v int"
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, schema).repartition(3)
        assert [r["v"] for r in dedup.latest_per_key(df, "key", "day").collect()] == [1]


def test_missing_order_value_comes_last(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", dt.date(2024, 1, 1), 2)], "key string, day date, v int")
    assert dedup.latest_per_key(df, "key", "day").first()["v"] == 2


@pytest.mark.parametrize("disputed", [False, True])
def test_counts_of_kept_values(spark, rows, disputed):
    """As many rows as latest_per_key keeps: values that differ within a key, that are NULL or that tie."""
    day = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None]
    data = [("same", day[0], 9, 1), ("same", day[1], 8, 1), ("none", day[0], 9, None), ("one", day[2], 9, 2), (None, day[0], 9, 1)]
    if disputed:
        data += [("later", day[0], 9, 1), ("later", day[1], 9, 3), ("tie", day[1], 9, 1), ("tie", day[1], 8, 2),
                 ("null", day[1], 9, 5), ("null", day[0], 9, None), ("to_null", day[0], 9, 5), ("to_null", day[1], 9, None),
                 ("low", day[0], 9, -1), ("low", day[2], 9, 4), (None, day[1], 9, 6)]
    df = spark.createDataFrame(data, "key string, day date, amount int, v int").repartition(3)
    got = dedup.count_kept(df, "key", "day", lambda kept: kept.select("key", F.col("v").alias("value")))
    expected = dedup.latest_per_key(df, "key", "day").groupBy("v").agg(F.count("*"))
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("wanted", [("key", "day"), ("t",), ("a", "key"), ("t", "b"), ("c", "a")])
def test_wanted_columns_of_the_kept_rows(spark, rows, wanted):
    """The same as of whole rows, also where rows tie up to the last wanted column or are NULL there."""
    cells = (None, "1", "2")
    days = (None, dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    data = [(cells[i % 2], days[i // 2 % 3 if i % 5 else 2], cells[i * 7 % 3], cells[i // 4 % 3], cells[i // 9 % 3], cells[i % 3])
            for i in range(60)]
    data += [(f"k{i % 9}", days[i % 2], cells[i // 18 % 2], cells[i // 9 % 2], cells[-(i // 36 % 2)], cells[i % 3]) for i in range(72)]
    df = spark.createDataFrame(data, "key string, day date, a string, t string, b string, c string").repartition(5)
    whole = dedup.latest_per_key(df, "key", "day", ["t"]).select(*wanted)
    assert rows(dedup.latest_columns(df, "key", "day", wanted, ["t"])) == rows(whole)


def test_ordinals_are_dense(spark):
    ids = spark.range(5000).select(F.col("id").cast("string").alias("client_id"))
    for frame in (ids, ids.repartition(7).unionByName(ids)):
        got = dense_ordinal(frame, "client_id").agg(
            F.count("*"), F.count_distinct("ordinal"), F.min("ordinal"), F.max("ordinal")
        ).first()
        assert tuple(got) == (5000, 5000, 0, 4999)


def test_pan_without_number_has_no_client(spark):
    customers = spark.createDataFrame([("c1",), ("c2",)], "client_id string")
    pans = spark.createDataFrame([("**3",), ("**5",), ("**",), ("**0",), (None,)], "pan string")
    got = {r["pan"]: r["client_id"] for r in with_client(pans, "pan", customers).collect()}
    assert got["**3"] == got["**5"] is not None and got["**"] is got["**0"] is got[None] is None
    nobody = customers.limit(0)
    assert {r["client_id"] for r in with_client(pans, "pan", nobody).collect()} == {None}
