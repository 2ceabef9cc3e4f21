from decimal import Decimal

from pyspark.sql import functions as F

from dimforge.functions import keys as K


def test_place_key_goldens(spark):
    df = spark.createDataFrame(
        [("Niterói", "RJ"), ("São Gonçalo", "RJ"), ("  Nova\t Iguaçu  ", " rj "), (None, "RJ"),
         ("\tDuque  de\nCaxias", "RJ"), ("Straße", "de")], "name string, uf string")
    got = [r[0] for r in df.select(K.place_key("name", "uf")).collect()]
    assert got == ["NITEROI/RJ", "SAO GONCALO/RJ", "NOVA IGUACU/RJ", None, "DUQUE DE CAXIAS/RJ", "STRASSE/DE"]


def test_size_band_edges(spark):
    df = spark.createDataFrame([(None,), (99_999,), (100_000,), (500_000,), (500_001,)], "p int")
    got = [r[0] for r in df.select(K.size_band("p")).collect()]
    assert got == [K.BAND_UNKNOWN, K.BAND_SMALL, K.BAND_MEDIUM, K.BAND_MEDIUM, K.BAND_LARGE]


def test_surrogate_key_is_deterministic(spark):
    df = spark.createDataFrame([(1, 2)], "a bigint, b int")
    a = df.select(K.surrogate_key("member", "a", "b")).first()[0]
    b = df.select(K.surrogate_key("member", "a", "b")).first()[0]
    c = df.select(K.surrogate_key("other", "a", "b")).first()[0]
    assert a == b and a != c and len(a) == 32


def test_minutes_round_not_truncate(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2025-01-01 10:00:00' AS s, TIMESTAMP_NTZ'2025-01-01 11:09:42' AS e")
    assert df.select(K.minutes_between("s", "e")).first()[0] == 70   # 69.7 min


def test_minutes_are_exact_and_local(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2025-01-01 00:00:00.6' AS s, TIMESTAMP_NTZ'2025-01-01 00:00:30.5' AS e")
    assert df.select(K.minutes_between("s", "e")).first()[0] == 0     # 29.9 s
    saved = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")  # the clock changes that night
        df = spark.sql("SELECT TIMESTAMP_NTZ'2025-03-30 01:00:00' AS s, TIMESTAMP_NTZ'2025-03-30 04:00:00' AS e")
        assert df.select(K.minutes_between("s", "e")).first()[0] == 180
    finally:
        spark.conf.set("spark.sql.session.timeZone", saved)


def test_surrogate_keys_tell_parts_apart(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a", None), (None, "a"), ("a\\", "b"), ("a", "\\N"), ("a", "")],
                               "x string, y string")
    keys = [r[0] for r in df.select(K.surrogate_key("n", "x", "y")).collect()]
    assert len(set(keys)) == len(keys)


def test_status_precedence(spark):
    df = spark.createDataFrame([(True, True, None), (False, True, 1), (False, False, 1), (False, False, None)],
                               "c boolean, d boolean, e int")
    got = [r[0] for r in df.select(K.trip_status("c", "d", "e")).collect()]
    assert got == [K.STATUS_CANCELLED, K.STATUS_LATE, K.STATUS_DONE, K.STATUS_RUNNING]


def test_rate_per_100k(spark):
    df = spark.createDataFrame([(2, 6_211_223), (11, 481_749), (5, 0), (3, None)], "n bigint, p int")
    got = [r[0] for r in df.select(K.rate_per_100k(F.col("n"), F.col("p"))).collect()]
    assert got == [Decimal("0.03"), Decimal("2.28"), None, None]


def test_decode_else_catches_null(spark):
    df = spark.createDataFrame([("A",), ("M",), (None,)], "c string")
    got = [r[0] for r in df.select(K.decode("c", {"A": "Office"}, "Driver")).collect()]
    assert got == ["Office", "Driver", "Driver"]
