"""Session handling: a configured session keeps its settings; UTC is always applied."""

from plaintscope.session import apply_required, get_spark


def test_existing_session_keeps_its_settings_and_gets_utc(spark):
    key = "spark.sql.adaptive.skewJoin.enabled"
    before = spark.conf.get(key)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set(key, "false")
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        again = get_spark("again")
        assert again is spark
        assert spark.conf.get(key) == "false"
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        apply_required(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        assert spark.conf.get("spark.checkpoint.dir")
    finally:
        spark.conf.set(key, before)
        spark.conf.set("spark.sql.session.timeZone", zone)
