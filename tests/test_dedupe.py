from relaykit.operators import dedupe

SCHEMA = "table_name string, dt string, user_unique_id string, et long, params string"


def test_delivery_key_dedupe_and_anti_join(spark):
    rows = [("pay", "d", "u1", 1, "{}"), ("pay", "d", "u1", 1, "{}"), ("pay", "d", "u2", 1, "{}"),
            ("pay", "d", None, 1, "{}")]
    df = spark.createDataFrame(rows, SCHEMA)
    groups = dedupe.duplicate_groups(df).collect()
    assert len(groups) == 1 and groups[0].n == 2
    assert dedupe.drop_duplicate_events(df).count() == 3
    delivered = df.where("user_unique_id = 'u2'").select(dedupe.delivery_key().alias("delivery_key"))
    rest = dedupe.not_yet_delivered(df, delivered)
    assert sorted(r.user_unique_id or "" for r in rest.collect()) == ["", "u1", "u1"]
