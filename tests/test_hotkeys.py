from strataloom.operators import hotkeys as H


def test_heavy_keys_and_ties(spark):
    rows = [("a",)] * 3 + [("b",)] * 3 + [(None,)] * 20 + [("",)] * 20 + [("  ",)] * 20 + [(f"k{i}",) for i in range(9)]
    df = spark.createDataFrame(rows, "k string")
    got = {(r["key_field"], r["key_value"], r["n_rows"], r["n_all"]) for r in H.heavy_keys(df, ["k"]).collect()}
    assert got == {("k", "a", 3, 75), ("k", "b", 3, 75)}


def test_one_row_less_is_not_heavy_and_padding_is_another_key(spark):
    df = spark.createDataFrame([("a",)] * 3 + [(" a",)] * 2 + [(f"k{i}",) for i in range(71)], "k string")
    assert H.heavy_keys(df, ["k"]).count() == 0


def test_profile_counts_members_once(spark):
    df = spark.createDataFrame([("a", 1, "m"), ("a", 0, "m"), ("a", None, None), (None, 1, "x"), ("a", 1, "n")], "key_value string, flag bigint, member string")
    got = {(r["key_value"], r["n_rows"], r["n_flagged"], r["n_members"]) for r in H.key_profile(df, ["key_value"], "flag", "member").collect()}
    assert got == {("a", 4, 2, 2), (None, 1, 1, 1)}


def test_empty_and_very_long(spark):
    df = spark.createDataFrame([("x" * 200_000,)], "k string")
    assert H.heavy_keys(df.limit(0), ["k"]).count() == 0 and H.heavy_keys(df, ["k"]).count() == 1


def test_only_states_are_shuffled(spark, small_dir):
    from strataloom.plans.problems import KEYS
    from strataloom.runtime import table

    plan = H.key_counts(table(spark, small_dir, "tokens"), KEYS)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange")  # printed from the top: the partial counts stand below the exchange
