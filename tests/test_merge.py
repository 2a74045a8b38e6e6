"""MERGE rules: clause order, null keys, ambiguous sources, null-safe differences, facts."""

import os

import pytest
from pyspark.sql import functions as F

from histkit.catalog import job_queries
from histkit.operators import facts
from histkit.operators import merge as mg
from histkit.sources import files


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_first_clause_wins_and_absent_rows(spark):
    t = frame(spark, [(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    s = frame(spark, [(1, "x"), (2, None), (4, "n")], "k int, v string")
    clauses = [mg.matched_delete(F.col("s.v").isNull()), mg.matched_update({"v": F.col("s.v")}), mg.insert_missing()]
    assert got(mg.merge(t, s, ["k"], clauses)) == [
        (1, "x", "update"),
        (2, "b", "delete"),
        (3, "c", "keep"),
        (4, "n", "insert"),
    ]
    synced = mg.sync(t, s, ["k"])
    assert {r.action: r.row_count for r in mg.merge_metrics(synced).collect()} == {"update": 2, "insert": 1, "delete": 1}


def test_null_keys_never_match(spark):
    t = frame(spark, [(None, "t"), (1, "a")], "k int, v string")
    s = frame(spark, [(None, "s"), (None, "s"), (1, "b")], "k int, v string")
    out = mg.merge(t, s, ["k"], [mg.matched_update({"v": F.col("s.v")}), mg.insert_missing()])
    assert got(out) == [(1, "b", "update"), (None, "s", "insert"), (None, "s", "insert"), (None, "t", "keep")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_absent_rows_need_a_full_join(spark):
    t = frame(spark, [(i, "t") for i in range(50)], "k int, v string")
    s = frame(spark, [(1, "x"), (99, "n")], "k int, v string")
    upsert = mg.merge(t, s, ["k"], [mg.matched_update({"v": F.col("s.v")}), mg.insert_missing()], source_unique=True)
    assert "FullOuter" not in plan(upsert) and "Window" not in plan(upsert)
    assert "FullOuter" in plan(mg.sync(t, s, ["k"], source_unique=True))


def test_a_small_source_is_broadcast(spark, tmp_path):
    spark.range(200_000).select("id", F.lit("t").alias("v")).write.parquet(f"{tmp_path}/t")
    spark.range(10).select("id", F.lit("s").alias("v")).write.parquet(f"{tmp_path}/s")
    t, s = (spark.read.parquet(f"{tmp_path}/{n}") for n in "ts")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        out = mg.merge(t, s, ["id"], [mg.matched_update({"v": F.col("s.v")}), mg.insert_missing()], source_unique=True)
        assert "BroadcastHashJoin [id" in plan(out) and "LeftOuter, BuildRight" in plan(out)
        assert {r.action: r.row_count for r in mg.merge_metrics(out).collect()} == {"keep": 199_990, "update": 10}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_null_keys_with_absent_clause(spark):
    t = frame(spark, [(None, "t"), (1, "a"), (2, "b")], "k int, v string")
    s = frame(spark, [(None, "s"), (1, "z")], "k int, v string")
    assert got(mg.sync(t, s, ["k"])) == [(1, "z", "update"), (2, "b", "delete"), (None, "s", "insert"), (None, "t", "delete")]


def test_two_source_rows_for_one_target_row_fail(spark):
    t = frame(spark, [(1, "a")], "k int, v string")
    s = frame(spark, [(1, "b"), (1, "c"), (2, "d"), (2, "e")], "k int, v string")
    with pytest.raises(Exception, match="more than one source row"):
        mg.merge(t, s, ["k"], [mg.matched_update({"v": F.col("s.v")})]).collect()
    # Rows that are only inserted may repeat, and untouched matches are no error.
    out = mg.merge(t, s, ["k"], [mg.insert_missing()])
    assert got(out) == [(1, "a", "keep"), (2, "d", "insert"), (2, "e", "insert")]


def test_scd1_keeps_create_time_and_skips_deletes(spark):
    schema = "k int, v string, envelopeType string, etl_metadata_struct struct<etl_create_est_timestamp:int, etl_update_est_timestamp:int>"
    t = frame(spark, [(1, "a", "XCreated", (1, 1)), (2, "b", "XCreated", (1, 1))], schema)
    s = frame(spark, [(1, "z", "XUpdated", (9, 9)), (2, "b", "XDeleted", (9, 9)), (3, "c", "XDeleted", (9, 9)), (4, "d", None, (9, 9))], schema)
    rows = {r.k: r for r in mg.merged_rows(mg.merge_scd1(t, s, ["k"])).collect()}
    assert set(rows) == {1, 4}
    assert tuple(rows[1].etl_metadata_struct) == (1, 9) and rows[1].v == "z"
    assert {r.k for r in mg.merged_rows(mg.merge_scd1(t, s, ["k"], deletes=False)).collect()} == {1, 2, 3, 4}


def test_null_to_value_is_a_difference(spark):
    t = frame(spark, [(1, None, "old"), (2, "b", "old")], "k int, v string, note string")
    s = frame(spark, [(1, "x"), (2, "b")], "k int, v string")
    take = {"v": F.col("s.v")}
    out = mg.merge_if_different(t, s, ["k"], {"v": "v"}, {**take, "note": F.lit(None)}, {**take, "k": F.col("s.k")})
    assert got(out) == [(1, "x", None, "update"), (2, "b", "old", "keep")]


def test_new_and_updated_with_maps(spark):
    t = frame(spark, [(1, {"a": 1, "b": 2}), (2, {"a": 1})], "k int, m map<string,int>")
    s = frame(spark, [(1, {"b": 2, "a": 1}), (2, {"a": 2}), (3, None)], "k int, m map<string,int>")
    assert sorted(r.k for r in mg.new_and_updated(s, t, ["k"]).collect()) == [2, 3]


def test_fact_stage_loaded_twice(spark):
    schema = "row_key int, trial_id int, ftre_cd string, rec_eff_ts date, rec_exp_ts date, is_latest_rec_ind string"
    d = {"eff1": "2024-01-01", "eff2": "2024-02-01", "open": "2999-12-31"}
    base = spark.createDataFrame([(1, 1, "f", d["eff1"], d["open"], "Y"), (2, 2, "f", d["eff1"], d["open"], "Y")], schema.replace("date", "string"))
    fact = base.selectExpr("row_key", "trial_id", "ftre_cd", "date(rec_eff_ts) rec_eff_ts", "date(rec_exp_ts) rec_exp_ts", "is_latest_rec_ind")
    stage = fact.where("row_key = 1").withColumns({"row_key": F.lit(10), "rec_eff_ts": F.lit(d["eff2"]).cast("date")})
    match, key = {"trial_id": "trial_id", "ftre_cd": "ftre_cd"}, {"row_key": "row_key"}
    once = mg.merged_rows(facts.expire_and_insert(fact, stage, match, key))
    rows = {r.row_key: (str(r.rec_exp_ts), r.is_latest_rec_ind) for r in once.collect()}
    assert rows == {1: ("2024-01-31", "N"), 2: ("2999-12-31", "Y"), 10: ("2999-12-31", "Y")}
    assert got(mg.merged_rows(facts.expire_and_insert(once, stage, match, key))) == got(once)


def test_fact_load_stores_its_keys(spark):
    schema = "row_key int, trial_id int, ftre_cd string, rec_eff_ts string, rec_exp_ts string, is_latest_rec_ind string"
    fact = frame(spark, [(1, 1, "f", "2024-01-01", "2999-12-31", "Y"), (2, 2, "f", "2024-01-01", "2999-12-31", "Y")], schema)
    stage = frame(spark, [(10, 1, "f", "2024-02-01", "2999-12-31", "Y"), (None, 2, "f", "2024-02-03", "2999-12-31", "Y"), (2, 2, "f", "2024-01-01", "2999-12-31", "Y")], schema)
    stored = {}

    def store(df, name):
        stored[name] = df
        return df

    how = {"match": {"trial_id": "trial_id", "ftre_cd": "ftre_cd"}, "row_key": {"row_key": "row_key"}}
    out = facts.expire_and_insert(fact, stage, **how, store=store)
    assert got(out) == got(facts.expire_and_insert(fact, stage, **how))
    assert [tuple(r) for r in stored["loaded-keys"].collect()] == [(2,)]
    assert sorted(r["_start"] for r in stored["starts"].collect()) == ["2024-02-01", "2024-02-03"]


def test_fact_load_stores_no_columns_without_values(spark, sf_dir, monkeypatch):
    stored = {}

    def store(df, name):
        stored.setdefault(name, df)
        return df

    monkeypatch.setattr(job_queries, "materialize", store)
    assert len(job_queries.fact_load(spark, sf_dir).columns) > 100
    assert len(stored["resolved"].columns) < 30


def test_fact_load_in_slices(spark, sf_dir, monkeypatch):
    whole = got(job_queries.fact_load(spark, sf_dir))
    held, kept = [], job_queries.stored_for_now

    def hold(df, name):
        held.append(df)
        return kept(df, name)

    monkeypatch.setattr(job_queries, "stored_for_now", hold)
    monkeypatch.setattr(job_queries, "SLICE_ROWS", 2500)
    assert got(job_queries.fact_load(spark, sf_dir)) == whole
    # The lines of a slice are chosen before they are joined with anything.
    filters = [x for x in held[0]._jdf.queryExecution().optimizedPlan().toString().split("\n") if "xxhash64" in x and "Filter" in x]
    assert len(held) == 3 and any("l_linenumber" in x for x in filters)


def test_slice_keeps_loaded_keys_of_other_slices(spark):
    schema = "row_key int, trial_id int, ftre_cd string, rec_eff_ts string, rec_exp_ts string, is_latest_rec_ind string"
    fact = frame(spark, [(1, 1, "f", "2024-01-01", "2999-12-31", "Y"), (2, 2, "f", "2024-01-01", "2999-12-31", "Y")], schema)
    stage = frame(spark, [(2, 1, "f", "2024-02-01", "2999-12-31", "Y"), (3, 1, "f", "2024-03-01", "2999-12-31", "Y")], schema)
    match, key = {"trial_id": "trial_id", "ftre_cd": "ftre_cd"}, {"row_key": "row_key"}
    loaded = facts.loaded_keys(fact, stage, key)
    parts = [facts.expire_and_insert(fact.where(p), stage.where(p), match, key, loaded=loaded) for p in ("trial_id = 1", "trial_id = 2")]
    assert got(parts[0].unionByName(parts[1])) == got(facts.expire_and_insert(fact, stage, match, key))


def test_shuffle_files_go_when_a_write_ends(spark, tmp_path):
    conf = "spark.sql.parquet.compression.codec"
    before = spark.conf.get(conf)
    with files.sparing_disk(spark):
        with files.stored_for_now(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts") as rows:
            folder = rows.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
            assert rows.count() == 7 and os.path.isdir(folder) and ".zstd" in rows.inputFiles()[0]
    assert not os.path.exists(folder) and spark.conf.get(conf) == before
