import json

import pytest
from pyspark.sql import functions as F

from rankloom.sources import catalog, state, tables
from rankloom.streaming import ingest


def test_quotas():
    assert sum(catalog.quotas("trial").values()) == 52_000 and sum(catalog.quotas("prod_like").values()) == 100_000
    assert catalog.quotas(override='{"dolly_ja": 5}')["dolly_ja"] == 5
    for bad in ('{"nobody": 1}', '{"dolly_ja": -1}', '{"dolly_ja": 1.5}', '{"dolly_ja": true}'):
        with pytest.raises(ValueError):
            catalog.quotas(override=bad)


def test_json_or_file(tmp_path):
    (tmp_path / "q.json").write_text('{"a": 1}')
    assert catalog.json_or_file(str(tmp_path / "q.json")) == {"a": 1} == catalog.json_or_file('{"a": 1}')


def test_sources_fall_back_to_the_next_place(spark, tmp_path):
    source = catalog.Source("s", "s", config="v9", data_dir="v1")
    (tmp_path / "s/v1").mkdir(parents=True)
    (tmp_path / "s/v1/x.json").write_text('{"question": "q"}\n')
    assert catalog.read_source(spark, source, str(tmp_path)).first().question == "q"
    with pytest.raises(FileNotFoundError, match="gone"):
        catalog.read_source(spark, catalog.Source("gone", "gone"), str(tmp_path))


def test_sources_give_no_other_subset_or_split(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s/x.json").write_text('{"question": "default subset"}\n')
    (tmp_path / "s/split=validation").mkdir()
    (tmp_path / "s/split=validation/x.json").write_text('{"question": "held out"}\n')
    read = lambda **more: catalog.read_source(spark, catalog.Source("s", "s", **more), str(tmp_path))
    with pytest.raises(FileNotFoundError):
        read(config="v1")
    assert read(split="validation").first().question == "held out"
    with pytest.raises(FileNotFoundError):
        read(split="test")
    (tmp_path / "p/split=validation").mkdir(parents=True)
    (tmp_path / "p/split=validation/x.json").write_text('{"question": "held out"}\n')
    with pytest.raises(FileNotFoundError):
        catalog.read_source(spark, catalog.Source("p", "p"), str(tmp_path))
    (tmp_path / "q").mkdir()
    (tmp_path / "q/x.json").write_text('{"question": "q"}\n')
    assert catalog.read_source(spark, catalog.Source("q", "q"), str(tmp_path)).first().question == "q"


def test_json_lines_with_any_blanks_and_scored_before(spark):
    lines = ["\t", '\t {"a": 1, "score": 5, "b": {"score": 2, "x": [1, "}"]}} \r', "\u3000", '{"a": 2}', '{ }']
    df = tables.parse_jsonl(spark.createDataFrame([(x,) for x in lines], "value string"), "a long")
    out = [json.loads(r[0]) for r in df.select(tables.with_fields(F.col("_line"), score=F.lit(9), more=F.lit(None).cast("string"))).collect()]
    assert out == [{"a": 1, "b": {"score": 2, "x": [1, "}"]}, "score": 9, "more": None}, {"a": 2, "score": 9, "more": None}, {"score": 9, "more": None}]
    for bad in ("[1]", "x", "\t[1]"):
        with pytest.raises(Exception, match="not a JSON object"):
            tables.parse_jsonl(spark.createDataFrame([(bad,)], "value string"), "a long").collect()


def test_read_split_finds_each_of_many(spark, tmp_path):
    path = f"{tmp_path}/many"
    spark.range(130).selectExpr("id AS x", "cast(id as string) AS split").write.parquet(path)
    assert all(tables.read_split(spark, path, str(i)).first().x == i for i in range(130))


def test_splits_and_parts(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "validation")], "x long, split string")
    path = str(tmp_path / "t")
    tables.write_table(df, path, split="split")
    assert tables.read_split(spark, path, "validation").first().x == 2
    with pytest.raises(ValueError, match="no split"):
        tables.read_split(spark, path, "test")
    with pytest.raises(ValueError, match="missing columns"):
        tables.read_split(spark, path, "train", ["y"])
    with pytest.raises(Exception, match="exist"):
        tables.write_table(df, path)
    assert tables.read_parts(spark, path).count() == 2
    log = spark.createDataFrame([(0, 1, f"{path}/split=train"), (0, 2, f"{path}/split=validation")], "part_id long, seq long, path string")
    assert tables.read_committed(spark, log).first().x == 2
    assert tables.summary(df)["total_rows"] == 2


def test_json_lines(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text('{"text": "é", "n": 1}\n\n  \n{"text": "b", "other": [1, 2]}\n{}\n')
    rows = tables.read_jsonl(spark, str(path), "text string")
    out = rows.select(tables.with_fields(F.col("_line"), score=F.lit(0.5)).alias("line"))
    tables.write_jsonl(out, str(tmp_path / "out"), "line")
    got = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert got == [{"text": "é", "n": 1, "score": 0.5}, {"text": "b", "other": [1, 2], "score": 0.5}, {"score": 0.5}]
    for bad in ("[1]", "{oops", "3"):
        path.write_text(bad + "\n")
        with pytest.raises(Exception, match="not a JSON object"):
            tables.read_jsonl(spark, str(path), "text string").collect()


def test_scores_must_cover_rows(spark):
    rows = spark.createDataFrame([(0,), (1,)], "i long")
    parts = spark.createDataFrame([(0, 0.1), (1, 0.2)], "orig_index long, score float")
    assert tables.merge_scores(rows, "i", parts).count() == 2
    for wrong, why in ((parts.limit(1), "no score"), (parts.union(parts), "several"), (parts.union(spark.createDataFrame([(9, 0.1)], "a long, b float")), "no row")):
        with pytest.raises(Exception, match=why):
            tables.merge_scores(rows, "i", wrong).collect()
    assert [r[0] for r in tables.uncovered(rows, "i", parts.where("orig_index = 0")).collect()] == [1]


def test_run_config(spark, tmp_path):
    path = str(tmp_path / "config")
    first = state.run_config(spark, path, {"seed": 1, "note": "a"}, ["seed"])
    assert state.run_config(spark, path, {"seed": 1, "note": "b"}, ["seed"]) == first
    with pytest.raises(ValueError, match="seed"):
        state.run_config(spark, path, {"seed": 2}, ["seed"])
    assert state.run_config(spark, path, {"seed": 2}, ["seed"], allow_mismatch=True) == first


def test_output_guard_and_stage_cache(spark, tmp_path):
    (tmp_path / "o").mkdir()
    (tmp_path / "o/x").write_text("")
    state.guard_output(spark, str(tmp_path / "none"))
    state.guard_output(spark, str(tmp_path / "o"), allowed=["x"])
    with pytest.raises(FileExistsError):
        state.guard_output(spark, str(tmp_path / "o"))
    made = []
    build = lambda: made.append(1) or spark.range(3)
    for config in ({"a": 1}, {"a": 1}, {"a": 2}):
        assert state.cached_stage(spark, str(tmp_path / "c"), config, build).count() == 3
    assert len(made) == 2


def test_contiguous_prefix_stops_at_a_gap(spark):
    parts = spark.createDataFrame([(0, 5), (5, 9), (10, 12), (12, 14)], "start long, end long")
    assert [r.end for r in state.contiguous_prefix(parts).orderBy("start").collect()] == [5, 9]
    assert state.contiguous_prefix(parts.where("start > 0")).count() == 0


def test_streams_append_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x long, k string")
    df.write.parquet(source)
    for rows in (2, 2, 3):
        if rows == 3:
            spark.createDataFrame([(3, "a")], "x long, k string").write.mode("append").parquet(source)
        ingest.append(ingest.file_stream(spark, source, df.schema), out, checkpoint).awaitTermination()
        assert spark.read.parquet(out).count() == rows


def test_streams_keep_the_first_of_a_key(spark, tmp_path):
    source = str(tmp_path / "in")
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "x long, k string").coalesce(1)
    df.write.parquet(source)
    query = ingest.first_seen(ingest.file_stream(spark, source, df.schema), "k").writeStream.format("memory").queryName("firsts").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {r.k for r in spark.table("firsts").collect()} == {"a", "b"} and spark.table("firsts").count() == 2


def test_summaries(spark, tmp_path):
    stats = spark.createDataFrame([("a", 3, 2), ("b", 4, 4)], "source_alias string, requested long, collected long")
    made = tables.pool_summary(stats, {"a": 3, "b": 4}, {"a": catalog.SOURCES["dolly_ja"]}, seed=42)
    tables.write_summary(spark, made, f"{tmp_path}/pool")
    got = tables.read_summary(spark, f"{tmp_path}/pool")
    assert got["total_rows"] == 6 and got["sources"][1]["collected"] == 4 and got["source_specs"]["a"]["path"] == "dolly_ja" and got["seed"] == 42
    done = spark.createDataFrame([("g", 4, True)], "generator string, committed_end long, complete boolean")
    made = tables.candidate_summary(spark.range(5), done, 2, world_size=1)
    assert made["total_rows"] == 5 and made["columns"] == ["id"] and made["generator_completion"][0]["complete"] and made["finalized_at"].endswith("+00:00")
    from rankloom.operators.labels import ScoreStats

    rows = spark.createDataFrame([("train",), ("train",), ("validation",)], "split string")
    made = tables.training_summary(rows, ScoreStats("train_zscore", 1.0, 2.0))
    assert made["splits"] == {"train": 2, "validation": 1} and made["score_normalization"]["std"] == 2.0


def test_logs_resume_and_finalise(spark, tmp_path):
    schema = "part_id long, seq long, path string, end long"
    log = f"{tmp_path}/log"
    assert state.resume_at(state.read_log(spark, log, schema)) == 0
    with pytest.raises(ValueError, match="committed"):
        state.finalise(spark, state.read_log(spark, log, schema), f"{tmp_path}/out")
    spark.createDataFrame([(1, "train")], "x long, split string").write.parquet(f"{tmp_path}/p1")
    state.append_log(spark.createDataFrame([(1, 1, f"{tmp_path}/p1", 8)], schema), log)
    state.append_log(spark.createDataFrame([(2, 2, f"{tmp_path}/gone", 16)], schema), log)
    entries = state.read_log(spark, log, schema)
    assert state.resume_at(entries) == 16 and [r.part_id for r in state.valid_parts(spark, entries).collect()] == [1]
    assert state.finalise(spark, entries, f"{tmp_path}/out").count() == 1
    with pytest.raises(FileExistsError):
        state.finalise(spark, entries, f"{tmp_path}/out")
