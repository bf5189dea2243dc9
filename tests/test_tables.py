"""Feeds, dated tables, the stream sink and the whole chain on a small store."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from pitval import schemas
from pitval.operators.pairs import PAIR_COLUMNS
from pitval.plans import forecast, recommend, resolution, valuation
from pitval.plans.ingest import ingest
from pitval.sources import feeds
from pitval.sources.store import Store
from pitval.streaming.snapshots import compact_snapshots, read_snapshots, stream_snapshots

D1, D2 = dt.date(2018, 4, 9), dt.date(2031, 9, 2)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


NAMES = "entity_id long, first_name string, last_name string"
FEED_ROWS = "feed_id long, period int, role string, player_name string, group_code string, primary_pos string"


def pit_store(store):
    """One entity, valued on two days."""
    spark = store.spark
    store.replace_for_date("registry", spark.createDataFrame([(44, "Ada", "Quill")], NAMES), D1)
    store.replace_for_date("feed", spark.createDataFrame([(7, 2018, "bat", "Ada Quill", "OAK", "C")], FEED_ROWS), D1)
    store.replace_for_date("resolutions", spark.createDataFrame([(7, 44)], "feed_id long, entity_id long"), D1)
    for day, surplus in ((D1, 12.5), (D2, 80.25)):
        made = spark.createDataFrame(
            [(44, 24, 0.5, surplus, True)],
            "entity_id long, age int, outcome_year1 double, surplus_value double, cost_estimated boolean",
        )
        store.replace_for_date("valuations", made, day)
    return store


@pytest.mark.parametrize(
    ("cutoff", "expected"),
    [("2018-04-09", [(12.5,)]), ("2025-01-01", [(12.5,)]), ("2031-12-31", [(80.25,)]), ("2018-04-08", []), (None, [(80.25,)])],
)
def test_cutoff_sees_only_what_was_known(store, cutoff, expected):
    assert rows(recommend._stored(pit_store(store), cutoff), "surplus_value") == expected


def test_later_feeds_names_and_resolutions_leave_a_past_answer(store):
    spark = pit_store(store).spark
    past = rows(recommend._stored(store, "2025-01-01"), *recommend.COLUMNS)
    store.replace_for_date("registry", spark.createDataFrame([(44, "Ida", "Quill"), (45, "Ada", "Quill")], NAMES), D2)
    store.replace_for_date("feed", spark.createDataFrame([(8, 2031, "bat", "Ida Quill", "NEW", "SS")], FEED_ROWS), D2)
    overrides = spark.createDataFrame([("Ada Quill", "OAK", 45, 0), ("Ida Quill", "NEW", 44, 1)], "player_name string, group_code string, entity_id long, seq long")
    resolution.resolve_all(store, overrides, 2031)
    assert rows(recommend._stored(store, "2025-01-01"), *recommend.COLUMNS) == past
    assert rows(recommend._stored(store, None), "name", "group_code", "primary_pos") == [("Ida Quill", "NEW", "SS")]
    # Asked for by name, a date is resolved again.
    resolution.resolve_all(store, overrides, 2031, dates=[D1])
    assert rows(store.snapshot("resolutions", D1), "entity_id") == [(45,)]


def test_the_newest_snapshot_is_found_without_old_files(store):
    pit_store(store)
    assert store.dates("valuations") == [D1, D2] and store.dates("predictions") == []
    plan = store.snapshot("valuations")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(as_of_date" in plan and str(D2) in plan and "Subquery" not in plan


def test_replay_before_any_data_is_empty(store):
    got = recommend.backtest(pit_store(store), "2011-01-01", top_n=5)
    assert got.columns == PAIR_COLUMNS
    assert got.count() == 0


def test_entity_lookup(store):
    pit_store(store)
    assert rows(recommend.entity_valuation(store, 44), "name", "as_of_date") == [("Ada Quill", D2)]
    assert recommend.entity_valuation(store, 5).count() == 0
    with pytest.raises(ValueError, match="top_n"):
        recommend.recommend(store, top_n=0)
    assert recommend.recommend(store, top_n=5000).count() == 0


def test_an_entity_with_both_roles_appears_once(spark):
    feed = spark.createDataFrame(
        [(1, "pitch", "A", "P", D1), (2, "bat", "B", "DH", D1), (3, "bat", "C", "DH", D1)],
        "feed_id long, role string, group_code string, primary_pos string, as_of_date date",
    ).withColumn("other_pos", F.lit(None).cast("string"))
    values = spark.createDataFrame([(7, D1, 30, 1.0, 5.0, False)], "entity_id long, as_of_date date, age int, outcome_year1 double, surplus_value double, cost_estimated boolean")
    registry = spark.createDataFrame([(7, "Two", "Way")], "entity_id long, first_name string, last_name string")
    ids = spark.createDataFrame([(1, 7), (2, 7), (3, 7)], "feed_id long, entity_id long")
    got = recommend.valuations_as_of(values, registry, ids, feed)
    assert rows(got, "entity_id", "group_code", "primary_pos") == [(7, "B", "DH")]


# ---- writes ---------------------------------------------------------------------


def test_rewriting_a_date_replaces_only_that_date(spark, store):
    def frame(*values):
        return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "entity_id long, surplus_value double")

    store.replace_for_date("valuations", frame(1.0, 2.0), D1)
    store.replace_for_date("valuations", frame(3.0), D2)
    store.replace_for_date("valuations", frame(4.0), D1)
    store.replace_for_date("valuations", frame(), D2)
    assert rows(store.read("valuations"), "as_of_date", "surplus_value") == [(D1, 4.0), (D2, 3.0)]


def test_missing_table_reads_as_empty(store):
    assert store.read("predictions").count() == 0
    assert store.read("predictions").schema == schemas.PREDICTIONS


def test_predictions_keep_the_higher_role_and_other_systems(spark, store):
    def frame(system, *pairs):
        return spark.createDataFrame(
            [(1, 2026, system, D1, v, r) for r, v in pairs],
            "entity_id long, period int, system string, as_of_date date, projected_outcome double, role string",
        )

    store.replace_predictions(frame("a", ("bat", 1.0), ("pitch", 2.0)))
    store.replace_predictions(frame("b", ("bat", 9.0)))
    store.replace_predictions(frame("a", ("bat", 5.0), ("pitch", 4.0)))
    assert rows(store.read("predictions"), "system", "projected_outcome") == [("a", 5.0), ("b", 9.0)]


def test_stream_takes_late_rows_and_survives_a_replay(spark, tmp_path):
    schema = "id long, v double, as_of_date date"
    source, target = str(tmp_path / "in"), str(tmp_path / "out")

    def land(*data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(source)

    def run(progress):
        stream = spark.readStream.schema(schema).parquet(source)
        stream_snapshots(stream, target, str(tmp_path / progress)).awaitTermination()
        got = read_snapshots(spark, target, spark.createDataFrame([], schema).schema, ["id"])
        return rows(got, "id", "v", "as_of_date")

    land((1, 1.0, D1), (2, 2.0, D2))
    assert run("p") == [(1, 1.0, D1), (2, 2.0, D2)]
    land((3, 3.0, D1), (2, 5.0, D2))
    late = [(1, 1.0, D1), (2, 5.0, D2), (3, 3.0, D1)]
    assert run("p") == late
    assert run("p") == late
    spark.createDataFrame([(1, 1.0, D1, 0)], schema + ", batch_id long").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("as_of_date", "batch_id").parquet(target)
    assert run("p") == late


def test_reading_a_stream_table_breaks_ties_and_keeps_the_schema(spark, tmp_path):
    schema = spark.createDataFrame([], "id long, v double, as_of_date date").schema
    source = spark.createDataFrame([(1, 1.0, D1, 0), (1, 3.0, D1, 0), (2, 5.0, D1, 0), (2, 4.0, D2, 1)], "id long, v double, as_of_date date, batch_id long")
    target, folded = str(tmp_path / "t"), str(tmp_path / "c")
    source.write.partitionBy("as_of_date", "batch_id").parquet(target)
    assert rows(read_snapshots(spark, target, schema, ["id"]), "id", "v") == [(1, 3.0), (2, 4.0)]
    assert schema.names == ["id", "v", "as_of_date"]
    compact_snapshots(spark, target, folded, schema, ["id"])
    assert rows(read_snapshots(spark, folded, schema, ["id"]), "id", "v", "as_of_date") == [(1, 3.0, D1), (2, 4.0, D2)]
    assert len(list((tmp_path / "c" / f"as_of_date={D1}").iterdir())) == 1


# ---- feeds ----------------------------------------------------------------------


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_feeds_are_read_by_header_and_missing_ones_skipped(spark, tmp_path):
    hitters = write(
        tmp_path / "h.csv",
        "EXTRA,PLAYER,TM,AGE,MAIN POS,OTHER POS,PA,AB,H,HR,BB,K,SB,AVG,OBP,SLG,OPS,R,2B,3B,RBI,CS\n"
        'x,"Smith, Al",NYM,27.0,1B,"3B,OF",600,1,2,3,4,5,6,.3,.4,.5,.9,7,8,9,10,bad\n',
    )
    got = feeds.load_feeds(spark, hitters, str(tmp_path / "none.csv"), 2026, D1, "s")
    row = got.first()
    assert (row.player_name, row.age, row.other_pos, row.pa, row.obp, row.cs) == ("Smith, Al", 27, "3B,OF", 600, 0.4, None)
    assert (row.role, row.source, row.period, row.as_of_date, row.ip) == ("bat", "s", 2026, D1, None)
    assert feeds.load_feeds(spark, str(tmp_path / "a"), str(tmp_path / "b"), 2026, D1) is None
    ids = [r.feed_id for r in feeds.with_feed_ids(got.union(got)).collect()]
    assert len(set(ids)) == 2 and all(i > 0 for i in ids)
    assert sorted(ids) == sorted(r.feed_id for r in feeds.with_feed_ids(got.union(got)).collect())
    other = got.withColumn("player_name", F.lit("Another"))
    assert not set(ids) & {r.feed_id for r in feeds.with_feed_ids(other.union(other)).collect()}


def test_large_ids_are_not_rounded(spark):
    big = (1 << 62) + 1
    df = spark.createDataFrame([(str(big), big)], "entity_id string, feed_id long")
    for name, schema in (("entity_id", schemas.REGISTRY), ("feed_id", schemas.FEED)):
        assert feeds.fit_schema(df, schema).first()[name] == big


def test_manual_files(spark, tmp_path):
    text = "player_name,team,primary_pos,mlbam_id,note\nA B,SEA,SP,12,\"says \"\"hi\"\", ok\"\nC D,,SS,,pending\n"
    got = feeds.read_overrides(spark, write(tmp_path / "o.csv", text))
    assert rows(got, "player_name", "group_code", "entity_id") == [("A B", "SEA", 12), ("C D", None, None)]
    empty = feeds.read_manual_costs(spark, write(tmp_path / "c.csv", "mlbam_id,season,salary_usd,note\n"))
    assert empty.count() == 0 and {"entity_id", "period", "cost", "seq"} <= set(empty.columns)
    assert feeds.read_manual_costs(spark, str(tmp_path / "missing.csv")).count() == 0


def test_registry_drops_sentinels_and_repeats(spark):
    raw = spark.createDataFrame(
        [("1.0", "B", "x"), ("1", "A", "x"), ("-1", "C", "x"), (None, "D", "x"), ("2", None, "x"), ("bad", "E", "x")],
        "key_mlbam string, name_first string, name_last string",
    )
    assert rows(feeds.clean_registry(raw), "entity_id", "first_name") == [(1, "A")]


def test_season_rows_keep_the_highest_volume_of_the_top_level(spark):
    raw = spark.createDataFrame(
        [
            ("Maj-AL", "5", "BOS", 100, 30), ("Maj-NL", "5.0", "COL", 200, 30), ("Min", "5", "X", 900, 30),
            (None, "5", "Y", 900, 30), ("Maj-AL", "oops", "Z", 1, 30), ("Maj-AL", "6", "SEA", None, 31),
        ],
        "Lev string, mlbID string, Tm string, PA int, Age int",
    ).withColumn("period", F.lit(2020))
    from pitval import constants as C

    got = feeds.clean_season(raw, C.SEASON_BAT_COLUMNS, "pa", "bat")
    assert rows(got, "entity_id", "group_code", "pa") == [(5, "COL", 200), (6, "SEA", None)]


def test_season_files_skip_a_failed_half(spark, tmp_path):
    bat = write(tmp_path / "b.csv", "Lev,mlbID,Tm,PA,Age\nMaj-AL,5,BOS,10,30\n")
    pitch = write(tmp_path / "p.csv", "Lev,mlbID,Tm,IP,Age\nMaj-AL,6,BOS,9.1,31\n")
    paths = {
        (2020, "bat"): bat, (2020, "pitch"): str(tmp_path / "none"),
        (2021, "bat"): str(tmp_path / "none"), (2021, "pitch"): pitch,
        (2022, "bat"): bat, (2022, "pitch"): pitch,
    }
    got = feeds.load_seasons(spark, paths, D1)
    assert rows(got, "period", "role", "entity_id") == [(2020, "bat", 5), (2022, "bat", 5), (2022, "pitch", 6)]


def test_broken_periods_are_left_out(spark, tmp_path):
    good = "Lev,mlbID,PA\nMaj-AL,5,10\n"
    paths = {(y, "bat"): write(tmp_path / f"b{y}.csv", text) for y, text in {
        2019: good, 2020: "Lev,mlbID,PA\nMaj-AL,5,10,11,12\n", 2021: "Lev,PA\nMaj-AL,10\n", 2022: good, 2023: "Lev,mlbID,PA\nMaj-AL\n",
    }.items()}
    paths |= {(y, "pitch"): write(tmp_path / f"p{y}.csv", "Lev,mlbID,IP\nMaj-AL,6,50\n") for y in range(2019, 2024)}
    paths[2022, "pitch"] = write(tmp_path / "p2022.csv", "Lev,mlbID,IP\nMaj-AL,6,50,7\n")
    got = feeds.load_seasons(spark, paths, D1)
    assert rows(got, "period", "role", "entity_id") == [(2019, "bat", 5), (2019, "pitch", 6), (2022, "bat", 5)]


def test_rows_that_arrive_later_are_resolved(spark, store):
    store.replace_for_date("registry", spark.createDataFrame([(1, "Ada", "Quill"), (2, "Ida", "Stone")], NAMES), D1)
    store.replace_for_date("outcomes", spark.createDataFrame([(1, 2026, "OAK")], "entity_id long, period int, group_code string"), D1)
    overrides = spark.createDataFrame([], "player_name string, group_code string, entity_id long, seq int")
    later = spark.createDataFrame([("Ada Quill", "OAK", 77, 1)], "player_name string, group_code string, entity_id long, seq int")

    def ingest(*feed):
        rows_ = [(i, 2026, "bat", name, "OAK", "C") for i, name in feed]
        store.replace_for_date("feed", spark.createDataFrame(rows_, FEED_ROWS), D1)

    ingest((7, "Ada Quill"), (8, "Gone Soon"))
    first = dt.date(2026, 1, 1)
    resolution.resolve_all(store, overrides, 2026, today=first)
    resolution.resolve_all(store, later, 2026, today=dt.date(2026, 2, 2))
    assert rows(store.snapshot("resolutions"), "feed_id", "entity_id", "resolved_at") == [(7, 1, first), (8, None, first)]
    ingest((7, "Ada Quill"), (9, "Ida Stone"), (10, "Ada  Quill"))
    second = dt.date(2026, 3, 3)
    resolution.resolve_all(store, later, 2026, today=second)
    # The verdict of row 7 stands, though an override would now give another one.
    assert rows(store.snapshot("resolutions"), "feed_id", "entity_id", "resolved_at") == [(10, 77, second), (7, 1, first), (9, 2, second)]


def test_many_files_of_a_date(spark, store):
    """Dates come from folder names, and only the folder asked for is read."""
    for day, value in ((D1, 1.0), (D2, 2.0)):
        frame = spark.range(40).selectExpr("id as entity_id", f"{value} as surplus_value").repartition(20)
        store.replace_for_date("valuations", frame, day)
    assert store.dates("valuations") == [D1, D2]
    for cutoff, want in ((D1, [(D1, 1.0)]), (None, [(D2, 2.0)]), (D1 - dt.timedelta(1), [])):
        got = store.snapshot("valuations", cutoff)
        assert sorted({(r["as_of_date"], r["surplus_value"]) for r in got.collect()}) == want
    assert store.snapshot("valuations", D1).count() == 40
    assert all(str(D1) in f for f in store.snapshot("valuations", D1).inputFiles())
    assert len(store.snapshot("valuations", D1).inputFiles()) < len(store.read("valuations").inputFiles())


def test_the_whole_chain(spark, store, tmp_path):
    """Ingest, resolve, forecast, value and recommend, twice for the same date."""
    common = "mlb_ID long, year_ID int, stint_ID int, name_common string, player_ID string, team_ID string, lg_ID string, G int, salary double, WAR double, WAR_rep double, WAA double"
    names = [("Al", "Ash"), ("Bo", "Birch"), ("Cy", "Cedar"), ("Di", "Doe")]
    bat = [
        (i + 1, y, 1, "n", "p", "NYM" if i % 2 else "SEA", "AL", 100, 1e6 * (i + 1), 1.0 + i + (y - 2022) / 2, 0.0, 0.0, float(i))
        for i in range(4) for y in range(2022, 2027)
    ]
    pit = [r[:-1] for r in bat]
    outcome_frames = (
        spark.createDataFrame(bat, common + ", runs_above_avg_def double"), spark.createDataFrame(pit, common),
    )
    seasons = {}
    for year in range(2022, 2026):
        seasons[year, "bat"] = write(
            tmp_path / f"b{year}.csv",
            "Lev,mlbID,Tm,PA,Age,H,HR\n" + "".join(f"Maj-AL,{i + 1},T,{400 + 10 * i + year % 7},{25 + i},{90 + i},{i}\n" for i in range(4)),
        )
        seasons[year, "pitch"] = write(
            tmp_path / f"p{year}.csv",
            "Lev,mlbID,Tm,IP,Age,ERA,W\n" + "".join(f"Maj-AL,{i + 1},T,{50 + i},{25 + i},{3 + i / 10},{year % 5}\n" for i in range(4)),
        )
    head = "PLAYER,AGE,TM,MAIN POS,OTHER POS,PA,AB,H,HR,BB,K,SB,AVG,OBP,SLG,OPS,R,2B,3B,RBI,CS\n"
    hitters = write(
        tmp_path / "hit.csv",
        head + "".join(f"{f} {n},{27 + i},{'NYM' if i % 2 else 'SEA'},1B,,{500 + i},1,{100 + i},{i},1,1,1,.3,.3,.3,.6,1,1,1,1,1\n" for i, (f, n) in enumerate(names)),
    )
    registry = spark.createDataFrame([(i + 1, f, n) for i, (f, n) in enumerate(names)], "key_mlbam long, name_first string, name_last string")
    overrides = spark.createDataFrame([], "player_name string, group_code string, entity_id long, seq long")
    manual = spark.createDataFrame([(1, 2027, 5.0, 0)], "entity_id long, period int, cost double, seq long")
    models = {role: (cols, forecast.fit_ridge) for role, (cols, _) in forecast.ROLE_MODELS.items()}
    day = dt.date(2026, 3, 1)
    for _ in range(2):
        ingest(store, day, registry, outcome_frames, seasons, (hitters, str(tmp_path / "none")), 2026)
        resolved = resolution.resolve_all(store, overrides, 2026)
        assert rows(resolved, "entity_id", "method") == [(i, "exact") for i in range(1, 5)]
        predicted = forecast.forecast(store, 2026, "ridge", day, models)
        assert rows(predicted, "entity_id") == [(1,), (2,), (3,), (4,)]
        valued = valuation.valuation_all(store, manual, 2026, "ridge", day)
        assert valued.count() == 4
    top = [r.entity_id for r in valuation.top_valued(valued, 2).collect()]
    assert top == [4, 3]
    pairs = recommend.recommend(store, top_n=3).collect()
    assert len(pairs) == 3 and all(p.group_code_a != p.group_code_b for p in pairs)
    assert recommend.backtest(store, "2026-02-01").count() == 0
    for_group = recommend.recommend(store, group="NYM").collect()
    assert for_group and all(p.group_code_a == "NYM" for p in for_group)


def test_row_ids_are_not_broadcast(spark, store, monkeypatch):
    """A table's ids may be many however small its files are: neither side of their joins goes to the driver."""
    store.replace_for_date("registry", spark.createDataFrame([(1, "Ada", "Quill")], NAMES), D1)
    store.replace_for_date("outcomes", spark.createDataFrame([(1, 2026, "OAK")], "entity_id long, period int, group_code string"), D1)
    overrides = spark.createDataFrame([], "player_name string, group_code string, entity_id long, seq int")
    plans, join = [], DataFrame.join

    def joined(self, other, on=None, how=None):
        made = join(self, other, on, how)
        if isinstance(on, str | list) and "feed_id" in on:
            plans.append(made._jdf.queryExecution().executedPlan().toString())
        return made

    monkeypatch.setattr(DataFrame, "join", joined)
    for ids in ((1, 2), (2, 3)):
        store.replace_for_date("feed", spark.createDataFrame([(i, 2026, "bat", "Ada Quill", "OAK", "SS") for i in ids], FEED_ROWS), D1)
        resolution.resolve_all(store, overrides, 2026)
    assert sorted(r["feed_id"] for r in store.read("resolutions").collect()) == [2, 3]
    # Rows of the feed's folder stand on either side of these joins.
    assert len(plans) == 8 and not any("BroadcastHashJoin" in p for p in plans)
