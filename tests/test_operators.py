"""Properties and brute-force checks of the distributed operators."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from legwork.operators import chain, encode, evaluate, graph, history, neighbors, profile, ranking, reshape, runs, scale, series, split, state
from legwork.plans import tuning
from legwork.registry import base
from legwork.registry import history as history_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def points(spark):
    draw = random.Random(3)
    rows = [(i, "hot" if draw.random() < 0.6 else draw.choice("ab"), draw.choice([0.0, 1.5, draw.lognormvariate(3, 2), -draw.random()]))
            for i in range(3000)]
    return rows, spark.createDataFrame(rows, "id bigint, k string, v double").repartition(5).cache()


def test_positions_and_cuts(points):
    rows, df = points
    levels = ranking.value_levels(F.col("v"))
    got = {r["id"]: (r["p"], r["p_total"]) for r in ranking.positions(df, ["k"], levels, ["v", "id"], "p", totals=True).collect()}
    groups = defaultdict(list)
    for i, k, v in rows:
        groups[k].append((v, i))
    for k, members in groups.items():
        for place, (_, i) in enumerate(sorted(members)):
            assert got[i] == (place, len(members))
    cuts = ranking.cut_rows(df, ["k"], levels, ["v", "id"], {"mid": F.floor(F.col("n") / 2), "none": F.col("n")}).collect()
    assert {(r["k"], r["v"], r["id"]) for r in cuts} == {(k, *sorted(m)[len(m) // 2]) for k, m in groups.items()}


def test_exact_quantiles(points):
    rows, df = points
    got = {r["k"]: (r["q1"], r["med"]) for r in ranking.exact_quantiles(df, ["k"], "v", {"q1": 0.25, "med": 0.5}).collect()}
    for k in got:
        values = [v for _, kk, v in rows if kk == k]
        assert np.allclose(got[k], np.quantile(values, [0.25, 0.5]))


@pytest.mark.parametrize("cell", [1, 7, 10**6])
def test_previous_row_crosses_cells(points, cell):
    rows, df = points
    found = ranking.previous_row(df, "k", F.floor(F.col("id") / cell), ["id"], ["id"], "prev").collect()
    assert len(found) == len(rows)
    last = {}
    for r in sorted(found, key=lambda r: r["id"]):
        assert (r["prev"]["id"] if r["prev"] else None) == last.get(r["k"])
        last[r["k"]] = r["id"]


def test_flight_history_of_hot_keys_equals_windows(spark):
    legs = history_queries.train(spark, SF).withColumn("Flight_Number_Reporting_Airline", F.lit(1))
    names = ["FlightID", *history.FLIGHT_HISTORY]
    cut = history.add_flight_history(legs, run_legs=40).select(*names).orderBy("FlightID").toPandas()
    plain = history.add_flight_history(legs, run_legs=10**6).select(*names).orderBy("FlightID").toPandas()
    assert len(cut) == len(plain) > 300
    np.testing.assert_allclose(cut.to_numpy(float), plain.to_numpy(float), rtol=1e-9)


def test_no_feature_sees_later_rows(spark):
    legs = base.legs(spark, SF)
    cutoff = "2024-01-15"
    early = legs.filter(F.col("FlightDate") < cutoff)
    for build in (
        lambda df: history.add_group_history(df, "Origin", "origin").select("FlightID", "FlightDate", "hist_origin_delay", "origin_lastweek_delay"),
        lambda df: state.attach_state(df, state.departures_state(df)).select("FlightID", "FlightDate", "R_dep_cum_count_sfd"),
        lambda df: chain.add_previous_leg(df).select("FlightID", "FlightDate", F.col("prev.FlightID").alias("p")),
    ):
        whole = build(legs).filter(F.col("FlightDate") < cutoff)
        assert build(early).exceptAll(whole).isEmpty()


def leg(i, tail, dep, origin, dest, **more):
    dep = datetime(2024, 1, 2) + timedelta(minutes=dep)
    row = dict(
        FlightID=i, Tail_Number=tail, Reporting_Airline="AA", Origin=origin, Dest=dest, FlightDate="2024-01-02", Cancelled=0.0, Diverted=0.0,
        CRSDepDateTime_UTC=dep, CRSArrDateTime_UTC=dep + timedelta(minutes=120), DepDateTime_UTC=dep, ArrDateTime_UTC=dep + timedelta(minutes=120),
        DepDelayMinutes=0.0, ArrDelayMinutes=0.0, LateAircraftDelay=1.0, WeatherDelay=2.0, NASDelay=3.0, CarrierDelay=4.0,
        Information_time_UTC=dep - timedelta(hours=2),
    )
    row.update(more)
    return row


LEG = (
    "FlightID bigint, Tail_Number string, Reporting_Airline string, Origin string, Dest string, FlightDate string, Cancelled double, Diverted double, "
    "CRSDepDateTime_UTC timestamp_ntz, CRSArrDateTime_UTC timestamp_ntz, DepDateTime_UTC timestamp_ntz, ArrDateTime_UTC timestamp_ntz, DepDelayMinutes double, "
    "ArrDelayMinutes double, LateAircraftDelay double, WeatherDelay double, NASDelay double, CarrierDelay double, Information_time_UTC timestamp_ntz"
)


def test_known_delay_rules(spark):
    day = datetime(2024, 1, 2)

    def at(m):
        return day + timedelta(minutes=m)

    rows = [
        leg(1, None, 600, "A", "B"), leg(2, None, 900, "B", "A"),  # no tail: no previous leg
        leg(3, "T", 600, "A", "B"), leg(4, "T", 900, "C", "A"),  # broken chain
        # planned out 600, really out 700; information at 660: 60 minutes overdue
        leg(5, "W", 600, "A", "B", DepDateTime_UTC=at(700), ArrDateTime_UTC=at(820), DepDelayMinutes=100.0, ArrDelayMinutes=100.0),
        leg(6, "W", 780, "B", "A"),
        # landed at 730 with 10 minutes delay, information at 780
        leg(7, "Z", 600, "A", "B", ArrDateTime_UTC=at(730), ArrDelayMinutes=10.0), leg(8, "Z", 900, "B", "A"),
        # should have landed at 720, still out at 780
        leg(9, "Y", 600, "A", "B", ArrDateTime_UTC=at(900), ArrDelayMinutes=180.0), leg(10, "Y", 900, "B", "A"),
    ]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], LEG)
    got = {r["FlightID"]: r for r in chain.add_chain(df).collect()}
    assert [got[i]["has_prev_flight"] for i in (2, 4, 6, 8, 10)] == [0, 0, 1, 1, 1]
    assert [got[i]["Prev_flight_DelayMinutes"] for i in (2, 4, 6, 8, 10)] == [0, 0, 60, 10, 60]
    assert [got[i]["Airplane_already_at_airport"] for i in (2, 4, 6, 8, 10)] == [0.5, 0.5, 0, 1, 0]
    assert got[4]["Time_since_last_certified_record"] == 180
    assert [got[i]["Prev_flight_has_departed"] for i in (4, 6, 8)] == [0, 0, 1]
    assert got[8]["NASDelay_prev_flight_delay_info"] == 3 and got[10]["NASDelay_prev_flight_delay_info"] == 0
    assert got[2]["Flights_before_today"] is None and got[4]["Flights_before_today"] == 1
    assert got[8]["is_Return_flight"] == 1 and got[1]["CRSTurnaroundTime"] == pytest.approx((60 + 180 + 180) / 3)


def test_turnaround_runs_the_chain_once(spark, capsys):
    rows = [leg(1, "T", 600, "A", "B"), leg(2, "T", 900, "B", "A"), leg(3, "U", 600, "A", "B")]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], LEG)
    timed = chain.add_turnaround(chain.add_previous_leg(df))
    timed.explain()
    plan = capsys.readouterr().out
    assert plan.count("Scan") == 1 and "Exchange" not in plan
    assert {r["FlightID"]: r["CRSTurnaroundTime"] for r in timed.collect()} == {1: 180, 2: 180, 3: 180}
    alone = chain.add_turnaround(chain.add_previous_leg(df.filter("FlightID <> 2")))
    assert [r["CRSTurnaroundTime"] for r in alone.collect()] == [None, None]
    assert chain.add_turnaround(chain.add_previous_leg(df.filter("FlightID > 9"))).count() == 0


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (2.0, 5.0)], "a double, b double")
    got = scale.apply_scaler(df, scale.fit_scaler(df, ["a", "b"]), ["a", "b"]).collect()
    assert [tuple(r) for r in got] == [(0.0, 0.0), (1.0, 0.0), (0.5, 0.0)]
    with pytest.raises(ValueError):
        scale.fit_scaler(df, ["a"], "robust")


def test_splits(spark):
    legs = base.legs(spark, SF)
    parts = split.chronological_split(legs, "CRSDepDateTime_UTC", "FlightID")
    n = legs.count()
    sizes = {r["split"]: r["count"] for r in parts.groupBy("split").count().collect()}
    assert sizes == {"train": int(n * 0.7), "validation": int(n * 0.85) - int(n * 0.7), "test": n - int(n * 0.85)}
    with pytest.raises(ValueError):
        split.threshold_split(legs, "CRSDepDateTime_UTC", "2019-01-01 00:00:00")
    with pytest.raises(ValueError):
        split.chronological_split(legs, "CRSDepDateTime_UTC", "FlightID", 0.9, 0.2)
    # one moment that holds every row: the id decides
    tied = legs.withColumn("CRSDepDateTime_UTC", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    tied = split.chronological_split(tied, "CRSDepDateTime_UTC", "FlightID")
    assert tied.filter("split = 'train'").count() == int(n * 0.7)


@pytest.fixture(scope="module")
def small_graph(spark):
    draw = random.Random(5)
    raw = [(0, i) for i in range(1, 40)] + [(draw.randrange(60), draw.randrange(60)) for _ in range(150)] + [(70, 71), (71, 70), (3, 3)]
    pairs = graph.undirected(spark.createDataFrame(raw, "src_id bigint, target_id bigint"))
    nodes = spark.createDataFrame([(i,) for i in (0, 5, 75)], "id bigint")
    ids = graph.all_ids(nodes)
    near = defaultdict(set)
    for a, b in raw:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    return pairs, ids, near, 76


def test_graph_metrics(small_graph):
    pairs, ids, near, n = small_graph
    degree = {r["id"]: r["degree"] for r in graph.degrees(pairs, ids).collect()}
    assert degree == {i: len(near[i]) for i in range(n)}
    assert sum(degree.values()) == 2 * pairs.count()
    found = {r["id"]: r["clustering_coeff"] for r in graph.clustering(pairs, ids).collect()}
    for i in range(n):
        d = len(near[i])
        links = sum(len(near[i] & near[j]) for j in near[i])
        assert found[i] == pytest.approx(links / (d * (d - 1)) if d > 1 else 0.0)
    labels = {r["id"]: r["component"] for r in graph.components(pairs, ids).collect()}
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        assert labels[i] == min(seen)


def test_components_of_a_long_path(spark):
    chain_ids = list(range(400))
    random.Random(2).shuffle(chain_ids)
    raw = list(zip(chain_ids, chain_ids[1:])) + [(500, 501)]
    pairs = graph.undirected(spark.createDataFrame(raw, "src_id bigint, target_id bigint"))
    ids = graph.all_ids(spark.createDataFrame([(501,)], "id bigint"))
    sizes = sorted(r["size"] for r in graph.component_sizes(graph.components(pairs, ids)).collect())
    assert sizes[-2:] == [2, 400] and sum(sizes) == 502


def peeled(near):
    core, left, k = {}, {i: set(found) for i, found in near.items()}, 0
    while left:
        i = min(left, key=lambda x: len(left[x]))
        k = max(k, len(left[i]))
        core[i] = k
        for j in left.pop(i):
            left[j].discard(i)
    return core


def test_core_number_by_peeling(small_graph):
    pairs, ids, near, n = small_graph
    core = peeled({i: near[i] for i in range(n)})
    assert {r["id"]: r["core_number"] for r in graph.core_numbers(pairs, ids).collect()} == core


def test_pagerank_by_matrix(small_graph):
    pairs, ids, near, n = small_graph
    rank = np.full(n, 1 / n)
    for _ in range(100):
        new = np.full(n, 0.15 / n + 0.85 * sum(rank[i] for i in range(n) if not near[i]) / n)
        for i in range(n):
            for j in near[i]:
                new[j] += 0.85 * rank[i] / len(near[i])
        done = np.abs(new - rank).sum() < 1e-6
        rank = new
        if done:
            break
    got = {r["id"]: r["pagerank"] for r in graph.pagerank(pairs, ids).collect()}
    assert sum(got.values()) == pytest.approx(1)
    np.testing.assert_allclose([got[i] for i in range(n)], rank, atol=1e-9)


def test_nearest_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "BLOCK_ROWS", 16)
    monkeypatch.setattr(neighbors, "LEAF_ROWS", 10)
    rng = np.random.default_rng(1)
    vectors = np.concatenate([rng.normal(c, 0.3, (60, 4)) for c in (0, 3, 9)])
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>, y int")
    train, asked = df.filter("id % 4 <> 0"), df.filter("id % 4 = 0")
    for p in (1, 2):
        found = defaultdict(list)
        for r in neighbors.nearest(train, asked, "id", "v", "y", k=5, p=p).collect():
            found[r["query_id"]].append((r["dist"], r["train_id"]))
        ids = np.array([i for i in range(len(rows)) if i % 4])
        for q in range(0, len(rows), 4):
            gap = np.abs(vectors[ids] - vectors[q])
            dist = gap.sum(axis=1) if p == 1 else np.sqrt((gap**2).sum(axis=1))
            best = ids[np.argsort(dist, kind="stable")[:5]]
            assert {i for _, i in found[q]} == set(best.tolist())


def test_neighbour_search_prunes_clustered_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "LEAF_ROWS", 64)
    rng = np.random.default_rng(2)
    vectors = np.concatenate([rng.normal(rng.normal(0, 8, 6), 0.5, (200, 6)) for _ in range(20)])
    df = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(vectors)], "id bigint, v array<double>, y int")
    train, asked = df.filter("id % 10 <> 0"), df.filter("id % 10 = 0")
    share = neighbors.visited_share(train, asked, "id", "v", "y", k=15)
    assert 0 < share < 0.3
    found = defaultdict(set)
    for r in neighbors.nearest(train, asked, "id", "v", "y", k=15).collect():
        found[r["query_id"]].add(r["train_id"])
    ids = np.array([i for i in range(len(vectors)) if i % 10])
    for q in range(0, len(vectors), 10):
        dist = np.sqrt(((vectors[ids] - vectors[q]) ** 2).sum(axis=1))
        assert found[q] == set(ids[np.argsort(dist, kind="stable")[:15]].tolist())


def test_neighbours_of_few_or_equal_rows(spark):
    kind = "id bigint, v array<double>, y int"
    few = spark.createDataFrame([(1, [0.0], 0), (2, [5.0], 1)], kind)
    asked = spark.createDataFrame([(9, [1.0], 0)], kind)
    assert sorted(r["train_id"] for r in neighbors.nearest(few, asked, "id", "v", "y", k=5).collect()) == [1, 2]
    equal = spark.createDataFrame([(i, [1.0, 1.0], i % 2) for i in range(600)], kind)
    same = spark.createDataFrame([(9, [1.0, 1.0], 0)], kind)
    assert sorted(r["train_id"] for r in neighbors.nearest(equal, same, "id", "v", "y", k=3).collect()) == [0, 1, 2]
    assert neighbors.nearest(few.filter("false"), asked, "id", "v", "y").count() == 0


def test_neighbours_among_many_copies_and_ties(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "LEAF_ROWS", 32)
    monkeypatch.setattr(neighbors, "BLOCK_NUMBERS", 8 * 100)
    monkeypatch.setattr(neighbors, "PART_NUMBERS", 8 * 10)
    rng = np.random.default_rng(4)
    vectors = rng.integers(0, 3, (700, 8)).astype(float) * 0.1  # many ties
    vectors[:300] = vectors[0]
    vectors[690:] *= 1e9
    df = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(vectors)], "id bigint, v array<double>, y int")
    train, asked = df.filter("id % 7 <> 0"), df.filter("id % 7 = 0")
    ids = np.array([i for i in range(700) if i % 7])
    for p in (1, 2):
        found = defaultdict(list)
        for r in neighbors.nearest(train, asked, "id", "v", "y", k=6, p=p).collect():
            found[r["query_id"]].append((r["dist"], r["train_id"], r["label"]))
        for q in range(0, 700, 7):
            dist = neighbors._distances(vectors[[q]], vectors[ids], p)[0]
            best = np.lexsort((ids, dist))[:6]
            assert sorted(found[q]) == [(dist[b], ids[b], ids[b] % 3) for b in best]


def test_neighbour_queries_are_sent_to_blocks_not_to_leaves(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "LEAF_ROWS", 10)
    vectors = np.random.default_rng(5).normal(0, 1, (1000, 16))  # no clusters, so every leaf is asked
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], "id bigint, v array<double>, y int")
    sent = []
    search = neighbors._search
    monkeypatch.setattr(neighbors, "_search", lambda blocks, s, k, p: sent.append(s.count()) or search(blocks, s, k, p))
    assert neighbors.nearest(df.filter("id >= 100"), df.filter("id < 100"), "id", "v", "y").count() == 1500
    assert sum(sent) < 100 * 10  # of 90 leaves only those of the first visit stand alone


def test_order_windows_need_no_shuffle_after_their_join(spark):
    df = spark.createDataFrame([(1, None, 5, 0), (2, None, 5, 1), (3, "a", None, 2), (4, "a", None, 3), (5, "a", 1, 4)], "id int, k string, c int, o int")
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    kept = {name: spark.conf.get(name) for name in plain}
    for name, value in plain.items():
        spark.conf.set(name, value)
    try:
        placed = ranking.positions(df, ["k"], [F.col("c")], ["o"], "p")
        linked = ranking.previous_row(df, "k", F.col("c"), ["o"], ["id"], "prev")
        for found in (placed, linked):
            plan = found._jdf.queryExecution().executedPlan().toString()
            above = plan[plan.index("Window"):plan.index("SortMergeJoin")]
            assert "Exchange" not in above
        assert {r["id"]: r["p"] for r in placed.collect()} == {1: 0, 2: 1, 3: 0, 4: 1, 5: 2}
        assert {r["id"]: r["prev"] and r["prev"]["id"] for r in linked.collect()} == {1: None, 2: None, 3: 5, 4: 3, 5: None}
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)


def test_rounded_spares_whole_numbers_only(spark):
    values = [None, -0.0, 3.0, -7.0, 1e300, float("inf"), 0.1234565, -2.5000005, 1e-9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r["v"] for r in df.select(*base.rounded("v")).collect()]
    assert str(got) == str([r["v"] for r in df.select(F.round("v", 6).alias("v")).collect()])


def test_series_fills_empty_days(spark):
    log = spark.createDataFrame([(1, 2, "2024-01-01 10:00:00"), (1, 3, "2024-01-04 09:00:00"), (2, 1, "2024-01-07 23:00:00")], "src int, dst int, t string")
    log = log.withColumn("datetime", F.col("t").cast("timestamp_ntz"))
    assert [r["num_messages"] for r in series.daily_counts(log).orderBy("label").collect()] == [1, 0, 0, 1, 0, 0, 1]
    assert [(str(r["label"]), r["num_messages"]) for r in series.weekly_counts(log).collect()] == [("2024-01-07", 3)]


def test_best_rows_and_first_known(spark):
    df = spark.createDataFrame([("m", "b", 1.0, None), ("m", "a", 1.0, "x"), ("m", "c", None, "y"), ("n", "d", None, None)], "g string, run string, s double, note string")
    best = {r["g"]: r["run"] for r in reshape.best_rows(df, "g", "s", "run").collect()}
    assert best == {"m": "a", "n": "d"}
    known = {r["g"]: r["note"] for r in reshape.first_known(df, "g", "s", "run").collect()}
    assert known == {"m": "x", "n": None}


def test_confusion_covers_every_row(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (3, 1), (2, 2)], "label int, prediction int")
    counts = evaluate.pair_counts(df)
    dense = evaluate.confusion(counts)
    assert dense.count() == 16 and dense.agg(F.sum("rows")).first()[0] == 4
    head = evaluate.headline_metrics(evaluate.per_class(counts)).first()
    assert head["accuracy"] == 0.5 and head["balanced_accuracy"] == pytest.approx((0.5 + 0 + 1) / 3)


def test_candidate_names(spark):
    df = spark.createDataFrame([(0, 1, 0.5), (1, 1, 0.6), (2, 3, 0.1)], "candidate_index int, rank_test_score int, mean_test_score double")
    assert {r["candidate_index"]: r["name"] for r in runs.rank_candidates(df).collect()} == {1: "tuned_model1", 0: "tuned_model2", 2: "tuned_model3"}


def test_mode_of_long_text_is_the_text(spark):
    rows = [("x" * 70, 1), ("x" * 70, 1), ("y" * 100, 1), (None, 1)]
    found = {r["column"]: r for r in profile.unique_profile(spark.createDataFrame(rows, "t string, n int")).collect()}
    assert (found["t"]["mode"], found["t"]["unique_values"], found["t"]["mode_share"]) == ("x" * 70, 2, 0.5)
    assert found["n"]["mode"] == "1"
    constant = profile.constant_columns(spark.createDataFrame(rows, "t string, n int")).collect()
    assert [(r["column"], r["unique_count"]) for r in constant] == [("n", 1)]


def test_distinct_counts_against_sets(spark, capsys):
    wide = -(2**63)
    rows = [(i % 7, wide if i % 3 else 2**63 - 1, float(i % 5), i / 4, i % 2 == 0, f"2020-01-{i % 20 + 1:02d}", None, i,
             float("nan") if i % 50 == 1 else None if i % 50 == 2 else float(i % 9), "x" * 80 + str(i % 6), [i % 4], -0.0 if i % 2 else 0.0)
            for i in range(1000)]
    schema = ("small int, sparse bigint, round double, fraction double, flag boolean, day string, nothing int, part bigint, "
              "holes double, long string, list array<int>, zero double")
    df = spark.createDataFrame(rows, schema).withColumn("day", F.col("day").cast("date"))
    df = df.withColumn("dense", F.when(F.col("part") != 5, F.col("part") * 90 - 40_000))
    counts = profile.distinct_counts(df)
    got = {r["column"]: (r["unique_values"], r["nan_values"]) for r in counts.collect()}
    want = {"small": (7, 0), "sparse": (2, 0), "round": (5, 0), "fraction": (1000, 0), "flag": (2, 0), "day": (20, 0),
            "nothing": (0, 1000), "part": (1000, 0), "holes": (10, 20), "long": (6, 0), "list": (4, 0), "zero": (1, 0),
            "dense": (999, 1)}
    assert got == want
    profiled = {r["column"]: (r["unique_values"], r["nan_values"]) for r in profile.unique_profile(df).collect()}
    assert profiled == want
    profile.value_counts_long(df).explain()
    assert "Generate" not in capsys.readouterr().out
    counts.explain()
    assert "Expand" not in capsys.readouterr().out
    none = profile.distinct_counts(df.limit(0)).collect()
    assert len(none) == 13 and all(r["unique_values"] == r["nan_values"] == 0 for r in none)
    assert profile.value_counts_long(df, []).count() == 0


def test_dense_numbers_become_bitmaps_per_bucket(spark, capsys):
    df = spark.range(200_000).select((F.col("id") * 2 - 77_777).alias("n"))
    counts = profile.distinct_counts(df.union(df.filter("n % 3 = 0")))
    counts.explain()
    assert "bitmap_construct_agg" in capsys.readouterr().out
    assert counts.collect()[0][:] == ("n", 200_000, 0)


def test_issues_of_columns_with_one_name(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, float("nan"))], "a int, b string, c double").toDF("a", "a", "b")
    found = {r["check"]: r["details"] for r in profile.issue_report(df).collect()}
    assert found["duplicate_columns"] == "['a']" and found["null_values"].startswith("a#2: 2 nulls")
    assert found["nan_values"].startswith("b: 1 NaNs")


def test_100000_categories_as_sparse_vectors(spark):
    df = spark.range(120_000).select("id", F.concat(F.lit("v"), F.lpad((F.col("id") % 100_001).cast("string"), 6, "0")).alias("c"), F.lit(None).cast("string").alias("none"))
    dictionary = encode.fit_dictionary(df.filter("c <> 'v100000'"), ["c", "none"])
    assert dictionary.agg(F.count("*"), F.min("index"), F.max("index"), F.countDistinct("index")).first()[:] == (100_000, 0, 99_999, 100_000)
    coded, vectors = encode.one_hot_vectors(df, dictionary, ["c", "none"])
    assert vectors == ["c_vector"] and len(coded.columns) == 4
    got = {r["id"]: r["c_vector"] for r in coded.filter("id IN (0, 7, 99999, 100000, 100001)").collect()}
    assert all(v.size == 100_000 for v in got.values())
    assert {i: v.indices.tolist() for i, v in got.items()} == {0: [0], 7: [7], 99999: [99999], 100000: [], 100001: [0]}


def test_many_categories(spark):
    df = spark.range(2500).select(F.concat(F.lit("c"), "id").alias("c"))
    assert len(encode.fit_categories(df, ["c"])["c"]) == 2500


def test_ids_are_spread(spark):
    ids = graph.all_ids(spark.createDataFrame([(5000,), (3,)], "id bigint"))
    assert ids.count() == 5001
    assert ids.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_penalty_follows_the_weighted_rows(spark):
    rows = spark.range(50).select(F.lit(2.0).alias("weight"))
    assert tuning.penalty(0.5, rows) == pytest.approx(1 / (0.5 * 100))


def test_no_leg_is_lost_without_day_or_time(spark):
    at = datetime(2024, 5, 1, 9)
    kind = ("FlightID bigint, Tail_Number string, Reporting_Airline string, Flight_Number_Reporting_Airline bigint, FlightDate string, "
            "CRSDepDateTime_UTC timestamp, ArrDelayMinutes double, Origin string, Dest string, Cancelled double, Diverted double, "
            "ArrDateTime_UTC timestamp, CRSArrDateTime_UTC timestamp, DepDateTime_UTC timestamp, DepDelayMinutes double, "
            "LateAircraftDelay double, WeatherDelay double, NASDelay double, CarrierDelay double")
    legs = [(1, "N", at), (2, "N", None), (3, None, at), (4, "N", at + timedelta(hours=3)), (5, None, None), (6, "N", at + timedelta(days=40)), (7, "N", None)]
    rows = [(i, tail, "AA", 5, None if i in (5, 6) else "2024-05-01", when, float(i), "A", "A", 0.0, 0.0, *[None] * 8) for i, tail, when in legs]
    df = spark.createDataFrame(rows, kind).repartition(3)
    per_day = {r["FlightID"]: (r["Flights_before_today"], r["total_Flights_scheduled_today"]) for r in chain.add_legs_per_day(df).collect()}
    assert per_day == {1: (0, 4), 4: (1, 4), 2: (2, 4), 7: (3, 4), 3: (None, None), 5: (None, None), 6: (None, None)}
    linked = {r["FlightID"]: r["prev"] and r["prev"]["FlightID"] for r in chain.add_previous_leg(df).collect()}
    assert linked == {1: None, 4: 1, 6: 4, 2: 6, 7: 2, 3: None, 5: None}
    # one flight number; days in order, legs without a time last in the day, legs without a day last of all
    order, seen = [1, 3, 4, 2, 7, 6, 5], {}
    for n, i in enumerate(order):
        earlier = [float(x) for x in order[:n]]
        seen[i] = (len(earlier), round(sum(earlier) / len(earlier), 6) if earlier else 0.0, float(np.median(earlier)) if earlier else 0.0)
    names = ["hist_flg_count_delay", "hist_flg_delay", "hist_flg_median_delay"]
    got = {r["FlightID"]: (r[names[0]], round(r[names[1]], 6), r[names[2]]) for r in history.add_flight_history(df).collect()}
    assert got == seen
    keyed = spark.createDataFrame([(None, 1), ("a", 2), (None, 3)], "k string, v int")
    placed = ranking.positions(keyed, ["k"], [F.lit(None).cast("int"), F.col("v")], ["v"], "p", totals=True).collect()
    assert sorted((r["v"], r["p"], r["p_total"]) for r in placed) == [(1, 0, 2), (2, 0, 1), (3, 1, 2)]
