"""Analyses on small tables, against plain Python."""

import itertools
import math
import random
import statistics
from collections import Counter, defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from ledgerlake.analytics import baskets, churn, cohorts, forecasting, propensity, rfm
from ledgerlake.operators import edges, slices

D = Decimal


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- quantile edges -------------------------------------------------------------------------------


def plain_edges(values, parts):
    ordered = sorted(v for v in values if v is not None)
    return [ordered[-(-k * len(ordered) // parts) - 1] for k in range(1, parts)] if ordered else []


@pytest.mark.parametrize("seed", range(3))
def test_edges_equal_sorting(spark, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice([None, 7, 7, 7, rng.randint(-5, 5)]), rng.randint(-(10**15), 10**15), 10**9 + rng.randint(0, 40), None, 3)
        for _ in range(rng.choice((1, 2, 50, 400)))
    ]
    names = list("abcde")
    df = spark.createDataFrame(rows, "a bigint, b bigint, c bigint, d bigint, e bigint")
    found = edges.exact_edges(df, {n: F.col(n) for n in names}, 5)
    assert found == {n: plain_edges([r[i] for r in rows], 5) for i, n in enumerate(names)}


def test_edges_of_nothing(spark):
    assert edges.exact_edges(spark.createDataFrame([], "a bigint"), {"a": F.col("a")}, 4) == {"a": []}


def test_equal_values_are_not_parted(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 2, 2, 9)], "a bigint")
    found = edges.exact_edges(df, {"a": F.col("a")}, 5)["a"]
    assert [r.p for r in df.select(edges.part_of(F.col("a"), found).alias("p")).collect()] == [1, 2, 2, 2, 5]


# --- positions and slices -------------------------------------------------------------------------


def test_positions_of_a_large_and_small_groups(spark):
    rng = random.Random(1)
    rows = [("hot", i * 7, i) for i in range(500)] + [(f"k{i % 40}", rng.randint(0, 10**9), 500 + i) for i in range(200)] + [(None, 5, 900), (None, 1, 901)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, at bigint, id int").repartition(7)
    found = slices.numbered(df, ["k"], "at", "position")
    assert found.columns == ["k", "at", "id", "position"]
    groups = defaultdict(list)
    for r in found.collect():
        groups[r.k].append((r.position, r.at))
    wanted = defaultdict(list)
    for k, at, _ in rows:
        wanted[k].append(at)
    assert {k: sorted(v) for k, v in groups.items()} == {k: list(enumerate(sorted(v))) for k, v in wanted.items()}


def test_windows_over_slices_equal_windows_over_groups(spark):
    rows = [(k, i, (i * 37 + len(k)) % 101) for k, n in (("long", 300), ("b", 3), ("c", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, p bigint, v bigint")
    columns = {"before": lambda w: F.lag("v", 9).over(w), "sum": lambda w: F.sum("v").over(w.rowsBetween(-9, -1))}
    whole = slices.windowed(df, ["k"], "p", 9, columns, slice_rows=10_000)
    for size in (1, 4, 9, 10, 64):
        cut = slices.windowed(df, ["k"], "p", 9, columns, slice_rows=size)
        assert cut.columns == whole.columns and sorted(cut.collect()) == sorted(whole.collect())
    assert cut.count() == len(rows)


# --- basket pairs ---------------------------------------------------------------------------------


def plain_rules(rows, least):
    by = defaultdict(set)
    for order, product in rows:
        if order is not None and product is not None:
            by[order].add(product)
    single = Counter(p for s in by.values() for p in s)
    both = Counter(pair for s in by.values() for pair in itertools.permutations(s, 2))
    n = len(by)
    return {
        (x, y, single[x], single[y], c, round(c / n, 9), round(c / single[x], 9), round(c * n / (single[x] * single[y]), 9))
        for (x, y), c in both.items()
        if c >= least
    }


def rules_of(df):
    return {(*tuple(r)[:5], *(round(x, 9) for x in tuple(r)[5:])) for r in df.collect()}


def some_baskets(seed=3, n=200, products=30):
    rng = random.Random(seed)
    rows = [(f"o{i}", f"p{min(rng.randint(0, products), rng.randint(0, products))}") for i in range(n) for _ in range(rng.randint(1, 6))]
    return rows + rows[:20] + [(None, "p1"), ("o1", None), ("alone", "once")] + [(f"l{i}", p) for i in range(50) for p in ("laptop", "mouse")]


@pytest.mark.parametrize("chunk", [256, 2, 1])
def test_rules_equal_plain_counting(spark, monkeypatch, chunk):
    """Also where nearly every basket is cut into chunks, and where each class is cut further."""
    monkeypatch.setattr(baskets, "CHUNK", chunk)
    rows = some_baskets() + [("large", f"p{i}") for i in range(31)] + [("large", f"q{i}") for i in range(60)] + [("large2", f"q{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "order_id string, product_id string")
    wanted = plain_rules(rows, 2)
    assert rules_of(baskets.basket_pairs(df)) == wanted
    best = max((w for w in wanted if w[4] >= 20), key=lambda w: w[-1])
    assert set(best[:2]) == {"laptop", "mouse"}


def test_minimum_support(spark):
    rows = some_baskets()
    df = spark.createDataFrame(rows, "order_id string, product_id string")
    n = len({o for o, p in rows if o and p})
    assert rules_of(baskets.basket_pairs(df, minimum_support=0.05)) == plain_rules(rows, math.ceil(0.05 * n))
    assert baskets.basket_pairs(df, minimum_support=1.0).count() == 0
    assert baskets.basket_pairs(df.limit(0)).count() == 0


def test_a_basket_of_5000_products_makes_few_rows(spark):
    """Each product is frequent, but hardly any pair is: of 12.5 million pairs few leave the counting."""
    large = [("large", f"p{i}") for i in range(5000)]
    single = [(f"s{i}", f"p{i}") for i in range(5000)]
    twice = [(f"t{k}", p) for k in range(3) for p in ("p1", "p2", "p3")]
    df = spark.createDataFrame(large + single + twice, "order_id string, product_id string")
    frequent = df.selectExpr("order_id AS _basket", "cast(substr(product_id, 2) AS bigint) * 32 + pmod(xxhash64(product_id), 32) AS _item")
    units = baskets._units(frequent).cache()
    longest = units.selectExpr("max(greatest(size(left), coalesce(size(right), 0))) AS n", "count(*) AS c").first()
    assert longest.n < 4 * baskets.CHUNK and longest.c > 100
    sent = baskets.count_pairs(units, 2)
    assert sent.count() < 1000
    exact = sent.groupBy("a", "b").agg(F.sum("n").alias("n")).where("n >= 2")
    assert sorted(r.n for r in exact.collect()) == [4, 4, 4]
    assert "CartesianProduct" not in plan_of(units)


def test_partial_counts_add_up(spark, monkeypatch):
    monkeypatch.setattr(baskets, "HELD_PAIRS", 5)
    rows = some_baskets()
    df = spark.createDataFrame(rows, "order_id string, product_id string")
    assert rules_of(baskets.basket_pairs(df)) == plain_rules(rows, 2)


# --- RFM ------------------------------------------------------------------------------------------


def customers(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, last_purchase_date date, completed_order_count bigint, return_adjusted_value decimal(18,2)")


def test_rfm_scores_and_ties(spark):
    day = date(2025, 7, 1)
    rows = [(f"c{i}", day - timedelta(days=10 * (i // 2)), 1 + i % 3, D(i * i) / 100 - 2) for i in range(40)]
    rows += [("one", day, 1, D("5.00")), ("never", None, 0, D("0.00")), ("returned", None, 0, D("-1.50")), ("later", day + timedelta(days=1), 4, D("9.99"))]
    found = {r["customer_id"]: r for r in as_dicts(rfm.build_rfm(customers(spark, rows), day))}
    scored = [r for r in rows if r[1] and r[1] <= day]
    cut = {
        "r": plain_edges([(day - r[1]).days for r in scored], 5),
        "f": plain_edges([r[2] for r in scored], 5),
        "m": plain_edges([r[3] for r in scored], 5),
    }
    for c, last, n, value in scored:
        got = found[c]
        assert got["recency_days"] == (day - last).days and got["frequency_orders"] == n and got["monetary_value"] == value
        assert got["r_score"] == 5 - sum((day - last).days > e for e in cut["r"])
        assert (got["f_score"], got["m_score"]) == (1 + sum(n > e for e in cut["f"]), 1 + sum(value > e for e in cut["m"]))
    assert found["c0"]["r_score"] == found["c1"]["r_score"] == found["one"]["r_score"] == 5
    for c, name in (("never", rfm.UNSCORED), ("returned", rfm.UNSCORED), ("later", rfm.LATER)):
        assert (found[c]["r_score"], found[c]["f_score"], found[c]["m_score"], found[c]["rfm_segment"]) == (None, None, None, name)


def test_rfm_segments(spark):
    names = {}
    for r, f, m in itertools.product(range(1, 6), repeat=3):
        names[r, f, m] = (
            "Champion" if min(r, f, m) >= 4 else "Loyal" if r >= 3 and f >= 4 else "Recent" if r >= 4 and f <= 2
            else "At risk" if r <= 2 and f >= 3 else "Dormant" if r <= 2 else "Regular"
        )
    df = spark.createDataFrame(list(names), "r int, f int, m int")
    assert {(x.r, x.f, x.m): x.s for x in df.select("*", rfm.segment(F.col("r"), F.col("f"), F.col("m")).alias("s")).collect()} == names


def test_rfm_needs_no_window_over_all_customers(spark):
    plan = plan_of(rfm.build_rfm(customers(spark, [("a", date(2025, 1, 1), 1, D(1))]), date(2025, 2, 1)))
    assert "Window" not in plan and "Exchange" not in plan


def test_rfm_of_no_customers(spark):
    assert rfm.build_rfm(customers(spark, []), date(2025, 1, 1)).count() == 0
    only = rfm.build_rfm(customers(spark, [("a", None, 0, D(0))]), date(2025, 1, 1)).first()
    assert only.rfm_segment == rfm.UNSCORED


# --- retention ------------------------------------------------------------------------------------


def test_retention_grid(spark):
    """a: Jan, Feb (twice), Apr; b: Jan; c: Mar, Apr. Two cohorts, April the last month."""
    month = lambda m: date(2025, m, 1)
    rows = [("a", 1, 1), ("a", 1, 2), ("a", 1, 2), ("a", 1, 4), ("b", 1, 1), ("c", 3, 3), ("c", 3, 4)]
    df = spark.createDataFrame([(c, month(s), m - s) for c, s, m in rows], "customer_id string, acquisition_cohort_month date, months_since_acquisition bigint")
    long = cohorts.retention(df)
    found = {(r.cohort_month.month, r.age_months): (r.cohort_size, r.active_customers, r.retention) for r in long.collect()}
    assert found == {(1, 0): (2, 2, 1.0), (1, 1): (2, 1, 0.5), (1, 2): (2, 0, 0.0), (1, 3): (2, 1, 0.5), (3, 0): (1, 1, 1.0), (3, 1): (1, 1, 1.0)}
    matrix = {r["cohort_month"].month: r for r in as_dicts(cohorts.retention_matrix(long, 5))}
    assert [matrix[1][f"age_0{k}"] for k in range(5)] == [1.0, 0.5, 0.0, 0.5, None]
    assert [matrix[3][f"age_0{k}"] for k in range(5)] == [1.0, 1.0, None, None, None]
    assert cohorts.retention(df.limit(0)).count() == 0


# --- snapshots ------------------------------------------------------------------------------------

CUTOFFS = [date(2025, 3, 31), date(2025, 6, 30), date(2025, 9, 30)]
UNTIL = date(2025, 10, 15)


def events_of(spark, orders, returns):
    """orders: (id, customer, day, units, value); returns: (order, customer, day, units, value)."""
    back = Counter()
    for o, _, _, n, _ in returns:
        back[o] += n
    outcomes = spark.createDataFrame(
        [(o, c, d, n, back[o], D(v)) for o, c, d, n, v in orders],
        "order_id string, customer_id string, order_date date, ordered_quantity bigint, returned_quantity bigint, net_sales decimal(18,2)",
    )
    taken = spark.createDataFrame(
        [(o, c, int(d.strftime("%Y%m%d")), n, D(v)) for o, c, d, n, v in returns],
        "order_id string, customer_id string, return_date_key bigint, returned_quantity bigint, returned_revenue decimal(18,2)",
    )
    return churn.customer_events(outcomes, taken)


def snapshots_of(spark, orders, returns, cutoffs=CUTOFFS):
    df = churn.build_customer_snapshots(events_of(spark, orders, returns), cutoffs, 90, UNTIL)
    return {(r.customer_id, r.cutoff): tuple(r)[2:] for r in df.collect()}


def plain_snapshots(orders, returns, cutoffs=CUTOFFS):
    whole = Counter()
    for o, _, _, n, _ in returns:
        whole[o] += n
    found = {}
    for customer, cutoff in itertools.product({o[1] for o in orders}, cutoffs):
        mine = [o for o in orders if o[1] == customer and o[2] <= cutoff]
        if not mine:
            continue
        back = [r for r in returns if r[1] == customer and r[2] <= cutoff]
        ended = sum(sum(r[3] for r in back if r[0] == o[0]) >= o[3] for o in mine)
        later = [o for o in orders if o[1] == customer and cutoff < o[2] <= cutoff + timedelta(days=90) and whole[o[0]] < o[3]]
        known = cutoff + timedelta(days=90) <= UNTIL
        found[customer, cutoff] = (
            len(mine), len(mine) - ended, sum(o[3] for o in mine) - sum(r[3] for r in back), sum(D(o[4]) for o in mine) - sum((D(r[4]) for r in back), D(0)),
            (cutoff - max(o[2] for o in mine)).days, (cutoff - min(o[2] for o in mine)).days, (0 if later else 1) if known else None,
        )
    return found


def test_label_boundaries(spark):
    cut, end = CUTOFFS[0], CUTOFFS[0] + timedelta(days=90)
    first = date(2025, 1, 5)
    customers_of = {"on cutoff": cut, "day after": cut + timedelta(days=1), "last day": end, "too late": end + timedelta(days=1)}
    orders = [(f"0{c}", c, first, 1, "1.00") for c in customers_of] + [(f"1{c}", c, d, 2, "3.00") for c, d in customers_of.items()]
    orders += [("n", "new", cut + timedelta(days=1), 1, "1.00"), ("r0", "returns only", first, 2, "2.00"), ("b0", "brought back", first, 2, "2.00"), ("b1", "brought back", cut + timedelta(days=3), 2, "2.00")]
    returns = [("r0", "returns only", cut + timedelta(days=2), 1, "1.00"), ("b1", "brought back", cut + timedelta(days=9), 1, "1.00"), ("b1", "brought back", UNTIL, 1, "1.00")]
    found = snapshots_of(spark, orders, returns)
    assert found == plain_snapshots(orders, returns)
    churned = {c: v[-1] for (c, at), v in found.items() if at == cut}
    assert churned == {"on cutoff": 1, "day after": 0, "last day": 0, "too late": 1, "returns only": 1, "brought back": 1}
    assert found["on cutoff", cut][0] == 2 and ("new", cut) not in found
    assert {v[-1] for (_, at), v in found.items() if at == CUTOFFS[2]} == {None}


def some_life(seed, n=120):
    rng = random.Random(seed)
    orders, returns = [], []
    for i in range(n):
        day, units = date(2025, 1, 1) + timedelta(days=rng.randint(0, 285)), rng.randint(1, 4)
        orders.append((f"o{i}", f"c{rng.randint(0, 25)}", day, units, f"{units}.50"))
        for _ in range(rng.choice((0, 0, 1, 2))):
            taken = sum(r[3] for r in returns if r[0] == f"o{i}")
            if taken < units:
                returns.append((f"o{i}", orders[-1][1], day + timedelta(days=rng.randint(0, 120)), rng.randint(1, units - taken), "0.25"))
    return orders, returns


@pytest.mark.parametrize("seed", [1, 2])
def test_snapshots_equal_plain(spark, seed):
    orders, returns = some_life(seed)
    assert snapshots_of(spark, orders, returns) == plain_snapshots(orders, returns)
    assert snapshots_of(spark, orders, returns, CUTOFFS[1:2]) == plain_snapshots(orders, returns, CUTOFFS[1:2])


def test_later_events_change_no_feature(spark):
    orders, returns = some_life(3)
    cutoff = CUTOFFS[1]
    features = lambda found: {k: v[:-1] for k, v in found.items() if k[1] <= cutoff}
    before = features(snapshots_of(spark, orders, returns))
    moved = [(o, c, d + timedelta(days=11) if d > cutoff else d, n, "99.00" if d > cutoff else v) for o, c, d, n, v in orders]
    later = [(o, c, d + timedelta(days=5) if d > cutoff else d, n, v) for o, c, d, n, v in returns]
    assert features(snapshots_of(spark, moved, later)) == before
    dropped = [r for r in returns if r[2] <= cutoff]
    assert features(snapshots_of(spark, [o for o in orders if o[2] <= cutoff], dropped)) == before


def test_events_are_not_copied_to_cutoffs(spark):
    """Many cutoffs, few events: the rows that are shuffled are one per customer and bucket."""
    orders, returns = some_life(4)
    many = [date(2025, 1, 1) + timedelta(days=k) for k in range(280)]
    events = events_of(spark, orders, returns)
    assert "Join" not in plan_of(churn.build_customer_snapshots(events, many, 90, UNTIL)).replace("SortMergeJoin", "", 1).replace("BroadcastHashJoin", "", 1)
    assert snapshots_of(spark, orders, returns, many) == plain_snapshots(orders, returns, many)


def test_no_events_and_no_cutoffs(spark):
    assert snapshots_of(spark, [], []) == {}
    orders, returns = some_life(5, 10)
    assert snapshots_of(spark, orders, returns, []) == {}


def test_quarter_ends():
    assert churn.quarter_ends(date(2024, 12, 31), date(2025, 9, 29)) == [date(2024, 12, 31), date(2025, 3, 31), date(2025, 6, 30)]


# --- forecasting ----------------------------------------------------------------------------------

FIRST = date(2020, 1, 6)


def weekly(spark, series):
    rows = []
    for category, values in series.items():
        for i, v in enumerate(values):
            price = None if not v else 10.0 + i % 7
            rows.append((FIRST + timedelta(weeks=i), category, i % 2, 0, v // 2 + 1, v, price, 0.1 * (i % 3), 1, 0.5, 0.25, 0.25))
    return spark.createDataFrame(
        rows,
        "week_start date, category string, holiday_days bigint, campaign_days bigint, order_count bigint, ordered_quantity bigint, average_unit_price double, "
        "effective_discount_rate double, promoted_order_count bigint, online_unit_share double, store_unit_share double, marketplace_unit_share double",
    )


def test_features_shift_first(spark):
    rng = random.Random(6)
    series = {"a": [rng.randint(0, 50) for _ in range(70)], "b": [rng.randint(0, 5) for _ in range(70)]}
    found = {(r["category"], r["week_start"]): r for r in as_dicts(forecasting.temporal_features(weekly(spark, series)))}
    for category, y in series.items():
        for i, v in enumerate(y):
            r = found[category, FIRST + timedelta(weeks=i)]
            assert r["target"] == v
            for k in forecasting.LAGS:
                assert r[f"lag_{k}"] == (y[i - k] if i >= k else None)
            for n in forecasting.WINDOWS:
                past = y[i - n : i] if i >= n else None
                assert r[f"rolling_mean_{n}"] == (pytest.approx(statistics.mean(past)) if past else None)
                assert r[f"rolling_std_{n}"] == (pytest.approx(statistics.stdev(past)) if past else None)
            assert r["promoted_share_lag_1"] == (pytest.approx(1 / (y[i - 1] // 2 + 1)) if i else None)
            assert r["holiday_days"] == i % 2 and r["average_unit_price_lag_1"] == (None if not i or not y[i - 1] else 10.0 + (i - 1) % 7)


def test_series_longer_than_a_slice(spark):
    rng = random.Random(7)
    base = weekly(spark, {"a": [rng.randint(0, 50) for _ in range(300)], "b": [1] * 300})
    whole = sorted(forecasting.temporal_features(base).collect())
    for rows in (20, 64, 299):
        assert sorted(forecasting.temporal_features(base, slice_rows=rows).collect()) == whole


def test_target_of_its_own_week_leaks_nowhere(spark):
    y = [5] * 80
    before = {r["week_start"]: r for r in as_dicts(forecasting.temporal_features(weekly(spark, {"a": y})))}
    y[60] = 1000
    at = FIRST + timedelta(weeks=60)
    for r in as_dicts(forecasting.temporal_features(weekly(spark, {"a": y}))):
        if r["week_start"] <= at:
            assert {k: v for k, v in r.items() if k != "target"} == {k: v for k, v in before[r["week_start"]].items() if k != "target"}


@pytest.mark.parametrize("weeks,min_train,horizon,step", [(20, 8, 4, 4), (20, 8, 4, 1), (20, 3, 2, 5), (12, 8, 4, 4), (11, 8, 4, 4), (1, 1, 1, 1)])
def test_folds(spark, weeks, min_train, horizon, step):
    base = weekly(spark, {"a": [1] * weeks, "b": [2] * weeks}).select("category", "week_start")
    found = forecasting.rolling_origin_splits(base, min_train, horizon, step).orderBy("fold").collect()
    wanted = []
    while min_train + len(wanted) * step + horizon <= weeks:
        wanted.append(min_train + len(wanted) * step)
    day = lambda i: FIRST + timedelta(weeks=i)
    assert [tuple(r) for r in found] == [(f, FIRST, day(t - 1), day(t), day(t + horizon - 1), t) for f, t in enumerate(wanted)]
    assert all(r.train_end < r.test_start for r in found)
    for r in forecasting.fold_membership(base, min_train, horizon, step).collect():
        trains = [f for f, t in enumerate(wanted) if r.period < t]
        tests = [f for f, t in enumerate(wanted) if t <= r.period < t + horizon]
        assert r.first_train_fold == (min(trains) if trains else None) and trains == list(range(trains[0], len(wanted)) if trains else [])
        assert (r.first_test_fold, r.last_test_fold) == ((min(tests), max(tests)) if tests else (None, None))


def test_folds_need_positive_numbers(spark):
    with pytest.raises(ValueError):
        forecasting.rolling_origin_splits(weekly(spark, {"a": [1]}), 0, 1, 1)


def test_last_known_over_slices(spark):
    values = [None, 3, None, None, 5, None, None, None, 7, None]
    rows = [("a", i, v) for i, v in enumerate(values)] + [("b", 0, None)]
    df = spark.createDataFrame(rows, "category string, period bigint, v bigint")
    wanted, last = [], None
    for i, v in enumerate(values):
        last = v if v is not None else last
        wanted.append(("a", i, last))
    for size in (1, 2, 3, 100):
        assert sorted(map(tuple, forecasting.last_known(df, "v", size).collect()), key=str) == sorted([*wanted, ("b", 0, None)], key=str)


def test_baselines_and_errors(spark):
    rng = random.Random(8)
    series = {"a": [rng.randint(0, 9) for _ in range(130)], "zero": [0] * 130}
    forecasts = forecasting.baseline_forecasts(weekly(spark, series), min_train=60, horizon=55, step=5)
    found = {tuple(r) for r in forecasts.collect()}
    wanted, folds = set(), range((130 - 60 - 55) // 5 + 1)
    for fold, (category, y) in itertools.product(folds, series.items()):
        origin = 60 + 5 * fold - 1
        for h in range(1, 56):
            back = origin + h - 52 * -(-h // 52)
            day = FIRST + timedelta(weeks=origin + h)
            wanted.add((fold, category, day, h, "last_value", y[origin + h], y[origin]))
            if back >= 0:
                wanted.add((fold, category, day, h, "seasonal_naive", y[origin + h], y[back]))
    assert found == wanted
    for r in forecasting.forecast_errors(forecasts).collect():
        mine = [(a, f) for _, c, _, h, m, a, f in wanted if (c, h, m) == (r.category, r.horizon, r.model)]
        assert r.n == len(mine) and r.mae == pytest.approx(sum(abs(a - f) for a, f in mine) / len(mine))
        assert r.smape == pytest.approx(sum(2 * abs(a - f) / (a + f) if a + f else 0 for a, f in mine) / len(mine), abs=1e-8)
        assert r.category != "zero" or (r.mae, r.smape) == (0, 0)


# --- propensity -----------------------------------------------------------------------------------


def labelled(spark, n=1500, seed=9):
    """Churn depends on recency and on the number of orders."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        recency, orders = rng.randint(0, 200), rng.randint(1, 20)
        p = 1 / (1 + math.exp(-(recency - 100) / 25 + (orders - 10) / 2))
        cutoff = date(2024, 1, 1) + timedelta(days=91 * (i % 8))
        rows.append((f"c{i % 400}", cutoff, orders, orders, orders * 2, D(orders * 10), recency, recency + 30, int(rng.random() < p) if i % 50 else None))
    return spark.createDataFrame(
        rows,
        "customer_id string, cutoff date, order_count bigint, completed_order_count bigint, net_units bigint, net_value decimal(18,2), recency_days bigint, tenure_days bigint, churned int",
    )


def test_classifier_beats_both_baselines(spark):
    first = date(2025, 6, 1)
    split = propensity.split_by_time(labelled(spark), first, 90)
    assert split.train.agg(F.max("cutoff")).first()[0] + timedelta(days=90) < first <= split.test.agg(F.min("cutoff")).first()[0]
    model = propensity.fit_classifier(split.train)
    scores = {
        name: propensity.brier(df).first().brier
        for name, df in (("majority", propensity.majority_baseline(split)), ("recency", propensity.recency_baseline(split)), ("classifier", propensity.classify(model, split.test)))
    }
    assert scores["classifier"] < scores["recency"] < scores["majority"]
    parts = propensity.calibration(propensity.classify(model, split.test)).orderBy("part").collect()
    assert [p.part for p in parts] == list(range(1, 11))
    assert all(a.mean_probability < b.mean_probability for a, b in itertools.pairwise(parts))
    assert all(abs(p.mean_probability - p.churn_rate) < 0.25 for p in parts)


def test_recency_baseline_by_hand(spark):
    rows = [("t", date(2024, 1, 1), r, c) for r, c in ((1, 0), (2, 0), (3, 1), (4, 0), (5, 1))] + [("x", date(2025, 1, 1), r, 1) for r in (0, 2, 3, 99)]
    df = spark.createDataFrame(rows, "customer_id string, cutoff date, recency_days bigint, churned int")
    split = propensity.split_by_time(df, date(2025, 1, 1), 90)
    found = {r.recency_days: r.probability for r in propensity.recency_baseline(split).collect()}
    assert found == {0: 0.0, 2: 0.0, 3: 1.0, 99: 1.0}
    assert {r.probability for r in propensity.majority_baseline(split).collect()} == {0.4}
    whole = propensity.brier(propensity.majority_baseline(split)).first()
    assert (whole.n, whole.churn_rate, whole.mean_probability, whole.brier) == (4, 1.0, 0.4, 0.36)
