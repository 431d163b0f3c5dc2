import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barstream.operators import portfolio
from barstream.params import JobParams
from conftest import nearly_equal

KEYS = ["portfolio_id", "symbol", "timestamp"]
ON = JobParams(auto_trade=True, starting_cash=100.0)


def signals_of(spark, rows):
    df = spark.createDataFrame(rows, "portfolio_id string, t int, symbol string, Close double, signal string")
    return df.withColumn("timestamp", F.timestamp_seconds("t")).drop("t")


def ledger(spark, rows, params=ON, **options):
    return portfolio.paper_trade(signals_of(spark, rows), params, **options).orderBy(
        "portfolio_id", "timestamp", "symbol").collect()


def test_exact_cash_buys_and_missing_shares_do_not_sell(spark):
    got = ledger(spark, [("p", 1, "A", 100.0, "BUY"), ("p", 2, "B", 5.0, "SELL"),
                         ("p", 3, "A", 120.0, "BUY"), ("p", 4, "A", 110.0, "SELL"),
                         ("p", 5, "A", 90.0, "HOLD")])
    assert [r["trade_executed"] for r in got] == [
        "BOUGHT 1 @ $100.00", "None", "None", "SOLD 1 @ $110.00", "None"]
    assert [r["cash"] for r in got] == [0.0, 0.0, 0.0, 110.0, 110.0]
    assert [r["portfolio_value"] for r in got] == [100.0, 100.0, 120.0, 110.0, 110.0]


def test_trading_is_off_by_default(spark):
    got = ledger(spark, [("p", 1, "A", 10.0, "BUY")], JobParams())
    assert got[0]["trade_executed"] == "None" and got[0]["cash"] == 100_000.0


def test_percentage_size_is_at_least_one_share(spark):
    params = JobParams(auto_trade=True, starting_cash=1000.0, position_sizing="percentage")
    got = ledger(spark, [("p", 1, "A", 7.0, "BUY"), ("p", 2, "B", 900.0, "BUY")], params)
    assert [r["shares_traded"] for r in got] == [7, 1]


def test_all_prices_of_a_batch_are_known_first(spark):
    """B's new price counts in A's row of the same batch."""
    got = ledger(spark, [("p", 1, "B", 10.0, "BUY"), ("p", 2, "A", 1.0, "HOLD"), ("p", 2, "B", 50.0, "HOLD")])
    assert [r["portfolio_value"] for r in got] == [100.0, 140.0, 140.0]


def random_rows(seed, n=400):
    rng = random.Random(seed)
    rows, t = [], 0
    while len(rows) < n:
        t += 1
        for p in "pq":
            for s in rng.sample("ABCDE", rng.randint(1, 5)):
                rows.append((p, t, s, round(rng.uniform(5, 60), 2), rng.choice(["BUY", "SELL", "HOLD"])))
    return rows


def naive(rows, params):
    """The rules applied to plain dictionaries."""
    out, accounts = {}, {}
    batches = {}
    for p, t, s, price, signal in rows:
        batches.setdefault((p, t), []).append((s, price, signal))
    for (p, t), batch in sorted(batches.items()):
        cash, held, last = accounts.setdefault(p, [params.starting_cash, {}, {}])
        for s, price, _ in batch:
            last[s] = price
        for s, price, signal in sorted(batch):
            n = 1
            if params.position_sizing == "percentage":
                n = max(1, int(accounts[p][0] * params.risk_pct / price))
            if signal == "BUY" and accounts[p][0] >= price * n:
                accounts[p][0] -= price * n
                held[s] = held.get(s, 0) + n
            elif signal == "SELL" and held.get(s, 0) >= n:
                accounts[p][0] += price * n
                held[s] -= n
            value = accounts[p][0] + sum(k * last[x] for x, k in held.items())
            out[p, t, s] = (accounts[p][0], held.get(s, 0), value)
    return out


@pytest.mark.parametrize("sizing", ["fixed", "percentage"])
def test_shared_cash_against_plain_rules(spark, sizing):
    rows = random_rows(3)
    params = JobParams(auto_trade=True, starting_cash=500.0, position_sizing=sizing)
    want = naive(rows, params)
    got = ledger(spark, rows, params)
    assert len(got) == len(want)
    for r in got:
        cash, held, value = want[r["portfolio_id"], int(r["timestamp"].timestamp()), r["symbol"]]
        assert r["cash"] == pytest.approx(cash) and r["shares_held"] == held
        assert r["portfolio_value"] == pytest.approx(value)
        assert r["cash"] >= 0 and r["shares_held"] >= 0


def test_slices_and_batch_borders_change_nothing(spark):
    rows = random_rows(5)
    df = signals_of(spark, rows)
    whole = portfolio.paper_trade(df, ON)
    sliced = portfolio.paper_trade(df, ON, max_rows=60)
    nearly_equal(whole, sliced, KEYS, 1e-12)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "3")
        nearly_equal(portfolio.paper_trade(df, ON), sliced, KEYS, 1e-12)
    finally:
        spark.conf.set(key, before)


def test_cash_flows_add_up(spark):
    df = portfolio.paper_trade(signals_of(spark, random_rows(8)), ON)
    flow = F.when(F.col("trade_executed").startswith("BOUGHT"), -1).otherwise(1)
    moved = {r["portfolio_id"]: r["m"] for r in df.groupBy("portfolio_id").agg(
        F.sum(flow * F.col("shares_traded") * F.col("Close")).alias("m")).collect()}
    for r in portfolio.account_values(df).collect():
        assert r["cash"] == pytest.approx(ON.starting_cash + moved[r["portfolio_id"]])


def test_views(spark):
    df = portfolio.paper_trade(signals_of(spark, random_rows(9)), ON)
    trades = portfolio.trades(df)
    assert portfolio.query_trades(trades, limit=0).count() == 1
    assert portfolio.query_trades(trades, limit=-1).count() == 1
    assert portfolio.query_trades(trades, symbol="nobody").count() == 0
    assert portfolio.query_trades(trades, limit=5000).count() == min(trades.count(), 1000)
    assert portfolio.trade_log(trades).count() == 10
    held = portfolio.holdings(df)
    prices = df.groupBy("symbol").agg(F.max_by("Close", "timestamp").alias("price"))
    worth = {r["portfolio_id"]: r["positions_value"]
             for r in portfolio.mark_to_market(held, prices.limit(0)).collect()}
    shares = {r["portfolio_id"]: r["n"]
              for r in held.groupBy("portfolio_id").agg(F.sum("shares").alias("n")).collect()}
    assert all(worth[p] == 100.0 * n for p, n in shares.items())
    fresh = portfolio.reset_portfolio(df, ON).collect()
    assert {r["portfolio_id"] for r in fresh} == {"p", "q"}
    assert all(r["cash"] == 100.0 and r["positions"] == {} for r in fresh)


def test_holdings_follow_the_order_of_trading(spark):
    """Bought and sold at one time: the last holding is what is left, not the larger."""
    rows = [("p", 1, "A", 10.0, "BUY"), ("p", 2, "A", 10.0, "BUY"), ("p", 2, "A", 10.0, "SELL"), ("p", 2, "A", 10.0, "SELL")]
    book = portfolio.paper_trade(signals_of(spark, rows), ON)
    (held,) = portfolio.holdings(book).collect()
    sold = book.filter("trade_executed LIKE 'SOLD%'").count()
    assert held["shares"] == book.filter("trade_executed LIKE 'BOUGHT%'").count() - sold and sold == 2
    assert portfolio.account_values(book).first()["cash"] == 100.0


@pytest.mark.parametrize("options", [{}, {"max_rows": 60}])
def test_positions_after_every_batch(spark, options):
    """The map on a batch's last row is the sum of all trades so far, and no other row has one."""
    book = portfolio.paper_trade(signals_of(spark, random_rows(11)), ON, **options)
    held = {}
    rows = book.orderBy("portfolio_id", "ledger_row").collect()
    for i, r in enumerate(rows):
        own = held.setdefault(r["portfolio_id"], {})
        own[r["symbol"]] = r["shares_held"]
        last = i + 1 == len(rows) or (rows[i + 1]["portfolio_id"], rows[i + 1]["timestamp"]) != (r["portfolio_id"], r["timestamp"])
        assert r["positions"] == ({s: n for s, n in own.items() if n} if last else None)
    assert portfolio.positions(book).count() == len({(r["portfolio_id"], r["timestamp"]) for r in rows})


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_ledger_reads_batches_without_scalars(monkeypatch, size):
    """Rows alone with their time, shared times and gaps, cut into batches anywhere: as one account after the other."""
    rows = [("p", "A", 1, 10.0, "BUY"), ("p", "A", 2, 20.0, "BUY"), ("p", "B", 2, 5.0, "BUY"), ("p", "A", 3, None, "SELL"),
            ("p", "A", 4, 30.0, "SELL"), ("q", "A", 4, 7.0, "BUY"), ("q", None, 5, 7.0, "BUY"), (None, "A", 6, 7.0, "BUY")]
    types = [pa.string(), pa.string(), pa.int64(), pa.float64(), pa.string(), pa.string()]
    batches = [[pa.array(c, t) for c, t in zip(zip(*((*r, None) for r in rows[i:i + size])), types)] for i in range(0, len(rows), size)]
    scalars = []
    monkeypatch.setattr(portfolio, "_values", lambda c, real=portfolio._values: (scalars.append(type(c)), real(c))[1], raising=True)
    out = [r for part in portfolio._ledger_batches(ON, False)(iter(batches)) for r in part.to_pylist()]
    assert len(scalars) == 6 * len(batches)
    assert [(r["shares_traded"], r["shares_held"], r["cash"], r["portfolio_value"], r["ledger_row"], r["positions"]) for r in out] == [
        (1, 1, 90.0, 100.0, 1, [("A", 1)]), (1, 2, 70.0, 110.0, 2, None), (1, 1, 65.0, 110.0, 3, [("A", 2), ("B", 1)]),
        (0, None, None, None, None, None), (1, 1, 95.0, 130.0, 4, [("A", 1), ("B", 1)]),
        (1, 1, 93.0, 100.0, 1, [("A", 1)]), (0, None, None, None, None, None), (0, None, None, None, None, None)]


def test_no_window_without_partition(spark, capsys):
    """Neither slicing accounts nor prefix sums put all rows in one task."""
    from barstream.operators.series import prefix_sums

    many = spark.range(100_000).select(F.md5(F.col("id").cast("string")).alias("symbol"), (F.col("id") % 7).alias("n"))
    sums = prefix_sums(many, ["symbol"], "n", "before")
    sums.explain()
    portfolio.paper_trade(signals_of(spark, random_rows(12)), ON, max_rows=60).explain()
    assert "SinglePartition" not in capsys.readouterr().out
    want = 0
    for r in sums.orderBy("symbol").collect():
        assert r["before"] == want
        want += r["n"]
