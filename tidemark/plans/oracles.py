"""The same queries as ANSI SQL, each written another way than its DataFrame form.

Windows stand where the DataFrame form aggregates, range joins where it uses windows, and so
on, so that one mistake is unlikely to appear in both.
"""

from __future__ import annotations

import re


def even(expr: str, digits: int) -> str:
    """Half-even rounding at a decimal scale."""
    return f"round_even(({expr}) * 1e{digits}, 0) / 1e{digits} + 0.0"


VIEWS: dict[str, str] = {
    "fx_base": """
        SELECT concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS id,
          date_diff('day', DATE '1970-01-01', l_shipdate::DATE)::BIGINT * 86400
            + (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31 + l_suppkey * 17) % 86400
            AS ts,
          concat('0xm', lpad(l_suppkey::VARCHAR, 8, '0')) AS maker,
          CASE WHEN o_custkey % 10 = 0 THEN '0x4bfb41d5b3570defd03c39a9a4d8de6bd8b8982e'
               ELSE concat('0xt', lpad(o_custkey::VARCHAR, 8, '0')) END AS taker,
          concat('7', lpad((l_partkey * 2 + 1 + l_linenumber % 2)::VARCHAR, 76, '0')) AS token,
          l_quantity::BIGINT * 1000000 AS token_units,
          l_quantity::BIGINT * 10000
            * (1 + (l_partkey * 37 + l_orderkey * 11 + l_linenumber * 5) % 99) AS usd_units,
          l_linestatus = 'O' AS maker_pays, l_linenumber,
          concat('0xh', l_orderkey::VARCHAR) AS transactionHash
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "fx_landed": """
        SELECT id, ts, maker,
          CASE WHEN maker_pays THEN '0' ELSE token END AS makerAssetId,
          CASE WHEN maker_pays THEN usd_units ELSE token_units END AS makerAmountFilled,
          taker,
          CASE WHEN maker_pays THEN token ELSE '0' END AS takerAssetId,
          CASE WHEN maker_pays THEN token_units ELSE usd_units END AS takerAmountFilled,
          transactionHash
        FROM (SELECT * FROM fx_base
              UNION ALL SELECT * FROM fx_base WHERE l_linenumber = 7) u""",
    "fx_fills": """
        SELECT id, ts, maker, makerAssetId, makerAmountFilled, taker, takerAssetId,
          takerAmountFilled, transactionHash
        FROM (SELECT *, row_number() OVER (PARTITION BY id
                ORDER BY ts, maker, taker, makerAssetId, takerAssetId, makerAmountFilled,
                         takerAmountFilled) AS rn
              FROM fx_landed) d
        WHERE rn = 1""",
    "fx_main": """
        SELECT concat('2024-01-', lpad((p_partkey % 28 + 1)::VARCHAR, 2, '0'), 'T00:00:00Z')
            AS createdAt,
          p_partkey::VARCHAR AS id, p_name AS question, 'Yes' AS answer1, 'No' AS answer2,
          p_size % 2 = 0 AS neg_risk, replace(p_name, ' ', '-') AS market_slug,
          concat('7', lpad((p_partkey * 2 + 1)::VARCHAR, 76, '0')) AS token1,
          concat('7', lpad((p_partkey * 2 + 2)::VARCHAR, 76, '0')) AS token2,
          concat('0xc', p_partkey) AS condition_id, p_retailprice AS volume, p_brand AS ticker,
          NULL::VARCHAR AS closedTime
        FROM part WHERE p_partkey % 50 <> 7""",
    "fx_late": """
        SELECT concat('2024-01-', lpad((p_partkey % 28 + 1)::VARCHAR, 2, '0'), 'T00:00:00Z')
            AS createdAt,
          p_partkey::VARCHAR AS id, concat(p_name, ' (late)') AS question, 'Yes' AS answer1,
          'No' AS answer2, p_size % 2 = 0 AS neg_risk, replace(p_name, ' ', '-') AS market_slug,
          concat('7', lpad((p_partkey * 2 + 1)::VARCHAR, 76, '0')) AS token1,
          concat('7', lpad((p_partkey * 2 + 2)::VARCHAR, 76, '0')) AS token2,
          concat('0xc', p_partkey) AS condition_id, p_retailprice AS volume, p_brand AS ticker,
          NULL::VARCHAR AS closedTime
        FROM part WHERE p_partkey % 100 = 7 OR p_partkey % 40 = 3""",
    "fx_markets": """
        SELECT * FROM fx_main
        UNION ALL
        SELECT * FROM fx_late WHERE id NOT IN (SELECT id FROM fx_main)""",
    "fx_tokens": """
        SELECT id AS market_id, 'token1' AS side, token1 AS asset_id FROM fx_markets
        UNION ALL
        SELECT id, 'token2', token2 FROM fx_markets""",
    "fx_labelled": """
        SELECT f.*, k.market_id, k.side,
          CASE WHEN makerAssetId = '0' THEN 'USDC' ELSE k.side END AS maker_asset,
          CASE WHEN takerAssetId = '0' THEN 'USDC' ELSE k.side END AS taker_asset
        FROM fx_fills f LEFT JOIN fx_tokens k
          ON k.asset_id = CASE WHEN makerAssetId <> '0' THEN makerAssetId ELSE takerAssetId END""",
    "fx_trades": """
        SELECT id, ts AS timestamp, market_id, maker, taker,
          CASE WHEN maker_asset <> 'USDC' THEN maker_asset ELSE taker_asset END AS nonusdc_side,
          CASE WHEN taker_asset = 'USDC' THEN 'SELL' ELSE 'BUY' END AS maker_direction,
          CASE WHEN taker_asset = 'USDC' THEN 'BUY' ELSE 'SELL' END AS taker_direction,
          CASE WHEN taker_asset = 'USDC'
               THEN takerAmountFilled::DOUBLE / nullif(makerAmountFilled, 0)::DOUBLE
               ELSE makerAmountFilled::DOUBLE / nullif(takerAmountFilled, 0)::DOUBLE END AS price,
          CASE WHEN taker_asset = 'USDC' THEN takerAmountFilled ELSE makerAmountFilled END
            AS usd_units,
          CASE WHEN taker_asset <> 'USDC' THEN takerAmountFilled ELSE makerAmountFilled END
            AS token_units,
          transactionHash
        FROM fx_labelled""",
    "fx_out": """
        SELECT id, timestamp, market_id, maker, taker, nonusdc_side, maker_direction,
          taker_direction, price, usd_units / 1e6 AS usd_amount,
          token_units / 1e6 AS token_amount, transactionHash,
          market_id IS NOT NULL AS is_matched
        FROM fx_trades""",
    "fx_last": """
        SELECT market_id, side,
          CASE WHEN price > 0.98::DOUBLE THEN 1.0::DOUBLE WHEN price < 0.02::DOUBLE
               THEN 0.0::DOUBLE ELSE price END AS last_price
        FROM (SELECT market_id, nonusdc_side AS side, price,
                row_number() OVER (PARTITION BY market_id, nonusdc_side
                                   ORDER BY timestamp DESC, id DESC) AS rn
              FROM fx_trades) d
        WHERE rn = 1""",
    "fx_sums": """
        SELECT maker, market_id, nonusdc_side AS side, count(*) AS trades,
          max(timestamp) AS last_trade_ts,
          coalesce(sum(usd_units) FILTER (maker_direction = 'BUY'), 0)::BIGINT AS bu,
          coalesce(sum(usd_units) FILTER (maker_direction = 'SELL'), 0)::BIGINT AS su,
          coalesce(sum(token_units) FILTER (maker_direction = 'BUY'), 0)::BIGINT AS bt,
          coalesce(sum(token_units) FILTER (maker_direction = 'SELL'), 0)::BIGINT AS st,
          coalesce(sum(usd_units) FILTER (maker_direction = 'BUY' AND price IS NOT NULL), 0)::BIGINT
            AS bn,
          coalesce(sum(usd_units) FILTER (maker_direction = 'SELL' AND price IS NOT NULL), 0)
            ::BIGINT AS sn
        FROM fx_trades GROUP BY maker, market_id, nonusdc_side""",
    "fx_priced": """
        SELECT s.*, l.last_price, m.question,
          CASE WHEN bt > 0 THEN bn::DOUBLE / bt END AS avg_buy_price,
          CASE WHEN st > 0 THEN sn::DOUBLE / st END AS avg_sold_price_only,
          CASE WHEN bt > 0 THEN (sn + (bt - st) * l.last_price) / bt END AS avg_sell_price,
          (su - bu + (bt - st) * l.last_price) / 1e6 AS total_pnl_usd
        FROM fx_sums s
        JOIN fx_last l ON s.market_id IS NOT DISTINCT FROM l.market_id
                      AND s.side IS NOT DISTINCT FROM l.side
        LEFT JOIN fx_markets m ON m.id = s.market_id""",
    "fx_sides": """
        SELECT *, (avg_sell_price - avg_buy_price) / nullif(avg_buy_price, 0) * 100 AS pct_change
        FROM fx_priced WHERE market_id IS NOT NULL""",
    "fx_by_market": f"""
        SELECT maker, market_id, max(question) AS question, sum(trades)::BIGINT AS trades,
          {even("sum(pct_change * (bu / 1e6)) / nullif(sum(bu) FILTER (pct_change IS NOT NULL) / 1e6, 0)", 6)}
            AS pct_change_combined,
          {even("sum(total_pnl_usd)", 6)} AS total_pnl_usd,
          sum(bu)::BIGINT / 1e6 AS buy_usd_total, sum(su)::BIGINT / 1e6 AS sell_usd_total,
          max(last_trade_ts) AS last_trade_ts
        FROM fx_sides GROUP BY maker, market_id""",
    "fx_traders": f"""
        SELECT maker, count(*) AS markets_traded, max(last_trade_ts) AS last_trade,
          count(*) FILTER (total_pnl_usd > 0) AS wins,
          count(*) FILTER (total_pnl_usd <= 0) AS losses,
          count(*) FILTER (total_pnl_usd > 0 AND pct_change_combined >= 70) AS big_wins_count,
          median(pct_change_combined) FILTER (total_pnl_usd > 0) AS mwp,
          median(pct_change_combined) FILTER (total_pnl_usd <= 0) AS mlp,
          median(total_pnl_usd) FILTER (total_pnl_usd > 0) AS mwu,
          median(total_pnl_usd) FILTER (total_pnl_usd <= 0) AS mlu,
          sum(round(total_pnl_usd * 1e6)::BIGINT)::BIGINT / 1e6 AS total_pnl_usd
        FROM fx_by_market GROUP BY maker""",
    "fx_trader_out": f"""
        SELECT maker, markets_traded, last_trade, wins, losses, big_wins_count,
          {even("wins::DOUBLE / markets_traded", 6)} AS win_rate,
          {even("big_wins_count::DOUBLE / markets_traded", 6)} AS big_win_rate_overall,
          {even("big_wins_count::DOUBLE / nullif(wins, 0)", 6)} AS big_win_rate_among_wins,
          {even("mwp", 7)} AS median_win_pct, {even("mlp", 7)} AS median_loss_pct,
          {even("mwu", 7)} AS median_win_usd, {even("mlu", 7)} AS median_loss_usd,
          total_pnl_usd
        FROM fx_traders""",
    "fx_depth": """
        SELECT transactionHash, count(DISTINCT maker) AS num_makers_matched,
          sum(usd_units)::BIGINT AS units
        FROM fx_trades GROUP BY transactionHash""",
    "fx_ticks": """
        SELECT event_type AS market_id, epoch_us(ts) // 1000000 AS ts, event_id AS id,
          value / 1000 AS price, value AS usd_amount
        FROM events""",
    "fx_bars": """
        SELECT DISTINCT market_id, ts - ts % 600 AS timestamp,
          first_value(price) OVER w AS open, max(price) OVER w AS high, min(price) OVER w AS low,
          last_value(price) OVER w AS close,
          sum(round(usd_amount * 1e6)::BIGINT) OVER w ::BIGINT / 1e6 AS volume
        FROM fx_ticks
        WINDOW w AS (PARTITION BY market_id, ts - ts % 600 ORDER BY ts, id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "fx_units": """
        SELECT *, round(close * 1e12)::HUGEINT AS cu,
          row_number() OVER (PARTITION BY market_id ORDER BY timestamp) AS n
        FROM fx_bars""",
    "fx_params": """
        SELECT fast::BIGINT AS fast, slow::BIGINT AS slow, stop_loss
        FROM (VALUES (10, 50, 0.02::DOUBLE), (20, 100, 0.05::DOUBLE),
                              (50, 200, 0.02::DOUBLE)) p(fast, slow, stop_loss)""",
    "fx_ma": """
        SELECT u.*, fast, slow, stop_loss,
          CASE fast WHEN 10 THEN s10 WHEN 20 THEN s20 ELSE s50 END::HUGEINT AS fsum,
          CASE slow WHEN 50 THEN s50 WHEN 100 THEN s100 ELSE s200 END::HUGEINT AS ssum
        FROM (SELECT *,
                sum(cu) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS s10,
                sum(cu) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS s20,
                sum(cu) OVER (w ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS s50,
                sum(cu) OVER (w ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS s100,
                sum(cu) OVER (w ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS s200
              FROM fx_units WINDOW w AS (PARTITION BY market_id ORDER BY timestamp)) u,
          fx_params""",
    # bars whose averages differ; a cross is a change of sign between neighbours of these
    "fx_signs": """
        SELECT market_id, timestamp, n, fast, slow, sign(fsum * slow - ssum * fast)::INT AS s,
          lag(sign(fsum * slow - ssum * fast)::INT)
            OVER (PARTITION BY market_id, fast, slow ORDER BY n) AS before
        FROM fx_ma WHERE n >= slow AND fsum * slow <> ssum * fast""",
    "fx_cross": """
        SELECT m.*, CASE WHEN g.before < g.s THEN 1 WHEN g.before > g.s THEN -1 ELSE 0 END AS "cross"
        FROM fx_ma m LEFT JOIN fx_signs g USING (market_id, fast, slow, n)""",
    "fx_ups": """
        SELECT u.market_id, u.fast, u.slow, u.stop_loss, u.n, u.timestamp, u.close,
          row_number() OVER (PARTITION BY u.market_id, u.fast, u.slow ORDER BY u.n) AS episode_id,
          b.timestamp AS entry_ts, b.open AS entry_price
        FROM fx_cross u JOIN fx_units b ON b.market_id = u.market_id AND b.n = u.n + 1
        WHERE u."cross" = 1""",
    "fx_exits": """
        SELECT u.market_id, u.fast, u.slow, u.episode_id, min(b.n) AS exit_n
        FROM fx_ups u JOIN fx_cross b
          ON b.market_id = u.market_id AND b.fast = u.fast AND b.slow = u.slow AND b.n > u.n
         AND (b."cross" = -1 OR b.close <= u.entry_price * (1::DOUBLE - u.stop_loss))
        GROUP BY ALL""",
    "fx_episodes_all": """
        SELECT u.market_id, u.fast, u.slow, u.episode_id, u.timestamp AS signal_ts,
          u.close AS signal_close, u.entry_ts, u.entry_price, (u.n + 1) AS entry_bar,
          CASE WHEN z.n IS NOT NULL THEN y.timestamp END AS exit_signal_ts,
          z.timestamp AS exit_ts, z.open AS exit_price, z.n AS exit_bar,
          CASE WHEN z.n IS NOT NULL THEN
            CASE WHEN y.close <= u.entry_price * (1::DOUBLE - u.stop_loss)
                 THEN 'stop' ELSE 'cross' END END AS exit_reason,
          1 + 0.95::DOUBLE / u.close * (z.open - u.entry_price) AS factor
        FROM fx_ups u LEFT JOIN fx_exits x USING (market_id, fast, slow, episode_id)
        LEFT JOIN fx_units y ON y.market_id = u.market_id AND y.n = x.exit_n
        LEFT JOIN fx_units z ON z.market_id = u.market_id AND z.n = x.exit_n + 1
        WHERE 0.95::DOUBLE * u.entry_price <= u.close""",
    "fx_equity_all": """
        SELECT *, 0.95::DOUBLE * cash_before / signal_close AS size,
          CASE WHEN exit_ts IS NOT NULL THEN cash_after - cash_before END AS pnl
        FROM (SELECT *, coalesce(lag(cash_after) OVER (PARTITION BY market_id, fast, slow
                                   ORDER BY episode_id), 10000::DOUBLE) AS cash_before
              FROM (SELECT *, 10000::DOUBLE * product(coalesce(factor, 1)) OVER (
                      PARTITION BY market_id, fast, slow ORDER BY episode_id) AS cash_after
                    FROM fx_episodes_all) a) b""",
    "fx_many_bars": """
        SELECT DISTINCT market_id, ts - ts % 7200 AS timestamp, first_value(price) OVER w AS open,
          last_value(price) OVER w AS close
        FROM fx_ticks
        WINDOW w AS (PARTITION BY market_id, ts - ts % 7200 ORDER BY ts, id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    "fx_many_units": """
        SELECT *, sum(cu) OVER (PARTITION BY market_id ORDER BY n)::HUGEINT AS run
        FROM (SELECT *, round(close * 1e12)::HUGEINT AS cu,
                row_number() OVER (PARTITION BY market_id ORDER BY timestamp) AS n FROM fx_many_bars)""",
    "fx_many_params": """
        SELECT 3 + i % 40 AS fast, 50 + i // 40 * 2 AS slow,
          CASE WHEN i % 2 = 1 THEN 0.02::DOUBLE ELSE 0.05::DOUBLE END AS stop_loss
        FROM range(2000) r(i)""",
    "fx_many_sums": """
        SELECT u.market_id, u.n, p.k, u.run - coalesce(b.run, 0) AS total
        FROM (SELECT DISTINCT fast AS k FROM fx_many_params UNION SELECT slow FROM fx_many_params) p
        JOIN fx_many_units u ON u.n >= p.k
        LEFT JOIN fx_many_units b ON b.market_id = u.market_id AND b.n = u.n - p.k""",
    "fx_many_signs": """
        SELECT *, lag(s) OVER (PARTITION BY market_id, fast, slow ORDER BY n) AS before
        FROM (SELECT f.market_id, f.n, fast, slow, stop_loss, sign(f.total * slow - s.total * fast)::INT AS s
              FROM fx_many_params p JOIN fx_many_sums f ON f.k = fast
              JOIN fx_many_sums s ON s.k = slow AND s.market_id = f.market_id AND s.n = f.n)
        WHERE s <> 0""",
    "fx_many_turns": """
        SELECT market_id, n, fast, slow, stop_loss, s FROM fx_many_signs WHERE before <> s""",
    "fx_many_ups": """
        SELECT t.*, u.close, b.open AS entry_price,
          lead(t.n) OVER (PARTITION BY t.market_id, fast, slow ORDER BY t.n) AS turn_n, t.s AS up
        FROM fx_many_turns t JOIN fx_many_units u USING (market_id, n)
        LEFT JOIN fx_many_units b ON b.market_id = t.market_id AND b.n = t.n + 1""",
    "fx_many_ends": """
        SELECT u.market_id, u.fast, u.slow, u.n, min(b.n) AS stop_n
        FROM fx_many_ups u JOIN fx_many_units b ON b.market_id = u.market_id AND b.n > u.n
          AND b.n <= coalesce(u.turn_n, 1000000000)
          AND b.close <= u.entry_price * (1::DOUBLE - u.stop_loss)
        WHERE u.up = 1 GROUP BY ALL""",
    "fx_many_trades": """
        SELECT u.market_id, u.fast, u.slow, u.n,
          1 + 0.95::DOUBLE / u.close * (z.open - u.entry_price) AS factor
        FROM fx_many_ups u LEFT JOIN fx_many_ends e USING (market_id, fast, slow, n)
        LEFT JOIN fx_many_units z
          ON z.market_id = u.market_id AND z.n = coalesce(e.stop_n, u.turn_n) + 1
        WHERE u.up = 1 AND 0.95::DOUBLE * u.entry_price <= u.close""",
    "fx_walk_flags": """
        SELECT market_id, n, timestamp, close,
          lead(timestamp) OVER w AS next_ts, lead(open) OVER w AS next_open,
          coalesce(close > average, false) AS enters, coalesce(close < average * 0.8::DOUBLE, false) AS leaves
        FROM (SELECT *, CASE WHEN n >= 20 THEN (sum(cu) OVER (PARTITION BY market_id ORDER BY n
                ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))::DOUBLE / (20 * 1e12::DOUBLE) END AS average
              FROM fx_units)
        WINDOW w AS (PARTITION BY market_id ORDER BY n)""",
    "fx_walk": """
        SELECT DISTINCT market_id, 0::BIGINT AS n, NULL::BIGINT AS o, NULL::DOUBLE AS price,
          NULL::BIGINT AS ended, NULL::VARCHAR AS reason FROM fx_walk_flags
        UNION ALL
        SELECT market_id, n,
          CASE WHEN ended IS NULL AND o IS NOT NULL THEN o WHEN o IS NULL AND fits THEN n END,
          CASE WHEN ended IS NULL AND o IS NOT NULL THEN price WHEN o IS NULL AND fits THEN next_open END,
          ended, CASE WHEN ended IS NOT NULL THEN CASE WHEN stopped THEN 'stop' ELSE 'cross' END END
        FROM (SELECT *, CASE WHEN o IS NOT NULL AND (stopped OR leaves) THEN o END AS ended
              FROM (SELECT f.market_id, f.n, w.o, w.price, f.next_open, f.leaves,
                      f.close <= w.price * (1::DOUBLE - 0.05) AS stopped,
                      f.enters AND coalesce(0.95::DOUBLE * f.next_open <= f.close, false) AS fits
                    FROM fx_walk w JOIN fx_walk_flags f ON f.market_id = w.market_id AND f.n = w.n + 1))""",
    "fx_walked": """
        SELECT market_id, ended AS o, n AS x, reason FROM fx_walk WHERE ended IS NOT NULL
        UNION ALL
        SELECT w.market_id, w.o, NULL, NULL FROM fx_walk w JOIN (
          SELECT market_id, max(n) AS n FROM fx_walk GROUP BY market_id) l USING (market_id, n)
        WHERE w.o IS NOT NULL""",
    "fx_changed": """
        SELECT market_id, ts, id, price, usd_amount
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY market_id, ts, price, usd_amount) AS rn
              FROM (SELECT * FROM fx_ticks
                    UNION ALL SELECT market_id, ts, id, price * 0.5, usd_amount FROM fx_ticks WHERE id % 5 = 0
                    UNION ALL SELECT market_id, ts - 259200, id, price, usd_amount FROM fx_ticks
                      WHERE id % 7 = 0))
        WHERE rn = 1""",
    "fx_runs": "SELECT DISTINCT market_id FROM fx_bars",
    "fx_grid": f"""
        SELECT market_id, CASE fast WHEN 10 THEN 0 WHEN 20 THEN 1 ELSE 2 END::BIGINT AS param_id,
          fast, slow, stop_loss, coalesce(trades, 0) AS trades, coalesce(won, 0) AS won,
          coalesce(final_cash, 10000) AS final_cash
        FROM (SELECT * FROM fx_runs, fx_params) r LEFT JOIN (
          SELECT market_id, fast, slow, count(*) AS trades, count(*) FILTER (pnl > 0) AS won,
            arg_max(cash_after, episode_id) AS final_cash
          FROM fx_equity_all GROUP BY market_id, fast, slow) e USING (market_id, fast, slow)""",
    "fx_episodes": "SELECT * FROM fx_episodes_all WHERE fast = 50",
    "fx_equity": "SELECT * FROM fx_equity_all WHERE fast = 50",
    "fx_curve": """
        SELECT b.market_id, b.timestamp, b.n,
          CASE WHEN o.size IS NOT NULL
               THEN o.cash_before + o.size * (b.close - o.entry_price)
               ELSE coalesce(c.cash_after, 10000::DOUBLE) END AS equity,
          CASE WHEN o.size IS NOT NULL THEN o.size * b.close ELSE 0::DOUBLE END AS position_value
        FROM fx_units b
        LEFT JOIN fx_equity o ON o.market_id = b.market_id AND o.entry_ts <= b.timestamp
          AND (o.exit_ts IS NULL OR b.timestamp < o.exit_ts)
        ASOF LEFT JOIN (SELECT * FROM fx_equity WHERE exit_ts IS NOT NULL) c
          ON c.market_id = b.market_id AND c.exit_ts <= b.timestamp""",
    "fx_dips": """
        SELECT *, peak - equity AS moneydown, (peak - equity) / peak * 100 AS drawdown,
          n - max(CASE WHEN equity = peak THEN n END) OVER w AS length
        FROM (SELECT *, max(equity) OVER (PARTITION BY market_id ORDER BY n) AS peak
              FROM fx_curve) p
        WINDOW w AS (PARTITION BY market_id ORDER BY n)""",
    "fx_daily": """
        SELECT market_id, period, equity,
          equity / coalesce(lag(equity) OVER (PARTITION BY market_id ORDER BY period),
                            10000::DOUBLE) - 1 AS period_return
        FROM (SELECT market_id, timestamp - timestamp % 86400 AS period,
                arg_max(equity, timestamp) AS equity
              FROM fx_curve GROUP BY ALL) e""",
    "fx_series": """
        SELECT run_id, series, slot AS timestamp, value
        FROM (SELECT concat('run', user_id % 10) AS run_id, event_type AS series,
                s - s % 600 AS slot,
                CASE WHEN event_id % 13 = 0 THEN 'NaN'::DOUBLE ELSE value END AS value,
                row_number() OVER (PARTITION BY user_id % 10, event_type, s - s % 600
                                   ORDER BY s DESC, event_id DESC) AS rn
              FROM (SELECT *, epoch_us(ts) // 1000000 AS s FROM events) e) x
        WHERE rn = 1""",
    "fx_clock": "SELECT run_id, timestamp FROM fx_series GROUP BY run_id, timestamp",
    "fx_slots": """
        SELECT c.run_id, n.series, c.timestamp
        FROM fx_clock c JOIN (SELECT DISTINCT run_id, series FROM fx_series) n USING (run_id)""",
    "fx_ffill": """
        SELECT c.run_id, c.series, c.timestamp, s.value
        FROM fx_slots c ASOF LEFT JOIN fx_series s
          ON c.run_id = s.run_id AND c.series = s.series AND c.timestamp >= s.timestamp""",
    "fx_bounds": "SELECT min(ts) - 1 AS lo, max(ts) AS hi FROM fx_landed",
    "fx_wins": """
        SELECT market_id, episode_id, pnl >= 0 AS won,
          row_number() OVER (PARTITION BY market_id ORDER BY episode_id)
          - row_number() OVER (PARTITION BY market_id, pnl >= 0 ORDER BY episode_id) AS island
        FROM fx_equity WHERE pnl IS NOT NULL""",
    "fx_streak": """
        SELECT market_id, won, count(*) AS n, max(episode_id) AS upto
        FROM fx_wins GROUP BY market_id, won, island""",
    "fx_streaks": """
        SELECT market_id,
          CASE WHEN arg_max(won, upto) THEN arg_max(n, upto) ELSE 0 END AS won_current,
          coalesce(max(n) FILTER (won), 0) AS won_longest,
          CASE WHEN arg_max(won, upto) THEN 0 ELSE arg_max(n, upto) END AS lost_current,
          coalesce(max(n) FILTER (NOT won), 0) AS lost_longest
        FROM fx_streak GROUP BY market_id""",
}

_FILL = ("id, ts AS timestamp, maker, makerAssetId, makerAmountFilled, taker, takerAssetId, "
         "takerAmountFilled, transactionHash")
_MARKET = ("createdAt, id, question, answer1, answer2, neg_risk, market_slug, token1, token2, "
           "condition_id, volume, ticker, closedTime")
_NAN = ("CASE WHEN isnan(value) THEN NULL ELSE value END AS value, "
        "coalesce(isnan(value), false) AS is_nan")


def _length(name: str, when: str) -> str:
    bars = "exit_bar - entry_bar"
    f = f"FILTER ({when})"
    return (f"coalesce(sum({bars}) {f}, 0)::BIGINT AS {name}_total, min({bars}) {f} AS {name}_min, "
            f"max({bars}) {f} AS {name}_max, {even(f'avg({bars}) {f}', 1)} AS {name}_average")


def _money(name: str, value: str, when: str) -> str:
    f = f"FILTER ({when})"
    return (f"{even(f'coalesce(sum({value}) {f}, 0)', 1)} AS {name}_total, "
            f"{even(f'avg({value}) {f}', 1)} AS {name}_average")


def _trade_analysis() -> str:
    closed, won, lost, none = "exit_ts IS NOT NULL", "pnl >= 0", "pnl < 0", "false"
    gross = "size * (exit_price - entry_price)"
    columns = ", ".join([
        "count(episode_id) AS total", f"count(episode_id) FILTER (NOT ({closed})) AS open",
        f"count(*) FILTER ({closed}) AS closed",
        f"count(*) FILTER ({won}) AS won", f"count(*) FILTER ({lost}) AS lost",
        f"count(*) FILTER ({closed}) AS long_total", f"count(*) FILTER ({won}) AS long_won",
        f"count(*) FILTER ({lost}) AS long_lost",
        "0::BIGINT AS short_total", "0::BIGINT AS short_won", "0::BIGINT AS short_lost",
        _money("pnl_gross", gross, closed), _money("pnl_net", "pnl", closed),
        _money("pnl_long", "pnl", closed), _money("pnl_long_won", "pnl", won),
        _money("pnl_long_lost", "pnl", lost), _money("pnl_short", "pnl", none),
        _money("pnl_short_won", "pnl", none), _money("pnl_short_lost", "pnl", none),
        _length("len_won", won), _length("len_lost", lost), _length("len_long", closed),
        _length("len_long_won", won), _length("len_long_lost", lost), _length("len_short", none),
        _length("len_short_won", none), _length("len_short_lost", none)])
    return f"""
        SELECT a.*, coalesce(won_current, 0) AS won_current, coalesce(won_longest, 0) AS won_longest,
          coalesce(lost_current, 0) AS lost_current, coalesce(lost_longest, 0) AS lost_longest
        FROM (SELECT market_id, {columns} FROM fx_runs LEFT JOIN fx_equity USING (market_id)
              GROUP BY market_id) a
        LEFT JOIN fx_streaks s USING (market_id)"""


def _parsed(mode: str) -> str:
    yes, no = ("''", "''") if mode == "bulk" else ("'YES'", "'NO'")
    keep = "" if mode == "bulk" else "AND p_partkey % 13 <> 0"
    return f"""
        SELECT '2024-01-01T00:00:00Z' AS createdAt, p_partkey::VARCHAR AS id,
          CASE WHEN p_partkey % 11 <> 0 THEN p_name ELSE p_type END AS question,
          CASE WHEN p_partkey % 17 = 0 THEN {yes} ELSE 'Up' END AS answer1,
          CASE WHEN p_partkey % 17 = 0 THEN {no} ELSE 'Down' END AS answer2,
          p_size % 2 = 0 AS neg_risk, replace(p_name, ' ', '-') AS market_slug,
          CASE WHEN p_partkey % 13 = 0 THEN '71' ELSE concat('7', p_partkey, '1') END AS token1,
          CASE WHEN p_partkey % 13 = 0 THEN '' ELSE concat('7', p_partkey, '2') END AS token2,
          concat('0xc', p_partkey) AS condition_id, p_retailprice AS volume,
          CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_brand END AS ticker,
          '' AS closedTime, '{mode}' AS mode
        FROM part WHERE NOT (p_partkey % 2 = 0 AND p_partkey % 19 = 0) {keep}"""


_BAR_OLD = """
    SELECT DISTINCT market_id, ts - ts % 600 AS timestamp,
      first_value(price) OVER w AS open, max(price) OVER w AS high, min(price) OVER w AS low,
      last_value(price) OVER w AS close,
      sum(round(usd_amount * 1e6)::BIGINT) OVER w ::BIGINT / 1e6 AS volume
    FROM fx_ticks WHERE ts {op} epoch_us(TIMESTAMP '{at}') // 1000000
    WINDOW w AS (PARTITION BY market_id, ts - ts % 600 ORDER BY ts, id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""

RESULTS: dict[str, str] = {
    "markets": f"SELECT {_MARKET} FROM fx_markets",
    "market_times": """
        SELECT id,
          CASE WHEN id::BIGINT % 4 < 2 THEN day + 18367
               WHEN id::BIGINT % 4 = 2 THEN day + 18367 - 7200 END AS created_at,
          CASE WHEN id::BIGINT % 3 = 0 THEN day + 82800 END AS closed_at
        FROM (SELECT id, epoch_us(createdAt[1:10]::TIMESTAMP) // 1000000 AS day
              FROM fx_markets) m""",
    "order_fills": f"SELECT {_FILL} FROM fx_landed",
    "parse_markets": f"{_parsed('bulk')} UNION ALL {_parsed('by_token')}",
    "parse_events": f"""
        SELECT {_FILL} FROM fx_landed
        UNION ALL
        SELECT {_FILL.replace('id, ts AS', "concat(id, '-b') AS id, ts + 1 AS")} FROM fx_landed""",
    "merge_segments": f"SELECT {_FILL} FROM fx_fills",
    "time_segments": """
        SELECT i::BIGINT AS segment, lo + i * ((hi - lo) // 5) AS start_ts,
          CASE WHEN i = 4 THEN hi ELSE lo + (i + 1) * ((hi - lo) // 5) END AS end_ts
        FROM fx_bounds, range(5) r(i)""",
    "ingest_counts": """
        SELECT i::BIGINT AS segment, count(*) AS records, count(DISTINCT id) AS ids,
          min(ts) AS first_ts, max(ts) AS last_ts
        FROM fx_landed, (SELECT i, lo + i * ((hi - lo) // 5) AS a,
          CASE WHEN i = 4 THEN hi ELSE lo + (i + 1) * ((hi - lo) // 5) END AS b
          FROM fx_bounds, range(5) r(i)) s
        WHERE ts > a AND ts <= b GROUP BY i""",
    "high_water_mark": """
        SELECT ts AS last_timestamp, id AS last_id,
          strftime(make_timestamp(ts * 1000000), '%Y-%m-%d %H:%M:%S UTC') AS last_time
        FROM fx_fills ORDER BY ts DESC, id DESC LIMIT 1""",
    "stored_trades": "SELECT * FROM fx_out",
    "safe_names": """
        SELECT id, trim(regexp_replace(regexp_replace(concat(question, ' / ', ticker),
          '[(),.*:/^]', '_', 'g'), '_+', '_', 'g'), '_') AS name
        FROM fx_markets""",
    "safe_high_water_mark": """
        SELECT hi AS open_timestamp, count(*) FILTER (ts = hi) AS open_rows,
          max(id) FILTER (ts = hi) AS open_last_id, max(ts) FILTER (ts < hi) AS safe_timestamp
        FROM fx_fills, (SELECT max(ts) AS hi FROM fx_fills) m GROUP BY hi""",
    "row_count": "SELECT count(*) AS row_count FROM fx_main",
    "dedup_fills": f"SELECT {_FILL} FROM fx_fills",
    "markets_long": "SELECT market_id, side, asset_id FROM fx_tokens",
    "nonusdc_asset": """
        SELECT id, CASE WHEN makerAssetId <> '0' THEN makerAssetId ELSE takerAssetId END
          AS nonusdc_asset_id FROM fx_fills""",
    "label_trades": "SELECT * FROM fx_out",
    "quality_report": """
        SELECT 'fills' AS "check", count(*) AS rows FROM fx_fills
        UNION ALL SELECT 'token_swaps', count(*) FROM fx_fills
          WHERE makerAssetId <> '0' AND takerAssetId <> '0'
        UNION ALL SELECT 'cash_swaps', count(*) FROM fx_fills
          WHERE makerAssetId = '0' AND takerAssetId = '0'
        UNION ALL SELECT 'zero_amounts', count(*) FROM fx_fills
          WHERE makerAmountFilled * takerAmountFilled = 0
        UNION ALL SELECT 'shared_tokens', count(*) FROM (
          SELECT asset_id FROM fx_tokens GROUP BY asset_id HAVING count(*) > 1) t
        UNION ALL SELECT 'unmatched_maker_tokens', count(*) FROM fx_trades
          WHERE market_id IS NULL AND nonusdc_side = 'USDC'
        UNION ALL SELECT 'unmatched_taker_tokens', count(*) FROM fx_trades
          WHERE market_id IS NULL AND nonusdc_side IS NULL""",
    "traded_assets": """
        SELECT makerAssetId AS asset_id FROM fx_fills WHERE makerAssetId <> '0'
        UNION SELECT takerAssetId FROM fx_fills WHERE takerAssetId <> '0'""",
    "missing_tokens": """
        (SELECT makerAssetId AS asset_id FROM fx_fills UNION SELECT takerAssetId FROM fx_fills)
        EXCEPT SELECT asset_id FROM fx_tokens EXCEPT SELECT '0'""",
    "new_markets": """
        SELECT l.id, l.question, l.token1, l.token2 FROM fx_late l
        WHERE NOT EXISTS (SELECT 1 FROM fx_main m WHERE m.id = l.id)""",
    "incremental_trades": "SELECT * FROM fx_out WHERE timestamp >= 900000000",
    "repair_unmatched": "SELECT * FROM fx_out",
    "last_price": "SELECT * FROM fx_last",
    "normalized_price": """
        SELECT id, market_id, nonusdc_side,
          CASE WHEN nonusdc_side = 'token2' THEN 1 - price ELSE price END AS price
        FROM fx_trades""",
    "trades_of_wallet": "SELECT * FROM fx_out WHERE maker = '0xm00000006'",
    "trades_of_market": """
        SELECT * FROM fx_out WHERE market_id = (
          SELECT id FROM fx_markets WHERE regexp_matches(question, '^(red|blue) ')
          ORDER BY volume, id LIMIT 1)""",
    "exclude_platform": """
        SELECT id, maker, taker FROM fx_fills
        WHERE NOT (maker IN ('0xc5d563a36ae78145c45a50134d48a1215220f80a',
                             '0x4bfb41d5b3570defd03c39a9a4d8de6bd8b8982e')
                OR taker IN ('0xc5d563a36ae78145c45a50134d48a1215220f80a',
                             '0x4bfb41d5b3570defd03c39a9a4d8de6bd8b8982e'))""",
    "platform_trades": """
        SELECT count(*) FILTER (maker = w) AS as_maker, count(*) FILTER (taker = w) AS as_taker,
          count(*) AS trades
        FROM fx_fills, (SELECT '0x4bfb41d5b3570defd03c39a9a4d8de6bd8b8982e' AS w) p""",
    "side_metrics": f"""
        SELECT maker, market_id, side, trades, {even("avg_buy_price", 6)} AS avg_buy_price,
          {even("avg_sold_price_only", 6)} AS avg_sold_price_only,
          {even("avg_sell_price", 6)} AS avg_sell_price, last_price,
          {even("total_pnl_usd", 6)} AS total_pnl_usd, last_trade_ts,
          bu / 1e6 AS buy_usd, su / 1e6 AS sell_usd, bt / 1e6 AS buy_tokens,
          st / 1e6 AS sell_tokens, bn / 1e6 AS buy_notional, sn / 1e6 AS sell_notional,
          question, {even("pct_change", 6)} AS pct_change
        FROM fx_sides""",
    "market_metrics": "SELECT * FROM fx_by_market",
    "trader_metrics": "SELECT * FROM fx_trader_out",
    "rank_traders": f"""
        SELECT s_name AS user_name, maker AS wallet, markets_traded, last_trade,
          {even("wins::DOUBLE / markets_traded * 100", 2)} AS win_rate_pct,
          {even("big_wins_count::DOUBLE / markets_traded * 100", 2)} AS big_win_rate_overall_pct,
          {even("big_wins_count::DOUBLE / nullif(wins, 0) * 100", 2)}
            AS big_win_rate_among_wins_pct,
          {even("mwp", 7)} AS median_win_pct, {even("mlp", 7)} AS median_loss_pct,
          {even("mwu", 7)} AS median_win_usd, {even("mlu", 7)} AS median_loss_usd,
          big_wins_count, total_pnl_usd
        FROM fx_traders LEFT JOIN supplier
          ON maker = concat('0xm', lpad(s_suppkey::VARCHAR, 8, '0'))
        WHERE markets_traded >= 300 AND last_trade > 883612800
        ORDER BY big_wins_count::DOUBLE / nullif(wins, 0) DESC NULLS LAST, mwp DESC NULLS LAST,
          total_pnl_usd DESC NULLS LAST, maker
        LIMIT 50""",
    "leaderboard_metrics": """
        SELECT b.maker, b.user_name, coalesce(markets_traded, 0) AS markets_traded, last_trade,
          coalesce(wins, 0) AS wins, coalesce(losses, 0) AS losses,
          coalesce(big_wins_count, 0) AS big_wins_count, win_rate, big_win_rate_overall,
          big_win_rate_among_wins, median_win_pct, median_loss_pct, median_win_usd,
          median_loss_usd, coalesce(total_pnl_usd, 0) AS total_pnl_usd
        FROM (SELECT concat(CASE WHEN s_suppkey % 10 = 0 THEN '0xz' ELSE '0xm' END,
                lpad(s_suppkey::VARCHAR, 8, '0')) AS maker, s_name AS user_name
              FROM supplier WHERE s_suppkey % 3 = 0) b
        LEFT JOIN fx_trader_out USING (maker)""",
    "wallet_pnl": """
        SELECT maker, sum(round(total_pnl_usd * 1e6)::BIGINT)::BIGINT / 1e6 AS total_pnl_usd
        FROM fx_priced GROUP BY maker""",
    "match_depth": """
        SELECT transactionHash, num_makers_matched, units / 1e6 AS total_volume FROM fx_depth""",
    "match_depth_summary": f"""
        SELECT count(*) AS transactions, {even("avg(num_makers_matched)", 6)} AS avg_makers,
          median(num_makers_matched)::DOUBLE AS median_makers FROM fx_depth""",
    "volume_by_depth": f"""
        SELECT bin_order::BIGINT AS bin_order, bin, sum(units)::BIGINT / 1e6 AS total_volume,
          {even("sum(units)::DOUBLE / sum(sum(units)) OVER () * 100", 4)} AS volume_pct
        FROM fx_depth JOIN (VALUES (0, '1', 0, 1), (1, '2', 1, 2), (2, '3', 2, 3),
          (3, '4-5', 3, 5), (4, '6-10', 5, 10), (5, '11-25', 10, 25), (6, '26-50', 25, 50),
          (7, '51-100', 50, 100), (8, '100+', 100, 9000000000)) b(bin_order, bin, lo, hi)
          ON num_makers_matched > lo AND num_makers_matched <= hi
        GROUP BY bin_order, bin""",
    "find_market": """
        SELECT id, question, volume FROM fx_markets
        WHERE regexp_matches(question, '^(red|blue) ') ORDER BY volume, id LIMIT 1""",
    "ohlcv": "SELECT * FROM fx_bars",
    "ohlcv_trades": f"""
        SELECT market_id, timestamp, {even("open", 6)} AS open, {even("high", 6)} AS high,
          {even("low", 6)} AS low, {even("close", 6)} AS close, volume
        FROM (SELECT market_id, timestamp - timestamp % 86400 AS timestamp,
                arg_min(p, (timestamp, id)) AS open, max(p) AS high, min(p) AS low,
                arg_max(p, (timestamp, id)) AS close, sum(usd_units)::BIGINT / 1e6 AS volume
              FROM (SELECT *, CASE WHEN nonusdc_side = 'token2' THEN 1 - price ELSE price END AS p
                    FROM fx_trades WHERE market_id IS NOT NULL) t
              GROUP BY market_id, timestamp - timestamp % 86400) b""",
    "bars_since": """
        SELECT * FROM fx_bars WHERE timestamp >= epoch_us(TIMESTAMP '2024-01-10') // 1000000
          AND timestamp <> epoch_us(TIMESTAMP '2024-01-15') // 1000000""",
    "bar_direction": "SELECT market_id, timestamp, close >= open AS is_up FROM fx_bars",
    "bar_feed": """
        SELECT market_id AS dataname, timestamp AS datetime, open, high, low, close, volume
        FROM fx_bars""",
    "sma": f"""
        SELECT market_id, timestamp,
          CASE WHEN n >= 50 THEN {even("s50 / (50 * 1e12)", 9)} END AS sma_50,
          CASE WHEN n >= 200 THEN {even("s200 / (200 * 1e12)", 9)} END AS sma_200
        FROM (SELECT market_id, timestamp, n,
                sum(cu) OVER (w ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS s50,
                sum(cu) OVER (w ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS s200
              FROM fx_units WINDOW w AS (PARTITION BY market_id ORDER BY timestamp)) u""",
    "crossover": 'SELECT market_id, timestamp, "cross"::BIGINT AS "cross" FROM fx_cross WHERE fast = 50',
    "episodes": f"""
        SELECT * EXCLUDE (fast, slow, factor), {even("factor", 9)} AS factor FROM fx_episodes""",
    "equity": f"""
        SELECT market_id, episode_id, exit_ts, {even("cash_before", 1)} AS cash_before,
          {even("cash_after", 1)} AS cash_after, {even("pnl", 1)} AS pnl, {even("size", 0)} AS size
        FROM fx_equity""",
    "equity_curve": f"""
        SELECT market_id, timestamp, {even("equity", 1)} AS equity,
          {even("position_value", 1)} AS position_value FROM fx_curve""",
    "param_grid": f"""
        SELECT * EXCLUDE (final_cash), {even("ln(final_cash / 10000)", 9)} AS log_growth,
          {even("won / nullif(trades, 0)::DOUBLE", 6)} AS win_share FROM fx_grid""",
    "param_grid_top": f"""
        SELECT market_id, fast, slow, trades, {even("ln(final_cash / 10000)", 9)} AS log_growth
        FROM fx_grid ORDER BY final_cash DESC, market_id, param_id LIMIT 5""",
    "master_clock": "SELECT * FROM fx_clock",
    "axis_index": """
        SELECT run_id, timestamp,
          row_number() OVER (PARTITION BY run_id ORDER BY timestamp) - 1 AS index
        FROM fx_clock""",
    "align_exact": f"""
        SELECT run_id, series, timestamp, {_NAN}
        FROM fx_slots LEFT JOIN fx_series USING (run_id, series, timestamp)""",
    "align_ffill": f"SELECT run_id, series, timestamp, {_NAN} FROM fx_ffill",
    "wide_series": """
        SELECT run_id, timestamp, """ + ", ".join(
            f"max(value) FILTER (series = '{s}' AND NOT isnan(value)) AS {s}"
            for s in ("click", "error", "purchase", "signup", "view")) + """
        FROM fx_ffill GROUP BY run_id, timestamp""",
    "slice_series": f"""
        SELECT run_id, series, timestamp, {_NAN}
        FROM (SELECT *, row_number() OVER (PARTITION BY run_id, series ORDER BY timestamp DESC)
                AS from_end FROM fx_series) s
        WHERE from_end > 2 AND timestamp >= epoch_us(TIMESTAMP '2024-01-05') // 1000000""",
    "area_clip": """
        SELECT run_id, series, timestamp,
          CASE WHEN NOT isnan(value) AND value > 50 THEN value ELSE 50 END AS value_fill_gt,
          CASE WHEN NOT isnan(value) AND value < 20 THEN value ELSE 20 END AS value_fill_lt
        FROM fx_series""",
    "lookback": f"""
        SELECT run_id, series, timestamp, {_NAN}
        FROM fx_series s
        WHERE (SELECT count(*) FROM fx_series t WHERE t.run_id = s.run_id
               AND t.series = s.series AND t.timestamp > s.timestamp) < 23""",
    "time_return": f"""
        SELECT market_id, period, {even("equity", 1)} AS equity,
          {even("period_return", 6)} AS period_return FROM fx_daily""",
    "annual_return": f"""
        SELECT market_id, year, {even('''equity / coalesce(lag(equity) OVER (
            PARTITION BY market_id ORDER BY year), 10000::DOUBLE) - 1''', 6)} AS annual_return
        FROM (SELECT market_id, year(make_timestamp(timestamp * 1000000))::BIGINT AS year,
                arg_max(equity, timestamp) AS equity FROM fx_curve GROUP BY ALL) y""",
    "drawdown": f"""
        SELECT market_id, arg_max(length, n) AS length,
          {even("arg_max(moneydown, n)", 1)} AS moneydown,
          {even("arg_max(drawdown, n)", 6)} AS drawdown, max(length) AS max_length,
          {even("max(moneydown)", 1)} AS max_moneydown, {even("max(drawdown)", 6)} AS max_drawdown
        FROM fx_dips GROUP BY market_id""",
    "drawdown_of_close": f"""
        SELECT market_id, timestamp, peak,
          n - max(CASE WHEN close = peak THEN n END) OVER (PARTITION BY market_id ORDER BY n)
            AS length,
          {even("peak - close", 6)} AS moneydown,
          {even("(peak - close) / peak * 100", 6)} AS drawdown
        FROM (SELECT *, max(close) OVER (PARTITION BY market_id ORDER BY n) AS peak
              FROM fx_units) p""",
    "streaks": """
        SELECT market_id, coalesce(won_current, 0) AS won_current,
          coalesce(won_longest, 0) AS won_longest, coalesce(lost_current, 0) AS lost_current,
          coalesce(lost_longest, 0) AS lost_longest
        FROM fx_runs LEFT JOIN fx_streaks USING (market_id)""",
    "sharpe": f"""
        SELECT market_id, {even("avg(period_return) / nullif(stddev_samp(period_return), 0)", 6)}
          AS sharpe_ratio FROM fx_daily GROUP BY market_id""",
    "calmar": f"""
        SELECT market_id, month, {even("ln(equity / 10000) / (k / 12.0::DOUBLE) / nullif(worst / 100, 0)", 6)}
          AS calmar
        FROM (SELECT market_id, epoch_us(month::TIMESTAMP) // 1000000 AS month, equity,
                row_number() OVER w AS k, max(deepest) OVER w AS worst
              FROM (SELECT market_id, date_trunc('month', make_timestamp(timestamp * 1000000))
                      AS month, arg_max(equity, n) AS equity, max(drawdown) AS deepest
                    FROM fx_dips GROUP BY ALL) m
              WINDOW w AS (PARTITION BY market_id ORDER BY month)) c""",
    "sqn": f"""
        SELECT market_id, {even("sqrt(count(pnl)) * avg(pnl) / nullif(stddev_samp(pnl), 0)", 6)}
          AS sqn, count(pnl) AS trades
        FROM fx_runs LEFT JOIN fx_equity USING (market_id) GROUP BY market_id""",
    "vwr": f"""
        SELECT market_id, {even("max(rate)", 6)} AS rate,
          {even("stddev_samp(off)", 6)} AS variability,
          {even('''CASE WHEN stddev_samp(off) <= 5 THEN (exp(max(rate) * 12) - 1) * 100
            * (1 - pow(stddev_samp(off) / 5, 2)) ELSE 0 END''', 4)} AS vwr
        FROM (SELECT market_id, rate, equity / (10000 * exp(rate * i)) - 1 AS off
              FROM (SELECT d.market_id, d.equity, r.rate,
                      row_number() OVER (PARTITION BY d.market_id ORDER BY period) AS i
                    FROM fx_daily d JOIN (
                      SELECT market_id, ln(arg_max(equity, period) / 10000) / count(*) AS rate
                      FROM fx_daily GROUP BY market_id) r USING (market_id)) a) b
        GROUP BY market_id""",
    "gross_leverage": f"""
        SELECT market_id, timestamp, {even("position_value / equity", 6)} AS leverage
        FROM fx_curve""",
    "transactions": f"""
        SELECT episode_id, market_id AS instrument, entry_ts AS timestamp,
          {even("size", 0)} AS size, {even("entry_price", 6)} AS price,
          {even("-size * entry_price", 0)} AS value FROM fx_equity
        UNION ALL
        SELECT episode_id, market_id, exit_ts, {even("-size", 0)}, {even("exit_price", 6)},
          {even("size * exit_price", 0)} FROM fx_equity WHERE exit_ts IS NOT NULL""",
    "trade_analysis": _trade_analysis(),
    "period_stats": f"""
        SELECT market_id, {even("avg(period_return)", 6)} AS average,
          {even("stddev_pop(period_return)", 6)} AS stddev,
          count(*) FILTER (period_return > 0) AS positive,
          count(*) FILTER (period_return < 0) AS negative,
          count(*) FILTER (period_return = 0) AS nochange,
          {even("max(period_return)", 6)} AS best, {even("min(period_return)", 6)} AS worst
        FROM fx_daily GROUP BY market_id""",
    "flatten_report": """
        SELECT market_id, 'DrawDown - len' AS label, arg_max(length, n)::VARCHAR AS value
        FROM fx_dips GROUP BY market_id
        UNION ALL SELECT market_id, 'DrawDown - drawdown',
          arg_max(drawdown, n)::DECIMAL(18, 4)::VARCHAR FROM fx_dips GROUP BY market_id
        UNION ALL SELECT market_id, 'DrawDown - max - len', max(length)::VARCHAR
        FROM fx_dips GROUP BY market_id
        UNION ALL SELECT market_id, 'DrawDown - max - drawdown',
          max(drawdown)::DECIMAL(18, 4)::VARCHAR FROM fx_dips GROUP BY market_id""",
    "upsert_bars": f"""
        SELECT coalesce(n.market_id, o.market_id) AS market_id,
          coalesce(n.timestamp, o.timestamp) AS timestamp, coalesce(n.open, o.open) AS open,
          coalesce(n.high, o.high) AS high, coalesce(n.low, o.low) AS low,
          coalesce(n.close, o.close) AS close,
          coalesce(CASE WHEN n.close > 0.05::DOUBLE THEN n.volume END, o.volume) AS volume
        FROM ({_BAR_OLD.format(op='<', at='2024-01-20')}) o
        FULL JOIN ({_BAR_OLD.format(op='>=', at='2024-01-19')}) n
          ON n.market_id = o.market_id AND n.timestamp = o.timestamp""",
    "bar_update_type": f"""
        SELECT n.market_id, n.timestamp,
          CASE WHEN o.hi IS NULL OR n.timestamp > o.hi THEN 'APPEND'
               WHEN n.timestamp = o.hi THEN 'UPDATE_LAST' ELSE 'FILL_OR_PREPEND' END AS update_type
        FROM ({_BAR_OLD.format(op='>=', at='2024-01-19')}) n
        LEFT JOIN (SELECT market_id, max(timestamp) AS hi
                   FROM ({_BAR_OLD.format(op='<', at='2024-01-19 12:05:00')}) b
                   GROUP BY market_id) o ON o.market_id = n.market_id""",
    "stream_label_trades": """
        SELECT l.id, l.ts AS timestamp, k.market_id, l.maker, l.taker,
          coalesce(k.side, CASE WHEN NOT buys THEN 'USDC' END) AS nonusdc_side,
          CASE WHEN buys THEN 'BUY' ELSE 'SELL' END AS maker_direction,
          CASE WHEN buys THEN 'SELL' ELSE 'BUY' END AS taker_direction,
          cash::DOUBLE / tokens AS price, cash / 1e6 AS usd_amount,
          CASE WHEN buys AND k.side IS NULL THEN cash ELSE tokens END / 1e6 AS token_amount,
          l.transactionHash, k.side IS NOT NULL AS is_matched
        FROM (SELECT *, makerAssetId = '0' AS buys,
                CASE WHEN makerAssetId = '0' THEN makerAmountFilled ELSE takerAmountFilled END
                  AS cash,
                CASE WHEN makerAssetId = '0' THEN takerAmountFilled ELSE makerAmountFilled END
                  AS tokens,
                CASE WHEN makerAssetId = '0' THEN takerAssetId ELSE makerAssetId END AS asset
              FROM fx_landed) l LEFT JOIN fx_tokens k ON k.asset_id = l.asset""",
    "stream_fresh_markets": "SELECT * FROM fx_out WHERE timestamp >= 900000000",
    "repair_stored": "SELECT * FROM fx_out",
    "stream_dedup": f"SELECT {_FILL} FROM fx_fills",
    "stream_dedup_stored": f"SELECT DISTINCT {_FILL} FROM fx_landed",
    "stream_ohlcv": "SELECT * FROM fx_bars",
    "stream_ohlcv_redelivered": "SELECT * FROM fx_bars",
    "fills_from_csv": f"SELECT {_FILL} FROM fx_landed",
    "fills_by_date": f"""
        SELECT {_FILL} FROM fx_fills
        WHERE year(make_timestamp(ts * 1000000)) BETWEEN 1994 AND 1996""",
    "markets_from_files": f"SELECT {_MARKET} FROM fx_markets",
    "leaderboard_from_file": """
        SELECT concat(CASE WHEN s_suppkey % 10 = 0 THEN '0xz' ELSE '0xm' END,
          lpad(s_suppkey::VARCHAR, 8, '0')) AS user_id, s_name AS user_name
        FROM supplier WHERE s_suppkey % 3 = 0""",
    "rejected_rows": """
        SELECT 'broken_market_pages' AS "check", count(*) FILTER (p_partkey % 7 = 0) AS rows FROM part
        UNION ALL SELECT 'rejected_markets',
          count(*) FILTER (p_partkey % 7 <> 0 AND p_partkey % 5 = 0) FROM part
        UNION ALL SELECT 'broken_event_pages', count(*) FILTER (p_partkey % 3 = 0) FROM part
        UNION ALL SELECT 'rows', count(*) FROM fx_landed
        UNION ALL SELECT 'rows_with_bad_fields', count(*) FILTER (ts % 9 = 0) FROM fx_landed""",
    "shared_token": "SELECT * FROM fx_out",
    "param_grid_idle": f"""
        SELECT * EXCLUDE (final_cash), {even("ln(final_cash / 10000)", 9)} AS log_growth FROM fx_grid
        UNION ALL
        SELECT market_id, 3, 400, 1000000, 0.02::DOUBLE, 0, 0, 0.0::DOUBLE FROM fx_runs""",
    "stream_last_price": "SELECT * FROM fx_last",
    "stream_last_price_compacted": "SELECT * FROM fx_last",
    "param_grid_many": f"""
        SELECT market_id, fast, slow, stop_loss, count(n) AS trades,
          count(*) FILTER (factor > 1) AS won,
          {even("coalesce(sum(ln(coalesce(factor, 1))) FILTER (n IS NOT NULL), 0)", 9)} AS log_growth
        FROM (SELECT * FROM (SELECT DISTINCT market_id FROM fx_many_bars), fx_many_params) r
        LEFT JOIN fx_many_trades USING (market_id, fast, slow) GROUP BY ALL""",
    "episodes_reentry": f"""
        SELECT s.market_id, s.episode_id, s.timestamp AS signal_ts, s.close AS signal_close,
          s.next_ts AS entry_ts, s.next_open AS entry_price, s.n + 1 AS entry_bar,
          CASE WHEN z.next_ts IS NOT NULL THEN z.timestamp END AS exit_signal_ts, z.next_ts AS exit_ts,
          z.next_open AS exit_price, CASE WHEN z.next_ts IS NOT NULL THEN z.n + 1 END AS exit_bar,
          CASE WHEN z.next_ts IS NOT NULL THEN reason END AS exit_reason,
          {even("1 + 0.95::DOUBLE / s.close * (z.next_open - s.next_open)", 9)} AS factor
        FROM fx_walked t
        JOIN (SELECT *, count(*) FILTER (enters) OVER (PARTITION BY market_id ORDER BY n) AS episode_id
              FROM fx_walk_flags) s ON s.market_id = t.market_id AND s.n = t.o
        LEFT JOIN fx_walk_flags z ON z.market_id = t.market_id AND z.n = t.x""",
    "resume_state": """
        SELECT 'full page' AS state, 0::BIGINT AS last_timestamp, arg_max(id, (ts, id)) AS last_id,
          max(ts) AS sticky_timestamp FROM fx_fills WHERE ts < 900000000
        UNION ALL SELECT 'second complete', max(ts), NULL, NULL FROM fx_fills WHERE ts < 900000000
        UNION ALL SELECT 'no cursor', max(ts) - 1, NULL, NULL FROM fx_fills
        UNION ALL SELECT 'no data', 0, NULL, NULL""",
    "resume_fills": f"""
        SELECT {_FILL} FROM fx_fills
        WHERE ts > (SELECT max(ts) FROM fx_fills WHERE ts < 900000000)""",
    "ingest_observed": """
        SELECT i::BIGINT AS segment, count(*) AS records, min(ts) AS first_ts, max(ts) AS last_ts
        FROM fx_landed, (SELECT i, lo + i * ((hi - lo) // 5) AS a,
          CASE WHEN i = 4 THEN hi ELSE lo + (i + 1) * ((hi - lo) // 5) END AS b
          FROM fx_bounds, range(5) r(i)) s
        WHERE ts > a AND ts <= b GROUP BY i
        UNION ALL SELECT -1, count(*), min(ts), max(ts) FROM fx_landed""",
    "incremental_by_id": "SELECT * FROM fx_out WHERE timestamp >= 900000000",
    "stream_ohlcv_conflicting": """
        SELECT DISTINCT market_id, ts - ts % 600 AS timestamp,
          first_value(price) OVER w AS open, max(price) OVER w AS high, min(price) OVER w AS low,
          last_value(price) OVER w AS close,
          sum(round(usd_amount * 1e6)::BIGINT) OVER w ::BIGINT / 1e6 AS volume
        FROM fx_changed
        WINDOW w AS (PARTITION BY market_id, ts - ts % 600 ORDER BY ts, id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
}
for _name, _same in (("mark_stored", "high_water_mark"), ("safe_mark_stored", "safe_high_water_mark"),
                     ("sma_chunks", "sma"), ("crossover_chunks", "crossover"), ("episodes_chunks", "episodes"),
                     ("drawdown_chunks", "drawdown_of_close"), ("streaks_chunks", "streaks")):
    RESULTS[_name] = RESULTS[_same]


def _needed(sql: str, found: dict[str, None], within: tuple[str, ...] = ()) -> dict[str, None]:
    for name in re.findall(r"\bfx_\w+", sql):
        if name not in found and name not in within:
            _needed(VIEWS[name], found, (*within, name))
            found[name] = None
    return found


def oracle(name: str) -> str:
    body = RESULTS[name]
    views = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in _needed(body, {}))
    return f"WITH RECURSIVE {views}\n{body}" if views else body
