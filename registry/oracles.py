"""The registered queries as SQL over the sample tables.

``half_up`` rounds a double by its shortest decimal text, ties away from zero. Engines that
scale and round in binary instead differ in the last place now and then.
"""

from __future__ import annotations

from registry.queries import DAY, EVE, FIRST_DELIVERY_TO, MOST, PAYOUT_SUMS, REDELIVERY_FROM, WEEKEND


def half_up(value: str, scale: int = 8) -> str:
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,20)), {scale}) AS DOUBLE)"


def money(value: str) -> str:
    return f"CAST(CAST({value} AS VARCHAR) AS DECIMAL(18,2))"


STAMP = "'%Y-%m-%d %H:%M:%S.%f'"

TX = f"""
tx AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id,
         CAST(user_id * 10 + event_id % 2 AS VARCHAR) AS account_id,
         ts AS event_time,
         CAST(CASE WHEN event_type IN ('purchase', 'error') THEN -{money('value')}
              ELSE {money('value')} END AS DECIMAL(18,2)) AS amount,
         CAST(ts AS DATE) AS date,
         event_type AS channel, event_id
  FROM events)"""

TX_ORDERS = f"""
tx AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(o_custkey AS VARCHAR) AS account_id,
         o_orderdate AS event_time,
         CAST(CASE WHEN o_orderstatus = 'F' THEN -{money('o_totalprice')}
              ELSE {money('o_totalprice')} END AS DECIMAL(18,2)) AS amount,
         CAST(o_orderdate AS DATE) AS date, o_orderkey AS order_id
  FROM orders)"""


def _rates(table: str, time: str) -> str:
    return f"""
rates AS (
  SELECT CAST({time} AS DATE) AS date,
         CAST(400 + count(*) % 100 AS DOUBLE) / CAST(10000 AS DOUBLE) AS valor
  FROM {table} GROUP BY CAST({time} AS DATE) HAVING isodow(CAST({time} AS DATE)) <= 5)"""


RATES = _rates("events", "ts")
RATES_ORDERS = _rates("orders", "o_orderdate")

TX_COLUMNS = f"""user_id, account_id, strftime(event_time, {STAMP}) AS event_time,
  CAST(amount AS DOUBLE) AS amount, date"""

# One row per key, the greatest amount first, as the upserts choose among repeated keys.
LATEST_TX = """
kept AS (
  SELECT user_id, account_id, event_time, amount, date, channel FROM (
    SELECT *, row_number() OVER (
      PARTITION BY account_id, event_time
      ORDER BY user_id DESC, amount DESC, channel DESC) AS rn
    FROM tx) WHERE rn = 1)"""

MERGED_TX = f"""
target AS (SELECT * FROM tx WHERE event_id % 3 <> 0),
source AS (
  SELECT user_id, account_id, event_time, CAST(amount + 1 AS DECIMAL(18,2)) AS amount, date
  FROM tx WHERE event_id % 3 <> 1),
merged AS (
  SELECT t.user_id, t.account_id, t.event_time, t.amount, t.date, t.channel,
         CAST(NULL AS VARCHAR) AS note
  FROM target t ANTI JOIN source s ON t.account_id = s.account_id AND t.event_time = s.event_time
  UNION ALL
  SELECT s.user_id, s.account_id, s.event_time, s.amount, s.date, t.channel, 'redelivered'
  FROM source s LEFT JOIN target t
    ON t.account_id = s.account_id AND t.event_time = s.event_time)"""

ACTIVITY = """
activity AS (
  SELECT user_id, account_id, CAST(event_time AS DATE) AS event_date,
         CAST(SUM(amount) AS DOUBLE) AS movimentacao_dia, MAX(event_time) AS event_time
  FROM tx GROUP BY ALL),
lagged AS (
  SELECT user_id, account_id, event_date,
         COALESCE(lag(movimentacao_dia) OVER w, 0.0) AS saldo_dia_anterior,
         movimentacao_dia, lag(event_time) OVER w AS horario_saldo_elegivel, event_time
  FROM activity WINDOW w AS (PARTITION BY user_id, account_id ORDER BY event_date))"""


def _active(where: str = "TRUE") -> str:
    return f"""{ACTIVITY},
active AS (
  SELECT l.*, COALESCE(r.valor, CAST(0 AS DOUBLE)) AS valor_cdi
  FROM lagged l LEFT JOIN rates r ON l.event_date = r.date WHERE {where})"""


ACTIVE_COLUMNS = f"""user_id, account_id, event_date,
  CAST(saldo_dia_anterior AS DOUBLE) AS saldo_dia_anterior, movimentacao_dia,
  strftime(horario_saldo_elegivel, {STAMP}) AS horario_saldo_elegivel,
  strftime(event_time, {STAMP}) AS event_time"""

# Row by row: the rate a day may pay needs more than 24 hours in whole seconds.
LEDGER = """
steps AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, account_id ORDER BY event_date) AS n,
         CASE WHEN horario_saldo_elegivel IS NOT NULL
               AND (CAST(floor(epoch(event_time)) AS BIGINT)
                    - CAST(floor(epoch(horario_saldo_elegivel)) AS BIGINT)) / 3600.0 > 24
              THEN valor_cdi / CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS rate
  FROM active),
walk AS (
  SELECT user_id, account_id, n, CAST(0 AS DOUBLE) AS opening, CAST(0 AS DOUBLE) AS interest,
         CAST(0 AS DOUBLE) + movimentacao_dia + CAST(0 AS DOUBLE) AS total
  FROM steps WHERE n = 1
  UNION ALL
  SELECT s.user_id, s.account_id, s.n, w.total,
         CASE WHEN w.total > 100 THEN s.rate * w.total ELSE CAST(0 AS DOUBLE) END,
         w.total + s.movimentacao_dia
           + CASE WHEN w.total > 100 THEN s.rate * w.total ELSE CAST(0 AS DOUBLE) END
  FROM walk w JOIN steps s
    ON s.user_id = w.user_id AND s.account_id = w.account_id AND s.n = w.n + 1),
ledger AS (
  SELECT s.*, w.opening AS saldo_dia_anterior_corrigido, w.interest AS cdi_diario, w.total
  FROM steps s JOIN walk w USING (user_id, account_id, n))"""

LEDGER_COLUMNS = f"""{ACTIVE_COLUMNS}, valor_cdi, saldo_dia_anterior_corrigido, cdi_diario, total"""
REPORT_COLUMNS = f"""user_id, account_id, event_date,
  strftime(horario_saldo_elegivel, {STAMP}) AS horario_saldo_elegivel,
  saldo_dia_anterior_corrigido, valor_cdi, cdi_diario, movimentacao_dia, total"""


def _ledger(tx: str, rates: str, where: str = "TRUE", columns: str = LEDGER_COLUMNS) -> str:
    return f"WITH RECURSIVE {tx}, {rates}, {_active(where)}, {LEDGER} SELECT {columns} FROM ledger"


BUSIEST = """l.account_id = (
  SELECT account_id FROM tx GROUP BY account_id ORDER BY count(*) DESC, account_id LIMIT 1)"""


def _payout(opening: str, movement: str, rate: str, day: str) -> str:
    interest = f"CASE WHEN {opening} >= 100 THEN {opening} * {rate} ELSE CAST(0 AS DOUBLE) END"
    return f"""user_id, account_id, {opening} AS saldo_a_mais_24_horas,
  {movement} AS movimentacao_dia,
  CASE WHEN {opening} >= 100 THEN {opening} ELSE CAST(0 AS DOUBLE) END AS saldo_elegivel,
  {half_up(interest)} AS juros_calculado,
  {half_up(f'{opening} + {movement} + {interest}')} AS saldo_final,
  {day} AS date"""


def _day_payouts(name: str, day, previous: str | None) -> str:
    """CTEs ``{name}_base`` and ``{name}``: payouts of one day."""
    carried = f"LEFT JOIN {previous} p ON p.user_id = a.user_id AND p.account_id = a.account_id" \
        if previous else ""
    closing = "p.saldo_final, " if previous else ""
    return f"""
{name}_base AS (
  SELECT a.user_id, a.account_id, r.valor / CAST(100 AS DOUBLE) AS rate,
         COALESCE({closing}a.history, CAST(0 AS DOUBLE)) AS opening,
         COALESCE(a.movement, CAST(0 AS DOUBLE)) AS movement
  FROM (SELECT user_id, account_id,
               CAST(SUM(amount) FILTER (WHERE date < DATE '{day}') AS DOUBLE) AS history,
               CAST(SUM(amount) FILTER (WHERE date = DATE '{day}') AS DOUBLE) AS movement
        FROM tx WHERE date <= DATE '{day}' GROUP BY ALL) a
  {carried}
  CROSS JOIN (SELECT valor FROM rates WHERE date = DATE '{day}') r),
{name} AS (SELECT {_payout('opening', 'movement', 'rate', f"DATE '{day}'")} FROM {name}_base)"""


def _snapshot(columns: str = "*") -> str:
    return (f"WITH {TX}, {RATES}, {_day_payouts('eve', EVE, None)}, "
            f"{_day_payouts('today', DAY, 'eve')} SELECT {columns} FROM today")


CHAIN = f"""
calendar AS (
  SELECT date, valor / CAST(100 AS DOUBLE) AS rate,
         date - CAST(row_number() OVER (ORDER BY date) AS INTEGER) AS island
  FROM rates),
islands AS (SELECT island, min(date) AS first_day FROM calendar GROUP BY island),
daily AS (
  SELECT user_id, account_id, date, SUM(amount) AS movement FROM tx GROUP BY ALL),
accounts AS (
  SELECT user_id, account_id, min(date) AS since FROM daily GROUP BY ALL),
grid AS (
  SELECT a.user_id, a.account_id, c.date, c.rate, c.island,
         CAST(COALESCE(d.movement, 0) AS DOUBLE) AS movement,
         row_number() OVER (
           PARTITION BY a.user_id, a.account_id, c.island ORDER BY c.date) AS n
  FROM accounts a JOIN calendar c ON c.date >= a.since
  LEFT JOIN daily d
    ON d.user_id = a.user_id AND d.account_id = a.account_id AND d.date = c.date),
history AS (
  SELECT d.user_id, d.account_id, i.island, CAST(SUM(d.movement) AS DOUBLE) AS history
  FROM daily d JOIN islands i ON d.date < i.first_day GROUP BY ALL),
walk AS (
  SELECT g.user_id, g.account_id, g.island, g.n, g.date, g.rate, g.movement,
         COALESCE(h.history, CAST(0 AS DOUBLE)) AS opening
  FROM grid g LEFT JOIN history h
    ON h.user_id = g.user_id AND h.account_id = g.account_id AND h.island = g.island
  WHERE g.n = 1
  UNION ALL
  SELECT g.user_id, g.account_id, g.island, g.n, g.date, g.rate, g.movement,
         {half_up('w.opening + w.movement + CASE WHEN w.opening >= 100 '
                  'THEN w.opening * w.rate ELSE CAST(0 AS DOUBLE) END')}
  FROM walk w JOIN grid g
    ON g.user_id = w.user_id AND g.account_id = w.account_id
   AND g.island = w.island AND g.n = w.n + 1),
payouts AS (SELECT {_payout('opening', 'movement', 'rate', 'date')} FROM walk)"""


def _chain(tx: str, rates: str, select: str = "SELECT * FROM payouts", more: str = "") -> str:
    return f"WITH RECURSIVE {tx}, {rates}, {CHAIN} {more} {select}"


_REVISED = f"(date >= DATE '{REDELIVERY_FROM}' AND CAST(user_id AS BIGINT) % 3 <> 1)"
MERGED_PAYOUTS = f"""
SELECT user_id, account_id, saldo_a_mais_24_horas, movimentacao_dia, saldo_elegivel,
       juros_calculado,
       CASE WHEN {_REVISED} THEN saldo_final + CAST(1 AS DOUBLE) ELSE saldo_final END
         AS saldo_final, date
FROM payouts
WHERE {_REVISED} OR (date <= DATE '{FIRST_DELIVERY_TO}' AND CAST(user_id AS BIGINT) % 3 <> 0)"""


def _merged_orders(latest: bool) -> str:
    """Every stored row that matches gives way to its source rows, once for each."""
    chosen = """QUALIFY row_number() OVER (
        PARTITION BY account_id, event_time ORDER BY amount DESC) = 1""" if latest else ""
    return f"""WITH {TX_ORDERS},
target AS (SELECT * FROM tx WHERE order_id % 3 <> 0),
source AS (
  SELECT user_id, account_id, event_time, CAST(amount + 1 AS DECIMAL(18,2)) AS amount, date, order_id
  FROM tx WHERE order_id % 3 <> 1 {chosen}),
merged AS (
  SELECT t.* FROM target t ANTI JOIN source s
    ON t.account_id = s.account_id AND t.event_time = s.event_time
  UNION ALL
  SELECT s.* FROM source s LEFT JOIN target t
    ON t.account_id = s.account_id AND t.event_time = s.event_time)
SELECT {TX_COLUMNS} FROM merged"""


def _quality(keys: str) -> str:
    return f"""per_key AS (
  SELECT {keys}, count(*) AS n FROM tx GROUP BY {keys})
SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(0 AS BIGINT) AS null_key_rows,
       count(*) FILTER (WHERE n > 1) AS duplicate_keys,
       CAST(COALESCE(sum(n - 1) FILTER (WHERE n > 1), 0) AS BIGINT) AS surplus_rows
FROM per_key"""


def _curated(*days) -> str:
    chosen = ", ".join(f"DATE '{d}'" for d in days)
    return f"""WITH {TX}, {RATES}, {LATEST_TX},
curated_rates AS (SELECT * FROM rates WHERE date IN ({chosen}))
SELECT k.date, user_id, account_id, strftime(event_time, {STAMP}) AS event_time,
       CAST(amount AS DOUBLE) AS amount, r.valor
FROM kept k LEFT JOIN curated_rates r ON k.date = r.date WHERE k.date IN ({chosen})"""


# A careless delivery, its faults by column, and of sound rows the copies of a key.
FAULTY = f"""
sent AS (SELECT tx.*, unnest(range(CASE WHEN event_id % 71 = 0 THEN 2 ELSE 1 END)) AS copy FROM tx),
faults AS (
  SELECT *, CASE WHEN event_id % 89 = 0 THEN 'account_id: missing' END AS f1,
         CASE WHEN event_id % 83 = 0 THEN 'event_time: type' WHEN event_id % 79 = 0 THEN 'event_time: missing' END AS f2,
         CASE WHEN event_id % 97 = 0 THEN 'amount: type' WHEN abs(amount) > {MOST} THEN 'amount: range' END AS f3
  FROM sent),
judged AS (
  SELECT *, CASE WHEN f1 IS NULL AND f2 IS NULL AND f3 IS NULL THEN
           CASE WHEN row_number() OVER (
             PARTITION BY f1 IS NULL AND f2 IS NULL AND f3 IS NULL, account_id, event_time
             ORDER BY user_id DESC, amount DESC, channel DESC, event_id DESC) > 1 THEN 'key: repeated' END
         ELSE concat_ws(', ', f1, f2, f3) END AS reasons
  FROM faults)"""

# Late movements of four days came in, those of other days never did.
TX_LATE = TX.replace("tx AS (", "all_tx AS (") + f""",
tx AS (
  SELECT * FROM all_tx WHERE event_id % 3 <> 0 OR date < DATE '{REDELIVERY_FROM}'
     OR date IN (DATE '{REDELIVERY_FROM}', DATE '{EVE}', DATE '{DAY}', DATE '{WEEKEND}'))"""

PAYLOAD = "strftime(date, '%d/%m/%Y') AS data, CAST(valor AS VARCHAR) AS valor"

ORACLES: dict[str, str] = {
    "scan_transactions": f"""WITH {TX} SELECT user_id, account_id,
        strftime(event_time, {STAMP}) AS event_time, CAST(amount AS DOUBLE) AS amount FROM tx""",
    "scan_rates_json": f"WITH {RATES} SELECT {PAYLOAD} FROM rates",
    "rates_rejected": f"""WITH {RATES} SELECT date, reason, unnest(['landing', 'landed']) AS found FROM (
        SELECT date, CASE day(date) % 7 WHEN 1 THEN 'no array' WHEN 2 THEN 'no number' WHEN 3 THEN 'other day' END AS reason
        FROM rates) WHERE reason IS NOT NULL""",
    "scan_curated": f"WITH {TX}, {LATEST_TX} SELECT {TX_COLUMNS} FROM kept",
    "rates_from_records": f"""WITH {TX}, {RATES}
        SELECT tx.date, rates.valor, count(*) AS movements, CAST(SUM(amount) AS DOUBLE) AS amount
        FROM tx LEFT JOIN rates ON tx.date = rates.date GROUP BY tx.date, rates.valor""",
    "table_exists": """SELECT 'transactions' AS table_name, CAST(1 AS BIGINT) AS present,
        count(*) AS stored_rows FROM events
        UNION ALL SELECT 'payouts', CAST(0 AS BIGINT), CAST(0 AS BIGINT)""",
    "snapshot_first_load":
        f"WITH {TX}, {RATES}, {_day_payouts('today', DAY, None)} SELECT * FROM today",
    "rate_lookup": f"""WITH {RATES}
        SELECT valor / CAST(100 AS DOUBLE) AS rate FROM rates WHERE date = DATE '{DAY}'""",
    "rates_normalize": f"WITH {RATES} SELECT date AS data, valor FROM rates",
    "write_partitioned": f"WITH {TX} SELECT {TX_COLUMNS} FROM tx",
    "write_rates": f"WITH {RATES} SELECT date, valor FROM rates",
    "merge_transactions": f"WITH {TX}, {MERGED_TX} SELECT {TX_COLUMNS} FROM merged",
    "merge_rates": f"""WITH {RATES} SELECT date,
        CASE WHEN date >= DATE '{REDELIVERY_FROM}' THEN valor + CAST(1 AS DOUBLE)
             ELSE valor END AS valor FROM rates""",
    "merge_payouts": _chain(TX, RATES, MERGED_PAYOUTS),
    "merge_evolve": f"WITH {TX}, {MERGED_TX} SELECT {TX_COLUMNS}, channel, note FROM merged",
    "merge_orders_keep_all": _merged_orders(latest=False),
    "merge_orders_latest": _merged_orders(latest=True),
    "merge_orders_distinct": f"""WITH {TX_ORDERS},
        target AS (SELECT user_id, account_id, event_time, amount, date FROM tx WHERE order_id % 3 <> 0),
        source AS (
          SELECT DISTINCT user_id, account_id, event_time, CAST(amount + 1 AS DECIMAL(18,2)) AS amount, date
          FROM tx WHERE order_id % 3 <> 1),
        merged AS (SELECT * FROM target UNION ALL (SELECT * FROM source EXCEPT SELECT * FROM target))
        SELECT {TX_COLUMNS} FROM merged""",
    "merge_orders_replace": f"""WITH {TX_ORDERS},
        target AS (SELECT user_id, account_id, event_time, amount, date FROM tx WHERE order_id % 3 <> 0),
        source AS (
          SELECT user_id, account_id, event_time, CAST(amount + 1 AS DECIMAL(18,2)) AS amount, date
          FROM tx WHERE order_id % 3 <> 1),
        merged AS (
          SELECT t.* FROM target t ANTI JOIN source s ON t.account_id = s.account_id AND t.event_time = s.event_time
          UNION ALL SELECT * FROM source)
        SELECT {TX_COLUMNS} FROM merged""",
    "stream_in_batches": f"""WITH {TX}, {RATES},
        kept AS (SELECT DISTINCT user_id, account_id, event_time, amount, date FROM tx)
        SELECT k.date, user_id, account_id, strftime(event_time, {STAMP}) AS event_time, CAST(amount AS DOUBLE) AS amount,
               CASE WHEN day(k.date) <= 9 THEN r.valor ELSE r.valor / CAST(2 AS DOUBLE) END AS valor
        FROM kept k LEFT JOIN rates r ON k.date = r.date""",
    "merge_idempotent": f"WITH {TX}, {MERGED_TX} SELECT {TX_COLUMNS} FROM merged",
    "overwrite_partitions": f"""WITH {TX} SELECT user_id, account_id,
        strftime(event_time, {STAMP}) AS event_time,
        CAST(amount + CASE WHEN date >= DATE '{REDELIVERY_FROM}' THEN 1 ELSE 0 END AS DOUBLE)
          AS amount, date FROM tx""",
    "land_rates": f"WITH {RATES} SELECT date, valor FROM rates",
    "filter_business_date": f"""WITH {TX} SELECT user_id, account_id,
        strftime(event_time, {STAMP}) AS event_time, CAST(amount AS DOUBLE) AS amount
        FROM tx WHERE date = DATE '{DAY}'""",
    "curate_transactions": f"WITH {TX} SELECT {TX_COLUMNS} FROM tx WHERE date = DATE '{DAY}'",
    "curate_rates": f"WITH {RATES} SELECT date, valor FROM rates WHERE date = DATE '{DAY}'",
    "balance_until": f"""WITH {TX} SELECT user_id, account_id,
        CAST(SUM(amount) AS DOUBLE) AS saldo_ate_ontem_curated
        FROM tx WHERE date <= DATE '{EVE}' GROUP BY ALL""",
    "movement_of_day": f"""WITH {TX} SELECT user_id, account_id,
        CAST(SUM(amount) AS DOUBLE) AS movimentacao_dia
        FROM tx WHERE date = DATE '{DAY}' GROUP BY ALL""",
    "accounts_today": f"""WITH {TX}
        SELECT user_id, account_id FROM tx WHERE date = DATE '{DAY}'
        UNION SELECT user_id, account_id FROM tx WHERE date <= DATE '{EVE}'""",
    "previous_closing": f"""WITH {TX}, {RATES}, {_day_payouts('eve', EVE, None)}
        SELECT user_id, account_id, saldo_final AS prev_saldo_final FROM eve""",
    "daily_activity": f"""WITH {TX}, {ACTIVITY} SELECT user_id, account_id, event_date,
        movimentacao_dia, strftime(event_time, {STAMP}) AS event_time FROM activity""",
    "activity_lag": f"WITH {TX}, {ACTIVITY} SELECT {ACTIVE_COLUMNS} FROM lagged",
    "activity_with_rate":
        f"WITH {TX}, {RATES}, {_active()} SELECT {ACTIVE_COLUMNS}, valor_cdi FROM active",
    "gap_hours": f"""WITH {TX}, {ACTIVITY} SELECT user_id, account_id, event_date,
        CAST(CAST(floor(epoch(event_time)) AS BIGINT)
             - CAST(floor(epoch(horario_saldo_elegivel)) AS BIGINT) AS DOUBLE)
          / CAST(3600 AS DOUBLE) AS hours FROM lagged""",
    "union_days": f"""WITH {TX}, {ACTIVITY} SELECT user_id, account_id, event_date,
        movimentacao_dia, strftime(event_time, {STAMP}) AS event_time FROM activity
        UNION ALL SELECT user_id, account_id, event_date,
        movimentacao_dia, strftime(event_time, {STAMP}) AS event_time FROM activity
        WHERE event_date BETWEEN DATE '{REDELIVERY_FROM}' AND DATE '{EVE}'""",
    "ledger": _ledger(TX, RATES),
    "ledger_one_account": _ledger(TX, RATES, BUSIEST),
    "ledger_from_date": _ledger(
        TX, RATES,
        f"l.event_date BETWEEN DATE '{REDELIVERY_FROM}' AND DATE '{FIRST_DELIVERY_TO}'"),
    "ledger_report": _ledger(TX, RATES, columns=REPORT_COLUMNS),
    "ledger_orders": _ledger(TX_ORDERS, RATES_ORDERS),
    "ledger_continued": _ledger(TX, RATES, "l.event_date <= DATE '2024-01-31'"),
    "daily_snapshot": _snapshot(),
    "opening_balance": _snapshot("user_id, account_id, saldo_a_mais_24_horas"),
    "eligible_balance": _snapshot("user_id, account_id, saldo_elegivel"),
    "daily_interest": _snapshot("user_id, account_id, juros_calculado"),
    "closing_balance": _snapshot("user_id, account_id, saldo_final"),
    "snapshot_no_rate":
        f"""WITH {TX}, {RATES}, {_day_payouts('none', WEEKEND, None)},
        {_day_payouts('today', DAY, None)} SELECT * FROM none UNION ALL SELECT * FROM today""",
    "snapshot_chain": _chain(TX, RATES),
    "snapshot_chain_orders": _chain(TX_ORDERS, RATES_ORDERS, f"""
        SELECT date, count(*) AS accounts,
               count(*) FILTER (WHERE saldo_elegivel > 0) AS eligible_accounts,
               max(saldo_a_mais_24_horas) AS top_opening, max(juros_calculado) AS top_interest,
               min(saldo_final) AS low_closing, max(saldo_final) AS top_closing,
               {", ".join(f"CAST(SUM(CAST({c} AS DECIMAL(28,8))) AS VARCHAR) AS sum_{c}" for c in PAYOUT_SUMS)}
        FROM payouts GROUP BY date"""),
    "curate_day": _curated(DAY, EVE, WEEKEND),
    "curate_no_data": _curated(DAY),
    "curate_range": f"""WITH {TX}, {RATES} SELECT {TX_COLUMNS.replace(', date', ', tx.date')}, rates.valor
        FROM tx LEFT JOIN rates ON tx.date = rates.date
        WHERE tx.date BETWEEN DATE '{REDELIVERY_FROM}' AND DATE '{WEEKEND}'""",
    "curate_mixed_files": f"""WITH {TX} SELECT {TX_COLUMNS}, CASE WHEN event_id % 2 = 1 THEN channel END AS channel
        FROM tx WHERE date IN (DATE '{EVE}', DATE '{DAY}')""",
    "file_manifest": f"""WITH {TX} SELECT min(date) AS first_day, max(date) AS last_day, count(*) AS row_count,
        CAST(0 AS BIGINT) AS undated FROM tx GROUP BY CAST(floor((day(date) - 1) / 7) AS INTEGER)""",
    "curate_evolved": f"""WITH {TX} SELECT {TX_COLUMNS}, channel FROM tx
        WHERE date IN (DATE '{EVE}', DATE '{DAY}')""",
    "curate_orders": f"WITH {TX_ORDERS} SELECT {TX_COLUMNS} FROM tx",
    "curate_arrivals": f"WITH {TX}, {LATEST_TX} SELECT {TX_COLUMNS} FROM kept",
    "payouts_of_days": _chain(
        TX, RATES, f"SELECT * FROM payouts WHERE date <= DATE '{DAY}'"),
    "totals_restated": f"""WITH {TX_LATE},
        days AS (SELECT unnest([DATE '{EVE}', DATE '2024-01-31']) AS date)
        SELECT user_id, account_id, CAST(SUM(amount) AS DOUBLE) AS total, days.date
        FROM tx JOIN days ON tx.date <= days.date GROUP BY ALL""",
    "payouts_restated": _chain(TX_LATE, RATES, "SELECT * FROM payouts WHERE date <= DATE '2024-01-31'"),
    "tx_quality": f"WITH {TX}, {_quality('account_id, event_time')}",
    "tx_quality_orders": f"WITH {TX_ORDERS}, {_quality('account_id, event_time')}",
    "rate_quality": f"""WITH {TX.replace('tx AS', 'all_tx AS')}, {RATES},
        tx AS (SELECT rates.date FROM all_tx JOIN rates ON rates.date = all_tx.date),
        {_quality('date')}""",
    "dedup_latest": f"""WITH {TX_ORDERS} SELECT {TX_COLUMNS.replace(', date', '')} FROM (
        SELECT *, row_number() OVER (PARTITION BY account_id, event_time
          ORDER BY amount DESC, user_id DESC) AS rn FROM tx) WHERE rn = 1""",
    "tx_validated": f"""WITH {TX}, {FAULTY} SELECT user_id, account_id, strftime(event_time, {STAMP}) AS event_time,
        CAST(amount AS DOUBLE) AS amount, channel, event_id FROM judged WHERE reasons IS NULL""",
    "tx_rejected": f"WITH {TX}, {FAULTY} SELECT event_id, reasons FROM judged WHERE reasons IS NOT NULL",
    "reject_reasons": f"""WITH {TX}, {FAULTY} SELECT reason, count(*) AS row_count FROM (
        SELECT unnest(string_split(reasons, ', ')) AS reason FROM judged WHERE reasons IS NOT NULL) GROUP BY reason""",
    "curate_validated": f"""WITH {TX}, {FAULTY},
        days AS (
          SELECT CASE WHEN f2 IS NULL THEN date END AS date, reasons, amount FROM judged
          WHERE f2 IS NOT NULL OR date IN (DATE '{EVE}', DATE '{DAY}'))
        SELECT date, nullif(count(*) FILTER (WHERE reasons IS NULL), 0) AS accepted,
               CAST(SUM(amount) FILTER (WHERE reasons IS NULL) AS DOUBLE) AS amount,
               nullif(count(*) FILTER (WHERE reasons IS NOT NULL), 0) AS rejected
        FROM days GROUP BY date""",
}
