"""Table layouts. Column names and keys are part of the data contract."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: column names, types, keys and thresholds of the tables ---
TRANSACTIONS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("amount", T.DecimalType(18, 2)),
])
CURATED_TRANSACTIONS = T.StructType(
    TRANSACTIONS.fields + [T.StructField("date", T.DateType())]
)
RATE_PAYLOAD = T.StructType([
    T.StructField("data", T.StringType()),
    T.StructField("valor", T.StringType()),
])
RATE_RECORDS = T.StructType([
    T.StructField("data", T.StringType()),
    T.StructField("valor", T.DoubleType()),
])
RATE_FAULTS = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("payload", T.StringType()),
    T.StructField("reason", T.StringType()),
])
RATES = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("valor", T.DoubleType()),
])
PAYOUTS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("saldo_a_mais_24_horas", T.DoubleType()),
    T.StructField("movimentacao_dia", T.DoubleType()),
    T.StructField("saldo_elegivel", T.DoubleType()),
    T.StructField("juros_calculado", T.DoubleType()),
    T.StructField("saldo_final", T.DoubleType()),
    T.StructField("date", T.DateType()),
])
TOTALS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("total", T.DecimalType(38, 2)),
    T.StructField("date", T.DateType()),
])
TOUCHED = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("date", T.DateType()),
])
LEDGER_STATE = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("event_date", T.TimestampType()),
    T.StructField("movimentacao_dia", T.DecimalType(28, 2)),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("balance", T.DoubleType()),
    T.StructField("date", T.DateType()),
])
LEDGER = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("account_id", T.StringType()),
    T.StructField("event_date", T.TimestampType()),
    T.StructField("saldo_dia_anterior", T.DecimalType(28, 2)),
    T.StructField("movimentacao_dia", T.DecimalType(28, 2)),
    T.StructField("horario_saldo_elegivel", T.TimestampType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("valor_cdi", T.DoubleType()),
    T.StructField("saldo_dia_anterior_corrigido", T.DoubleType()),
    T.StructField("cdi_diario", T.DoubleType()),
    T.StructField("total", T.DoubleType()),
    T.StructField("date", T.DateType()),
])
LEDGER_COLUMNS = [
    "user_id", "account_id", "event_date", "saldo_dia_anterior", "movimentacao_dia",
    "horario_saldo_elegivel", "event_time", "valor_cdi", "saldo_dia_anterior_corrigido",
    "cdi_diario", "total",
]
LEDGER_REPORT_COLUMNS = [
    "user_id", "account_id", "event_date", "horario_saldo_elegivel",
    "saldo_dia_anterior_corrigido", "valor_cdi", "cdi_diario", "movimentacao_dia", "total",
]

ACCOUNT_KEY = ["user_id", "account_id"]
TRANSACTION_KEY = ["account_id", "event_time"]
RATE_KEY = ["date"]
PAYOUT_KEY = ["user_id", "account_id", "date"]

PAYLOAD_DATE_FORMAT = "dd/MM/yyyy"
MINIMUM_BALANCE = 100.0
HELD_HOURS = 24
MONEY_SCALE = 8
# --- end of fixed values ---
