"""Fixed values.

Everything below must stay exactly as it is for results to agree with what
existing consumers of the reports expect: column names, sentinels, thresholds,
formats and the wording of messages.
"""

# Input columns ------------------------------------------------
CRITICAL_COLUMNS = (
    "timestamp",
    "receiving_address",
    "amount",
    "transaction_type",
    "location_region",
)
STANDARD_TEXT_COLUMNS = (
    "transaction_type",
    "location_region",
    "purchase_pattern",
    "age_group",
    "anomaly",
)
RISK_SENTINEL = "none"
SALE_TYPE = "sale"
READABLE_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Analyses -----------------------------------------------------
TOP_ADDRESSES = 3
RISK_DIGITS = 2
RISK_RESULT = "location_risk_analysis"
RISK_RESULT_COLUMNS = ("location_region", "avg_risk_score")
SALES_RESULT = "top_sale_addresses"
SALES_RESULT_COLUMNS = ("receiving_address", "amount", "timestamp", "timestamp_readable")

# Anomaly checks -----------------------------------------------
REFERENCE_EPOCH = 1698642474
SECONDS_PER_YEAR = 31536000
OLD_AFTER_YEARS = 10
FUTURE_AFTER_YEARS = 1
NEGATIVE_VALUES_TEXT = "Valores negativos encontrados na coluna amount"
OLD_TIMESTAMPS_TEXT = "Timestamps muito antigos encontrados"
FUTURE_TIMESTAMPS_TEXT = "Timestamps futuros encontrados"

# Quality score (0 to 100) -------------------------------------
POINTS_PER_NULL_COLUMN = 5
MAX_NULL_POINTS = 20
MAX_DUPLICATE_POINTS = 30
POINTS_PER_ANOMALY_TYPE = 10
MAX_ANOMALY_POINTS = 20

# Thresholds ---------------------------------------------------
ALERT_SCORE = 80.0
ALERT_DUPLICATE_PERCENTAGE = 5.0
GATE_SCORE = 70.0
MAX_NULL_PERCENTAGE = 10.0
MAX_DUPLICATE_PERCENTAGE = 5.0
RULE_COLUMNS = CRITICAL_COLUMNS + ("risk_score",)
BAND_HIGH = 80.0
BAND_MEDIUM = 60.0

# Table names and message texts --------------------------------
RAW_TABLE = "raw_data"
CLEANED_TABLE = "cleaned_data"
ALERT_SCORE_TEXT = ("🚨 Score de qualidade baixo: ", "/100")
ALERT_NULLS_TEXT = ("⚠️  ", " colunas com valores nulos")
ALERT_DUPLICATES_TEXT = ("🔄 ", "% de registros duplicados")
ALERT_ANOMALIES_TEXT = ("🔍 ", " tipos de anomalias detectadas")
SUMMARY_TITLE = "RELATÓRIO DE QUALIDADE DE DADOS"
SUMMARY_RULER = "=" * 50
SUMMARY_TIMESTAMP = "Timestamp: "
SUMMARY_RECORDS = "Total de registros: "
SUMMARY_COLUMNS = "Total de colunas: "
SUMMARY_SCORE = ("Score de qualidade: ", "/100")
SUMMARY_NULL_COLUMNS = "Colunas com nulos: "
SUMMARY_DUPLICATES = "Registros duplicados: "
SUMMARY_ANOMALIES = "Anomalias detectadas: "
