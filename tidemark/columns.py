"""Names of the columns that travel between operators, in their fixed order."""

# The person, the features of a person at a snapshot, and the targets.
PERSON = "customer_unique_id"
STATE = "customer_state"
SNAPSHOT = "snapshot_date"
MONEY = "monetary_total"
FEATURE_COLUMNS = [
    PERSON,
    STATE,
    "recency_days",
    "tenure_days",
    "frequency",
    MONEY,
    "aov",
    "max_delivery_delay_days",
    "has_undelivered_order",
    "total_canceled_orders",
    SNAPSHOT,
]
VALUE_TARGET = "target_180d_ltv"
CHURN_TARGET = "target_is_churn"
INGESTED_AT = "ingested_at_utc"
PANEL_COLUMNS = FEATURE_COLUMNS + [VALUE_TARGET, CHURN_TARGET, INGESTED_AT]

# Columns of a panel that are no model features, the label, and the names of the splits.
SYSTEM_COLUMNS = [PERSON, SNAPSHOT, INGESTED_AT, VALUE_TARGET]
LABEL = CHURN_TARGET
SPLIT = "split"
SPLITS = ["train", "val", "test"]

# What scoring adds, and the columns of the business report.
PROBABILITY = "predicted_probability"
AT_RISK = "revenue_at_risk"
REPORT_COLUMNS = [PERSON, PROBABILITY, MONEY, AT_RISK]
