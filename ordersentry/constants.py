"""Values that must equal the original platform's for equal results."""

# Verdict labels, the status of an unscreened order, topic
# names, and the money text format (prefix "Rp.", "." between thousands).
FRAUD = "Fraud"
GENUINE = "Genuine"
PENDING = "pending"
ORDERS_TOPIC = "orders"
PROCESSED_TOPIC = "processed_orders"
ALERTS_TOPIC = "fraud_alerts"
RUPIAH_PREFIX = "Rp."
RUPIAH_THOUSANDS = "."
