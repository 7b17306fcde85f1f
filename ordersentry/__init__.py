"""ordersentry: order screening, raw-table maintenance, daily ingest with
reconciliation, and warehouse models, as Spark DataFrame jobs.

Entry points: :mod:`ordersentry.operators.fraud` (screening),
:mod:`ordersentry.streaming` (stream jobs), :mod:`ordersentry.plans`
(models, ingest) and :mod:`ordersentry.catalog` (registered queries).
"""

__version__ = "0.1.0"
