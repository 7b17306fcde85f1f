"""A direct, row-at-a-time statement of the screening rules, used only as
a test oracle: one arrival-ordered buffer per stream, checked order by
order."""

from __future__ import annotations

import datetime as dt
from collections import deque

WINDOW = dt.timedelta(seconds=10)


def _num(uid):
    try:
        return int(str(uid).lstrip("Uu"))
    except (TypeError, ValueError):
        return None


def screen(orders, window=WINDOW, cap=200):
    """orders: dicts in arrival order with user_id, product_id, quantity,
    amount_numeric, country, created_date, event_ts (datetimes).
    Returns [(status, first_rule)]."""
    buf = deque(maxlen=cap)
    out = []
    for o in orders:
        buf.append(o)
        now = o["event_ts"]
        rec = [b for b in buf if now - b["event_ts"] < window]
        hour = o["created_date"].hour
        night = 0 <= hour < 4
        fired = []
        if o.get("country") != "ID":
            fired.append("country")
        if night and (o.get("quantity") or 0) > 100:
            fired.append("night_quantity")
        if night and (o.get("amount_numeric") or 0) > 100_000_000:
            fired.append("night_amount")
        same = [b for b in rec if b["user_id"] == o["user_id"] and b["product_id"] == o["product_id"]]
        if len(same) >= 2:
            fired.append("bot_a")
        one_pq = len(rec) >= 2 and len({(b["product_id"], b["quantity"]) for b in rec}) == 1
        ids = [_num(b["user_id"]) for b in rec]
        if one_pq and None not in ids and ids == sorted(ids):
            fired.append("bot_b")
        if one_pq:
            fired.append("bot_c")
        out.append(("Fraud", fired[0]) if fired else ("Genuine", None))
    return out
