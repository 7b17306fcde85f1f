"""Order screening: row rules, rolling-buffer bot rules and the verdict.

Semantics (one definition, used by batch and streaming):

* Each stream partition keeps a buffer of its last ``buffer_size`` orders in
  arrival order, the current order included.
* ``rec`` = buffer orders whose ``event_ts`` is less than ``window`` before
  the current order's (strict; no lower bound, so back-dated orders count).
* country      : country is not the home country (a missing country counts)
* night_quantity / night_amount : hour of created_date in [start, end) and
  quantity / amount_numeric strictly above the limit (missing -> 0)
* bot_a : at least two orders in ``rec`` with the current user and product
* bot_c : at least two orders in ``rec`` and all share the current product
  and quantity
* bot_b : bot_c and the numeric user ids of ``rec`` never decrease in
  arrival order (any id that is not a number disables it)
* verdict ``Fraud`` if any rule fires, else ``Genuine``; ``first_rule`` names
  the first rule in the order above (country, night_quantity, night_amount,
  bot_a, bot_b, bot_c).

Plan at scale (the buffer is the only non-local part).  A window over the
whole stream would put every row in one task, so arrival order is cut into
blocks of at least ``buffer_size``: a row's buffer lies in its own block and the
end of the one before.  Each row is sent to its own block, and a narrow copy
(its other columns NULL) of a block's last ``buffer_size - 1`` rows to the next
block as context: one scan of the input, one shuffle on (partition, block).
The verdict alone takes blocks of about ``BLOCK_ROWS``, which need few copies;
with attribution, where a group's orders may be spelled out, blocks are
``buffer_size`` long.  Every window group holds less than ``buffer_size`` rows
more than its block whatever the key distribution, so a hot user, product
or stream partition cannot overload a task, and all further steps only sort
inside a task.  No buffer is ever materialized:

* bot_a needs the latest time among the buffer's earlier orders with the same
  user and product: a maximum over a RANGE frame of arrival numbers.
* bot_c needs the latest time of any earlier order and of one with another
  (product, quantity).  Both come from a sliding maximum that keeps the best
  time and the best time of a different (product, quantity); such pairs merge,
  so windows of 6, 36, ... rows are built from each other by ``lag`` and
  overlap to the exact width (a maximum may count a row twice).
* bot_b, given bot_c, needs the user ids of the recent orders, which all share
  one (product, quantity), to rise.  Among the buffer's orders of that
  (product, quantity) the recent ones are the last ones as long as times don't
  fall, and a RANGE maximum over "id falls after this order" answers it.  Only
  for an order whose buffer holds such orders with falling (back-dated) times
  is the buffer spelled out, as rows, and its recent orders compared in turn.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import FRAUD, GENUINE
from ..functions import hour_in, micros, user_number

RULES = ("country", "night_quantity", "night_amount", "bot_a", "bot_b", "bot_c")
RULES_FLAGS = ("f_country", "f_night_quantity", "f_night_amount", "bot_a", "bot_b", "bot_c")


@dataclass(frozen=True)
class FraudParams:
    # Fixed values of the screening rules (defaults of the original platform).
    window_seconds: float = 10.0
    buffer_size: int = 200
    max_quantity: int = 100
    max_amount: int = 100_000_000
    night_start_hour: int = 0
    night_end_hour: int = 4
    home_country: str = "ID"

    @property
    def window_micros(self) -> int:
        return int(round(self.window_seconds * 1_000_000))


DEFAULT = FraudParams()


# --------------------------------------------------------------- row rules
def row_rules(df: DataFrame, params: FraudParams = DEFAULT) -> DataFrame:
    """Add ``f_country``, ``f_night_quantity``, ``f_night_amount``.

    The hour is ``hour(created_date)`` (UTC session), or the ``created_hour``
    column when the input has one (streams take the hour as written in the
    ISO text, whatever its offset).
    """
    if "created_hour" in df.columns:
        h = F.col("created_hour")
        night = (h >= params.night_start_hour) & (h < params.night_end_hour)
    else:
        night = hour_in(F.col("created_date"), params.night_start_hour, params.night_end_hour)
    return df.select(
        "*",
        (~F.col("country").eqNullSafe(F.lit(params.home_country))).alias("f_country"),
        F.coalesce(night & (F.coalesce(F.col("quantity"), F.lit(0)) > params.max_quantity),
                   F.lit(False)).alias("f_night_quantity"),
        F.coalesce(night & (F.coalesce(F.col("amount_numeric"), F.lit(0)) > params.max_amount),
                   F.lit(False)).alias("f_night_amount"),
    )


# ------------------------------------------------------ rolling buffer
_RADIX = 6                    # widths 1, 6, 36: three steps for 199 rows
# Orders of a wide block.  With its context it stays below the 4,096 rows that
# Spark's window keeps as plain objects.
BLOCK_ROWS = 3200


def block_width(params: FraudParams = DEFAULT) -> int:
    """Orders of a wide block: whole buffers, about ``BLOCK_ROWS``, one buffer at least."""
    return params.buffer_size * max(1, BLOCK_ROWS // params.buffer_size)


def with_blocks(df: DataFrame, seq: str = "seq", partition_cols: tuple[str, ...] = ("partition",),
                params: FraudParams = DEFAULT, width: int | None = None) -> DataFrame:
    """Every row in its own block (``_blk``, ``_own`` true) of ``width`` orders
    (default and least: ``buffer_size``) and, when it lies in the buffer of one
    of the next block's, there too, with its other columns NULL; ``_u``, ``_p``,
    ``_q``, ``_n``, ``_t`` are user, product, quantity, numeric user id and event
    time (micros) in both.

    ``seq`` must be dense per partition (0, 1, 2, ... without gaps); Kafka
    offsets of an uncompacted topic are.  Use :func:`dense_sequence` first
    otherwise.
    """
    # Own row and context copy come from one read of the input (a union of two
    # selections would scan and price it twice).
    width = width or params.buffer_size
    own = f"struct(`{seq}` div {width} AS _blk, true AS _own)"
    context = f"struct(`{seq}` div {width} + 1 AS _blk, false AS _own)"
    narrow = {*partition_cols, seq}
    wide = [f"`{c}`" if c in narrow else f"IF(_own, `{c}`, NULL) AS `{c}`" for c in df.columns]
    return df.select(
        "*", F.col("user_id").alias("_u"), F.col("product_id").alias("_p"), F.col("quantity").cast("long").alias("_q"),
        user_number(F.col("user_id")).alias("_n"), micros(F.col("event_ts")).alias("_t"),
        F.expr(f"inline(IF(`{seq}` % {width} > {width - params.buffer_size}, array({own}, {context}), array({own})))"),
    ).selectExpr(*wide, "_u", "_p", "_q", "_n", "_t", "_blk", "_own")


def _names(cols) -> str:
    return ", ".join(f"`{c}`" for c in cols)


def latest_times(blocks: DataFrame, seq: str, partition_cols: tuple[str, ...], before: int) -> DataFrame:
    """Add ``_any``, the latest event time among the ``before`` earlier
    arrivals, and ``_other``, the latest among those with another product or
    quantity.

    A row's state is ``_best`` (time, (product, quantity)) and ``_rest``, the
    latest time of a different (product, quantity).  Merging states: the best
    is the greatest; what competes for the rest is, per state, its rest if it
    has the same (product, quantity) as the winner, else its best.
    """
    if before < 1:
        return blocks.selectExpr("*", "CAST(NULL AS BIGINT) AS _any", "CAST(NULL AS BIGINT) AS _other")
    keep = [f"`{c}`" for c in blocks.columns]
    over = f"OVER (PARTITION BY {_names(partition_cols)}, _blk ORDER BY `{seq}`)"
    state = blocks.selectExpr(*keep, "named_struct('p', _p, 'q', _q) AS _key", "CAST(NULL AS BIGINT) AS _rest").selectExpr(
        *keep, "_key", "_rest", "IF(_t IS NULL, NULL, named_struct('t', _t, 'k', _key)) AS _best")
    keep.append("_key")

    def merged(frame, lags, own, single):
        """States of the rows ``lags`` before (and the row's own) as one;
        ``single``: states of one row each, which have no rest."""
        many = [*(["_best"] if own else []), *(f"_b{i}" for i in lags)]
        rest = [*(["_rest"] if own else []), *(f"_r{i}" for i in lags)]
        columns = [("_best", "_b")] if single else [("_best", "_b"), ("_rest", "_r")]
        look = [f"lag({c}, {i}) {over} AS {a}{i}" for i in lags for c, a in columns]
        best = f"greatest({', '.join(many)})" if len(many) > 1 else many[0]
        of = [f"IF({m}.k <=> _top.k, {'NULL' if single else r}, {m}.t)" for m, r in zip(many, rest)]
        second = f"greatest({', '.join(of)})" if len(of) > 1 else of[0]
        return (frame.selectExpr(*keep, "_best", "_rest", *look).selectExpr(*keep, *many, *([] if single else rest), f"{best} AS _top")
                .selectExpr(*keep, "_top AS _best", f"CAST({second} AS BIGINT) AS _rest"))

    width = 1
    while width * _RADIX <= before:
        state = merged(state, [width * i for i in range(1, _RADIX)], own=True, single=width == 1)
        width *= _RADIX
    ends = sorted({*range(1, before - width + 2, width), before - width + 1})
    return merged(state, ends, own=False, single=width == 1).selectExpr(
        *keep[:-1], "_best.t AS _any", "IF(_best.k <=> _key, _rest, _best.t) AS _other")


def _rising_ids(rows: DataFrame, seq: str, partition_cols: tuple[str, ...], params: FraudParams) -> DataFrame:
    """Add ``_rise`` to own rows with ``_c`` (bot_c): the numeric ids of the
    recent orders are present and never decrease.  Context copies end here."""
    before, thr = params.buffer_size - 1, f"_t - {params.window_micros}"
    keep = [f"`{c}`" for c in rows.columns]
    same = f"PARTITION BY {_names(partition_cols)}, _blk, _p, _q"
    frame = f"OVER ({same} ORDER BY `{seq}` RANGE BETWEEN {before} PRECEDING AND"
    earliest = "coalesce({}, -9223372036854775808)"
    looked = rows.selectExpr(*keep, f"lead(_n) OVER ({same} ORDER BY `{seq}`) AS _next_n",
                             f"lead({earliest.format('_t')}) OVER ({same} ORDER BY `{seq}`) AS _next_t")
    events = looked.selectExpr(*keep, "IF(_next_n < _n, _t, NULL) AS _drop", "IF(_n IS NULL, _t, NULL) AS _unnumbered",
                               f"_next_t < {earliest.format('_t')} AS _fall")
    whole = f"OVER ({same} ORDER BY `{seq}` ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    slid = events.selectExpr(*keep, f"max(_drop) {frame} 1 PRECEDING) AS _drop", f"max(_unnumbered) {frame} CURRENT ROW) AS _unnumbered",
                             f"max(_fall) {frame} 1 PRECEDING) AS _fall",
                             # The last order that may have to be spelled out: times fall somewhere in its group.
                             f"IF(max(_fall) {whole}, max(IF(_own AND _c, `{seq}`, NULL)) {whole}, NULL) AS _last")
    last = slid.selectExpr(*keep, f"NOT coalesce(_drop > {thr}, false) AND NOT coalesce(_unnumbered > {thr}, false) AS _rise",
                           "_own AND _c AND coalesce(_fall, false) AS _spell", "_last")
    # Every earlier order of the (product, quantity) is copied to the orders to spell out.
    copies = last.selectExpr(*keep, "_rise", "_spell", f"explode(IF(_last > `{seq}`, sequence(`{seq}`, least(`{seq}` + {before}, _last)), "
                                                       f"array(`{seq}`))) AS _for")
    own = f"`{seq}` = _for"
    inner = {*partition_cols, seq, "_p", "_q", "_n", "_t", "_blk"}
    copies = copies.selectExpr(*[k if k.strip("`") in inner else f"IF({own}, {k}, NULL) AS {k}" for k in keep], "_for",
                               f"IF({own}, _rise, NULL) AS _rise", f"{own} AND _spell AS _spell")
    asked = copies.selectExpr("*", f"max(IF(_spell, _t, NULL)) OVER ({same}, _for) - {params.window_micros} AS _from")
    asked = asked.filter(f"{own} OR _t > _from")
    turn = asked.selectExpr("*", f"lag(_n) OVER ({same}, _for ORDER BY `{seq}`) AS _before_n")
    turn = turn.selectExpr("*", f"max(_n IS NULL OR coalesce(_before_n > _n, false)) OVER ({same}, _for ORDER BY `{seq}`) AS _falls")
    return turn.filter(f"{own} AND _own").selectExpr(*keep, "IF(_spell, NOT _falls, _rise) AS _rise")


def bot_facts(df: DataFrame, seq: str = "seq", partition_cols: tuple[str, ...] = ("partition",),
              params: FraudParams = DEFAULT, attribution: bool = True) -> DataFrame:
    """Add ``bot_a`` and ``bot_c`` (F4, F6) and, with ``attribution``, ``bot_b``."""
    before, thr = params.buffer_size - 1, f"_t - {params.window_micros}"
    blocks = with_blocks(df, seq, partition_cols, params, None if attribution else block_width(params))
    rows = latest_times(blocks, seq, partition_cols, before)
    keep = [f"`{c}`" for c in rows.columns if c not in ("_any", "_other")]
    same = (f"OVER (PARTITION BY {_names(partition_cols)}, _blk, _u, _p ORDER BY `{seq}` "
            f"RANGE BETWEEN {before} PRECEDING AND 1 PRECEDING)") if before else None
    rows = rows.selectExpr(*keep, f"coalesce(_any > {thr} AND NOT coalesce(_other > {thr}, false), false) AS _c",
                           f"max(_t) {same} AS _pair" if same else "CAST(NULL AS BIGINT) AS _pair")
    rows = rows.selectExpr(*keep, "_c", f"coalesce(_pair > {thr}, false) AS _a")
    flags = ["_a AS bot_a", "_c AS bot_c"]
    if attribution and before:
        rows = _rising_ids(rows, seq, partition_cols, params)
        flags.append("_c AND _rise AS bot_b")
    else:
        rows = rows.filter("_own")
        flags += ["false AS bot_b"] if attribution else []
    return rows.selectExpr(*[f"`{c}`" for c in df.columns], *flags)


# ------------------------------------------------------ rules and verdict
def screen(orders: DataFrame, seq: str = "seq", partition_cols: tuple[str, ...] = ("partition",),
           params: FraudParams = DEFAULT, keep_flags: bool = False, attribution: bool = True) -> DataFrame:
    """Classify every order: ``status`` becomes ``Fraud`` / ``Genuine`` and
    ``first_rule`` names the first rule that fired (NULL when genuine).

    The input keeps all its columns; with ``keep_flags`` the six rule flags
    (``f_country``, ``f_night_quantity``, ``f_night_amount``, ``bot_a``,
    ``bot_b``, ``bot_c``) are added too.  ``attribution=False`` leaves out
    ``first_rule`` (and with it bot_b, which never decides a verdict).
    """
    if keep_flags and not attribution:
        raise ValueError("the rule flags include bot_b, which needs attribution")
    out = bot_facts(row_rules(orders, params), seq, partition_cols, params, attribution)
    # bot_b implies bot_c, so the verdict does without it.
    fraud = " OR ".join(f for f in RULES_FLAGS if f != "bot_b")
    status = f"IF({fraud}, '{FRAUD}', '{GENUINE}') AS status"
    cols = [status if c == "status" else f"`{c}`" for c in orders.columns]
    if "status" not in orders.columns:
        cols.append(status)
    if attribution:
        cols.append("CASE " + " ".join(f"WHEN {flag} THEN '{name}'" for flag, name in zip(RULES_FLAGS, RULES)) + " END AS first_rule")
    return out.selectExpr(*cols, *(RULES_FLAGS if keep_flags else ()))


# ----------------------------------------------------- dense arrival numbers
def dense_sequence(df: DataFrame, order_col: str, partition_cols: tuple[str, ...] = ("partition",),
                   out_col: str = "seq", block: int = 1 << 16, block_col: str | None = None) -> DataFrame:
    """Number rows 0, 1, 2, ... per partition in ``order_col`` order, for
    offsets with gaps (compacted or transactional topics).

    Counts per (partition, offset block) are small (rows / ``block``); their
    running sum gives each block's first number, and a row's number is that
    plus its rank inside the block.  No step sees more than one block.
    ``block_col`` names the block number's column of rows that already lie by
    ``partition_cols`` and it, and isn't kept.
    """
    b = F.col(block_col) if block_col else F.expr(f"`{order_col}` div {block}")
    with_b = df.withColumnRenamed(block_col, "_ob") if block_col else df.select("*", b.alias("_ob"))
    counts = with_b.groupBy(*partition_cols, "_ob").agg(F.count(F.lit(1)).alias("_n"))
    wcum = Window.partitionBy(*partition_cols).orderBy("_ob").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*partition_cols, "_ob",
                           F.coalesce(F.sum("_n").over(wcum), F.lit(0)).alias("_start"))
    rank = F.row_number().over(Window.partitionBy(*partition_cols, "_ob").orderBy(order_col)) - 1
    # Ranked first: the rows then lie in the join's order, too, and are sorted once.
    return (with_b.withColumn("_rank", rank).join(starts, on=[*partition_cols, "_ob"])
                  .withColumn(out_col, F.col("_start") + F.col("_rank"))
                  .drop("_ob", "_start", "_rank"))
