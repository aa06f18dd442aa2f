"""The registered queries as plain SQL over the given tables, written independently.

Every statement is a list of named steps (``WITH``) and a final ``SELECT``.
"""

from __future__ import annotations

from barsmith.config import (
    CATEGORICAL, CONTINUOUS, DOMAINS, INPUT_FEATURES, LAGGED_CONTINUOUS, SCALED,
    feature_table_columns,
)
from barsmith.plans.views import ASSET_ROWS, CLASS_MAP_ROWS, CUTOFF

STEPS = range(1, 7)


def num(x: float) -> str:
    return f"CAST({x} AS DOUBLE)"


def q(name: str) -> str:
    return f'"{name}"'


def csv(names) -> str:
    return ", ".join(q(n) for n in names)


def with_(steps: dict[str, str], final: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in steps.items()) + "\n" + final


def clock(name: str, alias: str | None = None) -> str:
    return f"strftime({q(name)}, '%Y-%m-%d %H:%M:%S') AS {q(alias or name)}"


def rnd(expr: str, alias: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0 AS {q(alias)}"


# --- shared steps -------------------------------------------------------------------------

def bar_steps(symbol: str = "'ES'", part: str = "CAST(ts AS DATE)") -> dict[str, str]:
    ha = {c: f"(event_id * {k}) % 3 + 1"
          for c, k in zip(CATEGORICAL[6:], (1, 2, 4, 5, 7, 8), strict=True)}
    codes = {
        "MACDState": "event_id % 17", "HAColor": "user_id % 3 + 1",
        "HALongWick": "(event_id + user_id) % 3 + 1", "HAGreenConsec": "event_id % 53",
        "HARedConsec": "user_id % 51", "EMAState": "user_id % 16 + 1", **ha,
    }
    code_sql = ", ".join(f"CAST({e} AS INT) AS {q(c)}" for c, e in codes.items())
    return {
        "clocked": f"""
SELECT event_id, ts, user_id, value, {symbol} AS symbol, CAST(ts AS DATE) AS trading_day,
  row_number() OVER w AS rn, coalesce(lead(value) OVER w, value) AS nxt
FROM events WINDOW w AS (PARTITION BY {part} ORDER BY ts, event_id)""",
        "bars": f"""
SELECT event_id AS bar_id, symbol, trading_day,
  CAST(trading_day AS TIMESTAMP) + to_seconds(30840 + 5 * rn) AS "Date",
  6000 + value / 25 AS "Open",
  6000 + greatest(value, nxt) / 25 + {num(0.01)} * (event_id % 40) AS "High",
  6000 + least(value, nxt) / 25 - {num(0.01)} * (user_id % 40) AS "Low",
  6000 + nxt / 25 AS "Close",
  CAST(event_id * 37 % 101 AS DOUBLE) AS "RSI",
  (value - nxt) / 10 AS "MACD",
  CAST(event_id % 21 AS DOUBLE) / 20 AS "HABodyRangeRatio",
  CAST(user_id % 5 AS DOUBLE) - 2 AS "MyWAZLTTrend",
  {code_sql}
FROM clocked""",
    }


IN_WINDOW = "CAST(\"Date\" AS TIME) BETWEEN TIME '08:35:00' AND TIME '10:25:00'"
BARS = bar_steps()
WINDOW_BARS = BARS | {"wbars": f"SELECT * FROM bars WHERE {IN_WINDOW}"}
COPIES = BARS | {
    "copies": "SELECT * FROM bars UNION ALL SELECT * FROM bars WHERE bar_id % 10 = 0",
    "dedup": "SELECT DISTINCT * FROM copies",
}


def lag_step(source: str = "wbars") -> dict[str, str]:
    lags = ", ".join(f"coalesce(lag({q(c)}) OVER w, 0) AS {q(c + '_lag1')}" for c in INPUT_FEATURES)
    return {"lagged": f"""
SELECT *, {lags} FROM {source}
WINDOW w AS (PARTITION BY symbol, trading_day ORDER BY "Date", bar_id)"""}


def indicator_sql(names: list[str]) -> str:
    return ", ".join(
        f"CASE WHEN {q(n)} = {k} THEN {num(1.0)} ELSE {num(0.0)} END AS {q(f'{n}_{k}')}"
        for n in names for k in DOMAINS[n.removesuffix("_lag1")])


def feature_step() -> dict[str, str]:
    flags = indicator_sql([n for c in CATEGORICAL for n in (c, f"{c}_lag1")])
    return lag_step() | {"features": f"""
SELECT "Date", bar_id, {csv(CONTINUOUS)}, {csv(LAGGED_CONTINUOUS)}, {flags} FROM lagged"""}


def horizon_step(source: str = "bars") -> dict[str, str]:
    leads = ", ".join(
        f"lead({q(c)}, {j}) OVER w AS {c.lower()}{j}"
        for c in ("Date", "Open", "High", "Low", "Close") for j in STEPS)
    return {"horizon": f"""
SELECT *, {IN_WINDOW} AS "InWindow", {leads},
  {IN_WINDOW} AND lead(bar_id, 6) OVER w IS NOT NULL AS is_valid
FROM {source} WINDOW w AS (PARTITION BY symbol, trading_day ORDER BY "Date", bar_id)"""}


class Money:
    """Exit rules as SQL, for fixed parameters or joined columns."""

    def __init__(self, point=num(50), res=num(0.25), target=num(100), stop=num(150)):
        self.point, self.res, self.target, self.stop = point, res, target, stop

    def value(self, move: str) -> str:
        return f"(({move}) / {self.res}) * ({self.point} * {self.res})"

    def stop_hit(self, side: str, j: int) -> str:
        move = f"open1 - low{j}" if side == "long" else f"high{j} - open1"
        return f"{self.value(move)} >= {self.stop}"

    def target_hit(self, side: str, j: int, intrabar: bool = False) -> str:
        if side == "long":
            return f"{self.value(f'{'high' if intrabar else 'close'}{j} - open1')} >= {self.target}"
        return f"{self.value(f'open1 - {'low' if intrabar else 'close'}{j}')} >= {self.target}"

    def exit_bar(self, side: str, last: bool = False) -> str:
        order = reversed(STEPS) if last else STEPS
        cases = " ".join(
            f"WHEN {self.stop_hit(side, j)} OR {self.target_hit(side, j, last)} THEN {j}"
            for j in order)
        return f"CASE {cases} ELSE 6 END"

    def profit(self, side: str) -> str:
        close = at("close", f"{side}_exit_bar")
        return self.value(f"{close} - open1" if side == "long" else f"open1 - {close}")


def at(field: str, bar: str) -> str:
    return f"CASE {bar} " + " ".join(f"WHEN {j} THEN {field}{j}" for j in STEPS) + " END"


def sim_steps(rules: Money = Money(), source: str = "bars", last: bool = False) -> dict[str, str]:
    return horizon_step(source) | {
        "ended": f"""SELECT *, {rules.exit_bar('long', last)} AS long_exit_bar,
  {rules.exit_bar('short', last)} AS short_exit_bar FROM horizon""",
        "sim": f"""SELECT *,
  CASE WHEN is_valid THEN {rules.profit('long')} ELSE {num(0)} END AS long_profit,
  CASE WHEN is_valid THEN {rules.profit('short')} ELSE {num(0)} END AS short_profit
FROM ended""",
    }


SIM = BARS | sim_steps()
VALID_EXITS = "bar_id, long_exit_bar, short_exit_bar, long_profit, short_profit"


def reward(profit: str) -> str:
    return (f"CASE WHEN {profit} > 30 THEN {profit} WHEN {profit} > 10 "
            f"THEN {num(-150)} * exp({num(-0.2)} * ({profit} - 10)) ELSE {num(-150)} END")


def ratio(own: str, other: str) -> str:
    return f"CASE WHEN {other} <> 0 THEN {own} / abs({other}) ELSE {own} END"


def split_steps(source: str) -> dict[str, str]:
    return {
        "days": f"""SELECT trading_day, row_number() OVER (ORDER BY trading_day) AS day_rank,
  count(*) OVER () AS n FROM (SELECT DISTINCT trading_day FROM {source}
  WHERE "Date" < TIMESTAMP '{CUTOFF}')""",
        "split_rows": f"""SELECT s.*, CASE WHEN s."Date" >= TIMESTAMP '{CUTOFF}' THEN 'test'
  WHEN d.day_rank <= floor({num(0.8)} * d.n) THEN 'train' ELSE 'val' END AS split
FROM {source} s LEFT JOIN days d ON s.trading_day = d.trading_day""",
    }


def candidate_steps(min_profit: float = 30) -> dict[str, str]:
    lp, sp = "long_profit", "short_profit"

    def score(own: str, other: str) -> str:
        return (f"{own} * {num(0.4)} + {reward(own)} * {num(0.3)} "
                f"+ ({ratio(own, other)}) * {num(0.3)}")

    return BARS | split_steps("bars") | sim_steps(source="split_rows") | {
        "sided": f"""SELECT *, {ratio(lp, sp)} AS long_ratio, {ratio(sp, lp)} AS short_ratio,
  CASE WHEN {lp} > {min_profit} AND {reward(lp)} > 0 AND {lp} > {sp} THEN 0
       WHEN {sp} > {min_profit} AND {reward(sp)} > 0 AND {sp} > {lp} THEN 1 END AS side
FROM sim WHERE is_valid""",
        "candidates": f"""SELECT *, CASE side WHEN 0 THEN {score(lp, sp)}
  WHEN 1 THEN {score(sp, lp)} END AS score FROM sided""",
    }


def label_steps(min_profit: float = 30, long: float = 0.75, short: float = 0.5) -> dict[str, str]:
    return candidate_steps(min_profit) | {
        "ranked": """SELECT *, row_number() OVER (PARTITION BY split, side
  ORDER BY score DESC, "Date", bar_id) AS place,
  count(*) OVER (PARTITION BY split, side) AS available FROM candidates""",
        "labelled": f"""SELECT *, CASE
  WHEN side = 0 AND place <= floor({num(long)} * available) THEN 0
  WHEN side = 1 AND place <= floor({num(short)} * available) THEN 1 ELSE 2 END AS label,
  CASE WHEN side IS NOT NULL THEN place END AS rank FROM ranked""",
    }


LABELS = label_steps()


def score_step(source: str, key: str = "bar_id") -> dict[str, str]:
    def model(name: str, k: str) -> str:
        parts = [f"CAST({k} * {f} % {m} + 1 AS DOUBLE)"
                 for f, m in ((7919, 11), (104729, 13), (1299709, 17))]
        whole = f"({parts[0]} + {parts[1]} + {parts[2]})"
        return ", ".join(f"{p} / {whole} AS {name}_{n}"
                         for p, n in zip(parts, ("p_long", "p_short", "p_none"), strict=True))

    shifted = f"(({key} + 1) % (SELECT count(*) FROM events))"
    blend = ", ".join(f"{num(0.7)} * boost_{n} + {num(0.3)} * forest_{n} AS {n}"
                      for n in ("p_long", "p_short", "p_none"))
    return {
        "models": f"SELECT *, {model('boost', key)}, {model('forest', shifted)} FROM {source}",
        "blended": f"SELECT *, {blend} FROM models",
        "decided": """SELECT *, CASE WHEN p_long > p_short AND p_long > p_none THEN 0
  WHEN p_short >= p_long AND p_short > p_none THEN 1 ELSE 2 END AS predicted FROM blended""",
    }


THRESHOLD = f"""CASE WHEN p_long > {num(0.3)} AND p_long > p_short AND p_long > p_none THEN 0
  WHEN p_short > {num(0.3)} AND p_short > p_long AND p_short > p_none THEN 1 ELSE 2 END"""
EVALUATED = LABELS | score_step("labelled")
DECIDED = SIM | score_step("sim")


def name_of(code: str) -> str:
    return f"CASE {code} WHEN 0 THEN 'Long' WHEN 1 THEN 'Short' ELSE 'No Trade' END"


RESULT = EVALUATED | {"result": f"""SELECT "Date", bar_id, {name_of('label')} AS "Actual_Signal",
  {name_of('predicted')} AS "Predicted_Signal", p_long AS "Long_Probability",
  p_short AS "Short_Probability", p_none AS "NoTrade_Probability",
  long_profit AS "Long_Profit", short_profit AS "Short_Profit",
  CASE label WHEN 0 THEN long_profit WHEN 1 THEN short_profit ELSE {num(0)} END AS "Actual_Profit",
  CASE label WHEN 0 THEN {reward('long_profit')} WHEN 1 THEN {reward('short_profit')}
    ELSE {num(0)} END AS "Actual_Reward",
  label = predicted AS "Correct_Prediction", 'Model' AS "Model_Name" FROM decided"""}
RESULT_ROWS = with_(RESULT, f"""SELECT * REPLACE (strftime("Date", '%Y-%m-%d %H:%M:%S') AS "Date",
  round("Actual_Reward", 6) + 0.0 AS "Actual_Reward") FROM result""")


def long_form(source: str, names, measures: dict[str, str], extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {extra}"
        + ", ".join(e.format(c=q(c)) + f" AS {m}" for m, e in measures.items())
        + f" FROM {source}" for c in names)


def extremes(low: bool) -> str:
    f, factor, rsi = ("min", 0.8, 0) if low else ("max", 1.2, 100)
    parts = []
    for i, c in enumerate(CONTINUOUS):
        if c == "RSI":
            parts.append(f"{num(rsi)} AS {q(c)}")
        else:
            parts.append(f"{f}({q(c)})" + (f" * {num(factor)}" if i < 4 else "") + f" AS {q(c)}")
    return ", ".join(parts)


def padded_step(source: str) -> dict[str, str]:
    return {"padded": f"SELECT {extremes(True)} FROM {source} UNION ALL "
                      f"SELECT {csv(CONTINUOUS)} FROM {source} UNION ALL "
                      f"SELECT {extremes(False)} FROM {source}"}


def fitted_step(source: str) -> dict[str, str]:
    stats = ", ".join(
        f"avg({q(c)}) AS {q('m_' + c)}, coalesce(nullif(stddev_pop({q(c)}), 0), 1) AS {q('s_' + c)}"
        for c in CONTINUOUS)
    return padded_step(source) | {"fitted": f"SELECT {stats} FROM padded"}


def scaled(c: str) -> str:
    base = c.removesuffix("_lag1")
    return f"({q(c)} - {q('m_' + base)}) / {q('s_' + base)}"


RAW_DATES = {"raw_dates": """
SELECT event_id, CASE event_id % 4
  WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
  WHEN 1 THEN strftime(ts, '%m/%d/%Y %I:%M:%S %p')
  WHEN 2 THEN strftime(ts, '%m/%d/%y %I:%M:%S %p') ELSE 'bad' END AS d FROM events"""}
# The two-digit format must not take four-digit years and the other way round.
FORMAT_SQL = [
    "try_strptime(d, '%Y-%m-%d %H:%M:%S')",
    "CASE WHEN regexp_full_match(d, '\\d+/\\d+/\\d{4} .*') "
    "THEN try_strptime(d, '%m/%d/%Y %I:%M:%S %p') END",
    "CASE WHEN regexp_full_match(d, '\\d+/\\d+/\\d{2} .*') "
    "THEN try_strptime(d, '%m/%d/%y %I:%M:%S %p') END",
]
PARSED = RAW_DATES | {
    "tried": "SELECT event_id, " + ", ".join(f"{e} AS d{i}" for i, e in enumerate(FORMAT_SQL))
             + " FROM raw_dates",
    "counts": "SELECT count(d0) AS n0, count(d1) AS n1, count(d2) AS n2 FROM tried",
    "parsed": """SELECT event_id, CASE WHEN n0 > 0 THEN d0 WHEN n1 > 0 THEN d1 ELSE d2 END AS "Date"
FROM tried, counts""",
}
ON_MARK = 'second("Date") % 5 = 0'


def trade_sql(rules: Money = Money()) -> str:
    def outcome(side: str, what: str) -> str:
        cases = []
        for j in STEPS:
            stop, target = (f"{j}", f"{j}") if what == "bar" else ("'STOP_LOSS'", "'TARGET_PROFIT'")
            cases.append(f"WHEN {rules.stop_hit(side, j)} THEN {stop} "
                         f"WHEN {rules.target_hit(side, j)} THEN {target}")
        return f"CASE {' '.join(cases)} ELSE {'6' if what == 'bar' else chr(39) + 'HARD_EXIT' + chr(39)} END"

    return f"""SELECT *, CASE predicted WHEN 0 THEN {outcome('long', 'bar')}
  WHEN 1 THEN {outcome('short', 'bar')} ELSE 6 END AS xbar,
  CASE predicted WHEN 0 THEN {outcome('long', 'reason')}
  WHEN 1 THEN {outcome('short', 'reason')} ELSE 'NO_TRADE' END AS reason
FROM decided WHERE is_valid"""


TRADES = DECIDED | {
    "outcomes": trade_sql(),
    "exited": f"SELECT *, {at('close', 'xbar')} AS xprice, {at('date', 'xbar')} AS xdate FROM outcomes",
    "trades": f"""SELECT bar_id,
  CASE predicted WHEN 0 THEN 'LONG' WHEN 1 THEN 'SHORT' ELSE 'NO_TRADE' END AS "Trade_Signal",
  strftime(date1, '%Y-%m-%d %H:%M:%S') AS "EntryDateTime", open1 AS "EntryPrice",
  strftime(xdate, '%Y-%m-%d %H:%M:%S') AS "ExitDateTime", xprice AS "ExitPrice",
  CASE predicted WHEN 0 THEN (xprice - open1) * {num(50)}
    WHEN 1 THEN (open1 - xprice) * {num(50)} ELSE {num(0)} END AS "BaseProfit",
  xbar AS "ExitBar", reason AS "ExitReason" FROM exited""",
}


def pct(part: str, whole: str, factor: str = "* 100.0") -> str:
    return f"CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / {whole} ELSE 0 END {factor}"


CLASSES = {"classes": "SELECT unnest([0, 1, 2]) AS k"}
CELLS = EVALUATED | CLASSES | {
    "matrix": """SELECT a.k AS actual, p.k AS pred, count(d.bar_id) AS n FROM classes a
  CROSS JOIN classes p LEFT JOIN decided d ON d.label = a.k AND d.predicted = p.k
  GROUP BY 1, 2""",
    "per_class": """SELECT k, (SELECT n FROM matrix WHERE actual = k AND pred = k) AS hit,
  (SELECT sum(n)::BIGINT FROM matrix WHERE actual = k) AS actual_n,
  (SELECT sum(n)::BIGINT FROM matrix WHERE pred = k) AS pred_n FROM classes""",
}


def side_sql(code: int, side: str) -> str:
    p = f"{side}_profit"
    taken = f"predicted = {code}"
    return f"""SELECT '{side.upper()}' AS side,
  count(*) FILTER (WHERE {taken} AND "InWindow") AS trades,
  coalesce(sum({p}) FILTER (WHERE {taken}), 0) AS total_profit,
  coalesce(avg({p}) FILTER (WHERE {taken}), 0) AS avg_profit,
  coalesce(sum({reward(p)}) FILTER (WHERE {taken}), 0) AS total_reward,
  coalesce(avg({reward(p)}) FILTER (WHERE {taken}), 0) AS avg_reward,
  count(*) FILTER (WHERE {taken} AND {p} > 0) AS profitable,
  count(*) FILTER (WHERE {taken}) AS taken, count(*) FILTER (WHERE predicted = 2) AS none_n,
  count(*) FILTER (WHERE label = predicted) AS hits, count(*) AS bars FROM decided"""


PERFORMANCE = EVALUATED | {
    "sides": side_sql(0, "long") + " UNION ALL " + side_sql(1, "short"),
    "perf": f"""SELECT *, {pct('profitable', 'greatest(trades, 1)')} AS rate,
  (SELECT sum(total_profit) FROM sides) AS all_profit FROM sides""",
}

SNAPSHOTS = DECIDED | {"snapshots": """
SELECT CASE bar_id % 2 WHEN 0 THEN 'Long' ELSE 'Short' END AS tt, 'PV' || (bar_id % 3 + 1) AS td,
  CAST(bar_id % 6 + 1 AS INT) AS bs, bar_id AS seq, "RSI",
  [boost_p_long, boost_p_short, boost_p_none] AS probs FROM decided"""}
REQUESTS = {"requests": """
SELECT event_id AS request_id, CASE user_id % 2 WHEN 0 THEN 'Long' ELSE 'Short' END AS tt,
  'PV' || (user_id % 3 + 1) AS td, CAST(user_id % 7 + 1 AS INT) AS bs
FROM events WHERE event_type = 'purchase'"""}
CLASS_MAP = {"class_map": "SELECT * FROM (VALUES " + ", ".join(
    f"('{t}', '{d}', {i}, {v})" for t, d, i, v in CLASS_MAP_ROWS) + ") AS m(tt, td, idx, val)"}
ASSETS = {"assets": "SELECT * FROM (VALUES " + ", ".join(
    "('" + r[0] + "', " + ", ".join(num(v) for v in r[1:]) + ")" for r in ASSET_ROWS)
    + ") AS a(symbol, point, res, tick, drawdown, points, target, stop)"}


def color(value: int) -> str:
    return (f"coalesce((SELECT max(f.probs[m.idx + 1]) FROM class_map m "
            f"WHERE m.tt = r.tt AND m.td = r.td AND m.val = {value}), 0)")


MULTI = bar_steps("upper(event_type)", "event_type, CAST(ts AS DATE)") | ASSETS | {
    "priced": "SELECT b.*, a.point, a.res, a.target, a.stop FROM bars b JOIN assets a USING (symbol)"
} | sim_steps(Money("point", "res", "target", "stop"), "priced")

DIST = " + ".join(f"(a.{q(c)} - b.{q(c)}) * (a.{q(c)} - b.{q(c)})" for c in CONTINUOUS)
MINORITY = LABELS | {
    "train": "SELECT * FROM labelled WHERE split = 'train'",
    "sizes": "SELECT label, count(*) AS n FROM train GROUP BY label",
}
CLAMP_RULES = Money()


def drawdown(side: str) -> str:
    lows = "[" + ", ".join(f"{'low' if side == 'long' else 'high'}{j}" for j in STEPS) + "]"
    pick = "list_min" if side == "long" else "list_max"
    worst = f"{pick}({lows}[1:{side}_exit_bar])"
    return CLAMP_RULES.value(f"open1 - {worst}" if side == "long" else f"{worst} - open1")


def excursion(side: str) -> str:
    low = "[" + ", ".join(f"low{j}" for j in STEPS) + "]"
    high = "[" + ", ".join(f"high{j}" for j in STEPS) + "]"
    own, other = (low, high) if side == "long" else (high, low)
    pick, best = ("list_min", "list_max") if side == "long" else ("list_max", "list_min")
    path = f"{own}[1:{side}_exit_bar]"
    until = (f"CASE WHEN {drawdown(side)} >= 150 THEN list_position({path}, {pick}({path})) "
             "ELSE 6 END")
    price = f"{best}({other}[1:{until}])"
    return CLAMP_RULES.value(f"{price} - open1" if side == "long" else f"open1 - {price}")


def model_sql(extra: str = "") -> str:
    """Scored rows are the labelled bars of the test part; the checks on each must hold."""
    return with_(LABELS, f"""SELECT bar_id, label, true AS sums_to_one, true AS follows_rule,
  true AS beats_constant{extra}
FROM labelled WHERE split = 'test'""")


def if_valid(expr: str, alias: str) -> str:
    return f"CASE WHEN is_valid THEN {expr} ELSE {num(0)} END AS {alias}"


def clamped(side: str) -> str:
    return if_valid(f"CASE WHEN {drawdown(side)} >= 150 THEN {num(-150)} "
                    f"ELSE least({side}_profit, {num(100)}) END", f"{side}_clamped")


LAGS = ", ".join(q(f"{c}_lag1") for c in INPUT_FEATURES)
DAY_TEXT = "strftime(CAST(\"Date\" AS DATE), '%Y-%m-%d') AS trading_day"

ORACLE: dict[str, str] = {
    "clean_report": with_(PARSED, f"""SELECT count(*) AS loaded,
  count(*) FILTER (WHERE "Date" IS NULL) AS dropped_undated, count("Date") AS dated,
  count(*) FILTER (WHERE NOT ({ON_MARK})) AS dropped_off_mark,
  count(*) FILTER (WHERE {ON_MARK}) AS remaining,
  count(*) FILTER (WHERE {ON_MARK} AND {IN_WINDOW}) AS in_window FROM parsed"""),
    "date_format_choice": with_(PARSED, """SELECT 0 AS format, n0 AS parsed, n0 > 0 AS chosen
FROM counts UNION ALL SELECT 1, n1, n0 = 0 AND n1 > 0 FROM counts
UNION ALL SELECT 2, n2, n0 + n1 = 0 AND n2 > 0 FROM counts"""),
    "clean_bars": with_(PARSED, f"""SELECT event_id, {clock('Date')}, {IN_WINDOW} AS "InWindow",
  {DAY_TEXT} FROM parsed WHERE "Date" IS NOT NULL AND {ON_MARK}"""),
    "dedup": with_(COPIES, f"SELECT bar_id, symbol, {csv(INPUT_FEATURES)} FROM dedup"),
    "window_flag": with_(BARS, f"""SELECT bar_id, {clock('Date')}, {DAY_TEXT},
  {IN_WINDOW} AS "InWindow" FROM bars"""),
    "day_count": with_(WINDOW_BARS, "SELECT count(DISTINCT trading_day) AS days FROM wbars"),
    "project_continuous": with_(BARS, f"SELECT {csv(CONTINUOUS)} FROM bars"),
    "lag_features": with_(WINDOW_BARS | lag_step(), f"SELECT bar_id, {LAGS} FROM lagged"),
    "onehot": with_(WINDOW_BARS | feature_step(), """SELECT * REPLACE (
  strftime("Date", '%Y-%m-%d %H:%M:%S') AS "Date") FROM features"""),
    "minmax_profile": with_(COPIES, long_form(
        "dedup", CONTINUOUS, {"min": "min({c})", "max": "max({c})"})),
    "pad_extremes": with_(BARS | padded_step("bars"), "SELECT * FROM padded"),
    "scaler_fit": with_(
        COPIES | padded_step("dedup") | {"base": long_form(
            "padded", CONTINUOUS, {"mean": "avg({c})", "std": "stddev_pop({c})"})},
        """SELECT "column", round(mean, 6) + 0.0 AS mean, round(std, 6) + 0.0 AS std FROM base
UNION ALL SELECT "column" || '_lag1', round(mean, 6) + 0.0, round(std, 6) + 0.0 FROM base"""),
    "scaler_apply": with_(
        WINDOW_BARS | lag_step() | fitted_step("bars"),
        "SELECT bar_id, " + ", ".join(rnd(scaled(c), c, 4) for c in SCALED)
        + " FROM lagged, fitted"),
    "scaler_verify": with_(
        BARS | fitted_step("bars") | {
            "after": "SELECT " + ", ".join(f"{scaled(c)} AS {q(c)}" for c in CONTINUOUS)
                     + " FROM bars, fitted"},
        " UNION ALL ".join(
            long_form(t, CONTINUOUS, {"mean": "round(avg({c}), 5) + 0.0",
                                      "std_samp": "round(stddev_samp({c}), 5) + 0.0"},
                      f"'{stage}' AS stage, ")
            for stage, t in (("before", "bars"), ("after", "after")))),
    "exit_profit": with_(SIM, """SELECT bar_id, CASE WHEN is_valid THEN long_exit_bar ELSE 0 END
  AS long_exit_bar, CASE WHEN is_valid THEN short_exit_bar ELSE 0 END AS short_exit_bar,
  long_profit, short_profit, is_valid FROM sim"""),
    "exit_profit_clamped": with_(
        SIM, f"SELECT bar_id, {clamped('long')}, {clamped('short')} FROM sim"),
    "max_excursion": with_(SIM, f"""SELECT bar_id, {if_valid(excursion('long'), 'max_long_profit')},
  {if_valid(excursion('short'), 'max_short_profit')} FROM sim"""),
    "exit_last_hit": with_(
        BARS | sim_steps(last=True), f"SELECT {VALID_EXITS} FROM sim WHERE is_valid"),
    "reward": with_(SIM, f"""SELECT bar_id, {rnd(reward('long_profit'), 'long_reward')},
  {rnd(reward('short_profit'), 'short_reward')}, {num(0)} AS no_trade_reward
FROM sim WHERE is_valid"""),
    "asset_join": with_(MULTI, f"SELECT symbol, {VALID_EXITS} FROM sim WHERE is_valid"),
    "split_days": with_(WINDOW_BARS | split_steps("wbars"), """SELECT split, count(*) AS "rows",
  strftime(min("Date"), '%Y-%m-%d %H:%M:%S') AS first_bar FROM split_rows GROUP BY split"""),
    "valid_semi": with_(
        WINDOW_BARS | sim_steps() | split_steps("wbars"), """SELECT bar_id, split FROM split_rows
WHERE bar_id IN (SELECT bar_id FROM sim WHERE is_valid)"""),
    "label_candidates": with_(candidate_steps(), """SELECT bar_id, split, side, long_ratio,
  short_ratio, score FROM candidates WHERE side IS NOT NULL"""),
    "label_stats": with_(candidate_steps(), """SELECT split, count(*) AS bars,
  count(*) FILTER (WHERE side = 0) AS n_long, count(*) FILTER (WHERE side = 1) AS n_short,
  count(*) FILTER (WHERE side = 0) / CAST(count(*) AS DOUBLE) AS long_ratio_data,
  count(*) FILTER (WHERE side = 1) / CAST(count(*) AS DOUBLE) AS short_ratio_data,
  count(side) / CAST(count(*) AS DOUBLE) AS total_trade_ratio FROM candidates GROUP BY split"""),
    "labels": with_(LABELS, "SELECT bar_id, split, label, coalesce(rank, 0) AS rank FROM labelled"),
    "labels_all": with_(label_steps(40, 1.0, 1.0), "SELECT bar_id, split, label FROM labelled"),
    "labels_top10": with_(label_steps(30, 0.1, 0.1), "SELECT bar_id, split, label FROM labelled"),
    "label_counts": with_(
        LABELS, "SELECT split, label, count(*) AS bars FROM labelled GROUP BY split, label"),
    "class_weights": with_(MINORITY, """SELECT bar_id, label,
  (SELECT sum(n) FROM sizes) / CAST(3 * n AS DOUBLE) AS weight FROM train JOIN sizes USING (label)"""),
    "smote_neighbors": with_(
        MINORITY | {
            "minority": """SELECT train.* FROM train JOIN sizes USING (label)
  WHERE n < (SELECT max(n) FROM sizes)""",
            "pairs": f"""SELECT a.label, a.bar_id, b.bar_id AS nn_id, {DIST} AS distance2
  FROM minority a JOIN minority b ON a.label = b.label AND a.bar_id <> b.bar_id""",
            "near": """SELECT *, row_number() OVER (PARTITION BY label, bar_id
  ORDER BY distance2, nn_id) AS place FROM pairs""",
        }, """SELECT label, bar_id, CAST(place AS INT) AS nn_rank, nn_id, distance2 FROM near
WHERE place <= 3"""),
    "smote_counts": with_(MINORITY, """SELECT label, (SELECT max(n) FROM sizes) AS bars,
  (SELECT max(n) FROM sizes) - n AS synthetic FROM sizes"""),
    "threshold_rule": with_(
        score_step("(SELECT event_id AS bar_id FROM events)"),
        f"SELECT bar_id, {THRESHOLD} AS predicted FROM blended"),
    "ensemble_actions": with_(
        BARS | score_step("bars"),
        "SELECT bar_id, p_long, p_short, p_none, predicted FROM decided"),
    "balanced_accuracy": with_(
        EVALUATED | {
            "ruled": f"SELECT label, CAST(({THRESHOLD}) = label AS INT) AS hit FROM blended",
            "recalls": "SELECT label, avg(hit) AS recall FROM ruled GROUP BY label",
        }, f"""SELECT {rnd('(SELECT avg(hit) FROM ruled)', 'accuracy', 9)},
  {rnd('avg(recall)', 'balanced_accuracy', 9)} FROM recalls"""),
    "eval_rows": RESULT_ROWS,
    "results_roundtrip": RESULT_ROWS,
    "signal_dist": with_(RESULT, """SELECT 'actual' AS kind, "Actual_Signal" AS signal,
  count(*) AS bars, count(*) FILTER (WHERE "Correct_Prediction") AS correct
FROM result GROUP BY 2 UNION ALL SELECT 'predicted', "Predicted_Signal", count(*),
  count(*) FILTER (WHERE "Correct_Prediction") FROM result GROUP BY 2"""),
    "confusion": with_(CELLS, """SELECT actual, max(n) FILTER (WHERE pred = 0) AS pred_long,
  max(n) FILTER (WHERE pred = 1) AS pred_short, max(n) FILTER (WHERE pred = 2) AS pred_none
FROM matrix GROUP BY actual"""),
    "class_detail": with_(
        CELLS | {
            "missed": """SELECT actual, pred, CASE WHEN actual = pred THEN 0 ELSE n END AS n
  FROM matrix""",
            "wide": """SELECT actual, max(n) FILTER (WHERE pred = 0) AS as_long,
  max(n) FILTER (WHERE pred = 1) AS as_short, max(n) FILTER (WHERE pred = 2) AS as_none
  FROM missed GROUP BY actual""",
            "overall": """SELECT sum(actual_n)::BIGINT AS all_cases, sum(hit)::BIGINT AS all_correct
  FROM per_class""",
        }, f"""SELECT actual, actual_n AS total, hit AS correct, {pct('hit', 'actual_n')} AS correct_pct,
  as_long, as_short, as_none, {pct('as_long', 'actual_n')} AS as_long_pct,
  {pct('as_short', 'actual_n')} AS as_short_pct, {pct('as_none', 'actual_n')} AS as_none_pct,
  all_cases, all_correct, all_cases - all_correct AS all_missed,
  {pct('all_correct', 'all_cases', '')} AS overall_accuracy
FROM wide JOIN per_class ON actual = k, overall"""),
    "prf1": with_(
        CELLS | {"pr": f"""SELECT k, {pct('hit', 'pred_n', '')} AS p,
  {pct('hit', 'actual_n', '')} AS r FROM per_class"""},
        """SELECT k AS class, p AS precision, r AS recall,
  CASE WHEN p + r > 0 THEN 2 * (p * r) / (p + r) ELSE 0 END AS f1 FROM pr"""),
    "trading_perf": with_(PERFORMANCE, f"""SELECT side, trades,
  {rnd('total_profit', 'total_profit', 5)}, {rnd('avg_profit', 'avg_profit', 5)},
  {rnd('total_reward', 'total_reward', 5)}, {rnd('avg_reward', 'avg_reward', 5)},
  profitable, rate AS profitable_rate, {pct('trades', 'bars')} AS pct_of_bars,
  {pct('taken', 'bars')} AS action_pct, {pct('none_n', 'bars')} AS none_pct,
  {rnd('all_profit', 'all_profit', 5)}, {pct('hits', 'bars', '')} AS accuracy FROM perf"""),
    "eval_summary": with_(PERFORMANCE, f"""SELECT 'Model' AS model_name,
  {pct('l.hits', 'l.bars', '')} AS overall_accuracy, {rnd('l.all_profit', 'total_profit', 5)},
  l.trades AS long_trades, s.trades AS short_trades,
  {rnd('l.avg_profit', 'avg_long_profit', 5)}, {rnd('s.avg_profit', 'avg_short_profit', 5)},
  l.rate AS profitable_long_rate, s.rate AS profitable_short_rate
FROM perf l JOIN perf s ON l.side = 'LONG' AND s.side = 'SHORT'"""),
    "signal_ohlc": with_(SIM, f"""SELECT bar_id, {clock('Date', 'Datetime')}, "Open", "High",
  "Low", "Close" FROM sim WHERE is_valid"""),
    "trade_list": with_(TRADES, "SELECT * FROM trades"),
    "export_roundtrip": with_(TRADES, "SELECT * FROM trades"),
    "stream_exits": with_(TRADES, "SELECT *, false AS late FROM trades"),
    "trade_dist": with_(
        TRADES, 'SELECT "Trade_Signal", count(*) AS trades FROM trades GROUP BY 1'),
    "export_totals": with_(TRADES, """SELECT 'ohlc' AS export, count(*) AS records FROM sim
WHERE is_valid UNION ALL SELECT 'trades', count(*) FROM trades"""),
    "exit_scores": with_(
        SNAPSHOTS | REQUESTS | CLASS_MAP | {"firsts": """SELECT tt, td, bs,
  min_by("RSI", seq) AS rsi, min_by(probs, seq) AS probs FROM snapshots GROUP BY tt, td, bs"""},
        f"""SELECT r.request_id, f.rsi AS "RSI", {color(-1)} AS red, {color(0)} AS yellow,
  {color(1)} AS green, CASE WHEN f.rsi IS NULL THEN 'no snapshot' END AS error
FROM requests r LEFT JOIN firsts f ON r.tt = f.tt AND r.td = f.td AND r.bs = f.bs"""),
    "parse_requests": with_(REQUESTS | {
        "lines": """SELECT request_id, CASE WHEN request_id % 20 = 0
  THEN concat_ws(' ', 'a.json', 'c.json', tt, td)
  ELSE concat_ws(' ', 'a.json', 'c.json', tt, td, bs, 'models/es') END AS line FROM requests""",
        "parts": "SELECT request_id, string_split(line, ' ') AS p FROM lines",
    }, """SELECT request_id, p[1] AS json_path, p[2] AS columns_path, p[3] AS "TradeType",
  p[4] AS "TradeDesignation", coalesce(TRY_CAST(p[5] AS INT), -1) AS "BarsSinceTradeEntry", p[6] AS model_dir,
  CASE WHEN len(p) < 6 THEN 'too few fields' WHEN TRY_CAST(p[5] AS INT) IS NULL
    THEN 'bars since entry is not a number' END AS error FROM parts"""),
    "stream_entry": with_(
        BARS | score_step("bars") | fitted_step("bars"),
        f"""SELECT bar_id, {IN_WINDOW} AS "InWindow",
  {', '.join(rnd(scaled(c), c, 4) for c in CONTINUOUS)}, {indicator_sql(CATEGORICAL)},
  predicted AS action, greatest(p_long, p_short, p_none) AS confidence
FROM decided, fitted WHERE {ON_MARK}"""),
    "stream_lag": with_(
        WINDOW_BARS | lag_step(), f"SELECT bar_id, {LAGS}, false AS late FROM lagged"),
    "csv_roundtrip": with_(WINDOW_BARS | feature_step(), f"""SELECT {clock('Date')},
  {csv(feature_table_columns()[1:])} FROM features"""),
    "raw_roundtrip": with_(BARS, f"""SELECT bar_id, symbol, {clock('Date')}, {csv(INPUT_FEATURES)}
FROM bars"""),
    "feature_vector": with_(
        WINDOW_BARS | feature_step(), f"""SELECT bar_id, 76 AS width,
  {rnd(' + '.join(q(c) for c in feature_table_columns()[1:77]), 'total')} FROM features"""),
    "train_forest_check": model_sql(),
    "train_boost_check": model_sql(),
    "train_weighted_check": model_sql(),
    "model_roundtrip_check": model_sql(", true AS same_as_fitted"),
    "routed_scores_check": with_(SNAPSHOTS | REQUESTS, """SELECT request_id, tt AS "TradeType",
  td AS "TradeDesignation", bs AS "BarsSinceTradeEntry", CASE WHEN NOT EXISTS (
    SELECT 1 FROM snapshots s WHERE s.tt = r.tt AND s.td = r.td AND s.bs = r.bs) THEN 'no snapshot'
  WHEN td = 'PV3' THEN 'no model' END AS error, true AS consistent FROM requests r"""),
}
