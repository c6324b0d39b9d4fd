"""Bars, features, labels and live analytics as registered queries, each with DuckDB SQL that folds
the same recurrences by recursion."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bars as B
from ..operators import features as X
from ..operators import kernels as K
from ..operators import relational as R
from ..operators.scan import ordered_scan
from ..sources import adapters as A
from . import queries as Q
from . import serving
from .queries import _DEC, _DIB, _FUNDING, _QUOTES, _TRADES
from .registry import SQL, query

_TARGET, _SPAN = 60.0, 20
_EARLY = "time < (SELECT date_trunc('day', min(time)) + INTERVAL 5 DAY FROM k0)"
_TICKS = f"""{_TRADES}, k0 AS (SELECT sym, time, tradeId, price, qty, price * qty AS dvol, CASE WHEN buyerIsMaker THEN -1 ELSE 1 END AS bt FROM t WHERE price * qty >= 50),
k1 AS (SELECT *, bt * dvol AS sd, CAST(time AS DATE) AS day, {_EARLY} AS warm FROM k0),
k AS (SELECT *, row_number() OVER (PARTITION BY sym, warm ORDER BY tradeId) AS i FROM k1)"""
_HIT = "CASE WHEN hit THEN {} ELSE {} END"
_STEP = {"dib": "r.theta + k.sd", "rwdib": "r.theta + k.sd", "drb": "CASE WHEN (k.sd > 0) = (r.theta > 0) THEN r.theta + k.sd ELSE k.sd END"}


def _scan(name: str, kind: str, th: str) -> str:
    """The fixed-threshold scan of the warm-up ticks; row 0 of a symbol is the start."""
    hit = lambda a, b: _HIT.format(a, b)
    return f"""{name} AS (SELECT sym, 0::BIGINT AS i, 0.0::DOUBLE AS theta, 0::BIGINT AS bn, 0::BIGINT AS tib, 0::BIGINT AS bib, 0.0::DOUBLE AS dib FROM {th}
 UNION ALL SELECT sym, i, {hit("0.0::DOUBLE", "x")}, bn + {hit(1, 0)}, {hit(0, "tib")}, {hit(0, "bib")}, {hit("0.0::DOUBLE", "dib")} FROM (SELECT *, abs(x) >= th AS hit FROM (
  SELECT k.sym, k.i, r.bn, r.tib + 1 AS tib, r.bib + CASE WHEN k.bt > 0 THEN 1 ELSE 0 END AS bib, r.dib + k.dvol AS dib, {_STEP[kind]} AS x, h.th FROM {name} r JOIN k ON k.warm AND k.sym = r.sym AND k.i = r.i + 1 JOIN {th} h ON h.sym = r.sym)))"""


def _grouped(source: str, by: str, theta: str, more: str) -> str:
    return f"""SELECT {by}, min(time) AS barstart, max(time) AS barend, arg_min(price, tradeId) AS open, max(price) AS high, min(price) AS low, arg_max(price, tradeId) AS close, sum(qty) AS qty, sum(dvol::{_DEC})::DOUBLE AS dqty, count(*) AS ticks,
 count(*) FILTER (WHERE bt > 0) AS buys, coalesce(sum(qty) FILTER (WHERE bt > 0), 0) AS bqty, coalesce(sum(qty) FILTER (WHERE bt < 0), 0) AS sqty, sum(dvol::{_DEC})::DOUBLE / sum(qty) AS vwap, {theta} AS theta{more} FROM {source} GROUP BY {by}"""


def _warm(kind: str) -> str:
    """The views wb (warm-up bars) and st (the state after them)."""
    th = {"dib": "et * ed * abs(2 * pb - 1)", "drb": "et * ed * greatest(pb, 1 - pb)", "rwdib": "sigma * sqrt(et)"}[kind]
    out = f"""{_TICKS}, c AS (SELECT sym, count(*) AS n, count(*) / {_TARGET}::DOUBLE AS et, (count(*) FILTER (WHERE bt > 0))::DOUBLE / count(*) AS pb, sum(dvol::{_DEC})::DOUBLE / count(*) AS ed,
 sqrt(greatest(sum(sd::DECIMAL(18,4) * sd::DECIMAL(18,4))::DOUBLE / count(*) - pow(sum(sd::{_DEC})::DOUBLE / count(*), 2.0), 0.0)) AS sigma, sum(price::{_DEC})::DOUBLE / count(*) AS anchorprice FROM k WHERE warm GROUP BY sym),
h0 AS (SELECT *, {th} AS th FROM c)"""
    if kind == "rwdib":
        out += f""", {_scan("g0", kind, "h0")}, h AS (SELECT h0.* EXCLUDE (th), h0.th * sqrt(greatest(made, 1) / {_TARGET}::DOUBLE) AS th FROM h0 JOIN (SELECT sym, max(bn) AS made FROM g0 GROUP BY sym) m ON m.sym = h0.sym)"""
    else:
        out += ", h AS (SELECT * FROM h0)"
    last = "(SELECT * FROM g QUALIFY i = max(i) OVER (PARTITION BY sym))"
    if kind == "rwdib":
        state = f"SELECT h.sym, h.n / greatest(o.bn, 1) AS et, 0.0::DOUBLE AS pb, 0.0::DOUBLE AS ed, h.th, h.th AS anchor, h.anchorprice, o.bn, o.theta, o.tib, 0::BIGINT AS bib, o.dib FROM h JOIN {last} o ON o.sym = h.sym"
    else:
        state = f"SELECT h.sym, h.et, h.pb, h.ed, h.th, h.th AS anchor, h.anchorprice, o.bn, o.theta, o.tib, o.bib, o.dib FROM h JOIN {last} o ON o.sym = h.sym"
    bars = _grouped("w", "sym, bn", f"sum(sd::{_DEC})::DOUBLE", ", max(th) AS th")
    return f"""{out}, {_scan("g", kind, "h")}, st AS ({state}),
w AS (SELECT k.*, g.bn, h.th FROM k JOIN g ON k.warm AND k.sym = g.sym AND k.i = g.i JOIN h ON h.sym = k.sym), w1 AS ({bars}),
wb AS (SELECT w1.*, st.et, st.pb, st.ed, true AS warmup FROM w1 JOIN st ON st.sym = w1.sym WHERE w1.bn < st.bn)"""


def _adaptive(kind: str) -> str:
    """_warm and the view ab of the adaptive bars of the days after the warm-up."""
    alpha = f"(2.0::DOUBLE / {_SPAN + 1})"
    mean = lambda old, new: f"({alpha} * ({new}) + (1 - {alpha}) * {old})"
    hit = lambda a, b: _HIT.format(a, b)
    anchor = "st.anchor * (d.mean / st.anchorprice)" if kind == "rwdib" else "st.anchor"
    term = {"dib": "et2 * ed2 * abs(2 * pb2 - 1)", "drb": "et2 * ed2 * greatest(pb2, 1 - pb2)", "rwdib": "(th * sqrt(et2 / et)) + 0.02::DOUBLE * (anchor - (th * sqrt(et2 / et)))"}[kind]
    pb, ed = (mean("r.pb", "(r.bib + CASE WHEN k.bt > 0 THEN 1 ELSE 0 END)::DOUBLE / (r.tib + 1)"), mean("r.ed", "(r.dib + k.dvol) / (r.tib + 1)")) if kind != "rwdib" else ("r.pb", "r.ed")
    bars = _grouped("z", "sym, bn, day", "arg_max(theta, tradeId)", ", arg_max(th, tradeId) AS th")
    ends = "arg_max(pb, tradeId) AS pb, arg_max(ed, tradeId) AS ed" if kind != "rwdib" else "0.0::DOUBLE AS pb, 0.0::DOUBLE AS ed"
    return f"""{_warm(kind)}, d AS (SELECT sym, day, sum(price::{_DEC})::DOUBLE / count(*) AS mean FROM k WHERE NOT warm GROUP BY sym, day),
y AS (SELECT sym, 0::BIGINT AS i, theta, bn, et, pb, ed, th, tib, bib, dib, 0::BIGINT AS bnOut, 0.0::DOUBLE AS thOut, 0.0::DOUBLE AS thetaOut FROM st
 UNION ALL SELECT sym, i, {hit("0.0::DOUBLE", "x")}, bn + {hit(1, 0)}, {hit("et2", "et")}, {hit("pb2", "pb")}, {hit("ed2", "ed")}, {hit(term, "th")}, {hit(0, "tib")}, {hit(0, "bib")}, {hit("0.0::DOUBLE", "dib")}, bn, th, x FROM (SELECT *, abs(x) >= th AS hit FROM (
  SELECT k.sym, k.i, r.bn, r.et, r.pb, r.ed, r.th, r.tib + 1 AS tib, r.bib + CASE WHEN k.bt > 0 THEN 1 ELSE 0 END AS bib, r.dib + k.dvol AS dib, {_STEP[kind]} AS x, {anchor} AS anchor, {mean("r.et", "r.tib + 1")} AS et2, {pb} AS pb2, {ed} AS ed2
  FROM y r JOIN k ON NOT k.warm AND k.sym = r.sym AND k.i = r.i + 1 JOIN st ON st.sym = r.sym JOIN d ON d.sym = k.sym AND d.day = k.day))),
z AS (SELECT k.*, y.bnOut AS bn, y.thOut AS th, y.thetaOut AS theta, y.et, y.pb, y.ed FROM k JOIN y ON NOT k.warm AND k.sym = y.sym AND k.i = y.i),
e AS (SELECT sym, day, arg_max(et, tradeId) AS et, {ends} FROM z GROUP BY sym, day), p AS ({bars}),
ab AS (SELECT p.* EXCLUDE (day), e.et, e.pb, e.ed, false AS warmup FROM p JOIN e ON e.sym = p.sym AND e.day = p.day WHERE abs(p.theta) >= p.th)"""


def _register(kind: str) -> None:
    def warm(spark, d):
        return B.warmup(Q.halves(B.ticks(A.trades(spark, d)))[0], kind, _TARGET)[0]

    def adaptive(spark, d):
        first, rest = Q.halves(B.ticks(A.trades(spark, d)))
        return B.adaptive(rest, B.warmup(first, kind, _TARGET)[1], kind)

    warm.__name__, adaptive.__name__ = f"warmup_{kind}", f"adaptive_{kind}"
    query(f"WITH RECURSIVE {_warm(kind)} SELECT * FROM wb")(warm)
    query(f"WITH RECURSIVE {_adaptive(kind)} SELECT * FROM ab")(adaptive)


for _kind in ("dib", "drb", "rwdib"):
    _register(_kind)

# warmup_bars takes all days as one warm-up.
for _name, _views, _view, _is in (("warmup_bars", _warm, "wb", "true"), ("adaptive_bars", _adaptive, "ab", _EARLY)):
    SQL[_name] = " UNION ALL BY NAME ".join(f"SELECT *, '{k}' AS kind FROM (WITH RECURSIVE {_views(k)} SELECT * FROM {_view})" for k in ("dib", "drb", "rwdib")).replace(_EARLY, _is)

SQL["bar_stats"] = f"WITH RECURSIVE {_adaptive('rwdib')} SELECT sym, warmup, count(*) AS n, sum(ticks::{_DEC})::DOUBLE / count(*) AS avgTicks, sum(th::{_DEC})::DOUBLE / count(*) AS avgTh, min(pb) AS minPb, max(pb) AS maxPb, arg_min(th, bn) AS th0, arg_max(th, bn) AS th1, max(th) AS thMax, max(th) > 10 * arg_min(th, bn) AS exploded FROM ab GROUP BY sym, warmup"


def _run(spark, d):
    first, rest = Q.halves(B.ticks(A.trades(spark, d)))
    bars, state = B.warmup(first, "rwdib", _TARGET)
    return bars.unionByName(B.adaptive(rest, state, "rwdib"))


@query(f"WITH RECURSIVE {_adaptive('rwdib')} SELECT sym, row_number() OVER (PARTITION BY sym ORDER BY bn) AS bn, barstart, barend, open, high, low, close, qty, dqty, ticks, buys, bqty, sqty, vwap, theta FROM ab")
def clean_bars(spark, d):
    """Warm-up and adaptive days, cleaned."""
    return B.clean(_run(spark, d))


@query(f"WITH RECURSIVE {_adaptive('rwdib')} SELECT sym, count(*) AS n, arg_min(th, bn) AS th0, arg_max(th, bn) AS th1, 100 * ((arg_max(th, bn) - arg_min(th, bn)) / arg_min(th, bn)) AS pct FROM (SELECT * FROM wb UNION ALL BY NAME SELECT * FROM ab) GROUP BY sym")
def threshold_evolution(spark, d):
    return B.evolution(_run(spark, d))


# The online bars as one recursion over a symbol's trades: the state is a row, `fire` says which bar closes.
_ONLINE = f"""{_TRADES}, s AS (SELECT *, row_number() OVER (PARTITION BY sym ORDER BY tradeId) AS i FROM t),
o AS (SELECT sym, 0::BIGINT AS i, NULL::DOUBLE AS last, 1 AS bt, 20000.0::DOUBLE AS th, 0::BIGINT AS bn, 0 AS pos, NULL::TIMESTAMP AS start, NULL::DOUBLE AS open, NULL::DOUBLE AS high, NULL::DOUBLE AS low, 0::BIGINT AS n, 0.0::DOUBLE AS theta, 0.0::DOUBLE AS run, 1 AS up, 0.0::DOUBLE AS vol, 0.0::DOUBLE AS usd, 0.0::DOUBLE AS bought,
  NULL::VARCHAR AS fire, 0::BIGINT AS bnOut, 0 AS posOut, NULL::TIMESTAMP AS startOut, 0.0::DOUBLE AS openOut, 0.0::DOUBLE AS highOut, 0.0::DOUBLE AS lowOut, 0::BIGINT AS nOut, 0.0::DOUBLE AS thetaOut, 0.0::DOUBLE AS runOut, 0.0::DOUBLE AS volOut, 0.0::DOUBLE AS usdOut, 0.0::DOUBLE AS pct, 0.0::DOUBLE AS thOut FROM (SELECT DISTINCT sym FROM t)
 UNION ALL SELECT sym, i, price, bt, CASE WHEN fire = 'dib' THEN 0.02::DOUBLE * (usd * (abs(theta) / usd)) + 0.98::DOUBLE * th ELSE th END, bn + CASE WHEN fire IS NULL THEN 0 ELSE 1 END, pos2,
  CASE WHEN fire IS NULL THEN start ELSE time END, CASE WHEN fire IS NULL THEN open ELSE price END, CASE WHEN fire IS NULL THEN high ELSE price END, CASE WHEN fire IS NULL THEN low ELSE price END, CASE WHEN fire IS NULL THEN n ELSE 0 END,
  CASE WHEN fire IS NULL THEN theta ELSE 0 END, CASE WHEN fire IS NULL THEN run ELSE 0 END, CASE WHEN fire IS NULL THEN bt ELSE 1 END, CASE WHEN fire IS NULL THEN vol ELSE 0 END, CASE WHEN fire IS NULL THEN usd ELSE 0 END, CASE WHEN fire IS NULL THEN bought ELSE 0 END,
  fire, bn, pos2, start, open, high, low, n, theta, run, vol, usd, pct, lim
 FROM (SELECT *, CASE WHEN fire = 'dib' AND pct > 65 THEN 1 WHEN fire = 'dib' AND pct < 35 THEN -1 ELSE pos END AS pos2 FROM (SELECT *, CASE WHEN usd > 0 THEN 100 * bought / usd ELSE 50.0 END AS pct, CASE WHEN abs(theta) >= lim THEN 'dib' WHEN run >= lim THEN 'drb' END AS fire FROM (
  SELECT sym, i, time, price, bt, th, bn, pos, coalesce(start, time) AS start, coalesce(open, price) AS open, greatest(coalesce(high, price), price) AS high, least(coalesce(low, price), price) AS low, n + 1 AS n, theta + bt * d AS theta, CASE WHEN bt = up THEN run ELSE 0 END + d AS run, vol + qty AS vol, usd + d AS usd, bought + CASE WHEN bt > 0 THEN d ELSE 0 END AS bought, greatest(th, 1000.0) AS lim
  FROM (SELECT o.* EXCLUDE (i, bt, last), s.i, s.time, s.price, s.qty, s.price * s.qty AS d, CASE WHEN o.last IS NULL OR s.price = o.last THEN o.bt WHEN s.price > o.last THEN 1 ELSE -1 END AS bt FROM o JOIN s ON s.sym = o.sym AND s.i = o.i + 1))))),
ol AS (SELECT o.sym, fire AS kind, bnOut AS bn, startOut AS barstart, s.time AS barend, openOut AS open, highOut AS high, lowOut AS low, s.price AS close, nOut AS ticks, volOut AS volume, usdOut AS dollars, pct AS buyPct, thetaOut AS theta, runOut AS maxRun, o.bt AS direction, thOut AS threshold, posOut AS position FROM o JOIN s ON s.sym = o.sym AND s.i = o.i WHERE fire IS NOT NULL)"""
_FLIPS = "fl AS (SELECT barend AS time, sym, bn, position, close AS price, buyPct, dollars, ticks FROM (SELECT *, coalesce(lag(position) OVER (PARTITION BY sym ORDER BY bn), 0) AS before FROM ol) WHERE position <> before)"
SQL["online_bars"] = f"WITH RECURSIVE {_ONLINE} SELECT * FROM ol"
SQL["position_flips"] = f"WITH RECURSIVE {_ONLINE}, {_FLIPS} SELECT * FROM fl"
SQL["position_stats"] = f"WITH RECURSIVE {_ONLINE}, {_FLIPS} SELECT sym, count(*) AS changes, count(*) FILTER (WHERE position = 1) AS longs, count(*) FILTER (WHERE position = -1) AS shorts, arg_max(position, bn) AS lastPosition, arg_max(price, bn) AS lastPrice, arg_max(time, bn) AS lastTime FROM fl GROUP BY sym"


@query(f"WITH RECURSIVE {_ONLINE} SELECT sym, count(*) AS bars, sum(ticks::{_DEC})::DOUBLE / count(*) AS avgTicks, sum(dollars::{_DEC})::DOUBLE / count(*) AS avgDollarVol, sum(epoch_us(barend) - epoch_us(barstart))::DOUBLE / count(*) / 1000000.0::DOUBLE AS avgDurationSec, sum(buyPct::{_DEC})::DOUBLE / count(*) AS avgBuyPct FROM ol WHERE kind = 'dib' GROUP BY sym")
def online_dib_stats(spark, d):
    return R.online_bar_stats(Q.online_bars(spark, d), "dib")


@query(f"WITH RECURSIVE {_ONLINE} SELECT sym, count(*) AS bars, sum(ticks::{_DEC})::DOUBLE / count(*) AS avgTicks, sum(dollars::{_DEC})::DOUBLE / count(*) AS avgDollarVol, count(*) FILTER (WHERE direction = 1) AS buyRuns, count(*) FILTER (WHERE direction = -1) AS sellRuns FROM ol WHERE kind = 'drb' GROUP BY sym")
def online_drb_stats(spark, d):
    return R.online_bar_stats(Q.online_bars(spark, d), "drb")


_RSI = f"""{_DIB}, x AS (SELECT *, row_number() OVER v AS i, close - lag(close) OVER v AS diff FROM bars WINDOW v AS (PARTITION BY sym ORDER BY bn)),
u AS (SELECT sym, i, bn, coalesce(greatest(diff, 0), 0) AS gain, coalesce(greatest(-diff, 0), 0) AS loss FROM x),
rs AS (SELECT sym, i, bn, gain AS gs, loss AS ls, NULL::DOUBLE AS g, NULL::DOUBLE AS l FROM u WHERE i = 1
 UNION ALL SELECT u.sym, u.i, u.bn, rs.gs + u.gain, rs.ls + u.loss, CASE WHEN u.i < 15 THEN NULL WHEN u.i = 15 THEN (rs.gs + u.gain) / 15 ELSE (u.gain + rs.g * 13) / 14 END, CASE WHEN u.i < 15 THEN NULL WHEN u.i = 15 THEN (rs.ls + u.loss) / 14 ELSE (u.loss + rs.l * 13) / 14 END FROM rs JOIN u ON u.sym = rs.sym AND u.i = rs.i + 1),
ri AS (SELECT sym, bn, CASE WHEN l = 0 THEN NULL ELSE 100 * (g / l) / (1 + g / l) END AS rsi FROM rs)"""
SQL["rsi_bars"] = f"WITH RECURSIVE {_RSI} SELECT ri.sym, ri.bn, bars.close, ri.rsi FROM ri JOIN bars ON bars.sym = ri.sym AND bars.bn = ri.bn"

_LABELS = f"""{_DIB}, x AS (SELECT *, row_number() OVER v AS i, abs(ln(close / lag(close) OVER v)) AS r FROM bars WINDOW v AS (PARTITION BY sym ORDER BY bn)),
sg AS (SELECT sym, i, bn, high, low, close, NULL::DOUBLE AS sigma FROM x WHERE i = 1
 UNION ALL SELECT x.sym, x.i, x.bn, x.high, x.low, x.close, CASE WHEN sg.sigma IS NULL THEN x.r ELSE (2.0::DOUBLE / 101) * x.r + (1 - 2.0::DOUBLE / 101) * sg.sigma END FROM sg JOIN x ON x.sym = sg.sym AND x.i = sg.i + 1),
br AS (SELECT *, close * (1 + 2.0::DOUBLE * sigma) AS upperPx, close * (1 - 1.0::DOUBLE * sigma) AS lowerPx FROM sg),
ah AS (SELECT b.sym, b.i, f.i AS j, f.bn AS fbn, f.close AS fclose, f.high >= b.upperPx AS up, f.low <= b.lowerPx AS dn FROM br b JOIN br f ON f.sym = b.sym AND f.i > b.i AND f.i <= b.i + 10),
ht AS (SELECT sym, i, count(*) AS n, arg_max(fbn, j) AS endBn, arg_max(fclose, j) AS endClose, min(j) FILTER (WHERE up OR dn) AS hit FROM ah GROUP BY sym, i),
lb AS (SELECT br.*, ht.endBn AS lastBn, ht.endClose, ah.fbn AS hitBn, (br.sigma IS NULL) AS none, ht.n IS NULL AS nofuture, ah.up, ah.dn FROM br LEFT JOIN ht ON ht.sym = br.sym AND ht.i = br.i LEFT JOIN ah ON ah.sym = br.sym AND ah.i = br.i AND ah.j = ht.hit),
lr AS (SELECT *, CASE WHEN none THEN 'noSigma' WHEN nofuture THEN 'noFuture' WHEN hitBn IS NULL THEN 'vertical' WHEN up AND dn THEN 'sameBar' WHEN up THEN 'upper' ELSE 'lower' END AS reason, (endClose - close) / close AS drift FROM lb),
labels_ AS (SELECT sym, bn, close, sigma, CASE WHEN reason IN ('noSigma', 'noFuture') THEN NULL ELSE coalesce(hitBn, lastBn) END AS endBn, upperPx, lowerPx,
 (CASE reason WHEN 'upper' THEN 1 WHEN 'lower' THEN -1 WHEN 'sameBar' THEN 0 WHEN 'vertical' THEN sign(drift) END)::BIGINT AS label, CASE reason WHEN 'upper' THEN 2.0::DOUBLE * sigma WHEN 'lower' THEN -1.0::DOUBLE * sigma WHEN 'sameBar' THEN 0.0 WHEN 'vertical' THEN drift END AS retAtTouch, reason FROM lr)"""
_KEPT = "WHERE reason NOT IN ('noSigma', 'noFuture')"
_PLACES = 9
#: Logarithms differ in their last bits between engines, so what stems from them is rounded.
SQL["triple_barrier"] = f"WITH RECURSIVE {_LABELS} SELECT sym, bn, close, endBn, label, reason, " + ", ".join(f"round({c}, {_PLACES}) AS {c}" for c in ("sigma", "upperPx", "lowerPx", "retAtTouch")) + " FROM labels_"
SQL["label_distribution"] = f"WITH RECURSIVE {_LABELS} SELECT sym, label, count(*) AS n, sum(endBn - bn)::DOUBLE / count(*) AS avgHorizon FROM labels_ {_KEPT} GROUP BY sym, label"
SQL["label_summary"] = f"WITH RECURSIVE {_LABELS} SELECT sym, count(*) AS n, 100.0::DOUBLE * count(*) FILTER (WHERE label = 1) / count(*) AS upPct, 100.0::DOUBLE * count(*) FILTER (WHERE label = -1) / count(*) AS dnPct, 100.0::DOUBLE * count(*) FILTER (WHERE reason = 'sameBar') / count(*) AS sameBarPct, 100.0::DOUBLE * count(*) FILTER (WHERE reason = 'vertical') / count(*) AS verticalPct FROM labels_ {_KEPT} GROUP BY sym"


@query(f"WITH RECURSIVE {_LABELS} SELECT sym, reason, count(*) AS n FROM labels_ GROUP BY sym, reason")
def label_reasons(spark, d):
    return X.label_reasons(Q.labelled(spark, d))


#: The labels of adaptive bars: the same views over the bars of the adaptive days.
_OF_ADAPTIVE = f"{_adaptive('rwdib')}, bars AS (SELECT * FROM ab){_LABELS.removeprefix(_DIB)}"


def labelled_adaptive(spark, d):
    first, rest = Q.halves(B.ticks(A.trades(spark, d)))
    bars = B.adaptive(rest, B.warmup(first, "rwdib", _TARGET)[1], "rwdib").select("sym", "bn", "high", "low", "close")
    return X.triple_barrier(ordered_scan(bars, ["sym"], ["bn"], K.label_sigma(), "sym string, bn long, high double, low double, close double, sigma double"), horizon=10)


@query(f"WITH RECURSIVE {_OF_ADAPTIVE} SELECT sym, bn, close, endBn, label, reason, " + ", ".join(f"round({c}, {_PLACES}) AS {c}" for c in ("sigma", "upperPx", "lowerPx", "retAtTouch")) + " FROM labels_")
def adaptive_labels(spark, d):
    return Q._rounded(labelled_adaptive(spark, d), "sigma", "upperPx", "lowerPx", "retAtTouch")


@query(f"WITH RECURSIVE {_OF_ADAPTIVE} SELECT sym, label, count(*) AS n, sum(endBn - bn)::DOUBLE / count(*) AS avgHorizon FROM labels_ {_KEPT} GROUP BY sym, label")
def adaptive_label_distribution(spark, d):
    return X.label_distribution(labelled_adaptive(spark, d))


SQL["features_windowed"] = f"""WITH RECURSIVE {_DIB}, x AS (SELECT *, ln(close / lag(close) OVER v) AS r FROM bars WINDOW v AS (PARTITION BY sym ORDER BY bn))
SELECT sym, bn, barstart, close, round(last_value(r IGNORE NULLS) OVER (v ROWS UNBOUNDED PRECEDING), {_PLACES}) AS logReturn, round((close - avg(close) OVER n) / avg(close) OVER n, {_PLACES}) AS meanReversion, round(sqrt(avg(r * r) OVER n), {_PLACES}) AS realizedVol,
 round(sqrt(avg(pow(ln(high / low), 2)) OVER n / (4 * ln(2))), {_PLACES}) AS parkinson, round(avg(abs(bqty - sqty)) OVER n / avg(bqty + sqty) OVER n, {_PLACES}) AS vpin FROM x WINDOW v AS (PARTITION BY sym ORDER BY bn), n AS (PARTITION BY sym ORDER BY bn ROWS 9 PRECEDING)"""

_MACD = """m AS (SELECT sym, bn, i, close AS f, close AS w, 0.0::DOUBLE AS g FROM x WHERE i = 1 UNION ALL
  SELECT sym, bn, i, f, w, (2.0::DOUBLE / 10) * (f - w) + (1 - 2.0::DOUBLE / 10) * g FROM (SELECT x.sym, x.bn, x.i, (2.0::DOUBLE / 13) * x.close + (1 - 2.0::DOUBLE / 13) * m.f AS f, (2.0::DOUBLE / 27) * x.close + (1 - 2.0::DOUBLE / 27) * m.w AS w, m.g FROM m JOIN x ON x.sym = m.sym AND x.i = m.i + 1))"""


@query(f"WITH RECURSIVE {_RSI}, {_MACD} SELECT b.sym, b.bn, b.barstart, b.close, ri.rsi, m.f - m.w AS macd, m.g AS macdSignal, (m.f - m.w) - m.g AS macdHist, b.bqty / (b.bqty + b.sqty) AS buyPct FROM bars b JOIN ri ON ri.sym = b.sym AND ri.bn = b.bn JOIN m ON m.sym = b.sym AND m.bn = b.bn")
def features_recursive(spark, d):
    return X.build(Q.fixed_dib(spark, d), ["rsi", "macd", "macdSignal", "macdHist", "buyPct"])


_LEVELS = ", ".join(f"(1 + (event_id * {a} + {i} * {b}) % 97)::DOUBLE AS {s}Qty{i}" for s, a, b in (("bid", 7, 13), ("ask", 11, 17)) for i in range(1, 6))
_OBI = f"""l AS (SELECT event_type AS sym, event_id AS fhSeqNo, {_LEVELS} FROM events),
w AS (SELECT sym, fhSeqNo, ({" + ".join(f"bidQty{i}" for i in range(1, 6))} - ({" + ".join(f"askQty{i}" for i in range(1, 6))})) / ({" + ".join(f"bidQty{i}" for i in range(1, 6))} + ({" + ".join(f"askQty{i}" for i in range(1, 6))})) AS raw, row_number() OVER (PARTITION BY sym ORDER BY fhSeqNo) AS i FROM l),
e AS (SELECT sym, fhSeqNo, i, raw, raw AS smooth FROM w WHERE i = 1 UNION ALL SELECT w.sym, w.fhSeqNo, w.i, w.raw, 0.05::DOUBLE * w.raw + (1 - 0.05::DOUBLE) * e.smooth FROM e JOIN w ON w.sym = e.sym AND w.i = e.i + 1)"""
SQL["order_book_imbalance"] = f"WITH RECURSIVE {_OBI} SELECT sym, fhSeqNo, raw AS rawOBI, smooth AS smoothOBI FROM e"

_VOL = f"""{_TRADES}, s AS (SELECT *, epoch_us(time) AS us, row_number() OVER (PARTITION BY sym ORDER BY tradeId) AS i FROM t),
v AS (SELECT sym, i, us AS at, price AS p, false AS taken, NULL::DOUBLE AS r FROM s WHERE i = 1
 UNION ALL SELECT s.sym, s.i, CASE WHEN s.us - v.at < 3600000000 THEN v.at ELSE s.us END, CASE WHEN s.us - v.at < 3600000000 THEN v.p ELSE s.price END, s.us - v.at >= 3600000000, CASE WHEN s.us - v.at < 3600000000 THEN NULL ELSE ln(s.price / v.p) END FROM v JOIN s ON s.sym = v.sym AND s.i = v.i + 1),
vs AS (SELECT v.sym, s.time, count(*) OVER q AS samples, sqrt(31536000 / 3600.0::DOUBLE) * stddev_pop(r) OVER q AS vol FROM v JOIN s ON s.sym = v.sym AND s.i = v.i WHERE taken WINDOW q AS (PARTITION BY v.sym ORDER BY v.at RANGE BETWEEN 259199999999 PRECEDING AND CURRENT ROW)),
vh AS (SELECT sym, time, round(100 * vol, 6) AS annualizedVol, samples, samples >= 24 AS isValid FROM vs WHERE samples >= 10 AND vol > 0)"""
SQL["realized_volatility"] = f"WITH RECURSIVE {_VOL} SELECT * FROM vh"


@query(f"WITH RECURSIVE {_VOL} SELECT sym, time, annualizedVol, samples, isValid, CASE sym WHEN 'click' THEN 45.0 WHEN 'view' THEN 65.0 END::DOUBLE AS impliedVol, annualizedVol - CASE sym WHEN 'click' THEN 45.0 WHEN 'view' THEN 65.0 END::DOUBLE AS difference FROM vh QUALIFY time = max(time) OVER (PARTITION BY sym)")
def volatility_comparison(spark, d):
    return serving.volatility_comparison(Q.realized_volatility(spark, d), {"click": 45.0, "view": 65.0})


SQL["rsi_ranking"] = f"""WITH RECURSIVE {_TRADES}, en AS (SELECT sym, max(time) AS hi FROM t GROUP BY sym), bd AS (SELECT sym, k AS step, hi - INTERVAL 1 HOUR * (14 - k) AS at FROM en, range(15) r(k)),
cl AS (SELECT bd.sym, bd.step, t.price AS close, row_number() OVER (PARTITION BY bd.sym ORDER BY step) AS i FROM bd ASOF LEFT JOIN t ON t.sym = bd.sym AND bd.at >= t.time),
rs AS (SELECT sym, i, close, 0.0::DOUBLE AS g, 0.0::DOUBLE AS l FROM cl WHERE i = 1 UNION ALL SELECT cl.sym, cl.i, cl.close, rs.g + greatest(cl.close - rs.close, 0), rs.l + greatest(rs.close - cl.close, 0) FROM rs JOIN cl ON cl.sym = rs.sym AND cl.i = rs.i + 1),
sc AS (SELECT sym, close, CASE WHEN l = 0 THEN NULL ELSE 100 * ((g / 14) / (l / 14)) / (1 + (g / 14) / (l / 14)) END AS rsi FROM rs WHERE i = 15),
rk AS (SELECT *, row_number() OVER (ORDER BY rsi DESC, sym) AS r, count(*) OVER () AS n, bool_and(rsi IS NOT NULL AND close IS NOT NULL) OVER () AS whole FROM sc)
SELECT sym, rsi, close, CASE WHEN r = 1 THEN 1 WHEN r = n THEN -1 ELSE 0 END AS exposure, CASE WHEN r = 1 OR r = n THEN 100000.0::DOUBLE / close END AS qty FROM rk WHERE whole AND n >= 2"""


@query(f"WITH {_TRADES} SELECT * FROM t ORDER BY tradeId DESC LIMIT 50")
def last_n_global(spark, d):
    return R.last_n(A.trades(spark, d), 50, "tradeId", None)


@query(f"WITH {_TRADES} SELECT * FROM t WHERE time >= (SELECT max(time) FROM t) - INTERVAL 1440 MINUTE")
def retained_trades(spark, d):
    t = A.trades(spark, d)
    return R.retained(t, t.agg(F.max("time")).scalar(), 1440)


@query(f"WITH {_TRADES}, {_QUOTES}, u AS (SELECT 'trade' AS side, time, tradeId AS seq FROM t UNION ALL SELECT 'quote', time, fhSeqNo FROM q) SELECT *, row_number() OVER (ORDER BY time, seq, side) AS tpSeqNo FROM u")
def sequence_stamps(spark, d):
    return R.stamped(("time", "seq"), trade=A.trades(spark, d).withColumnRenamed("tradeId", "seq"), quote=A.quotes(spark, d).withColumnRenamed("fhSeqNo", "seq"))


_HEALTH = "hl AS (SELECT event_type AS handler, ts AS time, event_id AS msgsPublished, 1 + event_id % 977 AS uptimeSec, ts - INTERVAL 3 SECOND AS lastMsgTimeUtc FROM events)"


@query(f"WITH {_HEALTH}, z AS (SELECT * FROM hl QUALIFY row_number() OVER (PARTITION BY handler ORDER BY time DESC) = 1) SELECT handler, time, msgsPublished, uptimeSec, lastMsgTimeUtc, floor(msgsPublished / uptimeSec::DOUBLE + 0.5)::BIGINT AS avgRate, (floor(epoch((SELECT max(ts) FROM events))) - floor(epoch(lastMsgTimeUtc)))::BIGINT AS lastActivitySec FROM z")
def handler_status(spark, d):
    h = A.health(spark, d)
    return R.handler_status(h, h.agg(F.max("time")).scalar().cast("timestamp"))


@query(f"WITH {_TRADES}, {_FUNDING} SELECT sym, count(*) AS rows, min(fundingTime) AS first, max(fundingTime) AS last FROM fr GROUP BY sym")
def funding_status(spark, d):
    from ..sources.archives import funding_status

    return funding_status(A.funding(spark, d))


@query("WITH p AS (SELECT DISTINCT event_type AS sym FROM events) SELECT sym FROM p WHERE sym NOT IN ('click', 'view')")
def unsubscribed_symbols(spark, d):
    t = A.trades(spark, d)
    return R.unsubscribed(t.select("sym"), t.where("sym in ('click', 'view')").select("sym"))


@query(f"WITH {_QUOTES} SELECT sym, time, fhSeqNo, isValid, bidPrice1, askPrice1, askPrice1 - bidPrice1 AS spread, 0.5::DOUBLE * (bidPrice1 + askPrice1) AS mid FROM q QUALIFY row_number() OVER (PARTITION BY sym ORDER BY fhSeqNo DESC) = 1")
def latest_books(spark, d):
    return serving.order_book(A.quotes(spark, d)).select("sym", "time", "fhSeqNo", "isValid", "bidPrice1", "askPrice1", "spread", "mid")


@query(f"WITH RECURSIVE {_OBI} SELECT sym, fhSeqNo, raw AS rawOBI, smooth AS smoothOBI FROM e QUALIFY row_number() OVER (PARTITION BY sym ORDER BY fhSeqNo DESC) = 1")
def latest_imbalance(spark, d):
    return serving.latest(Q.order_book_imbalance(spark, d), "fhSeqNo")


@query(f"WITH {_TRADES}, l AS (SELECT CAST(CAST(time AS DATE) AS VARCHAR) AS day, sym, arg_max(price, tradeId) AS price FROM t GROUP BY 1, 2), o AS (SELECT sym, arg_min(price, tradeId) AS first FROM t GROUP BY sym), h AS (SELECT day, sum((price - first)::{_DEC})::DOUBLE AS pnl FROM l JOIN o ON o.sym = l.sym GROUP BY day) SELECT sum(pnl::{_DEC})::DOUBLE / count(*) AS avg, min(pnl) AS min, max(pnl) AS max, max(pnl) - min(pnl) AS range FROM h")
def pnl_stats(spark, d):
    """Statistics of the daily P&L of one unit of each symbol, bought at its first price."""
    return R.range_stats(serving.pnl_history(A.trades(spark, d), "1 day"), "pnl")


@query(f"WITH {_TRADES} SELECT * FROM t WHERE time >= (SELECT date_trunc('day', min(time)) FROM t) + INTERVAL 2 DAY AND time < (SELECT date_trunc('day', min(time)) FROM t) + INTERVAL 5 DAY")
def trades_on_days(spark, d):
    t = A.trades(spark, d)
    day = lambda n: t.agg(F.date_add(F.to_date(F.min("time")), n)).scalar()
    return R.on_days(t, day(2), day(4))


@query(f"""WITH RECURSIVE {_OBI}, o AS (SELECT e.*, epoch_us(v.ts) AS us FROM e JOIN events v ON v.event_id = e.fhSeqNo),
h AS (SELECT sym, fhSeqNo, i, raw, smooth, us AS last, true AS kept FROM o WHERE i = 1 UNION ALL
  SELECT o.sym, o.fhSeqNo, o.i, o.raw, o.smooth, CASE WHEN o.us - h.last >= 7200000000 THEN o.us ELSE h.last END, o.us - h.last >= 7200000000 FROM h JOIN o ON o.sym = h.sym AND o.i = h.i + 1)
SELECT sym, fhSeqNo, raw AS rawOBI, smooth AS smoothOBI FROM h WHERE kept""")
def imbalance_history(spark, d):
    """The imbalance at least two hours after the row before it."""
    times = A.quotes(spark, d).select("fhSeqNo", "time")
    rows = Q.order_book_imbalance(spark, d).join(times, "fhSeqNo").select("sym", "time", "fhSeqNo", "rawOBI", "smoothOBI")
    return ordered_scan(rows, ["sym"], ["fhSeqNo"], K.thinned(7200), "sym string, time timestamp_ntz, fhSeqNo long, rawOBI double, smoothOBI double").drop("time")


@query(f"WITH {_TRADES}, {_FUNDING} SELECT t.sym, count(*) AS n, max(price) AS high FROM t WHERE qty > 5 AND sym IN (SELECT sym FROM fr) GROUP BY t.sym HAVING count(*) > 1")
def adhoc_sql(spark, d):
    serving.register_views(spark, d)
    return spark.sql("select t.sym, count(*) as n, max(price) as high from trades t where qty > 5 and sym in (select sym from funding) group by t.sym having count(*) > 1")


@query(f"WITH RECURSIVE {_RSI} SELECT ri.sym, ri.bn, bars.close, ri.rsi FROM ri JOIN bars ON bars.sym = ri.sym AND bars.bn = ri.bn WHERE rsi IS NOT NULL")
def rsi_without_nulls(spark, d):
    return R.drop_null(Q.rsi_bars(spark, d), ["rsi"])
