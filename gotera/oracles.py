"""The registered queries once more as plain SQL over the same tables, written from the definitions in long form."""

from __future__ import annotations

# The trend windows (months before, months judged, drop in percent) and the lengths of constant runs.
TREND_DROPS = [(1, 4, 90), (1, 3, 90), (2, 3, 90), (1, 6, 90), (3, 3, 90), (6, 5, 10), (6, 6, 10), (6, 4, 10), (6, 1,
    10), (5, 5, 10)]
CONSTANT_RUNS = [8, 9, 10, 3, 4, 5]
TRACKED = ["categoria", "estado", "determinacion_consumo"]
STATIC = ["instalacion", "estado", "categoria", "subcategoria_estrato", "localidad", "municipio", "barrio",
    "microsector"]

N = 12
ONE = ["1999-01-01"]
VALID: list[str] = []  # all months with inspections that have a full history
MONTHS = [f"{k}_anterior" for k in range(N, 0, -1)]

ITEMS = """items AS (
  SELECT l.*, o.o_orderpriority, s.s_nationkey, s.s_acctbal, n.n_name, r.r_name,
         lpad(CAST(l_suppkey * 10 + l_linenumber AS VARCHAR), 9, '0') AS contrato,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
         l_orderkey * 33554432 + (l_partkey & 33554431) AS pos,
         CAST(year(l_shipdate) AS BIGINT) AS year, CAST(month(l_shipdate) AS BIGINT) AS month
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey JOIN supplier s ON l_suppkey = s_suppkey
  JOIN nation n ON s_nationkey = n_nationkey JOIN region r ON n_regionkey = r_regionkey)"""

CONSUMO = ITEMS + """, consumo AS (
  SELECT contrato, date, pos, year, month, year * 100 + month AS file_month,
         CASE WHEN floor(l_quantity / 10) >= 1 THEN floor(l_quantity / 10) - 1 END AS consumo,
         CASE WHEN l_tax <> 0.08 THEN l_returnflag END AS categoria, l_linestatus AS estado,
         CAST(l_linenumber AS VARCHAR) AS microsector, CAST(l_suppkey AS VARCHAR) AS instalacion,
         CAST(s_nationkey AS VARCHAR) AS subcategoria_estrato, n_name AS localidad, r_name AS municipio,
         o_orderpriority AS determinacion_consumo, CASE WHEN s_acctbal >= 0 THEN n_name END AS barrio
  FROM items)"""

RESULTS = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Fraude' WHEN '2-HIGH' THEN 'Anomalía'
  WHEN '3-MEDIUM' THEN 'Sin definición' WHEN '5-LOW' THEN 'Normal' END"""

LABELS = f"""inspected AS (
  SELECT contrato, date, CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS BIGINT) AS is_fraud,
         {RESULTS} AS clasificacion_resultado, CAST(l_orderkey AS VARCHAR) AS solicitud,
         CAST(l_suppkey AS VARCHAR) AS instalacion, l_returnflag AS resultado, l_linestatus AS causa_de_revision,
         pos, year, month
  FROM items WHERE l_discount = 0.1 AND o_orderpriority <> '3-MEDIUM'), labels AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY contrato, date ORDER BY is_fraud DESC, pos) AS place FROM inspected)
  WHERE place = 1)"""

RAW_INSPECTIONS = f"""raw_inspections AS (
  SELECT CASE WHEN l_discount = 0.09 THEN substr(contrato, 2, 8) ELSE contrato END AS contrato, pos, year, month,
         CAST(l_orderkey AS VARCHAR) AS solicitud, {RESULTS} AS clasificacion_resultado
  FROM items WHERE l_discount IN (0.1, 0.09, 0.08))"""


def dates(values: list[str]) -> str:
    return "[" + ", ".join(f"DATE '{v}'" for v in values) + "]"


def windows(cutoffs: list[str]) -> str:
    listed = f"""SELECT unnest({dates(cutoffs)}) AS cutoff""" if cutoffs else f"""SELECT DISTINCT date AS cutoff FROM labels
  WHERE date >= (SELECT min(date) FROM consumo) + INTERVAL {N} MONTH"""
    return f"""{LABELS}, cutoffs AS ({listed}), win AS (
  SELECT c.*, cutoff, date_diff('month', c.date, cutoff) AS k
  FROM consumo c JOIN cutoffs ON c.date < cutoff AND c.date >= cutoff - INTERVAL {N} MONTH)"""


CELLS = "cells AS (SELECT contrato, cutoff, k, avg(consumo) AS v FROM win GROUP BY ALL)"

SERIES = """ids AS (SELECT contrato, cutoff FROM cells GROUP BY ALL HAVING count(v) > 0), grid AS (
  SELECT i.contrato, i.cutoff, 12 - p.k AS i, c.v FROM ids i CROSS JOIN (SELECT unnest(range(1, 13)) AS k) p
  LEFT JOIN cells c ON c.contrato = i.contrato AND c.cutoff = i.cutoff AND c.k = p.k), ser AS (
  SELECT contrato, cutoff, i, v, coalesce(
    last_value(v IGNORE NULLS) OVER (PARTITION BY contrato, cutoff ORDER BY i
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(v IGNORE NULLS) OVER (PARTITION BY contrato, cutoff ORDER BY i
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS x FROM grid)"""


def r6(expression: str, name: str) -> str:
    return f'round(CAST({expression} AS DOUBLE) + 1e-9, 6) + 0.0 AS "{name}"'


def big(expression: str, name: str) -> str:
    return f'CAST({expression} AS BIGINT) AS "{name}"'


def month_values(source: str) -> list[str]:
    """Aggregates over a series relation (i, x or v) giving the monthly columns."""
    return [r6(f"max(CASE WHEN i = {i} THEN {source} END)", name) for i, name in enumerate(MONTHS)]


def panel(cutoffs: list[str]) -> str:
    return f"WITH {CONSUMO}, {windows(cutoffs)}, {CELLS}, {SERIES}"


POPULATION_SUMS = "sums AS (SELECT cutoff, categoria, contrato, " + ", ".join(
    f"CASE WHEN count(*) FILTER (k <= {m}) > 0 THEN coalesce(sum(consumo) FILTER (k <= {m}), 0) END AS sum_{m}"
    for m in (12, 6, 3)) + " FROM win WHERE categoria IS NOT NULL GROUP BY ALL)"

POPULATION = "pop AS (SELECT cutoff, categoria, " + ", ".join(
    f"avg(sum_{m}) AS consumo_{m}m_ts_mean, max(sum_{m}) AS consumo_{m}m_ts_max" for m in (12, 6, 3)
) + " FROM sums GROUP BY ALL)"

POPULATION_COLUMNS = [f"consumo_{m}m_ts_{s}" for m in (12, 6, 3) for s in ("mean", "max")]

LATEST = "latest AS (SELECT contrato, cutoff, " + ", ".join(STATIC) + """ FROM (
  SELECT *, row_number() OVER (PARTITION BY contrato, cutoff ORDER BY date DESC, file_month, pos) AS place FROM win)
  WHERE place = 1)"""

DISTINCT = "dist AS (SELECT contrato, cutoff, " + ", ".join(
    f"count(DISTINCT {a}) AS cant_{a}" for a in TRACKED) + " FROM win GROUP BY ALL)"


def _changes(a: str) -> str:
    return f"""moves_{a} AS (SELECT contrato, cutoff, sum(CASE WHEN {a} = before THEN 0 ELSE 1 END) - 1 AS cambios_{a} FROM (
  SELECT contrato, cutoff, {a}, lag({a}) OVER (PARTITION BY contrato, cutoff ORDER BY date, file_month, pos) AS before
  FROM win WHERE {a} IS NOT NULL) GROUP BY ALL)"""


CHANGES = ", ".join(_changes(a) for a in TRACKED)
JOIN_CHANGES = " ".join(f"LEFT JOIN moves_{a} USING (contrato, cutoff)" for a in TRACKED)
CHANGE_COLUMNS = [big(f"coalesce(cambios_{a}, -1)", f"cambios_{a}") for a in TRACKED]

RATIO_PARTS = "levels AS (SELECT contrato, cutoff, " + ", ".join(
    f"avg(v) FILTER (i >= {N - m}) AS level_{m}" for m in (3, 6, 12)) + ", count(*) FILTER (v IS NULL) AS cant_null " \
    "FROM ser GROUP BY ALL)"

RATIOS = [
    r6(f"level_{m} / (consumo_{m}m_ts_{s} + 1e-9)", f"prop_cons_ult{m}_{s}_g") for m in (3, 6, 12) for s in ("mean", "max")]

CALENDAR = [big("month(cutoff)", "num_mes"), big("quarter(cutoff)", "quarter_anio"),
            big("weekofyear(cutoff)", "semana_anio")]

NEGATIVES = """pairs AS (SELECT DISTINCT contrato, cutoff FROM win), unlabelled AS (
  SELECT contrato, cutoff FROM pairs p WHERE NOT EXISTS (
    SELECT 1 FROM labels l WHERE l.contrato = p.contrato AND l.date = p.cutoff)), negatives AS (
  SELECT contrato, cutoff FROM (SELECT *, row_number() OVER (
    PARTITION BY cutoff ORDER BY md5(contrato || '|' || CAST(cutoff AS VARCHAR) || '|42')) AS place FROM unlabelled)
  WHERE place <= 20)"""

LABEL_COLUMNS = [
    big("coalesce(l.is_fraud, 0)", "is_fraud"), "l.solicitud", "l.instalacion AS instalacion_orden", "l.resultado",
    "l.clasificacion_resultado", "l.causa_de_revision"]


def comma(*groups) -> str:
    return ", ".join(part for g in groups for part in ([g] if isinstance(g, str) else g))


def wide_sql(cutoffs: list[str], columns: list[str] | None = None, extra_ctes: str = "", source: str = "wide_ids",
             extra_joins: str = "", extra_columns: list[str] | None = None) -> str:
    chosen = columns or [
        "cutoff AS date_fizcalizacion",
        *[f'"{m}"' for m in MONTHS], *[f"CAST(cant_{a} AS BIGINT) AS cant_{a}" for a in TRACKED], *CHANGE_COLUMNS,
        *[f"latest.{c}" for c in STATIC], *[r6(c, c) for c in POPULATION_COLUMNS], big("cant_null", "cant_null"),
        *RATIOS, *CALENDAR]
    return f"""{panel(cutoffs)}, {POPULATION_SUMS}, {POPULATION}, {LATEST}, {DISTINCT}, {CHANGES}, {RATIO_PARTS}
  {extra_ctes}, filled AS (SELECT contrato, cutoff, {comma(month_values('x'))} FROM ser GROUP BY ALL),
  wide_ids AS (SELECT contrato, cutoff FROM ids)
SELECT contrato, {comma(chosen, extra_columns or [])} FROM {source} JOIN ids USING (contrato, cutoff)
  JOIN filled USING (contrato, cutoff) JOIN latest USING (contrato, cutoff) JOIN dist USING (contrato, cutoff)
  JOIN levels USING (contrato, cutoff) {JOIN_CHANGES} LEFT JOIN pop USING (cutoff, categoria) {extra_joins}"""


# --- series features in long form: one row per contract and month -----------------------------------------------------

SER = panel(VALID).replace("ser AS (", "gaps AS (") + """, ser AS (
  SELECT contrato || ' ' || CAST(cutoff AS VARCHAR) AS ventana, i, v, x FROM gaps)"""


def _trend(base: int, evaluated: int) -> str:
    return (f"100 * avg(x) FILTER (i >= {N - evaluated}) / "
            f"(avg(x) FILTER (i >= {N - evaluated - base} AND i < {N - evaluated}) + 1e-6)")


RUNS = """runs AS (SELECT ventana, m, x, count(*) AS len FROM (
  SELECT *, i - row_number() OVER (PARTITION BY ventana, m, x ORDER BY i) AS grp
  FROM ser CROSS JOIN (SELECT unnest([3, 6, 12]) AS m) WHERE i >= 12 - m) GROUP BY ventana, m, x, grp)"""


def moments_sql(columns: list[str]) -> str:
    def spread_cols(expression: str, name: str, least: int = 3) -> list[str]:
        return [f"max({expression}) FILTER (m = {m}) AS {name}{m}" for m in (3, 6, 12) if m >= least]

    skew = "CASE WHEN d2 < 1e-14 THEN 0 ELSE m * sqrt(m - 1) / (m - 2) * d3 / pow(d2, 1.5) END"
    kurt = ("CASE WHEN d2 < 1e-14 THEN 0 ELSE CASE WHEN m > 3 THEN m * (m + 1) * (m - 1) * d4 / "
            "((m - 2) * (m - 3) * d2 * d2) - 3.0 * (m - 1) * (m - 1) / ((m - 2) * (m - 3)) END END")
    parts = comma(
        spread_cols("mu", "mean_"), spread_cols("lo", "min_cons"), spread_cols("hi", "max_cons"),
        spread_cols("sqrt(d2 / (m - 1))", "std_cons"), spread_cols("d2 / (m - 1)", "var_cons"),
        spread_cols(skew, "skew_cons"), spread_cols(kurt, "kurt_cons", 6), spread_cols("slope", "slope_"))
    return f"""{SER}, parts AS (SELECT ventana, m, i, x, avg(x) OVER (PARTITION BY ventana, m) AS mu
    FROM ser CROSS JOIN (SELECT unnest([3, 6, 12]) AS m) WHERE i >= 12 - m), sums AS (
  SELECT ventana, m, any_value(mu) AS mu, min(x) AS lo, max(x) AS hi, sum((x - mu) ** 2) AS d2, sum((x - mu) ** 3) AS d3,
    sum((x - mu) ** 4) AS d4, regr_slope(x, i) AS slope FROM parts GROUP BY ALL), flat AS (
  SELECT ventana, {parts} FROM sums GROUP BY ventana)
SELECT ventana, {comma([r6(c, c) for c in columns])} FROM flat"""


MOMENTS = [f"{p}{m}" for m in (3, 6, 12) for p in (
    "mean_", "min_cons", "max_cons", "std_cons", "var_cons", "skew_cons", "kurt_cons") if (p, m) != ("kurt_cons", 3)]


def _quantile(q: float) -> str:
    return f"quantile_cont(x, {q})"


STATISTICAL = f"""{SER}, mid AS (SELECT ventana, avg(x) AS mu, median(x) AS med, min(x) AS lo, max(x) AS hi,
    {_quantile(0.2)} AS p0, {_quantile(0.8)} AS p1 FROM ser GROUP BY ALL), joined AS (
  SELECT * FROM ser JOIN mid USING (ventana)), binned AS (
  SELECT *, CASE WHEN hi = lo THEN 0 ELSE least(CAST(floor((x - lo) / (hi - lo) * 10) AS INTEGER), 9) END AS bin
  FROM joined), agg AS (
  SELECT ventana, max(x) AS hi, min(x) AS lo, avg(x) AS mu, median(x) AS med, sum((x - mu) ** 2) AS s2,
    sum((x - mu) ** 3) AS s3, sum((x - mu) ** 4) AS s4, sum(x * x) AS e, avg(abs(x - mu)) AS mad,
    median(abs(x - med)) AS medad, {_quantile(0.75)} - {_quantile(0.25)} AS iqr, any_value(p0) AS p0, any_value(p1) AS p1,
    count(*) FILTER (x <= p0) AS c0, count(*) FILTER (x <= p1) AS c1,
    {comma([f"count(*) FILTER (bin = {b}) AS h{b}" for b in range(10)])} FROM binned GROUP BY ventana)
SELECT ventana, {comma(
    r6("hi", "ts_max"), r6("lo", "ts_min"), r6("mu", "ts_mean"), r6("med", "ts_median"), r6("s2 / 12", "ts_variance"),
    r6("sqrt(s2 / 12)", "ts_std"), r6("sqrt(e / 12)", "ts_rms"), r6("mad", "ts_mean_abs_deviation"),
    r6("medad", "ts_median_abs_deviation"), r6("iqr", "ts_interquartile_range"),
    r6("CASE WHEN s2 >= 1e-14 THEN (s3 / 12) / pow(s2 / 12, 1.5) END", "ts_skewness"),
    r6("CASE WHEN s2 >= 1e-14 THEN (s4 / 12) / pow(s2 / 12, 2) - 3 END", "ts_kurtosis"),
    [big(f"h{b}", f"ts_histogram_{b}") for b in range(10)], [r6(f"{i + 1} / 12.0", f"ts_ecdf_{i}") for i in range(12)],
    r6("p0", "ts_ecdf_percentile_0"), r6("p1", "ts_ecdf_percentile_1"),
    big("c0", "ts_ecdf_percentile_count_0"), big("c1", "ts_ecdf_percentile_count_1"))} FROM agg"""

TEMPORAL = f"""{SER}, steps AS (
  SELECT ventana, i, x, lead(x) OVER w AS nxt, lead(x) OVER w - x AS d, lead(x, 2) OVER w - lead(x) OVER w AS d_next,
    lag(x) OVER w AS a1, lag(x, 2) OVER w AS a2, lead(x, 2) OVER w AS b2 FROM ser
  WINDOW w AS (PARTITION BY ventana ORDER BY i)), freq AS (
  SELECT ventana, -sum(c / 12.0 * log2(c / 12.0)) / nullif(log2(count(*)), 0) AS h FROM (
    SELECT ventana, x, count(*) AS c FROM ser GROUP BY ALL) GROUP BY ventana), agg AS (
  SELECT ventana, sum(x * x) AS e, sum((x + nxt) / 2) AS area, sum(i * x * x) AS ix2, avg(d) AS md, avg(abs(d)) AS mad,
    median(d) AS medd, median(abs(d)) AS medad, sum(abs(d)) AS sad, count(*) FILTER (d < 0 AND d_next > 0) AS pt,
    count(*) FILTER (d > 0 AND d_next < 0) AS nt, count(*) FILTER (x > a1 AND x > a2 AND x > nxt AND x > b2) AS peaks,
    max(x) - min(x) AS pp, sum(sqrt(1 + d * d)) AS dist, regr_slope(x, i) AS slope,
    count(*) FILTER (sign(x) <> sign(nxt)) AS zc FROM steps GROUP BY ventana)
SELECT ventana, {comma(
    r6("e", "ts_absolute_energy"), r6("e / 12", "ts_mean_power"), r6("area", "ts_area_under_curve"),
    r6("e", "ts_autocorrelation"), r6("ix2 / nullif(e, 0)", "ts_centroid"), r6("coalesce(h, 0)", "ts_entropy"),
    r6("md", "ts_mean_diff"), r6("mad", "ts_mean_abs_diff"), r6("medd", "ts_median_diff"),
    r6("medad", "ts_median_abs_diff"), r6("sad", "ts_sum_abs_diff"), big("pt", "ts_positive_turning"),
    big("nt", "ts_negative_turning"), big("peaks", "ts_neighbourhood_peaks"), r6("pp", "ts_pk_pk_distance"),
    r6("dist", "ts_signal_distance"), r6("slope", "ts_slope"), big("zc", "ts_zero_cross"))}
FROM agg JOIN freq USING (ventana)"""

SPECTRUM = f"""{SER}, raw_power AS (
  SELECT ventana, k, sum(x * cos(2 * pi() * k * i / 12)) ** 2 + sum(x * sin(2 * pi() * k * i / 12)) ** 2 AS p
  FROM ser CROSS JOIN (SELECT unnest(range(0, 7)) AS k) GROUP BY ALL), power AS (
  SELECT ventana, k, k / 12.0 AS f, CASE WHEN p < 1e-9 * max(p) OVER (PARTITION BY ventana) THEN 0 ELSE p END AS p
  FROM raw_power), bins AS (
  SELECT *, sqrt(p) AS a, sum(p) OVER c AS pc, sum(sqrt(p)) OVER c AS ac, sum(p) OVER t AS pt, sum(sqrt(p)) OVER t AS atotal,
    max(sqrt(p)) OVER t AS atop, max(CASE WHEN k > 0 THEN sqrt(p) END) OVER t AS utop,
    first_value(sqrt(p)) OVER c AS a0, lag(sqrt(p)) OVER o AS aprev, p / nullif(sum(p) OVER t, 0) AS q
  FROM power WINDOW o AS (PARTITION BY ventana ORDER BY k), t AS (PARTITION BY ventana),
    c AS (PARTITION BY ventana ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), steps AS (
  SELECT *, CASE WHEN abs(a - aprev) < atop * 1e-9 THEN 0 ELSE a - aprev END AS d,
    sum(f * q) OVER (PARTITION BY ventana) AS m1 FROM bins), turns AS (
  SELECT *, lead(d) OVER (PARTITION BY ventana ORDER BY k) AS d_next FROM steps), agg AS (
  SELECT ventana, any_value(pt) AS pt, any_value(m1) AS m1, sqrt(sum((f - m1) ** 2 * q)) AS sd,
    sum((f - m1) ** 3 * q) AS m3, sum((f - m1) ** 4 * q) AS m4, max(p) AS top,
    min(f) FILTER (k > 0 AND a >= utop * (1 - 1e-9)) AS strongest, any_value(utop) AS utop,
    min(f) FILTER (pc >= pt * (0.95 - 1e-9)) AS p95, min(f) FILTER (pc >= pt * (0.5 - 1e-9)) AS p50,
    min(f) FILTER (pc >= pt * (0.975 - 1e-9)) AS p975, min(f) FILTER (pc >= pt * (0.025 - 1e-9)) AS p025,
    min(f) FILTER (ac >= atotal * (0.05 - 1e-9)) AS a05, min(f) FILTER (ac >= atotal * (0.95 - 1e-9)) AS a95,
    regr_slope(a, f) AS slope, sum((a - a0) / nullif(k, 0)) / nullif(sum(a) FILTER (k > 0), 0) AS decrease,
    1 - sum(a * aprev) / nullif(sqrt(sum(a * a) FILTER (k > 0) * sum(aprev * aprev)), 0) AS variation,
    -sum(CASE WHEN q > 0 THEN q * log2(q) ELSE 0 END) / log2(7) AS entropy, sum(atotal * k / 6.0 - ac) AS distance,
    count(*) FILTER (d < 0 AND d_next > 0) AS turns,
    {comma([f"max(p) FILTER (k = {k}) AS p{k}" for k in range(7)])} FROM turns GROUP BY ventana)
"""

SPECTRAL = SPECTRUM + "SELECT ventana, " + comma(
    [r6(f"p{k}", f"ts_fft_power_{k}") for k in range(7)], r6("top", "ts_max_power"),
    r6("CASE WHEN utop > 0 THEN strongest ELSE 0 END", "ts_fundamental_frequency"),
    [r6(f"CASE WHEN pt > 0 THEN {e} END", name) for e, name in (
        ("p95", "ts_max_frequency"), ("p50", "ts_median_frequency"), ("a05", "ts_roll_on"), ("a95", "ts_roll_off"),
        ("p975 - p025", "ts_power_bandwidth"), ("m1", "ts_spectral_centroid"), ("sd", "ts_spectral_spread"),
        ("CASE WHEN sd < sqrt(1e-9) THEN 0 ELSE m3 / sd ** 3 END", "ts_spectral_skewness"),
        ("CASE WHEN sd < sqrt(1e-9) THEN 0 ELSE m4 / sd ** 4 END", "ts_spectral_kurtosis"),
        ("slope", "ts_spectral_slope"), ("decrease", "ts_spectral_decrease"), ("variation", "ts_spectral_variation"),
        ("entropy", "ts_spectral_entropy"), ("distance", "ts_spectral_distance"))],
    big("turns", "ts_spectral_positive_turning")) + " FROM agg"

CHOSEN = SPECTRUM.rstrip() + """, med AS (SELECT ventana, median(x) AS med FROM ser GROUP BY ALL), crossings AS (
  SELECT ventana, count(*) FILTER (sign(x) <> sign(nxt)) AS zc FROM (
    SELECT ventana, x, lead(x) OVER (PARTITION BY ventana ORDER BY i) AS nxt FROM ser) GROUP BY ALL)
SELECT ventana, """ + comma(
    r6("med", "ts_median"), big("zc", "ts_zero_cross"), r6("m1", "ts_spectral_centroid")) + """
FROM agg JOIN med USING (ventana) JOIN crossings USING (ventana)"""

# --- encoder and model inputs -----------------------------------------------------------------------------------------

LABELLED = f"""WITH {CONSUMO}, rows AS (SELECT contrato, pos, categoria, estado, localidad, subcategoria_estrato, consumo,
  CAST(determinacion_consumo IN ('1-URGENT', '2-HIGH') AS BIGINT) AS target FROM consumo)"""


def _smoothed(keys: str, source: str, weight: int, name: str) -> str:
    return (f"{name} AS (SELECT {keys}, (sum(target) + (SELECT avg(target) FROM rows) * {weight}) / (count(*) + {weight}) "
            f"AS encoded FROM {source} GROUP BY ALL)")


def _reduced(column: str, threshold: float) -> str:
    return (f"CASE WHEN {column} IN (SELECT {column} FROM rows WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) "
            f">= {threshold} * (SELECT count({column}) FROM rows)) THEN {column} ELSE 'otros' END")


MAJORITY = f"""WITH {CONSUMO}, {LABELS}, rows AS (
  SELECT k.contrato, k.date, CAST(coalesce(l.is_fraud, 0) AS BIGINT) AS target FROM (
    SELECT DISTINCT contrato, date FROM consumo) k LEFT JOIN (SELECT * FROM labels WHERE is_fraud = 1) l
  ON k.contrato = l.contrato AND k.date = l.date), sizes AS (
  SELECT count(*) FILTER (target = 0) AS big, count(*) FILTER (target = 1) AS small FROM rows), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY
    md5(contrato || '|' || CAST(date AS VARCHAR) || '|40')) AS place FROM rows)"""

NUMERIC = """WITH rows AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax, l_quantity * 2 + l_tax AS double_quantity,
  1.0 AS one, CASE WHEN l_quantity > 1 THEN 0.0 ELSE 1.0 END AS nearly_zero,
  CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS target FROM lineitem)"""


def _pairs(columns: list[str], prefix: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {r6(f'corr({prefix}{a}, {prefix}{b})', 'correlation')} FROM rows"
        for i, a in enumerate(columns) for b in columns[i + 1:])


CORRELATED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "double_quantity"]
RANKED = NUMERIC.replace("WITH rows AS", "WITH plain AS") + ", rows AS (SELECT " + comma([
    f"avg(p_{c}) OVER (PARTITION BY {c}) AS {c}" for c in CORRELATED[:4]]) + " FROM (SELECT *, " + comma([
        f"row_number() OVER (ORDER BY {c}) AS p_{c}" for c in CORRELATED[:4]]) + " FROM plain))"


def _kept_by_correlation(features: list[str], threshold: float) -> str:
    drops = " UNION ".join(
        f"SELECT '{b}' AS feature FROM rows HAVING abs(corr({a}, {b})) > {threshold} "
        f"AND abs(corr({a}, target)) > abs(corr({b}, target))" for a in features for b in features if a != b)
    names = ", ".join(f"'{f}'" for f in features)
    return f"SELECT feature FROM (SELECT unnest([{names}]) AS feature) WHERE feature NOT IN ({drops})"


def _top_shares(features: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, max(c) * 1.0 / (SELECT count(*) FROM rows) AS top_share FROM "
        f"(SELECT count(*) AS c FROM rows WHERE {f} IS NOT NULL GROUP BY {f})" for f in features)


RAW_CONSUMO = f"""{ITEMS}, raw_consumo AS (
  SELECT ' ' || contrato || ' ' AS niu, strftime(l_shipdate, '%Y%m') AS fecha_mes,
    CAST(CAST(floor(l_quantity / 10) - 1 AS BIGINT) AS VARCHAR) AS consumo,
    CASE WHEN l_tax <> 0.08 THEN l_returnflag END AS categoria, l_linestatus AS estado,
    CAST(l_linenumber AS VARCHAR) AS microsector, ' ' || CAST(l_suppkey AS VARCHAR) || ' ' AS instalacion,
    ' ' || CAST(s_nationkey AS VARCHAR) || ' ' AS subcategoria_estrato, ' ' || n_name || ' ' AS localidad,
    ' ' || r_name || ' ' AS municipio, ' ' || o_orderpriority || ' ' AS determinacion_consumo,
    CASE WHEN s_acctbal >= 0 THEN ' ' || n_name || ' ' END AS barrio, year, month, pos, date, FALSE AS broken FROM items
  UNION ALL
  SELECT ' ' || contrato || ' ', strftime(l_shipdate, '%Y-%m'),
    CAST(CAST(floor(l_quantity / 10) - 1 AS BIGINT) AS VARCHAR),
    CASE WHEN l_tax <> 0.08 THEN l_returnflag END, l_linestatus, CAST(l_linenumber AS VARCHAR),
    ' ' || CAST(l_suppkey AS VARCHAR) || ' ', ' ' || CAST(s_nationkey AS VARCHAR) || ' ', ' ' || n_name || ' ',
    ' ' || r_name || ' ', ' ' || o_orderpriority || ' ', CASE WHEN s_acctbal >= 0 THEN ' ' || n_name || ' ' END,
    year, month, pos, date, TRUE FROM items WHERE l_discount = 0)"""

RAW_NAMES = ("niu, fecha_mes, consumo, categoria, estado, microsector, instalacion, subcategoria_estrato, localidad, "
             "municipio, determinacion_consumo, barrio")
CLEAN_NAMES = ("contrato, date, consumo, categoria, estado, microsector, instalacion, subcategoria_estrato, localidad, "
               "municipio, determinacion_consumo, coalesce(barrio, 'sin_dato') AS barrio, year, month")
LABEL_NAMES = ("contrato, date, is_fraud, clasificacion_resultado, solicitud, instalacion, resultado, causa_de_revision, "
               "pos, year, month")
CUTOFFS_OF_LABELS = f"WITH {ITEMS}, {LABELS}, c AS (SELECT DISTINCT date AS cutoff FROM labels)"


def _ratio_of_curves() -> str:
    """Area under the ROC curve by trapezoids, and average precision by steps, over the distinct scores."""
    return f"""{LABELLED}, points AS (
  SELECT consumo / 4 AS score, sum(target) AS pos, count(*) - sum(target) AS neg FROM rows WHERE consumo IS NOT NULL
  GROUP BY ALL), cum AS (
  SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, (SELECT sum(pos) FROM points) AS p,
    (SELECT sum(neg) FROM points) AS n FROM points WINDOW w AS (ORDER BY score DESC)), curve AS (
  SELECT score, tp / p AS tpr, fp / n AS fpr, tp / (tp + fp) AS prec FROM cum), steps AS (
  SELECT tpr, fpr, prec, lag(tpr, 1, 0) OVER w AS tpr0, lag(fpr, 1, 0) OVER w AS fpr0
  FROM curve WINDOW w AS (ORDER BY score DESC))
SELECT {r6("sum((fpr - fpr0) * (tpr + tpr0) / 2)", "auc")},
  {r6("sum((tpr - tpr0) * prec)", "average_precision")} FROM steps"""


FEATURE_QUERIES = ("trend_drop_flags", "constant_runs", "zero_runs", "series_moments", "series_slope", "ts_statistical", "ts_temporal",
                   "ts_spectral")


def with_features(oracles: dict[str, str], name: str, cutoffs: list[str]) -> str:
    """The rows of a wide query with every series feature of their window."""
    joins = " ".join(
        f"JOIN ({oracles[q].replace(windows(VALID), windows(cutoffs))}) {q} USING (ventana)" for q in FEATURE_QUERIES)
    return (f"SELECT * EXCLUDE (ventana) FROM (SELECT *, contrato || ' ' || CAST(date_fizcalizacion AS VARCHAR) AS ventana "
            f"FROM ({oracles[name]}) wide) {joins}")


GATED = f"""{panel(ONE)}, {RATIO_PARTS}, zeros AS (SELECT contrato, count(*) FILTER (x = 0) AS zeros FROM ser GROUP BY ALL),
  gated AS (SELECT contrato FROM levels JOIN zeros USING (contrato) WHERE cant_null < 6 AND zeros < 9)"""


def oracle_sql() -> dict[str, str]:
    made = plain_sql()
    return made | {
        "train_features": with_features(made, "train_wide_multi_cutoff", VALID),
        "inference_features": with_features(made, "inference_wide", ONE),
        "labels_over_files": f"""WITH {ITEMS}, {LABELS}, filed AS (
  SELECT * EXCLUDE (year, month), CAST(year(f) AS BIGINT) AS year, CAST(month(f) AS BIGINT) AS month FROM (
    SELECT *, date + to_months(CAST(pos % 3 AS INTEGER)) AS f FROM inspected))
SELECT contrato, date, is_fraud, pos, year, month FROM (SELECT *, row_number() OVER (
  PARTITION BY contrato, date ORDER BY is_fraud DESC, year, month, pos) AS place FROM filed) WHERE place = 1""",
        # facts about models: who is scored, and what holds of every score
        "gbt_scores": f"{GATED} SELECT contrato, TRUE AS is_probability FROM gated",
        "saved_model_scores": f"{GATED} SELECT contrato, TRUE AS same_score, TRUE AS same_features FROM gated",
        "random_search": "SELECT TRUE AS is_auc, TRUE AS is_a_candidate",
        "forest_vote_select": """SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount']) AS feature,
  unnest([TRUE, FALSE, FALSE]) AS selected""",
    }


def plain_sql() -> dict[str, str]:
    return {
        # sources and sinks
        "raw_month_read": f"""WITH {RAW_CONSUMO} SELECT {RAW_NAMES}, year, month,
  lag(concat_ws('|', determinacion_consumo, fecha_mes)) OVER (
    PARTITION BY niu, year, month ORDER BY pos, length(fecha_mes)) AS before FROM raw_consumo""",
        "pending_months": f"WITH {ITEMS}, {RAW_INSPECTIONS} SELECT DISTINCT year, month FROM raw_inspections WHERE year > 1998",
        "etl_summary": f"""WITH {ITEMS}, {RAW_INSPECTIONS}, n AS (
  SELECT 'inspecciones' AS source, count(DISTINCT year * 100 + month) AS c FROM raw_inspections UNION ALL
  SELECT 'consumo', count(DISTINCT year * 100 + month) FROM items)
SELECT source, c AS processed, CAST(0 AS BIGINT) AS skipped, c AS total_pending FROM n""",
        "interim_round_trip": f"""WITH {CONSUMO} SELECT {CLEAN_NAMES}, lag(concat_ws('|', determinacion_consumo,
  CAST(consumo AS VARCHAR))) OVER (PARTITION BY contrato, file_month ORDER BY pos) AS before FROM consumo""",
        "streamed_interim": f"WITH {ITEMS}, {LABELS} SELECT contrato, date, is_fraud, year, month FROM labels",
        "interim_pruned_scan": f"""WITH {CONSUMO} SELECT contrato, date, consumo, categoria, pos FROM consumo
  WHERE file_month BETWEEN 199801 AND 199901""",
        "consumption_month_range": f"WITH {CONSUMO} SELECT min(date) AS first_month, max(date) AS last_month FROM consumo",
        "processed_months": f"WITH {ITEMS}, {LABELS} SELECT DISTINCT year, month FROM labels",
        "processed_dataset": f"""{panel(VALID)}, {LATEST}, {DISTINCT} SELECT contrato, cutoff AS date_fizcalizacion, categoria, cant_estado, barrio
  FROM ids JOIN latest USING (contrato, cutoff) JOIN dist USING (contrato, cutoff)""",
        "score_file": f"{SER} SELECT ventana AS contrato, {r6('x / 10', 'score')} FROM ser WHERE i = 11",
        "ranked_delivery": f"{SER} SELECT ventana, 'v1' AS id_seleccion, {r6('max(x)', 'pred_score')} FROM ser GROUP BY ventana",
        # cleaning
        "normalized_text": "SELECT doc_id, " + comma([
            rf"regexp_replace(regexp_replace(regexp_replace(strip_accents(lower({c})), '[^\w\s]', '', 'g'), "
            rf"'^\s+|\s+$', '', 'g'), '\s+', '_', 'g') AS {c}" for c in ("source", "text")]) + " FROM documents",
        "clean_consumption": f"WITH {CONSUMO} SELECT {CLEAN_NAMES}, pos FROM consumo",
        "clean_inspections": f"WITH {ITEMS}, {LABELS} SELECT {LABEL_NAMES} FROM labels",
        "contract_keys": f"WITH {ITEMS}, {RAW_INSPECTIONS} SELECT contrato, pos FROM raw_inspections WHERE length(contrato) = 9",
        "month_parse": f"""WITH {RAW_CONSUMO} SELECT niu, fecha_mes, date, year AS anio, month AS mes, pos FROM raw_consumo
  WHERE NOT broken""",
        "result_labels": f"""WITH {ITEMS}, {RAW_INSPECTIONS} SELECT solicitud, pos, clasificacion_resultado,
  CAST(coalesce(clasificacion_resultado IN ('Fraude', 'Anomalía'), FALSE) AS BIGINT) AS is_fraud
FROM raw_inspections WHERE clasificacion_resultado IS DISTINCT FROM 'Sin definición'""",
        "label_argmax_dedup": f"""WITH {CONSUMO}, flagged AS (SELECT contrato, date, pos, categoria,
    CAST(determinacion_consumo IN ('1-URGENT', '2-HIGH') AS BIGINT) AS is_fraud FROM consumo)
SELECT contrato, date, is_fraud, pos, categoria FROM (SELECT *, row_number() OVER (
  PARTITION BY contrato, date ORDER BY is_fraud DESC, pos) AS place FROM flagged) WHERE place = 1""",
        "non_negative_measure": f"""WITH {RAW_CONSUMO} SELECT niu,
  count(*) FILTER (CAST(consumo AS DOUBLE) >= 0) AS readings,
  round(sum(CAST(consumo AS DOUBLE)) FILTER (CAST(consumo AS DOUBLE) >= 0), 6) AS consumo FROM raw_consumo GROUP BY niu""",
        "default_strings": f"""WITH {RAW_CONSUMO} SELECT coalesce(trim(barrio), 'sin_dato') AS barrio, count(*) AS rows
  FROM raw_consumo GROUP BY 1""",
        "filled_nulls": f"""WITH {CONSUMO} SELECT contrato, pos, coalesce(categoria, 'sin_dato') AS categoria,
  coalesce(barrio, 'sin_dato') AS barrio, coalesce(consumo, -1.0) AS consumo FROM consumo""",
        "model_input_gate": f"""{panel(VALID)}, {LATEST}, {RATIO_PARTS}, zeros AS (
  SELECT contrato, cutoff, count(*) FILTER (x = 0) AS zeros FROM ser GROUP BY ALL)
SELECT contrato, cutoff, coalesce(categoria, 'sin_dato') AS categoria, subcategoria_estrato, municipio, localidad,
  coalesce(barrio, 'sin_dato') AS barrio, {big("cant_null", "cant_null")}, {big("zeros", "cant_ceros_12")}
FROM ids JOIN latest USING (contrato, cutoff) JOIN levels USING (contrato, cutoff) JOIN zeros USING (contrato, cutoff)
WHERE cant_null < 6 AND zeros < 9""",
        "danger_zone_code": f"""WITH {CONSUMO} SELECT contrato, pos, CAST(CASE WHEN estado = 'O' THEN 1
  WHEN categoria = 'A' THEN 0 END AS BIGINT) AS zona FROM consumo""",
        "allow_list_filter": f"""WITH {CONSUMO}, {LABELS} SELECT contrato, date, pos, consumo FROM consumo
  WHERE contrato IN (SELECT contrato FROM labels WHERE is_fraud = 1)""",
        "month_completeness": f"""WITH {CONSUMO} SELECT count(DISTINCT date) AS months FROM consumo
  WHERE date >= DATE '1998-01-01' AND date < DATE '1999-01-01'""",
        # windows, joins and aggregates
        "window_bounds": f"""{CUTOFFS_OF_LABELS} SELECT cutoff, CAST(cutoff - INTERVAL 12 MONTH AS DATE) AS start,
  CAST(cutoff - INTERVAL 1 DAY AS DATE) AS last_day FROM c""",
        "month_calendar": f"""{CUTOFFS_OF_LABELS} SELECT cutoff, CAST(p AS BIGINT) AS position,
  CAST(cutoff - to_months(CAST(12 - p AS INTEGER)) AS DATE) AS month FROM c CROSS JOIN (SELECT unnest(range(0, 12)) AS p)""",
        "valid_cutoffs": f"""WITH {CONSUMO}, {LABELS} SELECT DISTINCT date AS cutoff FROM labels
  WHERE date >= (SELECT min(date) FROM consumo) + INTERVAL 12 MONTH AND date <= DATE '2001-06-01'""",
        "window_slice": f"""WITH {CONSUMO}, {windows(VALID)} SELECT contrato, date, pos, consumo, cutoff, {big("k", "k")} FROM win""",
        "contract_sums": f"WITH {CONSUMO}, {windows(VALID)}, {POPULATION_SUMS} SELECT * FROM sums",
        "population_stats_12_6_3": f"""WITH {CONSUMO}, {windows(VALID)}, {POPULATION_SUMS}, {POPULATION}
SELECT cutoff, categoria, {comma([r6(c, c) for c in POPULATION_COLUMNS])} FROM pop""",
        "inspected_window_rows": f"""WITH {CONSUMO}, {windows(VALID)}
SELECT contrato, date, pos, cutoff, {big("k", "k")} FROM win w
WHERE EXISTS (SELECT 1 FROM labels l WHERE l.contrato = w.contrato AND l.date = w.cutoff)""",
        "uninspected_contracts": f"WITH {CONSUMO}, {windows(VALID)}, {NEGATIVES} SELECT * FROM unlabelled",
        "negative_sample": f"WITH {CONSUMO}, {windows(VALID)}, {NEGATIVES} SELECT * FROM negatives",
        "attr_distinct_counts": f"WITH {CONSUMO}, {windows(VALID)}, {DISTINCT} SELECT * FROM dist",
        "attr_change_counts": f"""WITH {CONSUMO}, {windows(VALID)}, {CHANGES} SELECT contrato, cutoff, {comma(CHANGE_COLUMNS)}
FROM (SELECT DISTINCT contrato, cutoff FROM win) {JOIN_CHANGES}""",
        "latest_attributes": f"WITH {CONSUMO}, {windows(VALID)}, {LATEST} SELECT * FROM latest",
        "wide_pivot": f"{panel(VALID)} SELECT contrato, cutoff, {comma(month_values('v'))} FROM ser GROUP BY contrato, cutoff",
        "null_count": f"{panel(VALID)} SELECT contrato, cutoff, count(*) FILTER (v IS NULL) AS cant_null FROM ser GROUP BY ALL",
        "gap_fill": f"{panel(VALID)} SELECT contrato, cutoff, {comma(month_values('x'))} FROM ser GROUP BY contrato, cutoff",
        "population_ratios": f"""{panel(VALID)}, {POPULATION_SUMS}, {POPULATION}, {LATEST}, {RATIO_PARTS}
SELECT contrato, cutoff, categoria, {comma(RATIOS)} FROM ids JOIN latest USING (contrato, cutoff)
JOIN levels USING (contrato, cutoff) LEFT JOIN pop USING (cutoff, categoria)""",
        "calendar_features": f"{CUTOFFS_OF_LABELS} SELECT cutoff, {comma(CALENDAR)} FROM c",
        "label_join": f"""{panel(VALID)} SELECT ids.contrato, cutoff, {comma(LABEL_COLUMNS)} FROM ids
LEFT JOIN labels l ON l.contrato = ids.contrato AND l.date = ids.cutoff""",
        "inference_wide": wide_sql(ONE),
        "inference_wide_allow_list": wide_sql(
            ONE, [*[r6(c, c) for c in POPULATION_COLUMNS], RATIOS[2]], "", "(SELECT * FROM wide_ids "
            "WHERE contrato IN (SELECT contrato FROM labels WHERE is_fraud = 1))"),
        "train_wide_multi_cutoff": wide_sql(
            VALID, None, f", {NEGATIVES}, targets AS (SELECT contrato, date AS cutoff FROM labels "
            "UNION ALL SELECT contrato, cutoff FROM negatives)", "targets",
            "LEFT JOIN labels l ON l.contrato = targets.contrato AND l.date = targets.cutoff", LABEL_COLUMNS
        ).replace("SELECT contrato, cutoff AS date_fizcalizacion", "SELECT targets.contrato, cutoff AS date_fizcalizacion"),
        # series features
        "trend_percentages": f"{SER} SELECT ventana, " + comma([
            r6(f"round({_trend(b, e)}, 3)", f"trend_{b}_{e}") for b, e, _ in TREND_DROPS]) + " FROM ser GROUP BY ventana",
        "trend_drop_flags": f"{SER} SELECT ventana, " + comma([
            big(f"100 - {_trend(b, e)} > {th}", f"trend_perc_{b}_{e}") for b, e, th in TREND_DROPS])
            + " FROM ser GROUP BY ventana",
        "constant_runs": f"{SER}, {RUNS} SELECT ventana, " + comma([
            big(f"max(len) >= {r}", f"constant_{r}") for r in CONSTANT_RUNS]) + " FROM runs WHERE m = 12 GROUP BY ventana",
        "zero_runs": f"{SER}, {RUNS} SELECT ventana, " + comma([
            big(f"coalesce(sum(len) FILTER (m = {m} AND x = 0), 0)", f"cant_ceros_{m}") for m in (3, 6, 12)], [
            big(f"coalesce(max(len) FILTER (m = {m} AND x = 0 AND len >= 2), 0)", f"max_cant_ceros_seg_{m}")
            for m in (3, 6, 12)]) + " FROM runs GROUP BY ventana",
        "series_moments": moments_sql(MOMENTS),
        "series_slope": moments_sql(["slope_3", "slope_6", "slope_12"]),
        "row_minmax": f"{SER}, ext AS (SELECT ventana, min(x) AS lo, max(x) AS hi FROM ser GROUP BY ALL) SELECT ventana, "
            + comma([r6(f"max(CASE WHEN i = {i} THEN CASE WHEN hi = lo THEN 0 ELSE (x - lo) / (hi - lo) END END)", f"x_{i}")
                     for i in range(12)]) + " FROM ser JOIN ext USING (ventana) GROUP BY ventana",
        "ts_statistical": STATISTICAL,
        "ts_temporal": TEMPORAL,
        "ts_spectral": SPECTRAL,
        "ts_chosen_features": CHOSEN,
        # encoders, sampling, reports, selection
        "dummy_encode": f"{LABELLED} SELECT contrato, pos, " + comma([
            big(f"coalesce({c} = '{v}', FALSE)", f"dummy_{c}_{v}")
            for c, v in (("categoria", "A"), ("categoria", "N"), ("categoria", "R"), ("estado", "F"), ("estado", "O"))])
            + " FROM rows",
        "target_encode": f"""{LABELLED}, {_smoothed("categoria, localidad", "rows WHERE categoria IS NOT NULL", 50, "te")}
SELECT contrato, pos, target, {r6("coalesce(encoded, (SELECT avg(target) FROM rows))", "categoria")}
FROM rows LEFT JOIN te USING (categoria, localidad)""",
        "category_shares": f"""{LABELLED} SELECT categoria AS value,
  {r6("count(*) * 1.0 / (SELECT count(categoria) FROM rows)", "share")} FROM rows WHERE categoria IS NOT NULL GROUP BY categoria""",
        "cardinality_reduce": f"""{LABELLED} SELECT contrato, pos, {_reduced("categoria", 0.05)} AS categoria,
  {_reduced("localidad", 0.05)} AS localidad FROM rows""",
        "model_preprocessing": f"""{LABELLED}, red AS (SELECT contrato, pos, categoria, target,
  {_reduced("localidad", 0.005)} AS localidad, {_reduced("subcategoria_estrato", 0.05)} AS stratum FROM rows),
  {_smoothed("localidad", "red", 50, "te_l")}, {_smoothed("stratum", "red", 50, "te_s")}
SELECT contrato, pos, target, {comma([big(f"coalesce(categoria = '{v}', FALSE)", f"dummy_categoria_{v}") for v in "ANR"])},
  {r6("te_l.encoded", "localidad")}, {r6("te_s.encoded", "subcategoria_estrato")}
FROM red JOIN te_l USING (localidad) JOIN te_s USING (stratum)""",
        "split_80_20": f"""WITH {ITEMS}, {LABELS} SELECT contrato, date, is_fraud AS target,
  md5(contrato || '|' || CAST(date AS VARCHAR) || '|42') < 'cccccccc' AS is_train FROM labels""",
        "oversampled_rows": f"""{MAJORITY}, plan AS (SELECT CAST(floor(big * 0.5) AS BIGINT) - small AS extra, small FROM sizes),
  copies AS (SELECT contrato, date, target, 1 + extra // small + CASE WHEN place <= extra % small THEN 1 ELSE 0 END AS n
    FROM ranked CROSS JOIN plan WHERE target = 1)
SELECT contrato, date, target FROM rows WHERE target = 0 UNION ALL
SELECT contrato, date, target FROM (SELECT contrato, date, target, unnest(range(0, n)) AS copy FROM copies)""",
        "undersampled_rows": f"""{MAJORITY} SELECT contrato, date, target FROM ranked
WHERE target = 1 OR place <= (SELECT floor(small / 0.5) FROM sizes)""",
        "target_mean": f"WITH {ITEMS}, {LABELS} SELECT {r6('avg(is_fraud)', 'target_mean')} FROM labels",
        "target_counts": f"WITH {ITEMS}, {LABELS} SELECT is_fraud AS target, count(*) AS rows FROM labels GROUP BY 1",
        "score_histogram": f"""WITH s AS (SELECT l_extendedprice / 100000 AS score FROM lineitem), e AS (
  SELECT min(score) AS lo, max(score) AS hi FROM s)
SELECT {big("least(floor(50 * (score - lo) / (hi - lo)) + 1, 50)", "bin")}, count(*) AS rows FROM s CROSS JOIN e GROUP BY 1""",
        "zero_scores": f"""WITH {CONSUMO} SELECT count(*) FILTER (coalesce(consumo, 0) / 4 = 0) AS zero_scores FROM consumo""",
        "auc_rank_sum": _ratio_of_curves(),
        "correlation_matrix": f"{NUMERIC} " + _pairs([*CORRELATED, "target"]),
        "rank_correlation_matrix": f"{RANKED} " + _pairs(CORRELATED[:4]),
        "corr_select": f"{NUMERIC} " + _kept_by_correlation(CORRELATED, 0.9),
        "constant_select": f"{NUMERIC} SELECT feature FROM (" + _top_shares(
            ["l_quantity", "l_discount", "l_tax", "one", "nearly_zero"]) + ") WHERE top_share <= 0.95",
        "top_value_shares": f"{NUMERIC} SELECT feature, {r6('top_share', 'top_share')} FROM (" + _top_shares(
            ["l_quantity", "l_discount", "l_tax", "nearly_zero"]) + ")",
    }
