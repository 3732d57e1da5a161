"""Plain SQL for the same results, written without the operators it checks."""

from heatline.constants import (
    CLEAN_PATTERN, ENGLISH_STOP_WORDS, PUNCTUATION, SPLIT_SEED, SYNTHETIC_AXIS_START)
from heatline.operators.kalman import acceleration_model, velocity_model
from heatline.plans import catalog as C


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def mean(value="value"):
    return f"round(avg({value}), 9)"


def bucket(unit, name="timestamp", where="TRUE"):
    return f"""SELECT event_type AS series, date_trunc('{unit}', ts) AS "{name}",
        {mean()} AS prediction, count(*) AS n FROM events WHERE {where} GROUP BY 1, 2"""


SPARSE = f"""
raw AS (SELECT event_type AS series, date_trunc('hour', ts) AS hour, {mean()} AS y
        FROM events GROUP BY 1, 2),
sparse AS (SELECT series, row_number() OVER (PARTITION BY series ORDER BY hour) - 1 AS idx, hour, y
           FROM raw)"""
DENSE = f"""
raw AS (SELECT event_type AS series, date_trunc('hour', ts) AS hour, {mean()} AS y
        FROM events GROUP BY 1, 2),
ends AS (SELECT series, min(hour) AS a, max(hour) AS b FROM raw GROUP BY 1),
axis AS (SELECT series, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS hour FROM ends),
dense AS (SELECT series, row_number() OVER (PARTITION BY series ORDER BY hour) - 1 AS idx, hour,
                 last_value(y IGNORE NULLS) OVER (PARTITION BY series ORDER BY hour) AS y
          FROM axis LEFT JOIN raw USING (series, hour))"""
DAILY = f"""
daily AS (SELECT o_orderpriority AS series, o_orderdate AS day,
                 round(sum(o_totalprice), 4) AS y
          FROM orders GROUP BY 1, 2),
returns AS (SELECT series, row_number() OVER w - 2 AS idx, ln(y) - lag(ln(y)) OVER w AS r
            FROM daily WINDOW w AS (PARTITION BY series ORDER BY day)
            QUALIFY lag(y) OVER w IS NOT NULL),
level AS (SELECT series, avg(r) AS m, var_pop(r) AS s2 FROM returns GROUP BY 1),
shocks AS (SELECT series, idx, r - m AS e, s2 FROM returns JOIN level USING (series))"""

TIMED = f"""
timed AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS idx,
                 TIMESTAMP '{SYNTHETIC_AXIS_START}'
                 + to_hours(row_number() OVER (ORDER BY doc_id)) AS "timestamp" FROM documents)"""

# The queries that need a time but not a rank: an hour per id.
DATED = f"""
timed AS (SELECT *, TIMESTAMP '{SYNTHETIC_AXIS_START}' + to_hours((doc_id + 1)::BIGINT) AS "timestamp"
          FROM documents)"""

CLEAN = f"trim(lower(regexp_replace(text, '{CLEAN_PATTERN}', '', 'g')))"
PLAIN = "[" + "".join("\\" + c for c in PUNCTUATION) + "]+"
NORMAL = (f"trim(regexp_replace(regexp_replace(lower(text), {text(PLAIN)}, '', 'g'), "
          r"'[\s\p{Z}]+', ' ', 'g'))")
STOPS = ", ".join(text(w) for w in ENGLISH_STOP_WORDS)


def split(value):
    body = rf"regexp_replace(lower({value}), '\s+$', '')"
    return (f"CASE WHEN {value} = '' THEN [''] WHEN {body} = '' THEN CAST([] AS VARCHAR[]) "
            rf"ELSE string_split_regex({body}, '\s') END")


TERMS = f"""
kept AS (SELECT doc_id, list_filter({split(CLEAN)}, lambda w: w NOT IN ({STOPS})) AS words
         FROM documents)"""


def found(where="TRUE"):
    return f"""WITH {DATED} SELECT '{C.SEARCHED}' AS topic, doc_id, "timestamp", text FROM timed
        WHERE lang = 'en' AND contains(lower(text), '{C.SEARCHED}') AND {where}
        QUALIFY row_number() OVER (ORDER BY doc_id DESC) <= 100"""


TOPIC_ROWS = ", ".join(f"({text(t)})" for t in C.TOPICS)


def loci(source, width):
    """CTEs that end in `tagged`: the input with its flag, from the definition at every radius.

    Values fall into bins of `width`; a radius matters if it, or half of it, is the distance of two
    filled bins.
    """
    near = "PARTITION BY series, r ORDER BY x RANGE BETWEEN r // 2 PRECEDING AND r // 2 FOLLOWING"
    wide = "PARTITION BY series, r ORDER BY x RANGE BETWEEN r PRECEDING AND r FOLLOWING"
    return f"""WITH input AS ({source}),
    binned AS (SELECT *, floor(v / {width})::BIGINT AS x FROM input),
    filled AS (SELECT series, x, count(*)::HUGEINT AS c FROM binned GROUP BY 1, 2),
    gaps AS (SELECT DISTINCT a.series, a.x - b.x AS d FROM filled a JOIN filled b USING (series) WHERE a.x > b.x),
    radii AS (SELECT series, d AS r FROM gaps UNION SELECT series, 2 * d FROM gaps),
    near AS (SELECT series, r, x, c, sum(c) OVER ({near}) AS a FROM filled JOIN radii USING (series)),
    wide AS (SELECT series, x, a, sum(c) OVER ({wide}) AS n, sum(c * a) OVER ({wide}) AS p,
                    sum(c * a * a) OVER ({wide}) AS q FROM near),
    marks AS (SELECT series, x, max(CAST(p >= 20 * n AND p > a * n
                     AND (p - a * n) * (p - a * n) > 9 * (q * n - p * p) AS INTEGER)) AS flag FROM wide GROUP BY 1, 2),
    tagged AS (SELECT b.*, coalesce(flag, 0) AS flag FROM binned b LEFT JOIN marks USING (series, x))"""


MINUTES = f"""SELECT series, "timestamp", prediction AS v FROM ({bucket('minute')})"""
LOCI_LENGTHS = loci("SELECT doc_id, lang AS series, n_chars::DOUBLE AS v FROM documents", 50)

PERSIST = f"""WITH {DENSE},
pairs AS (SELECT series, idx, y AS label, lag(y) OVER (PARTITION BY series ORDER BY idx) AS p
          FROM dense QUALIFY p IS NOT NULL)"""


def seasonal(rows):
    """CTEs up to the fit: lagged seasonal differences, ten sums, fifty alternations."""
    sums = ", ".join(f"sum(w{i} * w{j}) AS g{i}{j}" for i in range(4) for j in range(i, 4))
    phi = ("coalesce((g01 - b * (g12 + g03) + b * b * g23) / "
           "nullif(g11 - 2 * b * g13 + b * b * g33, 0), 0)")
    big = ("coalesce((g02 - a * (g12 + g03) + a * a * g13) / "
           "nullif(g22 - 2 * a * g23 + a * a * g33, 0), 0)")
    return f"""
    w AS (SELECT series, idx, y, y - lag(y, 12) OVER o AS w0 FROM {rows}
          WINDOW o AS (PARTITION BY series ORDER BY idx)),
    ws AS (SELECT series, idx, w0, lag(w0, 1) OVER o AS w1, lag(w0, 12) OVER o AS w2,
                  lag(w0, 13) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY series ORDER BY idx)
           QUALIFY w3 IS NOT NULL),
    g AS (SELECT series, count(*) AS equations, {sums} FROM ws GROUP BY 1),
    turns AS (SELECT series, 0 AS i, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b FROM g
              UNION ALL
              SELECT series, i + 1, a, {big} AS b FROM
                (SELECT series, i, {phi} AS a, g.* EXCLUDE (series) FROM turns JOIN g USING (series)
                 WHERE i < 50)),
    fit AS (SELECT series, n, equations, a AS phi, b AS seasonal_phi,
                   g00 + a*a*g11 + b*b*g22 + a*a*b*b*g33 + 2*(-a*g01 - b*g02 + a*b*g03 + a*b*g12
                   - a*a*b*g13 - a*b*b*g23) AS css
            FROM turns JOIN g USING (series)
            JOIN (SELECT series, count(*) AS n FROM {rows} GROUP BY 1) USING (series)
            WHERE i = 50)"""


def seasonal_path(rows, steps):
    return f"""{seasonal(rows)},
    tail AS (SELECT series, list(y ORDER BY idx) AS ys, list(w0 ORDER BY idx) AS ws FROM
               (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY series ORDER BY idx DESC)
                                        <= 13) GROUP BY 1),
    path AS (SELECT series, 0 AS h, ys, ws, 0.0::DOUBLE AS forecast FROM tail
             UNION ALL
             SELECT series, h + 1, list_append(ys, f), list_append(ws, v), f FROM
               (SELECT *, ys[len(ys) - 11] + v AS f FROM
                 (SELECT path.*, phi * ws[len(ws)] + seasonal_phi * ws[len(ws) - 11]
                         - phi * seasonal_phi * ws[len(ws) - 12] AS v, {steps} AS steps
                  FROM path JOIN fit USING (series)))
             WHERE h < steps)"""


def kalman(model, forecast=0):
    """Scalar recursion; a two-state model is the three-state one without the third row."""
    dt, q, n = model.dt, model.Q, len(model.x0)
    noise = {(i, j): (float(q[i][j]) if i < n and j < n else 0.0) for i in range(3)
             for j in range(i, 3)}
    start = [float(model.P0[i][i]) if i < n else 0.0 for i in range(3)]
    third = 1 if n == 3 else 0
    return f"""WITH RECURSIVE {DENSE},
    f AS (
      SELECT series, -1::BIGINT AS idx, 0.0::DOUBLE AS predicted, 0.0::DOUBLE AS x0,
             0.0::DOUBLE AS x1, 0.0::DOUBLE AS x2, {start[0]}::DOUBLE AS p00, 0.0::DOUBLE AS p01,
             0.0::DOUBLE AS p02, {start[1]}::DOUBLE AS p11, 0.0::DOUBLE AS p12,
             {start[2]}::DOUBLE AS p22 FROM ends
      UNION ALL
      SELECT series, idx, m0, m0 + a00 / s * (y - m0), m1 + a01 / s * (y - m0),
             m2 + a02 / s * (y - m0), a00 - a00 * a00 / s, a01 - a00 * a01 / s,
             a02 - a00 * a02 / s, a11 - a01 * a01 / s, a12 - a01 * a02 / s, a22 - a02 * a02 / s
      FROM (SELECT *, a00 + {model.R} AS s FROM (
        SELECT d.series, d.idx, d.y, x0 + {dt} * x1 AS m0, x1 + {dt * third} * x2 AS m1, x2 AS m2,
          (p00 + {dt} * p01) + {dt} * (p01 + {dt} * p11) + {noise[0, 0]} AS a00,
          (p01 + {dt} * p11) + {dt * third} * (p02 + {dt} * p12) + {noise[0, 1]} AS a01,
          p02 + {dt} * p12 + {noise[0, 2]} AS a02,
          (p11 + {dt * third} * p12) + {dt * third} * (p12 + {dt * third} * p22)
            + {noise[1, 1]} AS a11,
          p12 + {dt * third} * p22 + {noise[1, 2]} AS a12, p22 + {noise[2, 2]} AS a22
        FROM f JOIN dense d ON d.series = f.series AND d.idx = f.idx + 1)))
    """ + (f"""SELECT series, h, round(x0 + h * {dt} * x1
                 + {third} * h * (h - 1) / 2.0 * {dt * dt} * x2, 6) AS forecast
        FROM (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY series ORDER BY idx DESC) = 1),
             (SELECT unnest(generate_series(1, {forecast}))::BIGINT AS h)""" if forecast else
           """SELECT f.series, f.idx, round(y, 6) AS y, round(predicted, 6) AS predicted
        FROM f JOIN dense USING (series, idx)""")


GARCH_FIT = f"""WITH RECURSIVE {DAILY},
points(alpha, beta) AS (VALUES {", ".join(f"({a}::DOUBLE, {b}::DOUBLE)" for a, b in C.GARCH_POINTS)}),
v AS (SELECT series, alpha, beta, 0::BIGINT AS idx, s2 AS v, 0.0::DOUBLE AS ll FROM level, points
      UNION ALL
      SELECT v.series, alpha, beta, v.idx + 1, s2 * (1 - alpha - beta) + alpha * e * e + beta * v,
             ll - 0.5 * (ln(2 * pi() * v) + e * e / v)
      FROM v JOIN shocks s ON s.series = v.series AND s.idx = v.idx),
done AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY series, alpha, beta
                                                   ORDER BY idx DESC) = 1),
weights AS (SELECT *, exp(ll - max(ll) OVER (PARTITION BY series)) AS wt FROM done),
fits AS (SELECT series, sum(wt * alpha) / sum(wt) AS alpha, sum(wt * beta) / sum(wt) AS beta,
                any_value(s2) AS s2, sum(wt * v) / sum(wt) AS next_variance
         FROM weights JOIN level USING (series) GROUP BY 1)
"""


def acf(lags):
    return f"""WITH {DENSE},
        c AS (SELECT series, idx, y - avg(y) OVER (PARTITION BY series) AS d FROM dense),
        s AS (SELECT series, sum(d * d) AS total FROM c GROUP BY 1)
        SELECT a.series, k AS lag, round(sum(a.d * b.d) / any_value(total), 6) AS r
        FROM c a, (SELECT unnest(generate_series(1, {lags}))::BIGINT AS k) ks
        JOIN c b ON b.series = a.series AND b.idx = a.idx - k
        JOIN s ON s.series = a.series GROUP BY 1, 2"""


def eliminated(size):
    """CTEs `solved` (key, i, v) from `cells` (key, i, j, v), symmetric systems with the right side in
    column `size`, by Gauss-Jordan elimination in order."""
    return f"""
    steps AS (SELECT key, i, j, v, 0 AS k FROM cells
              UNION ALL
              SELECT key, i, j, CASE WHEN i = k THEN v / head ELSE v - factor * across / head END, k + 1 FROM
              (SELECT *, max(CASE WHEN i = k AND j = k THEN v END) OVER (PARTITION BY key) AS head,
                      max(CASE WHEN i = k THEN v END) OVER (PARTITION BY key, j) AS across,
                      max(CASE WHEN j = k THEN v END) OVER (PARTITION BY key, i) AS factor
               FROM steps WHERE k < {size})),
    solved AS (SELECT key, i, v FROM steps WHERE k = {size} AND j = {size})"""


def changes(p):
    """CTE `wide`: z0, the change of y, its lags z1..zp, and a constant, where all exist."""
    lags = ", ".join(f"lag(z0, {k}) OVER o AS z{k}" for k in range(1, p + 1))
    return f"""{DENSE},
    z AS (SELECT series, idx, y, y - lag(y) OVER (PARTITION BY series ORDER BY idx) AS z0 FROM dense),
    wide AS (SELECT series, idx, y, 1.0::DOUBLE AS one, z0, {lags} FROM z
             WINDOW o AS (PARTITION BY series ORDER BY idx) QUALIFY z{p} IS NOT NULL)"""


def ar_forecast(p, steps):
    """Least squares on p lagged changes, carried on step by step."""
    names = ["one"] + [f"z{k}" for k in range(1, p + 1)] + ["z0"]
    cells = " UNION ALL ".join(f"SELECT series AS key, {i} AS i, {j} AS j, sum({names[i]} * {names[j]}) AS v "
                               "FROM wide GROUP BY 1" for i in range(p + 1) for j in range(p + 2))
    return f"""WITH RECURSIVE {changes(p)},
    cells AS ({cells}), {eliminated(p + 1)},
    model AS (SELECT key AS series, list(v ORDER BY i) AS coef FROM solved GROUP BY 1),
    latest AS (SELECT series, y, [z0{''.join(f', z{k}' for k in range(1, p))}] AS past FROM wide
               QUALIFY row_number() OVER (PARTITION BY series ORDER BY idx DESC) = 1),
    path AS (SELECT series, 0::BIGINT AS h, y, past, coef FROM latest JOIN model USING (series)
             UNION ALL
             SELECT series, h + 1, y + move, list_prepend(move, past[1:{p - 1}]), coef FROM
             (SELECT *, coef[1] + list_dot_product(coef[2:], past) AS move FROM path WHERE h < {steps}))
    SELECT series, h, round(y, 6) AS forecast FROM path WHERE h > 0"""


def walk_forward(p):
    """CTEs up to `steps_ahead`: each row predicted by least squares on the strictly earlier rows."""
    names = ["one"] + [f"z{k}" for k in range(1, p + 1)] + ["z0"]
    sums = ", ".join(f"sum({names[i]} * {names[j]}) OVER o AS g_{i}_{j}" for i in range(p + 1) for j in range(i, p + 2))
    cells = " UNION ALL ".join(f"SELECT key, {i} AS i, {j} AS j, g_{min(i, j)}_{max(i, j)} AS v FROM g"
                               for i in range(p + 1) for j in range(p + 2))
    x = " + ".join(f"CASE i WHEN {k} THEN {n} ELSE 0 END" for k, n in enumerate(names[:-1]))
    return f"""WITH RECURSIVE {changes(p)},
    g AS (SELECT series || ':' || idx AS key, {sums} FROM wide
          WINDOW o AS (PARTITION BY series ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
          QUALIFY g_0_0 >= {2 * (p + 1)}),
    cells AS ({cells}), {eliminated(p + 1)},
    steps_ahead AS (SELECT series, idx, any_value(y) AS y, any_value(y - z0) + sum(v * ({x})) AS forecast
                    FROM wide JOIN solved ON key = series || ':' || idx GROUP BY 1, 2)"""


def form(left, right):
    """SQL of left' G right for two vectors {place: SQL} and the sums g00 .. g66."""
    return " + ".join(f"({a}) * ({b}) * g{min(i, j)}{max(i, j)}" for i, a in left.items() for j, b in right.items())


def solved_pair(base, one, two, has_one, has_two):
    """SQL of the coefficients that minimise the sum of squares of base + c1 * one + c2 * two, 0 for one not asked for."""
    a, b, c = form(one, one), form(one, two), form(two, two)
    r, t = f"-({form(one, base)})", f"-({form(two, base)})"
    both = f"(({a}) * ({c}) - ({b}) * ({b}))"
    return (f"CASE WHEN {has_one} = 0 THEN 0 WHEN {has_two} = 0 THEN ({r}) / ({a}) ELSE (({r}) * ({c}) - ({t}) * ({b})) / {both} END",
            f"CASE WHEN {has_two} = 0 THEN 0 WHEN {has_one} = 0 THEN ({t}) / ({c}) ELSE (({t}) * ({a}) - ({r}) * ({b})) / {both} END")


def order_search_ma(rounds=30):
    """The 48 candidates with a moving average: shocks from a long autoregression, then alternation over
    the sums of products of z, its lags 1, 12, 13 and the shocks' lags 1, 12, 13."""
    long, names = 25, ["z", "z1", "zs", "zt", "e1", "es", "et"]
    zs = ", ".join(f"lag(z, {k}) OVER o AS l{k}" for k in range(1, long + 1))
    products = ", ".join(f"sum(z * {'l' + str(k) if k else 'z'}) AS s{k}" for k in range(long + 1))
    cells = " UNION ALL ".join(
        f"SELECT key, {i} AS i, {j} AS j, s{abs(i - j) if j < long else i + 1}{' * (1 + 1e-9)' if i == j else ''} AS v FROM long_sums"
        for i in range(long) for j in range(long + 1))
    shock = " - ".join(["z", *[f"coef[{k}] * l{k}" for k in range(1, long + 1)]])
    sums = ", ".join(f"sum({names[i]} * {names[j]}) AS g{i}{j}" for i in range(7) for j in range(i, 7))
    a, th = solved_pair({0: "1", 2: "-b", 5: "-bt"}, {1: "-1", 3: "b"}, {4: "-1", 6: "-bt"}, "p", "q")
    b, bt = solved_pair({0: "1", 1: "-a", 4: "-th"}, {2: "-1", 3: "a"}, {5: "-1", 6: "-th"}, "sp", "sq")
    last = {0: "1", 1: "-a", 2: "-b", 3: "a * b", 4: "-th", 5: "-bt", 6: "-th * bt"}
    return f"""WITH RECURSIVE {DENSE},
    back AS (SELECT *, lag(y) OVER o AS y1, lag(y, 12) OVER o AS ys, lag(y, 13) OVER o AS yt FROM dense
             WINDOW o AS (PARTITION BY series ORDER BY idx)),
    forms AS (SELECT series, idx, 0 AS d, 0 AS sd, y AS z FROM back
              UNION ALL SELECT series, idx, 1, 0, y - y1 FROM back UNION ALL SELECT series, idx, 0, 1, y - ys FROM back
              UNION ALL SELECT series, idx, 1, 1, y - y1 - ys + yt FROM back),
    lags AS (SELECT *, series || ':' || d || ':' || sd AS key, {zs} FROM forms
             WHERE z IS NOT NULL WINDOW o AS (PARTITION BY series, d, sd ORDER BY idx)),
    long_sums AS (SELECT key, {products} FROM lags GROUP BY 1),
    cells AS ({cells}), {eliminated(long)},
    model AS (SELECT key, list(v ORDER BY i) AS coef FROM solved GROUP BY 1),
    shocks AS (SELECT series, d, sd, idx, z, l1 AS z1, l12 AS zs, l13 AS zt, {shock} AS e FROM lags JOIN model USING (key) WHERE l{long} IS NOT NULL),
    seven AS (SELECT *, lag(e) OVER o AS e1, lag(e, 12) OVER o AS es, lag(e, 13) OVER o AS et FROM shocks
              WINDOW o AS (PARTITION BY series, d, sd ORDER BY idx)),
    g AS (SELECT series, d, sd, count(*) AS n, {sums} FROM seven WHERE idx >= 51 GROUP BY ALL),
    fit AS (SELECT *, 0 AS round, 0.0::DOUBLE AS a, 0.0::DOUBLE AS th, 0.0::DOUBLE AS b, 0.0::DOUBLE AS bt, 0.0::DOUBLE AS moved
            FROM g, (SELECT p, q, sp, sq FROM (VALUES (0), (1)) AS w(p), (VALUES (0), (1)) AS x(q), (VALUES (0), (1)) AS y(sp),
                     (VALUES (0), (1)) AS z(sq) WHERE q + sq > 0)
            UNION ALL
            SELECT * EXCLUDE (pa, pth, pb, pbt) REPLACE (greatest(abs(a - pa), abs(th - pth), abs(b - pb), abs(bt - pbt)) AS moved) FROM
            (SELECT * REPLACE (round + 1 AS round, {b} AS b, {bt} AS bt) FROM
             (SELECT * REPLACE ({a} AS a, {th} AS th), a AS pa, th AS pth, b AS pb, bt AS pbt FROM fit WHERE round < {rounds}))),
    done AS (SELECT *, {form(last, last)} AS css FROM fit WHERE round = {rounds} AND moved < 1e-9)
    SELECT series, p, d, q, sp, sd, sq, n, round(a, 5) AS phi, round(b, 5) AS seasonal_phi, round(th, 5) AS theta,
           round(bt, 5) AS seasonal_theta, round(n * (ln(2 * pi() * css / n) + 1) + 2 * (p + q + sp + sq + 1), 4) AS aic FROM done"""


def order_search_ar(rounds=30):
    """Least squares of the 16 candidates with q = Q = 0, by alternation over sums of lagged products."""
    names = ["z", "z1", "zs", "zt"]
    sums = ", ".join(f"sum({names[i]} * {names[j]}) AS g{i}{j}" for i in range(4) for j in range(i, 4))
    phi = "(g01 - b * (g12 + g03) + b * b * g23) / (g11 - 2 * b * g13 + b * b * g33)"
    big = "(g02 - a * (g12 + g03) + a * a * g13) / (g22 - 2 * a * g23 + a * a * g33)"
    c = ["1", "-a", "-b", "a * b"]
    css = " + ".join(f"({c[i]}) * ({c[j]}) * g{min(i, j)}{max(i, j)}" for i in range(4) for j in range(4))
    return f"""WITH RECURSIVE {DENSE},
    wide AS (SELECT *, lag(y) OVER o AS y1, lag(y, 12) OVER o AS ys, lag(y, 13) OVER o AS yt FROM dense
             WINDOW o AS (PARTITION BY series ORDER BY idx)),
    forms AS (SELECT series, idx, 0 AS d, 0 AS sd, y AS z FROM wide
              UNION ALL SELECT series, idx, 1, 0, y - y1 FROM wide UNION ALL SELECT series, idx, 0, 1, y - ys FROM wide
              UNION ALL SELECT series, idx, 1, 1, y - y1 - ys + yt FROM wide),
    lags AS (SELECT *, lag(z) OVER o AS z1, lag(z, 12) OVER o AS zs, lag(z, 13) OVER o AS zt FROM forms
             WHERE z IS NOT NULL WINDOW o AS (PARTITION BY series, d, sd ORDER BY idx)),
    g AS (SELECT series, d, sd, count(*) AS n, {sums} FROM lags WHERE idx >= 51 GROUP BY ALL),
    fit AS (SELECT *, 0 AS round, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0.0::DOUBLE AS pa,
                   0.0::DOUBLE AS pb FROM g,
                   (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS t(p, sp)
            UNION ALL
            SELECT * REPLACE (round + 1 AS round, CASE WHEN sp = 1 THEN {big} ELSE 0 END AS b) FROM
            (SELECT * REPLACE (CASE WHEN p = 1 THEN {phi} ELSE 0 END AS a, a AS pa, b AS pb) FROM fit WHERE round < {rounds})),
    done AS (SELECT *, {css} AS css FROM fit WHERE round = {rounds})
    SELECT series, p, d, sp, sd, n, round(a, 6) AS phi, round(b, 6) AS seasonal_phi,
           round(n * (ln(2 * pi() * css / n) + 1) + 2 * (p + sp + 1), 6) AS aic,
           CASE WHEN greatest(abs(a - pa), abs(b - pb)) > 1e-6 THEN 'not_converged' ELSE 'ok' END AS status FROM done"""


SQL = {
    "order_search_ar": order_search_ar(),
    "order_search_ma": order_search_ma(),
    "ar10_forecast": ar_forecast(10, C.AR_STEPS),
    "walk_forward_ar5": walk_forward(5) + """
    SELECT series, idx, round(y, 6) AS y, round(forecast, 6) AS forecast FROM steps_ahead""",
    "walk_forward_error": walk_forward(5) + """
    SELECT series, count(*) AS n, round(avg((forecast - y) * (forecast - y)), 6) AS mse FROM steps_ahead GROUP BY 1""",
    "minute_mean": bucket("minute"),
    "hour_mean": bucket("hour"),
    "hour_from_minute": bucket("hour"),
    "null_safe_mean": bucket("hour", where="value <= 200 AND value >= 2"),
    "anomalies": loci(MINUTES, 0.5) + """ SELECT series, "timestamp" AS times, v AS prediction,
        flag AS "isAnomaly" FROM tagged""",
    "anomalies_every_radius": loci(MINUTES, 0.25) + """ SELECT series, "timestamp" AS times,
        v AS prediction, flag AS "isAnomaly" FROM tagged""",
    "anomalous_lengths": LOCI_LENGTHS + """ SELECT doc_id, series, v AS prediction,
        flag AS "isAnomaly" FROM tagged""",
    "sharp_rises": f"""WITH {DENSE} SELECT series, hour, y,
        round(m, 12) AS trailing_mean, round(s, 6) AS trailing_std,
        CAST(y > m + 3 * s AS INTEGER) AS rise FROM
        (SELECT *, avg(y) OVER o AS m, stddev_pop(y) OVER o AS s FROM dense WINDOW o AS
         (PARTITION BY series ORDER BY idx ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))
        WHERE idx >= 24""",
    "range_filter": """SELECT event_id, value AS prediction FROM events
        WHERE value > 20 AND value < 50""",
    "scaled_score": "SELECT doc_id, toxic * 100.0::DOUBLE AS toxicity FROM labels",
    "project_rename": """SELECT event_id, ts AS times, event_type AS topic, value AS prediction,
        TIMESTAMP '2018-04-13 10:31:30' AS collected FROM events""",
    "strict_parse": "SELECT event_id, ts AS times, value AS prediction FROM events",
    "math_functions": """SELECT event_id, round(ln(value + 1), 6) AS ln,
        round(sqrt(value), 6) AS root, abs(value - 50) AS gap, round(sin(value), 6) AS sine,
        round(pow(value, 2), 6) AS square FROM events""",
    "clean_text": f"SELECT doc_id, {CLEAN} AS text FROM documents",
    "normalise_text": f"SELECT doc_id, {NORMAL} AS text FROM documents",
    "tokens": f"""SELECT doc_id, len(w) AS n, array_to_string(w, '|') AS words
        FROM (SELECT doc_id, {split('text')} AS w FROM documents)""",
    "tokens_no_stop": f"""WITH {TERMS} SELECT doc_id, array_to_string(words, '|') AS words
        FROM kept""",
    "tfidf_terms": f"""WITH {TERMS},
        tf AS (SELECT doc_id, term, count(*) AS tf FROM
               (SELECT doc_id, unnest(words) AS term FROM kept) GROUP BY 1, 2),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1)
        SELECT doc_id, term, tf, df,
               round(tf * ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (df + 1)), 6) AS tfidf
        FROM tf JOIN df USING (term)""",
    "synthetic_axis": f'WITH {TIMED} SELECT doc_id, idx, "timestamp" FROM timed',
    "topic_search": found(),
    "topic_search_window": found(f"\"timestamp\" >= TIMESTAMP '{C.SEARCH_SINCE}' "
                                 f"AND \"timestamp\" < TIMESTAMP '{C.SEARCH_UNTIL}'"),
    "topic_sweep": f"""SELECT topic, row_number() OVER (PARTITION BY topic ORDER BY doc_id DESC)
        AS rank, doc_id FROM documents JOIN (VALUES {TOPIC_ROWS}) t(topic)
        ON contains(lower(text), topic) WHERE lang = 'en' QUALIFY rank <= 100""",
    "topic_counts": f"""SELECT topic, count(*) AS n, count(toxic) AS labelled,
        coalesce(sum(toxic), 0)::BIGINT AS toxic FROM documents
        JOIN (VALUES {TOPIC_ROWS}) t(topic) ON contains(lower(text), topic)
        LEFT JOIN labels USING (doc_id) GROUP BY 1""",
    "labelled_messages": "SELECT doc_id, text, quality, toxic FROM documents JOIN labels USING (doc_id)",
    "unlabelled_messages": """SELECT doc_id, text FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "training_rows": f"""SELECT doc_id, {CLEAN} AS text, toxic * 100.0::DOUBLE AS label
        FROM documents JOIN labels USING (doc_id)""",
    "union_by_name": """SELECT doc_id, text, lang FROM documents
        UNION ALL BY NAME SELECT text, role, conv_id FROM conversations""",
    "dedup_messages": "SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text",
    "dedup_turns": "SELECT conv_id, turn, role, text FROM conversations",
    "series_pushdown": f"""SELECT o_orderpriority, o_orderdate, o_totalprice FROM orders
        WHERE o_orderpriority IN {C.PRICE_KEYS}
        AND o_orderdate BETWEEN TIMESTAMP '{C.PRICE_SINCE}' AND TIMESTAMP '{C.PRICE_UNTIL}'""",
    "first_rows": "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 250",
    "shuffled_documents": "SELECT doc_id, text FROM documents",
    "hash_split": f"""SELECT doc_id, CASE WHEN ('0x' || substr(md5('{SPLIT_SEED}:' || doc_id), 1, 8))
        ::BIGINT % 10000 < 7500 THEN 'train' ELSE 'test' END AS part FROM documents""",
    "json_encode": f"""WITH {DATED} SELECT doc_id, CAST(json_object('timestamp',
        strftime("timestamp", '%Y-%m-%d %H:%M:%S'), 'text', text) AS VARCHAR) AS value
        FROM timed""",
    "json_decode": """SELECT event_id, date_trunc('second', ts) AS "timestamp", props AS text
        FROM events""",
    "json_extract": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
        FROM events""",
    "row_positions": """SELECT event_id, event_type AS series,
        row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS in_series,
        row_number() OVER (ORDER BY event_id) - 1 AS overall FROM events""",
    "dense_hours": f"WITH {DENSE} SELECT series, idx, hour, y FROM dense",
    "holdout_split": f"""WITH {SPARSE}, sized AS (SELECT *, count(*) OVER (PARTITION BY series) AS n
        FROM sparse) SELECT series, idx, y,
        CASE WHEN idx >= n - n // 4 THEN 'test' ELSE 'train' END AS part,
        CASE WHEN idx >= n - n // 4 THEN idx - (n - n // 4) + 1 END AS h FROM sized""",
    "forecast_axis": """WITH e AS (SELECT event_type AS series,
        count(DISTINCT date_trunc('hour', ts)) AS n, date_trunc('hour', max(ts)) AS last
        FROM events GROUP BY 1)
        SELECT series, h, last + to_hours(h) AS "timestamp" FROM
        (SELECT series, last, unnest(generate_series(1, n // 4)) AS h FROM e WHERE n // 4 > 1)""",
    "last_values": f"""WITH {SPARSE} SELECT series, count(*) AS n, count(*) // 4 AS horizon,
        max(hour) AS last_hour, arg_max(y, hour) AS last_y FROM sparse GROUP BY 1""",
    "log_returns": f"WITH {DAILY} SELECT series, idx, round(r, 6) AS r FROM returns",
    "aligned_pairs": f"""WITH {DENSE} SELECT series, idx, y, next_day FROM
        (SELECT series, idx, y, lead(y, 24) OVER (PARTITION BY series ORDER BY idx) AS next_day
         FROM dense) WHERE next_day IS NOT NULL""",
    "regression_metrics": PERSIST + """ SELECT series, n, round(m, 6) AS mean_label,
        round(sqrt(e), 6) AS rmse, round(e, 6) AS mse, round(r, 6) AS r,
        round(r * sqrt(n - 2) / sqrt(1 - r * r), 6) AS t FROM
        (SELECT series, count(*) AS n, avg(label) AS m, avg(pow(p - label, 2)) AS e,
                corr(p, label) AS r FROM pairs GROUP BY 1)""",
    # density of Student's t, integrated over |t| in 20,000 midpoint steps
    "significance": PERSIST + """, fits AS (SELECT series, n, r,
        abs(r) * sqrt(n - 2) / sqrt(1 - r * r) AS t FROM
        (SELECT series, count(*) AS n, corr(p, label) AS r FROM pairs GROUP BY 1)),
        steps AS (SELECT (unnest(generate_series(0, 19999)) + 0.5) / 20000 AS u)
        SELECT series, n, round(r, 6) AS r, round(abs(1 - 2 * t / 20000 * sum(
        exp(lgamma((n - 1) / 2.0) - lgamma((n - 2) / 2.0)) / sqrt((n - 2) * pi())
        * pow(1 + u * u * t * t / (n - 2), -(n - 1) / 2.0))), 6) AS p
        FROM fits, steps GROUP BY series, n, r, t""",
    "band_fit": PERSIST + """ SELECT series, count(*) AS n, round(regr_slope(p, label), 6) AS slope,
        round(regr_intercept(p, label), 6) AS intercept, round(corr(p, label), 6) AS r
        FROM pairs WHERE p > 20 AND p < 50 GROUP BY 1""",
    "percentage_error": PERSIST + """ SELECT series,
        round_even(avg(abs((label - p) / nullif(label, 0))) * 100, 2) AS mape,
        count(*) FILTER (label = 0) AS zero_actuals, round(abs(corr(label, p)), 6) AS corr
        FROM pairs GROUP BY 1""",
    "overall_mean": "SELECT count(*) AS n, avg(toxic * 100.0::DOUBLE) AS mean_score FROM labels",
    "lag_correlation": PERSIST + " SELECT series, round(corr(p, label), 6) AS r FROM pairs GROUP BY 1",
    "autocorrelation": acf(C.MAX_LAG),
    "autocorrelation_week": acf(C.WEEK_LAG),
    "autocorrelation_all": f"SELECT series, lag, r + 0.0::DOUBLE AS r FROM ({acf('(SELECT max(idx) FROM dense)')})",
    "seasonal_gram": f"""WITH RECURSIVE {DENSE}, {seasonal('dense')}
        SELECT series, equations + 25 AS n, equations, """ + ", ".join(
            f"round(g{i}{j}, 6) AS g_{i}_{j}" for i in range(4) for j in range(i, 4)) + " FROM g",
    "sarima_fit": f"""WITH RECURSIVE {DENSE}, {seasonal('dense')}
        SELECT series, n, equations, round(phi, 6) AS phi, round(seasonal_phi, 6) AS seasonal_phi,
               round(css, 6) AS css, round(equations * ln(css / equations) + 4, 6) AS aic,
               'ok' AS status FROM fit""",
    "sarima_forecast": f"""WITH RECURSIVE {DENSE}, {seasonal_path('dense', 'n // 4')}
        SELECT series, h::BIGINT AS h, round(forecast, 6) AS forecast FROM path WHERE h > 0""",
    "sarima_forecast_sparse": f"""WITH RECURSIVE {SPARSE}, {seasonal_path('sparse', 'n // 4')}
        SELECT series, h::BIGINT AS h, round(forecast, 6) AS forecast FROM path WHERE h > 0""",
    "stream_forecast": f"""WITH RECURSIVE {SPARSE}, {seasonal_path('sparse', 'n // 4')},
        lasts AS (SELECT series, max(hour) AS last FROM sparse GROUP BY 1)
        SELECT series, last + to_hours(h::BIGINT) AS times, round(forecast, 4) AS prediction
        FROM path JOIN lasts USING (series) WHERE h > 0""",
    # All pairs of a label: labels here are small enough for the query to search them whole.
    "oversampled_vectors": """WITH rows_ AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
        counted AS (SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY id) - 1 AS idx,
                           count(*) OVER (PARTITION BY label) AS n FROM rows_),
        wanted AS (SELECT id, label, ((idx + 1) * (most - n)) // n - (idx * (most - n)) // n AS copies
                   FROM counted, (SELECT max(n) AS most FROM counted)),
        near AS (SELECT a.id, b.id AS other, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.v, b.v), b.id) - 1 AS place,
                        least(5, count(*) OVER (PARTITION BY a.id)) AS known
                 FROM rows_ a JOIN rows_ b ON a.label = b.label AND a.id <> b.id QUALIFY place < 5),
        made AS (SELECT id, label, copy, ('0x' || substr(md5(concat_ws(':', 7, 'pick', id, copy)), 1, 15))::BIGINT AS pick,
                        ('0x' || substr(md5(concat_ws(':', 7, 'weight', id, copy)), 1, 15))::BIGINT / 1152921504606846976.0::DOUBLE AS weight
                 FROM wanted, unnest(range(1, copies + 1)) AS t(copy))
        SELECT made.id, copy, made.label, other AS neighbour, round(weight, 9) AS weight,
               round(list_sum(a.v) + weight * (list_sum(b.v) - list_sum(a.v)), 6) AS total
        FROM made JOIN near ON near.id = made.id AND place = pick % known JOIN rows_ a ON a.id = made.id JOIN rows_ b ON b.id = other""",
    "stream_late_rows": f"""WITH days AS (SELECT *, date_diff('day', (SELECT min(ts) FROM events)::DATE, ts::DATE) // {C.LATE_DAYS}
                 + CASE WHEN event_id % {C.LATE_EVERY} = 0 THEN 1 ELSE 0 END AS part FROM events),
        lasts AS (SELECT part, max(max(ts)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest
                  FROM days GROUP BY 1),
        judged AS (SELECT days.*, coalesce(ts < latest - INTERVAL {C.LATE_DELAY_DAYS} DAY, FALSE) AS late FROM days JOIN lasts USING (part))
        SELECT event_type AS series, date_trunc('hour', ts) AS times, {mean()} AS prediction, count(*) AS n
        FROM judged WHERE NOT late GROUP BY 1, 2
        UNION ALL SELECT event_type, NULL, NULL, count(*) FROM judged WHERE late GROUP BY 1""",
    "stream_minutes": f"""SELECT event_type AS series, date_trunc('minute', ts) AS times, {mean()} AS prediction
        FROM events GROUP BY 1, 2""",
    "sarima_holdout": f"""WITH RECURSIVE {DENSE},
        parted AS (SELECT *, idx - (n - n // 4) + 1 AS h FROM
                   (SELECT *, count(*) OVER (PARTITION BY series) AS n FROM dense)),
        train AS (SELECT series, idx, y FROM parted WHERE h < 1),
        {seasonal_path('train', '(n + 2) // 3')}
        SELECT series, count(*) AS n_test, round(abs(corr(y, forecast)), 6) AS corr,
               round_even(avg(abs((y - forecast) / nullif(y, 0))) * 100, 2) AS mape,
               count(*) FILTER (y = 0) AS zero_actuals
        FROM parted JOIN path USING (series, h) WHERE h > 0 GROUP BY 1""",
    "ar1_fit": f"""WITH {DENSE}, pairs AS (SELECT series, y, lag(y) OVER
        (PARTITION BY series ORDER BY idx) AS p FROM dense QUALIFY p IS NOT NULL)
        SELECT series, equations, round(c, 6) AS const, round(phi, 6) AS phi, round(css, 4) AS css,
               round(equations * ln(css / equations) + 6, 6) AS aic FROM
        (SELECT series, count(*) AS equations, regr_intercept(y, p) AS c, regr_slope(y, p) AS phi,
                regr_syy(y, p) * (1 - regr_r2(y, p)) AS css FROM pairs GROUP BY 1)""",
    "walk_forward_ar1": f"""WITH {DENSE},
        z AS (SELECT series, idx, y, lag(y) OVER o AS y1, y - lag(y) OVER o AS z0
              FROM dense WINDOW o AS (PARTITION BY series ORDER BY idx)),
        zz AS (SELECT *, lag(z0) OVER (PARTITION BY series ORDER BY idx) AS z1 FROM z),
        fits AS (SELECT series, idx, y, y1, z1, count(*) OVER o AS n, regr_slope(z0, z1) OVER o AS b,
                        regr_intercept(z0, z1) OVER o AS c, avg(z0) OVER o AS m0,
                        avg(z1) OVER o AS m1 FROM zz WHERE z1 IS NOT NULL WINDOW o AS
                 (PARTITION BY series ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT series, idx, round(y, 6) AS y, round(y1 + coalesce(c + b * z1,
               m0 * (1 + m1 * z1) / (1 + m1 * m1)), 6) AS forecast FROM fits
        WHERE n >= 4""",
    "best_lag": f"""WITH {DENSE},
        pairs AS (SELECT a.series, k AS lag, a.y, b.y AS p
                  FROM dense a, (SELECT unnest(generate_series(1, {C.MAX_LAG}))::BIGINT AS k) ks
                  JOIN dense b ON b.series = a.series AND b.idx = a.idx - k),
        fits AS (SELECT series, lag, count(*) AS n, regr_slope(y, p) AS slope,
                        regr_syy(y, p) * (1 - regr_r2(y, p)) AS css FROM pairs GROUP BY 1, 2)
        SELECT series, lag, n, round(slope, 6) AS slope, round(aic, 6) AS aic FROM
        (SELECT *, n * ln(css / n) + 6 AS aic FROM fits) WHERE aic > 0
        QUALIFY row_number() OVER (PARTITION BY series ORDER BY aic) = 1""",
    "kalman_velocity": kalman(velocity_model()),
    "kalman_velocity_forecast": kalman(velocity_model(), forecast=C.VELOCITY_STEPS),
    "kalman_acceleration": kalman(acceleration_model()),
    "kalman_acceleration_forecast": kalman(acceleration_model(), forecast=C.KALMAN_STEPS),
    "garch_path": f"""WITH RECURSIVE {DAILY},
        v AS (SELECT series, 0::BIGINT AS idx, s2 AS v FROM level UNION ALL
              SELECT v.series, v.idx + 1, s2 * {1 - C.GARCH_ALPHA - C.GARCH_BETA}
                     + {C.GARCH_ALPHA} * e * e + {C.GARCH_BETA} * v
              FROM v JOIN shocks s ON s.series = v.series AND s.idx = v.idx)
        SELECT series, idx, round(e, 6) AS e, round(v, 6) AS variance
        FROM v JOIN shocks USING (series, idx)""",
    "garch_fit": GARCH_FIT + """SELECT series, round(alpha, 6) AS alpha, round(beta, 6) AS beta,
        round(s2, 6) AS s2, round(next_variance, 6) AS next_variance FROM fits""",
    "garch_forecast": GARCH_FIT + f"""SELECT series, h, round(s2 + pow(alpha + beta, h - 1)
        * (next_variance - s2), 6) AS variance FROM fits,
        (SELECT unnest(generate_series(1, {C.GARCH_STEPS}))::BIGINT AS h)""",
    "legacy_csv": r"SELECT doc_id::VARCHAR AS doc_id, regexp_replace(text, '[^\x{00}-\x{FF}]', '?', 'g') AS text FROM documents",
    "csv_round_trip": f"""WITH {DATED} SELECT strftime("timestamp", '%Y-%m-%d %H:%M:%S')
        AS "timestamp", text FROM timed""",
    "batch_table": f"""SELECT event_id, ts AS "timestamp", event_type AS series,
        value AS prediction, (ts >= TIMESTAMP '{C.BATCH_EDGE}')::BIGINT AS batch_id FROM events""",
    "csv_corpus": f"""WITH {DATED} SELECT strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp",
        text, CAST(toxic AS VARCHAR) AS toxicity FROM timed JOIN labels USING (doc_id)""",
    "surrogate_ids": "SELECT count(*) AS n, count(*) AS ids FROM events",
    "random_parts": "SELECT doc_id FROM documents",
    "differences": f"""WITH {DENSE} SELECT series, idx, y - lag(y) OVER o AS by_1,
        y - lag(y, 12) OVER o AS by_12 FROM dense WINDOW o AS (PARTITION BY series ORDER BY idx)""",
    "hashed_counts": f"""WITH {TERMS} SELECT doc_id, len(words)::DOUBLE AS total FROM kept""",
    "series_file": f"""WITH {SPARSE} SELECT series, idx, y FROM sparse""",
    "stream_hour_mean": bucket("hour"),
    "stream_dedup_hour_mean": bucket("hour"),
    "stream_messages": f'WITH {DATED} SELECT "timestamp", text FROM timed',
    "stream_kalman": kalman(velocity_model()),
}
