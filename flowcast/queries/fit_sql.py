"""SQL equivalents of the linear models: least squares by elimination, then recursion.

Each function returns common table expressions whose last one, ``{p}out``, has
(event_type, ts_hour, predicted). ``source`` names a gap-free (ts_hour, event_type, n)
relation; ``p`` prefixes the names so that several models fit in one statement.
"""

HORIZON = 168


def _eliminate(p, system):
    """Solve ``system`` = (key columns, relation with matrix ``m``): Gauss-Jordan."""
    keys, relation = system
    return f"""
{p}e AS (SELECT {keys}, 1 AS k, m FROM {relation} UNION ALL
  SELECT {keys}, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k
    THEN list_transform(r, lambda x: x / m[k][k])
    ELSE list_transform(r, lambda x, c: x - r[k] * m[k][c] / m[k][k]) END)
  FROM {p}e WHERE k <= len(m)),
{p}b AS (SELECT {keys}, list_transform(m, lambda r: r[-1]) AS b FROM {p}e WHERE k = len(m) + 1)"""


def _gram(p, relation, width):
    return f"""
{p}s AS (SELECT event_type, i, j, sum(x[i] * x[j]) AS s FROM {relation},
  range(1, {width + 1}) AS a(i), range(1, {width + 1}) AS b(j) GROUP BY ALL),
{p}r AS (SELECT event_type, i, list(s ORDER BY j) AS r FROM {p}s GROUP BY ALL),
{p}g AS (SELECT event_type, list(r ORDER BY i) AS g FROM {p}r GROUP BY ALL)"""


def _terms(ts, trend):
    hour = f"hour({ts})"
    week_hour = f"((isodow({ts}) - 1) * 24 + hour({ts}))"
    terms = ["1.0", trend]
    for period, place, count in ((24, hour, 4), (168, week_hour, 3)):
        for k in range(1, count + 1):
            terms += [f"{f}({place} * 2 * pi() * {k} / {period})" for f in ("sin", "cos")]
    return terms


def fourier(source, p="f_"):
    train = _terms("ts_hour", f"t / greatest(m - 1, 1)")
    ahead = _terms("ts_hour", f"(m - 1 + h) / greatest(m - 1, 1)")
    width = len(train) + 1
    return f"""
{p}t AS (SELECT event_type, ts_hour, CAST(n AS DOUBLE) AS y,
  row_number() OVER (PARTITION BY event_type ORDER BY ts_hour) - 1 AS t,
  count(*) OVER (PARTITION BY event_type) AS m FROM {source}),
{p}x AS (SELECT event_type, [{', '.join(train)}, y] AS x FROM {p}t),{_gram(p, p + 'x', width)},
{p}a AS (SELECT event_type, g[1:{width - 1}] AS m FROM {p}g),{_eliminate(p, ('event_type', p + 'a'))},
{p}n AS (SELECT event_type, max(ts_hour) AS last, any_value(m) AS m FROM {p}t GROUP BY 1),
{p}h AS (SELECT event_type, m, h, last + to_hours(h) AS ts_hour FROM {p}n, range(1, {HORIZON + 1}) AS a(h)),
{p}out AS (SELECT event_type, ts_hour,
  greatest(list_sum(list_transform(list_zip(b, [{', '.join(ahead)}]), lambda z: z[1] * z[2])), 0.0) AS predicted
  FROM {p}h JOIN {p}b USING (event_type))"""


def autoregression(source, seasonal=(), p="a_"):
    lags = [1, 2, 3, 4, 5, *seasonal]
    deepest = max(lags) + 1 + (24 if seasonal else 0)
    forms = [(d, s) for s in ((0, 1) if seasonal else (0,)) for d in (0, 1)]
    width = len(lags) + 2

    def z(j):
        return (f"(l[{j + 1}] - d * l[{j + 2}] - CASE WHEN sd = 1 THEN l[{j + 25}] - d * l[{j + 26}] ELSE 0 END)")

    sets = [list(range(1, q + 2)) + [6 + i for i in range(1, n + 1)]
            for n in range(len(seasonal) + 1) for q in range(1, 6)]
    step = ("(acc[l] - d * acc[l + 1] - CASE WHEN sd = 1 THEN acc[l + 24] - d * acc[l + 25] ELSE 0 END)")
    return f"""
{p}f(d, sd, pos) AS (VALUES {', '.join(f'({d}, {s}, {i})' for i, (d, s) in enumerate(forms))}),
{p}l AS (SELECT event_type, ts_hour,
  [{', '.join(f'CAST(lag(n, {k}) OVER w AS DOUBLE)' for k in range(deepest + 1))}] AS l
  FROM {source} WINDOW w AS (PARTITION BY event_type ORDER BY ts_hour)),
{p}k AS (SELECT * FROM {p}l WHERE l[{deepest + 1}] IS NOT NULL),
{p}v AS (SELECT event_type, d, sd, pos, var_pop({z(0)}) AS v FROM {p}k, {p}f GROUP BY ALL),
{p}c AS (SELECT event_type, arg_min(d, (v, pos)) AS d, arg_min(sd, (v, pos)) AS sd FROM {p}v GROUP BY 1),
{p}x AS (SELECT event_type, [1.0, {', '.join(z(j) for j in lags)}, {z(0)}] AS x
  FROM {p}k JOIN {p}c USING (event_type)),{_gram(p, p + 'x', width)},
{p}i(id, idx) AS (VALUES {', '.join(f'({i}, {s})' for i, s in enumerate(sets))}),
{p}a AS (SELECT event_type, id, list_transform(idx, lambda i:
  list_append(list_transform(idx, lambda j: g[i][j]), g[i][{width}])) AS m FROM {p}g, {p}i),
{_eliminate(p, ('event_type, id', p + 'a'))},
{p}q AS (SELECT event_type, id, idx, b, g[1][1] AS n,
  g[{width}][{width}] - list_sum(list_transform(idx, lambda i, o: b[o] * g[i][{width}])) AS rss
  FROM {p}b JOIN {p}i USING (id) JOIN {p}g USING (event_type)),
{p}best AS (SELECT event_type, arg_min(idx, (n * ln(rss / n) + 2 * (len(idx) + 1), id)) AS idx,
  arg_min(b, (n * ln(rss / n) + 2 * (len(idx) + 1), id)) AS b FROM {p}q GROUP BY 1),
{p}w AS (SELECT event_type, d, sd, b[1] AS c, list_transform(idx[2:], lambda i: {lags}[i - 1]) AS used, b[2:] AS phi
  FROM {p}best JOIN {p}c USING (event_type)),
{p}y AS (SELECT event_type, max(ts_hour) AS last,
  list(CAST(n AS DOUBLE) ORDER BY ts_hour DESC)[1:{deepest}] AS acc FROM {source} GROUP BY 1),
{p}z AS (SELECT event_type, 0 AS h, acc FROM {p}y UNION ALL
  SELECT event_type, h + 1, list_prepend(
    c + list_sum(list_transform(used, lambda l, o: phi[o] * {step})) + d * acc[1]
      + CASE WHEN sd = 1 THEN acc[24] - d * acc[25] ELSE 0 END, acc)
  FROM {p}z JOIN {p}w USING (event_type) WHERE h < {HORIZON}),
{p}out AS (SELECT event_type, last + to_hours(h) AS ts_hour, greatest(acc[1], 0.0) AS predicted
  FROM (SELECT event_type, h, acc FROM {p}z) JOIN (SELECT event_type, last FROM {p}y) USING (event_type) WHERE h > 0)"""


def arma(source, p=2, q=2, long=12, name="h_"):
    """Two least squares passes, the second with the lags of the first one's residuals."""
    lags = ", ".join(f"lag(y, {k}) OVER w" for k in range(1, long + 1))
    terms = ", ".join([f"y{k}" for k in range(1, p + 1)] + [f"e{j}" for j in range(1, q + 1)])
    back = ", ".join([f"lag(y, {k}) OVER w AS y{k}" for k in range(1, p + 1)] + [f"lag(e, {j}) OVER w AS e{j}" for j in range(1, q + 1)])
    series = "WINDOW w AS (PARTITION BY event_type ORDER BY ts_hour)"
    return f"""
{name}y AS (SELECT event_type, ts_hour, CAST(n AS DOUBLE) AS y FROM {source}),
{name}0 AS (SELECT event_type, ts_hour, y, [1.0, {lags}, y] AS x FROM {name}y {series}),
{name}1 AS (SELECT * FROM {name}0 WHERE x[{long + 1}] IS NOT NULL),{_gram(name + 'a', name + '1', long + 2)},
{name}m AS (SELECT event_type, g[1:{long + 1}] AS m FROM {name}ag),{_eliminate(name + 'a', ('event_type', name + 'm'))},
{name}2 AS (SELECT z.event_type, z.ts_hour, z.y, CASE WHEN x[{long + 1}] IS NOT NULL
  THEN z.y - list_sum(list_transform(b, lambda v, i: v * x[i])) END AS e FROM {name}0 z JOIN {name}ab USING (event_type)),
{name}3 AS (SELECT *, {back} FROM {name}2 {series}),
{name}4 AS (SELECT event_type, [1.0, {terms}, y] AS x FROM {name}3 WHERE e{q} IS NOT NULL),{_gram(name + 'b', name + '4', p + q + 2)},
{name}n AS (SELECT event_type, g[1:{p + q + 1}] AS m FROM {name}bg),{_eliminate(name + 'b', ('event_type', name + 'n'))},
{name}l AS (SELECT event_type, max(ts_hour) AS last, list(y ORDER BY ts_hour DESC)[1:{p}] AS ys,
  list(e ORDER BY ts_hour DESC)[1:{q}] AS es FROM {name}2 GROUP BY 1),
{name}r AS (SELECT event_type, 0 AS h, ys, es FROM {name}l UNION ALL
  SELECT event_type, h + 1, list_prepend(b[1] + list_sum(list_transform(b[2:{p + 1}], lambda v, i: v * ys[i]))
    + list_sum(list_transform(b[{p + 2}:], lambda v, i: v * es[i])), ys)[1:{p}], list_prepend(0.0::DOUBLE, es)[1:{q}]
  FROM {name}r JOIN {name}bb USING (event_type) WHERE h < {HORIZON}),
{name}out AS (SELECT event_type, last + to_hours(h) AS ts_hour, greatest(ys[1], 0.0) AS predicted
  FROM (SELECT event_type, h, ys FROM {name}r) JOIN (SELECT event_type, last FROM {name}l) USING (event_type) WHERE h > 0)"""


def kpss(source, z, name, most=12):
    lags = ", ".join(f"lag(d, {j}) OVER w AS d{j}" for j in range(1, most + 1))
    sums = " + ".join(f"CASE WHEN l >= {j} THEN 2 * (1 - {j} / (l + 1)) * coalesce(sum(d * d{j}), 0) ELSE 0 END" for j in range(1, most + 1))
    return f"""
{name}d AS (SELECT event_type, ts_hour, {z} - avg({z}) OVER (PARTITION BY event_type) AS d,
  least({most}, floor(4 * pow(count(*) OVER (PARTITION BY event_type) / 100, 0.25))) AS l FROM {source} WHERE {z} IS NOT NULL),
{name}w AS (SELECT event_type, l, d, sum(d) OVER w AS s, {lags} FROM {name}d WINDOW w AS (PARTITION BY event_type ORDER BY ts_hour)),
{name}out AS (SELECT event_type, sum(s * s) / (count(*) * (sum(d * d) + {sums})) AS kpss FROM {name}w GROUP BY event_type, l)"""


def difference_orders(source, season=24):
    half = season // 2
    return f"""
o_y AS (SELECT event_type, ts_hour, CAST(n AS DOUBLE) AS y FROM {source}),
o_t AS (SELECT event_type, row_number() OVER w - 1 AS i, y - CASE WHEN count(y) OVER f = {season + 1}
  THEN (sum(y) OVER k + (lag(y, {half}) OVER w + lead(y, {half}) OVER w) / 2) / {season} END AS r FROM o_y
  WINDOW w AS (PARTITION BY event_type ORDER BY ts_hour),
  f AS (PARTITION BY event_type ORDER BY ts_hour ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING),
  k AS (PARTITION BY event_type ORDER BY ts_hour ROWS BETWEEN {half - 1} PRECEDING AND {half - 1} FOLLOWING)),
o_r AS (SELECT event_type, r, r - avg(r) OVER (PARTITION BY event_type, i % {season}) AS e FROM o_t WHERE r IS NOT NULL),
o_s AS (SELECT event_type, greatest(0.0, 1 - var_pop(e) / var_pop(r)) AS strength FROM o_r GROUP BY 1),
o_z AS (SELECT event_type, ts_hour, y - CASE WHEN strength > 0.64 THEN lag(y, {season}) OVER w ELSE 0 END AS z0
  FROM o_y JOIN o_s USING (event_type) WINDOW w AS (PARTITION BY event_type ORDER BY ts_hour)),
o_zz AS (SELECT *, z0 - lag(z0) OVER (PARTITION BY event_type ORDER BY ts_hour) AS z1 FROM o_z),{kpss('o_zz', 'z0', 'o_a')},{kpss('o_zz', 'z1', 'o_b')},
o_out AS (SELECT event_type, n, strength, CAST(strength > 0.64 AS INTEGER) AS seasonal_d, a.kpss AS kpss_0, b.kpss AS kpss_1,
  CASE WHEN a.kpss <= 0.463 THEN 0 WHEN b.kpss <= 0.463 THEN 1 ELSE 2 END AS d
  FROM (SELECT event_type, count(*) AS n FROM o_y GROUP BY 1) JOIN o_s USING (event_type)
  JOIN o_aout a USING (event_type) JOIN o_bout b USING (event_type))"""


def changepoints(source, count=10, penalty=0.001, sweeps=100, name="c_"):
    at = [0.8 * j / (count + 1) for j in range(1, count + 1)]
    train = ", ".join(f"greatest(t - {c!r}, 0.0)" for c in at)
    p = count + 2
    return f"""
{name}n AS (SELECT event_type, ts_hour, CAST(n AS DOUBLE) AS y, count(*) OVER (PARTITION BY event_type) AS m,
  row_number() OVER (PARTITION BY event_type ORDER BY ts_hour) - 1 AS i FROM {source}),
{name}t AS (SELECT *, i / greatest(m - 1, 1) AS t FROM {name}n),
{name}x AS (SELECT event_type, [1.0, t, {train}, y] AS x FROM {name}t),{_gram(name, name + 'x', p + 1)},
{name}d AS (SELECT event_type, 0 AS k, list_transform(range({p}), lambda i: 0.0::DOUBLE) AS b FROM {name}g UNION ALL
  SELECT event_type, k + 1, list_transform(b, lambda v, i: CASE WHEN i <> k % {p} + 1 THEN v ELSE (
    CASE WHEN i <= 2 THEN pull ELSE sign(pull) * greatest(abs(pull) - {penalty!r} * g[1][1], 0) END) / g[i][i] END)
  FROM (SELECT event_type, k, b, g, g[k % {p} + 1][{p + 1}] - list_sum(list_transform(b, lambda v, i: v * g[k % {p} + 1][i]))
    + g[k % {p} + 1][k % {p} + 1] * b[k % {p} + 1] AS pull FROM {name}d JOIN {name}g USING (event_type)) WHERE k < {p * sweeps}),
{name}l AS (SELECT event_type, max(ts_hour) AS last, any_value(m) AS m FROM {name}t GROUP BY 1),
{name}h AS (SELECT event_type, last + to_hours(h) AS ts_hour, (m - 1 + h) / greatest(m - 1, 1) AS t FROM {name}l, range(1, {HORIZON + 1}) AS a(h)),
{name}out AS (SELECT event_type, ts_hour, greatest(list_sum(list_transform(list_zip(b, [1.0, t, {train}]), lambda z: z[1] * z[2])), 0.0) AS predicted
  FROM {name}h JOIN (SELECT event_type, b FROM {name}d WHERE k = {p * sweeps}) USING (event_type))"""


def interval_widths(seasonal=(), p="a_", quantile=1.959963984540054):
    """After ``autoregression``: half widths of the intervals by the psi weights of the chosen lags."""
    deepest = max([5, *seasonal]) + 1 + (24 if seasonal else 0)
    step = "(acc[l] - d * acc[l + 1] - CASE WHEN sd = 1 THEN acc[l + 24] - d * acc[l + 25] ELSE 0 END)"
    return f"""
{p}sg AS (SELECT event_type, arg_min(rss / n, (n * ln(rss / n) + 2 * (len(idx) + 1), id)) AS s2 FROM {p}q GROUP BY 1),
{p}ps AS (SELECT event_type, 0 AS h, 1.0::DOUBLE AS total,
  list_prepend(1.0::DOUBLE, list_transform(range({deepest} - 1), lambda i: 0.0::DOUBLE)) AS acc FROM {p}w UNION ALL
  SELECT event_type, h + 1, total + psi * psi, list_prepend(psi, acc) FROM (SELECT event_type, h, total, acc,
    list_sum(list_transform(used, lambda l, o: phi[o] * {step})) + d * acc[1] + CASE WHEN sd = 1 THEN acc[24] - d * acc[25] ELSE 0 END AS psi
  FROM {p}ps JOIN {p}w USING (event_type)) WHERE h < {HORIZON - 1}),
{p}width AS (SELECT event_type, h + 1 AS h, {quantile!r} * sqrt(s2 * total) AS wide FROM {p}ps JOIN {p}sg USING (event_type))"""
