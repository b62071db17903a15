"""SQL for checks: the feature families over the relations masks and objects, each as one SELECT, and the standard profile."""

from __future__ import annotations

import math

KEYS = "position, tile, tp, label"
PAIRS = f"SELECT {KEYS}, y, x, max(v) FILTER (c = 0) AS v0, max(v) FILTER (c = 1) AS v1 FROM objects GROUP BY {KEYS}, y, x"
UNSIGNED = f"SELECT {KEYS}, y, x, abs(v0) AS v0, abs(v1) AS v1 FROM ({PAIRS})"
STEPS = "(VALUES (-1, 0), (1, 0), (0, -1), (0, 1)) s(dy, dx)"
#: Pixels with the number of their edges that are the object's.
RIM = f"""SELECT {KEYS}, y, x, sum(edge) AS edges FROM (SELECT m.*, (n.label IS NULL)::INT AS edge FROM (SELECT * FROM masks, {STEPS}) m LEFT JOIN masks n ON n.position = m.position AND n.tile = m.tile AND n.tp = m.tp AND n.label = m.label AND n.y = m.y + m.dy AND n.x = m.x + m.dx) GROUP BY ALL"""

SIZESHAPE = f"""SELECT {KEYS}, area, min_y, max_y, min_x, max_x, perimeter, area / ((max_y - min_y + 1) * (max_x - min_x + 1)) AS extent, sqrt(4 * area / pi()) AS equivalent_diameter,
 4 * sqrt(m + q) AS major_axis, 4 * sqrt(greatest(m - q, 0)) AS minor_axis, sqrt(1 - greatest(m - q, 0) / (m + q)) AS eccentricity FROM
 (SELECT *, (yy + xx) / 2 AS m, sqrt(pow(yy - xx, 2) / 4 + xy * xy) AS q FROM (SELECT {KEYS}, CAST(count(*) AS BIGINT) AS area, min(y) AS min_y, max(y) AS max_y, min(x) AS min_x, max(x) AS max_x,
  var_pop(y) + 1 / 12 AS yy, var_pop(x) + 1 / 12 AS xx, covar_pop(y, x) AS xy, CAST(sum(edges) AS BIGINT) AS perimeter FROM ({RIM}) GROUP BY {KEYS}))"""

INTENSITY = f"""SELECT * FROM (SELECT {KEYS}, c, sum(v) AS integrated, avg(v) AS mean, stddev_pop(v) AS std, min(v) AS min, max(v) AS max, quantile_cont(v, 0.25) AS lower_quartile, median(v) AS median,
 quantile_cont(v, 0.75) AS upper_quartile, sqrt(pow(sum(x * v) / nullif(sum(v), 0) - avg(x), 2) + pow(sum(y * v) / nullif(sum(v), 0) - avg(y), 2)) AS mass_displacement, mad(v) AS mad FROM objects GROUP BY {KEYS}, c)
 LEFT JOIN (SELECT {KEYS}, c, sum(v) AS integrated_edge, avg(v) AS mean_edge, stddev_pop(v) AS std_edge FROM objects JOIN (SELECT {KEYS}, y, x FROM ({RIM}) WHERE edges > 0) USING ({KEYS}, y, x) GROUP BY {KEYS}, c) USING ({KEYS}, c)"""

#: The smallest width lies along an edge of the hull; lines through other pairs of pixels are no narrower.
FERET = f"""WITH p AS (SELECT {KEYS}, y, x FROM masks),
 far AS (SELECT {KEYS}, sqrt(max((a.y - b.y) * (a.y - b.y) + (a.x - b.x) * (a.x - b.x))) AS feret_max FROM p a JOIN p b USING ({KEYS}) GROUP BY ALL),
 ways AS (SELECT DISTINCT {KEYS}, b.x - a.x AS ny, a.y - b.y AS nx FROM p a JOIN p b USING ({KEYS}) WHERE (a.y, a.x) < (b.y, b.x)),
 width AS (SELECT {KEYS}, ny, nx, (max(y * ny + x * nx) - min(y * ny + x * nx)) / sqrt(ny * ny + nx * nx) AS w FROM ways JOIN p USING ({KEYS}) GROUP BY {KEYS}, ny, nx)
 SELECT {KEYS}, feret_max, coalesce(feret_min, 0) AS feret_min FROM far LEFT JOIN (SELECT {KEYS}, min(w) AS feret_min FROM width GROUP BY ALL) USING ({KEYS})"""

_WAYS = ((0, 1), (1, 0), (1, 1), (1, -1))
_TEXTURE = (("contrast", "(g - g2) * (g - g2) * p"), ("energy", "p * p"), ("homogeneity", "p / (1 + (g - g2) * (g - g2))"), ("entropy", "-p * log2(p)"))
TEXTURE = f"""WITH grey AS (SELECT {KEYS}, c, y, x, CAST(least(7, floor(coalesce((v - min(v) OVER w) / nullif(max(v) OVER w - min(v) OVER w, 0), 0) * 8)) AS INT) AS g FROM objects WINDOW w AS (PARTITION BY {KEYS}, c)),
 pairs AS (SELECT {KEYS}, c, way, a.g, b.g AS g2, count(*) AS n FROM grey a JOIN grey b USING ({KEYS}, c), (VALUES {', '.join(f'({k}, {dy}, {dx})' for k, (dy, dx) in enumerate(_WAYS))}) s(way, dy, dx)
  WHERE b.y = a.y + dy AND b.x = a.x + dx GROUP BY ALL),
 p AS (SELECT *, n / sum(n) OVER (PARTITION BY {KEYS}, c, way) AS p FROM pairs)
 SELECT {KEYS}, c, {', '.join(f'sum({e}) FILTER (way = {k}) AS {n}_{k}' for k in range(4) for n, e in _TEXTURE)} FROM p GROUP BY {KEYS}, c"""

RADIAL = f"""WITH o AS (SELECT *, y - avg(y) OVER w AS dy, x - avg(x) OVER w AS dx FROM objects WINDOW w AS (PARTITION BY {KEYS}, c)),
 r AS (SELECT *, sqrt(dy * dy + dx * dx) AS r FROM o),
 placed AS (SELECT *, CAST(least(3, floor(coalesce(r / nullif(max(r) OVER (PARTITION BY {KEYS}, c), 0), 0) * 4)) AS INT) AS ring,
  (dy > 0)::INT + 2 * (dx > 0)::INT + 4 * (abs(dx) > abs(dy))::INT AS wedge FROM r),
 wedges AS (SELECT {KEYS}, c, ring, wedge, sum(v) AS s, count(*) AS n, avg(v) AS m FROM placed GROUP BY ALL),
 rings AS (SELECT {KEYS}, c, ring, sum(s) AS s, sum(n) AS n, stddev_pop(m) / nullif(avg(m), 0) AS radial_cv FROM wedges GROUP BY {KEYS}, c, ring),
 shares AS (SELECT *, s / nullif(sum(s) OVER w, 0) AS frac_at_d, n / sum(n) OVER w AS part FROM rings WINDOW w AS (PARTITION BY {KEYS}, c))
 SELECT {KEYS}, c, ring, frac_at_d, frac_at_d / part AS mean_frac, radial_cv FROM shares"""
RADIAL_WIDE = f"SELECT {KEYS}, c, {', '.join(f'max({n}) FILTER (ring = {k}) AS {n}_{k}' for k in range(4) for n in ('frac_at_d', 'mean_frac', 'radial_cv'))} FROM ({RADIAL}) GROUP BY {KEYS}, c"

MOMENTS = [(n, m) for n in range(10) for m in range(n % 2, n + 1, 2)]


def zernike(weight: str, source: str = "SELECT * FROM objects") -> str:
    """Magnitudes of the moments, from the definition of the radial polynomials."""
    f = math.factorial
    columns = []
    for n, m in MOMENTS:
        radial = " + ".join(f"({(-1) ** s * f(n - s) / (f(s) * f((n + m) // 2 - s) * f((n - m) // 2 - s))!r}) * pow(r, {n - 2 * s})" for s in range((n - m) // 2 + 1))
        real, other = (f"sum(({radial}) * {t}({m} * a) * k)" for t in ("cos", "sin"))
        columns.append(f"{n + 1} / pi() * sqrt(pow({real}, 2) + pow({other}, 2)) / nullif(sum(k), 0) AS zernike_{n}_{m}")
    return f"""WITH o AS (SELECT *, {weight} AS k, y - avg(y) OVER w AS dy, x - avg(x) OVER w AS dx FROM ({source}) WINDOW w AS (PARTITION BY {KEYS}, c)),
 d AS (SELECT *, coalesce(sqrt(dy * dy + dx * dx) / nullif(max(sqrt(dy * dy + dx * dx)) OVER (PARTITION BY {KEYS}, c), 0), 0) AS r, atan2(dy, dx) AS a FROM o)
 SELECT {KEYS}, c, {', '.join(columns)} FROM d GROUP BY {KEYS}, c"""


ZERNIKE = zernike("1.0", "SELECT *, 0 AS c FROM masks")
RADIAL_ZERNIKES = zernike("v")

PEARSON = f"SELECT {KEYS}, CASE WHEN isnan(corr(v0, v1)) THEN NULL ELSE corr(v0, v1) END AS pearson, regr_slope(v1, v0) AS slope FROM ({PAIRS}) GROUP BY ALL"
MANDERS = f"""SELECT {KEYS}, sum(CASE WHEN v1 >= t1 THEN v0 ELSE 0 END) / nullif(sum(v0), 0) AS manders_1, sum(CASE WHEN v0 >= t0 THEN v1 ELSE 0 END) / nullif(sum(v1), 0) AS manders_2 FROM
 (SELECT *, 0.15 * max(v0) OVER (PARTITION BY {KEYS}) AS t0, 0.15 * max(v1) OVER (PARTITION BY {KEYS}) AS t1 FROM ({UNSIGNED})) WHERE v0 >= t0 OR v1 >= t1 GROUP BY {KEYS}"""
RWC = f"""WITH r AS (SELECT *, dense_rank() OVER (PARTITION BY {KEYS} ORDER BY v0) AS r0, dense_rank() OVER (PARTITION BY {KEYS} ORDER BY v1) AS r1,
  0.15 * max(v0) OVER (PARTITION BY {KEYS}) AS t0, 0.15 * max(v1) OVER (PARTITION BY {KEYS}) AS t1 FROM ({UNSIGNED})),
 n AS (SELECT *, greatest(max(r0) OVER (PARTITION BY {KEYS}), max(r1) OVER (PARTITION BY {KEYS})) AS n FROM r),
 k AS (SELECT *, (n - abs(r0 - r1)) / n AS k, v0 >= t0 AND v1 >= t1 AS joint FROM n)
 SELECT {KEYS}, {', '.join(f'sum(CASE WHEN joint THEN v{i} * k ELSE 0 END) / nullif(sum(CASE WHEN v{i} >= t{i} THEN v{i} ELSE 0 END), 0) AS rwc_{i + 1}' for i in (0, 1))} FROM k GROUP BY {KEYS}"""
COSTES = f"""WITH p AS ({UNSIGNED}),
 o AS (SELECT {KEYS}, max(v0) AS high, avg(v0) AS a, avg(v1) AS b, var_pop(v0) AS va, var_pop(v1) AS vb, covar_pop(v0, v1) AS cov, count(*) AS n FROM p GROUP BY {KEYS}),
 line AS (SELECT *, CASE WHEN n > 1 AND cov <> 0 THEN (vb - va + sqrt((vb - va) * (vb - va) + 4 * cov * cov)) / (2 * cov) END AS slope FROM o),
 levels AS (SELECT *, v0 - a AS dx, v1 - b AS dy, CASE WHEN slope > 0 THEN least(v0, a + (v1 - b) / slope) END AS u FROM p JOIN line USING ({KEYS})),
 sums AS (SELECT *, count(*) OVER w AS k, sum(dx) OVER w AS sx, sum(dy) OVER w AS sy, sum(dx * dy) OVER w AS sxy FROM levels WINDOW w AS (PARTITION BY {KEYS} ORDER BY u RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
 loose AS (SELECT *, max(u) FILTER (k < 3 OR k * sxy <= sx * sy) OVER (PARTITION BY {KEYS}) AS last FROM sums),
 cut AS (SELECT *, CASE WHEN slope > 0 THEN coalesce(min(u) FILTER (u > last OR last IS NULL) OVER (PARTITION BY {KEYS}), high) WHEN slope IS NOT NULL THEN high END AS t FROM loose)
 SELECT {KEYS}, max(t) AS threshold, CASE WHEN max(t) IS NOT NULL THEN coalesce(sum(v0) FILTER (u > t), 0) / nullif(sum(v0), 0) END AS costes_1,
  CASE WHEN max(t) IS NOT NULL THEN coalesce(sum(v1) FILTER (u > t), 0) / nullif(sum(v1), 0) END AS costes_2 FROM cut GROUP BY {KEYS}"""

#: Peaks: the largest sum over a disk about a pixel of the object. Nucleus: a Gaussian over the object less its median.
PEAKS = f"""WITH disk AS (SELECT {KEYS}, c, 0.015 * count(*) FILTER (v <> 0) AS r FROM objects GROUP BY ALL),
 spot AS (SELECT {KEYS}, c, m.y, m.x, r FROM masks m JOIN disk USING ({KEYS}))
 SELECT {KEYS}, c, max(s) AS small_peaks_conv FROM (SELECT spot.position, spot.tile, spot.tp, spot.label, spot.c, spot.y, spot.x, sum(f.v) AS s FROM spot JOIN flat f ON f.position = spot.position AND f.tp = spot.tp AND f.c = spot.c
  AND (f.y - spot.y) * (f.y - spot.y) + (f.x - spot.x) * (f.x - spot.x) <= spot.r * spot.r GROUP BY ALL) GROUP BY {KEYS}, c"""
NUCLEUS = f"""WITH q AS (SELECT -2 * ln(0.05) AS q),
 o AS (SELECT {KEYS}, c, median(v) AS med, sqrt(0.085 * count(*) FILTER (v <> 0) / pi()) AS r FROM objects GROUP BY {KEYS}, c),
 s AS (SELECT *, r * r / q AS variance, CAST(ceil(2 * r) AS INT) AS h FROM o, q WHERE r > 0),
 weights AS (SELECT *, CASE WHEN w < 2.220446049250313e-16 THEN 0 ELSE w END AS k FROM (SELECT s.*, dy, dx, exp(-(dy * dy + dx * dx) / (2 * variance)) AS w FROM s, range(-20, 21) a(dy), range(-20, 21) b(dx) WHERE abs(dy) <= h AND abs(dx) <= h)),
 kernel AS (SELECT {KEYS}, c, med, variance, q, dy, dx, k / sum(k) OVER (PARTITION BY {KEYS}, c) AS k FROM weights),
 norm AS (SELECT {KEYS}, c, sum(k * k) * 0.95 * pi() * max(q) * max(variance) AS norm FROM kernel GROUP BY {KEYS}, c),
 spread AS (SELECT {KEYS}, c, y + dy AS y, x + dx AS x, sum((v - med) * k) AS s FROM objects JOIN kernel USING ({KEYS}, c) GROUP BY ALL),
 placed AS (SELECT o.position, o.tile, o.tp, o.label, o.c, max(coalesce(s.s, 0)) AS best FROM s o JOIN flat f USING (position, tp, c)
  LEFT JOIN spread s ON s.position = o.position AND s.tile = o.tile AND s.tp = o.tp AND s.label = o.label AND s.c = o.c AND s.y = f.y AND s.x = f.x GROUP BY ALL)
 SELECT {KEYS}, c, best / norm AS nuc_est_conv FROM placed JOIN norm USING ({KEYS}, c)"""
LOCALISATION = f"SELECT {KEYS}, c, small_peaks_conv, nuc_est_conv FROM ({PEAKS}) LEFT JOIN ({NUCLEUS}) USING ({KEYS}, c)"

#: Squared distances to the outside; from the pixels farthest inside; and from those to the others.
SHAPE = f"""WITH rim AS (SELECT DISTINCT {KEYS}, y + dy AS oy, x + dx AS ox FROM masks, {STEPS} EXCEPT SELECT {KEYS}, y, x FROM masks),
 near AS (SELECT {KEYS}, m.y, m.x, min((m.y - oy) * (m.y - oy) + (m.x - ox) * (m.x - ox)) AS q FROM masks m JOIN rim USING ({KEYS}) GROUP BY ALL),
 deep AS (SELECT *, q = max(q) OVER (PARTITION BY {KEYS}) AS deepest FROM near),
 dn AS (SELECT {KEYS}, p.y, p.x, p.q, min((p.y - m.y) * (p.y - m.y) + (p.x - m.x) * (p.x - m.x)) AS d FROM deep p JOIN deep m USING ({KEYS}) WHERE m.deepest GROUP BY ALL),
 cone AS (SELECT {KEYS}, p.y, p.x, sqrt(min((p.y - m.y) * (p.y - m.y) + (p.x - m.x) * (p.x - m.x))) AS e FROM dn p JOIN dn m USING ({KEYS}) WHERE p.d = 0 AND m.d > 0 GROUP BY ALL),
 half AS (SELECT {KEYS}, round_even(sqrt(max(q)), 0) AS minor, round_even(sqrt(max(d)) + coalesce(max(s), 0) / 2, 0) AS major FROM dn LEFT JOIN (SELECT {KEYS}, sum(e) AS s FROM cone GROUP BY {KEYS}) USING ({KEYS}) GROUP BY {KEYS})
 SELECT {KEYS}, minor, major, sqrt(greatest(major * major - minor * minor, 0)) / nullif(major, 0) AS eccentricity, 4.0 / 3 * pi() * minor * minor * major AS volume FROM half"""

_Z = [f"zernike_{n}_{m}" for n, m in MOMENTS]
#: Each family's columns, in the order of the SQL.
COLUMNS: dict[str, list[str]] = {
    "sizeshape": ["area", "min_y", "max_y", "min_x", "max_x", "perimeter", "extent", "equivalent_diameter", "major_axis", "minor_axis", "eccentricity"],
    "radial_zernikes": _Z,
    "intensity": ["integrated", "mean", "std", "min", "max", "lower_quartile", "median", "upper_quartile", "mass_displacement", "mad", "integrated_edge", "mean_edge", "std_edge"],
    "feret": ["feret_max", "feret_min"],
    "texture": [f"{n}_{k}" for k in range(4) for n, _ in _TEXTURE],
    "radial_distribution": [f"{n}_{k}" for k in range(4) for n in ("frac_at_d", "mean_frac", "radial_cv")],
    "zernike": _Z,
    "pearson": ["pearson", "slope"],
    "costes": ["threshold", "costes_1", "costes_2"],
    "manders_fold": ["manders_1", "manders_2"],
    "rwc": ["rwc_1", "rwc_2"],
    "shape": ["minor", "major", "eccentricity", "volume"],
    "localisation": ["small_peaks_conv", "nuc_est_conv"],
}
FAMILIES = {
    "sizeshape": SIZESHAPE, "radial_zernikes": RADIAL_ZERNIKES, "intensity": INTENSITY, "feret": FERET, "texture": TEXTURE, "radial_distribution": RADIAL_WIDE, "zernike": ZERNIKE,
    "pearson": PEARSON, "costes": COSTES, "manders_fold": MANDERS, "rwc": RWC, "shape": SHAPE, "localisation": LOCALISATION,
}


def rounded(family: str, keys: str = KEYS, places: int = 6) -> str:
    """A family with its numbers rounded, as the queries round them."""
    whole = {"area", "min_y", "max_y", "min_x", "max_x", "perimeter"}
    columns = [c if c in whole else f"round({c}, {places}) + 0.0 AS {c}" for c in COLUMNS[family]]
    return f"SELECT {keys}, {', '.join(columns)} FROM ({FAMILIES[family]})"


def standard(channels: tuple[int, ...] = (0, 1), places: int = 6) -> tuple[str, list[str]]:
    """The standard job as one wide SELECT, and its columns."""
    parts = [("None/None", "sizeshape", None)]
    parts += [(f"{c}/max", f, c) for c in channels for f in ("radial_zernikes", "intensity", "feret", "texture", "radial_distribution", "zernike")]
    parts += [("(0, 1)/None/max", f, None) for f in ("pearson", "costes", "manders_fold", "rwc")]
    names, columns, joins = [], [], []
    for i, (path, family, c) in enumerate(parts):
        one = "" if c is None or family in ("feret", "zernike") else f" WHERE c = {c}"
        joins.append(f"LEFT JOIN (SELECT * FROM ({FAMILIES[family]}){one}) f{i} USING ({KEYS})")
        for column in COLUMNS[family]:
            names.append(f"{path}/{family}/{column}")
            columns.append(f'round(CAST(f{i}.{column} AS DOUBLE), {places}) + 0.0 AS "{names[-1]}"')
    return f"SELECT {KEYS}, {', '.join(columns)} FROM (SELECT DISTINCT {KEYS} FROM masks) {' '.join(joins)}", names
