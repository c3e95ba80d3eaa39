"""The registered queries in DuckDB SQL, over the same tables.

``CTES`` states the adapters of ``adapters.py``; :func:`sql` puts the needed ones in front
of a query. Percentiles and sums may differ between engines in the last bits, so both sides
round to the same number of places.
"""

from __future__ import annotations

import math

TAIL = "ILW_CONUS.V5.all.CONUS.300m.nc"
VARS = ("tmin", "tmax", "prcp", "srad", "vp", "dayl")
DAY = "'%Y-%m-%d'"
STAMP = "'%Y-%m-%d %H:%M:%S.%f'"


def day(x: str) -> str:
    return f"strftime({x}, {DAY})"


def stamp(x: str) -> str:
    return f"strftime(CAST({x} AS TIMESTAMP), {STAMP})"


def daily_name(d: str) -> str:
    return f"'S3M_OLCI_EFRNT.' || strftime({d}, '%Y%m%d') || '.L3m.DAY.{TAIL}'"


_STAR = [(1, 0), (0.4, 0.4), (0, 1), (-0.4, 0.4), (-1, 0), (-0.4, -0.4), (0, -1), (0.4, -0.4)]
_SQUARE = [(1, 1), (-1, 1), (-1, -1), (1, -1)]
_HOLE = [(0.2, 0), (0, 0.2), (-0.2, 0), (0, -0.2)]


def _offsets() -> str:
    rows = []
    for shape, ring, pts in ((0, 0, _STAR), (0, 1, _HOLE), (1, 0, _SQUARE)):
        for i, (dx, dy) in enumerate(pts):
            ex, ey = pts[(i + 1) % len(pts)]
            rows.append(f"({shape},{ring},{dx:e},{dy:e},{ex:e},{ey:e})")
    return "(VALUES " + ",".join(rows) + ") v(shape, ring, ox, oy, qx, qy)"


def _albers() -> tuple[str, str]:
    """SQL templates for equal-area metres, with {lon} and {lat} to fill in."""
    a, f = 6378137.0, 1 / 298.257222101
    e2 = 2 * f - f * f
    e = math.sqrt(e2)

    def q(deg):
        s = math.sin(math.radians(deg))
        return (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    def m2(deg):
        s = math.sin(math.radians(deg))
        return math.cos(math.radians(deg)) ** 2 / (1 - e2 * s * s)

    n = (m2(29.5) - m2(45.5)) / (q(45.5) - q(29.5))
    c = m2(29.5) + n * q(29.5)
    rho0 = a * math.sqrt(c - n * q(23)) / n
    s = "sin(radians({lat}))"
    qp = f"(({1 - e2!r}e0)*({s}/(1-({e2!r}e0)*{s}*{s}) - ln((1-({e!r}e0)*{s})/(1+({e!r}e0)*{s}))/({2 * e!r}e0)))"
    rho = f"(({a!r}e0)*sqrt(({c!r}e0)-({n!r}e0)*{qp})/({n!r}e0))"
    theta = f"(({n!r}e0)*radians({{lon}}+96e0))"
    return f"({rho}*sin({theta}))", f"(({rho0!r}e0)-{rho}*cos({theta}))"


_AX, _AY = _albers()


def mx(lon: str, lat: str) -> str:
    return _AX.format(lon=lon, lat=lat)


def my(lon: str, lat: str) -> str:
    return _AY.format(lon=lon, lat=lat)


_CI_OK = (
    "CASE WHEN ci >= CAST(0 AS FLOAT) AND ci <= CAST(0.005 AS FLOAT) AND ci > CAST(5e-5 AS FLOAT) "
    "THEN CAST(ci AS DOUBLE) END"
)
_NAME = "(['Superior','Michigan','Huron','Erie','Ontario'])[1 + s_nationkey % 5]"

_KIND = "(CASE WHEN o_orderpriority LIKE '5-%' AND o_orderkey%2=0 THEN 6 ELSE CAST(substr(o_orderpriority,1,1) AS INTEGER) END)"

CTES = {
    "pix": f"""SELECT {daily_name('l_shipdate')} AS src, CAST(l_shipdate AS DATE) AS date,
        CAST((l_orderkey*7919)%2100 AS INTEGER) AS x, CAST((l_partkey*31)%90 AS INTEGER) AS y,
        -95e0+((l_orderkey*7919)%2100)/1e2 AS lon, 40e0+((l_partkey*31)%90)/1e1 AS lat,
        CASE WHEN l_linenumber=7 THEN NULL ELSE CAST(l_extendedprice*5e-8 AS FLOAT) END AS ci FROM lineitem""",
    "ok": f"SELECT *, {_CI_OK} AS v FROM pix",
    "grid": "SELECT DISTINCT y, x, lon, lat FROM pix",
    "boxes": """SELECT 'GL-' || (r_regionkey+1) AS lake_id, r_regionkey*3e0-93 AS minx, 41e0 AS miny,
        r_regionkey*3e0-89 AS maxx, 48e0 AS maxy FROM region""",
    "ctr": """SELECT CAST(s_suppkey AS BIGINT) AS part, s_nationkey, -97e0+((s_suppkey*37)%230)/1e1 AS cx,
        38.05e0+((s_suppkey*53)%110)/1e1 AS cy, 0.25e0+(s_suppkey%7)/1e1 AS r FROM supplier""",
    "parts": f"""SELECT c.*, 'L-' || part AS lake_id,
        CASE part%8 WHEN 5 THEN upper({_NAME}) WHEN 6 THEN 'Lake ' || {_NAME} WHEN 7 THEN NULL ELSE {_NAME} END AS lake_name,
        CASE part%3 WHEN 0 THEN 'United States of America' WHEN 1 THEN 'Canada' END AS country FROM ctr c""",
    "edge": f"""SELECT lake_id, lake_name, country, part, ring, cx+r*ox AS x1, cy+r*oy AS y1, cx+r*qx AS x2, cy+r*qy AS y2
        FROM parts JOIN {_offsets()} ON shape = part%2""",
    "medge": f"""SELECT lake_id, lake_name, country, part, ring, {mx('x1', 'y1')} AS x1, {my('x1', 'y1')} AS y1,
        {mx('x2', 'y2')} AS x2, {my('x2', 'y2')} AS y2 FROM edge""",
    "bnd": """SELECT lake_id, min(least(x1,x2)) AS minx, min(least(y1,y2)) AS miny, max(greatest(x1,x2)) AS maxx,
        max(greatest(y1,y2)) AS maxy FROM edge GROUP BY lake_id""",
    "inside": """SELECT lake_id, y, x FROM (
        SELECT g.lake_id, g.y, g.x, e.part,
          sum(CASE WHEN (y1 > lat) <> (y2 > lat) AND (CASE WHEN y2 > y1 THEN (lon-x1)*(y2-y1) < (x2-x1)*(lat-y1)
              ELSE (lon-x1)*(y2-y1) > (x2-x1)*(lat-y1) END) THEN 1 ELSE 0 END) AS hits,
          bool_or((lon-x1)*(y2-y1) = (x2-x1)*(lat-y1) AND lon BETWEEN least(x1,x2) AND greatest(x1,x2)
              AND lat BETWEEN least(y1,y2) AND greatest(y1,y2)) AS touch
        FROM (SELECT b.lake_id, grid.* FROM grid JOIN bnd b ON lon BETWEEN minx AND maxx AND lat BETWEEN miny AND maxy) g
        JOIN edge e ON e.lake_id = g.lake_id GROUP BY ALL) WHERE hits % 2 = 1 AND NOT touch""",
    "obs": """SELECT c_mktsegment AS lake_id, CAST(o_orderdate AS DATE) AS date, avg(o_totalprice/3.7234567e8) AS m,
        max(o_totalprice/3.7234567e8) AS p, count(*) AS n FROM orders JOIN customer ON o_custkey=c_custkey GROUP BY 1, 2""",
    "climl": """SELECT 'GL-' || (user_id%5+1) AS lake_id, 'Lake ' || (user_id%5+1) AS lake_name, CAST(ts AS DATE) AS date,
        CASE event_type WHEN 'click' THEN 'tmin' WHEN 'view' THEN 'tmax' WHEN 'purchase' THEN 'prcp' WHEN 'signup' THEN 'srad'
        ELSE CASE WHEN event_id%2=0 THEN 'dayl' ELSE 'vp' END END AS var, value FROM events""",
    "clim": """SELECT lake_id, lake_name, date, var, avg(CASE WHEN (day(date) + CAST(substr(lake_id,4) AS INTEGER)*3 + length(var)) % 5 <> 0
        THEN value END) AS value FROM climl GROUP BY ALL""",
    "climw": "SELECT lake_id, lake_name, date, "
             + ", ".join(f"max(CASE WHEN var='{v}' THEN value END) AS {v}" for v in VARS)
             + " FROM clim GROUP BY lake_id, lake_name, date",
    "climo": "SELECT c_mktsegment AS lake_id, CAST(o_orderdate AS DATE) AS date, "
             + ", ".join(f"avg(CASE WHEN {_KIND} = {i + 1} THEN o_totalprice/3.7234567e4 END) AS {v}" for i, v in enumerate(VARS))
             + " FROM orders JOIN customer ON o_custkey=c_custkey GROUP BY 1, 2",
    "ev": """SELECT 'GL-' || (user_id%5+1) AS lake_id, CAST(ts AS DATE) AS d,
        CASE WHEN day(CAST(ts AS DATE))%3=0 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) ELSE min(ts) END AS ts, avg(value) AS m, count(*) AS n,
        CASE WHEN day(CAST(ts AS DATE))%4 <> 0 THEN 1 ELSE 0 END AS ok FROM events GROUP BY 1, CAST(ts AS DATE)""",
    # regular calendar of the partly blanked observations, interpolated and clipped
    "thin": "SELECT lake_id, date, " + ", ".join(f"CASE WHEN (dayofyear(date)*7)%11 < 8 THEN {c} END AS {c}" for c in "mpn") + " FROM obs",
    "cal": """SELECT s.lake_id, s.date, t.m, t.p, t.n, row_number() OVER (PARTITION BY s.lake_id ORDER BY s.date) AS pos
        FROM (SELECT lake_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM thin GROUP BY lake_id) s
        LEFT JOIN thin t ON t.lake_id=s.lake_id AND t.date=s.date""",
}


def _interp(source: str, limit: int, extra: str = "") -> str:
    """Interpolated m and p of a calendar table ``source(lake_id, date, m, p, pos)``."""

    def side(fn, col, frame):
        return (f"{fn}(CASE WHEN {col} IS NOT NULL THEN {{0}} END IGNORE NULLS) OVER "
                f"(PARTITION BY lake_id ORDER BY pos ROWS BETWEEN {frame})")

    cols, picks = [], []
    for c in ("m", "p"):
        prev = side("last_value", c, "UNBOUNDED PRECEDING AND CURRENT ROW")
        nxt = side("first_value", c, "CURRENT ROW AND UNBOUNDED FOLLOWING")
        cols += [prev.format("pos") + f" AS {c}pp", prev.format(c) + f" AS {c}pv",
                 nxt.format("pos") + f" AS {c}np", nxt.format(c) + f" AS {c}nv"]
        picks.append(
            f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN pos-{c}pp <= {limit} OR {c}np-pos <= {limit} THEN "
            f"CASE WHEN {c}pp IS NULL THEN {c}nv WHEN {c}np IS NULL THEN {c}pv "
            f"ELSE {c}pv+({c}nv-{c}pv)*(pos-{c}pp)/({c}np-{c}pp) END END AS {c}"
        )
    return f"SELECT lake_id, date, pos{extra}, {', '.join(picks)} FROM (SELECT *, {', '.join(cols)} FROM {source})"


def _clip(c: str, lo: str, hi: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN greatest({lo}, least({hi}, {c})) END"


CTES["filled"] = _interp("cal", 3, ", n")
CTES["regq"] = f"""SELECT lake_id, date, n, {_clip('m', 'ml', 'mh')} AS m, {_clip('p', 'pl', 'ph')} AS p,
    CASE WHEN n < q05 THEN 1 ELSE 0 END AS low FROM filled JOIN (SELECT lake_id, quantile_cont(m, 0.001) AS ml,
    quantile_cont(m, 0.999) AS mh, quantile_cont(p, 0.001) AS pl, quantile_cont(p, 0.999) AS ph,
    quantile_cont(CAST(n AS DOUBLE), 0.05) AS q05 FROM filled GROUP BY lake_id) USING (lake_id)"""
CTES["expd"] = """SELECT c_mktsegment AS lake_id, count(*)*1000e0 AS area_m2,
    CAST(round_even(count(*)/3e1, 0) + 2 AS BIGINT) AS exp_pix,
    upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS lake_name FROM customer GROUP BY c_mktsegment"""
CTES["qc"] = f"""SELECT o.lake_id, o.date, {daily_name('o.date')} AS src, area_m2, exp_pix, lake_name, nmax, o.n,
    {_clip('m', 'ml', 'mh')} AS m, {_clip('p', 'pl', 'ph')} AS p, o.n/CAST(exp_pix AS DOUBLE) AS pg, o.n/CAST(nmax AS DOUBLE) AS pe,
    CASE WHEN o.n/CAST(exp_pix AS DOUBLE) < 0.05e0 THEN 1 ELSE 0 END AS fg, CASE WHEN o.n/CAST(nmax AS DOUBLE) < 0.3e0 THEN 1 ELSE 0 END AS fe,
    CASE WHEN o.n < 2 THEN 1 ELSE 0 END AS ft FROM obs o LEFT JOIN expd USING (lake_id)
    JOIN (SELECT lake_id, max(n) AS nmax, quantile_cont(m, 0.001) AS ml, quantile_cont(m, 0.999) AS mh,
      quantile_cont(p, 0.001) AS pl, quantile_cont(p, 0.999) AS ph FROM obs GROUP BY lake_id) USING (lake_id)"""
CTES["qcv"] = "SELECT *, CASE WHEN fg=1 OR fe=1 OR ft=1 THEN 0 ELSE 1 END AS valid FROM qc"

NEEDS = {
    "ok": ["pix"], "grid": ["pix"], "parts": ["ctr"], "edge": ["parts"], "medge": ["edge"], "bnd": ["edge"],
    "inside": ["grid", "bnd", "edge"], "clim": ["climl"], "climw": ["clim"], "thin": ["obs"], "cal": ["thin"],
    "filled": ["cal"], "regq": ["filled"], "qc": ["obs", "expd"], "qcv": ["qc"],
}


def sql(ctes: str, body: str) -> str:
    order: list[str] = []

    def add(name):
        for dep in NEEDS.get(name, []):
            add(dep)
        if name not in order:
            order.append(name)

    for name in ctes.split():
        add(name)
    head = ", ".join(f"{n} AS ({CTES[n]})" for n in order)
    return f"WITH {head} {body}" if head else body


def _halves() -> str:
    """The outline of a square lake made of two halves: their common edge is none of it."""
    pts = [(0, 1), (-1, 1), (-1, -1), (0, -1), (1, -1), (1, 1)]
    rows = [f"({a:e},{b:e},{pts[(i + 1) % 6][0]:e},{pts[(i + 1) % 6][1]:e})" for i, (a, b) in enumerate(pts)]
    return "(VALUES " + ",".join(rows) + ") v(ox, oy, qx, qy)"


CTES["hedge"] = f"SELECT 'L-' || part AS lake_id, cx+r*ox AS x1, cy+r*oy AS y1, cx+r*qx AS x2, cy+r*qy AS y2 FROM ctr CROSS JOIN {_halves()}"
CTES["hmedge"] = f"""SELECT lake_id, {mx('x1', 'y1')} AS x1, {my('x1', 'y1')} AS y1, {mx('x2', 'y2')} AS x2, {my('x2', 'y2')} AS y2 FROM hedge"""
CTES["hpts"] = f"""SELECT 'L-' || part AS lake_id, y, x, lon, lat, {mx('lon', 'lat')} AS px, {my('lon', 'lat')} AS py FROM grid JOIN ctr
    ON lon BETWEEN cx-r AND cx+r AND lat BETWEEN cy-r AND cy+r"""
NEEDS |= {"hedge": ["ctr"], "hmedge": ["hedge"], "hpts": ["grid", "ctr"]}


# what the rectangles of adapters.PATCHES leave as outline, corner by corner, with the points where they meet
_OUTLINES = (
    [(-1, -1), (0, -1), (1, -1), (1, 0.25), (1, 1), (0, 1), (-1, 1)],
    [(-1, -1), (-0.2, -1), (0.3, -1), (1, -1), (1, 1), (0.3, 1), (-0.2, 1), (-1, 1)],
    [(-0.5, -1), (0.5, -1), (0.5, -0.5), (1, -0.5), (1, 0.5), (1, 1), (0.5, 1), (-0.5, 1), (-0.5, 0.5), (-1, 0.5), (-1, -0.5), (-0.5, -0.5)],
)


def _patches() -> str:
    rows = []
    for kind, pts in enumerate(_OUTLINES):
        rows += [f"({kind},{a:e},{b:e},{pts[(i + 1) % len(pts)][0]:e},{pts[(i + 1) % len(pts)][1]:e})" for i, (a, b) in enumerate(pts)]
    return "(VALUES " + ",".join(rows) + ") v(kind, ox, oy, qx, qy)"


CTES["uedge"] = f"SELECT 'L-' || part AS lake_id, cx+r*ox AS x1, cy+r*oy AS y1, cx+r*qx AS x2, cy+r*qy AS y2 FROM ctr JOIN {_patches()} ON kind = part%3"
CTES["umedge"] = CTES["hmedge"].replace("hedge", "uedge")
NEEDS |= {"uedge": ["ctr"], "umedge": ["uedge"]}


def _inside_outline(points: str, edge: str, px: str, py: str, part: str = "", inset: float = 0.0) -> str:
    """(lake_id, y, x) of points in a part by ray parity, off every edge of the lake and ``inset`` away from it."""
    t = (f"greatest(0e0, least(1e0, coalesce((({px}-x1)*(x2-x1)+({py}-y1)*(y2-y1))/nullif((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1),0), 0e0)))")
    d2 = f"({px}-(x1+{t}*(x2-x1)))*({px}-(x1+{t}*(x2-x1))) + ({py}-(y1+{t}*(y2-y1)))*({py}-(y1+{t}*(y2-y1)))"
    return f"""SELECT lake_id, y, x FROM (SELECT p.lake_id, p.y, p.x {part and ', e.' + part}, sum(CASE WHEN (y1 > {py}) <> (y2 > {py}) AND
        (CASE WHEN y2 > y1 THEN ({px}-x1)*(y2-y1) < (x2-x1)*({py}-y1) ELSE ({px}-x1)*(y2-y1) > (x2-x1)*({py}-y1) END) THEN 1 ELSE 0 END) AS hits,
        min({d2}) AS d2, bool_or(({px}-x1)*(y2-y1) = (x2-x1)*({py}-y1) AND {px} BETWEEN least(x1,x2) AND greatest(x1,x2)
          AND {py} BETWEEN least(y1,y2) AND greatest(y1,y2)) AS touch
        FROM {points} p JOIN {edge} e ON e.lake_id=p.lake_id GROUP BY ALL)
        GROUP BY lake_id, y, x HAVING bool_or(hits%2=1) AND NOT bool_or(touch) AND sqrt(min(d2)) >= {inset:e}"""


def _scanned(edge: str, key: str, step: float, inset: float) -> str:
    """(key, area): free length of the scan lines of a lake's inset, turned by half a radian, times their distance."""
    c, s = math.cos(0.5), math.sin(0.5)
    turned = ", ".join(f"x{i}*{c!r}e0-y{i}*{s!r}e0 AS x{i}, x{i}*{s!r}e0+y{i}*{c!r}e0 AS y{i}" for i in (1, 2))
    y, n = f"((k+0.5e0)*{step:e})", "sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1))"
    nx, ny = f"(-(y2-y1)/{n}*{inset:e})", f"((x2-x1)/{n}*{inset:e})"
    at = [f"CASE WHEN abs({y}-y{i}) < {inset:e} THEN x{i} {sign} sqrt({inset * inset:e}-({y}-y{i})*({y}-y{i})) END" for i in (1, 2) for sign in "+-"]
    ring = [(f"(x1{a}{nx})", f"(y1{a}{ny})") if i == 1 else (f"(x2{a}{nx})", f"(y2{a}{ny})") for i, a in ((1, "+"), (2, "+"), (2, "-"), (1, "-"))]
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        at.append(f"CASE WHEN ({ay} > {y}) <> ({by} > {y}) THEN {ax}+({bx}-{ax})*({y}-{ay})/({by}-{ay}) END")
    w = f"PARTITION BY {key}, k ORDER BY x"
    return f"""SELECT {key}, sum(nxt-x)*{step:e} AS area FROM (SELECT {key}, x, lead(x) OVER ({w}) AS nxt,
          sum(turn) OVER ({w} ROWS UNBOUNDED PRECEDING) AS turns, sum(deep) OVER ({w} ROWS UNBOUNDED PRECEDING) AS deeps FROM
        (SELECT {key}, k, unnest([x0, lo, hi]) AS x, unnest([1, 0, 0]) AS turn, unnest([0, 1, -1]) AS deep FROM
          (SELECT {key}, k, CASE WHEN (y1 > {y}) <> (y2 > {y}) THEN x1+({y}-y1)/(y2-y1)*(x2-x1) END AS x0, least({', '.join(at)}) AS lo, greatest({', '.join(at)}) AS hi
           FROM (SELECT *, unnest(generate_series(CAST(ceil((least(y1,y2)-{inset:e})/{step:e}-0.5e0) AS BIGINT),
              CAST(floor((greatest(y1,y2)+{inset:e})/{step:e}-0.5e0) AS BIGINT))) AS k FROM (SELECT {key}, {turned} FROM {edge})))) WHERE x IS NOT NULL)
        WHERE turns % 2 = 1 AND deeps = 0 AND nxt > x GROUP BY {key}"""


def _degrees(x: str, y: str) -> tuple[str, str]:
    """Longitude and latitude of a point in equal-area metres."""
    a, f = 6378137.0, 1 / 298.257222101
    e2 = 2 * f - f * f
    e = math.sqrt(e2)

    def q(deg):
        s = math.sin(math.radians(deg))
        return (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    def m2(deg):
        s = math.sin(math.radians(deg))
        return math.cos(math.radians(deg)) ** 2 / (1 - e2 * s * s)

    n = (m2(29.5) - m2(45.5)) / (q(45.5) - q(29.5))
    c = m2(29.5) + n * q(29.5)
    rho0 = a * math.sqrt(c - n * q(23)) / n
    down = f"({rho0!r}e0-{y})"
    beta = f"asin(({c!r}e0-({x}*{x}+{down}*{down})*{n * n / (a * a):.17e})/{n * q(90)!r}e0)"
    series = [(2, e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040), (4, 23 * e2**2 / 360 + 251 * e2**3 / 3780), (6, 761 * e2**3 / 45360)]
    lat = beta + "".join(f"+{w:.17e}*sin({k}*{beta})" for k, w in series)
    return f"(degrees(atan2({x}, {down}))/{n!r}e0-96e0)", f"degrees({lat})"


def _inset_boxes(edge: str, r: float) -> str:
    """Boxes around all points at distance ``r`` from two of a lake's edges or corners and no nearer to any: all pairs are tried."""
    n = "sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1))"
    nx, ny = f"(-(y2-y1)/{n}*{r:e})", f"((x2-x1)/{n}*{r:e})"
    dx, dy = "(a.x2-a.x1)", "(a.y2-a.y1)"
    u = f"((b.x1-a.x1)*(b.y2-b.y1)-(b.y1-a.y1)*(b.x2-b.x1))/nullif({dx}*(b.y2-b.y1)-{dy}*(b.x2-b.x1), 0)"
    t = f"(((b.x1-a.x1)*{dx}+(b.y1-a.y1)*{dy})/({dx}*{dx}+{dy}*{dy}))"
    off = f"((a.x1+{t}*{dx}-b.x1)*(a.x1+{t}*{dx}-b.x1)+(a.y1+{t}*{dy}-b.y1)*(a.y1+{t}*{dy}-b.y1))"
    half = f"sqrt(greatest({r * r:e}-{off}, 0e0)/({dx}*{dx}+{dy}*{dy}))"
    gap = "((b.x1-a.x1)*(b.x1-a.x1)+(b.y1-a.y1)*(b.y1-a.y1))"
    out = f"sqrt(greatest({r * r:e}/{gap}-0.25e0, 0e0))"
    pairs = "tr a JOIN tr b ON a.lake_id=b.lake_id"
    pts = [f"SELECT a.lake_id, a.x1+{u}*{dx} AS px, a.y1+{u}*{dy} AS py FROM {pairs} WHERE a.kind='l' AND b.kind='l'"]
    for s in "+-":
        pts.append(f"SELECT a.lake_id, a.x1+({t}{s}{half})*{dx}, a.y1+({t}{s}{half})*{dy} FROM {pairs} WHERE a.kind='l' AND b.kind='c' AND {off} <= {r * r:e}")
    pts.append(f"SELECT a.lake_id, (a.x1+b.x1)/2+{out}*(b.y1-a.y1), (a.y1+b.y1)/2-{out}*(b.x1-a.x1) FROM {pairs} "
               f"WHERE a.kind='c' AND b.kind='c' AND {gap} > 0 AND {gap} <= {4 * r * r:e}")
    lon, lat = _degrees("x", "y")
    return f"""WITH tr AS (SELECT lake_id, 'l' AS kind, x1+{nx} AS x1, y1+{ny} AS y1, x2+{nx} AS x2, y2+{ny} AS y2 FROM {edge}
          UNION ALL SELECT lake_id, 'l', x1-{nx}, y1-{ny}, x2-{nx}, y2-{ny} FROM {edge} UNION ALL SELECT lake_id, 'c', x1, y1, x1, y1 FROM {edge}),
        pts AS (SELECT lake_id, 1 AS y, row_number() OVER () AS x, px, py FROM ({" UNION ALL ".join(pts)}) WHERE px IS NOT NULL),
        good AS ({_inside_outline('pts', edge, 'px', 'py', inset=r - 1e-3)})
        SELECT lake_id, round(min({lon}), 6) AS minx, round(min({lat}), 6) AS miny, round(max({lon}), 6) AS maxx, round(max({lat}), 6) AS maxy
        FROM (SELECT g.lake_id, p.px AS x, p.py AS y FROM good g JOIN pts p ON p.x = g.x) GROUP BY 1"""


def _union(edge: str, key: str) -> str:
    """Edges (key, x1, y1, x2, y2) around the union of a key's parts: all pairs are cut, all pieces probed on both sides.

    ``edge`` has key, part and the edge's ends. A piece stays if some part is on one hand and none on the other.
    """
    d = "1e-7"
    return f"""SELECT {key}, min(x1) AS x1, min(y1) AS y1, min(x2) AS x2, min(y2) AS y2 FROM (
      SELECT {key}, no, t0, any_value(x1) AS x1, any_value(y1) AS y1, any_value(x2) AS x2, any_value(y2) AS y2, any_value(mx) AS mx,
          any_value(my) AS my, bool_or(hits%2=1 AND side=1) AS l, bool_or(hits%2=1 AND side=-1) AS r FROM (
        SELECT s.{key}, s.no, s.t0, s.x1, s.y1, s.x2, s.y2, s.mx, s.my, s.side, w.part,
            sum(CASE WHEN (w.y1 > s.py) <> (w.y2 > s.py) AND s.px < (w.x2-w.x1)*(s.py-w.y1)/(w.y2-w.y1)+w.x1 THEN 1 ELSE 0 END) AS hits
        FROM (SELECT *, mx - side*{d}*(y2-y1)/len AS px, my + side*{d}*(x2-x1)/len AS py FROM
          (SELECT {key}, no, t0, least(p1, p2)[1] AS x1, least(p1, p2)[2] AS y1, greatest(p1, p2)[1] AS x2, greatest(p1, p2)[2] AS y2,
             (p1[1]+p2[1])/2 AS mx, (p1[2]+p2[2])/2 AS my, sqrt((p2[1]-p1[1])*(p2[1]-p1[1])+(p2[2]-p1[2])*(p2[2]-p1[2])) AS len FROM
            (SELECT {key}, no, t AS t0, [x1+t*(x2-x1), y1+t*(y2-y1)] AS p1, lead([x1+t*(x2-x1), y1+t*(y2-y1)]) OVER (PARTITION BY no ORDER BY t) AS p2
             FROM (SELECT DISTINCT n.{key}, n.no, n.x1, n.y1, n.x2, n.y2, round(t, 9) AS t FROM {edge}_no n JOIN {edge}_cut c USING (no)))
           WHERE p2 IS NOT NULL), (VALUES (1), (-1)) v(side)) s
        JOIN {edge}_no w ON w.{key}=s.{key} GROUP BY ALL)
      GROUP BY {key}, no, t0)
    WHERE l <> r GROUP BY {key}, round(mx, 6), round(my, 6)"""


def _union_ctes(edge: str, key: str) -> str:
    """Numbered edges, and where each is met (as a share of its length); to stand before :func:`_union`."""
    cross = "((a.x2-a.x1)*(b.y2-b.y1)-(a.y2-a.y1)*(b.x2-b.x1))"
    off = "abs((a.x2-a.x1)*({y}-a.y1)-(a.y2-a.y1)*({x}-a.x1))/a.len"
    at = "(({x}-a.x1)*(a.x2-a.x1)+({y}-a.y1)*(a.y2-a.y1))/(a.len*a.len)"
    ends = " UNION ALL ".join(
        f"SELECT no, {at.format(x=x, y=y)} AS t FROM p WHERE {off.format(x=x, y=y)} < 1e-9".replace("a.", "a_").replace("b.", "b_")
        for x, y in (("b.x1", "b.y1"), ("b.x2", "b.y2")))
    cols = ", ".join(f"{s}.{c} AS {s}_{c}" for s in "ab" for c in ("x1", "y1", "x2", "y2", "len"))
    t = f"((b.x1-a.x1)*(b.y2-b.y1)-(b.y1-a.y1)*(b.x2-b.x1))/{cross}".replace("a.", "a_").replace("b.", "b_")
    u = f"((b.x1-a.x1)*(a.y2-a.y1)-(b.y1-a.y1)*(a.x2-a.x1))/{cross}".replace("a.", "a_").replace("b.", "b_")
    c = cross.replace("a.", "a_").replace("b.", "b_")
    return f"""{edge}_no AS (SELECT *, row_number() OVER () AS no, sqrt((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1)) AS len FROM {edge}),
    {edge}_cut AS (WITH p AS (SELECT a.no, {cols} FROM {edge}_no a JOIN {edge}_no b ON a.{key}=b.{key} AND a.part<>b.part)
      SELECT no, t FROM (SELECT no, 0e0 AS t FROM {edge}_no UNION ALL SELECT no, 1e0 FROM {edge}_no UNION ALL {ends}
      UNION ALL SELECT no, {t} FROM p WHERE abs({c}) > 1e-12 * a_len * b_len AND {u} BETWEEN -1e-9 AND 1 + 1e-9) WHERE t BETWEEN 0 AND 1)"""


def _stats(v: str = "v") -> str:
    return (f"round(avg({v}), 9) AS CI_mean, round(quantile_cont({v}, 0.9), 9) AS CI_p90, "
            f"CAST(count({v}) AS BIGINT) AS n_valid")


def _centre(c: str, part: str, order: str = "date") -> str:
    w = f"OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)"
    return f"CASE WHEN count({c}) {w} >= 3 THEN avg({c}) {w} END"


def _r(cols, places):
    return ", ".join(f"round({c}, {places}) AS {c}" for c in cols)


def _resample(label: str, step: str, extra: str = "") -> str:
    means = ", ".join(f"avg({v}) AS {v}" for v in VARS)
    return sql("climo", f"""SELECT s.lake_id, {day('s.date')} AS date, {", ".join(f"round(b.{v}, 8) AS {v}" for v in VARS)} FROM
        (SELECT lake_id, CAST(unnest(generate_series(min(l), max(l), INTERVAL {step})) AS DATE) AS date FROM
          (SELECT lake_id, {label} AS l FROM climo {extra}) GROUP BY lake_id) s
        LEFT JOIN (SELECT lake_id, {label} AS date, {means} FROM climo {extra} GROUP BY 1, 2) b
        ON b.lake_id=s.lake_id AND b.date=s.date""")


_FIRST = "JOIN (SELECT lake_id, min(date) AS f FROM climo GROUP BY lake_id) USING (lake_id)"


def _lattice(source: str, key: str, cell: float, inset: float) -> str:
    """(key, row, col) of lattice cells inside each key's parts, ``inset`` away from their edges."""
    c, d = f"{cell:e}", "((px-x1)*(x2-x1)+(py-y1)*(y2-y1))/nullif((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1),0)"
    t = f"greatest(0e0, least(1e0, coalesce({d}, 0e0)))"
    return f"""SELECT DISTINCT {key}, r, c FROM (
        SELECT {key}, r, c, part, sum(CASE WHEN (y1 > py) <> (y2 > py) AND (CASE WHEN y2 > y1 THEN (px-x1)*(y2-y1) < (x2-x1)*(py-y1)
            ELSE (px-x1)*(y2-y1) > (x2-x1)*(py-y1) END) THEN 1 ELSE 0 END) AS hits,
          min((px-(x1+{t}*(x2-x1)))*(px-(x1+{t}*(x2-x1))) + (py-(y1+{t}*(y2-y1)))*(py-(y1+{t}*(y2-y1)))) AS d2
        FROM (SELECT {key}, r, c, (c+0.5e0)*{c} AS px, (r+0.5e0)*{c} AS py FROM
          (SELECT {key}, c0, c1, unnest(generate_series(r0, r1)) AS r FROM
            (SELECT {key}, CAST(floor(min(least(y1,y2))/{c}) AS BIGINT) AS r0, CAST(floor(max(greatest(y1,y2))/{c}) AS BIGINT) AS r1,
              CAST(floor(min(least(x1,x2))/{c}) AS BIGINT) AS c0, CAST(floor(max(greatest(x1,x2))/{c}) AS BIGINT) AS c1
             FROM {source} GROUP BY {key})), unnest(generate_series(c0, c1)) u(c))
        JOIN {source} USING ({key}) GROUP BY ALL) WHERE hits%2=1 AND d2>0 AND sqrt(d2) >= {inset:e}"""


def _box_hits(source: str, key: str, minx, miny, maxx, maxy) -> str:
    """Keys whose polygon shares a point with the box: a vertex inside, an edge across, or a corner covered."""
    def corner(cx, cy):
        return (f"sum(CASE WHEN (y1 > {cy}) <> (y2 > {cy}) AND {cx} < (x2-x1)*({cy}-y1)/nullif(y2-y1,0)+x1 THEN 1 ELSE 0 END)%2=1")

    side = []
    for x in (minx, maxx):
        side.append(f"((x1-({x}))*(x2-({x})) <= 0 AND x1<>x2 AND y1+(y2-y1)*(({x})-x1)/nullif(x2-x1,0) BETWEEN {miny} AND {maxy})")
    for y in (miny, maxy):
        side.append(f"((y1-({y}))*(y2-({y})) <= 0 AND y1<>y2 AND x1+(x2-x1)*(({y})-y1)/nullif(y2-y1,0) BETWEEN {minx} AND {maxx})")
    vertex = f"(x1 BETWEEN {minx} AND {maxx} AND y1 BETWEEN {miny} AND {maxy})"
    return f"""SELECT DISTINCT {key} FROM (SELECT {key}, part, bool_or({vertex} OR {' OR '.join(side)}) AS meets,
        {corner(minx, miny)} AS cov FROM {source} GROUP BY {key}, part) WHERE meets OR cov"""


# what each way of writing an event time keeps of it
_KEPT = ("half", "day", "day", "second", "day", "day", "day", "minute", "day", "day", "second", "minute", "minute", "day", "minute", "minute",
         "day", "month", "second", "day", "day", "day", "minute", "second", "zone")
_SPECIAL = {"half": "date_trunc('second', ts) + INTERVAL 500 MILLISECOND", "zone": "date_trunc('second', ts) - INTERVAL 2 HOUR"}
_TEXT_TIME = "CASE event_id%27 " + " ".join(
    f"WHEN {i} THEN " + _SPECIAL.get(k, f"date_trunc('{k}', ts)")
    for i, k in enumerate(_KEPT)
) + " END"

_SPANS = """SELECT CASE WHEN o_orderkey%2=0 THEN 'CONUS' ELSE 'ALASKA' END AS region, CAST(min(o_orderdate) AS DATE) AS a,
    CAST(max(o_orderdate) AS DATE) AS b FROM orders GROUP BY 1"""
_TAIL = "CASE region WHEN 'CONUS' THEN 'ILW_CONUS.V5.all.CONUS.300m.nc' ELSE 'ILW_ALASKA.V5.all.ILW_AK.300m.nc' END"
_EXPECTED = f"""SELECT region, d AS date, 'S3M_OLCI_EFRNT.' || strftime(d, '%Y%m%d') || '.L3m.DAY.' || {_TAIL} AS src FROM
    (SELECT region, CAST(unnest(generate_series(a, b - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM ({_SPANS}))"""
_LISTING = """SELECT src, count(CASE WHEN ci >= CAST(0 AS FLOAT) AND ci <= CAST(0.001 AS FLOAT) AND ci > CAST(5e-5 AS FLOAT)
    THEN 1 END) AS length FROM pix GROUP BY src"""

_FILE = f"""SELECT o_orderkey, o_orderkey%2=0 AS mo, CAST(o_orderdate AS DATE) AS d, substr(o_orderpriority,1,1) AS p,
    date_trunc('month', o_orderdate) AS m0, CAST(last_day(o_orderdate) AS TIMESTAMP) AS m1 FROM orders"""
_FILE_NAME = (
    "CASE WHEN mo THEN 'S3B_OLCI_EFRNT.' || strftime(m0, '%Y%m%d') || '_' || strftime(m1, '%Y%m%d') || "
    f"'.L3m.MO.{TAIL}' ELSE {daily_name('d')} END"
)
_HALF = "{0} + to_microseconds(CAST((epoch_us({1}) - epoch_us({0})) // 2 AS BIGINT))"

_PROFILE_NUM = """SELECT '{c}' AS "column", count({v}) AS "count", CAST(NULL AS DOUBLE) AS "unique", CAST(NULL AS VARCHAR) AS top,
    CAST(NULL AS DOUBLE) AS freq, round(avg({v}),5) AS mean, round(stddev_samp({v}),5) AS std, round(min({v}),5) AS "min",
    round(quantile_cont({v},0.25),5) AS p25, round(quantile_cont({v},0.5),5) AS p50, round(quantile_cont({v},0.75),5) AS p75,
    round(max({v}),5) AS "max" FROM orders"""
_PROFILE_TEXT = """SELECT '{c}', (SELECT count({c}) FROM orders), CAST((SELECT count(DISTINCT {c}) FROM orders) AS DOUBLE),
    (SELECT {c} FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
    CAST((SELECT max(k) FROM (SELECT count(*) AS k FROM orders GROUP BY {c})) AS DOUBLE), NULL, NULL, NULL, NULL, NULL, NULL, NULL"""

_LAKE_PICK = f"""SELECT part, lake_name, country, lake_name IS NOT NULL AND
    regexp_matches(lake_name, '(?i)superior|michigan|huron|erie|ontario') AND
    (coalesce(country,'') ILIKE '%united states%' OR part IN ({_box_hits('edge', 'part', -95, 40, -74, 49)})) AS pick FROM parts"""
_FIVE = "('Erie','Huron','Michigan','Ontario','Superior')"

ORACLES: dict[str, str] = {
    "zonal_daily": sql("ok boxes", f"""SELECT b.lake_id, {stamp('f.date')} AS date, 'daily' AS product, round(m, 9) AS CI_mean,
        round(p, 9) AS CI_p90, coalesce(n, 0) AS n_valid, f.src, 'table' AS engine
        FROM (SELECT DISTINCT src, date FROM pix) f CROSS JOIN boxes b LEFT JOIN
        (SELECT src, lake_id, avg(v) AS m, quantile_cont(v, 0.9) AS p, count(v) AS n FROM ok JOIN boxes
          ON lon BETWEEN minx AND maxx AND lat BETWEEN miny AND maxy GROUP BY 1, 2) s ON s.src=f.src AND s.lake_id=b.lake_id"""),
    "zonal_tiled": sql("ok boxes", f"""SELECT 'all' AS product, lake_id, {_stats()} FROM boxes LEFT JOIN ok
        ON lon BETWEEN minx AND maxx AND lat BETWEEN miny AND maxy WHERE lake_id <> 'GL-3' GROUP BY lake_id"""),
    "zonal_many_lakes": sql("ok ctr", f"""SELECT 'all' AS product, 'L-' || part AS lake_id, {_stats()} FROM ctr LEFT JOIN ok
        ON lon BETWEEN cx-r AND cx+r AND lat BETWEEN cy-r AND cy+r GROUP BY part"""),
    "zonal_monthly": sql("pix boxes", f"""SELECT b.lake_id, strftime(CASE WHEN month(a)%3=0 THEN a + to_microseconds(CAST(date_diff('microsecond', a, z + INTERVAL 12 HOUR)//2 AS BIGINT))
        ELSE a + to_microseconds(CAST(date_diff('microsecond', a, z)//2 AS BIGINT)) END, {STAMP}) AS time, 'monthly' AS product, CI_mean, CI_p90,
        coalesce(n_valid, 0) AS n_valid, 'S3B_OLCI_EFRNT.' || strftime(a, '%Y%m%d') || '_' || strftime(z, '%Y%m%d') || '.L3m.MO.{TAIL}' AS src, 'table' AS engine FROM
        (SELECT DISTINCT CAST(date_trunc('month', date) AS TIMESTAMP) AS a, CAST(last_day(date) AS TIMESTAMP) AS z FROM pix) f CROSS JOIN boxes b LEFT JOIN
        (SELECT date_trunc('month', date) AS mo, lake_id, {_stats()} FROM (SELECT *, CASE WHEN ci >= CAST(0 AS FLOAT) AND
          ci <= CASE WHEN month(date)%2=1 THEN CAST(0.004 AS FLOAT) ELSE CAST(0.005 AS FLOAT) END AND ci > CAST(5e-5 AS FLOAT) THEN CAST(ci AS DOUBLE) END AS v FROM pix)
          JOIN boxes ON lon BETWEEN minx AND maxx AND lat BETWEEN miny AND maxy GROUP BY 1, 2) s ON s.mo=f.a AND s.lake_id=b.lake_id"""),
    "regional_daily": sql("ok", f"""SELECT {stamp('date')} AS date, {_stats()}, src, 'table' AS engine FROM ok GROUP BY src, date"""),
    "regional_readers": sql("ok", f"""SELECT {stamp('date')} AS date, {_stats()}, src, CASE WHEN day(date)%2=0 THEN 'primary' ELSE 'fallback' END AS engine
        FROM ok WHERE day(date)%5<>0 GROUP BY src, date"""),
    "regional_monthly": sql("ok", f"""SELECT strftime(a + to_microseconds(CAST(date_diff('microsecond', a, b)//2 AS BIGINT)), {STAMP}) AS time,
        CI_mean, CI_p90, n_valid FROM (SELECT CAST(date_trunc('month', date) AS TIMESTAMP) AS a, CAST(last_day(date) AS TIMESTAMP) AS b,
        {_stats()} FROM ok GROUP BY 1, 2)"""),
    "index_cleaning": sql("pix", f"""SELECT {day('date')} AS date, count(*) AS n_all, count(CASE WHEN ci > CAST(5e-5 AS FLOAT) THEN 1 END) AS n_floor,
        count({_CI_OK}) AS n_kept, count(CASE WHEN ci > CAST(2e-3 AS FLOAT) THEN 1 END) AS n_high,
        round(CAST(CAST(1e-3 AS FLOAT) AS DOUBLE), 9) AS threshold, any_value(n_wide_floor) AS n_wide_floor, any_value(n_wide_kept) AS n_wide_kept
        FROM pix JOIN (SELECT CAST(l_shipdate AS DATE) AS date, count(CASE WHEN w > 5e-5 THEN 1 END) AS n_wide_floor,
          count(CASE WHEN w > 1e-3 AND w <= 2e-3 THEN 1 END) AS n_wide_kept FROM (SELECT l_shipdate, CAST(l_quantity AS DOUBLE)*5e-5 AS w FROM lineitem) GROUP BY 1) USING (date) GROUP BY date"""),
    "time_labels": f"""WITH f AS ({_FILE}) SELECT o_orderkey, {_FILE_NAME} AS file, strftime(CASE
        WHEN p='1' THEN CAST(d AS TIMESTAMP) + INTERVAL 23400250 MILLISECOND
        WHEN p='2' AND mo THEN {_HALF.format("(CAST(d AS TIMESTAMP) + INTERVAL 1 SECOND)", "(CAST(d AS TIMESTAMP) + INTERVAL 9 DAY + INTERVAL 86398 SECOND)")}
        WHEN p='2' THEN CAST(d AS TIMESTAMP) + INTERVAL 1 SECOND
        WHEN mo THEN {_HALF.format("m0", "m1")} ELSE CAST(d AS TIMESTAMP) END, {STAMP}) AS label FROM f""",
    "filename_dates": f"""WITH f AS (SELECT CASE WHEN mo THEN CAST(m0 AS TIMESTAMP) ELSE CAST(d AS TIMESTAMP) END AS a,
        CASE WHEN mo THEN m1 ELSE CAST(d AS TIMESTAMP) END AS z FROM ({_FILE})) SELECT {stamp('a')} AS first, {stamp('z')} AS last,
        strftime({_HALF.format("a", "z")}, {STAMP}) AS middle, count(*) AS n_files FROM f GROUP BY a, z""",
    "period_snap": f"""SELECT {day("ts")} AS day, {day("date_trunc('week', ts)")} AS week, {day("date_trunc('month', ts)")} AS month,
        {day("date_trunc('quarter', ts)")} AS quarter, count(*) AS n FROM events GROUP BY 1, 2, 3, 4""",
    "lenient_datetime": f"SELECT event_id, strftime({_TEXT_TIME}, {STAMP}) AS date FROM events WHERE event_id%27 < 25",
    "dropped_datetime": "SELECT count(*) AS rows, count(CASE WHEN event_id%27 >= 25 THEN 1 END) AS rows_dropped FROM events",
    "dedupe_first": f"""SELECT c_mktsegment AS series, {day("date_trunc('month', o_orderdate)")} AS date, o_orderkey AS src, o_totalprice AS value
        FROM orders JOIN customer ON o_custkey=c_custkey QUALIFY row_number() OVER (PARTITION BY c_mktsegment,
        date_trunc('month', o_orderdate) ORDER BY o_orderdate, o_orderkey)=1""",
    "reindex_daily": sql("obs", f"""SELECT s.lake_id, {day('s.date')} AS date, round(m, 11) AS CI_mean, CAST(n AS DOUBLE) AS n_valid FROM
        (SELECT lake_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM obs GROUP BY 1) s
        LEFT JOIN obs o ON o.lake_id=s.lake_id AND o.date=s.date"""),
    "reindex_monthly": f"""WITH m AS (SELECT o_custkey AS series, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
        round(max(o_totalprice), 2) AS top FROM orders GROUP BY 1, 2)
        SELECT s.series, {day('s.date')} AS date, top FROM (SELECT series, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 MONTH)) AS DATE)
        AS date FROM m GROUP BY 1) s LEFT JOIN m ON m.series=s.series AND m.date=s.date""",
    "calendar_days": sql("obs", f"""SELECT lake_id, {day('d')} AS date FROM (SELECT lake_id, unnest(generate_series(min(date), max(date),
        INTERVAL 1 DAY)) AS d FROM obs GROUP BY lake_id)"""),
    "clip_global": f"""SELECT l_orderkey, l_linenumber, round({_clip('l_extendedprice', 'lo', 'hi')}, 6) AS l_extendedprice FROM lineitem,
        (SELECT quantile_cont(l_extendedprice, 0.001) AS lo, quantile_cont(l_extendedprice, 0.999) AS hi FROM lineitem)""",
    "clip_per_lake": f"""WITH o AS (SELECT c_mktsegment AS series, o_orderkey AS src, o_totalprice AS v FROM orders JOIN customer ON o_custkey=c_custkey)
        SELECT series, src, round({_clip('v', 'lo', 'hi')}, 6) AS value FROM o JOIN (SELECT series, quantile_cont(v, 0.001) AS lo,
        quantile_cont(v, 0.999) AS hi FROM o GROUP BY 1) USING (series)""",
    "regional_quality_daily": sql("regq", f"""SELECT lake_id, {day('date')} AS date, round(m, 11) AS CI_mean, round(p, 11) AS CI_p90,
        CAST(n AS DOUBLE) AS n_valid, low AS qc_low_coverage FROM regq"""),
    "regional_quality_summary": sql("regq", """SELECT 'regional_daily' AS tag, count(*) AS rows, count(*)-count(m) AS n_missing_CI_mean,
        count(*)-count(p) AS n_missing_CI_p90, count(*)-count(n) AS n_missing_n_valid FROM regq"""),
    "rolling_centre7": sql("obs", f"""SELECT lake_id, {day('date')} AS date, round({_centre('m', 'lake_id')}, 11) AS CI_mean_7,
        round({_centre('p', 'lake_id')}, 11) AS CI_p90_7 FROM obs"""),
    "lake_quality": sql("qcv", f"""SELECT lake_id, {stamp('date')} AS date, round(m, 11) AS CI_mean, round(p, 11) AS CI_p90, n AS n_valid, src,
        area_m2, exp_pix AS expected_pixels_geom, lake_name, nmax AS empiric_n_valid_max, round(pg, 6) AS pct_valid_geom,
        round(pe, 6) AS pct_valid_emp, fg AS qc_low_cov_geom, fe AS qc_low_cov_emp, ft AS qc_tiny_abs_pix, valid AS qc_is_valid FROM qcv"""),
    "lake_quality_summary": sql("qcv", """SELECT lake_id, count(*) AS rows, CAST(sum(valid) AS BIGINT) AS rows_valid,
        round_even(sum(valid)/CAST(count(*) AS DOUBLE), 4) AS frac_valid, round(median(pg), 6) AS pct_valid_geom_med,
        round(median(pe), 6) AS pct_valid_emp_med, min(lake_name) AS lake_name FROM qcv GROUP BY lake_id"""),
    "lake_counts": sql("qcv", """SELECT lake_id, count(*) AS n_rows, count(m) AS n_CI_finite, count(CASE WHEN n>0 THEN 1 END) AS n_valid_pos,
        CAST(sum(valid) AS BIGINT) AS qc_valid FROM qcv GROUP BY lake_id"""),
    "count_column_choice": sql("obs", "SELECT lake_id, CAST(sum(n) AS BIGINT) AS pixels FROM obs GROUP BY lake_id"),
    "value_presence": sql("climw", "SELECT lake_id, count(*) AS days, "
                          + ", ".join(f"CAST(count({v})>0 AS INTEGER) AS has_{v}" for v in VARS) + " FROM climw GROUP BY lake_id"),
    "climate_outer": sql("climw", f"SELECT lake_id, lake_name, {day('date')} AS date, {_r(VARS, 9)} FROM climw"),
    "climate_pivot": sql("climw", f"SELECT lake_id, lake_name, {day('date')} AS date, {_r(VARS, 9)} FROM climw"),
    "resample_7d": _resample("CAST(f + 7*(date_diff('day', f, date)//7) * INTERVAL 1 DAY AS DATE)", "7 DAY", _FIRST),
    "resample_wmon": _resample("CAST(date + ((8 - isodow(date))%7) * INTERVAL 1 DAY AS DATE)", "7 DAY"),
    "resample_month": _resample("CAST(date_trunc('month', date) AS DATE)", "1 MONTH"),
    "rolling_28d": sql("climo", f"SELECT lake_id, {day('date')} AS date, " + ", ".join(
        f"round(avg({v}) OVER (PARTITION BY lake_id ORDER BY date RANGE BETWEEN INTERVAL 27 DAY PRECEDING AND CURRENT ROW), 8) AS {v}"
        for v in VARS) + " FROM climo"),
    "rolling_1970": sql("climo", f"SELECT lake_id, {day('date - 9500')} AS date, " + ", ".join(
        f"round(avg({v}) OVER (PARTITION BY lake_id ORDER BY date RANGE BETWEEN INTERVAL 27 DAY PRECEDING AND CURRENT ROW), 8) AS {v}"
        for v in VARS) + " FROM climo"),
    "lake_pixels_mean": sql("inside pix parts", f"""SELECT i.lake_id, lake_name, {day("date_trunc('month', date)")} AS date,
        round(avg(CASE WHEN x%2=0 THEN CAST(ci AS DOUBLE) END), 9) AS tmin, round(avg(CASE WHEN x%2<>0 THEN CAST(ci AS DOUBLE) END), 9) AS tmax
        FROM pix JOIN inside i USING (y, x) JOIN parts p ON p.lake_id=i.lake_id GROUP BY 1, 2, 3"""),
    "zonal_polygon": sql("inside ok parts", f"""SELECT f.src, p.lake_id, round(avg(v), 9) AS CI_mean, round(quantile_cont(v, 0.9), 9) AS CI_p90,
        CAST(count(v) AS BIGINT) AS n_valid FROM (SELECT DISTINCT CAST(year(date) AS VARCHAR) AS src FROM pix) f CROSS JOIN parts p
        LEFT JOIN (SELECT i.lake_id, CAST(year(date) AS VARCHAR) AS src, v FROM ok JOIN inside i USING (y, x)) s
        ON s.src=f.src AND s.lake_id=p.lake_id GROUP BY 1, 2"""),
    "features_daily": sql("ev climw", f"""SELECT ev.lake_id, {stamp('ts')} AS date, round(m, 9) AS CI_mean, n AS n_valid, ok AS qc_is_valid,
        {_r(VARS, 9)} FROM ev LEFT JOIN climw c ON c.lake_id=ev.lake_id AND c.date=ev.d WHERE ok=1"""),
    "features_exact": sql("ev climw", f"""SELECT ev.lake_id, {stamp('ts')} AS date, round(m, 9) AS CI_mean, n AS n_valid, ok AS qc_is_valid,
        {_r(VARS, 9)} FROM ev LEFT JOIN climw c ON c.lake_id=ev.lake_id AND CAST(c.date AS TIMESTAMP)=ev.ts WHERE ok=1"""),
    "features_monthly": sql("obs climo", f"""SELECT o.lake_id, {day("o.d + INTERVAL 14 DAY")} AS date, round(m, 11) AS CI_mean, n AS n_valid,
        1 AS qc_is_valid, {_r(VARS, 8)} FROM (SELECT lake_id, date_trunc('month', date) AS d, avg(m) AS m, CAST(sum(n) AS BIGINT) AS n FROM obs GROUP BY 1, 2) o
        LEFT JOIN (SELECT lake_id, date_trunc('month', date) AS d, {", ".join(f"avg({v}) AS {v}" for v in VARS)} FROM climo GROUP BY 1, 2) c
        ON c.lake_id=o.lake_id AND c.d=o.d WHERE n%3<>0"""),
    "valid_row_counts": sql("qcv", "SELECT count(*) AS rows_before, CAST(sum(valid) AS BIGINT) AS rows_after FROM qcv"),
    "points_in_polygon": sql("inside", "SELECT lake_id, y, x FROM inside"),
    "polygon_bounds": sql("bnd", f"SELECT lake_id, {_r(('minx', 'miny', 'maxx', 'maxy'), 9)} FROM bnd"),
    "projected_bounds": sql("medge", """SELECT lake_id, round(min(least(x1,x2)),3) AS minx, round(min(least(y1,y2)),3) AS miny,
        round(max(greatest(x1,x2)),3) AS maxx, round(max(greatest(y1,y2)),3) AS maxy FROM medge GROUP BY lake_id"""),
    "expected_pixels": sql("medge", """SELECT lake_id, CAST(round_even(a/9e4, 0) AS BIGINT) AS expected_pixels_geom, lake_name, round(a/1e6, 3) AS area_km2
        FROM (SELECT lake_id, lake_name, sum(CASE WHEN ring=0 THEN a ELSE -a END) AS a FROM
        (SELECT lake_id, lake_name, ring, abs(sum(x1*y2-x2*y1))/2 AS a FROM medge GROUP BY 1, 2, 3) GROUP BY 1, 2)"""),
    "inset_membership": sql("medge grid bnd", f"""SELECT lake_id, y, x FROM (SELECT g.lake_id, y, x,
        sum(CASE WHEN (y1 > py) <> (y2 > py) AND px < (x2-x1)*(py-y1)/nullif(y2-y1,0)+x1 THEN 1 ELSE 0 END) AS hits,
        min((px-(x1+t*(x2-x1)))*(px-(x1+t*(x2-x1))) + (py-(y1+t*(y2-y1)))*(py-(y1+t*(y2-y1)))) AS d2 FROM
        (SELECT g.*, e.x1, e.y1, e.x2, e.y2, greatest(0e0, least(1e0, coalesce(((px-x1)*(x2-x1)+(py-y1)*(y2-y1))/
          nullif((x2-x1)*(x2-x1)+(y2-y1)*(y2-y1),0), 0e0))) AS t FROM
         (SELECT lake_id, y, x, {mx('lon', 'lat')} AS px, {my('lon', 'lat')} AS py FROM grid JOIN bnd
           ON lon BETWEEN minx AND maxx AND lat BETWEEN miny AND maxy) g JOIN medge e ON e.lake_id=g.lake_id) g GROUP BY 1, 2, 3)
        WHERE hits%2=1 AND sqrt(d2) >= 5000e0"""),
    "touching_parts": sql("hpts hedge hmedge", f"""SELECT *, 0e0 AS inset_km FROM ({_inside_outline('hpts', 'hedge', 'lon', 'lat')})
        UNION ALL SELECT *, 5e0 FROM ({_inside_outline('hpts', 'hmedge', 'px', 'py', inset=5000)})"""),
    "overlapping_parts": sql("hpts uedge umedge", f"""SELECT *, 0e0 AS inset_km FROM ({_inside_outline('hpts', 'uedge', 'lon', 'lat')})
        UNION ALL SELECT *, 5e0 FROM ({_inside_outline('hpts', 'umedge', 'px', 'py', inset=5000)})"""),
    "united_area": sql("umedge", """SELECT lake_id, CAST(round_even(a/9e4, 0) AS BIGINT) AS expected_pixels_geom, round(a/1e6, 3) AS area_km2
        FROM (SELECT lake_id, sum(x1*y2-x2*y1)/2 AS a FROM umedge GROUP BY 1)"""),
    "inset_chain": sql("edge grid bnd", f"""WITH pick AS (SELECT part, lake_name AS lake_id FROM ({_LAKE_PICK}) WHERE pick AND lake_name IN {_FIVE}),
        pe AS (SELECT p.lake_id, m.part, x1, y1, x2, y2 FROM edge m JOIN pick p USING (part)), {_union_ctes('pe', 'lake_id')},
        e AS (SELECT lake_id, {mx('x1', 'y1')} AS x1, {my('x1', 'y1')} AS y1, {mx('x2', 'y2')} AS x2, {my('x2', 'y2')} AS y2 FROM ({_union('pe', 'lake_id')})),
        b AS (SELECT p.lake_id, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM bnd JOIN pick p ON bnd.lake_id='L-' || part GROUP BY 1),
        g AS (SELECT lake_id, y, x, {mx('lon', 'lat')} AS px, {my('lon', 'lat')} AS py FROM grid JOIN b ON lon BETWEEN minx AND maxx AND lat BETWEEN miny AND maxy),
        a AS (SELECT lake_id, CAST(round_even(area/25e6, 0) AS BIGINT) AS expected_pixels_geom FROM ({_scanned('e', 'lake_id', 500, 3000)})),
        n AS (SELECT lake_id, count(*) AS members FROM ({_inside_outline('g', 'e', 'px', 'py', inset=3000)}) GROUP BY 1)
        SELECT 'GL-' || row_number() OVER (ORDER BY a.lake_id) AS lake_id, a.lake_id AS lake_name, expected_pixels_geom, members
        FROM a LEFT JOIN n USING (lake_id)""").replace(") WITH pick AS", "), pick AS", 1),
    "inset_area": sql("medge", f"SELECT lake_id, round(area/1e6, 3) AS area_km2 FROM ({_scanned('medge', 'lake_id', 200, 2000)})"),
    "inset_boxes": sql("medge", _inset_boxes("medge", 2000)).replace(") WITH tr AS", "), tr AS", 1),
    "box_intersects": sql("edge", _box_hits("edge", "lake_id", -92, 41, -84, 46)),
    "lake_candidates": sql("edge", f"SELECT part AS \"Hylak_id\", lake_name AS \"Lake_name\", country AS \"Country\" FROM ({_LAKE_PICK}) WHERE pick"),
    "lake_union_first": sql("edge", f"""SELECT part AS "Hylak_id", CASE WHEN country LIKE 'United States%' THEN 'country' ELSE 'box' END AS why
        FROM parts WHERE country LIKE 'United States%' OR part IN ({_box_hits('edge', 'part', -95, 40, -74, 49)})"""),
    "study_lakes": sql("medge", f"""SELECT 'GL-' || row_number() OVER (ORDER BY lake_name) AS lake_id, lake_name, count(*) AS parts,
        min(part) AS first_part, 300e0 AS inset_m FROM ({_LAKE_PICK}) WHERE pick AND lake_name IN {_FIVE} AND lake_name IN
        (SELECT lake_name FROM ({_lattice("(SELECT * FROM medge WHERE part IN (SELECT part FROM (" + _LAKE_PICK + ") WHERE pick))", "lake_name", 5000, 300)}))
        GROUP BY lake_name"""),
    "lake_labels": sql("expd", "SELECT lake_id, lake_id || ' - ' || lake_name AS label FROM expd"),
    "name_search": sql("parts", """SELECT lake_name AS "Lake_name", count(*) AS n FROM parts WHERE regexp_matches(lake_name, '(?i)superior|erie') GROUP BY 1"""),
    "manifest_daily": f"SELECT region, {day('date')} AS date, src FROM ({_EXPECTED})",
    "manifest_monthly": f"""SELECT region, {day('m')} AS date, 'S3B_OLCI_EFRNT.' || strftime(m, '%Y%m%d') || '_' || strftime(last_day(m), '%Y%m%d')
        || '.L3m.MO.' || {_TAIL} AS src FROM (SELECT region, CAST(unnest(generate_series(make_date(year(a),1,1), make_date(year(b),12,1), INTERVAL 1 MONTH))
        AS DATE) AS m FROM ({_SPANS})) WHERE month(m) BETWEEN 3 AND 10""",
    "manifest_audit": sql("pix", f"""SELECT e.src, {day('date')} AS date, CASE WHEN length > 0 THEN 'skip' WHEN day(date)%2=1 THEN 'get' ELSE 'miss' END AS action
        FROM ({_EXPECTED}) e LEFT JOIN ({_LISTING}) l ON l.src=e.src"""),
    "manifest_missing": sql("pix", f"""SELECT e.src, {day('date')} AS date FROM ({_EXPECTED}) e LEFT JOIN ({_LISTING}) l ON l.src=e.src
        WHERE coalesce(length, 0) = 0"""),
    "url_names": """SELECT page_id, CASE k WHEN 0 THEN 'daymet_v4_daily_na_' || v || '_2024.nc' WHEN 1 THEN 'daymet_v4_' || v || '_monavg_hi_2023.tif'
        ELSE split_part(regexp_extract(url, '[^/]*$'), '?', 1) END AS file,
        CASE WHEN k < 2 THEN v END AS variable, CASE k WHEN 0 THEN 'na' WHEN 1 THEN 'hi' END AS region,
        CASE WHEN k=1 THEN 'monavg' END AS summary, CASE k WHEN 0 THEN 2024e0 WHEN 1 THEN 2023e0 END AS year,
        CASE k WHEN 0 THEN 'nc' WHEN 1 THEN 'tif' END AS format FROM (SELECT *, page_id%4 AS k, (['tmin','vp','prcp'])[1+page_id%3] AS v FROM pages)""",
    "reader_status": sql("pix", """SELECT CASE WHEN day(date)%2=0 THEN 'primary' ELSE 'fallback' END AS engine, CAST(year(date) AS INTEGER) AS year,
        count(*) AS pixels FROM pix WHERE day(date)%5<>0 GROUP BY 1, 2"""),
    "file_audit": sql("obs", f"""SELECT src, engine, k AS n_dates, {day('a')} AS first, {day('b')} AS last, rows, n_lakes,
        CASE WHEN k=0 THEN 'NA' WHEN k=1 THEN {day('a')} ELSE {day('a')} || '→' || {day('b')} || ' (n=' || k || ')' END AS date_text FROM
        (SELECT strftime(date, '%Y%m') AS src, CASE WHEN n>2 THEN 'primary' ELSE 'fallback' END AS engine, count(DISTINCT date) AS k, min(date) AS a,
        max(date) AS b, count(*) AS rows, count(DISTINCT lake_id) AS n_lakes FROM obs GROUP BY 1, 2)"""),
    "table_profile": " UNION ALL ".join([
        _PROFILE_NUM.format(c="o_totalprice", v="o_totalprice"), _PROFILE_NUM.format(c="o_custkey", v="CAST(o_custkey AS DOUBLE)"),
        _PROFILE_NUM.format(c="o_orderdate", v="(epoch_us(o_orderdate)/864e8)"),
        _PROFILE_TEXT.format(c="o_orderpriority"), _PROFILE_TEXT.format(c="o_orderstatus"),
    ]),
    "chart_regional": sql("regq", f"""SELECT lake_id, {stamp('date')} AS date, round(m, 11) AS CI_mean, round({_centre('m', 'lake_id')}, 11) AS CI_mean_7,
        round({_centre('p', 'lake_id')}, 11) AS CI_p90_7 FROM regq"""),
    "chart_lake_daily": sql("qcv", f"""SELECT lake_id, lake_name AS title, {stamp('date')} AS date, round(m, 11) AS CI_mean,
        round({_centre('m', 'lake_id')}, 11) AS CI_mean_7, round({_centre('p', 'lake_id')}, 11) AS CI_p90_7, round(pg, 5) AS pct_valid_geom,
        CAST(count(m) OVER (PARTITION BY lake_id) > 0 AS INTEGER) AS "has_CI_mean", CAST(count(p) OVER (PARTITION BY lake_id) > 0 AS INTEGER) AS "has_CI_p90",
        CAST(count(pg) OVER (PARTITION BY lake_id) > 0 AS INTEGER) AS has_pct_valid_geom FROM qcv"""),
    "chart_lake_monthly": sql("qcv", f"""SELECT lake_id, lake_name AS title, {stamp('date')} AS date, round(m, 11) AS CI_mean, round(p, 11) AS CI_p90,
        CAST(count(m) OVER (PARTITION BY lake_id) > 0 AS INTEGER) AS "has_CI_mean", CAST(count(p) OVER (PARTITION BY lake_id) > 0 AS INTEGER) AS "has_CI_p90"
        FROM qcv WHERE valid=1"""),
    "facet_shading": sql("qcv", f"""SELECT CASE lake_id WHEN 'MACHINERY' THEN 0 WHEN 'BUILDING' THEN 1 ELSE 2 END AS ord, lake_id, lake_name AS title,
        {stamp('date')} AS date, round(coalesce(greatest(0e0, least(1e0, pg))*max(m) OVER (PARTITION BY lake_id)*0.2e0, 0e0), 11) AS coverage_height,
        round({_centre('m', 'lake_id')}, 11) AS CI_mean_7, round({_centre('p', 'lake_id')}, 11) AS CI_p90_7
        FROM qcv WHERE lake_id IN ('MACHINERY','BUILDING','AUTOMOBILE')"""),
    "validity_matrix": sql("ev", "SELECT lake_id || ' - Lake ' || substr(lake_id,4) AS label, " + ", ".join(
        f"max(CASE WHEN strftime(d, '%Y%m%d') = '202401{k:02}' THEN CAST(ok AS DOUBLE) END) AS d202401{k:02}" for k in range(1, 31)) + " FROM ev GROUP BY 1"),
    "validity_long": sql("qcv", f"SELECT lake_id || ' - ' || lake_name AS label, {day('date')} AS date, valid AS qc_is_valid FROM qcv"),
    "schema_complete": sql("obs", f"""SELECT lake_id, {stamp('date')} AS date, CAST(NULL AS VARCHAR) AS product, round(m, 11) AS CI_mean,
        CAST(NULL AS DOUBLE) AS CI_p90, n AS n_valid, CAST(NULL AS VARCHAR) AS src, CAST(NULL AS VARCHAR) AS engine FROM obs"""),
    "column_resolve": sql("obs", f"""SELECT lake_id, upper(lake_id[1]) || lower(lake_id[2:]) AS lake_name, {stamp('min(date)')} AS first,
        {stamp('max(date)')} AS last, CAST(sum(n) AS BIGINT) AS pixels FROM obs GROUP BY lake_id"""),
    "coordinate_names": sql("pix", """SELECT y, count(*) AS n, round(min(lon), 6) AS west, round(max(lon), 6) AS east, round(max(lat), 6) AS lat
        FROM pix GROUP BY y"""),
    "csv_round_trip": sql("obs", f"""SELECT lake_id || '/' || {day('date')} AS time, {_r(('m', 'p'), 11).replace('AS m', 'AS CI_mean').replace('AS p', 'AS CI_p90')},
        CASE WHEN day(date)%6<>0 THEN CAST(n AS DOUBLE) END AS n_valid FROM obs"""),
    "parquet_glob": sql("obs", """SELECT lake_id, count(*) AS rows, count(CASE WHEN day(date)%9<>0 THEN 1 END) AS n_mean, count(*) AS n_src FROM obs GROUP BY 1"""),
    "pixel_scan": sql("pix", """SELECT src, count(*) AS n, count(ci) AS n_value, round(sum(lon), 6) AS lon, round(sum(lat), 6) AS lat FROM pix GROUP BY 1"""),
    "polygon_round_trip": sql("bnd parts", f"""SELECT lake_id, CAST(4326 AS INTEGER) AS srid, CAST(CASE WHEN part%2=0 THEN 12 ELSE 4 END AS INTEGER) AS points,
        {_r(('minx', 'miny', 'maxx', 'maxy'), 9)} FROM bnd JOIN parts USING (lake_id)"""),
    "optional_input": """SELECT 'orders' AS name, CAST(count(*) AS DOUBLE) AS rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
        UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'no_such_table', NULL""",
    "sorted_rows": sql("obs", f"SELECT lake_id, {day('date')} AS date, n AS n_valid, row_number() OVER (ORDER BY lake_id, date) - 1 AS place FROM obs"),
    "numbered_rows": sql("pix", f"""SELECT {day('date')} AS date, count(*) AS rows, count(*) AS last, count(*) AS numbers, round(min(CAST(ci AS DOUBLE)), 9) AS lowest,
        CASE WHEN count(ci) < count(*) THEN count(ci) END AS first_missing FROM pix GROUP BY pix.date"""),
    "facet_first": sql("qcv", f"""SELECT lake_id, count(*) AS rows, {stamp('min(date)')} AS first, {stamp('max(date)')} AS last FROM qcv
        WHERE lake_id IN (SELECT DISTINCT lake_id FROM qcv ORDER BY 1 LIMIT 2) GROUP BY 1"""),
    "quality_defaults": sql("qc", """SELECT lake_id, count(*) AS rows, CAST(sum(g) AS BIGINT) AS qc_low_cov_geom, CAST(sum(e) AS BIGINT) AS qc_low_cov_emp,
        CAST(sum(t) AS BIGINT) AS qc_tiny_abs_pix, CAST(sum(CASE WHEN g + e + t > 0 THEN 0 ELSE 1 END) AS BIGINT) AS qc_is_valid FROM
        (SELECT lake_id, CAST(n*25e0/(exp_pix*100e0) < 0.1e0 AS INTEGER) AS g, CAST(n/CAST(nmax AS DOUBLE) < 0.1e0 AS INTEGER) AS e,
           CAST(n*25 < 50 AS INTEGER) AS t FROM qc) GROUP BY 1"""),
    "guarded_write": sql("obs", """SELECT 'all' AS name, 1::INTEGER AS written, count(*) AS rows FROM obs UNION ALL SELECT 'none', 0, 0"""),
    "column_difference": sql("obs", """SELECT lake_id, 2*count(*) AS rows, count(*) AS n_counts, count(*) AS n_means, 'engine,product,src' AS lacking
        FROM obs GROUP BY 1"""),
    "facet_all": sql("qcv", "SELECT lake_id, CAST(NULL AS DOUBLE) AS ord, count(*) AS rows FROM qcv GROUP BY 1"),
}

for _limit in (3, 1):
    _cal = CTES["cal"].replace("FROM thin", "FROM thin2").replace("JOIN thin t", "JOIN thin2 t")
    _cols = "round(m, 11) AS CI_mean, round(p, 11) AS CI_p90"
    ORACLES[f"interp_limit{_limit}"] = sql("obs", "").rstrip() + (
        f", thin2 AS (SELECT lake_id, date, CASE WHEN (dayofyear(date)*7)%11 < 5 THEN m END AS m, CASE WHEN (dayofyear(date)*7)%11 < 5 THEN p END AS p, n FROM obs), cal AS ({_cal}) "
        f"SELECT lake_id, {day('date')} AS date, {_cols} FROM ({_interp('cal', _limit)})"
    )

# monthly calendar: first day with orders of each month, empty months interpolated by one, clipped
CTES["mon"] = """SELECT lake_id, CAST(date_trunc('month', date) AS DATE) AS date, arg_min(m, date) AS m, arg_min(p, date) AS p
    FROM obs GROUP BY 1, 2"""
CTES["mcal"] = CTES["cal"].replace("1 DAY", "1 MONTH").replace("t.p, t.n,", "t.p,").replace("thin", "mon")
CTES["mfill"] = _interp("mcal", 1)
NEEDS |= {"mon": ["obs"], "mcal": ["mon"], "mfill": ["mcal"]}
ORACLES["chart_regional_monthly"] = sql("mfill", f"""SELECT lake_id, {stamp('date')} AS date, round({_clip('m', 'ml', 'mh')}, 11) AS CI_mean,
    round({_clip('p', 'pl', 'ph')}, 11) AS CI_p90 FROM mfill JOIN (SELECT lake_id, quantile_cont(m, 0.001) AS ml, quantile_cont(m, 0.999) AS mh,
    quantile_cont(p, 0.001) AS pl, quantile_cont(p, 0.999) AS ph FROM mfill GROUP BY 1) USING (lake_id)""")
