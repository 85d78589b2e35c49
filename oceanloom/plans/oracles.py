"""DuckDB SQL for the registered queries, written apart from the DataFrame plans."""

from __future__ import annotations

_BASE = """
base AS (SELECT o.o_orderkey k, o.o_totalprice tp, c.c_acctbal ab FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
nrows AS (SELECT CAST(floor(count(*)/416) AS INT) nj FROM orders),
q AS (SELECT CAST(k % 13 AS INT) face, CAST(floor(floor(k/13)/32) AS INT) j, CAST(CAST(floor(k/13) AS BIGINT) % 32 AS INT) i, tp, ab FROM base),
g AS (SELECT face, j, i, -1.8e0 + 32e0*(tp-1000e0)/500000e0 theta, 30e0 + 8e0*(ab+1000e0)/11000e0 salt,
  CASE WHEN face=7 AND i=31 AND j%5=0 THEN NULL WHEN face=5 THEN 0e0 WHEN face<>6 AND (j%12)<3 AND i BETWEEN 8 AND 13 THEN 0e0 ELSE 1e0 END hfacc,
  900e0 + 10e0*(i%7) + 5e0*(j%3) dxc, 950e0 + 10e0*(j%5) + 4e0*(i%4) dyc,
  (1e0-(face/13e0)*(face/13e0))/(1e0+(face/13e0)*(face/13e0)) cs, 2e0*(face/13e0)/(1e0+(face/13e0)*(face/13e0)) sn
  FROM q CROSS JOIN nrows WHERE j < nj)"""


def _grid(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([_BASE, *ctes]) + "\n" + select


def _bulk(s: str, t: str, p: str) -> str:
    return f"""(1.965933e4 + 1.444304e2*{t} - 1.706103e0*{t}*{t} + 9.648704e-3*{t}*{t}*{t} - 4.190253e-5*{t}*{t}*{t}*{t}
 + {s}*(5.284855e1 - 3.101089e-1*{t} + 6.283263e-3*{t}*{t} - 5.084188e-5*{t}*{t}*{t})
 + {s}*sqrt({s})*(3.886640e-1 + 9.085835e-3*{t} - 4.619924e-4*{t}*{t})
 + {p}*(3.186519e0 + 2.212276e-2*{t} - 2.984642e-4*{t}*{t} + 1.956415e-6*{t}*{t}*{t})
 + {p}*{s}*(6.704388e-3 - 1.847318e-4*{t} + 2.059331e-7*{t}*{t}) + {p}*{s}*sqrt({s})*1.480266e-4
 + {p}*{p}*(2.102898e-4 - 1.202016e-5*{t} + 1.394680e-7*{t}*{t})
 + {p}*{p}*{s}*(-2.040237e-6 + 6.128773e-8*{t} + 6.207323e-10*{t}*{t}))"""


def _rho(s: str, t: str) -> str:
    return f"""(999.842594e0 + 6.793952e-2*{t} - 9.095290e-3*{t}*{t} + 1.001685e-4*{t}*{t}*{t} - 1.120083e-6*{t}*{t}*{t}*{t} + 6.536332e-9*{t}*{t}*{t}*{t}*{t}
 + {s}*(8.244930e-1 - 4.089900e-3*{t} + 7.643800e-5*{t}*{t} - 8.246700e-7*{t}*{t}*{t} + 5.387500e-9*{t}*{t}*{t}*{t})
 + {s}*sqrt({s})*(-5.724660e-3 + 1.022700e-4*{t} - 1.654600e-6*{t}*{t}) + 4.831400e-4*{s}*{s})"""


def _u(*key: str) -> str:
    return "((('0x' || substr(md5(concat_ws(':', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in key) + ")), 1, 8))::BIGINT + 0.5e0) / 4294967296e0)"


_GX = "wi AS (SELECT *, (v - lag(v) OVER x)/dxc gx FROM f WINDOW x AS (PARTITION BY face, j ORDER BY i)),\n" \
      "ci AS (SELECT *, CASE WHEN lead(i) OVER x IS NULL THEN 0.5e0*gx ELSE 0.5e0*(gx + lead(gx) OVER x) END cx FROM wi WINDOW x AS (PARTITION BY face, j ORDER BY i)),\n" \
      "wj AS (SELECT *, (v - lag(v) OVER y)/dyc gy FROM ci WINDOW y AS (PARTITION BY face, i ORDER BY j)),\n" \
      "cj AS (SELECT *, CASE WHEN lead(j) OVER y IS NULL THEN 0.5e0*gy ELSE 0.5e0*(gy + lead(gy) OVER y) END cy FROM wj WINDOW y AS (PARTITION BY face, i ORDER BY j)),\n" \
      "gr AS (SELECT face, j, i, cx*cs - cy*sn zonal, cx*sn + cy*cs merid FROM cj)"  # fmt: skip

_SAMPLE = f"""smp AS (SELECT row_number() OVER (ORDER BY key DESC, face, j, i) sample_id, face, j, i FROM
 (SELECT face, j, i, 0.5e0*theta - ln(-ln({_u('face', 'j', 'i', '7')})) AS key FROM g WHERE hfacc > 0 AND theta IS NOT NULL ORDER BY key DESC, face, j, i LIMIT 50))"""


def _extent(axis: str, spacing: str, other: str, name: str) -> str:
    return f"""d_{name} AS (SELECT * FROM (SELECT face, {other} o, {axis} k, 0.5e0*({spacing} + lead({spacing}) OVER w)/1000e0 d, lead({axis}) OVER w nx FROM g WINDOW w AS (PARTITION BY face, {other} ORDER BY {axis})) WHERE nx IS NOT NULL),
r_{name} AS (SELECT s.sample_id, s.{axis} c, k, d FROM smp s JOIN d_{name} ON d_{name}.face = s.face AND o = s.{other}),
u_{name} AS (SELECT sample_id, sum(d) OVER (PARTITION BY sample_id ORDER BY k) cum FROM r_{name} WHERE k >= c),
l_{name} AS (SELECT sample_id, sum(d) OVER (PARTITION BY sample_id ORDER BY k DESC) cum FROM r_{name} WHERE k <= c),
n_{name} AS (SELECT s.sample_id, s.{axis} c, (SELECT count(*) FROM l_{name} l WHERE l.sample_id=s.sample_id AND cum < 3.5e0) lo0, (SELECT count(*) FROM l_{name} l WHERE l.sample_id=s.sample_id) ll,
 (SELECT count(*) FROM u_{name} u WHERE u.sample_id=s.sample_id AND cum < 3.5e0) hi0, (SELECT count(*) FROM u_{name} u WHERE u.sample_id=s.sample_id) lh FROM smp s),
m_{name} AS (SELECT sample_id, c, CASE WHEN lo0 = ll THEN hi0 ELSE lo0 END low, CASE WHEN lo0 <> ll AND hi0 = lh THEN lo0 ELSE hi0 END high FROM n_{name}),
e_{name} AS (SELECT m.sample_id, CAST(low AS INT) low, CAST(high AS INT) high, CASE WHEN low <= m.c THEN coalesce((SELECT sum(d) FROM r_{name} r WHERE r.sample_id = m.sample_id AND k BETWEEN m.c - low AND m.c + high - 1), 0e0) END real_km FROM m_{name} m)"""


_EI, _EJ = _extent("i", "dxc", "j", "i"), _extent("j", "dyc", "i", "j")
_BOUNDS = """sz AS (SELECT face, max(i)+1 ni, max(j)+1 nj FROM g GROUP BY face),
bd AS (SELECT *, CASE WHEN i_start < 0 THEN 'i_low' WHEN i_end > ni-1 THEN 'i_high' WHEN j_start < 0 THEN 'j_low' WHEN j_end > nj-1 THEN 'j_high' ELSE 'ok' END status FROM
 (SELECT s.sample_id, s.face, s.i - a.low i_start, s.i + a.high i_end, s.j - b.low j_start, s.j + b.high j_end, a.real_km real_km_w, b.real_km real_km_h, ni, nj
  FROM smp s JOIN e_i a USING (sample_id) JOIN e_j b USING (sample_id) JOIN sz ON sz.face = s.face))"""
_PIX = """px AS (SELECT sample_id, channel, g.j - j_start y, g.i - i_start x, CASE WHEN channel = 0 THEN CAST(theta AS FLOAT) ELSE CAST(salt AS FLOAT) END v
 FROM bd JOIN g ON g.face = bd.face AND g.j BETWEEN j_start AND j_end AND g.i BETWEEN i_start AND i_end CROSS JOIN (SELECT unnest([0, 1]) channel) WHERE status = 'ok')"""

_LIST = """ls AS (SELECT pos, CASE WHEN pos%11=3 THEN 'bucket/surface/other_' || nm WHEN pos%11=5 THEN 'bucket/surface/' || nm || '.tmp'
 WHEN pos%11=7 THEN 'bucket/surface/snap_f1_k0_iter_x99.json' ELSE 'bucket/surface/' || nm END path FROM
 (SELECT o_orderkey pos, 'snap_f' || (o_orderkey%13) || '_k0_iter_' || (10000+144*(o_orderkey%97)) || '.json' nm FROM orders)),
th AS (SELECT pos, path, CAST(regexp_extract(path, '/snap_f\\d+_k\\d+_iter_(\\d+)\\.json$', 1) AS BIGINT) iter FROM ls WHERE regexp_matches(path, '/snap_f\\d+_k\\d+_iter_\\d+\\.json$'))"""


def _hist(source: str, bins: int, low: str, high: str) -> str:
    """CTEs from ``source`` (a select of v) to h(bin, lo, hi, n)."""
    return f"""x AS ({source}), lm0 AS (SELECT {low} a, {high} b FROM x), lm AS (SELECT CASE WHEN a=b THEN a-0.5 ELSE a END a, CASE WHEN a=b THEN b+0.5 ELSE b END b FROM lm0),
cl AS (SELECT least(greatest(v, lm0.a), lm0.b) v FROM x, lm0 WHERE v IS NOT NULL),
cn AS (SELECT CAST(least(floor((v-a)/(b-a)*{bins}), {bins}-1) AS INT) bin, count(*) n FROM cl, lm GROUP BY 1),
h AS (SELECT CAST(r AS INT) bin, a + r*((b-a)/{bins}) lo, CASE WHEN r={bins}-1 THEN b ELSE a + (r+1)*((b-a)/{bins}) END hi, coalesce(n, 0) n FROM range({bins}) t(r) CROSS JOIN lm LEFT JOIN cn ON cn.bin = r)"""


_PRICE = "SELECT log10(l_extendedprice) v FROM lineitem"
_Q = lambda p: f"quantile_cont(v, {p})"
_PDF = lambda n: _hist(_PRICE, n, _Q(0.001), _Q(0.999))
_LINEAR = """bc AS (SELECT CAST(r AS INT) bin, CAST(trunc(1000 * ((1+99e0*r/9)/sum(1+99e0*r/9) OVER ())) AS INT) n FROM range(10) t(r))"""
_DRAWN = f"""dr AS (SELECT h.bin, CAST(d AS INT) draw, lo + {_u('h.bin', 'd', '{seed}')}*(hi-lo) v FROM bc JOIN h USING (bin), range(1, 1001) t(d) WHERE d <= bc.n)"""
_DENSITY = "SELECT bin, round(lo, 6) lo, round(hi, 6) hi, n, round(n/((sum(n) OVER ())*(hi-lo)), 6) density FROM h"

#: Seams of the test grid, both ways.
_LINKS = [
    (0, "i_high", 1, "i_low", False), (1, "j_high", 2, "j_low", False), (2, "i_high", 3, "j_low", True), (3, "j_high", 4, "i_high", False),
    (7, "i_high", 8, "i_high", True), (8, "j_low", 9, "j_low", True), (10, "j_low", 11, "i_low", True), (11, "j_high", 12, "i_low", False), (6, "i_low", 6, "i_high", False),
]
_SEAMS = (
    "lk AS (SELECT * FROM (VALUES " + ", ".join(f"({f}, '{a}', {t}, '{b}', {r}), ({t}, '{b}', {f}, '{a}', {r})" for f, a, t, b, r in _LINKS) + ") t(face, side, to_face, to_side, rev))",
    "sz AS (SELECT face, max(i) + 1 ni, max(j) + 1 nj FROM g GROUP BY face)",
    """ed AS (SELECT g.*, side, ni, nj, CASE WHEN side LIKE 'i%' THEN j ELSE i END a, CASE WHEN side LIKE 'i%' THEN nj ELSE ni END n FROM g JOIN sz USING (face),
 (VALUES ('i_low'), ('i_high'), ('j_low'), ('j_high')) t(side) WHERE (side = 'i_low' AND i = 0) OR (side = 'i_high' AND i = ni - 1) OR (side = 'j_low' AND j = 0) OR (side = 'j_high' AND j = nj - 1))""",
    """gh0 AS (SELECT lk.face, lk.side, lk.to_side, lk.rev, CASE WHEN rev THEN n - 1 - a ELSE a END a, theta, salt, CASE WHEN to_side LIKE 'i%' THEN dxc ELSE dyc END d FROM ed JOIN lk ON ed.face = lk.to_face AND ed.side = lk.to_side)""",
    """gh AS (SELECT gh0.*, ni, nj FROM gh0 JOIN sz USING (face) WHERE a >= 0 AND a < CASE WHEN side LIKE 'i%' THEN nj ELSE ni END)""",
)
_ACROSS = """wi AS (SELECT g.*, (g.theta - coalesce(lag(g.theta) OVER (PARTITION BY g.face, g.j ORDER BY g.i), lo.theta))/g.dxc gx, coalesce((hi.theta - g.theta)/hi.d, 0e0) hx FROM g JOIN sz USING (face)
 LEFT JOIN gh lo ON lo.face = g.face AND lo.side = 'i_low' AND g.i = 0 AND lo.a = g.j LEFT JOIN gh hi ON hi.face = g.face AND hi.side = 'i_high' AND g.i = sz.ni - 1 AND hi.a = g.j),
ci AS (SELECT *, 0.5e0*(gx + CASE WHEN lead(i) OVER x IS NULL THEN hx ELSE lead(gx) OVER x END) cx FROM wi WINDOW x AS (PARTITION BY face, j ORDER BY i)),
wj AS (SELECT g.*, (g.theta - coalesce(lag(g.theta) OVER (PARTITION BY g.face, g.i ORDER BY g.j), lo.theta))/g.dyc gy, coalesce((hi.theta - g.theta)/hi.d, 0e0) hy FROM ci g JOIN sz USING (face)
 LEFT JOIN gh lo ON lo.face = g.face AND lo.side = 'j_low' AND g.j = 0 AND lo.a = g.i LEFT JOIN gh hi ON hi.face = g.face AND hi.side = 'j_high' AND g.j = sz.nj - 1 AND hi.a = g.i),
cj AS (SELECT *, 0.5e0*(gy + CASE WHEN lead(j) OVER y IS NULL THEN hy ELSE lead(gy) OVER y END) cy FROM wj WINDOW y AS (PARTITION BY face, i ORDER BY j))"""


def _marched(steps: int, halo: float) -> list[str]:
    """The distance by steps over all cells at once, as many as a front needs to cross the halo."""
    two = "(wy*a + wx*b + sqrt(greatest((wy*a + wx*b)*(wy*a + wx*b) - (wy + wx)*(wy*a*a + wx*b*b - 1e0), 0e0)))/(wy + wx)"
    solved = f"""CASE WHEN a IS NULL THEN b + dx WHEN b IS NULL THEN a + dy
 WHEN (wy*a + wx*b)*(wy*a + wx*b) >= (wy + wx)*(wy*a*a + wx*b*b - 1e0) AND {two} >= greatest(a, b) THEN {two} ELSE least(a + dy, b + dx) END"""
    out = [
        "mk AS (SELECT g.face, j, i, NOT coalesce(hfacc > 0, false) m, dx, dy FROM g JOIN (SELECT face, avg(dxc)/1000 dx, avg(dyc)/1000 dy FROM g GROUP BY face) USING (face))",
        """st AS (SELECT *, CASE WHEN coalesce(lag(m) OVER x, false) OR coalesce(lead(m) OVER x, false) THEN 4e0/(dx*dx) ELSE 0e0 END + CASE WHEN coalesce(lag(m) OVER y, false) OR coalesce(lead(m) OVER y, false) THEN 4e0/(dy*dy) ELSE 0e0 END v
 FROM mk WINDOW x AS (PARTITION BY face, j ORDER BY i), y AS (PARTITION BY face, i ORDER BY j))""",
        "d0 AS (SELECT face, j, i, m, dx, dy, 1e0/(dx*dx) wx, 1e0/(dy*dy) wy, v > 0 fixed, CASE WHEN NOT m AND v > 0 THEN 1e0/sqrt(v) END d FROM st)",
    ]
    for k in range(steps):
        near = f"n{k} AS (SELECT *, least(lag(d) OVER y, lead(d) OVER y) a, least(lag(d) OVER x, lead(d) OVER x) b FROM d{k} WINDOW x AS (PARTITION BY face, j ORDER BY i), y AS (PARTITION BY face, i ORDER BY j))"
        out += [near, f"d{k + 1} AS (SELECT face, j, i, m, dx, dy, wx, wy, fixed, CASE WHEN m THEN NULL WHEN fixed THEN d ELSE least(d, {solved}) END d FROM n{k})"]
    return [*out, f"kept AS (SELECT face, j, i, NOT m AND coalesce(d >= {halo}, true) retained FROM d{steps})"]


def _thin(source: str, out: str, by: str, size: int) -> str:
    """CTEs from ``source({by}, v, w)`` to at most ``size`` weighted values of each group."""
    p = f"PARTITION BY {by}" if by else ""
    keys = f"{by}, " if by else ""
    return f"""{out}_a AS (SELECT {keys}v, w, sum(w) OVER ({p} ORDER BY v, w ROWS UNBOUNDED PRECEDING) u, sum(w) OVER ({p}) t FROM {source}),
{out}_b AS (SELECT {keys}v, w, u, least(CAST(floor((2*u - w)*{size}::DOUBLE/(2*t)) AS INT), {size} - 1) s FROM {out}_a),
{out}_c AS (SELECT {keys}v, s, u, sum(w) OVER x a, min(u - w) OVER x f FROM {out}_b WINDOW x AS (PARTITION BY {keys}s)),
{out} AS (SELECT {keys}min(CASE WHEN (u - f)*2 >= a THEN v END) v, any_value(a) w FROM {out}_c GROUP BY {keys}s)"""


ORACLES: dict[str, str] = {
    "scan_snapshot": _grid("SELECT CAST(10000 AS BIGINT) iter, face, j, i, round(theta, 6) theta, round(salt, 6) salt FROM g WHERE face IN (0, 5, 7)"),
    "scan_grid": _grid("SELECT face, j, i, dxc, dyc, hfacc, round(cs, 6) cs, round(sn, 6) sn FROM g"),
    "list_theta_files": "WITH " + _LIST + " SELECT pos, path, iter FROM th",
    "latest_iteration": "WITH " + _LIST + " SELECT pos, path, iter FROM th ORDER BY iter DESC, pos LIMIT 1",
    "last_listed_file": "WITH " + _LIST + " SELECT pos, path, iter FROM th ORDER BY pos DESC LIMIT 1",
    "flux_variables": _grid("SELECT CAST(10000 AS BIGINT) iter, face, j, i, round(theta*2, 6) KPPhbl, round(salt/2, 6) oceTAUX FROM g"),
    "read_stores": _grid("SELECT CAST(10000 AS BIGINT) iter, face, j, i, round(CASE WHEN face <= 7 THEN theta ELSE theta + 100 END, 6) theta FROM g WHERE face IN (0, 5, 7, 8, 12)"),
    "read_chunks": _grid("SELECT CAST(10000 AS BIGINT) iter, face, j, i, round(theta, 6) \"Theta\", hfacc \"hFacC\" FROM g WHERE face IN (0, 5, 7, 12) AND j BETWEEN 10 AND 300 AND i BETWEEN 3 AND 28"),
    "references": "SELECT CAST(n_nationkey AS INT) nation, true listed, n_name \"name\", CAST(n_regionkey AS INT) region FROM nation",
    "object_paths": "SELECT n_nationkey, 'bucket/f' || (n_nationkey % 13) || '/it_0000010000.json' path FROM nation",
    "merge_inner": _grid("SELECT face, j, i, round(theta, 6) theta, round(salt, 6) salt, CASE WHEN hfacc > 0 THEN 1e0 END maskc, coalesce(hfacc > 0, false) is_ocean FROM g WHERE (i + j) % 7 <> 0"),
    "merge_landmask": _grid("SELECT face, j, i, CASE WHEN (i + j) % 7 <> 0 THEN round(theta, 6) END theta, CASE WHEN (i + j) % 7 <> 0 THEN round(salt, 6) END salt, CASE WHEN hfacc > 0 THEN 1e0 END maskc, coalesce(hfacc > 0, false) is_ocean FROM g"),
    "density_surface": _grid(f"SELECT face, j, i, round({_rho('salt', 'theta')}, 6) rho FROM g"),
    "density_pressure": _grid(f"SELECT face, j, i, round({_rho('salt', 'theta')}/(1e0 - (j*50e0*0.1e0)/{_bulk('salt', 'theta', '(j*50e0*0.1e0)')}), 6) rho FROM g"),
    "bulk_modulus": _grid(f"SELECT face, j, i, round({_bulk('salt', 'theta', '(j*5e0)')}, 6) k FROM g"),
    "buoyancy": _grid(f"SELECT face, j, i, round(0.0098e0*{_rho('salt', 'theta')}/1025e0*1e3, 6) b FROM g"),
    "negative_salinity": _grid("SELECT count(*) FILTER (salt - 34e0 < 0) negative_salinity FROM g"),
    "observed_negative_salinity": _grid("SELECT count(*) FILTER (salt - 34e0 < 0) negative_salinity FROM g"),
    "gradient_attributes": _grid("SELECT 'zonal' \"name\", 'zonal gradient of potential temperature' long_name, 'K/m' units, count(zonal) n FROM gr UNION ALL SELECT 'merid', 'meridional gradient of potential temperature', 'K/m', count(merid) FROM gr", "f AS (SELECT *, theta v FROM g)", _GX),
    "merge_conflicts": _grid("SELECT face, j, i FROM g WHERE (i + j) % 10 = 0"),
    "negative_salinity_faces": _grid("SELECT face, bool_or(salt - 30e0 - face/1000e0 < 0) any_negative FROM g GROUP BY face"),
    "diff_x": _grid("SELECT face, j, i, round(theta - lag(theta) OVER (PARTITION BY face, j ORDER BY i), 6) d FROM g"),
    "diff_y": _grid("SELECT face, j, i, round(coalesce(theta - lag(theta) OVER (PARTITION BY face, i ORDER BY j), 0e0), 6) d FROM g"),
    "interp_fill": _grid("SELECT face, j, i, round(0.5e0*(theta + coalesce(lead(theta) OVER (PARTITION BY face, j ORDER BY i), 0e0)), 6) m FROM g"),
    "gradient_native": _grid("SELECT face, j, i, round(zonal*1e3, 6) zonal, round(merid*1e3, 6) merid FROM gr", "f AS (SELECT *, theta v FROM g)", _GX),
    "gradient_linked": _grid("SELECT face, j, i, round((cx*cs - cy*sn)*1e3, 6) zonal, round((cx*sn + cy*cs)*1e3, 6) merid FROM cj", *_SEAMS, _ACROSS),
    "seam_vectors": _grid("""SELECT face, CAST(CASE side WHEN 'j_low' THEN -1 WHEN 'j_high' THEN nj ELSE a END AS INT) j, CAST(CASE side WHEN 'i_low' THEN -1 WHEN 'i_high' THEN ni ELSE a END AS INT) i, side,
 round(CASE side WHEN 'i_low' THEN -inw WHEN 'i_high' THEN inw ELSE alo END, 6) theta, round(CASE side WHEN 'j_low' THEN -inw WHEN 'j_high' THEN inw ELSE alo END, 6) salt FROM
 (SELECT *, CASE to_side WHEN 'i_low' THEN theta WHEN 'i_high' THEN -theta WHEN 'j_low' THEN salt ELSE -salt END inw, CASE WHEN rev THEN -1e0 ELSE 1e0 END * CASE WHEN to_side LIKE 'i%' THEN salt ELSE theta END alo FROM gh)""", *_SEAMS),
    "halo_mask_fmm": _grid("SELECT face, j, i, retained FROM kept", *_marched(10, 2.2)),
    "grad_squared": _grid("SELECT face, count(zonal*zonal+merid*merid) n, round(max((zonal*zonal+merid*merid)*1e9), 6) g2_max, round(avg((zonal*zonal+merid*merid)*1e9), 6) g2_mean FROM gr GROUP BY face",
                          f"f AS (SELECT *, 0.0098e0*{_rho('salt', 'theta')}/1025e0*1e4 v FROM g)", _GX),
    "compute_pdf": "WITH " + _PDF(200) + " SELECT bin, round(lo, 6) lo, round(hi, 6) hi, n, round(n/sum(n) OVER (), 6) pdf, round(sum(n) OVER (ORDER BY bin)/sum(n) OVER (), 6) cdf FROM h",
    "approximate_quantiles": "SELECT true low_ok, true high_ok",
    "quantile_summaries": _grid("""SELECT share, round(v, 6) v, round(greatest(avg(CAST(theta < v AS INT)) - share, share - avg(CAST(theta <= v AS INT)), 0e0), 6) error FROM lim, g GROUP BY share, v""",
        "q0 AS (SELECT face, floor(j/24) jb, floor(i/24) ib, theta v, 1 w FROM g)", _thin("q0", "q1", "face, jb, ib", 64), _thin("q1", "q2", "face", 64), _thin("q2", "q3", "", 64),
        "cu AS (SELECT v, sum(w) OVER (ORDER BY v) u, sum(w) OVER () t FROM q3)", "lim AS (SELECT share, min(v) v FROM cu, (SELECT unnest([0.01e0, 0.1e0, 0.5e0, 0.9e0, 0.99e0]) share) WHERE u >= share*t GROUP BY share)"),
    "log_range": "SELECT round(quantile_cont(log10(abs(l_discount)), 0.01), 6) vmin, round(quantile_cont(log10(abs(l_discount)), 0.99), 6) vmax FROM lineitem WHERE abs(l_discount) > 0",
    "density_hist": "WITH " + _hist("SELECT abs(value) v FROM events WHERE abs(value) > 0", 200, "min(v)", "max(v)") + " " + _DENSITY,
    "log_density_hist": "WITH " + _hist("SELECT log10(abs(value)) v FROM events WHERE abs(value) > 0", 200, "min(v)", "max(v)") + " " + _DENSITY,
    "face_minmax": _grid("SELECT face, round(min(theta), 6) vmin, round(max(theta), 6) vmax, count(theta) n FROM g GROUP BY face"),
    "face_mean_spacing": _grid("SELECT face, round(avg(dxc)/1000, 6) dx_km, round(avg(dyc)/1000, 6) dy_km FROM g GROUP BY face"),
    "size_estimate": _grid("SELECT count(*) AS \"rows\", count(*)*52 bytes FROM g"),
    "mosaic_layout": _grid("SELECT face, n, CAST(r AS INT) slot_row, CAST(c AS INT) slot_col, CAST(r*5+c AS INT) slot FROM (VALUES (0,4,0),(1,3,0),(2,2,0),(3,4,1),(4,3,1),(5,2,1),(6,1,1),(7,1,2),(8,1,3),(9,1,4),(10,0,2),(11,0,3),(12,0,4)) t(face, r, c) JOIN (SELECT face, count(*) n FROM g GROUP BY face) USING (face)"),
    "log_field_mosaic": _grid("""SELECT g.face, j, i, CAST(slot AS INT) slot, round(CASE WHEN abs(theta) > 0 THEN log10(abs(theta)) END, 6) log_v, round(a, 6) vmin, round(b, 6) vmax FROM g
 JOIN (VALUES (0,20),(1,15),(2,10),(3,21),(4,16),(5,11),(6,6),(7,7),(8,8),(9,9),(10,2),(11,3),(12,4)) t(face, slot) ON t.face = g.face,
 (SELECT quantile_cont(log10(abs(theta)), 0.01) a, quantile_cont(log10(abs(theta)), 0.99) b FROM g WHERE abs(theta) > 0)"""),
    "face_slice": _grid("SELECT face, j, i, round(theta, 6) theta FROM g WHERE face = 7"),
    "face_two_vars": _grid("SELECT face, j, i, round(theta, 6) left_v, round(salt, 6) right_v FROM g WHERE face = 7"),
    "halo_mask_euclid": _grid("""SELECT c.face, c.j, c.i, NOT c.m AND NOT EXISTS (SELECT 1 FROM ip JOIN sp USING (face) WHERE ip.face = c.face AND ip.pj BETWEEN 2*c.j-6 AND 2*c.j+6 AND ip.pi BETWEEN 2*c.i-6 AND 2*c.i+6
 AND sqrt(((c.j-pj/2e0)*dy)*((c.j-pj/2e0)*dy) + ((c.i-pi/2e0)*dx)*((c.i-pi/2e0)*dx)) < 2.2e0) retained FROM mk c""",
        "mk AS (SELECT face, j, i, NOT coalesce(hfacc > 0, false) m FROM g)", "sp AS (SELECT face, avg(dxc)/1000 dx, avg(dyc)/1000 dy FROM g GROUP BY face)",
        "ip AS (SELECT a.face, a.j+b.j pj, a.i+b.i pi FROM mk a JOIN mk b ON a.face=b.face AND ((a.j=b.j AND b.i=a.i+1) OR (a.i=b.i AND b.j=a.j+1)) WHERE a.m <> b.m)"),
    "weighted_sample": _grid("SELECT sample_id, face, j, i FROM smp", _SAMPLE),
    "weighted_sample_half": _grid(f"""SELECT row_number() OVER (ORDER BY key DESC, face, j, i) sample_rank, face, j, i FROM
 (SELECT face, j, i, 0.5e0*theta - ln(-ln({_u('face', 'j', 'i', '7')})) AS key FROM g WHERE theta IS NOT NULL) QUALIFY sample_rank <= (SELECT count(*)//2 FROM g)"""),
    "weighted_sample_by_column": _grid(f"""SELECT row_number() OVER (ORDER BY key DESC, face, j, i) sample_rank, face, j, i FROM
 (SELECT face, j, i, CASE WHEN face < 6 THEN 0.25e0 ELSE 0.75e0 END*(theta - (SELECT min(theta) FROM g)) - ln(-ln({_u('face', 'j', 'i', '7')})) AS key FROM g WHERE theta IS NOT NULL ORDER BY key DESC, face, j, i LIMIT 50)"""),
    "sample_weights": _grid("SELECT face, j, i, round(w, 6) w, round(w/sum(w) OVER ()*1e6, 6) p FROM (SELECT face, j, i, exp(0.5e0*(theta - min(theta) OVER ())) w FROM g)"),
    "uniform_sample": _grid(f"SELECT face, j, i FROM g ORDER BY {_u('face', 'j', 'i', '7')}, face, j, i LIMIT 50"),
    "linear_bin_counts": "WITH " + _PDF(10) + ", " + _LINEAR + " SELECT bin, bc.n, h.n held FROM bc JOIN h USING (bin)",
    "linear_sample": "WITH " + _PDF(10) + ", " + _LINEAR + ", " + _DRAWN.format(seed="7") + " SELECT bin, draw, round(v, 6) v FROM dr",
    "inverse_transform_sample": "WITH " + _PDF(50) + f""", cd AS (SELECT *, sum(n) OVER (ORDER BY bin)/sum(n) OVER () cdf FROM h), bb AS (SELECT bin, lo, hi, coalesce(lag(cdf) OVER (ORDER BY bin), -1) bl, CASE WHEN bin=49 THEN 2e0 ELSE cdf END up FROM cd),
 uu AS (SELECT d draw, {_u('d', '1', '7')} u1, {_u('d', '2', '7')} u2 FROM range(500) t(d)) SELECT draw, bin, round(lo + u2*(hi-lo), 6) v FROM uu JOIN bb ON u1 > bl AND u1 <= up""",
    "sample_on_pdf": "WITH " + _PDF(10) + ", " + _LINEAR + ", " + _DRAWN.format(seed="7") + f" SELECT bin, draw, round(v, 6) v FROM dr ORDER BY {_u('bin', 'draw', '8')}, bin, draw LIMIT 100",
    "first_match_tolerance": """WITH s AS (SELECT p_partkey sample_id, p_retailprice + CASE WHEN p_partkey % 2 = 0 THEN 0e0 ELSE 1e7 END s FROM part)
 SELECT sample_id, s, min(p_partkey) "match" FROM s LEFT JOIN part ON abs(p_retailprice - s) < 0.01 GROUP BY ALL""",
    "extent_i": _grid("SELECT sample_id, low, high, round(real_km, 6) real_km FROM e_i", _SAMPLE, _EI),
    "extent_j": _grid("SELECT sample_id, low, high, round(real_km, 6) real_km FROM e_j", _SAMPLE, _EJ),
    "patch_bounds": _grid("SELECT sample_id, face, i_start, i_end, j_start, j_end, round(real_km_w, 6) real_km_w, round(real_km_h, 6) real_km_h FROM bd WHERE status = 'ok'", _SAMPLE, _EI, _EJ, _BOUNDS),
    "patch_rejects": _grid("SELECT status, count(*) n FROM bd GROUP BY status", _SAMPLE, _EI, _EJ, _BOUNDS),
    "image_pixels": _grid("SELECT sample_id, channel, y, x, round(CAST(v AS DOUBLE), 6) v FROM px", _SAMPLE, _EI, _EJ, _BOUNDS, _PIX),
    "image_dataset_records": _grid("""SELECT smp.sample_id, smp.face, smp.j, smp.i, CASE WHEN status = 'ok' AND (j_end - j_start < 3 OR i_end - i_start < 3) THEN 'small' ELSE status END status, round(smp.v, 6) v, n_pixels, mean
 FROM smp JOIN bd USING (sample_id) LEFT JOIN (SELECT sample_id, count(v) n_pixels, round(avg(CAST(v AS DOUBLE)), 4) mean FROM
 (SELECT sample_id, ky, kx, CAST(CASE WHEN count(v) = count(*) THEN avg(CAST(v AS DOUBLE)) END AS FLOAT) v
 FROM px JOIN (SELECT sample_id, max(y)+1 h, max(x)+1 w FROM px GROUP BY 1) USING (sample_id), range(4) a(ky), range(4) b(kx)
 WHERE channel = 0 AND h >= 4 AND w >= 4 AND y >= ky*h//4 AND y < ((ky+1)*h+3)//4 AND x >= kx*w//4 AND x < ((kx+1)*w+3)//4 GROUP BY sample_id, ky, kx) GROUP BY sample_id) USING (sample_id)""",
        f"f AS (SELECT *, 0.0098e0*{_rho('salt', 'theta')}/1025e0*1e4 v FROM g)", _GX, *_marched(10, 2.2),
        f"""smp AS (SELECT row_number() OVER (ORDER BY key DESC, face, j, i) sample_id, face, j, i, v FROM
 (SELECT face, j, i, v, 0.5e0*v - ln(-ln({_u('face', 'j', 'i', '7')})) AS key FROM (SELECT face, j, i, log10(zonal*zonal + merid*merid) v FROM gr WHERE zonal*zonal + merid*merid > 0) JOIN kept USING (face, j, i) WHERE retained ORDER BY key DESC, face, j, i LIMIT 50))""",
        _EI, _EJ, _BOUNDS, _PIX),
    "image_blocks": _grid("SELECT sample_id, channel, y, x, round(CAST(v AS DOUBLE), 6) v FROM px", _SAMPLE, _EI, _EJ, _BOUNDS, _PIX),
    "image_tensor_pixels": _grid("SELECT sample_id, channel, y, x, round(CAST(v AS DOUBLE), 6) v FROM px", _SAMPLE, _EI, _EJ, _BOUNDS, _PIX),
    "image_downsample": _grid("""SELECT sample_id, channel, CAST(ky AS INT) y, CAST(kx AS INT) x, round(CAST(CAST(CASE WHEN count(v) = count(*) THEN avg(CAST(v AS DOUBLE)) END AS FLOAT) AS DOUBLE), 4) v
 FROM px JOIN (SELECT sample_id, max(y)+1 h, max(x)+1 w FROM px GROUP BY 1) USING (sample_id), range(4) a(ky), range(4) b(kx)
 WHERE h >= 4 AND w >= 4 AND y >= ky*h//4 AND y < ((ky+1)*h+3)//4 AND x >= kx*w//4 AND x < ((kx+1)*w+3)//4 GROUP BY ALL""", _SAMPLE, _EI, _EJ, _BOUNDS, _PIX),
    "image_downsample_pixels": _grid("""SELECT sample_id, channel, CAST(ky AS INT) y, CAST(kx AS INT) x, round(CAST(CAST(CASE WHEN count(v) = count(*) THEN avg(CAST(v AS DOUBLE)) END AS FLOAT) AS DOUBLE), 4) v
 FROM px JOIN (SELECT sample_id, max(y)+1 h, max(x)+1 w FROM px GROUP BY 1) USING (sample_id), range(4) a(ky), range(4) b(kx)
 WHERE h >= 4 AND w >= 4 AND y >= ky*h//4 AND y < ((ky+1)*h+3)//4 AND x >= kx*w//4 AND x < ((kx+1)*w+3)//4 GROUP BY ALL""", _SAMPLE, _EI, _EJ, _BOUNDS, _PIX),
    "image_tensor": _grid("""SELECT sample_id, CAST(max(channel)+1 AS INT) c, CAST(max(ky)+1 AS INT) h, CAST(max(kx)+1 AS INT) w, string_agg(coalesce(CAST(CAST(round(CAST(v AS DOUBLE)*1e3) AS BIGINT) AS VARCHAR), '-'), ',' ORDER BY channel, ky, kx) AS data FROM
 (SELECT sample_id, channel, ky, kx, CAST(CASE WHEN count(v) = count(*) THEN avg(CAST(v AS DOUBLE)) END AS FLOAT) v
 FROM px JOIN (SELECT sample_id, max(y)+1 h, max(x)+1 w FROM px GROUP BY 1) USING (sample_id), range(4) a(ky), range(4) b(kx)
 WHERE h >= 4 AND w >= 4 AND y >= ky*h//4 AND y < ((ky+1)*h+3)//4 AND x >= kx*w//4 AND x < ((kx+1)*w+3)//4 GROUP BY sample_id, channel, ky, kx) GROUP BY sample_id""", _SAMPLE, _EI, _EJ, _BOUNDS, _PIX),
    "metadata_stream": "SELECT event_type, count(*) n, count(DISTINCT event_id) n_ids, round(sum(value), 3) total FROM events GROUP BY 1",
    "metadata_union": "SELECT event_type, count(*) n, count(CASE WHEN event_id % 2 = 1 THEN value END) with_value FROM events GROUP BY 1",
    "metadata_records": "SELECT CAST(n_nationkey AS BIGINT) nation, n_name \"name\", CASE WHEN n_nationkey % 3 <> 0 THEN CASE WHEN n_nationkey < 14 THEN n_nationkey ELSE n_nationkey + 0.5e0 END END size FROM nation",
    "metadata_append": "SELECT event_type, count(*) n, count(CASE WHEN event_id % 2 = 1 THEN value END) with_value FROM events GROUP BY 1",
    "hash_uniform": _grid(f"SELECT face, j, i, round({_u('face', 'j', 'i', '7')}, 6) u FROM g"),
}
