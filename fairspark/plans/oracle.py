"""DuckDB SQL for each registered query, written independently of the Spark code.

The nearest centre is the first index reaching the least distance (a CASE
scan); the fixed costs are a second pass against the group means; the gamma
search is a recursive CTE over one row of per-centre parameters.  Centres of a
later step are read from the previous step's CTE with scalar subqueries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from .tables import OFF_HALVES, P2_CENTERS, P2_FAR_CENTER, P2_FAR_CENTERS, P64_DIM, PART_CENTERS, PRICE_SCALE, TABLE_CENTERS, UNBALANCED_QTY

def lit(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


def r6(e: str) -> str:
    return f"round({e}, 6)"


# above this many coordinates a distance is a left fold over two lists, which
# keeps the coordinate order of the sum without a deep expression tree
LIST_DIM = 8


def list_dist(xs: str, cs: str) -> str:
    return (f"list_reduce(list_transform(list_zip({xs}, {cs}), "
            f"lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda u, v: u + v)")


def dist(xs: Sequence[str], cs: Sequence[str]) -> str:
    if len(xs) > LIST_DIM:
        return list_dist("[" + ", ".join(xs) + "]", "[" + ", ".join(cs) + "]")
    return "(" + " + ".join(f"({x} - {c}) * ({x} - {c})" for x, c in zip(xs, cs)) + ")"


class CenterRef:
    """SQL for centre coordinates: one coordinate, or the whole vector as a list."""

    def __init__(self, coord: Callable[[int, int], str], vec: Callable[[int], str] | None = None):
        self.coord = coord
        self._vec = vec

    def __call__(self, i: int, j: int) -> str:
        return self.coord(i, j)

    def vec(self, i: int, dim: int) -> str:
        if self._vec is not None:
            return self._vec(i)
        return "[" + ", ".join(self.coord(i, j) for j in range(dim)) + "]"


# ---------------------------------------------------------------- sources

LINES = r"""
lines AS (
  SELECT doc_id, CAST(generate_subscripts(ls, 1) - 1 AS INTEGER) AS line_no, unnest(ls) AS value
  FROM (SELECT doc_id,
               CASE WHEN text = '' THEN []::VARCHAR[]
                    ELSE regexp_split_to_array(regexp_replace(text, '(\r\n|\r|\n)\z', ''),
                                               '\r\n|\r|\n') END AS ls
        FROM documents WHERE text IS NOT NULL)
),
toks AS (
  SELECT doc_id, line_no, unnest(
           CASE WHEN value = '' THEN ['']
                WHEN rtrim(value) = '' THEN []::VARCHAR[]
                ELSE string_split(rtrim(value), ' ') END) AS word
  FROM lines
)"""

P2_GROUP = {
    "balanced": "CASE WHEN l_linestatus = 'F' THEN 'A' ELSE 'B' END",
    "unbalanced": f"CASE WHEN l_quantity <= {lit(UNBALANCED_QTY)} THEN 'A' ELSE 'B' END",
}


def p2_points_sql(grouping: str = "unbalanced") -> str:
    return (f"SELECT l_orderkey, l_linenumber, l_quantity AS x0, "
            f"l_extendedprice / {lit(PRICE_SCALE)} AS x1, {P2_GROUP[grouping]} AS grp FROM lineitem")


def p64_points_sql() -> str:
    xs = ", ".join(f"CAST(embedding[{j + 1}] AS DOUBLE) AS x{j}" for j in range(P64_DIM))
    return (f"SELECT vec_id, {xs}, CASE WHEN label % 2 = 0 THEN 'A' ELSE 'B' END AS grp "
            f"FROM embeddings")


P64_CENTERS_CTE = """
cen AS (
  SELECT row_number() OVER (ORDER BY e.label) - 1 AS cid, e.embedding
  FROM embeddings e
  WHERE e.vec_id IN (SELECT min(vec_id) FROM embeddings GROUP BY label)
)"""


p64_center = CenterRef(
    lambda i, j: f"(SELECT CAST(embedding[{j + 1}] AS DOUBLE) FROM cen WHERE cid = {i})",
    lambda i: f"(SELECT list_transform(embedding, lambda v: CAST(v AS DOUBLE)) FROM cen WHERE cid = {i})")


def literal_centers(centers) -> CenterRef:
    return CenterRef(lambda i, j: lit(centers[i][j]))


def cte_centers(name: str, dim: int | None = None) -> CenterRef:
    vec = None
    if dim is not None:
        vec = lambda i: (f"(SELECT [" + ", ".join(f"c{j}" for j in range(dim))
                         + f"] FROM {name} WHERE cid = {i})")
    return CenterRef(lambda i, j: f"(SELECT c{j} FROM {name} WHERE cid = {i})", vec)


# ---------------------------------------------------------------- assignment

def assign_cte(name: str, src: str, dim: int, k: int, center: CenterRef,
               keep: Sequence[str] = ()) -> str:
    xs = [f"x{j}" for j in range(dim)]
    if dim > LIST_DIM:
        xl = "[" + ", ".join(xs) + "]"
        ds = ", ".join(f"{list_dist(xl, center.vec(i, dim))} AS d{i}" for i in range(k))
    else:
        ds = ", ".join(f"{dist(xs, [center(i, j) for j in range(dim)])} AS d{i}" for i in range(k))
    least = "least(" + ", ".join(f"d{i}" for i in range(k)) + ")" if k > 1 else "d0"
    case = "CASE " + " ".join(f"WHEN d{i} = m THEN {i}" for i in range(k)) + " END"
    cols = ", ".join([*keep, *xs, "grp"])
    return (f"{name} AS (SELECT {cols}, m AS d2, {case} AS cid FROM "
            f"(SELECT *, {least} AS m FROM (SELECT {cols}, {ds} FROM {src})))")


# ---------------------------------------------------------------- one fair step

def fair_step_ctes(p: str, assigned: str, dim: int, k: int, steps: int = 10) -> tuple[list[str], str]:
    """CTEs of one fair step over ``assigned`` (x0.., grp, cid); returns (ctes, centres CTE)."""
    sa = ", ".join(f"sum(x{j}) FILTER (WHERE grp = 'A') AS sa{j}, "
                   f"sum(x{j}) FILTER (WHERE grp = 'B') AS sb{j}" for j in range(dim))
    g = (f"{p}_g AS (SELECT cid, count(*) FILTER (WHERE grp = 'A') AS n_a, "
         f"count(*) FILTER (WHERE grp = 'B') AS n_b, {sa} FROM {assigned} GROUP BY cid)")
    means = ", ".join(
        f"CASE WHEN n_a > 0 THEN sa{j} / n_a ELSE sb{j} / n_b END AS ma{j}, "
        f"CASE WHEN n_b > 0 THEN sb{j} / n_b ELSE sa{j} / n_a END AS mb{j}" for j in range(dim))
    ma = [f"ma{j}" for j in range(dim)]
    mb = [f"mb{j}" for j in range(dim)]
    xs = [f"x{j}" for j in range(dim)]
    m = (f"{p}_m AS (SELECT cid, n_a, n_b, {means}, sqrt({dist(ma, mb)}) AS ell FROM {p}_g)")
    t = f"{p}_t AS (SELECT sum(n_a) AS na, sum(n_b) AS nb FROM {p}_m)"
    f = (f"{p}_f AS (SELECT sum(CASE WHEN a.grp = 'A' THEN {dist(['a.' + x for x in xs], ['m.' + y for y in ma])} END)"
         f" / (SELECT na FROM {p}_t) AS fa, "
         f"sum(CASE WHEN a.grp = 'B' THEN {dist(['a.' + x for x in xs], ['m.' + y for y in mb])} END)"
         f" / (SELECT nb FROM {p}_t) AS fb FROM {assigned} a JOIN {p}_m m ON a.cid = m.cid)")
    qcols = ", ".join(
        f"max(CASE WHEN cid = {i} THEN n_a / (SELECT na FROM {p}_t) END) AS a{i}, "
        f"max(CASE WHEN cid = {i} THEN n_b / (SELECT nb FROM {p}_t) END) AS b{i}, "
        f"max(CASE WHEN cid = {i} THEN ell END) AS l{i}" for i in range(k))
    q = f"{p}_q AS (SELECT {qcols}, (SELECT fa FROM {p}_f) AS fa0, (SELECT fb FROM {p}_f) AS fb0 FROM {p}_m)"

    def qv(name: str) -> str:
        return f"(SELECT {name} FROM {p}_q)"

    def x_of(gexpr: str, i: int) -> str:
        a, b, l = qv(f"a{i}"), qv(f"b{i}"), qv(f"l{i}")
        one = lit(1.0)
        return f"(({one} - {gexpr}) * {b} * {l} / ({gexpr} * {a} + ({one} - {gexpr}) * {b}))"

    present = range(k)
    fa = qv("fa0")
    fb = qv("fb0")
    for i in present:
        xi = x_of("g", i)
        fa = f"({fa} + {qv(f'a{i}')} * {xi} * {xi})"
        fb = f"({fb} + {qv(f'b{i}')} * ({qv(f'l{i}')} - {xi}) * ({qv(f'l{i}')} - {xi}))"
    ls = (f"{p}_ls(t, g, pw, done, ge) AS ("
          f"SELECT 0, {lit(0.5)}, {lit(0.5)}, false, CAST(NULL AS DOUBLE) "
          f"UNION ALL "
          f"SELECT t + 1, CASE WHEN fa = fb THEN g WHEN fa > fb THEN g + pw / 2 ELSE g - pw / 2 END, "
          f"pw / 2, fa = fb, g FROM (SELECT t, g, pw, {fa} AS fa, {fb} AS fb FROM {p}_ls "
          f"WHERE t < {steps} AND NOT done))")
    xcols = ", ".join(f"{x_of('ge', i)} AS x{i}" for i in present)
    x = f"{p}_x AS (SELECT ge AS gamma, {xcols} FROM {p}_ls WHERE t = (SELECT max(t) FROM {p}_ls))"
    xcase = "CASE cid " + " ".join(f"WHEN {i} THEN (SELECT x{i} FROM {p}_x)" for i in present) + " END"
    ccols = ", ".join(f"CASE WHEN ell = 0 THEN ma{j} ELSE ((ell - xx) * ma{j} + xx * mb{j}) / ell END AS c{j}"
                      for j in range(dim))
    c = f"{p}_c AS (SELECT cid, {ccols} FROM (SELECT *, {xcase} AS xx FROM {p}_m))"
    return [g, m, t, f, q, ls, x, c], f"{p}_c"


def with_(ctes: Sequence[str], body: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(c.strip() for c in ctes) + "\n" + body


def round_centers(name: str, dim: int) -> str:
    return f"SELECT cid, " + ", ".join(f"{r6(f'c{j}')} AS c{j}" for j in range(dim)) + f" FROM {name}"


def fair_lloyd_sql(dim: int, k: int, first: CenterRef, iters: int,
                   tag: str = "", src: str = "pts") -> tuple[list[str], str]:
    """Fair Lloyd steps over the CTE ``src``; returns (ctes, last centres CTE)."""
    ctes: list[str] = []
    center = first
    last = ""
    for it in range(iters):
        ctes.append(assign_cte(f"{tag}a{it}", src, dim, k, center))
        step, last = fair_step_ctes(f"{tag}s{it}", f"{tag}a{it}", dim, k)
        ctes += step
        center = cte_centers(last, dim)
    return ctes, last


def lloyd_sql(dim: int, k: int, first: CenterRef, iters: int,
              tag: str = "") -> tuple[list[str], str]:
    """Standard Lloyd steps over the ``pts`` CTE; an empty centre keeps its place."""
    ctes: list[str] = []
    center = first
    last = ""
    for it in range(iters):
        a, g, prev, new = f"{tag}a{it}", f"{tag}g{it}", f"{tag}k{it}", f"{tag}l{it}"
        ctes.append(assign_cte(a, "pts", dim, k, center))
        means = ", ".join(f"sum(x{j}) / count(*) AS m{j}" for j in range(dim))
        ctes.append(f"{g} AS (SELECT cid, {means} FROM {a} GROUP BY cid)")
        kvals = " UNION ALL ".join(
            f"SELECT {i} AS cid, " + ", ".join(f"{center(i, j)} AS c{j}" for j in range(dim))
            for i in range(k))
        ctes.append(f"{prev} AS ({kvals})")
        cols = ", ".join(f"coalesce(g.m{j}, p.c{j}) AS c{j}" for j in range(dim))
        ctes.append(f"{new} AS (SELECT p.cid, {cols} FROM {prev} p LEFT JOIN {g} g ON p.cid = g.cid)")
        center = cte_centers(new, dim)
        last = new
    return ctes, last


# ---------------------------------------------------------------- k-means|| with hashed draws

def seeds_sql(k: int, seed: int = 1, rounds: int = 2, factor: float = 2.0) -> tuple[list[str], str]:
    """CTEs of the seeding over ``lineitem``; the last one holds (cid, c0, c1) in the order picked."""
    def u(axis: str) -> str:
        return f"CAST(CAST('0x' || substr(md5('{seed}-{axis}-' || key), 1, 13) AS BIGINT) AS DOUBLE) / {lit(2.0 ** 52)}"

    def square(a: str, b: str) -> str:
        return dist([f"{a}.x0", f"{a}.x1"], [f"{b}.x0", f"{b}.x1"])

    def picked(i: int) -> float:
        return int(hashlib.md5(f"{seed}-pick{i}".encode()).hexdigest()[:13], 16) / 2.0 ** 52

    ctes = [f"""uq AS MATERIALIZED (SELECT l_quantity AS x0, l_extendedprice / {lit(PRICE_SCALE)} AS x1,
        CAST(l_quantity AS BIGINT) || '-' || CAST(round(l_extendedprice * 100) AS BIGINT) AS key, count(*) AS n
        FROM lineitem GROUP BY ALL)""",
            f"cand0 AS MATERIALIZED (SELECT 0 AS pos, x0, x1 FROM uq ORDER BY {u('draw0')}, x0, x1 LIMIT 1)"]
    for r in range(1, rounds + 1):
        ctes.append(f"near{r} AS MATERIALIZED (SELECT q.x0, q.x1, q.key, any_value(q.n) AS n, min({square('q', 'c')}) AS d2 "
                    f"FROM uq q CROSS JOIN cand{r - 1} c GROUP BY q.x0, q.x1, q.key)")
        ctes.append(f"new{r} AS MATERIALIZED (SELECT DISTINCT x0, x1 FROM near{r} "
                    f"WHERE {u(f'draw{r}')} < {lit(factor * k)} * d2 / (SELECT sum(n * d2) FROM near{r}) "
                    f"AND (x0, x1) NOT IN (SELECT (x0, x1) FROM cand{r - 1}))")
        ctes.append(f"cand{r} AS MATERIALIZED (SELECT * FROM cand{r - 1} UNION ALL SELECT (SELECT max(pos) FROM cand{r - 1}) + "
                    f"row_number() OVER (ORDER BY x0, x1) AS pos, x0, x1 FROM new{r})")
    last = f"cand{rounds}"
    ctes.append(f"""cw AS MATERIALIZED (SELECT c.pos, c.x0, c.x1, coalesce(w.w, 0) AS w FROM {last} c LEFT JOIN
        (SELECT pos, sum(n) AS w FROM (SELECT q.x0, q.x1, q.key, any_value(q.n) AS n, arg_min(c.pos, ({square('q', 'c')}, c.pos)) AS pos
         FROM uq q CROSS JOIN {last} c GROUP BY q.x0, q.x1, q.key) GROUP BY pos) w ON c.pos = w.pos)""")
    for i in range(k):
        mass = "w" if i == 0 else f"w * (SELECT min({square('m', 'p')}) FROM pk{i - 1} p)"
        before = f"SELECT * FROM pk{i - 1} UNION ALL " if i else ""
        ctes.append(f"""mass{i} AS MATERIALIZED (SELECT pos, x0, x1, sum(mass) OVER (ORDER BY pos) AS up_to, sum(mass) OVER () AS total
            FROM (SELECT m.pos, m.x0, m.x1, CAST({mass} AS DOUBLE) AS mass FROM cw m))""")
        ctes.append(f"""pk{i} AS MATERIALIZED ({before}SELECT {i} AS cid, x0, x1 FROM mass{i} WHERE pos =
            (SELECT min(pos) FROM mass{i} WHERE up_to > {lit(picked(i))} * total))""")
    ctes.append(f"seeds AS MATERIALIZED (SELECT CAST(cid AS INTEGER) AS cid, x0 AS c0, x1 AS c1 FROM pk{k - 1})")
    return ctes, "seeds"


# ---------------------------------------------------------------- the oracle set

# fixed values: the return flags of the tables
RETURN_FLAGS = ("A", "N", "R")

def _p2(grouping="unbalanced") -> str:
    return f"pts AS ({p2_points_sql(grouping)})"


def _p2_assigned(centers=P2_CENTERS, grouping="unbalanced") -> list[str]:
    return [_p2(grouping), assign_cte("a", "pts", 2, len(centers), literal_centers(centers),
                                      keep=("l_orderkey", "l_linenumber"))]


def _one_step(centers=P2_CENTERS) -> tuple[list[str], str]:
    ctes = _p2_assigned(centers)
    step, last = fair_step_ctes("s", "a", 2, len(centers))
    return ctes + step, last


def _repair_ctes(fars, tag: str = "", src: str = "pts") -> tuple[list[str], str]:
    """One fair step over ``src`` whose far centres are repaired one after the other."""
    centers = [*P2_CENTERS, *fars]
    k = len(centers)
    ctes = [assign_cte(f"{tag}a", src, 2, k, literal_centers(centers))]
    last = f"{tag}a"
    for far in range(len(P2_CENTERS), k):
        d_far = dist(["x0", "x1"], [lit(v) for v in centers[far]])
        new, sizes, donor = f"{tag}ar{far}", f"{tag}sizes{far}", f"{tag}donor{far}"
        ctes.append(f"{sizes} AS (SELECT cid, count(*) AS n FROM {last} GROUP BY cid)")
        ctes.append(
            f"{donor} AS (SELECT a.x0, a.x1, a.grp, a.cid FROM {last} a JOIN {sizes} s ON a.cid = s.cid "
            f"WHERE s.n > 1 AND a.cid < {len(P2_CENTERS)} ORDER BY {d_far}, a.x0, a.x1, a.grp, a.cid LIMIT 1)")
        ctes.append(
            f"{new} AS (SELECT a.x0, a.x1, a.grp, CASE WHEN EXISTS (SELECT 1 FROM {donor} d WHERE d.x0 = a.x0 "
            f"AND d.x1 = a.x1 AND d.grp = a.grp AND d.cid = a.cid) THEN {far} ELSE a.cid END AS cid FROM {last} a)")
        last = new
    step, last = fair_step_ctes(f"{tag}s", last, 2, k)
    return ctes + step, last


def _repair_sql(fars) -> str:
    ctes, last = _repair_ctes(fars)
    return with_([_p2(), *ctes], round_centers(last, 2))


def _models_sql(by: str, centers, iters: int, steps: int = 10) -> str:
    """Fair steps of one model per value of ``by``, without repair: every CTE carries the key.

    A centre without points, and all centres of a model without one of the groups, keep their place.
    """
    k = len(centers)
    ctes = [f"pts AS MATERIALIZED (SELECT {by} AS seg, l_quantity AS x0, l_extendedprice / {lit(PRICE_SCALE)} AS x1, "
            f"{P2_GROUP['unbalanced']} AS grp FROM lineitem)",
            "k0 AS MATERIALIZED (SELECT seg, " + ", ".join(f"{lit(v)} AS c{i}_{j}" for i, c in enumerate(centers) for j, v in enumerate(c))
            + " FROM (SELECT DISTINCT seg FROM pts))"]
    for it in range(iters):
        p = f"t{it}"
        ds = ", ".join(f"{dist(['p.x0', 'p.x1'], [f'k.c{i}_0', f'k.c{i}_1'])} AS d{i}" for i in range(k))
        case = "CASE " + " ".join(f"WHEN d{i} = least({', '.join(f'd{j}' for j in range(k))}) THEN {i}" for i in range(k)) + " END"
        ctes.append(f"{p}a AS MATERIALIZED (SELECT seg, x0, x1, grp, {case} AS cid FROM (SELECT p.*, {ds} FROM pts p JOIN k{it} k ON p.seg = k.seg))")
        ctes.append(f"{p}g AS MATERIALIZED (SELECT seg, cid, count(*) FILTER (WHERE grp = 'A') AS na, count(*) FILTER (WHERE grp = 'B') AS nb, "
                    + ", ".join(f"avg(x{j}) FILTER (WHERE grp = '{g.upper()}') AS m{g}{j}" for g in "ab" for j in (0, 1)) + f" FROM {p}a GROUP BY seg, cid)")
        ctes.append(f"{p}m AS MATERIALIZED (SELECT seg, cid, na, nb, " + ", ".join(
            f"coalesce(m{g}{j}, m{o}{j}) AS m{g}{j}" for g, o in ("ab", "ba") for j in (0, 1)) + f" FROM {p}g)")
        ctes.append(f"{p}w AS MATERIALIZED (SELECT seg, CAST(sum(na) AS DOUBLE) AS ta, CAST(sum(nb) AS DOUBLE) AS tb FROM {p}m GROUP BY seg)")
        ctes.append(f"{p}f AS MATERIALIZED (SELECT a.seg, "
                    f"sum(CASE WHEN a.grp = 'A' THEN {dist(['a.x0', 'a.x1'], ['m.ma0', 'm.ma1'])} END) / any_value(w.ta) AS fa, "
                    f"sum(CASE WHEN a.grp = 'B' THEN {dist(['a.x0', 'a.x1'], ['m.mb0', 'm.mb1'])} END) / any_value(w.tb) AS fb "
                    f"FROM {p}a a JOIN {p}m m ON a.seg = m.seg AND a.cid = m.cid JOIN {p}w w ON a.seg = w.seg GROUP BY a.seg)")
        per = ", ".join(f"coalesce(max(CASE WHEN cid = {i} THEN na / ta END), 0) AS a{i}, coalesce(max(CASE WHEN cid = {i} THEN nb / tb END), 0) AS b{i}, "
                        f"coalesce(max(CASE WHEN cid = {i} THEN sqrt({dist(['ma0', 'ma1'], ['mb0', 'mb1'])}) END), 0) AS l{i}" for i in range(k))
        ctes.append(f"{p}q AS MATERIALIZED (SELECT m.seg, {per}, any_value(f.fa) AS fa, any_value(f.fb) AS fb FROM {p}m m JOIN {p}w w ON m.seg = w.seg "
                    f"JOIN {p}f f ON m.seg = f.seg WHERE ta > 0 AND tb > 0 GROUP BY m.seg)")

        def x_of(i: int, g: str = "g") -> str:
            return f"CASE WHEN a{i} + b{i} = 0 THEN {lit(0.0)} ELSE ({lit(1.0)} - {g}) * b{i} * l{i} / ({g} * a{i} + ({lit(1.0)} - {g}) * b{i}) END"

        fa = " + ".join(["fa", *[f"a{i} * ({x_of(i)}) * ({x_of(i)})" for i in range(k)]])
        fb = " + ".join(["fb", *[f"b{i} * (l{i} - ({x_of(i)})) * (l{i} - ({x_of(i)}))" for i in range(k)]])
        ctes.append(f"{p}_ls(seg, t, g, pw, done, ge) AS (SELECT seg, 0, {lit(0.5)}, {lit(0.5)}, false, CAST(NULL AS DOUBLE) FROM {p}q UNION ALL "
                    f"SELECT seg, t + 1, CASE WHEN va = vb THEN g WHEN va > vb THEN g + pw / 2 ELSE g - pw / 2 END, pw / 2, va = vb, g FROM "
                    f"(SELECT s.*, {fa} AS va, {fb} AS vb FROM {p}_ls s JOIN {p}q q ON s.seg = q.seg WHERE t < {steps} AND NOT done))")
        ctes.append(f"{p}e AS MATERIALIZED (SELECT seg, arg_max(ge, t) AS ge FROM {p}_ls GROUP BY seg)")
        new = ", ".join(f"coalesce(max(CASE WHEN m.cid = {i} THEN CASE WHEN l{i} = 0 THEN ma{j} ELSE "
                        f"((l{i} - ({x_of(i, 'ge')})) * ma{j} + ({x_of(i, 'ge')}) * mb{j}) / l{i} END END), any_value(k.c{i}_{j})) AS c{i}_{j}"
                        for i in range(k) for j in (0, 1))
        ctes.append(f"k{it + 1} AS MATERIALIZED (SELECT k.seg, {new} FROM k{it} k LEFT JOIN (SELECT * FROM {p}q JOIN {p}e USING (seg)) q "
                    f"ON k.seg = q.seg LEFT JOIN {p}m m ON q.seg = m.seg GROUP BY k.seg)")
    body = " UNION ALL ".join(f"SELECT seg AS {by}, CAST({i} AS INTEGER) AS cid, " + ", ".join(f"{r6(f'c{i}_{j} + {lit(OFF_HALVES)}')} AS c{j}" for j in (0, 1)) + f" FROM k{iters}" for i in range(k))
    return with_(ctes, body)


def _centers_long_sql(name: str, dim: int) -> str:
    parts = " UNION ALL ".join(f"SELECT cid, {j} AS j, {r6(f'c{j}')} AS value FROM {name}"
                               for j in range(dim))
    return parts


def _kept(ctes: Sequence[str]) -> list[str]:
    """The same CTEs, each computed once."""
    return [c if " AS MATERIALIZED (" in c or "_ls(" in c else c.replace(" AS (", " AS MATERIALIZED (", 1) for c in ctes]


def _compared(standard: str, fair: str, k: int) -> str:
    """Both objectives of two centre CTEs on the same points."""
    evals = [assign_cte("es", "pts", 2, k, cte_centers(standard)), assign_cte("ef", "pts", 2, k, cte_centers(fair))]
    return ",\n".join(evals) + "\n" + " UNION ALL ".join(
        f"SELECT '{model}' AS model, {r6('sum(s) / sum(n)')} AS delta, {r6('max(s / n)')} AS phi FROM "
        f"(SELECT grp, count(*) AS n, sum(d2) AS s FROM {pref} GROUP BY grp)"
        for model, pref in (("standard", "es"), ("fair", "ef")))


def oracle_sql() -> dict[str, str]:
    words_one = f"WITH {LINES.strip()}\nSELECT word, count(*) AS n FROM toks GROUP BY word"
    out: dict[str, str] = {
        "wc_num_docs": f"WITH {LINES.strip()}\nSELECT count(*) AS n_docs FROM lines",
        "wc_per_doc": f"WITH {LINES.strip()}\nSELECT doc_id, line_no, word, count(*) AS n "
                      f"FROM toks GROUP BY doc_id, line_no, word",
        "wc_one_round": words_one,
        "wc_salted": words_one,
        "wc_salted_expr": words_one,
        "wc_partitions": words_one,
        "wc_distinct_words": f"WITH {LINES.strip()}\nSELECT count(DISTINCT word) AS n_words FROM toks",
        "wc_avg_word_length": f"WITH {LINES.strip()}\nSELECT round(avg(length(word)), 6) AS avg_word_length "
                              f"FROM (SELECT DISTINCT word FROM toks)",
        "points_parse": f"SELECT l_quantity AS x, l_extendedprice / {lit(PRICE_SCALE)} AS y, "
                        f"CASE l_linestatus WHEN 'F' THEN 'A' ELSE 'B' END AS grp FROM lineitem",
        "points_group_counts": f"WITH {_p2('balanced')} SELECT count(*) AS n, "
                               f"count(*) FILTER (WHERE grp = 'A') AS n_a, "
                               f"count(*) FILTER (WHERE grp = 'B') AS n_b FROM pts",
    }
    k = len(P2_CENTERS)
    dcols = ", ".join(f"{r6(dist(['x0', 'x1'], [lit(v) for v in c]))} AS d{i}"
                      for i, c in enumerate(P2_CENTERS))
    out["point_center_distance"] = f"WITH {_p2()} SELECT l_orderkey, l_linenumber, {dcols} FROM pts"
    assigned = with_(_p2_assigned(), "")
    out["nearest_center"] = assigned + f"SELECT l_orderkey, l_linenumber, cid, {r6('d2')} AS d2 FROM a"
    out["delta_objective"] = assigned + f"SELECT {r6('sum(d2) / count(*)')} AS delta FROM a"
    out["group_mean_costs"] = assigned + (f"SELECT grp, count(*) AS n, {r6('sum(d2) / count(*)')} AS mean_cost "
                                          f"FROM a GROUP BY grp")
    out["phi_objective"] = assigned + (f"SELECT {r6('max(c)')} AS phi FROM "
                                       f"(SELECT sum(d2) / count(*) AS c FROM a GROUP BY grp)")
    six = [*P2_CENTERS, P2_FAR_CENTER]
    cvals = " UNION ALL ".join(
        f"SELECT {i} AS cid, '{','.join(f'{v:.6f}' for v in c)}' AS center" for i, c in enumerate(six))
    out["center_stats"] = with_(_p2_assigned(six), "") + (
        f"SELECT c.cid, c.center, count(a.grp) FILTER (WHERE a.grp = 'A') AS n_a, "
        f"count(a.grp) FILTER (WHERE a.grp = 'B') AS n_b "
        f"FROM ({cvals}) c LEFT JOIN a ON a.cid = c.cid GROUP BY c.cid, c.center")
    out["cluster_group_counts"] = assigned + (
        "SELECT cid, count(*) FILTER (WHERE grp = 'A') AS n_a, count(*) FILTER (WHERE grp = 'B') AS n_b "
        "FROM a GROUP BY cid")
    out["evaluate_balanced"] = with_(_p2_assigned(grouping="balanced"), "") + (
        f"SELECT CAST(sum(n) AS BIGINT) AS n, CAST(sum(CASE WHEN grp = 'A' THEN n ELSE 0 END) AS BIGINT) AS n_a, "
        f"CAST(sum(CASE WHEN grp = 'B' THEN n ELSE 0 END) AS BIGINT) AS n_b, {r6('sum(s) / sum(n)')} AS delta, "
        f"{r6('max(s / n)')} AS phi FROM (SELECT grp, count(*) AS n, sum(d2) AS s FROM a GROUP BY grp)")
    out["cluster_group_sums"] = assigned + (
        "SELECT cid, grp, count(*) AS n, round(sum(x0), 6) AS sum_x, round(sum(x1), 6) AS sum_y "
        "FROM a GROUP BY cid, grp")
    step_ctes, last = _one_step()
    step = with_(step_ctes, "")
    out["cluster_fair_params"] = step + (
        f"SELECT cid, n_a, n_b, {r6('n_a / (SELECT na FROM s_t)')} AS alpha, "
        f"{r6('n_b / (SELECT nb FROM s_t)')} AS beta, {r6('ma0')} AS mu_a_x, {r6('ma1')} AS mu_a_y, "
        f"{r6('mb0')} AS mu_b_x, {r6('mb1')} AS mu_b_y, {r6('ell')} AS ell FROM s_m")
    out["fair_fixed_costs"] = step + f"SELECT {r6('fa')} AS fixed_a, {r6('fb')} AS fixed_b FROM s_f"
    xs = " UNION ALL ".join(f"SELECT {i} AS cid, gamma, {r6(f'x{i}')} AS x FROM s_x" for i in range(k))
    out["fair_line_search"] = step + xs
    out["fair_centers"] = step + round_centers(last, 2)
    for iters in (1, 2):
        ctes, last = fair_lloyd_sql(2, k, literal_centers(P2_CENTERS), iters)
        out[f"fair_lloyd_{iters}"] = with_([_p2(), *ctes], round_centers(last, 2))
    seg_ctes, seg_parts = [], []
    for flag in RETURN_FLAGS:  # each model on its own points
        seg_ctes.append(f"p{flag} AS ({p2_points_sql()} WHERE l_returnflag = '{flag}')")
        ctes, last = fair_lloyd_sql(2, k, literal_centers(P2_CENTERS), 2, tag=f"m{flag}_", src=f"p{flag}")
        seg_ctes += ctes
        seg_parts.append(f"SELECT '{flag}' AS l_returnflag, cid, {r6('c0')} AS c0, {r6('c1')} AS c1 FROM {last}")
    out["fair_lloyd_by_segment"] = with_(seg_ctes, " UNION ALL ".join(seg_parts))
    first, seeds = seeds_sql(5)
    out["kmeans_init"] = with_(first, round_centers(seeds, 2))
    ctes, last = lloyd_sql(2, 5, cte_centers(seeds), 5)
    out["kmeans_standard"] = with_([_p2(), *first, *_kept(ctes)], round_centers(last, 2))
    std, std_last = lloyd_sql(2, 5, cte_centers(seeds), 2, tag="std_")
    fct, fct_last = fair_lloyd_sql(2, 5, cte_centers(seeds), 2, tag="fair_")
    out["fair_vs_standard_kmeans"] = with_([_p2(), *first, *_kept([*std, *fct])], "") .rstrip() + ",\n" + _compared(std_last, fct_last, 5)
    seg_ctes, seg_parts = [], []
    for flag in RETURN_FLAGS:
        seg_ctes.append(f"p{flag} AS ({p2_points_sql()} WHERE l_returnflag = '{flag}')")
        ctes, last = _repair_ctes(P2_FAR_CENTERS if flag == "N" else [], f"m{flag}_", f"p{flag}")
        seg_ctes += ctes
        seg_parts.append(f"SELECT '{flag}' AS l_returnflag, cid, {r6('c0')} AS c0, {r6('c1')} AS c1 FROM {last}")
    out["fair_lloyd_by_segment_repair"] = with_(seg_ctes, " UNION ALL ".join(seg_parts))
    out["fair_lloyd_by_part"] = _models_sql("l_partkey", PART_CENTERS, 2)
    ctes, last = lloyd_sql(2, k, literal_centers(P2_CENTERS), 2)
    out["lloyd_standard_2"] = with_([_p2(), *ctes], round_centers(last, 2))
    ctes, last = lloyd_sql(2, k, literal_centers(P2_CENTERS), 6)
    out["lloyd_bounded"] = with_([_p2(), *ctes], round_centers(last, 2))
    out["fair_lloyd_bounded"] = out["fair_lloyd_2"]
    # both centre sets evaluated on the same points
    lctes, llast = lloyd_sql(2, k, literal_centers(P2_CENTERS), 2, tag="std_")
    fctes, flast = fair_lloyd_sql(2, k, literal_centers(P2_CENTERS), 2, tag="fair_")
    out["fair_vs_standard"] = with_([_p2(), *lctes, *fctes], "").rstrip() + ",\n" + _compared(llast, flast, k)
    out["empty_center_repair"] = _repair_sql([P2_FAR_CENTER])
    out["empty_center_repair_many"] = _repair_sql(P2_FAR_CENTERS)
    out["kmeans_properties"] = ("SELECT CAST(5 AS INTEGER) AS n_centers, count(*) AS n_points, true AS costs, "
                                "true AS improved FROM lineitem")
    out["synth_points_by_key"] = _synth_sql()
    out["synth_points"] = _dealt_sql()
    out["points_read_good"] = out["points_parse"] + " WHERE l_linenumber <> 7"
    key = "l_orderkey || '-' || l_linenumber"
    out["points_read_bad"] = (
        f"SELECT CASE l_orderkey % 3 WHEN 0 THEN {key} || ',' || l_linestatus WHEN 1 THEN {key} || ',1.5,' || l_linestatus ELSE '1,2,' || {key} END AS value, "
        f"CASE l_orderkey % 3 WHEN 0 THEN 'field count' WHEN 1 THEN 'malformed number' ELSE 'label is neither group' END AS reason, true AS placed "
        f"FROM lineitem WHERE l_linenumber = 7")
    out["nearest_center_table"] = (
        f"WITH {_p2()}, cen AS (SELECT CAST(l_orderkey % {TABLE_CENTERS} AS INTEGER) AS cid, min(l_quantity) AS c0, "
        f"max(l_extendedprice) / {lit(PRICE_SCALE)} AS c1 FROM lineitem GROUP BY 1), "
        f"best AS (SELECT x0, x1, min({{'d': {dist(['x0', 'x1'], ['c0', 'c1'])}, 'cid': cid}}) AS b FROM (SELECT DISTINCT x0, x1 FROM pts), cen "
        f"GROUP BY x0, x1) SELECT l_orderkey, l_linenumber, b.cid AS cid, {r6('b.d')} AS d2 FROM pts JOIN best USING (x0, x1)")
    # 64-d points
    p64 = f"pts AS ({p64_points_sql()})"
    k64 = 10
    a64 = assign_cte("a", "pts", P64_DIM, k64, p64_center, keep=("vec_id",))
    base64 = with_([P64_CENTERS_CTE, p64, a64], "")
    out["nearest_center_p64"] = base64 + f"SELECT vec_id, cid, {r6('d2')} AS d2 FROM a"
    out["phi_objective_p64"] = base64 + (f"SELECT {r6('max(c)')} AS phi FROM "
                                         f"(SELECT sum(d2) / count(*) AS c FROM a GROUP BY grp)")
    out["cluster_group_counts_p64"] = base64 + (
        "SELECT cid, count(*) FILTER (WHERE grp = 'A') AS n_a, count(*) FILTER (WHERE grp = 'B') AS n_b "
        "FROM a GROUP BY cid")
    sums = " UNION ALL ".join(f"SELECT cid, grp, count(*) AS n, {j} AS j, {r6(f'sum(x{j})')} AS total FROM a GROUP BY cid, grp" for j in range(P64_DIM))
    out["cluster_group_sums_p64"] = base64 + sums
    step, _ = fair_step_ctes("s", "a", P64_DIM, k64)
    out["fair_fixed_costs_p64"] = with_([P64_CENTERS_CTE, p64, a64, *step], f"SELECT {r6('fa')} AS fixed_a, {r6('fb')} AS fixed_b FROM s_f")
    ctes, last = fair_lloyd_sql(P64_DIM, k64, p64_center, 2)
    out["fair_lloyd_2_p64"] = with_([P64_CENTERS_CTE, p64, *ctes], _centers_long_sql(last, P64_DIM))
    return out


def _dealt_sql(k: int = 5, seed: int = 42) -> str:
    def u(axis: str) -> str:
        return f"CAST(CAST('0x' || substr(md5('{seed}-{axis}-' || id), 1, 13) AS BIGINT) AS DOUBLE) / {lit(2.0 ** 52)}"
    return (
        f"WITH n AS (SELECT count(*) // {k} AS per FROM lineitem), "
        f"dealt AS (SELECT id, CAST(id // per AS INTEGER) AS cid, id % per < CAST(floor({lit(0.8)} * per) AS BIGINT) AS is_a "
        f"FROM (SELECT row_number() OVER () - 1 AS id FROM lineitem), n WHERE id < per * {k}) "
        f"SELECT id, cid, round({lit(0.0)} + cid * {lit(100.0)} + {u('x')} * {lit(20.0)}, 6) AS x, "
        f"round(CASE WHEN is_a THEN {lit(50.0)} ELSE {lit(10.0)} END + {u('y')} * {lit(20.0)}, 6) AS y, "
        f"CASE WHEN is_a THEN 'A' ELSE 'B' END AS grp FROM dealt")


def _synth_sql(k: int = 5, seed: int = 42) -> str:
    def u(axis: str) -> str:
        return (f"CAST(CAST('0x' || substr(md5('{seed}-{axis}-' || l_orderkey || '-' || l_linenumber), 1, 13) AS BIGINT)"
                f" AS DOUBLE) / {lit(2.0 ** 52)}")
    return (
        f"WITH drawn AS (SELECT l_orderkey, l_linenumber, CAST(floor({u('cid')} * {k}) AS INTEGER) AS cid, "
        f"{u('grp')} < {lit(0.8)} AS is_a FROM lineitem) "
        f"SELECT l_orderkey, l_linenumber, cid, "
        f"round({lit(0.0)} + cid * {lit(100.0)} + {u('x')} * {lit(20.0)}, 6) AS x, "
        f"round(CASE WHEN is_a THEN {lit(50.0)} ELSE {lit(10.0)} END + {u('y')} * {lit(20.0)}, 6) AS y, "
        f"CASE WHEN is_a THEN 'A' ELSE 'B' END AS grp FROM drawn")
