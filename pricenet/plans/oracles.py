"""Independent DuckDB SQL for every registered query.

The oracle uses different algorithms where it matters: shortest paths by
walk counting in a recursive CTE (d = shortest walk length, sigma = number
of walks of that length), betweenness by the pair-dependency triple sum,
eigenvector by a recursive power iteration with a window norm.  Each oracle
string is a WITH RECURSIVE prefix holding only the CTEs it needs.
"""

from __future__ import annotations

from pricenet.plans import catalog as Q

ABSENT = "NATION_ABSENT"
G = "year, category"


def _tau_edges(tau: str) -> str:
    return f"SELECT year, category, u, v, sim, 1.0::DOUBLE AS weight FROM pairs WHERE sim >= {tau}"


def _r(expr: str, alias: str, digits: int = 6) -> str:
    """Same rounding as the Spark side: round(x * 10^d) / 10^d + 0.0."""
    scale = float(10 ** digits)
    return f"round(({expr})::DOUBLE * {scale!r}) / {scale!r} + 0.0 AS {alias}"


CTES: dict[str, tuple[list[str], str]] = {
    "raw": ([], """
        SELECT n.n_name AS city, CAST(year(o.o_orderdate) AS INTEGER) AS year, p.p_type AS category,
               strftime(o.o_orderdate, '%Y-%m') AS month_year, CAST(p.p_type AS VARCHAR) AS item_description,
               avg(l.l_extendedprice / l.l_quantity) AS price
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN part p ON l.l_partkey = p.p_partkey
        GROUP BY 1, 2, 3, 4, 5"""),
    "obs": (["raw"], """
        SELECT r.city, r.year, r.category, r.month_year, r.item_description,
               CASE WHEN z.sd IS NULL OR z.sd = 0 THEN 0.0 ELSE (r.price - z.mu) / z.sd END AS normalized_price
        FROM raw r JOIN (SELECT category, item_description, avg(price) AS mu, stddev_samp(price) AS sd
                         FROM raw GROUP BY 1, 2) z USING (category, item_description)"""),
    "raw_brand": ([], """
        SELECT n.n_name AS city, CAST(year(o.o_orderdate) AS INTEGER) AS year, p.p_type AS category,
               strftime(o.o_orderdate, '%Y-%m') AS month_year, CAST(p.p_brand AS VARCHAR) AS item_description,
               avg(l.l_extendedprice / l.l_quantity) AS price
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN part p ON l.l_partkey = p.p_partkey
        GROUP BY 1, 2, 3, 4, 5"""),
    "obs_brand": (["raw_brand"], """
        SELECT r.city, r.year, r.category, r.month_year, r.item_description,
               CASE WHEN z.sd IS NULL OR z.sd = 0 THEN 0.0 ELSE (r.price - z.mu) / z.sd END AS normalized_price
        FROM raw_brand r JOIN (SELECT category, item_description, avg(price) AS mu, stddev_samp(price) AS sd
                               FROM raw_brand GROUP BY 1, 2) z USING (category, item_description)"""),
    "roster": ([], f"""
        SELECT n_name AS city, CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS INTEGER) AS node_id FROM nation
        UNION ALL SELECT '{ABSENT}', CAST((SELECT count(*) FROM nation) AS INTEGER)"""),
    "nr": (["roster"], "SELECT count(*) AS n FROM roster"),
    "feats": (["obs"], """
        SELECT year, category, city,
               coalesce(CAST(month_year AS VARCHAR), 'None') || '_' || coalesce(CAST(item_description AS VARCHAR), 'None') AS feature,
               min(normalized_price) AS value
        FROM obs WHERE normalized_price IS NOT NULL GROUP BY 1, 2, 3, 4"""),
    "feats_brand": (["obs_brand"], """
        SELECT year, category, city,
               coalesce(CAST(month_year AS VARCHAR), 'None') || '_' || coalesce(CAST(item_description AS VARCHAR), 'None') AS feature,
               min(normalized_price) AS value
        FROM obs_brand WHERE normalized_price IS NOT NULL GROUP BY 1, 2, 3, 4"""),
    "groups": (["feats"], "SELECT DISTINCT year, category FROM feats"),
    "rf": (["feats", "roster"], "SELECT * FROM feats WHERE city IN (SELECT city FROM roster) AND value <> 0"),
    "rf_brand": (["feats_brand", "roster"],
                 "SELECT * FROM feats_brand WHERE city IN (SELECT city FROM roster) AND value <> 0"),
    "norms": (["rf"], "SELECT year, category, city, sqrt(sum(value * value)) AS norm FROM rf GROUP BY 1, 2, 3"),
    "pairs": (["rf", "norms"], """
        SELECT d.year, d.category, d.u, d.v, greatest(-1.0, least(1.0, d.dot / (nu.norm * nv.norm))) AS sim
        FROM (SELECT a.year, a.category, a.city AS u, b.city AS v, sum(a.value * b.value) AS dot
              FROM rf a JOIN rf b ON a.year = b.year AND a.category = b.category AND a.feature = b.feature
                                  AND a.city < b.city
              GROUP BY 1, 2, 3, 4) d
        JOIN norms nu ON nu.year = d.year AND nu.category = d.category AND nu.city = d.u
        JOIN norms nv ON nv.year = d.year AND nv.category = d.category AND nv.city = d.v"""),
    "pairs_brand": (["rf_brand"], """
        SELECT d.year, d.category, d.u, d.v, greatest(-1.0, least(1.0, d.dot / (nu.norm * nv.norm))) AS sim
        FROM (SELECT a.year, a.category, a.city AS u, b.city AS v, sum(a.value * b.value) AS dot
              FROM rf_brand a JOIN rf_brand b ON a.year = b.year AND a.category = b.category
                                            AND a.feature = b.feature AND a.city < b.city
              GROUP BY 1, 2, 3, 4) d
        JOIN (SELECT year, category, city, sqrt(sum(value * value)) AS norm FROM rf_brand GROUP BY 1, 2, 3) nu
          ON nu.year = d.year AND nu.category = d.category AND nu.city = d.u
        JOIN (SELECT year, category, city, sqrt(sum(value * value)) AS norm FROM rf_brand GROUP BY 1, 2, 3) nv
          ON nv.year = d.year AND nv.category = d.category AND nv.city = d.v"""),
    "edges": (["pairs"], _tau_edges("{TAU}")),
    "meta": (["groups", "edges", "nr"], f"""
        SELECT g.year, g.category, CAST((SELECT n FROM nr) AS BIGINT) AS num_nodes,
               CAST(count(e.u) AS BIGINT) AS num_edges,
               count(e.u) / ((SELECT n FROM nr) * ((SELECT n FROM nr) - 1) / 2.0) AS density,
               {{TAU}}::DOUBLE AS threshold, false AS weighted
        FROM groups g LEFT JOIN edges e ON e.year = g.year AND e.category = g.category
        GROUP BY 1, 2"""),
    "nets": (["meta"], "SELECT * FROM meta WHERE num_edges > 0"),
    "nodes": (["nets", "roster"], "SELECT w.year, w.category, r.node_id, r.city FROM nets w CROSS JOIN roster r"),
    "adj": (["edges"], """
        SELECT year, category, u AS src, v AS dst FROM edges
        UNION ALL SELECT year, category, v AS src, u AS dst FROM edges"""),
    "deg": (["nodes", "adj"], """
        SELECT n.year, n.category, n.city, n.node_id, CAST(count(a.dst) AS BIGINT) AS degree
        FROM nodes n LEFT JOIN adj a ON a.year = n.year AND a.category = n.category AND a.src = n.city
        GROUP BY 1, 2, 3, 4"""),
    # No shortest path is longer than the number of nodes less one.
    "walks": (["nodes", "adj", "nr"], """
        SELECT year, category, city AS s, city AS t, 0 AS l, 1.0::DOUBLE AS cnt FROM nodes
        UNION ALL
        SELECT w.year, w.category, w.s, a.dst AS t, w.l + 1 AS l, sum(w.cnt) AS cnt
        FROM walks w JOIN adj a ON a.year = w.year AND a.category = w.category AND a.src = w.t
        WHERE w.l < (SELECT n FROM nr) - 1
        GROUP BY 1, 2, 3, 4, 5"""),
    "paths": (["walks"], """
        SELECT year, category, s, t, CAST(min(l) AS INTEGER) AS d, arg_min(cnt, l) AS sigma
        FROM walks GROUP BY 1, 2, 3, 4"""),
    "comp": (["paths", "nodes"], """
        SELECT p.year, p.category, p.s AS city, min(n.node_id) AS component
        FROM paths p JOIN nodes n ON n.year = p.year AND n.category = p.category AND n.city = p.t
        GROUP BY 1, 2, 3"""),
    "ccount": (["comp"], """
        SELECT year, category, CAST(count(DISTINCT component) AS BIGINT) AS num_components,
               count(DISTINCT component) = 1 AS is_connected
        FROM comp GROUP BY 1, 2"""),
    "tri": (["edges"], """
        SELECT a.year, a.category, a.u AS x, a.v AS y, b.v AS z
        FROM edges a JOIN edges b ON a.year = b.year AND a.category = b.category AND a.u = b.u AND a.v < b.v
        JOIN edges c ON c.year = a.year AND c.category = a.category AND c.u = a.v AND c.v = b.v"""),
    "lcc": (["deg", "tri"], """
        SELECT d.year, d.category, d.city, d.degree, coalesce(t.k, 0) AS triangles,
               CASE WHEN d.degree >= 2 THEN 2.0 * coalesce(t.k, 0) / (d.degree * (d.degree - 1)) ELSE 0.0 END AS clustering
        FROM deg d LEFT JOIN (
            SELECT year, category, node, count(*) AS k
            FROM (SELECT year, category, x AS node FROM tri UNION ALL SELECT year, category, y FROM tri
                  UNION ALL SELECT year, category, z FROM tri) GROUP BY 1, 2, 3) t
          ON t.year = d.year AND t.category = d.category AND t.node = d.city"""),
    "clust": (["lcc"], "SELECT year, category, avg(clustering) AS clustering FROM lcc GROUP BY 1, 2"),
    "dc": (["deg", "nr"], """
        SELECT year, category, city, degree / ((SELECT n FROM nr) - 1.0) AS d_i FROM deg"""),
    "cc": (["nodes", "paths", "nr"], """
        SELECT n.year, n.category, n.city,
               CASE WHEN coalesce(f.tot, 0) > 0
                    THEN (f.r * 1.0 / f.tot) * (f.r / ((SELECT n FROM nr) - 1.0)) ELSE 0.0 END AS c_i
        FROM nodes n LEFT JOIN (SELECT year, category, s, count(*) AS r, sum(d) AS tot
                                FROM paths WHERE d > 0 GROUP BY 1, 2, 3) f
          ON f.year = n.year AND f.category = n.category AND f.s = n.city"""),
    "bc": (["nodes", "paths", "nr"], """
        SELECT n.year, n.category, n.city,
               coalesce(b.raw, 0.0) / (((SELECT n FROM nr) - 1.0) * ((SELECT n FROM nr) - 2.0)) AS b_i
        FROM nodes n LEFT JOIN (
            SELECT sv.year, sv.category, sv.t AS v, sum(sv.sigma * vt.sigma / st.sigma) AS raw
            FROM paths sv
            JOIN paths vt ON vt.year = sv.year AND vt.category = sv.category AND vt.s = sv.t
            JOIN paths st ON st.year = sv.year AND st.category = sv.category AND st.s = sv.s AND st.t = vt.t
            WHERE sv.d > 0 AND vt.d > 0 AND sv.s <> vt.t AND st.d = sv.d + vt.d
            GROUP BY 1, 2, 3) b
          ON b.year = n.year AND b.category = n.category AND b.v = n.city"""),
    "adjself": (["adj", "nodes"], """
        SELECT year, category, src, dst FROM adj
        UNION ALL SELECT year, category, city, city FROM nodes"""),
    "power": (["nodes", "adjself", "nr"], """
        SELECT year, category, city, 0 AS it, 1.0 / (SELECT n FROM nr) AS x, NULL::DOUBLE AS xl,
               false AS conv FROM nodes
        UNION ALL
        SELECT year, category, city, it, x, xl,
               sum(abs(x - xl)) OVER (PARTITION BY year, category) < (SELECT n FROM nr) * 1e-6 AS conv
        FROM (SELECT year, category, city, it, y / sqrt(sum(y * y) OVER (PARTITION BY year, category)) AS x, xl
              FROM (SELECT a.year, a.category, a.dst AS city, e.it + 1 AS it, sum(e.x) AS y,
                           sum(CASE WHEN a.src = a.dst THEN e.x END) AS xl
                    FROM power e JOIN adjself a ON a.year = e.year AND a.category = e.category AND a.src = e.city
                    WHERE e.it < 1000 AND NOT e.conv
                    GROUP BY 1, 2, 3, 4))"""),
    "ec": (["power", "nodes"], """
        SELECT n.year, n.category, n.city, coalesce(p.x, 0.0) AS e_i
        FROM nodes n
        LEFT JOIN (SELECT year, category, min(it) AS it FROM power WHERE conv GROUP BY 1, 2) s
          ON s.year = n.year AND s.category = n.category
        LEFT JOIN power p ON p.year = n.year AND p.category = n.category AND p.city = n.city AND p.it = s.it"""),
    "cent": (["nodes", "dc", "cc", "bc", "ec"], """
        SELECT n.year, n.category, n.city,
               coalesce(dc.d_i, 0.0) AS d_i, coalesce(cc.c_i, 0.0) AS c_i,
               coalesce(bc.b_i, 0.0) AS b_i, coalesce(ec.e_i, 0.0) AS e_i
        FROM nodes n
        LEFT JOIN dc USING (year, category, city) LEFT JOIN cc USING (year, category, city)
        LEFT JOIN bc USING (year, category, city) LEFT JOIN ec USING (year, category, city)"""),
    "rho": (["cent"], """
        SELECT year, category,
          CASE WHEN var_pop(d_i) > 0 AND var_pop(c_i) > 0 THEN abs(corr(d_i, c_i)) ELSE 0.0 END AS rho_d_i_c_i,
          CASE WHEN var_pop(d_i) > 0 AND var_pop(b_i) > 0 THEN abs(corr(d_i, b_i)) ELSE 0.0 END AS rho_d_i_b_i,
          CASE WHEN var_pop(d_i) > 0 AND var_pop(e_i) > 0 THEN abs(corr(d_i, e_i)) ELSE 0.0 END AS rho_d_i_e_i,
          CASE WHEN var_pop(c_i) > 0 AND var_pop(b_i) > 0 THEN abs(corr(c_i, b_i)) ELSE 0.0 END AS rho_c_i_b_i,
          CASE WHEN var_pop(c_i) > 0 AND var_pop(e_i) > 0 THEN abs(corr(c_i, e_i)) ELSE 0.0 END AS rho_c_i_e_i,
          CASE WHEN var_pop(b_i) > 0 AND var_pop(e_i) > 0 THEN abs(corr(b_i, e_i)) ELSE 0.0 END AS rho_b_i_e_i
        FROM cent GROUP BY 1, 2"""),
    "wcorr": (["rho"], """
        SELECT year, category, rd / t AS wd, rc / t AS wc, rb / t AS wb, re / t AS we
        FROM (SELECT *, rd + rc + rb + re AS t FROM (
          SELECT year, category,
                 1.0 / (1.0 + rho_d_i_c_i + rho_d_i_b_i + rho_d_i_e_i) AS rd,
                 1.0 / (1.0 + rho_d_i_c_i + rho_c_i_b_i + rho_c_i_e_i) AS rc,
                 1.0 / (1.0 + rho_d_i_b_i + rho_c_i_b_i + rho_b_i_e_i) AS rb,
                 1.0 / (1.0 + rho_d_i_e_i + rho_c_i_e_i + rho_b_i_e_i) AS re
          FROM rho))"""),
    "ent": (["cent"], """
        SELECT year, category,
               -sum(pd * ln(pd)) AS h_d_i, -sum(pc * ln(pc)) AS h_c_i,
               -sum(pb * ln(pb)) AS h_b_i, -sum(pe * ln(pe)) AS h_e_i
        FROM (SELECT year, category,
                CASE WHEN sum(d_i) OVER w > 1e-10 THEN d_i / sum(d_i) OVER w ELSE 1.0 / count(*) OVER w END + 1e-10 AS pd,
                CASE WHEN sum(c_i) OVER w > 1e-10 THEN c_i / sum(c_i) OVER w ELSE 1.0 / count(*) OVER w END + 1e-10 AS pc,
                CASE WHEN sum(b_i) OVER w > 1e-10 THEN b_i / sum(b_i) OVER w ELSE 1.0 / count(*) OVER w END + 1e-10 AS pb,
                CASE WHEN sum(e_i) OVER w > 1e-10 THEN e_i / sum(e_i) OVER w ELSE 1.0 / count(*) OVER w END + 1e-10 AS pe
              FROM cent WINDOW w AS (PARTITION BY year, category))
        GROUP BY 1, 2"""),
    "went": (["ent"], """
        SELECT year, category,
               CASE WHEN t > 1e-10 THEN h_d_i / t ELSE 0.25 END AS wd,
               CASE WHEN t > 1e-10 THEN h_c_i / t ELSE 0.25 END AS wc,
               CASE WHEN t > 1e-10 THEN h_b_i / t ELSE 0.25 END AS wb,
               CASE WHEN t > 1e-10 THEN h_e_i / t ELSE 0.25 END AS we
        FROM (SELECT *, h_d_i + h_c_i + h_b_i + h_e_i AS t FROM ent)"""),
    "catw": ([], "SELECT * FROM (VALUES " + ", ".join(
        f"('{k}', {v!r})" for k, v in Q.CATEGORY_WEIGHTS.items()) + ") t(category, w)"),
    "scores": (["cent", "wcorr", "went", "catw"], """
        SELECT c.year, c.category, c.city, c.d_i, c.c_i, c.b_i, c.e_i,
               0.25 * (c.d_i + c.c_i + c.b_i + c.e_i) AS score_equal,
               c.d_i * k.wd + c.c_i * k.wc + c.b_i * k.wb + c.e_i * k.we AS score_correlation,
               0.25 * (c.d_i + c.c_i + c.b_i + c.e_i) AS score_category,
               0.25 * (c.d_i + c.c_i + c.b_i + c.e_i) * coalesce(cw.w, 0.1) AS score_category_weighted,
               c.d_i * h.wd + c.c_i * h.wc + c.b_i * h.wb + c.e_i * h.we AS score_entropy,
               0.25 * c.d_i + 0.25 * c.c_i + 0.25 * c.b_i + 0.25 * c.e_i AS score_interactive
        FROM cent c
        JOIN wcorr k USING (year, category) JOIN went h USING (year, category)
        LEFT JOIN catw cw ON cw.category = c.category"""),
    "yscores": (["scores"], """
        SELECT year, city, avg(score_equal) AS score_equal, avg(score_correlation) AS score_correlation,
               avg(score_entropy) AS score_entropy, sum(score_category_weighted) AS score_category_weighted,
               avg(score_interactive) AS score_interactive
        FROM scores GROUP BY 1, 2"""),
    "evo": (["nets", "clust", "ccount"], """
        SELECT w.year, w.category, w.num_nodes AS nodes, w.num_edges AS edges, w.density,
               coalesce(c.clustering, 0.0) AS clustering, k.num_components AS components, k.is_connected
        FROM nets w LEFT JOIN clust c USING (year, category) LEFT JOIN ccount k USING (year, category)"""),
    "nested": (["pairs"], " UNION ALL ".join(
        f"SELECT year, category, {i + 1} AS step, u, v FROM pairs WHERE sim >= {t!r}"
        for i, t in enumerate(Q.NESTED_TAUS))),
    "turns": (["pairs"], "SELECT year, category, u, v FROM pairs WHERE sim >= CASE year % 2 "
                         f"WHEN 0 THEN {Q.TURN_TAUS[0]!r} ELSE {Q.TURN_TAUS[1]!r} END"),
    "nrel": (["nested"], """
        SELECT s.year, s.category, s.t_from, s.t_to
        FROM (SELECT a.year, a.category, a.step AS t_from, b.step AS t_to, count(*) AS shared
              FROM nested a JOIN nested b ON a.year = b.year AND a.category = b.category AND a.u = b.u AND a.v = b.v
              GROUP BY 1, 2, 3, 4) s
        JOIN (SELECT year, category, step, count(*) AS size FROM nested GROUP BY 1, 2, 3) z
          ON z.year = s.year AND z.category = s.category AND z.step = s.t_from
        WHERE s.shared = z.size"""),
    "nrel_broken": (["nrel"], f"SELECT * FROM nrel WHERE NOT (t_from = 1 AND t_to = {len(Q.NESTED_TAUS)})"),
    "nred": (["nrel"], """
        SELECT * FROM nrel r
        WHERE NOT EXISTS (
            SELECT 1 FROM nrel a JOIN nrel b ON a.year = b.year AND a.category = b.category AND a.t_to = b.t_from
            WHERE a.year = r.year AND a.category = r.category AND a.t_from = r.t_from AND b.t_to = r.t_to
              AND a.t_from <> a.t_to AND b.t_from <> b.t_to
              AND NOT EXISTS (SELECT 1 FROM nrel x WHERE x.year = a.year AND x.category = a.category
                              AND x.t_from = a.t_to AND x.t_to = a.t_from)
              AND NOT EXISTS (SELECT 1 FROM nrel x WHERE x.year = b.year AND x.category = b.category
                              AND x.t_from = b.t_to AND x.t_to = b.t_from))"""),
}


# Contained pairs of year graphs by counts of shared edges.
CONTAINED_YEARS = """
        SELECT s.category, s.t_from, s.t_to
        FROM (SELECT a.category, a.year AS t_from, b.year AS t_to, count(*) AS shared
              FROM edges a JOIN edges b ON a.category = b.category AND a.u = b.u AND a.v = b.v GROUP BY 1, 2, 3) s
        JOIN (SELECT category, year, count(*) AS size FROM edges GROUP BY 1, 2) z
          ON z.category = s.category AND z.year = s.t_from
        WHERE s.shared = z.size"""


def build(final: str, needs: list[str], tau: float = Q.TAU) -> str:
    """WITH RECURSIVE prefix of the needed CTEs (dependencies first), then ``final``.

    ``{TAU}`` in a fragment is the network threshold of this oracle.
    """
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][0]:
            visit(dep)
        order.append(name)

    for n in needs:
        visit(n)
    body = ",\n".join(f"{n} AS ({CTES[n][1].replace('{TAU}', repr(float(tau)))}\n)" for n in order)
    return f"WITH RECURSIVE {body}\n{final}"


def _cols(*names: str) -> str:
    return ", ".join(names)


CENT_COLS = _cols("year", "category", "city", _r("d_i", "d_i"), _r("c_i", "c_i"), _r("b_i", "b_i"), _r("e_i", "e_i"))
OBS_COLS = _cols("city", "year", "category", "month_year", "item_description", _r("normalized_price", "normalized_price"))
RAW_COLS = _cols("city", "year", "category", "month_year", "item_description", "CAST(price AS FLOAT) AS price")
SCORE_SEL = _cols("year", "city", _r("score_equal", "score_equal"), _r("score_correlation", "score_correlation"),
                  _r("score_entropy", "score_entropy"), _r("score_category_weighted", "score_category_weighted"),
                  _r("score_interactive", "score_interactive"))

PARTIAL_ORDER = """
        SELECT *, reflexive AND antisymmetric AND transitive AS is_partial_order FROM (
        SELECT year, category,
          NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT year, category, step FROM nested) t
                      WHERE t.year = k.year AND t.category = k.category
                        AND NOT EXISTS (SELECT 1 FROM nrel r WHERE r.year = t.year AND r.category = t.category
                                        AND r.t_from = t.step AND r.t_to = t.step)) AS reflexive,
          NOT EXISTS (SELECT 1 FROM nrel a JOIN nrel b ON a.year = b.year AND a.category = b.category
                        AND a.t_from = b.t_to AND a.t_to = b.t_from
                      WHERE a.year = k.year AND a.category = k.category AND a.t_from < a.t_to
                        AND (SELECT count(*) FROM nested x WHERE x.year = a.year AND x.category = a.category AND x.step = a.t_from)
                         <> (SELECT count(*) FROM nested x WHERE x.year = a.year AND x.category = a.category AND x.step = a.t_to)
                     ) AS antisymmetric,
          NOT EXISTS (SELECT 1 FROM nrel a JOIN nrel b ON a.year = b.year AND a.category = b.category AND a.t_to = b.t_from
                      WHERE a.year = k.year AND a.category = k.category
                        AND NOT EXISTS (SELECT 1 FROM nrel c WHERE c.year = a.year AND c.category = a.category
                                        AND c.t_from = a.t_from AND c.t_to = b.t_to)) AS transitive
        FROM (SELECT DISTINCT year, category FROM nested) k)"""

ORACLES: dict[str, str] = {
    "observations": build(f"""
        SELECT city, year, category, month_year, item_description,
               CASE WHEN category <> '{Q.UNPRICED_CATEGORY}' THEN {_r('normalized_price', 'x').removesuffix(' AS x')} END AS normalized_price
        FROM obs""", ["obs"]),
    "prep_time_features": build(f"SELECT {RAW_COLS} FROM raw", ["raw"]),
    "prep_unpivot": build(f"SELECT year, month_year, category, item_description, city, CAST(price AS FLOAT) AS price "
                          f"FROM raw WHERE price IS NOT NULL", ["raw"]),
    "prep_categorize": build(f"""
        SELECT n.n_name AS city, CAST(year(o.o_orderdate) AS INTEGER) AS year, strftime(o.o_orderdate, '%Y-%m') AS month_year,
               CAST(p.p_partkey AS VARCHAR) AS item_description,
               CAST(avg(l.l_extendedprice / l.l_quantity) AS FLOAT) AS price,
               CASE WHEN p.p_type = '{Q.UNPRICED_CATEGORY}' THEN 'Other' ELSE p.p_type END AS category
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN part p ON l.l_partkey = p.p_partkey
        GROUP BY 1, 2, 3, 4, 6""", []).removeprefix("WITH RECURSIVE ").lstrip(),
    "prep_zscore": build(f"SELECT {OBS_COLS} FROM obs", ["obs"]),
    "slice": build(f"SELECT {OBS_COLS} FROM obs WHERE year = {Q.SLICE_YEAR} AND category = '{Q.SLICE_CATEGORY}'",
                   ["obs"]),
    "feature_key": build(
        "SELECT year, category, city, coalesce(CAST(month_year AS VARCHAR), 'None') || '_' || "
        f"coalesce(CAST(item_description AS VARCHAR), 'None') AS feature, {_r('normalized_price', 'normalized_price')} "
        "FROM obs", ["obs"]),
    "vector_dedup": build(f"""
        SELECT year, category, city, feature, {_r('value', 'value')}
        FROM (SELECT CAST(year(o.o_orderdate) AS INTEGER) AS year, p.p_type AS category, n.n_name AS city,
                     strftime(o.o_orderdate, '%Y-%m') || '_' || p.p_type AS feature,
                     l.l_extendedprice / l.l_quantity AS value,
                     row_number() OVER (PARTITION BY year(o.o_orderdate), p.p_type, n.n_name, strftime(o.o_orderdate, '%Y-%m')
                                        ORDER BY l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_extendedprice / l.l_quantity) AS place
              FROM lineitem l
              JOIN orders o ON l.l_orderkey = o.o_orderkey
              JOIN customer c ON o.o_custkey = c.c_custkey
              JOIN nation n ON c.c_nationkey = n.n_nationkey
              JOIN part p ON l.l_partkey = p.p_partkey
              WHERE l.l_returnflag <> 'R')
        WHERE place = 1""", []).removeprefix("WITH RECURSIVE ").lstrip(),
    "vector_features": build(f"SELECT year, category, city, feature, {_r('value', 'value')} FROM feats", ["feats"]),
    "vector_matrix": build(f"SELECT year, category, city, feature, {_r('value', 'value')} FROM rf", ["rf"]),
    "vector_coverage": build(f"""
        SELECT year, category, (SELECT n FROM nr) AS n_cities, n_features,
               (SELECT n FROM nr) * n_features AS n_cells,
               (SELECT n FROM nr) * n_features - nonzero AS zero_count,
               {_r('((SELECT n FROM nr) * n_features - nonzero) * 100.0 / ((SELECT n FROM nr) * n_features)', 'zero_pct')},
               ((SELECT n FROM nr) * n_features - nonzero) * 100.0 / ((SELECT n FROM nr) * n_features) > 70 AS high_missing
        FROM (SELECT year, category, CAST(count(DISTINCT feature) AS BIGINT) AS n_features,
                     CAST(count(*) FILTER (WHERE city IN (SELECT city FROM roster) AND value <> 0) AS BIGINT) AS nonzero
              FROM feats GROUP BY 1, 2)""", ["feats", "nr", "roster"]),
    "vector_norm": build(f"SELECT year, category, city, {_r('norm', 'norm')} FROM norms", ["norms"]),
    "cosine_pairs": build(f"SELECT year, category, u, v, {_r('sim', 'sim')} FROM pairs", ["pairs"]),
    "cosine_pairs_brand": build(f"SELECT year, category, u, v, {_r('sim', 'sim')} FROM pairs_brand", ["pairs_brand"]),
    "similarity_stats": build(f"""
        SELECT g.year, g.category, CAST(np AS BIGINT) AS n_pairs,
               {_r('CASE WHEN np - coalesce(present, 0) > 0 THEN least(coalesce(mn, 0.0), 0.0) ELSE mn END', 'min_sim')},
               {_r('CASE WHEN np - coalesce(present, 0) > 0 THEN greatest(coalesce(mx, 0.0), 0.0) ELSE mx END', 'max_sim')},
               {_r('coalesce(sm, 0.0) / np', 'mean_sim')},
               CAST(np - coalesce(present, 0) + coalesce(zeros, 0) AS BIGINT) AS zero_pairs,
               np - coalesce(present, 0) + coalesce(zeros, 0) > np * 0.5 AS high_zero_share
        FROM groups g
        CROSS JOIN (SELECT n * (n - 1) // 2 AS np FROM nr)
        LEFT JOIN (SELECT year, category, min(sim) AS mn, max(sim) AS mx, sum(sim) AS sm, count(*) AS present,
                          count(*) FILTER (WHERE sim = 0) AS zeros FROM pairs GROUP BY 1, 2) p
          ON p.year = g.year AND p.category = g.category""", ["groups", "pairs", "nr"]),
    "similarity_matrix": build(f"""
        SELECT g.year, g.category, a.city AS city_i, b.city AS city_j,
               {_r("CASE WHEN a.city = b.city THEN 1.0 ELSE coalesce(p.sim, 0.0) END", 'sim')}
        FROM groups g CROSS JOIN roster a CROSS JOIN roster b
        LEFT JOIN pairs p ON p.year = g.year AND p.category = g.category
                         AND p.u = least(a.city, b.city) AND p.v = greatest(a.city, b.city)""",
                               ["groups", "roster", "pairs"]),
    "threshold_edges": build(f"SELECT year, category, u, v, {_r('sim', 'sim')}, {_r('weight', 'weight')} FROM edges",
                             ["edges"]),
    "threshold_join": build(f"SELECT year, category, u, v, {_r('sim', 'sim')}, {_r('weight', 'weight')} FROM edges",
                            ["edges"]),
    "threshold_join_tau075": build(f"SELECT year, category, u, v, {_r('sim', 'sim')}, {_r('weight', 'weight')} FROM edges",
                                   ["edges"], tau=0.75),
    "weighted_edges": build(f"SELECT year, category, u, v, {_r('sim', 'sim')}, {_r('sim', 'weight')} FROM edges",
                            ["edges"]),
    "network_nodes": build("SELECT year, category, node_id, city FROM nodes", ["nodes"]),
    "network_adjacency": build("SELECT year, category, src, dst FROM adj", ["adj"]),
    "network_metadata": build(f"SELECT year, category, num_nodes, num_edges, {_r('density', 'density')}, "
                              f"{_r('threshold', 'threshold')}, weighted FROM meta", ["meta"]),
    "networks_nonempty": build(f"SELECT year, category, num_nodes, num_edges, {_r('density', 'density')}, "
                               f"{_r('threshold', 'threshold')}, weighted FROM nets", ["nets"]),
    "network_stats": build(f"""
        SELECT w.year, w.category, w.num_nodes, w.num_edges, {_r('w.density', 'density')},
               {_r('d.avg_degree', 'avg_degree')}, d.max_degree, d.min_degree
        FROM nets w JOIN (SELECT year, category, avg(degree) AS avg_degree, max(degree) AS max_degree,
                                 min(degree) AS min_degree FROM deg GROUP BY 1, 2) d USING (year, category)""",
                           ["nets", "deg"]),
    "connected_components": build("SELECT year, category, num_components, is_connected FROM ccount", ["ccount"]),
    "clustering_coefficient": build(f"SELECT year, category, {_r('clustering', 'clustering')} FROM clust", ["clust"]),
    "path_metrics": build(f"""
        SELECT k.year, k.category, k.num_components, k.is_connected,
               CASE WHEN k.is_connected AND (SELECT n FROM nr) > 1 THEN CAST(p.diam AS BIGINT) END AS diameter,
               {_r('CASE WHEN k.is_connected AND (SELECT n FROM nr) > 1 THEN p.apl END', 'avg_path_length')}
        FROM ccount k LEFT JOIN (SELECT year, category, max(d) AS diam, avg(d) AS apl
                                 FROM paths WHERE d > 0 GROUP BY 1, 2) p USING (year, category)""",
                          ["ccount", "paths", "nr"]),
    "network_statistics": build(f"""
        SELECT w.year, w.category, w.num_nodes, w.num_edges, {_r('w.density', 'density')},
               {_r('d.avg_degree', 'avg_degree')}, d.max_degree, d.min_degree, {_r('c.clustering', 'clustering')},
               k.num_components, k.is_connected,
               CASE WHEN k.is_connected AND (SELECT n FROM nr) > 1 THEN CAST(p.diam AS BIGINT) END AS diameter,
               {_r('CASE WHEN k.is_connected AND (SELECT n FROM nr) > 1 THEN p.apl END', 'avg_path_length')}
        FROM nets w
        JOIN (SELECT year, category, avg(degree) AS avg_degree, max(degree) AS max_degree,
                     min(degree) AS min_degree FROM deg GROUP BY 1, 2) d USING (year, category)
        JOIN clust c USING (year, category) JOIN ccount k USING (year, category)
        LEFT JOIN (SELECT year, category, max(d) AS diam, avg(d) AS apl
                   FROM paths WHERE d > 0 GROUP BY 1, 2) p USING (year, category)""",
                                ["nets", "deg", "clust", "ccount", "paths", "nr"]),
    "network_summary": build(f"""
        SELECT count(*) AS num_networks, CAST(sum(num_edges) AS BIGINT) AS total_edges,
               {_r('avg(density)', 'mean_density')}, {_r('min(density)', 'min_density')},
               {_r('max(density)', 'max_density')} FROM nets""", ["nets"]),
    "induced_subgraph": build(f"""
        SELECT e.year, e.category, e.u, e.v, {_r('e.sim', 'sim')}, {_r('e.weight', 'weight')}
        FROM edges e
        JOIN roster ru ON ru.city = e.u JOIN roster rv ON rv.city = e.v
        WHERE ru.node_id < {Q.INDUCED_N} AND rv.node_id < {Q.INDUCED_N}""", ["edges", "roster"]),
    "shortest_paths": build(f"SELECT year, category, s, t, d, {_r('sigma', 'sigma')} FROM paths", ["paths"]),
    "degree_centrality": build(f"SELECT year, category, city, {_r('d_i', 'd_i')} FROM dc", ["dc"]),
    "closeness_centrality": build(f"SELECT year, category, city, {_r('c_i', 'c_i')} FROM cc", ["cc"]),
    "betweenness_centrality": build(f"SELECT year, category, city, {_r('b_i', 'b_i')} FROM bc", ["bc"]),
    "eigenvector_centrality": build(f"SELECT year, category, city, {_r('e_i', 'e_i')} FROM ec", ["ec"]),
    "centrality_single": build(f"SELECT {CENT_COLS} FROM cent WHERE year = {Q.SLICE_YEAR} "
                               f"AND category = '{Q.SLICE_CATEGORY}'", ["cent"]),
    "centrality_all": build(f"SELECT {CENT_COLS} FROM cent", ["cent"]),
    "centrality_minmax": build(f"""
        SELECT {CENT_COLS},
          {_r("CASE WHEN max(d_i) OVER w = min(d_i) OVER w THEN 0.5 ELSE (d_i - min(d_i) OVER w) / (max(d_i) OVER w - min(d_i) OVER w) END", 'd_i_norm')},
          {_r("CASE WHEN max(c_i) OVER w = min(c_i) OVER w THEN 0.5 ELSE (c_i - min(c_i) OVER w) / (max(c_i) OVER w - min(c_i) OVER w) END", 'c_i_norm')},
          {_r("CASE WHEN max(b_i) OVER w = min(b_i) OVER w THEN 0.5 ELSE (b_i - min(b_i) OVER w) / (max(b_i) OVER w - min(b_i) OVER w) END", 'b_i_norm')},
          {_r("CASE WHEN max(e_i) OVER w = min(e_i) OVER w THEN 0.5 ELSE (e_i - min(e_i) OVER w) / (max(e_i) OVER w - min(e_i) OVER w) END", 'e_i_norm')}
        FROM cent WINDOW w AS (PARTITION BY year, category)""", ["cent"]),
    "top_cities": build(f"""
        SELECT {CENT_COLS}, CAST(row_number() OVER (ORDER BY round(d_i, 9) DESC, city, year, category) AS INTEGER) AS rank
        FROM cent ORDER BY round(d_i, 9) DESC, city, year, category LIMIT {Q.TOP_N}""", ["cent"]),
    "centrality_summary": build(f"""
        SELECT metric, {_r('avg(value)', 'mean')}, {_r('median(value)', 'median')},
               {_r('stddev_samp(value)', 'std')}, {_r('min(value)', 'min')}, {_r('max(value)', 'max')},
               CAST(count(*) FILTER (WHERE value = 0) AS BIGINT) AS zeros
        FROM (UNPIVOT cent ON d_i, c_i, b_i, e_i INTO NAME metric VALUE value) GROUP BY 1""", ["cent"]),
    "top3_per_metric": build(f"""
        SELECT year, category, city, metric, {_r('value', 'value')}, rank FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY metric ORDER BY round(value, 9) DESC, city, year, category) AS INTEGER) AS rank
          FROM (UNPIVOT cent ON d_i, c_i, b_i, e_i INTO NAME metric VALUE value)) WHERE rank <= 3""", ["cent"]),
    "score_equal": build(f"SELECT {CENT_COLS}, {_r('0.25 * (d_i + c_i + b_i + e_i)', 'score_equal')} FROM cent",
                         ["cent"]),
    "metric_correlations": build("SELECT year, category, " + ", ".join(
        _r(c, c) for c in ["rho_d_i_c_i", "rho_d_i_b_i", "rho_d_i_e_i", "rho_c_i_b_i", "rho_c_i_e_i", "rho_b_i_e_i"])
        + " FROM rho", ["rho"]),
    "score_correlation": build(f"SELECT {CENT_COLS}, {_r('score_correlation', 'score_correlation')} FROM scores",
                               ["scores"]),
    "score_category": build(f"SELECT {CENT_COLS}, {_r('score_category', 'score_category')}, "
                            f"{_r('score_category_weighted', 'score_category_weighted')} FROM scores", ["scores"]),
    "metric_entropy": build("SELECT year, category, " + ", ".join(_r(c, c) for c in ["h_d_i", "h_c_i", "h_b_i", "h_e_i"])
                            + " FROM ent", ["ent"]),
    "score_entropy": build(f"SELECT {CENT_COLS}, {_r('score_entropy', 'score_entropy')} FROM scores", ["scores"]),
    "score_custom": build(f"SELECT {CENT_COLS}, " + _r(
        " + ".join(f"{w!r} * {m.lower()}" for m, w in Q.CUSTOM_WEIGHTS.items()), "score_interactive")
        + " FROM cent", ["cent"]),
    "scores_all": build(f"""SELECT {CENT_COLS}, {_r('score_equal', 'score_equal')},
        {_r('score_correlation', 'score_correlation')}, {_r('score_category', 'score_category')},
        {_r('score_category_weighted', 'score_category_weighted')}, {_r('score_entropy', 'score_entropy')},
        {_r('score_interactive', 'score_interactive')} FROM scores""", ["scores"]),
    "scores_by_year": build(f"SELECT {SCORE_SEL} FROM yscores", ["yscores"]),
    "rankings": build(f"""
        SELECT year, CAST(row_number() OVER (PARTITION BY year ORDER BY round(score_equal, 9) DESC, city) AS INTEGER) AS rank,
               city, {_r('score_equal', 'score_equal')} FROM yscores""", ["yscores"]),
    "compare_schemes": build(f"""
        SELECT year, city,
          max(CASE WHEN scheme = 'score_equal' THEN rank END) AS rank_score_equal,
          {_r("max(CASE WHEN scheme = 'score_equal' THEN score END)", 'score_score_equal')},
          max(CASE WHEN scheme = 'score_correlation' THEN rank END) AS rank_score_correlation,
          {_r("max(CASE WHEN scheme = 'score_correlation' THEN score END)", 'score_score_correlation')},
          max(CASE WHEN scheme = 'score_entropy' THEN rank END) AS rank_score_entropy,
          {_r("max(CASE WHEN scheme = 'score_entropy' THEN score END)", 'score_score_entropy')},
          max(CASE WHEN scheme = 'score_category_weighted' THEN rank END) AS rank_score_category_weighted,
          {_r("max(CASE WHEN scheme = 'score_category_weighted' THEN score END)", 'score_score_category_weighted')},
          max(CASE WHEN scheme = 'score_interactive' THEN rank END) AS rank_score_interactive,
          {_r("max(CASE WHEN scheme = 'score_interactive' THEN score END)", 'score_score_interactive')}
        FROM (SELECT year, city, scheme, score,
                     CAST(row_number() OVER (PARTITION BY year, scheme ORDER BY round(score, 9) DESC, city) AS INTEGER) AS rank
              FROM (UNPIVOT yscores ON score_equal, score_correlation, score_entropy, score_category_weighted,
                    score_interactive INTO NAME scheme VALUE score))
        WHERE rank <= {Q.TOP_N} GROUP BY 1, 2""", ["yscores"]),
    "edge_subset": build("""
        SELECT k.year, k.category, NOT EXISTS (
            SELECT 1 FROM pairs a WHERE a.year = k.year AND a.category = k.category AND a.sim >= 0.5
              AND NOT EXISTS (SELECT 1 FROM pairs b WHERE b.year = a.year AND b.category = a.category
                              AND b.u = a.u AND b.v = a.v AND b.sim >= 0.2)) AS is_subset
        FROM (SELECT DISTINCT year, category FROM pairs WHERE sim >= 0.2 OR sim >= 0.5) k""", ["pairs"]),
    "edge_subset_swapped": build("""
        SELECT year, category, count(*) FILTER (WHERE sim < 0.5) = 0 AS is_subset
        FROM pairs WHERE sim >= 0.2 GROUP BY 1, 2""", ["pairs"]),
    "containment_relation": build("SELECT year, category, t_from, t_to FROM nrel", ["nrel"]),
    "containment_relation_years": build(CONTAINED_YEARS, ["edges"]),
    "containment_relation_turns": build(CONTAINED_YEARS.replace("edges", "turns"), ["turns"]),
    "containment_reduction": build("SELECT year, category, t_from, t_to FROM nred", ["nred"]),
    "hasse_edges": build("""
        SELECT r.year, r.category, r.t_from, r.t_to, k.num_years
        FROM nred r JOIN (SELECT year, category, count(*) AS num_years FROM nred WHERE t_from = t_to GROUP BY 1, 2) k
          USING (year, category) WHERE r.t_from <> r.t_to""", ["nred"]),
    "partial_order_check": build(PARTIAL_ORDER, ["nested", "nrel"]),
    "partial_order_broken": build(PARTIAL_ORDER.replace("nrel", "nrel_broken"), ["nested", "nrel_broken"]),
    "network_evolution": build(f"SELECT year, category, nodes, edges, {_r('density', 'density')}, "
                               f"{_r('clustering', 'clustering')}, components, is_connected FROM evo", ["evo"]),
    "density_by_year": build(f"SELECT year, {_r('avg(density)', 'mean_density')} FROM evo GROUP BY 1", ["evo"]),
    "feed_network": build("SELECT year, category, city, degree, degree * 100 + 100 AS node_size FROM deg", ["deg"]),
    "feed_network_edges": build(f"SELECT year, category, u, v, {_r('sim', 'width')} FROM edges", ["edges"]),
    "feed_radar": build(f"""
        SELECT year, category, city, metric, {_r('value', 'value')}
        FROM (UNPIVOT (SELECT * FROM cent WHERE city = '{Q.RADAR_CITY}' AND year = {Q.RADAR_YEAR})
              ON d_i, c_i, b_i, e_i INTO NAME metric VALUE value)""", ["cent"]),
    "feed_top_by_scheme": build(f"""
        SELECT year, city, scheme, {_r('score', 'score')}, rank FROM (
          SELECT year, city, scheme, score,
                 CAST(row_number() OVER (PARTITION BY year, scheme ORDER BY round(score, 9) DESC, city) AS INTEGER) AS rank
          FROM (UNPIVOT yscores ON score_equal, score_correlation, score_entropy, score_category_weighted,
                score_interactive INTO NAME scheme VALUE score)) WHERE rank <= 5""", ["yscores"]),
    "feed_metric_series": build(f"SELECT year, {_r('density', 'value')} FROM evo WHERE category = '{Q.SERIES_CATEGORY}'",
                                ["evo"]),
    "overview_counts": build(f"""
        SELECT count(DISTINCT city) AS num_cities, count(DISTINCT category) AS num_categories,
               count(DISTINCT year) AS num_years, {_r(repr(Q.TAU), 'threshold')} FROM obs""", ["obs"]),
    "report_summary": build(f"""
        SELECT (SELECT count(*) FROM nets) AS num_networks, (SELECT count(*) FROM cent) AS num_centrality_rows,
               (SELECT count(DISTINCT city) FROM cent) AS unique_cities,
               {_r('(SELECT avg(density) FROM evo)', 'mean_density')},
               {_r('(SELECT avg(clustering) FROM evo)', 'mean_clustering')}""", ["nets", "cent", "evo"]),
    "report_top5": build(f"""
        SELECT year, city, {_r('score_equal', 'score_equal')}, rank FROM (
          SELECT year, city, score_equal,
                 CAST(row_number() OVER (PARTITION BY year ORDER BY round(score_equal, 9) DESC, city) AS INTEGER) AS rank
          FROM yscores) WHERE rank <= 5""", ["yscores"]),
    # the original default threshold and the eigenvector failure case
    "network_metadata_tau075": build(f"SELECT year, category, num_nodes, num_edges, {_r('density', 'density')}, "
                                     f"{_r('threshold', 'threshold')}, weighted FROM meta", ["meta"], tau=0.75),
    "centrality_all_tau075": build(f"SELECT {CENT_COLS} FROM cent", ["cent"], tau=0.75),
    "eigenvector_centrality_tau05": build(f"SELECT year, category, city, {_r('e_i', 'e_i')} FROM ec", ["ec"],
                                          tau=0.5),
    "path_metrics_tau05": build(f"""
        SELECT k.year, k.category, k.num_components, k.is_connected,
               CASE WHEN k.is_connected AND (SELECT n FROM nr) > 1 THEN CAST(p.diam AS BIGINT) END AS diameter,
               {_r('CASE WHEN k.is_connected AND (SELECT n FROM nr) > 1 THEN p.apl END', 'avg_path_length')}
        FROM ccount k LEFT JOIN (SELECT year, category, max(d) AS diam, avg(d) AS apl
                                 FROM paths WHERE d > 0 GROUP BY 1, 2) p USING (year, category)""",
                                ["ccount", "paths", "nr"], tau=0.5),
}
