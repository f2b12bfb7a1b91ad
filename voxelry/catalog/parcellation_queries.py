"""Queries of region schemes and anatomical rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import regions as R
from ..operators import parcellation as P
from . import recipe as V
from .recipe import DIMS, NI, NJ, NK
from .registry import query
from .sqltext import VOX, components as cc_views, eroded, near, sql
from .neighbour_queries import hull_sql
from .voxel_queries import lut_values


def values(pairs: dict | list, alias: str) -> str:
    rows = pairs.items() if isinstance(pairs, dict) else pairs
    return "(VALUES " + ", ".join(f"({a}, {b!r})" for a, b in rows) + f") {alias}"


def labels_in(codes) -> str:
    return "(" + ", ".join(map(str, codes)) + ")"


def _scheme(name: str):
    text = sql(f"SELECT {VOX}, region_label AS label, region FROM derived JOIN {lut_values(name)} ON label = src_label")

    @query(f"parcellate_{name}", text)
    def run(spark, d):
        return P.parcellate(V.derived(spark, d), name)


for _name in R.SCHEMES:
    _scheme(_name)


@query("parcellate_for_biomarker", sql(" UNION ALL ".join(
    f"SELECT {VOX}, region_label AS label, region, '{b}' AS biomarker FROM derived JOIN {lut_values(s)} ON label = src_label" for b, s in R.BIOMARKER_SCHEME.items())))
def parcellate_for_biomarker(spark, d):
    return P.parcellate_for_biomarker(V.derived(spark, d), list(R.BIOMARKER_SCHEME))


@query("fs_regions", sql(f"""SELECT {VOX}, code AS label, region FROM (SELECT *, CASE WHEN label BETWEEN 1000 AND 1035 THEN 3 WHEN label BETWEEN 2000 AND 2035 THEN 42 ELSE label END AS code
 FROM parc WHERE label <> 24) JOIN {values([(c, n) for n, c in R.FS_REGIONS.items()], 'f(c, region)')} ON code = c"""))
def fs_regions(spark, d):
    return P.fs_regions(V.parc(spark, d))


ISLANDS = dict(
    **cc_views("parc", equal="label"),
    sizes="SELECT subject_id, cluster_id, any_value(label) AS label, count(*) AS n FROM cc GROUP BY 1, 2",
    ranked="SELECT *, row_number() OVER (PARTITION BY subject_id, label ORDER BY n DESC, cluster_id) AS rn FROM sizes",
    isles="SELECT * FROM ranked WHERE rn > 1 AND n <= 5 AND label <> 251",
    around="""SELECT DISTINCT c.subject_id, c.cluster_id AS island, o.i, o.j, o.k, o.label FROM cc c JOIN isles USING (subject_id, cluster_id)
 JOIN cc o ON o.subject_id = c.subject_id AND abs(o.i-c.i) + abs(o.j-c.j) + abs(o.k-c.k) = 1 AND o.cluster_id <> c.cluster_id""",
    won="SELECT subject_id, island, arg_max(label, (n, -label)) AS new FROM (SELECT subject_id, island, label, count(*) AS n FROM around GROUP BY ALL) GROUP BY ALL")


@query("remove_islands", sql(f"""SELECT {VOX}, coalesce(new, label)::INT AS label, CASE WHEN new IS NOT NULL THEN label END AS removed
 FROM cc LEFT JOIN won ON cc.subject_id = won.subject_id AND cc.cluster_id = won.island""".replace(VOX, "cc.subject_id, i, j, k"), **ISLANDS))
def remove_islands(spark, d):
    return P.remove_islands(V.parc(spark, d), DIMS, 5, [251])


HYPER = dict(
    hyp=f"SELECT {VOX} FROM parc WHERE label = 77",
    **cc_views("hyp", 1, name="hc"),
    touch="""SELECT h.subject_id, h.cluster_id, h.i, h.j, h.k, max((p.label = 2)::INT) AS l, max((p.label = 41)::INT) AS r FROM hc h LEFT JOIN parc p
 ON p.subject_id = h.subject_id AND p.label IN (2, 41) AND abs(p.i-h.i) + abs(p.j-h.j) + abs(p.k-h.k) = 1 GROUP BY ALL""",
    halves="SELECT subject_id, count(*) FILTER (label = 2) AS al, count(*) FILTER (label = 41) AS ar FROM parc GROUP BY 1",
    side_of="""SELECT subject_id, cluster_id, CASE WHEN coalesce(sum(l), 0) > coalesce(sum(r), 0) THEN 2 WHEN coalesce(sum(r), 0) > coalesce(sum(l), 0) THEN 41
 WHEN any_value(al) >= any_value(ar) THEN 2 ELSE 41 END AS wm FROM touch JOIN halves USING (subject_id) GROUP BY 1, 2""",
    seg=f"""SELECT {VOX}, label FROM parc WHERE label <> 77 UNION ALL SELECT {VOX}, wm::INT AS label FROM hc JOIN side_of USING (subject_id, cluster_id)""")


@query("hyperintensity_to_wm", sql(f"SELECT {VOX}, label FROM seg", **HYPER))
def hyperintensity_to_wm(spark, d):
    return P.hyperintensity_to_wm(V.parc_table(spark, d), DIMS)


def _seeds(side: str) -> list[tuple[int, int]]:
    shift = R.RIGHT_PARCEL if side == "R" else 0
    return [(p + shift, R.code(lobe, side)) for lobe, ps in R.LOBE_PARCELS.items() for p in ps if p not in R.FILLED_PARCELS]


OTHERS = [(v, R.code(n, s)) for n, sides in R.STRUCTURES.items() for s, vs in zip("LR", sides) for v in vs] + [(R.BRAINSTEM, R.BRAINSTEM_CODE)]


def lobar_views(source: str) -> dict[str, str]:
    seeds = " UNION ALL ".join(f"SELECT {VOX}, c AS label, '{s}' AS side FROM {source} JOIN {values(_seeds(s), 'v(o, c)')} ON label = o" for s in "LR")
    shift = {"L": 0, "R": R.RIGHT_PARCEL}
    open_ = " UNION ALL ".join(f"SELECT {VOX}, '{s}' AS side FROM {source} WHERE label IN {labels_in([R.WHITE_MATTER[s]] + [p + shift[s] for p in R.FILLED_PARCELS])}" for s in "LR")
    return dict(
        lobe_seeds=seeds, lobe_open=open_,
        lobar=f"""SELECT m.subject_id, m.i, m.j, m.k, arg_min(label, greatest(abs(m.i-s.i), abs(m.j-s.j), abs(m.k-s.k)) * 1000 + label)::INT AS label
 FROM lobe_open m JOIN lobe_seeds s ON m.subject_id = s.subject_id AND m.side = s.side GROUP BY ALL
 UNION ALL SELECT {VOX}, label FROM lobe_seeds UNION ALL SELECT {VOX}, c AS label FROM {source} JOIN {values(OTHERS, 'v(o, c)')} ON label = o""")


@query("lobar_labels", sql(f"SELECT {VOX}, label FROM lobar", **lobar_views("parc")))
def lobar_labels(spark, d):
    return P.lobar_labels(V.parc_table(spark, d), DIMS)


def sided_sql(source: str, members: dict) -> str:
    return " UNION ALL ".join(f"SELECT {VOX}, '{s}' AS side FROM {source} WHERE label IN {labels_in(members[s])}" for s in "LR")


def rule_views(source: str) -> dict[str, str]:
    """Views of the anatomical rules on a label map."""
    parcels = [p for ps in R.LOBE_PARCELS.values() for p in ps]
    cortex = parcels + [p + R.RIGHT_PARCEL for p in parcels]
    return dict(
        wm=sided_sql(source, {s: [c] for s, c in R.WHITE_MATTER.items()}),
        nuclei=sided_sql(source, R.CAPSULE_NUCLEI), nuclei_hull=hull_sql("nuclei", "side"), nuclei_core=eroded("nuclei_hull", 3, "side", True),
        capsule=f"SELECT {VOX}, side FROM nuclei_core SEMI JOIN wm USING ({VOX}, side)",
        cortex=f"SELECT {VOX} FROM {source} WHERE label IN {labels_in(cortex)}", cortex_near=near("cortex", 3),
        juxta=f"SELECT {VOX}, side FROM wm SEMI JOIN cortex_near USING ({VOX})",
        vent=f"SELECT {VOX} FROM {source} WHERE label IN {labels_in(R.VENTRICLES['L'] + R.VENTRICLES['R'])}", vent_near=near("vent", 2),
        peri=f"SELECT {VOX} FROM vent_near ANTI JOIN vent USING ({VOX})",
        peri_wm=f"SELECT {VOX}, side FROM wm SEMI JOIN peri USING ({VOX})",
        inner_caps=f"SELECT {VOX}, side FROM capsule ANTI JOIN peri_wm USING ({VOX}, side)")


RULES = rule_views("parc")


@query("internal_capsule", sql(f"SELECT {VOX}, side FROM capsule", **RULES))
def internal_capsule(spark, d):
    return P.internal_capsule(V.parc_table(spark, d), DIMS)


@query("juxtacortical_wm", sql(f"SELECT {VOX}, side FROM juxta", **RULES))
def juxtacortical_wm(spark, d):
    return P.juxtacortical_wm(V.parc(spark, d), DIMS)


@query("periventricular", sql(f"SELECT {VOX} FROM peri", **RULES))
def periventricular(spark, d):
    return P.periventricular(V.parc(spark, d), DIMS)


@query("periventricular_wm", sql(f"SELECT {VOX}, side FROM own_near SEMI JOIN wm USING ({VOX}, side)",
                                 **RULES, own_vent=sided_sql("parc", R.VENTRICLES), own_near=near("own_vent", 2, "side")))
def periventricular_wm(spark, d):
    return P.periventricular_wm(V.parc(spark, d), DIMS)


def external_views(source: str, barred: str, reach: int, low: int) -> dict[str, str]:
    walls = {s: [R.PUTAMEN[s], R.INSULA[s]] for s in "LR"}
    return dict(
        walls=sided_sql(source, walls), walls_hull=hull_sql("walls", "side"),
        put=sided_sql(source, {s: [R.PUTAMEN[s]] for s in "LR"}), ins=sided_sql(source, {s: [R.INSULA[s]] for s in "LR"}),
        put_near=near("put", reach, "side"), ins_near=near("ins", reach, "side"),
        lower=f"SELECT {VOX} FROM {source} WHERE label IN {labels_in(R.HIPPOCAMPUS_VENTRAL_DC)}", lower_near=near("lower", low),
        barred=f"{barred} UNION SELECT {VOX} FROM lower_near",
        ext_core=f"""SELECT {VOX}, side FROM walls_hull SEMI JOIN put_near USING ({VOX}, side) SEMI JOIN ins_near USING ({VOX}, side)
 SEMI JOIN wm USING ({VOX}, side) ANTI JOIN barred USING ({VOX})""",
        ext_all=f"SELECT {VOX}, side FROM ext_core UNION SELECT {VOX}, side FROM walls", ext_grown=near("ext_all", 3, "side"), ext_closed=eroded("ext_grown", 3, "side"),
        external=f"SELECT {VOX}, side FROM ext_closed ANTI JOIN walls USING ({VOX}, side) SEMI JOIN wm USING ({VOX}, side)")


EXTERNAL = external_views("parc", f"SELECT {VOX} FROM juxta UNION SELECT {VOX} FROM inner_caps", 10, 5)


@query("external_capsule", sql(f"SELECT {VOX}, side FROM external", **RULES, **external_views("parc", f"SELECT {VOX} FROM peri", 6, 1)))
def external_capsule(spark, d):
    labels = V.parc_table(spark, d)
    return P.external_capsule(labels, DIMS, P.periventricular(labels, DIMS), reach=6, low=1)


def callosum_views(source: str, reach: int, closing: int, growth: int, opening: int) -> dict[str, str]:
    own = labels_in(R.CORPUS_CALLOSUM)
    cingulate = {"L": R.CINGULATE_PARCELS, "R": [p + R.RIGHT_PARCEL for p in R.CINGULATE_PARCELS]}
    return dict(
        cc_own=f"SELECT {VOX} FROM {source} WHERE label IN {own}", cc_grown=near("cc_own", 1),
        cc_split=f"""SELECT m.subject_id, m.i, m.j, m.k, arg_min(s.side, greatest(abs(m.i-s.i), abs(m.j-s.j), abs(m.k-s.k)) * 10 + (s.side = 'R')::INT) AS side
 FROM cc_grown m JOIN (SELECT {VOX}, side FROM wm SEMI JOIN cc_grown USING ({VOX})) s ON m.subject_id = s.subject_id GROUP BY ALL""",
        rest=f"SELECT * FROM {source} ANTI JOIN cc_own USING (subject_id)",
        third=f"SELECT {VOX} FROM rest WHERE label = {R.THIRD_VENTRICLE}", third_near=near("third", reach),
        fornix0=f"SELECT {VOX} FROM rest WHERE label IN {labels_in(R.LATERAL_VENTRICLES)} UNION SELECT {VOX} FROM third_near", fornix1=near("fornix0", reach), fornix=eroded("fornix1", reach),
        cing0=sided_sql("rest", cingulate), cing1=near("cing0", closing, "side"), cing=eroded("cing1", closing, "side"),
        halves_wm=f"SELECT {VOX}, side FROM wm SEMI JOIN rest USING ({VOX})",
        free=f"SELECT {VOX} FROM halves_wm ANTI JOIN fornix USING ({VOX}) ANTI JOIN cing USING ({VOX})",
        half_near=near("halves_wm", 1, "side"),
        meet=f"SELECT {VOX} FROM half_near SEMI JOIN free USING ({VOX}) GROUP BY ALL HAVING count(*) = 2",
        body0=near("meet", growth), body1=f"SELECT {VOX} FROM body0 SEMI JOIN free USING ({VOX})",
        body2=eroded("body1", opening + 1, "", True), body3=near("body2", opening),
        callosum=f"SELECT {VOX}, side FROM cc_split UNION ALL SELECT {VOX}, side FROM halves_wm SEMI JOIN body3 USING ({VOX})")


@query("corpus_callosum", sql(f"SELECT {VOX}, side FROM callosum", **RULES, **callosum_views("parc", 1, 2, 3, 1)))
def corpus_callosum(spark, d):
    return P.corpus_callosum(V.parc_table(spark, d), DIMS, 1, 2, 3, 1)


LOBES = labels_in(list(R.LOBE_CODES.values()) + [v + R.RIGHT_LOBE for v in R.LOBE_CODES.values()])


def _over(view: str, name: str, prio: int) -> str:
    return f"SELECT {VOX}, CASE side WHEN 'L' THEN {R.code(name, 'L')} ELSE {R.code(name, 'R')} END, {prio} FROM {view}"


FULL = dict(
    **HYPER, **rule_views("seg"), **lobar_views("seg"), **external_views("seg", f"SELECT {VOX} FROM juxta UNION SELECT {VOX} FROM inner_caps", 10, 5),
    **callosum_views("seg", 6, 5, 10, 2),
    on_lobe=f"SELECT {VOX}, side, label FROM wm JOIN lobar USING ({VOX}) WHERE label IN {LOBES}",
    near_own=f"SELECT {VOX}, label FROM lobar SEMI JOIN peri USING ({VOX})",
    layers=" UNION ALL ".join([
        f"SELECT {VOX}, label, 0 AS prio FROM lobar", f"SELECT {VOX}, label + 2, 1 FROM on_lobe", f"SELECT {VOX}, label + 1, 2 FROM on_lobe SEMI JOIN juxta USING ({VOX}, side)",
        f"SELECT {VOX}, label + 3, 3 FROM on_lobe SEMI JOIN peri_wm USING ({VOX}, side)", _over("inner_caps", "Internal capsule", 4), _over("external", "External capsule", 5),
        _over("callosum", "Corpus callosum", 6), f"SELECT {VOX}, label + 38, 7 FROM near_own WHERE label IN (40, 50)",
        _over(f"capsule SEMI JOIN peri USING ({VOX})", "Internal capsule periventricular", 8), f"SELECT {VOX}, label + 38, 9 FROM near_own WHERE label IN (41, 51)"]))


@query("lobar_wm_parcellation", sql(f"SELECT {VOX}, arg_max(label, prio)::INT AS label FROM layers GROUP BY ALL", **FULL))
def lobar_wm_parcellation(spark, d):
    return P.lobar_wm_parcellation(V.parc(spark, d), DIMS)


WALL = dict(
    bg="SELECT subject_id, min(j) AS j0, max(j) AS j1, min(k) AS k0, max(k) AS k1 FROM parc WHERE label IN " + labels_in(R.BASAL_GANGLIA_BOX) + " GROUP BY 1",
    insula=f"SELECT subject_id, i, j, k, CASE WHEN i < {NI // 2} THEN 'L' ELSE 'R' END AS side FROM parc WHERE label IN (1035, 2035)",
    lines="SELECT subject_id, side, j, k, min(i) AS a, max(i) AS b FROM insula GROUP BY ALL",
    cols="SELECT subject_id, side, j, min(k) AS ka, max(k) AS kb FROM insula GROUP BY ALL",
    ends="SELECT subject_id, side, min(j) AS ja, max(j) AS jb FROM insula GROUP BY ALL",
    cells=f"""SELECT e.subject_id, e.side, ja, jb, y.j, coalesce(ka, 0) AS ka, coalesce(kb, 0) AS kb, z.k FROM ends e JOIN range({NJ}) y(j) ON y.j BETWEEN ja AND jb
 LEFT JOIN cols c ON c.subject_id = e.subject_id AND c.side = e.side AND c.j = y.j JOIN range({NK}) z(k) ON z.k BETWEEN coalesce(ka, 0) AND coalesce(kb, 0)""",
    carried="""SELECT s.*, last_value(a IGNORE NULLS) OVER w AS wa, last_value(b IGNORE NULLS) OVER w AS wb FROM (SELECT c.*, l.a, l.b FROM cells c LEFT JOIN lines l
 ON l.subject_id = c.subject_id AND l.side = c.side AND l.j = c.j AND l.k = c.k) s WINDOW w AS (PARTITION BY subject_id, side ORDER BY j, k)""",
    spread=f"""SELECT subject_id, side, wa, wb, unnest(range(CASE WHEN j = ja THEN 0 ELSE j END, CASE WHEN j = jb AND ja <> jb THEN {NJ} ELSE j + 1 END)) AS y,
 CASE WHEN k = ka THEN 0 ELSE k END AS z0, CASE WHEN k = kb THEN {NK} ELSE k + 1 END AS z1 FROM carried""",
    edges="""SELECT subject_id, y AS j, z AS k, max(CASE side WHEN 'L' THEN wa END) AS lo, min(CASE side WHEN 'R' THEN wb END) AS hi
 FROM (SELECT *, unnest(range(z0, z1)) AS z FROM spread) GROUP BY ALL""")


@query("basal_ganglia_box", sql("""SELECT g.subject_id, g.i, g.j, g.k FROM grid g JOIN bg USING (subject_id) LEFT JOIN edges e ON e.subject_id = g.subject_id AND e.j = g.j AND e.k = g.k
 WHERE g.j BETWEEN j0 AND j1 AND g.k BETWEEN k0 AND k1 AND (lo IS NULL OR g.i >= lo) AND (hi IS NULL OR g.i <= hi)""", **WALL))
def basal_ganglia_box(spark, d):
    return P.basal_ganglia_box(V.parc_table(spark, d), DIMS)
