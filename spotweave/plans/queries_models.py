"""M and T: matrix, graph and statistics operators, and the stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from spotweave.functions import stats
from spotweave.functions.runtime import durable, scratch_path
from spotweave.operators import (
    associations, autocorr as ac, cohort, communities as cm, design, enrichment as en, factorial as fx, glm,
    lattice as la, neighbors as nb, pca, roi)
from spotweave.operators.components import component_sizes, connected_components
from spotweave.plans import standin as v
from spotweave.plans.queries_aggs import EXC, WARN_SQL, id_effects, rounded
from spotweave.plans.queries_joins import HEX_SQL
from spotweave.plans.registry import query

KEY = ["sample_id", "barcode"]


# --- expression space -------------------------------------------------------

@query("m01_highly_variable_genes")
def _(spark, d):
    return pca.highly_variable(v.counts(spark, d), v.primary(spark, d), n_top=3000)


@query("w14_hvg_rank_combination", """
with s as (select 'S' || (l_orderkey % 25) as sample_id, 'G' || l_partkey as gene_id, round(stddev_samp(l_quantity), 9) as x
  from lineitem group by 1, 2 having count(*) > 1),
r as (select *, row_number() over (partition by sample_id order by x desc, gene_id) as rk from s),
t as (select gene_id, quantile_cont((rk - 1)::double, 0.5) filter (rk <= 40) as med, count(*) filter (rk <= 40) as nb from r group by 1),
b as (select gene_id from t where med is not null order by med, nb desc, gene_id limit 40)
select gene_id, round(med, 6) as highly_variable_rank, nb as highly_variable_nbatches,
  gene_id in (select gene_id from b) as highly_variable from t
""")
def _(spark, d):
    s = v.table(spark, d, "lineitem").groupBy(
        v.sample_of(F.col("l_orderkey")).alias("sample_id"),
        F.concat(F.lit("G"), F.col("l_partkey").cast("string")).alias("gene_id")).agg(
        F.stddev_samp("l_quantity").alias("x"), F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        "sample_id", "gene_id", "x")
    return rounded(pca.combine_ranks(s, 40, "x"), "highly_variable_rank")


@query("m02_scale_and_clip", """
with x as (select sample_id, barcode, gene_id, ln(1 + count * 10000.0::double / sum(count) over (partition by sample_id, barcode)) as x
  from v_counts),
n as (select count(*) as n from v_primary),
g as (select gene_id, sum(x) / n as m, sqrt((sum(x * x) - n * (sum(x) / n) * (sum(x) / n)) / (n - 1)) as sd from x, n group by gene_id, n)
select sample_id, barcode, gene_id, round(greatest(least((x - m) / sd, 10), -10), 5) as z,
  round(greatest(least(-m / sd, 10), -10), 6) as z0 from x join g using (gene_id)
""")
def _(spark, d):
    z, _ = pca.scale_values(cohort.normalise(v.counts(spark, d)), v.primary(spark, d))
    return rounded(rounded(z, "z", digits=5), "z0")


def cohort_pca(spark, d, n_top=100, n_comps=10):
    counts, spots = durable(v.counts(spark, d)), durable(v.primary(spark, d))
    hv = pca.highly_variable(counts, spots, n_top=n_top).filter("highly_variable")
    norm = cohort.normalise(counts, genes=durable(hv.select("gene_id")))
    return pca.principal_components(durable(norm), spots, n_comps)


@query("m03_principal_components")
def _(spark, d):
    scores, _, var = cohort_pca(spark, d)
    lead = scores.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_spots"), *[
        F.round(F.avg(F.element_at("pc", i).cast("double")), 4).alias(f"mean_pc{i}") for i in (1, 2)])
    return lead.withColumn("pc1_variance_ratio", F.lit(round(var.orderBy("pc_index").first()["variance_ratio"], 6)))


@query("m04_padded_loadings", """
select 'V' || vec_id as gene_id, i as pc_index, round(case when label < 5 then embedding[i]::double else 0 end, 6) as loading
from embeddings, range(1, 9) t(i)
""")
def _(spark, d):
    e = v.table(spark, d, "embeddings").withColumn("gene_id", F.concat(F.lit("V"), F.col("vec_id").cast("string")))
    have = e.filter("label < 5").select("gene_id", F.slice("embedding", 1, 8).alias("loadings"))
    return rounded(pca.padded_loadings(have, e, 8).withColumn("pc_index", F.col("pc_index").cast("long")), "loading")


def points(spark, d):
    return v.table(spark, d, "embeddings").select(
        F.col("vec_id").alias("id"), F.slice("embedding", 1, 30).alias("vector"), "label")


KNN_SQL = """
with p as (select vec_id as id, list_transform(embedding[1:30], lambda x: x::double) as v, label from embeddings),
pairs as (select a.id as src, b.id as dst, list_distance(a.v, b.v) as distance from p a join p b on a.id <> b.id),
knn as (select *, row_number() over (partition by src order by round(distance, 9), dst) as rank from pairs qualify rank <= 14)
"""


@query("m05_nearest_neighbors", KNN_SQL + "select src, dst, round(distance, 6) as distance, rank from knn")
def _(spark, d):
    return rounded(nb.nearest_neighbors(points(spark, d).select("id", "vector"), 14), "distance")


def expression_graph(spark, d):
    return durable(nb.fuzzy_connectivities(durable(nb.nearest_neighbors(points(spark, d), 14)), 15))


@query("m06_fuzzy_connectivities")
def _(spark, d):
    return rounded(expression_graph(spark, d), "weight")


GRID = [(r, s) for r in (0.4, 0.6, 0.8) for s in (0, 1, 2)]


def expression_communities(spark, d):
    return cm.communities(points(spark, d).select("id"), expression_graph(spark, d), GRID)


@query("m07_communities")
def _(spark, d):
    return expression_communities(spark, d).select("resolution", "seed", "id", "community")


def agreement_sql(by, a, b, source, minimum=1):
    """ARI and NMI per group from the contingency table."""
    return f"""
p as (select {by}, {a} as a, {b} as b, count(*)::double as c from {source} where {a} is not null and {b} is not null group by all),
ra as (select {by}, a, sum(c) as c from p group by all), rb as (select {by}, b, sum(c) as c from p group by all),
sa as (select {by}, sum(c) as n, count(*) as ka, sum(c * (c - 1) / 2) as s, sum(c * ln(c)) as e from ra group by {by}),
sb as (select {by}, count(*) as kb, sum(c * (c - 1) / 2) as s, sum(c * ln(c)) as e from rb group by {by}),
sp as (select {by}, sum(c * (c - 1) / 2) as s, sum(c * ln(c)) as e from p group by {by}),
agr as (select {by}, cast(n as bigint) as n_matched, ka as n_labels_a, kb as n_labels_b,
  round(case when n < 2 or (sp.s = sa.s and sp.s = sb.s) then 1.0 else (sp.s - sa.s * sb.s / (n * (n - 1) / 2)) /
    ((sa.s + sb.s) / 2 - sa.s * sb.s / (n * (n - 1) / 2)) end, 6) as adjusted_rand_index,
  round(case when ka = 1 and kb = 1 then 1.0 when ka = 1 or kb = 1 then 0.0 else
    greatest(((ln(n) - sa.e / n) + (ln(n) - sb.e / n) - (ln(n) - sp.e / n)) / (((ln(n) - sa.e / n) + (ln(n) - sb.e / n)) / 2), 0) end, 6)
    as normalized_mutual_information
  from sa join sb using ({by}) join sp using ({by}))"""


_SCOPED = "(select *, unnest([sample_id, '__all__']) as scope_id from v_clusters)"


def _scoped_agreement(spark, d, b):
    t = stats.agreement(la.scoped(v.clusters(spark, d)), ["scope_id"], "label_a", b)
    return rounded(t, "adjusted_rand_index", "normalized_mutual_information")


@query("m08_adjusted_rand_index",
       f"with {agreement_sql('scope_id', 'label_a', 'label_b', _SCOPED)} select scope_id, n_matched, n_labels_a, n_labels_b, "
       "adjusted_rand_index from agr")
def _(spark, d):
    return _scoped_agreement(spark, d, "label_b").drop("normalized_mutual_information")


@query("m09_normalized_mutual_information",
       f"with {agreement_sql('scope_id', 'label_a', 'label_c', _SCOPED)} select scope_id, n_matched, "
       "adjusted_rand_index, normalized_mutual_information from agr")
def _(spark, d):
    return _scoped_agreement(spark, d, "label_c").drop("n_labels_a", "n_labels_b")


@query("m10_same_sample_neighbours", KNN_SQL + """
, e as (select src, dst from knn union select dst, src from knn),
s as (select src, count(*) as graph_degree, avg((a.label = b.label)::int) as f from e join p a on e.src = a.id join p b
  on e.dst = b.id group by 1)
select 'L' || label as sample_id, count(*) as n_spots, round(avg(graph_degree), 6) as mean_graph_degree,
  round(avg(f), 6) as mean_same_sample_neighbour_fraction, round(quantile_cont(f, 0.5), 6) as
  median_same_sample_neighbour_fraction from s join p on s.src = p.id group by 1
""")
def _(spark, d):
    k = durable(nb.nearest_neighbors(points(spark, d), 14))
    e = k.select("src", "dst").union(k.select("dst", "src")).distinct()
    spots = points(spark, d).select("id", F.concat(F.lit("L"), F.col("label").cast("string")).alias("sample_id"))
    return rounded(la.neighbour_summary(la.neighbour_fraction(e, spots)), "mean_graph_degree",
                   "mean_same_sample_neighbour_fraction", "median_same_sample_neighbour_fraction")


# --- lattice ----------------------------------------------------------------

TISSUE_EDGES = ("te as materialized (" + HEX_SQL.format(t="(select * from v_positions where in_tissue = 1)") + ")")


def tissue_spots(spark, d):
    return v.positions(spark, d).filter("in_tissue = 1")


@query("m11_row_weights", f"with {TISSUE_EDGES} select src, dst, round(1.0 / count(*) over (partition by src), 6) as weight from te")
def _(spark, d):
    return rounded(la.row_weights(la.hex_edges(tissue_spots(spark, d)).select("src", "dst")), "weight")


@query("m12_joint_graph", f"""
with {TISSUE_EDGES}, q as (select observation_id, sample_id, array_row, array_col, total_counts from v_spot_qc where in_tissue = 1),
ex as (select a.observation_id as src, b.observation_id as dst, 1.0::double / (1 + abs(a.total_counts - b.total_counts)) as weight
  from q a join (select *, unnest([array_row - 2, array_row + 2]) as r2 from q) b
  on a.sample_id = b.sample_id and a.array_row = b.r2 and a.array_col = b.array_col),
u as (select src, dst, weight * 0.7 as w from ex union all
  select src, dst, 0.3 * 1.0::double / count(*) over (partition by src) from te),
s as (select src, dst, w from u union all select dst, src, w from u)
select src, dst, round(sum(w) * 0.5, 6) as weight from s where src <> dst group by 1, 2 having sum(w) <> 0
""")
def _(spark, d):
    from spotweave.plans.queries_aggs import spot_metrics
    q = spot_metrics(spark, d).filter("in_tissue = 1").select(
        "sample_id", "observation_id", "array_row", "array_col", "total_counts")
    far = q.withColumn("array_row", F.explode(F.array(F.col("array_row") - 2, F.col("array_row") + 2))).select(
        "sample_id", "array_row", "array_col", F.col("observation_id").alias("dst"), F.col("total_counts").alias("tb"))
    ex = q.join(far, ["sample_id", "array_row", "array_col"]).select(
        F.col("observation_id").alias("src"), "dst", (1.0 / (1 + F.abs(F.col("total_counts") - F.col("tb")))).alias("weight"))
    return rounded(la.joint_graph(ex, la.hex_edges(tissue_spots(spark, d)).select("src", "dst"), 0.3), "weight")


def components_sql(nodes, edges):
    return (f"cc(id, comp) using key (id) as (select id, id from {nodes} union select e.dst, min(c.comp) from cc c "
            f"join {edges} e on e.src = c.id join recurring.cc r on r.id = e.dst where c.comp < r.comp group by e.dst)")


REGION_CC = ("with recursive re as materialized (select * from v_region_edges), rn as materialized "
             "(select *, observation_id as id from v_region), " + components_sql("rn", "re"))
REGION_FULL = REGION_CC + """,
sized as materialized (select rn.*, comp, count(*) over (partition by comp) as csize from rn join cc using (id)),
kept as materialized (select * from sized where csize >= 20),
ke as materialized (select re.* from re where src in (select id from kept)),
fam as materialized (select k.sample_id, k.roi, f.gene_id, k.id, k.comp, f.count, ln(1 + f.count * 10000.0::double / k.total_counts) as x
  from v_family f join kept k on f.observation_id = k.id),
nroi as materialized (select sample_id, roi, count(*) as n from kept group by 1, 2),
gate as materialized (select sample_id, roi, gene_id, count(*) as det, cast(sum(count) as bigint) as tot from fam join nroi
  using (sample_id, roi) group by sample_id, roi, gene_id, n having count(*) >= greatest(15, ceil(n * 0.1)))
"""


def region_inputs(spark, d, minimum=20):
    edges, nodes, kept = ac.roi_graph(v.region_spots(spark, d), minimum)
    fam = durable(ac.retained_counts(v.family_counts(spark, d), nodes))
    gate = durable(ac.gene_gate(fam, nodes))
    return fam, edges, nodes, kept, gate


@query("m13_connected_components",
       REGION_CC + " select id, comp as component, count(*) over (partition by comp) as component_size, "
       "count(*) over (partition by comp) >= 20 as retained from cc")
def _(spark, d):
    s = durable(v.region_spots(spark, d))
    comp = connected_components(s.select(F.col("observation_id").alias("id")), la.hex_edges(s, ["sample_id", "roi"]))
    return component_sizes(comp, 20).select("id", "component", "component_size", "retained")


@query("m14_graph_qc", f"with recursive {TISSUE_EDGES}, tn as materialized (select *, observation_id as id from v_positions "
       "where in_tissue = 1), " + components_sql("tn", "te") + """,
t as (select tn.id, sample_id, comp, coalesce(deg, 0) as degree from tn join cc using (id) left join
  (select src as id, count(*) as deg from te group by 1) using (id)),
s as (select *, unnest([sample_id, '__all__']) as scope_id from t),
z as (select scope_id, comp, count(*) as size from s group by 1, 2)
select case when scope_id = '__all__' then 'cohort' else 'sample' end as scope, scope_id as sample_id, count(*) as n_spots,
  cast(sum(degree) / 2 as bigint) as n_undirected_edges, round(avg(degree), 6) as mean_degree,
  quantile_cont(degree::double, 0.5) as median_degree, min(degree) as min_degree, max(degree) as max_degree,
  (select count(*) from z where z.scope_id = s.scope_id) as n_components, count(*) filter (degree = 0) as n_isolated_spots,
  (select max(size) from z where z.scope_id = s.scope_id) as largest_component_spots,
  round((select max(size) from z where z.scope_id = s.scope_id) / count(*), 6) as largest_component_fraction,
  cast(0 as bigint) as cross_sample_undirected_edges from s group by scope_id
""")
def _(spark, d):
    t = tissue_spots(spark, d)
    e = durable(la.hex_edges(t).select("src", "dst"))
    spots = t.select(F.col("observation_id").alias("id"), "sample_id")
    return rounded(la.graph_qc(spots, e, connected_components(spots, e)), "mean_degree", "largest_component_fraction")


@query("m15_spatial_continuity", f"with recursive {TISSUE_EDGES}, tn as materialized (select *, observation_id as id from "
       "v_positions where in_tissue = 1), le as materialized (select te.*, a.roi_label as la, b.roi_label as lb, a.sample_id from te "
       "join tn a on te.src = a.id join tn b on te.dst = b.id), se as materialized (select * from le where la = lb), "
       + components_sql("tn", "se") + """,
t as (select tn.id, sample_id, roi_label as label, comp, coalesce(deg, 0) as degree from tn join cc using (id) left join
  (select src as id, count(*) as deg from se group by 1) using (id)),
s as (select *, unnest([sample_id, '__all__']) as scope_id from t),
z as (select scope_id, label, comp, count(*) as size from s group by 1, 2, 3),
e as (select *, unnest([sample_id, '__all__']) as scope_id from le),
top as (select scope_id, cast(count(*) / 2 as bigint) as n, cast(count(*) filter (la = lb) / 2 as bigint) as same from e group by 1),
n as (select scope_id, count(*) as spots from s group by 1)
select 'labeling_summary' as record_type, scope_id, '__all__' as label, spots as n_spots, n as n_spatial_edges,
  same as n_same_label_spatial_edges, round(same / n, 6) as same_label_spatial_edge_fraction, null::bigint as n_label_components,
  null::bigint as n_label_isolated_spots, null::bigint as largest_label_component_spots,
  null::double as largest_label_component_fraction from n join top using (scope_id)
union all
select 'label_component', scope_id, label, count(*), cast(sum(degree) / 2 as bigint), cast(sum(degree) / 2 as bigint),
  case when sum(degree) > 0 then 1.0::double end, (select count(*) from z where z.scope_id = s.scope_id and z.label = s.label),
  count(*) filter (degree = 0), (select max(size) from z where z.scope_id = s.scope_id and z.label = s.label),
  round((select max(size) from z where z.scope_id = s.scope_id and z.label = s.label) / count(*), 6) from s group by scope_id, label
""")
def _(spark, d):
    t = tissue_spots(spark, d)
    e = durable(la.hex_edges(t).select("src", "dst"))
    lab = t.select(F.col("observation_id").alias("id"), "sample_id", F.col("roi_label").alias("label"))
    return rounded(la.label_continuity(lab, e, lab), "same_label_spatial_edge_fraction", "largest_label_component_fraction")


@query("m16_region_graph_qc", REGION_FULL + """,
deg as (select src as id, count(*) as d from re group by 1),
c as (select sample_id, roi, count(distinct comp) as nc, count(distinct comp) filter (csize >= 20) as nr, max(csize) as mx from sized group by 1, 2),
b as (select sample_id, roi, count(*) as n, cast(sum(coalesce(d, 0)) / 2 as bigint) as e, count(*) filter (csize >= 20) as nk,
  cast(coalesce(sum(d) filter (csize >= 20), 0) / 2 as bigint) as ek, count(*) filter (csize >= 20 and d is null) as iso
  from sized left join deg using (id) group by 1, 2),
g as (select sample_id, roi, count(*) as ng from gate group by 1, 2)
select sample_id, roi, n as n_spots_eligibility_intersection, e as n_edges_before_component_filter, nk as n_spots_retained,
  ek as n_edges_retained, iso as n_isolated_retained, nc as n_components_before_filter, nr as n_components_retained,
  mx as largest_component_before_filter, coalesce(ng, 0) as n_genes_eligible, case when nk = 0 then 'no_component_meets_minimum'
  when coalesce(ng, 0) = 0 then 'no_gene_meets_detection_threshold' else 'analyzed' end as status,
  cast(greatest(15, ceil(nk * 0.1)) as bigint) as gene_min_detected_spots_effective, round(nk / n, 6) as retained_fraction
from b join c using (sample_id, roi) left join g using (sample_id, roi)
""")
def _(spark, d):
    _, edges, nodes, _, gate = region_inputs(spark, d)
    return rounded(ac.roi_graph_qc(nodes, edges, gate), "retained_fraction")


@query("m17_gene_gate", REGION_FULL + " select sample_id, roi, gene_id, det as n_detected_spots, tot as total_counts from gate")
def _(spark, d):
    return region_inputs(spark, d)[4].select("sample_id", "roi", "gene_id", "n_detected_spots", "total_counts")


MORAN_SQL = REGION_FULL + """,
dense as materialized (select k.sample_id, k.roi, g.gene_id, k.id, k.comp, coalesce(f.x, 0) as x from kept k join gate g
  using (sample_id, roi) left join fam f on f.id = k.id and f.gene_id = g.gene_id),
cen as materialized (select *, x - avg(x) over (partition by sample_id, roi, gene_id, comp) as y from dense),
w as materialized (select src, dst, 1.0::double / count(*) over (partition by src) as w from ke),
s0 as (select sample_id, roi, sum(w) as s0 from w join kept on w.src = kept.id group by 1, 2),
tot as (select sample_id, roi, gene_id, count(*) as n, sum(y * y) as d, avg(x) as mx, count(distinct comp) as nc from cen group by 1, 2, 3),
lag as (select a.sample_id, a.roi, a.gene_id, sum(w * a.y * b.y) as crs, sum(w * (a.y - b.y) * (a.y - b.y)) as sq
  from w join cen a on w.src = a.id join cen b on w.dst = b.id and b.gene_id = a.gene_id group by 1, 2, 3),
mg as materialized (select t.sample_id, t.roi, t.gene_id, n, nc, mx, n / s0 * crs / d as moran, (n - 1) / (2 * s0) * sq / d as geary, det, tot
  from tot t join lag using (sample_id, roi, gene_id) join s0 on s0.sample_id = t.sample_id and s0.roi = t.roi
  join gate on gate.sample_id = t.sample_id and gate.roi = t.roi and gate.gene_id = t.gene_id)
"""


def region_effects(spark, d):
    fam, _, nodes, kept, gate = region_inputs(spark, d)
    values = durable(ac.expression_values(fam, nodes, gate))
    return ac.moran_geary(values, nodes, kept, gate), values, nodes, kept


@query("m18_moran", MORAN_SQL + "select sample_id, roi, gene_id, n as n_spots, nc as n_components, det as n_detected_spots, "
       "round(mx, 6) as mean_log1p_cp10k, round(moran, 6) as moran_I, round(moran + 1 / (n - 1), 6) as moran_effect from mg")
def _(spark, d):
    t = region_effects(spark, d)[0]
    return rounded(t.select("sample_id", "roi", "gene_id", "n_spots", "n_components", "n_detected_spots",
                            "mean_log1p_cp10k", "moran_I", "moran_effect"), "mean_log1p_cp10k", "moran_I", "moran_effect")


@query("m19_geary", MORAN_SQL + "select sample_id, roi, gene_id, round(geary, 6) as geary_C, round(1 - geary, 6) as geary_effect, "
       "round(det / n, 6) as detection_rate from mg")
def _(spark, d):
    t = region_effects(spark, d)[0]
    return rounded(t.select("sample_id", "roi", "gene_id", "geary_C", "geary_effect", "detection_rate"), "geary_C",
                   "geary_effect", "detection_rate")


@query("w04_screen_candidates", MORAN_SQL + """,
r as (select *, row_number() over (partition by sample_id, roi order by round(moran, 9) desc, gene_id) as rm,
  row_number() over (partition by sample_id, roi order by round(geary, 9), gene_id) as rg from mg)
select sample_id, roi, gene_id, case when rm <= 50 then rm end as candidate_rank_moran, case when rg <= 50 then rg end as
  candidate_rank_geary, concat_ws(';', case when rm <= 50 then 'moran_top50' end, case when rg <= 50 then 'geary_top50' end) as
  selection_reasons from r where rm <= 50 or rg <= 50
""")
def _(spark, d):
    return ac.screen_candidates(region_effects(spark, d)[0])


@query("m20_permutation_pvalues", MORAN_SQL + """,
r as (select *, row_number() over (partition by sample_id, roi order by round(moran, 9) desc, gene_id) as rm,
  row_number() over (partition by sample_id, roi order by round(geary, 9), gene_id) as rg from mg),
cand as materialized (select sample_id, roi, gene_id from r where rm <= 50 or rg <= 50),
spot as materialized (select sample_id, roi, id, row_number() over (partition by sample_id, roi order by id) as place,
  coalesce((select sum(w) from w where src = id), 0) as r, coalesce((select sum(w) from w where dst = id), 0) as s from kept),
perm as materialized (select sample_id, roi, id, p, row_number() over (partition by sample_id, roi, p order by
  case when p > 0 then md5('1729:' || p || ':' || id) end, id) as place from spot, range(0, 200) t(p)),
val as materialized (select c.sample_id, c.roi, c.gene_id, s.place, c.y from cen c join cand using (sample_id, roi, gene_id)
  join spot s on s.id = c.id),
own as (select v.sample_id, v.roi, v.gene_id, perm.p, sum((s.r + s.s) * y * y) as yyrs from perm join spot s using (id)
  join val v on v.sample_id = perm.sample_id and v.roi = perm.roi and v.place = perm.place group by all),
step as materialized (select a.sample_id, a.roi, a.p, a.place as i, b.place as j, w from w join perm a on a.id = w.src
  join perm b on b.id = w.dst and b.p = a.p),
crs as (select x.sample_id, x.roi, x.gene_id, t.p, sum(w * x.y * z.y) as crs from step t
  join val x on x.sample_id = t.sample_id and x.roi = t.roi and x.place = t.i
  join val z on z.sample_id = x.sample_id and z.roi = x.roi and z.gene_id = x.gene_id and z.place = t.j group by all),
sc as (select sample_id, roi, sum(r) as sw from spot group by all),
st as materialized (select sample_id, roi, gene_id, p, round(n / sw * coalesce(crs, 0) / d, 9) as m,
  round((n - 1) / (2 * sw) * (yyrs - 2 * coalesce(crs, 0)) / d, 9) as g
  from own left join crs using (sample_id, roi, gene_id, p) join tot using (sample_id, roi, gene_id) join sc using (sample_id, roi))
select sample_id, roi, gene_id, o.m as observed_moran, o.g as observed_geary,
  (1 + count(*) filter (where st.m >= o.m)) / 200.0::double as moran_p_permutation_one_sided,
  (1 + count(*) filter (where st.g <= o.g)) / 200.0::double as geary_p_permutation_one_sided
from st join (select * from st where p = 0) o using (sample_id, roi, gene_id) where st.p > 0 group by sample_id, roi, gene_id, o.m, o.g
""")
def _(spark, d):
    eff, values, nodes, kept = region_effects(spark, d)
    cand = durable(ac.screen_candidates(eff))
    return ac.permutation_pvalues(cand, values, nodes, kept).select(
        "sample_id", "roi", "gene_id", "observed_moran", "observed_geary", "moran_p_permutation_one_sided", "geary_p_permutation_one_sided")


# --- associations -----------------------------------------------------------

def _long_scores(spark, d):
    """Scores against two covariates: the id and the score of the next component."""
    s = v.scores(spark, d)
    nxt = s.select("vec_id", (F.col("pc_index") - 1).alias("pc_index"), F.col("score").alias("nxt"))
    cov = F.explode(F.array(
        F.struct(F.lit("log1p_id").alias("covariate"), F.log1p(F.col("vec_id").cast("double")).alias("value")),
        F.struct(F.lit("next_component").alias("covariate"), F.col("nxt").alias("value")),
        F.struct(F.lit("constant").alias("covariate"), F.lit(1.0).alias("value")))).alias("c")
    return s.join(nxt, ["vec_id", "pc_index"], "left").select("vec_id", "pc_index", "score", cov).select(
        "vec_id", "pc_index", "score", "c.*")


@query("m21_numeric_associations", """
with l as (select s.vec_id, s.pc_index, s.score, c.name as covariate, c.v as value from (select a.*, b.score as nxt from v_scores a
    left join v_scores b on a.vec_id = b.vec_id and b.pc_index = a.pc_index + 1) s, unnest([{'name': 'log1p_id', 'v': ln(1 + s.vec_id)},
    {'name': 'next_component', 'v': s.nxt}, {'name': 'constant', 'v': 1.0::double}]) t(c)),
b as (select * from l where value is not null),
r as (select *, rank() over (partition by pc_index, covariate order by score) + (count(*) over (partition by pc_index, covariate, score) - 1) / 2 as rs,
  rank() over (partition by pc_index, covariate order by value) + (count(*) over (partition by pc_index, covariate, value) - 1) / 2 as rv from b),
k as (select pc_index, covariate, count(*) as nc, min(value) = max(value) as flat, corr(score, value) as p, corr(rs, rv) as s from r group by 1, 2)
select l.pc_index, l.covariate, count(*) as n_spots_total, any_value(nc) as n_spots_complete,
  round(any_value(case when not flat then p end), 6) as pearson_r, round(any_value(case when not flat then s end), 6) as spearman_rho,
  case when any_value(nc) is null then 'fewer_than_three_complete_spots' when any_value(flat) then 'constant_covariate' else '' end as reason,
  case when any_value(nc) is null or any_value(flat) then 'not_evaluable' else 'computed' end as status
from l left join k on l.pc_index = k.pc_index and l.covariate = k.covariate group by 1, 2
""")
def _(spark, d):
    return rounded(associations.numeric_associations(_long_scores(spark, d)).withColumn(
        "pc_index", F.col("pc_index").cast("long")), "pearson_r", "spearman_rho")


@query("m22_categorical_associations", """
with l as (select pc_index, score, x.n as variable, x.l as level from v_scores, unnest([{'n': 'label', 'l': label},
    {'n': 'parity', 'l': case when vec_id % 3 = 0 then null else vec_id % 2 end}, {'n': 'single', 'l': 1}]) t(x)),
k as (select * from l where level is not null),
g as (select pc_index, variable, level, count(*) as n, avg(score) as m from k group by 1, 2, 3),
t as (select pc_index, variable, count(*) as n, avg(score) as gm, var_pop(score) * count(*) as ss, count(distinct level) as c from k group by 1, 2)
select t.pc_index, t.variable, c as n_categories, t.n as n_spots_complete, round(case when c >= 2 then sum(g.n * (g.m - gm) * (g.m - gm)) / ss end, 6)
  as eta_squared, case when c >= 2 then 'computed' else 'not_evaluable' end as status,
  case when c >= 2 then '' else 'fewer_than_two_categories' end as reason
from t join g using (pc_index, variable) group by t.pc_index, t.variable, c, t.n, ss
""")
def _(spark, d):
    lev = F.explode(F.array(
        F.struct(F.lit("label").alias("variable"), F.col("label").cast("long").alias("level")),
        F.struct(F.lit("parity").alias("variable"), F.when(F.col("vec_id") % 3 != 0, F.col("vec_id") % 2).alias("level")),
        F.struct(F.lit("single").alias("variable"), F.lit(1).cast("long").alias("level")))).alias("c")
    long = v.scores(spark, d).select("pc_index", "score", lev).select("pc_index", "score", "c.*")
    return rounded(associations.categorical_associations(long).withColumn(
        "pc_index", F.col("pc_index").cast("long")), "eta_squared")


@query("m23_spearman_complexity", """
with r as (select sample_id, rank() over (partition by sample_id order by total_counts) + (count(*) over (partition by sample_id,
    total_counts) - 1) / 2 as a, rank() over (partition by sample_id order by n_genes_by_counts) + (count(*) over (partition by
    sample_id, n_genes_by_counts) - 1) / 2 as b from v_spot_qc)
select sample_id, round(corr(a, b), 6) as spearman from r group by 1
""")
def _(spark, d):
    from spotweave.plans.queries_aggs import spot_metrics
    return rounded(stats.spearman(spot_metrics(spark, d), ["sample_id"], "total_counts", "n_genes_by_counts", "spearman"),
                   "spearman")


# --- replicated design ------------------------------------------------------

def cells25(spark, d):
    return design.assign_design_cells(v.samples(spark, d), "G0", "G1", "T0", "T1")


@query("m24_design_matrix", """
select animal_id as biological_unit_id, sample_id, lower(genotype) || '_' || lower(treatment) as design_cell,
  technical_batch as model_batch, 1.0::double as Intercept, (genotype = 'G1')::int::double as genotype_alternative,
  (treatment = 'T1')::int::double as treatment_alternative, (genotype = 'G1' and treatment = 'T1')::int::double as genotype_by_treatment,
""" + ", ".join(f"(technical_batch = 'B{i}')::int::double as batch_level_{i}" for i in range(1, 5)) + " from v_samples")
def _(spark, d):
    return design.design_rows(design.check_biological_units(cells25(spark, d), batch="technical_batch"))


@query("m24_design_rank",
       "select count(*) as n_units, 3 + count(distinct technical_batch) as n_design_columns, 3 + count(distinct technical_batch) "
       "as design_rank, count(*) - 3 - count(distinct technical_batch) as residual_df from v_samples")
def _(spark, d):
    return design.design_rank(design.design_rows(design.check_biological_units(cells25(spark, d), batch="technical_batch")))


@query("m25_biological_units",
       "select sample_id, lower(genotype) || '_' || lower(treatment) as design_cell, animal_id as biological_unit_id, "
       "technical_batch as model_batch from v_samples")
def _(spark, d):
    return design.check_biological_units(cells25(spark, d), batch="technical_batch").select(
        "sample_id", "design_cell", "biological_unit_id", "model_batch")


def unit_pseudobulk(spark, d):
    return durable(fx.canonical_pseudobulk(
        roi.pseudobulk(v.counts(spark, d), v.roi_spots(spark, d), v.genes(spark, d), EXC), check=False))


def unit_counts(spark, d, min_spots=50):
    pb = unit_pseudobulk(spark, d)
    rows = durable(glm.roi_units(pb, design.check_biological_units(cells25(spark, d)), min_spots))
    ok = rows.filter("not low_spot")
    counts = pb.join(ok.select("sample_id", "roi_label_canonical", "biological_unit_id"), ["sample_id", "roi_label_canonical"]
                     ).select("roi_label_canonical", "biological_unit_id", "gene_id", F.col("sum_raw_counts").alias("count"))
    return counts, rows, ok, pb


def unit_sums(spark, d, min_spots=50):
    """Positive counts of the eligible units, and their rows: neither needs the region x gene grid."""
    use = durable(roi.analysis_spots(v.roi_spots(spark, d), EXC).select(*KEY, "roi_label_canonical", "total_counts"))
    have = use.groupBy("sample_id", "roi_label_canonical").agg(F.count(F.lit(1)).alias("n_spots"))
    ok = durable(glm.roi_units(have, design.check_biological_units(cells25(spark, d)), min_spots).filter("not low_spot"))
    sums = roi.roi_gene_sums(v.counts(spark, d), use).filter("sum_raw_counts > 0")
    # Sections times labels, as in the pseudobulk.
    counts = sums.join(F.broadcast(ok.select("sample_id", "roi_label_canonical", "biological_unit_id")), ["sample_id", "roi_label_canonical"])
    return durable(counts.select("roi_label_canonical", "biological_unit_id", "gene_id", F.col("sum_raw_counts").alias("count"))), ok


UNIT_SQL = """
with use as (select * from v_roi_spots where rec and mg and roi_label_canonical <> '4-NOT SPECIFIED'),
n as (select sample_id, roi_label_canonical, count(*) as n_spots from use group by 1, 2),
ok as (select * from n where n_spots >= 50),
c as (select sample_id, roi_label_canonical, gene_id, cast(sum(count) as bigint) as c from v_counts join use using (sample_id, barcode)
  join (select sample_id, roi_label_canonical from ok) using (sample_id, roi_label_canonical) group by 1, 2, 3)
"""


@query("m26_size_factors", UNIT_SQL + """
, k as (select roi_label_canonical, count(*) as n from ok group by 1),
g as (select roi_label_canonical, gene_id, sum(ln(c)) / n as g from c join k using (roi_label_canonical) group by 1, 2, n),
m as (select roi_label_canonical, sample_id, quantile_cont(ln(c) - g, 0.5) as m from c join g using (roi_label_canonical, gene_id) group by 1, 2)
select roi_label_canonical, 'A' || substr(sample_id, 2) as biological_unit_id,
  round(exp(m - avg(m) over (partition by roi_label_canonical)), 6) as size_factor from m
""")
def _(spark, d):
    counts, ok = unit_sums(spark, d)
    return rounded(glm.size_factors(counts, units=ok), "size_factor")


@query("m27_replicated_effects")
def _(spark, d):
    counts, ok = unit_sums(spark, d)
    out = glm.fit_replicated(counts, ok)
    return out.select("roi_label_canonical", "contrast_id", "gene_id", *[
        F.round(c, 4).alias(c) for c in ("log2_fold_change", "lfc_standard_error", "p_value", "fdr_bh")])


@query("m28_contrast_manifest", """
select x.id as contrast_id, x.f as contrast_formula, x.w as weight, count(s.sample_id) as n_samples from (select unnest([""" + ", ".join(
    "{'id': '%s', 'f': '%s', 'c': '%s', 'w': %s::double}" % (i, f, c, x)
    for i, f, w, _ in fx.CONTRASTS for c, x in zip(design.DESIGN_CELLS, w)) + """]) as x) left join v_samples s
on x.c = lower(genotype) || '_' || lower(treatment) group by x.id, x.f, x.w, x.c""")
def _(spark, d):
    m = fx.contrast_manifest(spark).select("contrast_id", "contrast_formula", F.posexplode("cell_weights").alias("p", "weight"))
    names = F.array(*[F.lit(c) for c in design.DESIGN_CELLS])
    m = m.withColumn("design_cell", F.get(names, F.col("p")))
    n = cells25(spark, d).groupBy("design_cell").agg(F.count(F.lit(1)).alias("n_samples"))
    return m.join(n, "design_cell", "left").select("contrast_id", "contrast_formula", "weight", "n_samples")


@query("m29_model_audit", UNIT_SQL + """
, u as (select n.*, lower(genotype) || '_' || lower(treatment) as cell, n_spots < 55 as low from n join v_samples using (sample_id)),
o as (select roi_label_canonical, count(*) filter (low) as nlow, count(*) filter (not low and cell = 'g0_t0') as a,
  count(*) filter (not low and cell = 'g0_t1') as b, count(*) filter (not low and cell = 'g1_t0') as c,
  count(*) filter (not low and cell = 'g1_t1') as d from u group by 1),
p as (select *, nullif(concat_ws(',', case when a < 3 then 'g0_t0=' || a end, case when b < 3 then 'g0_t1=' || b end, case when c < 3 then
  'g1_t0=' || c end, case when d < 3 then 'g1_t1=' || d end), '') as few from o)
select roi_label_canonical, few is null as model_eligible, case when few is null then 'eligible_fitted' else
  'excluded_insufficient_roi_replication' end as eligibility_status, coalesce(nullif(concat_ws(';', case when nlow > 0 then
  'low_spot_units:' || nlow end, 'insufficient_biological_units:' || few), ''), 'eligible') as reason_codes,
  a as n_units_g0_t0, b as n_units_g0_t1, c as n_units_g1_t0, d as n_units_g1_t1, a + b + c + d as n_units_total from p
""")
def _(spark, d):
    pb = unit_pseudobulk(spark, d)
    rows = durable(glm.roi_units(pb, design.check_biological_units(cells25(spark, d)), 55))
    return glm.model_audit(rows, pb, 3, 10).select(
        "roi_label_canonical", "model_eligible", "eligibility_status", "reason_codes", "n_units_g0_t0", "n_units_g0_t1",
        "n_units_g1_t0", "n_units_g1_t1", "n_units_total")


@query("m29_model_diagnostics", UNIT_SQL + """
, cells as (select n.roi_label_canonical, n.sample_id, lower(genotype) || '_' || lower(treatment) as cell from n join v_samples using (sample_id)
  where n_spots >= 50),
u as (select roi_label_canonical, count(*) as units, count(*) filter (cell = 'g0_t0') as a, count(*) filter (cell = 'g0_t1') as b,
  count(*) filter (cell = 'g1_t0') as c, count(*) filter (cell = 'g1_t1') as d from cells group by 1),
al as (select distinct roi_label_canonical from n),
gi as (select roi_label_canonical, gene_id, sum(c) as t from c group by 1, 2),
gt as (select roi_label_canonical, count(*) filter (t >= 10) as tested from gi group by 1),
k as (select roi_label_canonical, count(*) as n from ok group by 1),
g as (select roi_label_canonical, gene_id, sum(ln(c)) / n as g from c join k using (roi_label_canonical) group by 1, 2, n),
m as (select roi_label_canonical, sample_id, quantile_cont(ln(c) - g, 0.5) as m from c join g using (roi_label_canonical, gene_id) group by 1, 2),
sf as (select roi_label_canonical, exp(m - avg(m) over (partition by roi_label_canonical)) as f from m),
ss as (select roi_label_canonical, min(f) as lo, quantile_cont(f, 0.5) as mid, max(f) as hi from sf group by 1)
select roi_label_canonical, case when least(a, b, c, d) >= 3 then 'fitted' else 'not_fitted_insufficient_roi_replication' end as fit_status,
  case when units is null then 0 else (select count(distinct 'G' || l_partkey) from lineitem) end as n_genes_input, coalesce(tested, 0) as n_genes_tested,
  coalesce(units - (a > 0)::int - (b > 0)::int - (c > 0)::int - (d > 0)::int, 0) as residual_df, round(lo, 6) as size_factor_min,
  round(mid, 6) as size_factor_median, round(hi, 6) as size_factor_max
from al left join u using (roi_label_canonical) left join gt using (roi_label_canonical) left join ss using (roi_label_canonical)
""")
def _(spark, d):
    counts, rows, _, pb = unit_counts(spark, d)
    return rounded(glm.model_diagnostics(glm.model_audit(rows, pb), glm.size_factors(counts)), "size_factor_min",
                   "size_factor_median", "size_factor_max")


# --- enrichment -------------------------------------------------------------

@query("m30_prepare_ranking",
       "select r.roi_label_canonical, r.contrast_id, r.gene_symbol, rank, combined_raw_counts_four_sections, n_nonzero_design_cells "
       "from v_rank4 r join v_eff4 e on e.roi_label_canonical = r.roi_label_canonical and e.contrast_id = r.contrast_id and "
       "e.gene_id = r.gene_symbol")
def _(spark, d):
    return en.prepare_ranking(id_effects(spark, d)).select(
        "roi_label_canonical", "contrast_id", "gene_symbol", "rank", "combined_raw_counts_four_sections", "n_nonzero_design_cells")


ES_SQL = """
with n as (select roi_label_canonical, contrast_id, count(*) as n from v_rank4 group by 1, 2),
h as (select r.*, term, count(*) over (partition by r.roi_label_canonical, r.contrast_id, term) as m, abs(original_effect) as w
  from v_rank4 r join v_gene_sets g on r.gene_symbol = g.gene qualify m between 5 and 500),
s as (select r.roi_label_canonical, r.contrast_id, t.term, r.rank, t.m, n.n, t.tot, h.w from v_rank4 r join
  (select roi_label_canonical, contrast_id, term, any_value(m) as m, sum(w) as tot from h group by 1, 2, 3) t using (roi_label_canonical, contrast_id)
  join n using (roi_label_canonical, contrast_id) left join h on h.roi_label_canonical = r.roi_label_canonical and
  h.contrast_id = r.contrast_id and h.term = t.term and h.rank = r.rank),
run as (select *, sum(case when w is not null then w / tot else -1.0::double / (n - m) end) over (partition by roi_label_canonical, contrast_id, term
  order by rank) as es from s),
e as (select roi_label_canonical, contrast_id, term, any_value(m) as set_size, any_value(n) as n_ranked, round(max(es), 12) as hi,
  round(min(es), 12) as lo from run group by 1, 2, 3)
"""


@query("m31_enrichment_score", ES_SQL + "select roi_label_canonical, contrast_id, term, set_size, n_ranked, "
       "round(case when hi >= -lo then hi else lo end, 6) as es from e")
def _(spark, d):
    ranking = durable(en.prepare_ranking(id_effects(spark, d)))
    by = ["roi_label_canonical", "contrast_id", "library_id", "term"]
    t = en.enrichment_score(en.hits_of(ranking, v.gene_sets(spark, d)), by)
    return rounded(t.select("roi_label_canonical", "contrast_id", "term", "set_size", "n_ranked", "es"), "es")


def _score_sql(source: str, by: str) -> str:
    """Score and edge of sets of hits ``source`` (``by``, rank, m, n, w): extremes lie at or just before a hit."""
    return f"""(select {by}, any_value(m) as m, any_value(n) as n, max(hi) as mx, min(lo) as mn,
  min(rank) filter (hi = top) as peak, max(rank) filter (lo = low) as dip from (select *, max(hi) over (partition by {by}) as top,
  min(lo) over (partition by {by}) as low from (select *, round(case when tot > 0 then cum / tot else i::double / m end - miss, 12) as hi,
  round(case when tot > 0 then (cum - w) / tot else (i - 1)::double / m end - miss, 12) as lo from (select *,
  coalesce((rank - i) / nullif(n - m, 0)::double, 0) as miss from (select *, sum(w) over (partition by {by} order by rank) as cum,
  sum(w) over (partition by {by}) as tot, row_number() over (partition by {by} order by rank) as i from {source})))) group by {by})"""


RC = "roi_label_canonical, contrast_id"


NULL_SQL = f"""
with n as (select {RC}, count(*) as n from v_rank4 group by all),
h as (select r.*, library_id, term, n.n, count(*) over (partition by {RC}, library_id, term) as m, abs(original_effect) as w
  from v_rank4 r join v_gene_sets g on r.gene_symbol = g.gene join n using ({RC}) qualify m between 5 and 500),
o as (select *, case when mx >= -mn then mx else mn end as es, case when mx >= -mn then peak else dip end as edge from
  {_score_sql("h", f"{RC}, library_id, term")}),
led as (select {RC}, library_id, term, count(*) as n_led, string_agg(gene_symbol, ';' order by rank) as genes from h join o
  using ({RC}, library_id, term) where case when es >= 0 then rank <= edge else rank >= edge end group by all),
pick as (select {RC}, p, rank, abs(original_effect) as w, row_number() over (partition by {RC}, p order by md5('0:' || roi_label_canonical
  || ':' || contrast_id || ':' || p || ':' || rank), rank) as k from v_rank4, range(1, 101) t(p) qualify k <= 500),
draw as (select {RC}, p, rank, w, m, n from pick join (select distinct {RC}, m, n from o) using ({RC}) where k <= m),
nul as (select {RC}, m, p, case when mx >= -mn then mx else mn end as null_es from {_score_sql("draw", f"{RC}, m, p").replace("any_value(m) as m, ", "")}),
j as (select o.*, p, null_es from o join nul using ({RC}, m)),
per as (select {RC}, library_id, term, avg(null_es) filter (null_es >= 0) as pos, avg(-null_es) filter (null_es < 0) as neg,
  count(*) filter ((null_es >= 0) = (es >= 0)) as same, count(*) filter ((null_es >= 0) = (es >= 0) and abs(null_es) >= abs(es)) as ge from j group by all),
t as (select o.*, es >= 0 as up, es / nullif(case when es >= 0 then pos else neg end, 0) as nes, ge / nullif(same, 0)::double as pv
  from o join per using ({RC}, library_id, term)),
x as (select * from (select {RC}, library_id, p, null_es >= 0 as up, abs(null_es / nullif(case when null_es >= 0 then pos else neg end, 0)) as v
  from j join per using ({RC}, library_id, term)) where v is not null),
nn as (select {RC}, library_id, up, count(*) as n_null from x group by all),
no as (select {RC}, library_id, up, count(*) as n_obs from t where nes is not null group by all),
ge as (select t.roi_label_canonical, t.contrast_id, t.library_id, t.term, count(x.v) as null_ge from t left join x on
  (t.roi_label_canonical, t.contrast_id, t.library_id, t.up) = (x.roi_label_canonical, x.contrast_id, x.library_id, x.up) and x.v >= abs(t.nes) group by all),
og as (select t.roi_label_canonical, t.contrast_id, t.library_id, t.term, count(y.term) as obs_ge from t left join t y on
  (t.roi_label_canonical, t.contrast_id, t.library_id, t.up) = (y.roi_label_canonical, y.contrast_id, y.library_id, y.up) and abs(y.nes) >= abs(t.nes) group by all),
mxx as (select {RC}, library_id, up, p, max(v) as v from x group by all),
fw as (select t.roi_label_canonical, t.contrast_id, t.library_id, t.term, count(mxx.v) as max_ge from t left join mxx on
  (t.roi_label_canonical, t.contrast_id, t.library_id, t.up) = (mxx.roi_label_canonical, mxx.contrast_id, mxx.library_id, mxx.up) and mxx.v >= abs(t.nes) group by all)
select {RC}, library_id, term, round(es, 6) as es, round(nes, 6) as nes, round(pv, 6) as nominal_permutation_p_value,
  round(least(null_ge / n_null::double / (obs_ge / n_obs::double), 1.0::double), 6) as fdr_q_value, max_ge / 100.0::double as fwer_p_value,
  m as set_size, n as n_ranked, round(n_led / m::double, 6) as tag_fraction,
  round(case when es >= 0 then edge else n - edge + 1 end / n::double, 6) as gene_fraction, genes as leading_edge_genes
from t join ge using ({RC}, library_id, term) join og using ({RC}, library_id, term) join fw using ({RC}, library_id, term)
  join led using ({RC}, library_id, term) join no using ({RC}, library_id, up) left join nn using ({RC}, library_id, up) where nes is not null
"""


@query("m31_enrichment_null", NULL_SQL)
def _(spark, d):
    ranking = durable(en.prepare_ranking(id_effects(spark, d)))
    t = en.enrichment(ranking, v.gene_sets(spark, d)).drop("n_permutations", "seed", "inference_status")
    return rounded(t, "es", "nes", "nominal_permutation_p_value", "fdr_q_value", "tag_fraction", "gene_fraction")


@query("m32_task_grid",
       "select distinct roi_label_canonical, contrast_id, 'blocks' as library_id, case when contrast_id like '%main%' then "
       "'completed_reused_checkpoint' else 'pending' end as execution_status from v_rank4")
def _(spark, d):
    ranking = durable(en.prepare_ranking(id_effects(spark, d)))
    prints = en.ranking_fingerprints(ranking)
    sets = v.gene_sets(spark, d)
    libs = sets.groupBy("library_id").agg(F.sha2(F.sum(F.crc32(F.concat_ws("|", "term", "gene"))).cast("string"), 256).alias(
        "observed_sha256"))
    first = durable(en.task_grid(prints, libs, spark.createDataFrame([], "run_fingerprint string")))
    done = first.filter("contrast_id like '%main%'").select("run_fingerprint")
    return en.task_grid(prints, libs, done).select("roi_label_canonical", "contrast_id", "library_id", "execution_status")


@query("m32_resumed_results", NULL_SQL)
def _(spark, d):
    """Two runs over one folder: the second computes only what the first left, and all results are those of one run."""
    ranking = durable(en.prepare_ranking(id_effects(spark, d)))
    prints, sets, folder = en.ranking_fingerprints(ranking), v.gene_sets(spark, d), scratch_path(spark, "tasks")
    libs = sets.groupBy("library_id").agg(F.sha2(F.sum(F.crc32(F.concat_ws("|", "term", "gene"))).cast("string"), 256).alias(
        "observed_sha256"))
    for part in (prints.filter("contrast_id like '%main%'"), prints):
        en.run_tasks(ranking, sets, durable(en.task_grid(part, libs, en.finished_tasks(spark, folder))), folder)
    t = en.task_results(spark, folder).drop("n_permutations", "seed", "inference_status", "run_fingerprint")
    return rounded(t, "es", "nes", "nominal_permutation_p_value", "fdr_q_value", "tag_fraction", "gene_fraction")


# --- cluster runs, layout, integration --------------------------------------

def _label_runs(spark, d):
    c = v.clusters(spark, d)
    item = F.explode(F.array(*[F.struct(F.lit(i).alias("seed"), F.col(x).alias("community"))
                               for i, x in enumerate(("label_a", "label_b", "label_c"))])).alias("x")
    return c.select(F.concat_ws("::", *KEY).alias("id"), F.lit(0.6).alias("resolution"), item).select(
        "id", "resolution", "x.*")


@query("m33_cluster_runs",
       "select 0.6::double as resolution, cast(s as integer) as seed, count(distinct l) as n_clusters, count(*) as n_spots from "
       "(select unnest([0, 1, 2]) as s, unnest([label_a, label_b, label_c]) as l from v_clusters) group by 2")
def _(spark, d):
    return cm.cluster_runs(_label_runs(spark, d))


_PAIRS = ("(select 'ab' as pair, label_a as x, label_b as y from v_clusters union all select 'ac', label_a, label_c from v_clusters "
          "union all select 'bc', label_b, label_c from v_clusters)")


@query("m33_mean_seed_agreement", f"with {agreement_sql('pair', 'x', 'y', _PAIRS)} select 0.6::double as resolution, "
       "round(avg(adjusted_rand_index), 5) as mean_adjusted_rand_index from agr")
def _(spark, d):
    pairs = rounded(cm.seed_agreement(_label_runs(spark, d)), "adjusted_rand_index")
    return rounded(cm.mean_agreement(pairs), "mean_adjusted_rand_index", digits=5)


@query("m34_layout")
def _(spark, d):
    return rounded(nb.spectral_layout(expression_graph(spark, d)), "x", "y", digits=4)


@query("m35_integration_eligibility",
       "select case when count(technical_batch) < count(*) or count(*) = 0 then 'not_eligible' "
       "else 'not_requested' end as integration_status, count(*) as n_samples from v_samples")
def _(spark, d):
    s = v.samples(spark, d)
    return s.agg(F.lit(design.integration_eligibility(s)).alias("integration_status"), F.count(F.lit(1)).alias("n_samples"))


@query("t01_resource_monitor", """
with t as (select step, time_bucket(interval '1 minute', ts) as w, count(*) as n_samples, max(cpu_percent) as peak_cpu_percent,
  max(rss_gib) as peak_rss_gib, max(vms_gib) as peak_vms_gib, max(project_gib) as peak_project_gib, min(free_gib) as lo
  from v_resource group by 1, 2)
select step, cast(epoch(w) as bigint) as window_start, n_samples, peak_cpu_percent, peak_rss_gib, peak_vms_gib, peak_project_gib,
  concat_ws(';', case when peak_cpu_percent > 80 then 'CPU_CAPACITY_ABOVE_WARNING' end, case when peak_project_gib > 100 then
  'PROJECT_SIZE_ABOVE_WARNING' end, case when peak_project_gib > 200 then 'PROJECT_SIZE_ABOVE_CRITICAL' end, case when lo < 20 then
  'FILESYSTEM_FREE_BELOW_WARNING' end) as warning_codes
from t where w + interval '1 minute' <= (select max(ts) from events) - interval '10 minutes'
""")
def _(spark, d):
    """The whole event table as a file stream; closed windows land in a parquet table."""
    from spotweave.streaming import monitor
    src, out, ck = (scratch_path(spark, x) for x in ("samples", "peaks", "monitor"))
    s = v.resource(spark, d).withColumn("ts", F.timestamp_micros(v.epoch_us("ts")))
    s.write.parquet(src)
    peaks = monitor.windowed_peaks(monitor.read_samples(spark, src, s.schema))
    monitor.write_peaks(peaks, out, ck).awaitTermination()
    schema = peaks.schema
    return spark.read.schema(schema).parquet(out).withColumn("window_start", F.unix_seconds("window_start"))


_PEAKS_SQL = """
with t as (select step, time_bucket(interval '1 minute', ts) as w, count(*) as n_samples, max(cpu_percent) as peak_cpu_percent,
  max(rss_gib) as peak_rss_gib, max(vms_gib) as peak_vms_gib, max(project_gib) as peak_project_gib, min(free_gib) as lo
  from v_resource group by 1, 2)
select step, cast(epoch(w) as bigint) as window_start, n_samples, peak_cpu_percent, peak_rss_gib, peak_vms_gib, peak_project_gib,
  concat_ws(';', case when peak_cpu_percent > 80 then 'CPU_CAPACITY_ABOVE_WARNING' end, case when peak_project_gib > 100 then
  'PROJECT_SIZE_ABOVE_WARNING' end, case when peak_project_gib > 200 then 'PROJECT_SIZE_ABOVE_CRITICAL' end, case when lo < 20 then
  'FILESYSTEM_FREE_BELOW_WARNING' end) as warning_codes from t
"""


@query("t01_closed_windows", _PEAKS_SQL)
def _(spark, d):
    """The stream in two runs of one checkpoint; the closing event between them ends the last windows."""
    from spotweave.streaming import monitor
    src, out, ck = (scratch_path(spark, x) for x in ("samples", "peaks", "monitor"))
    s = v.resource(spark, d).withColumn("ts", F.timestamp_micros(v.epoch_us("ts")))
    s.write.parquet(src)
    peaks = monitor.windowed_peaks(monitor.read_samples(spark, src, s.schema))
    monitor.write_peaks(peaks, out, ck).awaitTermination()
    monitor.close_samples(spark, src, s.schema)
    monitor.write_peaks(peaks, out, ck).awaitTermination()
    return spark.read.schema(peaks.schema).parquet(out).withColumn("window_start", F.unix_seconds("window_start"))


@query("t01_first_crossings", f"select step, code, threshold, epoch_us(first_ts) as first_us, peak_observed from ({WARN_SQL})")
def _(spark, d):
    """First crossings as a stream over several triggers: the same as W12 over the whole table."""
    from spotweave.streaming import monitor
    src, out, ck = (scratch_path(spark, x) for x in ("samples", "crossings", "monitor"))
    s = v.resource(spark, d).withColumn("ts", F.timestamp_micros(v.epoch_us("ts")))
    s.repartition(3, "event_id").write.parquet(src)
    monitor.write_crossings(monitor.read_samples(spark, src, s.schema, max_files=1), out, ck).awaitTermination()
    return monitor.crossings(spark, out).select("step", "code", "threshold", v.epoch_us("first_ts").alias("first_us"), "peak_observed")
