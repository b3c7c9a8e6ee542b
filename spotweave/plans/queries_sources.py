"""S: scans and sinks over files that Spark first writes from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spotweave.functions.runtime import scratch_path
from spotweave.plans import standin as v
from spotweave.plans.registry import query
from spotweave.sources import readers as r, sinks


def _tsv(df, name, sep="\t"):
    path = scratch_path(df.sparkSession, name)
    df.write.csv(path, sep=sep, header=True, emptyValue="", nullValue="")
    return path


@query("s01_sample_sheet", "select * from v_samples")
def _(spark, d):
    return r.read_sample_sheet(spark, _tsv(v.samples(spark, d), "samples"))


def mtx_inputs(spark, d):
    root = scratch_path(spark, "mtx")
    genes = v.genes(spark, d).withColumn(
        "feature_type", F.when(F.col("feature_type") == "PROMO", "Antibody Capture")
        .otherwise("Gene Expression"))
    sinks.write_mtx(v.counts(spark, d), genes, root)
    return root


@query("s02_mtx_counts",
       "select c.*, gene_symbol from v_counts c join v_genes using (gene_id) where feature_type <> 'PROMO'")
def _(spark, d):
    root = mtx_inputs(spark, d)
    return r.read_10x_count_matrix(spark, f"{root}/matrix", f"{root}/features", f"{root}/barcodes")


@query("s03_mtx_dimensions",
       "select sample_id, (select count(*) from v_genes) as n_features, "
       "count(distinct barcode) as n_barcodes, count(*) as nnz from v_counts group by 1")
def _(spark, d):
    return r.mtx_dimensions(spark, mtx_inputs(spark, d) + "/matrix")


@query("s04_positions",
       "select sample_id, barcode, in_tissue, array_row, array_col, pxl_row as pxl_row_in_fullres, "
       "pxl_col as pxl_col_in_fullres from v_positions")
def _(spark, d):
    root = scratch_path(spark, "positions")
    p = v.positions(spark, d).select("sample_id", F.col("pxl_col").alias("pxl_col_in_fullres"), "barcode", "in_tissue",
                                     "array_row", "array_col", F.col("pxl_row").alias("pxl_row_in_fullres"))
    p.write.partitionBy("sample_id").csv(root, header=True, nullValue="")
    return r.read_positions(spark, root)


@query("s05_inspect_positions",
       "select sample_id, count(*) as row_count, count(*) filter (in_tissue = 1) as n_in_tissue, "
       "count(*) filter (in_tissue = 0) as n_off_tissue, "
       "count(*) filter (in_tissue is null) as missing_in_tissue, "
       "count(*) filter (array_row is null) as missing_array_row, "
       "count(*) filter (array_col is null) as missing_array_col, "
       "count(*) filter (pxl_row is null) as missing_pxl_row, "
       "count(*) filter (pxl_col is null) as missing_pxl_col, "
       "count(*) - count(distinct barcode) as n_duplicate_barcodes from v_positions group by 1")
def _(spark, d):
    return r.inspect_positions(v.positions(spark, d))


@query("s06_feature_summary",
       "select feature_type, count(*) as n_features from v_genes group by 1")
def _(spark, d):
    return r.feature_summary(v.genes(spark, d))


@query("s07_mitochondrial_features",
       "select count(*) filter (upper(gene_symbol) like 'RED %') as n_mitochondrial from v_genes")
def _(spark, d):
    return r.mitochondrial_feature_count(v.genes(spark, d), v.MITO_PREFIXES)


CAPABILITY_SQL = """
with e as (
  select sample_id, count(*) as n_positions, count(*) filter (in_tissue is null) as missing_in_tissue,
    count(*) filter (array_row is null or array_col is null) as missing_array,
    count(*) filter (pxl_row is null or pxl_col is null) as missing_pixel,
    count(*) filter (in_tissue = 1) % 2 = 0 as registered_image,
    count(*) filter (roi_label = '5-LOW') % 2 = 0 as metrics_summary,
    count(*) filter (roi_label = '2-HIGH') % 2 = 0 as molecule_info,
    count(*) filter (roi_label = '1-URGENT') as n_images, 0 as n_read_files
  from v_positions group by 1),
m as (select count(*) filter (upper(gene_symbol) like 'RED %') > 0 as mito from v_genes),
c as (select sample_id, count(*) as n from v_counts group by 1),
f as (select e.*, coalesce(c.n, 0) > 0 as counts, mito, registered_image and missing_pixel = 0 as hist
      from e left join c using (sample_id) cross join m)
select sample_id, x.kind as kind, x.name as name,
  case when x.ok then 'available' when x.part then 'partial' else 'not_available' end as status
from (select sample_id, unnest([
  {'kind': 'capability', 'name': 'raw_counts_matrix', 'ok': counts, 'part': false},
  {'kind': 'capability', 'name': 'filtered_counts_matrix', 'ok': counts, 'part': false},
  {'kind': 'capability', 'name': 'array_coordinates', 'ok': missing_array = 0, 'part': false},
  {'kind': 'capability', 'name': 'pixel_coordinates', 'ok': missing_pixel = 0, 'part': false},
  {'kind': 'capability', 'name': 'in_tissue_labels', 'ok': missing_in_tissue = 0, 'part': false},
  {'kind': 'capability', 'name': 'histology_image', 'ok': n_images > 0, 'part': false},
  {'kind': 'capability', 'name': 'registered_histology', 'ok': hist, 'part': false},
  {'kind': 'capability', 'name': 'upstream_metrics', 'ok': metrics_summary, 'part': false},
  {'kind': 'capability', 'name': 'molecule_level_data', 'ok': molecule_info, 'part': false},
  {'kind': 'capability', 'name': 'mitochondrial_features', 'ok': mito, 'part': false},
  {'kind': 'capability', 'name': 'raw_reads', 'ok': n_read_files > 0, 'part': false},
  {'kind': 'qc_metric', 'name': 'in_tissue', 'ok': missing_in_tissue = 0, 'part': false},
  {'kind': 'qc_metric', 'name': 'total_counts', 'ok': counts, 'part': false},
  {'kind': 'qc_metric', 'name': 'detected_genes', 'ok': counts, 'part': false},
  {'kind': 'qc_metric', 'name': 'mitochondrial_fraction', 'ok': counts and mito, 'part': false},
  {'kind': 'qc_metric', 'name': 'image_alignment', 'ok': hist, 'part': false},
  {'kind': 'qc_metric', 'name': 'spatial_artifacts', 'ok': counts and missing_array = 0 and hist,
   'part': counts and missing_array = 0}]) as x from f)
"""


def capability_evidence(spark, d):
    p = v.positions(spark, d)

    def missing(a, b):
        return F.count_if(F.col(a).isNull() | F.col(b).isNull())

    e = p.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n_positions"), missing("in_tissue", "in_tissue").alias("missing_in_tissue"),
        missing("array_row", "array_col").alias("missing_array"),
        missing("pxl_row", "pxl_col").alias("missing_pixel"),
        (F.count_if(F.col("in_tissue") == 1) % 2 == 0).alias("registered_image"),
        (F.count_if(F.col("roi_label") == "5-LOW") % 2 == 0).alias("metrics_summary"),
        (F.count_if(F.col("roi_label") == "2-HIGH") % 2 == 0).alias("molecule_info"),
        F.count_if(F.col("roi_label") == "1-URGENT").alias("n_images"),
        F.lit(0).alias("n_read_files"), F.lit(True).alias("scalefactors_valid"))
    c = v.counts(spark, d).groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_filtered_counts"))
    mito = r.mitochondrial_feature_count(v.genes(spark, d), v.MITO_PREFIXES).first()[0]
    e = e.join(c, "sample_id", "left").fillna({"n_filtered_counts": 0}).withColumn(
        "n_raw_counts", F.col("n_filtered_counts")).withColumn("n_mitochondrial", F.lit(mito))
    return e


@query("s08_capabilities", CAPABILITY_SQL)
def _(spark, d):
    return r.capabilities(capability_evidence(spark, d))


_GROUNDS_SQL = ", ".join(f"('{k}', '{n}', '{text}', '{','.join(sources)}')" for (k, n), (text, sources) in r.CAPABILITY_GROUNDS.items())


@query("s08_capability_reasons", f"""
with s as ({CAPABILITY_SQL}), g(kind, name, grounds, sources) as (values {_GROUNDS_SQL}),
e as (select sample_id, unnest(case when count(*) filter (roi_label = '1-URGENT') > 0
    then [{{'k': 'positions', 'p': 'b/' || sample_id || '.csv'}}, {{'k': 'images', 'p': 'a/' || sample_id || '.png'}}, {{'k': 'images', 'p': 'b/' || sample_id || '.csv'}}]
    else [{{'k': 'positions', 'p': 'b/' || sample_id || '.csv'}}] end) as e from v_positions group by sample_id),
p as (select g.kind, g.name, sample_id, string_agg(distinct e.p, ';' order by e.p) as evidence
    from g join e on list_contains(string_split(sources, ','), e.k) group by all)
select s.sample_id, s.kind, s.name, s.status,
  case when s.kind = 'capability' then null when s.name = 'image_alignment' then 'visual_review' when s.name = 'spatial_artifacts' then 'hybrid'
    else 'automatic' end as mode,
  case s.status when 'available' then 'present: ' || grounds when 'partial' then 'present: count matrix, array coordinates; absent: registered image'
    else 'absent or incomplete: ' || grounds end as reason, coalesce(evidence, '') as evidence
from s join g using (kind, name) left join p using (kind, name, sample_id)
""")
def _(spark, d):
    places = F.array(F.concat(F.lit("b/"), "sample_id", F.lit(".csv")))
    # The images list names the positions file too: a path stands once in an entry's evidence.
    images = F.concat(F.array(F.concat(F.lit("a/"), "sample_id", F.lit(".png"))), places)
    e = capability_evidence(spark, d).withColumn("paths", F.create_map(
        F.lit("positions"), places, F.lit("images"), F.when(F.col("n_images") > 0, images).otherwise(F.array().cast("array<string>"))))
    return r.explained_capabilities(e)


@query("s09_roi_csv",
       "select sample_id || '::' || roi_barcode as roi_barcode, roi_label from v_roi")
def _(spark, d):
    roi = v.roi_table(spark, d).select(
        F.concat(F.lit(" "), F.concat_ws("::", "sample_id", "roi_barcode")).alias("Barcode"),
        F.concat("roi_label", F.lit(" ")).alias("Region"))
    return r.read_roi(spark, _tsv(roi, "roi", ","))


def region_aliases(spark, d):
    """Brand aliases: several brands share the first canonical label of their part type."""
    return v.table(spark, d, "part").groupBy(F.col("p_brand").alias("source_label")).agg(
        F.min("p_type").alias("canonical_label"),
        F.when(F.count(F.lit(1)) % 2 == 0, "requires review").otherwise("").alias("status"),
        F.lit("n").alias("notes"))


_ALIAS_SQL = ("select p_brand as source_label, min(p_type) as canonical_label, "
              "case when count(*) % 2 = 0 then 'requires review' else 'unspecified' end as status, "
              "'n' as notes from part group by 1")


@query("s10_alias_scan", _ALIAS_SQL)
def _(spark, d):
    return r.read_aliases(spark, _tsv(region_aliases(spark, d), "alias"))


@query("s11_alias_audit",
       f"select status, count(*) as n_labels, status like '%review%' as review_required "
       f"from ({_ALIAS_SQL}) group by 1")
def _(spark, d):
    return r.alias_audit(r.read_aliases(spark, _tsv(region_aliases(spark, d), "alias")))


@query("s11_review_rows", f"select * from ({_ALIAS_SQL}) where status like '%review%'")
def _(spark, d):
    return r.review_required(r.read_aliases(spark, _tsv(region_aliases(spark, d), "alias")))


def gmt_folder(spark, d):
    """One GMT line per term; gene order is by id, with one repeat that must be dropped."""
    genes = F.array_sort(F.collect_set("gene"))
    lines = v.gene_sets(spark, d).groupBy("term").agg(genes.alias("g")).select(
        F.concat_ws("\t", "term", F.lit("block of parts"), F.array_join("g", "\t"), F.col("g")[0]))
    path = scratch_path(spark, "gmt")
    lines.write.text(path)
    return path


@query("s12_gmt_scan",
       "select library_id, term, 'block of parts' as description, count(*) as n_genes, "
       "string_agg(gene, ',' order by gene) as genes from v_gene_sets group by 1, 2")
def _(spark, d):
    sets = r.read_gmt(spark, gmt_folder(spark, d), "blocks")
    return sets.withColumn("n_genes", F.size("genes").cast("long")).withColumn(
        "genes", F.array_join("genes", ","))


@query("s13_manifest_checksums",
       "select 'L' || doc_id as library_id, 'yes' as enabled, sha256(text) as sha256, "
       "true as verified from documents where lang <> 'de'")
def _(spark, d):
    """One file per document; German ones are disabled; every enabled checksum must match."""
    docs = v.table(spark, d, "documents")
    name = F.concat(F.lit("L"), F.col("doc_id").cast("string"))
    manifest = docs.select(
        name.alias("library_id"), F.when(F.col("lang") == "de", "no").otherwise("yes").alias("enabled"),
        F.concat(F.lit("sets/"), name).alias("gmt_path"), F.upper(F.sha2("text", 256)).alias("sha256"))
    observed = docs.select(name.alias("file_name"),
                           F.sha2(F.col("text").cast("binary"), 256).alias("observed_sha256"))
    return r.verify_manifest(manifest, observed).select(
        "library_id", "enabled", F.lower("sha256").alias("sha256"), "verified")


def reviews(spark, d):
    """A review per supplier and manual component, decision by balance."""
    s = v.table(spark, d, "supplier")
    comp = F.explode(F.array(F.lit("image_alignment"), F.lit("spatial_artifacts"))).alias("component")
    return s.select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("sample_id"), comp,
        F.when(F.col("s_acctbal") < 0, "fail").when(F.col("s_acctbal") < 2000, " pending ")
        .otherwise("pass").alias("decision"),
        F.col("s_name").alias("evidence"), F.lit("rev").alias("reviewer"),
        F.lit("2024-05-01T10:00:00Z").alias("reviewed_at"), F.lit("").alias("notes"))


@query("s14_review_scan",
       "select 'S' || s_suppkey as sample_id, c as component, case when s_acctbal < 0 then 'FAIL' "
       "when s_acctbal < 2000 then 'PENDING' else 'PASS' end as decision, s_name as evidence, "
       "'rev' as reviewer, '2024-05-01T10:00:00Z' as reviewed_at, '' as notes "
       "from supplier, (values ('image_alignment'), ('spatial_artifacts')) t(c)")
def _(spark, d):
    table = r.read_text_table(spark, _tsv(reviews(spark, d), "reviews"))
    known = v.table(spark, d, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("sample_id"))
    return r.check_reviews(table, known, ("image_alignment", "spatial_artifacts"))


@query("s15_profile_rules",
       "select p_brand as component, w as warn, p as passed, h as higher_is_better from ("
       "select p_brand, case when count(*) % 5 = 0 then null else min(p_size) * 1.0::double end as w, "
       "case when count(*) % 7 = 0 then null else median(p_size)::double - 20 end as p, "
       "count(*) % 2 = 0 as h from part group by 1) where ((w is null) <> (p is null)) or "
       "coalesce(case when h then w < 0 or p < w else p < 0 or w < p or w > 1 end, false)")
def _(spark, d):
    from spotweave.functions.ordering import exact_quantiles
    part = v.table(spark, d, "part")
    n = part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.min("p_size").alias("lo"))
    med = exact_quantiles(part, ["p_brand"], "p_size", {"med": 0.5})
    rules = n.join(med, "p_brand").select(
        F.col("p_brand").alias("component"),
        F.when(F.col("n") % 5 != 0, F.col("lo").cast("double")).alias("warn"),
        F.when(F.col("n") % 7 != 0, F.col("med") - 20).alias("passed"),
        (F.col("n") % 2 == 0).alias("higher_is_better"))
    return r.check_profile(rules)


@query("s16_profile_assays",
       "select p_type as assay, 'G' || p_partkey as sample_id from part where p_type not in "
       "(select p_type from part group by 1 having count(*) % 2 = 0)")
def _(spark, d):
    part = v.table(spark, d, "part")
    allowed = part.groupBy(F.col("p_type").alias("assay")).agg(F.count(F.lit(1)).alias("n")).filter("n % 2 = 0")
    have = part.select(F.concat(F.lit("G"), F.col("p_partkey").cast("string")).alias("sample_id"),
                       F.col("p_type").alias("assay"))
    return r.incompatible_assays(have, allowed)


def resource_folder(spark, d):
    """One JSON summary per step, written by Spark, next to an unrelated JSON table."""
    e = v.resource(spark, d).groupBy("step").agg(
        F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("started_utc"),
        F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("finished_utc"),
        F.count(F.lit(1)).alias("n"), F.max("cpu_percent").alias("cpu"), F.max("rss_gib").alias("rss"),
        F.max("vms_gib").alias("vms"), F.max("project_gib").alias("proj"))
    out = e.select(
        "step", F.array("step").alias("command"),
        F.when(F.col("n") % 5 == 0, "failed").otherwise("success").alias("status"),
        F.when(F.col("n") % 5 == 0, 1).otherwise(0).alias("exit_code"), "started_utc", "finished_utc",
        F.col("n").cast("double").alias("wall_seconds"), F.lit(8).alias("logical_cpu_count"),
        F.col("proj").alias("final_project_size_gib"),
        F.when(F.col("cpu") > 250, F.array(F.struct(F.lit("CPU_CAPACITY_ABOVE_WARNING").alias("code"))))
        .otherwise(F.array().cast("array<struct<code:string>>")).alias("warnings"),
        F.struct(F.col("cpu").alias("cpu_percent_machine_capacity"), F.col("rss").alias("rss_gib"),
                 F.col("vms").alias("vms_gib"), F.col("proj").alias("project_size_gib")).alias("peaks"))
    root = scratch_path(spark, "resources")
    out.write.partitionBy("step").json(root + "/runs")
    v.table(spark, d, "region").write.json(root + "/other")
    return root


_RES_SQL = """
select step, case when n % 5 = 0 then 'failed' else 'success' end as status, n::double as wall_seconds,
 strftime(t0, '%Y-%m-%d %H:%M:%S') as started_utc, cpu as peak_cpu, rss as peak_rss,
 proj as peak_project, case when cpu > 250 then 1 else 0 end as n_warnings
from (select step, count(*) as n, min(ts) as t0, max(cpu_percent) as cpu, max(rss_gib) as rss,
 max(project_gib) as proj from v_resource group by 1)
"""


@query("s17_resource_summaries",
       f"select step, status, wall_seconds, started_utc, peak_cpu from ({_RES_SQL})")
def _(spark, d):
    found = r.discover_resource_summaries(spark, resource_folder(spark, d))
    return found.select(
        F.regexp_extract("resource_summary_path", "step=([^/]+)/", 1).alias("step"), "status",
        "wall_seconds", "started_utc", F.col("peaks.cpu_percent_machine_capacity").alias("peak_cpu"))


@query("s18_wide_metrics",
       "select c_mktsegment as sample_id, m.metric as metric, m.value as value from (select c_mktsegment, "
       "unnest([{'metric': 'n_spots', 'value': count(*)::double}, "
       "{'metric': 'max_balance', 'value': max(c_acctbal)}, {'metric': 'min_balance', 'value': min(c_acctbal)}]) "
       "as m from customer group by 1)")
def _(spark, d):
    wide = v.table(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("sample")).agg(
        F.count(F.lit(1)).alias("Total"), F.max("c_acctbal").alias("Hi"), F.min("c_acctbal").alias("Lo"))
    scanned = r.read_text_table(spark, _tsv(wide, "wide"))
    return r.wide_to_long(scanned.withColumnRenamed("sample", "sample_id"), ["sample_id"],
                          {"Total": "n_spots", "Hi": "max_balance", "Lo": "min_balance"})


# Barcodes of sixteen letters from the order key's digits; finished orders have no valid one.
_CODE = "translate(lpad(k::varchar, 16, '0'), '0123456789', 'ACGTNACGTN')"


def _cluster_source(spark, d):
    key = F.col("o_orderkey").cast("string")
    code = F.translate(F.lpad(key, 16, "0"), "0123456789", "ACGTNACGTN")
    return v.table(spark, d, "orders").select(
        F.when(F.col("o_orderstatus") == "F", F.concat(code, F.lit("-0"))).otherwise(F.concat(code, F.lit("-1"))).alias("Barcode"),
        v.sample_of(F.col("o_orderkey")).alias("sampleid"), F.col("o_orderpriority").alias("clusters"), key.alias("id"))


@query("s18_cluster_csv", f"""
with c as (select o_orderkey as k, o_orderstatus as st, o_orderpriority as cl from orders)
select {_CODE} || case when st = 'F' then '-0' else '-1' end as source_identifier, 'S' || (k % 25) as sample_id, cl as reference_cluster,
  {_CODE} || case when st = 'F' then '-0' else '-1' end as barcode, case when st <> 'F' then {_CODE} end as barcode_core, st <> 'F' as identifier_valid from c
""")
def _(spark, d):
    return r.read_cluster_csv(spark, _tsv(_cluster_source(spark, d).drop("id"), "clusters", ","))


@query("s18_cluster_parquet", """
select 'O' || o_orderkey as source_identifier, o_orderpriority as reference_cluster, case when o_orderstatus <> 'P' then 'S' || (o_orderkey % 25) end as sample_id,
  case when o_orderstatus <> 'P' then o_orderkey::varchar end as barcode, case when o_orderstatus <> 'P' then o_orderstatus = 'O' else false end as identifier_valid
from orders
""")
def _(spark, d):
    o = v.table(spark, d, "orders").withColumn("source_identifier", F.concat(F.lit("O"), F.col("o_orderkey").cast("string")))
    path = scratch_path(spark, "clusters")
    o.select("source_identifier", F.col("o_orderpriority").alias("leiden")).write.parquet(path)
    spots = o.filter("o_orderstatus <> 'P'").select(
        "source_identifier", v.sample_of(F.col("o_orderkey")).alias("sample_id"), F.col("o_orderkey").cast("string").alias("barcode"),
        (F.col("o_orderstatus") == "O").alias("identifier_valid"))
    return r.read_cluster_parquet(spark, path, spots)


@query("s19_parsed_identifiers", """
select sample_id, case when label_c <> 'P' then barcode end as barcode, label_b as label,
  sample_id || case when label_c = 'P' then ':' else '::' end || barcode as source_identifier, label_c <> 'P' as identifier_valid from v_clusters
""")
def _(spark, d):
    c = v.clusters(spark, d)
    joint = F.when(F.col("label_c") == "P", ":").otherwise("::")
    return r.parsed_identifiers(c.withColumn("spot_id", F.concat("sample_id", joint, "barcode")), label="label_b")


@query("s19_label_scan",
       "select case when label_c = 'P' then ' ' else sample_id end as sample_id, barcode, label_b as label, "
       "case when label_c = 'P' then ' ' else sample_id end || '::' || barcode as source_identifier, "
       "label_c <> 'P' as identifier_valid from v_clusters")
def _(spark, d):
    c = v.clusters(spark, d).withColumn(
        "sample_id", F.when(F.col("label_c") == "P", " ").otherwise(F.col("sample_id")))
    return r.label_with_validity(c, "label_b")


@query("s20_eligibility_scan",
       "select barcode, sample_id, in_primary_matrix, case when in_tissue = 0 then 'exclude' else 'keep' end "
       "as eligibility_state, in_tissue is distinct from 0 as recommended_keep from v_spot_qc")
def _(spark, d):
    from spotweave.operators.qc import spot_qc
    q = spot_qc(v.positions(spark, d), v.counts(spark, d), v.genes(spark, d), v.MITO_PREFIXES)
    off = F.coalesce(F.col("in_tissue") == 0, F.lit(False))
    q = q.withColumn("eligibility_state", F.when(off, "exclude").otherwise("keep")).withColumn(
        "recommended_keep", ~off)
    return r.scan_eligibility(q)[0]


@query("s21_sample_metadata",
       "select observation_id, s.* from v_positions join v_samples s using (sample_id)")
def _(spark, d):
    return r.attach_sample_metadata(
        v.positions(spark, d).select("observation_id", "sample_id"), v.samples(spark, d))


def artifacts(spark, d):
    """Documents as files of a run: path by source and id, content is the text."""
    doc = v.table(spark, d, "documents")
    ext = F.when(F.col("lang") == "en", ".tsv").when(F.col("lang") == "fr", ".json").when(
        F.col("lang") == "de", ".csv.gz").otherwise(".bin")
    return doc.select(
        F.concat(F.lit("results/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), ext)
        .alias("path"), F.octet_length("text").cast("long").alias("length"),
        F.col("text").cast("binary").alias("content"))


@query("s22_artifact_inventory",
       "select 'results/' || source || '/' || doc_id || case lang when 'en' then '.tsv' when 'fr' then '.json' "
       "when 'de' then '.csv.gz' else '.bin' end as path, cast(octet_length(encode(text)) as bigint) as size_bytes, source as module, "
       "case when octet_length(encode(text)) <= 4096 then sha256(text) end as sha256, "
       "case lang when 'en' then 'text/tab-separated-values' when 'fr' then 'application/json' "
       "when 'de' then 'text/csv' else 'application/octet-stream' end as media_type from documents")
def _(spark, d):
    a = artifacts(spark, d)
    return r.artifact_inventory(a.unionByName(a), 4096)


@query("s23_tsv_sink",
       "select sample_id, barcode, cast(in_tissue as varchar) as in_tissue from v_positions")
def _(spark, d):
    path = scratch_path(spark, "tsv")
    sinks.write_tsv_gz(v.positions(spark, d).select("sample_id", "barcode", "in_tissue"), path)
    out = r.read_text_table(spark, path)
    return out.withColumn("in_tissue", F.nullif("in_tissue", F.lit("")))


@query("s24_checkpoint_sink", "select * from v_counts")
def _(spark, d):
    path = scratch_path(spark, "checkpoint")
    return sinks.write_checkpoint(v.counts(spark, d), path, {"x_semantics": "raw_counts"})


@query("s25_summary_sink",
       "select sample_id, count(*) as n, count(in_tissue) as labeled from v_positions group by 1")
def _(spark, d):
    path = scratch_path(spark, "summary")
    s = v.positions(spark, d).groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("in_tissue").alias("labeled"))
    sinks.write_summary(s, path)
    return spark.read.schema("sample_id string, n bigint, labeled bigint").json(path)


@query("s26_spot_export",
       "select vec_id, label, " + ", ".join(
           f"round(embedding[{i}]::double, 6) as PC{i}" for i in range(1, 11)) + " from embeddings")
def _(spark, d):
    e = sinks.spot_export(v.table(spark, d, "embeddings"), ["vec_id", "label"], "embedding", 10)
    return e.select("vec_id", "label", *[
        F.round(F.col(f"PC{i}").cast("double"), 6).alias(f"PC{i}") for i in range(1, 11)])
