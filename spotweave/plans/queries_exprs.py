"""P: column expressions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spotweave.functions import exprs as e
from spotweave.plans import standin as v
from spotweave.plans.registry import query


@query("p01_mitochondrial_mask",
       "select gene_id, upper(gene_symbol) like 'RED %' or upper(gene_symbol) like 'OLD %' as is_mt, "
       "gene_symbol like 'Red %' as is_mt_exact from v_genes")
def _(spark, d):
    return v.genes(spark, d).select(
        "gene_id", e.mitochondrial(F.col("gene_symbol"), ("Red ", "old ")).alias("is_mt"),
        e.mitochondrial(F.col("gene_symbol"), ("Red ",), case_sensitive=True).alias("is_mt_exact"))


def _mixed(df):
    """Barcodes in lower case, with longer suffixes, or with a foreign letter, by label."""
    b = F.col("roi_barcode")
    lab = F.col("roi_label")
    return df.withColumn("b", F.when(lab == "1-URGENT", F.lower(b)).when(
        lab == "2-HIGH", F.concat(b, F.lit("0"))).when(lab == "", F.concat(F.lit("X"), b)).otherwise(b))


_MIXED = ("(select *, case roi_label when '1-URGENT' then lower(roi_barcode) when '2-HIGH' then roi_barcode || '0' "
          "when '' then 'X' || roi_barcode else roi_barcode end as b from v_roi)")


@query("p02_barcode_core_loose",
       "select b, case when regexp_matches(upper(b), '^[ACGTN]+-[0-9]+$') then "
       f"regexp_extract(upper(b), '^([ACGTN]+)-', 1) end as core from {_MIXED}")
def _(spark, d):
    return _mixed(v.roi_table(spark, d)).select("b", e.barcode_core_loose(F.col("b")).alias("core"))


@query("p03_barcode_core_strict",
       "select b, nullif(regexp_extract(b, '^([ACGTN]{16})-[1-9][0-9]*$', 1), '') as core "
       f"from {_MIXED}")
def _(spark, d):
    return _mixed(v.roi_table(spark, d)).select("b", e.barcode_core_strict(F.col("b")).alias("core"))


@query("p04_alias_application",
       "select observation_id, roi_label as roi_label_source, coalesce(canonical_label, roi_label) as "
       "roi_label_canonical, coalesce(status, 'unmapped_identity') as roi_alias_status, coalesce(notes, '') as "
       "roi_alias_notes, canonical_label is not null as roi_alias_applied from v_positions left join v_alias "
       "on roi_label = source_label")
def _(spark, d):
    from spotweave.operators.roi import apply_aliases
    p = v.positions(spark, d).select("observation_id", F.col("roi_label").alias("roi_label_source"))
    return apply_aliases(p, v.aliases(spark))


@query("p05_roi_usable",
       "select observation_id, case when s is null or trim(lower(s)) in ('noise', '4-not specified') then false "
       "else true end as usable from (select observation_id, case when in_tissue is null then null "
       "when in_tissue = 0 and roi_label = '5-LOW' then ' NOISE ' else roi_label end as s from v_positions)")
def _(spark, d):
    lab = F.when(F.col("in_tissue").isNull(), None).when(
        (F.col("in_tissue") == 0) & (F.col("roi_label") == "5-LOW"), " NOISE ").otherwise(F.col("roi_label"))
    return v.positions(spark, d).select("observation_id", lab.alias("s")).select(
        "observation_id", e.roi_usable(F.col("s"), F.col("s"), ["Noise", "4-Not Specified"]).alias("usable"))


ELIGIBILITY_SQL = """
with roi as (
  select sample_id, regexp_extract(roi_barcode, '^([ACGTN]+)-', 1) || '-1' as barcode, roi_label from v_roi),
t as (
  select p.sample_id, p.barcode, p.in_tissue, p.in_primary_matrix, p.total_counts, p.n_genes_by_counts,
    r.barcode is not null as mem, nullif(trim(r.roi_label), '') as lab,
    case when p.pxl_col * 0.1::double < 0 or p.pxl_col * 0.1::double >= 220 or p.pxl_row * 0.1::double < 0
      or p.pxl_row * 0.1::double >= 280 then 'outside' else 'inside' end as bounds
  from v_spot_qc p left join roi r using (sample_id, barcode)),
u as (select *, mem and lab is null as missing, mem and coalesce(lower(lab) = '4-not specified', false) as excl
  from t),
w as (select *, case when missing then null else mem and not excl end as manual from u),
x as (select *, list_filter([
  case when not in_primary_matrix then 'NOT_IN_PRIMARY_MATRIX' end,
  case when in_tissue = 0 then 'UPSTREAM_OFF_TISSUE' end,
  case when in_primary_matrix and total_counts = 0 then 'ZERO_TOTAL_COUNTS' end,
  case when in_primary_matrix and n_genes_by_counts = 0 then 'ZERO_DETECTED_GENES' end,
  case when in_primary_matrix and not mem then 'OUTSIDE_MANUAL_ROI' end,
  case when excl then 'ROI_LABEL_EXCLUDED' end,
  case when in_tissue is not null and manual is not null and (in_tissue = 1) <> manual
    and (in_primary_matrix or mem) then 'TISSUE_SOURCE_CONFLICT' end,
  case when missing then 'ROI_LABEL_MISSING' end,
  case when bounds = 'outside' then 'COORDINATE_OUT_OF_IMAGE_BOUNDS' end,
  case when in_primary_matrix and in_tissue is null then 'ELIGIBILITY_SOURCE_UNAVAILABLE' end],
  lambda c: c is not null) as codes from w),
z as (select *, case
  when list_has_any(codes, ['NOT_IN_PRIMARY_MATRIX', 'UPSTREAM_OFF_TISSUE', 'ZERO_TOTAL_COUNTS',
    'ZERO_DETECTED_GENES', 'OUTSIDE_MANUAL_ROI', 'ROI_LABEL_EXCLUDED']) then 'exclude'
  when list_has_any(codes, ['ROI_UNAVAILABLE', 'ELIGIBILITY_SOURCE_UNAVAILABLE']) then 'not_evaluable'
  when list_has_any(codes, ['ROI_LABEL_MISSING', 'COORDINATE_OUT_OF_IMAGE_BOUNDS']) then 'review'
  else 'keep' end as eligibility_state, array_to_string(codes, ';') as reason_codes from x)
"""


def eligibility(spark, d):
    """Decision table of every place with the manual labels matched by 10x core."""
    from spotweave.operators.eligibility import assess_eligibility
    from spotweave.operators.qc import spot_qc
    q = spot_qc(v.positions(spark, d).drop("roi_label"), v.counts(spark, d), v.genes(spark, d),
                v.MITO_PREFIXES)
    images = v.samples(spark, d).select(
        "sample_id", F.lit(0.1).alias("scale"), F.lit(220).alias("width"), F.lit(280).alias("height"))
    return assess_eligibility(q, v.roi_table(spark, d), images, v.EXCLUDED_LABELS)


@query("p06_eligibility_reasons", ELIGIBILITY_SQL + "select sample_id, barcode, reason_codes from z")
def _(spark, d):
    return eligibility(spark, d).select("sample_id", "barcode", "reason_codes")


@query("p07_state_from_reasons",
       ELIGIBILITY_SQL + "select reason_codes, eligibility_state, count(*) as n from z group by 1, 2")
def _(spark, d):
    return eligibility(spark, d).groupBy("reason_codes", "eligibility_state").agg(F.count(F.lit(1)).alias("n"))


@query("p08_recommended_keep",
       ELIGIBILITY_SQL + "select sample_id, barcode, case eligibility_state when 'keep' then true when 'exclude' "
       "then false end as recommended_keep from z")
def _(spark, d):
    return eligibility(spark, d).select("sample_id", "barcode", "recommended_keep")


@query("p09_coordinate_bounds",
       "select observation_id, case when in_tissue is null then 'not_available' when pxl_col * 0.2::double >= 400 "
       "or pxl_row * 0.2::double >= 500 then 'outside' else 'inside' end as bounds_status from v_positions")
def _(spark, d):
    x = F.when(F.col("in_tissue").isNotNull(), F.col("pxl_col"))
    return v.positions(spark, d).select("observation_id", e.bounds_status(
        x, F.col("pxl_row"), F.lit(0.2), F.lit(400), F.lit(500)).alias("bounds_status"))


GATE_SQL = ELIGIBILITY_SQL + """, g as (select *, list_filter([
  case when eligibility_state <> 'keep' then 'UPSTREAM_NOT_RECOMMENDED' end,
  case when total_counts = 0 then 'ZERO_TOTAL_COUNTS' end,
  case when n_genes_by_counts < 3 and total_counts <> 0 then 'BELOW_MIN_GENES' end], lambda c: c is not null)
  as gate from z where in_primary_matrix)
"""


@query("p10_analysis_gate",
       GATE_SQL + "select sample_id, barcode, coalesce(gate[1], 'KEEP') as primary_filter_reason, "
       "array_to_string(list_concat(codes, list_filter(gate, lambda c: not list_contains(codes, c))), ';') "
       "as analysis_reason_codes, len(gate) = 0 as analysis_keep from g")
def _(spark, d):
    from spotweave.operators.cohort import analysis_gate
    return analysis_gate(eligibility(spark, d).filter("in_primary_matrix"), min_genes=3).select(
        "sample_id", "barcode", "primary_filter_reason", "analysis_reason_codes", "analysis_keep")


@query("p11_gene_filter_reason",
       "select gene_id, count(c.barcode) as n_spots, case when count(c.barcode) >= 30 then 'KEEP' else "
       "'BELOW_MIN_SPOTS' end as primary_filter_reason from v_genes left join v_counts c using (gene_id) group by 1")
def _(spark, d):
    from spotweave.operators.cohort import spots_per_gene
    return spots_per_gene(v.counts(spark, d), v.genes(spark, d).select("gene_id"), min_spots=30).select(
        "gene_id", "n_spots", "primary_filter_reason")


@query("p12_log1p_cp10k",
       "select sample_id, barcode, gene_id, round(ln(1 + count * 10000.0::double / sum(count) over "
       "(partition by sample_id, barcode)), 6) as log1p_cp from v_counts")
def _(spark, d):
    from spotweave.operators.cohort import normalise
    return normalise(v.counts(spark, d)).select(
        "sample_id", "barcode", "gene_id", F.round("log1p_cp", 6).alias("log1p_cp"))


@query("p13_log2_cpm",
       "select sample_id, gene_id, round(log2(c * 1.0::double / sum(c) over (partition by sample_id) * 1e6 + 1), 6) "
       "as log2_cpm from (select sample_id, gene_id, sum(count) as c from v_counts group by 1, 2)")
def _(spark, d):
    per = v.counts(spark, d).groupBy("sample_id", "gene_id").agg(F.sum("count").alias("c"))
    lib = per.groupBy("sample_id").agg(F.sum("c").alias("lib"))
    return per.join(lib, "sample_id").select(
        "sample_id", "gene_id", F.round(e.log2_cpm1(F.col("c"), F.col("lib")), 6).alias("log2_cpm"))


@query("p14_threshold_class",
       "select p_partkey, case when p_size % 9 = 0 then 'NA' when p_size % 8 = 0 then 'UNCALIBRATED' "
       "when p_type = 'PROMO' then case when p_retailprice <= 1000 then 'PASS' when p_retailprice <= 1400 then 'WARN' "
       "else 'FAIL' end else case when p_retailprice < 1000 then 'FAIL' when p_retailprice < 1400 then 'WARN' "
       "else 'PASS' end end as status from part")
def _(spark, d):
    low = F.col("p_type") == "PROMO"
    known = F.col("p_size") % 8 != 0
    a, b = F.when(known, 1000.0), F.when(known, 1400.0)
    value = F.when(F.col("p_size") % 9 != 0, F.col("p_retailprice"))
    return v.table(spark, d, "part").select("p_partkey", e.threshold_class(
        value, F.when(low, b).otherwise(a), F.when(low, a).otherwise(b), ~low).alias("status"))


@query("p15_identifier_split",
       "select observation_id, case when starts_with(observation_id, s || '::') then "
       "substr(observation_id, length(s) + 3) end as barcode, case when ends_with(barcode || '-' || sample_id, "
       "'-' || s) then barcode end as stripped from (select *, case when roi_label = '5-LOW' then 'S2' else sample_id "
       "end as s from v_positions)")
def _(spark, d):
    p = v.positions(spark, d).withColumn(
        "s", F.when(F.col("roi_label") == "5-LOW", "S2").otherwise(F.col("sample_id")))
    joined = F.concat_ws("-", "barcode", "sample_id")
    return p.select("observation_id", e.barcode_from_observation(F.col("observation_id"), F.col("s")).alias("barcode"),
                    e.barcode_without_sample_suffix(joined, F.col("s")).alias("stripped"))


@query("p16_design_cell",
       "select sample_id, lower(genotype) || '_' || lower(treatment) as design_cell from v_samples")
def _(spark, d):
    from spotweave.operators.design import assign_design_cells
    return assign_design_cells(v.samples(spark, d), "G0", "G1", "T0", "T1").select("sample_id", "design_cell")


@query("p17_stable_seed",
       "select sample_id, barcode, cast(('0x' || substr(sha256('1729' || chr(0) || sample_id || chr(0) || barcode), "
       "9, 8)) as bigint) as seed from v_positions")
def _(spark, d):
    return v.positions(spark, d).select("sample_id", "barcode", e.stable_seed(
        F.lit(1729), F.col("sample_id"), F.col("barcode")).alias("seed"))


@query("p18_fingerprint",
       "select term, sha256('{\"library_id\":\"' || library_id || '\",\"seed\":0,\"term\":\"' || term || '\"}') as fp "
       "from v_gene_sets group by library_id, term")
def _(spark, d):
    t = v.gene_sets(spark, d).select("library_id", "term").distinct()
    return t.select("term", e.fingerprint(F.struct("library_id", F.lit(0).alias("seed"), "term")).alias("fp"))


@query("p19_path_redaction", r"""
select key, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
  '(?i)(^|[^A-Za-z0-9_])file://[^\s<>"'']+', '\1<redacted-path>', 'g'),
  '(^|[^A-Za-z0-9])(?:[A-Za-z]:[\\/]|\\\\)[^\s<>"'';,)\]}]+', '\1<redacted-path>', 'g'),
  '(^|[^A-Za-z0-9:<>''"/])~[/\\][^\s<>"'';,)\]}]+', '\1<redacted-path>', 'g'),
  '(^|[^A-Za-z0-9:<>''"/>])/[\p{L}\p{M}\p{N}_.~\-][^\s<>"'';,)\]}]*', '\1<redacted-path>', 'g')) as redacted_md5
from (select 'd' || doc_id as key, text from documents union all
      select 'e' || event_id, 'see /data/run/' || event_type || '/x.tsv, C:\tmp\' || user_id || ' ~/a and 1/2'
      from events)
""")
def _(spark, d):
    docs = v.table(spark, d, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("key"), "text")
    ev = v.table(spark, d, "events").select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("key"),
        F.concat(F.lit("see /data/run/"), F.col("event_type"), F.lit("/x.tsv, C:\\tmp\\"),
                 F.col("user_id").cast("string"), F.lit(" ~/a and 1/2")).alias("text"))
    return docs.unionByName(ev).select("key", F.md5(e.redact_paths(F.col("text"))).alias("redacted_md5"))


@query("p20_portable_path",
       "select page_id, case when starts_with(u, '/example/') then substr(u, 10) when starts_with(u, '/') then "
       "'<external>/' || regexp_extract(u, '([^/]+)$', 1) else u end as path from (select page_id, case page_id % 3 "
       "when 0 then '/example/' || url when 1 then '/other/' || url else url end as u from pages)")
def _(spark, d):
    k = F.col("page_id") % 3
    u = F.when(k == 0, F.concat(F.lit("/example/"), "url")).when(
        k == 1, F.concat(F.lit("/other/"), "url")).otherwise(F.col("url"))
    return v.table(spark, d, "pages").select("page_id", e.portable_path(u, "/example").alias("path"))


@query("p21_step_id",
       "select doc_id, case when doc_id % 3 = 0 then source || '_resources' when doc_id % 3 = 1 then 'run' || doc_id "
       "else 'qc' || doc_id end as step_id from documents")
def _(spark, d):
    k, key = F.col("doc_id") % 3, F.col("doc_id").cast("string")
    path = F.when(k == 0, F.concat(F.lit("logs/"), "source", F.lit("/resources.json"))).when(
        k == 1, F.concat(F.lit("logs/run"), key, F.lit(".summary.json"))).otherwise(
        F.concat(F.lit("logs/qc"), key, F.lit("_summary.json")))
    return v.table(spark, d, "documents").select("doc_id", e.step_id(path).alias("step_id"))


@query("p22_natural_key",
       "select p_brand, cast(row_number() over (order by cast(regexp_extract(p_brand, '([0-9]+)$', 1) as integer)) as "
       "bigint) as natural_rank from (select distinct p_brand from part)")
def _(spark, d):
    from spotweave.functions.ordering import row_rank
    b = v.table(spark, d, "part").select("p_brand").distinct()
    return row_rank(b, [], [e.natural_key(F.col("p_brand")).asc()], "natural_rank")


@query("p23_sample_from_path",
       "select doc_id, case lang when 'en' then source when 'fr' then source else null end as sample_id "
       "from documents")
def _(spark, d):
    lang, src = F.col("lang"), F.col("source")
    path = F.when(lang == "en", F.concat(F.lit("results/qc/"), src, F.lit("/a.tsv"))).when(
        lang == "fr", F.concat(F.lit("results/qc/cohort/svg/"), src)).when(
        lang == "de", F.concat(F.lit("results/input/"), src, F.lit(".json"))).otherwise(
        F.concat(F.lit("results/roi/"), src, F.lit("/b.tsv")))
    return v.table(spark, d, "documents").select("doc_id", e.sample_from_path(path).alias("sample_id"))


@query("p24_safe_ratio",
       "select l_orderkey, l_linenumber, round(l_quantity / nullif(l_discount, 0), 6) as ratio from lineitem")
def _(spark, d):
    return v.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(e.safe_ratio(F.col("l_quantity"), F.col("l_discount")), 6).alias("ratio"))


@query("p25_difference_class",
       "select l_orderkey, l_linenumber, case when l_returnflag = 'N' then 'metric_missing_on_one_side' "
       "when l_tax = 0 then 'exact' when l_tax < 0.05 then 'rounding_only' else "
       "'expected_population_or_method_difference' end as comparison_status from lineitem")
def _(spark, d):
    tax = F.col("l_tax")
    ref = F.when(F.col("l_returnflag") != "N", F.col("l_quantity") + F.when(tax == 0, 0.0).when(
        tax < 0.05, 0.0005).otherwise(tax))
    return v.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", e.difference_class(F.col("l_quantity"), ref).alias("comparison_status"))


@query("p26_signal_transforms",
       "select l_orderkey, l_linenumber, round(ln(1 + l_quantity), 6) as log1p_value, "
       "round(log10(1 + l_quantity), 6) as log10p1_value from lineitem")
def _(spark, d):
    q = F.col("l_quantity")
    return v.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(F.log1p(q), 6).alias("log1p_value"),
        F.round(F.log10(q + 1), 6).alias("log10p1_value"))


@query("p27_dotted_lookup",
       "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, "
       "json_extract_string(props, '$.missing.path') as missing from events")
def _(spark, d):
    return v.table(spark, d, "events").select(
        "event_id", F.get_json_object("props", "$.k").cast("long").alias("k"),
        F.get_json_object("props", "$.missing.path").alias("missing"))


@query("p28_resolution_token",
       "select p_partkey, replace(cast(p_size / 10.0::double as varchar), '.', 'p') as raw_token, "
       "case when p_size % 10 = 0 then cast(p_size // 10 as varchar) else replace(cast(p_size / 10.0::double as varchar), "
       "'.', 'p') end as token from part")
def _(spark, d):
    x = F.col("p_size") / F.lit(10.0)
    return v.table(spark, d, "part").select(
        "p_partkey", F.translate(x.cast("string"), ".", "p").alias("raw_token"), e.resolution_token(x).alias("token"))


@query("p29_path_glob",
       "select path from (select 'results/' || source || '/' || doc_id || '.tsv' as path, source, row_number() over "
       "(partition by source order by doc_id) as rn from documents where regexp_matches('results/' || source || '/' || "
       "doc_id || '.tsv', '^results/src1.*/.*5\\.tsv$')) where rn <= 20")
def _(spark, d):
    from spotweave.functions.ordering import top_n
    p = v.table(spark, d, "documents").select("doc_id", "source", F.concat(
        F.lit("results/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".tsv")).alias("path"))
    hits = p.filter(F.col("path").rlike(e.glob_to_regex("results/src1*/*5.tsv")))
    return top_n(hits, ["source"], [F.col("doc_id").asc()], 20, "rn").select("path")


@query("p29_module_artifacts",
       "select source as module, path from (select source, 'results/' || source || '/' || doc_id || '.tsv' as path, row_number() over "
       "(order by 'results/' || source || '/' || doc_id || '.tsv') as rn from documents where source = 'src1' and doc_id::varchar like '%1') where rn <= 20")
def _(spark, d):
    from spotweave.operators.reporting import matching_artifacts
    p = v.table(spark, d, "documents").select(F.col("source").alias("module"), F.concat(
        F.lit("results/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".tsv")).alias("path"))
    return matching_artifacts(p, "src1", "results/src1/*[!2-9].tsv", 20)
