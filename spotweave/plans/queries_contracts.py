"""V: validation contracts; every query returns the violations found in whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spotweave.operators import contracts as c
from spotweave.operators.qc import count_metrics, spot_qc
from spotweave.plans import standin as v
from spotweave.plans.registry import query


@query("v01_duplicate_keys",
       "select l_orderkey, l_partkey, count(*) as n_rows from lineitem group by 1, 2 having count(*) > 1")
def _(spark, d):
    return c.duplicate_keys(v.table(spark, d, "lineitem"), ["l_orderkey", "l_partkey"])


@query("v02_key_set_difference",
       "(select sample_id, barcode, 'missing' as side from v_positions p where not exists (select 1 from "
       "v_primary q where q.sample_id = p.sample_id and q.barcode = p.barcode)) union all "
       "(select sample_id, barcode, 'extra' as side from v_primary q where not exists (select 1 from "
       "v_positions p where q.sample_id = p.sample_id and q.barcode = p.barcode))")
def _(spark, d):
    return c.key_set_difference(v.positions(spark, d), v.primary(spark, d), ["sample_id", "barcode"])


@query("v03_raw_count_contract",
       "select event_id, value from events where value < 0 or abs(value - round_even(value, 0)) > 1e-6")
def _(spark, d):
    return c.bad_counts(v.table(spark, d, "events"), "value").select("event_id", "value")


@query("v04_drop_zeros",
       "select l_orderkey, l_linenumber, l_partkey, round(l_discount * 100)::bigint as count from lineitem "
       "where l_discount <> 0")
def _(spark, d):
    li = v.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(F.col("l_discount") * 100).cast("long").alias("count"))
    return c.drop_zeros(li)


@query("v05_boolean_parse",
       "select o_orderkey, t from (select o_orderkey, case o_orderstatus when 'O' then ' True' when 'P' then '' "
       "when 'F' then case when o_orderpriority = '5-LOW' then 'maybe' else '0' end end as t from orders) "
       "where t = 'maybe'")
def _(spark, d):
    s = F.col("o_orderstatus")
    t = F.when(s == "O", " True").when(s == "P", "").otherwise(
        F.when(F.col("o_orderpriority") == "5-LOW", "maybe").otherwise("0"))
    return c.unparsed_booleans(v.table(spark, d, "orders").select("o_orderkey", t.alias("t")), "t", True)


@query("v06_checksum_equality",
       "select doc_id, sha256(text) as sha256, sha256(lower(text)) as observed_sha256 from documents "
       "where sha256(text) <> sha256(lower(text))")
def _(spark, d):
    doc = v.table(spark, d, "documents")
    want = doc.select("doc_id", F.sha2("text", 256).alias("sha256"))
    seen = doc.select("doc_id", F.sha2(F.lower("text"), 256).alias("observed_sha256"))
    return c.checksum_mismatch(want, seen, ["doc_id"])


@query("v07_numeric_parse",
       "select item, t from (select p_partkey as item, case when p_size % 4 = 0 then '' when p_size % 4 = 1 "
       "then ' ' || p_size else case when p_size > 40 then p_type else '1' end end as t from part) "
       "where trim(t) <> '' and (try_cast(trim(t) as double) is null or try_cast(trim(t) as double) not in (0, 1))")
def _(spark, d):
    size = F.col("p_size")
    t = F.when(size % 4 == 0, "").when(size % 4 == 1, F.concat(F.lit(" "), size.cast("string"))).otherwise(
        F.when(size > 40, F.col("p_type")).otherwise("1"))
    return c.unparsed_numbers(v.table(spark, d, "part").select(
        F.col("p_partkey").alias("item"), t.alias("t")), "t", binary=True)


@query("v08_declared_samples",
       "(select 'S' || n_nationkey as sample_id, 'missing' as side from nation where n_nationkey not in "
       "(select s_nationkey from supplier where s_acctbal > 5000)) union all (select distinct case when s_acctbal > 5000 then "
       "'S' else 'X' end || s_nationkey, 'extra' from supplier where s_acctbal <= 5000 or s_nationkey not in (select n_nationkey "
       "from nation))")
def _(spark, d):
    named = F.when(F.col("s_acctbal") > 5000, "S").otherwise("X")
    seen = v.table(spark, d, "supplier").select(F.concat(named, F.col("s_nationkey").cast("string")).alias("sample_id"))
    return c.unexpected_samples(seen, v.samples(spark, d))


@query("v09_functional_dependency",
       "select p_name, count(*) as n_values from (select distinct p_name, p_type from part) group by 1 "
       "having count(*) > 1")
def _(spark, d):
    return c.functional_dependency(v.table(spark, d, "part"), ["p_name"], ["p_type"])


@query("v10_constant_within_group",
       "select sample_id, roi_label, count(*) as n_values from (select distinct sample_id, roi_label, in_tissue "
       "from v_positions where in_tissue is not null) group by 1, 2 having count(*) > 1")
def _(spark, d):
    return c.varying_within(v.positions(spark, d), ["sample_id", "roi_label"], "in_tissue")


@query("v11_one_to_one",
       "select (select count(*) from nation where n_name is null) = 0 and "
       "(select count(distinct n_name) = count(*) and count(distinct n_nationkey) = count(*) from nation) "
       "as one_to_one")
def _(spark, d):
    return c.one_to_one(v.table(spark, d, "nation"), "n_nationkey", "n_name")


@query("v12_gene_universe",
       "with g as (select distinct 'S' || (l_orderkey % 25) as sample_id, 'G' || l_partkey as gene_id, "
       "case when l_returnflag = 'R' and p_type = 'PROMO' then 'alt' else p_name end as gene_symbol "
       "from lineitem join part on l_partkey = p_partkey) "
       "select gene_id, count(distinct sample_id) as n_samples, min(gene_symbol) as first_symbol, "
       "max(gene_symbol) as last_symbol from g group by 1 having count(distinct sample_id) <> "
       "(select count(distinct sample_id) from g) or min(gene_symbol) <> max(gene_symbol)")
def _(spark, d):
    li = v.table(spark, d, "lineitem").join(
        v.table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    alt = (F.col("l_returnflag") == "R") & (F.col("p_type") == "PROMO")
    g = li.select(
        v.sample_of(F.col("l_orderkey")).alias("sample_id"),
        F.concat(F.lit("G"), F.col("l_partkey").cast("string")).alias("gene_id"),
        F.when(alt, "alt").otherwise(F.col("p_name")).alias("gene_symbol")).distinct()
    return c.inconsistent_genes(g)


@query("v13_coordinate_uniqueness",
       "select sample_id, array_row, array_col, count(*) as n_rows from (select 'S' || c_nationkey as sample_id, "
       "cast(c_custkey // 40 as integer) as array_row, cast(c_custkey % 2 as integer) as array_col from customer) "
       "group by 1, 2, 3 having count(*) > 1")
def _(spark, d):
    k = F.col("c_custkey")
    s = v.table(spark, d, "customer").select(
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("sample_id"),
        F.floor(k / 40).cast("int").alias("array_row"), (k % 2).cast("int").alias("array_col"))
    return c.duplicate_coordinates(s)


@query("v14_coordinate_system",
       "select sample_id, count(*) as n, case when count(pc) not in (0, count(*)) or count(pr) not in (0, count(*)) "
       "or count(pc) <> count(pr) then 'COORDINATE_PAIR_INCOMPLETE' when count(pr) = count(*) then 'pixel' "
       "else 'array' end as coordinate_system from (select sample_id, "
       "case when sample_id like 'S1%' then null else pxl_row end as pr, "
       "case when sample_id like 'S1%' or (sample_id = 'S2' and roi_label = '5-LOW') then null else pxl_col end as pc "
       "from v_positions) group by 1")
def _(spark, d):
    s = F.col("sample_id")
    p = v.positions(spark, d).withColumn(
        "pxl_row", F.when(~s.startswith("S1"), F.col("pxl_row"))).withColumn(
        "pxl_col", F.when(~(s.startswith("S1") | ((s == "S2") & (F.col("roi_label") == "5-LOW"))),
                          F.col("pxl_col")))
    return c.coordinate_system(p)


@query("v15_genes_within_counts",
       "select l_orderkey, count(*) as n_genes_by_counts, cast(sum(l_linenumber = 1) as bigint) as total_counts "
       "from lineitem group by 1 having count(*) > sum(l_linenumber = 1)")
def _(spark, d):
    li = v.table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_genes_by_counts"), F.count_if(F.col("l_linenumber") == 1).alias("total_counts"))
    return c.genes_exceed_counts(li)


@query("v16_keep_matches_state",
       "select o_orderkey, s as eligibility_state, k as recommended_keep from (select o_orderkey, "
       "case o_orderstatus when 'O' then 'keep' when 'F' then 'exclude' else 'review' end as s, "
       "case when o_orderpriority = '5-LOW' then null when o_orderpriority = '1-URGENT' then false else "
       "o_orderstatus = 'O' end as k from orders) where k is distinct from "
       "(case s when 'keep' then true when 'exclude' then false end)")
def _(spark, d):
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    o = v.table(spark, d, "orders").select(
        "o_orderkey",
        F.when(st == "O", "keep").when(st == "F", "exclude").otherwise("review").alias("eligibility_state"),
        F.when(pr == "5-LOW", None).when(pr == "1-URGENT", False).otherwise(st == "O").alias("recommended_keep"))
    return c.keep_disagrees_with_state(o)


@query("v17_metrics_match_counts",
       "with q as (select sample_id, barcode, case when roi_label = '5-LOW' then total_counts + 1 else total_counts "
       "end as total_counts, n_genes_by_counts from v_spot_qc) select q.* from q left join v_spot_qc s "
       "using (sample_id, barcode) where q.total_counts <> s.total_counts or "
       "q.n_genes_by_counts <> s.n_genes_by_counts")
def _(spark, d):
    q = spot_qc(v.positions(spark, d), v.counts(spark, d), v.genes(spark, d), v.MITO_PREFIXES)
    shifted = q.withColumn("total_counts", F.when(
        F.col("roi_label") == "5-LOW", F.col("total_counts") + 1).otherwise(F.col("total_counts")))
    return c.totals_disagree(
        shifted.select("sample_id", "barcode", "total_counts", "n_genes_by_counts"),
        count_metrics(v.counts(spark, d)), ["sample_id", "barcode"], ["total_counts", "n_genes_by_counts"])


@query("v18_conservation",
       "select sample_id, count(*) as n_rows, count(in_tissue) as n_categorised, "
       "count(*) = count(in_tissue) as conserved from v_positions group by 1")
def _(spark, d):
    return c.conservation(v.positions(spark, d), "in_tissue")


@query("v19_descriptive_only",
       "select p_partkey, p_size % 5 <> 0 as exploratory_only, case when p_size % 7 = 0 then p_retailprice end "
       "as p_value, null::double as fdr_bh from part where p_size % 5 = 0 or p_size % 7 = 0")
def _(spark, d):
    p = v.table(spark, d, "part").select(
        "p_partkey", (F.col("p_size") % 5 != 0).alias("exploratory_only"),
        F.when(F.col("p_size") % 7 == 0, F.col("p_retailprice")).alias("p_value"),
        F.lit(None).cast("double").alias("fdr_bh"))
    return c.not_descriptive(p)


@query("v20_raw_orphans",
       "with raw as (select distinct sample_id, barcode from v_counts), "
       "pos as (select p.*, q.barcode is not null as in_primary_matrix from (select * replace (barcode || case when roi_label = "
       "'2-HIGH' then 'x' else '' end as barcode) from v_positions) p left join v_primary q using (sample_id, barcode)) "
       "(select sample_id, barcode, 'RAW_BARCODE_WITHOUT_POSITION' as code from raw anti join pos "
       "using (sample_id, barcode)) union all (select sample_id, barcode, case when in_primary_matrix then "
       "'PRIMARY_POSITION_ABSENT_RAW' else 'IN_TISSUE_POSITION_ABSENT_RAW' end from pos anti join raw "
       "using (sample_id, barcode) where in_primary_matrix or in_tissue = 1)")
def _(spark, d):
    prim = v.primary(spark, d).withColumn("p", F.lit(True))
    moved = F.concat("barcode", F.when(F.col("roi_label") == "2-HIGH", "x").otherwise(""))
    pos = v.positions(spark, d).withColumn("barcode", moved).join(
        prim, ["sample_id", "barcode"], "left").withColumn("in_primary_matrix", F.coalesce("p", F.lit(False)))
    return c.raw_orphans(v.counts(spark, d), pos)


@query("v21_forbidden_text", r"""
with l as (
  select path, line_number, line from (
    select 'documents/' || doc_id as path, generate_subscripts(string_split(text, chr(10)), 1) as line_number,
      unnest(string_split(text, chr(10))) as line from documents
    union all
    select 'pages/' || page_id, generate_subscripts(string_split(html, chr(10)), 1),
      unnest(string_split(html, chr(10))) from pages)),
h as (select path, line_number, [
  case when regexp_matches(line, '(?i)(^|[^A-Za-z0-9_])file://') then 'file URL' end,
  case when regexp_matches(line, '(^|[^A-Za-z0-9])[A-Za-z]:[\\/]') then 'Windows drive path' end,
  case when regexp_matches(line, '\\{2,}[^\\\s]+\\{1,}[^\\\s]+') then 'UNC path' end,
  case when regexp_matches(line, '(?i)/(?:home|users|private|mnt|tmp|var/tmp|root|workspace|data|srv|opt)/')
    then 'common POSIX local path' end,
  case when contains(line, 'example.com') then 'forbidden value ''example.com''' end,
  case when contains(line, 'password') then 'forbidden value ''password''' end] as hits from l)
select path, cast(line_number as bigint) as line_number,
  array_to_string(list_sort(list_filter(hits, lambda x: x is not null)), ', ') as labels
from h where len(list_filter(hits, lambda x: x is not null)) > 0
""")
def _(spark, d):
    def lines(df, prefix, key, text):
        return df.select(F.concat(F.lit(prefix), F.col(key).cast("string")).alias("path"),
                         F.posexplode(F.split(text, "\n", -1)).alias("p", "line")).select(
            "path", (F.col("p") + 1).cast("long").alias("line_number"), "line")

    both = lines(v.table(spark, d, "documents"), "documents/", "doc_id", "text").unionByName(
        lines(v.table(spark, d, "pages"), "pages/", "page_id", "html"))
    return c.forbidden_text(both, ["example.com", "password"], limit=None)
