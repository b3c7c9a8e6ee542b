"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Sources share all words by weight, no source above ``max_epochs`` times its own words. Within
a source documents stand in the order of exponential keys ``-ln(u) / quality``: a weighted
sample without replacement is any prefix of that order. Complete epochs take every document
once; the words still missing are the prefix of that order, and the document on the edge
gives just the words the budget still has.

Rows are range-partitioned by (source, key), so one source of any size is spread over many
tasks; prefix sums are local sums plus one offset per partition and source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from spotweave.llm.common import WORD, packed, pick, unpacked, written

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SYMBOLS = r"[#*$%&|<>]+"
MIN_QUALITY = 0.1


def uniform(doc_id: Column, seed: int) -> Column:
    """52 bits of md5 as a number inside (0, 1)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def keyed(documents: DataFrame, seed: int) -> DataFrame:
    """Source key (null last), words, and the exponential key scaled by quality: the share of words without symbol runs."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    noise = F.coalesce(F.regexp_count("text", F.lit(SYMBOLS)), F.lit(0)).cast("double")
    quality = F.greatest(F.lit(MIN_QUALITY), 1.0 - noise / F.greatest(F.col("size"), F.lit(1)))
    source = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))
    return (documents.withColumn("size", words).withColumn("sort_key", -F.log(uniform(F.col("doc_id"), seed)) / quality)
            .withColumn("source_key", source).withColumn("tie", F.xxhash64("text")))


def targets(rows: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """One row per source: its words and its target.

    In ascending order of cap / weight the capped sources come first; a source is capped when
    its share of what the capped ones before it leave is above its cap. One row per source
    goes through this window, however many documents there are.
    """
    by_name = W.orderBy("source_key")
    table = F.array(*[F.lit(w) for w in weights])
    s = rows.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("weight", F.get(table, (F.row_number().over(by_name) - 1) % len(weights)))
    s = s.withColumn("cap", F.col("source_size") * max_epochs)
    order = [F.col("cap") / F.col("weight"), F.col("source_key")]
    before = W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    after = W.orderBy(*order).rowsBetween(0, W.unboundedFollowing)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    s = s.withColumn("level", left / F.sum("weight").over(after))
    s = s.withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    level = F.min(F.when(~F.col("capped"), F.struct(*order, F.col("level").alias("level")))).over(everything)["level"]
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(level * F.col("weight"))
    return s.select("source_key", "source_size", target.alias("target"))


def plan(rows: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """The rows of ``keyed`` (without texts) with source_size, target, epochs and taken."""
    order = ["sort_key", "doc_id", "size", "tie"]
    goals = targets(rows, weights, max_epochs)
    # The partition number is written with the rows, so every later reading sees the same one.
    dealt = written(rows.repartitionByRange("source_key", *order).withColumn("part", F.spark_partition_id()), "mix")
    sums = dealt.groupBy("part", "source_key").agg(F.sum("size").alias("words"))
    earlier = W.partitionBy("source_key").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("part", "source_key", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    local = W.partitionBy("part", "source_key").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    out = dealt.withColumn("before", F.coalesce(F.sum("size").over(local), F.lit(0)))
    out = out.join(sums.join(goals, "source_key"), ["part", "source_key"])
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    out = out.withColumn("epochs", epochs)
    missing = budget - F.col("epochs") * F.col("source_size") - F.col("offset") - F.col("before")
    part = F.greatest(F.lit(0), F.least(F.col("size"), missing))
    return out.withColumn("taken", (F.col("epochs") * F.col("size") + part).cast("long"))


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 0) -> DataFrame:
    """Per input row doc_id, size, source_size, target, epochs and taken (long words, repeats counted).

    A null text has no words and is never taken; a null source is a source of its own, the
    last. Repeated rows are documents of their own; rows of equal key stand by doc_id, size
    and text. A source without words has target 0. An empty table gives no rows. Other
    columns are ignored. No text is shuffled or written.
    """
    docs = pick(documents, doc_id="long", text="string", source="string")
    rows = written(keyed(docs, seed).drop("text", "source"), "mix")
    return plan(rows, weights, max_epochs).select("doc_id", "size", "source_size", "target", "epochs", "taken")


def mixed_documents(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 0) -> DataFrame:
    """The mix as document rows: one per epoch that takes the document, texts whole, all columns kept.

    The document on the edge of a source's budget is kept whole, so a source may exceed its
    target by less than one document. Texts are written once with their row number and meet
    the plan by it. Odd cases as in ``mix``.
    """
    docs = packed(documents, doc_id="long", text="string", source="string").withColumn("row", F.monotonically_increasing_id())
    held = written(docs.select("row", "_row"), "mix")
    small = held.select("row", *[F.col("_row")[f"_{documents.columns.index(n)}"].cast(t).alias(n) for n, t in (
        ("doc_id", "long"), ("text", "string"), ("source", "string"))])
    found = plan(written(keyed(small, seed).drop("text", "source"), "mix"), weights, max_epochs).filter("taken > 0")
    copies = found.select("row", F.ceil(F.col("taken") / F.col("size")).cast("int").alias("copies"))
    out = held.join(copies, "row").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return unpacked(out, documents)


#: Columns doc_id, size, source_size, target, epochs, taken of ``documents``.
SQL = r"""
with d as (select doc_id, source is null as no_source, source, text,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    coalesce(len(regexp_extract_all(text, '[#*$%&|<>]+')), 0)::double as noise from {documents}),
k as (select doc_id, no_source, coalesce(source, '') as source, size,
    -ln((('0x' || substr(md5('0:' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint + 0.5::double) / 4503599627370496.0::double)
      / greatest(0.1::double, 1.0::double - noise / greatest(size, 1)) as key from d),
s0 as (select no_source, source, sum(size)::bigint as source_size from k group by all),
s1 as (select *, (row_number() over (order by no_source, source) - 1) % 3 + 1 as weight, 3 * source_size as cap from s0),
s2 as (select *, row_number() over (order by cap::double / weight, no_source, source) as rank from s1),
s3 as (select *, (sum(source_size) over () - coalesce(sum(cap) over (order by rank rows between unbounded preceding and 1 preceding), 0))::double
    / (sum(weight) over (order by rank rows between current row and unbounded following))::double as level from s2),
s4 as (select *, cap <= level * weight as capped from s3),
s5 as (select no_source, source, source_size, case when capped then cap::double else
    (select level from s4 where not capped order by rank limit 1) * weight end as target from s4),
r as (select k.*, s5.source_size, s5.target, round(target)::bigint as budget,
    (coalesce(sum(size) over (partition by no_source, source order by key, doc_id, size
      rows between unbounded preceding and 1 preceding), 0))::bigint as before
    from k join s5 using (no_source, source)),
e as (select *, case when source_size > 0 then budget // source_size else 0 end as epochs from r)
select doc_id, size, source_size, target, epochs::bigint as epochs,
  (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::bigint as taken from e
"""
