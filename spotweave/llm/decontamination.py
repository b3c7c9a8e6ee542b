"""Benchmark decontamination: size-partitioned MinHash containment search, then exact shingles.

Test items are short and documents long, so Jaccard similarity says nothing; containment of
the item's shingles in the document's does. Items are partitioned by size class. A class
whose largest item has u shingles keeps, of each item, the ``floor((1 - t) * u) + extra``
smallest hash values (its MinHash sketch). An item of n shingles contained to t or more
lacks at most ``n - ceil(t * n)`` of them, so at least sketch size minus that many sketch
values are hashes of the document: fewer hits rule a pair out, and no pair is lost. What
remains is verified on the shingles themselves.

The items are the stated query set: they go to the tasks in blocks of bounded size, and
each block is one pass over the documents without a shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from spotweave.llm.common import alnum, map_batches, packed, pick, raw, shingle_hashes, unpacked

SHINGLE, THRESHOLD = 5, 0.8
BLOCK_ITEMS, BLOCK_BYTES = 5000, 16 << 20
EXTRA = 4
_FILTER_BITS = 20
SCHEMA = "doc_id long, item_id long, n_shingles long, n_hits long, containment double"
_ARROW = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_shingles", pa.int64()), ("n_hits", pa.int64()),
                    ("containment", pa.float64())])


def shingles(joined: bytes, size: int) -> set[bytes]:
    words = joined.split(b" ") if joined else []
    return {b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


@dataclass
class Block:
    """Items of one block: their shingles, and by shingle length the sketch values with the items they belong to."""

    ids: list
    grams: list[set[bytes]]
    hashes: list[np.ndarray]
    needed: list[int]  # sketch hits without which the item can't be contained
    by_size: dict[int, tuple[np.ndarray, np.ndarray, list[np.ndarray]]]  # size: filter, values, items of each value


def build(items: list[tuple[int, bytes]], size: int, threshold: float, extra: int = EXTRA) -> Block:
    ids, grams, hashes, sizes = [], [], [], []
    for item_id, text in items:
        joined = alnum(text)
        if own := shingles(joined, size):
            ids.append(item_id)
            grams.append(own)
            sizes.append(min(size, joined.count(b" ") + 1))
            hashes.append(np.unique(shingle_hashes(joined, size)[0]))
    classes: dict[int, int] = {}
    for g in grams:
        c = len(g).bit_length()
        classes[c] = max(classes.get(c, 0), len(g))
    needed, values = [], {}
    for i, (g, h) in enumerate(zip(grams, hashes)):
        width = math.floor((1 - threshold) * classes[len(g).bit_length()] + 1e-9) + extra
        sketch = h[:width]  # ascending: the smallest hash values
        needed.append(len(sketch) - (len(g) - math.ceil(threshold * len(g) - 1e-9)))
        for x in sketch.tolist():
            values.setdefault(sizes[i], {}).setdefault(x, []).append(i)
    by_size = {}
    for k, found in values.items():
        keys = np.array(sorted(found), np.uint64)
        bits = np.zeros(1 << _FILTER_BITS, bool)
        bits[(keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        by_size[k] = (bits, keys, [np.array(found[x]) for x in keys.tolist()])
    return Block(ids, grams, hashes, needed, by_size)


def search(block: Block, text: bytes, threshold: float) -> list[tuple[int, int, int]]:
    """(item, its shingles, those the document holds) of every contained item."""
    joined = alnum(text)
    out = []
    for size, (bits, keys, owners) in block.by_size.items():
        h, starts, ends = shingle_hashes(joined, size)
        some = np.unique(h[bits[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]])
        at = np.searchsorted(keys, some)
        hit = at[(at < len(keys))]
        hit = hit[keys[hit] == some[:len(at)][at < len(keys)]]
        if not len(hit):
            continue
        items, counts = np.unique(np.concatenate([owners[x] for x in hit.tolist()]), return_counts=True)
        for i, n in zip(items.tolist(), counts.tolist()):
            if n >= block.needed[i]:
                places = np.flatnonzero(np.isin(h, block.hashes[i]))
                held = {joined[a:b] for a, b in zip(starts[places].tolist(), ends[places].tolist())} & block.grams[i]
                if len(held) >= threshold * len(block.grams[i]) - 1e-9:
                    out.append((i, len(block.grams[i]), len(held)))
    return out


def item_blocks(benchmark: DataFrame, block_items: int, block_bytes: int) -> list[DataFrame]:
    """The query set in blocks of about so many items and bytes at most, by hash of the row."""
    items = pick(benchmark, item_id="long", text="string").filter("text is not null")
    n, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, math.ceil(n / block_items), math.ceil(size / block_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    return [items.filter(part == b) for b in range(blocks)] if n else []


def contained_items(documents: DataFrame, benchmark: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD,
                    block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document row and contained item row.

    Words are lower-case letters and digits; shingles are of five words, fewer words being one
    shingle. Null and empty documents hold nothing, null and empty items are in nothing; null
    ids stay null; repeated rows count each; other columns are ignored; without items or
    documents there are no rows. Texts are read whole.
    """
    docs = pick(documents, doc_id="long", text="string")
    out = None
    for part in item_blocks(benchmark, block_items, block_bytes):
        rows = [(r["item_id"], r["text"].encode()) for r in part.collect()]
        shared = docs.sparkSession.sparkContext.broadcast(build(rows, size, threshold))

        def run(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            block, ids, found = shared.value, batch.column("doc_id").to_pylist(), []
            for doc_id, text in zip(ids, raw(batch, "text")):
                found += [{"doc_id": doc_id, "item_id": block.ids[i], "n_shingles": n, "n_hits": k, "containment": k / n}
                          for i, n, k in search(block, text, threshold)]
            return pa.RecordBatch.from_pylist(found, schema=_ARROW)

        hits = map_batches(docs, run, SCHEMA)
        out = hits if out is None else out.unionByName(hits)
    return docs.sparkSession.createDataFrame([], SCHEMA) if out is None else out


def _clean(shared: Broadcast, threshold: float):
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: not search(shared.value, (t or "").encode(), threshold)).astype(bool)

    return F.pandas_udf(clean, "boolean")


def decontaminated(documents: DataFrame, benchmark: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD,
                   block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The document rows that contain no item, all columns kept. Odd cases as in ``contained_items``."""
    left = documents
    for part in item_blocks(benchmark, block_items, block_bytes):
        rows = [(r["item_id"], r["text"].encode()) for r in part.collect()]
        shared = documents.sparkSession.sparkContext.broadcast(build(rows, size, threshold))

        held = packed(left, text="string")
        left = unpacked(held.filter(_clean(shared, threshold)("text")), documents)
    return left


_AZ = "abcdefghijklmnopqrstuvwxyz"
SQL = rf"""
with words as (select 'd' as kind, doc_id as id, row_number() over () as row_id, regexp_extract_all(translate(text, '{_AZ.upper()}', '{_AZ}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
  union all select 'i', item_id, row_number() over (), regexp_extract_all(translate(text, '{_AZ.upper()}', '{_AZ}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark),
grams as (select distinct kind, id, row_id, least(len(w), 5) as k, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') as g
  from (select *, unnest(range(1, greatest(len(w) - 3, 2))) as i from words where len(w) > 0)),
-- A document is also cut into the shorter lengths that items of under five words have.
short as (select distinct k from grams where kind = 'i' and k < 5),
more as (select distinct kind, id, row_id, k, array_to_string(w[i:i + k - 1], ' ') as g from
  (select kind, id, row_id, w, k, unnest(range(1, len(w) - k + 2)) as i from words, short where kind = 'd' and len(w) >= k)),
docs as (select id, row_id, k, g from grams where kind = 'd' and k = 5 union select id, row_id, k, g from more),
items as (select *, count(*) over (partition by row_id) as n from grams where kind = 'i')
select d.id as doc_id, i.id as item_id, i.n::bigint as n_shingles, count(*)::bigint as n_hits, count(*)::double / i.n as containment
from docs d join items i using (k, g) group by d.id, d.row_id, i.id, i.row_id, i.n having count(*) >= 0.8 * i.n - 1e-9
"""
