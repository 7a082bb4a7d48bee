"""The registered queries of the operators, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from docketry.llm import contain, lexical, negatives, pstable, quality, recompress, secrets, sharding, simhash, suffixes, token_counts, tokens, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

SHARDS = [f"shard-{i:02d}" for i in range(64)]
SLOTS = 6_553
COUNTED = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the labels whose document's number leaves a remainder."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    scored = quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, by its number."""
    return sharding.place(table(spark, sf_dir, "documents"), "doc_id", SHARDS, SLOTS)


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_earlier_bytes(table(spark, sf_dir, "documents"), 50, texts=False)


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encoded_and_decoded(table(spark, sf_dir, "documents"), RANKS, PATTERN, ids=False)


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select("doc_id", "fingerprint", "component_id")


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expected grade of every document; the labels have two grades."""
    return toxicity.graded(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.found_secrets(table(spark, sf_dir, "documents"), RANKS, PATTERN, mask=None)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans")


@query
def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pstable.near_vectors(table(spark, sf_dir, "embeddings"), 0.9)


@query
def op9_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.without_earlier_words(table(spark, sf_dir, "documents"), 20, texts=False)


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it holds."""
    return contain.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), Path(COUNTED).read_text())


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth vector against all; labels of every seventh are moved on by one."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved), lambda vec_id: vec_id % 100 == 0)


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 50 of all documents for each benchmark item."""
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 50)


# ---- the same in SQL, by comparing everything with everything

SQL["op2_sharding"] = f"""
with recursive p as (select s, ('0x' || substr(md5(name || '/offset'), 1, 15))::bigint % {SLOTS} as first_slot, ('0x' || substr(md5(name || '/skip'), 1, 15))::bigint % {SLOTS - 1} + 1 as skip
  from (select i as s, 'shard-' || lpad(i::varchar, 2, '0') as name from range({len(SHARDS)}) t(i))),
fill(turn, slot, taken) as (
  select -1::bigint, -1::bigint, bitstring('0', {SLOTS}) union all
  select turn + 1, x, set_bit(taken, x::int, 1) from (
    select turn, taken, (first_slot + list_filter(range({SLOTS}), lambda j: get_bit(taken, ((first_slot + j * skip) % {SLOTS})::int) = 0)[1] * skip) % {SLOTS} as x
    from fill join p on s = (turn + 1) % {len(SHARDS)} where turn < {SLOTS - 1}))
select doc_id, slot::int as slot, (turn % {len(SHARDS)})::int as shard, 'shard-' || lpad((turn % {len(SHARDS)})::varchar, 2, '0') as shard_name
from (select doc_id, ('0x' || substr(md5(doc_id::varchar), 1, 15))::bigint % {SLOTS} as slot from documents) join (select turn, slot from fill where turn >= 0) using (slot)
"""

SQL["op3_suffix_dedup"] = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, '')))::bigint as n from documents),
w as (select doc_id, i, substr(h, 2 * i + 1, 100) as s from (select doc_id, h, unnest(range(0, n - 49)) as i from d)),
bad as (select doc_id, i from (select doc_id, i, min(doc_id) over (partition by s) as earliest from w) where earliest < doc_id),
marked as (select *, case when i <= lag(i) over (partition by doc_id order by i) + 50 then 0 else 1 end as opens from bad),
spans as (select doc_id, min(i) as a, max(i) + 50 as z from (select *, sum(opens) over (partition by doc_id order by i) as g from marked) group by doc_id, g),
listed as (select doc_id, list(a order by a) as a, list(z order by a) as z, sum(z - a)::bigint as removed, count(*) as many from spans group by 1)
select doc_id, n as n_bytes, coalesce(removed, 0) as n_removed, coalesce(many, 0) as n_spans,
  sha256(unhex(case when many is null then h else substr(h, 1, 2 * a[1]) ||
    array_to_string(list_transform(range(1, many + 1), lambda k: substr(h, 2 * z[k] + 1, 2 * (coalesce(a[k + 1], n) - z[k]))), '') end)) as kept_sha256
from d left join listed using (doc_id)
"""

_WORDS = r"list_filter(regexp_split_to_array(coalesce({}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

SQL["op9_recompression"] = f"""
with d as (select doc_id, {_WORDS.format("text")} as ws from documents),
w as (select doc_id, i, ws[i : i + 19] as s from (select doc_id, ws, unnest(range(1, len(ws) - 18)) as i from d)),
bad as (select doc_id, i from (select doc_id, i, row_number() over (partition by s order by doc_id, i) as r from w) where r > 1),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as i from bad),
per as (select doc_id, list(i) as places, count(*) as n from gone group by 1)
select doc_id, len(ws)::bigint as n_words, coalesce(n, 0) as n_removed,
  sha256(array_to_string(case when n is null then ws else list_transform(list_filter(range(1, len(ws) + 1), lambda k: not list_contains(places, k)), lambda k: ws[k]) end, ' ')) as kept_sha256
from d left join per using (doc_id)
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op10_decontamination"] = f"""
with grams as (select distinct doc_id, array_to_string(ws[i : i + 4], ' ') as g from (
    select doc_id, ws, unnest(range(1, len(ws) - 3)) as i from (select doc_id, {_WORDS.format(_LOWER.format("text"))} as ws from documents))),
items as (select distinct item_id, array_to_string(ws[i : i + 4], ' ') as g from (
    select item_id, ws, unnest(range(1, len(ws) - 3)) as i from (select item_id, {_WORDS.format(_LOWER.format("text"))} as ws from benchmark))),
size as (select item_id, count(*) as n from items group by 1)
select doc_id, item_id, n as n_shingles, count(*) as n_shared, count(*)::double / n as containment
from grams join items using (g) join size using (item_id) group by doc_id, item_id, n having count(*) >= 0.8::double * n
"""

SQL["op8_embeddings"] = """
with recursive pairs as (select a.vec_id as x, b.vec_id as y from embeddings a join embeddings b on a.vec_id <> b.vec_id
  and list_cosine_similarity(a.embedding::double[], b.embedding::double[]) >= 0.9),
reach as (select vec_id as x, vec_id as y from embeddings union select r.x, p.y from reach r join pairs p on p.x = r.y),
least as (select x as vec_id, min(y) as component_id from reach group by 1)
select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept
from least left join (select x as vec_id, count(*) as n from pairs group by 1) using (vec_id)
"""

SQL["op12_hard_negatives"] = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as x
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, list_inner_product(a.x, b.x)::bigint as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
positives as (select anchor_id, id as positive_id, score as positive_score from pairs where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
found as (select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, id)::int as rank, id as negative_id, positive_score, score as negative_score
  from positives join pairs using (anchor_id) where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score)
select * from found where rank <= 5
"""

_TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SQL["op13_ranked_search"] = f"""
with d as (select doc_id, {_TERMS.format(_LOWER.format("text"))} as ts from documents),
sizes as (select doc_id, len(ts)::bigint as n from d where len(ts) > 0),
whole as (select count(*)::bigint as docs, sum(n)::bigint as total from sizes),
tfs as (select doc_id, t, count(*)::bigint as tf from (select doc_id, unnest(ts) as t from d) group by all),
items as (select distinct item_id, t from (select item_id, unnest({_TERMS.format(_LOWER.format("text"))}) as t from benchmark)),
weights as (select t, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as w from (select t, count(*)::bigint as df from tfs group by t), whole),
scores as (select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total))))::bigint as score
  from items join weights using (t) join tfs using (t) join sizes using (doc_id), whole group by item_id, doc_id)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score from scores where score > 0
qualify rank <= 50
"""
