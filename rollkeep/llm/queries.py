"""The registered queries of this subpackage, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeep.llm import bpe, embedding_dedup, exact_dedup, language_id, license_scan, line_dedup, merkle, packing, periodic_runs, sharding, simhash, toxicity, url_filter
from rollkeep.llm.common import ascii_lower, table


def vocabulary(name: str) -> str:
    """The file of a public tokenizer, as installed on this machine and on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document; null texts count as empty."""
    import public_tokenizers

    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; und where the text is null or has no letter."""
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs.select("doc_id", "text"), language_id.train(docs)).drop("text")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector; vectors that cannot be compared link with nothing."""
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of lines by fate and the dropped line numbers of every document."""
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset; null texts count as empty."""
    pieces = packing.cut(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")).drop("ids")
    return packing.pack(pieces)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every document; null texts count as empty."""
    return exact_dedup.copies(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, empty ones too."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels"))).drop("text")


#: The rules of the query.
URL_RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule and verdict of every page; null urls have an empty host and path."""
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.rules_table(spark, URL_RULES))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint and component_id of every document; texts without a word have fingerprint zero."""
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the number of notices, their licenses as a sorted list, and the places of the first one; every document."""
    found = license_scan.find_notices(table(spark, sf_dir, "documents"))
    first = F.try_element_at("notices", F.lit(1))
    names = F.array_join(F.array_sort(F.array_distinct(F.transform("notices", lambda x: x.license))), ",")
    return found.select("doc_id", F.size("notices").alias("n_notices"), names.alias("licenses"), first.begin.alias("first_begin"), first.end.alias("first_end"))


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the texts, by CRC-32 of doc_id, repeat from some word on with some period."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    a = F.col("g") % F.size("words")
    p = 1 + F.floor((F.size("words") - a) / (3 + F.col("g") % 8))
    moved = F.transform("words", lambda w, i: F.when(i < a, w).otherwise(F.get("words", (a + (i - a) % p).cast("int"))))
    return rows.select("doc_id", F.when(F.size("words") > 0, F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_runs, the longest run and digests of all runs and of the collapsed text of every document."""
    found = periodic_runs.find_runs(planted(table(spark, sf_dir, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("less"), r.start.alias("start"), r.period.alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r.start, F.lit(","), r.length, F.lit(","), r.period, F.lit("\n"))), "")
    out = found.withColumns({"x": longest, "length": -longest.less})
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("x.start").alias("start"), "length", F.col("x.period").alias("period"),
        F.floor(F.col("length") * 1000 / F.col("x.period")).alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every document; a fifth of them, by CRC-32 of doc_id, is tampered with."""
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    lower = F.when(F.col("text").isNotNull(), ascii_lower(F.col("text")))
    found = merkle.proofs(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], "source", "doc_id", ("text", lower, tampered))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2("others", 256).alias("proof_sha256"), "folded_root", "verified")


#: Fixed value: the number of shards of the query.
SHARDS = 24


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document; the counts of shards are at most one apart."""
    found = sharding.shuffled(table(spark, sf_dir, "documents"), SHARDS)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bpe": op1_bpe,
        "op2_language_id": op2_language_id,
        "op3_embedding_dedup": op3_embedding_dedup,
        "op4_line_dedup": op4_line_dedup,
        "op5_packing": op5_packing,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_toxicity": op7_toxicity,
        "op8_url_filter": op8_url_filter,
        "op9_simhash": op9_simhash,
        "op10_license_scan": op10_license_scan,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_merkle": op12_merkle,
        "op13_sharding": op13_sharding,
    }


EXACT_SQL = """
with d as (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as text_sha256 from documents)
select doc_id, max(doc_id) over (partition by text_sha256) as keep_id, count(*) over (partition by text_sha256) as group_size,
       doc_id = max(doc_id) over (partition by text_sha256) as kept, text_sha256
from d"""

URL_SQL = """
with p as (
  select page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
r(rhost, rpath, v) as (values {rules})
select page_id, host, path, best.rule as rule, coalesce(best.verdict, 'allow') as verdict from (
  select page_id, host, path, max(case when rhost is not null then struct_pack(n := length(rhost || rpath), rule := rhost || rpath, verdict := v) end) as best
  from p left join r on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
  group by page_id, host, path)""".format(rules=", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES))


def crc32_sql(codes: str) -> str:
    """The unsigned CRC-32 of a list of byte values."""
    return f"xor(list_reduce([4294967295::bigint] || {codes}, lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"


def part_sql(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::varchar)) || ':' || {value}::varchar, '-')"


MERKLE_SQL = """
with recursive hashed as (
  select doc_id, source, sha256({parts} || {text}) as leaf, case when {crc} % 5 = 0 then sha256({parts} || {lower}) end as other from documents),
leaf as (
  select *, dense_rank() over (order by source nulls first) - 1 as tree, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as place, count(*) over (partition by source) as n
  from hashed),
nodes(tree, level, place, digest, n) as (
  select tree, 0, place, leaf, n from leaf
  union all select tree, level + 1, place // 16, sha256(string_agg(digest, '' order by place)), (n + 15) // 16 from nodes where n > 1 group by tree, level, place // 16, n),
tops(level, place, digest, n) as (
  select 0, tree, digest, count(*) over () from nodes where n = 1
  union all select level + 1, place // 16, sha256(string_agg(digest, '' order by place)), (n + 15) // 16 from tops where n > 1 group by level, place // 16, n),
met as (
  select l.tree, l.place, 0 as above, k.level, k.place as spot, l.place >> 4 * k.level as own, k.digest
  from leaf l join nodes k on k.tree = l.tree and k.n > 1 and k.place // 16 = l.place >> 4 * k.level + 4
  union all select l.tree, l.place, 1, k.level, k.place, l.tree >> 4 * k.level, k.digest from leaf l join tops k on k.n > 1 and k.place // 16 = l.tree >> 4 * k.level + 4),
steps as (
  select tree, place, above, level, coalesce(string_agg(digest, '' order by spot) filter (spot < own), '') as before, coalesce(string_agg(digest, '' order by spot) filter (spot > own), '') as after
  from met group by tree, place, above, level),
paths as (select tree, place, string_agg(before || after, '' order by above, level) as others, list(before || '|' || after order by above, level) as path from steps group by tree, place),
found as (
  select doc_id, leaf, s.digest as subroot, r.digest as root, sha256(coalesce(others, '')) as proof_sha256,
         list_reduce([coalesce(other, leaf)] || coalesce(path, []), lambda now, s: sha256(split_part(s, '|', 1) || now || split_part(s, '|', 2))) as folded_root
  from leaf l left join paths p using (tree, place) join nodes s on s.tree = l.tree and s.n = 1, tops r where r.n = 1)
select *, folded_root = root as verified from found""".format(
    parts=" || ".join(map(part_sql, ("doc_id", "source", "lang", "n_chars"))), text=part_sql("text"), lower=part_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"), crc=crc32_sql("list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c))")
)

SHARD_SQL = """
with recursive sized as (select doc_id, coalesce(text, '') as text, octet_length(encode(coalesce(text, ''))) + 8 as size from documents),
t as (select list(c order by i) as t from (select i, list_reduce([i::bigint, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: xor(x >> 1, 3988292384 * (x & 1))) as c from range(256) r(i))),
summed as (
  select doc_id, size, xor(list_reduce([4294967295::bigint] || list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::bigint), lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8)), 4294967295) as text_crc32
  from sized, t),
placed as (select *, row_number() over (order by doc_id nulls first, size, text_crc32) - 1 as place, count(*) over () as n, greatest(1, (length(bin(greatest(count(*) over () - 1, 1))) + 1) // 2) as bits from summed),
walk as (
  select doc_id, size, text_crc32, n, bits, place as x, false as moved from placed
  union all
  select doc_id, size, text_crc32, n, bits,
         list_reduce([x] || {keys}, lambda s, k: ((s % (1 << bits)) << bits) | xor(s >> bits, list_transform([list_transform([(s % (1 << bits) + k) % 4294967296], lambda u: (u::hugeint * {a} % 4294967296)::bigint)[1]],
           lambda u: list_transform([(xor(u, u >> 15)::hugeint * {b} % 4294967296)::bigint], lambda v: xor(v, v >> 13) % (1 << bits))[1])[1])), true
  from walk where not moved or x >= n)
select doc_id, size, text_crc32, 'rows' as law, (x % {shards})::int as shard, x // {shards} as slot, null::int as grown_shard from walk where moved and x < n""".format(
    keys=[*sharding.round_keys(0)], a=sharding.MIX[1], b=sharding.MIX[2], shards=SHARDS
)


def oracle_sql() -> dict[str, str]:
    return {"op6_exact_dedup": EXACT_SQL, "op8_url_filter": URL_SQL, "op12_merkle": MERKLE_SQL, "op13_sharding": SHARD_SQL}
