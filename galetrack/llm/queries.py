"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galetrack.llm import ann, bpe, conversations, language, lexical, licenses, mixing, omh, ppm, simhash, suffixes, toxicity, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    import public_tokenizers

    return language.predict(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_omh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near duplicates of every document."""
    return omh.classes(table(spark, sf_dir, "documents"))


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    return toxicity.predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, its edited text's, both likenesses, and the near fingerprints of every hundredth."""
    return simhash.compare_with_next(table(spark, sf_dir, "documents"), queries=F.col("doc_id") % 100 == 0)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.digest(table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The license notices that every document holds."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record, read back and put in capture order: the records' own fields."""
    found = warc.archive(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log-probability of every document."""
    return ppm.score_documents(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the word-level vocabulary."""
    import public_tokenizers

    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return conversations.trie(conversations.rebuilt(table(spark, sf_dir, "conversations")))


def op12_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document without byte strings that start earlier."""
    return suffixes.digests(table(spark, sf_dir, "documents"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents that score highest for each benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_language": op1_language,
    "op2_omh": op2_omh,
    "op3_ann": op3_ann,
    "op4_toxicity": op4_toxicity,
    "op5_simhash": op5_simhash,
    "op6_mixing": op6_mixing,
    "op7_licenses": op7_licenses,
    "op8_warc": op8_warc,
    "op9_ppm": op9_ppm,
    "op10_bpe": op10_bpe,
    "op11_conversations": op11_conversations,
    "op12_suffixes": op12_suffixes,
    "op13_lexical": op13_lexical,
}

#: Base32 of a SHA-1: its 160 bits, five at a time.
_BITS = "cast(cast(unhex(sha1(html)) as bit) as varchar)"
_FIVE = " + ".join(f"{1 << (4 - k)} * cast(substr(bits, cast(5 * i + {k + 1} as int), 1) as int)" for k in range(5))
#: crc32 of a decimal id, bit by bit: 3988292384 is the reversed polynomial.
_STEP = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))"
_CRC = f"xor(4294967295, list_reduce([cast(4294967295 as bigint)] || list_transform(string_split(cast(conv_id as varchar), ''), lambda x: cast(ascii(x) as bigint)), lambda c, b: {_STEP}))"
#: A trie node is the list of its turns' digests, joined.
_KEY = "array_to_string(r[1:d], ',')"
_TRIE = f"""
with turns as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, role, text) as p, role, text,
               sha256(octet_length(encode(role)) || ':' || role || text) as k
               from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)),
every as (select conv_id, {_CRC} % 9 as h, conv_id - conv_id % 5 as base from (select distinct conv_id from turns)),
parts as (select every.conv_id, p, k, text from every join turns on turns.conv_id = base and p <= h
          union all select every.conv_id, p + 8, k, text from every join turns on turns.conv_id = every.conv_id and p > h),
talks as (select conv_id, coalesce(r, []) as r, coalesce(z, []) as z, len(coalesce(r, [])) as n from every left join
          (select conv_id, list(k order by p) as r, list(octet_length(encode(text)) order by p) as z from parts group by conv_id) using (conv_id)),
prefixes as (select conv_id, n, d, {_KEY} as node, array_to_string(r[1:d-1], ',') as above, z[d] as size, r from (select *, unnest(range(n + 1)) as d from talks)),
nodes as (select d, node, min(conv_id) as conv_id, count(*) as n_convs, any_value(above) as above, any_value(size) as size, any_value(r[1:d]) as r,
          sha256(coalesce(string_agg(conv_id, ',' order by conv_id) filter (n = d), '')) as ends_sha256 from prefixes group by d, node),
below as (select d, above as node, count(*) as n_children from nodes where d > 0 group by d, above),
whole as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join below on below.d = nodes.d + 1 and below.node = nodes.node),
up as (select a as d, array_to_string(r[1:a], ',') as node, sum((n_convs - 1) * coalesce(size, 0)) as saved_tokens, count(*) filter (n_children = 0) as n_leaves
       from (select *, unnest(range(d + 1)) as a from whole) group by 1, 2)
select w.conv_id, cast(w.d as bigint) as depth, p.conv_id as parent_conv_id, w.n_convs, w.n_children, up.n_leaves, cast(up.saved_tokens as bigint) as saved_tokens, w.ends_sha256
from whole w join up on up.d = w.d and up.node = w.node left join whole p on p.d = w.d - 1 and p.node = w.above
"""
_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_SEARCH = f"""
with docs as (select doc_id, row_number() over () as row, {_TERMS} as ts from documents),
total as (select count(*) filter (len(ts) > 0) as n, cast(sum(len(ts)) as bigint) as l from docs),
counts as (select row, t, count(*) as tf from (select row, unnest(ts) as t from docs) group by row, t),
asked as (select item, item_id, t, count(*) as qtf from (select row_number() over () as item, item_id, unnest({_TERMS}) as t from benchmark) group by item, item_id, t),
weights as (select t, cast(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) as bigint) as w from (select t, count(*) as df from counts group by t), total),
scores as (select item, item_id, row, cast(sum(w * qtf * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(ts) * n) // l)))) as bigint) as score
           from asked join weights using (t) join counts using (t) join docs using (row), total group by item, item_id, row),
ranked as (select item_id, row_number() over (partition by item order by score desc, doc_id nulls first) as rank, doc_id, score from scores join docs using (row) where score > 0)
select item_id, cast(rank as int) as rank, doc_id, score from ranked where rank <= 20
"""
ORACLE: dict[str, str] = {
    "op11_conversations": _TRIE,
    "op13_lexical": _SEARCH,
    "op8_warc": (
        "select page_id, payload_bytes, list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
        f"cast(1 + {_FIVE} as int), 1)), 'string_agg', '') as payload_digest,"
        " case when page_id = latest then 'response' else 'revisit' end as record_type, case when page_id <> latest then latest end as refers_to"
        f" from (select page_id, cast(octet_length(encode(html)) as bigint) as payload_bytes, {_BITS} as bits, max(page_id) over (partition by html) as latest"
        " from (select page_id, coalesce(html, '') as html from pages))"
    ),
}
