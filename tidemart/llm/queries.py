"""The registered queries of this subpackage: one thin ``opN_<name>`` each.

Each query reads its whole table, calls its operator and derives the digest
columns of the query's contract from the operator's real outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import common, convtrie, decontam, htmlblocks, orderminhash, planes, rabitq, ranked, substring, suffixes, toxicity, trie_bpe, urlfilter, warc


def op1_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planes.read(planes.write(common.table(spark, sf_dir, "documents"), common.scratch(spark, "token-planes")))


def op2_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(common.table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op3_rabitq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rabitq.near_duplicates(common.table(spark, sf_dir, "embeddings"))


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderminhash.near_duplicates(common.table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.write(common.table(spark, sf_dir, "pages"), common.scratch(spark, "warc"))).drop("url", "payload")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.contamination(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op8_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = trie_bpe.encode_decode(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmlblocks.extract(common.table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    out = toxicity.score(docs, model)
    return out.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op11_induced_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.remove_repeats(common.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convtrie.trie(common.table(spark, sf_dir, "conversations"))


def op13_range_maximum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(ranked.build(common.table(spark, sf_dir, "documents")), common.table(spark, sf_dir, "benchmark"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_planes": op1_token_planes,
        "op2_url_vocabulary": op2_url_vocabulary,
        "op3_rabitq": op3_rabitq,
        "op4_order_minhash": op4_order_minhash,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_warc_dictionary": op6_warc_dictionary,
        "op7_decontamination": op7_decontamination,
        "op8_trie_bpe": op8_trie_bpe,
        "op9_text_blocks": op9_text_blocks,
        "op10_toxicity": op10_toxicity,
        "op11_induced_suffixes": op11_induced_suffixes,
        "op12_conversation_trie": op12_conversation_trie,
        "op13_range_maximum": op13_range_maximum,
    }


#: Distinct windows of items are joined with all windows of the documents.
OP7_SQL = r"""
with letters as (select 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' as up, 'abcdefghijklmnopqrstuvwxyz' as low),
d as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents, letters),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark, letters),
phrases as (
  select distinct item_id, least(10, len(w)) as n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as p
  from (select item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) as i from b where len(w) > 0)),
sizes as (select distinct n from phrases),
runs as (
  select r, n, i, array_to_string(w[i : i + n - 1], ' ') as p
  from (select r, w, n, unnest(generate_series(1, len(w) - n + 1)) as i from d, sizes where len(w) >= n)),
hits as (select r, item_id, runs.n, i from runs join phrases on runs.p = phrases.p and runs.n = phrases.n),
words as (select r, count(distinct k) as n_hit from (select r, unnest(generate_series(i, i + n - 1)) as k from hits) group by r),
items as (select r, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct r, cast(item_id as varchar) as id from hits where item_id is not null) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (r) left join items using (r)
"""


def op2_sql() -> str:
    """Rules and terms as tables; a term counts between characters that are no ASCII letter or digit."""
    rules = ", ".join(f"('{r.host}', '{r.path}', '{r.verdict}')" for r in urlfilter.RULES)
    terms = ", ".join(f"('{t}', {str(t in urlfilter.STRICT).lower()})" for t in dict.fromkeys(urlfilter.STRICT + urlfilter.SOFT))
    return rf"""
with rules(h, p, v) as (values {rules}), terms(t, strict) as (values {terms}),
u as (
  select row_number() over () as r, page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low,
    case when contains(url, '://') then regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*') else '' end as rest
  from pages),
parts as (
  select r, page_id, low, translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    substr(rest, length(split_part(rest, '/', 1)) + 1) as path
  from u),
fits as (
  select r, arg_max(h || p, length(h || p)) as rule, arg_max(v, length(h || p)) as v
  from parts join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by r),
hits as (
  select r, count(*) filter (where strict) as s, count(*) filter (where not strict) as w
  from parts join terms on regexp_matches(low, '(^|[^a-z0-9])' || t || '([^a-z0-9]|$)') group by r)
select page_id, host, path, rule, coalesce(v, case when s >= 1 or w >= {urlfilter.SOFT_MIN} then 'block' else 'allow' end) as verdict,
  cast(coalesce(s, 0) as integer) as n_strict, cast(coalesce(w, 0) as integer) as n_soft
from parts left join fits using (r) left join hits using (r)
"""


#: Base 32 of SHA-1: 160 bits, five to a letter.
OP6_SQL = """
with p as (
  select page_id, coalesce(html, '') as html,
    array_to_string([lpad(bin(instr('0123456789abcdef', c) - 1), 4, '0') for c in string_split(sha1(coalesce(html, '')), '')], '') as bits
  from pages),
g as (
  select page_id, html, max(page_id) over w as top, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum([cast(substr(bits, 5 * i + k, 1) as integer) * (1 << (5 - k)) for k in [1, 2, 3, 4, 5]])::integer, 1) for i in range(32)], '') as b32
  from p window w as (partition by html))
select page_id, cast(octet_length(encode(html)) as bigint) as payload_bytes, b32 as payload_digest,
  case when top is null or page_id = top then 'response' else 'revisit' end as record_type,
  case when page_id is distinct from top then top end as refers_to
from g
"""


#: Turns are named by their digests; crc32 takes a byte, then eight shifts.
OP12_SQL = r"""
with t as (
  select conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as k,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as words
  from conversations where conv_id is not null),
dictionary as (select k, row_number() over (order by k) as id, any_value(words) as words from t group by k),
own as (select conv_id, list(id order by turn nulls first, k) as s from t join dictionary using (k) group by conv_id),
crc as (
  select conv_id, s, xor(4294967295, list_reduce(flatten([[4294967295], flatten([[ascii(x), -1, -1, -1, -1, -1, -1, -1, -1] for x in string_split(cast(conv_id as varchar), '')])]),
    lambda a, b: case when b >= 0 then xor(a, b) else xor(a >> 1, 3988292384 * (a & 1)) end)) % 4 as h
  from own),
built as (select c.conv_id, list_concat(coalesce(d.s[1 : h], []), c.s[h + 1 :]) as s from crc c left join own d on d.conv_id = c.conv_id - c.conv_id % 20),
paths as (select conv_id, d, s[1 : d] as p, len(s) = d as ends from (select conv_id, s, unnest(generate_series(0, len(s))) as d from built)),
nodes as (
  select p, any_value(d) as d, min(conv_id) as low, count(*) as n, coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (ends), '') as ids
  from paths group by p),
children as (select p[1 : d - 1] as p, count(*) as n_children from nodes where d > 0 group by all),
full_nodes as (
  select nodes.*, coalesce(n_children, 0) as n_children, case when d > 0 then (n - 1) * words else 0 end as saved
  from nodes left join children using (p) left join dictionary on id = p[d]),
sums as (
  select p[1 : a] as p, sum((n_children = 0)::int) as n_leaves, sum(saved) as saved
  from (select p, n_children, saved, unnest(generate_series(0, d)) as a from full_nodes) group by all)
select f.low as conv_id, f.d as depth, u.low as parent_conv_id, f.n as n_convs, f.n_children as n_children, cast(n_leaves as bigint) as n_leaves,
  cast(sums.saved as bigint) as saved_tokens, sha256(f.ids) as ends_sha256
from full_nodes f join sums using (p) left join nodes u on f.d > 0 and u.p = f.p[1 : f.d - 1]
"""


OP13_SQL = r"""
with letters as (select 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' as up, 'abcdefghijklmnopqrstuvwxyz' as low),
d as (select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents, letters),
i as (select row_number() over () as i, item_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from (select distinct item_id, text from benchmark), letters),
corpus as (select count(*) as n, sum(len(w)) as l from d where len(w) > 0),
tf as (select r, term, count(*) as tf from (select r, unnest(w) as term from d) group by r, term),
weights as (select term, cast(floor(1000 * ln(cast(2 * any_value(n) + 2 as double) / cast(2 * count(*) + 1 as double))) as bigint) as w from tf, corpus group by term),
norms as (select r, doc_id, 10 + cast((90 * len(d.w) * n) // l as bigint) as m from d, corpus),
asked as (select distinct i, item_id, term from (select i, item_id, unnest(w) as term from i)),
scores as (
  select i, any_value(item_id) as item_id, r, any_value(doc_id) as doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
  from asked join tf using (term) join weights using (term) join norms using (r) group by i, r),
ranked as (select item_id, cast(row_number() over (partition by i order by score desc, doc_id nulls last) as integer) as rank, doc_id, score from scores where score > 0)
select * from ranked where rank <= 10
"""


def all_sql() -> dict[str, str]:
    return {"op2_url_vocabulary": op2_sql(), "op6_warc_dictionary": OP6_SQL, "op7_decontamination": OP7_SQL, "op12_conversation_trie": OP12_SQL, "op13_range_maximum": OP13_SQL}
