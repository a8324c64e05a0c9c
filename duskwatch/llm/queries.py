"""The operators over the given tables, one query each, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.llm.alignment import NUMBERS, align_documents
from duskwatch.llm.conversations import damage, repair, summarize
from duskwatch.llm.decontaminate import contamination
from duskwatch.llm.embeddings import link_vectors
from duskwatch.llm.licences import scan_licences
from duskwatch.llm.packing import pack_documents
from duskwatch.llm.quality import score_documents
from duskwatch.llm.redirects import judge_pages
from duskwatch.llm.secrets import scan_secrets, secret_digests
from duskwatch.llm.shuffle_shards import shard_documents
from duskwatch.llm.simhash import near_duplicates
from duskwatch.llm.substrings import repeated_words
from duskwatch.llm.token_files import encode_and_index
from duskwatch.session import prepare

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Of a public tokenizer the queries use; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def op1_token_files(spark, sf_dir):
    return encode_and_index(read(spark, sf_dir, "documents"), tokenizer_path(), end_id=1)


def op2_simhash_ball(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"), shingle=3)


def op3_substring_factors(spark, sf_dir):
    return repeated_words(read(spark, sf_dir, "documents"), window=13)


def op4_licence_scan(spark, sf_dir):
    return scan_licences(read(spark, sf_dir, "documents"))


def op5_embedding_tiles(spark, sf_dir):
    return link_vectors(read(spark, sf_dir, "embeddings"), threshold=0.93)


def op6_redirect_rules(spark, sf_dir):
    return judge_pages(read(spark, sf_dir, "pages"))


def op7_bin_completion(spark, sf_dir):
    return pack_documents(read(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048, end_id=0)


def op8_rule_ensemble(spark, sf_dir):
    return score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), threshold=0.3)


def op9_feistel_shards(spark, sf_dir):
    return shard_documents(read(spark, sf_dir, "documents"), shards=8)


def op10_wu_manber(spark, sf_dir):
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=10)


def op11_fragment_monoid(spark, sf_dir):
    aligned = align_documents(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"),
                              digest=True)
    return aligned.select("doc_id", *NUMBERS, F.col("groups").alias("groups_sha256"))


def op12_four_russians(spark, sf_dir):
    conversations = read(spark, sf_dir, "conversations")
    return summarize(repair(damage(conversations)), conversations)


def op13_token_efficiency(spark, sf_dir):
    import public_tokenizers

    return secret_digests(scan_secrets(read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


QUERIES = {f.__name__: f for f in (
    op1_token_files, op2_simhash_ball, op3_substring_factors, op4_licence_scan, op5_embedding_tiles, op6_redirect_rules,
    op7_bin_completion, op8_rule_ensemble, op9_feistel_shards, op10_wu_manber, op11_fragment_monoid, op12_four_russians,
    op13_token_efficiency)}

ORACLES = {
    "op3_substring_factors": r"""
        with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') ws from documents),
        w as (select doc_id, i, array_to_string(ws[i:i + 12], ' ') k from d, unnest(range(1, len(ws) - 11)) t(i)),
        f as (select k, min(doc_id) m from w group by k),
        p as (select distinct w.doc_id, i + j pos from w join f on w.k = f.k, unnest(range(13)) r(j) where m < w.doc_id),
        g as (select doc_id, list(pos) gone from p group by doc_id),
        j as (select d.doc_id, len(ws) n, coalesce(len(gone), 0) r,
                     array_to_string(list_transform(list_filter(range(1, len(ws) + 1),
                         lambda x: gone is null or not list_contains(gone, x)), lambda x: ws[x]), ' ') kept
              from d left join g using (doc_id))
        select doc_id, n::bigint n_words, r::bigint n_removed, sha256(kept) kept_sha256 from j""",
    "op5_embedding_tiles": r"""
        with recursive v as (
            select vec_id, label, embedding::double[] e from embeddings
            where label is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
              and len(list_filter(embedding, lambda x: x <> 0)) > 0),
        n as (select *, sqrt(list_inner_product(e, e)) s from v),
        l as (select a.vec_id a, b.vec_id b from n a join n b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
              where list_inner_product(a.e, b.e) / (a.s * b.s) >= 0.93),
        r(a, b) as (select a, b from l union select r.a, l.b from r join l on r.b = l.a),
        c as (select a, min(b) m from r group by a),
        k as (select a, count(*) n from l group by a)
        select vec_id, coalesce(k.n, 0)::bigint n_links, least(vec_id, coalesce(m, vec_id))::bigint component_id,
               least(vec_id, coalesce(m, vec_id)) = vec_id kept
        from embeddings left join k on k.a = vec_id left join c on c.a = vec_id""",
    "op10_wu_manber": r"""
        with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws from documents),
        b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws from benchmark),
        i as (select distinct item_id, least(len(ws), 10) n, array_to_string(ws[s:s + 9], ' ') k
              from b, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) t(s) where len(ws) > 0),
        w as (select doc_id, s, m.n, array_to_string(ws[s:s + m.n - 1], ' ') k
              from d, (select distinct n from i) m, unnest(range(1, len(ws) - m.n + 2)) t(s)),
        o as (select distinct doc_id, s, n, item_id from w join i using (n, k)),
        h as (select doc_id, count(distinct s + j) n_hit from o, unnest(range(n)) r(j) group by doc_id),
        t as (select doc_id, count(distinct item_id) n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) items
              from o group by doc_id)
        select doc_id, len(ws)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
               sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
        from d left join h using (doc_id) left join t using (doc_id)""",
}
# op6: no page of these tables has a canonical link or refresh, so the rules alone decide; the links are tested against brute force.
ORACLES["op6_redirect_rules"] = r"""
    with u as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) end r from pages),
    p as (select page_id, coalesce(translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') host,
                 coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') path from u),
    q(rule, h, s, v) as (values ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
                         ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
    b as (select page_id, arg_max(rule, length(rule)) rule, arg_max(v, length(rule)) v
          from p join q on (host = h or ends_with(host, '.' || h)) and starts_with(path, s) group by page_id)
    select page_id, host, path, rule, coalesce(v, 'allow') verdict from p left join b using (page_id)"""

# Per conversation and row, the cheapest edits that end in each state of the pattern (nothing yet, after s, u, a) as (cost, audit, lines).
ORACLES["op12_four_russians"] = r"""
    with recursive n as (
        select conv_id, turn, coalesce(role, ' ') r0, coalesce(text, ' ') t0,
               xor(list_reduce([4294967295::bigint] || flatten(list_transform(
                       string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''),
                       lambda ch: [ascii(ch)::bigint] || list_transform(range(8), lambda b: -1::bigint))),
                   lambda v, b: case when b >= 0 then xor(v, b) when v & 1 = 1 then xor(v >> 1, 3988292384::bigint) else v >> 1 end),
                   4294967295::bigint) % 20 k from conversations),
    d as (select conv_id, turn, case k when 4 then 'user' else r0 end r,
                 case k when 1 then '' when 2 then regexp_replace(t0, '[.!?]', '', 'g') else t0 end x
          from n, unnest(range(case k when 3 then 2 else 1 end)) c(copy) where k <> 0),
    e as (select *, row_number() over (partition by conv_id order by turn nulls first, r, x) i from d),
    o as (select *, row_number() over (partition by conv_id, r, x order by i) seen, lag(left(r, 1)) over (partition by conv_id order by i) before,
                 rtrim(x, e' \t\n\x0b\x0c\r') body from e),
    f as (select *, case when body = '' then 'b' when seen > 1 then 'd' when right(body, 1) not in ('.', '!', '?') then 't' else '' end fault,
                 left(r, 1) q, r || ':' || x line from o),
    g as (select conv_id, count(*) rows, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count_if(fault = 'b') blank,
                 count_if(fault = 'd') duplicate, count_if(fault = 't') truncated,
                 count_if(before is not null and before || q not in ('su', 'ua', 'au')) illegal from f group by conv_id),
    z as (select conv_id, 0::bigint i, {'c': 0, 'a': '', 'l': []::varchar[]} s0, {'c': 9000000, 'a': '', 'l': []::varchar[]} ss,
                 {'c': 3, 'a': 'I', 'l': ['user:']} su, {'c': 6, 'a': 'II', 'l': ['user:', 'assistant:']} sa from g
          union all
          select conv_id, i, s0, ss, v.su, list_min([v.sa, {'c': v.su.c + 3, 'a': v.su.a || 'I', 'l': list_append(v.su.l, 'assistant:')}])
          from (select conv_id, i, s0, ss, list_min([pu] || list_transform([s0, ss, pa], lambda y: {'c': y.c + 3, 'a': y.a || 'I', 'l': list_append(y.l, 'user:')})) su,
                       pa sa from (
              select f.conv_id, f.i, f.fault in ('b', 'd') gone, case f.fault when 't' then 3 else 0 end e,
                     {'c': s0.c + 4, 'a': s0.a || 'D', 'l': s0.l} s0,
                     list_min([{'c': ss.c + 4, 'a': ss.a || 'D', 'l': ss.l},
                               {'c': s0.c + e + case when q = 's' and not gone then 0 else 9000000 end, 'a': s0.a || 'K', 'l': list_append(s0.l, line)}]) ss,
                     list_min([{'c': su.c + 4, 'a': su.a || 'D', 'l': su.l}]
                         || list_transform([s0, ss, sa], lambda y: {'c': y.c + e + case when q = 'u' and not gone then 0 else 9000000 end, 'a': y.a || 'K', 'l': list_append(y.l, line)})
                         || list_transform([s0, ss, sa], lambda y: {'c': y.c + 3 + e + case when gone then 9000000 else 0 end, 'a': y.a || 'R', 'l': list_append(y.l, 'user:' || x)})) pu,
                     list_min([{'c': sa.c + 4, 'a': sa.a || 'D', 'l': sa.l},
                               {'c': su.c + e + case when q = 'a' and not gone then 0 else 9000000 end, 'a': su.a || 'K', 'l': list_append(su.l, line)},
                               {'c': su.c + 3 + e + case when gone then 9000000 else 0 end, 'a': su.a || 'R', 'l': list_append(su.l, 'assistant:' || x)}]) pa
              from z join f on f.conv_id is not distinct from z.conv_id and f.i = z.i + 1)) v),
    h as (select z.conv_id, gaps, blank, duplicate, truncated, illegal, list_min([s0, sa]) best
          from z join g on g.conv_id is not distinct from z.conv_id and z.i = g.rows)
    select a.conv_id, coalesce(gaps, 0)::bigint gaps, coalesce(blank, 0)::bigint blank, coalesce(duplicate, 0)::bigint duplicate,
           coalesce(truncated, 0)::bigint truncated, coalesce(illegal, 0)::bigint illegal, coalesce(best.c, 0)::bigint cost,
           coalesce(best.a, '') audit, sha256(coalesce(array_to_string(best.l, chr(10)), '')) repaired_sha256
    from (select distinct conv_id from conversations) a left join h on h.conv_id is not distinct from a.conv_id"""
