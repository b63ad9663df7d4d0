"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from pavilion.llm.align import align_tokens, read_pair
from pavilion.llm.bytebpe import decode_tokens, encode_texts
from pavilion.llm.cascade import quality_report
from pavilion.llm.decontaminate import benchmark_hits
from pavilion.llm.hilbert import hilbert_shards
from pavilion.llm.langid import identify_languages
from pavilion.llm.lines import deduplicate_lines
from pavilion.llm.merkle import fold_proof, merkle_proofs, proof_digest, tampered_digests
from pavilion.llm.mixture import mixed
from pavilion.llm.neardup import near_duplicates
from pavilion.llm.registry import ORACLES, QUERIES, query, table
from pavilion.llm.rindex import remove_repeated_bytes
from pavilion.llm.rlz import remove_repeats
from pavilion.llm.warc import archive_round_trip


__all__ = ["ORACLES", "QUERIES"]

OP5 = r"""
with d as materialized (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
s as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 2 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as s from d),
n as (select doc_id, count(*) as n from s group by doc_id),
x as (select a.doc_id as a, b.doc_id as b, count(*) as shared from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by all),
l as (select a, b from x join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * shared >= 80 * (na.n + nb.n - shared)),
e as (select a, b from l union all select b, a from l),
r as (with recursive r(id, c) as (select doc_id, doc_id from documents union select e.b, r.c from r join e on e.a = r.id)
  select id, min(c) as c from r group by id)
select documents.doc_id, coalesce(n.n, 0)::bigint as n_shingles, r.c as component_id, documents.doc_id = r.c as kept
from documents left join n using (doc_id) join r on r.id = documents.doc_id
"""


@query("op5_minmax_near_duplicates", OP5)
def op5(spark, folder):
    return near_duplicates(table(spark, folder, "documents"), shingle_words=2).drop("row")


OP9 = r"""
with d as materialized (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
p as (select doc_id, unnest(range(1, len(w) - 33)) as i, w from d where len(w) >= 35),
k as (select doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) as k from p),
h as (select doc_id, i from k qualify count(*) over (partition by k) > 1),
c as (select distinct doc_id, i + j as i from h, (select unnest(range(35)) as j)),
x as (select doc_id, list(i) as gone from c group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(len(gone), 0)::bigint as n_removed,
  sha256(coalesce(array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: gone is null or not list_contains(gone, i)), lambda i: w[i]), ' '), '')) as kept_sha256
from d left join x using (doc_id)
"""


@query("op9_relative_lempel_ziv", OP9)
def op9(spark, folder):
    return remove_repeats(table(spark, folder, "documents"), with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP4 = r"""
with d as materialized (select doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, '')) as n from documents),
q as materialized (select doc_id, b, n, substr(h, 2 * b + 1, 610) as h from (select doc_id, n, h, unnest(range(0, n - 49, 256)) as b from d where n >= 50)),
p as (select doc_id, b + j as i, substr(h, 2 * j + 1, 100) as s from (select doc_id, b, h, unnest(range(least(256, n - 49 - b))) as j from q)),
k as (select doc_id, i, hash(s) as k1, md5_number_lower(s) as k2 from p),
f as (select k1, k2, min(doc_id) as lo from k group by k1, k2 having count(distinct doc_id) > 1),
m as (select k.doc_id, k.i from k join f using (k1, k2) where k.doc_id > lo),
b as (select doc_id, i, i > coalesce(max(i) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding) + 50, -1) as fresh from m),
r as (select doc_id, i, sum(fresh::int) over (partition by doc_id order by i) as g from b),
s as (select doc_id, g, min(i) as a, max(i) + 50 as z from r group by doc_id, g),
t as (select doc_id, a, z, lag(z, 1, 0) over (partition by doc_id order by a) as before from s),
u as (select doc_id, count(*) as n_spans, sum(z - a) as gone, max(z) as z,
  string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' order by a) as kept from t join d using (doc_id) group by doc_id)
select d.doc_id, n::bigint as n_bytes, coalesce(gone, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(z, 0) + 1))) as kept_sha256
from d left join u using (doc_id)
"""


@query("op4_run_length_index", OP4)
def op4(spark, folder):
    found = remove_repeated_bytes(table(spark, folder, "documents"), with_text=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


OP1 = r"""
with d as materialized (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
b as materialized (
  select item_id::varchar as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
i as (
  select distinct item, least(len(w), 10) as n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') as k
  from (select item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as p from b where len(w) > 0)),
z as (select distinct n from i),
h as (
  select doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') as k
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as p from d, z where len(w) >= n)
  where k in (select k from i)),
x as (select distinct doc_id, p, h.n, item from h join i on i.n = h.n and i.k = h.k),
c as (select doc_id, count(distinct q) as n_hit from (select doc_id, unnest(range(p, p + n)) as q from x) group by doc_id),
m as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from x) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join c using (doc_id) left join m using (doc_id)
"""


@query("op1_prefix_filtered_containment", OP1)
def op1(spark, folder):
    found = benchmark_hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP7 = r"""
with d as materialized (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as l
  from documents),
g as (select doc_id, unnest(range(1, len(w) - 1)) as i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as s
  from d where len(w) >= 3),
k as (select doc_id, i from g qualify count(*) over (partition by doc_id, s) > 1),
r as (select doc_id, count(distinct i + j) as n from k, (select unnest(range(3)) as j) group by doc_id),
m as (
  select d.doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(r.n, 0)::bigint as n_repeat_words, len(l) as n_lines,
    regexp_matches(t, '\p{Ll}|\p{Lo}') as lower_case
  from d left join r using (doc_id)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or 10 * n_symbols > 3 * n_words or 100 * n_dup_lines > 50 * n_lines or word_chars > 25 * n_words or not lower_case) as kept
from b
"""


@query("op7_short_circuit_cascade", OP7)
def op7(spark, folder):
    return quality_report(table(spark, folder, "documents"))


@query("op2_block_mixture")
def op2(spark, folder):
    documents, _ = mixed(table(spark, folder, "documents"))
    return documents.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query("op6_hilbert_shards")
def op6(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    narrow = docs.select("doc_id", "source", "lang", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    sized = narrow.select("doc_id", "source", "lang", (F.octet_length("text") + 8).cast("bigint").alias("size"), F.crc32("text").alias("text_crc32"))
    axes = {"source": F.col("source"), "lang": F.col("lang"), "size": F.col("size")}
    placed = hilbert_shards(sized, axes, 24, [F.col("text_crc32"), F.col("doc_id")])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


OP10 = r"""
with l as (select doc_id, generate_subscripts(ls, 1) as i, unnest(ls) as l from (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents)),
w as materialized (select doc_id, i, l, regexp_extract_all(l, '[^\x20\x09-\x0D]+') as w from l),
k as (select doc_id, i, w, array_to_string(w, ' ') as k, len(w) as n from w where len(w) > 0),
f as (select k, any_value(w) as w, any_value(n) as n, min(struct_pack(d := doc_id, i := i)) as f from k group by k),
v as (
  select k, f, n, p, md5(array_to_string(w[1:p - 1] || w[p + 1:n], ' ')) as v
  from (select *, unnest(range(1, n + 1)) as p from f where n >= 5)),
near as (
  select k from (select k, f, min(f) over (partition by v, p, n) as m from v) where m < f
  union select v.k from v join f on md5(f.k) = v.v and f.n = v.n - 1 where f.n >= 5 and f.f < v.f
  union select f.k from f join v on md5(f.k) = v.v and f.n = v.n - 1 where f.n >= 5 and v.f < f.f),
stay as (select f.f.d as doc_id, f.f.i as i from f where k not in (select k from near)),
o as (select w.doc_id, w.i, w.l, len(w.w) > 0 as filled, len(w.w) = 0 or stay.i is not null as kept from w left join stay on stay.doc_id = w.doc_id and stay.i = w.i)
select doc_id, count(*) filter (filled)::bigint as n_lines, count(*) filter (not kept)::bigint as n_removed,
  sha256(coalesce(string_agg(l, chr(10) order by i) filter (kept), '')) as kept_sha256
from o group by doc_id
"""


@query("op10_deletion_neighbourhood_lines", OP10)
def op10(spark, folder):
    return deduplicate_lines(table(spark, folder, "documents"), with_text=False).select("doc_id", "n_lines", "n_removed", "kept_sha256")


OP8 = r"""
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
d as (select page_id, octet_length(b)::bigint as n, sha1(b) as digest from p),
m as (select *, max(page_id) over (partition by digest) as newest from d)
select page_id, n as payload_bytes, digest as payload_digest,
  case when n >= 1000 and page_id < newest then 'revisit' else 'response' end as record_type,
  case when n >= 1000 and page_id < newest then newest end as refers_to
from m
"""


@query("op8_capture_index", OP8)
def op8(spark, folder):
    found = archive_round_trip(table(spark, folder, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op3_string_kernel_language")
def op3(spark, folder):
    return identify_languages(table(spark, folder, "documents"))


@query("op11_spill_counted_alignment")
def op11(spark, folder):
    pair = read_pair(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    found = align_tokens(table(spark, folder, "documents"), pair, with_groups=False)
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


OP12 = r"""
with recursive b as materialized (select range as i from range(256)),
crc as materialized (
  select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t from b),
e as materialized (
  select doc_id, source,
    list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])) as c,
    coalesce(strlen(doc_id::varchar)::varchar || ':' || doc_id::varchar, '-') || coalesce(strlen(source)::varchar || ':' || source, '-') ||
      coalesce(strlen(lang)::varchar || ':' || lang, '-') || coalesce(strlen(n_chars::varchar)::varchar || ':' || n_chars::varchar, '-') as h,
    text, replace(text, chr(10), '') as x
  from documents, crc),
leaves as materialized (
  select doc_id, source, row_number() over (partition by source order by doc_id nulls first) - 1 as i,
    sha256(h || coalesce(strlen(text)::varchar || ':' || text, '-')) as leaf,
    case when xor(c, 4294967295) % 2 = 0 then sha256(h || coalesce(strlen(x)::varchar || ':' || x, '-')) else sha256(h || coalesce(strlen(text)::varchar || ':' || text, '-')) end as tampered
  from e),
t as materialized (
  with recursive t(source, level, i, d) as (
    select source, 0, i, leaf from leaves
    union all
    select source, level + 1, i // 3, sha256(string_agg(d, '' order by i))
    from (select *, count(*) over (partition by source) as n from t) where n > 1 group by source, level, i // 3)
  select * from t),
subs as materialized (select *, row_number() over (order by source nulls first) - 1 as i from (
  select source, level as levels, d as subroot from t qualify level = max(level) over (partition by source))),
r as materialized (
  with recursive r(level, i, d) as (
    select 0, i, subroot from subs
    union all
    select level + 1, i // 3, sha256(string_agg(d, '' order by i)) from (select *, count(*) over () as n from r) where n > 1 group by level, i // 3)
  select * from r),
st as materialized (
  select source, t.level, i,
    coalesce(string_agg(d, '') over (partition by source, t.level, i // 3 order by i rows between unbounded preceding and 1 preceding), '') as before,
    coalesce(string_agg(d, '') over (partition by source, t.level, i // 3 order by i rows between 1 following and unbounded following), '') as after
  from t where level < (select max(levels) from subs s where s.source is not distinct from t.source)),
sr as materialized (
  select level, i,
    coalesce(string_agg(d, '') over (partition by level, i // 3 order by i rows between unbounded preceding and 1 preceding), '') as before,
    coalesce(string_agg(d, '') over (partition by level, i // 3 order by i rows between 1 following and unbounded following), '') as after
  from r where level < (select max(level) from r)),
f as materialized (
  with recursive f(doc_id, source, leaf, level, i, own, proof) as (
    select doc_id, source, leaf, 0, i, tampered, '' from leaves
    union all
    select f.doc_id, f.source, f.leaf, f.level + 1, f.i // 3, sha256(before || own || after), proof || before || after
    from f join st on st.source is not distinct from f.source and st.level = f.level and st.i = f.i)
  select f.*, subroot, s.i as place from f join subs s on s.source is not distinct from f.source and s.levels = f.level),
g as materialized (
  with recursive g(doc_id, leaf, subroot, level, i, own, proof) as (
    select doc_id, leaf, subroot, 0, place, own, proof from f
    union all
    select g.doc_id, g.leaf, g.subroot, g.level + 1, g.i // 3, sha256(before || own || after), proof || before || after
    from g join sr on sr.level = g.level and sr.i = g.i)
  select * from g where level = (select max(level) from r))
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, own as folded_root, own = root as verified
from g, (select d as root from r where level = (select max(level) from r))
"""


@query("op12_time_forward_manifest", OP12)
def op12(spark, folder):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    leaves = tampered_digests(table(spark, folder, "documents").select(*columns), columns).select("doc_id", "source", "leaf", "tampered")
    found = merkle_proofs(leaves, F.col("source"), [F.col("doc_id")])
    folded = found.withColumns({"proof_sha256": proof_digest(F.col("proof")), "folded_root": fold_proof(F.col("tampered"), F.col("proof"))})
    return folded.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op13_byte_level_bpe")
def op13(spark, folder):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = encode_texts(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    decoded = decode_tokens(encoded, ranks, public_tokenizers.PATTERN)
    written = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(written, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
