"""The named queries of the language-model operators and, where SQL can say them, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from wardstat.llm import chat_format, decontamination, divergence, embedding_dedup, line_dedup, lm_scoring, merkle_manifest, minhash_dedup, mixing, pii, substring_dedup, token_counts, toxicity
from wardstat.plans.registry import query

BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


@query("op1_minhash_dedup", rf"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{line_dedup.UPPER}', '{line_dedup.LOWER}'), '{WORD}') as ws from documents),
w as (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as i from d where len(ws) > 0),
s as (select distinct doc_id, md5(array_to_string(ws[i:i + 4], ' ')) as h from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as m from s a join s b on a.h = b.h and a.doc_id < b.doc_id group by 1, 2),
l as materialized (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * m >= 85 * (x.n + y.n - m)),
e as materialized (select a, b from l union all select b, a from l),
c(doc_id, c) as (with recursive r(doc_id, c) as (select a, a from e union select e.b, r.c from r join e on e.a = r.doc_id) select doc_id, min(c) from r group by doc_id)
select d.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(c.c, d.doc_id) as component_id, coalesce(c.c, d.doc_id) = d.doc_id as kept
from d left join n using (doc_id) left join c using (doc_id)""")
def op1(t):
    return minhash_dedup.near_duplicates(t.documents)


@query("op2_toxicity")
def op2(t):
    out = toxicity.score(t.documents, toxicity.learn_on_training_part(t.documents, t.labels))
    return out.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"), "density")


@query("op3_lm_scoring")
def op3(t):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    out = lm_scoring.score_texts(t.documents, ~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op4_substring_dedup", rf"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as ws from documents),
w as (select doc_id, unnest(range(1, greatest(len(ws) - 11, 1))) as i, ws from d),
k as (select doc_id, i, md5(array_to_string(ws[i:i + 12], ' ')) as k from w),
f as (select k, min(doc_id) as owner from k group by k),
c as (select distinct doc_id, unnest(range(i, i + 13)) as p from k join f using (k) where doc_id > owner),
p as (select doc_id, unnest(ws) as word, generate_subscripts(ws, 1) as p from d),
m as (select p.doc_id, p.p, p.word, c.p is not null as gone from p left join c on p.doc_id = c.doc_id and p.p = c.p),
r as (select doc_id, count(*) as n, count(*) filter (where gone) as g, string_agg(word, ' ' order by p) filter (where not gone) as kept from m group by doc_id)
select d.doc_id, coalesce(r.n, 0) as n_words, coalesce(r.g, 0) as n_removed, sha256(coalesce(r.kept, '')) as kept_sha256
from d left join r using (doc_id)""")
def op4(t):
    out = substring_dedup.remove_repeats(t.documents)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op5_token_counts")
def op5(t):
    out = token_counts.count_tokens(t.documents, public_tokenizers.path("piece_bpe_32k.model"))
    return out.withColumn("over_limit", F.col("n_tokens") > 4096)


def _level(parent: str, name: str, nodes: str) -> str:
    """SQL for one level of budgets: water filling among the children of a parent, in integers."""
    over = f"partition by {parent}"
    fill = f"({over} order by cap / w, {name} rows between unbounded preceding and 1 preceding)"
    return f"""(select *, case when "full" then cap else ((given - taken) * w) // greatest(open, 1) end as budget from
  (select *, coalesce(sum(case when "full" then cap end) over ({over}), 0)::bigint as taken, coalesce(sum(case when not "full" then w end) over ({over}), 0)::bigint as open from
    (select *, cap * (sum(w) over ({over}) - coalesce(sum(w) over {fill}, 0))::bigint <= (given - coalesce(sum(cap) over {fill}, 0)::bigint) * w as "full" from ({nodes}))))"""


_MIX = rf"""
with d as materialized (select doc_id, case when regexp_extract(source, '(\d+)$', 1) = '' then 'other' when regexp_extract(source, '(\d+)$', 1) = '0' then 'web'
    when regexp_extract(source, '(\d+)$', 1)::bigint % 2 = 1 then 'forum' else 'books' end as domain, lang, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) as n_tokens from documents),
l as materialized (select domain, lang, source, sum(n_tokens)::bigint as n_tokens, 3 * sum(n_tokens)::bigint as cap from d group by all),
t as (select sum(n_tokens)::bigint * 3 // 5 as given from l),
a as materialized (select domain, budget as given from {_level("root", "domain", "select domain, 0 as root, case domain when 'web' then 2 when 'forum' then 3 when 'books' then 5 else 1 end as w, sum(cap)::bigint as cap, any_value(t.given) as given from l, t where cap > 0 group by domain")}),
b as materialized (select domain, lang, budget as given from {_level("domain", "lang", "select l.domain, lang, case lang when 'en' then 4 when 'de' then 2 when 'fr' then 2 when 'es' then 2 else 1 end as w, sum(cap)::bigint as cap, any_value(a.given) as given from l join a using (domain) where cap > 0 group by l.domain, lang")}),
c as materialized (select domain, lang, source, budget from {_level("domain, lang", "source", "select l.domain, l.lang, source, 1 as w, cap, b.given from l join b on l.domain = b.domain and l.lang = b.lang where cap > 0")}),
p as (select l.domain, l.lang, l.source, coalesce(budget // nullif(n_tokens, 0), 0) as epochs, coalesce(budget % nullif(n_tokens, 0), 0) as rest, coalesce(budget, 0) > 0 as paid from l left join c using (domain, lang, source)),
r as (select d.*, epochs, rest, paid, sum(n_tokens) over (partition by domain, lang, source order by md5('7:' || epochs || ':' || doc_id), doc_id, n_tokens rows unbounded preceding) as ends from d join p using (domain, lang, source))
select doc_id, domain, lang, source, n_tokens, (epochs + case when ends <= rest and paid then 1 else 0 end)::bigint as copies from r"""


@query("op6_mixing", _MIX)
def op6(t):
    domain, weights = mixing.stage_settings()
    return mixing.mix(t.documents, domain, weights, share=(3, 5), max_epochs=3, seed=7)


@query("op7_embedding_dedup", """
with v as (select vec_id, label, embedding::double[] as e from embeddings where label is not null and embedding is not null),
g as (select *, sqrt(list_dot_product(e, e)) as n from v where list_dot_product(e, e) > 0),
l as materialized (select a.vec_id as a, b.vec_id as b from g a join g b on a.label = b.label and a.vec_id <> b.vec_id where list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98),
c(vec_id, c) as (with recursive r(vec_id, c) as (select a, a from l union select l.b, r.c from r join l on l.a = r.vec_id) select vec_id, min(c) from r group by vec_id),
n as (select a as vec_id, count(*) as n from l group by a)
select e.vec_id, coalesce(n.n, 0) as n_links, coalesce(c.c, e.vec_id) as component_id, coalesce(c.c, e.vec_id) = e.vec_id as kept
from embeddings e left join n using (vec_id) left join c using (vec_id)""")
def op7(t):
    return embedding_dedup.near_duplicates(t.embeddings)


@query("op8_decontamination")
def op8(t):
    return decontamination.find_leaks(t.documents, t.benchmark)


@query("op9_line_dedup", rf"""
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents),
k as (select *, translate(regexp_replace(regexp_replace(line, '^{BLANK}+', ''), '{BLANK}+$', ''), '{line_dedup.UPPER}', '{line_dedup.LOWER}') as key from l),
f as (select key, max(doc_id) as keeper from k where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
m as (select k.doc_id, k.pos, k.line, f.key is not null and k.doc_id <> f.keeper as gone from k left join f on k.key = f.key)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from m group by doc_id""")
def op9(t):
    out = line_dedup.dedupe_lines(t.documents)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op10_chat_format")
def op10(t):
    return chat_format.repair_roles(t.conversations)


def _merkle_sql(levels: int = 9, top_levels: int = 4) -> str:
    """SQL of the manifest for up to 8^levels rows of a language and 8^top_levels languages."""
    field = lambda c: f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')"
    leaf = lambda text: f"sha256({' || '.join(map(field, ('doc_id', 'source', 'lang', 'n_chars')))} || {field(text)})"
    lower = f"translate(text, '{line_dedup.UPPER}', '{line_dedup.LOWER}')"
    parts = [f"""t as (select list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end)) as tbl),
d as (select *, xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::varchar, ''), lambda ch: ascii(ch)::bigint)), lambda c, b: xor(c // 256, tbl[xor(c, b) % 256 + 1])), 4294967295) % 3 = 0 as hit from documents, t),
g as materialized (select doc_id, coalesce('=' || lang, '') as k, {leaf("text")} as leaf, case when hit and text is not null then {leaf(lower)} end as other from d),
x0 as (select *, row_number() over (partition by k order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by k) as m, '' as proof, coalesce(other, leaf) as f from g),
n0 as (select k, i, m, leaf as h from x0)"""]

    def climb(node: str, row: str, n: int, first: int) -> None:
        for j in range(first, first + n):
            run = "partition by k, i // 8 order by i rows between"
            parts.append(f"""s{j} as materialized (select *, case when m > 1 then coalesce(string_agg(h, '') over ({run} unbounded preceding and 1 preceding), '') end as l, case when m > 1 then coalesce(string_agg(h, '') over ({run} 1 following and unbounded following), '') end as r from {node}{j}),
{node}{j + 1} as (select k, i // 8 as i, any_value((m + 7) // 8) as m, case when any_value(m) > 1 then sha256(string_agg(h, '' order by i)) else any_value(h) end as h from {node}{j} group by k, i // 8),
{row}{j + 1} as materialized (select x.* replace (x.i // 8 as i, x.proof || coalesce(l || r, '') as proof, case when l is null then f else sha256(l || f || r) end as f) from {row}{j} x join s{j} s on x.k = s.k and x.i = s.i)""")

    climb("n", "x", levels, 0)
    parts.append(f"n{levels}_top as (select k, h as subroot, row_number() over (order by k) - 1 as pos, count(*) over () as m from n{levels})")
    parts.append(f"n{100} as (select '' as k, pos as i, m, subroot as h from n{levels}_top)")
    parts.append(f"x{100} as (select x.doc_id, '' as k, u.pos as i, x.leaf, x.proof, x.f, u.subroot from x{levels} x join n{levels}_top u on x.k = u.k)")
    climb("n", "x", top_levels, 100)
    last = 100 + top_levels
    return "with " + ",\n".join(parts) + f"\nselect doc_id, leaf, subroot, (select h from n{last}) as root, sha256(proof) as proof_sha256, f as folded_root, f = (select h from n{last}) as verified from x{last}"


@query("op11_merkle_manifest", _merkle_sql())
def op11(t):
    text = F.col("text")
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, line_dedup.UPPER, line_dedup.LOWER))
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    out = merkle_manifest.manifest(t.documents, F.when(hit, lowered))
    folded = merkle_manifest.fold(F.coalesce("other", "leaf"), F.col("path"))
    out = out.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle_manifest.proof_text(F.col("path")), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


@query("op13_divergence", rf"""
with d as materialized (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, translate(coalesce(text, ''), '{line_dedup.UPPER}', '{line_dedup.LOWER}') as text from documents),
t as materialized (select r, lang, source, unnest(regexp_extract_all(text, '{_TERM}')) as term from d),
k as materialized (select lang, term, count(*) as total from t group by lang, term having count(distinct r) >= 10),
v as materialized (select lang, count(*) as v, sum(total) as total from k group by lang),
s as materialized (select distinct lang, source from d),
n as (select lang, source, term, count(*) as n from t group by lang, source, term),
c as materialized (select s.lang, s.source, k.term, k.total, coalesce(n.n, 0) as n from s join k on s.lang = k.lang left join n on n.lang = s.lang and n.source = s.source and n.term = k.term),
o as (select lang, source, sum(n) as own from c group by lang, source),
p as materialized (select c.lang, c.source, c.term, c.n, (1 + (1000000000::hugeint * (c.n + 2)) // (o.own + 2 * v.v))::bigint as p, (1 + (1000000000::hugeint * (c.total + 2)) // (v.total + 2 * v.v))::bigint as q
  from c join o using (lang, source) join v using (lang)),
f as (select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
u as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(f.value, 0)::bigint as value from s a join s b on a.lang = b.lang and a.source <> b.source left join f on f.lang = a.lang and f.source = a.source and f.item = b.source
  union all select lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::bigint from p where n > 0 and p > q),
r as (select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank from u)
select * from r where part = 'pair' or rank <= 10""")
def op13(t):
    return divergence.audit(t.documents)


@query("op12_pii")
def op12(t):
    out = pii.find(t.documents)
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *(n(k) for k in pii.KINDS), F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"), pii.as_text(F.col("spans")).alias("spans"))
