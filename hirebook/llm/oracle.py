"""DuckDB SQL of the registered queries that SQL can express.

Each is the plain definition of the result, not the operator's method: copies
by a window over the whole text, links by comparing every two vectors, secrets
by one search a rule.  They are for the small tables of a comparison.
"""

from __future__ import annotations

OP1 = """
    with p as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as h from pages),
    digits as (select h, list_aggregate(list_transform(generate_series(1, 40), lambda i: right(bin(16 + strpos('0123456789abcdef', h[i]) - 1), 4)), 'string_agg', '') as bits
               from (select distinct h from p)),
    named as (select h, list_aggregate(list_transform(generate_series(0, 31),
                  lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_sum(list_transform(generate_series(1, 5), lambda k: bits[5 * i + k]::int * (1 << (5 - k))))::int]),
                  'string_agg', '') as payload_digest from digits),
    f as (select *, min(page_id) over (partition by h, payload_bytes) as least from p)
    select page_id, payload_bytes, payload_digest, case when page_id = least then 'response' else 'revisit' end as record_type,
           case when page_id <> least then least end as refers_to
    from f join named using (h)"""

OP4 = """
    with recursive v as (select vec_id, embedding::double[] as e from embeddings),
    good as (select vec_id, e from v where len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
             and len(list_filter(e, lambda x: x <> 0)) > 0),
    links as (select a.vec_id as a, b.vec_id as b from good a join good b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
              where list_cosine_similarity(a.e, b.e) >= 0.9),
    reach as (select vec_id as a, vec_id as b from v union select r.a, l.b from reach r join links l on l.a = r.b)
    select vec_id, (select count(*) from links l where l.a = vec_id) as n_links,
           (select min(r.b) from reach r where r.a = vec_id) as component_id,
           vec_id = (select min(r.b) from reach r where r.a = vec_id) as kept
    from v"""

OP6 = """
    with t as (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as h from documents)
    select doc_id, max(doc_id) over (partition by h) as keep_id, count(*) over (partition by h) as group_size,
           doc_id = max(doc_id) over (partition by h) as kept, h as text_sha256 from t"""


OP11 = r"""
    with d as (select row_number() over () as n, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
    l as (select n, doc_id, generate_subscripts(lines, 1) as i, unnest(lines) as line from d),
    k as (select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
    g as (select *, length(key) >= 10 and min(doc_id) over (partition by key) <> doc_id as dropped from k)
    select doc_id, count(*) as n_lines, count(*) filter (dropped) as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by i) filter (not dropped), '')) as kept_sha256
    from g group by n, doc_id"""

OP12 = """
    with r as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                      list_transform(embedding, lambda c: floor(256 * c::double)) as x
               from embeddings where label is not null and embedding is not null
                    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
    s as (select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same, list_inner_product(a.x, b.x)::bigint as score
          from r a join r b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
    p as (select * from s where same qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
    select p.anchor_id, p.other as positive_id, (row_number() over best)::int as rank, s.other as negative_id,
           p.score as positive_score, s.score as negative_score
    from p join s on s.anchor_id = p.anchor_id and not s.same and 80 * p.score <= 100 * s.score and s.score <= p.score
    window best as (partition by p.anchor_id, p.other order by s.score desc, s.other)
    qualify row_number() over best <= 5"""


def _either(word: str) -> str:
    """The word with every letter in either case (ASCII only)."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


# Kind, pattern, group whose length counts, its least length.
_NAMES = "|".join(map(_either, ("password", "passwd", "secret", "token", "api_?key")))
_KINDS = (
    ("assign", rf"""({_NAMES})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]+", 0, 16),
    ("pem", "-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----", 0, 1),
)

# The pieces between matches and the matches before one tell where it starts.
OP2 = ("with t as (select row_number() over () as n, doc_id, coalesce(text, '') as text from documents), cut as ("
       + " union all ".join(
           f"select n, {rank} as rank, '{kind}' as kind, generate_subscripts(hits, 1) as i, unnest(hits) as hit, unnest(gaps[:len(hits)]) as gap, "
           f"unnest(list_transform(hits, lambda x: length(regexp_extract(x, '{pattern}', {group})) >= {least})) as good "
           f"from (select n, regexp_extract_all(text, '{pattern}') as hits, string_split_regex(text, '{pattern}') as gaps from t)"
           for rank, (kind, pattern, group, least) in enumerate(_KINDS))
       + """),
    spans as (select n, rank, kind, good, sum(length(gap) + length(hit)) over (partition by n, rank order by i) as stop, length(hit) as size from cut),
    found as (select n, count(*) filter (rank = 0) as n_assign, count(*) filter (rank = 1) as n_access, count(*) filter (rank = 2) as n_hex,
                     string_agg(concat_ws(':', kind, stop - size, stop), ',' order by stop - size, rank) as spans,
                     string_agg(concat_ws(':', kind, stop - size, stop), ',' order by stop - size, rank) filter (rank < 3) as base
              from spans where good group by n)
    select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
           sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
    from t left join found using (n)""")

ORACLE_SQL = {"op1_warc": OP1, "op2_secret_ledger": OP2, "op4_vector_passes": OP4, "op6_exact_dedup": OP6, "op11_line_dedup": OP11,
              "op12_hard_negatives": OP12}
