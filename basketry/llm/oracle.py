"""SQL counterparts for DuckDB of those queries that SQL can express."""

from __future__ import annotations

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

SQL: dict[str, str] = {
    # Base32 spelled from each 20 bits (5 hexadecimal digits) of the SHA-1.
    "op2_warc_revisits": """
        with rows as (
            select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as hex
            from pages),
        named as (
            select *, array_to_string([array_to_string([
                       substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                              1 + ((('0x' || substr(hex, 5 * g + 1, 5))::int >> b) & 31), 1)
                       for b in [15, 10, 5, 0]], '') for g in range(8)], '') as payload_digest,
                   min(page_id) over (partition by hex) as first
            from rows)
        select page_id, payload_bytes, payload_digest,
               case when page_id = first then 'response' else 'revisit' end as record_type,
               case when page_id <> first then first end as refers_to
        from named""",
    "op8_exact_top_k": """
        with v as (
            select vec_id, [floor(64 * x::double) for x in embedding] as w from embeddings
            where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
        pairs as (
            select q.vec_id as query_id, c.vec_id, list_inner_product(q.w, c.w)::bigint as score
            from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id)
        select query_id, row_number() over best::int as rank, vec_id, score from pairs
        window best as (partition by query_id order by score desc, vec_id)
        qualify row_number() over best <= 20""",
    "op9_substring_dedup": rf"""
        with texts as (select doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents),
        windows as (
            select doc_id, unnest(range(1, len(w) - 48)) as i, w from texts where len(w) >= 50),
        named as (select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as h from windows),
        first as (select h, min(doc_id) as low from named group by h),
        covered as (
            select distinct doc_id, unnest(range(i, i + 50)) as place
            from named join first using (h) where low < doc_id),
        gone as (select doc_id, list(place) as places, count(*) as n from covered group by doc_id)
        select doc_id, len(w) as n_words, coalesce(n, 0) as n_removed,
               sha256(coalesce(array_to_string([x for x, k in w if n is null or not list_contains(places, k)], ' '), ''))
                   as kept_sha256
        from texts left join gone using (doc_id)""",
    "op10_exact_dedup": rf"""
        with rows as (
            select doc_id, sha256(regexp_replace(coalesce(text, ''), '{SPACES}', ' ', 'g')) as text_sha256
            from documents)
        select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
               doc_id = min(doc_id) over same as kept, text_sha256
        from rows window same as (partition by text_sha256)""",
}


def codes_sql(entries: int = 16, parts: int = 8, rounds: int = 6) -> str:
    """Operator 11, one group of common table expressions per round."""

    def assigned(book: str) -> str:
        return f"""
            select p.n, p.part, p.v, min(list_sum([(x[1] - x[2]) * (x[1] - x[2]) for x in list_zip(p.v, b.v)])::hugeint
                       * {entries} + b.entry) as best
            from parts p join {book} b using (part) group by all"""

    steps = []
    for r in range(rounds):
        steps.append(f"""
        near{r} as materialized ({assigned(f"book{r}")}),
        mean{r} as materialized (
            select part, entry, list((s - ((s % c) + c) % c) // c order by place) as v
            from (select part, (best % {entries})::int as entry, place, sum(v[place])::hugeint as s, count(*)::hugeint as c
                  from near{r}, unnest(range(1, len(v) + 1)) as u(place) group by all) group by all),
        book{r + 1} as materialized (
            select b.part, b.entry, coalesce(m.v, b.v) as v from book{r} b left join mean{r} m using (part, entry))""")
    return f"""
        with kept as (
            select vec_id, label, embedding, row_number() over (order by vec_id) as n from embeddings
            where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
        parts as materialized (
            select n, part, [floor(4096 * x::double)::hugeint for x in
                             embedding[part * (len(embedding) // {parts}) + 1 : (part + 1) * (len(embedding) // {parts})]] as v
            from kept, unnest(range({parts})) as u(part)),
        book0 as materialized (select part, (n - 1)::int as entry, v from parts where n <= {entries}),
        {",".join(steps)},
        final as ({assigned(f"book{rounds}")}),
        codes as (
            select n, string_agg(printf('%02x', (best % {entries})::int), '' order by part) as code,
                   sum(best // {entries})::bigint as error from final group by n),
        digest as (
            select sha256(string_agg(x::varchar, ',' order by part, entry, place)) as codebooks_sha256
            from (select part, entry, place, v[place] as x from book{rounds}, unnest(range(1, len(v) + 1)) as u(place)))
        select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256
        from kept join codes using (n), digest"""


def phrases_sql(support: int = 30, length: int = 4, top: int = 2000, cover: int = 80) -> str:
    """Operator 12."""
    return rf"""
        with pieces as (
            select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?
-]')) as piece
            from documents),
        worded as materialized (select lang, regexp_extract_all(piece, '[^ 	]+') as w from pieces),
        sizes as (select lang, sum(len(w))::bigint as n from worded group by lang),
        grams as (
            select lang, words, w[i : i + words - 1] as g
            from worded, unnest(range(1, {length + 1})) as a(words), unnest(range(1, len(w) - words + 2)) as b(i)),
        counts as materialized (
            select lang, words, g, count(*) as f from grams group by all having count(*) >= {support}),
        cuts as (
            select c.lang, c.words, c.g, c.f as a, k, l.f as l, r.f as r,
                   (c.f::hugeint * 2000000 // (l.f + r.f))::bigint as score
            from counts c, unnest(range(1, c.words)) as u(k)
            join counts l on l.lang = c.lang and l.g = c.g[1:k]
            join counts r on r.lang = c.lang and r.g = c.g[k + 1:]
            where c.words > 1),
        lowest as (select * from cuts qualify row_number() over (partition by lang, g order by score, k) = 1),
        inside as (
            select lang, g[i : i + size - 1] as g, max(f) as most
            from counts, unnest(range(2, words)) as a(size), unnest(range(1, words - size + 2)) as b(i) group by all),
        named as (
            select o.lang, array_to_string(o.g, ' ') as phrase, a, l, r, score
            from lowest o left join inside i on i.lang = o.lang and i.g = o.g
            where i.most is null or 100 * i.most::hugeint < {cover} * a::hugeint)
        select lang, row_number() over best::int as rank, phrase, a, l, r, n, score
        from named join sizes using (lang)
        window best as (partition by lang order by score desc, a desc, phrase)
        qualify row_number() over best <= {top}"""


def oracle_sql() -> dict[str, str]:
    return SQL | {"op11_vector_codes": codes_sql(), "op12_phrase_collocations": phrases_sql()}
