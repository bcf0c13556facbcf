"""DuckDB SQL of the registered queries that SQL can express on whole tables."""

from __future__ import annotations

OP8 = r"""
with d as (
    select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents
), w as (
    select rid, doc_id, t,
        list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
    from d
), each_word as (
    select rid, unnest(words) as word, unnest(range(0, len(words))) as i from w
), windows as (
    select rid, i, concat_ws(' ', word, lead(word, 1) over o, lead(word, 2) over o, lead(word, 3) over o,
        lead(word, 4) over o) as g, lead(word, 4) over o is not null as whole
    from each_word window o as (partition by rid order by i)
), twice as (
    select rid, i from windows where whole qualify count(*) over (partition by rid, g) >= 2
), covered as (
    select rid, count(distinct i + k) as n_repeat_words
    from twice, (select unnest(range(0, 5)) as k) group by rid
), m as (
    select w.doc_id,
        len(words)::bigint as n_words,
        coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
        len(lines)::bigint as n_lines,
        (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
        coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
        (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::bigint as n_upper
    from w left join covered using (rid)
), f as (
    select *, (
        case when n_words < 10 then 1 else 0 end
        + case when 100 * n_repeat_words > 20 * n_words then 2 else 0 end
        + case when 100 * n_symbols > 30 * n_words then 4 else 0 end
        + case when 100 * n_dup_lines > 50 * n_lines then 8 else 0 end
        + case when word_chars > 25 * n_words then 16 else 0 end
        + case when word_chars < 2 * n_words then 32 else 0 end
        + case when 100 * n_upper > 60 * word_chars then 64 else 0 end)::bigint as failures
    from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    failures % 4 <> 0 as base_failed, failures = 0 as kept, failures
from f
"""


OP10 = r"""
with p as (
    select page_id, coalesce(html, '') as t, sha256(coalesce(html, '')) as payload_digest,
        strlen(coalesce(html, ''))::bigint as payload_bytes
    from pages
), f as (
    select payload_digest, min(page_id) as first_id from p where payload_bytes >= 100 group by payload_digest
)
select page_id, payload_bytes, p.payload_digest,
    case when page_id > first_id then 'revisit' else 'response' end as record_type,
    case when page_id > first_id then first_id end as refers_to
from p left join f on p.payload_digest = f.payload_digest
"""


OP11 = r"""
with v as (
    select row_number() over () as rid, vec_id,
        list_transform(embedding, lambda x: floor(64 * x::double)::bigint::double) as x
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
    select q.rid as qid, q.vec_id as query_id, c.vec_id, c.rid, list_inner_product(q.x, c.x)::bigint as score
    from v q join v c on q.vec_id % 20 = 0 and q.rid <> c.rid
)
select query_id, vec_id, score,
    row_number() over (partition by qid order by score desc, vec_id nulls last, rid)::int as rank
from s qualify rank <= 20
"""


def _grams(n: int) -> str:
    """Runs of n words inside pieces, with their number of occurrences in a language."""
    words = " || ' ' || ".join(["word", *[f"lead(word, {k}) over o" for k in range(1, n)]])
    return f"""g{n} as (
    select lang, phrase, {n} as size, count(*)::hugeint as f from (
        select lang, {words} as phrase from w window o as (partition by rid, piece order by pos)
    ) where phrase is not null group by lang, phrase having count(*) >= 100
)"""


OP12 = rf"""
with p as (
    select lang, rid, unnest(pieces) as words, unnest(range(len(pieces))) as piece from (
        select coalesce(lang, 'und') as lang, row_number() over () as rid,
            regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]') as pieces
        from documents)
), w as (
    select lang, rid, piece, unnest(tokens) as word, unnest(range(len(tokens))) as pos from (
        select lang, rid, piece, list_filter(regexp_split_to_array(words, '[\x20\x09]+'), lambda x: x <> '') as tokens
        from p)
), total as (
    select lang, count(*)::hugeint as n from w group by lang
), {", ".join(_grams(n) for n in range(1, 6))}, g as (
    {" union all ".join(f"select * from g{n}" for n in range(1, 6))}
), cuts as (
    select lang, phrase, size, f, unnest(range(1, size)) as k, string_split(phrase, ' ') as words from g where size > 1
), scored as (
    select c.lang, c.phrase, c.f as a, x.f as l, y.f as r, k, (1000 * c.f * n) // (x.f * y.f) as score, n
    from cuts c join total using (lang)
    join g x on x.lang = c.lang and x.phrase = array_to_string(words[1:k], ' ')
    join g y on y.lang = c.lang and y.phrase = array_to_string(words[k + 1:], ' ')
), cut as (
    select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), parts as (
    select lang, array_to_string(words[i:i + m - 1], ' ') as phrase, max(f) as longer from (
        select distinct lang, f, string_split(phrase, ' ') as words, m, unnest(range(1, size - m + 2)) as i
        from g, (select unnest(range(2, 5)) as m) where size > m
    ) group by all
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase,
    a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from cut left join parts using (lang, phrase) where longer is null or 100 * longer < 100 * a
qualify rank <= 2000
"""


def _assigned(r: int) -> str:
    """Nearest entry and its distance of every part under the codebook of round r."""
    return f"""a{r} as materialized (
    select rid, p, min_by(k, d * 16 + k) as k, min(d) as d from (
        select rid, p, k, list_sum(list_transform(list_zip(v.y, c.y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::hugeint as d
        from parts v join c{r} c using (p)
    ) group by rid, p
)"""


def _moved(r: int) -> str:
    """The codebook after round r."""
    return f"""c{r + 1} as materialized (
    select p, k, list(coalesce(z, old) order by i) as y from (
        select p, k, unnest(y) as old, unnest(range(len(y))) as i from c{r}
    ) left join (
        select p, k, i, (sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*) as z from (
            select p, k, unnest(y) as x, unnest(range(len(y))) as i from a{r} join parts using (rid, p)
        ) group by p, k, i
    ) using (p, k, i) group by p, k
)"""


OP13 = f"""
with v as (
    select row_number() over () as rid, vec_id, label,
        list_transform(embedding, lambda x: floor(4096 * x::double)::bigint) as x
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as materialized (
    select rid, p, x[p * (len(x) // 8) + 1:(p + 1) * (len(x) // 8)] as y from v, (select unnest(range(8)) as p)
), c0 as (
    select p, k, y from parts join (select rid, row_number() over (order by vec_id) - 1 as k from v) using (rid) where k < 16
), {", ".join(_assigned(r) + ", " + _moved(r) for r in range(6))}, {_assigned(6)}, book as (
    select sha256(string_agg(array_to_string(y, ','), ',' order by p, k)) as codebooks_sha256 from c6
), coded as (
    select rid, string_agg(format('{{:02x}}', k), '' order by p) as code, sum(d)::bigint as error from a6 group by rid
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from coded join v using (rid), book
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op8_quality_rules": OP8,
        "op10_warc": OP10,
        "op11_pivot_search": OP11,
        "op12_collocations": OP12,
        "op13_vector_codes": OP13,
    }
