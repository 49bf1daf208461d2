"""Registered queries of the operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from clickmarts.llm import (bpe, chat, collocations, decontaminate, fingerprints, language_id, licenses, ngram_join, pii, quality,
                            spelling, suffix_dedup, url_filter)
from clickmarts.llm.common import table


def op1_ngram_join(spark, sf_dir):
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op2_bpe(spark, sf_dir):
    return bpe.encode_table(table(spark, sf_dir, "documents"))


def op3_decontamination(spark, sf_dir):
    return decontaminate.contamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


def op4_language_id(spark, sf_dir):
    return language_id.language_report(table(spark, sf_dir, "documents"))


def op5_pii(spark, sf_dir):
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op6_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint_report(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op8_chat(spark, sf_dir):
    """All conversations, and conversation -1, whose texts are the template's own kind of marks."""
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_turns(rows.union(extra)))


def op9_url_filter(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op10_licenses(spark, sf_dir):
    return licenses.license_scan(table(spark, sf_dir, "documents")).drop("spans")


def op11_quality_rules(spark, sf_dir):
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_ngram_join, op2_bpe, op3_decontamination, op4_language_id, op5_pii, op6_fingerprints, op7_suffix_dedup, op8_chat,
    op9_url_filter, op10_licenses, op11_quality_rules, op12_spelling_variants,
    op13_collocations, pipeline)}

_STOPS = ", ".join(f"'{f}'" for w in quality.STOP_WORDS for f in dict.fromkeys((w, w.capitalize())))

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op1_ngram_join": rf"""
        with recursive w as materialized (
          select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
        s as materialized (
          select distinct doc_id, case when len(w) < 4 then array_to_string(w, ' ') else
                 array_to_string(w[i:i + 3], ' ') end as t
          from (select doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) as i from w where len(w) > 0)),
        n as materialized (select doc_id, count(*) as n from s group by 1),
        c as materialized (
          select a.doc_id as a, b.doc_id as b, count(*) as common from s a join s b on a.t = b.t and a.doc_id <> b.doc_id
          group by 1, 2),
        e as materialized (
          select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b
          where 100 * common >= 85 * (x.n + y.n - common)),
        r as (select doc_id as node, doc_id as root from documents
              union select e.b, r.root from r join e on e.a = r.node)
        select d.doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(r.root) as component_id
        from documents d left join n using (doc_id) join r on r.node = d.doc_id group by d.doc_id""",
    "op3_decontamination": rf"""
        with d as materialized (
          select doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
        b as (select cast(item_id as varchar) as item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
              from benchmark),
        win as materialized (
          select distinct item, least(10, len(w)) as k, array_to_string(w[i:i + 9], ' ') as t
          from (select item, w, unnest(range(1, greatest(2, len(w) - 8))) as i from b where len(w) > 0)),
        p as materialized (
          select doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') as t
          from (select doc_id, w, k, unnest(range(1, greatest(1, len(w) - k + 2))) as i
                from d, (select distinct k from win))),
        hit as materialized (select doc_id, i, p.k, item from p join win on p.t = win.t and p.k = win.k),
        cover as (select doc_id, count(distinct x) as n from (select doc_id, unnest(range(i, i + k)) as x from hit) group by 1),
        items as (select doc_id, count(*) as n, string_agg(item, ',' order by item) as names
                  from (select distinct doc_id, item from hit) group by 1)
        select d.doc_id, len(d.w) as n_words, coalesce(cover.n, 0) as n_hit, coalesce(items.n, 0) as n_items,
               sha256(coalesce(items.names, '')) as items_sha256, coalesce(cover.n, 0) > 0 as contaminated
        from d left join cover using (doc_id) left join items using (doc_id)""",
    "op8_chat": r"""
        with c as (
          select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
          union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
        e as (
          select *, length(replace(replace(replace(replace(role || text, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;'), ']',
                    '&rsqb;')) + length('[]' || chr(10) || '</s>' || chr(10)) as n from c)
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
               cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), ''))
                 as loss_sha256,
               cast(sum(n) + length('<s>') as bigint) as formatted_chars
        from e group by conv_id""",
    "op9_url_filter": r"""
        with p as (
          select page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                   'abcdefghijklmnopqrstuvwxyz'), '') as host,
                 coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') as path from pages),
        rules(verdict, h, p) as (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
          ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
        m as (
          select page_id, arg_max(h || rules.p, length(h || rules.p)) as rule, arg_max(verdict, length(h || rules.p)) as own
          from p join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, rules.p) group by 1)
        -- The pages have no redirects or canonical links (checked here), so every alias is the page itself.
        select p.page_id, host, path, rule, coalesce(own, 'allow') as verdict
        from p left join m using (page_id)
        where (select count(*) from pages where html ilike '%canonical%' or html ilike '%http-equiv%') = 0""",
    "op11_quality_rules": rf"""
        with t as (select doc_id, row_number() over () as r, coalesce(text, '') as text from documents),
        p as materialized (
          select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ln from t),
        win as (select r, i, array_to_string(w[i:i + 7], ' ') as h
                from (select r, w, unnest(range(1, greatest(1, len(w) - 6))) as i from p)),
        rep as (select r, i from win qualify count(*) over (partition by r, h) > 1),
        cov as (select r, count(distinct x) as n from (select r, unnest(range(i, i + 8)) as x from rep) group by r),
        m as (
          select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
                 length(text) - length(translate(text, '#*$%&|<>', '')) as n_symbols, len(ln) as n_lines,
                 len(ln) - len(list_distinct(ln)) as n_dup_lines, coalesce(cov.n, 0) as n_repeat_words,
                 len(list_filter(w, lambda x: x in ({_STOPS}))) as n_stops,
                 len(list_filter(ln, lambda x: regexp_matches(x, '^[ \t]*[-*\x{{2022}}]'))) as n_bullets,
                 len(list_filter(ln, lambda x: regexp_matches(x, '(\.\.\.|\x{{2026}})[ \t\r]*$'))) as n_cut
          from p left join cov using (r)),
        f as (
          select *, list_filter([
              case when n_words < 20 then 'few_words' end,
              case when 100 * n_repeat_words > 30 * n_words then 'repeated_words' end,
              case when word_chars < 2.5 * n_words or word_chars > 10 * n_words then 'word_length' end,
              case when 10 * n_symbols > n_words and n_words > 0 then 'symbols' end,
              case when n_words > 0 and 100 * n_stops < 3 * n_words then 'stop_words' end,
              case when n_stops < 2 then 'few_stop_words' end,
              case when 2 * n_dup_lines > n_lines then 'repeated_lines' end,
              case when 10 * n_bullets > 9 * n_lines then 'bullet_lines' end,
              case when 10 * n_cut > 3 * n_lines then 'cut_lines' end], lambda x: x is not null) as failed from m)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               list_has_any(failed, ['few_words', 'repeated_words']) as base_failed, len(failed) = 0 as kept,
               array_to_string(failed, ',') as failed
        from f""",
    "op12_spelling_variants": rf"""
        with recursive r as (
          select run, coalesce(cast(doc_id as varchar), '') || ':' || run as s, count(*) as n
          from (select doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{C0}}-\x{{FF}}]+')) as run from documents)
          where length(run) >= 6 group by all),
        b as (  -- the bytes of document and run: ASCII, or two of U+00C0 to U+00FF
          select run, n, flatten(list_transform(string_split(s, ''), lambda c: case when unicode(c) < 128
                 then [unicode(c)::bigint] else [195::bigint, (unicode(c) - 64)::bigint] end)) as bytes from r),
        h as (
          select run, n, xor(4294967295, list_reduce(bytes, lambda c, x: list_reduce(range(8),
                 lambda k, i: xor(k >> 1, 3988292384 * (k & 1)), xor(c, x)), 4294967295)) as h from b),
        v as materialized (
          select word, cast(sum(n) as bigint) as n
          from (select n, case when h % 199 = 0 then left(run, cast(h % length(run) as int)) ||
                       substr(run, cast(h % length(run) as int) + 2) else run end as word from h)
          where length(word) >= 6 group by word having sum(n) >= 5),
        gone as materialized (
          select word, n, i, left(word, i - 1) || substr(word, i + 1) as rest
          from (select word, n, unnest(range(1, length(word) + 1)) as i from v)),
        near as (
          select a.word, a.n, b.word as near, b.n as m from gone a join gone b
          on a.i = b.i and a.rest = b.rest and a.word <> b.word
          union select a.word, a.n, b.word, b.n from gone a join v b on a.rest = b.word
          union select b.word, b.n, a.word, a.n from gone a join v b on a.rest = b.word),
        best as (
          select word, count(*) as n_near, max(m) as m, arg_min(near, {{'m': -m, 'near': near}}) as near from near group by word),
        f as materialized (
          select v.word, v.n, coalesce(n_near, 0) as n_near, case when m >= 5 * v.n then near end as form,
                 case when m >= 5 * v.n then m end as form_n
          from v left join best using (word)),
        chain as (select word, word as root, form as ahead from f
                  union all select c.word, f.word, f.form from chain c join f on f.word = c.ahead)
        select f.word, form, chain.root, n, n_near, form_n
        from f join chain on chain.word = f.word and chain.ahead is null""",
    "op13_collocations": rf"""
        with pieces as (
          select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) as piece
          from documents),
        w as materialized (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
        total as (select lang, cast(sum(len(w)) as bigint) as n from w group by lang),
        f as materialized (
          select lang, k, phrase, count(*) as f
          from (select lang, k, unnest(list_transform(range(1, greatest(1, len(w) - k + 2)),
                       lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
                from w, (select unnest(range(1, 5)) as k)) group by all having count(*) >= 30),
        cand as materialized (select lang, k as size, phrase, f as a, string_split(phrase, ' ') as p from f where k >= 2),
        cuts as (
          select c.lang, c.phrase, size, a, c.k, x.f as l, y.f as r,
                 cast((2000000::hugeint * a) // (x.f::hugeint + y.f) as bigint) as score
          from (select *, unnest(range(1, size)) as k from cand) c
          join f x on x.lang = c.lang and x.phrase = array_to_string(p[1:c.k], ' ')
          join f y on y.lang = c.lang and y.phrase = array_to_string(p[c.k + 1:], ' ')),
        cut as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1),
        held as (
          select lang, phrase, max(a) as longest
          from (select lang, a, array_to_string(p[i:i + m - 1], ' ') as phrase
                from (select lang, a, p, m, unnest(range(1, size - m + 2)) as i
                      from (select *, unnest(range(2, size)) as m from cand))) group by all),
        best as (
          select cut.*, row_number() over (partition by cut.lang order by score desc, a desc, cut.phrase) as rank
          from cut left join held using (lang, phrase) where longest is null or 100::hugeint * longest < 80::hugeint * a)
        select lang, rank, phrase, a, l, r, n, score from best join total using (lang) where rank <= 2000""",
}
