"""The registered queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroweave.llm import (
    conversations, decontaminate, divergence, gam, html, language_model, lines, mixing, quality, repeats, simhash, topk, urls,
)

#: Rules of the URL query: host, path, verdict.
URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to equal shares of all sources, at the size of the corpus; ``copy`` replaces a column of that name."""
    return mixing.mix_sources(_table(spark, sf_dir, "documents").drop("copy")).withColumnRenamed("__copy", "copy")


def op2_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(_table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def op3_dedup_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.dedup_substrings(_table(spark, sf_dir, "documents")).drop("kept")


def op4_extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(_table(spark, sf_dir, "pages"))


def op5_filter_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.filter_urls(_table(spark, sf_dir, "pages"), rules)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(_table(spark, sf_dir, "documents"))


def op7_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) where the document holds the item."""
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_score_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gam.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_score_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(_table(spark, sf_dir, "documents"))


def op10_spread_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without cross-site boilerplate lines."""
    return lines.dedup_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"),
        F.sha2(F.col("text"), 256).alias("kept_sha256"), F.length("text").alias("kept_chars"))


def op11_audit_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(_table(spark, sf_dir, "documents"))


def op12_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit(_table(spark, sf_dir, "conversations"), damage=True)


def op13_top_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_simhash_groups, op3_dedup_substrings, op4_extract_text, op5_filter_urls, op6_quality_rules,
    op7_benchmark_leaks, op8_score_quality, op9_score_texts, op10_spread_lines,
    op11_audit_sources, op12_repair_conversations, op13_top_scores,
)}


def _edit(state: str, cost: str, edit: str, row: str = "") -> str:
    """A state's best way with one edit more, as SQL."""
    return (f"case when {state} is not null then {{'c': {state}.c + {cost}, 'a': {state}.a || '{edit}', "
            f"'o': {state}.o{f' || chr(10) || {row}' if row else ''}}} end")


def _least(*ways: str) -> str:
    return f"list_min(list_filter([{', '.join(ways)}], lambda w: w is not null))"


def _repair_sql() -> str:
    """Least ways to the four states (e: nothing, y: system, u: open user, p: pairs), one row after the other."""
    gone, own = "case when not gone then {} end", "role || ':' || text"

    def kept(state: str, initial: str) -> str:
        return f"case when not gone and initial = '{initial}' then {_edit(state, 'worn', 'K', own)} end"

    def changed(state: str, role: str) -> str:
        return gone.format(_edit(state, "worn + 1", "R", f"'{role}:' || text"))

    steps = {
        "e": [_edit("e", "2", "D")], "y": [_edit("y", "2", "D"), kept("e", "s")],
        "u": [_edit("u", "2", "D"), *[kept(s, "u") for s in "eyp"], *[changed(s, "user") for s in "eyp"]],
        "p": [_edit("p", "2", "D"), kept("u", "a"), changed("u", "assistant")],
    }
    moved = ", ".join(f"{_least(*ways)} as {state}" for state, ways in steps.items())
    opened = _least("u", *[_edit(s, "5", "I", "'user:'") for s in "eyp"])
    paired = _least("p", _edit("u", "5", "I", "'assistant:'"))
    hashed = """list_transform(range(1, length(case_of) + 1), lambda k: ascii(substr(case_of, k, 1))::bigint)"""
    return f"""
        with recursive bytes as (select list(v order by i) as tb from (select i, list_reduce([i, 0, 1, 2, 3, 4, 5, 6, 7],
            lambda a, k: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as v from range(256) r(i))),
        named as (select conv_id as conv, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
            coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as case_of from conversations),
        cases as (select conv, turn, role, text, xor(list_reduce([4294967295::bigint] || {hashed},
            lambda a, b: xor(a >> 8, tb[(xor(a, b) & 255) + 1])), 4294967295) % 20 as k from named, bytes),
        spoiled as (select conv, turn, case when k = 4 then 'user' else role end as role, case when k = 1 then ''
            when k = 2 then translate(text, '.!?', '') else text end as text, case k when 0 then 0 when 3 then 2 else 1 end as n
            from cases),
        present as (select conv, turn, role, text, substr(role, 1, 1) as initial,
            row_number() over (partition by conv order by turn nulls first, role, sha256(text)) as pos
            from spoiled, range(n)),
        marked as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]') as ink,
            row_number() over (partition by conv, role, text order by pos) > 1 as again,
            lag(initial) over (partition by conv order by pos) as before from present),
        rows as (select conv, turn, pos, role, text, initial, before, len(ink) = 0 as blank, len(ink) > 0 and again as duplicate,
            len(ink) = 0 or again as gone, not again and len(ink) > 0 and ink[-1] not in ('.', '!', '?') as truncated from marked),
        priced as (select *, case when truncated then 5 else 0 end as worn from rows),
        ways as (
            select conv, 0::bigint as pos, {{'c': 0, 'a': '', 'o': ''}} as e, null::struct(c integer, a varchar, o varchar) as y,
                {{'c': 5, 'a': 'I', 'o': chr(10) || 'user:'}} as u,
                {{'c': 10, 'a': 'II', 'o': chr(10) || 'user:' || chr(10) || 'assistant:'}} as p
            from (select distinct conv from spoiled)
            union all
            select conv, pos, e, y, u, {paired} as p from (select conv, pos, e, y, {opened} as u, p from (
                select r.conv, r.pos, {moved} from ways w join priced r
                    on w.conv is not distinct from r.conv and r.pos = w.pos + 1))),
        best as (select conv, {_least("e", "p")} as b from ways qualify row_number() over (partition by conv order by pos desc) = 1),
        counted as (select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
            count(*) filter (where blank) as blank, count(*) filter (where duplicate) as duplicate,
            count(*) filter (where truncated) as truncated,
            count(*) filter (where before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
            from rows group by conv)
        select b.conv as conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
            coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, b.b.c::bigint as cost, b.b.a as audit,
            sha256(substr(b.b.o, 2)) as repaired_sha256
        from best b left join counted c on b.conv is not distinct from c.conv"""


SQL = {
    "op6_quality_rules": r"""
        with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as text, coalesce(source, chr(0)) as host
            from documents),
        w as (select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words from d),
        ws as (select rid, unnest(words) as word, generate_subscripts(words, 1) as i from w),
        wins as (select rid, i, word || chr(10) || lead(word, 1) over o || chr(10) || lead(word, 2) over o || chr(10)
            || lead(word, 3) over o || chr(10) || lead(word, 4) over o as win from ws window o as (partition by rid order by i)),
        twice as (select rid, i, count(*) over (partition by rid, win) > 1 as hit from wins where win is not null),
        near as (select a.rid, a.i, max(coalesce(t.hit, false)::int) over (partition by a.rid order by a.i
            rows between 4 preceding and current row) as hit from ws a left join twice t on a.rid = t.rid and a.i = t.i),
        rep as (select rid, sum(hit)::bigint as n_repeat_words from near group by rid),
        ls as (select rid, doc_id, host, hash(text) as tk, unnest(string_split(text, chr(10))) as line,
            generate_subscripts(string_split(text, chr(10)), 1) as i from d),
        lw as (select *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') as ws from ls),
        lk as (select *, translate(array_to_string(ws, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789',
            'abcdefghijklmnopqrstuvwxyz000000000') as key, row_number() over (partition by rid, line order by i) > 1 as dup
            from lw where len(ws) > 0),
        hosts as (select host, count(distinct text) as n from d group by host),
        common as (select host, key from lk join hosts using (host) group by host, key, n
            having count(distinct tk) >= 20 and count(distinct tk) ** 2 > 4 * n),
        per as (select rid, sum(dup::int)::bigint as n_dup_lines,
            coalesce(sum(len(ws)) filter (where c.key is not null), 0)::bigint as lost
            from lk left join common c on lk.host = c.host and lk.key = c.key group by rid),
        base as (select doc_id, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
            (length(text) - length(translate(text, '#*$%&|<>', '')))::bigint as n_symbols,
            coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
            coalesce(lost, 0) as n_common_words from w left join rep using (rid) left join per using (rid))
        select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
            not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and n_words - n_common_words >= 0.2 * n_words as kept
        from base""",
    "op5_filter_urls": """
        with rules(host, path, verdict) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
            ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        rest as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) end as rest from pages),
        parts as (select page_id, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
            coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path from rest),
        fits as (select p.page_id, p.host, p.path, r.host || r.path as rule, r.verdict,
            row_number() over (partition by p.page_id order by length(r.host || r.path) desc nulls last,
                length(r.host) desc, r.verdict desc) as k
            from parts p left join rules r on (p.host = r.host or ends_with(p.host, '.' || r.host))
                and starts_with(p.path, r.path))
        select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from fits where k = 1""",
    "op10_spread_lines": r"""
        with split as (select doc_id, text, coalesce(source, chr(1)) as site, string_split(text, chr(10)) as ls from documents),
        each as (select doc_id, site, unnest(ls) as line, generate_subscripts(ls, 1) as pos from split),
        keyed as (select *, lower(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')) as key from each),
        spread as (select key, min(doc_id) as first_doc from keyed where key <> '' group by key
            having count(distinct site) >= 10),
        marked as (select k.*, s.key is not null and not (k.doc_id = s.first_doc and k.pos = min(k.pos) over (
            partition by k.doc_id, k.key)) as gone from keyed k left join spread s using (key)),
        cut as (select doc_id, count(*)::int as n_lines, (count(*) filter (where gone))::int as n_removed,
            coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '') as kept from marked group by doc_id)
        select doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed,
            sha256(kept) as kept_sha256, length(kept)::int as kept_chars from documents left join cut using (doc_id)""",
    "op1_mix_sources": """
        with sized as (select coalesce(source, chr(1)) as grp, sum(coalesce(length(text), 0)) as chars from documents group by 1),
        rates as (select grp, case when chars > 0 then sum(chars) over () * 1.0 / (count(*) filter (where chars > 0) over ()) / chars
            else 0 end as rate from sized),
        ks as (select grp, rate, unnest(generate_series(0, (rate + 12 * sqrt(rate) + 40)::bigint)) as k from rates where rate > 0),
        pmf as (select grp, rate, k, exp(k * ln(rate) - rate - lgamma(k + 1)) as p from ks),
        cdf as (select grp, k, sum(p) over (partition by grp order by k) as c from pmf),
        u as (select *, coalesce(source, chr(1)) as grp, (('0x' || substr(md5('copies:20240:' || coalesce(doc_id::varchar,
            'null')), 1, 12))::bigint + 0.5) / 281474976710656.0 as u from documents),
        n as (select u.doc_id, u.text, u.lang, u.source, u.n_chars, count(*) filter (where c.c < u.u) as n
            from u join cdf c using (grp) group by all)
        select doc_id, text, lang, source, n_chars, unnest(generate_series(1, n))::int as copy from n""",
    "op11_audit_sources": r"""
        with d as (select row_number() over () as rid, coalesce(text, '') as text, coalesce(lang, '') as lang,
            coalesce(source, '') as source from documents),
        words as (select rid, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from d),
        kept as (select lang, term, count(*) as n from words group by lang, term having count(distinct rid) >= 30),
        vocabulary as (select lang, count(*) as v, sum(n) as total from kept group by lang),
        groups as (select distinct lang, source from d),
        counts as (select lang, source, term, count(*) as n from words group by all),
        cells as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n, k.n as lang_n
            from groups g join kept k using (lang) left join counts c using (lang, source, term)),
        shares as (select lang, source, term, n,
            1 + (1000000000::hugeint * (n + 5)) // (sum(n) over (partition by lang, source) + 5 * v) as p,
            1 + (1000000000::hugeint * (lang_n + 5)) // (total + 5 * v) as q from cells join vocabulary using (lang)),
        apart as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
            from shares a join shares b using (lang, term) where a.source <> b.source group by all),
        pairs as (select g.lang, g.source, 'pair' as part, h.source as item, coalesce(a.value, 0)::bigint as value
            from groups g join groups h on g.lang = h.lang and g.source <> h.source
            left join apart a on a.lang = g.lang and a.source = g.source and a.item = h.source),
        terms as (select lang, source, 'term' as part, term as item, (p - q)::bigint as value from shares where n > 0 and p > q)
        select *, (row_number() over (partition by lang, source order by value desc, item))::int as rank from pairs
        union all
        select *, (row_number() over (partition by lang, source order by value desc, item))::int as rank from terms
        qualify rank <= 50""",
    "op12_repair_conversations": _repair_sql(),
    "op13_top_scores": """
        with v as (select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as e
            from embeddings where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (select q.r, q.vec_id as query, c.vec_id, list_dot_product(c.e, q.e)::bigint as score
            from v q join v c on q.r <> c.r where q.vec_id % 20 = 0)
        select query, (row_number() over (partition by r order by score desc, vec_id nulls last))::int as rank, vec_id, score
        from scored qualify rank <= 20""",
}
