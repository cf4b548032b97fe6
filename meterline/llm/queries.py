"""The corpus operators as registered queries, with SQL where it can say the same."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline.llm import (chat, conversation_repair, decontamination, near_duplicates, packing, personal_data, product_search,
                           quality_rules, tokens, toxicity, url_rules, vector_codes, warc)
from meterline.llm.common import table

#: Listed host and path rules with their verdicts.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
PROBE = "</s>[INST] ok [/INST]"


def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_archives(table(spark, sf_dir, "pages"))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], turns.schema)
    return chat.written_and_read(turns.union(probe))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def private(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find(table(spark, sf_dir, "documents"))


def near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"))


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), URL_RULES)


def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_search.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": decontaminate,
    "op2_warc": archives,
    "op3_toxicity": toxic,
    "op4_chat": chats,
    "op5_quality_rules": quality,
    "op6_personal_data": private,
    "op7_near_duplicates": near,
    "op8_token_counts": token_counts,
    "op9_packing": packed,
    "op10_url_rules": urls,
    "op11_top_products": top_products,
    "op12_conversation_repair": repairs,
    "op13_vector_codes": codes,
    "pipeline": pipeline,
}

def _codes_sql(rounds: int = 4, entries: int = 256) -> str:
    """The rounds unrolled: each assigns all parts by brute force and takes the floors of the means."""
    nearest = """a{r} as materialized (
        select p.place, p.part, min((p.nn + b.nn - 2 * list_inner_product(p.v, b.v)) * 256 + b.entry)::bigint as best
        from p join b{r} b on p.part = b.part group by p.place, p.part)"""
    update = """m{r} as materialized (
        select part, entry, list(mean order by pos) as v from (
            select part, entry, pos, floor(sum(c) / count(*)) as mean from (
                select p.part, a.best % 256 as entry, unnest(p.v) as c, unnest(range(len(p.v))) as pos
                from p join a{r} a on p.place = a.place and p.part = a.part) group by part, entry, pos)
        group by part, entry),
        b{n} as materialized (
        select b.part, b.entry, coalesce(m.v, b.v) as v, list_inner_product(coalesce(m.v, b.v), coalesce(m.v, b.v)) as nn
        from b{r} b left join m{r} m on b.part = m.part and b.entry = m.entry)"""
    steps = [nearest.format(r=0)]
    for r in range(rounds):
        steps += [update.format(r=r, n=r + 1), nearest.format(r=r + 1)]
    return f"""
        with w as materialized (
            select row_number() over (order by vec_id) as place, vec_id, label,
                   list_transform(embedding, lambda x: floor(1024 * x::double)) as x
            from embeddings where embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        p as materialized (
            select *, list_inner_product(v, v) as nn from (
                select place, part, x[part * len(x) // 4 + 1:(part + 1) * len(x) // 4] as v
                from w, range(4) as parts(part))),
        b0 as materialized (select part, place - 1 as entry, v, nn from p where place <= {entries}),
        {", ".join(steps)},
        c as (select w.vec_id, w.label, string_agg(printf('%02x', a.best % 256), '' order by a.part) as code,
                     sum(a.best // 256)::bigint as error
              from w join a{rounds} a on w.place = a.place group by w.place, w.vec_id, w.label)
        select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error,
               (select sha256(string_agg(t, ',' order by part, entry)) from (
                    select part, entry, array_to_string(list_transform(v, lambda y: y::bigint), ',') as t
                    from b{rounds})) as codebooks_sha256
        from c"""


def _repair_sql() -> str:
    """The cheapest edits by dynamic programming: a state is (cost and edits, lines), compared as text.

    A state stands for what was said last: nothing, system, user, assistant.
    Each row is two steps, insertions and the row itself.
    """
    def add(state: str, cost: str, letter: str, line: str = "''") -> str:
        return (f"{{'k': lpad((substr({state}.k, 1, 8)::bigint + {cost})::varchar, 8, '0') || substr({state}.k, 9) || "
                f"'{letter}', 'r': {state}.r || {line}}}")

    def unless(condition: str, state: str) -> str:
        return f"case when {condition} then {state} else {never} end"
    never = "{'k': '90000000', 'r': ''}"
    said = lambda role: f"chr(10) || '{role}:'"
    own, user, assistant = "chr(10) || x.role || ':' || x.text", f"{said('user')} || x.text", f"{said('assistant')} || x.text"
    insert = f"""least(a.s2, {add('a.s0', '2', 'I', said('user'))}, {add('a.s1', '2', 'I', said('user'))},
                       {add('a.s3', '2', 'I', said('user'))})"""
    twice = f"least(a.s3, {add('a.s2', '2', 'I', said('assistant'))})"
    stays = "not x.gone and x.role[1] = "
    to_user = ", ".join([unless("not x.gone", add(f"a.{s}", "2 + x.t", "R", user)) + ", " + unless(
        f"{stays}'u'", add(f"a.{s}", "x.t", "K", own)) for s in ("s0", "s1", "s3")])
    return f"""
        with crcs as (select list(v order by i) as t from (
            select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
                case when (c & 1) = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
            from (select unnest(range(256)) as i))),
        k as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
                     coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name from conversations),
        h as (select k.*, xor(list_reduce(
                  list_concat([4294967295], list_transform(string_split(name, ''), lambda c: ascii(c)::bigint)),
                  lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 as hit from k, crcs),
        d as (select conv_id, turn, case when hit = 4 then 'user' else role end as role,
                     case hit when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
              from h, range(2) as copies(copy) where hit <> 0 and (copy = 0 or hit = 3)),
        r as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as place from d),
        o as (select *, row_number() over (partition by conv_id, role, text order by place) as nth,
                     regexp_replace(text, '[\x20\x09-\x0D]+$', '') as body from r),
        f as (select *, case when body = '' then 'blank' when nth > 1 then 'duplicate'
                             when right(body, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
                     lag(role) over (partition by conv_id order by place) as before from o),
        steps as (select conv_id, place, step, role, text, fault in ('blank', 'duplicate') as gone,
                         (fault = 'truncated')::bigint as t from f, range(3) as s(step)
                  union all select conv_id, 0, 3, '', '', false, 0 from f group by conv_id
                  union all select conv_id, max(place) + 1, step, '', '', false, 0 from f, range(2) as s(step)
                  group by conv_id, step),
        lists as (select conv_id, list({{'s0': {{'k': '00000000', 'r': ''}}, 's1': {never}, 's2': {never}, 's3': {never},
                          'step': step, 'role': role, 'text': text, 'gone': gone, 't': t}} order by place, step) as l
                  from steps group by conv_id),
        ends as (select conv_id, list_reduce(l, lambda a, x: case x.step
            when 0 then {{'s0': a.s0, 's1': a.s1, 's2': {insert}, 's3': a.s3, 'step': x.step, 'role': x.role,
                          'text': x.text, 'gone': x.gone, 't': x.t}}
            when 1 then {{'s0': a.s0, 's1': a.s1, 's2': a.s2, 's3': {twice}, 'step': x.step, 'role': x.role,
                          'text': x.text, 'gone': x.gone, 't': x.t}}
            else {{'s0': {add('a.s0', '3', 'D')},
                   's1': least({add('a.s1', '3', 'D')}, {unless(stays + "'s'", add('a.s0', 'x.t', 'K', own))}),
                   's2': least({add('a.s2', '3', 'D')}, {to_user}),
                   's3': least({add('a.s3', '3', 'D')}, {unless('not x.gone', add('a.s2', '2 + x.t', 'R', assistant))},
                               {unless(stays + "'a'", add('a.s2', 'x.t', 'K', own))}),
                   'step': x.step, 'role': x.role, 'text': x.text, 'gone': x.gone, 't': x.t}} end) as a
            from lists),
        best as (select conv_id, least(a.s0, a.s3) as b from ends),
        counts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
                          count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
                          count(*) filter (fault = 'truncated') as truncated,
                          count(*) filter (before is not null and left(before, 1) || left(role, 1) not in ('su', 'ua', 'au'))
                              as illegal from f group by conv_id)
        select i.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
               coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
               coalesce(substr(b.k, 1, 8)::bigint, 0) as cost, coalesce(substr(b.k, 9), '') as audit,
               sha256(coalesce(substr(b.r, 2), '')) as repaired_sha256
        from (select distinct conv_id from conversations) i
        left join counts on i.conv_id is not distinct from counts.conv_id
        left join best on i.conv_id is not distinct from best.conv_id"""


#: Queries without an entry have no SQL counterpart and are tested by brute force.
ORACLE_SQL: dict[str, str] = {
    "op2_warc": """
        with p as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest
                   from pages),
        o as (select *, max(page_id) over (partition by payload_digest) as original from p)
        select page_id, payload_bytes, payload_digest,
               case when payload_bytes >= 1000 and page_id <> original then 'revisit' else 'response' end as record_type,
               case when payload_bytes >= 1000 and page_id <> original then original end as refers_to
        from o""",
    "op4_chat": """
        with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
                   union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
                   union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        m as (select *, lag(role) over (partition by conv_id order by turn, role, text) as before,
                     row_number() over (partition by conv_id order by turn, role, text) - 1 as place,
                     length(text) + length(regexp_replace(text, '\\\\|<\\|im_start\\|>|<\\|im_end\\|>|<\\|endoftext\\|>|<s>|</s>|\\[INST\\]|\\[/INST\\]', 'x\\0', 'g'))
                       - length(text) + length('<|im_start|>') + length(role) + 1 + length('<|im_end|>') + 1 as chars
              from t),
        v as (select *, case when before is null then role in ('system', 'user') when before = 'system' then role = 'user'
                             when before = 'user' then role = 'assistant' when before = 'assistant' then role in ('user', 'tool')
                             when before = 'tool' then role = 'assistant' else false end as allowed from m)
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
               coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by place) filter (role = 'assistant'), '')) as loss_sha256,
               sum(chars)::bigint as formatted_chars,
               coalesce(min(place) filter (not allowed), case when arg_max(role, place) <> 'assistant' then count(*) end) is null as valid,
               coalesce(min(place) filter (not allowed), case when arg_max(role, place) <> 'assistant' then count(*) end) as first_error
        from v group by conv_id""",
    "op11_top_products": """
        with v as (select row_number() over () as place, vec_id,
                          list_transform(embedding, lambda x: floor(256 * x::double)) as x
                   from embeddings
                   where embedding is not null
                     and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        p as (select q.place, q.vec_id as query_id, c.vec_id, list_inner_product(q.x, c.x)::bigint as score
              from v q join v c on q.place <> c.place where q.vec_id % 50 = 0),
        r as (select *, row_number() over (partition by place order by score desc, vec_id) as rank from p)
        select query_id, rank::int as rank, vec_id, score from r where rank <= 5""",
    "op13_vector_codes": _codes_sql(),
    "op12_conversation_repair": _repair_sql(),
}
