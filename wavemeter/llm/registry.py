"""The queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from wavemeter.llm.bpe import op5_byte_bpe
from wavemeter.llm.chat import op1_chat_format
from wavemeter.llm.jaccard import op8_jaccard_join
from wavemeter.llm.languages import op11_language_id
from wavemeter.llm.licences import op9_licence_scan
from wavemeter.llm.mixing import PRODUCTION, Mix, op10_source_mix
from wavemeter.llm.negatives import op13_hard_negatives
from wavemeter.llm.passages import op3_passage_dedup
from wavemeter.llm.quality import BOILERPLATE, op4_quality_rules
from wavemeter.llm.runs import op12_periodic_runs
from wavemeter.llm.secrets import op7_secret_scan
from wavemeter.llm.shards import op6_byte_shards
from wavemeter.llm.vectors import op2_vector_dedup

QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_format,
        op2_vector_dedup,
        op3_passage_dedup,
        op4_quality_rules,
        op5_byte_bpe,
        op6_byte_shards,
        op7_secret_scan,
        op8_jaccard_join,
        op9_licence_scan,
        op10_source_mix,
        op11_language_id,
        op12_periodic_runs,
        op13_hard_negatives,
    )
}

_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"


def _mix_sql(mix: Mix = PRODUCTION) -> str:
    """The production mix: a level of the tree after the other, then prefixes by MD5."""
    levels = ["domain", "lang", "source"]
    text = f"""with d as (
        select doc_id, lang, source, len({_WORDS.format("coalesce(text, '')")})::bigint as n_tokens,
            case when regexp_full_match(coalesce(source, ''), 'src[0-9]{{1,9}}')
                then ['web', 'news', 'books', 'talk'][substr(source, 4)::bigint % 4 + 1] else 'other' end as domain
        from documents
    ), leaves as (
        select domain, lang, source, sum(n_tokens)::bigint as available,
            (sum(n_tokens) * {mix.epochs})::bigint as capacity
        from d group by all
    ), b0 as (
        select least(sum(available)::bigint * {mix.share[0]} // {mix.share[1]}, sum(capacity)::bigint) as budget from leaves
    )"""
    for depth, name in enumerate(levels, 1):
        here, above = ", ".join(levels[:depth]), ", ".join(levels[: depth - 1])
        cases = "".join(
            " when " + " and ".join(f"{c} = '{v}'" for c, v in zip(levels, path, strict=False)) + f" then {w}"
            for path, w in mix.weights.items()
            if len(path) == depth
        )
        weight = f"case{cases} else 1 end" if cases else "1"
        part = f"partition by {above}" if above else ""
        window = f"{part} order by capacity::double / weight, {name}"
        using = f"join b{depth - 1} using ({above})" if above else "cross join b0"
        text += f""", n{depth} as (
        select {here}, sum(capacity)::bigint as capacity, sum(available)::bigint as available, {weight} as weight
        from leaves group by {here}
    ), m{depth} as (
        select *, budget - coalesce(sum(capacity) over ({window} rows between unbounded preceding and 1 preceding), 0) as rest,
            sum(weight) over ({part}) - coalesce(sum(weight) over ({window} rows between unbounded preceding and 1 preceding), 0)
                as weights_left
        from n{depth} {using}
    ), f{depth} as (
        select *, rest * weight < capacity * weights_left as open, capacity::double / weight as ratio from m{depth}
    ), o{depth} as (
        select *, arg_min(struct_pack(rest := rest, weights_left := weights_left), struct_pack(a := ratio, b := {name}))
            filter (open) over ({part}) as first_open
        from f{depth}
    ), b{depth} as (
        select {here}, available,
            (case when open then first_open.rest * weight // first_open.weights_left else capacity end)::bigint as budget
        from o{depth}
    )"""
        if depth < len(levels):
            text = text.replace(f"select {here}, available,\n            (case", f"select {here},\n            (case")
    return text + f""", s as (
        select d.*, b3.budget, b3.budget // b3.available as whole, b3.budget % b3.available as rest,
            md5('{mix.seed}:' || (b3.budget // b3.available) || ':' || doc_id) as key
        from d join b3 using (domain, lang, source) where b3.available > 0
    ), p as (
        select *, sum(n_tokens) over (partition by domain, lang, source order by key rows unbounded preceding) as used from s
    )
    select doc_id, domain, lang, source, unnest(range(0, whole + (rest > 0 and used <= rest)::bigint))::integer as epoch,
        n_tokens, budget from p"""


_SYMBOLS, _BARS = "[#*$%&|<>]", "[|>»›•·]"
_ENDS = "('.', '!', '?', '…', '。', '！', '？')"
_PHRASES = "|".join(BOILERPLATE).replace(" ", r"[\x20\x09-\x0D]+")
_QUALITY_SQL = rf"""
    with d as (
        select doc_id, coalesce(text, '') as t from documents
    ), w as (
        select doc_id, t, {_WORDS.format("t")} as ws from d
    ), windows as (
        select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as three
        from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w)
    ), repeated as (
        select doc_id, unnest([i, i + 1, i + 2]) as place
        from (select doc_id, i from windows qualify count(*) over (partition by doc_id, three) > 1)
    ), covered as (
        select doc_id, count(distinct place) as n_repeat_words from repeated group by doc_id
    ), lines as (
        select doc_id, line, {_WORDS.format("line")} as lw,
            trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as t
        from (select doc_id, unnest(string_split(t, chr(10))) as line from d)
    ), judged as (
        select *, len(lw) as n, coalesce(list_sum(list_transform(lw, lambda x: length(x))), 0) as chars,
            len(regexp_extract_all(t, '{_SYMBOLS}')) as symbols, len(regexp_extract_all(t, '{_BARS}')) as bars,
            len(regexp_extract_all(t, '[!?]')) as shouts
        from lines where len(lw) > 0
    ), failed as (
        select *, symbols > 0.3::double * n or (bars >= 3 and bars > 0.2::double * n)
            or shouts > 0.5::double * greatest(n, 4)
            or (length(t) <= 200 and regexp_matches(t, '(?i)(?:^|[^A-Za-z0-9_])(?:{_PHRASES})(?:[^A-Za-z0-9_]|$)'))
            or right(rtrim(t, '"'')]»”’'), 1) not in {_ENDS} as bad
        from judged
    ), by_line as (
        select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines,
            count(*) filter (bad) as n_failed_lines, coalesce(sum(chars) filter (bad), 0)::bigint as lost_chars
        from failed group by doc_id
    ), counted as (
        select doc_id, len(ws)::bigint as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
            len(regexp_extract_all(t, '{_SYMBOLS}'))::bigint as n_symbols,
            coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
            coalesce(n_lines, 0) as n_lines, coalesce(n_failed_lines, 0) as n_failed_lines, coalesce(lost_chars, 0) as lost_chars
        from w left join by_line using (doc_id) left join covered using (doc_id)
    )
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
        not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and lost_chars <= 0.5::double * word_chars as kept
    from counted
"""

_NEGATIVES_SQL = """
    with r as (
        select distinct vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
            list_transform(embedding, lambda x: floor(256 * x::double)) as q
        from embeddings
        where vec_id is not null and label is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), scored as (
        select a.id as anchor_id, r.id, r.label = a.label as own, list_inner_product(a.q, r.q)::bigint as score
        from r a, r where a.id % 50 = 0 and a.id <> r.id
    ), positives as (
        select anchor_id, id as positive_id, score as positive_score from scored where own
        qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
    )
    select anchor_id, positive_id,
        row_number() over (partition by anchor_id, positive_id order by n.score desc, n.id)::integer as rank,
        n.id as negative_id, positive_score, n.score as negative_score
    from positives join scored n using (anchor_id)
    where not own and 50 * positive_score <= 100 * n.score and 100 * n.score <= 95 * positive_score
    qualify rank <= 3
"""

ORACLES = {
    # The digests follow from the turns alone: formatting and reading back must change nothing.
    "op1_chat_format": r"""
        with added as (
            select conv_id, turn, role, coalesce(text, '') as text from conversations
            union all
            select -1, n, r, '<|im_end|><|im_start|>assistant ok'
            from (values (0, 'user'), (1, 'assistant')) v(n, r)
        ), moves(state, role, to_state) as (
            values ('begin', 'system', 'briefed'), ('begin', 'user', 'asked'),
                   ('briefed', 'user', 'asked'), ('asked', 'assistant', 'answered'),
                   ('asked', 'tool', 'asked'), ('answered', 'user', 'asked'),
                   ('answered', 'tool', 'asked')
        ), placed as (
            select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as n,
                   lag(role) over (partition by conv_id order by turn nulls first, role, text) as before
            from added
        ), judged as (
            -- the state after a role is known from the role, so one turn back decides
            select p.*, case
                when p.before is null then p.role in ('system', 'user')
                when p.before = 'system' then p.role = 'user'
                when p.before in ('user', 'tool') then p.role in ('assistant', 'tool')
                when p.before = 'assistant' then p.role in ('user', 'tool')
                else false end as fits
            from placed p
        )
        select conv_id,
               count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
               coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by n) filter (role = 'assistant'), '')) as loss_sha256,
               sum(length('<|im_start|>') + length(role) + 1 + length(text) + length('<|im_end|>') + 1
                   + len(regexp_extract_all(text, '<\\*\|')))::bigint as formatted_chars,
               bool_and(fits) and arg_max(role, n) = 'assistant' as valid
        from judged group by conv_id
    """,
    "op4_quality_rules": _QUALITY_SQL,
    "op10_source_mix": _mix_sql(),
    "op13_hard_negatives": _NEGATIVES_SQL,
}


def queries() -> dict:
    import corpus_pipeline

    return {**QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    out = dict(ORACLES)
    if corpus_pipeline.ORACLE_SQL:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
