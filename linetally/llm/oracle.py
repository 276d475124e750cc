"""DuckDB SQL for the queries that SQL can express, written independently of the operators."""

from __future__ import annotations

from linetally.llm.chat import BEGIN, CONTROL
from linetally.llm.mixing import MEAN_PER_DRAW, MOST_PER_DRAW
from linetally.llm.quality import RATES, TWO_SIDED, Fences

WORD = r"[^\x20\x09-\x0D]+"


def quality_sql(fences: Fences = Fences()) -> str:
    slack = dict(fences.slack)

    def rate(name: str) -> str:
        part, whole = RATES[name]
        return f"coalesce({part} * 1000 // nullif({whole}, 0), 0)"

    rates = " union all ".join(
        f"select lang, source, '{name}' as rate, {rate(name)} as v from measured where not base_failed" for name in RATES
    )
    slack_of = " ".join(f"when '{name}' then {slack[name]}" for name in RATES)

    checks = " and ".join(
        [f"max({rate(name)}) filter (f.rate = '{name}') <= max(f.q2 + f.reach) filter (f.rate = '{name}')" for name in RATES]
        + [
            f"max({rate(name)}) filter (f.rate = '{name}') >= max(f.q2 - f.reach) filter (f.rate = '{name}')"
            for name in TWO_SIDED
        ]
    )
    return f"""
    with texts as (
        select row_number() over () as r, doc_id, lang, source, coalesce(text, '') as t from documents),
    split as (
        select *, regexp_extract_all(t, '{WORD}') as w,
               [x for x in string_split(t, chr(10)) if regexp_matches(x, '{WORD}')] as l from texts),
    windows as (
        select r, i, w[i + 1:i + 8] as words
        from (select r, w, unnest(range(greatest(len(w) - 7, 0))) as i from split)),
    repeated as (
        select r, count(distinct place)::bigint as n_repeat_words
        from (select r, unnest(range(i, i + 8)) as place
              from (select r, i, count(*) over (partition by r, words) as n from windows) where n >= 2)
        group by r),
    counted as (
        select s.r, doc_id, lang, source, len(w)::bigint as n_words,
               length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::bigint as word_chars,
               (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
               len(l)::bigint as n_lines, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
               coalesce(n_repeat_words, 0)::bigint as n_repeat_words
        from split s left join repeated p on s.r = p.r),
    measured as (
        select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from counted),
    rated as ({rates}),
    binned as (
        select lang, source, rate, (v >> greatest(length(bin(v)) - 5, 0)) << greatest(length(bin(v)) - 5, 0) as bin
        from rated),
    own as (select lang, source, rate, bin, count(*)::hugeint as n from binned group by all),
    by_lang as (select lang, rate, bin, sum(n)::hugeint as n from own group by all),
    mixed as (
        select o.lang, o.source, o.rate, o.bin, o.n * t.total as n
        from own o join (select lang, rate, sum(n)::hugeint as total from by_lang group by all) t
          on o.lang is not distinct from t.lang and o.rate = t.rate
        union all
        select g.lang, g.source, g.rate, b.bin, {fences.prior} * b.n
        from (select distinct lang, source, rate from own) g join by_lang b
          on g.lang is not distinct from b.lang and g.rate = b.rate),
    running as (
        select *, sum(n) over (partition by lang, source, rate order by bin) as upto,
               sum(n) over (partition by lang, source, rate) as total
        from (select lang, source, rate, bin, sum(n) as n from mixed group by all)),
    fences as (
        select lang, source, rate, min(bin) filter (upto * 4 >= total * 2) as q2,
               (min(bin) filter (upto * 4 >= total * 3) - min(bin) filter (upto * 4 >= total)) * {fences.spread}
                 + case rate {slack_of} end as reach
        from running group by lang, source, rate),
    judged as (
        select m.r, {checks} as inside
        from measured m join fences f
          on m.lang is not distinct from f.lang and m.source is not distinct from f.source
        group by m.r)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           not base_failed and coalesce(inside, false) as kept
    from measured m left join judged j on m.r = j.r"""


def chat_sql() -> str:
    escaped = "replace(text, '\\', '\\\\')"
    for control in CONTROL:
        escaped = f"replace({escaped}, '{control}', '{control[0]}\\{control[1:]}')"
    frame = len(BEGIN) + len("\n") + len("</s>\n")
    return f"""
    with turns as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
        union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
    trained as (
        select conv_id, coalesce(string_agg(text, '' order by turn, text) filter (role = 'assistant'), '') as loss,
               string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as turns,
               count(*) as n_turns, sum(length(role) + length({escaped}) + {frame})::bigint as formatted_chars
        from turns group by conv_id)
    select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss)::bigint as loss_chars,
           sha256(loss) as loss_sha256, formatted_chars, 0::bigint as n_rewrites
    from trained"""


def mixing_sql(weights: dict[str, float], rest_weight: float, seed: str = "mix") -> str:
    named = ", ".join(f"('{name}', {weight!r}::double)" for name, weight in weights.items())
    everything = float(sum(weights.values()) + rest_weight)
    return f"""
    with recursive named(name, weight) as (values {named}),
    docs as (
        select row_number() over () as r, d.*, coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, '')) as id, name,
               coalesce(weight, {float(rest_weight)!r}::double) as weight
        from documents d left join named on d.source = name),
    sizes as (
        select name, any_value(weight) as weight, sum(coalesce(strlen(text), 0))::double as size from docs group by name),
    rates as (
        select name, case when size = 0 then 1.0::double
                     else (select sum(size) from sizes) * 1.0::double * weight / ({everything!r}::double * size) end as rate
        from sizes),
    means as (
        select name, greatest(ceil(rate / {MEAN_PER_DRAW!r}::double), 1)::bigint as draws, rate / draws as mean from rates),
    cdf(name, mean, k, p, c) as (
        select name, mean, 0, exp(-mean), exp(-mean) from means
        union all
        select name, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) from cdf where k + 1 < {MOST_PER_DRAW}),
    drawn as (
        select r, docs.name, ('0x' || substr(md5('{seed}:' || id || ':' || draw), 1, 13))::bigint::double
                             / 4503599627370496.0::double as u
        from (select r, id, docs.name, unnest(range(1, draws + 1)) as draw
              from docs join means on docs.name is not distinct from means.name) as docs),
    copies as (
        select r, count(*) as n from drawn join cdf on drawn.name is not distinct from cdf.name and c <= u group by r)
    select doc_id, text, lang, source, n_chars, unnest(range(1, n + 1)) as copy
    from docs join copies on docs.r = copies.r"""


def substring_sql() -> str:
    return f"""
    with split as (
        select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents),
    windows as (
        select r, doc_id, i, sha256(array_to_string(w[i + 1:i + 13], ' ')) as h
        from (select r, doc_id, w, unnest(range(greatest(len(w) - 12, 0))) as i from split)),
    late as (
        select r, i from (select *, min(doc_id) over (partition by h) as first from windows) where first < doc_id),
    gone as (select distinct r, unnest(range(i, i + 13)) as place from late),
    kept as (
        select s.r, string_agg(s.word, ' ' order by s.place) as text
        from (select r, unnest(w) as word, unnest(range(len(w))) as place from split) s
        left join gone g on s.r = g.r and s.place = g.place where g.r is null group by s.r),
    removed as (select r, count(*) as n from gone group by r)
    select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed,
           sha256(coalesce(kept.text, '')) as kept_sha256
    from split left join kept on split.r = kept.r left join removed on split.r = removed.r"""


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit: each byte is followed by seven steps without one."""
    steps = f"list_transform(string_split({text}, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1])"
    mixed = "case when x >= 0 then xor(a, x) else a end"
    step = f"xor(({mixed}) >> 1, 3988292384::bigint * (({mixed}) & 1))"
    return f"xor(list_reduce(list_concat([4294967295::bigint], flatten({steps})), lambda a, x: {step}), 4294967295::bigint)"


def repair_sql() -> str:
    """Dynamic programming over the rows: the best (cost, edits, lines) for each last role."""

    def then(label: str, cost: object, edit: str, line: str = "''") -> str:
        return (
            f"case when {label} is not null then struct_pack(cost := {label}.cost + {cost}, "
            f"audit := {label}.audit || '{edit}', lines := {label}.lines || {line}) end"
        )

    def inserted(table: str) -> str:
        """Labels with turns inserted after them, where that is better."""
        user, assistant = "'user:' || chr(10)", "'assistant:' || chr(10)"
        both = f"{user} || {assistant}"
        two = [f"least({table}.l2, {', '.join(then(f'{table}.l{s}', 2, 'I', user) for s in (0, 1, 3))}) as l2"]
        three = [
            f"least({table}.l3, {then(f'{table}.l2', 2, 'I', assistant)}, "
            f"{', '.join(then(f'{table}.l{s}', 4, 'II', both) for s in (0, 1))}) as l3"
        ]
        return ", ".join([f"{table}.l0 as l0", f"{table}.l1 as l1", *two, *three])

    kept, renamed = "r.role || ':' || r.text || chr(10)", "':' || r.text || chr(10)"

    def kept_if(initial: str, states: tuple[int, ...]) -> str:
        moves = ", ".join(then(f"c.l{s}", "r.cut", "K", kept) for s in states)
        best = f"least({moves})" if len(states) > 1 else moves
        return f"case when not r.gone and r.initial = '{initial}' then {best} end"

    def renamed_to(role: str, states: tuple[int, ...]) -> str:
        moves = ", ".join(then(f"c.l{s}", "2 + r.cut", "R", f"'{role}' || {renamed}") for s in states)
        best = f"least({moves})" if len(states) > 1 else moves
        return f"case when not r.gone then {best} end"

    deleted = {s: then(f"c.l{s}", 3, "D") for s in range(4)}
    label = "struct_pack(cost := {}::bigint, audit := {}::varchar, lines := {}::varchar)"
    start, none = label.format(0, "''", "''"), f"case when false then {label.format(0, chr(39) * 2, chr(39) * 2)} end"
    return f"""
    with recursive given as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
               {crc32_sql("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as fault
        from conversations),
    damaged as (
        select conv_id, turn, case when fault = 4 then 'user' else role end as role,
               case fault when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
               unnest(range(case fault when 0 then 0 when 3 then 2 else 1 end)) as again
        from given),
    placed as (
        select conv_id, turn, role, text, role[1] as initial,
               row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
               regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g') as visible
        from damaged),
    faulty as (
        select *, row_number() over (partition by conv_id, role, text order by i) as nth,
               case when visible = '' then 'blank' when nth > 1 then 'duplicate'
                       when visible[-1] not in ('.', '!', '?') then 'truncated' else '' end as fault,
               lag(initial) over (partition by conv_id order by i) || initial as pair from placed),
    steps as (
        select conv_id, i, role, text, initial, fault in ('blank', 'duplicate') as gone,
               (fault = 'truncated')::bigint as cut from faulty),
    counted as (
        select g.conv_id, coalesce(max(f.turn) - min(f.turn) + 1 - count(distinct f.turn), 0)::bigint as gaps,
               count(*) filter (f.fault = 'blank') as blank, count(*) filter (f.fault = 'duplicate') as duplicate,
               count(*) filter (f.fault = 'truncated') as truncated,
               count(*) filter (f.pair not in ('su', 'ua', 'au')) as illegal, count(f.i) as n
        from (select distinct conv_id from given) g left join faulty f on g.conv_id is not distinct from f.conv_id
        group by g.conv_id),
    labels(conv_id, i, l0, l1, l2, l3) as (
        select conv_id, 0::bigint, {start}, {none}, {none}, {none} from counted
        union all
        select c.conv_id, r.i, {deleted[0]},
               least({deleted[1]}, {kept_if("s", (0,))}),
               least({deleted[2]}, {kept_if("u", (0, 1, 3))}, {renamed_to("user", (0, 1, 3))}),
               least({deleted[3]}, {kept_if("a", (2,))}, {renamed_to("assistant", (2,))})
        from (select conv_id, i, {inserted("w")} from labels w) c
        join steps r on c.conv_id is not distinct from r.conv_id and r.i = c.i + 1),
    ended as (
        select conv_id, least(l0, l3) as best
        from (select w.conv_id, {inserted("w")} from labels w join counted n
              on w.conv_id is not distinct from n.conv_id and w.i = n.n))
    select e.conv_id, gaps, blank, duplicate, truncated, illegal, best.cost as cost, best.audit as audit,
           sha256(best.lines[:-2]) as repaired_sha256
    from ended e join counted n on e.conv_id is not distinct from n.conv_id"""


def turn_trie_sql() -> str:
    """A node is a prefix of 64 digits per turn; its subtree is all that starts with it."""
    return f"""
    with turns as (
        select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
               row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as place
        from conversations where conv_id is not null),
    convs as (
        select distinct conv_id, conv_id - conv_id % 5 as base, {crc32_sql("conv_id::varchar")} % 9 as h from turns),
    rebuilt as (
        select c.conv_id, 0 as own, t.place, md5(role) || md5(text) as name, strlen(text)::bigint as bytes
        from convs c join turns t on t.conv_id = c.base and t.place < c.h
        union all
        select c.conv_id, 1, t.place, md5(role) || md5(text), strlen(text)::bigint
        from convs c join turns t on t.conv_id = c.conv_id and t.place >= c.h),
    paths as (
        select c.conv_id, coalesce(string_agg(name, '' order by own, place), '') as path, count(name)::bigint as n,
               list(bytes order by own, place) as sizes
        from convs c left join rebuilt r on c.conv_id = r.conv_id group by c.conv_id),
    places as (select conv_id, d, left(path, (64 * d)::int) as node, sizes[d] as bytes, n
               from (select *, unnest(range(n + 1)) as d from paths)),
    nodes as (
        select node, any_value(d) as depth, min(conv_id) as conv_id, count(*) as n_convs,
               coalesce((count(*) - 1) * any_value(bytes), 0) as saved,
               coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (d = n), '') as ends
        from places group by node),
    families as (
        select c.*, p.conv_id as parent_conv_id
        from nodes c left join nodes p on c.depth = p.depth + 1 and starts_with(c.node, p.node)),
    counted as (
        select p.node, count(c.node) as n_children
        from nodes p left join nodes c on c.depth = p.depth + 1 and starts_with(c.node, p.node) group by p.node),
    sums as (
        select v.node, count(*) filter (n_children = 0) as n_leaves, sum(w.saved)::bigint as saved_tokens
        from nodes v join (select * from nodes join counted using (node)) w on starts_with(w.node, v.node) group by v.node)
    select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) as ends_sha256
    from families join counted using (node) join sums using (node)"""
