"""DuckDB SQL for the queries that SQL can express."""

from tillstone.llm.licenses import RULES, SENTENCES


def _values(rows: list[tuple]) -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)
    return ", ".join("(" + ", ".join(quoted(x) for x in row) + ")" for row in rows)


def _crc32(text: str) -> str:
    """crc32 of an ASCII text, bit by bit."""
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::bigint,
        list_transform(string_split({text}, ''), lambda c: ascii(c)::bigint)),
        lambda acc, b: list_reduce(list_prepend(xor(acc, b), range(8)),
            lambda x, i: xor(x // 2, (x % 2) * 3988292384))))"""


def _least(options: str) -> str:
    return f"list_sort(list_filter([{options}], lambda o: o is not null))[1]"


def _put(letter: str, cost: str, line: str, then: str) -> str:
    """A candidate repair: cost, letters, lines of what is left."""
    lines = f"list_prepend({line}, {then}.r)" if line else f"{then}.r"
    return f"{{'c': {then}.c + {cost}, 'a': '{letter}' || {then}.a, 'r': {lines}}}"


def _row(state: int) -> str:
    """The repairs from a state that begin with the row itself; 0 start, 1 after system, 2 after user, 3 after assistant."""
    then, role = ("g3", "assistant") if state == 2 else ("g2", "user")
    own = "role || ':' || text"
    kept = f"when i = '{role[0]}' then {_put('K', 'cut', own, then)}"
    if state == 0:
        kept += f" when i = 's' then {_put('K', 'cut', own, 'g1')}"
    return _least(
        f"{_put('D', '2', '', f'g{state}')}, case when must then null {kept} end, "
        f"case when not must then {_put('R', '1 + cut', f"'{role}:'", then).replace(f"'{role}:'", f"'{role}:' || text")} end"
    )


def _inserted(state: int) -> str:
    first, second = (3, 2) if state == 2 else (2, 3)
    role = ["user:", "assistant:"]
    if state == 2:
        role.reverse()
    one = _put("I", "5", f"'{role[0]}'", f"b{first}")
    two = f"{{'c': b{second}.c + 10, 'a': 'II' || b{second}.a, 'r': list_prepend('{role[0]}', list_prepend('{role[1]}', b{second}.r))}}"
    return _least(f"b{state}, {one}, {two}")


_SPACES = r"\x20\x09-\x0D"

ORACLE = {
    "op1_patricia_owners": r"""
        with n as (
            select doc_id, coalesce(text, '') t,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') k
            from documents
        ), g as (
            select doc_id, k,
                   first_value(doc_id) over (partition by k order by length(t) desc, doc_id nulls last) keep_id,
                   count(*) over (partition by k) group_size,
                   row_number() over (partition by k order by length(t) desc, doc_id nulls last) r
            from n
        )
        select doc_id, keep_id, group_size, r = 1 as kept, sha256(k) as text_sha256 from g""",
    "op7_coordinate_join": r"""
        with recursive w as (
            select doc_id, list_filter(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x20\x09-\x0D]+'), lambda x: x != '') as ws
            from documents
        ), s as (
            select distinct doc_id,
                   unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
                          else list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) end) as sh
            from w
        ), n as (select doc_id, count(*) as n from s group by doc_id
        ), common as (
            select a.doc_id as a, b.doc_id as b, count(*) as c
            from s a join s b on a.sh = b.sh and a.doc_id != b.doc_id group by 1, 2
        ), links as (
            select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b
            where 100 * c >= 85 * (x.n + y.n - c)
        ), reach(v, r) as (
            select doc_id, doc_id from w
            union
            select reach.v, links.b from reach join links on links.a = reach.r
        )
        select w.doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(r) as component_id,
               w.doc_id = min(r) as kept
        from w join reach on v = w.doc_id left join n on n.doc_id = w.doc_id group by w.doc_id""",
    "op3_positional_index": r"""
        with d as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') as ws
            from documents
        ), i as (
            select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') as ws
            from benchmark
        ), windows as (
            select distinct item_id, least(13, len(ws)) as n,
                   unnest(list_transform(range(1, greatest(len(ws) - 12, 1) + 1),
                                         lambda k: array_to_string(ws[k:k + 12], ' '))) as w
            from i where len(ws) > 0
        ), grams as (
            select doc_id, n, unnest(range(1, len(ws) - n + 2)) as k, ws
            from d, (select distinct n from windows) where len(ws) >= n
        ), hits as (
            select distinct g.doc_id, g.k, g.n, w, item_id
            from (select doc_id, k, n, array_to_string(ws[k:k + n - 1], ' ') as w from grams) g
            join windows using (n, w)
        ), covered as (
            select doc_id, count(distinct p) as n_hit
            from (select doc_id, unnest(range(k, k + n)) as p from hits) group by 1
        ), named as (
            select doc_id, count(distinct item_id) as n_items,
                   string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items
            from hits group by 1
        ), terms as (
            select w, unnest(string_split(w, ' ')) as term, generate_subscripts(string_split(w, ' '), 1) - 1 as off
            from (select distinct w from windows)
        ), tokens as (
            select doc_id, unnest(ws) as term, generate_subscripts(ws, 1) - 1 as pos from d
        ), counted as (
            select w, term, off, coalesce(c, 0) as c, row_number() over (partition by w order by coalesce(c, 0), off, term) as r
            from terms left join (select term, count(*) as c from tokens group by 1) using (term)
        ), probes as (
            select w, term, off, 1 << (r - 1)::int as bit, least(3, count(*) over (partition by w)) as need,
                   min(c) over (partition by w) as least_c, r
            from counted
        ), shifted as (
            select distinct doc_id, w, pos - off as start, bit, (1 << need::int) - 1 as full_bits
            from tokens join probes using (term) where r <= 3 and least_c > 0
        ), close as (
            select distinct doc_id, w from (
                select doc_id, w, full_bits, bit_or(bit) over (partition by doc_id, w order by start
                                                               range between current row and 2 following) as bits
                from shifted
            ) where bits = full_bits
        ), nearly as (
            select doc_id, count(*) as n_near from close
            anti join (select distinct doc_id, w from hits) using (doc_id, w)
            group by 1
        )
        select d.doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(items, '')) as items_sha256,
               coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated,
               coalesce(n_near, 0) as n_near
        from d left join covered using (doc_id) left join named using (doc_id) left join nearly using (doc_id)""",
    "op6_sentence_rules": rf"""
        with known(sid, sentence) as (values {_values([(i + 1, x) for i, x in enumerate(SENTENCES)])}),
        rules(licence, rule, sids) as (values {_values(RULES)}),
        cut as (
            select doc_id, unnest(s) as sentence, generate_subscripts(s, 1) - 1 as place
            from (select doc_id, regexp_split_to_array(coalesce(text, ''), '[.!?;]+(?:\s+|$)|\n+') as s from documents)
        ), seen as (
            select doc_id, list(place order by place) as ats, list(sid order by place) as sids
            from (select doc_id, place, trim(lower(regexp_replace(sentence, '[^A-Za-z0-9]+', ' ', 'g'))) as sentence from cut)
            join known using (sentence) group by doc_id
        ), found as (
            select doc_id, ats, licence, rule, len(rules.sids) as n,
                   unnest(list_filter(range(1, len(seen.sids) - len(rules.sids) + 2),
                                      lambda i: seen.sids[i:i + len(rules.sids) - 1] = rules.sids)) as a
            from seen, rules
        )
        select doc_id, licence, rule, ats[a]::bigint as first, ats[a + n - 1]::bigint as last
        from found f
        where not exists (select 1 from found g where g.doc_id = f.doc_id and g.a <= f.a
                          and g.a + g.n >= f.a + f.n and g.n > f.n)""",
    "op11_block_tables": rf"""
        with recursive h as (
            select *, {_crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as k
            from conversations
        ), d as (
            select conv_id, turn, case when k = 4 then 'user' else coalesce(role, ' ') end as role,
                   case when k = 1 then '' when k = 2 then translate(coalesce(text, ' '), '.!?', '')
                        else coalesce(text, ' ') end as text,
                   unnest(case when k = 3 then [1, 2] else [1] end) as copy
            from h where k != 0
        ), n as (
            select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as p from d
        ), f as (
            select *, substr(role, 1, 1) as i, lag(substr(role, 1, 1)) over (partition by conv_id order by p) as j,
                   case when not regexp_matches(text, '[^{_SPACES}]') then 'b'
                        when row_number() over (partition by conv_id, role, text order by p) > 1 then 'd'
                        when not regexp_matches(text, '[.!?][{_SPACES}]*$') then 't' else '' end as fault
            from n
        ), told as (
            select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
                   count(*) filter (where fault = 'b') as blank, count(*) filter (where fault = 'd') as duplicate,
                   count(*) filter (where fault = 't') as truncated,
                   count(*) filter (where j || i not in ('su', 'ua', 'au')) as illegal, max(p) as last
            from f group by conv_id
        ), g as (
            select conv_id, last as p, {{'c': 0::bigint, 'a': '', 'r': []::varchar[]}} as g0,
                   {{'c': 10::bigint, 'a': 'II', 'r': ['user:', 'assistant:']}} as g1,
                   {{'c': 5::bigint, 'a': 'I', 'r': ['assistant:']}} as g2,
                   {{'c': 0::bigint, 'a': '', 'r': []::varchar[]}} as g3
            from told
            union all
            select conv_id, p - 1, {_inserted(0)}, {_inserted(1)}, {_inserted(2)}, {_inserted(3)}
            from (
                select conv_id, p, {_row(0)} as b0, {_row(1)} as b1, {_row(2)} as b2, {_row(3)} as b3
                from (
                    select g.conv_id, g.p, g0, g1, g2, g3, role, text, i, fault in ('b', 'd') as must,
                           case when fault = 't' then 5 else 0 end as cut
                    from g join f on f.conv_id is not distinct from g.conv_id and f.p = g.p
                )
            )
        )
        select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
               coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(g0.c, 0)::bigint as cost,
               coalesce(g0.a, '') as audit, sha256(coalesce(array_to_string(g0.r, chr(10)), '')) as repaired_sha256
        from (select distinct conv_id from conversations) o
        left join told t on t.conv_id is not distinct from o.conv_id
        left join g on g.conv_id is not distinct from o.conv_id and g.p = 0""",
    "op12_sequence_collapse": rf"""
        with t as (
            select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as p,
                   {{'r': coalesce(role, ''), 't': coalesce(text, '')}} as said
            from conversations where conv_id is not null
        ), own as (
            select conv_id, list(said order by p) as turns, {_crc32("conv_id::varchar")} % 4 as h from t group by conv_id
        ), rebuilt as (
            select c.conv_id, list_concat(list_slice(coalesce(b.turns, []), 1, c.h), list_slice(c.turns, c.h + 1, len(c.turns))) as turns
            from own c left join own b on b.conv_id = c.conv_id - c.conv_id % 20
        ), prefixes as (
            select conv_id, unnest(range(0, len(turns) + 1)) as depth, turns from rebuilt
        ), nodes as (
            select list_slice(turns, 1, depth) as seq, depth, min(conv_id) as conv_id, count(*) as n_convs,
                   sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where len(turns) = depth), '')) as ends_sha256
            from prefixes group by 1, 2
        ), children as (
            select list_slice(seq, 1, depth - 1) as seq, count(*) as n_children from nodes where depth > 0 group by 1
        ), below as (
            select list_slice(n.seq, 1, a) as seq, count(*) filter (where c.seq is null) as n_leaves,
                   sum((n_convs - 1) * case when depth = 0 then 0 else
                       len(regexp_extract_all(n.seq[depth].t, '[^{_SPACES}]+')) end) as saved_tokens
            from (select *, unnest(range(0, depth + 1)) as a from nodes) n left join children c on c.seq = n.seq group by 1
        )
        select n.conv_id, n.depth, q.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children, n_leaves,
               saved_tokens::bigint as saved_tokens, n.ends_sha256
        from nodes n join below on below.seq = n.seq left join children on children.seq = n.seq
        left join nodes q on n.depth > 0 and q.depth = n.depth - 1 and q.seq = list_slice(n.seq, 1, n.depth - 1)""",
}
