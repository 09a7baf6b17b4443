"""SQL that computes the same rows as the core's queries."""

_WS = r"\x09-\x0d\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_TOKENS = f"case when coalesce(length(c), 0) = 0 then 0 else greatest(1, len(regexp_extract_all(c, '[^{_WS}]+')) + length(c) // 4) end"
_FILLED = f"coalesce(regexp_matches(c, '[^{_WS}]'), false)"
_FAILED = """coalesce((regexp_matches(regexp_extract(c, '(?i)Exit Code:\\s*([0-9]+)', 1), '[1-9]')
  and not (contains(lower(c), 'grep') or contains(lower(c), 'ps aux |') or contains(lower(c), 'lsof -i :') or contains(lower(c), 'sleep ') or contains(lower(c), 'jobs -l') or contains(lower(c), 'curl')))
  or contains(lower(c), 'command not found') or contains(lower(c), 'no such file or directory'), false)"""

_ROWS = """r as (select row_number() over () as rid, id, messages from conversation_records),
m as (select rid, id, unnest(range(len(messages))) as pos, unnest(messages) as m from r where messages is not null),
t as (select rid, id, pos, m.role as role, m.content as c, m.tool_call_id as call_id, coalesce(m.is_error, false) as is_error, coalesce(m.tool_calls, []) as calls from m),
k as (select rid, pos, unnest(calls) as called from t where role = 'assistant'),
kk as (select rid, pos, coalesce(called.id, '') as call_id, lower(coalesce(called.function.name, '')) as name from k)"""

_METRICS = f"""{_ROWS},
a as (select rid, count(*) as total_messages,
  coalesce(sum(case when role in ('user', 'assistant', 'tool') then {_TOKENS} end), 0)::bigint as total_tokens,
  count(*) filter (role = 'user') as user_turns, count(*) filter (role = 'assistant') as assistant_turns, count(*) filter (role = 'tool') as tool_results,
  count(*) filter (role = 'tool' and (coalesce(contains(c, 'Error:'), false) or is_error)) as tool_error_count,
  coalesce(sum(case when role = 'assistant' then len(regexp_extract_all(coalesce(c, ''), '(?s)<think>(.*?)</think>')) end), 0)::bigint as thinking_tags,
  count(*) filter (role = 'assistant' and not {_FILLED} and len(calls) = 0) as truly_empty_assistant
  from t group by rid),
b as (select rid, count(*) as tool_calls, count(distinct name) filter (name <> '') as tool_count,
  bool_or(name in ('read_file', 'view', 'cat', 'read')) as reads,
  bool_or(name in ('write_file', 'edit', 'create_file', 'str_replace_editor', 'str_replace_based_edit_tool', 'write')) as writes from kk group by rid),
cr as (select distinct rid, call_id from kk), rr as (select distinct rid, coalesce(call_id, '') as call_id from t where role = 'tool'),
p as (select cr.rid, count(rr.call_id) as complete_pairs, count(*) - count(rr.call_id) as incomplete_tool_chains from cr left join rr on cr.rid = rr.rid and cr.call_id = rr.call_id group by cr.rid),
x as (select r.rid, r.id, coalesce(total_messages, 0) as total_messages, coalesce(total_tokens, 0) as total_tokens, coalesce(user_turns, 0) as user_turns, coalesce(assistant_turns, 0) as assistant_turns,
  coalesce(tool_calls, 0) as tool_calls, coalesce(tool_results, 0) as tool_results, coalesce(complete_pairs, 0) as complete_pairs, coalesce(incomplete_tool_chains, 0) as incomplete_tool_chains,
  coalesce(thinking_tags, 0) as thinking_tags, coalesce(tool_error_count, 0) as tool_error_count, coalesce(truly_empty_assistant, 0) as truly_empty_assistant, coalesce(tool_count, 0) as tool_count,
  coalesce(reads and writes, false) as chain
  from r left join a using (rid) left join b using (rid) left join p using (rid))"""

_SCORED = f"""{_METRICS},
y as (select *, case when tool_results > 0 then tool_error_count::double / tool_results else 0.0::double end as err, case when assistant_turns > 0 then truly_empty_assistant::double / assistant_turns else 0.0::double end as emp from x),
z as (select *, least(greatest(ln(1 + total_tokens::double) / ln(8001::double), 0), 1) as s_l, least(greatest(ln(1 + tool_calls::double) / ln(21::double), 0), 1) as s_c,
  case when tool_count > 0 then least(greatest((tool_count - 1)::double / 4.0::double, 0), 1) else 0.0::double end as s_d, case when chain then 1.0::double else 0.0::double end as s_e,
  case when tool_calls > 0 then complete_pairs::double / tool_calls else 0.0::double end as s_p, case when thinking_tags > 0 then 1.0::double else 0.0::double end as s_t, case when user_turns > 0 then 1.0::double else 0.0::double end as s_u,
  least(greatest((err - 0.30::double) / 0.30::double, 0), 1) as p_e, least(greatest((emp - 0.10::double) / 0.30::double, 0), 1) as p_m from y),
w as (select *, (0.35::double * s_l + 0.20::double * s_c + 0.15::double * s_d + 0.10::double * s_e + 0.10::double * s_p + 0.05::double * s_t + 0.05::double * s_u) - 0.30::double * p_e - 0.20::double * p_m as raw,
  total_messages < 2 or total_tokens < 1000 as trivial from z),
v as (select *, least(greatest(case when trivial then 0.0::double when tool_calls = 0 then least(raw, 0.4::double) else raw end, 0), 1) as s from w),
scored as (select *, cast(printf('%.3f', s) as double) as score, case when s >= 0.7::double then 'good' when s >= 0.5::double then 'maybe' else 'bad' end as label from v)"""

_NORM = "nullif(lower(regexp_replace(%s, '^\\s+|\\s+$', '', 'g')), '')"

_FOREST = f"""with recursive e as (select file_path, line_no, row_id, {_NORM % 'uuid'} as uuid, {_NORM % 'parentUuid'} as parent, {_NORM % 'leafUuid'} as leaf, lower(trim(type)) as type from claude_entries),
        head as (select file_path, uuid, parent from (select *, row_number() over (partition by file_path order by line_no, row_id) as n from e where uuid is not null) where n = 1),
        sm as (select file_path, leaf from (select *, row_number() over (partition by file_path order by line_no, row_id) as n from e where type = 'summary' and leaf is not null) where n = 1),
        lk as (select head.uuid, sm.leaf as parent from head join sm using (file_path) where head.parent is null and not exists (select 1 from e where e.file_path = head.file_path and e.uuid = sm.leaf)),
        n as (select uuid, max(parent) as parent from (select uuid, parent from e where uuid is not null union all select uuid, parent from lk) group by uuid),
        g as (select n.uuid, n.parent, p.uuid is not null as has from n left join n p on p.uuid = n.parent),
        t(uuid, root_uuid, depth) as (select uuid, uuid, 0 from g where not has union all select g.uuid, t.root_uuid, t.depth + 1 from t join g on g.parent = t.uuid and g.has)"""
_ROOTS = "select n.uuid, coalesce(t.root_uuid, 'cycle') as root_uuid, coalesce(t.depth, -1)::integer as depth from n left join t on t.uuid = n.uuid"

SQL: dict[str, str] = {
    "conv_token_counts": f"with {_ROWS} select id, sum({_TOKENS})::bigint as n_tokens from t where role in ('user', 'assistant', 'tool') group by id",
    "conv_metrics": f"""with {_SCORED} select id, total_messages, total_tokens, user_turns, assistant_turns, tool_calls, tool_results, incomplete_tool_chains, thinking_tags, tool_error_count,
        cast(printf('%.3f', err) as double) as error_ratio, truly_empty_assistant, tool_count from scored""",
    "conv_score": f"""with {_SCORED} select id, score, label, concat_ws(';', printf('length:%.2f', s_l), printf('calls:%.2f', s_c), printf('diversity:%.2f', s_d), printf('editchain:%.2f', s_e), printf('pairing:%.2f', s_p),
        case when s_t > 0 then 'thinking' end, case when s_u = 0 then 'no_user_input' end, case when p_e > 0 then printf('-error_ratio:%.2f', err) end, case when p_m > 0 then printf('-empty_ratio:%.2f', emp) end,
        case when trivial then 'hard_floor:trivial' when tool_calls = 0 then 'cap:no_tool_calls' end) as reasons from scored""",
    "conv_label_hist": f"with {_SCORED} select label, count(*) as n from scored group by label",
    "conv_filter": f"with {_SCORED} select id, score from scored where score >= 0.5",
    "conv_tools_used": f"with {_ROWS} select r.id, coalesce(n.tools, '') as tools_used from r left join (select rid, string_agg(name, ',' order by name) as tools from (select distinct rid, name from kk where name <> '') group by rid) n using (rid)",
    "conv_tool_pairs": f"with {_METRICS} select id, complete_pairs, incomplete_tool_chains as incomplete_calls from x",
    "failed_commands": f"with {_ROWS} select id, pos::bigint as pos, {_FAILED} as failed from t where role = 'tool'",
    "clean_conversations": f"""with {_ROWS},
        kept as (select * from t where role in ('system', 'user') or (role = 'assistant' and ({_FILLED} or len(calls) > 0)) or (role = 'tool' and not {_FAILED})),
        res as (select distinct rid, coalesce(call_id, '') as call_id from kept where role = 'tool'),
        n as (select kk.rid, kk.pos, count(res.call_id) as n from kk left join res on kk.rid = res.rid and kk.call_id = res.call_id group by kk.rid, kk.pos),
        f as (select kept.*, coalesce(n.n, 0) as n from kept left join n on kept.rid = n.rid and kept.pos = n.pos and kept.role = 'assistant'),
        g as (select rid, string_agg(substr(role, 1, 1), '' order by pos) as roles, sum(n)::bigint as n_calls from f where not (role = 'assistant' and len(calls) > 0 and n = 0 and not {_FILLED}) group by rid),
        d as (select rid, count(*) as removed from t where role = 'tool' and {_FAILED} group by rid)
        select r.id, coalesce(d.removed, 0)::bigint as removed, coalesce(g.roles, '') as roles, coalesce(g.n_calls, 0)::bigint as n_calls from r left join g using (rid) left join d using (rid)""",
    "clean_keep_orphans": f"""with {_ROWS} select r.id, count(t.pos)::bigint as n_messages from r left join (select * from t where role in ('system', 'user') or (role = 'assistant' and ({_FILLED} or len(calls) > 0)) or (role = 'tool' and not {_FAILED})) t using (rid) group by r.rid, r.id""",
    "thinking": f"""with {_ROWS}, h as (select id, pos, c, regexp_extract_all(c, '(?s)<think>(.*?)</think>', 1) as th, regexp_replace(regexp_replace(c, '(?s)<think>(.*?)</think>', '', 'g'), '^[{_WS}]+|[{_WS}]+$', '', 'g') as rest from t where role = 'assistant' and c like '%<think>%')
        select id, pos::bigint as pos, len(th)::bigint as n, md5(case when len(th) = 0 then rest when rest = '' then '<think>' || chr(10) || array_to_string(th, chr(10)) || chr(10) || '</think>' else regexp_replace('<think>' || chr(10) || array_to_string(th, chr(10)) || chr(10) || '</think>' || chr(10) || rest, '^[{_WS}]+|[{_WS}]+$', '', 'g') end) as text_md5 from h""",
    "user_hashes": "select name, 'user_' || substr(sha256(name), 1, 8) as \"user\" from name_list",
    "prompt_variants": """with m as (select coalesce(json_extract_string(data, '$.model.modelID'), case when json_type(data, '$.model') <> 'OBJECT' then json_extract_string(data, '$.model') end) as model from opencode_message),
        v as (select model, trim(coalesce(model, '')) as t from m)
        select model, case when contains(t, 'gpt-4') or contains(t, 'o1') or contains(t, 'o3') then 'beast' when contains(t, 'gpt') then (case when contains(t, 'codex') then 'codex' else 'gpt' end) when contains(t, 'gemini-') then 'gemini'
        when contains(t, 'claude') then 'anthropic' when contains(lower(t), 'trinity') then 'trinity' when contains(lower(t), 'kimi') then 'kimi' else 'default' end as variant, count(*) as n from v group by 1, 2""",
    "first_versions": "select file_path, uuid, row_id, type from (select file_path, uuid, row_id, type, row_number() over (partition by file_path, uuid order by row_id) as n from qwen_entries) where n = 1",
    "anonymised_paths": "select project, replace(replace(replace(root_path, '/srv/ws', '/home/REDACTED_USER'), 'checkout', 'user_' || substr(sha256('checkout'), 1, 8)), 'build', 'user_' || substr(sha256('build'), 1, 8)) as path from workspaces",
    "session_chains": """with recursive e as (select file_path, line_no, row_id, type, nullif(uuid, '') as uuid, nullif(parentUuid, '') as parent, nullif(leafUuid, '') as leaf from claude_entries),
        own as (select distinct file_path, uuid from e where uuid is not null),
        fp as (select file_path, parent from (select *, row_number() over (partition by file_path order by line_no, row_id) as n from e where parent is not null) where n = 1),
        sl as (select file_path, leaf from (select *, row_number() over (partition by file_path order by line_no, row_id) as n from e where type = 'summary' and leaf is not null) where n = 1),
        main as (select distinct file_path from claude_entries where not contains(file_path, '/subagents/')),
        anc as (select m.file_path, coalesce(case when own.uuid is null then fp.parent end, sl.leaf) as anchor from main m left join fp using (file_path) left join own on own.file_path = fp.file_path and own.uuid = fp.parent left join sl on sl.file_path = m.file_path),
        owner as (select uuid as anchor, max(file_path) as prev from own where not contains(file_path, '/subagents/') group by uuid),
        edge as (select prev, min(anc.file_path) as nxt from anc join owner using (anchor) where prev <> anc.file_path group by prev),
        c(file_path, root, place) as (select file_path, file_path, 0::bigint from main where file_path not in (select nxt from edge) union all select edge.nxt, c.root, c.place + 1 from c join edge on edge.prev = c.file_path)
        select file_path, root, place from c""",
    "p5_found": f"{_FOREST} {_ROOTS}",
    "p5_contracted": f"{_FOREST} {_ROOTS}",
    "p5_descendants": f"""{_FOREST},
        r(uuid, descendant, distance) as (select g.parent, g.uuid, 1 from g join t on t.uuid = g.uuid where g.has union all select g.parent, r.descendant, r.distance + 1 from r join g on g.uuid = r.uuid where g.has)
        select uuid, descendant, distance::integer as distance from r""",
    "p6_steps": """with recursive o(stream, file_seq, line_id, prefix, doc) as (select stream, file_seq, line_id, '', line::json from raw_lines where json_valid(line) and json_type(line) = 'OBJECT'
          union all select stream, file_seq, line_id, prefix || k || '.', json_extract(doc, '$."' || k || '"') from (select *, unnest(json_keys(doc)) as k from o) where json_type(doc, '$."' || k || '"') = 'OBJECT'),
        v as (select stream, file_seq, prefix || k as field, case when t in ('VARCHAR', 'BOOLEAN', 'ARRAY', 'OBJECT') then t when t <> 'NULL' then 'NUMBER' end as kind from (select *, json_type(doc, '$."' || k || '"') as t from (select *, unnest(json_keys(doc)) as k from o))),
        f as (select stream, file_seq, field, coalesce(list_sort(list(distinct kind) filter (kind is not null)), []) as kinds from v where stream is not null and file_seq is not null group by all),
        n as (select stream, file_seq, row_number() over (partition by stream order by file_seq) as nth, lead(file_seq) over (partition by stream order by file_seq) as after from (select distinct stream, file_seq from raw_lines where stream is not null and file_seq is not null)),
        p as (select f.*, nth, after, lag(nth) over w as before, lag(kinds) over w as was, lead(nth) over w as next from f join n using (stream, file_seq) window w as (partition by stream, field order by nth))
        select stream, file_seq, field, 'added' as change from p where nth > 1 and coalesce(before <> nth - 1, true)
        union all select stream, file_seq, field, 'type_changed' from p where before = nth - 1 and was <> kinds
        union all select stream, after, field, 'removed' from p where after is not null and coalesce(next <> nth + 1, true)""",
    "arrow_safe_records": f"""with {_ROWS}, tl as (select row_number() over () as rid, case when coalesce(tools, '[]') not in ('[]', '', 'null') then tools end as tools from conversation_records),
        j as (select rid, id, pos, '{{' || concat_ws(',', '"role":' || to_json(role)::varchar, '"content":' || to_json(c)::varchar, '"name":' || to_json(m.name)::varchar, '"tool_call_id":' || to_json(m.tool_call_id)::varchar,
          case when m.is_error is not null then '"is_error":' || m.is_error::varchar end,
          case when len(m.tool_calls) > 0 then '"tool_calls":[' || array_to_string(list_transform(m.tool_calls, lambda x: '{{' || concat_ws(',', '"id":' || to_json(x.id)::varchar, '"type":' || to_json(x.type)::varchar,
            '"function":{{' || concat_ws(',', '"name":' || to_json(x.function.name)::varchar, '"arguments":' || case when json_valid(x.function.arguments) then regexp_replace(x.function.arguments, '^[{_WS}]+|[{_WS}]+$', '', 'g') else to_json(x.function.arguments)::varchar end) || '}}') || '}}'), ',') || ']' end,
          case when pos = 0 then '"tools":' || tl.tools end) || '}}' as json from (select m.rid, m.id, m.pos, m.m, m.m.role as role, m.m.content as c from m) left join tl using (rid))
        select r.id, count(j.json) as n, coalesce(string_agg(j.json, chr(10) order by j.pos), '') as json from r left join j using (rid) group by r.rid, r.id""",
}
