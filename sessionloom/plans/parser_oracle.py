"""SQL that computes the same rows as the parsers' queries."""

from sessionloom.plans.oracle import _WS

_STRIP = f"regexp_replace(%s, '^[{_WS}]+|[{_WS}]+$', '', 'g')"
_FULL = f"regexp_matches(%s, '[^{_WS}]')"
_COUNTS = "count(*) filter (role = 'user') as users, count(*) filter (role = 'assistant') as assistants, count(*) filter (role = 'tool') as tools"
_MD5 = "md5(string_agg(role || '|' || content || '|' || call_id, chr(10) order by %s)) as messages_md5"

_STORE = f"""with s as (select distinct id, directory, time_created, time_updated from opencode_session),
  m as (select distinct id as message_id, session_id, data, time_created, json_extract_string(data, '$.role') as role from opencode_message),
  p as (select message_id, data, row_number() over (partition by message_id order by time_created nulls first, data) as n, json_extract_string(data, '$.type') as type, json_extract_string(data, '$.text') as text
    from (select distinct message_id, data, time_created from opencode_part)),
  t as (select message_id, {_STRIP % "string_agg(case type when 'text' then text else '<think>' || text || '</think>' end, chr(10) order by type = 'text', case type when 'text' then n else -n end)"} as content
    from p where type in ('text', 'reasoning') and {_FULL % 'text'} group by message_id),
  w as (select message_id, k, coalesce(json_extract_string(data, '$.id'), 'call_' || k) as call_id, coalesce(json_extract_string(data, '$.state.output'), '') as output
    from (select *, row_number() over (partition by message_id order by n) - 1 as k from p where type = 'tool')),
  n as (select message_id, count(*) as n_calls from w group by message_id),
  msg as (select m.session_id, m.time_created, m.data, m.message_id, 0 as k, m.role, coalesce(t.content, '') as content, '' as call_id from m left join t using (message_id) left join n using (message_id)
    where m.role in ('user', 'assistant') and (coalesce(t.content, '') <> '' or (m.role = 'assistant' and n_calls > 0))
    union all select m.session_id, m.time_created, m.data, m.message_id, w.k + 1, 'tool', w.output, w.call_id from m join w using (message_id) where m.role = 'assistant' and w.output <> ''),
  ses as (select session_id, {_COUNTS}, {_MD5 % "time_created nulls first, data, message_id, k"} from msg group by session_id having count(*) >= 2)
  select s.id, users, assistants, tools, s.time_created as start_time, s.time_updated as end_time, messages_md5 from ses join s on s.id = ses.session_id"""

_THOUGHTS = "'<think>' || chr(10) || array_to_string(th, chr(10)) || chr(10) || '</think>'"
_CHAT = f"""with e as (select file_path, line_no, row_id, coalesce(uuid, '') as uuid, type, subtype, coalesce("timestamp", '') as ts, parts, coalesce(callId, '') as call_id from qwen_entries),
  f as (select * from (select *, max(coalesce(type in ('user', 'assistant', 'tool_result') or (type = 'system' and subtype = 'ui_telemetry'), false)::int)
    over (partition by file_path, uuid order by ts, line_no, row_id rows between unbounded preceding and 1 preceding) as blocked from e) where coalesce(blocked, 0) = 0),
  tm as (select file_path, min(ts) filter (ts <> '') as start_time, max(ts) filter (ts <> '') as end_time from f group by file_path),
  x as (select file_path, ts, line_no, row_id, type, call_id, unnest(range(len(ps))) as k, unnest(ps) as part from
    (select *, case when json_valid(parts) then case when json_type(parts) = 'ARRAY' then parts::json[] end end as ps from f) where ps is not null),
  y as (select *, json_extract_string(part, '$.text') as text, json_type(part, '$.functionCall') = 'OBJECT' as is_call, json_type(part, '$.functionResponse') = 'OBJECT' as is_response from x),
  c as (select *, row_number() over (partition by file_path, ts, line_no, row_id order by k) - 1 as i from y where type = 'assistant' and text is null and is_call),
  u as (select file_path, ts, line_no, row_id, {_STRIP % "string_agg(text, chr(10) order by k)"} as content from y where type = 'user' and text <> '' and not contains(text, '--- Content from referenced files ---') group by all),
  h as (select *, regexp_extract_all(raw, '(?s)<think>(.*?)</think>', 1) as th, {_STRIP % "regexp_replace(raw, '(?s)<think>(.*?)</think>', '', 'g')"} as rest
    from (select file_path, ts, line_no, row_id, coalesce(string_agg(text, chr(10) order by k) filter (text is not null), '') as raw, count(*) filter (text is null and is_call) as n_calls from y where type = 'assistant' group by all)),
  g as (select file_path, ts, line_no, row_id, n_calls, case when len(th) = 0 then rest when rest = '' then {_THOUGHTS} else {_STRIP % f"({_THOUGHTS} || chr(10) || rest)"} end as content from h),
  r as (select *, json_extract_string(part, '$.functionResponse.response.output') as o, json_extract_string(part, '$.functionResponse.response.error') as err from y where type = 'tool_result' and is_response),
  a as (select file_path, ts, line_no, row_id, k, call_id, {_STRIP % "concat_ws(chr(10), nullif(o, ''), 'Error: ' || nullif(err, ''))"} as content from r),
  msg as (select file_path, ts, line_no, row_id, 0 as k, 'user' as role, content, '' as call_id from u where content <> ''
    union all select file_path, ts, line_no, row_id, 0, 'assistant', content, '' from g where content <> '' or n_calls > 0
    union all select file_path, ts, line_no, row_id, k, 'tool', content, call_id from a where content <> ''),
  ses as (select file_path, {_COUNTS}, {_MD5 % "ts, line_no, row_id, k"} from msg group by file_path having count(*) >= 2)"""
_STEM = "regexp_extract(%s, '([^/]*?)(?:\\.[^./]*)?$', 1)"

_TREE = f"""with recursive e as (select file_path, line_no, row_id, type, nullif(uuid, '') as uuid, nullif(parentUuid, '') as parent, nullif(leafUuid, '') as leaf, sessionId, "timestamp" as ts,
    coalesce(isCompactSummary, false) or coalesce(isMeta, false) as synthetic, message.content as content from claude_entries),
  l as (select *, case when starts_with(content, '[') then case when json_valid(content) then content::json[] end end as items from e where type in ('user', 'assistant')),
  b as (select *, case when len(list_filter(items, lambda i: json_type(i) <> 'OBJECT' or coalesce(json_type(i, '$.type'), 'NULL') = 'NULL')) = 0 then items end as blocks from l),
  x as (select file_path, line_no, row_id, type, synthetic, unnest(range(len(blocks))) as k, unnest(blocks) as block from b where blocks is not null),
  y as (select *, json_extract_string(block, '$.type') as kind from x),
  res as (select file_path, call_id, content from (select file_path, json_extract_string(block, '$.tool_use_id') as call_id, row_number() over (partition by file_path, json_extract_string(block, '$.tool_use_id') order by line_no desc, row_id desc, k desc) as n,
      case when json_type(block, '$.content') = 'ARRAY' then array_to_string(list_transform(json_extract(block, '$.content')::json[], lambda i: coalesce(json_extract_string(i, '$.text'), json_extract_string(i, '$'))), chr(10)) else coalesce(json_extract_string(block, '$.content'), '') end as content
    from y where type = 'user' and kind = 'tool_result' and json_extract_string(block, '$.tool_use_id') <> '') where n = 1),
  said as (select file_path, line_no, row_id, {_STRIP % "string_agg(case kind when 'text' then text else '<think>' || text || '</think>' end, chr(10) order by kind = 'text', case kind when 'text' then k else -k end)"} as content
    from (select *, json_extract_string(block, '$.' || kind) as text from y where (kind = 'text' or (kind = 'thinking' and type = 'assistant')) and not synthetic) where {_FULL % 'text'} group by all),
  call as (select file_path, line_no, row_id, coalesce(json_extract_string(block, '$.id'), '') as call_id, row_number() over (partition by file_path, line_no, row_id order by k) as k from y where type = 'assistant' and kind = 'tool_use' and not synthetic),
  n as (select file_path, line_no, row_id, count(*) as n_calls from call group by all),
  msg as (select file_path, line_no, row_id, 0 as k, type as role, content, '' as call_id from (select b.file_path, b.line_no, b.row_id, b.type, n_calls, coalesce(case when b.blocks is not null then said.content when b.type = 'user' then {_STRIP % 'b.content'} end, '') as content
      from b left join said using (file_path, line_no, row_id) left join n using (file_path, line_no, row_id) where not b.synthetic) where content <> '' or n_calls > 0
    union all select file_path, line_no, row_id, k, 'tool', res.content, call_id from call join res using (file_path, call_id) where res.content <> ''),
  ses as (select file_path, count(*) as n_messages, {_COUNTS}, {_MD5 % "line_no, row_id, k"} from msg group by file_path having count(*) >= 2),
  head as (select file_path, sessionId, ts from (select *, row_number() over (partition by file_path order by line_no, row_id) as n from e) where n = 1),
  fin as (select file_path, ts from (select *, row_number() over (partition by file_path order by line_no desc, row_id desc) as n from e where ts <> '') where n = 1),
  tree as (select file_path, coalesce(nullif(head.sessionId, ''), {_STEM % 'file_path'}) || case when contains(file_path, '/subagents/') then '::' || {_STEM % 'file_path'} else '' end as id, head.ts as start_time, fin.ts as end_time, ses.* exclude (file_path)
    from ses join head using (file_path) left join fin using (file_path))"""

SQL: dict[str, str] = {
    "parse_stores": _STORE,
    "parse_chats": f"{_CHAT} select {_STEM % 'file_path'} as id, users, assistants, tools, start_time, end_time, messages_md5 from ses join tm using (file_path)",
    "first_tool_schemas": f"""{_CHAT},
  k as (select file_path, ts, line_no, row_id, i, json_extract_string(part, '$.functionCall.name') as name, case when json_type(part, '$.functionCall.args') = 'OBJECT' then json_extract(part, '$.functionCall.args') end as args from c),
  d as (select * from (select *, row_number() over (partition by file_path, name order by ts, line_no, row_id, i) as n from k where name <> '') where n = 1)
  select {_STEM % 'file_path'} as id, row_number() over (partition by file_path order by ts, line_no, row_id, i) - 1 as pos, name,
    coalesce(array_to_string(list_filter(json_keys(args), lambda j: not starts_with(j, '_') and json_type(args, '$."' || j || '"') <> 'NULL'), ','), '') as required from d semi join ses using (file_path)""",
    "parse_trees": f"{_TREE} select id, users, assistants, tools, start_time, end_time, messages_md5 from tree",
    "stitched_sessions": f"""{_TREE},
  own as (select distinct file_path, uuid from e where uuid is not null),
  fp as (select file_path, parent from (select *, row_number() over (partition by file_path order by line_no, row_id) as n from e where parent is not null) where n = 1),
  sl as (select file_path, leaf from (select *, row_number() over (partition by file_path order by line_no, row_id) as n from e where type = 'summary' and leaf is not null) where n = 1),
  main as (select file_path from tree where not contains(file_path, '/subagents/')),
  anc as (select m.file_path, coalesce(case when own.uuid is null then fp.parent end, sl.leaf) as anchor from main m left join fp using (file_path) left join own on own.file_path = fp.file_path and own.uuid = fp.parent left join sl on sl.file_path = m.file_path),
  owner as (select uuid as anchor, max(file_path) as prev from own semi join main using (file_path) group by uuid),
  edge as (select prev, min(anc.file_path) as nxt from anc join owner using (anchor) where prev <> anc.file_path group by prev),
  ch(file_path, root) as (select file_path, file_path from main where file_path not in (select nxt from edge) union all select edge.nxt, ch.root from ch join edge on edge.prev = ch.file_path)
  select r.id, count(*) - 1 as resumed, sum(t.n_messages)::bigint as n_messages from ch join tree t using (file_path) join tree r on r.file_path = ch.root group by r.file_path, r.id
  union all select id, 0, n_messages from tree where contains(file_path, '/subagents/')""",
}
