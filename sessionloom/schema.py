"""The canonical conversation: one row with its messages in order."""

CALL = "struct<id:string,type:string,function:struct<name:string,arguments:string>>"
MESSAGE = f"struct<role:string,content:string,name:string,tool_call_id:string,is_error:boolean,tool_calls:array<{CALL}>>"
TOOL = "struct<type:string,function:struct<name:string,description:string,parameters:struct<type:string,properties:map<string,struct<type:string>>,required:array<string>>>>"
METADATA = "struct<model:string,git_branch:string,cwd:string,start_time:string,end_time:string,version:string,session_id:string,is_subagent:boolean,resumed_from:array<string>>"
CONVERSATION = f"id string, source string, metadata {METADATA}, tools array<{TOOL}>, messages array<{MESSAGE}>"
