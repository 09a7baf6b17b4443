"""Command line: parse, redact, clean, evaluate, filter, validate, run."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import Observation
from pyspark.sql import functions as F

from sessionloom.operators import clean as cleaning
from sessionloom.operators import format as formatting
from sessionloom.operators import redact as redaction
from sessionloom.operators import score as scoring
from sessionloom.plans.pipeline import stages
from sessionloom.schema import CONVERSATION
from sessionloom.session import release, session, written
from sessionloom.sources import files, registry

TOKEN_VARIABLES = ("HF_TOKEN", "HUGGINGFACE_HUB_TOKEN", "HUGGING_FACE_HUB_TOKEN")
_SCORED = CONVERSATION + ", _cleaned_stats struct<removed_tool_results:int>, score double, label string"


def hub_token() -> tuple[str | None, str | None]:
    return next(((v, os.environ[v]) for v in TOKEN_VARIABLES if os.environ.get(v)), (None, None))


def dataset_card(name: str, repo: str) -> str:
    return f"---\ntags:\n- agent-conversations\n---\n\n# {repo}\n\nUploaded file: `{name}`\n"


def upload(folder: str, repo: str, private: bool = False, api=None) -> bool:
    """Uploads a written folder after a card; False without a token. ``api`` stands in for the hub's client."""
    variable, token = hub_token()
    if not token:
        print(f"No upload to {repo}: no token in {', '.join(TOKEN_VARIABLES)}", file=sys.stderr)
        return False
    if api is None:
        try:
            from huggingface_hub import HfApi
        except ImportError as e:
            raise SystemExit("an upload needs the package huggingface_hub") from e
        api = HfApi(token=token)
    api.create_repo(repo_id=repo, repo_type="dataset", private=private, exist_ok=True)
    api.upload_file(path_or_fileobj=dataset_card(os.path.basename(folder), repo).encode(), path_in_repo="README.md", repo_id=repo, repo_type="dataset")
    api.upload_folder(folder_path=folder, path_in_repo="data", repo_id=repo, repo_type="dataset")
    print(f"Uploaded {folder} to {repo} ({variable})")
    return True


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sessionloom", description="Agent session logs to training conversations")
    p.add_argument("--master", default=None, help="Spark master, where spark-submit sets none")
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, *, source=None, input=True, output=True):
        s = sub.add_parser(name)
        if source is not None:
            s.add_argument("--source", required=source, help="claude, qwen, opencode or all")
        s.add_argument("--input", required=input)
        s.add_argument("--output", required=output)
        return s

    parse, run = add("parse", source=True, input=False), add("run", source=True, input=False)
    for s in (parse, run):
        s.add_argument("--prompts", default=None, help="folder of system prompts, <source>[.<variant>].md")
        s.add_argument("--user-prompt", action="append", default=[], metavar="SOURCE=FILE", help="a system prompt of one's own for a source")
    for s in (add("redact"), run):
        s.add_argument("--wordlist", default=None, help=f"mnemonic word list, by default ${redaction.WORDLIST_VARIABLE}")
    add("clean").add_argument("--no-remove-orphaned", action="store_true")
    s = add("evaluate")
    s.add_argument("--min-turns", type=int, default=2)
    s.add_argument("--min-token-count", type=int, default=1000)
    for s in (add("filter"), run):
        s.add_argument("--min-score", type=float, default=0.5)
        s.add_argument("--hf-repo", default=None)
        s.add_argument("--hf-private", action="store_true")
    s = add("validate", source=False, input=False, output=False)
    s.add_argument("--model", default="Qwen/Qwen3.5-4B")
    return p


def template_counter(model: str):
    def make():
        from transformers import AutoTokenizer

        tool = AutoTokenizer.from_pretrained(model)
        return lambda messages, tools: len(tool.encode(tool.apply_chat_template(messages, tools=tools, tokenize=False)))

    return make


def _noted(df, **metrics):
    """The frame, and a function that gives the metrics once it was written: no second pass is made."""
    seen = Observation()
    noted = df.observe(seen, *[F.coalesce(c, F.lit(0)).alias(n) for n, c in metrics.items()])
    return noted, lambda: seen.get


def _parsed(spark, args):
    prompts = files.prompt_table(spark, args.prompts, dict(p.split("=", 1) for p in args.user_prompt))
    for r in registry.unread(spark, args.source, args.input).orderBy("file_path").collect() if args.source != "opencode" else ():
        print(f"Error parsing {r.file_path}: {r.error}", file=sys.stderr)
    return registry.in_order(registry.parse(spark, args.source, args.input, prompts))


def _validated(spark, args, out: str | None, make_counter) -> None:
    from sessionloom.operators import validate as v

    records = files.read_jsonl(spark, args.input, _SCORED) if args.input else registry.parse(spark, args.source)
    checked = written(v.validate(records, make_counter), "validated")
    r = v.report(checked).first()
    print(f"Total sessions: {r.total}\nPassed: {r.passed}\nFailed: {r.failed}\nSessions with tools: {r.sessions_with_tools}\nTotal tool calls: {r.total_tool_calls}")
    if r.passed:
        print(f"Token range: {r.min_tokens} - {r.max_tokens}\nAvg tokens: {r.avg_tokens:.0f}")
    for f in v.failures(checked).collect():
        print(f"  [{f.id}] {f.error}")
    if r.failed > 10:
        print(f"  ... and {r.failed - 10} more")
    if out:
        files.write_jsonl(v.passed(checked), out)
        print(f"Written {r.passed} validated records to {out}")


def main(argv: list[str] | None = None, spark=None, make_counter=None) -> int:
    args = parser().parse_args(argv if argv is not None else sys.argv[1:] or ["run", "--source", "all", "--output", "conversations.jsonl"])
    out = files.ensure_suffix(args.output) if args.output else None
    if args.command == "validate" and not (args.input or args.source):
        print("Error: give --input or --source", file=sys.stderr)
        return 1
    spark = spark or session(args.master)
    read = lambda: files.read_jsonl(spark, args.input, _SCORED)
    if args.command == "parse":
        df, seen = _noted(_parsed(spark, args), n=F.count("*"))
        files.write_jsonl(df, out)
        print(f"Parsed {seen()['n']} sessions. Written to {out}")
    elif args.command == "redact":
        df, seen = _noted(redaction.redact(read(), wordlist=args.wordlist), n=F.sum("n_redacted"))
        files.write_jsonl(df.drop("n_redacted"), out)
        print(f"Redacted {seen()['n']} secrets. Written to {out}")
    elif args.command == "clean":
        df, seen = _noted(cleaning.clean(read(), not args.no_remove_orphaned), n=F.count("*"), removed=F.sum("_cleaned_stats.removed_tool_results"))
        files.write_jsonl(df, out)
        print(f"Loaded {seen()['n']} conversations\nTotal tool results removed: {seen()['removed']}\nWritten to {out}")
    elif args.command == "evaluate":
        count = lambda x: F.count(F.when(F.col("label") == x, 1))
        df, seen = _noted(scoring.evaluate(read(), args.min_turns, args.min_token_count), good=count("good"), maybe=count("maybe"), bad=count("bad"))
        files.write_jsonl(df, out)
        print(f"Good: {seen()['good']}  Maybe: {seen()['maybe']}  Bad: {seen()['bad']}\nWritten to {out}")
    elif args.command == "filter":
        records, before = _noted(read(), n=F.count("*"))
        df, after = _noted(formatting.format_for_training(formatting.keep_scored(records, args.min_score)), n=F.count("*"))
        files.write_jsonl(df, out)
        print(f"Filtered {before()['n']} -> {after()['n']} records (min-score={args.min_score}). Written to {out}")
    elif args.command == "run":
        stem, target = os.path.splitext(out)[0], f"{os.path.splitext(out)[0]}_raw.jsonl"
        made = stages(written(_parsed(spark, args), "raw"), args.min_score, wordlist=args.wordlist)
        for name, df in made.items():
            target = out if name == "final" else f"{stem}_{name}.jsonl"
            files.write_jsonl(df, target)
        r = made.report()
        print(f"Redacted {r['redacted']} secrets\nTotal tool results removed: {r['removed']}\nGood: {r['good']}  Maybe: {r['maybe']}  Bad: {r['bad']}")
        print(f"Filtered {r['records']} -> {r['survivors']} records (min-score={args.min_score})\nWritten {target}")
    else:
        _validated(spark, args, out, make_counter or template_counter(args.model))
    release(spark)
    if args.command in ("filter", "run") and args.hf_repo:
        upload(out, args.hf_repo, args.hf_private)
    return 0


if __name__ == "__main__":
    sys.exit(main())
